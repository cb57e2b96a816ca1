"""Chat formatting: roles of raw transcripts by a hidden Markov model, then canonical turns.

A transcript is a sequence of lines.  A line is observed as its speaker marker, if any, and its
length class, or as blank.  The hidden state is a role and whether the line begins a turn, goes
on with it, or is a gap in or after it.  Start, transition and emission chances are counted from
conversations whose roles are known; Viterbi decoding finds the likeliest states.

A transcript of any length is decoded in parts.  Lines are dealt by ranges of (transcript,
place), so a long one spans several tasks.  A task sums up a part that reaches an edge of its
range as a matrix: the best score from each state before it to each state at its end.  The
driver chains these matrices, two for a task at most, and fixes the states at the edges; then each
task decodes its parts between fixed ends, which gives the same states as one run.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talentgrid.llm.frames import checkpointed, pick

ROLES = ["system", "user", "assistant"]
#: Speaker markers of common transcript styles, for each role in the same order.
MARKERS = {
    "system": ["System:", "Instructions:", "[SYSTEM]", "**System**:", "<|system|>"],
    "user": ["User:", "Human:", "[USER]", "**User**:", "<|user|>"],
    "assistant": ["Assistant:", "AI:", "[ASSISTANT]", "**Assistant**:", "<|assistant|>"],
}
#: Upper bounds of the length classes but the last.
LENGTHS = [60, 240]
BEGIN, INSIDE, GAP = range(3)
STATES = 3 * len(ROLES)  # 3 * role + BEGIN, INSIDE or GAP
CLASSES = len(LENGTHS) + 1
BLANK = CLASSES * (len(ROLES) + 1)
SYMBOLS = BLANK + 1


def _pattern(markers: list[str]) -> str:
    escaped = ["".join(c if c.isalnum() else "\\" + c for c in marker) for marker in markers]
    return r"(?i)^\s*(?:" + "|".join(escaped) + r")\s?"


def symbol(line: Column) -> Column:
    """What is observed of a line, as an integer below SYMBOLS."""
    kind = F.lit(0)
    for place, role in enumerate(ROLES):
        kind = F.when(line.rlike(_pattern(MARKERS[role])), place + 1).otherwise(kind)
    size = F.lit(len(LENGTHS))
    for place, bound in reversed(list(enumerate(LENGTHS))):
        size = F.when(F.char_length(line) <= bound, place).otherwise(size)
    return F.when(line.rlike(r"^\s*$"), BLANK).otherwise(kind * CLASSES + size).cast("int")


def unmarked(line: Column) -> Column:
    """The line without a speaker marker at its beginning."""
    return F.regexp_replace(line, _pattern([marker for role in ROLES for marker in MARKERS[role]]), "")


@dataclass
class Model:
    """Logarithms of the chances of first states, next states and symbols."""

    start: np.ndarray
    step: np.ndarray
    emit: np.ndarray


def train(lines: DataFrame) -> Model:
    """Count a model from lines of known transcripts: conv_id, turn, line_no, role, line.

    Turns are numbered without gaps; of rows that repeat a turn's number, the first role by name
    tells how turns follow each other.  Rows with another role, or nulls, teach nothing.  Each
    possible event counts half a time more, so nothing is impossible that the states allow.
    """
    known = pick(lines, "conv_id", "turn", "line_no", "role", "line").dropna().filter(F.col("role").isin(ROLES))
    role = F.array_position(F.array(*map(F.lit, ROLES)), F.col("role")).cast("int") - 1
    seen = symbol(F.col("line"))
    known = known.select("conv_id", "turn", "line_no", "line", role.alias("role"), seen.alias("symbol"))
    kind = F.when(F.col("line_no") == 0, BEGIN).when(F.col("symbol") == BLANK, GAP).otherwise(INSIDE)
    known = known.withColumn("state", 3 * F.col("role") + kind)
    emit = np.full((STATES, SYMBOLS), 0.5)
    for row in known.groupBy("state", "symbol").agg(F.count(F.lit(1)).alias("n")).collect():
        emit[row.state, row.symbol] += row.n
    # next states inside a turn, and the role that follows one
    turns = known.groupBy("conv_id", "turn").agg(
        F.min("role").alias("role"), F.max_by("state", "line_no").alias("last")
    )
    after = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("role").alias("next"))
    follow = turns.join(after, ["conv_id", "turn"]).groupBy("last", "next").agg(F.count(F.lit(1)).alias("n"))
    inside = known.select(
        "conv_id", "turn", (F.col("line_no") + 1).alias("line_no"), F.col("state").alias("before")
    ).dropDuplicates(["conv_id", "turn", "line_no"]).join(
        known.select("conv_id", "turn", "line_no", "state"), ["conv_id", "turn", "line_no"]
    ).groupBy("before", "state").agg(F.count(F.lit(1)).alias("n"))
    step = np.zeros((STATES, STATES))
    for before in range(STATES):
        step[before, BEGIN::3] = 0.5
        step[before, [before // 3 * 3 + INSIDE, before // 3 * 3 + GAP]] = 0.5
    for row in follow.collect():
        step[row.last, 3 * row.next + BEGIN] += row.n
    for row in inside.collect():
        if row.before // 3 == row.state // 3 and row.state % 3 != BEGIN:
            step[row.before, row.state] += row.n
    start = np.zeros(STATES)
    start[BEGIN::3] = 0.5
    for row in turns.groupBy("conv_id").agg(F.min_by("role", "turn").alias("role")).groupBy("role").count().collect():
        start[3 * row.role + BEGIN] += row["count"]
    with np.errstate(divide="ignore"):
        return Model(*(np.log(x / x.sum(-1, keepdims=True)) for x in (start, step, emit)))


def span(model: Model, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best scores of a part: from its beginning to each last state, and from each state before."""
    best = np.full((STATES + 1, STATES), -np.inf)
    best[0] = model.start + model.emit[:, symbols[0]]
    best[1:] = model.step + model.emit[:, symbols[0]]
    for seen in symbols[1:]:
        best = (best[:, :, None] + model.step).max(1) + model.emit[:, seen]
    return best[0], best[1:]


def decode(model: Model, symbols: np.ndarray, before: int | None = None, last: int | None = None) -> list[int]:
    """The likeliest states, after the state ``before`` and with the last state ``last`` if given.

    Of equally likely ones the last state with the lowest number is taken, then so on backwards.
    """
    score = (model.start if before is None else model.step[before]) + model.emit[:, symbols[0]]
    came = []
    for seen in symbols[1:]:
        ways = score[:, None] + model.step
        came.append(ways.argmax(0))
        score = ways.max(0) + model.emit[:, seen]
    states = [int(score.argmax()) if last is None else last]
    for back in reversed(came):
        states.append(int(back[states[-1]]))
    return states[::-1]


def _parts(batches):
    """(conv_id, columns) of each run of rows of one transcript in a task, in order."""
    held, current = [], None
    for batch in batches:
        ids = batch.column(0).to_pylist()
        cuts = [0, *[i for i in range(1, len(ids)) if ids[i] != ids[i - 1]], len(ids)]
        for i, j in zip(cuts, cuts[1:]):
            if i == j:
                continue
            if held and ids[i] != current:
                yield current, pa.Table.from_batches(held)
                held = []
            current = ids[i]
            held.append(batch.slice(i, j - i))
    if held:
        yield current, pa.Table.from_batches(held)


def _edges(ordered: DataFrame, model: Model) -> dict[tuple[int, int], tuple[int | None, int, bool]]:
    """For parts of transcripts that span tasks: the fixed state before and the last state.

    The key is (task, 0 for its first part or 1 for its last one).
    """
    def work(batches):
        task, before = TaskContext.get().partitionId(), None
        found = []
        for number, (conv_id, part) in enumerate(_parts(batches)):
            if number < 2:
                found.append((number, conv_id, part["symbol"].to_numpy()))
            else:
                found[1] = (number, conv_id, part["symbol"].to_numpy())
        for number, conv_id, symbols in found:
            first, rest = span(model, symbols)
            yield pa.RecordBatch.from_arrays([
                pa.array([task], pa.int32()), pa.array([number > 0]), pa.array([None if conv_id is None else str(conv_id)], pa.string()),
                pa.array([len(found) == 1]), pa.array([first.tolist()]), pa.array([rest.ravel().tolist()]),
            ], names=["task", "is_last", "conv_id", "only", "first", "rest"])

    rows = ordered.mapInArrow(
        work, "task int, is_last boolean, conv_id string, only boolean, first array<double>, rest array<double>"
    ).collect()
    rows.sort(key=lambda row: (row.task, row.is_last))
    chains: list[list] = []
    for row in rows:
        reaches = chains and chains[-1][-1].task < row.task and not row.is_last
        if reaches and chains[-1][-1].conv_id == row.conv_id:
            chains[-1].append(row)
        else:
            chains.append([row])
    fixed = {}
    for chain in chains:
        if len(chain) < 2:
            continue
        score, came = np.array(chain[0].first), []
        for row in chain[1:]:
            ways = score[:, None] + np.array(row.rest).reshape(STATES, STATES)
            came.append(ways.argmax(0))
            score = ways.max(0)
        state = int(score.argmax())
        for row, back in zip(reversed(chain), [*reversed(came), None]):
            before = None if back is None else int(back[state])
            fixed[row.task, int(row.is_last)] = (before, state)
            state = before
    return fixed


def parse(lines: DataFrame, model: Model, tasks: int | None = None) -> DataFrame:
    """(conv_id, turn_no, role, n_lines, text) of the turns found in transcripts.

    ``lines`` has columns conv_id, part, line_no and line: the lines of a transcript in order of
    (part, line_no), equal places by text.  Markers are taken off where a turn begins and blank
    lines at its end are left out; a null line counts as blank.  Rows without conv_id form one
    transcript.  Turns are numbered from 0.
    """
    source = pick(lines, "conv_id", "part", "line_no", "line").withColumn("line", F.coalesce("line", F.lit("")))
    tasks = tasks or int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = ["conv_id", "part", "line_no", "line"]
    ordered = checkpointed(
        source.select(*place, symbol(F.col("line")).alias("symbol"), unmarked(F.col("line")).alias("bare"))
        .repartitionByRange(tasks, *place).sortWithinPartitions(*place)
    )
    fixed = _edges(ordered, model)
    id_type = source.schema["conv_id"].dataType.simpleString()

    def work(batches):
        task = TaskContext.get().partitionId()
        pending = None
        for number, (conv_id, part) in enumerate(_parts(batches)):
            if pending is not None:
                yield from turns(task, *pending, False)
            pending = (number, conv_id, part)
        if pending is not None:
            yield from turns(task, *pending, True)

    def turns(task, number, conv_id, part, last):
        edge = fixed.get((task, 0)) if number == 0 else fixed.get((task, 1)) if last else None
        before, end = edge or (None, None)
        states = decode(model, part["symbol"].to_numpy(), before, end)
        whole, bare = part["line"].to_pylist(), part["bare"].to_pylist()
        rows, text = [], []
        for state, line, stripped in zip(states, whole, bare):
            if state % 3 == BEGIN or not rows:
                rows.append((state // 3, state % 3 == BEGIN, text := []))
            text.append(stripped if state % 3 == BEGIN else line)
        shift = 0 if rows[0][1] else -1
        ids = pa.array([conv_id] * len(rows), part.schema.field(0).type)
        yield pa.RecordBatch.from_arrays([
            ids, pa.array([task] * len(rows), pa.int32()), pa.array(range(shift, len(rows) + shift), pa.int64()),
            pa.array([ROLES[role] for role, _, _ in rows]), pa.array([len(text) for _, _, text in rows], pa.int64()),
            pa.array(["\n".join(text) for _, _, text in rows]), pa.array([edge is not None] * len(rows)),
        ], names=["conv_id", "task", "place", "role", "n_lines", "text", "edge"])

    found = checkpointed(ordered.mapInArrow(
        work, f"conv_id {id_type}, task int, place bigint, role string, n_lines bigint, text string, edge boolean"
    ))
    inner = found.filter("not edge").select("conv_id", F.col("place").alias("turn_no"), "role", "n_lines", "text")
    # turns of transcripts that span tasks: number them on and join the pieces of one turn
    spans = found.filter("edge")
    sizes = spans.groupBy("conv_id", "task").agg(F.count_if(F.col("place") >= 0).alias("n")).collect()
    offsets, sums = [], {}
    for row in sorted(sizes, key=lambda row: row.task):  # two rows a task at most
        offsets.append((row.conv_id, row.task, sums.get(row.conv_id, 0)))
        sums[row.conv_id] = sums.get(row.conv_id, 0) + row.n
    shifts = lines.sparkSession.createDataFrame(offsets, f"of_conv {id_type}, of_task int, shift bigint")
    same = F.col("conv_id").eqNullSafe(F.col("of_conv")) & (F.col("task") == F.col("of_task"))
    pieces = spans.join(F.broadcast(shifts), same).withColumn("turn_no", F.col("place") + F.col("shift"))
    joined = pieces.groupBy("conv_id", "turn_no").agg(
        F.min_by("role", "task").alias("role"), F.sum("n_lines").alias("n_lines"),
        F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct("task", "text"))), lambda piece: piece["text"]
        ), "\n").alias("text"),
    )
    return inner.unionByName(joined).withColumn("text", F.regexp_replace("text", r"\s+$", ""))


def rendered(turns: DataFrame) -> DataFrame:
    """Adds ``rendered``, the turn in canonical form, to rows as ``parse`` returns them."""
    return turns.withColumn(
        "rendered", F.concat(F.lit("<|"), "role", F.lit("|>\n"), "text", F.lit("\n<|end|>\n"))
    )


def transcripts(conversations: DataFrame) -> DataFrame:
    """Raw transcript lines of known conversations: conv_id, turn, part, line_no, role, line.

    Each conversation uses one marker style; a blank line ends each turn, and one later turn in
    ten has no marker, both chosen by hash.  A null text is empty, a null role has no marker.
    """
    source = pick(conversations, "conv_id", "turn", "role", "text")
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(MARKERS["user"])))
    marker = F.lit(None).cast("string")
    for role in ROLES:
        marker = F.when(F.col("role") == role, F.get(F.array(*map(F.lit, MARKERS[role])), style)).otherwise(marker)
    shown = (F.col("turn") == 0) | (F.pmod(F.xxhash64("conv_id", "turn"), F.lit(10)) > 0)
    opening = F.when(shown & marker.isNotNull(), F.concat(marker, F.lit(" "))).otherwise("")
    text = F.concat(opening, F.coalesce("text", F.lit("")), F.lit("\n"))
    return source.select(
        "conv_id", "turn", F.col("turn").alias("part"), "role", F.posexplode(F.split(text, "\n")).alias("line_no", "line")
    )
