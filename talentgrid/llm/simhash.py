"""SimHash near-duplicates: fingerprints, an exact Hamming join, and groups of linked documents.

The join follows the generalised pigeonhole principle.  The 64 bits are dealt into parts; if part
i has threshold t[i] and the sum of t[i] + 1 is the distance limit plus 1, then two fingerprints
within the limit are within t[i] in some part i, whatever the data.  (A threshold of -1 leaves
a part out.)  Correlated bits go into one part, so that a skewed part may get a low threshold.
Parts and thresholds are chosen by dynamic programming on the cost estimated from a bounded
sample; the estimate decides about cost only, every choice finds all links.

To find pairs within t in a part, each fingerprint is filed under its bits there and under each
value that has up to t of its zero bits set.  Two values within t meet at their union, and the
bits that both set number t at most.  Rows of one value are compared in blocks, and of the links
found only a spanning forest is kept, so a group of many near copies yields as many rows
as it has members.  A value that holds more than BLOCK_ROWS rows is cut into blocks that meet pair by
pair, so the work of one comparison doesn't grow with the data.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from talentgrid.llm.components import components
from talentgrid.llm.frames import HEAVY_SHARE, checkpointed, join_unique, numbered, pick

BITS = 64
#: Fingerprints on which costs are estimated.
SAMPLE = 2048
#: Cost of filing a row and of comparing a pair, in microseconds.
FILE_COST, PAIR_COST = 1.0, 0.02
#: Highest threshold of a part, and parts, that are considered (more where a limit needs them).
MOST_IN_PART, MOST_PARTS = 2, 8
#: Rows of one value that are compared as one block; more are cut into blocks that meet pair by pair.
BLOCK_ROWS = 4096
#: Rows compared at once.
AT_ONCE = 1 << 17


def fingerprint_of(raw: bytes | None, words: int = 4) -> int:
    """Signed 64-bit SimHash of a text's UTF-8 bytes.

    A-Z lower-cased; words part at ASCII white space; shingles of ``words`` words, repeats
    included, or all words if fewer; a bit is 1 if set in over half the shingles' XXH64 (seed
    42).  A null text and one without words have fingerprint 0.
    """
    tokens = (raw or b"").lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum([len(token) + 1 for token in tokens]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    last = ends[min(words, len(tokens)) - 1:].tolist()
    hash64 = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(last), 1 << 15):
        hashes = np.array(
            [hash64(joined[i:j], 42) for i, j in zip(starts[at:at + (1 << 15)], last[at:at + (1 << 15)])], "<u8"
        )
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(last), bitorder="little")
    return int(bits.view("<i8")[0])


@F.arrow_udf(LongType())
def fingerprint(raw: pa.Array) -> pa.Array:
    """The fingerprint of a binary column of UTF-8 texts."""
    return pa.array([fingerprint_of(text.as_py()) for text in raw], pa.int64())


def grouped_bits(sample: np.ndarray, parts: int) -> list[list[int]]:
    """The bits dealt into parts of almost equal size, correlated ones together."""
    bits = np.unpackbits(sample.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(float)
    bits -= bits.mean(0)
    scale = np.sqrt((bits * bits).sum(0))
    scale[scale == 0] = 1
    related = np.abs((bits / scale).T @ (bits / scale))
    left, out = set(range(BITS)), []
    for part in range(parts):
        size = len(left) // (parts - part)
        order = sorted(left)
        inner = related[np.ix_(order, order)] - np.eye(len(order))
        chosen = [order[int(inner.max(1).argmax())]]
        while len(chosen) < size:
            rest = sorted(left - set(chosen))
            chosen.append(rest[int(related[np.ix_(rest, chosen)].sum(1).argmax())])
        left -= set(chosen)
        out.append(sorted(chosen))
    return out


def mask_of(bits: list[int]) -> int:
    return sum(1 << bit for bit in bits)


def allotted(sample: np.ndarray, n: int, limit: int) -> tuple[list[int], list[int]]:
    """Masks and thresholds of the parts in use that cost least for ``n`` fingerprints."""
    if not len(sample):
        return [mask_of(list(range(BITS)))], [0]
    best = (float("inf"), [], [])
    limit = min(limit, BITS)  # no two differ in more
    needed = -(-(limit + 1) // (MOST_IN_PART + 1))
    left, right = np.triu_indices(len(sample), 1)
    apart = sample[left] ^ sample[right]
    for parts in range(1, max(min(limit + 1, MOST_PARTS), needed) + 1):
        groups = grouped_bits(sample, parts)
        costs = []
        for bits in groups:
            mask, width = np.uint64(mask_of(bits)), len(bits)
            near = np.bincount(np.bitwise_count(apart & mask), minlength=width + 1).cumsum()
            zeros = width - np.bitwise_count(sample & mask).mean()
            row = [0.0]
            for t in range(MOST_IN_PART + 1):
                filed = sum(float(np.prod([(zeros - k) / (k + 1) for k in range(x)])) for x in range(t + 1))
                even = sum(comb(width, x) for x in range(t + 1)) / 2 ** width
                share = max(even, near[min(t, width)] / max(1, len(apart)))
                row.append(FILE_COST * n * filed + PAIR_COST * n * n / 2 * share)
            costs.append(row)
        # least cost of the first parts that share out so many units; a part takes t + 1 of them
        table = {0: (0.0, [])}
        for row in costs:
            new: dict[int, tuple[float, list[int]]] = {}
            for used, (cost, taken) in table.items():
                for units in range(min(MOST_IN_PART + 1, limit + 1 - used) + 1):
                    option = (cost + row[units], [*taken, units - 1])
                    if used + units not in new or option[0] < new[used + units][0]:
                        new[used + units] = option
            table = new
        if limit + 1 in table and table[limit + 1][0] < best[0]:
            cost, thresholds = table[limit + 1]
            used = [(mask_of(bits), t) for bits, t in zip(groups, thresholds) if t >= 0]
            best = (cost, [mask for mask, _ in used], [t for _, t in used])
    return best[1], best[2]


def filed(prints: DataFrame, masks: list[int], thresholds: list[int]) -> DataFrame:
    """(part, value, level, fp): the values each fingerprint is filed under, and bits set for it."""
    def work(batches):
        for batch in batches:
            every = np.asarray(batch.column(0)).view(np.uint64)
            for at in range(0, len(every), 4096):
                fp = every[at:at + 4096]
                for part, (mask, most) in enumerate(zip(masks, thresholds)):
                    bits = [np.uint64(1 << bit) for bit in range(BITS) if mask >> bit & 1]
                    for level in range(most + 1):
                        for some in combinations(bits, level):
                            add = np.uint64(sum(int(bit) for bit in some))
                            rows = fp[(fp & add) == 0] if level else fp
                            value = (rows & np.uint64(mask)) | add
                            size = len(rows)
                            yield pa.RecordBatch.from_arrays([
                                pa.array(np.full(size, part, np.int32)), pa.array(value.view(np.int64)),
                                pa.array(np.full(size, level, np.int32)), pa.array(rows.view(np.int64)),
                            ], names=["part", "value", "level", "fp"])

    return prints.select("fp").mapInArrow(work, "part int, value bigint, level int, fp bigint")


def _forest(rows: dict[str, np.ndarray], thresholds: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links among rows of equal keys, which stand together."""
    fps, node = np.unique(rows["fp"], return_inverse=True)
    root = np.arange(len(fps))
    same = np.ones(len(node), bool)
    same[1:] = False
    for name in ("part", "value", "one", "two"):
        same[1:] |= rows[name][1:] != rows[name][:-1]
    first = np.flatnonzero(same)
    stop = np.repeat(np.append(first[1:], len(node)), np.diff(np.append(first, len(node))))
    at, step = np.arange(len(node)), 1

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    while len(at := at[at + step < stop[at]]):
        to = at + step
        near = np.bitwise_count(rows["fp"][at].view(np.uint64) ^ rows["fp"][to].view(np.uint64)) <= limit
        near &= rows["level"][at] + rows["level"][to] <= thresholds[rows["part"][at]]
        near &= (rows["one"][at] == rows["two"][at]) | (rows["block"][at] != rows["block"][to])
        a, b = node[at[near]], node[to[near]]
        joined = root[a] != root[b]
        for x, y in zip(a[joined].tolist(), b[joined].tolist()):
            x, y = find(x), find(y)
            if x != y:
                root[max(x, y)] = min(x, y)
        if joined.any():
            while (root != root[root]).any():
                root = root[root]
        step += 1
    linked = root != np.arange(len(fps))
    return fps[linked], fps[root[linked]]


def links(prints: DataFrame, limit: int) -> DataFrame:
    """(a, b): edges that connect all fingerprints within ``limit`` bits, directly or by others.

    ``prints`` has one row for each distinct fingerprint (fp); pass a checkpointed table.
    """
    n = prints.count()
    some = prints.orderBy(F.xxhash64("fp")).limit(SAMPLE).collect()
    masks, thresholds = allotted(np.array([row.fp for row in some], "<i8").view(np.uint64), n, limit)
    rows = filed(prints, masks, thresholds)
    counts = rows.groupBy("part", "value").agg(F.count(F.lit(1)).alias("n"))
    total = rows.agg(F.count(F.lit(1)).alias("n")).first().n
    large = counts.filter(F.col("n") > BLOCK_ROWS).select(
        "part", "value", "n", F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("blocks")
    )
    # at most HEAVY_SHARE values hold more than this share of the rows; the others fit a task
    heavy = large.filter(F.col("n") * HEAVY_SHARE > total).select("part", "value", "blocks")
    pairs = rows.join(F.broadcast(heavy), ["part", "value"], "left")
    if total > BLOCK_ROWS * HEAVY_SHARE:  # else every large value is heavy
        light = large.filter(F.col("n") * HEAVY_SHARE <= total).select("part", "value", F.col("blocks").alias("more"))
        # rows that have their blocks already go to a part that doesn't exist, spread by fingerprint
        done = F.col("blocks").isNotNull()
        keyed = pairs.withColumns({
            "in_part": F.when(done, -1).otherwise(F.col("part")), "in_value": F.when(done, F.col("fp")).otherwise(F.col("value"))
        })
        light = light.withColumnsRenamed({"part": "in_part", "value": "in_value"})
        pairs = keyed.join(light, ["in_part", "in_value"], "left").withColumn("blocks", F.coalesce("blocks", "more"))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    pairs = pairs.withColumn("block", F.coalesce(own, F.lit(0)))
    pairs = pairs.withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("blocks"), F.lit(1)) - 1)))
    pairs = pairs.select(
        "part", "value", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"),
        "block", "level", "fp",
    )
    keys = ["part", "value", "one", "two"]
    names = [*keys, "block", "level", "fp"]
    limits = np.array(thresholds or [0])

    def work(batches):
        held: list[dict[str, np.ndarray]] = []

        def found(rows):
            a, b = _forest(rows, limits, limit)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            held.append({name: np.asarray(column) for name, column in zip(names, batch.columns)})
            if sum(len(x["fp"]) for x in held) < AT_ONCE:
                continue
            rows = {name: np.concatenate([x[name] for x in held]) for name in names}
            whole = np.ones(len(rows["fp"]), bool)  # rows whose key isn't the last one
            for name in keys:
                whole &= rows[name] == rows[name][-1]
            cut = int(np.argmax(whole))
            held = [{name: column[cut:] for name, column in rows.items()}]
            if cut:
                yield found({name: column[:cut] for name, column in rows.items()})
        if held and len(held[0]["fp"]):
            yield found({name: np.concatenate([x[name] for x in held]) for name in names})

    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pairs.repartition(parts, *keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(work, "a bigint, b bigint")


def grouped(prints: DataFrame, limit: int) -> DataFrame:
    """(fp, component_id, root) for rows (doc_id, fp): one row for each distinct fingerprint.

    component_id is the smallest doc_id reachable over links, null if all are null; root is the
    smallest fingerprint there, which names the component.  Pass a checkpointed table.
    """
    distinct = checkpointed(prints.groupBy("fp").agg(F.min("doc_id").alias("doc_id")))
    roots = components(links(distinct, limit)).withColumnRenamed("node", "fp")
    linked = checkpointed(distinct.join(roots, "fp"))
    least = linked.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = join_unique(linked, least, "root").select("fp", "component_id", "root")
    alone = distinct.join(linked, "fp", "left_anti").select("fp", F.col("doc_id").alias("component_id"), F.col("fp").alias("root"))
    return checkpointed(named.union(alone))


def near_duplicates(docs: DataFrame, limit: int = 4) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document; fingerprint as 16 hex digits.

    Documents whose fingerprints differ in ``limit`` bits or fewer are linked; component_id is
    the smallest doc_id reachable.  Null and empty texts have fingerprint 0 and are linked like
    others; a null doc_id stays null and never names a group that has an id; repeated rows stay;
    other columns are not read.
    """
    prints = checkpointed(
        pick(docs, "doc_id", "text").select("doc_id", fingerprint(F.col("text").cast("binary")).alias("fp"))
    )
    return join_unique(prints, grouped(prints, limit), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, limit: int = 4) -> DataFrame:
    """The rows, all columns as they are, of one document of each group: the smallest doc_id.

    Of rows that repeat this id one stays; a row without id stays only if its group has no id.
    """
    plain, names = numbered(docs)
    print_of = fingerprint(F.col(names["text"]).cast("binary"))
    prints = checkpointed(plain.select(F.col(names["doc_id"]).alias("doc_id"), print_of.alias("fp")))
    groups = grouped(prints, limit)
    kept = join_unique(prints, groups, "fp").filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    counts = kept.groupBy("doc_id", "root").agg(F.count(F.lit(1)).alias("times"), F.min("fp").alias("fp"))
    chosen = checkpointed(counts)
    rows = plain.withColumn("fp", print_of)
    same = rows[names["doc_id"]].eqNullSafe(chosen["doc_id"]) & (rows["fp"] == chosen["fp"])
    found = rows.join(chosen, same).select(*plain.columns, "times", "root")
    once = found.filter("times = 1").select(*plain.columns)
    again = found.filter("times > 1").dropDuplicates([names["doc_id"], "root"]).select(*plain.columns)
    return once.union(again).toDF(*docs.columns)
