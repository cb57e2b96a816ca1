"""Periodic runs of words, by suffix-tree LCE.

A run is a stretch of words with smallest period q that no neighbouring word extends; those of at
least LEAST_WORDS words and LEAST_PERIODS periods are found.

* Ukkonen's algorithm builds the suffix trees of the words and of their reversal.  The Euler tour
  of a tree holds the string depth at each visit; the least depth between two leaves is that of
  their lowest common ancestor, the length of the suffixes' common beginning.  Blocks with
  minima from both ends and a sparse table over the blocks answer in constant time and linear space.
* Each run has a root that is the longest Lyndon word at its place in one of the two orders of the
  words (ascending or descending): it ends where the next smaller suffix begins.  Suffix ranks are
  the order of the leaves.  So both orders give one candidate a place, the common beginning of the
  suffixes at both ends of the root extends it to the right, that in the reversal to the left.

A word of a run of four periods occurs in it four times.  Words that occur less often therefore
part a text into stretches that no run leaves, and trees are built for the stretches that remain;
nothing is lost by that.  Memory is that of the longest such stretch, some 700 bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talentgrid.llm.byte_bpe import slices
from talentgrid.llm.frames import numbered, pick

#: A run that counts has at least so many words, and so many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Rounds of parting; what is left may hold rare words, which costs time only.
ROUNDS = 8
#: Visits of an Euler tour that share a block.
BLOCK = 16
#: A word ends at these; the class is that of the contract's ``[^\x20\x09-\x0D]+``.
WORD = r"[^\x20\x09-\x0D]+"


class Minima:
    """Least value of a range of an array, in constant time: blocks and a sparse table over them."""

    def __init__(self, values: np.ndarray):
        blocks = -(-len(values) // BLOCK)
        self.values = np.full((blocks + 1) * BLOCK, np.iinfo(np.int32).max, np.int32)
        self.values[:len(values)] = values
        rows = self.values[:blocks * BLOCK].reshape(blocks, BLOCK)
        self.to_here = np.minimum.accumulate(rows, 1).ravel()
        self.from_here = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()
        self.levels = [rows.min(1)]
        while 2 << (len(self.levels) - 1) <= blocks:
            below, step = self.levels[-1], 1 << (len(self.levels) - 1)
            level = below.copy()
            np.minimum(below[:-step], below[step:], out=level[:-step])
            self.levels.append(level)
        self.levels = np.array(self.levels)

    def between(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Least values from ``low`` to ``high``, both included."""
        first, last = low // BLOCK, high // BLOCK
        least = np.minimum(self.from_here[low], self.to_here[high])
        inner = np.flatnonzero(last - first > 1)
        if len(inner):
            a, b = first[inner] + 1, last[inner]
            level = np.frexp((b - a).astype(float))[1] - 1  # exact binary logarithm, rounded down
            found = np.minimum(self.levels[level, a], self.levels[level, b - (1 << level)])
            least[inner] = np.minimum(least[inner], found)
        same = np.flatnonzero(first == last)
        if len(same):
            at = low[same, None] + np.arange(BLOCK)
            window = np.where(at <= high[same, None], self.values[at], np.iinfo(np.int32).max)
            least[same] = window.min(1)
        return least


class SuffixTree:
    """The suffix tree of symbols 1 .. size - 1 and a last 0, by Ukkonen's algorithm."""

    def __init__(self, symbols: list[int], size: int):
        n = len(symbols)
        start, end, link, suffix, go = [0], [0], [0], [-1], {}
        node = edge = length = rest = 0
        for i, symbol in enumerate(symbols):
            rest += 1
            unlinked = 0
            while rest:
                if not length:
                    edge = i
                key = node * size + symbols[edge]
                child = go.get(key)
                if child is None:
                    go[key] = len(start)
                    start.append(i), end.append(n), link.append(0), suffix.append(i - rest + 1)
                    if unlinked:
                        link[unlinked] = node
                        unlinked = 0
                else:
                    begin = start[child]
                    span = (end[child] if end[child] <= i else i + 1) - begin
                    if length >= span:
                        edge, length, node = edge + span, length - span, child
                        continue
                    if symbols[begin + length] == symbol:
                        length += 1
                        if unlinked:
                            link[unlinked] = node
                        break
                    split = len(start)
                    start += [begin, i]
                    end += [begin + length, n]
                    link += [0, 0]
                    suffix += [-1, i - rest + 1]
                    go[key] = split
                    go[split * size + symbol] = split + 1
                    start[child] = begin + length
                    go[split * size + symbols[begin + length]] = child
                    if unlinked:
                        link[unlinked] = split
                    unlinked = split
                rest -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - rest + 1
        self.suffix = suffix
        self.lengths = [stop - begin for begin, stop in zip(start, end)]
        keys = np.fromiter(go, np.int64, len(go))
        self._parents, self._symbols = keys // size, keys % size
        self._children, self._size = np.fromiter(go.values(), np.int64, len(go)), size
        bounds = np.searchsorted(np.sort(self._parents), np.arange(len(start) + 1))
        self._bounds = bounds.tolist()

    def _ordered(self, order: np.ndarray) -> list[int]:
        """Children, by parent and then by the order of their edges' first symbols."""
        return self._children[np.lexsort((order, self._parents))].tolist()

    def ranks(self, descending: bool = False) -> list[int]:
        """Rank of each suffix; the last symbol is the least in either order of the others."""
        order = -self._symbols % self._size if descending else self._symbols
        children, bounds, suffix = self._ordered(-order), self._bounds, self.suffix
        ranks, todo, rank = [0] * (len(suffix) - suffix.count(-1)), [0], 0
        while todo:
            node = todo.pop()
            if suffix[node] >= 0:
                ranks[suffix[node]] = rank
                rank += 1
            else:
                todo += children[bounds[node]:bounds[node + 1]]
        return ranks

    def tour(self) -> None:
        """Walk the Euler tour, for ``common``."""
        children, bounds, suffix, lengths = self._ordered(self._symbols), self._bounds, self.suffix, self.lengths
        depth, up, following = [0] * len(suffix), [0] * len(suffix), bounds[:-1]
        visits, first, node = [0], [0] * (len(suffix) - suffix.count(-1)), 0
        while True:
            at = following[node]
            if at < bounds[node + 1]:
                following[node] = at + 1
                child, here = children[at], depth[node]
                if suffix[child] >= 0:
                    first[suffix[child]] = len(visits)
                    visits += (here + lengths[child], here)
                else:
                    up[child], depth[child] = node, here + lengths[child]
                    visits.append(depth[child])
                    node = child
            elif node:
                node = up[node]
                visits.append(depth[node])
            else:
                break
        self._first, self._depths = np.array(first), Minima(np.array(visits, np.int32))

    def common(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Length of the common beginning of suffixes; the two are different ones."""
        a, b = self._first[left], self._first[right]
        return self._depths.between(np.minimum(a, b), np.maximum(a, b))


def next_smaller(ranks: list[int]) -> list[int]:
    """The place of the next smaller suffix after each one but the last, which is the least."""
    found, waiting = [0] * (len(ranks) - 1), []
    for place, rank in enumerate(ranks):
        while waiting and ranks[waiting[-1]] > rank:
            found[waiting.pop()] = place
        waiting.append(place)
    return found


def runs_of_stretch(symbols: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs that count among symbols from 1 on, in no order."""
    n, size = len(symbols), int(symbols.max()) + 1
    tree = SuffixTree([*symbols.tolist(), 0], size)
    places = np.arange(n)
    candidates = set()
    for descending in (False, True):
        period = np.array(next_smaller(tree.ranks(descending))) - places
        candidates.update((period * n + places).tolist())  # (period, place) as one number
    periods, at = np.divmod(np.fromiter(candidates, np.int64, len(candidates)), n)
    fits = LEAST_PERIODS * periods <= n
    periods, at = periods[fits], at[fits]
    tree.tour()
    right = tree.common(at, at + periods)
    repeats = right > 0  # of four periods of a run, all but the last begin a root that repeats
    periods, at, right = periods[repeats], at[repeats], right[repeats]
    if not len(at):
        return []
    back = SuffixTree([*symbols[::-1].tolist(), 0], size)
    back.tour()
    left = back.common(n - at, n - at - periods)
    lengths = left + periods + right
    long = lengths >= np.maximum(LEAST_WORDS, LEAST_PERIODS * periods)
    return list(set(zip((at - left)[long].tolist(), lengths[long].tolist(), periods[long].tolist())))


def stretches(words: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    """Place and symbols (from 1) of the stretches that may hold a run."""
    known: dict[bytes, int] = {}
    symbols = np.array([known.setdefault(word, len(known)) for word in words], np.int64)
    todo = [(0, symbols, 0)]
    while todo:
        place, symbols, parted = todo.pop()
        if len(symbols) < LEAST_WORDS:
            continue
        if parted:
            _, symbols = np.unique(symbols, return_inverse=True)
        counts = np.bincount(symbols)
        if counts.min() >= LEAST_PERIODS or parted == ROUNDS:
            yield place, symbols + 1
            continue
        often = np.zeros(len(symbols) + 2, np.int8)
        often[1:-1] = counts[symbols] >= LEAST_PERIODS
        starts, = np.nonzero(np.diff(often) == 1)
        ends, = np.nonzero(np.diff(often) == -1)
        for k in np.flatnonzero(ends - starts >= LEAST_WORDS):
            todo.append((place + int(starts[k]), symbols[starts[k]:ends[k]], parted + 1))


def runs_of_words(words: list[bytes]) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs that count, by start, then period."""
    if len(words) < LEAST_WORDS:
        return []
    found = [
        (place + start, length, period)
        for place, symbols in stretches(words) for start, length, period in runs_of_stretch(symbols)
    ]
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run contains after its first period."""
    if not runs:
        return words
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period:start + length] = False
    return [words[place] for place in np.flatnonzero(kept).tolist()]


RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): one row for each row, from its whole text.

    ``runs`` holds a struct (start, length, period) for each run, in words from 0, by start, then
    period; ``collapsed`` is the text with each run cut to its first period, words joined by one
    space.  A null, empty or blank text has no words, no runs and an empty ``collapsed``.  Repeated
    rows stay, a null doc_id stays null, other columns are not read.
    """
    def work(batches):
        for batch in slices(batches):
            counts, runs, texts = [], [], []
            for text in batch.column(1).cast(pa.binary()):
                words = (text.as_py() or b"").split()  # at the six characters no word holds
                found = runs_of_words(words)
                counts.append(len(words))
                runs.append(found)
                texts.append(b" ".join(collapsed(words, found)))
            flat = np.array([run for found in runs for run in found], np.int64).reshape(-1, 3)
            parts = pa.StructArray.from_arrays([pa.array(column) for column in flat.T], fields=list(RUNS.value_type))
            offsets = pa.array(np.cumsum([0, *map(len, runs)]), pa.int32())
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(counts, pa.int64()), pa.ListArray.from_arrays(offsets, parts),
                pa.array(texts, pa.binary()).cast(pa.string()),
            ], names=["doc_id", "n_words", "runs", "collapsed"])

    source = pick(docs, "doc_id", "text")
    kind = source.schema["doc_id"].dataType.simpleString()
    runs = "array<struct<start: bigint, length: bigint, period: bigint>>"
    return source.mapInArrow(work, f"doc_id {kind}, n_words bigint, runs {runs}, collapsed string")


def planted(docs: DataFrame) -> DataFrame:
    """The documents, one in ten of them with a periodic end, all columns as they are.

    With h the CRC-32 of the id as text and g = floor(h / 10), a text of n > 0 words with h % 10 = 0
    gets the words w[a + (i - a) % p] for i >= a, where a = g % n and p = 1 + floor((n - a) / (3 + g % 8));
    its words are then joined by one space.  Other texts, and rows without an id, stay.
    """
    plain, names = numbered(docs)
    h = F.crc32(F.col(names["doc_id"]).cast("string").cast("binary"))
    g, text = F.floor(h / 10), F.col(names["text"])

    def periodic(words: Column) -> Column:
        n = F.size(words).cast("bigint")
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
        end = F.transform(F.sequence(F.lit(0).cast("bigint"), n - a - 1), lambda i: F.get(words, (a + F.pmod(i, p)).cast("int")))
        return F.array_join(F.concat(F.slice(words, F.lit(1), a.cast("int")), end), " ")

    # one binding of the words, so that a text is split once
    made = F.get(F.transform(F.array(F.regexp_extract_all(text, F.lit(f"({WORD})"))), periodic), F.lit(0))
    chosen = (F.pmod(h, F.lit(10)) == 0) & text.rlike(WORD)
    return plain.withColumn(names["text"], F.when(chosen, made).otherwise(text)).toDF(*docs.columns)


def digests(found: DataFrame) -> DataFrame:
    """The longest run of each document (ties: least start, then period) and digests of all."""
    order = F.transform("runs", lambda r: F.struct(-r["length"], r["start"].alias("start"), r["period"].alias("period")))
    longest = F.array_min(order)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    length, period = -longest["col1"], longest["period"]
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), longest["start"].alias("start"),
        length.alias("length"), period.alias("period"),
        ((1000 * length - 1000 * length % period) / period).cast("bigint").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
