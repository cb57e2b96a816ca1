"""Document fingerprints by content-defined chunking.

A gear hash runs over the UTF-8 bytes of a text: each byte shifts it left by one bit and adds the
byte's random number, so 32 bits of it depend on the last 32 bytes alone and all its values come
from five array additions.  A chunk may end after a place whose hash has certain bits zero:
before NORMAL bytes more bits than after it (normalised chunking, which evens out lengths),
never before LEAST and at the latest at MOST bytes.  Ends lie between characters.  As ends depend
on nearby bytes, an edit changes the chunks around it and later ones fall into step again.

A fingerprint is the set of chunk digests, each with its chunk's length.  Containment of one text
in another is the length of its chunks that the other has, over the length of all its chunks.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talentgrid.llm.byte_bpe import slices
from talentgrid.llm.frames import pick

LEAST, NORMAL, MOST = 16, 48, 192
#: Top bits that are zero where a chunk may end, before and after NORMAL bytes.
STRICT, LOOSE = 6, 4
#: Bytes hashed at once.
AT_ONCE = 1 << 20
#: Random numbers of the bytes, the same in every run.
GEAR = np.frombuffer(hashlib.shake_128(b"gear").digest(1024), "<u4")


def ends(raw: bytes) -> list[int]:
    """Ends of the chunks of a text's UTF-8 bytes, ascending; the last is its length."""
    loose, strict = [], []
    for at in range(0, len(raw), AT_ONCE):
        first = max(0, at - 31)  # the bytes that the first hashes also depend on
        data = np.frombuffer(raw, np.uint8, min(len(raw), at + AT_ONCE + 1) - first, first)
        gear = GEAR[data]
        for step in (1, 2, 4, 8, 16):
            gear[step:] += gear[:-step] << np.uint32(step)
        place = np.flatnonzero(gear < np.uint32(1 << (32 - LOOSE)))
        place = place[(place >= at - first) & (place < at - first + AT_ONCE)]
        inside = place + 1 < len(data)  # the next byte must begin a character
        place = place[inside][(data[place[inside] + 1] & 0xC0) != 0x80]
        loose.append(place + (first + 1))
        strict.append(place[gear[place] < np.uint32(1 << (32 - STRICT))] + (first + 1))
    loose, strict = (np.concatenate(x).tolist() if x else [] for x in (loose, strict))
    found, start, size = [], 0, len(raw)
    in_strict = in_loose = 0
    while size - start > LEAST:
        in_strict = bisect_left(strict, start + LEAST, in_strict)
        end = strict[in_strict] if in_strict < len(strict) else size
        if end >= start + NORMAL:
            in_loose = bisect_left(loose, start + NORMAL, in_loose)
            end = loose[in_loose] if in_loose < len(loose) else size
        if end > start + MOST:
            end = start + MOST
            while raw[end] & 0xC0 == 0x80:
                end -= 1
        found.append(end)
        start = end
    if start < size:
        found.append(size)
    return found


def chunks(raw: bytes) -> dict[str, int]:
    """Digest (12 hex digits) and length of each distinct chunk."""
    found, start = {}, 0
    for end in ends(raw):
        found[xxhash.xxh3_64_hexdigest(raw[start:end])[:12]] = end - start
        start = end
    return found


def containment(part: dict[str, int], whole: dict[str, int]) -> float:
    """Share of ``part`` by length that ``whole`` has; of an empty part, 1 if both are empty."""
    if not part:
        return float(not whole)
    return sum(part[digest] for digest in part.keys() & whole.keys()) / sum(part.values())


def written(found: dict[str, int]) -> str:
    """The fingerprint as text: digest:length of each distinct chunk, in ascending order."""
    return ",".join(f"{digest}:{length}" for digest, length in sorted(found.items()))


def read(fingerprint: str) -> dict[str, int]:
    pairs = (item.split(":") for item in fingerprint.split(",") if item)
    return {digest: int(length) for digest, length in pairs}


def edited(text: str, other: str) -> str:
    """The text with its last half, rounded down, replaced by as much of the other's beginning."""
    half = len(text) // 2
    return text[:len(text) - half] + other[:half]


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, n_chunks, fingerprint) of every whole text.

    A null text counts as empty and has an empty fingerprint; equal texts have equal ones.
    Repeated rows stay; other columns are not read.
    """
    def work(batches):
        for batch in slices(batches):
            texts = [text.as_py() or "" for text in batch.column(1)]
            found = [chunks(text.encode()) for text in texts]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(map(len, texts), pa.int64()), pa.array(map(len, found), pa.int64()),
                pa.array(map(written, found), pa.string()),
            ], names=["doc_id", "n_chars", "n_chunks", "fingerprint"])

    source = pick(docs, "doc_id", "text")
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(work, f"doc_id {kind}, n_chars bigint, n_chunks bigint, fingerprint string")


#: Bytes of texts, about, that one task compares; fewer where there are more shuffle partitions.
STRETCH_BYTES = 1 << 27
#: Key of rows without an id: before all others.
NO_ID = -(1 << 63)


def _bounds(keyed: DataFrame, stretches: int) -> list[tuple[int, int]]:
    """Places (key, digest) that part rows (key, digest) into about ``stretches`` equal stretches, ascending.

    Where one key spans several stretches it is parted by digest, and a digest that spans several, copies
    of one text, is named as often.  All lists that come to the driver are bounded by ``stretches``.
    """
    shares = [i / stretches for i in range(1, stretches)]
    found = keyed.agg(F.percentile_approx("key", shares, 10 * stretches).alias("keys"), F.count(F.lit(1)).alias("n")).first()
    spans = Counter(found.keys or [])
    hot = [key for key, times in spans.items() if times > 1]
    bounds = [(key, NO_ID) for key, times in spans.items() if times == 1]
    for key in hot:  # digests are even but for copies
        bounds += [(key, NO_ID + (j << 64) // (spans[key] + 1)) for j in range(spans[key] + 1)]
    if hot:
        copies = keyed.filter(F.col("key").isin(hot)).groupBy("key", "digest").agg(F.count(F.lit(1)).alias("n"))
        for row in copies.filter(F.col("n") * stretches > found.n).collect():
            bounds += [(row.key, row.digest)] * -(-row.n * stretches // found.n)
    return sorted(bounds)


def placed(keys: np.ndarray, digests: np.ndarray, bounds: np.ndarray, turn: int) -> np.ndarray:
    """The stretch of each row: how many bounds lie at or below it.

    Copies of a text that several bounds name are dealt to the stretches these begin, from ``turn`` on.
    """
    low, high = (np.searchsorted(bounds[:, 0], keys, side) for side in ("left", "right"))
    below, times = low.copy(), np.zeros(len(keys), np.int64)
    for key in np.unique(keys[high > low]):
        rows = np.flatnonzero(keys == key)
        named = bounds[low[rows[0]]:high[rows[0]], 1]
        right = np.searchsorted(named, digests[rows], "right")
        below[rows] += right
        times[rows] = right - np.searchsorted(named, digests[rows], "left")
    return below - (turn + np.arange(len(keys))) % np.maximum(times, 1)


def neighbours(docs: DataFrame, stretches: int) -> DataFrame:
    """Texts dealt so that each meets the next one by doc_id (null ids first, ties by digest).

    The rows are cut into about ``stretches`` stretches of equal numbers, also within the rows of one id and
    within copies of one text.  Each goes to one task, with a guest: a first row of the next stretch
    that has rows, for the last one the first row of all.  Columns: stretch, guest, key, digest,
    doc_id, packed (the compressed text); rows of a stretch follow each other in order.  Only ends
    of stretches, a number that ``stretches`` bounds, come to the driver.
    """
    spark, text = docs.sparkSession, F.coalesce(F.col("text"), F.lit(""))
    source = pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("bigint")).select(
        F.coalesce(F.col("doc_id"), F.lit(NO_ID)).alias("key"), F.xxhash64(text).alias("digest"), "doc_id", text.alias("text")
    )
    found = _bounds(source.select("key", "digest"), stretches)
    bounds = np.array(found, np.int64).reshape(-1, 2)

    def stretches_of(batches):
        turn = 0
        for batch in batches:
            columns = [column.to_numpy() for column in batch.columns[:2]]
            stretch = pa.array(placed(*columns, bounds, turn), pa.int64())
            turn += batch.num_rows
            yield batch, stretch

    def narrow(batches):
        for batch, stretch in stretches_of(batches):
            yield pa.RecordBatch.from_arrays([stretch, *batch.columns], names=["stretch", "key", "digest"])

    def packed(column):
        codec = pa.Codec("zstd")
        raw = [text.as_py() for text in column.cast(pa.binary())]
        return pa.array([len(x).to_bytes(8, "little") + codec.compress(x, asbytes=True) for x in raw], pa.binary())

    def dealt(guests):
        def work(batches):
            if guests:
                rows = ((batch, batch.column(4)) for batch in slices(batches))
            else:
                rows = stretches_of(slices(batches))
            for batch, stretch in rows:
                guest = pa.array(np.full(batch.num_rows, int(guests), np.int32))
                yield pa.RecordBatch.from_arrays(
                    [stretch, guest, *batch.columns[:3], packed(batch.column(3))],
                    names=["stretch", "guest", "key", "digest", "doc_id", "packed"],
                )
        return work

    schema = "stretch bigint, guest int, key bigint, digest bigint, doc_id bigint, packed binary"
    least = source.select("key", "digest").mapInArrow(narrow, "stretch bigint, key bigint, digest bigint").groupBy("stretch")
    firsts = sorted(least.agg(F.min(F.struct("key", "digest")).alias("first")).collect())
    to = [(*first, s) for (_, first), (s, _) in zip(firsts, [firsts[-1], *firsts[:-1]])] if firsts else []
    wanted = F.broadcast(spark.createDataFrame(to, "key bigint, digest bigint, stretch bigint"))
    # one row for each place where a stretch begins, whatever number of copies it has
    single = source.join(F.broadcast(wanted.select("key", "digest").distinct()), ["key", "digest"]).groupBy("key", "digest").agg(
        F.min("doc_id").alias("doc_id"), F.min("text").alias("text")
    )
    guests = single.join(wanted, ["key", "digest"]).select("key", "digest", "doc_id", "text", "stretch")
    rows = source.mapInArrow(dealt(False), schema).union(guests.mapInArrow(dealt(True), schema))
    return rows.repartition(stretches, "stretch").sortWithinPartitions("stretch", "guest", "key", "digest")


def compared(docs: DataFrame, stretches: int | None = None) -> DataFrame:
    """Fingerprints of every document and of its edited text, with their likeness.

    The edited text and ``near_next`` take the next document by doc_id, after the last one the
    first.  Null ids come first, rows of one id by XXH64 of their texts (copies in any order); a table of one
    row is its own next document.  ``near_edited`` and ``near_next`` are the containment of the
    document's chunks in the other text's.  A null text counts as empty.
    """
    if not stretches:
        size = pick(docs, "doc_id", "text").agg(F.sum(F.octet_length("text"))).first()[0] or 0
        stretches = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // STRETCH_BYTES)

    def rows(batches):
        codec = pa.Codec("zstd")
        before = None  # (stretch, doc_id, text, bytes, chunks)
        for batch in batches:
            for stretch, guest, doc_id, packed in zip(*(column for column in batch.columns)):
                stretch, guest, doc_id = stretch.as_py(), guest.as_py(), doc_id.as_py()
                if guest and (before is None or before[0] != stretch or before[-1]):
                    continue  # a stretch without rows of its own
                data = packed.as_buffer()
                size = int.from_bytes(data[:8].to_pybytes(), "little")
                raw = codec.decompress(data[8:], size, asbytes=True) if size else b""
                text, found = raw.decode(), chunks(raw)
                if before is not None and before[0] == stretch:
                    _, old_id, old_text, old, _ = before
                    new_text = edited(old_text, text)
                    new_raw = new_text.encode()
                    new = chunks(new_raw)
                    yield (
                        old_id, len(old_text), hashlib.sha256(new_raw).hexdigest(), written(old),
                        written(new), containment(old, new), containment(old, found),
                    )
                before = (stretch, doc_id, text, found, guest)

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    text, long, real = pa.string(), pa.int64(), pa.float64()
    kinds = [long, long, text, text, text, real, real]

    def work(batches):
        held = []
        for row in rows(batches):
            held.append(row)
            if len(held) == 256:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*held), kinds)], names=names)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*held), kinds)], names=names)

    dealt = neighbours(docs, stretches).select("stretch", "guest", "doc_id", "packed")
    return dealt.mapInArrow(
        work, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )
