"""Cross-tokenizer alignment: which tokens of two tokenizers cover common bytes of a text.

Each text is tokenised in full by both.  A whitespace-token anchor is a byte offset where a token
of both ends and a token that begins with a space follows in both.  Anchors split a document into
windows of token ids; the alignment of a window depends on its two tuples of ids only, so a
worker remembers it.  Offsets come from the lengths of the tokens' bytes and are used only after
the joined bytes of both have been compared with the text.

Corpus-wide counts of id pairs go through blocks: a task gathers documents up to BLOCK_CHARS characters
(a longer document is a block of its own) and writes one row a block with its distinct pairs, how many
of its documents hold each, and each document's pairs as indices into them.  The windows of a
block are made distinct and those not remembered are aligned together, by array operations.  Only distinct pairs of
blocks are shuffled, to be counted and to fetch the counts.  A pair occurs once a block, so no key
holds more rows than there are blocks, whatever pair is common.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from talentgrid.llm.byte_bpe import byte_letters, slices
from talentgrid.llm.frames import new_folder, pick

#: Characters of a block, at most, unless one text is longer.
BLOCK_CHARS = 1 << 20
#: Windows that a worker remembers (emptied when a block's new ones would exceed it), and the tokens of one, at most.
REMEMBERED, REMEMBERED_TOKENS = 400_000, 64
#: Tokens of either side of a window whose ids make up one number.
NARROW = 4
#: Fixed value: the public pattern of pieces of a byte-level tokenizer.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: White space of this length is left to the slower encoder: the other's pattern search has a bounded stack.
LONG_GAP = 20_000
GAP = re.compile(rf"\s{{{LONG_GAP}}}")
#: How the second tokenizer marks spaces, and its single bytes.
SPACE, BYTE = "▁", re.compile(r"<0x([0-9A-F]{2})>")


def ranked(path: str):
    """A byte-level BPE file as tiktoken's encoder, several times as fast; None if it might differ.

    Merges by rank of the token they make give the ids of merges by rank of the pair where tokens
    are numbered in the order of their merges, as training numbers them, and the pieces are those of the public
    pattern.  Tests compare both on every character and on random strings.
    """
    import tiktoken

    with open(path, encoding="utf-8") as lines:
        file = json.load(lines)
    model, before = file["model"], file.get("pre_tokenizer") or {}
    plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    if file.get("normalizer") or model.get("type") != "BPE" or any(before.get(key) != value for key, value in plain.items()):
        return None
    if any(model.get(key) for key in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
        return None
    letters, ids = byte_letters(), model["vocab"]
    pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"]]
    made = [ids.get("".join(pair), -1) for pair in pairs]
    first = [ids.get(letter, len(ids)) for letter in letters]
    ascending = all(low < high for low, high in zip([max(first), *made], made))
    if not ascending or len(ids) != len(first) + len(made):
        return None
    ranks = {bytes(letters[c] for c in token): number for token, number in ids.items()}
    return tiktoken.Encoding("ranked", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class Vocabulary:
    """Bytes of the tokens of one tokenizer, and their ids as they are written inside and at the end of a group."""

    def __init__(self, tokens: list[bytes], end: str):
        self.tokens = tokens
        self.lengths = np.array([len(token) for token in tokens], np.int64)
        self.spaced = np.array([token.startswith(b" ") for token in tokens])
        self.written = [f"{i}{mark}" for i in range(len(tokens)) for mark in (",", end)]

    def spells(self, ids: list[int], text: bytes) -> bool:
        return b"".join(map(self.tokens.__getitem__, ids)) == text


@dataclass
class Block:
    """The alignment of some texts: numbers of tokens, groups as text, and links.

    ``pairs`` are the distinct linked ids (A id << 32 | B id), ascending; the links of all texts follow each
    other as places among them, ``n_links`` of each text.
    """

    n_a: list[int]
    n_b: list[int]
    groups: list[str]
    n_links: np.ndarray
    pairs: np.ndarray
    links: np.ndarray


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of consecutive items at ``starts``, as many each as ``sizes`` says."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


def packed_ids(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The ids of windows of at most NARROW tokens as one number each, every id being below 2^16 - 1."""
    ids = np.append(ids, 0).astype(np.uint64) + np.uint64(1)
    keys = np.zeros(len(starts), np.uint64)
    for k in range(NARROW):
        held = sizes > k
        keys[held] |= ids[starts[held] + k] << np.uint64(16 * k)
    return keys


def merged(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of either and values of both, for two ascending arrays without repeats."""
    every = np.concatenate([left, right])
    every.sort(kind="stable")  # merges the two runs
    again = np.append(every[1:] == every[:-1], False)
    return every[~again], every[again]


class Aligner:
    """The tokenizers of a byte-level file (A) and a sentence-piece file (B), and their windows."""

    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks share the machine's cores
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a_encoder = Tokenizer.from_file(a_path)
        self.a_encoder.encode_special_tokens = True  # their strings in a text are plain text
        self.a_ranked = ranked(a_path)
        self.b_encoder = SentencePieceProcessor(model_file=b_path)
        letters = byte_letters()
        plain = [self.a_encoder.id_to_token(i) or "" for i in range(self.a_encoder.get_vocab_size())]
        self.a = Vocabulary([bytes(letters.get(c, 0) for c in token) for token in plain], "|")
        pieces = [self.b_encoder.id_to_piece(i) for i in range(self.b_encoder.get_piece_size())]
        self.b = Vocabulary([
            bytes([int(found[1], 16)]) if (found := BYTE.fullmatch(piece)) else piece.replace(SPACE, " ").encode()
            for piece in pieces
        ], ";")
        self.packs = max(len(plain), len(pieces)) < 0xFFFF
        # ids of a window -> its groups as text, each closed by ";", and its links
        self.windows: dict[tuple, tuple[str, bytes]] = {}

    def a_ids(self, text: str) -> list[int]:
        """Ids of a text by A."""
        if self.a_ranked and not (len(text) > LONG_GAP and GAP.search(text)):
            return self.a_ranked.encode_ordinary(text)
        return self.a_encoder.encode(text, add_special_tokens=False).ids

    def tokens(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of each text by both; none for a null or empty one and one that they don't both spell."""
        none = np.empty(0, np.int64)
        a_found, b_found = [none] * len(texts), [none] * len(texts)
        some = [k for k, text in enumerate(texts) if text]
        spaced = [" " + texts[k] for k in some]
        b_all = self.b_encoder.encode([texts[k] for k in some], num_threads=1)
        for k, text, a_ids, b_ids in zip(some, spaced, map(self.a_ids, spaced), b_all):
            raw = text.encode()
            if self.a.spells(a_ids, raw) and self.b.spells(b_ids, raw):
                a_found[k], b_found[k] = np.array(a_ids, np.int64), np.array(b_ids, np.int64)
        return a_found, b_found

    def align(self, a: np.ndarray, b: np.ndarray, a_sizes: np.ndarray, b_sizes: np.ndarray) -> list[tuple[str, bytes]]:
        """Groups and links of windows whose ids follow each other, ``a_sizes`` and ``b_sizes`` in each.

        A link is a stretch between two neighbouring token ends of either side, a group one
        between two ends that both sides share.
        """
        a_ends, b_ends = np.cumsum(self.a.lengths[a]), np.cumsum(self.b.lengths[b])
        ends, shared = merged(a_ends, b_ends)
        links = a[np.searchsorted(a_ends, ends)] << 32 | b[np.searchsorted(b_ends, ends)]
        a_stops, b_stops = np.searchsorted(a_ends, shared) + 1, np.searchsorted(b_ends, shared) + 1
        a_counts, b_counts = np.diff(a_stops, prepend=0), np.diff(b_stops, prepend=0)
        # a group's ids of A, then those of B: each id goes behind all of the groups before
        written = np.empty(len(a) + len(b), np.int64)
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[a_stops - 1] = last_b[b_stops - 1] = 1
        written[np.arange(len(a)) + np.repeat(b_stops - b_counts, a_counts)] = 2 * a + last_a
        written[np.arange(len(b)) + np.repeat(a_stops, b_counts)] = 2 * (len(self.a.tokens) + b) + last_b
        names, n_a = self.a.written, len(self.a.written)
        texts = [names[k] if k < n_a else self.b.written[k - n_a] for k in written.tolist()]
        window_ends = a_ends[np.cumsum(a_sizes) - 1]
        text_stops = np.cumsum(a_sizes + b_sizes).tolist()
        link_stops = (8 * (np.searchsorted(ends, window_ends) + 1)).tolist()
        raw = links.astype("<i8").tobytes()
        return [
            ("".join(texts[i:j]), raw[k:m])
            for i, j, k, m in zip([0, *text_stops], text_stops, [0, *link_stops], link_stops)
        ]

    def windows_of(self, a: np.ndarray, b: np.ndarray, a_cuts: np.ndarray, b_cuts: np.ndarray):
        """(codes, found): which of the distinct windows ``found`` each window between the cuts is."""
        a_sizes, b_sizes = np.diff(a_cuts), np.diff(b_cuts)
        narrow = (a_sizes <= NARROW) & (b_sizes <= NARROW) if self.packs else np.zeros(len(a_sizes), bool)
        where, codes = np.flatnonzero(narrow), np.empty(len(a_sizes), np.int64)
        a_keys = packed_ids(a, a_cuts[where], a_sizes[where])
        b_keys = packed_ids(b, b_cuts[where], b_sizes[where])
        b_codes, b_known = pd.factorize(b_keys)
        a_codes, _ = pd.factorize(a_keys)
        codes[where], distinct = pd.factorize(a_codes * (len(b_known) + 1) + b_codes)
        first = np.empty(len(distinct), np.int64)
        first[codes[where][::-1]] = where[::-1]
        place = np.searchsorted(where, first)
        keys = list(zip(a_keys[place].tolist(), b_keys[place].tolist()))
        firsts = first.tolist()
        known: dict[tuple, int] = {}
        a_raw, b_raw = a.astype("<u4").tobytes(), b.astype("<u4").tobytes()
        for at in np.flatnonzero(~narrow).tolist():
            key = a_raw[4 * a_cuts[at]:4 * a_cuts[at + 1]], b_raw[4 * b_cuts[at]:4 * b_cuts[at + 1]]
            if key not in known:
                known[key] = len(keys)
                keys.append(key)
                firsts.append(at)
            codes[at] = known[key]
        found = list(map(self.windows.get, keys))
        missing = [k for k, held in enumerate(found) if held is None]
        if missing:
            at = np.array([firsts[k] for k in missing])
            made = self.align(
                a[spread(a_cuts[at], a_sizes[at])], b[spread(b_cuts[at], b_sizes[at])], a_sizes[at], b_sizes[at]
            )
            if len(self.windows) + len(made) > REMEMBERED:
                self.windows.clear()
            short = (a_sizes[at] + b_sizes[at] <= REMEMBERED_TOKENS).tolist()
            for k, new, remembered in zip(missing, made, short):
                found[k] = new
                if remembered:
                    self.windows[keys[k]] = new
        return codes, found

    def block(self, texts: list[str | None]) -> Block:
        """The alignment of some texts; their ids are handled as one sequence, as a text's end is shared."""
        a_ids, b_ids = self.tokens(texts)
        n_a, n_b = np.array(list(map(len, a_ids)), np.int64), np.array(list(map(len, b_ids)), np.int64)
        a, b = (np.concatenate([np.empty(0, np.int64), *ids]) for ids in (a_ids, b_ids))
        if not len(a):
            none = np.empty(0, np.int64)
            return Block(n_a.tolist(), n_b.tolist(), [""] * len(texts), np.zeros(len(texts), np.int64), none, none)
        a_ends, b_ends = np.cumsum(self.a.lengths[a]), np.cumsum(self.b.lengths[b])
        # every text begins with a space, so its begin is an anchor as well
        before_a, before_b = (
            (ends - v.lengths[ids])[v.spaced[ids]] for v, ids, ends in ((self.a, a, a_ends), (self.b, b, b_ends))
        )
        text_ends = a_ends[np.cumsum(n_a)[n_a > 0] - 1]
        anchors, _ = merged(merged(before_a, before_b)[1], text_ends)
        anchors = anchors[anchors > 0]
        a_cuts = np.append(0, np.searchsorted(a_ends, anchors) + 1)
        b_cuts = np.append(0, np.searchsorted(b_ends, anchors) + 1)
        codes, found = self.windows_of(a, b, a_cuts, b_cuts)
        stops = np.zeros(len(texts), np.int64)
        stops[n_a > 0] = np.searchsorted(anchors, text_ends) + 1
        stops = np.maximum.accumulate(stops)
        names, listed = [groups for groups, _ in found], codes.tolist()
        groups = ["".join([names[c] for c in listed[i:j]])[:-1] for i, j in zip([0, *stops.tolist()], stops.tolist())]
        sizes = np.array([len(raw) // 8 for _, raw in found])
        places, pairs = pd.factorize(np.frombuffer(b"".join([raw for _, raw in found]), "<i8"), sort=True)
        n_links = np.diff(np.append(0, np.cumsum(sizes[codes]))[np.append(0, stops)])
        links = places[spread((np.cumsum(sizes) - sizes)[codes], sizes[codes])]
        return Block(n_a.tolist(), n_b.tolist(), groups, n_links, pairs, links)


@lru_cache(maxsize=2)
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


def gathered(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, list[str | None]]]:
    """Ids and texts of consecutive rows, BLOCK_CHARS characters together or one longer text."""
    ids, texts, size = [], [], 0
    for batch in slices(batches):
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py()
            n = len(text or "") + 1
            if ids and size + n > BLOCK_CHARS:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(doc_id)
            texts.append(text)
            size += n
    if ids:
        yield ids, texts


def n_groups(groups: str) -> int:
    return groups.count(";") + 1 if groups else 0


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups): one row for each row, from its whole text.

    ``groups`` holds the groups of tokens between offsets where both tokenizers end one, as
    ``a1,a2|b1;a3|b2,b3`` (ids of A, then of B); links are the pairs of an A and a B token that share
    a byte.  A text that is null or empty, or that either tokenizer's tokens don't spell, has none:
    zeros and an empty ``groups``.  Repeated rows stay, a null doc_id stays null, other columns are
    not read.  Both files must be readable on every executor.
    """
    def work(batches):
        tool = aligner(a_path, b_path)
        for ids, texts in gathered(batches):
            found = tool.block(texts)
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, id_type), pa.array(found.n_a, pa.int64()), pa.array(found.n_b, pa.int64()),
                pa.array(map(n_groups, found.groups), pa.int64()), pa.array(found.n_links, pa.int64()),
                pa.array(found.groups, pa.string()),
            ], names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups"])

    source = pick(docs, "doc_id", "text")
    kind, id_type = source.schema["doc_id"].dataType.simpleString(), to_arrow_type(source.schema["doc_id"].dataType)
    return source.mapInArrow(
        work, f"doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string"
    )


#: Numbers of a document, and digest of its groups, as lists of a block.
LISTS = ["n_a", "n_b", "n_groups", "n_links"]


def _blocks(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row for each block of documents: their numbers, and its distinct pairs (see above)."""
    def work(batches):
        tool, block = aligner(a_path, b_path), TaskContext.get().partitionId() << 32
        for number, (ids, texts) in enumerate(gathered(batches)):
            found = tool.block(texts)
            n_pairs = max(len(found.pairs), 1)
            docs = np.repeat(np.arange(len(ids)), found.n_links)
            own, times = np.unique(docs * n_pairs + found.links, return_counts=True)
            which, index = np.divmod(own, n_pairs)
            ends = np.searchsorted(which, np.arange(len(ids)), "right")
            held = np.bincount(index, minlength=len(found.pairs))
            digests = [sha256(text.encode()).hexdigest() if text else "" for text in found.groups]
            longs = found.n_a, found.n_b, list(map(n_groups, found.groups)), found.n_links
            yield pa.RecordBatch.from_arrays([
                pa.array([block + number], pa.int64()), pa.array([ids], pa.list_(id_type)),
                *[pa.array([x], pa.list_(pa.int64())) for x in longs],
                pa.array([digests], pa.list_(pa.string())),
                *[pa.array([x], pa.list_(pa.int64())) for x in (found.pairs, held)],
                *[pa.array([x.astype("<u4").tobytes()], pa.binary()) for x in (ends, index, times)],
            ], names=names)

    source = pick(docs, "doc_id", "text")
    kind, id_type = source.schema["doc_id"].dataType.simpleString(), to_arrow_type(source.schema["doc_id"].dataType)
    names = ["block", "doc_id", *LISTS, "groups_sha256", "pairs", "held", "ends", "index", "times"]
    return source.mapInArrow(
        work, f"block bigint, doc_id array<{kind}>, {', '.join(f'{name} array<bigint>' for name in LISTS)}, "
        "groups_sha256 array<string>, pairs array<bigint>, held array<bigint>, ends binary, index binary, times binary"
    )


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, n, best): documents that hold each pair linked, and whether that is its A id's most."""
    held = blocks.select(F.inline(F.arrays_zip("pairs", "held"))).withColumnRenamed("pairs", "pair")
    counts = held.groupBy("pair").agg(F.sum("held").alias("n")).withColumn("a", F.shiftright("pair", 32))
    most = counts.groupBy("a").agg(F.max("n").alias("most"))  # a row for each id of A at most
    return counts.join(F.broadcast(most), "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def scored(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one row for each row.

    A pair of ids counts once for each row of ``docs`` that holds it linked.  ``n_best`` are the
    links whose pair has the highest count of its A id, ties included; ``count_sum`` sums the counts
    of all links.  Of the groups, which ``align`` returns and which are several times as long as the
    text, the SHA-256 is kept; it is '' where there are none.  Other cases are as for ``align``.
    """
    spark = docs.sparkSession
    path = new_folder(spark, "alignment")
    _blocks(docs, a_path, b_path).write.option("compression", "zstd").parquet(path)
    blocks = spark.read.parquet(path)
    wanted = blocks.select("block", F.explode("pairs").alias("pair"))
    fetched = wanted.join(pair_counts(blocks), "pair").groupBy("block").agg(
        F.collect_list(F.struct("pair", "n", "best")).alias("found")
    )
    numbers = blocks.drop("pairs", "held").join(fetched, "block", "left").drop("block")
    names = ["doc_id", *LISTS, "n_best", "count_sum", "groups_sha256"]

    def work(batches):
        for batch in slices(batches, 1):
            rows = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
            found = rows["found"].flatten()
            order = np.argsort(found.field("pair").to_numpy()) if len(found) else np.empty(0, np.int64)
            ends, index, times = (np.frombuffer(rows[x][0].as_py(), "<u4") for x in ("ends", "index", "times"))
            ends, sums = np.concatenate([[0], ends]).astype(np.int64), []
            for name in ("best", "n"):
                values = found.field(name).to_numpy(zero_copy_only=False)[order].astype(np.int64) if len(found) else order
                total = np.concatenate([[0], np.cumsum(values[index] * times)])
                sums.append(pa.array(total[ends[1:]] - total[ends[:-1]], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [rows[x].flatten() for x in ("doc_id", *LISTS)] + sums + [rows["groups_sha256"].flatten()], names=names
            )

    kind = numbers.schema["doc_id"].dataType.elementType.simpleString()
    return numbers.mapInArrow(work, ", ".join([f"doc_id {kind}", *[f"{x} bigint" for x in names[1:-1]], "groups_sha256 string"]))
