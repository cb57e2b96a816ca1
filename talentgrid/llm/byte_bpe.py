"""Byte-level BPE: encoding by a rank file, decoding, and both as table operators.

A text is cut by the public pattern; a piece that is no token itself is merged pair by pair,
lowest rank first, leftmost of equal ranks.  The merge loop keeps a segment tree over the byte
positions of the piece.  A leaf holds the rank of the pair that starts there, a node the least
(rank, position) of its children, so the root is the next merge and each merge updates the
paths above three leaves in logarithmic time: a piece of any length costs n log n.  Nodes have
sixteen children, so that most words need leaves and root only.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame

from talentgrid.llm.frames import pick

#: Children of a node of the segment tree; the value of a place where no merge starts.
FAN_OUT, NONE = 16, 1 << 62
#: Words, and pieces, whose ids a worker remembers (emptied when full), and their length.
REMEMBERED, REMEMBERED_CHARS = 300_000, 64
#: Characters, or pieces, handled at once.
AT_ONCE = 1 << 20
#: Marks that may follow the letters of a word and make up one piece with each other: no apostrophe, which some pieces begin with.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
BEFORE_WORD = re.compile(r" (?=\S)")


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: visible ones of Latin-1
    for themselves, the others, in order, from U+0100 on.
    """
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = sorted(set(range(256)).difference(visible))
    return {chr(b): b for b in visible} | {chr(0x100 + k): b for k, b in enumerate(others)}


class Codec:
    """Encoder and decoder of one rank file (base64 token and rank on each line)."""

    def __init__(self, ranks_path: str, pattern: str):
        import regex

        with open(ranks_path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        # leaves of two bytes side by side, by their number; a place is added to them
        two = ((rank(bytes((a, b)))) for rank in (self.ranks.get,) for a in range(256) for b in range(256))
        self.two = [NONE if r is None else r << 32 for r in two]
        self.words, self.pieces = Remembered(), Remembered()
        # whether the pattern takes a word of letters with the space before it, and marks after it, as a piece each
        self.plain = self.pattern.findall(" aé中 aé中,.?! 1") == [" aé中", " aé中", ",.?!", " 1"]

    def merged(self, piece: bytes) -> list[int]:
        """Ids of a piece, by merging."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n, rank, two = len(piece), self.ranks.get, self.two
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        # a leaf: rank of the pair that starts there, and the place; no token is as long as NONE is large
        leaves = [two[a << 8 | b] + i for i, (a, b) in enumerate(zip(piece, piece[1:]))]
        leaves.append(NONE)
        levels = [leaves]
        while n > FAN_OUT and len(levels[-1]) > 1:
            below = levels[-1]
            levels.append([min(below[at:at + FAN_OUT]) for at in range(0, len(below), FAN_OUT)])
        root = levels[-1]
        while (least := min(root)) < NONE:
            i = least & 0xFFFFFFFF
            gone = after[i]
            after[i] = end = after[gone]
            leaves[gone] = NONE
            if end < n:
                before[end] = i
                r = rank(piece[i:after[end]])
                leaves[i] = NONE if r is None else r << 32 | i
            else:
                leaves[i] = NONE
            left = before[i]
            if left >= 0:
                r = rank(piece[left:end])
                leaves[left] = NONE if r is None else r << 32 | left
            if n > FAN_OUT:
                for changed in {left // FAN_OUT, i // FAN_OUT, gone // FAN_OUT} - {-1}:
                    for below, above in zip(levels, levels[1:]):
                        at = changed * FAN_OUT
                        above[changed] = min(below[at:at + FAN_OUT])
                        changed //= FAN_OUT
        ids, i, ranks = [], 0, self.ranks
        while i < n:
            ids.append(ranks[piece[i:after[i]]])
            i = after[i]
        return ids

    def _piece(self, piece: str) -> bytes:
        """Ids of a match of the pattern."""
        ids = self.pieces.get(piece)
        if ids is None:
            ids = array("I", self.merged(piece.encode())).tobytes()
            if len(piece) <= REMEMBERED_CHARS:
                self.pieces.keep(piece, ids)
        return ids

    def _plain(self, text: str) -> bytes:
        """Ids of a text, each match of the pattern merged on its own."""
        if len(text) <= AT_ONCE:
            return b"".join(map(self._piece, self.pattern.findall(text)))
        found, parts = self.pattern.finditer(text), []
        while some := [m[0] for m in islice(found, AT_ONCE)]:
            parts.append(b"".join(map(self._piece, some)))
        return b"".join(parts)

    def _word(self, word: str) -> bytes | None:
        """Ids of a space and a word; None if the word doesn't begin with a visible character.

        A word of letters is one piece with its space, and marks after one are another.
        """
        ids = self.words.get(word)
        if ids is not None:
            return ids
        if not word or word[0].isspace():
            return None
        stem = word.rstrip(MARKS)
        if self.plain and stem.isalpha():
            if stem == word:
                ids = array("I", self.merged((" " + word).encode())).tobytes()
            else:
                ids = self._word(stem) + self._piece(word[len(stem):])
        else:
            ids = self._plain(" " + word)
        if len(word) <= REMEMBERED_CHARS:
            self.words.keep(word, ids)
        return ids

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; a null text has none.

        No piece crosses a space before a visible character, so a text is cut there and the
        ids of common words are remembered.
        """
        parts, at = [], 0
        while text and at < len(text):
            cut = BEFORE_WORD.search(text, at + AT_ONCE)
            end = cut.start() if cut else len(text)
            part, at = text[at:end], end
            head, *words = part.split(" ")
            known, make = self.words.young.get, self._word
            ids = [known(word) or make(word) for word in words]
            parts += [self._plain(part)] if None in ids else [self._plain(head), *ids]
        return b"".join(parts)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, array("I", ids)))


class Remembered:
    """Ids of words, those used since the last two times that half of the room was full."""

    def __init__(self):
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def keep(self, word: str, ids: bytes) -> None:
        if len(self.young) >= REMEMBERED // 2:
            self.old = self.young.copy()
            self.young.clear()  # the same dictionary goes on
        self.young[word] = ids

    def get(self, word: str) -> bytes | None:
        ids = self.young.get(word)
        if ids is None and self.old and (ids := self.old.get(word)) is not None:
            self.keep(word, ids)
        return ids


@lru_cache(maxsize=4)
def codec(ranks_path: str, pattern: str) -> Codec:
    return Codec(ranks_path, pattern)


def slices(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that what is made from one stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of every whole text, without special tokens.

    One row for each input row; repeated rows stay.  ``ids`` is binary, little-endian unsigned
    32-bit.  A null or empty text gives no ids; a null doc_id stays null; other columns are not
    returned, whatever their names.  ``ranks_path`` must be readable on every executor.
    """
    def work(batches):
        to_ids = codec(ranks_path, pattern).encode
        for batch in slices(batches):
            ids = [to_ids(text.as_py()) for text in batch.column(1)]
            counts = pa.array([len(x) // 4 for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), counts, pa.array(ids, pa.binary())], names=["doc_id", "n_tokens", "ids"]
            )

    source = pick(docs, "doc_id", "text")
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(work, f"doc_id {kind}, n_tokens bigint, ids binary")


def coded(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded): what ``encode`` gives, and ``decode`` of that, in one pass over the texts."""
    def work(batches):
        codes = codec(ranks_path, pattern)
        for batch in slices(batches):
            ids = [codes.encode(text.as_py()) for text in batch.column(1)]
            counts = pa.array([len(x) // 4 for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), counts, pa.array(ids, pa.binary()), pa.array(map(codes.decode, ids), pa.binary())],
                names=["doc_id", "n_tokens", "ids", "decoded"],
            )

    source = pick(docs, "doc_id", "text")
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(work, f"doc_id {kind}, n_tokens bigint, ids binary, decoded binary")


def decode(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of rows as ``encode`` returns them; decoded is binary."""
    def work(batches):
        to_bytes = codec(ranks_path, pattern).decode
        for batch in slices(batches):
            decoded = pa.array([to_bytes(ids.as_py() or b"") for ids in batch.column(2)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, decoded], names=["doc_id", "n_tokens", "ids", "decoded"]
            )

    source = pick(encoded, "doc_id", "n_tokens", "ids")
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(work, f"doc_id {kind}, n_tokens bigint, ids binary, decoded binary")
