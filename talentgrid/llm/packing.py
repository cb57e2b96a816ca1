"""Packing of tokenised documents into sequences of bounded length.

Each task packs the documents of its partition in their order.  Their tokens form one stream;
a sequence is a window of it.  Windows may end at the end of a document (free), at the end of a
sentence (CUT_SENTENCE) or, where a sentence alone is longer than half a window or at the end of
a stretch, inside a sentence (CUT_INSIDE).  Dynamic programming over these places minimises
padding plus penalties.  A window's padding is the length limit less its length, so

    cost[j] = penalty[j] - place[j] + limit + min(cost[i] + place[i])

over the places i at most ``limit`` tokens before j: a sliding minimum, kept in a monotone queue,
so that each place enters and leaves it once.  Windows whose length is a power of two need no
padding; these few predecessors are looked up directly.

A stretch of STRETCH tokens is planned at once, which bounds memory whatever the size of a
partition or document, and costs at most one partly filled sequence a stretch.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from bisect import bisect_left
from collections import deque
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from talentgrid.llm.byte_bpe import byte_letters, slices
from talentgrid.llm.frames import pick

#: Penalties, in tokens of padding, for ending a window inside a document.
CUT_SENTENCE, CUT_INSIDE = 4, 40
#: Tokens planned at once.
STRETCH = 1 << 19
#: Words whose ids a worker remembers, twice as many with those of the time before, and their length.
REMEMBERED, REMEMBERED_CHARS = 200_000, 64
#: Characters of a text handled at once, and of texts whose new words are encoded together.
AT_ONCE, GROUP_CHARS = 1 << 20, 10_000
#: A character that is a token of its own; it parts words that are encoded together.
GAP = "\x02"
#: The first character beyond those that are one byte in Latin-1; the end of a word for the encoder by ranks, and
#: the ranks that its own bytes take.
LATIN_END, WORD_END, WORD_END_RANKS = "\u0100", "\U0010fffd", 3
#: Words that one call of the tokenizer encodes: its cost a word is least for some hundred.
CALL_WORDS = 256
#: Last characters of a token that ends a sentence.
SENTENCE_ENDS = ".!?…"
#: Marks that make up one piece with each other, whatever letters and digits stand before them.
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
SEPARATORS = re.compile("[\x1c-\x1f]")


def ranked_words(path: str):
    """A BPE file with word ends as tiktoken's encoder of lower-case words, several times as fast; None if it might differ.

    A private character, whose bytes are joined first, stands for the end of a word.  Merges by rank of the token they
    make give the ids of merges by rank of the pair where tokens are numbered in the order of their
    merges, as training numbers them; tests compare both.
    """
    import tiktoken

    with open(path, encoding="utf-8") as lines:
        file = json.load(lines)
    model, letters, end = file["model"], byte_letters(), "</w>"
    steps = [step.get("type") for step in (file.get("normalizer") or {}).get("normalizers", [])]
    if model.get("type") != "BPE" or model.get("end_of_word_suffix") != end or steps != ["NFC", "Replace", "Lowercase"]:
        return None
    if any(model.get(key) for key in ("dropout", "unk_token", "continuing_subword_prefix", "ignore_merges")):
        return None
    ids, special = model["vocab"], {token["content"] for token in file.get("added_tokens", [])}
    pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"]]
    made = [ids.get("".join(pair), -1) for pair in pairs]
    first = [ids.get(letter + tail, len(ids)) for letter in letters for tail in ("", end)]
    plain = {token: number for token, number in ids.items() if token not in special}
    if not all(low < high for low, high in zip([max(first), *made], made)) or len(plain) != len(first) + len(made):
        return None
    mark, ranks = WORD_END.encode(), {}
    for token, number in plain.items():
        stem = token.removesuffix(end)
        ranks[bytes(letters[c] for c in stem) + mark * (token != stem)] = number + WORD_END_RANKS
    joined = {mark[:k + 2]: k for k in range(WORD_END_RANKS)}  # the mark's own bytes, before all else
    if joined.keys() & ranks.keys():
        return None
    ranks |= joined
    return tiktoken.Encoding("ranked-words", pat_str="[^ ]+", mergeable_ranks=ranks, special_tokens={})


class Words:
    """Ids of a text by a tokenizers file that treats white space as a separator only.

    With ``special``, the string of a special token in a text is that token, as the library's
    plain call has it; else it is text like any other.
    """

    def __init__(self, path: str, special: bool = False, remembered: int | None = None):
        import regex
        from tokenizers import Tokenizer

        self.remembered = remembered or REMEMBERED
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        added = self.tokenizer.get_added_tokens_decoder().values() if special else ()
        # in lower case: only a word as it stands tells whether it holds the token
        self.special = [token.content.lower() for token in added]
        self.ranked = ranked_words(path)
        (gap_id,) = self.tokenizer.encode(GAP, add_special_tokens=False).ids
        self.split = regex.compile(r"\S+").findall
        self.gap = regex.compile(r"\s")
        # words used since the first store was full last time, and those of the time before
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        tokens = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        self.ends_word = np.array([token.endswith("</w>") for token in tokens])
        self.is_gap = np.arange(len(tokens)) == gap_id
        ends = {self.tokenizer.encode(c, add_special_tokens=False).ids[-1] for c in SENTENCE_ENDS}
        self.ends_sentence = np.array([
            i in ends or token.removesuffix("</w>")[-1:] in (".", "!", "?") for i, token in enumerate(tokens)
        ])

    def _learn(self, words: set[str]) -> None:
        """Encode forms: those of Latin letters by ranks, others of letters only in one text, as each ends
        one piece, the rest alike but parted by a word of one control character.
        """
        latin, plain, rest = [], [], []
        for word in words:
            if not word.isalpha():
                rest.append(word)
            elif word.isascii() or max(word) < LATIN_END:
                latin.append(word)
            else:
                plain.append(word)
        if not (self.ranked and self._ranked(latin)):
            plain += latin
        if not all([self._cut(plain[at:at + CALL_WORDS], " ", self.ends_word) for at in range(0, len(plain), CALL_WORDS)]):
            rest += plain
        for word in [word for word in rest if GAP in word]:
            self.known[word] = array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        rest = [word for word in rest if GAP not in word]
        for at in range(0, len(rest), CALL_WORDS):
            self._cut(rest[at:at + CALL_WORDS], f" {GAP} ", self.is_gap)

    def _ranked(self, words: list[str]) -> bool:
        """Encode lower-case words of Latin letters, which the normaliser leaves as they are, by ranks."""
        if not words:
            return True
        ids = np.array(self.ranked.encode_ordinary(f"{WORD_END} ".join(words) + WORD_END), "<u4") - np.uint32(WORD_END_RANKS)
        stops = (4 * (np.flatnonzero(self.ends_word[ids]) + 1)).tolist()
        if len(stops) != len(words):
            return False
        raw = ids.tobytes()
        self.known.update((word, raw[i:j]) for word, i, j in zip(words, [0, *stops], stops))
        return True

    def _cut(self, words: list[str], between: str, marks: np.ndarray) -> bool:
        """Encode words in one text and cut the ids at marked ones; False if these don't fit."""
        if not words:
            return True
        (found,) = self.tokenizer.encode_batch_fast([between.join(words)], add_special_tokens=False)
        ids = np.array(found.ids, "<u4")
        cuts = np.flatnonzero(marks[ids])
        raw, width = ids.tobytes(), int(between == " ")
        starts, ends = [0, *(cuts + 1).tolist()], (cuts + width).tolist()
        if width == 0:
            ends.append(len(ids))
        if len(ends) != len(words):
            return False
        self.known.update((word, raw[4 * i:4 * j]) for word, i, j in zip(words, starts, ends))
        return True

    def ids(self, text: str | None) -> bytes:
        """Ids without special tokens, as little-endian unsigned 32-bit integers."""
        return self.batch([text])[0]

    def batch(self, texts: Iterable[str | None]) -> list[bytes]:
        """Ids of each text.

        Nothing in the tokenizer reaches across white space, so words are encoded one by one
        and common ones are remembered; the new words of a few texts are encoded together.
        """
        out, group, size = [], [], 0
        for text in texts:
            group.append(text or "")
            size += len(group[-1])
            if size > GROUP_CHARS:
                out += self._group(group)
                group, size = [], 0
        return out + self._group(group)

    def _group(self, texts: list[str]) -> list[bytes]:
        if len(texts) == 1 and len(texts[0]) > AT_ONCE:
            return [b"".join(self._words([part])[0] for part in self._parts(texts[0]))]
        if any(len(text) > AT_ONCE for text in texts):
            return [ids for text in texts for ids in self._group([text])]
        return self._words(texts)

    def _parts(self, text: str) -> Iterator[str]:
        """A long text in parts that begin with white space."""
        at = 0
        while at < len(text):
            gap = self.gap.search(text, at + AT_ONCE)
            end = gap.start() if gap else len(text)
            yield text[at:end]
            at = end

    def _words(self, texts: list[str]) -> list[bytes]:
        held, new = [], set()
        for text in texts:
            # str.split() also cuts at the four separators, which are no white space here
            words = self.split(text) if SEPARATORS.search(text) else text.split()
            found = list(map(self.known.get, words))
            missing = places_of_none(found)
            new.update([words[k] for k in missing])
            held.append((words, found, missing))
        if new:
            self._keep(new)
        known, out = self.known, []
        for words, found, missing in held:
            for k in missing:
                found[k] = known[words[k]]
            out.append(b"".join(found))
        for word in [word for word in new if len(word) > REMEMBERED_CHARS]:
            del known[word]
        return out

    def _keep(self, new: set[str]) -> None:
        """Encode words that the store doesn't hold and put them there."""
        if len(self.known) + len(new) > self.remembered:
            self.known, self.old = {}, self.known
        known, before = self.known, self.old
        again = new & before.keys()
        known.update({word: before[word] for word in again})
        plain = new - again
        text = "\n".join(plain).lower() if self.special else ""
        if some := [string for string in self.special if string in text]:
            whole = [word for word in plain if any(string in word.lower() for string in some)]
            for word in whole:
                known[word] = array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
            plain = plain.difference(whole)
        own = [word for word in plain if word.isalpha() and word.islower()]  # their own forms
        forms = {word: stem(word) for word in plain.difference(own)}
        unknown = {form for pair in forms.values() for form in pair if form not in known}.union(own)
        unknown.discard("")
        if unknown:
            self._learn(unknown)
        known[""] = b""
        known.update({word: known[form] + known[end] if end else known[form] for word, (form, end) in forms.items()})


def places_of_none(values: list) -> list[int]:
    places, at = [], -1
    try:
        while True:
            at = values.index(None, at + 1)
            places.append(at)
    except ValueError:
        return places


def stem(word: str) -> tuple[str, str]:
    """A form of the word with the same ids, less the marks at its end, and these.

    A run of marks is a piece of its own after what the tokenizer's normaliser (NFC, lower-casing)
    leaves as a letter or digit, and case doesn't matter.  Some letters become a letter and a
    combining mark, which the tokenizer joins with the marks.  Letters up to U+00FF have one
    lower-case form, which is composed.
    """
    form = word.rstrip(MARKS)
    end = word[len(form):]
    if end and not ends_alnum(form):
        form, end = word, ""
    return (form.lower() if form.isascii() or max(form) < LATIN_END else form), end


def ends_alnum(word: str) -> bool:
    """True if the word's last character is a letter or digit, also after NFC and lower-casing."""
    if not word[-1:].isalnum():
        return False
    return word[-1].isascii() or unicodedata.normalize("NFC", word).lower()[-1].isalnum()


@lru_cache(maxsize=2)
def words_of(path: str, special: bool = False, remembered: int | None = None) -> Words:
    return Words(path, special, remembered)


def plan(places: list[int], penalties: list[int], limit: int) -> list[int]:
    """The window ends among ``places`` that cost least; of equal costs, the window from the monotone queue's
    earliest place, which wins against a power of two of the same cost.

    ``places`` ascend from 0 to the length of the stretch, neighbours at most ``limit`` apart.
    """
    # pairs of places a power of two apart, by the later one
    every, early, late = np.array(places), [], []
    for length in [1 << k for k in range(limit.bit_length()) if 1 << k <= limit]:
        found = np.searchsorted(every, every - length)
        exact = np.flatnonzero(every[found] == every - length)
        early.append(found[exact])
        late.append(exact)
    early, late = np.concatenate(early), np.concatenate(late)
    early = early[np.argsort(late, kind="stable")].tolist()
    stops = np.cumsum(np.bincount(late, minlength=len(places))).tolist()
    cost, came = [0] * len(places), [0] * len(places)
    queue: deque[tuple[int, int]] = deque([(0, 0)])  # (cost + place, position), both ascending
    for j in range(1, len(places)):
        place = places[j]
        while places[queue[0][1]] < place - limit:
            queue.popleft()
        best, came[j] = queue[0][0] - place + limit, queue[0][1]
        for i in early[stops[j - 1]:stops[j]]:
            if cost[i] < best:
                best, came[j] = cost[i], i
        cost[j] = best + penalties[j]
        entry = cost[j] + place
        while queue and queue[-1][0] >= entry:
            queue.pop()
        queue.append((entry, j))
    ends, j = [], len(places) - 1
    while j:
        ends.append(places[j])
        j = came[j]
    return ends[::-1]


def windows(doc_ends: list[int], sentence_ends: np.ndarray, limit: int) -> list[int]:
    """Window ends of a stretch of tokens.

    ``doc_ends`` and ``sentence_ends`` are places (tokens before them) in ascending order; the
    last document end closes the stretch.
    """
    length = doc_ends[-1]
    kinds = dict.fromkeys(sentence_ends.tolist(), CUT_SENTENCE) | dict.fromkeys(doc_ends, 0)
    known = sorted(kinds)
    tail = [length - (1 << k) for k in range(limit.bit_length()) if 1 << k < length]
    forced, last = set(), 0
    for place in known:
        if place - last > limit // 2:
            forced.update(range(last + limit // 2, place, limit // 2))
        last = place
    for place in forced | set(tail):
        kinds.setdefault(place, CUT_INSIDE)
    kinds[0] = kinds[length] = 0
    places = sorted(kinds)
    return plan(places, [kinds[place] for place in places], limit)


def pack(
    docs: DataFrame, tokenizer_path: str, limit: int = 2048, end_id: int = 1, remembered: int = REMEMBERED
) -> DataFrame:
    """One row for each piece of a document that lies in one sequence.

    Columns: doc_id, start (the document's ids before the piece), length, ids (binary,
    little-endian unsigned 32-bit; those of the library's plain call, where a special token's
    string in a text is that token), doc_tokens (all ids of the document, with ``end_id``, which
    ends each one), sequence_id and offset (place in the sequence, gapless from 0).  Sequences
    follow the order of rows in a partition and never cross partitions.  A null or empty text
    is its end id alone.  Repeated rows are packed again; a null doc_id stays null; other
    columns are not returned.  A worker remembers the ids of ``remembered`` words, and as many from before, some
    200 bytes each: fewer take more time and change nothing else.
    """
    def work(batches):
        words = words_of(tokenizer_path, True, remembered)
        partition, made = TaskContext.get().partitionId(), 0
        held: list[tuple] = []  # (doc_id, start, ids of this part, doc_tokens)
        tokens = 0

        def packed():
            nonlocal made
            stream = np.concatenate([part for _, _, part, _ in held])
            part_ends = np.cumsum([len(part) for _, _, part, _ in held])
            closes = [int(e) for e, (_, start, part, n) in zip(part_ends, held) if start + len(part) == n]
            if not closes or closes[-1] != len(stream):
                closes.append(len(stream))
            sentences = np.flatnonzero(words.ends_sentence[stream]) + 1
            ends = windows(closes, sentences[sentences < len(stream)], limit)
            rows, at = [], 0
            for k, (doc_id, start, part, n) in enumerate(held):
                begin, end = int(part_ends[k]) - len(part), int(part_ends[k])
                at = begin
                window = bisect_left(ends, begin + 1)
                while at < end:
                    stop = min(end, ends[window])
                    opened = ends[window - 1] if window else 0
                    rows.append((
                        doc_id, start + at - begin, stop - at, stream[at:stop].tobytes(), n,
                        partition << 32 | (made + window), at - opened,
                    ))
                    at, window = stop, window + 1
            made += len(ends)
            for first in range(0, len(rows), 4096):
                columns = list(zip(*rows[first:first + 4096]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in zip(columns, kinds)], names=names
                )

        for batch in slices(batches):
            for doc_id, raw in zip(batch.column(0).to_pylist(), words.batch(text.as_py() for text in batch.column(1))):
                ids = np.append(np.frombuffer(raw, "<u4"), np.uint32(end_id))
                for start in range(0, len(ids), STRETCH):
                    part = ids[start:start + STRETCH]
                    if tokens and tokens + len(part) > STRETCH:
                        yield from packed()
                        held, tokens = [], 0
                    held.append((doc_id, start, part, len(ids)))
                    tokens += len(part)
        if held:
            yield from packed()

    source = pick(docs, "doc_id", "text")
    id_type = source.schema["doc_id"].dataType
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    from pyspark.sql.pandas.types import to_arrow_type

    long = pa.int64()
    kinds = [to_arrow_type(id_type), long, long, pa.binary(), long, long, long]
    return source.mapInArrow(
        work, f"doc_id {id_type.simpleString()}, start bigint, length bigint, ids binary, "
        "doc_tokens bigint, sequence_id bigint, offset bigint",
    )
