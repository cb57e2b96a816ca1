"""Quality classifier: a convolutional network over the bytes of whole documents, in numpy.

A byte is embedded in DIM numbers.  FILTERS learned filters, WIDTH bytes wide, look at every STEP-th
place of the text; each keeps its largest answer in each chunk of CHUNK bytes (chunks overlap by
half).  A chunk's answers give HIDDEN values, their means over all chunks one logit, and that
the probability.  So every byte of a text of any length counts, and a text's length itself doesn't.

The convolution is computed once for each place: answers are pooled over halves of chunks, and two
neighbouring halves make a chunk.  The network is fitted by Adam on a bounded sample of labelled
documents, of each at most PIECES chunks spread evenly over the text; scoring reads whole texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talentgrid.llm.byte_bpe import slices
from talentgrid.llm.frames import pick

DIM, FILTERS, HIDDEN = 8, 48, 16
#: Bytes between places, blocks of that many bytes a filter sees, bytes of a chunk and of its half.
STEP, BLOCKS, CHUNK = 4, 3, 512
WIDTH, HALF = STEP * BLOCKS, CHUNK // 2
#: Labelled documents that the network is fitted on, at most, and chunks of each.
SAMPLE, PIECES = 4000, 8
#: Bytes of a training chunk: its last places see what follows.
PIECE = CHUNK + WIDTH - STEP
#: Bytes convolved at once.
AT_ONCE = 1 << 18
#: Least score of a document that is predicted good.
LEAST_SCORE = 0.3


@dataclass
class Network:
    """The weights; ``filters`` maps a block's embedded bytes to its part of each filter's answer."""

    embedding: np.ndarray  # 256 x DIM
    filters: np.ndarray  # BLOCKS x (STEP * DIM) x FILTERS
    bias: np.ndarray
    hidden: np.ndarray  # FILTERS x HIDDEN
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def fresh(cls, seed: int) -> Network:
        draw = np.random.default_rng(seed).standard_normal
        inputs = STEP * DIM
        return cls(*[x.astype(np.float32) for x in (
            draw((256, DIM)) * 0.5, draw((BLOCKS, inputs, FILTERS)) / np.sqrt(BLOCKS * inputs), np.zeros(FILTERS),
            draw((FILTERS, HIDDEN)) / np.sqrt(FILTERS), np.zeros(HIDDEN), draw(HIDDEN) / np.sqrt(HIDDEN), np.zeros(1),
        )])

    @property
    def weights(self) -> list[np.ndarray]:
        return [self.embedding, self.filters, self.bias, self.hidden, self.hidden_bias, self.out, self.out_bias]

    def answers(self, codes: np.ndarray) -> np.ndarray:
        """Answers of the filters at each place but the last BLOCKS - 1 of bytes in blocks of STEP."""
        blocks = self.embedding[codes].reshape(-1, STEP * DIM)
        places = len(blocks) - BLOCKS + 1
        total = blocks[:places] @ self.filters[0]
        for k in range(1, BLOCKS):
            total += blocks[k:k + places] @ self.filters[k]
        return total + self.bias

    def halves(self, texts: list[bytes]) -> list[np.ndarray]:
        """Largest positive answers in each half chunk of each text: (halves, FILTERS), none if empty."""
        found: list[list[np.ndarray]] = [[] for _ in texts]
        group, size = [], 0
        for k, text in enumerate(texts):
            for at in range(0, len(text), AT_ONCE):
                group.append((k, text[at:at + AT_ONCE], text[at + AT_ONCE:at + AT_ONCE + WIDTH - STEP]))
                size += len(group[-1][1])
                if size >= AT_ONCE:
                    self._pool(group, found)
                    group, size = [], 0
        if group:
            self._pool(group, found)
        return [np.concatenate(parts) if parts else np.zeros((0, FILTERS), np.float32) for parts in found]

    def _pool(self, group: list[tuple[int, bytes, bytes]], found: list[list[np.ndarray]]) -> None:
        buffer, cuts, own, at = [], [], [], 0
        for _, part, beyond in group:
            places = -(-len(part) // STEP)
            room = (places + BLOCKS - 1) * STEP
            buffer.append((part + beyond).ljust(room, b"\0"))
            starts = list(range(at, at + places, HALF // STEP))
            own.append(len(starts))
            cuts += [*starts, at + places]  # the last cut parts off the places that only look ahead
            at += places + BLOCKS - 1
        answers = self.answers(np.frombuffer(b"".join(buffer) + bytes(WIDTH), np.uint8))
        most = np.maximum(np.maximum.reduceat(answers, cuts, 0), 0)
        at = 0
        for (k, _, _), n in zip(group, own):
            found[k].append(most[at:at + n])
            at += n + 1

    def scores(self, texts: list[bytes]) -> list[float]:
        """Probability of label 1 of each whole text; an empty one is a chunk without any answer."""
        out = []
        for halves in self.halves(texts):
            if not len(halves):
                halves = np.zeros((1, FILTERS), np.float32)
            chunks = np.maximum(halves[:-1], halves[1:]) if len(halves) > 1 else halves
            hidden = np.tanh(chunks @ self.hidden + self.hidden_bias).mean(0, dtype=float)
            out.append(float(1 / (1 + np.exp(-(hidden @ self.out + self.out_bias[0])))))
        return out

    def slopes(self, codes: np.ndarray, sizes: np.ndarray, owner: np.ndarray, labels: np.ndarray) -> tuple[float, list]:
        """Log loss of documents given as chunks, and its slopes by the weights.

        ``codes`` are chunks x PIECE bytes, ``sizes`` the bytes of the chunk among them, ``owner``
        ascending numbers of documents from 0.
        """
        n, places = len(codes), CHUNK // STEP
        blocks = self.embedding[codes].reshape(n, PIECE // STEP, STEP * DIM)
        total = sum(blocks[:, k:k + places] @ self.filters[k] for k in range(BLOCKS)) + self.bias
        total[np.arange(places) * STEP >= sizes[:, None]] = 0
        best = total.argmax(1)  # chunks x FILTERS
        pooled = np.maximum(np.take_along_axis(total, best[:, None], 1)[:, 0], 0)
        hidden = np.tanh(pooled @ self.hidden + self.hidden_bias)
        share = 1 / np.bincount(owner, minlength=len(labels)).astype(hidden.dtype)
        means = np.zeros((len(labels), HIDDEN), hidden.dtype)
        np.add.at(means, owner, hidden * share[owner][:, None])
        logits = means @ self.out + self.out_bias
        chances = 1 / (1 + np.exp(-logits))
        loss = -np.log(np.where(labels == 1, chances, 1 - chances) + 1e-9).mean()

        error = ((chances - labels) / len(labels)).astype(hidden.dtype)
        to_hidden = (error * share)[owner][:, None] * self.out * (1 - hidden * hidden)
        to_pooled = to_hidden @ self.hidden.T * (pooled > 0)
        rows = np.arange(n)[:, None, None]
        at = best[:, :, None] + np.arange(BLOCKS)  # blocks that the winning place of each filter sees
        seen = blocks[rows, at]  # chunks x FILTERS x BLOCKS x inputs
        to_filters = np.einsum("cf,cfki->kif", to_pooled, seen, optimize=True)
        to_seen = to_pooled[:, :, None, None] * self.filters.transpose(2, 0, 1)
        which = codes.reshape(n, PIECE // STEP, STEP)[rows, at].ravel()
        by_byte = to_seen.reshape(-1, DIM)
        to_embedding = np.stack([np.bincount(which, by_byte[:, d], 256) for d in range(DIM)], 1)
        return float(loss), [
            to_embedding, to_filters, to_pooled.sum(0), pooled.T @ to_hidden, to_hidden.sum(0),
            means.T @ error, error.sum(keepdims=True),
        ]


def fit(
    chunks: list[list[bytes]], labels: list[int], passes: int = 8, batch: int = 32, rate: float = 0.004,
    decay: float = 1e-4, seed: int = 7,
) -> Network:
    """A network fitted to documents given as lists of chunks (PIECE bytes at most), by Adam."""
    network, order = Network.fresh(seed), np.random.default_rng(seed)
    weights = network.weights
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    step, steps = 0, passes * -(-len(labels) // batch)
    for _ in range(passes):
        shuffled = order.permutation(len(labels))
        for at in range(0, len(labels), batch):
            some = shuffled[at:at + batch]
            parts = [part for k in some for part in chunks[k]]
            codes = np.frombuffer(b"".join([part.ljust(PIECE, b"\0") for part in parts]), np.uint8).reshape(-1, PIECE)
            sizes = np.array([min(len(part), CHUNK) for part in parts])
            owner = np.repeat(np.arange(len(some)), [len(chunks[k]) for k in some])
            _, slopes = network.slopes(codes, sizes, owner, np.array([labels[k] for k in some]))
            step += 1
            pace = rate * (1 - step / (steps + 1)) * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
            for w, (first, second), slope in zip(weights, moments, slopes):
                slope = slope + decay * w
                first += 0.1 * (slope - first)
                second += 0.001 * (slope * slope - second)
                w -= (pace * first / (np.sqrt(second) + 1e-8)).astype(np.float32)
    return network


def spread_chunks(text: bytes, pieces: int = PIECES) -> list[bytes]:
    """At most ``pieces`` chunks of a text, evenly spread, the first and the last included."""
    last = max(-(-len(text) // HALF) - 2, 0)  # number of the last chunk; they begin at each half
    if last < pieces:
        starts = range(last + 1)
    else:
        starts = [round(k * last / (pieces - 1)) for k in range(pieces)]
    return [text[HALF * k:HALF * k + PIECE] for k in starts]


def held_out(doc_id: Column) -> Column:
    """True for rows that nothing is learned from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Network | None:
    """Learn ``quality`` from the texts of labelled rows that are not held out.

    At most ``sample`` labelled ids are used, those with the least hashes; of an id's repeated labels the least
    counts, of its repeated rows one text.  Null ids, labels and texts teach nothing.  Only chunks
    reach the driver, PIECES a document.  None if nothing is there to learn from.
    """
    marks = pick(labels, "doc_id", "quality").filter(
        F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id"))
    ).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = marks.withColumn("place", F.xxhash64(F.col("doc_id").cast("string"))).orderBy("place", "doc_id").limit(sample)
    texts = pick(docs, "doc_id", "text").filter(F.col("text").isNotNull())
    few = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "place", "quality", "text")

    def work(batches):
        for batch in slices(batches):
            parts = [spread_chunks(text.as_py()) for text in batch.column(3).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(parts, pa.list_(pa.binary()))], names=["doc_id", "place", "quality", "parts"]
            )

    kind = few.schema["doc_id"].dataType.simpleString()
    label = few.schema["quality"].dataType.simpleString()
    cut = few.mapInArrow(work, f"doc_id {kind}, place bigint, quality {label}, parts array<binary>")
    single = cut.groupBy("doc_id").agg(F.min(F.struct("place", "quality", "parts")).alias("row"))  # copies may differ
    rows = sorted((r.row for r in single.collect()), key=lambda r: (r.place, r.parts))
    if not rows:
        return None
    return fit([[bytes(part) for part in r.parts] for r in rows], [int(r.quality) for r in rows])


def score(docs: DataFrame, network: Network | None) -> DataFrame:
    """(doc_id, held_out, score, predicted): one row for each row, from its whole text alone.

    ``score`` is the chance of label 1, ``predicted`` 1 from LEAST_SCORE on.  Null texts are scored as
    empty ones: a chunk without any answer.  Without a network all scores are 0.5.  A null doc_id
    is not held out.  Other columns are not read.
    """
    def work(batches):
        for batch in slices(batches):
            texts = [text.as_py() or b"" for text in batch.column(2).cast(pa.binary())]
            found = network.scores(texts) if network else [0.5] * len(texts)
            yield pa.RecordBatch.from_arrays([
                *batch.columns[:2], pa.array(found, pa.float64()),
                pa.array([int(x >= LEAST_SCORE) for x in found], pa.int32()),
            ], names=["doc_id", "held_out", "score", "predicted"])

    source = pick(docs, "doc_id", "text").select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(work, f"doc_id {kind}, held_out boolean, score double, predicted int")
