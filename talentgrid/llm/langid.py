"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are 1-, 2- and 3-grams of the lower-cased letters of the whole text (each run of other
characters counts as one space), hashed to BUCKETS places; a value is (1 + log count) times the
inverse document frequency, and a text's values have length 1.

* Document frequencies are counted over all texts learned from, by Spark.
* Weights are fitted with follow-the-regularised-leader (proximal, per coordinate) under an
  elastic net on four fifths of the labelled texts, in shards that tasks fit by themselves; the
  weights are the mean of the shards' (parameter mixing).  Shards are fixed by the texts, not by the
  cluster, and a language with less than its share of texts has them in several shards.
* A temperature, fitted on the fifth that the weights don't see, makes the scores
  probabilities.  What a known language's texts look like comes from the same two parts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from talentgrid.llm.byte_bpe import slices
from talentgrid.llm.frames import numbered, pick

BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
#: Languages that are learned, at most, the most frequent ones: bounds the size of a model.
MOST_LANGUAGES = 6000
#: Distinct n-grams of the texts of a shard, together, about; a task holds one shard, some thousand texts.
SHARD_GRAMS = 4_000_000
#: Tasks that fit shards, at most; each fits its shards one after the other.
MOST_TASKS = 2000
#: One text in so many is set aside from the weights, of languages that have some texts.
ASIDE, ASIDE_FROM = 5, 10
#: An n-gram is strange to a language if at most this share of its texts that weights are fitted on hold it;
#: a text whose share of strange n-grams exceeds this one is in no language that was learned.
#: Where texts say that little of a language, the second goes up to the third times what 99 in a
#: hundred texts that it was not fitted on reach.
RARE, MOST_STRANGE, MARGIN = 0.005, 0.03, 1.5
#: The language of a text without letters.
UNKNOWN = "und"
#: Characters hashed at once.
AT_ONCE = 1 << 20
#: Logarithms of the temperatures tried, and the steps of a strangeness that are told apart.
LOG_TEMPERATURES = np.linspace(-4.0, 3.0, 281)
STRANGE_STEPS = 100_000
#: Sums over texts are kept in whole numbers of this fraction, so that they don't depend on their order.
FRACTION = 1 << 30


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of a text, ascending, and their counts; none without letters."""
    letters, counts, seen = _letters(), None, False
    shift = np.uint32(32 - BUCKET_BITS)
    carry = np.array([32], np.uint32)
    for at in range(0, len(text or ""), AT_ONCE):
        part = text[at:at + AT_ONCE].lower().encode("utf-32-le", "surrogatepass")
        codes = np.frombuffer(part, "<u4")
        is_letter = letters[codes]
        seen |= bool(is_letter.any())
        codes = np.concatenate([carry, np.where(is_letter, codes, np.uint32(32))])
        fresh = len(carry)
        keep = np.ones(len(codes), bool)
        keep[fresh:] = (codes[fresh:] != 32) | (codes[fresh - 1:-1] != 32)
        codes = codes[keep]
        one = codes * np.uint32(2654435761)
        two = (one[:-1] ^ np.uint32(0x5BD1E995)) * np.uint32(2246822519) + one[1:]
        three = (two[:-1] ^ np.uint32(0x27D4EB2F)) * np.uint32(3266489917) + one[2:]
        first = fresh  # n-grams that end in this part only
        grams = [one[first:], two[max(first - 1, 0):], three[max(first - 2, 0):]]
        found = np.bincount(
            np.concatenate([(g * np.uint32(0x9E3779B1)) >> shift for g in grams]), minlength=BUCKETS
        )
        counts = found if counts is None else counts + found
        carry = codes[-2:]
    if not seen:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    buckets = np.flatnonzero(counts)
    return buckets, counts[buckets]


@dataclass
class Model:
    """What prediction needs; its size depends on BUCKETS and the number of languages only."""

    languages: list[str] = field(default_factory=list)
    idf: np.ndarray = field(default_factory=lambda: np.ones(BUCKETS, np.float32))
    weights: np.ndarray = field(default_factory=lambda: np.zeros((BUCKETS, 0), np.float32))
    bias: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))
    temperature: float = 1.0
    #: buckets that texts of each language commonly hold, and the share of others that is accepted
    familiar: np.ndarray = field(default_factory=lambda: np.zeros((0, BUCKETS), bool))
    most_strange: float = MOST_STRANGE

    def values(self, buckets: np.ndarray, counts: np.ndarray) -> np.ndarray:
        values = (1 + np.log(counts)) * self.idf[buckets]
        return values / (np.sqrt(values @ values) or 1.0)

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and calibrated probability; UNKNOWN and 0 for a text without letters."""
        buckets, counts = gram_counts(text)
        if not len(buckets) or not self.languages:
            return UNKNOWN, 0.0
        best, chance = self._best(buckets, counts)
        return self.languages[best], chance

    def _best(self, buckets: np.ndarray, counts: np.ndarray) -> tuple[int, float]:
        logits = self.values(buckets, counts) @ self.weights[buckets] + self.bias
        chances = softmax(logits / self.temperature)
        best = int(np.argmax(chances))  # of equal ones the first in the order of the languages' names
        return best, float(chances[best])

    def strangeness(self, buckets: np.ndarray, counts: np.ndarray) -> float:
        """Share of a text's n-grams that few texts of its likeliest language hold.

        It doesn't depend on how many languages are known: a text of another language is as
        strange to one as to a hundred.
        """
        best, _ = self._best(buckets, counts)
        return float(counts[~self.familiar[best, buckets]].sum() / counts.sum())

    def knows(self, text: str | None) -> bool:
        """Whether a text is in a language that was learned; never without letters."""
        buckets, counts = gram_counts(text)
        return bool(len(buckets) and self.languages) and self.strangeness(buckets, counts) <= self.most_strange


def softmax(logits: np.ndarray) -> np.ndarray:
    powers = np.exp(logits - logits.max(-1, keepdims=True))
    return powers / powers.sum(-1, keepdims=True)


def follow_the_leader(
    rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int,
    passes: int = 3, rate: float = 0.5, beta: float = 1.0, lasso: float = 0.02, ridge: float = 0.02,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights (BUCKETS x classes) and bias by FTRL-proximal; ``lasso`` makes weights zero."""
    z = np.zeros((BUCKETS + 1, classes))
    n = np.zeros((BUCKETS + 1, classes))

    def solved(z, n, lasso, ridge):
        step = -(z - np.sign(z) * lasso) / ((beta + np.sqrt(n)) / rate + ridge)
        return np.where(np.abs(z) > lasso, step, 0.0)

    for _ in range(passes):
        for buckets, values, label in rows:
            w = solved(z[buckets], n[buckets], lasso, ridge)
            bias = solved(z[-1], n[-1], 0.0, 0.0)
            error = softmax(values @ w + bias)
            error[label] -= 1
            for at, now, x in ((buckets, w, values[:, None]), (-1, bias, 1.0)):
                slope = x * error
                more = n[at] + slope * slope
                z[at] += slope - (np.sqrt(more) - np.sqrt(n[at])) / rate * now
                n[at] = more
    return solved(z[:-1], n[:-1], lasso, ridge), solved(z[-1], n[-1], 0.0, 0.0)


def log_losses(logits: np.ndarray, label: int) -> np.ndarray:
    """For each of LOG_TEMPERATURES the log loss of a text: that of its label, and the mean of all labels."""
    logs = -np.log(np.maximum(softmax(logits / np.exp(LOG_TEMPERATURES)[:, None]), 1e-12))
    return np.stack([logs[:, label], logs.mean(1)])


def least_temperature(own: np.ndarray, mean: np.ndarray, texts: int) -> float:
    """The temperature with the least log loss: that of a parabola through the best one tried and its neighbours.

    Labels are smoothed by one text in all, so that a faultless set of texts isn't taken for certainty.
    """
    doubt = 1 / (texts + 2)
    loss = ((1 - doubt) * own + doubt * mean) / texts
    at = min(max(int(np.argmin(loss)), 1), len(loss) - 2)
    left, middle, right = loss[at - 1:at + 2]
    bend, step = left - 2 * middle + right, LOG_TEMPERATURES[1] - LOG_TEMPERATURES[0]
    shift = (left - right) / (2 * bend) if bend > 0 else 0.0
    return float(np.exp(LOG_TEMPERATURES[at] + step * min(max(shift, -1.0), 1.0)))


def best_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss on these texts."""
    return least_temperature(*sum(log_losses(*text) for text in zip(logits, labels)), len(labels))


def held_out(doc_id: Column) -> Column:
    """True for rows that nothing is learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


@dataclass(frozen=True)
class _Labels:
    """The languages learned, in order, and how many texts each has."""

    texts: dict[str, int]

    def places(self) -> dict[str, int]:
        return {lang: k for k, lang in enumerate(self.texts)}

    def aside(self) -> set[str]:
        """Languages with enough texts to set some aside."""
        return {lang for lang, n in self.texts.items() if n >= ASIDE_FROM}


def _gram_frequencies(labelled: DataFrame, labels: _Labels) -> dict[int, np.ndarray]:
    """Texts that hold each bucket, by language of the texts that weights are fitted on; those set aside are -1.

    The two places after the buckets count texts with letters, and all texts.  A task sends a row for each bucket and language.
    """
    places, parted = labels.places(), labels.aside()

    def work(batches):
        total: dict[int, np.ndarray] = {}
        for batch in slices(batches):
            for _, is_aside, lang, text in _rows(batch):
                if lang not in places:
                    continue
                label = -1 if is_aside and lang in parted else places[lang]
                counts = total.setdefault(label, np.zeros(BUCKETS + 2, np.int64))
                buckets, _ = gram_counts(text)
                counts[buckets] += 1
                counts[BUCKETS] += len(buckets) > 0
                counts[BUCKETS + 1] += 1
        for label, counts in total.items():
            yield _entries(label, counts)

    found = labelled.mapInArrow(work, ENTRY).groupBy("label", "bucket").agg(F.sum("n").alias("n"))
    return _dense(found, BUCKETS + 2)


def _rows(batch: pa.RecordBatch) -> Iterator[list]:
    """The rows one by one, so that no two texts are turned into strings at once."""
    for cells in zip(*batch.columns):
        yield [cell.as_py() for cell in cells]


#: One number for a label and a bucket; what is summed by these two is bounded by the size of a model.
ENTRY = "label int, bucket int, n bigint"


def _entries(label: int, values: np.ndarray) -> pa.RecordBatch:
    """The numbers of a label that are not zero, as rows."""
    at = np.flatnonzero(values)
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(len(at), label, np.int32)), pa.array(at.astype(np.int32)), pa.array(values[at], pa.int64())
    ], names=["label", "bucket", "n"])


def _dense(entries: DataFrame, size: int) -> dict[int, np.ndarray]:
    """Rows of ENTRY as an array for each label."""
    table = entries.toArrow()
    label, bucket, n = (table.column(name).to_numpy() for name in ("label", "bucket", "n"))
    out = {}
    for one in np.unique(label).tolist():
        out[one] = np.zeros(size, np.int64)
        out[one][bucket[label == one]] = n[label == one]
    return out


def _shards(labelled: DataFrame, labels: _Labels, count: int) -> DataFrame:
    """(shard, place, label, buckets, counts) of the texts that weights are fitted on.

    Every text is in one shard at least; those of a language with less than its even share of the
    texts are in as many as make up for it, each once at most, so rows at most double.
    """
    places, parted = labels.places(), labels.aside()
    share = sum(labels.texts.values()) / len(places)
    copies = {lang: min(count, -int(-share // n)) for lang, n in labels.texts.items()}

    def work(batches):
        for batch in slices(batches):
            rows = []
            for place, is_aside, lang, text in _rows(batch):
                if lang not in places or is_aside and lang in parted:
                    continue
                buckets, counts = gram_counts(text)
                if len(buckets):
                    grams = buckets.astype("<u2").tobytes(), counts.astype("<u4").tobytes()
                    rows += [((place + k) % count, place, places[lang], *grams) for k in range(copies[lang])]
            if rows:
                kinds = pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()
                columns = [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=["shard", "place", "label", "buckets", "counts"])

    return labelled.mapInArrow(work, "shard int, place bigint, label int, buckets binary, counts binary")


def _mixed_weights(shards: DataFrame, count: int, shard_grams: int, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias: the mean over the shards, each fitted in its texts' fixed order."""
    classes, tasks = len(model.languages), min(count, MOST_TASKS)

    def work(batches):
        total, n, current, rows, grams = np.zeros((BUCKETS + 1, classes), np.int64), 0, None, [], 0

        def fitted():
            weights, bias = follow_the_leader(rows, classes)
            return np.rint(np.vstack([weights, bias]) * FRACTION).astype(np.int64)

        for batch in batches:
            for shard, _, label, buckets, counts in _rows(batch):
                # copies of one row lie in one shard, which may have too many; what is too large is fitted in parts
                if rows and (shard != current or grams > 4 * shard_grams):
                    total, n, rows, grams = total + fitted(), n + 1, [], 0
                current, grams = shard, grams + len(buckets) // 2
                buckets, counts = np.frombuffer(buckets, "<u2"), np.frombuffer(counts, "<u4").astype(np.float32)
                rows.append((buckets, model.values(buckets, counts), label))
        if rows:
            total, n = total + fitted(), n + 1
        yield _entries(-1, np.array([n]))
        for label in range(classes):
            yield _entries(label, total[:, label])

    placed = shards.repartitionById(tasks, F.pmod("shard", F.lit(tasks)))
    placed = placed.sortWithinPartitions("shard", "place", "label", "buckets", "counts")
    found = _dense(
        placed.mapInArrow(work, ENTRY).groupBy("label", "bucket").agg(F.sum("n").alias("n")), BUCKETS + 1
    )
    none = np.zeros(BUCKETS + 1, np.int64)
    mean = np.stack([found.get(k, none) for k in range(classes)], 1) / (FRACTION * found[-1][0])
    return mean[:-1], mean[-1]


def _judged(labelled: DataFrame, labels: _Labels, model: Model) -> dict[int, np.ndarray]:
    """Of the texts set aside: their log losses (0: of the label, 1: mean of all), and how many are how strange (2)."""
    places, parted = labels.places(), labels.aside()

    def work(batches):
        losses, strange = np.zeros((2, len(LOG_TEMPERATURES)), np.int64), np.zeros(STRANGE_STEPS + 1, np.int64)
        for batch in slices(batches):
            for _, _, lang, text in _rows(batch):
                buckets, counts = gram_counts(text) if lang in parted else ((), ())
                if len(buckets):
                    logits = model.values(buckets, counts) @ model.weights[buckets] + model.bias
                    losses += np.rint(log_losses(logits, places[lang]) * FRACTION).astype(np.int64)
                    strange[int(np.ceil(model.strangeness(buckets, counts) * STRANGE_STEPS))] += 1
        for label, values in enumerate((*losses, strange)):
            yield _entries(label, values)

    few = labelled.filter("aside")
    return _dense(few.mapInArrow(work, ENTRY).groupBy("label", "bucket").agg(F.sum("n").alias("n")), STRANGE_STEPS + 1)


def _quantile(counts: np.ndarray, share: float) -> float:
    """As ``np.quantile`` over values that are given as counts of whole numbers."""
    upto, at = np.cumsum(counts), share * (counts.sum() - 1)
    low, high = (np.searchsorted(upto, rank, "right") for rank in (np.floor(at), np.ceil(at)))
    return float(low + (high - low) * (at - np.floor(at)))


def train(docs: DataFrame, shard_grams: int = SHARD_GRAMS) -> Model:
    """Learn from text and lang of all rows that are not held out.

    Rows with a null text or lang teach nothing.  Every label is learned, the most frequent MOST_LANGUAGES
    of more.  Every text counts for document frequencies.  Four in five fit the weights and say what is
    common in their language; the fifth is kept from these for the temperature and for how strange a text may
    be; a language with less than ASIDE_FROM texts gives all to the weights.  Without any text set aside these stay as they are.
    Without any labelled text with letters the model knows no language.
    """
    place = F.xxhash64("text", "doc_id")
    labelled = pick(docs, "doc_id", "text", "lang").filter(
        F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))
    ).select(F.shiftright(place, 8).alias("place"), (F.pmod(place, F.lit(ASIDE)) == ASIDE - 1).alias("aside"), "lang", "text")
    counted = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES).collect()
    labels = _Labels(dict(sorted((row["lang"], row["count"]) for row in counted)))
    frequencies = _gram_frequencies(labelled, labels) if counted else {}
    every = sum(frequencies.values(), np.zeros(BUCKETS + 2, np.int64))
    held = sum((counts for label, counts in frequencies.items() if label >= 0), np.zeros(BUCKETS + 2, np.int64))
    if not held[BUCKETS]:
        return Model()
    idf = np.log((1 + every[-1]) / (1 + every[:BUCKETS])).astype(np.float32) + np.float32(1)
    model = Model(list(labels.texts), idf)
    shards = -int(-held[:BUCKETS].sum() // shard_grams)
    weights, bias = _mixed_weights(_shards(labelled, labels, shards), shards, shard_grams, model)
    model.weights, model.bias = weights.astype(np.float32), bias.astype(np.float32)
    model.familiar = np.zeros((len(model.languages), BUCKETS), bool)
    for label, counts in frequencies.items():
        if label >= 0:
            model.familiar[label] = counts[:BUCKETS] > RARE * counts[BUCKETS]
    judged = _judged(labelled, labels, model)
    if 1 in judged:  # no losses with one language
        own, mean = (judged.get(at, np.zeros(1, np.int64))[:len(LOG_TEMPERATURES)] / FRACTION for at in (0, 1))
        model.temperature = least_temperature(own, mean, int(judged[2].sum()))
    if 2 in judged:
        model.most_strange = max(MOST_STRANGE, MARGIN * _quantile(judged[2], 0.99) / STRANGE_STEPS)
    return model


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): one row for each row, from its whole text alone.

    A null text, an empty one and one without letters are UNKNOWN with score 0.  A null doc_id
    is not held out.  Other columns are not read.
    """
    def work(batches):
        for batch in slices(batches):
            found = [model.predict(text.as_py()) for text in batch.column(2)]
            yield pa.RecordBatch.from_arrays([
                *batch.columns[:2], pa.array([lang for lang, _ in found], pa.string()),
                pa.array([score for _, score in found], pa.float64()),
            ], names=["doc_id", "held_out", "lang_pred", "score"])

    source = pick(docs, "doc_id", "text").select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(work, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows, all columns as they are, whose text is in a language that the model has learned.

    Null texts, texts without letters and texts too strange to their likeliest language go.
    """
    plain, names = numbered(docs)

    @F.arrow_udf(BooleanType())
    def known(texts: pa.Array) -> pa.Array:
        return pa.array([model.knows(text.as_py()) for text in texts], pa.bool_())

    return plain.filter(known(F.col(names["text"]))).toDF(*docs.columns)
