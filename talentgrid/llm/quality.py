"""Quality rules: text statistics and an importance score, from built-in expressions only.

The score compares two multinomials over hashed word unigrams and bigrams: the trusted target
(documents labelled good) and the raw corpus (all documents).  A document's score is the mean over
its n-grams of log(p_target / p_raw), so length doesn't matter; below a fixed threshold it is
rejected.  N-grams fall into BUCKETS places by hash, which bounds the model: its log ratios
are one array, read by every row.  Counts are summed per task before they are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talentgrid.llm.frames import checkpointed, join_unique, numbered, pick

#: Places of the hashed n-grams.
BUCKETS = 1 << 17
#: Bits of the sieve of trusted ids: with as many ids a fraction 1 - 1/e of the other texts moves for nothing, which costs
#: time only.
SIEVE_BITS = 24
#: Least mean log ratio of a document that is kept.
THRESHOLD = -0.2
#: Added to the found and to the expected count of a bucket, so that rare ones say little.
SMOOTHING = 4.0
#: Words of a window, least words of a document, highest share of repeated words in percent.
WINDOW, LEAST_WORDS, MOST_REPEATED = 8, 20, 30
WHITE_SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"


def words_of(text: Column) -> Column:
    """The words of a text; none if it is null."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), WHITE_SPACE), lambda word: word != "")
    return words


def shifted(values: Column, by: int) -> Column:
    return F.slice(values, F.lit(by + 1), F.greatest(F.size(values) - by, F.lit(0)))


def joined(values: Column, by: int) -> Column:
    """Hashes of each value with the one ``by`` places on, as long as there is one."""
    first = F.slice(values, F.lit(1), F.greatest(F.size(values) - by, F.lit(0)))
    return F.zip_with(first, shifted(values, by), lambda a, b: F.xxhash64(a, b))


def with_hashes(texts: DataFrame, text: str) -> DataFrame:
    """Adds hashes of the words (one) and of neighbouring words (two) to the table."""
    hashed = texts.withColumn("one", F.transform(words_of(F.col(text)), lambda word: F.xxhash64(word)))
    return hashed.withColumn("two", joined(F.col("one"), 1))


def bucket(value: Column) -> Column:
    return F.pmod(value, F.lit(BUCKETS)).cast("int")


def _place(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(1 << SIEVE_BITS))


def sieve(ids: DataFrame) -> DataFrame:
    """One row: a bit for each hash of an id (doc_id), 64 in a number; its size depends on SIEVE_BITS only."""
    words = 1 << (SIEVE_BITS - 6)
    place = ids.select(_place(F.col("doc_id")).alias("place"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("place", F.lit(64)).cast("int"))
    found = place.select(F.shiftright("place", 6).alias("word"), bit.alias("bits"))
    every = ids.sparkSession.range(words).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("bits"))
    marked = found.union(every).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    listed = marked.agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("marks"))
    return listed.select(F.col("marks.bits").alias("sieve"))


def sifted(doc_id: Column, marks: Column) -> Column:
    """False for ids that are surely not among those of the sieve, NULL for a null id."""
    place = _place(doc_id)
    word = F.get(marks, F.shiftright(place, 6).cast("int"))
    return doc_id.isNotNull() & (F.call_function("shiftrightunsigned", word, F.pmod(place, F.lit(64)).cast("int")).bitwiseAND(1) == 1)


def log_ratios(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row: ``ratios``, for each bucket the log of its target share over its raw share.

    The target holds all documents labelled quality 1 and not toxic, the raw counts all documents.  A bucket that
    is as frequent in both, or in neither, has ratio 0; without a target all have.
    """
    trusted = pick(labels, "doc_id", "quality", "toxic").filter(
        "quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null"
    ).select("doc_id").distinct()
    texts = pick(docs, "doc_id", "text")

    def counted(rows: DataFrame, name: str) -> DataFrame:
        grams = with_hashes(rows.select("text"), "text").select(F.explode(F.concat("one", "two")).alias("gram"))
        found = grams.groupBy(bucket(F.col("gram")).alias("bucket")).agg(F.count(F.lit(1)).alias(name))
        return found.select("bucket", *[
            (F.col(name) if name == other else F.lit(0).cast("bigint")).alias(other) for other in ("raw", "target")
        ])

    none = F.lit(0).cast("bigint")
    every = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"), none.alias("raw"), none.alias("target"))
    # the corpus is counted where it lies; only texts that the sieve lets through move to meet their labels
    likely = texts.withColumn("sieve", sieve(trusted).scalar()).filter(sifted(F.col("doc_id"), F.col("sieve"))).drop("sieve")
    chosen = join_unique(likely, trusted, "doc_id", hint="shuffle_hash")
    counts = checkpointed(
        counted(texts, "raw").union(counted(chosen, "target")).union(every)
        .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    )
    totals = counts.agg(F.sum("raw").alias("raws"), F.sum("target").alias("targets"))
    expected = F.col("raw") * F.col("targets") / F.greatest("raws", F.lit(1))
    ratio = F.log((F.col("target") + SMOOTHING) / (expected + SMOOTHING))
    # both sides are bounded: one row of totals, BUCKETS rows of counts
    rows = counts.withColumns({
        "raws": totals.select("raws").scalar(), "targets": totals.select("targets").scalar()
    }).select("bucket", ratio.cast("float").alias("ratio"))
    listed = rows.agg(F.sort_array(F.collect_list(F.struct("bucket", "ratio"))).alias("pairs"))
    return listed.select(F.col("pairs.ratio").alias("ratios"))


def _repeated_words(eight: Column) -> Column:
    """Words that lie in windows found twice or more, from the hashes of all windows."""
    places = F.sequence(F.lit(0), F.size(eight) - 1)
    ordered = F.sort_array(F.zip_with(eight, places, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    before = F.slice(ordered, F.lit(1), F.size(ordered) - 1)
    twins = F.zip_with(
        before, shifted(ordered, 1),
        lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")),
    )
    starts = F.sort_array(F.array_distinct(F.flatten(twins)))
    covered = F.aggregate(
        starts, F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n")),
        lambda acc, start: F.struct(
            (start + WINDOW).alias("end"),
            (acc["n"] + (start + WINDOW - F.greatest(start, acc["end"]))).alias("n"),
        ),
        lambda acc: acc["n"],
    )
    repeats = (F.size(eight) > 1) & (F.size(F.array_distinct(eight)) < F.size(eight))
    return F.when(repeats, covered).otherwise(F.lit(0).cast("bigint"))


def judged(docs: DataFrame, ratios: DataFrame, text: str) -> DataFrame:
    """Adds the statistics, score and verdict of column ``text`` to each row of the table.

    New columns: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score,
    kept, and row, a number.  A null text counts as empty; a text without words has score 0 and fails.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    length = lambda value: F.char_length(value).cast("bigint")
    grams = F.concat("one", "two")
    total = F.aggregate(
        grams, F.lit(0.0), lambda acc, gram: acc + F.get(F.col("ratios"), bucket(gram)).cast("double")
    )
    hashed = with_hashes(docs, text)
    hashed = hashed.withColumn("four", joined(F.col("two"), 2))
    hashed = hashed.withColumn("eight", joined(F.col("four"), 4))
    # the array comes in last: rows that carry it are not copied again
    return hashed.withColumn("ratios", ratios.scalar()).withColumns({
        "n_words": F.size("one").cast("bigint"),
        "word_chars": length(F.translate(whole, " \t\n\x0b\x0c\r", "")),
        "n_symbols": length(whole) - length(F.translate(whole, SYMBOLS, "")),
        "lines": lines,
        "n_repeat_words": _repeated_words(F.col("eight")),
        "score": F.when(F.size("one") > 0, total / F.size(grams)).otherwise(0.0),
        "row": F.monotonically_increasing_id(),
    }).withColumns({
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint"),
        "base_failed": (F.col("n_words") < LEAST_WORDS)
        | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")),
    }).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= THRESHOLD)).drop(
        "ratios", "one", "two", "four", "eight", "lines"
    )


def verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id and the columns of ``judged`` for every document; repeated rows stay."""
    return judged(pick(docs, "doc_id", "text"), log_ratios(docs, labels), "text").drop("text", "row")


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that are kept, all columns as they are."""
    plain, names = numbered(docs)
    found = judged(plain, log_ratios(docs, labels), names["text"])
    # the row number keeps the optimiser from working out the verdict twice, for filter and columns
    return found.filter(F.col("kept") & (F.col("row") >= 0)).select(*plain.columns).toDF(*docs.columns)
