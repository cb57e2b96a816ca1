"""The registered queries: (spark, sf_dir) -> DataFrame, one per operator."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from harness import fixtures as fx
from talentgrid import schemas, vocab
from talentgrid.functions import draws, levels, scoring
from talentgrid.functions.lookup import literal_list, literal_table, lookup
from talentgrid.operators import enrich, families, kpi, loading, matching, mixes, paging, quality
from talentgrid.plans import applications as plans, tables
from talentgrid.sinks.places import new_folder, shared_folder
from talentgrid.sinks.tables import committed_batches, counted, csv_ready, read_committed, record_batches, write_csv
from talentgrid.sinks.topics import as_records
from talentgrid.sources.dimensions import dimensions
from talentgrid.sources.tables import create_table
from talentgrid.sources.topics import TopicSource, decode
from talentgrid.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return build(spark, sf_dir)

    QUERIES[build.__name__] = run
    return build


def _text(table: DataFrame, *columns: str) -> DataFrame:
    """Timestamps as text, so that both engines hand over the same value."""
    return table.withColumns({name: F.col(name).cast("string") for name in columns})


# -- matching ---------------------------------------------------------------


@query
def match_scores(spark, sf_dir):
    return matching.match_scores(fx.candidates(spark, sf_dir), fx.posts(spark, sf_dir))


@query
def match_scores_aliases(spark, sf_dir):
    options = matching.MatchOptions(rank_aliases=True)
    return matching.match_scores(fx.candidates(spark, sf_dir), fx.posts(spark, sf_dir), options)


@query
def match_within(spark, sf_dir):
    options = matching.MatchOptions(within=timedelta(hours=1))
    return matching.match_scores(fx.candidates(spark, sf_dir), fx.posts(spark, sf_dir), options)


def _by_rare_skills(spark, sf_dir, min_score):
    options = matching.MatchOptions(min_score=min_score, by_rare_skills=True)
    return matching.match_scores(fx.candidates(spark, sf_dir), fx.posts(spark, sf_dir), options)


@query
def match_at_70(spark, sf_dir):
    return _by_rare_skills(spark, sf_dir, 70)


@query
def match_at_85(spark, sf_dir):
    return _by_rare_skills(spark, sf_dir, 85)


@query
def match_reasons(spark, sf_dir):
    return matching.match_reasons(fx.candidates(spark, sf_dir), fx.posts(spark, sf_dir))


def _applications(spark, sf_dir, options=matching.DEFAULTS, coded=False):
    return matching.applications(fx.candidates(spark, sf_dir), fx.posts(spark, sf_dir), options, coded)


@query
def applications(spark, sf_dir):
    return _text(_applications(spark, sf_dir).drop("timestamp"), "application_date")


@query
def processing_time(spark, sf_dir):
    """All applications of one run carry the time of that run."""
    # counted by time first: a distinct count beside another one would make two rows of each application
    by_time = _applications(spark, sf_dir).groupBy("timestamp").agg(F.count("*").alias("n"))
    return by_time.agg(
        F.count("timestamp").alias("times"), F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("applications")
    )


@query
def applications_distinct_pairs(spark, sf_dir):
    found = _applications(spark, sf_dir, matching.MatchOptions(distinct_pairs=True))
    return _text(found.drop("timestamp"), "application_date")


@query
def status_by_tier(spark, sf_dir):
    tier = F.when(F.col("compatibility_score") >= 80, "80+").when(
        F.col("compatibility_score") >= 60, "60-79"
    ).otherwise("below 60")
    # counted by score and code first: a number costs less to group by than a text
    code, statuses = matching.codes()["status"]
    counts = _applications(spark, sf_dir, coded=True).groupBy("compatibility_score", code).agg(F.count("*").alias("n"))
    return (
        counts.withColumn("status", F.get(literal_list(statuses), F.col(code)))
        .groupBy(tier.alias("tier"), "status")
        .agg(F.sum("n").alias("n"))
    )


@query
def application_times(spark, sf_dir):
    # by code first: a number costs less to group by than a text
    per_code = (
        _applications(spark, sf_dir, coded=True)
        .groupBy("post_code")
        .agg(
            F.count("*").alias("n"),
            F.min("application_date").alias("first"),
            F.max("application_date").alias("last"),
        )
    )
    named = matching.post_codes(fx.candidates(spark, sf_dir), fx.posts(spark, sf_dir))
    per_post = (
        per_code.join(named, "post_code")
        .groupBy("post_id")
        .agg(
            F.sum("n").alias("applications"),
            F.min("first").alias("first_application"),
            F.max("last").alias("last_application"),
        )
    )
    return _text(per_post, "first_application", "last_application")


@query
def thinning_rate(spark, sf_dir):
    rows = matching.chances(fx.candidates(spark, sf_dir), fx.posts(spark, sf_dir))
    # by score first: a whole number costs less to group by than a fraction
    counts = rows.groupBy("compatibility_score").agg(
        F.sum("copies").alias("pairs"),
        F.sum(F.when(matching.should_apply(), F.col("copies")).otherwise(0)).alias("applied"),
    )
    tier = scoring.apply_probability(F.col("compatibility_score")).alias("apply_probability")
    return counts.groupBy(tier).agg(F.sum("pairs").alias("pairs"), F.sum("applied").alias("applied"))


@query
def family_fanout(spark, sf_dir):
    have = families.with_family(
        fx.candidates(spark, sf_dir).select("job_category"), "job_category", "family"
    )
    need = families.with_family(fx.posts(spark, sf_dir).select("category"), "category", "family")
    return (
        have.select(F.lit("candidate").alias("side"), "family", F.col("job_category").alias("category"))
        .unionAll(need.select(F.lit("post"), "family", "category"))
        .groupBy("side", "family", "category")
        .agg(F.count("*").alias("n"))
    )


@query
def family_pairs(spark, sf_dir):
    return families.family_pairs(fx.candidates(spark, sf_dir), fx.posts(spark, sf_dir))


# -- rules over columns -----------------------------------------------------


@query
def experience_parse(spark, sf_dir):
    rows = enrich.experience_columns(fx.candidates(spark, sf_dir), "experience_range")
    return rows.select("candidate_id", "experience_range", "min_years", "max_years")


@query
def max_years(spark, sf_dir):
    rows = enrich.experience_columns(fx.posts(spark, sf_dir), "years_experience")
    return rows.select("post_id", "years_experience", "most_years")


@query
def employer_range(spark, sf_dir):
    return enrich.employer_columns(fx.candidates(spark, sf_dir)).select(
        "candidate_id", "employers_min", "employers_max"
    )


@query
def seniority_from_title(spark, sf_dir):
    rows = enrich.title_columns(fx.candidates(spark, sf_dir), "current_title", "job_category")
    return rows.select("candidate_id", "current_title", "title_seniority")


@query
def level_from_title(spark, sf_dir):
    rows = enrich.title_columns(fx.posts(spark, sf_dir), "job_title", "category")
    return rows.select("post_id", "job_title", "title_level")


@query
def level_from_title_strict(spark, sf_dir):
    rows = enrich.title_columns(fx.posts(spark, sf_dir), "job_title", "category", strict_words=True)
    return rows.select("post_id", "job_title", "title_level")


@query
def seniority_rank(spark, sf_dir):
    rank = scoring.seniority_rank(F.col("detailed_experience_level"))
    aliased = scoring.seniority_rank(F.col("detailed_experience_level"), aliases=True)
    return fx.posts(spark, sf_dir).select(
        "post_id", rank.alias("rank"), aliased.alias("rank_with_aliases")
    )


@query
def salary_band(spark, sf_dir):
    rows = enrich.draw_salary(fx.posts(spark, sf_dir), "post_id", "detailed_experience_level")
    return rows.select("post_id", "band", "band_min", "band_max", "drawn_salary")


@query
def years_allowed(spark, sf_dir):
    texts = levels.years_texts(levels.salary_band_level(F.col("detailed_experience_level")))
    return fx.posts(spark, sf_dir).select(
        "post_id",
        F.array_join(texts, "|").alias("allowed_texts"),
        F.array_contains(texts, F.col("years_experience")).alias("allowed"),
    )


@query
def level_dimension_join(spark, sf_dir):
    """Chained lookups by join: level -> band, level -> class of years -> range texts."""
    dims = dimensions(spark)
    texts = dims["years_text"].groupBy("years_class").agg(F.count("*").alias("texts"))
    levels_known = (
        dims["salary_band"].join(dims["level_years"], "level").join(texts, "years_class").drop("ordinal")
    )
    rows = fx.posts(spark, sf_dir).withColumnRenamed("detailed_experience_level", "level")
    return (
        rows.join(F.broadcast(levels_known), "level", "left")
        .groupBy("level", "years_class", "texts", "min_salary", "max_salary")
        .agg(F.count("*").alias("posts"), F.count_if(F.col("salary") < F.col("min_salary")).alias("underpaid"))
    )


@query
def location_split(spark, sf_dir):
    return enrich.location_columns(fx.candidates(spark, sf_dir)).select("candidate_id", "city", "country")


@query
def employment_allowed(spark, sf_dir):
    rows = enrich.employment_allowed(
        fx.posts(spark, sf_dir), levels.seniority_from_title(F.col("job_title"))
    )
    return rows.select("post_id", "employment_type", "employment_ok")


@query
def language_allowed(spark, sf_dir):
    return enrich.language_allowed(fx.posts(spark, sf_dir)).select(
        "post_id", "country", "language", "language_ok"
    )


@query
def derived_years(spark, sf_dir):
    text = F.coalesce("experience_range", F.lit(""))
    rows = fx.candidates(spark, sf_dir).withColumn("text", text)
    return enrich.draw_years(rows, "candidate_id", "text").select(
        "candidate_id", "drawn_graduation", "drawn_birth"
    )


@query
def drawn_deadlines(spark, sf_dir):
    rows = enrich.draw_deadline(fx.posts(spark, sf_dir), "post_id", "post_date")
    return _text(rows, "drawn_deadline").select("post_id", "drawn_deadline")


@query
def drawn_employment(spark, sf_dir):
    return enrich.draw_employment(fx.posts(spark, sf_dir), "post_id", "job_title").select(
        "post_id", "drawn_employment"
    )


@query
def keyed_ids(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events")
    key = draws.keyed_id(F.col("event_id").cast("string"), F.col("event_type"))
    return events.select("event_id", key.alias("record_id"))


@query
def weighted_pick(spark, sf_dir):
    return enrich.draw_continent(fx.posts(spark, sf_dir), "post_id", "industry").select(
        "post_id", "industry", "drawn_continent"
    )


@query
def sample_without_repeats(spark, sf_dir):
    rows = enrich.sample_list(
        fx.posts(spark, sf_dir), "post_id", "skills_needed", F.lit(4), "sampled"
    )
    return rows.select("post_id", F.array_join("sampled", "|").alias("sampled"))


# -- mixes and conformity ---------------------------------------------------


@query
def education_mix(spark, sf_dir):
    return mixes.education_mix(fx.candidates(spark, sf_dir))


@query
def continent_mix(spark, sf_dir):
    return mixes.continent_mix(fx.posts(spark, sf_dir))


@query
def conformity_report(spark, sf_dir):
    rows = [(category, word) for category, words in fx.SKILL_VOCABULARY.items() for word in words]
    terms = literal_table(spark, ["category", "term"], rows)
    return quality.conformity_report(
        fx.posts(spark, sf_dir), fx.candidates(spark, sf_dir), terms, fx.CERT_VOCABULARY
    )


# -- indicators -------------------------------------------------------------


def _tables(spark, sf_dir):
    return fx.application_events(spark, sf_dir), fx.posts(spark, sf_dir), fx.candidates(spark, sf_dir)


@query
def kpi_totals(spark, sf_dir):
    return kpi.totals(*_tables(spark, sf_dir))


@query
def kpi_cards(spark, sf_dir):
    return kpi.cards(kpi.totals(*_tables(spark, sf_dir)))


@query
def kpi_totals_missing_columns(spark, sf_dir):
    found, posts, candidates = _tables(spark, sf_dir)
    return kpi.cards(kpi.totals(found.drop("compatibility_score", "status"), posts, candidates))


@query
def source_counts(spark, sf_dir):
    found, posts, candidates = _tables(spark, sf_dir)
    return kpi.source_counts(applications=found, job_posts=posts, candidates=candidates)


@query
def kpi_report(spark, sf_dir):
    return kpi.report(*_tables(spark, sf_dir))


@query
def kpi_report_of_match(spark, sf_dir):
    found = _applications(spark, sf_dir, coded=True)
    return kpi.report(found, fx.posts(spark, sf_dir), fx.candidates(spark, sf_dir), matching.codes())


@query
def apps_by_3h(spark, sf_dir):
    return kpi.by_time_band(fx.application_events(spark, sf_dir))


@query
def peak_band(spark, sf_dir):
    return kpi.peak_band(fx.application_events(spark, sf_dir))


@query
def top_families(spark, sf_dir):
    return kpi.top_families(fx.application_events(spark, sf_dir))


@query
def score_histogram(spark, sf_dir):
    return kpi.score_histogram(fx.application_events(spark, sf_dir))


@query
def status_share(spark, sf_dir):
    return kpi.value_shares(fx.application_events(spark, sf_dir), "status")


@query
def score_box(spark, sf_dir):
    return kpi.score_box(fx.application_events(spark, sf_dir))


@query
def work_mode_counts(spark, sf_dir):
    return kpi.value_counts(fx.posts(spark, sf_dir), "work_mode")


@query
def employment_share(spark, sf_dir):
    return kpi.value_shares(fx.posts(spark, sf_dir), "employment_type")


@query
def education_counts(spark, sf_dir):
    return kpi.value_counts(fx.candidates(spark, sf_dir), "education_level")


@query
def salary_histogram(spark, sf_dir):
    return kpi.salary_histogram(fx.posts(spark, sf_dir))


@query
def top_countries(spark, sf_dir):
    return kpi.top_countries(fx.posts(spark, sf_dir))


@query
def recent_applications(spark, sf_dir):
    return _text(kpi.recent(fx.application_events(spark, sf_dir)), "timestamp")


@query
def recent_applications_missing_columns(spark, sf_dir):
    found = fx.application_events(spark, sf_dir).drop("status", "application_method")
    return _text(kpi.recent(found), "timestamp")


@query
def sorted_page(spark, sf_dir):
    found = fx.application_events(spark, sf_dir)
    third = paging.page(found, "compatibility_score", "application_id", number=3, size=50, ascending=False)
    return third.select("application_id", "candidate_id", "post_id", "compatibility_score", "status")


@query
def page_count(spark, sf_dir):
    return paging.page_count(fx.application_events(spark, sf_dir), size=25)


@query
def page_by_index(spark, sf_dir):
    """The third and the last page by the stored index, with their rows' numbers."""
    path, size = new_folder(spark, "pages"), 50
    paging.write_page_index(fx.application_events(spark, sf_dir), "compatibility_score", "application_id", path, ascending=False)
    pages = []
    for number in (3, paging.indexed_pages(spark, path, size)):
        pages.append(paging.page_by_index(spark, path, number, size))
    return pages[0].unionAll(pages[1]).select("application_id", "compatibility_score", "status", "row")


@query
def numbered_pages(spark, sf_dir):
    shared_folder(spark)
    pages = paging.numbered_pages(fx.application_events(spark, sf_dir), "status", "application_id", size=25)
    return pages.select("application_id", "status", "compatibility_score", "row", "page")


# -- records in and out -----------------------------------------------------


@query
def decode_json(spark, sf_dir):
    payload = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("timestamp", T.TimestampType())])
    events = fx.table(spark, sf_dir, "events")
    records = events.select(
        F.col("props").cast("binary").alias("value"), F.col("ts").cast("timestamp").alias("timestamp")
    )
    return decode(records, payload).groupBy("k").agg(
        F.count("*").alias("n"), F.max("timestamp").cast("string").alias("latest")
    )


def topic_rows(rows: DataFrame, key: str, topic: str) -> DataFrame:
    """Rows as a topic holds them: JSON values under producer spelling, plus the envelope."""
    spelled = rows.withColumnsRenamed({column: name for name, column in schemas.PAYLOAD_ALIASES.items()})
    return as_records(spelled, key).select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.monotonically_increasing_id().alias("offset"),
        F.timestamp_seconds(F.lit(1704067200)).alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


@query
def json_roundtrip(spark, sf_dir):
    records = topic_rows(fx.candidates(spark, sf_dir), "candidate_id", vocab.CANDIDATE_TOPIC)
    rows = decode(records, schemas.CANDIDATE)
    return _text(rows, "timestamp").withColumns(
        {name: F.array_join(name, "|") for name in
         ("skills", "certifications", "previous_companies", "previous_industries")}
    )


@query
def json_roundtrip_posts(spark, sf_dir):
    records = topic_rows(fx.posts(spark, sf_dir).drop("continent"), "post_id", vocab.POST_TOPIC)
    rows = decode(records, schemas.JOB_POST)
    return _text(rows, "timestamp", "post_date", "deadline").withColumns(
        {name: F.array_join(name, "|") for name in ("skills_needed", "certifications")}
    )


@query
def table_definition(spark, sf_dir):
    """A table defined by the record schema, twice, filled and read back by its name."""
    path = new_folder(spark, "defined")
    name = f"posts_{path.rsplit('-', 1)[1]}"
    for _ in range(2):
        create_table(spark, name, schemas.JOB_POST, path)
    fx.posts(spark, sf_dir).select(*schemas.JOB_POST.fieldNames()).write.insertInto(name)
    return spark.table(name).select("post_id", "category", "salary", F.size("skills_needed").cast("bigint").alias("skills"))


@query
def table_load_dedup(spark, sf_dir):
    """Orders bring candidate records over and over; one market segment is loaded already."""
    customers = fx.table(spark, sf_dir, "customer")
    loaded = customers.filter(F.col("c_mktsegment") == "BUILDING").select(
        F.concat(F.lit("cand-"), F.col("c_custkey").cast("string")).alias("candidate_id")
    )
    incoming = fx.table(spark, sf_dir, "orders").select(
        F.concat(F.lit("cand-"), F.col("o_custkey").cast("string")).alias("candidate_id"),
        F.col("o_orderkey").alias("delivery"),
        F.col("o_orderdate").cast("timestamp").alias("delivered"),
        F.col("o_orderpriority").alias("source"),
    )
    fresh = loading.new_records(incoming, loaded, "candidate_id", "delivered", "delivery")
    return _text(fresh, "delivered")


@query
def csv_export(spark, sf_dir):
    rows = fx.posts(spark, sf_dir).drop("continent")
    path = new_folder(spark, "csv")
    write_csv(rows, path)
    names = ", ".join(f"`{item.name}` string" for item in csv_ready(rows).schema)
    back = spark.read.option("header", True).option("escape", '"').schema(names).csv(path)
    return back


def numbered_records(spark, sf_dir) -> DataFrame:
    """Candidate records as a topic of three partitions; the offset is the number in the id."""
    number = F.regexp_extract("candidate_id", r"(\d+)$", 1).cast("bigint")
    rows = fx.candidates(spark, sf_dir)
    records = topic_rows(rows.withColumn("number", number), "number", vocab.CANDIDATE_TOPIC)
    number = F.col("key").cast("string").cast("bigint")
    return records.withColumns({"partition": (number % 3).cast("int"), "offset": number})


@query
def topic_snapshot(spark, sf_dir):
    """Two scans of a snapshot, with all records delivered once more at higher offsets between them."""
    root = new_folder(spark, "topics")
    records = numbered_records(spark, sf_dir)
    source = TopicSource(format="parquet", root=root)

    def deliver(rows):
        rows.write.mode("append").parquet(f"{root}/{vocab.CANDIDATE_TOPIC}")

    deliver(records)
    held = source.snapshot(spark, vocab.CANDIDATE_TOPIC, limit=600)
    before = held.read(spark)
    deliver(records.withColumn("offset", F.col("offset") + 100_000_000))
    scans = before.withColumn("scan", F.lit(1)).unionAll(held.read(spark).withColumn("scan", F.lit(2)))
    return scans.groupBy("scan", "partition").agg(
        F.count("*").alias("records"), F.min("offset").alias("first"), F.max("offset").alias("last")
    )


@query
def rejected_records(spark, sf_dir):
    """Candidate records, some cut short, some with an unfit field, some without a value: both outputs of one batch."""
    root, out = new_folder(spark, "topics"), new_folder(spark, "parsed")
    text, number = F.col("value").cast("string"), F.col("offset")
    value = (
        F.when(number % 11 == 0, F.left(text, F.length(text) - 1))
        .when(number % 13 == 0, F.concat(F.lit('{"graduation_year":"soon",'), F.substring(text, 2, 1 << 20)))
        .when(number % 17 == 0, F.lit("[]"))
        .when(number % 19 == 0, F.lit(None))
        .otherwise(text)
    )
    records = numbered_records(spark, sf_dir).withColumn("value", value.cast("binary"))
    records.repartition(3, "offset").write.parquet(f"{root}/{vocab.CANDIDATE_TOPIC}")
    own = jobs.stream_session(spark, STREAM_PARTITIONS)
    stream = TopicSource(format="parquet", root=root, options={"maxFilesPerTrigger": "2"}).stream(own, vocab.CANDIDATE_TOPIC)
    running = jobs.start_outputs(
        stream, f"{out}/checkpoint", tables.decoded(committed_batches(f"{out}/rows"), schemas.CANDIDATE),
        tables.rejected(committed_batches(f"{out}/rejects"), schemas.CANDIDATE), trigger={"availableNow": True},
    )
    running.awaitTermination()
    named = F.when(F.col("candidate_id").isNull(), "row of NULLs").otherwise("row")
    rows = read_committed(spark, f"{out}/rows", schemas.CANDIDATE).select(named.alias("outcome"), F.lit(None).cast("bigint").alias("at"))
    bad = read_committed(spark, f"{out}/rejects").select(F.col("reason").alias("outcome"), F.col("offset").alias("at"))
    return rows.unionAll(bad).groupBy("outcome").agg(F.count("*").alias("records"), F.sum("at").alias("offsets"))


# -- streams ----------------------------------------------------------------

STREAM_PARTITIONS = 8


@query
def stream_match(spark, sf_dir):
    """The match as a stream over topic files, several micro-batches, read back as a table."""
    root, out = new_folder(spark, "topics"), new_folder(spark, "applications")
    topics = {
        vocab.CANDIDATE_TOPIC: (fx.candidates(spark, sf_dir), "candidate_id"),
        vocab.POST_TOPIC: (fx.posts(spark, sf_dir).drop("continent"), "post_id"),
    }
    for topic, (rows, key) in topics.items():
        topic_rows(rows, key, topic).repartition(3, "key").write.parquet(f"{root}/{topic}")
    own = jobs.stream_session(spark, STREAM_PARTITIONS)
    source = TopicSource(format="parquet", root=root, options={"maxFilesPerTrigger": "2"})
    running = jobs.start_outputs(
        plans.stream_applications(own, source, checkpoint=f"{out}/checkpoint"),
        f"{out}/checkpoint",
        committed_batches(f"{out}/table"),
        trigger={"availableNow": True},
    )
    running.awaitTermination()
    table = read_committed(spark, f"{out}/table", schemas.APPLICATION)
    return _text(table.drop("timestamp", "batch_id"), "application_date")


@query
def stream_table_load(spark, sf_dir):
    """Candidate records, each delivered three times over several micro-batches, as a table."""
    root, out = new_folder(spark, "topics"), new_folder(spark, "candidates")
    rows = fx.candidates(spark, sf_dir)
    records = topic_rows(rows, "candidate_id", vocab.CANDIDATE_TOPIC)
    for _ in range(3):
        records.repartition(2, "key").write.mode("append").parquet(f"{root}/{vocab.CANDIDATE_TOPIC}")
    own = jobs.stream_session(spark, STREAM_PARTITIONS)
    source = TopicSource(format="parquet", root=root, options={"maxFilesPerTrigger": "2"})
    sizes = []
    running = tables.start_table_load(
        own, source, vocab.CANDIDATE_TOPIC, schemas.CANDIDATE, "candidate_id", f"{out}/table",
        f"{out}/checkpoint", counted(record_batches(f"{out}/records"), lambda batch, n: sizes.append(n)),
        trigger={"availableNow": True},
    )
    running.awaitTermination()
    loaded = read_committed(spark, f"{out}/table", schemas.CANDIDATE)
    delivered = F.lit(sum(sizes)).cast("bigint").alias("delivered")
    return _text(loaded, "timestamp").select("candidate_id", "name", "seniority", "timestamp", delivered)


@query
def stream_kpi(spark, sf_dir):
    """The counted indicators of an application stream, after its last refresh."""
    named = {"total_applications": "applications", "time_band": "time_band", "score_bin": "score_bin", "status": "status"}
    tally, found = _streamed_tally(spark, sf_dir)
    families = tally.filter("kind = 'job_family' AND key IS NOT NULL").select(F.lit("job_family").alias("kpi"), "key", "n")
    kpi = lookup(named, F.col("indicator"))
    return found.select(kpi.alias("kpi"), "key", "n").filter("kpi IS NOT NULL").unionAll(families)


@query
def stream_indicators(spark, sf_dir):
    """All indicators of an application stream: totals, mean, shares, histogram, boxes, bands, families."""
    return _streamed_tally(spark, sf_dir)[1]


def _streamed_tally(spark, sf_dir):
    """Counts and indicators of an application stream after several refreshes and a merge."""
    root, out = new_folder(spark, "topics"), new_folder(spark, "indicators")
    rows = fx.application_events(spark, sf_dir)
    topic_rows(rows, "application_id", vocab.APPLICATION_TOPIC).repartition(3, "key").write.parquet(
        f"{root}/{vocab.APPLICATION_TOPIC}"
    )
    own = jobs.stream_session(spark, STREAM_PARTITIONS)
    source = TopicSource(format="parquet", root=root, options={"maxFilesPerTrigger": "1"})
    stream = decode(source.stream(own, vocab.APPLICATION_TOPIC), schemas.APPLICATION)
    running = jobs.start_indicators(
        stream, f"{out}/table", f"{out}/checkpoint", trigger={"availableNow": True}, merge_every=2
    )
    running.awaitTermination()
    return jobs.read_tally(spark, f"{out}/table"), jobs.read_indicators(spark, f"{out}/table")
