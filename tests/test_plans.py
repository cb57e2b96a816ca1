"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from harness import fixtures as fx
from harness.queries import QUERIES
from talentgrid import vocab
from talentgrid.functions import scoring
from talentgrid.operators import kpi, matching
from talentgrid.operators.families import with_family

STREAMS = {"stream_match", "stream_kpi", "stream_indicators"}
#: rows that are counted by task and then numbered must stay in their tasks, so they are a checkpoint
CHECKPOINTED = {"numbered_pages"}
BATCH = [name for name in QUERIES if name not in STREAMS]


def plan(frame):
    return frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.mark.parametrize("name", BATCH)
def test_no_python_and_no_pairing_without_a_key(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for operator in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text
    assert "ExistingRDD" not in text or name in CHECKPOINTED


def test_scans_read_the_columns_they_need(spark, tmp_path):
    fx.posts(spark, "/root/testdata/sf0.001").write.parquet(str(tmp_path / "posts"))
    posts = spark.read.parquet(str(tmp_path / "posts"))
    text = plan(kpi.salary_histogram(posts))
    assert set(re.findall(r"ReadSchema: (.*)", text)) == {"struct<salary:double>"}
    assert "GreaterThan(salary,0.0)" in text
    schema = re.findall(r"ReadSchema: (.*)", plan(matching.prepare_posts(posts)))[0]
    assert "industry" not in schema and "skills_needed" in schema
    assert re.search(r"PushedFilters: \[.*In\(category", plan(matching.prepare_posts(posts)))


def test_pair_join_has_its_own_width_and_no_second_shuffle(spark, sf_dir):
    c, p = fx.candidates(spark, sf_dir), fx.posts(spark, sf_dir)
    options = matching.MatchOptions(partitions=13)
    text = plan(matching.score_pairs(c, p, options))
    placed = re.findall(r"hashpartitioning\(category#\d+, c_block#\d+, p_block#\d+, (\d+)\), (\w+)", text)
    assert placed == [("13", "REPARTITION_BY_NUM")] * 2
    assert "SortMergeJoin" in text


def test_a_pair_is_a_step_of_a_loop_and_scored_once(spark, sf_dir):
    c, p = fx.candidates(spark, sf_dir), fx.posts(spark, sf_dir)
    applied = matching.chances(c, p).filter(matching.should_apply())
    text = plan(applied.groupBy("apply_probability", "job_post_family_group").count())
    assert text.count(f"* {float(vocab.SALARY_ABOVE[0])})") == 1
    nodes = re.findall(r"^[-+: ]*(?:\*\(\d+\) )?(\w+)", text.split("\n\n")[0], re.M)
    loop = nodes.index("Generate")
    # joins with families and skill terms take a row for each candidate and cell, so they come before the loop
    assert "SortMergeJoin" in nodes[loop:] and not any("Join" in node for node in nodes[:loop])


def test_a_moment_asks_no_rules_of_a_zone_without_any(spark):
    days = spark.range(0, 400).select(
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("posted_on"),
        (F.col("id") % 30).cast("int").alias("day"), (F.col("id") % 17 / 17).alias("draw"),
    )
    moments = lambda: days.select(
        scoring.application_moment(F.col("posted_on"), F.col("day"), F.col("draw")).alias("moment"),
        F.timestamp_seconds(
            F.unix_seconds(F.date_add("posted_on", F.col("day")).cast("timestamp")) + (F.col("draw") * 86400).cast("int")
        ).alias("wanted"),
    )
    assert "as timestamp" not in plan(moments().select("moment"))
    for zone in ("UTC", "Europe/Berlin", "Asia/Kolkata"):  # the first and the last have no summer time
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert moments().filter(~F.col("moment").eqNullSafe(F.col("wanted"))).count() == 0
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_tally_counts_applications_before_it_parts_them_by_indicator(spark, sf_dir):
    nodes = plan(kpi.application_tally(fx.application_events(spark, sf_dir))).split("\n\n")[0]
    assert "HashAggregate" in nodes.split("Generate")[1]


def test_mapping_is_broadcast(spark, sf_dir):
    text = plan(with_family(fx.candidates(spark, sf_dir), "job_category", "family"))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_top_k_is_not_a_full_sort(spark, sf_dir):
    applications = fx.application_events(spark, sf_dir)
    for frame in (kpi.recent(applications), kpi.top_families(applications)):
        assert "TakeOrderedAndProject" in plan(frame)


def test_term_ranking_limits_groups_before_the_shuffle(spark, sf_dir):
    terms = matching.skill_terms(matching.prepare_posts(fx.posts(spark, sf_dir)))
    assert "WindowGroupLimit" in plan(terms)


def test_pair_loop_stays_small_enough_to_be_compiled(spark, sf_dir):
    """The JVM interprets methods beyond 8000 bytes of code, which costs a factor of five."""
    c, p = fx.candidates(spark, sf_dir), fx.posts(spark, sf_dir)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        stages = matching.applications(c, p)._jdf.queryExecution().debug().codegenToSeq()
        sizes = [stages.apply(at)._3().maxMethodCodeSize() for at in range(stages.size())]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(sizes) < 7000
