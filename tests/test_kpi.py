"""Indicators on empty and degenerate tables."""

import datetime as dt

from talentgrid import schemas
from talentgrid.operators import kpi, paging
from talentgrid.plans.dashboard import dashboard


def rows_of(frame):
    return [tuple(row) for row in frame.collect()]


def empty(spark, schema):
    return spark.createDataFrame([], schema)


def applications(spark, *rows):
    names = [item.name for item in schemas.APPLICATION]
    return spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], schemas.APPLICATION)


def test_dashboard_of_empty_tables(spark):
    a, p, c = (empty(spark, s) for s in (schemas.APPLICATION, schemas.JOB_POST, schemas.CANDIDATE))
    out = dashboard(a, p, c)
    assert dict(rows_of(out.pop("cards"))) == {
        "Total Applications": "0", "Active Job Posts": "0", "Active Candidates": "0", "Avg Match Score": "N/A",
        "Shortlisted": "0"}
    assert rows_of(out.pop("totals"))[0] == (0, None, 0, 0, 0)
    assert {row[1] for row in rows_of(out.pop("sources"))} == {0}
    assert len(out) == 12 and all(frame.count() == 0 for frame in out.values())


def test_dashboard_leaves_out_what_it_cannot_count(spark):
    a, p, c = (empty(spark, s) for s in (schemas.APPLICATION, schemas.JOB_POST, schemas.CANDIDATE))
    out = dashboard(a.drop("status"), p.drop("salary"), c)
    assert not {"status_shares", "score_box", "salary_histogram"} & set(out) and "score_histogram" in out


def test_histogram_edges(spark):
    a = applications(spark, *[dict(compatibility_score=s) for s in (0, 4, 5, 95, 99, 100, None)])
    assert sorted((r[0], r[3]) for r in rows_of(kpi.score_histogram(a))) == [(0, 2), (1, 1), (19, 3)]


def test_salary_histogram_of_one_value(spark):
    p = spark.createDataFrame([(50.0,), (50.0,), (0.0,), (None,)], "salary double")
    assert rows_of(kpi.salary_histogram(p)) == [(0, 50.0, 50.0, 2)]


def test_salary_histogram_adds_up(spark):
    p = spark.range(1000).selectExpr("cast(id * id % 977 as double) as salary")
    rows = rows_of(kpi.salary_histogram(p))
    assert sum(r[3] for r in rows) == p.filter("salary > 0").count() and len(rows) == 30


def test_box_with_outlier(spark):
    scores = [50, 51, 52, 53, 54, 99]
    a = applications(spark, *[dict(status="Applied", compatibility_score=s) for s in scores], dict(status=None, compatibility_score=1))
    assert rows_of(kpi.score_box(a)) == [("Applied", 6, 50, 51.25, 52.5, 53.75, 99, 50, 54, 1)]


def test_shares_and_ties(spark):
    frame = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "k string")
    assert sorted(rows_of(kpi.value_shares(frame, "k"))) == [("a", 1, 25.0), ("b", 1, 25.0), ("c", 2, 50.0)]
    assert rows_of(kpi.top_values(frame, "k", 2)) == [("c", 2), ("a", 1)]


def test_peak_band_tie_goes_to_the_earlier_band(spark):
    hours = [22, 1, 13]
    a = applications(spark, *[dict(application_date=dt.datetime(2024, 1, 1, h)) for h in hours])
    assert rows_of(kpi.peak_band(a)) == [(0, "12:00 AM - 3:00 AM", 1)]


def test_pages_cover_the_table_once(spark):
    frame = spark.range(57).selectExpr("id", "id % 5 as v", "if(id % 7 = 0, null, id % 3) as w")
    pages = rows_of(paging.page_count(frame, 10))[0][1]
    assert pages == 6
    seen = [r for n in range(1, pages + 1) for r in rows_of(paging.page(frame, "w", "id", n, 10, ascending=False))]
    assert seen == rows_of(paging.sort_rows(frame, "w", False, "id")) and len(seen) == 57
    numbered = rows_of(paging.numbered_pages(frame, "v", "id", size=10))
    assert [r[-2:] for r in numbered] == [(i + 1, i // 10 + 1) for i in range(57)]


def test_report_agrees_with_single_indicators(spark, sf_dir):
    from harness import fixtures as fx

    a, p, c = fx.application_events(spark, sf_dir), fx.posts(spark, sf_dir), fx.candidates(spark, sf_dir)
    report = {}
    for name, key, n in rows_of(kpi.report(a, p, c)):
        report.setdefault(name, {})[key] = n
    assert report["status"] == dict(rows_of(kpi.value_counts(a, "status")))
    assert report["education_level"] == dict(rows_of(kpi.value_counts(c, "education_level")))
    assert sum(report["score_bin"].values()) == report["applications"]["all"] == a.count()
