"""Time the headline operators and print one JSON line.

Inputs are the job-market tables projected from ``$BENCH_SF_DIR``, stored as Parquet
once (not timed), as a user's tables would be.  Each operator is built and run to a
sink that discards its rows: one warm-up, then the median of three runs.

``--udf`` times the match with a Python UDF for the score instead, on the same tables.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from datetime import timedelta

from harness import fixtures as fx
from harness.session import local_session
from talentgrid.operators import kpi, loading, matching, mixes, paging, quality
from talentgrid.sinks.places import new_folder

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def stored(spark, sf_dir):
    """(applications, posts, candidates) as Parquet tables."""
    folder = new_folder(spark, "bench")
    out = []
    for build in (fx.application_events, fx.posts, fx.candidates):
        path = f"{folder}/{build.__name__}"
        build(spark, sf_dir).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def operators(spark, a, p, c):
    orders = fx.table(spark, SF_DIR, "orders").selectExpr(
        "concat('cand-', o_custkey) AS candidate_id", "o_orderkey AS delivery", "o_orderdate AS delivered"
    )
    loaded = c.filter("gender = 'male'").select("candidate_id")
    return {
        "match_scores": lambda: matching.match_scores(c, p),
        "match_within": lambda: matching.match_scores(c, p, matching.MatchOptions(within=timedelta(hours=1))),
        "match_reasons": lambda: matching.match_reasons(c, p),
        "applications": lambda: matching.applications(c, p),
        "kpi_report_of_match": lambda: kpi.report(matching.applications(c, p), p, c),
        "kpi_totals": lambda: kpi.totals(a, p, c),
        "kpi_report": lambda: kpi.report(a, p, c),
        "apps_by_3h": lambda: kpi.by_time_band(a),
        "top_families": lambda: kpi.top_families(a),
        "score_histogram": lambda: kpi.score_histogram(a),
        "score_box": lambda: kpi.score_box(a),
        "status_share": lambda: kpi.value_shares(a, "status"),
        "salary_histogram": lambda: kpi.salary_histogram(p),
        "recent_applications": lambda: kpi.recent(a),
        "sorted_page": lambda: paging.page(a, "compatibility_score", "application_id", 3, 50, False),
        "education_mix": lambda: mixes.education_mix(c),
        "continent_mix": lambda: mixes.continent_mix(p),
        "conformity_report": lambda: quality.conformity_report(p, c, fx.SKILL_VOCABULARY, fx.CERT_VOCABULARY),
        "table_load_dedup": lambda: loading.new_records(orders, loaded, "candidate_id", "delivered", "delivery"),
    }


def seconds(build) -> float:
    start = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = local_session("bench")
    a, p, c = stored(spark, SF_DIR)
    if "--udf" in sys.argv:
        from harness.udf_form import match_scores

        pairs = matching.match_scores(c, p).count()
        took = seconds(lambda: match_scores(c, p))
        print(json.dumps({"metric": "udf_match", "value": round(took, 2), "unit": "sec", "pairs": pairs, "sf": SF_DIR}))
        return
    took = {}
    for name, build in operators(spark, a, p, c).items():
        seconds(build)
        took[name] = round(statistics.median(seconds(build) for _ in range(RUNS)), 3)
    scale = os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(took.values()), 3), "unit": "sec",
        "queries": took, "sf": float(scale), "cpus": os.environ.get("BENCH_CPUS", "8"),
    }))


if __name__ == "__main__":
    main()
