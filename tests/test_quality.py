"""Conformity with vocabularies of any size."""

import random

import pytest

from talentgrid import schemas, vocab
from talentgrid.operators import quality

FIRST, SECOND, THIRD = vocab.CATEGORIES[:3]


def posts(spark, rows):
    empty = {name: None for name in schemas.JOB_POST.fieldNames()}
    people = [empty | {"category": c, "skills_needed": s, "certifications": t} for c, s, t in rows]
    return spark.createDataFrame(people, schemas.JOB_POST)


def nobody(spark):
    return spark.createDataFrame([], schemas.CANDIDATE)


def judged(rows, known, at):
    """(passed, failed, unknown) by the rule's definition."""
    counts = [0, 0, 0]
    for row in rows:
        category, terms = row[0], row[at]
        if terms is None or category not in known:
            counts[2] += 1
        else:
            counts[not set(terms) <= set(known[category])] += 1
    return tuple(counts)


def found(report):
    return {
        (r.source, r.rule): (r.passed, r.failed, r.unknown) for r in report.collect() if r.rule in quality.LISTS.values()
    }


@pytest.mark.parametrize("shares", [5000, 3])
def test_lists_against_vocabularies(spark, monkeypatch, shares):
    monkeypatch.setattr(quality, "SHARES", shares)  # three: most terms are parted
    chance = random.Random(4)
    words = [f"w{k}" for k in range(8)]
    rows = [
        (
            chance.choice([FIRST, SECOND, THIRD, "elsewhere", None]),
            chance.choice([None, [], chance.choices([*words, None], k=chance.randint(1, 5))]),
            chance.choice([None, ["w0"] * chance.randint(0, 4)]),
        )
        for _ in range(600)
    ]
    skills = {FIRST: words, SECOND: words[:4], THIRD: []}
    certificates = {FIRST: ["w0"], SECOND: ["w1"]}
    table = spark.createDataFrame([(c, w) for c, many in skills.items() for w in many or [None]] * 2, "category string, term string")
    for given in (skills, table):
        report = quality.conformity_report(posts(spark, rows), nobody(spark), given, certificates)
        assert found(report) == {
            ("job_posts", "skills in vocabulary"): judged(rows, skills, 1),
            ("job_posts", "certificates in vocabulary"): judged(rows, certificates, 2),
            ("candidate_info", "skills in vocabulary"): (0, 0, 0), ("candidate_info", "certificates in vocabulary"): (0, 0, 0),
        }


def test_no_vocabulary_and_no_records(spark):
    none = posts(spark, [])
    assert set(found(quality.conformity_report(none, nobody(spark), {}, {})).values()) == {(0, 0, 0)}
    rows = [(FIRST, ["a"], []), (None, ["a"], None)]
    report = quality.conformity_report(posts(spark, rows), nobody(spark), {}, {FIRST: []})
    assert found(report)["job_posts", "skills in vocabulary"] == (0, 0, 2)
    assert found(report)["job_posts", "certificates in vocabulary"] == (1, 0, 1)


def test_the_vocabulary_is_never_one_array(spark):
    table = spark.range(1000).selectExpr(f"'{FIRST}' AS category", "concat('w', id) AS term")
    report = quality.conformity_report(posts(spark, [(FIRST, ["w5"], [])]), nobody(spark), table, table)
    text = report._jdf.queryExecution().toString()
    assert "collect_set" not in text and "collect_list" not in text and "LeftAnti" in text
    assert found(report)["job_posts", "skills in vocabulary"] == (1, 0, 0)
