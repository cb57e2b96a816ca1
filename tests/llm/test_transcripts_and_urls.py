"""Viterbi against all paths, roles of unseen transcripts, very long turns and urls, ties."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from talentgrid.llm import chat, packing, urls
from talentgrid.llm.frames import table
from talentgrid.llm.queries import URL_RULES


def likeliest(model, symbols):
    """The best path of all, the lowest last state, then the lowest before it, of equal ones."""
    paths = np.array(list(itertools.product(range(chat.STATES), repeat=len(symbols))))
    with np.errstate(invalid="ignore"):
        score = model.start[paths[:, 0]] + model.emit[paths[:, 0], symbols[0]]
        for k, seen in enumerate(symbols[1:], 1):
            score = score + model.step[paths[:, k - 1], paths[:, k]] + model.emit[paths[:, k], seen]
    best = paths[score >= score.max() - 1e-12]
    return min(best.tolist(), key=lambda path: path[::-1])


@pytest.mark.parametrize("levels", [None, 2])
def test_viterbi_equals_all_paths(levels):
    chance = np.random.default_rng(levels or 5)
    for size in (1, 2, 3, 4, 5):
        draw = (lambda shape: chance.integers(1, levels + 1, shape) / 4) if levels else chance.random  # two levels: many ties
        parts = (np.log(draw(s)) for s in ((chat.STATES,), (chat.STATES,) * 2, (chat.STATES, chat.SYMBOLS)))
        model, seen = chat.Model(*parts), chance.integers(0, chat.SYMBOLS, size)
        assert chat.decode(model, seen) == likeliest(model, seen)


@pytest.mark.parametrize("known,least", [(True, 0.96), (False, 0.85)])
def test_roles_of_transcripts_that_were_not_learned(spark, known, least):
    talk = table(spark, "/root/testdata/sf0.01", "conversations")
    lines = chat.transcripts(talk)
    model = chat.train(lines.filter("conv_id % 2 = 0"))
    odd = lines.filter("conv_id % 2 = 1")
    if not known:  # markers that the model has never seen: only lengths and blank lines are left
        odd = odd.withColumn("line", F.regexp_replace(chat.unmarked(F.col("line")), "^", ""))
    turns = {(r.conv_id, r.turn_no): r.role for r in chat.parse(odd, model).collect()}
    truth = talk.filter("conv_id % 2 = 1").collect()
    assert np.mean([turns.get((r.conv_id, r.turn)) == r.role for r in truth]) >= least


def test_one_very_long_turn(spark):
    lines = [(1, 0, 0, "User: hi"), (1, 0, 1, ""), (1, 1, 0, "Assistant: " + "word " * 200_000)]
    lines += [(1, 1, k, f"line {k} of the answer") for k in range(1, 30_000)] + [(1, 2, 0, ""), (1, 2, 1, "User: bye")]
    frame = spark.createDataFrame(lines, "conv_id long, part long, line_no long, line string")
    model = chat.train(chat.transcripts(table(spark, "/root/testdata/sf0.001", "conversations")))
    found = sorted((r.turn_no, r.role, r.n_lines, len(r.text)) for r in chat.parse(frame, model, 5).collect())
    assert [row[:2] for row in found] == [(0, "user"), (1, "assistant"), (2, "user")]
    assert found[1][2] == 30_001 and found[1][3] > 1_500_000  # with the blank line after it


def test_a_very_long_url(spark):
    long = "http://" + "a." * 50_000 + "example.org/es/" + "x/" * 50_000 + "?q=" + "y" * 100_000
    pages = spark.createDataFrame([(1, long), (2, "http://org/" + "z" * 500_000)], "page_id long, url string")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    found = {r.page_id: (r.rule, r.verdict, len(r.host), len(r.path)) for r in urls.verdicts(pages, rules).collect()}
    assert found == {1: ("example.org/es/", "block", 100_011, 100_004), 2: ("org/", "allow", 3, 500_001)}


def test_equal_plans_are_chosen_alike():
    chance = random.Random(2)
    for _ in range(50):
        places = [0]
        for _ in range(20):
            places.append(places[-1] + chance.randint(1, 4))
        penalties = [0] * len(places)
        assert packing.plan(places, penalties, 8) == packing.plan(list(places), list(penalties), 8)
