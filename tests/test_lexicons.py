"""Lexicons held in tables, mentions over partly labelled tables, and boards of unequal suites."""

import random

import pytest
from pyspark.sql import functions as F

from plimsoll.functions import runs as R
from plimsoll.operators import battery as B
from plimsoll.operators import profile

TERMS = [("g", "red"), ("g", "Blue  Sky"), ("g", "blue sky"), ("h", "blue sky"), ("h", "sky blue sky"), ("h", "..."),
         ("i", None), ("i", "été à la"), ("j", "nowhere"), ("k", "a b c d e f")]
TEXTS = [(1, "A RED, blue sky!"), (2, "blue-sky blue"), (3, "sky blue sky blue sky"), (4, None), (5, ""), (6, "Été à la mer"),
         (7, "reddish bluesky"), (8, "x a b c d e f"), (None, "red"), (9, "a b c d e"), (9, "red red")]


def brute(texts, terms):
    words = lambda t: "".join(c.lower() if c.isalnum() or c == "_" else " " for c in t or "").split()
    out = set()
    for key, text in texts:
        w = words(text)
        for group, term in terms:
            t = words(term)
            if t and any(w[i:i + len(t)] == t for i in range(len(w) - len(t) + 1)):
                out.add((key, group))
    return out


@pytest.mark.parametrize("together", [1 << 22, 16])
def test_phrases_of_a_table(spark, monkeypatch, together):
    monkeypatch.setattr(R, "TOGETHER", together)
    texts = spark.createDataFrame(TEXTS, "id int, text string").withColumn("run", F.lit("clash")).repartition(2)
    terms = spark.createDataFrame(TERMS, "group_name string, term string")
    got = profile.term_mentions(texts, terms).collect()
    assert len(got) == len(set(map(tuple, got))) and set(map(tuple, got)) == brute(TEXTS, TERMS)
    assert profile.term_mentions(texts, terms.where("false")).count() == 0
    assert profile.term_mentions(texts.where("false"), terms).count() == 0


def test_many_phrases(spark):
    rng = random.Random(4)
    line = lambda n: " ".join(rng.choice("a b c d é".split()) for _ in range(n))
    texts = [(i, line(rng.randint(0, 80))) for i in range(150)]
    terms = [(f"g{i % 7}", line(rng.randint(1, 6))) for i in range(90)]
    got = profile.term_mentions(spark.createDataFrame(texts, "id int, text string").repartition(4),
                                spark.createDataFrame(terms, "group_name string, term string"))
    assert set(map(tuple, got.collect())) == brute(texts, terms)


def test_mentions_count_unlabelled_rows(spark):
    rows = [(True, 1), (True, 0), (True, None), (False, None), (False, 1)]
    got = profile.group_mentions(spark.createDataFrame(rows, "g_x boolean, y_t int"), ["x"], ["t"]).first()
    assert got.asDict() == pytest.approx({"group_name": "x", "mentions": 3, "pct_of_corpus": 60.0, "t_rate_pct": 50.0,
                                          "t_base_pct": 100 * 2 / 3})


def test_board_keeps_suites_of_one_control(spark):
    cols = "suite string, n_cases long, should_flag boolean, passes long, pass_rate_pct double"
    ours = spark.createDataFrame([("a", 2, True, 1, 50.0), ("b", 4, False, 4, 100.0)], cols)
    theirs = spark.createDataFrame([("b", 4, False, 2, 50.0), ("c", 1, True, 0, 0.0)], cols)
    assert [tuple(r) for r in B.control_board(ours, theirs).collect()] == [
        ("a", True, 2, 50.0, None), ("b", False, 4, 100.0, 50.0), ("c", True, 1, None, 0.0)]
