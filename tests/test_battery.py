"""Battery expansion, scoring and gates."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plimsoll import dimensions as D
from plimsoll.functions import runs as R
from plimsoll.operators import battery as B
from plimsoll.sources.suites import parse_suites

LABELS = ["toxic", "insult"]
SPEC = {"suites": [
    {"suite": "benign_names", "type": "template", "should_flag": False, "templates": ["{identity} a", "b {identity}"],
     "identities": ["X", "Y"]},
    {"suite": "must", "should_flag": True, "cases": [
        {"text": "t1", "expected": {"insult": 1}, "note": "n"}, {"text": "t2"}]},
]}


@pytest.fixture(scope="module")
def suites(spark):
    return parse_suites(spark, json.dumps(SPEC))


@pytest.fixture(scope="module")
def cases(spark, suites):
    more = spark.createDataFrame([(0, "Z")], "pos long, identity string")
    return B.battery_cases(suites, LABELS, {"benign_names": more})


def predict(spark, flags):
    return spark.createDataFrame(
        [(f"RT{i:03d}", t, n) for i, (t, n) in enumerate(flags, 1)], "case_id string, pred_toxic int, pred_insult int")


def test_expansion_order_and_fields(cases):
    rows = cases.orderBy("case_id").collect()
    assert [r["text"] for r in rows] == ["X a", "Y a", "Z a", "b X", "b Y", "b Z", "t1", "t2"]
    assert [r["case_id"] for r in rows] == [f"RT{i:03d}" for i in range(1, 9)]
    assert rows[0]["note"] == "identity=X" and rows[0]["asserts_specific"]
    assert (rows[6]["expected_toxic"], rows[6]["expected_insult"], rows[6]["asserts_specific"]) == (0, 1, True)
    assert rows[7]["asserts_specific"] is False and rows[7]["note"] == ""


def test_filled_templates_are_numbered_among_all_cases(spark):
    first = {"suite": "first", "should_flag": True, "cases": [{"text": "w", "note": "identity=none"}]}
    suites = parse_suites(spark, json.dumps({"suites": [first, *SPEC["suites"]]}))
    more = spark.createDataFrame([(0, "Z"), (0, "Z"), (None, "N")], "pos long, identity string")
    extra = spark.createDataFrame(
        [(0, "kept", 3), (None, "unplaced", 4)], "suite_ord int, suite string, pos long").selectExpr(
        "*", "'' AS failure_mode", "'' AS regulation_ref", "true AS should_flag", "'doc' AS text", "'doc=1' AS note",
        "cast(map() AS map<string,int>) AS expected")
    rows = B.numbered_templates(suites, {"benign_names": more}, extra).orderBy("case_id").collect()
    assert [(r["case_id"], r["block"], r["text"]) for r in rows] == [
        (f"RT{i:03d}", b, t) for i, (b, t) in enumerate(
            [(0, "X a"), (0, "Y a"), (0, "Z a"), (0, "Z a"), (0, "N a"),
             (1, "b X"), (1, "b Y"), (1, "b Z"), (1, "b Z"), (1, "b N")], 3)]
    assert rows[0].asDict() == {"case_id": "RT003", "suite": "benign_names", "block": 0, "pos": 0, "text": "X a",
                                "note": "identity=X"}


def test_scoring_is_three_valued(spark, cases):
    scored = B.score_predictions(cases, predict(spark, [(0, 0)] * 5 + [(1, 0), (0, 1), (1, 0)]), LABELS)
    rows = scored.orderBy("case_id").collect()
    assert [r["result"] for r in rows] == ["PASS"] * 5 + ["FAIL", "PASS", "PASS"]
    assert [r["exact_match"] for r in rows] == [True] * 5 + [False, True, None]


@pytest.mark.parametrize("n", [7, 9])
def test_misaligned_predictions_fail(spark, cases, n):
    preds = predict(spark, [(0, 0)] * n)
    assert B.alignment(cases, preds).count() == 1
    with pytest.raises(Exception, match="do not align"):
        B.score_predictions(cases, preds, LABELS).collect()


def test_repeated_and_missing_flags_fail(spark, cases):
    preds = predict(spark, [(0, 0)] * 8)
    first = F.col("case_id") == "RT001"
    for wrong in (preds.unionByName(preds.where(first)),
                  preds.withColumn("pred_insult", F.when(~first, F.col("pred_insult")))):
        with pytest.raises(Exception, match="do not align at RT001"):
            B.score_predictions(cases, wrong, LABELS).collect()
    with pytest.raises(Exception, match="do not align at RT001"):
        B.score_predictions(cases.unionByName(cases.where(first)), preds, LABELS).collect()


def gates(spark):
    return D.declared(spark, B.GATES, B.GATE_COLUMNS)


def scored_frame(spark, rows):
    return spark.createDataFrame(rows, "suite string, should_flag boolean, outcome_correct boolean")


def test_gates_and_k3(spark):
    rows = [("benign_names", False, True)] * 9 + [("veiled_threat", True, False)]
    report = B.gate_report(scored_frame(spark, rows), gates(spark), "c")
    got = {r["gate"]: r["status"] for r in report.collect()}
    assert got == {"overall": "PASS", "benign": "PASS", "critical:veiled_threat": "RED — high-severity evasion"}
    k3 = B.gate_status(report).first()
    assert (k3["status"], k3["strict"], k3["overall_pct"], k3["benign_pct"]) == ("PASS", "RED", 90.0, 100.0)


def test_missing_benign_suite_is_not_passed(spark):
    report = B.gate_report(scored_frame(spark, [("other", True, True)]), gates(spark), "c")
    assert B.gate_status(report).first()["status"] == "RED"


def test_gate_reads_unrounded_rate(spark):
    rows = [("benign_names", False, True)] * 2999 + [("benign_names", False, False)]
    assert B.gate_status(B.gate_report(scored_frame(spark, rows), gates(spark), "c")).first()["status"] == "RED"


def test_mixed_suite_fails(spark):
    with pytest.raises(Exception, match="mixed should_flag"):
        B.suite_summary(scored_frame(spark, [("s", True, True), ("s", False, True)])).collect()


def test_leak_gate(spark):
    cases = spark.createDataFrame([("1", "Some  Text"), ("2", "other")], "case_id string, text string")
    train = spark.createDataFrame([("some text",), ("some text",)], "text string")
    norm = F.regexp_replace(F.lower("text"), r"\s+", " ")
    r = B.leak_gate(cases, train, norm).first()
    assert (r["n_cases"], r["n_leaked"], r["status"]) == (2, 1, "RED")


def test_shingle_leak_gate(spark):
    run = "one two three four five six seven eight"
    cases = spark.createDataFrame([(1, f"x {run}"), (2, "one two three"), (3, None)], "case_id int, text string")
    texts = spark.createDataFrame([(1, f"{run} nine"), (2, f"a {run} b {run}"), (3, run[4:]), (4, None)],
                                  "doc_id int, text string")
    words = F.col("text")
    red = B.shingle_leak_gate(cases, texts, words)
    assert tuple(red.first()) == (3, 1, 2, "RED")
    left = B.without_leaks(cases, texts, words)
    assert sorted(r["doc_id"] for r in left.collect()) == [3, 4]
    clean = B.shingle_leak_gate(cases, left, words)
    assert tuple(clean.first()) == (3, 0, 0, "PASS")
    B.require_pass(clean)
    with pytest.raises(ValueError, match="leak gate"):
        B.require_pass(red)
    none = B.shingle_leak_gate(cases.where("false"), texts, words).first()
    assert tuple(none) == (0, 0, 0, "PASS")


@pytest.mark.parametrize("full", [True, False])
def test_shared_runs_equal_brute_force(spark, monkeypatch, full):
    """Whatever the map of hashes lets through, runs are compared as text."""
    rng = random.Random(1)
    text = lambda n: " ".join(rng.choice(["a", "b", "été", "漢字"]) for _ in range(n))
    cases = [(i, text(rng.randint(0, 9))) for i in range(20)] + [(20, None), (21, "")]
    texts = [(i, text(rng.randint(0, 60))) for i in range(80)] + [(80, None), (81, ""), (82, "a " * 5000 + "b")]
    if full:
        monkeypatch.setattr(R, "run_map", lambda *_: np.full((1 << R.MAP_BITS) // 8, 255, np.uint8))
    monkeypatch.setattr(R, "TOGETHER", 200)

    def runs(rows):
        return {k: {tuple((t or "").split()[i:i + 4]) for i in range(len((t or "").split()) - 3)} for k, t in rows}

    in_cases, in_texts = runs(cases), runs(texts)
    known, seen = set().union(*in_cases.values()), set().union(*in_texts.values())
    got = B.shingle_leak_gate(spark.createDataFrame(cases, "case_id int, text string"),
                              spark.createDataFrame(texts, "doc_id int, text string").repartition(3),
                              F.trim("text"), width=4).first()
    assert (got["n_leaked"], got["n_documents"]) == (
        sum(bool(r & seen) for r in in_cases.values()), sum(bool(r & known) for r in in_texts.values()))
