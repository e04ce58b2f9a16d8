"""Scorecards, AUCs and running totals against brute force."""

import numpy as np
import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plimsoll import dimensions as D
from plimsoll.operators import fairness, metrics
from plimsoll.operators.running import numbered
from plimsoll.plans import bindings as X

relaxed = settings(max_examples=6, deadline=None, derandomize=True, database=None,
                   phases=[Phase.explicit, Phase.generate], suppress_health_check=list(HealthCheck))
cases = st.lists(st.tuples(st.integers(0, 1), st.sampled_from([0.0, 1e-9, 0.2, 0.25, 0.5, 0.50001, 0.75, 1 - 1e-12, 1.0])
                           | st.floats(0, 1)), min_size=2, max_size=60)


def brute(y, s):
    y, s = np.array(y), np.array(s)
    pos, neg = s[y == 1], s[y == 0]
    if not len(pos) or not len(neg):
        return None, None
    roc = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    ap, last = 0.0, 0.0
    for cut in sorted(set(s), reverse=True):
        hit = s >= cut
        recall = (y[hit] == 1).sum() / len(pos)
        ap += (recall - last) * (y[hit] == 1).mean()
        last = recall
    return roc, ap


def auc_of(spark, rows):
    df = spark.createDataFrame([("a", y, s) for y, s in rows], "category string, y int, score double")
    r = metrics.auc(metrics.score_points(df)).first()
    return r["roc_auc"], r["pr_auc"]


@given(cases)
@relaxed
def test_auc_equals_brute_force(spark, rows):
    want = brute(*zip(*rows))
    got = auc_of(spark, rows)
    assert got == want if want[0] is None else got == pytest.approx(want, abs=1e-12)


@given(cases)
@relaxed
def test_auc_ignores_monotone_maps(spark, rows):
    # halving loses the smallest doubles, so keep clear of them
    rows = [(y, round(s, 6)) for y, s in rows]
    (roc, ap), (roc2, ap2) = auc_of(spark, rows), auc_of(spark, [(y, s / 4 + 0.5) for y, s in rows])
    assert roc == roc2  # integer pair counts: exact
    assert ap == ap2 if ap is None else ap == pytest.approx(ap2, abs=1e-12)  # a sum of doubles: any order


def test_auc_outside_unit_interval_and_ties(spark):
    rows = [(1, 7.0), (0, -3.0), (1, -3.0), (0, 2.5), (1, 0.5), (0, 0.5)]
    assert auc_of(spark, rows) == pytest.approx(brute(*zip(*rows)))
    assert auc_of(spark, [(1, 0.5), (0, 0.5)]) == (0.5, 0.5)


def test_numbering_has_no_gaps(spark):
    df = spark.range(0, 5000).select((F.col("id") % 3).cast("int").alias("suite"), (F.col("id") * 37).alias("pos"))
    got = numbered(df.repartition(7), ["suite"], "pos").orderBy("suite", "pos").collect()
    assert [r["seq"] for r in got] == list(range(1, 5001))


@pytest.fixture(scope="module")
def dims(spark):
    rows = [("a", "", "ca", "", "", "Critical"), ("b", "", "cb", "", "", "Medium")]
    return D.with_tiers(D.taxonomy(spark, rows), D.tiers(spark, X.TIERS))


def test_scorecard_edges(spark, dims):
    long = spark.createDataFrame(
        [("a", 1, 1, 0.9), ("a", 0, 1, 0.8), ("a", 1, 0, 0.1), ("b", 0, 0, 0.2), ("b", 0, 0, 0.1)],
        "category string, y int, pred int, score double")
    a, b = metrics.per_category_metrics(long, dims).collect()
    assert (a["category"], a["support_pos"], a["precision"], a["recall"], a["f1"]) == ("a", 2, 0.5, 0.5, 0.5)
    assert (b["precision"], b["recall"], b["f1"], b["roc_auc"], b["pr_auc"]) == (0.0, 0.0, 0.0, None, None)


def test_unknown_category_fails(spark, dims):
    long = spark.createDataFrame([("zz", 1, 0.9)], "category string, y int, score double")
    with pytest.raises(Exception, match="missing from dimension"):
        metrics.tiered_predictions(long, dims).collect()


def test_wide_and_long_counts_agree(spark, sf_dir):
    wide = metrics.confusion_wide(X.scored(spark, sf_dir), X.LABELS)
    long = metrics.confusion_long(X.scored_long(spark, sf_dir))
    order = ["category", "tp", "fp", "fn", "tn"]
    assert sorted(wide.select(order).collect()) == sorted(long.select(order).collect())


def test_lower_cut_never_lowers_recall(spark, sf_dir):
    for r in metrics.flat_vs_tiered(X.scored_long(spark, sf_dir), X.dimension(spark)).collect():
        assert r["recall_tiered"] >= r["recall_flat"]


def test_macro_micro_against_numpy(spark):
    rows = [("a", 3, 1, 2, 4), ("b", 0, 0, 0, 10)]
    r = metrics.macro_micro(spark.createDataFrame(rows, "category string, tp long, fp long, fn long, tn long")).first()
    assert r["macro_f1"] == pytest.approx(6 / 9 / 2) and r["micro_f1"] == pytest.approx(6 / 9)
    assert r["macro_recall"] == pytest.approx(0.3) and r["macro_precision"] == pytest.approx(0.375)


def test_champion_challenger_needs_same_categories(spark, dims):
    schema = "category string, tp long, fp long, fn long, tn long"
    left = spark.createDataFrame([("a", 1, 1, 1, 1), ("b", 1, 1, 1, 1)], schema)
    right = spark.createDataFrame([("a", 1, 1, 1, 1)], schema)
    with pytest.raises(Exception, match="one control only"):
        metrics.champion_challenger(left, right, dims).collect()


def test_group_without_mentions_is_green(spark):
    df = spark.createDataFrame([(True, False, 0, 1), (True, False, 0, 0), (False, False, 0, 0), (False, False, 1, 1)],
                               "g_x boolean, g_none boolean, y_t int, pred_t int")
    rows = {r["group_name"]: r for r in fairness.group_false_positives(df, ["x", "none"], "t").collect()}
    assert rows["x"]["fpr_pct"] == 50.0 and rows["x"]["status"].startswith("RED")
    assert rows["none"]["fpr_pct"] is None and rows["none"]["gap_pp"] is None and rows["none"]["status"] == "GREEN"


def test_unscored_rows_fail(spark):
    long = spark.createDataFrame([("a", 1, 1, 0.5), ("a", 0, None, 0.5)], "category string, y int, pred int, score double")
    with pytest.raises(Exception, match="NULL in pred"):
        metrics.confusion_long(long).collect()
    wide = long.selectExpr("y as y_a", "pred as pred_a")
    with pytest.raises(Exception, match="NULL in pred_a"):
        metrics.confusion_wide(wide, ["a"]).collect()
    for column in ("y", "score"):
        rows = long.withColumn(column, F.lit(None).cast(long.schema[column].dataType))
        with pytest.raises(Exception, match=f"NULL in {column}"):
            metrics.auc(metrics.score_points(rows)).collect()
