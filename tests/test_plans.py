"""Shapes of the physical plans that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

from plimsoll.operators import fairness, metrics, profile, sampling
from plimsoll.plans import bindings as X
from plimsoll.plans.registry import QUERIES

EAGER = {"train_scores", "train_certificate", "train_scorecard", "top_features"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_pairwise_joins(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def keyed_shuffles(df):
    """Column names carried by every hash-partitioned exchange of the initial plan."""
    found, todo = [], [df._jdf.queryExecution().executedPlan().initialPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "Exchange" and "hashpartitioning" in node.outputPartitioning().toString():
            found.append([node.output().apply(i).name() for i in range(node.output().size())])
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


@pytest.mark.parametrize("build", [
    lambda s, d: metrics.confusion_wide(X.scored(s, d), X.LABELS),
    lambda s, d: fairness.group_false_positives(X.scored(s, d), list(X.GROUPS), "toxic"),
    lambda s, d: metrics.auc(metrics.score_points(X.scored_long(s, d))),
])
def test_text_never_enters_a_keyed_shuffle(spark, sf_dir, build):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if no side were small
    try:
        carried = keyed_shuffles(build(spark, sf_dir))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert carried and not any("text" in columns for columns in carried)


def test_scans_read_only_what_they_need(spark, sf_dir):
    text = plan(profile.flag_totals(X.truth(spark, sf_dir), X.LABELS))
    assert "ReadSchema: struct<quality:int,toxic:int>" in text
    text = plan(X.scored(spark, sf_dir).select("y_toxic", "pred_low_quality"))
    assert "text" not in re.search(r"ReadSchema: struct<doc_id:bigint,(.*)>", text).group(1).split("ReadSchema")[0]


def test_filters_reach_the_scan(spark, sf_dir):
    text = plan(X.table(spark, sf_dir, "documents").where("doc_id > 5").select("doc_id", "lang"))
    assert "GreaterThan(doc_id,5)" in text


def test_strata_are_cut_before_the_shuffle(spark, sf_dir):
    df = X.truth(spark, sf_dir).withColumn("draw", F.md5(F.col("doc_id").cast("string").cast("binary")))
    text = plan(sampling.top_per_stratum(df, "y_toxic", "draw", 5))
    assert text.count("WindowGroupLimit") == 2


def test_score_points_are_shuffled_once(spark, sf_dir):
    df = metrics.auc(metrics.score_points(X.scored_long(spark, sf_dir)))
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    by_score = [x for x in final.splitlines() if re.search(r"Exchange hashpartitioning\(category#\d+, score#", x)]
    fresh = [x for x in by_score if "ReusedExchange" not in x]
    assert len(fresh) == 1, by_score
