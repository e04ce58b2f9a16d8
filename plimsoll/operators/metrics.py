"""Scorecards: confusion counts, precision/recall/F1, exact ROC-AUC and average precision.

Long input: one row per (text, category) with ``y``, optional ``pred`` and ``score``. It is
reduced to one row per distinct (category, score, pred) first; everything else reads that.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..dimensions import annotate
from ..functions import measures as M
from .running import running_totals, value_range
from .shape import to_long


def known(name: str, what: str | None = None) -> Column:
    """The column, where a NULL fails the job: an unscored row is neither right nor wrong."""
    missing = F.raise_error(F.lit(f"NULL in {what or name}"))
    return F.when(F.col(name).isNotNull(), F.col(name)).otherwise(missing.cast("int"))


def confusion_wide(df: DataFrame, labels: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """tp/fp/fn/tn per label from wide ``y_<label>``/``pred_<label>``: three sums per label, one pass."""
    sums = [F.count(F.lit(1)).alias("n")]
    for x in labels:
        y, p = known(f"y_{x}"), known(f"pred_{x}")
        sums += [F.sum(y).alias(f"p_{x}"), F.sum(p).alias(f"q_{x}"), F.sum(y * p).alias(f"tp_{x}")]
    rows = to_long(df.groupBy(*by).agg(*sums), labels, [*by, "n"],
                   {"p": "p_{}", "q": "q_{}", "tp": "tp_{}"})
    return rows.select(
        *by, "category", F.coalesce("tp", F.lit(0)).alias("tp"),
        F.coalesce(F.col("q") - F.col("tp"), F.lit(0)).alias("fp"),
        F.coalesce(F.col("p") - F.col("tp"), F.lit(0)).alias("fn"),
        F.coalesce(F.col("n") - F.col("p") - F.col("q") + F.col("tp"), F.lit(0)).alias("tn"))


def confusion_long(df: DataFrame, by: Sequence[str] = ("category",)) -> DataFrame:
    """The same counts from long rows, per any key."""
    y, p = known("y") == 1, known("pred") == 1
    return df.groupBy(*by).agg(
        F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"))


def precision() -> Column:
    return M.rate_or_zero(F.col("tp"), F.col("tp") + F.col("fp"))


def recall() -> Column:
    return M.rate_or_zero(F.col("tp"), F.col("tp") + F.col("fn"))


def f1() -> Column:
    return M.rate_or_zero(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))


def scorecard(confusion: DataFrame, dimension: DataFrame, aucs: DataFrame | None = None) -> DataFrame:
    """Per-category report, most severe first. ``dimension``: category, severity_tier, severity."""
    card = annotate(confusion, dimension, ["severity_tier", "severity"])
    card = card.select(
        "category", "severity_tier", "severity", (F.col("tp") + F.col("fn")).alias("support_pos"),
        precision().alias("precision"), recall().alias("recall"), f1().alias("f1"))
    if aucs is None:
        card = card.withColumns({"roc_auc": F.lit(None).cast("double"), "pr_auc": F.lit(None).cast("double")})
    else:
        card = card.join(aucs.select("category", "roc_auc", "pr_auc"), "category", "left")
    return card.orderBy(F.desc("severity"), "category").select(
        "category", "severity_tier", "support_pos", "precision", "recall", "f1", "roc_auc", "pr_auc")


def macro_micro(confusion: DataFrame) -> DataFrame:
    """Label means, and F1 from pooled counts."""
    per = confusion.select("tp", "fp", "fn", precision().alias("p"), recall().alias("r"), f1().alias("f"))
    pooled = per.agg(
        F.avg("f").alias("macro_f1"), F.avg("r").alias("macro_recall"), F.avg("p").alias("macro_precision"),
        F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"))
    return pooled.select("macro_f1", f1().alias("micro_f1"), "macro_recall", "macro_precision")


def score_points(long: DataFrame, by: Sequence[str] = ("category",)) -> DataFrame:
    """Distinct scores with their class counts; ties, however heavy, become one row. A NULL fails the job."""
    score = F.when(F.col("score").isNotNull(), F.col("score")).otherwise(
        F.raise_error(F.lit("NULL in score")).cast("double"))
    return long.withColumns({"score": score, "y": known("y")}).groupBy(*by, "score").agg(
        F.sum(F.col("y").cast("long")).alias("pos"),
        F.sum(F.lit(1).cast("long") - F.col("y")).alias("neg"))


def _log_odds(score: Column) -> Column:
    """Strictly placed monotone scale: log-odds on (0, 1), growing tails outside."""
    inner = F.log(score / (1 - score))
    return (
        F.when(score <= 0, F.lit(-2000.0) - F.log(1 - score))
        .when(score >= 1, F.lit(2000.0) + F.log(score))
        .otherwise(inner))


def auc(points: DataFrame) -> DataFrame:
    """Exact ROC-AUC (ties count half) and average precision (step sum, no interpolation).

    Scores descend through ranges of log-odds, 1/16 wide and then 1/65536 wide, so a category
    with very many distinct scores is spread over many tasks. Pair counts are kept as exact
    integers. Both values are NULL unless the category has positives and negatives.
    """
    z = -_log_odds(F.col("score"))
    ranged = points.select(
        "category", "pos", "neg", (-F.col("score")).alias("down"),
        value_range(z * 16).alias("block"), value_range(z * 65536).alias("cell"))
    run = running_totals(ranged, ["category"], ["block"], ["cell"], ["down"], ["pos", "neg"])
    tp = F.col("before_pos") + F.col("pos")
    fp = F.col("before_neg") + F.col("neg")
    wide = "decimal(38,0)"
    sums = run.groupBy("category").agg(
        F.sum("pos").alias("p"), F.sum("neg").alias("n"),
        F.sum(F.col("neg").cast("decimal(18,0)") * (2 * F.col("before_pos") + F.col("pos")).cast("decimal(19,0)"))
        .cast(wide).alias("twice_pairs"),
        F.sum(F.col("pos") * M.rate_or_zero(tp, tp + fp)).alias("steps"))
    both = (F.col("p") > 0) & (F.col("n") > 0)
    p, n = F.col("p").cast("double"), F.col("n").cast("double")
    return sums.select(
        "category", F.col("p").alias("positives"), F.col("n").alias("negatives"),
        F.when(both, F.try_divide(F.col("twice_pairs").cast("double"), 2 * p * n)).alias("roc_auc"),
        F.when(both, F.try_divide(F.col("steps"), p)).alias("pr_auc"))


def per_category_metrics(long: DataFrame, dimension: DataFrame) -> DataFrame:
    """Scorecard with AUCs from long (category, y, pred, score) rows; ``dimension`` fixes the categories."""
    return scorecard(confusion_long(long), dimension, auc(score_points(long)))


def with_thresholds(long: DataFrame, dimension: DataFrame) -> DataFrame:
    """Adds the tier's decision threshold to every long row."""
    return annotate(long, dimension, ["threshold"])


def tiered_predictions(long: DataFrame, dimension: DataFrame, flat: float = 0.5) -> DataFrame:
    """Adds ``pred_flat`` (one cut for all) and ``pred_tiered`` (cut by severity tier)."""
    rows = with_thresholds(long, dimension)
    return rows.withColumns({
        "pred_flat": (F.col("score") >= flat).cast("int"),
        "pred_tiered": (F.col("score") >= F.col("threshold")).cast("int")})


def flat_vs_tiered(long: DataFrame, dimension: DataFrame, flat: float = 0.5) -> DataFrame:
    """Recall and precision under both cuts in one pass, with the recall lift."""
    y = F.col("y") == 1
    rows = tiered_predictions(long, dimension, flat)
    sums = rows.groupBy("category").agg(
        F.count_if(y).alias("p"),
        F.count_if(F.col("pred_flat") == 1).alias("q_flat"), F.count_if(F.col("pred_tiered") == 1).alias("q_tier"),
        F.count_if(y & (F.col("pred_flat") == 1)).alias("tp_flat"),
        F.count_if(y & (F.col("pred_tiered") == 1)).alias("tp_tier"))
    card = annotate(sums, dimension, ["severity_tier", "threshold"])
    r_flat = M.rate_or_zero(F.col("tp_flat"), F.col("p"))
    r_tier = M.rate_or_zero(F.col("tp_tier"), F.col("p"))
    return card.select(
        "category", "severity_tier", "threshold", r_flat.alias("recall_flat"), r_tier.alias("recall_tiered"),
        M.rate_or_zero(F.col("tp_flat"), F.col("q_flat")).alias("precision_flat"),
        M.rate_or_zero(F.col("tp_tier"), F.col("q_tier")).alias("precision_tiered"),
        F.bround(r_tier - r_flat, 3).alias("recall_lift"))


def champion_challenger(champion: DataFrame, challenger: DataFrame, dimension: DataFrame) -> DataFrame:
    """Recall and F1 of two controls side by side; both must cover the same categories."""
    left = champion.select("category", recall().alias("champion_recall"), f1().alias("champion_f1"))
    right = challenger.select("category", recall().alias("challenger_recall"), f1().alias("challenger_f1"))
    both = left.join(right, "category", "full_outer")
    gap = F.raise_error(F.concat(F.lit("category scored by one control only: "), F.col("category")))
    whole = F.col("champion_recall").isNotNull() & F.col("challenger_recall").isNotNull()
    both = both.withColumn("champion_recall",
                           F.when(whole, F.col("champion_recall")).otherwise(gap.cast("double")))
    return annotate(both, dimension, ["severity_tier"]).select(
        "category", "severity_tier", "champion_recall", "challenger_recall", "champion_f1", "challenger_f1")
