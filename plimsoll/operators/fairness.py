"""False positives on clean texts that mention a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import measures as M
from .shape import to_long


def group_false_positives(df: DataFrame, groups: Sequence[str], label: str,
                          red_pp: float = 3.0, amber_pp: float = 1.5) -> DataFrame:
    """Per group: clean mentions, false positives, rate, gap to the overall rate and its status.

    Wide input with ``g_<group>``, ``y_<label>`` and ``pred_<label>``; one pass. A group without
    clean mentions has a NULL rate and gap and is green. The gap is compared unrounded.
    """
    clean = F.col(f"y_{label}") == 0
    flagged = clean & (F.col(f"pred_{label}") == 1)
    sums = [F.count_if(clean).alias("all_clean"), F.count_if(flagged).alias("all_fp")]
    for g in groups:
        sums += [F.count_if(clean & F.col(f"g_{g}")).alias(f"n_{g}"),
                 F.count_if(flagged & F.col(f"g_{g}")).alias(f"fp_{g}")]
    rows = to_long(df.agg(*sums), groups, ["all_clean", "all_fp"],
                   {"clean_mentions": "n_{}", "false_positives": "fp_{}"}, key="group_name")
    rows = rows.select(
        "group_name", F.lit(label).alias("label"), "clean_mentions", "false_positives",
        M.percent(F.col("false_positives"), F.col("clean_mentions")).alias("fpr_pct"),
        M.percent(F.col("all_fp"), F.col("all_clean")).alias("overall_fpr_pct"))
    gap = F.col("fpr_pct") - F.col("overall_fpr_pct")
    return rows.withColumn("gap_pp", gap).withColumn(
        "status", M.ladder(F.col("gap_pp"), F.lit(red_pp), F.lit(amber_pp), M.GAP_RED, M.GAP_AMBER, M.GAP_GREEN)
    ).orderBy(F.desc_nulls_last("fpr_pct"), "group_name")
