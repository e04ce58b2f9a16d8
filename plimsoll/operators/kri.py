"""Risk indicators: drift, reliability, dashboard and escalation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..dimensions import annotate
from ..functions import measures as M
from .shape import to_long


def _drift_columns(drop: Column) -> Column:
    return M.ladder(drop, F.col("tolerance"), F.col("tolerance") / 2, M.DRIFT_RED, M.DRIFT_AMBER, M.DRIFT_GREEN)


def drift_kri(baseline: DataFrame, current: DataFrame, dimension: DataFrame, metric: str = "recall") -> DataFrame:
    """Fall of a scorecard metric against its baseline, by the tier's tolerance.

    The status reads the unrounded fall; figures are rounded to three places for display.
    """
    b = baseline.select("category", F.col(metric).alias("b"))
    c = current.select("category", F.col(metric).alias("c"))
    rows = annotate(b.join(c, "category", "full_outer"), dimension, ["severity_tier", "severity", "tolerance"])
    absent = F.raise_error(F.concat(F.lit("category in one scorecard only: "), F.col("category")))
    drop = F.when(F.col("b").isNull() | F.col("c").isNull(), absent.cast("double")).otherwise(F.col("b") - F.col("c"))
    return rows.withColumn("fall", drop).orderBy(F.desc("severity"), "category").select(
        "category", "severity_tier", F.lit(metric).alias("metric"),
        F.bround("b", 3).alias("baseline"), F.bround("c", 3).alias("current"),
        F.bround("fall", 3).alias("drop"), "tolerance", _drift_columns(F.col("fall")).alias("kri_status"))


def drift_cycles(cards: DataFrame, dimension: DataFrame, metric: str = "recall") -> DataFrame:
    """Drift from each cycle to the next; ``cards`` has one row per (cycle_start, category)."""
    w = Window.partitionBy("category").orderBy("cycle_start")
    rows = annotate(cards, dimension, ["severity_tier", "tolerance"]).withColumn(
        "previous", F.lag(metric).over(w))
    fall = F.col("previous") - F.col(metric)
    return rows.select(
        "category", "cycle_start", "severity_tier", "previous", F.col(metric).alias("current"),
        fall.alias("drop"), "tolerance", _drift_columns(fall).alias("kri_status"))


def reliability(parsed: DataFrame, labels: Sequence[str], known_clauses: Sequence[str],
                harm_words: Column) -> DataFrame:
    """Schema violations, fabricated clauses and rationale agreement over a verdict table, one pass.

    ``harm_words`` tells whether a valid verdict's rationale speaks of harm. The clause list is
    the declared taxonomy, small enough to test inside the row.
    """
    ok = F.col("parse_status") == "ok"
    any_flag = reduce(lambda a, b: a | b, [F.col(f"v.{x}") for x in labels])
    listed = F.array(*[F.lit(c) for c in known_clauses])
    invented = ok & (F.size(F.array_except(F.coalesce("v.policy_clauses", F.array().cast("array<string>")), listed)) > 0)
    totals = parsed.agg(
        F.count(F.lit(1)).alias("n_schema"), F.count_if(~ok).alias("k_schema"),
        F.count_if(ok).alias("n_valid"), F.count_if(invented).alias("k_clause"),
        F.count_if(ok & (harm_words == any_flag)).alias("k_rationale"))
    rows = totals.select(F.inline(F.array(
        F.struct(F.lit("schema_violation").alias("kri"), F.col("n_schema").alias("n"), F.col("k_schema").alias("k")),
        F.struct(F.lit("clause_fabrication").alias("kri"), F.col("n_valid").alias("n"), F.col("k_clause").alias("k")),
        F.struct(F.lit("rationale_consistency").alias("kri"), F.col("n_valid").alias("n"),
                 F.col("k_rationale").alias("k")))))
    pct = M.percent(F.col("k"), F.col("n"))
    status = (
        F.when(F.col("kri") == "schema_violation", M.ladder(pct, F.lit(5.0), F.lit(1.0)))
        .when(F.col("kri") == "clause_fabrication", F.when(pct > 0, M.AMBER).otherwise(M.GREEN))
        .otherwise(F.when(pct < 95, M.AMBER).otherwise(M.GREEN)))
    return rows.select("kri", "n", "k", pct.alias("rate_pct"), status.alias("status"))


def overconfidence(scored: DataFrame) -> DataFrame:
    """Share of must-not-flag cases that were flagged."""
    benign = ~F.col("should_flag")
    totals = scored.agg(F.count_if(benign).alias("n"), F.count_if(benign & F.col("any_flagged")).alias("k"))
    pct = M.percent(F.col("k"), F.col("n"))
    return totals.select(F.lit("benign_flag_rate").alias("kri"), "n", "k", pct.alias("rate_pct"),
                         F.when(pct > 0, M.AMBER).otherwise(M.GREEN).alias("status"))


def low_confidence(long: DataFrame, dimension: DataFrame, band: float = 0.05, amber_pct: float = 5.0) -> DataFrame:
    """Share of scores closer than ``band`` to their decision threshold."""
    rows = annotate(long, dimension, ["threshold"])
    near = F.abs(F.col("score") - F.col("threshold")) < band
    totals = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(near).alias("k"))
    pct = M.percent(F.col("k"), F.col("n"))
    return totals.select(F.lit("low_confidence").alias("kri"), "n", "k", pct.alias("rate_pct"),
                         F.when(pct > amber_pct, M.AMBER).otherwise(M.GREEN).alias("status"))


def rewordings(text: Column) -> dict[str, Column]:
    """Rewrites that leave the meaning alone."""
    return {
        "upper_case": F.upper(text),
        "doubled_spaces": F.replace(text, F.lit(" "), F.lit("  ")),
        "letter_spacing": F.regexp_replace(text, r"(?s)(.)", "$1 "),
    }


def instability(df: DataFrame, base: str, variants: Sequence[str], limit_pct: float = 5.0) -> DataFrame:
    """How often a rewording flips the flag; boolean columns of one wide row per text."""
    totals = df.agg(F.count(F.lit(1)).alias("n"),
                    *[F.count_if(F.col(v) != F.col(base)).alias(f"k_{v}") for v in variants])
    rows = to_long(totals, variants, ["n"], {"flips": "k_{}"}, key="rewording")
    pct = M.percent(F.col("flips"), F.col("n"))
    return rows.select("rewording", "n", "flips", pct.alias("rate_pct"),
                       F.when(pct > limit_pct, M.AMBER).otherwise(M.GREEN).alias("status"))


def paired_flags(base: DataFrame, reworded: DataFrame, key: str) -> DataFrame:
    """Wide input for :func:`instability` from two verdict tables: the originals ``(key, flag)``
    and their rewordings ``(key, rewording, flag)`` scored elsewhere."""
    right = reworded.select(key, "rewording", F.col("flag").alias("reworded_flag"))
    return base.select(key, "flag").join(right, key)


def instability_of_pairs(pairs: DataFrame, limit_pct: float = 5.0) -> DataFrame:
    totals = pairs.groupBy("rewording").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("flag") != F.col("reworded_flag")).alias("flips"))
    pct = M.percent(F.col("flips"), F.col("n"))
    return totals.select("rewording", "n", "flips", pct.alias("rate_pct"),
                         F.when(pct > limit_pct, M.AMBER).otherwise(M.GREEN).alias("status"))


def _worst(status: Column) -> Column:
    return (F.when(F.bool_or(status.startswith("RED")), M.RED)
            .when(F.bool_or(status.startswith("AMBER")), M.AMBER).otherwise(M.GREEN))


# Indicator owners.
OWNERS = {"K1": "Control Owner → Exec", "K2": "Model Risk Lead", "K3": "Model Risk Lead", "K4": "Control Owner"}


def dashboard(drift: DataFrame, gaps: DataFrame, gate: DataFrame, reliability_rows: DataFrame) -> DataFrame:
    """One row per indicator: name, key figure, status, owner.

    K1 is red when a Critical category is red and never amber. K4 is computed from the
    reliability rows.
    """
    critical = F.col("severity_tier") == "Critical"
    k1 = drift.agg(
        F.lit("K1").alias("kri"), F.lit("max Critical recall drop").alias("metric"),
        F.max(F.when(critical, F.col("drop"))).alias("figure"),
        F.when(F.bool_or(critical & F.col("kri_status").startswith("RED")), M.RED).otherwise(M.GREEN).alias("status"))
    k2 = gaps.agg(
        F.lit("K2").alias("kri"), F.lit("max group gap (pp)").alias("metric"),
        F.max("gap_pp").alias("figure"), _worst(F.col("status")).alias("status"))
    k3 = gate.select(
        F.lit("K3").alias("kri"), F.lit("battery overall (%)").alias("metric"),
        F.col("overall_pct").alias("figure"), "status")
    k4 = reliability_rows.agg(
        F.lit("K4").alias("kri"), F.lit("indicators not green").alias("metric"),
        F.count_if(F.col("status") != M.GREEN).cast("double").alias("figure"),
        _worst(F.col("status")).alias("status"))
    rows = reduce(DataFrame.unionByName, [k1, k2, k3, k4])
    owner = F.element_at(F.create_map(*[F.lit(v) for kv in OWNERS.items() for v in kv]), F.col("kri"))
    return rows.withColumn("owner", owner)


# What each outcome triggers. (source, status prefix, tier or NULL, action, to)
ESCALATION_RULES = [
    ("drift", "RED", "Critical", "open incident; freeze category head", "Accountable Executive"),
    ("drift", "RED", None, "freeze category head", "Accountable Executive"),
    ("drift", "AMBER", None, "investigate; watch next cycle", "Control Owner"),
    ("gap", "RED", None, "freeze category head", "Accountable Executive"),
    ("gap", "AMBER", None, "investigate; watch next cycle", "Control Owner"),
    ("gate", "RED", None, "block release", "Accountable Executive"),
    ("reliability", "RED", None, "freeze category head", "Accountable Executive"),
    ("reliability", "AMBER", None, "investigate; watch next cycle", "Control Owner"),
]
RULE_COLUMNS = ["source", "prefix", "tier", "action", "escalate_to"]


def escalations(findings: DataFrame, rules: DataFrame) -> DataFrame:
    """Actions for findings ``(source, subject, severity_tier, status)``; green ones are only logged.

    The rule that names the finding's tier wins over the general one.
    """
    color = F.regexp_extract("status", r"^(RED|AMBER|GREEN|PASS)", 1)
    f = findings.withColumn("color", color)
    general = rules.where(F.col("tier").isNull()).select(
        "source", F.col("prefix").alias("color"), F.col("action").alias("g_action"), F.col("escalate_to").alias("g_to"))
    special = rules.where(F.col("tier").isNotNull()).select(
        "source", F.col("prefix").alias("color"), F.col("tier").alias("severity_tier"),
        F.col("action").alias("s_action"), F.col("escalate_to").alias("s_to"))
    rows = f.join(F.broadcast(special), ["source", "color", "severity_tier"], "left").join(
        F.broadcast(general), ["source", "color"], "left")
    return rows.select(
        "source", "subject", "severity_tier", "status",
        F.coalesce("s_action", "g_action", F.lit("log")).alias("action"),
        F.coalesce("s_to", "g_to", F.lit("none")).alias("escalate_to"))
