"""Verdict tables from outside models: requests out, answers in, checks in between.

The engine never calls a model. It writes a request table for a batch client and reads the
answers back as JSON strings next to the row keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lexical import LEXICAL_RATIONALE, Lexicon, clauses_of

CORRUPT = "_corrupt_record"


def verdict_schema(labels: Sequence[str]) -> str:
    flags = ", ".join(f"{x} BOOLEAN" for x in labels)
    return f"{flags}, policy_clauses ARRAY<STRING>, rationale STRING, {CORRUPT} STRING"


def system_prompt(taxonomy: DataFrame, header: str, rules: str) -> DataFrame:
    """One row: header, one line per category in label order, rules. Built from the taxonomy table,
    so the wording sent out and the table used for scoring cannot drift apart."""
    line = F.format_string("- %s [%s]: %s Clause: %s", "category", "severity_tier", "definition", "clause")
    lines = F.array_sort(F.collect_list(F.struct("ord", line.alias("line"))))
    body = F.array_join(F.transform(lines, lambda r: r["line"]), "\n")
    prompt = F.concat(F.lit(header + "\n\n"), body, F.lit("\n\n" + rules))
    return taxonomy.agg(prompt.alias("prompt")).select(F.md5(F.col("prompt").cast("binary")).alias("prompt_id"),
                                                       "prompt")


def request_text(text: Column) -> Column:
    return F.concat(F.lit("Assess the text between the markers.\n<text>\n"), text, F.lit("\n</text>"))


def parse_verdicts(raw: DataFrame, labels: Sequence[str], payload: str = "payload") -> DataFrame:
    """Adds ``v`` (the verdict struct) and ``parse_status``.

    'malformed' is text that is not JSON of the right types, 'incomplete' lacks a required flag.
    """
    parse = F.from_json(F.col(payload), verdict_schema(labels),
                        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    # exploding the one-element array makes each answer parse once: a plain column would be
    # copied into every filter and field access that the optimizer moves below it
    parsed = raw.select("*", F.explode(F.array(parse)).alias("v"))
    lacking = F.lit(False)
    for x in labels:
        lacking = lacking | F.col(f"v.{x}").isNull()
    status = (F.when(F.col("v").isNull() | F.col(f"v.{CORRUPT}").isNotNull(), "malformed")
              .when(lacking, "incomplete").otherwise("ok"))
    return parsed.withColumn("parse_status", status)


def verdict_flags(parsed: DataFrame, labels: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """0/1 columns in label order for the valid verdicts."""
    return parsed.where(F.col("parse_status") == "ok").select(
        *keep, *[F.col(f"v.{x}").cast("int").alias(f"pred_{x}") for x in labels])


def lexical_verdicts(df: DataFrame, lexicon: Lexicon, clauses: Mapping[str, str], keep: Sequence[str],
                     text: str = "text", guard: bool = False) -> DataFrame:
    """Verdict rows from the lexical control: flags, clauses, fixed rationale."""
    flags = lexicon.flags(F.col(text), guard)
    rows = df.select(*keep, *[c.alias(x) for x, c in flags.items()])
    return rows.select(
        *keep, *lexicon.labels,
        clauses_of({x: F.col(x) for x in lexicon.labels}, clauses).alias("policy_clauses"),
        F.lit(LEXICAL_RATIONALE).alias("rationale"))


def coalesce_verdicts(lexical: DataFrame, parsed: DataFrame, labels: Sequence[str], key: str,
                      on_error: str = "lexical") -> DataFrame:
    """The model's verdict where it is valid, the lexical one elsewhere, and which of the two it was.

    ``on_error='raise'`` fails the job at the first row without a valid verdict.
    """
    good = parsed.where(F.col("parse_status") == "ok").select(
        key, *[F.col(f"v.{x}").alias(f"m_{x}") for x in labels],
        F.coalesce("v.policy_clauses", F.array().cast("array<string>")).alias("m_clauses"),
        F.coalesce("v.rationale", F.lit("")).alias("m_rationale"), F.lit(True).alias("from_model"))
    rows = lexical.join(good, key, "left")
    model = F.coalesce("from_model", F.lit(False))
    if on_error == "raise":
        failure = F.raise_error(F.concat(F.lit("no valid verdict for "), F.col(key).cast("string")))
        model = F.when(model, F.lit(True)).otherwise(failure.cast("boolean"))
    rows = rows.withColumn("__model", model)
    pick = lambda ours, theirs: F.when(F.col("__model"), F.col(theirs)).otherwise(F.col(ours))
    return rows.select(
        key, *[pick(x, f"m_{x}").alias(x) for x in labels],
        pick("policy_clauses", "m_clauses").alias("policy_clauses"),
        pick("rationale", "m_rationale").alias("rationale"),
        F.when(F.col("__model"), "model").otherwise("lexical").alias("verdict_source"))


def fabricated_clauses(parsed: DataFrame, taxonomy: DataFrame, key: str) -> DataFrame:
    """(key, clause) pairs that cite a clause the taxonomy does not have."""
    cited = parsed.select(key, F.explode("v.policy_clauses").alias("clause"))
    return cited.join(F.broadcast(taxonomy.select("clause")), "clause", "left_anti").select(key, "clause")


def calibration(probes: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Exact-vector agreement of ``pred_<label>`` with ``y_<label>`` over a probe table."""
    same = F.lit(True)
    for x in labels:
        same = same & (F.col(f"pred_{x}") == F.col(f"y_{x}"))
    totals = probes.agg(F.count(F.lit(1)).alias("n_probes"), F.count_if(same).alias("n_exact"))
    return totals.select(
        "n_probes", "n_exact", F.try_divide(F.lit(100) * F.col("n_exact"), F.col("n_probes")).alias("exact_pct"),
        F.when(F.col("n_exact") == F.col("n_probes"), "PASS").otherwise("FAIL").alias("status"))


def route(df: DataFrame, score: str, low: float, high: float) -> DataFrame:
    """Scores inside [low, high] go to the challenger, the rest are decided by the cheap control."""
    inside = F.col(score).between(low, high)
    return df.withColumn("route", F.when(inside, "challenger").otherwise("champion"))
