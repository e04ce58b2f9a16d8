"""Test-battery definitions: nested JSON in, typed rows out.

The file holds arrays throughout, so the order of suites, templates and cases - which decides
the case numbers - is explicit and survives distribution.
"""

from __future__ import annotations

from importlib import resources

from pyspark.sql import DataFrame, SparkSession

SUITE_SCHEMA = """
  suites ARRAY<STRUCT<
    suite: STRING, failure_mode: STRING, regulation_ref: STRING, should_flag: BOOLEAN, type: STRING,
    expected: MAP<STRING, INT>, templates: ARRAY<STRING>, identities: ARRAY<STRING>,
    cases: ARRAY<STRUCT<text: STRING, expected: MAP<STRING, INT>, note: STRING>>>>
"""


def builtin_battery() -> str:
    return str(resources.files("plimsoll") / "assets" / "battery.json")


def builtin_battery_text() -> str:
    return (resources.files("plimsoll") / "assets" / "battery.json").read_text(encoding="utf-8")


def read_suites(spark: SparkSession, path: str) -> DataFrame:
    """One row per suite with its position ``suite_ord``; absent flags and texts get their defaults."""
    raw = spark.read.schema(SUITE_SCHEMA).json(path, multiLine=True)
    return _numbered(raw)


def parse_suites(spark: SparkSession, text: str) -> DataFrame:
    """The same from a JSON string already in hand (no file needs to be visible to executors)."""
    from pyspark.sql import functions as F

    raw = spark.range(1).select(F.from_json(F.lit(text), SUITE_SCHEMA).alias("doc")).select("doc.suites")
    return _numbered(raw)


def _numbered(raw: DataFrame) -> DataFrame:
    rows = raw.selectExpr("posexplode(suites) AS (suite_ord, s)")
    return rows.selectExpr(
        "suite_ord", "s.suite AS suite", "coalesce(s.failure_mode, '') AS failure_mode",
        "coalesce(s.regulation_ref, '') AS regulation_ref", "coalesce(s.should_flag, false) AS should_flag",
        "coalesce(s.type, 'cases') AS type", "coalesce(s.expected, map()) AS expected",
        "coalesce(s.templates, array()) AS templates", "coalesce(s.identities, array()) AS identities",
        "coalesce(s.cases, array()) AS cases")
