"""Labelled corpus: typed scan and integrity gates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.profile import with_lengths
from ..operators.shape import to_long


class CorpusError(ValueError):
    """The corpus broke an integrity gate."""


def corpus_schema(labels: Sequence[str], key: str = "id", text: str = "comment_text") -> T.StructType:
    return T.StructType(
        [T.StructField(key, T.StringType()), T.StructField(text, T.StringType())]
        + [T.StructField(x, T.IntegerType()) for x in labels])


def read_corpus(spark: SparkSession, path: str, labels: Sequence[str], fmt: str = "csv",
                key: str = "id", text: str = "comment_text") -> DataFrame:
    """Typed lazy scan. CSV fields may hold quoted line breaks, which makes a CSV file one task:
    convert to Parquet once with :func:`land_corpus` and read that from then on."""
    if fmt == "csv":
        header = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
        # the header decides which columns exist; the schema then only fixes their types
        names = header.csv(path).columns
        require_columns(names, [key, text, *labels])
        typed = {f.name: f for f in corpus_schema(labels, key, text)}
        schema = T.StructType([typed.get(n, T.StructField(n, T.StringType())) for n in names])
        return header.schema(schema).csv(path)
    df = spark.read.format(fmt).load(path)
    require_columns(df.columns, [key, text, *labels])
    return df


def land_corpus(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def require_columns(present: Sequence[str], wanted: Sequence[str]) -> None:
    """Fails before any job when columns are absent."""
    missing = [c for c in wanted if c not in present]
    if missing:
        raise CorpusError(f"Missing expected columns: {missing}")


def gate_report(df: DataFrame, labels: Sequence[str], key: str = "id", pattern: str = "{}") -> DataFrame:
    """One row per gate with its failure count. One shuffle on the key covers all gates.

    A key that repeats counts once per surplus row; a NULL label is outside {0, 1} and fails.
    """
    bad = [F.sum(F.when(F.col(pattern.format(x)).isin(0, 1), 0).otherwise(1)).alias(f"bad_{x}") for x in labels]
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("copies"), *bad)
    totals = per_key.agg(
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("bad___key"),
        *[F.coalesce(F.sum(f"bad_{x}"), F.lit(0)).alias(f"bad_{x}") for x in labels])
    rows = to_long(totals, ["__key", *labels], [], {"failures": "bad_{}"}, key="subject")
    is_key = F.col("subject") == "__key"
    return rows.select(
        F.when(is_key, "unique_key").otherwise("binary_domain").alias("gate"),
        F.when(is_key, F.lit(key)).otherwise(F.col("subject")).alias("subject"),
        "failures",
        F.when(F.col("failures") == 0, "PASS").otherwise("FAIL").alias("status"))


def load_corpus(spark: SparkSession, path: str, labels: Sequence[str], fmt: str = "csv",
                rows: int | None = None, add_length: bool = True, key: str = "id",
                text: str = "comment_text") -> DataFrame:
    """Scan, gate and return the corpus; any failed gate raises with its count."""
    df = read_corpus(spark, path, labels, fmt, key, text)
    if rows is not None:
        df = df.orderBy(key).limit(rows)
    failed = [r for r in gate_report(df, labels, key).collect() if r["failures"]]
    if failed:
        raise CorpusError("; ".join(f"{r['gate']}({r['subject']}): {r['failures']}" for r in failed))
    return with_lengths(df, text) if add_length else df
