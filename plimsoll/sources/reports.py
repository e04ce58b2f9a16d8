"""Writers for result tables, and re-reading them when they exist."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def absent(error: AnalysisException) -> bool:
    """Whether a read failed because there is nothing at the path, and for no other reason."""
    return error.getCondition() == "PATH_NOT_FOUND"


def write_table(df: DataFrame, path: str) -> None:
    """Overwrite a result table; use this for anything that grows with the corpus."""
    df.write.mode("overwrite").parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """One CSV part with a header, for aggregates of a few rows (scorecards, dashboards)."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_or_compute(spark: SparkSession, path: str, compute: Callable[[], DataFrame]) -> DataFrame:
    """The stored result if there is one, else compute, store and read it back."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if not absent(e):
            raise
        write_table(compute(), path)
        return spark.read.parquet(path)
