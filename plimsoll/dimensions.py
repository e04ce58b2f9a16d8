"""Small declared tables (taxonomy, tiers, gates, rules) as DataFrames.

They are written out in code or configuration, so their size is known before any job runs;
that is why the operators may broadcast them by hint. Everything derived from data is left
to the optimizer's own size check.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TAXONOMY_COLUMNS = ["category", "definition", "clause", "harm_family", "regulation_ref", "severity_tier"]
TIER_COLUMNS = ["severity_tier", "severity", "threshold", "tolerance"]


def declared(spark: SparkSession, rows: Sequence[tuple], columns: Sequence[str]) -> DataFrame:
    """A literal relation: planned as local data, no job needed to read it."""
    data = {name: [row[i] for row in rows] for i, name in enumerate(columns)}
    return spark.createDataFrame(pa.table(data))


def taxonomy(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """Category table with its position, which is the label order everywhere else."""
    return declared(spark, [(i, *row) for i, row in enumerate(rows)], ["ord", *TAXONOMY_COLUMNS])


def tiers(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    return declared(spark, rows, TIER_COLUMNS)


def with_tiers(taxonomy_df: DataFrame, tiers_df: DataFrame) -> DataFrame:
    """Taxonomy rows with severity rank, decision threshold and drift tolerance."""
    return taxonomy_df.join(F.broadcast(tiers_df), "severity_tier")


def annotate(frame: DataFrame, dimension: DataFrame, columns: Sequence[str], key: str = "category") -> DataFrame:
    """Attach dimension columns; a key that the dimension does not know fails the job."""
    known = dimension.select(key, *columns, F.lit(True).alias("__known"))
    joined = frame.join(F.broadcast(known), key, "left")
    unknown = F.raise_error(F.concat(F.lit(f"{key} missing from dimension: "), F.col(key).cast("string")))
    first, *rest = columns
    checked = F.when(F.col("__known"), F.col(first)).otherwise(unknown.cast(known.schema[first].dataType))
    return joined.select(*frame.columns, checked.alias(first), *rest)
