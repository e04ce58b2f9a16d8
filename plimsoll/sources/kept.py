"""Results and models kept under a fingerprint of their inputs and settings.

The same inputs and settings find what an earlier run stored, in the same application or another that
shares the folder; a changed row, schema or setting has another fingerprint and is computed anew.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .stage import shared_folder


def fingerprint(tables: Sequence[DataFrame], settings: object = None) -> str:
    """A digest of the rows of the tables, in any order, of their schemas and of ``repr(settings)``.

    One aggregate a table: rows are counted and two hashes of each are added up, so nothing is
    shuffled but a row a task. Columns of map type are not supported.
    """
    parts = [repr(settings)]
    for table in tables:
        columns = sorted(table.columns)
        value = [F.col(f"`{c}`") for c in columns]
        sums = [F.sum(F.xxhash64(F.lit(salt), *value).cast("decimal(38,0)")).alias(f"h{salt}") for salt in (1, 2)]
        row = table.agg(F.count(F.lit(1)).alias("n"), *sums).first()
        parts.append(repr([(c, dict(table.dtypes)[c]) for c in columns] + list(row)))
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()[:32]


def kept_path(spark: SparkSession, name: str, tables: Sequence[DataFrame], settings: object = None) -> str:
    """Where the result called ``name`` of these inputs and settings is kept, in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/plimsoll/kept/{name}-{fingerprint(tables, settings)}"


def complete(spark: SparkSession, path: str) -> bool:
    """Whether a table was written there to the end; a writer that was lost leaves no mark of success."""
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


def kept_table(spark: SparkSession, name: str, tables: Sequence[DataFrame], settings: object,
               compute: Callable[[], DataFrame]) -> DataFrame:
    """The stored result for these inputs and settings, or what ``compute()`` returns, stored and read back."""
    path = kept_path(spark, name, tables, settings)
    if not complete(spark, path):
        compute().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
