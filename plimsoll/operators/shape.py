"""Moves between wide rows (one column per label) and long rows (one row per label)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_long(df: DataFrame, labels: Sequence[str], keep: Sequence[str], measures: dict[str, str],
            key: str = "category") -> DataFrame:
    """One row per label; ``measures`` maps an output column to a wide name pattern such as ``"y_{}"``.

    Also used on one-row aggregates, where it turns wide sums into a small report.
    """
    structs = [
        F.struct(F.lit(label).alias(key),
                 *[F.col(pattern.format(label)).alias(out) for out, pattern in measures.items()])
        for label in labels
    ]
    return df.select(*keep, F.inline(F.array(*structs)))


def exploded(df: DataFrame, keep: Sequence[str], array: Column, name: str) -> DataFrame:
    """One row per array element; empty arrays give none.

    The outer form is used because the plain one makes the optimizer add a "size > 0" filter,
    which computes a derived array a second time, next to the scan.
    """
    return df.select(*keep, F.explode_outer(array).alias(name)).where(F.col(name).isNotNull())
