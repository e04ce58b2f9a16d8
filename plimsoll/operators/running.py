"""Running totals over a table-sized order without a table-sized window partition.

A plain ``sum().over(partitionBy(group).orderBy(key))`` sorts each group in one task. Here the
order is cut twice into value ranges: totals per range give each range its starting value, and
only the rows inside the finest range are windowed. The ranges are functions of the key, so
re-running a lost task lands every row in the same range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.stage import staged

def value_range(scaled: Column) -> Column:
    """Whole-number range of a scaled key. Declared never NULL, so that joins on it add no filter
    and the readers of the input keep identical plans, which lets Spark run their shuffle once."""
    return F.coalesce(F.floor(scaled).cast("long"), F.lit(0).cast("long"))


def running_totals(df: DataFrame, by: Sequence[str], coarse: Sequence[str], fine: Sequence[str],
                   order: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Adds ``before_<s>`` for each summed column: the total of all rows earlier in the order.

    ``coarse`` and then ``fine`` must be ascending in the order within ``by``; ``order`` settles
    rows inside one fine range.
    """
    by, coarse, fine, order = list(by), list(coarse), list(fine), list(order)
    start = Window.unboundedPreceding
    keys = by + coarse + fine
    ranges = df.groupBy(*keys).agg(*[F.sum(s).alias(f"t_{s}") for s in sums])
    blocks = ranges.groupBy(*by, *coarse).agg(*[F.sum(f"t_{s}").alias(f"b_{s}") for s in sums])

    over_blocks = Window.partitionBy(*by).orderBy(*coarse).rowsBetween(start, -1)
    blocks = blocks.select(
        *by, *coarse, *[F.coalesce(F.sum(f"b_{s}").over(over_blocks), F.lit(0)).alias(f"o_{s}") for s in sums])
    over_ranges = Window.partitionBy(*by, *coarse).orderBy(*fine).rowsBetween(start, -1)
    ranges = ranges.select(
        *keys, *[F.coalesce(F.sum(f"t_{s}").over(over_ranges), F.lit(0)).alias(f"r_{s}") for s in sums])
    starts = ranges.join(blocks, by + coarse).select(
        *keys, *[(F.col(f"o_{s}") + F.col(f"r_{s}")).alias(f"s_{s}") for s in sums])

    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(start, -1)
    local = df.select(
        *df.columns, *[F.coalesce(F.sum(s).over(inside), F.lit(0)).alias(f"l_{s}") for s in sums])
    return local.join(starts, keys).select(
        *df.columns, *[(F.col(f"s_{s}") + F.col(f"l_{s}")).alias(f"before_{s}") for s in sums])


def ranked_parts(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The rows in ``order``, stored in ranges of about equal size, with their ``__part`` and place ``__at`` in it.

    Ranges are cut at splitters that Spark samples from the keys, so however the values lie, a task
    gets its share of the rows; only rows that agree in all of ``order`` must stay together. The
    result is stored because another run could draw other splitters.
    """
    place = F.monotonically_increasing_id()  # 33 bits of place below the number of the partition
    found = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__place", place)
    return staged(found).select(*df.columns, F.shiftright("__place", 33).alias("__part"),
                                F.col("__place").bitwiseAND((1 << 33) - 1).alias("__at"))


def numbered(df: DataFrame, coarse: Sequence[str], position: str, name: str = "seq") -> DataFrame:
    """Gap-free 1..n numbers in the order (coarse..., position) for a table of any size; positions may be sparse."""
    parts = ranked_parts(df, [*coarse, position])
    counts = parts.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    starts = counts.select("__part", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__start"))
    return parts.join(starts, "__part").select(*df.columns, (F.col("__start") + F.col("__at") + 1).alias(name))
