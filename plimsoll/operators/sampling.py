"""Deterministic splits, samples and review excerpts.

Every draw is a function of the row key and a seed, so the outcome does not depend on how
the data is partitioned or in which order tasks finish.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import measures as M
from ..functions import text as T
from .profile import any_label
from .shape import exploded


def with_split(df: DataFrame, key: str = "id", seed: int = 42, test_size: float = 0.2) -> DataFrame:
    """Adds ``split``: 'train' or 'test'."""
    return df.withColumn(
        "split", F.when(M.hash_unit(F.col(key), seed) < 1 - test_size, "train").otherwise("test"))


def head(df: DataFrame, n: int, key: str = "id") -> DataFrame:
    """First n rows in key order (a top-n per partition, then a merge)."""
    return df.orderBy(key).limit(n)


def top_per_stratum(df: DataFrame, stratum: str, order: str, k: int) -> DataFrame:
    """The k rows with the smallest ``order`` in each stratum.

    The rank filter is a literal, so Spark cuts each stratum to k rows before the shuffle;
    a stratum holding most of the table still sends at most k rows per map task.
    """
    w = Window.partitionBy(stratum).orderBy(order)
    return df.withColumn("pick", F.row_number().over(w)).where(F.col("pick") <= k)


def balanced_sample(df: DataFrame, labels: Sequence[str], n: int, key: str = "id", seed: int = 42) -> DataFrame:
    """n/2 flagged rows and clean rows for the rest, shuffled; a short flagged stratum is filled with clean."""
    keyed = df.select(key, any_label(labels).alias("flagged"), M.hash_order(F.col(key), seed).alias("draw"))
    short = top_per_stratum(keyed, "flagged", "draw", n)  # at most 2n rows from here on
    flagged = F.col("flagged") & (F.col("pick") <= n // 2)
    taken = F.count_if(flagged).over(Window.partitionBy())
    ranked = short.select(key, "flagged", "draw", "pick", taken.alias("taken"))
    chosen = ranked.where(flagged | (~F.col("flagged") & (F.col("pick") <= F.lit(n) - F.col("taken"))))
    return chosen.select(key, "flagged", "draw").orderBy("draw")


def rows_of_sample(rows: DataFrame, sample: DataFrame, key: str = "id") -> DataFrame:
    """The full rows of a drawn sample. The sample's size is a parameter of its draw, so it is sent
    to the rows rather than the rows being shuffled to it."""
    return rows.join(F.broadcast(sample.select(key)), key, "left_semi")


def label_samples(df: DataFrame, texts: DataFrame, labels: Sequence[str], stems: Sequence[str],
                  k: int = 2, key: str = "id", seed: int = 42, width: int = 240) -> DataFrame:
    """k redacted excerpts per label with the row's other labels.

    The draw runs on keys alone; the text is fetched afterwards for the chosen rows only.
    """
    strata = [F.when(F.col(f"y_{x}") == 1, F.lit(x)) for x in labels]
    marked = df.select(key, F.array_compact(F.array(*strata)).alias("present"),
                       M.hash_order(F.col(key), seed).alias("draw"))
    long = exploded(marked, [key, "present", "draw"], F.col("present"), "category")
    chosen = top_per_stratum(long, "category", "draw", k)
    others = F.concat_ws(", ", F.array_remove("present", F.col("category")))
    chosen = chosen.select(key, "category", "pick",
                           F.when(others == "", "-").otherwise(others).alias("other_labels"))
    # k rows per label: a declared bound, safe to broadcast
    found = texts.select(key, "text").join(F.broadcast(chosen), key)
    return found.select(
        "category", "pick", key, "other_labels",
        F.length("text").alias("chars"),
        T.redact(F.col("text"), stems, width).alias("redacted_excerpt"))
