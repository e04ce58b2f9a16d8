"""What bag-of-words features need around the counting in :mod:`terms`: folding, vocabulary and weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .shape import to_long


def normalised(text: Column) -> Column:
    return T.fold_accents(F.lower(T.or_empty(text)))


def folded(text: Column) -> dict:
    """What :mod:`terms` is to be told for a text whose accents go."""
    return {"text": F.lower(T.or_empty(text)), "fold": True}


def vocabulary(statistics: DataFrame, min_df: int = 3, max_features: int = 30_000) -> DataFrame:
    """Tokens in at least ``min_df`` texts, cut to the most used; ties go to the smaller token."""
    return statistics.where(F.col("df") >= min_df).orderBy(F.desc("n"), "token").limit(max_features)


def with_idf(vocab: DataFrame, n_texts: DataFrame) -> DataFrame:
    """Adds idf = ln((1 + n) / (1 + df)) + 1; ``n_texts`` is a one-row, one-column count."""
    idf = F.log((1 + n_texts.scalar()) / (1 + F.col("df"))) + 1
    return vocab.select("token", "n", "df", idf.alias("idf"))


def class_weights(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Balanced weights n / (2 * class size) per label; NULL for an absent class."""
    totals = df.agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"y_{x}").alias(f"p_{x}") for x in labels])
    rows = to_long(totals, labels, ["n"], {"positives": "p_{}"})
    return rows.select(
        "category", "n", "positives",
        F.try_divide(F.col("n"), 2 * F.col("positives")).alias("weight_pos"),
        F.try_divide(F.col("n"), 2 * (F.col("n") - F.col("positives"))).alias("weight_neg"))
