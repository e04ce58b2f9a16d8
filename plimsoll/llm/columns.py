"""Column helpers that several operators share; all stay inside the JVM."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Separators of the letter-and-digit words: every ASCII character but a-z, A-Z and 0-9.
NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: White-space separated words.
SPACED_WORD = r"[^\x20\x09-\x0D]+"


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else; `lower` does the same, faster, where all is ASCII."""
    return (F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
            .otherwise(F.lower(text)))


def plain_words(text: Column) -> Column:
    """Lower-cased words joined by single spaces; empty for null and for texts without words."""
    return F.trim(F.regexp_replace(lower_ascii(F.coalesce(text, F.lit(""))), NOT_WORD, " "))


def word_count(joined: Column) -> Column:
    """Number of words in what `plain_words` returns."""
    return F.when(joined == "", F.lit(0)).otherwise(
        F.length(joined) - F.length(F.replace(joined, F.lit(" "), F.lit(""))) + 1).cast("long")


def row_hash(text: Column) -> Column:
    """Tells rows apart that carry the same doc_id; equal rows stay equal."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def drawn_below(draw: Column, wanted: int, of: Column) -> Column:
    """Whether a 64-bit hash is among the least `2 * wanted` or so `of` that many; all are where there are fewer.

    Cuts a table to about the rows that a draw of the `wanted` least can keep, before they meet.
    """
    return draw.cast("double") < F.lit(float(-(1 << 63))) + F.lit(float(1 << 64)) * (2.0 * wanted / of + 1e-15)


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of `docs` whose doc_id and row_hash are not a row of `gone` (two columns); nulls match each other."""
    name = "_gone"
    while any(column.startswith(name) for column in docs.columns):
        name = f"_{name}"
    same = F.col("doc_id").eqNullSafe(F.col(f"{name}_doc_id")) & (row_hash(F.col("text")) == F.col(f"{name}_row"))
    return docs.join(gone.toDF(f"{name}_doc_id", f"{name}_row").distinct(), same, "left_anti")
