"""Scoring a stream of texts with the lexical control."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from ..operators.lexical import Lexicon
from ..operators.verdicts import lexical_verdicts


def score_texts(texts: DataFrame, lexicon: Lexicon, clauses: Mapping[str, str], keep: Sequence[str] = ("id",),
                text: str = "text", guard: bool = False) -> DataFrame:
    """The batch verdict expressions, applied row by row without state."""
    return lexical_verdicts(texts, lexicon, clauses, list(keep), text, guard)
