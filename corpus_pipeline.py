"""The training-data pipeline: five operators in a row, each on all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plimsoll.llm import decontaminate, language_id, mixing, ngram_join, registry, token_files
from plimsoll.sources.stage import staged

#: Pieces that a worker of the last stage remembers, some 80 MB; the other stages run in the same workers.
REMEMBERED = 300_000

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language model doesn't reject."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"), "doc_id", "text", "lang")
    found = language_id.language_id(rows, docs.where(~registry.held_out()), keep=["whole"])
    return found.where("not rejected").select("whole.*")


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return ngram_join.distinct_documents(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of the benchmark."""
    return decontaminate.clean_documents(docs, registry.table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources, as documents: a row for each pass that takes words of a document."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix written as token files and read back: doc_id, start, n_tokens, ids_crc32."""
    return token_files.token_files(docs, registry.tokenizer_path(), with_ids=False, remembered=REMEMBERED)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", known_language),
    ("ngram_jaccard_join", one_of_near_copies),
    ("benchmark_decontamination", decontaminated),
    ("source_mix", mixed),
    ("token_files", tokens),
]

#: Not expressible in SQL: learned classification, hashed draws and tokenisation.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet and reread as the next one's input."""
    docs = registry.table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir))
    return docs
