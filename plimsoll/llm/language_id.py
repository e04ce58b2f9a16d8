"""Language identification by nearest centroids.

A text is the unit-length TF-IDF vector of its hashed byte n-grams. Each language has several
centroids, found by clustering the vectors of a sample of its documents, and a text gets the
language of the centroid with the largest cosine. Texts too far from every centroid are rejected.

The sample is bounded: `per_language` documents of each language, chosen by a hash. Everything that
is learned (document frequencies, centroids, the distance limit) comes from it; scoring reads every
whole text in one pass without a shuffle, with the model (a few hundred kB) in the closure.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plimsoll.llm.columns import drawn_below
from plimsoll.llm.textbytes import groups, text_bytes, tidied
from plimsoll.sources.stage import staged

SIZES = (2, 3)
BUCKETS = 1 << 13
PER_LANGUAGE = 600
CENTROIDS = 4
#: Rejected below this part of the cosine that nearly all of the sample reaches.
SLACK = 0.25
UNKNOWN = "und"
LOWERED, LETTERED = "_lid_lowered", "_lid_lettered"
ROWS = 128


def letters(text: Column) -> Column:
    """Lower-cased letters, with one space for whatever stands between words."""
    return F.regexp_replace(F.lower(text), r"\P{L}+", " ")


def gram_counts(texts: pa.Array, buckets: int = BUCKETS) -> np.ndarray:
    """Counts of each text's hashed byte n-grams, a row per text."""
    data, offsets = text_bytes(texts)
    out = np.zeros((len(texts), buckets), np.float32)
    wide = data.astype(np.uint32)
    code = wide
    for n in range(2, max(SIZES) + 1):
        code = code[:-1] * np.uint32(257) + wide[n - 1:] if len(code) > 1 else code[:0]
        if n not in SIZES or not len(code):
            continue
        slot = ((code + np.uint32(n)) * np.uint32(2654435761)) >> np.uint32(32 - buckets.bit_length() + 1)
        for row in range(len(texts)):
            low, high = offsets[row], offsets[row + 1] - n + 1
            if high > low:
                out[row] += np.bincount(slot[low:high], minlength=buckets)
    return out


def unit(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Sublinear TF-IDF vectors of length one; a text without n-grams stays zero."""
    weighted = np.log1p(counts) * idf
    return weighted / np.maximum(np.linalg.norm(weighted, axis=1, keepdims=True), 1e-12)


def clustered(vectors: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """At most k unit centroids: seeds far from each other, then spherical k-means."""
    seeds = [int(np.argmax(vectors @ vectors.mean(axis=0)))]
    near = vectors @ vectors[seeds[0]]
    while len(seeds) < min(k, len(vectors)):
        seeds.append(int(np.argmin(near)))
        near = np.maximum(near, vectors @ vectors[seeds[-1]])
    centers = vectors[seeds]
    for _ in range(rounds):
        own = np.argmax(vectors @ centers.T, axis=1)
        means = [vectors[own == i].mean(axis=0) if (own == i).any() else centers[i] for i in range(len(centers))]
        centers = np.stack([m / max(np.linalg.norm(m), 1e-12) for m in means])
    return centers


def _counts(texts: pa.Table) -> np.ndarray:
    return np.concatenate([gram_counts(g.column("text")) for b in texts.combine_chunks().to_batches()
                           for g in groups(b)])


def _held(table: pa.Table) -> pa.Table:
    """A language's texts, and how many of them hold each n-gram."""
    counts = _counts(table)
    held = (counts > 0).sum(axis=0).astype(np.int32)
    return pa.table({"n": pa.array([len(counts)], pa.int64()), "held": pa.array([held.tobytes()], pa.binary())})


def drawn_texts(train: DataFrame, per_language: int) -> DataFrame:
    """text, lang, draw: at most `per_language` rows of each language, one for each doc_id drawn, drawn by a hash of it.

    Of rows that repeat a doc_id and a language, the least text is taken.
    """
    rows = train.where("lang is not null and text is not null and doc_id is not null").select(
        "doc_id", "lang", F.xxhash64("doc_id").alias("draw"))
    # drawn on ids: a row per language is sent to every task, then the ids drawn are, and only their texts move
    sizes = rows.groupBy(F.col("lang").alias("of")).agg(F.approx_count_distinct("doc_id").alias("n"))
    near = rows.join(F.broadcast(sizes), F.col("lang") == F.col("of")).where(
        drawn_below(F.col("draw"), per_language, F.col("n"))).select("doc_id", "lang", "draw").distinct()
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "doc_id"))
    drawn = near.withColumn("rank", rank).where(F.col("rank") <= per_language).select("doc_id", "lang", "draw")
    texts = train.where("text is not null").select("doc_id", letters(F.col("text")).alias("text"),
                                                   F.col("lang").alias("own"))
    met = texts.join(F.broadcast(drawn), "doc_id").where(F.col("own") == F.col("lang"))
    return met.groupBy("doc_id", "lang", "draw").agg(F.min("text").alias("text")).select("text", "lang", "draw")


def fit(train: DataFrame, per_language: int = PER_LANGUAGE) -> list[tuple[str, str | None, bytes]]:
    """The model from rows with doc_id, text and lang; at most `per_language` documents of each language are used.

    Rows without a doc_id are not drawn. Each language is counted and clustered in a task of its own, which
    holds `per_language` vectors; the driver holds one vector of counts and CENTROIDS centroids a language.
    """
    sample = staged(drawn_texts(train, per_language))
    by_lang = sample.groupBy("lang")
    n, held = 0, np.zeros(BUCKETS, np.int64)
    for row in by_lang.applyInArrow(_held, "n long, held binary").toLocalIterator():
        n, held = n + row["n"], held + np.frombuffer(row["held"], np.int32)
    if not n:
        return []
    idf = (np.log((1 + n) / (1 + held)) + 1).astype(np.float32)

    def cluster(key: tuple, table: pa.Table) -> pa.Table:
        centers = clustered(unit(_counts(table.sort_by("draw")), idf), CENTROIDS).astype(np.float32)
        return pa.table({"lang": pa.array([key[0].as_py()] * len(centers), pa.string()),
                         "place": pa.array(np.arange(len(centers), dtype=np.int32)),
                         "weights": pa.array([c.tobytes() for c in centers], pa.binary())})

    found = by_lang.applyInArrow(cluster, "lang string, place int, weights binary").collect()
    found = [(r["lang"], bytes(r["weights"])) for r in sorted(found, key=lambda r: (r["lang"], r["place"]))]
    centers = np.array([np.frombuffer(w, np.float32) for _, w in found])

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in groups(batch):
                for at in range(0, group.num_rows, ROWS):
                    near = unit(gram_counts(group.column("text").slice(at, ROWS)), idf) @ centers.T
                    yield pa.record_batch([pa.array(near.max(axis=1).astype(np.float64))], names=["reached"])

    least = sample.select("text").mapInArrow(reach, "reached double").agg(F.percentile("reached", F.lit(0.01))).first()[0]
    limit = np.array([SLACK * least], np.float32)
    return [("idf", None, idf.tobytes()), ("limit", None, limit.tobytes()), *(("centroid", lang, w) for lang, w in found)]


def language_id(docs: DataFrame, train: DataFrame, per_language: int = PER_LANGUAGE,
                keep: list[str] | None = None) -> DataFrame:
    """`docs` (or its columns `keep`) with lang_pred, score and rejected added, in place of any so named.

    lang_pred is a language of `train`, or `und` for null texts and texts without a letter, and when
    nothing could be learned. Of equal cosines the first language by name wins; repeated rows score
    alike. score is the cosine to the nearest centroid, 0 to 1. rejected is true
    for `und` and for texts farther from all centroids than the limit learned from the sample.
    """
    model = fit(train, per_language)
    idf = next((np.frombuffer(w, np.float32) for p, _, w in model if p == "idf"), None)
    limit = next((float(np.frombuffer(w, np.float32)[0]) for p, _, w in model if p == "limit"), 0.0)
    names = [lang for p, lang, _ in model if p == "centroid"]
    centers = np.array([np.frombuffer(w, np.float32) for p, _, w in model if p == "centroid"])
    added = pa.schema([("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cosines, best = np.zeros(batch.num_rows), np.zeros(batch.num_rows, int)
            done = 0
            slim = pa.record_batch([batch.column(LOWERED)], names=["text"])
            for group in groups(slim):
                for at in range(0, group.num_rows, ROWS):
                    texts = group.column("text").slice(at, ROWS)
                    if names:
                        near = unit(gram_counts(texts), idf) @ centers.T
                        best[done:done + len(texts)] = near.argmax(axis=1)
                        cosines[done:done + len(texts)] = near.max(axis=1)
                    done += len(texts)
            lettered = batch.column(LETTERED).to_numpy(zero_copy_only=False) & bool(names)
            cosines = np.where(lettered, np.clip(cosines, 0.0, 1.0), 0.0)
            lang = [names[b] if ok else UNKNOWN for b, ok in zip(best, lettered)]
            kept = [batch.column(i) for i, n in enumerate(batch.schema.names) if n not in (LOWERED, LETTERED)]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(lang, pa.string()), pa.array(cosines), pa.array(~lettered | (cosines < limit))],
                schema=pa.schema([f for f in batch.schema if f.name not in (LOWERED, LETTERED)] + list(added)))

    fields = docs.select(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)]).drop(
        "lang_pred", "score", "rejected")
    wide = docs.select(*[F.col(f"`{c}`") for c in fields.columns], letters(F.col("text")).alias(LOWERED),
                       F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias(LETTERED))
    schema = StructType(fields.schema.fields).add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return wide.mapInArrow(tidied(score), schema)
