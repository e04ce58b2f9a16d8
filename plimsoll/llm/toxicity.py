"""Toxicity scores from a factorization machine over hashed terms.

Terms are words and byte 5-grams of words, hashed to a fixed number of columns, of which those that
tell the classes apart are chosen. The machine scores a
text by a bias, a weight for each of its terms and, for each pair of terms, the product of the terms'
factors, so that a pair such as an insult and a mention of a group can count for more than its parts;
the pairs are summed in time linear in the number of terms.

Training uses a bounded sample of labelled rows (`sample`, drawn by a hash) in one task; the model has
a bounded size and scores each whole text in one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plimsoll.llm.columns import drawn_below
from plimsoll.llm.textbytes import groups, mixed, text_bytes, word_hashes, words

COLUMNS = 1 << 20
#: Columns that the machine is trained over, the texts that such a term must stand in, and its chi-squared.
CHOSEN = 2048
LEAST_TEXTS = 5
STRENGTH = 15.0
FACTORS = 8
EPOCHS = 20
RATE = 0.1
DECAY = 1e-4
STEP_TEXTS = 32
SAMPLE = 12_000
GRAM = 5
THRESHOLD = 0.7
LOWERED = "_fm_lowered"


def terms(texts: pa.Array, columns: int = COLUMNS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct term columns of each text, and the text of each."""
    data, offsets = text_bytes(texts)
    starts, ends, doc = words(data, offsets)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    whole = word_hashes(data, starts, ends)
    pieces, owner = [whole], [doc]
    if len(data) >= GRAM:
        code = np.zeros(len(data) - GRAM + 1, np.uint64)
        for i in range(GRAM):
            code = code * np.uint64(263) + data[i:len(data) - GRAM + 1 + i]
        # a gram counts where it lies inside one word
        word_at = np.zeros(len(data), np.int64)
        word_at[starts] = 1
        word_at = np.cumsum(word_at) - 1
        at = np.arange(len(code))
        inside = (at >= starts[word_at[:len(code)]]) & (at + GRAM <= ends[word_at[:len(code)]]) & (word_at[:len(code)] >= 0)
        pieces.append(mixed(code[inside]))
        owner.append(doc[word_at[:len(code)][inside]])
    column = (np.concatenate(pieces) >> np.uint64(64 - columns.bit_length() + 1)).astype(np.int64)
    key = np.unique(np.concatenate(owner) * columns + column)
    return key % columns, key // columns


def lookup(columns: np.ndarray) -> np.ndarray:
    """The place of each chosen column, -1 for the others."""
    place = np.full(COLUMNS, -1, np.int32)
    place[columns] = np.arange(len(columns), dtype=np.int32)
    return place


class Machine:
    """A factorization machine over the presence of chosen terms."""

    def __init__(self, bias: float, weights: np.ndarray, factors: np.ndarray):
        self.bias, self.weights, self.factors = bias, weights, factors

    def logits(self, column: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores before the logistic function, and each text's factor sums. Terms are sorted by text."""
        linear = np.bincount(doc, self.weights[column], n)
        sums = np.zeros((n, self.factors.shape[1]), np.float32)
        squares = np.zeros(n, np.float32)
        if len(doc):
            held, first = np.unique(doc, return_index=True)
            own = self.factors[column]
            sums[held] = np.add.reduceat(own, first)
            squares[held] = np.add.reduceat((own * own).sum(axis=1), first)
        return self.bias + linear + 0.5 * ((sums * sums).sum(axis=1) - squares), sums

    def probabilities(self, texts: pa.Array, place: np.ndarray) -> np.ndarray:
        column, doc = terms(texts)
        inside = place[column] >= 0
        z, _ = self.logits(place[column[inside]], doc[inside], len(texts))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def chosen(texts: list[pa.Array], labels: np.ndarray, most: int = CHOSEN, least: int = LEAST_TEXTS) -> np.ndarray:
    """The columns that tell the classes apart best (chi-squared), among those in `least` texts or more."""
    held, toxic, at = np.zeros(COLUMNS, np.float64), np.zeros(COLUMNS, np.float64), 0
    for part in texts:
        column, doc = terms(part)
        held += np.bincount(column, minlength=COLUMNS)
        toxic += np.bincount(column[labels[at + doc] == 1], minlength=COLUMNS)
        at += len(part)
    n, p = len(labels), labels.sum()
    other = held - toxic
    gap = toxic * (n - p - other) - other * (p - toxic)
    spread = np.maximum(held * (n - held) * max(p, 1) * max(n - p, 1), 1.0)
    power = np.where(held >= least, n * gap * gap / spread, 0.0)
    best = np.argsort(-power, kind="stable")[:most]
    return np.sort(best[power[best] > STRENGTH])


def trained(texts: list[pa.Array], labels: np.ndarray, seed: int = 11) -> tuple[np.ndarray, Machine]:
    """The chosen columns and a machine over them, by adaptive gradient steps over small groups of texts."""
    rng = np.random.default_rng(seed)
    columns = chosen(texts, labels)
    positive = float(np.clip(labels.mean() if len(labels) else 0.0, 1e-3, 1 - 1e-3))
    machine = Machine(float(np.log(positive / (1 - positive))), np.zeros(len(columns), np.float32),
                      rng.normal(0, 0.02, (len(columns), FACTORS)).astype(np.float32))
    place = lookup(columns)
    column, doc, seen = [], [], 0
    for part in texts:
        c, d = terms(part)
        inside = place[c] >= 0
        column.append(place[c[inside]]), doc.append(d[inside] + seen)
        seen += len(part)
    if not seen or not len(columns):
        return columns, machine
    column, doc = np.concatenate(column), np.concatenate(doc)
    begin = np.searchsorted(doc, np.arange(seen + 1))
    past_w, past_f = np.full(len(columns), 1e-2, np.float32), np.full(len(columns), 1e-2, np.float32)
    for _ in range(EPOCHS):
        order = rng.permutation(seen)
        for at in range(0, seen, STEP_TEXTS):
            rows = order[at:at + STEP_TEXTS]
            spans = [np.arange(begin[r], begin[r + 1]) for r in rows]
            c = column[np.concatenate(spans)]
            d = np.repeat(np.arange(len(rows)), [len(x) for x in spans])
            z, sums = machine.logits(c, d, len(rows))
            slope = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[rows]).astype(np.float32) / len(rows)
            machine.bias -= RATE * float(slope.sum())
            grad_w = np.bincount(c, slope[d], len(columns)).astype(np.float32) + DECAY * machine.weights
            pull = slope[d][:, None] * (sums[d] - machine.factors[c])
            grad_f = np.stack([np.bincount(c, pull[:, k], len(columns)) for k in range(FACTORS)], axis=1)
            grad_f = grad_f.astype(np.float32) + DECAY * machine.factors
            past_w += grad_w * grad_w
            past_f += (grad_f * grad_f).mean(axis=1)
            machine.weights -= RATE * grad_w / np.sqrt(past_w)
            machine.factors -= 0.3 * RATE * grad_f / np.sqrt(past_f)[:, None]
    return columns, machine


def _fitted(table: pa.Table) -> pa.Table:
    table = table.sort_by([("draw", "ascending"), ("y", "ascending")]).combine_chunks()
    parts = [g.column("text") for b in table.select(["text"]).to_batches() for g in groups(b)]
    columns, machine = trained(parts, table.column("y").to_numpy().astype(np.int64))
    return pa.table({"columns": [columns.astype(np.int32).tobytes()], "weights": [machine.weights.tobytes()],
                     "factors": [machine.factors.tobytes()], "bias": [machine.bias]})


def drawn_texts(docs: DataFrame, labels: DataFrame, label: str, sample: int) -> DataFrame:
    """text, y, draw: at most `sample` rows, one for each distinct (doc_id, label) drawn, drawn by a hash of doc_id.

    Of documents that repeat a doc_id the least text is taken; a doc_id with both labels gives a row
    of each.
    """
    marks = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).select(
        "doc_id", F.col(label).cast("int").alias("y"), F.xxhash64("doc_id").alias("draw"))
    n = marks.agg(F.approx_count_distinct("doc_id")).first()[0]
    marks = marks.where(drawn_below(F.col("draw"), sample, F.lit(float(max(n, 1))))).distinct()
    marks = marks.orderBy("draw", "doc_id", "y").limit(sample)
    rows = docs.select("doc_id", F.lower(F.coalesce("text", F.lit(""))).alias("text")).join(
        F.broadcast(marks), "doc_id")
    return rows.groupBy("doc_id", "y", "draw").agg(F.min("text").alias("text")).select("text", "y", "draw")


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic",
        sample: int = SAMPLE) -> tuple[np.ndarray, Machine]:
    """Chosen columns and machine from `docs` (doc_id, text) and `labels` (doc_id and a 0/1 label).

    At most `sample` texts, drawn by a hash, are used; without any, all texts score alike. The draw
    is made on the labels alone, so only the texts drawn are moved, by a join that sends the drawn
    labels (at most `sample` rows) to every task.
    """
    drawn = drawn_texts(docs, labels, label, sample).withColumn("all", F.lit(0))
    for r in drawn.groupBy("all").applyInArrow(
            _fitted, "columns binary, weights binary, factors binary, bias double").collect():
        return np.frombuffer(r["columns"], np.int32), Machine(
            r["bias"], np.frombuffer(r["weights"], np.float32),
            np.frombuffer(r["factors"], np.float32).reshape(-1, FACTORS))
    return np.zeros(0, np.int32), Machine(-5.0, np.zeros(0, np.float32), np.zeros((0, FACTORS), np.float32))


def toxicity(docs: DataFrame, columns: np.ndarray, machine: Machine, keep: list[str] | None = None,
             threshold: float = THRESHOLD) -> DataFrame:
    """`docs` (or its columns `keep`) with score and predicted added, in place of any so named.

    Null and empty texts get the score of a text without terms. Every whole text is scored; the
    model, at most CHOSEN columns, is part of the function that tasks run.
    """
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = lookup(columns)
        for batch in batches:
            slim = pa.record_batch([batch.column(LOWERED)], names=["text"])
            p = np.concatenate([machine.probabilities(g.column("text"), place) for g in groups(slim)] or [np.zeros(0)])
            names = [n for n in batch.schema.names if n != LOWERED]
            yield pa.record_batch([*[batch.column(n) for n in names], pa.array(p),
                                   pa.array((p >= threshold).astype(np.int32))], names=[*names, "score", "predicted"])

    fields = docs.select(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)]).drop("score", "predicted")
    wide = docs.select(*[F.col(f"`{c}`") for c in fields.columns],
                       F.lower(F.coalesce("text", F.lit(""))).alias(LOWERED))
    return wide.mapInArrow(score, StructType(fields.schema.fields).add("score", "double").add("predicted", "integer"))
