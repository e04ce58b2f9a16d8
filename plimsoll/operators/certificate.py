"""A certificate that fitted heads are the optimum they claim to be, from tables alone.

The loss of a head, sum(w * logloss) + ||b||^2 / (2c), is strictly convex in the coefficients, so the
one point with a zero gradient is its minimum. Features are built anew in long form from the texts,
the coefficients are read as a table, and each entry of the gradient is one aggregate:
sum(w * (p - y) * x) + b / c for a token, sum(w * (p - y)) for the intercept. Neither the solver nor
the feature stages of the model take part.
"""

from __future__ import annotations


import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.stage import staged
from . import features, terms
from .champion import Champion
from .shape import to_long



def coefficient_table(model: Champion, train: DataFrame) -> DataFrame:
    """token and b_<label>: the vocabulary by labels, wide."""
    return train.sparkSession.createDataFrame(pa.table(
        {"token": model.tokens, **{f"b_{x}": model.heads[x].coefficients.toArray() for x in model.labels}}))


def certificate(model: Champion, train: DataFrame, key: str = "id", text: str = "text", c: float = 4.0,
                balanced: bool = True, min_df: int = 3, max_features: int = 30_000) -> DataFrame:
    """A row per label: category, n_rows, n_positive, n_features, weighted_share, gradient and score_gap.

    ``gradient`` is the largest entry of the gradient of the mean loss, ``weighted_share`` the mean
    score by class weights (the intercept's condition makes it the positives' share of the weights),
    ``score_gap`` the largest difference between a score worked out here and the model's. ``key``
    must be unique. ``n_features`` counts tokens that vocabulary and coefficients both hold.
    """
    labels, ys = model.labels, [f"y_{x}" for x in model.labels]
    folded = {**features.folded(F.col(text)), "stop_words": model.stop_words, "longest": model.longest}
    vocab = staged(features.vocabulary(terms.statistics(train, **folded), min_df, max_features))
    idf = features.with_idf(vocab, train.agg(F.count(F.lit(1)).alias("n")))
    long = staged(terms.weights(train, idf=idf, key=key, **folded))
    # vocabulary and coefficients have a declared largest size, max_features rows
    coefficients = F.broadcast(coefficient_table(model, train))
    margins = long.join(coefficients, "token").groupBy(key).agg(
        *[F.sum(F.col("weight") * F.col(f"b_{x}")).alias(f"m_{x}") for x in labels])
    counts = train.agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"y_{x}").alias(x) for x in labels]).first()

    def weight(x: str):
        n, positive = counts["n"], counts[x]
        return F.when(F.col(f"y_{x}") == 1, n / (2.0 * positive)).otherwise(
            n / (2.0 * (n - positive))) if balanced else F.lit(1.0)

    scores = {f"p_{x}": 1 / (1 + F.exp(-(F.coalesce(f"m_{x}", F.lit(0.0)) + float(model.heads[x].intercept))))
              for x in labels}
    rows = train.select(key, *ys).join(margins, key, "left").withColumns(scores)
    rows = staged(rows.select(key, *ys, *scores, *[weight(x).alias(f"w_{x}") for x in labels], *[
        (weight(x) * (F.col(f"p_{x}") - F.col(f"y_{x}"))).alias(f"r_{x}") for x in labels]))
    entries = long.join(rows.select(key, *[f"r_{x}" for x in labels]), key).groupBy("token").agg(
        *[F.sum(F.col("weight") * F.col(f"r_{x}")).alias(f"s_{x}") for x in labels])
    steep = entries.join(coefficients, "token").agg(F.count(F.lit(1)).alias("n_features"), *[
        F.max(F.abs(F.col(f"s_{x}") + F.col(f"b_{x}") / c)).alias(f"steep_{x}") for x in labels])
    gaps = model.predict(train.select(key, text)).join(rows.select(key, *scores), key).agg(
        *[F.max(F.abs(F.col(f"score_{x}") - F.col(f"p_{x}"))).alias(f"gap_{x}") for x in labels])
    sums = rows.agg(F.count(F.lit(1)).alias("n_rows"), *[e for x in labels for e in (
        F.sum(f"y_{x}").alias(f"positive_{x}"), F.abs(F.sum(f"r_{x}")).alias(f"steep_{x}"),
        (F.sum(F.col(f"w_{x}") * F.col(f"p_{x}")) / F.sum(f"w_{x}")).alias(f"share_{x}"))])
    parts = [to_long(sums, labels, ["n_rows"], {"n_positive": "positive_{}", "weighted_share": "share_{}", "steep": "steep_{}"}),
             to_long(steep, labels, ["n_features"], {"steep": "steep_{}"}), to_long(gaps, labels, [], {"score_gap": "gap_{}"})]
    both = parts[0].unionByName(parts[1], True).unionByName(parts[2], True).groupBy("category")
    return both.agg(*[F.max(x).alias(x) for x in ("n_rows", "n_positive", "n_features", "weighted_share")],
                    (F.max("steep") / F.max("n_rows")).alias("gradient"), F.max("score_gap").alias("score_gap"))
