"""The trained control: TF-IDF features and one logistic head per label on Spark ML.

What passes through the driver is bounded by ``max_features``: the vocabulary with its
document counts, and one coefficient vector per label. Texts and features stay in the cluster.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from ..sources.kept import kept_path
from ..sources.reports import absent
from ..sources.stage import staged
from . import terms
from .battery import require_pass
from .features import folded, vocabulary
from .sampling import with_split


@dataclass
class Champion:
    labels: list[str]
    counter: CountVectorizerModel
    idf: np.ndarray
    heads: dict[str, LogisticRegressionModel]
    stop_words: list[str]
    longest: int = 2

    @property
    def tokens(self) -> list[str]:
        return list(self.counter.vocabulary)

    def features(self, df: DataFrame, text: str = "text") -> DataFrame:
        """Replaces the text by the unit-length ``features`` vector; a map-only step."""
        tokens = self.tokens
        idf = df.sparkSession.createDataFrame(pa.table({"place": range(len(tokens)), "token": tokens, "idf": self.idf}))
        found = terms.vectors(idf=idf, stop_words=self.stop_words, longest=self.longest, **folded(F.col(text)))
        return df.withColumn("features", found).drop(text)

    def predict(self, df: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
        """Adds ``score_<label>`` and ``pred_<label>`` in place of the text."""
        rows = self.features(df, text)
        for label, head in self.heads.items():
            head = head.copy().setPredictionCol("").setRawPredictionCol("").setProbabilityCol("__p")
            rows = head.transform(rows).withColumn(f"score_{label}", vector_to_array("__p")[1]).drop("__p")
        rows = rows.drop("features")
        return rows.withColumns(
            {f"pred_{x}": (F.col(f"score_{x}") >= threshold).cast("int") for x in self.labels})

    def weights(self, spark: SparkSession) -> DataFrame:
        """(category, token, weight), vocabulary by labels."""
        tokens = self.tokens
        parts = [
            pa.table({"category": [x] * len(tokens), "token": tokens,
                      "weight": self.heads[x].coefficients.toArray()})
            for x in self.labels]
        return spark.createDataFrame(pa.concat_tables(parts))

    def save(self, spark: SparkSession, path: str) -> None:
        self.counter.write().overwrite().save(f"{path}/counter")
        for label, head in self.heads.items():
            head.write().overwrite().save(f"{path}/heads/{label}")
        meta = pa.table({"labels": [self.labels], "stop_words": [self.stop_words], "longest": [self.longest],
                         "idf": [self.idf]})
        spark.createDataFrame(meta).coalesce(1).write.mode("overwrite").parquet(f"{path}/settings")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Champion:
        meta = spark.read.parquet(f"{path}/settings").first()
        labels = list(meta["labels"])
        return cls(labels, CountVectorizerModel.load(f"{path}/counter"), np.array(meta["idf"]),
                   {x: LogisticRegressionModel.load(f"{path}/heads/{x}") for x in labels},
                   list(meta["stop_words"]), int(meta["longest"]))


def fit_counter(vocab: DataFrame, size: int) -> CountVectorizerModel:
    """A count stage over exactly the tokens of a vocabulary table; positions are the stage's own."""
    single = vocab.select(F.array("token").alias("__grams"))
    return CountVectorizer(inputCol="__grams", outputCol="__counts", vocabSize=size, minDF=1.0, minTF=1.0).fit(single)


def fit_champion(train: DataFrame, labels: Sequence[str], stop_words: Sequence[str] = (), text: str = "text",
                 max_features: int = 30_000, longest: int = 2, c: float = 4.0, min_df: int = 3,
                 balanced: bool = True, max_iter: int = 1000, tol: float = 1e-5,
                 parallelism: int = 4) -> Champion:
    """Fit vocabulary, idf and one independent L2 head per label on ``y_<label>``.

    The loss is the sum over weighted rows plus ||b||^2 / (2c), so Spark's mean loss takes
    regParam = 1 / (c * total weight). The intercept is not penalised.
    """
    stop_words = list(stop_words)
    stats = terms.statistics(train, stop_words=stop_words, longest=longest, **folded(F.col(text)))
    counts = train.agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"y_{x}").alias(x) for x in labels]).first()
    vocab = staged(vocabulary(stats, min_df, max_features))
    frequencies = {r["token"]: r["df"] for r in vocab.select("token", "df").toLocalIterator()}
    if not frequencies:
        raise ValueError("empty vocabulary: no token reaches min_df")
    n = counts["n"]
    for x in labels:
        if not counts[x] or counts[x] == n:
            raise ValueError(f"label {x!r} needs both classes in the training rows")
    counter = fit_counter(vocab, max_features)
    df = np.array([frequencies[t] for t in counter.vocabulary], dtype=float)
    model = Champion(list(labels), counter, np.log((1.0 + n) / (1.0 + df)) + 1.0, {}, stop_words, longest)

    # stored once: a lost executor reads features again instead of tokenising in the middle of a solver step
    rows = staged(model.features(train.select(text, *[f"y_{x}" for x in labels]), text))

    def fit_head(x: str) -> LogisticRegressionModel:
        pos = counts[x]
        y = F.col(f"y_{x}")
        weight = F.when(y == 1, n / (2.0 * pos)).otherwise(n / (2.0 * (n - pos))) if balanced else F.lit(1.0)
        head = LogisticRegression(
            featuresCol="features", labelCol="y", weightCol="w", maxIter=max_iter, regParam=1.0 / (c * n),
            elasticNetParam=0.0, standardization=False, tol=tol)
        return head.fit(rows.select("features", y.cast("double").alias("y"), weight.alias("w")))

    # the heads are independent; a few at a time keep the cluster busy between solver steps
    with ThreadPoolExecutor(min(parallelism, len(labels))) as pool:
        model.heads.update(zip(labels, pool.map(inheritable_thread_target(train.sparkSession)(fit_head), labels)))
    return model


def train_baseline(df: DataFrame, labels: Sequence[str], key: str = "id", seed: int = 42,
                   test_size: float = 0.2, leak_gate: DataFrame | None = None,
                   **settings) -> tuple[Champion, DataFrame]:
    """Split by key hash, fit on the training side, return the model and the split table.

    With a leak gate's report, a fit on texts that the battery tests with is refused.
    """
    if leak_gate is not None:
        require_pass(leak_gate)
    rows = with_split(df, key, seed, test_size)
    return fit_champion(rows.where(F.col("split") == "train"), labels, **settings), rows


def load_or_train(spark: SparkSession, path: str, train, **settings) -> Champion:
    """The stored model, or the one ``train()`` fits (which is then stored)."""
    try:
        return Champion.load(spark, path)
    except AnalysisException as e:
        if not absent(e):
            raise
        model = train(**settings)
        model.save(spark, path)
        return model


def kept_champion(rows: DataFrame, labels: Sequence[str], key: str = "id", seed: int = 42, test_size: float = 0.2,
                  leak_gate: DataFrame | None = None, **settings) -> tuple[Champion, DataFrame]:
    """As :func:`train_baseline`, but a model that was fitted on the same rows with the same settings is loaded.

    The leak gate is asked either way, since the battery can have grown after the fit.
    """
    spark = rows.sparkSession
    if leak_gate is not None:
        require_pass(leak_gate)
    path = kept_path(spark, "champion", [rows], [list(labels), key, seed, test_size, sorted(settings.items())])
    train = lambda: train_baseline(rows, labels, key, seed, test_size, **settings)[0]
    return load_or_train(spark, path, train), with_split(rows, key, seed, test_size)


def top_features(weights: DataFrame, labels: Sequence[str], category: str | None = None, k: int = 15) -> DataFrame:
    """The k heaviest tokens, for one category or for each."""
    if category is not None and category not in labels:
        raise ValueError(f"{category} not in {list(labels)}")
    rows = weights if category is None else weights.where(F.col("category") == category)
    w = Window.partitionBy("category").orderBy(F.desc("weight"), "token")
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(
        "category", "rank", "token", F.round("weight", 3).alias("weight"))


def long_scores(df: DataFrame, labels: Sequence[str], keep: Sequence[str]) -> DataFrame:
    from .shape import to_long

    return to_long(df, labels, keep, {"y": "y_{}", "pred": "pred_{}", "score": "score_{}"})


def clause_map(taxonomy_rows: Sequence[tuple]) -> Mapping[str, str]:
    return {row[0]: row[2] for row in taxonomy_rows}
