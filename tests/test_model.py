"""Features and the trained control against NumPy."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from plimsoll.functions import runs as R
from plimsoll.functions import text as T
from plimsoll.operators import certificate as K
from plimsoll.operators import champion as C
from plimsoll.operators import features, sampling, terms
from plimsoll.plans import bindings as X
from plimsoll.sources.kept import kept_path, kept_table

TEXTS = ["red fish and blue fish", "blue sky", "red red red sky", "", "Blüe fish in the sky", "green", "fish fish sky"]
STOP = ["and", "in", "the"]


def py_grams(text):
    words = [w for w in text.lower().replace("ü", "u").split() if w not in STOP]
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def brute_tfidf(min_df, limit):
    docs = [Counter(py_grams(t)) for t in TEXTS]
    total, df = Counter(), Counter()
    for d in docs:
        total.update(d)
        df.update(d.keys())
    vocab = sorted((t for t in df if df[t] >= min_df), key=lambda t: (-total[t], t))[:limit]
    idf = {t: math.log((1 + len(docs)) / (1 + df[t])) + 1 for t in vocab}
    out = {}
    for i, d in enumerate(docs):
        raw = {t: (1 + math.log(d[t])) * idf[t] for t in d if t in idf}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        out.update({(i, t): v / norm for t, v in raw.items()})
    return vocab, out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id long, text string")


def test_tfidf_equals_numpy(spark, docs):
    vocab, want = brute_tfidf(2, 5)
    folded = {"text": features.normalised(F.col("text")), "stop_words": STOP, "longest": 2}
    got_vocab = features.vocabulary(terms.statistics(docs, **folded), 2, 5)
    assert [r["token"] for r in got_vocab.orderBy(F.desc("n"), "token").collect()] == vocab
    idf = features.with_idf(got_vocab, docs.agg(F.count(F.lit(1)).alias("n_texts")))
    rows = terms.weights(docs, idf=idf, **folded).collect()
    assert {(r["id"], r["token"]): r["weight"] for r in rows} == pytest.approx(want)


@pytest.mark.parametrize("longest, stop, together", [(1, [], 1 << 22), (3, ["b", "été"], 1 << 22), (4, ["a"], 40)])
def test_terms_equal_brute_force(spark, monkeypatch, longest, stop, together):
    rng = random.Random(longest)
    texts = [" ".join(rng.choice(["a", "b", "été", "漢字", "a b", " ", "c-d", ""]) for _ in range(rng.randint(0, 40)))
             for _ in range(120)] + [None, "", "  ", "a", "b b", "x " * 3000]
    want = []
    for t in texts:
        words = [w for w in re.split(r"[^\w]+", t or "") if w and w not in stop]
        want.append(Counter(" ".join(words[i:i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)))
    monkeypatch.setattr(R, "TOGETHER", together)
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(3)
    got = terms.frequencies(df, F.coalesce("text", F.lit("")), "id", stop, longest).collect()
    assert {(r["id"], r["token"]): r["tf"] for r in got} == {(i, t): n for i, c in enumerate(want) for t, n in c.items()}
    total, seen = sum(want, Counter()), Counter(t for c in want for t in c)
    got = terms.statistics(df, F.col("text"), stop, longest).collect()
    assert {r["token"]: (r["n"], r["df"]) for r in got} == {t: (n, seen[t]) for t, n in total.items()}
    assert len(got) == len(total)
    assert terms.statistics(df.where("false"), F.col("text"), stop, longest).count() == 0


def test_model_features_equal_the_long_form(spark, docs):
    vocab, want = brute_tfidf(2, 5)
    df = Counter(t for text in TEXTS for t in set(py_grams(text)))
    idf = np.array([math.log((1 + len(TEXTS)) / (1 + df[t])) + 1 for t in vocab])
    counter = CountVectorizerModel.from_vocabulary(vocab, inputCol="__grams", outputCol="__counts")
    model = C.Champion([], counter, idf, {}, STOP)
    rows = model.features(docs).select("id", vector_to_array("features").alias("v")).collect()
    got = {(r["id"], vocab[j]): v for r in rows for j, v in enumerate(r["v"]) if v}
    assert got == pytest.approx(want)


@pytest.fixture(scope="module")
def labelled(spark, sf_dir):
    return X.documents(spark, sf_dir).select("doc_id", "text").join(X.truth(spark, sf_dir), "doc_id")


@pytest.fixture(scope="module")
def trained(labelled):
    return C.train_baseline(labelled, ["toxic"], "doc_id", stop_words=X.STOP_WORDS, max_features=300, tol=1e-9)


def test_solution_is_stationary(trained):
    """Gradient of C * sum(w * loss) + ||b||^2 / 2 vanishes at the fitted coefficients."""
    model, rows = trained
    train = rows.where(F.col("split") == "train")
    data = model.features(train).select(vector_to_array("features").alias("v"), "y_toxic").collect()
    x, y = np.array([r["v"] for r in data]), np.array([r["y_toxic"] for r in data])
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    head = model.heads["toxic"]
    b, b0 = head.coefficients.toArray(), head.intercept
    residual = w * (1 / (1 + np.exp(-(x @ b + b0))) - y)
    gradient = 4.0 * (x.T @ residual) + b
    assert np.abs(gradient).max() < 1e-2 * max(1.0, np.abs(b).max())
    assert abs(4.0 * residual.sum()) < 1e-2 * len(y)


def test_certificate_tells_optimum_from_others(spark, trained):
    model, rows = trained
    train = rows.where(F.col("split") == "train").drop("split")
    right = K.certificate(model, train, "doc_id", max_features=300).first()
    totals = train.agg(F.count("*"), F.sum("y_toxic")).first()
    assert (right["n_rows"], right["n_positive"], right["n_features"]) == (*totals, len(model.tokens))
    assert right["gradient"] < 1e-5 and right["score_gap"] < 1e-9 and abs(right["weighted_share"] - 0.5) < 1e-5
    # the same coefficients are not the optimum of another penalty, of other weights or of other rows
    assert K.certificate(model, train, "doc_id", max_features=300, c=5.0).first()["gradient"] > 1e-5
    assert K.certificate(model, train, "doc_id", max_features=300, balanced=False).first()["gradient"] > 1e-3
    assert K.certificate(model, train.where("doc_id % 5 > 0"), "doc_id", max_features=300).first()["gradient"] > 1e-5
    early = C.fit_champion(train, ["toxic"], X.STOP_WORDS, max_features=300, max_iter=3)
    assert K.certificate(early, train, "doc_id", max_features=300).first()["gradient"] > 1e-4


def test_kept_models_and_results_follow_their_inputs(spark, labelled, monkeypatch):
    fits = []
    fit = C.fit_champion
    monkeypatch.setattr(C, "fit_champion", lambda *a, **k: fits.append(1) or fit(*a, **k))
    keep = lambda df, **k: C.kept_champion(df, ["toxic"], "doc_id", stop_words=X.STOP_WORDS, max_features=50, **k)[0]
    first = keep(labelled)
    assert keep(labelled.repartition(5)).tokens == first.tokens and len(fits) == 1
    keep(labelled, min_df=2)
    changed = labelled.withColumn("text", F.when(F.col("doc_id") == F.lit(labelled.first()["doc_id"]), "new").otherwise(F.col("text")))
    keep(changed)
    assert len(fits) == 3
    red = spark.createDataFrame([("RED",)], "status string")
    with pytest.raises(ValueError, match="leak gate"):
        keep(labelled, leak_gate=red)

    runs = []
    table = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "k int, `a.b` string")
    result = lambda df, s: kept_table(spark, "r", [df], s, lambda: runs.append(1) or df.groupBy("k").count()).collect()
    assert sorted(result(table, 1)) == sorted(result(table.repartition(3), 1)) and len(runs) == 1
    result(table, 2), result(table.limit(2), 1), result(table.withColumnRenamed("k", "j").withColumnRenamed("j", "k"), 1)
    assert len(runs) == 3


def test_a_result_without_success_mark_is_computed_anew(spark):
    table = spark.createDataFrame([(7,)], "k int")
    path = kept_path(spark, "lost", [table])
    spark.createDataFrame([(1,)], "k int").write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    assert [r["k"] for r in kept_table(spark, "lost", [table], None, lambda: table).collect()] == [7]


def test_save_load_and_fallback(spark, trained, tmp_path):
    model, rows = trained
    path, calls = str(tmp_path / "m"), []

    def train(**_):
        calls.append(1)
        return model

    first = C.load_or_train(spark, path, train)
    again = C.load_or_train(spark, path, train)
    assert len(calls) == 1 and again.tokens == first.tokens
    test = rows.where(F.col("split") == "test").select("doc_id", "text")
    assert sorted(again.predict(test).collect()) == sorted(model.predict(test).collect())


def test_top_features(spark, trained):
    model, _ = trained
    rows = C.top_features(model.weights(spark), model.labels, "toxic", 5).collect()
    weights = [r["weight"] for r in rows]
    assert len(rows) == 5 and weights == sorted(weights, reverse=True)
    with pytest.raises(ValueError, match="not in"):
        C.top_features(model.weights(spark), model.labels, "nope")


def test_one_class_is_refused(labelled):
    with pytest.raises(ValueError, match="both classes"):
        C.fit_champion(labelled.where("y_toxic = 0"), ["toxic"], max_features=50)


def test_split_and_samples_do_not_depend_on_partitioning(spark, sf_dir):
    truth = X.truth(spark, sf_dir)
    one, many = truth.coalesce(1), truth.repartition(13)
    split = lambda df: sorted(sampling.with_split(df, "doc_id").select("doc_id", "split").collect())
    assert split(one) == split(many) and len(split(one)) == truth.count()
    draw = lambda df: sampling.balanced_sample(df, X.LABELS, 20, "doc_id").collect()
    assert draw(one) == draw(many) and sum(r["flagged"] for r in draw(one)) == 10


def test_short_stratum_is_filled(spark):
    df = spark.createDataFrame([(i, int(i < 2)) for i in range(50)], "id long, y_t int")
    got = sampling.balanced_sample(df, ["t"], 20).collect()
    assert len(got) == 20 and sum(r["flagged"] for r in got) == 2


def test_folding_in_the_scan_agrees_with_the_jvm_on_every_character(spark):
    codes = [c for c in range(1, 0x110000) if not 0xD800 <= c <= 0xDFFF]
    texts = ["".join(f"x{chr(c)}y " for c in codes[i:i + 400]) for i in range(0, len(codes), 400)]
    texts += [None, "", " ", "Ünïcode ﬃ½ 한글 E\u0301tude … ſtraße Σας", "plain words_9 only"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(4)
    for normal, how in [(features.normalised(F.col("text")), features.folded(F.col("text"))),
                        (F.lower(F.coalesce("text", F.lit(""))), {"text": F.lower("text")})]:
        words = df.select("id", F.explode(T.tokens(normal)).alias("token"))
        want = words.groupBy("token").agg(F.count("id").alias("n"), F.countDistinct("id").alias("df"))
        got = terms.statistics(df, **how)
        assert got.exceptAll(want).take(3) == want.exceptAll(got).take(3) == []


def test_features_of_a_batch_hold_one_piece_at_a_time(spark):
    docs = spark.createDataFrame([(i, "Çafé au lait " * 70_000 if i < 3 else None if i == 3 else "lait lait thé") for i in range(6)],
                                 "id int, text string").coalesce(1)
    counter = CountVectorizerModel.from_vocabulary(["lait", "cafe au", "the"], inputCol="__grams", outputCol="__counts")
    rows = C.Champion([], counter, np.ones(3), {}, []).features(docs).orderBy("id").collect()
    once, twice = 1 + np.log(70_000), 1 + np.log(2)
    for row in rows:
        want = [once, once, 0] if row["id"] < 3 else [0, 0, 0] if row["id"] == 3 else [twice, 0, 1]
        assert np.allclose(row["features"].toArray(), np.array(want) / max(np.linalg.norm(want), 1))
