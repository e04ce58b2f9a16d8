"""Held-out accuracy of the trained operators, exact coding, and the pipeline stage by stage."""

import numpy as np
import pytest

import corpus_pipeline
from plimsoll.llm import language_id, mixing, ngram_join, rans, registry, textbytes, toxicity
from plimsoll.sources.stage import staged

MIDDLE = "/root/testdata/sf0.1"


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "lang")
    found = registry.op4_language_id(spark, MIDDLE).where("held_out").join(docs, "doc_id")
    right, n = found.selectExpr("sum(int(lang = lang_pred))", "count(*)").first()
    assert n > 3000 and right / n > 0.99


def sample_rows(n_languages, texts):
    """Rows of invented languages, each of syllables of its own."""
    out = []
    for i in range(n_languages):
        rng = np.random.default_rng(i)
        syllables = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 3)) for _ in range(12)]
        for k in range(texts):
            words = ["".join(rng.choice(syllables, 2)) for _ in range(60)]
            out.append((1000 * i + k, " ".join(words), f"l{i:03d}"))
    return out


def test_many_languages_and_rejection(spark):
    rows = sample_rows(60, 12)
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    odd = [(-1, "\u4e2d\u6587\u5b57\u7b26" * 40, None), (-2, "\u0416\u0429\u042e\u042f " * 40, None), (-3, "12 34", None)]
    found = {r["doc_id"]: r for r in language_id.language_id(
        frame.unionByName(spark.createDataFrame(odd, frame.schema)), frame.where("doc_id % 1000 < 8")).collect()}
    held = [r for r in rows if r[0] % 1000 >= 8]
    assert np.mean([found[i]["lang_pred"] == lang for i, _, lang in held]) > 0.98
    assert not any(found[i]["rejected"] for i, _, _ in rows)
    # letters that no language of the sample has are far from all centroids
    assert all(found[i]["rejected"] for i in (-1, -2, -3)) and found[-3]["lang_pred"] == "und"
    assert found[-1]["lang_pred"] != "und"


def test_language_model_by_brute_force(spark):
    rows = sample_rows(3, 10)
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    model = language_id.fit(frame)
    import pyarrow as pa
    order = [r["doc_id"] for r in frame.selectExpr("doc_id", "xxhash64(doc_id) h").orderBy("h").collect()]
    texts = {i: t for i, t, _ in rows}
    counts = {i: language_id.gram_counts(pa.array([texts[i]]))[0] for i in texts}
    idf = np.log((1 + len(texts)) / (1 + sum((c > 0).astype(int) for c in counts.values()))) + 1
    assert np.allclose(np.frombuffer(model[0][2], np.float32), idf)
    want, vectors = [], {i: language_id.unit(c[None], idf.astype(np.float32))[0] for i, c in counts.items()}
    for n in range(3):
        own = np.stack([vectors[i] for i in order if i // 1000 == n])
        want += list(language_id.clustered(own, language_id.CENTROIDS))
    assert np.allclose(np.array([np.frombuffer(w, np.float32) for _, _, w in model[2:]]), want, atol=1e-5)
    assert [lang for _, lang, _ in model[2:]] == [f"l{n:03d}" for n in range(3) for _ in range(language_id.CENTROIDS)]
    reached = [max(float(v @ c) for c in want) for v in vectors.values()]
    limit = np.frombuffer(model[1][2], np.float32)[0]
    assert np.isclose(limit, language_id.SLACK * np.quantile(reached, 0.01), atol=1e-5)


def test_the_sample_of_languages_is_bounded_in_rows(spark):
    # one id holds most rows, and repeats in two languages; nulls are not drawn
    rows = [(1, f"same id {i}", "a") for i in range(300)] + [(1, "other tongue", "b"), (None, "no id", "a")]
    rows += [(i, f"text {i}", "a") for i in range(2, 30)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    for most, a in ((5, 5), (600, 29)):
        drawn = language_id.drawn_texts(frame, most).collect()
        assert sorted(r["lang"] for r in drawn) == ["a"] * a + ["b"]
    assert sorted(r["text"] for r in drawn) == ["other tongue", "same id "] + ["text "] * 28


def test_toxicity_of_held_out_documents(spark):
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet").select("doc_id", "toxic")
    found = registry.op2_toxicity(spark, MIDDLE).where("held_out").join(labels, "doc_id").toPandas()
    positive = found[found.toxic == 1]
    clean = found[found.toxic == 0]
    assert positive.predicted.mean() > 0.6 and clean.predicted.mean() < 0.01
    pairs = np.searchsorted(np.sort(clean.score.to_numpy()), positive.score.to_numpy())
    assert pairs.mean() / len(clean) > 0.93


def test_the_sample_of_labels_is_bounded_in_rows(spark):
    docs = spark.createDataFrame([(1, f"Same {i:03d}") for i in range(300)] + [(i, f"t{i}") for i in range(2, 30)]
                                 + [(None, "none")], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(1, 1)] * 200 + [(1, 0), (None, 1), (2, None)] + [(i, i % 2) for i in range(3, 30)],
                                   "doc_id long, toxic int").repartition(3)
    drawn = toxicity.drawn_texts(docs, labels, "toxic", 600).collect()
    assert sorted((r["text"], r["y"]) for r in drawn) == sorted(
        [("same 000", 0), ("same 000", 1)] + [(f"t{i}", i % 2) for i in range(3, 30)])
    assert toxicity.drawn_texts(docs, labels, "toxic", 5).count() == 5


@pytest.mark.parametrize("n", [0, 1, 1023, 1024, 1025, 70_000, 600_001])
def test_rans_round_trip(n):
    ids = (np.random.default_rng(n).zipf(1.3, n) % 50_257).astype(np.int64)
    table = rans.Table(rans.scaled(np.bincount(ids, minlength=50_257)))
    words, marks, reads = rans.encode(ids, table)
    assert (rans.decode(words, marks, reads, n, table) == ids).all()
    if len(marks) > 1:  # a part alone, from its checkpoint
        part = rans.decode(words, marks, reads, n, table, range(1, 2))
        assert (part == ids[rans.CHECKPOINT:2 * rans.CHECKPOINT]).all()


def test_frequencies_fill_the_table():
    for counts in (np.array([1, 0, 5]), np.ones(50_000, int), np.array([10**12] + [1] * 50_000)):
        share = rans.scaled(counts)
        assert int(share.sum()) == 1 << rans.BITS and ((share > 0) == (counts > 0)).all()


def test_word_and_window_hashes():
    import pyarrow as pa
    texts = ["a b c d e f", "", "b c d e f g", " x\ty z ", "a b c d e f"]
    data, offsets = textbytes.text_bytes(pa.array(texts))
    starts, ends, doc = textbytes.words(data, offsets)
    got = [(int(d), data[s:e].tobytes()) for s, e, d in zip(starts, ends, doc)]
    assert got == [(i, w) for i, t in enumerate(texts) for w in t.encode().split()]
    each = textbytes.word_hashes(data, starts, ends)
    assert len(set(each.tolist())) == len({w for _, w in got})
    for n in (1, 3, 5):
        windows = textbytes.window_hashes(each, n)
        named = {}
        for i, h in enumerate(windows.tolist()):
            named.setdefault(h, set()).add(tuple(w for _, w in got[i:i + n]))
        assert all(len(v) == 1 for v in named.values())


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES:
        seen.append(staged(stage(spark, seen[-1], sf_dir)))
    start, known, distinct, clean, mixed, tokens = seen
    assert all(s.columns == docs.columns for s in seen[:-1])
    # the language stage keeps rows as they are, and nearly all of them
    assert known.exceptAll(start).isEmpty() and known.count() >= 0.98 * start.count()
    assert known.where("text is null").isEmpty()
    # one document of each group
    groups = ngram_join.near_groups(known)
    assert distinct.count() == groups.select("class_id").distinct().count() < known.count()
    assert ngram_join.near_groups(distinct).where("class_size > 1").isEmpty()
    # no benchmark window is left, and nothing else went
    marks = registry.decontaminate.decontaminate(distinct, registry.table(spark, sf_dir, "benchmark"))
    gone = {r["doc_id"] for r in marks.where("contaminated").collect()}
    assert gone and {r["doc_id"] for r in distinct.collect()} - gone == {r["doc_id"] for r in clean.collect()}
    # the mix has each source's target
    want = {r["source"]: r["target"] for r in mixing.targets(mixing.packed(clean)).collect()}
    have = {r["source"]: r["n"] for r in mixed.groupBy("source").agg({"text": "count"}).withColumnRenamed(
        "count(text)", "n").collect()}
    assert set(have) == {k for k, v in want.items() if v >= 0.5}
    # tokens of the mix, in order
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(registry.tokenizer_path())
    sizes = sorted((r["doc_id"], len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids) + 1)
                   for r in mixed.collect())
    assert sorted((r["doc_id"], r["n_tokens"]) for r in tokens.collect()) == sizes
    ordered = tokens.orderBy("start").collect()
    assert [r["doc_id"] for r in ordered] == sorted(r["doc_id"] for r in ordered)
    assert all(b["start"] == a["start"] + a["n_tokens"] for a, b in zip(ordered, ordered[1:]))
