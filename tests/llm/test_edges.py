"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from plimsoll.llm import (decontaminate, exact_dedup, language_id, license_scan, mixing, ngram_join, registry,
                          revisits, substring_dedup, token_files, toxicity)

RUN = " ".join(f"w{i}" for i in range(30))
LONG = " ".join(f"word{i % 977}x{i}" for i in range(40_000))
ROWS = [
    (1, RUN, "en", "a"), (2, None, "en", "a"), (3, "", None, "b"), (4, " \n\t ", "de", None), (5, RUN, "en", None),
    (5, RUN, "en", None), (6, LONG, "en", "a"), (7, "w3 w4", "de", "b"), (None, RUN.replace(" ", "  "), None, "a"),
    (8, "tail " + RUN + " Apache License, Version 2.0", "en", "a"), (9, "12 34!", "en", "b"),
    (10, "é ü 漢字   mixed space", "fr", "b"),
]
CLASH = ["row", "score", "block", "size", "words", "hash", "kept", "joined", "cls", "source_size", "lang_pred", "of"]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.createDataFrame(ROWS, SCHEMA)
    return frame.select("*", *[F.lit("clash").alias(c) for c in CLASH]).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, " ".join(f"W{i}" for i in range(5, 18))), (2, "w3, w4"), (3, None), (4, "!!"),
                                  (5, "never seen anywhere"), (1, "w3 w4")], "item_id long, text string")


def rows(df):
    return sorted(df.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain(text):
    return [w.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
            for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def test_substring_dedup(docs, empty):
    first = {}
    for doc_id, text, *_ in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0)):
        w, key = spaced(text), doc_id if doc_id is not None else -1
        for s in range(len(w) - 19):
            run = tuple(w[s:s + 20])
            first[run] = min(first.get(run, (key, s)), (key, s))
    want = []
    for doc_id, text, *_ in ROWS:
        w, gone, key = spaced(text), set(), doc_id if doc_id is not None else -1
        for s in range(len(w) - 19):
            if first[tuple(w[s:s + 20])] < (key, s):
                gone.update(range(s, s + 20))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        want.append((doc_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    for block_docs in (1, 500):
        got = substring_dedup.substring_dedup(docs, block_docs=block_docs)
        assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got.collect()),
                      key=str) == sorted(want, key=str)
    assert substring_dedup.substring_dedup(empty).count() == 0


def test_paths_carry_both_coordinates(spark):
    shared = " ".join(f"s{i}" for i in range(25))
    two = spark.createDataFrame([(1, "a b " + shared), (2, shared + " z")], "doc_id long, text string")
    texts = substring_dedup._blocks(two, 1)
    edges = substring_dedup.repeated_edges(texts, substring_dedup._messages(texts, 20), 20)
    path = substring_dedup.compacted(edges).drop("block").collect()
    assert [tuple(r) for r in path] == [(2, 0, 6, 1, 2)]


def test_exact_dedup(docs, empty):
    norm = {i: re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for i, (_, t, *_) in enumerate(ROWS)}
    want = []
    for i, (doc_id, *_) in enumerate(ROWS):
        group = [ROWS[j][0] for j in norm if norm[j] == norm[i]]
        known = [g for g in group if g is not None]
        keep = min(known) if known else None
        want.append((doc_id, keep, len(group), doc_id == keep, hashlib.sha256(norm[i].encode()).hexdigest()))
    # a fingerprint of two bits makes nearly all chunks clash
    for options in ({}, {"bits": 2}, {"bits": 2, "least": 3, "most": 9}):
        got = exact_dedup.exact_groups(docs, **options)
        assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
        assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert exact_dedup.exact_groups(empty).count() == 0


def test_chunks_are_the_text(spark):
    texts = [LONG, "x" * 20_000, "", "a\n  b", "an on in " * 4000]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    got = frame.select("text", F.array_join(exact_dedup.chunks(F.col("text")), "").alias("again")).collect()
    assert all(r["text"] == r["again"] for r in got)


def test_decontaminate(docs, empty, benchmark, monkeypatch):
    items = [(i, plain(t)) for i, t in benchmark.select("item_id", "text").collect()]
    windows = {}
    for item, w in items:
        n = min(len(w), 10)
        for s in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[s:s + n]), set()).add(str(item))
    want = []
    for doc_id, text, *_ in ROWS:
        w, hit, held = plain(text), set(), set()
        for win, names in windows.items():
            for s in range(len(w) - len(win) + 1):
                if tuple(w[s:s + len(win)]) == win:
                    hit.update(range(s, s + len(win)))
                    held |= names
        want.append((doc_id, len(w), len(hit), len(held),
                     hashlib.sha256(",".join(sorted(held)).encode()).hexdigest(), bool(hit)))
    for bits in (decontaminate.BITS, 64):  # the small map lets every place through
        monkeypatch.setattr(decontaminate, "BITS", bits)
        got = decontaminate.decontaminate(docs, benchmark)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    none = decontaminate.decontaminate(docs, benchmark.limit(0))
    assert none.count() == len(ROWS) and none.where("contaminated").count() == 0
    assert decontaminate.decontaminate(empty, benchmark).count() == 0
    clean = decontaminate.clean_documents(docs, benchmark)
    assert clean.columns == docs.columns
    assert {r["doc_id"] for r in clean.collect()} == {r[0] for r in want if not r[5]}


def test_near_groups(docs, empty):
    got = rows(ngram_join.near_groups(docs))
    by_id = {r["doc_id"]: r for r in got}
    assert len(got) == len(ROWS)
    assert by_id[5]["class_id"] == by_id[None]["class_id"] == 1 and by_id[1]["class_size"] == 5 + 0
    assert by_id[8]["class_id"] == 1 if by_id[8]["n_links"] else by_id[8]["class_id"] == 8
    assert {by_id[i]["class_id"] for i in (2, 3, 4)} == {2} and by_id[2]["n_links"] == 0
    assert ngram_join.near_groups(empty).count() == 0


def test_near_groups_against_all_pairs(spark):
    base = [f"t{i}" for i in range(120)]
    texts = []
    for i in range(90):  # a chain of edits, more than a block holds
        w = list(base)
        for j in range(i % 9):
            w[(7 * i + 13 * j) % 120] = f"e{i}_{j}"
        texts.append(" ".join(w))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [frozenset(tuple(t.split()[s:s + 5]) for s in range(116)) for t in texts]
    links = {i: {j for j in range(90) if sets[i] != sets[j]
                 and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])} for i in range(90)}
    root = list(range(90))
    for _ in range(90):
        for i in range(90):
            near = links[i] | {j for j in range(90) if sets[j] == sets[i]}
            root[i] = min([root[i], *(root[j] for j in near)])
    for block in (16, 256):
        got = rows(ngram_join.near_groups(frame, block=block))
        assert [r["class_id"] for r in got] == root
        assert [r["n_links"] for r in got] == [len({sets[j] for j in links[i]}) for i in range(90)]


def copy_rows(spark):
    text = {c: " ".join(f"{c}{i}" for i in range(60)) for c in "abcd"}
    near = {c: t + " tail" for c, t in text.items()}
    return spark.createDataFrame(
        [(1, text["a"], "first"), (None, near["a"], "near"), (None, text["b"], "unique"), (7, near["a"], "near"),
         (7, text["c"], "unique"), (8, text["d"], "twice"), (8, text["d"], "twice")],
        "doc_id long, text string, row string").repartition(3), text


def test_only_the_copies_go(spark):
    frame, text = copy_rows(spark)
    got = sorted(map(tuple, ngram_join.distinct_documents(frame).collect()), key=str)
    assert got == sorted([(1, text["a"], "first"), (None, text["b"], "unique"), (7, text["c"], "unique"),
                          (8, text["d"], "twice")], key=str)


def test_only_the_contaminated_go(spark):
    frame, text = copy_rows(spark)
    items = spark.createDataFrame([(1, " ".join(text["a"].split()[5:18]))], "item_id long, text string")
    got = sorted(map(tuple, decontaminate.clean_documents(frame, items).collect()), key=str)
    assert got == sorted([(None, text["b"], "unique"), (7, text["c"], "unique"), (8, text["d"], "twice"),
                          (8, text["d"], "twice")], key=str)


def test_null_ids_are_linked(spark):
    text = {c: " ".join(f"{c}{i}" for i in range(60)) for c in "abc"}
    frame = spark.createDataFrame(
        [(1, text["a"]), (None, text["a"] + " tail"), (None, text["b"]), (None, text["b"] + " tail"),
         (None, text["c"])], "doc_id long, text string").repartition(3)
    got = sorted((r["class_id"] or 0, r["n_links"], r["class_size"], r["kept"])
                 for r in ngram_join.near_groups(frame).where("doc_id is null").collect())
    assert got == [(0, 0, 1, True), (0, 1, 2, True), (0, 1, 2, True), (1, 1, 2, False)]
    left = [tuple(r) for r in ngram_join.distinct_documents(frame).collect()]
    assert len(left) == 3 and {(1, text["a"]), (None, text["c"])} < set(left)


def test_prefixes_are_shortened_to_the_recall():
    assert ngram_join.prefix_length(0.8) == 4
    assert ngram_join.prefix_length(0.8, recall=0.9) > 4 > ngram_join.prefix_length(0.5)


def test_mix(docs, empty):
    got = mixing.mix(docs).collect()
    sizes = {}
    for _, text, _, source in ROWS:
        sizes[source] = sizes.get(source, 0) + len(spaced(text))
    assert len(got) == len(ROWS)
    assert abs(sum(r["target"] * r["size"] / r["source_size"] for r in got if r["source_size"])
               - 1.5 * sum(sizes.values())) < 1
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mix(docs.repartition(2)).collect()), key=str)
    assert mixing.mix(empty).count() == 0
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    assert sum(len(spaced(r["text"])) for r in out.collect()) == sum(
        round(t) for t in {r["source_size"]: r["target"] for r in got}.values())


def test_dotted_columns(docs):
    """A column name with a dot in it goes through the mix and the pipeline's first stage."""
    import corpus_pipeline

    dotted = docs.withColumn("a.b", F.lit("dot"))
    assert mixing.mixed_documents(dotted).columns == dotted.columns
    kept = corpus_pipeline.known_language(dotted.sparkSession, dotted, "")
    assert kept.columns == dotted.columns and kept.count() > 0


@pytest.mark.parametrize("shard_slots", [4, 1000])
def test_shards_hold_the_mix(docs, empty, tmp_path, shard_slots):
    """Words by shard are the documents' words, each source has its target, and no slot is in two shards."""
    mixed = mixing.mixed_shards(docs, shard_slots=shard_slots)
    folder = str(tmp_path / "mix")
    mixing.write_shards(mixed, folder)
    got = docs.sparkSession.read.parquet(folder).collect()
    plan = mixing.targets(mixing.packed(docs)).collect()
    total = lambda key: {k: sum(len(r["text"].split(" ")) for r in got if r[key] == k) for k in {r[key] for r in got}}
    assert total("source") == {r["source"]: round(r["target"]) for r in plan if round(r["target"])}
    sizes = {}
    for r in mixing.mix(docs).collect():
        sizes[r["doc_id"]] = sizes.get(r["doc_id"], 0) + r["taken"]
    assert total("doc_id") == {k: n for k, n in sizes.items() if n}
    slots = {}
    for r in got:
        slots.setdefault((r["source"], r["slot"]), []).append(r)
    for parts in slots.values():
        assert len({r["shard"] for r in parts}) == 1
        words = [w for r in sorted(parts, key=lambda r: r["place"]) for w in r["text"].split(" ")]
        assert len(words) <= mixing.BLOCK
    held = {}
    for parts in slots.values():
        held[parts[0]["shard"]] = held.get(parts[0]["shard"], 0) + 1
    assert all(n <= shard_slots for shard, n in held.items() if shard != max(held))
    texts = {" ".join(spaced(t)) for _, t, *_ in ROWS}
    assert all(any(r["text"] in t for t in texts) for r in got)
    assert mixing.mixed_shards(empty).count() == 0


def test_draws_decide_the_shards(docs):
    """Another seed puts words into other shards; the counts by shard are those of the draws, near the shares."""
    one, two = ([tuple(r) for r in mixing.mixed_shards(docs, seed=s, shard_slots=64).groupBy("shard", "source").agg(
        F.count_distinct("slot").alias("n")).collect()] for s in (7, 8))
    assert sorted(one, key=str) != sorted(two, key=str)
    plan = mixing.targets(mixing.packed(docs)).collect()
    share = {r["source"]: r["target"] / sum(q["target"] for q in plan) for r in plan}
    last = max(shard for shard, _, _ in one)
    for source, p in share.items():
        full = [n for shard, s, n in one if s == source and shard < last - 3]
        if p * 64 >= 10:
            assert abs(sum(full) / len(full) - 64 * p) <= 4 * (64 * p * (1 - p) / len(full)) ** 0.5 + 1


def test_every_slot_takes_a_block_of_its_own(spark):
    for n in (1, 2, 7, 100, 1000):
        frame = spark.range(n).select("id", mixing.permuted(F.col("id"), F.lit(n), F.lit(n + 3)).alias("to"))
        back = frame.select("id", mixing.permuted(F.col("to"), F.lit(n), F.lit(n + 3), inverse=True).alias("again"))
        assert sorted(r["to"] for r in frame.collect()) == list(range(n))
        assert back.where("id <> again").isEmpty()


def test_license_scan(docs, empty):
    got = rows(license_scan.license_scan(docs))
    assert {r["doc_id"]: r["labels"] for r in got if r["labels"]} == {8: "apache"}
    r = next(r for r in got if r["doc_id"] == 8)
    assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (36, 1, 31, 31)
    assert license_scan.license_scan(empty).count() == 0


def test_license_base_places(spark):
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    texts = ["MIT License mit-license, mit license", "(CC BY) cc by-sa 4.0 and the GNU General Public License v3",
             "é mit licensed mit license", "Apache LİCENSE", "", None, "cc  by cc\nby", "gnu general public license " * 300]
    got = rows(license_scan.license_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    for r, text in zip(got, texts):
        w = plain(text)
        at = sorted((s, label) for p, label in phrases.items() for s in range(len(w))
                    if w[s:s + len(p.split())] == p.split())
        assert (r["n_words"], r["n_base"]) == (len(w), len(at))
        assert (r["first_word"], r["last_word"]) == ((at[0][0], at[-1][0]) if at else (None, None))
        assert r["base_labels"] == ",".join(sorted({label for _, label in at}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))


def test_license_rules_are_gated():
    for _, _, pattern, _ in license_scan.signatures():
        assert license_scan.openings(pattern), pattern
        literal = pattern.replace("licen[sc]e", "license")
        assert any(k.strip() in literal for k in license_scan.KEYWORDS), pattern


def spelled(pattern):
    """The shortest text that the pattern matches, by first alternatives."""
    def of(part):
        kind, value = str(part[0]), part[1]
        if kind == "LITERAL":
            return chr(value)
        if kind == "IN":
            return of(value[0])
        if kind == "CATEGORY":
            return "x"
        if kind == "MAX_REPEAT":
            return "".join(map(of, value[2])) * value[0]
        if kind in ("BRANCH", "SUBPATTERN"):
            return "".join(map(of, value[1][0] if kind == "BRANCH" else value[-1]))
        raise ValueError(kind)

    return "".join(map(of, re._parser.parse(pattern)))


def test_every_rule_passes_the_gate(spark):
    rules = [(label, spelled(pattern), pattern) for label, _, pattern, _ in license_scan.signatures()]
    for _, text, pattern in rules:
        assert re.fullmatch(pattern, text), (pattern, text)
        assert any(k in text for k in license_scan.KEYWORDS), text
    frame = spark.createDataFrame([(i, r[1]) for i, r in enumerate(rules)], "doc_id long, text string")
    got = rows(license_scan.license_scan(frame))
    assert not [(r[1], g["labels"]) for r, g in zip(rules, got) if r[0] not in g["labels"].split(",")]


def test_license_containment(spark):
    text = "This work is licensed under the Apache License, Version 2.0. See also the BSD license."
    found = license_scan.resolved(license_scan.detections(spark.createDataFrame([(1, text)], "doc_id long, text string")))
    kept = {(r["label"], r["start"], r["stop"]) for r in found.where("kept").collect()}
    assert ("bsd", 14, 16) in kept and ("apache", 3, 11) in kept and ("apache", 6, 8) not in kept


def test_revisits(spark):
    h = "map<string,string>"
    captures = [
        (1, "response", 10, "http://www.Ex.org:80/a/?b=2&a=1&utm_source=x#f", {"etag": "x", "vary": "old", "age": "1"}),
        (2, "revisit", 5, "https://ex.org/a?a=1&b=2", {"etag": "x"}),
        (3, "revisit", 20, "https://ex.org/a?a=1&b=2", {"etag": "x", "vary": "new", "age": "2"}),
        (4, "revisit", 21, "https://ex.org/a?a=1&b=2", {"etag": "y"}), (5, "revisit", 22, "//ex.org/a?b=2&a=1", None),
        (6, "response", 9000, "http://ex.org/a?a=1&b=2", {"etag": "z"}),
        (7, "revisit", 90000, "http://ex.org/a?a=1&b=2", {"etag": "z"}), (8, "revisit", None, "http://ex.org/", {}),
        (9, "revisit", 9, None, {"etag": "z"}), (6, "revisit", 9000, "http://ex.org/a?a=1&b=2", {"etag": "z"}),
    ]
    frame = spark.createDataFrame(captures, f"record_id long, kind string, at long, url string, headers {h}")
    for width in (8, 4096):
        got = {(r["record_id"], r["kind"]): r for r in revisits.resolve_revisits(frame, width).collect()}
        status = {k[0]: r["status"] for k, r in got.items() if k[1] == "revisit"}
        assert status == {2: "no_response", 3: "resolved", 4: "changed", 5: "no_validator", 7: "resolved",
                          8: "no_response", 9: "no_response", 6: "changed"}
        assert got[3, "revisit"]["headers"] == {"etag": "x", "vary": "new", "age": "1"}
        assert got[7, "revisit"]["refers_to"] == 6 and got[3, "revisit"]["refers_to"] == 1
    assert revisits.resolve_revisits(frame.limit(0)).count() == 0


def test_token_files(docs, empty):
    from tokenizers import Tokenizer
    path = registry.tokenizer_path()
    tokenizer = Tokenizer.from_file(path)
    got = token_files.token_files(docs, path).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == sorted((r[0] for r in ROWS), key=lambda d: (d is not None, d or 0))
    at = 0
    texts = {}
    for doc_id, text, *_ in ROWS:
        texts.setdefault(doc_id, tokenizer.encode(text or "", add_special_tokens=False).ids + [0])
    import numpy as np
    for r in got:
        assert r["start"] == at and r["n_tokens"] == len(texts[r["doc_id"]])
        assert np.frombuffer(r["ids"], "<u4").tolist() == texts[r["doc_id"]]
        at += r["n_tokens"]
    assert token_files.token_files(empty, path).count() == 0


def test_language_id(docs, empty):
    got = rows(language_id.language_id(docs, docs.select("doc_id", "text", "lang")))
    assert len(got) == len(ROWS)
    und = {r["doc_id"] for r in got if r["lang_pred"] == "und"}
    assert und == {2, 3, 4, 9} and all(r["rejected"] and r["score"] == 0 for r in got if r["doc_id"] in und)
    assert all(0 <= r["score"] <= 1 and r["lang_pred"] in ("en", "de", "fr", "und") for r in got)
    untaught = language_id.language_id(docs, empty)
    assert {r["lang_pred"] for r in untaught.collect()} == {"und"}
    assert language_id.language_id(empty, docs.select("doc_id", "text", "lang")).count() == 0


def test_toxicity(docs, empty):
    labelled = docs.select("doc_id", F.when(F.col("doc_id") % 2 == 0, 1).otherwise(0).alias("toxic"))
    for taught in (labelled, labelled.limit(0)):
        got = rows(toxicity.toxicity(docs, *toxicity.fit(docs, taught)))
        assert len(got) == len(ROWS) and all(0 <= r["score"] <= 1 for r in got)
        assert all(r["predicted"] == int(r["score"] >= 0.7) for r in got)
    assert toxicity.toxicity(empty, *toxicity.fit(docs, labelled)).count() == 0
