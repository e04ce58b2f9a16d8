"""Collocations, token counts and spelling variants against brute force, with every odd kind of row."""

import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from plimsoll.llm import collocations, prefix_tokens, registry, spelling, token_files

SCHEMA = "doc_id long, text string, lang string, source string"
SPEECH = "the cat sat on the mat. the cat sat on the hat, The Cat sat\ton the mat! a b A b x x x x x; \x0b \x01 q"
ODD = [(1, SPEECH, "en", "a"), (2, None, "en", "a"), (3, "", None, "b"), (4, " \n\t ", "de", None), (5, SPEECH, None, None),
       (5, SPEECH, None, None), (None, SPEECH + " " + SPEECH.upper(), "und", "a"), (7, "the cat " * 3000, "en", "a"),
       (8, "über über\tüber uber don't, 're'll", "de", "b"), (9, "the cat sat on the mat", "en w", "b")]
CLASH = ["phrase", "a", "n", "l", "word", "steps", "n_tokens", "part", "prefix", "next", "key", "last", "run", "a.b"]


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.createDataFrame(ODD, SCHEMA)
    return frame.select("*", *[F.lit("clash").alias(c) for c in CLASH]).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def lowered(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def every_collocation(rows, least, longest, top, covered):
    counts, sizes = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for k in range(1, longest + 1):
                counts.update((lang, tuple(words[s:s + k])) for s in range(len(words) - k + 1))
    phrases = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    out = []
    for (lang, p), a in phrases.items():
        inside = any(x == lang and len(q) > len(p) and 100 * b >= covered * a
                     and any(q[s:s + len(p)] == p for s in range(len(q))) for (x, q), b in phrases.items())
        if not inside:
            score, _, left, right = min((1000 * a * sizes[lang] // (counts[lang, p[:k]] * counts[lang, p[k:]]), k,
                                         counts[lang, p[:k]], counts[lang, p[k:]]) for k in range(1, len(p)))
            out.append((lang, " ".join(p), a, left, right, sizes[lang], score))
    out.sort(key=lambda r: (r[0], -r[6], -r[2], r[1].encode()))
    ranks, ranked = Counter(), []
    for r in out:
        ranks[r[0]] += 1
        if top is None or ranks[r[0]] <= top:
            ranked.append((r[0], ranks[r[0]], *r[1:]))
    return sorted(ranked)


@pytest.mark.parametrize("least, longest, top, covered", [(2, 5, None, 100), (3, 4, 5, 100), (2, 5, None, 60), (1, 3, 7, 100)])
def test_collocations(docs, least, longest, top, covered):
    got = collocations.collocations(docs, least, longest, top, covered)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == every_collocation(ODD, least, longest, top, covered)


def test_collocations_over_many_groups(spark, monkeypatch):
    random.seed(3)
    words = [random.choice("a b c dd ee é the of　x".split(" ")) for _ in range(6000)]
    rows = [(i, " ".join(words[i * 40:i * 40 + 40]).replace("dd", random.choice(["dd", "dd.", "DD"])), random.choice(["en", None, "de"]), "s")
            for i in range(150)]
    monkeypatch.setattr(collocations, "GROUP", 300)
    monkeypatch.setattr(collocations, "COMMON", 8)
    got = collocations.collocations(spark.createDataFrame(rows, SCHEMA).repartition(5), 4)
    assert sorted(map(tuple, got.collect())) == every_collocation(rows, 4, 5, 2000, 100)


@pytest.mark.parametrize("seen", [np.full((2, 1 << 12), 255, np.uint8), None])
def test_collocations_of_a_full_map(docs, monkeypatch, seen):
    """A map that lets all through, and a small one, change nothing."""
    small = collocations.phrase_map
    monkeypatch.setattr(collocations, "phrase_map", lambda *a: small(*a, bits=15) if seen is None else seen)
    got = collocations.collocations(docs, 2)
    assert sorted(map(tuple, got.collect())) == every_collocation(ODD, 2, 5, 2000, 100)


def test_collocations_of_nothing(empty, docs):
    assert collocations.collocations(empty).count() == 0
    assert collocations.collocations(docs, least=10**9).count() == 0


def test_scores_beyond_64_bits(spark):
    big = 3 * 10**12
    phrases = spark.createDataFrame([("en", "p q", 2, big)], "lang string, phrase string, words int, a long")
    totals = spark.createDataFrame([("en", "p", big + 7), ("en", "q", big + 11)], "lang string, phrase string, a long")
    sizes = spark.createDataFrame([("en", 10**15)], "lang string, n long")
    row = collocations.scored(phrases, totals, sizes).first()
    assert row["score"] == 1000 * big * 10**15 // ((big + 7) * (big + 11))


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(registry.tokenizer_path())


def token_total(tokenizer, text):
    return len(tokenizer.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("remembered", [20, 500_000])
def test_prefix_counts_of_odd_texts(tokenizer, monkeypatch, remembered):
    monkeypatch.setattr(prefix_tokens, "REMEMBERED", remembered)
    monkeypatch.setattr(prefix_tokens, "PAIRS", remembered)
    counter = prefix_tokens.PrefixCounter(registry.tokenizer_path())
    random.seed(11)
    parts = ["a", "b", "the", " ", "  ", "\n", "\t", "'", "'re", "'ll", "l", "s", "1", "23", "!", "é", "漢字", "ß", "́",
             "\x85", "\x1c", " ", "　", "\U0001f600", "<|endoftext|>", "<|end", "...", "X", "ing", "don't", "\r\n", "==", "​", "ﬁ"]
    texts = ["".join(random.choices(parts, k=random.randint(0, 14))) for _ in range(1500)] + ["x" * 300, " " * 200 + "y", "ab" * 90]
    counts, ends = counter.of_texts(texts)
    begin = 0
    for text, end in zip(texts, ends):
        assert counts[begin:end].tolist() == [token_total(tokenizer, text[:i + 1]) for i in range(len(text))]
        begin = end


def test_prefix_table(docs, empty, tokenizer):
    table = prefix_tokens.prefix_table(docs, registry.tokenizer_path())
    for limit in (512, 3, 0):
        want = []
        for doc_id, text, *_ in ODD:
            text = text or ""
            sizes = [token_total(tokenizer, text[:i]) for i in range(len(text) + 1)] if len(text) < 1000 else None
            total = token_total(tokenizer, text)
            fits = max(i for i, n in enumerate(sizes) if n <= limit) if sizes else None
            want.append((doc_id, len(text.encode()), total, total > limit, fits))
        got = [(r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"], r["chars_within"] if r["n_bytes"] < 1000 else None)
               for r in prefix_tokens.within(table, limit).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    got = prefix_tokens.tokens_at(table.where("doc_id = 8"), [0, 5, 10**6]).collect()
    assert [tuple(r) for r in got] == [(8, n, token_total(tokenizer, ODD[8][1][:n])) for n in (0, 5, 10**6)]
    assert prefix_tokens.within(prefix_tokens.prefix_table(empty, registry.tokenizer_path()), 5).count() == 0
    assert prefix_tokens.tokens_at(prefix_tokens.prefix_table(empty, registry.tokenizer_path()), [1]).count() == 0


def test_wide_steps(spark, tokenizer):
    """A character that changes the count by more than a byte holds."""
    text = "a" + " " * 40_000 + "b"
    row = prefix_tokens.prefix_table(spark.createDataFrame([(1, text, None, None)], SCHEMA), registry.tokenizer_path()).first()
    counts = prefix_tokens.counts_of(row["steps"], row["n_chars"])
    assert counts[-1] == token_total(tokenizer, text) and counts[-2] == token_total(tokenizer, text[:-1])


def test_op12_counts_whole_texts(spark, sf_dir, tokenizer):
    texts = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    for r in registry.op12_token_counts(spark, sf_dir).collect():
        text = texts[r["doc_id"]] or ""
        n = token_total(tokenizer, text)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 512)
        assert token_total(tokenizer, text[:r["chars_within"]]) <= 512


def test_prefix_counts_learn_words_together(tokenizer, monkeypatch):
    """Words beside marks and line feeds are known as single pre-tokens, and only odd pieces are worked off one by one."""
    counter = prefix_tokens.PrefixCounter(registry.tokenizer_path())
    one_by_one = []
    alone = counter.of_text
    monkeypatch.setattr(counter, "of_text", lambda text: one_by_one.append(text) or alone(text))
    draw = random.Random(5)
    words = ["".join(draw.choices("abeinrstü", k=draw.randint(1, 20))) for _ in range(200)] + ["123", "==", "Œuvre", "x" * 24, "y" * 25]
    texts = [a + w + b + v for w in words for v in words[:3] for a in ("", " ", "\n") for b in (". ", ",\n", "$$$ ", "/")]

    def same(texts):
        counts, ends = counter.of_texts(texts)
        begin = 0
        for text, end in zip(texts, ends):
            assert counts[begin:end].tolist() == [token_total(tokenizer, text[:i + 1]) for i in range(len(text))], text
            begin = end

    counts, ends = counter.of_texts(texts)
    assert len(one_by_one) < 10  # 4,731 when texts were cut at spaces alone
    same(texts[::19])
    end = "<|endoftext|>"
    odd = [f"{a}{gap}{b}" for gap in (" ", "  ", "\n", "\n ", " \n", "\t", "\r\n", "\u3000 ", "\xa0 ", "\u2009 ", "\x1c ", "\x85 ", "")
           for a in ("", "a", "é", "1", "'", "漢", "\u0444", end, "ª", "\x00") for b in ("", "b", "'re", "'rex", ".", end, "\u0301", "|>")]
    same(odd)
    counter = prefix_tokens.PrefixCounter(registry.tokenizer_path())
    counter.automaton.sound = False  # as for a tokenizer whose merges don't number its tokens: all pieces one by one
    same(texts[:60] + odd[::9])


def test_valid_neighbours():
    """Undoing merges tells the same neighbours as encoding their bytes."""
    counter = prefix_tokens.PrefixCounter(registry.tokenizer_path())
    random.seed(8)
    tokens = [bytes((b,)) for b in range(256)] + [a + b for a, b in (
        (counter.bytes_of[k // counter.size], counter.bytes_of[k % counter.size]) for k in counter.merges)]
    common = [i for i in range(256, 3000)]
    pairs = [(random.choice(common), random.choice(common)) for _ in range(4000)] + [
        (random.randrange(len(tokens)), random.randrange(len(tokens))) for _ in range(1000)]
    left, right = (np.array(side) for side in zip(*pairs))
    want = [counter._valid(counter.vocabulary[tokens[a]], counter.vocabulary[tokens[b]]) for a, b in pairs]
    assert counter.automaton.valid(left, right).tolist() == want
    assert 0 < sum(want) < len(want)


def test_prefix_counts_hold_little(monkeypatch):
    """A worker takes little more for many new words than for its texts, and keeps little of them."""
    class Docs:
        def selectExpr(self, *columns):
            return self

        def mapInArrow(self, work, schema):
            return work

    draw = random.Random(3)
    texts = [" ".join("".join(draw.choices("abcdefghij", k=5)) for _ in range(400)) for _ in range(2500)]
    batch = pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    work = prefix_tokens.prefix_table(Docs(), registry.tokenizer_path())
    for _ in work(iter([batch.slice(0, 1)])):  # the tokenizer
        pass
    tracemalloc.start()
    rows = sum(len(out) for out in work(iter([batch])))
    kept, peak = (x >> 20 for x in tracemalloc.get_traced_memory())
    tracemalloc.stop()
    assert rows == len(texts)
    assert kept < 20 and peak < 60  # 33 and 161 MB when each new piece had counts and lists of its own
    counter = prefix_tokens.PrefixCounter(registry.tokenizer_path())
    monkeypatch.setattr(prefix_tokens, "REMEMBERED", 1000)
    for i in range(20):  # long odd pieces are forgotten by their size
        counter.of_texts([chr(0x4E00 + i) * 5000])
    assert counter.used <= 40_000 and not counter.parts


def every_variant(rows, shortest, least, times):
    n = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", lowered(text)):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            at = h % len(run)
            n[run[:at] + run[at + 1:] if h % 31 == 0 else run] += 1
    n = {w: c for w, c in n.items() if len(w) >= shortest and c >= least}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        if len(a) > len(b):
            a, b = b, a
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    others = {w: [x for x in n if near(w, x)] for w in n}
    form = {}
    for w, found in others.items():
        best = min(found, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= times * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(others[w]), n.get(form[w])))
    return sorted(out, key=str)


def words_of(counts):
    return " ".join(w for w, c in counts.items() for _ in range(c))


@pytest.mark.parametrize("shortest, least, times", [(7, 2, 10), (1, 1, 2), (3, 1, 3)])
def test_spelling_variants(docs, spark, shortest, least, times):
    random.seed(shortest)
    noisy = [(i, " ".join("".join(random.choices("abÿ", k=random.randint(1, 9))) for _ in range(60)), None, None) for i in range(8)]
    chain = words_of({"abcdefgh": 300, "abcdefgx": 29, "abcdefyx": 2, "aabcdefgh": 4, "abcdefg": 30, "abbbbbcd": 2, "abbbbcd": 40,
                      "écdefgh": 3, "bcdefgh": 3, "abcdefgH": 2})
    rows = ODD + noisy + [(100, chain, "en", "a"), (None, chain, None, None)]
    frame = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit("clash").alias(c) for c in CLASH]).repartition(4)
    got = spelling.spelling_variants(frame, shortest, least, times)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect()), key=str) == every_variant(rows, shortest, least, times)


def test_spelling_groups_across_batches(spark):
    words = spark.createDataFrame([(f"abcdefg{c}", i + 1) for i, c in enumerate("abcdefghijklmnopqrstuvwxyz")], "word string, n long")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        got = {r["word"]: (r["n_near"], r["best"]) for r in spelling.neighbours(words).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got["abcdefga"] == (25, "abcdefgz") and got["abcdefgz"] == (25, "abcdefgy") and len(got) == 26


def test_spelling_of_nothing(empty):
    assert spelling.spelling_variants(empty).count() == 0


def test_token_files_equal_the_tokenizer(spark, docs, empty, tokenizer, monkeypatch):
    """Ids and checksums over odd texts, with little and much remembered."""
    random.seed(12)
    parts = ["a", "the", " ", "  ", "\n", "'re", "1", "!", "é", "漢字", "\x85", "\xa0", "　", "<|endoftext|>", "Â", " x", "Ã ", "\x00", "\U0001f600"]
    rows = [(i, "".join(random.choices(parts, k=random.randint(0, 20))), None, None) for i in range(400)] + ODD
    encoder = token_files.Encoder(registry.tokenizer_path())
    for remembered in (10, 700_000):
        monkeypatch.setattr(token_files, "REMEMBERED", remembered)
        monkeypatch.setattr(token_files, "PARTS", remembered)
        for low in range(0, len(rows), 50):
            texts = [r[1] or "" for r in rows[low:low + 50]]
            ids, ends = encoder.encoded(pa.array(texts, pa.string()))
            assert [x.tolist() for x in np.split(ids, ends[:-1])] == [
                tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    got = token_files.token_files(spark.createDataFrame(rows, SCHEMA).repartition(4), registry.tokenizer_path(), False)
    want = []
    for doc_id, text, *_ in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        want.append((doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got.collect()), key=str) == sorted(want, key=str)


def test_token_files_learn_each_word_once(tokenizer):
    """Marks and line feeds beside a word make no new pieces to tokenise; white space and special strings stay whole."""
    words = ["cat", "Mat", "über", "ſo", "x1", "don't", "×y", "Œuvre", "нет"]
    texts = [a + w + b + v for w in words for v in words for a in ("", " ", "\n") for b in (". ", ",\n", "$$$ ", "!", "/", " '")]
    encoder = token_files.Encoder(registry.tokenizer_path())

    def same(rows):
        ids, ends = encoder.encoded(pa.array(rows, pa.string()))
        assert [x.tolist() for x in np.split(ids, ends[:-1])] == [tokenizer.encode(t, add_special_tokens=False).ids for t in rows]

    same([t for t in texts if t.isascii()])
    assert len(encoder.number) < 60  # 184 when they were cut at spaces alone
    same(texts)
    end = "<|endoftext|>"
    same([f"{a}{gap}{b}" for gap in (" ", "  ", "\n", "\n ", " \n", "\t", "\n\n", "\r\n", "　 ", "\xa0 ", "\x1c", "\x85", "")
          for a in ("", "a", "é", "1", "'", ".", end, "ª", "\x00") for b in ("", "b", "é", "2", "'s", ".", end, "́", "|>")])


def test_token_files_hold_little(spark):
    """A worker takes little more for a batch of new words than for its texts, and keeps nothing that Arrow doesn't use."""
    class Docs:
        def select(self, *columns):
            return self

        def mapInArrow(self, work, schema):
            return work

    def resident():
        with open("/proc/self/smaps_rollup") as f:
            return int(re.search(r"\nPss_Anon:\s+(\d+)", f.read())[1]) >> 10

    draw = random.Random(3)
    texts = [" ".join("".join(draw.choices("abcdefghij", k=4)) for _ in range(500)) for _ in range(6000)]
    batch = pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    work = token_files.tokenised(Docs(), registry.tokenizer_path(), 300_000)
    for _ in work(iter([batch.slice(0, 1)])):  # the tokenizer
        pass
    pa.default_memory_pool().release_unused()
    tracemalloc.start()
    rows = sum(len(out) for out in work(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1] >> 20
    tracemalloc.stop()
    held = resident()
    pa.default_memory_pool().release_unused()
    assert rows == len(texts)
    assert peak < 60  # 81 MB when 4 MB of text were looked up together
    assert held - resident() < 8
