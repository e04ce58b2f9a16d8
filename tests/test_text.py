"""Text columns against plain Python."""

import re
import unicodedata

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plimsoll.functions import text as T

STEMS = ["idiot", "shit", "moron"]
PIECES = ["idiot", "Idiotic", "élan", "x", "https://a.b/c?d=1", "www.q.org", "me.x+1@host-a.co.uk", "@you", "a@b.c+d@e.f",
          "12345", "a1234", "1234", "٣٤٥٦", "1234_", "sh-it", "MORONS", ".", ",", "-", "_", "ñ@x.é.", "état", " ", "\n",
          "  ", "\t", "é", "½", "²", "ﬁ", "@", "www.", "1234 5678", "_moron"]
texts = st.lists(st.lists(st.sampled_from(PIECES + list("ab@. ")), max_size=12).map("".join), min_size=30, max_size=60)
relaxed = settings(max_examples=8, deadline=None, derandomize=True, database=None,
                   phases=[Phase.explicit, Phase.generate], suppress_health_check=list(HealthCheck))


def column(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[0] for r in df.select("i", expr.alias("o")).orderBy("i").select("o").collect()]


REDACTED = {
    "see https://a.b/c?d=1 now": "see [URL] now", "at www.q.org/x, ok": "at [URL] ok",
    "write me.x+1@host-a.co.uk today": "write [EMAIL] today", "hi @you and @me_2!": "hi [USER] and [USER]!",
    "call 12345 or 123": "call [NUM] or 123", "a1234 1234_ 1234": "a1234 1234_ [NUM]",
    "two  spaces\n\tand a line ": "two spaces and a line", "an Idiotic MORON": "an I****** M****",
    "sh-it shit": "sh-it s***", "plain": "plain", "": "",
}


def test_redact_by_example(spark):
    assert column(spark, list(REDACTED), T.redact(F.col("t"), STEMS)) == list(REDACTED.values())


def test_mask_by_example(spark):
    masked = {"idiot": "i****", "Idiotically so": "I********** so", "_moron": "_moron", "a moron, a shit.": "a m****, a s***.",
              "no idi ot": "no idi ot"}
    assert column(spark, list(masked), T.mask_stems(F.col("t"), STEMS)) == list(masked.values())


@given(texts)
@relaxed
def test_mask_keeps_length_and_is_idempotent(spark, values):
    once = column(spark, values, T.mask_stems(F.col("t"), STEMS))
    assert [len(g) for g in once] == [len(v) for v in values]
    assert column(spark, once, T.mask_stems(F.col("t"), STEMS)) == once


@given(texts)
@relaxed
def test_redacted_texts_hold_no_long_number_and_no_link(spark, values):
    for got in column(spark, values, T.redact(F.col("t"), STEMS, 10_000)):
        assert not re.search(r"(?<!\w)\d{4,}(?!\w)|https?://\S|\s\s", got)
        assert got == got.strip()


@given(texts)
@relaxed
def test_redact_is_idempotent_below_the_cut(spark, values):
    once = column(spark, values, T.redact(F.col("t"), STEMS, 10_000))
    assert column(spark, once, T.redact(F.col("t"), STEMS, 10_000)) == once


@given(texts)
@relaxed
def test_lengths_and_tokens(spark, values):
    assert column(spark, values, T.char_len(F.col("t"))) == [len(v) for v in values]
    assert column(spark, values, T.word_len(F.col("t"))) == [len(v.split()) for v in values]
    assert column(spark, values, T.tokens(F.lower("t"))) == [re.findall(r"\w+", v.lower()) for v in values]


@given(texts)
@relaxed
def test_whole_word_terms(spark, values):
    pattern = re.compile(r"\b(?:idiot|x|état)\b")
    got = column(spark, values, T.contains_term(F.lower("t"), ["idiot", "x", "état"]))
    assert got == [bool(pattern.search(v.lower())) for v in values]


def test_redact_cuts_and_marks(spark):
    text = "word " * 100
    assert column(spark, [text, None], T.redact(F.col("t"), [], 12)) == ["word word wo […]", None]


def test_accent_folding(spark):
    def fold(v):
        return "".join(c for c in unicodedata.normalize("NFKD", v) if not unicodedata.combining(c))

    latin = ["Crème brûlée", "ÀÉÎõüñç", "plain", "Ｆｕｌｌ", "é"]
    assert column(spark, latin, T.fold_accents(F.col("t"))) == [fold(v) for v in latin]
    wide = [*latin, "ﬁne ½", "한글"]
    assert column(spark, wide, T.fold_accents_full(F.col("t"))) == [fold(v) for v in wide]


def test_accent_folding_of_every_character(spark):
    """Every assigned code point, many to a text and between others."""
    codes = [c for c in range(1, 0x110000) if unicodedata.category(chr(c)) not in ("Cn", "Co", "Cs")]
    texts = ["".join(f"x{chr(c)}" for c in codes[i:i + 97]) for i in range(0, len(codes), 97)]
    want = ["".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)) for t in texts]
    assert column(spark, texts, T.fold_accents(F.col("t"))) == want
    assert column(spark, [None, "", "ﬁ"], T.fold_accents(F.col("t"))) == [None, "", "fi"]


def test_near_terms(spark):
    markers, groups = ["being a", "speaking as"], ["baker", "sailor"]
    wanted = {
        "being a baker": True, "being a kind and rather careful old baker": True, "being a\nsailor": False,
        "seeing a baker": False, "wellbeing a baker": False, "being a bakery": False, "a baker, being a sort": False,
        "being a " + "x" * 28 + " baker": True, "being a " + "x" * 29 + " baker": False,
    }
    got = column(spark, list(wanted), T.near_terms(F.lower("t"), markers, groups))
    assert got == list(wanted.values())


def test_grams_span_removed_words(spark):
    df = spark.createDataFrame([(["big", "the", "cat"],), ([],), (["one"],)], "w array<string>")
    kept = df.select(T.without(F.col("w"), ["the"]).alias("w"))
    assert [r[0] for r in kept.select(T.grams(F.col("w"))).collect()] == [["big", "cat", "big cat"], [], ["one"]]


def test_lexicon_patterns(spark):
    values = ["b-o g.", "bo*g", "please leave our tea", "leave hours ago", "nothing"]
    spaced, phrase = [r"b\W*o\W*g"], [r"\bleave our\b"]
    assert column(spark, values, T.contains_term(F.lower("t"), spaced, False)) == [True, True, False, False, False]
    assert column(spark, values, T.contains_term(F.lower("t"), phrase, False)) == [False, False, True, False, False]
