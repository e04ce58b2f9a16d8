"""Text predicates and rewrites as Spark columns.

All patterns spell out the Unicode word and space classes. Java's ``\\w`` is ASCII-only and
its ``(?U)`` variant also takes in combining marks, so neither agrees with the usual
letters-digits-underscore reading; the explicit classes do, in every engine.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterable, Sequence
from functools import lru_cache, reduce
from itertools import zip_longest

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

WORD = r"[\p{L}\p{N}_]"
NOT_WORD = r"[^\p{L}\p{N}_]"
SPACE = r"[\t-\r\x1c-\x1f \x85\p{Z}]"
NOT_SPACE = r"[^\t-\r\x1c-\x1f \x85\p{Z}]"
EDGE = rf"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))"

ELLIPSIS_MARK = " […]"


def or_empty(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def char_len(text: Column) -> Column:
    """Length in code points."""
    return F.length(text)


def word_len(text: Column) -> Column:
    """Number of whitespace-separated pieces; empty pieces do not count."""
    return F.size(F.filter(F.split(text, SPACE + "+"), lambda piece: piece != ""))


def portable(pattern: str) -> str:
    r"""Rewrite the shorthands ``\w \W \b \d \s`` (outside character classes) to explicit classes."""
    classes = {r"\w": WORD, r"\W": NOT_WORD, r"\b": EDGE, r"\d": r"\p{Nd}", r"\s": SPACE}
    return re.sub(r"\\[wWbds]", lambda m: classes[m.group(0)], pattern)


def _is_literal(term: str) -> bool:
    return re.escape(term).replace("\\ ", " ").replace("\\-", "-") == term


def contains_term(lowered: Column, terms: Sequence[str], whole_words: bool = True) -> Column:
    """True when any term occurs in an already lower-cased text.

    Plain words are first looked for with ``contains``; only texts that pass pay for the
    regular expression, which on ordinary text is a few percent of the rows.
    """
    literals = [t for t in terms if _is_literal(t)]
    patterns = [t for t in terms if not _is_literal(t)]
    tests = []
    if literals:
        seen = reduce(lambda a, b: a | b, [lowered.contains(t) for t in literals])
        if whole_words:
            seen = seen & lowered.rlike(f"(?:^|{NOT_WORD})(?:{'|'.join(literals)})(?:$|{NOT_WORD})")
        tests.append(seen)
    if patterns:
        body = "|".join(portable(p) for p in patterns)
        tests.append(lowered.rlike(f"{EDGE}(?:{body}){EDGE}" if whole_words else body))
    return F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False)) if tests else F.lit(False)


def near_terms(lowered: Column, markers: Sequence[str], terms: Sequence[str], gap: int = 30) -> Column:
    """A whole-word marker followed by a whole-word term at most ``gap`` characters later, same line."""
    inner = r"[^\p{L}\p{N}_\n]"
    between = rf"(?:{inner}|{inner}[^\n]{{0,{gap - 2}}}{inner})"
    return F.coalesce(
        lowered.rlike(
            f"(?:^|{NOT_WORD})(?:{'|'.join(markers)}){between}(?:{'|'.join(terms)})(?:$|{NOT_WORD})"
        ),
        F.lit(False),
    )


def mask_stems(text: Column, stems: Sequence[str]) -> Column:
    """Star out words that begin with a listed stem, keeping the first character and the length.

    One ``regexp_replace``: the first branch takes the first two characters of such a word,
    the ``\\G`` branch walks on through the rest of the same word.
    """
    if not stems:
        return text
    heads = "|".join(re.escape(s) for s in stems)
    pattern = rf"(?iu)(?:(?<!{WORD})(?=(?:{heads}))({WORD})|(?!^)\G)({WORD})"
    return F.regexp_replace(text, pattern, "$1*")


def redact(text: Column, stems: Sequence[str] = (), width: int = 240) -> Column:
    """Excerpt that is safe to show: links, addresses, handles, long numbers and listed words removed.

    The order is fixed: an address would otherwise be eaten by the handle rule.
    """
    t = text.cast("string")
    t = F.regexp_replace(t, rf"https?://{NOT_SPACE}+|www\.{NOT_SPACE}+", "[URL]")
    t = F.regexp_replace(
        t,
        rf"{EDGE}[\p{{L}}\p{{N}}_.+-]+@[\p{{L}}\p{{N}}_-]+\.[\p{{L}}\p{{N}}_.-]+{EDGE}",
        "[EMAIL]",
    )
    t = F.regexp_replace(t, rf"@{WORD}+", "[USER]")
    t = F.regexp_replace(t, rf"(?<!{WORD})\p{{Nd}}{{4,}}(?!{WORD})", "[NUM]")
    t = mask_stems(t, stems)
    t = F.trim(F.regexp_replace(t, SPACE + "+", " "))
    cut = F.concat(F.rtrim(F.substring(t, 1, width)), F.lit(ELLIPSIS_MARK))
    return F.when(F.length(t) > width, cut).otherwise(t)


def tokens(lowered: Column) -> Column:
    """Runs of word characters, in order."""
    return F.filter(F.split(lowered, NOT_WORD + "+"), lambda piece: piece != "")


def without(words: Column, stop_words: Iterable[str]) -> Column:
    stop = sorted(set(stop_words))
    return F.filter(words, lambda w: ~w.isin(stop)) if stop else words


def grams(kept: Column, longest: int = 2) -> Column:
    """1- to n-grams over a word array. Pass a plain column: it is referred to several times."""
    parts = [kept]
    for n in range(2, longest + 1):
        count = F.greatest(F.size(kept) - (n - 1), F.lit(0))
        joined = F.slice(kept, F.lit(1), count)
        for i in range(1, n):
            joined = F.zip_with(joined, F.slice(kept, F.lit(i + 1), count), lambda a, b: F.concat_ws(" ", a, b))
        parts.append(joined)
    return F.concat(*parts)


def bare(text: str) -> str:
    """Compatibility decomposition without combining marks."""
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


def _class_of(codes: Sequence[int], gap: Callable[[int], int] = lambda code: 0) -> str:
    """A regular-expression class of ascending code points, as ranges; gaps up to ``gap(code)`` are taken in."""
    ranges: list[list[int]] = []
    for code in codes:
        if ranges and code - ranges[-1][1] <= gap(code) + 1:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    return "[" + "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in ranges) + "]"


#: The Hangul syllables follow from three rows of letters by arithmetic: first code, vowels times finals, finals.
_HANGUL, _BLOCK, _FINALS = 0xAC00, 588, 28
_HANGUL_CLASS = r"[\x{AC00}-\x{D7A3}]"


@lru_cache(maxsize=1)
def _folding_table() -> tuple[str, str, str, str, str]:
    """Accent folding of every code point, derived from the Unicode database.

    Characters that fold to one other, and what they fold to, with the marks, which fold to nothing,
    last. Then those that fold to several: a class of few ranges that holds them, the exact class, and
    the characters with what they fold to.
    """
    source, target, dropped, several, spelled = [], [], [], [], []
    for code in range(0x80, 0x110000):
        if 0xD800 <= code <= 0xDFFF or _HANGUL <= code <= 0xD7A3:
            continue
        ch = chr(code)
        plain = bare(ch)
        if plain == ch:
            continue
        if not plain:
            dropped.append(ch)
        elif len(plain) == 1:
            source.append(ch)
            target.append(plain)
        else:
            several.append(code)
            spelled.append(f"\x02{ch}\x01{plain}")
    return "".join(source + dropped), "".join(target), _class_of(
        sorted([*several, *range(_HANGUL, 0xD7A4)]), lambda code: 3 if code < 0x250 else 0x800), _class_of(several), "".join(spelled) + "\x02"


def _each_replaced(text: Column, among: str, by: Callable[[Column], Column]) -> Column:
    """Replaces every character of the class by what ``by`` makes of it, one kind of character at a time."""
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(among), F.lit(0)))
    return F.aggregate(found, text, lambda held, ch: F.replace(held, ch, by(ch)))


def _jamo(syllable: Column) -> Column:
    """The two or three letters that a Hangul syllable is made of."""
    first = "".join(map(chr, range(0x1100, 0x1113)))
    vowels = "".join(map(chr, range(0x1161, 0x1176)))
    last = "".join(map(chr, range(0x11A8, 0x11C3)))
    place = F.ascii(syllable) - _HANGUL
    final = place % _FINALS
    return F.concat(
        F.substring(F.lit(first), F.floor(place / _BLOCK).cast("int") + 1, F.lit(1)),
        F.substring(F.lit(vowels), F.floor(place % _BLOCK / _FINALS).cast("int") + 1, F.lit(1)),
        F.when(final > 0, F.substring(F.lit(last), final, F.lit(1))).otherwise(""))


def fold_accents(text: Column) -> Column:
    """Compatibility decomposition without combining marks, inside the JVM, for any script.

    Plain ASCII texts pass untouched. Characters that fold to one other are translated in one pass.
    Those that fold to several (ligatures, fractions, enclosed and presentation forms, Hangul) are
    rare; texts that hold any, by a class test, have each kind replaced. A folded character is never
    folded again, so the order is free.
    """
    source, target, likely, several, spelled = _folding_table()

    def entry(ch: Column) -> Column:  # what stands between the character's own key and the next one
        behind = F.call_function("substring_index", F.lit(spelled), F.concat(F.lit("\x02"), ch, F.lit("\x01")), F.lit(-1))
        return F.substring_index(behind, "\x02", 1)

    rare = F.when(text.rlike(likely), _each_replaced(_each_replaced(text, several, entry), _HANGUL_CLASS, _jamo))
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(rare.otherwise(text), source, target)).otherwise(text)


@lru_cache(maxsize=1)
def _unfolded() -> str:
    """A class of the characters that folding leaves alone, or makes letters of a block as new as themselves."""
    source, target, _, several, _ = _folding_table()
    known = sorted(ord(c) for c, t in zip_longest(source, target, fillvalue="") if not "\U0001DF00" <= t <= "\U0001DFFF")
    return "[^" + "".join(x[1:-1] for x in (_class_of(known), several, _HANGUL_CLASS)) + "]"


def without_unassigned(text: Column, fold: bool = False) -> Column:
    """Spaces for code points that the JVM's Unicode has not assigned, which belong to no word here and in the patterns
    above; with ``fold``, those that folding knows stay."""
    unknown = rf"[\p{{Cn}}&&{_unfolded()}]" if fold else r"\p{Cn}"
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.regexp_replace(text, unknown, " ")).otherwise(text)


def fold_accents_full(text: Column) -> Column:
    """Compatibility decomposition without combining marks, for any script (Arrow batches)."""

    def fold(value):
        return value if value is None or value.isascii() else bare(value)

    @F.pandas_udf(StringType())
    def folded(values: pd.Series) -> pd.Series:
        return values.map(fold)

    return folded(text)
