"""Collocated phrases by stripes: each prefix keys an associative counter of its next words.

A task counts the windows of k words that it reads and writes one stripe a prefix of k - 1 words; the
stripes of a prefix are merged element by element. One structure gives what the measures need: an
entry is the count of the longer phrase, the largest entry says which longer phrase subsumes its
prefix, and the entries of the shorter stripes are the totals of all parts of a phrase.

Phrases grow by a word a level, since a phrase is frequent only if both of its shorter ends are. What
the level before found reaches the tasks as a bitmap of hashes of a fixed size, whatever the corpus:
it can only let too much through, and counts are of words, not of hashes. A second such map marks
prefixes that make up a thousandth of a language; their stripes are dealt over PARTS by the
next words, so that no prefix is one group. Levels are stored, so a lost executor repeats part of one level.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plimsoll.llm.textbytes import groups, text_bytes, window_hashes, word_hashes
from plimsoll.sources.stage import staged

#: Bytes of text that are counted before stripes are written.
GROUP = 1 << 22
#: A prefix is common if it occurs once in so many words of its language; its stripe is dealt over PARTS.
COMMON = 1000
PARTS = 64
#: log2 of the bits of the map of frequent phrases (8 MB); 15 at least.
MAP_BITS = 26
_BUCKET = 1 << 15
_BREAK, _GAP = 0x0A, 0x20


def _plain() -> np.ndarray:
    """Bytes as the counting sees them: lower case, one white space, one end of a piece."""
    table = np.arange(256, dtype=np.uint8)
    table[list(string.ascii_uppercase.encode())] = list(string.ascii_lowercase.encode())
    table[list(b".,;:!?\n\x0b\x0c\r")] = _BREAK
    table[ord("\t")] = _GAP
    return table


_PLAIN = _plain()


class Words:
    """The words of a group of texts: places, hashes, pieces and languages."""

    def __init__(self, batch: pa.RecordBatch):
        data, offsets = text_bytes(batch.column("text"))
        self.data = _PLAIN[data]
        inside = (self.data != _BREAK) & (self.data != _GAP)
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        edges = offsets[:-1][np.diff(offsets) > 0]
        first[edges] = inside[edges]
        last[edges[edges > 0] - 1] = inside[edges[edges > 0] - 1]
        self.starts, self.ends = np.nonzero(first)[0], np.nonzero(last)[0] + 1
        text = np.searchsorted(offsets, self.starts, "right") - 1
        self.piece = np.cumsum(self.data == _BREAK)[self.starts] + text
        langs = batch.column("lang").dictionary_encode()
        self.langs = langs.dictionary.to_pylist()
        self.lang = np.asarray(langs.indices)[text].astype(np.int64)

    def strings(self, at: np.ndarray) -> pa.StringArray:
        """The words of the given numbers."""
        sizes = (self.ends - self.starts)[at]
        ends = np.cumsum(sizes)
        places = np.repeat(self.starts[at] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
        offsets = np.zeros(len(at) + 1, np.int32)
        offsets[1:] = ends
        return pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(self.data[places]))

    def windows(self, size: int) -> np.ndarray:
        """Hashes of the window of `size` words from each word, as the maps have them; ends of pieces are not looked at."""
        hashed = window_hashes(word_hashes(self.data, self.starts, self.ends), size)
        keys = np.array([_language(x) for x in self.langs] or [0], np.uint64)
        return hashed ^ keys[self.lang[:len(hashed)]]


def _language(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang)


def _place(hashed: np.ndarray, bits: int) -> np.ndarray:
    return (hashed >> np.uint64(64 - bits)).astype(np.int64)


def _held(seen: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    place = _place(hashed, len(seen).bit_length() + 2)
    return (seen[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")


def word_totals(docs: DataFrame) -> DataFrame:
    """lang, phrase (one word), a: occurrences of every word."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in groups(batch, most=GROUP):
                found = Words(group)
                if not len(found.starts):
                    continue
                each = found.strings(np.arange(len(found.starts))).dictionary_encode()
                codes, counts = np.unique(found.lang * len(each.dictionary) + np.asarray(each.indices),
                                          return_counts=True)
                yield pa.record_batch(
                    [pa.array(found.langs, pa.string()).take(pa.array(codes // len(each.dictionary))),
                     each.dictionary.take(pa.array(codes % len(each.dictionary))), pa.array(counts)],
                    names=["lang", "phrase", "a"])

    return _texts(docs).mapInArrow(work, "lang string, phrase string, a long").groupBy("lang", "phrase").agg(
        F.sum("a").alias("a"))


def phrase_map(phrases: DataFrame, size: int, bits: int = MAP_BITS) -> np.ndarray:
    """Two bitmaps of the hashes of (lang, phrase) for phrases of `size` words: of all, and of the common ones.

    2^bits bits each, however many phrases there are.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("phrase"))
            # words of a phrase can hold control characters, so the phrase is cut at spaces alone
            starts = np.sort(np.concatenate([offsets[:-1], np.nonzero(data == _GAP)[0] + 1]))
            ends = np.sort(np.concatenate([offsets[1:], np.nonzero(data == _GAP)[0]]))
            hashed = window_hashes(word_hashes(data, starts, ends), size)[::size]
            langs = batch.column("lang").dictionary_encode()
            keys = np.array([_language(x) for x in langs.dictionary.to_pylist()] or [0], np.uint64)
            place = _place(hashed ^ keys[np.asarray(langs.indices)], bits)
            common = place[batch.column("common").to_numpy(zero_copy_only=False)] + (1 << bits)
            yield pa.record_batch([pa.array(np.concatenate([place, common]))], names=["place"])

    found = phrases.select("lang", "phrase", "common").mapInArrow(work, "place long").groupBy(
        F.floor(F.col("place") / _BUCKET).alias("bucket")).agg(
        F.bitmap_construct_agg(F.col("place") % _BUCKET).alias("bits"))
    seen = np.zeros((1 << bits) // 4, np.uint8)
    for row in found.toLocalIterator():  # 2^bits / 2^14 rows at most
        at = row["bucket"] * _BUCKET // 8
        seen[at:at + _BUCKET // 8] = np.frombuffer(row["bits"], np.uint8)
    return seen.reshape(2, -1)


def stripes(docs: DataFrame, size: int, seen: np.ndarray) -> DataFrame:
    """lang, prefix, part, stripe: counters of the next words, for windows of `size` words whose both shorter
    ends are in the map; several rows a prefix and part, to be merged.

    A stripe is written as its entries, one a line: the word and, if it is not 1, a space and the count.
    """
    shared = docs.sparkSession.sparkContext.broadcast(seen)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, common = shared.value
        for batch in batches:
            for group in groups(batch, most=GROUP):
                found = Words(group)
                count = len(found.starts) - size + 1
                if count < 1:
                    continue
                hashed = found.windows(size - 1)
                known = _held(frequent, hashed)
                at = np.nonzero(known[:-1] & known[1:] & (found.piece[:count] == found.piece[size - 1:]))[0]
                if not len(at):
                    continue
                # words of the windows as numbers, prefixes as numbers of their rows of words
                used = np.zeros(len(found.starts), bool)
                for i in range(size):
                    used[at + i] = True
                each = found.strings(np.nonzero(used)[0]).dictionary_encode()
                code, most = np.zeros(len(used), np.int64), len(each.dictionary)
                code[used] = np.asarray(each.indices)
                prefix = found.lang[at]
                for i in range(size - 1):
                    _, sample, prefix = np.unique(prefix * most + code[at + i], return_index=True, return_inverse=True)
                sample = at[sample]
                entries, counts = np.unique(prefix * most + code[at + size - 1], return_counts=True)
                prefix, follower = entries // most, entries % most
                share = np.zeros(most, np.int64)
                share[code[used]] = (word_hashes(found.data, found.starts[used], found.ends[used])
                                     % np.uint64(PARTS)).astype(np.int64)
                part = np.where(_held(common, hashed[sample])[prefix], share[follower], 0)
                order = np.argsort(prefix * PARTS + part, kind="stable")
                prefix, follower, part, counts = prefix[order], follower[order], part[order], counts[order]
                begins = np.nonzero(np.diff(prefix * PARTS + part, prepend=-1))[0]
                owner = sample[prefix[begins]]
                parts = [each.dictionary.take(pa.array(code[owner + i])) for i in range(size - 1)]
                nexts = each.dictionary.take(pa.array(follower))
                numbers = pa.array(counts)
                entry = pc.if_else(pc.greater(numbers, 1),
                                   pc.binary_join_element_wise(nexts, numbers.cast(pa.string()), " "), nexts)
                lists = pa.ListArray.from_arrays(pa.array(np.append(begins, len(prefix)).astype(np.int32)), entry)
                yield pa.record_batch(
                    [pa.array(found.langs, pa.string()).take(pa.array(found.lang[owner])),
                     pc.binary_join_element_wise(*parts, " ") if size > 2 else parts[0],
                     pa.array(part[begins].astype(np.int32)), pc.binary_join(lists, "\n")],
                    names=["lang", "prefix", "part", "stripe"])

    return _texts(docs).mapInArrow(work, "lang string, prefix string, part int, stripe string")


def merged(found: DataFrame, least: int) -> DataFrame:
    """lang, prefix, next, a: the entries of the stripes added up, those of at least `least`."""
    rows = found.repartition("lang", "prefix", "part").select(
        "lang", "prefix", "part", F.explode(F.split("stripe", "\n")).alias("entry"))
    number = F.split_part("entry", F.lit(" "), F.lit(2))
    return rows.groupBy("lang", "prefix", "part", F.substring_index("entry", " ", 1).alias("next")).agg(
        F.sum(F.when(number == "", 1).otherwise(number.cast("long"))).alias("a")).where(F.col("a") >= least).drop("part")


def scored(phrases: DataFrame, totals: DataFrame, sizes: DataFrame) -> DataFrame:
    """Adds l, r, n and score of each phrase's lowest-scoring cut, ties to the earliest.

    `phrases` has lang, phrase, words and a; `totals` has lang, phrase and a of every part that occurs
    in them; `sizes` has lang and n. Products are decimals of 38 digits, the quotient is whole.
    """
    cut = F.col("cut")
    cuts = phrases.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "lang", "phrase", "a", "cut", F.expr("substring_index(phrase, ' ', cut)").alias("first"),
        F.expr("substring_index(phrase, ' ', cut - words)").alias("rest"))
    part = totals.select(F.col("lang"), F.col("phrase").alias("part"), F.col("a").alias("total"))
    for name, total in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(part.withColumnsRenamed({"part": name, "total": total}), ["lang", name])
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "n", "l", "r")}
    quotient = cuts.join(sizes, "lang").withColumns({f"{c}_wide": w for c, w in wide.items()}).withColumn(
        "score", F.expr("(a_wide * n_wide * 1000BD) div (l_wide * r_wide)"))
    lowest = quotient.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", cut, "l", "r")).alias("low"))
    return lowest.select("lang", "phrase", "a", "low.l", "low.r", "n", "low.score")


def collocations(docs: DataFrame, least: int = 100, longest: int = 5, top: int | None = 2000,
                 covered: int = 100) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the `top` phrases of each language (None: all).

    Phrases of 2 to `longest` words with at least `least` occurrences, unless a longer one that holds
    them has `covered` percent of theirs. It is enough to look at phrases of one word more: whatever
    lies between a phrase and a longer one occurs as often as the longer one at least. A null language
    is `und`; null and empty texts have no words; repeated rows count each time; other columns and
    doc_ids are ignored; an empty table or one without frequent phrases gives no rows.
    """
    texts = docs.select("lang", "text")
    every = staged(word_totals(texts))
    sizes = every.groupBy("lang").agg(F.sum("a").alias("n"))
    common = (F.col("a") * COMMON >= F.col("n")).alias("common")
    level = every.where(F.col("a") >= least)
    totals, phrases, longer = level, None, None
    for size in range(2, longest + 1):
        found = staged(merged(stripes(texts, size, phrase_map(level.join(sizes, "lang").select(
            "lang", "phrase", common), size - 1)), least).select(
            "lang", "prefix", F.concat_ws(" ", "prefix", "next").alias("phrase"), F.lit(size).alias("words"), "a"))
        level = found.drop("prefix", "words")
        phrases = found.drop("prefix") if phrases is None else phrases.unionByName(found.drop("prefix"))
        both = found.select("lang", F.explode(F.array("prefix", F.expr(
            "substring_index(phrase, ' ', 1 - words)"))).alias("phrase"), F.col("a").alias("longer"))
        longer = both if longer is None else longer.unionByName(both)
        totals = totals.unionByName(level)
    subsumed = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = phrases.join(subsumed, ["lang", "phrase"], "left").where(
        F.coalesce(F.col("longer") * 100 < F.col("a") * covered, F.lit(True))).drop("longer")
    found = scored(kept, totals, sizes)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = found.withColumn("rank", F.row_number().over(order))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

