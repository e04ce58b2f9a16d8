"""Spelling variants by permuterm rotations.

A word and a terminator are written in all rotations. Two words that differ by a replaced character
share the rotation that begins after it, up to that character, which is its last; a word that lacks
the character has this very rotation as a whole. So rotations are dealt and sorted by what stands
before their last character, and each group holds a whole rotation (of at most one word) and the
words with one more character there, at most one a character: a group is never larger than the
alphabet, and a scan of the sorted rows gives every word's neighbours without writing down pairs.

A pair that differs by a replacement shares one group. One that differs by a character inside a run
of equal ones shares a group for each of them; only the first counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plimsoll.llm.columns import lower_ascii
from plimsoll.sources.stage import staged

RUN = r"[A-Za-zÀ-ÿ]+"
END = "$"
#: Every how manieth run, by its hash, loses a character.
DAMAGED = 31
#: Forms grow tenfold a step and counts have 63 bits, so no chain of forms is longer than 2^5.
DOUBLINGS = 5
_NEAR = "word string, near long, best_n long, best string"


def word_counts(docs: DataFrame, shortest: int = 7, least: int = 2) -> DataFrame:
    """word, n: the runs of letters, A-Z in lower case, every 31st by hash of doc_id and run less one character.

    A null doc_id is hashed as an empty one; null texts have no runs; repeated rows count each time.
    """
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"),
                       F.explode(F.regexp_extract_all(lower_ascii(F.col("text")), F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.where(F.length("run") >= shortest)
    drawn = F.crc32(F.concat("doc", F.lit(":"), "run"))
    at = (drawn % F.length("run")).cast("int")
    word = F.when(drawn % DAMAGED == 0, F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run"))))
    counted = runs.select(F.coalesce(word, F.col("run")).alias("word")).where(F.length("word") >= shortest)
    return counted.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def rotations(words: DataFrame) -> DataFrame:
    """key, last, n: every rotation as a whole (`last` empty) and, but for those that end with the terminator,
    without its last character."""
    word, size = F.col("word"), F.length("word")
    behind = lambda i: F.concat(F.substring(word, i + 1, size), F.lit(END), F.substring(word, F.lit(1), i))
    whole = F.transform(F.sequence(F.lit(0), size), lambda i: F.struct(behind(i).alias("key"), F.lit("").alias("last")))
    short = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.struct(
        F.concat(F.substring(word, i + 2, size), F.lit(END), F.substring(word, F.lit(1), i)).alias("key"),
        F.substring(word, i + 1, F.lit(1)).alias("last")))
    return words.select(F.inline(F.concat(whole, short)), "n")


def _word(key: str, last: str) -> str:
    behind, before = key.split(END)
    return before + last + behind


def _scan(table: pa.Table) -> pa.RecordBatch:
    """The neighbours in whole groups of rows sorted by key and last character."""
    keys, lasts = table.column("key").combine_chunks(), table.column("last").combine_chunks()
    n = np.asarray(table.column("n").combine_chunks())
    begins = np.ones(len(n), bool)
    if len(n) > 1:
        begins[1:] = ~np.asarray(pc.equal(keys[1:], keys[:-1]))
    group = np.cumsum(begins) - 1
    shared = np.bincount(group)[group] > 1
    at = np.nonzero(shared)[0]
    words, near, best_n, best = [], [], [], []
    key_list, last_list, counts = keys.take(pa.array(at)).to_pylist(), lasts.take(pa.array(at)).to_pylist(), n[at].tolist()
    stops = np.append(np.nonzero(begins[at])[0][1:], len(at)).tolist() if len(at) else []
    low = 0
    for stop in stops:
        key = key_list[low]
        names = [_word(key, last) for last in last_list[low:stop]]
        first = low
        if not last_list[low]:  # the word that lacks the character
            first += 1
            longer = [i for i in range(first, stop) if last_list[i] != key[-1]]
            if longer:
                top = min(longer, key=lambda i: (-counts[i], last_list[i]))
                words.append(names[0])
                near.append(len(longer))
                best_n.append(counts[top])
                best.append(names[top - low])
                for i in longer:
                    words.append(names[i - low])
                    near.append(1)
                    best_n.append(counts[low])
                    best.append(names[0])
        if stop - first > 1:
            ranked = sorted(range(first, stop), key=lambda i: (-counts[i], last_list[i]))[:2]
            for i in range(first, stop):
                top = ranked[i == ranked[0]]
                words.append(names[i - low])
                near.append(stop - first - 1)
                best_n.append(counts[top])
                best.append(names[top - low])
        low = stop
    return pa.record_batch([pa.array(words, pa.string()), pa.array(near, pa.int64()), pa.array(best_n, pa.int64()),
                            pa.array(best, pa.string())], names=["word", "near", "best_n", "best"])


def neighbours(words: DataFrame) -> DataFrame:
    """word, n_near, best_n, best: near words of each word that has any; the best has the largest n, then the
    least spelling by code points."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            if not held.num_rows:
                continue
            keys = held.column("key").combine_chunks()
            other = np.nonzero(~np.asarray(pc.equal(keys, keys[-1])))[0]
            if len(other):  # the last group may go on in the next batch
                yield _scan(held.slice(0, int(other[-1]) + 1))
                held = held.slice(int(other[-1]) + 1)
        if held is not None and held.num_rows:
            yield _scan(held)

    found = rotations(words).repartition("key").sortWithinPartitions("key", "last").mapInArrow(work, _NEAR)
    return found.groupBy("word").agg(F.sum("near").alias("n_near"),
                                     F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("top")).select(
        "word", "n_near", (-F.col("top.less")).alias("best_n"), F.col("top.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root for each (word, form): forms followed to the last, twice as far in each round.

    A form occurs more often than its word, so there are no circles.
    """
    reached = staged(forms.select("word", F.col("form").alias("root")))
    for _ in range(DOUBLINGS):
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = staged(reached.join(further, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        reached = moved.drop("moved")
        if moved.where("moved").isEmpty():
            break
    return reached


def spelling_variants(docs: DataFrame, shortest: int = 7, least: int = 2, times: int = 10) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of `shortest` characters and `least` occurrences.

    A word's form is its near word of largest n if that is at least `times` the word's (null: none); its
    root is the last of the forms, the word itself without any. Texts may be null, empty or of any
    length; other columns are ignored; an empty table gives no rows.
    """
    words = staged(word_counts(docs, shortest, least))
    near = staged(words.join(neighbours(words), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("best_n") >= F.col("n") * times, F.col("best")).alias("form"),
        F.when(F.col("best_n") >= F.col("n") * times, F.col("best_n")).alias("form_n")))
    followed = roots(near.where("form IS NOT NULL"))
    return near.join(followed, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
