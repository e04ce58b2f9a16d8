"""Words and grams counted inside the scan: a text's terms become numbers, and rows only once they are counted.

Texts come lower-cased. A few megabytes of them are taken together: accents are folded a kind of
character at a time (:func:`plimsoll.functions.runs.words_only`), words are numbered by a dictionary,
stop words fall out by number, grams are numbered from the numbers of their words, and all counting is
of integers. Only the distinct terms of such a piece are written out as text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import runs as R
from ..functions import text as T


def _words(text: Column, fold: bool) -> Column:
    return T.without_unassigned(text, fold).alias("words")


def _numbered(texts: pa.Array, stop_words: Sequence[str], longest: int,
              fold: bool) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Text number and term number of every term, and the distinct terms; a gram may span a stop word."""
    data, offsets = R.words_only(pc.fill_null(texts, ""), fold)
    begin, end, owner = R.word_spans(data, offsets)
    words = R.strings(data, begin, end).dictionary_encode()
    code, known = np.asarray(words.indices).astype(np.int64), words.dictionary
    if stop_words:
        stays = ~np.asarray(pc.is_in(known, value_set=pa.array(sorted(set(stop_words)), pa.string())))[code]
        owner, code = owner[stays], code[stays]
    owners, numbers, terms, base = [owner], [code], [known], len(known)
    gram = code
    for n in range(2, longest + 1):
        count = max(len(code) - n + 1, 0)
        pairs = gram[:count] * max(len(known), 1) + code[len(code) - count:]
        _, sample, gram = np.unique(pairs, return_index=True, return_inverse=True)
        inside = owner[:count] == owner[len(owner) - count:]
        owners.append(owner[:count][inside])
        numbers.append(base + gram[inside])
        terms.append(pc.binary_join_element_wise(*[known.take(pa.array(code[sample + i])) for i in range(n)], " "))
        base += len(sample)
    return np.concatenate(owners), np.concatenate(numbers), pa.concat_arrays(terms)


def _counted(owner: np.ndarray, number: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, term and count of each distinct pair."""
    pairs, counts = np.unique(owner * max(size, 1) + number, return_counts=True)
    return pairs // max(size, 1), pairs % max(size, 1), counts


def statistics(df: DataFrame, text: Column, stop_words: Sequence[str] = (), longest: int = 1,
               fold: bool = False) -> DataFrame:
    """(token, n uses, df documents) of the words and grams of lower-cased texts, folded here if asked.

    Both numbers are added up in the scan, so one row a term and piece of text is shuffled; a token
    that occurs in every text is no hot key.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in R.pieces(batch):
                owner, number, terms = _numbered(some.column("words"), stop_words, longest, fold)
                _, once, counts = _counted(owner, number, len(terms))
                uses = np.bincount(once, counts, len(terms)).astype(np.int64)
                documents = np.bincount(once, minlength=len(terms))
                seen = np.nonzero(uses)[0]
                yield pa.record_batch([terms.take(pa.array(seen)), pa.array(uses[seen]), pa.array(documents[seen])],
                                      names=["token", "n", "df"])

    parts = df.select(_words(text, fold)).mapInArrow(work, "token string, n long, df long")
    return parts.groupBy("token").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def frequencies(df: DataFrame, text: Column, key: str = "id", stop_words: Sequence[str] = (), longest: int = 1,
                fold: bool = False) -> DataFrame:
    """(key, token, tf): each text's own counts, found where the text is read; no shuffle."""
    kind = dict(df.dtypes)[key]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in R.pieces(batch):
                owner, number, terms = _numbered(some.column("words"), stop_words, longest, fold)
                owner, number, counts = _counted(owner, number, len(terms))
                yield pa.record_batch([some.column(key).take(pa.array(owner)), terms.take(pa.array(number)),
                                       pa.array(counts)], names=[key, "token", "tf"])

    return df.select(key, _words(text, fold)).mapInArrow(work, f"`{key}` {kind}, token string, tf long")


def weights(df: DataFrame, text: Column, idf: DataFrame, key: str = "id", stop_words: Sequence[str] = (),
            longest: int = 1, fold: bool = False) -> DataFrame:
    """(key, token, weight): (1 + ln tf) * idf of the vocabulary's tokens, at unit length per text.

    ``idf`` is a vocabulary with its idf; it has a declared largest size and is sent to the tasks, so
    counting, weighing and scaling happen where the text is read and nothing is shuffled.
    """
    kind = dict(df.dtypes)[key]
    rows = idf.select("token", "idf").toArrow().sort_by("token")
    shared = df.sparkSession.sparkContext.broadcast((rows.column("token").combine_chunks(),
                                                     rows.column("idf").to_numpy()))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, factor = shared.value
        for batch in batches:
            for some in R.pieces(batch):
                owner, number, terms = _numbered(some.column("words"), stop_words, longest, fold)
                place = pc.fill_null(pc.index_in(terms, value_set=tokens), -1).to_numpy(zero_copy_only=False)
                listed = place[number] >= 0
                owner, number, counts = _counted(owner[listed], number[listed], len(terms))
                raw = (1.0 + np.log(counts)) * factor[place[number]]
                norm = np.sqrt(np.bincount(owner, raw * raw, some.num_rows))
                yield pa.record_batch([some.column(key).take(pa.array(owner)), terms.take(pa.array(number)),
                                       pa.array(raw / norm[owner])], names=[key, "token", "weight"])

    return df.select(key, _words(text, fold)).mapInArrow(work, f"`{key}` {kind}, token string, weight double")


def vectors(text: Column, idf: DataFrame, stop_words: Sequence[str] = (), longest: int = 1, fold: bool = False) -> Column:
    """The weights of :func:`weights` as one sparse vector a text; ``idf`` has the columns place, token and idf.

    Worked out in the same pieces, whatever the size of a batch, so a worker holds no more than one of them.
    """
    rows = idf.select("place", "token", "idf").toArrow().sort_by("place")
    size = rows.num_rows
    shared = idf.sparkSession.sparkContext.broadcast((rows.column("token").combine_chunks(), rows.column("idf").to_numpy()))

    def of_piece(texts: pa.Array) -> pa.Array:
        tokens, factor = shared.value
        owner, number, terms = _numbered(texts, stop_words, longest, fold)
        place = pc.fill_null(pc.index_in(terms, value_set=tokens), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        listed = place[number] >= 0
        owner, place, counts = _counted(owner[listed], place[number[listed]], size)
        raw = (1.0 + np.log(counts)) * factor[place]
        values = raw / np.sqrt(np.bincount(owner, raw * raw, len(texts)))[owner]
        ends = pa.array(np.searchsorted(owner, np.arange(len(texts) + 1)), pa.int32())
        return pa.StructArray.from_arrays([
            pa.array(np.zeros(len(texts)), pa.int8()), pa.array(np.full(len(texts), size), pa.int32()),
            pa.ListArray.from_arrays(ends, pa.array(place, pa.int32())), pa.ListArray.from_arrays(ends, pa.array(values))],
            names=["type", "size", "indices", "values"])

    @F.arrow_udf(VectorUDT())
    def work(texts: pa.Array) -> pa.Array:
        batch = pa.record_batch([texts], names=["words"])
        found = [of_piece(some.column("words")) for some in R.pieces(batch)]
        return pa.concat_arrays(found) if found else of_piece(texts)

    return work(_words(text, fold))
