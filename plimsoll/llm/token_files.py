"""Token-id files: range asymmetric numeral system blocks in ascending doc_id order.

Writing takes three passes over narrow data: texts are tokenised once and their ids stored; the ids
are counted over all documents for one shared frequency table; the ids are dealt into ranges of
doc_id, sorted, and encoded in independent blocks. The format is a Parquet table of blocks (shard,
block, the documents' ids and lengths, lane states at checkpoints, words, checksum) beside a table of
frequencies, so Spark reads and writes it wherever it reads and writes. A block ends with a document;
only a document longer than a block makes a larger one.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plimsoll.llm.prefix_tokens import _byte_alphabet
from plimsoll.llm.pretokens import cuts, plain
from plimsoll.llm.rans import LANES, Table, decode, encode, scaled
from plimsoll.llm.textbytes import groups, text_bytes, tidied
from plimsoll.sources.stage import shared_folder, staged

END = 0
BLOCK_TOKENS = 1 << 19
#: Pieces, and pre-tokens of odd pieces, whose ids a worker remembers: about 170 and 220 bytes of each. A worker
#: keeps them for its next task, whatever that is, so callers with other work on the same executors may set fewer.
REMEMBERED = 1_400_000
PARTS = 700_000
#: Text whose token counts are stored as one.
GROUP_BYTES = 1 << 22
#: Text whose pieces are looked up together, which takes many times its size of a worker's memory.
LOOKUP_BYTES = 1 << 20
BLOCK_SCHEMA = ("shard int, block int, doc_ids binary, nulls binary, lengths binary, states binary, reads binary, "
                "words binary, crc long")
#: The character that stands for each byte in the vocabulary of a byte-level tokenizer.
SPELT = np.array([ord(c) for c, _ in sorted(_byte_alphabet().items(), key=lambda x: x[1])], "<u2")
_KEPT: dict[str, Encoder] = {}


def spelt(data: np.ndarray) -> str:
    return SPELT[data].tobytes().decode("utf-16-le")


class Encoder:
    """A byte-level tokenizer that remembers the ids of pieces of text.

    A text may be cut wherever a pre-token begins that doesn't depend on what is left of it. Such places
    are found on the bytes of many texts at once, so that nearly all pieces are single pre-tokens; they
    are numbered by a dictionary, and only new distinct ones are looked at. Those of one kind of character
    go to the tokenizer's model as they are, odd Latin pieces as rows of pre-tokens; others go to the
    tokenizer whole. The ids of all known pieces stand in one array, from which those of the texts are
    gathered.
    """

    LATIN = re.compile(r"[\t\n\r -~\u00c0-\u024f]*")
    #: The pre-tokens of byte-level tokenizers; a fixed value.
    PRE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

    def __init__(self, path: str):
        self.remembered: int | None = None
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        self.kind = "<u2" if self.size <= 1 << 16 else "<u4"
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.parts: dict[str, bytes] = {}
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.store, self.used = np.empty(1 << 20, self.kind), 0
        self.ends = np.zeros(1 << 16, np.int64)  # of each known piece in the store, after the one before

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind)

    def words(self, forms: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pre-tokens, spelt in the byte alphabet, and how many each has."""
        model = self.tokenizer.model
        rows = [[token.id for token in model.tokenize(form)] for form in forms]
        sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        return np.fromiter(chain.from_iterable(rows), self.kind, int(sizes.sum())), sizes

    def odd(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece that is not known to be one pre-token."""
        parts = self.parts
        rows = [None if not self.LATIN.fullmatch(p) or any(s in p for s in self.special) else self.PRE.findall(p)
                for p in pieces]
        new = [q for q in {q for row in rows if row for q in row} if q not in parts]
        ids, sizes = self.words([spelt(np.frombuffer(q.encode(), np.uint8)) for q in new])
        parts.update(zip(new, [x.tobytes() for x in np.split(ids, np.cumsum(sizes)[:-1])]))
        return [self.ids(p).tobytes() if row is None else b"".join([parts[q] for q in row])
                for p, row in zip(pieces, rows)]

    def remember(self, pieces: pa.Array, names: np.ndarray, new: np.ndarray) -> np.ndarray:
        """Put the ids of the new ones of the pieces behind those of the known ones; the new ones as they are numbered."""
        data, offsets = text_bytes(pieces)
        whole = plain(data, offsets)[new]
        easy, odd = new[whole], new[~whole]
        form = spelt(data)
        held = self.odd(names[odd].tolist())
        found = [self.words([form[a:b] for a, b in zip(offsets[easy].tolist(), offsets[easy + 1].tolist())]),
                 (np.frombuffer(b"".join(held), self.kind), np.array([len(h) for h in held], np.int64) // int(self.kind[-1]))]
        ids, sizes = [np.concatenate(x) for x in zip(*found)]
        order = np.concatenate([easy, odd])
        known, total = len(self.number), len(self.number) + len(new)
        if self.used + len(ids) > len(self.store):
            self.store = np.concatenate([self.store, np.empty(self.used + len(ids), self.kind)])
        if total >= len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros(total, np.int64)])
        self.store[self.used:self.used + len(ids)] = ids
        self.ends[known + 1:total + 1] = self.used + np.cumsum(sizes)
        self.used += len(ids)
        self.number.update(zip(names[order].tolist(), range(known, total)))
        return order

    def encoded(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's ids end."""
        if len(self.number) > (self.remembered or REMEMBERED):
            self._forget()
        if len(self.parts) > (self.remembered or 2 * PARTS) // 2:
            self.parts.clear()
        data, offsets = text_bytes(texts)
        if not len(data):
            return np.zeros(0, self.kind), np.zeros(len(texts), np.int64)
        begins = cuts(data, offsets, self.special)
        places = np.append(begins, len(data)).astype(np.int32)
        pieces = pa.StringArray.from_buffers(len(begins), pa.py_buffer(places), pa.py_buffer(data)).dictionary_encode()
        names = pieces.dictionary.to_numpy(zero_copy_only=False)
        number = np.fromiter(map(self.number.get, names, repeat(-1)), np.int64, len(names))
        new = np.nonzero(number < 0)[0]
        if len(new):
            known = len(self.number)
            number[self.remember(pieces.dictionary, names, new)] = np.arange(known, known + len(new))
        number = number[np.asarray(pieces.indices)]
        first = self.ends[number]
        sizes = self.ends[number + 1] - first
        ends = np.cumsum(sizes)
        ids = self.store[np.repeat(first - (ends - sizes), sizes) + np.arange(ends[-1])]
        return ids, np.append(0, ends)[np.searchsorted(begins, offsets[1:])]


def _encoder(path: str, remembered: int | None) -> Encoder:
    if path not in _KEPT:
        _KEPT[path] = Encoder(path)
    _KEPT[path].remembered = remembered
    return _KEPT[path]


def tokenised(docs: DataFrame, path: str, remembered: int | None = None) -> DataFrame:
    """doc_id, n_tokens and ids (bytes of the narrowest kind that holds them), END appended. Null is empty.

    The first row of each group of texts also carries the group's token counts: tokens, then counts.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, remembered)
        width = int(encoder.kind[-1])
        for batch in batches:
            for group in groups(batch, most=GROUP_BYTES):
                found = [encoder.encoded(part.column("text")) for part in groups(group, most=LOOKUP_BYTES)]
                ids = np.concatenate([part for part, _ in found])
                ends = np.cumsum(np.concatenate([np.diff(stops, prepend=0) for _, stops in found]) + 1)
                held = np.empty(len(ids) + len(ends), encoder.kind)
                last = np.zeros(len(held), bool)
                last[ends - 1] = True
                held[last], held[~last] = END, ids
                offsets = np.append(0, ends * width).astype(np.int32)
                rows = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(held)])
                total = np.bincount(held)
                seen = np.nonzero(total)[0]
                counts = [np.concatenate([seen, total[seen]]).astype("<u4").tobytes()] + [None] * (len(ends) - 1)
                yield pa.record_batch([group.column("doc_id"), pa.array(np.diff(ends, prepend=0)), rows,
                                       pa.array(counts, pa.binary())], names=["doc_id", "n_tokens", "ids", "counts"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        tidied(work), "doc_id long, n_tokens long, ids binary, counts binary")


def token_counts(tokens: DataFrame, size: int) -> np.ndarray:
    """Occurrences of each token over all documents, from the groups' counts; a row per token and task is shuffled."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for held in batch.column("counts").drop_null():
                seen, n = np.frombuffer(held.as_buffer(), "<u4").reshape(2, -1)
                total[seen] += n
        seen = np.nonzero(total)[0]
        yield pa.record_batch([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["token", "n"])

    rows = tokens.select("counts").mapInArrow(count, "token int, n long").groupBy("token").agg(F.sum("n").alias("n"))
    out = np.zeros(size, np.int64)
    for r in rows.collect():  # a row per token of the vocabulary
        out[r["token"]] = r["n"]
    return out


def write_tokens(docs: DataFrame, path: str, target: str, remembered: int | None = None) -> None:
    """Tokenise `docs` with the tokenizer file `path` and write the token files below `target`.

    Ascending doc_id, null first; rows that repeat a doc_id follow each other in the order of their
    ids. Other columns are ignored.
    """
    spark = docs.sparkSession
    encoder = _encoder(path, remembered)
    kind, size = encoder.kind, encoder.size
    tokens = staged(tokenised(docs, path, remembered))
    frequency = scaled(token_counts(tokens, size))
    spark.createDataFrame([(i, int(n)) for i, n in enumerate(frequency)], "token int, frequency long").coalesce(
        1).write.parquet(f"{target}/frequencies")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, shard, number = Table(frequency), TaskContext.get().partitionId(), 0
        held: list[np.ndarray] = []
        owners: list[int | None] = []
        waiting = 0

        def flush() -> pa.RecordBatch:
            nonlocal number, waiting
            ids = np.concatenate(held).astype(np.int64)
            words, states, reads = encode(ids, table)
            row = {"shard": shard, "block": number,
                   "doc_ids": np.array([o or 0 for o in owners], "<i8").tobytes(),
                   "nulls": np.array([o is None for o in owners], np.uint8).tobytes(),
                   "lengths": np.array([len(h) for h in held], "<u4").tobytes(), "states": states.tobytes(),
                   "reads": reads.tobytes(), "words": words.tobytes(),
                   "crc": zlib.crc32(ids.astype("<u4").tobytes())}
            number, waiting = number + 1, 0
            held.clear(), owners.clear()
            return pa.record_batch(
                [pa.array([v], t) for v, t in zip(row.values(), [pa.int32()] * 2 + [pa.binary()] * 6 + [pa.int64()])],
                names=list(row))

        for batch in batches:
            for owner, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids")):
                held.append(np.frombuffer(ids.as_buffer(), kind))
                owners.append(owner)
                waiting += len(held[-1])
                if waiting >= BLOCK_TOKENS:
                    yield flush()
        if held:
            yield flush()

    ranged = tokens.select("doc_id", "ids").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "ids")
    ranged.mapInArrow(tidied(blocks), BLOCK_SCHEMA).write.parquet(f"{target}/blocks")


def read_tokens(spark: SparkSession, source: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and ids (little-endian unsigned 32-bit) of files that `write_tokens` wrote.

    Without `with_ids` the ids are decoded and checked but not returned.

    Blocks are decoded apart from each other; one that does not match its checksum raises.
    """
    rows = spark.read.parquet(f"{source}/frequencies").orderBy("token").collect()  # the vocabulary
    frequency = np.array([r["frequency"] for r in rows], np.uint64)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(frequency)
        for batch in batches:
            for row in chain.from_iterable(batch.slice(at, 1).to_pylist() for at in range(batch.num_rows)):
                lengths = np.frombuffer(row["lengths"], "<u4").astype(np.int64)
                states = np.frombuffer(row["states"], np.uint64).reshape(-1, LANES)
                ids = decode(np.frombuffer(row["words"], np.uint32), states, np.frombuffer(row["reads"], np.int64),
                             int(lengths.sum()), table).astype("<u4")
                if zlib.crc32(ids.tobytes()) != row["crc"]:
                    raise ValueError(f"block {row['block']} of shard {row['shard']} is damaged")
                ends = np.cumsum(lengths)
                parts = [ids[e - n:e].tobytes() for e, n in zip(ends, lengths)]
                null = np.frombuffer(row["nulls"], np.uint8).astype(bool)
                n = len(parts)
                yield pa.record_batch(
                    [pa.array(np.full(n, row["shard"], np.int32)), pa.array(np.full(n, row["block"], np.int32)),
                     pa.array(ends - lengths), pa.array(np.frombuffer(row["doc_ids"], "<i8"), mask=null),
                     pa.array(lengths), pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                     pa.array(parts if with_ids else [None] * n, pa.binary())],
                    names=["shard", "block", "inside", "doc_id", "n_tokens", "ids_crc32", "ids"])

    stored = spark.read.parquet(f"{source}/blocks")
    decoded = stored.mapInArrow(tidied(documents), "shard int, block int, inside long, doc_id long, n_tokens long, "
                                           "ids_crc32 long, ids binary")

    def length_sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [int(np.frombuffer(x.as_buffer(), "<u4").sum(dtype=np.int64)) for x in batch.column("lengths")]
            yield pa.record_batch([batch.column("shard"), batch.column("block"), pa.array(sums, pa.int64())],
                                  names=["shard", "block", "n"])

    sizes = stored.select("shard", "block", "lengths").mapInArrow(length_sum, "shard int, block int, n long")
    totals = sizes.groupBy("shard").agg(F.sum("n").alias("n"))
    upto = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    shards = totals.select("shard", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before"))
    along = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select("shard", "block", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("at")).join(
        shards, "shard").select("shard", "block", (F.col("at") + F.col("before")).alias("begin"))
    found = decoded.join(begins, ["shard", "block"]).select(
        "doc_id", (F.col("begin") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", "ids")
    return found if with_ids else found.drop("ids")


def token_files(docs: DataFrame, path: str, with_ids: bool = True, remembered: int | None = None) -> DataFrame:
    """Write `docs` as token files in the shared folder and read them back (see `read_tokens`).

    `remembered` is how many pieces a worker remembers, and twice the pre-tokens; it changes no result.
    """
    target = f"{shared_folder(docs.sparkSession).rstrip('/')}/plimsoll/tokens-{uuid.uuid4().hex}"
    write_tokens(docs, path, target, remembered)
    return read_tokens(docs.sparkSession, target, with_ids)
