"""Removal of repeated word runs by compacting a De Bruijn graph of the corpus.

Edges of the graph are runs of `span` words. Four steps find those that repeat, and where first:

1. Anchors: of each edge, the part of `span // 2` words with the least hash. Equal edges have equal
   anchors, so only edges whose anchor stands at two places or more can repeat. A whole document is an
   edge of its own kind here: later copies of a document are one path and are settled at once.
2. Repeated edges: of what is left, equal edges are brought together by a window over their hashes;
   the least source coordinate (doc_id, start) is where the edge comes first.
3. Paths: a document's later edges that follow each other, with sources that follow each other, are
   compacted into one nonbranching path.
4. Paths are joined with their documents again, and the words that they cover are removed.

Documents are dealt to blocks of about BLOCK_DOCS by a hash of doc_id. A block folds equal anchors
and edges before anything is shuffled, so a passage that a third of all documents share sends a row a
block. Hashes of edges are 96 bits wide, from two independent halves; that width is the verification
that two places hold the same words, and each path carries the coordinates of both.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plimsoll.llm.textbytes import groups, mixed, text_bytes, window_hashes, word_hashes, words

SPAN = 20
BLOCK_DOCS = 500
NO_ID = np.iinfo(np.int64).min
OTHER = np.uint64(0xA0761D6478BD642F)


class Block:
    """The words of a block's documents, in order of doc_id, and their edges and anchors."""

    def __init__(self, table: pa.Table, span: int):
        table = table.select(["doc_id", "text"]).sort_by("doc_id").combine_chunks()
        self.ids = table.column("doc_id").fill_null(NO_ID).to_numpy().astype(np.int64)
        self.null = table.column("doc_id").is_null().to_numpy()
        self.texts: list[str] = table.column("text").fill_null("").to_pylist()
        hashes, docs, seen = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
        for batch in table.to_batches():
            for group in groups(batch):
                data, offsets = text_bytes(group.column("text"))
                starts, ends, doc = words(data, offsets)
                hashes.append(word_hashes(data, starts, ends))
                docs.append(doc + seen)
                seen += group.num_rows
        self.span = span
        self.word, self.doc = np.concatenate(hashes), np.concatenate(docs)
        self.first_word = np.searchsorted(self.doc, np.arange(len(self.ids) + 1))
        self.n_words = np.diff(self.first_word)
        edges = max(len(self.word) - span + 1, 0)
        self.at = np.nonzero(self.doc[:edges] == self.doc[span - 1:span - 1 + edges])[0]
        self.edge_doc = self.doc[self.at]
        self.start = self.at - self.first_word[self.edge_doc]

    def edge_hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """64 and 32 bits of each edge, from independent hashes of its words."""
        low = window_hashes(self.word, self.span)[self.at]
        high = window_hashes(mixed(self.word ^ OTHER), self.span)[self.at]
        return low, (high >> np.uint64(33)).astype(np.int32)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """The anchor hash of each edge, and where its anchor stands."""
        part = self.span // 2
        grams = window_hashes(self.word, part)
        least, place = grams[self.at], self.at.copy()
        for step in range(1, self.span - part + 1):
            other = grams[self.at + step]
            lower = other < least
            least, place = np.where(lower, other, least), np.where(lower, self.at + step, place)
        return least, place

    def whole(self) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of each document's word sequence, of use where it has edges."""
        sums = []
        for salt in (np.uint64(0), OTHER):
            place = np.arange(len(self.word)) - self.first_word[self.doc]
            each = mixed(mixed(self.word ^ salt) + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            run = np.concatenate([[np.uint64(0)], np.cumsum(each, dtype=np.uint64)])
            total = run[self.first_word[1:]] - run[self.first_word[:-1]]
            sums.append(mixed(total + self.n_words.astype(np.uint64)))
        return sums[0], (sums[1] >> np.uint64(33)).astype(np.int32)

    def copies(self) -> np.ndarray:
        """Documents that repeat a document of this block with a smaller doc_id."""
        low, high = self.whole()
        order = np.lexsort((self.ids, high, low))
        same = (low[order][1:] == low[order][:-1]) & (high[order][1:] == high[order][:-1])
        head = np.maximum.accumulate(np.where(np.concatenate([[True], ~same]), np.arange(len(order)), 0))
        later = np.zeros(len(self.ids), bool)
        later[order] = self.ids[order] > self.ids[order][head] if len(order) else False
        return later & (self.n_words >= self.span)

    def later(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Edges that stand earlier in this block too."""
        order = np.lexsort((self.start, self.ids[self.edge_doc], high, low))
        if not len(order):
            return np.zeros(0, bool)
        same = (low[order][1:] == low[order][:-1]) & (high[order][1:] == high[order][:-1])
        head = np.maximum.accumulate(np.where(np.concatenate([[True], ~same]), np.arange(len(order)), 0))
        first = order[head]
        out = np.zeros(len(order), bool)
        out[order] = (self.ids[self.edge_doc[order]] != self.ids[self.edge_doc[first]]) | (
            self.start[order] != self.start[first])
        return out


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _blocks(docs: DataFrame, block_docs: int) -> DataFrame:
    n = docs.count() // block_docs + 1
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.pmod(F.xxhash64("doc_id"), F.lit(n)).cast("int").alias("block"))


def _messages(texts: DataFrame, span: int) -> DataFrame:
    """block, doc_id, hash: anchors that repeat (no doc_id), and documents that copy an earlier one (no hash)."""
    def send(key: tuple, table: pa.Table) -> pa.Table:
        block = Block(table, span)
        number = key[0].as_py()
        anchors, places = block.anchors()
        held = np.unique(anchors)
        # edges that share one place of an anchor do not make it repeat
        first = np.unique(places, return_index=True)[1]
        many = np.unique(anchors[first], return_counts=True)[1] > 1
        low, high = block.whole()
        own = (block.n_words >= span) & ~block.copies()
        n = len(held) + int(own.sum())
        return pa.table({
            "hash": pa.concat_arrays([_signed(held), _signed(low[own])]),
            "high": pa.array(np.concatenate([np.zeros(len(held), np.int32), high[own]])),
            "block": pa.array(np.full(n, number, np.int32)),
            "many": pa.array(np.concatenate([many, np.zeros(int(own.sum()), bool)])),
            "doc_id": pa.array(np.concatenate([np.zeros(len(held), np.int64), block.ids[own]]),
                               mask=np.concatenate([np.ones(len(held), bool), np.zeros(int(own.sum()), bool)]))})

    rows = texts.groupBy("block").applyInArrow(send, "hash long, high int, block int, many boolean, doc_id long")
    same = Window.partitionBy("hash", "high")
    seen = rows.withColumns({"times": F.sum(F.lit(1) + F.col("many").cast("int")).over(same),
                             "first": F.min("doc_id").over(same)})
    anchor = F.col("doc_id").isNull() & (F.col("times") > 1)
    return seen.where(anchor | (F.col("first") < F.col("doc_id"))).select(
        "block", "doc_id", F.when(F.col("doc_id").isNull(), F.col("hash")).alias("hash"))


def _copied(block: Block, ids: np.ndarray) -> np.ndarray:
    """Documents whose words an earlier document repeats as a whole, here or by message."""
    return block.copies() | (np.isin(block.ids, ids) & (block.n_words >= block.span))


def repeated_edges(texts: DataFrame, messages: DataFrame, span: int) -> DataFrame:
    """block, doc_id, start, from_doc, from_start: a block's first occurrence of an edge that an earlier one repeats."""
    def send(key: tuple, table: pa.Table, news: pa.Table) -> pa.Table:
        names = ["low", "high", "block", "doc_id", "start"]
        if not table.num_rows:
            return pa.table([_signed(np.zeros(0, np.uint64)), *[pa.array([], t) for t in (
                pa.int32(), pa.int32(), pa.int64(), pa.int32())]], names=names)
        block = Block(table, span)
        known = news.column("hash").drop_null().to_numpy().astype(np.int64).view(np.uint64)
        copied = _copied(block, news.column("doc_id").drop_null().to_numpy())
        low, high = block.edge_hashes()
        mine = np.isin(block.anchors()[0], known) & ~copied[block.edge_doc] & ~block.later(low, high)
        ids = block.ids[block.edge_doc[mine]]
        return pa.table([_signed(low[mine]), pa.array(high[mine]),
                         pa.array(np.full(len(ids), key[0].as_py(), np.int32)), pa.array(ids),
                         pa.array(block.start[mine].astype(np.int32))], names=names)

    edges = texts.groupBy("block").cogroup(messages.groupBy("block")).applyInArrow(
        send, "low long, high int, block int, doc_id long, start int")
    first = F.min(F.struct("doc_id", "start")).over(Window.partitionBy("low", "high"))
    own = F.struct("doc_id", "start")
    return edges.withColumn("first", first).where(F.col("first") < own).select(
        "block", "doc_id", "start", F.col("first.doc_id").alias("from_doc"), F.col("first.start").alias("from_start"))


def compacted(edges: DataFrame) -> DataFrame:
    """block, doc_id, start, n_edges, from_doc, from_start: nonbranching paths of `repeated_edges`.

    An edge continues the path of the edge before it if its source follows that one's source.
    """
    along = Window.partitionBy("block", "doc_id").orderBy("start")
    follows = ((F.col("start") == F.lag("start").over(along) + 1)
               & (F.col("from_doc") == F.lag("from_doc").over(along))
               & (F.col("from_start") == F.lag("from_start").over(along) + 1))
    begun = edges.repartition("block").withColumn("begins", F.when(follows, 0).otherwise(1))
    path = F.sum("begins").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return begun.withColumn("path", path).groupBy("block", "doc_id", "path").agg(
        F.min("start").alias("start"), F.count(F.lit(1)).cast("int").alias("n_edges"),
        F.min("from_doc").alias("from_doc"), F.min("from_start").alias("from_start")).drop("path")


def substring_dedup(docs: DataFrame, span: int = SPAN, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """What is left of each document without its repeated runs of `span` words, one row per document.

    Columns: doc_id, n_words, n_removed, kept_sha256, n_paths (runs of edges that stand
    earlier too), kept (the words left, joined by one space). A word is removed if a run of `span`
    words over it also starts earlier: in a document of smaller doc_id, or earlier in the same one.
    Null and empty texts have no words. Of rows that repeat a doc_id, starts decide, so equal rows
    keep the same words; null doc_ids come first. Other columns are ignored.
    """
    texts = _blocks(docs, block_docs)
    messages = _messages(texts, span)
    paths = compacted(repeated_edges(texts, messages, span)).select("block", "doc_id", "start", "n_edges")
    whole = messages.where("doc_id is not null").select(
        "block", "doc_id", F.lit(-1).alias("start"), F.lit(1).alias("n_edges"))

    def finish(key: tuple, table: pa.Table, news: pa.Table) -> pa.Table:
        block = Block(table, span)
        times = news.column("n_edges").to_numpy().astype(np.int64)
        news_doc = np.repeat(news.column("doc_id").to_numpy().astype(np.int64), times)
        news_start = np.repeat(news.column("start").to_numpy().astype(np.int64), times)
        news_start += np.arange(len(times.repeat(times))) - np.repeat(np.cumsum(times) - times, times)
        copied = _copied(block, news_doc[news_start < 0])
        low, high = block.edge_hashes()
        gone = block.later(low, high) | copied[block.edge_doc]
        # places by doc_id and start, of the documents here and of the news
        told = news_start >= 0
        key_news = np.unique(np.stack([news_doc[told], news_start[told]], axis=1), axis=0) if told.any() else None
        if key_news is not None:
            known, number = np.unique(key_news[:, 0], return_inverse=True)
            width = int(max(block.start.max(initial=0), key_news[:, 1].max())) + 1
            at = np.searchsorted(known, block.ids[block.edge_doc]).clip(0, len(known) - 1)
            mine = np.where(known[at] == block.ids[block.edge_doc], at * width + block.start, -1)
            gone |= np.isin(mine, number * width + key_news[:, 1])
        cover = np.zeros(len(block.word) + 1, np.int64)
        np.add.at(cover, block.at[gone], 1)
        np.add.at(cover, block.at[gone] + span, -1)
        removed = np.cumsum(cover)[:-1] > 0
        runs = gone.copy()
        runs[1:] &= ~(gone[:-1] & (block.at[1:] == block.at[:-1] + 1))
        paths = np.bincount(block.edge_doc[runs], minlength=len(block.ids))
        counts = np.bincount(block.doc[removed], minlength=len(block.ids))
        kept = []
        for i, text in enumerate(block.texts):
            held = text.encode().split()
            if counts[i]:
                held = compress(held, ~removed[block.first_word[i]:block.first_word[i + 1]])
            kept.append(b" ".join(held))
        return pa.table({
            "doc_id": pa.array(block.ids, mask=block.null), "n_words": pa.array(block.n_words.astype(np.int64)),
            "n_removed": pa.array(counts.astype(np.int64)),
            "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
            "n_paths": pa.array(paths.astype(np.int64)), "kept": pa.array([k.decode() for k in kept], pa.string())})

    return texts.groupBy("block").cogroup(paths.unionByName(whole).groupBy("block")).applyInArrow(
        finish, "doc_id long, n_words long, n_removed long, kept_sha256 string, n_paths long, kept string")
