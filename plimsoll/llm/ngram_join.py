"""Self-join of documents by the Jaccard similarity of their word n-grams, with an LSH forest.

Documents with the same set of word n-grams are one class from the start, so copies cost one row.
Each class has a MinHash signature, laid out as the labels of several prefix tries. Two classes are
compared if they share a prefix in any trie; starting from the longest, prefixes are shortened until
a pair at the similarity limit would be met with the target recall.

Classes that meet are gathered into families (components of the stars from each prefix's least
class), a family is dealt into blocks, and each pair of blocks with a prefix in common is one task's
work: it compares the exact sets, counts links and keeps a spanning forest of them. So pairs are never
rows, a family of any size is split over tasks, and no link between different sets is lost beyond the
recall of the forest. A second component pass over the spanning edges gives the groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plimsoll.llm.columns import row_hash, without
from plimsoll.llm.components import components
from plimsoll.llm.textbytes import groups, mixed, text_bytes, window_hashes, word_hashes, words
from plimsoll.sources.stage import staged

WORDS = 5
#: The similarity limit as a fraction, so that the test is one of whole numbers.
LIMIT = (4, 5)
TREES = 24
LONGEST = 8
RECALL = 0.99999
#: Classes to a block, on average.
BLOCK = 256


def prefix_length(similarity: float, trees: int = TREES, longest: int = LONGEST, recall: float = RECALL) -> int:
    """The longest prefix at which a pair of that similarity is met with the recall wanted."""
    length = longest
    while length > 1 and 1 - (1 - similarity ** length) ** trees < recall:
        length -= 1
    return length


def shingle_sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of each text, sorted, and the places where each text's begin.

    A text of fewer than n words has one n-gram, all of its words; one without words has none.
    """
    data, offsets = text_bytes(texts)
    starts, ends, doc = words(data, offsets)
    each = word_hashes(data, starts, ends)
    count = np.bincount(doc, minlength=len(texts))
    edge = max(len(each) - n + 1, 0)
    full = doc[:edge] == doc[n - 1:n - 1 + edge]
    hashes, owner = [window_hashes(each, n)[full]], [doc[:edge][full]]
    first = np.cumsum(count) - count
    for size in range(1, n):
        short = np.nonzero(count == size)[0]
        if len(short):
            hashes.append(window_hashes(each, size)[first[short]])
            owner.append(short)
    hashes, owner = np.concatenate(hashes), np.concatenate(owner)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[new], owner[new]
    return hashes, np.searchsorted(owner, np.arange(len(texts) + 1))


def class_keys(hashes: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """A 64-bit key of each set; equal sets have equal keys."""
    run = np.concatenate([[np.uint64(0)], np.cumsum(mixed(hashes ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)])
    return mixed(run[begin[1:]] - run[begin[:-1]] + np.diff(begin).astype(np.uint64)).view(np.int64)


def prefix_keys(hashes: np.ndarray, begin: np.ndarray, trees: int, length: int) -> np.ndarray:
    """A key for the prefix of each trie, a row per set that is not empty."""
    rng = np.random.default_rng(5)
    factor = rng.integers(0, 1 << 31, trees * length, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    shift = rng.integers(0, 1 << 32, trees * length, dtype=np.uint32)
    starts = begin[:-1][np.diff(begin) > 0]
    top = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(starts), trees), np.uint64)
    for tree in range(trees):
        label = np.full(len(starts), np.uint64(tree + 1))
        for i in range(tree * length, (tree + 1) * length):
            least = np.minimum.reduceat(top * factor[i] + shift[i], starts) if len(starts) else top[:0]
            label = mixed(label * np.uint64(0x9E3779B97F4A7C15) + least)
        out[:, tree] = label
    return out.view(np.int64)


def signatures(docs: DataFrame, n: int, trees: int, length: int) -> DataFrame:
    """doc_id, row (row_hash of the text), cls (key of the n-gram set), grams (its size) and the prefix keys; one pass over the texts."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in groups(batch):
                hashes, begin = shingle_sets(group.column("text"), n)
                size = np.diff(begin)
                keys = prefix_keys(hashes, begin, trees, length)
                ends = np.concatenate([[0], np.cumsum((size > 0) * trees)]).astype(np.int32)
                yield pa.record_batch(
                    [group.column("doc_id"), group.column("row"), pa.array(class_keys(hashes, begin)),
                     pa.array(size.astype(np.int32)),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel()))],
                    names=["doc_id", "row", "cls", "grams", "keys"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_hash(F.col("text")).alias("row"),
                       "text").mapInArrow(work, "doc_id long, row long, cls long, grams int, keys array<long>")


def exact_sets(docs: DataFrame, n: int) -> DataFrame:
    """cls, grams: the sorted n-gram hashes of each document's text, as bytes."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in groups(batch):
                hashes, begin = shingle_sets(group.column("text"), n)
                yield pa.record_batch(
                    [pa.array(class_keys(hashes, begin)),
                     pa.array([hashes[a:b].tobytes() for a, b in zip(begin[:-1], begin[1:])], pa.binary())],
                    names=["cls", "grams"])

    return docs.select("text").mapInArrow(work, "cls long, grams binary")


def linked(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, limit: tuple[int, int]) -> np.ndarray:
    """A matrix of which sets numbered `left` reach the limit with which numbered `right`."""
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    _, gram, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # n-grams of one set alone are in no intersection
    place = np.cumsum(times > 1) - 1
    shared = times[gram] > 1
    width = int((times > 1).sum())
    bits = np.zeros((len(sets), -(-width // 64) * 8), np.uint8)
    column = place[gram[shared]]
    np.bitwise_or.at(bits, (owner[shared], column >> 3), (1 << (column & 7)).astype(np.uint8))
    packed = bits.view(np.uint64)
    both = np.zeros((len(left), len(right)), np.int64)
    if width:
        for i, row in enumerate(left):
            both[i] = np.bitwise_count(packed[right] & packed[row]).sum(axis=1)
    union = size[left][:, None] + size[right][None, :] - both
    return both * limit[1] >= union * limit[0]


def _work_off(limit: tuple[int, int]):
    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by("cls").combine_chunks()
        cls, part = table.column("cls").to_numpy(), table.column("part").to_numpy()
        sets = [np.frombuffer(g.as_buffer(), np.uint64) for g in table.column("grams")]
        inner = bool((part == 0).all()) and table.column("low")[0].as_py() == table.column("high")[0].as_py()
        left = np.nonzero(part == 0)[0]
        right = left if inner else np.nonzero(part == 1)[0]
        reach = np.zeros((len(cls), len(cls)), bool)
        if len(left) and len(right):
            reach[np.ix_(left, right)] = linked(sets, left, right, limit)
        reach |= reach.T
        np.fill_diagonal(reach, False)
        root = np.arange(len(cls))
        while True:  # rows are sorted, so the least row is the least class
            least = np.where(reach, root[None, :], len(cls)).min(axis=1, initial=len(cls))
            moved = np.minimum(root, least)
            moved = moved[moved]
            if (moved == root).all():
                break
            root = moved
        return pa.table({"cls": pa.array(cls), "links": pa.array(reach.sum(axis=1).astype(np.int64)),
                         "root": pa.array(cls[root])})

    return compare


def near_groups(docs: DataFrame, n: int = WORDS, limit: tuple[int, int] = LIMIT, trees: int = TREES,
                recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, class_id, n_links, class_size, kept.

    class_id is the least doc_id of the documents that chains of links (similarity at the limit or
    above) connect with this one; n_links counts the different n-gram sets that its set is linked
    with; equal sets are one class whatever else the texts differ in. Texts without words (null,
    empty, white space) are one class without links. Rows that repeat a doc_id and text count in
    class_size, and all rows with the least doc_id are kept. A null doc_id is linked like any other
    and never the least, unless its group has no other: then class_id is null and all rows are kept
    (distinct_documents keeps one). Other columns are ignored.
    """
    return grouped_rows(docs, n, limit, trees, recall, block).select(
        "doc_id", "class_id", "n_links", "class_size", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


def grouped_rows(docs: DataFrame, n: int = WORDS, limit: tuple[int, int] = LIMIT, trees: int = TREES,
                 recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """near_groups' rows with the row_hash of each text as `row`, and `stays` in place of `kept`.

    `stays` marks the one doc_id and text that stands for its group: of the least doc_id (nulls
    last), the text of least hash.
    """
    length = prefix_length(limit[0] / limit[1], trees, recall=recall)
    found = staged(signatures(docs, n, trees, length))
    classes = staged(found.groupBy("cls").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("lead"), F.count(F.lit(1)).alias("copies"), F.first("keys").alias("keys")))
    prefixes = classes.select("cls", F.explode("keys").alias("prefix"))
    shared = prefixes.groupBy("prefix").agg(F.count(F.lit(1)).alias("n"), F.min("cls").alias("least")).where("n > 1")
    members = staged(prefixes.join(shared.select("prefix", "least"), "prefix"))
    families = components(members.where("cls <> least").select(F.col("cls").alias("a"), F.col("least").alias("b")))
    sizes = families.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    dealt = staged(families.join(sizes, "root").select(
        F.col("v").alias("cls"), F.col("root").alias("family"),
        F.pmod(F.xxhash64("v"), F.ceil(F.col("n") / block)).cast("int").alias("block")))
    met = members.select("prefix", "cls").join(dealt, "cls").select("prefix", "family", "block").distinct()
    units = met.select("prefix", "family", F.col("block").alias("low")).join(
        met.select("prefix", F.col("block").alias("high")), "prefix").where("low <= high").select(
        "family", "low", "high").distinct()
    units = staged(units)
    sides = units.select("family", "low", "high", F.lit(0).alias("part"), F.col("low").alias("block")).union(
        units.where("low < high").select("family", "low", "high", F.lit(1), "high"))
    asked = dealt.join(sides, ["family", "block"]).select("cls", "family", "low", "high", "part")
    # one text per class; null ids meet too, and the hash keeps them from meeting in one task
    needed = classes.join(dealt.select("cls"), "cls", "left_semi").select(
        F.col("lead.doc_id").alias("of"), F.col("lead.row").alias("of_row"))
    texts = docs.select("doc_id", row_hash(F.col("text")).alias("row"), "text").join(
        needed, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("row") == F.col("of_row")), "left_semi")
    sets = exact_sets(texts, n).dropDuplicates(["cls"])
    work = asked.join(sets, "cls")
    compared = staged(work.groupBy("family", "low", "high").applyInArrow(
        _work_off(limit), "cls long, links long, root long"))
    links = compared.groupBy("cls").agg(F.sum("links").alias("n_links"))
    joined = components(compared.where("cls <> root").select(F.col("cls").alias("a"), F.col("root").alias("b")))
    rooted = classes.select("cls", "lead", "copies").join(joined.withColumnRenamed("v", "cls"), "cls", "left").join(
        links, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    # stored, so that joins exchange both sides themselves and can split the rows of a large group
    rooted = staged(rooted)
    totals = staged(rooted.groupBy("root").agg(F.min("lead").alias("first"), F.sum("copies").alias("class_size")))
    known = staged(rooted.join(totals, "root").select(
        "cls", "first", "class_size", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")))
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("row") == F.col("first.row"))
    return found.select("doc_id", "row", "cls").join(known, "cls").select(
        "doc_id", "row", F.col("first.doc_id").alias("class_id"), "n_links", "class_size", stays.alias("stays"))


def distinct_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs` that stay when one document of each group does: the one of least doc_id.

    Nulls come last; of texts with the same doc_id the one of least hash stays, and of rows equal in
    doc_id and text any one.
    """
    found = staged(grouped_rows(docs, **options).select("doc_id", "row", "stays"))
    repeated = staged(found.where("stays").groupBy("doc_id", "row").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                      .select("doc_id", "row"))
    gone = found.where("not stays").select("doc_id", "row")
    if repeated.isEmpty():
        return without(docs, gone)
    name = "_again"
    while any(column.startswith(name) for column in docs.columns):
        name = f"_{name}"
    same = F.col("doc_id").eqNullSafe(F.col(f"{name}_doc_id")) & (F.col(name) == F.col(f"{name}_row"))
    once = docs.withColumn(name, row_hash(F.col("text"))).join(
        repeated.toDF(f"{name}_doc_id", f"{name}_row"), same, "left_semi").dropDuplicates(["doc_id", name]).drop(name)
    return without(docs, gone.union(repeated)).unionByName(once)
