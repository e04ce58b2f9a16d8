"""Benchmark decontamination by a prefix-filtered set join.

A benchmark window (ten consecutive words of an item, or a whole shorter item) is a set of placed
word shingles. A document can only hold a window if it holds all of its shingles, hence also the
rarest one, so shingles are ordered by how many windows of the benchmark hold them and only each
window's rarest shingle (its necessary prefix) is looked for. A bitmap of fixed size, hashed from the
prefix shingles, drops nearly all other places of the documents inside the scan; it can only let too
much through. Places that pass leave the scan with the words around them and are joined with the
prefixes as text. The place of the shingle gives the one start that the window could have there;
starts before the document are cut off by the position bound, and the window is verified word for
word in the words around. The text is scanned twice, once for places and once for word counts, and
the plan is the same whatever the sizes of the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plimsoll.llm.columns import plain_words, row_hash, without
from plimsoll.sources.stage import staged

WINDOW = 10
SHINGLE = 5
#: Bits of the map of prefix shingles: 1 MB, whatever their number.
BITS = 1 << 23


def slot(gram: Column) -> Column:
    """The bit of a shingle."""
    return F.pmod(F.xxhash64(gram), F.lit(BITS))


def bitmap(prefixes: DataFrame) -> DataFrame:
    """One row, one column: the bits of all `gram` of `prefixes`, 64 to an entry."""
    part, bit = F.shiftright(slot(F.col("gram")), 6), (slot(F.col("gram")) % 64).cast("int")
    held = prefixes.select(part.alias("id"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("bit"))
    held = held.groupBy("id").agg(F.bit_or("bit").alias("bits"))
    whole = prefixes.sparkSession.range(BITS // 64).join(held, "id", "left")
    ordered = F.sort_array(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))))
    return whole.agg(ordered.alias("entries")).select(F.col("entries.bits").alias("bits"))


def benchmark_windows(benchmark: DataFrame, window: int, shingle: int) -> DataFrame:
    """Placed shingles of the distinct windows: win (the words), len, n (words a shingle), at, gram."""
    items = benchmark.select(plain_words(F.col("text")).alias("item"))
    words = items.where("item <> ''").select(F.split("item", " ").alias("w"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))
    wins = words.select(F.explode(F.transform(starts, lambda s: F.slice("w", s + 1, F.lit(window)))).alias("w"))
    wins = wins.select(F.array_join("w", " ").alias("win"), "w").distinct()
    wins = wins.select("win", "w", F.size("w").alias("len"), F.least(F.size("w"), F.lit(shingle)).alias("n"))
    return wins.select("win", "len", "n", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.col("len") - F.col("n")),
        lambda s: F.array_join(F.slice("w", s + 1, F.col("n")), " "))).alias("at", "gram"))


def window_items(benchmark: DataFrame, window: int) -> DataFrame:
    """win, item_id: the items that each distinct window stands in."""
    items = benchmark.select("item_id", plain_words(F.col("text")).alias("item")).where("item <> ''")
    words = items.select("item_id", F.split("item", " ").alias("w"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))
    return words.select("item_id", F.explode(F.transform(
        starts, lambda s: F.array_join(F.slice("w", s + 1, F.lit(window)), " "))).alias("win")).distinct()


def prefix_shingles(grams: DataFrame) -> DataFrame:
    """win, len, n, gram, at: the shingle of each window that the fewest windows hold, ties by text and place."""
    rarity = grams.groupBy("gram", "n").agg(F.countDistinct("win").alias("windows"))
    least = grams.join(rarity, ["gram", "n"]).groupBy("win", "len", "n").agg(
        F.min(F.struct("windows", "gram", "at")).alias("least"))
    return least.select("win", "len", "n", F.col("least.gram").alias("gram"), F.col("least.at").alias("at"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """Words of each document that stand in a benchmark window, one row per document.

    Columns: doc_id, n_words, n_hit, n_items, items_sha256, contaminated. Null and empty texts have
    no words; items without words have no windows; repeated items count once per item_id, and a
    null item_id is not listed. Rows that repeat a doc_id are told apart by their text. Other
    columns are ignored.
    """
    return marked(docs, benchmark, window, shingle).drop("row")


def marked(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """What `decontaminate` returns, with the row_hash of each text as `row`."""
    prefixes = staged(prefix_shingles(benchmark_windows(benchmark, window, shingle)))
    found = staged(_occurrences(docs, prefixes, window))
    hit = _hits(found, window_items(benchmark, window))
    counted = docs.select("doc_id", row_hash(F.col("text")).alias("row"),
                          F.regexp_count(F.coalesce("text", F.lit("")), F.lit(
                              r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")).cast("long").alias("n_words"))
    same = counted["doc_id"].eqNullSafe(hit["doc_id"]) & (counted["row"] == hit["row"])
    return counted.join(hit, same, "left").select(
        counted["doc_id"], counted["row"], counted["n_words"], F.coalesce(hit["n_hit"], F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(hit["n_items"], F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(hit["items"], F.lit("")), 256).alias("items_sha256"),
        (F.coalesce(hit["n_hit"], F.lit(0)) > 0).alias("contaminated"))


def _occurrences(docs: DataFrame, prefixes: DataFrame, window: int) -> DataFrame:
    """doc_id, row, win, len, start: verified places of windows, once for each equal row of `docs`."""
    widths = sorted(r["n"] for r in prefixes.select("n").distinct().collect())  # at most `shingle` numbers
    texts = docs.select("doc_id", row_hash(F.col("text")).alias("row"), plain_words(F.col("text")).alias("joined"))
    texts = texts.where("joined <> ''").select("doc_id", "row", F.split("joined", " ").alias("words"))
    places = texts.select("doc_id", "row", "words", F.explode(F.sequence(F.lit(0), F.size("words") - 1)).alias("pos"))
    places = places.select("*", F.explode(F.array(*[F.lit(n) for n in widths]).cast("array<int>")).alias("n"))
    places = places.where(F.col("pos") + F.col("n") <= F.size("words"))
    gram = F.array_join(F.slice("words", F.col("pos") + 1, F.col("n")), " ")
    bits = F.get(bitmap(prefixes).scalar(), F.shiftright(slot(gram), 6).cast("int"))
    passed = places.where(F.getbit(bits, (slot(gram) % 64).cast("int")) == 1)
    before = F.least(F.col("pos"), F.lit(window) - F.col("n"))
    around = passed.select("doc_id", "row", "pos", "n", gram.alias("gram"), before.alias("before"), F.slice(
        "words", F.col("pos") - before + 1, before + F.lit(window)).alias("around"))
    met = around.join(prefixes, ["gram", "n"]).where("at <= before")
    stands = F.array_join(F.slice("around", F.col("before") - F.col("at") + 1, F.col("len")), " ")
    return met.where(stands == F.col("win")).select(
        "doc_id", "row", "win", "len", (F.col("pos") - F.col("at")).alias("start"))


def _hits(found: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, row, n_hit, n_items, items (sorted, joined) of the documents that hold windows."""
    spans = found.groupBy("doc_id", "row", "start").agg(F.max("len").alias("len"))
    order = Window.partitionBy("doc_id", "row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("len")
    added = F.greatest(F.lit(0), end - F.greatest(F.col("start"), F.coalesce(F.max(end).over(order), F.lit(0))))
    covered = spans.select("doc_id", "row", added.alias("added")).groupBy("doc_id", "row").agg(
        F.sum("added").alias("n_hit"))
    named = (found.select("doc_id", "row", "win").distinct().join(items, "win")
             .groupBy("doc_id", "row").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("ids")))
    both = covered["doc_id"].eqNullSafe(named["doc_id"]) & (covered["row"] == named["row"])
    return covered.join(named, both).select(
        covered["*"], F.size("ids").cast("long").alias("n_items"), F.array_join("ids", ",").alias("items"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options: int) -> DataFrame:
    """The rows of `docs` in which no benchmark window occurs, unchanged."""
    return without(docs, marked(docs, benchmark, **options).where("contaminated").select("doc_id", "row"))
