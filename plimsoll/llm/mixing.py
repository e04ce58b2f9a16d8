"""Mixing sources to target weights.

Each source's documents are packed, in the order of a hash of their ids, into one stream of words
that is cut into blocks of a fixed length. The mix is a sequence of slots, each filled with one
block. Slots are dealt to output shards; a shard draws how many of its slots each source fills from
a multinomial law over the target shares, and a source's slots are numbered on through the shards.
Slot j of a source takes block perm(j) of the source, a keyed permutation of the block numbers that
needs no table, so that every pass over a source takes each block once and two passes at most are
ever begun. Slots are joined with blocks by source and block number. The draws decide what each shard
holds, and `mixed_shards` gives the words by shard; how much is taken of a document they do not change,
since each source gets exactly its target, the last slot being cut where it is reached. What the draws
leave short of a target fills one more shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plimsoll.llm.columns import SPACED_WORD, row_hash
from plimsoll.sources.stage import staged

BLOCK = 64
SHARD_SLOTS = 16384
#: Draws are made over shares in units of one part in so many.
UNITS = 1 << 16
WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MOST = 2
ROUNDS = 16
#: Rows of one source that share a running total, on average.
RUN = 2_000


def permuted(index: Column, size: Column, key: Column, rounds: int = ROUNDS, inverse: bool = False) -> Column:
    """A keyed pseudorandom permutation of 0..size-1 (swap-or-not shuffle); any size.

    Each round is its own inverse, so the rounds in reverse order undo the permutation.
    """
    def step(x: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(key, r, F.lit(1)), size) - x, size)
        swap = F.pmod(F.xxhash64(key, r, F.greatest(x, partner)), F.lit(2)) == 1
        return F.when(swap, partner).otherwise(x)

    return F.aggregate(F.sequence(F.lit(rounds), F.lit(1)) if inverse else F.sequence(F.lit(1), F.lit(rounds)), index, step)


def targets(sizes: DataFrame, weights=WEIGHTS, budget: float = BUDGET, most: int = MOST) -> DataFrame:
    """source, source_size, target: shares by weight, no source above `most` times its size.

    Sources are ranked by code point, null last, in one task: a row per source, not per document.
    What a source can't take is reshared by weight. Filling up to a common level does it at once:
    in order of size over weight, a source is full if the level that the rest would share exceeds it.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    every = Window.partitionBy(F.lit(0))
    rank = F.row_number().over(every.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % len(weights) + 1).cast("int"))
    rows = by_source.withColumn("weight", weight.cast("double"))
    cap = F.lit(most) * F.col("source_size")
    order = every.orderBy(cap / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(every) * F.lit(budget) - F.coalesce(F.sum(cap).over(before), F.lit(0))
    others = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = rows.withColumn("level", left / others).withColumn("full", F.col("level") * F.col("weight") >= cap)
    rest = F.min(F.when(~F.col("full"), F.struct((cap / F.col("weight")).alias("at"), "level"))).over(every)["level"]
    return level.withColumn("rest", rest).select(
        "source", "source_size",
        F.when(F.col("full"), cap).otherwise(F.col("rest") * F.col("weight")).cast("double").alias("target"))


def packed(docs: DataFrame) -> DataFrame:
    """doc_id, source, row, size and `begin`, the document's first word in its source's stream.

    Running totals are taken inside runs of about RUN rows, chosen by a hash of the id, and over the
    runs' totals, so no source's rows meet in one task.
    """
    sized = staged(docs.select("doc_id", "source", row_hash(F.col("text")).alias("row"), F.regexp_count(
        F.coalesce("text", F.lit("")), F.lit(SPACED_WORD)).cast("long").alias("size")))
    runs = sized.count() // RUN + 1
    rows = sized.withColumn("run", F.pmod(F.xxhash64("doc_id", "row"), F.lit(runs)))
    inside = Window.partitionBy("source", "run").orderBy("doc_id", "row")
    rows = rows.withColumn("within", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)))
    totals = rows.groupBy("source", "run").agg(F.sum("size").alias("total"))
    along = Window.partitionBy("source").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("source").alias("of"), F.col("run").alias("of_run"),
                            F.coalesce(F.sum("total").over(along), F.lit(0)).alias("offset"))
    same = F.col("source").eqNullSafe(F.col("of")) & (F.col("run") == F.col("of_run"))
    return rows.join(offsets, same).select(
        "doc_id", "source", "row", "size",
        (F.col("offset") + F.coalesce("within", F.lit(0))).alias("begin"))


def slots(plan: DataFrame, block: int = BLOCK, shard_slots: int = SHARD_SLOTS, seed: int = 7) -> DataFrame:
    """The mix, a row per slot: shard, source, slot, pass, block_no, words (the block's first so many).

    `plan` is what `targets` returns.
    """
    spark = plan.sparkSession
    goal = F.round("target").cast("long")
    sources = plan.where("source_size > 0").select(
        "source", "target", "source_size", F.ceil(F.col("source_size") / block).alias("n_blocks"),
        F.floor(goal / F.col("source_size")).alias("passes"), (goal % F.col("source_size")).alias("rest"),
        F.xxhash64("source", F.lit(seed)).alias("key"))
    sources = sources.withColumn("tail", F.col("source_size") - (F.col("n_blocks") - 1) * block).withColumn(
        "tail_at", permuted(F.col("n_blocks") - 1, F.col("n_blocks"), F.col("key"), inverse=True)).withColumn(
        "need", F.col("passes") * F.col("n_blocks") + F.least(F.ceil(F.col("rest") / block) + 1, F.col("n_blocks")))
    every = Window.partitionBy(F.lit(0))
    along = every.orderBy(F.col("source").asc_nulls_last())
    upto = F.round(F.sum("target").over(along) / F.sum("target").over(every) * UNITS).cast("int")
    share = sources.select("source", upto.alias("upto")).withColumn(
        "from", F.coalesce(F.lag("upto").over(along), F.lit(0)))
    units = share.where("upto > from").select("source", F.explode(F.expr("sequence(from, upto - 1)")).alias("unit"))
    total = sources.agg(F.coalesce(F.sum("need"), F.lit(0)).alias("n")).first()["n"]  # one figure
    n_shards = total // shard_slots + 1
    draws = spark.range(n_shards * shard_slots).select(
        F.floor(F.col("id") / shard_slots).alias("shard"),
        F.pmod(F.xxhash64(F.col("id"), F.lit(seed)), F.lit(UNITS)).cast("int").alias("unit"))
    drawn = draws.groupBy("shard", "unit").agg(F.count(F.lit(1)).alias("n")).join(units, "unit")
    counts = drawn.groupBy("shard", "source").agg(F.sum("n").alias("n"))
    # the slots that the draws leave over go to one more shard
    counts = counts.unionByName(sources.select(F.lit(n_shards).alias("shard"), "source", F.col("need").alias("n")))
    run = Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    dealt = counts.withColumn("first", F.coalesce(F.sum("n").over(run), F.lit(0)))
    dealt = dealt.join(sources.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    dealt = dealt.withColumn("last", F.least(F.col("first") + F.col("n"), F.col("need")) - 1).where("last >= first")
    # a few numbers each make thousands of slots, so they are dealt out by number, not by size
    dealt = dealt.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "shard", "source")
    each = dealt.withColumn("slot", F.explode(F.expr("sequence(first, last)"))).withColumns({
        "pass": F.floor(F.col("slot") / F.col("n_blocks")), "at": F.col("slot") % F.col("n_blocks")})
    each = each.withColumn("block_no", permuted(F.col("at"), F.col("n_blocks"), F.col("key")))
    length = F.when(F.col("at") == F.col("tail_at"), F.col("tail")).otherwise(F.lit(block))
    ahead = F.col("at") * block - F.when(F.col("at") > F.col("tail_at"), block - F.col("tail")).otherwise(F.lit(0))
    words = F.when(F.col("pass") < F.col("passes"), length).otherwise(F.least(length, F.col("rest") - ahead))
    return each.withColumn("words", words.cast("long")).where("words > 0").select(
        "shard", "source", "slot", "pass", "block_no", "words")


def pieces(docs: DataFrame, seed: int = 7, block: int = BLOCK,
           shard_slots: int = SHARD_SLOTS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The packed documents, the sources' targets, and what the mix takes of each document.

    The third has a row for each block that a pass takes of a document: doc_id, row, source, begin,
    pass, shard, slot, place, lo, hi. lo and hi are words of the document from 0, `place` is where
    they begin in the slot. `begin` tells equal rows apart.
    """
    rows = staged(packed(docs))
    plan = staged(targets(rows))
    # Spark takes exploded slots for a few rows and would broadcast them: they grow with the documents
    taken = slots(plan, block, shard_slots, seed).withColumnRenamed("source", "of").hint("merge")
    first = F.floor(F.col("begin") / block)
    last = F.floor((F.col("begin") + F.col("size") - 1) / block)
    parts = rows.where("size > 0").select("doc_id", "row", "source", "begin", "size",
                                          F.explode(F.sequence(first, last)).alias("part"))
    same = F.col("source").eqNullSafe(F.col("of")) & (F.col("part") == F.col("block_no"))
    lo = F.greatest(F.col("begin"), F.col("part") * block)
    hi = F.least(F.col("begin") + F.col("size"), F.col("part") * block + F.col("words"))
    cut = parts.join(taken, same).select(
        "doc_id", "row", "source", "begin", "pass", "shard", "slot", (lo - F.col("part") * block).alias("place"),
        (lo - F.col("begin")).alias("lo"), (hi - F.col("begin")).alias("hi"))
    return rows, plan, cut.where("hi > lo")


def mix(docs: DataFrame, seed: int = 7) -> DataFrame:
    """One row per document: doc_id, size, source_size, target (its source's), taken words, first_shard, last_shard.

    The last two are the least and largest output shard with words of it, null where none is taken. A null text has no words, a null source is a source of its own, ranked last. Every row is packed
    apart, also if it repeats another. Other columns are ignored.
    """
    rows, plan, cut = pieces(docs, seed)
    sums = cut.groupBy(F.col("doc_id").alias("id"), F.col("row").alias("of_row"), F.col("begin").alias("at")).agg(
        F.sum(F.col("hi") - F.col("lo")).alias("taken"), F.min("shard").alias("first_shard"),
        F.max("shard").alias("last_shard"))
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("row") == F.col("of_row")) & (F.col("begin") == F.col("at"))
    found = rows.join(sums.hint("merge"), same, "left").select(
        "doc_id", "source", "size", F.when(F.col("size") > 0, F.coalesce("taken", F.lit(0))).otherwise(0).cast(
            "long").alias("taken"), "first_shard", "last_shard")
    named = plan.withColumnRenamed("source", "of")
    return found.join(named, F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", "size", "source_size", "target", "taken", "first_shard", "last_shard")


def _texts(docs: DataFrame, key: list[str], ranges: DataFrame) -> DataFrame:
    """`ranges` (key columns named of_...) with each document's text and its words, `held`."""
    texts = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"), "doc_id", "source", "text",
                        row_hash(F.col("text")).alias("row")).dropDuplicates(key)
    same = F.lit(True)
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"of_{k}"))
    return texts.join(ranges.hint("merge"), same).withColumn(
        "held", F.regexp_extract_all("text", F.lit(SPACED_WORD), F.lit(0)))


def mixed_shards(docs: DataFrame, seed: int = 7, block: int = BLOCK, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """The mix by output shard, a row per slot and document with words in it.

    Columns: shard, source, slot, place (of the row's first word in the slot, from 0), pass, doc_id, text
    (the words, joined by single spaces). A slot belongs to one shard; a shard holds `shard_slots` slots
    or fewer, but for the last, which has what the draws left over. Null and empty texts have no row, a
    null source is a source of its own, rows that repeat another are taken apart. Other columns are ignored.
    """
    key = ["doc_id", "row", "source"]
    _, _, cut = pieces(docs, seed, block, shard_slots)
    ranges = cut.groupBy(*[F.col(k).alias(f"of_{k}") for k in key], "begin").agg(
        F.collect_list(F.struct("shard", "slot", "place", "pass", "lo", "hi")).alias("ranges"))
    words = lambda r: F.array_join(F.slice("held", (r["lo"] + 1).cast("int"), (r["hi"] - r["lo"]).cast("int")), " ")
    part = _texts(docs.select("doc_id", "source", "text"), key, ranges).select("doc_id", "source", F.transform(
        "ranges", lambda r: F.struct(r["shard"].alias("shard"), r["slot"].alias("slot"), r["place"].alias("place"),
                                     r["pass"].alias("pass"), words(r).alias("text"))).alias("parts"))
    return part.select("doc_id", "source", F.inline("parts")).select(
        "shard", "source", "slot", "place", "pass", "doc_id", "text")


def write_shards(mixed: DataFrame, folder: str) -> None:
    """Writes what `mixed_shards` returns as Parquet, a folder and one sorted file per shard."""
    mixed.repartition("shard").sortWithinPartitions("shard", "source", "slot", "place").write.partitionBy(
        "shard").parquet(folder)


def mixed_documents(docs: DataFrame, seed: int = 7) -> DataFrame:
    """The mix as documents: a row per document and pass that takes words of it.

    Columns are those of `docs`. A document taken whole keeps its text; of one taken in part the
    taken words remain, in order, joined by single spaces. Null and empty texts have no row, a null
    source is a source of its own, rows that repeat another are taken apart; an empty table has an
    empty mix.
    """
    _, _, cut = pieces(docs, seed)
    key = ["doc_id", "row", "source"]
    ranges = cut.groupBy(*key, "begin", "pass").agg(
        F.array_sort(F.collect_list(F.struct("lo", "hi"))).alias("ranges"),
        F.sum(F.col("hi") - F.col("lo")).alias("words"))
    ranges = ranges.select(*[F.col(k).alias(f"of_{k}") for k in key], "ranges", "words")
    part = _texts(docs, key, ranges)
    text = F.when(F.size("held") <= F.col("words"), F.col("text")).otherwise(F.array_join(F.flatten(F.transform(
        "ranges", lambda r: F.slice("held", (r["lo"] + 1).cast("int"), (r["hi"] - r["lo"]).cast("int")))), " "))
    return part.select(F.col("whole").withField("text", text).alias("whole")).select("whole.*")
