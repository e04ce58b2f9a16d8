"""Exact deduplication by content-defined chunk recipes.

Every normalised text is cut into chunks at places that its content defines. A text is then the
ordered list of its chunks' identifiers, and two texts are equal exactly when their lists are. The
identifier is a 64-bit fingerprint which is verified against the chunks themselves: each chunk is
moved once to the task that owns its fingerprint, after equal chunks of one map task have been
folded, and a fingerprint that stands for two different chunks is replaced, in every list, by the
chunk's own text. Lists, not documents, are what is grouped and joined afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plimsoll.sources.stage import staged

WHITE = r"[\x20\x09-\x0D]+"
#: A chunk ends after a word that ends in [a-m][n-z], not before the least and at the most length.
LEAST, MOST = 512, 4096


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


def chunks(text: Column, least: int = LEAST, most: int = MOST) -> Column:
    """The text's chunks in order; joined they give the text again."""
    return F.regexp_extract_all(
        text, F.lit(rf"(?s).{{{least},{most}}}?(?<=[a-m][n-z] )|.{{1,{most}}}"), F.lit(0))


def recipes(docs: DataFrame, least: int = LEAST, most: int = MOST, bits: int = 64) -> DataFrame:
    """One row per document: doc_id, text_sha256 and the ordered list of verified identifiers.

    `bits` shortens the fingerprint, which only tests need: the lists stay exact at any width.
    """
    def print_of(chunk: Column) -> Column:
        return F.xxhash64(chunk) if bits == 64 else F.pmod(F.xxhash64(chunk), F.lit(1 << bits))

    texts = docs.select("doc_id", normalised(F.col("text")).alias("norm"))
    cut = texts.select("doc_id", "norm", chunks(F.col("norm"), least, most).alias("cut"))
    listed = staged(cut.select(
        "doc_id", F.sha2("norm", 256).alias("text_sha256"), F.transform("cut", print_of).alias("recipe")))
    single = texts.select(F.explode(chunks(F.col("norm"), least, most)).alias("chunk")).select(
        print_of(F.col("chunk")).alias("print"), "chunk")
    clashing = staged(single.groupBy("print").agg(F.min("chunk").alias("low"), F.max("chunk").alias("high"))
                      .where("low <> high").select("print"))
    if clashing.isEmpty():
        return listed.withColumn("spelled", F.lit(None).cast("array<struct<at:int,chunk:string>>"))
    placed = cut.select("doc_id", F.sha2("norm", 256).alias("text_sha256"), F.posexplode("cut").alias("at", "chunk"))
    spelled = (placed.withColumn("print", print_of(F.col("chunk"))).join(clashing, "print")
               .groupBy("doc_id", "text_sha256")
               .agg(F.array_sort(F.collect_set(F.struct("at", "chunk"))).alias("spelled")))
    same = (listed["doc_id"].eqNullSafe(spelled["doc_id"])) & (listed["text_sha256"] == spelled["text_sha256"])
    return listed.join(spelled, same, "left").select(listed["*"], spelled["spelled"])


def exact_groups(docs: DataFrame, **options: int) -> DataFrame:
    """One row per document with the group of texts equal to its own.

    Columns: doc_id, keep_id (smallest doc_id of the group), group_size, kept, text_sha256. Null
    text is the empty text. Rows that repeat a doc_id and text count in group_size and share the
    verdict; a null doc_id is never the smallest, unless the group has no other. Other columns of
    `docs` are ignored.
    """
    listed = recipes(docs, **options)
    key = F.struct("recipe", F.coalesce("spelled", F.array().cast(listed.schema["spelled"].dataType)))
    rows = listed.select("doc_id", "text_sha256", key.alias("list"))
    groups = rows.groupBy("list").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("size"))
    # stored, so that the join exchanges both sides itself and can split the rows of a large group
    several = staged(groups.where("size > 1"))
    found = rows.join(several, "list", "left")
    keep = F.when(F.col("size").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    return found.select("doc_id", keep.alias("keep_id"), F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
                        F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256")
