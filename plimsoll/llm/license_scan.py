"""Licence detection by ordered signature rules.

Three sieves, each cheaper than the next: a document is only looked at if it holds a keyword that
some rule needs; a place in it only if one of the rules' opening words stands there; and only the
rules with that opening are matched, against the words that follow. Matches of all rules are word
intervals; one that lies inside the interval of a match of the same or a higher tier is suppressed,
and rules are ordered so that of equal intervals the earlier rule's stays.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plimsoll.llm.columns import plain_words, row_hash, word_count
from plimsoll.llm.license_rules import signatures

#: Words that follow an opening and are shown to its rules; no rule spans more.
SPAN = 28
#: Every rule's pattern holds one of these.
KEYWORDS = ["licen", "gpl", "asl", "public domain", "permission", "redistribution", "this program", "this library",
            "wtfpl", "fdl", "cc0", "cc zero", "cc by", "creative commons", "open data commons", "mpl ", "epl ", "cddl", "eupl", "odbl",
            "sspl", "cecill", "copyleft", "all rights reserved", "unauthorized ", "contributors", "copyright",
            "confidential and proprietary", "apache", "express or implied"]
#: What a match of each tier says about a document.
WEIGHT = {3: 0.95, 2: 0.85, 1: 0.7, 0: 0.4}


def _spellings(word: str) -> list[str]:
    """The literal words that a pattern's word can be; empty if it can be too many."""
    if m := re.fullmatch(r"\(\?:([a-z|]+)\)", word):
        return m[1].split("|")
    if m := re.fullmatch(r"([a-z]*)\[([a-z0-9]+)\]([a-z]*)", word):
        return [m[1] + c + m[3] for c in m[2]]
    return [word] if re.fullmatch(r"[a-z0-9]+", word) else []


def openings(pattern: str) -> list[str]:
    """Literal beginnings of one or two words, one of which stands wherever the pattern matches."""
    parts = pattern.split(" ")
    first = _spellings(parts[0]) or _spellings(parts[0].removesuffix("(?:"))
    plain = len(parts) > 1 and not parts[0].endswith("(?:")
    second = _spellings(parts[1]) if plain else []
    return [f"{a} {b}" for a in first for b in second] if second else first


def rule_table(spark: SparkSession) -> DataFrame:
    """rule, label, tier, base, opening, pattern: a row for each opening of each rule."""
    rows = [(i, label, tier, base, opening, f"^(?:{pattern})(?= |$)")
            for i, (label, tier, pattern, base) in enumerate(signatures()) for opening in openings(pattern)]
    return spark.createDataFrame(rows, "rule int, label string, tier int, base boolean, opening string, pattern string")


def detections(docs: DataFrame) -> DataFrame:
    """All matches: doc_id, row, start, stop (words), rule, label, tier, base. Nothing is suppressed yet."""
    spark = docs.sparkSession
    starts = sorted({o for _, _, p, _ in signatures() for o in openings(p)})
    one = [o for o in starts if " " not in o]
    two = [o for o in starts if " " in o]
    heads = sorted({o.split(" ")[0] for o in two})

    def gate(joined: Column) -> Column:
        return reduce(or_, [F.contains(joined, F.lit(keyword)) for keyword in KEYWORDS])

    # a plain filter would be evaluated on the text, with its words taken anew for each keyword
    held = docs.select("doc_id", row_hash(F.col("text")).alias("row"),
                       F.explode(F.filter(F.array(plain_words(F.col("text"))), gate)).alias("joined"))
    words = held.select("doc_id", "row", F.split("joined", " ").alias("w"))
    indexed = F.transform("w", lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    opened = F.filter(indexed, lambda x: x["w"].isin(one) | (x["w"].isin(heads) & F.concat_ws(
        " ", x["w"], F.get(F.col("w"), x["i"] + 1)).isin(two)))
    places = words.select("doc_id", "row", F.explode(F.transform(opened, lambda x: F.struct(
        x["i"].cast("long").alias("start"), F.array_join(F.slice("w", x["i"] + 1, F.lit(SPAN)), " ").alias("ahead"),
    ))).alias("p")).select("doc_id", "row", "p.start", "p.ahead")
    heads_of = places.withColumn("opening", F.explode(F.array_distinct(F.array(
        F.substring_index("ahead", " ", 1), F.substring_index("ahead", " ", 2)))))
    # the rules are declared in code: a few hundred rows
    met = heads_of.join(F.broadcast(rule_table(spark)), "opening").where(F.expr("ahead rlike pattern"))
    size = F.expr("size(split(regexp_extract(ahead, pattern, 0), ' '))")
    return met.select("doc_id", "row", "start", (F.col("start") + size).alias("stop"), "rule", "label", "tier", "base")


def resolved(found: DataFrame) -> DataFrame:
    """Adds `kept`: false where a match lies inside one of the same or a higher tier."""
    ahead = (Window.partitionBy("doc_id", "row").orderBy("start", F.desc("stop"), F.desc("tier"), "rule")
             .rowsBetween(Window.unboundedPreceding, -1))
    reach = {t: F.max(F.when(F.col("tier") >= t, F.col("stop"))).over(ahead) for t in WEIGHT}
    marked = found.select("*", *[reach[t].alias(f"reach_{t}") for t in WEIGHT])
    own = F.lit(None).cast("long")
    for t in WEIGHT:
        own = F.when(F.col("tier") == t, F.col(f"reach_{t}")).otherwise(own)
    return marked.withColumn("kept", F.coalesce(own < F.col("stop"), F.lit(True))).select(*found.columns, "kept")


def license_scan(docs: DataFrame) -> DataFrame:
    """Licences of each document, one row per document.

    Columns: doc_id, n_words, n_base, first_word, last_word (of base phrases; null without any),
    base_labels, labels (empty string without any), score. Null and empty texts have no words.
    Rows that repeat a doc_id are told apart by their text; other columns are ignored.
    """
    found = resolved(detections(docs).distinct())
    label = F.col("label")
    best = F.lit(0.0)
    for tier, weight in WEIGHT.items():
        best = F.when(F.col("tier") == tier, F.lit(weight)).otherwise(best)
    per = found.groupBy("doc_id", "row").agg(
        F.count_if("base").alias("n_base"), F.min(F.when(F.col("base"), F.col("start"))).alias("first_word"),
        F.max(F.when(F.col("base"), F.col("start"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("base"), label))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("base") | F.col("kept"), label))), ",").alias("labels"),
        F.max(best).alias("score"))
    counted = docs.select("doc_id", row_hash(F.col("text")).alias("row"),
                          word_count(plain_words(F.col("text"))).alias("n_words"))
    same = counted["doc_id"].eqNullSafe(per["doc_id"]) & (counted["row"] == per["row"])
    return counted.join(per, same, "left").select(
        counted["doc_id"], counted["n_words"], F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word", "last_word", *[F.coalesce(c, F.lit("")).alias(c) for c in ("base_labels", "labels")],
        F.coalesce("score", F.lit(0.0)).alias("score"))
