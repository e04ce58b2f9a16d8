"""Corpus profile: prevalence, co-occurrence, lengths, group mentions.

Inputs are wide: one row per text with a 0/1 column per label. Counting is done wide in one
pass with map-side partial sums, and only the one-row result is turned into report rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..dimensions import annotate
from ..functions import measures as M
from ..functions import runs as R
from ..functions import text as T
from ..sources.stage import staged
from .shape import exploded, to_long

CLEAN = "(clean)"


def any_label(labels: Sequence[str], pattern: str = "y_{}") -> Column:
    columns = [F.col(pattern.format(label)) for label in labels]
    return (F.greatest(*columns) if len(columns) > 1 else columns[0]) > 0


def label_count(labels: Sequence[str], pattern: str = "y_{}") -> Column:
    return sum((F.col(pattern.format(label)) for label in labels[1:]), F.col(pattern.format(labels[0])))


def with_lengths(df: DataFrame, text: str = "text") -> DataFrame:
    return df.withColumns({"char_len": T.char_len(F.col(text)), "word_len": T.word_len(F.col(text))})


def label_prevalence(df: DataFrame, labels: Sequence[str], taxonomy: DataFrame) -> DataFrame:
    totals = df.agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"y_{x}").alias(f"pos_{x}") for x in labels])
    rows = to_long(totals, labels, ["n"], {"positives": "pos_{}"})
    rows = annotate(rows, taxonomy, ["severity_tier"])
    return rows.select(
        "category",
        F.coalesce("positives", F.lit(0)).alias("positives"),
        M.percent(F.col("positives"), F.col("n")).alias("prevalence_pct"),
        "severity_tier",
    ).orderBy(F.desc("positives"), "category")


def flag_totals(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Flagged and clean counts; the clean share is the accuracy of never flagging anything."""
    totals = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(any_label(labels)).alias("flagged"))
    clean = F.col("n") - F.col("flagged")
    return totals.select(
        "n", "flagged", clean.alias("clean"),
        M.percent(F.col("flagged"), F.col("n")).alias("flagged_pct"),
        M.percent(clean, F.col("n")).alias("all_clean_accuracy_pct"),
    )


def multi_label_share(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    totals = df.agg(
        F.count_if(any_label(labels)).alias("flagged"),
        F.count_if(label_count(labels) > 1).alias("multi"),
    )
    return totals.select("flagged", "multi", M.percent(F.col("multi"), F.col("flagged")).alias("multi_pct"))


def label_cooccurrence(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """P(other | given) for every ordered pair, NULL where the given label never occurs."""
    sums = [F.sum(F.col(f"y_{a}") * F.col(f"y_{b}")).alias(f"n_{a}__{b}") for a in labels for b in labels]
    pairs = [
        F.struct(F.lit(a).alias("given"), F.lit(b).alias("other"),
                 M.rate(F.col(f"n_{a}__{b}"), F.col(f"n_{a}__{a}")).alias("share"))
        for a in labels for b in labels
    ]
    return df.agg(*sums).select(F.inline(F.array(*pairs)))


def length_median(df: DataFrame, labels: Sequence[str], length: str = "char_len") -> DataFrame:
    """Exact interpolated median length per label and for clean rows.

    Rows are first counted per (label, length), so what reaches the percentile is one entry per
    distinct length, however many texts share it.
    """
    bands = [F.when(F.col(f"y_{x}") == 1, F.lit(x)) for x in labels]
    bands.append(F.when(~any_label(labels), F.lit(CLEAN)))
    long = exploded(df, [length], F.array_compact(F.array(*bands)), "category")
    counts = long.groupBy("category", F.col(length).alias("len")).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("category").agg(
        F.percentile("len", 0.5, F.col("n")).alias("median_chars")
    ).orderBy("median_chars", "category")


def length_histogram(df: DataFrame, labels: Sequence[str], length: str = "char_len",
                     clip: int = 2000, bins: int = 60) -> DataFrame:
    """Equal-width bins over [0, clip], last bin closed, density per flagged/clean band."""
    slot = F.least(F.width_bucket(F.least(F.col(length), F.lit(clip)), F.lit(0), F.lit(clip), F.lit(bins)),
                   F.lit(bins))
    counts = df.groupBy(any_label(labels).alias("flagged"), slot.cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("n"))
    # at most `bins` entries per band from here on
    bands = counts.groupBy("flagged").agg(
        F.sum("n").alias("total"), F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("by_bin"))
    rows = bands.select("flagged", "total", "by_bin",
                        F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    n = F.coalesce(F.try_element_at("by_bin", F.col("bin")), F.lit(0))
    return rows.select("flagged", "bin", n.alias("n"),
                       (n * F.lit(bins) / (F.col("total") * F.lit(clip))).alias("density"))


def group_flags(text: Column, groups: Mapping[str, Sequence[str]]) -> dict[str, Column]:
    """One boolean column per group: the lower-cased text mentions one of its terms as a whole word."""
    lowered = F.lower(T.or_empty(text))
    return {name: T.contains_term(lowered, terms) for name, terms in groups.items()}


def group_mentions(df: DataFrame, groups: Sequence[str], rate_labels: Sequence[str]) -> DataFrame:
    """Mentions per group over all rows, and label rates among the mentioning rows that have the label.

    ``df`` carries ``g_<group>`` booleans and ``y_<label>``, which is NULL where a row is not labelled;
    groups nobody mentions stay, with NULL rates.
    """
    sums = [F.count(F.lit(1)).alias("n")]
    for label in rate_labels:
        sums += [F.sum(f"y_{label}").alias(f"base_{label}"), F.count(f"y_{label}").alias(f"known_{label}")]
    for g in groups:
        sums.append(F.count_if(F.col(f"g_{g}")).alias(f"k_{g}"))
        for label in rate_labels:
            y = F.col(f"y_{label}")
            sums += [F.count_if(F.col(f"g_{g}") & (y == 1)).alias(f"{label}__{g}"),
                     F.count_if(F.col(f"g_{g}") & y.isNotNull()).alias(f"known_{label}__{g}")]
    keep = ["n", *[c for x in rate_labels for c in (f"base_{x}", f"known_{x}")]]
    rows = to_long(df.agg(*sums), groups, keep, {"mentions": "k_{}", **{x: x + "__{}" for x in rate_labels},
                                                 **{f"seen_{x}": f"known_{x}__{{}}" for x in rate_labels}}, key="group_name")
    return rows.select(
        "group_name", "mentions",
        M.percent(F.col("mentions"), F.col("n")).alias("pct_of_corpus"),
        *[M.percent(F.col(x), F.col(f"seen_{x}")).alias(f"{x}_rate_pct") for x in rate_labels],
        *[M.percent(F.col(f"base_{x}"), F.col(f"known_{x}")).alias(f"{x}_base_pct") for x in rate_labels],
    ).orderBy(F.desc("mentions"), "group_name")


def term_mentions(df: DataFrame, terms: DataFrame, key: str = "id", text: str = "text") -> DataFrame:
    """(key, group_name) pairs for a lexicon too large to write into an expression.

    ``terms`` holds ``(group_name, term)`` rows; a term is one word or several, matched as whole words
    that follow each other. The words of both sides are hashed as runs, and a map of the lexicon's
    hashes, of a fixed size, cuts the texts to the runs that may be terms before anything is
    shuffled; what is left is compared as text. A run names all its groups in one row, and the pairs
    are made distinct before the shuffle, so a word that many groups list is sent once. The join side
    is left to the optimizer: it broadcasts a lexicon it has measured to be small, and a frequent term
    is split by the adaptive skew rule. Terms without a word match nothing.
    """
    words = R.joined(F.lower(T.or_empty(F.col("term"))))
    listed = terms.select("group_name", words.alias("run")).where(F.col("run") != "").groupBy("run").agg(
        F.collect_set("group_name").alias("groups"))
    listed = staged(listed.withColumn("width", F.length("run") - F.length(F.replace("run", F.lit(" "), F.lit(""))) + 1))
    widths = [r["width"] for r in listed.select("width").distinct().collect()]  # lengths of terms in words
    rows = df.select(key, R.joined(F.lower(T.or_empty(F.col(text)))).alias("words"))
    found = R.runs(rows, key, sorted(widths), R.run_map(listed))
    pairs = found.join(listed.select("run", "groups"), "run").select(key, F.explode("groups").alias("group_name"))
    return pairs.distinct()
