"""How the shared test tables play the roles of corpus, lexicon, battery and cycles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import dimensions as D
from ..functions import text as T
from ..operators import battery as B
from ..operators import kri
from ..operators.lexical import Lexicon
from ..operators.profile import group_flags
from ..operators.shape import to_long
from ..sources.suites import builtin_battery_text, parse_suites
from ..streaming.cycles import as_event_time

LABELS = ["toxic", "low_quality"]
HEADS = ["toxic", "abuse", "insult", "profane"]

# (category, definition, clause, harm_family, regulation_ref, severity_tier)
TAXONOMY = [
    ("toxic", "Labelled as harmful.", "No harmful messages", "Harassment", "robustness", "Critical"),
    ("low_quality", "Labelled as not worth keeping.", "No filler", "Quality", "transparency", "Medium"),
    ("abuse", "Uses a listed abusive word.", "No abusive words", "Harassment", "robustness", "High"),
    ("insult", "Uses a listed insulting word.", "No personal attacks", "Harassment", "robustness", "Medium"),
    ("profane", "Uses a vulgar word, masked or not.", "No vulgar words", "Explicit content", "minors", "Medium"),
]
TIERS = [("Medium", 1, 0.50, 0.08), ("High", 2, 0.40, 0.05), ("Critical", 3, 0.30, 0.03)]
CLAUSES = {row[0]: row[2] for row in TAXONOMY}
EVENT_KINDS = [("click", "Critical"), ("error", "Critical"), ("purchase", "High"), ("signup", "Medium"),
               ("view", "Medium")]

LEXICON = Lexicon(
    heads={
        "abuse": ["idiot", "stupid", "moron", "loser", "pathetic", "trash"],
        "insult": ["clown", "idiot", "moron"],
        "profane": [r"sh\W*it"],
    },
    whole_words=frozenset({"abuse", "insult"}),
    implied="toxic",
)
NEUTRAL_MARKERS = ["this", "that"]
NEUTRAL_TERMS = ["is", "and"]
MASKED = ["idiot", "stupid", "moron", "loser", "pathetic", "clown", "shit", "trash"]
GROUPS = {
    "this_that": ["this", "that"],
    "german": ["und", "der", "nicht"],
    "spanish": ["los", "para"],
    "digits": [],
    "absent": ["zzqx"],
}
STOP_WORDS = ["a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "from", "had", "has", "have",
              "he", "her", "his", "i", "in", "is", "it", "not", "of", "on", "or", "that", "the", "their",
              "they", "this", "to", "was", "we", "were", "which", "with", "you"]
SHORT_CHARS = 400
EVENT_CUT = 34.59
PROMPT_HEADER = "You label texts for a moderation desk. Decide for each category whether the text belongs to it."
PROMPT_RULES = "Naming a group of people is not harm. Answer with one JSON object and nothing else."

# Which source's answers are broken in which way.
TRUNCATED, INVENTED, LACKING, CONTRADICTING = "src7", "src11", "src13", "src17"
INVENTED_CLAUSE = "No made-up rules"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def taxonomy(spark: SparkSession) -> DataFrame:
    return D.taxonomy(spark, TAXONOMY)


def dimension(spark: SparkSession) -> DataFrame:
    return D.with_tiers(taxonomy(spark), D.tiers(spark, TIERS))


def gates(spark: SparkSession) -> DataFrame:
    return D.declared(spark, B.GATES, B.GATE_COLUMNS)


def escalation_rules(spark: SparkSession) -> DataFrame:
    return D.declared(spark, kri.ESCALATION_RULES, kri.RULE_COLUMNS)


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, y_toxic, y_low_quality."""
    return table(spark, sf_dir, "labels").select(
        "doc_id", F.col("toxic").alias("y_toxic"), (1 - F.col("quality")).alias("y_low_quality"))


def head_flags(text: Column) -> dict[str, Column]:
    return LEXICON.flags(text)


def text_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything later steps need from a document's text, as narrow columns.

    Evaluated in the scan stage: the text itself never reaches a join or an aggregate.
    """
    docs = documents(spark, sf_dir)
    text = F.col("text")
    groups = group_flags(text, GROUPS)
    groups["digits"] = text.rlike("[0-9]{4}")
    heads = head_flags(text)
    return docs.select(
        "doc_id", "n_chars", T.char_len(text).alias("char_len"),
        *[c.alias(f"head_{x}") for x, c in heads.items()],
        *[c.alias(f"g_{g}") for g, c in groups.items()])


def scored_from(facts: DataFrame) -> DataFrame:
    """Predictions and scores of the lexical control from the narrow facts."""
    hits = sum(F.col(f"head_{x}").cast("int") for x in ["insult", "profane"]) + F.col("head_abuse").cast("int")
    return facts.select(
        "*",
        F.col("head_toxic").cast("int").alias("pred_toxic"),
        (F.col("n_chars") < SHORT_CHARS).cast("int").alias("pred_low_quality"),
        (hits / (hits + F.lit(1.0))).alias("score_toxic"),
        (F.lit(float(SHORT_CHARS)) / (F.lit(float(SHORT_CHARS)) + F.col("n_chars"))).alias("score_low_quality"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with truth, predictions, scores and group flags; wide and narrow-typed."""
    return scored_from(text_facts(spark, sf_dir)).join(truth(spark, sf_dir), "doc_id")


def everyone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As :func:`scored`, but every document; truth is NULL where it is not labelled."""
    return scored_from(text_facts(spark, sf_dir)).join(truth(spark, sf_dir), "doc_id", "left")


def scored_long(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    rows = scored(spark, sf_dir) if rows is None else rows
    return to_long(rows, LABELS, ["doc_id"], {"y": "y_{}", "pred": "pred_{}", "score": "score_{}"})


def lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", T.char_len(F.col("text")).alias("char_len"))
    return docs.join(truth(spark, sf_dir), "doc_id")


def _identities(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {"benign_names": table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("long").alias("pos"), F.col("c_name").alias("identity"))}


def _document_cases(spark: SparkSession, sf_dir: str, flags: dict[str, Column]) -> DataFrame:
    """Labelled documents as two suites: toxic ones must flag (which head is left open), clean
    ones must not. The flags are taken in the scan, ahead of the join with the labels."""
    docs = documents(spark, sf_dir).select("doc_id", "text", *[c.alias(n) for n, c in flags.items()])
    toxic = F.col("y_toxic") == 1
    return docs.join(truth(spark, sf_dir), "doc_id").select(
        (F.lit(100) + F.col("y_toxic")).alias("suite_ord"),
        F.when(toxic, "labelled_toxic").otherwise("labelled_clean").alias("suite"),
        F.when(toxic, "A document labelled toxic is missed.")
        .otherwise("A document labelled clean is flagged.").alias("failure_mode"),
        F.lit("robustness").alias("regulation_ref"), toxic.alias("should_flag"),
        F.col("doc_id").alias("pos"), "text",
        F.concat(F.lit("doc="), F.col("doc_id").cast("string")).alias("note"),
        F.create_map().cast("map<string,int>").alias("expected"), *flags)


def battery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The built-in suites, the templates filled with every customer name, and the labelled documents."""
    suites = parse_suites(spark, builtin_battery_text())
    return B.battery_cases(suites, HEADS, _identities(spark, sf_dir), _document_cases(spark, sf_dir, {}))


def expanded_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The template suites alone, filled with their own identities and every customer name, numbered among all cases."""
    suites = parse_suites(spark, builtin_battery_text())
    return B.numbered_templates(suites, _identities(spark, sf_dir), _document_cases(spark, sf_dir, {}))


def control_flags(text: Column) -> dict[str, Column]:
    """0/1 flags of the champion (the lexical control) and of a challenger without the profane head."""
    reduced = Lexicon({k: v for k, v in LEXICON.heads.items() if k != "profane"}, LEXICON.whole_words, "toxic")
    other = {**reduced.flags(text), "profane": F.lit(False)}
    return {**{f"champion_{x}": c.cast("int") for x, c in LEXICON.flags(text).items()},
            **{f"challenger_{x}": c.cast("int") for x, c in other.items()}}


def judged_battery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Battery rows with both controls' flags, unnumbered and without text: what rates are made of."""
    flags = control_flags(F.col("text"))
    suites = parse_suites(spark, builtin_battery_text())
    listed = B.case_rows(suites, _identities(spark, sf_dir)).select("*", *[c.alias(n) for n, c in flags.items()])
    tabled = B.table_cases(_document_cases(spark, sf_dir, flags), list(flags))
    return listed.unionByName(tabled).select(
        "suite", "should_flag", "asserts_specific", *B.expected_columns(HEADS), *flags)


def battery_predictions(cases: DataFrame) -> DataFrame:
    """The champion's flags as a prediction table keyed by case id."""
    flags = head_flags(F.col("text"))
    return cases.select("case_id", *[flags[x].cast("int").alias(f"pred_{x}") for x in HEADS])


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model answers as JSON, one per document, with four sources answering badly."""
    from ..operators.lexical import clauses_of

    docs = documents(spark, sf_dir)
    flags = head_flags(F.col("text"))
    rows = docs.select("doc_id", "source", *[c.alias(x) for x, c in flags.items()])
    cited = clauses_of({x: F.col(x) for x in HEADS}, CLAUSES)
    cited = F.when(F.col("source") == INVENTED, F.array_append(cited, INVENTED_CLAUSE)).otherwise(cited)
    speaks = F.col("toxic") != (F.col("source") == CONTRADICTING)
    payload = F.to_json(F.struct(
        "toxic", "abuse",
        F.when(F.col("source") != LACKING, F.col("insult")).alias("insult"),
        "profane", cited.alias("policy_clauses"),
        F.when(speaks, "reads as harmful").otherwise("nothing of concern").alias("rationale")))
    cut = F.when(F.col("source") == TRUNCATED, F.substring(payload, F.lit(1), F.length(payload) - 5)).otherwise(payload)
    return rows.select("doc_id", cut.alias("payload"))


def rationale_speaks_of_harm() -> Column:
    return F.col("v.rationale").contains("harmful")


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as labelled decisions: ts, category, y, pred."""
    return decisions_from(table(spark, sf_dir, "events"))


def decisions_from(events: DataFrame) -> DataFrame:
    return as_event_time(events).select(
        "event_id", "ts", F.col("event_type").alias("category"),
        (F.get_json_object("props", "$.k").cast("int") >= 50).cast("int").alias("y"),
        (F.col("value") >= EVENT_CUT).cast("int").alias("pred"))


def event_dimension(spark: SparkSession) -> DataFrame:
    """The declared event types with tier, severity and tolerance."""
    kinds = D.declared(spark, EVENT_KINDS, ["category", "severity_tier"])
    return D.with_tiers(kinds, D.tiers(spark, TIERS))
