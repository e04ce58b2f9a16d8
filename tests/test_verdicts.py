"""Lexical control, verdict tables and indicators."""

import pytest
from pyspark.sql import functions as F

from plimsoll import defaults
from plimsoll import dimensions as D
from plimsoll.operators import kri
from plimsoll.operators import verdicts as V
from plimsoll.operators.champion import clause_map
from plimsoll.operators.lexical import Lexicon
from plimsoll.plans.registry import QUERIES

LABELS = ["toxic", "insult"]
# made up for these tests
HEADS = {
    "toxic": ["nitwit", "dunce", "rubbish", "stinks"], "severe_toxic": ["wish you gone", "gone for good"],
    "obscene": [r"b\W*o\W*g", "blasted"], "threat": ["break your", "come after you"],
    "insult": ["nitwit", "buffoon"], "identity_hate": [r"\bleave our\b", "your sort"],
}
FULL = Lexicon(HEADS, implied="toxic", self_markers=["speaking as", "being a"], self_groups=["baker", "sailor"],
               guarded_by=("identity_hate", "threat"))


def flags(spark, text, guard=False):
    df = spark.createDataFrame([(text,)], "text string")
    row = V.lexical_verdicts(df, FULL, clause_map(defaults.TAXONOMY), ["text"], guard=guard).first()
    return {x for x in defaults.LABELS if row[x]}, row


@pytest.mark.parametrize("text, want", [
    ("what a nice day", set()),
    ("You NITWIT", {"toxic", "insult"}),
    ("I will come after you", {"toxic", "threat"}),
    ("soon gone for good", {"toxic", "severe_toxic"}),
    ("leave our garden be", {"toxic", "identity_hate"}),
    ("b l a s t e d", set()),
    ("oh b-o_g, b og", {"toxic", "obscene"}),
    (None, set()),
])
def test_lexicon(spark, text, want):
    got, row = flags(spark, text)
    assert got == want
    assert list(row["policy_clauses"]) == sorted({clause_map(defaults.TAXONOMY)[x] for x in want})


def test_guard_clears_only_the_parent_label(spark):
    assert flags(spark, "Speaking as a plain baker: this track stinks")[0] == {"toxic"}
    assert flags(spark, "Speaking as a plain baker: this track stinks", guard=True)[0] == set()
    assert flags(spark, "Being a sailor, you buffoon", guard=True)[0] == {"toxic", "insult"}
    assert "toxic" in flags(spark, "Being a baker, and your sort stinks", guard=True)[0]


def parsed(spark):
    rows = [
        (1, '{"toxic":true,"insult":false,"policy_clauses":["A"],"rationale":"harmful"}'),
        (2, '{"toxic":true,"insult":fal'), (3, '{"toxic":true}'), (4, '{"toxic":"yes","insult":false}'),
        (5, None), (6, '{"toxic":false,"insult":false}'), (7, '{"toxic":false,"insult":false,"policy_clauses":["Z"]}')]
    return V.parse_verdicts(spark.createDataFrame(rows, "id int, payload string"), LABELS)


def test_parse_statuses(spark):
    got = {r["id"]: r["parse_status"] for r in parsed(spark).collect()}
    assert got == {1: "ok", 2: "malformed", 3: "incomplete", 4: "malformed", 5: "malformed", 6: "ok", 7: "ok"}
    assert V.verdict_flags(parsed(spark), LABELS, ["id"]).orderBy("id").first()["pred_toxic"] == 1


def test_fallback_and_raise(spark):
    lexical = spark.createDataFrame(
        [(i, False, True, ["L"], "lex") for i in range(1, 7)],
        "id int, toxic boolean, insult boolean, policy_clauses array<string>, rationale string")
    rows = {r["id"]: r for r in V.coalesce_verdicts(lexical, parsed(spark), LABELS, "id").collect()}
    assert rows[1]["verdict_source"] == "model" and rows[1]["toxic"] and rows[1]["policy_clauses"] == ["A"]
    assert rows[2]["verdict_source"] == "lexical" and rows[2]["insult"]
    assert rows[6]["policy_clauses"] == [] and rows[6]["rationale"] == ""
    with pytest.raises(Exception, match="no valid verdict for"):
        V.coalesce_verdicts(lexical, parsed(spark), LABELS, "id", on_error="raise").collect()


def test_reliability_rates(spark):
    rows = kri.reliability(parsed(spark), LABELS, ["A"], F.coalesce(F.col("v.rationale"), F.lit("")).contains("harm"))
    got = {r["kri"]: (r["n"], r["k"], r["status"]) for r in rows.collect()}
    assert got == {"schema_violation": (7, 4, "RED"), "clause_fabrication": (3, 1, "AMBER"),
                   "rationale_consistency": (3, 3, "GREEN")}
    known = spark.createDataFrame([("A",)], "clause string")
    assert [r["clause"] for r in V.fabricated_clauses(parsed(spark), known, "id").collect()] == ["Z"]


def test_prompt_follows_label_order(spark):
    tax = D.taxonomy(spark, defaults.TAXONOMY)
    prompt = V.system_prompt(tax.orderBy(F.desc("category")), "H", "R").first()["prompt"].split("\n")
    assert prompt[0] == "H" and prompt[-1] == "R"
    assert [line.split(" ")[1] for line in prompt[2:-2]] == defaults.LABELS


PROBES = [("a nice day", set()), ("you buffoon", {"toxic", "insult"}), ("we will break your fence", {"toxic", "threat"}),
          ("this is rubbish", {"toxic"})]


def test_written_calibration_probes(spark):
    rows = [(t, *[int(x in want) for x in defaults.LABELS]) for t, want in PROBES]
    probes = spark.createDataFrame(rows, ["text", *[f"y_{x}" for x in defaults.LABELS]])
    scored = probes.select("*", *[c.cast("int").alias(f"pred_{x}") for x, c in FULL.flags(F.col("text")).items()])
    r = V.calibration(scored, defaults.LABELS).first()
    assert (r["n_probes"], r["n_exact"], r["status"]) == (4, 4, "PASS")


def test_drift_ladder(spark):
    dims = D.with_tiers(D.taxonomy(spark, defaults.TAXONOMY), D.tiers(spark, defaults.TIERS))
    base = spark.createDataFrame([(x, 0.8) for x in defaults.LABELS], "category string, recall double")
    now = spark.createDataFrame([("threat", 0.76), ("obscene", 0.77), ("insult", 0.75), ("toxic", 0.9),
                                 ("severe_toxic", 0.74), ("identity_hate", 0.78)], "category string, recall double")
    got = {r["category"]: r["kri_status"][:5] for r in kri.drift_kri(base, now, dims).collect()}
    assert got == {"threat": "RED —", "obscene": "GREEN", "insult": "AMBER", "toxic": "GREEN",
                   "severe_toxic": "RED —", "identity_hate": "AMBER"}
    with pytest.raises(Exception, match="one scorecard only"):
        kri.drift_kri(base, now.limit(3), dims).collect()


def test_rewording_pairs(spark):
    base = spark.createDataFrame([(1, True), (2, False)], "id int, flag boolean")
    variants = spark.createDataFrame([(1, "upper", True), (2, "upper", True)], "id int, rewording string, flag boolean")
    r = kri.instability_of_pairs(kri.paired_flags(base, variants, "id")).first()
    assert (r["n"], r["flips"], r["rate_pct"], r["status"]) == (2, 1, 50.0, "AMBER")


def test_escalation_prefers_the_tier_rule(spark):
    findings = spark.createDataFrame(
        [("drift", "threat", "Critical", "RED — escalate"), ("drift", "insult", "Medium", "RED — escalate"),
         ("gap", "g", None, "GREEN"), ("gate", "benign", None, "RED — identity-bias incident")],
        "source string, subject string, severity_tier string, status string")
    rules = D.declared(spark, kri.ESCALATION_RULES, kri.RULE_COLUMNS)
    got = {r["subject"]: r["action"] for r in kri.escalations(findings, rules).collect()}
    assert got == {"threat": "open incident; freeze category head", "insult": "freeze category head", "g": "log",
                   "benign": "block release"}


def test_prompt_for_all_categories_and_for_those_in_use(spark, tmp_path):
    spark.createDataFrame([(1, "You clown", "src1", 9), (2, None, "src1", 0), (3, "calm", "src2", 4)],
                          "doc_id long, text string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(3, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    row = QUERIES["prompt_text"](spark, str(tmp_path)).first()
    named = lambda prompt: [x.split()[1] for x in prompt.splitlines() if x.startswith("- ")]
    assert named(row["prompt"]) == ["toxic", "low_quality", "abuse", "insult", "profane"]
    assert named(row["used_prompt"]) == ["toxic", "insult"] and row["n_requests"] == 2
