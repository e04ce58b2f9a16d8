"""The registered queries. Each takes (spark, sf_dir) and returns a lazy DataFrame over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import measures as M
from ..functions import runs as R
from ..functions import text as T
from ..operators import battery as B
from ..operators import champion as C
from ..operators import certificate, fairness, features, kri, metrics, profile, sampling, terms
from ..operators import verdicts as V
from ..operators.lexical import Lexicon
from ..operators.shape import exploded, to_long
from ..sources import corpus
from ..sources.kept import kept_table
from ..sources.stage import staged
from ..streaming import cycles, run
from ..streaming.scoring import score_texts
from . import bindings as X

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# -- scans and gates ------------------------------------------------------------------------

@query
def corpus_scan(spark, d):
    """S1"""
    return X.table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text", "lang")


@query
def corpus_head(spark, d):
    """The first rows in key order, redacted for display."""
    docs = X.table(spark, d, "documents")
    return sampling.head(docs, 12, "doc_id").select("doc_id", T.redact(F.col("text"), X.MASKED).alias("excerpt"))


@query
def gate_report_corpus(spark, d):
    """S3, S4, S5, P13"""
    labels = X.table(spark, d, "labels")
    corpus.require_columns(labels.columns, ["doc_id", "quality", "toxic"])
    return corpus.gate_report(labels, ["quality", "toxic"], "doc_id")


@query
def taxonomy(spark, d):
    """The taxonomy with how often each of its labels and heads occurs."""
    facts = X.everyone(spark, d)
    marks = {"toxic": F.col("y_toxic") == 1, "low_quality": F.col("y_low_quality") == 1,
             **{h: F.col(f"head_{h}") for h in X.HEADS if h != "toxic"}}
    totals = facts.agg(*[F.count_if(c).alias(f"n_{x}") for x, c in marks.items()])
    rows = to_long(totals, list(marks), [], {"occurrences": "n_{}"})
    return X.taxonomy(spark).join(rows, "category").orderBy("ord").select(
        "category", "definition", "clause", "harm_family", "regulation_ref", "severity_tier", "occurrences")


# -- profile --------------------------------------------------------------------------------

@query
def text_lengths(spark, d):
    """P1"""
    return profile.with_lengths(X.documents(spark, d)).select("doc_id", "char_len", "word_len")


@query
def flag_totals(spark, d):
    """A2, P2, P3"""
    return profile.flag_totals(X.truth(spark, d), X.LABELS)


@query
def label_prevalence(spark, d):
    """A1, O1"""
    return profile.label_prevalence(X.truth(spark, d), X.LABELS, X.taxonomy(spark))


@query
def multi_label_share(spark, d):
    """A3"""
    return profile.multi_label_share(X.truth(spark, d), X.LABELS)


@query
def label_cooccurrence(spark, d):
    """A4"""
    return profile.label_cooccurrence(X.truth(spark, d), X.LABELS)


@query
def length_median(spark, d):
    """A5"""
    return profile.length_median(X.lengths(spark, d), X.LABELS)


@query
def length_histogram(spark, d):
    """A6, P11"""
    return profile.length_histogram(X.lengths(spark, d), X.LABELS)


@query
def group_mentions(spark, d):
    """A7, A8, J8"""
    return profile.group_mentions(X.everyone(spark, d), list(X.GROUPS), X.LABELS)


@query
def group_mentions_joined(spark, d):
    """J8 for lexicons held in a table: documents using a word of the benchmark or of a speaker's turns, or any
    three words of the benchmark in a row."""
    words = F.array_distinct(T.tokens(F.lower(F.col("text"))))
    items, turns = X.table(spark, d, "benchmark"), X.table(spark, d, "conversations")
    parts = [exploded(items.withColumn("group_name", F.lit("benchmark")), ["group_name"], words, "term"),
             exploded(turns.withColumn("group_name", F.col("role")), ["group_name"], words, "term"),
             R.runs(items.select(F.lit("benchmark phrase").alias("group_name"), R.joined(F.lower("text")).alias("words")),
                    "group_name", [3]).withColumnRenamed("run", "term")]
    lexicon = parts[0].unionByName(parts[1]).unionByName(parts[2])
    mentions = profile.term_mentions(X.documents(spark, d), lexicon, "doc_id")
    return mentions.groupBy("group_name").agg(F.count(F.lit(1)).alias("mentions"))


# -- sampling and redaction -----------------------------------------------------------------

@query
def split_census(spark, d):
    """O6"""
    rows = sampling.with_split(X.table(spark, d, "documents").select("doc_id", "lang"), "doc_id")
    return rows.groupBy("split", "lang").agg(F.count(F.lit(1)).alias("n"))


@query
def balanced_sample(spark, d):
    """O7, O8, J12, U2, W3"""
    sample = sampling.balanced_sample(X.truth(spark, d), X.LABELS, 120, "doc_id")
    return sample.select("doc_id", "flagged", "draw")


@query
def balanced_sample_texts(spark, d):
    """The drawn documents themselves, redacted"""
    sample = sampling.balanced_sample(X.truth(spark, d), X.LABELS, 120, "doc_id")
    drawn = sampling.rows_of_sample(X.table(spark, d, "documents").select("doc_id", "text"), sample, "doc_id")
    return drawn.select("doc_id", T.redact(F.col("text"), X.MASKED).alias("excerpt"))


@query
def label_samples(spark, d):
    """O9, W3, P10"""
    docs = X.table(spark, d, "documents")
    return sampling.label_samples(X.truth(spark, d), docs, X.LABELS, X.MASKED, 2, "doc_id")


@query
def redact(spark, d):
    """documents and page addresses (only the latter hold links)."""
    docs = X.documents(spark, d).select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), "text")
    pages = X.table(spark, d, "pages").select(
        F.lit("page").alias("kind"), F.col("page_id").alias("id"),
        F.concat(F.lit("see "), F.col("url"), F.lit(" now")).alias("text"))
    return docs.unionByName(pages).select("kind", "id", T.redact(F.col("text"), X.MASKED).alias("redacted"))


@query
def mask_terms(spark, d):
    """F2"""
    return X.documents(spark, d).select("doc_id", T.mask_stems(F.col("text"), X.MASKED).alias("masked"))


# -- scorecards -----------------------------------------------------------------------------

@query
def confusion(spark, d):
    """A9"""
    return metrics.confusion_wide(X.scored(spark, d), X.LABELS)


@query
def scorecard(spark, d):
    """A10, A11, A12, O2, M12"""
    return _rounded(metrics.per_category_metrics(X.scored_long(spark, d, staged(X.scored(spark, d))), X.dimension(spark).where(
        F.col("category").isin(X.LABELS))), ["roc_auc", "pr_auc"], 9)


@query
def auc(spark, d):
    """A11, A12, W2"""
    return _rounded(metrics.auc(metrics.score_points(X.scored_long(spark, d))), ["roc_auc", "pr_auc"], 9)


@query
def macro_micro(spark, d):
    """A13"""
    card = metrics.macro_micro(metrics.confusion_wide(X.scored(spark, d), X.LABELS))
    return _rounded(card, card.columns, 12)


@query
def tier_thresholds(spark, d):
    """Each label's tier cut and how many scores reach it."""
    rows = metrics.tiered_predictions(X.scored_long(spark, d), X.dimension(spark))
    return rows.groupBy("category", "threshold").agg(
        F.sum(F.col("pred_tiered").cast("long")).alias("reached"), F.count(F.lit(1)).alias("n"))


@query
def flat_vs_tiered(spark, d):
    """P6, P8, J6, G5"""
    return metrics.flat_vs_tiered(X.scored_long(spark, d), X.dimension(spark))


@query
def group_fpr(spark, d):
    """A14, A15, O3"""
    return _gaps(X.scored(spark, d))


# -- lexical control and verdict tables -------------------------------------------------------

@query
def lexical_flags(spark, d):
    """J9, V2"""
    flags = X.head_flags(F.col("text"))
    return X.documents(spark, d).select("doc_id", *[c.cast("int").alias(x) for x, c in flags.items()])


def _verdict_rows(df: DataFrame, key: str, *extra) -> DataFrame:
    return df.select(key, *X.HEADS, F.array_join("policy_clauses", "; ").alias("clauses"), "rationale", *extra)


@query
def verdict_offline(spark, d):
    """V2, A20, over the conversation turns as well as the documents"""
    docs = X.documents(spark, d).select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), "text")
    turns = X.table(spark, d, "conversations").select(
        F.concat_ws("-", F.lit("c"), F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"), "text")
    return _verdict_rows(V.lexical_verdicts(docs.unionByName(turns), X.LEXICON, X.CLAUSES, ["id"]), "id")


@query
def verdict_preview(spark, d):
    """The first verdicts with redacted text, raised labels, clauses and rationale"""
    docs = sampling.head(X.table(spark, d, "documents"), 3, "doc_id")
    rows = V.lexical_verdicts(docs, X.LEXICON, X.CLAUSES, ["doc_id", "text"])
    raised = F.concat_ws(", ", *[F.when(F.col(x), F.lit(x)) for x in X.HEADS])
    return rows.select(
        "doc_id", T.redact(F.col("text"), X.MASKED).alias("excerpt"),
        F.when(raised == "", "clean").otherwise(raised).alias("flags"),
        F.array_join("policy_clauses", "; ").alias("clauses"), "rationale")


@query
def neutral_context(spark, d):
    """F5, V3"""
    guarded = Lexicon({"toxic": ["the", "of"], "abuse": X.LEXICON.heads["abuse"]}, frozenset({"toxic", "abuse"}),
                        "toxic", X.NEUTRAL_MARKERS, X.NEUTRAL_TERMS, ["abuse"])
    text = F.col("text")
    return X.documents(spark, d).select(
        "doc_id", guarded.neutral(text).alias("neutral"), guarded.flags(text)["toxic"].alias("toxic_plain"),
        guarded.flags(text, guard=True)["toxic"].alias("toxic_guarded"))


@query
def verdict_parse(spark, d):
    """V1"""
    parsed = V.parse_verdicts(X.answers(spark, d), X.HEADS)
    ok = F.col("parse_status") == "ok"
    return parsed.select(
        "doc_id", "parse_status", *[F.when(ok, F.col(f"v.{x}")).alias(x) for x in X.HEADS],
        F.when(ok, F.array_join("v.policy_clauses", "; ")).alias("clauses"))


@query
def verdict_flags(spark, d):
    """P9"""
    return V.verdict_flags(V.parse_verdicts(X.answers(spark, d), X.HEADS), X.HEADS, ["doc_id"])


@query
def verdict_coalesced(spark, d):
    """V4"""
    lexical = V.lexical_verdicts(X.documents(spark, d), X.LEXICON, X.CLAUSES, ["doc_id"])
    parsed = V.parse_verdicts(X.answers(spark, d), X.HEADS)
    return _verdict_rows(V.coalesce_verdicts(lexical, parsed, X.HEADS, "doc_id"), "doc_id", "verdict_source")


@query
def prompt_text(spark, d):
    """The prompt with every category of the taxonomy, how many requests go out with it, and the shorter prompt
    for the categories in use - those with a labelled or flagged document."""
    prompt = V.system_prompt(X.taxonomy(spark), X.PROMPT_HEADER, X.PROMPT_RULES)
    in_use = taxonomy(spark, d).where(F.col("occurrences") > 0).select("category")
    used = V.system_prompt(X.taxonomy(spark).join(in_use, "category", "left_semi"), X.PROMPT_HEADER, X.PROMPT_RULES)
    return prompt.withColumns({
        "n_requests": verdict_requests(spark, d).agg(F.count("content")).scalar(),
        "used_prompt": used.select("prompt").scalar()})


@query
def verdict_requests(spark, d):
    """P14"""
    return X.documents(spark, d).select("doc_id", V.request_text(F.col("text")).alias("content"))


@query
def calibration(spark, d):
    """V5, with every labelled document as a probe"""
    return V.calibration(X.scored(spark, d), X.LABELS)


@query
def route(spark, d):
    """V6"""
    scores = X.scored_from(X.text_facts(spark, d)).select("doc_id", "score_low_quality")
    return V.route(scores, "score_low_quality", 0.3, 0.7)


@query
def champion_challenger(spark, d):
    """The lexical control against the model's valid verdicts, on the labelled documents both saw and the
    label that both judge."""
    parsed = V.parse_verdicts(X.answers(spark, d), X.HEADS)
    model = V.verdict_flags(parsed, X.HEADS, ["doc_id"]).select("doc_id", F.col("pred_toxic").alias("model_toxic"))
    rows = X.scored(spark, d).join(model, "doc_id")
    theirs = rows.select("y_toxic", F.col("model_toxic").alias("pred_toxic"))
    return metrics.champion_challenger(metrics.confusion_wide(rows, ["toxic"]), metrics.confusion_wide(theirs, ["toxic"]),
                                       X.dimension(spark))


# -- battery --------------------------------------------------------------------------------

@query
def battery_expand(spark, d):
    """Every filled template with its place and its number among all cases of the battery"""
    return X.expanded_templates(spark, d)


@query
def battery_cases(spark, d):
    """S6, G1, W1, F10, F11"""
    return X.battery(spark, d)


@query
def battery_census(spark, d):
    """A17"""
    return B.battery_census(X.judged_battery(spark, d))


def _scored_battery(spark, d, control="champion"):
    return B.score_rows(X.judged_battery(spark, d), X.HEADS, control + "_{}")


@query
def battery_scored(spark, d):
    """J3, G2"""
    cases = X.battery(spark, d)
    return B.score_predictions(cases, X.battery_predictions(cases), X.HEADS).select(
        "case_id", "suite", "should_flag", "asserts_specific", "any_flagged", "outcome_correct", "exact_match", "result")


@query
def battery_summary(spark, d):
    """A16, O4"""
    return B.suite_summary(_scored_battery(spark, d))


@query
def battery_board(spark, d):
    """J5"""
    rows = staged(X.judged_battery(spark, d))
    return B.control_board(B.suite_summary(B.score_rows(rows, X.HEADS, "champion_{}")),
                           B.suite_summary(B.score_rows(rows, X.HEADS, "challenger_{}")))


@query
def battery_gates(spark, d):
    """G3, A18, U1"""
    gates, rows = X.gates(spark), staged(X.judged_battery(spark, d))
    return B.gate_report(B.score_rows(rows, X.HEADS, "champion_{}"), gates, "champion").unionByName(
        B.gate_report(B.score_rows(rows, X.HEADS, "challenger_{}"), gates, "challenger"))


@query
def gate_k3(spark, d):
    """From the stored battery result of these tables if there is one, else it is computed and stored"""
    inputs = [X.documents(spark, d), X.truth(spark, d), X.table(spark, d, "customer").select("c_custkey", "c_name")]
    rows = kept_table(spark, "battery", inputs, [X.HEADS, X.LEXICON.settings(), X.builtin_battery_text()],
                      lambda: _scored_battery(spark, d))
    return B.gate_status(B.gate_report(rows, X.gates(spark), "champion"))


@query
def battery_leak(spark, d):
    """Benchmark items against the documents as training text"""
    flat = F.trim(F.regexp_replace(F.lower(F.col("text")), T.SPACE + "+", " "))
    return B.leak_gate(_items(spark, d), X.documents(spark, d), flat)


@query
def battery_leak_shingles(spark, d):
    """Documents that share a run of eight words with a benchmark item"""
    return B.shingle_leak_gate(_items(spark, d), X.documents(spark, d).select("doc_id", "text"), R.joined(F.lower("text")))


# -- indicators -----------------------------------------------------------------------------

@query
def kri_clause_fabrication(spark, d):
    """J10, G8b"""
    parsed = V.parse_verdicts(X.answers(spark, d), X.HEADS)
    return V.fabricated_clauses(parsed.where(F.col("parse_status") == "ok"), X.taxonomy(spark), "doc_id")


def _reliability(spark, d, everyone=None, battery=None):
    parsed = V.parse_verdicts(X.answers(spark, d), X.HEADS)
    rows = kri.reliability(parsed, X.HEADS, list(X.CLAUSES.values()), X.rationale_speaks_of_harm())
    battery = _scored_battery(spark, d) if battery is None else battery
    return rows.unionByName(kri.overconfidence(battery)).unionByName(
        kri.low_confidence(
            X.scored_long(spark, d, X.everyone(spark, d) if everyone is None else everyone), X.dimension(spark)))


@query
def kri_reliability(spark, d):
    """G8a, G8b, G8d, G8e"""
    return _reliability(spark, d)


@query
def kri_instability(spark, d):
    """J11, G8c"""
    variants = kri.rewordings(F.col("text"))
    rows = X.documents(spark, d).select(
        X.head_flags(F.col("text"))["toxic"].alias("base"),
        *[X.head_flags(v)["toxic"].alias(name) for name, v in variants.items()])
    return kri.instability(rows, "base", list(variants))


def _drift(spark, d, scored=None):
    rows = sampling.with_split(X.scored(spark, d) if scored is None else scored, "doc_id")
    counts = metrics.confusion_wide(rows, X.LABELS, ["split"])
    card = lambda side: metrics.scorecard(counts.where(F.col("split") == side), X.dimension(spark))
    return kri.drift_kri(card("train"), card("test"), X.dimension(spark))


@query
def drift_kri(spark, d):
    """Training side as baseline, hold-out as current"""
    return _drift(spark, d)


@query
def cycle_counts(spark, d):
    """T2"""
    return cycles.cycle_counts(X.decisions(spark, d))


@query
def cycle_sliding(spark, d):
    """T3"""
    counts = cycles.cycle_counts(X.decisions(spark, d), slide="1 day")
    return counts.select("cycle_start", "category", "tp", "fn", metrics.recall().alias("recall"))


@query
def drift_cycles(spark, d):
    """W5"""
    cards = cycles.cycle_cards(cycles.cycle_counts(X.decisions(spark, d)))
    return kri.drift_cycles(cards, X.event_dimension(spark))


@query
def stream_scores(spark, d):
    """The documents and the conversation turns as a stream of files, scored without state"""
    docs = run.table_stream(spark, f"{d}/documents.parquet").select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), "text")
    turns = run.table_stream(spark, f"{d}/conversations.parquet").select(
        F.concat_ws("-", F.lit("c"), F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"), "text")
    scored = score_texts(docs.unionByName(turns), X.LEXICON, X.CLAUSES, ["id"])
    return _verdict_rows(run.drain(scored, run.new_folder(spark, "scores")), "id")


@query
def stream_unique(spark, d):
    """T5: every event sent twice, each kept once; state is bounded by the lateness"""
    events = lambda: cycles.as_event_time(run.table_stream(spark, f"{d}/events.parquet")).select(
        "event_id", "ts", "event_type", "value")
    kept = cycles.unique_rows(events().unionByName(events()), "event_id", "3650 days")
    return run.drain(kept, run.new_folder(spark, "unique"))


@query
def stream_alerts(spark, d):
    """T4: closed cycles of a stream that fall below the recall of all decisions so far stored"""
    card = cycles.cycle_counts(X.decisions(spark, d)).groupBy("category").agg(
        *[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn")]).select("category", metrics.recall().alias("recall"))
    baseline = staged(card)
    folder = run.new_folder(spark, "alerts")
    sink = cycles.alert_sink(baseline, X.event_dimension(spark), f"{folder}/rows")
    counts = cycles.cycle_counts(X.decisions_from(run.table_stream(spark, f"{d}/events.parquet")), lateness="1 hour")
    found = run.drain_batches(counts, folder, sink, f"{folder}/rows", cycles.ALERTS)
    return found.drop("batch_id")


def _staged_inputs(spark, d):
    """The narrow tables every indicator reads, each taken from its text scan once: all documents, those that
    are labelled, and the battery."""
    everyone = staged(X.everyone(spark, d))
    return everyone, everyone.where(F.col("y_toxic").isNotNull()), staged(_scored_battery(spark, d))


def _gaps(scored: DataFrame) -> DataFrame:
    return fairness.group_false_positives(scored, list(X.GROUPS), "toxic")


@query
def dashboard(spark, d):
    """G7, A19, F13, U3"""
    everyone, scored, battery = _staged_inputs(spark, d)
    gate = B.gate_status(B.gate_report(battery, X.gates(spark), "champion"))
    return kri.dashboard(_drift(spark, d, scored), _gaps(scored), gate, _reliability(spark, d, everyone, battery))


@query
def escalations(spark, d):
    """G9"""
    everyone, scored, battery = _staged_inputs(spark, d)
    tier = F.lit(None).cast("string")
    findings = _drift(spark, d, scored).select(
        F.lit("drift").alias("source"), F.col("category").alias("subject"), "severity_tier",
        F.col("kri_status").alias("status"))
    gaps = _gaps(scored).select(F.lit("gap"), "group_name", tier, "status")
    gates = B.gate_report(battery, X.gates(spark), "champion").select(F.lit("gate"), "gate", tier, "status")
    reliability = _reliability(spark, d, everyone, battery).select(F.lit("reliability"), "kri", tier, "status")
    return kri.escalations(findings.union(gaps).union(gates).union(reliability), X.escalation_rules(spark))


# -- features and model ---------------------------------------------------------------------

@query
def token_counts(spark, d):
    """F6"""
    return terms.statistics(X.documents(spark, d), F.lower(T.or_empty(F.col("text"))))


@query
def fold_accents(spark, d):
    """F7"""
    return X.documents(spark, d).select("doc_id", T.fold_accents(F.lower(F.col("text"))).alias("folded"))


def _folded() -> dict:
    return {**features.folded(F.col("text")), "stop_words": X.STOP_WORDS, "longest": 2}


@query
def ngram_counts(spark, d):
    """F8"""
    return terms.statistics(X.documents(spark, d), **_folded())


@query
def vocabulary(spark, d):
    """L2"""
    return features.vocabulary(terms.statistics(X.documents(spark, d), **_folded()))


@query
def tfidf_weights(spark, d):
    """L3"""
    docs = X.documents(spark, d)
    idf = features.with_idf(features.vocabulary(terms.statistics(docs, **_folded())), docs.agg(F.count(F.lit(1)).alias("n")))
    return _rounded(terms.weights(docs, idf=idf, key="doc_id", **_folded()), ["weight"], 9)


@query
def class_weights(spark, d):
    """L4"""
    return features.class_weights(X.truth(spark, d), X.LABELS)


def _items(spark, d):
    """Benchmark items as the battery that no fit may learn from."""
    return X.table(spark, d, "benchmark").select(F.col("item_id").alias("case_id"), "text")


def _champion(spark, d):
    """The trained control and the split rows: labelled documents that share no run with a benchmark item.

    Fitted once for the same rows and settings in a shared folder, and only if the leak gate passes.
    """
    docs = X.documents(spark, d).select("doc_id", "text").join(X.truth(spark, d), "doc_id")
    rows = staged(B.without_leaks(_items(spark, d), docs, R.joined(F.lower("text"))))
    gate = B.shingle_leak_gate(_items(spark, d), rows, R.joined(F.lower("text")))
    return C.kept_champion(rows, X.LABELS, "doc_id", leak_gate=gate, stop_words=X.STOP_WORDS, tol=1e-8)


@query
def train_scores(spark, d):
    """Hold-out scores of the trained control"""
    model, rows = _champion(spark, d)
    test = model.predict(rows.where(F.col("split") == "test"))
    return C.long_scores(test, X.LABELS, ["doc_id"])


@query
def train_scorecard(spark, d):
    """L7 into A10-A12: the hold-out scorecard of the trained control"""
    return metrics.per_category_metrics(
        staged(train_scores(spark, d)), X.dimension(spark).where(F.col("category").isin(X.LABELS)))


@query
def train_certificate(spark, d):
    """The fitted heads are the optimum of the penalised loss over the training rows"""
    model, rows = _champion(spark, d)
    found = certificate.certificate(model, rows.where(F.col("split") == "train").drop("split"), "doc_id")
    return _rounded(found, ["weighted_share", "gradient", "score_gap"], 5)


@query
def top_features(spark, d):
    """O5, W4, L8"""
    model, _ = _champion(spark, d)
    rows = C.top_features(model.weights(spark), X.LABELS)
    return rows.withColumn("token", T.mask_stems(F.col("token"), X.MASKED))


def _rounded(df: DataFrame, columns: list[str], places: int) -> DataFrame:
    """Sums of doubles depend on their order in the last bits; reports show fewer digits."""
    return df.withColumns({c: F.round(F.col(c), places) for c in columns})
