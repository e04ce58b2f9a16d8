"""The registered queries as SQL for an independent engine, over whole tables."""

from __future__ import annotations

import json

from ..operators import battery, kri
from ..sources.suites import builtin_battery_text
from . import bindings as X

WORD = r"\p{L}\p{N}_"
SP = r"\t-\r\x1c-\x1f \x{85}\p{Z}"


def lit(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, (int, float)):
        return f"{value!r}::DOUBLE" if isinstance(value, float) else str(value)
    return "'" + str(value).replace("'", "''") + "'"


def values(rows, columns, name) -> str:
    body = ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)
    return f"{name}({', '.join(columns)}) AS (VALUES {body})"


def whole(terms, text="lower(text)") -> str:
    return f"regexp_matches({text}, '(^|[^{WORD}])({'|'.join(terms)})($|[^{WORD}])')"


def heads(text="text") -> dict[str, str]:
    low = f"lower({text})"
    own = {
        "abuse": whole(X.LEXICON.heads["abuse"], low),
        "insult": whole(X.LEXICON.heads["insult"], low),
        "profane": f"regexp_matches({low}, 'sh[^{WORD}]*it')",
    }
    return {"toxic": "(" + " OR ".join(own.values()) + ")", **own}


H = heads()
_GROUPS = {g: whole(t) if t else "regexp_matches(text, '[0-9]{4}')" for g, t in X.GROUPS.items()}

DIM = values(
    [(r[0], i, r[1], r[2], r[3], r[4], r[5], *next(t[1:] for t in X.TIERS if t[0] == r[5]))
     for i, r in enumerate(X.TAXONOMY)],
    ["category", "ord", "definition", "clause", "harm_family", "regulation_ref", "severity_tier", "severity",
     "threshold", "tolerance"], "dim")

TRUTH = "truth AS (SELECT doc_id, toxic AS y_toxic, 1 - quality AS y_low_quality FROM labels)"

FACTS = "facts AS (SELECT doc_id, n_chars, source, length(text) AS char_len, " + ", ".join(
    [f"{s} AS head_{x}" for x, s in H.items()] + [f"{s} AS g_{g}" for g, s in _GROUPS.items()]) + " FROM documents)"

SCORED = FACTS + ", " + TRUTH + f""", preds AS (
  SELECT *, head_abuse::INT + head_insult::INT + head_profane::INT AS hits FROM facts),
scored AS (
  SELECT p.*, t.y_toxic, t.y_low_quality, head_toxic::INT AS pred_toxic,
         (n_chars < {X.SHORT_CHARS})::INT AS pred_low_quality,
         hits / (hits + 1.0::DOUBLE) AS score_toxic,
         400::DOUBLE / (400::DOUBLE + n_chars) AS score_low_quality
  FROM preds p JOIN truth t USING (doc_id)),
everyone AS (
  SELECT p.*, t.y_toxic, t.y_low_quality, hits / (hits + 1.0::DOUBLE) AS score_toxic,
         400::DOUBLE / (400::DOUBLE + n_chars) AS score_low_quality
  FROM preds p LEFT JOIN truth t USING (doc_id)),
every_score AS (
  SELECT 'toxic' AS category, score_toxic AS score FROM everyone
  UNION ALL SELECT 'low_quality', score_low_quality FROM everyone),
long AS (
  SELECT doc_id, 'toxic' AS category, y_toxic AS y, pred_toxic AS pred, score_toxic AS score FROM scored
  UNION ALL
  SELECT doc_id, 'low_quality', y_low_quality, pred_low_quality, score_low_quality FROM scored)"""

CONF_COLUMNS = """count(*) FILTER (y = 1 AND pred = 1) AS tp, count(*) FILTER (y = 0 AND pred = 1) AS fp,
       count(*) FILTER (y = 1 AND pred = 0) AS fn, count(*) FILTER (y = 0 AND pred = 0) AS tn"""
CONF = f"conf AS (SELECT category, {CONF_COLUMNS} FROM long GROUP BY 1)"


def ratio0(a, b):
    return f"coalesce(({a}) / nullif({b}, 0), 0::DOUBLE)"


P0, R0 = ratio0("tp", "tp + fp"), ratio0("tp", "tp + fn")
F0 = ratio0("2 * tp", "2 * tp + fp + fn")

AUCS = """points AS (
  SELECT category, score, sum(y) AS pos, sum(1 - y) AS neg FROM long GROUP BY 1, 2),
run AS (
  SELECT *, sum(pos) OVER w AS ctp, sum(neg) OVER w AS cfp FROM points
  WINDOW w AS (PARTITION BY category ORDER BY score DESC ROWS UNBOUNDED PRECEDING)),
aucs AS (
  SELECT category, sum(pos)::BIGINT AS positives, sum(neg)::BIGINT AS negatives,
         CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN
           round(sum(neg * (2 * ctp - pos))::DOUBLE / (2 * sum(pos)::DOUBLE * sum(neg)::DOUBLE), 9) END AS roc_auc,
         CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN
           round(sum(pos::DOUBLE * ctp / (ctp + cfp)) / sum(pos)::DOUBLE, 9) END AS pr_auc
  FROM run GROUP BY 1)"""

EDGE_FREE_EMAIL = (rf"[{WORD}][{WORD}.+-]*@[{WORD}-]+\.(?:[{WORD}.-]*[{WORD}])")


def mask_sql(text: str) -> str:
    """Word by word: cut into runs, star the listed ones, glue back."""
    stems = "|".join(X.MASKED)
    return (f"array_to_string(list_transform(regexp_extract_all({text}, '[{WORD}]+|[^{WORD}]+'), "
            f"lambda w: CASE WHEN regexp_matches(w, '^(?i)({stems})[{WORD}]*$') "
            f"THEN w[1:1] || repeat('*', length(w) - 1) ELSE w END), '')")


def redact_sql(text: str) -> str:
    t = rf"regexp_replace({text}, 'https?://[^{SP}]+|www\.[^{SP}]+', '[URL]', 'g')"
    t = f"regexp_replace({t}, '{EDGE_FREE_EMAIL}', '[EMAIL]', 'g')"
    t = f"regexp_replace({t}, '@[{WORD}]+', '[USER]', 'g')"
    number = rf"'(^|[^{WORD}])\p{{Nd}}{{4,}}($|[^{WORD}])', '\1[NUM]\2', 'g'"
    t = f"regexp_replace(regexp_replace({t}, {number}), {number})"
    t = mask_sql(t)
    t = f"trim(regexp_replace({t}, '[{SP}]+', ' ', 'g'))"
    return t


def redacted(source: str, columns: str, name: str) -> str:
    return (f"SELECT {columns}, CASE WHEN length(t) > 240 THEN rtrim(t[1:240]) || ' […]' ELSE t END "
            f"AS {name} FROM ({source})")


CLAUSES = "array_to_string(list_sort(list_distinct(list_filter([" + ", ".join(
    f"CASE WHEN {{{x}}} THEN {lit(X.CLAUSES[x])} END" for x in X.HEADS) + "], lambda c: c IS NOT NULL))), '; ')"
RATIONALE = "'[lexical control] word match; not a model verdict.'"

ANSWERS = f"""raw AS (
  SELECT doc_id, source, {", ".join(f"{s} AS {x}" for x, s in H.items())} FROM documents),
payloads AS (
  SELECT doc_id, source,
    '{{"toxic":' || toxic || ',"abuse":' || abuse
      || CASE WHEN source <> {lit(X.LACKING)} THEN ',"insult":' || insult ELSE '' END
      || ',"profane":' || profane
      || ',"policy_clauses":' || to_json(list_concat(list_sort(list_distinct(list_filter([
          {", ".join(f"CASE WHEN {x} THEN {lit(X.CLAUSES[x])} END" for x in X.HEADS)}], lambda c: c IS NOT NULL))),
          CASE WHEN source = {lit(X.INVENTED)} THEN [{lit(X.INVENTED_CLAUSE)}] ELSE [] END))::VARCHAR
      || ',"rationale":"' || CASE WHEN toxic <> (source = {lit(X.CONTRADICTING)}) THEN 'reads as harmful'
                                  ELSE 'nothing of concern' END || '"}}' AS whole
  FROM raw),
answers AS (
  SELECT doc_id, CASE WHEN source = {lit(X.TRUNCATED)} THEN whole[1:length(whole) - 5] ELSE whole END AS payload
  FROM payloads),
typed AS (
  SELECT doc_id, json_valid(payload) AS sound,
         CASE WHEN json_valid(payload) THEN payload::JSON END AS j FROM answers),
parsed AS (
  SELECT doc_id,
    CASE WHEN NOT sound THEN 'malformed'
         WHEN {" OR ".join(f"json_extract(j, '$.{x}') IS NULL" for x in X.HEADS)} THEN 'incomplete' ELSE 'ok' END
      AS parse_status,
    {", ".join(f"json_extract(j, '$.{x}')::BOOLEAN AS {x}" for x in X.HEADS)},
    json_extract_string(j, '$.policy_clauses[*]') AS clause_list,
    json_extract_string(j, '$.rationale') AS rationale
  FROM typed)"""


def _battery_ctes() -> str:
    suites = json.loads(builtin_battery_text())["suites"]
    fixed, templates = [], []
    for i, s in enumerate(suites):
        common = (i, s["suite"], s["failure_mode"], s["regulation_ref"], s["should_flag"])
        if s["type"] == "template":
            for b, t in enumerate(s["templates"]):
                templates.append((*common, b, t))
        else:
            for p, c in enumerate(s["cases"]):
                exp = c.get("expected") or {}
                fixed.append((*common, 0, p, c["text"], c.get("note", ""), (not s["should_flag"]) or bool(exp),
                              *[exp.get(x, 0) for x in X.HEADS]))
    common = ["suite_ord", "suite", "failure_mode", "regulation_ref", "should_flag"]
    expected = [f"expected_{x}" for x in X.HEADS]
    zeros = ", ".join("0" for _ in X.HEADS)
    return (
        values(templates, [*common, "block", "template"], "templates") + ",\n"
        + values(fixed, [*common, "block", "pos", "text", "note", "asserts_specific", *expected], "fixed") + f""",
{TRUTH},
unnumbered AS (
  SELECT suite_ord, suite, failure_mode, regulation_ref, should_flag, block, c_custkey::BIGINT AS pos,
         replace(template, '{{identity}}', c_name) AS text, 'identity=' || c_name AS note, true AS asserts_specific,
         {", ".join(f"0 AS {e}" for e in expected)}
  FROM templates, customer
  UNION ALL SELECT * FROM (SELECT suite_ord, suite, failure_mode, regulation_ref, should_flag, block, pos::BIGINT,
         text, note, asserts_specific, {", ".join(expected)} FROM fixed)
  UNION ALL
  SELECT 100 + y_toxic, CASE WHEN y_toxic = 1 THEN 'labelled_toxic' ELSE 'labelled_clean' END,
         CASE WHEN y_toxic = 1 THEN 'A document labelled toxic is missed.'
              ELSE 'A document labelled clean is flagged.' END,
         'robustness', y_toxic = 1, 0, doc_id, text, 'doc=' || doc_id, y_toxic = 0, {zeros}
  FROM documents JOIN truth USING (doc_id)),
cases AS (
  SELECT printf('RT%03d', row_number() OVER (ORDER BY suite_ord, block, pos)) AS case_id, suite, failure_mode,
         regulation_ref, should_flag, text, note, asserts_specific, {", ".join(expected)}
  FROM unnumbered)""")


BATTERY = _battery_ctes()
BATTERY_EXPANDED = f"""WITH {BATTERY}, placed AS (
  SELECT *, printf('RT%03d', row_number() OVER (ORDER BY suite_ord, block, pos)) AS case_id FROM unnumbered)
  SELECT case_id, suite, block, pos, text, note FROM placed WHERE suite_ord IN (SELECT suite_ord FROM templates)"""


def _scored_battery(name: str, challenger: bool = False) -> str:
    flags = dict(H)
    if challenger:
        flags = {"toxic": f"({H['abuse']} OR {H['insult']})", "abuse": H["abuse"], "insult": H["insult"],
                 "profane": "false"}
    preds = ", ".join(f"{s} AS p_{x}" for x, s in flags.items())
    exact = " AND ".join(f"p_{x}::INT = expected_{x}" for x in X.HEADS)
    return f"""{name}_p AS (SELECT *, {preds} FROM cases),
{name} AS (
  SELECT case_id, suite, should_flag, asserts_specific, {" OR ".join(f"p_{x}" for x in X.HEADS)} AS any_flagged,
         ({" OR ".join(f"p_{x}" for x in X.HEADS)}) = should_flag AS outcome_correct,
         CASE WHEN asserts_specific THEN {exact} END AS exact_match
  FROM {name}_p)"""


CHAMPION, CHALLENGER = _scored_battery("champion"), _scored_battery("challenger", True)


def _summary(name: str) -> str:
    return f"""{name}_sum AS (
  SELECT suite, count(*) AS n_cases, bool_and(should_flag) AS should_flag, count(*) FILTER (outcome_correct) AS passes,
         round_even(100 * count(*) FILTER (outcome_correct) / count(*), 1) AS pass_rate_pct
  FROM {name} GROUP BY 1)"""


GATES = values(battery.GATES, battery.GATE_COLUMNS, "gates")


def _gate_report(name: str) -> str:
    return f"""{name}_values AS (
  SELECT suite, 100 * count(*) FILTER (outcome_correct) / count(*) AS value_pct FROM {name} GROUP BY 1
  UNION ALL SELECT NULL, 100 * count(*) FILTER (outcome_correct) / count(*) FROM {name}),
{name}_gates AS (
  SELECT '{name}' AS control, gate, least_pct, value_pct,
         CASE WHEN value_pct >= least_pct THEN 'PASS' ELSE missed_status END AS status
  FROM gates LEFT JOIN {name}_values v ON gates.suite IS NOT DISTINCT FROM v.suite)"""


K3 = """k3 AS (
  SELECT control, max(value_pct) FILTER (gate = 'overall') AS overall_pct,
         max(value_pct) FILTER (gate = 'benign') AS benign_pct,
         CASE WHEN bool_and(status = 'PASS' OR gate NOT IN ('overall', 'benign')) THEN 'PASS' ELSE 'RED' END AS status,
         CASE WHEN bool_and(status = 'PASS') THEN 'PASS' ELSE 'RED' END AS strict
  FROM champion_gates GROUP BY 1)"""

RELIABILITY = """reliab AS (
  SELECT kri, n, k, 100 * k / nullif(n, 0) AS rate_pct FROM (
    SELECT 'schema_violation' AS kri, count(*) AS n, count(*) FILTER (parse_status <> 'ok') AS k FROM parsed
    UNION ALL
    SELECT 'clause_fabrication', count(*), count(*) FILTER (
      len(list_filter(clause_list, lambda c: NOT list_contains(KNOWN, c))) > 0)
    FROM parsed WHERE parse_status = 'ok'
    UNION ALL
    SELECT 'rationale_consistency', count(*), count(*) FILTER (
      contains(rationale, 'harmful') = (toxic OR abuse OR insult OR profane))
    FROM parsed WHERE parse_status = 'ok'
    UNION ALL
    SELECT 'benign_flag_rate', count(*), count(*) FILTER (any_flagged) FROM champion WHERE NOT should_flag
    UNION ALL
    SELECT 'low_confidence', count(*), count(*) FILTER (abs(score - threshold) < 0.05::DOUBLE)
    FROM every_score JOIN dim USING (category))),
reliability AS (
  SELECT *, CASE
    WHEN kri = 'schema_violation' THEN CASE WHEN rate_pct > 5 THEN 'RED' WHEN rate_pct > 1 THEN 'AMBER' ELSE 'GREEN' END
    WHEN kri = 'rationale_consistency' THEN CASE WHEN rate_pct < 95 THEN 'AMBER' ELSE 'GREEN' END
    WHEN kri = 'low_confidence' THEN CASE WHEN rate_pct > 5 THEN 'AMBER' ELSE 'GREEN' END
    ELSE CASE WHEN rate_pct > 0 THEN 'AMBER' ELSE 'GREEN' END END AS status
  FROM reliab)""".replace("KNOWN", "[" + ", ".join(lit(c) for c in X.CLAUSES.values()) + "]")

SPLIT = "(concat('0x', substr(md5(concat('42-', doc_id)), 1, 8))::BIGINT / 4294967296.0::DOUBLE < 0.8)"


def rag(value, tol, red, amber, green):
    return f"CASE WHEN {value} > {tol} THEN '{red}' WHEN {value} > {tol} / 2 THEN '{amber}' ELSE '{green}' END"


DRIFT = f"""split_conf AS (
  SELECT category, {SPLIT} AS train, {CONF_COLUMNS} FROM long GROUP BY 1, 2),
falls AS (
  SELECT b.category, b.r AS b, c.r AS c, b.r - c.r AS fall
  FROM (SELECT category, {R0} AS r FROM split_conf WHERE train) b
  JOIN (SELECT category, {R0} AS r FROM split_conf WHERE NOT train) c USING (category)),
drift AS (
  SELECT category, severity_tier, 'recall' AS metric, round_even(b, 3) AS baseline, round_even(c, 3) AS current,
         round_even(fall, 3) AS drop, tolerance,
         {rag("fall", "tolerance", "RED — escalate", "AMBER — watch", "GREEN — ok")} AS kri_status
  FROM falls JOIN dim USING (category))"""

_FPR_ROWS = " UNION ALL ".join(
    f"""SELECT '{g}' AS group_name, count(*) FILTER (y_toxic = 0 AND g_{g}) AS clean_mentions,
        count(*) FILTER (y_toxic = 0 AND pred_toxic = 1 AND g_{g}) AS false_positives,
        100 * count(*) FILTER (y_toxic = 0 AND pred_toxic = 1) / count(*) FILTER (y_toxic = 0) AS overall_fpr_pct
        FROM scored""" for g in X.GROUPS)
FPR = f"""fpr AS (
  SELECT *, CASE WHEN gap_pp > 3 THEN 'RED — investigate' WHEN gap_pp > 1.5 THEN 'AMBER — watch' ELSE 'GREEN' END
    AS status
  FROM (SELECT group_name, 'toxic' AS label, clean_mentions, false_positives,
               100 * false_positives / nullif(clean_mentions, 0) AS fpr_pct, overall_fpr_pct,
               100 * false_positives / nullif(clean_mentions, 0) - overall_fpr_pct AS gap_pp FROM ({_FPR_ROWS})))"""

EVENTS = values([(k, t, *next(x[1:] for x in X.TIERS if x[0] == t)) for k, t in X.EVENT_KINDS],
                ["category", "severity_tier", "severity", "threshold", "tolerance"], "kinds") + f""",
decisions AS (
  SELECT ts, event_type AS category, (json_extract(props, '$.k')::INT >= 50)::INT AS y,
         (value >= {X.EVENT_CUT}::DOUBLE)::INT AS pred FROM events),
counts AS (
  SELECT time_bucket(INTERVAL '7 days', ts, TIMESTAMP '1970-01-01') AS cycle_start, category, {CONF_COLUMNS}
  FROM decisions GROUP BY 1, 2)"""

TOKENS = f"list_filter(regexp_split_to_array(TEXT, '[^{WORD}]+'), lambda w: w <> '')"
STOP = "[" + ", ".join(lit(w) for w in X.STOP_WORDS) + "]"


#: Runs of eight words of benchmark items and of documents.
SHARED_RUNS = f"""b AS (SELECT item_id, {TOKENS.replace("TEXT", "lower(text)")} AS w FROM benchmark),
  d AS (SELECT doc_id, {TOKENS.replace("TEXT", "lower(text)")} AS w FROM documents),
  bs AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 7], ' ') AS run
         FROM (SELECT *, unnest(range(1, len(w) - 6)) AS i FROM b WHERE len(w) >= 8)),
  ds AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 7], ' ') AS run
         FROM (SELECT *, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8))"""


def grams_cte(source: str = "documents") -> str:
    tok = TOKENS.replace("TEXT", "strip_accents(lower(text))")
    return f"""kept AS (
  SELECT doc_id, list_filter({tok}, lambda w: NOT list_contains({STOP}, w)) AS k FROM {source}),
grams AS (
  SELECT doc_id, unnest(list_concat(k, list_transform(range(1, len(k)), lambda i: k[i] || ' ' || k[i + 1]))) AS token
  FROM kept),
tf AS (SELECT doc_id, token, count(*) AS tf FROM grams GROUP BY 1, 2),
stats AS (SELECT token, sum(tf)::BIGINT AS n, count(*) AS df FROM tf GROUP BY 1),
vocab AS (SELECT * FROM stats WHERE df >= 3 ORDER BY n DESC, token LIMIT 30000)"""


def _cooccurrence() -> str:
    parts = [f"SELECT '{a}' AS given, '{b}' AS other, sum(y_{a} * y_{b}) / nullif(sum(y_{a}), 0) AS share FROM truth"
             for a in X.LABELS for b in X.LABELS]
    return f"WITH {TRUTH} " + " UNION ALL ".join(parts)


def _group_mentions() -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{g}' AS group_name, count(*) FILTER (g_{g}) AS mentions, count(*) AS n, "
        f"count(*) FILTER (g_{g} AND y_toxic IS NOT NULL) AS seen, count(y_toxic) AS known, "
        f"count(*) FILTER (g_{g} AND y_toxic = 1) AS t, count(*) FILTER (g_{g} AND y_low_quality = 1) AS q, "
        "sum(y_toxic) AS bt, sum(y_low_quality) AS bq FROM everyone" for g in X.GROUPS)
    return f"""WITH {SCORED} SELECT group_name, mentions, 100 * mentions / n AS pct_of_corpus,
      100 * t / nullif(seen, 0) AS toxic_rate_pct, 100 * q / nullif(seen, 0) AS low_quality_rate_pct,
      100 * bt / known AS toxic_base_pct, 100 * bq / known AS low_quality_base_pct FROM ({rows})"""


def _taxonomy_rows() -> str:
    marks = {"toxic": "y_toxic = 1", "low_quality": "y_low_quality = 1",
             **{h: f"head_{h}" for h in X.HEADS if h != "toxic"}}
    return "occ AS (" + " UNION ALL ".join(
        f"SELECT '{x}' AS category, count(*) FILTER ({m}) AS occurrences FROM everyone" for x, m in marks.items()) + ")"


def _verdicts(source: str, key: str, more: str = "") -> str:
    return (f"SELECT {key}, {', '.join(X.HEADS)}, {CLAUSES.format(**{x: x for x in X.HEADS})} AS clauses, "
            f"{RATIONALE} AS rationale{more} FROM ({source})")


_LEX = ", ".join(f"{s} AS {x}" for x, s in H.items())
_NWN = rf"[^{WORD}\n]"
_NEUTRAL = (f"(regexp_matches(lower(text), '(^|[^{WORD}])({'|'.join(X.NEUTRAL_MARKERS)})"
            rf"({_NWN}|{_NWN}[^\n]{{0,28}}{_NWN})({'|'.join(X.NEUTRAL_TERMS)})($|[^{WORD}])') AND NOT {H['abuse']})")

_WORDINGS = {
    "upper_case": "upper(text)",
    "doubled_spaces": "replace(text, ' ', '  ')",
    "letter_spacing": r"regexp_replace(text, '(.)', '\1 ', 'gs')",
}


def _instability() -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{n}' AS rewording, count(*) AS n, count(*) FILTER ({heads(t)['toxic']} <> {H['toxic']}) AS flips "
        "FROM documents" for n, t in _WORDINGS.items())
    return f"""SELECT rewording, n, flips, 100 * flips / n AS rate_pct,
      CASE WHEN 100 * flips / n > 5 THEN 'AMBER' ELSE 'GREEN' END AS status FROM ({rows})"""


def _prompt() -> str:
    head, tail = f"{lit(X.PROMPT_HEADER)} || chr(10) || chr(10)", f"chr(10) || chr(10) || {lit(X.PROMPT_RULES)}"
    lines = """string_agg('- ' || category || ' [' || severity_tier || ']: ' || definition || ' Clause: ' || clause,
                      chr(10) ORDER BY ord)"""
    return f"""WITH {SCORED}, {DIM}, {_taxonomy_rows()}, p AS (
      SELECT {head} || {lines} || {tail} AS prompt FROM dim), u AS (
      SELECT {head} || coalesce({lines}, '') || {tail} AS used_prompt
      FROM dim JOIN occ USING (category) WHERE occurrences > 0)
      SELECT md5(prompt) AS prompt_id, prompt, (SELECT count(text) FROM documents) AS n_requests, used_prompt
      FROM p, u"""


_SAMPLE_DRAW = "md5(concat('42-', doc_id))"
_BOARD = f"{BATTERY}, {CHAMPION}, {CHALLENGER}"
_REL = f"{SCORED}, {DIM}, {ANSWERS}, " + BATTERY.replace(f"{TRUTH},\n", "") + f", {CHAMPION}, {RELIABILITY}"
_CARD = f"SELECT category, {R0} AS r, {F0} AS f FROM"

ORACLES: dict[str, str] = {
    "corpus_scan": "SELECT doc_id AS id, text, lang FROM documents",
    "corpus_head": redacted(
        f"SELECT doc_id, {redact_sql('text')} AS t FROM (SELECT * FROM documents ORDER BY doc_id LIMIT 12)",
        "doc_id", "excerpt"),
    "gate_report_corpus": """
      SELECT 'unique_key' AS gate, 'doc_id' AS subject, count(*) - count(DISTINCT doc_id) AS failures,
             CASE WHEN count(*) = count(DISTINCT doc_id) THEN 'PASS' ELSE 'FAIL' END AS status FROM labels
      UNION ALL SELECT 'binary_domain', 'quality', count(*) FILTER (quality IS NULL OR quality NOT IN (0, 1)),
             CASE WHEN bool_and(coalesce(quality IN (0, 1), false)) THEN 'PASS' ELSE 'FAIL' END FROM labels
      UNION ALL SELECT 'binary_domain', 'toxic', count(*) FILTER (toxic IS NULL OR toxic NOT IN (0, 1)),
             CASE WHEN bool_and(coalesce(toxic IN (0, 1), false)) THEN 'PASS' ELSE 'FAIL' END FROM labels""",
    "taxonomy": f"""WITH {SCORED}, {DIM}, {_taxonomy_rows()}
      SELECT category, definition, clause, harm_family, regulation_ref, severity_tier, occurrences
      FROM dim JOIN occ USING (category)""",
    "text_lengths": f"""SELECT doc_id, length(text)::INT AS char_len,
      len(list_filter(regexp_split_to_array(text, '[{SP}]+'), lambda w: w <> ''))::INT AS word_len FROM documents""",
    "flag_totals": f"""WITH {TRUTH}, t AS (SELECT count(*) AS n, count(*) FILTER (y_toxic = 1 OR y_low_quality = 1) AS f
      FROM truth) SELECT n, f AS flagged, n - f AS clean, 100 * f / n AS flagged_pct,
      100 * (n - f) / n AS all_clean_accuracy_pct FROM t""",
    "label_prevalence": f"""WITH {TRUTH}, {DIM}, t AS (
      SELECT 'toxic' AS category, sum(y_toxic)::BIGINT AS positives, count(*) AS n FROM truth
      UNION ALL SELECT 'low_quality', sum(y_low_quality)::BIGINT, count(*) FROM truth)
      SELECT category, positives, 100 * positives / n AS prevalence_pct, severity_tier FROM t JOIN dim USING (category)""",
    "multi_label_share": f"""WITH {TRUTH} SELECT count(*) FILTER (y_toxic + y_low_quality > 0) AS flagged,
      count(*) FILTER (y_toxic + y_low_quality > 1) AS multi,
      100 * count(*) FILTER (y_toxic + y_low_quality > 1) / count(*) FILTER (y_toxic + y_low_quality > 0) AS multi_pct
      FROM truth""",
    "label_cooccurrence": _cooccurrence(),
    "length_median": f"""WITH {TRUTH}, d AS (SELECT length(text) AS n, y_toxic, y_low_quality
      FROM documents JOIN truth USING (doc_id))
      SELECT 'toxic' AS category, quantile_cont(n, 0.5)::DOUBLE AS median_chars FROM d WHERE y_toxic = 1
      UNION ALL SELECT 'low_quality', quantile_cont(n, 0.5)::DOUBLE FROM d WHERE y_low_quality = 1
      UNION ALL SELECT '(clean)', quantile_cont(n, 0.5)::DOUBLE FROM d WHERE y_toxic + y_low_quality = 0""",
    "length_histogram": f"""WITH {TRUTH}, d AS (
        SELECT y_toxic + y_low_quality > 0 AS flagged,
               least(least(length(text), 2000) * 60 // 2000 + 1, 60)::INT AS bin
        FROM documents JOIN truth USING (doc_id)),
      totals AS (SELECT flagged, count(*) AS total FROM d GROUP BY 1),
      c AS (SELECT flagged, bin, count(*) AS n FROM d GROUP BY 1, 2)
      SELECT flagged, bin, coalesce(n, 0) AS n, coalesce(n, 0) * 60 / (total * 2000) AS density
      FROM (SELECT flagged, total, unnest(range(1, 61))::INT AS bin FROM totals) LEFT JOIN c USING (flagged, bin)""",
    "group_mentions": _group_mentions(),
    "group_mentions_joined": f"""WITH i AS (SELECT {TOKENS.replace("TEXT", "lower(text)")} AS w FROM benchmark),
      t AS (
        SELECT 'benchmark' AS group_name, unnest(w) AS term FROM i
        UNION SELECT role, unnest({TOKENS.replace("TEXT", "lower(text)")}) FROM conversations
        UNION SELECT 'benchmark phrase', unnest(list_transform(range(1, len(w) - 1), lambda s: array_to_string(w[s:s + 2], ' ')))
        FROM i WHERE len(w) >= 3),
      d AS (SELECT doc_id, {TOKENS.replace("TEXT", "lower(text)")} AS w FROM documents),
      w AS (SELECT DISTINCT doc_id, unnest(list_concat(w, CASE WHEN len(w) >= 3 THEN list_transform(
              range(1, len(w) - 1), lambda s: array_to_string(w[s:s + 2], ' ')) ELSE [] END)) AS term FROM d)
      SELECT group_name, count(DISTINCT doc_id) AS mentions FROM w JOIN t USING (term) GROUP BY 1""",
    "split_census": f"""SELECT CASE WHEN {SPLIT} THEN 'train' ELSE 'test' END AS split, lang, count(*) AS n
      FROM documents GROUP BY 1, 2""",
    "balanced_sample": f"""WITH {TRUTH}, r AS (
        SELECT doc_id, y_toxic + y_low_quality > 0 AS flagged, {_SAMPLE_DRAW} AS draw FROM truth),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY flagged ORDER BY draw) AS pick FROM r)
      SELECT doc_id, flagged, draw FROM ranked
      WHERE (flagged AND pick <= 60)
         OR (NOT flagged AND pick <= 120 - (SELECT count(*) FROM ranked WHERE flagged AND pick <= 60))""",
    "balanced_sample_texts": redacted(f"""WITH {TRUTH}, ranked AS (
        SELECT doc_id, y_toxic + y_low_quality > 0 AS flagged,
               row_number() OVER (PARTITION BY y_toxic + y_low_quality > 0 ORDER BY {_SAMPLE_DRAW}) AS pick FROM truth)
      SELECT doc_id, {redact_sql('text')} AS t FROM ranked JOIN documents USING (doc_id)
      WHERE (flagged AND pick <= 60)
         OR (NOT flagged AND pick <= 120 - (SELECT count(*) FROM ranked WHERE flagged AND pick <= 60))""",
        "doc_id", "excerpt"),
    "label_samples": redacted(f"""WITH {TRUTH}, l AS (
        SELECT doc_id, 'toxic' AS category, CASE WHEN y_low_quality = 1 THEN 'low_quality' ELSE '-' END AS other_labels
        FROM truth WHERE y_toxic = 1
        UNION ALL SELECT doc_id, 'low_quality', CASE WHEN y_toxic = 1 THEN 'toxic' ELSE '-' END
        FROM truth WHERE y_low_quality = 1),
      r AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY {_SAMPLE_DRAW})::INT AS pick FROM l)
      SELECT category, pick, doc_id, other_labels, length(text)::INT AS chars, {redact_sql('text')} AS t
      FROM r JOIN documents USING (doc_id) WHERE pick <= 2""",
        "category, pick, doc_id, other_labels, chars", "redacted_excerpt"),
    "redact": redacted(
        f"SELECT 'document' AS kind, doc_id AS id, {redact_sql('text')} AS t FROM documents UNION ALL "
        f"SELECT 'page', page_id, {redact_sql(chr(39) + 'see ' + chr(39) + ' || url || ' + chr(39) + ' now' + chr(39))} "
        "FROM pages", "kind, id", "redacted"),
    "mask_terms": f"SELECT doc_id, {mask_sql('text')} AS masked FROM documents",
    "confusion": f"WITH {SCORED}, {CONF} SELECT * FROM conf",
    "scorecard": f"""WITH {SCORED}, {DIM}, {CONF}, {AUCS}
      SELECT category, severity_tier, tp + fn AS support_pos, {P0} AS precision, {R0} AS recall, {F0} AS f1,
             roc_auc, pr_auc FROM conf JOIN dim USING (category) LEFT JOIN aucs USING (category)""",
    "auc": f"WITH {SCORED}, {AUCS} SELECT * FROM aucs",
    "macro_micro": f"""WITH {SCORED}, {CONF}, per AS (SELECT tp, fp, fn, {P0} AS p, {R0} AS r, {F0} AS f FROM conf)
      SELECT round(avg(f), 12) AS macro_f1,
             round(2 * sum(tp) / nullif(2 * sum(tp) + sum(fp) + sum(fn), 0), 12) AS micro_f1,
             round(avg(r), 12) AS macro_recall, round(avg(p), 12) AS macro_precision FROM per""",
    "tier_thresholds": f"""WITH {SCORED}, {DIM} SELECT category, threshold, count(*) FILTER (score >= threshold) AS reached,
      count(*) AS n FROM long JOIN dim USING (category) GROUP BY 1, 2""",
    "flat_vs_tiered": f"""WITH {SCORED}, {DIM}, s AS (
        SELECT category, severity_tier, threshold, count(*) FILTER (y = 1) AS p,
               count(*) FILTER (score >= 0.5) AS qf, count(*) FILTER (score >= threshold) AS qt,
               count(*) FILTER (y = 1 AND score >= 0.5) AS tf, count(*) FILTER (y = 1 AND score >= threshold) AS tt
        FROM long JOIN dim USING (category) GROUP BY 1, 2, 3)
      SELECT category, severity_tier, threshold, {ratio0("tf", "p")} AS recall_flat, {ratio0("tt", "p")} AS recall_tiered,
             {ratio0("tf", "qf")} AS precision_flat, {ratio0("tt", "qt")} AS precision_tiered,
             round_even({ratio0("tt", "p")} - {ratio0("tf", "p")}, 3) AS recall_lift FROM s""",
    "group_fpr": f"WITH {SCORED}, {FPR} SELECT * FROM fpr",
    "lexical_flags": "SELECT doc_id, " + ", ".join(f"{s}::INT AS {x}" for x, s in H.items()) + " FROM documents",
    "verdict_offline": _verdicts(
        f"SELECT 'd' || doc_id AS id, {_LEX} FROM documents UNION ALL "
        f"SELECT 'c-' || conv_id || '-' || turn, {_LEX} FROM conversations", "id"),
    "verdict_preview": f"""WITH v AS (SELECT doc_id, text, {_LEX} FROM documents ORDER BY doc_id LIMIT 3)
      SELECT doc_id, excerpt, coalesce(nullif(concat_ws(', ', {", ".join(f"CASE WHEN {x} THEN '{x}' END" for x in X.HEADS)}), ''),
             'clean') AS flags, {CLAUSES.format(**{x: x for x in X.HEADS})} AS clauses, {RATIONALE} AS rationale
      FROM v JOIN ({redacted(f"SELECT doc_id, {redact_sql('text')} AS t FROM documents", "doc_id", "excerpt")})
      USING (doc_id)""",
    "neutral_context": f"""SELECT doc_id, {_NEUTRAL} AS neutral,
      ({whole(["the", "of"])} OR {H["abuse"]}) AS toxic_plain,
      (({whole(["the", "of"])} AND NOT {_NEUTRAL}) OR {H["abuse"]}) AS toxic_guarded FROM documents""",
    "verdict_parse": f"""WITH {ANSWERS} SELECT doc_id, parse_status,
      {", ".join(f"CASE WHEN parse_status = 'ok' THEN {x} END AS {x}" for x in X.HEADS)},
      CASE WHEN parse_status = 'ok' THEN array_to_string(clause_list, '; ') END AS clauses FROM parsed""",
    "verdict_flags": f"""WITH {ANSWERS} SELECT doc_id, {", ".join(f"{x}::INT AS pred_{x}" for x in X.HEADS)}
      FROM parsed WHERE parse_status = 'ok'""",
    "verdict_coalesced": f"""WITH {ANSWERS}, lex AS (
        {_verdicts(f"SELECT doc_id, {_LEX} FROM documents", "doc_id")}),
      good AS (SELECT * FROM parsed WHERE parse_status = 'ok')
      SELECT l.doc_id, {", ".join(f"CASE WHEN g.doc_id IS NULL THEN l.{x} ELSE g.{x} END AS {x}" for x in X.HEADS)},
             CASE WHEN g.doc_id IS NULL THEN l.clauses ELSE array_to_string(g.clause_list, '; ') END AS clauses,
             CASE WHEN g.doc_id IS NULL THEN l.rationale ELSE g.rationale END AS rationale,
             CASE WHEN g.doc_id IS NULL THEN 'lexical' ELSE 'model' END AS verdict_source
      FROM lex l LEFT JOIN good g USING (doc_id)""",
    "prompt_text": _prompt(),
    "verdict_requests": """SELECT doc_id, 'Assess the text between the markers.' || chr(10) || '<text>' || chr(10) || text
      || chr(10) || '</text>' AS content FROM documents""",
    "calibration": f"""WITH {SCORED}, t AS (SELECT count(*) AS n, count(*) FILTER (
        pred_toxic = y_toxic AND pred_low_quality = y_low_quality) AS k FROM scored)
      SELECT n AS n_probes, k AS n_exact, 100 * k / n AS exact_pct,
             CASE WHEN k = n THEN 'PASS' ELSE 'FAIL' END AS status FROM t""",
    "route": """SELECT *, CASE WHEN score_low_quality BETWEEN 0.3::DOUBLE AND 0.7::DOUBLE THEN 'challenger'
      ELSE 'champion' END AS route
      FROM (SELECT doc_id, 400::DOUBLE / (400::DOUBLE + n_chars) AS score_low_quality FROM documents)""",
    "champion_challenger": f"""WITH {SCORED}, {DIM}, {ANSWERS}, both_saw AS (
        SELECT s.*, p.toxic::INT AS m_toxic FROM scored s JOIN parsed p ON p.doc_id = s.doc_id AND p.parse_status = 'ok'),
      a AS (SELECT category, {CONF_COLUMNS} FROM (
        SELECT 'toxic' AS category, y_toxic AS y, pred_toxic AS pred FROM both_saw) GROUP BY 1),
      b AS (SELECT category, {CONF_COLUMNS} FROM (
        SELECT 'toxic' AS category, y_toxic AS y, m_toxic AS pred FROM both_saw) GROUP BY 1)
      SELECT category, severity_tier, x.r AS champion_recall, z.r AS challenger_recall, x.f AS champion_f1,
             z.f AS challenger_f1 FROM ({_CARD} a) x JOIN ({_CARD} b) z USING (category) JOIN dim USING (category)""",
    "battery_expand": BATTERY_EXPANDED,
    "battery_cases": f"WITH {BATTERY} SELECT * FROM cases",
    "battery_census": f"""WITH {BATTERY} SELECT suite, count(*) AS n_cases, bool_and(should_flag) AS should_flag
      FROM cases GROUP BY 1""",
    "battery_scored": f"""WITH {BATTERY}, {CHAMPION} SELECT *, CASE WHEN outcome_correct THEN 'PASS' ELSE 'FAIL' END
      AS result FROM champion""",
    "battery_summary": f"WITH {BATTERY}, {CHAMPION}, {_summary('champion')} SELECT * FROM champion_sum",
    "battery_board": f"""WITH {_BOARD}, {_summary('champion')}, {_summary('challenger')}
      SELECT suite, a.should_flag, a.n_cases, a.pass_rate_pct AS champion_pass_pct,
             b.pass_rate_pct AS challenger_pass_pct FROM champion_sum a FULL JOIN challenger_sum b USING (suite)""",
    "battery_gates": f"""WITH {_BOARD}, {GATES}, {_gate_report('champion')}, {_gate_report('challenger')}
      SELECT * FROM champion_gates UNION ALL SELECT * FROM challenger_gates""",
    "gate_k3": f"WITH {BATTERY}, {CHAMPION}, {GATES}, {_gate_report('champion')}, {K3} SELECT * FROM k3",
    "battery_leak": f"""WITH f AS (SELECT DISTINCT trim(regexp_replace(lower(text), '[{SP}]+', ' ', 'g')) AS t
        FROM documents),
      b AS (SELECT item_id, trim(regexp_replace(lower(text), '[{SP}]+', ' ', 'g')) AS t FROM benchmark)
      SELECT count(*) AS n_cases, count(f.t) AS n_leaked, CASE WHEN count(f.t) = 0 THEN 'PASS' ELSE 'RED' END AS status
      FROM b LEFT JOIN f USING (t)""",
    "battery_leak_shingles": f"""WITH {SHARED_RUNS}
      SELECT (SELECT count(*) FROM benchmark) AS n_cases, count(DISTINCT item_id) AS n_leaked,
             count(DISTINCT doc_id) AS n_documents,
             CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'RED' END AS status FROM bs JOIN ds USING (run)""",
    "kri_clause_fabrication": f"""WITH {ANSWERS}, c AS (
        SELECT doc_id, unnest(clause_list) AS clause FROM parsed WHERE parse_status = 'ok')
      SELECT doc_id, clause FROM c WHERE clause NOT IN ({", ".join(lit(c) for c in X.CLAUSES.values())})""",
    "kri_reliability": f"WITH {_REL} SELECT * FROM reliability",
    "kri_instability": _instability(),
    "drift_kri": f"WITH {SCORED}, {DIM}, {DRIFT} SELECT * FROM drift",
    "cycle_counts": f"""WITH {EVENTS} SELECT cycle_start, cycle_start + INTERVAL '7 days' AS cycle_end, category,
      tp, fp, fn, tn FROM counts""",
    "cycle_sliding": f"""WITH {EVENTS}, s AS (
        SELECT time_bucket(INTERVAL '1 day', ts, TIMESTAMP '1970-01-01') - to_days(o::INT) AS cycle_start, category, y, pred
        FROM decisions, range(7) AS r(o)),
      c AS (SELECT cycle_start, category, {CONF_COLUMNS} FROM s GROUP BY 1, 2)
      SELECT cycle_start, category, tp, fn, {R0} AS recall FROM c""",
    "drift_cycles": f"""WITH {EVENTS}, r AS (
        SELECT category, cycle_start, {R0} AS current FROM counts),
      l AS (SELECT *, lag(current) OVER (PARTITION BY category ORDER BY cycle_start) AS previous FROM r)
      SELECT category, cycle_start, severity_tier, previous, current, previous - current AS drop, tolerance,
             {rag("(previous - current)", "tolerance", "RED — escalate", "AMBER — watch", "GREEN — ok")} AS kri_status
      FROM l JOIN kinds USING (category)""",
    "stream_scores": _verdicts(
        f"SELECT 'd' || doc_id AS id, {_LEX} FROM documents UNION ALL "
        f"SELECT 'c-' || conv_id || '-' || turn, {_LEX} FROM conversations", "id"),
    "stream_unique": "SELECT event_id, ts, event_type, value FROM events",
    "stream_alerts": f"""WITH {EVENTS}, base AS (
        SELECT category, {R0} AS baseline FROM (
          SELECT category, sum(tp) AS tp, sum(fp) AS fp, sum(fn) AS fn, sum(tn) AS tn FROM counts GROUP BY 1)),
      r AS (SELECT cycle_start, category, severity_tier, baseline, {R0} AS current, tolerance
            FROM counts JOIN base USING (category) JOIN kinds USING (category)
            WHERE cycle_start + INTERVAL '7 days' <= (SELECT max(ts) FROM events) - INTERVAL '1 hour'),
      a AS (SELECT cycle_start, category, severity_tier, baseline, current, baseline - current AS drop, tolerance FROM r)
      SELECT * FROM (SELECT *, {rag("drop", "tolerance", "RED — escalate", "AMBER — watch", "GREEN — ok")} AS kri_status FROM a)
      WHERE kri_status NOT LIKE 'GREEN%'""",
    "dashboard": f"""WITH {_REL}, {GATES}, {_gate_report('champion')}, {K3}, {DRIFT}, {FPR}
      SELECT 'K1' AS kri, 'max Critical recall drop' AS metric, max(drop) FILTER (severity_tier = 'Critical') AS figure,
             CASE WHEN bool_or(severity_tier = 'Critical' AND kri_status LIKE 'RED%') THEN 'RED' ELSE 'GREEN' END AS status,
             {lit(kri.OWNERS["K1"])} AS owner FROM drift
      UNION ALL SELECT 'K2', 'max group gap (pp)', max(gap_pp),
             CASE WHEN bool_or(status LIKE 'RED%') THEN 'RED' WHEN bool_or(status LIKE 'AMBER%') THEN 'AMBER'
                  ELSE 'GREEN' END, {lit(kri.OWNERS["K2"])} FROM fpr
      UNION ALL SELECT 'K3', 'battery overall (%)', overall_pct, status, {lit(kri.OWNERS["K3"])} FROM k3
      UNION ALL SELECT 'K4', 'indicators not green', (count(*) FILTER (status <> 'GREEN'))::DOUBLE,
             CASE WHEN bool_or(status = 'RED') THEN 'RED' WHEN bool_or(status = 'AMBER') THEN 'AMBER'
                  ELSE 'GREEN' END, {lit(kri.OWNERS["K4"])} FROM reliability""",
    "escalations": f"""WITH {_REL}, {GATES}, {_gate_report('champion')}, {DRIFT}, {FPR},
      {values(kri.ESCALATION_RULES, kri.RULE_COLUMNS, "rules")},
      findings AS (
        SELECT 'drift' AS source, category AS subject, severity_tier, kri_status AS status FROM drift
        UNION ALL SELECT 'gap', group_name, NULL, status FROM fpr
        UNION ALL SELECT 'gate', gate, NULL, status FROM champion_gates
        UNION ALL SELECT 'reliability', kri, NULL, status FROM reliability)
      SELECT f.source, subject, severity_tier, status, coalesce(s.action, g.action, 'log') AS action,
             coalesce(s.escalate_to, g.escalate_to, 'none') AS escalate_to
      FROM findings f
      LEFT JOIN rules s ON s.source = f.source AND starts_with(status, s.prefix) AND s.tier = f.severity_tier
      LEFT JOIN rules g ON g.source = f.source AND starts_with(status, g.prefix) AND g.tier IS NULL""",
    "token_counts": f"""WITH w AS (SELECT doc_id, unnest({TOKENS.replace("TEXT", "lower(text)")}) AS token FROM documents)
      SELECT token, count(*) AS n, count(DISTINCT doc_id) AS df FROM w GROUP BY 1""",
    "fold_accents": "SELECT doc_id, strip_accents(lower(text)) AS folded FROM documents",
    "ngram_counts": f"WITH {grams_cte()} SELECT token, n, df FROM stats",
    "vocabulary": f"WITH {grams_cte()} SELECT token, n, df FROM vocab",
    "tfidf_weights": f"""WITH {grams_cte()}, total AS (SELECT count(*) AS n_texts FROM documents),
      r AS (SELECT doc_id, token, (1 + ln(tf)) * (ln((1 + n_texts) / (1 + df)) + 1) AS raw
            FROM tf JOIN vocab USING (token), total)
      SELECT doc_id, token, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)), 9) AS weight FROM r""",
    "class_weights": f"""WITH {TRUTH}, t AS (
        SELECT 'toxic' AS category, count(*) AS n, sum(y_toxic)::BIGINT AS positives FROM truth
        UNION ALL SELECT 'low_quality', count(*), sum(y_low_quality)::BIGINT FROM truth)
      SELECT category, n, positives, n / nullif(2 * positives, 0) AS weight_pos,
             n / nullif(2 * (n - positives), 0) AS weight_neg FROM t""",
    # what the unique minimum of the penalised loss must satisfy: no gradient, and scores whose mean by class
    # weights is that of the labels; sizes are counted from the tables
    "train_certificate": f"""WITH {SHARED_RUNS}, {TRUTH}, train AS (
        SELECT doc_id, text, y_toxic, y_low_quality FROM documents JOIN truth USING (doc_id)
        WHERE {SPLIT} AND doc_id NOT IN (SELECT doc_id FROM ds JOIN bs USING (run))),
      {grams_cte("train")}, l AS (
        SELECT 'toxic' AS category, y_toxic AS y FROM train
        UNION ALL SELECT 'low_quality', y_low_quality FROM train),
      s AS (SELECT category, count(*) AS n_rows, sum(y)::BIGINT AS n_positive FROM l GROUP BY 1)
      SELECT category, n_rows, n_positive, (SELECT count(*) FROM vocab) AS n_features,
             round(n_positive * (n_rows / (2.0 * n_positive)) / n_rows, 5)::DOUBLE AS weighted_share,
             0.0::DOUBLE AS gradient, 0.0::DOUBLE AS score_gap FROM s""",
}
