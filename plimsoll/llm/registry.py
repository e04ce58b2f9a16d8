"""The registered queries of the subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plimsoll.llm import (collocations, decontaminate, exact_dedup, language_id, license_scan, mixing, ngram_join,
                          prefix_tokens, revisits, spelling, substring_dedup, token_files, toxicity)
from plimsoll.sources.stage import staged

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out() -> Column:
    """Rows that no model may learn from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(table(spark, sf_dir, "documents")).drop("kept")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    marks = table(spark, sf_dir, "labels").where(~held_out()).select("doc_id", "toxic")
    columns, machine = toxicity.fit(docs, marks)
    found = toxicity.toxicity(docs, columns, machine, keep=["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.language_id(docs, docs.where(~held_out()), keep=["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


def tokenizer_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(table(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False)


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = revisits.resolve_revisits(revisits.page_captures(table(spark, sf_dir, "pages")))
    return found.select("record_id", "kind", "at", "canonical_url", "status", "refers_to",
                        revisits.header_lines(F.col("headers")).alias("headers"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_groups(table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefixes = staged(prefix_tokens.prefix_table(table(spark, sf_dir, "documents"), tokenizer_path()))
    return prefix_tokens.within(prefixes, 512)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_substring_dedup, op2_toxicity, op3_exact_dedup, op4_language_id, op5_license_scan, op6_token_files,
    op7_source_mix, op8_decontaminate, op9_warc_revisits, op10_ngram_join,
    op11_collocations, op12_token_counts, op13_spelling_variants)}

_WORDS = r"""list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""

ORACLES: dict[str, str] = {
    "op1_substring_dedup": r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                                      lambda x: x <> '') AS w FROM documents),
r AS (SELECT doc_id, s, md5(array_to_string(w[s:s + 19], ' ')) AS run
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM d WHERE len(w) >= 20)),
f AS (SELECT doc_id, s, row_number() OVER (PARTITION BY run ORDER BY doc_id, s) > 1 AS later FROM r),
p AS (SELECT doc_id, s, later AND NOT (coalesce(lag(later) OVER o, false) AND lag(s) OVER o = s - 1) AS begins
      FROM f WINDOW o AS (PARTITION BY doc_id ORDER BY s)),
n AS (SELECT doc_id, count(*) FILTER (begins) AS n_paths FROM p GROUP BY 1),
g AS (SELECT doc_id, list_distinct(flatten(list(range(s, s + 20)))) AS gone FROM f WHERE later GROUP BY 1),
k AS (SELECT doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
             CASE WHEN gone IS NULL THEN w
                  ELSE list_filter(w, lambda x, i: NOT list_contains(gone, i)) END AS kept
      FROM d LEFT JOIN g USING (doc_id))
SELECT doc_id, n_words, n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256, coalesce(n_paths, 0) AS n_paths
FROM k LEFT JOIN n USING (doc_id)""",
    "op3_exact_dedup": r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
FROM n WINDOW same AS (PARTITION BY norm)""",
    "op9_warc_revisits": r"""
WITH p AS (SELECT page_id AS p, url, '"' || md5(coalesce(html, '')) || '"' AS tag, length(coalesce(html, '')) AS size
           FROM pages),
c AS (SELECT p * 4 AS record_id, 'response' AS kind, p AS at_s, url, tag AS etag, NULL AS size, NULL AS age,
             'cache-control: max-age=' || (p % 7 * 600) AS control, 'content-length: ' || size AS length_line FROM p
      UNION ALL SELECT p * 4 + 1, 'revisit', p + 5000, url, CASE WHEN p % 5 = 0 THEN '"changed"' ELSE tag END,
                       0, 60, NULL, NULL FROM p
      UNION ALL SELECT p * 4 + 2, 'revisit', p + 9000, url, NULL, NULL, NULL, NULL, NULL FROM p WHERE p % 2 = 0
      UNION ALL SELECT p * 4 + 3, 'revisit', p - 100000000, url, tag, NULL, NULL, NULL, NULL FROM p WHERE p % 3 = 0),
u AS (SELECT *, regexp_extract(url, '^[a-z]+://([^/?#]*)([^?#]*)(?:\?([^#]*))?', ['h', 'p', 'q']) AS x FROM c),
n AS (SELECT *, regexp_replace(lower(x.h), '^www\.', '') || regexp_replace(x.p, '/+$', '') || coalesce('?' || nullif(
        array_to_string(list_sort(list_filter(string_split(x.q, '&'), lambda a: a <> '' AND NOT regexp_matches(
          lower(a), '^(utm_[a-z_]*|ref|sid|sessionid|phpsessid|fbclid|gclid)(=.*)?$'))), '&'), ''), '') AS page FROM u),
f AS (SELECT n.*, r.record_id AS full_id, r.etag AS full_etag, r.length_line AS full_length
      FROM n ASOF LEFT JOIN (SELECT * FROM n WHERE kind = 'response') r
      ON n.page = r.page AND n.at_s::HUGEINT * 1000000000 + n.record_id > r.at_s::HUGEINT * 1000000000 + r.record_id),
s AS (SELECT *, CASE WHEN kind = 'response' THEN 'full' WHEN full_id IS NULL THEN 'no_response'
                     WHEN etag IS NULL THEN 'no_validator' WHEN etag = full_etag THEN 'resolved'
                     ELSE 'changed' END AS status FROM f)
SELECT record_id, kind, at_s AS "at", page AS canonical_url, status,
       CASE WHEN status = 'resolved' THEN full_id END AS refers_to,
       CASE WHEN kind = 'response' THEN control || chr(10) || length_line || chr(10) || 'content-type: text/html' || chr(10)
                 || 'date: ' || at_s || chr(10) || 'etag: ' || etag
            WHEN status = 'resolved' AND age IS NOT NULL THEN 'cache-control: max-age=60' || chr(10) || full_length || chr(10)
                 || 'content-type: text/html' || chr(10) || 'date: ' || at_s || chr(10) || 'etag: ' || etag
            WHEN age IS NOT NULL THEN 'cache-control: max-age=60' || chr(10) || 'content-length: 0' || chr(10)
                 || 'date: ' || at_s || chr(10) || 'etag: ' || etag || chr(10) || 'server: cache'
            WHEN etag IS NULL THEN 'date: ' || at_s ELSE 'etag: ' || etag END AS headers
FROM s""",
    "op10_ngram_join": r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                                                lambda x: x <> '') AS w FROM documents),
g AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_sort(list_distinct(list_transform(
        range(1, greatest(len(w) - 4, 1) + 1), lambda s: array_to_string(w[s:s + 4], ' ')))) END AS grams FROM d),
c AS (SELECT md5(array_to_string(grams, chr(10))) AS cls, any_value(grams) AS grams, min(doc_id) AS lead,
             count(*) AS copies FROM g GROUP BY 1),
x AS (SELECT cls, len(grams) AS n, unnest(grams) AS gram FROM c),
s AS (SELECT a.cls AS a, b.cls AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS shared
      FROM x a JOIN x b ON a.gram = b.gram AND a.cls <> b.cls GROUP BY 1, 2),
e AS (SELECT a, b FROM s WHERE shared * 5 >= (na + nb - shared) * 4),
r AS (SELECT cls AS v, cls AS seen FROM c UNION SELECT r.v, e.b FROM r JOIN e ON e.a = r.seen),
m AS (SELECT v, min(lead) AS class_id, sum(copies)::BIGINT AS class_size FROM r JOIN c ON c.cls = r.seen GROUP BY 1),
l AS (SELECT a, count(*) AS n_links FROM e GROUP BY 1)
SELECT doc_id, class_id, coalesce(n_links, 0) AS n_links, class_size, doc_id = class_id AS kept
FROM g JOIN m ON m.v = md5(array_to_string(grams, chr(10))) LEFT JOIN l ON l.a = m.v""",
    "op8_decontaminate": rf"""
WITH b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
wins AS (SELECT DISTINCT item_id, least(len(w), 10) AS n,
                array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS win
         FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM b WHERE len(w) > 0)),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
p AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s
      FROM d, (SELECT DISTINCT n FROM wins) WHERE len(w) >= n),
o AS (SELECT doc_id, s, p.n, item_id FROM p JOIN wins ON wins.n = p.n
      AND wins.win = array_to_string(p.w[s:s + p.n - 1], ' ')),
h AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS place FROM o) GROUP BY 1),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM o) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN i USING (doc_id)""",
    "op11_collocations": r"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(
             coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
           FROM documents),
p AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM d),
t AS (SELECT lang, sum(len(w))::BIGINT AS n FROM p GROUP BY 1),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda s: array_to_string(w[s:s + k - 1], ' '))) AS phrase
      FROM p, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT * FROM f WHERE k > 1),
gone AS (SELECT DISTINCT x.lang, x.phrase FROM c x JOIN c y ON x.lang = y.lang AND y.k > x.k AND 100 * y.a >= 100 * x.a
         AND contains(' ' || y.phrase || ' ', ' ' || x.phrase || ' ')),
q AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS cut
      FROM c ANTI JOIN gone USING (lang, phrase)),
s AS (SELECT q.lang, q.phrase, q.a, cut, x.a AS l, y.a AS r, n,
             (1000 * q.a::HUGEINT * n // (x.a::HUGEINT * y.a))::BIGINT AS score
      FROM q JOIN t USING (lang) JOIN f x ON x.lang = q.lang AND x.phrase = array_to_string(w[:cut], ' ')
      JOIN f y ON y.lang = q.lang AND y.phrase = array_to_string(w[cut + 1:], ' ')),
low AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
SELECT lang, row_number() OVER o AS rank, phrase, a, l, r, n, score FROM low
WINDOW o AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) QUALIFY rank <= 2000""",
    "op13_spelling_variants": r"""
WITH RECURSIVE runs AS (
  SELECT doc_id, run, count(*) AS c FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents)
  WHERE len(run) >= 7 GROUP BY ALL),
crc AS MATERIALIZED (SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, i: xor(c >> 1, (c & 1) * 3988292384))
                                 ORDER BY b) AS t FROM range(256) AS x(b)),
hashed AS (SELECT run, c, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
             range(1, octet_length(encode(s)) + 1), lambda i: ('0x' || substr(hex(encode(s)), 2 * i - 1, 2))::BIGINT)),
             lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS h
           FROM (SELECT run, c, coalesce(doc_id::VARCHAR, '') || ':' || run AS s FROM runs), crc),
w AS MATERIALIZED (
  SELECT word, sum(c)::BIGINT AS n FROM (SELECT c, CASE WHEN h % 31 = 0 THEN substr(run, 1, h % len(run))
           || substr(run, h % len(run) + 2) ELSE run END AS word FROM hashed)
  WHERE len(word) >= 7 GROUP BY 1 HAVING sum(c) >= 2),
x AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS less
                   FROM (SELECT *, unnest(range(1, len(word) + 1)) AS i FROM w)),
e AS (SELECT a.word, b.word AS other FROM x a JOIN x b ON a.i = b.i AND a.less = b.less AND a.word <> b.word
      UNION SELECT word, less FROM x WHERE less IN (SELECT word FROM w)
      UNION SELECT less, word FROM x WHERE less IN (SELECT word FROM w)),
m AS MATERIALIZED (SELECT word, count(*) AS n_near, arg_min(other, (-n, other)) AS form, max(n) AS form_n
      FROM (SELECT e.word, other, n FROM e JOIN w ON w.word = other) GROUP BY 1),
f AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * w.n THEN form END AS form,
             CASE WHEN form_n >= 10 * w.n THEN form_n END AS form_n FROM w LEFT JOIN m USING (word)),
r AS (SELECT word, form AS root, 1 AS step FROM f WHERE form IS NOT NULL
      UNION ALL SELECT r.word, f.form, step + 1 FROM r JOIN f ON f.word = r.root WHERE f.form IS NOT NULL),
z AS (SELECT word, arg_max(root, step) AS root FROM r GROUP BY 1)
SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM f LEFT JOIN z USING (word)""",
}
