"""Resolution of not-modified revisit records in web archives.

A revisit record says that a page had not changed, and leaves out what it was. It is resolved by an
as-of join on the canonical URL with the latest earlier full response: if the validators agree, the
record gets that response's payload and headers, with those headers replaced that a not-modified
answer may update. Rows hold no payloads; `refers_to` names the record that has it.

The join is one running "last full response" per URL. It runs inside slices of time, and each slice
is handed the last response of the slices before it, so a URL with many captures spreads over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Headers that a not-modified answer may update.
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "vary"]
#: Query parameters that name the visitor or the way there, not the page.
NOISE = r"^(?:utm_[a-z_]*|ref|sid|sessionid|phpsessid|fbclid|gclid)(?:=.*)?$"
SLICE = 1 << 12
_URL = r"(?s)^\s*(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)([^?#]*)(?:\?([^#]*))?"


def canonical_url(url: Column) -> Column:
    """Host, path and query under which captures of one page meet; null where there is no host.

    Scheme, user, default port, `www.`, fragment, closing slash and noise parameters go; the host is
    lower-cased and parameters are sorted.
    """
    host = F.regexp_replace(F.lower(F.regexp_extract(url, _URL, 1)), r"^.*@|:(?:80|443)?$", "")
    host = F.regexp_replace(host, r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(url, _URL, 2), "/+$", "")
    kept = F.array_sort(F.filter(F.split(F.regexp_extract(url, _URL, 3), "&"),
                                 lambda p: (p != "") & ~F.lower(p).rlike(NOISE)))
    query = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit(""))
    return F.when(host != "", F.concat(host, path, query))


def merged_headers(full: Column, update: Column) -> Column:
    """The full response's headers, with those that `update` has and may change."""
    allowed = F.map_filter(update, lambda k, _: k.isin(PERMITTED))
    return F.map_concat(F.map_filter(full, lambda k, _: ~F.map_contains_key(allowed, k)), allowed)


def resolve_revisits(captures: DataFrame, slice_size: int = SLICE) -> DataFrame:
    """One row per capture of `captures` (record_id, kind, at, url, headers: map of lower-case names).

    Adds canonical_url, refers_to and status, and replaces headers of resolved revisits by merged ones:
    `full` for responses; for revisits `resolved`, `changed` (the validators differ), `no_validator`
    (none that both records have) or `no_response` (no earlier full response, or null url or time).
    Earlier is by (at, record_id); a response of the same record_id and time is not earlier than
    itself. Null headers are empty. Other columns are dropped.
    """
    rows = captures.select(
        "record_id", "kind", F.col("at").cast("long").alias("at"), canonical_url(F.col("url")).alias("canonical_url"),
        F.coalesce("headers", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))
        .alias("headers"))
    rows = rows.withColumn("slice", F.floor(F.col("at") / slice_size))
    usable = (F.col("kind") == "response") & F.col("at").isNotNull() & F.col("canonical_url").isNotNull()
    record = F.when(usable, F.struct("at", "record_id", "headers"))
    inside = Window.partitionBy("canonical_url", "slice").orderBy("at", "record_id", F.desc("kind"))
    here = rows.withColumn("here", F.last(record, ignorenulls=True).over(
        inside.rowsBetween(Window.unboundedPreceding, -1)))
    lasts = rows.where(usable).groupBy("canonical_url", "slice").agg(F.max_by(
        F.struct("at", "record_id", "headers"), F.struct("at", "record_id")).alias("last"))
    along = Window.partitionBy("canonical_url").orderBy("slice")
    # each slice is told the last response before it: the slices that have rows, merged with those that have responses
    asked = rows.where(F.col("canonical_url").isNotNull() & F.col("slice").isNotNull()).select(
        "canonical_url", "slice").distinct().join(lasts, ["canonical_url", "slice"], "left")
    told = asked.select("canonical_url", "slice", F.last("last", ignorenulls=True).over(
        along.rowsBetween(Window.unboundedPreceding, -1)).alias("before")).where("before is not null")
    met = here.join(told, ["canonical_url", "slice"], "left").withColumn("full", F.coalesce("here", "before"))
    etag, dated = F.lit("etag"), F.lit("last-modified")

    def pair(name: Column) -> tuple[Column, Column]:
        return F.try_element_at("headers", name), F.try_element_at("full.headers", name)

    (tag, full_tag), (time, full_time) = pair(etag), pair(dated)
    agreed = F.when(tag.isNotNull() & full_tag.isNotNull(), tag == full_tag).otherwise(time == full_time)
    status = (F.when(F.col("kind") != "revisit", F.lit("full"))
              .when(F.col("full").isNull() | F.col("at").isNull() | F.col("canonical_url").isNull(),
                    F.lit("no_response"))
              .when(agreed.isNull(), F.lit("no_validator")).when(agreed, F.lit("resolved"))
              .otherwise(F.lit("changed")))
    done = met.withColumn("status", status)
    resolved = F.col("status") == "resolved"
    return done.select(
        "record_id", "kind", "at", "canonical_url", "status", F.when(resolved, F.col("full.record_id")).alias("refers_to"),
        F.when(resolved, merged_headers(F.col("full.headers"), F.col("headers"))).otherwise(
            F.col("headers")).alias("headers"))


def header_lines(headers: Column) -> Column:
    """`name: value` lines in order of name."""
    return F.array_join(F.array_sort(F.transform(F.map_entries(headers), lambda e: F.concat_ws(
        ": ", e["key"], e["value"]))), "\n")


def page_captures(pages: DataFrame) -> DataFrame:
    """A crawl of `pages`: each page in full, and later and earlier visits that found it unchanged.

    Page p is fetched at second p. It is revisited 5000 seconds later under a spelling of its own
    (every fifth page has a new entity tag by then), every second one again after 9000 seconds by a
    server that sends no validator, and every third one was visited long before the crawl.
    """
    tag = F.concat(F.lit('"'), F.md5(F.encode(F.coalesce("html", F.lit("")), "utf-8")), F.lit('"'))
    page = pages.select(F.col("page_id").alias("p"), "url", tag.alias("tag"),
                        F.length(F.coalesce("html", F.lit(""))).cast("string").alias("size"))

    def capture(number: int, kind: str, at: Column, url: Column, headers: dict[str, Column], when: Column) -> Column:
        held = F.create_map(*[x for k, v in headers.items() for x in (F.lit(k), v.cast("string"))])
        return F.when(when, F.struct((F.col("p") * 4 + number).alias("record_id"), F.lit(kind).alias("kind"),
                                     at.alias("at"), url.alias("url"), held.alias("headers")))

    p = F.col("p")
    later = F.when(p % 5 == 0, F.lit('"changed"')).otherwise(F.col("tag"))
    all_of = F.array(
        capture(0, "response", p, F.col("url"), {
            "content-type": F.lit("text/html"), "content-length": F.col("size"), "etag": F.col("tag"), "date": p,
            "cache-control": F.concat(F.lit("max-age="), (p % 7 * 600).cast("string"))}, F.lit(True)),
        capture(1, "revisit", p + 5000, F.concat(F.col("url"), F.lit("#again")), {
            "content-length": F.lit("0"), "etag": later, "date": p + 5000, "cache-control": F.lit("max-age=60"),
            "server": F.lit("cache")}, F.lit(True)),
        capture(2, "revisit", p + 9000, F.col("url"), {"date": p + 9000}, p % 2 == 0),
        capture(3, "revisit", p - 100000000, F.col("url"), {"etag": F.col("tag")}, p % 3 == 0))
    return page.select(F.explode(F.filter(all_of, lambda c: c.isNotNull())).alias("c")).select("c.*")
