"""Resolution of not-modified revisit records of a web archive.

A revisit record (a 304 answer) holds no body: it stands for the latest earlier
full response of the same canonical URL.  The as-of join finds that response,
its validators are checked against those of the revisit, and the headers that
a 304 answer may update are merged into the stored ones.

Scale: captures are dealt by range over (URL, time, record), so a URL with a
third of all captures fills many partitions and is never in one task; the last
full response of a URL in each partition carries over to the next ones (a
window over one row per URL and partition).  Bodies are not shuffled, only
their digests; ``with_bodies`` joins them by record when they are wanted.

Defined results: a record without URL is resolved to nothing (``no_original``);
captures of one time are ordered by record id; records that repeat are resolved
each; a NULL time comes before all others; header names are compared in lower
case; NULL headers are none; a revisit without validators cannot be checked and
is a ``mismatch``; full responses are returned as ``full`` with their own
headers; any other record is ``other``; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import checkpoint

# Header fields that a 304 answer carries to update a stored response (RFC 9110, 15.4.5).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary", "last-modified")
# Query parameters that name where a visitor came from, not a resource.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=.*)?$"


def canonical_url(url: Column) -> Column:
    """Host (lower case, no ``www.`` or default port), path without closing slashes, sorted query without tracking; no scheme or fragment."""
    rest = F.regexp_replace(F.trim(url), r"#.*$", "")
    rest = F.regexp_replace(rest, r"^[A-Za-z][A-Za-z0-9+.\-]*://", "")
    host = F.lower(F.regexp_extract(rest, r"^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.split(F.regexp_extract(rest, r"^[^?]*\?(.*)$", 1), "&")
    kept = F.array_sort(F.filter(query, lambda p: (p != "") & ~p.rlike(TRACKING)))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def lower_names(headers: Column) -> Column:
    """Headers with lower-case names; of names that then agree the last value in name order counts."""
    entries = F.array_sort(F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>"))))
    names = F.array_distinct(F.transform(entries, lambda e: F.lower(e["key"])))
    value = lambda n: F.element_at(F.filter(entries, lambda e: F.lower(e["key"]) == n), -1)["value"]
    return F.map_from_arrays(names, F.transform(names, value))


def _entity_tag(tag: Column) -> Column:
    """Weak comparison: the tag without its weakness mark."""
    return F.regexp_replace(tag, r"^W/", "")


def resolve(records: DataFrame) -> DataFrame:
    """Adds the stored response to every record.

    ``records``: ``record_id`` (long), ``url``, ``captured`` (ordered type),
    ``status`` (int) and ``headers`` (map of strings).  Returns ``record_id``,
    ``canonical_url``, ``outcome`` (``full``, ``resolved``, ``mismatch``,
    ``no_original``, ``other``), ``original_id`` and the effective ``headers``.
    """
    spark = records.sparkSession
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = records.select("record_id", canonical_url(F.col("url")).alias("canonical_url"), "captured", "status", lower_names(F.col("headers")).alias("headers"))
    rows = rows.withColumn("_key", F.coalesce("canonical_url", F.concat(F.lit("#"), F.coalesce(F.col("record_id").cast("string"), F.lit("")))))
    order = ("_key", "captured", "record_id")
    dealt = rows.repartitionByRange(n_parts, *order, F.xxhash64("status")).withColumn("_part", F.spark_partition_id())
    dealt = checkpoint(dealt)  # the partition numbers must not change between the two uses below
    full = F.when((F.col("status") == 200) & F.col("canonical_url").isNotNull(), F.struct("record_id", "headers"))
    here = Window.partitionBy("_part", "_key").orderBy("captured", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    own = dealt.withColumn("_own", F.last(full, ignorenulls=True).over(here))
    ends = dealt.where(full.isNotNull()).groupBy("_part", "_key").agg(F.max_by(full, F.struct("captured", "record_id")).alias("_end"))
    # every partition that a URL fills: one row each
    filled = dealt.groupBy("_part", "_key").agg(F.lit(1).alias("_one")).join(ends, ["_part", "_key"], "left")
    before = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = filled.withColumn("_carried", F.last("_end", ignorenulls=True).over(before)).where(F.col("_carried").isNotNull())
    carried = carried.select(F.col("_part").alias("_p"), F.col("_key").alias("_k"), "_carried")
    d = own.join(carried, (F.col("_part") == F.col("_p")) & (F.col("_key") == F.col("_k")), "left")
    d = d.withColumn("_o", F.coalesce("_own", "_carried"))
    tag, old_tag = F.col("headers")["etag"], F.col("_o.headers")["etag"]
    date, old_date = F.col("headers")["last-modified"], F.col("_o.headers")["last-modified"]
    same = F.when(tag.isNotNull(), F.coalesce(_entity_tag(tag) == _entity_tag(old_tag), F.lit(False))).otherwise(F.coalesce(date == old_date, F.lit(False)))
    revisit = F.col("status") == 304
    outcome = (
        F.when(F.col("status") == 200, "full")
        .when(revisit & F.col("_o").isNull(), "no_original")
        .when(revisit & same, "resolved")
        .when(revisit, "mismatch")
        .otherwise("other")
    )
    d = d.withColumn("outcome", outcome)
    allowed = F.map_filter("headers", lambda k, v: k.isin(*PERMITTED))
    stored = F.map_filter(F.col("_o.headers"), lambda k, v: ~F.map_contains_key(allowed, k))
    merged = F.when(F.col("outcome") == "resolved", F.map_concat(stored, allowed)).otherwise(F.col("headers"))
    original = F.when(F.col("outcome").isin("resolved", "mismatch"), F.col("_o.record_id")).when(F.col("outcome") == "full", F.col("record_id"))
    return d.select("record_id", "canonical_url", "outcome", original.alias("original_id"), merged.alias("headers"))


def with_bodies(resolved: DataFrame, records: DataFrame) -> DataFrame:
    """Resolved and full records with the body of their stored response (``records`` has ``record_id`` and ``body``)."""
    bodies = records.where(F.col("status") == 200).select(F.col("record_id").alias("_stored"), "body")
    good = resolved.where(F.col("outcome").isin("full", "resolved"))
    return good.join(bodies, F.col("original_id") == F.col("_stored")).drop("_stored")


def header_text(headers: Column) -> Column:
    """Header lines in the order of their names."""
    return F.array_join(F.array_sort(F.transform(F.map_entries(headers), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))), "\n")


def captures_of_pages(pages: DataFrame) -> DataFrame:
    """A capture log of the whole ``pages`` table.

    Page ``p`` is fetched at hour ``p`` (the full response) and revisited five
    hours later.  Every fifth revisit answers for a body that has changed, every
    seventh has a date validator only, and every third tag is weak.  A NULL
    ``page_id`` is time and record -1.
    """
    p = F.coalesce("page_id", F.lit(-1)).cast("long")
    digest = F.md5(F.coalesce("html", F.lit("")).cast("binary"))
    tag = F.concat(F.lit('"'), F.substring(digest, 1, 16), F.lit('"'))
    modified = F.concat(F.lit("day "), F.floor(p / 24).cast("string"))
    common = pages.select(p.alias("p"), "url", digest.alias("digest"), tag.alias("tag"), modified.alias("modified"), F.length("html").alias("size"))
    response = common.select(
        (F.col("p") * 2).alias("record_id"), "url", F.col("p").alias("captured"), F.lit(200).alias("status"),
        F.create_map(
            F.lit("Content-Type"), F.lit("text/html"), F.lit("Content-Length"), F.coalesce(F.col("size"), F.lit(0)).cast("string"), F.lit("ETag"), F.col("tag"),
            F.lit("Last-Modified"), F.col("modified"), F.lit("Date"), F.concat(F.lit("hour "), F.col("p").cast("string")),
        ).alias("headers"),
    )
    changed = F.when(F.col("p") % 5 == 0, F.lit('"changed"')).when(F.col("p") % 3 == 0, F.concat(F.lit("W/"), F.col("tag"))).otherwise(F.col("tag"))
    always = F.create_map(
        F.lit("Content-Length"), F.lit("0"), F.lit("Cache-Control"), F.lit("max-age=60"), F.lit("Last-Modified"), F.col("modified"),
        F.lit("Date"), F.concat(F.lit("hour "), (F.col("p") + 5).cast("string")),
    )
    headers = F.when(F.col("p") % 7 == 0, always).otherwise(F.map_concat(always, F.create_map(F.lit("ETag"), changed)))
    again = common.select((F.col("p") * 2 + 1).alias("record_id"), "url", (F.col("p") + 5).alias("captured"), F.lit(304).alias("status"), headers.alias("headers"))
    return response.unionByName(again)


def resolve_pages(pages: DataFrame) -> DataFrame:
    """``(record_id, canonical_url, outcome, original_id, header_lines)`` of the capture log of ``pages``."""
    return resolve(captures_of_pages(pages)).select("record_id", "canonical_url", "outcome", "original_id", header_text(F.col("headers")).alias("header_lines"))


ORACLE_SQL = r"""
WITH base AS (
  SELECT coalesce(page_id, -1)::BIGINT AS p, url, '"' || substr(md5(coalesce(html, '')), 1, 16) || '"' AS tag,
         'day ' || floor(coalesce(page_id, -1) / 24.0)::BIGINT AS modified, coalesce(length(html), 0) AS size,
         regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.\-]*://', '') AS rest
  FROM pages),
parts AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(rest, '^([^/?]*)', 1)), '^www\.', ''), ':(80|443)$', '')
         || regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '') AS start,
         list_sort(list_filter(string_split(regexp_extract(rest, '^[^?]*\?(.*)$', 1), '&'),
           lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|ref|fbclid|gclid)(=.*)?$'))) AS q
  FROM base),
page AS (
  SELECT *, start || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS canonical_url FROM parts),
rec AS (
  SELECT p * 2 AS record_id, canonical_url, p AS captured, 200 AS status, tag, modified,
         ['content-type: text/html', 'content-length: ' || size, 'etag: ' || tag, 'last-modified: ' || modified, 'date: hour ' || p] AS headers
  FROM page
  UNION ALL
  SELECT p * 2 + 1, canonical_url, p + 5, 304,
         CASE WHEN p % 7 = 0 THEN NULL WHEN p % 5 = 0 THEN '"changed"' WHEN p % 3 = 0 THEN 'W/' || tag ELSE tag END, modified,
         list_concat(['content-length: 0', 'cache-control: max-age=60', 'last-modified: ' || modified, 'date: hour ' || (p + 5)],
           CASE WHEN p % 7 = 0 THEN [] ELSE ['etag: ' || CASE WHEN p % 5 = 0 THEN '"changed"' WHEN p % 3 = 0 THEN 'W/' || tag ELSE tag END] END)
  FROM page),
joined AS (
  SELECT *, last_value(CASE WHEN status = 200 AND canonical_url IS NOT NULL
                            THEN {'id': record_id, 'tag': tag, 'modified': modified, 'headers': headers} END IGNORE NULLS)
    OVER (PARTITION BY coalesce(canonical_url, '#' || record_id) ORDER BY captured, record_id
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS o
  FROM rec),
judged AS (
  SELECT *, CASE WHEN status = 200 THEN 'full' WHEN o IS NULL THEN 'no_original'
    WHEN CASE WHEN tag IS NOT NULL THEN regexp_replace(tag, '^W/', '') = o.tag ELSE modified = o.modified END THEN 'resolved'
    ELSE 'mismatch' END AS outcome
  FROM joined)
SELECT record_id, canonical_url, outcome,
  CASE WHEN outcome = 'full' THEN record_id WHEN outcome <> 'no_original' THEN o.id END AS original_id,
  array_to_string(list_sort(CASE WHEN outcome = 'resolved' THEN
    list_concat(
      list_filter(o.headers, lambda h: split_part(h, ': ', 1) NOT IN ('cache-control', 'date', 'last-modified')
                             AND (tag IS NULL OR split_part(h, ': ', 1) <> 'etag')),
      list_filter(headers, lambda h: split_part(h, ': ', 1) <> 'content-length'))
    ELSE headers END), chr(10)) AS header_lines
FROM judged
"""
