"""URL filters over dated lists: a temporal (as-of) list join.

List entries are dated events on a pattern (``block`` or ``lift``); a pattern
is a domain, a host, or a host with its first path segment. Events become
validity intervals: of one pattern's events on one day ``block`` wins, and an
event holds until the pattern's next one. A capture is looked up by all
patterns that its URL has, each as of its fetch day, and is blocked if any of
them is blocked on that day; the most specific one is reported.

Intervals are cut at bucket boundaries (``BUCKET_DAYS``) and kept in the
buckets in which captures occur, so the as-of join is an equality join on
(pattern, bucket) that meets at most the few intervals of one bucket, and a capture
of a far day adds its one bucket, not all between. A pattern's intervals are
disjoint, so a capture gets at most one row a pattern. The list is broadcast
only behind a measured size; else adaptive execution may split a hot pattern's
captures, since nothing above the join needs them together. Built-in
expressions only.

A host is in lower case, without user, password, port and a trailing dot; an IP
address has no domain; a domain is the last two labels of the host, or three
where the last two are a public suffix (a parameter).

Defined results: a NULL or unparsable URL or a NULL day matches nothing and is
not blocked; repeated captures are rows of their own; entries with a NULL
pattern or day are ignored; an empty list blocks nothing, empty captures give
an empty result; other columns are not looked at.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from argent.llm.common import landed, table
from argent.operators.joins import fits_broadcast

BUCKET_DAYS = 16
#: Days that the list and the captures of the registered query span.
SPAN_DAYS = 366
FIRST_DAY = "2024-01-01"


#: Public suffixes of two labels, unless the caller has a list of its own.
SUFFIXES = "ac.jp ac.uk co.in co.jp co.kr co.nz co.uk co.za com.ar com.au com.br com.cn com.mx com.tr com.tw gov.uk net.au org.au org.uk".split()


def patterns(url: Column, suffixes: Sequence[str] = SUFFIXES) -> Column:
    """The URL's patterns, least specific first: domain, host, host/segment."""
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    host = F.lower(F.regexp_extract(F.regexp_replace(authority, "^.*@", ""), r"^(\[[^\]]*\]|[^:]*?)\.?(?::[0-9]*)?$", 1))
    two = F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1)
    three = F.regexp_extract(host, r"([^.]+\.[^.]+\.[^.]+)$", 1)
    domain = F.when(host.rlike(r"^([0-9.]+|\[.*)$"), "").when(two.isin(*suffixes), three).otherwise(two)
    segment = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^/?#]+)", 1)
    return F.when(host != "", F.array(
        F.when(domain != "", F.concat(F.lit("domain:"), domain)), F.concat(F.lit("host:"), host),
        F.when(segment != "", F.concat(F.lit("path:"), host, F.lit("/"), segment))))


def intervals(entries: DataFrame) -> DataFrame:
    """(``pattern``, ``since``, ``until``) in which a pattern is blocked, from
    (``pattern``, ``day``, ``block``). ``until`` is NULL for the last event."""
    daily = entries.filter("pattern is not null and day is not null and block is not null") \
        .groupBy("pattern", "day").agg(F.max("block").alias("block"))
    order = Window.partitionBy("pattern").orderBy("day")
    return daily.withColumn("until", F.lead("day").over(order)).filter("block") \
        .select("pattern", F.col("day").alias("since"), "until")


def bucket(day: Column) -> Column:
    return F.floor(F.datediff(day, F.lit(FIRST_DAY).cast("date")) / BUCKET_DAYS).cast("int")


def blocked(captures: DataFrame, entries: DataFrame, id_col: str, url_col: str, day_col: str) -> DataFrame:
    """One row per capture: ``id``, ``day``, ``blocked``, ``pattern`` and
    ``since`` of the most specific entry that was active on its day."""
    seen = landed(captures.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(day_col).alias("day"))
                  .withColumn("row", F.monotonically_increasing_id()), "captures")
    days = seen.where("day is not null").select(bucket(F.col("day")).alias("b")).distinct()
    # one number per 16 days that have a capture, whatever the number of captures
    met = F.from_json(F.lit(json.dumps(sorted(r["b"] for r in days.collect()))), "array<int>")
    first = bucket(F.col("since"))
    last = F.coalesce(bucket(F.date_sub("until", 1)), F.lit(2 ** 31 - 1))
    cut = intervals(entries).select("pattern", "since", "until", first.alias("first"), last.alias("last")).select(
        "pattern", "since", "until", F.explode(F.filter(met, lambda b: b.between(F.col("first"), F.col("last")))).alias("bucket"))
    cut = landed(cut, "intervals")
    keyed = seen.select("row", "day", bucket(F.col("day")).alias("bucket"), F.posexplode(patterns(F.col("url"))).alias("level", "pattern")) \
        .filter("pattern is not null and day is not null")
    active = keyed.join(F.broadcast(cut) if fits_broadcast(cut) else cut, ["pattern", "bucket"]) \
        .filter("since <= day and (until is null or day < until)")
    best = active.groupBy("row").agg(F.max(F.struct("level", "pattern", "since")).alias("hit"))
    return seen.join(best, "row", "left").select(
        "id", "day", F.col("hit").isNotNull().alias("blocked"), F.col("hit.pattern").alias("pattern"),
        F.col("hit.since").alias("since"))


def day_of(number: Column) -> Column:
    return F.date_add(F.lit(FIRST_DAY).cast("date"), F.pmod(number, F.lit(SPAN_DAYS)).cast("int"))


def listed(pages: DataFrame) -> DataFrame:
    """The dated list of the registered query, derived from all pages: each
    page reports one of its patterns on a day of its own."""
    kind = F.pmod(F.col("page_id"), F.lit(5))
    p = patterns(F.col("url"))
    return pages.select(
        F.when(kind <= 1, F.get(p, F.lit(1))).when(kind <= 3, F.get(p, F.lit(0))).otherwise(F.get(p, F.lit(2))).alias("pattern"),
        day_of(F.col("page_id") * 11).alias("day"), kind.isin(0, 2, 4).alias("block"))


def op7_url_filters(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("day", day_of(F.col("page_id") * 37 + 5))
    return blocked(captures, listed(pages), "page_id", "url", "day").select(
        F.col("id").alias("page_id"), F.col("day").cast("string").alias("day"), "blocked", "pattern",
        F.col("since").cast("string").alias("since"))


ORACLE = r"""
WITH a AS (
  SELECT page_id, url, regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '^.*@', '') AS authority FROM pages),
p AS (
  SELECT page_id, lower(regexp_extract(authority, '^(\[[^\]]*\]|[^:]*?)\.?(?::[0-9]*)?$', 1)) AS host,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^/?#]+)', 1) AS segment
  FROM a),
o AS (
  SELECT *, CASE WHEN regexp_matches(host, '^([0-9.]+|\[.*)$') THEN ''
    WHEN regexp_extract(host, '([^.]+\.[^.]+)$', 1) IN (@SUFFIXES) THEN regexp_extract(host, '([^.]+\.[^.]+\.[^.]+)$', 1)
    ELSE regexp_extract(host, '([^.]+\.[^.]+)$', 1) END AS domain
  FROM p),
q AS (
  SELECT page_id, host, CASE WHEN host <> '' THEN 'host:' || host END AS h,
         CASE WHEN host <> '' AND domain <> '' THEN 'domain:' || domain END AS d,
         CASE WHEN host <> '' AND segment <> '' THEN 'path:' || host || '/' || segment END AS s
  FROM o),
e AS (
  SELECT CASE WHEN page_id % 5 <= 1 THEN h WHEN page_id % 5 <= 3 THEN d ELSE s END AS pattern,
         DATE '2024-01-01' + CAST((page_id * 11) % 366 AS INTEGER) AS day, page_id % 5 IN (0, 2, 4) AS block
  FROM q),
daily AS (SELECT pattern, day, max(block) AS block FROM e WHERE pattern IS NOT NULL AND day IS NOT NULL GROUP BY 1, 2),
iv AS (SELECT pattern, day AS since, lead(day) OVER (PARTITION BY pattern ORDER BY day) AS until, block FROM daily),
c AS (
  SELECT page_id, DATE '2024-01-01' + CAST((page_id * 37 + 5) % 366 AS INTEGER) AS day, h, d, s FROM q),
k AS (
  SELECT page_id, day, 0 AS level, d AS pattern FROM c UNION ALL
  SELECT page_id, day, 1, h FROM c UNION ALL SELECT page_id, day, 2, s FROM c),
hit AS (
  SELECT k.page_id, k.pattern, iv.since, row_number() OVER (PARTITION BY k.page_id ORDER BY level DESC) AS r
  FROM k JOIN iv ON k.pattern = iv.pattern AND iv.block AND iv.since <= k.day AND (iv.until IS NULL OR k.day < iv.until))
SELECT c.page_id, CAST(c.day AS VARCHAR) AS day, hit.pattern IS NOT NULL AS blocked, hit.pattern AS pattern,
       CAST(hit.since AS VARCHAR) AS since
FROM c LEFT JOIN hit ON c.page_id = hit.page_id AND hit.r = 1
""".replace("@SUFFIXES", ", ".join(f"'{s}'" for s in SUFFIXES))
