"""URL filters by a temporal list join, in DataFrame functions only.

Dated list entries (value added to or removed from a list) become validity intervals. A capture is looked up under its
host, every domain above it and every path prefix of its host, in an as-of join: an entry counts if its interval holds
the capture's fetch time. The longest value that matches decides; allow goes before block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackmill.llm.common import written

_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"


def host(url: Column) -> Column:
    """Lower-case host without user, port and final dot; empty if there is none."""
    return F.regexp_replace(F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), _HOST, 1)), r"\.+$", "")


def domains(name: Column) -> Column:
    """The host and every domain above it, from the longest; none for an empty host."""
    labels = F.split(name, r"\.")
    n = F.size(labels)
    each = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n - i + 1), "."))
    return F.when(name != "", each).otherwise(F.array().cast("array<string>"))


def prefixes(url: Column) -> Column:
    """host/segment, host/segment/segment and so on."""
    parts = F.filter(F.split(F.regexp_extract(F.coalesce(url, F.lit("")), _PATH, 1), "/"), lambda s: s != "")
    name = host(url)
    each = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.concat(name, F.lit("/"), F.array_join(F.slice(parts, 1, i), "/")))
    return F.when((name != "") & (F.size(parts) > 0), each).otherwise(F.array().cast("array<string>"))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """(list, value, valid_from, valid_to) from entries(list, value, listed_at, action).

    An add holds until the next entry of that list and value, whatever it is; valid_to is null if there is none. At
    one time remove counts after add. Entries with a null in any column, or another action, are left out.
    """
    good = entries.where("list IS NOT NULL AND value IS NOT NULL AND listed_at IS NOT NULL AND action IN ('add', 'remove')")
    later = Window.partitionBy("list", "value").orderBy("listed_at", "action")
    found = good.withColumn("valid_to", F.lead("listed_at").over(later)).where("action = 'add'")
    return found.select("list", "value", F.col("listed_at").alias("valid_from"), "valid_to").where("valid_to IS NULL OR valid_from < valid_to")


def filter_urls(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url", time_col: str = "fetched_on") -> DataFrame:
    """One row per row of captures: id_col, host, time_col, n_hits, verdict (block, allow or none), entry.

    entry is the value that decides, null for none. URLs that are null, empty or without a host match nothing, and
    neither does a null time. Rows that repeat are judged each. Other columns of captures are not read.
    """
    intervals = written(validity_intervals(entries), "intervals")
    seen = captures.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(time_col).alias("at"))
    keys = seen.distinct().select("id", "url", "at", F.explode(F.concat(domains(host(F.col("url"))), prefixes(F.col("url")))).alias("value"))
    # both sides are plain exchanges, so that a host with very many captures can be split
    active = keys.join(intervals, "value").where("valid_from <= at AND (valid_to IS NULL OR at < valid_to)")
    rank = F.struct(F.length("value"), (F.col("list") == "allow").cast("int"))
    judged = active.groupBy("id", "url", "at").agg(F.count("*").alias("n_hits"), F.max(F.struct(rank.alias("rank"), "list", "value")).alias("best"))
    judged = written(judged.select(F.col("id").alias("j_id"), F.col("url").alias("j_url"), F.col("at").alias("j_at"), "n_hits", "best"), "judged")
    on = F.col("id").eqNullSafe(F.col("j_id")) & F.col("url").eqNullSafe(F.col("j_url")) & F.col("at").eqNullSafe(F.col("j_at"))
    return seen.join(judged, on, "left").select(
        F.col("id").alias(id_col),
        host(F.col("url")).alias("host"),
        F.col("at").alias(time_col),
        F.coalesce("n_hits", F.lit(0)).cast("long").alias("n_hits"),
        F.coalesce("best.list", F.lit("none")).alias("verdict"),
        F.col("best.value").alias("entry"),
    )


def page_captures(pages: DataFrame) -> DataFrame:
    """Captures of pages with a fetch day spread over 2024 by their number; pages has no such column itself."""
    return pages.select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 360).cast("int")).alias("fetched_on"))


def derived_entries(pages: DataFrame) -> DataFrame:
    """A dated list made of pages' own hosts, domains and first path segments, as a hash of each value has it."""
    values = pages.select(F.explode(F.concat(domains(host(F.col("url"))), F.slice(prefixes(F.col("url")), 1, 1))).alias("value")).distinct()
    values = values.where(F.regexp_count("value", F.lit(r"\.")) >= 2).withColumn("n", F.conv(F.substring(F.md5("value"), 1, 6), 16, 10).cast("int"))

    def entry(when: Column, name: str, day: Column, action: str) -> Column:
        made = F.struct(F.lit(name).alias("list"), F.date_add(F.lit("2024-01-01").cast("date"), day.cast("int")).alias("listed_at"), F.lit(action).alias("action"))
        return F.when(when, made)

    n = F.col("n")
    dated = [
        entry(n % 4 == 0, "block", n % 200, "add"),
        entry(n % 4 == 0, "block", n % 200 + 60, "remove"),
        entry(n % 8 == 0, "block", n % 200 + 120, "add"),
        entry(n % 4 == 1, "block", n % 300, "add"),
        entry(n % 8 == 3, "allow", n % 250, "add"),
    ]
    return values.select("value", F.explode(F.array_compact(F.array(*dated))).alias("e")).select("e.list", "value", "e.listed_at", "e.action")


ORACLE_SQL = rf"""
    WITH u AS (SELECT page_id, url, DATE '2024-01-01' + (page_id % 360)::INTEGER AS fetched_on,
            regexp_replace(lower(regexp_extract(coalesce(url, ''), '{_HOST}', 1)), '\.+$', '') AS host,
            list_filter(string_split(regexp_extract(coalesce(url, ''), '{_PATH}', 1), '/'), lambda s: s <> '') AS parts FROM pages),
    k AS (SELECT page_id, url, fetched_on, host, unnest(list_concat(
            CASE WHEN host <> '' THEN list_transform(range(1, len(string_split(host, '.')) + 1), lambda i: array_to_string(string_split(host, '.')[i:], '.')) ELSE [] END,
            CASE WHEN host <> '' THEN list_transform(range(1, len(parts) + 1), lambda i: host || '/' || array_to_string(parts[1:i], '/')) ELSE [] END)) AS value FROM u),
    v AS (SELECT DISTINCT value FROM (SELECT unnest(list_concat(
            CASE WHEN host <> '' THEN list_transform(range(1, len(string_split(host, '.')) + 1), lambda i: array_to_string(string_split(host, '.')[i:], '.')) ELSE [] END,
            CASE WHEN host <> '' AND len(parts) > 0 THEN [host || '/' || parts[1]] ELSE [] END)) AS value FROM u) WHERE len(value) - len(replace(value, '.', '')) >= 2),
    n AS (SELECT value, ('0x' || substr(md5(value), 1, 6))::INTEGER AS n FROM v),
    e AS (SELECT 'block' AS list, value, n % 200 AS day, 'add' AS action FROM n WHERE n % 4 = 0
        UNION ALL SELECT 'block', value, n % 200 + 60, 'remove' FROM n WHERE n % 4 = 0
        UNION ALL SELECT 'block', value, n % 200 + 120, 'add' FROM n WHERE n % 8 = 0
        UNION ALL SELECT 'block', value, n % 300, 'add' FROM n WHERE n % 4 = 1
        UNION ALL SELECT 'allow', value, n % 250, 'add' FROM n WHERE n % 8 = 3),
    i AS (SELECT list, value, action, DATE '2024-01-01' + day::INTEGER AS f, DATE '2024-01-01' + (lead(day) OVER (PARTITION BY list, value ORDER BY day, action))::INTEGER AS t FROM e),
    h AS (SELECT k.page_id, k.url, k.fetched_on, i.list, i.value FROM k JOIN i ON k.value = i.value AND i.action = 'add' AND i.f <= k.fetched_on AND (i.t IS NULL OR k.fetched_on < i.t)),
    b AS (SELECT page_id, count(*) AS n_hits, arg_max(list, (length(value), (list = 'allow')::INTEGER, list, value)) AS list, arg_max(value, (length(value), (list = 'allow')::INTEGER, list, value)) AS value FROM h GROUP BY page_id)
    SELECT u.page_id, u.host, u.fetched_on, coalesce(b.n_hits, 0) AS n_hits, coalesce(b.list, 'none') AS verdict, b.value AS entry FROM u LEFT JOIN b ON u.page_id = b.page_id
"""
