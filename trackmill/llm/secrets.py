"""Secret scans with multipart credential linking, in DataFrame functions only.

Strong patterns are reported wherever they match. Weak candidates (a bare 40-character key, an endpoint) say little
alone; they are reported only when a complementary part lies within the scope around it: a key by an access identifier,
an endpoint by an access identifier or an assigned secret. Parts meet in an interval join over buckets of positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackmill.llm.common import written

#: kind, pattern, group whose length counts, its least length, its greatest.
STRONG = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, None),
    ("access", r"AKIA[A-Z0-9]{14,}", 0, 18, None),
    ("hex", r"[0-9a-f]{16,}", 0, 16, None),
)
WEAK = (
    ("key", r"[A-Za-z0-9+/]{40,}", 0, 40, 40),
    ("endpoint", r"https?://[A-Za-z0-9._:/-]+", 0, 12, None),
)
#: Which strong kinds a weak kind needs nearby, and how many characters away its start may be.
NEEDS = {"key": ("access",), "endpoint": ("access", "assign")}
SCOPE, BUCKET, RUN = 200, 256, 512

_SPAN = "array<struct<start:int,rank:int,end:int,kind:string>>"


def spans(text: Column, kind: str, rank: int, pattern: str, group: int, least: int, most: int | None) -> Column:
    """The matches of pattern as (start, rank, end, kind) in code points; those of other lengths are left out.

    The text between the matches and the matches alternate, so running sums of their lengths are the positions; the
    sums are taken in runs, then over the runs, which keeps texts with very many matches cheap.
    """
    gaps, whole = F.split(text, pattern), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = whole if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    parts = F.arrays_zip(
        F.slice(F.transform(gaps, F.length), 1, F.size(whole)).alias("gap"), F.transform(whole, F.length).alias("whole"), F.transform(value, F.length).alias("value")
    ).cast("array<struct<gap:int,whole:int,value:int>>")
    runs = F.transform(F.sequence(F.lit(0), F.size(parts), F.lit(RUN)), lambda at: F.slice(parts, at + 1, RUN))
    sums = F.transform(runs, lambda run: F.aggregate(run, F.lit(0), lambda n, x: n + x["gap"] + x["whole"]))
    starts = F.aggregate(
        sums, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), lambda a, n: F.struct((a["at"] + n).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")), lambda a: a["out"]
    )

    def place(run: Column, first: Column) -> Column:
        start = F.struct(first.alias("at"), F.array().cast("array<struct<start:int,end:int,value:int>>").alias("out"))
        here = lambda a, x: F.struct((a["at"] + x["gap"]).alias("start"), (a["at"] + x["gap"] + x["whole"]).alias("end"), x["value"].alias("value"))
        return F.aggregate(run, start, lambda a, x: F.struct((a["at"] + x["gap"] + x["whole"]).alias("at"), F.concat(a["out"], F.array(here(a, x))).alias("out")), lambda a: a["out"])

    placed = F.filter(F.flatten(F.zip_with(runs, starts, place)), lambda x: x["value"].between(least, most or 2**31 - 1))
    made = F.transform(placed, lambda x: F.struct(x["start"], F.lit(rank).alias("rank"), x["end"], F.lit(kind).alias("kind")))
    return F.when(text.rlike(pattern), made.cast(_SPAN)).otherwise(F.array().cast(_SPAN))


def joined(found: Column) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined."""
    return F.array_join(F.transform(F.array_sort(found), lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """One row per row of docs: id_col, found (the strong spans), linked (the weak ones that were linked).

    Spans are (start, rank, end, kind), by start and then kind as listed. Null and empty texts have none. Rows that
    repeat an id and a text have the same spans; null ids are scanned like others. Other columns of docs are not read.
    """
    text = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    strong = [spans(F.col("text"), kind, rank, *rest) for rank, (kind, *rest) in enumerate(STRONG)]
    weak = [spans(F.col("text"), kind, len(STRONG) + rank, *rest) for rank, (kind, *rest) in enumerate(WEAK)]
    parts = text.select("id", F.sha2("text", 256).alias("row"), F.array_sort(F.concat(*strong)).alias("found"), F.concat(*weak).alias("weak"))
    parts = written(parts, "parts")
    # written, so that the join deals both sides anew and can split a text of very many copies
    linked = written(_linked(parts, scope).groupBy("row").agg(F.array_sort(F.collect_set("w")).alias("linked")), "linked")
    out = parts.join(linked, "row", "left")
    return out.select(F.col("id").alias(id_col), "found", F.coalesce("linked", F.array().cast(_SPAN)).alias("linked"))


def _linked(parts: DataFrame, scope: int) -> DataFrame:
    # a text's copies have the same parts
    both = parts.where((F.size("found") > 0) & (F.size("weak") > 0)).select("row", "found", "weak").dropDuplicates(["row"])
    near = both.select("row", F.explode("found").alias("s"))
    allowed = F.when(F.col("w.kind") == "key", F.array(*map(F.lit, NEEDS["key"]))).otherwise(F.array(*map(F.lit, NEEDS["endpoint"])))
    low, high = F.col("s.start") - scope, F.col("s.end") + scope
    near = near.withColumn("bucket", F.explode(F.sequence(F.floor(low / BUCKET), F.floor(high / BUCKET)))).withColumns({"low": low, "high": high})
    near = near.select("row", "bucket", "low", "high", F.col("s.kind").alias("strong"), F.col("s.start").alias("s_start"), F.col("s.end").alias("s_end"))
    weak = both.select("row", F.explode("weak").alias("w")).withColumn("bucket", F.floor(F.col("w.start") / BUCKET)).withColumn("needs", allowed)
    a, b = weak.alias("a"), near.alias("b")
    on = (F.col("a.row") == F.col("b.row")) & (F.col("a.bucket") == F.col("b.bucket"))
    inside = F.col("a.w.start").between(F.col("b.low"), F.col("b.high")) & F.array_contains(F.col("a.needs"), F.col("b.strong"))
    apart = (F.col("a.w.start") >= F.col("b.s_end")) | (F.col("a.w.end") <= F.col("b.s_start"))
    return a.join(b, on & inside & apart, "left_semi").select("row", "w")


def _of_kind(kind: str) -> Column:
    return F.filter("found", lambda x: x["kind"] == kind)


def secret_digest(docs: DataFrame) -> DataFrame:
    """The digest of scan_secrets: counts by kind, the hash of the strong spans, and all spans."""
    found = scan_secrets(docs)
    counts = [F.size(_of_kind(kind)).cast("long").alias(f"n_{kind}") for kind, *_ in STRONG]
    return found.select("doc_id", *counts, F.sha2(joined(F.col("found")), 256).alias("base_sha256"), joined(F.concat("found", "linked")).alias("spans"))


def _sql_spans(kind: str, rank: int, pattern: str, group: int, least: int, most: int | None) -> str:
    p = pattern.replace("'", "''")
    return f"""
        SELECT doc_id, rid, '{kind}' AS kind, {rank} AS rank, v,
            (coalesce(list_sum(list_transform(g[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(w[1:i - 1], lambda x: length(x))), 0))::BIGINT AS a, length(w[i]) AS n
        FROM (SELECT doc_id, rid, g, w, unnest(generate_series(1, len(w))) AS i, unnest(v) AS v
            FROM (SELECT doc_id, rid, string_split_regex(t, '{p}') AS g, regexp_extract_all(t, '{p}', 0) AS w, regexp_extract_all(t, '{p}', {group}) AS v FROM d))
        WHERE length(v) BETWEEN {least} AND {most or 2**31 - 1}"""


_NEEDED = " OR ".join(f"(w.kind = '{kind}' AND s.kind IN ({', '.join(repr(n) for n in needs)}))" for kind, needs in NEEDS.items())
ORACLE_SQL = f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS rid FROM documents),
    s AS ({" UNION ALL ".join(_sql_spans(kind, i, *rest) for i, (kind, *rest) in enumerate(STRONG))}),
    w AS ({" UNION ALL ".join(_sql_spans(kind, len(STRONG) + i, *rest) for i, (kind, *rest) in enumerate(WEAK))}),
    l AS (SELECT * FROM w WHERE EXISTS (SELECT 1 FROM s WHERE s.rid = w.rid AND w.a BETWEEN s.a - {SCOPE} AND s.a + s.n + {SCOPE} AND (w.a >= s.a + s.n OR w.a + w.n <= s.a) AND ({_NEEDED}))),
    x AS (SELECT rid, kind, rank, a, kind || ':' || a || ':' || (a + n) AS said, rank < {len(STRONG)} AS base FROM (SELECT * FROM s UNION ALL SELECT * FROM l))
    SELECT d.doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
        sha256(coalesce(string_agg(said, ',' ORDER BY a, rank) FILTER (base), '')) AS base_sha256, coalesce(string_agg(said, ',' ORDER BY a, rank), '') AS spans
    FROM d LEFT JOIN x ON d.rid = x.rid GROUP BY d.rid, d.doc_id
"""
