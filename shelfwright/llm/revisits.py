"""Not-modified revisits of a web archive, resolved by an as-of join on the canonical address.

A revisit (status 304) stands for the latest earlier full response (status 200) of its canonical address. If their
validators agree - the entity tag, compared weakly, or without one the time of last change - the response's headers are
updated with those of the revisit that a 304 may update.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwright.session import stored

#: Headers of a 304 that never replace the stored ones.
KEPT_HEADERS = ["connection", "content-encoding", "content-length", "content-md5", "content-range", "content-type", "keep-alive", "te", "trailer", "transfer-encoding", "upgrade"]


def canonical(url: Column) -> Column:
    """Scheme and host in small letters, no scheme, default port, leading www., fragment or empty query; query sorted."""
    bare = F.regexp_replace(F.coalesce(url, F.lit("")), r"#.*$", "")
    host = F.lower(F.regexp_extract(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^www\.", "")
    rest = F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*", "")
    path = F.regexp_replace(rest, r"\?.*$", "")
    asked = F.regexp_extract(rest, r"\?(.*)$", 1)
    asked = F.array_join(F.array_sort(F.filter(F.split(asked, "&", -1), lambda x: x != "")), "&")
    return F.concat(host, F.when(path == "", "/").otherwise(path), F.when(asked == "", "").otherwise(F.concat(F.lit("?"), asked)))


def _tag(headers: Column) -> Column:
    return F.regexp_replace(F.element_at(headers, "etag"), r"^W/", "")


def merged_headers(stored_headers: Column, revisit: Column) -> Column:
    """The stored headers, replaced or extended by those of the revisit that may be updated."""
    new = F.map_filter(revisit, lambda k, v: ~k.isin(KEPT_HEADERS))
    old = F.map_filter(stored_headers, lambda k, v: ~F.map_contains_key(new, k))
    return F.map_concat(old, new)


def _small(headers: Column) -> Column:
    """The headers with names in small letters; of names that differ only in that, the value of the first in order of name."""
    entries = F.array_sort(F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("k"), e["key"].alias("said"), e["value"].alias("value"))))
    first = F.filter(entries, lambda e, i: (i == 0) | (F.get(entries, i - 1)["k"] != e["k"]))
    return F.map_from_entries(F.transform(first, lambda e: F.struct(e["k"], e["value"])))


def resolved(captures: DataFrame, per_part: int = 4096) -> DataFrame:
    """(rec_id, uri, ts, full_id, verdict, headers) for each revisit of captures (rec_id, url, ts, status, headers).

    verdict: resolved; mismatch (the validators differ); unverified (either side has none); orphan (no full response
    before). Among full responses of one time the one with the largest rec_id counts; a revisit of the same time comes
    after it. headers are merged where resolved, else the revisit's own, with names in small letters (names are compared
    in any case); null headers are none. A revisit without a time is an orphan, a full response without a time or any
    other status is not looked at. A null url is the empty address. Repeated rows give repeated answers, an empty table none.

    Of each address only its different times are put in order, each with its one response that counts, and those are cut
    into runs of time of about per_part; the last response of a run is carried over to later runs. Revisits then meet
    their time by an equality join. So no task gets all captures of an address, or of an instant, that many have.
    """
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    rows = captures.select("rec_id", canonical(F.col("url")).alias("uri"), F.col("ts").cast("long").alias("ts"), "status", F.coalesce(_small(F.col("headers")), none).alias("headers")).where(F.col("status").isin(200, 304))
    rows = stored(rows, "captures")
    timed = rows.where("ts is not null")
    full = F.when(F.col("status") == 200, F.struct(F.col("rec_id").alias("full_id"), F.col("headers").alias("full_headers")))
    times = stored(timed.groupBy("uri", "ts").agg(F.max_by(full, F.when(F.col("status") == 200, F.col("rec_id"))).alias("full"), F.bool_or(F.col("status") == 304).alias("asked")), "times")
    # Runs: an address with n times gets about n / per_part of them, of equal width.
    span = times.groupBy("uri").agg(F.min("ts").alias("t0"), F.max("ts").alias("t1"), F.count("*").alias("n"))
    runs = F.greatest(F.lit(1), F.ceil(F.col("n") / per_part)).cast("long")
    width = F.greatest(F.lit(1), F.ceil((F.col("t1") - F.col("t0") + 1) / runs)).cast("long")
    cut = times.join(span, "uri").withColumn("run", F.floor((F.col("ts") - F.col("t0")) / width).cast("long"))
    inside = cut.withColumn("near", F.last("full", ignorenulls=True).over(Window.partitionBy("uri", "run").orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)))
    ends = cut.groupBy("uri", "run").agg(F.max_by("full", F.when(F.col("full").isNotNull(), F.col("ts"))).alias("end"))
    carried = ends.withColumn("before", F.last("end", ignorenulls=True).over(Window.partitionBy("uri").orderBy("run").rowsBetween(Window.unboundedPreceding, -1))).select("uri", "run", "before")
    found = inside.where("asked").join(carried, ["uri", "run"], "left").select("uri", "ts", F.coalesce("near", "before").alias("full"))
    met = timed.where("status = 304").join(found, ["uri", "ts"]).select("rec_id", "uri", "ts", "headers", "full")
    late = rows.where("ts is null and status = 304").select("rec_id", "uri", "ts", "headers", F.lit(None).cast(met.schema["full"].dataType).alias("full"))
    met = met.unionByName(late)
    old, own = F.col("full.full_headers"), F.col("headers")
    mine, theirs = _tag(own), _tag(old)
    mine2, theirs2 = F.element_at(own, "last-modified"), F.element_at(old, "last-modified")
    same = F.when(mine.isNotNull() & theirs.isNotNull(), mine == theirs).when(mine2.isNotNull() & theirs2.isNotNull(), mine2 == theirs2)
    verdict = F.when(F.col("full").isNull(), "orphan").when(same, "resolved").when(~same, "mismatch").otherwise("unverified")
    out = met.withColumn("verdict", verdict)
    return out.select("rec_id", "uri", "ts", F.col("full.full_id").alias("full_id"), "verdict", F.when(F.col("verdict") == "resolved", merged_headers(old, own)).otherwise(own).alias("headers"))


def said(headers: Column) -> Column:
    """name: value of every header, sorted, as lines."""
    return F.array_join(F.array_sort(F.transform(F.map_entries(headers), lambda e: F.concat_ws(": ", e["key"], e["value"]))), "\n")


#: The captures that a crawl of `pages` leaves: each page in full, and two revisits of it later on, the second one of
#: which may carry the tag of another version. Addresses are those of the pages' sites and their first path part.
_CAPTURES = """
SELECT page_id * 10 AS rec_id, url, page_id % 1000 * 60 AS ts, 200 AS status, md5(coalesce(html, '')) AS tag, page_id AS n, CAST(length(coalesce(html, '')) AS STRING) AS size FROM pages
UNION ALL SELECT page_id * 10 + 1, url, page_id % 1000 * 60 + 7200, 304, md5(coalesce(html, '')), page_id, '0' FROM pages WHERE page_id % 2 = 0
UNION ALL SELECT page_id * 10 + 2, url, page_id % 1000 * 60 + 100000, 304, CASE WHEN page_id % 3 = 0 THEN 'old' ELSE md5(coalesce(html, '')) END, page_id, '0' FROM pages WHERE page_id % 5 < 3
"""


def captures_of(pages: DataFrame) -> DataFrame:
    """Captures of a pages table: urls are cut to their site and first path part, so that one address has many."""
    site = pages.withColumn("url", F.concat(F.regexp_extract("url", r"^([a-zA-Z]+://[^/]*/[^/?#]*)", 1), F.concat(F.lit("/?b="), F.col("page_id") % 7, F.lit("&a=1#f"))))
    raw = site.sparkSession.sql(_CAPTURES.replace("FROM pages", "FROM {p}"), p=site)
    tag = F.when(F.col("n") % 11 != 0, F.concat(F.when(F.col("status") == 304, "W/").otherwise(""), F.col("tag")))
    pairs = F.array(
        F.struct(F.lit("etag").alias("k"), tag.alias("v")),
        F.struct(F.lit("last-modified").alias("k"), F.when(F.col("n") % 4 != 1, F.concat(F.lit("day "), F.col("n") % 3)).alias("v")),
        F.struct(F.lit("content-length").alias("k"), F.col("size").alias("v")),
        F.struct(F.lit("date").alias("k"), F.col("ts").cast("string").alias("v")),
    )
    headers = F.map_from_entries(F.filter(pairs, lambda x: x["v"].isNotNull()))
    return raw.select("rec_id", "url", "ts", "status", headers.alias("headers"))


def query(spark, sf_dir: str) -> DataFrame:
    """op7: every revisit that a crawl of the pages leaves, with the response it stands for."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    out = resolved(captures_of(pages))
    return out.select("rec_id", "uri", "ts", "full_id", "verdict", said(F.col("headers")).alias("headers"))


ORACLE_SQL = rf"""
WITH site AS (SELECT page_id, regexp_extract(url, '^([a-zA-Z]+://[^/]*/[^/?#]*)', 1) AS url, html FROM pages),
c AS ({_CAPTURES.replace("FROM pages", "FROM site").replace("STRING", "VARCHAR")}),
h AS (SELECT rec_id, ts, status, n, regexp_replace(regexp_replace(lower(regexp_extract(url, '^[a-zA-Z]+://([^/]*)', 1)), ':(80|443)$', ''), '^www\.', '')
    || regexp_replace(url, '^[a-zA-Z]+://[^/]*', '') || '/?a=1&b=' || (n % 7) AS uri,
    CASE WHEN n % 11 <> 0 THEN tag END AS tag, CASE WHEN n % 4 <> 1 THEN 'day ' || (n % 3) END AS modified, size FROM c),
j AS (SELECT r.*, f.rec_id AS full_id, f.tag AS ftag, f.modified AS fmod, f.size AS fsize FROM h r
    LEFT JOIN LATERAL (SELECT * FROM h f WHERE f.uri = r.uri AND f.status = 200 AND f.ts <= r.ts ORDER BY f.ts DESC, f.rec_id DESC LIMIT 1) f ON true WHERE r.status = 304),
v AS (SELECT *, CASE WHEN full_id IS NULL THEN 'orphan'
    WHEN tag IS NOT NULL AND ftag IS NOT NULL THEN CASE WHEN tag = ftag THEN 'resolved' ELSE 'mismatch' END
    WHEN modified IS NOT NULL AND fmod IS NOT NULL THEN CASE WHEN modified = fmod THEN 'resolved' ELSE 'mismatch' END ELSE 'unverified' END AS verdict FROM j)
SELECT rec_id, uri, ts, full_id, verdict, concat_ws(chr(10),
    'content-length: ' || CASE WHEN verdict = 'resolved' THEN fsize ELSE size END, 'date: ' || ts,
    'etag: ' || CASE WHEN tag IS NOT NULL THEN 'W/' || tag WHEN verdict = 'resolved' THEN ftag END,
    'last-modified: ' || CASE WHEN modified IS NOT NULL THEN modified WHEN verdict = 'resolved' THEN fmod END) AS headers FROM v
"""
