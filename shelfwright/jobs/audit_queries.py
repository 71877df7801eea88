"""Queries of the audits, each with the same in DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwright.jobs import queries
from shelfwright.jobs.queries import _sim, query
from shelfwright.operators import audits as U


@query("a17_distinct_stream_count", ["px_streams"], "SELECT rk AS file_id, count(DISTINCT ordinal) FILTER (ordinal % 5 <> 0) AS streams FROM px_streams GROUP BY 1")
def _(px):
    index = F.when(F.col("ordinal") % 5 == 0, "n/a").otherwise(F.col("ordinal").cast("string"))
    rows = px("px_streams").select(F.col("rk").alias("file_id"), index.alias("index"))
    return U.distinct_stream_count(rows.unionAll(rows))


@query(
    "a18_title_set_crosscheck",
    ["px_titles"],
    """, s AS (SELECT disc, count(DISTINCT title) AS sets FROM px_titles WHERE has_video GROUP BY 1), r AS (SELECT disc, count(DISTINCT title) AS ripped FROM px_titles WHERE title % 6 <> 0 GROUP BY 1)
SELECT disc, sets, coalesce(ripped, 0) AS ripped, CASE WHEN coalesce(ripped, 0) < sets THEN 'REVIEW' ELSE 'ok' END AS verdict FROM s LEFT JOIN r USING (disc)""",
)
def _(px):
    t = px("px_titles")
    return U.title_set_crosscheck(t.where("has_video").select("disc", F.col("title").alias("title_set")), t.where("title % 6 <> 0"))


@query(
    "j7_compare_enumerations",
    ["px_titles"],
    """, a AS (SELECT disc, title AS n, CASE WHEN NOT (disc % 4 = 1 AND title % 11 = 0) THEN sec - CASE WHEN disc % 4 = 2 AND title = 3 THEN 25 ELSE 0 END END AS sec FROM px_titles),
b AS (SELECT disc, title AS n, sec FROM px_titles WHERE NOT (disc % 4 = 3 AND title = 1)),
c AS (SELECT coalesce(x.disc, y.disc) AS disc, coalesce(na, 0) AS na, coalesce(nb, 0) AS nb FROM (SELECT disc, count(*) AS na FROM a WHERE sec IS NOT NULL GROUP BY 1) x FULL JOIN (SELECT disc, count(*) AS nb FROM b GROUP BY 1) y ON x.disc = y.disc),
s AS (SELECT a.disc, count(*) FILTER (a.sec IS NULL OR b.sec - a.sec > 20) AS short FROM a JOIN b ON a.disc = b.disc AND a.n = b.n GROUP BY 1)
SELECT disc, na, nb, coalesce(short, 0) AS short, CASE WHEN na <> nb THEN 'UNRELIABLE' WHEN coalesce(short, 0) > 0 THEN 'USE_OTHER' ELSE 'ok' END AS verdict FROM c LEFT JOIN s USING (disc)""",
)
def _(px):
    t = px("px_titles").withColumnRenamed("title", "n")
    off = F.when((F.col("disc") % 4 == 2) & (F.col("n") == 3), 25).otherwise(0)
    a = t.select("disc", "n", F.when(~((F.col("disc") % 4 == 1) & (F.col("n") % 11 == 0)), F.col("sec") - off).alias("sec"))
    return U.compare_enumerations(a, t.where("not (disc % 4 = 3 and n = 1)").select("disc", "n", "sec"))


@query(
    "j8_longest_vs_shipped",
    ["px_titles"],
    """, t AS (SELECT disc, title, sec, row_number() OVER (PARTITION BY disc ORDER BY sec DESC, title) AS place FROM px_titles), f AS (SELECT disc, max(sec + title % 3 * 20) AS ship FROM px_titles WHERE disc % 5 <> 0 AND title % 2 = 0 GROUP BY 1)
SELECT disc, title, place, round_even((sec - ship) / 60, 1) + 0.0 AS delta, CASE WHEN ship IS NULL THEN 'NOT SHIPPED' WHEN abs(sec - ship) <= 30 THEN 'ok' ELSE 'DIFFERS' END AS verdict FROM t LEFT JOIN f USING (disc) WHERE place <= 3""",
)
def _(px):
    t = px("px_titles")
    return U.longest_vs_shipped(t, t.where("disc % 5 <> 0 and title % 2 = 0").select("disc", (F.col("sec") + F.col("title") % 3 * 20).alias("sec")))


@query(
    "o4_union_after_merge",
    ["px_src", "px_dst"],
    """SELECT rel, 'LOST' AS verdict FROM (SELECT rel FROM px_src WHERE ok % 3 = 0 UNION SELECT rel FROM px_dst) WHERE rel NOT IN (SELECT rel FROM px_dst)
UNION ALL SELECT rel, 'UNEXPECTED' FROM px_dst WHERE rel NOT IN (SELECT rel FROM px_src WHERE ok % 3 = 0 UNION SELECT rel FROM px_dst)""",
)
def _(px):
    return U.union_after_merge(px("px_src").where("ok % 3 = 0"), px("px_dst"), px("px_dst"))


@query(
    "a19_audit_kept",
    ["px_items", "px_candidates"],
    f"""SELECT show_name AS "show", count(*) AS kept, count(*) FILTER (s < 0.3) AS wrong, round_even(count(*) FILTER (s < 0.3) / count(*), 4) AS wrong_rate
FROM (SELECT show_name, greatest({_sim("show_name", "title")}, {_sim("ep_title", "title")}) AS s FROM px_candidates JOIN px_items USING (rk) WHERE provider_rank = 1) GROUP BY 1""",
)
def _(px):
    return U.audit_kept(px("px_candidates").where("provider_rank = 1").select("rk", "title"), px("px_items"))


@query(
    "a20_audit_applied_fixes",
    ["px_log"],
    """SELECT CAST(floor(o / 10) AS INT) AS bin, count(*) AS fixes, count(*) FILTER (abs(abs(a) - 15) < 0.6 OR abs(abs(b) - 15) < 0.6 OR abs(abs(o) - 60) < 3) AS railed
FROM (SELECT event_id % 130 - 65.0 AS o, event_id % 31 - 15.2 AS a, event_id % 29 - 14.7 AS b FROM px_log) GROUP BY 1""",
)
def _(px):
    e = F.col("event_id")
    return U.audit_applied_fixes(px("px_log").select((e % 130 - 65.0).alias("offset"), (e % 31 - 15.2).alias("oa"), (e % 29 - 14.7).alias("ob")))
