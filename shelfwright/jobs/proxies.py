"""Portable SQL views of the driver's tables that stand for the library's own tables.

Each is text that Spark and DuckDB both run; a query names the views it needs, and both engines get them as WITH parts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["lineitem", "part", "orders", "events", "documents", "conversations"]

VIEWS = {
    "px_titles": """SELECT disc, title, CAST(CASE WHEN q = 1 THEN 273.0 WHEN q = 2 THEN 8.0 WHEN q = 3 THEN 4000.0 + ln ELSE 1200.0 + floor(pr * 100) % 1800 END AS DOUBLE) AS sec,
  tax < 0.08 AS has_video, CAST(ln % 4 AS INT) AS audio, (fl = 'R' AND st = 'F') AS phantom, CAST(pk % 9 AS INT) AS md5_no, sup, pk
FROM (SELECT CAST(floor(l_orderkey / 8) AS BIGINT) AS disc, CAST(row_number() OVER (PARTITION BY CAST(floor(l_orderkey / 8) AS BIGINT) ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate) AS INT) AS title,
  l_quantity AS q, l_extendedprice AS pr, l_linenumber AS ln, l_tax AS tax, l_returnflag AS fl, l_linestatus AS st, l_partkey AS pk, l_suppkey AS sup FROM lineitem) t""",
    "px_dispositions": """SELECT disc, title, CASE title % 4 WHEN 0 THEN 'exclude' WHEN 1 THEN 'encode' WHEN 2 THEN 'extra' ELSE 'exclude' END AS kind,
  CASE title % 5 WHEN 0 THEN 'short' WHEN 1 THEN 'n/a' WHEN 2 THEN 'Duplicate.' ELSE 'identified as the studio logo reel' END AS note FROM px_titles WHERE title % 7 <> 3""",
    "px_items": """SELECT p_partkey AS rk, p_name AS show_name, CAST(p_size % 5 AS INT) AS season, CAST(p_partkey % 20 AS INT) AS ep,
  CASE WHEN p_partkey % 9 = 0 THEN 'Episode 7' ELSE p_type END AS ep_title, 1200.0 + p_retailprice AS duration FROM part""",
    "px_streams": """SELECT rk, ordinal, CASE ln % 3 WHEN 0 THEN 3 WHEN 1 THEN 2 ELSE 1 END AS stream_type, CASE WHEN fl = 'A' THEN 'srt' WHEN fl = 'N' THEN 'pgs' ELSE 'ass' END AS codec,
  CASE WHEN sp % 3 = 0 THEN 'eng' WHEN sp % 3 = 1 THEN 'en' ELSE 'deu' END AS language_code, st = 'F' AS forced, q AS cues, ln AS channel
FROM (SELECT l_partkey AS rk, CAST(row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_quantity, l_shipdate) AS INT) AS ordinal,
  l_linenumber AS ln, l_returnflag AS fl, l_linestatus AS st, l_suppkey AS sp, l_quantity AS q FROM lineitem) t""",
    "px_media": """SELECT rk, ordinal, stream_type, codec, cues, CASE ordinal % 4 WHEN 1 THEN NULL WHEN 2 THEN upper(language_code) WHEN 3 THEN '' ELSE language_code END AS language_code,
  CASE language_code WHEN 'deu' THEN 'Deutsch' ELSE 'English' END AS language, CASE WHEN ordinal % 3 = 0 AND NOT forced THEN NULL ELSE forced END AS forced FROM px_streams""",
    "px_candidates": """SELECT c.rk, c.cand_id, c.provider_rank, CASE WHEN c.m = 0 THEN 'Audio Commentary' ELSE replace(p.p_name, ' ', '.') END || '.S0' || (p.p_size % 5) || 'E' || (p.p_partkey % 20) || '.' || replace(p.p_type, ' ', '.') || '.1080p.BluRay' AS title,
  c.fmt AS format, c.score FROM (SELECT l_partkey AS rk, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_quantity, l_shipdate) AS provider_rank,
    l_orderkey AS cand_id, l_suppkey % 11 AS m, CASE WHEN l_returnflag = 'N' THEN 'ass' ELSE 'srt' END AS fmt, CAST(floor(l_extendedprice) AS BIGINT) AS score,
    CASE WHEN l_linenumber % 2 = 0 THEN l_partkey ELSE (l_partkey * 7 + 3) % (SELECT max(p_partkey) + 1 FROM part) END AS of FROM lineitem) c JOIN part p ON p.p_partkey = c.of""",
    "px_packets": """SELECT user_id AS file_id, 0 AS track, pts FROM (SELECT user_id, event_type, 0.032 * row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pts FROM events) t
WHERE NOT (user_id % 3 = 0 AND event_type = 'error')""",
    "px_hashes": """SELECT l_suppkey AS file_id, l_linenumber % 2 AS track, l_orderkey % 40 AS offset_s, min(md5(CASE WHEN l_suppkey % 3 = 0 THEN CAST(l_orderkey % 40 AS STRING) ELSE CAST(l_partkey AS STRING) END)) AS h
FROM lineitem GROUP BY 1, 2, 3""",
    "px_src": """SELECT l_returnflag AS kind, l_suppkey AS work, l_suppkey || '/' || row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity, l_shipdate) AS rel,
  CAST(floor(l_extendedprice * 1000) AS BIGINT) AS bytes, l_shipdate AS created, l_orderkey AS ok FROM lineitem""",
    "px_dst": """SELECT kind, work, rel, CASE WHEN ok % 17 = 0 THEN bytes - 1 ELSE bytes END AS bytes FROM px_src WHERE ok % 13 <> 0""",
    "px_agent": """SELECT p_brand AS show_name, CAST(1 + p_size % 5 AS INT) AS season, CAST(p_partkey % 30 AS INT) AS idx, p_partkey AS rk, p_name AS title, p_partkey % 6 AS m FROM part""",
    "px_files": """SELECT rk, season, idx, CASE m WHEN 0 THEN 'Show S0' || season || 'E' || idx || ' - ' || title || '.mkv' WHEN 1 THEN 'Show S0' || season || 'E' || idx || ' - ' || upper(title) || '!.mkv'
  WHEN 2 THEN 'Show S0' || season || 'E' || idx || '-E' || (idx + 1) || '.mkv' WHEN 3 THEN 'Show S0' || season || 'E' || idx || ' - Some other thing.mkv' WHEN 4 THEN 'Show S0' || season || 'E' || idx || '.mkv' ELSE NULL END AS file FROM px_agent""",
    "px_canon": """SELECT o_custkey AS show_name, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS INT) AS idx, CAST((200 + CAST(floor(o_totalprice) AS BIGINT) % 400) / 10.0 AS DOUBLE) AS mins, o_orderkey AS ok FROM orders""",
    "px_log": """SELECT event_id, ts, user_id AS rk, CASE WHEN event_type = 'error' THEN 'search_fail' ELSE event_type END AS event FROM events""",
    "px_cues": """SELECT doc_id AS file_id, n_chars, text FROM documents""",
}


def register(spark: SparkSession, sf_dir: str) -> None:
    for t in TABLES:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)


def with_parts(names: list[str], kind: str = "") -> str:
    """WITH parts for the views and those they are made from; kind: what stands behind AS."""
    wanted: list[str] = []

    def add(name: str) -> None:
        for other in VIEWS:
            if other != name and other in VIEWS[name]:
                add(other)
        if name not in wanted:
            wanted.append(name)

    for n in names:
        add(n)
    return ",\n".join(f"{n} AS {kind}({VIEWS[n]})" for n in wanted)


def view(spark: SparkSession, name: str) -> DataFrame:
    """A proxy over the tables that register() named."""
    df = spark.sql(f"WITH {with_parts([name])} SELECT * FROM {name}")
    return df.withColumnRenamed("show_name", "show")  # a word that DuckDB keeps for itself
