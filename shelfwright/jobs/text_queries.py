"""Queries of the text functions and byte decoding, each with the same in DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwright.functions import text as T
from shelfwright.jobs.queries import _CUES, _NOISE, _STOP, _cues, _sig, _sim, query

_content = rf"list_filter({_sig('title')}, lambda w: w NOT IN ({_NOISE}) AND NOT regexp_full_match(w, '\d{{3,4}}') AND NOT regexp_full_match(w, '[\dhms_.]+'))"


@query("t2_content_words", ["px_candidates"], f"SELECT rk, provider_rank, array_to_string({_sig('title')}, ' ') AS sig, array_to_string({_content}, ' ') AS content FROM px_candidates")
def _(px):
    join = lambda c: F.array_join(c, " ")
    return px("px_candidates").select("rk", "provider_rank", join(T.sig_words(F.col("title"))).alias("sig"), join(T.content_words(F.col("title"))).alias("content"))


_TITLES = """SELECT p_partkey AS rk, CASE p_partkey % 5 WHEN 0 THEN 'Episode ' || p_size WHEN 1 THEN 'Disc ' || p_size || ' of the Extended Cut' WHEN 2 THEN p_name || '''s 1080p' WHEN 3 THEN NULL ELSE '1999 ' || p_type END AS title FROM part"""


@query("t3_usable_title", [], f"SELECT rk, len(list_filter(regexp_extract_all(lower(coalesce(title, '')), '[a-z0-9'']+'), lambda w: w NOT IN ({_STOP}) AND w NOT IN ({_NOISE}) AND NOT regexp_full_match(w, '\\d+'))) > 0 AS usable FROM ({_TITLES})")
def _(px):
    return px.spark.sql(_TITLES).select("rk", T.usable_title(F.col("title")).alias("usable"))


@query("t4_title_sim", ["px_items", "px_candidates"], f"SELECT rk, provider_rank, round_even({_sim('ep_title', 'title')}, 6) AS sim FROM px_candidates JOIN px_items USING (rk)")
def _(px):
    met = px("px_candidates").join(px("px_items"), "rk")
    return met.select("rk", "provider_rank", F.bround(T.title_sim(F.col("ep_title"), F.col("title")), 6).alias("sim"))


_SE = r"regexp_extract_all({c}, '[sS](\d{{1,2}})[ ._-]?[eExX](\d{{1,3}})', {g})"
_NAMED = "SELECT rk, provider_rank, title || ' s' || (rk % 30) || 'x' || (rk % 400) AS name FROM px_candidates"


@query("t5_se_tokens", ["px_candidates"], f"SELECT rk, provider_rank, array_to_string(list_transform(list_zip({_SE.format(c='name', g=1)}, {_SE.format(c='name', g=2)}), lambda x: CAST(x[1] AS INT) || '-' || CAST(x[2] AS INT)), ',') AS tokens FROM ({_NAMED})")
def _(px):
    name = F.concat("title", F.lit(" s"), F.col("rk") % 30, F.lit("x"), F.col("rk") % 400)
    said = F.transform(T.se_tokens(name), lambda x: F.concat_ws("-", x["season"], x["ep"]))
    return px("px_candidates").select("rk", "provider_rank", F.array_join(said, ",").alias("tokens"))


_BARE, _TITLED = r"(?i)S(\d+)E(\d+)(?:-E(\d+))?\.[^.]+$", r"(?i)S(\d+)E(\d+)(?:-E(\d+))?\s*-\s*(.+)\.[^.]+$"


@query(
    "t6_parse_episode_name",
    ["px_agent", "px_files"],
    rf"""SELECT rk, try_cast(CASE WHEN bare THEN regexp_extract(file, '{_BARE}', 1) ELSE regexp_extract(file, '{_TITLED}', 1) END AS INT) AS season, try_cast(CASE WHEN bare THEN regexp_extract(file, '{_BARE}', 2) ELSE regexp_extract(file, '{_TITLED}', 2) END AS INT) AS ep_from,
  try_cast(coalesce(nullif(CASE WHEN bare THEN regexp_extract(file, '{_BARE}', 3) ELSE regexp_extract(file, '{_TITLED}', 3) END, ''), CASE WHEN bare THEN regexp_extract(file, '{_BARE}', 2) ELSE regexp_extract(file, '{_TITLED}', 2) END) AS INT) AS ep_to,
  CASE WHEN bare THEN '' ELSE regexp_extract(file, '{_TITLED}', 4) END AS title
FROM (SELECT rk, file, regexp_matches(file, '{_BARE}') AS bare FROM px_files) WHERE bare OR regexp_matches(file, '{_TITLED}')""",
)
def _(px):
    return px("px_files").withColumn("p", T.parse_episode_name(F.col("file"))).where("p is not null").select("rk", "p.*")


_ACCENTED = """SELECT p_partkey AS rk, CASE p_partkey % 5 WHEN 0 THEN 'The Café ' || p_name WHEN 1 THEN 'Đêm Tiếng Việt: ' || p_type WHEN 2 THEN 'Ængström & Ñandú ' || p_name WHEN 3 THEN 'Anatomy of ' || upper(p_name) ELSE NULL END AS title FROM part"""
_plain = lambda c: f"regexp_replace(regexp_replace(strip_accents(lower(coalesce({c}, ''))), '[^a-z0-9]', '', 'g'), '^(the|a|an)', '')"


@query("t7_normalize_title", [], f"SELECT rk, {_plain('title')} AS t FROM ({_ACCENTED})")
def _(px):
    return px.spark.sql(_ACCENTED).select("rk", T.normalize_title(F.col("title")).alias("t"))


_PARTED = """SELECT p_partkey AS rk, CASE p_partkey % 6 WHEN 0 THEN p_name || ' (2)' WHEN 1 THEN p_name || ', Part Two' WHEN 2 THEN p_name || ' Part III' WHEN 3 THEN 'The ' || p_name || ' (99999999999)' WHEN 4 THEN p_name || ' party' ELSE p_name END AS a,
 CASE p_partkey % 4 WHEN 0 THEN upper(p_name) WHEN 1 THEN p_name || ' (2)' WHEN 2 THEN p_name || ', part three' ELSE p_type END AS b FROM part"""
_split = lambda c: rf"""CASE WHEN regexp_matches({c}, '\((\d+)\)\s*$') THEN {{'base': {_plain(rf"regexp_replace({c}, '\((\d+)\)\s*$', '')")}, 'part': try_cast(regexp_extract({c}, '\((\d+)\)\s*$', 1) AS INT)}}
  WHEN regexp_matches({c}, '(?i),?\s*part\s+(one|i)\b') THEN {{'base': {_plain(rf"regexp_replace({c}, '(?i),?\s*part\s+(one|i)\b', '', 'g')")}, 'part': 1}}
  WHEN regexp_matches({c}, '(?i),?\s*part\s+(two|ii)\b') THEN {{'base': {_plain(rf"regexp_replace({c}, '(?i),?\s*part\s+(two|ii)\b', '', 'g')")}, 'part': 2}}
  WHEN regexp_matches({c}, '(?i),?\s*part\s+(three|iii)\b') THEN {{'base': {_plain(rf"regexp_replace({c}, '(?i),?\s*part\s+(three|iii)\b', '', 'g')")}, 'part': 3}} ELSE {{'base': {_plain(c)}, 'part': NULL}} END"""  # noqa: E731


@query("t8_split_part_number", [], f"SELECT rk, s.base AS base, s.part AS part FROM (SELECT rk, {_split('a')} AS s FROM ({_PARTED}))")
def _(px):
    return px.spark.sql(_PARTED).withColumn("s", T.split_part_number(F.col("a"))).select("rk", "s.*")


@query("t9_same_episode", [], f"SELECT rk, x.base = y.base AND coalesce(x.part = y.part, true) AS same FROM (SELECT rk, {_split('a')} AS x, {_split('b')} AS y FROM ({_PARTED}))")
def _(px):
    return px.spark.sql(_PARTED).select("rk", T.same_episode(F.col("a"), F.col("b")).alias("same"))


_card = lambda c: f"trim(regexp_replace(regexp_replace(lower(coalesce({c}, '')), '[^a-z0-9 ]', ' ', 'g'), ' +', ' ', 'g'))"
_CARDS = "SELECT p_partkey AS rk, CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_name || ' Part ii, ' || p_type END AS title, CASE WHEN p_partkey % 3 = 0 THEN upper(p_name) ELSE p_type || ' xii' END AS read FROM part"
_asked = lambda c: rf"list_filter(string_split({_card(c)}, ' '), lambda w: length(w) > 2 OR regexp_full_match(w, '\d+|i{{1,3}}|iv|v|vi{{0,3}}|ix|x'))"
_card_score = lambda t, r: f"CASE WHEN len({_asked(t)}) = 0 THEN 0.0 ELSE round_even(len(list_filter({_asked(t)}, lambda w: contains({_card(r)}, w))) / len({_asked(t)}), 2) END"


@query("t10_card_score", [], f"SELECT rk, {_card_score('title', 'read')} AS score FROM ({_CARDS})")
def _(px):
    return px.spark.sql(_CARDS).select("rk", T.card_score(F.col("title"), F.col("read")).alias("score"))


_CLOCKS = "SELECT disc, title, CASE WHEN title % 7 = 0 THEN '12:30' WHEN title % 11 = 0 THEN NULL ELSE CAST(CAST(floor(sec / 3600) AS INT) AS STRING) || ':' || CAST(CAST(floor(sec / 60) AS INT) % 60 AS STRING) || ':' || CAST(CAST(floor(sec) AS INT) % 60 AS STRING) END AS c, floor(sec) AS sec FROM px_titles"


@query("t11_hms_to_sec", ["px_titles"], f"SELECT disc, title, CASE WHEN title % 7 > 0 AND c IS NOT NULL THEN sec END AS sec FROM ({_CLOCKS.replace('STRING', 'VARCHAR')})")
def _(px):
    px("px_titles").createOrReplaceTempView("px_titles")
    return px.spark.sql(_CLOCKS).select("disc", "title", T.hms_to_sec(F.col("c")).alias("sec"))


_SIZES = "SELECT rel, CASE ok % 4 WHEN 0 THEN bytes % 900 || '.5 GB' WHEN 1 THEN bytes % 900 || ' mb' WHEN 2 THEN 'n/a' ELSE NULL END AS s, bytes % 900 AS b, ok FROM px_src"


@query("t12_size_to_gb", ["px_src"], f"SELECT rel, CASE ok % 4 WHEN 0 THEN b + 0.5::DOUBLE WHEN 1 THEN b / 1024 END AS gb FROM ({_SIZES})")
def _(px):
    px("px_src").createOrReplaceTempView("px_src")
    return px.spark.sql(_SIZES).select("rel", T.size_to_gb(F.col("s")).alias("gb"))


@query("t14_shift_scale_cues", [], f"SELECT file_id, cue, round_even(greatest(start_s * (1 + file_id % 3 / 1000.0::DOUBLE) + (file_id % 7 - 3.0::DOUBLE), 0), 6) AS start_s, greatest(CAST(start_s * 1000 AS BIGINT) - file_id % 9 * 777, 0) / 1000 AS moved FROM ({_CUES})")
def _(px):
    f = F.col("file_id")
    moved = T.shift_ms(F.col("start_s"), -(f % 9) * 777)
    return _cues(px).select("file_id", "cue", F.bround(T.shift_scaled(F.col("start_s"), 1 + f % 3 / 1000.0, f % 7 - 3.0), 6).alias("start_s"), moved.alias("moved"))


_PLACES = """SELECT rel, CASE ok % 6 WHEN 0 THEN 'Films/Deleted Scenes' WHEN 1 THEN 'Shows/Season 00' ELSE 'Shows/Season 01' END AS dir, CASE ok % 5 WHEN 0 THEN 'Show S00E0' || ok % 9 || '.mkv' WHEN 1 THEN 'show s01e02.mkv' WHEN 2 THEN 'Film-pt' || ok % 3 || '.mkv' WHEN 3 THEN 'A Teaser.mkv' ELSE 'Film.mkv' END AS name FROM px_src"""


@query(
    "t15_file_role",
    ["px_src"],
    rf"""SELECT rel, CASE WHEN dir = 'Films/Deleted Scenes' OR regexp_matches(name, '(?i)(trailer|teaser)') THEN 'Extra' WHEN regexp_matches(name, '(?i)s00e\d+') THEN 'Special' WHEN regexp_matches(name, '(?i)s\d+e\d+') THEN 'Episode'
  WHEN regexp_matches(name, '(?i)[ -]pt\d+\.') THEN 'Part' ELSE 'Feature' END AS role FROM ({_PLACES})""",
)
def _(px):
    px("px_src").createOrReplaceTempView("px_src")
    return px.spark.sql(_PLACES).select("rel", T.file_role(T.leaf(F.col("dir")), F.col("name")).alias("role"))


@query(
    "t16_paths",
    ["px_agent"],
    """SELECT rk, '/tv/' || show_title || printf('/Season %02d/', season) || show_title || printf(' - S%02dE%02d - ', season, idx) || title || '.mkv' AS path,
  'E:/rips/Disk ' || rk % 7 || CASE WHEN rk % 2 = 0 THEN '/BDMV/STREAM/' || printf('%05d', rk) || '.m2ts' ELSE '' END AS src FROM (SELECT *, show_name || CASE WHEN rk % 5 > 0 THEN ' (' || 1960 + rk % 60 || ')' ELSE '' END AS show_title FROM px_agent)""",
)
def _(px):
    rk = F.col("rk")
    path = T.library_path(F.lit("/tv"), F.col("show"), F.col("season"), F.col("idx"), F.col("title"), F.when(rk % 5 > 0, 1960 + rk % 60))
    src = T.source_path(F.lit("E:\\rips"), F.lit("Disk {disc}"), (rk % 7).cast("string"), F.when(rk % 2 == 0, "BD").otherwise("DVD"), F.format_string("%05d", rk))
    return px("px_agent").select("rk", path.alias("path"), src.alias("src"))


@query(
    "t17_names",
    ["px_agent"],
    r"""SELECT rk, title || '.mkv' AS leaf, CASE rk % 3 WHEN 0 THEN '/mnt/tv/' || title || '.mkv' WHEN 1 THEN '/mnt/x\' || title || '.mkv' ELSE 'C:\y/' || title || '.mkv' END AS mapped,
  substr(regexp_replace(repeat(title || ' & Co: ', 9), '[^A-Za-z0-9._-]+', '_', 'g'), 1, 80) AS safe FROM px_agent""",
)
def _(px):
    rk = F.col("rk")
    path = F.concat(F.when(rk % 3 == 0, "D:\\tv\\").when(rk % 3 == 1, "D:\\x\\").otherwise("C:\\y/"), "title", F.lit(".mkv"))
    mapped = T.map_path(path, [("D:\\tv\\", "/mnt/tv/"), ("D:\\", "/mnt/")])
    return px("px_agent").select("rk", T.leaf(path).alias("leaf"), mapped.alias("mapped"), T.safe_name(F.repeat(F.concat("title", F.lit(" & Co: ")), 9)).alias("safe"))


@query(
    "s8_decode_bytes",
    [],
    r"""SELECT doc_id, md5(CASE doc_id % 3 WHEN 1 THEN regexp_replace(text, '[^\x00-\x7f\xa0-\xff]', '?', 'g') ELSE text END || CASE WHEN doc_id % 3 = 1 THEN 'é €…' ELSE '' END) AS digest FROM documents WHERE text IS NOT NULL""",
)
def _(px):
    d, text = F.col("file_id"), F.col("text")
    latin = F.regexp_replace(text, "[^\x00-\x7f\xa0-\xff]", "?")
    # An e acute, a space, a euro sign and an ellipsis in cp1252.
    raw = F.when(d % 3 == 0, F.concat(F.unhex(F.lit("EFBBBF")), text.cast("binary"))).when(d % 3 == 1, F.concat(F.encode(latin, "ISO-8859-1"), F.unhex(F.lit("E9208085")))).otherwise(text.cast("binary"))
    return px("px_cues").where("text is not null").select(d.alias("doc_id"), F.md5(T.decode_bytes(raw)).alias("digest"))
