"""Queries of the readers and writers over files that they write to the shared folder first, each with the same in DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwright.jobs.queries import query
from shelfwright.operators import audits as U, reconcile as J
from shelfwright.session import in_slices, new_path
from shelfwright.sources import readers as S, writers as K


def _written(px, rows: DataFrame, name, line, order: list[str], ending: str = "\n") -> str:
    """A folder with one text file for each name, its lines in order."""
    path = new_path(px.spark, "files")
    lines = F.array_sort(F.collect_list(F.struct(*order, line.alias("_line"))))
    # Dealt out by file before a row becomes its line, which is many times longer.
    files = rows.repartition(name).groupBy(name.alias("name")).agg(F.concat(F.array_join(F.transform(lines, lambda x: x["_line"]), ending), F.lit(ending)).alias("content"))
    K.write_files(files, path)
    return path


_SRC = "SELECT *, CAST(regexp_extract(rel, '/([0-9]+)$', 1) AS INT) AS n FROM px_src"


def _numbered(px) -> DataFrame:
    return px("px_src").withColumn("n", F.regexp_extract("rel", r"/([0-9]+)$", 1).cast("int"))


_hms = "CASE WHEN n % 9 = 0 THEN NULL ELSE bytes % 20000 END"


def _said(*parts) -> Column:
    """Texts and columns as one text; where there are many rows, quicker than a format is."""
    return F.concat(*(F.lit(x) if isinstance(x, str) else x.cast("string") for x in parts))


def _two(number: Column) -> Column:
    """A number with two digits at least."""
    return F.concat(F.when(number < 10, "0").otherwise(""), number.cast("string"))


def _clock(b: Column) -> Column:
    return _said(F.floor(b / 3600), ":", _two(F.floor(b / 60) % 60), ":", _two(b % 60))


def _log(px, rows: DataFrame | None = None) -> str:
    b, n = F.col("bytes") % 20000, F.col("n")
    clock = F.when(n % 9 == 0, "12:30").otherwise(_clock(b))
    rows = _numbered(px) if rows is None else rows
    line = F.concat_ws(
        "\n", F.lit('MSG:1,"x"'), _said("TINFO:", n, ',9,0,"', clock, '"'), _said("TINFO:", n, ',10,0,"', b, ' MB"'), _said("TINFO:", n, ',27,0,"a, b_t', _two(n), '.mkv"'),
        _said("SINFO:", n, ',0,1,6201,"Video"'), _said("SINFO:", n, ',1,4,0,"', F.when(n % 2 == 0, "eng").otherwise("deu"), '"'), F.when(n % 5 == 0, F.lit("TINFO:broken")),
    )
    return _written(px, rows, F.concat(F.lit("disc"), F.col("work").cast("string"), F.lit(".log")), line, ["n"])


@query("s1_robot_log_titles", ["px_src"], f"SELECT 'disc' || work AS disc, n AS title, ({_hms})::DOUBLE AS sec, (bytes % 20000) || ' MB' AS size_text, printf('a, b_t%02d.mkv', n) AS out_name FROM ({_SRC})")
def _(px):
    return S.read_robot_log(px.spark, _log(px))[0].select("disc", "title", "sec", "size_text", "out_name")


@query("s1_robot_log_streams", ["px_src"], f"SELECT 'disc' || work AS disc, n AS title, s AS n, CASE s WHEN 0 THEN 'Video' END AS type, CASE s WHEN 1 THEN CASE WHEN n % 2 = 0 THEN 'eng' ELSE 'deu' END END AS lang FROM ({_SRC}), (SELECT unnest([0, 1]) AS s)")
def _(px):
    return S.read_robot_log(px.spark, _log(px))[1].select("disc", "title", "n", "type", "lang")


@query("s2_read_playlists", ["px_src"], f"SELECT 'disc' || work AS disc, '00001' AS playlist, string_agg(printf('%05d', n), ',' ORDER BY n) AS clips FROM ({_SRC}) GROUP BY work")
def _(px):
    line = F.format_string("\u0001xx%05dM2TS\u0002", "n")
    path = _written(px, _numbered(px), F.concat(F.lit("disc"), F.col("work").cast("string"), F.lit("/BDMV/PLAYLIST/00001.mpls")), line, ["n"], "#")
    return S.read_playlists(px.spark, f"{path}/*/BDMV/PLAYLIST/*.mpls").select("disc", "playlist", F.array_join("clips", ",").alias("clips"))


@query("s3_read_clip_languages", ["px_src"], f"SELECT 'disc' || work AS disc, '00002' AS clip, row_number() OVER (PARTITION BY work ORDER BY n) - 1 AS pos, CASE n % 3 WHEN 0 THEN 'eng' WHEN 1 THEN 'deu' ELSE 'fra' END AS lang FROM ({_SRC})")
def _(px):
    line = F.concat(F.lit("\u0003"), F.when(F.col("n") % 3 == 0, "eng").when(F.col("n") % 3 == 1, "deu").otherwise("fra"), F.lit("\u0004"))
    path = _written(px, _numbered(px), F.concat(F.lit("disc"), F.col("work").cast("string"), F.lit("/BDMV/CLIPINF/00002.clpi")), line, ["n"], "#")
    return S.read_clip_languages(px.spark, f"{path}/*/BDMV/CLIPINF/*.clpi", ["eng", "deu", "fra"])


def _xml(px) -> str:
    """A disc's own XML: every third title with its length in elements below, every seventh plays all, episodes are marked."""
    b, n = F.col("bytes") % 20000, F.col("n")
    marks = F.when(n % 7 == 0, ' ContainsEpisode="False"').when(n % 2 == 0, F.format_string(' TVEpisode="%d"', n)).otherwise("")
    clock = (F.floor(b / 3600), F.floor(b / 60) % 60, b % 60)
    below = F.format_string("<Hours>%d</Hours>\n<Minutes>%d</Minutes><Seconds>%d</Seconds>", *clock)
    line = F.concat(
        F.format_string('<Title Number="%d"%s', n, marks), F.when(n % 3 == 0, F.concat(F.lit(">"), below, F.lit("</Title>\n"))).otherwise(F.format_string(' Hours="%d" Minutes="%d" Seconds="%d"/>\n', *clock)),
        F.format_string('<AudioTrack Language="%s" Type="DTS &amp; more" Channels="5.1" />', F.when(n % 3 == 0, "Commentary").otherwise("English")),
    )
    first = F.concat(F.lit('<?xml version="1.0"?>\n<Disc><LocalTitle> Film &amp; '), F.col("work"), F.lit("</LocalTitle><ExtraFeatures><![CDATA[Trailer\n  Making <of> \n\n]]></ExtraFeatures>\n"))
    last = n == F.max("n").over(Window.partitionBy("work"))
    rows = _numbered(px).withColumn("last", last)
    line = F.concat(F.when(n == 1, first).otherwise(""), line, F.when(F.col("last") & (F.col("work") % 10 > 0), "</Disc>").otherwise(""))
    return _written(px, rows, F.concat(F.lit("disc"), F.col("work").cast("string"), F.lit("/mymovies.xml")), line, ["n"])


@query(
    "s4_read_disc_xml",
    ["px_src"],
    f"""SELECT 'disc' || work AS disc, 'title' AS kind, n - 1 AS pos, n::VARCHAR AS name, (bytes % 20000)::DOUBLE AS sec, CASE WHEN n % 7 > 0 AND n % 2 = 0 THEN n END AS episode, n % 7 = 0 AS mark FROM ({_SRC})
UNION ALL SELECT 'disc' || work, 'audio', n - 1, CASE WHEN n % 3 = 0 THEN 'Commentary' ELSE 'English' END || ' DTS & more', NULL, NULL, NULL FROM ({_SRC})
UNION ALL SELECT DISTINCT 'disc' || work, 'extra', i, ['Trailer', 'Making <of>'][i + 1], NULL, NULL, NULL FROM px_src, (SELECT unnest([0, 1]) AS i)
UNION ALL SELECT DISTINCT 'disc' || work, 'header', 0, 'Film & ' || work, NULL, NULL, work % 10 = 0 FROM px_src""",
)
def _(px):
    titles, tracks, extras, header = S.read_disc_xml(px.spark, f"{_xml(px)}/*/mymovies.xml")
    row = lambda df, kind, name, mark=F.lit(None), pos=F.col("pos"): df.select("disc", F.lit(kind).alias("kind"), pos.alias("pos"), name.alias("name"), F.lit(None).cast("double").alias("sec"), F.lit(None).cast("int").alias("episode"), mark.cast("boolean").alias("mark"))  # noqa: B008, E731
    out = titles.select("disc", F.lit("title").alias("kind"), "pos", F.col("title").cast("string").alias("name"), "sec", "episode", F.col("play_all").alias("mark"))
    out = out.unionByName(row(tracks, "audio", F.concat_ws(" ", "language", "type"))).unionByName(row(extras, "extra", F.col("name")))
    return out.unionByName(row(header, "header", F.col("local_title"), F.col("malformed"), F.lit(0)))


@query(
    "s5_read_dispositions",
    ["px_src"],
    f"SELECT 'disc' || work AS disc, n // 2 AS title, CASE WHEN arg_max(n, n) % 2 = 0 THEN 'encode' ELSE 'exclude' END AS kind, CASE WHEN max(n) % 3 = 0 THEN '' ELSE 'note ' || max(n) END AS note FROM ({_SRC}) WHERE n % 7 > 0 GROUP BY work, n // 2",
)
def _(px):
    n = F.col("n")
    entry = F.format_string("t%02d|%s%s", F.floor(n / 2), F.when(n % 2 == 0, "Encode").otherwise("EXCLUDE"), F.when(n % 3 == 0, "").otherwise(F.format_string("| note %d ", n)))
    line = F.when(n % 7 == 0, F.concat(F.lit("# "), entry)).otherwise(entry)
    path = _written(px, _numbered(px), F.concat(F.lit("disc"), F.col("work").cast("string"), F.lit(".dispositions.txt")), line, ["n"], "\r\n")
    return S.read_dispositions(px.spark, path)


@query("s6_read_pipe_table", ["px_agent"], "SELECT rk::VARCHAR AS rk, season::VARCHAR AS season, title AS name FROM px_agent")
def _(px):
    path = new_path(px.spark, "files")
    rows = px("px_agent").select(F.concat_ws("|", F.format_string(" %d ", "rk"), F.format_string("%d ", "season"), F.col("title")).alias("value"))
    # A header in each part file, as each is a table of its own.
    px.spark.range(1).select(F.lit("# shows\nrk | season | name").alias("value")).union(rows).coalesce(1).write.text(path)
    return S.read_pipe_table(px.spark, path)


_TURNS = "SELECT conv_id AS file_id, turn AS cue, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n, text FROM conversations"


def _subtitles(px) -> str:
    c = px.spark.table("conversations").select(F.col("conv_id").alias("file_id"), F.col("turn").alias("cue"), (F.col("turn") * 4.25).alias("start_s"), (F.col("turn") * 4.25 + 2.5).alias("end_s"), "text")
    path = new_path(px.spark, "files")
    K.write_srt(c, path)
    return path


for _dialect, _first in (("strict", "n - 1"), ("lenient", "n - 1"), ("blocks", "n")):

    @query(f"k3_s7_srt_{_dialect}", [], f"SELECT file_id::VARCHAR AS file_id, {_first} AS cue, cue * 4.25::DOUBLE AS start_s, cue * 4.25 + 2.5::DOUBLE AS end_s, md5(text) AS digest FROM ({_TURNS})")
    def _(px, dialect=_dialect):
        return S.read_srt(px.spark, f"{_subtitles(px)}/*.srt", dialect).select("file_id", "cue", "start_s", "end_s", F.md5("text").alias("digest"))


_OCR = "SELECT conv_id, turn, string_split(text, chr(10)) AS l FROM conversations"


@query(
    "s9_read_ocr_results",
    [],
    f"""SELECT 'conv' || conv_id AS file_id, turn AS cue, md5(CASE WHEN turn % 3 = 2 THEN 'from text' ELSE array_to_string(list_filter(list_transform(l, lambda x: trim(x)), lambda x: x <> ''), chr(10)) END) AS digest
FROM ({_OCR}) WHERE turn % 3 = 2 OR len(list_filter(l, lambda x: trim(x) <> '')) > 0""",
)
def _(px):
    path, c = new_path(px.spark, "files"), px.spark.table("conversations")
    lines = F.filter(F.split("text", "\n"), lambda x: F.trim(x) != "")
    # JSON lines stand from the last to the first, with boxes that tell their true order.
    size = F.size(lines)
    boxes = F.transform(lines, lambda x, i: F.array(F.lit(0.0), (size - i).cast("double"), F.lit(9.0), (size - i + 5).cast("double")))
    said = F.to_json(F.struct(F.reverse(lines).alias("rec_texts"), boxes.alias("rec_boxes")))
    at = lambda ending: F.concat(F.lit("conv"), F.col("conv_id"), F.lit("/cue_"), F.lpad(F.col("turn").cast("string"), 4, "0"), F.lit(ending))
    plain = c.select(at(".txt").alias("name"), F.when(F.col("turn") % 3 == 2, " from text \n\n").otherwise("beaten").alias("content"))
    files = plain.unionByName(c.where("turn % 3 < 2").select(at("_res.json").alias("name"), said.alias("content")))
    # Dealt out, as the table is a few partitions of many texts.
    K.write_files(files.repartition(4 * px.spark.sparkContext.defaultParallelism, "name"), path)
    return S.read_ocr_results(px.spark, path).select("file_id", "cue", F.md5("text").alias("digest"))


@query("s10_read_listing", ["px_src"], f"SELECT 'disc' || work || '/VIDEO_TS/VTS_' || printf('%02d', n % 10) || '_0.IFO' AS rel, 'disc' || work AS work, 'disc' || work || '/VIDEO_TS' AS dir, 'VTS_' || printf('%02d', n % 10) || '_0.IFO' AS name, 'ifo' AS ext, sum(length('x' || n) + 1)::BIGINT AS bytes FROM ({_SRC}) GROUP BY work, n % 10")
def _(px):
    name = F.format_string("disc%d/VIDEO_TS/VTS_%02d_0.IFO", "work", F.col("n") % 10)
    return S.read_listing(px.spark, _written(px, _numbered(px), name, F.format_string("x%d", "n"), ["n"])).drop("modified")


@query("s11_read_declared_title_sets", ["px_src"], "SELECT 'disc' || work AS disc, 256 * (work % 3) + work % 200 AS declared FROM (SELECT DISTINCT work FROM px_src)")
def _(px):
    path, work = new_path(px.spark, "files"), F.col("work")
    byte = lambda k: F.unhex(F.lpad(F.hex(k), 2, "0"))
    discs = px("px_src").select("work").distinct()
    K.write_files(discs.select(F.format_string("disc%d/VIDEO_TS/VIDEO_TS.IFO", work).alias("name"), F.concat(F.repeat(F.lit("x"), 62).cast("binary"), byte(work % 3), byte(work % 200), F.lit("rest").cast("binary")).alias("content")), path)
    return S.read_declared_title_sets(px.spark, f"{path}/*/VIDEO_TS/VIDEO_TS.IFO")


@query(
    "s12_read_state",
    ["px_src"],
    "SELECT rel AS rk, CASE ok % 3 WHEN 0 THEN 'matched' ELSE 'no_match' END AS r, CASE ok % 3 WHEN 0 THEN ok % 100 / 100.0::DOUBLE END AS cover, CASE WHEN ok % 2 = 0 THEN 'a' || ok END AS t, CASE WHEN ok % 2 = 0 THEN ok END AS score, CASE WHEN ok % 2 = 0 AND ok % 5 = 0 THEN 'download_failed' END AS why FROM px_src",
)
def _(px):
    """State files as the search writes them, a tried candidate's title in t; every second one indented."""
    ok = F.col("ok")
    one = F.struct(F.concat(F.lit("a"), ok).alias("t"), ok.alias("score"), F.lit(0.5).alias("sim"), F.when(ok % 5 == 0, "download_failed").alias("why"))
    verdict = F.struct(F.when(ok % 3 == 0, "matched").otherwise("no_match").alias("r"), F.when(ok % 3 == 0, ok % 100 / 100.0).alias("cover"), F.when(ok % 2 == 0, F.array(one)).alias("tried"))
    rows = px("px_src").groupBy("work").agg(F.map_from_entries(F.collect_list(F.struct("rel", verdict))).alias("m"))
    content = F.when(F.col("work") % 2 == 0, F.to_json("m", {"pretty": "true"})).otherwise(F.to_json("m"))
    path = new_path(px.spark, "files")
    K.write_files(rows.select(F.format_string("state%d.json", "work").alias("name"), content.alias("content")), path)
    return S.read_state(px.spark, path).select("rk", "r", "cover", F.get("tried", 0)["t"].alias("t"), F.get("tried", 0)["score"].alias("score"), F.get("tried", 0)["why"].alias("why"))


def _catalogued(px, per_disc: bool) -> DataFrame:
    """Discs catalogued and read back, a slice of them after another: an archive's catalogues are many times its tables."""
    return in_slices(_numbered(px).select("work", "n", "bytes"), "work", lambda rows: (_catalogued_slice(px, rows, per_disc),), "catalogued")[0]


def _catalogued_slice(px, rows: DataFrame, per_disc: bool) -> DataFrame:
    b, n = F.col("bytes") % 9000, F.col("n")
    t = rows.select(F.concat(F.lit("disc "), F.col("work")).alias("disc"), F.lit(10).alias("min_length"), n.alias("title"), _clock(b).alias("duration"), _said(n, " MB").alias("size_text"), F.when(n % 3 == 0, F.array(F.lit("f1.png"))).alias("frames"))
    s = t.where("title % 10 > 0").select("disc", "title", F.explode(F.array(F.lit(0), F.lit(1))).alias("n")).withColumn("type", F.when(F.col("n") == 0, "Video").otherwise("Audio"))
    path = new_path(px.spark, "catalogue")
    K.write_catalogue(t, s, path, per_disc)
    titles, streams = S.read_catalogue(px.spark, path, not per_disc)
    of = streams.groupBy("disc", "title").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "type"))), lambda x: x["type"]), ",").alias("types"))
    # Merged: the stored tables are small on disk, not in memory.
    return titles.join(of.hint("merge"), ["disc", "title"], "left").select("disc", "title", "sec", "size_text", F.size("frames").alias("frames"), "types")


_CATALOGUE = f"SELECT 'disc ' || work AS disc, n AS title, (bytes % 9000)::DOUBLE AS sec, n || ' MB' AS size_text, CASE WHEN n % 3 = 0 THEN 1 END AS frames, CASE WHEN n % 10 > 0 THEN 'Video,Audio' END AS types FROM ({_SRC})"


@query("s12_k1_catalogue", ["px_src"], _CATALOGUE)
def _(px):
    """A file a disc, indented, as the cataloguing tool writes it."""
    return _catalogued(px, True)


@query("s12_k1_catalogue_lines", ["px_src"], _CATALOGUE)
def _(px):
    return _catalogued(px, False)


@query("s12_unreadable", ["px_src"], "SELECT DISTINCT work, CASE WHEN work % 6 = 1 THEN 'empty' ELSE 'no JSON' END AS why FROM px_src WHERE work % 3 = 1")
def _(px):
    work, path = F.col("work"), new_path(px.spark, "files")
    content = F.when(work % 6 == 1, " \n").when(work % 3 == 1, '{"a": {"r": "matched"').otherwise('{\n  "a": {"r": "matched"}\n}')
    K.write_files(px("px_src").select(F.format_string("s%d.json", work).alias("name"), content.alias("content")).distinct(), path)
    return S.unreadable(px.spark, path).select(F.regexp_extract("file", r"s(\d+)\.json$", 1).cast("long").alias("work"), "why")


def _manifested(px, per_show: bool):
    rk, none = F.col("rk"), F.lit(None).cast("string")
    pair = lambda k, title: F.struct(F.lit(k).alias("idx"), title.alias("title"))
    rows = px("px_agent").select(
        F.col("show").alias("manifest"), F.concat(rk, F.lit(" "), "title", F.lit(".mkv")).alias("out"), F.when(rk % 2 == 0, "BD").otherwise("DVD").alias("kind"), F.when(rk % 2 > 0, F.col("idx")).alias("title"), F.when(rk % 3 == 0, "eng").when(rk % 3 == 1, "2").alias("subTrack"),
        F.when(rk % 5 == 0, F.array(F.lit(1), F.lit(0))).alias("audioTracks"), F.when(rk % 4 == 0, F.array(pair(1, none), pair(2, F.lit('The "Writers"')))).when(rk % 4 == 1, F.array(pair(3, none))).alias("commentary"),
        F.when(rk % 6 == 0, F.array(pair(4, F.lit("Described")))).alias("audioDescription"),
    )
    path = new_path(px.spark, "manifest")
    K.write_manifest(rows if per_show else rows.drop("manifest"), path, "manifest" if per_show else None)
    read = S.read_manifest(px.spark, path, not per_show)
    said = lambda c: F.array_join(F.transform(c, lambda x: F.concat(x["idx"], F.lit(":"), F.coalesce(x["title"], F.lit("-")))), ",").alias(S.snake(c))
    return read.select("out", "kind", "title", F.col("subTrack").alias("sub_track"), F.array_join("audioTracks", ",").alias("tracks"), said("commentary"), said("audioDescription"))


_MANIFESTS = """SELECT rk || ' ' || title || '.mkv' AS out, CASE WHEN rk % 2 = 0 THEN 'BD' ELSE 'DVD' END AS kind, CASE WHEN rk % 2 > 0 THEN idx END AS title, CASE rk % 3 WHEN 0 THEN 'eng' WHEN 1 THEN '2' END AS sub_track, CASE rk % 5 WHEN 0 THEN '1,0' END AS tracks,
  CASE rk % 4 WHEN 0 THEN '1:-,2:The "Writers"' WHEN 1 THEN '3:-' END AS commentary, CASE WHEN rk % 6 = 0 THEN '4:Described' END AS audio_description FROM px_agent"""


@query("s12_k2_manifest", ["px_agent"], _MANIFESTS)
def _(px):
    """A list of items in a file for each show."""
    return _manifested(px, True)


@query("s12_k2_manifest_lines", ["px_agent"], _MANIFESTS)
def _(px):
    return _manifested(px, False)


@query("k4_append_log", ["px_log"], "SELECT event_id, rk, event FROM px_log UNION ALL SELECT event_id, rk, event FROM px_log WHERE event_id % 3 = 0")
def _(px):
    log, path = px("px_log").select("event_id", "rk", "event"), new_path(px.spark, "log")
    K.append_log(log, path)
    K.append_log(log.where("event_id % 3 = 0"), path)
    return S.read_log(px.spark, path, "event_id long, rk long, event string")


@query("s13_explode_media_streams", ["px_streams"], "SELECT rk, (stream_type - 1)::INT AS part, row_number() OVER (PARTITION BY rk, stream_type ORDER BY ordinal) - 1 AS ordinal, codec, language_code FROM px_streams")
def _(px):
    stream = F.struct("ordinal", "codec", "language_code")
    rows = px("px_streams").groupBy("rk", "stream_type").agg(F.array_sort(F.collect_list(stream)).alias("Stream"))
    parts = F.transform(F.sequence(F.lit(1), F.lit(3)), lambda k: F.struct(F.flatten(F.transform(F.filter("p", lambda x: x["stream_type"] == k), lambda x: F.transform(x["Stream"], lambda s: F.struct(s["codec"].alias("codec"), s["language_code"].alias("language_code"))))).alias("Stream")))
    items = rows.groupBy("rk").agg(F.collect_list(F.struct("stream_type", "Stream")).alias("p")).select("rk", F.array(F.struct(parts.alias("Part"))).alias("Media"))
    return S.explode_media_streams(items).where("codec is not null")


@query(
    "j21_title_sets",
    ["px_src"],
    f"""SELECT DISTINCT 'disc' || work AS disc, printf('%02d', n % 10) AS title_set FROM ({_SRC}) WHERE (work, n % 10) NOT IN (SELECT (work, n % 10) FROM ({_SRC}) WHERE n % 4 = 0)""",
)
def _(px):
    n, disc = F.col("n") % 10, F.concat(F.lit("disc"), F.col("work").cast("string"))
    ifo = _numbered(px).select(disc.alias("disc"), F.format_string("VTS_%02d_0.IFO", n).alias("name"))
    return J.title_sets_without_backup(ifo.unionByName(_numbered(px).where("n % 4 = 0").select(disc.alias("disc"), F.format_string("vts_%02d_0.bup", n).alias("name"))))


@query("j21_incomplete_title_sets", ["px_src"], f"SELECT work AS disc, work % 12 AS declared, count(DISTINCT n % 10) FILTER (n % 10 < work % 11) AS present FROM ({_SRC}) GROUP BY work HAVING work % 12 > count(DISTINCT n % 10) FILTER (n % 10 < work % 11)")
def _(px):
    rows = _numbered(px)
    declared = rows.select(F.col("work").alias("disc"), (F.col("work") % 12).alias("declared")).distinct()
    return J.incomplete_title_sets(declared, rows.where("n % 10 < work % 11").select(F.col("work").alias("disc"), (F.col("n") % 10).alias("title_set")))


@query("a25_disc_kind", ["px_src"], f"SELECT work AS disc, CASE work % 5 WHEN 0 THEN 'Blu-ray' WHEN 1 THEN 'DVD' WHEN 2 THEN CASE WHEN count(*) = 1 THEN 'ISO' ELSE 'several ISOs' END WHEN 3 THEN 'ISO' ELSE 'unusable' END AS kind, count(*) AS files, sum(bytes)::BIGINT AS bytes FROM ({_SRC}) GROUP BY work")
def _(px):
    w, n = F.col("work") % 5, F.col("n")
    ext = F.when((w == 0) & (n % 2 == 1), "m2ts").when((w == 1) & (n % 2 == 1), "vob").when((w == 2) | ((w == 3) & (n == 1)), "iso").otherwise("txt")
    return U.disc_kind(_numbered(px).select(F.col("work").alias("disc"), ext.alias("ext"), "bytes"))
