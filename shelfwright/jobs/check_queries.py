"""Queries of the predicates, reconciliations, aggregates and rankings that look at files, the index and readings, each with the same in DuckDB SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window, functions as F

from shelfwright.jobs.queries import _CUES, _cues, _norm, _sim, query
from shelfwright.jobs.source_queries import _SRC, _numbered
from shelfwright.jobs.text_queries import _card_score
from shelfwright.operators import aggregates as A, audits as U, predicates as P, ranking as W, reconcile as J

_FILES = f"SELECT CASE WHEN work % 2 = 0 THEN 'tv' ELSE 'movie' END AS kind, work, n % 3 AS grp, rel, CASE WHEN n % 5 = 0 THEN 'txt' ELSE 'MKV' END AS ext, bytes, ok, n FROM ({_SRC})"


def _files(px):
    n = F.col("n")
    return _numbered(px).select(F.when(F.col("work") % 2 == 0, "tv").otherwise("movie").alias("kind"), "work", (n % 3).alias("grp"), "rel", F.when(n % 5 == 0, "txt").otherwise("MKV").alias("ext"), "bytes", "ok", "n")


@query(
    "p4_survey_subtitles",
    ["px_src"],
    f""", f AS ({_FILES}), m AS (SELECT *, CASE kind WHEN 'tv' THEN row_number() OVER (PARTITION BY kind, work, grp ORDER BY rel) ELSE row_number() OVER (PARTITION BY kind, work ORDER BY bytes DESC, rel) END AS place FROM f WHERE ext = 'MKV'),
c AS (SELECT rel, ok % 3 AS bitmap_subs, CASE ok % 4 WHEN 0 THEN 1 ELSE 0 END AS text_subs FROM m WHERE place = 1)
SELECT rel, bitmap_subs, text_subs, CASE WHEN bitmap_subs > 0 AND text_subs = 0 THEN 'YES' WHEN bitmap_subs > text_subs THEN 'partial' ELSE 'no' END AS needs_ocr FROM c""",
)
def _(px):
    files = _files(px)
    image = files.select("rel", F.explode(F.sequence(F.lit(0), F.col("ok") % 3)).alias("k")).where("k > 0").select("rel", F.lit("hdmv_pgs_subtitle").alias("codec"))
    text = files.where("ok % 4 = 0").select("rel", F.lit("subrip").alias("codec"))
    return U.survey_subtitles(files, image.unionByName(text), U.IMAGE_CODECS, P.TEXT_CODECS)


@query(
    "p5_bitmap_populated",
    ["px_src"],
    """SELECT rel, md5(concat_ws('|', rel, bytes, epoch_us(created))) AS cache_key, CASE WHEN ok % 10 = 0 THEN 'exhausted' WHEN ok % 3 = 0 THEN 'empty' WHEN ok % 7 = 0 THEN 'exhausted' ELSE 'populated' END AS verdict FROM px_src WHERE ok % 4 > 0""",
)
def _(px):
    ok, src = F.col("ok"), px("px_src")
    media = src.select("rel", "bytes", F.col("created").alias("modified"), "ok")
    image = src.where("ok % 4 > 0").select("rel", F.lit("dvd_subtitle").alias("codec"), F.when(ok % 3 == 0, 0).otherwise(5).alias("packets"))
    text = src.select("rel", F.lit("subrip").alias("codec"), F.lit(9).alias("packets"))
    read = src.where("ok % 7 = 0").select("rel", F.lit(0).alias("cues"))
    key = F.md5(F.concat_ws("|", "rel", F.col("bytes").cast("string"), F.unix_micros(F.col("created").cast("timestamp")).cast("string")))
    known = src.where("ok % 10 = 0").select(key.alias("cache_key"), F.lit("exhausted").alias("verdict"))
    return U.bitmap_populated(media.drop("ok"), image.unionByName(text), read, known)


@query(
    "p8_label_audio",
    ["px_streams"],
    """, t AS (SELECT rk AS file_id, ordinal, CASE language_code WHEN 'en' THEN 'und' ELSE language_code END AS lang FROM px_streams WHERE stream_type = 2),
k AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY ordinal) - 1 AS place FROM t)
SELECT file_id, place, ordinal, CASE WHEN file_id % 4 = 0 AND place = 1 THEN 'spa' WHEN file_id % 3 = 0 AND place = 0 THEN 'deu' WHEN lang = 'und' THEN 'eng' ELSE lang END AS language,
  CASE WHEN file_id % 7 = 0 AND ordinal % 4 = 3 THEN 'Described' WHEN file_id % 5 = 0 AND ordinal = 2 THEN 'Audio Commentary 1' WHEN file_id % 5 = 0 AND ordinal = 4 THEN 'Writers' WHEN file_id % 5 = 1 AND ordinal = 2 THEN 'Audio Commentary' END AS title,
  CASE WHEN file_id % 7 = 0 AND ordinal % 4 = 3 THEN 'visual_impaired' WHEN (file_id % 5 = 0 AND ordinal IN (2, 4)) OR (file_id % 5 = 1 AND ordinal = 2) THEN 'comment' END AS disposition FROM k""",
)
def _(px):
    t = px("px_streams").where("stream_type = 2").select(F.col("rk").alias("file_id"), "ordinal", F.when(F.col("language_code") == "en", "und").otherwise(F.col("language_code")).alias("lang"))
    kept = t.groupBy("file_id").agg(F.array_sort(F.collect_list("ordinal")).alias("kept"))
    f = F.col("file_id")
    entry = lambda k, name: F.struct(F.lit(k).alias("idx"), F.lit(name).cast("string").alias("title"))
    said = F.transform(F.filter("kept", lambda k: k % 4 == 3), lambda k: F.struct(k.alias("idx"), F.lit("Described").alias("title")))
    manifest = kept.select(
        "file_id", F.when(f % 3 == 0, "deu").otherwise("eng").alias("orig_lang"), F.when(f % 4 == 0, F.array(F.lit(None).cast("string"), F.lit("spa"))).alias("audio_langs"),
        F.when(f % 5 == 0, F.array(entry(2, None), entry(4, "Writers"))).when(f % 5 == 1, F.array(entry(2, None))).alias("commentary"), F.when(f % 7 == 0, said).alias("description"),
    )
    return P.label_audio(kept, t, manifest)


@query(
    "p9_geometry_flags",
    ["px_titles"],
    """SELECT disc, title, sd AS is_sd, title % 4 IN (0, 1) AS interlaced, sd AND disc % 3 = 0 AS abort, CASE WHEN title % 10 = 0 THEN CASE WHEN sd THEN 'SD trailer' ELSE 'HD trailer' END END AS trailer FROM (SELECT *, title % 2 = 0 AND title % 7 < 5 AS sd FROM px_titles)""",
)
def _(px):
    t = F.col("title")
    rows = px("px_titles").withColumns(
        {
            "name": F.when(t % 10 == 0, "Theatrical Trailer").otherwise("Film"), "kind": F.when(F.col("disc") % 3 == 0, "BD").otherwise("DVD"), "width": F.when(t % 2 == 0, 720).otherwise(1920), "height": F.when(t % 7 < 5, 576).otherwise(1080),
            "field_order": F.when(t % 4 == 0, "tt").when(t % 4 == 1, "bb").when(t % 4 == 2, "progressive"),
        }
    )
    return P.geometry_flags(rows).select("disc", "title", "is_sd", "interlaced", "abort", "trailer")


@query(
    "p12_metadata_mismatch",
    ["px_items"],
    f"""SELECT rk, bad_year, bad_runtime, bad_folder FROM (SELECT rk, CASE WHEN rk % 9 = 0 THEN false ELSE rk % 4 = 0 END AS bad_year, abs(rk % 50 * 30) > 600 AS bad_runtime,
  coalesce({_sim("show_name", "folder")} < 0.5, false) AS bad_folder FROM (SELECT *, CASE WHEN rk % 3 = 0 THEN ep_title ELSE show_name END AS folder FROM px_items)) WHERE bad_year OR bad_runtime OR bad_folder""",
)
def _(px):
    rk = F.col("rk")
    rows = px("px_items").select(
        "rk", F.when(rk % 4 == 0, 1998).otherwise(1999).alias("year"), F.when(rk % 9 != 0, F.lit("1999-05-01").cast("date")).alias("aired"), F.col("duration").alias("sec"), (F.col("duration") + rk % 50 * 30).alias("matched_sec"),
        F.col("show").alias("title"), F.when(rk % 3 == 0, F.col("ep_title")).otherwise(F.col("show")).alias("folder"),
    )
    return U.metadata_mismatch(rows).select("rk", "bad_year", "bad_runtime", "bad_folder")


@query(
    "p13_layout_violations",
    ["px_src"],
    f"""SELECT 'movies/' || work AS dir, 'several editions' AS reason FROM ({_FILES}) WHERE kind = 'movie' AND n % 4 = 0 GROUP BY work HAVING count(DISTINCT n % 3) > 1
UNION ALL SELECT DISTINCT 'tv/' || work || '/Featurettes', 'film extras folder' FROM ({_FILES}) WHERE kind = 'tv' AND n % 6 = 0""",
)
def _(px):
    n = F.col("n")
    rows = _files(px).select(
        "kind", F.when(F.col("kind") == "movie", F.concat(F.lit("movies/"), "work")).otherwise(F.concat(F.lit("tv/"), F.col("work"), F.when(n % 6 == 0, "/Featurettes").otherwise("/Season 01"))).alias("dir"),
        F.when(n % 4 == 0, F.format_string("Film {edition-Cut %d}.mkv", n % 3)).otherwise("Film.mkv").alias("name"),
    )
    return P.layout_violations(rows)


@query(
    "j4_truncated_streams",
    ["px_titles"],
    """, m AS (SELECT disc, printf('%05d', title) AS stem, sec FROM px_titles WHERE title % 3 = 0), l AS (SELECT disc, title, sec AS list_sec, title % 10 = 9 AS blind FROM px_titles WHERE title % 3 > 0)
SELECT m.disc, m.stem, printf('%05d', l.title) AS playlist, list_sec, CASE WHEN blind THEN 'UNREADABLE' ELSE 'TRUNCATED' END AS verdict FROM m JOIN l ON m.disc = l.disc AND list_sec > sec + 20 WHERE blind OR m.stem IN (printf('%05d', l.title + 1), printf('%05d', l.title + 2), printf('%05d', l.title - 1))""",
)
def _(px):
    t = px("px_titles")
    name = lambda k: F.format_string("%05d", F.col("title") + k)
    lists = t.where("title % 3 > 0")
    return J.truncated_streams(
        t.where("title % 3 = 0").select("disc", name(0).alias("stem"), "sec"), lists.select("disc", name(0).alias("playlist"), "sec"), lists.select("disc", name(0).alias("playlist"), F.when(F.col("title") % 10 != 9, F.array(name(1), name(2), name(-1), name(1))).alias("clips"))
    )


@query(
    "j4_allowed_streams",
    ["px_titles"],
    """, m AS (SELECT disc, title, disc * 4 + title % 4 AS manifest, printf('%05d', title) AS stem, sec, CASE WHEN title % 3 = 0 THEN title % 15 = 0 END AS ok FROM px_titles WHERE title % 3 < 2), l AS (SELECT disc, title, sec AS list_sec FROM px_titles WHERE title % 3 = 2)
SELECT m.disc, m.stem, printf('%05d', l.title) AS playlist, list_sec, CASE WHEN l.title % 4 = 1 THEN 'UNREADABLE' ELSE 'TRUNCATED' END AS verdict FROM m JOIN l ON m.disc = l.disc AND list_sec > sec + 20
WHERE manifest NOT IN (SELECT manifest FROM m WHERE ok) AND (l.title % 4 = 1 OR m.title IN (l.title - 1, l.title - 2, l.title + 1))""",
)
def _(px):
    """A quarter of the playlists is not on the disc, and manifests with an item that asks for its raw stream pass whole."""
    t = px("px_titles")
    title, name = F.col("title"), lambda k: F.format_string("%05d", F.col("title") + k)
    items = t.where("title % 3 < 2").select("disc", (F.col("disc") * 4 + title % 4).alias("manifest"), name(0).alias("stem"), "sec", F.when(title % 3 == 0, title % 15 == 0).alias("allow_raw_stream"))
    lists = t.where("title % 3 = 2")
    there = lists.where("title % 4 <> 1").select("disc", name(0).alias("playlist"), F.array(name(-1), name(-2), name(1)).alias("clips"))
    return J.truncated_streams(items, lists.select("disc", name(0).alias("playlist"), "sec"), there)


@query(
    "j6_reconcile_durations",
    ["px_titles"],
    """, s AS (SELECT disc, list_sort(list(sec + title % 5 * 9) FILTER (sec + title % 5 * 9 >= 60)) AS c, list_sort(list(sec) FILTER (title % 4 > 0 AND sec >= 60)) AS m FROM px_titles GROUP BY 1),
w AS (WITH RECURSIVE st(disc, i, j, claimed, measured) AS (SELECT disc, 1, 1, NULL::DOUBLE, NULL::DOUBLE FROM s
  UNION ALL SELECT st.disc, CASE WHEN coalesce(m[j] < c[i] - 30, false) THEN i ELSE i + 1 END, CASE WHEN coalesce(m[j] <= c[i] + 30, false) THEN j + 1 ELSE j END,
    CASE WHEN NOT coalesce(m[j] < c[i] - 30, false) THEN c[i] END, CASE WHEN m[j] >= c[i] - 30 AND m[j] <= c[i] + 30 THEN m[j] END FROM st JOIN s USING (disc) WHERE i <= len(c)) SELECT * FROM st)
SELECT disc, claimed, measured FROM w WHERE claimed IS NOT NULL""",
)
def _(px):
    t = px("px_titles")
    return U.reconcile_durations(t.select("disc", (F.col("sec") + F.col("title") % 5 * 9).alias("sec")), t.where("title % 4 > 0").select("disc", "sec"))


_SPECIALS = """SELECT show_name, rk, CASE rk % 7 WHEN 0 THEN 'Episode ' || idx ELSE title END AS title, file, rk % 4 = 1 AS locked, rk * 1000 AS duration_ms, idx AS updated FROM px_agent JOIN (SELECT rk, file FROM px_files) USING (rk)"""
_special = r"""CASE WHEN regexp_matches(title, '(?i)^Episode\s+\d+$') THEN 'placeholder' WHEN t <> '' AND regexp_replace(lower(t), '\W', '', 'g') <> regexp_replace(lower(title), '\W', '', 'g') THEN 'contradicts' WHEN t = '' THEN 'UNVERIFIED' WHEN NOT locked THEN 'NOTE' ELSE 'ok' END"""
_AUDITED = f"""SELECT show_name, rk, {_special} AS verdict, round_even(duration_ms / 60000, 1) AS minutes FROM (SELECT *, coalesce(regexp_extract(file, ' - (.+)\\.[^.]+$', 1), '') AS t FROM ({_SPECIALS}))
 WHERE show_name IN (SELECT show_name FROM ({_SPECIALS}) WHERE updated >= 29)"""


def _specials(px):
    rk = F.col("rk")
    met = px("px_agent").join(px("px_files").select("rk", "file"), "rk")
    rows = met.select("show", "rk", F.when(rk % 7 == 0, F.concat(F.lit("Episode "), "idx")).otherwise(F.col("title")).alias("title"), "file", (rk % 4 == 1).alias("locked"), (rk * 1000).alias("duration_ms"), F.col("idx").alias("updated"))
    return U.audit_specials(rows, since=29)


@query("j12_audit_specials", ["px_agent", "px_files"], f'SELECT show_name AS "show", rk, verdict, minutes FROM ({_AUDITED})')
def _(px):
    return _specials(px)


@query(
    "j12_specials_by_show",
    ["px_agent", "px_files"],
    f"""SELECT show_name AS "show", count(*) AS specials, count(*) FILTER (verdict IN ('placeholder', 'contradicts')) AS faults, count(*) FILTER (verdict = 'UNVERIFIED') AS unverified, count(*) FILTER (verdict = 'NOTE') AS notes FROM ({_AUDITED}) GROUP BY 1""",
)
def _(px):
    return U.specials_by_show(_specials(px))


@query(
    "j13_unindexed_extras",
    ["px_src"],
    """, i AS (SELECT work, rel FROM px_src WHERE ok % 5 > 0 AND ok % 7 > 0), s AS (SELECT work FROM (SELECT work, count(*) AS n FROM px_src GROUP BY 1) JOIN (SELECT work AS w, count(*) AS m FROM i GROUP BY 1) ON w = work WHERE m < n)
SELECT work, replace(rel, '/', '-') AS base FROM px_src WHERE work IN (SELECT work FROM s) AND rel NOT IN (SELECT rel FROM i)""",
)
def _(px):
    name = F.replace("rel", F.lit("/"), F.lit("-"))
    shipped = px("px_src").select("work", F.concat(F.lit("/x/"), name, F.lit(".mkv")).alias("path"))
    indexed = px("px_src").where("ok % 5 > 0").select("work", F.concat(F.lit("D:\\y\\"), name, F.lit(".mp4")).alias("path"), (F.col("ok") % 7 > 0).alias("local"))
    return U.unindexed_extras(shipped, indexed)


@query(
    "j15_compare_orderings",
    ["px_canon"],
    """SELECT show_name AS "show", 0 AS season, idx, CASE WHEN ok % 4 > 0 THEN 'T' || ok END AS title_a, CASE WHEN ok % 5 > 0 THEN 'T' || (ok - CASE WHEN ok % 3 = 0 THEN 1 ELSE 0 END) END AS title_b FROM px_canon
WHERE (ok % 4 > 0 OR ok % 5 > 0) AND (ok % 4 = 0 OR ok % 5 = 0 OR ok % 3 = 0)""",
)
def _(px):
    ok = F.col("ok")
    row = lambda o, n: px("px_canon").select("show", F.lit(0).alias("season"), "idx", "ok", F.lit(o).alias("ordering"), F.concat(F.lit("T"), n).alias("title"))
    return J.compare_orderings(row("aired", ok).where("ok % 4 > 0").unionByName(row("dvd", ok - F.when(ok % 3 == 0, 1).otherwise(0)).where("ok % 5 > 0")), "aired", "dvd")


@query("j17_match_by_basename", ["px_src"], "SELECT s.ok AS rk, d.rel AS rel FROM px_src s JOIN px_src d ON s.rel = d.rel WHERE s.ok % 3 = 0 AND d.ok % 2 = 1")
def _(px):
    name = F.replace("rel", F.lit("/"), F.lit("-"))
    agent = px("px_src").where("ok % 3 = 0").select(F.col("ok").alias("rk"), F.concat(F.lit("Z:\\tv\\"), name).alias("file"))
    listing = px("px_src").where("ok % 2 = 1").select(F.concat(F.lit("tv/"), name).alias("rel"))
    return U.match_by_basename(agent, listing).select("rk", F.replace(F.substring("rel", 4, 1 << 20), F.lit("-"), F.lit("/")).alias("rel"))


_MARKS = f"""SELECT file_id, cue AS landmark, start_s + CASE file_id % 3 WHEN 0 THEN 0.5 WHEN 1 THEN 200.0 + cue ELSE 400.0 END AS t, CASE WHEN cue % 4 = 3 THEN 'no such line' ELSE substr(text, 1, 25) END AS line FROM ({_CUES}) WHERE cue % 5 IN (0, 3)"""
_ERRORS = f"""SELECT m.file_id, landmark, arg_min(c.start_s - t, (abs(c.start_s - t), c.start_s)) FILTER (c.start_s IS NOT NULL) AS error FROM ({_MARKS}) m LEFT JOIN ({_CUES}) c ON c.file_id = m.file_id AND contains(lower(c.text), lower(line)) GROUP BY 1, 2"""


def _errors(px):
    cues = _cues(px)
    f, cue = F.col("file_id"), F.col("cue")
    off = F.when(f % 3 == 0, 0.5).when(f % 3 == 1, 200.0 + cue).otherwise(400.0)
    marks = cues.where("cue % 5 in (0, 3)").select("file_id", cue.alias("landmark"), (F.col("start_s") + off).alias("t"), F.when(cue % 4 == 3, "no such line").otherwise(F.substring("text", 1, 25)).alias("line"))
    return J.nearest_cue(cues, marks)


@query("j18_nearest_cue", [], _ERRORS)
def _(px):
    return _errors(px)


@query(
    "j18_landmark_verdict",
    [],
    f"""SELECT file_id, n, lo, hi, CASE WHEN n < 2 THEN 'too few' WHEN abs(lo) <= 1 AND abs(hi) <= 1 THEN 'correct' WHEN hi - lo <= 1 THEN 'pure shift' ELSE 'different cut' END AS verdict FROM (SELECT file_id, count(error) AS n, min(error) AS lo, max(error) AS hi FROM ({_ERRORS}) GROUP BY 1)""",
)
def _(px):
    return J.landmark_verdict(_errors(px))


@query("j19_awaiting_sidecar", ["px_src"], "SELECT rel AS base, CASE WHEN ok % 5 = 0 THEN 'ENCODING' ELSE 'AWAITING' END AS verdict FROM px_src WHERE ok % 3 > 0 AND ok % 4 > 0")
def _(px):
    ok, src = F.col("ok"), px("px_src")
    media = src.select(F.col("rel").alias("base"), (ok % 3 > 0).alias("populated"), F.when(ok % 5 > 0, 100.0).alias("dur"))
    return J.awaiting_sidecar(media, src.where("ok % 4 = 0").select(F.col("rel").alias("base"))).select("base", "verdict")


@query(
    "j20_orphan_sidecars",
    [],
    f"""SELECT file_id, CASE WHEN file_id % 4 = 0 THEN 'NO MEDIA' WHEN abs(file_id % 3 * 100.0) > 120 THEN 'FAR FROM END' ELSE 'ok' END AS verdict FROM (SELECT DISTINCT file_id FROM ({_CUES}))""",
)
def _(px):
    spans = A.cue_span(_cues(px))
    media = spans.where("file_id % 4 > 0").select("file_id", (F.col("last_end") + F.col("file_id") % 3 * 100.0).alias("dur"))
    return J.orphan_sidecars(spans, media).select("file_id", "verdict")


@query(
    "j23_verify_stream_copy",
    ["px_streams"],
    """, o AS (SELECT rk, count(*) FILTER (rk % 3 = 0 AND ordinal = 2) AS lost, bool_or(true) AS there FROM px_streams WHERE rk % 5 > 0 GROUP BY 1)
SELECT DISTINCT s.rk AS file_id, CASE WHEN o.rk IS NULL OR NOT EXISTS (SELECT 1 FROM px_streams x WHERE x.rk = s.rk AND NOT (x.rk % 3 = 0 AND x.ordinal = 2)) THEN 'MISSING' WHEN lost = 0 AND s.rk % 7 > 0 THEN 'ok' ELSE 'DIFFERS' END AS verdict FROM px_streams s LEFT JOIN o ON o.rk = s.rk""",
)
def _(px):
    rk = F.col("rk")
    kind = F.when(F.col("stream_type") == 3, "subtitle").when(F.col("stream_type") == 2, "audio").otherwise("video")
    src = px("px_streams").select(rk.alias("file_id"), F.lit(100.0).alias("sec"), kind.alias("type"), "ordinal")
    out = src.where("file_id % 5 > 0 and not (file_id % 3 = 0 and ordinal = 2)").withColumn("sec", F.when(F.col("file_id") % 7 > 0, 100.9).otherwise(103.0))
    return U.verify_stream_copy(src, out)


@query(
    "j25_playall_containment",
    ["px_titles"],
    """, t AS (SELECT disc, title, sec, title % 6 AS place, title - title % 6 AS reel FROM px_titles), r AS (SELECT disc, title AS reel, sec AS reel_sec FROM t WHERE place = 0),
p AS (SELECT t.disc, t.reel, t.title, t.sec, t.place, reel_sec, (t.title % 5 > 0 AND t.place < 5) AS inside FROM t JOIN r USING (disc, reel) WHERE place > 0),
s AS (SELECT disc, reel, any_value(reel_sec) AS reel_sec, count(*) AS parts, count(*) FILTER (inside) AS inside, count(*) FILTER (inside AND place * 240.0 * 3 >= reel_sec * 2) AS late, sum(sec) AS parts_sec FROM p GROUP BY 1, 2)
SELECT disc, reel, parts, inside, late, round_even(reel_sec - parts_sec, 3) AS excess, CASE WHEN inside = parts AND late > 0 THEN 'CONTAINED' WHEN inside > 0 THEN 'PARTLY' ELSE 'APART' END AS verdict FROM s""",
)
def _(px):
    t = px("px_titles").select("disc", "title", "sec", (F.col("title") % 6).alias("place"), (F.col("title") - F.col("title") % 6).alias("reel"))
    own = t.where("place > 0").select("disc", "title", F.lit(0.0).alias("offset_s"), F.when((F.col("title") % 5 > 0) & (F.col("place") < 5), F.format_string("r%d-%d", "reel", "place")).otherwise(F.format_string("own%d", "title")).alias("h"))
    # The reel plays its parts one after another, 240 s each.
    reel = t.where("place = 0").select("disc", "title", F.explode(F.sequence(F.lit(1), F.lit(4))).alias("k")).select("disc", "title", (F.col("k") * 240.0).alias("offset_s"), F.format_string("r%d-%d", "title", "k").alias("h"))
    return J.playall_containment(t, t.where("place > 0").select("disc", "reel", "title"), own.unionByName(reel))


@query("j26_staged_without_manifest", ["px_src"], "SELECT DISTINCT 'disk ' || work AS folder FROM px_src WHERE work NOT IN (SELECT work FROM px_src WHERE ok % 1000 IN (7, 102, 229))")
def _(px):
    """Manifests read a title file in the folder, a Blu-ray's stream far below it, or the folder as a whole disc."""
    folder, mark = F.concat(F.lit("disk "), "work"), F.col("ok") % 1000
    below = F.when(mark == 102, "/BDMV/STREAM/00001.m2ts").when(mark == 229, "").otherwise("\\t00.mkv")
    read = px("px_src").where(mark.isin(7, 102, 229, 500)).select(F.concat(F.when(mark == 500, "F:/other/").otherwise("E:\\Stage\\"), folder, below).alias("src"))
    return U.staged_without_manifest(px("px_src").select(folder.alias("folder")), read, "E:\\stage")


@query(
    "j28_track_identity",
    [],
    f"""SELECT conv_id AS file_id, turn AS track, CASE WHEN said IS NULL THEN 'UNHEARD' WHEN same > 1 THEN 'SAME LINES' WHEN hints >= 2 THEN 'COMMENTARY?' ELSE 'dialogue' END AS verdict FROM (
SELECT *, count(said) OVER (PARTITION BY conv_id, trim({_norm("said")})) AS same, CASE turn % 3 WHEN 1 THEN 3 ELSE 0 END AS hints FROM (SELECT conv_id, turn, CASE WHEN turn % 5 = 4 THEN NULL WHEN turn % 4 = 3 THEN 'Come here!' WHEN turn % 3 = 1 THEN 'We shot the scene with a camera ' || turn ELSE 'line ' || turn END AS said FROM conversations))""",
)
def _(px):
    turn = F.col("track")
    c = px.spark.table("conversations").select(F.col("conv_id").alias("file_id"), F.col("turn").alias("track"))
    said = F.when(turn % 4 == 3, F.when(turn % 8 == 3, "Come here!").otherwise("come HERE")).when(turn % 3 == 1, F.concat(F.lit("We shot the scene with a camera "), turn)).otherwise(F.concat(F.lit("line "), turn))
    return U.track_identity(c, c.where("track % 5 < 4").select("file_id", "track", F.lit("en").alias("heard"), said.alias("text")))


_FUNCTION = ", ".join(f"'{w}'" for w in A.ENGLISH)
_ELSEWHERE = ", ".join(f"'{w}'" for w in A.FOREIGN)
_tokens = "regexp_extract_all(lower(line), '[a-zà-ÿ]+')"


@query(
    "a2_ocr_gates",
    [],
    rf"""WITH l AS (SELECT doc_id AS file_id, n_chars, unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL),
k AS (SELECT *, regexp_matches(line, '^\d+\s*$') AS digits, trim(line) AS t FROM l), m AS (SELECT *, t <> '' AND NOT digits AND NOT contains(line, '-->') AS said, regexp_matches(line, '^\s*[\(\[][^\)\]]{{2,}}[\)\]]\s*$') AS sound FROM k),
b AS (SELECT file_id, any_value(n_chars) AS n_chars, count(*) + count(*) FILTER (digits) AS cues, count(*) AS total, count(*) FILTER (said) AS lines, count(*) FILTER (said AND (length(t) <= 2 OR length(regexp_replace(t, '[^\p{{L}} ]', '', 'g')) / length(t) < 0.65)) AS junk,
  count(*) FILTER (said AND NOT sound) AS judgeable, count(*) FILTER (said AND NOT sound AND len(list_filter({_tokens}, lambda w: w IN ({_FUNCTION}))) > 0) AS english, count(*) FILTER (said AND len(list_filter({_tokens}, lambda w: w IN ({_ELSEWHERE}))) > 0) AS foreign_ FROM m GROUP BY 1),
w AS (SELECT file_id, trim(unnest(regexp_extract_all(line, '[A-Za-z][A-Za-z'']{{2,}}')), '''') AS w FROM m WHERE said AND NOT sound),
d AS (SELECT DISTINCT lower(unnest(regexp_extract_all(text, '[A-Za-z'']+'))) AS word FROM conversations),
tk AS (SELECT file_id, count(*) AS tokens, count(*) FILTER (lower(w) IN (SELECT word FROM d) OR string_split(lower(w), '''')[1] IN (SELECT word FROM d)) AS known FROM w WHERE length(w) >= 3 AND regexp_matches(w, '^[a-z]') GROUP BY 1),
x AS (SELECT b.*, coalesce(tokens, 0) AS tokens, CASE WHEN coalesce(tokens, 0) > 0 THEN round_even(100 * known / tokens, 1) ELSE 0.0 END AS dict_pct, CASE WHEN lines > 0 THEN round_even(100 * junk / lines, 0) ELSE 100.0 END AS junk_pct,
  CASE WHEN judgeable > 0 THEN round_even(100 * english / judgeable, 0) ELSE 0.0 END AS english_pct, CASE WHEN lines > 0 THEN round_even(100 * foreign_ / lines, 0) ELSE 0.0 END AS foreign_pct, n_chars / 15.0::DOUBLE AS sec FROM b LEFT JOIN tk USING (file_id)),
f AS (SELECT *, CASE WHEN sec / 60 > 5 THEN floor(sec / 60 / 4) ELSE greatest(1, least(5, floor(sec / 15))) END AS f0 FROM x), g AS (SELECT *, CASE WHEN cues < f0 THEN least(f0, greatest(1, ceil(total / 2))) ELSE f0 END AS fl FROM f)
SELECT file_id, cues, lines, junk_pct, english_pct, foreign_pct, tokens, dict_pct, CASE WHEN cues < fl THEN 'too few cues' WHEN junk_pct > 30 THEN 'junk' WHEN judgeable >= 10 AND english_pct < 15 THEN 'function words' WHEN judgeable < 10 AND foreign_pct >= 25 THEN 'foreign words'
  WHEN judgeable < 10 AND tokens >= 3 AND dict_pct < 85 THEN 'dictionary (short)' WHEN judgeable >= 10 AND tokens >= 200 AND dict_pct < 95 THEN 'dictionary' ELSE 'ok' END AS verdict FROM g""",
)
def _(px):
    docs = px("px_cues").where("text is not null")
    lines = F.split("text", "\n", -1)
    numbered = F.transform(lines, lambda x, i: F.concat((i + 1).cast("string"), F.lit("\n00:00:01,000 --> 00:00:02,000\n"), x))
    words = px.spark.table("conversations").select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z']+"), F.lit(0))).alias("word"))
    return A.ocr_gates(docs.select("file_id", F.array_join(numbered, "\n").alias("text")), docs.select("file_id", (F.col("n_chars") / 15.0).alias("sec"), F.size(lines).alias("max_packets")), words)


@query(
    "a6_audio_review",
    ["px_streams"],
    """, t AS (SELECT rk AS file_id, ordinal, CASE WHEN ordinal % 3 = 0 THEN 'Main' END AS title, CASE WHEN ordinal % 4 > 0 THEN -20 - ordinal % 2 END AS mean_db FROM px_streams),
s AS (SELECT *, CASE WHEN mean_db IS NULL THEN 1 ELSE count(*) OVER (PARTITION BY file_id, mean_db) END AS same FROM t), r AS (SELECT file_id, count(*) AS tracks, count(*) FILTER (title IS NULL) AS untitled, count(*) FILTER (same > 1) AS alike FROM s GROUP BY 1)
SELECT *, CASE WHEN alike > 0 THEN 'DUPLICATE?' WHEN untitled > 0 AND tracks > 1 THEN 'UNTITLED' ELSE 'ok' END AS verdict FROM r""",
)
def _(px):
    o = F.col("ordinal")
    return U.audio_review(px("px_streams").select(F.col("rk").alias("file_id"), F.when(o % 3 == 0, "Main").alias("title"), F.when(o % 4 > 0, -20 - o % 2).alias("mean_db"), F.lit(-1.5).alias("max_db")))


@query(
    "a9_crop_vote",
    ["px_packets"],
    """, c AS (SELECT file_id, CASE CAST(pts / 0.032 AS INT) % 3 WHEN 0 THEN CASE WHEN file_id % 4 = 0 THEN '700:400:1:1' ELSE '1920:817:1:131' END WHEN 1 THEN '1920:800:0:140' ELSE CASE WHEN file_id % 2 = 0 THEN '1919:1061:3:5' ELSE '1920:817:1:131' END END AS crop FROM px_packets),
m AS (SELECT file_id, crop FROM (SELECT file_id, crop, row_number() OVER (PARTITION BY file_id ORDER BY count(*) DESC, crop) AS p FROM c GROUP BY 1, 2) WHERE p = 1)
SELECT file_id, CASE crop WHEN '1920:817:1:131' THEN '1920:817:0:130' WHEN '1920:800:0:140' THEN '1920:800:0:140' WHEN '1919:1061:3:5' THEN '1919:1061:2:4' ELSE '1440:1080:240:0' END AS crop, crop = '700:400:1:1' AS defaulted FROM m""",
)
def _(px):
    k, f = F.bround(F.col("pts").cast("double") / 0.032, 0).cast("int") % 3, F.col("file_id")
    odd = F.lit("1920:817:1:131")
    crop = F.when(k == 0, F.when(f % 4 == 0, "700:400:1:1").otherwise(odd)).when(k == 1, "1920:800:0:140").otherwise(F.when(f % 2 == 0, "1919:1061:3:5").otherwise(odd))
    return A.crop_vote(px("px_packets").select("file_id", crop.alias("crop")))


@query(
    "a16_playlist_runtime",
    ["px_titles"],
    """, c AS (SELECT disc, title, CASE WHEN title % 13 = 0 THEN NULL ELSE CASE WHEN title % 4 = 0 THEN 1.5 ELSE sec END END AS sec FROM px_titles), e AS (SELECT disc, title - title % 5 AS playlist, sum(sec) FILTER (sec > 2.0) AS total, count(*) FILTER (sec <= 2.0) AS idents, count(*) FILTER (sec IS NULL) AS unknown FROM c GROUP BY 1, 2)
SELECT disc, playlist, 5000.0 AS expected, total, idents, unknown, round_even(total - 5000.0, 3) AS excess FROM e""",
)
def _(px):
    t = px("px_titles")
    lists = t.groupBy("disc", (F.col("title") - F.col("title") % 5).alias("playlist")).agg(F.lit(5000.0).alias("expected"), F.array_sort(F.collect_list("title")).alias("clips"))
    clips = t.where("title % 13 > 0").select("disc", F.col("title").alias("clip"), F.when(F.col("title") % 4 == 0, 1.5).otherwise(F.col("sec")).alias("sec"))
    return U.playlist_runtime(lists, clips)


_PALETTES = "SELECT disc, 1000000 + pk * 7919 % 15000000 AS rgb, title % 4 AS k, title, pk FROM px_titles"
_lum = lambda c: f"(0.299 * ({c} >> 16) + 0.587 * (({c} >> 8) % 256) + 0.114 * ({c} % 256))"


@query(
    "a21_ink_weight",
    ["px_titles"],
    f""", e AS (SELECT disc, k, min(rgb) AS rgb, count(*) * 50 + k AS n FROM ({_PALETTES}) GROUP BY 1, 2), v AS (SELECT *, {_lum("rgb")} AS l FROM e WHERE NOT (k = 3 AND disc % 3 = 0)),
w AS (SELECT *, l - min(l) OVER (PARTITION BY disc) > 32 AS ink, count(*) OVER (PARTITION BY disc) AS seen FROM v),
f AS (SELECT disc, arg_max(n, (l, k)) AS fill_n, arg_max(k, (l, k)) AS fill_k, arg_max(rgb, (l, k)) AS fill_rgb, sum(n) AS total, count(*) AS inks, any_value(seen) AS seen FROM w WHERE ink GROUP BY 1),
r AS (SELECT d.disc, CASE WHEN seen >= 2 AND inks >= 2 AND fill_n > 0 THEN (total - fill_n) / fill_n END AS ratio, 100 * (total - fill_n) // fill_n AS q, 2 * (100 * (total - fill_n) % fill_n) - fill_n AS over, (SELECT count(*) FROM w WHERE w.disc = d.disc AND ink AND k <> fill_k AND rgb <> fill_rgb) AS changed FROM (SELECT DISTINCT disc FROM px_titles) d LEFT JOIN f USING (disc))
SELECT disc, CASE WHEN ratio IS NOT NULL THEN (q + CASE WHEN over > 0 OR (over = 0 AND q % 2 = 1) THEN 1 ELSE 0 END) / 100 END AS ratio, CASE WHEN ratio IS NULL OR ratio < 0.15 OR changed = 0 THEN 'skip' ELSE 'repair' END AS verdict FROM r""",
)
def _(px):
    t = px("px_titles").select("disc", (F.col("title") % 4).alias("k"), (1000000 + F.col("pk") * 7919 % 15000000).cast("int").alias("rgb"))
    of = t.groupBy("disc").agg(*(F.min(F.when(F.col("k") == k, F.col("rgb"))).alias(f"c{k}") for k in range(4)), *(F.count_if(F.col("k") == k).alias(f"n{k}") for k in range(4)))
    idx = F.array(*(F.when(F.col(f"n{k}") > 0, F.lit(k)) for k in range(4)))
    seen = F.array(*(F.when(F.lit(k == 3) & (F.col("disc") % 3 == 0) | (F.col(f"n{k}") == 0), 0).otherwise(15) for k in range(4)))
    return A.ink_weight(of.select("disc", F.array(*(F.col(f"c{k}") for k in range(4))).alias("palette"), idx.alias("pal_idx"), seen.alias("alpha"), F.array(*(F.col(f"n{k}") * 50 + k for k in range(4))).alias("hist")))


@query(
    "w3_best_card_frame",
    [],
    f"""WITH f AS (SELECT p_partkey AS file_id, CASE WHEN p_partkey % 9 = 0 THEN '' ELSE p_name || ' part ii' END AS title, t, CASE t WHEN 0 THEN p_type WHEN 1 THEN upper(p_name) WHEN 2 THEN CASE WHEN p_partkey % 2 = 0 THEN p_name || ' II' ELSE 'x' END ELSE lower(p_name) END AS read FROM part, (SELECT unnest(range(0, 4)) AS t)),
s AS (SELECT file_id, title, t, {_card_score("title", "read")} AS score FROM f), b AS (SELECT file_id, title, max(score) AS score, arg_min(t, (-score, t)) AS t FROM s GROUP BY 1, 2)
SELECT file_id, score, CASE WHEN score > 0 THEN t END AS t, CASE WHEN title = '' THEN 'SKIP' WHEN score >= 0.6 THEN 'OK' ELSE 'MISMATCH' END AS verdict FROM b""",
)
def _(px):
    part, k, t = px.spark.table("part"), F.col("p_partkey"), F.col("t")
    files = part.select(k.alias("file_id"), F.when(k % 9 == 0, "").otherwise(F.concat("p_name", F.lit(" part ii"))).alias("title"))
    read = F.when(t == 0, F.col("p_type")).when(t == 1, F.upper("p_name")).when(t == 2, F.when(k % 2 == 0, F.concat("p_name", F.lit(" II"))).otherwise("x")).otherwise(F.lower("p_name"))
    frames = part.withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(3)))).select(k.alias("file_id"), "t", read.alias("text"))
    return W.best_card_frame(frames, files)


@query(
    "w6_append_specials",
    ["px_canon"],
    """, n AS (SELECT show_name, 'n' || ok AS name FROM px_canon WHERE ok % 3 = 0), l AS (SELECT show_name, max(idx) AS last FROM px_canon WHERE ok % 3 > 0 GROUP BY 1)
SELECT show_name AS "show", name, coalesce(last, 0) + row_number() OVER (PARTITION BY show_name ORDER BY name) AS idx FROM n LEFT JOIN l USING (show_name)""",
)
def _(px):
    c = px("px_canon")
    return W.append_specials(c.where("ok % 3 > 0").select("show", "idx"), c.where("ok % 3 = 0").select("show", F.concat(F.lit("n"), "ok").alias("name")))


@query(
    "w8_rename_plan",
    ["px_canon"],
    """SELECT show_name AS "show", season, idx, idx + shift AS new_idx, row_number() OVER (PARTITION BY show_name, season ORDER BY CASE WHEN shift > 0 THEN -idx ELSE idx END) AS step
FROM (SELECT show_name, ok % 4 AS season, idx, CASE ok % 4 WHEN 1 THEN 2 WHEN 2 THEN -1 END AS shift FROM px_canon) WHERE shift IS NOT NULL""",
)
def _(px):
    files = px("px_canon").select("show", (F.col("ok") % 4).alias("season"), "idx")
    shifts = files.select("show", "season").distinct().where("season in (1, 2)").withColumn("shift", F.when(F.col("season") == 1, 2).otherwise(-1))
    return W.rename_plan(files, shifts).select("show", "season", "idx", "new_idx", "step")


@query(
    "w13_double_slot_files",
    ["px_canon"],
    """, a AS (SELECT show_name, idx, ok, mins * 60 AS slot, lead(mins * 60) OVER (PARTITION BY show_name ORDER BY idx) AS next FROM px_canon), f AS (SELECT *, CASE WHEN ok % 3 = 0 THEN slot + next + ok % 5 * 100 - 100 ELSE slot END AS sec FROM a)
SELECT show_name AS "show", 1 AS season, idx, printf('E%02d-E%02d', idx, idx + 1) AS form FROM f WHERE abs(sec - slot - next) <= 180 AND abs(sec - slot) > 180""",
)
def _(px):
    c = px("px_canon").select("show", F.lit(1).alias("season"), "idx", "ok", (F.col("mins") * 60).alias("sec"))
    after = F.lead("sec").over(Window.partitionBy("show").orderBy("idx"))
    files = c.withColumn("sec", F.when(F.col("ok") % 3 == 0, F.col("sec") + after + F.col("ok") % 5 * 100 - 100).otherwise(F.col("sec"))).drop("ok")
    return U.double_slot_files(files, c.drop("ok"))


_ATTEMPTS = "SELECT l_orderkey AS rk, l_linenumber AS detector, CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE l_partkey % 80 - 40.0 END AS offset_s FROM lineitem"


@query(
    "w14_first_plausible",
    [],
    f"""WITH t AS (SELECT DISTINCT ON (rk, detector) * FROM ({_ATTEMPTS}) ORDER BY rk, detector, offset_s NULLS FIRST), g AS (SELECT rk, min(detector) FILTER (abs(offset_s) < 30) AS good, max(detector) AS last FROM t GROUP BY 1)
SELECT t.rk, t.detector, t.offset_s AS "offset" FROM t JOIN g ON t.rk = g.rk AND t.detector = coalesce(good, last)""",
)
def _(px):
    tried = px.spark.sql(_ATTEMPTS).groupBy("rk", "detector").agg(F.min_by(F.struct("offset_s"), F.struct(F.col("offset_s").isNotNull(), "offset_s")).alias("x"))
    return W.first_plausible(tried.select("rk", "detector", F.col("x.offset_s").cast("double").alias("offset")))


@query("o3_missing_names", ["px_src"], "SELECT ok FROM px_src EXCEPT ALL SELECT ok FROM px_src WHERE bytes % 3 = 0")
def _(px):
    return J.missing_names(px("px_src").select("ok"), px("px_src").where("bytes % 3 = 0").select("ok"))


@query(
    "o5_empty_folders",
    ["px_src"],
    """SELECT 'f/' || ok AS folder FROM (SELECT DISTINCT ok FROM px_src) WHERE ok % 4 > 0 AND ok % 5 > 0 AND ok % 3 > 0 AND ok % 7 > 0""",
)
def _(px):
    now = dt.datetime(2024, 1, 2, tzinfo=dt.UTC)
    ok = F.col("ok")
    made = px("px_src").select("ok").distinct()
    folders = made.select(F.concat(F.lit("f/"), ok).alias("folder"), F.lit("f").alias("parent"), (ok % 7 > 0).alias("listed"), F.when(ok % 3 > 0, F.lit("2024-01-01").cast("timestamp")).otherwise(F.lit("2024-01-01 23:58:00").cast("timestamp")).alias("modified"))
    inner = made.where("ok % 5 = 0").select(F.concat(F.lit("f/"), ok, F.lit("/x")).alias("folder"), F.concat(F.lit("f/"), ok).alias("parent"), F.lit(False).alias("listed"), F.lit("2024-01-01").cast("timestamp").alias("modified"))
    return W.empty_folders(folders.unionByName(inner), made.where("ok % 4 = 0").select(F.concat(F.lit("f/"), ok).alias("folder")), now).select("folder")
