"""Queries of the composite jobs, each with the same in DuckDB SQL."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from shelfwright.jobs import composite
from shelfwright.jobs.check_queries import _FILES, _FUNCTION, _SPECIALS, _files, _special
from shelfwright.jobs.queries import _CUES, _GUARD, ORACLE_SQL, _cues, query
from shelfwright.jobs.source_queries import _SRC, _hms, _log, _numbered, _said, _two, _written
from shelfwright.operators import aggregates as A, predicates as P
from shelfwright.session import in_slices, new_path, stored
from shelfwright.sources import readers as S, writers as K
from shelfwright.sources.state import StateTable


@query(
    "c1_subtitle_search",
    ["px_items", "px_media", "px_candidates", "px_log", "px_cues"],
    _GUARD.strip()
    + f""", need AS (SELECT rk FROM px_items i WHERE NOT EXISTS (SELECT 1 FROM px_media s WHERE s.rk = i.rk AND stream_type = 3 AND codec IN ('srt', 'ass') AND forced IS NOT TRUE AND starts_with(lower(coalesce(nullif(language_code, ''), language, '')), 'en'))
  AND rk NOT IN (SELECT rk FROM px_log WHERE event_id % 7 = 0)),
k AS (SELECT *, row_number() OVER (PARTITION BY rk ORDER BY score DESC, provider_rank, cand_id) AS place FROM g WHERE rk IN (SELECT rk FROM need)),
sp AS (SELECT file_id AS f, max(end_s) * 60 AS last_end, count(*) * 10 AS cues FROM ({_CUES}) GROUP BY 1),
b AS (SELECT k.*, CASE WHEN coalesce(cues, 0) < 20 THEN NULL WHEN last_end / duration BETWEEN 0.85 AND 1.02 THEN 'fit' WHEN last_end / duration BETWEEN 1.021 AND 1.075 OR last_end / duration BETWEEN 0.930 AND 0.975 THEN 'rescale' END AS band
  FROM k JOIN px_items USING (rk) LEFT JOIN sp ON sp.f = cand_id % (SELECT max(file_id) + 1 FROM px_cues) WHERE place <= 6),
r AS (SELECT rk, count(*) AS tried, min(place) FILTER (band IS NOT NULL) AS p FROM b GROUP BY 1)
SELECT need.rk, b.cand_id, b.place, b.band, CASE WHEN r.p IS NOT NULL THEN 'kept' WHEN r.tried > 0 THEN 'none fits' ELSE 'no candidate' END AS verdict
FROM need LEFT JOIN r ON r.rk = need.rk LEFT JOIN b ON b.rk = need.rk AND b.place = r.p""",
)
def _(px):
    return composite.subtitle_search(px("px_items"), px("px_media"), px("px_log").where("event_id % 7 = 0").select("rk"), *_search_args(px))


def _search_args(px, wanted=None):
    """Candidates, block list and spans; with wanted (rk), those of its items, stored for all that reads them."""
    candidates = px("px_candidates")
    if wanted is not None:
        candidates = stored(candidates.join(wanted, "rk", "left_semi"), "candidates")
    block = px("px_items").where("rk % 50 = 7").select(F.col("rk").cast("string").alias("key"), F.lit("bluray").alias("pattern"))
    of = A.cue_span(_cues(px)).select(F.col("file_id").alias("f"), (F.col("last_end") * 60).alias("last_end"), (F.col("cues") * 10).alias("cues"))
    docs = px("px_cues").agg((F.max("file_id") + 1).alias("docs"))  # one row
    ids = candidates.select("cand_id").distinct().crossJoin(docs).withColumn("f", F.col("cand_id") % F.col("docs")).drop("docs")
    spans = ids.join(of, "f").drop("f")
    return candidates, block, spans if wanted is None else stored(spans, "spans")


_NOW, _BEFORE = dt.datetime(2024, 5, 1), dt.datetime(2024, 4, 1)
_C1 = ORACLE_SQL["c1_subtitle_search"].split("\nSELECT need.rk")[0]


@query(
    "c1_search_resumed",
    [],
    _C1
    + """, k6 AS (SELECT b.*, r.p AS fit FROM b JOIN r USING (rk) WHERE place <= coalesce(r.p, 6))
SELECT need.rk, CASE WHEN count(k6.rk) = 0 THEN 'no_candidates' WHEN any_value(fit) IS NOT NULL THEN 'matched' ELSE 'no_match' END AS r, CASE WHEN count(k6.rk) > 0 THEN count(k6.rk) END AS tried,
  any_value(title) FILTER (place = fit) AS kept, any_value(k6.band) FILTER (place = fit) AS kind FROM need LEFT JOIN k6 USING (rk) GROUP BY 1""",
)
def _(px):
    """The same search as a job with state that runs in instalments; one of them stops before its commit."""
    state = StateTable(px.spark, new_path(px.spark, "state"), composite.STATE.format(key="long"))
    known = px("px_log").where("event_id % 7 = 0").select("rk").distinct()
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in state.schema.fields if f.name not in ("rk", "r", "ts")]
    state.commit(known.select("rk", F.lit("matched").alias("r"), *none, F.lit(_BEFORE).alias("ts")), "before")
    items, log = px("px_items"), new_path(px.spark, "log")
    # Stored, as each instalment reads them: the streams' windows run once, the candidates' over the items that are open.
    media = stored(px("px_media").where("stream_type = 3").select("rk", "stream_type", "codec", "language_code", "language", "forced"), "media")
    wanted = stored(P.needs_subtitles(items, media).join(state.read(), "rk", "left_anti").select("rk"), "wanted")
    args = [items, media, *_search_args(px, wanted), _NOW]
    half = wanted.count() // 2 + 1
    composite.subtitle_search_job(state, *args, log=log, limit=half)
    state.staged(known.select("rk", F.lit("lost").alias("r"), *none, F.lit(_NOW).alias("ts")))
    while composite.subtitle_search_job(state, *args, log=log, limit=half) > state.version():
        pass
    done = state.read().where(F.col("ts") == F.lit(_NOW))
    return done.select("rk", "r", F.size("tried").cast("long").alias("tried"), "kept", "kind")


_GATE = ORACLE_SQL["a14_disc_gate"]


@query("c2_disc_accounting", ["px_titles", "px_dispositions"], ", d AS" + _GATE.split(", d AS", 1)[1])
def _(px):
    t = px("px_titles")
    discs = t.select("disc").distinct().withColumn("min_length", F.when(F.col("disc") % 10 == 9, F.lit(None)).when(F.col("disc") % 10 == 8, 120).otherwise(10))
    return composite.disc_accounting(t, px("px_dispositions"), discs)[0]


_CONV = "SELECT conv_id AS file_id, turn AS cue, turn * 3.0 AS start_s, CASE WHEN turn % 6 = 5 THEN ' ' ELSE '|' || text END AS text FROM conversations"


def _published(px):
    c, texts, probes, media, local, remote = _publish_args(px)
    return composite.ocr_publish(c, texts, probes, None, media, local, remote)


def _publish_args(px):
    c = px.spark.table("conversations").select(F.col("conv_id").alias("file_id"), F.col("turn").alias("cue"), (F.col("turn") * 3.0).alias("start_s"), (F.col("turn") * 3.0 + 2).alias("end_s"), "text")
    texts = c.select("file_id", "cue", F.when(F.col("cue") % 6 == 5, " ").otherwise(F.concat(F.lit("|"), "text")).alias("text"))
    files = c.select("file_id").distinct()
    f = F.col("file_id")
    probes = files.select("file_id", F.lit(30.0).alias("sec"), F.lit(2).alias("max_packets"))
    media = files.select(f.alias("base"), (f % 3 > 0).alias("populated"), F.when(f % 5 > 0, 60.0).alias("dur"))
    local = files.select(F.floor(f / 8).alias("work"), F.concat(F.lit("r"), f).alias("rel"), f.alias("base"), (f * 7).alias("bytes"))
    remote = local.where("base % 2 = 0").select("rel", (F.col("bytes") + F.when(F.col("base") % 4 == 0, 1).otherwise(0)).alias("bytes"))
    return c.drop("text"), texts, probes, media, local, remote


# Without a dictionary the gates see cues, junk and function words; every text here has a bar in front that becomes an I.
_PASSED = rf"""m AS (SELECT file_id, cue, row_number() OVER (PARTITION BY file_id ORDER BY cue) AS n, 'I' || substr(text, 2) AS text FROM ({_CONV}) WHERE trim(text) <> ''),
l AS (SELECT file_id, unnest(string_split(replace(text, '|', 'I'), chr(10))) AS line FROM m), k AS (SELECT *, trim(line) AS t, regexp_matches(line, '^\d+\s*$') AS digits FROM l),
b AS (SELECT file_id, count(DISTINCT n) AS cues FROM m GROUP BY 1), j AS (SELECT file_id, count(*) FILTER (digits) AS more, count(*) FILTER (t <> '' AND NOT digits) AS lines, count(*) FILTER (t <> '' AND NOT digits AND (length(t) <= 2 OR length(regexp_replace(t, '[^\p{{L}} ]', '', 'g')) / length(t) < 0.65)) AS junk,
  count(*) FILTER (t <> '' AND NOT digits AND NOT regexp_matches(line, '^\s*[\(\[][^\)\]]{{2,}}[\)\]]\s*$')) AS judgeable, count(*) FILTER (t <> '' AND NOT digits AND NOT regexp_matches(line, '^\s*[\(\[][^\)\]]{{2,}}[\)\]]\s*$') AND len(list_filter(regexp_extract_all(lower(line), '[a-zà-ÿ]+'), lambda w: w IN ({_FUNCTION}))) > 0) AS english FROM k GROUP BY 1),
g AS (SELECT file_id, CASE WHEN cues + more < CASE WHEN cues + more < 2 THEN 1 ELSE 2 END THEN 'too few cues' WHEN round_even(100 * junk / lines, 0) > 30 THEN 'junk' WHEN judgeable >= 10 AND round_even(100 * english / judgeable, 0) < 15 THEN 'function words' ELSE 'ok' END AS verdict FROM b JOIN j USING (file_id)),
f AS (SELECT DISTINCT conv_id AS file_id FROM conversations), h AS (SELECT f.file_id, f.file_id % 3 > 0 AND coalesce(verdict, '') <> 'ok' AS held, f.file_id % 2 = 1 OR f.file_id % 4 = 0 AS needs FROM f LEFT JOIN g USING (file_id)),
w AS (SELECT file_id // 8 AS work, bool_or(needs) AS needs, bool_or(held) AS hold FROM h GROUP BY 1)"""


@query("c3_ocr_gates", [], f"WITH {_PASSED} SELECT file_id, verdict FROM g")
def _(px):
    return _published(px)[1].select("file_id", "verdict")


@query("c3_ocr_cues", [], f"WITH {_PASSED} SELECT file_id, n, md5(replace(text, '|', 'I')) AS digest FROM m JOIN g USING (file_id) WHERE verdict = 'ok'")
def _(px):
    return _published(px)[0].select("file_id", "n", F.md5("text").alias("digest"))


@query("c3_ocr_status", [], f"WITH {_PASSED} SELECT work, CASE WHEN needs AND hold THEN 'BLOCKED' WHEN needs THEN 'READY' ELSE 'DONE' END AS verdict FROM w")
def _(px):
    return _published(px)[2].select("work", "verdict")


@query("c3_ocr_plan", [], f"WITH {_PASSED} SELECT 'r' || file_id AS rel FROM h JOIN w ON work = file_id // 8 WHERE w.needs AND NOT w.hold AND h.needs")
def _(px):
    return _published(px)[3].select("rel")


#: Each word of a document as a cue, so that there are enough of them.
_WORDS = _CUES.replace("chr(10)", "' '")
_TRACKS = f"SELECT file_id AS rk, CASE WHEN file_id % 2 = 0 THEN 1 ELSE 2 END AS ordinal, cue, start_s * 12 AS start_s, end_s * 12 AS end_s, text FROM ({_WORDS})"


def _resynced(px):
    return composite.resync(*_resync_args(px))


def _resync_args(px):
    f = F.col("file_id")
    words = px("px_cues").select("file_id", F.posexplode(F.split("text", " ", -1)).alias("cue", "text")).withColumns({"start_s": F.col("cue") * 4.0, "end_s": F.col("cue") * 4.0 + 2.5})
    cues = words.select(f.alias("rk"), F.when(f % 2 == 0, 1).otherwise(2).alias("ordinal"), "cue", (F.col("start_s") * 12).alias("start_s"), (F.col("end_s") * 12).alias("end_s"), "text")
    counts = stored(cues.groupBy("rk", "ordinal").agg(F.count("*").alias("cues"), (F.max("start_s") * 1.01).alias("dur")), "counts")  # the texts are split once for all that is read from it
    rk = F.col("rk")
    tracks = counts.select("rk", "ordinal", "cues", (rk % 7 == 0).alias("forced")).unionByName(counts.select("rk", (3 - F.col("ordinal")).alias("ordinal"), (F.col("cues") - 1).alias("cues"), (rk % 7 < 2).alias("forced")))
    alignments = counts.where("rk % 5 < 4").select("rk", F.when(rk % 5 == 0, 59.0).when(rk % 5 == 1, 2.0).when(rk % 5 == 2, 0.05).otherwise(-1.5).alias("offset"), F.lit(1.0).alias("scale"))
    anchors = counts.select(rk.alias("file_id"), "dur", (rk % 4 / 10.0).alias("oa"), F.when(rk % 11 > 0, rk % 3 / 10.0).alias("ob"))
    return tracks, cues, alignments, anchors


_RESYNC = f"""WITH c AS ({_TRACKS}), n AS (SELECT rk, any_value(ordinal) AS own, count(*) AS cues, max(start_s) * 1.01::DOUBLE AS dur FROM c GROUP BY 1),
p AS (SELECT *, rk % 7 = 0 AS forced1, CASE WHEN rk % 7 = 0 THEN NULL ELSE own END AS picked, CASE rk % 5 WHEN 0 THEN 'align_railed' WHEN 1 THEN 'refine' WHEN 2 THEN 'already_aligned' WHEN 3 THEN 'refine' ELSE 'align_fail' END AS v, CASE rk % 5 WHEN 0 THEN 59.0 WHEN 1 THEN 2.0 WHEN 2 THEN 0.05 WHEN 3 THEN -1.5 END AS off,
  rk % 4 / 10.0::DOUBLE AS oa, CASE WHEN rk % 11 > 0 THEN rk % 3 / 10.0::DOUBLE END AS ob FROM n),
x AS (SELECT rk, count(*) FILTER (start_s < 0.3 * dur) AS na, count(*) FILTER (start_s >= 0.7 * dur AND start_s < dur) AS nb, avg(start_s) FILTER (start_s < 0.3 * dur) AS ta, avg(start_s) FILTER (start_s >= 0.7 * dur AND start_s < dur) AS tb FROM c JOIN p USING (rk) WHERE v = 'refine' AND picked IS NOT NULL GROUP BY 1),
f AS (SELECT p.*, ta, tb, CASE WHEN v = 'refine' AND picked IS NOT NULL THEN CASE WHEN cues < 80 THEN 'too_few_cues' WHEN na < 30 THEN 'sparse_a' WHEN nb < 30 THEN 'sparse_b' WHEN ob IS NULL THEN 'anchor_b_failed' WHEN abs(ob - oa) > 5 OR tb - ta < 300 THEN 'anchors_inconsistent' ELSE 'ok' END END AS reason FROM p LEFT JOIN x USING (rk)),
s AS (SELECT rk, CASE WHEN picked IS NULL THEN 'no_usable_sub' WHEN v = 'refine' THEN CASE WHEN reason = 'ok' THEN 'resynced' ELSE 'needs_review' END ELSE v END AS r, off AS "offset", CASE WHEN v = 'refine' THEN coalesce(reason, 'too_few_cues') END AS why,
  CASE WHEN reason = 'ok' THEN round_even(1 + (ob - oa) / (tb - ta), 6) END AS scale2, CASE WHEN reason = 'ok' THEN round_even(oa - ((ob - oa) / (tb - ta)) * ta, 4) END AS shift FROM f)"""


@query("c4_resync_state", [], f"{_RESYNC} SELECT * FROM s")
def _(px):
    return _resynced(px)[0]


@query("c4_resync_cues", [], f"{_RESYNC} SELECT rk, ordinal, cue, round_even(greatest(start_s * scale2 + shift, 0), 4) AS start_s FROM c JOIN s USING (rk) WHERE r = 'resynced'")
def _(px):
    return _resynced(px)[1].select("rk", "ordinal", "cue", F.bround("start_s", 4).alias("start_s"))


@query("c4_resync_resumed", [], f"{_RESYNC} SELECT rk, r, why, shift FROM s WHERE rk % 13 > 0")
def _(px):
    """The same correction as a job with state, in two runs, over the items that a search has matched."""
    tracks, cues, alignments, anchors = _resync_args(px)
    rk = F.col("rk")
    found = tracks.select("rk").distinct().select("rk", F.concat(F.lit("l"), rk).alias("label"), F.when(rk % 13 == 0, "no_match").otherwise("matched").alias("r"))
    state = StateTable(px.spark, new_path(px.spark, "state"), composite.RESYNC.format(key="long"))
    composite.resync_job(state, found, tracks, cues, alignments, anchors, _NOW, limit=found.count() // 2)
    composite.resync_job(state, found, tracks, cues, alignments, anchors, _NOW)
    return state.read().select("rk", "r", "why", "shift")


_IDENTITY = r""", c AS (SELECT show_name, 1 + ok % 2 AS season, idx, 'T' || ok AS title, mins, ok FROM px_canon), f AS (SELECT ok AS rk, show_name, season, idx, mins + ok % 5 AS file_mins, CASE WHEN ok % 6 = 0 THEN '' ELSE title END AS title,
  CASE WHEN ok % 8 > 0 THEN 'S S' || season || 'E' || idx || ' - ' || title || '.mkv' END AS file FROM c),
d AS (SELECT rk, c.idx, abs(file_mins - c.mins) AS d, row_number() OVER (PARTITION BY rk ORDER BY abs(file_mins - c.mins), c.idx) AS p FROM f JOIN c USING (show_name, season)),
t AS (SELECT rk, min(idx) FILTER (p = 1) AS near_idx, round_even(min(d), 1) AS delta, max(d) FILTER (p = 2) AS d2 FROM d WHERE p <= 2 GROUP BY 1)
SELECT f.rk AS file_id, show_name AS "show", season, f.idx, near_idx, CASE WHEN delta > 3 THEN 'NO CLOSE MATCH' WHEN (CASE WHEN d2 IS NULL THEN 99.0 ELSE round_even(d2 - delta, 1) END) < 1 THEN 'AMBIGUOUS' ELSE 'ok' END AS runtime,
  CASE WHEN file IS NULL THEN 'NOFILE' ELSE 'OK' END AS slot, CASE WHEN title = '' THEN 'SKIP' WHEN rk % 3 = 0 OR rk < 10 THEN 'MISMATCH' ELSE 'OK' END AS card, rk % 4 = 0 AS torn FROM f JOIN t USING (rk)"""


@query("c5_episode_identity", ["px_canon"], _IDENTITY)
def _(px):
    ok = F.col("ok")
    c = px("px_canon").select("show", (1 + ok % 2).alias("season"), "idx", F.concat(F.lit("T"), ok).alias("title"), "mins", "ok")
    orderings = c.withColumn("ordering", F.lit("aired")).unionByName(c.withColumns({"ordering": F.lit("dvd"), "title": F.when(ok % 4 == 0, "other").otherwise(F.col("title"))}))
    name = F.concat(F.lit("S S"), F.col("season"), F.lit("E"), F.col("idx"), F.lit(" - "), F.col("title"), F.lit(".mkv"))
    files = c.select(ok.alias("file_id"), "show", "season", "idx", F.when(ok % 6 == 0, "").otherwise(F.col("title")).alias("title"), (F.col("mins") + ok % 5).alias("file_mins"), F.when(ok % 8 > 0, name).alias("file"))
    agent = c.select(ok.alias("rk"), "show", "season", "idx", "title")
    frames = c.select(ok.alias("file_id"), F.lit(1).alias("t"), F.when(ok % 3 > 0, F.concat(F.lit("the "), F.lower("title"))).otherwise("nothing").alias("text"))
    return composite.episode_identity(orderings, "aired", "dvd", files, agent, frames)[0]


_MANIFEST = """, t AS (SELECT rk AS file_id, rk // 8 AS disc, 1960 + rk % 60 AS year, show_name, season, ep, ep_title, CASE WHEN rk % 2 = 0 THEN 'BD' ELSE 'DVD' END AS kind, printf('%05d', rk % 40) AS clip, rk % 8 = 0 AS sd, CASE rk % 6 WHEN 0 THEN 'deu' END AS orig, CASE rk % 4 WHEN 0 THEN 'none' WHEN 1 THEN 'deu' END AS sub, rk % 40 < 10 AND rk // 8 % 9 = 3 AS short FROM px_items),
s AS (SELECT file_id, min(ordinal) FILTER (language_code = coalesce(sub, 'eng')) AS o, count(ordinal) AS n FROM t LEFT JOIN (SELECT * FROM px_streams WHERE stream_type = 3) ON rk = file_id GROUP BY 1),
b AS (SELECT file_id, 'truncated stream' AS reason FROM t WHERE short UNION ALL SELECT file_id, 'standard source as BD' FROM t WHERE sd AND kind = 'BD' UNION ALL SELECT file_id, 'no such subtitle' FROM t JOIN s USING (file_id) WHERE coalesce(sub, 'eng') <> 'none' AND o IS NULL AND n > 0)"""


def _manifested(px):
    return composite.manifest(*_manifest_args(px), "/tv", "E:\\rips", "Disk {disc}")


def _manifest_args(px):
    rk = F.col("rk")
    sd = rk % 8 == 0
    table = px("px_items").select(
        rk.alias("file_id"), F.floor(rk / 8).alias("disc"), (1960 + rk % 60).alias("year"), "show", "season", "ep", F.col("ep_title").alias("name"), F.when(rk % 2 == 0, "BD").otherwise("DVD").alias("kind"), F.format_string("%05d", rk % 40).alias("clip"), F.lit(100.0).alias("sec"),
        F.when(sd, 720).otherwise(1920).alias("width"), F.when(sd, 576).otherwise(1080).alias("height"), F.lit("progressive").alias("field_order"), F.when(rk % 6 == 0, "deu").alias("orig_lang"), F.when(rk % 4 == 0, "none").when(rk % 4 == 1, "deu").alias("sub_track"),
    )
    streams = px("px_streams").where("stream_type > 1").select(rk.alias("file_id"), "ordinal", F.when(F.col("stream_type") == 3, "subtitle").otherwise("audio").alias("kind"), F.col("language_code").alias("lang"))
    one = table.where("disc % 9 = 3").select("disc").distinct()
    clips = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda k: F.format_string("%05d", k))
    return table, streams, one.select("disc", F.lit("00800").alias("playlist"), clips.alias("clips")), one.select("disc", F.lit("00800").alias("playlist"), F.lit(500.0).alias("sec"))


@query("c6_manifest_aborts", ["px_items", "px_streams"], f"{_MANIFEST} SELECT * FROM b")
def _(px):
    return _manifested(px)[1]


@query(
    "c6_manifest",
    ["px_items", "px_streams"],
    f"""{_MANIFEST}, a AS (SELECT rk AS file_id, ordinal, language_code AS lang, CASE WHEN orig = 'deu' AND language_code = 'deu' THEN 0 WHEN language_code IN ('eng', 'en') THEN 1 END AS r FROM px_streams JOIN t ON rk = file_id WHERE stream_type = 2),
k AS (SELECT file_id, list(ordinal ORDER BY ordinal) AS every, list(lang ORDER BY ordinal) AS every_lang, list(ordinal ORDER BY r, ordinal) FILTER (r IS NOT NULL) AS fit, list(lang ORDER BY r, ordinal) FILTER (r IS NOT NULL) AS fit_lang FROM a GROUP BY 1),
m AS (SELECT file_id, CASE WHEN len(every) = 1 OR fit IS NULL THEN every ELSE fit END AS o, CASE WHEN len(every) = 1 OR fit IS NULL THEN every_lang ELSE fit_lang END AS l FROM k)
SELECT file_id, '/tv/' || show_name || ' (' || year || printf(')/Season %02d/', season) || show_name || ' (' || year || printf(') - S%02dE%02d - ', season, ep) || ep_title || '.mkv' AS out, 'E:/rips/Disk ' || disc || CASE WHEN kind = 'BD' THEN '/BDMV/STREAM/' || clip || '.m2ts' ELSE '' END AS src,
  CASE WHEN coalesce(sub, 'eng') <> 'none' THEN o2 END AS sub_track, array_to_string(m.o, ',') AS tracks, array_to_string(CASE WHEN orig = 'deu' THEN list_concat(['deu'], m.l[2:]) ELSE m.l END, ',') AS langs
FROM t JOIN (SELECT file_id, o AS o2 FROM s) USING (file_id) LEFT JOIN m USING (file_id) WHERE file_id NOT IN (SELECT file_id FROM b)""",
)
def _(px):
    rows = _manifested(px)[0]
    return rows.select("file_id", "out", "src", F.col("subTrack").cast("int").alias("sub_track"), F.array_join("audioTracks", ",").alias("tracks"), F.array_join("audioLangs", ",").alias("langs"))


_LISTED = f"SELECT rel, kind, work, grp, ext, bytes, ok, n FROM ({_FILES})"


@query(
    "c7_library_audit",
    ["px_src", "px_agent", "px_files", "px_streams"],
    f""", l AS ({_LISTED}), p AS (SELECT *, CASE kind WHEN 'tv' THEN row_number() OVER (PARTITION BY kind, work, grp ORDER BY rel) ELSE row_number() OVER (PARTITION BY kind, work ORDER BY bytes DESC, rel) END AS place FROM l WHERE ext = 'MKV'),
y AS (SELECT work, list_sort(list(bytes)) AS b FROM l GROUP BY 1), z AS (SELECT l.*, b[least(CAST(round_even(len(b) / 2, 0) AS INT), len(b) - 1) + 1] AS med FROM l JOIN y USING (work)),
st AS (SELECT rel, CASE WHEN NOT (round_even(bytes / 1048576, 2) < 20 OR (round_even(bytes / med, 3) < 0.25 AND med > 50 * 1048576)) THEN 'ok' WHEN ok % 7 = 0 THEN 'STUB unreadable' WHEN ok % 40 < CASE kind WHEN 'tv' THEN 0.2 ELSE 30 END / 3 THEN 'STUB' WHEN ok % 40 < CASE kind WHEN 'tv' THEN 0.2 ELSE 30 END THEN 'SUSPECT' ELSE 'ok(small)' END AS verdict FROM z),
sp AS (SELECT verdict FROM (SELECT {_special} AS verdict FROM (SELECT *, coalesce(regexp_extract(file, ' - (.+)[.][^.]+$', 1), '') AS t FROM ({_SPECIALS})))),
ix AS (SELECT work, rel FROM px_src WHERE ok % 5 > 0), au AS (SELECT rk, count(*) AS n FROM px_streams GROUP BY 1)
SELECT 'subtitles' AS "check", CASE WHEN ok % 4 > 0 THEN 'YES' ELSE 'partial' END AS verdict, count(*) AS n FROM p WHERE place = 1 AND ok % 3 > CASE WHEN ok % 4 = 0 THEN 1 ELSE 0 END GROUP BY 1, 2
UNION ALL SELECT 'stub', verdict, count(*) FROM st WHERE NOT starts_with(verdict, 'ok') GROUP BY 1, 2 UNION ALL SELECT 'special', verdict, count(*) FROM sp WHERE verdict NOT IN ('ok', 'NOTE') GROUP BY 1, 2
UNION ALL SELECT 'extra', 'not indexed', count(*) FROM px_src WHERE ok % 5 = 0 HAVING count(*) > 0
UNION ALL SELECT 'layout', 'film extras folder', count(DISTINCT work) FROM l WHERE kind = 'tv' HAVING count(*) > 0 UNION ALL SELECT 'audio', 'UNTITLED', count(*) FROM au WHERE n > 1 HAVING count(*) > 0""",
)
def _(px):
    ok, n = F.col("ok"), F.col("n")
    folder = F.concat(F.lit("m/"), F.col("work"), F.when(F.col("kind") == "tv", "/Scenes").otherwise(""))
    listing = _files(px).withColumns({"file_id": F.col("rel"), "dir": folder, "name": F.lit("Film.mkv"), "created": F.lit("2024-01-01").cast("timestamp")})
    image = _files(px).select("rel", F.explode(F.sequence(F.lit(0), ok % 3)).alias("k")).where("k > 0").select("rel", F.lit("hdmv_pgs_subtitle").alias("codec"))
    text = _files(px).where("ok % 4 = 0").select("rel", F.lit("subrip").alias("codec"))
    probes = _files(px).where("ok % 7 > 0").select(F.col("rel").alias("file_id"), (ok % 40 * 60.0).alias("sec"))
    rk = F.col("rk")
    met = px("px_agent").join(px("px_files").select("rk", "file"), "rk")
    agent = met.select("show", "rk", F.when(rk % 7 == 0, F.concat(F.lit("Episode "), "idx")).otherwise(F.col("title")).alias("title"), "file", (rk % 4 == 1).alias("locked"), (rk * 1000).alias("duration_ms"), F.col("idx").alias("updated"))
    path = F.concat(F.lit("/x/"), F.replace("rel", F.lit("/"), F.lit("-")), F.lit(".mkv"))
    shipped = px("px_src").select("work", path.alias("path"), "ok")
    tracks = px("px_streams").select(rk.alias("file_id"), F.lit(None).cast("string").alias("title"), F.lit(None).cast("double").alias("mean_db"), F.lit(None).cast("double").alias("max_db"))
    findings, _ = composite.library_audit(listing, image.unionByName(text), probes, agent, shipped.drop("ok"), shipped.where("ok % 5 > 0").drop("ok").withColumn("local", F.lit(True)), tracks)
    return A.verdict_counts(findings, "check", "verdict")


@query(
    "c2_accounting_files",
    ["px_src"],
    f""", t AS (SELECT 'disc' || work AS disc, n AS title, ({_hms})::DOUBLE AS sec FROM ({_SRC})), p AS (SELECT 'disc' || work AS disc, n // 2 AS title, max(n) AS last FROM ({_SRC}) WHERE n % 7 > 0 GROUP BY work, n // 2),
u AS (SELECT disc, count(*) AS missing, count(*) FILTER (sec > 0) AS timed FROM t ANTI JOIN p USING (disc, title) GROUP BY 1), b AS (SELECT disc, count(*) AS bad FROM p WHERE last % 2 = 1 AND (last % 3 = 0 OR last < 100) GROUP BY 1), c AS (SELECT disc, count(*) AS catalogued FROM t GROUP BY 1)
SELECT disc, catalogued, coalesce(missing, 0) AS missing, coalesce(timed, 0) AS labelled, coalesce(bad, 0) AS bad, CASE WHEN missing > 0 THEN 'missing titles' WHEN bad > 0 THEN 'bad reasons' ELSE 'ACCOUNTED' END AS verdict FROM c LEFT JOIN u USING (disc) LEFT JOIN b USING (disc)""",
)
def _(px):
    """From logs, decisions and playlists on disk to the gate and the catalogues, which are read back: the files of a slice of the discs
    after another, then all discs at once."""
    n, out = F.col("n"), new_path(px.spark, "catalogue")
    entry = _said("t", _two(F.floor(n / 2)), "|", F.when(n % 2 == 0, "Encode").otherwise("EXCLUDE"), F.when(n % 3 == 0, "").otherwise(_said("| note ", n, " ")))
    name = lambda ending: F.concat(F.lit("disc"), F.col("work").cast("string"), F.lit(ending))

    def read(rows):
        at = f"{out}/part={uuid.uuid4().hex}"
        decisions = _written(px, rows.where("n % 7 > 0"), name(".dispositions.txt"), entry, ["n"], "\r\n")
        lists = _written(px, rows.where("n < 5"), name("/BDMV/PLAYLIST/00001.mpls"), F.format_string("%05dM2TS", n), ["n"], "#")
        discs = composite.read_discs(px.spark, _log(px, rows), decisions, f"{lists}/*/BDMV/PLAYLIST/*.mpls", at)
        return *discs, S.read_catalogue(px.spark, at, lines=True)[0].groupBy("disc").agg(F.count("*").alias("catalogued"))

    *discs, kept = in_slices(_numbered(px).select("work", "n", "bytes"), "work", read, "discs")
    gate, missing, _ = composite.account_discs(*discs)
    labels = missing.groupBy("disc").agg(F.count("label").alias("labelled"))
    met = gate.join(kept, "disc", "left").join(labels, "disc", "left")
    return met.select("disc", "catalogued", "missing", F.coalesce("labelled", F.lit(0).cast("long")).alias("labelled"), "bad", "verdict")


@query("c3_published_files", [], f"WITH {_PASSED} SELECT file_id || '.srt' AS rel, 'OK' AS verdict FROM g WHERE verdict = 'ok'")
def _(px):
    """From a text file for each picture to subtitle files, verified byte by byte against the folder."""
    path, out = new_path(px.spark, "readings"), new_path(px.spark, "published")
    c, texts, probes, media, local, remote = _publish_args(px)
    at = F.concat("file_id", F.lit("/cue_"), F.lpad(F.col("cue").cast("string"), 4, "0"), F.lit(".txt"))
    # Dealt out, as the table is a few partitions of many texts.
    K.write_files(texts.select(at.alias("name"), F.col("text").alias("content")).repartition(4 * px.spark.sparkContext.defaultParallelism, "name"), path)
    files = lambda df: df.withColumn("file_id", F.col("file_id").cast("string"))
    return composite.ocr_publish_job(px.spark, path, files(c), files(probes), None, media, local, remote, out)[1].select("rel", "verdict")


@query(
    "c6_manifest_files",
    [],
    "SELECT kind, out, src, sub_track::VARCHAR AS sub_track, tracks, langs FROM (SELECT *, CASE WHEN file_id % 2 = 0 THEN 'BD' ELSE 'DVD' END AS kind FROM (" + ORACLE_SQL["c6_manifest"] + "))",
)
def _(px):
    """From the pipe table on disk to manifests on disk, which are read back."""
    table, streams, playlists, lists = _manifest_args(px)
    path, out = new_path(px.spark, "table"), new_path(px.spark, "manifests")
    table.write.option("sep", "|").option("header", True).csv(path)
    composite.manifest_job(px.spark, path, streams, playlists, lists, out, "/tv", "E:\\rips", "Disk {disc}")
    return S.read_manifest(px.spark, out, lines=True).select("kind", "out", "src", F.col("subTrack").alias("sub_track"), F.array_join("audioTracks", ",").alias("tracks"), F.array_join("audioLangs", ",").alias("langs"))
