"""The library's queries over the driver's tables, each with the same in DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwright.functions import text as T
from shelfwright.jobs.proxies import register, view, with_parts
from shelfwright.operators import aggregates as A, predicates as P, ranking as W, reconcile as J
from shelfwright.session import stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


class Proxies:
    """The proxies of the tables that a session has registered, by name."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def __call__(self, name: str) -> DataFrame:
        return view(self.spark, name)


def query(name: str, views: list[str], sql: str):
    """Registers make(px) -> DataFrame under name, px giving a proxy by its name, and its SQL over the same proxies."""

    def add(make):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            register(spark, sf_dir)
            return make(Proxies(spark))

        QUERIES[name] = run
        ORACLE_SQL[name] = f"WITH {with_parts(views, 'MATERIALIZED ')}\n{sql}" if views else sql  # sql may go on with further parts
        return make

    return add


_REAL = "has_video AND sec > 15 AND NOT (phantom AND sec < 120)"
_REELS = "SELECT round_even(sec, 3) AS sec3, count(DISTINCT disc) AS discs FROM px_titles WHERE sec < 600 GROUP BY 1 HAVING count(DISTINCT disc) >= 3"
_LABELS = f""", b AS ({_REELS}), r AS (SELECT *, {_REAL} AS real FROM px_titles WHERE sec > 0),
o AS (SELECT *, row_number() OVER (PARTITION BY disc, real ORDER BY sec DESC, title) AS place FROM r),
s AS (SELECT disc, max(sec) FILTER (real AND place = 2) AS second FROM o GROUP BY 1),
m AS (SELECT disc, list_sort(list(sec) FILTER (real AND place > 1)) AS l FROM o GROUP BY 1),
md AS (SELECT disc, CASE WHEN len(l) > 0 THEN l[least(CAST(round_even(len(l) / 2, 0) AS INT), len(l) - 1) + 1] ELSE 0 END AS med FROM m),
lab AS (SELECT o.disc, o.title, o.sec, CASE WHEN NOT real THEN 'ARTIFACT' WHEN round_even(o.sec, 3) IN (SELECT sec3 FROM b) THEN 'BOILERPLATE'
  WHEN place = 1 AND o.sec >= 1.5 * second THEN 'PLAYALL?' WHEN coalesce(med, 0) > 0 AND abs(o.sec - med) <= 0.25 * med THEN 'EPISODE?' ELSE 'REVIEW' END AS label FROM o JOIN s USING (disc) LEFT JOIN md USING (disc))
"""


@query("a3_boilerplate_durations", ["px_titles"], _REELS)
def _(px):
    return P.boilerplate_durations(px("px_titles"))


@query("p3_classify_probed_titles", ["px_titles"], _LABELS.strip().rstrip() + "SELECT * FROM lab")
def _(px):
    return P.classify_probed_titles(px("px_titles"))


@query("j1_unaccounted_titles", ["px_titles", "px_dispositions"], "SELECT t.disc, t.title, t.sec FROM px_titles t ANTI JOIN px_dispositions d ON t.disc = d.disc AND t.title = d.title")
def _(px):
    return J.unaccounted_titles(px("px_titles"), px("px_dispositions")).select("disc", "title", "sec")


@query("undecided_by_label", ["px_titles", "px_dispositions"], _LABELS.strip() + "SELECT label, count(*) AS n FROM lab ANTI JOIN px_dispositions d ON lab.disc = d.disc AND lab.title = d.title GROUP BY 1")
def undecided_by_label(px):
    """C2's question: which titles on which discs has nobody decided, and what are they?"""
    return A.verdict_counts(J.unaccounted_titles(P.classify_probed_titles(px("px_titles")), px("px_dispositions")), "label")


_BAD = r"kind = 'exclude' AND (length(trim(note)) < 8 OR regexp_matches(lower(trim(note)), '^(too short|short|duplicate|dupe|not needed|n/?a|junk|skip)\.?$'))"


@query("p10_bad_exclusions", ["px_dispositions"], f"SELECT disc, title, note FROM px_dispositions WHERE {_BAD}")
def _(px):
    return P.bad_exclusions(px("px_dispositions")).select("disc", "title", "note")


@query("a10_verdict_counts", ["px_dispositions"], "SELECT kind, note, count(*) AS n FROM px_dispositions GROUP BY 1, 2")
def _(px):
    return A.verdict_counts(px("px_dispositions"), "kind", "note")


@query(
    "a14_disc_gate",
    ["px_titles", "px_dispositions"],
    f""", d AS (SELECT disc, CASE WHEN disc % 10 = 9 THEN NULL WHEN disc % 10 = 8 THEN 120 ELSE 10 END AS min_length FROM px_titles GROUP BY 1),
  u AS (SELECT t.disc, count(*) AS missing FROM px_titles t ANTI JOIN px_dispositions p ON t.disc = p.disc AND t.title = p.title GROUP BY 1),
  b AS (SELECT disc, count(*) AS bad FROM px_dispositions WHERE {_BAD} GROUP BY 1)
SELECT disc, min_length, coalesce(missing, 0) AS missing, coalesce(bad, 0) AS bad, CASE WHEN min_length IS NULL THEN 'no catalogue' WHEN min_length > 10 THEN 'enumeration floor'
  WHEN coalesce(missing, 0) > 0 THEN 'missing titles' WHEN coalesce(bad, 0) > 0 THEN 'bad reasons' ELSE 'ACCOUNTED' END AS verdict FROM d LEFT JOIN u USING (disc) LEFT JOIN b USING (disc)""",
)
def _(px):
    t, d = px("px_titles"), px("px_dispositions")
    discs = t.select("disc").distinct().withColumn("min_length", F.when(F.col("disc") % 10 == 9, F.lit(None)).when(F.col("disc") % 10 == 8, 120).otherwise(10))
    return A.disc_gate(discs, J.unaccounted_titles(t, d), P.bad_exclusions(d))


@query("j24_duplicate_prompts", ["px_titles"], "SELECT disc, sec, min(title) AS first_title, count(*) AS titles, 'REVIEW' AS verdict FROM px_titles GROUP BY 1, 2 HAVING count(*) > 1")
def _(px):
    return J.duplicate_prompts(px("px_titles"))


@query("j9_raw_stream_duplicates", ["px_titles"], "SELECT disc, title, sec FROM px_titles r WHERE title % 2 = 1 AND EXISTS (SELECT 1 FROM px_titles l WHERE l.title % 2 = 0 AND l.disc = r.disc AND round_even(l.sec, 0) = round_even(r.sec, 0))")
def _(px):
    return J.raw_stream_duplicates(px("px_titles").withColumn("is_playlist", F.col("title") % 2 == 0))


@query(
    "a5_shared_soundtracks",
    ["px_titles"],
    "SELECT disc, md5_no AS audio_md5, count(*) AS n, min(title) AS first_title, max(title) AS last_title FROM px_titles WHERE title % 3 > 0 GROUP BY 1, 2 HAVING count(*) > 1",
)
def _(px):
    return A.shared_soundtracks(px("px_titles").withColumnRenamed("md5_no", "audio_md5").withColumn("probe_scope", F.when(F.col("title") % 3 > 0, "title").otherwise("clip")))


@query("w4_longest_titles", ["px_titles"], "SELECT disc, title, sec, place FROM (SELECT *, row_number() OVER (PARTITION BY disc ORDER BY sec DESC, title) AS place FROM px_titles) WHERE place <= 3")
def _(px):
    return W.longest_titles(px("px_titles")).select("disc", "title", "sec", "place")


@query(
    "w5_commentary_positions",
    ["px_titles"],
    "SELECT disc, title, audio FROM (SELECT *, lag(audio) OVER w AS b, lead(audio) OVER w AS a FROM px_titles WINDOW w AS (PARTITION BY disc ORDER BY title)) WHERE audio = a + 1 AND audio = b + 1",
)
def _(px):
    return W.commentary_positions(px("px_titles"))


@query(
    "j22_verify_rips",
    ["px_titles"],
    "SELECT disc, title, sec, CASE WHEN title % 5 <> 0 THEN sec + title % 4 * 2 END AS got, CASE WHEN title % 5 = 0 THEN 'NO FILE' WHEN title % 4 * 2 > 3 THEN 'CHECK' WHEN title % 13 > 0 AND title % 11 = 3 THEN 'SIZE' ELSE 'ok' END AS verdict FROM px_titles",
)
def _(px):
    t = px("px_titles")
    k = F.col("title")
    made = t.where("title % 5 <> 0").select("disc", "title", (F.col("sec") + k % 4 * 2).alias("sec"), ((k % 7 + F.when(k % 11 == 3, 40).otherwise(0)) .cast("long") * 104_857_600).alias("bytes"))
    size = F.when(k % 13 > 0, F.concat(((k % 7) / 10).cast("string"), F.lit(" GB")))
    return J.verify_rips(t.select("disc", "title", "sec", size.alias("size_text")), made).select("disc", "title", "sec", "got", "verdict")


@query(
    "p1_needs_subtitles",
    ["px_items", "px_media"],
    "SELECT rk, show_name AS \"show\" FROM px_items i WHERE NOT EXISTS (SELECT 1 FROM px_media s WHERE s.rk = i.rk AND stream_type = 3 AND codec IN ('srt', 'ass') AND forced IS NOT TRUE AND starts_with(lower(coalesce(nullif(language_code, ''), language, '')), 'en'))",
)
def _(px):
    return P.needs_subtitles(px("px_items"), px("px_media")).select("rk", "show")


@query(
    "a23_library_subtitle_stats",
    ["px_items", "px_streams"],
    """, k AS (SELECT CASE WHEN t IS NULL THEN 'none' WHEN t THEN 'text' ELSE 'image only' END AS kind FROM px_items LEFT JOIN
  (SELECT rk, bool_or(codec IN ('srt', 'ass')) AS t FROM px_streams WHERE stream_type = 3 GROUP BY 1) USING (rk))
SELECT kind, count(*) AS n, round_even(100 * count(*) / (SELECT count(*) FROM k), 2) AS pct FROM k GROUP BY 1""",
)
def _(px):
    return A.library_subtitle_stats(px("px_items"), px("px_streams"), P.TEXT_CODECS)


@query(
    "a23_sketched_shares",
    ["px_items", "px_streams"],
    """SELECT season % 2 AS part, CASE WHEN t IS NULL THEN 'none' WHEN t THEN 'text' ELSE 'image only' END AS kind, count(*) AS n, true AS within FROM px_items LEFT JOIN
  (SELECT rk, bool_or(codec IN ('srt', 'ass')) AS t FROM px_streams WHERE stream_type = 3 GROUP BY 1) USING (rk) GROUP BY 1, 2""",
)
def _(px):
    """Each library's sketches stored, then merged: every item is in two libraries. The estimate lies within three standard errors of the count."""
    items = px("px_items")
    libraries = items.withColumn("library", F.col("season")).unionByName(items.withColumn("library", F.col("season") + 100)).withColumn("part", F.col("season") % 2)
    sketches = stored(A.subtitle_sketches(libraries, px("px_streams"), P.TEXT_CODECS, ["part", "library"]), "sketches")
    exact = A.subtitle_kinds(items, px("px_streams"), P.TEXT_CODECS).groupBy((F.col("season") % 2).alias("part"), "kind").agg(F.count("*").alias("exact"))
    met = exact.join(A.sketched_shares(sketches, ["part"]), ["part", "kind"])
    return met.select("part", "kind", F.col("exact").alias("n"), (F.abs(F.col("n") - F.col("exact")) <= 0.05 * F.col("exact") + 1).alias("within"))


@query("w2_pick_subtitle", ["px_media"], "SELECT rk, ordinal, row_number() OVER (PARTITION BY rk ORDER BY cues DESC, ordinal DESC) = 1 AS picked FROM px_media WHERE forced IS NOT TRUE")
def _(px):
    return W.pick_subtitle(px("px_media")).select("rk", "ordinal", "picked")


_KEEP = """SELECT rk AS file_id, list(ordinal ORDER BY ordinal) AS every, list(ordinal ORDER BY r, ordinal) FILTER (r IS NOT NULL) AS fit FROM
 (SELECT *, CASE WHEN rk % 3 = 0 AND language_code = 'deu' THEN 0 WHEN language_code IN ('eng', 'en') THEN 1 END AS r FROM px_streams WHERE stream_type = 2) GROUP BY 1"""


@query("p7_keep_audio", ["px_streams"], f"SELECT file_id, array_to_string(CASE WHEN len(every) = 1 OR fit IS NULL THEN every ELSE fit END, ',') AS kept FROM ({_KEEP})")
def _(px):
    tracks = px("px_streams").where("stream_type = 2").withColumnsRenamed({"rk": "file_id", "language_code": "lang"})
    return P.keep_audio(tracks, F.when(F.col("file_id") % 3 == 0, "deu").otherwise("eng")).select("file_id", F.array_join("kept", ",").alias("kept"))


@query(
    "p6_select_track",
    ["px_items", "px_streams"],
    """, w AS (SELECT rk AS file_id, CASE rk % 4 WHEN 0 THEN 'none' WHEN 1 THEN 'deu' WHEN 2 THEN '2' ELSE 'eng' END AS spec FROM px_items),
s AS (SELECT rk AS file_id, language_code AS spec, min(ordinal) AS o FROM px_streams WHERE stream_type = 3 GROUP BY 1, 2), c AS (SELECT rk AS file_id, count(*) AS n FROM px_streams WHERE stream_type = 3 GROUP BY 1)
SELECT file_id, spec, CASE WHEN spec = 'none' THEN NULL WHEN spec = '2' THEN 2 ELSE o END AS ordinal,
  CASE WHEN spec = 'none' THEN 'NONE' WHEN spec = '2' OR o IS NOT NULL THEN 'OK' WHEN coalesce(n, 0) = 0 THEN 'NONE' ELSE 'ABORT' END AS verdict FROM w LEFT JOIN s USING (file_id, spec) LEFT JOIN c USING (file_id)""",
)
def _(px):
    spec = F.when(F.col("rk") % 4 == 0, "none").when(F.col("rk") % 4 == 1, "deu").when(F.col("rk") % 4 == 2, "2")
    wanted = px("px_items").select(F.col("rk").alias("file_id"), spec.alias("sub_track"))
    return P.select_track(wanted, px("px_streams").where("stream_type = 3").withColumnsRenamed({"rk": "file_id", "language_code": "lang"}))


_norm = lambda c: f"regexp_replace(lower(coalesce({c}, '')), '[^a-z0-9]+', ' ', 'g')"
_STOP = ", ".join(f"'{w}'" for w in T.STOP_WORDS)
_NOISE = ", ".join(f"'{w}'" for w in T.NOISE_WORDS)
_sig = lambda c: f"list_filter(string_split({_norm(c)}, ' '), lambda w: length(w) >= 3 AND w NOT IN ({_STOP}))"


def _sim(want: str, cand: str) -> str:
    content = rf"list_filter({_sig(cand)}, lambda w: w NOT IN ({_NOISE}) AND NOT regexp_full_match(w, '\d{{3,4}}') AND NOT regexp_full_match(w, '[\dhms_.]+'))"
    flat = f"replace({_norm(cand)}, ' ', '')"
    return f"CASE WHEN len({_sig(want)}) = 0 THEN 1.0 WHEN len({content}) = 0 THEN NULL ELSE len(list_filter({_sig(want)}, lambda w: contains({flat}, w))) / len({_sig(want)}) END"


_GUARD = rf""", m AS (SELECT c.*, i.show_name, i.season, i.ep, i.ep_title FROM px_candidates c JOIN px_items i USING (rk) WHERE format = 'srt' AND NOT regexp_matches(lower(title), 'commentary|karaoke|lyrics') AND duration >= 60 AND NOT (rk % 50 = 7 AND contains(title, 'BluRay'))),
t AS (SELECT *, list_zip(regexp_extract_all(title, '[sS](\d{{1,2}})[ ._-]?[eExX](\d{{1,3}})', 1), regexp_extract_all(title, '[sS](\d{{1,2}})[ ._-]?[eExX](\d{{1,3}})', 2)) AS se FROM m),
e AS (SELECT *, len(list_filter(se, lambda x: CAST(x[1] AS INT) = season AND CAST(x[2] AS INT) = ep)) > 0 AS exact FROM t),
s AS (SELECT *, {_sim("show_name", "title")} AS s1, CASE WHEN ep_title <> 'Episode 7' THEN {_sim("ep_title", "title")} END AS s2 FROM e WHERE len(se) = 0 OR exact),
g AS (SELECT *, greatest(s1, s2) AS sim FROM s WHERE greatest(s1, s2) IS NULL OR greatest(s1, s2) >= CASE WHEN exact THEN 0.3 ELSE 0.6 END)
"""


def _guarded(px):
    items = px("px_items")
    block = items.where("rk % 50 = 7").select(F.col("rk").cast("string").alias("key"), F.lit("BluRay").alias("pattern"))
    return J.guard_candidates(items, px("px_candidates"), block)


@query("j10_guard_candidates", ["px_items", "px_candidates"], _GUARD.strip() + "SELECT rk, cand_id, title, score, round_even(sim, 4) AS sim FROM g")
def _(px):
    return _guarded(px).select("rk", "cand_id", "title", "score", F.bround("sim", 4).alias("sim"))


@query(
    "w1_rank_candidates",
    ["px_items", "px_candidates"],
    _GUARD.strip() + "SELECT rk, cand_id, place FROM (SELECT *, row_number() OVER (PARTITION BY rk ORDER BY score DESC, provider_rank, cand_id) AS place FROM g) WHERE place <= 6",
)
def _(px):
    return W.rank_candidates(_guarded(px)).select("rk", "cand_id", "place")


_CUES = """SELECT doc_id AS file_id, i AS cue, 4.0 * i AS start_s, 4.0 * i + 2.5 AS end_s, line AS text FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(0, len(string_split(text, chr(10))))) AS i FROM documents)"""


def _cues(px):
    lines = px("px_cues").select("file_id", F.posexplode(F.split("text", "\n", -1)).alias("cue", "text"))
    return lines.select("file_id", "cue", (F.col("cue") * 4.0).alias("start_s"), (F.col("cue") * 4.0 + 2.5).alias("end_s"), "text")


@query("a1_cue_span", [], f"SELECT file_id, max(end_s) AS last_end, count(*) AS cues FROM ({_CUES}) GROUP BY 1")
def _(px):
    return A.cue_span(_cues(px))


@query(
    "p2_cover_band",
    [],
    f"""SELECT file_id, cues, CASE WHEN cues < 20 THEN NULL WHEN c BETWEEN 0.85 AND 1.02 THEN 'fit' WHEN c BETWEEN 1.021 AND 1.075 OR c BETWEEN 0.930 AND 0.975 THEN 'rescale' END AS band
 FROM (SELECT file_id, cues, last_end / (cues * (3.7 + file_id % 10 / 10.0)) AS c FROM (SELECT file_id, max(end_s) AS last_end, count(*) AS cues FROM ({_CUES}) GROUP BY 1))""",
)
def _(px):
    spans = A.cue_span(_cues(px))
    dur = F.col("cues") * (3.7 + F.col("file_id") % 10 / 10.0)
    return spans.select("file_id", "cues", P.cover_band(F.col("last_end"), dur, F.col("cues")).alias("band"))


@query("w9_subset_renumber", [], f"SELECT file_id, cue, row_number() OVER (PARTITION BY file_id ORDER BY start_s, cue) AS n FROM ({_CUES}) WHERE start_s >= 20 AND start_s < 60")
def _(px):
    return W.subset_renumber(_cues(px), 20.0, 60.0).select("file_id", "cue", "n")


@query(
    "a12_anchor_fit",
    [],
    f""", c AS ({_CUES}), d AS (SELECT file_id, 20.0 * count(*) AS dur, CASE WHEN file_id % 5 = 0 THEN NULL WHEN file_id % 5 = 1 THEN -14.99 ELSE file_id % 7 / 10.0 END AS oa,
  CASE WHEN file_id % 11 = 0 THEN NULL ELSE file_id % 3 / 10.0 END AS ob FROM c GROUP BY 1),
x AS (SELECT file_id, oa, ob, count(*) AS n, count(*) FILTER (s < 0.30 * dur) AS na, count(*) FILTER (s >= 0.70 * dur AND s < dur) AS nb, avg(s) FILTER (s < 0.30 * dur) AS ta, avg(s) FILTER (s >= 0.70 * dur AND s < dur) AS tb
  FROM (SELECT c.file_id, dur, oa, ob, 5.0 * start_s AS s FROM c JOIN d USING (file_id)) GROUP BY 1, 2, 3),
r AS (SELECT *, CASE WHEN n < 80 THEN 'too_few_cues' WHEN na < 30 THEN 'sparse_a' WHEN oa IS NULL THEN 'anchor_a_failed' WHEN nb < 30 THEN 'sparse_b' WHEN ob IS NULL THEN 'anchor_b_failed'
  WHEN abs(abs(oa) - 15) < 0.6 THEN 'anchor_a_railed' WHEN abs(abs(ob) - 15) < 0.6 THEN 'anchor_b_railed' WHEN abs(ob - oa) > 5 OR tb - ta < 300 THEN 'anchors_inconsistent' ELSE 'ok' END AS reason FROM x)
SELECT file_id, reason, CASE WHEN reason = 'ok' THEN round_even(1 + (ob - oa) / (tb - ta), 6) END AS scale, CASE WHEN reason = 'ok' THEN round_even(oa - ((ob - oa) / (tb - ta)) * ta, 4) END AS shift FROM r""".replace(", c AS", "WITH c AS", 1),
)
def _(px):
    cues = _cues(px)
    n = F.col("file_id")
    anchors = cues.groupBy("file_id").agg((F.count("*") * 20.0).alias("dur"))
    anchors = anchors.withColumn("oa", F.when(n % 5 == 0, F.lit(None)).when(n % 5 == 1, -14.99).otherwise(n % 7 / 10.0)).withColumn("ob", F.when(n % 11 == 0, F.lit(None)).otherwise(n % 3 / 10.0))
    return A.anchor_fit(cues.withColumn("start_s", F.col("start_s") * 5.0), anchors)


@query(
    "t13_repair_pipes",
    [],
    r"""SELECT doc_id, list_sum(list_transform(l, lambda x: CASE WHEN regexp_full_match(x, '\d+\s*') OR contains(x, '-->') THEN 0 ELSE length(x) - length(replace(x, '|', '')) END))::BIGINT AS n,
  md5(array_to_string(list_transform(l, lambda x: CASE WHEN regexp_full_match(x, '\d+\s*') OR contains(x, '-->') THEN x ELSE replace(x, '|', 'I') END), chr(10))) AS digest
FROM (SELECT doc_id, string_split('12' || chr(10) || '00:00:01,000 --> 00:00:02,000 | x' || chr(10) || '|t |s' || chr(10) || text, chr(10)) AS l FROM documents)""",
)
def _(px):
    cue = F.concat(F.lit("12\n00:00:01,000 --> 00:00:02,000 | x\n|t |s\n"), "text")
    fixed = px("px_cues").select(F.col("file_id").alias("doc_id"), T.repair_pipes(cue).alias("r"))
    return fixed.select("doc_id", F.col("r.n").cast("long").alias("n"), F.md5("r.text").alias("digest"))


@query("t1_norm_ascii", [], f"SELECT doc_id, md5({_norm('text')}) AS digest FROM documents")
def _(px):
    return px("px_cues").select(F.col("file_id").alias("doc_id"), F.md5(T.norm_ascii(F.col("text"))).alias("digest"))


@query("t18_commentary_hints", [], r"SELECT doc_id, len(regexp_extract_all(lower(text), '\b(we (shot|filmed|had|were|wanted)|the scene|this shot|the film|the movie|the director|the script|the sequence|originally|actually|you can see|i remember|the studio|the set|camera|takes?|edit|footage|screenplay|producer)\b')) AS hints FROM documents")
def _(px):
    return px("px_cues").select(F.col("file_id").alias("doc_id"), T.commentary_hints(F.col("text"), F.lit("en"))["hints"].cast("long").alias("hints"))


@query("t11_srt_times", [], r"SELECT event_id, printf('%02d:%02d:%02d,%03d', ms // 3600000, ms // 60000 % 60, ms // 1000 % 60, ms % 1000) AS span FROM (SELECT event_id, CAST(round_even(greatest(value * 37 - 5, 0.0) * 1000, 0) AS BIGINT) AS ms FROM events)")
def _(px):
    return _events(px).select("event_id", T.sec_to_srt(F.col("value") * 37 - 5).alias("span"))


def _events(px):
    return px.spark.table("events")


@query("j3_verify_copies", ["px_src", "px_dst"], "SELECT s.rel, CASE WHEN d.bytes IS NULL THEN 'MISSING' WHEN d.bytes <> s.bytes THEN 'SIZE' ELSE 'OK' END AS verdict FROM px_src s LEFT JOIN px_dst d USING (rel)")
def _(px):
    return J.verify_copies(px("px_src"), px("px_dst")).select("rel", "verdict")


@query("k5_copy_plan", ["px_src", "px_dst"], "SELECT s.rel, s.bytes FROM px_src s LEFT JOIN px_dst d USING (rel) WHERE d.bytes IS NULL OR d.bytes <> s.bytes")
def _(px):
    return J.copy_plan(px("px_src"), px("px_dst"), overwrite=True).select("rel", "bytes")


@query(
    "j2_staged_complete",
    ["px_src", "px_dst"],
    """, s AS (SELECT work AS folder, count(*) AS s_files, sum(bytes)::BIGINT AS s_bytes FROM px_dst GROUP BY 1), t AS (SELECT work AS folder, count(*) AS t_files, sum(bytes)::BIGINT AS t_bytes FROM px_src WHERE work % 5 <> 0 GROUP BY 1)
SELECT folder, s_files, s_bytes, CASE WHEN t_files IS NULL THEN CASE WHEN folder % 2 = 0 THEN 'DONE' ELSE 'UNKNOWN' END WHEN s_files = t_files AND s_bytes = t_bytes THEN 'COMPLETE' ELSE 'SHORT' END AS verdict FROM s LEFT JOIN t USING (folder)""",
)
def _(px):
    folder = lambda df: df.withColumnRenamed("work", "folder")
    src = folder(px("px_src"))
    return J.staged_complete(folder(px("px_dst")), src.where("folder % 5 <> 0"), src.where("folder % 2 = 0").select("folder")).select("folder", "s_files", "s_bytes", "verdict")


@query(
    "j2_never_staged",
    ["px_src", "px_dst"],
    """, s AS (SELECT work AS folder, count(*) AS s_files, sum(bytes)::BIGINT AS s_bytes FROM px_dst WHERE work % 7 <> 3 GROUP BY 1), t AS (SELECT work AS folder, count(*) AS t_files, sum(bytes)::BIGINT AS t_bytes FROM px_src WHERE work % 5 <> 0 GROUP BY 1)
SELECT folder, coalesce(s_files, 0) AS s_files, coalesce(s_bytes, 0)::BIGINT AS s_bytes, t_files, CASE WHEN s_files IS NULL THEN 'NOT STAGED' WHEN t_files IS NULL THEN CASE WHEN folder % 2 = 0 THEN 'DONE' ELSE 'UNKNOWN' END WHEN s_files = t_files AND s_bytes = t_bytes THEN 'COMPLETE' ELSE 'SHORT' END AS verdict FROM s FULL JOIN t USING (folder)""",
)
def _(px):
    """Folders seen from both sides: a seventh of them is still on the source alone."""
    folder = lambda df: df.withColumnRenamed("work", "folder")
    src, staged = folder(px("px_src")), folder(px("px_dst")).where("folder % 7 <> 3")
    return J.staged_complete(staged, src.where("folder % 5 <> 0"), src.where("folder % 2 = 0").select("folder")).select("folder", "s_files", "s_bytes", "t_files", "verdict")


@query(
    "a13_work_status",
    ["px_src", "px_dst"],
    """SELECT work, CASE WHEN n AND h THEN 'BLOCKED' WHEN n THEN 'READY' ELSE 'DONE' END AS verdict FROM (SELECT s.work, bool_or(d.bytes IS NULL OR d.bytes <> s.bytes) AS n, bool_or(s.bytes % 97 = 0) AS h
 FROM px_src s LEFT JOIN px_dst d USING (rel) GROUP BY 1)""",
)
def _(px):
    src = px("px_src")
    return A.work_status(src, px("px_dst"), src.where("bytes % 97 = 0").select("rel")).select("work", "verdict")


@query(
    "a11_inventory_rollup",
    ["px_src"],
    "SELECT kind, CAST(CAST(created AS DATE) AS VARCHAR) AS day, count(*) AS files, sum(bytes)::BIGINT / 1e9 AS gb, grouping_id(kind, CAST(CAST(created AS DATE) AS VARCHAR)) AS level FROM px_src GROUP BY ROLLUP (kind, CAST(CAST(created AS DATE) AS VARCHAR))",
)
def _(px):
    return A.inventory_rollup(px("px_src"))


@query(
    "a4_stub_inventory",
    ["px_src"],
    """, l AS (SELECT rel, 'm/' || work AS dir, CASE ok % 3 WHEN 0 THEN 'Show s01e02.mkv' WHEN 1 THEN 'Film.mkv' ELSE 'a trailer.mkv' END AS name, bytes * (1 + ok % 3) AS bytes, CASE WHEN ok % 7 <> 0 THEN bytes / 30000.0 END AS sec FROM px_src),
m AS (SELECT dir, list_sort(list(bytes)) AS b FROM l GROUP BY 1), md AS (SELECT dir, b[least(CAST(round_even(len(b) / 2, 0) AS INT), len(b) - 1) + 1] AS med FROM m),
x AS (SELECT *, round_even(bytes / 1048576, 2) AS mb, CASE WHEN med = 0 THEN 1.0 ELSE round_even(bytes / med, 3) END AS frac, CASE name WHEN 'Film.mkv' THEN 'Feature' WHEN 'a trailer.mkv' THEN 'Extra' ELSE 'Episode' END AS role FROM l JOIN md USING (dir)),
y AS (SELECT *, CASE role WHEN 'Feature' THEN 30.0 WHEN 'Episode' THEN 10.0 ELSE 0.2 END AS f, round_even(sec / 60, 2) AS mins FROM x)
SELECT rel AS file_id, role, mb, frac, CASE WHEN NOT (mb < 20 OR (frac < 0.25 AND med > 50 * 1048576)) THEN 'ok' WHEN sec IS NULL THEN 'STUB unreadable' WHEN mins < f / 3 THEN 'STUB' WHEN mins < f THEN 'SUSPECT' ELSE 'ok(small)' END AS verdict FROM y""",
)
def _(px):
    s = px("px_src")
    name = F.when(F.col("ok") % 3 == 0, "Show s01e02.mkv").when(F.col("ok") % 3 == 1, "Film.mkv").otherwise("a trailer.mkv")
    listing = s.select(F.col("rel").alias("file_id"), F.concat(F.lit("m/"), "work").alias("dir"), name.alias("name"), (F.col("bytes") * (1 + F.col("ok") % 3)).alias("bytes"))
    return A.stub_inventory(listing, s.where("ok % 7 <> 0").select(F.col("rel").alias("file_id"), (F.col("bytes") / 30000.0).alias("sec")))


@query(
    "j11_verify_episode_slots",
    ["px_agent", "px_files"],
    r""", p AS (SELECT a.rk, a.title, a.idx, f.file, regexp_extract(file, '(?i)E(\d+)', 1) AS e1, regexp_extract(file, '(?i)-E(\d+)', 1) AS e2, regexp_extract(file, ' - (.+)\.[^.]+$', 1) AS t FROM px_agent a JOIN px_files f USING (rk)),
q AS (SELECT *, coalesce(idx BETWEEN try_cast(e1 AS INT) AND try_cast(coalesce(nullif(e2, ''), e1) AS INT), false) AS inside, regexp_replace(regexp_replace(lower(t), '[^a-z0-9]', '', 'g'), '^(the|a|an)', '') AS tn, regexp_replace(regexp_replace(lower(title), '[^a-z0-9]', '', 'g'), '^(the|a|an)', '') AS an FROM p)
SELECT rk, file, CASE WHEN file IS NULL THEN 'NOFILE' WHEN inside AND e2 <> '' AND e2::INT > e1::INT THEN 'OK(combined)' WHEN lower(t) = lower(title) THEN 'OK' WHEN t <> '' AND tn = an THEN 'OK(normalised)' WHEN t = '' THEN 'NOTITLE' ELSE 'MISMATCH' END AS verdict, inside AS slot_ok FROM q""",
)
def _(px):
    return J.verify_episode_slots(px("px_agent"), px("px_files").select("rk", "file")).select("rk", "file", "verdict", "slot_ok")


@query(
    "w7_uniform_shift",
    ["px_agent"],
    """, a AS (SELECT show_name, season, idx, regexp_replace(regexp_replace(lower(title), '[^a-z0-9]', '', 'g'), '^(the|a|an)', '') AS t FROM px_agent), b AS (SELECT show_name, season, idx - CASE WHEN season % 2 = 0 THEN 1 ELSE 0 END AS idx, t FROM a)
SELECT show_name AS "show", season, min(a.idx - b.idx)::INT AS shift, count(*) AS n FROM a JOIN b USING (show_name, season, t) GROUP BY 1, 2 HAVING min(a.idx - b.idx) = max(a.idx - b.idx) AND min(a.idx - b.idx) <> 0 AND count(*) > 1""",
)
def _(px):
    a = px("px_agent")
    return W.uniform_shift(a, a.withColumn("idx", F.col("idx") - F.when(F.col("season") % 2 == 0, 1).otherwise(0)))


@query(
    "j5_match_by_runtime",
    ["px_canon"],
    """, e AS (SELECT show_name, ok % 3 AS season, idx, mins, ok FROM px_canon), f AS (SELECT ok AS file_id, show_name, season, CASE WHEN ok % 9 <> 0 THEN mins + ok % 5 * 1.3 END AS file_mins FROM e),
d AS (SELECT file_id, e.idx, abs(file_mins - mins) AS d, row_number() OVER (PARTITION BY file_id ORDER BY abs(file_mins - mins), e.idx) AS p FROM f JOIN e USING (show_name, season) WHERE file_mins IS NOT NULL),
t AS (SELECT file_id, min(idx) FILTER (p = 1) AS idx, round_even(min(d), 1) AS delta, max(d) FILTER (p = 2) AS d2 FROM d WHERE p <= 2 GROUP BY 1)
SELECT file_id, idx, delta, CASE WHEN idx IS NULL THEN NULL WHEN d2 IS NULL THEN 99.0 ELSE round_even(d2 - delta, 1) + 0.0 END AS gap,
  CASE WHEN file_mins IS NULL THEN 'NO DURATION' WHEN idx IS NULL OR delta > 3 THEN 'NO CLOSE MATCH' WHEN (CASE WHEN d2 IS NULL THEN 99.0 ELSE round_even(d2 - delta, 1) END) < 1 THEN 'AMBIGUOUS' ELSE 'ok' END AS verdict FROM f LEFT JOIN t USING (file_id)""",
)
def _(px):
    c = px("px_canon").withColumn("season", F.col("ok") % 3)
    files = c.select(F.col("ok").alias("file_id"), "show", "season", F.when(F.col("ok") % 9 != 0, F.col("mins") + (F.col("ok") % 5 * F.lit(Decimal("1.3"))).cast("double")).alias("file_mins"))
    return J.match_by_runtime(files, c.select("show", "season", "idx", "mins"))


@query(
    "a7_commentary_verdict",
    ["px_hashes"],
    """, p AS (SELECT file_id, offset_s, max(h) FILTER (track = 0) AS x, max(h) FILTER (track = 1) AS y FROM px_hashes GROUP BY 1, 2), c AS (SELECT file_id, count(*) FILTER (x IS NOT NULL AND y IS NOT NULL) AS windows, count(*) FILTER (x <> y) AS differ FROM p GROUP BY 1)
SELECT *, CASE WHEN windows = 0 THEN 'TOO SHORT' WHEN differ > 0 THEN 'COMMENTARY' ELSE 'DUPLICATE' END AS verdict FROM c""",
)
def _(px):
    return A.commentary_verdict(px("px_hashes"))


@query(
    "a8_audio_gaps",
    ["px_packets"],
    """, pr AS (SELECT file_id, CASE WHEN max(pts) < 1 + 60 THEN round_even(max(pts)::DOUBLE * 0.25, 0) ELSE 1 END AS from_s FROM px_packets GROUP BY 1),
p AS (SELECT *, lag(pts) OVER (PARTITION BY file_id, track ORDER BY pts) AS prev, count(*) OVER (PARTITION BY file_id, track) AS n FROM px_packets JOIN pr USING (file_id) WHERE pts BETWEEN from_s AND from_s + 60),
d AS (SELECT *, pts - prev AS d FROM p WHERE prev IS NOT NULL AND n >= 50), m AS (SELECT file_id, track, list_sort(list(d)) AS l FROM d GROUP BY 1, 2),
a AS (SELECT file_id, track, l[least(CAST(round_even(len(l) / 2, 0) AS INT), len(l) - 1) + 1] AS approx FROM m),
f AS (SELECT file_id, track, avg(d) FILTER (d < 1.5 * approx) AS frame, count(*) FILTER (d < 1.5 * approx) AS usual, min(prev) AS first, max(pts) AS last, count(*) AS present FROM d JOIN a USING (file_id, track) WHERE approx > 0 GROUP BY 1, 2),
g AS (SELECT file_id, track, count(*) AS gaps, min(prev) AS g0, max(prev) AS g1 FROM d JOIN f USING (file_id, track) WHERE d > 1.5 * frame GROUP BY 1, 2)
SELECT file_id, track, round_even(frame, 6) AS frame, round_even(100 * (e - present) / e, 3) AS missing_pct, coalesce(gaps, 0) AS gaps, CASE WHEN coalesce(gaps, 0) >= 2 THEN round_even((g1 - g0) / (gaps - 1), 4) ELSE 0.0 END AS period,
  CASE WHEN 100 * (e - present) / e >= 1.0 THEN 'FLAG' ELSE 'ok' END AS verdict FROM (SELECT *, round_even((last - first) / frame, 0) AS e FROM f WHERE usual >= 10) LEFT JOIN g USING (file_id, track)""",
)
def _(px):
    packets = px("px_packets").withColumn("pts", F.col("pts").cast("double"))
    return A.audio_gaps(packets, packets.groupBy("file_id").agg(F.max("pts").alias("sec")), start=1.0)


@query(
    "w11_failure_runs",
    ["px_log"],
    """, r AS (SELECT *, sum(CASE WHEN event <> 'search_fail' THEN 1 ELSE 0 END) OVER (PARTITION BY rk ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS run FROM px_log)
SELECT rk, run, count(*) AS failures, min(event_id) AS first_event, count(*) >= 3 AS abort FROM r WHERE event = 'search_fail' GROUP BY 1, 2""",
)
def _(px):
    return W.failure_runs(px("px_log"), 3)


@query("w12_transitions", ["px_log"], "SELECT event_id, rk, event, before FROM (SELECT *, lag(event) OVER (PARTITION BY rk ORDER BY ts, event_id) AS before FROM px_log) WHERE event IS DISTINCT FROM before")
def _(px):
    return W.transitions(px("px_log")).select("event_id", "rk", "event", "before")


@query("o2_merge_state", ["px_log"], "SELECT rk, arg_max(event, (ts, event_id)) AS event, max(ts) AS ts, arg_max(event_id, (ts, event_id)) AS event_id FROM px_log GROUP BY 1")
def _(px):
    log = px("px_log").select("rk", "ts", "event_id", "event")
    return W.merge_state(log.where("event_id % 2 = 0"), log.where("event_id % 2 = 1")).select("rk", "event", "ts", "event_id")


@query("j16_todo", ["px_items", "px_log"], "SELECT rk, duration FROM px_items ANTI JOIN px_log ON px_items.rk = px_log.rk")
def _(px):
    return J.todo(px("px_items"), px("px_log"), size="duration").select("rk", "duration")


@query(
    "p11_offset_verdict",
    ["px_log"],
    """SELECT event_id, CASE WHEN o IS NULL THEN 'align_fail' WHEN abs(abs(o) - 60) < 3 THEN 'align_railed' WHEN abs(o) > 30 THEN 'needs_review' WHEN abs(o) < 0.15 AND abs(s - 1) <= 0.0002 THEN 'already_aligned' ELSE 'refine' END AS verdict
FROM (SELECT event_id, CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 3 = 0 THEN event_id % 10 / 100.0 ELSE event_id % 130 - 65.0 END AS o, 1 + event_id % 4 / 10000.0 AS s FROM px_log)""",
)
def _(px):
    e = F.col("event_id")
    offset = F.when(e % 13 == 0, F.lit(None)).when(e % 3 == 0, e % 10 / 100.0).otherwise(e % 130 - 65.0)
    return P.offset_verdict(px("px_log").select("event_id", offset.alias("offset"), (1 + e % 4 / 10000.0).alias("scale"))).select("event_id", "verdict")


@query(
    "j14_merge_ocr",
    [],
    "SELECT conv_id AS file_id, turn AS cue, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations WHERE turn % 6 <> 5 AND trim(text) <> ''",
)
def _(px):
    c = px.spark.table("conversations").select(F.col("conv_id").alias("file_id"), F.col("turn").alias("cue"), "text")
    return J.merge_ocr(c.select("file_id", "cue"), c.where("cue % 6 <> 5")).select("file_id", "cue", "n")


@query(
    "a22_engine_agreement",
    [],
    f"""SELECT kind, count(*) AS n FROM (SELECT CASE WHEN text = y THEN 'equal' WHEN trim({_norm("text")}) = trim({_norm("y")}) THEN 'punctuation' ELSE 'words' END AS kind
 FROM (SELECT text, CASE turn % 3 WHEN 0 THEN text WHEN 1 THEN text || '!' ELSE text || ' more' END AS y FROM conversations)) GROUP BY 1""",
)
def _(px):
    c = px.spark.table("conversations").select(F.col("conv_id").alias("file_id"), F.col("turn").alias("cue"), "text")
    other = F.when(F.col("cue") % 3 == 0, F.col("text")).when(F.col("cue") % 3 == 1, F.concat("text", F.lit("!"))).otherwise(F.concat("text", F.lit(" more")))
    return A.engine_agreement(c, c.withColumn("text", other))
