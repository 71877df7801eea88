"""Readers and writers on files in the forms that the archive's tools write."""

import json

from pyspark.sql import functions as F

from shelfwright.functions import text as T
from shelfwright.operators import audits as U, predicates as P, ranking as W, reconcile as J
from shelfwright.sources import readers as S, writers as K

XML = """<?xml version="1.0" encoding="utf-8"?>
<Title>
  <LocalTitle>Salt &amp; Iron</LocalTitle>
  <IMDB>tt0000001</IMDB>
  <AudioTracks>
    <AudioTrack Language="English"    Type="DTS-HD Master" Channels="7.1" />
    <AudioTrack Language="Commentary" Type="Dolby &quot;D&quot;" Channels="2.0" />
  </AudioTracks>
  <ExtraFeatures Count="2"><![CDATA[
    Making <the> film
    Trailer & more

  ]]></ExtraFeatures>
  <Titles>
    <Title Number="1" ContainsEpisode="False"><Hours>2</Hours><Minutes>45</Minutes><Seconds>0</Seconds></Title>
    <Title Number="2" TVEpisode="1" Hours="0" Minutes="41" Seconds="7" MainMovie="True"/>
    <Title Number="3" TVEpisode="2"><Hours>0</Hours><Minutes>42</Minutes></Title>
    <Title Number="4"/>
  </Titles>
</Title>
"""


def put(folder, name, content, encoding="utf-8"):
    at = folder / name
    at.parent.mkdir(parents=True, exist_ok=True)
    at.write_bytes(content.encode(encoding))
    return at


def test_disc_xml(spark, tmp_path):
    put(tmp_path, "Disc A/mymovies.xml", XML)
    put(tmp_path, "Disc B/mymovies.xml", XML.replace("</Titles>\n</Title>", ""), "utf-8-sig")
    put(tmp_path, "Disc C/mymovies.xml", " ")
    titles, tracks, extras, header = S.read_disc_xml(spark, f"{tmp_path}/*/mymovies.xml")
    rows = {(r.disc, r.title): (r.sec, r.episode, r.play_all, r.main_movie) for r in titles.collect()}
    for d in ("Disc A", "Disc B"):
        assert [rows[d, k] for k in (1, 2, 3, 4)] == [(9900.0, None, True, False), (2467.0, 1, False, True), (2520.0, 2, False, False), (None, None, False, False)]
    assert [(r.pos, r.language, r.type) for r in tracks.where("disc = 'Disc A'").orderBy("pos").collect()] == [(0, "English", "DTS-HD Master"), (1, "Commentary", 'Dolby "D"')]
    assert [r.name for r in extras.where("disc = 'Disc A'").orderBy("pos").collect()] == ["Making <the> film", "Trailer & more"]
    heads = {r.disc: (r.local_title, r.imdb, r.malformed) for r in header.collect()}
    assert heads == {"Disc A": ("Salt & Iron", "tt0000001", False), "Disc B": ("Salt & Iron", "tt0000001", True), "Disc C": (None, None, True)}
    # The claimed lengths feed the reconciliation with what was measured.
    measured = spark.createDataFrame([("Disc A", 2470.0), ("Disc A", 9890.0)], "disc string, sec double")
    found = U.reconcile_durations(titles.where("disc = 'Disc A' and sec is not null").select("disc", "sec"), measured)
    assert {(r.claimed, r.measured) for r in found.collect()} == {(2467.0, 2470.0), (2520.0, None), (9900.0, 9890.0)}


CATALOGUE = {
    "disc": "Disc A", "discPath": "E:\\\\Disc A", "minLength": 10, "titleCount": 1,
    "titles": [{"title": 0, "duration": "1:34:58", "sizeText": "33.2 GB", "source": "00001.mpls", "outName": "a_t00.mkv", "width": 1920, "height": 1080, "fieldOrder": None, "frameRate": "24/1", "probeFile": None, "probeScope": "title", "audioMd5": "ab", "frames": ["a.png", "b.png"], "disposition": None,
                "streams": [{"n": 0, "type": "Video", "lang": None, "codec": "V_AVC", "bitrate": None, "channels": None, "resolution": "1920x1080", "label": None}, {"n": 1, "type": "Audio", "lang": "eng", "codec": "A_DTS", "bitrate": "1.5 Mb/s", "channels": "6", "resolution": None, "label": "Surround"}]}],
}


def test_catalogue(spark, tmp_path):
    put(tmp_path / "c", "Disc A.catalogue.json", json.dumps(CATALOGUE, indent=4), "utf-8-sig")
    put(tmp_path / "c", "Disc B.catalogue.json", json.dumps(CATALOGUE | {"disc": "Disc B", "titles": []}))
    broken = put(tmp_path / "c", "Disc C.catalogue.json", json.dumps(CATALOGUE)[:200])
    titles, streams = S.read_catalogue(spark, str(tmp_path / "c"))
    r = titles.collect()
    assert len(r) == 1 and (r[0].disc, r[0].sec, r[0].size_text, r[0].out_name, r[0].frame_rate, r[0].probe_scope, r[0].audio_md5, r[0].frames) == ("Disc A", 5698.0, "33.2 GB", "a_t00.mkv", "24/1", "title", "ab", ["a.png", "b.png"])
    assert [(s.n, s.type, s.codec, s.lang, s.channels, s.label) for s in streams.orderBy("n").collect()] == [(0, "Video", "V_AVC", None, None, None), (1, "Audio", "A_DTS", "eng", "6", "Surround")]
    assert [(x.file.rsplit("/", 1)[-1].replace("%20", " "), x.why) for x in S.unreadable(spark, str(tmp_path / "c")).collect()] == [(broken.name, "no JSON")]
    K.write_catalogue(titles.withColumn("min_length", F.lit(10)), streams, str(tmp_path / "w"), per_disc=True)
    said = json.loads((tmp_path / "w" / "Disc A.catalogue.json").read_text())
    gone = lambda x: {k: gone(v) if isinstance(v, dict) else [gone(y) if isinstance(y, dict) else y for y in v] if isinstance(v, list) else v for k, v in x.items() if v is not None}
    assert said == gone({k: v for k, v in CATALOGUE.items() if k != "discPath"})


def test_manifests(spark, tmp_path):
    items = [
        {"out": "a.mkv", "kind": "BD", "src": "E:/d/BDMV/STREAM/00001.m2ts", "crop": "auto", "subTrack": "eng", "commentary": [1, [2, "Writers"]], "audioDescription": 3, "audioTracks": [0, 1], "origLang": "deu", "allowRawStream": True},
        {"out": "b.mkv", "kind": "DVD", "src": "E:/d", "title": 4, "chapterStart": 2, "subTrack": 0, "commentary": [[5, "The \"cast\", again"]]},
    ]
    put(tmp_path / "m", "two.json", json.dumps(items, indent=2), "utf-8-sig")
    put(tmp_path / "m", "one.json", json.dumps({"out": "c.mkv", "kind": "MKV", "src": "c", "commentary": 2}))
    put(tmp_path / "m", "bad.json", "[{")
    got = {r.out: r for r in S.read_manifest(spark, str(tmp_path / "m")).collect()}
    pairs = lambda x: x and [tuple(e) for e in x]
    assert set(got) == {"a.mkv", "b.mkv", "c.mkv"} and pairs(got["a.mkv"].commentary) == [(1, None), (2, "Writers")] and pairs(got["a.mkv"].audioDescription) == [(3, None)]
    assert (got["a.mkv"].subTrack, got["b.mkv"].subTrack, got["c.mkv"].subTrack) == ("eng", "0", None) and got["b.mkv"].chapterStart == 2 and got["a.mkv"].allowRawStream is True
    assert pairs(got["b.mkv"].commentary) == [(5, 'The "cast", again')] and pairs(got["c.mkv"].commentary) == [(2, None)] and got["c.mkv"].audioDescription is None
    rows = S.read_manifest(spark, str(tmp_path / "m"))
    K.write_manifest(rows.withColumn("name", F.lit("all")), str(tmp_path / "w"), "name")
    said = {x["out"]: x for x in json.loads((tmp_path / "w" / "all.json").read_text())}
    assert said["a.mkv"] == items[0] | {"audioDescription": [3]} and said["b.mkv"] == items[1] and said["c.mkv"]["commentary"] == [2]
    # What is read labels the audio.
    tracks = spark.createDataFrame([("a.mkv", k, "und") for k in range(4)], "file_id string, ordinal int, lang string")
    kept = tracks.groupBy("file_id").agg(F.array_sort(F.collect_list("ordinal")).alias("kept"))
    labels = P.label_audio(kept, tracks, rows.select(F.col("out").alias("file_id"), F.col("origLang").alias("orig_lang"), F.col("audioLangs").alias("audio_langs"), "commentary", F.col("audioDescription").alias("description")))
    assert {r.ordinal: (r.title, r.disposition) for r in labels.collect()} == {0: (None, None), 1: ("Audio Commentary 1", "comment"), 2: ("Writers", "comment"), 3: ("Audio Description", "visual_impaired")}


def test_state(spark, tmp_path):
    state = {"11": {"r": "matched", "label": "x", "tried": [{"t": "a", "why": "download_failed"}, {"t": "b", "score": 7, "sim": 0.5, "cover": 0.95, "cues": 90, "kind": "fit"}], "kept": "b", "cover": 0.95, "cues": 90, "kind": "fit"}, "12": {"r": "no_candidates", "label": "y"}}
    put(tmp_path / "s", "subtitle_state.json", json.dumps(state, indent=1))
    got = {r.rk: r for r in S.read_state(spark, str(tmp_path / "s")).collect()}
    assert got["12"].r == "no_candidates" and got["12"].tried is None and (got["11"].kept, got["11"].cues, got["11"].kind) == ("b", 90, "fit")
    assert [tuple(t) for t in got["11"].tried] == [("a", None, None, None, None, None, "download_failed"), ("b", 7, 0.5, 0.95, 90, "fit", None)]


def test_boxes_behind_empty_points(spark, tmp_path):
    put(tmp_path / "f1", "cue_0001_res.json", json.dumps({"rec_texts": ["low", "high"], "rec_polys": [], "rec_boxes": [[0, 50, 9, 60], [0, 10, 9, 20]]}))
    assert [(r.file_id, r.cue, r.text) for r in S.read_ocr_results(spark, str(tmp_path)).collect()] == [("f1", 1, "high\nlow")]


def test_languages_and_forced_marks(spark):
    items = spark.createDataFrame([(k,) for k in range(1, 7)], "rk int")
    streams = spark.createDataFrame(
        [(1, 3, "srt", "ENG", None, None), (2, 3, "srt", None, "English", False), (3, 3, "srt", "", "english", None), (4, 3, "srt", "eng", None, True), (5, 3, "pgs", "eng", None, None), (6, 3, "srt", "deu", "English", None)],
        "rk int, stream_type int, codec string, language_code string, language string, forced boolean",
    )
    assert {r.rk for r in P.needs_subtitles(items, streams).collect()} == {4, 5, 6}
    tracks = spark.createDataFrame([(1, 1, 10, None), (1, 2, 5, False), (1, 3, 99, True), (2, 1, 3, None)], "rk int, ordinal int, cues int, forced boolean")
    assert {(r.rk, r.ordinal, r.picked) for r in W.pick_subtitle(tracks).collect()} == {(1, 1, True), (1, 2, False), (2, 1, True)}


def test_paths_copies_and_rips(spark):
    row = spark.range(1).select(T.library_path(F.lit("D:\\tv"), F.lit("Salt"), F.lit(0), F.lit(7), F.lit("Pier"), F.lit(1987)).alias("a"), T.library_path(F.lit("/tv"), F.lit("Salt"), F.lit(1), F.lit(2), F.lit("Pier"), F.lit(None).cast("int")).alias("b")).first()
    assert row.a == "D:/tv/Salt (1987)/Season 00/Salt (1987) - S00E07 - Pier.mkv" and row.b == "/tv/Salt/Season 01/Salt - S01E02 - Pier.mkv"
    src = spark.createDataFrame([("a/x.mkv", 1), ("a/_TitleCards/f.png", 1), ("a\\_titlecards\\g.png", 1), ("a/y_titlecards.txt", 2)], "rel string, bytes long")
    assert {r.rel: r.verdict for r in J.verify_copies(src, spark.createDataFrame([("a/x.mkv", 1)], "rel string, bytes long")).collect()} == {"a/x.mkv": "OK", "a/y_titlecards.txt": "MISSING"}
    asked = spark.createDataFrame([("d", 5, 124.0, "9.9 MB"), ("d", 6, 100.0, "4.7 GB"), ("d", 7, 100.0, None), ("d", 8, 100.0, "1 GB")], "disc string, title int, sec double, size_text string")
    made = spark.createDataFrame([("d", 5, 125.0, 4_700_000_000), ("d", 6, 101.0, 5_000_000_000), ("d", 7, 100.0, 5), ("d", 8, 90.0, 5)], "disc string, title int, sec double, bytes long")
    assert {r.title: r.verdict for r in J.verify_rips(asked, made).collect()} == {5: "SIZE", 6: "ok", 7: "ok", 8: "CHECK"}


def test_landmarks_at_any_place(spark):
    cues = spark.createDataFrame([("f", float(10 * k), f"Line number {k} of many words" if k % 2 else f"uh {k}!") for k in range(2000)] + [("g", 5.0, None), ("g", None, "uh 3!")], "file_id string, start_s double, text string")
    marks = spark.createDataFrame(
        [("f", 1, 19990.0, "LINE number 3 of"), ("f", 2, 100.0, "uh 1998!"), ("f", 3, 7000.0, "uh 7"), ("f", 4, 10.0, "nowhere"), ("f", 5, 10.0, None), ("f", 6, None, "uh 2"), ("g", 7, 1.0, "uh"), ("h", 8, 1.0, "uh")],
        "file_id string, landmark int, t double, line string",
    )
    got = {r.landmark: r.error for r in J.nearest_cue(cues, marks).collect()}
    assert got == {1: 30.0 - 19990.0, 2: 19980.0 - 100.0, 3: 0.0, 4: None, 5: None, 6: None, 7: None, 8: None}
