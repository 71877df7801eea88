"""Small cases of the operators without a query of their own."""

import datetime as dt

from pyspark.sql import functions as F

from shelfwright.operators import aggregates as A, audits as U, predicates as P, ranking as W, reconcile as J
from shelfwright.sources import readers as S


def table(spark, ddl, *rows):
    return spark.createDataFrame(list(rows), ddl)


def test_playlists_and_copies(spark):
    lists = table(spark, "disc string, playlist string, expected double, clips array<string>", ("d", "1", 100.0, ["a", "b", "c"]))
    clips = table(spark, "disc string, clip string, sec double", ("d", "a", 1.5), ("d", "b", 60.0), ("d", "c", 45.0))
    r = U.playlist_runtime(lists, clips).first()
    assert (r.total, r.idents, r.excess) == (105.0, 1, 5.0)
    src = table(spark, "file_id string, sec double, type string", ("f", 10.0, "video"), ("f", 10.0, "audio"), ("g", 5.0, "video"), ("h", 5.0, "video"))
    out = table(spark, "file_id string, sec double, type string", ("f", 10.4, "video"), ("f", 10.4, "audio"), ("g", 5.0, "video"), ("g", 5.0, "subtitle"))
    assert {r.file_id: r.verdict for r in U.verify_stream_copy(src, out).collect()} == {"f": "ok", "g": "DIFFERS", "h": "MISSING"}


def test_index(spark):
    shipped = table(spark, "work string, path string", ("w", "/x/a.mkv"), ("w", "/x/b.mkv"), ("v", "/x/c.mkv"))
    indexed = table(spark, "work string, path string, local boolean", ("w", "D:\\x\\a.mkv", True), ("w", "/net/b.mkv", False), ("v", "/x/other.mkv", True))
    assert [tuple(r) for r in U.unindexed_extras(shipped, indexed).collect()] == [("w", "b")]
    seasons = table(spark, "show string, ordering string, season int, idx int, title string", ("s", "aired", 1, 1, "A"), ("s", "dvd", 1, 1, "A"), ("s", "aired", 1, 2, "B"), ("s", "dvd", 1, 2, "C"), ("s", "dvd", 1, 3, "D"))
    assert {(r.idx, r.title_a, r.title_b) for r in J.compare_orderings(seasons, "aired", "dvd").collect()} == {(2, "B", "C"), (3, None, "D")}
    agent, listing = table(spark, "rk int, file string", (1, "Z:\\t\\a b.mkv")), table(spark, "rel string", ("t/a b.mkv",), ("t/c.mkv",))
    assert [r.rel for r in U.match_by_basename(agent, listing).collect()] == ["t/a b.mkv"]


def test_index_in_any_case(spark):
    shipped = table(spark, "work string, path string", ("w", "/x/Behind The Scenes.mkv"), ("w", "/x/Trailer.mkv"))
    indexed = table(spark, "work string, path string, local boolean", ("w", "D:\\x\\behind the scenes.mkv", True))
    assert [tuple(r) for r in U.unindexed_extras(shipped, indexed).collect()] == [("w", "Trailer")]


def test_staging_from_both_sides(spark):
    rows = lambda *r: table(spark, "folder string, bytes long", *r)
    staged, source = rows(("a", 1), ("a", 2), ("b", 1), ("c", 1), ("d", 5)), rows(("a", 2), ("a", 1), ("b", 2), ("e", 7))
    got = {r.folder: (r.s_files, r.s_bytes, r.t_files, r.verdict) for r in J.staged_complete(staged, source, table(spark, "folder string", ("c",), ("c",))).collect()}
    assert got == {"a": (2, 3, 2, "COMPLETE"), "b": (1, 1, 1, "SHORT"), "c": (1, 1, None, "DONE"), "d": (1, 5, None, "UNKNOWN"), "e": (0, 0, 1, "NOT STAGED")}


def test_playlists_that_cannot_be_read(spark):
    """Null clips and no row at all are the same, a title without a playlist is none, and the flag lets an item or its manifest through."""
    ddl = "manifest string, disc string, stem string, sec double, allow_raw_stream boolean"
    items = table(spark, ddl, ("m", "d", "00001", 100.0, None), ("m", "d", "00002", 100.0, True), ("n", "d", "00003", 100.0, False), (None, "d", "00004", 900.0, None))
    titles = table(spark, "disc string, playlist string, sec double", ("d", "00100", 500.0), ("d", "00101", 600.0), ("d", None, 700.0), ("d", "00102", 110.0), ("d", "00103", 800.0), ("e", "00100", 990.0))
    lists = table(spark, "disc string, playlist string, clips array<string>", ("d", "00100", None), ("d", "00103", ["00001", "00002", "00003"]))
    got = lambda df: sorted((r.stem, r.playlist, r.verdict) for r in J.truncated_streams(df, titles, lists).collect())
    of = lambda stem: [(stem, "00100", "UNREADABLE"), (stem, "00101", "UNREADABLE"), (stem, "00103", "TRUNCATED")]
    assert got(items.drop("allow_raw_stream", "manifest")) == of("00001") + of("00002") + of("00003")
    assert got(items.drop("manifest")) == of("00001") + of("00003")
    assert got(items) == of("00003")


def test_sidecars(spark):
    media = table(spark, "base string, populated boolean, dur double", ("a", True, 1.0), ("b", True, None), ("c", False, 1.0), ("d", True, 1.0))
    assert {r.base: r.verdict for r in J.awaiting_sidecar(media, table(spark, "base string", ("d",))).collect()} == {"a": "AWAITING", "b": "ENCODING"}
    spans = table(spark, "file_id string, last_end double", ("a", 990.0), ("b", 100.0), ("c", 5.0))
    assert {r.file_id: r.verdict for r in J.orphan_sidecars(spans, table(spark, "file_id string, dur double", ("a", 1000.0), ("b", 1000.0))).collect()} == {"a": "ok", "b": "FAR FROM END", "c": "NO MEDIA"}
    when = dt.datetime(2024, 1, 1)
    media = table(spark, "rel string, bytes long, modified timestamp", ("a", 1, when), ("b", 1, when), ("c", 1, when), ("d", 1, when))
    streams = table(spark, "rel string, codec string, packets int", ("a", "dvd_subtitle", 3), ("b", "dvd_subtitle", 4), ("c", "hdmv_pgs_subtitle", 0), ("c", "subrip", 9), ("d", "subrip", 5))
    got = U.bitmap_populated(media, streams, table(spark, "rel string, cues int", ("b", 0), ("a", 7)))
    assert {r.rel: r.verdict for r in got.collect()} == {"a": "populated", "b": "exhausted", "c": "empty"}
    # A kept verdict holds until the file is written anew.
    known = got.select("cache_key", F.lit("exhausted").alias("verdict"))
    assert {r.verdict for r in U.bitmap_populated(media, streams, table(spark, "rel string, cues int"), known).collect()} == {"exhausted"}
    assert "exhausted" not in {r.verdict for r in U.bitmap_populated(media.withColumn("bytes", F.lit(2)), streams, table(spark, "rel string, cues int"), known).collect()}


def test_folders_and_names(spark):
    staged, manifests = table(spark, "folder string", ("x",), ("y",)), table(spark, "src string", ("D:\\stage\\x\\t00.mkv",))
    assert [r.folder for r in U.staged_without_manifest(staged, manifests, "D:\\stage").collect()] == ["y"]
    discs = table(spark, "folder string", ("Blu One",), ("Whole",), ("STREAM",), ("Other",))
    reads = table(spark, "src string", ("d:/Stage/blu one/BDMV/STREAM/00001.m2ts",), ("D:\\stage\\Whole",), ("E:/elsewhere/Other/x.mkv",))
    assert {r.folder for r in U.staged_without_manifest(discs, reads, "D:\\stage\\").collect()} == {"STREAM", "Other"}
    now, old = dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 1)
    folders = table(spark, "folder string, parent string, listed boolean, modified timestamp", ("a", None, True, old), ("a/b", "a", True, old), ("c", None, False, old), ("d", None, True, now), ("e", None, True, old))
    assert {r.folder for r in W.empty_folders(folders, table(spark, "folder string", ("e",)), now).collect()} == {"a/b"}
    names = lambda *x: table(spark, "n string", *((v,) for v in x))
    assert sorted(r.n for r in J.missing_names(names("a", "a", "b"), names("a", "c")).collect()) == ["a", "b"]
    existing, new = table(spark, "show string, idx int", ("s", 4), ("s", 2)), table(spark, "show string, name string", ("s", "b"), ("s", "a"), ("t", "z"))
    assert {(r.name, r.idx) for r in W.append_specials(existing, new).collect()} == {("a", 5), ("b", 6), ("z", 1)}
    files, shifts = table(spark, "show string, season int, idx int", ("s", 1, 1), ("s", 1, 2)), table(spark, "show string, season int, shift int", ("s", 1, 1))
    assert [(r.idx, r.new_idx) for r in W.rename_plan(files, shifts).orderBy("step").collect()] == [(2, 3), (1, 2)]


def test_tracks(spark):
    tracks = table(spark, "file_id string, track int", ("f", 0), ("f", 1), ("f", 2), ("f", 3))
    heard = table(spark, "file_id string, track int, heard string, text string", ("f", 0, "en", "Come here."), ("f", 1, "en", "come HERE"), ("f", 2, "en", "We shot the scene with a camera"))
    assert [r.verdict for r in U.track_identity(tracks, heard).orderBy("track").collect()] == ["SAME LINES", "SAME LINES", "COMMENTARY?", "UNHEARD"]


def test_surveys(spark):
    files = table(spark, "kind string, work string, grp string, rel string, ext string, bytes long", ("film", "w", None, "w/a", "mkv", 5), ("film", "w", None, "w/b", "mkv", 9), ("tv", "t", "s1", "t/e1", "mkv", 1), ("tv", "t", "s1", "t/e2", "mkv", 9), ("film", "x", None, "x/n", "nfo", 9))
    streams = table(spark, "rel string, codec string", ("w/b", "pgs"), ("t/e1", "srt"), ("t/e1", "pgs"), ("t/e1", "pgs"))
    assert {r.rel: r.needs_ocr for r in U.survey_subtitles(files, streams, ["pgs"], ["srt"]).collect()} == {"w/b": "YES", "t/e1": "partial"}
    titles = table(spark, "title int, name string, width int, height int, field_order string, kind string", (1, "Trailer", 720, 576, "tt", "BD"), (2, "Teaser", 1920, 1080, "progressive", "BD"))
    assert [(r.is_sd, r.interlaced, r.abort, r.trailer) for r in P.geometry_flags(titles).orderBy("title").collect()] == [(True, True, True, "SD trailer"), (False, False, False, "HD trailer")]
    items = table(spark, "rk int, year int, aired date, sec double, matched_sec double, title string, folder string", (1, 1990, dt.date(1990, 5, 1), 6000.0, 6100.0, "Dirty Harry", "Dirty Harry (1971)"), (2, 1990, dt.date(1991, 1, 1), 6000.0, None, "Big Deal", "Other Thing"))
    assert {r.rk: (r.bad_year, r.bad_runtime, r.bad_folder) for r in U.metadata_mismatch(items).collect()} == {2: (True, False, True)}
    listing = table(spark, "kind string, dir string, name string", ("movie", "m", "a {edition-One}.mkv"), ("movie", "m", "a {edition-Two}.mkv"), ("movie", "n", "b {edition-One}.mkv"), ("tv", "t/Featurettes", "x"))
    assert {tuple(r) for r in P.layout_violations(listing).collect()} == {("m", "several editions"), ("t/Featurettes", "film extras folder")}
    sound = table(spark, "file_id int, track int, offset_s int, h string", (1, 0, 0, "a"), (1, 1, 0, "a"), (2, 0, 0, "a"), (2, 1, 0, "b"), (3, 0, 0, "a"))
    assert {r.file_id: r.verdict for r in A.commentary_verdict(sound).collect()} == {1: "DUPLICATE", 2: "COMMENTARY", 3: "TOO SHORT"}


def test_names_of_discs_as_on_disk(spark, tmp_path):
    """Spaces, plus and percent signs in names; empty, quoted and broken values of a log; a key of unknown codes alone stays a row."""
    log = 'MSG:1,"x"\nTINFO:0,9,0,"1:02:03"\t \nTINFO:0,27,0,"a, ""b""_t00.mkv"\nTINFO:0,16,0,""\nTINFO:0,10,0,"4 GB" x\nTINFO:x,9,0,"1"\nTINFO:1,99,0,"z"\n'
    log += 'SINFO:0,0,1,6201,"Video"\nSINFO:0,1,4,0,"eng,fra"\nSINFO:0,1,30,0,"\n SINFO:0,2,4,0,"eng"\n'
    for name in ("Show S1 Disc 2", "50% A+B %20 ü"):
        (tmp_path / f"{name}.log").write_text(log)
        (tmp_path / f"{name}.dispositions.txt").write_text("t00|Encode|\nt01|exclude| studio logo \n")
        (tmp_path / name / "BDMV" / "PLAYLIST").mkdir(parents=True)
        (tmp_path / name / "BDMV" / "PLAYLIST" / "00001.mpls").write_text("x00019M2TSy00020M2TS")
    titles, streams = S.read_robot_log(spark, f"{tmp_path}/*.log")
    for name in ("Show S1 Disc 2", "50% A+B %20 ü"):
        of = lambda df, *c: sorted(tuple(r) for r in df.where(F.col("disc") == name).select(*c).collect())  # noqa: E731, B023
        assert of(titles, "title", "sec", "size_text", "source", "out_name") == [(0, 3723.0, None, "", 'a, ""b""_t00.mkv'), (1, None, None, None, None)]
        assert of(streams, "title", "n", "type", "lang", "label") == [(0, 0, "Video", None, None), (0, 1, None, "eng,fra", None)]
        assert of(S.read_dispositions(spark, f"{tmp_path}/*.dispositions.txt"), "title", "kind", "note") == [(0, "encode", ""), (1, "exclude", "studio logo")]
        assert of(S.read_playlists(spark, f"{tmp_path}/*/BDMV/PLAYLIST/*.mpls"), "playlist", "clips") == [("00001", ["00019", "00020"])]
