"""Known cases of the verdicts, the sources and the streams."""

import datetime as dt

from pyspark.sql import functions as F

from shelfwright.operators import aggregates as A, audits as U, predicates as P, ranking as W, reconcile as J
from shelfwright.sources import readers as S, writers as K
from shelfwright.streaming import streams as R


def test_probed_titles(spark):
    reel = [(f"d{k}", 9, 273.0, True, False) for k in range(3)]
    disc = [("d0", 1, 1500.0, True, False), ("d0", 2, 1520.0, True, False), ("d0", 3, 3020.0, True, False), ("d0", 4, 8.0, True, False), ("d0", 5, 700.0, True, False), ("d0", 6, 0.0, True, False)]
    got = {(r.disc, r.title): r.label for r in P.classify_probed_titles(spark.createDataFrame(reel + disc, "disc string, title int, sec double, has_video boolean, phantom boolean")).collect()}
    assert got["d0", 9] == "BOILERPLATE" and got["d0", 3] == "PLAYALL?" and got["d0", 1] == got["d0", 2] == "EPISODE?" and got["d0", 4] == "ARTIFACT" and got["d0", 5] == "REVIEW" and ("d0", 6) not in got


def test_anchors_and_offsets(spark):
    rows = [(1, None, 1.0), (2, -58.5, 1.0), (3, 45.0, 1.0), (4, 0.1, 1.0), (5, 2.0, 1.0)]
    got = [r.verdict for r in P.offset_verdict(spark.createDataFrame(rows, "rk int, offset double, scale double")).orderBy("rk").collect()]
    assert got == ["align_fail", "align_railed", "needs_review", "already_aligned", "refine"]
    cues = spark.createDataFrame([(1, float(t * 10)) for t in range(200)], "file_id int, start_s double")
    fit = lambda a, b: A.anchor_fit(cues, spark.createDataFrame([(1, 2000.0, a, b)], "file_id int, dur double, oa double, ob double")).first().reason
    assert fit(-14.99, -14.99) == "anchor_a_railed" and fit(1.0, 1.2) == "ok" and fit(1.0, None) == "anchor_b_failed" and fit(0.0, 9.0) == "anchors_inconsistent"


def test_ocr_gates(spark):
    spot = "\n".join(f"{k}\n00:00:0{k},000 --> 00:00:0{k},900\n{t}\n" for k, t in enumerate(["Far up.", "Far out.", "Far more.", "James Bond is back."], 1))
    spanish = "\n".join(f"{k}\n00:00:0{k},000 --> 00:00:0{k},900\n{t}\n" for k, t in enumerate(["todo lo que", "para el hombre", "una casa", "pero no"], 1))
    words = spark.createDataFrame([(w,) for w in "far up out more is back".split()], "word string")
    texts = spark.createDataFrame([("a", spot), ("b", spanish)], "file_id string, text string")
    probes = spark.createDataFrame([("a", 30.0, 8), ("b", 30.0, 8)], "file_id string, sec double, max_packets int")
    got = {r.file_id: r.verdict for r in A.ocr_gates(texts, probes, words).collect()}
    assert got == {"a": "ok", "b": "foreign words"}


def test_ink_weight(spark):
    ramp = [0x000000, 0xFFFFFF, 0x808080, 0x000000] + [0] * 12
    rows = [("repair", ramp, [0, 1, 2, 3], [15, 15, 15, 0], [900, 100, 76, 0]), ("thin", ramp, [0, 1, 2, 3], [15, 15, 15, 0], [900, 100, 3, 0])]
    got = {r.disc: (r.ratio, r.verdict) for r in A.ink_weight(spark.createDataFrame(rows, "disc string, palette array<int>, pal_idx array<int>, alpha array<int>, hist array<bigint>")).collect()}
    assert got == {"repair": (0.76, "repair"), "thin": (0.03, "skip")}


def test_crops_gaps_and_sets(spark):
    rows = [("a", "1920:816:0:132")] * 4 + [("a", "1920:800:0:140")] * 2 + [("b", "700:400:1:1")]
    got = {r.file_id: (r.crop, r.defaulted) for r in A.crop_vote(spark.createDataFrame(rows, "file_id string, crop string")).collect()}
    assert got == {"a": ("1920:816:0:132", False), "b": ("1440:1080:240:0", True)}
    pts = [(1, 0, 0.032 * k) for k in range(1500) if k % 21]
    r = A.audio_gaps(spark.createDataFrame(pts, "file_id int, track int, pts double")).first()
    assert abs(r.missing_pct - 4.76) < 0.1 and r.period == 0.672 and r.verdict == "FLAG"
    declared = spark.createDataFrame([("x", 27), ("y", 2)], "disc string, declared int")
    present = spark.createDataFrame([("x", k) for k in range(11)] + [("y", 1), ("y", 2)], "disc string, title_set int")
    assert [(r.disc, r.present) for r in J.incomplete_title_sets(declared, present).collect()] == [("x", 11)]


def test_runtime_match(spark):
    canon = spark.createDataFrame([("s", 1, 5, 57.4), ("s", 1, 6, 50.5), ("s", 1, 7, 57.2), ("s", 2, 1, 50.3)], "show string, season int, idx int, mins double")
    files = spark.createDataFrame([("f", "s", 1, 50.3), ("g", "s", 1, 57.3), ("h", "s", 1, None), ("i", "none", 1, 3.0)], "file_id string, show string, season int, file_mins double")
    got = {r.file_id: (r.idx, r.verdict) for r in J.match_by_runtime(files, canon).collect()}
    assert got["f"] == (6, "ok") and got["g"][1] == "AMBIGUOUS" and got["h"][1] == "NO DURATION" and got["i"] == (None, "NO CLOSE MATCH")


def test_truncated_and_landmarks(spark):
    m = spark.createDataFrame([("d", "00020", 100.0), ("d", "00019", 100.0)], "disc string, stem string, sec double")
    t = spark.createDataFrame([("d", "00020", 500.0), ("d", "00021", 90.0)], "disc string, playlist string, sec double")
    p = spark.createDataFrame([("d", "00020", ["00019", "00021"]), ("d", "00021", ["00020"])], "disc string, playlist string, clips array<string>")
    assert [(r.stem, r.verdict) for r in J.truncated_streams(m, t, p).collect()] == [("00019", "TRUNCATED")]
    cues = spark.createDataFrame([("f", 61.0, "Hello there"), ("f", 3000.0, "Bye now"), ("f", 10.0, "hello there")], "file_id string, start_s double, text string")
    marks = spark.createDataFrame([("f", 1, 59.0, "hello"), ("f", 2, 2998.0, "bye")], "file_id string, landmark int, t double, line string")
    assert J.landmark_verdict(J.nearest_cue(cues, marks)).first().verdict == "pure shift"
    # A line may stand far from its landmark, and a landmark without its line has no error.
    far = spark.createDataFrame([("f", 1, 761.0, "hello"), ("f", 2, 3700.0, "bye"), ("f", 3, 5.0, "never said")], "file_id string, landmark int, t double, line string")
    errors = J.nearest_cue(cues, far)
    assert {r.landmark: r.error for r in errors.collect()} == {1: -700.0, 2: -700.0, 3: None} and J.landmark_verdict(errors).first().verdict == "pure shift"


def test_rankings(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 5)], "rk int, event string, ts int")
    new = spark.createDataFrame([(1, "c", 2), (2, "d", 4), (3, "e", 1)], "rk int, event string, ts int")
    once = W.merge_state(old, new)
    assert {tuple(r) for r in once.collect()} == {(1, "c", 2), (2, "b", 5), (3, "e", 1)} == {tuple(r) for r in W.merge_state(once, new).collect()}
    tried = spark.createDataFrame([(1, 1, None), (1, 2, 5.0), (1, 3, 1.0), (2, 1, 40.0), (2, 2, 50.0)], "rk int, detector int, offset double")
    assert {tuple(r) for r in W.first_plausible(tried).collect()} == {(1, 2, 5.0), (2, 2, 50.0)}
    frames = spark.createDataFrame([("f", 2, "LIGHTS OF LONDON"), ("f", 1, "lights of london"), ("f", 3, "x"), ("g", 1, "y")], "file_id string, t int, text string")
    names = spark.createDataFrame([("f", "Lights of London"), ("g", "")], "file_id string, title string")
    assert {tuple(r) for r in W.best_card_frame(frames, names).collect()} == {("f", 1.0, 1, "OK"), ("g", 0.0, None, "SKIP")}


def test_sources(spark, tmp_path):
    (tmp_path / "disc1.log").write_text('MSG:1,"x"\nTINFO:0,9,0,"1:34:58"\nTINFO:0,10,0,"33.2 GB"\nTINFO:0,16,0,"00001.mpls"\nTINFO:0,27,0,"a, b_t00.mkv"\nSINFO:0,0,1,6201,"Video"\nSINFO:0,1,1,6202,"Audio"\nSINFO:0,1,4,0,"eng"\n')
    titles, streams = S.read_robot_log(spark, str(tmp_path / "disc1.log"))
    r = titles.first()
    assert (r.disc, r.title, r.sec, r.source, r.out_name) == ("disc1", 0, 5698.0, "00001.mpls", "a, b_t00.mkv") and {(x.n, x.type, x.lang) for x in streams.collect()} == {(0, "Video", None), (1, "Audio", "eng")}
    (tmp_path / "00020.mpls").write_bytes(b"\x00\xff00019M2TS\x01\x8800021M2TS\x00")
    assert S.read_playlists(spark, str(tmp_path / "*.mpls")).first().clips == ["00019", "00021"]
    (tmp_path / "disc.dispositions.txt").write_text("# c\n\nt01|Encode|ok film\nbad\nt01|EXCLUDE|dupe\nt02|extra\n")
    assert {tuple(x) for x in S.read_dispositions(spark, str(tmp_path / "disc.dispositions.txt")).collect()} == {("disc", 1, "exclude", "dupe"), ("disc", 2, "extra", "")}
    (tmp_path / "VIDEO_TS.IFO").write_bytes(bytes(0x3E) + b"\x00\x1b" + bytes(9))
    assert S.read_declared_title_sets(spark, str(tmp_path / "*.IFO")).first().declared == 27
    for name, sep in (("lf", "\n"), ("crlf", "\r\n")):
        (tmp_path / f"{name}.srt").write_bytes(f"1{sep}00:00:01,000 --> 00:00:02,500{sep}Hi{sep}there{sep}{sep}2{sep}00:00:03,000 --> 00:00:04,000{sep}42{sep}".encode())
    cues = S.read_srt(spark, str(tmp_path / "*.srt")).orderBy("file_id", "cue").collect()
    assert [tuple(c)[1:] for c in cues] == [(0, 1.0, 2.5, "Hi\nthere"), (1, 3.0, 4.0, "42")] * 2
    K.write_srt(S.read_srt(spark, str(tmp_path / "lf.srt")), str(tmp_path / "out"))
    assert {p.name for p in (tmp_path / "out").iterdir()} - {"._SUCCESS.crc"} >= {"lf.srt"}
    back = S.read_srt(spark, str(tmp_path / "out/*.srt")).orderBy("cue").collect()
    assert [tuple(c)[1:] for c in back] == [(0, 1.0, 2.5, "Hi\nthere"), (1, 3.0, 4.0, "42")]
    names = {x.name for x in S.read_listing(spark, str(tmp_path)).collect()}
    assert {"disc1.log", "00020.mpls"} <= names


def _stream(spark, tmp_path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    return spark.readStream.schema(schema).parquet(str(tmp_path / "in"))


def test_staging_gate(spark, tmp_path):
    at = lambda s: dt.datetime(2024, 1, 1, 0, 0, 0) + dt.timedelta(seconds=s)
    rows = [(at(0), "a", "1", 5), (at(10), "a", "2", 3), (at(20), "a", "2", 7), (at(90), "a", "2", 7), (at(95), "a", "2", 9), (at(0), "b", "1", 1)]
    source = spark.createDataFrame([("a", 2, 12), ("b", 2, 4)], "folder string, files int, total long")
    with R.rocksdb_state(spark):
        out = R.drained(R.staging_gate(_stream(spark, tmp_path, rows, "ts timestamp, folder string, file string, bytes long"), source))
    assert [r.verdict for r in out.where("folder = 'a'").orderBy("ts").collect()] == ["SHORT", "GROWING", "COMPLETE"] and [r.verdict for r in out.where("folder = 'b'").collect()] == ["SHORT"]


def test_streams_match_batch(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(k, t0 + dt.timedelta(minutes=k), k % 3, "search_fail" if k % 7 else "kept") for k in range(120)] + [(999, t0 + dt.timedelta(days=1), 9, "kept")]
    schema = "event_id long, ts timestamp, rk long, event string"
    log = spark.createDataFrame(rows, schema)
    stream = _stream(spark, tmp_path, rows, schema)
    same = lambda a, b: {tuple(r) for r in a.collect()} == {tuple(r) for r in b.collect()}
    assert same(R.drained(R.transitions(stream)), W.transitions(log).select("rk", "event_id", "event", "before"))
    broke = R.drained(R.failure_breaker(stream, 3)).count()
    assert broke == W.failure_runs(log, 3).where("abort").count() > 0
    assert R.drained(R.quiet_folders(stream.withColumnRenamed("rk", "folder"), "5 minutes")).count() == 3
    assert R.drained(R.new_work(stream, log.where("rk = 1"))).select("rk").distinct().count() == 3
    assert R.drained(R.event_counts(stream, "1 hour"), "complete").agg(F.sum("n")).first()[0] == 121


def test_audits(spark):
    claimed = spark.createDataFrame([("d", 100.0), ("d", 110.0), ("d", 500.0), ("d", 20.0)], "disc string, sec double")
    measured = spark.createDataFrame([("d", 105.0), ("d", 130.0), ("e", 90.0)], "disc string, sec double")
    assert sorted(tuple(r) for r in U.reconcile_durations(claimed, measured).where("measured is not null").collect()) == [("d", 100.0, 105.0), ("d", 110.0, 130.0)]
    assert [r.claimed for r in U.reconcile_durations(claimed, measured).where("measured is null").collect()] == [500.0]
    tracks = spark.createDataFrame([("f", 0, "a", -20.0, -1.0), ("f", 1, None, -20.0, -1.0), ("g", 0, "", None, None), ("g", 1, "x", None, None)], "file_id string, track int, title string, mean_db double, max_db double")
    assert {r.file_id: r.verdict for r in U.audio_review(tracks).collect()} == {"f": "DUPLICATE?", "g": "UNTITLED"}
    agent = spark.createDataFrame([(1, "Episode 4", "S S00E04.mkv", 60000, True), (2, "Other", "S S00E01 - Title.mkv", 1, True), (3, "Title!", "S S00E01 - title.mkv", 1, False), (4, "A", "S S00E02.mkv", 90000, True)], "rk int, title string, file string, duration_ms long, locked boolean").withColumn("show", F.lit("s"))
    assert {r.rk: r.verdict for r in U.audit_specials(agent).collect()} == {1: "placeholder", 2: "contradicts", 3: "NOTE", 4: "UNVERIFIED"}
    files = spark.createDataFrame([("s", 1, 1, 3000.0), ("s", 1, 2, 1500.0)], "show string, season int, idx int, sec double")
    slots = spark.createDataFrame([("s", 1, k, 1500.0) for k in (1, 2, 3)], "show string, season int, idx int, sec double")
    assert [r.form for r in U.double_slot_files(files, slots).collect()] == ["E01-E02"]
    listing = spark.createDataFrame([("a", "m2ts", 5), ("b", "iso", 1), ("b", "iso", 1), ("c", "txt", 1)], "disc string, ext string, bytes long")
    assert {r.disc: r.kind for r in U.disc_kind(listing).collect()} == {"a": "Blu-ray", "b": "several ISOs", "c": "unusable"}
