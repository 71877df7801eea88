"""Cases of the third round's findings about growth."""

import datetime as dt

from pyspark.sql import functions as F

from shelfwright.jobs import composite
from shelfwright.operators import aggregates as A, common as C, predicates as P, ranking as W
from shelfwright.session import tracked
from shelfwright.sources import readers as S
from shelfwright.sources.state import StateTable


def test_uniform_shift_counts_pairs_without_making_them(spark):
    """A title that a season has 100,000 times on both sides: 10^10 pairs, none of which is made."""
    many = spark.range(100_000).select(F.lit("s").alias("show"), F.lit(1).alias("season"), F.lit(7).alias("idx"), F.lit("The Pilot").alias("title"))
    few = spark.createDataFrame([("s", 2, 5, "A"), ("s", 2, None, "A"), ("s", 2, 6, "B"), ("s", 3, 1, "C"), ("s", 3, 2, "C"), ("s", 4, 1, None), ("t", 1, 1, "D")], "show string, season int, idx int, title string")
    agent = many.unionByName(few)
    files = agent.withColumn("idx", F.col("idx") - 1)
    assert sorted(map(tuple, W.uniform_shift(agent, files).collect())) == [("s", 1, 1, 10**10), ("s", 2, 1, 5)]
    one = few.where("season = 2 and (idx is null or idx > 5)")
    assert sorted(map(tuple, W.uniform_shift(one, one.withColumn("idx", F.col("idx") - 2)).collect())) == [("s", 2, 2, 2)]


def _joins(df, capsys) -> int:
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out.count("SortMergeJoin")


def test_gaps_of_whole_tracks_need_no_joins(spark, capsys):
    """Tracks dealt out whole are scanned by windows alone; cut into parts they say the same."""
    packets = spark.range(600).select((F.col("id") % 4).alias("file_id"), F.lit(0).alias("track"), (F.floor(F.col("id") / 4) * F.when(F.col("id") % 4 == 1, 0.04).otherwise(0.032)).alias("pts"))
    packets = packets.where("not (file_id = 2 and pts > 1 and pts < 1.5) and not (file_id = 3 and pts > 1)").unionByName(spark.createDataFrame([(None, 0, 0.1)], "file_id long, track int, pts double"))
    whole, cut = A.audio_gaps(packets), A.audio_gaps(packets, per_part=20)
    assert sorted(whole.collect()) == sorted(cut.collect()) and whole.count() == 3
    assert _joins(whole, capsys) == 0


def test_titles_of_whole_discs_need_no_joins(spark, capsys):
    """Discs dealt out whole are scanned by windows alone; cut into parts they say the same, and discs without a number too."""
    n = F.col("id")
    titles = spark.range(400).select(F.when(n % 10 > 0, n % 10).alias("disc"), (n / 10).cast("int").alias("title"), (F.when(n % 7 == 0, 273.0).when(n % 31 == 0, 9000.0).otherwise(10.0 + n * 7919 % 3000)).alias("sec"), (n % 11 > 0).alias("has_video"), F.lit(2).alias("audio"), (n % 13 == 0).alias("phantom"))
    whole, cut = P.classify_probed_titles(titles), P.classify_probed_titles(titles, per_part=20)
    said = sorted(whole.collect(), key=str)
    assert said == sorted(cut.collect(), key=str) and {r.label for r in said} == {"ARTIFACT", "BOILERPLATE", "PLAYALL?", "EPISODE?", "REVIEW"}
    assert _joins(whole, capsys) == 0


def test_medians_by_windows_and_by_sketch(spark):
    """A group has one median whichever way it is found; rows that do not count, nulls and null keys keep their place."""
    n = F.col("id")
    rows = spark.range(300).select(F.when(n % 9 > 0, n % 9).alias("k"), F.when(n % 8 > 0, n * 37 % 101 / 4).alias("v"), (n % 5 > 0).alias("w"))
    for where in (None, F.col("w") & (F.col("k") > 2)):
        whole, cut = (sorted(C.with_rint_median(rows, ["k"], "v", "m", where, most).collect(), key=str) for most in (1000, 10))
        assert whole == cut and any(r.m for r in whole) and not any(r.m for r in whole if r.k is None)


def test_anchors_meet_the_cues_of_their_own_track(spark):
    """Anchors that name a track meet its cues alone, in the one join that cues go through."""
    cues = spark.range(400).select(F.lit(1).alias("file_id"), (F.col("id") % 2).cast("int").alias("ordinal"), (F.col("id") * 5.0).alias("start_s"))
    anchors = spark.createDataFrame([(1, 0, 2000.0, 0.1, 0.2)], "file_id int, ordinal int, dur double, oa double, ob double")
    got = A.anchor_fit(cues, anchors, ["file_id", "ordinal"]).collect()
    assert got == A.anchor_fit(cues.where("ordinal = 0"), anchors.drop("ordinal")).collect() and got[0].reason == "ok"


def test_tokens_do_not_move_to_a_dictionary_that_fits(spark, capsys):
    """Only rows of files are shuffled; verdicts are those that counted words find by a join."""
    line = lambda k: " ".join(f"{'the' if j % 3 else 'word'}{'' if j % 3 else chr(97 + (k + j) % 26)} worda's it's" for j in range(8))
    texts = spark.createDataFrame([(f"f{k}", "\n".join(f"{n}\n00:00:01,000 --> 00:00:02,000\n{line(k + n)}" for n in range(1, 3 + 4 * k))) for k in range(8)], "file_id string, text string")
    probes = texts.select("file_id", F.lit(100.0).alias("sec"), F.lit(4).alias("max_packets"))
    words = spark.createDataFrame([("The",), ("it",), ("worda",), ("wordb",), ("worda",), (None,)], "word string")
    here = A.ocr_gates(texts, probes, words)
    capsys.readouterr()
    here.explain()
    plan = capsys.readouterr().out
    assert "hashpartitioning(file_id#" in plan and "hashpartitioning(w#" not in plan and ", w#" not in "".join(x for x in plan.splitlines() if "hashpartitioning(" in x)
    rows = sorted(map(tuple, here.collect()))
    assert rows == sorted(map(tuple, A.ocr_gates(texts, probes, words, whole_words=3).collect())) and len({r[7] for r in rows}) > 1


def test_a_search_with_nothing_to_do_looks_at_no_candidate(spark, tmp_path):
    items = spark.createDataFrame([(1, "Harbour", 1, 1, "The Long Pier", 1000.0)], "rk long, show string, season int, ep int, ep_title string, duration double")
    media = spark.createDataFrame([(1, 3, "srt", "eng", None, False)], "rk long, stream_type int, codec string, language_code string, language string, forced boolean")
    cands = spark.createDataFrame([], "rk long, cand_id long, provider_rank long, title string, format string, score long")
    spans, block = spark.createDataFrame([], "cand_id long, last_end double, cues long"), spark.createDataFrame([], "key string, pattern string")
    state = StateTable(spark, str(tmp_path / "state"), composite.STATE.format(key="long"))
    with tracked() as made:
        assert composite.subtitle_search_job(state, items, media, cands, block, spans, dt.datetime(2024, 5, 1)) == 0
    assert not any("verdicts-" in path for path in made)


def test_a_log_is_parsed_once_for_titles_and_streams(spark, tmp_path):
    (tmp_path / "d1.log").write_text('MSG:1,"x"\nTINFO:0,9,0,"0:01:40"\nTINFO:0,27,0,"a, b.mkv"\nSINFO:0,0,1,6201,"Video"\nSINFO:0,1,4,0,"eng"\nTINFO:1,3,0,"other"\nSINFO:x,0,1,0,"Video"\nTINFO:broken\n')
    with tracked() as made:
        titles, streams = S.read_robot_log(spark, str(tmp_path), once=True)
    assert [p.rpartition("/")[2].partition("-")[0] for p in made] == ["log"]
    assert sorted((r.disc, r.title, r.sec, r.out_name) for r in titles.collect()) == [("d1", 0, 100.0, "a, b.mkv"), ("d1", 1, None, None)]
    assert sorted((r.title, r.n, r.type, r.lang) for r in streams.collect()) == [(0, 0, "Video", None), (0, 1, None, "eng")]
    for a, b in zip((titles, streams), S.read_robot_log(spark, str(tmp_path)), strict=True):
        assert a.schema == b.schema and sorted(a.collect(), key=str) == sorted(b.collect(), key=str)


def test_readings_are_decoded_once(spark, tmp_path, capsys):
    """What is worked out of a text works on text that is there, not on the bytes of its file once more for each use."""
    (tmp_path / "f1").mkdir()
    (tmp_path / "f1" / "cue_0001.txt").write_bytes("caf\xe9 \n\n two".encode("cp1252"))
    (tmp_path / "f1" / "cue_0002_res.json").write_text('{"rec_texts": ["low", "high"], "rec_boxes": [[0, 9, 1, 10], [0, 1, 1, 2]]}')
    got = S.read_ocr_results(spark, str(tmp_path))
    capsys.readouterr()
    got.explain()
    assert "binaryFile" not in capsys.readouterr().out
    assert sorted(map(tuple, got.collect())) == [("f1", 1, "caf\xe9\ntwo"), ("f1", 2, "high\nlow")]
