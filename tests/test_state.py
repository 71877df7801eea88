"""Versioned state, the upsert log's merges, and jobs that stop and go on."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from shelfwright.jobs import composite
from shelfwright.sources import state as S
from shelfwright.streaming import streams

NOW = dt.datetime(2024, 5, 1)
ROWS = "rk long, r string, ts timestamp"


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_versions_are_whole_or_not_there(spark, tmp_path, monkeypatch):
    t = S.StateTable(spark, str(tmp_path / "state"), ROWS)
    made = lambda *x: spark.createDataFrame([(k, r, NOW + dt.timedelta(days=d)) for k, r, d in x], ROWS)
    assert t.version() == 0 and rows_of(t.read()) == []
    assert t.commit(made((1, "a", 0), (2, "b", 1)), "first") == 1
    assert t.commit(made((1, "x", 5)), "first") == 1  # the same run again adds nothing
    t.staged(made((2, "lost", 9)))  # a job that stops before its commit
    assert t.commit(made((1, "old", -1), (2, "c", 1), (3, "n", 0))) == 2
    assert [(k, r) for k, r, _ in rows_of(t.read())] == [(1, "a"), (2, "c"), (3, "n")]  # latest by time, of equal times the new one
    assert [(k, r) for k, r, _ in rows_of(t.read(1))] == [(1, "a"), (2, "b")]
    # Two writers of one version: the second learns it.
    other = S.StateTable(spark, str(tmp_path / "state"), ROWS)
    number, folder = other.staged(made((3, "late", 9)))
    assert t.commit(made((4, "d", 0))) == 3
    with pytest.raises(S.Late):
        other.commits.add(number, {"folder": folder})
    assert (3, "n") in [(k, r) for k, r, _ in rows_of(other.read())]
    # A pointer that can't be moved leaves the version that was.
    monkeypatch.setattr(S.Commits, "add", lambda *a: (_ for _ in ()).throw(OSError("stopped")))
    with pytest.raises(OSError, match="stopped"):
        t.commit(made((5, "e", 0)))
    monkeypatch.undo()
    assert t.version() == 3 and t.read().count() == 4
    t.vacuum(keep=1)
    left = [p.name for p in (tmp_path / "state").iterdir() if p.name.startswith("v")]
    assert t.read().count() == 4 and t.commits.numbers() == [3] and all(int(n[1:].split("-")[0]) > 3 or n == t.commits.last()[1]["folder"] for n in left)


def tables(spark):
    make = lambda ddl, *rows: spark.createDataFrame(list(rows), ddl)
    items = make("rk long, show string, season int, ep int, ep_title string, duration double", *((k, f"Harbour Lights {k}" if k % 4 else "Salt Road", 1, k, "The Long Pier", 30.0 if k == 9 else 1000.0 + k) for k in range(1, 13)))
    streams_ = make("rk long, stream_type int, codec string, language_code string, language string, forced boolean", (1, 3, "srt", "eng", None, False))
    cands = make(
        "rk long, cand_id long, provider_rank long, title string, format string, score long",
        *((k, 100 * k + j, j, f"{'Harbour.Lights.' + str(k) if k % 4 else 'Salt.Road'}.S01E{k:02d}.cut{j}", "srt", 50 - j) for k in range(1, 13) if k != 7 for j in range(3)),
    )
    spans = make("cand_id long, last_end double, cues long", *((100 * k + j, 950.0 if j == k % 3 and k % 5 else 100.0, 200) for k in range(1, 13) for j in range(3)))
    block = make("key string, pattern string", ("2", "cut0"))
    return items, streams_, cands, block, spans


def test_search_stopped_and_run_again_equals_one_run(spark, tmp_path, monkeypatch):
    args = tables(spark)
    schema = composite.STATE.format(key="long")
    once = S.StateTable(spark, str(tmp_path / "once"), schema)
    assert composite.subtitle_search_job(once, *args, NOW, log=str(tmp_path / "log1")) == 1
    assert composite.subtitle_search_job(once, *args, NOW) == 1  # nothing left to decide
    parts = S.StateTable(spark, str(tmp_path / "parts"), schema)
    assert composite.subtitle_search_job(parts, *args, NOW, log=str(tmp_path / "log2"), limit=4) == 1
    monkeypatch.setattr(S.Commits, "add", lambda *a: (_ for _ in ()).throw(OSError("stopped")))
    with pytest.raises(OSError, match="stopped"):
        composite.subtitle_search_job(parts, *args, NOW, log=str(tmp_path / "log2"), limit=4)
    monkeypatch.undo()
    assert parts.read().count() == 4
    for _ in range(3):
        composite.subtitle_search_job(parts, *args, NOW, log=str(tmp_path / "log2"), limit=4)
    want = {r.rk: r for r in once.read().collect()}
    assert want == {r.rk: r for r in parts.read().collect()} and set(want) == set(range(2, 13))
    assert want[9].r == "skip_no_duration" and want[7].r == "no_candidates" and want[5].r == "no_match" and len(want[5].tried) == 3
    assert want[3].r == "matched" and want[3].kept.endswith("cut0") and len(want[3].tried) == 1 and want[2].kept.endswith("cut2") and [x.t[-4:] for x in want[2].tried] == ["cut1", "cut2"]
    logs = [rows_of(spark.read.json(str(tmp_path / f"log{k}")).select("rk", "event")) for k in (1, 2)]
    assert logs[0] == logs[1] and len(logs[0]) == 11
    # Named keys are decided again whatever was decided.
    fewer = (*args[:2], args[2].where("rk <> 3"), *args[3:])
    composite.subtitle_search_job(parts, *fewer, NOW + dt.timedelta(days=1), keys=[3])
    assert parts.read().where("rk = 3").first().r == "no_candidates" and parts.read().count() == 11


def test_resync_goes_on(spark, tmp_path):
    found = spark.createDataFrame([(k, f"l{k}", "matched" if k != 4 else "no_match") for k in range(1, 7)], "rk long, label string, r string")
    tracks = spark.createDataFrame([(k, 1, 200, None) for k in range(1, 6)], "rk long, ordinal int, cues int, forced boolean")
    cues = spark.createDataFrame([(k, 1, j, j * 10.0, j * 10.0 + 2, "t") for k in range(1, 6) for j in range(200)], "rk long, ordinal int, cue int, start_s double, end_s double, text string")
    align = spark.createDataFrame([(k, 2.0 if k < 4 else 0.01, 1.0) for k in range(1, 6)], "rk long, offset double, scale double")
    anchors = spark.createDataFrame([(k, 2010.0, 1.0, 1.5 if k != 2 else None) for k in range(1, 6)], "file_id long, dur double, oa double, ob double")
    make = lambda name: S.StateTable(spark, str(tmp_path / name), composite.RESYNC.format(key="long"))
    once, parts = make("once"), make("parts")
    whole = rows_of(composite.resync_job(once, found, tracks, cues, align, anchors, NOW))
    some = []
    for _ in range(4):
        some += composite.resync_job(parts, found, tracks, cues, align, anchors, NOW, limit=2).collect()
    assert sorted(map(tuple, some)) == whole and rows_of(once.read()) == rows_of(parts.read())
    assert {r.rk: r.r for r in once.read().collect()} == {1: "resynced", 2: "needs_review", 3: "resynced", 5: "already_aligned", 6: "no_usable_sub"}


def test_merged_batches_and_replays(spark, tmp_path):
    path, schema = str(tmp_path / "log"), spark.createDataFrame([], "rk long, event string").schema
    write = lambda n, *rows: spark.createDataFrame(list(rows), schema).write.mode("overwrite").parquet(f"{path}/batch={n}")
    assert streams.latest_of(spark, path, schema).count() == 0
    batches = [[(n % 5, f"e{n}"), (100 + n, "once")] for n in range(12)]
    for n, rows in enumerate(batches):
        write(n, *rows)
    want = rows_of(streams.latest_of(spark, path, schema))
    assert len(want) == 17 and (1, "e11") in want and upserts_read(spark, path) == (None, list(range(12)))
    streams.compact(spark, path, schema, 5)
    assert rows_of(streams.latest_of(spark, path, schema)) == want and upserts_read(spark, path)[1] == list(range(6, 12))
    write(5, *batches[5])  # a merged batch comes again: the same rows
    assert rows_of(streams.latest_of(spark, path, schema)) == want
    write(11, *batches[11])  # and the newest one, during the next merge
    streams.compact(spark, path, schema, 10)
    write(11, *batches[11])
    assert rows_of(streams.latest_of(spark, path, schema)) == want and upserts_read(spark, path)[1] == [11]
    ledger = json.loads(max((tmp_path / "log" / "merges").glob("*.json")).read_text())
    assert ledger["upto"] == 10 and not (tmp_path / "log" / "batch=5").exists()
    streams.compact(spark, path, schema)
    streams.compact(spark, path, schema)
    assert rows_of(streams.latest_of(spark, path, schema)) == want and len(list((tmp_path / "log").glob("merged-*"))) == 2


def upserts_read(spark, path):
    return streams.upsert_folders(spark, path)


def test_a_stream_merges_its_batches(spark, tmp_path):
    table = spark.range(40).select(F.col("id").alias("event_id"), (F.col("id") % 7).alias("rk"), F.concat(F.lit("e"), "id").alias("event"), F.timestamp_seconds("id").alias("ts"))
    for k in range(8):
        table.where(F.col("event_id") % 8 == k).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    latest = streams.latest_state(stream)
    out = str(tmp_path / "out")
    streams.upserts(latest, out, 3).option("checkpointLocation", str(tmp_path / "at")).trigger(availableNow=True).start().awaitTermination()
    assert {r.rk: r.event_id for r in streams.latest_of(spark, out, latest.schema).collect()} == {k: max(i for i in range(40) if i % 7 == k) for k in range(7)}
    merged, batches = streams.upsert_folders(spark, out)
    assert merged.startswith("merged-5-") and batches == [6, 7]
