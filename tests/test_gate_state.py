"""The staging gate's state: what a batch writes, timers, and restarts."""

import datetime as dt

from shelfwright.streaming import streams as R

SCHEMA = "ts timestamp, folder string, file string, bytes long"


def at(s):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)


def run(spark, tmp_path, rows, source, **options):
    """Adds rows and drains them; the query's progress with the puts of its state store."""
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    with R.rocksdb_state(spark):
        q = R.staging_gate(stream, source, **options).writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "log")).trigger(availableNow=True).start()
        q.awaitTermination()
    with_rows = [p for p in q.recentProgress if p["numInputRows"]]
    return sum(int(p["stateOperators"][0]["customMetrics"]["rocksdbPutCount"]) for p in with_rows)


def test_a_batch_writes_the_files_that_changed(spark, tmp_path):
    source = spark.createDataFrame([("a", 400, 401), ("b", 2, 9)], "folder string, files int, total long")
    first = run(spark, tmp_path, [(at(k % 50), "a", f"f{k:03}", 1) for k in range(400)], source)
    again = run(spark, tmp_path, [(at(60), "a", f"f{k:03}", 1) for k in range(300)], source)  # named, but unchanged
    last = run(spark, tmp_path, [(at(70), "a", "f007", 2), (at(70), "b", "x", 4)], source)
    assert first > 400 and again < 30 and last < 30
    done = run(spark, tmp_path, [(at(200), "b", "y", 5)], source)
    got = sorted((r.folder, r.ts, r.verdict) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [("a", at(0), "SHORT"), ("a", at(70), "GROWING"), ("a", at(130), "COMPLETE"), ("b", at(70), "SHORT"), ("b", at(200), "GROWING")] and done < 60


def test_timers_that_a_later_change_outruns(spark, tmp_path):
    source = spark.createDataFrame([("a", 1, 5), ("z", 9, 9)], "folder string, files int, total long")
    run(spark, tmp_path, [(at(0), "a", "x", 5)], source, keep_s=500)
    run(spark, tmp_path, [(at(50), "a", "x", 6), (at(55), "a", "x", 5)], source, keep_s=500)
    run(spark, tmp_path, [(at(130), "z", "x", 1)], source, keep_s=500)  # the watermark passes 60 s, not 115 s
    got = lambda: sorted((r.ts, r.verdict) for r in spark.read.parquet(str(tmp_path / "out")).where("folder = 'a'").collect())
    assert got() == [(at(0), "GROWING"), (at(50), "SHORT"), (at(55), "GROWING")]
    run(spark, tmp_path, [(at(400), "z", "x", 1)], source, keep_s=500)
    run(spark, tmp_path, [(at(401), "a", "x", 7)], source, keep_s=500)  # after it was complete: nothing changes
    assert got()[-1] == (at(115), "COMPLETE") and len(got()) == 4


def test_a_small_folder_is_one_row_of_state(spark, tmp_path):
    """Folders of few files put one row of state a batch; one that grows beyond that goes on in the map with the same verdicts."""
    source = spark.createDataFrame([(f"s{k}", 5, 15) for k in range(20)] + [("big", 70, 70)], "folder string, files int, total long")
    first = run(spark, tmp_path, [(at(k), f"s{j}", f"f{k}", 2) for j in range(20) for k in range(5)] + [(at(k % 7), "big", f"f{k}", 1) for k in range(60)], source)
    assert first < 70  # one row for each of 21 folders, and the counters beside it
    run(spark, tmp_path, [(at(20), f"s{j}", f"f{k}", 3) for j in range(20) for k in range(5)] + [(at(20), "big", f"f{k}", 1) for k in range(55, 70)], source)
    run(spark, tmp_path, [(at(25), "big", "f3", 2), (at(26), "big", "f3", 1), (at(30), "big", None, 0)], source)
    run(spark, tmp_path, [(at(500), "end", "x", 0)], source)
    got = sorted((r.folder, r.ts, r.verdict) for r in spark.read.parquet(str(tmp_path / "out")).where("folder <> 'end'").collect())
    want = [(f"s{j}", at(t), v) for j in range(20) for t, v in ((0, "SHORT"), (20, "GROWING"), (80, "COMPLETE"))]
    # A file may lack a name: it is one more file.
    assert [x for x in got if x[0] == "big"] == [("big", at(0), "SHORT"), ("big", at(20), "GROWING"), ("big", at(25), "SHORT"), ("big", at(26), "GROWING"), ("big", at(30), "SHORT")]
    # While sizes of 2 become 3 one by one at 20 s, the last of them makes the folder whole.
    assert [x for x in got if x[0] != "big"] == sorted(want)
