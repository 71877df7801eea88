"""Scans in parts of a hot key, the fold of durations, and sketches."""

import collections
import random

from pyspark.sql import Window, functions as F

from shelfwright.operators import aggregates as A, audits as U, common as C, predicates as P, ranking as W, reconcile as J
from shelfwright.sources.state import StateTable
from shelfwright.streaming import streams as R


def hot_log(spark, n=900):
    """A third of all rows under one key, ties in time, null events."""
    draw = random.Random(3)
    rows = [(k, draw.randrange(200), 7 if k % 3 == 0 else draw.randrange(40), draw.choice(["search_fail", "search_fail", "ok", None])) for k in range(n)]
    return spark.createDataFrame(rows + [(10_000 + k, k, None, "ok") for k in range(40)], "event_id long, ts long, rk long, event string").repartition(4)


def test_parts_of_a_hot_key_equal_one_window(spark):
    log = hot_log(spark)
    parts = C.in_parts(log, ["rk"], ["ts", "event_id"], 50)
    sizes = {(r.rk, r._part): r["count"] for r in parts.groupBy("rk", "_part").count().collect()}
    assert sum(k == 7 for k, _ in sizes) >= 5 and max(sizes.values()) <= 100 and max(r["count"] for r in parts.groupBy("_part").count().collect()) <= 100
    assert C.in_parts(log, ["rk"], ["ts", "event_id"], 10_000) is None
    w = Window.partitionBy("rk").orderBy("ts", "event_id")
    want = {r.event_id: (r.b, r.s) for r in log.withColumn("b", F.lag("event").over(w)).withColumn("s", F.sum(F.col("event_id") % 5).over(w.rowsBetween(Window.unboundedPreceding, 0))).collect()}
    for per_part in (50, 7, 10_000):
        got = C.with_running_sum(C.with_previous(log, ["rk"], ["ts", "event_id"], "event", "b", per_part), ["rk"], ["ts", "event_id"], F.col("event_id") % 5, "s", per_part).collect()
        assert {r.event_id: (r.b, r.s) for r in got} == want


def test_operators_on_a_hot_key(spark):
    log = hot_log(spark).where("event is not null")
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(W.failure_runs(log, 3, per_part=40)) == rows(W.failure_runs(log, 3)) != []
    some = lambda df: rows(df.select("rk", "event_id", "event", "before"))
    assert some(W.transitions(log, per_part=40)) == some(W.transitions(log)) != []
    packets = [(f, 0, k * 0.032) for f in ("hot", "b") for k in range(1500 if f == "hot" else 300) if (k * 7 + len(f)) % 90 > 3]
    table = spark.createDataFrame(packets, "file_id string, track int, pts double")
    assert rows(A.audio_gaps(table, per_part=100)) == rows(A.audio_gaps(table)) and len(rows(A.audio_gaps(table))) == 2


def test_runtimes_of_a_hot_season(spark):
    """A season with a third of all rows, ties of episodes and of files: parts give what one order gives, and what all pairs give."""
    draw = random.Random(5)
    season = lambda k: "hot" if k % 3 == 0 else f"s{k % 4}"
    canon = [(season(k), 1, k, draw.randrange(200, 400) / 10) for k in range(150)] + [("hot", 1, 900, None), ("one", 1, 1, 20.0)]
    files = [(f"f{k}", season(k), 1, draw.randrange(180, 460) / 10) for k in range(300)] + [("g", "hot", 1, None), ("h", "one", 1, 22.5), ("i", "none", 1, 3.0)]
    a, b = spark.createDataFrame(files, "file_id string, show string, season int, file_mins double"), spark.createDataFrame(canon, "show string, season int, idx int, mins double")
    got = {per: {r.file_id: tuple(r) for r in J.match_by_runtime(a, b, per).collect()} for per in (25, 1 << 20)}
    assert got[25] == got[1 << 20] and len(got[25]) == len(files)
    for name, show, _, mins in files:
        near = sorted((abs(mins - m), i) for s, _, i, m in canon if s == show and m is not None) if mins is not None else []
        _, idx, delta, gap, verdict = got[25][name]
        assert idx == (near[0][1] if near else None)
        if near:
            assert abs(delta - near[0][0]) <= 0.05 + 1e-9 and abs(gap - (near[1][0] - delta if len(near) > 1 else 99.0)) <= 0.05 + 1e-9
            assert verdict == ("NO CLOSE MATCH" if delta > 3 else "AMBIGUOUS" if gap < 1 else "ok")
        else:
            assert verdict == ("NO DURATION" if mins is None else "NO CLOSE MATCH")


def test_streams_scan_hot_keys_in_parts(spark, tmp_path):
    """Batches as tables give what the keyed streams give, and a batch that runs again adds nothing."""
    draw = random.Random(9)
    rows = [(k, 1000 * (k // 40) + draw.randrange(50), 7 if k % 3 == 0 else draw.randrange(5), draw.choice(["search_fail", "search_fail", "search_fail", "ok"])) for k in range(240)]
    log = spark.createDataFrame(rows, "event_id long, t long, rk long, event string").withColumn("ts", F.timestamp_seconds("t")).drop("t")
    schema = log.schema
    for k in range(3):
        log.where(f"event_id div 80 = {k}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    same = lambda a, b: sorted(map(str, a.collect())) == sorted(map(str, b.collect())) != []
    top = str(tmp_path / "t")
    got = R.drained_in_batches(stream, R.transitions_step(10), "event string", "rk long, event_id long, event string, before string", top)
    assert same(got, W.transitions(log).select("rk", "event_id", "event", "before"))
    kept = StateTable(spark, f"{top}/state", "rk long, event string, ts timestamp")
    before = (kept.version(), sorted(map(str, got.collect())))
    R.in_batches(stream, top, R.transitions_step(10), "event string").option("checkpointLocation", str(tmp_path / "again")).trigger(availableNow=True).start().awaitTermination()
    assert (kept.version(), sorted(map(str, got.collect()))) == before and kept.has_run("2")
    got = R.drained_in_batches(stream, R.breaker_step(3, per_part=10), "failures long", "rk long, event_id long", str(tmp_path / "b"))
    assert same(got, R.drained(R.failure_breaker(stream, 3)))


def test_durations_fold(spark):
    draw = random.Random(8)
    claimed = [(d, draw.choice([30.0, 59.9, 60.0, *(float(draw.randrange(60, 700)) for _ in range(9))])) for d in range(40) for _ in range(draw.randrange(1, 12))] + [(99, None), (98, 100.0)]
    measured = [(d, float(draw.randrange(50, 700))) for d in range(40) for _ in range(draw.randrange(0, 12))] + [(99, 100.0), (0, None)]
    want = collections.Counter()
    for d in {d for d, _ in claimed}:
        pool = sorted(s for k, s in measured if k == d and s is not None and s >= 60)
        for c in sorted(s for k, s in claimed if k == d and s is not None and s >= 60):
            hit = next((m for m in pool if abs(m - c) <= 30), None)
            if hit is not None:
                pool.remove(hit)
            want[d, c, hit] += 1
    make = lambda rows: spark.createDataFrame(rows, "disc int, sec double")
    got = U.reconcile_durations(make(claimed), make(measured))
    assert collections.Counter(map(tuple, got.collect())) == want and "Python" not in got._jdf.queryExecution().toString()


def test_sketches_of_many_libraries(spark):
    items = spark.range(6000).select(F.col("id").alias("rk"), (F.col("id") % 4).alias("library"))
    items = items.unionByName(items.withColumn("library", F.lit(9).cast("long")))  # all items are in library 9, too
    streams = items.where("rk % 3 > 0 and library = 9").select("rk", F.lit(3).alias("stream_type"), F.when(F.col("rk") % 3 == 1, "srt").otherwise("pgs").alias("codec"))
    sketches = A.subtitle_sketches(items, streams, P.TEXT_CODECS, ["library"])
    got = {r.kind: (r.n, r.pct) for r in A.sketched_shares(sketches).collect()}
    assert set(got) == {"none", "text", "image only"} and all(abs(n - 2000) <= 100 and abs(pct - 33.33) < 1.5 for n, pct in got.values())
    each = {(r.library, r.kind): r.n for r in A.sketched_shares(sketches, ["library"]).collect()}
    assert len(each) == 15 and all(abs(n - (2000 if k[0] == 9 else 500)) <= (100 if k[0] == 9 else 25) for k, n in each.items())
