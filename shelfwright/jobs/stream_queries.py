"""Streaming queries over the events table, which arrives in slices; each has the same over the whole table in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwright.streaming import streams as S

_LOG = "(SELECT event_id, ts, user_id AS rk, CASE WHEN event_type = 'error' THEN 'search_fail' ELSE event_type END AS event, value FROM events)"
SLICES = 3
#: A last row, far later than all others: it moves the watermark past everything.
_LAST = "2099-01-01"


def _by_time(log: DataFrame, slices: int = SLICES):
    """Which rows arrive in slice k: equal spans of the log's time."""
    low, high = log.agg(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))).first()
    width = (high - low) // slices + 1
    return lambda k: F.floor((F.unix_micros("ts") - low) / width) == k


def _closed(log: DataFrame) -> DataFrame:
    """The log with its last row."""
    return log.unionByName(log.sparkSession.range(1).select(F.lit(-1).cast("long").alias("event_id"), F.lit(_LAST).cast("timestamp").alias("ts"), F.lit(-1).cast("long").alias("rk"), F.lit("last").alias("event"), F.lit(0.0).alias("value")))


def _in_slices(log: DataFrame):
    """Slices by time; the far last row comes with the last slice."""
    when, last = _by_time(log), F.col("event_id") == -1
    return lambda k: F.when(last, F.lit(k == SLICES - 1)).otherwise(when(k))


def _r1(spark, sf_dir):
    log = S.events_log(spark, sf_dir)
    obs = log.select("ts", "event_id", "rk", "event", (F.col("value") % 7).cast("long").alias("bytes"))
    last = obs.groupBy("rk", "event").agg(F.max_by("bytes", F.struct("ts", "event_id")).alias("bytes"))
    source = last.groupBy(F.col("rk").alias("folder")).agg(F.count("*").cast("int").alias("files"), F.sum(F.col("bytes") + F.when(F.col("rk") % 3 == 0, 1).otherwise(0)).alias("total"))
    rows = _closed(log).select("event_id", "ts", F.col("rk").alias("folder"), F.col("event").alias("file"), (F.col("value") % 7).cast("long").alias("bytes"))
    with S.rocksdb_state(spark):
        return S.replayed(rows, _in_slices(log), lambda s: S.staging_gate(s.drop("event_id"), source, 600, keep_s=10**9), SLICES).where("folder >= 0")


def _r2(spark, sf_dir):
    log = S.events_log(spark, sf_dir)
    return S.replayed(_closed(log), _in_slices(log), lambda s: S.quiet_folders(s.withColumnRenamed("rk", "folder"), "5 minutes"), SLICES)


def _r3(spark, sf_dir):
    log = S.events_log(spark, sf_dir)
    return S.replayed(log, _by_time(log), S.transitions, SLICES)


def _r4(spark, sf_dir):
    log = S.events_log(spark, sf_dir)
    return S.replayed(log, _by_time(log), lambda s: S.failure_breaker(s, 3), SLICES)


def _r3_parts(spark, sf_dir):
    """Batches as tables whose hot keys are scanned in parts of 500 rows."""
    log = S.events_log(spark, sf_dir)
    drain = lambda s, top: S.drained_in_batches(s, S.transitions_step(500), "event string", "rk long, event_id long, event string, before string", top)
    return S.replayed(log, _by_time(log), lambda s: s, SLICES, drain)


def _r4_parts(spark, sf_dir):
    log = S.events_log(spark, sf_dir)
    drain = lambda s, top: S.drained_in_batches(s, S.breaker_step(3, per_part=500), "failures long", "rk long, event_id long", top)
    return S.replayed(log, _by_time(log), lambda s: s, SLICES, drain)


def _r5(spark, sf_dir):
    log = S.events_log(spark, sf_dir)
    return S.replayed(log, _by_time(log), lambda s: S.event_counts(s, "6 hours"), SLICES, "complete")


def _r5_late(spark, sf_dir):
    """Every twentieth event arrives a slice later than its time, too late for its windows."""
    log = S.events_log(spark, sf_dir)
    when, late = _in_slices(log), F.col("event_id") % 20 == 0
    delayed = lambda k: F.when(late, when(k - 1) if k else F.lit(False)).otherwise(when(k)) if k < SLICES - 1 else F.when(late, when(k - 1) | when(k)).otherwise(when(k))
    return S.replayed(_closed(log), delayed, lambda s: S.event_counts(s, "2 hours", "1 hour", "30 minutes"), SLICES)


def _r6(spark, sf_dir):
    log = S.events_log(spark, sf_dir)
    rows = log.select(F.col("event_id").alias("rk"), "ts", "event")
    decided = rows.where("rk % 4 = 0").select("rk")
    return S.replayed(rows.unionByName(rows.where("rk % 10 < 3")), _by_time(log), lambda s: S.new_work(s, decided), SLICES).select("rk", "event")


def _r7(spark, sf_dir):
    log = S.events_log(spark, sf_dir)
    return S.replayed(log, _by_time(log), S.latest_state, SLICES, "update").select("rk", "event", "event_id")


QUERIES = {
    "r1_stream_staging_gate": _r1, "r2_stream_quiet_folders": _r2, "r3_stream_transitions": _r3, "r4_stream_failure_breaker": _r4, "r3_transitions_in_parts": _r3_parts, "r4_breaker_in_parts": _r4_parts, "r5_stream_event_counts": _r5, "r5_stream_late_events": _r5_late, "r6_stream_new_work": _r6, "r7_stream_latest_state": _r7,
}
ORACLE_SQL = {
    "r1_stream_staging_gate": f"""WITH o AS (SELECT event_id, ts, rk AS folder, event AS file, CAST(floor(value % 7) AS BIGINT) AS bytes FROM {_LOG}),
l AS (SELECT folder, file, arg_max(bytes, (ts, event_id)) AS b FROM o GROUP BY 1, 2), s AS (SELECT folder, count(*) AS files, sum(b) + CASE WHEN folder % 3 = 0 THEN count(*) ELSE 0 END AS total FROM l GROUP BY 1),
d AS (SELECT *, lag(bytes) OVER (PARTITION BY folder, file ORDER BY ts, event_id) AS b0 FROM o), c AS (SELECT *, bytes IS DISTINCT FROM b0 AS changes, sum(bytes - coalesce(b0, 0)) OVER w AS t, count(*) FILTER (b0 IS NULL) OVER w AS n FROM d WINDOW w AS (PARTITION BY folder ORDER BY ts, file ROWS UNBOUNDED PRECEDING)),
v AS (SELECT c.*, t = total AND n = files AS same, max(ts) FILTER (changes) OVER (PARTITION BY folder ORDER BY ts, c.file ROWS UNBOUNDED PRECEDING) AS changed, lead(ts) OVER (PARTITION BY folder ORDER BY ts, c.file) AS next FROM c JOIN s USING (folder)),
done AS (SELECT folder, min(changed + INTERVAL 600 SECOND) AS done_at FROM v WHERE same AND (next IS NULL OR next >= changed + INTERVAL 600 SECOND) GROUP BY 1),
k AS (SELECT v.folder, v.ts, file, CASE WHEN same THEN 'GROWING' ELSE 'SHORT' END AS verdict FROM v LEFT JOIN done ON done.folder = v.folder WHERE done_at IS NULL OR v.ts < done_at),
e AS (SELECT *, lag(verdict) OVER (PARTITION BY folder ORDER BY ts, file) AS before FROM k)
SELECT folder, ts, verdict FROM e WHERE verdict IS DISTINCT FROM before UNION ALL SELECT folder, done_at, 'COMPLETE' FROM done""",
    "r2_stream_quiet_folders": f"""WITH g AS (SELECT rk AS folder, ts, CASE WHEN ts < lag(ts) OVER (PARTITION BY rk ORDER BY ts) + INTERVAL 5 MINUTE THEN 0 ELSE 1 END AS new FROM {_LOG}), r AS (SELECT *, sum(new) OVER (PARTITION BY folder ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run FROM g)
SELECT folder, min(ts) AS start, max(ts) + INTERVAL 5 MINUTE AS end, count(*) AS writes FROM r GROUP BY folder, run""",
    "r3_stream_transitions": f"SELECT rk, event_id, event, before FROM (SELECT *, lag(event) OVER (PARTITION BY rk ORDER BY ts, event_id) AS before FROM {_LOG}) WHERE event IS DISTINCT FROM before",
    "r4_stream_failure_breaker": f"""WITH r AS (SELECT *, sum(CASE WHEN event <> 'search_fail' THEN 1 ELSE 0 END) OVER (PARTITION BY rk ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM {_LOG}),
n AS (SELECT *, row_number() OVER (PARTITION BY rk, run ORDER BY ts, event_id) AS k FROM r WHERE event = 'search_fail') SELECT rk, event_id FROM n WHERE k = 3""",
    "r5_stream_event_counts": f"SELECT time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '1970-01-01') AS start, event, count(*) AS n FROM {_LOG} GROUP BY 1, 2",
    "r5_stream_late_events": f"""WITH b AS (SELECT min(epoch_us(ts)) AS lo, (max(epoch_us(ts)) - min(epoch_us(ts))) // {SLICES} + 1 AS width FROM events), e AS (SELECT l.*, (epoch_us(ts) - lo) // width AS own, CASE WHEN event_id % 20 = 0 THEN least((epoch_us(ts) - lo) // width + 1, {SLICES - 1}) ELSE (epoch_us(ts) - lo) // width END AS slice FROM {_LOG} l, b),
m AS (SELECT slice, max(ts) AS top FROM e GROUP BY 1), w AS (SELECT m.slice, (SELECT max(top) - INTERVAL 30 MINUTE FROM m x WHERE x.slice < m.slice) AS mark FROM m),
p AS (SELECT e.*, time_bucket(INTERVAL '1 hour', ts, TIMESTAMP '1970-01-01') - k * INTERVAL 1 HOUR AS start FROM e, (SELECT unnest([0, 1]) AS k))
SELECT start, event, count(*) AS n FROM p JOIN w USING (slice) WHERE mark IS NULL OR start + INTERVAL 2 HOUR > mark GROUP BY 1, 2""",
    "r6_stream_new_work": f"SELECT event_id AS rk, event FROM {_LOG} WHERE event_id % 4 > 0",
    "r7_stream_latest_state": f"SELECT rk, arg_max(event, (ts, event_id)) AS event, arg_max(event_id, (ts, event_id)) AS event_id FROM {_LOG} GROUP BY 1",
}
ORACLE_SQL |= {"r3_transitions_in_parts": ORACLE_SQL["r3_stream_transitions"], "r4_breaker_in_parts": ORACLE_SQL["r4_stream_failure_breaker"]}
