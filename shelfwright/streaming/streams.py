"""The polling loops as Structured Streaming: stateful gates, transitions, breakers, windows and upserts."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from shelfwright.operators.common import PER_PART, with_previous, with_running_sum
from shelfwright.session import drop, new_path, stored
from shelfwright.sources.state import Commits, StateTable


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams that start inside keep their state in RocksDB, which writes what changes; staging_gate() needs it."""
    name, kind = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    before = spark.conf.get(name, None)
    spark.conf.set(name, kind)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


#: Files of a folder whose sizes lie in its one row of state.
FEW_FILES = 64


def staging_gate(obs: DataFrame, source: DataFrame, settle_s: int = 60, late: str = "1 minute", keep_s: int = 86_400) -> DataFrame:
    """(folder, ts, verdict) for each change of a folder's verdict: SHORT, GROWING (complete, but not yet quiet), COMPLETE.

    obs (ts, folder, file, bytes) is a stream, source (folder, files, total) a table. A folder is COMPLETE once files
    and bytes equal the source's and no size has changed for settle_s of event time; its ts is when that came true. The
    next observation tells it, or, if none comes, a timer as soon as the watermark (the latest time less `late`) has
    passed. Then the sizes go, and later observations change nothing; a further timer removes what is left keep_s after the
    last of them.

    State is one row of totals for each folder, with the sizes of its files while they are few; beyond FEW_FILES the sizes are a map by
    file, of which a batch reads the files that it names and writes those that have changed, however many files a folder has.
    Each reading and writing of state is a message to the executor and back, so a small folder's batch takes one of each.
    """
    # What the gate reads of a row is one text, as Spark hands rows to Python value by value: time, bytes, files, total, file; empty for null.
    said = [F.unix_micros("ts"), *(F.col(c).cast("long") for c in ("bytes", "files", "total")), F.concat(F.lit("="), F.col("file").cast("string"))]
    met = obs.withWatermark("ts", late).join(source, "folder", "left").select("folder", "ts", F.concat_ws("\0", *(F.coalesce(c.cast("string"), F.lit("")) for c in said)).alias("row"))
    settle, keep, few = settle_s * 1_000_000, keep_s * 1_000_000, FEW_FILES

    class Gate(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.sizes = handle.getMapState("sizes", "file string", "bytes long")
            self.totals = handle.getValueState("totals", "files long, bytes long, changed long, said string, done boolean, seen long, same boolean, few boolean, names array<string>, sizes array<long>")

        def _timer(self, us: int) -> None:
            self.handle.registerTimer(-(-us // 1000))

        def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
            batch = sorted((int(us), name, int(size), want) for us, size, *want, name in (r[-1].split("\0", 4) for r in rows))
            files, total, changed, said, done, seen, same, small, names, sizes = self.totals.get() or (0, 0, 0, "", False, 0, False, True, [], [])
            held, new, out = dict(zip(names, sizes, strict=True)), {}, []
            for us, name, size, want in batch:
                seen = max(seen, us)
                if not done and same and us >= changed + settle:
                    out.append((changed + settle, "COMPLETE"))
                    done = True
                if done:
                    continue
                if name not in held:
                    kept = None if small else self.sizes.getValue((name,))
                    held[name] = kept[0] if kept else None
                if held[name] != size:
                    files, total = files + (held[name] is None), total + size - (held[name] or 0)
                    held[name] = new[name] = size
                    changed = us
                same = want == [str(files), str(total)]
                verdict = "GROWING" if same else "SHORT"
                if verdict != said:
                    out.append((us, verdict))
                    said = verdict
            if done:
                if not small:
                    self.sizes.clear()
                small, held = True, {}
                self._timer(seen + keep)
            else:
                if small and files > few:
                    small, new = False, held  # from now on in the map
                if not small:
                    for name, size in new.items():
                        self.sizes.updateValue((name,), (size,))
                    held = {}
                if same:
                    self._timer(changed + settle)
            self.totals.update((files, total, changed, said, done, seen, same, small, list(held), list(held.values())))
            for us, verdict in out:
                yield Row(folder=key[0], us=us, verdict=verdict)

        def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
            at, kept = expiredTimerInfo.getExpiryTimeInMs() * 1000, self.totals.get()
            if kept:
                files, total, changed, said, done, seen, same, small, _, _ = kept
                if done and at >= seen + keep:
                    self.totals.clear()
                elif not done and same and at >= changed + settle:  # not one that a later change has outrun
                    if not small:
                        self.sizes.clear()
                    self.totals.update((files, total, changed, said, True, seen, same, True, [], []))
                    self._timer(seen + keep)
                    yield Row(folder=key[0], us=changed + settle, verdict="COMPLETE")

        def close(self) -> None:
            pass

    kind = obs.schema["folder"].dataType.simpleString()
    told = met.groupBy("folder").transformWithState(Gate(), f"folder {kind}, us long, verdict string", "append", "eventtime")
    return told.select("folder", F.timestamp_micros("us").alias("ts"), "verdict")


def quiet_folders(obs: DataFrame, quiet: str = "5 minutes", late: str = "1 minute") -> DataFrame:
    """R2: (folder, start, end, writes) of each run of writes, once nothing came for so long."""
    runs = obs.withWatermark("ts", late).groupBy(F.session_window("ts", quiet).alias("w"), "folder").agg(F.count("*").alias("writes"))
    return runs.select("folder", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "writes")


def transitions(status: DataFrame) -> DataFrame:
    """(rk, event_id, event, before) where the status of a key changes. State is one status a key.

    A key's rows of one batch are one sorted frame, compared as columns; the source bounds a batch (maxFilesPerTrigger).
    """

    def changes(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(chunks)).sort_values(["ts", "event_id"])
        before = rows.event.shift(1).astype(object)
        before.iloc[0] = state.get[0] if state.exists else None
        changed = (rows.event != before).to_numpy()
        state.update((rows.event.iloc[-1],))
        yield pd.DataFrame({"rk": key[0], "event_id": rows.event_id[changed], "event": rows.event[changed], "before": before[changed]})

    return status.groupBy("rk").applyInPandasWithState(changes, "rk long, event_id long, event string, before string", "last string", "append", GroupStateTimeout.NoTimeout)


def failure_breaker(log: DataFrame, n: int = 15, failure: str = "search_fail") -> DataFrame:
    """(rk, event_id) of the n-th failure in a row of a key; a success resets the count. State is one count a key.

    A key's rows of one batch are one sorted frame, counted as columns; the source bounds a batch (maxFilesPerTrigger).
    """

    def count(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(chunks)).sort_values(["ts", "event_id"])
        failed = rows.event == failure
        run = (~failed).cumsum()
        length = failed.groupby(run).cumsum() + (state.get[0] if state.exists else 0) * (run == 0)
        length = length.where(failed, 0)
        state.update((int(length.iloc[-1]),))
        yield pd.DataFrame({"rk": key[0], "event_id": rows.event_id[(length == n).to_numpy()]})

    return log.groupBy("rk").applyInPandasWithState(count, "rk long, event_id long", "failures int", "append", GroupStateTimeout.NoTimeout)


def in_batches(stream: DataFrame, path: str, step: Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]], state: str):
    """A writer that takes each batch as a table: step(batch, state) gives what it emits and the new state of the keys it changes.

    For keys so hot that a batch of theirs is no frame: a step may scan in parts, as batch operators do. What a batch emits is
    path/out/batch=N, its state a version that is committed after it; a batch that runs again after that emits nothing anew, one that
    stopped before starts from the state it had. state: columns besides rk, kept in path/state.
    """

    def run(df: DataFrame, n: int) -> None:
        spark = df.sparkSession
        kept = StateTable(spark, f"{path}/state", f"rk {df.schema['rk'].dataType.simpleString()}, {state}, ts timestamp")
        if kept.has_run(str(n)):
            return
        out, new = step(stored(df, "batch"), kept.read().drop("ts"))
        out.write.mode("overwrite").parquet(f"{path}/out/batch={n}")
        kept.commit(new.withColumn("ts", F.timestamp_seconds(F.lit(n))), str(n))

    return stream.writeStream.foreachBatch(run)


def transitions_step(per_part: int = PER_PART) -> Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]]:
    """R3 for in_batches(), with state `event string`: what transitions() emits, a key's rows of a batch scanned in parts of per_part."""

    def step(rows: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
        seen = with_previous(rows.withColumn("_e", F.struct("event")), ["rk"], ["ts", "event_id"], "_e", "_b", per_part)
        met = seen.join(state.select("rk", F.col("event").alias("_s")), "rk", "left").withColumn("before", F.when(F.col("_b").isNull(), F.col("_s")).otherwise(F.col("_b.event")))
        last = rows.groupBy("rk").agg(F.max_by(F.struct("event"), F.struct("ts", "event_id")).alias("x")).select("rk", "x.event")
        return met.where(~F.col("event").eqNullSafe(F.col("before"))).select("rk", "event_id", "event", "before"), last

    return step


def breaker_step(n: int = 15, failure: str = "search_fail", per_part: int = PER_PART) -> Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]]:
    """R4 for in_batches(), with state `failures long`: what failure_breaker() emits, a key's rows of a batch scanned in parts of per_part."""

    def step(rows: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
        failed = F.coalesce(F.col("event") == failure, F.lit(False))
        runs = stored(with_running_sum(rows.select("rk", "ts", "event_id", failed.alias("failed")), ["rk"], ["ts", "event_id"], F.when(F.col("failed"), 0).otherwise(1), "run", per_part), "runs")
        inside = with_running_sum(runs.where("failed"), ["rk", "run"], ["ts", "event_id"], F.lit(1), "length", per_part)
        carried = F.when(F.col("run") == 0, F.coalesce("failures", F.lit(0))).otherwise(0)
        hit = inside.join(state, "rk", "left").where(F.col("length") + carried == n).select("rk", "event_id")
        last = runs.groupBy("rk").agg(F.max("run").alias("last"))
        ends = runs.where("failed").groupBy("rk", "run").agg(F.count("*").alias("length"))
        new = last.join(ends.withColumnRenamed("run", "last"), ["rk", "last"], "left").join(state, "rk", "left")
        return hit, new.select("rk", (F.coalesce("length", F.lit(0)) + F.when(F.col("last") == 0, F.coalesce("failures", F.lit(0))).otherwise(0)).cast("long").alias("failures"))

    return step


def event_counts(log: DataFrame, size: str = "1 hour", slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Outcomes by tumbling or sliding window; what is later than the watermark is dropped."""
    counts = log.withWatermark("ts", late).groupBy(F.window("ts", size, slide).alias("w"), "event").agg(F.count("*").alias("n"))
    return counts.select(F.col("w.start").alias("start"), "event", "n")


def new_work(manifests: DataFrame, state: DataFrame, late: str = "1 hour") -> DataFrame:
    """Each arriving manifest once, without those that the state table has decided."""
    once = manifests.withWatermark("ts", late).dropDuplicatesWithinWatermark(["rk"])
    decided = state.select("rk", F.lit(True).alias("_decided")).distinct()
    return once.join(decided, "rk", "left").where(F.col("_decided").isNull()).drop("_decided")


def latest_state(log: DataFrame) -> DataFrame:
    """The latest event of each key that a batch changes, in update mode (all keys in complete mode)."""
    latest = log.groupBy("rk").agg(F.max_by(F.struct("event", "event_id", "ts"), F.struct("ts", "event_id")).alias("x"))
    return latest.select("rk", F.col("x.event").alias("event"), F.col("x.event_id").alias("event_id"), F.col("x.ts").alias("ts"))


#: Batches of an upsert log after which they are merged.
MERGE_AFTER = 16


def upserts(stream: DataFrame, path: str, merge_after: int = MERGE_AFTER):
    """A writer of what each batch changes, as path/batch=N: a batch that runs again writes the same folder, and no batch
    writes what another has written. latest_of() reads it; every merge_after batches those before the newest one, which alone
    can run again as it was, are merged by compact()."""

    def write(df: DataFrame, n: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch={n}")
        if n and n % merge_after == 0:
            compact(df.sparkSession, path, df.schema, n - 1)

    return stream.writeStream.outputMode("update").foreachBatch(write)


def _batches(spark: SparkSession, path: str) -> list[int]:
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(fs_path)] if fs.exists(fs_path) else []
    return sorted(int(n.removeprefix("batch=")) for n in names if n.startswith("batch=") and n.removeprefix("batch=").isdigit())


def upsert_folders(spark: SparkSession, path: str, upto: int | None = None) -> tuple[str | None, list[int]]:
    """What latest_of() reads: the newest merged folder, and the batches that came after it (to upto)."""
    info = Commits(spark, f"{path}/merges").last()[1]
    return info.get("folder"), [n for n in _batches(spark, path) if n > info.get("upto", -1) and (upto is None or n <= upto)]


def _latest_with_batch(spark: SparkSession, path: str, schema: T.StructType, upto: int | None = None) -> DataFrame:
    whole = T.StructType([*(f for f in schema.fields if f.name != "batch"), T.StructField("batch", T.LongType())])
    merged, batches = upsert_folders(spark, path, upto)
    parts = [spark.read.schema(whole).parquet(f"{path}/{merged}")] if merged else []
    if batches:
        parts.append(spark.read.schema(whole).option("basePath", path).parquet(*(f"{path}/batch={n}" for n in batches)))
    rows = reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], whole)
    names = [f.name for f in whole.fields if f.name != "rk"]
    return rows.groupBy("rk").agg(F.max_by(F.struct(*names), "batch").alias("x")).select("rk", *(F.col(f"x.{c}").alias(c) for c in names))


def compact(spark: SparkSession, path: str, schema: T.StructType, upto: int | None = None) -> None:
    """The batches of an upsert log to upto (all) as one merged folder, which a ledger names once it is whole; then they are
    removed. A batch to upto that is written again, meanwhile or later, says what the merged folder has of it and is not
    looked at; the next merge removes it. The folder merged before stays for readers that have begun."""
    ledger = Commits(spark, f"{path}/merges")
    number, info = ledger.last()
    batches = _batches(spark, path)
    upto = max(batches, default=-1) if upto is None else upto
    if upto > info.get("upto", -1) and any(n <= upto for n in batches):
        folder = f"merged-{upto}-{uuid.uuid4().hex}"
        _latest_with_batch(spark, path, schema, upto).write.parquet(f"{path}/{folder}")
        ledger.add(number + 1, {"folder": folder, "upto": upto, "before": info.get("folder")})
        if info.get("before"):
            drop(spark, [f"{path}/{info['before']}"])
    drop(spark, [f"{path}/batch={n}" for n in batches if n <= upto])


def latest_of(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The newest row of each key of what upserts() wrote: one merged folder and the few batches since."""
    return _latest_with_batch(spark, path, schema).drop("batch")


def drained_in_batches(stream: DataFrame, step: Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]], state: str, schema: str, top: str) -> DataFrame:
    """What in_batches() emits for all that is there now, going on where a run in the folder top ended."""
    in_batches(stream, top, step, state).option("checkpointLocation", f"{top}/log").trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(schema).option("basePath", f"{top}/out").parquet(f"{top}/out").drop("batch")


def drained(stream: DataFrame, mode: str = "append", top: str | None = None) -> DataFrame:
    """What a stream emits for all that is there now, as a table in the shared folder; with top, going on where a run there ended.

    append: every batch adds rows, exactly once by the sink's own log; update: batches of changed rows by key rk, of which
    the newest count; complete: each batch replaces the table.
    """
    spark = stream.sparkSession
    top = top or new_path(spark, "stream")
    if mode == "append":
        writer = stream.writeStream.outputMode(mode).format("parquet").option("path", f"{top}/out")
    elif mode == "update":
        writer = upserts(stream, f"{top}/out")
    else:
        writer = stream.writeStream.outputMode(mode).foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(f"{top}/out"))
    writer.option("checkpointLocation", f"{top}/log").trigger(availableNow=True).start().awaitTermination()
    return latest_of(spark, f"{top}/out", stream.schema) if mode == "update" else spark.read.schema(stream.schema).parquet(f"{top}/out")


def replayed(table: DataFrame, arrives, build: Callable[[DataFrame], DataFrame], slices: int = 3, mode: str | Callable[[DataFrame, str], DataFrame] = "append") -> DataFrame:
    """What build(stream) emits if table arrives in slices, those rows first for which arrives(k) holds for the lowest k. mode: one of
    drained(), or a function (stream, folder) that drains it.

    After each slice the query ends and is started anew from its checkpoint, so state has to survive both.
    """
    spark = table.sparkSession
    top = new_path(spark, "replay")
    out = None
    for k in range(slices):
        table.where(arrives(k)).write.mode("append").parquet(f"{top}/in")
        stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1000).parquet(f"{top}/in")
        out = mode(build(stream), f"{top}/run") if callable(mode) else drained(build(stream), mode, f"{top}/run")
    return out


def events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a log (event_id, ts, rk, event)."""
    raw = spark.read.parquet(f"{sf_dir}/events.parquet")
    return raw.select("event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").alias("rk"), F.when(F.col("event_type") == "error", "search_fail").otherwise(F.col("event_type")).alias("event"), "value")
