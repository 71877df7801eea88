"""Sinks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwright.functions import text as T
from shelfwright.session import stored
from shelfwright.sources.readers import DISC_FIELDS, STREAM_FIELDS, TITLE_FIELDS, snake


def write_files(files: DataFrame, path: str) -> DataFrame:
    """One file for each row of files (name, content): path/name. Returns (name, bytes) of what was written.

    Tasks write to a name of their own and then move it in place, so a task that runs again leaves the same files.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        store, top = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
        for batch in batches:
            names = batch.column(0).to_pylist()
            for name, content in zip(names, batch.column(1), strict=True):
                at = f"{top}/{name}"
                folder, _, leaf = at.rpartition("/")
                store.create_dir(folder, recursive=True)
                tmp = f"{folder}/.{leaf}.{uuid.uuid4().hex}"
                with store.open_output_stream(tmp) as out:
                    out.write(content.as_py() or b"")
                store.move(tmp, at)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(c.as_py() or b"") for c in batch.column(1)], pa.int64())], ["name", "bytes"])

    rows = files.select(F.col("name").cast("string").alias("name"), F.col("content").cast("binary").alias("content"))
    # Contents are large: some MB at once, where Spark hands on 64, in the executor and in its Python worker.
    conf, key = files.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    before = conf.get(key)
    conf.set(key, "8m")
    try:
        return stored(rows.mapInArrow(run, "name string, bytes long"), "written")
    finally:
        conf.set(key, before)


def write_srt(cues: DataFrame, path: str) -> DataFrame:
    """K3: one renumbered subtitle text for each file, path/<file_id>.srt, UTF-8 with plain line ends; (name, bytes) of each."""
    n = F.row_number().over(Window.partitionBy("file_id").orderBy("start_s", "cue"))
    block = F.concat_ws("\n", n.cast("string"), F.concat(T.sec_to_srt(F.col("start_s")), F.lit(" --> "), T.sec_to_srt(F.col("end_s"))), "text", F.lit(""))
    blocks = F.transform(F.array_sort(F.collect_list(F.struct("n", "block"))), lambda x: x["block"])
    files = cues.withColumn("n", n).withColumn("block", block).groupBy("file_id").agg(F.array_join(blocks, "\n").alias("content"))
    return write_files(files.select(F.concat(F.col("file_id").cast("string"), F.lit(".srt")).alias("name"), "content"), path)


def _written_entries(c: str) -> Column:
    """An array of (idx, title) as the list that a manifest holds: numbers, and [number, title] pairs of those with a title."""
    named = lambda e: F.concat(F.lit("["), e["idx"].cast("string"), F.lit(","), F.substr(F.to_json(F.array(e["title"])), F.lit(2)))
    each = F.transform(c, lambda e: F.when(e["title"].isNull(), e["idx"].cast("string")).otherwise(named(e)))
    return F.when(F.size(c) > 0, F.parse_json(F.concat(F.lit("["), F.array_join(each, ","), F.lit("]"))))


def _item(df: DataFrame) -> Column:
    """A manifest's item as JSON, fields without a value left out; a subTrack of digits is a number."""
    quoted = F.to_json(F.array("subTrack"))  # ["tag"]
    sub = F.parse_json(F.when(F.col("subTrack").rlike(r"^\d+$"), F.regexp_replace("subTrack", r"^0+(?=\d)", "")).otherwise(F.substr(quoted, F.lit(2), F.length(quoted) - 2)))
    own = {"subTrack": F.when(F.col("subTrack").isNotNull(), sub)} if "subTrack" in df.columns else {}
    own |= {c: _written_entries(c) for c in ("commentary", "audioDescription") if c in df.columns}
    return F.to_json(F.struct(*(own.get(c, F.col(c)).alias(c) for c in df.columns)))


def write_manifest(df: DataFrame, path: str, file_col: str | None = None) -> DataFrame | None:
    """K2: manifest rows as JSON, fields without a value left out; commentary and audioDescription are arrays of (idx, title).

    With file_col, a column that names each row's manifest, each manifest is a file path/<name>.json with a list of its items,
    and (name, bytes) of each comes back; without, Spark writes one item a line.
    """
    if file_col is None:
        df.select(_item(df).alias("value")).write.mode("overwrite").text(path)
        return None
    rows = df.select(F.col(file_col).cast("string").alias("name"), _item(df.drop(file_col)).alias("item"))
    files = rows.groupBy("name").agg(F.concat(F.lit("[\n"), F.array_join(F.array_sort(F.collect_list("item")), ",\n"), F.lit("\n]\n")).alias("content"))
    return write_files(files.select(F.concat("name", F.lit(".json")).alias("name"), "content"), path)


def write_catalogue(titles: DataFrame, streams: DataFrame, path: str, per_disc: bool = False) -> DataFrame | None:
    """K1: a nested catalogue of each disc, its titles with their streams, with the field names of read_catalogue().

    Spark writes one disc a line, many to a file, compressed; with per_disc each disc is an indented file path/<disc>.catalogue.json of its own, and
    (name, bytes) of each comes back. Of a disc's own columns (disc_path, min_length) the titles' largest are taken.
    """
    renamed = lambda df, fields: [F.col(snake(k)).alias(k) for k in fields if snake(k) in df.columns]
    own = [k for k in DISC_FIELDS if k not in ("disc", "titleCount") and snake(k) in titles.columns]
    # Titles and streams go through one shuffle, by disc. A stream without a disc or title is none of a title's.
    t = F.struct(F.struct(*renamed(titles, TITLE_FIELDS)).alias("t"), *(F.col(snake(k)).alias(k) for k in own)).alias("t")
    s = F.struct(*renamed(streams, STREAM_FIELDS)).alias("s")
    kinds = {k: x.select(c).schema[0].dataType for k, x, c in (("t", titles, t), ("s", streams, s))}
    none = lambda k: F.lit(None).cast(kinds[k]).alias(k)
    rows = titles.select("disc", "title", t, none("s")).unionAll(streams.where("disc is not null and title is not null").select("disc", "title", none("t"), s))
    each = rows.repartition("disc").groupBy("disc", "title").agg(F.collect_list("t").alias("t"), F.sort_array(F.collect_list("s")).alias("streams"))
    whole = each.select("disc", F.explode("t").alias("t"), "streams").select("disc", *(F.col(f"t.{k}") for k in own), F.struct("t.t.*", "streams").alias("title"))
    discs = whole.groupBy("disc").agg(*(F.max(k).alias(k) for k in own), F.count("*").cast("int").alias("titleCount"), F.sort_array(F.collect_list("title")).alias("titles"))
    if not per_disc:
        discs.write.mode("overwrite").option("compression", "gzip").json(path)
        return None
    name = F.concat(F.col("disc").cast("string"), F.lit(".catalogue.json"))
    return write_files(discs.select(name.alias("name"), F.to_json(F.struct(*discs.columns), {"pretty": "true"}).alias("content")), path)


def append_log(df: DataFrame, path: str, form: str = "json") -> None:
    """K4: rows added to a log or state of JSON lines, CSV or Parquet; what was there stays."""
    df.write.mode("append").format(form).save(path)


def write_run(df: DataFrame, path: str, run: str) -> None:
    """K4: the log rows of one run of a job, as path/run=<name>: a run that is repeated writes its rows again, none twice."""
    df.write.mode("overwrite").json(f"{path}/run={run}")
