"""Readers of the archive's own file formats; each gives tables with fixed columns."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from shelfwright.functions import text as T
from shelfwright.session import stored

# Codes of a robot log's title and stream attributes.
TITLE_CODES = {9: "duration", 10: "size_text", 16: "source", 27: "out_name"}
STREAM_CODES = {1: "type", 4: "lang", 6: "codec", 13: "bitrate", 14: "channels", 19: "resolution", 30: "label"}


#: Read partitions that a task takes one after another: each holds only a few small files.
PER_TASK = 16


@contextmanager
def _listed(spark: SparkSession) -> Iterator[None]:
    """Folders are listed by a few tasks a core inside the block, not by up to 10,000 tasks of a folder each."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    spark.conf.set(key, str(4 * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _files(spark: SparkSession, path: str) -> DataFrame:
    """Whole files that a pattern names, listed once."""
    with _listed(spark):
        return spark.read.format("binaryFile").load(path)


def _store(path: str) -> tuple[fs.FileSystem, str, str] | None:
    """Arrow's store of a folder, where the folder is in it, and what Spark calls the folder; None where Arrow sees no folder."""
    local = path.removeprefix("file:") if path.startswith("file:") else path if "://" not in path else None
    try:
        store, top = (fs.LocalFileSystem(), f"/{local.strip('/')}") if local and local.startswith("/") else fs.FileSystem.from_uri(path)
        seen = store.get_file_info(top).type == fs.FileType.Directory
    except (pa.ArrowException, ValueError, OSError):
        return None
    return (store, top.rstrip("/"), f"file:{top}".rstrip("/") if local else path.rstrip("/")) if seen else None


#: Bytes that a reading task reads in all, about.
_PER_READ = 1 << 26


def _tree(spark: SparkSession, root: str, only: str = "", contents: bool = True) -> DataFrame:
    """(path, rel, length, modificationTime, content) of the files below a folder at any depth whose path has the pattern only; rel is
    the path below the folder. Names and files are those that Spark lists: none that are hidden, or of no bytes.

    Tasks list the folders, a level after another, and read the files, so that the driver holds no list of them. Where only Spark can
    read the folder, or a pattern or a file is named, Spark lists it.
    """
    at = _store(root)
    if at is None:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
        with _listed(spark):
            found = files.load(root)
        whole = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
        above = whole.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(whole).toString().rstrip("/") + "/"
        rel = F.when(F.startswith("path", F.lit(above)), F.substr("path", F.lit(len(above) + 1))).otherwise(F.col("path"))
        return _dealt(found.where(F.col("path").rlike(only)).select("path", rel.alias("rel"), "length", "modificationTime", *["content"] * contents))
    store, top, name = at

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def hidden(x: str) -> bool:
            return x.startswith(".") or x.endswith("._COPYING_") or (x.startswith("_") and "=" not in x)

        kinds = [pa.string(), pa.bool_(), pa.int64(), pa.timestamp("us", "UTC")]
        batch = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["rel", "folder", "length", "modificationTime"])
        rows: list[tuple] = []
        for each in batches:
            for folder in each.column(0).to_pylist():
                for x in store.get_file_info(fs.FileSelector(f"{top}/{folder}" if folder else top or "/")):
                    below = x.type == fs.FileType.Directory
                    if not hidden(x.base_name) and (below or x.size):
                        rows.append((f"{folder}/{x.base_name}" if folder else x.base_name, below, x.size or 0, (x.mtime_ns or 0) // 1_000_000 * 1000))
                    if len(rows) >= 10_000:
                        yield batch(rows)
                        rows = []
        if rows:
            yield batch(rows)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for each in batches:
            first, held, size = 0, [], 0
            for i, rel in enumerate(each.column(0).to_pylist()):
                with store.open_input_file(f"{top}/{rel}") as f:
                    held.append(f.read())
                size += len(held[-1])
                if size >= 1 << 24 or i + 1 == each.num_rows:
                    yield pa.RecordBatch.from_arrays([*each.slice(first, i + 1 - first).columns, pa.array(held, pa.binary())], [*each.schema.names, "content"])
                    first, held, size = i + 1, [], 0

    cores = spark.sparkContext.defaultParallelism
    levels, folders = [], spark.range(0, 1, 1, 1).select(F.lit("").alias("rel"))
    while True:
        levels.append(level := stored(folders.mapInArrow(listed, "rel string, folder boolean, length long, modificationTime timestamp"), "listing"))
        if not (n := level.where("folder").count()):
            break
        folders = level.where("folder").select("rel").repartition(min(4 * cores, -(-n // PER_TASK)), "rel")
    path = F.concat(F.lit(f"{name}/"), "rel").alias("path")
    files = reduce(DataFrame.unionAll, levels).where("not folder").select(path, "rel", "length", "modificationTime").where(F.col("path").rlike(only))
    if not contents:
        return _dealt(files)
    total, size = files.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    tasks = max(1, min(-(-total // PER_TASK), 4 * cores), -(-size // _PER_READ))
    rows = files.select("rel", "length", "modificationTime").repartition(tasks, "rel").mapInArrow(read, "rel string, length long, modificationTime timestamp, content binary")
    return rows.select(path, "rel", "length", "modificationTime", "content")


def _lines(spark: SparkSession, path: str, whole: bool = False) -> DataFrame:
    with _listed(spark):
        return spark.read.text(path, wholetext=whole)


def _dealt(df: DataFrame) -> DataFrame:
    """df, which reads many small files, in fewer tasks: Spark puts no more than a handful of small files in a partition, and each task
    has a cost of its own and tells the driver of itself. To be called on what is selected, so that no content is read in vain."""
    parts = df.rdd.getNumPartitions()
    return df.coalesce(max(1, min(parts, max(4 * df.sparkSession.sparkContext.defaultParallelism, -(-parts // PER_TASK)))))


def _name(path_col: str = "path") -> Column:
    """A file's name without its last ending."""
    return F.regexp_replace(F.regexp_extract(path_col, r"([^/]+)$", 1), r"\.[^.]+$", "")


def _text_name() -> Column:
    """The name of a line's file without its last ending, as it is on disk: Spark gives the path percent-encoded, with a plus sign as it
    stands. Without patterns, since each line asks for it."""
    leaf = F.substring_index("_metadata.file_path", "/", -1)
    ending = F.when(F.contains(leaf, F.lit(".")), F.length(F.substring_index(leaf, ".", -1)) + 1).otherwise(0)
    stem = F.substr(leaf, F.lit(1), F.length(leaf) - ending)
    return F.when(F.contains(stem, F.lit("%")), F.url_decode(F.replace(stem, F.lit("+"), F.lit("%2B")))).otherwise(stem)


def read_robot_log(spark: SparkSession, path: str, once: bool = False) -> tuple[DataFrame, DataFrame]:
    """Titles and streams of disc enumeration logs; the disc is the file's name. With once, what both are made of is stored, so that
    a log is read and parsed once for the two.

    A line meets one pattern, once; its parts are then cut at commas. One row of each title or stream with a column for each of
    the codes: one shuffle, begun where the lines are.
    """
    lines = _dealt(_lines(spark, path).select(_text_name().alias("disc"), "value"))
    of_title = F.startswith("value", F.lit("TINFO:"))
    # The forms of the log's lines.
    t = r'^TINFO:(\d+),(\d+),\d+,"(.*)"\s*$'
    s = r'^SINFO:(\d+),(\d+),(\d+),\d+,"(.*)"\s*$'
    held = lines.where((of_title & F.col("value").rlike(t)) | (F.startswith("value", F.lit("SINFO:")) & F.col("value").rlike(s)))
    cut = held.select("disc", of_title.alias("of_title"), F.split(F.substr("value", F.lit(7)), ",", F.when(of_title, 4).otherwise(5)).alias("p"))
    quoted = F.get("p", F.when(F.col("of_title"), 3).otherwise(4))
    inside = F.substr(quoted, F.lit(2), F.length(quoted) - F.length(F.substring_index(quoted, '"', -1)) - 2)
    code = F.get("p", F.when(F.col("of_title"), 1).otherwise(2)).cast("int")
    rows = cut.select("disc", "of_title", F.get("p", 0).cast("int").alias("title"), F.when(~F.col("of_title"), F.get("p", 1).cast("int")).alias("n"), code.alias("code"), inside.alias("v"))
    value = lambda codes, own: [F.first(F.when(own & (F.col("code") == k), F.col("v")), ignorenulls=True).alias(c) for k, c in codes.items()]
    every = rows.groupBy("disc", "of_title", "title", "n").agg(*value(TITLE_CODES, F.col("of_title")), *value(STREAM_CODES, ~F.col("of_title"))).withColumn("sec", T.hms_to_sec(F.col("duration")))
    every = stored(every, "log") if once else every
    return every.where("of_title").select("disc", "title", *TITLE_CODES.values(), "sec"), every.where("not of_title").select("disc", "title", "n", *STREAM_CODES.values())


def _disc(path_col: str = "path") -> Column:
    """The disc that a file lies on: the folder above the one of its disc format (BDMV, VIDEO_TS), else its own folder."""
    inner = F.regexp_extract(path_col, r"/([^/]+)/(?:BDMV|VIDEO_TS)/", 1)
    return F.when(inner != "", inner).otherwise(F.regexp_extract(path_col, r"([^/]+)/[^/]+$", 1))


def read_playlists(spark: SparkSession, glob: str) -> DataFrame:
    """(disc, playlist, clips): the clip numbers of binary playlists, in order."""
    said = F.decode("content", "ISO-8859-1")
    return _dealt(_files(spark, glob).select(_disc().alias("disc"), _name().alias("playlist"), F.regexp_extract_all(said, F.lit(r"(\d{5})(?=M2TS)"), F.lit(1)).alias("clips")))


def read_clip_languages(spark: SparkSession, glob: str, codes: list[str]) -> DataFrame:
    """S3: (disc, clip, pos, lang): language codes embedded in binary clip files, in order."""
    said = F.decode("content", "ISO-8859-1")
    found = F.regexp_extract_all(said, F.lit("(" + "|".join(codes) + ")"), F.lit(1))
    return _dealt(_files(spark, glob).select(_disc().alias("disc"), _name().alias("clip"), F.posexplode(found).alias("pos", "lang")))


def read_dispositions(spark: SparkSession, path: str) -> DataFrame:
    """(disc, title, kind, note) of tNN|kind|note lines; the last line of a title counts."""
    whole = _dealt(_lines(spark, path, whole=True).select(F.regexp_replace(_text_name(), r"\.dispositions$", "").alias("disc"), F.split("value", r"\r?\n").alias("lines")))
    each = whole.select("disc", F.posexplode("lines").alias("line", "value"))
    p = r"^\s*t(\d+)\s*\|\s*([A-Za-z]+)\s*(?:\|(.*))?$"
    rows = each.where(F.col("value").rlike(p)).select("disc", F.regexp_extract("value", p, 1).cast("int").alias("title"), "line", "value")
    last = rows.groupBy("disc", "title").agg(F.max_by("value", "line").alias("value"))
    return last.select("disc", "title", F.lower(F.regexp_extract("value", p, 2)).alias("kind"), F.trim(F.regexp_extract("value", p, 3)).alias("note"))


def read_pipe_table(spark: SparkSession, path: str) -> DataFrame:
    """A table with named columns between bars; # begins a comment."""
    raw = spark.read.csv(path, sep="|", header=True, comment="#", ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    return raw.toDF(*(c.strip() for c in raw.columns))


# How the dialects write the time line of a cue.
_TIMES = {"strict": r"(\d\d:\d\d:\d\d,\d\d\d) --> (\d\d:\d\d:\d\d,\d\d\d)", "lenient": r"(\d\d:\d\d:\d\d[,.]\d\d\d)\s*-->\s*(\d\d:\d\d:\d\d[,.]\d\d\d)"}


def read_srt(spark: SparkSession, glob: str, dialect: str = "lenient") -> DataFrame:
    """(file_id, cue, start_s, end_s, text) of subtitle files in any encoding of decode_bytes().

    strict and lenient: a block reaches from one time line to the number line before the next. blocks: blocks stand
    between blank lines, their first line is a number (cue), the second the times; others are left out.
    """
    whole = _dealt(_files(spark, glob).select(_name().alias("file_id"), F.regexp_replace(T.decode_bytes(F.col("content")), "\r\n", "\n").alias("value")))
    if dialect == "blocks":
        p = _TIMES["lenient"]
        block = whole.select("file_id", F.explode(F.split("value", r"\n[ \t]*\n\s*")).alias("b")).select("file_id", F.split(F.trim(F.trim("b"), F.lit("\n")), "\n").alias("l"))
        found = block.where(F.get("l", 0).rlike(r"^\s*\d+\s*$") & F.get("l", 1).rlike(p))
        span = lambda k: T.srt_to_sec(F.regexp_extract(F.get("l", 1), p, k))
        return found.select("file_id", F.trim(F.get("l", 0)).cast("int").alias("cue"), span(1).alias("start_s"), span(2).alias("end_s"), F.array_join(F.slice("l", 3, 1 << 30), "\n").alias("text"))
    p = _TIMES[dialect]
    blocks = whole.select("file_id", F.regexp_extract_all("value", F.lit(p), F.lit(0)).alias("times"), F.slice(F.split("value", p, -1), 2, 1 << 30).alias("bodies"))
    rows = blocks.select("file_id", F.posexplode(F.arrays_zip("times", "bodies")).alias("cue", "x"), F.size("times").alias("n"))
    body = F.col("x.bodies")
    body = F.when(F.col("cue") < F.col("n") - 1, F.regexp_replace(body, r"\n[^\n]*\n?$", "")).otherwise(body)
    span = lambda k: T.srt_to_sec(F.regexp_extract("x.times", p, k))
    return rows.select("file_id", "cue", span(1).alias("start_s"), span(2).alias("end_s"), F.trim(F.trim(body), F.lit("\n")).alias("text"))


def read_ocr_results(spark: SparkSession, root: str) -> DataFrame:
    """(file_id, cue, text) of the texts read from each cue's picture; file_id is the folder of cue_N.txt and cue_N_res.json.

    Lines of a JSON result stand by the upper edge of their boxes where there is a box for each; boxes are points, or
    left, top, right, bottom (read where there are no points). JSON beats text for one cue, blank lines and cues without a line are left out.
    """
    folder, cue = F.regexp_extract("path", r"([^/]+)/[^/]+$", 1), lambda p: F.regexp_extract("path", p, 1).try_cast("int")
    # One listing and one scan for both kinds of files.
    said = _tree(spark, root, r"/cue_[^/]*(\.txt|_res\.json)$")
    kind = F.endswith("path", F.lit(".json")).cast("int").alias("kind")
    said = said.select(folder.alias("file_id"), F.coalesce(cue(r"/cue_(\d+)\.txt$"), cue(r"/cue_(\d+)_res\.json$")).alias("cue"), kind, T.decode_bytes(F.col("content")).alias("said"))
    said = stored(said, "readings")  # else Spark decodes a file again for each use of its text below
    said = said.withColumn("json", F.when(F.col("kind") == 1, F.col("said")))
    points = F.from_json("json", "rec_texts array<string>, rec_polys array<array<array<double>>>")
    boxes = F.from_json("json", "rec_boxes array<array<double>>")["rec_boxes"]
    tops = F.coalesce(F.transform(F.when(F.size("p.rec_polys") > 0, F.col("p.rec_polys")), lambda b: F.array_min(F.transform(b, lambda q: F.get(q, 1)))), F.transform("b", lambda b: F.least(F.get(b, 1), F.get(b, 3))))
    said = said.withColumns({"p": points, "b": boxes}).select("file_id", "cue", "kind", "said", F.filter(F.transform("p.rec_texts", lambda x: F.trim(x)), lambda x: x != "").alias("lines"), tops.alias("tops"))
    placed = F.array_sort(F.transform(F.arrays_zip("tops", "lines"), lambda x, i: F.struct(x["tops"].alias("top"), i.alias("i"), x["lines"].alias("line"))))
    ordered = F.when(F.size("tops") == F.size("lines"), F.transform(placed, lambda x: x["line"])).otherwise(F.col("lines"))
    trimmed = F.filter(F.transform(F.split("said", r"\r?\n"), lambda x: F.trim(x)), lambda x: x != "")
    both = said.select("file_id", "cue", "kind", F.when(F.col("kind") == 1, ordered).otherwise(trimmed).alias("lines"))
    best = both.where("cue is not null and size(lines) > 0").groupBy("file_id", "cue").agg(F.max_by("lines", "kind").alias("lines"))
    return best.select("file_id", "cue", F.array_join("lines", "\n").alias("text"))


def _documents(spark: SparkSession, path: str) -> DataFrame:
    """(file, content): whole small control files, below a folder at any depth, in any encoding of decode_bytes()."""
    return _tree(spark, path).select(F.col("path").alias("file"), T.decode_bytes(F.col("content")).alias("content"))


# Attributes and elements of a disc's own XML.
_TITLE_XML = "_Number int, _TVEpisode string, _ContainsEpisode string, _MainMovie string, _Hours int, _Minutes int, _Seconds int, Hours int, Minutes int, Seconds int"
_TRACK_XML = "_Language string, _Type string, _Channels string"


def read_disc_xml(spark: SparkSession, glob: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """What discs say of themselves, of each file the disc it lies on: titles (disc, pos, title, sec, episode, play_all, main_movie)
    of the numbered titles, audio_tracks (disc, pos, language, type, channels) in stream order, extras (disc, pos, name), header
    (disc, file, local_title, imdb, malformed).

    Elements are found wherever they stand in a file and read by Spark's XML parser: lengths as attributes or as elements
    below, entities and CDATA decoded. A title that holds no episode plays all; episode is the number it is marked with.
    A file that is no XML is reported as malformed, with what could be read of it.
    """
    # Stored, as four tables are read from it: each file is opened once.
    text = stored(_dealt(_files(spark, glob).select(_disc().alias("disc"), F.col("path").alias("file"), T.decode_bytes(F.col("content")).alias("x"))), "xml")
    element = lambda name, more="": rf"(?s)<{name}\b{more}(?:[^>]*/>|[^>]*>.*?</{name}>)"
    some = lambda c: F.when(F.trim(c) != "", F.trim(c))
    each = lambda p, kind: text.select("disc", F.posexplode(F.regexp_extract_all("x", F.lit(p), F.lit(0))).alias("pos", "e")).select("disc", "pos", F.from_xml("e", F.lit(kind)).alias("e"))
    part = lambda name: F.coalesce(f"e._{name}", f"e.{name}", F.lit(0))
    timed = F.coalesce(*(F.col(f"e.{p}{n}") for n in ("Hours", "Minutes", "Seconds") for p in ("_", ""))).isNotNull()
    titles = each(element("Title", r"(?=[^>]*\bNumber\s*=)"), _TITLE_XML).select(
        "disc", "pos", F.col("e._Number").alias("title"), F.when(timed, (part("Hours") * 3600 + part("Minutes") * 60 + part("Seconds")).cast("double")).alias("sec"), F.col("e._TVEpisode").try_cast("int").alias("episode"),
        F.coalesce(F.lower("e._ContainsEpisode") == "false", F.lit(False)).alias("play_all"), F.coalesce(F.lower("e._MainMovie") == "true", F.lit(False)).alias("main_movie"),
    )
    tracks = each(element("AudioTrack"), _TRACK_XML).select("disc", "pos", some(F.col("e._Language")).alias("language"), some(F.col("e._Type")).alias("type"), some(F.col("e._Channels")).alias("channels"))
    wrapped = lambda name: F.from_xml(F.concat(F.lit("<w>"), F.regexp_extract("x", element(name), 0), F.lit("</w>")), F.lit(f"{name} string"))[name]
    extras = text.select("disc", F.posexplode(F.filter(F.transform(F.split(wrapped("ExtraFeatures"), r"\r?\n"), lambda x: F.trim(x)), lambda x: x != "")).alias("pos", "name"))
    broken = F.from_xml("x", F.lit("_corrupt_record string"))["_corrupt_record"].isNotNull() | (F.trim("x") == "")
    header = text.select("disc", "file", some(wrapped("LocalTitle")).alias("local_title"), some(wrapped("IMDB")).alias("imdb"), F.coalesce(broken, F.lit(True)).alias("malformed"))
    return titles, tracks, extras, header


# Fields of the control files, as they are written and as the tables have them.
STREAM_FIELDS = {"n": "int", "type": "string", "lang": "string", "codec": "string", "bitrate": "string", "channels": "string", "resolution": "string", "label": "string"}
TITLE_FIELDS = {
    "title": "int", "duration": "string", "sizeText": "string", "source": "string", "outName": "string", "width": "int", "height": "int", "fieldOrder": "string", "frameRate": "string",
    "probeFile": "string", "probeScope": "string", "audioMd5": "string", "frames": "array<string>", "disposition": "string",
}
DISC_FIELDS = {"disc": "string", "discPath": "string", "minLength": "int", "titleCount": "int"}
TRIED = "array<struct<t:string,score:bigint,sim:double,cover:double,cues:bigint,kind:string,why:string>>"
STATE = f"struct<r:string,label:string,tried:{TRIED},kept:string,cover:double,cues:bigint,kind:string,offset:double,scale:double,shift:double>"
MANIFEST_FIELDS = {
    "out": "string", "kind": "string", "src": "string", "crop": "string", "title": "int", "chapterStart": "int", "chapterEnd": "int", "subTrack": "string", "audioTracks": "array<int>", "audioLangs": "array<string>",
    "origLang": "string", "deinterlace": "boolean", "allowRawStream": "boolean",
}


def snake(name: str) -> str:
    """The name of a table's column for a field: sizeText is size_text, audioMd5 audio_md5."""
    return "".join(f"_{c.lower()}" if c.isupper() else c for c in name)


def unreadable(spark: SparkSession, path: str) -> DataFrame:
    """(file, why) of the control files below path that are no JSON: empty, or broken. Spark does not list files of no bytes at all."""
    return _documents(spark, path).where(F.try_parse_json("content").isNull()).select("file", F.when(F.col("content").rlike(r"^\s*$"), "empty").otherwise("no JSON").alias("why"))


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """(rk, r, label, tried, kept, cover, cues, kind, offset, scale, shift): state files, each one JSON object of verdicts by key,
    indented or not. Entries that are no objects are left out; unreadable() names broken files."""
    whole = _documents(spark, path).select(F.explode(F.from_json("content", f"map<string,{STATE}>")).alias("rk", "v"))
    return whole.where("v is not null").select("rk", "v.*")


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a log of JSON lines, of the columns that schema names."""
    return spark.read.schema(schema).json(path)


def read_catalogue(spark: SparkSession, path: str, lines: bool = False) -> tuple[DataFrame, DataFrame]:
    """(titles, streams) of nested catalogues: a file for each disc, indented or not, or (lines) many discs to a file, one a line.

    Columns are those of the files in small letters; titles have sec, their duration in seconds, besides. unreadable() names broken files.
    """
    schema = _ddl(DISC_FIELDS | {"titles": f"array<struct<{_ddl(TITLE_FIELDS | {'streams': f'array<struct<{_ddl(STREAM_FIELDS)}>>'})}>>"})
    discs = spark.read.schema(schema).json(path) if lines else _documents(spark, path).select(F.from_json("content", schema).alias("d")).select("d.*")
    # Titles of no disc go, and discs of no titles, without a filter that Spark would take to the files and parse them for a second time.
    each = discs.select("disc", F.posexplode_outer(F.when(F.col("disc").isNotNull(), F.col("titles"))).alias("pos", "t")).where("pos is not null")
    each = each.select("disc", *(F.col(f"t.{k}").alias(snake(k)) for k in TITLE_FIELDS), "t.streams")
    # Stored, as two tables are read from it: each file is opened and parsed once. A row is a title, not a disc: Spark reads stored rows
    # some thousands at a time, whatever they hold.
    titles = stored(each, "catalogue").withColumn("sec", T.hms_to_sec(F.col("duration")))
    return titles.drop("streams"), titles.select("disc", "title", F.explode("streams").alias("s")).select("disc", "title", *(F.col(f"s.{k}").alias(k) for k in STREAM_FIELDS))


def _ddl(fields: dict[str, str]) -> str:
    return ", ".join(f"{k} {v}" for k, v in fields.items())


def _entries(v: Column, name: str) -> Column:
    """A field that is a number, a list of numbers, or a list of [number, title] pairs, as an array of (idx, title)."""
    many = F.coalesce(F.try_variant_get(v, f"$.{name}", "array<variant>"), F.array(F.try_variant_get(v, f"$.{name}", "variant")))
    entry = lambda e: F.struct(F.coalesce(F.try_variant_get(e, "$[0]", "int"), F.try_variant_get(e, "$", "int")).alias("idx"), F.try_variant_get(e, "$[1]", "string").alias("title"))
    found = F.filter(F.transform(many, entry), lambda x: x["idx"].isNotNull())
    return F.when(F.size(found) > 0, found)


def read_manifest(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Manifest rows with fixed columns; what a row leaves out is null. A file holds a list of items or one item, indented or
    not, or (lines) one item a line. commentary and audioDescription become arrays of (idx, title), subTrack a text.
    unreadable() names broken files."""
    text = spark.read.text(path).select(F.col("value").alias("content")) if lines else _documents(spark, path)
    whole = text.select(F.try_parse_json("content").alias("v")).where("v is not null")
    items = whole.select(F.explode(F.coalesce(F.try_variant_get("v", "$", "array<variant>"), F.array("v"))).alias("v"))
    plain = (F.try_variant_get("v", f"$.{k}", kind).alias(k) for k, kind in MANIFEST_FIELDS.items())
    return items.select(*plain, *(_entries(F.col("v"), k).alias(k) for k in ("commentary", "audioDescription")))


def read_listing(spark: SparkSession, root: str) -> DataFrame:
    """(rel, work, dir, name, ext, bytes, modified) of a folder and all below; contents are not read."""
    files, rel = _tree(spark, root, contents=False).withColumnsRenamed({"length": "bytes", "modificationTime": "modified"}), F.col("rel")
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return files.select(rel.alias("rel"), F.when(F.contains(rel, F.lit("/")), F.substring_index(rel, "/", 1)).alias("work"), F.regexp_replace(rel, r"/?[^/]+$", "").alias("dir"), name.alias("name"), F.lower(F.regexp_extract(name, r"\.([^.]+)$", 1)).alias("ext"), "bytes", "modified")


def read_declared_title_sets(spark: SparkSession, glob: str) -> DataFrame:
    """(disc, declared): the big-endian number at byte 0x3E of disc index files."""
    return _dealt(_files(spark, glob).select(_disc().alias("disc"), F.conv(F.hex(F.substring("content", 63, 2)), 16, 10).cast("int").alias("declared")))


def explode_media_streams(items: DataFrame) -> DataFrame:
    """One row for each stream of all media and parts. items (rk, Media array<struct<Part array<struct<Stream ..>>>>)."""
    media = items.select("rk", F.explode_outer("Media").alias("m"))
    parts = media.select("rk", F.posexplode_outer("m.Part").alias("part", "p"))
    return parts.select("rk", "part", F.posexplode_outer("p.Stream").alias("ordinal", "s")).select("rk", "part", "ordinal", "s.*")
