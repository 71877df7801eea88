"""Session helpers: where intermediate tables go, and how they are cut off from their lineage."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir as the cluster names it.

    A temporary folder stands in only on a local master, where one machine is the cluster.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    base = tempfile.mkdtemp(prefix="shelfwright-")
    spark.conf.set("spark.checkpoint.dir", base)
    return base


#: The paths made inside the innermost tracked() block of this thread.
_made: ContextVar[list[str] | None] = ContextVar("_made", default=None)


def new_path(spark: SparkSession, tag: str) -> str:
    """A path in the shared folder that nothing has used; tracked() tells of it."""
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    made = _made.get()
    if made is not None:
        made.append(path)
    return path


def stored(df: DataFrame, tag: str) -> DataFrame:
    """df written once to the shared folder and read back: short lineage, and no loss with an executor."""
    path = new_path(df.sparkSession, tag)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def tracked() -> Iterator[list[str]]:
    """The list of paths that are made inside the block by this thread, without those of blocks inside it."""
    made: list[str] = []
    outer = _made.set(made)
    try:
        yield made
    finally:
        _made.reset(outer)


def settled(spark: SparkSession, make: Callable[[], DataFrame], tag: str) -> DataFrame:
    """make()'s rows written to the shared folder and read back; the intermediate tables that it made are removed."""
    path = new_path(spark, tag)
    with tracked() as made:
        df = make()
        df.write.option("compression", "zstd").parquet(path)
    drop(spark, made)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What a write inside the block shuffles is removed when the write is done, not when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


#: Rows of a slice of in_slices().
PER_SLICE = 1 << 24


def in_slices(rows: DataFrame, key: str, make: Callable[[DataFrame], tuple[DataFrame, ...]], tag: str, per_slice: int = PER_SLICE) -> tuple[DataFrame, ...]:
    """make()'s tables of all of rows: of one slice of keys after another where there are many. A slice has all rows of its keys. What
    make() writes and shuffles in between takes disk for one slice at a time."""
    spark = rows.sparkSession
    with shuffles_dropped(spark):
        rows = stored(rows, tag)
        n = -(-rows.count() // per_slice)
        if n <= 1:
            return make(rows)
        kept: list[list[str]] = []
        for k in range(n):
            with tracked() as made:
                out = make(rows.where(F.pmod(F.xxhash64(key), F.lit(n)) == k))
                schemas, here = [df.schema for df in out], len(made)
                for df in out:
                    df.write.option("compression", "zstd").parquet(new_path(spark, tag))
            drop(spark, made[:here])
            kept.append(made[here:])
        if (outer := _made.get()) is not None:
            outer.extend(p for paths in kept for p in paths)
        return tuple(spark.read.schema(schema).parquet(*paths) for schema, paths in zip(schemas, zip(*kept, strict=True), strict=True))


def drop(spark: SparkSession, paths: list[str]) -> None:
    """Removes folders of the shared file system; what is not there is no error."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def modified(spark: SparkSession, path: str) -> int | None:
    """When a file or folder of the shared file system was last changed, in ms; None if it is not there."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getFileStatus(at).getModificationTime() if fs.exists(at) else None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """This package sent to the executors, once per application, so that their Python workers can import it."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = Path(__file__).resolve().parent
    if top.is_dir():
        path = Path(tempfile.mkdtemp(prefix="shelfwright-")) / "shelfwright_py.zip"
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as packed:
            for f in sorted(top.rglob("*.py")):
                packed.write(f, f.relative_to(top.parent))
        spark.sparkContext.addPyFile(str(path))
    _shipped.add(app)


def arrow_map(df: DataFrame, run, schema: str) -> DataFrame:
    """df.mapInArrow with this package at hand on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)
