"""The corpus pipeline: five stages over `documents`, each written as Parquet and read again as the next one's docs.

Of every stage: null and empty texts have no words and are rejected by the first stage (given alone, a later stage keeps
them); texts are taken whole, however long; rows that repeat are rows like others, but for near-duplicates, where one row
of each id stays; a null id is an id of no other row; an empty table gives an empty table; further columns of any name
stay as they are.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwright.llm import mixing, near_dups, piece_bpe, quality_rules, secret_scan
from shelfwright.session import drop, modified, new_path, stored, tracked

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


class Scratch:
    """Tables that stages have made on the way to their results. Who writes the results closes it."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def close(self) -> None:
        drop(self.spark, self.paths)
        self.paths.clear()

    def close_older(self, docs: DataFrame) -> None:
        """Closes it if docs are files written after all its tables: they are what was made of them, so these are not needed."""
        files = docs.inputFiles() if self.paths else []
        if files:
            written, made = modified(self.spark, files[0]), [modified(self.spark, p) for p in self.paths]
            if written is not None and all(m is None or m < written for m in made):
                self.close()


#: For stages that are given no scratch: one for each thread.
_own = threading.local()


def _stage(make: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[..., DataFrame]:
    """A stage (spark, docs, sf_dir, scratch). Its tables lie in scratch, which the caller closes once the result is written.

    Without one they stay until this thread gives a stage documents that were written after them. So any number of stages
    may be built before one of them is written; a result is good until a later stage reads what was written of it.
    """

    @wraps(make)
    def call(spark: SparkSession, docs: DataFrame, sf_dir: str, scratch: Scratch | None = None) -> DataFrame:
        if scratch is None:
            scratch = _own.__dict__.setdefault(spark.sparkContext.applicationId, Scratch(spark))
            scratch.close_older(docs)
        with tracked() as made:
            out = make(spark, docs, sf_dir)
        scratch.paths.extend(made)
        return out

    return call


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, repeated rows alike. Verdicts lie beside their texts, so no text moves."""
    return quality_rules.kept_documents(docs)


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near-duplicates, and one row of it where its id repeats (the first
    as stored). Rows without an id, and texts without a word, are in no group: all stay."""
    rows = stored(docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*docs.columns).alias("doc")), "rows")
    ids = rows.select("row", F.col("doc.doc_id").alias("id"))
    found = near_dups.near_duplicates(rows.select("doc.doc_id", "doc.text"))
    firsts = found.where("id = component_id").select("id").distinct()
    one = ids.join(firsts, "id").groupBy("id").agg(F.min("row").alias("row")).select("row")
    return rows.join(one.unionByName(ids.where("id is null").select("row")), "row", "left_semi").select("doc.*")


@_stage
def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with credentials masked and n_chars counted anew where that is; copied examples stay."""
    return secret_scan.redacted(docs)


@_stage
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of op4's mixture, those of scarce sources again as often as its target asks."""
    return mixing.mixed_documents(docs, cover=True)


@_stage
def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, n_tokens, ids) of all documents; a null text has no ids."""
    rows = docs.select(F.struct("doc_id", "source").alias("key"), "text")
    ids = piece_bpe.encode(rows, piece_bpe.model_file(), id_col="key")
    return ids.select("id.doc_id", "id.source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [("quality rules", quality), ("near-duplicates", near_duplicates), ("secret scans", secrets), ("mixing sources", mixture), ("piece encoding", encoding)]
#: SQL can't express the sketches' hashes, the seeded permutations or the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. All that was written on the way is removed as soon as it can be."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    scratch, last = Scratch(spark), []
    try:
        for k, (_, stage) in enumerate(STAGES):
            path = new_path(spark, f"pipeline-{k}")
            stage(spark, docs, sf_dir, scratch).write.parquet(path)
            scratch.close()
            docs = spark.read.parquet(path)
            drop(spark, last)
            last = [path]
    finally:
        scratch.close()
    return docs
