"""Exact top-k search by inner product: tiled matrix products of queries and parts of the rows, and a tree merge of lists.

Queries are cut into blocks and rows into parts by hashes; each pair of a block and a part is a tile of its own task. A tile holds its
block's matrix and streams its part's rows in Arrow batches: every batch is one matrix product, of which only what can
still enter a query's list is kept. Lists of (query, part) are then merged in groups of 16 until one list a query is left.

What moves is rows x blocks and queries x parts; a task holds one block (16,384 queries), one slice of scores and the
block's lists, whatever the sizes of the tables.

A vector component x becomes floor(scale * x), x as double. Vectors that are null or hold null or non-finite components
take no part, neither as query nor as row; missing components at the end of shorter vectors count as 0, so an empty vector
scores 0. Products are exact: by float matrices only where the lengths of the vectors prove that every partial sum is a whole
number that a float holds, else by 64-bit integers, else an OverflowError says that a score may not fit in a long. Ties go to the
smaller id, null ids last, then to the row stored first. Rows that repeat are rows like others: only a query's own row is left out,
and a query that repeats gets its list once for each of its rows. An empty table gives no row; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shelfwright.session import arrow_map, stored

#: Queries of a block, rows of a part while there are few, tiles that are enough for any cluster, lists that are merged at a time.
BLOCK, PART, TILES, FAN_IN = 1 << 14, 1 << 13, 1 << 12, 16
#: Scores that a tile has at a time.
SCORES = 1 << 21
LAST = np.iinfo(np.int64).max


def whole_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int, *others: str) -> DataFrame:
    """(row, id, v array<long>, others..) of the vectors that take part; row tells stored rows apart."""
    x = F.col(vector_col).cast("array<double>")
    finite = F.forall(x, lambda c: F.coalesce((F.abs(c) < float("inf")) & ~F.isnan(c), F.lit(False)))
    kept = df.where(F.col(vector_col).isNotNull() & finite)
    # a floor that a long does not hold would be cut to the largest long; here it raises an error
    whole = F.transform(x, lambda c: F.when(F.abs(c) * scale < float(1 << 62), F.floor(c * scale)).otherwise(F.raise_error(F.lit(f"a vector component times {scale} does not fit in a long")).cast("long")))
    return kept.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), whole.alias("v"), *(F.col(c) for c in others))


def matrix(column: pa.Array, width: int | None = None) -> np.ndarray:
    """A list column as rows of equal length, with zeros behind shorter lists."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    edges = column.offsets.to_numpy()
    flat = column.values.to_numpy()[edges[0] : edges[-1]]
    size = np.diff(edges)
    width = int(size.max(initial=0)) if width is None else width
    if (size == width).all():
        return flat.reshape(len(size), width)
    out = np.zeros((len(size), max(width, int(size.max(initial=0)))), np.int64)
    out[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def exact_kind(*sides: np.ndarray) -> type:
    """The number type in which products of two matrices' rows are exact. By Cauchy and Schwarz no partial sum exceeds the product of the lengths."""
    most = float(np.prod([np.sqrt((m.astype(np.float64) ** 2).sum(axis=1).max(initial=0.0)) for m in sides])) * 1.0001
    largest = max(float(np.abs(m.astype(np.float64)).max(initial=0.0)) for m in sides)
    for kind, bits in ((np.float32, 24), (np.float64, 53), (np.int64, 63)):
        if max(most, largest) < 2.0**bits:
            return kind
    raise OverflowError("inner products of these vectors may not fit in a long")


class Lists:
    """The best k of each query of a block so far, of rows that come in order of id (nulls last) and row."""

    def __init__(self, k: int, row: np.ndarray, vectors: np.ndarray):
        self.k, self.row, self.vectors, self.cast = k, row, vectors, {}
        self.query, self.score, self.id, self.none, self.of = (np.zeros(0, t) for t in (np.int64, np.int64, np.int64, bool, np.int64))
        #: The k-th score of a query's list; a later row must exceed it, as ties go to earlier ones.
        self.least = np.full(len(row), np.iinfo(np.int64).min)

    def meet(self, rows: np.ndarray, ids: np.ndarray, none: np.ndarray, vectors: np.ndarray) -> None:
        """A tile: the scores of a slice of rows; of each query at most k of them join its list."""
        width = max(self.vectors.shape[1], vectors.shape[1])
        if self.vectors.shape[1] < width:
            self.vectors, self.cast = np.pad(self.vectors, ((0, 0), (0, width - self.vectors.shape[1]))), {}
        if vectors.shape[1] < width:
            vectors = np.pad(vectors, ((0, 0), (0, width - vectors.shape[1])))
        kind = exact_kind(self.vectors, vectors)
        if kind not in self.cast:
            self.cast = {kind: self.vectors.astype(kind)}
        across = vectors.astype(kind).T
        step, keep = max(1, SCORES // len(rows)), min(self.k + 1, len(rows))  # one more, as a query's own row may be among them
        for lo in range(0, len(self.row), step):
            score = self.cast[kind][lo : lo + step] @ across
            least = np.partition(score, len(rows) - keep, axis=1)[:, len(rows) - keep][:, None]
            fits = (score >= least) & (score > self.least[lo : lo + step].astype(kind)[:, None])
            if np.count_nonzero(fits) > 4 * keep * len(score):  # of many ties the first count
                equal = score == least
                fits &= ~equal | (np.cumsum(equal, axis=1, dtype=np.int32) <= keep)
            q, c = np.nonzero(fits)
            other = self.row[lo + q] != rows[c]
            q, c = q[other], c[other]
            self._join(lo + q, score[q, c].astype(np.int64), ids[c], none[c], rows[c])

    def _join(self, query: np.ndarray, *new: np.ndarray) -> None:
        if not len(query):
            return
        touched = np.zeros(len(self.row), bool)
        touched[query] = True
        old = touched[self.query]
        have = (self.query, self.score, self.id, self.none, self.of)
        parts = [np.concatenate((x[old], y)) for x, y in zip(have, (query, *new), strict=True)]
        order = np.lexsort((parts[4], parts[2], parts[3], -parts[1], parts[0]))
        q = parts[0][order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        best, full = order[place < self.k], order[place == self.k - 1]
        self.least[parts[0][full]] = parts[1][full]
        self.query, self.score, self.id, self.none, self.of = (np.concatenate((x[~old], y[best])) for x, y in zip(have, parts, strict=True))


def _tiles(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (tile, queries first, id, row): for each tile its queries' lists."""
    tile, own, lists = None, [], None

    def out() -> Iterator[pa.RecordBatch]:
        if lists is not None and len(lists.query):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(lists.query), tile, np.int32)), pa.array(lists.row[lists.query]), pa.array(lists.score), pa.array(lists.id, mask=lists.none), pa.array(lists.of)], ["tile", "query", "score", "id", "row"]
            )

    for batch in batches:
        tiles = batch.column(0).to_numpy()
        for lo, hi in zip(cuts := [0, *(np.flatnonzero(np.diff(tiles)) + 1).tolist()], [*cuts[1:], len(tiles)], strict=True):
            if hi == lo:
                continue
            if tiles[lo] != tile:
                yield from out()
                tile, own, lists = int(tiles[lo]), [], None
            piece = batch.slice(lo, hi - lo)
            asked = piece.column(1).to_numpy(zero_copy_only=False)
            queries, rows = piece.filter(pa.array(asked)), piece.filter(pa.array(~asked))
            if queries.num_rows:
                own.append(queries)
            if rows.num_rows and own:
                if lists is None:
                    block = pa.Table.from_batches(own)
                    lists = Lists(k, block["row"].to_numpy(), matrix(block["v"]))
                ids = rows.column(rows.schema.get_field_index("id"))
                none = ids.is_null().to_numpy(zero_copy_only=False)
                lists.meet(rows.column(rows.schema.get_field_index("row")).to_numpy(), ids.fill_null(LAST).to_numpy(), none, matrix(rows.column(rows.schema.get_field_index("v"))))
    yield from out()


def merged(lists: DataFrame, k: int, parts: int) -> DataFrame:
    """(query, best): lists of (query, part, best array) merged in groups of FAN_IN parts until each query has one."""
    while parts > 1:
        parts = -(-parts // FAN_IN)
        lists = lists.groupBy("query", F.floor(F.col("part") / FAN_IN).alias("part")).agg(F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, k).alias("best"))
    return lists.select("query", "best")


def exact_top_k(rows: DataFrame, asked: Column, k: int) -> DataFrame:
    """(query_row, query_id, rank, id, row, score) of whole_vectors() rows: for each row that meets the condition `asked` the k
    best other rows (all, if fewer), rank from 1."""
    rows = stored(rows.withColumn("asked", F.coalesce(asked, F.lit(False))), "vectors")
    n, n_queries = rows.agg(F.count("*"), F.count_if("asked")).first()
    blocks = max(1, -(-n_queries // BLOCK))
    parts = max(1, min(-(-n // PART), -(-TILES // blocks)))
    block, part = F.pmod(F.xxhash64("row"), F.lit(blocks)), F.pmod(F.xxhash64("row", F.lit(1)), F.lit(parts))
    ids = lambda m: F.sequence(F.lit(0), F.lit(m - 1))
    queries = rows.where("asked").select(F.explode(ids(parts)).alias("other"), F.lit(True).alias("query"), "row", "id", "v").withColumn("tile", block * parts + F.col("other"))
    others = rows.select(F.explode(ids(blocks)).alias("other"), F.lit(False).alias("query"), "row", "id", "v").withColumn("tile", F.col("other") * parts + part)
    dealt = queries.unionByName(others).select(F.col("tile").cast("int").alias("tile"), "query", "row", "id", "v").repartitionById(blocks * parts, "tile")
    dealt = dealt.sortWithinPartitions("tile", F.desc("query"), F.asc_nulls_last("id"), "row")
    found = arrow_map(dealt, lambda batches: _tiles(batches, k), "tile int, query long, score long, id long, row long")
    # Sorted as structs: the largest score first, null ids last, then by id and row.
    entry = F.struct((-F.col("score")).alias("less"), F.col("id").isNull().alias("none"), "id", "row")
    lists = found.groupBy("query", (F.col("tile") % parts).alias("part")).agg(F.array_sort(F.collect_list(entry)).alias("best"))
    best = merged(lists, k, parts).select("query", F.posexplode("best").alias("rank", "x"))
    named = rows.where("asked").select(F.col("row").alias("query"), F.col("id").alias("query_id"))
    out = best.join(named, "query")
    return out.select(F.col("query").alias("query_row"), "query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("x.id").alias("id"), F.col("x.row").alias("row"), (-F.col("x.less")).alias("score"))


def query(spark, sf_dir: str) -> DataFrame:
    """op11: the ten best vectors for every vector whose id is divisible by 100."""
    rows = whole_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding", 1024)
    return exact_top_k(rows, F.col("id") % 100 == 0, 10).select("query_id", "rank", F.col("id").alias("vec_id"), "score")


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0
), ranked AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
