"""Vector code compression: product codes, whose codebooks are moved by Lloyd rounds that filter entries over kd-trees.

A whole-number vector is cut into equal consecutive parts, each with a codebook of its own. In a round every part goes to
its codebook's nearest entry, then each entry moves to the mean of its parts. Slices of vectors (16,384) build a kd-tree for each
part position, whose nodes hold the bounding box, the sum and the number of their points. Down the tree, entries that are
farther than another one from every place of a node's box are dropped from that node on; a node with one entry left gives
its cached sum and number to that entry, and its points their code, all at once.

Trees are built in the task that reads a slice. A round moves one row of sums for each entry and task, whatever the number of
vectors; the driver holds the codebooks (parts x entries) alone.

Components are floor(scale * x), x as double, and must stay so small that a squared distance fits in a long (else an OverflowError).
Vectors that are null or hold null or non-finite components have no row. The length of a vector is the longest one's, up to a multiple
of the number of parts; missing components count as 0. The first codebooks are the parts of the vectors with the smallest ids
(null ids last, of equal ids by their components); with fewer vectors than entries there are fewer entries, equal entries stay, and
the lower index wins ties. Repeated rows count each. An empty table gives no row; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfwright.llm.vector_tiles import matrix, whole_vectors
from shelfwright.session import arrow_map, stored

#: Vectors whose trees a task has at a time, and points of a leaf.
SLICE, LEAF = 1 << 14, 8


class Tree:
    """A kd-tree over the rows of a matrix, level by level: every node splits at the middle of its widest side."""

    def __init__(self, points: np.ndarray):
        self.order = np.arange(len(points))
        self.levels: list[dict[str, np.ndarray]] = []
        first, size = np.array([0]), np.array([len(points)])
        while len(first):
            own = points[self.order]
            at = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))  # the places of this level's nodes
            starts = np.cumsum(size) - size
            here = own[at]
            low, high = np.minimum.reduceat(here, starts), np.maximum.reduceat(here, starts)
            split = (size > LEAF) & (low < high).any(axis=1)
            self.levels.append({"first": first, "size": size, "low": low, "high": high, "sum": np.add.reduceat(here, starts), "child": np.where(split, 2 * (np.cumsum(split) - 1), -1)})
            axis = np.argmax(high - low, axis=1)
            node = np.repeat(np.arange(len(first)), size)
            moved = split[node]
            at, node = at[moved], node[moved]
            value = own[at, axis[node]]
            self.order[at] = self.order[at[np.lexsort((value, node))]]
            left = size[split] // 2
            first = np.stack((first[split], first[split] + left), axis=1).ravel()
            size = np.stack((left, size[split] - left), axis=1).ravel()


def _squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    return ((points - entries) ** 2).sum(axis=1)


def _firsts(n: np.ndarray) -> np.ndarray:
    return np.cumsum(n) - n


def _places(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0] .. first[0]+size[0]-1, first[1] .., one after the other."""
    return np.repeat(first - _firsts(size), size) + np.arange(int(size.sum()))


def _least(value: np.ndarray, entry: np.ndarray, starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """In each run the place of the least value, of equal ones that of the lowest entry. Entries rise within a run."""
    best = np.repeat(np.minimum.reduceat(value, starts), n)
    hit = np.flatnonzero(value == best)
    return hit[np.searchsorted(hit, starts)]


def filtered(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(code of each point, sums and numbers of points by entry, number of points compared one by one): the nearest entry, ties to the lower index."""
    tree, k = Tree(points), len(entries)
    code = np.zeros(len(points), np.int64)
    sums, numbers, compared = np.zeros_like(entries), np.zeros(k, np.int64), 0
    # The entries that are left for each node, node by node, in rising order.
    node, left, n = np.array([0]), np.arange(k), np.array([k])
    for level in tree.levels:
        starts, low, high = _firsts(n), level["low"][node], level["high"][node]
        of = np.repeat(np.arange(len(node)), n)
        middle = (low + high)[of]
        star = left[_least(_squared(middle, 2 * entries[left]), left, starts, n)]
        # The corner of the box that lies farthest towards an entry from the middle's own: if even there the middle's is nearer, no point of the box goes to the entry.
        corner = np.where(entries[left] > entries[star][of], high[of], low[of])
        more = _squared(corner, entries[left]) - _squared(corner, entries[star][of])
        stays = (more < 0) | ((more == 0) & (left <= star[of]))
        left, n = left[stays], np.add.reduceat(stays.astype(np.int64), starts)
        starts = _firsts(n)
        # Whole subtrees with one entry left.
        one = n == 1
        whole, entry = node[one], left[starts[one]]
        np.add.at(sums, entry, level["sum"][whole])
        np.add.at(numbers, entry, level["size"][whole])
        code[tree.order[_places(level["first"][whole], level["size"][whole])]] = np.repeat(entry, level["size"][whole])
        # Leaves: their points meet the entries that are left.
        leaf = ~one & (level["child"][node] < 0)
        if leaf.any():
            size, per = level["size"][node[leaf]], n[leaf]
            own = tree.order[_places(level["first"][node[leaf]], size)]
            many = np.repeat(per, size)
            at = left[_places(np.repeat(starts[leaf], size), many)]
            value = _squared(points[np.repeat(own, many)], entries[at])
            found = at[_least(value, at, _firsts(many), many)]
            code[own] = found
            np.add.at(sums, found, points[own])
            numbers += np.bincount(found, minlength=k)
            compared += len(own)
        # Others hand their entries to both children.
        inner = np.flatnonzero(~one & ~leaf)
        per = np.repeat(n[inner], 2)
        left = left[_places(np.repeat(starts[inner], 2), per)]
        node, n = (level["child"][node[inner]][:, None] + np.array([0, 1])).ravel(), per
        if not len(node):
            break
    return code, sums, numbers, compared


def _slices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of SLICE rows with their vectors."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        while n >= SLICE:
            table = pa.Table.from_batches(held)
            yield table.slice(0, SLICE), matrix(table["v"].slice(0, SLICE), width)
            held, n = table.slice(SLICE).to_batches(), n - SLICE
    if n:
        table = pa.Table.from_batches(held)
        yield table, matrix(table["v"], width)


class Codes:
    """Codebooks of every part: an array (parts, entries, components)."""

    def __init__(self, books: np.ndarray):
        self.books = books

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.books.ravel().tolist())).encode()).hexdigest()

    def moved(self, vectors: DataFrame) -> Codes:
        """The codebooks after one round: each entry at the floor of its parts' mean; unused entries stay."""
        books = self.books
        parts, entries, size = books.shape

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, numbers = np.zeros_like(books), np.zeros((parts, entries), np.int64)
            for _, vectors in _slices(batches, parts * size):
                for p in range(parts):
                    _, s, n, _ = filtered(vectors[:, p * size : (p + 1) * size], books[p])
                    sums[p] += s
                    numbers[p] += n
            used = np.flatnonzero(numbers.ravel())
            if len(used):
                yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(numbers.ravel()[used]), pa.array(sums.reshape(-1, size)[used].tolist(), pa.list_(pa.int64()))], ["at", "n", "s"])

        found = arrow_map(vectors.select("v"), run, "at long, n long, s array<long>")
        found = found.groupBy("at").agg(F.sum("n").alias("n"), *(F.sum(F.get("s", F.lit(d))).alias(f"s{d}") for d in range(size)))
        new = books.reshape(-1, size).copy()
        for row in found.collect():  # at most one row for each entry of each part
            new[row["at"]] = [row[f"s{d}"] // row["n"] for d in range(size)]
        return Codes(new.reshape(books.shape))

    def encoded(self, vectors: DataFrame, *others: str) -> DataFrame:
        """(row, id, code, error, others..): the index of each part's entry, and the squared distances summed over the parts."""
        books = self.books
        parts, _, size = books.shape

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for table, vectors in _slices(batches, parts * size):
                code = np.stack([filtered(vectors[:, p * size : (p + 1) * size], books[p])[0] for p in range(parts)], axis=1)
                error = ((vectors.reshape(-1, parts, size) - books[np.arange(parts), code]) ** 2).sum(axis=(1, 2))
                listed = pa.ListArray.from_arrays(pa.array(np.arange(0, code.size + 1, parts, dtype=np.int32)), pa.array(code.ravel(), pa.int32()))
                own = [table[c].combine_chunks() for c in ("row", "id")] + [listed, pa.array(error, pa.int64())] + [table[c].combine_chunks() for c in others]
                yield pa.RecordBatch.from_arrays(own, ["row", "id", "code", "error", *others])

        kinds = "".join(f", {c} {vectors.schema[c].dataType.simpleString()}" for c in others)
        return arrow_map(vectors.select("row", "id", "v", *others), run, f"row long, id long, code array<int>, error long{kinds}")


def fitted(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2) -> Codes | None:
    """Codebooks of whole_vectors() rows, or None where there are none."""
    width, largest = vectors.agg(F.max(F.size("v")), F.max(F.greatest(F.abs(F.array_max("v")), F.abs(F.array_min("v"))))).first()
    if width is None:
        return None
    size = max(1, -(-width // parts))
    if size * parts * (2.0 * (2 * (largest or 0) + 1)) ** 2 >= 2.0**63:
        raise OverflowError("squared distances of these vectors may not fit in a long")
    start = vectors.select("id", "v").orderBy(F.asc_nulls_last("id"), "v").limit(entries).collect()
    first = np.zeros((len(start), parts * size), np.int64)
    for k, row in enumerate(start):
        first[k, : len(row["v"])] = row["v"]
    codes = Codes(np.ascontiguousarray(first.reshape(len(start), parts, size).transpose(1, 0, 2)))
    for _ in range(rounds):
        codes = codes.moved(vectors)
    return codes


def query(spark, sf_dir: str) -> DataFrame:
    """op12: every vector as 16 indexes of 64 entries, its error, its label's error, and the codebooks' digest."""
    vectors = stored(whole_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding", 256, "label"), "vectors")
    codes = fitted(vectors)
    if codes is None:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    found = stored(codes.encoded(vectors, "label"), "codes")
    sums = found.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    hexed = F.array_join(F.transform("code", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    met = found.join(sums, F.col("label").eqNullSafe(F.col("of")))
    return met.select(F.col("id").alias("vec_id"), hexed.alias("code"), "error", "label_error", F.lit(codes.sha256()).alias("codebooks_sha256"))


def _oracle(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """The same rounds by all distances; part vectors as lists."""
    sql = f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), cut AS MATERIALIZED (
  SELECT vec_id, label, part, v[part * (len(v) // {parts}) + 1 : (part + 1) * (len(v) // {parts})] AS x FROM v, range({parts}) AS r(part)
), book0 AS MATERIALIZED (
  SELECT part, entry, x AS e FROM (SELECT part, x, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry FROM cut) WHERE entry < {entries}
)"""
    for k in range(rounds + 1):
        sql += f""", near{k} AS MATERIALIZED (
  SELECT vec_id, label, part, any_value(x) AS x, min(d * {entries} + entry) AS best FROM (
    SELECT vec_id, label, c.part, x, entry, CAST(list_sum(list_transform(list_zip(x, e), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d
    FROM cut c JOIN book{k} b ON b.part = c.part) GROUP BY vec_id, label, part
)"""
        if k < rounds:
            sql += f""", mean{k} AS (
  SELECT part, entry, list(m ORDER BY pos) AS e FROM (
    SELECT part, best % {entries} AS entry, pos, CAST(floor(sum(x[pos]) / count(*)) AS BIGINT) AS m FROM near{k}, (SELECT unnest(range(1, 1025)) AS pos) WHERE pos <= len(x) GROUP BY 1, 2, 3) GROUP BY part, entry
), book{k + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.e, b.e) AS e FROM book{k} b LEFT JOIN mean{k} m ON m.part = b.part AND m.entry = b.entry)"""
    return f"""{sql}, coded AS (
  SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', CAST(best % {entries} AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(best // {entries}) AS BIGINT) AS error FROM near{rounds} GROUP BY vec_id
), mark AS (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded, mark
"""


ORACLE_SQL = _oracle()
