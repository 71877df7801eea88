"""op11 and op12 against plain Python."""

import collections
import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwright.llm import vector_codes, vector_tiles

SCHEMA = "vec_id long, embedding array<double>, label int, row string, tile int, code string"


def odd_vectors(n=400, dims=16, seed=5):
    """Rows with ties, repeats, nulls and broken vectors; a third of them one vector."""
    draw = random.Random(seed)
    same = [draw.uniform(-1, 1) for _ in range(dims)]
    rows = [(k, same if k % 3 == 0 else [draw.choice((-0.5, 0.25, draw.uniform(-1, 1))) for _ in range(dims)], k % 5 if k % 7 else None, "r", 1, "c") for k in range(n)]
    rows += [rows[100], rows[100], rows[7], (None, same, None, "r", 1, "c"), (None, same, 1, "r", 1, "c")]
    broken = [None, [None] * dims, [math.nan] + same[1:], [math.inf] + same[1:], [1.0, None]]
    return rows + [(100 * k, v, 0, "r", 1, "c") for k, v in enumerate(broken)]


def kept(rows, scale):
    return [(i, [math.floor(scale * x) for x in v], label) for i, v, label, *_ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]


def plain_top(rows, k, scale):
    vectors = kept(rows, scale)
    out = []
    for a, (q, v, _) in enumerate(vectors):
        if q is not None and q % 100 == 0:
            found = sorted((-sum(x * y for x, y in zip(v, w, strict=False)), i is None, i or 0) for b, (i, w, _) in enumerate(vectors) if b != a)[:k]
            out += [(q, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(found)]
    return collections.Counter(out)


def found_top(df, k, scale=1024):
    rows = vector_tiles.whole_vectors(df, "vec_id", "embedding", scale)
    return collections.Counter(tuple(r) for r in vector_tiles.exact_top_k(rows, F.col("id") % 100 == 0, k).select("query_id", "rank", "id", "score").collect())


@pytest.mark.parametrize("sizes", [(1 << 14, 1 << 13, 1 << 21), (2, 40, 64)])
def test_top_k_equals_plain_python(spark, monkeypatch, sizes):
    for name, value in zip(("BLOCK", "PART", "SCORES"), sizes, strict=True):
        monkeypatch.setattr(vector_tiles, name, value)
    rows = odd_vectors() + [(500, [0.5, 0.5], None, "r", 1, "c"), (600, [], None, "r", 1, "c")]  # shorter and empty vectors
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert found_top(df, 10) == plain_top(rows, 10, 1024)
    few = [r for r in rows if r[0] in (100, 200, 7)]
    assert found_top(spark.createDataFrame(few, SCHEMA), 10) == plain_top(few, 10, 1024)
    assert not found_top(df.limit(0), 10) and not found_top(df.where("vec_id = 1"), 10)


def test_large_components_stay_exact_or_raise(spark):
    draw = random.Random(2)
    for size in (3e3, 2e7, 1e9):
        rows = [(k, [draw.uniform(-size, size) / 1024 for _ in range(8)], 0, "r", 1, "c") for k in range(0, 300)]
        assert found_top(spark.createDataFrame(rows, SCHEMA), 5) == plain_top(rows, 5, 1024)
    with pytest.raises(Exception, match="fit in a long"):
        found_top(spark.createDataFrame([(0, [1e10] * 8, 0, "r", 1, "c"), (1, [1e10] * 8, 0, "r", 1, "c")], SCHEMA), 5)
    with pytest.raises(Exception, match="does not fit in a long"):
        found_top(spark.createDataFrame([(0, [1e30], 0, "r", 1, "c")], SCHEMA), 5)


def test_merging_lists_in_levels(spark):
    draw = random.Random(4)
    rows = [(q, p, sorted((draw.randrange(50), draw.randrange(9)) for _ in range(4))) for q in range(5) for p in range(300)]
    lists = spark.createDataFrame(rows, "query long, part long, best array<struct<less:long,id:long>>")
    got = {r.query: [tuple(x) for x in r.best] for r in vector_tiles.merged(lists, 6, 300).collect()}
    assert got == {q: sorted(x for k, _, xs in rows if k == q for x in xs)[:6] for q in range(5)}


def plain_codes(rows, parts, entries, rounds, scale=256):
    """(codes and errors by row, codebooks) by all distances."""
    vectors = kept(rows, scale)
    width = max(len(v) for _, v, _ in vectors)
    size = max(1, -(-width // parts))
    cut = [[(v + [0] * (size * parts - len(v)))[p * size : (p + 1) * size] for p in range(parts)] for _, v, _ in vectors]
    first = sorted(range(len(vectors)), key=lambda k: (vectors[k][0] is None, vectors[k][0] or 0, vectors[k][1]))[:entries]
    books = [[cut[k][p] for k in first] for p in range(parts)]

    def assign():
        far = lambda x, e: sum((a - b) ** 2 for a, b in zip(x, e, strict=True))
        return [[min((far(x[p], e), j) for j, e in enumerate(books[p])) for p in range(parts)] for x in cut]

    for _ in range(rounds):
        near = assign()
        for p in range(parts):
            for j in range(len(books[p])):
                own = [x[p] for x, c in zip(cut, near, strict=True) if c[p][1] == j]
                if own:
                    books[p][j] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    return collections.Counter((i, tuple(j for _, j in c), sum(d for d, _ in c)) for (i, _, _), c in zip(vectors, assign(), strict=True)), books


@pytest.mark.parametrize(("slice_rows", "leaf"), [(1 << 14, 8), (37, 1), (64, 3)])
def test_codes_equal_plain_python(spark, monkeypatch, slice_rows, leaf):
    monkeypatch.setattr(vector_codes, "SLICE", slice_rows)
    monkeypatch.setattr(vector_codes, "LEAF", leaf)
    rows = odd_vectors(300) + [(900, [0.5, 0.5], None, "r", 1, "c"), (901, [], None, "r", 1, "c")]
    vectors = vector_tiles.whole_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3), "vec_id", "embedding", 256, "label")
    codes = vector_codes.fitted(vectors, parts=4, entries=16)
    want, books = plain_codes(rows, 4, 16, 2)
    assert codes.books.tolist() == books
    assert collections.Counter((r.id, tuple(r.code), r.error) for r in codes.encoded(vectors, "label").collect()) == want
    assert codes.sha256() == hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def test_few_vectors_and_none(spark):
    rows = [(3, [1.0, 2.0, 3.0], None, "r", 1, "c"), (1, [1.0, 2.0, 3.0], 2, "r", 1, "c"), (1, [0.0, -2.0, 3.0], 2, "r", 1, "c")]
    vectors = vector_tiles.whole_vectors(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding", 256)
    codes = vector_codes.fitted(vectors, parts=16)
    want, books = plain_codes(rows, 16, 64, 2)
    assert codes.books.tolist() == books and collections.Counter((r.id, tuple(r.code), r.error) for r in codes.encoded(vectors).collect()) == want
    assert vector_codes.fitted(vectors.limit(0)) is None
    with pytest.raises(OverflowError):
        vector_codes.fitted(vectors.select("row", "id", F.array(F.lit(1 << 40)).alias("v")))


def test_query_of_an_empty_table_and_null_labels(spark, tmp_path):
    rows = odd_vectors(200, 32)
    for name, some in (("full", rows), ("none", [])):
        spark.createDataFrame(some, SCHEMA).write.parquet(str(tmp_path / name / "embeddings.parquet"))
    assert vector_codes.query(spark, str(tmp_path / "none")).count() == vector_tiles.query(spark, str(tmp_path / "none")).count() == 0
    got = vector_codes.query(spark, str(tmp_path / "full")).collect()
    want, _ = plain_codes(rows, 16, 64, 2)
    assert collections.Counter((r.vec_id, tuple(bytes.fromhex(r.code)), r.error) for r in got) == want
    assert len({r.label_error for r in got}) <= 6 and sum({r.label_error for r in got}) == sum(r.error for r in got)


def test_filtering_meets_few_points_where_parts_are_clustered():
    draw = np.random.default_rng(1)
    centres = draw.integers(-4000, 4000, (16, 4))
    points = centres[draw.integers(0, 16, 20_000)] + draw.integers(-20, 20, (20_000, 4))
    code, sums, numbers, compared = vector_codes.filtered(points, centres)
    assert compared < 400  # most points get their code with a whole subtree
    assert (code == ((points[:, None, :] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)).all()
    assert (numbers == np.bincount(code, minlength=16)).all() and (sums == np.stack([points[code == k].sum(axis=0) for k in range(16)])).all()
