"""Cases of the third round's findings."""

from pathlib import Path

import duckdb
import pytest

from shelfwright.jobs import registry
from shelfwright.operators import aggregates as A, audits as U, reconcile as J
from shelfwright.sources import readers as S

SF = "/root/testdata/sf0.001"


def test_ink_weight_in_thousandths(spark):
    """Lumas that are just 32 apart are no ink, though their doubles differ by more."""
    row = ("edge", [0x442082, 0x822EB0, 0xFFFFFF, 0x000000] + [0] * 12, [0, 1, 2, 3], [15, 15, 15, 0], [900, 100, 100, 0])
    got = A.ink_weight(spark.createDataFrame([row], "disc string, palette array<int>, pal_idx array<int>, alpha array<int>, hist array<bigint>")).first()
    assert (got.ratio, got.verdict) == (None, "skip")


@pytest.mark.skipif(not Path(SF).exists(), reason="needs the driver's tables")
def test_minutes_as_decimals(spark, tmp_path):
    """A file midway between two episodes: 3 * 1.3 minutes are 3.9, not the double above it."""
    for t in ["lineitem", "part", "events", "documents", "conversations"]:
        (tmp_path / f"{t}.parquet").symlink_to(f"{SF}/{t}.parquet")
    # Two episodes of one season, at 20.2 and 28.0 minutes; the file of order 3 has 3 * 1.3 minutes more than the first.
    c = duckdb.connect()
    c.execute(f"CREATE TABLE o AS SELECT * FROM '{SF}/orders.parquet' LIMIT 0")
    c.execute("INSERT INTO o (o_orderkey, o_custkey, o_totalprice) VALUES (3, 1, 2.0), (9, 1, 80.0)")
    c.execute(f"COPY o TO '{tmp_path}/orders.parquet'")
    c.execute("CREATE VIEW orders AS SELECT * FROM o")
    ran = c.execute(registry.ORACLE_SQL["j5_match_by_runtime"])
    names = [d[0] for d in ran.description]
    want = sorted(ran.fetchall(), key=str)
    got = registry.QUERIES["j5_match_by_runtime"](spark, str(tmp_path)).select(*names).collect()
    assert sorted((tuple(r) for r in got), key=str) == want


def test_landmarks_of_large_files(spark):
    """Files above the limit of pairs go by words and rings, with the errors that a comparison line by line has."""
    say = ["a long line that comes back", "uh 3!", "another Line of five words", "of five", "", "x"]
    cues = [(f, 4.0 * k, say[(k * k + f) % 6] + ("" if k % 3 else f" {k}")) for f in (1, 2, 3) for k in range(120)] + [(3, 8.0, "uh 3!"), (None, 1.0, "x")]
    marks = [(f, 40 * f + k, 7.0 * k + f, w) for f in (1, 2, 3, 4) for k, w in enumerate(["LINE of five", "uh", "that comes", "a long line", "never a word", "line that comes back 3", "five words", "x", None, ""] * 2)]
    cues = spark.createDataFrame(cues, "file_id long, start_s double, text string")
    marks = spark.createDataFrame([*marks, (None, 1, 1.0, "x"), (1, 999, None, "x")], "file_id long, landmark int, t double, line string")
    pairs = {(f, n): min(((abs(s - t), s, s - t) for g, s, text in map(tuple, cues.collect()) if g == f and f and t is not None and line is not None and line.lower() in text.lower()), default=(0, 0, None))[2] for f, n, t, line in map(tuple, marks.collect())}
    for per_file in (J.PER_FILE, 2000, 0):
        assert {(r.file_id, r.landmark): r.error for r in J.nearest_cue(cues, marks, per_file=per_file).collect()} == pairs


def test_small_files_in_few_tasks(spark, tmp_path):
    """Readers of many small files run few tasks, and give back the setting that they list with."""
    for k in range(100):
        (tmp_path / f"c{k}").mkdir()
        (tmp_path / f"c{k}/cue_{k}.txt").write_text(f" line {k} \n")
        (tmp_path / f"c{k}/cue_{k}_res.json").write_text('{"rec_texts": ["read"]}' if k % 2 else '{"rec_texts": []}')
    key, most = "spark.sql.sources.parallelPartitionDiscovery.parallelism", "spark.sql.files.maxPartitionBytes"
    before, size = spark.conf.get(key), spark.conf.get(most)
    spark.conf.set(most, "4m")
    try:
        listing, read = S.read_listing(spark, str(tmp_path)), S.read_ocr_results(spark, str(tmp_path))
        assert listing.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
        assert listing.count() == 200 and spark.conf.get(key) == before
        assert {(r.file_id, r.cue, r.text) for r in read.collect()} == {(f"c{k}", k, "read" if k % 2 else f"line {k}") for k in range(100)}
    finally:
        spark.conf.set(most, size)


def test_union_after_merge_in_one_pass(spark, capsys):
    """The names are compared in one aggregation, with no joins; a null name equals no other."""
    names = lambda *rels: spark.createDataFrame([(r,) for r in rels], "rel string")
    out = U.union_after_merge(names("a", "b", "b", None), names("c", "a"), names("b", "c", "d", "d", None))
    assert sorted(map(tuple, out.collect()), key=str) == [("a", "LOST"), ("d", "UNEXPECTED"), (None, "LOST"), (None, "UNEXPECTED")]
    out.explain()
    assert "Join" not in capsys.readouterr().out
