"""Cases of the fourth round's findings about size."""

import uuid
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from shelfwright.jobs import composite_queries, registry, source_queries
from shelfwright.session import in_slices, new_path, tracked
from shelfwright.sources import readers as S, writers as K

SF = "/root/testdata/sf0.001"


def _catalogues(spark, discs: int, titles: int):
    t = spark.range(discs * titles).select(F.concat(F.lit("d"), F.col("id") % discs).alias("disc"), F.floor(F.col("id") / discs).cast("int").alias("title"), F.lit("0:01:40").alias("duration"))
    return t, t.where("title % 3 > 0").select("disc", "title", F.explode(F.array(F.lit(0), F.lit(1))).alias("n")).withColumn("type", F.lit("Video"))


def test_a_stored_catalogue_has_a_title_a_row(spark, tmp_path):
    """A reader that takes some thousands of stored rows at a time holds as many titles, not all titles of as many discs."""
    titles, streams = _catalogues(spark, 4, 50)
    K.write_catalogue(titles, streams, str(tmp_path / "lines"))
    with open(tmp_path / "lines" / "more.json", "w") as more:
        more.write('{"disc": null, "titles": [{"title": 1}]}\n{"disc": "e", "titles": []}\n{"disc": "f"}\n{"disc": "g", "titles": [null, {"title": 2, "streams": [null]}]}\n')
    with tracked() as made:
        got, of = S.read_catalogue(spark, str(tmp_path / "lines"), lines=True)
    there = [spark.read.parquet(p) for p in made if "/catalogue-" in p]
    assert len(there) == 1 and "titles" not in there[0].columns and there[0].count() == 202
    assert sorted((r.disc, r.title, r.sec) for r in got.where("disc <> 'g'").collect()) == sorted((f"d{d}", t, 100.0) for d in range(4) for t in range(50))
    assert sorted((r.title, r.sec) for r in got.where("disc = 'g' and title is not null").collect()) == [(2, None)]
    assert of.where("disc <> 'g'").count() == 4 * 33 * 2 and of.where("type = 'Video'").count() == 4 * 33 * 2


def test_slices_are_whole_and_leave_nothing_but_their_rows(spark):
    """Each key is in one slice, all rows come back, and a slice's files are gone before the next one's are written."""
    seen, key = [], "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    there = lambda p: Path(p.removeprefix("file:").replace("//", "/")).exists()
    rows = spark.range(1000).select((F.col("id") % 40).alias("disc"), F.col("id").cast("string").alias("content"))

    def make(part):
        assert not any(there(p) for p, _ in seen)
        path = new_path(spark, "files")
        files = part.groupBy(F.col("disc").cast("string").alias("name")).agg(F.concat_ws(",", F.sort_array(F.collect_list("content"))).alias("content"))
        seen.append((path, K.write_files(files, path).count()))
        content = spark.read.text(path, wholetext=True).select(F.explode(F.split("value", ",")).alias("content"))
        return content, content.groupBy().agg(F.count("*").alias("n"))

    before = spark.conf.get(key)
    with tracked() as made:
        whole, counts = in_slices(rows, "disc", make, "sliced", per_slice=300)
    assert len(made) == 1 + 2 * 4 and all(there(p) for p in made) and counts.agg(F.sum("n")).first()[0] == 1000 and counts.count() == 4
    assert sorted(int(r.content) for r in whole.collect()) == list(range(1000))
    assert len(seen) == 4 and sum(n for _, n in seen) == 40 and not any(there(p) for p, _ in seen)
    assert spark.conf.get(key) == before
    assert in_slices(rows, "disc", make, "sliced")[0].count() == 1000 and len(seen) == 5 and there(seen[-1][0])


def test_a_catalogue_is_put_together_in_one_shuffle(spark, tmp_path, capsys):
    """Titles that are there twice, streams of no title and titles without a stream or number stay as a join leaves them."""
    titles = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("a", 2, "z"), ("a", None, "w"), ("b", 1, None)], "disc string, title int, duration string")
    streams = spark.createDataFrame([("a", 1, 1, "V"), ("a", 1, 0, "A"), ("a", 9, 0, "V"), ("a", None, 0, "V"), ("c", 1, 0, "V")], "disc string, title int, n int, type string")
    K.write_catalogue(titles, streams, str(tmp_path / "c"))
    assert {p.suffix for p in (tmp_path / "c").glob("part-*")} == {".gz"}
    got, of = S.read_catalogue(spark, str(tmp_path / "c"), lines=True)
    assert sorted(((r.disc, r.title, r.duration) for r in got.collect()), key=str) == [("a", 1, "x"), ("a", 1, "y"), ("a", 2, "z"), ("a", None, "w"), ("b", 1, None)]
    assert sorted((r.disc, r.title, r.n, r.type) for r in of.collect()) == [("a", 1, 0, "A"), ("a", 1, 0, "A"), ("a", 1, 1, "V"), ("a", 1, 1, "V")]
    assert {r.disc: r.titleCount for r in spark.read.json(str(tmp_path / "c")).collect()} == {"a": 4, "b": 1}


def _results(spark, make) -> int:
    """Bytes that the tasks of make()'s jobs send to the driver."""
    tracker, store = spark.sparkContext.statusTracker(), spark.sparkContext._jsc.sc().statusStore()
    spark.sparkContext.setJobGroup(group := uuid.uuid4().hex, "")
    try:
        make()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
    return sum(store.lastStageAttempt(s).resultSize() for s in stages if tracker.getStageInfo(s) and tracker.getStageInfo(s).numCompletedTasks)


def _readings(top, folders: int, cues: int):
    for k in range(folders):
        (top / f"f{k}").mkdir(parents=True)
        for c in range(cues):
            (top / f"f{k}" / f"cue_{c:04d}.txt").write_text(f" line {k} {c} \n")


def test_the_driver_gets_no_list_of_files(spark, tmp_path):
    """What tasks tell the driver does not grow with the files, be they listed or read."""
    sent = []
    for n in (2, 40):
        _readings(tmp_path / str(n), 40, n)
        sent.append([_results(spark, lambda: S.read_listing(spark, str(tmp_path / str(n))).write.format("noop").mode("overwrite").save()), _results(spark, lambda: S.read_ocr_results(spark, str(tmp_path / str(n))).write.format("noop").mode("overwrite").save())])
    assert all(0 < few and many < 3 * few + 50_000 for few, many in zip(*sent, strict=True)), sent


def test_trees_are_listed_as_spark_lists_them(spark, tmp_path):
    """Hidden files and files of no bytes are left out; a folder may be named by a path or an address, and names are those on disk."""
    for rel in ("a b/c%20d/x+1.txt", "a b/ü.txt", "top.txt", "a b/.hidden/x.txt", "a b/_no/x.txt", "_k=1/x.txt", ".x", "_y", "z._COPYING_"):
        (tmp_path / "t" / rel).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "t" / rel).write_text(rel)
    (tmp_path / "t" / "empty").write_text("")
    (tmp_path / "t" / "none").mkdir()
    spark_says = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(tmp_path / "t"))
    wanted = sorted((r.path, r.length, r.modificationTime, bytes(r.content)) for r in spark_says.collect())
    rels = {"a b/c%20d/x+1.txt", "a b/ü.txt", "top.txt", "_k=1/x.txt"}
    for root in (f"{tmp_path}/t", f"{tmp_path}/t/", f"file:{tmp_path}/t", f"file://{tmp_path}/t"):
        tree = S._tree(spark, root)
        assert sorted((r.path, r.length, r.modificationTime, bytes(r.content)) for r in tree.collect()) == wanted
        assert {(r.rel, r.work, r.dir, r.name) for r in S.read_listing(spark, root).collect()} == {(x, x.partition("/")[0] if "/" in x else None, x.rpartition("/")[0], x.rpartition("/")[2]) for x in rels}
    assert {r.rel for r in S._tree(spark, f"{tmp_path}/t", r"\.txt$", contents=False).collect()} == rels
    assert S.read_listing(spark, str(tmp_path / "t" / "none")).count() == 0


@pytest.mark.skipif(not Path(SF).exists(), reason="needs the driver's tables")
@pytest.mark.parametrize("name", ["c2_accounting_files", "s12_k1_catalogue", "s12_k1_catalogue_lines"])
def test_queries_in_slices_equal_their_sql(spark, monkeypatch, name):
    """A few discs at a time give what all at once give, and of their files only the job's own catalogues stay."""
    at = composite_queries if name.startswith("c2") else source_queries
    monkeypatch.setattr(at, "in_slices", lambda rows, key, make, tag: in_slices(rows, key, make, tag, per_slice=2000))
    c = duckdb.connect()
    c.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{SF}/lineitem.parquet'")
    ran = c.execute(registry.ORACLE_SQL[name])
    names = [d[0] for d in ran.description]
    with tracked() as made:
        got = registry.QUERIES[name](spark, SF)
    assert sorted((tuple(r) for r in got.select(*names).collect()), key=str) == sorted(ran.fetchall(), key=str)
    kinds = {p.rpartition("/")[2].partition("-")[0] for p in made}
    assert kinds == ({"catalogue", "discs", "probed"} if name.startswith("c2") else {"catalogued"})
