"""Secret candidates are judged by repositories and by owners."""

from pyspark.sql import functions as F

from shelfwright.llm import secret_scan

SCHEMA = "doc_id long, text string, source string, n_chars long"
EXAMPLE, ALONE, TWO = "Zx81Kq77Lm20Pw45Tr63", "Ab12Cd34Ef56Gh78Ij90", "Qw98Er76Ty54Ui32Op10"


def data(spark):
    said = [(k, f"copy {EXAMPLE} of it", "hot") for k in range(40)] + [(100, f"my {ALONE}", "hot"), (101, f"a {TWO}", "hot"), (102, f"a {TWO}", None), (103, None, None)]
    return spark.createDataFrame([(i, t, s, len(t or "")) for i, t, s in said], SCHEMA)


def test_example_repeated_by_one_source(spark):
    got = {r.id: r for r in secret_scan.scanned(data(spark)).withColumn("live", secret_scan.said(F.col("live"))).collect()}
    assert (got[7].live, got[7].n_live, got[7].n_copied) == ("", 0, 1)
    assert (got[100].live, got[100].n_live, got[100].n_copied) == ("token:3:23", 1, 0)
    verdicts = {i: [(x.n_repos, x.n_owners, x.verdict) for x in got[i].judged] for i in (7, 100, 101, 102, 103)}
    assert verdicts == {7: [(40, 1, "copied")], 100: [(1, 1, "live")], 101: [(2, 2, "unsure")], 102: [(2, 2, "unsure")], 103: []}


def test_pipeline_leaves_the_example(spark):
    got = {r.doc_id: r.text for r in secret_scan.redacted(data(spark)).collect()}
    assert got[7] == f"copy {EXAMPLE} of it" and got[100] == "my [SECRET]" and len(got) == 44
