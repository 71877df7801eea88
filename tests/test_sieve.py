"""The dictionary's sieve: no hit is lost, few others pass, and verdicts are the same without it."""

from pyspark.sql import functions as F

from shelfwright.operators import aggregates as A


def test_sieve_loses_no_word(spark):
    known = spark.range(20_000).select(F.concat(F.lit("w"), F.col("id") * 7).alias("word"))
    rows = spark.range(60_000).select("id", F.concat(F.lit("w"), F.col("id")).alias("key"))
    passed = A.likely(rows, "key", known)
    assert passed.columns == ["id", "key"]
    ids = {r.id for r in passed.collect()}
    hits = {k for k in range(60_000) if k % 7 == 0}
    assert hits <= ids and len(ids - hits) < 0.03 * 60_000
    assert A.likely(rows, "key", known, most_bits=1 << 10).count() == 60_000  # too large a filter: nothing is tested
    assert A.likely(rows, "key", known.limit(0)).count() == 0


def test_gates_are_the_same(spark):
    line = lambda k: " ".join(f"{'the' if j % 3 else 'word'}{'' if j % 3 else chr(97 + (k + j) % 26)} it's o'clock" for j in range(8))
    texts = spark.createDataFrame([(f"f{k}", "\n".join(f"{n}\n00:00:01,000 --> 00:00:02,000\n{line(k + n)}" for n in range(1, 3 + 4 * k))) for k in range(8)], "file_id string, text string")
    probes = texts.select("file_id", F.lit(100.0).alias("sec"), F.lit(4).alias("max_packets"))
    words = spark.createDataFrame([("The",), ("it",), ("worda",), ("wordb",), ("o'clock",), (None,)], "word string")
    got = [sorted(map(tuple, A.ocr_gates(texts, probes, words, sieve_bits=bits).collect())) for bits in (A.SIEVE_BITS, 0)]
    assert got[0] == got[1] and len(got[0]) == 8 and len({r[7] for r in got[0]}) > 1
