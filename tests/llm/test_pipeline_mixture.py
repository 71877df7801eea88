"""The pipeline's mixing stage writes each row of the plan, in its order."""

import collections

import corpus_pipeline


def test_mixture(spark):
    rows = [(k, f"a b c d{k}", "en", "hot", 9) for k in range(300)] + [(None if k % 2 else 7, f"a b c r{k}", "en", "rare", 9) for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    got = [r.text for r in corpus_pipeline.mixture(spark, docs, "").collect()]
    n = collections.Counter(got)
    assert set(n) == {r[1] for r in rows} and sum(n[r[1]] for r in rows[:300]) <= 301 and all(3 <= n[r[1]] <= 5 for r in rows[300:])
    assert [t for t in got if "d" in t] != [r[1] for r in rows[:300]]
    at = [i for i, t in enumerate(got) if "r" in t]
    assert at[0] < len(got) / 4 and at[-1] > len(got) * 3 / 4
