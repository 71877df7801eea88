"""Tables of the pipeline's stages: whose they are, and when they go."""

import os
import threading

import corpus_pipeline
from shelfwright import session
from shelfwright.llm import mixing, quality_ranker

PROSE = "The old harbour was quiet in the morning, and the boats lay on the sand. A man came down from the town with a lamp in his hand. "


def documents(spark, n=30):
    return spark.createDataFrame([(k, PROSE + f"It was number {k} of them, he said, and the {k * 7}th of the year.", "en" if k % 3 else "fr", f"s{k % 2}", 9) for k in range(n)], "doc_id long, text string, lang string, source string, n_chars long")


def test_two_stages_built_before_either_is_written(spark):
    docs = documents(spark)
    a = corpus_pipeline.quality(spark, docs, "")
    b = corpus_pipeline.secrets(spark, docs, "")
    c = corpus_pipeline.mixture(spark, docs, "")
    assert a.count() == 30 and b.count() == 30 and c.count() >= 30 and a.count() == 30


def test_tables_go_once_their_result_is_read_back(spark, tmp_path):
    docs = documents(spark)
    with session.tracked() as made:
        pass
    first = corpus_pipeline.quality(spark, docs, "")
    own = corpus_pipeline._own.__dict__[spark.sparkContext.applicationId]
    made = list(own.paths)
    assert made and all(os.path.exists(p) for p in made)
    first.write.parquet(str(tmp_path / "kept"))
    corpus_pipeline.secrets(spark, spark.read.parquet(str(tmp_path / "kept")), "")
    assert not any(os.path.exists(p) for p in made)


def test_two_pipelines_in_one_session(spark, tmp_path):
    for k in (0, 1):
        documents(spark, 30 + k).write.parquet(str(tmp_path / f"d{k}" / "documents.parquet"))
    got, threads = {}, []
    for k in (0, 1):
        t = threading.Thread(target=lambda k=k: got.update({k: corpus_pipeline.run(spark, str(tmp_path / f"d{k}")).select("doc_id").distinct().count()}))
        t.start()
        threads.append(t)
    for t in threads:
        t.join()
    assert set(got) == {0, 1} and all(n > 0 for n in got.values())


def test_mixture_of_uneven_languages(spark):
    """The exponent is below 1, and the weights are those of a plain bisection."""
    rows = [(k, "a b c d e f g h", "en" if k % 10 < 6 else "fr" if k % 10 < 9 else None, f"s{k % 4}") for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    import math

    from pyspark.sql import functions as F

    got = mixing.mixed(docs.select("doc_id", "text", F.to_json(F.struct("lang", "source")).alias("source"))).collect()
    counts = {}
    for _, _, lang, source in rows:
        counts[lang, source] = counts.get((lang, source), 0) + 8
    total = sum(counts.values())

    def weights(a):
        p = {k: (n / total) ** a for k, n in counts.items()}
        return {k: v / sum(p.values()) for k, v in p.items()}

    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        enough = -sum(p * math.log(p) for p in weights(mid).values()) >= 0.97 * math.log(len(counts))
        low, high = (mid, high) if enough else (low, mid)
    assert low < 0.99 and {round(r.exponent, 6) for r in got} == {round(low, 6)}
    of = {r.doc_id: (r.lang, r.source) for r in docs.collect()}
    assert all(abs(r.weight - weights(low)[of[r.id]]) < 1e-6 for r in got)
    assert any(r.epoch > 0 for r in got) and len({r.id for r in got}) < 400


def test_an_id_that_a_third_of_the_rows_share_weighs_once(spark):
    text = lambda k: ("plain words of good quality here today, said he. " * 5 if k % 4 else "BAD!!! ### $$$ THING " * 40) + " ".join(f"w{j}" for j in range(k % 50))
    own = [(k, text(k)) for k in range(400)]
    labels = spark.createDataFrame([(k, int(k % 4 > 0)) for k in range(400)] + [(1000, 0)], "doc_id long, quality int")
    hot = [(1000, f"plain words of good quality here today, said he. {k}") for k in range(200)]
    import pandas as pd

    seen, old = [], quality_ranker.fit_pairs
    quality_ranker.fit_pairs = lambda x, y, pairs: seen.append(len(y)) or old(x, y, pairs)
    try:
        got = quality_ranker.ranked(spark.createDataFrame(own + hot, "doc_id long, text string"), labels, lambda c: c < 0).toPandas()
    finally:
        quality_ranker.fit_pairs = old
    assert seen == [401] and len(got) == 600
    rest = got[got.id < 400]
    assert (rest.predicted == pd.Series([int(k % 4 > 0) for k in rest.id], index=rest.index)).mean() > 0.99
