"""The ranker's cut covers all documents, also where labels and the learning sample cover only some (no equal scores here)."""

from shelfwright.llm import quality_ranker


def test_cut_is_the_quantile_of_all_scores(spark):
    text = lambda k: ("plain words of good quality here today " * 5 if k % 4 else "BAD!!! ### $$$ THING " * 40) + " ".join(f"w{j}" for j in range(k % 400 // 4 + k // 400))
    docs = spark.createDataFrame([(k, text(k)) for k in range(1200)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 4 > 0)) for k in range(400) if k % 4 in (0, 1)], "doc_id long, quality int")
    for most in (20_000, 60):
        got = quality_ranker.ranked(docs, labels, lambda c: c < 0, most_labels=most).collect()
        assert abs(sum(r.predicted == 0 for r in got) - 600) <= 24 and all(r.predicted == 0 for r in got if r.id % 4 == 0)
