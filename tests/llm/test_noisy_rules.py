"""A rule that fires on many documents which the others find good is learned to be noise."""

from shelfwright.llm import quality_rules


def test_one_bad_vote_of_a_noisy_rule(spark):
    words = lambda k, form: " ".join(form(f"w{(k * 31 + j * 7) % 997}abc") for j in range(80))
    clean = [(k, words(k, str)) for k in range(120)]
    loud = [(1000 + k, words(k, str.upper)) for k in range(60)]
    junk = [(2000 + k, " ".join(f"###w{k}" if j % 9 else f"$$$v{k}{j}" for j in range(60))) for k in range(20)]
    docs = spark.createDataFrame(clean + loud + junk, "doc_id long, text string")
    voted = quality_rules.measured(docs).withColumns(quality_rules.votes()).where("doc_id = 1000").select(*quality_rules.votes()).first().asDict()
    # Texts without sentences, commas and function words: rules that vote on all documents alike tell nothing.
    same = {v for v in voted if voted[v] == quality_rules.BAD}
    assert same == {"v_capitals", "v_sentences", "v_function_words", "v_commas"} and list(voted.values()).count(quality_rules.GOOD) >= 6
    kept = {r.doc_id: r.kept for r in quality_rules.judged(docs, ["doc_id"]).collect()}
    assert all(kept[k] for k, _ in clean + loud) and not any(kept[k] for k, _ in junk)


def test_patterns(spark):
    names = list(quality_rules.votes())
    vote = lambda *bad: tuple(quality_rules.BAD if k in bad else quality_rules.GOOD if k % 4 != 1 else quality_rules.ABSTAIN for k in range(len(names)))
    rows = [vote()] * 650 + [vote(4)] * 250 + [vote(0, 7)] * 40 + [vote(0)] * 60
    voted = spark.createDataFrame(rows, ", ".join(f"{v} int" for v in names))
    p = quality_rules.posterior(*quality_rules.fitted(voted, names))
    got = {tuple(r[v] for v in names): r.p for r in voted.distinct().withColumn("p", p).collect()}
    assert got[vote()] > 0.5 and got[vote(4)] > 0.5 and got[vote(0, 7)] < 0.5 and got[vote(0)] < 0.5
