"""Quality rules by weak supervision: rules vote or abstain, and the votes' own agreement says how far to trust each.

Native throughout: word, line and window statistics are array expressions of one scan; expectation-maximisation runs
over the counts of vote patterns (at most 3 to the number of rules, whatever the corpus holds).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from shelfwright.session import stored

SYMBOL = r"[#*$%&|<>]"
WINDOW = 8
#: Votes.
GOOD, BAD, ABSTAIN = 1, 0, -1


def _let(value: Column, body) -> Column:
    """body(value), with value worked out once."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column) -> Column:
    """Words inside windows of 8 words that the text holds twice or more, the first one included."""

    def paired(h: Column, by: int) -> Column:
        """Of each place its hash together with the one `by` places on."""
        n = F.greatest(F.lit(0), F.size(h) - by)
        return F.zip_with(F.slice(h, 1, n), F.slice(h, by + 1, n), lambda x, y: F.xxhash64(x, y))

    def covered(marks: Column) -> Column:
        # (hash, place) in order: a place counts if a neighbour has its hash; windows in order of place then overlap.
        ordered = F.array_sort(F.transform(marks, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(o: Column) -> Column:
            last = F.size(o)
            same = F.transform(o, lambda x, k: F.when(((k > 0) & (F.get(o, k - 1)["h"] == x["h"])) | ((k < last - 1) & (F.get(o, k + 1)["h"] == x["h"])), x["i"]))
            return F.array_sort(F.filter(same, lambda i: i.isNotNull()))

        def length(p: Column) -> Column:
            start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last"))
            step = lambda acc, i: F.struct((acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).cast("long").alias("n"), i.alias("last"))
            return F.aggregate(p, start, step, lambda acc: acc["n"])

        return _let(ordered, lambda o: _let(places(o), length))

    each = F.transform(words, lambda w: F.xxhash64(w))
    hashes = _let(_let(_let(each, lambda h: paired(h, 1)), lambda h: paired(h, 2)), lambda h: paired(h, 4))
    return _let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered(h)))


#: What the rules look at.
STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "_kinds", "_stutters", "_lines", "_c", "_m", "_ends", "_commas", "_stops", "_bare"]
#: Common function words of English, French, German and Spanish, without marks around them.
FUNCTION_WORDS = """a al and are as at auf be but by con con dans das de del dem den der des die du ein eine el elle en er es est et for from had has he his ich il in is
it la las le les lo los mit ne nicht no not of on or par pas por pour que qui se sich sie son su sur that the this to un una und une was we wenn which with y you zu""".split()


def measured(docs: DataFrame, text_col: str = "text", *kept: Column) -> DataFrame:
    """The kept columns (all of docs, if none are named) with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and
    what the rules look at besides.

    A null text has no words. The counts are of whole texts.
    """
    def of_words(w: Column) -> Column:
        pairs = F.zip_with(w, F.slice(w, 2, F.greatest(F.size(w), F.lit(1))), lambda x, y: x == y)
        stutters = F.size(F.filter(pairs, lambda same: same)).cast("long")
        return F.struct(stutters.alias("stutters"), F.size(w).cast("long").alias("n"), F.length(F.array_join(w, "")).cast("long").alias("chars"), _repeat_words(w).alias("repeats"), F.size(F.array_distinct(w)).cast("long").alias("kinds"), F.size(F.filter(w, lambda x: F.lower(F.trim(x, F.lit(".,;:!?"))).isin(FUNCTION_WORDS))).cast("long").alias("stops"))

    def of_lines(x: Column) -> Column:
        return F.struct((F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"), F.size(x).cast("long").alias("n"))

    def of_text(t: Column) -> Column:
        words = F.array_remove(F.split(t, r"[\x20\x09-\x0D]+"), "")
        lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
        count = lambda pattern: F.regexp_count(t, F.lit(pattern)).cast("long")
        capitals = F.length(F.regexp_replace(t, "[^A-Z]+", "")).cast("long")
        return F.struct(_let(words, of_words).alias("w"), _let(lines, of_lines).alias("l"), count(SYMBOL).alias("symbols"), capitals.alias("c"), count("!").alias("m"), count(r"[.!?](?=\s|$)").alias("ends"), count(",").alias("commas"), count(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D\p{L}]+(?![^\x20\x09-\x0D])").alias("bare"))

    # One expression for all, so that the text is taken once a row.
    found = docs.select(*(kept or docs.columns), _let(F.coalesce(F.col(text_col), F.lit("")), of_text).alias("_x"))
    names = {"n_words": "w.n", "word_chars": "w.chars", "n_symbols": "symbols", "n_dup_lines": "l.dup", "n_repeat_words": "w.repeats", "_kinds": "w.kinds", "_stutters": "w.stutters", "_lines": "l.n", "_c": "c", "_m": "m", "_ends": "ends", "_commas": "commas", "_stops": "w.stops", "_bare": "bare"}
    return found.withColumns({k: F.col(f"_x.{v}") for k, v in names.items()}).drop("_x")


def _vote(bad: Column, good: Column | None = None) -> Column:
    found = F.when(bad, BAD)
    return (found if good is None else found.when(good, GOOD)).otherwise(ABSTAIN)


def votes() -> dict[str, Column]:
    """The rules: each votes that a document is bad, that it is good, or abstains. Most documents are voted on by most rules, and what
    most texts have in common - sentences, commas, function words, lines of some length - speaks for a document as well as against."""
    n, chars, symbols = F.col("n_words"), F.col("word_chars"), F.col("n_symbols")
    per_100 = lambda c: F.col(c) * 100
    return {
        "v_symbols": _vote(symbols * 5 > n, symbols * 50 <= n),
        "v_repeats": _vote(per_100("n_repeat_words") > n * 29, per_100("n_repeat_words") <= n * 5),
        "v_dup_lines": _vote((F.col("n_dup_lines") > 2) & (per_100("n_dup_lines") > F.col("_lines") * 30), F.col("n_dup_lines") == 0),
        "v_stutter": _vote(per_100("_stutters") > n * 30, per_100("_stutters") <= n * 5),
        "v_capitals": _vote(F.col("_c") * 10 > chars * 3, F.col("_c") * 10 <= chars),
        "v_shouting": _vote(F.col("_m") * 10 > n, per_100("_m") <= n),
        "v_word_length": _vote((chars < n * 2) | (chars > n * 14), (chars >= n * 3) & (chars <= n * 10)),
        "v_variety": _vote(per_100("_kinds") < n * 25, per_100("_kinds") >= n * 40),
        "v_sentences": _vote((per_100("_ends") < n) | (per_100("_ends") > n * 25), (per_100("_ends") >= n * 3) & (per_100("_ends") <= n * 20)),
        "v_function_words": _vote(per_100("_stops") < n * 5, per_100("_stops") >= n * 10),
        "v_commas": _vote((F.col("_commas") == 0) & (n >= 60) | (per_100("_commas") > n * 25), (per_100("_commas") >= n) & (per_100("_commas") <= n * 15)),
        "v_letterless": _vote(per_100("_bare") > n * 20, per_100("_bare") <= n * 5),
        "v_line_length": _vote((n < F.col("_lines") * 4) | (n > F.col("_lines") * 120), (n >= F.col("_lines") * 8) & (n <= F.col("_lines") * 100)),
    }


#: What is taken for known before any vote is seen, and how many documents that weighs as: the share of good documents, of a bad
#: document's votes those that are bad, of a rule's bad votes those on good documents.
PRIOR, RECALL, ALARM, WEIGHT = 0.9, 0.5, 0.25, 20.0


def fitted(voted: DataFrame, names: list[str], rounds: int = 100) -> tuple[float, dict[str, tuple[float, float]]]:
    """(prior, weights) by expectation-maximisation over the vote patterns of a corpus.

    Given the class, rules vote independently, and an abstention says nothing. Learned are the share of good documents and
    of each rule how many of its votes on good and on bad documents are bad. What is known before is counts like
    others (WEIGHT documents), not a bound, so a large corpus outweighs it. At the start a quarter of a rule's bad votes
    count as false alarms: a rule that seldom fires is trusted, one that fires on many documents is not, until the
    other rules' votes on the same documents say otherwise. A bad vote never speaks for a document. A weight is the log-odds that a
    bad (first) or good (second) vote adds for the good class. An empty corpus keeps the start. The driver holds the patterns' counts.
    """
    patterns = voted.groupBy(*names).agg(F.count("*").alias("n")).collect()
    total = sum(r["n"] for r in patterns)
    rate = {v: (sum(r["n"] for r in patterns if r[v] == BAD) + 0.5) / (sum(r["n"] for r in patterns if r[v] != ABSTAIN) + 1) for v in names}
    recall = {v: RECALL * rate[v] / (rate[v] + 1 - PRIOR) for v in names}  # of what all rules find, this one's part
    prior, weights = PRIOR, {v: (min(0.0, math.log(rate[v] * ALARM / RECALL)), max(0.0, math.log((1 - rate[v] * ALARM) / (1 - recall[v])))) for v in names}
    for _ in range(rounds if total else 0):
        good = bad = 0.0
        sums = {v: [0.0] * 4 for v in names}  # bad and good votes on good documents, then on bad ones
        for r in patterns:
            odds = math.log(prior / (1 - prior)) + sum(weights[v][0] if r[v] == BAD else weights[v][1] if r[v] == GOOD else 0.0 for v in names)
            p = 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))
            good, bad = good + r["n"] * p, bad + r["n"] * (1 - p)
            for v in names:
                if r[v] != ABSTAIN:
                    k = 0 if r[v] == BAD else 1
                    sums[v][k] += r["n"] * p
                    sums[v][k + 2] += r["n"] * (1 - p)
        new_prior = (good + WEIGHT * PRIOR) / (total + WEIGHT)
        new = {}
        for v, (alarms, fine, hits, missed) in sums.items():
            alarm = (alarms + WEIGHT * rate[v] * ALARM) / (alarms + fine + WEIGHT)
            hit = max(alarm, (hits + WEIGHT * recall[v]) / (hits + missed + WEIGHT))
            new[v] = (math.log(alarm / hit), math.log((1 - alarm) / (1 - hit)))
        moved = max(abs(new_prior - prior), *(abs(x - y) for v in names for x, y in zip(new[v], weights[v], strict=True)))
        prior, weights = new_prior, new
        if moved < 1e-4:
            break
    return prior, weights


def posterior(prior: float, weights: dict[str, tuple[float, float]]) -> Column:
    """Probability of the good class given the votes."""
    odds = F.lit(math.log(prior / (1 - prior)))
    for v, (bad, good) in weights.items():
        odds = odds + F.when(F.col(v) == GOOD, good).when(F.col(v) == BAD, bad).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def _judged(docs: DataFrame, text_col: str, threshold: float, *kept: Column) -> DataFrame:
    """The kept columns, the statistics and votes, base_failed, p_good and kept of each row; each text is scanned once."""
    names = list(votes())
    facts = measured(docs, text_col, *kept).withColumns(votes())
    facts = facts.withColumn("base_failed", (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30))
    facts = stored(facts.drop(*STATISTICS[5:]), "facts")
    prior, weights = fitted(facts, names)
    return facts.withColumn("p_good", posterior(prior, weights)).withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= threshold))


def judged(docs: DataFrame, keep_cols: list[str], text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """keep_cols of docs (renamed by the caller where they clash) with the statistics, base_failed, p_good and kept.

    base_failed: fewer than 20 words, or over 30 % of them in repeated windows. kept: not base_failed and a posterior
    of at least `threshold`. Null and empty texts fail. Every row is judged, repeated rows alike; an empty table gives none.
    """
    found = _judged(docs, text_col, threshold, F.struct(*keep_cols).alias("_doc"))
    return found.select("_doc.*", *STATISTICS[:5], "base_failed", "p_good", "kept")


def kept_documents(docs: DataFrame, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of docs, all columns as they were, that judged() keeps. Texts stay where they are, beside their verdict."""
    return _judged(docs, text_col, threshold, F.struct(*docs.columns).alias("_doc")).where("kept").select("_doc.*")


def query(spark, sf_dir: str) -> DataFrame:
    """op3: every document's statistics and verdict."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return judged(docs, ["doc_id"])
