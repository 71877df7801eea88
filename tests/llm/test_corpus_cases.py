"""The corpus operators against plain Python, and the pipeline's stages, on odd rows: nulls, empty and long texts, ties, repeats, odd columns."""

import base64
import collections
import heapq
import math
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shelfwright.llm import digests, lang_id, mixing, near_dups, piece_bpe, quality_ranker, quality_rules, revisits, secret_scan, sharding
from shelfwright.llm import textarrays as ta
from shelfwright.llm.pieces import Split, Units, vocabulary

PROSE = "It was a bright cold day in April and the clocks were striking thirteen while the wind blew over the old roofs of town. "
ODD = "doc_id long, text string, lang string, source string, n_chars long, row string, doc string, c int, spans string, kept string, key string, block int, _doc string, _x int, id string"
LONG = " ".join(f"word{k}{('', '', ', the', '', '.')[k % 5] if k % 3 else ''}" for k in range(20_000))


def odd_rows():
    r = lambda i, text, source="s": (i, text, "en", source, len(text or ""), "r", "d", 1, "x", "k", "y", 2, "z", 3, "i")
    many = [r(100 + k, f"{PROSE}{PROSE} and number {k} of them is told apart by {k * 7} things that it says here", f"s{k % 3}") for k in range(12)]
    return [r(1, PROSE * 2), r(2, PROSE * 2, None), r(3, None), r(4, ""), r(5, " \n"), r(None, PROSE + "no id"), r(None, PROSE + "no id"), r(7, LONG), r(7, LONG), r(7, "another text of the same id " * 3), r(8, 'the password = "hunter22x" ' + PROSE)] + many


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), ODD).repartition(2)


def test_stages_on_odd_rows(spark, odd):
    none = odd.limit(0)
    kept = corpus_pipeline.quality(spark, odd, "").collect()
    assert {r.doc_id for r in kept} <= {r[0] for r in odd_rows()} and all(r.text and r._doc == "z" and r.key == "y" for r in kept)
    assert sum(r.doc_id == 7 and r.text == LONG for r in kept) == 2  # repeated rows alike
    firsts = corpus_pipeline.near_duplicates(spark, odd, "").collect()
    n = collections.Counter(r.doc_id for r in firsts)
    assert n[None] == 2 and n[7] == 1 and n[1] == 1 and n[2] == 0 and n[3] == n[4] == n[5] == 1
    masked = corpus_pipeline.secrets(spark, odd, "").collect()
    assert len(masked) == len(odd_rows()) and [r.n_chars for r in masked if r.doc_id == 8] == [len(r.text) for r in masked if r.doc_id == 8]
    assert not any("hunter22x" in (r.text or "") for r in masked) and sum(r.text is None for r in masked) == 1
    mixed = corpus_pipeline.mixture(spark, odd, "").collect()
    assert collections.Counter(r[:3] for r in mixed).keys() == collections.Counter(r[:3] for r in odd_rows()).keys()
    ids = corpus_pipeline.encoding(spark, odd, "").collect()
    assert len(ids) == len(odd_rows()) and all(r.n_tokens == 0 for r in ids if r.doc_id in (3, 4))
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, none, "")
        assert out.count() == 0 and (out.columns == odd.columns or stage is corpus_pipeline.encoding)


def test_secret_spans_beside_odd_columns(spark, odd):
    out = secret_scan.redacted(odd)
    assert out.columns == odd.columns and [r.spans for r in out.collect()] == ["x"] * len(odd_rows())


# op2
def test_ranker_is_at_the_minimum_and_cuts_at_the_share():
    draw = np.random.default_rng(3)
    x = draw.normal(size=(120, 3))
    y = (x @ [1.0, -2.0, 0.3] + draw.normal(size=120) > 0).astype(int)
    w = quality_ranker.fit_pairs(x, y, pairs=2000)
    rng = np.random.Generator(np.random.PCG64(7))
    good, bad = x[y == 1], x[y == 0]
    n = min(2000, len(good) * len(bad))
    diff = good[rng.integers(0, len(good), n)] - bad[rng.integers(0, len(bad), n)]
    scale = diff.std(axis=0)

    def loss(v):
        return sum(math.log1p(math.exp(-float(d @ v))) for d in diff) / n + 0.5e-3 * float(((v * scale) ** 2).sum())

    at = loss(w)
    assert all(loss(w + step) > at - 1e-9 for k in range(3) for step in (0.02 * np.eye(3)[k], -0.02 * np.eye(3)[k]))


# op3
def plain_em(rows, names, rounds=100):
    """The same fit, a document at a time."""
    q = quality_rules
    rate = {v: (sum(r[v] == 0 for r in rows) + 0.5) / (sum(r[v] >= 0 for r in rows) + 1) for v in names}
    part = {v: q.RECALL * rate[v] / (rate[v] + 1 - q.PRIOR) for v in names}
    prior, w = q.PRIOR, {v: [min(0.0, math.log(rate[v] * q.ALARM / q.RECALL)), max(0.0, math.log((1 - rate[v] * q.ALARM) / (1 - part[v])))] for v in names}
    prob = lambda r: 1 / (1 + math.exp(-(math.log(prior / (1 - prior)) + sum(w[v][0] * (r[v] == 0) + w[v][1] * (r[v] == 1) for v in names))))
    for _ in range(rounds):
        p = [prob(r) for r in rows]
        new_prior, new = (sum(p) + q.WEIGHT * q.PRIOR) / (len(rows) + q.WEIGHT), {}
        for v in names:
            count = lambda vote, of: sum(x for r, x in zip(rows, of) if r[v] == vote)  # noqa: B023, E731
            rest = [1 - x for x in p]
            alarm = (count(0, p) + q.WEIGHT * rate[v] * q.ALARM) / (count(0, p) + count(1, p) + q.WEIGHT)
            hit = max(alarm, (count(0, rest) + q.WEIGHT * q.RECALL * rate[v] / (rate[v] + 1 - q.PRIOR)) / (count(0, rest) + count(1, rest) + q.WEIGHT))
            new[v] = [math.log(alarm / hit), math.log((1 - alarm) / (1 - hit))]
        moved = max(abs(new_prior - prior), *(abs(a - b) for v in names for a, b in zip(new[v], w[v])))
        prior, w = new_prior, new
        if moved < 1e-4:
            break
    return [prob(r) for r in rows]


def test_posterior_against_plain_em(spark):
    names = list(quality_rules.votes())
    draw = np.random.default_rng(4)
    bad = draw.random(400) < 0.2
    rows = [{v: int(0 if draw.random() < (0.6 if b else (0.2 if k == 4 else 0.01)) else 1 if draw.random() < 0.8 else -1) for k, v in enumerate(names)} for b in bad]
    voted = spark.createDataFrame([tuple(r[v] for v in names) for r in rows], ", ".join(f"{v} int" for v in names))
    got = {tuple(r[v] for v in names): r.p for r in voted.distinct().withColumn("p", quality_rules.posterior(*quality_rules.fitted(voted, names))).collect()}
    want = plain_em(rows, names)
    assert all(abs(got[tuple(r[v] for v in names)] - p) < 1e-6 for r, p in zip(rows, want))
    # Some documents with one bad vote are kept: the posterior is no all-must-pass rule.
    assert any(list(r.values()).count(0) == 1 and p >= 0.5 for r, p in zip(rows, want))


@pytest.mark.skipif(not Path("/root/testdata/sf0.01").exists(), reason="needs the driver's tables")
def test_posterior_overrules_single_votes_and_agrees_with_labels(spark):
    """The labels are looked at here alone."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    voted = quality_rules.measured(docs, "text", F.col("doc_id")).withColumns(quality_rules.votes())
    bad = sum((F.col(v) == quality_rules.BAD).cast("int") for v in quality_rules.votes())
    rows = quality_rules.query(spark, "/root/testdata/sf0.01").join(voted.select("doc_id", bad.alias("bad")), "doc_id").join(labels.select("doc_id", "quality"), "doc_id", "left").where("not base_failed").collect()
    assert sum(r.kept and r.bad > 0 for r in rows) >= 10 and not any(r.kept and r.bad > 2 for r in rows)
    assert all(r.kept for r in rows if r.quality == 1) and not any(r.kept for r in rows if r.quality == 0)


SF = "/root/testdata/sf0.001"
BASE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d), u AS (SELECT doc_id, count(*) - count(DISTINCT line) AS dup FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY 1),
x AS (SELECT doc_id, unnest(range(1, len(w) - 6)) AS i, w FROM d WHERE len(w) >= 8), g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i:i + 7]) AS n FROM x),
r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM g WHERE n > 1) GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT, length(array_to_string(w, ''))::BIGINT, len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT, coalesce(dup, 0)::BIGINT, coalesce(r.n, 0)::BIGINT, len(w) < 20 OR 100 * coalesce(r.n, 0) > 30 * len(w) FROM d LEFT JOIN u USING (doc_id) LEFT JOIN r USING (doc_id)
"""


@pytest.mark.skipif(not Path(SF).exists(), reason="needs the driver's tables")
def test_base_columns_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = quality_rules.query(spark, SF).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
    assert sorted(map(tuple, got)) == sorted(con.execute(BASE_SQL).fetchall())


# op4
def test_mixing_against_plain_bisection(spark):
    sizes = {"hot": 500, "b": 60, "c": 25, None: 40, "wordless": 0}
    rows = [(k, "a b c d" if n else None, s) for s, n in sizes.items() for k in range(n or 30)]
    got = mixing.mixed(spark.createDataFrame(rows, "doc_id long, text string, source string"), entropy_share=0.97, most_repeats=None, block_tokens=300).collect()
    tokens = {s: 4 * n for s, n in sizes.items() if n}
    total = sum(tokens.values())

    def weights(a):
        p = {s: (n / total) ** a for s, n in tokens.items()}
        return {s: x / sum(p.values()) for s, x in p.items()}

    low, high = 0.0, 1.0
    for _ in range(200):
        mid = (low + high) / 2
        entropy = -sum(x * math.log(x) for x in weights(mid).values())
        low, high = (mid, high) if entropy >= 0.97 * math.log(len(tokens)) - 1e-12 else (low, mid)
    have = collections.Counter(r.source for r in got)
    for s, share in weights(low).items():
        quota = math.ceil(share * total - 1e-6)
        assert have[s] == sum(1 for e in range(quota // tokens[s] + 1) for k in range(sizes[s]) if e * tokens[s] + 4 * k < quota)
    blocks = collections.defaultdict(list)
    for r in got:
        blocks[r.block].append(r)
    assert all(sorted(r.slot for r in b) == list(range(len(b))) for b in blocks.values())
    assert have["wordless"] == 30 and len({r.block for r in got if r.source == "wordless"}) > 3


# op5
def plain_digest(text: bytes, ranks):
    """Bits of each filter, window by window."""
    if len(text) < digests.SHORT:
        return None
    kinds = []
    for i in range(len(text) - 63):
        n = collections.Counter(b & 15 for b in text[i : i + 64])
        kinds.append(sum(int(digests._TERM[c]) for c in n.values()) // digests.CLASS)
    points = collections.Counter()
    for a in range(-63, len(kinds)):  # runs that reach beyond an end count, too
        points[min(range(max(0, a), min(a + 64, len(kinds))), key=lambda i: (ranks[kinds[i]], i))] += 1
    return [i for i in sorted(points) if points[i] >= digests.POINTS]


def test_digest_against_plain_contest():
    texts = [(PROSE * 3).encode(), " ".join(f"{k * k} {PROSE[k % 40:k % 40 + 30]}" for k in range(40)).encode()]
    ranks = np.random.default_rng(1).permutation(digests.CLASSES)
    prints = digests.fingerprints(texts, ranks)
    for t, got in zip(texts, prints):
        features, seen = [], set()
        for i in plain_digest(t, ranks):
            if t[i : i + 64] not in seen:
                seen.add(t[i : i + 64])
                features.append(i)
        at = np.array(features)
        hashes = ta.span_hash(ta.prefix_hash(np.frombuffer(t, np.uint8)), at, at + 64).tolist()
        want = np.zeros((-(-len(features) // digests.PER_FILTER), digests.FILTER_BITS), bool)
        for k, h in enumerate(hashes):
            for j in range(digests.HASHES):
                want[k // digests.PER_FILTER, h >> 11 * j & digests.FILTER_BITS - 1] = True
        assert features and np.array_equal(np.packbits(want, axis=1), got)
    assert digests.likeness(prints[0], prints[0]) == 1.0


def test_entropy_ranks_and_equal_ids(spark):
    rows = [(5, PROSE * 2), (5, PROSE * 2), (4, PROSE * 3), (None, PROSE), (3, ""), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ranks = digests.entropy_ranks(docs)
    assert sorted(ranks.tolist()) == list(range(digests.CLASSES))
    got = {(r.id, r.n_chars): r for r in digests.against_next(docs, rows=2).collect()}
    assert len(got) == 5 and got[5, len(PROSE) * 2].fingerprint == f"{base64.b64encode(b'').decode()}" + got[5, len(PROSE) * 2].fingerprint and got[2, 0].near_next < 1
    with pytest.raises(TypeError):
        digests.against_next(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


# op6
def test_repeated_ids_tie_their_texts(spark):
    a, b = "a b c d e f g h i j k l", "m n o p q r s t u v w x y"
    rows = [(3, a), (5, a), (5, b), (9, b), (9, b), (11, None), (11, ""), (None, a), (20, "a text of its own here now")]
    got = sorted((r.id or 0, r.component_id) for r in near_dups.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(0, None), (3, 3), (5, 3), (5, 3), (9, 3), (9, 3), (11, 11), (11, 11), (20, 20)]
    with pytest.raises(TypeError):
        near_dups.near_duplicates(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


def families(draw):
    data = []
    for f in range(3):
        base = [f"w{draw.integers(0, 60)}" for _ in range(60)]
        for k in range(25):
            w = list(base)
            for _ in range(int(draw.integers(0, 6))):
                w[int(draw.integers(0, 60))] = f"x{draw.integers(0, 9)}"
            data.append((1000 * f + k, " ".join(w)))
    return data


@pytest.mark.parametrize("k", [64, 1 << 20])
def test_all_links_by_blocks_of_lists(spark, monkeypatch, k):
    """Small bounds send every list to the blocks; with k above any set's size the search is exact."""
    from test_corpus_operators import brute_components

    monkeypatch.setattr(near_dups, "SHORT_LIST", 3)
    monkeypatch.setattr(near_dups, "BLOCK", 8)
    data = families(np.random.default_rng(k))
    got = {r.id: (r.n_shingles, r.component_id) for r in near_dups.near_duplicates(spark.createDataFrame(data, "doc_id long, text string"), k=k).collect()}
    assert got == brute_components(data)


# op7
def test_header_names_in_any_case_and_one_hot_second(spark):
    h = lambda tag, more: {"ETag": tag, "Content-Length": more, "Date": more}
    data = [(k, "http://a.com/", 7, 200, h(f"v{k}", "9")) for k in range(50)] + [(100 + k, "http://a.com", 7, 304, h("W/v49", "0")) for k in range(50)]
    got = revisits.resolved(spark.createDataFrame(data, "rec_id long, url string, ts long, status int, headers map<string,string>")).collect()
    assert len(got) == 50 and all((r.full_id, r.verdict, r.headers) == (49, "resolved", {"etag": "W/v49", "content-length": "9", "date": "0"}) for r in got)


# op9
def test_expected_counts_against_all_segmentations():
    v = vocabulary(piece_bpe.model_file())
    probs = np.random.default_rng(3).random(len(v.pieces)) / 40
    units, times = ["▁the", "▁hello", "house", "▁" + "ab" * 60, "漢"], np.array([2.0, 1.0, 3.0, 1.0, 4.0])
    split = Split.of_units(units)
    got, log = lang_id._expected(v, Units(v, split, np.arange(len(units))), probs, times)
    want, total = np.zeros(len(probs)), 0.0
    for unit, n in zip(units, times):
        if unit == "漢":
            for b in unit.encode():
                want[v.byte_ids[b]] += n
                total += n * math.log(probs[v.byte_ids[b]])
            continue
        size = len(unit)
        ahead, behind = [0.0] * (size + 1), [0.0] * (size + 1)
        ahead[0] = behind[size] = 1.0
        spans = [(b, e, v.ids[unit[b:e]]) for b in range(size) for e in range(b + 1, min(size, b + 16) + 1) if unit[b:e] in v.ids]
        for b, e, t in sorted(spans, key=lambda x: x[1]):
            ahead[e] += ahead[b] * probs[t]
        for b, e, t in sorted(spans, key=lambda x: -x[0]):
            behind[b] += behind[e] * probs[t]
        for b, e, t in spans:
            want[t] += n * ahead[b] * probs[t] * behind[e] / ahead[size]
        total += n * math.log(ahead[size])
    assert np.allclose(got, want, rtol=1e-6, atol=1e-12) and abs(log - total) < 1e-6


def test_languages_without_spaces_and_behind_unknown_characters(spark):
    draw = np.random.default_rng(6)
    run = lambda letters, n: "".join(draw.choice(list(letters), n))
    forms = {"xa": lambda: run("abcde", 150), "xb": lambda: run("fghij", 150), "xc": lambda: "漢" + run("klmno", 9), "xd": lambda: "漢" + run("pqrst", 9), "xe": lambda: run("日本語の文", 30), "xf": lambda: run("漢字中国人", 30)}
    rows = [(k, form(), lang) for lang, form in forms.items() for k in range(30)]
    docs = spark.createDataFrame([(i, *r[1:]) for i, r in enumerate(rows)], "key long, text string, lang string")
    model = lang_id.train(docs.where("key % 3 > 0"), piece_bpe.model_file())
    found = lang_id.identify(docs.where("key % 3 = 0"), model, "key", "text").collect()
    assert len(found) == 60 and all(r.lang_pred == rows[r.id][2] for r in found)


# op10
def test_shards_against_a_plain_heap(spark):
    draw = np.random.default_rng(2)
    texts = ["x" * int(n) for n in draw.integers(1, 400, 60)]
    rows = [(f"id{k % 50}", texts[k % 60]) for k in range(90)] + [(None, None)] * 3
    got = sharding.sharded(spark.createDataFrame(rows, "doc_id string, text string"), 5).collect()
    assert len(got) == len(rows) and {r.id for r in got} == {r[0] for r in rows}
    groups = collections.Counter()
    for _, t in rows:
        groups[t] += len(t or "") + 8
    heap = [(0, s) for s in range(5)]
    for size in sorted(groups.values(), reverse=True):
        load, s = heapq.heappop(heap)
        heapq.heappush(heap, (load + size, s))
    loads = collections.Counter()
    for r in got:
        loads[r.shard] += r.size
    assert sorted(loads.values()) == sorted(load for load, _ in heap)
    for s in range(5):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
