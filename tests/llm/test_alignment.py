"""op13 against plain Python and the two public libraries."""

import collections
import hashlib

import public_tokenizers
from pyspark.sql import functions as F

from shelfwright.llm import alignment


def token_bytes(texts):
    """For each text both sides' [(id, bytes)], by the public libraries one text at a time."""
    import sentencepiece
    from tokenizers import Tokenizer

    left = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    left.encode_special_tokens = True
    right = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    shown = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
    back = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(x for x in range(256) if x not in shown)}
    piece = lambda p: bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()
    for text in texts:
        a = [(i, bytes(back[c] for c in left.id_to_token(i))) for i in left.encode(" " + text, add_special_tokens=False).ids] if text else []
        b = [(i, piece(right.id_to_piece(i))) for i in right.encode(text)] if text else []
        want = (" " + text).encode() if text else b""
        yield (a, b) if b"".join(x for _, x in a) == want == b"".join(x for _, x in b) else ([], [])


def plain(docs):
    """{id: (n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)}, token by token."""
    found, counts = {}, collections.Counter()
    for (key, _), (a, b) in zip(docs, token_bytes([t or "" for _, t in docs]), strict=True):
        spans = []
        for side in (a, b):
            at, out = 0, []
            for i, said in side:
                out.append((i, at, at + len(said)))
                at += len(said)
            spans.append(out)
        links, k = [], 0
        for i, lo, hi in spans[0]:
            while k and spans[1][k - 1][2] > lo:
                k -= 1
            while k < len(spans[1]) and spans[1][k][1] < hi:
                if spans[1][k][2] > lo:
                    links.append((i, spans[1][k][0]))
                k += 1
        both = {e for _, _, e in spans[0]} & {e for _, _, e in spans[1]}
        parts = []
        for side in spans:
            out, now = [], []
            for i, _, e in side:
                now.append(str(i))
                if e in both:
                    out.append(",".join(now))
                    now = []
            parts.append(out)
        said = ";".join(f"{x}|{y}" for x, y in zip(*parts, strict=True))
        found[key] = (len(a), len(b), len(both), links, hashlib.sha256(said.encode()).hexdigest() if said else "")
        counts.update(links)
    most = collections.Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    return {k: (n_a, n_b, n_g, len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), mark) for k, (n_a, n_b, n_g, links, mark) in found.items()}


TEXTS = [
    None, "", " ", "plain words and more words", "plain words and more words", "Größe naïve ▁ mark", "tabs\tand\r\nlines  with   runs     of spaces ",
    "<|endoftext|> in a text </s> <unk> <0x41>", "日本語と emoji 👩‍👩‍👧 and \u0000 control \x7f", "é combining ​ zero ﻿ width", "x" * 3000, "word " * 30_000, "1234567890 3.14159 don't they'll",
]


def test_equals_plain_python(spark, monkeypatch):
    monkeypatch.setattr(alignment, "SLICE", 1 << 12)
    docs = list(enumerate(TEXTS))
    df = spark.createDataFrame([(k, t, "x", 1, "p") for k, t in docs], "doc_id long, text string, part string, place int, codes string").repartition(3)
    got = {r.id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in alignment.alignment(df, alignment.byte_file(), alignment.model_file()).collect()}
    want = plain(docs)
    assert got == want
    assert want[0] == want[1] == want[5] == (0, 0, 0, 0, 0, 0, "") and want[3][0] > 0 and want[8][0] > 0 and want[7][0] > 0


def test_rows_and_ids_of_any_kind(spark):
    df = spark.createDataFrame([("a", "same words"), ("a", "same words"), (None, "same words"), (None, None)], "name string, body string")
    out = alignment.alignment(df, alignment.byte_file(), alignment.model_file(), "name", "body").collect()
    assert len(out) == 4 and sorted(r.n_links for r in out) == [0, 2, 2, 2] and {r.count_sum for r in out} == {0, 6}
    assert alignment.alignment(df.limit(0), alignment.byte_file(), alignment.model_file(), "name", "body").count() == 0


def test_spans_and_products(spark):
    texts = {k: t for k, t in enumerate(TEXTS[3:10])}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = alignment.aligned(df, alignment.byte_file(), alignment.model_file()).cache()
    sides = dict(zip(texts, token_bytes(texts.values()), strict=True))
    for r in found.collect():
        a, b = sides[r.id]
        assert r.a == [i for i, _ in a] and r.b == [i for i, _ in b] and len(r.end) == len(r.link_a) == len(r.link_b)
        stops = [[sum(len(x) for _, x in side[: k + 1]) for k in range(len(side))] for side in (a, b)]
        for x, y, e in zip(r.link_a, r.link_b, r.end, strict=True):
            assert e == min(stops[0][x], stops[1][y]) and max(stops[0][x] - len(a[x][1]), stops[1][y] - len(b[y][1])) < e
    got = collections.Counter((r.id, r.a, r.b) for r in alignment.expanded(found).collect())
    want = collections.Counter()
    for r in found.collect():
        for k, (x, y) in enumerate(zip(r.close_a, r.close_b, strict=True)):
            for i in r.a[r.close_a[k - 1] if k else 0 : x]:
                for j in r.b[r.close_b[k - 1] if k else 0 : y]:
                    want[r.id, i, j] += 1
    assert got == want and want
    sums = {r.id: r.n_products for r in alignment.alignment(df, alignment.byte_file(), alignment.model_file()).select("id", "n_products").collect()}
    assert sums == {k: sum(n for (i, _, _), n in want.items() if i == k) for k in texts}
    assert found.where(F.size("a") == 0).count() == 1
