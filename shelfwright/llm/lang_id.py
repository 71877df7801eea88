"""Language identification by unigram piece models with all segmentations summed.

For each language every piece of a fixed public vocabulary has a probability, learned by expectation-maximisation. The
likelihood of a unit (a word with the space before it, or what stands behind a character that the vocabulary lacks) is
the sum over all its segmentations into pieces, by a forward pass; such a character itself is its byte pieces. A text's
likelihood is the product over its units without digits. Each distinct unit of a chunk is passed once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shelfwright.llm import textarrays as ta
from shelfwright.llm.piece_bpe import CHUNK, KEPT, model_file
from shelfwright.llm.pieces import Split, Units, Vocabulary, merged, vocabulary
from shelfwright.session import arrow_map, stored

#: Score of a text with nothing to learn from.
UNDETERMINED = "und"


def _byte_rows(vocab: Vocabulary, u: Units) -> tuple[np.ndarray, np.ndarray]:
    """(unit, piece) of every byte of the units whose one character the vocabulary lacks: such a unit is its byte pieces."""
    lacking = np.flatnonzero(~u.is_known)
    said = [chr(c).encode("utf-8", "replace") for c in u.flat[u.first[lacking]].tolist()]
    of = np.repeat(lacking, np.fromiter(map(len, said), np.int64, len(said)))
    return of, vocab.byte_ids[np.frombuffer(b"".join(said), np.uint8)].astype(np.int64)


def _with_digits(u: Units) -> np.ndarray:
    """Units with a digit; they say nothing of the language."""
    out = np.zeros(len(u.first), bool)
    if len(u.flat):
        out[:] = np.maximum.reduceat((u.flat >= 48) & (u.flat <= 57), u.first)
    return out


#: Places after which running sums are scaled anew; no piece is longer.
_STEP = 16
#: Characters times languages that the forward pass holds at once.
_CELLS = 1 << 23


def _log_likelihood(vocab: Vocabulary, u: Units, probs: np.ndarray) -> np.ndarray:
    """log-likelihood of each unit by language: the sum over all its segmentations. Languages go in blocks of _CELLS values."""
    out = np.zeros((len(u.first), probs.shape[1]))
    whole = np.flatnonzero(u.is_known & ~u.only_marks)
    steps = list(u.by_end(vocab))
    wide = max(1, _CELLS // max(1, len(u.flat)))
    of, byte = _byte_rows(vocab, u)
    for c in range(0, probs.shape[1], wide):
        p = np.ascontiguousarray(probs[:, c : c + wide])
        alpha = np.zeros((len(u.flat) + 1, p.shape[1]))  # of the prefix that ends behind a place, kept at that place
        scale = np.zeros((len(u.first), p.shape[1]))
        for k, (place, past, piece) in enumerate(steps):
            start = place == u.core[u.unit_at[place]]
            before = np.where(start[:, None], 1.0, alpha[place - 1])
            order = np.argsort(past, kind="stable")
            sums = before[order] * p[piece[order]]
            ends, first = np.unique(past[order], return_index=True)
            alpha[ends - 1] = np.add.reduceat(sums, first, axis=0)
            if k % _STEP == _STEP - 1:  # keeps long units within the range of doubles
                who = u.unit_at[ends - 1]
                top = np.maximum(alpha[ends - 1], 1e-300)
                scale[who] += np.log(top)
                back = ends[:, None] - 1 - np.arange(_STEP)
                inside = back >= u.core[who][:, None]
                alpha[back[inside]] /= np.repeat(top, inside.sum(axis=1), axis=0)
        out[whole, c : c + wide] = np.log(np.maximum(alpha[u.end[whole] - 1], 1e-300)) + scale[whole]
        np.add.at(out[:, c : c + wide], of, np.log(p[byte]))
    out[_with_digits(u)] = 0.0
    return out


def _expected(vocab: Vocabulary, u: Units, probs: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, float]:
    """Expected counts of the pieces in the units of one language (probs: its pieces'), and the units' log-likelihood.

    weights: how often each unit stands. Forward and backward sums are scaled as they go, so units may be of any length.
    """
    counts = np.zeros(len(probs))
    of, byte = _byte_rows(vocab, u)
    counts += np.bincount(byte, weights[of], len(probs))
    total = float((np.log(probs[byte]) * weights[of]).sum())
    steps = list(u.by_end(vocab))
    if not steps:
        return counts, total
    ahead, ahead_log = np.zeros(len(u.flat) + 1), np.zeros(len(u.flat) + 1)
    for k, (place, past, piece) in enumerate(steps):
        start = place == u.core[u.unit_at[place]]
        order = np.argsort(past, kind="stable")
        sums = (np.where(start, 1.0, ahead[place - 1]) * probs[piece])[order]
        ends, first = np.unique(past[order], return_index=True)
        ahead[ends - 1] = np.add.reduceat(sums, first)
        # What a prefix's sum was divided by is the same for all prefixes that the next pieces begin behind.
        ahead_log[ends - 1] = np.where(ends - 2 >= u.core[u.unit_at[ends - 1]], ahead_log[ends - 2], 0.0)
        if k % _STEP == _STEP - 1:
            top = np.maximum(ahead[ends - 1], 1e-300)
            back = ends[:, None] - 1 - np.arange(_STEP)
            inside = back >= u.core[u.unit_at[ends - 1]][:, None]
            ahead[back[inside]] /= np.repeat(top, inside.sum(axis=1))
            ahead_log[back[inside]] += np.repeat(np.log(top), inside.sum(axis=1))
    place, past, piece = (np.concatenate(x) for x in zip(*steps, strict=True))
    order = np.argsort(place - u.core[u.unit_at[place]], kind="stable")[::-1]
    place, past, piece = place[order], past[order], piece[order]
    far = place - u.core[u.unit_at[place]]
    cuts = np.flatnonzero(np.diff(far)) + 1
    behind, behind_log = np.zeros(len(u.flat) + 1), np.zeros(len(u.flat) + 1)
    for a, b in zip(np.concatenate(([0], cuts)).tolist(), np.append(cuts, len(place)).tolist(), strict=True):
        p, q, t = place[a:b], past[a:b], piece[a:b]
        who = u.unit_at[p]
        by_place = np.argsort(p, kind="stable")
        starts, first = np.unique(p[by_place], return_index=True)
        last = q == u.end[who]
        behind[starts] = np.add.reduceat((probs[t] * np.where(last, 1.0, behind[np.minimum(q, len(behind) - 1)]))[by_place], first)
        end = u.end[u.unit_at[starts]]
        behind_log[starts] = np.where(starts + 1 < end, behind_log[np.minimum(starts + 1, len(behind) - 1)], 0.0)
        if far[a] % _STEP == 0:
            top = np.maximum(behind[starts], 1e-300)
            on = starts[:, None] + np.arange(_STEP)
            inside = on < end[:, None]
            behind[on[inside]] /= np.repeat(top, inside.sum(axis=1))
            behind_log[on[inside]] += np.repeat(np.log(top), inside.sum(axis=1))
    who = u.unit_at[place]
    start, last = place == u.core[who], past == u.end[who]
    before, before_log = np.where(start, 1.0, ahead[place - 1]), np.where(start, 0.0, ahead_log[place - 1])
    after, after_log = np.where(last, 1.0, behind[np.minimum(past, len(behind) - 1)]), np.where(last, 0.0, behind_log[np.minimum(past, len(behind) - 1)])
    unit_log = np.log(np.maximum(ahead[u.end - 1], 1e-300)) + ahead_log[u.end - 1]
    shares = before * probs[piece] * after * np.exp(before_log + after_log - unit_log[who])
    counts += np.bincount(piece, shares * weights[who], len(probs))
    whole = u.is_known & ~u.only_marks
    return counts, total + float((unit_log * weights)[whole].sum())


class Model:
    """Languages, their shares of the learning texts, and piece probabilities (pieces x languages)."""

    def __init__(self, path: str, langs: list[str], prior: np.ndarray, probs: np.ndarray):
        self.path, self.langs, self.prior, self.probs = path, langs, prior, probs
        self.keys, self.rows = np.zeros(0, np.uint64), np.zeros((0, len(langs)))

    def __getstate__(self):
        return self.path, self.langs, self.prior, self.probs

    def __setstate__(self, state):
        self.__init__(*state)

    def score(self, texts: list[str]) -> np.ndarray:
        """log-likelihood of each text by language."""
        vocab = vocabulary(self.path)
        split = Split(vocab, texts)
        out = np.zeros((len(texts), len(self.langs)))
        if not len(split.keys):
            return out
        at = np.searchsorted(self.keys, split.keys)
        seen = np.zeros(len(split.keys), bool)
        inside = at < len(self.keys)
        seen[inside] = self.keys[at[inside]] == split.keys[inside]
        new = np.flatnonzero(~seen)
        rows = _log_likelihood(vocab, Units(vocab, split, new), self.probs)
        keys, order = merged(self.keys, split.keys[new])
        rows = np.concatenate((self.rows, rows))[order]
        if len(keys) <= KEPT:
            self.keys, self.rows = keys, rows
        each = rows[np.searchsorted(keys, split.keys)[split.of]]
        some = np.flatnonzero(split.per_text)
        out[some] = np.add.reduceat(each, (np.cumsum(split.per_text) - split.per_text)[some], axis=0)
        return out


def _sample(known: DataFrame, per_lang: int) -> tuple[DataFrame, list[tuple[str, int]]]:
    """The texts to learn from, about per_lang of each language at most, and the languages with their numbers of texts."""
    sizes = stored(known.groupBy("lang").agg(F.count("*").alias("n")), "langs")
    rate = sizes.select(F.col("lang").alias("_lang"), (F.least(F.lit(1.0), F.lit(float(per_lang)) / F.col("n")) * (1 << 20)).alias("_rate"))
    chosen = known.join(rate, F.col("lang") == F.col("_lang")).where(F.pmod(F.xxhash64("key"), F.lit(1 << 20)) < F.col("_rate"))
    return chosen.select("lang", "text"), [(r["lang"], r["n"]) for r in sizes.orderBy("lang").collect()]


def train(samples: DataFrame, path: str, per_lang: int = 1000, rounds: int = 4, gain: float = 0.01, smooth: float = 0.1) -> Model:
    """A model from (text, lang, key).

    It learns from about `per_lang` texts of each language at most (a bound of the fit alone): those whose hash of key
    falls below the language's rate. Executors count their units - all of them, of any length, with a space mark in
    front or behind a character that the vocabulary lacks - and work out expected piece counts; the driver holds piece
    probabilities, one row of the vocabulary (256 KB) for each language. Expectation-maximisation ends after `rounds`,
    or once the log-likelihood grows by less than `gain` of itself: later rounds change ranks of languages no more.
    """
    known = samples.where("text is not null and lang is not null")
    chosen, sizes = _sample(known, per_lang)
    langs = [lang for lang, _ in sizes]
    if not langs:
        return Model(path, [], np.zeros(0), np.zeros((0, 0)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch, texts in ta.chunks(batches, "text", CHUNK):
            said, names = [t.decode().lower() for t in texts], batch.column(0).to_pylist()
            for lang in sorted(set(names)):
                s = Split(v, [t for t, x in zip(said, names, strict=True) if x == lang])
                times = np.bincount(s.of, minlength=len(s.keys))
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(times), pa.string()), pa.array(s.units(), pa.string()), pa.array(times, pa.int64())], ["lang", "unit", "n"])

    counted = stored(arrow_map(chosen, count, "lang string, unit string, n long").groupBy("lang", "unit").agg(F.sum("n").alias("n")), "units")
    n_pieces = len(vocabulary(path).pieces)
    at = {lang: k for k, lang in enumerate(langs)}
    probs, before = np.full((n_pieces, len(langs)), 1.0 / n_pieces), None
    for _ in range(rounds):

        def expect(batches: Iterator[pa.RecordBatch], probs: np.ndarray = probs) -> Iterator[pa.RecordBatch]:
            v = vocabulary(path)
            sums = np.zeros_like(probs)
            said = np.zeros(len(langs))
            for batch, units in ta.chunks(batches, "unit", CHUNK // 4):
                who = np.fromiter((at[x] for x in batch.column(0).to_pylist()), np.int64, batch.num_rows)
                times, units = batch.column(2).to_numpy().astype(float), np.array([x.decode() for x in units], object)
                for k in np.unique(who).tolist():
                    split = Split.of_units(units[who == k].tolist())
                    u = Units(v, split, np.arange(len(split.length)))
                    more, log = _expected(v, u, probs[:, k], np.where(_with_digits(u), 0.0, times[who == k]))
                    sums[:, k] += more
                    said[k] += log
            piece, lang = np.nonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(piece), pa.array(lang), pa.array(sums[piece, lang])], ["piece", "lang", "n"])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(langs), -1)), pa.array(np.arange(len(langs))), pa.array(said)], ["piece", "lang", "n"])

        got = arrow_map(counted, expect, "piece long, lang long, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n")).toArrow()
        piece, lang, n = (got.column(c).to_numpy() for c in ("piece", "lang", "n"))
        sums = np.full_like(probs, smooth)
        sums[piece[piece >= 0], lang[piece >= 0]] += n[piece >= 0]
        probs = sums / sums.sum(axis=0)
        log = float(n[piece < 0].sum())
        if before is not None and log - before < gain * abs(before):
            break
        before = log
    prior = np.array([n for _, n in sizes], np.float64)
    return Model(path, langs, prior / prior.sum(), probs)


def identify(docs: DataFrame, model: Model, id_col: str, text_col: str) -> DataFrame:
    """(id, lang_pred, score) of every whole text.

    score is the posterior of the language found, from equal priors; where likelihoods tie, the language that more
    learning texts have is taken. A null text, one without a letter, or an empty model gives `und` and 0.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    if not model.langs:
        return rows.select("id", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(model.langs, object)
        for batch, texts in ta.chunks(batches, "text", CHUNK):
            logs = model.score([t.decode().lower() for t in texts])
            logs -= logs.max(axis=1, keepdims=True)
            best = np.argmax(logs + 1e-12 * model.prior, axis=1)
            score = 1.0 / np.exp(logs).sum(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names[best], pa.string()), pa.array(score)], ["id", "lang_pred", "score"])

    said = arrow_map(rows.where(_lettered("text")), run, f"id {rows.schema['id'].dataType.simpleString()}, lang_pred string, score double")
    rest = rows.where(~F.coalesce(_lettered("text"), F.lit(False))).select("id", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    return said.unionByName(rest)


def _lettered(column: str) -> Column:
    return F.col(column).rlike(r"\p{L}")


def query(spark, sf_dir: str) -> DataFrame:
    """op9: the language of every document; rows with crc32(doc_id) mod 4 = 2 are never learned from."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))
    learn = docs.where(~held & F.col("doc_id").isNotNull()).select("text", "lang", F.col("doc_id").alias("key"))
    model = train(learn, model_file())
    found = identify(docs, model, "doc_id", "text")
    return found.select(F.col("id").alias("doc_id"), F.coalesce(F.pmod(F.crc32(F.col("id").cast("string")), F.lit(4)) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")
