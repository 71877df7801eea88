"""A quality classifier by Bradley-Terry ranking: scores learned from preference pairs, cut at a score quantile.

Of two labelled documents the one of quality 1 is preferred to the one of quality 0. The chance of a preference is the
logistic function of the difference of scores, a score is linear in a document's features, and the weights minimise the
logistic loss on feature differences.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfwright.llm import textarrays as ta
from shelfwright.session import arrow_map, stored

FEATURES = ["f_length", "f_short", "f_symbols", "f_bars", "f_capitals", "f_shouting", "f_digits", "f_stutter", "f_repeats", "f_sameness", "f_dup_lines", "f_word_length", "f_stops"]
_CLASS = np.zeros(256, np.int64)
_LOWER, _UPPER, _DIGIT, _SYMBOL, _BAR, _SHOUT, _STOP, _HIGH = range(1, 9)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = _LOWER, _UPPER, _DIGIT, _HIGH
_CLASS[[ord(c) for c in "#*$%&<>"]], _CLASS[ord("|")], _CLASS[ord("!")], _CLASS[[ord(c) for c in ".,;"]] = _SYMBOL, _BAR, _SHOUT, _STOP
_CHUNK = 1 << 21


def _new_in_text(owner: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """How many different hashes each of n texts has."""
    _, first = np.unique(ta.mix(hashes + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
    return np.bincount(owner[first], minlength=n)


def features(texts: list[bytes]) -> np.ndarray:
    """One row of FEATURES for each whole text; zeros for an empty one."""
    n = len(texts)
    data, first, end = ta.packed(texts, b"\n")
    owner = np.repeat(np.arange(n), end - first + 1)
    kinds = np.bincount(owner * 9 + _CLASS[data], minlength=9 * n).reshape(n, 9).astype(float)
    start, stop = ta.words(data)
    of = owner[start] if len(start) else start
    words = np.bincount(of, minlength=n).astype(float)
    some = np.maximum(words, 1)
    sums = ta.prefix_hash(data)
    each = ta.span_hash(sums, start, stop)
    stutter = np.bincount(of[1:][(each[1:] == each[:-1]) & (of[1:] == of[:-1])], minlength=n)
    kinds_of_word = _new_in_text(of, each, n)
    rolled = np.zeros(max(0, len(each) - 7), np.uint64)
    for j, w in enumerate(ta.powers(0xD1342543DE82EF95, 8)):
        rolled += each[j : j + len(rolled)] * w
    inside = of[: len(rolled)] == of[7:] if len(rolled) else np.zeros(0, bool)
    windows = np.bincount(of[: len(rolled)][inside], minlength=n)
    repeats = windows - _new_in_text(of[: len(rolled)][inside], rolled[inside], n)
    breaks = np.flatnonzero(data == 10)
    begin = np.concatenate(([0], breaks[:-1] + 1)) if len(breaks) else breaks
    full = breaks > begin
    line_of = owner[begin[full]] if len(breaks) else breaks
    lines = np.bincount(line_of, minlength=n)
    dup_lines = lines - _new_in_text(line_of, ta.span_hash(sums, begin[full], breaks[full]), n)
    letters = np.maximum(kinds[:, _LOWER] + kinds[:, _UPPER] + kinds[:, _HIGH], 1)
    size = np.maximum(end - first, 1)
    length = np.bincount(of, stop - start, minlength=n) / some
    columns = [
        np.log1p(words) / 10,
        words < 20,
        np.minimum(kinds[:, _SYMBOL] / some, 3) / 3,
        np.minimum(kinds[:, _BAR] / some, 1),
        kinds[:, _UPPER] / letters,
        np.minimum(kinds[:, _SHOUT] / some, 1),
        kinds[:, _DIGIT] / size,
        stutter / some,
        repeats / np.maximum(windows, 1),
        (1 - kinds_of_word / some) ** 4,
        dup_lines / np.maximum(lines, 1),
        np.minimum(np.abs(length - 6), 20) / 20,
        np.minimum(kinds[:, _STOP] / some, 1),
    ]
    return np.stack([np.asarray(c, float) for c in columns], axis=1) * (words > 0)[:, None]


def featured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, f_..): the features of every whole text; a null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in ta.chunks(batches, "text", _CHUNK):
            x = features(texts)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x[:, k]) for k in range(x.shape[1]))], ["id", *FEATURES])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return arrow_map(rows, run, f"id {rows.schema['id'].dataType.simpleString()}, " + ", ".join(f"{f} double" for f in FEATURES))


def fit_pairs(x: np.ndarray, y: np.ndarray, pairs: int = 40_000, l2: float = 1e-3, rounds: int = 300) -> np.ndarray:
    """Weights that minimise the logistic loss on differences of (preferred, other) rows, by Newton's method."""
    good, bad = x[y == 1], x[y == 0]
    if not len(good) or not len(bad):
        return np.zeros(x.shape[1])
    draw = np.random.Generator(np.random.PCG64(7))
    n = min(pairs, len(good) * len(bad))
    diff = good[draw.integers(0, len(good), n)] - bad[draw.integers(0, len(bad), n)]
    scale = np.maximum(diff.std(axis=0), 1e-6)
    diff = diff / scale
    w = np.zeros(x.shape[1])
    for _ in range(min(rounds, 30)):
        p = 1 / (1 + np.exp(np.clip(diff @ w, -30, 30)))  # of the wrong order
        slope = -(diff * p[:, None]).mean(axis=0) + l2 * w
        bend = (diff * (p * (1 - p))[:, None]).T @ diff / n + l2 * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w / scale


def ranked(docs: DataFrame, labels: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most_labels: int = 20_000, cut: float = 0.3, most_pairs: int = 40_000) -> DataFrame:
    """(id, score, predicted) of every whole text, learned from labels of ids for which held_out(id column) is false.

    At most about `most_labels` labelled rows are learned from (those with the lowest hashes of their id; they alone
    come to the driver, as features, one row for each id: of rows that repeat an id the one with the least features), by
    `most_pairs` random pairs of them. An id whose labels differ is left out. The
    threshold is the quantile of all documents' scores at the share of label 0 among all labels that are not held out,
    however many of them were learned from; scores are logistic around it, so that it becomes `cut`. Without both labels all
    documents score 0.5. Rows are scored each by its own text, also where an id is null or repeats; ids may be of any type,
    labels' ids are brought to it. Null and empty texts have features of 0, equal texts equal scores; an empty table gives no row.
    """
    facts = stored(featured(docs, id_col, text_col), "features")
    known = labels.select(F.col(id_col).cast(docs.schema[id_col].dataType).alias("id"), F.col(label_col).alias("y")).where("id is not null and y is not null").where(~held_out(F.col("id")))
    known = known.groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("y2")).where("y = y2")
    n, bad = known.agg(F.count("*"), F.count_if(F.col("y") == 0)).first()
    if n > most_labels:
        known = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(most_labels / n * (1 << 30)))
    learn = facts.join(known.select("id", "y"), "id").groupBy("id", "y").agg(F.min(F.struct(*FEATURES)).alias("x")).select("y", "x.*").toPandas()
    x, y = learn[FEATURES].to_numpy(float), learn["y"].to_numpy()
    order = np.lexsort((*x.T[::-1], y)) if len(y) else np.zeros(0, int)  # whatever order rows came in
    x, y = x[order], y[order]
    w = fit_pairs(x, y, most_pairs)
    if not w.any():
        return facts.select("id", F.lit(0.5).alias("score"), F.lit(1).alias("predicted"))
    raw = sum((F.col(f) * float(k) for f, k in zip(FEATURES, w, strict=True)), F.lit(0.0))
    last = facts.agg(F.percentile_approx(raw, bad / n, 100_000)).first()[0]
    # Half-way to the next score, so that the last document of the share lies below.
    above = facts.where(raw > last).agg(F.min(raw)).first()[0]
    threshold = last if above is None else (last + above) / 2
    score = 1 / (1 + F.exp(-(raw - threshold + math.log(cut / (1 - cut)))))
    return facts.select("id", score.alias("score")).withColumn("predicted", F.when(F.col("score") >= cut, 1).otherwise(0))


def _held_out(doc_id):
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0, F.lit(False))


def query(spark, sf_dir: str) -> DataFrame:
    """op2: every document's score; rows with crc32(doc_id) mod 5 = 0 are never learned from."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    out = ranked(docs, labels, _held_out)
    return out.select(F.col("id").alias("doc_id"), _held_out(F.col("id")).alias("held_out"), "score", "predicted")
