"""Improbable-feature digests: byte windows ranked by how rare their entropy is, selected into chained Bloom filters.

Every window of 64 bytes has an entropy over 16 classes of bytes. How often each entropy occurs is counted over all
windows of the corpus, and the fewer windows share one, the rarer it is. Of each 64 windows in a row the rarest (of equal
ones the leftmost) gets a point; windows with 16 points or more are the features of a text. In order of place they go to Bloom filters of 2,048 bits, 160 to a filter, then the next.
A text of under 128 bytes has too few windows for a contest: all its windows of 8 bytes are features, or itself as one.
Two digests are compared filter by filter: the bits in common beyond chance, as a share of what was possible.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfwright.llm import textarrays as ta
from shelfwright.llm.ordering import whole_numbers
from shelfwright.session import arrow_map

WINDOW, NEIGHBOURS, POINTS = 64, 64, 16
FILTER_BITS, PER_FILTER, HASHES = 2048, 160, 5
SHORT, SHORT_WINDOW = 128, 8
_CHUNK = 1 << 20
_UNIT = 1000  # entropies are whole numbers of 1/1000 bit
#: Entropies count as equal within so many thousandths of a bit; classes of entropy there are.
CLASS, CLASSES = 20, 4 * _UNIT // 20 + 2
_c = np.arange(WINDOW + 1)
_TERM = np.zeros(256, np.int16)
_TERM[1 : WINDOW + 1] = np.round(-(_c[1:] / WINDOW) * np.log2(_c[1:] / WINDOW) * _UNIT)
#: One byte of a word counts each of 8 classes; two words have 16.
_LOW = np.array([1 << 8 * (b & 7) if not b & 8 else 0 for b in range(256)], np.uint64)
_HIGH = np.array([1 << 8 * (b & 7) if b & 8 else 0 for b in range(256)], np.uint64)


def _entropy(data: np.ndarray) -> np.ndarray:
    """Of the window that begins at each place, in thousandths of a bit."""
    out = np.zeros(len(data) - WINDOW + 1, np.int32)
    for classes in (_LOW, _HIGH):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(classes[data], dtype=np.uint64, out=sums[1:])
        counts = (sums[WINDOW:] - sums[:-WINDOW]).view(np.uint8)
        out += _TERM[counts].reshape(-1, 8).sum(axis=1, dtype=np.int32)
    return out


def _least_ahead(keys: np.ndarray, n: int) -> np.ndarray:
    """The least of each n keys in a row."""
    size = -(-len(keys) // n) * n
    rows = np.full(size, np.iinfo(np.int64).max)
    rows[: len(keys)] = keys
    rows = rows.reshape(-1, n)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: len(keys) - n + 1], ahead[n - 1 : len(keys)])


def _windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one array, first and end byte of each, the class of entropy of each window and whether it counts:
    it lies in one text, of SHORT bytes at least."""
    gap = b"\0" * (WINDOW + NEIGHBOURS)  # keeps the windows and the contests of texts apart
    data, first, end = ta.packed([b"", *texts], gap)
    first, end = first[1:], end[1:]
    kind = (_entropy(data) // CLASS).astype(np.int64)
    whole = np.zeros(len(data) + 1, np.int8)
    long = end - first >= SHORT
    whole[first[long]] += 1
    whole[end[long] - WINDOW + 1] -= 1
    return data, first, end, kind, np.cumsum(whole[: len(kind)], dtype=np.int8) > 0


def entropy_ranks(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """The place of each class of entropy from rare (0) to common, by its windows in all texts; of equal ones the lower class first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(CLASSES, np.int64)
        for _, texts in ta.chunks(batches, "text", _CHUNK):
            *_, kind, counts = _windows(texts)
            sums += np.bincount(kind[counts], minlength=CLASSES)
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sums[some])], ["kind", "n"])

    found = arrow_map(docs.select(F.col(text_col).alias("text")), run, "kind long, n long").groupBy("kind").agg(F.sum("n").alias("n")).collect()
    sums = np.zeros(CLASSES, np.int64)
    for r in found:
        sums[r["kind"]] = r["n"]
    ranks = np.empty(CLASSES, np.int64)
    ranks[np.argsort(sums, kind="stable")] = np.arange(CLASSES)
    return ranks


def fingerprints(texts: list[bytes], ranks: np.ndarray) -> list[np.ndarray]:
    """The filters of each text, (filters x 256) bytes: none for an empty text, equal ones for equal texts.

    ranks: of each class of entropy, from rare to common (entropy_ranks of a corpus).
    """
    data, first, end, kind, valid = _windows(texts)
    long = end - first >= SHORT
    keys = ranks[kind] << 32 | np.arange(len(kind))
    none = np.iinfo(np.int64).max
    keys[~valid] = none
    won = _least_ahead(keys, NEIGHBOURS)
    won = won[won != none] & 0xFFFFFFFF
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(won)) + 1, [len(won)])) if len(won) else np.zeros(1, np.int64)
    chosen = won[cuts[:-1]][np.diff(cuts) >= POINTS]
    owner = np.searchsorted(first, chosen, "right") - 1
    short = np.flatnonzero(~long & (end > first))
    size = np.minimum(end - first, SHORT_WINDOW)[short]
    windows = (end - first)[short] - size + 1
    begin = np.repeat(first[short] - (np.cumsum(windows) - windows), windows) + np.arange(int(windows.sum()))
    sums = ta.prefix_hash(data)
    hashes = np.concatenate((ta.span_hash(sums, chosen, chosen + WINDOW), ta.span_hash(sums, begin, begin + np.repeat(size, windows))))
    owner, at = np.concatenate((owner, np.repeat(short, windows))), np.concatenate((chosen, begin))
    # A feature counts once in a text.
    _, once = np.unique(ta.mix(hashes + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
    once = once[np.argsort(at[once])]
    hashes, owner = hashes[once], owner[once]
    number = np.bincount(owner, minlength=len(texts))
    rank = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
    filters = -(-number // PER_FILTER)
    stop = np.cumsum(filters)
    row = (stop - filters)[owner] + rank // PER_FILTER
    bits = np.zeros((int(stop[-1]) if len(stop) else 0, FILTER_BITS), bool)
    for k in range(HASHES):
        bits[row, ((hashes >> np.uint64(11 * k)) & np.uint64(FILTER_BITS - 1)).astype(np.int64)] = True
    rows = np.packbits(bits, axis=1)
    return [rows[b - n : b] for b, n in zip(stop.tolist(), filters.tolist(), strict=True)]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1: of the digest with fewer filters, the mean of each filter's best overlap in the other beyond chance."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if len(a) > len(b) or (len(a) == len(b) and a.tobytes() > b.tobytes()):
        a, b = b, a
    size_b = np.bitwise_count(b).sum(axis=1, dtype=np.int64)
    total = 0.0
    for f in a:
        size = int(np.bitwise_count(f).sum(dtype=np.int64))
        common = np.bitwise_count(b & f).sum(axis=1, dtype=np.int64)
        most, chance = np.minimum(size, size_b), size * size_b / FILTER_BITS
        total += float(np.clip((common - chance) / np.maximum(most - chance, 1e-9), 0.0, 1.0).max())
    return total / len(a)


def as_text(filters: np.ndarray) -> str:
    return f"{len(filters)}:{base64.b64encode(filters.tobytes()).decode()}"


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: np.ndarray | None = None) -> DataFrame:
    """(id, fingerprint) of every whole text; a null text is empty. Without ranks those of docs themselves hold: fingerprints
    of two corpora are comparable only by the same ranks."""
    ranks = entropy_ranks(docs, text_col) if ranks is None else ranks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in ta.chunks(batches, "text", _CHUNK):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([as_text(f) for f in fingerprints(texts, ranks)])], ["id", "fingerprint"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return arrow_map(rows, run, f"id {rows.schema['id'].dataType.simpleString()}, fingerprint string")


def _bounds(ids: DataFrame, rows: int, most: int) -> np.ndarray:
    """Ids that cut the table into parts of about `rows` rows, `most` parts at most; descending order is meant."""
    n = ids.count()
    parts = max(1, min(most, -(-n // rows)))
    if parts == 1:
        return np.zeros(0, np.int64)
    cuts = ids.where("id is not null").approxQuantile("id", [k / parts for k in range(1, parts)], 0.2 / parts)
    return np.unique(np.array(cuts, np.int64))


def _part(bounds: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Part 0 has the greatest ids."""
    return len(bounds) - np.searchsorted(bounds, ids, "left")


def against_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = 4000, most_parts: int = 50_000, ranks: np.ndarray | None = None) -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for every row.

    The next row is that of the next lower id (equal ids by text; a null id comes last); after the last comes the first.
    The edited text has its last floor(n / 2) characters replaced by the next text's first ones. A null text is empty.
    Ids are whole numbers (else a TypeError). Texts move once, to ranges of ids; the first row of each range is sent to
    the range before it, too, and rows are streamed in order, a chunk of texts at a time. Ranges hold about `rows` rows;
    beyond most_parts ranges they grow with the input, in time but not in memory, as do rows that share one id.
    """
    low = -(2**63)
    ranks = entropy_ranks(docs, text_col) if ranks is None else ranks
    ids = docs.select(whole_numbers(docs, id_col).alias("id"))
    bounds = _bounds(ids, rows, most_parts)
    parts = len(bounds) + 1

    def parted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).fill_null(low).to_numpy(zero_copy_only=False)
            part = _part(bounds, own)
            heads = np.unique(part)
            yield pa.RecordBatch.from_arrays([pa.array(heads, pa.int32()), pa.array([own[part == p].max() for p in heads.tolist()], pa.int64())], ["part", "head"])

    found = {r["part"]: r["head"] for r in arrow_map(ids, parted, "part int, head long").groupBy("part").agg(F.max("head").alias("head")).collect()}
    filled = sorted(found)  # ranges with rows, the greatest ids first
    before = {found[p]: filled[k - 1] for k, p in enumerate(filled)}  # the first range's head also ends the last one
    head_ids = np.array(sorted(before), np.int64)
    head_for = np.array([before[h] for h in head_ids.tolist()], np.int32)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).fill_null(low).to_numpy(zero_copy_only=False)
            part = pa.array(_part(bounds, own), pa.int32())
            yield pa.RecordBatch.from_arrays([part, pa.array(np.zeros(len(own), bool)), *batch.columns], ["part", "guest", "id", "text"])
            at = np.searchsorted(head_ids, own)
            guest = np.flatnonzero((at < len(head_ids)) & (head_ids[np.minimum(at, len(head_ids) - 1)] == own))
            if len(guest):
                some = batch.take(pa.array(guest))
                yield pa.RecordBatch.from_arrays([pa.array(head_for[at[guest]]), pa.array(np.ones(len(guest), bool)), *some.columns], ["part", "guest", "id", "text"])

    texts = docs.select(whole_numbers(docs, id_col).alias("id"), F.col(text_col).alias("text"))
    # Each range is a partition of its own: a hash of its number would put several into one.
    moved = arrow_map(texts, dealt, "part int, guest boolean, id long, text string").repartitionById(parts, "part")
    moved = moved.sortWithinPartitions("part", "guest", F.col("id").desc_nulls_last(), F.col("text").asc_nulls_first())
    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def compared(rows: list[tuple], after: str) -> pa.RecordBatch:
        """Rows (id, text) in order; after: the text that follows the last."""
        own = [t for _, t in rows] + [after]
        edited = [t[: len(t) - len(t) // 2] + n[: len(t) // 2] for t, n in zip(own, own[1:], strict=False)]
        raw = [t.encode() for t in edited]
        prints = fingerprints([*(t.encode() for t in own), *raw], ranks)
        a, b = prints[: len(own)], prints[len(own) :]
        columns = [
            pa.array([i for i, _ in rows], pa.int64()),
            pa.array([len(t) for t in own[:-1]], pa.int64()),
            pa.array([hashlib.sha256(t).hexdigest() for t in raw]),
            pa.array([as_text(f) for f in a[:-1]]),
            pa.array([as_text(f) for f in b]),
            pa.array([likeness(x, y) for x, y in zip(a, b, strict=False)]),
            pa.array([likeness(x, y) for x, y in zip(a, a[1:], strict=False)]),
        ]
        return pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, part, closed = 0, None, False
        for batch in batches:
            for p, guest, i, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                t = t or ""
                if guest:
                    if held and not closed:
                        yield compared(held, t)
                        held, size = [], 0
                    closed = True  # of several guests with one id the first counts
                    continue
                if p != part:
                    part, closed = p, False
                if size > _CHUNK // 2:
                    yield compared(held, t)
                    held, size = [], 0
                held.append((i, t))
                size += len(t)

    return arrow_map(moved, run, "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def query(spark, sf_dir: str) -> DataFrame:
    """op5: every document's fingerprint against that of its edited text and of the next document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return against_next(docs).withColumnRenamed("id", "doc_id")
