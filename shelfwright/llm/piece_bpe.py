"""SentencePiece (BPE) encoding and decoding through a merge-type prefix table.

For each prefix of a unit exactly one piece can be the last of its encoding: the one that ends there, by the automaton,
and stands behind the last piece of the prefix before it as a compatible pair - a pair whose own text is encoded as just
that pair. The table keeps this piece for each prefix, and ids are recovered backwards. Time is linear in the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfwright.llm import textarrays as ta
from shelfwright.llm.pieces import MARK, Split, Units, Vocabulary, merged, vocabulary
from shelfwright.session import arrow_map

#: Bytes of text worked on at once.
CHUNK = 1 << 21
_KNOWN_BITS = 20
#: Units whose ids a worker keeps; others are worked out anew in each chunk.
KEPT = 1 << 20


class Merger:
    """Which pieces may stand side by side, by merge order of the vocabulary."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.spines: dict[tuple[int, bool], list[tuple[int, float, float]]] = {}
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.pair_key = np.full(1 << _KNOWN_BITS, -1, np.int64)
        self.pair_fits = np.zeros(1 << _KNOWN_BITS, bool)

    def rank(self, piece: int) -> float:
        """When a merge makes this piece: early is low. Single characters are there from the start."""
        return -1.0 if self.vocab.lengths[piece] == 1 else -self.vocab.scores[piece]

    def split(self, piece: int) -> tuple[int, int] | None:
        """The two pieces of its last merge."""
        if piece not in self.halves:
            row, last = [self.vocab.ids[c] for c in self.vocab.pieces[piece]], None
            while len(row) > 1:
                made = [(self.vocab.ids.get(self.vocab.pieces[a] + self.vocab.pieces[b]), k) for k, (a, b) in enumerate(zip(row, row[1:], strict=False))]
                best, k = min(((self.rank(m), k) for m, k in made if m is not None), default=(None, -1))
                if best is None:
                    break
                last = (row[k], row[k + 1])
                row[k : k + 2] = [made[k][0]]
            self.halves[piece] = last if len(row) == 1 else None
        return self.halves[piece]

    def spine(self, piece: int, right: bool) -> list[tuple[int, float, float]]:
        """What stands at the piece's right or left edge over time: (piece, made at, merged away at)."""
        key = (piece, right)
        if key not in self.spines:
            out, gone, at = [], float("inf"), piece
            while True:
                out.append((at, self.rank(at), gone))
                halves = self.split(at) if self.vocab.lengths[at] > 1 else None
                if halves is None:
                    break
                gone, at = self.rank(at), halves[right]
            self.spines[key] = out
        return self.spines[key]

    def fits(self, left: int, right: int) -> bool:
        """Whether the text of the pair is encoded as the pair. Of equal ranks, the merge further left comes first."""
        names, ids = self.vocab.pieces, self.vocab.ids
        for a, made_a, gone_a in self.spine(left, True):
            for b, made_b, gone_b in self.spine(right, False):
                if made_b < gone_a and made_a <= gone_b:  # side by side for some time
                    across = ids.get(names[a] + names[b])
                    if across is not None and (when := self.rank(across)) < gone_a and when <= gone_b:
                        return False
        return True

    def all_fit(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """fits() of many pairs; answers are kept in a table of fixed size."""
        key = left << 21 | right
        slot = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _KNOWN_BITS)).astype(np.int64)
        out = self.pair_fits[slot]
        missing = np.flatnonzero(self.pair_key[slot] != key)
        if len(missing):
            new, which = np.unique(key[missing], return_inverse=True)
            answers = np.array([self.fits(k >> 21, k & 0x1FFFFF) for k in new.tolist()], bool)
            out[missing] = answers[which]
            at = slot[missing]
            self.pair_key[at], self.pair_fits[at] = key[missing], out[missing]
            wrong = self.pair_key[at] != key[missing]  # two new pairs in one slot: the last key stays with its own answer
            if wrong.any():
                both = dict(zip(new.tolist(), answers.tolist(), strict=True))
                for s in set(at[wrong].tolist()):
                    self.pair_fits[s] = both[int(self.pair_key[s])]
        return out


class Encoder:
    """Ids of texts; one for each vocabulary and worker."""

    def __init__(self, path: str):
        self.vocab = vocabulary(path)
        self.merger = Merger(self.vocab)
        v = self.vocab
        self.valid = np.array([len(p) == 1 or (p in v.ids and not p.startswith(MARK * 2) and self.merger.split(i) is not None) for i, p in enumerate(v.pieces)], bool)
        runs = {len(p): i for p, i in v.ids.items() if set(p) == {MARK}}
        self.runs = runs
        self.keys, self.begin, self.size, self.flat = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def run_ids(self, n: int) -> list[int]:
        """Marks only merge last, all at one score, the leftmost first: the first block grows as far as it can."""
        out: list[int] = []
        while n > 0:
            size = 1
            ahead = 0  # marks of the block that grows behind it
            while size + ahead < n:
                ahead += 1
                if ahead in self.runs and size + ahead in self.runs:
                    size, ahead = size + ahead, 0
                elif ahead not in self.runs:
                    break
            out.append(self.runs[size])
            n -= size
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and the number of each text's."""
        split = Split(self.vocab, texts)
        if not len(split.keys):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        at = np.searchsorted(self.keys, split.keys)
        seen = np.zeros(len(split.keys), bool)
        inside = at < len(self.keys)
        seen[inside] = self.keys[at[inside]] == split.keys[inside]
        new = np.flatnonzero(~seen)
        begin, size, flat = self._units(Units(self.vocab, split, new))
        keys, order = merged(self.keys, split.keys[new])
        begin = np.concatenate((self.begin, begin + len(self.flat)))[order]
        size, flat = np.concatenate((self.size, size))[order], np.concatenate((self.flat, flat))
        if len(keys) <= KEPT:
            self.keys, self.begin, self.size, self.flat = keys, begin, size, flat
        which = np.searchsorted(keys, split.keys)[split.of]
        each, begin = size[which], begin[which]
        stop = np.cumsum(each)
        gathered = flat[np.repeat(begin - (stop - each), each) + np.arange(int(stop[-1]))]
        edges = np.concatenate(([0], stop))[np.concatenate(([0], np.cumsum(split.per_text)))]
        return gathered, np.diff(edges)

    def _units(self, u: Units) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of each unit: where they begin in the flat ids, their number, and the flat ids."""
        v = self.vocab
        # The prefix table: the last piece of the encoding of core[:p].
        last = np.full(len(u.flat) + 1, -1, np.int64)
        # unit ends coincide with the next unit's start, so the table is kept at end - 1
        for place, past, piece in u.by_end(v):
            at_start = place == u.core[u.unit_at[place]]
            before = np.where(at_start, 0, last[place - 1])
            ok = self.valid[piece] & (at_start | (before >= 0))
            inner = np.flatnonzero(ok & ~at_start)
            ok[inner] = self.merger.all_fit(before[inner], piece[inner])
            last[past[ok] - 1] = piece[ok]
        # Backwards from each unit's end.
        n_units = len(u.first)
        at, who = u.end - 1, np.flatnonzero(u.is_known & ~u.only_marks)
        at = at[who]
        steps: list[tuple[np.ndarray, np.ndarray]] = []
        while len(who):
            piece = last[at]
            if (piece < 0).any():
                raise ValueError("a unit without an encoding")
            steps.append((who, piece))
            at = at - v.lengths[piece]
            more = at >= u.core[who]
            at, who = at[more], who[more]
        counts = np.zeros(n_units, np.int64)
        for who, _ in steps:
            counts[who] += 1
        # Marks before the core, and units of marks or of a character that the vocabulary lacks.
        first_piece = np.full(n_units, -1, np.int64)
        for who, piece in steps:
            first_piece[who] = piece
        bare = first_piece == v.mark_id
        spare = np.where(u.only_marks, u.marks, np.where(bare, u.marks, np.maximum(u.marks - 1, 0)))
        heads: dict[int, list[int]] = {int(k): self.run_ids(int(k)) for k in np.unique(spare[spare > 0])}
        byte_units = np.flatnonzero(~u.is_known)
        raw = {int(k): v.byte_ids[np.frombuffer(chr(int(u.flat[u.first[k]])).encode("utf-8", "replace"), np.uint8)] for k in byte_units.tolist()}
        head = np.zeros(n_units, np.int64)
        for k, ids in heads.items():
            head[spare == k] = len(ids)
        for k, ids in raw.items():
            head[k] = len(ids)
        body = counts - bare
        total = head + body
        stop = np.cumsum(total)
        flat = np.zeros(int(stop[-1]) if n_units else 0, np.int32)
        for k, (who, piece) in enumerate(steps):
            keep = k < body[who]
            flat[stop[who[keep]] - 1 - k] = piece[keep]
        begin = stop - total
        for k, ids in heads.items():
            where = begin[spare == k]
            for j, i in enumerate(ids):
                flat[where + j] = i
        for k, ids in raw.items():
            flat[begin[k] : begin[k] + len(ids)] = ids
        return begin, total, flat


def decode(vocab: Vocabulary, ids: np.ndarray) -> bytes:
    """The text of ids as UTF-8: one leading space of the first piece goes, broken byte sequences are replaced."""
    said = b"".join(vocab.surfaces[ids].tolist())
    if len(ids) and vocab.pieces[ids[0]].startswith(MARK):
        said = said[1:]
    return said if said.isascii() else said.decode("utf-8", "replace").encode()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of every whole text, without begin or end ids. A null text is empty and has no ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in ta.chunks(batches, "text", CHUNK):
            flat, counts = encoder(model_path).encode([t.decode() for t in texts])
            yield pa.RecordBatch.from_arrays([batch.column(0), ta.ragged(flat, counts, pa.int32())], ["id", "ids"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return arrow_map(rows, run, f"id {rows.schema['id'].dataType.simpleString()}, ids array<int>")


def decoded(encoded: DataFrame, model_path: str) -> DataFrame:
    """(id, text) of (id, ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model_path)
        for batch in batches:
            said = [decode(v, np.array(x or [], np.int64)).decode() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(said, pa.string())], ["id", "text"])

    rows = encoded.select("id", "ids")
    return arrow_map(rows, run, f"id {rows.schema['id'].dataType.simpleString()}, text string")


def round_trip(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): encoding and decoding in one pass, only digests leave the workers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model_path)
        decimal = np.array([str(i).encode() for i in range(len(enc.vocab.pieces))], object)
        for batch, texts in ta.chunks(batches, "text", CHUNK):
            flat, counts = enc.encode([t.decode() for t in texts])
            edges = np.concatenate(([0], np.cumsum(counts))).tolist()
            marks: tuple[list[str], list[str]] = ([], [])
            for a, b in zip(edges, edges[1:], strict=False):
                ids = flat[a:b]
                marks[0].append(hashlib.sha256(b",".join(decimal[ids].tolist())).hexdigest())
                marks[1].append(hashlib.sha256(decode(enc.vocab, ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), *map(pa.array, marks)], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return arrow_map(rows, run, f"id {rows.schema['id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def model_file() -> str:
    """The public model; its folder is a parameter of every function here."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def query(spark, sf_dir: str) -> DataFrame:
    """op8: digests of every document's ids and of their decoding."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return round_trip(docs, model_file()).withColumnRenamed("id", "doc_id")
