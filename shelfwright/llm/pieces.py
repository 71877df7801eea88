"""Texts as units of a public piece vocabulary, in numpy: unit splitting, a trie automaton, and all matches by end.

A unit is a run of the space mark with the word behind it, or one character that the vocabulary lacks. No piece holds a
mark behind another character, so no piece crosses units; each distinct unit of a batch is worked on once.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

from shelfwright.llm import textarrays as ta

#: The space mark of the vocabulary.
MARK = "▁"
_GOLD = np.uint64(0x9E3779B97F4A7C15)


class Table:
    """64-bit keys to small integers; many look-ups at once, open addressing."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(len(keys) * 3).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, -1, np.int32)
        todo = np.arange(len(keys))
        slot = self._slot(keys)
        while len(todo):
            free = self.keys[slot[todo]] == -1
            first = todo[free]
            self.keys[slot[first]] = keys[first]  # of several claims of a slot one stays
            won = first[self.keys[slot[first]] == keys[first]]
            self.values[slot[won]] = values[won]
            lost = np.ones(len(keys), bool)
            lost[won] = False
            todo = todo[lost[todo]]
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _GOLD) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Values, or -1 where a key is absent."""
        slot = self._slot(keys)
        out = np.full(len(keys), -1, np.int32)
        todo = np.arange(len(keys))
        while len(todo):
            there = self.keys[slot[todo]]
            hit = there == keys[todo]
            out[todo[hit]] = self.values[slot[todo[hit]]]
            todo = todo[~hit & (there != -1)]
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
        return out


class Vocabulary:
    """Pieces of a sentencepiece model file: ids, scores, bytes and the trie of their characters."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        self.scores = [model.get_score(i) for i in range(n)]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in range(n)]
        self.byte_ids = np.zeros(256, np.int32)
        for i in range(n):
            if model.is_byte(i):
                self.byte_ids[int(self.pieces[i][3:5], 16)] = i
        self.ids = {p: i for i, p in enumerate(self.pieces) if not special[i]}
        self.mark_id = self.ids[MARK]
        self.lengths = np.array([len(p) for p in self.pieces], np.int64)
        #: What a decoder writes for each id: control pieces nothing, byte pieces their byte.
        self.surfaces = np.array(
            [bytes([int(p[3:5], 16)]) if model.is_byte(i) else b"" if model.is_control(i) else " ⁇ ".encode() if model.is_unknown(i) else p.replace(MARK, " ").encode() for i, p in enumerate(self.pieces)],
            object,
        )
        self.known = np.zeros(0x110000, bool)
        self.known[[ord(p) for p in self.ids if len(p) == 1]] = True
        self._trie()

    def _trie(self) -> None:
        """Nodes by prefix; runs of marks are left out, as no unit's word holds two."""
        nodes, edges, ends = {"": 0}, [], [(0, -1)]
        for p, i in self.ids.items():
            if p.startswith(MARK * 2):
                continue
            at = 0
            for k in range(1, len(p) + 1):
                if p[:k] not in nodes:
                    nodes[p[:k]] = len(nodes)
                    edges.append((at << 21 | ord(p[k - 1]), nodes[p[:k]]))
                at = nodes[p[:k]]
            ends.append((at, i))
        keys = np.array(edges, np.int64)
        self.step = Table(keys[:, 0], keys[:, 1].astype(np.int32))
        self.piece_at = np.full(len(nodes), -1, np.int32)
        found = np.array(ends, np.int64)
        self.piece_at[found[:, 0]] = found[:, 1]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Split:
    """The units of some texts: keys, the hash of each distinct one in order; of, for each unit of the texts, which
    distinct one; per_text, units of each text."""

    def __init__(self, vocab: Vocabulary, texts: list[str]):
        said = [MARK + t if t else "" for t in texts]
        size = np.fromiter(map(len, said), np.int64, len(said))
        points = np.frombuffer("".join(said).encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
        points[points == 32] = ord(MARK)
        begin = np.cumsum(size) - size
        known, mark = vocab.known[points], points == ord(MARK)
        starts = np.empty(len(points), bool)
        starts[:1] = True
        starts[1:] = (mark[1:] & ~mark[:-1]) | ~known[1:] | ~known[:-1]
        starts[begin[size > 0]] = True
        start = np.flatnonzero(starts)
        stop = np.append(start[1:], len(points)) if len(start) else start
        self.per_text = np.diff(np.searchsorted(start, np.append(begin, len(points))))
        sums = np.zeros(len(points) + 1, np.uint64)
        np.cumsum(ta.mix(points.view(np.uint64)) * ta.powers(ta._BASE, len(points)), dtype=np.uint64, out=sums[1:])
        self.keys, some, self.of = np.unique(ta.span_hash(sums, start, stop), return_index=True, return_inverse=True)
        self.points, self.start, self.length = points, start[some], (stop - start)[some]

    def units(self) -> list[str]:
        """The distinct units as text."""
        return [self.points[a : a + n].astype(np.uint32).tobytes().decode("utf-32-le") for a, n in zip(self.start.tolist(), self.length.tolist(), strict=True)]

    @classmethod
    def of_units(cls, units: list[str]) -> Split:
        """Units that a split gave, each as it was: none is cut or marked anew."""
        out = cls.__new__(cls)
        out.length = np.fromiter(map(len, units), np.int64, len(units))
        out.start = np.cumsum(out.length) - out.length
        out.points = np.frombuffer("".join(units).encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
        return out


class Units:
    """Distinct units laid out for matching.

    flat: their characters as code points; first, end: each unit's part of flat; marks: its leading marks; core: where
    its last mark stands, or its first character without one.
    """

    def __init__(self, vocab: Vocabulary, split: Split, which: np.ndarray):
        length, start = split.length[which], split.start[which]
        self.end = np.cumsum(length)
        self.first = self.end - length
        self.flat = split.points[np.repeat(start - self.first, length) + np.arange(int(length.sum()))]
        word = np.append(np.flatnonzero(self.flat != ord(MARK)), len(self.flat))
        self.marks = np.minimum(word[np.searchsorted(word, self.first)], self.end) - self.first
        self.core = self.first + np.maximum(self.marks - 1, 0)
        self.unit_at = np.repeat(np.arange(len(self.first)), length)
        self.is_known = vocab.known[self.flat[self.first]] if len(self.flat) else np.zeros(0, bool)
        self.only_marks = self.first + self.marks == self.end

    def matches(self, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Every match of a piece inside a unit's core: place, length, piece id."""
        wanted = self.is_known & ~self.only_marks
        at = np.flatnonzero(wanted[self.unit_at] & (np.arange(len(self.flat)) >= self.core[self.unit_at])) if len(self.flat) else np.zeros(0, np.int64)
        stop = self.end[self.unit_at[at]] if len(at) else at
        node = np.zeros(len(at), np.int64)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        length = 0
        while len(at):
            node = vocab.step.get(node << 21 | self.flat[at + length]).astype(np.int64)
            length += 1
            alive = node >= 0
            at, stop, node = at[alive], stop[alive], node[alive]
            piece = vocab.piece_at[node]
            hit = piece >= 0
            found.append((at[hit], np.full(int(hit.sum()), length, np.int64), piece[hit].astype(np.int64)))
            more = at + length < stop
            at, stop, node = at[more], stop[more], node[more]
        if not found:
            return (np.zeros(0, np.int64),) * 3
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def by_end(self, vocab: Vocabulary) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The matches (place, place behind, piece), one step for each distance of their end from the core's start."""
        place, length, piece = self.matches(vocab)
        step = place + length - self.core[self.unit_at[place]]
        order = np.argsort(step.astype(np.uint16) if len(step) and step.max() < 1 << 16 else step, kind="stable")
        place, past, piece, step = place[order], (place + length)[order], piece[order], step[order]
        cuts = np.flatnonzero(np.diff(step)) + 1
        for a, b in zip(np.concatenate(([0], cuts)).tolist(), np.append(cuts, len(step)).tolist(), strict=True):
            if b > a:
                yield place[a:b], past[a:b], piece[a:b]


def merged(old: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two runs of keys as one in order, and for each place which of old, then new, stands there."""
    both = np.concatenate((old, new))
    order = np.argsort(both, kind="stable")
    return both[order], order
