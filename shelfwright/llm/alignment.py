"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes of a text, and how often over a corpus.

Both encodings of a text cover the same bytes, so their token ends cut it into elementary intervals: the union of both
end arrays. Each interval lies in one token of either side (binary search in its end array), and each overlapping pair
of tokens holds just one interval: intervals are the links. Ends that both sides share close the groups; the product of a
group's two sides expands to all its pairs.

Texts never move. A slice of texts (1 MB, or one longer text) is aligned in its task, which writes the documents' links
against the slice's own list of distinct id pairs. Only those lists are shuffled by pair for the counts over the corpus,
and looked up again by slice; what a task holds is a slice's links and pairs.

Null and empty texts have no tokens: counts of 0, no groups. The same holds for texts that one side does not give back
byte by byte (the piece vocabulary's space mark within a text). Texts are taken whole. Repeated rows are rows like
others and add to the counts; ids may be of any type, null, or repeat. An empty table gives no row; other columns are not
looked at.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from sentencepiece import SentencePieceProcessor

from shelfwright.llm import textarrays as ta
from shelfwright.llm.piece_bpe import encoder, model_file
from shelfwright.session import arrow_map, ship, stored

#: Bytes of text that are aligned at a time, and pairs in a row of a slice's list.
SLICE = 1 << 20
LISTED = 1 << 15


class ByteBPE:
    """A byte-level BPE vocabulary file of the tokenizers library, encoded by tiktoken with the entries' ids as ranks.

    The ids of the file's entries follow its merges, so ranks say the same; both libraries agree on every code point in
    words, numbers and spaces (tried), and tiktoken takes a fifth of the time.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as f:
            entries = json.load(f)["model"]["vocab"]
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        byte_of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(shown))}
        ranks = {bytes(byte_of[c] for c in entry): i for entry, i in entries.items()}
        self.coder = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.surfaces = np.full(max(ranks.values()) + 1, b"", object)
        for said, i in ranks.items():
            self.surfaces[i] = said
        self.sizes = np.array([len(x) for x in self.surfaces])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and their number in each; strings of special tokens are plain text."""
        each = [self.coder.encode_to_numpy(t, disallowed_special=()) for t in texts]
        return np.concatenate([np.zeros(0, np.uint32), *each]).astype(np.int64), np.fromiter(map(len, each), np.int64, len(each))


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBPE:
    return ByteBPE(path)


@lru_cache(maxsize=4)
def _decimal(n: int, behind: bytes) -> np.ndarray:
    """Every number below n as bytes, with what stands behind it."""
    return np.array([b"%d" % i + behind for i in range(n)], object)


class Side:
    """The tokens of a slice's texts by one vocabulary: its entries' bytes and their lengths, ids one text after the other, ids in each text."""

    def __init__(self, surfaces: np.ndarray, sizes: np.ndarray, ids: np.ndarray, counts: np.ndarray):
        self.surfaces, self.sizes, self.ids, self.counts = surfaces, sizes, ids, counts
        self.ends = np.cumsum(sizes[ids])

    def spoken(self, said: list[bytes]) -> np.ndarray:
        """Whether the tokens of each text join to its bytes."""
        own = self.surfaces[self.ids].tolist()
        if b"".join(own) == b"".join(said):
            edges = np.concatenate(([0], self.ends))[np.concatenate(([0], np.cumsum(self.counts)))]
            return np.diff(edges) == np.fromiter(map(len, said), np.int64, len(said))
        stops = np.cumsum(self.counts)
        return np.array([b"".join(own[e - n : e]) == t for e, n, t in zip(stops.tolist(), self.counts.tolist(), said, strict=True)], bool)

    def only(self, keep: np.ndarray) -> Side:
        return self if keep.all() else Side(self.surfaces, self.sizes, self.ids[np.repeat(keep, self.counts)], np.where(keep, self.counts, 0))


@lru_cache(maxsize=2)
def _piece_sizes(path: str) -> np.ndarray:
    return np.array([len(x) for x in encoder(path).vocab.surfaces])


class Slice:
    """The alignment of a slice of texts: elementary intervals, their owners, and the groups that shared ends close."""

    def __init__(self, a: Side, b: Side):
        ends_a, ends_b = a.ends, b.ends
        self.a, self.b = a, b
        both = np.sort(np.concatenate((ends_a, ends_b)), kind="stable")  # union1d, by a merge as both are sorted
        self.ends = both[np.diff(both, prepend=0) > 0]
        self.of_a, self.of_b = np.searchsorted(ends_a, self.ends), np.searchsorted(ends_b, self.ends)
        shared = np.flatnonzero((ends_a[self.of_a] == self.ends) & (ends_b[self.of_b] == self.ends)) if len(self.ends) else np.zeros(0, np.int64)
        self.close_a, self.close_b = self.of_a[shared] + 1, self.of_b[shared] + 1
        #: By text: where its tokens, links and groups begin in those of the slice.
        self.first_a, self.first_b = (np.concatenate(([0], np.cumsum(s.counts))) for s in (a, b))
        bytes_before = np.concatenate(([0], ends_a))[self.first_a]
        self.first_link = np.searchsorted(self.ends, bytes_before, "right")
        self.first_group = np.searchsorted(self.ends[shared], bytes_before, "right")

    def group_sizes(self) -> tuple[np.ndarray, np.ndarray]:
        return np.diff(self.close_a, prepend=0), np.diff(self.close_b, prepend=0)

    def pairs(self) -> np.ndarray:
        """The id pair of each link as one number."""
        return self.a.ids[self.of_a] * len(self.b.surfaces) + self.b.ids[self.of_b]

    def texts_of_links(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first_link) - 1), np.diff(self.first_link))

    def written(self) -> list[bytes]:
        """For each text its groups as a1,a2|b1;a3|b2,b3."""
        m, n = self.group_sizes()
        g = np.arange(len(m))
        in_a, in_b = np.repeat(g, m), np.repeat(g, n)
        said = np.empty(len(in_a) + len(in_b), object)
        last_a, last_b = np.zeros(len(in_a), bool), np.zeros(len(in_b), bool)
        last_a[self.close_a - 1], last_b[self.close_b - 1] = True, True
        at_a, at_b = np.arange(len(in_a)) + (self.close_b - n)[in_a], np.arange(len(in_b)) + self.close_a[in_b]
        for at, side, last, behind in ((at_a, self.a, last_a, b"|"), (at_b, self.b, last_b, b";")):
            said[at] = _decimal(len(side.surfaces), b",")[side.ids]
            said[at[last]] = _decimal(len(side.surfaces), behind)[side.ids[last]]
        edges = (self.first_a + self.first_b).tolist()
        return [b"".join(said[lo:hi].tolist())[:-1] for lo, hi in zip(edges, edges[1:], strict=False)]


def align(texts: list[bytes], a_path: str, b_path: str) -> Slice:
    """The alignment of texts (UTF-8), each behind one space: by a byte-level BPE file, and by a piece model that adds the space itself."""
    left, right = byte_bpe(a_path), encoder(b_path)
    plain = [t.decode() for t in texts]
    a = Side(left.surfaces, left.sizes, *left.encode([" " + t if t else "" for t in plain]))
    ids, counts = right.encode(plain)
    b = Side(right.vocab.surfaces, _piece_sizes(b_path), ids.astype(np.int64), counts)
    said = [b" " + t if t else b"" for t in texts]
    ok = a.spoken(said) & b.spoken(said)
    return Slice(a.only(ok), b.only(ok))


def byte_file() -> str:
    """The public byte-level vocabulary; its folder is a parameter of every function here."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def aligned(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, a, b, link_a, link_b, end, close_a, close_b) of every text: both sides' token ids, each link's places in them (from 0)
    and the byte, counted from the space, where it ends; the number of tokens of either side up to the end of each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in ta.chunks(batches, "text", SLICE):
            x = align(texts, a_path, b_path)
            links, groups = np.diff(x.first_link), np.diff(x.first_group)
            before = np.concatenate(([0], x.a.ends))[x.first_a[:-1]]
            lists = [(x.a.ids, x.a.counts), (x.b.ids, x.b.counts)]
            lists += [(x.of_a - np.repeat(x.first_a[:-1], links), links), (x.of_b - np.repeat(x.first_b[:-1], links), links), (x.ends - np.repeat(before, links), links)]
            lists += [(x.close_a - np.repeat(x.first_a[:-1], groups), groups), (x.close_b - np.repeat(x.first_b[:-1], groups), groups)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(ta.ragged(v, n, pa.int64()) for v, n in lists)], ["id", *names])

    names = ["a", "b", "link_a", "link_b", "end", "close_a", "close_b"]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return arrow_map(rows, run, f"id {rows.schema['id'].dataType.simpleString()}, " + ", ".join(f"{n} array<long>" for n in names))


def expanded(found: DataFrame) -> DataFrame:
    """(id, grp, a, b): of aligned(), the product of each group's two sides, as id pairs."""
    groups = found.select("id", "a", "b", F.posexplode(F.arrays_zip("close_a", "close_b")).alias("grp", "to"), "close_a", "close_b")
    part = lambda s: F.slice(F.col(s), F.coalesce(F.get(f"close_{s}", F.col("grp") - 1), F.lit(0)).cast("int") + 1, (F.col(f"to.close_{s}") - F.coalesce(F.get(f"close_{s}", F.col("grp") - 1), F.lit(0))).cast("int"))
    sides = groups.select("id", "grp", part("a").alias("a"), part("b").alias("b"))
    return sides.select("id", "grp", F.explode("a").alias("a"), "b").select("id", "grp", "a", F.explode("b").alias("b"))


def _sliced(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Rows of documents (place from 0 within their slice) with their links as places in the slice's list of pairs, and rows of that list."""
    kind = docs.schema["id"].dataType.simpleString()
    schema = f"part long, place int, id {kind}, n_a long, n_b long, n_groups long, n_links long, n_products long, groups_sha256 string, codes array<int>, times array<int>, first int, pairs array<long>, counts array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = count(TaskContext.get().partitionId() << 32)
        for batch, texts in ta.chunks(batches, "text", SLICE):
            part, n = next(number), len(texts)
            x = align(texts, a_path, b_path)
            pairs, code, counts = np.unique(x.pairs(), return_inverse=True, return_counts=True)
            own, times = np.unique(x.texts_of_links() * max(1, len(pairs)) + code, return_counts=True)
            owner, code = np.divmod(own, max(1, len(pairs)))
            links, (m, k) = np.diff(x.first_link), x.group_sizes()
            products = np.diff(np.concatenate(([0], np.cumsum(m * k)))[x.first_group])
            marks = [hashlib.sha256(s).hexdigest() if s else "" for s in x.written()]
            per_text = np.bincount(owner, minlength=n)
            longs = [x.a.counts, x.b.counts, np.diff(x.first_group), links, products]
            none = [pa.nulls(n, t) for t in (pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()))]
            rows = [pa.array(np.full(n, part)), pa.array(np.arange(n, dtype=np.int32)), batch.column(0), *(pa.array(v, pa.int64()) for v in longs), pa.array(marks, pa.string())]
            yield pa.RecordBatch.from_arrays([*rows, ta.ragged(code, per_text, pa.int32()), ta.ragged(times, per_text, pa.int32()), *none], names)
            for first in range(0, len(pairs), LISTED):
                size = np.array([min(LISTED, len(pairs) - first)])
                empty = [pa.nulls(1, t) for t in (pa.int32(), batch.column(0).type, *[pa.int64()] * 5, pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()))]
                listed = [pa.array([first], pa.int32()), *(ta.ragged(v[first : first + LISTED], size, pa.int64()) for v in (pairs, counts))]
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), *empty, *listed], names)

    names = [c.strip().split(" ")[0] for c in "part,place,id,n_a,n_b,n_groups,n_links,n_products,groups_sha256,codes,times,first,pairs,counts".split(",")]
    return arrow_map(docs, run, schema)


def alignment(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, n_products) of every text.

    The count of an id pair is the number of its links in the corpus; n_best are links whose pair has the highest count
    of its B id, ties included; count_sum adds the counts of a text's links; n_products is the size of its groups' products.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    known = stored(_sliced(rows, a_path, b_path), "links")
    listed = known.where("pairs is not null").select("part", "first", F.posexplode(F.arrays_zip("pairs", "counts")).alias("at", "x"))
    listed = listed.select("part", (F.col("first") + F.col("at")).alias("code"), F.col("x.pairs").alias("pair"), F.col("x.counts").alias("n"))
    totals = stored(listed.groupBy("pair").agg(F.sum("n").alias("total")), "totals")
    b_ids = SentencePieceProcessor(model_file=b_path).vocab_size()
    # One row for each id of the second vocabulary at most: a bound that no corpus moves.
    most = totals.groupBy((F.col("pair") % b_ids).alias("b")).agg(F.max("total").alias("most"))
    totals = totals.withColumn("b", F.col("pair") % b_ids).join(F.broadcast(most), "b").select("pair", (F.col("total") * 2 + (F.col("total") == F.col("most")).cast("long")).alias("worth"))
    worth = listed.join(totals, "pair").select(F.col("part").alias("of_part"), "code", "worth")
    texts = known.where("place is not null").drop("first", "pairs", "counts")
    names = ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_products"]
    schema = texts.withColumns({"n_best": F.lit(0).cast("long"), "count_sum": F.lit(0).cast("long")}).select(*names).schema

    def meet(own: pa.Table, found: pa.Table) -> pa.Table:
        value = np.zeros(found.num_rows, np.int64)
        value[found["code"].to_numpy()] = found["worth"].to_numpy()
        codes, times = (own[c].combine_chunks() for c in ("codes", "times"))
        edges = codes.offsets.to_numpy()
        got, times = value[codes.values.to_numpy()], times.values.to_numpy().astype(np.int64)
        sums = {"count_sum": (got >> 1) * times, "n_best": (got & 1) * times}
        for name, each in sums.items():
            own = own.append_column(name, pa.array(np.diff(np.concatenate(([0], np.cumsum(each)))[edges])))
        return own.select(names)

    ship(docs.sparkSession)
    return texts.groupBy("part").cogroup(worth.groupBy("of_part")).applyInArrow(meet, schema)


def query(spark, sf_dir: str) -> DataFrame:
    """op13: every document aligned by both public vocabularies."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return alignment(docs, byte_file(), model_file()).withColumnRenamed("id", "doc_id")
