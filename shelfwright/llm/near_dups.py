"""Near-duplicate documents: bottom-k sketches from one hash function, inverted lists, exact verification.

Sets are distinct shingles of lower-cased (A-Z) words. Equal sets are one class from the start, whatever their number.
Of each class one sketch is kept: the k least values of one hash over the set. Two sets that reach the wanted
similarity share at least `shared(n)` of these values, so, with values ordered from rare to common, they share one
among the first `size - shared + 1`: only those go to the inverted lists. Each list links its members to its least
member first; what is not yet connected is then paired across components, so a list of thousands of copies costs its
length and not its square; a document with too few shingles that others hold is in no pair. Candidates are estimated on the sketch of the union and confirmed on whole sets.

A loss is possible only where a pair at the threshold shares fewer than half of 64 values (about 1 pair in a million).
With k as large as the largest set, sketches are whole sets, the prefix rule is exact and no pair can be lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwright.llm import textarrays as ta
from shelfwright.llm.components import components
from shelfwright.llm.ordering import whole_numbers
from shelfwright.session import arrow_map, settled, stored

#: Values kept of each set.
K = 64
#: Lists up to this length are joined pair by pair; members of longer ones meet in blocks of so many rows.
SHORT_LIST, BLOCK = 32, 512


def _sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, first, end = ta.packed(texts)
    start, stop = ta.words(data)
    sums = ta.prefix_hash(ta.LOWER[data])
    each = ta.span_hash(sums, start, stop)
    begin, past = np.searchsorted(start, first), np.searchsorted(start, end)
    weights = ta.powers(0xD1342543DE82EF95, n)
    rolled = np.zeros(max(0, len(each) - n + 1), ta.U64)
    for j in range(n):
        rolled += each[j : j + len(rolled)] * weights[j]
    rolled = ta.mix(rolled).view(np.int64)
    out = []
    for b, p in zip(begin.tolist(), past.tolist(), strict=True):
        if p - b >= n:
            out.append(np.unique(rolled[b : p - n + 1]))
        elif p > b:  # the whole sequence as one
            out.append(ta.mix(np.sum(each[b:p] * weights[: p - b], dtype=ta.U64, keepdims=True) + ta.U64(p - b)).view(np.int64))
        else:
            out.append(np.empty(0, np.int64))
    return out


def shingle_sketches(docs: DataFrame, id_col: str, text_col: str, n: int = 5, k: int = K) -> DataFrame:
    """(id, n_shingles, s1, s2, sketch): set size, a 128-bit mark of the set, its k least hashes in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in ta.chunks(batches, "text"):
            sets = _sets(texts, n)
            sizes = np.fromiter(map(len, sets), np.int64, len(sets))
            flat = np.concatenate(sets).view(ta.U64)
            marks = []
            for salt in (0x632BE59BD9B4E019, 0x1B873593CC9E2D51):
                sums = np.zeros(len(flat) + 1, ta.U64)
                np.cumsum(ta.mix(flat + ta.U64(salt)), dtype=ta.U64, out=sums[1:])
                at = np.concatenate(([0], np.cumsum(sizes)))
                marks.append(pa.array((sums[at[1:]] - sums[at[:-1]]).view(np.int64)))
            heads = [s[:k] for s in sets]
            sketch = ta.ragged(np.concatenate(heads), np.minimum(sizes, k), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes), *marks, sketch], ["id", "n_shingles", "s1", "s2", "sketch"])

    rows = docs.select(whole_numbers(docs, id_col).alias("id"), F.col(text_col).alias("text"))
    return arrow_map(rows, run, "id long, n_shingles long, s1 long, s2 long, sketch array<long>")


def shingle_sets(docs: DataFrame, n: int = 5) -> DataFrame:
    """(id, shingles) of docs (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in ta.chunks(batches, "text"):
            sets = _sets(texts, n)
            column = ta.ragged(np.concatenate(sets), np.fromiter(map(len, sets), np.int64, len(sets)), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), column], ["id", "shingles"])

    return arrow_map(docs.select("id", "text"), run, "id long, shingles array<long>")


def _shared(size: Column, k: int, per_cent: int) -> Column:
    """Sketch values that a set of this size shares at least with any set that is similar enough."""
    return F.least(F.lit(k // 2), F.ceil(size * per_cent / 100)).cast("int")


def _listed(sketches: DataFrame, k: int, per_cent: int) -> DataFrame:
    """(value, id): the inverted lists of each set's rarest retained values."""
    retained = sketches.select("id", "n_shingles", F.explode("sketch").alias("value"))
    common = retained.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    met = retained.join(common, "value")
    by_id = Window.partitionBy("id")
    return (
        met.withColumn("have", F.count("*").over(by_id))
        .withColumn("place", F.row_number().over(by_id.orderBy("df", "value")))
        .where(F.col("place") <= F.col("have") - _shared(F.col("n_shingles"), k, per_cent) + 1)
        .select("value", "id", "n_shingles")
    )


def _confirmed(pairs: DataFrame, sets: DataFrame, k: int, per_cent: int) -> DataFrame:
    """The pairs (a, b) whose estimate on the union's sketch, then whose whole sets, are similar enough."""
    near = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("xa")), "a")
    near = near.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("xb")), "b")
    sa, sb = F.slice("xa", 1, k), F.slice("xb", 1, k)  # sets are in order of hash
    union = F.slice(F.array_sort(F.array_union(sa, sb)), 1, k)
    share, whole = F.size(F.array_intersect(F.array_intersect(sa, sb), union)), (F.size("xa") < k) & (F.size("xb") < k)
    # Sketches below k values are whole sets and the estimate is exact; others may err by a third.
    near = near.where(whole | (share * 100 * 3 >= F.size(union) * per_cent * 2))
    inter = F.size(F.array_intersect("xa", "xb"))
    return near.where(100 * inter >= per_cent * (F.size("xa") + F.size("xb") - inter)).select("a", "b")


def _mixed(rows: DataFrame) -> DataFrame:
    """Rows (value, id, c, ..) of lists with several components, with the list's length m and its largest component."""
    counts = rows.groupBy("value", "c").agg(F.count("*").alias("k"))
    lists = counts.groupBy("value").agg(F.sum("k").alias("m"), F.max(F.struct("k", "c")).alias("top"), F.count("*").alias("kinds")).where("kinds > 1")
    # Stored, so that few shapes meet their lists where these are, and many by a join that splits hot values.
    return rows.join(stored(lists.select("value", "m", F.col("top.c").alias("main")), "shape"), "value")


def _shareable(rows: DataFrame, sets: DataFrame, per_cent: int) -> DataFrame:
    """Rows of documents that can still be similar to another one of the lists, with their count of shareable shingles.

    Only a shingle that two documents of these lists hold can be common to a pair. A copy whose edits made too many
    shingles of its own is left out here, before any pair is made; the bound is on whole sets and loses no link.
    """
    ids = rows.select("id").distinct()
    each = sets.join(ids, "id", "left_semi").select("id", F.explode("shingles").alias("x"))
    held = each.groupBy("x").agg(F.count("*").alias("df")).where("df > 1").select("x")
    counts = each.join(held, "x").groupBy("id").agg(F.count("*").alias("shareable"))
    return rows.join(counts, "id").where(100 * F.col("shareable") >= per_cent * F.col("n_shingles"))


def _can_link(n1: str, h1: str, n2: str, h2: str, per_cent: int) -> Column:
    """Whether sets of n1 and n2 shingles, h1 and h2 of them shareable, can be similar enough."""
    most = F.least(h1, h2, n1, n2)
    return 100 * most >= per_cent * (F.col(n1) + F.col(n2) - most)


def _shape(members: DataFrame, *group: str) -> DataFrame:
    """Of each group of (.., id, c): its rows m, its largest component main, and its rows outside that."""
    counts = members.groupBy(*group, "c").agg(F.count("*").alias("n"))
    shape = counts.groupBy(*group).agg(F.max(F.struct("n", "c")).alias("top"), F.sum("n").alias("m"))
    return shape.select(*group, "m", F.col("top.c").alias("main"), (F.col("m") - F.col("top.n")).alias("out"))


def _in_blocks(long: DataFrame, sets: DataFrame, per_cent: int) -> DataFrame:
    """Links (a, b) across components in the long lists (value, id, c, ..), found block against block.

    Lists that share members are one family, unless the family holds more pairs than its lists one by one: a chain of
    many lists stays apart. In each such group the members outside the largest component meet all members in blocks of
    BLOCK rows; whole sets are compared as bits inside a task, and only links leave it, one for each two components.
    """
    # Stored for the same reason as the shapes in _mixed.
    heads = stored(long.groupBy("value").agg(F.min("id").alias("a")), "heads")
    ties = long.select("value", F.col("id").alias("b")).join(heads, "value").select("a", "b")
    families = stored(components(ties), "family").withColumnRenamed("component", "family")
    rows = stored(long.select("value", "id", "c").join(families, "id"), "chained")
    inside = rows.select("family", "id", "c").distinct()
    families = _shape(inside, "family")
    by_list = _shape(rows.select("value", "id", "c"), "value").join(rows.select("value", "family").distinct(), "value")
    by_list = by_list.groupBy("family").agg(F.sum(F.col("m").cast("double") * F.col("out")).alias("apart"))
    split = families.join(by_list, "family").where(F.col("m").cast("double") * F.col("out") > F.col("apart")).select("family")
    whole = inside.join(split, "family", "left_anti").select(F.lit(False).alias("one"), F.col("family").alias("g"), "id", "c")
    apart = rows.join(split, "family", "left_semi").select(F.lit(True).alias("one"), F.col("value").alias("g"), "id", "c").distinct()
    members = stored(whole.unionByName(apart), "grouped")
    shape = _shape(members, "one", "g").where("out > 0")
    shape = shape.select("one", "g", F.col("main"), F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks"), F.ceil(F.col("out") / BLOCK).cast("int").alias("left_blocks"))
    members = members.join(shape, ["one", "g"]).join(sets, "id")
    place = lambda salt, n: F.pmod(F.xxhash64(F.lit(salt), "id"), F.col(n)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("left_blocks") - 1))
    right = members.select("one", "g", every.alias("x"), place(1, "blocks").alias("y"), F.lit(False).alias("query"), "id", "c", "shingles")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    left = members.where("c <> main").select("one", "g", place(2, "left_blocks").alias("x"), every.alias("y"), F.lit(True).alias("query"), "id", "c", "shingles")

    def compare(table: pa.Table) -> pa.Table:
        query = table["query"].to_numpy()
        ids, labels = table["id"].to_numpy(), table["c"].to_numpy()
        lists = table["shingles"].combine_chunks()
        flat, sizes = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())
        owner = np.repeat(np.arange(len(ids)), sizes)
        _, column, times = np.unique(flat, return_inverse=True, return_counts=True)
        common = times > 1  # others cannot be shared
        width = np.cumsum(common) - 1
        keep = common[column]
        bits = np.zeros((len(ids), int(common.sum()) + 1), bool)
        bits[owner[keep], width[column[keep]]] = True
        bits = np.packbits(bits, axis=1)
        bits = np.pad(bits, ((0, 0), (0, -bits.shape[1] % 8))).view(np.uint64)
        asked, all_rows = np.flatnonzero(query), np.flatnonzero(~query)
        found: dict[tuple[int, int], tuple[int, int]] = {}
        for i in asked.tolist():
            inter = np.bitwise_count(bits[all_rows] & bits[i]).sum(axis=1, dtype=np.int64)
            hit = all_rows[(100 * inter >= per_cent * (sizes[all_rows] + sizes[i] - inter)) & (labels[all_rows] != labels[i])]
            for j in hit.tolist():
                found.setdefault((int(labels[i]), int(labels[j])), (int(ids[i]), int(ids[j])))
        pairs = list(found.values())
        return pa.table({"a": pa.array([x for x, _ in pairs], pa.int64()), "b": pa.array([y for _, y in pairs], pa.int64())})

    return left.unionByName(right).groupBy("one", "g", "x", "y").applyInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, per_cent: int = 75, k: int = K) -> DataFrame:
    """(id, n_shingles, component_id): one row per row of docs.

    component_id is the least id reachable over links of Jaccard similarity >= per_cent / 100, itself included.
    Null or empty texts (and texts without a word) have the empty set and link with nothing. Rows that repeat an id are
    one node with the links of all its rows. A null id gets a null component. Ids are whole numbers (else a TypeError).
    Other columns are not looked at. k: values kept of each set; from the size of the largest set on, all links are
    found for certain.
    """
    rows = docs.select(whole_numbers(docs, id_col).alias("id"), F.col(text_col).alias("text"))
    again = rows.where("id is not null").groupBy("id").agg(F.count("*").alias("n")).where("n > 1")
    found = _of_repeated_ids if again.limit(1).count() else _of_single_ids
    return settled(docs.sparkSession, lambda: found(rows, n, per_cent, k), "near-duplicates")


def _of_repeated_ids(rows: DataFrame, n: int, per_cent: int, k: int) -> DataFrame:
    """near_duplicates() of (id, text): each different text of an id is a node, and those of one id are tied."""
    mark = F.md5(F.coalesce("text", F.lit("")))
    nodes = rows.withColumn("mark", mark).groupBy("id", "mark").agg(F.first("text").alias("text"))
    nodes = stored(nodes.withColumn("key", F.monotonically_increasing_id()), "nodes")
    found = stored(_of_single_ids(nodes.select(F.col("key").alias("id"), "text"), n, per_cent, k), "found")
    named = nodes.select("key", "id", "mark").join(found.select(F.col("id").alias("key"), "n_shingles", F.col("component_id").alias("c")), "key")
    known = named.where("id is not null")
    ties = known.groupBy("id").agg(F.min("key").alias("b")).join(known.select("id", F.col("key").alias("a")), "id").select("a", "b")
    joined = components(known.select(F.col("key").alias("a"), F.col("c").alias("b")).unionByName(ties))
    whole = known.select("id", "mark", "n_shingles", "key").join(joined.select(F.col("id").alias("key"), "component"), "key", "left").withColumn("component", F.coalesce("component", "key"))
    least = whole.groupBy("component").agg(F.min("id").alias("component_id"))
    named = whole.join(least, "component").select(F.col("id").alias("i"), F.col("mark").alias("m"), "n_shingles", "component_id")
    named = named.unionByName(nodes.where("id is null").join(found.select(F.col("id").alias("key"), "n_shingles"), "key").select(F.col("id").alias("i"), F.col("mark").alias("m"), "n_shingles", F.lit(None).cast("long").alias("component_id")))
    marked = rows.select("id", mark.alias("mark"))
    return marked.join(named, F.col("id").eqNullSafe(F.col("i")) & (F.col("mark") == F.col("m"))).select("id", "n_shingles", "component_id")


def _of_single_ids(docs: DataFrame, n: int, per_cent: int, k: int) -> DataFrame:
    """near_duplicates() of (id, text) where no id repeats; null ids may."""
    sketches = stored(shingle_sketches(docs, "id", "text", n, k), "sketch")
    mark = ["n_shingles", "s1", "s2"]
    some = sketches.where("n_shingles > 0 and id is not null")
    classes = stored(some.groupBy(*mark).agg(F.min("id").alias("rep"), F.count("*").alias("copies")), "class")
    reps = some.join(classes.select("rep", *mark), [*mark]).where("id = rep").select("id", "n_shingles", "sketch")
    lists = stored(_listed(reps, k, per_cent), "lists")

    fits = lambda x, y: F.least(x, y) * 100 >= F.greatest(x, y) * per_cent
    # Stored, so that its size is known before lists move: small ones meet it where they are, others by a join that splits hot values.
    pivots = stored(lists.groupBy("value").agg(F.min(F.struct("id", "n_shingles")).alias("p"), F.count("*").alias("m")).where("m > 1"), "pivots")
    star = lists.join(pivots, "value").where("id <> p.id").where(fits(F.col("n_shingles"), F.col("p.n_shingles")))
    star = stored(star.select(F.col("p.id").alias("a"), F.col("id").alias("b")).distinct(), "pairs")

    # Whole sets are wanted of listed documents only.
    wanted = lists.join(pivots.select("value"), "value", "left_semi").select("id").distinct()
    sets = stored(shingle_sets(docs.join(wanted, "id", "left_semi"), n), "sets")
    links = stored(_confirmed(star, sets, k, per_cent), "links")

    # What the stars left apart: in each list, members outside its largest component against all of the others. Here a
    # component is only what hangs on one pivot; that is enough to leave out most pairs.
    first = links.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("c"))
    labelled = lists.join(pivots.select("value"), "value", "left_semi").join(first, "id", "left")
    # Stored in between, so that counting by value and component deals out by both, whatever the length of a list.
    labelled = stored(labelled.withColumn("c", F.least("c", "id")).select("value", "id", "n_shingles", "c"), "listed")
    labelled = _mixed(labelled).where("m > 2")  # a list of two is tried already
    able = _shareable(stored(labelled.select("value", "id", "n_shingles", "c"), "labelled"), sets, per_cent)
    inside = stored(_mixed(stored(able, "able")), "inside")
    short, long = inside.where(F.col("m") <= SHORT_LIST), inside.where(F.col("m") > SHORT_LIST)
    fewer = short.where("c <> main").select("value", F.col("id").alias("a"), F.col("c").alias("ca"), F.col("n_shingles").alias("na"), F.col("shareable").alias("ha"))
    others = short.select("value", F.col("id").alias("b"), F.col("c").alias("cb"), F.col("n_shingles").alias("nb"), F.col("shareable").alias("hb"), "main")
    cross = fewer.join(others, "value").where("ca <> cb and (cb = main or a < b)").where(_can_link("na", "ha", "nb", "hb", per_cent))
    cross = stored(cross.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
    links = links.unionByName(_confirmed(cross.join(star, ["a", "b"], "left_anti"), sets, k, per_cent))
    if long.limit(1).count():
        links = links.unionByName(_in_blocks(long, sets, per_cent))
    joined = components(links)
    found = classes.select(*mark, "rep").join(joined.withColumnRenamed("component", "c"), F.col("rep") == F.col("id"), "left")
    found = found.select(*mark, F.coalesce("c", "rep").alias("c")).withColumnsRenamed({"n_shingles": "n_", "s1": "s1_", "s2": "s2_"})
    met = (sketches["n_shingles"] == found["n_"]) & (sketches["s1"] == found["s1_"]) & (sketches["s2"] == found["s2_"]) & sketches["id"].isNotNull()
    out = sketches.select("id", "n_shingles", "s1", "s2").join(found, met, "left")
    return out.select("id", "n_shingles", F.coalesce("c", "id").alias("component_id"))


def query(spark, sf_dir: str) -> DataFrame:
    """op6: every document with its component; kept is the first of each component."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = near_duplicates(docs)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))


#: The same over whole sets, every pair that shares a shingle counted.
ORACLE_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w),
each AS (SELECT doc_id, len(s) AS n, md5(unnest(s)) AS x FROM sets),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS c FROM each a JOIN each b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2, 3, 4),
links AS (SELECT a, b FROM pairs WHERE 100 * c >= 75 * (na + nb - c)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT ways.b, reach.c FROM reach JOIN ways ON ways.a = reach.id),
least AS (SELECT id, min(c) AS c FROM reach GROUP BY 1)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, c AS component_id, doc_id = c AS kept FROM sets JOIN least ON id = doc_id
"""
