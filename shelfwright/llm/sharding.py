"""Sharding by longest-processing-time scheduling: groups stay together, the largest go first, each to the least load.

Groups large enough to matter alone are scheduled one by one through a heap on the driver; their number is bounded by
shards x FINE. All other groups are scheduled by size class: groups of a class (sizes that agree in their 8 leading
bits) are interchangeable, so a class is a run of equal jobs, and the heap deals them out by number. The driver holds
one row for each large group and each class, whatever the number of documents.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, functions as F, types as T

from shelfwright.llm.ordering import positions
from shelfwright.session import stored

#: A group above 1 / (shards * FINE) of all bytes is scheduled alone.
FINE = 1024
CLASS_BITS = 8


def longest_first(jobs: list[tuple[float, int]], shards: int) -> list[list[int]]:
    """For each job (size of one, number of equal ones): how many go to each shard.

    Jobs are taken from large to small; each single one goes to the least loaded shard (of equal ones the lowest).
    Where a job stands for many, loads are first levelled in bulk and only the rest goes through the heap.
    """
    loads = [0.0] * shards
    out = [[0] * shards for _ in jobs]
    for k in sorted(range(len(jobs)), key=lambda k: -jobs[k][0]):
        size, n = jobs[k]
        if n > 4 * shards:
            level = (sum(loads) + size * n) / shards
            for _ in range(shards):  # shards above the level take none; the others share what is left
                low = [x for x in loads if x < level]
                new = (sum(low) + size * n) / len(low)
                if new >= level - 1e-9:
                    break
                level = new
            for s in range(shards):
                take = min(n, max(0, int((level - loads[s]) // size) - 1))
                loads[s], out[k][s], n = loads[s] + take * size, out[k][s] + take, n - take
        heap = [(load, s) for s, load in enumerate(loads)]
        heapq.heapify(heap)
        for _ in range(n):
            load, s = heapq.heappop(heap)
            loads[s], out[k][s] = load + size, out[k][s] + 1
            heapq.heappush(heap, (load + size, s))
    return out


def sharded(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", overhead: int = 8) -> DataFrame:
    """(id, size, text_crc32, shard, slot) for every row of docs; rows of one text are in one shard.

    size is the text's UTF-8 bytes (null: none) plus overhead; slots are gapless from 0 in each shard. Null texts are a
    group of their own, apart from empty ones. Ids may be of any type, null, or repeat: each row has its own slot. Groups
    of one size go in order of their text's hash. An empty table gives no row.
    """
    text = F.col(text_col)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), (F.coalesce(F.octet_length(text), F.lit(0)) + overhead).cast("long").alias("size"), F.crc32(F.coalesce(text, F.lit(""))).cast("long").alias("text_crc32"), F.coalesce(F.md5(text), F.lit("null")).alias("g")
    )
    rows = stored(rows, "sizes")
    groups = stored(rows.groupBy("g").agg(F.sum("size").alias("bytes")), "groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    alone = total / (shards * FINE)
    large = [(r["g"], r["bytes"]) for r in groups.where(F.col("bytes") > alone).orderBy(F.desc("bytes"), "g").collect()]
    small = groups.where(F.col("bytes") <= alone).withColumn("drop", F.greatest(F.lit(0), F.length(F.bin("bytes")) - CLASS_BITS))
    small = small.withColumn("cls", F.expr("shiftright(bytes, drop) * 64 + drop")).drop("drop").withColumn("h", F.xxhash64("g"))
    classes = [(r["cls"], r["n"], r["bytes"]) for r in small.groupBy("cls").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")).orderBy("cls").collect()]
    dealt = longest_first([(b, 1) for _, b in large] + [(b / n, n) for _, n, b in classes], shards)

    spark = docs.sparkSession
    whole = T.StructType([T.StructField("g", T.StringType()), T.StructField("shard", T.IntegerType())])
    whole = spark.createDataFrame([(g, counts.index(1)) for (g, _), counts in zip(large, dealt, strict=False)], whole)
    shares = []
    for (cls, _, _), counts in zip(classes, dealt[len(large) :], strict=True):
        ends, who, at = [], [], 0
        for s, n in enumerate(counts):
            if n:
                at += n
                ends.append(at)
                who.append(s)
        shares.append((cls, ends, who))
    shares = spark.createDataFrame(shares, "k long, ends array<long>, who array<int>")
    # Both tables are bounded: shards x FINE rows, and one for each of some thousand classes.
    ranked = positions(small, ["cls"], "h", ["g"]).join(F.broadcast(shares), F.col("cls") == F.col("k"))
    ranked = ranked.select("g", F.get("who", F.size(F.filter("ends", lambda e: e <= F.col("pos")))).alias("shard2"))
    met = rows.join(F.broadcast(whole), "g", "left")
    placed = met.where("shard is not null").select("row", "id", "size", "text_crc32", "shard")
    others = met.where("shard is null").drop("shard").join(ranked, "g").select("row", "id", "size", "text_crc32", F.col("shard2").alias("shard"))
    placed = placed.unionByName(others).withColumn("h", F.xxhash64("row"))  # rows differ, so no part of the hash range is hot
    return positions(placed, ["shard"], "h", ["row"]).select("id", "size", "text_crc32", "shard", F.col("pos").alias("slot"))


def query(spark, sf_dir: str) -> DataFrame:
    """op10: every document in one of 24 shards of near equal bytes."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = sharded(docs, 24)
    return out.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
