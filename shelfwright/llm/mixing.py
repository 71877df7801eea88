"""Mixing sources to target weights by temperature.

A source's share of all tokens is raised to an exponent between 0 (all alike) and 1 (as they are) and normalised. The
exponent is bisected: the largest one whose weights reach a target entropy, or the smallest one whose weights repeat no
source's tokens more often than allowed; both limits together take the exponent that repeats less. The weights become
an order of documents: each source is a row of permutations of its documents (epochs), cut at its budget, and blocks of
tokens take from every source in the proportion of its weight.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from shelfwright.llm.ordering import positions
from shelfwright.session import settled, stored

_GRID = 15


def tokens(text: Column) -> Column:
    """Words of white space; the size in which budgets are given. A null text has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _weights_of(sources: DataFrame, alphas: list[float], total: int) -> list[tuple[float, float, float, float]]:
    """For each exponent: the normaliser, the entropy, and the least and largest weight per share, in one aggregate."""
    share = F.col("tokens") / F.lit(float(total))
    aggs = []
    for k, a in enumerate(alphas):
        p = F.pow(share, F.lit(a))
        aggs += [F.sum(p).alias(f"z{k}"), F.sum(p * F.log(p)).alias(f"e{k}"), F.max(p / share).alias(f"m{k}"), F.min(p / share).alias(f"l{k}")]
    row = sources.where("tokens > 0").agg(*aggs).first()
    out = []
    for k in range(len(alphas)):
        z = row[f"z{k}"]
        out.append((z, math.log(z) - row[f"e{k}"] / z, row[f"m{k}"] / z, row[f"l{k}"] / z))
    return out


def temperature(sources: DataFrame, total: int, entropy_share: float | None, most_repeats: float | None, cover: bool) -> tuple[float, float, float]:
    """(exponent, normaliser, least weight per share) for sources (source, tokens).

    Bisection by sections: each aggregate tries 15 exponents of the bracket at once, until it is below 1e-9.
    A budget of all tokens repeats a source weight / share times; with cover, the budget grows until no source has less
    than one epoch, and repeats are counted from there.
    """
    n = sources.where("tokens > 0").count()
    if not n or not total:
        return 1.0, 1.0, 1.0
    target = None if entropy_share is None else entropy_share * math.log(n)

    def repeats(x: tuple[float, float, float, float]) -> float:
        return x[2] / x[3] if cover else x[2]

    def bisect(flat_enough) -> float:
        """The largest exponent for which flat_enough holds (it holds below and fails above, or everywhere)."""
        low, high = 0.0, 1.0
        if flat_enough(_weights_of(sources, [1.0], total)[0]):
            return 1.0
        while high - low > 1e-9:
            grid = [low + (high - low) * (k + 1) / (_GRID + 1) for k in range(_GRID)]
            ok = [flat_enough(x) for x in _weights_of(sources, grid, total)]
            first_bad = ok.index(False) if False in ok else _GRID
            low, high = ([low, *grid])[first_bad], ([*grid, high])[first_bad]
        return low

    by_entropy = bisect(lambda x: x[1] >= target - 1e-12) if target is not None else 0.0
    by_repeats = bisect(lambda x: repeats(x) > most_repeats) if most_repeats is not None else 0.0
    alpha = max(by_entropy, by_repeats) if entropy_share is not None or most_repeats is not None else 1.0
    z, _, _, least = _weights_of(sources, [alpha], total)[0]
    return alpha, z, least


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", entropy_share: float | None = 0.97, most_repeats: float | None = 4.0, budget: int | None = None, cover: bool = False, block_tokens: int = 1 << 20, seed: int = 1, row_col: str | None = None) -> DataFrame:
    """(row, id, source, n_tokens, epoch, block, slot, exponent, weight): the documents in the order of the mixture.

    row is row_col, a key of the input's rows, or without one the place of the row in the input as read by this call. A document stands once for each epoch of
    its source that the budget reaches: its first token must lie below the source's quota, budget x weight. slot is
    its place in its block, by hash. budget: tokens of all (default: as many as there are); with cover, as many as
    give every source a whole epoch at least, so that no document is left out. A null source is a source of its own, a
    null text has no tokens; exponent is the same for all rows, weight is the source's (0 without tokens). Documents without tokens come with their source's first epoch, where all of a source are
    so spread over the blocks by hash. Repeated rows are rows of their own, an empty table gives none.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), tokens(F.col(text_col)).alias("n_tokens"), (F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("row"))
    rows = stored(rows, "mix")
    sources = stored(rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs")), "sources")
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    alpha, z, least = temperature(sources, total, entropy_share, most_repeats, cover)
    budget = math.ceil(total / least) if cover else total if budget is None else budget
    weight = F.pow(F.col("tokens") / F.lit(float(max(total, 1))), F.lit(alpha)) / z
    quota = F.when(F.col("tokens") > 0, F.ceil(weight * budget - 1e-6)).otherwise(1).cast("long")
    quota = F.greatest(quota, F.col("tokens")) if cover else quota
    blocks = max(1, -(-budget // block_tokens))
    plan = sources.select(F.col("source").alias("s"), "tokens", quota.alias("quota"))
    # The plan has a row for each source: small beside the documents, but of no fixed bound, so the join is left to Spark.
    each = rows.join(plan, F.col("source").eqNullSafe(F.col("s"))).withColumn("epoch", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("quota") / F.greatest("tokens", F.lit(1))).cast("int") - 1))))
    each = each.withColumn("h", F.xxhash64(F.lit(seed), "epoch", "row"))
    placed = positions(each.drop("s"), ["source", "epoch"], "h", ["row"], "n_tokens")
    start = F.col("epoch") * F.col("tokens") + F.col("before")
    kept = placed.where((start < F.col("quota")) | ((F.col("epoch") == 0) & (F.col("tokens") == 0) | (F.lit(cover) & (F.col("epoch") == 0))))
    block = F.when(F.col("tokens") == 0, F.pmod("h", F.lit(blocks))).otherwise(F.least(F.lit(blocks - 1), F.floor(start / F.col("quota") * blocks))).cast("int")
    kept = kept.withColumn("block", block).drop("pos", "before").withColumn("h2", F.xxhash64(F.lit(seed + 1), "block", "epoch", "row"))
    slotted = positions(kept, ["block"], "h2", ["row", "epoch"])
    return slotted.select("row", "id", "source", "n_tokens", "epoch", "block", F.col("pos").cast("int").alias("slot"), F.lit(alpha).alias("exponent"), F.when(F.col("tokens") > 0, weight).otherwise(0.0).alias("weight"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """docs in the order of the mixture (block, slot): each row once for each epoch that takes it, the columns as they were.

    Rows are met by a stored key of their own, so null and repeated ids are rows like others, and columns may have any name.
    """
    text_col, source_col = options.pop("text_col", "text"), options.pop("source_col", "source")
    keyed = stored(docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*docs.columns).alias("doc")), "keyed")
    facts = keyed.select("row", F.col(f"doc.{id_col}").alias("id"), F.col(f"doc.{text_col}").alias("text"), F.col(f"doc.{source_col}").alias("source"))
    plan = settled(docs.sparkSession, lambda: mixed(facts, "id", "text", "source", row_col="row", **options).select("row", "block", "slot"), "plan")
    return keyed.join(plan, "row").orderBy("block", "slot").select("doc.*")


def query(spark, sf_dir: str) -> DataFrame:
    """op4: the documents as a mixture of what each language has of each source, flattened to 97 % of the greatest entropy or 4 epochs
    at most. Languages are uneven where sources are alike, so the exponent is below 1 and scarce languages come again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.select("doc_id", "text", F.to_json(F.struct("lang", "source")).alias("source"))
    return mixed(rows).withColumnRenamed("id", "doc_id").drop("row")
