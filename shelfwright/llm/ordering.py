"""Positions and running sums inside groups of any size, without a window over a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from shelfwright.session import stored


def whole_numbers(docs: DataFrame, id_col: str) -> Column:
    """The ids as longs; a TypeError where they are no whole numbers (number rows first, then join the ids back)."""
    if not isinstance(docs.schema[id_col].dataType, T.IntegralType):
        raise TypeError(f"{id_col} must be of a whole-number type, not {docs.schema[id_col].dataType.simpleString()}")
    return F.col(id_col).cast("long")


def positions(df: DataFrame, keys: list[str], order: str, tie: list[str], size: str | None = None, per_part: int = 8192) -> DataFrame:
    """df (stored) with `pos`, the gapless place from 0 in its group, and `before`, the sum of size over places before.

    Groups are by keys (null is a value of its own); the order is that of the long column `order`, spread evenly over
    its range as a hash is, then of tie. Parts of the range are numbered alone and shifted by the counts of the parts before them, so no task
    gets more than about per_part rows, whatever share of the rows one group has.
    """
    df = stored(df, "rows")
    n = df.count()
    bits = max(0, (n // per_part).bit_length())
    part = F.shiftright(F.col(order), 64 - bits).cast("int") if bits else F.lit(0)
    df = df.withColumn("_part", part)
    amount = F.col(size) if size else F.lit(0)
    sums = df.groupBy(*keys, "_part").agg(F.count("*").alias("_n"), F.sum(amount).alias("_s"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    shift = sums.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(earlier), zero).alias("_n0"), F.coalesce(F.sum("_s").over(earlier), zero).alias("_s0"))
    inside = Window.partitionBy(*keys, "_part").orderBy(order, *tie)
    rows = df.withColumn("_pos", F.row_number().over(inside) - 1).withColumn("_sum", F.coalesce(F.sum(amount).over(inside.rowsBetween(Window.unboundedPreceding, -1)), zero))
    on = F.col("_part") == F.col("_p")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    met = rows.join(shift, on)
    return met.select(*(c for c in df.columns if c != "_part"), (F.col("_pos") + F.col("_n0")).cast("long").alias("pos"), (F.col("_sum") + F.col("_s0")).cast("long").alias("before"))
