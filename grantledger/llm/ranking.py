"""Order and running sums over whole tables, without a single task that sees all rows.

A table is dealt out by ranges of its sort keys and written with each row's
place in its range. What came before a range is a sum over ranges, a table of
as many rows as there are ranges (times the groups in them).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grantledger.llm.common import shuffle_width
from grantledger.session import settle

#: monotonically_increasing_id() keeps the row's place in the lower 33 bits.
PLACE_BITS = 33


def in_order(df: DataFrame, *keys: Column) -> DataFrame:
    """`df`, written in the order of `keys`, with `__range` and `__place` (both from 0).

    Rows equal in all keys follow in the order of the input; that last key also
    lets a long run of equal rows be cut into several ranges.
    """
    width = shuffle_width(df.sparkSession)
    df = df.withColumn("__input", F.monotonically_increasing_id())
    by = [*keys, F.col("__input")]
    dealt = df.repartitionByRange(width, *by).sortWithinPartitions(*by).drop("__input")
    written = settle(dealt.withColumn("__at", F.monotonically_increasing_id()), "in-order")
    return written.select(
        *[c for c in written.columns if c != "__at"],
        F.shiftrightunsigned("__at", PLACE_BITS).alias("__range"),
        F.col("__at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).alias("__place"),
    )


def with_rank(df: DataFrame, *keys: Column, rank: str = "rank", total: str = "total") -> DataFrame:
    """`df` with the row's number, from 0, in the order of `keys` over the whole table, and the table's length."""
    ordered = in_order(df, *keys)
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each range, so as many as there are shuffle partitions
    starts = ordered.groupBy("__range").agg(F.count("*").alias("__n")).select(
        "__range",
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"),
        F.sum("__n").over(Window.partitionBy()).alias(total),
    )
    joined = ordered.join(F.broadcast(starts), "__range")
    return joined.withColumn(rank, F.col("__start") + F.col("__place")).drop("__range", "__place", "__start")


def with_running(df: DataFrame, group: str, value: str, *keys: Column, before: str = "before") -> DataFrame:
    """`df` with the sum of `value` over the rows of its group that come earlier by `keys`.

    A group of any size is cut into ranges; inside a range a window sums up.
    """
    ordered = in_order(df, F.col(group), *keys)
    inside = (
        Window.partitionBy("__range", group).orderBy("__place").rowsBetween(Window.unboundedPreceding, -1)
    )
    earlier = Window.partitionBy(group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    sums = ordered.groupBy("__range", group).agg(F.sum(value).alias("__sum"))
    starts = sums.select(
        F.col("__range").alias("__r"),
        F.col(group).alias("__g"),
        F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__start"),
    )
    local = ordered.withColumn("__inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    joined = local.join(
        starts, (local["__range"] == starts["__r"]) & local[group].eqNullSafe(starts["__g"])
    )
    return joined.withColumn(before, F.col("__start") + F.col("__inside")).drop(
        "__range", "__place", "__inside", "__start", "__r", "__g"
    )
