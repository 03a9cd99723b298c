"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grantledger.llm.common import seeded
from grantledger.llm.ranking import with_running
from grantledger.session import settle

SEED = 11
#: Weights of the sources in their order, repeating.
WEIGHTS = (5, 2, 1)
#: No source is repeated more often than this.
MAX_EPOCHS = 3


def cyclic_weights(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """`sources` with `weight`: the given ones in turn, by code point, the null source last."""
    # one row for each source, not for each document
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    return sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn.cast("int") + 1))


def fill(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """`sources` (source, source_size, weight) with `target`, sharing the sum of all sizes.

    A source stops at `max_epochs` times its size; what it leaves is shared
    again by weight. With the sources ordered by the level at which they stop,
    a source stops exactly if its share of what the earlier ones leave is above
    its stop, so one pass over that order gives the fixed point.
    """
    stop = F.col("source_size") * max_epochs
    order = Window.orderBy(stop / F.col("weight"), F.col("source").asc_nulls_last())
    earlier, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    shared = sources.select(
        "*",
        stop.alias("__stop"),
        (F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum(stop).over(earlier), F.lit(0)))
        .cast("double").alias("__left"),
        F.sum("weight").over(rest).cast("double").alias("__rest"),
    )
    full = F.col("__stop") <= F.col("__left") * F.col("weight") / F.col("__rest")
    # the level at which the others settle is that of the first source that is not full
    level = F.first(F.when(~full, F.struct("__left", "__rest")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    levelled = shared.withColumn("__full", full).withColumn("__level", level)
    share = F.col("__level.__left") * F.col("weight") / F.col("__level.__rest")
    return levelled.withColumn(
        "target", F.when(F.col("__full"), F.col("__stop").cast("double")).otherwise(share)
    ).drop("__stop", "__left", "__rest", "__full", "__level")


def mix(
    docs: DataFrame,
    size: Column,
    key: str = "doc_id",
    weights: tuple[int, ...] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """`docs` with `size`, `source_size`, `target` and `repeats`, how often the mix takes the row.

    Every row is taken as often as its source's target holds the source whole;
    of the rest of the target, rows in a seeded order are taken once more while
    the larger part of the row lies inside. A source so misses its target by
    half a row at most. Columns of these names are replaced.

    Only key, source, size and a hash of the text are sorted. What comes back to
    the rows is one cut for each source: the last row in the seeded order that
    is taken once more.

    A null text has size 0; rows of size 0 and sources of size 0 follow the
    same rule (a source of size 0 is not taken). A null source is a source. Rows
    that agree in key and text share their place in the order and are taken
    alike. An empty table gives an empty table.
    """
    taken_names = ("size", "source_size", "target", "repeats")
    rows = docs.drop(*taken_names).withColumn("size", size.cast("long"))
    place = F.struct(
        seeded(seed, F.col(key)).alias("drawn"), F.xxhash64(F.col(key), F.col("text")).alias("tie")
    )
    slim = rows.select("source", "size", place.alias("place"))
    # equal rows count as one, so that a run of them lies in one range
    slim = settle(slim.groupBy("source", "place").agg(F.sum("size").alias("size")), "mix-sizes")
    sizes = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = fill(cyclic_weights(sizes, weights), max_epochs)

    running = with_running(slim, "source", "size", F.col("place"))
    of = targets.withColumnRenamed("source", "__source")
    placed = running.join(of, running["source"].eqNullSafe(of["__source"]))
    whole = F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
    ).otherwise(F.lit(0))
    extra = F.col("target") - whole * F.col("source_size")
    inside = (extra > 0) & (F.col("before") + F.col("size") / 2 <= extra)
    cuts = placed.groupBy("__source").agg(F.max(F.when(inside, F.col("place"))).alias("__cut"))

    of = of.withColumn("__whole", whole.cast("int")).join(
        cuts.withColumnRenamed("__source", "__cut_source"),
        F.col("__source").eqNullSafe(F.col("__cut_source")),
    )
    of = settle(of, "mix-cuts")  # one row for each source, whose size is known from here on
    joined = rows.join(of, rows["source"].eqNullSafe(of["__source"]))
    once_more = F.coalesce((place <= F.col("__cut")) & (F.col("source_size") > 0), F.lit(False))
    return joined.select(
        *[rows[c] for c in rows.columns],
        "source_size",
        "target",
        (F.col("__whole") + once_more.cast("int")).alias("repeats"),
    )


def repeated(mixed: DataFrame) -> DataFrame:
    """Each row as often as the mix takes it."""
    copies = F.explode(F.sequence(F.lit(1), F.col("repeats")))
    return mixed.where("repeats > 0").withColumn("__copy", copies).drop("__copy")
