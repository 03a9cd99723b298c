"""Shards that all hold the sources in the mixture's proportions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantledger.llm.common import seeded
from grantledger.llm.ranking import with_rank, with_running

SEED = 5
SHARDS = 40


def interleave(docs: DataFrame, key: str = "doc_id", shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """`docs` with `shard` and `slot`, its place in the shard from 0.

    Rows are shuffled by a seeded hash within their source. The k-th of n rows
    of a source stands at (k + 1/2) / n; sorted by that fraction the sources
    interleave in proportion, and equal cuts of the order are the shards. The
    numbers of rows of two shards differ by one at most.

    Pass few and short columns: rows are sorted twice. A null source is a
    source; null keys and repeated rows are rows like others; an empty table
    gives an empty table. Columns named `shard` and `slot` are replaced.
    """
    rows = docs.drop("shard", "slot").withColumn("__drawn", seeded(seed, F.col(key))).withColumn("__one", F.lit(1))
    ranked = with_running(rows, "source", "__one", F.col("__drawn"), F.col(key), before="__earlier")
    sizes = docs.groupBy(F.col("source").alias("__source")).agg(F.count("*").alias("__n"))
    placed = ranked.join(sizes, ranked["source"].eqNullSafe(sizes["__source"])).drop("__source")
    placed = placed.withColumn("__at", (F.col("__earlier") + F.lit(0.5)) / F.col("__n"))
    ordered = with_rank(
        placed.select(*docs.drop("shard", "slot").columns, F.col("__at").alias("__fraction"), "__drawn"),
        F.col("__fraction"), F.col("__drawn"), F.col(key), rank="__rank", total="__total",
    )
    # the first rank of a shard is the least r with r * shards >= shard * total
    return ordered.withColumn("shard", F.expr(f"cast(__rank * {shards} div __total as int)")).select(
        *docs.drop("shard", "slot").columns,
        "shard",
        F.expr(f"__rank - (shard * __total + {shards - 1}) div {shards}").alias("slot"),
    )
