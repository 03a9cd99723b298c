"""SimHash fingerprints and a search within a Hamming radius, in DataFrame expressions alone."""

from __future__ import annotations

import math
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantledger.llm.common import SPACE
from grantledger.llm.ranking import with_rank

BITS = 64
HALF = BITS // 2
#: Two 32-bit counters in a long: a bit of the lower half of a hash and one of the upper half.
LANES = (1 << HALF) + 1
RADIUS = 3
#: Key bits of a block table beyond those that number all fingerprints.
SPARE_BITS = 4


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >= 1 << (BITS - 1) else value


def _bit(place: int, on: Column) -> Column:
    return F.when(on, F.lit(_signed(1 << place))).otherwise(F.lit(0).cast("long"))


def simhash(texts: DataFrame, *keys: str, text: str = "text") -> DataFrame:
    """`keys` with `fingerprint`: each term's hash votes on the 64 signs, weighted by how often it occurs.

    A bit is set if more occurrences vote for it than against; a text without
    words has fingerprint 0. Rows with equal keys are one text in parts; a null
    text counts as empty. The votes are sums, combined before any shuffle. A
    sum counts two bits, in lanes that 2^32 occurrences would overflow.
    """
    words = F.split(F.coalesce(F.col(text), F.lit("")), f"[{SPACE}]+")
    # the empty word votes for nothing, but keeps texts without words
    rows = texts.select(*keys, F.explode(words).alias("__word"))
    spoken = F.col("__word") != ""
    rows = rows.select(*keys, F.when(spoken, F.xxhash64("__word")).alias("__hash"))
    lanes = [
        F.sum(F.shiftrightunsigned("__hash", i).bitwiseAND(F.lit(LANES))).alias(f"__v{i}") for i in range(HALF)
    ]
    votes = rows.groupBy(*keys).agg(F.count("__hash").alias("__n"), *lanes)
    n = F.col("__n")
    low = [_bit(i, F.col(f"__v{i}").bitwiseAND(F.lit((1 << HALF) - 1)) * 2 > n) for i in range(HALF)]
    high = [_bit(i + HALF, F.shiftrightunsigned(f"__v{i}", HALF) * 2 > n) for i in range(HALF)]
    return votes.select(*keys, reduce(Column.bitwiseOR, low + high).alias("fingerprint"))


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def likeness(a: Column, b: Column) -> Column:
    """The part of equal bits, from 0 to 1."""
    return 1 - distance(a, b) / F.lit(float(BITS))


def written(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), BITS // 4, "0"))


def block_tables(count: int, radius: int = RADIUS) -> list[int]:
    """Masks of the permuted tables for about `count` fingerprints.

    The bits are cut into blocks; whatever `radius` bits differ, all other
    blocks agree, so one of the tables, each keyed by as many blocks as must
    agree, brings two such fingerprints together. More fingerprints get more
    blocks and so longer keys; any number of blocks finds all pairs.
    """
    wanted = min(math.log2(max(count, 2)) + SPARE_BITS, BITS - 2 * radius)
    blocks = radius + 1
    while BITS * (blocks - radius) // blocks < wanted:
        blocks += 1
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    masks = [sum(1 << b for b in range(edges[i], edges[i + 1])) for i in range(blocks)]
    return [_signed(sum(masks[i] for i in chosen)) for chosen in combinations(range(blocks), blocks - radius)]


def near(queries: DataFrame, fingerprints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs (`query`, `fingerprint`, `distance`) of distinct fingerprints within `radius` bits, equal ones included.

    Both sides need a column `fingerprint`; null ones match nothing. A pair is
    kept in the first table that brings it together, so no distinct is needed.
    """
    known = fingerprints.select("fingerprint").where("fingerprint is not null").distinct()
    asked = queries.select(F.col("fingerprint").alias("query")).where("query is not null").distinct()
    masks = block_tables(known.count(), radius)
    tables = F.array(*[F.struct(F.lit(i).alias("t"), F.lit(m).alias("m")) for i, m in enumerate(masks)])

    def dealt(df: DataFrame, column: str) -> DataFrame:
        rows = df.withColumn("__table", F.explode(tables))
        return rows.select(
            column, F.col("__table.t").alias("__t"), F.col(column).bitwiseAND(F.col("__table.m")).alias("__key")
        )

    left, right = dealt(asked, "query").alias("q"), dealt(known, "fingerprint").alias("k")
    differ = F.col("query").bitwiseXOR(F.col("fingerprint"))
    first = F.coalesce(*[F.when(differ.bitwiseAND(F.lit(m)) == 0, F.lit(i)) for i, m in enumerate(masks)])
    within = (F.bit_count(differ) <= radius) & (first == F.col("q.__t"))
    pairs = left.join(right, (F.col("q.__t") == F.col("k.__t")) & (F.col("q.__key") == F.col("k.__key")) & within)
    return pairs.select("query", "fingerprint", F.bit_count(differ).alias("distance"))


def with_edited(docs: DataFrame) -> DataFrame:
    """A row for each different row of `docs` (doc_id, text), with its number of `copies`, `text` and `edited` text.

    `__k` and `__k2` are its key, `__next` and `__next2` that of the next document.

    The edited text ends with the beginning of the next document, by descending
    id, nulls last, then a hash of the text; the last one's next is the first.
    Repeated rows are one document here, null texts empty. The whole text is dealt out once, by the key
    (`__k`, `__k2`); to its neighbour goes only the borrowed beginning.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumns(
        {"__k": F.xxhash64("doc_id", "text"), "__k2": F.xxhash64(F.lit(1), "text", "doc_id")}
    )
    counted = rows.groupBy("__k", "__k2", "doc_id", F.length("text").cast("long").alias("n")).count()
    ranked = with_rank(counted, F.col("doc_id").desc_nulls_last(), F.col("__k"), F.col("__k2"))
    if not ranked.where("count > 1").isEmpty():
        rows = rows.dropDuplicates(["__k", "__k2"])
    follows = ranked.select(
        F.col("__k").alias("__next"), F.col("__k2").alias("__next2"), F.col("rank").alias("__rank")
    )
    order = ranked.select(
        "__k", "__k2", "doc_id", F.col("count").alias("copies"), "n",
        ((F.col("rank") + 1) % F.col("total")).alias("__rank"),
    ).join(follows, "__rank")
    asked = order.select(
        F.col("__next").alias("__k"), F.col("__next2").alias("__k2"), F.col("__k").alias("__to"),
        F.col("__k2").alias("__to2"), "doc_id", "copies", F.floor(F.col("n") / 2).cast("int").alias("__chars"),
    )
    # both joins read the same columns of the texts, so both read the same shuffle
    texts = rows.select("__k", "__k2", "text")
    lent = texts.join(asked, ["__k", "__k2"]).select(
        F.col("__to").alias("__k"), F.col("__to2").alias("__k2"), F.col("__k").alias("__next"),
        F.col("__k2").alias("__next2"), "doc_id", "copies", "__chars",
        F.expr("substring(text, 1, __chars)").alias("__lent"),
    )
    kept = F.expr("substring(text, 1, length(text) - __chars)")
    return texts.join(lent, ["__k", "__k2"]).select(
        "__k", "__k2", "doc_id", "copies", "text", F.concat(kept, "__lent").alias("edited"), "__next", "__next2"
    )
