"""Narrowing a comparison to the buckets of rows in which two snapshots differ.

Rows fall into buckets by a hash of all values. Each side sums its buckets up in
one row each: the number of rows, and sum and exclusive or of two 64-bit hashes,
which no order of rows changes. Equal digests mean equal rows; only rows of the
other buckets go into the comparison, which then looks at their values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantledger.schemas import Domain
from grantledger.session import settle

#: Buckets of a comparison; also the most rows that are sent to all tasks.
BUCKETS = 1 << 16

_LOW = 0xFFFFFFFF


def _hashes(domain: Domain) -> tuple[Column, Column]:
    """Two hashes of a row's values that tell NULL from anything else in any column."""
    def parts(columns: list[str]) -> list[Column]:
        return [part for c in columns for part in (F.col(c).isNull(), F.col(c))]

    names = list(domain.values)
    return F.xxhash64(*parts(names)), F.xxhash64(F.lit(1), *parts(names[::-1]))


def bucket(domain: Domain, buckets: int = BUCKETS) -> Column:
    return F.pmod(_hashes(domain)[0], F.lit(buckets)).cast("int")


def digests(rows: DataFrame, domain: Domain, buckets: int = BUCKETS) -> DataFrame:
    """One row for each bucket that has rows: `bucket`, `digest`."""
    one, two = _hashes(domain)
    hashed = rows.select(bucket(domain, buckets).alias("bucket"), one.alias("one"), two.alias("two"))

    def halves(name: str) -> list[Column]:
        # halves, so that sums stay within 64 bits
        return [
            F.sum(F.col(name).bitwiseAND(F.lit(_LOW))),
            F.sum(F.shiftrightunsigned(name, 32)),
            F.bit_xor(name),
        ]

    columns = [F.count(F.lit(1)), *halves("one"), *halves("two")]
    names = ["n", "low1", "high1", "xor1", "low2", "high2", "xor2"]
    summed = hashed.groupBy("bucket").agg(*[c.alias(n) for c, n in zip(columns, names, strict=True)])
    return summed.select("bucket", F.struct(*names).alias("digest"))


def differing(
    live: DataFrame, staging: DataFrame, domain: Domain, buckets: int = BUCKETS
) -> tuple[DataFrame, DataFrame]:
    """Both sides without the buckets that are equal in both.

    Repeated rows count in a digest: where they alone differ, a bucket is
    compared in vain, and the comparison finds no change. Both sides are read
    twice, so they should be stored tables.
    """
    before = digests(live, domain, buckets).withColumnRenamed("digest", "before")
    now = digests(staging, domain, buckets).withColumnRenamed("digest", "now")
    unlike = before.join(now, "bucket", "full_outer").where(~F.col("before").eqNullSafe(F.col("now")))
    unlike = settle(unlike.select("bucket"), "unlike")

    def narrowed(rows: DataFrame) -> DataFrame:
        # at most one number for each bucket
        return rows.withColumn("__bucket", bucket(domain, buckets)).join(
            F.broadcast(unlike.withColumnRenamed("bucket", "__bucket")), "__bucket", "left_semi"
        ).drop("__bucket")

    return narrowed(live), narrowed(staging)
