"""Equi-join that spreads hot keys over several tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantledger.session import settle

ROWS_PER_SLICE = 2_000_000

_SLICES = "_slices"
_SLICE = "_slice"


def spread_join(
    left: DataFrame, right: DataFrame, on: list[str], rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """Inner join of `left` with `right` on equally named columns.

    Every key with more than `rows_per_slice` rows in `left`, found by a
    map-side combined count, is cut into slices of about that size by a hash of
    the whole left row, and the right rows of just these keys are repeated per
    slice. There are at most as many such keys as `left` has slices, and
    Catalyst decides by size how to join them. `left` is read twice, so settle
    it if it is expensive. The result equals a plain join.
    """
    columns = [*left.columns, *[c for c in right.columns if c not in on]]
    # a NULL key joins nothing, but would gather in one task
    usable = left.dropna(subset=on)
    heavy = usable.groupBy(*on).count().filter(F.col("count") > rows_per_slice)
    cuts = F.ceil(F.col("count") / rows_per_slice).cast("int")
    hot = settle(heavy.select(*on, cuts.alias(_SLICES)), "hot-keys")
    slices = F.coalesce(F.col(_SLICES), F.lit(1))
    sliced = usable.join(hot, on, "left").withColumn(
        _SLICE, F.pmod(F.xxhash64(*left.columns), slices).cast("int")
    )
    repeated = right.join(hot, on, "left").withColumn(
        _SLICE, F.explode(F.sequence(F.lit(0), slices - 1))
    )
    joined = sliced.drop(_SLICES).join(repeated.drop(_SLICES), [*on, _SLICE], "inner")
    return joined.select(*columns)
