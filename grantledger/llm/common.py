"""Helpers shared by the operators of this package."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The white space of all word definitions here: space and the controls 9 to 13.
SPACE = r"\x20\x09-\x0D"
WORD = f"[^{SPACE}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, null counting as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def seeded(seed: int, *columns: Column) -> Column:
    """A pseudo-random order of rows that any engine with md5 can repeat."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in columns]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))


#: Bytes of one Arrow batch handed to Python; a single longer text makes a batch of its own.
BATCH_BYTES = 2 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Let batches handed to Python end by bytes too, as texts may be very long."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key, None)
    if now is None or not now.isdigit() or int(now) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def with_fields(schema: T.StructType, *fields: tuple[str, str]) -> T.StructType:
    """`schema` followed by new fields, given as (name, DDL type)."""
    out = T.StructType(list(schema.fields))
    for name, kind in fields:
        out = out.add(name, T._parse_datatype_string(kind))
    return out


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner delete now what steps before a written table had shuffled.

    It notices dropped shuffles when garbage is collected, by itself every half hour.
    """
    gc.collect()
    spark._jvm.System.gc()
