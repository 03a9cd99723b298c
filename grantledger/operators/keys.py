"""Key columns shared by the gathers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ANY_SERVER = "server_name"
SPREAD = 1 << 20


def with_server(df: DataFrame, server_name: str | None) -> DataFrame:
    """Catalog rows carry their server; a single-server extract gets it from the job."""
    if ANY_SERVER in df.columns:
        return df
    if server_name is None:
        raise ValueError("catalog has no server_name column and no server_name was given")
    return df.withColumn(ANY_SERVER, F.lit(server_name))


def lookup_id(resolvable: Column, key: Column, *spread_by: str) -> Column:
    """The id to look a row up by in a left join; rows without a partner get a spread one.

    Rows that cannot find a partner would all carry the same id (0 or NULL) and
    meet in a single task. They get a negative hash instead, which the caller
    must know to match nothing, by another key column or by the ids' range.
    """
    spread = -1 - F.pmod(F.xxhash64(*spread_by), F.lit(SPREAD))
    return F.when(resolvable, key.cast("bigint")).otherwise(spread)
