"""What a snapshot delivered: only rows of databases it could read can be missing from it.

A database that is listed but not usable, or whose server is not in the extract
at all, says nothing about its rows. One that a delivered server no longer
lists was dropped, and its rows are gone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantledger.operators.databases import usable
from grantledger.operators.keys import ANY_SERVER, with_server

PAIR = ["ServerName", "Scope"]


@dataclass(frozen=True)
class Coverage:
    """`servers` (ServerName) that delivered, and the databases (ServerName, Scope) of theirs that were not read."""

    servers: DataFrame
    unread: DataFrame


def of_databases(databases: DataFrame, server_name: str | None = None) -> Coverage:
    """The coverage of the per-database domains. A database listed twice is read if one of its rows is usable."""
    listed = with_server(databases, server_name).select(
        F.col(ANY_SERVER).alias("ServerName"), F.col("name").alias("Scope"), "state_desc", "user_access_desc"
    )
    read = usable(listed).select(*PAIR).distinct()
    unread = listed.select(*PAIR).distinct().join(read, PAIR, "left_anti")
    return Coverage(listed.select("ServerName").distinct(), unread)


def _flagged(rows: DataFrame, coverage: Coverage) -> DataFrame:
    servers = coverage.servers.withColumn("__delivered", F.lit(True))
    unread = coverage.unread.withColumn("__unread", F.lit(True))
    joined = rows.join(servers, "ServerName", "left").join(unread, PAIR, "left")
    return joined.select(
        *rows.columns, (F.col("__delivered").isNotNull() & F.col("__unread").isNull()).alias("__covered")
    )


def inside(rows: DataFrame, coverage: Coverage | None) -> DataFrame:
    """Rows whose absence from the snapshot, or presence in it, means something."""
    if coverage is None:
        return rows
    return _flagged(rows, coverage).filter("__covered").drop("__covered")


def outside(rows: DataFrame, coverage: Coverage) -> DataFrame:
    """All other rows; those without a server are among them."""
    return _flagged(rows, coverage).filter("not __covered").drop("__covered")
