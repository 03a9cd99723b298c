"""Hand-made rows and the helpers to compare frames."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantledger.schemas import GROUPS, INSTANCE, POLL, ROLES, live_schema, value_schema

DAY1 = "2024-01-01 00:00:00"
DAY2 = "2024-01-02 00:00:00"
DAY3 = "2024-01-03 00:00:00"


def grant(
    name="ann", permission="VIEW", state="GRANT", disabled="No", sid="S1", kind="SQL_LOGIN",
    server="srv", endpoint="N/A",
):
    return (server, "Instance-Level", sid, name, kind, disabled, permission, state, "SERVER", endpoint)


def staging(spark, domain, rows):
    return spark.createDataFrame(rows, value_schema(domain, T.StringType()))


def live(spark, domain, rows, poll=DAY1):
    """Live rows; a row may carry its own poll time as a last extra value."""
    width = len(domain.values)
    full = [tuple(r[:width]) + (r[width] if len(r) > width else poll,) for r in rows]
    schema = value_schema(domain, T.StringType()).add(POLL, T.StringType())
    frame = spark.createDataFrame(full, schema)
    return frame.withColumn(POLL, F.col(POLL).cast("timestamp"))


def values(df, domain):
    """Multiset of value tuples."""
    return Counter(tuple(r) for r in df.select(*domain.values).collect())


def polled(df, domain):
    """Value tuples with the day they carry."""
    shown = df.select(*domain.values, F.date_format(POLL, "yyyy-MM-dd HH:mm:ss").alias(POLL))
    return {tuple(r)[:-1]: r[POLL] for r in shown.collect()}


def everything(df):
    return Counter(tuple(r) for r in df.collect())


__all__ = [
    "DAY1", "DAY2", "DAY3", "GROUPS", "INSTANCE", "ROLES", "everything", "grant", "live",
    "live_schema", "polled", "staging", "values",
]
