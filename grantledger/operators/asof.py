"""What a principal was allowed at a moment in the past, from live tables and removal histories.

A live row is valid from its poll time on, a removed one from when it was first
seen until its removal was noticed. Moments are found among the intervals by
one equi-join: time is cut into buckets, buckets are paired, pairs are paired
again, and each interval lies at the smallest such node that holds all of it.
A moment asks the nodes above it, one of each level, so the many intervals are
never repeated and the few moments are, a fixed number of times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantledger.operators.diff import FIRST_SEEN
from grantledger.operators.lookup import ASKED, OBJECT_COLUMNS, ROLE_COLUMNS, Live, Permissions, having
from grantledger.operators.skew import spread_join
from grantledger.schemas import INSTANCE, POLL, Domain
from grantledger.session import settle

AT = "Moment"
VALID_FROM = "valid_from"
VALID_TO = "valid_to"
SPAN = (VALID_FROM, VALID_TO)
#: Seconds of a bucket, and levels of nodes above buckets; the top node holds everything.
BUCKET = 900
LEVELS = 24
_NODE = ("_level", "_node")


def validity(live: DataFrame, history: DataFrame, domain: Domain) -> DataFrame:
    """Value columns, `valid_from` and `valid_to` (NULL: still live), each interval once.

    A sticky row that was recorded but stays live is one open interval. A
    history without the time of the first sight (compat runs) leaves
    `valid_from` NULL: the row counts as held ever before.
    """
    first = F.col(FIRST_SEEN) if FIRST_SEEN in history.columns else F.lit(None)
    rows = live.select(*domain.values, F.col(POLL).alias(VALID_FROM), F.lit(None).cast("timestamp").alias(VALID_TO))
    ended = history.select(*domain.values, first.cast("timestamp").alias(VALID_FROM), F.col(POLL).alias(VALID_TO))
    return (
        rows.unionByName(ended)
        .groupBy(*domain.values, VALID_FROM)
        .agg(F.when(F.bool_and(F.col(VALID_TO).isNotNull()), F.max(VALID_TO)).alias(VALID_TO))
    )


def _bucket(moment: str) -> Column:
    return F.floor(F.unix_timestamp(moment) / BUCKET)


def _placed(intervals: DataFrame) -> DataFrame:
    """Each interval with the smallest node that holds it; those with an open end lie at the top."""
    apart = _bucket(VALID_FROM).bitwiseXOR(_bucket(VALID_TO))
    level = F.when(apart == 0, 0).otherwise(F.length(F.bin(apart)))
    # NULL ends and spans beyond all levels
    level = F.when(level < LEVELS, level).otherwise(LEVELS)
    placed = intervals.withColumn(_NODE[0], level)
    node = F.expr(f"CAST(floor(floor(unix_timestamp({VALID_FROM}) / {BUCKET}) / shiftleft(1L, {_NODE[0]})) AS BIGINT)")
    return placed.withColumn(_NODE[1], F.when(F.col(_NODE[0]) < LEVELS, node).otherwise(F.lit(0)))


def _asking(moments: DataFrame) -> DataFrame:
    """A row for each node above a moment."""
    every = moments.withColumn(_NODE[0], F.explode(F.sequence(F.lit(0), F.lit(LEVELS))))
    node = F.expr(f"CAST(floor(floor(unix_timestamp({AT}) / {BUCKET}) / shiftleft(1L, {_NODE[0]})) AS BIGINT)")
    return every.withColumn(_NODE[1], F.when(F.col(_NODE[0]) < LEVELS, node).otherwise(F.lit(0)))


def held(intervals: DataFrame, asks: DataFrame, on: list[str]) -> DataFrame:
    """Intervals joined with the asks (`on`, `Moment` and more) whose moment lies in them.

    The start belongs to an interval, the end does not. A NULL in `on` or a
    NULL moment matches nothing. Keys that hold many intervals are cut into
    slices. `asks` is read several times, so it should be settled or cheap.
    """
    asks = asks.dropna(subset=[*on, AT])
    # a short list of names becomes literals, which reach the tables below `validity`
    wanted = having(intervals, on[-1], asks).join(asks.select(*on).distinct(), on, "left_semi")
    rows = settle(_placed(wanted), "intervals")
    joined = spread_join(rows, _asking(asks), [*on, *_NODE]).drop(*_NODE)
    began = F.col(VALID_FROM).isNull() | (F.col(VALID_FROM) <= F.col(AT))
    return joined.filter(began & (F.col(VALID_TO).isNull() | (F.col(AT) < F.col(VALID_TO))))


def identities_at(asks: DataFrame, past: Live) -> DataFrame:
    """(Principal, Moment, PrincipalName): each asked `name` and `Moment` with itself and its groups of then."""
    asked = settle(asks.select(F.col("name").alias(ASKED), AT).dropna().distinct(), "asked")
    own = asked.select(ASKED, AT, F.col(ASKED).alias("PrincipalName"))
    in_groups = held(past.groups, own, ["PrincipalName"]).select(ASKED, AT, F.col("ADGroupName").alias("PrincipalName"))
    return settle(own.unionByName(in_groups.dropna()).distinct(), "identities")


def _shown(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    return rows.select(ASKED, AT, *[c for c in columns if c != POLL], *SPAN)


def instance_at(who: DataFrame, past: Live) -> DataFrame:
    return _shown(held(past.instance, who, ["PrincipalName"]), INSTANCE.values)


def roles_at(who: DataFrame, past: Live) -> DataFrame:
    return _shown(held(past.roles, who, ["PrincipalName"]), ROLE_COLUMNS)


def role_permissions_at(who: DataFrame, past: Live) -> DataFrame:
    """Object permissions of the roles held at the moment, each role once for a principal and moment."""
    names = roles_at(who, past).select(ASKED, AT, "ServerName", "Scope", F.col("DatabaseRole").alias("PrincipalName"))
    names = settle(names.distinct(), "roles")
    return _shown(held(past.objects, names, ["ServerName", "Scope", "PrincipalName"]), OBJECT_COLUMNS)


def objects_at(who: DataFrame, past: Live, logins: DataFrame) -> DataFrame:
    """Object permissions of the identities, or of the sid that the principal's login has today."""
    by_name = held(past.objects, who, ["PrincipalName"])
    asked = who.select(ASKED, AT).distinct()
    sids = settle(logins.select(F.col("name").alias(ASKED), "sid").dropna().distinct().join(asked, ASKED), "sids")
    by_sid = held(past.objects, sids, ["sid"]).join(who, [ASKED, AT, "PrincipalName"], "left_anti")
    return _shown(by_name, OBJECT_COLUMNS).unionByName(_shown(by_sid, OBJECT_COLUMNS))


def permissions_at(asks: DataFrame, past: Live, logins: DataFrame) -> Permissions:
    """Effective permissions at given moments (`name`, `Moment`), in strict mode.

    `past` are the four tables of `validity`. Groups and roles count as they
    were at the moment. `logins`, which have no history, give today's sids. The
    four parts show the interval in which a row was held.
    """
    who = identities_at(asks, past)
    return Permissions(
        instance_at(who, past), roles_at(who, past), role_permissions_at(who, past), objects_at(who, past, logins)
    )
