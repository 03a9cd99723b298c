"""Effective permissions of a principal, through its groups and database roles."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property, reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantledger.operators.skew import spread_join
from grantledger.schemas import INSTANCE, POLL
from grantledger.session import settle

INSTANCE_COLUMNS = (*INSTANCE.values, POLL)
OBJECT_COLUMNS = (
    "ServerName", "Scope", "PrincipalName", "ObjectType", "PermissionType",
    "PermissionState", "SchemaName", "ObjectName", "ColumnName", POLL,
)
ROLE_COLUMNS = ("ServerName", "Scope", "PrincipalName", "PrincipalType", "DatabaseRole", POLL)
ASKED = "Principal"
#: So many names become literals of a filter; longer lists are joined.
LITERALS = 10_000


class Live(NamedTuple):
    """The four live tables."""

    instance: DataFrame
    groups: DataFrame
    roles: DataFrame
    objects: DataFrame


class Permissions(NamedTuple):
    """The four parts of an answer."""

    instance: DataFrame
    roles: DataFrame
    role_permissions: DataFrame
    objects: DataFrame


def identities(principal: str, groups: DataFrame) -> DataFrame:
    """The principal's own name and the groups it is mapped to, as `PrincipalName`."""
    own = groups.sparkSession.range(1).select(F.lit(principal).alias("PrincipalName"))
    in_groups = groups.filter(F.col("PrincipalName") == principal).select(
        F.col("ADGroupName").alias("PrincipalName")
    )
    return own.unionByName(in_groups.dropna()).distinct()


def _listed(rows: DataFrame, column: str) -> list | None:
    """The distinct values of a settled column, or None if they are many."""
    values = rows.select(column).distinct().limit(LITERALS + 1).collect()
    return [row[0] for row in values] if len(values) <= LITERALS else None


def having(table: DataFrame, column: str, rows: DataFrame) -> DataFrame:
    """Rows of `table` whose `column` is among that of `rows`.

    A short list is a filter with literals, which reaches the scan: live files
    are sorted by principal, so most of their row groups and pages are skipped.
    """
    values = _listed(rows, column)
    if values is None:
        return table.join(rows.select(column).distinct(), column, "left_semi")
    return table.filter(F.col(column).isin(values))


def _of_either(objects: DataFrame, who: DataFrame, sids: DataFrame) -> DataFrame:
    """Objects with the principal name of a row of `who` or the sid of a row of `sids`; one read of the objects."""
    names, numbers = _listed(who, "PrincipalName"), _listed(sids, "sid")
    if names is not None and numbers is not None:
        return objects.filter(F.col("PrincipalName").isin(names) | F.col("sid").isin(numbers))
    # both conditions of the OR as flags, so the objects are read once
    flagged = objects.join(
        who.select("PrincipalName").distinct().withColumn("by_name", F.lit(True)), "PrincipalName", "left"
    ).join(sids.select("sid").distinct().withColumn("by_sid", F.lit(True)), "sid", "left")
    return flagged.filter(F.col("by_name").isNotNull() | F.col("by_sid").isNotNull()).select(*objects.columns)


def instance_part(who: DataFrame, live: Live) -> DataFrame:
    """Instance permissions of the identities."""
    return having(live.instance, "PrincipalName", who).select(*INSTANCE_COLUMNS)


def roles_part(
    who: DataFrame, live: Live, server_name: str | None = None, compat: bool = False
) -> DataFrame:
    """Database roles the identities hold; compat mode shows `server_name` on them."""
    held = having(live.roles, "PrincipalName", who).select(*ROLE_COLUMNS)
    if compat and server_name is not None:
        held = held.withColumn("ServerName", F.lit(server_name))
    return held


def role_permissions_part(who: DataFrame, live: Live, compat: bool = False) -> DataFrame:
    """Object permissions of those roles.

    Compat mode ignores the server and repeats a role's permissions for each
    identity that holds the role.
    """
    key = ["Scope", "PrincipalName"] if compat else ["ServerName", "Scope", "PrincipalName"]
    held = having(live.roles, "PrincipalName", who)
    names = held.drop("PrincipalName").withColumnRenamed("DatabaseRole", "PrincipalName")
    names = settle(names.select(*key) if compat else names.select(*key).distinct(), "roles")
    return having(live.objects, "PrincipalName", names).join(names, key, "inner").select(*OBJECT_COLUMNS)


def objects_part(principal: str, who: DataFrame, live: Live, logins: DataFrame) -> DataFrame:
    """Object permissions of the identities, or of the sid of the principal's login; one read of the objects."""
    sids = settle(
        logins.filter(F.col("name") == principal).select("sid").dropna().distinct(), "sids"
    )
    return _of_either(live.objects, who, sids).select(*OBJECT_COLUMNS)


def permissions(
    principal: str,
    live: Live,
    logins: DataFrame,
    server_name: str | None = None,
    compat: bool = False,
) -> Permissions:
    """Effective permissions of one principal.

    The principal's identities, roles and sids are settled first: their size is
    then known, and where it is small the live tables are read without a shuffle.
    """
    who = settle(identities(principal, live.groups), "identities")
    return Permissions(
        instance_part(who, live),
        roles_part(who, live, server_name, compat),
        role_permissions_part(who, live, compat),
        objects_part(principal, who, live, logins),
    )


def identities_of(principals: DataFrame, groups: DataFrame) -> DataFrame:
    """(Principal, PrincipalName): each asked principal with itself and its groups."""
    asked = principals.select(F.col("name").alias(ASKED)).dropna().distinct()
    in_groups = (
        groups.select(F.col("PrincipalName").alias(ASKED), "ADGroupName")
        .join(asked, ASKED, "left_semi")
        .select(ASKED, F.col("ADGroupName").alias("PrincipalName"))
    )
    own = asked.select(ASKED, F.col(ASKED).alias("PrincipalName"))
    return own.unionByName(in_groups.dropna()).distinct()


def _met(table: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """`spread_join` of the rows of `table` that have a principal of the settled `right`.

    These rows alone are written, so that hot keys are counted and joined
    without a further reading of the whole table.
    """
    return spread_join(settle(having(table, "PrincipalName", right), "met"), right, on)


class BatchPermissions:
    """The four parts of the answers for several principals, each found when it is first asked for."""

    def __init__(self, who: DataFrame, live: Live, logins: DataFrame) -> None:
        self._who, self._live, self._logins = who, live, logins

    def __iter__(self) -> Iterator[DataFrame]:
        return (getattr(self, part) for part in Permissions._fields)

    @cached_property
    def instance(self) -> DataFrame:
        rows = self._live.instance.select(*INSTANCE_COLUMNS)
        return _met(rows, self._who, ["PrincipalName"]).select(ASKED, *INSTANCE_COLUMNS)

    @cached_property
    def roles(self) -> DataFrame:
        rows = self._live.roles.select(*ROLE_COLUMNS)
        return _met(rows, self._who, ["PrincipalName"]).select(ASKED, *ROLE_COLUMNS)

    @cached_property
    def role_permissions(self) -> DataFrame:
        names = self.roles.select(ASKED, "ServerName", "Scope", F.col("DatabaseRole").alias("PrincipalName"))
        names = settle(names.distinct(), "roles")
        rows = self._live.objects.select(*OBJECT_COLUMNS)
        return _met(rows, names, ["ServerName", "Scope", "PrincipalName"]).select(ASKED, *OBJECT_COLUMNS)

    @cached_property
    def objects(self) -> DataFrame:
        who = self._who
        sids = settle(
            self._logins.select(F.col("name").alias(ASKED), "sid")
            .join(who.select(ASKED).distinct(), ASKED, "left_semi")
            .dropna()
            .distinct(),
            "sids",
        )
        rows = settle(_of_either(self._live.objects.select("sid", *OBJECT_COLUMNS), who, sids), "met")
        by_name = spread_join(rows.select(*OBJECT_COLUMNS), who, ["PrincipalName"])
        by_sid = spread_join(rows, sids, ["sid"]).join(who, [ASKED, "PrincipalName"], "left_anti")
        columns = [ASKED, *OBJECT_COLUMNS]
        return by_name.select(*columns).unionByName(by_sid.select(*columns))


def permissions_of(principals: DataFrame, live: Live, logins: DataFrame) -> BatchPermissions:
    """Effective permissions of several principals (column `name`), in strict mode.

    Same four parts with the asked principal as first column. A table is read
    once, for the parts that are asked for, and what it has of the identities
    is the left side of the spread joins, so a name or role holding a large
    share of all rows is cut into slices.
    """
    return BatchPermissions(settle(identities_of(principals, live.groups), "identities"), live, logins)


def summary(principals: DataFrame, live: Live, logins: DataFrame) -> DataFrame:
    """How many permission rows each principal has in each part of its answer.

    Grants are counted per identity before they meet the identities, so the
    work follows the size of the tables and not the number of answer rows. The
    objects are read once.
    """
    who = settle(identities_of(principals, live.groups), "identities")

    def total(rows: DataFrame, part: str) -> DataFrame:
        return rows.groupBy(ASKED).agg(F.sum("n").alias("n")).withColumn("part", F.lit(part))

    def counted(df: DataFrame, *keys: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))

    def merged(counts: DataFrame, *keys: str) -> DataFrame:
        return counts.groupBy(*keys).agg(F.sum("n").alias("n"))

    in_scope = ["ServerName", "Scope", "PrincipalName"]
    objects = settle(counted(live.objects, *in_scope, "sid"), "counts")
    holders = (
        who.join(
            live.roles.select("ServerName", "Scope", "PrincipalName", "DatabaseRole").distinct(),
            "PrincipalName",
        )
        .select(ASKED, "ServerName", "Scope", F.col("DatabaseRole").alias("PrincipalName"))
        .distinct()
    )
    sids = (
        logins.select(F.col("name").alias(ASKED), "sid")
        .join(who.select(ASKED).distinct(), ASKED, "left_semi")
        .dropna()
        .distinct()
    )
    by_name = ["PrincipalName"]
    # rows found by sid only; a NULL principal name is nobody's identity
    by_sid = sids.join(merged(objects, "sid", "PrincipalName"), "sid").join(
        who, [ASKED, "PrincipalName"], "left_anti"
    )
    parts = (
        total(who.join(counted(live.instance, *by_name), by_name), "instance"),
        total(who.join(counted(live.roles, *by_name), by_name), "roles"),
        total(holders.join(merged(objects, *in_scope), in_scope), "role_permissions"),
        total(who.join(merged(objects, *by_name), by_name), "objects"),
        total(by_sid, "objects"),
    )
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy(ASKED, "part")
        .agg(F.sum("n").alias("n"))
    )
