"""Database roles that hold other roles: what a principal may do through all of them.

A way leads from a person to its groups, from these to roles, and from role to
role within a database. Roles of all databases and servers are walked at once:
a node is named by server, database and role together, so equal names in two
databases stay apart. Roles that hold each other are one node of the walk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantledger.operators.groups import GROUP_TYPE, memberships
from grantledger.operators.lookup import ASKED, OBJECT_COLUMNS, Live, identities_of
from grantledger.operators.skew import spread_join
from grantledger.session import settle

ROLE_TYPE = "DATABASE_ROLE"
_PLACE = ["ServerName", "Scope"]


def _node(name: str) -> Column:
    """Server, database and role as one text that can be read back."""
    return F.to_json(F.array(*_PLACE, name))


def role_ancestors(roles: DataFrame) -> DataFrame:
    """(ServerName, Scope, DatabaseRole, Ancestor): roles and the roles that hold them, at any depth.

    From rows of the role domain whose member is a role itself. A role is no
    ancestor of its own, also on a cycle; rows with a NULL are left out.
    """
    links = roles.filter(F.col("PrincipalType") == ROLE_TYPE).dropna(subset=[*_PLACE, "PrincipalName", "DatabaseRole"])
    edges = settle(
        links.select(
            _node("PrincipalName").alias("account_name"),
            F.lit(GROUP_TYPE).alias("type"),
            _node("DatabaseRole").alias("permission_path"),
        ).distinct(),
        "role-edges",
    )
    pairs = memberships(edges, edges.select(F.col("permission_path").alias("group")).distinct())
    low, high = (F.from_json(c, "array<string>") for c in ("account_name", "ancestor"))
    return pairs.select(
        low[0].alias("ServerName"), low[1].alias("Scope"), low[2].alias("DatabaseRole"), high[2].alias("Ancestor")
    )


def roles_of(principals: DataFrame, live: Live) -> DataFrame:
    """(Principal, ServerName, Scope, DatabaseRole, direct): all roles of the asked principals (column `name`).

    `direct` says whether the principal or one of its groups is a member of the role itself.
    """
    who = settle(identities_of(principals, live.groups), "identities")
    place = [*_PLACE, "DatabaseRole"]
    held = spread_join(live.roles.select(*place, "PrincipalName"), who, ["PrincipalName"])
    first = settle(held.select(ASKED, *place).dropna().distinct(), "roles")
    further = spread_join(first, role_ancestors(live.roles), place).select(
        ASKED, *_PLACE, F.col("Ancestor").alias("DatabaseRole")
    )
    every = first.withColumn("direct", F.lit(True)).unionByName(further.withColumn("direct", F.lit(False)))
    return every.groupBy(ASKED, *place).agg(F.max("direct").alias("direct"))


def role_permissions_of(principals: DataFrame, live: Live) -> DataFrame:
    """Object permissions of all roles of the asked principals, nested ones too; each once for a principal and role."""
    names = settle(roles_of(principals, live), "nested-roles").select(
        ASKED, *_PLACE, F.col("DatabaseRole").alias("PrincipalName")
    )
    rows = spread_join(live.objects.select(*OBJECT_COLUMNS), names, [*_PLACE, "PrincipalName"])
    return rows.select(ASKED, *OBJECT_COLUMNS)
