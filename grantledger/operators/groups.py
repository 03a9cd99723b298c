"""Directory-group membership, expanded through nested groups.

Edges are (account_name, type, permission_path): the account is a direct
member of the group `permission_path`. Only edges between groups are walked
round by round; the far larger number of user edges is joined once at the end.
Every round is written to the shared folder, and pairs already found are not
followed again, so cycles end and any depth is covered.

Who is a member, without the depth, is found over components: groups that are
members of each other are one node while paths are doubled, and are listed one
by one only in the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantledger.functions.labels import status_text
from grantledger.operators.condense import cyclic_components
from grantledger.operators.skew import spread_join
from grantledger.schemas import GROUPS
from grantledger.session import settle

GROUP_TYPE = "group"


def group_logins(logins: DataFrame) -> DataFrame:
    """Names of the logins that are directory groups: the roots of the walk."""
    return logins.filter(F.col("isntgroup") == 1).select(F.col("name").alias("group")).distinct()


def _nested(edges: DataFrame) -> DataFrame:
    """Group-in-group edges as (child, parent)."""
    return (
        edges.filter(F.col("type") == GROUP_TYPE)
        .select(F.col("account_name").alias("child"), F.col("permission_path").alias("parent"))
        .distinct()
    )


def _links(edges: DataFrame) -> DataFrame:
    return _nested(edges).filter(F.col("child") != F.col("parent"))


def group_paths(edges: DataFrame) -> DataFrame:
    """All (child, ancestor, depth) among groups, with the smallest depth per pair.

    Each round doubles the covered depth: a shortest path longer than `reach`
    starts with a shortest path of exactly `reach`, followed by a known one.
    A hierarchy of depth d takes log2(d) rounds.
    """
    found = settle(_links(edges).withColumn("depth", F.lit(1)), "paths").withColumnRenamed(
        "parent", "ancestor"
    )
    reach = 1
    while True:
        start = found.filter(F.col("depth") == reach).select("child", F.col("ancestor").alias("mid"))
        rest = found.withColumnsRenamed({"child": "mid"})
        longer = (
            spread_join(start, rest, ["mid"])
            .filter(F.col("child") != F.col("ancestor"))
            .groupBy("child", "ancestor")
            .agg((F.min("depth") + reach).alias("depth"))
            .join(found, ["child", "ancestor"], "left_anti")
        )
        longer = settle(longer, "paths")
        if longer.isEmpty():
            return found
        found = found.unionByName(longer)
        reach *= 2


def groups_below(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """The root groups and all groups nested anywhere below them, as `ancestor`.

    Walked from the roots down, a level in each round, so edges out of their
    reach are not followed.
    """
    links = _links(edges)
    found = settle(roots.select(F.col("group").alias("ancestor")).distinct(), "groups")
    level = found
    while True:
        below = links.join(level.select(F.col("ancestor").alias("parent")), "parent", "left_semi")
        level = settle(
            below.select(F.col("child").alias("ancestor")).distinct().join(found, "ancestor", "left_anti"), "groups"
        )
        if level.isEmpty():
            return found
        found = found.unionByName(level)


def closure(edges: DataFrame, roots: DataFrame | None = None) -> DataFrame:
    """(account_name, ancestor, depth) over any number of nesting levels.

    With `roots`, ancestors are the roots and the groups below them, and only
    edges into these are walked.
    """
    if roots is not None:
        wanted = groups_below(edges, roots).withColumnRenamed("ancestor", "permission_path")
        edges = settle(edges.join(wanted, "permission_path", "left_semi"), "edges")
    paths = group_paths(edges)
    direct = edges.select(
        "account_name", F.col("permission_path").alias("ancestor"), F.lit(1).alias("depth")
    )
    nested = spread_join(
        edges.select("account_name", F.col("permission_path").alias("child")).distinct(),
        paths,
        ["child"],
    ).select("account_name", "ancestor", (F.col("depth") + 1).alias("depth"))
    return (
        direct.unionByName(nested)
        .filter(F.col("account_name") != F.col("ancestor"))
        .groupBy("account_name", "ancestor")
        .agg(F.min("depth").alias("depth"))
    )


def memberships(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """(account_name, ancestor) over any number of nesting levels, each pair once.

    The pairs of `closure` without their depth. A cycle of n groups is one node
    while groups below the roots and paths are walked; its n * n pairs are rows
    of the result alone.
    """
    parts = cyclic_components(_links(edges))

    def node(frame: DataFrame, column: str) -> DataFrame:
        """`frame` with the component in place of a group that lies on a cycle."""
        mapped = frame.join(parts.withColumnRenamed("group", column), column, "left")
        return mapped.withColumn(column, F.coalesce("component", column)).drop("component")

    between = node(node(_nested(edges), "child"), "parent").filter(F.col("child") != F.col("parent"))
    steps = settle(
        between.select(
            F.col("child").alias("account_name"), F.lit(GROUP_TYPE).alias("type"), F.col("parent").alias("permission_path")
        ).distinct(),
        "steps",
    )
    wanted = groups_below(steps, node(roots, "group")).withColumnRenamed("ancestor", "child")
    paths = group_paths(steps.join(wanted.withColumnRenamed("child", "permission_path"), "permission_path", "left_semi"))
    members = node(edges.select("account_name", F.col("permission_path").alias("child")), "child")
    first = settle(members.distinct().join(wanted, "child", "left_semi"), "first")
    further = spread_join(first, paths, ["child"]).select("account_name", F.col("ancestor").alias("child"))
    reached = first.unionByName(further).distinct()
    listed = reached.join(parts.withColumnsRenamed({"component": "child"}), "child", "left")
    return listed.select("account_name", F.coalesce("group", "child").alias("ancestor")).filter(
        F.col("account_name") != F.col("ancestor")
    )


def components(edges: DataFrame) -> DataFrame:
    """(group, component, size) of all groups, with the least name of those that contain each other."""
    links = _links(edges)
    alone = edges.select(F.col("permission_path").alias("group")).union(links.select("child")).dropna().distinct()
    parts = cyclic_components(links)
    every = alone.join(parts, "group", "left").select("group", F.coalesce("component", "group").alias("component"))
    return every.join(every.groupBy("component").agg(F.count(F.lit(1)).alias("size")), "component").select(
        "group", "component", "size"
    )


def _login_sids(logins: DataFrame) -> DataFrame:
    return logins.select("sid", F.col("name").alias("login")).distinct()


def direct_members(edges: DataFrame, logins: DataFrame) -> DataFrame:
    """Direct members of the group logins; the directory gives no sid for them."""
    roots = group_logins(logins).withColumnRenamed("group", "permission_path")
    sid = logins.schema["sid"].dataType
    # distinct first: the join by group then ends the plan, and a hot group can be split
    return (
        edges.select("account_name", "permission_path")
        .distinct()
        .join(roots, "permission_path", "left_semi")
        .select(
            F.lit(None).cast(sid).alias("sid"),
            F.col("account_name").alias("PrincipalName"),
            F.col("permission_path").alias("ADGroupName"),
        )
    )


def members_with_status(edges: DataFrame, logins: DataFrame) -> DataFrame:
    """Direct members of the group logins, with the status and group flag of that login.

    A member has no status of its own in the directory; it counts as enabled or
    disabled with the login of its group. A group that is several logins gives
    a row for each different status.
    """
    parents = logins.filter(F.col("isntgroup") == 1).select(
        F.col("name").alias("permission_path"), "status", "isntgroup"
    )
    rows = edges.select("account_name", "permission_path").distinct().join(parents.distinct(), "permission_path")
    return rows.select(
        F.col("account_name").alias("PrincipalName"),
        F.col("permission_path").alias("ADGroupName"),
        "status",
        "isntgroup",
        status_text(F.col("status")).alias("StatusText"),
    )


def gather(edges: DataFrame, logins: DataFrame, compat: bool = False) -> DataFrame:
    """Staging rows of the group domain.

    Strict mode lists every member under each of its groups at any depth, with
    the member's own sid. Compat mode lists direct members without a sid, and
    members of nested groups only under the parents of their group, with the
    sid of that nested group.
    """
    if not compat:
        pairs = memberships(edges, group_logins(logins))
        own = _login_sids(logins).withColumnRenamed("login", "account_name")
        return pairs.join(own, "account_name", "left").select(
            "sid",
            F.col("account_name").alias("PrincipalName"),
            F.col("ancestor").alias("ADGroupName"),
        )
    wanted = groups_below(edges, group_logins(logins))
    upper = (
        _nested(edges)
        .join(wanted.withColumnRenamed("ancestor", "parent"), "parent", "left_semi")
        .alias("u")
        .join(_login_sids(logins).alias("s"), F.col("u.child") == F.col("s.login"), "left")
        .select("sid", "child", F.col("parent").alias("ADGroupName"))
    )
    members = edges.select(
        F.col("account_name").alias("PrincipalName"), F.col("permission_path").alias("child")
    ).distinct()
    nested = spread_join(members, upper, ["child"]).select(*GROUPS.values)
    return direct_members(edges, logins).unionByName(nested).distinct()

