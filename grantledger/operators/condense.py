"""Groups that are members of each other, found as strongly connected components.

Links are (child, parent). Groups without a link in or out are peeled off first,
which is all of it in a directory without cycles. What is left is coloured in
both directions: every group learns the least group it reaches and the least one
that reaches it. Groups go by numbers meanwhile, which are dealt anew for each
colouring. Where both are the same group, the component of that group is found;
a link between groups that differ in either cannot lie on a cycle and is cut.

A round of colouring holds a few rows for each link, however long the cycles. A
group also takes over what its present colours have learned, and what a group
further up and one further down have learned, at distances that double in each
round: a plain ring of n groups is done after about log2 n rounds. Where a ring
has further links, a jump may leave it, and in the worst case news goes round it
one group in a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantledger.session import settle

_COLOURS = ("ahead", "behind")
#: The group further on in the direction of each colour.
_JUMPS = {"ahead": "up", "behind": "down"}


def _peeled(links: DataFrame) -> DataFrame:
    """Links without those of groups at an end, while that takes half of them in a round."""
    links = settle(links, "links")
    size = links.count()
    while size:
        ends = links.select("child").distinct(), links.select("parent").distinct()
        inner = links.join(ends[0].withColumnRenamed("child", "parent"), "parent", "left_semi").join(
            ends[1].withColumnRenamed("parent", "child"), "child", "left_semi"
        )
        links = settle(inner.select("child", "parent"), "links")
        left = links.count()
        if 2 * left > size:
            return links
        size = left
    return links


def _numbered(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(group, number), and the links by numbers."""
    groups = links.select(F.col("child").alias("group")).union(links.select("parent")).distinct()
    names = settle(groups.withColumn("number", F.monotonically_increasing_id()), "names")
    for side in ("child", "parent"):
        of = names.select(F.col("group").alias(side), F.col("number").alias(f"{side}_number"))
        links = links.join(of, side)
    return names, links.select(*[F.col(f"{side}_number").alias(side) for side in ("child", "parent")])


def _dealt(frame: DataFrame, *columns: str) -> DataFrame:
    """Other numbers in place of these; the hash of one long is a permutation, so different ones stay different."""
    return frame.withColumns({c: F.xxhash64(c) for c in columns})


def _offers(groups: DataFrame, links: DataFrame) -> DataFrame:
    """What each group may take: its own colours, its neighbours', its colours' own and its jumps'.

    All that is asked for is one join with the groups.
    """
    def asks(frame: DataFrame, group: str, of: str, colour: str) -> DataFrame:
        return frame.select(F.col(group).alias("group"), F.col(of).alias("_of"), F.lit(colour).alias("_colour"))

    wanted = (
        asks(links, "child", "parent", "ahead")
        .unionByName(asks(links, "parent", "child", "behind"))
        .unionByName(asks(groups, "group", "ahead", "ahead"))
        .unionByName(asks(groups, "group", "behind", "behind"))
        .unionByName(asks(groups, "group", "up", "up"))
        .unionByName(asks(groups, "group", "down", "down"))
    )
    known = groups.select(*[F.col(c).alias("_of" if c == "group" else f"_{c}") for c in groups.columns])
    taken = wanted.join(known, "_of").select(
        "group",
        *[F.when(F.col("_colour").isin(c, j), F.col(f"_{c}")).alias(c) for c, j in _JUMPS.items()],
        *[F.when(F.col("_colour") == j, F.col(f"_{j}")).alias(j) for j in _JUMPS.values()],
    )
    own = groups.select("group", *_COLOURS, *[F.col(c).alias(f"was_{c}") for c in [*_COLOURS, *_JUMPS.values()]])
    return own.unionByName(taken, allowMissingColumns=True)


def _coloured(links: DataFrame) -> DataFrame:
    """(group, ahead, behind): the least group it reaches and the least that reaches it."""
    ends = links.select(F.col("child").alias("group"), F.col("parent").alias("up"), F.lit(None).cast("long").alias("down"))
    names = ends.union(links.select("parent", F.lit(None).cast("long"), "child"))
    first = names.groupBy("group").agg(F.min("up").alias("up"), F.min("down").alias("down"))
    groups = settle(first.select("*", *[F.col("group").alias(c) for c in _COLOURS]), "colours")
    while True:
        best = _offers(groups, links).groupBy("group").agg(
            *[F.min(c).alias(c) for c in _COLOURS],
            *[F.max(f"was_{c}").alias(f"was_{c}") for c in _COLOURS],
            *[F.coalesce(F.max(j), F.max(f"was_{j}")).alias(j) for j in _JUMPS.values()],
        )
        moved = (F.col("ahead") != F.col("was_ahead")) | (F.col("behind") != F.col("was_behind"))
        step = settle(best.select(*groups.columns, moved.alias("moved")), "colours")
        groups = step.drop("moved")
        if step.filter("moved").isEmpty():
            return groups


def cyclic_components(links: DataFrame) -> DataFrame:
    """(group, component) of the groups that lie on a cycle of two or more groups.

    `component` is the least name in the component. A link from a group to
    itself and links with a NULL are no cycle; repeated links count once.
    """
    links = _peeled(links.select("child", "parent").filter(F.col("child") != F.col("parent")).distinct())
    if links.isEmpty():
        return links.select(F.col("child").alias("group"), F.col("child").alias("component"))
    names, links = _numbered(links)
    parts: DataFrame | None = None
    while not links.isEmpty():
        names, links = _dealt(names, "number"), settle(_dealt(links, "child", "parent"), "links")
        if parts is not None:
            parts = _dealt(parts, "number", "component")
        groups = _coloured(links)
        done = groups.filter(F.col("ahead") == F.col("behind")).select(
            F.col("group").alias("number"), F.col("ahead").alias("component")
        )
        parts = done if parts is None else parts.unionByName(done)
        open_ = groups.filter(F.col("ahead") != F.col("behind"))
        sides = [
            open_.select(F.col("group").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in _COLOURS])
            for side in ("child", "parent")
        ]
        kept = links.join(sides[0], "child").join(sides[1], "parent").filter(
            (F.col("child_ahead") == F.col("parent_ahead")) & (F.col("child_behind") == F.col("parent_behind"))
        )
        links = _peeled(kept.select("child", "parent"))
    parts = settle(parts.join(names, "number").select("group", "component"), "parts")
    named = parts.groupBy("component").agg(F.min("group").alias("least"), F.count(F.lit(1)).alias("size"))
    return settle(
        parts.join(named.filter("size > 1"), "component").select("group", F.col("least").alias("component")),
        "components",
    )
