"""Lookups in the past, renamed principals and nested roles, against plain Python."""

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from grantledger.operators import asof, lookup, nested_roles, renames
from grantledger.schemas import GROUPS, INSTANCE, OBJECTS, POLL, ROLES
from tests.rows import DAY1, DAY2, DAY3, everything, grant, live, staging

SPANS = "name string, valid_from timestamp, valid_to timestamp"
START = datetime(2024, 1, 1)


def moments(spark, rows):
    return spark.createDataFrame(rows, "name string, Moment timestamp")


@pytest.mark.parametrize("seed", range(3))
def test_held_equals_a_nested_loop(spark, seed):
    rng = random.Random(seed)

    def time():
        return START + timedelta(seconds=rng.choice([0, 1, 899, 900, 901, 86_400, 10**8]) * rng.randrange(-3, 4))

    spans = set()
    for _ in range(60):
        begin, end = sorted([time(), time()])
        spans.add((rng.choice(["a", "b", None]), rng.choice([begin, begin, None]), rng.choice([end, end, None])))
    asks = {(rng.choice(["a", "b", "c", None]), rng.choice([time(), None])) for _ in range(40)}
    # the limits of intervals are moments too
    asks |= {(n, t) for n, *ends in spans for t in ends if rng.random() < 0.5}
    got = asof.held(
        spark.createDataFrame(sorted(spans, key=str), SPANS), moments(spark, sorted(asks, key=str)), ["name"]
    ).select("name", "Moment", "valid_from", "valid_to")
    expected = Counter(
        (n, t, a, b)
        for n, a, b in spans for m, t in asks
        if n is not None and n == m and t is not None and (a is None or a <= t) and (b is None or t < b)
    )
    assert everything(got) == expected


def test_held_long_before_the_first_bucket_and_after_the_last(spark):
    far = [datetime(1901, 1, 1), datetime(1969, 12, 31, 23, 59), datetime(1970, 1, 1), datetime(2900, 1, 1)]
    spans = [("a", b, e) for i, b in enumerate(far) for e in far[i + 1:]]
    got = asof.held(spark.createDataFrame(spans, SPANS), moments(spark, [("a", t) for t in far]), ["name"])
    assert got.count() == sum(b <= t < e for _, b, e in spans for t in far)


def test_intervals_are_not_repeated(spark):
    """The many intervals meet the moments at one node each."""
    spans = [("a", START + timedelta(hours=i), START + timedelta(hours=i + 5)) for i in range(50)]
    placed = asof._placed(spark.createDataFrame(spans, SPANS))
    assert placed.count() == len(spans)
    # and short ones stay below the top
    assert placed.filter(F.col("_level") == asof.LEVELS).isEmpty()


def test_validity_of_live_removed_and_sticky_rows(spark):
    stays, gone = grant("ann"), grant("bob")
    sticky = grant("cy", permission="CONNECT SQL")
    history = live(spark, INSTANCE, [gone, sticky], DAY2).withColumn("first_seen", F.lit(DAY1).cast("timestamp"))
    rows = asof.validity(live(spark, INSTANCE, [stays, sticky, (*gone, DAY3)]), history, INSTANCE)
    shown = rows.select(
        "PrincipalName", *[F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("valid_from", "valid_to")]
    )
    assert everything(shown) == Counter(
        [("ann", DAY1, None), ("cy", DAY1, None), ("bob", DAY1, DAY2), ("bob", DAY3, None)]
    )


def test_permissions_at_follow_groups_and_roles_of_the_moment(spark):
    def past(domain, rows):
        """Rows with the days from and to which they were held."""
        width = len(domain.values)
        frame = live(spark, domain, [r[:width] for r in rows]).drop(POLL)
        times = spark.createDataFrame([r for r in rows], frame.schema.add("valid_from", "string").add("valid_to", "string"))
        return times.withColumns({c: F.col(c).cast("timestamp") for c in asof.SPAN})

    def grant_to(name, obj, sid=None):
        return ("s", "d", sid, name, "VIEW", "SELECT", "GRANT", "dbo", obj, "N/A")

    tables = lookup.Live(
        past(INSTANCE, [(*grant("g"), DAY1, None), (*grant("ann", "ALTER"), DAY2, DAY3)]),
        past(GROUPS, [(None, "ann", "g", DAY1, DAY2)]),
        past(ROLES, [("s", "d", None, "g", "SQL_USER", "r", DAY1, None), ("s", "d", None, "ann", "SQL_USER", "q", DAY2, None)]),
        past(OBJECTS, [
            (*grant_to("r", "of r"), DAY1, None), (*grant_to("q", "of q"), DAY1, DAY3),
            (*grant_to("ann", "own"), DAY2, None), (*grant_to("other", "by sid", "S9"), DAY1, DAY2),
        ]),
    )
    logins = spark.createDataFrame([("S9", "ann"), (None, "bob")], "sid string, name string")
    asks = spark.createDataFrame(
        [(n, t) for n in ("ann", "bob", None) for t in ("2023-12-31 00:00:00", DAY1, DAY2, DAY3)], "name string, Moment string"
    ).withColumn("Moment", F.col("Moment").cast("timestamp"))
    answer = asof.permissions_at(asks, tables, logins)

    def by_day(part, *columns):
        day = F.date_format("Moment", "yyyy-MM-dd HH:mm:ss")
        return everything(part.select("Principal", day, *columns))

    assert by_day(answer.instance, "PermissionType") == Counter([("ann", DAY1, "VIEW"), ("ann", DAY2, "ALTER")])
    assert by_day(answer.roles, "DatabaseRole") == Counter([("ann", DAY1, "r"), ("ann", DAY2, "q"), ("ann", DAY3, "q")])
    assert by_day(answer.role_permissions, "ObjectName") == Counter([("ann", DAY1, "of r"), ("ann", DAY2, "of q")])
    assert by_day(answer.objects, "ObjectName") == Counter(
        [("ann", DAY1, "by sid"), ("ann", DAY2, "own"), ("ann", DAY3, "own")]
    )


def changed(spark, before, after):
    rows = renames.principal_changes(live(spark, INSTANCE, before), staging(spark, INSTANCE, after))
    return everything(rows.select("sid", "OldName", "OldType", "NewName", "NewType", "change"))


def test_a_sid_pairs_old_and_new_names(spark):
    kind = "SQL_LOGIN"
    before = [grant("ann", sid="1"), grant("ann", "ALTER", sid="1"), grant("bob", sid="2"), grant("x", sid=None)]
    after = [grant("anna", sid="1"), grant("cy", sid="3"), grant("y", sid=None)]
    assert changed(spark, before, after) == Counter([
        ("1", "ann", kind, "anna", kind, "renamed"), ("2", "bob", kind, None, None, "dropped"),
        ("3", None, None, "cy", kind, "new"), (None, "x", kind, None, None, "dropped"), (None, None, None, "y", kind, "new"),
    ])


def test_ties_are_paired_by_rank_after_kept_names(spark):
    kind, other = "SQL_LOGIN", "WINDOWS_LOGIN"
    before = [grant(n, sid="1") for n in ("c", "a", "b", "k")]
    after = [grant("z", sid="1"), grant("y", sid="1"), grant("k", sid="1", kind=other)]
    expected = Counter([
        ("1", "k", kind, "k", other, "retyped"), ("1", "a", kind, "y", kind, "renamed"),
        ("1", "b", kind, "z", kind, "renamed"), ("1", "c", kind, None, None, "dropped"),
    ])
    assert changed(spark, before, after) == changed(spark, before[::-1], after[::-1]) == expected


def test_equal_sids_of_two_servers_are_not_paired_and_empty_tables_give_nothing(spark):
    kind = "SQL_LOGIN"
    got = changed(spark, [grant("a", sid="1", server="s")], [grant("b", sid="1", server="t")])
    assert got == Counter([("1", "a", kind, None, None, "dropped"), ("1", None, None, "b", kind, "new")])
    assert changed(spark, [], []) == Counter()


@pytest.mark.parametrize("seed", range(2))
def test_nested_roles_equal_a_walk(spark, seed):
    rng = random.Random(seed)
    names = [f"r{i}" for i in range(6)]
    roles = {
        (rng.choice("st"), rng.choice(["d1", "d2"]), None, rng.choice(names), "DATABASE_ROLE", rng.choice(names))
        for _ in range(30)
    } | {(rng.choice("st"), "d1", None, n, "SQL_USER", rng.choice(names)) for n in ("ann", "g", "bob")}
    # a cycle, and rows with a NULL
    roles |= {("s", "d1", None, "r0", "DATABASE_ROLE", "r1"), ("s", "d1", None, "r1", "DATABASE_ROLE", "r0")}
    roles |= {("s", "d1", None, "r0", "DATABASE_ROLE", None), (None, "d1", None, "ann", "SQL_USER", "r0")}
    state = lookup.Live(
        live(spark, INSTANCE, []), live(spark, GROUPS, [(None, "ann", "g")]), live(spark, ROLES, sorted(roles, key=str)),
        live(spark, OBJECTS, [(s, d, None, r, "VIEW", "SELECT", "GRANT", "dbo", r, "N/A") for s in "st" for d in ("d1", "d2") for r in names]),
    )
    asked = spark.createDataFrame([("ann",), ("bob",), (None,), ("nobody",)], "name string")
    above = defaultdict(set)
    for s, d, _, member, kind, role in roles:
        if kind == "DATABASE_ROLE" and role is not None:
            above[s, d, member].add(role)
    expected = set()
    for person, who in (("ann", {"ann", "g"}), ("bob", {"bob"})):
        first = {(s, d, role) for s, d, _, member, _, role in roles if member in who and None not in (s, role)}
        seen, todo = set(first), list(first)
        while todo:
            s, d, role = todo.pop()
            fresh = {(s, d, up) for up in above[s, d, role]} - seen
            seen |= fresh
            todo += fresh
        expected |= {(person, *place, place in first) for place in seen}
    assert everything(nested_roles.roles_of(asked, state)) == Counter(expected)
    got = nested_roles.role_permissions_of(asked, state).select("Principal", "ServerName", "Scope", "PrincipalName")
    assert everything(got) == Counter(row[:4] for row in expected)


def test_only_the_intervals_of_the_asked_are_grouped(spark, monkeypatch):
    """The asked names are a filter below the grouping of `validity`, on live and history alike."""
    spans = asof.validity(
        live(spark, ROLES, [("s", "d", None, n, "SQL_USER", "r") for n in ("ann", "bob")]),
        live(spark, ROLES, [("s", "d", None, "ann", "SQL_USER", "r2")], poll=DAY2),
        ROLES,
    )
    asks = spark.createDataFrame([("ann", DAY1)], "PrincipalName string, Moment string")
    asks = asks.withColumn("Moment", F.col("Moment").cast("timestamp"))
    plans = []
    settle = asof.settle

    def noted(rows, label):
        if label == "intervals":
            plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return settle(rows, label)

    monkeypatch.setattr(asof, "settle", noted)
    assert asof.held(spans, asks, ["PrincipalName"]).count() == 2
    below = plans[0].partition("Union")[2].rpartition("Aggregate [")[0]
    assert below.count("= ann)") == 2, plans[0]
