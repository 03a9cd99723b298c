"""Comparisons within what a snapshot delivered, and those narrowed by digests."""

import random

import pytest

from grantledger.operators import coverage, diff, digests
from grantledger.schemas import GROUPS, INSTANCE, ROLES
from tests.rows import DAY1, DAY2, grant, live, polled, staging, values

DATABASES = "server_name string, name string, state_desc string, user_access_desc string"


def role(database="db", name="ann", server="srv", sid="S1", role="reader"):
    return (server, database, sid, name, "SQL_USER", role)


@pytest.fixture
def read(spark):
    listed = [
        ("srv", "db", "ONLINE", "MULTI_USER"), ("srv", "off", "OFFLINE", "MULTI_USER"),
        ("srv", "one", "ONLINE", "SINGLE_USER"), ("srv", "twice", "OFFLINE", "MULTI_USER"),
        ("srv", "twice", "ONLINE", "MULTI_USER"), ("other", "db", "RESTORING", "MULTI_USER"),
    ]
    return coverage.of_databases(spark.createDataFrame(listed, DATABASES))


BEFORE = [
    role("db", "gone"), role("db", "stays"), role("off"), role("one"), role("twice"), role("dropped"),
    role("db", server="other"), role("db", server="silent"), role("off", sid=None), (None, "db", "S1", "x", "SQL_USER", "r"),
]
NOTICED = {role("db", "gone"), role("twice"), role("dropped")}


def test_only_what_could_be_read_is_recorded(spark, read):
    before, now = live(spark, ROLES, BEFORE), staging(spark, ROLES, [role("db", "stays"), role("db", "new")])
    assert set(values(diff.removed(before, now, ROLES, DAY2, coverage=read), ROLES)) == NOTICED
    assert set(values(diff.added(before, now, ROLES, DAY2, read), ROLES)) == {role("db", "new")}
    delta = diff.changes(before, now, ROLES, coverage=read)
    after = polled(diff.next_live(before, delta, ROLES, DAY2), ROLES)
    assert after == {row: DAY1 for row in BEFORE if row not in NOTICED} | {role("db", "new"): DAY2}
    # without the coverage all of them would have gone
    assert len(values(diff.removed(before, now, ROLES, DAY2), ROLES)) == len(BEFORE) - 1


def test_compat_deletes_nothing_outside(spark, read):
    """Its match without the server reaches other servers, but not databases that could not be read."""
    before, now = live(spark, ROLES, BEFORE), staging(spark, ROLES, [role("db", "stays")])
    gone = diff.removed(before, now, ROLES, DAY2, coverage=read)
    extra = live(spark, ROLES, [role("off"), role("db", server="silent")], DAY2)  # an older notice of the same rows
    after = diff.apply_removed(before, gone.unionByName(extra), ROLES, True, DAY1, read)
    assert set(values(after, ROLES)) == set(BEFORE) - NOTICED


def test_inside_and_outside_make_up_the_whole(spark, read):
    rows = live(spark, ROLES, BEFORE + BEFORE[:2])
    both = coverage.inside(rows, read).unionByName(coverage.outside(rows, read))
    assert values(both, ROLES) == values(rows, ROLES)
    assert coverage.inside(rows, None) is rows


def test_an_empty_list_covers_nothing(spark):
    nothing = coverage.of_databases(spark.createDataFrame([], DATABASES))
    before = live(spark, ROLES, BEFORE)
    assert diff.removed(before, staging(spark, ROLES, []), ROLES, DAY2, coverage=nothing).isEmpty()


@pytest.mark.parametrize("buckets", [1, 7, digests.BUCKETS])
def test_narrowed_comparisons_find_the_same(spark, buckets):
    rng = random.Random(buckets)
    pool = [
        grant(name=rng.choice("abc"), permission=rng.choice(["x", "y", None]), sid=rng.choice(["S", None]), endpoint=f"e{i % 9}")
        for i in range(60)
    ]
    before = live(spark, INSTANCE, sorted(set(rng.sample(pool, 40)), key=str))
    now = staging(spark, INSTANCE, rng.sample(pool, 40) + pool[:3])
    narrow = digests.differing(before, now, INSTANCE, buckets)
    for side in (diff.removed, diff.added):
        assert polled(side(*narrow, INSTANCE, DAY2), INSTANCE) == polled(side(before, now, INSTANCE, DAY2), INSTANCE)


def test_a_null_that_moves_is_a_change(spark):
    before, now = live(spark, GROUPS, [(None, "a", "b")]), staging(spark, GROUPS, [("a", None, "b")])
    narrow = digests.differing(before, now, GROUPS)
    assert set(values(diff.removed(*narrow, GROUPS, DAY2), GROUPS)) == {(None, "a", "b")}


def test_a_pair_of_equal_rows_does_not_cancel_out(spark):
    before = live(spark, GROUPS, [("s", "a", "b")])
    for rows in ([], [("s", "c", "b"), ("s", "c", "b")], [("s", "a", "b")] * 3):
        narrow = digests.differing(before, staging(spark, GROUPS, rows), GROUPS)
        found = diff.removed(*narrow, GROUPS, DAY2)
        assert set(values(found, GROUPS)) == {("s", "a", "b")} - set(rows)


def test_unchanged_buckets_are_not_shuffled(spark, tmp_path):
    rows = [(f"s{i}", f"p{i}", f"g{i % 50}") for i in range(5000)]
    live(spark, GROUPS, rows).write.parquet(f"{tmp_path}/live")
    staging(spark, GROUPS, rows[:-2] + [("new", "p", "g")]).write.parquet(f"{tmp_path}/staging")
    before, now = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("live", "staging"))
    narrow = digests.differing(before, now, GROUPS)
    assert narrow[0].count() < 10 and narrow[1].count() < 10
    found = diff.changes(*narrow, GROUPS)
    assert found.count() == 3
    # each side is narrowed before the comparison's only shuffle
    plan = found._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
    assert final.count("Exchange hashpartitioning") == 1
    assert final.index("Exchange hashpartitioning") < final.index("BroadcastHashJoin")
    assert final.count("LeftSemi") == 2
