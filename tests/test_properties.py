"""Random snapshots against a plain-Python model."""

import random
from collections import Counter

import pytest

from grantledger.operators import diff
from grantledger.operators.skew import spread_join
from grantledger.schemas import GROUPS, INSTANCE, PRINCIPALS
from tests.rows import DAY2, DAY3, everything, live, polled, staging, values

CONNECT = "CONNECT SQL"


def random_grants(rng, size):
    return [
        (
            rng.choice(["s1", "s2"]), "Instance-Level", rng.choice([None, "A", "B"]),
            rng.choice(["ann", "bob", "cy"]), rng.choice([None, "SQL_LOGIN"]), rng.choice(["Yes", "No"]),
            rng.choice([CONNECT, "VIEW", "ALTER"]), rng.choice(["GRANT", "DENY"]), "SERVER", "N/A",
        )
        for _ in range(size)
    ]


def model(before, now, key_of, principal_of):
    """Strict instance state after a run, row by row."""
    new = now - before
    new_keys = {key_of(r) for r in new}
    principals = {principal_of(r) for r in now}
    kept = {
        r for r in before - now
        if r[6] == CONNECT and principal_of(r) in principals and key_of(r) not in new_keys
    }
    return (before & now) | kept | new


def positions(names):
    return lambda row: tuple(row[INSTANCE.values.index(n)] for n in names)


@pytest.mark.parametrize("seed, partitions", [(0, "1"), (1, "7"), (2, "4")])
def test_instance_run_matches_model(spark, conf, seed, partitions):
    conf(spark__sql__shuffle__partitions=partitions)
    rng = random.Random(seed)
    before, now = set(random_grants(rng, 60)), random_grants(rng, 60)
    frame, snapshot = live(spark, INSTANCE, sorted(before, key=str)), staging(spark, INSTANCE, now)
    expected = model(before, set(now), positions(INSTANCE.update_key), positions(PRINCIPALS.values))

    delta = diff.changes(frame, snapshot, INSTANCE)
    gone = diff.removed(frame, snapshot, INSTANCE, DAY2)
    assert values(gone, INSTANCE) == Counter(before - set(now))
    dropped = diff.dropped_principals(delta, snapshot, DAY2).select(*PRINCIPALS.values)
    whole = diff.removed(frame, snapshot, PRINCIPALS, DAY2).select(*PRINCIPALS.values)
    assert everything(dropped) == everything(whole)
    after = diff.next_live(frame, delta, INSTANCE, DAY2, dropped)
    assert values(after, INSTANCE) == Counter(expected)

    step = diff.apply_removed(frame, gone, INSTANCE)
    step = diff.apply_removed(step, dropped, PRINCIPALS)
    assert polled(diff.upsert(step, snapshot, DAY2), INSTANCE) == polled(after, INSTANCE)


@pytest.mark.parametrize("seed", range(2))
def test_plain_domain_follows_snapshot_and_settles(spark, seed):
    rng = random.Random(seed)

    def rows():
        return [
            (rng.choice([None, "S"]), rng.choice("abcd"), rng.choice(["g", "h", None]))
            for _ in range(15)
        ]

    before, now = set(rows()), rows()
    frame, snapshot = live(spark, GROUPS, sorted(before, key=str)), staging(spark, GROUPS, now)
    after = diff.upsert(frame, snapshot, DAY2, GROUPS)
    assert values(after, GROUPS) == Counter(set(now))
    delta = diff.changes(frame, snapshot, GROUPS)
    assert polled(diff.next_live(frame, delta, GROUPS, DAY2), GROUPS) == polled(after, GROUPS)
    assert diff.changes(after, snapshot, GROUPS).isEmpty()
    kept = diff.apply_removed(frame, diff.removed(frame, snapshot, GROUPS, DAY3), GROUPS)
    assert values(kept, GROUPS) == Counter(before & set(now))


@pytest.mark.parametrize("rows_per_slice", [1, 10, 10_000])
def test_spread_join_equals_plain_join(spark, rows_per_slice):
    rng = random.Random(rows_per_slice)
    left = [(rng.choice(["hot"] * 6 + list("abcdef") + [None]), i % 40) for i in range(300)]
    right = [(k, w) for k in ["hot", "a", "b", "zz", None] for w in range(3)]
    facts = spark.createDataFrame(left, "k string, v int")
    names = spark.createDataFrame(right, "k string, w int")
    got = spread_join(facts, names, ["k"], rows_per_slice=rows_per_slice)
    assert got.columns == ["k", "v", "w"]
    assert everything(got) == everything(facts.join(names, "k").select("k", "v", "w"))


def test_spread_join_splits_the_hot_key(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    facts = spark.range(4000).selectExpr("CASE WHEN id % 3 = 0 THEN -1 ELSE id END AS k", "id AS v")
    names = spark.range(-1, 4000).selectExpr("id AS k", "id * 2 AS w")
    joined = spread_join(facts, names, ["k"], rows_per_slice=100)
    tasks = joined.where("k = -1").selectExpr("spark_partition_id() AS p").distinct().count()
    assert tasks == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert joined.count() == 4000


def test_every_key_above_the_threshold_is_cut(spark, conf):
    """More hot keys than any list of fixed length would hold."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    facts = spark.range(36_000).selectExpr("id % 1200 AS k", "id AS v")
    names = spark.range(1200).selectExpr("id AS k", "id * 2 AS w")
    joined = spread_join(facts, names, ["k"], rows_per_slice=10)
    spread = joined.selectExpr("k", "spark_partition_id() AS p").distinct().groupBy("k").count()
    assert joined.count() == 36_000
    assert spread.where("count > 1").count() > 1000
