"""Lookups against nested loops in Python."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantledger.operators import lookup
from grantledger.schemas import GROUPS, INSTANCE, OBJECTS, ROLES
from tests.rows import everything, live

NAMES = ["ann", "bob", "cy", "g1", "g2"]


def tables(seed):
    rng = random.Random(seed)

    def pick(*options):
        return rng.choice(options)

    groups = {(pick(None, "x"), pick("ann", "bob", "cy"), pick("g1", "g2")) for _ in range(5)}
    instance = {
        ("s", "Instance-Level", None, pick(*NAMES, None), None, "No", pick("A", "B"), "GRANT", "SERVER", "N/A")
        for _ in range(20)
    }
    roles = {
        (pick("s", "t"), pick("d1", "d2"), None, pick(*NAMES), "SQL_USER", pick("r1", "r2"))
        for _ in range(15)
    }
    objects = {
        (pick("s", "t"), pick("d1", "d2"), pick(None, "U1", "U2"), pick(*NAMES, "r1", "r2", None),
         "VIEW", pick("SELECT", "UPDATE"), "GRANT", "dbo", pick("o1", "o2"), "N/A")
        for _ in range(60)
    }
    return [sorted(t, key=str) for t in (instance, groups, roles, objects)]


SIDS = {"ann": "U1", "bob": None, "cy": "U2"}


def live_tables(spark, seed):
    data = tables(seed)
    domains = (INSTANCE, GROUPS, ROLES, OBJECTS)
    state = lookup.Live(*[live(spark, d, rows) for d, rows in zip(domains, data)])
    logins = spark.createDataFrame([(s, n) for n, s in SIDS.items()], "sid string, name string")
    return data, state, logins


def brute(data, name):
    instance, groups, roles, objects = data
    who = {name} | {g for _, member, g in groups if member == name}
    held = [r for r in roles if r[3] in who]
    grants = {(r[0], r[1], r[5]) for r in held}
    no_sid = [o[:2] + o[3:] for o in objects]
    return (
        Counter(r for r in instance if r[3] in who),
        Counter(r[:2] + r[3:] for r in held),
        Counter(s for o, s in zip(objects, no_sid) if (o[0], o[1], o[3]) in grants),
        Counter(
            s for o, s in zip(objects, no_sid)
            if o[3] in who or (SIDS[name] is not None and o[2] == SIDS[name])
        ),
    )


@pytest.mark.parametrize("seed", range(2))
def test_one_principal(spark, seed):
    data, state, logins = live_tables(spark, seed)
    for name in SIDS:
        answer = lookup.permissions(name, state, logins)
        got = tuple(everything(part.drop("PollDate")) for part in answer)
        assert got == brute(data, name)


@pytest.mark.parametrize("seed", [3])
def test_several_principals_and_summary(spark, seed):
    data, state, logins = live_tables(spark, seed)
    answer = lookup.permissions_of(logins, state, logins)
    counts = {
        (r.Principal, r.part): r.n for r in lookup.summary(logins, state, logins).collect()
    }
    for name in SIDS:
        expected = brute(data, name)
        got = tuple(
            everything(part.filter(F.col("Principal") == name).drop("Principal", "PollDate"))
            for part in answer
        )
        assert got == expected
        sizes = [counts.get((name, part), 0) for part in lookup.Permissions._fields]
        assert sizes == [sum(part.values()) for part in expected]


def test_unknown_principal_has_no_permissions(spark):
    _, state, logins = live_tables(spark, 0)
    assert all(part.isEmpty() for part in lookup.permissions("nobody", state, logins))


def test_role_permissions_compat_repeat_and_ignore_the_server(spark):
    roles = [("s", "d", None, "ann", "SQL_USER", "r"), ("s", "d", None, "g", "SQL_USER", "r")]
    objects = [
        (server, "d", None, "r", "VIEW", "SELECT", "GRANT", "dbo", "o", "N/A") for server in ("s", "t")
    ]
    state = lookup.Live(
        live(spark, INSTANCE, []), live(spark, GROUPS, [(None, "ann", "g")]),
        live(spark, ROLES, roles), live(spark, OBJECTS, objects),
    )
    logins = spark.createDataFrame([], "sid string, name string")
    strict = lookup.permissions("ann", state, logins)
    compat = lookup.permissions("ann", state, logins, "here", compat=True)
    assert [r.ServerName for r in strict.role_permissions.collect()] == ["s"]
    assert sorted(r.ServerName for r in compat.role_permissions.collect()) == ["s", "s", "t", "t"]
    assert {r.ServerName for r in strict.roles.collect()} == {"s"}
    assert {r.ServerName for r in compat.roles.collect()} == {"here"}


@pytest.mark.parametrize("literals", [0, 2])
def test_long_lists_are_joined(spark, monkeypatch, literals):
    monkeypatch.setattr(lookup, "LITERALS", literals)
    data, state, logins = live_tables(spark, 1)
    for name in SIDS:
        answer = lookup.permissions(name, state, logins)
        assert tuple(everything(part.drop("PollDate")) for part in answer) == brute(data, name)


def test_names_reach_the_scan_of_a_recorded_state(spark, conf, tmp_path):
    from grantledger.plans.audit import run_audit
    from grantledger.sources.state import State
    from tests.rows import DAY1
    from tests.test_audit import first

    conf(spark__sql__maxMetadataStringLength="4000")
    state = State(spark, str(tmp_path / "state"), sid_type=T.StringType())
    catalogs = first(spark)
    assert run_audit(catalogs, state, DAY1, "srv").succeeded
    answer = lookup.permissions("ann", state.all_live(), catalogs.logins)
    for part, scans in zip(answer, (1, 1, 1, 1)):
        text = part._jdf.queryExecution().executedPlan().toString()
        live = [line for line in text.splitlines() if "FileScan" in line and "/live/" in line]
        assert len(live) == scans
        assert re.search(r"PushedFilters: \[[^\]]*(In|EqualTo)\(PrincipalName", live[0])


def test_batch_parts_read_what_they_need_once(spark):
    """A part of the answers for several principals runs its own table alone, and that once."""
    _, state, logins = live_tables(spark, 1)
    reads = spark.sparkContext.accumulator(0)

    def counted(rows):
        def passed(batches):
            for batch in batches:
                reads.add(batch.num_rows)
                yield batch

        return rows.coalesce(1).mapInArrow(passed, rows.schema)

    sizes = {part: rows.count() for part, rows in zip(state._fields, state)}
    needs = {
        "instance": ["instance"], "roles": ["roles"],
        "role_permissions": ["roles", "objects"], "objects": ["objects"],
    }
    for part, tables_ in needs.items():
        reads.value = 0
        watched = state._replace(**{t: counted(getattr(state, t)) for t in ("instance", "roles", "objects")})
        getattr(lookup.permissions_of(logins, watched, logins), part).collect()
        assert reads.value == sum(sizes[t] for t in tables_), part


@pytest.mark.parametrize("seed", range(3))
def test_batch_of_more_names_than_literals(spark, seed, monkeypatch):
    _, state, logins = live_tables(spark, seed)
    few = [everything(part) for part in lookup.permissions_of(logins, state, logins)]
    monkeypatch.setattr(lookup, "LITERALS", 1)
    assert [everything(part) for part in lookup.permissions_of(logins, state, logins)] == few
