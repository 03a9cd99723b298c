"""Nested groups on small graphs, checked against a plain-Python walk."""

import random

import pytest

from grantledger.operators import condense, groups

LOGIN = "sid string, name string, isntgroup int"
EDGE = "account_name string, type string, permission_path string"


def edges(spark, pairs, group_names):
    rows = [(m, "group" if m in group_names else "user", g) for m, g in pairs]
    return spark.createDataFrame(rows, EDGE)


def logins(spark, group_names, user_names=()):
    rows = [(f"S-{n}", n, 1) for n in group_names] + [(f"S-{n}", n, 0) for n in user_names]
    return spark.createDataFrame(rows, LOGIN)


def brute_closure(pairs, group_names):
    """Smallest number of steps from each account up to each group."""
    parents = {}
    for member, group in pairs:
        parents.setdefault(member, set()).add(group)
    found = {}
    for start in parents:
        level, depth, seen = parents[start], 1, set()
        while level:
            for group in level - seen:
                found.setdefault((start, group), depth)
            seen |= level
            level = {p for g in level if g in group_names for p in parents.get(g, ())} - seen
            depth += 1
    return {k: d for k, d in found.items() if k[0] != k[1]}


GRAPHS = {
    "chain": [("u", "a"), ("a", "b"), ("b", "c"), ("c", "d"), ("d", "e"), ("e", "f"), ("f", "g")],
    "diamond": [("u", "a"), ("a", "b"), ("a", "c"), ("b", "d"), ("c", "d"), ("d", "e")],
    "two_cycle": [("u", "a"), ("a", "b"), ("b", "a"), ("v", "b")],
    "self_loop": [("u", "a"), ("a", "a"), ("a", "b")],
    "shortcut": [("u", "a"), ("a", "b"), ("b", "c"), ("c", "d"), ("a", "d"), ("d", "e")],
    "three_cycle": [("a", "b"), ("b", "c"), ("c", "a"), ("u", "c"), ("c", "d")],
}


@pytest.mark.parametrize("name", GRAPHS)
def test_closure(spark, name):
    pairs = GRAPHS[name]
    names = {g for _, g in pairs}
    got = groups.closure(edges(spark, pairs, names)).collect()
    assert {(r[0], r[1]): r[2] for r in got} == brute_closure(pairs, names)


def test_random_graph(spark):
    rng = random.Random(5)
    names = [f"g{i}" for i in range(25)]
    pairs = [(rng.choice(names), rng.choice(names)) for _ in range(40)]
    pairs += [(f"u{i}", rng.choice(names)) for i in range(30)]
    pairs = sorted(set(pairs))
    got = groups.closure(edges(spark, pairs, set(names))).collect()
    assert {(r[0], r[1]): r[2] for r in got} == brute_closure(pairs, set(names))


def test_long_chain_is_not_cut(spark):
    pairs = [(f"g{i:02}", f"g{i + 1:02}") for i in range(40)]
    names = {n for p in pairs for n in p}
    got = groups.closure(edges(spark, pairs, names))
    assert got.count() == 41 * 40 // 2
    assert got.selectExpr("max(depth)").first()[0] == 40


def test_gather_strict_lists_all_levels_with_own_sid(spark):
    pairs = [("u", "low"), ("low", "mid"), ("mid", "top"), ("w", "other")]
    login = logins(spark, ["top"], ["u"])
    rows = groups.gather(edges(spark, pairs, {"low", "mid", "top"}), login).collect()
    assert {tuple(r) for r in rows} == {
        ("S-u", "u", "low"), ("S-u", "u", "mid"), ("S-u", "u", "top"),
        (None, "low", "mid"), (None, "low", "top"), (None, "mid", "top"),
    }


def test_gather_compat_goes_one_level_up_with_the_groups_sid(spark):
    pairs = [("u", "low"), ("low", "mid"), ("mid", "top"), ("w", "other")]
    login = logins(spark, ["top", "low"], ["u"])
    graph = edges(spark, pairs, {"low", "mid", "top"})
    rows = groups.gather(graph, login, compat=True).collect()
    assert {tuple(r) for r in rows} == {
        (None, "mid", "top"), (None, "u", "low"),        # direct members of group logins
        (None, "low", "top"),                            # through mid, which is no login
        ("S-low", "u", "mid"),                           # through low, with the sid of low
    }


def test_unknown_group_adds_nothing(spark):
    graph = edges(spark, [("u", "elsewhere")], {"elsewhere"})
    assert groups.gather(graph, logins(spark, ["top"])).isEmpty()
    assert groups.gather(graph, logins(spark, ["top"]), compat=True).isEmpty()


def test_direct_members_have_no_sid(spark):
    graph = edges(spark, [("u", "top"), ("u", "top"), ("u", "low")], {"top", "low"})
    rows = groups.direct_members(graph, logins(spark, ["top"], ["u"])).collect()
    assert [tuple(r) for r in rows] == [(None, "u", "top")]


def test_edges_out_of_the_roots_reach_are_not_walked(spark, monkeypatch):
    walked = []
    paths = groups.group_paths
    monkeypatch.setattr(groups, "group_paths", lambda edges: walked.append(edges.collect()) or paths(edges))
    rows = [("a", "user", "g1"), ("g1", "group", "root"), ("b", "user", "far"), ("far", "group", "farther"), ("g2", "group", "g1"), ("g1", "group", "g2")]
    edges = spark.createDataFrame(rows, "account_name string, type string, permission_path string")
    roots = spark.createDataFrame([("root",)], "group string")
    got = {(r.account_name, r.ancestor): r.depth for r in groups.closure(edges, roots).collect()}
    assert {r.permission_path for r in walked[0]} == {"g1", "g2", "root"}
    assert got == {("a", "g1"): 1, ("a", "root"): 2, ("a", "g2"): 2, ("g1", "root"): 1, ("g2", "root"): 2, ("g2", "g1"): 1, ("g1", "g2"): 1}


def brute_components(pairs, group_names):
    reach = {n: {n} for p in pairs for n in p}
    for (a, b) in brute_closure(pairs, group_names):
        reach[a].add(b)
    return {
        n: min(m for m in reach[n] if n in reach[m]) for n in reach if any(m != n and n in reach[m] for m in reach[n])
    }


@pytest.mark.parametrize("seed", range(2))
def test_components_of_random_graphs(spark, seed):
    rng = random.Random(seed)
    names = [f"g{i:02}" for i in range(40)]
    pairs = sorted({(rng.choice(names), rng.choice(names)) for _ in range(rng.choice([35, 50, 70]))})
    links = spark.createDataFrame([*pairs, *pairs[:5], (None, "g00"), ("g00", None)], "child string, parent string")
    got = {r.group: r.component for r in condense.cyclic_components(links).collect()}
    assert got == brute_components(pairs, set(names))


def test_colours_are_numbers(spark, monkeypatch):
    """Names are looked up before and after the rounds alone; several colourings find rings linked to each other."""
    kinds, plain = [], condense.settle

    def noted(df, label):
        if label == "colours":
            kinds.append({f.dataType.simpleString() for f in df.schema})
        return plain(df, label)

    monkeypatch.setattr(condense, "settle", noted)
    rings = [[f"a rather long name of a group {r} {i}" for i in range(4)] for r in range(8)]
    pairs = [(a, b) for ring in rings for a, b in zip(ring, ring[1:] + ring[:1], strict=True)]
    pairs += [(one[1], other[2]) for one, other in zip(rings, rings[1:], strict=False)]
    got = {r.group: r.component for r in condense.cyclic_components(spark.createDataFrame(pairs, "child string, parent string")).collect()}
    assert got == {name: ring[0] for ring in rings for name in ring}
    assert kinds and set().union(*kinds) <= {"bigint", "boolean"}


def test_components_without_links(spark):
    assert condense.cyclic_components(spark.createDataFrame([], "child string, parent string")).isEmpty()
    alone = groups.components(spark.createDataFrame([("u", "user", "top"), ("top", "group", "top")], EDGE))
    assert [tuple(r) for r in alone.collect()] == [("top", "top", 1)]


@pytest.mark.parametrize("seed", range(1))
def test_memberships_are_the_closure_without_depth(spark, seed):
    rng = random.Random(100 + seed)
    names = [f"g{i}" for i in range(20)]
    pairs = [(rng.choice(names), rng.choice(names)) for _ in range(30)]
    pairs += [(f"u{i}", rng.choice(names)) for i in range(20)]
    graph = edges(spark, pairs, set(names))
    roots = spark.createDataFrame([(n,) for n in names[:3]], "group string")
    got = groups.memberships(graph, roots)
    wanted = groups.closure(graph, roots).select("account_name", "ancestor")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, wanted.collect()))


def test_a_long_cycle_takes_linear_rows_until_the_result(spark, monkeypatch):
    size, written = 2000, []

    def counted(module):
        plain = module.settle

        def count(df, label):
            table = plain(df, label)
            written.append(table.count())
            return table

        monkeypatch.setattr(module, "settle", count)

    counted(groups)
    counted(condense)
    ring = [(f"g{i}", f"g{(i + 1) % size}") for i in range(size)]
    pairs = [*ring, ("u", "g5"), ("g7", "top"), ("below", "g9"), ("v", "below")]
    names = {g for _, g in pairs}
    roots = spark.createDataFrame([("top",)], "group string")
    found = groups.memberships(edges(spark, pairs, names), roots)
    # each of the ring in the others and in top; u and below and v in the ring and top; v in below
    assert found.count() == size * (size - 1) + size + 3 * (size + 1) + 1
    assert max(written) <= 2 * size and len(written) < 60


def test_members_carry_the_status_of_their_group(spark):
    login = spark.createDataFrame(
        [("top", 1, 9), ("low", 1, 10), ("odd", 1, None), ("u", 0, 9)], "name string, isntgroup int, status int"
    )
    graph = edges(spark, [("u", "top"), ("u", "top"), ("u", "low"), ("w", "odd"), ("w", "u")], set())
    got = {tuple(r) for r in groups.members_with_status(graph, login).collect()}
    assert got == {
        ("u", "top", 9, 1, "Enabled"), ("u", "low", 10, 1, "Disabled"), ("w", "odd", None, 1, "???"),
    }
