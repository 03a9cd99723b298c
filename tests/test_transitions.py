"""State transitions on hand-made rows, in strict and compat mode."""

from collections import Counter

import pytest
from pyspark.sql import types as T

from grantledger.operators import diff
from grantledger.schemas import GROUPS, INSTANCE, OBJECTS, PRINCIPALS, ROLES
from tests.rows import DAY1, DAY2, DAY3, grant, live, polled, staging, values

CONNECT = "CONNECT SQL"


def run_strict(before, now, as_of, history=None):
    """Instance steps as a run composes them; returns (revoked, dropped, live)."""
    delta = diff.changes(before, now, INSTANCE, history)
    revoked = diff.removed(before, now, INSTANCE, as_of, history)
    dropped = diff.dropped_principals(delta, now, as_of)
    after = diff.next_live(
        before, delta, INSTANCE, as_of, dropped.select(*PRINCIPALS.values)
    )
    return revoked, dropped, after


def run_stepwise(before, now, as_of, compat=False, since=DAY1):
    revoked = diff.removed(before, now, INSTANCE, as_of)
    step = diff.apply_removed(before, revoked, INSTANCE, compat, since)
    dropped = diff.removed(step, now, PRINCIPALS, as_of)
    step = diff.apply_removed(step, dropped, PRINCIPALS, compat, since)
    return diff.upsert(step, now, as_of, compat=compat)


def test_unchanged_row_keeps_its_time(spark):
    before = live(spark, INSTANCE, [grant()])
    now = staging(spark, INSTANCE, [grant(), grant()])
    revoked, dropped, after = run_strict(before, now, DAY2)
    assert revoked.isEmpty() and dropped.isEmpty()
    assert polled(after, INSTANCE) == {grant(): DAY1}


def test_added_and_removed(spark):
    before = live(spark, INSTANCE, [grant(), grant(permission="OLD")])
    now = staging(spark, INSTANCE, [grant(), grant(permission="NEW")])
    revoked, dropped, after = run_strict(before, now, DAY2)
    assert polled(revoked, INSTANCE) == {grant(permission="OLD"): DAY2}
    assert dropped.isEmpty()
    assert polled(after, INSTANCE) == {grant(): DAY1, grant(permission="NEW"): DAY2}


def test_changed_state_is_revoked_and_inserted(spark):
    before = live(spark, INSTANCE, [grant(state="GRANT"), grant(permission="x")])
    now = staging(spark, INSTANCE, [grant(state="DENY"), grant(permission="x")])
    revoked, _, after = run_strict(before, now, DAY2)
    assert polled(revoked, INSTANCE) == {grant(state="GRANT"): DAY2}
    assert polled(after, INSTANCE) == {grant(state="DENY"): DAY2, grant(permission="x"): DAY1}


def test_changed_connect_row_is_recorded_and_rewritten(spark):
    old, new = grant(permission=CONNECT), grant(permission=CONNECT, disabled="Yes")
    before = live(spark, INSTANCE, [old])
    now = staging(spark, INSTANCE, [new])
    revoked, dropped, after = run_strict(before, now, DAY2)
    assert polled(revoked, INSTANCE) == {old: DAY2}
    assert dropped.isEmpty()
    assert polled(after, INSTANCE) == {new: DAY2}
    kept = diff.apply_removed(before, revoked, INSTANCE)
    assert values(kept, INSTANCE) == Counter([old])
    assert values(run_stepwise(before, now, DAY2, compat=True), INSTANCE) == Counter([new])


def test_connect_row_stays_while_principal_has_other_rows(spark):
    connect, other = grant(permission=CONNECT), grant()
    before = live(spark, INSTANCE, [connect, other])
    now = staging(spark, INSTANCE, [other])
    revoked, dropped, after = run_strict(before, now, DAY2)
    assert values(revoked, INSTANCE) == Counter([connect])
    assert values(after, INSTANCE) == Counter([connect, other])
    # recorded once in strict mode, again without the history
    again, _, unchanged = run_strict(after, now, DAY3, history=revoked)
    assert again.isEmpty()
    assert values(unchanged, INSTANCE) == Counter([connect, other])
    assert not diff.removed(after, now, INSTANCE, DAY3).isEmpty()


def test_connect_row_removed_after_coming_back_is_recorded_again(spark):
    connect, other = grant(permission=CONNECT), grant()
    history = live(spark, INSTANCE, [connect], poll=DAY1)
    rewritten = live(spark, INSTANCE, [(*connect, DAY2), (*other, DAY1)])
    now = staging(spark, INSTANCE, [other])
    assert values(diff.removed(rewritten, now, INSTANCE, DAY3, history), INSTANCE) == Counter([connect])


def test_dropped_principal_takes_its_connect_row_along(spark):
    mine = [grant("bob", CONNECT, sid="S2"), grant("bob", "VIEW", sid="S2")]
    before = live(spark, INSTANCE, [*mine, grant()])
    now = staging(spark, INSTANCE, [grant()])
    _, dropped, after = run_strict(before, now, DAY2)
    assert values(dropped, PRINCIPALS) == Counter([("srv", "Instance-Level", "S2", "bob", "SQL_LOGIN")])
    assert values(after, INSTANCE) == Counter([grant()])
    assert values(run_stepwise(before, now, DAY2), INSTANCE) == Counter([grant()])


def test_renamed_principal(spark):
    before = live(spark, INSTANCE, [grant("old"), grant("old", CONNECT)])
    now = staging(spark, INSTANCE, [grant("new"), grant("new", CONNECT)])
    _, dropped, after = run_strict(before, now, DAY2)
    assert [r.PrincipalName for r in dropped.collect()] == ["old"]
    assert polled(after, INSTANCE) == {grant("new"): DAY2, grant("new", CONNECT): DAY2}


def test_null_sid_strict_removes_compat_keeps(spark):
    ghost = grant("ghost", sid=None)
    before = live(spark, INSTANCE, [ghost, grant()])
    now = staging(spark, INSTANCE, [grant()])
    revoked, _, after = run_strict(before, now, DAY2)
    assert values(revoked, INSTANCE) == Counter([ghost])
    assert values(after, INSTANCE) == Counter([grant()])
    compat = run_stepwise(before, now, DAY2, compat=True)
    assert values(compat, INSTANCE) == Counter([ghost, grant()])
    assert values(diff.removed(compat, now, INSTANCE, DAY3), INSTANCE) == Counter([ghost])


def test_null_sid_of_group_member_is_matched_in_both_modes(spark):
    row = (None, "ann", "readers")
    before = live(spark, GROUPS, [row])
    gone = diff.removed(before, staging(spark, GROUPS, []), GROUPS, DAY2)
    assert diff.apply_removed(before, gone, GROUPS).isEmpty()
    assert diff.apply_removed(before, gone, GROUPS, True, DAY1).isEmpty()


def test_role_delete_without_server_in_compat(spark):
    here, there = (("a", "db", "U1", "ann", "SQL_USER", "r")), (("b", "db", "U1", "ann", "SQL_USER", "r"))
    before = live(spark, ROLES, [here, there])
    gone = diff.removed(before, staging(spark, ROLES, [there]), ROLES, DAY2)
    assert values(diff.apply_removed(before, gone, ROLES), ROLES) == Counter([there])
    assert diff.apply_removed(before, gone, ROLES, True, DAY1).isEmpty()


@pytest.mark.parametrize("since, left", [(None, 1), (DAY1, 0), (DAY2, 1)])
def test_compat_watermark(spark, since, left):
    before = live(spark, INSTANCE, [grant()])
    gone = diff.removed(before, staging(spark, INSTANCE, []), INSTANCE, DAY2)
    assert diff.apply_removed(before, gone, INSTANCE, True, since).count() == left


def test_compat_rededuction_across_runs(spark):
    """A re-added row matches older history while the watermark lies before it."""
    before = live(spark, INSTANCE, [grant()], poll=DAY3)
    history = live(spark, INSTANCE, [grant()], poll=DAY2)
    assert diff.apply_removed(before, history, INSTANCE, True, DAY1).isEmpty()
    assert diff.apply_removed(before, history, INSTANCE, True, DAY3).count() == 1


def test_removed_added_removed_gives_two_history_rows(spark):
    row = grant()
    first = diff.removed(
        live(spark, INSTANCE, [row]), staging(spark, INSTANCE, []), INSTANCE, DAY2
    )
    second = diff.removed(
        live(spark, INSTANCE, [row], poll=DAY2), staging(spark, INSTANCE, []), INSTANCE, DAY3,
        history=first,
    )
    assert values(first.unionByName(second), INSTANCE) == Counter({row: 2})


def test_empty_live_and_empty_staging(spark):
    rows = [grant(), grant(), grant(permission="b")]
    nothing, some = staging(spark, INSTANCE, []), staging(spark, INSTANCE, rows)
    assert values(diff.upsert(live(spark, INSTANCE, []), some, DAY1), INSTANCE) == Counter(set(rows))
    _, dropped, after = run_strict(live(spark, INSTANCE, rows[1:]), nothing, DAY2)
    assert after.isEmpty() and dropped.count() == 1


def test_first_seen_is_kept_on_request(spark):
    gone = diff.removed(
        live(spark, INSTANCE, [grant()]), staging(spark, INSTANCE, []), INSTANCE, DAY2,
        with_first_seen=True,
    ).first()
    assert str(gone["first_seen"]) == DAY1 and str(gone["PollDate"]) == DAY2


def test_change_kind(spark):
    old, other = grant(state="GRANT"), grant(permission="OTHER")
    before = live(spark, INSTANCE, [old, other])
    now = staging(spark, INSTANCE, [grant(state="DENY")])
    kinds = diff.superseded(
        diff.removed(before, now, INSTANCE, DAY2), diff.added(before, now, INSTANCE, DAY2)
    )
    found = {r.PermissionType: r.change_kind for r in kinds.collect()}
    assert found == {"VIEW": "superseded", "OTHER": "removed"}


def test_ambiguous_update_key(spark):
    """Two stale and two new rows of one key: strict replaces exactly the stale ones."""
    valid = grant("valid", CONNECT)
    before = live(spark, INSTANCE, [valid, grant("a", CONNECT), grant("b", CONNECT)])
    now = staging(spark, INSTANCE, [valid, grant("c", CONNECT), grant("d", CONNECT)])
    strict = diff.upsert(before, now, DAY2)
    assert polled(strict, INSTANCE) == {
        valid: DAY1, grant("c", CONNECT): DAY2, grant("d", CONNECT): DAY2,
    }
    compat = diff.upsert(before, now, DAY2, compat=True)
    # every live row of the key, the valid one too, becomes the smallest new row
    assert values(compat, INSTANCE) == Counter({grant("c", CONNECT): 3, grant("d", CONNECT): 1})


def test_upsert_for_plain_domains(spark):
    before = live(spark, GROUPS, [(None, "a", "g"), ("S", "b", "g")])
    now = staging(spark, GROUPS, [(None, "a", "g"), ("S", "c", "g"), ("S", "c", "g")])
    assert polled(diff.upsert(before, now, DAY2, GROUPS), GROUPS) == {
        (None, "a", "g"): DAY1, ("S", "c", "g"): DAY2,
    }


def test_binary_sids(spark):
    from grantledger.schemas import live_schema, value_schema

    row = (bytearray(b"\x01\x02"), "a", "g")
    before = spark.createDataFrame([], live_schema(GROUPS, T.BinaryType()))
    now = spark.createDataFrame([row, row], value_schema(GROUPS))
    after = diff.upsert(before, now, DAY1, GROUPS)
    assert after.count() == 1 and diff.removed(after, now, GROUPS, DAY2).isEmpty()


def test_objects_domain_has_no_sticky_rows(spark):
    row = ("srv", "db", None, None, "SCHEMA", CONNECT, "GRANT", None, "N/A", "N/A")
    before = live(spark, OBJECTS, [row])
    delta = diff.changes(before, staging(spark, OBJECTS, []), OBJECTS)
    assert diff.next_live(before, delta, OBJECTS, DAY2).isEmpty()
