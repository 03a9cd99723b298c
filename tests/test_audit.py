"""Whole runs on a small server: recording, failures, replays, compat mode, streaming."""

import json
import re
from collections import Counter
from dataclasses import fields, replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantledger.functions.times import in_alert_window, run_timestamp, stamp, stamp_text
from grantledger.operators.lookup import permissions
from grantledger.plans import audit
from grantledger.plans.audit import LateSnapshot, run_audit
from grantledger.schemas import DOMAINS, GROUPS, INSTANCE, OBJECTS, PRINCIPALS, ROLES
from grantledger.sources import runs
from grantledger.sources import state as state_module
from grantledger.sources.catalogs import Catalogs
from grantledger.sources.state import State
from grantledger.streaming.snapshots import follow
from tests.rows import DAY1, DAY2, DAY3, polled, values

ROLE_FLAGS = (
    "sysadmin", "securityadmin", "serveradmin", "setupadmin", "processadmin", "diskadmin",
    "dbcreator", "bulkadmin",
)


def catalogs(spark, grants=(), logins=(), edges=(), members=(), db_grants=()):
    """A server with principals ann, bob and the group staff, and one database."""
    frame = spark.createDataFrame
    flags = ", ".join(f"{r} int" for r in ROLE_FLAGS)
    return Catalogs(
        server_principals=frame(
            [(1, "S1", "ann", "SQL_LOGIN", 0), (2, None, "bob", "SQL_LOGIN", 0)],
            "principal_id int, sid string, name string, type_desc string, is_disabled int",
        ),
        server_permissions=frame(
            [(who, 0, "SERVER", what, state) for who, what, state in grants],
            "grantee_principal_id int, major_id int, class_desc string, permission_name string, state_desc string",
        ),
        endpoints=frame([], "endpoint_id int, name string"),
        logins=frame(
            [(f"L-{n}", n, int(is_group), 0, 0, 9, int(admin), *(0,) * 7) for n, is_group, admin in logins],
            f"sid string, name string, isntgroup int, isntuser int, isntname int, status int, {flags}",
        ),
        group_edges=frame(list(edges), "account_name string, type string, permission_path string"),
        databases=frame([("db", "ONLINE", "MULTI_USER")], "name string, state_desc string, user_access_desc string"),
        database_principals=frame(
            [("db", 1, "U1", "ann", "SQL_USER"), ("db", 2, None, "bob", "SQL_USER"), ("db", 9, None, "readers", "DATABASE_ROLE")],
            "database_name string, principal_id int, sid string, name string, type_desc string",
        ),
        database_role_members=frame(
            [("db", m, r) for m, r in members],
            "database_name string, member_principal_id int, role_principal_id int",
        ),
        database_permissions=frame(
            [("db", 0, "DATABASE", 0, 0, who, what, state) for who, what, state in db_grants],
            "database_name string, class int, class_desc string, major_id int, minor_id int, "
            "grantee_principal_id int, permission_name string, state_desc string",
        ),
        all_objects=frame([], "database_name string, object_id int, schema_id int, name string, type_desc string"),
        schemas=frame([], "database_name string, schema_id int, name string"),
        all_columns=frame([], "database_name string, object_id int, column_id int, name string"),
        securables=frame([], "database_name string, kind string, id int, name string"),
    )


def first(spark):
    return catalogs(
        spark,
        grants=[(1, "CONNECT SQL", "GRANT"), (1, "VIEW", "GRANT"), (2, "CONNECT SQL", "GRANT")],
        logins=[("staff", 1, 0), ("ann", 0, 1)],
        edges=[("ann", "user", "staff"), ("bob", "user", "staff")],
        members=[(1, 9), (2, 9)],
        db_grants=[(9, "SELECT", "GRANT"), (2, "UPDATE", "GRANT")],
    )


def second(spark):
    """bob is gone everywhere, ann lost VIEW and got ALTER, the role lost a grant."""
    return catalogs(
        spark,
        grants=[(1, "CONNECT SQL", "GRANT"), (1, "ALTER", "GRANT")],
        logins=[("staff", 1, 0), ("ann", 0, 1)],
        edges=[("ann", "user", "staff")],
        members=[(1, 9)],
        db_grants=[(9, "SELECT", "DENY")],
    )


@pytest.fixture
def state(spark, tmp_path):
    return State(spark, str(tmp_path / "state"), sid_type=T.StringType())


def rows(frame, *columns):
    return Counter(tuple(r) for r in frame.select(*columns).collect())


def test_two_runs_and_a_quiet_third(spark, state):
    done = run_audit(first(spark), state, DAY1, "srv", run_by="me")
    assert done.succeeded and done.run_id == 1 and len(done.steps) == 14, done.errors
    assert state.live(INSTANCE).count() == 4  # three grants and one fixed role
    for domain in (*DOMAINS, PRINCIPALS):
        assert state.history(domain).isEmpty()

    done = run_audit(second(spark), state, DAY2, "srv")
    assert done.succeeded, done.errors
    assert rows(state.live(INSTANCE), "PrincipalName", "PermissionType") == Counter(
        [("ann", "CONNECT SQL"), ("ann", "ALTER"), ("ann", "Database Role")]
    )
    times = {r.PermissionType: str(r.PollDate) for r in state.live(INSTANCE).collect()}
    assert times == {"CONNECT SQL": DAY1, "ALTER": DAY2, "Database Role": DAY1}
    assert rows(state.history(INSTANCE), "PrincipalName", "PermissionType", "run_id") == Counter(
        [("ann", "VIEW", 2), ("bob", "CONNECT SQL", 2)]
    )
    assert rows(state.history(PRINCIPALS), "PrincipalName") == Counter([("bob",)])
    assert rows(state.history(GROUPS), "PrincipalName", "ADGroupName") == Counter([("bob", "staff")])
    assert rows(state.history(ROLES), "PrincipalName", "DatabaseRole") == Counter([("bob", "readers")])
    assert rows(state.history(OBJECTS), "PrincipalName", "PermissionState") == Counter(
        [("readers", "GRANT"), ("bob", "GRANT")]
    )
    versions = state.versions_in_use()
    kept = {d.name: (polled(state.live(d), d), state.history(d).count()) for d in DOMAINS}

    assert run_audit(second(spark), state, DAY3, "srv").succeeded
    assert state.versions_in_use() == versions  # nothing rewritten
    assert {d.name: (polled(state.live(d), d), state.history(d).count()) for d in DOMAINS} == kept

    answer = permissions("ann", state.all_live(), second(spark).logins)
    assert rows(answer.role_permissions, "PrincipalName", "PermissionState") == Counter([("readers", "DENY")])


def test_readers_keep_their_version_until_it_is_old(spark, tmp_path):
    state = State(spark, str(tmp_path / "state"), retention=timedelta(hours=1), sid_type=T.StringType())
    opened = None
    for day, source, expected in ((1, first, 2), (2, second, 1), (3, first, 2), (4, second, 1)):
        now = datetime(2024, 3, 1) + timedelta(minutes=10 * day)
        assert run_audit(source(spark), state, f"2024-02-0{day} 00:00:00", "srv", clock=lambda now=now: now).succeeded
        assert state.versions_in_use()[ROLES.name] == day and state.live(ROLES).count() == expected
        opened = opened or state.all_live()
    assert opened.roles.count() == 2 and opened.instance.count() == 4  # three rewrites later
    assert run_audit(first(spark), state, "2024-02-05 00:00:00", "srv", clock=lambda: datetime(2024, 3, 2)).succeeded
    folder = tmp_path / "state" / "live" / ROLES.live
    assert sorted(p.name for p in folder.iterdir()) == ["run_id=4", "run_id=5"]


def test_journal_stays_few_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(state_module, "JOURNAL_FILES", 3)
    state = State(spark, str(tmp_path / "state"), sid_type=T.StringType())
    for day in range(1, 5):
        assert run_audit((second, first)[day % 2](spark), state, f"2024-02-0{day} 00:00:00", "srv").succeeded
        assert state.log().count() == 15 * day and state.commits().count() == day
    folder = tmp_path / "state" / "journal"
    files = {g.name: sum(p.name.startswith("part-") for p in g.iterdir()) for g in folder.iterdir()}
    assert len(files) <= 2 and max(files.values()) <= 4
    assert state.history(ROLES).count() == 2


def test_a_lost_run_leaves_its_log_open(spark, state, monkeypatch):
    def lost(*_):
        raise ConnectionError("driver lost")

    with monkeypatch.context() as patch, pytest.raises(ConnectionError):
        patch.setattr(State, "commit", lost)
        run_audit(first(spark), state, DAY1, "srv")
    begun = state.log().collect()
    assert len(begun) == 15 and all(r.ExecStopDT is None and r.SuccessIndicator == "N" for r in begun)
    assert run_audit(first(spark), state, DAY1, "srv").succeeded
    ended = state.log().collect()
    assert len(ended) == 15 and all(r.ExecStopDT is not None and r.SuccessIndicator == "Y" for r in ended)


def test_run_and_stream_share_one_state(spark, state, tmp_path):
    """A direct run, then a stream with another snapshot, then a new checkpoint with a third one."""
    assert run_audit(first(spark), state, DAY1, "srv").run_id == 1
    feed = Feed(spark, state, tmp_path)
    feed.announce("1.json", (feed.snapshot("b", second(spark)), DAY2))
    feed.drain("checkpoint")
    assert rows(state.history(INSTANCE), "PermissionType") == Counter([("VIEW",), ("CONNECT SQL",)])
    feed.announce("2.json", (feed.snapshot("c", first(spark)), DAY3))
    feed.drain("new_checkpoint")  # brings both files, of which one is new
    assert state.last_run() == 3 and state.live(ROLES).count() == 2
    assert set(values(state.live(OBJECTS), OBJECTS)) == set(values(state.staging(OBJECTS), OBJECTS))


def test_redelivery_runs_only_what_failed(spark, state, tmp_path):
    feed = Feed(spark, state, tmp_path)
    feed.announce("1.json", (feed.snapshot("a", first(spark)), DAY1))
    feed.drain("checkpoint")
    path = feed.snapshot("b", second(spark))
    members = tmp_path / "b" / "database_role_members"
    sound = {p: p.read_bytes() for p in members.iterdir() if p.name.startswith("part-")}
    for p in sound:
        p.write_bytes(sound[p][: len(sound[p]) // 2] + b"torn")
        (members / f".{p.name}.crc").unlink()
    feed.announce("2.json", (path, DAY2))
    with pytest.raises(Exception):  # noqa: B017 - the stream ends with the batch's error
        feed.drain("checkpoint")
    kept = state.live(ROLES).count()
    for p, content in sound.items():
        p.write_bytes(content)
    feed.drain("checkpoint")
    assert kept == 2 and state.live(ROLES).count() == 1
    assert rows(state.history(ROLES), "PrincipalName", "DatabaseRole") == Counter([("bob", "readers")])
    assert state.history(OBJECTS).count() == 2  # recorded once
    last = state.commits().orderBy(F.desc("run_id")).first()
    assert last.succeeded and "roles" in [p.domain for p in last.parts]


def test_late_snapshots_are_set_aside(spark, state, tmp_path):
    feed = Feed(spark, state, tmp_path)
    feed.announce("1.json", (feed.snapshot("b", second(spark)), DAY2))
    feed.drain("checkpoint")
    kept = {d.name: polled(state.live(d), d) for d in DOMAINS}
    feed.announce("2.json", (feed.snapshot("a", first(spark)), DAY1))
    feed.drain("checkpoint")
    assert {d.name: polled(state.live(d), d) for d in DOMAINS} == kept
    assert state.commits().count() == 1
    assert [r.as_of for r in state.journal().filter("kind = 'parked'").collect()] == [datetime(2024, 1, 1)]
    feed.drain("other_checkpoint")
    assert state.journal().filter("kind = 'parked'").count() == 1
    with pytest.raises(LateSnapshot):
        run_audit(first(spark), state, DAY2, "srv")


def test_times_are_compared_as_times(spark, state, tmp_path):
    feed = Feed(spark, state, tmp_path)
    feed.announce("1.json", (feed.snapshot("b", second(spark)), "2024-01-10 00:00:00"), (feed.snapshot("a", first(spark)), "2024-01-09"))
    feed.drain("checkpoint")
    assert state.live(ROLES).count() == 1 and state.history(ROLES).count() == 1


def test_a_failing_finish_is_a_failed_step(spark, state, monkeypatch):
    run_audit(first(spark), state, DAY1, "srv", compat=True)
    before = polled(state.live(ROLES), ROLES)

    def broken_finish(self):
        if self.domain is ROLES:
            raise OSError("disk full")

    with monkeypatch.context() as patch:
        patch.setattr(audit._CompatRun, "finish", broken_finish)
        done = run_audit(second(spark), state, DAY2, "srv", compat=True)
    assert not done.succeeded and done.errors == {"record new role members": "disk full"}
    assert polled(state.live(ROLES), ROLES) == before and state.last_run() == 2
    log = state.log().filter("USPName = 'record new role members'").orderBy("RecordPermissionsAuditID")
    assert [r.SuccessIndicator for r in log.collect()] == ["Y", "N"]
    again = run_audit(second(spark), state, DAY2, "srv", compat=True, run_id=2)
    assert again.succeeded
    assert list(again.steps) == ["clear staging", "gather roles", "record dropped role members", "record new role members"]


def test_compat_run_takes_the_watermark_from_the_last_success(spark, state):
    run_audit(first(spark), state, DAY1, "srv", compat=True)
    run_audit(second(spark), state, DAY2, "srv", compat=True)
    # what this run recorded is later than the last successful one, so it is deleted; bob has no sid and stays
    assert ("ann", "VIEW") not in rows(state.live(INSTANCE), "PrincipalName", "PermissionType")
    assert rows(state.live(ROLES), "PrincipalName") == Counter([("ann",), ("bob",)])


def test_history_tells_first_seen_and_kind(spark, state):
    run_audit(first(spark), state, DAY1, "srv")
    run_audit(second(spark), state, DAY2, "srv")
    found = state.history(INSTANCE).select("PermissionType", F.date_format("first_seen", "yyyy-MM-dd HH:mm:ss"), "change_kind")
    assert {tuple(r) for r in found.collect()} == {("VIEW", DAY1, "removed"), ("CONNECT SQL", DAY1, "removed")}


def test_strict_runs_read_no_history_and_compat_runs_prune_it(spark, state, monkeypatch):
    run_audit(first(spark), state, DAY1, "srv")

    def unread(*_):
        raise AssertionError("history was read")

    with monkeypatch.context() as patch:
        patch.setattr(State, "history", unread)
        assert run_audit(second(spark), state, DAY2, "srv").succeeded
        assert run_audit(second(spark), state, DAY3, "srv").succeeded
    assert state.history(INSTANCE).count() == 2
    later = state.history(INSTANCE, DAY1)
    text = later._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*run_id", text)
    assert later.count() == 2 and state.history(INSTANCE, DAY2).count() == 0


def test_run_log(spark, state):
    ticks = (datetime(2024, 1, 1) + timedelta(seconds=n) for n in range(1000))
    run_audit(first(spark), state, DAY1, "srv", run_by="me", clock=lambda: next(ticks))
    log = state.log().orderBy("RecordPermissionsAuditID").collect()
    assert len(log) == 15
    assert [r.ParentAuditID for r in log] == [-1] + [100] * 14
    assert [r.RecordPermissionsAuditID for r in log] == list(range(100, 115))
    assert {r.SuccessIndicator for r in log} == {"Y"} and {r.RunBy for r in log} == {"me"}
    assert all(r.ExecStopDT > r.ExecStartDT for r in log)
    last = runs.last_success(runs.history_of(state.log(), "audit"), "audit").first()
    assert str(last.last_run) == "2024-01-01 00:00:00"


def broken(catalog, name):
    """The catalogs with an extract that fails when it is read."""
    bad = getattr(catalog, name)
    column = bad.columns[0]
    bad = bad.withColumn(column, F.raise_error(F.lit("extract unreadable")).cast(bad.schema[column].dataType))
    return replace(catalog, **{name: bad})


def test_failed_gather_removes_nothing_in_strict_mode(spark, state):
    run_audit(first(spark), state, DAY1, "srv")
    before = polled(state.live(ROLES), ROLES)
    done = run_audit(broken(second(spark), "database_role_members"), state, DAY2, "srv")
    assert not done.succeeded
    assert done.steps["gather roles"] is False and done.steps["record dropped role members"] is False
    assert "unreadable" in done.errors["gather roles"] and "skipped" in done.errors["record new role members"]
    assert polled(state.live(ROLES), ROLES) == before and state.history(ROLES).isEmpty()
    assert state.history(OBJECTS).count() == 2  # other domains went on
    parents = state.log().filter("ParentAuditID = -1").orderBy("RecordPermissionsAuditID")
    assert [r.SuccessIndicator for r in parents.collect()] == ["Y", "N"]
    assert run_audit(second(spark), state, DAY3, "srv").succeeded
    assert state.history(ROLES).count() == 1


def test_failed_gather_in_compat_mode_empties_live(spark, state):
    run_audit(first(spark), state, DAY1, "srv", compat=True)
    done = run_audit(
        broken(first(spark), "database_role_members"), state, DAY2, "srv", compat=True, since=DAY1
    )
    assert done.succeeded and done.steps["gather roles"] is False
    # the row with a NULL sid cannot be matched and stays
    assert rows(state.live(ROLES), "PrincipalName") == Counter([("bob",)])
    assert state.history(ROLES).count() == 2


def test_compat_runs_compare_once_where_deletions_take_no_row_of_the_snapshot(spark, state, monkeypatch):
    compared = Counter()
    made = audit.diff.compare

    def counting(live, staging, domain, *args, **kwargs):
        compared[domain.name] += 1
        return made(live, staging, domain, *args, **kwargs)

    run_audit(first(spark), state, DAY1, "srv", compat=True)
    with monkeypatch.context() as patch:
        patch.setattr(audit.diff, "compare", counting)
        run_audit(second(spark), state, DAY2, "srv", compat=True)
    # role rows of other servers go along, so the roles are compared anew after the deletion
    assert compared == {"instance": 1, "principals": 1, "groups": 1, "roles": 2, "objects": 1}
    assert rows(state.live(OBJECTS), "PrincipalName", "PermissionType", "PermissionState") == Counter(
        [("readers", "SELECT", "DENY"), ("bob", "UPDATE", "GRANT"), ("readers", "SELECT", "GRANT")]
    )


def test_compat_rows_that_older_history_deletes_come_back_as_new(spark, state):
    """With an early watermark ann's VIEW, gone at DAY2 and back at DAY3, is deleted and added once more."""
    day4 = "2024-01-20 00:00:00"
    for make, day in ((first, DAY1), (second, DAY2), (first, DAY3)):
        run_audit(make(spark), state, day, "srv", compat=True)
    run_audit(first(spark), state, day4, "srv", compat=True, since=DAY1)
    view = state.live(INSTANCE).filter("PrincipalName = 'ann' AND PermissionType = 'VIEW'")
    assert [str(r.PollDate) for r in view.collect()] == [day4]


def test_compat_run_without_watermark_deletes_nothing(spark, state):
    run_audit(first(spark), state, DAY1, "srv", compat=True)
    run_audit(second(spark), state, DAY2, "srv", compat=True, since=None)
    assert rows(state.live(INSTANCE), "PrincipalName", "PermissionType") == Counter(
        [("ann", "CONNECT SQL"), ("ann", "VIEW"), ("ann", "ALTER"), ("bob", "CONNECT SQL"), ("ann", "Database Role")]
    )
    run_audit(second(spark), state, DAY3, "srv", compat=True, since=DAY1)
    # deletes what both runs recorded; bob has no sid and is recorded again instead
    assert ("ann", "VIEW") not in rows(state.live(INSTANCE), "PrincipalName", "PermissionType")
    assert rows(state.history(PRINCIPALS), "PrincipalName") == Counter({("bob",): 2})
    assert set(values(state.live(OBJECTS), OBJECTS)) >= set(values(state.staging(OBJECTS), OBJECTS))


def test_uncommitted_run_is_invisible_and_repeated(spark, state, monkeypatch):
    run_audit(first(spark), state, DAY1, "srv")
    before = {d.name: polled(state.live(d), d) for d in DOMAINS}

    def lost(*_):
        raise ConnectionError("driver lost")

    with monkeypatch.context() as patch, pytest.raises(ConnectionError):
        patch.setattr(State, "commit", lost)
        run_audit(second(spark), state, DAY2, "srv")
    assert {d.name: polled(state.live(d), d) for d in DOMAINS} == before
    assert all(state.history(d).isEmpty() for d in (*DOMAINS, PRINCIPALS))
    # the same run id with an unchanged snapshot: leftovers of the lost attempt stay hidden
    assert run_audit(first(spark), state, DAY2, "srv").run_id == 2
    assert all(state.history(d).isEmpty() for d in (*DOMAINS, PRINCIPALS))
    assert run_audit(second(spark), state, DAY3, "srv").run_id == 3
    assert state.history(ROLES).count() == 1


def test_committed_run_id_is_not_run_again(spark, state):
    run_audit(first(spark), state, DAY1, "srv", run_id=7)
    again = run_audit(second(spark), state, DAY2, "srv", run_id=7)
    assert again.succeeded and not again.steps
    assert state.live(INSTANCE).count() == 4


class Feed:
    """Snapshots in files and announcements of them."""

    def __init__(self, spark, state, tmp_path):
        self.spark, self.state, self.at = spark, state, tmp_path
        self.inbox = tmp_path / "inbox"
        self.inbox.mkdir()

    def snapshot(self, name, source):
        for field in fields(source):
            getattr(source, field.name).write.parquet(f"{self.at}/{name}/{field.name}")
        return f"{self.at}/{name}"

    def announce(self, file, *entries):
        lines = [json.dumps({"path": path, "as_of": at, "server_name": "srv"}) for path, at in entries]
        (self.inbox / file).write_text("\n".join(lines))

    def drain(self, checkpoint):
        query = follow(self.spark, str(self.inbox), self.state, str(self.at / checkpoint))
        query.awaitTermination(300)
        assert query.exception() is None


def test_snapshots_arriving_as_a_stream(spark, state, tmp_path):
    feed = Feed(spark, state, tmp_path)
    a, b = feed.snapshot("a", first(spark)), feed.snapshot("b", second(spark))
    feed.announce("1.json", (b, DAY2), (a, DAY1))
    feed.drain("checkpoint")
    assert rows(state.history(INSTANCE), "PermissionType") == Counter([("VIEW",), ("CONNECT SQL",)])
    committed = state.commits().count()
    feed.drain("checkpoint")          # nothing new
    feed.drain("other_checkpoint")    # the same batch delivered again
    assert state.commits().count() == committed
    assert state.history(INSTANCE).count() == 2


# watermark, times and gate

HISTORY = "job_name string, step_id int, run_status int, run_date int, run_time int"


@pytest.mark.parametrize(
    "history, expected",
    [
        ([], None),
        ([("j", 0, 0, 20240101, 1)], None),
        ([("j", 1, 1, 20240101, 1), ("other", 0, 1, 20240101, 1)], None),
        ([("j", 0, 1, 20240101, 5712)], "2024-01-01 00:57:12"),
        ([("j", 0, 1, 20240101, 235959), ("j", 0, 1, 20240102, 7)], "2024-01-02 00:00:07"),
        ([("j", 0, 1, 20240102, 90000), ("j", 0, 1, 20240102, 100000), ("j", 0, 0, 20240103, 1)], "2024-01-02 10:00:00"),
        ([("j", 0, 1, 20240102, 90000)] * 2, "2024-01-02 09:00:00"),
    ],
)
def test_watermark(spark, history, expected):
    assert runs.watermark(spark.createDataFrame(history, HISTORY), "j") == expected


def test_history_joined_with_jobs(spark):
    history = spark.createDataFrame([(1, 0, 1, 20240101, 1), (9, 0, 1, 20250101, 1)], "job_id int, step_id int, run_status int, run_date int, run_time int")
    jobs = spark.createDataFrame([(1, "j"), (2, "k")], "job_id int, name string")
    assert runs.watermark(runs.with_job_names(history, jobs), "j") == "2024-01-01 00:00:01"


def test_times(spark):
    frame = spark.createDataFrame([(20240131, 5712), (20240131, 235959), (20241331, 1)], "d int, t int")
    got = frame.select(stamp_text(run_timestamp(F.col("d"), F.col("t")))).collect()
    assert [r[0] for r in got] == ["2024-01-31 00:57:12.000", "2024-01-31 23:59:59.000", None]


@pytest.mark.parametrize(
    "at, fires",
    [("09:59:59", False), ("10:00:00", True), ("10:14:59", True), ("10:15:00", False), ("22:05:00", False)],
)
def test_alert_window(spark, at, fires):
    ts = stamp(f"2024-01-01 {at}")
    assert spark.range(1).select(in_alert_window(ts)).first()[0] is fires
