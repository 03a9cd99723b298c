"""The counts measured beforehand on the views written down in FIXTURES.md."""

import re
from functools import cache

import pytest
from pyspark.sql import functions as F

from grantledger.operators import databases, diff, groups, instance
from grantledger.schemas import INSTANCE, PRINCIPALS
from grantledger.sources import runs
from tests.conftest import ROOT, TESTDATA
from workload.registry import Views


@cache
def written_views():
    text = (ROOT / "FIXTURES.md").read_text()
    return dict(re.findall(r"### (fx_\w+)\n.*?```sql\n(.*?)```", text, re.S))


@pytest.fixture(scope="module")
def v(spark):
    views = Views(spark, f"{TESTDATA}/sf0.001", written_views())
    return views


NOW = "2024-02-01 00:00:00"
BEFORE = "2024-01-15 00:00:00"


def test_all_views_are_found():
    assert len(written_views()) == 16


def test_instance_changes(v):
    gone = diff.removed(v.fx_instance_prev, v.fx_instance_cur, INSTANCE, NOW)
    counts = gone.agg(
        F.count(F.lit(1)),
        F.count_if(F.col("sid").isNull()),
        F.count_if(F.col("PermissionType") == "CONNECT SQL"),
    ).first()
    assert tuple(counts) == (86, 10, 15)
    assert diff.added(v.fx_instance_prev, v.fx_instance_cur, INSTANCE, NOW).count() == 88
    assert diff.removed(v.fx_instance_prev, v.fx_instance_cur, PRINCIPALS, NOW).count() == 5


def test_instance_live_in_compat_mode(v):
    gone = diff.removed(v.fx_instance_prev, v.fx_instance_cur, INSTANCE, NOW)
    live = diff.apply_removed(v.fx_instance_prev, gone, INSTANCE, True, BEFORE)
    assert live.count() == 785
    dropped = diff.removed(v.fx_instance_prev, v.fx_instance_cur, PRINCIPALS, NOW)
    live = diff.apply_removed(live, dropped, PRINCIPALS, True, BEFORE)
    assert live.count() == 781
    assert diff.added(live, v.fx_instance_cur, INSTANCE, NOW).count() == 88


def test_gather_counts(v):
    compat = instance.grants(
        v.fx_server_principals, v.fx_server_permissions, v.fx_endpoints, "srv", compat=True
    )
    assert compat.count() == 1500
    assert instance.fixed_role_members(v.fx_syslogins, "srv").count() == 36
    everywhere = v.fx_databases.withColumns(
        {"state_desc": F.lit("ONLINE"), "user_access_desc": F.lit("MULTI_USER")}
    )
    pairs = databases.role_members(
        v.fx_database_principals, v.fx_database_role_members, everywhere, "srv"
    )
    assert pairs.count() == 2
    columns = databases.object_permissions(
        v.fx_database_permissions, v.fx_database_principals, v.fx_all_objects, v.fx_schemas,
        v.fx_all_columns, v.fx_securables, everywhere, "srv", classes=[1],
    )
    assert columns.count() == 833


def test_group_counts(v):
    assert groups.closure(v.fx_group_edges).count() == 339
    assert groups.gather(v.fx_group_edges, v.fx_syslogins, compat=True).count() == 45


def test_last_success(v):
    row = runs.last_success(v.fx_job_history, "permissions-audit").first()
    assert (row.run_date, row.run_time) == (20240130, 232616)
