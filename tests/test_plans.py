"""What Catalyst makes of the operators: scans, shuffles, skew, code generation."""

import re

import pytest

from grantledger.operators import diff, instance
from grantledger.schemas import INSTANCE
from grantledger.session import shared_dir, shuffle_partitions
from tests.rows import DAY2, grant, live, staging


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"Exchange hashpartitioning", plan(df)))


@pytest.fixture
def snapshots(spark, tmp_path):
    live(spark, INSTANCE, [grant(), grant("b")]).write.parquet(f"{tmp_path}/live")
    staging(spark, INSTANCE, [grant()]).write.parquet(f"{tmp_path}/staging")
    return spark.read.parquet(f"{tmp_path}/live"), spark.read.parquet(f"{tmp_path}/staging")


def test_comparison_needs_one_shuffle(spark, conf, snapshots):
    conf(spark__sql__adaptive__enabled="false")
    for df in (
        diff.removed(*snapshots, INSTANCE, DAY2),
        diff.added(*snapshots, INSTANCE, DAY2),
        diff.changes(*snapshots, INSTANCE),
    ):
        assert exchanges(df) == 1 and "Join" not in plan(df)
        assert plan(df).count("HashAggregate") == 2  # partial before the shuffle


def test_principal_comparison_reads_five_columns(snapshots):
    from grantledger.schemas import PRINCIPALS

    text = diff.removed(*snapshots, PRINCIPALS, DAY2)._jdf.queryExecution().toString()
    schemas = re.findall(r"ReadSchema: struct<(.*?)>", text)
    assert schemas and all("EndpointName" not in s and "PermissionType" not in s for s in schemas)


def test_next_live_does_not_shuffle_live_for_few_changes(spark, snapshots, tmp_path):
    before, now = snapshots
    diff.changes(before, now, INSTANCE).write.parquet(f"{tmp_path}/delta")
    delta = spark.read.parquet(f"{tmp_path}/delta")
    after = diff.next_live(before, delta, INSTANCE, DAY2)
    after.collect()
    text = plan(after)
    final = text[: text.index("== Initial Plan ==")] if "== Initial Plan ==" in text else text
    assert "BroadcastHashJoin" in final and "SortMergeJoin" not in final


def test_sticky_history_filter_reaches_the_scan(spark, snapshots):
    before, now = snapshots
    text = diff.changes(before, now, INSTANCE, history=before)._jdf.queryExecution().toString()
    assert "EqualNullSafe(PermissionType,CONNECT SQL)" in text or "EqualTo(PermissionType,CONNECT SQL)" in text


def test_fixed_roles_scan_the_logins_once(spark, tmp_path):
    flags = ", ".join(f"{r} int" for r in instance.FIXED_SERVER_ROLES)
    schema = f"sid string, name string, isntgroup int, isntuser int, isntname int, status int, {flags}"
    spark.createDataFrame([("a", "n", 1, 0, 0, 9, *(1,) * 8)], schema).write.parquet(f"{tmp_path}/logins")
    df = instance.fixed_role_members(spark.read.parquet(f"{tmp_path}/logins"), "srv")
    assert plan(df).count("FileScan parquet") == 1
    assert "PushedFilters: [Or(" in df._jdf.queryExecution().toString()
    assert df.count() == 8


def hot_catalog(spark, size=30_000):
    """Server grants of which a third belong to one principal and most point to id 0."""
    permissions = spark.range(size).selectExpr(
        "IF(id % 3 = 0, 7L, id) AS grantee_principal_id", "0L AS major_id",
        "IF(id % 100 = 0, 'ENDPOINT', 'SERVER') AS class_desc",
        "concat('p', id) AS permission_name", "'GRANT' AS state_desc",
    )
    principals = spark.range(size).selectExpr(
        "id AS principal_id", "concat('S', id) AS sid", "concat('n', id) AS name",
        "'SQL_LOGIN' AS type_desc", "0 AS is_disabled",
    )
    endpoints = spark.range(100).selectExpr("id AS endpoint_id", "concat('e', id) AS name")
    return principals, permissions, endpoints


def test_hot_grantee_is_split_at_run_time(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="8",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
    )
    df = instance.grants(*hot_catalog(spark), "srv")
    assert len(df.collect()) == 30_000
    assert "SortMergeJoin(skew=true)" in plan(df)


def test_rows_without_a_securable_are_spread(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false",
        spark__sql__shuffle__partitions="8",
    )
    df = instance.grants(*hot_catalog(spark, 8_000), "srv")
    sizes = [r[1] for r in df.selectExpr("spark_partition_id() AS p").groupBy("p").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * min(sizes)


def test_shuffle_width_follows_the_input():
    assert shuffle_partitions(0, 8) == 8
    assert shuffle_partitions(100 << 40, 4000) == 820_000 - 820_000 % 4000 + (0 if 820_000 % 4000 == 0 else 4000)


def test_shared_dir_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_operators_run_without_python_workers(snapshots):
    text = plan(diff.upsert(*snapshots, DAY2))
    assert "Python" not in text and "Pandas" not in text
