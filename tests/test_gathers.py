"""Gathers on hand-made catalogs."""

import pytest

from grantledger.functions.labels import status_text
from grantledger.operators import databases, instance
from grantledger.sources.catalogs import COLUMNS, checked

PRINCIPALS = "principal_id int, sid string, name string, type_desc string, is_disabled int"
PERMISSIONS = (
    "grantee_principal_id int, major_id int, class_desc string, permission_name string, state_desc string"
)


def server(spark):
    principals = spark.createDataFrame(
        [(1, "S1", "ann", "SQL_LOGIN", 0), (2, None, "bob", "WINDOWS_LOGIN", 1), (3, "S3", "cy", "SQL_LOGIN", None)],
        PRINCIPALS,
    )
    permissions = spark.createDataFrame(
        [
            (1, 2, "SERVER_PRINCIPAL", "IMPERSONATE", "GRANT"),
            (1, 2, "ENDPOINT", "CONNECT", "GRANT"),
            (2, 0, "SERVER", "CONNECT SQL", "GRANT_WITH_GRANT_OPTION"),
            (3, 9, "ENDPOINT", "CONNECT", "DENY"),
            (8, 0, "SERVER", "CONNECT SQL", "GRANT"),
        ],
        PERMISSIONS,
    )
    endpoints = spark.createDataFrame([(2, "mirror"), (0, "zero")], "endpoint_id int, name string")
    return principals, permissions, endpoints


def shown(df):
    return {
        (r.PrincipalName, r.PermissionType, r.ClassDescription, r.IsDisabled, r.EndpointName)
        for r in df.collect()
    }


def test_grants_strict_resolve_ids_within_their_class(spark):
    rows = instance.grants(*server(spark), "srv")
    assert shown(rows) == {
        ("ann", "IMPERSONATE", "SERVER_PRINCIPAL", "No", "bob"),
        ("ann", "CONNECT", "ENDPOINT", "No", "mirror"),
        ("bob", "CONNECT SQL", "SERVER", "Yes", "N/A"),
        ("cy", "CONNECT", "ENDPOINT", "???", "N/A"),
    }
    assert {r.PermissionState for r in rows.collect()} == {"GRANT", "DENY", "GRANT_WITH_GRANT_OPTION"}


def test_grants_compat_take_the_endpoint_of_an_equal_id(spark):
    assert shown(instance.grants(*server(spark), "srv", compat=True)) == {
        ("ann", "IMPERSONATE", "SERVER_PRINCIPAL", "No", "mirror"),
        ("ann", "CONNECT", "ENDPOINT", "No", "mirror"),
        ("bob", "CONNECT SQL", "SERVER", "Yes", "zero"),
        ("cy", "CONNECT", "ENDPOINT", "???", "N/A"),
    }


def test_fixed_roles(spark):
    flags = ", ".join(f"{r} int" for r in instance.FIXED_SERVER_ROLES)
    schema = f"sid string, name string, isntgroup int, isntuser int, isntname int, status int, {flags}"
    none = (0,) * 8
    rows = [
        ("a", "grp", 1, 1, 1, 9, 1, 0, 0, 0, 0, 0, 0, 1),
        ("b", "usr", 0, 1, 1, 10, 0, 1, 0, 0, 0, 0, 0, 0),
        ("c", "sql", 0, 0, 0, None, 0, 0, 1, 0, 0, 0, 0, 0),
        ("d", "odd", 0, 0, 1, 9, 0, 0, 0, 0, 0, 0, 1, 0),
        ("e", "idle", 0, 0, 0, 9, *none),
        ("f", "unset", 0, 0, 0, 9, *(None,) * 8),
    ]
    got = instance.fixed_role_members(spark.createDataFrame(rows, schema), "srv").collect()
    assert {(r.PrincipalName, r.PrincipalType, r.IsDisabled, r.EndpointName) for r in got} == {
        ("grp", "WINDOWS_GROUP", "No", "sysadmin"), ("grp", "WINDOWS_GROUP", "No", "bulkadmin"),
        ("usr", "WINDOWS_LOGIN", "Yes", "securityadmin"), ("sql", "SQL_LOGIN", "Yes", "serveradmin"),
        ("odd", None, "No", "dbcreator"),
    }
    assert {(r.Scope, r.PermissionType, r.PermissionState, r.ClassDescription) for r in got} == {
        ("Instance-Level", "Database Role", "GRANT", "SERVER")
    }


def test_login_status_words(spark):
    from pyspark.sql import functions as F

    got = spark.createDataFrame([(9,), (10,), (17,), (None,)], "s int").select(status_text(F.col("s")))
    assert [r[0] for r in got.collect()] == ["Enabled", "Disabled", "???", "???"]


def database(spark):
    frame = spark.createDataFrame
    return dict(
        principals=frame(
            [("db", 1, "U1", "ann", "SQL_USER"), ("db", 2, None, "readers", "DATABASE_ROLE"),
             ("off", 1, "U9", "eve", "SQL_USER")],
            "database_name string, principal_id int, sid string, name string, type_desc string",
        ),
        objects=frame(
            [("db", 10, 5, "t1", "USER_TABLE"), ("db", 11, 99, "t2", "VIEW"), ("off", 10, 5, "x", "VIEW")],
            "database_name string, object_id int, schema_id int, name string, type_desc string",
        ),
        schemas=frame([("db", 5, "dbo")], "database_name string, schema_id int, name string"),
        columns=frame(
            [("db", 10, 1, "c1"), ("db", 11, 1, "d1"), ("db", 10, 2, "c2")],
            "database_name string, object_id int, column_id int, name string",
        ),
        securables=frame(
            [("db", "ASSEMBLY", 7, "asm"), ("db", "TYPE", 7, "typ"), ("db", "CERTIFICATE", 7, "cert"),
             ("db", "XML_SCHEMA_COLLECTION", 10, "xsc")],
            "database_name string, kind string, id int, name string",
        ),
        databases=frame(
            [("db", "ONLINE", "MULTI_USER"), ("off", "OFFLINE", "MULTI_USER"), ("one", "ONLINE", "SINGLE_USER")],
            "name string, state_desc string, user_access_desc string",
        ),
    )


CASES = [
    # class, major, minor -> object type, schema, object, column
    ((0, 0, 0), ("CLASS", "N/A", "N/A", "N/A")),
    ((1, 10, 0), ("USER_TABLE", "dbo", "t1", "N/A")),
    ((1, 10, 2), ("USER_TABLE", "dbo", "t1", "c2")),
    ((1, 11, 1), ("VIEW", "Unknown", "t2", "d1")),
    ((1, 11, 2), ("VIEW", "Unknown", "t2", "N/A")),
    ((1, -8, 0), ("CLASS", "Unknown", "N/A", "N/A")),
    ((3, 5, 0), ("CLASS", "dbo", "N/A", "N/A")),
    ((3, 6, 0), ("CLASS", None, "N/A", "N/A")),
    ((4, 2, 0), ("CLASS", "N/A", "readers", "N/A")),
    ((4, 77, 0), ("CLASS", "N/A", None, "N/A")),
    ((5, 7, 0), ("CLASS", "N/A", "asm", "N/A")),
    ((6, 7, 0), ("CLASS", "N/A", "typ", "N/A")),
    ((6, 8, 0), ("CLASS", "N/A", None, "N/A")),
    ((10, 10, 0), ("CLASS", "N/A", "xsc", "N/A")),
    ((10, 50, 0), ("CLASS", "N/A", "Unknown", "N/A")),
    ((25, 7, 0), ("CLASS", "N/A", "cert", "N/A")),
    ((25, 8, 0), ("CLASS", "N/A", "Unknown", "N/A")),
]


def test_object_permissions_of_all_classes(spark):
    parts = database(spark)
    rows = [("db", c, "CLASS", major, minor, 1, f"p{i}", "GRANT") for i, ((c, major, minor), _) in enumerate(CASES)]
    rows += [("off", 0, "CLASS", 0, 0, 1, "offline", "GRANT"), ("db", 0, "CLASS", 0, 0, 55, "orphan", "DENY"),
             ("db", 17, "CLASS", 0, 0, 1, "other class", "GRANT")]
    permissions = spark.createDataFrame(
        rows,
        "database_name string, class int, class_desc string, major_id int, minor_id int, "
        "grantee_principal_id int, permission_name string, state_desc string",
    )
    got = databases.object_permissions(permissions, server_name="srv", **parts).collect()
    found = {
        r.PermissionType: (r.ObjectType, r.SchemaName, r.ObjectName, r.ColumnName) for r in got
    }
    expected = {f"p{i}": names for i, (_, names) in enumerate(CASES)}
    assert found == {**expected, "orphan": ("CLASS", "N/A", "N/A", "N/A")}
    assert len(got) == len(CASES) + 1
    orphan = next(r for r in got if r.PermissionType == "orphan")
    assert orphan.sid is None and orphan.PrincipalName is None
    assert {(r.ServerName, r.Scope) for r in got} == {("srv", "db")}
    # compat mode takes the id of a collection for that of an object
    compat = databases.object_permissions(permissions, server_name="srv", compat=True, **parts)
    names = {r.PermissionType: r.ObjectName for r in compat.collect()}
    assert names == {r.PermissionType: r.ObjectName for r in got} | {"p13": "t1"}


def test_permissions_meet_only_names_grantees_and_columns(spark, conf):
    """Schemas join the objects: of three joins with the permissions none is by schema."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    parts = database(spark)
    permissions = spark.createDataFrame(
        [], "database_name string, class int, class_desc string, major_id int, minor_id int, "
        "grantee_principal_id int, permission_name string, state_desc string",
    )
    df = databases.object_permissions(permissions, server_name="srv", **parts)
    text = df._jdf.queryExecution().optimizedPlan().toString()
    schema_joins = [line for line in text.splitlines() if "Join" in line and "schema_id" in line]
    assert len(schema_joins) == 1 and text.count("Join LeftOuter") == 4


def test_role_members_of_usable_databases(spark):
    parts = database(spark)
    members = spark.createDataFrame(
        [("db", 1, 2), ("off", 1, 1), ("db", 1, 66)],
        "database_name string, member_principal_id int, role_principal_id int",
    )
    got = databases.role_members(parts["principals"], members, parts["databases"], "srv").collect()
    assert [tuple(r) for r in got] == [("srv", "db", "U1", "ann", "SQL_USER", "readers")]


def test_several_servers_in_one_extract(spark):
    principals = spark.createDataFrame(
        [("s1", 1, "A", "ann", "SQL_LOGIN", 0), ("s2", 1, "B", "bob", "SQL_LOGIN", 0)],
        f"server_name string, {PRINCIPALS}",
    )
    permissions = spark.createDataFrame(
        [("s1", 1, 1, "SERVER_PRINCIPAL", "VIEW", "GRANT"), ("s2", 1, 1, "SERVER_PRINCIPAL", "VIEW", "GRANT")],
        f"server_name string, {PERMISSIONS}",
    )
    endpoints = spark.createDataFrame([], "server_name string, endpoint_id int, name string")
    got = instance.grants(principals, permissions, endpoints).collect()
    assert {(r.ServerName, r.PrincipalName, r.EndpointName) for r in got} == {
        ("s1", "ann", "ann"), ("s2", "bob", "bob"),
    }


def test_server_name_is_required_once(spark):
    with pytest.raises(ValueError, match="server_name"):
        instance.grants(*server(spark))


def test_missing_extract_column_is_named(spark):
    with pytest.raises(ValueError, match="endpoints lacks name"):
        checked(spark.createDataFrame([(1,)], "endpoint_id int"), "endpoints")
    frame = spark.createDataFrame([(1, "e", "x")], "endpoint_id int, name string, more string")
    assert checked(frame, "endpoints").columns == list(COLUMNS["endpoints"])
