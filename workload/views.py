"""Catalog extracts and snapshots derived from the given tables.

Each view is SQL that Spark and DuckDB read alike. All rows of the given
tables take part. A `prev_` view is an earlier state of the view it is named
after: the same rows with some values changed, which makes rows appear,
disappear and change between the two snapshots.
"""

from __future__ import annotations

import re

# the given tables in use, with their columns
BASE_TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}

_LOGIN_SID = (
    "CASE WHEN {k} % 29 = 0 THEN NULL ELSE 'S-' || lpad(CAST({k} AS STRING), 10, '0') END"
)
_USER_SID = (
    "CASE WHEN {k} % 7 = 0 THEN NULL ELSE 'U-' || lpad(CAST({k} AS STRING), 10, '0') END"
)
_LOGIN_KIND = (
    "CASE {k} % 3 WHEN 0 THEN 'WINDOWS_GROUP' WHEN 1 THEN 'WINDOWS_LOGIN' ELSE 'SQL_LOGIN' END"
)


def _instance_snapshot(name: str, disabled: str, state: str) -> str:
    key = "o_custkey"
    return f"""
SELECT 'SRV' || CAST({key} % 3 AS STRING) AS ServerName, 'Instance-Level' AS Scope,
{_LOGIN_SID.format(k=key)} AS sid, {name} || lpad(CAST({key} AS STRING), 9, '0') AS PrincipalName,
{_LOGIN_KIND.format(k=key)} AS PrincipalType, CASE WHEN {disabled} THEN 'Yes' ELSE 'No' END AS IsDisabled,
CASE WHEN o_orderpriority = '1-URGENT' THEN 'CONNECT SQL' ELSE o_orderpriority END AS PermissionType,
{state} AS PermissionState, 'SERVER' AS ClassDescription, 'N/A' AS EndpointName
FROM orders"""


def _server_principals(name: str, disabled_every: int) -> str:
    return f"""
SELECT c_custkey AS principal_id, {_LOGIN_SID.format(k='c_custkey')} AS sid, {name} AS name,
{_LOGIN_KIND.format(k='c_custkey')} AS type_desc,
CASE WHEN c_custkey % 97 = 0 THEN NULL WHEN c_custkey % {disabled_every} = 0 THEN 1 ELSE 0 END AS is_disabled
FROM customer"""


def _server_permissions(other_state: str) -> str:
    return f"""
SELECT o_custkey AS grantee_principal_id,
CASE o_orderkey % 4 WHEN 0 THEN o_orderkey % 40 ELSE -1 END AS major_id,
CASE WHEN o_orderkey % 8 = 0 THEN 'ENDPOINT' WHEN o_orderkey % 4 = 0 THEN 'SERVER_PRINCIPAL' ELSE 'SERVER' END AS class_desc,
CASE WHEN o_orderpriority = '1-URGENT' THEN 'CONNECT SQL' ELSE o_orderpriority END AS permission_name,
CASE o_orderstatus WHEN 'F' THEN 'GRANT' WHEN 'O' THEN 'DENY' ELSE '{other_state}' END AS state_desc
FROM orders"""


def _group_edges(second_parent_of: str) -> str:
    return f"""
SELECT m.c_name AS account_name, CASE WHEN k.parent IS NOT NULL THEN 'group' ELSE 'user' END AS type,
g.c_name AS permission_path
FROM (SELECT c_custkey, c_name, CAST(floor(c_custkey / 10) AS BIGINT) AS parent FROM customer
UNION ALL SELECT c_custkey, c_name, CAST(floor(c_custkey / 10) AS BIGINT) + 1 FROM customer
WHERE c_mktsegment = '{second_parent_of}') m
JOIN customer g ON g.c_custkey = m.parent AND g.c_custkey <> m.c_custkey
LEFT JOIN (SELECT DISTINCT CAST(floor(c_custkey / 10) AS BIGINT) AS parent FROM customer) k
ON k.parent = m.c_custkey"""


#: Supplier keys near that of a row of `lineitem`, so that every row names two suppliers.
_NEAR_SUPPLIER = "((l_suppkey + {step} * (l_partkey % {width}) + {shift}) % (SELECT count(*) FROM supplier))"


def _role_pairs(shift: str) -> str:
    key = _NEAR_SUPPLIER.format(step=1, width=40, shift=shift)
    return f"""
SELECT DISTINCT m.database_name, m.principal_id AS member_principal_id, r.principal_id AS role_principal_id
FROM (SELECT l_suppkey, key - key % 5 AS role_key FROM (SELECT l_suppkey, {key} AS key FROM lineitem) k) l
JOIN fx_database_principals m ON m.principal_id = l.l_suppkey
JOIN fx_database_principals r ON r.principal_id = l.role_key AND r.database_name = m.database_name
WHERE r.type_desc = 'DATABASE_ROLE' AND r.principal_id <> m.principal_id"""


def _user_groups(shift: str) -> str:
    key = _NEAR_SUPPLIER.format(step=11, width=7, shift=shift)
    return f"""
SELECT DISTINCT CAST(NULL AS STRING) AS sid, m.s_name AS PrincipalName, g.s_name AS ADGroupName,
TIMESTAMP '2024-01-01 00:00:00' AS PollDate
FROM (SELECT l_suppkey, {key} AS key FROM lineitem) l
JOIN supplier m ON m.s_suppkey = l_suppkey JOIN supplier g ON g.s_suppkey = l.key AND g.s_suppkey <> m.s_suppkey"""


def _database_permissions(state: str) -> str:
    return f"""
SELECT r_name AS database_name, c.class, c.class_desc,
CASE c.class WHEN 4 THEN l.l_suppkey WHEN 0 THEN 0 WHEN 3 THEN l.l_partkey % 30 ELSE l.l_partkey END AS major_id,
CASE WHEN c.class = 1 AND l.l_shipdate > TIMESTAMP '1997-01-01 00:00:00' THEN 1 + l.l_orderkey % 7 ELSE 0 END AS minor_id,
l.l_suppkey AS grantee_principal_id,
CASE l.l_returnflag WHEN 'A' THEN 'SELECT' WHEN 'N' THEN 'EXECUTE' ELSE 'UPDATE' END AS permission_name,
{state} AS state_desc
FROM lineitem l JOIN fx_securable_classes c ON c.line = l.l_linenumber AND c.flag = l.l_returnflag
JOIN supplier ON s_suppkey = l.l_suppkey JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey"""


VIEWS: dict[str, str] = {
    "fx_server_principals": _server_principals("c_name", 10),
    "prev_server_principals": _server_principals(
        "CASE WHEN c_custkey % 43 = 1 THEN 'Former ' || c_name ELSE c_name END", 11
    ),
    "fx_logins": f"""
SELECT {_LOGIN_SID.format(k='c_custkey')} AS sid, c_name AS name,
CASE WHEN c_custkey % 31 = 0 THEN 0 WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS isntgroup,
CASE WHEN c_custkey % 31 = 0 THEN 0 WHEN c_custkey % 3 = 1 THEN 1 ELSE 0 END AS isntuser,
CASE WHEN c_custkey % 31 = 0 THEN 1 WHEN c_custkey % 3 = 2 THEN 0 ELSE 1 END AS isntname,
CASE WHEN c_custkey % 10 = 0 THEN 10 WHEN c_custkey % 7 = 0 THEN 17 ELSE 9 END AS status,
CASE WHEN c_custkey % 50 = 1 THEN 1 ELSE 0 END AS sysadmin,
CASE WHEN c_custkey % 37 = 2 THEN 1 ELSE 0 END AS securityadmin,
CASE WHEN c_custkey % 41 = 3 THEN 1 ELSE 0 END AS serveradmin,
CASE WHEN c_custkey % 43 = 4 THEN 1 ELSE 0 END AS setupadmin,
CASE WHEN c_custkey % 47 = 5 THEN 1 ELSE 0 END AS processadmin,
CASE WHEN c_custkey % 53 = 6 THEN 1 ELSE 0 END AS diskadmin,
CASE WHEN c_custkey % 25 = 7 THEN 1 ELSE 0 END AS dbcreator,
CASE WHEN c_custkey % 20 = 8 THEN 1 ELSE 0 END AS bulkadmin
FROM customer""",
    "fx_server_permissions": _server_permissions("GRANT_WITH_GRANT_OPTION"),
    "prev_server_permissions": _server_permissions("GRANT"),
    "fx_endpoints": "SELECT n_nationkey AS endpoint_id, n_name AS name FROM nation",
    "fx_databases": """
SELECT r_name AS name, CASE WHEN r_regionkey = 4 THEN 'OFFLINE' ELSE 'ONLINE' END AS state_desc,
CASE WHEN r_regionkey = 3 THEN 'SINGLE_USER' ELSE 'MULTI_USER' END AS user_access_desc FROM region""",
    # an earlier and a later list of databases: one comes, two go out of reach, one is dropped
    "prev_databases": """
SELECT r_name AS name, CASE WHEN r_regionkey = 2 THEN 'OFFLINE' ELSE 'ONLINE' END AS state_desc,
'MULTI_USER' AS user_access_desc FROM region""",
    "later_databases": "SELECT name, state_desc, user_access_desc FROM fx_databases WHERE name <> 'AMERICA'",
    "fx_database_principals": f"""
SELECT r_name AS database_name, s_suppkey AS principal_id, {_USER_SID.format(k='s_suppkey')} AS sid,
s_name AS name, CASE WHEN s_suppkey % 5 = 0 THEN 'DATABASE_ROLE' ELSE 'SQL_USER' END AS type_desc
FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey""",
    "fx_database_role_members": _role_pairs("0"),
    "prev_database_role_members": _role_pairs("CASE WHEN l_suppkey % 4 = 1 THEN 20 ELSE 0 END"),
    "fx_securable_classes": """
SELECT line, flag, class, class_desc FROM (VALUES
(1, 'A', 0, 'DATABASE'), (1, 'N', 0, 'DATABASE'), (1, 'R', 0, 'DATABASE'),
(2, 'A', 1, 'OBJECT_OR_COLUMN'), (2, 'N', 1, 'OBJECT_OR_COLUMN'), (2, 'R', 1, 'OBJECT_OR_COLUMN'),
(3, 'A', 3, 'SCHEMA'), (3, 'N', 3, 'SCHEMA'), (3, 'R', 3, 'SCHEMA'),
(4, 'A', 4, 'DATABASE_PRINCIPAL'), (4, 'N', 4, 'DATABASE_PRINCIPAL'), (4, 'R', 4, 'DATABASE_PRINCIPAL'),
(5, 'A', 5, 'ASSEMBLY'), (5, 'N', 5, 'ASSEMBLY'), (5, 'R', 5, 'ASSEMBLY'),
(6, 'A', 6, 'TYPE'), (6, 'N', 6, 'TYPE'), (6, 'R', 6, 'TYPE'),
(7, 'A', 10, 'XML_SCHEMA_COLLECTION'), (7, 'N', 25, 'CERTIFICATE'), (7, 'R', 25, 'CERTIFICATE')
) AS t(line, flag, class, class_desc)""",
    "fx_database_permissions": _database_permissions(
        "CASE WHEN l.l_discount > 0.08 THEN 'DENY' WHEN l.l_linestatus = 'F' THEN 'GRANT' ELSE 'GRANT_WITH_GRANT_OPTION' END"
    ),
    "prev_database_permissions": _database_permissions(
        "CASE WHEN l.l_linestatus = 'F' THEN 'GRANT' ELSE 'GRANT_WITH_GRANT_OPTION' END"
    ),
    "fx_all_objects": """
SELECT r_name AS database_name, p_partkey AS object_id, p_partkey % 30 AS schema_id,
p_name || ' ' || CAST(p_partkey AS STRING) AS name, p_type AS type_desc
FROM part JOIN region ON r_regionkey = p_partkey % 5""",
    "fx_schemas": """
SELECT DISTINCT r_name AS database_name, n_nationkey AS schema_id, n_name AS name
FROM part JOIN region ON r_regionkey = p_partkey % 5 JOIN nation ON n_nationkey = p_partkey % 30""",
    "fx_all_columns": """
SELECT r_name AS database_name, l_partkey AS object_id, l_linenumber AS column_id,
'col_' || CAST(l_partkey AS STRING) || '_' || CAST(l_linenumber AS STRING) AS name
FROM (SELECT DISTINCT l_partkey, l_linenumber FROM lineitem) l JOIN region ON r_regionkey = l_partkey % 5""",
    "fx_securables": """
SELECT database_name, CASE WHEN p_size <= 15 THEN 'ASSEMBLY' WHEN p_size <= 30 THEN 'TYPE' ELSE 'CERTIFICATE' END AS kind,
p_partkey AS id, p_brand || '_' || CAST(p_partkey AS STRING) AS name
FROM part JOIN fx_all_objects ON object_id = p_partkey
UNION ALL SELECT database_name, 'XML_SCHEMA_COLLECTION', p_partkey, p_brand || '_xsc' || '_' || CAST(p_partkey AS STRING)
FROM part JOIN fx_all_objects ON object_id = p_partkey WHERE p_partkey % 3 > 0""",
    "fx_group_edges": _group_edges("BUILDING"),
    "prev_group_edges": _group_edges("MACHINERY"),
    # rings of ten groups that contain each other, every second ring inside the next one, and users in them
    "fx_ring_edges": """
SELECT m.c_name AS account_name, 'group' AS type, g.c_name AS permission_path
FROM (SELECT c_name, c_custkey - (c_custkey - 1) % 10 + c_custkey % 10 AS parent FROM customer
UNION ALL SELECT c_name, c_custkey + 10 FROM customer WHERE c_custkey % 20 = 7) m
JOIN customer g ON g.c_custkey = m.parent
UNION ALL SELECT s_name, 'user', c_name FROM supplier JOIN customer ON c_custkey = s_suppkey""",
    "fx_instance": _instance_snapshot(
        "CASE WHEN o_custkey % 43 = 1 THEN 'Renamed#' ELSE 'Customer#' END",
        "o_custkey % 10 = 0 OR o_custkey % 41 = 1",
        "CASE WHEN o_orderkey % 17 = 0 THEN 'DENY' WHEN o_orderstatus = 'F' THEN 'GRANT' ELSE 'DENY' END",
    ),
    "prev_instance": (
        "SELECT DISTINCT *, TIMESTAMP '2024-01-01 00:00:00' AS PollDate FROM ("
        + _instance_snapshot(
            "'Customer#'", "o_custkey % 10 = 0",
            "CASE o_orderstatus WHEN 'F' THEN 'GRANT' ELSE 'DENY' END",
        )
        + ") t"
    ),
    "fx_user_groups": _user_groups("0"),
    "prev_user_groups": _user_groups("CASE WHEN l_suppkey % 4 = 1 THEN 3 ELSE 0 END"),
    # a login whose sid is that of another database user
    "fx_user_logins": f"""
SELECT {_USER_SID.format(k='(s_suppkey + 1)')} AS sid, s_name AS name FROM supplier""",
    "fx_group_mappings": """
SELECT CAST(NULL AS STRING) AS sid, account_name AS PrincipalName, permission_path AS ADGroupName,
TIMESTAMP '2024-01-01 00:00:00' AS PollDate FROM fx_group_edges
UNION ALL SELECT sid, PrincipalName, ADGroupName, PollDate FROM fx_user_groups""",
    # runs of several jobs by id, some of a job that is not known any more
    "fx_jobs": """
SELECT CAST(r_regionkey AS BIGINT) AS job_id, CASE WHEN r_regionkey = 1 THEN 'permissions-audit' ELSE 'job of ' || r_name END AS name
FROM region""",
    "fx_job_runs": """
SELECT CAST(user_id % 7 AS BIGINT) AS job_id, CAST(event_id % 3 AS INT) AS step_id,
CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS run_status,
CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS INT) AS run_date,
CAST(hour(ts) * 10000 + minute(ts) * 100 + floor(second(ts)) AS INT) AS run_time FROM events""",
    "fx_job_history": """
SELECT 'permissions-audit' AS job_name, CAST(event_id % 3 AS INT) AS step_id,
CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS run_status,
CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS INT) AS run_date,
CAST(hour(ts) * 10000 + minute(ts) * 100 + floor(second(ts)) AS INT) AS run_time FROM events""",
}


def needed(sql: str, views: dict[str, str] | None = None) -> list[str]:
    """Views that a query mentions, directly or through other views, in definition order."""
    views = VIEWS if views is None else views
    wanted: set[str] = set()
    open_texts = [sql]
    while open_texts:
        for word in set(re.findall(r"\w+", open_texts.pop())) & views.keys():
            if word not in wanted:
                wanted.add(word)
                open_texts.append(views[word])
    return [name for name in views if name in wanted]


def with_views(sql: str, views: dict[str, str] | None = None, recursive: bool = False) -> str:
    """The query with the views it needs as leading common table expressions."""
    views = VIEWS if views is None else views
    parts = [f"{name} AS ({views[name]})" for name in needed(sql, views)]
    if not parts:
        return sql
    return f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(parts)} {sql}"
