"""The registered queries as SQL, written independently of the Spark operators."""

from __future__ import annotations

from grantledger.schemas import GROUPS, INSTANCE, OBJECTS, PRINCIPALS, ROLES

AS_OF = "2024-02-01 00:00:00"
POLLED = "2024-01-01 00:00:00"
LOGIN = "Customer#000000042"
USER = "Supplier#000000003"
ASKED = ("Supplier#000000001", "Supplier#000000003", "Supplier#000000007", "Supplier#000000010")
ASKED_LOGINS = ("Customer#000000007", "Customer#000000010", "Customer#000000042", "Customer#000000100")
#: Before both snapshots, between them, and at the second one.
MOMENTS = ("2023-12-31 12:00:00", "2024-01-15 08:00:00", AS_OF)
JOB = "permissions-audit"
SERVER = "SRV"


def cols(names, alias: str = "") -> str:
    return ", ".join(f"{alias}{n}" for n in names)


def null_safe(names, a: str, b: str) -> str:
    return " AND ".join(f"{a}.{n} IS NOT DISTINCT FROM {b}.{n}" for n in names)


def plain(names, a: str, b: str) -> str:
    return " AND ".join(f"{a}.{n} = {b}.{n}" for n in names)


def minus(domain, first: str, second: str) -> str:
    listed = cols(domain.values)
    return f"SELECT {listed} FROM {first} EXCEPT SELECT {listed} FROM {second}"


# instance domain

def instance_grants(principals: str, permissions: str, compat: bool = False) -> str:
    on_endpoint = "" if compat else " AND p.class_desc = 'ENDPOINT'"
    on_principal = "" if compat else " AND p.class_desc = 'SERVER_PRINCIPAL'"
    return f"""
SELECT '{SERVER}' AS ServerName, 'Instance-Level' AS Scope, g.sid, g.name AS PrincipalName,
g.type_desc AS PrincipalType, CASE WHEN g.is_disabled = 0 THEN 'No' WHEN g.is_disabled = 1 THEN 'Yes' ELSE '???' END AS IsDisabled,
p.permission_name AS PermissionType, p.state_desc AS PermissionState, p.class_desc AS ClassDescription,
COALESCE(e.name, t.name, 'N/A') AS EndpointName
FROM {permissions} p JOIN {principals} g ON g.principal_id = p.grantee_principal_id
LEFT JOIN fx_endpoints e ON e.endpoint_id = p.major_id{on_endpoint}
LEFT JOIN {principals} t ON t.principal_id = p.major_id{on_principal}"""


def fixed_roles(roles) -> str:
    branches = [
        f"""SELECT '{SERVER}' AS ServerName, 'Instance-Level' AS Scope, sid, name AS PrincipalName,
CASE WHEN isntgroup = 1 THEN 'WINDOWS_GROUP' WHEN isntuser = 1 THEN 'WINDOWS_LOGIN' WHEN isntname = 0 THEN 'SQL_LOGIN' END AS PrincipalType,
CASE WHEN status = 9 THEN 'No' ELSE 'Yes' END AS IsDisabled, 'Database Role' AS PermissionType,
'GRANT' AS PermissionState, 'SERVER' AS ClassDescription, '{role}' AS EndpointName FROM fx_logins WHERE {role} = 1"""
        for role in roles
    ]
    return " UNION ALL ".join(branches)


def instance_gather(principals: str, permissions: str, roles) -> str:
    listed = cols(INSTANCE.values)
    return (
        f"SELECT {listed} FROM ({instance_grants(principals, permissions)}) g "
        f"UNION ALL SELECT {listed} FROM ({fixed_roles(roles)}) r"
    )


# databases

def usable(databases: str) -> str:
    return f"SELECT name FROM {databases} WHERE state_desc = 'ONLINE' AND user_access_desc = 'MULTI_USER'"


def unread(databases: str) -> str:
    """Databases that are listed but could not be read."""
    return f"SELECT name FROM {databases} EXCEPT {usable(databases)}"


def role_members(members: str, databases: str = "fx_databases") -> str:
    return f"""
SELECT '{SERVER}' AS ServerName, m.database_name AS Scope, p.sid, p.name AS PrincipalName,
p.type_desc AS PrincipalType, r.name AS DatabaseRole
FROM {members} m
JOIN fx_database_principals p ON p.database_name = m.database_name AND p.principal_id = m.member_principal_id
JOIN fx_database_principals r ON r.database_name = m.database_name AND r.principal_id = m.role_principal_id
WHERE m.database_name IN ({usable(databases)})"""


# per class: object type, schema, object and column names, and the joins they come from
_IN_DB = "{a}.database_name = p.database_name"


def _lookup(view: str, alias: str, condition: str) -> str:
    return f"LEFT JOIN {view} {alias} ON {_IN_DB.format(a=alias)} AND {condition}"


OBJECT_CLASSES = {
    0: ("p.class_desc", "'N/A'", "'N/A'", "'N/A'", ""),
    1: (
        "COALESCE(o.type_desc, p.class_desc)", "COALESCE(s.name, 'Unknown')",
        "COALESCE(o.name, 'N/A')", "COALESCE(c.name, 'N/A')",
        " ".join([
            _lookup("fx_all_objects", "o", "o.object_id = p.major_id"),
            _lookup("fx_schemas", "s", "s.schema_id = o.schema_id"),
            _lookup("fx_all_columns", "c", "c.object_id = p.major_id AND c.column_id = p.minor_id"),
        ]),
    ),
    3: ("p.class_desc", "s.name", "'N/A'", "'N/A'",
        _lookup("fx_schemas", "s", "s.schema_id = p.major_id")),
    4: ("p.class_desc", "'N/A'", "t.name", "'N/A'",
        _lookup("fx_database_principals", "t", "t.principal_id = p.major_id")),
    5: ("p.class_desc", "'N/A'", "t.name", "'N/A'",
        _lookup("fx_securables", "t", "t.kind = 'ASSEMBLY' AND t.id = p.major_id")),
    6: ("p.class_desc", "'N/A'", "t.name", "'N/A'",
        _lookup("fx_securables", "t", "t.kind = 'TYPE' AND t.id = p.major_id")),
    10: ("p.class_desc", "'N/A'", "COALESCE(t.name, 'Unknown')", "'N/A'",
         _lookup("fx_securables", "t", "t.kind = 'XML_SCHEMA_COLLECTION' AND t.id = p.major_id")),
    25: ("p.class_desc", "'N/A'", "COALESCE(t.name, 'Unknown')", "'N/A'",
         _lookup("fx_securables", "t", "t.kind = 'CERTIFICATE' AND t.id = p.major_id")),
}


# in compat mode a collection's id is looked up among the objects
COLLECTION_COMPAT = ("p.class_desc", "'N/A'", "COALESCE(o.name, 'Unknown')", "'N/A'",
                     _lookup("fx_all_objects", "o", "o.object_id = p.major_id"))


def object_class(
    cls: int, permissions: str = "fx_database_permissions", compat: bool = False, databases: str = "fx_databases"
) -> str:
    kind, schema, name, column, joins = COLLECTION_COMPAT if compat and cls == 10 else OBJECT_CLASSES[cls]
    return f"""
SELECT '{SERVER}' AS ServerName, p.database_name AS Scope, g.sid, g.name AS PrincipalName, {kind} AS ObjectType,
p.permission_name AS PermissionType, p.state_desc AS PermissionState, {schema} AS SchemaName, {name} AS ObjectName, {column} AS ColumnName
FROM {permissions} p
LEFT JOIN fx_database_principals g ON g.database_name = p.database_name AND g.principal_id = p.grantee_principal_id
{joins} WHERE p.class = {cls} AND p.database_name IN ({usable(databases)})"""


def object_gather(
    permissions: str = "fx_database_permissions", compat: bool = False, databases: str = "fx_databases"
) -> str:
    return " UNION ALL ".join(object_class(cls, permissions, compat, databases) for cls in OBJECT_CLASSES)


# groups

ROOTS = "SELECT DISTINCT name FROM fx_logins WHERE isntgroup = 1"


def group_walk(edges: str, suffix: str = "") -> dict[str, str]:
    """Recursive steps: groups below the roots, all memberships, and upward ways with their length."""
    return {
        f"reach{suffix}": f"""{ROOTS} UNION SELECT e.account_name FROM reach{suffix} r
JOIN {edges} e ON e.permission_path = r.name AND e.type = 'group'""",
        f"walk{suffix}": f"""SELECT account_name, permission_path AS ancestor FROM {edges}
UNION SELECT w.account_name, e.permission_path FROM walk{suffix} w
JOIN {edges} e ON e.account_name = w.ancestor AND e.type = 'group'""",
        # a shortest way passes each group once, so it is no longer than there are groups
        f"ways{suffix}": f"""SELECT account_name, permission_path AS ancestor, 1 AS depth FROM {edges}
UNION SELECT w.account_name, e.permission_path, w.depth + 1 FROM ways{suffix} w
JOIN {edges} e ON e.account_name = w.ancestor AND e.type = 'group'
WHERE w.depth <= (SELECT count(DISTINCT permission_path) FROM {edges})""",
    }


def group_members(suffix: str = "") -> str:
    return f"""
SELECT DISTINCT l.sid, w.account_name AS PrincipalName, w.ancestor AS ADGroupName
FROM walk{suffix} w JOIN reach{suffix} r ON r.name = w.ancestor
LEFT JOIN fx_logins l ON l.name = w.account_name WHERE w.account_name <> w.ancestor"""


GROUP_DIRECT = f"""
SELECT DISTINCT CAST(NULL AS VARCHAR) AS sid, account_name AS PrincipalName, permission_path AS ADGroupName
FROM fx_group_edges WHERE permission_path IN ({ROOTS})"""

GROUP_STATUS = """
SELECT DISTINCT account_name AS PrincipalName, permission_path AS ADGroupName, status, isntgroup,
CASE WHEN status = 9 THEN 'Enabled' WHEN status = 10 THEN 'Disabled' ELSE '???' END AS StatusText
FROM fx_group_edges JOIN fx_logins ON name = permission_path WHERE isntgroup = 1"""

GROUP_COMPONENTS = """
SELECT name AS "group", component, count(*) OVER (PARTITION BY component) AS size
FROM (SELECT g.name, least(g.name, coalesce(min(b.account_name), g.name)) AS component
FROM (SELECT account_name AS name FROM fx_ring_edges WHERE type = 'group' UNION SELECT permission_path FROM fx_ring_edges) g
LEFT JOIN walk_ring a ON a.account_name = g.name
LEFT JOIN walk_ring b ON b.account_name = a.ancestor AND b.ancestor = g.name
GROUP BY g.name) t"""

GROUP_COMPAT = f"""{GROUP_DIRECT}
UNION SELECT l.sid, m.account_name, u.permission_path FROM fx_group_edges m
JOIN fx_group_edges u ON u.account_name = m.permission_path AND u.type = 'group'
JOIN reach r ON r.name = u.permission_path
LEFT JOIN fx_logins l ON l.name = u.account_name"""


# state transitions of the instance domain: previous live, and live after each of three steps

def instance_steps(compat: bool) -> dict[str, str]:
    v, k, five = INSTANCE.values, INSTANCE.update_key, PRINCIPALS.values
    match = plain if compat else null_safe
    listed = cols(v)
    steps = {
        "revoked": minus(INSTANCE, "prev_instance", "fx_instance"),
        "dropped": f"SELECT {cols(five)} FROM prev_instance EXCEPT SELECT {cols(five)} FROM fx_instance",
        "after_revoke": f"""SELECT * FROM prev_instance l WHERE l.PermissionType = 'CONNECT SQL'
OR NOT EXISTS (SELECT 1 FROM revoked r WHERE {match(v, 'l', 'r')})""",
        "after_drop": f"""SELECT * FROM after_revoke l
WHERE NOT EXISTS (SELECT 1 FROM dropped r WHERE {match(five, 'l', 'r')})""",
        "delta": minus(INSTANCE, "fx_instance", "after_drop"),
    }
    if compat:
        steps["pick"] = f"""SELECT * FROM (SELECT {listed}, row_number() OVER
(PARTITION BY {cols(k)} ORDER BY {listed}) AS place FROM delta) t WHERE place = 1"""
        steps["updated"] = f"""SELECT {', '.join(f'CASE WHEN r.place = 1 THEN r.{c} ELSE l.{c} END AS {c}' for c in v)},
CASE WHEN r.place = 1 THEN TIMESTAMP '{AS_OF}' ELSE l.PollDate END AS PollDate
FROM after_drop l LEFT JOIN pick r ON {plain(k, 'l', 'r')}"""
        steps["after_upsert"] = f"""SELECT * FROM updated UNION ALL
SELECT {listed}, TIMESTAMP '{AS_OF}' FROM delta l WHERE NOT EXISTS (SELECT 1 FROM updated r WHERE {plain(v, 'l', 'r')})"""
    else:
        steps["stale"] = minus(INSTANCE, "after_drop", "fx_instance")
        steps["replaced"] = f"""SELECT {listed} FROM stale l
WHERE EXISTS (SELECT 1 FROM delta r WHERE {null_safe(k, 'l', 'r')})"""
        steps["after_upsert"] = f"""SELECT {listed}, PollDate FROM after_drop l
WHERE NOT EXISTS (SELECT 1 FROM replaced r WHERE {null_safe(v, 'l', 'r')})
UNION ALL SELECT {listed}, TIMESTAMP '{AS_OF}' FROM delta"""
    return steps


def next_state(domain, before: str, now: str) -> str:
    """Live after removal and insertion, for a domain without sticky rows."""
    return f"""SELECT {cols(domain.values)}, CASE WHEN count(b.hit) > 0 THEN TIMESTAMP '{POLLED}'
ELSE TIMESTAMP '{AS_OF}' END AS PollDate
FROM (SELECT {cols(domain.values, 'n.')}, p.hit FROM {now} n
LEFT JOIN (SELECT DISTINCT *, 1 AS hit FROM {before}) p ON {null_safe(domain.values, 'n', 'p')}) b
GROUP BY {cols(domain.values)}"""


def minus_covered(domain, first: str, second: str, databases: str) -> str:
    return f"SELECT * FROM ({minus(domain, first, second)}) t WHERE Scope NOT IN ({unread(databases)})"


def next_state_covered(domain, before: str, now: str, databases: str) -> str:
    """Live after removal and insertion; rows of databases that could not be read stay."""
    return f"""{next_state(domain, before, now)} UNION ALL
SELECT DISTINCT {cols(domain.values)}, TIMESTAMP '{POLLED}' FROM {before} WHERE Scope IN ({unread(databases)})"""


def after_removal_compat(domain, before: str, now: str, spared: str | None = None) -> str:
    """Live without the rows that the snapshot lacks, as plain equality finds them, but for those in spared databases."""
    match = plain(domain.compat_match, "l", "g")
    if domain.compat_null_safe:
        match += " AND " + null_safe(domain.compat_null_safe, "l", "g")
    return f"""SELECT {cols(domain.values, 'l.')}, TIMESTAMP '{POLLED}' AS PollDate
FROM (SELECT DISTINCT {cols(domain.values)} FROM {before}) l
WHERE NOT EXISTS (SELECT 1 FROM ({minus(domain, before, now)}) g WHERE {match})
{f"OR l.Scope IN ({spared})" if spared else ""}"""


# lookups: live tables and the four parts of an answer

LIVE = {
    "live_instance": "SELECT * FROM prev_instance",
    "live_roles": f"SELECT *, TIMESTAMP '{POLLED}' AS PollDate FROM ({role_members('fx_database_role_members')}) t",
    "live_objects": f"SELECT *, TIMESTAMP '{POLLED}' AS PollDate FROM ({object_gather()}) t",
}


def identities(name: str) -> str:
    return f"(SELECT '{name}' UNION SELECT ADGroupName FROM fx_group_mappings WHERE PrincipalName = '{name}')"


def shown(names) -> str:
    return cols([*names, "PollDate"])


OBJECT_SHOWN = [c for c in OBJECTS.values if c != "sid"]
ROLE_SHOWN = [c for c in ROLES.values if c != "sid"]

LOOKUP_INSTANCE = (
    f"SELECT {shown(INSTANCE.values)} FROM live_instance WHERE PrincipalName IN {identities(LOGIN)}"
)
LOOKUP_ROLES = (
    f"SELECT {shown(ROLE_SHOWN)} FROM live_roles WHERE PrincipalName IN {identities(USER)}"
)
LOOKUP_ROLE_PERMISSIONS = f"""
SELECT {cols([*OBJECT_SHOWN, 'PollDate'], 'o.')} FROM live_objects o
JOIN (SELECT DISTINCT ServerName, Scope, DatabaseRole FROM live_roles WHERE PrincipalName IN {identities(USER)}) r
ON r.ServerName = o.ServerName AND r.Scope = o.Scope AND r.DatabaseRole = o.PrincipalName"""
LOOKUP_ROLE_PERMISSIONS_COMPAT = f"""
SELECT {cols([*OBJECT_SHOWN, 'PollDate'], 'o.')} FROM live_objects o
JOIN live_roles r ON r.Scope = o.Scope AND r.DatabaseRole = o.PrincipalName
WHERE r.PrincipalName IN {identities(USER)}"""
LOOKUP_OBJECTS = f"""
SELECT {shown(OBJECT_SHOWN)} FROM live_objects WHERE PrincipalName IN {identities(USER)}
OR sid = (SELECT sid FROM fx_user_logins WHERE name = '{USER}')"""

LOOKUP_SUMMARY = """
WITH who AS (SELECT name AS Principal, name AS PrincipalName FROM fx_user_logins
UNION SELECT PrincipalName, ADGroupName FROM fx_group_mappings WHERE PrincipalName IN (SELECT name FROM fx_user_logins)),
per_role AS (SELECT DISTINCT w.Principal, r.ServerName, r.Scope, r.DatabaseRole FROM who w JOIN live_roles r ON r.PrincipalName = w.PrincipalName),
counts AS (SELECT ServerName, Scope, PrincipalName, sid, count(*) AS n FROM live_objects GROUP BY ALL)
SELECT w.Principal, 'roles' AS part, CAST(count(*) AS BIGINT) AS n FROM who w JOIN live_roles r ON r.PrincipalName = w.PrincipalName GROUP BY 1
UNION ALL SELECT w.Principal, 'instance', CAST(count(*) AS BIGINT) FROM who w JOIN live_instance r ON r.PrincipalName = w.PrincipalName GROUP BY 1
UNION ALL SELECT p.Principal, 'role_permissions', CAST(sum(o.n) AS BIGINT) FROM per_role p
JOIN counts o ON o.ServerName = p.ServerName AND o.Scope = p.Scope AND o.PrincipalName = p.DatabaseRole GROUP BY 1
UNION ALL SELECT Principal, 'objects', CAST(sum(n) AS BIGINT) FROM (
SELECT w.Principal, o.* FROM who w JOIN counts o ON o.PrincipalName = w.PrincipalName
UNION SELECT l.name, o.* FROM fx_user_logins l JOIN counts o ON o.sid = l.sid) t GROUP BY 1"""

def _who(names, logins: str) -> str:
    return f"""
WITH asked AS (SELECT name FROM {logins} WHERE name IN ({", ".join(f"'{n}'" for n in names)})),
who AS (SELECT name AS Principal, name AS PrincipalName FROM asked
UNION SELECT PrincipalName, ADGroupName FROM fx_group_mappings WHERE PrincipalName IN (SELECT name FROM asked))"""


_WHO = _who(ASKED, "fx_user_logins")
LOOKUP_BATCH = {
    "instance": f"""SELECT * FROM ({_who(ASKED_LOGINS, "fx_logins")} SELECT w.Principal, {cols([*INSTANCE.values, 'PollDate'], 'l.')}
FROM who w JOIN live_instance l ON l.PrincipalName = w.PrincipalName) t""",
    "roles": f"""SELECT * FROM ({_WHO} SELECT w.Principal, {cols([*ROLE_SHOWN, 'PollDate'], 'l.')}
FROM who w JOIN live_roles l ON l.PrincipalName = w.PrincipalName) t""",
    "role_permissions": f"""SELECT * FROM ({_WHO} SELECT r.Principal, {cols([*OBJECT_SHOWN, 'PollDate'], 'o.')}
FROM (SELECT DISTINCT w.Principal, l.ServerName, l.Scope, l.DatabaseRole FROM who w JOIN live_roles l ON l.PrincipalName = w.PrincipalName) r
JOIN live_objects o ON o.ServerName = r.ServerName AND o.Scope = r.Scope AND o.PrincipalName = r.DatabaseRole) t""",
    "objects": f"""SELECT * FROM ({_WHO} SELECT a.name AS Principal, {cols([*OBJECT_SHOWN, 'PollDate'], 'o.')}
FROM asked a JOIN live_objects o ON o.PrincipalName IN (SELECT PrincipalName FROM who w WHERE w.Principal = a.name)
OR o.sid IN (SELECT sid FROM fx_user_logins l WHERE l.name = a.name)) t""",
}
LOOKUP_ANSWER = f"""
SELECT PrincipalName, count(*) AS n, 'instance' AS part FROM live_instance WHERE PrincipalName IN {identities(USER)} GROUP BY 1
UNION ALL SELECT PrincipalName, count(*), 'roles' FROM live_roles WHERE PrincipalName IN {identities(USER)} GROUP BY 1
UNION ALL SELECT PrincipalName, count(*), 'role_permissions' FROM ({LOOKUP_ROLE_PERMISSIONS}) a GROUP BY 1
UNION ALL SELECT PrincipalName, count(*), 'objects' FROM ({LOOKUP_OBJECTS}) b GROUP BY 1"""

# nested roles, all databases at once

ROLE_WALK = {
    "role_walk": """SELECT ServerName, Scope, PrincipalName AS member, DatabaseRole AS role FROM live_roles WHERE PrincipalType = 'DATABASE_ROLE'
UNION SELECT w.ServerName, w.Scope, w.member, r.DatabaseRole FROM role_walk w JOIN live_roles r ON r.ServerName = w.ServerName
AND r.Scope = w.Scope AND r.PrincipalName = w.role AND r.PrincipalType = 'DATABASE_ROLE'""",
}
LOOKUP_NESTED_ROLES = f"""
SELECT Principal, ServerName, Scope, DatabaseRole, bool_or(direct) AS direct FROM ({_WHO},
first AS (SELECT w.Principal, l.ServerName, l.Scope, l.DatabaseRole FROM who w JOIN live_roles l ON l.PrincipalName = w.PrincipalName)
SELECT *, true AS direct FROM first
UNION ALL SELECT f.Principal, f.ServerName, f.Scope, w.role, false FROM first f
JOIN role_walk w ON w.ServerName = f.ServerName AND w.Scope = f.Scope AND w.member = f.DatabaseRole) t GROUP BY 1, 2, 3, 4"""
LOOKUP_NESTED_ROLE_PERMISSIONS = f"""
SELECT r.Principal, {cols([*OBJECT_SHOWN, 'PollDate'], 'o.')} FROM ({LOOKUP_NESTED_ROLES}) r
JOIN live_objects o ON o.ServerName = r.ServerName AND o.Scope = r.Scope AND o.PrincipalName = r.DatabaseRole"""


# lookups at moments of the past

def _span(domain, before: str, now: str) -> str:
    """Rows of two snapshots with the time in which they were held."""
    listed = cols(domain.values)
    return f"""SELECT {listed}, CASE WHEN bool_or(b) THEN TIMESTAMP '{POLLED}' ELSE TIMESTAMP '{AS_OF}' END AS valid_from,
CASE WHEN bool_or(n) THEN NULL ELSE TIMESTAMP '{AS_OF}' END AS valid_to
FROM (SELECT {listed}, true AS b, false AS n FROM ({before}) x UNION ALL SELECT {listed}, false, true FROM ({now}) y) z GROUP BY {listed}"""


def _in_span(ask: str, row: str) -> str:
    return f"{row}.valid_from <= {ask}.Moment AND ({row}.valid_to IS NULL OR {ask}.Moment < {row}.valid_to)"


def past_steps() -> dict[str, str]:
    moments = ", ".join(f"(TIMESTAMP '{at}')" for at in MOMENTS)
    names = ", ".join(f"'{n}'" for n in (*ASKED, *ASKED_LOGINS))
    return instance_steps(False) | {
        "span_instance": _span(INSTANCE, "SELECT * FROM prev_instance", "SELECT * FROM after_upsert"),
        "span_groups": _span(GROUPS, "SELECT * FROM prev_user_groups", "SELECT * FROM fx_user_groups"),
        "span_roles": _span(ROLES, role_members("prev_database_role_members"), role_members("fx_database_role_members")),
        "span_objects": _span(OBJECTS, object_gather("prev_database_permissions"), object_gather()),
        "asked_at": f"""SELECT DISTINCT name, Moment FROM (SELECT name FROM fx_user_logins UNION ALL SELECT name FROM fx_logins) l,
(VALUES {moments}) m(Moment) WHERE name IN ({names})""",
        "who_at": f"""SELECT name AS Principal, Moment, name AS PrincipalName FROM asked_at
UNION SELECT a.name, a.Moment, g.ADGroupName FROM asked_at a JOIN span_groups g ON g.PrincipalName = a.name AND {_in_span('a', 'g')}""",
    }


_SPAN = ["valid_from", "valid_to"]
_OBJECTS_AT = cols([*OBJECT_SHOWN, *_SPAN], "o.")
LOOKUP_AS_OF = {
    "instance": f"""SELECT w.Principal, w.Moment, {cols([*INSTANCE.values, *_SPAN], 'o.')} FROM who_at w
JOIN span_instance o ON o.PrincipalName = w.PrincipalName AND {_in_span('w', 'o')}""",
    "roles": f"""SELECT w.Principal, w.Moment, {cols([*ROLE_SHOWN, *_SPAN], 'o.')} FROM who_at w
JOIN span_roles o ON o.PrincipalName = w.PrincipalName AND {_in_span('w', 'o')}""",
    "role_permissions": f"""SELECT r.Principal, r.Moment, {_OBJECTS_AT} FROM (SELECT DISTINCT w.Principal, w.Moment, l.ServerName, l.Scope, l.DatabaseRole
FROM who_at w JOIN span_roles l ON l.PrincipalName = w.PrincipalName AND {_in_span('w', 'l')}) r
JOIN span_objects o ON o.ServerName = r.ServerName AND o.Scope = r.Scope AND o.PrincipalName = r.DatabaseRole AND {_in_span('r', 'o')}""",
    "objects": f"""SELECT a.name AS Principal, a.Moment, {_OBJECTS_AT} FROM asked_at a JOIN span_objects o ON {_in_span('a', 'o')}
AND (o.PrincipalName IN (SELECT PrincipalName FROM who_at w WHERE w.Principal = a.name AND w.Moment = a.Moment)
OR o.sid IN (SELECT sid FROM fx_user_logins l WHERE l.name = a.name))""",
}


# principals that went and came, paired by sid: first those that kept their name, the others by rank

PRINCIPALS_CHANGED = """
SELECT * FROM (WITH o1 AS (SELECT *, row_number() OVER (PARTITION BY ServerName, Scope, sid, PrincipalName ORDER BY PrincipalType) AS place FROM went),
n1 AS (SELECT *, row_number() OVER (PARTITION BY ServerName, Scope, sid, PrincipalName ORDER BY PrincipalType) AS place FROM came),
kept AS (SELECT o.*, n.PrincipalType AS NewType FROM o1 o JOIN n1 n USING (ServerName, Scope, sid, PrincipalName, place)),
o2 AS (SELECT o.*, row_number() OVER (PARTITION BY ServerName, Scope, sid ORDER BY PrincipalName, PrincipalType) AS rank FROM o1 o
WHERE NOT EXISTS (SELECT 1 FROM kept k WHERE k.ServerName = o.ServerName AND k.sid = o.sid AND k.PrincipalName = o.PrincipalName AND k.place = o.place)),
n2 AS (SELECT n.*, row_number() OVER (PARTITION BY ServerName, Scope, sid ORDER BY PrincipalName, PrincipalType) AS rank FROM n1 n
WHERE NOT EXISTS (SELECT 1 FROM kept k WHERE k.ServerName = n.ServerName AND k.sid = n.sid AND k.PrincipalName = n.PrincipalName AND k.place = n.place))
SELECT ServerName, Scope, sid, PrincipalName AS OldName, PrincipalType AS OldType, PrincipalName AS NewName, NewType, 'retyped' AS change FROM kept
UNION ALL SELECT coalesce(o.ServerName, n.ServerName), coalesce(o.Scope, n.Scope), coalesce(o.sid, n.sid), o.PrincipalName, o.PrincipalType,
n.PrincipalName, n.PrincipalType, CASE WHEN n.rank IS NULL THEN 'dropped' WHEN o.rank IS NULL THEN 'new' ELSE 'renamed' END
FROM o2 o FULL JOIN n2 n ON n.ServerName = o.ServerName AND n.Scope = o.Scope AND n.sid = o.sid AND n.rank = o.rank) t"""

LAST_SUCCESS = f"""
SELECT run_date, run_time, strptime(CAST(run_date AS VARCHAR) || lpad(CAST(run_time AS VARCHAR), 6, '0'), '%Y%m%d%H%M%S') AS last_run
FROM fx_job_history WHERE job_name = '{JOB}' AND step_id = 0 AND run_status = 1
ORDER BY run_date DESC, run_time DESC LIMIT 1"""

JOB_RUNS_NAMED = """SELECT j.name AS job_name, h.step_id, h.run_status, h.run_date, h.run_time
FROM fx_job_runs h JOIN fx_jobs j ON j.job_id = h.job_id"""

JOB_RUN_TIMES = """
SELECT run_date, run_time, strftime(strptime(CAST(run_date AS VARCHAR) || lpad(CAST(run_time AS VARCHAR), 6, '0'), '%Y%m%d%H%M%S'),
'%Y-%m-%d %H:%M:%S') || '.000' AS run_text FROM fx_job_history"""

ALERT_GATE = """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M') AS alert_minute FROM events
WHERE date_part('hour', ts) = 10 AND date_part('minute', ts) < 15"""

DB_ONLINE = f"SELECT database_name, principal_id, name FROM fx_database_principals WHERE database_name IN ({usable('fx_databases')})"
