"""Column layout of the four audited domains and the run log."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

POLL = "PollDate"


@dataclass(frozen=True)
class Domain:
    """One audited table family: staging, live and removal history share `values`.

    `values` identify a row; `PollDate` is never compared.
    `update_key` is the part of a row that survives an in-place change.
    `sticky` names a (column, value) whose rows stay live when only the
    permission row, and not its whole principal, disappears.
    `compat_match` are the columns the compat delete compares with plain
    equality, `compat_null_safe` those it compares null-safely.
    """

    name: str
    live: str
    removed: str
    values: tuple[str, ...]
    update_key: tuple[str, ...] = ()
    sticky: tuple[str, str] | None = None
    compat_match: tuple[str, ...] = ()
    compat_null_safe: tuple[str, ...] = ()


INSTANCE = Domain(
    name="instance",
    live="InstanceLevel",
    removed="RevokedInstancePermissions",
    values=(
        "ServerName", "Scope", "sid", "PrincipalName", "PrincipalType", "IsDisabled",
        "PermissionType", "PermissionState", "ClassDescription", "EndpointName",
    ),
    update_key=(
        "ServerName", "Scope", "sid", "PrincipalType", "PermissionType",
        "ClassDescription", "EndpointName",
    ),
    sticky=("PermissionType", "CONNECT SQL"),
    compat_match=(
        "ServerName", "Scope", "sid", "PrincipalName", "PrincipalType", "IsDisabled",
        "PermissionType", "PermissionState", "ClassDescription", "EndpointName",
    ),
)

# Derived from the instance domain: a principal is a distinct five-column prefix of its rows.
PRINCIPALS = Domain(
    name="principals",
    live="InstanceLevel",
    removed="DroppedPrincipals",
    values=("ServerName", "Scope", "sid", "PrincipalName", "PrincipalType"),
    compat_match=("ServerName", "Scope", "sid", "PrincipalName", "PrincipalType"),
)

GROUPS = Domain(
    name="groups",
    live="PrincipalToADGroupMappings",
    removed="DroppedMembersFromADGroups",
    values=("sid", "PrincipalName", "ADGroupName"),
    compat_match=("PrincipalName", "ADGroupName"),
    compat_null_safe=("sid",),
)

ROLES = Domain(
    name="roles",
    live="PrincipalToDatabaseRoleMappings",
    removed="DroppedMembersFromDatabaseRoles",
    values=("ServerName", "Scope", "sid", "PrincipalName", "PrincipalType", "DatabaseRole"),
    compat_match=("Scope", "sid", "PrincipalName", "PrincipalType", "DatabaseRole"),
)

OBJECTS = Domain(
    name="objects",
    live="DatabaseObjectLevel",
    removed="RevokedDatabasePermissions",
    values=(
        "ServerName", "Scope", "sid", "PrincipalName", "ObjectType", "PermissionType",
        "PermissionState", "SchemaName", "ObjectName", "ColumnName",
    ),
    compat_match=(
        "ServerName", "Scope", "sid", "PrincipalName", "ObjectType", "PermissionType",
        "PermissionState", "SchemaName", "ObjectName", "ColumnName",
    ),
)

DOMAINS = (INSTANCE, GROUPS, ROLES, OBJECTS)


def value_schema(domain: Domain, sid_type: T.DataType | None = None) -> T.StructType:
    """Schema of a staging table: strings, with a nullable binary `sid`."""
    sid = sid_type or T.BinaryType()
    return T.StructType(
        [T.StructField(c, sid if c == "sid" else T.StringType()) for c in domain.values]
    )


def live_schema(domain: Domain, sid_type: T.DataType | None = None) -> T.StructType:
    return value_schema(domain, sid_type).add(POLL, T.TimestampType())


RUN_LOG = T.StructType(
    [
        T.StructField("RecordPermissionsAuditID", T.LongType(), False),
        T.StructField("ParentAuditID", T.LongType(), False),
        T.StructField("USPName", T.StringType(), False),
        T.StructField("ExecStartDT", T.TimestampType(), False),
        T.StructField("ExecStopDT", T.TimestampType()),
        T.StructField("RunBy", T.StringType(), False),
        T.StructField("SuccessIndicator", T.StringType(), False),
    ]
)
