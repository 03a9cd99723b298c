"""Instance-level permissions: explicit grants and fixed server role members."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantledger.functions.labels import (
    FIXED_SERVER_ROLES, NOT_APPLICABLE, disabled_flag, disabled_from_status, login_type,
)
from grantledger.operators.keys import ANY_SERVER, lookup_id, with_server
from grantledger.schemas import INSTANCE

SCOPE = "Instance-Level"


def grants(
    principals: DataFrame,
    permissions: DataFrame,
    endpoints: DataFrame,
    server_name: str | None = None,
    compat: bool = False,
) -> DataFrame:
    """Explicit server permissions with their grantee and the securable's name.

    Strict mode resolves `major_id` within the permission's own class. Compat
    mode looks the bare id up among endpoints, then among principals.
    """
    principals = with_server(principals, server_name)
    permissions = with_server(permissions, server_name)
    endpoints = with_server(endpoints, server_name)
    named = permissions.join(
        principals.withColumnRenamed("principal_id", "grantee_principal_id"),
        [ANY_SERVER, "grantee_principal_id"],
        "inner",
    )
    endpoint_names = endpoints.select(
        ANY_SERVER, F.col("endpoint_id").cast("bigint").alias("target_id"),
        F.col("name").alias("endpoint_name"),
    )
    principal_names = principals.select(
        ANY_SERVER, F.col("principal_id").cast("bigint").alias("target_id"),
        F.col("name").alias("target_name"),
    )
    if compat:
        named = named.withColumn("target_id", F.col("major_id").cast("bigint"))
        resolved = named.join(endpoint_names, [ANY_SERVER, "target_id"], "left").join(
            principal_names, [ANY_SERVER, "target_id"], "left"
        )
        target = F.coalesce("endpoint_name", "target_name", F.lit(NOT_APPLICABLE))
    else:
        # one lookup for both kinds of securable; other classes have nothing to look up
        targets = (
            endpoint_names.withColumnRenamed("endpoint_name", "target_name")
            .withColumn("class_desc", F.lit("ENDPOINT"))
            .unionByName(principal_names.withColumn("class_desc", F.lit("SERVER_PRINCIPAL")))
        )
        resolvable = F.col("class_desc").isin("ENDPOINT", "SERVER_PRINCIPAL")
        resolved = named.withColumn(
            "target_id",
            lookup_id(resolvable, F.col("major_id"), "grantee_principal_id", "permission_name"),
        ).join(targets, [ANY_SERVER, "class_desc", "target_id"], "left")
        target = F.coalesce("target_name", F.lit(NOT_APPLICABLE))
    return resolved.select(
        F.col(ANY_SERVER).alias("ServerName"),
        F.lit(SCOPE).alias("Scope"),
        "sid",
        F.col("name").alias("PrincipalName"),
        F.col("type_desc").alias("PrincipalType"),
        disabled_flag(F.col("is_disabled")).alias("IsDisabled"),
        F.col("permission_name").alias("PermissionType"),
        F.col("state_desc").alias("PermissionState"),
        F.col("class_desc").alias("ClassDescription"),
        target.alias("EndpointName"),
    )


def fixed_role_members(logins: DataFrame, server_name: str | None = None) -> DataFrame:
    """One row per login and fixed server role it holds, from one scan of the logins."""
    holds_any: Column = reduce(or_, [F.col(role) == 1 for role in FIXED_SERVER_ROLES])
    held = (
        with_server(logins, server_name)
        .filter(holds_any)
        .unpivot(
            [ANY_SERVER, "sid", "name", "isntgroup", "isntuser", "isntname", "status"],
            list(FIXED_SERVER_ROLES),
            "role",
            "held",
        )
        .filter(F.col("held") == 1)
    )
    return held.select(
        F.col(ANY_SERVER).alias("ServerName"),
        F.lit(SCOPE).alias("Scope"),
        "sid",
        F.col("name").alias("PrincipalName"),
        login_type(F.col("isntgroup"), F.col("isntuser"), F.col("isntname")).alias("PrincipalType"),
        disabled_from_status(F.col("status")).alias("IsDisabled"),
        F.lit("Database Role").alias("PermissionType"),
        F.lit("GRANT").alias("PermissionState"),
        F.lit("SERVER").alias("ClassDescription"),
        F.col("role").alias("EndpointName"),
    )


def gather(
    principals: DataFrame,
    permissions: DataFrame,
    endpoints: DataFrame,
    logins: DataFrame,
    server_name: str | None = None,
    compat: bool = False,
) -> DataFrame:
    """Staging rows of the instance domain."""
    explicit = grants(principals, permissions, endpoints, server_name, compat)
    return explicit.unionByName(fixed_role_members(logins, server_name)).select(*INSTANCE.values)
