"""Per-database gathers: role memberships and object permissions.

All databases are read together; `database_name` is part of every key, so no
loop over databases is needed.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantledger.functions import labels as L
from grantledger.operators.keys import ANY_SERVER, lookup_id, with_server
from grantledger.schemas import OBJECTS, ROLES

IN_DATABASE = [ANY_SERVER, "database_name"]


def usable(databases: DataFrame) -> DataFrame:
    """Databases that are online and open to more than one user."""
    return databases.filter(
        (F.col("state_desc") == "ONLINE") & (F.col("user_access_desc") == "MULTI_USER")
    )


def in_usable(rows: DataFrame, databases: DataFrame, server_name: str | None) -> DataFrame:
    """Rows of usable databases only."""
    names = with_server(usable(databases), server_name).select(
        ANY_SERVER, F.col("name").alias("database_name")
    )
    return with_server(rows, server_name).join(names, IN_DATABASE, "left_semi")


def role_members(
    principals: DataFrame,
    members: DataFrame,
    databases: DataFrame,
    server_name: str | None = None,
) -> DataFrame:
    """Staging rows of the role domain: who is a direct member of which role."""
    principals = with_server(principals, server_name)
    pairs = in_usable(members, databases, server_name)
    member = principals.select(
        *IN_DATABASE, F.col("principal_id").alias("member_principal_id"),
        "sid", F.col("name").alias("PrincipalName"), F.col("type_desc").alias("PrincipalType"),
    )
    role = principals.select(
        *IN_DATABASE, F.col("principal_id").alias("role_principal_id"),
        F.col("name").alias("DatabaseRole"),
    )
    resolved = pairs.join(member, [*IN_DATABASE, "member_principal_id"], "inner").join(
        role, [*IN_DATABASE, "role_principal_id"], "inner"
    )
    return resolved.withColumnsRenamed(
        {ANY_SERVER: "ServerName", "database_name": "Scope"}
    ).select(*ROLES.values)


def _securable_names(
    principals: DataFrame, objects: DataFrame, schemas: DataFrame, securables: DataFrame, compat: bool
) -> DataFrame:
    """Names of what a permission can point to, keyed by class and id.

    Objects meet their schemas here, on the names' side, so the permissions
    themselves are joined once. A stack of the name tables, so Catalyst knows
    its size and broadcasts it only where that is small.
    """
    nothing = F.lit(None).cast("string")

    def entry(df, cls, key, name=F.col("name"), kind=nothing, schema_name=nothing):
        return df.select(
            *IN_DATABASE,
            F.lit(cls).alias("class"),
            F.col(key).cast("bigint").alias("target_id"),
            name.alias("target_name"),
            kind.alias("target_kind"),
            schema_name.alias("schema_name"),
        )

    homes = schemas.select(*IN_DATABASE, "schema_id", F.col("name").alias("home"))
    parts = [
        entry(
            objects.join(homes, [*IN_DATABASE, "schema_id"], "left"), L.OBJECT_OR_COLUMN, "object_id",
            kind=F.col("type_desc"), schema_name=F.col("home"),
        ),
        entry(schemas, L.SCHEMA, "schema_id", name=nothing, schema_name=F.col("name")),
        entry(principals, L.DATABASE_PRINCIPAL, "principal_id"),
    ]
    kinds = {"ASSEMBLY": L.ASSEMBLY, "TYPE": L.TYPE, "CERTIFICATE": L.CERTIFICATE}
    if compat:
        parts.append(entry(objects, L.XML_SCHEMA_COLLECTION, "object_id"))
    else:
        kinds["XML_SCHEMA_COLLECTION"] = L.XML_SCHEMA_COLLECTION
    for kind, cls in kinds.items():
        parts.append(entry(securables.filter(F.col("kind") == kind), cls, "id"))
    return reduce(DataFrame.unionByName, parts)


def object_permissions(
    permissions: DataFrame,
    principals: DataFrame,
    objects: DataFrame,
    schemas: DataFrame,
    columns: DataFrame,
    securables: DataFrame,
    databases: DataFrame,
    server_name: str | None = None,
    classes: Iterable[int] = L.SECURABLE_CLASSES,
    compat: bool = False,
) -> DataFrame:
    """Staging rows of the object domain, for all securable classes in one scan.

    An XML schema collection has an id space of its own and is looked up among
    the collections; compat mode looks its id up among the objects.

    The eight classes differ only in where the securable's name comes from.
    The name tables are stacked into one keyed by class and id, so the
    permissions are read and joined once instead of once per class.
    """
    classes = list(classes)
    facts = in_usable(permissions, databases, server_name).filter(F.col("class").isin(classes))
    principals = with_server(principals, server_name)
    grantees = principals.select(
        *IN_DATABASE, F.col("principal_id").alias("grantee_principal_id"),
        "sid", F.col("name").alias("PrincipalName"),
    )
    names = _securable_names(
        principals,
        with_server(objects, server_name),
        with_server(schemas, server_name),
        with_server(securables, server_name),
        compat,
    ).filter(F.col("class").isin(classes))
    column_names = with_server(columns, server_name).select(
        *IN_DATABASE,
        F.col("object_id").cast("bigint").alias("target_id"),
        F.col("column_id").cast("bigint").alias("column_id"),
        F.col("name").alias("column_name"),
    )
    spread_by = ("grantee_principal_id", "major_id", "permission_name")
    # a database is not among the names, and column ids are positive: a spread id
    # finds nothing
    has_name = F.col("class") != L.DATABASE
    on_column = (F.col("class") == L.OBJECT_OR_COLUMN) & (F.col("minor_id") > 0)
    facts = facts.withColumns(
        {
            "class": F.col("class").cast("int"),
            "target_id": lookup_id(has_name, F.col("major_id"), *spread_by),
            "column_id": lookup_id(on_column, F.col("minor_id"), *spread_by),
        }
    )
    resolved = facts.join(grantees, [*IN_DATABASE, "grantee_principal_id"], "left").join(
        names, [*IN_DATABASE, "class", "target_id"], "left"
    )
    if L.OBJECT_OR_COLUMN in classes:
        resolved = resolved.join(column_names, [*IN_DATABASE, "target_id", "column_id"], "left")
    else:
        resolved = resolved.withColumn("column_name", F.lit(None).cast("string"))

    cls = F.col("class")
    absent = F.lit(L.NOT_APPLICABLE)
    unknown = F.lit(L.UNKNOWN)
    return resolved.select(
        F.col(ANY_SERVER).alias("ServerName"),
        F.col("database_name").alias("Scope"),
        "sid",
        "PrincipalName",
        F.coalesce("target_kind", "class_desc").alias("ObjectType"),
        F.col("permission_name").alias("PermissionType"),
        F.col("state_desc").alias("PermissionState"),
        F.when(cls == L.OBJECT_OR_COLUMN, F.coalesce("schema_name", unknown))
        .when(cls == L.SCHEMA, F.col("schema_name"))
        .otherwise(absent)
        .alias("SchemaName"),
        F.when(cls.isin(L.DATABASE, L.SCHEMA), absent)
        .when(cls == L.OBJECT_OR_COLUMN, F.coalesce("target_name", absent))
        .when(cls.isin(L.XML_SCHEMA_COLLECTION, L.CERTIFICATE), F.coalesce("target_name", unknown))
        .otherwise(F.col("target_name"))
        .alias("ObjectName"),
        F.coalesce("column_name", absent).alias("ColumnName"),
    ).select(*OBJECTS.values)
