"""Readers for the security-catalog extracts."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession

from grantledger.functions.labels import FIXED_SERVER_ROLES

# Columns each extract must have. `server_name` may be added to any of them
# when one extract covers several servers.
COLUMNS = {
    "server_principals": ("principal_id", "sid", "name", "type_desc", "is_disabled"),
    "server_permissions": (
        "grantee_principal_id", "major_id", "class_desc", "permission_name", "state_desc",
    ),
    "endpoints": ("endpoint_id", "name"),
    "logins": (
        "sid", "name", "isntgroup", "isntuser", "isntname", "status", *FIXED_SERVER_ROLES,
    ),
    "group_edges": ("account_name", "type", "permission_path"),
    "databases": ("name", "state_desc", "user_access_desc"),
    "database_principals": ("database_name", "principal_id", "sid", "name", "type_desc"),
    "database_role_members": ("database_name", "member_principal_id", "role_principal_id"),
    "database_permissions": (
        "database_name", "class", "class_desc", "major_id", "minor_id",
        "grantee_principal_id", "permission_name", "state_desc",
    ),
    "all_objects": ("database_name", "object_id", "schema_id", "name", "type_desc"),
    "schemas": ("database_name", "schema_id", "name"),
    "all_columns": ("database_name", "object_id", "column_id", "name"),
    "securables": ("database_name", "kind", "id", "name"),
}


def checked(df: DataFrame, name: str) -> DataFrame:
    """Only the columns the gathers use; a missing one is named."""
    missing = [c for c in COLUMNS[name] if c not in df.columns]
    if missing:
        raise ValueError(f"{name} lacks {', '.join(missing)}")
    extra = [c for c in ("server_name",) if c in df.columns]
    return df.select(*COLUMNS[name], *extra)


@dataclass(frozen=True)
class Catalogs:
    """One snapshot of the security catalogs; per-database ones carry `database_name`."""

    server_principals: DataFrame
    server_permissions: DataFrame
    endpoints: DataFrame
    logins: DataFrame
    group_edges: DataFrame
    databases: DataFrame
    database_principals: DataFrame
    database_role_members: DataFrame
    database_permissions: DataFrame
    all_objects: DataFrame
    schemas: DataFrame
    all_columns: DataFrame
    securables: DataFrame

    def __post_init__(self) -> None:
        for field in fields(self):
            object.__setattr__(self, field.name, checked(getattr(self, field.name), field.name))

    @classmethod
    def from_files(cls, spark: SparkSession, root: str, fmt: str = "parquet") -> Catalogs:
        """One folder or file set per extract, `<root>/<extract>`."""
        return cls(
            **{f.name: spark.read.format(fmt).load(f"{root}/{f.name}") for f in fields(cls)}
        )

    @classmethod
    def from_jdbc(
        cls,
        spark: SparkSession,
        url: str,
        tables: dict[str, str],
        partitioned: dict[str, dict[str, str]] | None = None,
        **options: str,
    ) -> Catalogs:
        """Extracts read through JDBC; needs a driver on the class path.

        `tables` names the view or subquery behind each extract. `partitioned`
        may give an extract partitionColumn, lowerBound, upperBound and
        numPartitions, so that large extracts are read by many tasks.
        """
        partitioned = partitioned or {}

        def read(name: str) -> DataFrame:
            reader = spark.read.format("jdbc").options(url=url, dbtable=tables[name], **options)
            return reader.options(**partitioned.get(name, {})).load()

        return cls(**{f.name: read(f.name) for f in fields(cls)})
