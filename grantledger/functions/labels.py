"""Code-to-text projections used by the gathers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed server roles, one flag column each.
FIXED_SERVER_ROLES = (
    "sysadmin",
    "securityadmin",
    "serveradmin",
    "setupadmin",
    "processadmin",
    "diskadmin",
    "dbcreator",
    "bulkadmin",
)

# Securable classes of a database permission.
DATABASE = 0
OBJECT_OR_COLUMN = 1
SCHEMA = 3
DATABASE_PRINCIPAL = 4
ASSEMBLY = 5
TYPE = 6
XML_SCHEMA_COLLECTION = 10
CERTIFICATE = 25
SECURABLE_CLASSES = (
    DATABASE, OBJECT_OR_COLUMN, SCHEMA, DATABASE_PRINCIPAL,
    ASSEMBLY, TYPE, XML_SCHEMA_COLLECTION, CERTIFICATE,
)

# Texts standing in for a missing name or code.
NOT_APPLICABLE = "N/A"
UNKNOWN = "Unknown"
UNCODED = "???"


def disabled_flag(is_disabled: Column) -> Column:
    """0/1 flag of a principal as No/Yes."""
    return F.when(is_disabled == 0, "No").when(is_disabled == 1, "Yes").otherwise(UNCODED)


def disabled_from_status(status: Column) -> Column:
    """Login status as a disabled flag; only 9 means enabled."""
    return F.when(status == 9, "No").otherwise("Yes")


def status_text(status: Column) -> Column:
    """Login status in words; another map than `disabled_from_status`."""
    return F.when(status == 9, "Enabled").when(status == 10, "Disabled").otherwise(UNCODED)


def login_type(isntgroup: Column, isntuser: Column, isntname: Column) -> Column:
    """First matching type; NULL when no flag decides."""
    return (
        F.when(isntgroup == 1, "WINDOWS_GROUP")
        .when(isntuser == 1, "WINDOWS_LOGIN")
        .when(isntname == 0, "SQL_LOGIN")
    )
