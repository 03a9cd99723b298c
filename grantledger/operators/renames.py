"""Principals that went and came between two snapshots, paired by their sid.

A login that was renamed keeps its sid; the comparison of whole rows shows it
as one principal dropped and another one new.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grantledger.functions.matching import same
from grantledger.operators.coverage import Coverage
from grantledger.operators.diff import changes
from grantledger.schemas import PRINCIPALS
from grantledger.session import settle

#: What stays with a renamed principal.
IDENTITY = ("ServerName", "Scope", "sid")
NAMED = ("PrincipalName", "PrincipalType")


def _paired(gone: DataFrame, new: DataFrame, keys: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    """Both sides by rank within their key; a full outer join, `o` and `n` are structs of the two rows."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))

    def ranked(rows: DataFrame, side: str) -> DataFrame:
        return rows.select(*keys, F.struct(*PRINCIPALS.values).alias(side), place.alias("place"))

    left, right = ranked(gone, "o").alias("l"), ranked(new, "n").alias("r")
    return left.join(right, same([*keys, "place"]), "full").select("o", "n")


def _one_side(pairs: DataFrame, side: str) -> DataFrame:
    other = "n" if side == "o" else "o"
    return pairs.filter(F.col(other).isNull()).select(f"{side}.*")


def principal_changes(live: DataFrame, staging: DataFrame, coverage: Coverage | None = None) -> DataFrame:
    """ServerName, Scope, sid, old and new name and type, and `change`: renamed, retyped, dropped or new.

    A dropped and a new principal of one server that share a sid are one. Of
    several, those that kept their name are paired first (`retyped`), the others
    by their rank among the names of the sid, so reruns agree; what is left over
    is dropped or new. Principals without a sid are never paired. A sid has a
    few names, so its ranks are small.
    """
    delta = settle(changes(live, staging, PRINCIPALS, coverage=coverage), "principals")

    def side(change: str, with_sid: bool) -> DataFrame:
        known = F.col("sid").isNotNull()
        return delta.filter((F.col("change") == change) & (known if with_sid else ~known)).select(*PRINCIPALS.values)

    kept = settle(
        _paired(side("removed", True), side("added", True), (*IDENTITY, "PrincipalName"), ("PrincipalType",)), "pairs"
    )
    rest = _paired(_one_side(kept, "o"), _one_side(kept, "n"), IDENTITY, NAMED)
    none = F.lit(None)

    def shown(pairs: DataFrame, both: str) -> DataFrame:
        def either(column: str) -> Column:
            return F.coalesce(f"o.{column}", f"n.{column}").alias(column)

        change = F.when(F.col("n").isNull(), "dropped").when(F.col("o").isNull(), "new").otherwise(both)
        return pairs.select(
            *[either(c) for c in IDENTITY],
            F.col("o.PrincipalName").alias("OldName"), F.col("o.PrincipalType").alias("OldType"),
            F.col("n.PrincipalName").alias("NewName"), F.col("n.PrincipalType").alias("NewType"),
            change.alias("change"),
        )

    row = F.struct(*PRINCIPALS.values)
    form = delta.select(row.alias("row")).schema["row"].dataType
    unpaired = side("removed", False).select(row.alias("o"), none.cast(form).alias("n")).unionByName(
        side("added", False).select(none.cast(form).alias("o"), row.alias("n"))
    )
    both = kept.filter(F.col("o").isNotNull() & F.col("n").isNotNull())
    return shown(both, "retyped").unionByName(shown(rest, "renamed")).unionByName(shown(unpaired, "renamed"))
