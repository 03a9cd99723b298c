"""Null-safe snapshot comparison and the state transitions built on it.

Both directions of a comparison come from one aggregation: the two snapshots
are stacked, grouped by the whole row, and each group says on which sides it
was seen. Grouping is null-safe, removes duplicates, combines map-side and
needs a single shuffle on the full row, so a principal or a database that owns
a large share of all rows still spreads evenly over the tasks.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantledger.functions.matching import equal, same
from grantledger.functions.times import stamp
from grantledger.operators.coverage import Coverage, inside, outside
from grantledger.schemas import INSTANCE, POLL, PRINCIPALS, Domain

IN_LIVE = "in_live"
IN_STAGING = "in_staging"
FIRST_SEEN = "first_seen"
RECORDED = "last_recorded"


def _is_sticky(domain: Domain) -> Column:
    if domain.sticky is None:
        return F.lit(False)
    column, value = domain.sticky
    return F.col(column).eqNullSafe(F.lit(value))


def _poll(df: DataFrame) -> Column:
    return F.col(POLL) if POLL in df.columns else F.lit(None).cast("timestamp")


def compare(
    live: DataFrame, staging: DataFrame, domain: Domain, history: DataFrame | None = None,
    coverage: Coverage | None = None,
) -> DataFrame:
    """One row per distinct value tuple, flagged with the sides that hold it.

    The time a sticky row was last recorded as removed comes from live, where
    live tables carry it, or else from `history`. Rows outside the `coverage`
    of the snapshot are left out on both sides.
    """
    live, staging = inside(live, coverage), inside(staging, coverage)

    def side(df: DataFrame, in_live: bool, in_staging: bool, seen: Column, recorded: Column):
        return df.select(
            *domain.values,
            F.lit(in_live).alias(IN_LIVE),
            F.lit(in_staging).alias(IN_STAGING),
            seen.alias(FIRST_SEEN),
            recorded.alias(RECORDED),
        )

    never = F.lit(None).cast("timestamp")
    noted = F.col(RECORDED) if RECORDED in live.columns else never
    stacked = side(live, True, False, _poll(live), noted).unionByName(
        side(staging, False, True, never, never)
    )
    if history is not None and domain.sticky is not None:
        known = history.filter(_is_sticky(domain))
        stacked = stacked.unionByName(side(known, False, False, never, _poll(known)))
    return (
        stacked.groupBy(*domain.values)
        .agg(
            F.max(IN_LIVE).alias(IN_LIVE),
            F.max(IN_STAGING).alias(IN_STAGING),
            F.min(FIRST_SEEN).alias(FIRST_SEEN),
            F.max(RECORDED).alias(RECORDED),
        )
    )


def _gone() -> Column:
    return F.col(IN_LIVE) & ~F.col(IN_STAGING)


def _new() -> Column:
    return F.col(IN_STAGING) & ~F.col(IN_LIVE)


def _unrecorded() -> Column:
    """Not yet in the history since the live row was last written."""
    return F.coalesce(F.col(RECORDED) < F.col(FIRST_SEEN), F.lit(True))


def removed(
    live: DataFrame,
    staging: DataFrame,
    domain: Domain,
    as_of: datetime | str,
    history: DataFrame | None = None,
    with_first_seen: bool = False,
    coverage: Coverage | None = None,
) -> DataFrame:
    """Live rows that the snapshot no longer holds, stamped with the time of notice.

    With `history`, a sticky row that stays live is recorded once and not on
    every run. `with_first_seen` keeps the live row's own time as well.
    """
    rows = compare(live, staging, domain, history, coverage).filter(_gone())
    if history is not None and domain.sticky is not None:
        rows = rows.filter(_unrecorded())
    extra = [FIRST_SEEN] if with_first_seen else []
    return rows.select(*domain.values, stamp(as_of).alias(POLL), *extra)


def added(
    live: DataFrame, staging: DataFrame, domain: Domain, as_of: datetime | str, coverage: Coverage | None = None
) -> DataFrame:
    """Snapshot rows that live does not hold yet."""
    rows = compare(live, staging, domain, coverage=coverage).filter(_new())
    return rows.select(*domain.values, stamp(as_of).alias(POLL))


def changes(
    live: DataFrame, staging: DataFrame, domain: Domain, history: DataFrame | None = None,
    coverage: Coverage | None = None,
) -> DataFrame:
    """Both directions at once: value columns, `change`, `first_seen`, `unrecorded`."""
    one_sided = compare(live, staging, domain, history, coverage).filter(_gone() | _new())
    return one_sided.select(
        *domain.values,
        F.when(F.col(IN_LIVE), "removed").otherwise("added").alias("change"),
        FIRST_SEEN,
        _unrecorded().alias("unrecorded"),
    )


def superseded(gone: DataFrame, new: DataFrame, domain: Domain = INSTANCE) -> DataFrame:
    """Removed rows with `change_kind`: superseded by a new row of the same key, or removed."""
    keys = new.select(*domain.update_key).distinct().withColumn("hit", F.lit(True))
    return (
        gone.alias("l")
        .join(keys.alias("r"), same(domain.update_key), "left")
        .select(
            "l.*",
            F.when(F.col("r.hit"), "superseded").otherwise("removed").alias("change_kind"),
        )
    )


def apply_removed(
    live: DataFrame,
    gone: DataFrame,
    domain: Domain,
    compat: bool = False,
    since: datetime | str | None = None,
    coverage: Coverage | None = None,
) -> DataFrame:
    """Live without the removed rows; sticky rows and rows outside the coverage stay.

    Strict mode matches all value columns null-safely. Compat mode compares
    with plain equality, so rows holding a NULL stay live, and takes only
    history rows polled after `since`; without `since` nothing is deleted.
    """
    if compat:
        if since is None:
            return live
        gone = gone.filter(F.col(POLL) > stamp(since))
        condition = equal(domain.compat_match)
        if domain.compat_null_safe:
            condition = same(domain.compat_null_safe) & condition
    else:
        condition = same(domain.values)
    leaving = gone.filter(~_is_sticky(domain))
    stay = inside(live, coverage).alias("l").join(leaving.alias("r"), condition, "left_anti")
    return stay if coverage is None else stay.unionByName(outside(live, coverage))


def apply_added(live: DataFrame, new: DataFrame, domain: Domain) -> DataFrame:
    """Live plus the new rows."""
    columns = [*domain.values, POLL]
    return live.select(*columns).unionByName(new.select(*columns))


def upsert_compat(
    live: DataFrame, staging: DataFrame, as_of: datetime | str, domain: Domain = INSTANCE, new: DataFrame | None = None
) -> DataFrame:
    """Live with every row of a new row's key overwritten, also those still valid, by the smallest new one.

    Keys match with plain equality; the other new rows are inserted. `new` holds
    the rows of the snapshot that live lacks, where they are known.
    """
    delta = added(live, staging, domain, as_of) if new is None else new
    pick = delta.groupBy(*domain.update_key).agg(
        F.min(F.struct(*domain.values, POLL)).alias("pick")
    )
    columns = [*domain.values, POLL]
    updated = (
        live.alias("l")
        .join(pick.alias("r"), equal(domain.update_key), "left")
        .select(
            *[
                F.when(F.col("r.pick").isNotNull(), F.col(f"r.pick.{c}"))
                .otherwise(F.col(f"l.{c}"))
                .alias(c)
                for c in columns
            ]
        )
    )
    rest = delta.alias("l").join(updated.alias("r"), equal(domain.values), "left_anti")
    return updated.unionByName(rest.select(*columns))


def upsert(
    live: DataFrame,
    staging: DataFrame,
    as_of: datetime | str,
    domain: Domain = INSTANCE,
    compat: bool = False,
) -> DataFrame:
    """Live brought up to the snapshot by a comparison of the two.

    Strict mode lets a new row replace every stale row (one the snapshot no
    longer holds) of its key, and inserts the other new rows. All new rows get
    the same time, so the result does not depend on which of several new rows
    is called the update and which the insert.
    """
    if compat:
        return upsert_compat(live, staging, as_of, domain)
    return next_live(live, changes(live, staging, domain), domain, as_of)


def next_live(
    live: DataFrame,
    delta: DataFrame,
    domain: Domain,
    as_of: datetime | str,
    dropped: DataFrame | None = None,
) -> DataFrame:
    """Next live state from a recorded `changes` table instead of the full snapshot.

    Live is read once. The rows leaving it are usually few, so the anti join
    broadcasts them when their measured size allows and shuffles otherwise.
    `dropped` holds the principals whose sticky rows leave too.
    """
    gone = delta.filter(F.col("change") == "removed")
    new = delta.filter(F.col("change") == "added")
    leaving = gone.filter(~_is_sticky(domain)).select(*domain.values)
    if domain.sticky is not None:
        sticky = gone.filter(_is_sticky(domain)).select(*domain.values)
        replaced = sticky.alias("l").join(
            new.select(*domain.update_key).distinct().alias("r"),
            same(domain.update_key),
            "left_semi",
        )
        leaving = leaving.unionByName(replaced)
        if dropped is not None:
            principal = [c for c in domain.values if c in dropped.columns]
            leaving = leaving.unionByName(
                sticky.alias("l").join(dropped.alias("r"), same(principal), "left_semi")
            )
    columns = [*domain.values, POLL]
    if RECORDED in live.columns:
        # what stays although it is gone was recorded by this run at the latest
        recorded = gone.filter(_is_sticky(domain) & F.col("unrecorded")).select(*domain.values)
        marks = leaving.select("*", F.lit(True).alias("leaves")).unionByName(
            recorded.select("*", F.lit(False).alias("leaves"))
        ).groupBy(*domain.values).agg(F.max("leaves").alias("leaves"))
        noted = F.when(F.col("r.leaves").isNotNull(), stamp(as_of)).otherwise(F.col(f"l.{RECORDED}"))
        stay = live.alias("l").join(marks.alias("r"), same(domain.values), "left").filter(
            ~F.coalesce(F.col("r.leaves"), F.lit(False))
        ).select("l.*", noted.alias("__noted")).drop(RECORDED).withColumnRenamed("__noted", RECORDED)
        columns.append(RECORDED)
    else:
        stay = live.alias("l").join(leaving.alias("r"), same(domain.values), "left_anti")
    fresh = new.select(*domain.values, stamp(as_of).alias(POLL))
    if RECORDED in columns:
        fresh = fresh.withColumn(RECORDED, F.lit(None).cast("timestamp"))
    return stay.select(*columns).unionByName(fresh.select(*columns))


def alters_live(delta: DataFrame, domain: Domain) -> DataFrame:
    """The part of a `changes` table because of which live may differ from before.

    A sticky row recorded earlier leaves live only along with another change.
    """
    return delta.filter(
        (F.col("change") == "added") | ~_is_sticky(domain) | F.col("unrecorded")
    )


def dropped_principals(
    delta: DataFrame, staging: DataFrame, as_of: datetime | str
) -> DataFrame:
    """Principals of live without any row in the snapshot, found from recorded changes.

    Such a principal lost all its rows, so it is among the removed ones; the
    snapshot is only asked which of those few principals it still holds.
    """
    columns = PRINCIPALS.values
    candidates = delta.filter(F.col("change") == "removed").select(*columns).distinct()
    # distinct first: a principal with many rows combines map-side before the join
    present = (
        staging.select(*columns)
        .distinct()
        .alias("l")
        .join(candidates.alias("r"), same(columns), "left_semi")
    )
    return (
        candidates.alias("l")
        .join(present.alias("r"), same(columns), "left_anti")
        .select(*columns, stamp(as_of).alias(POLL))
    )
