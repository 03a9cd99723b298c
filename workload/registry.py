"""The registered queries: Spark operators over the derived views, and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantledger.functions.labels import FIXED_SERVER_ROLES, SECURABLE_CLASSES
from grantledger.functions.times import in_alert_window, run_timestamp, stamp, stamp_text
from grantledger.operators import (
    asof, coverage, databases, diff, digests, groups, instance, lookup, nested_roles, renames,
)
from grantledger.schemas import DOMAINS, GROUPS, INSTANCE, OBJECTS, POLL, PRINCIPALS, ROLES, Domain
from grantledger.session import settle
from grantledger.sources import runs
from workload import audit_runs
from workload import oracles as O
from workload.views import BASE_TABLES, VIEWS, needed, with_views

Query = Callable[[SparkSession, str], DataFrame]


class Views:
    """Given tables and derived views of one scale by attribute; nothing stays registered."""

    def __init__(
        self, spark: SparkSession, sf_dir: str, views: dict[str, str] | None = None
    ) -> None:
        self._spark, self.sf_dir = spark, sf_dir
        self._views = VIEWS if views is None else views
        self._made: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._make(name)
        return self._made[name]

    def _make(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            reader = self._spark.read.schema(BASE_TABLES[name])
            return reader.parquet(f"{self.sf_dir}/{name}.parquet")
        steps = {t: f"SELECT * FROM {{{t}}}" for t in BASE_TABLES} | self._views
        query = f"SELECT * FROM {name}"
        names = needed(query, steps)
        tables = {t: getattr(self, t) for t in BASE_TABLES if t in names}
        listed = ", ".join(f"{n} AS ({steps[n]})" for n in names)
        return self._spark.sql(f"WITH {listed} {query}", **tables)


def _plain_time(df: DataFrame) -> DataFrame:
    """Poll time without time zone, as the SQL side returns it."""
    return df.withColumn(POLL, F.col(POLL).cast("timestamp_ntz"))


def _polled(df: DataFrame) -> DataFrame:
    return df.withColumn(POLL, stamp(O.POLLED))


# gathers

def grants(v: Views, compat: bool = False) -> DataFrame:
    return instance.grants(
        v.fx_server_principals, v.fx_server_permissions, v.fx_endpoints, O.SERVER, compat
    )


def instance_gather(v: Views) -> DataFrame:
    return instance.gather(
        v.fx_server_principals, v.fx_server_permissions, v.fx_endpoints, v.fx_logins, O.SERVER
    )


def roles_gather(
    v: Views, members: str = "fx_database_role_members", listed: str = "fx_databases"
) -> DataFrame:
    return databases.role_members(
        v.fx_database_principals, getattr(v, members), getattr(v, listed), O.SERVER
    )


def objects_gather(
    v: Views, permissions: str = "fx_database_permissions", classes=SECURABLE_CLASSES, compat=False,
    listed: str = "fx_databases",
) -> DataFrame:
    return databases.object_permissions(
        getattr(v, permissions), v.fx_database_principals, v.fx_all_objects, v.fx_schemas,
        v.fx_all_columns, v.fx_securables, getattr(v, listed), O.SERVER, classes, compat,
    )


def groups_gather(v: Views, edges: str = "fx_group_edges", compat: bool = False) -> DataFrame:
    return groups.gather(getattr(v, edges), v.fx_logins, compat)


# comparisons: (previous, current) per domain

def snapshots(v: Views, domain: Domain) -> tuple[DataFrame, DataFrame]:
    if domain in (INSTANCE, PRINCIPALS):
        return v.prev_instance, v.fx_instance
    if domain is GROUPS:
        return groups_gather(v, "prev_group_edges"), groups_gather(v)
    if domain is ROLES:
        return roles_gather(v, "prev_database_role_members"), roles_gather(v)
    return objects_gather(v, "prev_database_permissions"), objects_gather(v)


def gone(v: Views, domain: Domain) -> DataFrame:
    return diff.removed(*snapshots(v, domain), domain, O.AS_OF).select(*domain.values)


def new(v: Views, domain: Domain) -> DataFrame:
    return diff.added(*snapshots(v, domain), domain, O.AS_OF).select(*domain.values)


def next_state(v: Views, domain: Domain) -> DataFrame:
    """The way a run does it: live changed by the recorded differences."""
    before, now = snapshots(v, domain)
    live = settle(_polled(before.distinct()), "live")
    delta = settle(diff.changes(live, now, domain), "changes")
    return _plain_time(diff.next_live(live, delta, domain, O.AS_OF))


def after_removal_compat(v: Views, domain: Domain) -> DataFrame:
    """Live after the recorded removals of a run that compares with plain equality."""
    before, now = snapshots(v, domain)
    live = settle(_polled(before.distinct()), "live")
    gone = settle(diff.removed(live, now, domain, O.AS_OF), "gone")
    return _plain_time(diff.apply_removed(live, gone, domain, True, O.POLLED))


# comparisons within what the later snapshot could read

def covered_snapshots(v: Views, domain: Domain) -> tuple[DataFrame, DataFrame, coverage.Coverage]:
    gather, before = (
        (roles_gather, "prev_database_role_members") if domain is ROLES
        else (objects_gather, "prev_database_permissions")
    )
    return (
        gather(v, before, listed="prev_databases"),
        gather(v, listed="later_databases"),
        coverage.of_databases(v.later_databases, O.SERVER),
    )


def gone_covered(v: Views, domain: Domain) -> DataFrame:
    before, now, read = covered_snapshots(v, domain)
    return diff.removed(before, now, domain, O.AS_OF, coverage=read).select(*domain.values)


def next_state_covered(v: Views, domain: Domain) -> DataFrame:
    before, now, read = covered_snapshots(v, domain)
    live = settle(_polled(before.distinct()), "live")
    delta = settle(diff.changes(live, now, domain, coverage=read), "changes")
    return _plain_time(diff.next_live(live, delta, domain, O.AS_OF))


def after_removal_covered_compat(v: Views, domain: Domain) -> DataFrame:
    before, now, read = covered_snapshots(v, domain)
    live = settle(_polled(before.distinct()), "live")
    gone = settle(diff.removed(live, now, domain, O.AS_OF, coverage=read), "gone")
    return _plain_time(diff.apply_removed(live, gone, domain, True, O.POLLED, read))


# comparisons of stored snapshots, narrowed by digests

def unlike(v: Views, domain: Domain) -> tuple[DataFrame, DataFrame]:
    before, now = (settle(rows, "snapshot") for rows in snapshots(v, domain))
    return digests.differing(before, now, domain)


# instance transitions

def after_revoke(v: Views, compat: bool = False) -> DataFrame:
    live, staging = snapshots(v, INSTANCE)
    revoked = diff.removed(live, staging, INSTANCE, O.AS_OF)
    return diff.apply_removed(live, revoked, INSTANCE, compat, O.POLLED)


def after_drop(v: Views, compat: bool = False) -> DataFrame:
    live, staging = snapshots(v, INSTANCE)
    dropped = diff.removed(live, staging, PRINCIPALS, O.AS_OF)
    return diff.apply_removed(after_revoke(v, compat), dropped, PRINCIPALS, compat, O.POLLED)


def after_upsert(v: Views) -> DataFrame:
    """The way a run does it: from recorded changes, without a second comparison."""
    live, staging = snapshots(v, INSTANCE)
    delta = settle(diff.changes(live, staging, INSTANCE), "changes")
    dropped = diff.dropped_principals(delta, staging, O.AS_OF).select(*PRINCIPALS.values)
    return diff.next_live(live, delta, INSTANCE, O.AS_OF, dropped)


def after_upsert_compat(v: Views) -> DataFrame:
    return diff.upsert(
        settle(after_drop(v, compat=True), "live"), v.fx_instance, O.AS_OF, compat=True
    )


# lookups

class LiveViews:
    """The live tables, each built when a lookup first asks for it."""

    def __init__(self, v: Views) -> None:
        self._v = v

    @cached_property
    def instance(self) -> DataFrame:
        return self._v.prev_instance

    @cached_property
    def groups(self) -> DataFrame:
        return self._v.fx_group_mappings

    @cached_property
    def roles(self) -> DataFrame:
        return _polled(roles_gather(self._v))

    @cached_property
    def objects(self) -> DataFrame:
        return _polled(objects_gather(self._v))


def identities(v: Views, principal: str) -> DataFrame:
    return settle(lookup.identities(principal, v.fx_group_mappings), "identities")


def role_permissions(v: Views, compat: bool = False) -> DataFrame:
    return lookup.role_permissions_part(identities(v, O.USER), LiveViews(v), compat)


def lookup_objects(v: Views) -> DataFrame:
    return lookup.objects_part(O.USER, identities(v, O.USER), LiveViews(v), v.fx_user_logins)


def batch(v: Views, names=O.ASKED, logins: str = "fx_user_logins") -> lookup.BatchPermissions:
    """Answers for a given list of principals."""
    known = getattr(v, logins)
    asked = known.filter(F.col("name").isin(*names)).select("name")
    return lookup.permissions_of(asked, LiveViews(v), known)


def nested(v: Views, of: Callable) -> DataFrame:
    asked = v.fx_user_logins.filter(F.col("name").isin(*O.ASKED)).select("name")
    return of(asked, LiveViews(v))


# lookups at moments of the past

class PastViews:
    """When the rows of two snapshots were held, from live tables and histories after both; each domain when it is asked for."""

    def __init__(self, v: Views) -> None:
        self._v = v

    def _span(self, domain: Domain) -> DataFrame:
        v = self._v
        before, now = (v.prev_user_groups, v.fx_user_groups) if domain is GROUPS else snapshots(v, domain)
        before = before if POLL in before.columns else _polled(before)
        live = settle(before.select(*domain.values, POLL).distinct(), "live")
        delta = settle(diff.changes(live, now, domain), "changes")
        dropped = None
        if domain is INSTANCE:
            dropped = diff.dropped_principals(delta, now, O.AS_OF).select(*PRINCIPALS.values)
        history = delta.filter((F.col("change") == "removed") & F.col("unrecorded"))
        # not settled: a lookup asks for few principals, and its filter goes below the grouping
        return asof.validity(
            diff.next_live(live, delta, domain, O.AS_OF, dropped),
            history.select(*domain.values, stamp(O.AS_OF).alias(POLL), diff.FIRST_SEEN),
            domain,
        )

    @cached_property
    def instance(self) -> DataFrame:
        return self._span(INSTANCE)

    @cached_property
    def groups(self) -> DataFrame:
        return self._span(GROUPS)

    @cached_property
    def roles(self) -> DataFrame:
        return self._span(ROLES)

    @cached_property
    def objects(self) -> DataFrame:
        return self._span(OBJECTS)


def lookup_as_of(v: Views, part: str) -> DataFrame:
    known = v.fx_user_logins.select("name").unionByName(v.fx_logins.select("name"))
    moments = F.explode(F.array(*[stamp(at) for at in O.MOMENTS])).alias(asof.AT)
    asked = known.filter(F.col("name").isin(*O.ASKED, *O.ASKED_LOGINS)).select("name", moments)
    tables = PastViews(v)
    who = asof.identities_at(asked, tables)
    more = [v.fx_user_logins] if part == "objects" else []
    rows = getattr(asof, f"{part}_at")(who, tables, *more)
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in (asof.AT, *asof.SPAN)})


def answer(v: Views) -> DataFrame:
    """A whole answer for one principal: the rows of its four parts."""
    parts = lookup.permissions(O.USER, LiveViews(v), v.fx_user_logins)
    counts = [
        part.groupBy("PrincipalName").agg(F.count(F.lit(1)).alias("n")).withColumn("part", F.lit(name))
        for name, part in zip(parts._fields, parts, strict=True)
    ]
    return reduce(DataFrame.unionByName, counts)


def job_run_times(v: Views) -> DataFrame:
    ran = run_timestamp(F.col("run_date"), F.col("run_time"))
    return v.fx_job_history.select("run_date", "run_time", stamp_text(ran).alias("run_text"))


def last_success(v: Views) -> DataFrame:
    return runs.last_success(v.fx_job_history, O.JOB).withColumn(
        "last_run", F.col("last_run").cast("timestamp_ntz")
    )


def last_success_of_job(v: Views) -> DataFrame:
    history = runs.with_job_names(v.fx_job_runs, v.fx_jobs)
    return runs.last_success(history, O.JOB).withColumn("last_run", F.col("last_run").cast("timestamp_ntz"))


def job_runs_named(v: Views) -> DataFrame:
    history = runs.with_job_names(v.fx_job_runs, v.fx_jobs)
    return history.select("job_name", "step_id", "run_status", "run_date", "run_time")


def alert_gate(v: Views) -> DataFrame:
    return v.events.filter(in_alert_window(F.col("ts"))).select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm").alias("alert_minute")
    )


def db_online(v: Views) -> DataFrame:
    return databases.in_usable(v.fx_database_principals, v.fx_databases, O.SERVER).select(
        "database_name", "principal_id", "name"
    )


def group_closure(v: Views) -> DataFrame:
    return groups.closure(v.fx_group_edges)


QUERIES: dict[str, Callable[[Views], DataFrame]] = {
    "inst_explicit_grants": grants,
    "inst_explicit_grants_compat": lambda v: grants(v, compat=True),
    "inst_fixed_roles": lambda v: instance.fixed_role_members(v.fx_logins, O.SERVER),
    "inst_gather": instance_gather,
    "db_online": db_online,
    "db_role_members": roles_gather,
    **{
        f"obj_class_{cls}": lambda v, cls=cls: objects_gather(v, classes=[cls])
        for cls in SECURABLE_CLASSES
    },
    "obj_class_10_compat": lambda v: objects_gather(v, classes=[10], compat=True),
    "obj_gather": objects_gather,
    "inst_revoked": lambda v: gone(v, INSTANCE),
    "principals_dropped": lambda v: gone(v, PRINCIPALS),
    "inst_delta": lambda v: new(v, INSTANCE),
    "inst_live_after_revoke": lambda v: _plain_time(after_revoke(v)),
    "inst_live_after_revoke_compat": lambda v: _plain_time(after_revoke(v, compat=True)),
    "inst_live_after_drop": lambda v: _plain_time(after_drop(v)),
    "inst_live_after_drop_compat": lambda v: _plain_time(after_drop(v, compat=True)),
    "inst_live_after_upsert": lambda v: _plain_time(after_upsert(v)),
    "inst_live_after_upsert_compat": lambda v: _plain_time(after_upsert_compat(v)),
    "group_direct": lambda v: groups.direct_members(v.fx_group_edges, v.fx_logins),
    "group_members": groups_gather,
    "group_members_compat": lambda v: groups_gather(v, compat=True),
    "group_closure": group_closure,
    "group_ring_members": lambda v: groups_gather(v, "fx_ring_edges"),
    "group_components": lambda v: groups.components(v.fx_ring_edges),
    "group_members_status": lambda v: groups.members_with_status(v.fx_group_edges, v.fx_logins),
    "group_dropped": lambda v: gone(v, GROUPS),
    "group_new": lambda v: new(v, GROUPS),
    "group_live_next": lambda v: next_state(v, GROUPS),
    "group_live_after_removal_compat": lambda v: after_removal_compat(v, GROUPS),
    "role_dropped": lambda v: gone(v, ROLES),
    "role_new": lambda v: new(v, ROLES),
    "role_live_next": lambda v: next_state(v, ROLES),
    "role_live_after_removal_compat": lambda v: after_removal_compat(v, ROLES),
    "obj_revoked": lambda v: gone(v, OBJECTS),
    "obj_new": lambda v: new(v, OBJECTS),
    "obj_live_next": lambda v: next_state(v, OBJECTS),
    "obj_live_after_removal_compat": lambda v: after_removal_compat(v, OBJECTS),
    "role_dropped_covered": lambda v: gone_covered(v, ROLES),
    "role_live_next_covered": lambda v: next_state_covered(v, ROLES),
    "role_live_after_removal_covered_compat": lambda v: after_removal_covered_compat(v, ROLES),
    "obj_revoked_covered": lambda v: gone_covered(v, OBJECTS),
    "inst_delta_by_digest": lambda v: diff.added(*unlike(v, INSTANCE), INSTANCE, O.AS_OF).select(*INSTANCE.values),
    "obj_revoked_by_digest": lambda v: diff.removed(*unlike(v, OBJECTS), OBJECTS, O.AS_OF).select(*OBJECTS.values),
    "lookup_instance": lambda v: _plain_time(
        lookup.instance_part(identities(v, O.LOGIN), LiveViews(v))
    ),
    "lookup_roles": lambda v: _plain_time(lookup.roles_part(identities(v, O.USER), LiveViews(v))),
    "lookup_role_permissions": lambda v: _plain_time(role_permissions(v)),
    "lookup_role_permissions_compat": lambda v: _plain_time(role_permissions(v, compat=True)),
    "lookup_objects": lambda v: _plain_time(lookup_objects(v)),
    "lookup_summary": lambda v: lookup.summary(v.fx_user_logins, LiveViews(v), v.fx_user_logins),
    "lookup_answer": answer,
    **{
        f"lookup_batch_{part}": lambda v, part=part: _plain_time(getattr(batch(v), part))
        for part in lookup.Permissions._fields
    },
    "lookup_batch_instance": lambda v: _plain_time(batch(v, O.ASKED_LOGINS, "fx_logins").instance),
    "principals_changed": lambda v: renames.principal_changes(*snapshots(v, PRINCIPALS)),
    "lookup_nested_roles": lambda v: nested(v, nested_roles.roles_of),
    "lookup_nested_role_permissions": lambda v: _plain_time(nested(v, nested_roles.role_permissions_of)),
    **{
        f"lookup_as_of_{part}": lambda v, part=part: lookup_as_of(v, part) for part in lookup.Permissions._fields
    },
    "audit_two_runs": audit_runs.summary,
    **{
        f"audit_live_{domain.name}": lambda v, domain=domain: _plain_time(audit_runs.live_rows(v, domain))
        for domain in DOMAINS
    },
    **{
        f"audit_history_{domain.name}": lambda v, domain=domain: _plain_time(audit_runs.history_rows(v, domain))
        for domain in (*DOMAINS, PRINCIPALS)
    },
    **{
        f"audit_compat_live_{domain.name}": lambda v, domain=domain: _plain_time(
            audit_runs.live_rows(v, domain, compat=True)
        )
        for domain in (ROLES, OBJECTS)
    },
    **{
        f"audit_compat_history_{domain.name}": lambda v, domain=domain: _plain_time(
            audit_runs.history_rows(v, domain, compat=True)
        )
        for domain in (ROLES, OBJECTS)
    },
    "audit_log": audit_runs.log_rows,
    "last_success": last_success,
    "last_success_of_job": last_success_of_job,
    "job_runs_named": job_runs_named,
    "job_run_times": job_run_times,
    "alert_gate": alert_gate,
}


def _bind(build: Callable[[Views], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(Views(spark, sf_dir))


def queries() -> dict[str, Query]:
    return {name: _bind(build) for name, build in QUERIES.items()}


def _sql(final: str, steps: dict[str, str] | None = None) -> str:
    return with_views(final, {**VIEWS, **(steps or {})}, recursive=True)


def oracle_sql() -> dict[str, str]:
    strict, compat = O.instance_steps(False), O.instance_steps(True)
    walk = {**O.group_walk("fx_group_edges"), **O.group_walk("prev_group_edges", "_prev")}
    ring = O.group_walk("fx_ring_edges", "_ring")
    domains = {
        "group": (GROUPS, {
            **walk, "before": O.group_members("_prev"), "now": O.group_members(),
        }),
        "role": (ROLES, {
            "before": O.role_members("prev_database_role_members"),
            "now": O.role_members("fx_database_role_members"),
        }),
        "obj": (OBJECTS, {
            "before": O.object_gather("prev_database_permissions"), "now": O.object_gather(),
        }),
    }
    instance_state = f"SELECT {O.cols([*INSTANCE.values, POLL])} FROM "
    result = {
        "inst_explicit_grants": _sql(O.instance_grants("fx_server_principals", "fx_server_permissions")),
        "inst_explicit_grants_compat": _sql(
            O.instance_grants("fx_server_principals", "fx_server_permissions", compat=True)
        ),
        "inst_fixed_roles": _sql(O.fixed_roles(FIXED_SERVER_ROLES)),
        "inst_gather": _sql(
            O.instance_gather("fx_server_principals", "fx_server_permissions", FIXED_SERVER_ROLES)
        ),
        "db_online": _sql(O.DB_ONLINE),
        "db_role_members": _sql(O.role_members("fx_database_role_members")),
        **{f"obj_class_{cls}": _sql(O.object_class(cls)) for cls in SECURABLE_CLASSES},
        "obj_class_10_compat": _sql(O.object_class(10, compat=True)),
        "obj_gather": _sql(O.object_gather()),
        "inst_revoked": _sql(O.minus(INSTANCE, "prev_instance", "fx_instance")),
        "principals_dropped": _sql(O.minus(PRINCIPALS, "prev_instance", "fx_instance")),
        "inst_delta": _sql(O.minus(INSTANCE, "fx_instance", "prev_instance")),
        "group_direct": _sql(O.GROUP_DIRECT),
        "group_members": _sql(O.group_members(), walk),
        "group_members_compat": _sql(O.GROUP_COMPAT, walk),
        "group_closure": _sql(
            "SELECT account_name, ancestor, CAST(min(depth) AS INT) AS depth FROM ways "
            "WHERE account_name <> ancestor GROUP BY account_name, ancestor", walk,
        ),
        "group_ring_members": _sql(O.group_members("_ring"), ring),
        "group_components": _sql(O.GROUP_COMPONENTS, ring),
        "group_members_status": _sql(O.GROUP_STATUS),
        "lookup_instance": _sql(O.LOOKUP_INSTANCE, O.LIVE),
        "lookup_roles": _sql(O.LOOKUP_ROLES, O.LIVE),
        "lookup_role_permissions": _sql(O.LOOKUP_ROLE_PERMISSIONS, O.LIVE),
        "lookup_role_permissions_compat": _sql(O.LOOKUP_ROLE_PERMISSIONS_COMPAT, O.LIVE),
        "lookup_objects": _sql(O.LOOKUP_OBJECTS, O.LIVE),
        "lookup_summary": _sql(f"SELECT * FROM ({O.LOOKUP_SUMMARY}) t", O.LIVE),
        "lookup_answer": _sql(O.LOOKUP_ANSWER, O.LIVE),
        **{f"lookup_batch_{part}": _sql(sql, O.LIVE) for part, sql in O.LOOKUP_BATCH.items()},
        "principals_changed": _sql(O.PRINCIPALS_CHANGED, {
            "went": O.minus(PRINCIPALS, "prev_instance", "fx_instance"),
            "came": O.minus(PRINCIPALS, "fx_instance", "prev_instance"),
        }),
        "lookup_nested_roles": _sql(O.LOOKUP_NESTED_ROLES, O.LIVE | O.ROLE_WALK),
        "lookup_nested_role_permissions": _sql(O.LOOKUP_NESTED_ROLE_PERMISSIONS, O.LIVE | O.ROLE_WALK),
        **{f"lookup_as_of_{part}": _sql(sql, O.past_steps()) for part, sql in O.LOOKUP_AS_OF.items()},
        "audit_two_runs": _sql(audit_runs.final(), audit_runs.steps(walk)),
        **{
            f"audit_live_{domain.name}": _sql(audit_runs.live_sql(domain), audit_runs.steps(walk))
            for domain in DOMAINS
        },
        **{
            f"audit_history_{domain.name}": _sql(audit_runs.history_sql(domain), audit_runs.steps(walk))
            for domain in (*DOMAINS, PRINCIPALS)
        },
        **{
            f"audit_compat_live_{domain.name}": _sql(
                audit_runs.compat_live_sql(domain), audit_runs.steps(walk, compat=True)
            )
            for domain in (ROLES, OBJECTS)
        },
        **{
            f"audit_compat_history_{domain.name}": _sql(
                audit_runs.history_sql(domain), audit_runs.steps(walk, compat=True)
            )
            for domain in (ROLES, OBJECTS)
        },
        "audit_log": audit_runs.log_sql(),
        "last_success": _sql(O.LAST_SUCCESS),
        "last_success_of_job": _sql(O.LAST_SUCCESS.replace("fx_job_history", f"({O.JOB_RUNS_NAMED}) h")),
        "job_runs_named": _sql(O.JOB_RUNS_NAMED),
        "job_run_times": _sql(O.JOB_RUN_TIMES),
        "alert_gate": _sql(O.ALERT_GATE),
    }
    covered = {
        "role": (ROLES, {
            "before": O.role_members("prev_database_role_members", "prev_databases"),
            "now": O.role_members("fx_database_role_members", "later_databases"),
        }),
        "obj": (OBJECTS, {
            "before": O.object_gather("prev_database_permissions", databases="prev_databases"),
            "now": O.object_gather(databases="later_databases"),
        }),
    }
    domain, steps = covered["role"]
    result |= {
        "role_dropped_covered": _sql(O.minus_covered(domain, "before", "now", "later_databases"), steps),
        "role_live_next_covered": _sql(O.next_state_covered(domain, "before", "now", "later_databases"), steps),
        "role_live_after_removal_covered_compat": _sql(
            O.after_removal_compat(domain, "before", "now", O.unread("later_databases")), steps
        ),
        "obj_revoked_covered": _sql(
            O.minus_covered(OBJECTS, "before", "now", "later_databases"), covered["obj"][1]
        ),
        "inst_delta_by_digest": result["inst_delta"],
        "obj_revoked_by_digest": _sql(O.minus(OBJECTS, "before", "now"), domains["obj"][1]),
    }
    for step in ("after_revoke", "after_drop", "after_upsert"):
        result[f"inst_live_{step}"] = _sql(instance_state + step, strict)
        result[f"inst_live_{step}_compat"] = _sql(instance_state + step, compat)
    for prefix, (domain, steps) in domains.items():
        first = "revoked" if prefix == "obj" else "dropped"
        result[f"{prefix}_{first}"] = _sql(O.minus(domain, "before", "now"), steps)
        result[f"{prefix}_new"] = _sql(O.minus(domain, "now", "before"), steps)
        result[f"{prefix}_live_after_removal_compat"] = _sql(
            O.after_removal_compat(domain, "before", "now"), steps
        )
        result[f"{prefix}_live_next"] = _sql(O.next_state(domain, "before", "now"), steps)
    return result
