"""The audit run: gather a snapshot, record what changed, bring live up to date."""

from __future__ import annotations

import logging
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantledger.functions.times import stamp
from grantledger.operators import coverage, databases, diff, digests, groups, instance
from grantledger.operators.coverage import Coverage
from grantledger.schemas import (
    DOMAINS, GROUPS, INSTANCE, OBJECTS, POLL, PRINCIPALS, ROLES, Domain,
)
from grantledger.session import scratch
from grantledger.sources.catalogs import Catalogs
from grantledger.sources.state import CHANGE_KIND, Part, State

LOG = logging.getLogger(__name__)

#: Log ids of a run: its own and those of its steps, of which there are fourteen.
IDS_PER_RUN = 100
NO_PARENT = -1
RUN_NAME = "record permissions"
CLEAR = "clear staging"

# the steps of each domain, in order
STEPS = {
    INSTANCE: (
        "gather instance",
        "record revoked instance permissions",
        "record dropped principals",
        "record instance permission changes",
    ),
    GROUPS: ("gather groups", "record dropped group members", "record new group members"),
    ROLES: ("gather roles", "record dropped role members", "record new role members"),
    OBJECTS: (
        "gather objects", "record revoked object permissions", "record new object permissions",
    ),
}
ORDER = (CLEAR, *[name for names in STEPS.values() for name in names])


#: The watermark of a compat run is that of the last successful run, unless one is given.
LAST_SUCCESS = "last success"


class LateSnapshot(ValueError):
    """The snapshot is not newer than what is recorded already."""


def moment(value: datetime | str) -> datetime:
    """A time as it is compared with recorded ones, in the session time zone."""
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    return value.astimezone(timezone.utc).replace(tzinfo=None) if value.tzinfo else value


@dataclass
class AuditResult:
    run_id: int
    succeeded: bool
    steps: dict[str, bool] = field(default_factory=dict)
    errors: dict[str, str] = field(default_factory=dict)


def gather(domain: Domain, catalogs: Catalogs, server_name: str | None, compat: bool) -> DataFrame:
    """Staging rows of one domain."""
    c = catalogs
    if domain is INSTANCE:
        return instance.gather(
            c.server_principals, c.server_permissions, c.endpoints, c.logins, server_name, compat
        )
    if domain is GROUPS:
        return groups.gather(c.group_edges, c.logins, compat)
    if domain is ROLES:
        return databases.role_members(
            c.database_principals, c.database_role_members, c.databases, server_name
        )
    return databases.object_permissions(
        c.database_permissions, c.database_principals, c.all_objects, c.schemas,
        c.all_columns, c.securables, c.databases, server_name, compat=compat,
    )


def coverage_of(domain: Domain, catalogs: Catalogs, server_name: str | None) -> Coverage | None:
    """Which databases the snapshot read; the other domains are delivered whole."""
    if domain in (ROLES, OBJECTS):
        return coverage.of_databases(catalogs.databases, server_name)
    return None


class _DomainRun:
    """One domain's part of a run; its steps follow each other."""

    def __init__(self, domain: Domain, state: State, run_id: int, as_of, version: int | None) -> None:
        self.domain = domain
        self.state = state
        self.run_id = run_id
        self.as_of = as_of
        self.earlier = version
        self.version: int | None = None
        self.recorded: list[str] = []

    def gather(self, catalogs: Catalogs, server_name: str | None, compat: bool) -> None:
        self.live = self.state.live_at(self.domain, self.earlier)
        self.coverage = coverage_of(self.domain, catalogs, server_name)
        rows = gather(self.domain, catalogs, server_name, compat)
        self.state.write_staging(self.domain, rows)

    @property
    def staging(self) -> DataFrame:
        return self.state.staging(self.domain)

    def settled(self, step: str, rows: DataFrame) -> DataFrame:
        return self.state.settle_work(self.domain, step, rows)

    def record(self, kind: Domain, rows: DataFrame) -> bool:
        if not self.state.write_history(kind, self.run_id, rows):
            return False
        self.recorded.append(kind.removed)
        return True

    def write_live(self, rows: DataFrame) -> None:
        self.version = self.state.write_live(self.domain, rows, self.run_id)


class _StrictRun(_DomainRun):
    """One comparison, whose result all later steps reuse; no history is read."""

    def removed(self) -> None:
        domain = self.domain
        # live and staging are stored tables: their digests cost less than a shuffle of all rows
        live, staging = digests.differing(coverage.inside(self.live, self.coverage), self.staging, domain)
        self.delta = self.settled("changes", diff.changes(live, staging, domain, coverage=self.coverage))
        gone = self.delta.filter((F.col("change") == "removed") & F.col("unrecorded"))
        if domain.update_key:
            gone = diff.superseded(gone, self.delta.filter(F.col("change") == "added"), domain)
        else:
            gone = gone.withColumn(CHANGE_KIND, F.lit("removed"))
        kept = gone.select(*domain.values, stamp(self.as_of).alias(POLL), diff.FIRST_SEEN, CHANGE_KIND)
        self.record(domain, kept)

    def dropped(self) -> None:
        rows = diff.dropped_principals(self.delta, self.staging, self.as_of)
        self.drops = self.record(PRINCIPALS, self.settled("dropped", rows))

    def changed(self) -> None:
        if diff.alters_live(self.delta, self.domain).isEmpty():
            return
        dropped = None
        if self.domain is INSTANCE and self.drops:
            recorded = self.state.recorded_in(PRINCIPALS, self.run_id)
            dropped = recorded.select(*PRINCIPALS.values)
        self.write_live(
            diff.next_live(self.live, self.delta, self.domain, self.as_of, dropped)
        )

    def finish(self) -> None:
        pass


class _CompatRun(_DomainRun):
    """Every step changes live on its own, with what the steps before it left."""

    since: datetime | str | None = None
    deleted = False
    #: New rows as one comparison found them along with the removed ones; None where live may have lost others since.
    new: DataFrame | None = None

    def gather(self, catalogs: Catalogs, server_name: str | None, compat: bool) -> None:
        super().gather(catalogs, server_name, compat)
        self.live = self.live.select(*self.domain.values, POLL)

    def _delete(self, kind: Domain, step: str, gone: DataFrame) -> None:
        recorded = self.record(kind, gone)
        if self.since is None:
            return
        columns = [*kind.values, POLL]
        history = self.state.history(kind, self.since).select(*columns)
        if self.new is not None and not history.isEmpty():
            # what other runs recorded may delete rows that the snapshot holds
            self.new = None
        if recorded:
            history = history.unionByName(self.state.recorded_in(kind, self.run_id).select(*columns))
        after = diff.apply_removed(self.live, history, kind, True, self.since, self.coverage)
        self.live = self.settled(f"after-{step}", after)
        self.deleted = True

    def removed(self) -> None:
        domain = self.domain
        if {*domain.compat_match, *domain.compat_null_safe} != {*domain.values}:
            # the deletion may take rows along that the snapshot holds
            gone = diff.removed(self.live, self.staging, domain, self.as_of, coverage=self.coverage)
            self._delete(domain, "removed", self.settled("removed", gone))
            return
        delta = self.settled("changes", diff.changes(self.live, self.staging, domain, coverage=self.coverage))
        sides = {
            change: delta.filter(F.col("change") == change).select(*domain.values, stamp(self.as_of).alias(POLL))
            for change in ("added", "removed")
        }
        self.new = sides["added"]
        self._delete(domain, "removed", sides["removed"])

    def dropped(self) -> None:
        gone = diff.removed(self.live, self.staging, PRINCIPALS, self.as_of, coverage=self.coverage)
        self._delete(PRINCIPALS, "dropped", self.settled("dropped", gone))

    def changed(self) -> None:
        domain, staging = self.domain, self.staging
        if domain is INSTANCE:
            live = diff.upsert_compat(self.live, staging, self.as_of, new=self.new)
        else:
            new = self.new
            if new is None:
                new = diff.added(self.live, staging, domain, self.as_of, self.coverage)
            live = diff.apply_added(self.live, new, domain)
        self.write_live(live)
        self.deleted = False

    def finish(self) -> None:
        """Keep the deletions where the last step failed."""
        if self.deleted:
            self.write_live(self.live)


def run_audit(
    catalogs: Catalogs,
    state: State,
    as_of: datetime | str,
    server_name: str | None = None,
    run_by: str = "audit",
    compat: bool = False,
    since: datetime | str | None = LAST_SUCCESS,
    run_id: int | None = None,
    delivery: str | None = None,
    clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc).replace(tzinfo=None),
) -> AuditResult:
    """Run the fourteen steps once and commit the result.

    The four domains share nothing, so their jobs are submitted side by side
    and fill the cluster together. A failed step never stops the run. In strict
    mode the rest of its domain is skipped and its state left as it was, and
    the run counts as failed. In compat mode the later steps go on with what is
    there, the run counts as successful, and deletions use history polled after
    `since`: by default the snapshot of the last successful run, without which,
    or with None, nothing is deleted.

    A run has the next number. `delivery` (or an earlier `run_id`) says which
    snapshot this is: if all its domains are complete nothing is done, and of
    one that failed in part only the open domains are run. A snapshot that is
    not newer than what an open domain has recorded raises `LateSnapshot`.
    """
    at = moment(as_of)
    head = state.head()
    known = None
    if run_id is not None or delivery is not None:
        known = state.done(run_id, delivery)
    wanted = [d for d in DOMAINS if d.name not in (known or ())]
    if not wanted:
        return AuditResult(head.last_run if run_id is None else run_id, True)
    late = [d.name for d in wanted if d.name in head.as_of and head.as_of[d.name] >= at]
    if late:
        raise LateSnapshot(f"{', '.join(late)}: a snapshot of {at} or later is recorded already")
    if run_id is None:
        run_id = head.last_run + 1
    if since == LAST_SUCCESS:
        since = head.last_success
    result = AuditResult(run_id, True)
    parent = run_id * IDS_PER_RUN
    started = clock()
    number = {name: parent + 1 + i for i, name in enumerate(ORDER)}
    names = [CLEAR, *[name for d in wanted for name in STEPS[d]]]
    rows: dict[str, tuple] = {}
    state.begin(
        run_id, delivery, at, started,
        [(parent, NO_PARENT, RUN_NAME, started, None, run_by, "N")]
        + [(number[name], parent, name, started, None, run_by, "N") for name in names],
    )

    def step(name: str, action: Callable[[], None], skip: str | None = None) -> bool:
        opened = clock()
        message = skip
        if skip is None:
            LOG.info("%s: starting", name)
            try:
                action()
            except Exception as error:  # noqa: BLE001 - a failure is recorded, the run goes on
                LOG.exception("%s: failed", name)
                message = str(error)
        if message is not None:
            result.errors[name] = message
        rows[name] = (number[name], parent, name, opened, clock(), run_by, "Y" if message is None else "N")
        return message is None

    def run_domain(part: _StrictRun | _CompatRun) -> bool:
        actions = [
            lambda: part.gather(catalogs, server_name, compat),
            part.removed,
            *([part.dropped] if part.domain is INSTANCE else []),
            part.changed,
        ]
        complete = True
        for name, action in zip(STEPS[part.domain], actions, strict=True):
            skip = None
            if not (complete or compat):
                skip = f"skipped after a failed step of {part.domain.name}"
            complete = step(name, action, skip) and complete
        try:
            part.finish()
        except Exception as error:  # noqa: BLE001 - the last step has not kept what it should
            name = STEPS[part.domain][-1]
            LOG.exception("%s: failed", name)
            result.errors[name] = str(error)
            rows[name] = (*rows[name][:-1], "N")
            part.version = None
            return False
        return complete or compat

    with scratch(state.spark):
        step(CLEAR, state.clear_staging)
        kind = _CompatRun if compat else _StrictRun
        parts = [kind(d, state, run_id, at, head.versions.get(d.name)) for d in wanted]
        for part in parts:
            part.since = since
        with ThreadPoolExecutor(len(parts)) as threads:
            complete = list(threads.map(run_domain, parts))

    result.steps = {name: name not in result.errors for name in names}
    failed = [p.domain.name for p, ok in zip(parts, complete, strict=True) if not ok]
    result.succeeded = not failed and (compat or not result.errors)
    ended = clock()
    whole = (parent, NO_PARENT, RUN_NAME, started, ended, run_by, "Y" if result.succeeded else "N")
    state.commit(
        run_id, delivery, at, ended, result.succeeded,
        [
            Part(p.domain.name, ok, p.version, p.recorded) if ok else Part(p.domain.name, False, None, [])
            for p, ok in zip(parts, complete, strict=True)
        ],
        [whole, *[rows[name] for name in names]],
    )
    state.compact()
    state.retire(ended)
    return result
