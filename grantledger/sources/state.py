"""Audit state in Parquet folders.

    staging/<domain>               the current snapshot, replaced by every run
    work/<domain>-<step>           a step's changes, for the run's later steps
    live/<table>/run_id=<n>        the live version that run n wrote
    history/<table>/run_id=<n>     rows removed by run n
    journal/gen=<g>                what runs began, committed or set aside

A run's live version and history become visible with its journal entry, which
holds the outcome and the log too, so readers never see half a run, and
repeating an uncommitted run overwrites what it left. A version that another
one has replaced stays for `retention`, for those who still read it. The
journal is written anew as one file whenever appends have made it many. There
must be one writer at a time.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantledger.functions.times import stamp
from grantledger.operators.diff import FIRST_SEEN, RECORDED
from grantledger.operators.lookup import Live
from grantledger.schemas import DOMAINS, POLL, RUN_LOG, Domain, live_schema, value_schema
from grantledger.sources import files

CHANGE_KIND = "change_kind"
OPEN, COMMIT, PARKED = "open", "commit", "parked"
PART = T.StructType(
    [
        T.StructField("domain", T.StringType(), False),
        T.StructField("complete", T.BooleanType(), False),
        T.StructField("version", T.LongType()),
        T.StructField("recorded", T.ArrayType(T.StringType()), False),
    ]
)
JOURNAL = T.StructType(
    [
        T.StructField("kind", T.StringType(), False),
        T.StructField("run_id", T.LongType()),
        T.StructField("delivery", T.StringType()),
        T.StructField("as_of", T.TimestampType()),
        T.StructField("written_at", T.TimestampType(), False),
        T.StructField("succeeded", T.BooleanType()),
        T.StructField("parts", T.ArrayType(PART), False),
        T.StructField("log", T.ArrayType(RUN_LOG), False),
    ]
)
#: The journal is written anew after so many files; a run appends two.
JOURNAL_FILES = 100
RETENTION = timedelta(days=2)


@dataclass
class Head:
    """Where the state stands: per domain the newest version and the time of the last snapshot."""

    last_run: int = 0
    versions: dict[str, int] = field(default_factory=dict)
    as_of: dict[str, datetime] = field(default_factory=dict)
    last_success: datetime | None = None


@dataclass
class Part:
    """What a run did with a domain."""

    domain: str
    complete: bool
    version: int | None
    recorded: list[str]


class State:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        retention: timedelta = RETENTION,
        sid_type: T.DataType | None = None,
    ) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.retention = retention
        self.sid_type = sid_type or T.BinaryType()

    def _read(self, path: str, schema: T.StructType) -> DataFrame:
        """The table at `path`, or an empty one where nothing was written yet."""
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{path}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _write(self, df: DataFrame, path: str) -> None:
        df.write.mode("overwrite").parquet(f"{self.root}/{path}")

    # the journal

    def _generations(self) -> list[int]:
        """Complete generations; one without the mark of a finished write is a lost attempt."""
        found = [n for n in files.children(self.spark, f"{self.root}/journal") if n.startswith("gen=")]
        whole = [n for n in found if files.exists(self.spark, f"{self.root}/journal/{n}/_SUCCESS")]
        return sorted(int(n.removeprefix("gen=")) for n in whole)

    def journal(self) -> DataFrame:
        newest = max(self._generations(), default=0)
        return self._read(f"journal/gen={newest}", JOURNAL)

    def _append(self, *entries: tuple) -> None:
        path = f"{self.root}/journal/gen={max(self._generations(), default=0)}"
        self.spark.createDataFrame(entries, JOURNAL).coalesce(1).write.mode("append").parquet(path)

    def compact(self) -> None:
        """Write the journal as one file if it has become many; begun runs that ended go."""
        generations = self._generations()
        newest = max(generations, default=0)
        names = files.children(self.spark, f"{self.root}/journal/gen={newest}")
        if sum(n.startswith("part-") for n in names) < JOURNAL_FILES:
            return
        journal = self.journal()
        ended = journal.filter(F.col("kind") == COMMIT).select("run_id").distinct()
        begun = journal.filter(F.col("kind") == OPEN).join(ended, "run_id", "left_anti")
        kept = journal.filter(F.col("kind") != OPEN).unionByName(begun.select(*journal.columns))
        self._write(kept.coalesce(1), f"journal/gen={newest + 1}")
        for old in generations[:-1]:  # the last one stays for those who read it just now
            files.delete(self.spark, f"{self.root}/journal/gen={old}")

    def commits(self) -> DataFrame:
        """One row for each committed run."""
        return self.journal().filter(F.col("kind") == COMMIT)

    def head(self) -> Head:
        """Everything a run has to know of earlier ones, in one read of the journal."""
        commits = self.commits()
        parts = commits.select("run_id", "as_of", "succeeded", F.explode_outer("parts").alias("part"))
        version, complete = F.col("part.version"), F.col("part.complete")
        # at most a row for each domain and one for runs without any
        rows = parts.groupBy("part.domain").agg(
            F.max("run_id").alias("last_run"),
            F.max(F.when(version.isNotNull(), F.struct("run_id", version.alias("version")))).alias("newest"),
            F.max(F.when(complete, F.col("as_of"))).alias("as_of"),
            F.max(F.when(F.col("succeeded"), F.col("as_of"))).alias("last_success"),
        ).collect()
        head = Head(last_run=max((r.last_run for r in rows), default=0))
        head.versions = {r.domain: r.newest.version for r in rows if r.newest is not None}
        head.as_of = {r.domain: r.as_of for r in rows if r.as_of is not None}
        head.last_success = max((r.last_success for r in rows if r.last_success), default=None)
        return head

    def last_run(self) -> int:
        return self.head().last_run

    def done(self, run_id: int | None = None, delivery: str | None = None) -> set[str] | None:
        """Domains completed by a run, or for a delivery; None if it is not known."""
        wanted = F.lit(False)
        if run_id is not None:
            wanted = wanted | (F.col("run_id") == run_id)
        if delivery is not None:
            wanted = wanted | (F.col("delivery") == delivery)
        rows = self.commits().filter(wanted).select("parts").collect()  # the tries of one delivery
        if not rows:
            return None
        return {part.domain for row in rows for part in row.parts if part.complete}

    def is_committed(self, run_id: int) -> bool:
        """Whether a run has completed all domains."""
        return self.done(run_id) == {domain.name for domain in DOMAINS}

    def is_parked(self, delivery: str) -> bool:
        parked = self.journal().filter((F.col("kind") == PARKED) & (F.col("delivery") == delivery))
        return not parked.isEmpty()

    def begin(self, run_id: int, delivery: str | None, as_of: datetime, at: datetime, log: list[tuple]) -> None:
        """Note a run and its steps before the work, so that a lost run leaves a trace."""
        self._append((OPEN, run_id, delivery, as_of, at, None, [], log))

    def commit(
        self, run_id: int, delivery: str | None, as_of: datetime, at: datetime, succeeded: bool,
        parts: Iterable[Part], log: list[tuple],
    ) -> None:
        """Make a run visible, with its outcome and its log, by a single write."""
        listed = [(p.domain, p.complete, p.version, p.recorded) for p in parts]
        self._append((COMMIT, run_id, delivery, as_of, at, succeeded, listed, log))

    def park(self, delivery: str, as_of: datetime, at: datetime) -> None:
        """Set a delivery aside that came too late to be audited."""
        self._append((PARKED, None, delivery, as_of, at, None, [], []))

    def log(self) -> DataFrame:
        """Run-log rows: of ended runs as they ended, of others as they began."""
        rows = self.journal().filter(F.col("kind") != PARKED).select("kind", "written_at", F.explode("log").alias("row"))
        newest = rows.groupBy("row.RecordPermissionsAuditID").agg(
            F.max_by("row", F.struct((F.col("kind") == COMMIT).alias("ended"), "written_at")).alias("row")
        )
        return newest.select("row.*")

    # staging and work tables

    def staging(self, domain: Domain) -> DataFrame:
        return self._read(f"staging/{domain.name}", value_schema(domain, self.sid_type))

    def write_staging(self, domain: Domain, rows: DataFrame) -> None:
        self._write(rows.select(*domain.values), f"staging/{domain.name}")

    def clear_staging(self) -> None:
        for domain in DOMAINS:
            empty = self.spark.createDataFrame([], value_schema(domain, self.sid_type))
            self._write(empty, f"staging/{domain.name}")

    def settle_work(self, domain: Domain, step: str, rows: DataFrame) -> DataFrame:
        path = f"work/{domain.name}-{step}"
        self._write(rows, path)
        return self.spark.read.schema(rows.schema).parquet(f"{self.root}/{path}")

    # live versions

    def _live_schema(self, domain: Domain) -> T.StructType:
        schema = live_schema(domain, self.sid_type)
        return schema.add(RECORDED, T.TimestampType()) if domain.sticky else schema

    def versions_in_use(self) -> dict[str, int]:
        return self.head().versions

    def live(self, domain: Domain) -> DataFrame:
        return self.live_at(domain, self.versions_in_use().get(domain.name))

    def live_at(self, domain: Domain, version: int | None) -> DataFrame:
        """A live version; sticky domains also tell when a row was last recorded as removed."""
        schema = self._live_schema(domain)
        if version is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/live/{domain.live}/run_id={version}")

    def write_live(self, domain: Domain, rows: DataFrame, run_id: int) -> int:
        """Write the run's version, which counts once committed.

        Rows are sorted by principal within each file, so that a lookup whose
        names are literals skips row groups and pages, and the write pays for
        no shuffle.
        """
        columns = self._live_schema(domain).names
        if RECORDED in columns and RECORDED not in rows.columns:
            rows = rows.withColumn(RECORDED, F.lit(None).cast("timestamp"))
        ordered = rows.select(*columns).sortWithinPartitions("PrincipalName")
        self._write(ordered, f"live/{domain.live}/run_id={run_id}")
        return run_id

    def retire(self, now: datetime) -> None:
        """Delete live versions that another one replaced longer than `retention` ago, and lost attempts."""
        kept_since = now - self.retention
        for domain in DOMAINS:
            names = files.children(self.spark, f"{self.root}/live/{domain.live}")
            there = sorted(int(n.removeprefix("run_id=")) for n in names if n.startswith("run_id="))
            if len(there) < 2:
                continue
            parts = self.commits().select("written_at", F.explode("parts").alias("part")).filter(
                (F.col("part.domain") == domain.name) & F.col("part.version").isin(there)
            )
            # as many rows as versions are kept
            written = {r.version: r.at for r in parts.groupBy("part.version").agg(F.min("written_at").alias("at")).collect()}
            known = sorted(written)
            for version, after in zip(known, known[1:], strict=False):
                if written[after] < kept_since:
                    files.delete(self.spark, f"{self.root}/live/{domain.live}/run_id={version}")
            for lost in [v for v in there if known and v < known[-1] and v not in written]:
                files.delete(self.spark, f"{self.root}/live/{domain.live}/run_id={lost}")

    def all_live(self) -> Live:
        versions = self.versions_in_use()
        return Live(*[self.live_at(domain, versions.get(domain.name)) for domain in DOMAINS])

    # history

    def _history_schema(self, domain: Domain) -> T.StructType:
        schema = live_schema(domain, self.sid_type)
        return schema.add(FIRST_SEEN, T.TimestampType()).add(CHANGE_KIND, T.StringType()).add("run_id", T.LongType())

    def history(self, domain: Domain, since: datetime | str | None = None) -> DataFrame:
        """Rows removed by committed runs, with their `run_id`; with `since`, by runs on later snapshots.

        `since` makes the runs a list, so that the folders of all others are
        not even listed for reading.
        """
        rows = self._read(f"history/{domain.removed}", self._history_schema(domain))
        named = F.exists("parts", lambda p: F.array_contains(p["recorded"], domain.removed))
        committed = self.commits().filter(named)
        if since is None:
            return rows.join(committed.select("run_id").distinct(), "run_id", "left_semi")
        later = committed.filter(F.col("as_of") > stamp(since)).select("run_id").distinct().collect()
        return rows.filter(F.col("run_id").isin([r.run_id for r in later]))

    def write_history(self, domain: Domain, run_id: int, rows: DataFrame) -> bool:
        """Record removed rows under the run; nothing is written where there are none.

        `rows` should be settled: they are looked at before they are written.
        """
        if rows.isEmpty():
            return False
        for name, kind in ((FIRST_SEEN, "timestamp"), (CHANGE_KIND, "string")):
            if name not in rows.columns:
                rows = rows.withColumn(name, F.lit(None).cast(kind))
        self._write(
            rows.select(*domain.values, POLL, FIRST_SEEN, CHANGE_KIND), f"history/{domain.removed}/run_id={run_id}"
        )
        return True

    def recorded_in(self, domain: Domain, run_id: int) -> DataFrame:
        """Rows the given run has recorded, committed or not."""
        return self._read(
            f"history/{domain.removed}/run_id={run_id}", live_schema(domain, self.sid_type)
        )
