"""Job-run history and the last-successful-run watermark."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantledger.functions.times import run_timestamp

JOB_OUTCOME = 0
SUCCEEDED = 1


def with_job_names(history: DataFrame, jobs: DataFrame) -> DataFrame:
    """History rows of known jobs, with `job_name`."""
    return history.join(jobs.select("job_id", F.col("name").alias("job_name")), "job_id", "inner")


def history_of(run_log: DataFrame, job: str) -> DataFrame:
    """Our own run log in the shape of a job history: one outcome row per parent row."""
    parents = run_log.filter(F.col("ParentAuditID") == -1)
    started = F.col("ExecStartDT")
    return parents.select(
        F.lit(job).alias("job_name"),
        F.lit(JOB_OUTCOME).alias("step_id"),
        F.when(F.col("SuccessIndicator") == "Y", SUCCEEDED).otherwise(0).alias("run_status"),
        F.date_format(started, "yyyyMMdd").cast("int").alias("run_date"),
        F.date_format(started, "HHmmss").cast("int").alias("run_time"),
    )


def last_success(history: DataFrame, job: str) -> DataFrame:
    """The latest successful whole-job run: no row, or one with its date, time and timestamp.

    A maximum over the pair combines map-side and needs no sort.
    """
    latest = (
        history.filter(
            (F.col("job_name") == job)
            & (F.col("step_id") == JOB_OUTCOME)
            & (F.col("run_status") == SUCCEEDED)
        )
        .agg(F.max(F.struct("run_date", "run_time")).alias("latest"))
        .filter(F.col("latest").isNotNull())
    )
    return latest.select("latest.run_date", "latest.run_time").withColumn(
        "last_run", run_timestamp(F.col("run_date"), F.col("run_time"))
    )


def watermark(history: DataFrame, job: str) -> datetime | str | None:
    """`last_success` as text in the session time zone, or None without a successful run."""
    row = last_success(history, job).select(F.col("last_run").cast("string")).first()
    return row[0] if row else None
