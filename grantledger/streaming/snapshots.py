"""Audit runs driven by arriving snapshot announcements."""

from __future__ import annotations

import json
import logging
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from grantledger.plans.audit import LateSnapshot, moment, run_audit
from grantledger.sources.catalogs import Catalogs
from grantledger.sources.state import State

LOG = logging.getLogger(__name__)

ANNOUNCEMENT = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("as_of", T.StringType(), False),
        T.StructField("server_name", T.StringType()),
    ]
)


def delivery_of(path: str, as_of: str, server_name: str | None) -> str:
    """What identifies an announcement, whichever stream or batch brings it."""
    return json.dumps([path, as_of, server_name])


def run_batch(
    announced: DataFrame,
    batch_id: int,
    state: State,
    open_catalogs: Callable[[SparkSession, str], Catalogs] = Catalogs.from_files,
) -> None:
    """Audit each announced snapshot in the order of its time, one at a time.

    A delivery whose domains are all complete is skipped; of one that failed in
    part, only the open domains are run again. A snapshot older than what is
    recorded is set aside. A failed run ends the batch with an error, so the
    stream brings it again and nothing later overtakes it.
    """
    announced = announced.withColumn("_at", F.try_to_timestamp("as_of"))
    for row in announced.orderBy("_at", "path").toLocalIterator():
        if row["_at"] is None:
            raise ValueError(f"no time: {row['as_of']!r} of {row['path']}")
        delivery = delivery_of(row["path"], row["as_of"], row["server_name"])
        if state.is_parked(delivery):
            continue
        try:
            result = run_audit(
                open_catalogs(state.spark, row["path"]), state, row["as_of"],
                server_name=row["server_name"], delivery=delivery,
            )
        except LateSnapshot as late:
            LOG.warning("set aside: %s", late)
            state.park(delivery, moment(row["as_of"]), datetime.now(timezone.utc).replace(tzinfo=None))
            continue
        if not result.succeeded:
            raise RuntimeError(f"run {result.run_id} on {row['path']} failed: {result.errors}")


def follow(
    spark: SparkSession, announcements: str, state: State, checkpoint: str, **trigger
) -> StreamingQuery:
    """Follow a folder of JSON announcements, one file per micro-batch.

    The stream carries only the announcements; each run reads its snapshot as
    a batch. Without a trigger it handles all waiting files and stops.
    """
    stream = (
        spark.readStream.schema(ANNOUNCEMENT)
        .option("maxFilesPerTrigger", 1)
        .json(announcements)
    )
    return (
        stream.writeStream.foreachBatch(lambda rows, batch: run_batch(rows, batch, state))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
