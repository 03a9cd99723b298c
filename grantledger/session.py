"""Session settings and lineage cuts shared by all jobs."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from grantledger.sources import files

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even where the split costs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}

TARGET_PARTITION_BYTES = 128 << 20


def shuffle_partitions(input_bytes: int, cores: int) -> int:
    """Shuffle width giving about 128 MB per task, in whole waves over the cores.

    Adaptive execution merges partitions that turn out small, but never makes
    more than this number, so it has to follow the size of the snapshot.
    """
    wanted = max(-(-input_bytes // TARGET_PARTITION_BYTES), 1)
    waves = -(-wanted // cores)
    return waves * cores


def build_session(
    app_name: str = "grantledger", input_bytes: int | None = None, cores: int = 8, **conf: str
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    if input_bytes is not None:
        builder = builder.config(
            "spark.sql.shuffle.partitions", shuffle_partitions(input_bytes, cores)
        )
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by `spark.checkpoint.dir`.

    Only a local session without that setting, whose executors are the driver,
    gets a folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="grantledger-"))
    return context.getCheckpointDir()


#: Tables settled since each open `scratch` began.
_OWNED: list[list[str]] = []


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Cuts the lineage of iterative jobs. The table outlives lost executors, and
    its file sizes let Catalyst choose the join for the next step. Inside a
    `scratch` it is removed at its end, otherwise it stays for the caller.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    if _OWNED:
        _OWNED[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove at the end what was settled meanwhile; results must be written by then."""
    owned: list[str] = []
    _OWNED.append(owned)
    try:
        yield
    finally:
        _OWNED.remove(owned)
        for path in owned:
            files.delete(spark, path)
