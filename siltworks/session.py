"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "siltworks", master: str | None = None, **conf: str) -> SparkSession:
    """A UTC session with adaptive execution; ``conf`` overrides any setting."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Rows go between the JVM and a Python worker in batches that end after so many bytes: less than a
#: power of two, which the last row passes and which would double the buffers.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "3m"
#: Parquet files are read in batches of so many rows.
READ_SETTING, READ_ROWS = "spark.sql.parquet.columnarReaderBatchSize", "512"


def bounded_batches(spark: SparkSession) -> None:
    """Let the session bound Arrow batches by bytes and read Parquet in small batches, unless it has
    bounds of its own.

    A batch of 10,000 rows with long texts is held by the JVM and by the worker, by each of them
    with the batch before it, and its buffers grow by doubling. So do those of the Parquet reader,
    whose 4,096 texts lie in the heap in one array for each task.
    """
    for setting, value in ((BATCH_SETTING, BATCH_BYTES), (READ_SETTING, READ_ROWS)):
        if spark.conf.get(setting, None) is None:
            spark.conf.set(setting, value)


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own: on a cluster a
    machine-local folder would be lost with its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="siltworks-")
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared checkpoint folder that nothing has used yet."""
    return f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    This fixes values that a recomputation could change (row positions, for example), cuts
    the lineage, survives lost executors, and lets later steps read only the columns they need.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def task_slots(spark: SparkSession) -> int:
    """How many slices a full shuffle is cut into before adaptive execution merges small ones."""
    first = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return int(first or spark.conf.get("spark.sql.shuffle.partitions"))
