"""Session settings and the one helper that cuts lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the bench; clusters bring their own session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("jobloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("JOBLOOM_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def prepare(spark: SparkSession) -> SparkSession:
    """Settings every plan relies on: UTC days and runtime re-planning with skew splitting."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


#: Tasks for each core that `balance` asks for.
TASKS_PER_CORE = 4


def balance(spark: SparkSession) -> SparkSession:
    """Several tasks for each core, where Spark would plan about one and the last core's second task would double the time.

    Both numbers are least ones: large inputs get more tasks, small shuffles fewer. What a session has set itself stays.
    """
    tasks = str(TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    for key in ("spark.sql.files.minPartitionNum", "spark.sql.adaptive.coalescePartitions.minPartitionNum"):
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, tasks)
    return spark


@contextmanager
def settings(spark: SparkSession, wanted: Mapping[str, str]) -> Iterator[None]:
    """SQL settings for what is run inside, put back afterwards."""
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by spark.checkpoint.dir.

    A machine-local folder is only made up for a local master.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    made = tempfile.mkdtemp(prefix="jobloom-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/jobloom/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Used where several consumers read one result, or where values that depend on the physical layout
    (partition number, position) must stay fixed. The written files survive the loss of executors.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimised plan."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
