"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom.session import prepare

# Rows and bytes of one Arrow batch, so that a Python worker never holds more text than this at once (one row may be larger).
BATCH_ROWS = 1000
BATCH_BYTES = 16 * 1024 * 1024


def settle(spark: SparkSession) -> SparkSession:
    """The session settings the operators rely on."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_batches(df: DataFrame, per_batch: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """mapInArrow with a function of one batch; batches without rows are passed over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = per_batch(batch)
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def row_id(id_col: str, *others: str) -> Column:
    """`id_col`, or for a null a negative number made of the other columns, so that rows without an id stay apart."""
    return F.coalesce(F.col(id_col), -F.lit(1) - F.abs(F.xxhash64(*others).bitwiseAND(F.lit((1 << 62) - 1))))


#: Ids are broadcast up to this many (16 bytes each); beyond it the same join is a shuffle.
BROADCAST_IDS = 2_000_000


def ids_side(ids: DataFrame) -> DataFrame:
    """The distinct-id side of a semi or anti join, broadcast if its size has been counted to be small."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
