"""Upsert of landed files, micro-batch by micro-batch.

Each micro-batch is reduced to its last write per key and written to its own folder, named by the batch number, so a
repeated batch replaces itself. Reading resolves the batches to one row per key; `compact` folds them into one. No
batch rewrites rows of earlier ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from jobloom.operators.positions import dense_key
from jobloom.schemas import RAW
from jobloom.sources import store
from jobloom.sources.raw import latest_per_key

STORED = T.StructType([*RAW.fields, T.StructField("batch", T.LongType())])
KEY = ("source", "source_id")
# Ids of one batch start at its number times this, so a key's first id is its smallest.
ID_STEP = 1 << 40


def write_batch(batch: DataFrame, target: str, number: int, order: str = "seq") -> None:
    """Land one batch; overwriting its own folder makes a retry harmless."""
    latest = dense_key(latest_per_key(batch, order), ["first_order", *KEY], "place")
    rows = latest.select(
        (F.lit(number * ID_STEP) + F.col("place")).alias("raw_id"), *KEY, "latest.scraped_at", "latest.raw_data"
    )
    rows.write.mode("overwrite").parquet(f"{target}/batch={number}")


def read_batches(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.schema(STORED).parquet(target)


def current_raw(spark: SparkSession, target: str) -> DataFrame:
    """One row per key: content of its newest batch, id of its first. Both are partially aggregated."""
    resolved = read_batches(spark, target).groupBy(*KEY).agg(
        F.min("raw_id").alias("raw_id"),
        F.max_by(F.struct("scraped_at", "raw_data"), F.col("batch")).alias("latest"),
    )
    return resolved.select("raw_id", *KEY, "latest.scraped_at", "latest.raw_data")


def compact(spark: SparkSession, target: str, new_target: str, number: int) -> None:
    """Fold all batches up to `number` into one folder of a new target; ids stay."""
    current_raw(spark, target).write.mode("overwrite").parquet(f"{new_target}/batch={number}")


def upsert_stream(source: DataFrame, target: str, checkpoint: str, order: str = "seq") -> StreamingQuery:
    """Run the stream over everything that has landed, then stop."""
    return (
        source.writeStream.foreachBatch(lambda batch, number: write_batch(batch, target, number, order))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def upsert_stream_batches(source: DataFrame, root: str, checkpoint: str, stream: str = "ingest", order: str = "seq", fanout: int = store.FANOUT) -> StreamingQuery:
    """Run the stream into a stored table (made by `store.create`): each micro-batch is one `store.append`, with the merges
    it sets off. The batch number is kept in the table, so a micro-batch that is repeated after a failure adds nothing."""

    def add(batch: DataFrame, number: int) -> None:
        store.append(batch.sparkSession, root, batch, order, stream, number, fanout)

    return source.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
