from datetime import datetime

from pyspark.sql import functions as F

from jobloom.session import scratch_path
from jobloom.sources.raw import upsert_raw
from jobloom.streaming import ingest

SCHEMA = "source string, source_id string, scraped_at timestamp, raw_data string, seq long"


def day(n):
    """Day n re-scrapes keys 0..n and one key many times."""
    at = datetime(2026, 5, 1 + n)
    return [("s", f"k{i}", at, f"{n}:{i}", 100 * n + i) for i in range(n + 1)] + [("s", "hot", at, f"{n}:hot{j}", 100 * n + 50 + j) for j in range(20)]


def run(spark, landed, target, checkpoint):
    source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{landed}/*")
    ingest.upsert_stream(source, target, checkpoint).awaitTermination()


def test_stream_equals_batch_and_keeps_ids(spark, rows):
    landed, target, checkpoint = (scratch_path(spark, n) for n in ("landed", "target", "check"))
    for n in range(3):
        spark.createDataFrame(day(n), SCHEMA).coalesce(1).write.parquet(f"{landed}/day={n}")
    run(spark, landed, target, checkpoint)
    before = {r.source_id: r.raw_id for r in ingest.current_raw(spark, target).collect()}

    spark.createDataFrame(day(3), SCHEMA).coalesce(1).write.parquet(f"{landed}/day=3")
    run(spark, landed, target, checkpoint)
    run(spark, landed, target, checkpoint)  # nothing new
    after = ingest.current_raw(spark, target)
    ids = {r.source_id: r.raw_id for r in after.collect()}
    assert {k: ids[k] for k in before} == before and len(set(ids.values())) == len(ids) == 5

    batch = spark.createDataFrame([r for n in range(4) for r in day(n)], SCHEMA)
    empty = batch.select(F.lit(0).cast("long").alias("raw_id"), "source", "source_id", "scraped_at", "raw_data").limit(0)
    content = ["source", "source_id", "scraped_at", "raw_data"]
    assert rows(after.select(*content)) == rows(upsert_raw(empty, batch).select(*content))

    folded = scratch_path(spark, "folded")
    ingest.compact(spark, target, folded, 9)
    assert rows(ingest.current_raw(spark, folded)) == rows(after)


def test_repeated_batch_replaces_itself(spark, rows):
    target = scratch_path(spark, "target")
    batch = spark.createDataFrame(day(2), SCHEMA)
    ingest.write_batch(batch, target, 0)
    once = rows(ingest.current_raw(spark, target))
    ingest.write_batch(batch, target, 0)
    assert rows(ingest.current_raw(spark, target)) == once
