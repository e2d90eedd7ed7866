"""Raw posting scan, seed load and upsert."""

from __future__ import annotations

import csv
import io
from functools import reduce
from importlib.resources import files

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobloom import schemas
from jobloom.operators.positions import dense_key

SEEDS = {"skill_terms": schemas.SKILL_TERMS, "regions": schemas.REGIONS}


def read_raw(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Scan of landed raw postings; files are best partitioned by source."""
    return spark.read.schema(schemas.RAW).format(fmt).load(path)


_UNREAD = "_unread"
#: Columns that a raw posting cannot be without.
REQUIRED = ("source", "source_id", "scraped_at", "raw_data")


def read_raw_json(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(raw postings, rows kept aside) of landed JSON lines: none is lost.

    Aside are lines that are no JSON or whose values do not fit the schema ("unreadable"), with their text as `record`, and
    rows without a required column ("incomplete"). Fields that the schema does not know are passed over.
    """
    schema = T.StructType([*schemas.RAW.fields, T.StructField(_UNREAD, T.StringType())])
    lines = spark.read.text(path).where(F.trim("value") != "")
    # Not the JSON reader: it tests filters before it knows that a line is bad, and then loses it. The generator keeps Spark
    # from parsing a line once for the filter and once more for the row.
    parsed = F.from_json("value", schema, {"columnNameOfCorruptRecord": _UNREAD})
    rows = lines.select("value", F.inline_outer(F.array(parsed)))
    lacking = reduce(Column.__or__, [F.col(c).isNull() for c in REQUIRED])
    nothing = reduce(Column.__and__, [F.col(c).isNull() for c in schemas.RAW.names])
    reason = F.when(F.col(_UNREAD).isNotNull() | nothing, "unreadable").when(lacking, "incomplete")
    judged = rows.withColumn("reason", reason)
    return judged.where("reason is null").select(*schemas.RAW.names), judged.where("reason is not null").select("reason", F.col("value").alias("record"))


def read_seed(spark: SparkSession, name: str, path: str | None = None) -> DataFrame:
    """A seed table: the packaged one, or a CSV in shared storage.

    The packaged file is read on the driver into a local relation, so executors need no copy of it and
    Catalyst knows its exact size. Patterns hold backslashes, hence no escape character in the CSV scan.
    """
    schema = SEEDS[name]
    if path is not None:
        reader = spark.read.schema(schema).option("header", True).option("comment", "#")
        return reader.option("escape", "\u0000").csv(path)
    text = files("jobloom").joinpath("seeds", f"{name}.csv").read_text(encoding="utf-8")
    rows = list(csv.DictReader(io.StringIO(text.split("\n", 1)[1])))
    columns = {
        field.name: [
            (row[field.name] == "true") if field.dataType.typeName() == "boolean" else row[field.name] for row in rows
        ]
        for field in schema.fields
    }
    return spark.createDataFrame(pa.table(columns), schema=schema)


def latest_per_key(batch: DataFrame, order: str) -> DataFrame:
    """Last write per (source, source_id) by `order`; partial aggregation shrinks hot keys before the shuffle."""
    return batch.groupBy("source", "source_id").agg(
        F.max_by(F.struct("scraped_at", "raw_data"), F.col(order)).alias("latest"),
        F.min(order).alias("first_order"),
    )


def upsert_raw(current: DataFrame, batch: DataFrame, order: str = "seq") -> DataFrame:
    """Insert or overwrite raw_data and scraped_at on (source, source_id); known keys keep their id.

    batch: source, source_id, scraped_at, raw_data and `order`, the position of the write in the batch.
    New keys get ids after the present maximum, in order of their first write.
    """
    incoming = latest_per_key(batch, order)
    known = current.select("source", "source_id", "raw_id", "scraped_at", "raw_data")
    kept = known.join(incoming.select("source", "source_id", "latest"), ["source", "source_id"], "left").select(
        "raw_id",
        "source",
        "source_id",
        F.coalesce(F.col("latest.scraped_at"), F.col("scraped_at")).alias("scraped_at"),
        F.when(F.col("latest").isNotNull(), F.col("latest.raw_data")).otherwise(F.col("raw_data")).alias("raw_data"),
    )
    fresh = incoming.join(known.select("source", "source_id"), ["source", "source_id"], "left_anti")
    # Payloads stay out of the sort: the numbers meet them where the aggregation has put them.
    key = [F.col("source").alias("_source"), F.col("source_id").alias("_source_id"), "first_order"]
    places = dense_key(fresh.select(*key), ["first_order", "_source", "_source_id"], "offset_id").drop("first_order")
    numbered = fresh.join(places, F.expr("source <=> _source and source_id <=> _source_id"))
    top = current.agg(F.coalesce(F.max("raw_id"), F.lit(0))).scalar()
    added = numbered.select(
        (top + F.col("offset_id")).alias("raw_id"),
        "source",
        "source_id",
        F.col("latest.scraped_at").alias("scraped_at"),
        F.col("latest.raw_data").alias("raw_data"),
    )
    return kept.unionByName(added)
