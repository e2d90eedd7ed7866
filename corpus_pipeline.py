"""The corpus pipeline: documents to shards, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of `docs`. Stages that drop rows judge each row by itself, told apart by
its place in the files, so rows that share a doc_id or have none can fare differently. Empty input gives empty output.
"""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom.llm import kneser_ney, mixing, phrases, sharding, simhash
from jobloom.llm.common import ids_side, row_id, settle, table
from jobloom.llm.queries import SHARDS
from jobloom.session import cut, scratch_path

ID = "_row_id"


def _begin(spark: SparkSession) -> None:
    """Settings, and the end of what earlier stages left in the driver: plans, and the broadcasts and shuffle files that
    Spark keeps as long as a plan refers to them."""
    settle(spark)
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _numbered(docs: DataFrame) -> DataFrame:
    """docs with a number of its own for each row, the same at each reading of the files."""
    return docs.withColumn(ID, F.monotonically_increasing_id())


def _without(docs: DataFrame, bad: DataFrame) -> DataFrame:
    """docs without the rows whose id is in `bad` (ID). Texts are not shuffled while the ids are few."""
    return docs.join(ids_side(bad.select(ID).distinct()), ID, "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep what the classifier keeps; null and empty texts go."""
    _begin(spark)
    known = _numbered(docs)
    labels = table(spark, sf_dir, "labels").join(known.select("doc_id", ID), "doc_id").select(F.col(ID).alias("doc_id"), "quality", "toxic")
    judged = kneser_ney.classify(known, cut(labels, "labels"), id_col=ID)
    return _without(known, judged.where("not keep").withColumnRenamed("id", ID)).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of near copies: that of the smallest doc_id (nulls last), then by content."""
    _begin(spark)
    known = _numbered(docs)
    found = cut(simhash.near_duplicates(known, id_col=ID).select(F.col("id").alias(ID), "component_id"), "classes")
    rank = known.select(ID, F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64("text", "lang", "source"), F.col(ID)).alias("rank"))
    first = found.join(rank, ID).groupBy("component_id").agg(F.min_by(ID, "rank").alias(ID))
    return _without(known, found.join(first.select(ID), ID, "left_anti")).select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in which a window of a benchmark item occurs."""
    _begin(spark)
    known = _numbered(docs)
    found = phrases.contamination(known, table(spark, sf_dir, "benchmark"), id_col=ID)
    return _without(known, found.where("contaminated").select(F.col("doc_id").alias(ID))).select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix uses it, in the order of training. A last use in part counts as whole from half on."""
    _begin(spark)
    known = docs.withColumn(ID, row_id("doc_id", "text", "lang", "source"))
    plan = mixing.plan(known, id_col=ID)
    uses = plan.select("id", F.filter("uses", lambda u: 2 * u["take"] >= F.col("size")).alias("uses")).groupBy("id").agg(F.max("uses").alias("uses"))
    used = known.join(uses.withColumnRenamed("id", ID), ID).withColumn("_use", F.explode("uses"))
    return mixing.in_training_order(used.withColumn("_position", F.col("_use.position")), "_position", ID).select(docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs with their virtual slot and shard, by a map rebalanced for bytes."""
    _begin(spark)
    rows = sharding.slotted(docs)
    loads = cut(sharding.slot_loads(rows), "loads")
    root = scratch_path(spark, "slot-map")
    sharding.store_map(sharding.first_map(spark, SHARDS), root)
    sharding.store_map(sharding.rebalance(sharding.load_map(spark, root, 0), loads, SHARDS), root)
    placed = sharding.assign(rows, sharding.load_map(spark, root, 1))
    return placed.select(*docs.columns, F.col("_slot").alias("virtual_slot"), F.col("_shard").alias("shard"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("sharding", shard),
]

#: No SQL: the stages train a model, follow links and fill shards step by step; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
