"""Shards by fixed virtual slots and a versioned slot-to-shard map.

Records are hashed into a fixed number of slots, bytes are summed per slot, and a map gives each slot's shard. Only the
map is edited when shards are rebalanced or added; its versions are stored side by side. All DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SLOTS = 4096


def slotted(docs: DataFrame, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with _slot and _size (UTF-8 bytes of the text, null: none, plus 1). Rows without an id are dealt by their text."""
    key = F.coalesce(F.xxhash64(F.when(F.col(id_col).isNotNull(), F.col(id_col)), F.when(F.col(id_col).isNull(), F.col(text_col))), F.lit(0))
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + 1
    return docs.withColumns({"_slot": F.pmod(key, F.lit(slots)).cast("int"), "_size": size})


def slot_loads(rows: DataFrame) -> DataFrame:
    """(slot, bytes, n) of the slots that hold rows."""
    return rows.groupBy(F.col("_slot").alias("slot")).agg(F.sum("_size").alias("bytes"), F.count("*").alias("n"))


def first_map(spark: SparkSession, shards: int, slots: int = SLOTS) -> DataFrame:
    """Version 0: slots dealt round robin."""
    return spark.range(slots).select(F.lit(0).alias("version"), F.col("id").cast("int").alias("slot"), F.pmod("id", F.lit(shards)).cast("int").alias("shard"))


def _loaded(slot_map: DataFrame, loads: DataFrame) -> DataFrame:
    return slot_map.join(loads, "slot", "left").withColumns({"bytes": F.coalesce("bytes", F.lit(0)), "n": F.coalesce("n", F.lit(0))})


def _lightest_first(freed: DataFrame, kept: DataFrame, shards: int) -> DataFrame:
    """(slot, to): freed slots, largest first, each given to the shard that is lightest then. Bounded by the slots."""
    shard_row = kept.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard"))
    sums = shard_row.join(kept.groupBy("shard").agg(F.sum("bytes").alias("bytes")), "shard", "left").agg(
        F.array_sort(F.collect_list(F.struct("shard", F.coalesce("bytes", F.lit(0)).alias("bytes")))).alias("s")
    )
    order = freed.agg(F.array_sort(F.collect_list(F.struct((-F.col("bytes")).alias("less"), "slot"))).alias("f"))
    row = sums.select(F.transform("s", lambda x: x["bytes"]).alias("loads"), F.lit(1).alias("k")).join(order.withColumn("k", F.lit(1)), "k")
    state = F.struct(F.col("loads").alias("loads"), F.array().cast("array<struct<slot:int,to:int>>").alias("given"))

    def give(acc: Column, x: Column) -> Column:
        to = F.array_position(acc["loads"], F.array_min(acc["loads"])).cast("int") - 1
        loads = F.transform(acc["loads"], lambda v, i: F.when(i == to, v - x["less"]).otherwise(v))
        return F.struct(loads.alias("loads"), F.concat(acc["given"], F.array(F.struct(x["slot"].alias("slot"), to.alias("to")))).alias("given"))

    return row.select(F.inline(F.aggregate("f", state, give)["given"]))


def _edited(slot_map: DataFrame, given: DataFrame) -> DataFrame:
    moved = slot_map.join(given, "slot", "left")
    return moved.select((F.col("version") + 1).alias("version"), "slot", F.coalesce("to", "shard").alias("shard"))


def rebalance(slot_map: DataFrame, loads: DataFrame, shards: int) -> DataFrame:
    """The next version of the map. Each shard keeps its largest slots up to the mean and gives up the rest; these go to
    the lightest shards, largest first. Sizes end within one slot of each other where that slot is small."""
    full = _loaded(slot_map, loads)
    mean = full.agg((F.sum("bytes") / shards).alias("mean"))
    down = Window.partitionBy("shard").orderBy(F.col("bytes").desc(), "slot").rowsBetween(Window.unboundedPreceding, 0)
    marked = full.withColumn("sum", F.sum("bytes").over(down)).join(F.broadcast(mean)).withColumn("stays", F.col("sum") <= F.col("mean"))
    return _edited(slot_map, _lightest_first(marked.where("not stays"), marked.where("stays"), shards))


def add_shard(slot_map: DataFrame, loads: DataFrame, shards: int) -> DataFrame:
    """The next version with one more shard, number `shards`: every other shard gives up its smallest slots, up to its
    share of the new shard's bytes; no slot moves between old shards."""
    full = _loaded(slot_map, loads)
    up = Window.partitionBy("shard").orderBy("bytes", "slot").rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("bytes").over(Window.partitionBy("shard"))
    moved = full.withColumns({"sum": F.sum("bytes").over(up), "total": total}).where(F.col("sum") <= F.col("total") / (shards + 1))
    return _edited(slot_map, moved.select("slot", F.lit(shards).alias("to")))


def store_map(slot_map: DataFrame, root: str) -> None:
    """Add a version to those stored under `root`; versions are folders, an old one is never rewritten."""
    slot_map.write.mode("append").partitionBy("version").parquet(root)


def load_map(spark: SparkSession, root: str, version: int) -> DataFrame:
    return spark.read.schema("version int, slot int, shard int").parquet(root).where(F.col("version") == version)


def assign(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Rows of `slotted` with their _shard. The map has one row per slot, a fixed number, so rows are not shuffled."""
    return rows.join(F.broadcast(slot_map.select(F.col("slot").alias("_slot"), F.col("shard").alias("_shard"))), "_slot")


def places(rows: DataFrame, slot_map: DataFrame, loads: DataFrame, order: list[str]) -> DataFrame:
    """Rows of `assign` with _place, gapless from 0 in each shard: slots one after the other, rows of a slot by `order`."""
    before = Window.partitionBy("shard").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    base = _loaded(slot_map, loads).select(F.col("slot").alias("_slot"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    inside = F.row_number().over(Window.partitionBy("_slot").orderBy(*order))
    return rows.withColumn("_in", inside).join(F.broadcast(base), "_slot").withColumn("_place", F.col("_base") + F.col("_in") - 1)
