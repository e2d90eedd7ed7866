"""Materialising views, inline relations and tables; snapshot append; run log."""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobloom import schemas
from jobloom.session import cut
from jobloom.sources import versions

# Which folder each layer's tables live in, and how the layer is materialised.
LAYER_SCHEMAS = {"staging": "staging", "marts": "warehouse"}
LAYER_KINDS = {"staging": "view", "intermediate": "inline", "marts": "table"}
DEFAULT_SCHEMA = "dev"


def schema_of(layer: str) -> str:
    return LAYER_SCHEMAS.get(layer, DEFAULT_SCHEMA)


def table_path(root: str, layer: str, name: str) -> str:
    return f"{root.rstrip('/')}/{schema_of(layer)}/{name}"


def materialize(df: DataFrame, layer: str, name: str, root: str | None = None, partition_by: Sequence[str] = ()) -> DataFrame:
    """Full refresh of one relation: temp view, plain DataFrame, or a new version of a parquet table under `root`.

    A version is a folder of its own, which readers see once it is whole; those of older versions keep theirs. Rows are
    laid out by `partition_by`, columns of few values, so that filters on them pick folders.
    """
    kind = LAYER_KINDS.get(layer, "view")
    if kind == "inline":
        return df
    if kind == "view":
        df.createOrReplaceTempView(f"{schema_of(layer)}_{name}")
        return df
    if root is None:
        raise ValueError("a table layer needs a root folder")
    spark, path = df.sparkSession, table_path(root, layer, name)
    known = versions.load(spark, path)
    folder = versions.new_folder(path)
    (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(f"{path}/{folder}")
    versions.commit(spark, path, known[0] + 1 if known else 0, {"folder": folder, "schema": df.schema.jsonValue()})
    return read_table(spark, root, layer, name)


def read_table(spark: SparkSession, root: str, layer: str, name: str, version: int | None = None) -> DataFrame:
    """The newest or a given version of a table."""
    path = table_path(root, layer, name)
    found = versions.load(spark, path, version)
    if found is None:
        raise FileNotFoundError(f"no table at {path}")
    schema = T.StructType.fromJson(found[1]["schema"])
    return spark.read.schema(schema).parquet(f"{path}/{found[1]['folder']}").select(*schema.names)


def drop_old_versions(spark: SparkSession, root: str, layer: str, name: str, keep: int = 2) -> int:
    """Delete all versions but the newest `keep` with their files, and files of refreshes that broke off; gives the number of
    folders deleted. Readers of those versions lose their files: run it when they are done."""
    path = table_path(root, layer, name)
    known = sorted(versions.numbers(spark, path))
    kept = known[-max(keep, 1) :]
    used = {versions.load(spark, path, n)[1]["folder"].split("/")[1] for n in kept}
    for n in known[: -len(kept)]:
        versions.delete(spark, f"{path}/{versions.FOLDER}/v{n:012d}.json")
    unused = [f for f in versions.children(spark, f"{path}/data") if f not in used]
    for f in unused:
        versions.delete(spark, f"{path}/data/{f}")
    return len(unused)


#: Runs of one level that are merged into one of the next level.
RUNS = 16


def append_snapshot(demand: DataFrame, path: str, runs: int = RUNS) -> None:
    """Write the days of `demand` and leave all other days as they are.

    An append is a run of files of its own, which a new version names together with the days that it holds; a day that is
    written again is taken from the list of the run that had it, so a retried append adds nothing twice and no stored row
    is written anew. `runs` runs of a level are merged into one of the next, which keeps their number low. A day is spread
    over tasks by its rows' contents. Rows without a day are never replaced.
    """
    spark = demand.sparkSession
    found = versions.load(spark, path)
    number, known = (found[0] + 1, found[1]["runs"]) if found else (0, [])
    fresh = _write_run(demand, path, 0)
    days = set(fresh["days"])
    known = [{**r, "days": [d for d in r["days"] if d not in days], "gone": sorted({*r["gone"], *(days & set(r["days"]))})} for r in known]
    known = [r for r in known if r["days"] or r["dayless"]] + [fresh]
    level = 0
    while len(full := [r for r in known if r["level"] == level]) >= runs:
        known = [r for r in known if r["level"] != level] + [_write_run(_live(spark, path, full, demand.schema), path, level + 1)]
        level += 1
    versions.commit(spark, path, number, {"runs": known})


def _write_run(rows: DataFrame, path: str, level: int) -> dict:
    """A new run: sorted by day, so that readers of some days skip the others' parts of the files."""
    folder = versions.new_folder(path)
    spread = rows.repartitionByRange("snapshot_date", F.xxhash64(*rows.columns)).sortWithinPartitions("snapshot_date")
    spread.write.parquet(f"{path}/{folder}")
    stored = rows.sparkSession.read.schema(rows.schema).parquet(f"{path}/{folder}")
    days = [r[0] for r in stored.select("snapshot_date").distinct().collect()]  # one value per day
    return {"folder": folder, "level": level, "days": sorted(d.isoformat() for d in days if d), "gone": [], "dayless": None in days}


def _live(spark: SparkSession, path: str, runs: Sequence[dict], schema: T.StructType) -> DataFrame:
    """Rows of the runs, without the days that later runs have replaced. Untouched runs are one scan."""
    whole = [f"{path}/{r['folder']}" for r in runs if not r["gone"]]
    parts = [spark.read.schema(schema).parquet(*whole)] if whole else []
    for run in (r for r in runs if r["gone"]):
        gone = F.coalesce(F.col("snapshot_date").isin([datetime.date.fromisoformat(d) for d in run["gone"]]), F.lit(False))
        parts.append(spark.read.schema(schema).parquet(f"{path}/{run['folder']}").where(~gone))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def read_snapshots(spark: SparkSession, path: str, like: DataFrame, version: int | None = None) -> DataFrame:
    """All stored days, as of the newest or a given version; `like` gives the columns."""
    found = versions.load(spark, path, version)
    if found is None:
        raise FileNotFoundError(f"no snapshots at {path}")
    return _live(spark, path, found[1]["runs"], like.schema)


def drop_old_snapshots(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete all versions but the newest `keep`, and the runs that none of those names, with those of appends that broke
    off; gives the number of runs deleted. Run it when no append is under way and old versions have no readers."""
    known = sorted(versions.numbers(spark, path))
    kept = known[-max(keep, 1) :]
    used = {r["folder"].split("/")[1] for n in kept for r in versions.load(spark, path, n)[1]["runs"]}
    for n in known[: -len(kept)]:
        versions.delete(spark, f"{path}/{versions.FOLDER}/v{n:012d}.json")
    unused = [f for f in versions.children(spark, f"{path}/data") if f not in used]
    for f in unused:
        versions.delete(spark, f"{path}/data/{f}")
    return len(unused)


def run_log_rows(runs: DataFrame, error_length: int | None = None) -> DataFrame:
    """Shape run records like the log; error text is whole unless `error_length` says how much of it to store."""
    text = F.col("error_message") if error_length is None else F.substring("error_message", 1, error_length)
    shaped = runs.withColumn("error_message", text).withColumn("status", F.coalesce("status", F.lit("running")))
    shaped = shaped.withColumn("records_scraped", F.coalesce("records_scraped", F.lit(0)))
    return shaped.select(*[F.col(f.name).cast(f.dataType) for f in schemas.RUN_LOG.fields])


def append_run_log(runs: DataFrame, path: str, error_length: int | None = None) -> None:
    run_log_rows(runs, error_length).write.mode("append").parquet(path)


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.RUN_LOG).parquet(path)


def run_health(log: DataFrame) -> DataFrame:
    """Per source: last run and status, totals, failures and runs that brought nothing."""
    return log.groupBy("source").agg(
        F.count("*").alias("runs"),
        F.max("started_at").alias("last_started_at"),
        F.max_by("status", F.struct("started_at", "id")).alias("last_status"),
        F.sum("records_scraped").alias("records_total"),
        F.count_if(F.col("status") == "error").alias("failed_runs"),
        F.count_if(F.col("records_scraped") == 0).alias("empty_runs"),
    )
