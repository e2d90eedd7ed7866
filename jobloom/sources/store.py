"""A stored table of raw postings that is upserted by (source, source_id).

Keys are dealt into buckets by hash. A version of the table (see `versions`) names for each bucket the runs of files that
make it up, oldest first. There are two ways to write, and both may be used on one table:

* `upsert` copies on write: the buckets that hold a changed key are written anew, as one run each; the others keep their
  files. Reads need no merge. For batches that arrive now and then.
* `append` adds the batch as a run of level 0 and touches nothing older. A bucket with `fanout` runs of a level merges them
  into one of the next, so a row is rewritten once per level, and reads merge few runs. For streams.

A batch that is repeated, because its writer died or a stream starts again, changes nothing. One writer at a time; a second
one ends in VersionTaken and can try again.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobloom.operators.positions import dense_key
from jobloom.schemas import RAW
from jobloom.session import cut
from jobloom.sources import versions
from jobloom.sources.raw import latest_per_key

KEY = ("source", "source_id")
#: `written` is the version that wrote the content of a row.
STORED = T.StructType([*RAW.fields, T.StructField("written", T.LongType())])
BUCKETS = 64
FANOUT = 4


@dataclass(frozen=True)
class Table:
    """A version: runs[bucket] = [[folder, level], ...], oldest first; applied[stream] = its last batch."""

    version: int
    buckets: int
    next_id: int = 1
    merges: int = 0
    applied: dict[str, int] = field(default_factory=dict)
    runs: dict[str, list[list]] = field(default_factory=dict)

    def folders(self, buckets: Iterable[int] | None = None) -> list[str]:
        chosen = self.runs if buckets is None else map(str, buckets)
        return [folder for b in chosen for folder, _ in self.runs.get(b, [])]


def _commit(spark: SparkSession, root: str, table: Table) -> Table:
    content = asdict(table)
    versions.commit(spark, root, content.pop("version"), content)
    return table


def create(spark: SparkSession, root: str, buckets: int = BUCKETS) -> Table:
    """An empty table. Choose `buckets` so that one holds some hundreds of megabytes in the end."""
    return _commit(spark, root, Table(0, buckets))


def open_table(spark: SparkSession, root: str, version: int | None = None) -> Table:
    found = versions.load(spark, root, version)
    if found is None:
        raise FileNotFoundError(f"no table at {root}")
    return Table(found[0], **found[1])


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(*KEY), F.lit(buckets)).cast("int")


def _same_key(a: DataFrame, b: DataFrame) -> Column:
    return a["source"].eqNullSafe(b["source"]) & a["source_id"].eqNullSafe(b["source_id"])


def _resolved(rows: DataFrame) -> DataFrame:
    """One row per key: content of its newest write, id of its first."""
    latest = F.max_by(F.struct("scraped_at", "raw_data", "written"), F.col("written")).alias("latest")
    return rows.groupBy(*KEY).agg(F.min("raw_id").alias("raw_id"), latest).select("raw_id", *KEY, "latest.*")


def _scan(spark: SparkSession, root: str, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], STORED)
    return spark.read.schema(STORED).parquet(*[f"{root}/{f}" for f in folders])


def _rows(spark: SparkSession, root: str, table: Table, buckets: Iterable[int] | None = None) -> DataFrame:
    """Resolved rows; buckets of a single run are read as they are, without a shuffle."""
    chosen = list(table.runs) if buckets is None else [str(b) for b in buckets if str(b) in table.runs]
    single = [b for b in chosen if len(table.runs[b]) == 1]
    several = [b for b in chosen if len(table.runs[b]) > 1]
    parts = [_scan(spark, root, table.folders(single))] if single or not several else []
    parts += [_resolved(_scan(spark, root, table.folders(several)))] if several else []
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def read(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The table as of its newest or a given version. Later writes do not disturb what was opened."""
    return _rows(spark, root, open_table(spark, root, version)).select(*RAW.names)


def read_keys(spark: SparkSession, root: str, keys: Iterable[tuple[str, str]]) -> DataFrame:
    """The rows of some keys, read from their buckets only."""
    table = open_table(spark, root)
    asked = spark.createDataFrame(list(keys), "source string, source_id string")
    buckets = [r[0] for r in asked.select(_bucket(table.buckets)).distinct().collect()]
    return _rows(spark, root, table, buckets).join(F.broadcast(asked.distinct()), list(KEY), "left_semi").select(*RAW.names)


def _write(rows: DataFrame, root: str, buckets: int) -> str:
    """Write rows by bucket into a new folder and give its name. One bucket is one task's file."""
    folder = versions.new_folder(root)
    dealt = rows.withColumn("bucket", _bucket(buckets))
    dealt.repartition("bucket").write.partitionBy("bucket").parquet(f"{root}/{folder}")
    return folder


def _seen(table: Table, stream: str | None, number: int | None) -> bool:
    return stream is not None and number is not None and table.applied.get(stream, -1) >= number


def _applied(table: Table, stream: str | None, number: int | None) -> dict[str, int]:
    return table.applied if stream is None or number is None else {**table.applied, stream: number}


def upsert(spark: SparkSession, root: str, batch: DataFrame, order: str = "seq", stream: str | None = None, number: int | None = None) -> Table:
    """Insert or overwrite scraped_at and raw_data by key; known keys keep their ids.

    batch: source, source_id, scraped_at, raw_data and `order`, the place of a write in the batch; the last write of a key
    counts. New keys get ids after all present ones, in the order of their first write. Buckets without a changed row keep
    their files; a batch that changes nothing makes no version. `stream` and `number` mark batches, so that one that was
    applied is passed over unread. Nulls in a key are a value like any other.
    """
    table = open_table(spark, root)
    if _seen(table, stream, number):
        return table
    incoming = cut(latest_per_key(batch, order).withColumn("bucket", _bucket(table.buckets)), "incoming")
    hit = [r[0] for r in incoming.select("bucket").distinct().collect()]  # at most one per bucket
    current = _rows(spark, root, table, hit)
    known = current.select(*KEY, "raw_id", "scraped_at", "raw_data")
    differs = ~(F.col("latest.scraped_at").eqNullSafe(known["scraped_at"]) & F.col("latest.raw_data").eqNullSafe(known["raw_data"]))
    compared = incoming.join(known, _same_key(incoming, known), "left").select(
        incoming["source"], incoming["source_id"], "bucket", "first_order", "raw_id", (F.col("raw_id").isNull() | differs).alias("changed")
    )
    changed = cut(compared.where("changed"), "changed")  # keys only: texts stay where they are
    touched = [r[0] for r in changed.select("bucket").distinct().collect()]
    if not touched:
        if _applied(table, stream, number) == table.applied:
            return table
        return _commit(spark, root, replace(table, version=table.version + 1, applied=_applied(table, stream, number)))

    fresh = dense_key(changed.where("raw_id is null").select(*KEY, "first_order"), ["first_order", *KEY], "place")
    new_ids = fresh.select(*KEY, (F.lit(table.next_id - 1) + F.col("place")).alias("raw_id"))
    ids = changed.where("raw_id is not null").select(*KEY, "raw_id").unionByName(new_ids)
    written = incoming.join(ids, _same_key(incoming, ids)).select(
        "raw_id", incoming["source"], incoming["source_id"], "latest.scraped_at", "latest.raw_data", F.lit(table.version + 1).cast("long").alias("written")
    )
    before = _rows(spark, root, table, touched)
    kept = before.join(changed.select(*KEY), _same_key(before, changed), "left_anti")
    folder = _write(kept.unionByName(written), root, table.buckets)
    runs = {**table.runs, **{str(b): [[f"{folder}/bucket={b}", 0]] for b in touched}}
    added = changed.where("raw_id is null").count()
    return _commit(spark, root, replace(table, version=table.version + 1, next_id=table.next_id + added, applied=_applied(table, stream, number), runs=runs))


def append(spark: SparkSession, root: str, batch: DataFrame, order: str = "seq", stream: str | None = None, number: int | None = None, fanout: int = FANOUT) -> Table:
    """Add a batch without reading what is stored; the result of a read is that of `upsert`.

    Every key of the batch takes an id, and a key that is known already keeps its older, smaller one, so ids have gaps.
    """
    table = open_table(spark, root)
    if _seen(table, stream, number):
        return table
    incoming = cut(latest_per_key(batch, order).withColumn("bucket", _bucket(table.buckets)), "incoming")
    buckets = {r["bucket"]: r["n"] for r in incoming.groupBy("bucket").agg(F.count("*").alias("n")).collect()}
    if buckets:
        places = dense_key(incoming.select(*KEY, "first_order"), ["first_order", *KEY], "place")
        rows = incoming.join(places, _same_key(incoming, places)).select(
            (F.lit(table.next_id - 1) + F.col("place")).alias("raw_id"), incoming["source"], incoming["source_id"],
            "latest.scraped_at", "latest.raw_data", F.lit(table.version + 1).cast("long").alias("written"),
        )
        folder = _write(rows, root, table.buckets)
        runs = dict(table.runs)
        for b in buckets:
            runs[str(b)] = [*runs.get(str(b), []), [f"{folder}/bucket={b}", 0]]
    else:
        runs = table.runs
    added = replace(table, version=table.version + 1, next_id=table.next_id + sum(buckets.values()), applied=_applied(table, stream, number), runs=runs)
    return merge(spark, root, _commit(spark, root, added), fanout)


def merge(spark: SparkSession, root: str, table: Table | None = None, fanout: int = FANOUT) -> Table:
    """Merge, level by level, the runs of buckets that have `fanout` of them; all such buckets of a level in one job."""
    if fanout < 2:
        raise ValueError("fewer than two runs cannot be merged")
    table = table or open_table(spark, root)
    level = 0
    while level <= max((lv for runs in table.runs.values() for _, lv in runs), default=-1):
        full = [b for b, runs in table.runs.items() if sum(lv == level for _, lv in runs) >= fanout]
        if full:
            old = {b: [f for f, lv in table.runs[b] if lv == level] for b in full}
            folder = _write(_resolved(_scan(spark, root, [f for b in full for f in old[b]])), root, table.buckets)
            runs = dict(table.runs)
            for b in full:  # runs of a level are neighbours: older ones are of higher levels, newer ones of lower
                older, newer = [r for r in runs[b] if r[1] > level], [r for r in runs[b] if r[1] < level]
                runs[b] = [*older, [f"{folder}/bucket={b}", level + 1], *newer]
            table = _commit(spark, root, replace(table, version=table.version + 1, merges=table.merges + 1, runs=runs))
        level += 1
    return table


def expire(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete all but the newest `keep` versions and the data that none of them names; gives the number of folders deleted.
    Readers of older versions lose their files, and so does a write that is under way: run it alone."""
    known = sorted(versions.numbers(spark, root))
    kept = known[-max(keep, 1) :]
    used = {f.split("/")[1] for n in kept for f in open_table(spark, root, n).folders()}
    for n in known[: -len(kept)]:
        versions.delete(spark, f"{root}/{versions.FOLDER}/v{n:012d}.json")
    unused = [f for f in versions.children(spark, f"{root}/data") if f not in used]
    for f in unused:
        versions.delete(spark, f"{root}/data/{f}")
    return len(unused)
