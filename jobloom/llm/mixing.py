"""Time-varying curriculum: sources mixed to target weights along training time.

Each source has a share of the mix and a schedule, its weight over training time from 0 to 1. The schedule is linear, so
its integral is a parabola with a closed inverse: the cumulative demand of a source says when its n-th word is wanted,
and inverting it gives each document's time. Documents are range-sorted by the position that the summed demand has then.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobloom.session import cut

#: Hash ranges per source; running sums go over the ranges first and then inside one range, so a hot source is split.
RANGES = 4096
WORD = "[^\\x20\\x09-\\x0D]+"


class Phase(NamedTuple):
    """Share weight of a source and its relative weight at the start and end of training."""

    weight: float
    start: float = 1.0
    end: float = 1.0


#: Shares 3, 1, 2; the first kind of source fades out, the third comes in.
CURRICULUM = (Phase(3, 1.5, 0.5), Phase(1), Phase(2, 0.5, 1.5))
SHARE = 1.5
MOST_PASSES = 2


def demand(phase: Phase, time: Column) -> Column:
    """Part of a source's words wanted until `time`: the integral of its schedule, 1 at the end."""
    a, d = phase.start, phase.end - phase.start
    return (F.lit(a) * time + F.lit(d / 2) * time * time) / F.lit(a + d / 2)


def time_of(phase: Phase, part: Column) -> Column:
    """Inverse of `demand`."""
    a, d = phase.start, phase.end - phase.start
    return part if d == 0 else (F.sqrt(F.lit(a * a) + F.lit(d * (2 * a + d)) * part) - F.lit(a)) / F.lit(d)


def word_count(text_col: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, phases: Sequence[Phase] = CURRICULUM, share: float = SHARE, passes: int = MOST_PASSES) -> DataFrame:
    """sizes (source, source_size) -> source, source_size, kind (number of the phase), target.

    Sources are ordered by code point, null last, and take the phases in turn. The mix holds `share` times all words,
    dealt by weight; a source stops at `passes` times its size and the rest is dealt again by weight until none is above.
    That ends at one level: sources in order of size per weight are full, and the others have level x weight each.
    One row per source; a source without words has target 0.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    weights = F.array(*[F.lit(float(p.weight)) for p in phases])
    kinds = sizes.withColumn("kind", (F.row_number().over(order) - 1) % len(phases))
    each = kinds.withColumns({"weight": F.element_at(weights, F.col("kind") + 1), "most": (F.col("source_size") * passes).cast("double")})
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    fill = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("source_size").over(every) * share
    left = F.coalesce(F.sum("most").over(fill), F.lit(0.0))
    weight_left = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(fill), F.lit(0.0))
    level = each.withColumn("_level", (total - left) / weight_left).withColumn("_open", F.col("_level") * F.col("weight") <= F.col("most"))
    water = F.min(F.when(F.col("_open"), F.struct((F.col("most") / F.col("weight")).alias("o"), F.col("_level").alias("level")))).over(every)["level"]
    target = F.least(F.col("most"), F.coalesce(water, F.lit(float("inf"))) * F.col("weight"))
    return level.select("source", "source_size", "kind", target.alias("target"))


def plan(docs: DataFrame, phases: Sequence[Phase] = CURRICULUM, share: float = SHARE, passes: int = MOST_PASSES, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per row of `docs`: id, source, size, source_size, target, taken (words), uses (pass, take, position).

    Within a source documents stand in the order of a hash of their id (null ids: of their text), pass after pass, until
    the target is reached; the document there is taken in part. `position` is the word of the whole mix at which a use
    begins. Texts that are null or wordless have size 0 and no uses; equal ids are ordered by size. No rows: no rows.
    """
    place = F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.col(text_col)), F.lit("mix"))
    sized = cut(
        docs.select(F.col(id_col).cast("long").alias("id"), F.col(source_col).alias("source"), word_count(text_col).alias("size"), place.alias("h")), "sizes"
    ).withColumn("range", F.pmod(F.col("h"), F.lit(RANGES)))
    ranges = sized.groupBy("source", "range").agg(F.sum("size").alias("words"))
    targets = source_targets(ranges.groupBy("source").agg(F.sum("words").alias("source_size")), phases, share, passes)
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    bases = ranges.withColumn("base", F.coalesce(F.sum("words").over(before), F.lit(0))).alias("b")
    known = bases.join(targets.alias("t"), F.col("b.source").eqNullSafe(F.col("t.source"))).select(
        F.col("b.source").alias("_source"), F.col("range").alias("_range"), "base", "source_size", "target", "kind"
    )
    inside = Window.partitionBy("source", "range").orderBy("h", F.col("id"), "size").rowsBetween(Window.unboundedPreceding, -1)
    begun = sized.withColumn("_before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = begun.join(known, F.col("source").eqNullSafe(F.col("_source")) & (F.col("range") == F.col("_range"))).withColumn("_begin", F.col("base") + F.col("_before"))
    totals = targets.groupBy("kind").agg(F.sum("target").alias("target")).collect()  # one row per phase
    of_kind = {r["kind"]: float(r["target"]) for r in totals}
    wanted = F.round("target").cast("long")

    def use(number: Column) -> Column:
        at = number * F.col("source_size") + F.col("_begin")
        part = F.when(F.col("target") > 0, F.least(at / F.col("target"), F.lit(1.0))).otherwise(0.0)
        time = F.coalesce(*[F.when(F.col("kind") == k, time_of(p, part)) for k, p in enumerate(phases)])
        position = sum((F.lit(of_kind.get(k, 0.0)) * demand(p, time) for k, p in enumerate(phases)), F.lit(0.0))
        take = F.greatest(F.least(wanted - at, F.col("size")), F.lit(0)).cast("long")
        return F.struct(number.cast("int").alias("pass"), take.alias("take"), position.alias("position"))

    uses = F.filter(F.array(*[use(F.lit(i)) for i in range(passes)]), lambda u: u["take"] > 0)
    taken = F.aggregate("uses", F.lit(0).cast("long"), lambda s, u: s + u["take"])
    return joined.withColumn("uses", uses).select("id", "source", "size", "source_size", "target", taken.alias("taken"), "uses")


def in_training_order(rows: DataFrame, position: str, tie: str) -> DataFrame:
    """Rows range-sorted by position, those without one last; `tie` also spreads rows of equal or no position over ranges."""
    order = [F.col(position).asc_nulls_last(), F.col(tie)]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)
