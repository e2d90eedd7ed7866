"""Tool calls and their results in chats: linked by identifier, ordered by dependency, validated, written as JSON."""

from __future__ import annotations

import json
from collections.abc import Mapping
from math import isfinite

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobloom.llm.common import map_batches
from jobloom.operators.positions import rank_within
from jobloom.session import cut

_TYPES = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "array": list, "object": dict, "null": type(None)}


def problems(value: object, schema: Mapping, at: str = "$") -> list[str]:
    """What is wrong with `value` by a JSON schema of type, enum, minimum, maximum, maxLength, items, properties, required and
    additionalProperties; paths in order of the schema."""
    out = []
    kind = schema.get("type")
    if kind and not (isinstance(value, _TYPES[kind]) and not (isinstance(value, bool) and kind in ("integer", "number"))):
        return [f"{at}: not {kind}"]
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{at}: not in enum")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        out += [f"{at}: {word} {bound}" for word, bound, bad in (("below", schema.get("minimum"), lambda b: value < b), ("above", schema.get("maximum"), lambda b: value > b)) if bound is not None and bad(bound)]
    if isinstance(value, str) and len(value) > schema.get("maxLength", len(value)):
        out.append(f"{at}: longer than {schema['maxLength']}")
    if isinstance(value, list) and "items" in schema:
        out += [p for i, v in enumerate(value) for p in problems(v, schema["items"], f"{at}[{i}]")]
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
        out += [p for k, s in known.items() if k in value for p in problems(value[k], s, f"{at}.{k}")]
        if schema.get("additionalProperties", True) is False:
            out += [f"{at}.{k}: unknown" for k in sorted(value) if k not in known]
    return out


def canonical(value: object) -> str:
    """JSON with sorted keys and no white space; not-a-number and infinities raise ValueError."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def _no_constant(name: str):
    raise ValueError(name)


def _finite(text: str) -> float:
    number = float(text)
    if not isfinite(number):
        raise ValueError(text)
    return number


def parse(text: str | None) -> tuple[object, str | None]:
    """(value, None), or (text, error) for what is no JSON or could not be written again: numbers beyond a double, lone
    surrogates, nesting beyond the interpreter's depth."""
    try:
        value = json.loads(text or "", parse_constant=_no_constant, parse_float=_finite)
        canonical(value).encode()
    except (ValueError, RecursionError):
        return text, "$: not JSON"
    return value, None


_KEY = ["conv_id", "call_id"]


def _anchored(links: DataFrame) -> DataFrame:
    """(conv_id, call_id, at, steps) of calls with a single need, followed back to the first call that is none such.

    Pointers double: each round a call takes over what the call it points at points at, so a chain of n calls takes about
    log2(n) rounds. Those still moving when the steps exceed all links are on or behind a cycle; they point at a link.
    """
    moving, rounds = cut(links.select(*_KEY, F.col("need").alias("at"), F.lit(1).cast("long").alias("steps")), "links"), 0
    most = moving.count()
    while most >> rounds:
        ahead = moving.select("conv_id", F.col("call_id").alias("at"), F.col("at").alias("next"), F.col("steps").alias("more"))
        met = moving.join(ahead, ["conv_id", "at"], "left")
        moving = cut(met.select(*_KEY, F.coalesce("next", "at").alias("at"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"), F.col("next").isNotNull().alias("moved")), "links")
        still = moving.where("moved").limit(1).count()
        moving, rounds = moving.drop("moved"), rounds + 1
        if not still:
            break
    return moving


def levels(calls: DataFrame, needs: DataFrame) -> DataFrame:
    """(conv_id, call_id, level): 0 without needs, else one above the highest need. Calls on or behind a cycle are left out.

    Calls with a single need follow their chain back to where it starts, by doubling pointers. What is left, calls with
    several needs, is peeled off round by round: a round places those whose needs all start at placed calls. So rounds
    are as many as the longest succession of calls with several needs, plus the logarithm of the longest chain. Each round
    is written to the shared folder.
    """
    distinct = cut(needs.distinct(), "needs")
    sized = distinct.groupBy(*_KEY).agg(F.count("*").alias("_n"), F.min("need").alias("need"))
    chained = _anchored(sized.where("_n = 1"))
    start = chained.select("conv_id", F.col("call_id").alias("need"), "at", "steps")
    joins = distinct.join(sized.where("_n > 1").select(*_KEY), _KEY, "left_semi").join(start, ["conv_id", "need"], "left")
    left = cut(joins.select(*_KEY, F.coalesce("at", "need").alias("at"), (F.coalesce("steps", F.lit(0)) + 1).alias("steps"), F.lit(None).cast("long").alias("level")), "joins")
    placed = cut(calls.join(sized, _KEY, "left_anti").select(*_KEY, F.lit(0).cast("long").alias("level")), "level")
    out = placed
    while left.limit(1).count():
        new = placed.select("conv_id", F.col("call_id").alias("at"), F.col("level").alias("_level"))
        left = cut(left.join(new, ["conv_id", "at"], "left").select(*_KEY, "at", "steps", F.coalesce("level", F.col("_level") + F.col("steps")).alias("level")), "joins")
        placed = cut(left.groupBy(*_KEY).agg(F.max("level").alias("level"), F.count("level").alias("_met"), F.count("*").alias("_all")).where("_met = _all").select(*_KEY, "level"), "level")
        if not placed.limit(1).count():
            break
        out, left = out.unionByName(placed), left.join(placed.select(*_KEY), _KEY, "left_anti")
    ends = out.select("conv_id", F.col("call_id").alias("at"), "level")
    return out.unionByName(chained.join(ends, ["conv_id", "at"]).select(*_KEY, (F.col("level") + F.col("steps")).alias("level"))).withColumn("level", F.col("level").cast("int"))


def link(calls: DataFrame, results: DataFrame, schemas: Mapping[str, Mapping]) -> DataFrame:
    """One row per call, and one per result without a call.

    calls (conv_id, turn, call_id, name, arguments, needs array), results (conv_id, turn, call_id, content). Columns out:
    conv_id, call_id, turn, status, level, position (gapless from 1 in the chat: by level, then turn and id; calls on a
    cycle come last with a null level), valid, errors, json.

    status: linked; no_result; no_call (a result alone; position null). Of calls that share an identifier in a chat the
    first by turn stands, later ones are `repeated`; of several results the first counts. Rows whose chat or identifier is
    null can't be linked and become no_result or no_call without a position. Needs that name no call of the chat are
    errors and do not bind. Arguments that are null or no JSON, and names without a schema, are errors.
    """
    keyed = cut(calls.select("conv_id", "turn", "call_id", "name", "arguments", "needs"), "calls")
    first = Window.partitionBy(*_KEY).orderBy("turn", "name", "arguments")
    whole = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    numbered = keyed.where(whole).withColumn("_r", F.row_number().over(first))
    own = cut(numbered.where("_r = 1").drop("_r"), "calls")
    answer = Window.partitionBy(*_KEY).orderBy("turn", "content")
    given = results.select("conv_id", "turn", "call_id", "content")
    answers = cut(given.where(whole).withColumn("_r", F.row_number().over(answer)).where("_r = 1").select(*_KEY, F.col("turn").alias("result_turn"), "content"), "results")

    asked = own.select(*_KEY, F.explode("needs").alias("need")).where("need is not null")
    there = own.select("conv_id", F.col("call_id").alias("need"), F.lit(True).alias("there"))
    marked = asked.distinct().join(there, ["conv_id", "need"], "left")
    unknown = marked.where("there is null").groupBy(*_KEY).agg(F.array_sort(F.collect_set(F.concat(F.lit("needs: no "), "need"))).alias("unknown"))
    placed = own.join(levels(own.select(*_KEY), marked.where("there").select(*_KEY, "need")), _KEY, "left").select(*_KEY, "turn", "level")
    order = rank_within(placed, ["conv_id"], [F.col("level").asc_nulls_last(), F.col("turn").asc_nulls_last(), F.col("call_id")], "position")
    joined = own.join(order.drop("turn"), _KEY).join(answers, _KEY, "left").join(unknown, _KEY, "left")
    linked = joined.withColumn("status", F.when(F.col("result_turn").isNotNull() | F.col("content").isNotNull(), "linked").otherwise("no_result"))
    none = {"level": F.lit(None).cast("int"), "position": F.lit(None).cast("long"), "result_turn": F.lit(None).cast("long"), "content": F.lit(None).cast("string"), "unknown": F.lit(None).cast("array<string>")}
    again = numbered.where("_r > 1").drop("_r").withColumns({**none, "status": F.lit("repeated")})
    apart = keyed.where(~whole).withColumns({**none, "status": F.lit("no_result")})
    alone = answers.join(own, _KEY, "left_anti").unionByName(given.where(~whole).select(*_KEY, F.col("turn").alias("result_turn"), "content"))
    orphans = alone.select(*_KEY, F.col("result_turn").alias("turn"), F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("arguments"), F.lit(None).cast("array<string>").alias("needs"), "content").withColumns(
        {k: v for k, v in none.items() if k != "content"} | {"status": F.lit("no_call")}
    )
    columns = ["conv_id", "call_id", "turn", "name", "arguments", "level", "position", "content", "unknown", "status"]
    every = linked.select(columns).unionByName(again.select(columns)).unionByName(apart.select(columns)).unionByName(orphans.select(columns))

    def per_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for row in batch.to_pylist():
            errors = list(row["unknown"] or [])
            record = {"id": row["call_id"], "result": row["content"]}
            if row["status"] != "no_call":
                value, bad = parse(row["arguments"])
                schema = schemas.get(row["name"])
                errors += [bad] if bad else ["name: no schema"] if schema is None else problems(value, schema)
                record |= {"name": row["name"], "arguments": value, "position": row["position"]}
            out.append({**{k: row[k] for k in ("conv_id", "call_id", "turn", "status", "level", "position")}, "valid": not errors and row["status"] != "no_call", "errors": errors, "json": canonical(record)})
        return pa.RecordBatch.from_pylist(out, schema=_LINKED)

    return map_batches(every, per_batch, "conv_id long, call_id string, turn long, status string, level int, position long, valid boolean, errors array<string>, json string")


_LINKED = pa.schema([
    ("conv_id", pa.int64()), ("call_id", pa.string()), ("turn", pa.int64()), ("status", pa.string()), ("level", pa.int32()),
    ("position", pa.int64()), ("valid", pa.bool_()), ("errors", pa.list_(pa.string())), ("json", pa.string()),
])
