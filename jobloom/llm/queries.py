"""Registered queries of the subpackage, with production parameters over whole tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom.llm import dac, gnat, kneser_ney, lsh, mixing, orchard, phrases, pii, previous_factor, sharding, simhash, tool_calls, url_filter
from jobloom.llm.common import ids_side, settle, table
from jobloom.session import cut, scratch_path

SHARDS = 8
#: Fixed values of the URL rules.
RULES = (
    url_filter.Rule("allow", "com", "/"),
    url_filter.Rule("block", "example.com", "/en/"),
    url_filter.Rule("allow", "www.example.com", "/en/"),
    url_filter.Rule("block", "net", "/es/"),
    url_filter.Rule("block", "net", "/fr/"),
)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    settle(spark)
    judged = kneser_ney.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.withColumnRenamed("id", "doc_id")


def op2_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    settle(spark)
    return dac.read_documents(dac.write_tokens(table(spark, sf_dir, "documents"), tokenizer_path()))


#: Schemas of the tools that `chats_with_tools` makes calls of.
SCHEMAS = {
    "search": {"type": "object", "required": ["query", "limit"], "additionalProperties": False, "properties": {"query": {"type": "string", "maxLength": 60}, "limit": {"type": "integer", "minimum": 1, "maximum": 300}}},
    "lookup": {"type": "object", "required": ["key"], "properties": {"key": {"type": "string"}, "limit": {"type": "integer", "maximum": 100}}},
    "count": {"type": "object", "required": ["words"], "properties": {"words": {"type": "array", "items": {"type": "string", "maxLength": 12}}}},
}


def chats_with_tools(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results made of the chats' own turns: each assistant turn is a call with its whole text in the
    arguments, which from turn 3 on needs the call two turns before. The text is also its result; that of turns
    divisible by eleven answers a call that was never made."""
    said = conversations.where("role = 'assistant'")
    words = F.split("text", r"\s+")
    kind = F.pmod("turn", F.lit(5))
    arguments = (
        F.when(kind == 1, F.to_json(F.struct(F.size(words).alias("limit"), F.col("text").alias("query"))))
        .when(kind == 3, F.to_json(F.struct(words.alias("words"))))
        .otherwise(F.to_json(F.struct(words[0].alias("key"), F.size(words).alias("limit"), F.col("text").alias("about"))))
    )
    name = F.when(kind == 1, "search").when(kind == 3, "count").otherwise("lookup")
    call_id = F.concat(F.lit("c"), F.col("turn"))
    needs = F.when(F.col("turn") > 2, F.array(F.concat(F.lit("c"), F.col("turn") - 2))).otherwise(F.array().cast("array<string>"))
    calls = said.select("conv_id", "turn", call_id.alias("call_id"), name.alias("name"), arguments.alias("arguments"), needs.alias("needs"))
    answered = F.when(F.col("turn") % 11 == 0, F.concat(F.lit("x"), F.col("turn"))).otherwise(call_id)
    results = said.select("conv_id", "turn", answered.alias("call_id"), F.col("text").alias("content"))
    return calls, results


def op3_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    settle(spark)
    return tool_calls.link(*chats_with_tools(table(spark, sf_dir, "conversations")), SCHEMAS)


def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    settle(spark)
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    _, said = url_filter.matched_rule(*url_filter.parts(F.col("url")), RULES)
    model = url_filter.train(pages.select("url", (said == "block").alias("label")))
    return url_filter.judge(pages, RULES, model, ["page_id"])


def op5_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    settle(spark)
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    rows = sharding.slotted(docs).drop("text")
    loads = sharding.slot_loads(rows)
    root = scratch_path(spark, "slot-map")
    first = sharding.first_map(spark, SHARDS)
    sharding.store_map(first, root)
    sharding.store_map(sharding.rebalance(sharding.load_map(spark, root, 0), loads, SHARDS), root)
    current = sharding.load_map(spark, root, 1)
    placed = sharding.places(sharding.assign(rows, current), current, loads, ["doc_id", "text_crc32", "_size"])
    return placed.select(
        "doc_id", F.col("_size").alias("size"), "text_crc32", F.lit("bytes").alias("law"), F.col("_shard").alias("shard"),
        F.col("_place").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), F.col("_slot").alias("virtual_slot"),
    )


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    settle(spark)
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), simhash.fingerprint_hex(F.col("fingerprint")).alias("fingerprint"), "component_id")


def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    settle(spark)
    mixed = mixing.plan(table(spark, sf_dir, "documents")).withColumn("position", F.array_min(F.transform("uses", lambda u: u["position"])))
    ordered = mixing.in_training_order(mixed, "position", "id")
    return ordered.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "source", "position")


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    settle(spark)
    return lsh.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)


def op9_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    settle(spark)
    found = phrases.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumn("items_sha256", F.sha2(F.array_join("item_ids", ","), 256)).drop("item_ids")


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    settle(spark)
    docs = table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.train(docs))
    count = lambda kind: F.size(F.filter("base", lambda s: s.startswith(kind + ":"))).cast("long").alias(f"n_{kind}")
    part = lambda s: F.split(s, ":")
    order = lambda s: F.struct(part(s)[1].cast("long"), F.array_position(F.array(*map(F.lit, pii.KINDS)), part(s)[0]), part(s)[2].cast("long"), s.alias("span"))
    spans = F.transform(F.array_sort(F.transform(F.concat("base", "added"), order)), lambda x: x["span"])
    return found.select(
        F.col("id").alias("doc_id"), *map(count, pii.KINDS), F.sha2(F.array_join("base", ","), 256).alias("base_sha256"),
        F.array_join(spans, ",").alias("spans"), F.size("added").cast("long").alias("n_added"),
    )


def op11_previous_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    settle(spark)
    left = previous_factor.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return left.select(
        F.col("id").alias("doc_id"), "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op12_orchard_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    settle(spark)
    found = orchard.cluster(table(spark, sf_dir, "embeddings"))
    rows = cut(found.rows, "clusters")
    sums = {r["cluster"]: int(r["total"]) for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in found.centroids]
    # One row per centroid: bounded by the parameter, not by the vectors.
    facts = [(i, sums[i], sum(sums.values()), digests[i]) for i in sorted(sums)]
    about = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(about), "cluster").select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op13_gnat_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    settle(spark)
    found = gnat.compress(table(spark, sf_dir, "embeddings"))
    rows = cut(found.rows, "codes")
    errors = rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    code = F.array_join(F.transform("code", lambda i: F.lower(F.lpad(F.hex(i), 2, "0"))), "")
    joined = rows.join(ids_side(errors), F.col("label").eqNullSafe(F.col("of")))
    return joined.select(F.col("id").alias("vec_id"), code.alias("code"), "error", "label_error", F.lit(gnat.codebooks_digest(found.codebooks)).alias("codebooks_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality, op2_tokens, op3_tool_calls, op4_urls, op5_shards, op6_near_duplicates, op7_mix, op8_neighbours, op9_contamination, op10_personal_data,
        op11_previous_factors, op12_orchard_clusters, op13_gnat_codes,
    )
}
