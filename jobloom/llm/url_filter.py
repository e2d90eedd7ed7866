"""URL filters: gradient-boosted trees on lexical features, and allow and block rules. DataFrame operations only.

Labelled URLs train the trees; suffix statistics are smoothed block rates of the host's last labels, counted over all
labelled URLs. Features are column expressions; the trees are Spark's own.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Labelled URLs the trees are fitted on at most (those with the smallest hashes); suffix statistics count all.
TRAIN_ROWS = 50_000
#: Weight of the overall block rate in a suffix's rate.
PRIOR = 20.0
FEATURES = [
    "url_length", "host_length", "path_length", "host_depth", "path_depth", "digit_ratio", "host_digit_ratio", "entropy",
    "params", "hyphens", "has_fragment", "is_secure", "suffix_rate", "site_rate",
]


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def parts(url: Column) -> tuple[Column, Column]:
    """Host (after the first ://, A-Z lower-cased) and path; both empty for a null or one without ://."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def matched_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, or nulls. A rule fits its host and subdomains where the path begins
    with the rule's. Rules are a short list, tried in order of length."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name, verdict = F.when(fits, rule.name).otherwise(name), F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def _ratio(text: Column, pattern: str) -> Column:
    return _count(text, pattern) / F.greatest(F.length(text), F.lit(1))


def entropy(text: Column) -> Column:
    """Shannon entropy, in bits, of the characters; 0 for an empty text."""
    letters = F.filter(F.split(text, ""), lambda c: c != "")
    shares = F.transform(F.array_distinct(letters), lambda c: F.size(F.filter(letters, lambda x: x == c)) / F.size(letters))
    return F.coalesce(F.aggregate(shares, F.lit(0.0), lambda s, p: s - p * F.log2(p)), F.lit(0.0))


def features(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """`urls` with _host, _path, _suffix (last label), _site (last two labels) and the lexical features."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    host, path = parts(F.col(url_col))
    named = urls.withColumns({"_host": host, "_path": path})
    h, p = F.col("_host"), F.col("_path")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return named.withColumns(
        {
            "_suffix": F.substring_index(h, ".", -1), "_site": F.substring_index(h, ".", -2),
            "url_length": F.length(url).cast("double"), "host_length": F.length(h).cast("double"), "path_length": F.length(p).cast("double"),
            "host_depth": _count(h, r"\."), "path_depth": _count(p, "/[^/]"), "digit_ratio": _ratio(url, "[0-9]"), "host_digit_ratio": _ratio(h, "[0-9]"),
            "entropy": entropy(url), "params": _count(query, "[^&]+"), "hyphens": _count(h, "-"),
            "has_fragment": url.contains("#").cast("double"), "is_secure": url.startswith("https:").cast("double"),
        }
    )


class UrlModel(NamedTuple):
    trees: PipelineModel | None
    suffixes: DataFrame
    sites: DataFrame
    rate: float

    def verdicts(self, featured: DataFrame) -> DataFrame:
        """`featured` with _score (probability of block) and _verdict."""
        joined = _with_rates(featured, self.suffixes, self.sites, self.rate)
        if self.trees is None:
            scored = joined.withColumn("_score", F.lit(self.rate))
        else:
            scored = self.trees.transform(joined).withColumn("_score", vector_to_array("_probability")[1])
        return scored.withColumn("_verdict", F.when(F.col("_score") > 0.5, "block").otherwise("allow"))


def _with_rates(featured: DataFrame, suffixes: DataFrame, sites: DataFrame, rate: float) -> DataFrame:
    return (
        featured.join(suffixes, "_suffix", "left")
        .join(sites, "_site", "left")
        .withColumns({"suffix_rate": F.coalesce("suffix_rate", F.lit(rate)), "site_rate": F.coalesce("site_rate", F.lit(rate))})
    )


def train(labelled: DataFrame, label_col: str = "label", url_col: str = "url", rounds: int = 10, depth: int = 4, rows: int = TRAIN_ROWS) -> UrlModel:
    """Fit on URLs with a label, 1 for block and 0 for allow; rows without one take no part. With labels of one kind only
    (or none) there are no trees, and every URL gets the overall rate."""
    known = features(labelled.where(F.col(label_col).isNotNull()).withColumn("_label", F.col(label_col).cast("double")), url_col)
    total = known.agg(F.count("*"), F.coalesce(F.sum("_label"), F.lit(0.0))).first()
    rate = total[1] / total[0] if total[0] else 0.0

    def rates(key: str, name: str) -> DataFrame:
        return known.groupBy(key).agg(((F.sum("_label") + PRIOR * rate) / (F.count("*") + PRIOR)).alias(name))

    suffixes, sites = rates("_suffix", "suffix_rate"), rates("_site", "site_rate")
    if not 0 < total[1] < total[0]:
        return UrlModel(None, suffixes, sites, rate)
    sample = _with_rates(known.orderBy(F.xxhash64(url_col), url_col).limit(rows), suffixes, sites, rate)
    assembled = VectorAssembler(inputCols=FEATURES, outputCol="_features")
    gbt = GBTClassifier(featuresCol="_features", labelCol="_label", predictionCol="_prediction", maxIter=rounds, maxDepth=depth, seed=7)
    fitted = gbt.fit(assembled.transform(sample.select(*FEATURES, "_label"))).setProbabilityCol("_probability").setRawPredictionCol("_raw")
    return UrlModel(PipelineModel([assembled, fitted]), suffixes, sites, rate)


def judge(urls: DataFrame, rules: Sequence[Rule], model: UrlModel, keep: Sequence[str], url_col: str = "url") -> DataFrame:
    """keep columns, host, path, rule (null if none fits), verdict (the rule's, else the model's), score."""
    judged = model.verdicts(features(urls.select(*keep, *([url_col] if url_col not in keep else [])), url_col))
    name, said = matched_rule(F.col("_host"), F.col("_path"), rules)
    return judged.select(*keep, F.col("_host").alias("host"), F.col("_path").alias("path"), name.alias("rule"), F.coalesce(said, "_verdict").alias("verdict"), F.col("_score").alias("score"))
