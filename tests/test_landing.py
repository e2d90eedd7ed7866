from pyspark.sql import functions as F

from catalog import fixtures as fx
from jobloom.session import settings
from jobloom.sources.adapter import posting_fields


def test_landing_keeps_the_partitions_and_settings(spark):
    """A table is written as its build has dealt it out: neither dealt out again, which sorts whole rows, nor sorted by source."""

    def build(spark, _):
        return spark.range(0, 100, 1, 2).select(F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("source"), "id")

    before = [spark.conf.get(k, None) for k in fx.LANDING]
    out = fx._once("landing-test", spark, "none", build)
    assert sorted(r.id for r in out.collect()) == list(range(100)) and len(out.inputFiles()) == 4
    assert [spark.conf.get(k, None) for k in fx.LANDING] == before


def test_settings_are_put_back_after_an_error(spark):
    before = spark.conf.get("spark.sql.codegen.hugeMethodLimit", None)
    try:
        with settings(spark, {"spark.sql.codegen.hugeMethodLimit": "77"}):
            assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "77"
            raise KeyError
    except KeyError:
        pass
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit", None) == before


def test_orders_are_dealt_out_before_they_are_widened(spark, tmp_path):
    spark.range(40).selectExpr("id AS o_orderkey", "id % 4 AS o_custkey", "1000.0D AS o_totalprice", "timestamp_ntz'1995-01-01' AS o_orderdate").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(4).selectExpr("id AS c_custkey", "'N' AS c_name", "1 AS c_nationkey").write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(1).selectExpr("1 AS n_nationkey", "'X' AS n_name").write.parquet(f"{tmp_path}/nation.parquet")
    fields = posting_fields(spark, str(tmp_path))
    assert fields.count() == 40
    assert "RepartitionByExpression [o_orderkey" in fields._jdf.queryExecution().optimizedPlan().toString()
