"""Buckets of quantiles are cut column by column."""

from pyspark.sql import functions as F

from loanloom.operators import ordered


def test_a_common_value_fills_its_own_bucket(spark):
    df = spark.range(4000).select((F.col("id") % 4).cast("double").alias("few"), F.col("id").cast("double").alias("many"),
                                  F.lit(None).cast("double").alias("none"))
    cols = ["few", "many", "none"]
    long = df.unpivot([], cols, "column_name", "x").where("x is not null")
    cells = ordered._column_buckets(df, long, cols, 8000, 8)
    sizes = {(r["column_name"], r["_bucket"]): r["count"] for r in cells.groupBy("column_name", "_bucket").count().collect()}
    assert max(sizes.values()) <= 2000 and sum(sizes.values()) == 8000
    assert len([c for c, _ in sizes if c == "few"]) >= 3
    got = {r["column_name"]: r["value"] for r in ordered.exact_quantiles(df, cols, buckets=8, small=10).collect()}
    assert got == {"few": 1.5, "many": 1999.5}


def test_quantiles_of_odd_values(spark):
    values = [-0.0, 0.0, float("inf"), float("-inf"), float("nan"), 2.0, 2.0, 3.0, None] * 9
    df = spark.createDataFrame([(v,) for v in values], "v double")
    wide = {(r["q"]): repr(r["value"]) for r in ordered.exact_quantiles(df, ["v"], [(1, 4), (1, 2), (3, 4)], buckets=6, small=1).collect()}
    one = {(r["q"]): repr(r["value"]) for r in ordered.exact_quantiles(df, ["v"], [(1, 4), (1, 2), (3, 4)]).collect()}
    assert wide == one
