import pandas as pd
import pytest
from pyspark.sql import functions as F

from loanloom.operators import joins


@pytest.mark.parametrize("total", [None, 1000])
def test_hot_key_lookup_is_complete(spark, total, monkeypatch):
    """A third of the rows on one key, null keys and unseen keys."""
    monkeypatch.setattr(joins, "HOT_PARTS", 20)
    rows = spark.createDataFrame(
        [(i, "hot" if i % 3 == 0 else None if i % 3 == 1 and i % 7 == 0 else f"k{i % 50}") for i in range(1000)],
        "id int, k string")
    table = rows.where("k is not null and k <> 'k7'").groupBy("k").agg(
        F.count(F.lit(1)).alias("n"), F.max("id").alias("top"))
    got = joins.hot_key_lookup(rows, table, ["k"], "n", total).toPandas().sort_values("id")
    want = rows.join(table.drop("n"), "k", "left").toPandas().sort_values("id")
    assert got["id"].tolist() == list(range(1000))
    pd.testing.assert_series_equal(got["top"].reset_index(drop=True), want["top"].reset_index(drop=True))


def test_small_tables_are_broadcast_and_large_are_not(spark):
    rows = spark.range(100).withColumn("k", F.col("id") % 10)
    table = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("m"))
    small = joins.lookup(rows, table, ["k"], 10, "n")._jdf.queryExecution().toString()
    large = joins.lookup(rows, table, ["k"], 10, "n", limit=5)._jdf.queryExecution().toString()
    assert "_salt" not in small and "_salt" in large


def test_few_long_texts_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(joins, "MEASURED_ROWS", 5)
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 1000)
    rows = spark.range(40).select("id", F.concat(F.lit("k"), F.col("id") % 10).alias("k"))
    table = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.repeat(F.lit("x"), 200).alias("t"))
    got = joins.lookup(rows, table, ["k"], 10, "n")
    assert "_salt" in got._jdf.queryExecution().toString() and got.where("length(t) = 200").count() == 40


def test_keys_beyond_a_task_are_hot(spark, monkeypatch):
    """A key far below a thousandth of all rows is spread once it has more rows than a task should get."""
    monkeypatch.setattr(joins, "HOT_ROWS", 8)
    rows = spark.range(20_000).select("id", F.when(F.col("id") < 9, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    table = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("m"))
    got = joins.hot_key_lookup(rows, table, ["k"], "n")
    assert got.count() == 20_000 and got.where("k = -1 and m = 8").count() == 9


def test_lookup_of_rows_with_odd_columns(spark, monkeypatch):
    """Helper names that are taken, dots, back ticks, maps and null keys pass through both branches."""
    monkeypatch.setattr(joins, "HOT_PARTS", 4)
    rows = spark.range(60).select(
        "id", F.when(F.col("id") % 3 > 0, F.col("id") % 3 * F.col("id") % 5).alias("k"), F.lit(1).alias("_hot"),
        F.lit(2).alias("_cold"), F.lit(3).alias("_salt"), F.col("id").alias("a.b"), F.lit("x").alias("t`k"),
        F.create_map(F.lit("m"), F.col("id")).alias("map"))
    table = spark.createDataFrame([(0, 30, "z"), (1, 2, None), (2, 3, "y")], "k long, n long, `v.w` string")
    want = {i: {0: "z", 2: "y"}.get(None if i % 3 == 0 else i % 3 * i % 5) for i in range(60)}
    for limit in (0, 100):
        got = joins.lookup(rows, table, ["k"], 3, "n", limit=limit)
        assert sorted(got.columns) == sorted([*rows.columns, "v.w"])
        found = got.collect()
        assert {r.id: r["v.w"] for r in found} == want and len(found) == 60
        assert all((r._hot, r._cold, r._salt, r["a.b"], r["t`k"], r.map) == (1, 2, 3, r.id, "x", {"m": r.id}) for r in found)


def test_lookup_of_rows_that_hold_maps_only_beside_the_key(spark):
    rows = spark.range(9).select("id", F.create_map(F.lit("m"), F.col("id")).alias("map"))
    table = spark.createDataFrame([(3, 1, "z")], "id long, n long, v string")
    got = joins.lookup(rows, table, ["id"], 1, "n", limit=0)
    assert sorted((r.id, r.v) for r in got.collect()) == [(i, "z" if i == 3 else None) for i in range(9)]
