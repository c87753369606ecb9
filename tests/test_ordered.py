import random
import re

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loanloom.functions.text import seeded_md5
from loanloom.operators import ordered


def _frame(spark, n=3000, seed=1, hot=True):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        v = None if i % 41 == 0 else (0.25 if hot and i % 3 == 0 else round(rnd.gauss(0, 1), 2))
        rows.append((i, f"g{rnd.randrange(4)}" if i % 53 else None, v))
    return spark.createDataFrame(rows, "id long, g string, v double")


@pytest.mark.parametrize("buckets", [None, 1, 7, 64])
@pytest.mark.parametrize("limit", [0, 10**6])
def test_ranks_match_pandas(spark, buckets, limit):
    df = _frame(spark)
    got = ordered.percent_rank_in_group(df, "v", ["g"], "r", buckets, broadcast_rows=limit).toPandas()
    pdf = df.toPandas()
    want = pdf.groupby("g")["v"].rank(pct=True)
    merged = got.set_index("id")["r"].sort_index()
    want.index = pdf["id"]
    pd.testing.assert_series_equal(merged, want.sort_index(), check_names=False, rtol=1e-12)


def test_small_rank_example(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 2.0), (4, 4.0), (5, None)], "id int, v double")
    got = {r["id"]: r["pct_rank"] for r in ordered.percent_rank_in_group(df, "v").collect()}
    assert got == {1: 0.25, 2: 0.625, 3: 0.625, 4: 1.0, 5: None}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.floats(-1e6, 1e6, allow_nan=False)), min_size=1, max_size=60))
def test_global_rank_property(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v double")
    got = {r["id"]: r["pct_rank"] for r in ordered.percent_rank_in_group(df, "v", buckets=5).collect()}
    want = pd.Series([np.nan if v is None else v for v in values], dtype="float64").rank(pct=True)
    for i, w in want.items():
        assert (got[i] is None) if np.isnan(w) else got[i] == pytest.approx(w, rel=1e-12)


@pytest.mark.parametrize("parts", [1, 4, 64])
def test_running_totals_do_not_depend_on_partitions(spark, parts):
    df = _frame(spark, 800).repartition(parts)
    got = ordered.running_totals(df, "v", ["g"], {"s": F.col("id")}, buckets=16).orderBy("g", "v").toPandas()
    base = ordered.running_totals(_frame(spark, 800), "v", ["g"], {"s": F.col("id")}, buckets=1).orderBy(
        "g", "v").toPandas()
    pd.testing.assert_frame_equal(got, base)


def test_text_values_are_ordered(spark):
    words = [f"w{i:04d}" for i in range(300)]
    df = spark.createDataFrame([(w,) for w in words], "v string")
    t = ordered.running_totals(df, "v", buckets=8)
    assert [r["before_n"] for r in t.orderBy("v").collect()] == list(range(300))


def test_rows_are_not_sorted_in_one_task(spark):
    """With several buckets the only single-task exchange is over the bucket table."""
    df = _frame(spark, 2000)
    t = ordered.running_totals(df, "v", buckets=16)
    plan = t._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    singles = re.findall(r"Exchange\n(?:.*\n)*?Arguments: SinglePartition", plan)
    assert len(singles) <= 1
    assert "hashpartitioning(_bucket" in plan
    assert "CartesianProduct" not in plan


@pytest.mark.parametrize("buckets", [None, 1, 9])
def test_quantiles_match_pandas(spark, buckets):
    df = _frame(spark).select("id", "v", (F.col("v") * F.col("id")).alias("w"))
    fractions = [(0, 1), (1, 15), (1, 2), (14, 15), (1, 1)]
    got = ordered.exact_quantiles(df, ["v", "w"], fractions, buckets=buckets, small=100).toPandas()
    pdf = df.toPandas()
    for r in got.itertuples():
        a, b = fractions[r.q]
        assert r.value == pytest.approx(pdf[r.column_name].quantile(a / b), rel=1e-9, abs=1e-9)


def test_median_interpolates(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (10.0,), (20.0,)], "x double")
    assert ordered.medians(df, ["x"]) == {"x": 6.0}


@pytest.mark.parametrize("digits", [1, 3])
def test_hash_row_numbers(spark, digits):
    df = _frame(spark, 500)
    got = ordered.hash_row_numbers(df, seeded_md5("id", 1), "id", digits=digits).toPandas()
    assert sorted(got["row_number"]) == list(range(1, 501))
