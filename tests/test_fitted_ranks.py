"""Ranks read from a fitted table: their error, and scoring of streams with them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanloom.operators import features, training
from loanloom.operators.features import BaseFeatureEngineer
from loanloom.operators.ordered import percent_rank_in_group
from loanloom.streaming import scoring


@pytest.fixture(scope="module")
def values(spark):
    rng = np.random.default_rng(6)
    x = np.r_[rng.standard_normal(900), np.full(400, 0.25), rng.integers(0, 9, 200)]
    rows = [(i, "ab"[i % 2] if i % 50 else None, float(v)) for i, v in enumerate(x)]
    return spark.createDataFrame([*rows, (9998, "a", None), (9999, "lone", 3.0)], "ID long, g string, v double")


@pytest.mark.parametrize("parts", [4, 16, 1024, 1 << 20])
def test_error_is_at_most_one_part(values, parts):
    table = features.fitted_ranks(values, "v", "g", parts)
    assert table.agg(F.max(F.size("xs"))).first()[0] <= 2 * parts + 2
    exact = percent_rank_in_group(values, "v", ["g"], "exact")
    both = exact.join(table, "g", "left").withColumn("got", features.interpolated(F.col("v"), F.col("xs"), F.col("ys"), 2 * parts + 2))
    r = both.agg(F.max(F.abs(F.col("got") - F.col("exact"))).alias("worst"), F.count_if(F.col("got").isNull()).alias("none"),
                 F.count_if(F.col("exact").isNull()).alias("want")).first()
    assert r.worst <= (1 / parts if parts < 2000 else 1e-12) and r.none == r.want


def test_values_never_seen(spark, values):
    table = features.fitted_ranks(values, "v", "g", 1 << 20).where("g = 'a'").first()
    asked = [-99.0, -3.21, 0.1234, 0.25, 5.5, 99.0]
    rows = spark.createDataFrame([(x, table.xs, table.ys) for x in asked], "x double, xs array<double>, ys array<double>")
    got = {r.x: r.y for r in rows.select("x", features.interpolated(F.col("x"), F.col("xs"), F.col("ys"), 1 << 21).alias("y")).collect()}
    assert [got[x] for x in asked] == pytest.approx(np.interp(asked, table.xs, table.ys), abs=1e-12)


def test_stream_scores_equal_batch_scores(spark, train, test_set, folds, tmp_path):
    eng = BaseFeatureEngineer(ranks="fitted").fit(train)
    tr = eng.transform(train)
    cols = training.numeric_columns(tr)
    assert {"amount_rank_in_product", "income_rank_in_province"} <= set(cols)
    model = training.fit_model(training.build_model("xgb", {"n_estimators": 3, "max_depth": 3}), training.assemble(tr, cols))
    want = {r.ID: r.score for r in scoring.score_rows(test_set, eng, model, cols).collect()}
    # a row alone gets what it gets among others
    alone = scoring.score_rows(test_set.limit(1), eng, model, cols).first()
    assert alone.score == want[alone.ID]
    timed = test_set.withColumn("at", F.timestamp_seconds(F.lit(1_700_000_000) + F.hash("ID") % 600))
    timed.unionByName(timed.limit(20)).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(timed.schema).parquet(str(tmp_path / "in"))
    q = scoring.start_scoring(stream, str(tmp_path / "out"), str(tmp_path / "ckpt"), event_time="at", engineer=eng, model=model, cols=cols)
    q.awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert len(rows) == len(want) and {r.ID: r.score for r in rows} == pytest.approx(want, abs=1e-12)


def test_pieces_equal_the_whole_line(spark):
    """A row carries the knots of one piece, however many its group has, and its rank is that of the whole line."""
    rows = [(i, "a" if i % 3 else "b", None if i % 41 == 0 else float(i * 37 % 211)) for i in range(600)]
    train = spark.createDataFrame([(i, None if i % 50 == 0 else g, v) for i, g, v in rows], "ID int, g string, v double")
    asked = spark.createDataFrame(
        [(i, None if i % 29 == 0 else "new" if i % 31 == 0 else g, None if v is None else v * 1.1 - 5) for i, g, v in rows],
        "ID int, g string, v double")
    line = features.interpolated(F.col("v"), F.col("xs"), F.col("ys"), 1 << 12)
    whole = asked.join(features.fitted_ranks(train, "v", "g", 1024), "g", "left").select("ID", line.alias("y"))
    fine = features.fine_fitted_ranks(asked, train, "v", "g", "y", 1024, 16)
    assert fine.columns == ["ID", "g", "v", "y"]
    want = {r.ID: r.y for r in whole.collect()}
    assert {r.ID: r.y for r in fine.collect()} == want and len(want) == 600
    assert sum(y is not None for y in want.values()) > 400
