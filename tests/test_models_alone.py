"""A model that one task grows is the one that passes over the rows grow; features counted together or one by one."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from loanloom.operators import boosting, training
from loanloom.operators.boosting import BoostSettings


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(8)
    n = 700
    x = np.c_[rng.standard_normal(n), rng.integers(0, 5, n), rng.random(n), rng.integers(0, 2, n), np.full(n, 3.0)]
    y = rng.random(n) < 1 / (1 + np.exp(-2 * x[:, 0] + (x[:, 1] == 2) - x[:, 3]))
    rows = [(str(i % 690), int(t), i % 3, *map(float, v)) for i, (v, t) in enumerate(zip(x, y, strict=True))]
    df = spark.createDataFrame(rows, "ID string, Target int, fold_id int, a double, b double, c double, d double, e double")
    return training.assemble_once(df, ["a", "b", "c", "d", "e"]).rows


SETTINGS = [
    BoostSettings(n_estimators=30, learning_rate=0.4, num_leaves=9, min_child_samples=5, reg_lambda=1.0, max_bins=16, patience=3),
    BoostSettings(n_estimators=5, learning_rate=0.3, num_leaves=0, max_depth=4, min_child_samples=2, min_child_weight=1.0, reg_alpha=1.0,
                  subsample=0.7, colsample_bytree=0.6, max_bins=64),
    BoostSettings(n_estimators=3, learning_rate=0.3, num_leaves=80, min_child_samples=2, max_bins=200),
    BoostSettings(n_estimators=4, learning_rate=0.3, num_leaves=12, max_depth=3, min_split_gain=2.0, max_bins=32, patience=2)]


def _trees(table, s):
    held = F.col("fold_id") == 2
    w = F.when(F.col("Target") == 1, 1.25).otherwise(0.75)
    fit = [F.when(~held, w), F.when(F.col("fold_id") != 0, F.lit(1.0)), F.lit(None).cast("double")]
    watch = [F.when(held, w), F.lit(None).cast("double"), F.lit(1.0)]
    return [m.getOrDefault("trees") for m in boosting.boost(table, fit, watch, s, seeds=[1, 2, 3])]


@pytest.mark.parametrize("s", SETTINGS)
def test_alone_as_by_passes(table, s, monkeypatch):
    jobs = []
    passes = boosting._Boost._fit
    monkeypatch.setattr(boosting._Boost, "_fit", lambda self, edges: jobs.append(1) or passes(self, edges))
    alone = _trees(table, s)
    # one task for each model, no pass
    assert not jobs and len(set(alone)) == 3
    monkeypatch.setattr(boosting, "GRID", 1)
    monkeypatch.setattr(boosting, "ROUTED", 50)
    monkeypatch.setattr(boosting, "COUNTED", 30)
    assert _trees(table, s) == alone and not jobs
    monkeypatch.setattr(boosting, "ALONE", 0)
    for small in (1 << 18, 150, 1):
        monkeypatch.setattr(boosting, "SMALL", small)
        assert _trees(table.repartition(5), s) == alone
    assert len(jobs) == 3


def test_grids_hold_what_features_hold():
    rng = np.random.default_rng(3)
    sizes = [64, 2, 200, 5, 64, 2, 3]
    bins = np.stack([rng.integers(0, n, 900) for n in sizes]).astype(np.uint8)
    grids = boosting.Grids(bins, sizes)
    assert sorted(f for g in grids.groups for f in g) == list(range(7)) and len(grids.groups) < 5
    allowed = np.array([True, True, True, False, True, False, True])
    for scale in (1 << 20, 1 << 45):
        g, h = np.rint(rng.normal(size=900) * 1000), np.rint(rng.random(900) * scale)
        for rows in (np.arange(900), np.flatnonzero(rng.random(900) < 0.1), np.zeros(0, np.int64)):
            want = boosting.row_cells(bins.T[rows], g[rows], h[rows], allowed, 200)
            assert (grids.cells(rows, np.stack([g, h], axis=1), allowed, 200) == want).all()


@pytest.mark.parametrize("leaves", [9, 100])
def test_scores_by_places_among_thresholds(spark, table, leaves, monkeypatch):
    """Scoring looks up tables of small integers; no row walks down a tree of up to 64 leaves by its values."""
    s = BoostSettings(n_estimators=6, learning_rate=0.4, num_leaves=leaves, min_child_samples=2, max_bins=200)
    model = boosting.boost(table, [F.lit(1.0)], [F.lit(0.0)], s)[0]
    trees = model.tree_list()
    rng = np.random.default_rng(2)
    rows = [[float(v) for v in r] for r in rng.normal(1, 2, (300, 5))]
    # values at thresholds, beside them, and outside all of them
    rows += [[t.at[i] if t.feature[i] == f else at for f, at in enumerate(rows[i])] for t in trees for i in t.inner()[:20]]
    rows += [[float("inf")] * 5, [float("-inf")] * 5, [float("nan")] * 5]
    want = []
    for x in rows:
        out = model.base
        for t in trees:
            i = 0
            while t.left[i] != i:
                i = t.left[i] if x[t.feature[i]] <= t.at[i] else t.right[i]
            out += t.value[i]
        want.append(out)
    df = spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "i int, x array<double>")
    monkeypatch.setattr(boosting.Routes, "of_values", None)
    got = model.transform(df.select("i", array_to_vector("x").alias("features"))).orderBy("i").select("margin").collect()
    assert [r.margin for r in got] == want
