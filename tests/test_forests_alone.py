"""Extremely randomised trees that tasks grow whole are those of passes; passes get rows in batches of the session's size."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loanloom.operators import random_trees, training
from loanloom.operators.random_trees import RandomTreeSettings


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(6)
    n = 400
    x = np.c_[rng.standard_normal(n), rng.integers(0, 3, n), np.full(n, 2.0), rng.random(n).round(2), -np.abs(rng.standard_normal(n).round(1))]
    y = rng.random(n) < 1 / (1 + np.exp(-(2 * x[:, 0] + (x[:, 1] == 1) - 1.5 * x[:, 3])))
    rows = [(str(i % 390), int(t), *map(float, v)) for i, (v, t) in enumerate(zip(x, y, strict=True))]
    df = spark.createDataFrame(rows, "ID string, Target int, a double, b double, c double, d double, e double")
    return training.assemble_once(df, list("abcde")).rows


@pytest.mark.parametrize("s", [RandomTreeSettings(11, 5, 1, seed=5), RandomTreeSettings(3, 30, 4, max_features=3, seed=8),
                               RandomTreeSettings(2, 0, seed=1), RandomTreeSettings(2, 30, 300, seed=2)])
def test_alone_as_by_passes(table, s, monkeypatch):
    levels = []
    level = random_trees._level
    monkeypatch.setattr(random_trees, "_level", lambda *a: levels.append(1) or level(*a))
    weight = F.when(F.col("Target") == 1, 1.3).otherwise(F.lit(0.8))
    alone = random_trees.grow_forest(table, weight, s)
    # no pass over the rows for a level
    assert not levels and len(alone[0]) == s.n_estimators
    monkeypatch.setattr(random_trees, "ALONE", 0)
    assert random_trees.grow_forest(table.repartition(3), weight, s) == alone
    one = table.where("Target = 1")
    pure = random_trees.grow_forest(one, F.lit(1.0), s)
    monkeypatch.undo()
    assert random_trees.grow_forest(one, F.lit(1.0), s) == pure


def test_passes_get_whole_batches(table, monkeypatch):
    sizes = []

    def counted(open_, n_features):
        def run(found):
            for batch in found:
                yield pa.RecordBatch.from_arrays([pa.array([0]), pa.array([float(batch.num_rows)]), pa.array([0.0])], ["cell", "low", "high"])

        return run

    monkeypatch.setattr(random_trees, "ALONE", 0)
    monkeypatch.setattr(random_trees, "_ranges", counted)
    # the least of a column is the size of its smallest batch here
    monkeypatch.setattr(random_trees, "choose", lambda low, high, *a: sizes.append(low[0, 0]) or _none(len(low)))
    random_trees.grow_forest(table.coalesce(1), F.lit(1.0), RandomTreeSettings(1, 3))
    assert sizes == [400.0]


def _none(n):
    return np.full((n, 2), -1), np.zeros((n, 2))
