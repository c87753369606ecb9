"""Extremely randomised trees and per-row attribution against brute force."""

import itertools
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from loanloom.operators import attribution, boosting, metrics, random_trees, training
from loanloom.operators.random_trees import RandomTreeSettings


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(9)
    x = np.c_[rng.standard_normal(260), rng.integers(0, 3, 260), np.full(260, 2.0), rng.random(260).round(2), rng.standard_normal(260)]
    y = (rng.random(260) < 1 / (1 + np.exp(-(2 * x[:, 0] + (x[:, 1] == 1) - 1.5 * x[:, 3])))).astype(int)
    return x, y


@pytest.fixture(scope="module")
def table(spark, data):
    x, y = data
    rows = [(str(i), int(t), *map(float, v)) for i, (v, t) in enumerate(zip(x, y, strict=True))]
    df = spark.createDataFrame(rows, "ID string, Target int, a double, b double, c double, d double, e double")
    return training.assemble_once(df, list("abcde")).rows


def _plain_tree(x, y, w, t, s, k):
    """One tree grown node by node: {path: (feature, threshold)} and {path: share}."""
    splits, shares, todo = {}, {}, [(1, list(range(len(x))))]
    while todo:
        path, rows = todo.pop()
        pos, neg = sum(w[i] for i in rows if y[i]), sum(w[i] for i in rows if not y[i])
        shares[path] = pos / (pos + neg)
        if path.bit_length() > s.max_depth or not pos or not neg or len(rows) < 2 * s.min_child_samples:
            continue
        one = np.array([t]), np.array([path])
        first, second = random_trees.draws(s.seed, 1, *one, x.shape[1])[0], random_trees.draws(s.seed, 2, *one, x.shape[1])[0]
        best = None
        varying = [f for f in np.argsort(first) if min(x[i, f] for i in rows) < max(x[i, f] for i in rows)]
        for f in varying[:k]:
            low, high = min(x[i, f] for i in rows), max(x[i, f] for i in rows)
            at = low + second[f] * (high - low)
            left, right = [i for i in rows if x[i, f] <= at], [i for i in rows if x[i, f] > at]
            if min(len(left), len(right)) < s.min_child_samples:
                continue
            score = 0.0
            for side in (left, right):
                p, n = sum(w[i] for i in side if y[i]), sum(w[i] for i in side if not y[i])
                score += (p * p + n * n) / (p + n)
            if best is None or score > best[0] + 1e-12:
                best = (score, int(f), at, left, right)
        if best:
            splits[path] = best[1:3]
            todo += [(2 * path, best[3]), (2 * path + 1, best[4])]
    return splits, shares


@pytest.mark.parametrize("s", [RandomTreeSettings(3, 4, 1, seed=5), RandomTreeSettings(2, 30, 4, max_features=3, seed=8)])
def test_trees_equal_plain_ones(table, data, s, monkeypatch):
    x, y = data
    weight = F.when(F.col("Target") == 1, 2.0).otherwise(1.0)
    trees, _ = random_trees.grow_forest(table, weight, s)
    for t, got in enumerate(trees):
        splits, shares = _plain_tree(x, y, np.where(y == 1, 2.0, 1.0), t, s, s.max_features or 2)
        seen, todo = {}, [(0, 1)]
        while todo:
            i, path = todo.pop()
            if got.left[i] == i:
                assert got.value[i] == pytest.approx(shares[path])
            else:
                seen[path] = (got.feature[i], got.at[i])
                todo += [(got.left[i], 2 * path), (got.right[i], 2 * path + 1)]
        assert seen.keys() == splits.keys()
        for path, (f, at) in splits.items():
            assert seen[path][0] == f and seen[path][1] == pytest.approx(at, abs=1e-12)
    monkeypatch.setattr(random_trees, "NODES", 3)
    assert random_trees.grow_forest(table.repartition(5), weight, s)[0] == trees


def test_forest_scores(table, tmp_path):
    model = training.fit_model(training.build_model("extra_trees", {"n_estimators": 12, "max_depth": 6}), table)
    scored = training.score(model, table, ["ID", "Target"])
    assert metrics.roc_auc(scored).first()["roc_auc"] > 0.8
    importances = model.stages[0].featureImportances.toArray()
    assert importances.sum() == pytest.approx(1.0) and importances[2] == 0 and importances.argmax() == 0
    model.write().overwrite().save(str(tmp_path / "m"))
    again = training.score(PipelineModel.load(str(tmp_path / "m")), table, ["ID", "Target"])
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in scored.collect()}


def _expected(tree, x, known, i=0):
    """Value of a tree when only the known features are given."""
    if tree.left[i] == i:
        return tree.value[i]
    f, left, right = tree.feature[i], tree.left[i], tree.right[i]
    if f in known:
        return _expected(tree, x, known, left if x[f] <= tree.at[i] else right)
    return sum(tree.cover[c] / tree.cover[i] * _expected(tree, x, known, c) for c in (left, right))


def test_values_equal_all_subsets(table, data):
    x, _ = data
    s = boosting.BoostSettings(n_estimators=4, learning_rate=0.5, num_leaves=11, min_child_samples=3, max_bins=32)
    model = boosting.boost(table, [F.lit(1.0)], [F.lit(0.0)], s)[0]
    got = {r.ID: r for r in attribution.explain(model, table).collect()}
    assert len(got) == 260
    n = x.shape[1]
    for i in range(260):
        r = got[str(i)]
        assert r.base + sum(r.contributions) == pytest.approx(r.margin, abs=1e-9)
    for i in range(0, 260, 29):
        want = np.zeros(n)
        for tree in model.tree_list():
            value = {known: _expected(tree, x[i], set(known)) for k in range(n + 1) for known in itertools.combinations(range(n), k)}
            for f in range(n):
                for k in range(n):
                    weight = math.factorial(k) * math.factorial(n - k - 1) / math.factorial(n)
                    for known in itertools.combinations([j for j in range(n) if j != f], k):
                        want[f] += weight * (value[tuple(sorted((*known, f)))] - value[known])
        assert got[str(i)].contributions == pytest.approx(want, abs=1e-9)
    means = attribution.mean_contributions(attribution.explain(model, table), list("abcde")).collect()
    assert means[0].feature == "a" and means[-1].mean_abs == 0
    table_ = attribution.path_table(model, list("abcde"))
    assert table_.select("tree", "leaf").distinct().count() == sum(t.n_leaves() for t in model.tree_list())


def test_values_of_long_paths():
    """Deep chains on two features and a single leaf."""
    tree = boosting.Tree(*[[] for _ in range(8)], 0)
    depth = 9
    for i in range(depth):
        tree.feature += [i % 2, 0]
        tree.bin += [0, 0]
        tree.at += [1.0 - i * 0.1, 0.0]
        tree.value += [0.0, float(i)]
        tree.gain += [1.0, 0.0]
        tree.left += [2 * i + 2, 2 * i + 1]
        tree.right += [2 * i + 1, 2 * i + 1]
        tree.cover += [float(2 ** (depth - i)), float(2 ** (depth - i - 1))]
    tree.feature.append(0), tree.bin.append(0), tree.at.append(0.0), tree.value.append(7.0), tree.gain.append(0.0)
    tree.left.append(2 * depth), tree.right.append(2 * depth), tree.cover.append(1.0)
    x = np.array([[0.15, 0.35], [2.0, 2.0], [-1.0, -1.0]])
    got = attribution.shapley(x, attribution.leaf_paths([tree]))
    for row, phi in zip(x, got, strict=True):
        v = {k: _expected(tree, row, set(k)) for k in ((), (0,), (1,), (0, 1))}
        assert phi == pytest.approx([((v[(0,)] - v[()]) + (v[(0, 1)] - v[(1,)])) / 2, ((v[(1,)] - v[()]) + (v[(0, 1)] - v[(0,)])) / 2])


def test_sums_of_a_level_take_no_more_room_than_the_trees_own_nodes(monkeypatch):
    """Ranges and sides of two trees against brute force; sums of a tree are made for its nodes, not for all open ones."""
    rng = np.random.default_rng(4)
    x, y, w = rng.random((90, 3)), (rng.random(90) < 0.4).astype(float), rng.integers(1, 5, 90).astype(float)
    forest = random_trees._Forest(RandomTreeSettings(2, 3))
    for t in range(2):
        forest.splits[t] = {1: (t, 0.5), 2: (2, 0.3), 3: (2, 0.6)}
        forest.sums[t] = {p: np.ones(3) for p in range(1, 8)}
    nodes = [(t, p) for t in range(2) for p in range(4, 8)]
    places = [{p: 4 * t + p - 4 for p in range(4, 8)} for t in range(2)]
    open_ = random_trees._Open(*(np.array(v) for v in zip(*nodes, strict=True)),
                               {t: boosting.Routes(forest.tree(t, places[t])) for t in range(2)})
    batch = pa.RecordBatch.from_arrays([pa.array(y), pa.array(w), pa.array(x.tolist())], ["y", "w", "x"])
    at = [[4 * t + (2 * int(v[t] > 0.5) + int(v[2] > (0.3 if v[t] <= 0.5 else 0.6))) for v in x] for t in range(2)]
    members = [[i for i in range(90) if at[n // 4][i] == n] for n in range(8)]
    low = next(random_trees._ranges(open_, 3)([batch]))
    want = [min(x[i, f] for i in members[n]) for n in range(8) for f in range(3)]
    assert low.column(1).to_pylist() == want
    feature, bound = rng.integers(-1, 3, (8, 2)), rng.random((8, 2))
    sizes, bincount = [], np.bincount
    monkeypatch.setattr(np, "bincount", lambda c, *a, **k: sizes.append(len(bincount(c, *a, **k))) or bincount(c, *a, **k))
    got = next(random_trees._sides(open_, feature, bound, 1.0)([batch]))
    found = dict(zip(got.column(0).to_pylist(), zip(*(got.column(i).to_pylist() for i in (1, 2, 3)), strict=True), strict=True))
    for j, n in itertools.product(range(2), range(8)):
        left = [i for i in members[n] if feature[n, j] >= 0 and x[i, feature[n, j]] <= bound[n, j]]
        assert found.get(8 * j + n, (0, 0, 0)) == (sum(w[i] for i in left if y[i]), sum(w[i] for i in left if not y[i]), len(left))
    assert sum(sizes) <= 2 * 2 * (2 * 4 + 4)
