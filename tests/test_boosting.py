"""Boosting against a plain grower; the same trees from any partitions and from both ways of finishing leaves."""

import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from loanloom.operators import boosting, metrics, training
from loanloom.operators.boosting import BoostSettings


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(4)
    n = 600
    x = np.c_[rng.standard_normal(n), rng.integers(0, 5, n), rng.random(n), rng.standard_normal(n).round(1)]
    z = 1.5 * x[:, 0] - (x[:, 1] == 2) + 2 * (x[:, 2] > 0.5) * x[:, 3] - 0.5
    y = (rng.random(n) < 1 / (1 + np.exp(-z))).astype(int)
    return x, y


@pytest.fixture(scope="module")
def table(spark, data):
    x, y = data
    rows = [(str(i), int(t), i % 3, *map(float, v)) for i, (v, t) in enumerate(zip(x, y, strict=True))]
    df = spark.createDataFrame(rows, "ID string, Target int, fold_id int, a double, b double, c double, d double")
    return training.assemble_once(df, ["a", "b", "c", "d"]).rows


def _score(g, h, s):
    t = math.copysign(max(abs(g) - s.reg_alpha, 0.0), g)
    return t * t / (h + s.reg_lambda) if h + s.reg_lambda > 0 else 0.0


def _plain(x, y, w, edges, s, scale):
    """Boosting as it is written in books: one leaf after the other, by lists; gradients rounded to the same grid."""
    bins = [[sum(e < v for e in edges[f]) for f, v in enumerate(row)] for row in x]
    base = math.log(sum(w[y == 1]) / sum(w[y == 0]))
    margin, trees = [base] * len(x), []
    for _ in range(s.n_estimators):
        p = [1 / (1 + math.exp(-m)) for m in margin]
        g = [round(float(np.rint(w[i] * (p[i] - y[i]) * scale))) for i in range(len(x))]
        h = [round(float(np.rint(w[i] * p[i] * (1 - p[i]) * scale))) for i in range(len(x))]

        def best(rows, depth):
            if s.max_depth and depth >= s.max_depth:
                return None
            found = None
            whole = _score(sum(g[i] for i in rows) / scale, sum(h[i] for i in rows) / scale, s)
            for f in range(x.shape[1]):
                for b in range(len(edges[f])):
                    left = [i for i in rows if bins[i][f] <= b]
                    right = [i for i in rows if bins[i][f] > b]
                    gl, hl = sum(g[i] for i in left) / scale, sum(h[i] for i in left) / scale
                    gr, hr = sum(g[i] for i in right) / scale, sum(h[i] for i in right) / scale
                    if min(len(left), len(right)) < s.min_child_samples or min(hl, hr) < s.min_child_weight:
                        continue
                    gain = _score(gl, hl, s) + _score(gr, hr, s) - whole
                    if gain > max(s.min_split_gain, 1e-12) and (found is None or gain > found[0]):
                        found = (gain, f, b, left, right)
            return found

        leaves = {1: (list(range(len(x))), best(range(len(x)), 0))}
        splits = {}
        while len(leaves) < s.leaves:
            open_ = [(-b[0], path) for path, (_, b) in leaves.items() if b]
            if not open_:
                break
            path = min(open_)[1]
            _, (_, f, b, left, right) = leaves.pop(path)
            splits[path] = (f, b)
            for child, rows in ((2 * path, left), (2 * path + 1, right)):
                leaves[child] = (rows, best(rows, path.bit_length()))
        values = {}
        for path, (rows, _) in leaves.items():
            gs, hs = sum(g[i] for i in rows) / scale, sum(h[i] for i in rows) / scale
            values[path] = -s.learning_rate * math.copysign(max(abs(gs) - s.reg_alpha, 0.0), gs) / (hs + s.reg_lambda)
            for i in rows:
                margin[i] += values[path]
        trees.append((splits, values))
    return base, trees, margin


def _paths(tree):
    """(splits, leaf values) of a fitted tree, by path."""
    splits, values, todo = {}, {}, [(0, 1)]
    while todo:
        i, path = todo.pop()
        if tree.left[i] == i:
            values[path] = tree.value[i]
        else:
            splits[path] = (tree.feature[i], tree.bin[i])
            todo += [(tree.left[i], 2 * path), (tree.right[i], 2 * path + 1)]
    return splits, values


SETTINGS = [
    BoostSettings(n_estimators=3, learning_rate=0.3, num_leaves=9, min_child_samples=5, reg_lambda=1.0, max_bins=16),
    BoostSettings(n_estimators=2, learning_rate=0.5, num_leaves=0, max_depth=3, min_child_samples=1, min_child_weight=1.0, reg_alpha=2.0,
                  max_bins=16),
    BoostSettings(n_estimators=2, learning_rate=0.2, num_leaves=12, max_depth=4, min_child_samples=10, min_split_gain=1.0, reg_lambda=0.5,
                  max_bins=16)]


@pytest.mark.parametrize("s", SETTINGS)
def test_equals_a_plain_grower(table, data, s):
    x, y = data
    w = np.where(y == 1, 1.3, 0.8)
    edges = boosting.bin_edges(table, 4, s.max_bins)
    weight = F.when(F.col("Target") == 1, 1.3).otherwise(0.8)
    model = boosting.boost(table, [weight], [F.lit(0.0)], s)[0]
    most = float(sum(w))
    base, trees, margin = _plain(x, y, w, edges, s, float(2 ** min(30, 46 - math.ceil(math.log2(most)))))
    assert model.base == pytest.approx(base, abs=1e-12)
    for got, (splits, values) in zip(model.tree_list(), trees, strict=True):
        got_splits, got_values = _paths(got)
        assert got_splits == splits
        assert got_values == pytest.approx(values, abs=1e-9)
    scored = {r.ID: r.margin for r in model.transform(table).select("ID", "margin").collect()}
    assert [scored[str(i)] for i in range(len(x))] == pytest.approx(margin, abs=1e-9)


def _fit(table, s, **more):
    fit = [F.when(F.col("fold_id") != k, 1.0) for k in range(3)]
    return [m.getOrDefault("trees") for m in boosting.boost(table, fit, [F.lit(None).cast("double")] * 3, s, **more)]


def test_leaves_finish_alike(table, monkeypatch):
    """By passes for each level, by rows of whole trees, and by rows of lower leaves; one partition or seven; folds together or alone."""
    s = BoostSettings(n_estimators=4, learning_rate=0.3, num_leaves=12, min_child_samples=4, subsample=0.7, colsample_bytree=0.5, max_bins=32)
    want = _fit(table, s)
    monkeypatch.setattr(boosting, "WRITE_EVERY", 2)
    for small in (0, 150):
        monkeypatch.setattr(boosting, "SMALL", small)
        assert _fit(table, s) == want
    assert _fit(table.repartition(7, "a" if "a" in table.columns else "ID"), s) == want
    alone = boosting.boost(table.where("fold_id <> 1"), [F.lit(1.0)], [F.lit(0.0)], s)[0]
    assert alone.getNumTrees == 4


def test_leaf_limit_and_penalties(table):
    few = training.fit_model(training.build_model("lgbm", {"n_estimators": 2, "num_leaves": 5, "max_bins": 16}), table).stages[-1]
    assert [t.n_leaves() for t in few.tree_list()] == [5, 5]
    free, held = (training.fit_model(training.build_model("xgb", {"n_estimators": 1, "max_depth": 2, "reg_alpha": a, "reg_lambda": r}),
                                     table).stages[-1].tree_list()[0] for a, r in ((0.0, 0.0), (1.0, 50.0)))
    assert max(map(abs, held.value)) < max(map(abs, free.value))
    none = training.fit_model(training.build_model("xgb", {"n_estimators": 3, "reg_alpha": 1e6}), table).stages[-1]
    assert none.getNumTrees == 0


def test_stops_while_boosting(table):
    params = {"n_estimators": 60, "learning_rate": 0.5, "num_leaves": 16, "min_child_samples": 2, "patience": 3, "max_bins": 16}
    model = training.fit_model(training.build_model("lgbm", params), table, early_stop=True).stages[-1]
    losses = model.losses
    assert len(losses) == model.getNumTrees + 3 < 60
    assert int(np.argmin(losses)) + 1 == model.getNumTrees
    # the watched losses are those of the prefixes on the stop rows
    flagged = table.withColumn("w", training.class_weights(table)).withColumn("stop", training._stop_flag()).where("stop")
    scored = model.transform(flagged).withColumn("p", training.positive_score())
    loss = F.sum(F.col("w") * F.when(F.col("Target") == 1, -F.log("p")).otherwise(-F.log(1 - F.col("p")))) / F.sum("w")
    assert scored.agg(loss).first()[0] == pytest.approx(min(losses), abs=1e-6)
    together = training.fit_folds(training.build_model("lgbm", params), table, [0, 1, 2], early_stop=True)
    assert all(m.stages[0].getNumTrees < 60 for m in together)


def test_folds_together_equal_folds_alone(table):
    params = {"n_estimators": 5, "learning_rate": 0.3, "max_depth": 3, "max_bins": 16}
    together = training.cv_train("xgb", params, training.Assembled(table, ["a", "b", "c", "d"]))
    assert len(together.fold_aucs) == 3 and together.mean_auc > 0.7
    edges = boosting.bin_edges(table, 4, 16)
    rest = table.where("fold_id <> 2")
    alone = training.fit_model(training.build_model("xgb", params), rest)
    if boosting.bin_edges(rest, 4, 16) == edges:
        assert alone.stages[0].tree_list() == together.models[2].stages[0].tree_list()
    held = training.score(alone, table.where("fold_id = 2"), ["ID", "Target"])
    assert metrics.roc_auc(held).first()["roc_auc"] == pytest.approx(together.fold_aucs[2], abs=0.03)


@pytest.mark.parametrize("depth", [0, 1, 5, 6, 8])
def test_leaf_tables_equal_a_walk(depth):
    """Trees of 1, 2, 32 and 64 leaves by tables, one of more by its nodes; a bin of each column decides."""
    rng = np.random.default_rng(depth)
    t = boosting.Tree(depth=depth)
    todo = [(0, None)]
    while todo:
        deep, parent = todo.pop()
        i = len(t.left)
        if parent is not None:
            (t.right if t.left[parent] >= 0 else t.left)[parent] = i
        inner = deep < depth
        t.feature.append(int(rng.integers(0, 4)) if inner else 0)
        t.bin.append(int(rng.integers(0, 15)) if inner else 0)
        t.at.append(0.0)
        t.value.append(0.0 if inner else float(i))
        t.left.append(-1 if inner else i)
        t.right.append(-1 if inner else i)
        todo += [(deep + 1, i)] * 2 if inner else []
    bins = rng.integers(0, 16, (4, 500)).astype(np.uint8)
    want = []
    for row in bins.T:
        i = 0
        while t.left[i] != i:
            i = t.left[i] if row[t.feature[i]] <= t.bin[i] else t.right[i]
        want.append(t.value[i])
    routes = boosting.Routes(t)
    assert (routes.leaves is None) == (depth == 8)
    assert routes.values_of(boosting.Columns(bins)).tolist() == want


def test_edges_of_many_ranges(spark, monkeypatch):
    """Cut points from a few rows only, ties, one value throughout: the edges are those of exact ranks."""
    monkeypatch.setattr(boosting, "CUT_ROWS", 300)
    monkeypatch.setattr(boosting, "RANGES", 40)
    rng = np.random.default_rng(4)
    x = np.stack([rng.normal(size=3000), rng.integers(0, 5, 3000) * 1.0, np.full(3000, 7.0),
                  np.where(rng.random(3000) < 0.6, 0.0, rng.exponential(size=3000))], axis=1)
    rows = spark.createDataFrame([(r.tolist(),) for r in x], "x array<double>").repartition(3)
    want = []
    for column in x.T:
        values, n = np.unique(column, return_counts=True)
        part = np.ceil(np.cumsum(n) * 16 / 3000)
        want.append([float(v) for v, p, q in zip(values, part, part[1:], strict=False) if p != q])
    assert boosting.bin_edges(rows, 4, 16, "x") == want


def test_passes_read_blocks(spark, table, monkeypatch):
    """A pass gets blocks of rows as they were written: no row of the table is made anew for a task."""
    read = []
    rows = boosting._Boost._rows
    monkeypatch.setattr(boosting._Boost, "_rows", lambda self: read.append(rows(self).count()) or rows(self))
    _fit(table.coalesce(1), BoostSettings(n_estimators=1, max_depth=2, num_leaves=0, max_bins=16))
    assert read and max(read) < 10


def test_blocks_are_kept_between_passes(table, monkeypatch):
    """Passes read kept blocks, equal weights are one column for all seeds, and the trees do not depend on when margins are kept."""
    fit = [F.when(F.col("fold_id") != k, 1.0) for k in range(2)]
    s = BoostSettings(n_estimators=6, learning_rate=0.3, num_leaves=5, subsample=0.7, max_bins=16)

    def trees():
        found = boosting.boost(table, fit * 2, [F.lit(None).cast("double")] * 4, s, seeds=[1, 1, 2, 2])
        return [m.getOrDefault("trees") for m in found]

    want = trees()
    seen = []
    rows = boosting._Boost._rows
    monkeypatch.setattr(boosting._Boost, "_rows", lambda self: seen.append((rows(self).is_cached, len(rows(self).first()[2]))) or rows(self))
    monkeypatch.setattr(boosting, "KEEP_EVERY", 2)
    monkeypatch.setattr(boosting, "WRITE_EVERY", 3)
    monkeypatch.setattr(boosting, "DIRECT", 0)
    monkeypatch.setattr(boosting, "SMALL", 40)
    assert trees() == want and want[0] != want[2]
    assert set(seen) == {(True, 2)}


def test_sums_of_packed_cells():
    rng = np.random.default_rng(5)
    c = rng.integers(0, 7, 500)
    # added up with the counts as one, and too large for that
    for scale in (1 << 20, 1 << 43):
        g, h = np.rint(rng.normal(size=500) * 1000), np.rint(rng.random(500) * scale)
        want = [[sum(int(v) for v, at in zip(x, c, strict=True) if at == i) for i in range(8)] for x in (g, h, np.ones(500))]
        assert boosting._adder(g, h, 8)(c).astype(int).tolist() == want


def test_saved_and_read_again(table, tmp_path):
    model = training.fit_model(training.build_model("catboost", {"n_estimators": 2, "depth": 3}), table)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    a, b = ({r.ID: r.score for r in training.score(m, table, ["ID"]).collect()} for m in (model, again))
    assert a == b and model.stages[0].featureImportances.toArray().sum() == pytest.approx(1.0)


def test_settings_that_cannot_be():
    with pytest.raises(ValueError):
        BoostSettings(num_leaves=0)
    with pytest.raises(ValueError):
        BoostSettings(max_bins=300)
