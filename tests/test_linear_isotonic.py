"""Linear learners of all folds, pooled calibration by ranges and blend search against closed forms and plain loops."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import functions as F

from loanloom.operators import ensemble, isotonic, linear, metrics, training
from loanloom.session import materialize


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(12)
    x = np.c_[rng.random(400), rng.random(400).round(1), rng.standard_normal(400) * 1e4]
    y = (rng.random(400) < 1 / (1 + np.exp(-(3 * x[:, 0] - 2 * x[:, 1])))).astype(int)
    return x, y, np.arange(400) % 4


@pytest.fixture(scope="module")
def table(spark, data):
    rows = [(str(i), int(t), int(k), *map(float, v)) for i, (v, t, k) in enumerate(zip(*data, strict=True))]
    return materialize(spark.createDataFrame(rows, "ID string, Target int, fold_id int, a double, b double, c double").repartition(5))


def test_ridge_of_all_folds(table, data):
    x, y, k = data
    got = linear.ridge_folds(table, ["a", "b"], 2.0)
    for fold, (beta, intercept) in got.items():
        xs, ys = x[k != fold, :2], y[k != fold]
        xc = xs - xs.mean(0)
        want = np.linalg.solve(xc.T @ xc + 2 * np.eye(2), xc.T @ (ys - ys.mean()))
        assert beta == pytest.approx(want, abs=1e-10) and intercept == pytest.approx(ys.mean() - xs.mean(0) @ want, abs=1e-10)
    with pytest.raises(ValueError):
        linear.ridge_of_moments(np.zeros((4, 4)), 1.0)


def _optimum(x, y, w, penalty):
    xa = np.c_[np.ones(len(x)), x]
    beta, held = np.zeros(xa.shape[1]), np.diag([0.0, *[penalty] * x.shape[1]])
    for _ in range(200):
        p = 1 / (1 + np.exp(-xa @ beta))
        step = np.linalg.solve((xa * (w * p * (1 - p))[:, None]).T @ xa + held, xa.T @ (w * (p - y)) + held @ beta)
        beta -= step
        if abs(step).max() < 1e-14:
            break
    return beta


def test_logistic_fits_of_all_folds(table, data):
    x, y, k = data
    weights = [F.when(F.col("fold_id") != f, F.when(F.col("Target") == 1, 1.7).otherwise(0.6)) for f in range(4)]
    got = linear.logistic_fits(table, F.array("a", "b", "c"), weights, 0.5)
    for f, (beta, intercept) in enumerate(got):
        rows = k != f
        want = _optimum(x[rows], y[rows], np.where(y[rows] == 1, 1.7, 0.6), 0.5)
        assert np.r_[intercept, beta] == pytest.approx(want, rel=1e-7, abs=1e-10)
    with pytest.raises(ValueError):
        linear.logistic_fits(table, F.array("a"), [F.lit(0.0)], 1.0)


def test_separated_labels_still_end(spark):
    rows = [(i, int(i > 10), float(i)) for i in range(20)]
    df = spark.createDataFrame(rows, "ID int, Target int, a double")
    beta, intercept = linear.logistic_fits(df, F.array("a"), [F.lit(1.0)], 1e-3)[0]
    want = _optimum(np.array([[float(i)] for i in range(20)]), np.array([int(i > 10) for i in range(20)]), np.ones(20), 1e-3)
    assert np.r_[intercept, beta] == pytest.approx(want, rel=1e-5)


def test_folds_in_common_passes_equal_single_fits(table, tmp_path):
    ready = training.Assembled(training.assemble(table, ["a", "b"]), ["a", "b"])
    result = training.cv_train("lr", {"C": 0.7}, ready)
    for k, model in enumerate(result.models):
        alone = training.fit_model(training.build_model("lr", {"C": 0.7}), ready.rows.where(F.col("fold_id") != k)).stages[-1]
        assert model.stages[0].coefficients == pytest.approx(alone.coefficients.toArray(), abs=1e-6)
        assert model.stages[0].intercept == pytest.approx(alone.intercept, abs=1e-6)
    result.models[0].write().save(str(tmp_path / "lr"))
    again = PipelineModel.load(str(tmp_path / "lr"))
    a, b = (training.score(m, ready.rows, ["ID"]).orderBy("ID").collect() for m in (result.models[0], again))
    assert a == b


@pytest.fixture(scope="module")
def scores(spark):
    rng = np.random.default_rng(2)
    s = np.r_[rng.random(700), rng.random(300).round(1), np.full(200, 0.5)]
    y = (rng.random(len(s)) < 0.2 + 0.5 * s + 0.2 * np.sin(9 * s)).astype(int)
    rows = [(str(i), int(t), float(v)) for i, (v, t) in enumerate(zip(s, y, strict=True))]
    return spark.createDataFrame([*rows, ("n", 1, None), ("m", None, 0.3)], "ID string, Target int, score double").repartition(6)


def _pooled(rows):
    """Sequential pooling of (score, label) pairs."""
    cells = {}
    for s, y in rows:
        t = cells.setdefault(s, [0, 0])
        t[0] += y
        t[1] += 1
    out = []
    for s in sorted(cells):
        out.append([s, s, *cells[s]])
        while len(out) > 1 and out[-2][2] / out[-2][3] >= out[-1][2] / out[-1][3]:
            b = out.pop()
            out[-1] = [out[-1][0], b[1], out[-1][2] + b[2], out[-1][3] + b[3]]
    return [(a, b, t / n, n) for a, b, t, n in out]


@pytest.mark.parametrize("buckets", [1, 2, 7, 20, 64])
def test_blocks_equal_sequential_pooling(scores, buckets, monkeypatch):
    monkeypatch.setattr(isotonic, "FAN", 3)
    want = _pooled([(r.score, r.Target) for r in scores.dropna().collect()])
    got = [tuple(r) for r in isotonic.isotonic_blocks(scores, buckets=buckets).orderBy("low").collect()]
    assert got == want


def test_calibrated_scores(scores, spark):
    blocks = isotonic.isotonic_blocks(scores, buckets=5)
    points = scores.dropna().groupBy("score").agg(F.avg("Target").alias("y"), F.count("*").cast("double").alias("w"))
    theirs = IsotonicRegression(featuresCol="score", labelCol="y", weightCol="w").fit(points)
    asked = spark.createDataFrame([(str(i), -0.2 + i / 700, "x", "y") for i in range(1000)], "ID string, score double, _bucket string, _w string")
    want = {r.ID: r.prediction for r in theirs.transform(asked.select("ID", "score")).collect()}
    got = {r.ID: r.score for r in isotonic.apply_blocks(asked, blocks).collect()}
    assert got == pytest.approx(want, abs=1e-12)
    plain = asked.select("ID", "score").union(spark.createDataFrame([("null", None)], "ID string, score double"))
    by_range = {r.ID: r.score for r in isotonic.apply_blocks(plain, blocks, limit=0).collect()}
    assert by_range.pop("null") is None
    assert by_range == pytest.approx(want, abs=1e-12)


def test_blend_search_without_copies(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = []
    for i in range(900):
        y = int(rng.random() < 0.3)
        rows.append((str(i), y, *[float(np.clip(0.4 + 0.1 * w * y + 0.2 * rng.standard_normal(), 0, 1).round(d)) for w, d in
                                  ((1, 1), (2, 6), (0.5, 2))]))
    wide = spark.createDataFrame([*rows, ("z", 1, None, 0.1, 0.2)], "ID string, Target int, m0 double, m1 double, m2 double").repartition(4)
    models = ["m0", "m1", "m2"]
    trials = [*ensemble.trial_weights(models, 40), {"m0": 0.0, "m1": 0.0, "m2": 0.0}, {"m0": 1.0, "m1": 0.0, "m2": 0.0}]
    exact = ensemble.search_trials(wide.dropna(), [ensemble._mix(t) for t in trials], screen=False)
    want = {r.trial: r.roc_auc for r in exact.collect()}
    for name, value in (("FINE_BINS", 64), ("FINE_TRIALS", 5), ("SCREEN_TRIALS", 9)):
        monkeypatch.setattr(ensemble, name, value)
    for bins in (4, 4096):
        got = {r.trial: r.roc_auc for r in ensemble.blend_aucs(wide, models, trials, bins=bins).collect()}
        assert max(got.values()) == pytest.approx(max(want.values()), abs=1e-12)
        assert all(v == pytest.approx(want[t], abs=1e-12) for t, v in got.items())
        assert len(got) < len(trials) or bins == 4
    best, _ = ensemble.weight_search(wide.dropna(), models, 40)
    top = max(range(40), key=lambda i: (want[i], -i))
    assert best == pytest.approx({m: w / sum(trials[top].values()) for m, w in trials[top].items()})
    assert metrics.roc_auc(ensemble.blend(wide.dropna(), best)).first()["roc_auc"] == pytest.approx(want[top])
