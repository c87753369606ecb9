import numpy as np
import pytest
from pyspark.sql import functions as F

from loanloom.operators import metrics, training
from loanloom.operators.features import BaseFeatureEngineer
from loanloom.operators.folds import holdout_split
from loanloom.operators.ordered import medians
from loanloom.plans import runs
from loanloom.sources import sinks
from loanloom.streaming import scoring

TREES = {"n_estimators": 4, "max_depth": 3, "learning_rate": 0.3}


@pytest.fixture(scope="module")
def base(train, test_set, folds):
    eng = BaseFeatureEngineer(ranks=False).fit(train)
    return eng, eng.transform(train).join(folds, "ID").persist(), eng.transform(test_set).persist()


def test_unknown_model():
    with pytest.raises(ValueError):
        training.build_model("nope")


@pytest.mark.parametrize("name,params", [
    ("lr", {"max_iter": 5}), ("rf", {"n_estimators": 3, "max_depth": 3}), ("xgb", TREES),
    ("mlp", {"hidden_dims": [4], "max_iter": 5})])
def test_every_kind_scores_all_rows(base, name, params):
    _, tr, te = base
    cols = training.numeric_columns(tr)
    model = training.fit_model(training.build_model(name, params, len(cols)), training.assemble(tr, cols))
    got = training.score(model, training.assemble(te, cols, ("ID",)), ["ID"])
    s = got.agg(F.count("score"), F.min("score"), F.max("score")).first()
    assert s[0] == 50 and 0 <= s[1] <= s[2] <= 1


def test_parameter_names_of_other_learners():
    spec = training.build_model("catboost", {"iterations": 7, "depth": 4, "l2_leaf_reg": 1.0})
    assert spec.estimator.getMaxIter() == 7 and spec.estimator.getMaxDepth() == 4
    assert spec.estimator.boost_settings().reg_lambda == 1.0
    assert training.build_model("lgbm", {"num_leaves": 31}).estimator.boost_settings().leaves == 31


def test_settings_are_never_swallowed():
    with pytest.raises(ValueError, match="n_estimatorz"):
        training.build_model("xgb", {"n_estimatorz": 5})
    with pytest.warns(UserWarning, match="random_strength"):
        assert training.build_model("catboost", {"random_strength": 1.0}).ignored == ["random_strength"]


def test_best_prefix():
    assert training.best_prefix([5, 4, 3, 3.5, 2.9, 3, 3, 3, 2], 3) == 5
    assert training.best_prefix([5, 4, 3, 3.5, 2.9, 3, 3, 3, 2], 4) == 9
    assert training.best_prefix([1.0], 10) == 1


def test_early_stopping_keeps_learning(spark):
    """Small steps gain little each; they go on as long as the stop rows gain at all."""
    rng = np.random.default_rng(1)
    x = rng.standard_normal((1500, 3))
    y = (rng.random(1500) < 1 / (1 + np.exp(-(2 * x[:, 0] - x[:, 1] * x[:, 2])))).astype(int)
    rows = [(str(i), int(t), *map(float, v)) for i, (v, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "ID string, Target int, a double, b double, c double")
    table = training.assemble(df, ["a", "b", "c"])
    params = {"n_estimators": 25, "max_depth": 3, "learning_rate": 0.1}
    stopped = training.fit_model(training.build_model("lgbm", params), table, early_stop=True).stages[-1]
    assert 10 < stopped.getNumTrees <= 25
    assert training.fit_model(training.build_model("xgb", params), table, early_stop=True).stages[-1].getNumTrees == 25
    short = training.build_model("catboost", {**params, "learning_rate": 1.0, "max_depth": 6, "patience": 2})
    assert training.fit_model(short, table, early_stop=True).stages[-1].getNumTrees < 25


def test_balanced_weights(train):
    w = train.withColumn("w", training.class_weights(train)).groupBy("Target").agg(F.sum("w").alias("s")).collect()
    assert w[0]["s"] == pytest.approx(w[1]["s"]) == pytest.approx(100.0)


def test_logistic_regression_optimum(spark):
    """Same penalty as C on the sum of weighted losses."""
    rng = np.random.default_rng(0)
    x = rng.standard_normal((300, 2))
    y = (rng.random(300) < 1 / (1 + np.exp(-(x @ [1.0, -0.5] - 1)))).astype(int)
    df = spark.createDataFrame([(str(i), int(t), float(a), float(b)) for i, ((a, b), t) in enumerate(zip(x, y))],
                               "ID string, Target int, a double, b double")
    m = training.fit_model(training.build_model("lr"), training.assemble(df, ["a", "b"])).stages[-1]
    w = np.where(y == 1, 300 / (2 * y.sum()), 300 / (2 * (300 - y.sum())))
    beta = np.zeros(3)
    xa = np.c_[x, np.ones(300)]
    for _ in range(50):
        p = 1 / (1 + np.exp(-xa @ beta))
        g = xa.T @ (w * (p - y)) + np.r_[beta[:2], 0]
        h = (xa * (w * p * (1 - p))[:, None]).T @ xa + np.diag([1, 1, 0])
        beta -= np.linalg.solve(h, g)
    assert np.r_[m.coefficients.toArray(), m.intercept] == pytest.approx(beta, abs=1e-4)


def test_cv_scores(base):
    _, tr, te = base
    r = training.cv_train("xgb", TREES, tr, te, early_stop=True)
    assert r.oof.count() == 200 and r.oof.select("ID").distinct().count() == 200
    assert len(r.fold_aucs) == 5 and len(r.models) == 5
    assert r.test.count() == 50
    each = [training.score(m, training.assemble(te, r.features, ("ID",)), ["ID"]).toPandas().set_index("ID")["score"]
            for m in r.models]
    want = sum(each) / 5
    got = r.test.toPandas().set_index("ID")["score"]
    assert (got - want).abs().max() < 1e-12
    row = r.metrics_row().first()
    assert row["mean_auc"] == pytest.approx(np.mean(r.fold_aucs)) and row["std_auc"] == pytest.approx(np.std(r.fold_aucs))


def test_held_out_rows_are_scored_by_models_that_never_saw_them(base):
    """Labels of one fold do not change the scores of that fold, encoding included."""
    _, tr, _ = base
    cols = ["province", "employment_sector"]
    a = training.cv_train_encoded("lr", {"max_iter": 10}, tr, None, cols, features=["province", "amount_usd"])
    other = tr.withColumn("Target", F.when(F.col("fold_id") == 2, 1 - F.col("Target")).otherwise(F.col("Target")))
    b = training.cv_train_encoded("lr", {"max_iter": 10}, other, None, cols, features=["province", "amount_usd"])
    x = a.oof.where("fold_id = 2").select("ID", "score").toPandas().set_index("ID").sort_index()
    y = b.oof.where("fold_id = 2").select("ID", "score").toPandas().set_index("ID").sort_index()
    assert (x["score"] - y["score"]).abs().max() < 1e-9


def test_train_models_skips_unknown_variants(base):
    _, tr, te = base
    done = training.train_models([("lr", "base", {"max_iter": 5}), ("rf", "absent", {})], {"base": (tr, te)})
    assert [r.model for r in done] == ["lr"]


def test_importances(base):
    _, tr, _ = base
    cols = ["annual_rate_pct", "amount_usd", "term_months"]
    model = training.fit_model(training.build_model("xgb", TREES), training.assemble(tr, cols))
    imp = training.feature_importances(model, cols, top=2).collect()
    assert len(imp) == 2 and imp[0]["importance"] >= imp[1]["importance"]
    drop = {r["feature"]: r["auc_drop"] for r in
            training.permutation_importance(model, tr, cols).collect()}
    assert set(drop) == set(cols)


def test_search_resumes_its_own_trials_only(base, tmp_path, monkeypatch):
    _, tr, _ = base
    path = str(tmp_path / "trials")
    space = {"max_depth": ("int", 2, 3), "learning_rate": ("float", 0.1, 0.3)}
    small = tr.select("ID", "Target", "fold_id", "amount_usd", "annual_rate_pct")
    runs_ = []
    real = training.cv_train
    monkeypatch.setattr(training, "cv_train", lambda *a, **k: (runs_.append(a[1]), real(*a, **k))[1])
    search = lambda n, rows=small, seed=42, space=space, variant="a": training.tune_model(
        "xgb", rows, n, seed=seed, trials_path=path, space=space, fixed={"n_estimators": 2}, variant=variant)
    search(1)
    best, table = search(2)
    assert sorted(r["trial"] for r in table.collect()) == [0, 1] and 2 <= best["max_depth"] <= 3
    before = len(runs_)
    search(2)
    assert len(runs_) == before
    for other in (dict(rows=small.where("ID <> 'TR00003'")), dict(variant="b"), dict(space={"max_depth": ("int", 4, 5)})):
        before = len(runs_)
        best, table = search(1, **other)
        assert len(runs_) == before + 1 and table.count() == 1
    assert best["max_depth"] in (4, 5)


def test_training_table_is_written_once(base, monkeypatch):
    _, tr, te = base
    written = []
    real = training.training_table
    monkeypatch.setattr(training, "training_table", lambda df: (written.append(1), real(df))[1])
    small = tr.select("ID", "Target", "fold_id", "amount_usd", "annual_rate_pct")
    training.multi_seed("catboost", {**TREES, "n_estimators": 2}, small, te, [0, 1, 2])
    assert len(written) == 1
    training.tune_model("xgb", small, 3, space={"max_depth": ("int", 2, 9)}, fixed={"n_estimators": 1})
    assert len(written) == 2


def test_drift_check_keeps_shared_ids_apart(train):
    row = training.adversarial_validation(train, train.drop("Target"), 2, params=TREES).first()
    assert row["mean_auc"] < 0.6 and not row["shifted"]


def test_drift_check_sees_a_shift(train, test_set):
    shifted = test_set.withColumn("amount_usd", F.col("amount_usd") + 60000)
    row = training.adversarial_validation(train, shifted, 2, params=TREES).first()
    assert row["mean_auc"] > 0.9 and row["shifted"]


def test_baseline(train, test_set):
    cols = ["amount_usd", "annual_rate_pct"]
    report, scores = training.baseline(train, test_set, cols, medians(train, cols), holdout_split(train))
    assert report.count() == 1 and scores.count() == 50


def test_sparse_one_hot(train):
    out = training.sparse_one_hot(["province"]).fit(train).transform(train)
    assert out.select("features").first()[0].size >= 5


def test_saved_model_scores_batch_and_stream(spark, base, train, test_set, tmp_path):
    eng, tr, _ = base
    cols = training.numeric_columns(tr)
    model = training.fit_model(training.build_model("lr", {"max_iter": 5}), training.assemble(tr, cols))
    again = sinks.load_model(sinks.save_model(model, str(tmp_path / "model")))
    want = scoring.score_rows(test_set, eng, again, cols).toPandas().set_index("ID")["score"].sort_index()
    test_set.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(test_set.schema).parquet(str(tmp_path / "in"))
    q = scoring.start_scoring(stream, str(tmp_path / "out"), str(tmp_path / "ckpt"),
                              engineer=eng, model=again, cols=cols)
    q.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).toPandas().set_index("ID")["score"].sort_index()
    assert (got - want).abs().max() < 1e-12 and len(got) == 50
    with pytest.raises(ValueError):
        scoring.score_rows(stream, BaseFeatureEngineer().fit(train), again, cols)


def test_full_run_from_files(spark, tmp_path):
    from conftest import loan_row
    from test_sources import _write_csv

    _write_csv(tmp_path / "Train.csv", [loan_row(i) for i in range(200)])
    _write_csv(tmp_path / "Test.csv", [loan_row(i, True) for i in range(50)])
    with open(tmp_path / "SampleSubmission.csv", "w") as f:
        f.write("ID,Target\n" + "".join(f"TT{i:05d},0\n" for i in range(50)))
    options = runs.RunOptions(
        models=[("lr", "v2_ordinal", {"max_iter": 5}), ("xgb", "v3_target_woe", TREES), ("rf", "absent", {})],
        n_folds=2, blend_trials=3, out_dir=str(tmp_path / "out"), engineer={"ranks": False})
    result = runs.run_files(spark, str(tmp_path), options)
    assert result.best_method in ("rank_avg", "stacking", "weight_blend")
    assert result.model_metrics.count() == 2 and result.ensemble_metrics.count() == 1
    out = spark.read.option("header", True).csv(result.submission_path)
    assert out.count() == 50 and out.columns == ["ID", "Target"]
    assert spark.read.json(str(tmp_path / "out" / "training")).count() == 2


def test_error_report(spark):
    rows = spark.createDataFrame(
        [(str(i), i % 2, (i * 37 % 100) / 100, f"p{i % 2 * (i % 3)}", 30.0 + i % 20) for i in range(200)],
        "ID string, Target int, score double, province string, annual_rate_pct double")
    report = runs.error_report(rows)
    assert set(report) == {"calibration", "histogram", "roc", "auc_by_province", "auc_by_rate_band"}
    assert all(df.count() > 0 for df in report.values())
    assert metrics.roc_auc(rows).first()["n"] == 200
