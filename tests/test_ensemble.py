import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loanloom.operators import ensemble as en
from loanloom.operators import linear, metrics, search, stacking
from loanloom.operators.folds import make_folds
from loanloom.operators.training import build_model

MODELS = ["m0", "m1", "m2"]


@pytest.fixture(scope="module")
def wide(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(500):
        y = int(rng.random() < 0.35)
        s = [float(np.clip(0.4 + 0.12 * y * w + 0.2 * rng.standard_normal(), 0, 1)) for w in (1, 2, 0.3)]
        rows.append((f"I{i}", y, round(s[0], 2), s[1], s[2]))
    df = spark.createDataFrame(rows, "ID string, Target int, m0 double, m1 double, m2 double")
    return df.join(make_folds(df), "ID").persist()


@pytest.fixture(scope="module")
def long(wide):
    return wide.unpivot(["ID", "Target", "fold_id"], MODELS, "model", "score").persist()


def _auc(y, s):
    d = s[y == 1][:, None] - s[y == 0][None, :]
    return ((d > 0).sum() + 0.5 * (d == 0).sum()) / d.size


def test_wide_and_long(wide, long):
    back = en.wide_scores(long, MODELS).toPandas().set_index("ID").sort_index()
    want = wide.toPandas().set_index("ID").sort_index()
    pd.testing.assert_frame_equal(back[MODELS], want[MODELS])


def test_rank_average(wide, long):
    got = en.rank_average(long).toPandas().set_index("ID")["score"].sort_index()
    pdf = wide.toPandas().set_index("ID").sort_index()
    want = pdf[MODELS].rank(pct=True).mean(axis=1)
    pd.testing.assert_series_equal(got, want, check_names=False, rtol=1e-12)
    with pytest.raises(ValueError):
        en.rank_average(long, models=[])


def test_bounds_enclose_the_auc(wide, long):
    exact = {r["model"]: r["roc_auc"] for r in metrics.roc_auc(long, keys=["model"]).collect()}
    for bins in (4, 64, 4096):
        for r in en.auc_bounds(long, keys=["model"], bins=bins).collect():
            assert r["low"] - 1e-12 <= exact[r["model"]] <= r["high"] + 1e-12


def test_screening_keeps_the_best_trial(wide):
    _, every = en.weight_search(wide, MODELS, 30, screen=False)
    weights, kept = en.weight_search(wide, MODELS, 30)
    full = {r["trial"]: r["roc_auc"] for r in every.collect()}
    some = {r["trial"]: r["roc_auc"] for r in kept.collect()}
    assert len(full) == 30 and 1 <= len(some) < 30
    top = max(full.values())
    assert max(some.values()) == top
    assert all(full[t] == a for t, a in some.items())
    assert sum(weights.values()) == pytest.approx(1.0)
    pdf = wide.toPandas()
    mix = sum(pdf[m] * w for m, w in weights.items())
    assert _auc(pdf["Target"].to_numpy(), mix.to_numpy()) == pytest.approx(top, rel=1e-9)


def test_zero_weights_score_one_half(wide):
    aucs = en.search_trials(wide, [en._mix({"m0": 0.0, "m1": 0.0})], screen=False).collect()
    assert aucs[0]["roc_auc"] == 0.5


def test_pairs_and_subsets(wide, long):
    pdf = wide.toPandas()
    y = pdf["Target"].to_numpy()
    ranks = pdf[MODELS].rank()
    for r in en.pair_aucs(long, MODELS).collect():
        want = _auc(y, (ranks[r["model_a"]] + ranks[r["model_b"]]).to_numpy())
        assert r["roc_auc"] == pytest.approx(want, rel=1e-12)
    got = {r["subset"]: r["roc_auc"] for r in en.subset_aucs(long, {"all": MODELS}).collect()}
    assert got["all"] == pytest.approx(_auc(y, ranks.sum(axis=1).to_numpy()), rel=1e-12)


def test_greedy_matches_brute_force(wide, long):
    got = en.greedy_selection(long, "m2", ["m0", "m1"])
    pdf = wide.toPandas()
    y, ranks = pdf["Target"].to_numpy(), pdf[MODELS].rank()
    chosen, current, left = ["m2"], _auc(y, ranks["m2"].to_numpy()), ["m0", "m1"]
    while left:
        trial = {c: _auc(y, ranks[[*chosen, c]].mean(axis=1).to_numpy()) for c in left}
        best = max(trial, key=trial.get)
        if trial[best] <= current + 1e-7:
            break
        chosen.append(best)
        left.remove(best)
        current = trial[best]
    assert [m for m, _ in got] == chosen
    assert got[-1][1] == pytest.approx(current, rel=1e-12)


def test_mean_of_ranks(wide):
    a, b = (wide.select("ID", "Target", F.col(m).alias("score")) for m in ("m0", "m1"))
    got = en.mean_of_ranks([a, b]).toPandas().set_index("ID")["score"].sort_index()
    pdf = wide.toPandas().set_index("ID").sort_index()
    want = (pdf["m0"].rank() + pdf["m1"].rank()) / (2 * len(pdf))
    pd.testing.assert_series_equal(got, want, check_names=False, rtol=1e-12)


def test_ridge_equals_the_closed_form(wide):
    beta, intercept = linear.ridge_of_moments(sum(linear.fold_moments(wide, MODELS).values()), 1.0)
    pdf = wide.toPandas()
    x, y = pdf[MODELS].to_numpy(), pdf["Target"].to_numpy(float)
    xc, yc = x - x.mean(0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + np.eye(3), xc.T @ yc)
    assert beta == pytest.approx(want, abs=1e-9)
    assert intercept == pytest.approx(y.mean() - x.mean(0) @ want, abs=1e-9)


def test_stacking_is_cross_fitted_and_option_is_not(wide):
    oof, test = stacking.stack(wide, wide, MODELS)
    inside, _ = stacking.stack(wide, wide, MODELS, in_sample=True)
    assert oof.count() == 500 and test.count() == 500
    both = oof.join(inside.withColumnRenamed("score", "s2"), ["ID", "Target"])
    assert both.where("abs(score - s2) > 1e-6").count() > 0
    assert metrics.roc_auc(oof).first()["roc_auc"] > 0.6
    ridge, ridge_test = stacking.ridge_stack(wide, wide, MODELS)
    assert ridge.count() == 500 and ridge_test.count() == 500


def test_calibration(wide):
    s = wide.select("ID", "Target", F.col("m1").alias("score"))
    t = s.select("ID", (F.col("score") * 3 - 1).alias("score"))
    cal, test = stacking.platt(s, t)
    assert metrics.roc_auc(cal).first()["roc_auc"] == pytest.approx(metrics.roc_auc(s).first()["roc_auc"])
    iso, iso_test = stacking.isotonic(s, t)
    pairs = iso.join(s.withColumnRenamed("score", "raw"), ["ID", "Target"]).orderBy("raw").toPandas()
    assert (pairs["score"].diff().dropna() >= -1e-12).all()
    lo, hi = pairs["score"].min(), pairs["score"].max()
    assert iso_test.where((F.col("score") < lo - 1e-12) | (F.col("score") > hi + 1e-12)).count() == 0


def test_method_selection(wide, long):
    test = long.select("ID", "model", "score")
    best, oof, scores, aucs = stacking.select_ensemble(long, test, MODELS, n_trials=5)
    table = {r["method"]: r["roc_auc"] for r in aucs.collect()}
    assert set(table) == {"rank_avg", "stacking", "weight_blend"} and table[best] == max(table.values())
    assert oof.count() == 500 and scores.count() == 500
    name, one, _, _ = stacking.select_ensemble(long, test, ["m1"])
    assert name == "single" and one.count() == 500


def test_search_spaces():
    a = search.suggest("lgbm", 20, 1)
    assert a == search.suggest("lgbm", 20, 1) != search.suggest("lgbm", 20, 2)
    for p in a:
        assert 20 <= p["num_leaves"] <= 300 and 1e-4 <= p["learning_rate"] <= 0.3
    deep = search.suggest({"grow_policy": ("choice", ["SymmetricTree", "Lossguide"]),
                           "max_leaves": ("int", 16, 64, ("grow_policy", "Lossguide"))}, 40)
    assert {p["grow_policy"] for p in deep} == {"SymmetricTree", "Lossguide"}
    assert all(("max_leaves" in p) == (p["grow_policy"] == "Lossguide") for p in deep)
    with pytest.raises(ValueError):
        search.suggest("nope", 1)
    # every parameter of a space is one that the model reads
    for space in search.SEARCH_SPACES:
        build_model(space.split("_")[0], search.suggest(space, 1)[0])


def test_units_follow_the_stated_rule(spark):
    from loanloom.functions.text import unit_from_md5

    got = spark.range(1).select(unit_from_md5(F.lit("42:3:w1"))).first()[0]
    assert got == search.unit_values(["w1"], 4, 42)[3]["w1"]
