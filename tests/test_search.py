"""Search spaces as expressions, candidates from densities, and searches that stop early and resume."""

import math
import random

import pytest

from loanloom.operators import search, training


@pytest.mark.parametrize("space", sorted(search.SEARCH_SPACES))
def test_expressions_equal_the_plain_candidates(spark, space):
    table = search.trial_table(spark.range(1), space, 40, seed=7)
    want = search.suggest(space, 40, 7)
    for row in table.collect():
        got = {k: v for k, v in row.asDict().items() if k not in ("id", "trial") and v is not None}
        assert got.keys() == want[row.trial].keys()
        for name, value in want[row.trial].items():
            assert got[name] == (pytest.approx(value, rel=1e-12) if isinstance(value, float) else value)


def test_each_key_has_its_own_candidates(spark):
    keys = spark.createDataFrame([("a",), ("b",), (None,)], "seg string")
    rows = search.trial_table(keys, "xgb", 5, key="seg").collect()
    assert len(rows) == 15 and len({r.learning_rate for r in rows if r.seg}) == 10


def test_density_is_one():
    rng = random.Random(1)
    for n in (0, 1, 2, 7):
        p = search.Parzen([rng.random() for _ in range(n)])
        xs = [(i + 0.5) / 4000 for i in range(4000)]
        assert sum(map(p.density, xs)) / 4000 == pytest.approx(1.0, abs=1e-3)
        for pick in (0.0, 0.5, 0.999):
            draws = [p.draw(pick, (i + 0.5) / 50) for i in range(50)]
            assert draws == sorted(draws) and 0 <= draws[0] and draws[-1] <= 1


def _plain_suggestion(space, done, trial, seed):
    """The rule of a Parzen search once more, spelled out by hand for numbers without conditions."""
    def cdf(x):
        return (1 + math.erf(x / 2 ** 0.5)) / 2

    order = sorted(enumerate(done), key=lambda t: (-t[1][1], t[0]))
    k = max(2, math.ceil(len(done) / 5))
    out = {}
    for name, (kind, low, high) in space.items():
        def unit(v):
            if kind == "int":
                return (v - low + 0.5) / (high - low + 1)
            return math.log(v / low, high / low) if kind == "log" else (v - low) / (high - low)

        def mixture(values):
            values = sorted(values)
            gaps = [b - a for a, b in zip([0, *values], [*values, 1], strict=True)]
            return [(v, min(1, max(1 / min(100, len(values) + 2), gaps[i], gaps[i + 1]))) for i, v in enumerate(values)]

        near, far = mixture([unit(d[0][name]) for _, d in order[:k]]), mixture([unit(d[0][name]) for _, d in order[k:]])

        def height(parts, x):
            return (1 + sum(math.exp(-((x - m) / w) ** 2 / 2) / (w * (2 * math.pi) ** 0.5) / (cdf((1 - m) / w) - cdf(-m / w))
                            for m, w in parts)) / (len(parts) + 1)

        best = None
        for j in range(24):
            i = int(search._unit(seed, trial, f"{name}:{j}:a") * (len(near) + 1))
            x = search._unit(seed, trial, f"{name}:{j}:b")
            if i < len(near):
                m, w = near[i]
                goal, a, b = cdf(-m / w) + x * (cdf((1 - m) / w) - cdf(-m / w)), 0.0, 1.0
                while b - a > 1e-15:
                    c = (a + b) / 2
                    if c in (a, b):
                        break
                    a, b = (c, b) if cdf((c - m) / w) < goal else (a, c)
                x = (a + b) / 2
            ratio = height(near, x) / height(far, x)
            if best is None or ratio > best[0] + 1e-12:
                best = (ratio, x)
        x = best[1]
        out[name] = low + int(x * (high - low + 1)) if kind == "int" else low * (high / low) ** x if kind == "log" else low + (high - low) * x
    return out


SPACE = {"a": ("float", -1.0, 3.0), "b": ("log", 1e-4, 1.0), "c": ("int", 1, 9)}


def _goal(p):
    return -(p["a"] - 2) ** 2 - 0.3 * math.log10(p["b"] / 0.01) ** 2 - 0.05 * (p["c"] - 4) ** 2


def _run(n, seed, draw):
    done = []
    for t in range(n):
        p = draw(done, t, seed)
        done.append((p, _goal(p)))
    return done


def test_sampler_equals_a_plain_one():
    done = _run(12, 3, lambda d, t, s: search.suggest(SPACE, t + 1, s)[t])
    for t in range(12, 30):
        got = search.learned_suggestion(SPACE, done, t, 3)
        want = _plain_suggestion(SPACE, done, t, 3)
        assert got["c"] == want["c"] and got["a"] == pytest.approx(want["a"], abs=1e-9) and got["b"] == pytest.approx(want["b"], rel=1e-9)
        done.append((got, _goal(got)))


def test_finds_an_optimum_sooner_than_chance():
    """Trials until the goal is within 0.05 of the optimum, over some seeds."""
    def trials_needed(draw, seed):
        done = _run(150, seed, draw)
        return next((i for i, (_, v) in enumerate(done) if v > -0.05), 150)

    learned = [trials_needed(lambda d, t, s: search.learned_suggestion(SPACE, d, t, s), seed) for seed in range(6)]
    chance = [trials_needed(lambda d, t, s: search.suggest(SPACE, t + 1, s)[t], seed) for seed in range(6)]
    assert sum(learned) < 0.6 * sum(chance)


def test_choices_and_conditions():
    space = {"kind": ("choice", ["x", "y"]), "depth": ("int", 1, 8, ("kind", "y"))}
    done = [({"kind": "y", "depth": i % 8 + 1} if i % 2 else {"kind": "x"}, float(i % 2) - abs(i % 8 - 4) / 20) for i in range(24)]
    got = [search.learned_suggestion(space, done, t, 1) for t in range(24, 40)]
    assert {g["kind"] for g in got} == {"y"} and all(1 <= g["depth"] <= 8 for g in got)


def test_search_halves_resumes_and_repeats(train, folds, tmp_path, monkeypatch):
    rows = train.join(folds, "ID").select("ID", "Target", "fold_id", "amount_usd", "annual_rate_pct")
    fits = []

    def fake(name, params, ready, variant):
        fits.append(dict(params))
        auc = 0.5 + 0.1 * params["n_estimators"] / 40 - abs(params["learning_rate"] - 0.2)
        return training.CvResult(name, variant, None, None, [auc, auc], 0.0)

    monkeypatch.setattr(training, "cv_train", fake)
    space = {"learning_rate": ("float", 0.01, 0.5)}

    def run(n, path=None):
        return training.adaptive_search("xgb", rows, n, 5, path, space, {"n_estimators": 40}, batch=4)

    path = str(tmp_path / "t")
    best, table = run(16, path)
    got = table.collect()
    assert [sum(r.rung == k for r in got) for k in (0, 1)] == [16, 8]
    assert sorted({f["n_estimators"] for f in fits}) == [10, 40] and len(fits) == 24
    assert abs(best["learning_rate"] - 0.2) < 0.1
    fits.clear()
    again, more = run(16, path)
    assert not fits and again == best and more.count() == 24
    longer, _ = run(20, path)
    assert len(fits) == 6
    fits.clear()
    fresh, _ = run(20)
    assert fresh == longer and len(fits) == 30


def test_search_on_rows(train, folds):
    rows = train.join(folds, "ID").select("ID", "Target", "fold_id", "amount_usd", "annual_rate_pct")
    best, table = training.adaptive_search("xgb", rows, 2, space={"max_depth": ("int", 2, 3)}, fixed={"n_estimators": 4}, batch=2)
    assert table.count() == 3 and best["max_depth"] in (2, 3)
