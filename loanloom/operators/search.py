"""Search spaces: seeded random candidates, the same as JVM expressions, and candidates that learn from finished trials."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _unit(seed: int, trial: int, name: str) -> float:
    text = f"{seed}:{trial}:{name}".encode()
    return int(hashlib.md5(text).hexdigest()[:7], 16) / 16**7


def unit_values(names: Sequence[str], n_trials: int, seed: int = 42) -> list[dict[str, float]]:
    """Numbers in [0, 1) per trial and name, from the md5 of seed, trial and name."""
    return [{n: _unit(seed, t, n) for n in names} for t in range(n_trials)]


# Search ranges as (kind, low, high), (kind, choices), or a
# condition on another parameter as the last item. Parameters that the
# learners have no counterpart for are left out.
SEARCH_SPACES: dict[str, dict[str, tuple]] = {
    "lgbm": {
        "n_estimators": ("int", 100, 2000),
        "num_leaves": ("int", 20, 300),
        "learning_rate": ("log", 1e-4, 0.3),
        "min_child_samples": ("int", 5, 100),
        "subsample": ("float", 0.5, 1.0),
        "colsample_bytree": ("float", 0.5, 1.0),
        "reg_alpha": ("log", 1e-8, 10.0),
        "reg_lambda": ("log", 1e-8, 10.0),
    },
    "xgb": {
        "n_estimators": ("int", 100, 2000),
        "max_depth": ("int", 3, 12),
        "learning_rate": ("log", 1e-4, 0.3),
        "subsample": ("float", 0.5, 1.0),
        "colsample_bytree": ("float", 0.5, 1.0),
        "reg_alpha": ("log", 1e-8, 10.0),
        "reg_lambda": ("log", 1e-8, 10.0),
    },
    "catboost": {
        "iterations": ("int", 100, 2000),
        "depth": ("int", 3, 10),
        "learning_rate": ("log", 1e-4, 0.3),
        "l2_leaf_reg": ("log", 1e-8, 10.0),
    },
    "lgbm_wide": {
        "num_leaves": ("int", 15, 127),
        "learning_rate": ("log", 0.005, 0.1),
        "min_child_samples": ("int", 5, 100),
        "subsample": ("float", 0.5, 1.0),
        "colsample_bytree": ("float", 0.3, 1.0),
        "reg_alpha": ("log", 1e-8, 10.0),
        "reg_lambda": ("log", 1e-8, 10.0),
        "min_split_gain": ("float", 0.0, 1.0),
        "max_depth": ("int", -1, 12),
    },
    "xgb_wide": {
        "max_depth": ("int", 3, 10),
        "learning_rate": ("log", 0.005, 0.1),
        "min_child_weight": ("int", 1, 50),
        "subsample": ("float", 0.5, 1.0),
        "colsample_bytree": ("float", 0.3, 1.0),
        "reg_alpha": ("log", 1e-8, 10.0),
        "reg_lambda": ("log", 1e-8, 10.0),
        "gamma": ("float", 0.0, 5.0),
    },
    "catboost_deep": {
        "depth": ("int", 4, 10),
        "learning_rate": ("log", 0.01, 0.1),
        "l2_leaf_reg": ("float", 1.0, 30.0),
        "border_count": ("int", 32, 255),
        "min_data_in_leaf": ("int", 1, 100),
        "grow_policy": ("choice", ["SymmetricTree", "Lossguide"]),
        "max_leaves": ("int", 16, 64, ("grow_policy", "Lossguide")),
    },
}
# End of fixed values.


def _value(rule: tuple, u: float) -> Any:
    kind = rule[0]
    if kind == "choice":
        return rule[1][int(u * len(rule[1]))]
    low, high = rule[1], rule[2]
    if kind == "int":
        return low + int(u * (high - low + 1))
    if kind == "log":
        return low * (high / low) ** u
    return low + (high - low) * u


def suggest(space: str | dict[str, tuple], n_trials: int, seed: int = 42) -> list[dict[str, Any]]:
    """Parameter sets of a space; conditional ones only where their condition holds."""
    if isinstance(space, str):
        if space not in SEARCH_SPACES:
            raise ValueError(f"No search space for '{space}'.")
        space = SEARCH_SPACES[space]
    out = []
    for units in unit_values(list(space), n_trials, seed):
        picked: dict[str, Any] = {}
        for name, rule in space.items():
            if isinstance(rule[-1], tuple) and picked.get(rule[-1][0]) != rule[-1][1]:
                continue
            picked[name] = _value(rule, units[name])
        out.append(picked)
    return out


def _condition(rule: tuple) -> tuple[str, Any] | None:
    return rule[-1] if isinstance(rule[-1], tuple) else None


def unit_expression(seed: int, trial: Column, name: str, key: Column | None = None) -> Column:
    """The number in [0, 1) of a trial and parameter as an expression; ``key`` gives each key its own numbers."""
    parts = [F.lit(f"{seed}:"), *([key.cast("string"), F.lit(":")] if key is not None else []), trial.cast("string"), F.lit(f":{name}")]
    digits = F.substring(F.md5(F.concat(*parts).cast("binary")), 1, 7)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(16**7))


def trial_table(rows: DataFrame, space: str | dict[str, tuple], n_trials: int, seed: int = 42, key: str | None = None) -> DataFrame:
    """``rows`` times ``n_trials``: (columns of ``rows``, trial, one column for each parameter), drawn in the JVM.

    Without ``key`` every row gets the candidates that ``suggest`` gives; with
    it, candidates of its own. A parameter whose condition does not hold is null.
    """
    space = SEARCH_SPACES[space] if isinstance(space, str) else space
    out = rows.withColumn("trial", F.explode(F.sequence(F.lit(0), F.lit(n_trials - 1))))
    for name, rule in space.items():
        u = unit_expression(seed, F.col("trial"), name, F.col(key) if key else None)
        kind = rule[0]
        if kind == "choice":
            value = F.element_at(F.array(*[F.lit(c) for c in rule[1]]), F.floor(u * len(rule[1])).cast("int") + 1)
        elif kind == "int":
            value = F.floor(u * (rule[2] - rule[1] + 1)).cast("int") + F.lit(rule[1])
        elif kind == "log":
            value = F.lit(float(rule[1])) * F.pow(F.lit(float(rule[2])) / F.lit(float(rule[1])), u)
        else:
            value = F.lit(float(rule[1])) + F.lit(float(rule[2] - rule[1])) * u
        if held := _condition(rule):
            value = F.when(F.col(held[0]) == F.lit(held[1]), value)
        out = out.withColumn(name, value)
    return out


# --- candidates from finished trials ------------------------------------------

#: Random trials before densities are used, part of the trials that counts as good, candidates per parameter.
STARTUP, GOOD, CANDIDATES = 10, 0.2, 24


def _to_unit(rule: tuple, value: Any) -> float:
    kind = rule[0]
    if kind == "int":
        return (value - rule[1] + 0.5) / (rule[2] - rule[1] + 1)
    if kind == "log":
        return math.log(value / rule[1]) / math.log(rule[2] / rule[1])
    return (value - rule[1]) / (rule[2] - rule[1])


def _normal_cdf(x: float) -> float:
    return 0.5 * (1 + math.erf(x / math.sqrt(2)))


class Parzen:
    """Density on [0, 1]: one truncated normal for each value, as wide as its larger gap, and one flat part."""

    def __init__(self, values: Sequence[float]) -> None:
        self.at = sorted(values)
        n = len(self.at)
        edge = [0.0, *self.at, 1.0]
        least = 1.0 / min(100, n + 2)
        self.width = [min(1.0, max(least, edge[i + 1] - edge[i], edge[i + 2] - edge[i + 1])) for i in range(n)]

    def draw(self, pick: float, u: float) -> float:
        """The part that ``pick`` names, at its quantile ``u``."""
        i = int(pick * (len(self.at) + 1))
        if i == len(self.at):
            return u
        m, w = self.at[i], self.width[i]
        low, high = _normal_cdf(-m / w), _normal_cdf((1 - m) / w)
        target, lo, hi = low + u * (high - low), 0.0, 1.0
        for _ in range(60):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if _normal_cdf((mid - m) / w) < target else (lo, mid)
        return (lo + hi) / 2

    def density(self, x: float) -> float:
        total = 1.0
        for m, w in zip(self.at, self.width, strict=True):
            mass = _normal_cdf((1 - m) / w) - _normal_cdf(-m / w)
            total += math.exp(-0.5 * ((x - m) / w) ** 2) / (w * math.sqrt(2 * math.pi) * mass)
        return total / (len(self.at) + 1)


def learned_suggestion(space: dict[str, tuple], done: Sequence[tuple[dict[str, Any], Any]], trial: int, seed: int = 42,
                       startup: int = STARTUP) -> dict[str, Any]:
    """Parameters of one trial, from finished trials as (parameters, value); larger values are better.

    Before ``startup`` trials are done, the seeded random candidate. After that
    each parameter is drawn from the density of the good trials, and of some
    draws the one is taken at which good trials are densest against the others.
    """
    if len(done) < startup:
        return suggest(space, trial + 1, seed)[trial]
    ranked = sorted(range(len(done)), key=lambda i: (done[i][1], -i), reverse=True)
    n_good = max(2, math.ceil(GOOD * len(done)))
    good, rest = [done[i][0] for i in ranked[:n_good]], [done[i][0] for i in ranked[n_good:]]
    picked: dict[str, Any] = {}
    for name, rule in space.items():
        held = _condition(rule)
        if held and picked.get(held[0]) != held[1]:
            continue
        a, b = ([p[name] for p in group if p.get(name) is not None] for group in (good, rest))
        draws = [(_unit(seed, trial, f"{name}:{j}:a"), _unit(seed, trial, f"{name}:{j}:b")) for j in range(CANDIDATES)]
        if rule[0] == "choice":
            share = [[(1 + group.count(c)) / (len(group) + len(rule[1])) for c in rule[1]] for group in (a, b)]
            picked[name] = max(rule[1], key=lambda c: (share[0][rule[1].index(c)] / share[1][rule[1].index(c)], -rule[1].index(c)))
            continue
        near, far = (Parzen([_to_unit(rule, v) for v in group]) for group in (a, b))
        units = [min(near.draw(pick, u), 1 - 1e-12) for pick, u in draws]
        best = max(range(CANDIDATES), key=lambda j: (near.density(units[j]) / far.density(units[j]), -j))
        picked[name] = _value(rule, units[best])
    return picked
