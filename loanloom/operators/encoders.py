"""Categorical encoders: fitted on the statistics table, applied by lookup joins.

A missing value is the category ``nan``. Tables up to ``joins.BROADCAST_ROWS``
rows are broadcast, larger ones go through the hot-key-safe shuffle lookup.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.functions.text import category_text
from loanloom.operators import joins
from loanloom.operators.catstats import CategoryStats, detect_categories
from loanloom.operators.ordered import running_totals
from loanloom.schema import GROUP_STAT_COLS, ID_COL, TARGET_COL
from loanloom.session import materialize


def smoothed_mean(smoothing: float) -> Column:
    """(positives + s * overall rate) / (n + s)."""
    s = F.lit(float(smoothing))
    prior = F.try_divide(F.col("all_pos").cast("double"), F.col("all_n").cast("double"))
    return (F.col("pos") + s * prior) / (F.col("n") + s)


def weight_of_evidence(smoothing: float) -> Column:
    """Log of the smoothed share of non-events over that of events."""
    s = F.lit(float(smoothing))
    events = (F.col("pos") + s) / (F.col("all_pos") + 2 * s)
    others = (F.col("n") - F.col("pos") + s) / (F.col("all_n") - F.col("all_pos") + 2 * s)
    return F.log(others / events)


def apply_maps(
    df: DataFrame,
    stats: CategoryStats,
    maps: DataFrame,
    outputs: Mapping[str, Mapping[str, str]],
    defaults: Mapping[str, float | Column],
    by_fold: str | None = None,
    limit: int | None = None,
    weight: str = "n",
) -> DataFrame:
    """Look columns up in ``maps`` and write the found values.

    ``maps`` has (column_name, category[, fold_id], weight, value columns...);
    ``outputs`` gives, per input column, value column -> output column. All
    lookups read one written table and end in one projection.
    """
    limit = joins.BROADCAST_ROWS if limit is None else limit
    maps = materialize(maps)
    keyed = {f"_cat_{i}": category_text(c) for i, c in enumerate(outputs)}
    if by_fold:
        keyed["_fold"] = F.col(by_fold).cast("int")
    rows = df.withColumns(keyed)
    new: dict[str, Column] = {}
    for i, (c, names) in enumerate(outputs.items()):
        keys = [f"_cat_{i}"] + (["_fold"] if by_fold else [])
        picked = [F.col("category").alias(keys[0])]
        if by_fold:
            picked.append(F.col("fold_id").alias("_fold"))
        table = maps.where(F.col("column_name") == c).select(
            *picked, F.col(weight).alias("_weight"),
            *[F.col(v).alias(f"_{i}_{v}") for v in names])
        n_rows = stats.sizes.get(c, 0) * (len(stats.folds) if by_fold else 1)
        rows = joins.lookup(rows, table, keys, n_rows, "_weight", limit)
        for v, name in names.items():
            hit = F.col(f"_{i}_{v}")
            new[name] = F.coalesce(hit, F.lit(defaults[v])) if v in defaults else hit
    # the column order of the input is kept; a replaced column stays in place
    return rows.select(
        *[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in df.columns],
        *[e.alias(c) for c, e in new.items() if c not in df.columns])


class CategoryEncoder:
    """Fit on training rows, transform any rows; state is a small table."""

    def __init__(self, cat_cols: Sequence[str] | None = None, suffix: str = "",
                 broadcast_limit: int | None = None) -> None:
        self.cat_cols = list(cat_cols) if cat_cols else None
        self.suffix = suffix
        self.broadcast_limit = broadcast_limit
        self.stats: CategoryStats | None = None

    def fit(self, df: DataFrame, label: str | None = TARGET_COL, fold: str | None = None,
            stats: CategoryStats | None = None):
        if self.cat_cols is None:
            self.cat_cols = detect_categories(df, exclude=(ID_COL,))
        if label is not None and label not in df.columns:
            label = None
        self.stats = stats or CategoryStats.fit(df, self.cat_cols, label, fold)
        return self

    def _fitted(self) -> CategoryStats:
        if self.stats is None:
            raise RuntimeError("Call fit() first.")
        return self.stats

    def _name(self, c: str) -> str:
        return f"{c}{self.suffix}"

    def _apply(self, df: DataFrame, maps: DataFrame, default: float,
               by_fold: str | None = None, weight: str = "n") -> DataFrame:
        outputs = {c: {"value": self._name(c)} for c in self.cat_cols}
        return apply_maps(df, self._fitted(), maps, outputs, {"value": default}, by_fold,
                          self.broadcast_limit, weight)


class FrequencyEncoder(CategoryEncoder):
    """Share of the training rows; unseen categories get 0."""

    def transform(self, df: DataFrame) -> DataFrame:
        maps = self._fitted().totals().withColumn("value", F.col("n") / F.col("all_n"))
        return self._apply(df, maps, 0.0)


class OrdinalEncoder(CategoryEncoder):
    """Position among the sorted categories of the column; unseen gets -1."""

    def codes(self, buckets: int | None = None) -> DataFrame:
        seen = self._fitted().totals().select("column_name", "category", "n")
        ordered = running_totals(
            seen, "category", ["column_name"], {"rows": F.col("n")}, buckets)
        return ordered.select("column_name", "category", F.col("rows").alias("n"),
                              F.col("before_n").cast("double").alias("value"))

    def transform(self, df: DataFrame) -> DataFrame:
        return self._apply(df, self.codes(), -1.0)


class OneHotEncoder(CategoryEncoder):
    """One 0/1 column per fitted category; unseen rows get all zeros.

    The dense form is for few categories, so more than ``max_columns`` raise an
    error; ``training.sparse_one_hot`` has the sparse form for wide cases.
    """

    def __init__(self, cat_cols: Sequence[str] | None = None, max_columns: int = 2000) -> None:
        super().__init__(cat_cols)
        self.max_columns = max_columns

    def feature_names(self) -> list[tuple[str, str]]:
        stats = self._fitted()
        wide = sum(stats.sizes[c] for c in self.cat_cols)
        if wide > self.max_columns:
            raise ValueError(f"{wide} one-hot columns exceed {self.max_columns}; use the sparse form")
        seen = {(r["column_name"], r["category"]) for r in
                stats.table.select("column_name", "category").distinct().collect()}
        return [(c, v) for c in self.cat_cols for v in sorted(v for k, v in seen if k == c)]

    def transform(self, df: DataFrame) -> DataFrame:
        new = [(category_text(c) == F.lit(v)).cast("double").alias(f"{c}_{v}")
               for c, v in self.feature_names()]
        kept = [F.col(f"`{c}`") for c in df.columns if c not in self.cat_cols]
        return df.select(*kept, *new)


class KFoldTargetEncoder(CategoryEncoder):
    """Smoothed target mean; training rows only see the other folds."""

    def __init__(self, cat_cols: Sequence[str] | None = None, smoothing: float = 10.0,
                 suffix: str = "", broadcast_limit: int | None = None) -> None:
        super().__init__(cat_cols, suffix, broadcast_limit)
        self.smoothing = smoothing

    def transform(self, df: DataFrame) -> DataFrame:
        maps = self._fitted().totals().withColumn("value", smoothed_mean(self.smoothing))
        return self._apply(df, maps, self.stats.rate)

    def transform_train(self, df: DataFrame, fold: str = "fold_id") -> DataFrame:
        other = self._fitted().complements().where(F.col("n") > 0)
        maps = other.withColumn("value", smoothed_mean(self.smoothing))
        return self._apply(df, maps, self.stats.rate, fold, "own_n")


class WOEEncoder(CategoryEncoder):
    """Weight of evidence; unseen categories get 0."""

    def __init__(self, cat_cols: Sequence[str] | None = None, smoothing: float = 0.5,
                 suffix: str = "", broadcast_limit: int | None = None) -> None:
        super().__init__(cat_cols, suffix, broadcast_limit)
        self.smoothing = smoothing

    def transform(self, df: DataFrame) -> DataFrame:
        maps = self._fitted().totals().withColumn("value", weight_of_evidence(self.smoothing))
        return self._apply(df, maps, 0.0)

    def transform_train(self, df: DataFrame, fold: str = "fold_id") -> DataFrame:
        other = self._fitted().complements().where(F.col("n") > 0)
        maps = other.withColumn("value", weight_of_evidence(self.smoothing))
        return self._apply(df, maps, 0.0, fold, "own_n")


class GroupStatsEncoder(CategoryEncoder):
    """Adds ``<col>_default_rate`` and ``<col>_loan_count``; unseen is null."""

    def __init__(self, group_cols: Sequence[str] | None = None,
                 broadcast_limit: int | None = None) -> None:
        super().__init__(group_cols or GROUP_STAT_COLS, broadcast_limit=broadcast_limit)

    def _add(self, df: DataFrame, counts: DataFrame, by_fold: str | None, weight: str) -> DataFrame:
        maps = counts.withColumns({
            "rate": F.col("pos").cast("double") / F.col("n"), "loans": F.col("n")})
        outputs = {c: {"rate": f"{c}_default_rate", "loans": f"{c}_loan_count"}
                   for c in self.cat_cols if c in df.columns}
        return apply_maps(df, self._fitted(), maps, outputs, {}, by_fold,
                          self.broadcast_limit, weight)

    def transform(self, df: DataFrame) -> DataFrame:
        return self._add(df, self._fitted().totals(), None, "n")

    def transform_train(self, df: DataFrame, fold: str = "fold_id") -> DataFrame:
        return self._add(df, self._fitted().complements().where(F.col("n") > 0), fold, "own_n")


class FoldEncoder:
    """Target mean, weight of evidence and group statistics fitted outside one fold.

    All folds come from one statistics table, so K folds cost one pass.
    """

    def __init__(self, cat_cols: Sequence[str] | None = None, smoothing: float = 10.0,
                 woe_limit: int = 30, group_cols: Sequence[str] | None = None) -> None:
        self.cat_cols = list(cat_cols) if cat_cols else None
        self.smoothing = smoothing
        self.woe_limit = woe_limit
        self.group_cols = list(group_cols or GROUP_STAT_COLS)
        self.stats: CategoryStats | None = None

    def fit(self, df: DataFrame, label: str = TARGET_COL, fold: str = "fold_id",
            stats: CategoryStats | None = None) -> FoldEncoder:
        if self.cat_cols is None:
            self.cat_cols = detect_categories(df, exclude=(ID_COL,))
        self.stats = stats or CategoryStats.fit(df, self.cat_cols, label, fold)
        return self

    def _encode(self, df: DataFrame, counts: DataFrame, prior: float | Column,
                by_fold: str | None = None, weight: str = "n") -> DataFrame:
        if self.stats is None:
            raise RuntimeError("Call fit() first.")
        maps = counts.where(F.col("n") > 0).withColumns({
            "mean": smoothed_mean(self.smoothing), "woe": weight_of_evidence(0.5),
            "rate": F.col("pos").cast("double") / F.col("n"), "loans": F.col("n")})
        low = self.stats.low_cardinality(self.woe_limit)
        outputs: dict[str, dict[str, str]] = {}
        for c in self.cat_cols:
            outputs[c] = {"mean": c}
            if c in low:
                outputs[c]["woe"] = f"{c}_woe"
            if c in self.group_cols:
                outputs[c].update(rate=f"{c}_default_rate", loans=f"{c}_loan_count")
        return apply_maps(df, self.stats, maps, outputs, {"mean": prior, "woe": 0.0}, by_fold,
                          weight=weight)

    def transform(self, df: DataFrame) -> DataFrame:
        """Rows that were not in training: statistics of all training rows."""
        return self._encode(df, self.stats.totals(), self.stats.rate)

    def transform_for_fold(self, df: DataFrame, k: int) -> DataFrame:
        """Any rows, with statistics of the training rows outside fold ``k``."""
        s = self.stats
        prior = (s.pos - s.fold_pos[k]) / (s.n - s.fold_n[k])
        return self._encode(df, s.without_fold(k), prior)

    def transform_train(self, df: DataFrame, fold: str = "fold_id") -> DataFrame:
        """Training rows, each with the statistics of the other folds."""
        s = self.stats
        # a category seen in no other fold gets the other folds' rate, as in transform_for_fold
        pairs = [F.lit(x) for k in s.folds for x in (k, (s.pos - s.fold_pos[k]) / (s.n - s.fold_n[k]))]
        prior = F.create_map(*pairs)[F.col(fold).cast("int")]
        return self._encode(df, s.complements(), prior, fold, "own_n")
