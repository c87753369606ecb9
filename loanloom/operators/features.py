"""Fitted base features: flags, imputation, dates, ratios, interactions, ranks."""

from __future__ import annotations

from collections.abc import Sequence
from copy import copy

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanloom.functions import loan
from loanloom.operators.catstats import category_counts
from loanloom.operators.encoders import FrequencyEncoder
from loanloom.operators.joins import hot_key_lookup, lookup
from loanloom.operators.ordered import average_ranks, medians, percent_rank_in_group
from loanloom.schema import (CATEGORICAL_COLS, DATE_COLS, ID_COL, NATIVE_NULL_TEXT, NUMERIC_COLS,
                             TARGET_COL, UNKNOWN)
from loanloom.session import materialize


def modes(df: DataFrame, cols: Sequence[str]) -> dict[str, str]:
    """Most frequent value per column, the smallest on ties; ``Unknown`` if none."""
    counts = category_counts(df, cols, keep_null=True).where("category is not null")
    best = counts.groupBy("column_name").agg(
        F.min_by("category", F.struct((-F.col("n")).alias("k"), F.col("category"))).alias("mode"))
    found = {r["column_name"]: r["mode"] for r in best.collect()}
    return {c: found.get(c, UNKNOWN) for c in cols}


def approximate_medians(df: DataFrame, cols: Sequence[str], accuracy: int = 10_000) -> dict[str, float]:
    row = df.agg(*[F.approx_percentile(F.col(c).cast("double"), 0.5, accuracy).alias(c)
                   for c in cols]).first()
    return {c: row[c] for c in cols}


def numeric_columns(df: DataFrame, id_col: str = ID_COL, label: str = TARGET_COL,
                    exclude: Sequence[str] = ("fold_id",)) -> list[str]:
    """Columns a model may use: numeric, neither key nor target nor fold."""
    kinds = ("tinyint", "smallint", "int", "bigint", "float", "double")
    return [c for c, k in df.dtypes
            if (k in kinds or k.startswith("decimal")) and c not in (id_col, label, *exclude)]


#: Knots of a fitted rank are at most two per part of this many; the error on training values is at most one part.
RANK_PARTS = 1024


def fitted_ranks(train: DataFrame, value: str, group: str, parts: int = RANK_PARTS) -> DataFrame:
    """(group, xs, ys, n): per group the percentile rank of training rows as knots of a line, and the group's rows.

    Values are cut into ``parts`` of equal rank; the least and the largest value
    of each part are knots. Between two parts there is no training value, within
    a part ranks differ by at most 1 / ``parts``, and a value with many rows is
    a knot itself. So the line misses the exact average-tie rank of a training
    value by at most 1 / ``parts``.
    """
    lists = _rank_knots(train, value, group, parts).groupBy(group).agg(F.sort_array(F.collect_list("k")).alias("k"), F.max("n").alias("n"))
    return lists.select(group, F.col("k.x").alias("xs"), F.col("k.y").alias("ys"), "n")


def _rank_knots(train: DataFrame, value: str, group: str, parts: int) -> DataFrame:
    """(group, part, rows, n, k): the knots, their part with its distinct training values, and the group's rows."""
    ranked = average_ranks(train.select(group, F.col(value).cast("double").alias("_v")), "_v", [group])
    pct = F.col("avg_rank") / F.col("group_n")
    ends = ranked.groupBy(group, F.floor(pct * parts).alias("_part")).agg(
        F.min(F.struct("_v", pct)).alias("a"), F.max(F.struct("_v", pct)).alias("b"), F.max("group_n").alias("n"), F.sum("n").alias("_rows"))
    return ends.select(group, "_part", "_rows", "n", F.explode(F.array_distinct(F.array(
        F.struct(F.col("a")["_v"].alias("x"), F.col("a")["col2"].alias("y")),
        F.struct(F.col("b")["_v"].alias("x"), F.col("b")["col2"].alias("y"))))).alias("k"))


def fine_fitted_ranks(rows: DataFrame, train: DataFrame, value: str, group: str, output: str, parts: int,
                      size: int = RANK_PARTS) -> DataFrame:
    """``rows`` with the rank of ``value`` among the training rows of its group, for more knots than a row should carry.

    The line of ``fitted_ranks`` is cut into pieces of ``size`` parts. A row first finds its piece among the first
    values of the pieces of its group, then gets the knots of that piece alone by a lookup, and the first knot after it.
    """
    knots = _rank_knots(train, value, group, parts).withColumn("_piece", F.floor(F.col("_part") / size))
    # both knots of a part with several values count it, which is enough for a weight
    pieces = knots.groupBy(group, "_piece").agg(F.sort_array(F.collect_list("k")).alias("k"), F.sum("_rows").alias("_weight"))
    order = Window.partitionBy(group).orderBy("_piece")
    firsts = materialize(pieces.select(group, "_piece", "_weight", "k"))
    # one row a piece, at most parts / size + 1 of a group
    after = F.lead(F.col("k")[0]).over(order)
    next_ones = firsts.select(group, "_piece", after.alias("_next"))
    table = firsts.join(next_ones, [group, "_piece"]).withColumn(
        "k", F.when(F.col("_next").isNull(), F.col("k")).otherwise(F.concat("k", F.array("_next")))).select(
        group, "_piece", "_weight", F.col("k.x").alias("_xs"), F.col("k.y").alias("_ys"))
    starts = firsts.groupBy(group).agg(F.sort_array(F.collect_list(F.struct(F.col("k")[0]["x"].alias("x"), "_piece"))).alias("_s"))
    starts = starts.select(group, F.col("_s.x").alias("_starts"), F.col("_s._piece").alias("_pieces"))
    at = _places(F.col(value).cast("double"), F.col("_starts"), parts // size + 2)
    # few groups, each with one value a piece
    placed = rows.join(F.broadcast(starts), group, "left").withColumn(
        "_piece", F.when(F.col(value).isNotNull(), F.get("_pieces", F.greatest(at - 1, F.lit(0))))).drop("_starts", "_pieces")
    found = hot_key_lookup(placed, table, [group, "_piece"], "_weight")
    return found.select(*rows.columns, interpolated(F.col(value).cast("double"), F.col("_xs"), F.col("_ys"), 2 * size + 1).alias(output))


def _places(value: Column, xs: Column, most: int) -> Column:
    """How many of the rising ``xs`` are at most ``value``, by binary search in JVM expressions."""
    n = F.size(xs)
    jumps = F.array(*[F.lit(1 << b) for b in reversed(range(most.bit_length()))])

    def step(at, jump):
        fits = (at + jump <= n) & (F.element_at(xs, F.least(at + jump, n)) <= value)
        return F.when(fits, at + jump).otherwise(at)

    return F.aggregate(jumps, F.lit(0), step)


def interpolated(value: Column, xs: Column, ys: Column, most: int = 2 * RANK_PARTS + 2) -> Column:
    """The line through the knots at ``value``, flat outside them; by binary search in JVM expressions."""
    n = F.size(xs)

    def line(at):
        low, high = F.greatest(at, F.lit(1)), F.least(at + 1, n)
        x0, x1, y0, y1 = (F.element_at(c, i) for c in (xs, ys) for i in (low, high))
        return F.when((at == 0) | (low == high) | (x0 == x1), y0).otherwise(y0 + (y1 - y0) * (value - x0) / (x1 - x0))

    # an array of one place names it, so that the search runs once a row
    found = F.get(F.transform(F.array(_places(value, xs, most)), line), F.lit(0))
    return F.when(value.isNotNull() & xs.isNotNull(), found)


def feature_columns(df: DataFrame, id_col: str = ID_COL, label: str = TARGET_COL) -> list[str]:
    return [c for c in df.columns if c not in (id_col, label)]


_FEATURES = loan.DATE_FEATURES + loan.RATIO_FEATURES + loan.INTERACTION_FEATURES


class BaseFeatureEngineer:
    """Learns medians and modes from training rows; transforms any rows.

    ``transform`` is one lazy projection plus one ranking per rank feature. With
    ``ranks="fitted"`` ranks are those among the training rows, read from a
    fitted table: the same for a row in any batch or stream.
    """

    RANKS = (("amount_rank_in_product", "amount_usd", "product_code"),
             ("income_rank_in_province", "monthly_income_usd", "province"))

    def __init__(self, approximate: bool = False, ranks: bool | str = True,
                 numeric_cols: Sequence[str] | None = None,
                 categorical_cols: Sequence[str] | None = None) -> None:
        self.approximate = approximate
        self.ranks = ranks
        self.numeric_cols = list(numeric_cols or NUMERIC_COLS)
        self.categorical_cols = list(categorical_cols or CATEGORICAL_COLS)
        self.numeric_medians: dict[str, float] = {}
        self.cat_modes: dict[str, str] = {}
        self.rank_tables: dict[str, tuple[DataFrame, int]] = {}
        self.fitted = False
        self.rank_source: DataFrame | None = None

    def fit(self, train: DataFrame) -> BaseFeatureEngineer:
        numbers = [c for c in self.numeric_cols if c in train.columns]
        categories = [c for c in self.categorical_cols if c in train.columns]
        if numbers:
            fit = approximate_medians if self.approximate else medians
            self.numeric_medians = fit(train, numbers)
        if categories:
            self.cat_modes = modes(train, categories)
        self.fitted = True
        if self.ranks == "fitted":
            filled = self.impute(train)
            for name, value, group in self.RANKS:
                if value in train.columns and group in train.columns:
                    table = materialize(fitted_ranks(filled, value, group))
                    self.rank_tables[name] = table, table.count()
        return self

    def impute(self, df: DataFrame) -> DataFrame:
        if not self.fitted:
            raise RuntimeError("Call fit() before transform().")
        filled = {}
        for c, v in self.numeric_medians.items():
            if c in df.columns and v is not None:
                filled[c] = F.coalesce(F.col(c).cast("double"), F.lit(float(v)))
        for c, v in self.cat_modes.items():
            if c in df.columns:
                filled[c] = F.coalesce(F.col(c).cast("string"), F.lit(v))
        return df.withColumns(filled) if filled else df

    def rank_features(self, df: DataFrame, source: DataFrame | None = None) -> DataFrame:
        """Percentile ranks within the rows passed in, or within those of ``source``."""
        out, source = df, df if source is None else source
        for name, value, group in self.RANKS:
            if name in self.rank_tables and value in df.columns and group in df.columns:
                table, rows = self.rank_tables[name]
                # a group's knots count as so many rows of the lookup table
                found = lookup(out, table, [group], rows * 64, "n")
                out = found.select(*df.columns, *[c for c in out.columns if c not in df.columns],
                                   interpolated(F.col(value).cast("double"), F.col("xs"), F.col("ys")).alias(name))
            elif value in df.columns and group in df.columns:
                out = percent_rank_in_group(out, value, [group], name, source=source)
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """Features of raw rows; ranks are those among ``rank_source`` if it is set, else among ``df`` itself."""
        filled = self.impute(loan.missing_flags(df))
        out = self._wide(filled)
        if not self.ranks:
            return out
        source = None if self.rank_source is None else self.impute(self.rank_source)
        made = {f.name for f in _FEATURES} | set(DATE_COLS)
        if any(c in made for _, *cols in self.RANKS for c in cols):
            return self.rank_features(out, None if source is None else self._wide(source))
        # a lookup shuffles whole rows, so it comes before the features make them wide
        ranked = self.rank_features(filled, source)
        return self._wide(ranked).select(*out.columns, *[c for c in ranked.columns if c not in filled.columns])

    def _wide(self, filled: DataFrame) -> DataFrame:
        out = loan.add_features(filled, _FEATURES)
        return loan.drop_dates(out, [c for c in DATE_COLS if c in out.columns])

    def fit_transform(self, train: DataFrame) -> DataFrame:
        return self.fit(train).transform(train)


def with_folds(engineer: BaseFeatureEngineer, train: DataFrame, rows: DataFrame, folds: DataFrame, **changes) -> DataFrame:
    """``engineer.transform(train).join(folds, ID)``, where ``rows`` are the raw rows of ``train`` joined with their folds.

    So folds are joined to narrow rows. ``changes`` are attributes of the engineer for this time only.
    """
    own = copy(engineer)
    # where an ID is repeated, ranks count the rows of ``train``, not those of the join
    vars(own).update(changes, rank_source=train)
    out = own.transform(rows)
    last = [c for c in folds.columns if c != ID_COL]
    return out.select(*[c for c in out.columns if c not in last], *last)


def add_extra_features(train: DataFrame, test: DataFrame, cat_cols: Sequence[str],
                       urban: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Frequency columns beside the categories, urban flag and rate interactions."""
    freq = FrequencyEncoder(cat_cols, suffix="_freq").fit(train, label=None)
    extra = [loan.urban_flag(list(urban) if urban else None), *loan.EXTRA_FEATURES]
    return (loan.add_features(freq.transform(train), extra),
            loan.add_features(freq.transform(test), extra))


def native_categories(df: DataFrame, cat_cols: Sequence[str]) -> DataFrame:
    """Categories as text with ``__NA__`` for null, numbers with 0 for null."""
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit(NATIVE_NULL_TEXT))
            for c in cat_cols if c in df.columns}
    numbers = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
               for c in numeric_columns(df) if c not in text}
    return df.withColumns({**text, **numbers})
