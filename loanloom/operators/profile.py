"""Audits and distribution tables: one aggregation pass per report."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanloom.operators import joins
from loanloom.operators.catstats import category_counts
from loanloom.operators.ordered import exact_quantiles
from loanloom.schema import TARGET_COL
from loanloom.session import materialize


def _tall(row: DataFrame, cols: Sequence[str], names: Sequence[str]) -> DataFrame:
    """One row with an array per column -> one row per column."""
    items = F.array(*[
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"`{c}`")[i].alias(m)
                                                  for i, m in enumerate(names)])
        for c in cols])
    return row.select(F.explode(items).alias("_x")).select("_x.*")


def missing_rates(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column_name, missing_rate) of columns with missing values, worst first."""
    cols = list(cols or df.columns)
    row = df.agg(*[F.array(F.avg(F.col(c).isNull().cast("double"))).alias(c) for c in cols])
    tall = _tall(row, cols, ["missing_rate"])
    return tall.where("missing_rate > 0").orderBy(F.desc("missing_rate"), "column_name")


def missing_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Like ``missing_rates`` in rows and percent, with empty text as missing."""
    cols = list(cols or df.columns)
    kinds = dict(df.dtypes)

    def absent(c: str) -> Column:
        gone = F.col(c).isNull()
        return gone | (F.trim(F.col(c)) == "") if kinds[c] == "string" else gone

    row = df.agg(*[
        F.array(F.count_if(absent(c)).cast("double"), F.count(F.lit(1)).cast("double")).alias(c)
        for c in cols])
    tall = _tall(row, cols, ["m", "n"]).where("m > 0")
    return tall.select("column_name", F.col("m").cast("long").alias("n_missing"),
                       (F.lit(100.0) * F.col("m") / F.col("n")).alias("pct_missing")
                       ).orderBy(F.desc("n_missing"), "column_name")


def schema_audit(df: DataFrame, required: Sequence[str]) -> dict[str, list[str]]:
    """Required columns that are absent and columns nobody asked for."""
    return {"missing": [c for c in required if c not in df.columns],
            "unexpected": [c for c in df.columns if c not in required]}


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    gone = schema_audit(df, required)["missing"]
    if gone:
        raise ValueError(f"missing columns: {gone}")
    return df


def class_balance(df: DataFrame, label: str = TARGET_COL) -> DataFrame:
    """Rows and share per class; the window runs over one row per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(label, "n", (F.col("n") / F.sum("n").over(Window.partitionBy())).alias("share"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(col)


def numeric_summary(df: DataFrame, cols: Sequence[str], buckets: int | None = None) -> DataFrame:
    """Mean, median, minimum, maximum and missing count per column."""
    cols = list(cols)
    row = df.agg(*[
        F.array(F.avg(c), F.min(c).cast("double"), F.max(c).cast("double"),
                F.count_if(F.col(c).isNull()).cast("double")).alias(c) for c in cols])
    basics = _tall(row, cols, ["mean", "min", "max", "missing"])
    middle = exact_quantiles(df, cols, buckets=buckets).select(
        "column_name", F.col("value").alias("median"))
    # one row per column on both sides
    return basics.join(F.broadcast(middle), "column_name", "left").select(
        "column_name", "mean", "median", "min", "max", F.col("missing").cast("long").alias("missing"))


def histogram(df: DataFrame, cols: Sequence[str], bins: int = 40, by: str | None = None,
              log1p: bool = False) -> DataFrame:
    """Equal-width histogram per column and class; the last bin is closed.

    (column_name[, by], bin, bin_start, bin_width, n, density). Edges span the
    rows of each class, as separate plots of the classes would.
    """
    cols = list(cols)
    groups = ["column_name"] + ([by] if by else [])
    value = (lambda c: F.log1p(c)) if log1p else (lambda c: F.col(c).cast("double"))
    long = df.select(*([by] if by else []), *[value(c).alias(c) for c in cols]).unpivot(
        [by] if by else [], cols, "column_name", "x").where("x is not null")
    # one row per column and class; as many as classes, so the lookup checks its size
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    span = materialize(long.groupBy(*groups).agg(
        F.min("x").alias("lo"), F.max("x").alias("hi"), F.count("x").alias("total")).withColumns(
        {"w": width, "_weight": F.col("total")}))
    place = F.least(F.floor((F.col("x") - F.col("lo")) / F.nullif(F.col("w"), F.lit(0.0))),
                    F.lit(bins - 1))
    binned = joins.lookup(long, span, groups, span.count(), "_weight").where("lo is not null").withColumn(
        "bin", F.coalesce(place, F.lit(0)).cast("int"))
    counts = binned.groupBy(*groups, "bin").agg(
        F.count("x").alias("n"), F.max("lo").alias("lo"), F.max("w").alias("w"),
        F.max("total").alias("total"))
    return counts.select(
        *groups, "bin", (F.col("lo") + F.col("bin") * F.col("w")).alias("bin_start"),
        F.col("w").alias("bin_width"), "n",
        F.try_divide(F.col("n").cast("double"), F.col("total") * F.col("w")).alias("density"))


def correlation(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair in one pass: (col_a, col_b, r)."""
    pairs = list(combinations(cols, 2))
    row = df.agg(*[F.corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    items = F.array(*[F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
                               F.col(f"r{i}").alias("r")) for i, (a, b) in enumerate(pairs)])
    return row.select(F.explode(items).alias("_x")).select("_x.*")


def default_rates(df: DataFrame, cols: Sequence[str], label: str = TARGET_COL) -> DataFrame:
    """Target rate per category of every column, highest first within a column."""
    counts = category_counts(df, cols, label, keep_null=True).where("category is not null")
    return counts.select("column_name", "category", "n",
                         (F.col("pos").cast("double") / F.col("n")).alias("default_rate")
                         ).orderBy("column_name", F.desc("default_rate"), "category")


def cardinalities(df: DataFrame, cols: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct non-null values per column, exact by default."""
    cols = list(cols)
    if approximate:
        row = df.agg(*[F.array(F.approx_count_distinct(c)).alias(c) for c in cols])
        return _tall(row, cols, ["n_distinct"])
    distinct = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        [], cols, "column_name", "category").distinct()
    return distinct.groupBy("column_name").agg(F.count("category").alias("n_distinct"))


def low_cardinality(df: DataFrame, cols: Sequence[str], limit: int = 30) -> list[str]:
    small = {r["column_name"] for r in
             cardinalities(df, cols).where(F.col("n_distinct") <= limit).collect()}
    return [c for c in cols if c in small]


def score_summary(df: DataFrame, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean, minimum, maximum and share above one half."""
    return df.groupBy(*by).agg(
        F.avg(score).alias("mean"), F.min(score).alias("min"), F.max(score).alias("max"),
        F.avg((F.col(score) > 0.5).cast("double")).alias("share_above_half"))
