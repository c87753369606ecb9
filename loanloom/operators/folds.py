"""Stratified folds, hold-outs and samples, repeatable by seed."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.functions.text import seeded_md5
from loanloom.operators.ordered import hash_row_numbers
from loanloom.schema import ID_COL, TARGET_COL


def _digits(df: DataFrame) -> int:
    """Hex digits of the bucket: about 16 or more buckets per shuffle partition."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(2, min(4, math.ceil(math.log(max(16, 4 * parts), 16))))


def make_folds(df: DataFrame, n_folds: int = 5, seed: int = 42, id_col: str = ID_COL,
               label: str = TARGET_COL) -> DataFrame:
    """(ID, fold_id): rows are dealt out class by class in md5 order, so class
    rates and fold sizes differ by at most one row between folds."""
    keyed = df.select(id_col, label)
    numbered = hash_row_numbers(
        keyed, seeded_md5(id_col, seed), id_col, across=[label], digits=_digits(df), output="_n")
    return numbered.select(id_col, F.pmod(F.col("_n") - 1, F.lit(n_folds)).cast("int").alias("fold_id"))


def fold_summary(df: DataFrame, folds: DataFrame, id_col: str = ID_COL, label: str = TARGET_COL,
                 tolerance: float = 0.02) -> DataFrame:
    """Rows and class rate per fold, flagged when far from the overall rate."""
    per_fold = df.select(id_col, label).join(folds, id_col).groupBy("fold_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(label).cast("long").alias("pos"))
    whole = per_fold.agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))
    overall = whole.select(F.col("pos") / F.col("n")).scalar()
    rated = per_fold.select(
        "fold_id", "n", "pos", (F.col("pos") / F.col("n")).alias("fold_rate"),
        overall.alias("overall_rate"))
    return rated.withColumn(
        "off", F.abs(F.col("fold_rate") - F.col("overall_rate")) > F.lit(tolerance))


def check_folds(df: DataFrame, folds: DataFrame, n_folds: int, id_col: str = ID_COL,
                label: str = TARGET_COL) -> None:
    """Error unless every row has exactly one fold and all folds are there."""
    seen = folds.agg(F.count(F.lit(1)).alias("n"), F.min("fold_id").alias("lo"),
                     F.max("fold_id").alias("hi")).first()
    covered = fold_summary(df, folds, id_col, label).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("k")).first()
    rows = df.count()
    if seen["n"] != rows or covered["n"] != rows:
        raise ValueError(f"fold table covers {covered['n']} of {rows} rows ({seen['n']} entries)")
    if covered["k"] != n_folds:
        raise ValueError(f"expected {n_folds} folds, found {covered['k']}")


def holdout_split(df: DataFrame, test_share: tuple[int, int] = (3, 10), seed: int = 42,
                  id_col: str = ID_COL, label: str = TARGET_COL) -> DataFrame:
    """(ID, is_holdout): an exact share of every class, in md5 order."""
    part, whole = test_share
    numbered = hash_row_numbers(
        df.select(id_col, label), seeded_md5(id_col, seed), id_col, keys=[label],
        digits=_digits(df), output="_n")
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("_class_n"))
    # one row per class
    sized = numbered.join(F.broadcast(sizes), label)
    cut = F.floor((F.col("_class_n") * 2 * part + whole) / (2 * whole))
    return sized.select(id_col, (F.col("_n") <= cut).cast("int").alias("is_holdout"))


def hash_sample(df: DataFrame, n: int = 100, seed: int = 42, id_col: str = ID_COL) -> DataFrame:
    """``n`` rows drawn without regard to their order or partitioning."""
    order: Column = seeded_md5(id_col, seed)
    return df.orderBy(order, F.col(id_col)).limit(n)


def fold_parts(df: DataFrame, folds: DataFrame, k: int, id_col: str = ID_COL) -> tuple[DataFrame, DataFrame]:
    """Training part and held-out part of fold ``k``."""
    joined = df.join(folds, id_col) if "fold_id" not in df.columns else df
    return joined.where(F.col("fold_id") != k), joined.where(F.col("fold_id") == k)
