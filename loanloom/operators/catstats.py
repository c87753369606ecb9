"""The category statistics table: one shuffle that all encoders are fitted from."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanloom.functions.text import category_text
from loanloom.session import materialize

NO_FOLD = -1


def detect_categories(df: DataFrame, integer_categories: Sequence[str] = ("product_code",),
                      exclude: Sequence[str] = ()) -> list[str]:
    """Text columns and declared integer categories, in schema order."""
    return [c for c, kind in df.dtypes
            if c not in exclude and (kind == "string" or c in integer_categories)]


def category_counts(df: DataFrame, cols: Sequence[str], label: str | Column | None = None,
                    fold: str | None = None, keep_null: bool = False) -> DataFrame:
    """(column_name, category, fold_id, n, pos), combined before the shuffle.

    Missing values are the category ``nan`` unless ``keep_null`` is set.
    """
    y = F.lit(0) if label is None else (F.col(label) if isinstance(label, str) else label)
    k = F.lit(NO_FOLD) if fold is None else F.col(fold)
    text = [(F.col(c).cast("string") if keep_null else category_text(c)).alias(c) for c in cols]
    long = df.select(k.cast("int").alias("fold_id"), y.cast("long").alias("_y"), *text).unpivot(
        ["fold_id", "_y"], list(cols), "column_name", "category")
    return long.groupBy("column_name", "category", "fold_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("_y").alias("pos"))


@dataclass
class CategoryStats:
    """Fitted counts per column, category and fold, with their totals."""

    table: DataFrame
    cols: list[str]
    sizes: dict[str, int]
    fold_n: dict[int, int] = field(default_factory=dict)
    fold_pos: dict[int, int] = field(default_factory=dict)

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str], label: str | None = None,
            fold: str | None = None) -> CategoryStats:
        cols = list(cols)
        table = materialize(category_counts(df, cols, label, fold))
        sizes = {r["column_name"]: r["k"] for r in (
            table.select("column_name", "category").distinct()
            .groupBy("column_name").agg(F.count(F.lit(1)).alias("k")).collect())}
        folds = (table.where(F.col("column_name") == cols[0]).groupBy("fold_id")
                 .agg(F.sum("n").alias("n"), F.sum("pos").alias("pos")).collect())
        return cls(table, cols, sizes, {r["fold_id"]: r["n"] for r in folds},
                   {r["fold_id"]: r["pos"] for r in folds})

    @property
    def n(self) -> int:
        return sum(self.fold_n.values())

    @property
    def pos(self) -> int:
        return sum(self.fold_pos.values())

    @property
    def rate(self) -> float:
        return self.pos / self.n

    @property
    def folds(self) -> list[int]:
        return sorted(self.fold_n)

    def low_cardinality(self, limit: int = 30) -> list[str]:
        return [c for c in self.cols if self.sizes[c] <= limit]

    def totals(self) -> DataFrame:
        """All rows: (column_name, category, n, pos, all_n, all_pos)."""
        return self.table.groupBy("column_name", "category").agg(
            F.sum("n").alias("n"), F.sum("pos").alias("pos")).withColumns(
            {"all_n": F.lit(self.n).cast("long"), "all_pos": F.lit(self.pos).cast("long")})

    def fold_constant(self, values: dict[int, int]) -> Column:
        pairs = [F.lit(x) for k in self.folds for x in (k, values[k])]
        return F.create_map(*pairs)[F.col("fold_id")].cast("long")

    def complements(self) -> DataFrame:
        """Per category and fold it occurs in: counts of the other folds.

        ``own_n`` is the number of rows of the fold itself. The window holds one
        row per fold.
        """
        others = Window.partitionBy("column_name", "category")
        return self.table.select(
            "column_name", "category", "fold_id", F.col("n").alias("own_n"),
            (F.sum("n").over(others) - F.col("n")).alias("n"),
            (F.sum("pos").over(others) - F.col("pos")).alias("pos"),
            (F.lit(self.n) - self.fold_constant(self.fold_n)).alias("all_n"),
            (F.lit(self.pos) - self.fold_constant(self.fold_pos)).alias("all_pos"))

    def without_fold(self, k: int) -> DataFrame:
        """Counts of all rows outside fold ``k``, only categories that occur there."""
        rest = self.table.where(F.col("fold_id") != k).groupBy("column_name", "category").agg(
            F.sum("n").alias("n"), F.sum("pos").alias("pos"))
        return rest.withColumns({
            "all_n": F.lit(self.n - self.fold_n[k]).cast("long"),
            "all_pos": F.lit(self.pos - self.fold_pos[k]).cast("long")})
