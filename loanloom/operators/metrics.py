"""Exact binary-classification metrics, grouped by any keys.

All curve metrics read one table of running totals per distinct score, so a
long table of many models is evaluated in one job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.operators.ordered import exact_quantiles, running_totals
from loanloom.operators.profile import histogram
from loanloom.schema import TARGET_COL

CALIBRATION_BINS = 15


def score_totals(df: DataFrame, label: str = TARGET_COL, score: str = "score",
                 keys: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """Running totals of rows and positives per distinct score."""
    return running_totals(df, score, keys, {"pos": F.col(label).cast("long")}, buckets)


def _neg_total() -> Column:
    return F.max(F.col("total_n") - F.col("total_pos"))


def _auc_value() -> Column:
    """Share of (positive, negative) pairs in the right order, ties one half."""
    neg = (F.col("n") - F.col("pos")).cast("double")
    neg_below = (F.col("before_n") - F.col("before_pos")).cast("double")
    won = F.sum(F.col("pos") * (neg_below + neg / 2.0))
    return F.try_divide(won, F.max("total_pos").cast("double") * _neg_total().cast("double"))


def _auc(t: DataFrame, keys: Sequence[str]) -> DataFrame:
    return t.groupBy(*keys).agg(
        _auc_value().alias("roc_auc"), F.max("total_n").alias("n"),
        F.max("total_pos").alias("positives"))


def roc_auc(df: DataFrame, label: str = TARGET_COL, score: str = "score",
            keys: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """(keys, roc_auc, n, positives); null when a class is absent."""
    return _auc(score_totals(df, label, score, keys, buckets), keys)


def curve_points(df: DataFrame, label: str = TARGET_COL, score: str = "score",
                 keys: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """Per distinct threshold: tp, fp, precision, recall, fpr, tpr and f1."""
    return _points(score_totals(df, label, score, keys, buckets), score, keys)


def _points(t: DataFrame, score: str, keys: Sequence[str]) -> DataFrame:
    tp = F.col("total_pos") - F.col("before_pos")
    flagged = F.col("total_n") - F.col("before_n")
    rows = t.select(
        *keys, F.col(score).alias("threshold"), "n", "pos", tp.alias("tp"),
        (flagged - tp).alias("fp"), (tp / flagged).alias("precision"),
        F.try_divide(tp, F.col("total_pos")).alias("recall"),
        F.try_divide(flagged - tp, F.col("total_n") - F.col("total_pos")).alias("fpr"),
        "total_pos")
    p, r = F.col("precision"), F.coalesce(F.col("recall"), F.lit(1.0))
    f1 = F.lit(2.0) * p * r / (p + r + F.lit(1e-8))
    return rows.withColumns({"tpr": F.col("recall"), "f1": f1})


def _precision_value() -> Column:
    """Sum of precision times recall gained, over falling thresholds."""
    flagged = F.col("total_n") - F.col("before_n")
    precision = (F.col("total_pos") - F.col("before_pos")) / flagged
    gain = F.try_divide(F.col("pos").cast("double"), F.col("total_pos").cast("double"))
    return F.coalesce(F.sum(gain * precision), F.lit(0.0))


def average_precision(df: DataFrame, label: str = TARGET_COL, score: str = "score",
                      keys: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """(keys, pr_auc), exact with ties."""
    return score_totals(df, label, score, keys, buckets).groupBy(*keys).agg(
        _precision_value().alias("pr_auc"))


def best_threshold(df: DataFrame, label: str = TARGET_COL, score: str = "score",
                   keys: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """(keys, threshold, f1) with the highest f1; the lowest threshold on ties."""
    points = curve_points(df, label, score, keys, buckets)
    best = points.groupBy(*keys).agg(
        F.max(F.struct("f1", (-F.col("threshold")).alias("neg"))).alias("_b"))
    return best.select(*keys, (-F.col("_b.neg")).alias("threshold"), F.col("_b.f1").alias("f1"))


def _cells(label: str, hit: Column) -> dict[str, Column]:
    y = F.col(label) == 1
    return {"tp": F.count_if(y & hit), "fp": F.count_if(~y & hit),
            "fn": F.count_if(y & ~hit), "tn": F.count_if(~y & ~hit)}


def confusion_cells(df: DataFrame, label: str = TARGET_COL, score: str = "score",
                    keys: Sequence[str] = (), threshold: float | Column = 0.5) -> DataFrame:
    """(keys, tp, fp, fn, tn) where a score at the threshold counts as positive."""
    hit = F.col(score) >= threshold
    return df.groupBy(*keys).agg(*[e.alias(k) for k, e in _cells(label, hit).items()])


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def _flat_metrics(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    return {"accuracy": _ratio(tp + tn, tp + tn + fp + fn), "f1": _ratio(2 * tp, 2 * tp + fp + fn),
            "precision": _ratio(tp, tp + fp), "recall": _ratio(tp, tp + fn)}


def threshold_metrics(df: DataFrame, label: str = TARGET_COL, score: str = "score",
                      keys: Sequence[str] = (), threshold: float | Column = 0.5) -> DataFrame:
    """(keys, accuracy, f1, precision, recall); 0 where undefined."""
    flat = _flat_metrics(*(F.col(c) for c in ("tp", "fp", "fn", "tn")))
    return confusion_cells(df, label, score, keys, threshold).select(
        *keys, *[e.alias(k) for k, e in flat.items()])


def confusion_matrix(df: DataFrame, label: str = TARGET_COL, score: str = "score",
                     threshold: float = 0.5) -> DataFrame:
    """All four (actual, predicted, n) cells."""
    cells = F.array(*[
        F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(c).alias("n"))
        for a, p, c in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))])
    one = confusion_cells(df, label, score, (), threshold)
    return one.select(F.explode(cells).alias("_x")).select("_x.*")


def classification_report(df: DataFrame, label: str = TARGET_COL, score: str = "score",
                          threshold: float = 0.5) -> DataFrame:
    """(row, precision, recall, f1, support) per class and for the averages."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    one = confusion_cells(df, label, score, (), threshold).withColumns({
        "p0": _ratio(tn, tn + fn), "r0": _ratio(tn, tn + fp), "f0": _ratio(2 * tn, 2 * tn + fn + fp),
        "p1": _ratio(tp, tp + fp), "r1": _ratio(tp, tp + fn), "f1": _ratio(2 * tp, 2 * tp + fp + fn),
        "s0": tn + fp, "s1": tp + fn, "acc": _ratio(tp + tn, tp + tn + fp + fn)})
    s0, s1 = F.col("s0"), F.col("s1")
    both = s0 + s1

    def row(name: str, p: Column, r: Column, f: Column, s: Column) -> Column:
        return F.struct(F.lit(name).alias("row"), p.alias("precision"), r.alias("recall"),
                        f.alias("f1"), s.alias("support"))

    macro = [(F.col(f"{m}0") + F.col(f"{m}1")) / 2.0 for m in "prf"]
    weighted = [_ratio(F.col(f"{m}0") * s0 + F.col(f"{m}1") * s1, both) for m in "prf"]
    acc = F.col("acc")
    rows = F.array(
        row("0", F.col("p0"), F.col("r0"), F.col("f0"), s0),
        row("1", F.col("p1"), F.col("r1"), F.col("f1"), s1),
        row("accuracy", acc, acc, acc, both),
        row("macro avg", *macro, both), row("weighted avg", *weighted, both))
    return one.select(F.explode(rows).alias("_x")).select("_x.*")


def evaluate(df: DataFrame, label: str = TARGET_COL, score: str = "score",
             keys: Sequence[str] = ("model",), threshold: float = 0.5,
             buckets: int | None = None) -> DataFrame:
    """One full metric row per key, from one aggregation of the running totals."""
    hit = F.col(score) >= threshold
    neg = F.col("n") - F.col("pos")
    cells = {"tp": F.when(hit, F.col("pos")), "fp": F.when(hit, neg),
             "fn": F.when(~hit, F.col("pos")), "tn": F.when(~hit, neg)}
    row = score_totals(df, label, score, keys, buckets).groupBy(*keys).agg(
        _auc_value().alias("roc_auc"), _precision_value().alias("pr_auc"),
        *[F.coalesce(F.sum(e), F.lit(0)).alias(c) for c, e in cells.items()])
    flat = _flat_metrics(*(F.col(c) for c in ("tp", "fp", "fn", "tn")))
    return row.select(*keys, "roc_auc", "pr_auc", *[e.alias(k) for k, e in flat.items()],
                      F.lit(float(threshold)).alias("threshold"))


def fold_aucs(df: DataFrame, label: str = TARGET_COL, score: str = "score",
              keys: Sequence[str] = ("model",), fold: str = "fold_id") -> DataFrame:
    """(keys, fold_aucs, mean_auc, std_auc) with the population deviation."""
    per_fold = roc_auc(df, label, score, [*keys, fold])
    return per_fold.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(fold, "roc_auc"))),
                    lambda s: s["roc_auc"]).alias("fold_aucs"),
        F.avg("roc_auc").alias("mean_auc"), F.stddev_pop("roc_auc").alias("std_auc"))


def segment_auc(df: DataFrame, segment: str, label: str = TARGET_COL, score: str = "score",
                min_pos: int = 5, min_neg: int = 5) -> DataFrame:
    """AUC within every segment that has enough rows of both classes."""
    per = roc_auc(df, label, score, [segment])
    enough = (F.col("positives") >= min_pos) & (F.col("n") - F.col("positives") >= min_neg)
    return per.where(enough).select(segment, "n", "roc_auc")


def rate_band(col: str = "annual_rate_pct") -> Column:
    """Report bands: below 40 percent, and 40 percent or more; missing counts as 0."""
    return F.when(F.coalesce(F.col(col), F.lit(0.0)) < 40, "Bank (<40%)").otherwise("MFI (>=40%)")


def calibration_curve(df: DataFrame, label: str = TARGET_COL, score: str = "score",
                      bins: int = CALIBRATION_BINS, buckets: int | None = None) -> DataFrame:
    """(bin, n, mean_score, positive_rate) over quantile bins, empty bins left out."""
    edges = exact_quantiles(df, [score], [(i, bins) for i in range(1, bins)], buckets)
    inner = [r["value"] for r in edges.orderBy("q").collect()]
    below = F.lit(0)
    for e in inner:
        below = below + (F.lit(e) < F.col(score)).cast("int")
    binned = df.where(F.col(score).isNotNull()).withColumn("bin", below)
    return binned.groupBy("bin").agg(
        F.count(F.lit(1)).alias("n"), F.avg(score).alias("mean_score"),
        F.avg(F.col(label).cast("double")).alias("positive_rate"))


def score_histogram(df: DataFrame, label: str = TARGET_COL, score: str = "score",
                    bins: int = 50) -> DataFrame:
    return histogram(df, [score], bins, by=label)


def ranked_models(metrics: DataFrame, value: str = "mean_auc") -> DataFrame:
    return metrics.orderBy(F.desc(value), "model")


def best_model(metrics: DataFrame, value: str = "roc_auc") -> DataFrame:
    """The row with the highest value; the first name wins a tie."""
    return metrics.orderBy(F.desc(value), "model").limit(1)

