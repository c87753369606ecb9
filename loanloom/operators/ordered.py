"""Exact ordered computations without putting all rows in one task.

Rows are first collapsed to distinct values with counts, which also makes ties
exact. Values are then cut into buckets of about equal numbers of distinct
values; running totals come from a window inside each bucket plus the totals
of the buckets before it. Cut points only steer the balance: any set of cut
points gives the same result.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanloom.operators.joins import BROADCAST_ROWS, lookup
from loanloom.session import materialize

ROWS_PER_BUCKET = 1_000_000
MAX_BUCKETS = 8192
SAMPLE_PER_BUCKET = 16
# Up to this many values one exact percentile aggregate holds them all.
SMALL_AGGREGATE = 1_000_000


def bucket_count(n_rows: int | None, buckets: int | None = None) -> int:
    if buckets is not None:
        return max(1, buckets)
    return max(1, min(MAX_BUCKETS, math.ceil(n_rows / ROWS_PER_BUCKET)))


def _cut_points(df: DataFrame, value: str, keys: Sequence[str], n_rows: int, buckets: int) -> list:
    """Up to ``buckets - 1`` rising cut points from a hash sample of the values.

    The sample holds about ``SAMPLE_PER_BUCKET * buckets`` distinct values,
    whatever the input size, because it is drawn by the hash of the value.
    """
    if buckets <= 1:
        return []
    step = max(1, n_rows // (SAMPLE_PER_BUCKET * buckets))
    picked = F.pmod(F.xxhash64(*keys, value), F.lit(step)) == 0
    sample = df.where(picked).select(*keys, value).distinct().select(value)
    points = sorted(r[0] for r in sample.collect())
    every = max(1, math.ceil(len(points) / buckets))
    return sorted(set(points[every::every]))


def _with_bucket(df: DataFrame, value: str, cuts: list) -> DataFrame:
    if not cuts:
        return df.withColumn("_bucket", F.lit(0))
    if isinstance(cuts[0], str):
        # binary search in the sorted cut points
        n, edges = len(cuts), F.array(*[F.lit(c) for c in cuts])
        jumps = F.array(*[F.lit(1 << b) for b in reversed(range(n.bit_length()))])

        def step(at, jump):
            fits = (at + jump <= n) & (F.element_at(edges, F.least(at + jump, F.lit(n))) <= F.col(value))
            return F.when(fits, at + jump).otherwise(at)

        return df.withColumn("_bucket", F.aggregate(jumps, F.lit(0), step))
    splits = [-math.inf, *[float(c) for c in cuts], math.inf]
    edges = df.withColumn("_edge", F.col(value).cast("double"))
    cutter = Bucketizer(splits=splits, inputCol="_edge", outputCol="_bucket", handleInvalid="keep")
    return cutter.transform(edges).drop("_edge").withColumn("_bucket", F.col("_bucket").cast("int"))


def _column_buckets(df: DataFrame, long: DataFrame, cols: Sequence[str], n_values: int, buckets: int) -> DataFrame:
    """(column_name, x, _bucket) of all values, each column cut by its own values into buckets of about equal numbers of rows.

    Cut points come from some values of ``long``, about ``SAMPLE_PER_BUCKET`` a bucket and column. A value with many rows
    fills a bucket of its own, so that few rows lie in the bucket of any position.
    """
    points: dict[str, list[float]] = {c: [] for c in cols}
    if buckets > 1:
        share = min(1.0, SAMPLE_PER_BUCKET * buckets * len(points) / max(1, n_values))
        for r in (long.sample(share, 1) if share < 1 else long).collect():
            if math.isfinite(r["x"]):
                points[r["column_name"]].append(r["x"])
    out, places = df.select(*[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(cols)]), []
    for i, c in enumerate(cols):
        found = sorted(points[c])
        every = max(1, math.ceil(len(found) / buckets))
        cuts = sorted(set(found[every::every]))
        if cuts:
            cutter = Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol=f"_x{i}", outputCol=f"_b{i}", handleInvalid="keep")
            out = cutter.transform(out)
        places += [F.lit(c), F.col(f"_x{i}"), F.col(f"_b{i}").cast("int") if cuts else F.lit(0)]
    return _present(out.select(F.stack(F.lit(len(cols)), *places).alias("column_name", "x", "_bucket")), ["x"])


def _present(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    for c in cols:
        df = df.where(F.col(c).isNotNull())
    return df


def _bucket_offsets(bucketed: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Per group and bucket: totals of earlier buckets and of the whole group.

    The window runs over at most ``MAX_BUCKETS`` pre-aggregated rows per group.
    """
    per_bucket = bucketed.groupBy(*keys, "_bucket").agg(*[F.sum(s).alias(s) for s in sums])
    group = Window.partitionBy(*keys)
    earlier = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return per_bucket.select(
        *keys, "_bucket",
        *[F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(f"_off_{s}") for s in sums],
        *[F.sum(s).over(group).alias(f"total_{s}") for s in sums],
    )


def running_totals(
    df: DataFrame,
    value: str,
    keys: Sequence[str] = (),
    sums: Mapping[str, Column] | None = None,
    buckets: int | None = None,
    n_rows: int | None = None,
) -> DataFrame:
    """One row per group and distinct value, in rising order of the value.

    ``n`` counts the rows; each entry of ``sums`` is summed too. For every sum
    ``x`` there are ``before_x`` (over smaller values) and ``total_x`` (over the
    group). Rows with a null value or group are left out. The rows are counted
    first unless the caller knows ``n_rows``.
    """
    keys = list(keys)
    rows = _present(df, [*keys, value])
    extra = dict(sums or {})
    names = ["n", *extra]
    if n_rows is None and buckets != 1:
        n_rows = rows.count()
    buckets = bucket_count(n_rows, buckets)
    cuts = _cut_points(rows, value, keys, n_rows, buckets)
    collapsed = rows.groupBy(*keys, value).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(s) for s, c in extra.items()])
    bucketed = _with_bucket(collapsed, value, cuts)
    offsets = _bucket_offsets(bucketed, keys, names)
    inside = (Window.partitionBy(*keys, "_bucket").orderBy(value)
              .rowsBetween(Window.unboundedPreceding, -1))
    ran = bucketed.select(
        *keys, "_bucket", value, *names,
        *[F.coalesce(F.sum(s).over(inside), F.lit(0)).alias(f"_in_{s}") for s in names])
    return ran.join(offsets, [*keys, "_bucket"]).select(
        *keys, value, *names,
        *[(F.col(f"_off_{s}") + F.col(f"_in_{s}")).alias(f"before_{s}") for s in names],
        *[f"total_{s}" for s in names])


def average_ranks(df: DataFrame, value: str, keys: Sequence[str] = (),
                  buckets: int | None = None, n_rows: int | None = None) -> DataFrame:
    """Average-tie rank of every distinct value in its group, with its count."""
    t = running_totals(df, value, keys, buckets=buckets, n_rows=n_rows)
    return t.select(
        *keys, value, "n", F.col("total_n").alias("group_n"),
        (F.col("before_n") + (F.col("n") + 1) / F.lit(2.0)).alias("avg_rank"))


def attach_ranks(df: DataFrame, value: str, keys: Sequence[str] = (), rank: str = "avg_rank",
                 size: str = "group_n", buckets: int | None = None,
                 source: DataFrame | None = None,
                 broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Add the average-tie rank of every row and the size of its group.

    A null value or group gives nulls. ``source`` may hold the same rows with
    fewer columns and a shorter plan; the ranks are computed from it.
    """
    keys = list(keys)
    base = (df if source is None else source).select(*keys, value)
    n_rows = _present(base, [*keys, value]).count()
    table = average_ranks(base, value, keys, buckets, n_rows).select(
        *keys, value, "n", F.col("avg_rank").alias(rank), F.col("group_n").alias(size))
    return lookup(df, table, [*keys, value], n_rows, "n", broadcast_rows, total=n_rows)


def percent_rank_in_group(df: DataFrame, value: str, keys: Sequence[str] = (),
                          output: str = "pct_rank", buckets: int | None = None,
                          source: DataFrame | None = None,
                          broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Add rank / group size with average ties; null value or group gives null."""
    ranked = attach_ranks(df, value, keys, "_rank", "_size", buckets, source, broadcast_rows)
    return ranked.select(*df.columns, (F.col("_rank") / F.col("_size")).alias(output))


def hash_row_numbers(df: DataFrame, order: Column, id_col: str, keys: Sequence[str] = (),
                     across: Sequence[str] = (), digits: int = 3,
                     output: str = "row_number") -> DataFrame:
    """1-based position by (``across``, hash text, id) within each ``keys`` group.

    The bucket is the first ``digits`` hex digits of the hash, so it is balanced
    without looking at the data. ``across`` columns come before the hash in the
    order and must have few values (classes, for example).
    """
    keys, across = list(keys), list(across)
    bucketed = df.withColumn("_h", order).withColumn("_bucket", F.substring("_h", 1, digits))
    cell = [*keys, *across, "_bucket"]
    per_bucket = bucketed.groupBy(*cell).agg(F.count(F.lit(1)).alias("_n"))
    earlier = (Window.partitionBy(*keys).orderBy(*across, "_bucket")
               .rowsBetween(Window.unboundedPreceding, -1))
    # at most classes * 16**digits rows, one per bucket
    offsets = per_bucket.select(
        *cell, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"))
    inside = Window.partitionBy(*cell).orderBy("_h", id_col)
    numbered = bucketed.withColumn("_rn", F.row_number().over(inside))
    return numbered.join(offsets, cell).select(
        *df.columns, (F.col("_off") + F.col("_rn")).alias(output))


def exact_quantiles(
    df: DataFrame,
    cols: Sequence[str],
    fractions: Sequence[tuple[int, int]] = ((1, 2),),
    buckets: int | None = None,
    small: int = SMALL_AGGREGATE,
) -> DataFrame:
    """Interpolated quantiles of several columns: (column_name, q, value, n).

    ``fractions`` are (numerator, denominator) pairs; ``q`` is the position in
    that list. Large input is narrowed to the buckets that hold the wanted
    positions before anything is sorted.
    """
    cols = list(cols)
    long = _present(
        df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
            [], cols, "column_name", "x"), ["x"])
    n_rows = long.count()
    if n_rows <= small and buckets is None:
        cells = long
        offsets = None
    else:
        cells = _column_buckets(df, long, cols, n_rows, bucket_count(n_rows, buckets))
        # one row per column and bucket, written since several steps need it
        counts = materialize(cells.groupBy("column_name", "_bucket").agg(F.count(F.lit(1)).alias("in_n")))
        offsets = _bucket_offsets(counts.withColumn("n", F.col("in_n")), ["column_name"], ["n"])
    wanted = F.explode(F.array(*[
        F.struct(F.lit(i).alias("q"), F.lit(a).cast("long").alias("a"),
                 F.lit(b).cast("long").alias("b"))
        for i, (a, b) in enumerate(fractions)]))

    def positions(totals: DataFrame) -> DataFrame:
        """The two 0-based neighbours of every quantile and the weight of the second."""
        p = totals.withColumn("_w", wanted).select(
            "column_name", "total_n", F.col("_w.q").alias("q"), F.col("_w.b").alias("b"),
            (F.col("_w.a") * (F.col("total_n") - 1)).alias("m"))
        low = F.floor(F.col("m") / F.col("b")).cast("long")
        return p.select(
            "column_name", "q", "total_n", low.alias("low"),
            F.least(low + 1, F.col("total_n") - 1).alias("high"),
            ((F.col("m") - low * F.col("b")) / F.col("b")).alias("part"))

    counted = None
    if offsets is None:
        counted = cells.groupBy("column_name", "x").agg(F.count(F.lit(1)).alias("n"))
        group = Window.partitionBy("column_name")
        ordered = group.orderBy("x").rowsBetween(Window.unboundedPreceding, -1)
        counted = counted.select(
            "column_name", "x", "n", F.coalesce(F.sum("n").over(ordered), F.lit(0)).alias("before"),
            F.sum("n").over(group).alias("total_n"))
        spots = positions(counted.groupBy("column_name").agg(F.max("total_n").alias("total_n")))
    else:
        offsets = counts.join(offsets, ["column_name", "_bucket"])
        spots = positions(offsets.groupBy("column_name").agg(F.max("total_n").alias("total_n")))
        holds = ((F.col("low") < F.col("_off_n") + F.col("in_n"))
                 & (F.col("high") >= F.col("_off_n")))
        # at most two buckets per column and quantile
        needed = (offsets.join(F.broadcast(spots), "column_name").where(holds)
                  .select("column_name", "_bucket", "_off_n").distinct())
        # the other buckets go before rows are matched one by one
        held: dict[str, set[int]] = {}
        for r in needed.collect():
            held.setdefault(r["column_name"], set()).add(r["_bucket"])
        inner = F.lit(False)
        for c, found in held.items():
            inner = inner | ((F.col("column_name") == c) & F.col("_bucket").isin(sorted(found)))
        values = cells.where(inner).groupBy("column_name", "_bucket", "x").agg(F.count(F.lit(1)).alias("n"))
        counted = values.join(F.broadcast(needed.withColumnRenamed("_off_n", "off")), ["column_name", "_bucket"])
        inside = (Window.partitionBy("column_name", "_bucket").orderBy("x")
                  .rowsBetween(Window.unboundedPreceding, -1))
        counted = counted.select(
            "column_name", "x", "n",
            (F.col("off") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("before"))
    covers_low = (F.col("before") <= F.col("low")) & (F.col("low") < F.col("before") + F.col("n"))
    covers_high = (F.col("before") <= F.col("high")) & (F.col("high") < F.col("before") + F.col("n"))
    picked = counted.drop("total_n").join(F.broadcast(spots), "column_name").where(
        covers_low | covers_high)
    ends = picked.groupBy("column_name", "q").agg(
        F.max(F.when(covers_low, F.col("x"))).alias("a"),
        F.max(F.when(covers_high, F.col("x"))).alias("b"),
        F.max("part").alias("part"), F.max("total_n").alias("n"))
    return ends.select(
        "column_name", "q",
        (F.col("a") + (F.col("b") - F.col("a")) * F.col("part")).alias("value"), "n")


def medians(df: DataFrame, cols: Sequence[str], **kw) -> dict[str, float]:
    """Exact interpolated median per column, as fitted constants."""
    found = exact_quantiles(df, cols, **kw).select("column_name", "value").collect()
    return {r["column_name"]: r["value"] for r in found}
