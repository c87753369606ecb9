"""Isotonic regression in parallel: pooled blocks of score ranges, merged by a tree.

Pooling adjacent violators of a whole is the pooling of the blocks of its parts.
So score ranges are pooled by tasks of their own, and neighbouring ranges are
merged, ``FAN`` at a time, until one list of blocks is left. Sums are whole
numbers where labels are, so blocks do not depend on the ranges. With labels of
0 and 1 the means of blocks are different fractions with small denominators:
N rows make at most some N^(2/3) blocks, in practice N^(1/3).
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.operators.joins import BROADCAST_ROWS, hot_key_lookup
from loanloom.operators.ordered import _cut_points, _with_bucket, bucket_count
from loanloom.schema import TARGET_COL
from loanloom.session import materialize

#: Ranges that one merge takes.
FAN = 16
BLOCKS = pa.schema([("part", pa.int32()), ("low", pa.float64()), ("high", pa.float64()), ("total", pa.float64()), ("weight", pa.float64())])
BLOCKS_SQL = "part int, low double, high double, total double, weight double"


def pool(points: Iterable[tuple[float, float, float, float]]) -> list[list[float]]:
    """(low, high, total, weight) in rising order -> blocks with rising means; equal means are one block."""
    out: list[list[float]] = []
    for low, high, total, weight in points:
        block = [low, high, total, weight]
        while out and out[-1][2] * block[3] >= block[2] * out[-1][3]:
            last = out.pop()
            block = [last[0], block[1], last[2] + block[2], last[3] + block[3]]
        out.append(block)
    return out


def _table(part: int, blocks: list[list[float]]) -> list[pa.Array]:
    columns = list(zip(*blocks, strict=True)) if blocks else [[]] * 4
    return [pa.array([part] * len(blocks), pa.int32()), *[pa.array(c, pa.float64()) for c in columns]]


def _pool_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (part, low, high, total, weight) sorted by part and low -> blocks of each part."""
    part, blocks = None, []
    for batch in batches:
        parts = batch.column(0).to_numpy()
        cut = np.flatnonzero(np.r_[True, parts[1:] != parts[:-1]]) if len(parts) else []
        values = [batch.column(i).to_pylist() for i in range(1, 5)]
        for lo, hi in zip(cut, [*cut[1:], len(parts)], strict=True):
            if part is not None and part != parts[lo]:
                yield pa.RecordBatch.from_arrays(_table(part, blocks), schema=BLOCKS)
                blocks = []
            part = int(parts[lo])
            blocks = pool([*blocks, *zip(*[v[lo:hi] for v in values], strict=True)])
    if part is not None:
        yield pa.RecordBatch.from_arrays(_table(part, blocks), schema=BLOCKS)


def isotonic_blocks(rows: DataFrame, score: str = "score", label: str = TARGET_COL, buckets: int | None = None) -> DataFrame:
    """(low, high, value, weight): the blocks in rising order of score, as a written table. Null scores and labels are left out."""
    known = rows.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    n_rows = known.count()
    buckets = bucket_count(n_rows, buckets)
    cells = known.groupBy(F.col(score).cast("double").alias("low")).agg(
        F.sum(F.col(label).cast("double")).alias("total"), F.count(F.lit(1)).cast("double").alias("weight"))
    cuts = _cut_points(known.select(F.col(score).cast("double").alias("low")), "low", [], n_rows, buckets)
    parts = _with_bucket(cells, "low", cuts).select(
        F.col("_bucket").cast("int").alias("part"), "low", F.col("low").alias("high"), "total", "weight")
    while True:
        parts = materialize(parts.repartition(min(buckets, 512), "part").sortWithinPartitions("part", "low").mapInArrow(_pool_ranges, BLOCKS_SQL))
        if buckets == 1:
            return parts.select("low", "high", (F.col("total") / F.col("weight")).alias("value"), "weight")
        buckets = -(-buckets // FAN)
        parts = parts.withColumn("part", F.floor(F.col("part") / FAN).cast("int"))


def _knots(blocks: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    rows = blocks.orderBy("low").select("low", "high", "value").toArrow()
    low, high, value = (rows.column(i).to_numpy() for i in range(3))
    return np.stack([low, high], axis=1).ravel(), np.repeat(value, 2)


def apply_blocks(rows: DataFrame, blocks: DataFrame, score: str = "score", output: str = "score", limit: int = BROADCAST_ROWS) -> DataFrame:
    """``rows`` with the calibrated score: constant inside and outside blocks, linear between them; null stays null.

    Up to ``limit`` blocks go along with the tasks. More of them are dealt into
    ranges, each with the knots around it, and looked up by range.
    """
    n = blocks.count()
    if not n:
        raise ValueError("no rows to learn from")
    if n <= limit:
        xs, ys = _knots(blocks)

        @F.pandas_udf("double")
        def level(s: pd.Series) -> pd.Series:
            return pd.Series(np.where(s.isna(), np.nan, np.interp(s.to_numpy(float), xs, ys)))

        found = level(F.col(score).cast("double"))
        return rows.withColumn(output, F.when(F.col(score).isNotNull(), found))
    ends = blocks.select(F.explode(F.array("low", "high")).alias("x"), "value")
    cuts = _cut_points(ends, "x", [], 2 * n, max(2, n // 4096))
    count = len(cuts) + 1
    inside = _with_bucket(ends, "x", cuts).groupBy("_bucket").agg(
        F.sort_array(F.collect_list(F.struct("x", "value"))).alias("k"))
    held = {r["_bucket"]: (r["f"], r["l"]) for r in inside.select("_bucket", F.col("k")[0].alias("f"), F.element_at("k", -1).alias("l")).collect()}
    # ranges without knots of their own still need those on both sides
    around, last = [], None
    for b in range(count):
        after = next((held[c][0] for c in range(b + 1, count) if c in held), None)
        around.append((b, last, after))
        last = held[b][1] if b in held else last
    spark = rows.sparkSession
    side = spark.createDataFrame(around, "_bucket int, before struct<x:double,value:double>, after struct<x:double,value:double>")
    weights = _with_bucket(rows.where(F.col(score).isNotNull()).withColumn("_s", F.col(score).cast("double")), "_s", cuts).groupBy(
        F.col("_bucket").cast("int").alias("_bucket")).agg(F.count(F.lit(1)).alias("_w"))
    inside = inside.withColumn("_bucket", F.col("_bucket").cast("int"))
    table = materialize(side.join(inside, "_bucket", "left").join(weights, "_bucket").select(
        "_bucket", "_w", F.filter(F.concat(F.array("before"), F.coalesce("k", F.array().cast("array<struct<x:double,value:double>>")),
                                           F.array("after")), lambda e: e.isNotNull()).alias("_knots")))
    keyed = _with_bucket(rows.withColumn("_s", F.col(score).cast("double")), "_s", cuts).withColumn("_bucket", F.col("_bucket").cast("int"))
    joined = hot_key_lookup(keyed, table, ["_bucket"], "_w")

    @F.pandas_udf("double")
    def near(s: pd.Series, x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([np.nan if a is None else float(np.interp(v, a, b)) for v, a, b in zip(s, x, y, strict=True)])

    found = near(F.col("_s"), F.col("_knots.x"), F.col("_knots.value"))
    return joined.withColumn(output, F.when(F.col(score).isNotNull(), found)).select(*dict.fromkeys([*rows.columns, output]))


# task functions travel with the job, so executors need no copy of the library
cloudpickle.register_pickle_by_value(sys.modules[__name__])
