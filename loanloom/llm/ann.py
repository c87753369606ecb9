"""Nearest neighbours by a block matrix join: int8 tiles with error bounds, then exact products, merged by heaps.

Each vector is split into a scale times int8 components and a rest. The product
of two vectors differs from the scaled int8 product by at most what the norms
of the rests allow, so every tile of products gives a lower and an upper bound
for each pair. Pairs whose upper bound is below the k-th largest lower bound of
their query cannot be among its k nearest; the others are recomputed in double
precision on the original components. Results are exact.

Every query block meets every candidate block once, as equal keys of a join;
a task holds two blocks. The k best of each meeting go to a merge by heap.
"""

from __future__ import annotations

import heapq
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm.tables import materialize, partitions

#: Least and largest number of rows of a candidate block (it follows the data), and rows of a query block.
CANDIDATES = 4096, 32_768
QUERIES = 4096
#: Products that are held at once.
TILE = 1 << 20


def _usable(rows: DataFrame) -> DataFrame:
    """Vectors that take part: no null, not empty, finite, not all zero, a row id."""
    e = F.col("embedding")
    x = F.transform(e, lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    whole = e.isNotNull() & F.col("vec_id").isNotNull() & (F.size(e) > 0)
    return rows.select("vec_id", F.when(whole, x).alias("x"), F.when(whole, bad).otherwise(True).alias("bad")).where(
        ~F.col("bad")).where(F.exists("x", lambda v: v != 0)).select("vec_id", "x", F.size("x").alias("dim"))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block key columns ..., vec_id, x) sorted by block -> vec ids and float64 matrices in one row a block and batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        dim, block = (batch.column(i).to_numpy() for i in range(2))
        cut = np.flatnonzero(np.r_[True, (dim[1:] != dim[:-1]) | (block[1:] != block[:-1])])
        ids = batch.column(2).to_numpy()
        out = []
        for lo, hi in zip(cut, np.r_[cut[1:], len(dim)], strict=True):
            x = batch.column(3).slice(lo, hi - lo).flatten().to_numpy(zero_copy_only=False)
            out.append((int(dim[lo]), int(block[lo]), ids[lo:hi].tobytes(), x.astype(np.float64).tobytes()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), pa.int32(), pa.binary(), pa.binary()),
                                            strict=True)], ["dim", "block", "ids", "x"])


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 components (as float32), scales, norms of what they stand for, and norms of the rests, rounded up."""
    top = np.abs(x).max(axis=1, keepdims=True)
    scale = np.where(top > 0, top / 127, 1.0)
    q = np.rint(x / scale)
    back = q * scale
    up = 1 + 1e-9
    return (q.astype(np.float32), scale[:, 0], np.linalg.norm(back, axis=1) * up,
            np.linalg.norm(x - back, axis=1) * up + 1e-300)


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row products in double precision, added in the order of the components."""
    out = np.zeros(len(a))
    for d in range(a.shape[1]):
        out += a[:, d] * b[:, d]
    return out


def tile_top(qi: np.ndarray, q: np.ndarray, ci: np.ndarray, c: np.ndarray, k: int):
    """(query index, vec id, score) of each query's k nearest of one candidate block, exact."""
    q8, qs, qn, qe = quantise(q)
    c8, cs, cn, ce = quantise(c)
    step = max(1, TILE // max(1, len(c)))
    full = np.linalg.norm(c, axis=1) * (1 + 1e-9)
    out = []
    for lo in range(0, len(q), step):
        part = slice(lo, lo + step)
        # sums of at most 64k products of int8 are whole numbers; single precision holds them up to 2^24
        wide = q8[part].astype(np.float64) @ c8.T if q.shape[1] > 1000 else q8[part] @ c8.T
        near = wide * qs[part, None] * cs
        # |q.c - q'.c'| <= |q - q'| |c| + |q'| |c - c'|; the last part covers rounding in the bounds themselves
        slack = qe[part, None] * full + qn[part, None] * ce + 1e-9 * qn[part, None] * cn
        own = ci[None, :] == qi[part, None]
        low = np.where(own, -np.inf, near - slack)
        high = np.where(own, -np.inf, near + slack)
        n = min(k, low.shape[1])
        least = np.partition(low, low.shape[1] - n, axis=1)[:, low.shape[1] - n]
        i, j = np.nonzero((high >= least[:, None]) & ~own)
        if not len(i):
            continue
        score = np.concatenate([exact(q[lo + i[a:a + TILE // 8]], c[j[a:a + TILE // 8]])
                                for a in range(0, len(i), TILE // 8)])
        order = np.lexsort((ci[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        first = np.searchsorted(i, i)
        keep = np.arange(len(i)) - first < k
        out.append((lo + i[keep], ci[j[keep]], score[keep]))
    if not out:
        return np.zeros(0, int), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(v) for v in zip(*out, strict=True))


def _meet(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                qi, ci = np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["ids"], np.int64)
                q = np.frombuffer(row["q_x"], np.float64).reshape(len(qi), -1)
                c = np.frombuffer(row["x"], np.float64).reshape(len(ci), -1)
                i, vec, score = tile_top(qi, q, ci, c, k)
                yield pa.RecordBatch.from_arrays([pa.array(qi[i]), pa.array(vec), pa.array(score)],
                                                 ["query_id", "vec_id", "score"])

    return run


def _merge(k: int):
    """Partial results sorted by query -> the k best of each, by a heap that never holds more than k."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                yield from zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)

        out: list[tuple] = []
        for query, group in itertools.groupby(rows(), key=lambda r: r[0]):
            heap: list[tuple[float, int]] = []
            for _, vec, score in group:
                (heapq.heappush if len(heap) < k else heapq.heappushpop)(heap, (score, -vec))
            out += [(query, r + 1, -v, s) for r, (s, v) in enumerate(sorted(heap, reverse=True))]
            if len(out) > 50_000:
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(SCHEMA.names, r, strict=True)) for r in out], schema=SCHEMA)
                out = []
        yield pa.RecordBatch.from_pylist([dict(zip(SCHEMA.names, r, strict=True)) for r in out], schema=SCHEMA)

    return run


SCHEMA = pa.schema([("query_id", pa.int64()), ("rank", pa.int32()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _blocks(rows: DataFrame, count: int, size: int) -> tuple[DataFrame, int]:
    n = max(1, math.ceil(count / size))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    spread = partitions(rows.sparkSession)
    keyed = rows.select("dim", block.alias("block"), "vec_id", "x")
    return keyed.repartition(max(n, spread), "block").sortWithinPartitions("dim", "block").mapInArrow(
        _pack, "dim int, block int, ids binary, x binary"), n


def nearest(rows: DataFrame, k: int = 20, query: str = "vec_id % 20 = 0") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest rows of each query row by inner product.

    Candidates are all rows but the query's own (by vec_id), of the query's
    length. Vectors that are null, empty, zero or hold null or non-finite
    components take no part on either side. Ties go to the smaller vec_id.
    ``query`` is an SQL condition that picks the queries.
    """
    use = materialize(_usable(rows))
    asked = use.where(query)
    count = use.count()
    least, most = CANDIDATES
    cands, n = _blocks(use, count, min(most, max(least, count // partitions(rows.sparkSession))))
    queries, _ = _blocks(asked, asked.count(), QUERIES)
    cands = materialize(cands)
    queries = materialize(queries.select("dim", F.col("block").alias("q_block"), F.col("ids").alias("q_ids"),
                                         F.col("x").alias("q_x")))
    copies = queries.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    meet = copies.join(cands, ["dim", "block"]).select("q_ids", "q_x", "ids", "x")
    tops = meet.mapInArrow(_meet(k), "query_id long, vec_id long, score double")
    spread = partitions(rows.sparkSession)
    return tops.repartition(spread, "query_id").sortWithinPartitions("query_id").mapInArrow(
        _merge(k), "query_id long, rank int, vec_id long, score double")
