"""Hard negatives by Four-Russians scoring: subset sums of the anchors, looked up by the bits of the candidates.

Components are whole numbers. The dimensions are cut into groups of eight. For
an anchor, a table of 256 sums per group holds the sum of every subset of the
group's eight components. A candidate is kept as bit planes: plane ``b`` has one
byte per group, the ``b``-th two's-complement bits of its eight components. One
table lookup per group and plane adds what that plane contributes, and the
planes are put together by doubling from the top one (which counts negative)
down. That is the full inner product, exact.

Every anchor block meets every candidate block once, as equal keys of a join; a
task holds two blocks. The first pass finds each anchor's positives, the second
one the negatives between the bounds that each positive sets. A meeting returns
at most ``k`` rows per anchor (first pass) or per positive (second pass), so no
label and no anchor gathers many rows anywhere.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanloom.llm.tables import materialize, partitions

GROUP = 8
#: Least and largest number of rows of a candidate block (it follows the data), and rows of an anchor block.
CANDIDATES = 4096, 65_536
ANCHORS = 1024
#: Anchors whose tables are held at once, and candidates that are looked up at once.
TABLES = 64
ROWS = 4096
#: Components are held to 32 bits.
LIMIT = float(1 << 31)


def _usable(rows: DataFrame) -> DataFrame:
    """vec_id, label, v (whole components), dim of the rows that take part."""
    x = F.transform("embedding", lambda e: e.cast("double"))
    whole = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0)
    picked = rows.where(whole).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"), x.alias("x"))
    bad = F.exists("x", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == F.lit(float("inf"))))
    held = F.transform("x", lambda e: F.greatest(F.least(F.floor(F.greatest(F.least(e, F.lit(LIMIT)), F.lit(-LIMIT)) * 256),
                                                         F.lit((1 << 31) - 1)), F.lit(-(1 << 31))).cast("int"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).cast("int")
    return picked.where(~bad).select("vec_id", label.alias("label"), held.alias("v"), F.size("x").alias("dim"))


def bit_planes(v: np.ndarray) -> np.ndarray:
    """Whole numbers (rows x dims) -> planes x rows x groups of packed bits, two's complement, lowest plane first."""
    width = max(int(v.max(initial=0)).bit_length(), int(-1 - v.min(initial=0)).bit_length()) + 1
    spare = -v.shape[1] % GROUP
    if spare:
        v = np.pad(v, ((0, 0), (0, spare)))
    out = np.empty((width, len(v), v.shape[1] // GROUP), np.uint8)
    for b in range(width):
        out[b] = np.packbits(((v >> b) & 1).astype(np.uint8), axis=1, bitorder="little")
    return out


def subset_sums(a: np.ndarray) -> np.ndarray:
    """Anchors (anchors x dims) -> groups x 256 x anchors: the sum of every subset of each group's components."""
    spare = -a.shape[1] % GROUP
    if spare:
        a = np.pad(a, ((0, 0), (0, spare)))
    parts = a.T.reshape(-1, GROUP, len(a))
    out = np.zeros((len(parts), 1 << GROUP, len(a)), a.dtype)
    for bit in range(GROUP):
        step = 1 << bit
        out[:, step:2 * step] = out[:, :step] + parts[:, bit, None, :]
    return out


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Candidates x anchors: the exact inner products, by lookups and doubling."""
    total = None
    for plane in planes[::-1]:
        part = tables[0].take(plane[:, 0], axis=0)
        for g in range(1, len(tables)):
            part += tables[g].take(plane[:, g], axis=0)
        if total is None:
            total = np.negative(part, out=part)
        else:
            total += total
            total += part
    return total


def _narrow(anchors: np.ndarray, n_planes: int) -> np.ndarray:
    """32-bit anchors where no sum can leave 32 bits, else 64."""
    worst = anchors.shape[1] * (int(np.abs(anchors).max(initial=0)) + 1) << n_planes
    return anchors.astype(np.int32 if worst < 1 << 31 else np.int64)


def _first(rank: np.ndarray, key: np.ndarray, k: int) -> np.ndarray:
    """Indices of the ``k`` first by (rank falling, key rising), in order; ties at the edge are looked at whole."""
    if len(rank) > 4 * k:
        edge = np.partition(rank, len(rank) - k)[len(rank) - k]
        near = np.flatnonzero(rank >= edge)
    else:
        near = np.arange(len(rank))
    return near[np.lexsort((key[near], -rank[near]))[:k]]


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """dim, block, vec_id, label, v sorted by dim and block -> one row a block and batch, components as bit planes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        dim, block, ids, label = (batch.column(i).to_numpy() for i in range(4))
        cut = np.flatnonzero(np.r_[True, (dim[1:] != dim[:-1]) | (block[1:] != block[:-1])])
        for lo, hi in zip(cut, np.r_[cut[1:], len(dim)], strict=True):
            v = batch.column(4).slice(lo, hi - lo).flatten().to_numpy(zero_copy_only=False).reshape(hi - lo, -1)
            planes = bit_planes(v.astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(dim[lo])], pa.int32()), pa.array([int(block[lo])], pa.int32()),
                 pa.array([ids[lo:hi].tobytes()], pa.binary()), pa.array([label[lo:hi].tobytes()], pa.binary()),
                 pa.array([len(planes)], pa.int32()), pa.array([planes.tobytes()], pa.binary())],
                ["dim", "block", "ids", "labels", "n_planes", "planes"])


def _tiles(row: dict) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(anchor places, candidate ids, candidate labels, scores) of the tiles of one meeting."""
    ids = np.frombuffer(row["ids"], np.int64)
    labels = np.frombuffer(row["labels"], np.int32)
    planes = np.frombuffer(row["planes"], np.uint8).reshape(row["n_planes"], len(ids), -1)
    anchors = np.array(row["a_v"], np.int64)
    for lo in range(0, len(anchors), TABLES):
        tables = subset_sums(_narrow(anchors[lo:lo + TABLES], row["n_planes"]))
        for r in range(0, len(ids), ROWS):
            part = slice(r, r + ROWS)
            found = scores(tables, np.ascontiguousarray(planes[:, part]))
            yield np.arange(lo, min(lo + TABLES, len(anchors))), ids[part], labels[part], found


def _positives(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                out: list[tuple] = []
                for places, ids, labels, found in _tiles(row):
                    for col, a in enumerate(places):
                        own = np.flatnonzero((labels == row["a_label"][a]) & (ids != row["a_id"][a]))
                        score = found[own, col].astype(np.int64)
                        top = _first(score, ids[own], k)
                        out += zip([row["a_key"][a]] * len(top), ids[own[top]].tolist(), score[top].tolist(), strict=True)
                yield _batch(out, ["a_key", "vec_id", "score"], [pa.int64()] * 3)

    return run


def _negatives(k: int, least: int, of: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                out: list[tuple] = []
                for places, ids, labels, found in _tiles(row):
                    for col, a in enumerate(places):
                        other = np.flatnonzero(labels != row["a_label"][a])
                        score = found[other, col].astype(np.int64)
                        order = np.lexsort((ids[other], -score))
                        falling = -score[order]
                        for place, bound in enumerate(row["a_bounds"][a]):
                            # falling order: from the first score of at most the bound to the last of at least its share
                            lo = int(np.searchsorted(falling, -bound, "left"))
                            hi = int(np.searchsorted(falling, -(-(-least * bound // of)), "right"))
                            for j in order[lo:min(hi, lo + k)]:
                                out.append((row["a_key"][a], place, int(ids[other[j]]), int(score[j])))
                yield _batch(out, ["a_key", "place", "vec_id", "score"], [pa.int64(), pa.int32(), pa.int64(), pa.int64()])

    return run


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)


def _meetings(anchors: DataFrame, n: int, cands: DataFrame, copies: int, *more: str) -> DataFrame:
    """Blocks of anchors beside blocks of candidates: a row for each two of one length.

    The copies of the anchors, one for each candidate block, are as many bytes as
    anchors times blocks. They are made in tasks and shuffled; a broadcast, which
    their written size would allow, would bring all of them to the driver.
    """
    parts = partitions(anchors.sparkSession)
    left, right = (t.repartition(parts, "dim", "block") for t in (_anchor_blocks(anchors, n, copies, *more), cands))
    return left.join(right.hint("merge"), ["dim", "block"]).drop("dim", "block")


def _anchor_blocks(anchors: DataFrame, n: int, copies: int, *more: str) -> DataFrame:
    """Blocks of anchors, one copy for each candidate block."""
    blocks = max(1, math.ceil(n / ANCHORS))
    fields = {"a_key": "key", "a_id": "vec_id", "a_label": "label", "a_v": "v"} | {f"a_{c}": c for c in more}
    grouped = anchors.groupBy("dim", F.pmod(F.xxhash64("key"), F.lit(blocks)).alias("part")).agg(
        F.collect_list(F.struct(*[F.col(c).alias(name) for name, c in fields.items()])).alias("rows"))
    packed = materialize(grouped.select("dim", *[F.col(f"rows.{name}").alias(name) for name in fields]))
    return packed.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))


def hard_negatives(rows: DataFrame, n_positives: int = 5, n_negatives: int = 5, least: int = 80, of: int = 100,
                   anchor: str = "vec_id % 100 = 0") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: hard negatives of each anchor.

    ``rows`` has vec_id, label and embedding; other columns are not looked at.
    Rows with a null vec_id, label or vector, an empty vector or a null or
    non-finite component take no part. Where vec_id is divisible by 7 the label
    becomes (label + 1) % 10. A component x counts as floor(256 x), held to 32
    bits. Anchors are the rows that the SQL condition ``anchor`` picks; only
    vectors of an anchor's own length are compared with it.

    Positives are the first ``n_positives`` rows of the anchor's label with
    another vec_id, by falling score, ties by smaller vec_id. For each of them
    the first ``n_negatives`` rows of other labels in the same order with
    least / of * positive_score <= negative_score <= positive_score are returned,
    ranked from 1. A positive without such rows gives none, so does a negative
    positive_score. Repeated rows are rows of their own, on either side; an empty
    table gives none.
    """
    spark = rows.sparkSession
    use = materialize(_usable(rows))
    count = use.count()
    least_rows, most_rows = CANDIDATES
    # some blocks for each core are enough; more would only be more copies of the anchors
    wanted = min(partitions(spark), 4 * max(2, spark.sparkContext.defaultParallelism))
    n = max(1, math.ceil(count / min(most_rows, max(least_rows, count // wanted))))
    cands = materialize(
        use.select("dim", F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int").alias("block"), "vec_id", "label", "v")
        .repartition(max(n, partitions(spark)), "block").sortWithinPartitions("dim", "block")
        .mapInArrow(_pack, "dim int, block int, ids binary, labels binary, n_planes int, planes binary"))
    anchors = materialize(use.where(anchor).withColumn("key", F.monotonically_increasing_id()))
    n_anchors = anchors.count()

    found = _meetings(anchors, n_anchors, cands, n).mapInArrow(
        _positives(n_positives), "a_key long, vec_id long, score long")
    order = [F.desc("score"), F.asc("vec_id")]
    best = Window.partitionBy("a_key").orderBy(*order)
    positives = materialize(
        found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= n_positives)
        .groupBy("a_key").agg(F.sort_array(F.collect_list(F.struct("r", "vec_id", "score"))).alias("p")))

    asked = anchors.join(positives.withColumnRenamed("a_key", "key"), "key").withColumn("bounds", F.col("p.score"))
    near = _meetings(asked, n_anchors, cands, n, "bounds").mapInArrow(
        _negatives(n_negatives, least, of), "a_key long, place int, vec_id long, score long")
    best = Window.partitionBy("a_key", "place").orderBy(*order)
    ranked = near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n_negatives)
    named = asked.select(F.col("key").alias("a_key"), F.col("vec_id").alias("anchor_id"), F.posexplode("p").alias("place", "p"))
    return ranked.join(named, ["a_key", "place"]).select(
        "anchor_id", F.col("p.vec_id").alias("positive_id"), "rank", F.col("vec_id").alias("negative_id"),
        F.col("p.score").alias("positive_score"), F.col("score").alias("negative_score"))
