"""Exact dedup: counting quotient filters per partition, merged by sorted remainders.

A 64-bit fingerprint is split into a block (its high bits), and a remainder. A
partition keeps, per block, the sorted remainders it has met and a count for
each, as two packed arrays. Filters of the same block merge losslessly: sorted
runs are joined and the counts of equal remainders added. Fingerprints with a
count above one are the only ones whose texts are compared byte by byte; all
other rows are unique without a look at any other text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm.tables import attach, fresh, materialize, partitions, texts

#: Fingerprints that a task gathers before it hands its filters on.
FILTER_ROWS = 500_000
#: Fingerprints a block is sized for.
BLOCK_ROWS = 100_000


def _merge(remainders: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct remainders with the sums of their counts."""
    order = np.argsort(remainders, kind="stable")
    r, c = remainders[order], counts[order]
    first = np.flatnonzero(np.r_[True, r[1:] != r[:-1]]) if len(r) else np.zeros(0, int)
    return r[first], np.add.reduceat(c, first) if len(r) else c


def _filters(bits: int):
    """Batches of (fp long) -> (block, remainders, counts), one row per block and run of a task."""
    low = 64 - bits

    def packed(fps: np.ndarray) -> pa.RecordBatch:
        fps, counts = _merge(fps, np.ones(len(fps), np.int64))
        block = (fps >> np.uint64(low)).astype(np.int64) if bits else np.zeros(len(fps), np.int64)
        starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]]) if len(fps) else np.zeros(0, int)
        ends = np.r_[starts[1:], len(fps)].astype(int)
        return pa.RecordBatch.from_arrays([
            pa.array(block[starts], pa.int32()),
            pa.array([fps[a:b].tobytes() for a, b in zip(starts, ends, strict=False)], pa.binary()),
            pa.array([counts[a:b].tobytes() for a, b in zip(starts, ends, strict=False)], pa.binary()),
        ], ["block", "remainders", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
            if sum(map(len, held)) >= FILTER_ROWS:
                yield packed(np.concatenate(held))
                held = []
        if held:
            yield packed(np.concatenate(held))

    return run


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Filters sorted by block -> fingerprints whose merged count is above one."""
    def out(r: np.ndarray, c: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(r[c > 1].view(np.int64)), pa.array(c[c > 1])], ["fp", "n"])

    block, r, c = None, np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for batch in batches:
        for b, more_r, more_c in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if b != block:
                yield out(r, c)
                block, r, c = b, np.zeros(0, np.uint64), np.zeros(0, np.int64)
            r, c = _merge(np.r_[r, np.frombuffer(more_r, np.uint64)], np.r_[c, np.frombuffer(more_c, np.int64)])
    yield out(r, c)


def repeated_fingerprints(rows: DataFrame, total: int) -> DataFrame:
    """(fp long, n long) of the fingerprints of ``rows`` (fp long) that occur more than once."""
    bits = max(8, int(np.ceil(np.log2(max(1, total) / BLOCK_ROWS))))
    n = partitions(rows.sparkSession, total)
    return (rows.select("fp").mapInArrow(_filters(bits), "block int, remainders binary, counts binary")
            .repartition(n, "block").sortWithinPartitions("block").mapInArrow(_repeated, "fp long, n long"))


def _groups(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, sha) of every row, and (sha, keep_id, group_size) of texts met more than once."""
    marked = texts(docs).withColumns({"fp": F.xxhash64("text"), "sha": F.unhex(F.sha2("text", 256))})
    ids = materialize(marked.select("doc_id", "fp", "sha"))
    twice = materialize(repeated_fingerprints(ids, ids.count()))
    # the bytes of suspects only; equal ones meet before the shuffle, so a group of copies sends a text per task
    suspects = attach(marked, twice, "fp").where(F.col("n").isNotNull())
    groups = suspects.groupBy("fp", "text").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"), F.first("sha").alias("sha"))
    return ids, materialize(groups.where("group_size > 1").select("sha", "keep_id", "group_size"))


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are; null counts as empty. Of equal texts
    the row with the largest doc_id stays (a null id is below all others). Rows
    that share doc_id and text are members of the group each and stay or go
    together.
    """
    ids, groups = _groups(docs)
    found = attach(ids, groups, "sha")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return found.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        keep.eqNullSafe(F.col("doc_id")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``exact_dedup`` keeps, with their own columns."""
    _, groups = _groups(docs)
    key, keep = fresh(docs, "_sha"), fresh(docs, "_keep")
    named = materialize(groups.select(F.col("sha").alias(key), F.struct("keep_id").alias(keep)))
    sha = F.unhex(F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256))
    found = attach(docs.withColumn(key, sha), named, key)
    return found.where(F.col(keep).isNull() | F.col(keep)["keep_id"].eqNullSafe(F.col("doc_id"))).select(*docs.columns)
