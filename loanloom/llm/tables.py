"""Small helpers for the operators: input columns, written tables, lookups on skewed keys."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.operators.joins import BROADCAST_ROWS, hot_key_lookup
from loanloom.session import materialize

__all__ = ["attach", "crc_mod", "fresh", "drop_ids", "materialize", "partitions", "texts"]


def texts(docs: DataFrame, *columns: str) -> DataFrame:
    """``doc_id`` and ``text`` (null: empty) and the named columns, nothing else."""
    return docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *columns)


def fresh(docs: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``docs`` has it."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def crc_mod(column: str, n: int):
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(n))


def partitions(spark: SparkSession, rows: int = 0, per_task: int = 200_000) -> int:
    """Shuffle partitions of the session, more where a task would get over ``per_task`` rows."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / per_task))


def attach(rows: DataFrame, table: DataFrame, on: str, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Left lookup of ``rows.on`` in a written table with unique keys; hot keys are spread.

    The table is counted; up to ``limit`` rows (of a few fixed-width columns) it
    is broadcast, beyond that joined by shuffle with frequent keys salted.
    """
    if table.count() <= limit:
        return rows.join(F.broadcast(table), on, "left")
    weights = rows.groupBy(on).agg(F.count(F.lit(1)).alias("_w"))
    return hot_key_lookup(rows, materialize(table.join(weights, on)), [on], "_w")


def drop_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` without the rows whose doc_id is in ``ids`` (doc_id, distinct)."""
    flag = fresh(docs, "_gone")
    gone = materialize(ids.select("doc_id", F.lit(True).alias(flag)))
    return attach(docs, gone, "doc_id").where(F.col(flag).isNull()).select(*docs.columns)
