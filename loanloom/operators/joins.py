"""Lookup joins that stay safe when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A lookup table of at most this many rows and bytes of text is broadcast; text is
# only measured where there are more than MEASURED_ROWS rows.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
MEASURED_ROWS = 10_000
# A key is hot when it holds at least 1/HOT_PARTS of the weight, or more rows than a
# task should get; never more than BROADCAST_ROWS keys are hot, so broadcasting them is safe.
HOT_PARTS = 1000
HOT_ROWS = 5_000_000
SPREAD = 1 << 16


def text_bytes(table: DataFrame) -> int:
    """Bytes of all text and binary values."""
    wide = [c for c, kind in table.dtypes if kind in ("string", "binary")]
    if not wide:
        return 0
    size = sum((F.coalesce(F.octet_length(_col(c)), F.lit(0)).cast("long") for c in wide), F.lit(0).cast("long"))
    return table.agg(F.sum(size)).first()[0] or 0


def lookup(rows: DataFrame, table: DataFrame, on: Sequence[str], n_rows: int,
           weight: str, limit: int = BROADCAST_ROWS, total: int | None = None) -> DataFrame:
    """Left lookup in a table with unique keys and at most ``n_rows`` rows."""
    if n_rows <= limit and (n_rows <= MEASURED_ROWS or text_bytes(table) <= BROADCAST_BYTES):
        return rows.join(F.broadcast(table.drop(weight)), list(on), "left")
    return hot_key_lookup(rows, table, on, weight, total)


def hot_key_lookup(rows: DataFrame, table: DataFrame, on: Sequence[str], weight: str,
                   total: int | None = None) -> DataFrame:
    """Left lookup in a table of any size, ``weight`` = matching rows per key.

    Hot keys are answered by a broadcast. Their
    rows, and rows with a null key, then carry a salt that matches nothing, so
    the shuffle of the other lookup spreads them over all tasks.
    """
    on = list(on)
    payload = [c for c in table.columns if c not in on and c != weight]
    hot_, cold_, salt_ = (_unused(c, [*rows.columns, *table.columns]) for c in ("_hot", "_cold", "_salt"))
    whole = table.agg(F.sum(_col(weight))).scalar() if total is None else F.lit(total)
    share = whole.cast("double")
    is_hot = _col(weight) >= F.greatest(F.least(share / HOT_PARTS, F.lit(float(HOT_ROWS))), share / BROADCAST_ROWS)
    keys = [_col(c) for c in on]
    values = F.struct(*[_col(c).alias(f"p{i}") for i, c in enumerate(payload)])
    hot = table.where(is_hot).select(*keys, values.alias(hot_))
    cold = table.where(~is_hot).select(*keys, F.lit(0).alias(salt_), values.alias(cold_))
    no_key = F.lit(False)
    for c in keys:
        no_key = no_key | c.isNull()
    # maps have no hash; what is left tells the rows of a hot key apart well enough
    hashed = [_col(f.name) for f in rows.schema.fields if "map<" not in f.dataType.simpleString()]
    spread = F.lit(1) + F.pmod(F.xxhash64(*hashed) if hashed else F.lit(0), F.lit(SPREAD)).cast("int")
    salted = rows.join(F.broadcast(hot), on, "left").withColumn(
        salt_, F.when(F.col(hot_).isNotNull() | no_key, spread).otherwise(F.lit(0)))
    joined = salted.join(cold, [*on, salt_], "left")
    found = F.coalesce(F.col(hot_), F.col(cold_))
    return joined.select(
        *[_col(c) for c in rows.columns], *[found.getField(f"p{i}").alias(c) for i, c in enumerate(payload)])


def _col(name: str) -> Column:
    """The column of that very name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def _unused(name: str, taken: Sequence[str]) -> str:
    """``name``, lengthened until it is none of the taken ones."""
    lower = {c.lower() for c in taken}
    while name in lower:
        name += "_"
    return name
