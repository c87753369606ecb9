"""Text keys: category text and md5-based ordering values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loanloom.schema import NULL_TEXT


def category_text(col: str | Column) -> Column:
    """A category as text; a missing one is the category ``nan``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit(NULL_TEXT))


def seeded_md5(id_col: str, seed: int | str) -> Column:
    """A repeatable shuffle key: the same for any partitioning or engine."""
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))


def unit_from_md5(text: Column) -> Column:
    """A number in [0, 1) from the first 28 bits of the md5 of ``text``."""
    bits = F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("double")
    return bits / F.lit(float(16**7))
