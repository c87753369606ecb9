"""Expressions that turn raw text into dates, numbers and nulls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.schema import DATE_FORMATS, NA_TOKENS


def parse_date(col: str | Column, formats: list[str] | None = None) -> Column:
    """First format that fits wins (day before month); otherwise null."""
    c = F.trim(F.col(col) if isinstance(col, str) else col)
    return F.coalesce(*[_one_format(c, f) for f in formats or DATE_FORMATS])


def _one_format(c: Column, fmt: str) -> Column:
    day = F.try_to_timestamp(c, F.lit(fmt)).cast("date")
    if "yyyy" in fmt:
        return day
    # two-digit years mean 1969 to 2068, not 2000 to 2099
    return F.when(F.year(day) >= 2069, F.add_months(day, -1200)).otherwise(day)


def parse_number(col: str | Column) -> Column:
    """Number from text; unreadable or NaN text is null."""
    c = F.col(col) if isinstance(col, str) else col
    number = F.trim(c.cast("string")).try_cast("double")
    return F.when(~F.isnan(number), number)


def null_tokens(col: str | Column, tokens: list[str] | None = None) -> Column:
    """Null for text that stands for a missing value."""
    c = F.col(col) if isinstance(col, str) else col
    listed = NA_TOKENS if tokens is None else tokens
    return F.when(~F.trim(c).isin(listed), c)


def unparsed_dates(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per column, how many values are present but are no dates."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        [], cols, "column_name", "raw"
    )
    bad = F.col("raw").isNotNull() & parse_date("raw").isNull()
    return long.groupBy("column_name").agg(
        F.count("raw").alias("n_values"), F.count_if(bad).alias("n_failed")
    )


def apply_dtypes(
    df: DataFrame, dates: list[str], categories: list[str], numbers: list[str]
) -> DataFrame:
    """Dates parsed, numbers coerced, categories as text; one projection.

    Columns that are absent are skipped, typed ones stay as they are.
    """
    kinds = dict(df.dtypes)
    out = []
    for c in df.columns:
        if c in dates and kinds[c] == "string":
            out.append(parse_date(c).alias(c))
        elif c in dates:
            out.append(F.col(c).cast("date").alias(c))
        elif c in numbers and kinds[c] == "string":
            out.append(parse_number(c).alias(c))
        elif c in categories:
            out.append(F.col(c).cast("string").alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)
