"""A loan-shaped view of the order tables, and score columns over it.

Only the joins that the asked columns need are planned. All lookups are left
joins on unique keys, so the row set is the same for any column list.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loanloom.schema import CATEGORICAL_COLS, DATE_COLS, ID_COL, NUMERIC_COLS, TARGET_COL
from loanloom.session import materialize

APPROVED = "cast(o_orderdate as date)"
DISBURSED = f"({APPROVED} + cast(1 + k % 14 as int))"

# column -> (expression, tables it needs beside orders)
EXPRESSIONS: dict[str, tuple[str, tuple[str, ...]]] = {
    "ID": ("cast(k as string)", ()),
    "product_code": ("cast(substr(o_orderpriority, 1, 1) as int)", ()),
    "date_approved": (APPROVED, ()),
    "date_disbursed": (DISBURSED, ()),
    "first_payment_due": (f"({DISBURSED} + cast(20 + k % 20 as int))", ()),
    "maturity_date": (f"({DISBURSED} + cast(180 + k % 550 as int))", ()),
    "amount_usd": ("o_totalprice", ()),
    "annual_rate_pct": ("rate", ("lineitem",)),
    "term_months": ("cast(1 + k % 48 as int)", ()),
    "payment_frequency": ("flag", ("lineitem",)),
    "loan_purpose": ("p_brand", ("lineitem", "part")),
    "client_gender": ("case when ck % 2 = 0 then 'Male' else 'Female' end", ()),
    "client_dob": ("(date '1950-01-01' + cast(ck * 37 % 15000 as int))", ()),
    "marital_status": (
        "case when ck % 67 = 0 then null when ck % 4 = 0 then 'Married' when ck % 4 = 1 then 'Single'"
        " when ck % 4 = 2 then 'Divorced' else 'Widowed' end", ()),
    "num_dependents": ("case when k % 17 = 0 then null else cast(ck % 9 as double) end", ()),
    "employment_sector": ("case when k % 33 = 0 then null else c_mktsegment end", ("customer",)),
    "months_at_employer": (
        "case when k % 20 = 0 then null else cast(1 + ck * 13 % 240 as double) end", ()),
    "monthly_income_usd": (
        "case when k % 13 = 0 then null else greatest(c_acctbal, cast(31 as double)) end",
        ("customer",)),
    "existing_obligations": ("cast(coalesce(n_lines, 0) as int)", ("lineitem",)),
    "collateral_type": (
        "case when k % 25 = 0 then null when k % 6 = 0 then 'None' when k % 6 = 1 then 'Vehicle'"
        " when k % 6 = 2 then 'Property' when k % 6 = 3 then 'Livestock'"
        " when k % 6 = 4 then 'Savings' else 'Guarantor' end", ()),
    "disbursement_channel": ("r_name", ("customer", "nation", "region")),
    "province": ("n_name", ("customer", "nation")),
    "Target": (
        "case when (k * 7919) % 100 < 10 + coalesce(rate - 8, cast(0 as double)) / 5"
        " then 1 else 0 end", ("lineitem",)),
    "is_test": ("case when k % 4 = 0 then 1 else 0 end", ()),
}

LOAN_COLS = [ID_COL, *CATEGORICAL_COLS, *DATE_COLS, *NUMERIC_COLS, TARGET_COL, "is_test"]

# pseudo-model scores: a signal, noise, a mixture with many ties, another mixture
SCORES = {
    "s1": "coalesce(annual_rate_pct, cast(8 as double)) / 200",
    "s2": "cast(cast(ID as bigint) * 31 % 1000 as double) / 1000",
    "s3": "cast(floor(cast(60 as double) * (coalesce(annual_rate_pct, cast(8 as double)) / 200)"
          " + cast(40 as double) * (cast(cast(ID as bigint) * 31 % 1000 as double) / 1000))"
          " as double) / 100",
    "s4": "cast(0.4 as double) * (coalesce(annual_rate_pct, cast(8 as double)) / 200)"
          " + cast(0.6 as double) * (cast(cast(ID as bigint) * 53 % 97 as double) / 97)",
}


_SCHEMAS: dict[tuple[str, int], StructType] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A source table; its schema is read from the file once, and again when the file has changed."""
    path = f"{sf_dir}/{name}.parquet"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    status = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(hadoop)
    key = (path, status.getModificationTime())
    if key not in _SCHEMAS:
        _SCHEMAS[key] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[key]).parquet(path)


def loan_view(spark: SparkSession, sf_dir: str, cols: Sequence[str] | None = None) -> DataFrame:
    """The asked loan columns, one row per order."""
    cols = list(cols or LOAN_COLS)
    need = {t for c in cols for t in EXPRESSIONS[c][1]}
    base = _table(spark, sf_dir, "orders").withColumns(
        {"k": F.col("o_orderkey"), "ck": F.col("o_custkey")})
    if "lineitem" in need:
        lines = _table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
            F.round(F.lit(8.0) + F.lit(1920.0) * F.avg("l_discount"), 4).alias("rate"),
            F.count(F.lit(1)).alias("n_lines"), F.max("l_returnflag").alias("flag"),
            F.min("l_partkey").alias("pk"))
        base = base.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    if "part" in need:
        base = base.join(_table(spark, sf_dir, "part"), F.col("pk") == F.col("p_partkey"), "left")
    if "customer" in need:
        base = base.join(
            _table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
    if "nation" in need:
        base = base.join(
            _table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    if "region" in need:
        base = base.join(
            _table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return base.select(*[F.expr(EXPRESSIONS[c][0]).alias(c) for c in cols])


def train_rows(spark: SparkSession, sf_dir: str, cols: Sequence[str] | None = None) -> DataFrame:
    return _split(spark, sf_dir, cols, 0)


def test_rows(spark: SparkSession, sf_dir: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Unlabelled part; the split is the data set's own, not a sample."""
    return _split(spark, sf_dir, cols, 1)


def _split(spark: SparkSession, sf_dir: str, cols: Sequence[str] | None, flag: int) -> DataFrame:
    cols = [c for c in (cols or LOAN_COLS) if c != "is_test"]
    return loan_view(spark, sf_dir, [*cols, "is_test"]).where(F.col("is_test") == flag).drop("is_test")


def scored_rows(spark: SparkSession, sf_dir: str, models: Sequence[str] = ("s1", "s2", "s3", "s4"),
                cols: Sequence[str] = ()) -> DataFrame:
    """Training rows with one column per pseudo-model."""
    base = train_rows(spark, sf_dir, [ID_COL, TARGET_COL, "annual_rate_pct",
                                      *[c for c in cols if c != "annual_rate_pct"]])
    return base.select(
        ID_COL, TARGET_COL, *cols, *[F.expr(SCORES[m]).alias(m) for m in models])


def long_scores(spark: SparkSession, sf_dir: str,
                models: Sequence[str] = ("s1", "s2", "s3", "s4")) -> DataFrame:
    """(ID, Target, model, score), from scores that are written once."""
    return materialize(scored_rows(spark, sf_dir, models)).unpivot(
        [ID_COL, TARGET_COL], list(models), "model", "score")
