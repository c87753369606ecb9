import datetime as dt

import pytest
from pyspark.sql import functions as F

from loanloom.functions import cleaning


@pytest.mark.parametrize("text,expected", [
    ("1/2/2025", dt.date(2025, 2, 1)), ("31/12/1999", dt.date(1999, 12, 31)),
    ("2025-02-01", dt.date(2025, 2, 1)), ("01-Feb-2025", dt.date(2025, 2, 1)),
    ("1/2/25", dt.date(2025, 2, 1)), ("7/3/71", dt.date(1971, 3, 7)),
    ("5-6-2024", dt.date(2024, 6, 5)), ("bad", None), (None, None), ("31/02/2024", None),
    ("2024-02-29 10:11:12", dt.date(2024, 2, 29)),
])
def test_date_forms(spark, text, expected):
    df = spark.createDataFrame([(text,)], "d string")
    assert df.select(cleaning.parse_date("d")).first()[0] == expected


def test_unparsed_counts(spark):
    df = spark.createDataFrame([("1/2/2025",), ("bad",), (None,)], "d string")
    row = cleaning.unparsed_dates(df, ["d"]).first()
    assert (row["n_values"], row["n_failed"]) == (2, 1)


def test_numbers_and_tokens(spark):
    df = spark.createDataFrame([("1.5",), ("",), ("abc",), ("NaN",), (" 7 ",), (None,)], "x string")
    assert [r[0] for r in df.select(cleaning.parse_number("x")).collect()] == [1.5, None, None, None, 7.0, None]
    df = spark.createDataFrame([("None",), ("NA",), ("Vehicle",)], "x string")
    assert [r[0] for r in df.select(cleaning.null_tokens("x")).collect()] == ["None", None, "Vehicle"]
    strict = df.select(cleaning.null_tokens("x", ["None", "NA"]))
    assert [r[0] for r in strict.collect()] == [None, None, "Vehicle"]


def test_apply_dtypes_skips_absent_columns(spark):
    df = spark.createDataFrame([("1/2/2025", 3, "x")], "date_approved string, product_code int, other string")
    out = cleaning.apply_dtypes(df, ["date_approved", "client_dob"], ["product_code"], ["amount_usd"])
    assert dict(out.dtypes) == {"date_approved": "date", "product_code": "string", "other": "string"}
    assert out.select(F.col("product_code")).first()[0] == "3"


def test_free_form_dates_and_tokens(spark):
    texts = ["1 Feb 2025", "1 February 2025", "Feb 1, 2025", "2025-02-01T10:20:30", "1/2/2025 10:20"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r[0] for r in df.select(cleaning.parse_date("t")).collect()} == {dt.date(2025, 2, 1)}
    odd = spark.createDataFrame([(t,) for t in ("#NA", "1.#QNAN", "-nan", "None")], "t string")
    assert [r[0] for r in odd.select(cleaning.null_tokens("t")).collect()] == [None, None, None, "None"]
