import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[4]").appName("tests")
         .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "6g").getOrCreate())
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()


# Category values of the data dictionary, in its order.
FREQUENCIES = ["Monthly", "Bi-Weekly", "Weekly"]
PURPOSES = ["Working_Capital", "Stock_Purchase", "Equipment", "School_Fees", "Medical", "Home_Improvement", "Vehicle",
            "Farming_Inputs"]
GENDERS = ["Male", "Female"]
MARITAL = ["Married", "Single", "Divorced", "Widowed"]
SECTORS = ["Agriculture", "Mining", "Manufacturing", "Retail_Trade", "Government", "Education", "Healthcare"]
COLLATERAL = ["None", "Vehicle", "Property", "Livestock", "Savings", "Guarantor"]
CHANNELS = ["EcoCash", "Bank_Transfer", "Cash", "InnBucks", "OneMoney"]
PROVINCES = ["Harare", "Bulawayo", "Manicaland", "Mashonaland_West", "Mashonaland_East", "Mashonaland_Central"]
# End of fixed values.

N_TRAIN, N_TEST = 200, 50
#: Values that the edge cases ask for: band limits, zero rates, incomes below one, ties.
RATES = [0.0, 0.1, 15.0, 15.1, 40.0, 72.5, 100.0, 150.0, 210.0, None]
INCOMES = [0.0, 0.5, 120.0, 350.0, 350.0, 900.0, 2600.0, None]


def loan_row(i: int, test: bool = False) -> dict:
    """Loan number ``i``: each field walks through its values at its own stride, so that combinations vary."""
    import datetime as dt

    def pick(values, stride):
        return values[(i * stride + i // len(values)) % len(values)]

    start = dt.date(2024, 12, 20) + dt.timedelta(days=(i * 11) % 400)
    paid_out = start + dt.timedelta(days=i % 10)
    term = [1, 2, 6, 9, 12, 15, 24, 36, 48][i % 9]
    row = dict(
        ID=f"{'TT' if test else 'TR'}{i:05d}",
        product_code=(i * 5 + i // 6) % 6,
        date_approved=start,
        date_disbursed=paid_out,
        first_payment_due=paid_out + dt.timedelta(days=25 + i % 11),
        maturity_date=paid_out + dt.timedelta(days=30 * term),
        amount_usd=75.0 + (i * 7919) % 60000,
        annual_rate_pct=pick(RATES, 3),
        term_months=term,
        payment_frequency=pick(FREQUENCIES, 2),
        loan_purpose=None if i % 41 == 40 else pick(PURPOSES, 3),
        client_gender=pick(GENDERS, 1),
        client_dob=dt.date(1961, 3, 1) + dt.timedelta(days=(i * 67) % 15000),
        marital_status=None if i % 53 == 52 else pick(MARITAL, 3),
        num_dependents=None if i % 17 == 16 else float((i * 4 + i // 9) % 9),
        employment_sector=None if i % 37 == 36 else pick(SECTORS, 3),
        months_at_employer=None if i % 23 == 22 else float(1 + (i * 29) % 240),
        monthly_income_usd=pick(INCOMES, 3),
        existing_obligations=(i * 2 + i // 9) % 9,
        collateral_type=None if i % 29 == 28 else pick(COLLATERAL, 5),
        disbursement_channel=pick(CHANNELS, 3),
        province=pick(PROVINCES, 5),
    )
    if not test:
        risky = (row["province"] in PROVINCES[:2]) + (row["existing_obligations"] > 5)
        row["Target"] = int((i * 37 + i // 7) % 100 < 12 + 18 * risky)
    return row


@pytest.fixture(scope="session")
def loan_pdfs():
    import pandas as pd

    train = pd.DataFrame([loan_row(i) for i in range(N_TRAIN)])
    test = pd.DataFrame([loan_row(i, True) for i in range(N_TEST)])
    return train, test


def to_spark(spark, rows):
    from pyspark.sql import types as T

    kinds = {"product_code": T.IntegerType(), "term_months": T.IntegerType(),
             "existing_obligations": T.IntegerType(), "Target": T.IntegerType()}
    doubles = {"amount_usd", "annual_rate_pct", "num_dependents", "months_at_employer", "monthly_income_usd"}
    dates = {"date_approved", "date_disbursed", "first_payment_due", "maturity_date", "client_dob"}
    fields = [T.StructField(c, kinds.get(c) or (T.DoubleType() if c in doubles else
                            T.DateType() if c in dates else T.StringType())) for c in rows[0]]
    return spark.createDataFrame([tuple(r.values()) for r in rows], T.StructType(fields))


@pytest.fixture(scope="session")
def train(spark):
    return to_spark(spark, [loan_row(i) for i in range(N_TRAIN)]).persist()


@pytest.fixture(scope="session")
def test_set(spark):
    return to_spark(spark, [loan_row(i, True) for i in range(N_TEST)]).persist()


@pytest.fixture(scope="session")
def folds(train):
    from loanloom.operators.folds import make_folds

    return make_folds(train).persist()
