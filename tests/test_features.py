import pytest
from pyspark.sql import functions as F

from loanloom.functions import loan
from loanloom.operators import features as fx


def test_fit_is_needed(train):
    with pytest.raises(RuntimeError):
        fx.BaseFeatureEngineer().transform(train)


def test_transform_matches_pandas(train, loan_pdfs):
    import numpy as np
    import pandas as pd

    got = fx.BaseFeatureEngineer().fit_transform(train).toPandas().sort_values("ID").reset_index(drop=True)
    pdf = loan_pdfs[0]
    med = pdf["monthly_income_usd"].median()
    income = pdf["monthly_income_usd"].fillna(med)
    pd.testing.assert_series_equal(got["debt_to_income"], pdf["amount_usd"] / income.clip(lower=1), check_names=False)
    rate = pdf["annual_rate_pct"].fillna(pdf["annual_rate_pct"].median())
    r = rate / 1200
    pay = pdf["amount_usd"] * r / (1 - (1 + r) ** (-pdf["term_months"]))
    pd.testing.assert_series_equal(got["monthly_payment_est"], pay, check_names=False)
    want = pd.cut(rate, [0, 15, 40, 100, 210], labels=False).astype(float)
    pd.testing.assert_series_equal(got["rate_bucket"], want, check_names=False)
    ranks = pd.Series(income).groupby(pdf["province"]).rank(pct=True)
    pd.testing.assert_series_equal(got["income_rank_in_province"], ranks, check_names=False)
    assert got["collateral_type_was_missing"].sum() == pdf["collateral_type"].isna().sum() > 0
    age = (pd.to_datetime(pdf["date_approved"]) - pd.to_datetime(pdf["client_dob"])).dt.days / 365.25
    pd.testing.assert_series_equal(got["client_age_at_approval"], age, check_names=False)
    assert not np.isnan(got["employer_stability"]).any()
    assert not {"date_approved", "client_dob"} & set(got.columns)


def test_test_rows_use_train_values(train, test_set):
    eng = fx.BaseFeatureEngineer().fit(train)
    out = eng.transform(test_set)
    assert out.where("monthly_income_usd is null or employment_sector is null").count() == 0
    assert "Target" not in out.columns and out.count() == 50


def test_same_features_twice_and_under_any_partitioning(train):
    a = fx.BaseFeatureEngineer().fit_transform(train).orderBy("ID").toPandas()
    b = fx.BaseFeatureEngineer().fit_transform(train.repartition(13)).orderBy("ID").toPandas()
    assert a.equals(b)


def test_modes(spark):
    df = spark.createDataFrame([("b", None), ("a", None), (None, None)], "x string, y string")
    assert fx.modes(df, ["x", "y"]) == {"x": "a", "y": "Unknown"}


@pytest.mark.parametrize("rate,bucket", [(0.0, None), (0.1, 0.0), (15.0, 0.0), (15.1, 1.0), (40.0, 1.0),
                                         (100.0, 2.0), (210.0, 3.0), (211.0, None), (None, None)])
def test_rate_buckets(spark, rate, bucket):
    df = spark.createDataFrame([(rate,)], "annual_rate_pct double")
    row = loan.add_features(df, loan.RATIO_FEATURES).first()
    assert row["rate_bucket"] == bucket
    assert row["is_mfi_loan"] == (1.0 if rate is not None and rate > 40 else 0.0)


def test_edge_values(spark):
    df = spark.createDataFrame(
        [(1000.0, 0.0, 12, 0.5, 0, 0.0)],
        "amount_usd double, annual_rate_pct double, term_months int, monthly_income_usd double,"
        " existing_obligations int, num_dependents double")
    row = loan.add_features(df, loan.RATIO_FEATURES).first()
    assert row["monthly_payment_est"] is None and row["debt_to_income"] == 1000.0


def test_absent_inputs_are_skipped(spark):
    out = loan.add_features(spark.createDataFrame([(5.0,)], "amount_usd double"), loan.RATIO_FEATURES)
    assert set(out.columns) == {"amount_usd", "log_amount_usd"}


def test_extra_features_and_native_frame(train, test_set):
    eng = fx.BaseFeatureEngineer(ranks=False).fit(train)
    tr, te = fx.add_extra_features(eng.transform(train), eng.transform(test_set), ["province"])
    assert {"province_freq", "is_urban", "months_to_repay", "mfi_no_collateral"} <= set(te.columns)
    assert tr.where("is_urban = 1").count() == tr.where("province in ('Harare', 'Bulawayo')").count()
    native = fx.native_categories(train, ["loan_purpose"])
    assert native.where(F.col("loan_purpose") == "__NA__").count() == train.where("loan_purpose is null").count() > 0
    assert native.where("annual_rate_pct is null").count() == 0


def test_feature_lists(train):
    assert "ID" not in fx.feature_columns(train) and "Target" not in fx.feature_columns(train)
    assert "province" not in fx.numeric_columns(train) and "amount_usd" in fx.numeric_columns(train)


def test_approximate_medians_are_close(train):
    exact = fx.BaseFeatureEngineer().fit(train).numeric_medians
    rough = fx.BaseFeatureEngineer(approximate=True).fit(train).numeric_medians
    assert rough["amount_usd"] == pytest.approx(exact["amount_usd"], rel=0.05)
