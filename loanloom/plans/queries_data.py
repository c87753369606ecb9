"""Queries for loading, audits and feature expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from loanloom.functions import cleaning, loan
from loanloom.operators import profile
from loanloom.operators.features import (BaseFeatureEngineer, add_extra_features,
                                         native_categories)
from loanloom.operators.metrics import roc_auc
from loanloom.operators.ordered import medians, percent_rank_in_group
from loanloom.operators.features import fine_fitted_ranks, modes
from loanloom.plans.catalog import query
from loanloom.plans.loanview import loan_view, scored_rows, test_rows, train_rows
from loanloom.schema import CATEGORICAL_COLS, DATE_COLS, ID_COL, MISSING_FLAG_COLS, NUMERIC_COLS
from loanloom.session import materialize

def _k():
    return F.col("ID").cast("bigint")


# --- loading ---------------------------------------------------------------

@query("a04_apply_dtypes", """
SELECT ID, date_approved, client_dob, cast(product_code as varchar) AS product_code,
  case when cast(ID as bigint) % 11 = 0 then null else amount_usd end AS amount_usd, province
FROM loans""")
def apply_dtypes(spark, sf):
    v = loan_view(spark, sf, ["ID", "date_approved", "client_dob", "product_code", "amount_usd", "province"])
    raw = v.select(
        "ID", F.date_format("date_approved", "d/M/yyyy").alias("date_approved"),
        F.date_format("client_dob", "dd-MMM-yyyy").alias("client_dob"), "product_code",
        F.when(_k() % 11 == 0, F.lit("unknown")).otherwise(F.col("amount_usd").cast("string")).alias("amount_usd"),
        "province")
    return cleaning.apply_dtypes(raw, DATE_COLS, CATEGORICAL_COLS, NUMERIC_COLS)


def _date_texts(spark, sf):
    day = F.col("date_approved")
    styles = ["d/M/yyyy", "dd/MM/yyyy", "yyyy-MM-dd", "yyyy/MM/dd", "dd-MMM-yyyy", "d-M-yyyy",
              "dd.MM.yyyy", "d/M/yy"]
    text = F.when(_k() % 10 == 8, F.lit("not a date"))
    for i, s in enumerate(styles):
        text = text.when(_k() % 10 == i, F.date_format(day, s))
    return loan_view(spark, sf, ["ID", "date_approved"]).select("ID", text.alias("raw"))


_RAW_DATES = """
raw_dates AS (
  SELECT ID, case cast(ID as bigint) % 10
    when 0 then strftime(date_approved, '%-d/%-m/%Y') when 1 then strftime(date_approved, '%d/%m/%Y')
    when 2 then strftime(date_approved, '%Y-%m-%d') when 3 then strftime(date_approved, '%Y/%m/%d')
    when 4 then strftime(date_approved, '%d-%b-%Y') when 5 then strftime(date_approved, '%-d-%-m-%Y')
    when 6 then strftime(date_approved, '%d.%m.%Y') when 7 then strftime(date_approved, '%-d/%-m/%y')
    when 8 then 'not a date' end AS raw FROM loans),
parsed_dates AS (
  SELECT ID, raw, cast(case when regexp_matches(raw, '^[0-9]{1,2}/[0-9]{1,2}/[0-9]{2}$')
    then try_strptime(raw, '%d/%m/%y')
    else try_strptime(raw, ['%d/%m/%Y', '%Y-%m-%d', '%Y/%m/%d', '%d-%b-%Y', '%d-%m-%Y', '%d.%m.%Y'])
    end as date) AS parsed FROM raw_dates)
"""


@query("a05_date_parse", _RAW_DATES + "SELECT ID, parsed FROM parsed_dates")
def date_parse(spark, sf):
    return _date_texts(spark, sf).select("ID", cleaning.parse_date("raw").alias("parsed"))


@query("a05_unparsed_dates", _RAW_DATES + """
SELECT 'raw' AS column_name, count(raw) AS n_values,
  count(*) FILTER (raw IS NOT NULL AND parsed IS NULL) AS n_failed FROM parsed_dates""")
def unparsed_dates(spark, sf):
    return cleaning.unparsed_dates(_date_texts(spark, sf), ["raw"])


@query("a06_numeric_coercion", """
SELECT ID, try_cast(case cast(ID as bigint) % 7 when 0 then 'n.a.' when 1 then ''
  else cast(amount_usd as varchar) end as double) AS amount_usd FROM loans""")
def numeric_coercion(spark, sf):
    text = (F.when(_k() % 7 == 0, "n.a.").when(_k() % 7 == 1, "")
            .otherwise(F.col("amount_usd").cast("string")))
    return loan_view(spark, sf, ["ID", "amount_usd"]).select(
        "ID", cleaning.parse_number(text).alias("amount_usd"))


@query("a07_na_tokens", """
SELECT ID, case when collateral_type IN ('None') then null else collateral_type end AS none_is_null,
  collateral_type AS none_is_value FROM loans""")
def na_tokens(spark, sf):
    v = loan_view(spark, sf, ["ID", "collateral_type"])
    text = F.coalesce(F.col("collateral_type"), F.lit("NA"))
    return v.select("ID", cleaning.null_tokens(text, ["", "NA", "None"]).alias("none_is_null"),
                    cleaning.null_tokens(text).alias("none_is_value"))


# --- audits ----------------------------------------------------------------

_AUDITED = [*CATEGORICAL_COLS, *NUMERIC_COLS]


@query("b01_missing_rates", "rates AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, avg(case when {c} is null then 1.0::double else 0.0::double end)"
    f" AS missing_rate FROM train" for c in _AUDITED)
    + ") SELECT column_name, round(missing_rate, 9) AS missing_rate FROM rates WHERE missing_rate > 0")
def missing_rates(spark, sf):
    return profile.missing_rates(train_rows(spark, sf, _AUDITED)).select(
        "column_name", F.round("missing_rate", 9).alias("missing_rate"))


_BLANKED = {c: f"case when cast(ID as bigint) % 19 = 0 then '' else {c} end"
            for c in ("loan_purpose", "employment_sector")}


@query("b02_missing_counts", "blank AS (SELECT ID, num_dependents, "
       + ", ".join(f"{e} AS {c}" for c, e in _BLANKED.items()) + " FROM train), tall AS ("
       + " UNION ALL ".join(
           f"SELECT '{c}' AS column_name, count(*) FILTER ({c} is null or trim(cast({c} as varchar)) = '')"
           f" AS n_missing, count(*) AS n FROM blank"
           for c in ("loan_purpose", "employment_sector", "num_dependents"))
       + ") SELECT column_name, n_missing, round(100.0::double * n_missing / n, 6) AS pct_missing"
         " FROM tall WHERE n_missing > 0")
def missing_counts(spark, sf):
    v = train_rows(spark, sf, ["ID", "num_dependents", "loan_purpose", "employment_sector"])
    v = v.withColumns({c: F.expr(e) for c, e in _BLANKED.items()})
    return profile.missing_counts(v, ["loan_purpose", "employment_sector", "num_dependents"]).withColumn(
        "pct_missing", F.round("pct_missing", 6))


@query("b04_class_balance", """
SELECT Target, count(*) AS n, round(count(*) * 1.0::double / (SELECT count(*) FROM train), 9) AS share
FROM train GROUP BY Target""")
def class_balance(spark, sf):
    return profile.class_balance(train_rows(spark, sf, ["Target"])).withColumn("share", F.round("share", 9))


@query("b05_value_counts", "SELECT product_code, count(*) AS n FROM train GROUP BY product_code")
def value_counts(spark, sf):
    return profile.value_counts(train_rows(spark, sf, ["product_code"]), "product_code")


@query("b06_numeric_summary", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, round(avg({c}), 6) AS mean, round(cast(median({c}) as double), 6) AS median,"
    f" cast(min({c}) as double) AS \"min\", cast(max({c}) as double) AS \"max\","
    f" count(*) FILTER ({c} is null) AS missing FROM train" for c in NUMERIC_COLS))
def numeric_summary(spark, sf):
    t = materialize(train_rows(spark, sf, NUMERIC_COLS))
    return profile.numeric_summary(t, NUMERIC_COLS).withColumns(
        {"mean": F.round("mean", 6), "median": F.round("median", 6)})


def _hist_sql(col, bins, by, value):
    group = f"{by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    return f"""
vals AS (SELECT {group}{value} AS x FROM train WHERE {col} IS NOT NULL),
span AS (SELECT *, min(x) OVER ({part}) AS lo, (max(x) OVER ({part}) - min(x) OVER ({part})) / {bins} AS w,
  count(*) OVER ({part}) AS total FROM vals),
placed AS (SELECT *, cast(least(floor((x - lo) / w), {bins - 1}) as int) AS bin FROM span)
SELECT '{col}' AS column_name, {group}bin, round(lo + bin * w, 6) AS bin_start, round(w, 6) AS bin_width,
  count(*) AS n, round(count(*) / (total * w), 9) AS density
FROM placed GROUP BY {group}bin, lo, w, total"""


def _hist(df):
    return df.withColumns({"bin_start": F.round("bin_start", 6), "bin_width": F.round("bin_width", 6),
                           "density": F.round("density", 9)})


@query("b07_histogram", _hist_sql("amount_usd", 40, "", "amount_usd"))
def histogram(spark, sf):
    return _hist(profile.histogram(train_rows(spark, sf, ["amount_usd"]), ["amount_usd"], 40))


@query("b07_histogram_by_class", _hist_sql("annual_rate_pct", 50, "Target", "annual_rate_pct"))
def histogram_by_class(spark, sf):
    return _hist(profile.histogram(
        train_rows(spark, sf, ["annual_rate_pct", "Target"]), ["annual_rate_pct"], 50, by="Target"))


@query("b07_log_histogram", """
vals AS (SELECT Target, ln(1 + amount_usd) AS x FROM train WHERE amount_usd IS NOT NULL),
span AS (SELECT *, min(x) OVER (PARTITION BY Target) AS lo,
  (max(x) OVER (PARTITION BY Target) - min(x) OVER (PARTITION BY Target)) / 50 AS w FROM vals)
SELECT 'amount_usd' AS column_name, Target, cast(least(floor((x - lo) / w), 49) as int) AS bin, count(*) AS n
FROM span GROUP BY Target, bin""")
def log_histogram(spark, sf):
    return profile.histogram(train_rows(spark, sf, ["amount_usd", "Target"]), ["amount_usd"], 50,
                             by="Target", log1p=True).select("column_name", "Target", "bin", "n")


@query("b08_correlation", "t AS (SELECT * FROM imp WHERE is_test = 0) " + " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 8) AS r FROM t"
    for i, a in enumerate(NUMERIC_COLS) for b in NUMERIC_COLS[i + 1:]))
def correlation(spark, sf):
    t = materialize(train_rows(spark, sf, NUMERIC_COLS))
    filled = BaseFeatureEngineer(categorical_cols=["none"]).fit(t).impute(t)
    return profile.correlation(filled, NUMERIC_COLS).withColumn("r", F.round("r", 8))


@query("b09_default_rates", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, cast({c} as varchar) AS category, count(*) AS n,"
    f" round(avg(Target), 9) AS default_rate FROM train WHERE {c} IS NOT NULL GROUP BY 2"
    for c in CATEGORICAL_COLS))
def default_rates(spark, sf):
    t = train_rows(spark, sf, [*CATEGORICAL_COLS, "Target"])
    return profile.default_rates(t, CATEGORICAL_COLS).withColumn("default_rate", F.round("default_rate", 9))


@query("b10_univariate_auc", "tall AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, Target, {c} AS x FROM imp WHERE is_test = 0" for c in NUMERIC_COLS) + """),
ranked AS (SELECT *, rank() OVER (PARTITION BY column_name ORDER BY x)
  + (count(*) OVER (PARTITION BY column_name, x) - 1) / 2.0::double AS r FROM tall),
aucs AS (SELECT column_name, (sum(case when Target = 1 then r else 0 end) - sum(Target) * (sum(Target) + 1) / 2)
  / (sum(Target) * sum(1 - Target)) AS a FROM ranked GROUP BY column_name)
SELECT column_name, round(greatest(a, 1 - a), 8) AS roc_auc FROM aucs""")
def univariate_auc(spark, sf):
    t = materialize(train_rows(spark, sf, [*NUMERIC_COLS, "Target"]))
    filled = BaseFeatureEngineer(categorical_cols=["none"]).fit(t).impute(t)
    tall = filled.unpivot(["Target"], NUMERIC_COLS, "column_name", "score")
    a = F.col("roc_auc")
    return roc_auc(tall, keys=["column_name"]).select(
        "column_name", F.round(F.greatest(a, 1 - a), 8).alias("roc_auc"))


@query("b11_cardinality", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct FROM fe WHERE is_test = 0"
    f" HAVING count(DISTINCT {c}) <= 30" for c in [*CATEGORICAL_COLS, "province_sector"]))
def cardinality(spark, sf):
    t = _engineered(spark, sf, CATEGORICAL_COLS, [*CATEGORICAL_COLS, "province_sector"], part="train")
    return profile.cardinalities(t, [*CATEGORICAL_COLS, "province_sector"]).where("n_distinct <= 30")


@query("b13_prediction_summary", """
SELECT model, round(avg(score), 8) AS mean, min(score) AS "min", max(score) AS "max",
  round(avg(case when score > 0.5 then 1.0::double else 0.0::double end), 9) AS share_above_half
FROM longs GROUP BY model""")
def prediction_summary(spark, sf):
    models = ["s1", "s2", "s3", "s4"]
    long = scored_rows(spark, sf, models).unpivot(["ID"], models, "model", "score")
    return profile.score_summary(long, "score", ["model"]).withColumns(
        {"mean": F.round("mean", 8), "share_above_half": F.round("share_above_half", 9)})


# --- features --------------------------------------------------------------

def _written(spark, sf, raw):
    """The asked columns of all loans, written once for the passes of a fit; and the train part."""
    rows = materialize(loan_view(spark, sf, [ID_COL, *raw, "is_test"]))
    return rows.drop("is_test"), rows.where("is_test = 0").drop("is_test")


def _engineered(spark, sf, raw, out, part="all"):
    """Medians and modes from the training rows, features for all asked rows."""
    rows, train = _written(spark, sf, [c for c in raw if c != ID_COL])
    eng = BaseFeatureEngineer(ranks=False).fit(train)
    rows = train if part == "train" else rows
    return eng.transform(rows).select(*([ID_COL] if part != "train" else []), *out)


@query("c01_missing_flags", "SELECT ID, " + ", ".join(
    f"case when {c} is null then 1.0::double else 0.0::double end AS {c}_was_missing"
    for c in MISSING_FLAG_COLS) + " FROM loans")
def missing_flags(spark, sf):
    return loan.missing_flags(loan_view(spark, sf, ["ID", *MISSING_FLAG_COLS])).select(
        "ID", *[f"{c}_was_missing" for c in MISSING_FLAG_COLS])


@query("c02_median_impute", "SELECT ID, " + ", ".join(NUMERIC_COLS) + " FROM imp")
def median_impute(spark, sf):
    rows, train = _written(spark, sf, NUMERIC_COLS)
    return BaseFeatureEngineer(categorical_cols=["none"]).fit(train).impute(rows)


@query("c02_medians", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, cast(median({c}) as double) AS median FROM train" for c in NUMERIC_COLS))
def median_table(spark, sf):
    found = medians(train_rows(spark, sf, NUMERIC_COLS), NUMERIC_COLS)
    return spark.createDataFrame(sorted(found.items()), "column_name string, median double")


@query("c03_mode_impute", "SELECT ID, " + ", ".join(CATEGORICAL_COLS) + " FROM imp")
def mode_impute(spark, sf):
    rows, train = _written(spark, sf, CATEGORICAL_COLS)
    return BaseFeatureEngineer(numeric_cols=["none"]).fit(train).impute(rows)


def _feature(name, raw, out, digits=None):
    """One query per feature row of the inventory, over all loans."""
    cols = [out] if isinstance(out, str) else out
    pick = [f"round({c}, {digits}) AS {c}" if digits else c for c in cols]

    @query(name, f"SELECT ID, {', '.join(pick)} FROM fe")
    def run(spark, sf):
        got = _engineered(spark, sf, raw, cols)
        return got.withColumns({c: F.round(c, digits) for c in cols}) if digits else got

    return run


_AGE = ["date_approved", "client_dob"]
_PAY = ["amount_usd", "annual_rate_pct", "term_months", "monthly_income_usd"]
_feature("c04_approval_to_disburse", ["date_approved", "date_disbursed"], "approval_to_disburse_days")
_feature("c05_disburse_to_first_pay", ["date_disbursed", "first_payment_due"], "disburse_to_first_pay_days")
_feature("c06_loan_age", ["date_disbursed", "maturity_date"], "loan_age_days")
_feature("c07_client_age", _AGE, "client_age_at_approval")
_feature("c08_month_cycle", ["date_approved"], ["approval_month_sin", "approval_month_cos"], 9)
_feature("c09_quarter", ["date_approved"], "approval_quarter")
_feature("c10_debt_to_income", ["amount_usd", "monthly_income_usd"], "debt_to_income")
_feature("c11_monthly_payment", _PAY, "monthly_payment_est", 6)
_feature("c13_obligation_burden", ["existing_obligations", "monthly_income_usd"], "obligation_burden")
_feature("c14_income_per_dependent", ["monthly_income_usd", "num_dependents"], "income_per_dependent")
_feature("c15_employer_stability", ["months_at_employer", *_AGE], "employer_stability", 9)
_feature("c16_log_amount", ["amount_usd"], "log_amount_usd", 9)
_feature("c17_log_income", ["monthly_income_usd"], "log_monthly_income_usd", 9)
_feature("c18_is_mfi_loan", ["annual_rate_pct"], "is_mfi_loan")
_feature("c19_rate_bucket", ["annual_rate_pct"], "rate_bucket")
_feature("c20_amount_per_month", ["amount_usd", "term_months"], "amount_per_month")
_feature("c21_total_loan_cost", ["amount_usd", "annual_rate_pct", "term_months"], "total_loan_cost", 4)
_feature("c22_many_obligations", ["existing_obligations"], "has_many_obligations")
_feature("c23_new_employee", ["months_at_employer"], "is_new_employee")
_feature("c24_province_sector", ["province", "employment_sector"], "province_sector")
_feature("c25_product_purpose", ["product_code", "loan_purpose"], "product_purpose")
_feature("c26_collateral_score", ["collateral_type"], "collateral_score")
_feature("c27_channel_province", ["disbursement_channel", "province"], "channel_province")
_feature("c30_has_collateral", ["collateral_type"], "has_collateral")


@query("c12_payment_to_income", """
SELECT ID, round(monthly_payment_est / greatest(monthly_income_usd, 1), 8) AS payment_to_income FROM fe""")
def payment_to_income(spark, sf):
    return _engineered(spark, sf, _PAY, ["payment_to_income"]).withColumn(
        "payment_to_income", F.round("payment_to_income", 8))


def _rank_sql(value, group, out):
    return f"""
SELECT ID, case when {value} is not null and {group} is not null then
  (rank() OVER (PARTITION BY {group} ORDER BY {value} NULLS LAST)
   + (count(*) OVER (PARTITION BY {group}, {value}) - 1) / 2.0::double)
  / count({value}) OVER (PARTITION BY {group}) end AS {out} FROM train"""


@query("c28_amount_rank", _rank_sql("amount_usd", "product_code", "amount_rank_in_product"))
def amount_rank(spark, sf):
    t = train_rows(spark, sf, ["ID", "amount_usd", "product_code"])
    return percent_rank_in_group(t, "amount_usd", ["product_code"], "amount_rank_in_product").select(
        "ID", "amount_rank_in_product")


_FITTED_RANK = """
d AS (SELECT product_code AS g, amount_usd AS x, count(*) AS n FROM train GROUP BY 1, 2),
r AS (SELECT g, x, (sum(n) OVER (PARTITION BY g ORDER BY x) - n + (n + 1) / 2.0::double) / sum(n) OVER (PARTITION BY g) AS y FROM d)
SELECT t.ID, round(case when lo.x IS NULL then hi.y when hi.x IS NULL or lo.x = t.amount_usd then lo.y
  else lo.y + (hi.y - lo.y) * (t.amount_usd - lo.x) / (hi.x - lo.x) end, 7) AS amount_rank_in_product
FROM test t ASOF LEFT JOIN r lo ON t.product_code = lo.g AND t.amount_usd >= lo.x
  ASOF LEFT JOIN r hi ON t.product_code = hi.g AND t.amount_usd < hi.x"""


@query("c28_fitted_rank", _FITTED_RANK)
def fitted_rank(spark, sf):
    """Rank of unlabelled rows among the training rows, from a table fine enough to be exact."""
    train = train_rows(spark, sf, ["amount_usd", "product_code"])
    test = test_rows(spark, sf, ["ID", "amount_usd", "product_code"])
    parts = 1 << 20
    ranked = fine_fitted_ranks(test, train, "amount_usd", "product_code", "rank", parts)
    return ranked.select("ID", F.round("rank", 7).alias("amount_rank_in_product"))


@query("c29_income_rank", _rank_sql("monthly_income_usd", "province", "income_rank_in_province"))
def income_rank(spark, sf):
    t = train_rows(spark, sf, ["ID", "monthly_income_usd", "province"])
    return percent_rank_in_group(t, "monthly_income_usd", ["province"], "income_rank_in_province").select(
        "ID", "income_rank_in_province")


@query("c31_drop_dates", "SELECT ID, amount_usd, approval_to_disburse_days, loan_age_days FROM fe")
def drop_dates(spark, sf):
    raw = ["date_approved", "date_disbursed", "maturity_date", "amount_usd"]
    out = BaseFeatureEngineer(ranks=False).fit(train_rows(spark, sf, ["ID", *raw])).transform(
        loan_view(spark, sf, ["ID", *raw]))
    return out.drop("log_amount_usd", "approval_month_sin", "approval_month_cos", "approval_quarter")


@query("c34_is_urban", """
SELECT ID, case when province IN ('NATION_3', 'NATION_7') then 1.0::double else 0.0::double end AS is_urban
FROM loans""")
def is_urban(spark, sf):
    return loan.add_features(
        loan_view(spark, sf, ["ID", "province"]),
        [loan.urban_flag(["NATION_3", "NATION_7"])]).select("ID", "is_urban")


def _extra(name, raw, out, sql, digits=None):
    cols = [out] if isinstance(out, str) else out
    exprs = [sql] if isinstance(sql, str) else sql
    pick = [f"round({e}, {digits}) AS {c}" if digits else f"{e} AS {c}" for c, e in zip(cols, exprs)]

    @query(name, f"SELECT ID, {', '.join(pick)} FROM fe")
    def run(spark, sf):
        rows, train = _written(spark, sf, raw)
        base = BaseFeatureEngineer(ranks=False).fit(train).transform(rows)
        got = loan.add_features(base, loan.EXTRA_FEATURES).select("ID", *cols)
        return got.withColumns({c: F.round(c, digits) for c in cols}) if digits else got

    return run


_extra("c35_interest_burden", ["annual_rate_pct", "amount_usd"], "interest_burden",
       "annual_rate_pct * amount_usd / 100", 4)
_extra("c36_rate_income_ratio", ["annual_rate_pct", "monthly_income_usd"], "rate_income_ratio",
       "annual_rate_pct / greatest(monthly_income_usd, 1)", 9)
_extra("c37_months_to_repay", _PAY, "months_to_repay",
       "amount_usd * (1 + annual_rate_pct / 100 * greatest(term_months, 1) / 12)"
       " / greatest(monthly_income_usd, 1)", 6)
_extra("c38_age_flags", _AGE, ["age_young", "age_senior"],
       ["case when client_age_at_approval < 25 then 1.0::double else 0.0::double end",
        "case when client_age_at_approval > 55 then 1.0::double else 0.0::double end"])
_extra("c39_age_income_ratio", [*_AGE, "monthly_income_usd"], "age_income_ratio",
       "client_age_at_approval / greatest(monthly_income_usd, 1)", 9)
_extra("c40_mfi_no_collateral", ["annual_rate_pct", "collateral_type"], "mfi_no_collateral",
       "case when is_mfi_loan = 1 and has_collateral = 0 then 1.0::double else 0.0::double end")


@query("c41_frequency_columns", """
SELECT ID, province, round((SELECT count(*) FROM train t WHERE t.province = s.province)
  / (SELECT count(*) FROM train), 9) AS province_freq FROM test s""")
def frequency_columns(spark, sf):
    train = train_rows(spark, sf, ["ID", "province"])
    _, test = add_extra_features(train, test_rows(spark, sf, ["ID", "province"]), ["province"])
    return test.select("ID", "province", F.round("province_freq", 9).alias("province_freq"))


@query("c42_native_categories", """
SELECT ID, coalesce(employment_sector, '__NA__') AS employment_sector,
  coalesce(monthly_income_usd, 0.0::double) AS monthly_income_usd FROM loans""")
def native_frame(spark, sf):
    v = loan_view(spark, sf, ["ID", "employment_sector", "monthly_income_usd"])
    return native_categories(v, ["employment_sector"])


@query("c03_modes", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, v AS mode FROM mode_{c}" for c in CATEGORICAL_COLS))
def mode_table(spark, sf):
    found = modes(train_rows(spark, sf, CATEGORICAL_COLS), CATEGORICAL_COLS)
    return spark.createDataFrame(sorted(found.items()), "column_name string, mode string")
