"""Loan and borrower feature expressions.

Every feature is one Spark SQL expression over columns that exist when its
stage runs. Stages only matter for features that use earlier ones; Catalyst
collapses the projections into one.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.schema import COLLATERAL_SCORES, DATE_COLS, MISSING_FLAG_COLS, NULL_TEXT, URBAN_PROVINCES


class Feature(NamedTuple):
    name: str
    needs: tuple[str, ...]
    sql: str


def _flag(condition: str) -> str:
    """0.0 / 1.0, where an unknown condition counts as false."""
    return f"cast(coalesce({condition}, false) as double)"


def _joined(first: str, second: str) -> str:
    text = "coalesce(cast({} as string), '" + NULL_TEXT + "')"
    return f"concat({text.format(first)}, '_', {text.format(second)})"


def _score_case(scores: dict[str, int]) -> str:
    arms = " ".join(f"when '{name}' then {points}" for name, points in scores.items())
    return f"case collateral_type {arms} else 0 end"


_INCOME = "greatest(monthly_income_usd, 1.0D)"
_TERM = "greatest(cast(term_months as double), 1.0D)"
_RATE = "(annual_rate_pct / 1200.0D)"

DATE_FEATURES = [
    Feature("approval_to_disburse_days", ("date_disbursed", "date_approved"),
            "datediff(date_disbursed, date_approved)"),
    Feature("disburse_to_first_pay_days", ("first_payment_due", "date_disbursed"),
            "datediff(first_payment_due, date_disbursed)"),
    Feature("loan_age_days", ("maturity_date", "date_disbursed"),
            "datediff(maturity_date, date_disbursed)"),
    Feature("client_age_at_approval", ("date_approved", "client_dob"),
            "datediff(date_approved, client_dob) / 365.25D"),
    Feature("approval_month_sin", ("date_approved",),
            "sin(2 * pi() * month(date_approved) / 12)"),
    Feature("approval_month_cos", ("date_approved",),
            "cos(2 * pi() * month(date_approved) / 12)"),
    Feature("approval_quarter", ("date_approved",), "quarter(date_approved)"),
]

RATIO_FEATURES = [
    Feature("debt_to_income", ("amount_usd", "monthly_income_usd"),
            f"amount_usd / {_INCOME}"),
    Feature("monthly_payment_est",
            ("amount_usd", "annual_rate_pct", "term_months", "monthly_income_usd"),
            f"amount_usd * {_RATE} / nullif(1.0D - power(1.0D + {_RATE}, -{_TERM}), 0.0D)"),
    Feature("obligation_burden", ("existing_obligations", "monthly_income_usd"),
            f"existing_obligations / {_INCOME}"),
    Feature("income_per_dependent", ("monthly_income_usd", "num_dependents"),
            "monthly_income_usd / nullif(num_dependents + 1.0D, 0.0D)"),
    Feature("employer_stability", ("months_at_employer", "client_age_at_approval"),
            "months_at_employer / greatest(client_age_at_approval * 12.0D, 1.0D)"),
    Feature("log_amount_usd", ("amount_usd",), "log1p(amount_usd)"),
    Feature("log_monthly_income_usd", ("monthly_income_usd",), "log1p(monthly_income_usd)"),
    Feature("is_mfi_loan", ("annual_rate_pct",), _flag("annual_rate_pct > 40")),
    Feature("rate_bucket", ("annual_rate_pct",),
            "case when annual_rate_pct <= 0 then null when annual_rate_pct <= 15 then 0.0D"
            " when annual_rate_pct <= 40 then 1.0D when annual_rate_pct <= 100 then 2.0D"
            " when annual_rate_pct <= 210 then 3.0D end"),
    Feature("amount_per_month", ("amount_usd", "term_months"), f"amount_usd / {_TERM}"),
    Feature("total_loan_cost", ("amount_usd", "annual_rate_pct", "term_months"),
            "amount_usd * (1.0D + annual_rate_pct / 100.0D * term_months / 12.0D)"),
    Feature("has_many_obligations", ("existing_obligations",), _flag("existing_obligations >= 3")),
    Feature("is_new_employee", ("months_at_employer",), _flag("months_at_employer < 12")),
    Feature("payment_to_income", ("monthly_payment_est", "monthly_income_usd"),
            f"monthly_payment_est / {_INCOME}"),
]

INTERACTION_FEATURES = [
    Feature("province_sector", ("province", "employment_sector"),
            _joined("province", "employment_sector")),
    Feature("product_purpose", ("product_code", "loan_purpose"),
            _joined("product_code", "loan_purpose")),
    Feature("collateral_score", ("collateral_type",), _score_case(COLLATERAL_SCORES)),
    Feature("channel_province", ("disbursement_channel", "province"),
            _joined("disbursement_channel", "province")),
    Feature("has_collateral", ("collateral_type",),
            f"cast(coalesce(collateral_type, '{NULL_TEXT}') != 'None' as double)"),
]

EXTRA_FEATURES = [
    Feature("interest_burden", ("annual_rate_pct", "amount_usd"),
            "annual_rate_pct * amount_usd / 100.0D"),
    Feature("rate_income_ratio", ("annual_rate_pct", "monthly_income_usd"),
            f"annual_rate_pct / {_INCOME}"),
    Feature("months_to_repay",
            ("amount_usd", "annual_rate_pct", "term_months", "monthly_income_usd"),
            f"amount_usd * (1.0D + annual_rate_pct / 100.0D * {_TERM} / 12.0D) / {_INCOME}"),
    Feature("age_young", ("client_age_at_approval",), _flag("client_age_at_approval < 25")),
    Feature("age_senior", ("client_age_at_approval",), _flag("client_age_at_approval > 55")),
    Feature("age_income_ratio", ("client_age_at_approval", "monthly_income_usd"),
            f"client_age_at_approval / {_INCOME}"),
    Feature("mfi_no_collateral", ("is_mfi_loan", "has_collateral"),
            _flag("is_mfi_loan = 1 and has_collateral = 0")),
]


def urban_flag(provinces: list[str] | None = None) -> Feature:
    names = ", ".join(f"'{p}'" for p in provinces or URBAN_PROVINCES)
    return Feature("is_urban", ("province",), _flag(f"province in ({names})"))


def add_features(df: DataFrame, features: list[Feature]) -> DataFrame:
    """Add every feature whose inputs exist; an input may be an earlier feature."""
    waiting = list(features)
    while waiting:
        have = set(df.columns)
        ready = [f for f in waiting if have.issuperset(f.needs)]
        if not ready:
            break
        df = df.withColumns({f.name: F.expr(f.sql) for f in ready})
        waiting = [f for f in waiting if f not in ready]
    return df


def missing_flags(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """``<col>_was_missing`` flags; call before imputing."""
    names = [c for c in cols or MISSING_FLAG_COLS if c in df.columns]
    return df.withColumns({f"{c}_was_missing": F.col(c).isNull().cast("double") for c in names})


def drop_dates(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    return df.drop(*(cols or DATE_COLS))
