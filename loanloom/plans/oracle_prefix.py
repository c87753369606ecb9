"""Shared SQL for the oracle: the loan view, imputation, features and folds.

Written for DuckDB. Common table expressions that a query does not use cost
nothing.
"""

from __future__ import annotations

from loanloom.plans.loanview import EXPRESSIONS, SCORES
from loanloom.schema import CATEGORICAL_COLS, NUMERIC_COLS

_VIEW = ",\n".join(f"{sql} AS {name}" for name, (sql, _) in EXPRESSIONS.items())

_MEDIANS = ", ".join(f"cast(median({c}) as double) AS {c}" for c in NUMERIC_COLS)
_MODES = ",\n".join(
    f"mode_{c} AS (SELECT cast({c} as varchar) AS v FROM train WHERE {c} IS NOT NULL"
    f" GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)" for c in CATEGORICAL_COLS)
_IMPUTED = ",\n".join(
    [f"coalesce(cast({c} as double), (SELECT {c} FROM med)) AS {c}" for c in NUMERIC_COLS]
    + [f"coalesce(cast({c} as varchar), (SELECT v FROM mode_{c})) AS {c}" for c in CATEGORICAL_COLS])

PREFIX = f"""
WITH li AS (
  SELECT l_orderkey, round(cast(8 as double) + cast(1920 as double) * avg(l_discount), 4) AS rate,
         count(*) AS n_lines, max(l_returnflag) AS flag, min(l_partkey) AS pk
  FROM lineitem GROUP BY l_orderkey),
joined AS (
  SELECT *, o_orderkey AS k, o_custkey AS ck FROM orders
  LEFT JOIN li ON o_orderkey = l_orderkey LEFT JOIN part ON pk = p_partkey
  LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey),
loans AS (SELECT {_VIEW} FROM joined),
train AS (SELECT * FROM loans WHERE is_test = 0),
test AS (SELECT * FROM loans WHERE is_test = 1),
med AS (SELECT {_MEDIANS} FROM train),
{_MODES},
imp AS (
  SELECT ID, date_approved, date_disbursed, first_payment_due, maturity_date, client_dob,
  Target, is_test,
  {_IMPUTED}
  FROM loans),
dated AS (
  SELECT *,
    cast(date_disbursed - date_approved as int) AS approval_to_disburse_days,
    cast(first_payment_due - date_disbursed as int) AS disburse_to_first_pay_days,
    cast(maturity_date - date_disbursed as int) AS loan_age_days,
    cast(date_approved - client_dob as double) / cast(365.25 as double) AS client_age_at_approval,
    sin(2 * pi() * month(date_approved) / 12) AS approval_month_sin,
    cos(2 * pi() * month(date_approved) / 12) AS approval_month_cos,
    cast(quarter(date_approved) as int) AS approval_quarter
  FROM imp),
fe AS (
  SELECT *,
    amount_usd / greatest(monthly_income_usd, 1) AS debt_to_income,
    amount_usd * (annual_rate_pct / 1200)
      / nullif(1 - pow(1 + annual_rate_pct / 1200, -greatest(term_months, 1)), 0)
      AS monthly_payment_est,
    existing_obligations / greatest(monthly_income_usd, 1) AS obligation_burden,
    monthly_income_usd / nullif(num_dependents + 1, 0) AS income_per_dependent,
    months_at_employer / greatest(client_age_at_approval * 12, 1) AS employer_stability,
    case when amount_usd > -1 then ln(1 + amount_usd) end AS log_amount_usd,
    case when monthly_income_usd > -1 then ln(1 + monthly_income_usd) end AS log_monthly_income_usd,
    case when annual_rate_pct > 40 then 1.0::double else 0.0::double end AS is_mfi_loan,
    case when annual_rate_pct > 0 and annual_rate_pct <= 15 then 0.0::double
         when annual_rate_pct > 15 and annual_rate_pct <= 40 then 1.0::double
         when annual_rate_pct > 40 and annual_rate_pct <= 100 then 2.0::double
         when annual_rate_pct > 100 and annual_rate_pct <= 210 then 3.0::double end AS rate_bucket,
    amount_usd / greatest(term_months, 1) AS amount_per_month,
    amount_usd * (1 + annual_rate_pct / 100 * term_months / 12) AS total_loan_cost,
    case when existing_obligations >= 3 then 1.0::double else 0.0::double end AS has_many_obligations,
    case when months_at_employer < 12 then 1.0::double else 0.0::double end AS is_new_employee,
    province || '_' || employment_sector AS province_sector,
    product_code || '_' || loan_purpose AS product_purpose,
    case collateral_type when 'None' then 0 when 'Guarantor' then 1 when 'Savings' then 1
      when 'Livestock' then 2 when 'Vehicle' then 3 when 'Property' then 4 else 0 end
      AS collateral_score,
    disbursement_channel || '_' || province AS channel_province,
    case when collateral_type <> 'None' then 1.0::double else 0.0::double end AS has_collateral
  FROM dated),
folds AS (
  SELECT ID, cast((row_number() OVER (ORDER BY Target, md5(ID || ':42'), ID) - 1) % 5 as int)
    AS fold_id FROM train),
scored AS (
  SELECT *, {", ".join(f"{sql} AS {name}" for name, sql in SCORES.items())} FROM train),
longs AS (
  {" UNION ALL ".join(f"SELECT ID, Target, '{m}' AS model, {m} AS score FROM scored" for m in SCORES)})
"""


def counts(cols: list[str], source: str = "train") -> str:
    """(column_name, category, n, pos) with missing values as ``nan``."""
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, coalesce(cast({c} as varchar), 'nan') AS category,"
        f" count(*) AS n, sum(Target) AS pos FROM {source} GROUP BY 2" for c in cols)
