"""Risk formulas as column expressions. Random terms of the formulas are optional input columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Base risk of an employer by employment type.
EMPLOYER_RISK = {
    "Pensiunan": 0.1,
    "ASN aktif": 0.05,
    "ASN kontrak": 0.2,
    "PNS Purna Bakti": 0.15,
    "Pegawai BUMN": 0.08,
}
# Category spellings the formulas test for.
INSURED = "Ada"
DIVORCED = "Cerai"
PENSIONER = "Pensiunan"
VEHICLE_LOAN = "Vehicle Loan"


def clip(value: Column, low: float, high: float) -> Column:
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def flag(condition: Column) -> Column:
    """A truth value as 1.0 / 0.0; unknown counts as false."""
    return F.coalesce(condition, F.lit(False)).cast("double")


def _noise(noise: Column | None) -> Column:
    return F.lit(0.0) if noise is None else noise


def default_probability(
    bureau_score: Column,
    dti: Column,
    health_risk: Column,
    past_due_months: Column,
    insurance_status: Column,
    marital_status: Column,
    employer_risk: Column,
    age: Column,
    term_months: Column,
    noise: Column | None = None,
) -> Column:
    """Logistic probability of default, clipped to [0.005, 0.999]."""
    logit = (
        F.lit(-2.0)
        - F.lit(0.01) * (bureau_score - F.lit(650))
        + F.lit(3.0) * dti
        + F.lit(1.5) * health_risk
        + F.lit(1.0) * past_due_months
        - flag(insurance_status == INSURED)
        + F.lit(1.5) * flag(marital_status == DIVORCED)
        + employer_risk
        + F.lit(10.0) * flag((age >= 60) & (term_months >= 60))
    )
    return clip(F.lit(1.0) / (F.lit(1.0) + F.exp(-logit)) + _noise(noise), 0.005, 0.999)


def loss_given_default(collateral_flag: Column, insurance_status: Column, noise: Column | None = None) -> Column:
    raw = (
        F.lit(0.4)
        + F.lit(0.1) * flag(collateral_flag == 0)
        - F.lit(0.15) * flag(insurance_status == INSURED)
        + _noise(noise)
    )
    return clip(raw, 0.1, 0.8)


def exposure_at_default(outstanding_balance: Column, utilisation: Column) -> Column:
    return outstanding_balance * utilisation


def expected_loss(pd: Column, lgd: Column, ead: Column) -> Column:
    return pd * lgd * ead


def employer_risk_score(employment_type: Column, noise: Column | None = None) -> Column:
    risk = F.lit(None).cast("double")
    for name, value in EMPLOYER_RISK.items():
        risk = F.when(employment_type == name, F.lit(value)).otherwise(risk)
    return risk + _noise(noise)


def monthly_income(base_income: Column, age: Column) -> Column:
    """Half as much again below the age of 55."""
    return base_income * (F.lit(1.0) + F.lit(0.5) * flag(age < 55))


def pension_amount(employment_type: Column, income: Column) -> Column:
    return F.when(employment_type == PENSIONER, F.bround(income * F.lit(0.8), 0)).otherwise(F.lit(0.0))


def medical_expense_ratio(age: Column, noise: Column | None = None) -> Column:
    return clip(F.lit(0.1) + (age - F.lit(40)) * F.lit(0.01) + _noise(noise), 0.05, 0.45)


def salary_volatility(income_stability: Column, noise: Column | None = None) -> Column:
    return clip(F.lit(0.1) + (F.lit(1.0) - income_stability) * F.lit(0.5) + _noise(noise), 0.05, 0.5)


def debt_to_income(installments: Column, income: Column, share: Column) -> Column:
    return clip(installments * F.lit(0.05) + income * F.lit(0.000005) * share, 0.1, 0.6)


def health_risk_score(age: Column, noise: Column | None = None) -> Column:
    return clip(F.lit(0.2) + (age - F.lit(40)) * F.lit(0.015) + _noise(noise), 0.0, 1.0)


def if_insured(insurance_status: Column, amount: Column) -> Column:
    """Coverage and premium exist only for the insured."""
    return F.when(insurance_status == INSURED, amount).otherwise(F.lit(0.0))


def interest_rate(loan_amount: Column, noise: Column | None = None) -> Column:
    return clip(F.lit(0.08) + loan_amount / F.lit(1e9) * F.lit(0.05) + _noise(noise), 0.05, 0.2)


def collateral_flag(product_type: Column) -> Column:
    return F.when(product_type == VEHICLE_LOAN, F.lit(1)).otherwise(F.lit(0))


def loan_to_value(collateral: Column, ratio: Column) -> Column:
    return F.when(collateral == 1, ratio).otherwise(F.lit(0.0))


def round_to_long(value: Column) -> Column:
    """Round half to even, then an integer."""
    return F.bround(value, 0).cast("long")


def padded_id(prefix: str, number: Column) -> Column:
    return F.format_string(f"{prefix}%05d", number)


def date_from_offset(base: str, days: Column) -> Column:
    return F.date_add(F.lit(base).cast("date"), days.cast("int"))
