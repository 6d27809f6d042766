"""Column selection, row validity, defaults and anomaly rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Identifiers and outcome columns that must not reach training.
LEAKAGE_COLUMNS = [
    "customer_id", "name_masked", "loan_id", "issue_date", "PD", "risk_grade", "expected_loss", "LGD", "EAD",
]
# What a scoring request means when a whole feature is absent.
DEFAULT_FEATURES = {
    "credit_history_length": 9.0, "income_stability": 1.0, "interest_rate": 0.05,
    "salary_volatility": 0.05, "avg_account_balance": 2816651.0, "monthly_income": 3203345.0,
    "macro_unemployment": 0.03, "medical_check_grade": "Hijau", "pension_amount": 0.0,
    "recent_cash_withdrawals": 0.0, "outstanding_balance": 1834289.0, "macro_property_index": 101.7,
    "employer_risk_score": 0.03, "digital_payment_frequency": 4.0, "loan_amount": 5004438.0,
    "macro_inflation": 0.015, "macro_interest_rate": 0.054, "card_spending": 0.0,
    "total_existing_installments": 0.0, "product_type": "Vehicle Loan", "ltv": 0.0,
    "marital_status": "Menikah", "employment_type": "Pegawai Swasta", "salary_source": "Payroll",
    "medical_expense_ratio": 0.1, "health_risk_score": 0.2, "age": 40, "life_insurance_coverage": 0,
    "insurance_status": "Tidak ada", "insurance_premium_monthly": 0, "bureau_score": 650,
    "past_due_months": 0, "collateral_flag": "0",
}
# Reason texts of the anomaly rules, in the order they are reported.
INVALID_AGE = "Invalid age"
NEGATIVE_INCOME = "Negative monthly income"
INVALID_LOAN = "Invalid loan amount"
LTV_BOUNDS = "LTV out of bounds"
AGE_AT_MATURITY = "Usia saat pelunasan melebihi batas (80 tahun)"
REASONS = [INVALID_AGE, NEGATIVE_INCOME, INVALID_LOAN, LTV_BOUNDS, AGE_AT_MATURITY]


def drop_if_present(df: DataFrame, names: Sequence[str] = LEAKAGE_COLUMNS) -> DataFrame:
    return df.drop(*names)


def require_target(df: DataFrame, target_col: str) -> DataFrame:
    if target_col not in df.columns:
        raise KeyError(f"Target column '{target_col}' not found in DataFrame. Available columns: {df.columns}")
    return df


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.VarcharType, T.CharType))]


def shared_numeric(reference: DataFrame, current: DataFrame, both: bool = False) -> list[str]:
    """Shared columns, numeric in the reference; ``both`` asks for numeric on either side."""
    names = set(numeric_columns(reference)) & set(numeric_columns(current) if both else current.columns)
    return sorted(names)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes null once, at ingest."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def drop_null_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a value in every column (NaN counts as missing)."""
    return df.na.drop(subset=list(columns))


def fill_missing_columns(df: DataFrame, required: Sequence[str], defaults: Mapping[str, object] = DEFAULT_FEATURES) -> DataFrame:
    """Add absent columns with their default, 0 where none is known. Nulls of present columns stay."""
    absent = {f: F.lit(defaults.get(f, 0)) for f in required if f not in df.columns}
    return df.withColumns(absent) if absent else df


def anomaly_reasons(columns: Sequence[str]) -> Column:
    """Reasons a record is invalid, as an array in fixed order.

    An absent column reads as 0; a null compares false and gives no reason. The loan-to-value rule
    exists only where the column does.
    """

    def read(name: str) -> Column:
        return F.col(name).try_cast("double") if name in columns else F.lit(0.0)

    age = read("age")
    rules = [
        ((age < 18) | (age > 100), INVALID_AGE),
        (read("monthly_income") < 0, NEGATIVE_INCOME),
        (read("loan_amount") <= 0, INVALID_LOAN),
    ]
    if "ltv" in columns:
        rules.append(((read("ltv") < 0) | (read("ltv") > 2.0), LTV_BOUNDS))
    rules.append((age + read("term_months") / F.lit(12.0) > 80, AGE_AT_MATURITY))
    return F.array_compact(F.array(*[F.when(F.coalesce(test, F.lit(False)), F.lit(text)) for test, text in rules]))


def constraint_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """``(rule, n_rows, n_violations)`` in one scan; a rule that evaluates to null is no violation."""
    flags = df.select(*[(~r).alias(f"r{i}") for i, r in enumerate(rules.values())])
    counted = flags.agg(F.count("*").alias("n_rows"), *[F.count_if(F.col(f"r{i}")).alias(f"r{i}") for i in range(len(rules))])
    cells = [F.struct(F.lit(n).alias("rule"), F.col(f"r{i}").alias("n_violations")) for i, n in enumerate(rules)]
    return counted.select("n_rows", F.explode(F.array(*cells)).alias("c")).select("c.rule", "n_rows", "c.n_violations")


def inequality(low: str, high: str, difference: float) -> Column:
    """``high - low >= difference`` as a row rule."""
    return F.col(high) - F.col(low) >= F.lit(difference)


# Distinct values per column up to which the indexer may keep the list of values on the driver.
INDEXER_VALUES = 10_000


def ordinal_encode(
    df: DataFrame,
    columns: Sequence[str],
    missing: str = "Missing",
    suffix: str = "",
    indexer_values: int = INDEXER_VALUES,
) -> DataFrame:
    """Each string column as the rank of its value in sorted order; nulls are the value 'Missing'.

    Columns with few values go through StringIndexer together. A column with many (an id, say) gets
    its ranks from a bucketed distributed numbering of the distinct values and a lookup join.
    """
    from pyspark.ml.feature import StringIndexer

    from riskframe.operators.lookup import lookup
    from riskframe.operators.orderstats import dense_index

    if not columns:
        return df
    filled = df.na.fill(missing, subset=list(columns))
    sizes = filled.agg(*[F.approx_count_distinct(c, 0.02).alias(c) for c in columns]).first()
    few = [c for c in columns if sizes[c] <= indexer_values]
    codes = {c: f"__ord_{c}" for c in columns}
    coded = filled
    if few:
        indexer = StringIndexer(inputCols=few, outputCols=[codes[c] for c in few], stringOrderType="alphabetAsc")
        coded = indexer.fit(filled).transform(filled)
    for c in columns:
        if c not in few:
            values = filled.groupBy(F.col(c).alias("key")).agg(F.count("*").alias("n"))
            ranked = dense_index(values, ["key"], codes[c]).withColumn(codes[c], F.col(codes[c]).cast("double"))
            coded = lookup(coded, ranked, F.col(c), [codes[c]], table_rows=sizes[c], weight="n")
    if suffix:
        return coded.withColumnsRenamed({codes[c]: c + suffix for c in columns})
    return coded.drop(*columns).withColumnsRenamed({codes[c]: c for c in columns})
