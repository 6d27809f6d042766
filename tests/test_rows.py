"""Row rules, defaults, labels, risk formulas and lookups."""

import math

import pytest
from pyspark.sql import functions as F

from riskframe.functions import risk, text
from riskframe.operators import rows as R
from riskframe.operators.lookup import lookup


def reasons(spark, record, schema):
    df = spark.createDataFrame([record], schema)
    return df.select(R.anomaly_reasons(df.columns).alias("r")).first()["r"]


GOOD = (40, 5.0, 9.0, 0.5, 24)
SCHEMA = "age int, monthly_income double, loan_amount double, ltv double, term_months int"


@pytest.mark.parametrize(
    "change, want",
    [
        ({}, []),
        ({"age": 17}, [R.INVALID_AGE]),
        ({"age": 101}, [R.INVALID_AGE, R.AGE_AT_MATURITY]),
        ({"age": 78, "term_months": 24}, []),
        ({"age": 78, "term_months": 25}, [R.AGE_AT_MATURITY]),
        ({"monthly_income": -0.01, "loan_amount": 0.0, "ltv": 2.1}, [R.NEGATIVE_INCOME, R.INVALID_LOAN, R.LTV_BOUNDS]),
        ({"ltv": 2.0}, []),
        ({"age": None, "monthly_income": None, "loan_amount": None, "ltv": None, "term_months": None}, []),
    ],
)
def test_anomaly_rules(spark, change, want):
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    record = tuple(change.get(n, v) for n, v in zip(names, GOOD))
    assert reasons(spark, record, SCHEMA) == want


def test_absent_columns_read_zero(spark):
    assert reasons(spark, (1,), "other int") == [R.INVALID_AGE, R.INVALID_LOAN]


def test_defaults_fill_columns_and_not_nulls(spark):
    df = spark.createDataFrame([(None,)], "age int")
    row = R.fill_missing_columns(df, ["age", "ltv", "product_type", "unknown"]).first()
    assert tuple(row) == (None, 0.0, "Vehicle Loan", 0)


def test_columns_by_type(spark):
    df = spark.createDataFrame([(1, 2.0, "x", True)], "i int, d double, s string, b boolean")
    assert R.numeric_columns(df) == ["i", "d"] and R.string_columns(df) == ["s"]
    other = spark.createDataFrame([("a", 1.0)], "i string, d double")
    assert R.shared_numeric(df, other) == ["d", "i"] and R.shared_numeric(df, other, both=True) == ["d"]
    assert R.drop_if_present(df.withColumn("PD", F.lit(1))).columns == df.columns


def test_missing_target_lists_columns(spark):
    with pytest.raises(KeyError, match="'i'"):
        R.require_target(spark.range(1).withColumnRenamed("id", "i"), "y")


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(math.nan, 1), (2.0, 2)], "a double, b int")
    assert R.nan_to_null(df).where("a is null").count() == 1
    assert R.drop_null_rows(df, ["a"]).count() == 1


def test_constraints(spark):
    df = spark.createDataFrame([(30, 10), (30, 20), (None, 1)], "age int, years_employed int")
    row = R.constraint_violations(df, {"r": R.inequality("years_employed", "age", 18)}).first()
    assert (row["rule"], row["n_rows"], row["n_violations"]) == ("r", 3, 1)


@pytest.mark.parametrize("indexer_values", [100, 1])
def test_ordinal_codes(spark, indexer_values):
    df = spark.createDataFrame([("b", 1), ("a", 2), (None, 3), ("Z", 4), ("b", 5)], "s string, k int")
    out = R.ordinal_encode(df, ["s"], indexer_values=indexer_values).orderBy("k").collect()
    # Sorted by code point: Missing, Z, a, b.
    assert [r["s"] for r in out] == [3.0, 2.0, 0.0, 1.0, 3.0]


def test_lookup_paths_agree(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 3 > 0, F.concat(F.lit("k"), F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 50))).alias("g"))
    table = df.where("g is not null").groupBy(F.col("g").alias("key")).agg(F.count("*").alias("n")).where("key <> 'k7'")
    results = [
        sorted((r["id"], r["n"]) for r in lookup(df, table.withColumnRenamed("n", "w").withColumn("n", F.col("w")), F.col("g"), ["n"], weight=w, broadcast_rows=b).select("id", "n").collect() if r["n"])
        for w, b in (("w", 10**6), ("w", 0), (None, 0))
    ]
    assert results[0] == results[1] == results[2] and len(results[0]) > 500


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_probability_of_default(spark):
    def pd(age, term, **change):
        f = {"score": 650, "dti": 0.2, "health": 0.4, "late": 1, "insured": "Ada", "married": "Cerai", "employer": 0.1, **change}
        return value(spark, risk.default_probability(
            F.lit(f["score"]), F.lit(f["dti"]), F.lit(f["health"]), F.lit(f["late"]), F.lit(f["insured"]), F.lit(f["married"]), F.lit(f["employer"]), F.lit(age), F.lit(term)))

    logit = -2.0 + 3 * 0.2 + 1.5 * 0.4 + 1 - 1 + 1.5 + 0.1
    assert pd(50, 60) == pytest.approx(1 / (1 + math.exp(-logit)))
    assert pd(60, 60) == pytest.approx(min(0.999, 1 / (1 + math.exp(-logit - 10))))
    assert pd(60, 48) == pd(50, 60)
    assert pd(40, 12, score=850, late=0, married="Menikah", dti=0.0, health=0.0) == pytest.approx(max(0.005, 1 / (1 + math.exp(4.9))))


def test_losses(spark):
    assert value(spark, risk.loss_given_default(F.lit(0), F.lit("Ada"))) == pytest.approx(0.35)
    assert value(spark, risk.loss_given_default(F.lit(1), F.lit("Lapsed"))) == pytest.approx(0.4)
    assert value(spark, risk.loss_given_default(F.lit(1), F.lit("Ada"), F.lit(-9.0))) == 0.1
    assert value(spark, risk.expected_loss(F.lit(0.1), F.lit(0.4), risk.exposure_at_default(F.lit(1000.0), F.lit(0.9)))) == pytest.approx(36.0)


def test_rounding_is_half_to_even(spark):
    assert [value(spark, risk.round_to_long(F.lit(x))) for x in (0.5, 1.5, 2.5, -0.5)] == [0, 2, 2, 0]


def test_ids_and_dates(spark):
    assert value(spark, risk.padded_id("LOAN", F.lit(7))) == "LOAN00007"
    assert str(value(spark, risk.date_from_offset("2024-01-01", F.lit(60)))) == "2024-03-01"


@pytest.mark.parametrize("name, want", [("monthly_income_woe", "Monthly Income"), ("DTI_WOE", "DTI"), ("pastDue_months", "PastDue Months")])
def test_labels(spark, name, want):
    assert value(spark, text.display_label(text.display_feature(F.lit(name)))) == want


@pytest.mark.parametrize("number, want", [(0.12345, "+0.123"), (-2.0, "-2.000"), (0.0, "0.000")])
def test_signed_values(spark, number, want):
    assert value(spark, text.signed_value(F.lit(number))) == want


def test_remap(spark):
    df = spark.createDataFrame([("Pemasukan stabil per bulan", 0.3), ("other", 0.3), ("", 0.3), (None, 0.3)], "stability string, income_stability double")
    out = text.remap_stability(df)
    assert out.columns == ["income_stability"] and [r[0] for r in out.collect()] == [1.0, 0.0, 0.3, 0.3]
    assert [value(spark, text.numeric_text(F.lit(t))) for t in ("12.5", "", "x1", " 7 ")] == [12.5, None, None, 7.0]
