"""Views over the given tables that the queries share, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskframe.functions import risk
from riskframe.functions.hashing import HEX_DIGITS, uniform
from riskframe.operators.passes import spread_small
from riskframe.plans.registry import table

LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
CREDIT_NUMERIC = ["l_quantity", "l_extendedprice"]
CREDIT_CATEGORIES = ["l_discount", "l_tax", "l_returnflag", "l_linestatus"]
SPLIT_DAY = "1998-07-01"


def sql_uniform(seed: str, *keys: str, digits: int = HEX_DIGITS) -> str:
    parts = ", ".join([f"'{seed}'", *keys])
    return f"(('0x' || substr(md5(concat_ws('|', {parts})), 1, {digits}))::BIGINT / {float(16**digits)}::DOUBLE)"


def credit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem with a target that depends on quantity, discount and return flag."""
    u = uniform("42", "l_orderkey", "l_linenumber", "l_partkey", digits=8)
    returned = F.when(F.col("l_returnflag") == "R", F.lit(0.15)).otherwise(F.lit(0.0))
    risk_level = F.lit(0.05) + F.lit(0.004) * F.col("l_quantity") + F.col("l_discount") + returned
    # Small fixtures are one row group: without spreading them one core would compute every hash.
    return spread_small(table(spark, sf_dir, "lineitem")).withColumn("y", F.when(u < risk_level, F.lit(1)).otherwise(F.lit(0)))


CREDIT_SQL = f"""credit AS (
  SELECT *, CASE WHEN {sql_uniform('42', 'l_orderkey', 'l_linenumber', 'l_partkey', digits=8)}
    < 0.05::DOUBLE + 0.004::DOUBLE * l_quantity + l_discount
      + CASE WHEN l_returnflag = 'R' THEN 0.15::DOUBLE ELSE 0::DOUBLE END THEN 1 ELSE 0 END AS y
  FROM lineitem)"""


def early(df: DataFrame) -> DataFrame:
    return df.where(F.col("l_shipdate") < F.lit(SPLIT_DAY).cast("timestamp_ntz"))


def late(df: DataFrame) -> DataFrame:
    return df.where(F.col("l_shipdate") >= F.lit(SPLIT_DAY).cast("timestamp_ntz"))


EARLY_SQL = f"l_shipdate < TIMESTAMP '{SPLIT_DAY}'"
LATE_SQL = f"l_shipdate >= TIMESTAMP '{SPLIT_DAY}'"

# Text columns of a loan application, derived from an order and its customer.
_EMPLOYMENT = list(risk.EMPLOYER_RISK)
_TERMS = [12, 24, 36, 60]


def applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A loan application per order."""
    joined = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    ok, ck = F.col("o_orderkey"), F.col("c_custkey")

    def pick(options, index: Column) -> Column:
        return F.element_at(F.array(*[F.lit(o) for o in options]), (index + 1).cast("int"))

    return joined.select(
        "o_orderkey",
        "c_custkey",
        (F.lit(45) + ck % 25).cast("int").alias("age"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("Cerai")).otherwise(F.lit("Menikah")).alias("marital_status"),
        pick(_EMPLOYMENT, F.col("c_nationkey") % 5).alias("employment_type"),
        F.when(F.col("o_orderstatus") == "F", F.lit("Ada")).when(F.col("o_orderstatus") == "O", F.lit("Lapsed")).otherwise(F.lit("Tidak ada")).alias("insurance_status"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("Vehicle Loan")).otherwise(F.lit("KTA")).alias("product_type"),
        (F.lit(500) + ck % 351).cast("int").alias("bureau_score"),
        (F.lit(0.1) + (ok % 50) / F.lit(100.0)).alias("DTI"),
        ((ok % 100) / F.lit(100.0)).alias("health_risk_score"),
        (ok % 4).cast("int").alias("past_due_months"),
        pick(_TERMS, ok % 4).alias("term_months"),
        F.col("c_acctbal").alias("monthly_income"),
        F.col("o_totalprice").alias("loan_amount"),
        (F.lit(0.9) + (ck % 10) / F.lit(100.0)).alias("utilisation"),
    )


APPLICATIONS_SQL = f"""applications AS (
  SELECT o_orderkey, c_custkey, 45 + c_custkey % 25 AS age,
    CASE WHEN c_mktsegment = 'BUILDING' THEN 'Cerai' ELSE 'Menikah' END AS marital_status,
    ([{', '.join(f"'{e}'" for e in _EMPLOYMENT)}])[c_nationkey % 5 + 1] AS employment_type,
    CASE o_orderstatus WHEN 'F' THEN 'Ada' WHEN 'O' THEN 'Lapsed' ELSE 'Tidak ada' END AS insurance_status,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'Vehicle Loan' ELSE 'KTA' END AS product_type,
    500 + c_custkey % 351 AS bureau_score,
    0.1::DOUBLE + (o_orderkey % 50)::DOUBLE / 100::DOUBLE AS "DTI",
    (o_orderkey % 100)::DOUBLE / 100::DOUBLE AS health_risk_score,
    o_orderkey % 4 AS past_due_months,
    ({_TERMS})[o_orderkey % 4 + 1] AS term_months,
    c_acctbal AS monthly_income, o_totalprice AS loan_amount,
    0.9::DOUBLE + (c_custkey % 10)::DOUBLE / 100::DOUBLE AS utilisation
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

EMPLOYER_RISK_SQL = "CASE employment_type " + " ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in risk.EMPLOYER_RISK.items()) + " END"


def sql_clip(expr: str, low: float, high: float) -> str:
    return f"least(greatest({expr}, {low}::DOUBLE), {high}::DOUBLE)"


PD_SQL = sql_clip(
    f"""1::DOUBLE / (1::DOUBLE + exp(-(-2::DOUBLE - 0.01::DOUBLE * (bureau_score - 650) + 3::DOUBLE * "DTI"
      + 1.5::DOUBLE * health_risk_score + past_due_months
      - CASE WHEN insurance_status = 'Ada' THEN 1::DOUBLE ELSE 0::DOUBLE END
      + 1.5::DOUBLE * CASE WHEN marital_status = 'Cerai' THEN 1::DOUBLE ELSE 0::DOUBLE END
      + {EMPLOYER_RISK_SQL}
      + 10::DOUBLE * CASE WHEN age >= 60 AND term_months >= 60 THEN 1::DOUBLE ELSE 0::DOUBLE END)))""",
    0.005,
    0.999,
)


def with_pd(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "PD",
        risk.default_probability(
            F.col("bureau_score"), F.col("DTI"), F.col("health_risk_score"), F.col("past_due_months"), F.col("insurance_status"),
            F.col("marital_status"), risk.employer_risk_score(F.col("employment_type")), F.col("age"), F.col("term_months"),
        ),
    )
