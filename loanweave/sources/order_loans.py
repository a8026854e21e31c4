"""Loans derived from an order book.

No loan file ships with this repository. The columns of a loan are computed from the
``orders`` and ``customer`` tables: every order is one loan of its customer. The
expressions are ANSI SQL text, so another engine can build the same loans from the same
tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOAN_EXPRESSIONS = {
    "id": "o_orderkey",
    "duration": "CAST(4 + CAST(dayofyear(o_orderdate) AS INT) % 69 AS BIGINT)",
    "amount": "CAST(floor(o_totalprice/25) AS BIGINT)",
    "present_residence": "CAST(1 + c_nationkey % 4 AS BIGINT)",
    "age": "CAST(19 + CAST(floor(c_acctbal + 1000) AS INT) % 57 AS BIGINT)",
    "number_credits": "CAST(1 + c_custkey % 4 AS BIGINT)",
    "people_liable": "CAST(c_custkey % 3 AS BIGINT)",
    "installment_rate": "CAST(1 + o_orderkey % 4 AS BIGINT)",
    "status": """CASE WHEN c_acctbal < 0 THEN '... < 100 DM' WHEN c_acctbal < 3000 THEN '0 <= ... < 200 DM'
        WHEN c_acctbal < 6000 THEN '... >= 200 DM / salary for at least 1 year'
        ELSE 'no checking account' END""",
    "credit_history": """CASE o_orderpriority
        WHEN '5-LOW' THEN 'no credits taken/ all credits paid back duly'
        WHEN '4-NOT SPECIFIED' THEN 'all credits at this bank paid back duly'
        WHEN '3-MEDIUM' THEN 'existing credits paid back duly till now'
        WHEN '2-HIGH' THEN 'delay in paying off in the past'
        ELSE 'critical account/ other credits existing (not at this bank)' END""",
    "purpose": """CASE o_orderkey % 10 WHEN 0 THEN 'car (new)' WHEN 1 THEN 'car (used)'
        WHEN 2 THEN 'furniture/equipment' WHEN 3 THEN 'retraining' WHEN 4 THEN 'radio/television'
        WHEN 5 THEN 'repairs' WHEN 6 THEN 'education' WHEN 7 THEN 'domestic appliances'
        WHEN 8 THEN 'business' ELSE 'others' END""",
    "savings": """CASE WHEN c_acctbal < 500 THEN 'unknown/no savings account'
        WHEN c_acctbal < 5000 THEN '... < 100 DM' ELSE '... >= 1000 DM' END""",
    "employment_duration": """CASE c_nationkey % 5 WHEN 0 THEN 'unemployed' WHEN 1 THEN '... < 1 year'
        WHEN 2 THEN '1 <= ... < 4 years' WHEN 3 THEN '4 <= ... < 7 years' ELSE '... >= 7 years' END""",
    "personal_status_sex": """CASE c_custkey % 4 WHEN 0 THEN 'male : single'
        WHEN 1 THEN 'female : divorced/separated/married' WHEN 2 THEN 'male : divorced/separated'
        ELSE 'male : married/widowed' END""",
    "other_debtors": """CASE WHEN o_totalprice < 50000 THEN 'guarantor'
        WHEN o_totalprice < 100000 THEN 'co-applicant' ELSE 'none' END""",
    "property": """CASE c_nationkey % 4 WHEN 0 THEN 'real estate' WHEN 1 THEN 'car or other'
        WHEN 2 THEN 'building society savings agreement/life insurance'
        ELSE 'unknown/no property' END""",
    "other_installment_plans": """CASE WHEN o_orderkey % 7 = 0 THEN 'bank'
        WHEN o_orderkey % 7 = 1 THEN 'stores' ELSE 'none' END""",
    "housing": "CASE c_custkey % 5 WHEN 0 THEN 'rent' WHEN 1 THEN 'for free' ELSE 'own' END",
    "job": "c_mktsegment",
    "telephone": "CASE WHEN c_custkey % 2 = 0 THEN 'yes (under customer name)' ELSE 'no' END",
    "foreign_worker": "CASE WHEN c_nationkey % 9 = 0 THEN 'no' ELSE 'yes' END",
    "credit_risk": "CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END",
}


def join_orders(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Loans from both tables; ``orders`` may be a stream.

    No broadcast hint: Spark compares the size of ``customer`` with its threshold, and
    adaptive execution splits a customer that holds too many of the orders.
    """
    joined = orders.join(customers, orders["o_custkey"] == customers["c_custkey"])
    return joined.selectExpr(*[f"{text} AS {name}" for name, text in LOAN_EXPRESSIONS.items()])


def loans_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_orders(
        spark.read.parquet(f"{sf_dir}/orders.parquet"),
        spark.read.parquet(f"{sf_dir}/customer.parquet"),
    )


def dirty_loans(loans: DataFrame) -> DataFrame:
    """The same loans as a careless source would deliver them: padded and missing texts."""
    return loans.withColumns({name: F.expr(text) for name, text in DIRTY_EXPRESSIONS.items()})


DIRTY_EXPRESSIONS = {
    "purpose": "CASE WHEN id % 17 = 0 THEN NULL WHEN id % 3 = 0 THEN concat('  ', purpose, ' ') ELSE purpose END",
    "job": "CASE WHEN id % 19 = 0 THEN NULL ELSE concat(job, '   ') END",
    "housing": "CASE WHEN id % 23 = 0 THEN '' ELSE housing END",
    "age": "CASE WHEN id % 29 = 0 THEN NULL ELSE age END",
    "score": "CASE WHEN id % 31 = 0 THEN CAST('NaN' AS DOUBLE) WHEN id % 37 = 0 THEN NULL ELSE CAST(id AS DOUBLE) END",
}
