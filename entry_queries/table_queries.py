"""Sources, sinks and cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from loanweave.functions.fixed_values import CATEGORICAL, RAW_NUMERIC
from loanweave.operators.cleaning import (
    cast_label,
    clean_loans,
    drop_raw_numerics,
    fill_unknown,
    select_reporting,
    trim_strings,
)
from loanweave.plans.layers import build_bronze, build_gold
from loanweave.plans.optimisation import build_optimised
from loanweave.session import scratch_path
from loanweave.sources.loans_csv import LOAN_SCHEMA, read_loans_csv
from loanweave.sources.tables import publish_gold, read_table, write_table, write_table_evolve

from . import inputs
from .registry import query, with_bins, with_dirty, with_loans, with_selection

RAW = LOAN_SCHEMA.fieldNames()
CATS = [f"{c}_cat" for c in RAW_NUMERIC]
PER_PURPOSE = """SELECT purpose, count(*) AS credits, CAST(sum(amount) AS BIGINT) AS amount,
    CAST(sum(credit_risk) AS BIGINT) AS bad FROM {table} GROUP BY purpose"""


def per_purpose(df):
    return df.groupBy("purpose").agg(
        F.count("*").alias("credits"), F.sum("amount").alias("amount"), F.sum("credit_risk").alias("bad")
    )


@query("read_loans_csv", with_loans(f"SELECT {', '.join(RAW)} FROM loans"))
def q_read_loans_csv(spark, sf_dir):
    path = scratch_path(spark, "csv")
    inputs.loans(spark, sf_dir).select(*RAW).write.option("header", True).csv(path)
    return read_loans_csv(spark, path)


@query("read_table", with_loans(PER_PURPOSE.format(table="loans")))
def q_read_table(spark, sf_dir):
    path = scratch_path(spark, "orc")
    write_table(inputs.loans(spark, sf_dir), path, fmt="orc")
    return per_purpose(read_table(spark, path, fmt="orc"))


@query("write_table", with_loans("SELECT id, purpose, amount, credit_risk FROM loans WHERE credit_risk = 1"))
def q_write_table(spark, sf_dir):
    path = scratch_path(spark, "parquet")
    loans = inputs.loans(spark, sf_dir).select("id", "purpose", "amount", "credit_risk")
    write_table(loans.limit(0), path)
    write_table(loans, path, partition_by=["credit_risk"])
    return read_table(spark, path).filter("credit_risk = 1")


@query(
    "write_table_evolve",
    with_loans(
        """SELECT id, amount, CAST(NULL AS VARCHAR) AS purpose, CASE WHEN amount > 5000 THEN 1 ELSE 0 END AS large FROM loans"""
    ),
)
def q_write_table_evolve(spark, sf_dir):
    """A column the new rows lack stays as NULL, a new one is added."""
    path = scratch_path(spark, "evolve")
    loans = inputs.loans(spark, sf_dir).select("id", "amount", "purpose")
    write_table(loans, path)
    large = F.when(F.col("amount") > 5000, 1).otherwise(0)
    write_table_evolve(loans.drop("purpose").withColumn("large", large), path)
    return read_table(spark, path)


@query("publish_gold", with_bins(PER_PURPOSE.format(table="binned")))
def q_publish_gold(spark, sf_dir):
    """Read by name from another session of the catalog."""
    reporting = select_reporting(inputs.loans(spark, sf_dir))
    publish_gold(reporting, scratch_path(spark, "gold"), "loanweave_gold", catalog=True)
    return spark.newSession().sql(
        "SELECT purpose, count(*) AS credits, sum(amount) AS amount, sum(credit_risk) AS bad "
        "FROM loanweave_gold GROUP BY purpose"
    )


@query("medallion_layers", with_bins(f"SELECT {', '.join([*CATS, 'amount', *CATEGORICAL, 'credit_risk'])} FROM binned"))
def q_medallion_layers(spark, sf_dir):
    root = scratch_path(spark, "layers")
    raw = f"{root}/raw"
    inputs.loans(spark, sf_dir).select(*RAW).write.option("header", True).csv(raw)
    reporting, _ = build_gold(build_bronze(spark, raw, root), root)
    return reporting


MONEY = ["expected_profit", "expected_loss", "expected_value", "exposure_at_risk"]


@query(
    "build_optimised",
    with_selection(
        f"""SELECT id, optim_choice, CASE WHEN optim_choice = 1 THEN 'Optimized' ELSE 'Baseline' END AS portfolio_type,
        CASE WHEN credit_risk = 1 THEN 'Risque élevé' ELSE 'Risque faible' END AS credit_risk_niveau,
        {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in MONEY)} FROM opt"""
    ),
)
def q_build_optimised(spark, sf_dir):
    """The gold table as it is stored."""
    table = build_optimised(inputs.binned(spark, sf_dir), scratch_path(spark, "optimised"))
    return table.select("id", "optim_choice", "portfolio_type", "credit_risk_niveau", *MONEY)


@query("trim_strings", with_dirty("SELECT id, trim(purpose) AS purpose, trim(job) AS job, trim(housing) AS housing FROM dirty"))
def q_trim_strings(spark, sf_dir):
    return trim_strings(inputs.dirty(spark, sf_dir)).select("id", "purpose", "job", "housing")


@query(
    "fill_unknown",
    with_dirty(
        "SELECT id, age, housing, coalesce(purpose, 'Unknown') AS purpose, coalesce(job, 'Unknown') AS job FROM dirty"
    ),
)
def q_fill_unknown(spark, sf_dir):
    return fill_unknown(inputs.dirty(spark, sf_dir)).select("id", "age", "housing", "purpose", "job")


@query(
    "clean_loans",
    with_dirty(
        """SELECT id, coalesce(trim(purpose), 'Unknown') AS purpose, coalesce(trim(job), 'Unknown') AS job,
        trim(housing) AS housing, credit_risk FROM dirty"""
    ),
)
def q_clean_loans(spark, sf_dir):
    raw = inputs.dirty(spark, sf_dir).withColumn("credit_risk", F.col("credit_risk") == 1)
    return clean_loans(raw).select("id", "purpose", "job", "housing", "credit_risk")


for _name in RAW_NUMERIC:

    @query(f"bin_{_name}", with_bins(f"SELECT id, {_name}, {_name}_cat FROM binned"))
    def q_bin(spark, sf_dir, name=_name):
        return inputs.binned(spark, sf_dir).select("id", name, f"{name}_cat")


@query("select_reporting", with_bins(f"SELECT {', '.join([*CATS, 'amount', *CATEGORICAL, 'credit_risk'])} FROM binned"))
def q_select_reporting(spark, sf_dir):
    return select_reporting(inputs.loans(spark, sf_dir))


@query(
    "drop_raw_numerics",
    with_bins(f"SELECT id, installment_rate, {', '.join([*CATEGORICAL, 'credit_risk', *CATS])} FROM binned"),
)
def q_drop_raw_numerics(spark, sf_dir):
    return drop_raw_numerics(inputs.loans(spark, sf_dir))


@query("cast_label", with_loans("SELECT id, CAST(credit_risk AS DOUBLE) AS label FROM loans"))
def q_cast_label(spark, sf_dir):
    return cast_label(inputs.loans(spark, sf_dir)).select("id", "label")
