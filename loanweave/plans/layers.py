"""Raw files to bronze, silver and gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.cleaning import clean_loans, drop_raw_numerics, select_reporting
from ..sources.loans_csv import read_loans_csv
from ..sources.tables import DEFAULT_FORMAT, publish_gold, read_table, table_path, write_table


def build_bronze(spark: SparkSession, raw_path: str, root: str, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    """Read raw CSV files, clean the texts and write ``bronze_credit``."""
    path = table_path(root, "bronze", "bronze_credit")
    write_table(clean_loans(read_loans_csv(spark, raw_path)), path, fmt)
    return read_table(spark, path, fmt)


def build_gold(bronze: DataFrame, root: str, fmt: str = DEFAULT_FORMAT) -> tuple[DataFrame, DataFrame]:
    """Write the reporting table and the training table; both start from stored bronze."""
    reporting = publish_gold(
        select_reporting(bronze), table_path(root, "gold", "credit_scoring"), "credit_scoring", fmt
    )
    training = publish_gold(
        drop_raw_numerics(bronze), table_path(root, "gold", "credit_scoring_ml"), "credit_scoring_ml", fmt
    )
    return reporting, training
