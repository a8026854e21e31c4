"""Raw loan files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

# Column order and types of a raw loan file.
LOAN_SCHEMA = T.StructType(
    [
        T.StructField("status", T.StringType()),
        T.StructField("duration", T.LongType()),
        T.StructField("credit_history", T.StringType()),
        T.StructField("purpose", T.StringType()),
        T.StructField("amount", T.LongType()),
        T.StructField("savings", T.StringType()),
        T.StructField("employment_duration", T.StringType()),
        T.StructField("installment_rate", T.LongType()),
        T.StructField("personal_status_sex", T.StringType()),
        T.StructField("other_debtors", T.StringType()),
        T.StructField("present_residence", T.LongType()),
        T.StructField("property", T.StringType()),
        T.StructField("age", T.LongType()),
        T.StructField("other_installment_plans", T.StringType()),
        T.StructField("housing", T.StringType()),
        T.StructField("number_credits", T.LongType()),
        T.StructField("job", T.StringType()),
        T.StructField("people_liable", T.LongType()),
        T.StructField("telephone", T.StringType()),
        T.StructField("foreign_worker", T.StringType()),
        T.StructField("credit_risk", T.IntegerType()),
    ]
)


def read_loans_csv(
    spark: SparkSession, path: str, schema: T.StructType = LOAN_SCHEMA, keep_bad: bool = False, **options: str
) -> DataFrame:
    """Read CSV files with a header into typed columns.

    The schema is given, so no pass over the data is spent on guessing it; files whose
    header disagrees with it are refused rather than read into the wrong columns. A line with a value of the wrong
    type or without all fields ends the read. With ``keep_bad`` such lines stay, whole, in ``_corrupt_record``;
    ``split_bad`` parts them from the others.
    """
    reader = spark.read.option("header", True).option("enforceSchema", False)
    if keep_bad:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    else:
        reader = reader.option("mode", "FAILFAST")
    return reader.schema(schema).options(**options).csv(path)


def split_bad(loans: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows without the extra column, and the text of the bad lines."""
    bad = loans[CORRUPT].isNotNull()
    return loans.filter(~bad).drop(CORRUPT), loans.filter(bad).select(CORRUPT)
