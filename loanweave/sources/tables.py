"""Layer tables: one folder per layer and table, in a format of choice."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.fixed_values import WATERFALL_STEPS
from ..session import stage

DEFAULT_FORMAT = "parquet"


def table_path(root: str, layer: str, table: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{table}"


def read_table(
    spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT, merge_schema: bool = False
) -> DataFrame:
    """Load a table; ``merge_schema`` unites the columns of files written at different times."""
    reader = spark.read.format(fmt)
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    return reader.load(path)


def write_table(
    df: DataFrame, path: str, fmt: str = DEFAULT_FORMAT, partition_by: list[str] | None = None
) -> None:
    """Replace the table at ``path``."""
    writer = df.write.format(fmt).mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_table_evolve(df: DataFrame, path: str, fmt: str = DEFAULT_FORMAT) -> None:
    """Replace the table's rows and merge its schema.

    Columns that only the old table has stay, as NULL; new ones are added; a column whose type changes is refused.
    The rows are written to the shared folder first, so they may come from the table itself and a failure
    while they are made leaves it as it was.
    """
    old = _schema_of(df.sparkSession, path, fmt)
    new = {field.name: field.dataType for field in df.schema}
    for field in old:
        if field.name in new and new[field.name] != field.dataType:
            raise ValueError(f"{field.name} is {field.dataType.simpleString()} in {path}, not {new[field.name].simpleString()}")
    missing = {field.name: F.lit(None).cast(field.dataType) for field in old if field.name not in new}
    merged = df.withColumns(missing).select(*[f.name for f in old], *[c for c in df.columns if c not in old.names])
    stage(merged, "evolving").write.format(fmt).mode("overwrite").option("mergeSchema", "true").save(path)


def _schema_of(spark: SparkSession, path: str, fmt: str) -> T.StructType:
    """Columns of the table at ``path``; none if there is no table yet."""
    try:
        return spark.read.format(fmt).load(path).schema
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return T.StructType()


def publish_gold(
    df: DataFrame, path: str, name: str, fmt: str = DEFAULT_FORMAT, catalog: bool = False, evolve: bool = False
) -> DataFrame:
    """Write a gold table and make it queryable as ``name``.

    In this session by default; with ``catalog`` as a table of the catalog over these files, for every session that
    uses it. ``evolve`` merges the schema with that of the table before.
    """
    spark = df.sparkSession
    (write_table_evolve if evolve else write_table)(df, path, fmt)
    published = read_table(spark, path, fmt)
    if catalog:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.catalog.createTable(name, path=path, source=fmt)
    else:
        published.createOrReplaceTempView(name)
    return published


def steps_table(spark: SparkSession) -> DataFrame:
    """The four waterfall steps and their order."""
    schema = T.StructType([T.StructField("Step", T.StringType()), T.StructField("Order", T.IntegerType())])
    return spark.createDataFrame(WATERFALL_STEPS, schema)
