"""Applications that arrive as files and leave as scored rows.

Scoring keeps no state between rows, so there is no watermark and late data is no
special case. The checkpoint makes every file count once, also after a restart.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.fixed_values import CATEGORICAL, RAW_NUMERIC
from ..operators.model import Scorecard
from ..operators.scoring import score_applications

APPLICATION_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in (*CATEGORICAL, *[f"{c}_cat" for c in RAW_NUMERIC])]
    + [T.StructField("credit_amount", T.LongType())]
)


def read_applications(
    spark: SparkSession,
    path: str,
    schema: T.StructType = APPLICATION_SCHEMA,
    fmt: str = "json",
    files_per_batch: int | None = None,
    **options: str,
) -> DataFrame:
    """A stream of the files in a folder; ``files_per_batch`` bounds one micro-batch."""
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def score_applications_stream(
    applications: DataFrame,
    scorer: PipelineModel | Scorecard,
    sink_path: str,
    checkpoint_path: str,
    amount: str = "credit_amount",
    keep: list[str] | None = None,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Score what has arrived, append it to ``sink_path`` and stop."""
    scored = score_applications(applications, scorer, amount, keep)
    return (
        scored.writeStream.format(fmt)
        .option("path", sink_path)
        .option("checkpointLocation", checkpoint_path)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
