"""Balancing classes and bringing numbers to one scale."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fixed_values import SEED
from ..session import stage
from .identity import HASH_RANGE, hash_number
from .profiling import class_balance

COPIES_PER_CHUNK = 10_000
MOST_CLASSES = 1_000
# Slices of a step of the search for the last drawn rows, and rows that are not cut again.
SLICES = 1024
LAST_ROWS = 100_000


def oversample_minority(
    df: DataFrame, label: str = "label", id: str = "id", seed: int = SEED, chunk: int = COPIES_PER_CHUNK
) -> DataFrame:
    """Repeat rows of the smaller classes until every class has the size of the largest.

    Every row is repeated equally often; what is then missing is drawn by a hash of the
    id, so the result is the same on every run. Adds ``copy``, a BIGINT counted from 1.

    Class sizes and draws come from id and label, which are written once. A row's copies are made in chunks that
    are spread over the cluster before they are written out, so a class of one row fills no task.
    A label with more than ``MOST_CLASSES`` values is no class label and is refused.
    """
    narrow = stage(
        df.select(
            F.col(id).alias("id"),
            F.col(label).alias("label"),
            hash_number(id, seed).alias("rank"),
        ),
        "draw",
    )
    found = class_balance(narrow).limit(MOST_CLASSES + 1).collect()
    if len(found) > MOST_CLASSES:
        raise ValueError(f"{label} has more than {MOST_CLASSES} values")
    sizes = {row["label"]: row["count"] for row in found}
    largest = max(sizes.values(), default=0)
    missing = {value: largest % size for value, size in sizes.items() if largest % size}
    cuts = find_cuts(narrow, missing) if missing else {}
    copies = F.lit(1).cast("bigint")
    for value, size in sizes.items():
        if largest == size:
            continue
        extra = F.lit(0)
        if value in missing:
            (rank, last), own = cuts[value], hash_number(id, seed)
            extra = F.when((own < rank) | ((own == rank) & (F.col(id) <= last)), 1).otherwise(0)
        here = F.col(label).eqNullSafe(F.lit(value))
        copies = F.when(here, (F.lit(largest // size) + extra).cast("bigint")).otherwise(copies)
    last_chunk = F.floor((F.col("_copies") - 1) / chunk)
    chunks = df.withColumn("_copies", copies).withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), last_chunk)))
    if any(-(-largest // size) > chunk for size in sizes.values()):
        chunks = chunks.repartition(id, "_chunk")
    first = F.col("_chunk") * chunk + 1
    last = F.least(F.col("_copies"), first + chunk - 1)
    return chunks.withColumn("copy", F.explode(F.sequence(first, last))).drop("_copies", "_chunk")


def find_cuts(rows: DataFrame, wanted: dict) -> dict:
    """For each label the (rank, id) of the last of its first ``wanted`` rows by rank and id.

    One search for all labels: the ranges that hold the ends are cut into slices in one aggregation per step, which
    brings one row per label to the driver, so the number of jobs does not follow the number of labels. Ranges of at
    most ``LAST_ROWS`` rows, of all labels together, are looked at row by row; equal ranks are told apart by id.
    """
    spark = rows.sparkSession
    kinds = rows.schema["label"].dataType.simpleString()
    ends = {label: (0, HASH_RANGE - 1, n) for label, n in wanted.items()}
    while True:
        table = spark.createDataFrame([(v, low, high, n) for v, (low, high, n) in ends.items()], f"of {kinds}, low bigint, high bigint, left bigint")
        near = rows.join(F.broadcast(table), F.col("label").eqNullSafe(F.col("of"))).filter(F.col("rank").between(F.col("low"), F.col("high")))
        width = F.greatest(F.ceil((F.col("high") - F.col("low") + 1) / SLICES), F.lit(1).cast("bigint"))
        slices = near.groupBy("label", F.floor((F.col("rank") - F.col("low")) / width).alias("slice"), "left").agg(
            F.count("*").alias("n"), F.min("rank").alias("low"), F.max("rank").alias("high")
        )
        up_to = F.sum("n").over(Window.partitionBy("label").orderBy("slice"))
        found = slices.withColumn("up_to", up_to).where("up_to >= left AND up_to - n < left").collect()
        ends = {r["label"]: (r["low"], r["high"], r["left"] - (r["up_to"] - r["n"])) for r in found}
        if sum(r["n"] for r in found) <= LAST_ROWS or all(low == high for low, high, _ in ends.values()):
            break
    table = spark.createDataFrame([(v, low, high, n) for v, (low, high, n) in ends.items()], f"of {kinds}, low bigint, high bigint, left bigint")
    near = rows.join(F.broadcast(table), F.col("label").eqNullSafe(F.col("of"))).filter(F.col("rank").between(F.col("low"), F.col("high")))
    place = F.row_number().over(Window.partitionBy("label").orderBy("rank", "id"))
    last = near.select("label", "rank", "id", "left", place.alias("place")).where("place = left").collect()
    return {r["label"]: (r["rank"], r["id"]) for r in last}


def scale_features(
    df: DataFrame, columns: list[str], with_mean: bool = True, with_std: bool = True
) -> DataFrame:
    """Add ``<column>_scaled``: centred and divided by the sample standard deviation."""
    stages = [
        VectorAssembler(inputCols=columns, outputCol="_numbers", handleInvalid="error"),
        StandardScaler(inputCol="_numbers", outputCol="_scaled", withMean=with_mean, withStd=with_std),
    ]
    scaled = Pipeline(stages=stages).fit(df).transform(df)
    values = vector_to_array("_scaled")
    return scaled.withColumns({f"{c}_scaled": values[i] for i, c in enumerate(columns)}).drop("_numbers", "_scaled")
