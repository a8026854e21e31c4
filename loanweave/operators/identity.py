"""Stable row ids and hash-based splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fixed_values import SEED, TRAIN_FRACTION
from ..session import stage

HASH_RANGE = 1 << 32
SPLIT_STEPS = 10_000
# Up to so many files their offsets (some 100 bytes each) are broadcast; beyond, the join moves rows.
MOST_FILES = 100_000


def loan_id(df: DataFrame, key: str | None = None, out: str = "id") -> DataFrame:
    """Add a unique BIGINT id.

    With a source ``key`` the key is the id. Without one the rows are written once and numbered from 1 without
    gaps by their place in the stored files: the ids are fixed by these files, whatever reads them and
    however often, and equal rows differ. No row moves; what is counted and added up is one number per file.
    Writing the same rows again, dealt out differently, gives other ids.
    """
    if key is not None:
        return df.withColumn(out, F.col(key).cast("bigint"))
    stored = stage(df, "loans").select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_place"))
    sizes = stored.groupBy("_file").agg(F.count("*").alias("_rows"))
    # One row per file.
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stage(sizes.select("_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")), "file-offsets")
    if offsets.count() <= MOST_FILES:
        offsets = F.broadcast(offsets)
    numbered = stored.join(offsets, "_file")
    return numbered.withColumn(out, F.col("_before") + F.col("_place") + 1).drop("_file", "_place", "_before")


def hash_number(key: str, seed: int = SEED) -> Column:
    """A pseudo-random number below 2^32 from a key, the same on every run and engine."""
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def with_split(df: DataFrame, key: str = "id", fraction: float = TRAIN_FRACTION, seed: int = SEED) -> DataFrame:
    """Add ``split`` = train or test, decided by the row's key alone."""
    limit = round(fraction * SPLIT_STEPS)
    return df.withColumn("split", F.when(F.pmod(hash_number(key, seed), F.lit(SPLIT_STEPS)) < limit, "train").otherwise("test"))


def train_test_split(
    df: DataFrame, key: str = "id", fraction: float = TRAIN_FRACTION, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    both = with_split(df, key, fraction, seed)
    return (
        both.filter(F.col("split") == "train").drop("split"),
        both.filter(F.col("split") == "test").drop("split"),
    )
