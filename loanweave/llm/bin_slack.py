"""Best-fit packing of token pieces into sequences by minimum bin slack.

A bin starts with the longest piece left; a subset-sum table over the lengths still available, one
bitset per step, finds the fullest combination that fits beside it. That combination is taken as often
as the counts allow, then the next is searched. All of this needs only how many pieces have each
length, which is at most ``capacity`` numbers; the pieces themselves stay distributed.
A piece's place follows from its number among the pieces of its length.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanweave.session import stage

from .bpe_words import WordIds
from .common import map_texts

CAPACITY = 2048
END_ID = 0
_TOKENIZERS: dict[str, WordIds] = {}


def fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The combination with the least slack that holds the longest piece: how many of each length."""
    longest = max(counts)
    room = capacity - longest
    mask = (1 << room + 1) - 1
    reach, layers = 1, []
    for length in sorted(counts, reverse=True):
        left = min(counts[length] - (length == longest), room // length)
        share = 1
        while left > 0:
            taken = min(share, left)
            layers.append((length, taken, reach))
            reach |= reach << length * taken & mask
            left -= taken
            share *= 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    used = {longest: 1}
    for length, taken, before in reversed(layers):
        if not before >> total & 1:
            total -= length * taken
            used[length] = used.get(length, 0) + taken
    return used


def packing_runs(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first number, pieces, pieces per bin, first bin, first offset) that place all pieces."""
    left = {length: n for length, n in counts.items() if n}
    placed = dict.fromkeys(left, 0)
    runs, bin_ = [], 0
    while left:
        used = fullest(left, capacity)
        bins = min(left[length] // n for length, n in used.items())
        offset = 0
        for length, n in used.items():
            runs.append((length, placed[length], n * bins, n, bin_, offset))
            offset += n * length
            placed[length] += n * bins
            left[length] -= n * bins
            if not left[length]:
                del left[length]
        bin_ += bins
    return runs


def token_pieces(docs: DataFrame, keep: list[str], tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """``doc``, ``piece``, ``start``, ``length`` and ``ids`` (little-endian unsigned 32-bit) of each piece.

    A text's ids and the end id; only longer ones are cut, into pieces of ``capacity``. A null text
    is an empty one: the end id alone.
    """

    def run(texts: list[bytes | None]) -> dict[str, object]:
        if tokenizer not in _TOKENIZERS:
            _TOKENIZERS[tokenizer] = WordIds(tokenizer)
        end = np.array([END_ID], "<u4").tobytes()
        found: list[bytes] = []
        for at in range(0, len(texts), 1000):
            found += [ids + end for ids in _TOKENIZERS[tokenizer].ids([t or b"" for t in texts[at : at + 1000]])]
        return {"ids": found}

    whole = map_texts(docs, keep, run, {"ids": "binary"})
    size = F.floor(F.length("ids") / 4)
    pieces = F.sequence(F.lit(0), F.ceil(size / capacity).cast("int") - 1)
    start = F.col("piece").cast("bigint") * capacity
    ids = F.expr(f"substring(ids, piece * {4 * capacity} + 1, {4 * capacity})")
    return (
        whole.select("doc", "ids", F.explode(pieces).alias("piece"))
        .select("doc", "piece", start.alias("start"), ids.alias("ids"))
        .select("doc", "piece", "start", (F.length("ids") / 4).cast("bigint").alias("length"), "ids")
    )


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (a column ``length``, 1 to ``capacity``) with ``sequence_id`` and ``offset``."""
    spark = pieces.sparkSession
    stored = stage(pieces.withColumn("_part", F.spark_partition_id()), "pieces")
    counts = stage(stored.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("n")), "lengths")
    # At most `capacity` rows.
    totals = {row["length"]: row["n"] for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = packing_runs(totals, capacity)
    plan = spark.createDataFrame(
        runs, "length bigint, first bigint, pieces bigint, per_bin bigint, bin bigint, at bigint"
    )
    parts = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "_part", F.coalesce(F.sum("n").over(parts), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "_part").orderBy("_order")
    numbered = (
        stored.withColumn("_order", F.monotonically_increasing_id())
        .withColumn("_inside", F.row_number().over(inside) - 1)
        .join(before, ["length", "_part"])
        .withColumn("_number", F.col("before") + F.col("_inside"))
    )
    in_run = (F.col("_number") >= F.col("first")) & (F.col("_number") < F.col("first") + F.col("pieces"))
    nth = F.col("_number") - F.col("first")
    placed = numbered.join(plan.withColumnRenamed("length", "_length"), (F.col("length") == F.col("_length")) & in_run)
    return placed.select(
        *pieces.columns,
        (F.col("bin") + F.floor(nth / F.col("per_bin"))).cast("bigint").alias("sequence_id"),
        (F.col("at") + nth % F.col("per_bin") * F.col("length")).alias("offset"),
    )


def sequences(packed: DataFrame) -> DataFrame:
    """The training sequences: ``sequence_id`` and its ``ids`` in offset order. At most ``capacity`` ids a group."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(ordered.alias("parts")).select(
        "sequence_id",
        F.aggregate("parts", F.lit(b""), lambda whole, part: F.concat(whole, part["ids"])).alias("ids"),
    )


def packed_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: id, place in the document, digest of its ids, sequence and place there."""
    pieces = token_pieces(docs, ["doc_id"], tokenizer, capacity)
    narrow = pieces.select(
        "doc.doc_id", "piece", "start", "length", F.crc32("ids").cast("bigint").alias("ids_crc32")
    )
    return pack(narrow, capacity)
