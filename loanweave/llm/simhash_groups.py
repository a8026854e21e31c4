"""Near-duplicate groups by SimHash, found through a Gray-order hierarchical index.

Fingerprints that differ in at most ``radius`` of 64 bits agree in at least ``blocks - radius``
of ``blocks`` bit blocks. So each distinct fingerprint goes to one task per choice of that many
blocks, keyed by their bits; the number of blocks follows the number of fingerprints, so that keys
stay selective. In a task the fingerprints of a key are sorted by Gray rank, which puts those that
share bits side by side; every 16 neighbours make a node that holds the bits all of them share (mask
and value), every 16 nodes a node above. Two groups are compared from the top: differing
shared bits add up, and above the radius the whole pair of groups is dropped.

A task returns a spanning forest of the links it finds, never all pairs, so its output is at most its
input. Keys with many fingerprints are dealt out as tiles of salted parts, each pair of parts to a task.
"""

from __future__ import annotations

from itertools import combinations
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from loanweave.session import stage

from .common import components, map_texts

SEED = 42
BITS = 64
FAN = 16
PAIRS_AT_ONCE = 2048
PART_ROWS = 1024
BITS_AT_ONCE = 1 << 16


def simhash(text: bytes | None, shingle: int = 4) -> int:
    """Majority of the hashes' bits over all word shingles, repeats included; without words 0."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    last = min(shingle, len(words)) - 1
    hashes = [
        xxh64_intdigest(joined[a:b], SEED)
        for a, b in zip(starts[: len(words) - last].tolist(), ends[last:].tolist(), strict=True)
    ]
    votes = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), BITS_AT_ONCE):
        raw = np.array(hashes[at : at + BITS_AT_ONCE], "<u8").view(np.uint8)
        votes += np.unpackbits(raw, bitorder="little").reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<u8")[0])


def with_simhash(docs: DataFrame, keep: list[str], text: str = "text", shingle: int = 4) -> DataFrame:
    """``doc`` (the columns ``keep``) and ``fp``, the fingerprint as a signed long."""

    def fingerprints(texts: list[bytes | None]) -> dict[str, object]:
        return {"fp": np.array([simhash(t, shingle) for t in texts], np.uint64).view(np.int64)}

    return map_texts(docs, keep, fingerprints, {"fp": "bigint"}, text)


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the sequence of Gray codes."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining the sets of ``a`` and ``b``; a label is the smallest place in its set."""
    while len(a):
        la, lb = label[a], label[b]
        apart = la != lb
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        if not len(a):
            break
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            jumped = label[label]
            if np.array_equal(jumped, label):
                break
            label = jumped
    return label


def forest(fp: np.ndarray, group: np.ndarray, radius: int) -> np.ndarray:
    """For codes sorted by group and Gray rank: each one's set, linked within ``radius`` inside its group."""
    label = np.arange(len(fp))
    if len(fp) < 2:
        return label
    # Per level: shared value, mask of shared bits, first and last group. Level 0 is the codes themselves.
    levels = [(fp, np.full(len(fp), np.uint64(2**64 - 1)), group, group)]
    low, high = fp, fp
    while len(low) > 1:
        starts = np.arange(0, len(low), FAN)
        ends = np.minimum(starts + FAN, len(low)) - 1
        low, high = np.bitwise_and.reduceat(low, starts), np.bitwise_or.reduceat(high, starts)
        levels.append((low, ~(low ^ high), levels[-1][2][starts], levels[-1][3][ends]))
    steps = np.arange(FAN)
    stack = [(len(levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        level, i, j = stack.pop()
        if len(i) > PAIRS_AT_ONCE:
            stack.append((level, i[PAIRS_AT_ONCE:], j[PAIRS_AT_ONCE:]))
            i, j = i[:PAIRS_AT_ONCE], j[:PAIRS_AT_ONCE]
        value, mask, first, last = levels[level - 1]
        if level == 1:
            # Leaves that are one set already have nothing to add.
            both = np.concatenate([i[:, None] * FAN + steps, j[:, None] * FAN + steps], axis=1)
            sets = label[np.minimum(both, len(fp) - 1)]
            open_ = sets.min(axis=1) != sets.max(axis=1)
            i, j = i[open_], j[open_]
        a = np.repeat(i[:, None] * FAN + steps, FAN, axis=1).ravel()
        b = np.tile(j[:, None] * FAN + steps, (1, FAN)).ravel()
        keep = (a < b if level == 1 else a <= b) & (b < len(value)) & (a < len(value))
        a, b = a[keep], b[keep]
        keep = last[a] >= first[b]
        a, b = a[keep], b[keep]
        keep = np.bitwise_count((value[a] ^ value[b]) & mask[a] & mask[b]) <= radius
        a, b = a[keep], b[keep]
        if level == 1:
            label = merge(label, a, b)
        elif len(a):
            stack.append((level - 1, a, b))
    return label


def block_masks(count: int, radius: int) -> list[int]:
    """Masks of the block choices; at least ``radius + 1`` blocks, more until keys tell ``count`` codes apart."""
    blocks = radius + 1
    while BITS * (blocks - radius) / blocks < log2(max(count, 2)) - 6 and blocks < 4 * (radius + 1):
        blocks += 1
    edges = [BITS * k // blocks for k in range(blocks + 1)]
    parts = [(1 << edges[k + 1]) - (1 << edges[k]) for k in range(blocks)]
    masks = [sum(chosen) for chosen in combinations(parts, blocks - radius)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def hamming_links(codes: DataFrame, radius: int = 4, part_rows: int = PART_ROWS) -> DataFrame:
    """Links (a, b) that join the distinct codes ``fp`` exactly as all pairs within ``radius`` would."""
    masks = block_masks(codes.count(), radius)
    keyed = codes.select(
        "fp",
        F.explode(
            F.array(
                *[F.struct(F.lit(k).alias("choice"), F.col("fp").bitwiseAND(m).alias("bits")) for k, m in enumerate(masks)]
            )
        ).alias("key"),
    ).select("fp", "key.choice", "key.bits")
    large = (
        keyed.groupBy("choice", "bits")
        .agg(F.ceil(F.count(F.lit(1)) / part_rows).cast("int").alias("parts"))
        .where("parts > 1")
    )
    part = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    tiled = (
        keyed.join(large, ["choice", "bits"], "left")
        .withColumn("parts", F.coalesce("parts", F.lit(1)))
        .withColumn("part", part)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("fp", "choice", "bits", F.least("part", "other").alias("one"), F.greatest("part", "other").alias("two"))
    )

    def run(batches):
        columns = [[] for _ in range(5)]
        for batch in batches:
            for k in range(5):
                columns[k].append(batch.column(k).to_numpy(zero_copy_only=False))
        if not columns[0]:
            return
        fp, choice, bits, one, two = (np.concatenate(c) for c in columns)
        fp = fp.view(np.uint64)
        order = np.lexsort((gray_rank(fp), two, one, bits, choice))
        fp = fp[order]
        keys = np.stack([choice[order], bits[order], one[order], two[order]])
        group = np.concatenate([[0], np.cumsum((keys[:, 1:] != keys[:, :-1]).any(axis=0))])
        label = forest(fp, group, radius)
        tied = np.flatnonzero(label != np.arange(len(label)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(fp[tied].view(np.int64)), pa.array(fp[label[tied]].view(np.int64))], names=["a", "b"]
        )

    return tiled.repartition("choice", "bits", "one", "two").mapInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, keep: list[str], radius: int = 4, shingle: int = 4, id_col: str = "doc_id") -> DataFrame:
    """``doc`` (the columns ``keep``, with ``id_col``), ``fp``, ``root`` and ``component_id`` for each row.

    ``root`` is the smallest linked fingerprint and names the group; ``component_id`` is the group's
    smallest id. Null and blank texts have fingerprint 0. Rows without an id belong to their
    group; a group without any id has a null ``component_id``. Repeated rows are all returned.
    """
    rows = stage(with_simhash(docs, keep, shingle=shingle), "simhash")
    codes = stage(rows.groupBy("fp").agg(F.min(F.col("doc").getField(id_col)).alias("least_id")), "codes")
    roots = components(hamming_links(codes.select("fp"), radius), "simhash-links")
    rooted = stage(
        codes.join(roots, codes["fp"] == roots["node"], "left").select(
            "fp", "least_id", F.coalesce("root", "fp").alias("root")
        ),
        "roots",
    )
    smallest = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    groups = rooted.join(smallest, "root").select("fp", "root", "component_id")
    return rows.join(groups, "fp").select("doc", "fp", "root", "component_id")


def keep_one(docs: DataFrame, radius: int = 4, shingle: int = 4) -> DataFrame:
    """``docs`` with one row of each group: the one with the smallest id, ids before null.

    The texts are written once with their fingerprints and row numbers; all decisions are made on
    narrow columns, and the rows that stay are picked by number, so equal rows and ids do no harm.
    """
    columns = docs.columns
    rows = stage(
        with_simhash(docs, columns, shingle=shingle).withColumn("row", F.monotonically_increasing_id()), "simhash-docs"
    )
    key = rows.select(F.struct(F.col("doc").getField("doc_id").alias("doc_id"), "row").alias("key"), "row", "fp")
    codes = stage(key.groupBy("fp").agg(_first_key().alias("key")), "codes")
    roots = components(hamming_links(codes.select("fp"), radius), "simhash-links")
    rooted = codes.join(roots, codes["fp"] == roots["node"], "left").select(
        F.coalesce("root", "fp").alias("root"), "key"
    )
    chosen = rooted.groupBy("root").agg(_first_key().alias("key")).select(F.col("key.row").alias("row"))
    return rows.join(chosen, "row", "left_semi").select(*[F.col("doc").getField(c).alias(c) for c in columns])


def _first_key():
    """The key with the smallest id, rows without an id last."""
    return F.min_by("key", F.struct(F.col("key.doc_id").isNull(), F.col("key.doc_id"), F.col("key.row")))
