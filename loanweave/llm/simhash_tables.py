"""Document fingerprints by SimHash, and all fingerprints within a Hamming radius by permuted block tables.

A text's terms are its pairs of neighbouring words. Each term's 128-bit hash votes on every bit, with
weight 1 + ln of how often the term occurs; a bit is set if the votes for it outweigh those against.

Fingerprints within ``radius`` agree in at least one of ``radius + k`` choices of ``k`` blocks. Each
choice is a table that is sorted by those blocks' bits; a pair is counted in the first table in which it agrees
only, so counts need no list of pairs. Large blocks are dealt out as tiles of salted parts.
"""

from __future__ import annotations

from collections import Counter
from itertools import combinations
from math import log2

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from loanweave.session import stage

from .common import slices

BITS = 128
RADIUS = 6
PART_ROWS = 1024
TERMS_AT_ONCE = 1 << 16
LOWEST = -(2**63)


def fingerprint(text: bytes | None) -> bytes:
    """16 bytes; zero for a text without words. A single word is its own term."""
    words = (text or b"").lower().split()
    if not words:
        return bytes(BITS // 8)
    terms = Counter(map(b" ".join, zip(words, words[1:], strict=False))) if len(words) > 1 else Counter(words)
    votes = np.zeros(BITS, np.float64)
    hashes = [xxh3_128_digest(t) for t in terms]
    weights = 1 + np.log(np.fromiter(terms.values(), np.float64, len(terms)))
    for at in range(0, len(hashes), TERMS_AT_ONCE):
        raw = np.frombuffer(b"".join(hashes[at : at + TERMS_AT_ONCE]), np.uint8).reshape(-1, BITS // 8)
        weight = weights[at : at + TERMS_AT_ONCE].astype(np.float32)
        votes += weight @ (np.unpackbits(raw, axis=1).astype(np.float32) - np.float32(0.5))
    return np.packbits(votes > 0).tobytes()


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits of two fingerprints given as (high, low) structs."""
    differing = F.bit_count(a["high"].bitwiseXOR(b["high"])) + F.bit_count(a["low"].bitwiseXOR(b["low"]))
    return 1 - differing / F.lit(float(BITS))


def written(code: Column) -> Column:
    return F.concat(*[F.lpad(F.lower(F.hex(code[half])), 16, "0") for half in ("high", "low")])


CODE = "struct<high:bigint,low:bigint>"
CODE_TYPE = pa.struct([("high", pa.int64()), ("low", pa.int64())])


def codes_of(texts: list[bytes | None]) -> pa.Array:
    halves = np.frombuffer(b"".join(map(fingerprint, texts)), ">i8").astype(np.int64).reshape(-1, 2)
    return pa.StructArray.from_arrays([pa.array(halves[:, 0]), pa.array(halves[:, 1])], ["high", "low"])


def in_descending_order(docs: DataFrame) -> DataFrame:
    """``bucket``, ``place``, ``guest``, ``doc_id``, ``text`` and the next document's text, by falling id.

    Ids are cut into ranges of even size; the first document of a range is a guest at the end of the range before,
    and the very first at the end of the last, so that every document meets its next one without an order of
    all rows in one task. Rows without an id come last; rows with one id follow each other by text.
    """
    spark = docs.sparkSession
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LOWEST))
    shares = [k / ranges for k in range(1, ranges)]
    edges = docs.agg(F.percentile_approx(ids, shares, 20 * ranges)).first()[0]
    edges = np.unique(np.array(edges or [], np.int64))

    @F.pandas_udf("int")
    def bucket_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, key.to_numpy(), side="left").astype(np.int32))

    # At most one row per range.
    highest = docs.select(bucket_of(ids).alias("bucket"), ids.alias("key")).groupBy("bucket").agg(F.max("key").alias("key"))
    rows = sorted((r["bucket"], r["key"]) for r in highest.collect())
    hosts = {key: rows[(k + 1) % len(rows)][0] for k, (_, key) in enumerate(rows)}
    guests = spark.createDataFrame([(k, b) for k, b in hosts.items()] or [(None, None)], "key bigint, host int")
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), ids.alias("key"))
    own = keyed.withColumn("bucket", bucket_of("key")).withColumn("guest", F.lit(False))
    visiting = keyed.join(F.broadcast(guests), "key").select(
        "doc_id", "text", "key", F.col("host").alias("bucket"), F.lit(True).alias("guest")
    )
    order = Window.partitionBy("bucket").orderBy("guest", F.desc("key"), "text")
    return own.unionByName(visiting).select(
        "bucket", "guest", "doc_id", "text", F.row_number().over(order).alias("place"), F.lead("text").over(order).alias("next")
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id``, ``n_chars``, digest of the edited text, both fingerprints as (high, low), and two likenesses.

    The edited text has its last third replaced by the beginning of the next document's text, by falling id; after the
    last comes the first. A null text is empty; texts without words have fingerprint zero.
    """
    ordered = in_descending_order(docs)
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next", F.lit(1), cut))
    source = ordered.select(
        "bucket",
        "guest",
        "place",
        "doc_id",
        n.cast("bigint").alias("n_chars"),
        F.when(~F.col("guest"), F.sha2(edited.cast("binary"), 256)).alias("edited_sha256"),
        F.col("text").cast("binary").alias("text"),
        F.when(~F.col("guest"), edited.cast("binary")).alias("edited"),
    )
    kept = source.columns[:-2]
    schema = source.select(*kept, F.lit(None).cast(CODE).alias("code"), F.lit(None).cast(CODE).alias("edited_code")).schema

    def run(batches):
        for batch in slices(batches):
            found = [codes_of(batch.column(name).to_pylist()) for name in ("text", "edited")]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *found], names=schema.names)

    coded = source.mapInArrow(run, schema)
    order = Window.partitionBy("bucket").orderBy("place")
    return (
        coded.withColumn("next_code", F.lead("code").over(order))
        .where("NOT guest")
        .select(
            "doc_id",
            "n_chars",
            "edited_sha256",
            "code",
            "edited_code",
            likeness(F.col("code"), F.col("edited_code")).alias("near_edited"),
            likeness(F.col("code"), F.col("next_code")).alias("near_next"),
        )
    )


def block_tables(count: int, radius: int) -> tuple[list[tuple[int, int]], list[tuple[int, ...]]]:
    """Bit ranges of the blocks, and the choices of blocks that are tables; more blocks for more fingerprints."""
    blocks = radius + 1
    while BITS * (blocks - radius) / blocks < log2(max(count, 2)) - 4 and blocks < 3 * (radius + 1):
        blocks += 1
    edges = [BITS * k // blocks for k in range(blocks + 1)]
    return list(zip(edges, edges[1:], strict=False)), list(combinations(range(blocks), blocks - radius))


def _mask(start: int, end: int) -> tuple[int, int]:
    """High and low half of the bits ``start`` to ``end``, as signed longs."""
    whole = (1 << BITS - start) - (1 << BITS - end)
    halves = (whole >> 64, whole & (1 << 64) - 1)
    return tuple(h - (1 << 64) if h >> 63 else h for h in halves)


def link_counts(codes: DataFrame, radius: int = RADIUS, part_rows: int = PART_ROWS) -> DataFrame:
    """``code`` and ``n_links``, how many other of the distinct codes lie within ``radius``; codes without any are left out."""
    blocks, choices = block_tables(codes.count(), radius)
    masks = [_mask(*b) for b in blocks]
    keys = []
    for k, choice in enumerate(choices):
        high, low = (sum(masks[b][half] for b in choice) for half in (0, 1))
        keys.append(
            F.struct(
                F.lit(k).alias("choice"),
                F.col("code.high").bitwiseAND(F.lit(high)).alias("kh"),
                F.col("code.low").bitwiseAND(F.lit(low)).alias("kl"),
            )
        )
    keyed = codes.select("code", F.explode(F.array(*keys)).alias("key")).select("code", "key.*")
    large = (
        keyed.groupBy("choice", "kh", "kl")
        .agg(F.ceil(F.count(F.lit(1)) / part_rows).cast("int").alias("parts"))
        .where("parts > 1")
    )
    tiled = (
        keyed.join(large, ["choice", "kh", "kl"], "left")
        .withColumn("parts", F.coalesce("parts", F.lit(1)))
        .withColumn("part", F.pmod(F.xxhash64("code.high", "code.low"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            F.col("code.high").alias("high"),
            F.col("code.low").alias("low"),
            "choice",
            "kh",
            "kl",
            F.least("part", "other").alias("one"),
            F.greatest("part", "other").alias("two"),
            "part",
        )
    )

    def run(batches):
        columns = [[] for _ in range(8)]
        for batch in batches:
            for k in range(8):
                columns[k].append(batch.column(k).to_numpy(zero_copy_only=False))
        if columns[0]:
            rows = [np.concatenate(c) for c in columns]
            order = np.lexsort(rows[6:1:-1])
            high, low, choice, kh, kl, one, two, part = (r[order] for r in rows)
            changes = np.flatnonzero(np.diff(np.stack([choice, kh, kl, one, two])).any(axis=0)) + 1
            edges = [0, *changes.tolist(), len(high)]
            links = np.zeros(len(high), np.int64)
            for a, b in zip(edges, edges[1:], strict=False):
                if b - a > 1:
                    _count(links[a:b], high[a:b], low[a:b], part[a:b], choices[choice[a]], masks, choices, one[a] != two[a], radius)
            some = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [pa.array(high[some]), pa.array(low[some]), pa.array(links[some])], names=["high", "low", "links"]
            )

    counted = tiled.repartition("choice", "kh", "kl", "one", "two").mapInArrow(run, "high bigint, low bigint, links bigint")
    return counted.groupBy(F.struct("high", "low").alias("code")).agg(F.sum("links").alias("n_links"))


def _count(links, high, low, part, choice, masks, choices, across, radius) -> None:
    """Adds each code's links inside one tile; with ``across`` only those between its two parts."""
    before = [c for c in choices if c < choice]
    for i in range(0, len(high), 256):
        rows = slice(i, i + 256)
        dh, dl = high[rows, None] ^ high[None, :], low[rows, None] ^ low[None, :]
        near = np.bitwise_count(dh.view(np.uint64)).astype(np.int32) + np.bitwise_count(dl.view(np.uint64)) <= radius
        near &= (dh != 0) | (dl != 0)
        if across:
            near &= part[rows, None] != part[None, :]
        a, b = np.nonzero(near)
        if len(a) and before:
            equal = np.stack([((dh[a, b] & h) == 0) & ((dl[a, b] & w) == 0) for h, w in masks])
            earlier = np.zeros(len(a), bool)
            for c in before:
                earlier |= equal[list(c)].all(axis=0)
            a = a[~earlier]
        links[rows] += np.bincount(a, minlength=len(links[rows]))


def documents_with_links(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``fingerprints`` with ``n_links``: different fingerprints within ``radius`` of the row's own."""
    found = stage(fingerprints(docs), "fingerprints")
    codes = stage(found.select("code").distinct(), "distinct-fingerprints")
    # Written first, so that a code with very many rows can be split in the join.
    counts = stage(link_counts(codes, radius), "link-counts")
    return found.join(counts, "code", "left").withColumn("n_links", F.coalesce("n_links", F.lit(0)))
