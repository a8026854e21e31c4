"""What several text operators share: per-text functions, byte grams, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanweave.session import stage

ARROW_TYPES = {
    "int": pa.int32(),
    "bigint": pa.int64(),
    "double": pa.float64(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<int>": pa.list_(pa.int32()),
    "array<bigint>": pa.list_(pa.int64()),
    "array<binary>": pa.list_(pa.binary()),
    "array<string>": pa.list_(pa.string()),
}


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def packed(docs: DataFrame, keep: Sequence[str] | None = None):
    """The columns ``keep`` (default: all) as one struct ``doc``, so that no name of theirs can clash."""
    return F.struct(*[F.col(quoted(c)) for c in (docs.columns if keep is None else keep)]).alias("doc")


def unpacked(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns that ``packed`` has put away."""
    return df.select(*[F.col("doc").getField(c).alias(c) for c in columns])


def map_texts(
    docs: DataFrame,
    keep: Sequence[str],
    function: Callable[[list[bytes | None]], dict[str, object]],
    results: dict[str, str],
    text: str = "text",
) -> DataFrame:
    """``doc`` (struct of the columns ``keep``) and one column for each entry of ``results``.

    ``function`` gets the UTF-8 bytes of a batch of whole texts and returns a sequence per result.
    """
    source = docs.select(packed(docs, keep), F.col(quoted(text)).cast("binary").alias("_text"))
    schema = source.select("doc", *[F.lit(None).cast(kind).alias(name) for name, kind in results.items()]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = function(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(found[n], ARROW_TYPES[k]) for n, k in results.items()]],
                names=["doc", *results],
            )

    return source.mapInArrow(run, schema)


def slices(batches: Iterator[pa.RecordBatch], size: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """The batches in parts of about ``size`` bytes, so that a task holds few copies of texts at once."""
    for batch in batches:
        rows = max(1, int(batch.num_rows * size / max(batch.nbytes, size)))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)



class GramCosts:
    """Costs of byte grams, kept in a table of fixed size; what it lacks is computed for each distinct gram.

    ``compute`` maps an array of distinct grams to a row of costs each. A slot holds one gram, and a
    gram that meets another in its slot replaces it, so memory is bounded and no value is approximate.
    """

    def __init__(self, compute: Callable[[np.ndarray], np.ndarray], order: int, width: int, slots_log2: int = 20):
        self.compute, self.order = compute, order
        self.shift = np.uint64(64 - slots_log2)
        # No gram of up to seven bytes has this value, so an empty slot never matches.
        self.keys = np.full(1 << slots_log2, np.uint64(2**64 - 1))
        self.costs = np.zeros((1 << slots_log2, width), np.float32)

    def of(self, grams: np.ndarray) -> np.ndarray:
        slots = ((grams * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)
        costs = self.costs[slots]
        missing = np.flatnonzero(self.keys[slots] != grams)
        if len(missing):
            distinct, place = np.unique(grams[missing], return_inverse=True)
            fresh = self.compute(distinct)
            costs[missing] = fresh[place]
            home = ((distinct * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)
            # Of several grams for one slot the last stays, in both arrays.
            self.keys[home], self.costs[home] = distinct, fresh
        return costs

    def sums(self, texts: list[bytes], start: bytes, chunk: int = 1 << 18) -> np.ndarray:
        """Per text, the sum over its bytes, each with the ``order`` bytes before it (``start`` before the first)."""
        total = np.zeros((len(texts), self.costs.shape[1]))
        for owners, buffer, begins, ends in chunks(texts, start, chunk):
            _add_sums(total, owners, begins, ends, self.of(grams(buffer, self.order)))
        return total

    def sums_and_rest(self, texts: list[bytes], start: bytes, chunk: int = 1 << 18) -> tuple[np.ndarray, list[np.ndarray]]:
        """The same without grams that ``compute`` gives NaN for, and those grams of each text."""
        total = np.zeros((len(texts), self.costs.shape[1]))
        rest: list[list[np.ndarray]] = [[] for _ in texts]
        for owners, buffer, begins, ends in chunks(texts, start, chunk):
            codes = grams(buffer, self.order)
            costs = self.of(codes)
            lacking = np.isnan(costs[:, 0])
            at = np.flatnonzero(lacking & inside(begins, ends, len(codes)))
            costs[lacking] = 0
            _add_sums(total, owners, begins, ends, costs)
            cuts = np.searchsorted(at, begins)
            for owner, own in zip(owners.tolist(), np.split(codes[at], cuts[1:]), strict=True):
                rest[owner].append(own)
        return total, [np.concatenate([np.zeros(0, np.uint64), *own]) for own in rest]


def _add_sums(total: np.ndarray, owners: np.ndarray, begins: np.ndarray, ends: np.ndarray, costs: np.ndarray) -> None:
    # A gram's place is its first byte, so a text's sums run over as many places as it has bytes.
    edges = np.empty(2 * len(begins), np.int64)
    edges[0::2], edges[1::2] = begins, ends
    if edges[-1] == len(costs):
        edges = edges[:-1]
    np.add.at(total, owners, np.add.reduceat(costs, edges, axis=0, dtype=np.float64)[::2])


def inside(begins: np.ndarray, ends: np.ndarray, places: int) -> np.ndarray:
    """Which places hold a gram of one text, not one that runs over into the next text."""
    edges = np.zeros(places + 1, np.int8)
    np.add.at(edges, begins, 1)
    np.add.at(edges, ends, -1)
    return np.cumsum(edges)[:places] > 0


def grams(buffer: np.ndarray, order: int) -> np.ndarray:
    """At every place, the ``order`` + 1 bytes from there on as one number, the first byte on top."""
    n = len(buffer) - order
    out = np.zeros(n, np.uint64)
    for k in range(order + 1):
        out <<= np.uint64(8)
        out |= buffer[k : k + n]
    return out


def chunks(texts: list[bytes], start: bytes, size: int):
    """Texts joined to arrays of about ``size`` bytes, each text with ``start`` before it; long ones in parts.

    A part is led by the bytes before it, so no gram is lost or counted twice. Gives the texts' places
    in the list, the bytes, and for each part where its grams begin and end; empty texts have no part.
    """
    order = len(start)
    owners: list[int] = []
    parts: list[bytes] = []
    held = 0
    for k, text in enumerate(texts):
        whole = start + text
        for at in range(0, len(text), size):
            part = whole[at : at + size + order]
            owners.append(k)
            parts.append(part)
            held += len(part)
            if held >= size:
                yield _joined(owners, parts, order)
                owners, parts, held = [], [], 0
    if parts:
        yield _joined(owners, parts, order)


def _joined(owners: list[int], parts: list[bytes], order: int):
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    begins = np.cumsum(lengths) - lengths
    return np.array(owners), np.frombuffer(b"".join(parts), np.uint8), begins, begins + lengths - order


def components(links: DataFrame, name: str) -> DataFrame:
    """``node`` and ``root`` (smallest node it is linked to, itself included) for every node of ``links`` (a, b).

    Large-star and small-star rounds: every round is a few shuffles of the links, the number of
    rounds grows with the logarithm of the longest chain, and nothing but two totals reaches the
    driver. Each round's links are written to the shared folder.
    """
    links = stage(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), name
    )
    before = None
    while True:
        both = links.union(links.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        # The reversed rows keep a node of two stars tied to both of them.
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        links = stage(small.union(low.select("a", "m")).distinct(), name)
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
