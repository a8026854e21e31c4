"""Vectors as short codes: one of 256 entries for each of four parts, found by integers alone.

Components become whole numbers. A part and the entries of its codebook are padded with zeros to a power of two and
go through the Walsh-Hadamard transform, which scales all squared distances by its length. In sequency order, slow
changes first, squared differences are added up; an entry whose sum so far is above the whole distance of an entry already
known is left out. All of it is exact in 64 bits, so ties are real ties and results do not depend on the partitioning.

Codebooks are fitted by rounds of assigning and averaging. A round is one pass over the staged vectors, in which each
task adds up its own rows per entry; these sums, not the vectors, are shuffled. Only codebooks (256 entries a part) are
known to the driver and to every task.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanweave.session import stage

from .common import packed, quoted

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Points compared with all entries at once in a task, so that their sums stay in a core's cache.
BATCH = 128
#: Coefficients after which entries are left out; once fewer than one pair in ``FEW`` is left, only these go on.
HEADS = (2, 4, 8, 16, 32, 64, 128)
FEW = 10


def sequency_order(n: int) -> np.ndarray:
    """Places of the transform's rows by their number of sign changes."""
    bits = n.bit_length() - 1
    gray = np.arange(n) ^ (np.arange(n) >> 1)
    return sum(((gray >> k) & 1) << (bits - 1 - k) for k in range(bits)) if bits else gray


def transformed(points: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of each row, padded with zeros to a power of two, in sequency order."""
    n = 1 << max(0, points.shape[1] - 1).bit_length()
    out = np.zeros((len(points), n), np.int64)
    out[:, : points.shape[1]] = points
    step = 1
    while step < n:
        pairs = out.reshape(len(out), n // (2 * step), 2, step)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(out), n)
        step *= 2
    return out[:, sequency_order(n)]


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For transformed points: the nearest transformed entry (ties: the lower index) and the distance in scaled squares."""
    if not len(points):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    most = max(int(np.abs(points).max()), int(np.abs(entries).max()))
    kind = np.int32 if 4 * points.shape[1] * most * most < 2**31 else np.int64
    points, entries = points.astype(kind), entries.astype(kind)
    columns = np.ascontiguousarray(entries.T)
    blocks = [_nearest(points[at : at + BATCH], entries, columns) for at in range(0, len(points), BATCH)]
    return tuple(np.concatenate(side).astype(np.int64) for side in zip(*blocks, strict=True))


def _nearest(points: np.ndarray, entries: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n, k = points.shape[1], 0
    so_far = np.zeros((len(points), len(entries)), points.dtype)
    step = np.empty_like(so_far)
    bound = None
    for head in [h for h in HEADS if h < n]:
        while k < head:
            _add_square(so_far, step, points[:, k], columns[k])
            k += 1
        # The whole distance of one entry bounds the least one from above.
        guess = ((points - entries[so_far.argmin(axis=1)]) ** 2).sum(axis=1, dtype=points.dtype)
        bound = guess if bound is None else np.minimum(bound, guess)
        left = so_far <= bound[:, None]
        if np.count_nonzero(left) * FEW < left.size:
            return _among(points, entries, *np.nonzero(left), so_far[left], bound, k)
    while k < n:
        _add_square(so_far, step, points[:, k], columns[k])
        k += 1
    found = so_far.argmin(axis=1)
    return found, so_far[np.arange(len(points)), found]


def _add_square(so_far: np.ndarray, step: np.ndarray, of_points: np.ndarray, of_entries: np.ndarray) -> None:
    np.subtract(of_points[:, None], of_entries[None, :], out=step)
    np.multiply(step, step, out=step)
    np.add(so_far, step, out=so_far)


def _among(points, entries, who, entry, total, bound, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The same for the pairs that are left, by point and then entry; every point has kept one at least."""
    n = points.shape[1]
    while k < n:
        last = min(n, 2 * k)
        step = points[who, k:last] - entries[entry, k:last]
        total = total + (step * step).sum(axis=1, dtype=total.dtype)
        stay = total <= bound[who]
        who, entry, total, k = who[stay], entry[stay], total[stay], last
    starts = np.flatnonzero(np.diff(who, prepend=-1))
    least = np.minimum.reduceat(total, starts)
    first = np.flatnonzero(total == least[who])
    return entry[first[np.flatnonzero(np.diff(who[first], prepend=-1))]], least


def _assigned(parts: np.ndarray, codebooks: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Entries (row, part) and squared distances (row, part) of vectors cut into parts."""
    codes = np.zeros(parts.shape[:2], np.int64)
    errors = np.zeros(parts.shape[:2], np.int64)
    for p, book in enumerate(codebooks):
        entries = transformed(book)
        codes[:, p], scaled = nearest(transformed(parts[:, p]), entries)
        errors[:, p] = scaled // entries.shape[1]
    return codes, errors


def _parts(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), PARTS, width // PARTS)


def _averaged(rows: DataFrame, codebooks: list[np.ndarray], width: int) -> list[np.ndarray]:
    """Codebooks with every entry that has parts replaced by their mean, rounded down."""
    depth = width // PARTS

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((PARTS, ENTRIES, depth), np.int64)
        count = np.zeros((PARTS, ENTRIES), np.int64)
        for batch in batches:
            parts = _parts(batch.column(0), width)
            codes, _ = _assigned(parts, codebooks)
            for p in range(PARTS):
                np.add.at(total[p], codes[:, p], parts[:, p])
                count[p] += np.bincount(codes[:, p], minlength=ENTRIES)
        used = np.argwhere(count)
        columns = [used[:, 0], used[:, 1], count[count > 0]]
        arrays = [pa.array(c, pa.int64()) for c in columns] + [pa.array(total[count > 0].tolist(), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(arrays, names=["part", "entry", "n", "sums"])

    found = rows.select("v").mapInArrow(sums, "part bigint, entry bigint, n bigint, sums array<bigint>")
    totals = [F.sum(F.col("sums")[k].cast("decimal(38,0)")).alias(f"s{k}") for k in range(depth)]
    out = [book.copy() for book in codebooks]
    # At most PARTS * ENTRIES rows.
    for row in found.groupBy("part", "entry").agg(F.sum("n").alias("n"), *totals).collect():
        out[row.part][row.entry] = [int(row[f"s{k}"]) // row.n for k in range(depth)]
    return out


def encode(
    vectors: DataFrame,
    keep: Sequence[str],
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    rounds: int = ROUNDS,
) -> tuple[DataFrame, list[np.ndarray]]:
    """Codes of all vectors, and the codebooks (entries by part).

    Columns: ``doc`` (struct of the columns ``keep``), ``codes`` (four entries), ``errors`` (their squared distances).
    Rows whose vector is null or holds nulls or numbers that are not finite are left out. Vectors shorter than the longest
    are filled up with zeros behind, to a multiple of four components. Entries start as the vectors of the smallest
    ids (equal ids: by their components; null ids last); there are as many as rows if these are fewer
    than 256. Components too large for exact sums in 64 bits (some 90,000 for 64 components) are refused.
    """
    values = F.transform(quoted(vector_col), lambda x: F.floor(x.cast("double") * SCALE).cast("bigint"))
    column = F.col(quoted(vector_col))
    whole = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < math.inf))
    kept = vectors.where(column.isNotNull() & whole)
    rows = stage(kept.select(packed(vectors, keep), F.col(quoted(id_col)).alias("id"), values.alias("v")), "vectors")
    most = rows.agg(F.max(F.size("v")), F.max(F.array_max(F.transform("v", F.abs)))).first()
    width = PARTS * max(1, -(-(most[0] or 0) // PARTS))
    padded = 1 << (width // PARTS - 1).bit_length()
    limit = math.isqrt((2**63 - 1) // (4 * padded * padded))
    if (most[1] or 0) > limit:
        raise ValueError(f"components above {limit // SCALE} cannot be added up exactly")
    rows = rows.withColumn("v", F.concat("v", F.array_repeat(F.lit(0).cast("bigint"), F.lit(width) - F.size("v"))))
    first = rows.select("id", "v").orderBy(F.col("id").asc_nulls_last(), "v").limit(ENTRIES).collect()
    start = np.array([r.v for r in first], np.int64).reshape(len(first), PARTS, width // PARTS)
    codebooks = [start[:, p] for p in range(PARTS)]
    if len(first):
        for _ in range(rounds):
            codebooks = _averaged(rows, codebooks, width)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, errors = _assigned(_parts(batch.column(1), width), codebooks)
            found = [pa.array(a.tolist(), pa.list_(pa.int64())) for a in (codes, errors)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *found], names=["doc", "codes", "errors"])

    none = F.lit(None).cast("array<bigint>")
    schema = rows.select("doc", none.alias("codes"), none.alias("errors")).schema
    return rows.select("doc", "v").mapInArrow(assign, schema), codebooks


def digest(codebooks: list[np.ndarray]) -> str:
    """SHA-256 of all components, by part, entry and place."""
    return hashlib.sha256(",".join(str(x) for book in codebooks for x in book.ravel().tolist()).encode()).hexdigest()
