"""Language of a text by prediction by partial matching (PPM, escape method C).

Each language has context trees over bytes up to ``ORDER``: a byte seen behind the longest known
context costs its share there; otherwise the escape of that context is paid and the next
shorter one is asked, down to equal shares of all 256 bytes. Counts are frozen after learning,
so the cost of a byte depends on its ``ORDER`` + 1 bytes only, and a text's code length under a
language is a sum over its bytes. No exclusion of bytes that longer contexts have ruled out.

Learning reads about ``SAMPLE`` labelled documents per language, whole, picked by a hash of id and text with
the chance ``SAMPLE`` / number of labelled documents (a parameter). Every label is learned: labels are dealt out to blocks of
about ``LANGUAGES`` by a hash, a block's model is bounded by the bytes of its labels' samples and is broadcast alone, and each
block is one more pass that keeps the best label so far. Every document is predicted, by whole text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanweave.session import stage

from .common import GramCosts, chunks, grams, map_texts, packed, slices

ORDER = 3
SAMPLE = 500
LANGUAGES = 128
UNDETERMINED = "und"
START = b"\0" * ORDER
BEST = "struct<best:string,mass:double,bits:double>"


def remainder(id_col: str, divisor: int):
    """CRC-32 of the id as text modulo ``divisor``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string")) % divisor


def gram_counts(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct grams and their counts, for each chunk of texts."""
    for _, buffer, begins, ends in chunks(texts, START, 1 << 18):
        inside = np.zeros(len(buffer) + 1, np.int8)
        np.add.at(inside, begins, 1)
        np.add.at(inside, ends, -1)
        codes = grams(buffer, ORDER)
        yield np.unique(codes[np.cumsum(inside)[: len(codes)] > 0], return_counts=True)


@dataclass
class ContextTrees:
    """Sorted byte strings as numbers, per order: costs of seen bytes, and of escapes behind contexts."""

    seen: list[tuple[np.ndarray, np.ndarray]]
    escapes: list[tuple[np.ndarray, np.ndarray]]

    @classmethod
    def learned(cls, codes: np.ndarray, counts: np.ndarray) -> ContextTrees:
        seen, escapes = [], []
        for order in range(ORDER + 1):
            keys, place = np.unique(codes & np.uint64((1 << 8 * (order + 1)) - 1), return_inverse=True)
            count = np.bincount(place, counts)
            contexts, of, different = np.unique(keys >> np.uint64(8), return_inverse=True, return_counts=True)
            whole = np.bincount(of, count) + different
            seen.append((keys, -np.log2(count / whole[of])))
            escapes.append((contexts, -np.log2(different / whole)))
        return cls(seen, escapes)

    def costs(self, codes: np.ndarray) -> np.ndarray:
        """Bits for the last byte of each gram."""
        cost = np.full(len(codes), 8.0)
        for order in range(ORDER + 1):
            part = codes & np.uint64((1 << 8 * (order + 1)) - 1)
            known, byte_cost = _looked_up(*self.seen[order], part)
            behind, escape = _looked_up(*self.escapes[order], part >> np.uint64(8))
            cost = np.where(known, byte_cost, np.where(behind, escape + cost, cost))
        return cost


def _looked_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return keys[place] == wanted, values[place]


class Model:
    """All languages' trees, and their costs for every gram that learning has met."""

    def __init__(self, counts):
        self.languages = sorted(counts["lang"].unique())
        self.trees = []
        for lang in self.languages:
            own = counts[counts["lang"] == lang]
            self.trees.append(ContextTrees.learned(own["gram"].to_numpy().astype(np.uint64), own["n"].to_numpy()))
        self.keys = np.unique(counts["gram"].to_numpy().astype(np.uint64))
        self.table = self._costs(self.keys)

    def _costs(self, codes: np.ndarray) -> np.ndarray:
        return np.stack([tree.costs(codes) for tree in self.trees], axis=1).astype(np.float32)

    def costs(self, codes: np.ndarray) -> np.ndarray:
        place = np.minimum(np.searchsorted(self.keys, codes), len(self.keys) - 1)
        out = self.table[place]
        new = self.keys[place] != codes
        if new.any():
            out[new] = self._costs(codes[new])
        return out


def learn(docs: DataFrame, sample: int = SAMPLE, languages: int = LANGUAGES) -> Iterator[Model]:
    """The models of the labelled documents that are not held out, one for each block of labels; none where there are none.

    A block is read from the tables when it is asked for, so the driver holds two models at a time.
    """
    labelled = docs.select("doc_id", "lang", "text").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.coalesce(remainder("doc_id", 4), F.lit(0)) != 2)
    )
    frequent = stage(labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("of")), "labels")
    # A hash of id and text, spread evenly over 0 to 2^63.
    draw = F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 1)
    blocks = -(-frequent.count() // languages)
    for block in range(blocks):
        own = frequent.where(F.pmod(F.xxhash64("lang"), F.lit(blocks)) == block)
        chosen = labelled.join(own, "lang").where(draw <= F.lit(float(sample)) / F.col("of") * F.lit(2.0**63))
        counts = _counted(chosen)
        if len(counts):
            yield Model(counts)


def _counted(chosen: DataFrame):
    """Distinct grams of the chosen texts by label, on the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts: dict[str, list[bytes]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                texts.setdefault(lang, []).append(text.lower())
            for lang, own in texts.items():
                for codes, counts in gram_counts(own):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(codes)), pa.array(codes.view(np.int64)), pa.array(counts)],
                        names=["lang", "gram", "n"],
                    )

    counted = chosen.select("lang", F.col("text").cast("binary")).mapInArrow(count, "lang string, gram bigint, n bigint")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()


def predict(docs: DataFrame, keep: list[str], models: Iterable[Model]) -> DataFrame:
    """``doc`` (the columns ``keep``), ``lang_pred``, ``score`` and ``bits_per_byte``.

    ``und`` with score 0 for null texts, texts without a letter, and all texts if nothing could be learned.
    The score is the best language's share among all labels of all models when code lengths are softened by the square root
    of the text's length. Equal code lengths: the first label in alphabetical order.
    """
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    size = F.octet_length(F.coalesce("text", F.lit("")))
    rows = docs.select(
        packed(docs, keep),
        F.struct(letters.alias("letters"), F.greatest(size, F.lit(1)).cast("double").alias("size")).alias("known"),
        F.lit(None).cast(BEST).alias("found"),
        "text",
    )
    models = iter(models)
    model = next(models, None)
    while model is not None:
        following = next(models, None)
        rows = _better(rows, model, ["doc", "known", "found", *(["text"] if following else [])])
        # Passes before the last are written, so that a task holds one model.
        rows, model = (stage(rows, "languages") if following else rows), following
    found, known = F.col("found"), F.col("known")
    told = known.letters & found.isNotNull()
    return rows.select(
        "doc",
        F.when(told, found.best).otherwise(UNDETERMINED).alias("lang_pred"),
        F.when(told, 1 / found.mass).otherwise(0.0).alias("score"),
        F.coalesce(found.bits / known["size"], F.lit(0.0)).alias("bits_per_byte"),
    )


def _better(rows: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``rows`` with what is found so far compared with one more model's labels."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    tables: list[GramCosts] = []

    def run(texts: list[bytes | None]) -> dict[str, object]:
        model = shared.value
        if not tables:
            tables.append(GramCosts(model.costs, ORDER, len(model.languages)))
        bodies = [(t or b"").lower() for t in texts]
        bits = tables[0].sums(bodies, START)
        size = np.maximum(1, np.fromiter(map(len, bodies), np.int64, len(bodies)))
        least = bits.min(axis=1)
        share = np.exp2((least[:, None] - bits) / np.sqrt(size)[:, None])
        return {"best": [model.languages[k] for k in bits.argmin(axis=1)], "mass": share.sum(axis=1), "bits": least}

    made = map_texts(rows, keep, run, {"best": "string", "mass": "double", "bits": "double"})
    before, known = F.col("doc.found"), F.col("doc.known")

    def kept(bits, mass):
        """Shares are sums over labels against the best one; against a better one they shrink."""
        return mass * F.pow(F.lit(2.0), (F.least(before.bits, F.col("bits")) - bits) / F.sqrt(known["size"]))

    first = (before.bits < F.col("bits")) | ((before.bits == F.col("bits")) & (before.best < F.col("best")))
    both = F.struct(
        F.when(first, before.best).otherwise(F.col("best")).alias("best"),
        (kept(before.bits, before.mass) + kept(F.col("bits"), F.col("mass"))).alias("mass"),
        F.least(before.bits, F.col("bits")).alias("bits"),
    )
    alone = F.struct("best", "mass", "bits")
    found = F.when(before.isNull(), alone).otherwise(both).alias("found")
    return made.select(*[found if c == "found" else F.col("doc").getField(c).alias(c) for c in keep])


def keep_recognised(docs: DataFrame, least_score: float = 0.5) -> DataFrame:
    """``docs`` without those whose language is undetermined or not better than all others together."""
    columns = docs.columns
    found = predict(docs, columns, learn(docs))
    return found.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least_score)).select(
        *[F.col("doc").getField(c).alias(c) for c in columns]
    )
