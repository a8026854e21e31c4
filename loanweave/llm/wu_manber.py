"""Benchmark passages in documents by Wu-Manber search over words.

The alphabet is words. All passages of 13 words form one search, shorter items another. A block of
two words at the end of the search window decides how far the window may move: as far as the block's
last place in any pattern allows, which for most blocks of a document is nearly the whole window. A
block that ends a pattern's first ``m`` words leads to a bucket, in which the pattern's first word selects
candidates; their bytes are then compared directly.

A search is a few arrays, some six bytes for each byte of benchmark, and holds equal passages once. The benchmark
reaches the executors in blocks of bounded size. One block needs one pass over the documents and no shuffle; with
more, each block's pass stores what it has found by the text's digest, and one join by digest ties it to the rows.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanweave.session import stage

from .common import packed, slices

WINDOW = 13
BLOCK_BYTES = 16_000_000
# ASCII letters and digits and all bytes of other characters make words; A-Z are lower-cased.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


SPACES = re.compile(rb" {2,}")
#: Bytes of words whose codes are computed at once.
PART = 1 << 18
POWERS = np.cumprod(np.full(PART + 1, 0x100000001B3, np.uint64))
FACTOR = np.uint64(0xD6E8FEB86659FD93)
HALF = np.uint64(32)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(WORD_BYTES).split() if text else []


def spaced(text: bytes | None) -> bytes:
    """The words with one space behind each."""
    plain = SPACES.sub(b" ", text.translate(WORD_BYTES)).strip(b" ") if text else b""
    return plain + b" " if plain else b""


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


class Words:
    """Where the words of a ``spaced`` text begin and end, and a 64-bit code of each."""

    def __init__(self, raw: bytes):
        data = np.frombuffer(raw, np.uint8)
        self.raw = raw
        self.ends = np.flatnonzero(data == 32)
        self.starts = np.concatenate([[0], self.ends + 1])[:-1]
        self.codes = np.zeros(len(self.ends), np.uint64)
        at = 0
        while at < len(self.ends):
            first = self.starts[at]
            to = int(np.searchsorted(self.ends, first + PART, "right"))
            if to <= at:
                digest = hashlib.blake2b(raw[first : self.ends[at]], digest_size=8).digest()
                self.codes[at] = int.from_bytes(digest, "little")
                at += 1
                continue
            begins = self.starts[at:to] - first
            places = np.arange(self.ends[to - 1] + 1 - first) - np.repeat(begins, self.ends[at:to] + 1 - self.starts[at:to])
            self.codes[at:to] = _mixed(np.add.reduceat(data[first : self.ends[to - 1] + 1] * POWERS[places], begins))
            at = to

    def blocks(self, size: int) -> np.ndarray:
        """A code for the block that ends at each word; the first words of a text end none."""
        if size == 1:
            return self.codes
        return np.concatenate([self.codes[:1], _mixed(self.codes[:-1] * FACTOR + self.codes[1:])])


class WuManber:
    """Occurrences of word sequences, each tied to a set of item ids."""

    def __init__(self, patterns: dict[tuple[bytes, ...], set[str]]):
        names = sorted(set().union(*patterns.values()))
        number = {name: k for k, name in enumerate(names)}
        last = np.cumsum([len(p) for p in patterns])
        first = last - [len(p) for p in patterns]
        each = [len(items) for items in patterns.values()]
        item = np.array([number[name] for items in patterns.values() for name in items])
        words = Words(b"".join(word + b" " for pattern in patterns for word in pattern))
        self._build(words, np.repeat(first, each), np.repeat(last, each), item, names)

    @classmethod
    def of_places(cls, words: Words, first: np.ndarray, last: np.ndarray, item: np.ndarray, names: list[str]) -> WuManber:
        """Patterns are the words from ``first`` to before ``last``."""
        made = cls.__new__(cls)
        made._build(words, first, last, item, names)
        return made

    def _build(self, words: Words, first: np.ndarray, last: np.ndarray, item: np.ndarray, names: list[str]) -> None:
        length = last - first
        self.least = m = int(length.min())
        self.block = min(2, m)
        self.reach = m - self.block + 1
        whole = length.astype(np.uint64)
        for k in range(int(length.max())):
            inside = np.flatnonzero(k < length)
            whole[inside] = _mixed(whole[inside] * FACTOR + words.codes[first[inside] + k])
        blocks = words.blocks(self.block)
        # Buckets in order of the block's upper half and the first word's; in a bucket equal patterns stand together.
        key = self._keys(blocks[first + m - 1], words.codes[first])
        order = np.lexsort((item, whole, key))
        key, whole, first, last, item = (v[order] for v in (key, whole, first, last, item))
        begin, end = words.starts[first], words.ends[last - 1]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (whole[1:] != whole[:-1])
        for at in np.flatnonzero(~new).tolist():
            new[at] = words.raw[begin[at] : end[at]] != words.raw[begin[at - 1] : end[at - 1]]
        heads = np.flatnonzero(new)
        self.text, self.names = words.raw, names
        self.key = key[heads]
        self.begin, self.end = begin[heads].astype(np.int32), end[heads].astype(np.int32)
        # An item may hold a passage several times.
        fresh = new.copy()
        fresh[1:] |= item[1:] != item[:-1]
        self.item = item[fresh].astype(np.int32)
        self.owned = np.append(np.cumsum(fresh)[heads] - 1, fresh.sum()).astype(np.int32)
        bits = min(max((4 * len(heads)).bit_length(), 8), 26)
        self.drop = np.uint64(64 - bits)
        self.shift = np.full(1 << bits, min(self.reach, 255), np.uint8)
        # Later places of a block allow less and overwrite the earlier ones.
        for place in range(self.block, m + 1):
            self.shift[blocks[first[heads] + place - 1] >> self.drop] = min(m - place, 255)

    @staticmethod
    def _keys(blocks: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        return (blocks >> HALF << HALF) | (firsts >> HALF)

    @property
    def nbytes(self) -> int:
        arrays = (self.key, self.begin, self.end, self.item, self.owned, self.shift)
        return len(self.text) + sum(a.nbytes for a in arrays)

    def hits(self, words: Words) -> Iterator[tuple[int, int, int]]:
        """First word, word after the last, and number of the pattern of each occurrence."""
        back, n = self.least - 1, len(words.codes)
        if n <= back:
            return
        blocks = words.blocks(self.block)
        steps = self.shift[blocks >> self.drop].tolist()
        stops = []
        at = back
        while at < n:
            step = steps[at]
            if not step:
                stops.append(at)
                step = 1
            at += step
        first = np.array(stops, np.int64) - back
        key = self._keys(blocks[first + back], words.codes[first])
        low, high = np.searchsorted(self.key, key, "left"), np.searchsorted(self.key, key, "right")
        some = np.flatnonzero(low < high)
        for k, start, a, b in zip(*(v[some].tolist() for v in (first, words.starts[first], low, high)), strict=True):
            for pattern in range(a, b):
                begin, end = int(self.begin[pattern]), int(self.end[pattern])
                # With the space behind the last word.
                if words.raw[start : start + end - begin + 1] == self.text[begin : end + 1]:
                    yield k, k + self.text.count(b" ", begin, end) + 1, pattern

    def items(self, pattern: int) -> list[str]:
        return [self.names[k] for k in self.item[self.owned[pattern] : self.owned[pattern + 1]].tolist()]

    def find(self, words: list[bytes]) -> Iterator[tuple[int, int, set[str]]]:
        """First word, word after the last, and items of each occurrence."""
        for first, last, pattern in self.hits(Words(b"".join(word + b" " for word in words))):
            yield first, last, set(self.items(pattern))


def searches(items: list[tuple[str, bytes]], window: int = WINDOW) -> list[WuManber]:
    """One search for passages of ``window`` words and one for items that are shorter."""
    names = sorted({name for name, _ in items})
    number = {name: k for k, name in enumerate(names)}
    texts = [spaced(text) for _, text in items]
    words = Words(b"".join(texts))
    sizes = np.array([text.count(b" ") for text in texts], np.int64)
    behind = np.cumsum(sizes)
    item = np.array([number[name] for name, _ in items], np.int64)
    count = np.maximum(sizes - window + 1, 0)
    long = np.repeat(behind - sizes, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    found = []
    if len(long):
        found.append(WuManber.of_places(words, long, long + window, np.repeat(item, count), names))
    short = np.flatnonzero((sizes > 0) & (sizes < window))
    if len(short):
        found.append(WuManber.of_places(words, (behind - sizes)[short], behind[short], item[short], names))
    return found


def item_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[str, bytes]]]:
    """The benchmark in blocks of at most ``block_bytes`` and one item more, read part by part."""
    rows = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")), F.col("text").cast("binary")
    ).where("text is not null")
    block, held = [], 0
    for name, text in rows.toLocalIterator():
        block.append((name, bytes(text)))
        held += len(text)
        if held >= block_bytes:
            yield block
            block, held = [], 0
    if block:
        yield block


def benchmark_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: list[str],
    text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``doc`` (the columns ``keep``), ``n_words``, ``spans`` and ``items`` for each row.

    ``spans`` holds first word and word after the last, in turn, of the stretches inside occurrences, merged and
    sorted; ``items`` the distinct ids of occurring items. A null text has no words; null item
    texts and items without words never occur; an item without an id counts under the empty
    id. Repeated items count once. Without a benchmark nothing occurs.
    """
    body = F.col(text).cast("binary")
    blocks = item_blocks(benchmark, block_bytes)
    one, more = next(blocks, []), next(blocks, None)
    if more is None:
        return _search(docs.select(packed(docs, keep), body.alias("body")), one, window)
    # Only what is found is stored, once for equal texts.
    digest = F.unhex(F.sha2(body, 256))
    texts = docs.where(F.col(text).isNotNull()).select(F.struct(digest.alias("digest")).alias("doc"), body.alias("body"))
    passes = None
    while one is not None:
        found = _search(texts, one, window).where("size(items) > 0").select("doc.digest", "spans", "items")
        found = stage(found.dropDuplicates(["digest"]), "benchmark-pass")
        passes = found if passes is None else passes.unionByName(found)
        one, more = more, next(blocks, None)
    # At most one row of a text for each block.
    parts = passes.groupBy("digest").agg(*[F.flatten(F.collect_list(c)).alias(f"found_{c}") for c in ("spans", "items")])
    rows = _search(docs.select(F.struct(packed(docs, keep), digest.alias("digest")).alias("doc"), body.alias("body")), [], window)
    rows = rows.select("doc.doc", "doc.digest", "n_words").join(parts, "digest", "left")
    return _united(rows.select("doc", "n_words", "found_spans", "found_items"))


RESULTS = "n_words bigint, spans array<int>, items array<string>"


def _search(source: DataFrame, block: list[tuple[str, bytes]], window: int) -> DataFrame:
    shared = source.sparkSession.sparkContext.broadcast(searches(block, window))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [spaced(body) for body in batch.column(1).to_pylist()]
            counts = [text.count(b" ") for text in texts]
            edges = np.cumsum([0, *counts])
            spans: list[list[tuple[int, int]]] = [[] for _ in texts]
            items: list[set[str]] = [set() for _ in texts]
            words = Words(b"".join(texts)) if shared.value else None
            for finder in shared.value:
                for first, last, pattern in finder.hits(words):
                    row = int(np.searchsorted(edges, first, "right")) - 1
                    # Not across two texts.
                    if last <= edges[row + 1]:
                        spans[row].append((first - int(edges[row]), last - int(edges[row])))
                        items[row].update(finder.items(pattern))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array([_merged(s) for s in spans], pa.list_(pa.int32())),
                    pa.array([sorted(i) for i in items], pa.list_(pa.string())),
                ],
                names=["doc", "n_words", "spans", "items"],
            )

    return source.mapInArrow(run, _with_results(source))


def _with_results(source: DataFrame):
    """The schema of ``doc`` and the results."""
    kinds = [part.split() for part in RESULTS.split(", ")]
    return source.select("doc", *[F.lit(None).cast(kind).alias(name) for name, kind in kinds]).schema


def _united(rows: DataFrame) -> DataFrame:
    """Spans of all blocks merged, and items of all blocks in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            spans, items = ([v or [] for v in batch.column(k).to_pylist()] for k in (2, 3))
            merged = [_merged(list(zip(s[::2], s[1::2], strict=True))) for s in spans]
            columns = [pa.array(merged, pa.list_(pa.int32())), pa.array([sorted(set(i)) for i in items], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["doc", "n_words", "spans", "items"])

    return rows.mapInArrow(run, _with_results(rows))


def _merged(spans: list[tuple[int, int]]) -> list[int]:
    out: list[int] = []
    for a, b in sorted(spans):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def covered(spans: str = "spans"):
    """Number of words inside the spans."""
    places = F.sequence(F.lit(0), F.size(spans) - 1)
    signed = F.transform(places, lambda k: F.get(spans, k) * F.when(k % 2 == 0, -1).otherwise(1))
    total = F.aggregate(signed, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return F.when(F.size(spans) == 0, F.lit(0).cast("bigint")).otherwise(total)


def contaminated(n_words: str = "n_words", n_hit: str = "n_hit"):
    """At least a twentieth of the words lie in benchmark passages."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))
