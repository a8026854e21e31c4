"""Code lengths of texts under context-tree weighting of byte contexts.

A byte is eight binary decisions, each with its own context tree over the bytes before. At every
node a Krichevsky-Trofimov estimate is mixed half and half with the product over longer contexts, so
all depths up to ``DEPTH`` take part with weights that the data give. Counts are taken over all
learning texts and then frozen; a byte's code length depends on its ``DEPTH`` + 1 bytes only.

The tree has every context of the learning texts. Counts of all byte strings are a distributed aggregation; the
strings of the other texts take part with a count of zero. Contexts with equal last ``SPLIT`` bytes are weighted
together in one task; only sums for shorter contexts, whose number is fixed, meet on the driver. So every string
of the texts gets its exact cost. The costs of the strings learned most often (at most ``NODES``) are broadcast; all
others meet their costs in a join.

The base score needs every word's count. The most frequent words (at most ``FREQUENT``) are broadcast;
all other words of a text meet their counts in a join.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanweave.session import stage

from .common import GramCosts, chunks, grams, inside, map_texts, slices

DEPTH = 5
#: Contexts of this length are weighted whole in one task; there are at most 65,536 of them.
SPLIT = 2
#: About so many strings are weighted at once.
WEIGHED = 1 << 18
NODES = 1 << 20
FREQUENT = 200_000
#: No byte of UTF-8, so it marks the places before a text and its end.
EDGE = b"\xff"
HELD_WORDS = 300_000
HELD_GRAMS = 1_000_000


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Natural logarithm of the gamma function for x >= 0.5, by Stirling's series at x + 8."""
    y = x + 8.0
    series = (1 / 12 - (1 / 360 - 1 / (1260 * y * y)) / (y * y)) / y
    product = np.ones_like(x)
    for k in range(8):
        product *= x + k
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(product)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - np.log(np.pi)


PREFIXES_AT_ONCE = 8


class Children:
    """Adds rows of contexts to the rows of their next shorter ones, depth by depth."""

    def __init__(self, parent: np.ndarray, depth: np.ndarray):
        self.levels = [np.flatnonzero(depth == d) for d in range(int(depth.max()) + 1)]
        self.sorted = []
        for at in self.levels:
            order = at[np.argsort(parent[at], kind="stable")]
            up = parent[order]
            starts = np.flatnonzero(np.diff(up, prepend=-1))
            self.sorted.append((order, starts, up[starts]))

    def add(self, depth: int, values: np.ndarray, to: np.ndarray) -> None:
        order, starts, up = self.sorted[depth]
        if len(order):
            to[up] += np.add.reduceat(values[order], starts, axis=0)


def code_lengths(counts: np.ndarray, parent: np.ndarray, depth: np.ndarray, deepest: int = DEPTH) -> np.ndarray:
    """Bits for each byte behind each context: [contexts, 256].

    ``counts`` [contexts, 256] of bytes; ``parent`` is each context's next shorter one (the root is its own),
    and parents come first. A row holds for texts whose longest known context is that node.
    """
    children = Children(parent, depth)
    bits = np.zeros(counts.shape, np.float32)
    for b in range(8):
        width = 1 << 8 - b
        for first in range(0, 1 << b, PREFIXES_AT_ONCE):
            last = min(first + PREFIXES_AT_ONCE, 1 << b)
            part = counts[:, first * width : last * width].reshape(len(counts), last - first, 2, width // 2)
            one = _chances(part.sum(axis=3), parent, children, deepest)
            costs = -np.log2(np.stack([1 - one, one], axis=2)).astype(np.float32)
            bits[:, first * width : last * width] += costs.repeat(width // 2, axis=2).reshape(len(counts), -1)
    return bits


def _chances(split: np.ndarray, parent: np.ndarray, children: Children, deepest: int) -> np.ndarray:
    """Chance of a one at every decision, from the counts [contexts, decisions, 2] behind every context."""
    levels = children.levels
    met = np.zeros_like(split)
    for d in range(1, len(levels)):
        children.add(d, split, met)
    # What a context has seen behind longer ones that are not kept.
    rest = split - met
    own, own_one = log_kt(split[..., 0], split[..., 1]), (split[..., 1] + 0.5) / (split.sum(axis=2) + 1)
    rest_one = (rest[..., 1] + 0.5) / (rest.sum(axis=2) + 1)
    weighted, longer = own.copy(), log_kt(rest[..., 0], rest[..., 1])
    for d in range(len(levels) - 1, -1, -1):
        at = levels[d]
        if d < deepest:
            weighted[at] = np.log(0.5) + np.logaddexp(own[at], longer[at])
        if d:
            children.add(d, weighted, longer)
    stop = np.exp(np.log(0.5) + own - weighted)
    so_far, mass = np.zeros_like(own), np.ones_like(own)
    chance = np.empty_like(own)
    for d, at in enumerate(levels):
        if d:
            up = parent[at]
            so_far[at] = so_far[up] + mass[up] * stop[up] * own_one[up]
            mass[at] = mass[up] * (1 - stop[up])
        mixed = own_one[at] if d == deepest else stop[at] * own_one[at] + (1 - stop[at]) * rest_one[at]
        chance[at] = so_far[at] + mass[at] * mixed
    return chance


@dataclass
class ContextTree:
    """A tree in memory: contexts per depth (sorted, as numbers), their rows, and the code lengths.

    The plain form of what ``gram_costs`` does for all contexts, for trees of few contexts.
    """

    contexts: list[np.ndarray]
    first: list[int]
    bits: np.ndarray

    @classmethod
    def weighted(cls, depth: np.ndarray, context: np.ndarray, byte: np.ndarray, n: np.ndarray) -> ContextTree:
        """From counts of bytes behind kept contexts; with a context, all its shorter ones are kept."""
        contexts = [np.unique(context[depth == d]) for d in range(DEPTH + 1)]
        contexts[0] = np.zeros(1, np.int64)
        first = np.concatenate([[0], np.cumsum([len(c) for c in contexts])]).tolist()
        counts = np.zeros((first[-1], 256))
        parent = np.zeros(first[-1], np.int64)
        depths = np.zeros(first[-1], np.int64)
        for d in range(DEPTH + 1):
            own = depth == d
            counts[first[d] + np.searchsorted(contexts[d], context[own]), byte[own]] = n[own]
            if d:
                shorter = contexts[d] & ((1 << 8 * (d - 1)) - 1)
                parent[first[d] : first[d + 1]] = first[d - 1] + np.searchsorted(contexts[d - 1], shorter)
            depths[first[d] : first[d + 1]] = d
        return cls(contexts, first, code_lengths(counts, parent, depths))

    def costs(self, codes: np.ndarray) -> np.ndarray:
        """Bits for the last byte of each gram, behind its longest known context."""
        signed = codes.view(np.int64)
        node = np.zeros(len(codes), np.int64)
        for d in range(1, DEPTH + 1):
            known = self.contexts[d]
            if len(known):
                wanted = (signed >> 8) & ((1 << 8 * d) - 1)
                place = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
                node = np.where(known[place] == wanted, self.first[d] + place, node)
        return self.bits[node, signed & 255][:, None]


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def body_of(text: bytes | None) -> bytes:
    """The words with one space between them and the end, as the base score's tokens know no other white space."""
    return b" ".join(words_of(text)) + EDGE


def _counted(codes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, place = np.unique(codes, return_inverse=True)
    return distinct, np.bincount(place, n).astype(np.int64)


def corpus_counts(docs: DataFrame, learning) -> DataFrame:
    """Counts ``n`` over the ``learning`` texts: of every ``word``, and of every ``gram`` of ``DEPTH`` + 1 bytes in any text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter[bytes] = Counter()
        held = (np.zeros(0, np.uint64), np.zeros(0, np.int64))

        def out(codes, n, is_word):
            none = pa.nulls(len(n), pa.int64() if is_word else pa.binary())
            columns = [pa.array(codes, pa.binary()), none] if is_word else [none, pa.array(codes.view(np.int64))]
            return pa.RecordBatch.from_arrays([*columns, pa.array(n, pa.int64())], names=["word", "gram", "n"])

        for batch in slices(batches):
            bodies: dict[bool, list[bytes]] = {True: [], False: []}
            for text, learned in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = words_of(text)
                bodies[learned].append(b" ".join(own) + EDGE)
                if learned:
                    words.update(own)
                if len(words) > HELD_WORDS:
                    yield out(list(words), list(words.values()), True)
                    words.clear()
            for learned, own in bodies.items():
                for _, buffer, begins, ends in chunks(own, EDGE * DEPTH, 1 << 20):
                    codes = grams(buffer, DEPTH)
                    codes, times = np.unique(codes[inside(begins, ends, len(codes))], return_counts=True)
                    new = (codes, times * learned)
                    held = _counted(*(np.concatenate(pair) for pair in zip(held, new, strict=True)))
                    if len(held[0]) > HELD_GRAMS:
                        yield out(*held, False)
                        held = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        yield out(list(words), list(words.values()), True)
        yield out(*held, False)

    texts = docs.select(F.col("text").cast("binary"), F.coalesce(learning, F.lit(False)))
    parts = texts.mapInArrow(run, "word binary, gram bigint, n bigint")
    return parts.groupBy("word", "gram").agg(F.sum("n").alias("n"))


def least_count(counts: DataFrame, column: str, most: int) -> int:
    """The smallest power of two so that at most ``most`` rows have that count or more."""
    power = F.floor(F.log2(column)).cast("int")
    rows = counts.groupBy(power.alias("power")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("power")).collect()
    total, least = 0, 2**62
    for row in rows:
        total += row["n"]
        if total > most:
            break
        least = 2 ** row["power"]
    return least


class Level:
    """The decisions on one bit behind all contexts of one length.

    A decision's key is its context and the byte's bits before, as one number. ``up`` is its place behind the next
    shorter contexts, ``node`` the place of every code of this length and ``one`` the bit it goes on with.
    """

    def __init__(self, codes: np.ndarray, n: np.ndarray, bit: int):
        keys = codes >> np.uint64(8 - bit)
        new = np.diff(keys, prepend=keys[:1] ^ np.uint64(1)) != 0
        starts = np.flatnonzero(new)
        self.key, self.node = keys[starts], np.cumsum(new) - 1
        self.one = (codes >> np.uint64(7 - bit)) & np.uint64(1) > 0
        self.ones = np.add.reduceat(n * self.one, starts)
        self.zeros = np.add.reduceat(n, starts) - self.ones

    def weigh(self, longer: np.ndarray | None) -> np.ndarray:
        """Logarithm of the weighted probability, given that of all longer contexts together (None: there are none)."""
        self.own = log_kt(self.zeros, self.ones)
        self.weighted = self.own if longer is None else np.log(0.5) + np.logaddexp(self.own, longer)
        return self.weighted

    def own_one(self) -> np.ndarray:
        return (self.ones + 0.5) / (self.zeros + self.ones + 1)

    def passed(self, so_far: np.ndarray, mass: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What longer contexts start from: the chance of a one up to here, and the weight that is left."""
        stop = np.exp(np.log(0.5) + self.own - self.weighted)
        return so_far + mass * stop * self.own_one(), mass * (1 - stop)


def _shorter(keys: np.ndarray, depth: int, bit: int) -> np.ndarray:
    """The keys of decisions behind contexts cut to their last ``depth`` bytes."""
    return keys & np.uint64((1 << 8 * depth + bit) - 1)


def _weighed(grams: np.ndarray, n: np.ndarray):
    """For every bit: the levels from ``SPLIT`` to ``DEPTH``, weighted from the longest contexts on, and links to shorter ones."""
    codes = [_counted(grams & np.uint64((1 << 8 * (d + 1)) - 1), n) for d in range(SPLIT, DEPTH + 1)]
    for bit in range(8):
        levels = [Level(own, times.astype(np.float64), bit) for own, times in codes]
        ups = [
            np.searchsorted(levels[k].key, _shorter(levels[k + 1].key, SPLIT + k, bit)) for k in range(len(levels) - 1)
        ]
        longer = None
        for k in range(len(levels) - 1, -1, -1):
            weighted = levels[k].weigh(longer)
            if k:
                longer = np.bincount(ups[k - 1], weighted, len(levels[k - 1].key))
        yield bit, levels, ups


def _whole_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted grams and counts, with all grams of a context of ``SPLIT`` bytes together, about ``WEIGHED`` at once."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    for batch in batches:
        held.append((batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy()))
        size += batch.num_rows
        if size >= WEIGHED:
            grams, n = (np.concatenate(side) for side in zip(*held, strict=True))
            context = (grams >> np.uint64(8)) & np.uint64((1 << 8 * SPLIT) - 1)
            # Rows come context by context; the last one may go on.
            last = int(np.flatnonzero(context != context[-1])[-1]) + 1 if context[0] != context[-1] else 0
            if last:
                yield _counted(grams[:last], n[:last])
            held, size = [(grams[last:], n[last:])], len(grams) - last
    if size:
        yield _counted(*(np.concatenate(side) for side in zip(*held, strict=True)))


def _above(rows) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For every bit: keys behind the contexts of ``SPLIT`` - 1 bytes, and what they pass on to longer ones."""
    found = []
    for bit in range(8):
        part = rows[rows["bit"] == bit]
        order = np.argsort(part["key"].to_numpy())
        keys = part["key"].to_numpy()[order].astype(np.uint64)
        sums = [part[c].to_numpy()[order] for c in ("zeros", "ones", "longer")]
        levels, ups = [], []
        for depth in range(SPLIT - 1, -1, -1):
            level = Level.__new__(Level)
            level.key, (level.zeros, level.ones, longer) = keys, sums
            weighted = level.weigh(longer)
            levels.append(level)
            if depth:
                keys, up = np.unique(_shorter(keys, depth - 1, bit), return_inverse=True)
                ups.append(up)
                sums = [np.bincount(up, v, len(keys)) for v in (level.zeros, level.ones, weighted)]
        passed = levels[-1].passed(np.zeros(len(keys)), np.ones(len(keys)))
        for level, up in zip(levels[-2::-1], ups[::-1], strict=True):
            passed = level.passed(passed[0][up], passed[1][up])
        found.append((levels[0].key, *passed))
    return found


def gram_costs(gram_counts: DataFrame) -> DataFrame:
    """``gram``, ``n`` and the ``bits`` of its last byte behind all contexts of the bytes before, from counts of all grams."""

    def up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for grams, n in _whole_contexts(batches):
            for bit, levels, _ in _weighed(grams, n):
                top = levels[0]
                keys, at = np.unique(_shorter(top.key, SPLIT - 1, bit), return_inverse=True)
                sums = [pa.array(np.bincount(at, v, len(keys))) for v in (top.zeros, top.ones, top.weighted)]
                bits = pa.array(np.full(len(keys), bit, np.int32))
                yield pa.RecordBatch.from_arrays([bits, pa.array(keys.view(np.int64)), *sums], names=["bit", "key", "zeros", "ones", "longer"])

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for grams, n in _whole_contexts(batches):
            bits = np.zeros(len(grams))
            for bit, levels, ups in _weighed(grams, n):
                keys, so_far, mass = above.value[bit]
                at = np.searchsorted(keys, _shorter(levels[0].key, SPLIT - 1, bit))
                so_far, mass = so_far[at], mass[at]
                for level, place in zip(levels, ups, strict=False):
                    so_far, mass = (v[place] for v in level.passed(so_far, mass))
                last = levels[-1]
                one = (so_far + mass * last.own_one())[last.node]
                bits -= np.log2(np.where(last.one, one, 1 - one))
            yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(n), pa.array(bits)], names=["gram", "n", "bits"])

    context = F.shiftright("gram", 8).bitwiseAND((1 << 8 * SPLIT) - 1)
    dealt = gram_counts.select("gram", "n").repartition(context).sortWithinPartitions(context)
    sums = dealt.mapInArrow(up, "bit int, key bigint, zeros double, ones double, longer double").groupBy("bit", "key")
    # At most 256 contexts of one byte with 255 decisions each, whatever the input.
    rows = sums.agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "longer")]).toArrow().to_pandas()
    above = gram_counts.sparkSession.sparkContext.broadcast(_above(rows))
    return dealt.mapInArrow(down, "gram bigint, n bigint, bits double")


def scores(docs: DataFrame, learning, nodes: int = NODES, frequent: int = FREQUENT) -> DataFrame:
    """Per row: ``doc_id``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``, ``bits_per_byte``.

    ``learning`` is the condition of the rows to learn from. Texts are lower-cased (A-Z), and white space is one
    space between words; a null text is empty and costs its end. Without learning texts every byte costs eight bits and every word has
    count zero. Repeated rows are counted and returned each.
    """
    spark = docs.sparkSession
    counts = stage(corpus_counts(docs, learning), "ctw-counts")
    words = counts.where("word IS NOT NULL").select("word", "n")
    costs = stage(gram_costs(counts.where("gram IS NOT NULL")), "ctw-costs")
    learned = costs.where("n > 0")
    often = F.col("n") >= least_count(learned, "n", nodes)
    # At most `nodes` rows.
    near = learned.where(often).select("gram", F.col("bits").cast("float")).toArrow()
    known, bits = (near[c].to_numpy() for c in ("gram", "bits"))
    order = np.argsort(known)
    near = (known[order].view(np.uint64), bits[order])
    ends = docs.where(learning).count()
    tokens, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    tokens, distinct = tokens + ends, distinct + (ends > 0)
    least = least_count(words, "n", frequent)
    # At most `frequent` rows.
    table = words.where(F.col("n") >= least).select("word", F.log10(F.col("n") + 1)).toArrow()
    shared = spark.sparkContext.broadcast((near, dict(zip(*(c.to_pylist() for c in table.columns), strict=True))))
    ready: list[GramCosts] = []

    def run(texts: list[bytes | None]) -> dict[str, object]:
        (known, bits), logs = shared.value

        def near_costs(codes: np.ndarray) -> np.ndarray:
            if not len(known):
                return np.full((len(codes), 1), np.nan, np.float32)
            place = np.minimum(np.searchsorted(known, codes), len(known) - 1)
            return np.where(known[place] == codes, bits[place], np.float32(np.nan))[:, None]

        if not ready:
            ready.append(GramCosts(near_costs, DEPTH, 1))
        get = logs.__getitem__
        out: dict[str, list] = {k: [] for k in ("n_tokens", "known_sum", "n_frequent", "rare", "times")}
        for text in texts:
            own = words_of(text)
            rare = Counter(w for w in own if w not in logs)
            out["n_tokens"].append(len(own) + 1)
            out["known_sum"].append(sum(get(w) for w in own if w in logs))
            out["n_frequent"].append(len(own) - rare.total())
            out["rare"].append(list(rare))
            out["times"].append(list(rare.values()))
        bodies = list(map(body_of, texts))
        total, far = ready[0].sums_and_rest(bodies, EDGE * DEPTH)
        far = [np.unique(own, return_counts=True) for own in far]
        out["far"] = [codes.view(np.int64) for codes, _ in far]
        out["far_times"] = [times.astype(np.int32) for _, times in far]
        return {**out, "bits": total[:, 0], "n_bytes": list(map(len, bodies))}

    results = {"n_tokens": "bigint", "known_sum": "double", "n_frequent": "bigint", "rare": "array<binary>"}
    results |= {"times": "array<int>", "bits": "double", "n_bytes": "bigint"}
    results |= {"far": "array<bigint>", "far_times": "array<int>"}
    found = stage(
        map_texts(docs, ["doc_id"], run, results).withColumn("row", F.monotonically_increasing_id()), "ctw-texts"
    )
    rare = found.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", "x.rare", "x.times")
    met = (
        rare.join(words.where(F.col("n") < least), rare["rare"] == words["word"])
        .groupBy("row")
        .agg(F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("rare_sum"), F.sum("times").alias("n_rare"))
    )
    far = found.select("row", F.explode(F.arrays_zip("far", "far_times")).alias("x")).select("row", "x.far", "x.far_times")
    rest = (
        far.join(costs.where(~often), far["far"] == costs["gram"])
        .groupBy("row")
        .agg(F.sum(F.col("far_times") * F.col("bits")).alias("rest_bits"))
    )
    whole = float(np.log10(tokens + distinct + 1))
    bits = F.col("bits") + F.coalesce("rest_bits", F.lit(0.0))
    logs = F.col("known_sum") + F.coalesce("rare_sum", F.lit(0.0)) + F.lit(float(np.log10(ends + 1)))
    return found.join(met, "row", "left").join(rest, "row", "left").select(
        "doc.doc_id",
        "n_tokens",
        (F.col("n_frequent") + F.coalesce("n_rare", F.lit(0)) + F.lit(int(ends > 0))).alias("n_known"),
        F.lit(tokens).cast("bigint").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.lit(whole)).alias("base_score"),
        (bits * F.lit(-float(np.log10(2)))).alias("score"),
        (bits / F.col("n_bytes")).alias("bits_per_byte"),
    )
