"""Bytes that repeat: every string of ``LENGTH`` bytes that also starts elsewhere, found by sorted suffixes.

The suffixes of a collection of texts are sorted column by column: one round inserts, for every text, the suffix that is
one symbol longer than the one before. The place of a new suffix follows from the rank of its first symbol in the
Burrows-Wheeler transform so far, and the length of the prefix it shares with its neighbours from the least shared prefix
between two equal symbols. Transform and shared prefixes are sequences that a round reads once from front to
back and writes anew with the new symbols in between. At the end a string of ``LENGTH`` bytes repeats if its suffix
shares that many bytes with a neighbour.

One collection of all texts would need a round per byte of the longest text and one place for all suffixes. So Spark deals
it out. Each string of ``LENGTH`` bytes is led by its smallest k-mer, its anchor, and neighbouring strings with one
anchor form a segment; equal strings have equal anchors, so they are in segments with the same key. Segments of one
key go to one task, a quarter of a million bytes at a time, and are the texts of its collection: at most ``LENGTH + STARTS - 1``
rounds. The sequences of a round are held in memory, as they are bounded and a machine's own folders may be lost with it.

Keys that occur once cannot repeat and drop out first. Equal segments are counted before anything is moved and enter as one,
so copies cost no more than one text; they repeat as a whole. A key with more than ``CLASSES`` different segments
is split by longer anchors: strings with at least half of the other bytes to the left of the anchor, and the rest, each
with an anchor grown to that side. An anchor of ``LENGTH`` bytes has one segment, so eight splits end it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanweave.session import stage

from .common import packed, quoted, slices

LENGTH = 200
#: Bytes of an anchor, and places of it in a string.
ANCHOR = 48
STARTS = LENGTH - ANCHOR + 1
#: Different segments of a key up to which they are sorted together, and bytes that a task sorts at once.
CLASSES = 16_384
COLLECTION = 1 << 18
#: Places below which one of them and a symbol (nine bits) are a number of 32 bits.
NARROW = 1 << 23
#: Bytes whose anchors are looked for at once.
CHUNK = 1 << 16

BASE = np.uint64(0x100000001B3)
MOST = 2 * CHUNK + 2 * LENGTH
POWERS = np.cumprod(np.full(MOST, BASE))
INVERSES = np.cumprod(np.full(MOST, np.uint64(pow(int(BASE), -1, 1 << 64))))
LOW = np.uint64((1 << MOST.bit_length()) - 1)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


#: A number for each byte.
SYMBOLS = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def window_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours, from least values of blocks up to and from a place on."""
    n = len(values) - width + 1
    blocks = np.concatenate([values, np.full(-len(values) % width, np.iinfo(np.uint64).max)]).reshape(-1, width)
    up_to = np.minimum.accumulate(blocks, axis=1).ravel()
    from_on = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(from_on[:n], up_to[width - 1 : width - 1 + n])


def pieces(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts joined to buffers of about ``CHUNK`` bytes: owners, places in their texts, lengths, bytes.

    Long texts come in parts that overlap by ``LENGTH - 1`` bytes, so each string is in one part.
    """
    owners: list[int] = []
    places: list[int] = []
    parts: list[bytes] = []
    held = 0
    for k, text in enumerate(texts):
        for at in range(0, len(text) - LENGTH + 1, CHUNK):
            part = text[at : at + CHUNK + LENGTH - 1]
            owners.append(k)
            places.append(at)
            parts.append(part)
            held += len(part)
            if held >= CHUNK:
                yield np.array(owners), np.array(places), np.array([len(p) for p in parts]), np.frombuffer(b"".join(parts), np.uint8)
                owners, places, parts, held = [], [], [], 0
    if parts:
        yield np.array(owners), np.array(places), np.array([len(p) for p in parts]), np.frombuffer(b"".join(parts), np.uint8)


def segments(texts: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
    """Owner, key, class, first byte, place of the anchor and number of strings of every segment."""
    for owners, places, lengths, raw in pieces(texts):
        n = len(raw)
        ends = np.cumsum(lengths)
        with np.errstate(over="ignore"):
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(SYMBOLS[raw] * POWERS[:n])])
            codes = _mixed((sums[ANCHOR:] - sums[: n - ANCHOR + 1]) * INVERSES[: n - ANCHOR + 1])
            # Of equal k-mers the first one is the anchor.
            tagged = (codes & ~LOW) | np.arange(len(codes), dtype=np.uint64)
            anchor = (window_least(tagged, STARTS) & LOW).astype(np.int64)
            part = np.repeat(np.arange(len(lengths)), lengths)[: n - LENGTH + 1]
            start = np.flatnonzero(ends[part] - np.arange(n - LENGTH + 1) >= LENGTH)
            part, anchor = part[start], anchor[start]
            new = np.flatnonzero(np.diff(anchor, prepend=-1))
            count = np.diff(new, append=len(start))
            start, part, anchor = start[new], part[new], anchor[new]
            shape = ((anchor - start) << 8 | count).astype(np.uint64)
            digest = (sums[start + count - 1 + LENGTH] - sums[start]) * INVERSES[start]
            digest = _mixed(_mixed(digest) + shape * np.uint64(0x9E3779B97F4A7C15))
        yield owners[part], codes[anchor], digest, start - (ends - lengths)[part] + places[part], anchor - start, count


def repeated_starts(strings: list[bytes], least: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """String and place of each suffix that shares ``least`` bytes or more with another one of the collection.

    ``bwt`` is the transform ordered by symbol: symbol (upper bits) and place in the order of suffixes (lower bits), so the
    rank of a symbol is its index. ``shared`` are the bytes that each suffix shares with the one before, ``least`` at most.
    """
    m = len(strings)
    lengths = np.array([len(s) for s in strings], np.int64)
    raw = np.frombuffer(b"".join(strings), np.uint8).astype(np.int64)
    ends = np.cumsum(lengths)
    # Two halves to write to in turn, and room for the shifts of a round.
    size = m + len(raw) + 1
    kind, bits = (np.uint32, 23) if size < NARROW else (np.int64, 32)
    low = kind((1 << bits) - 1)
    halves = [np.empty(size, kind) for _ in range(2)]
    shared_halves = [np.zeros(size, np.uint8 if least < 256 else np.uint16) for _ in range(2)]
    place_of, shift, old = np.empty(size, np.int64), np.empty(size, kind), np.empty(size, bool)
    # Round 0: the empty suffixes in the order of their strings, as all ends differ. Symbol 0 stands for the end.
    string = np.arange(m)
    keys = _symbols(raw, ends, lengths, string, 0) << bits | np.arange(m)
    index = np.argsort(keys)
    bwt, shared = halves[0][:m], shared_halves[0][:m]
    bwt[:] = keys[index]
    rank = np.empty(m, np.int64)
    rank[index] = np.arange(m)
    for step in range(1, int(lengths.max(initial=0)) + 1):
        going = lengths[string] >= step
        string, rank = string[going], rank[going]
        n, live = len(bwt), len(string)
        now = (bwt[rank] & low).astype(np.int64)
        # Before a suffix come all empty ones and those of smaller symbols or of the same one further up; ends are no symbols.
        new = m + rank - (m - live)
        order = np.argsort(new)
        string, rank, now, new = string[order], rank[order], now[order], new[order]
        with_before, with_behind = _shared_with_neighbours(bwt, bits, shared_halves[(step + 1) % 2], rank, now, least)
        # Places move on by the new suffixes before them.
        moved = np.repeat(np.arange(live + 1, dtype=kind), np.diff(new - np.arange(live), prepend=0, append=n + 1))
        np.bitwise_and(bwt, low, out=place_of[:n])
        np.take(moved, place_of[:n], out=shift[:n], mode="clip")
        bwt += shift[:n]
        keys = (_symbols(raw, ends, lengths, string, step) << bits | new).astype(kind)
        order = np.argsort(keys)
        rank = np.empty(live, np.int64)
        rank[order] = np.searchsorted(bwt, keys[order]) + np.arange(live)
        grown, grown_shared = halves[step % 2][: n + live], shared_halves[step % 2][: n + live]
        _inserted(grown, bwt, rank, keys, old)
        _inserted(grown_shared, shared, new, with_before, old)
        known = with_behind > 0
        grown_shared[new[known] + 1] = with_behind[known]
        bwt, shared = grown, grown_shared
    return _walked(bwt & low, shared, lengths, least)


def _symbols(raw, ends, lengths, string, step: int) -> np.ndarray:
    """The symbol before each string's suffix of ``step`` bytes, plus 1; 0 before the whole string."""
    return np.where(lengths[string] > step, raw[np.maximum(ends[string] - 1 - step, 0)] + 1, 0)


def _inserted(grown: np.ndarray, before: np.ndarray, places: np.ndarray, values: np.ndarray, old: np.ndarray) -> None:
    stay = old[: len(grown)]
    stay[:] = True
    stay[places] = False
    grown[stay] = before
    grown[places] = values


def _shared_with_neighbours(bwt, bits, shared, rank, now, least) -> tuple[np.ndarray, np.ndarray]:
    """Bytes that a new suffix shares with the one before and the one behind it, 0 where that has another first symbol.

    These are one more than the suffixes without the first symbol share: the least of all between the two. ``now`` rises;
    from the last to the first, so that no sum is taken from one pair to the next one.
    """
    out = []
    own = bwt[rank] >> bits
    for side in (-1, 1):
        near = bwt[np.clip(rank + side, 0, len(bwt) - 1)].astype(np.int64)
        place = near & ((1 << bits) - 1)
        same = np.flatnonzero((near >> bits == own) & (place != now))[::-1]
        found = np.zeros(len(rank), shared.dtype)
        if len(same):
            edges = np.empty(2 * len(same), np.int64)
            pair = (place[same], now[same])
            edges[0::2], edges[1::2] = np.minimum(*pair) + 1, np.maximum(*pair) + 1
            found[same] = np.minimum(np.minimum.reduceat(shared[: len(bwt) + 1], edges)[::2], least - 1) + 1
        out.append(found)
    return out[0], out[1]


def _walked(places, shared, lengths, least: int) -> tuple[np.ndarray, np.ndarray]:
    """From the empty suffixes to the longest ones along the transform, those that repeat."""
    m = len(lengths)
    repeats = shared >= least
    repeats[:-1] |= repeats[1:].copy()
    # Where the suffix with one more symbol is; there are as many ends as empty suffixes.
    longer = np.empty(len(places), np.int64)
    longer[places] = np.arange(len(places))
    string, place = np.arange(m), np.arange(m)
    owners, starts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for step in range(1, int(lengths.max(initial=0)) + 1):
        going = lengths[string] >= step
        string, place = string[going], longer[place[going]]
        found = string[repeats[place]]
        owners.append(found)
        starts.append(lengths[found] - step)
    return np.concatenate(owners), np.concatenate(starts)


def _runs(owners: np.ndarray, starts: np.ndarray, n: int) -> list[list[int]]:
    """For each of ``n`` strings the first and last places of neighbouring starts."""
    order = np.lexsort((starts, owners))
    owners, starts = owners[order], starts[order]
    new = (np.diff(owners, prepend=-1) != 0) | (np.diff(starts, prepend=-2) != 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts))[: len(first)] - 1
    out: list[list[int]] = [[] for _ in range(n)]
    for owner, a, b in zip(owners[first].tolist(), starts[first].tolist(), starts[last].tolist(), strict=True):
        out[owner] += [a, b]
    return out


def _sorted_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of repeating starts of segments (key, class, bytes), which come ordered by key."""
    held: list[tuple[int, int, bytes]] = []
    size = 0
    for batch in slices(batches):
        for row in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            if size >= COLLECTION and row[0] != held[-1][0]:
                yield _repeating(held)
                held, size = [], 0
            held.append(row)
            size += len(row[2])
    if held:
        yield _repeating(held)


def _repeating(held: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    # A row may come twice if a text and its id do.
    held = [row for row, before in zip(held, [None, *held], strict=False) if row != before]
    runs = _runs(*repeated_starts([row[2] for row in held]), len(held))
    rows = [(key, of, run) for (key, of, _), run in zip(held, runs, strict=True) if run]
    columns = list(zip(*rows, strict=True)) or [[], [], []]
    types = (pa.int64(), pa.int64(), pa.list_(pa.int32()))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["key", "class", "runs"])


def _by_keys(sized: DataFrame, hot: bool, classes: int) -> DataFrame:
    """``key``, ``class`` and ``runs`` of segments (``key, class, weight, at, core, bytes, n``) that share strings with others.

    ``n`` is the number of segments of the key, at least 2, and ``hot`` tells if any is above ``classes``.
    """
    together = sized.where(F.col("n") <= classes).select("key", "class", "bytes")
    found = stage(
        together.repartition("key").sortWithinPartitions("key", "class").mapInArrow(_sorted_together, "key bigint, class bigint, runs array<int>"),
        "repeats",
    )
    if not hot:
        return found
    rest = F.lit(LENGTH) - F.col("core")
    reach = F.ceil(rest / 2).cast("int")
    last = F.octet_length("bytes") - LENGTH
    # First and last string of either half, the side its anchor grows to, and the anchor.
    left = F.struct(
        F.lit(0).alias("from"), F.least(F.col("at") - reach, last).alias("to"), (F.col("at") - reach).alias("at"), (F.col("core") + reach).alias("core")
    )
    right = F.struct(
        F.greatest(F.lit(0), F.col("at") - reach + 1).alias("from"), last.alias("to"), F.col("at"), (F.col("core") + rest - reach + 1).alias("core")
    )
    half = F.explode(F.filter(F.array(left, right), lambda h: h["from"] <= h["to"])).alias("half")
    parts = sized.where(F.col("n") > classes).select(F.col("key").alias("of_key"), F.col("class").alias("of_class"), "weight", "bytes", half)
    parts = parts.select(
        "of_key",
        "of_class",
        "weight",
        F.col("half.from").alias("from"),
        (F.col("half.at") - F.col("half.from")).alias("at"),
        "half.core",
        F.xxhash64(F.col("half.core"), F.substring("bytes", F.col("half.at") + 1, F.col("half.core"))).alias("key"),
        F.substring("bytes", F.col("half.from") + 1, F.col("half.to") - F.col("half.from") + LENGTH).alias("bytes"),
    ).withColumn("class", F.xxhash64("at", "bytes"))
    parts = stage(parts, "repeat-parts")
    merged = parts.groupBy("key", "class").agg(
        F.sum("weight").alias("weight"), F.first("at").alias("at"), F.first("core").alias("core"), F.first("bytes").alias("bytes")
    )
    merged = stage(merged, "repeat-halves")
    sizes = stage(merged.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "repeat-sizes")
    whole = merged.where("weight > 1").select("key", "class", F.array(F.lit(0), F.octet_length("bytes") - LENGTH).alias("runs"))
    deeper = _by_keys(merged.join(sizes, "key"), not sizes.where(F.col("n") > classes).isEmpty(), classes)
    runs = whole.unionByName(deeper.join(whole.select("key", "class"), ["key", "class"], "left_anti"))
    moved = parts.select("key", "class", "of_key", "of_class", "from").join(runs, ["key", "class"])
    back = moved.groupBy(F.col("of_key").alias("key"), F.col("of_class").alias("class")).agg(
        F.flatten(F.collect_list(F.transform("runs", lambda x: x + F.col("from")))).alias("runs")
    )
    return found.unionByName(stage(back, "repeats"))


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        for found in segments(batch.column(0).to_pylist()):
            yield pa.RecordBatch.from_arrays([pa.array(found[1].view(np.int64))], names=["key"])


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        rows, more = (batch.column(k).to_numpy() for k in (1, 2))
        for owner, key, of, start, at, count in segments(batch.column(0).to_pylist()):
            place = start << 32 | more[owner] << 16 | at << 8 | count
            arrays = [key.view(np.int64), of.view(np.int64), rows[owner], place]
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()) for a in arrays], names=["key", "class", "row", "place"])


def without_repeats(docs: DataFrame, keep: Sequence[str], id_col: str = "doc_id", text_col: str = "text", classes: int = CLASSES) -> DataFrame:
    """``doc`` (struct of the columns ``keep``), ``n_bytes``, ``spans`` and ``kept``, one row for each row of ``docs``.

    ``spans`` holds begin and end of each longest run of bytes that are covered by a string of ``LENGTH`` bytes which also
    starts elsewhere, in the same text or another one, in turn; ``kept`` are the other bytes. Null texts are empty.
    Rows are told apart by 80 bits of hashes of text and id; rows that agree in both are occurrences of their own
    and have the same result. Segments of one key are taken as equal if 64 bits of their hash and their shape agree;
    all else is compared by bytes. ``docs`` is read four times, so it should be stored.
    """
    text = F.coalesce(F.col(quoted(text_col)).cast("binary"), F.lit(b""))
    name = F.col(quoted(id_col)).cast("string")
    source = docs.select(
        packed(docs, keep),
        text.alias("text"),
        F.xxhash64(text, name).alias("row"),
        F.pmod(F.xxhash64(F.lit(1), name, text), F.lit(1 << 16)).alias("more"),
    )
    long = source.where(F.octet_length("text") >= LENGTH)
    keys = long.select("text").mapInArrow(_keys, "key bigint")
    shared = stage(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "anchors")
    columns = "key bigint, class bigint, row bigint, place bigint"
    members = stage(long.select("text", "row", "more").mapInArrow(_members, columns).join(shared, "key"), "segments")
    one = members.groupBy("key", "class").agg(F.count(F.lit(1)).alias("weight"), F.min(F.struct("row", "place")).alias("one"))
    one = stage(one.select("key", "class", "weight", "one.*"), "segment-classes")
    sizes = stage(one.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "segment-sizes")
    place = F.col("place")
    start, more = F.shiftright(place, 32), F.shiftright(place, 16).bitwiseAND(0xFFFF)
    at, count = F.shiftright(place, 8).bitwiseAND(0xFF), place.bitwiseAND(0xFF)
    several = one.join(sizes, "key").withColumn("more", more).join(long.select("row", "more", "text"), ["row", "more"])
    several = several.select(
        "key",
        "class",
        "weight",
        at.cast("int").alias("at"),
        F.lit(ANCHOR).alias("core"),
        F.substring("text", (start + 1).cast("int"), (count + LENGTH - 1).cast("int")).alias("bytes"),
        "n",
    )
    hot = not sizes.where(F.col("n") > classes).isEmpty()
    found = _by_keys(stage(several, "hot-segments") if hot else several, hot, classes)
    copies = one.where("weight > 1").select("key", "class", F.lit(None).cast("array<int>").alias("runs"))
    marked = copies.unionByName(found.join(copies.select("key", "class"), ["key", "class"], "left_anti"))
    marked = stage(marked, "repeated-segments")
    begin, end = start, start + count - 1 + LENGTH
    runs = F.transform(
        F.sequence(F.lit(0), F.size("runs") - 2, F.lit(2)),
        lambda k: F.struct((begin + F.get("runs", k)).alias("from"), (begin + F.get("runs", k + 1) + LENGTH).alias("to")),
    )
    spans = F.when(F.col("runs").isNull(), F.array(F.struct(begin.alias("from"), end.alias("to")))).otherwise(runs)
    ranges = members.join(marked, ["key", "class"]).select("row", more.alias("more"), F.explode(spans).alias("span"))
    ranges = ranges.groupBy("row", "more").agg(F.collect_set("span").alias("ranges"))
    cut = source.join(ranges, ["row", "more"], "left").select("doc", "text", F.col("ranges.from").alias("froms"), F.col("ranges.to").alias("tos"))
    kinds = {"n_bytes": "bigint", "spans": "array<bigint>", "kept": "binary"}
    schema = cut.select("doc", *[F.lit(None).cast(kind).alias(c) for c, kind in kinds.items()]).schema
    return cut.mapInArrow(_cut, schema)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts, froms, tos = (batch.column(k).to_pylist() for k in (1, 2, 3))
        spans, kept = [], []
        for text, a, b in zip(texts, froms, tos, strict=True):
            own: list[int] = []
            for begin, end in sorted(zip(a or (), b or (), strict=True)):
                if own and begin <= own[-1]:
                    own[-1] = max(own[-1], end)
                else:
                    own += [begin, end]
            edges = [0, *own, len(text)]
            spans.append(own)
            kept.append(b"".join(text[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True)))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array(spans, pa.list_(pa.int64())),
                pa.array(kept, pa.binary()),
            ],
            names=["doc", "n_bytes", "spans", "kept"],
        )
