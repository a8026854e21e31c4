"""Shards and sequences against brute force and the tokenizer library."""

from __future__ import annotations

import itertools
import math
import random
from bisect import bisect_left, insort

import numpy as np
import pytest
from conftest import docs
from hypothesis import given, settings
from hypothesis import strategies as st

from loanweave.llm import bfd_shards as B
from loanweave.llm import bin_slack as P
from loanweave.llm.bpe_words import WordIds
from loanweave.llm.queries import tokenizer_path

SIZES = st.lists(st.integers(1, 60), min_size=1, max_size=80)


@given(SIZES, st.integers(60, 120))
@settings(max_examples=100, deadline=None)
def test_runs_are_best_fit_one_by_one(sizes, capacity):
    runs, opened = B.best_fit(sorted(((s, sizes.count(s)) for s in set(sizes)), reverse=True), capacity)
    rooms: list[tuple[int, int]] = []
    bins = 0
    plain = []
    for size in sorted(sizes, reverse=True):
        k = bisect_left(rooms, (size, -1))
        room, shard = rooms.pop(k) if k < len(rooms) else (capacity, bins)
        bins += shard == bins
        plain.append((size, shard))
        insort(rooms, (room - size, shard))
    assert opened == bins
    assert sorted((size, shard) for size, _, n, shard in runs for _ in range(n)) == sorted(plain)
    assert [first for _, first, _, _ in runs] == list(itertools.accumulate((n for _, _, n, _ in runs), initial=0))[:-1]


def test_tree_stays_balanced():
    tree, rng, keys = B.OpenShards(), random.Random(1), set()
    for i in range(3000):
        key = (rng.randrange(500), i)
        tree.add(*key)
        keys.add(key)
        if i % 3 == 0:
            gone = rng.choice(sorted(keys)) if i < 300 else key
            tree.remove(gone)
            keys.discard(gone)
        if i % 500 == 0:
            wanted = rng.randrange(500)
            assert tree.tightest(wanted) == min((k for k in keys if k[0] >= wanted), default=None)
    assert tree.root.height <= 1.45 * math.log2(len(keys) + 2)


@pytest.mark.parametrize("capacity", [None, 300])
def test_shards_keep_groups_whole_and_slots_gapless(spark, capacity):
    rng = random.Random(2)
    texts = ["x" * rng.randrange(60) + str(rng.randrange(40)) for _ in range(150)] + ["hot text"] * 50 + [None, ""]
    rows = B.shard(docs(spark, texts), 4, capacity).collect()
    assert len(rows) == len(texts)
    places = {}
    for r in rows:
        places.setdefault(texts[r.doc_id] or "", set()).add(r.shard)
    assert all(len(p) == 1 for p in places.values())
    for shard in {r.shard for r in rows}:
        own = [r for r in rows if r.shard == shard]
        assert sorted(r.slot for r in own) == list(range(len(own)))
        assert capacity is None or sum(r.size for r in own) <= max(capacity, 50 * 9)
    totals = [sum(r.size for r in rows if r.shard == s) for s in range(4)]
    assert capacity or max(totals) - min(totals) <= 1 + max(len(t or "") + 1 for t in texts)


@given(st.lists(st.integers(1, 40), min_size=1, max_size=9))
@settings(max_examples=100, deadline=None)
def test_fullest_combination(lengths):
    counts = {n: lengths.count(n) for n in lengths}
    used = P.fullest(counts, 40)
    best = max(
        sum(c) for k in range(len(lengths) + 1) for c in itertools.combinations(sorted(lengths), k) if max(lengths) in c and sum(c) <= 40
    )
    assert used[max(lengths)] >= 1 and all(n <= counts[k] for k, n in used.items())
    assert sum(k * n for k, n in used.items()) == best


@given(st.lists(st.integers(1, 64), min_size=1, max_size=200))
@settings(max_examples=60, deadline=None)
def test_packing_places_every_piece_once(lengths):
    runs = P.packing_runs({n: lengths.count(n) for n in lengths}, 64)
    bins: dict[int, list] = {}
    for length, _, pieces, per_bin, first, at in runs:
        for k in range(pieces):
            bins.setdefault(first + k // per_bin, []).append((at + k % per_bin * length, length))
    assert sorted(n for b in bins.values() for _, n in b) == sorted(lengths)
    for parts in bins.values():
        ends = [0, *itertools.accumulate(n for _, n in sorted(parts))]
        assert [at for at, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 64
    rooms: list[int] = []
    for n in sorted(lengths, reverse=True):
        k = next((i for i, room in enumerate(rooms) if room >= n), None)
        if k is None:
            rooms.append(64 - n)
        else:
            rooms[k] -= n
    # Never much worse than first-fit decreasing.
    assert len(bins) <= len(rooms) + 1


ODD = st.sampled_from([" ", "\n", "'s", "don't", "É", "ß", "é", "İ", "Σ", "—", "<|endoftext|>", "<|ENDOFTEXT|>", "12", "½", "日本", "\x1c", "\x85", " "])
TEXT = st.lists(st.one_of(ODD, st.text(st.characters(max_codepoint=0x17F, exclude_categories=["Cs"]), max_size=8)), max_size=12)
OURS = WordIds(tokenizer_path())


@given(TEXT)
@settings(max_examples=300, deadline=None)
def test_ids_are_those_of_the_library(parts):
    text = "".join(parts)
    assert np.frombuffer(OURS.ids([text.encode()])[0], "<u4").tolist() == OURS.library.encode(text, add_special_tokens=False).ids


def test_sequences_round_trip(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choices(["alpha", "beta", "Straße", "x1"], k=rng.randrange(90))) for _ in range(60)] + [None]
    pieces = P.token_pieces(docs(spark, texts), ["doc_id"], tokenizer_path(), 64).select("doc.doc_id", "piece", "start", "length", "ids")
    packed = P.pack(pieces, 64)
    rows = packed.collect()
    whole = {r.sequence_id: bytes(r.ids) for r in P.sequences(packed).collect()}
    got: dict[int, bytes] = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.piece)):
        part = whole[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)]
        assert r.start == len(got.get(r.doc_id, b"")) // 4
        got[r.doc_id] = got.get(r.doc_id, b"") + part
    for i, text in enumerate(texts):
        ids = OURS.library.encode(text or "", add_special_tokens=False).ids + [0]
        assert np.frombuffer(got[i], "<u4").tolist() == ids
    assert max(map(len, whole.values())) <= 64 * 4


def test_a_piece_is_merged_once_and_odd_words_are_the_librarys(monkeypatch):
    words, merged = WordIds(tokenizer_path()), []
    merge_all = WordIds.merge_all
    monkeypatch.setattr(WordIds, "merge_all", lambda own, pieces: merged.extend(pieces) or merge_all(own, pieces))
    odd = ["", " \n", "river, a×b ÷ ÿ ß", "\x1c a\x1d\x00", "don't", "x" * 49, "ÀÉ÷ÖØ 1,000", "İ 中", "<|endoftext|> River"]
    for texts in (["river stone"], ["river. (stone) river!"], odd, [""], []):
        expected = [np.array(words.library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
        assert words.ids([t.encode() for t in texts]) == expected
    assert len(merged) == len(set(merged)) and {b"river", b"stone"} <= set(merged)
