"""Benchmark passages, near-duplicate groups and block tables against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
from conftest import WORDS, docs
from hypothesis import given, settings
from hypothesis import strategies as st

from loanweave.llm import simhash_groups as G
from loanweave.llm import simhash_tables as S
from loanweave.llm import wu_manber as W


@given(st.lists(st.lists(st.sampled_from("abc"), min_size=1, max_size=5), min_size=1, max_size=6), st.text("abc", max_size=60))
@settings(max_examples=150, deadline=None)
def test_wu_manber_finds_what_comparison_finds(patterns, text):
    words = [w.encode() for w in text]
    table = {tuple(w.encode() for w in p): {"".join(p)} for p in patterns}
    found = sorted((a, b, min(items)) for a, b, items in W.WuManber(table).find(words))
    plain = sorted(
        (i, i + len(p), b"".join(p).decode()) for p in table for i in range(len(words)) if tuple(words[i : i + len(p)]) == p
    )
    assert found == plain


def test_benchmark_in_blocks_changes_nothing(spark):
    rng = random.Random(1)
    items = [" ".join(rng.choices(WORDS, k=rng.choice([3, 13, 20]))) for _ in range(30)]
    texts = [" ".join([*rng.choices(WORDS, k=20), items[i % 30], "end"]) if i % 3 else "clean words here" for i in range(60)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    rows = [
        sorted(map(tuple, W.benchmark_passages(docs(spark, texts), bench, ["doc_id"], block_bytes=size).select("doc.doc_id", "n_words", "spans", "items").collect()))
        for size in (10**6, 300)
    ]
    assert rows[0] == rows[1]
    assert all(str(d % 30) in items for d, _, _, items in rows[0] if d % 3)
    assert all(not items for d, _, _, items in rows[0] if d % 3 == 0)


def test_search_of_a_benchmark_holds_few_bytes_each():
    rng = random.Random(6)
    words = [f"{rng.choice(WORDS)}{k}" for k in range(4000)]
    items = [(f"i{k}", " ".join(rng.choices(words, k=400)).encode()) for k in range(6000)]
    items += [(f"copy{k}", items[0][1]) for k in range(500)]
    size = sum(len(text) for _, text in items)
    assert size > 15_000_000
    (search,) = W.searches(items)
    assert search.nbytes < 10 * size
    text = W.words_of(b"before " + items[77][1][:900])
    found = list(search.find(text))
    # The last word is cut.
    assert [a for a, _, _ in found] == list(range(1, len(text) - 13)) and all(b - a == 13 and i == {"i77"} for a, b, i in found)
    (hit,) = search.find(W.words_of(items[0][1])[20:33])
    assert hit[2] == {"i0", *(f"copy{k}" for k in range(500))}


@pytest.mark.parametrize("size", [W.PART - 1, W.PART, W.PART + 1, 3 * W.PART])
def test_words_of_any_length_are_told_apart(size):
    long = b"x" * size
    search = W.WuManber({(b"a", long, b"b"): {"one"}, (b"a", long + b"y", b"b"): {"two"}})
    text = [b"c", b"a", long, b"b", b"a", long + b"y", b"b", b"a", long + b"z", b"b"]
    assert list(search.find(text)) == [(1, 4, {"one"}), (4, 7, {"two"})]
    assert W.spaced(long + b"..,\n" + b"A") == long.lower() + b" a " and W.spaced(b" .\n") == W.spaced(None) == b""


def test_passages_do_not_cross_texts(spark):
    bench = spark.createDataFrame([("a", "one two three"), ("b", " ".join(WORDS[:13]))], "item_id string, text string")
    texts = ["one two", "three one two three", " ".join(WORDS[:7]), " ".join(WORDS[7:13]), "", None, "One, TWO; three!"]
    for size in (10**6, 1):
        found = W.benchmark_passages(docs(spark, texts).coalesce(1), bench, ["doc_id"], block_bytes=size).collect()
        rows = {r.doc.doc_id: (r.n_words, list(r.spans), list(r["items"])) for r in found}
        assert rows == {0: (2, [], []), 1: (4, [1, 4], ["a"]), 2: (7, [], []), 3: (6, [], []), 4: (0, [], []), 5: (0, [], []), 6: (3, [0, 3], ["a"])}


def test_gray_rank():
    codes = np.arange(256, dtype=np.uint64)
    gray = codes ^ (codes >> np.uint64(1))
    assert (G.gray_rank(gray) == codes).all()


def groups_of(codes, near):
    parent = list(range(len(codes)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(codes)):
        for j in range(i):
            if near(i, j):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(codes))]


@pytest.mark.parametrize("seed", range(3))
def test_forest_is_that_of_all_pairs(seed):
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 2**63, 12, dtype=np.uint64)
    fp = np.array([c ^ np.uint64(sum(1 << int(b) for b in rng.integers(0, 64, rng.integers(0, 6)))) for c in centres for _ in range(25)])
    group = np.sort(rng.integers(0, 3, len(fp)))
    order = np.lexsort((G.gray_rank(fp), group))
    fp, group = fp[order], group[order]
    expected = groups_of(fp, lambda i, j: group[i] == group[j] and int(fp[i] ^ fp[j]).bit_count() <= 4)
    assert G.forest(fp, group, 4).tolist() == expected


def near_codes(rng, count, bits, most):
    centres = [rng.getrandbits(bits) for _ in range(count // 8)]
    return sorted({rng.choice(centres) ^ sum(1 << b for b in rng.sample(range(bits), rng.randrange(most))) for _ in range(count)})


@pytest.mark.parametrize("part_rows", [4, 1000])
def test_links_join_what_all_pairs_join(spark, part_rows):
    codes = near_codes(random.Random(5), 160, 64, 7)
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    frame = spark.createDataFrame([(c,) for c in signed], "fp bigint")
    links = G.hamming_links(frame, 4, part_rows).collect()
    place = {c: i for i, c in enumerate(signed)}
    tied = {frozenset((place[r.a], place[r.b])) for r in links}
    near = lambda i, j: (codes[i] ^ codes[j]).bit_count() <= 4
    assert groups_of(codes, lambda i, j: frozenset((i, j)) in tied) == groups_of(codes, near)
    roots = {r.node: r.root for r in G.components(frame.sparkSession.createDataFrame(links), "t").collect()}
    expected = groups_of(codes, near)
    assert all(place[roots[c]] == min((g for g in range(len(codes)) if expected[g] == expected[i]), key=lambda k: signed[k]) for i, c in enumerate(signed) if c in roots)


def test_one_document_of_each_group_stays(spark):
    rng = random.Random(3)
    base = " ".join(rng.choices(WORDS, k=400))
    texts = [base, "something else entirely", base, base + " tail", None, ""]
    kept = sorted((r.doc_id, r.text) for r in G.keep_one(docs(spark, texts)).collect())
    assert [d for d, _ in kept] == [0, 1, 4]


@pytest.mark.parametrize("part_rows", [4, 1000])
def test_block_tables_count_every_near_pair_once(spark, part_rows):
    codes = near_codes(random.Random(8), 150, 128, 9)
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    rows = [((signed(c >> 64), signed(c & (1 << 64) - 1)),) for c in codes]
    found = {(r.code.high, r.code.low): r.n_links for r in S.link_counts(spark.createDataFrame(rows, f"code {S.CODE}"), 6, part_rows).collect()}
    for c, (key,) in zip(codes, rows, strict=True):
        assert found.get(key, 0) == sum((c ^ d).bit_count() <= 6 for d in codes if d != c)


def test_edited_texts_take_the_next_document_and_wrap(spark):
    texts = ["abcdef", "uvwxyz", None, "né plus ultra"]
    rows = {r.doc_id: r for r in S.fingerprints(docs(spark, texts)).collect()}
    import hashlib

    order = [3, 2, 1, 0]
    for k, d in enumerate(order):
        own, after = texts[d] or "", texts[order[(k + 1) % 4]] or ""
        n = len(own) // 3
        assert rows[d].edited_sha256 == hashlib.sha256((own[: len(own) - n] + after[:n]).encode()).hexdigest()
    assert rows[2].near_edited == 1.0 and S.fingerprint(b"A  b\nc") == S.fingerprint(b"a b c")
