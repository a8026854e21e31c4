"""Repeated bytes against counting all strings."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import duckdb
import pytest

from loanweave.llm import repeated_bytes
from loanweave.llm.queries import QUERIES


def brute_starts(strings, least):
    counts = Counter(s[k : k + least] for s in strings for k in range(len(s) - least + 1))
    return {(n, k) for n, s in enumerate(strings) for k in range(len(s) - least + 1) if counts[s[k : k + least]] > 1}


@pytest.mark.parametrize("letters", [b"a", b"ab", b"abcdef", bytes(range(256))])
def test_suffixes_against_counting(letters):
    rng = random.Random(len(letters))
    for _ in range(60):
        strings = [bytes(rng.choice(letters) for _ in range(rng.randrange(1, 60))) for _ in range(rng.randrange(1, 14))]
        strings += [strings[0], b"x" + strings[-1][1:] + b"y"]
        least = rng.randrange(1, 9)
        found = list(zip(*(side.tolist() for side in repeated_bytes.repeated_starts(strings, least)), strict=True))
        assert len(found) == len(set(found)) and set(found) == brute_starts(strings, least)


@pytest.mark.parametrize("least", [1, 5, 200, 255, 256, 300])
@pytest.mark.parametrize("narrow", [0, 1 << 23])
def test_numbers_of_either_width_find_the_same(monkeypatch, narrow, least):
    monkeypatch.setattr(repeated_bytes, "NARROW", narrow)
    rng = random.Random(least)
    common = bytes(rng.randrange(256) for _ in range(least + 20))
    strings = [bytes([n]) * rng.randrange(1, 40) + common[rng.randrange(9) :] + bytes([n, 255]) for n in range(40)] + [b"a" * 400]
    found = set(zip(*(side.tolist() for side in repeated_bytes.repeated_starts(strings, least)), strict=True))
    assert found == brute_starts(strings, least) and found


def test_segments_hold_each_string_once():
    rng = random.Random(3)
    texts = [b"", b"a" * 199, b"a" * 200, b"ab" * 4000, bytes(rng.choice(b"abc ") for _ in range(150_000)), bytes(rng.randrange(256) for _ in range(3000))]
    seen = Counter()
    for owners, _, _, starts, ats, counts in repeated_bytes.segments(texts):
        for k, start, at, count in zip(owners, starts, ats, counts, strict=True):
            assert 0 <= at < repeated_bytes.STARTS and 0 < count <= repeated_bytes.STARTS
            seen.update((k, start + i) for i in range(count))
    assert seen == Counter((k, i) for k, text in enumerate(texts) for i in range(len(text) - 199))


def brute(rows):
    texts = [(r[1] or "").encode() for r in rows]
    covered = [bytearray(len(t)) for t in texts]
    for n, k in brute_starts(texts, 200):
        covered[n][k : k + 200] = b"\x01" * 200
    out = []
    for row, text, marks in zip(rows, texts, covered, strict=True):
        kept = bytes(b for b, mark in zip(text, marks, strict=True) if not mark)
        spans = len([run for run in bytes(marks).split(b"\x00") if run])
        out.append((row[0], len(text), sum(marks), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def prose(rng, n):
    return " ".join("".join(rng.choice("aeiou") + rng.choice("nrst") for _ in range(rng.randrange(1, 4))) for _ in range(n))


def texts(rng):
    line, passage, long = prose(rng, 14)[:90], prose(rng, 90), prose(rng, 700)
    # A line shared by texts that differ around it, within 200 bytes and beyond, passages, copies, near copies, repeats inside.
    found = [prose(rng, 60) + line + prose(rng, 60) for _ in range(40)]
    found += [prose(rng, rng.randrange(40)) + passage[a : a + 260 + a] + prose(rng, 30) for a in range(0, 60, 3)]
    found += [long] * 5 + [long[:k] + "é" + long[k + 1 :] for k in range(50, 3000, 500)]
    found += ["x" * 1000, "ab" * 500, passage + "-" + passage, "y" * 200, "y" * 199, None, "", "short"]
    return found + [prose(rng, 200) + passage + line * 3]


@pytest.mark.parametrize("classes", [3, 16_384])
def test_operator_against_counting(spark, tables, monkeypatch, classes):
    # With a small bound most keys are split, down to whole strings.
    monkeypatch.setattr(repeated_bytes.without_repeats, "__defaults__", ("doc_id", "text", classes))
    rows = [(k, t) for k, t in enumerate(texts(random.Random(9)))] + [(None, "z" * 250), (7, "same" * 70), (7, "same" * 70)]
    folder = tables(documents=("doc_id bigint, text string, row int, key int, class int, bytes int", [(*r, 1, 2, 3, 4) for r in rows]))
    found = QUERIES["op11_column_wise_repeats"](spark, folder).collect()
    assert sorted(map(tuple, found), key=str) == brute(rows)


def test_query_against_counting_on_given_tables(spark):
    folder = "/root/testdata/sf0.01"
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet'").fetchall()
    found = QUERIES["op11_column_wise_repeats"](spark, folder).collect()
    assert sorted(map(tuple, found), key=str) == brute(rows) and sum(r.n_removed for r in found) > 0
