"""Vector codes and fill-in-the-middle texts against slow versions."""

from __future__ import annotations

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanweave.llm import fill_in_middle, vector_codes
from loanweave.llm.queries import QUERIES

from conftest import docs


def test_lanes_find_every_rank():
    rng = random.Random(5)
    for n in (0, 1, 7, 8, 9, 64, 65, 700):
        widths = [rng.randrange(1, 9) for _ in range(n)]
        lanes = fill_in_middle.Lanes(widths)
        assert [lanes.place(k) for k in range(n + 1)] == [sum(widths[:k]) for k in range(n + 1)]
        assert max(len(units) for units, _ in lanes.lanes[-1:]) <= fill_in_middle.SPAN or n <= fill_in_middle.SPAN


@pytest.mark.parametrize("text", ["", "a", "\n", "a\n", "\n\na", "é\r\n b\n\U0001f600", "x" * 5000 + "\n" * 3000])
def test_lines_are_those_of_the_pattern(text):
    assert fill_in_middle.line_widths(text) == [len(line) for line in re.findall(r"[^\n]*\n|[^\n]+", text)]


def brute_cut(doc_id, text):
    text = text or ""
    name = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(name[8 * k : 8 * k + 8], 16) for k in range(4)]
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    a, b = sorted(x % (len(lines) + 1) for x in h[:2])
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if not text or re.search("<[PSM]>", text):
        form, out = "plain", text
    else:
        form, out = ("spm", f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 50 else ("psm", f"<P>{p}<S>{s}<M>{m}")
    sizes = (None, None) if form == "plain" else (len(p), len(m))
    return (doc_id, len(lines), form, *sizes, *(hashlib.sha256(x.encode()).hexdigest() for x in (out, text)))


def test_cuts_against_a_slow_version(spark, tables):
    texts = [None, "", "a", "one\ntwo\nthree", "<", "<P", "a<S\n>b\n<", "P>\nS>\n<\n<\n", "keep <M> this\n", "é\n" * 3000, "no line feed " * 9000]
    rows = [(i, t) for i, t in enumerate(texts * 8)] + [(None, "x\ny\nz"), (3, "one\ntwo"), (3, "one\ntwo"), (2**60, "u\nv\n")]
    found = QUERIES["op13_skip_list_fill_in_middle"](spark, tables(documents=("doc_id bigint, text string, n int, form int", [(*r, 1, 2) for r in rows])))
    assert sorted(map(tuple, found.collect()), key=str) == sorted((brute_cut(*r) for r in rows), key=str)
    assert {r.form for r in found.collect()} == {"plain", "psm", "spm"}


def test_other_rates_and_marks(spark):
    df = docs(spark, [f"line {k}\nand\nmore {k}\n<P> " for k in range(300)])
    marks = ("[pre]", "[suf]", "[mid]")
    found = fill_in_middle.transform(df, ["text"], percent=50, percent_spm=0, marks=marks)
    found = found.select("doc.text", "form", fill_in_middle.restored(F.col("output"), F.col("form"), marks).alias("back")).collect()
    assert all(r.back == r.text for r in found) and 100 < sum(r.form == "psm" for r in found) < 200
    with pytest.raises(ValueError):
        fill_in_middle.transform(df, ["text"], marks=("<P>", "<P<", "<M>"))


def test_transform_keeps_scaled_distances_in_sequency_order():
    rng = np.random.default_rng(1)
    for depth in (1, 2, 3, 8, 13, 16, 33):
        points = rng.integers(-9000, 9000, (50, depth))
        moved = vector_codes.transformed(points)
        n = moved.shape[1]
        assert ((moved**2).sum(axis=1) == n * (points**2).sum(axis=1)).all()
        rows = vector_codes.transformed(np.eye(n, dtype=np.int64)).T
        assert [int((np.diff(row) != 0).sum()) for row in rows] == list(range(n))


def test_nearest_against_all_distances():
    rng = np.random.default_rng(2)
    for depth, spread in ((16, 300), (16, 2), (5, 1), (1, 3)):
        points, entries = rng.integers(-spread, spread + 1, (700, depth)), rng.integers(-spread, spread + 1, (256, depth))
        whole = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
        found, scaled = vector_codes.nearest(vector_codes.transformed(points), vector_codes.transformed(entries))
        assert (found == whole.argmin(axis=1)).all()
        assert (scaled == whole.min(axis=1) * (1 << (depth - 1).bit_length())).all()


def brute_codes(rows):
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    width = 4 * max(1, -(-max((len(r[1]) for r in kept), default=0) // 4))
    vectors = [[math.floor(1024 * x) for x in r[1]] + [0] * (width - len(r[1])) for r in kept]
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, vectors[k]))[:256]
    d = width // 4
    parts = [[v[p * d : p * d + d] for p in range(4)] for v in vectors]
    books = [[parts[k][p] for k in order] for p in range(4)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(4):
        for p in range(4):
            own = [nearest(x[p], books[p])[1] for x in parts]
            for k in set(own):
                of = [x[p] for x, o in zip(parts, own, strict=True) if o == k]
                books[p][k] = [sum(c) // len(of) for c in zip(*of, strict=True)]
    last = [[nearest(x[p], books[p]) for p in range(4)] for x in parts]
    errors = [sum(d for d, _ in x) for x in last]
    digest = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    return [
        (r[0], "".join(f"{k:02x}" for _, k in x), e, sum(f for q, f in zip(kept, errors, strict=True) if q[2] == r[2]), digest)
        for r, x, e in zip(kept, last, errors, strict=True)
    ]


@pytest.mark.parametrize("partitions", [1, 7])
@pytest.mark.parametrize("width", [8, 9])
def test_codes_against_a_slow_version(spark, tables, width, partitions):
    rng = random.Random(width)
    rows = [(k, [rng.choice((-0.1, 0.0, 0.25, rng.gauss(0, 1))) for _ in range(width)], rng.choice((1, 2, None))) for k in range(320)]
    rows += [(None, [0.5] * width, 1), (7, [0.5] * width, None), (7, [0.5] * width, None), (9, [1.0, -1.0], 2), (10, [], 1)]
    rows += [(11, None, 1), (12, [1.0, None], 2), (13, [float("nan")] * width, 1), (14, [float("-inf"), 0.0], 1)]
    schema = "vec_id bigint, embedding array<double>, label int, v int, id string, doc int, codes int, error int"
    folder = tables(unused=("a int", []))
    spark.createDataFrame([(*r, 1, "x", 2, 3, 4) for r in rows], schema).repartition(partitions).write.parquet(f"{folder}/embeddings.parquet")
    found = QUERIES["op12_walsh_hadamard_codes"](spark, folder).collect()
    assert sorted(map(tuple, found), key=str) == sorted(brute_codes(rows), key=str)


def test_components_too_large_are_refused(spark):
    df = spark.createDataFrame([(1, [1e9, 0.0, 0.0, 0.0])], "vec_id bigint, embedding array<double>")
    with pytest.raises(ValueError):
        vector_codes.encode(df, ["vec_id"])
