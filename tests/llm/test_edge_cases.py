"""Every query over odd rows and over empty tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import queries
from loanweave.llm.queries import QUERIES

NAMES = sorted({*QUERIES, "pipeline"})
# Extra columns with names that operators use themselves.
EXTRA = ", doc string, row bigint, fp bigint, root int, text_crc32 string, `of` int, _text string, `a.b` int"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint" + EXTRA
REST = ("x", 1, 2, 3, "y", 4, "z", 5)


def row(doc_id, text, lang="en"):
    return (doc_id, text, lang, None, None, *REST)


LONG = " ".join(f"word{i % 977} of text{i % 331}." for i in range(40_000))
ODD = [
    row(None, None, None),
    row(None, "some text without an id"),
    row(1, None),
    row(2, ""),
    row(3, "   \n\t "),
    row(4, "one"),
    row(4, "one"),
    row(4, "another text under the same id"),
    row(5, "12345 !!! ???", None),
    row(6, "Grüße an alle, schöne Straße", "de"),
    row(7, LONG),
    row(8, LONG + " and a word more"),
    row(9, "\u0000 odd   \U0001f600 marks <|endoftext|> İ"),
    row(10, "mail a.b@example.com or 10.0.0.1, card 4111 1111 1111 1111, call +1 (234) 555-1234"),
]
BENCH = [(1, "one"), (1, "one"), (None, "another text under the same id"), (2, None), (3, ""), (4, LONG[:400])]
VECTORS = [(1, [0.5, None, 0.5, 0.5], 1), (2, None, 1), (None, [0.5, -0.5, 0.25, 0.0], None), (3, [], 1), (3, [float("nan")] * 4, 1), (4, [0.5] * 5, 2)]
PAGES = [(1, None, None), (None, "http://a", "<p>x"), (2, "u", "<!-- open <p>gone"), (2, "u", "<!-- open <p>gone"), (3, "v", LONG)]


@pytest.fixture
def odd(tables):
    return tables(
        documents=(DOCS, ODD),
        benchmark=("item_id bigint, text string, spans int", [(*b, 0) for b in BENCH]),
        pages=("page_id bigint, url string, html string, block string", [(*p, "b") for p in PAGES]),
        embeddings=("vec_id bigint, embedding array<float>, label int, codes int", [(*v, 0) for v in VECTORS]),
    )


@pytest.fixture
def empty(tables):
    return tables(
        documents=(DOCS, []),
        benchmark=("item_id bigint, text string", []),
        pages=("page_id bigint, url string, html string", []),
        embeddings=("vec_id bigint, embedding array<float>, label int", []),
    )


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows(spark, odd, name):
    rows = queries()[name](spark, odd).collect()
    if name.startswith("op1_"):
        assert len(rows) == 2 * len(PAGES)
    elif name == "pipeline":
        assert {r.doc_id for r in rows} <= {None, 2, 4, 6, 7, 8, 9, 10} and 7 in {r.doc_id for r in rows}
    elif name.startswith("op12_"):
        assert sorted(r.vec_id or -1 for r in rows) == [-1, 3, 4] and {r.error for r in rows} == {0}
    elif name.startswith("op4_"):
        assert sum(r.piece == 0 for r in rows) == len(ODD)
    elif not name.startswith("op10_"):
        assert sorted(r.doc_id or -1 for r in rows) == sorted(r[0] or -1 for r in ODD)
    else:
        assert {(r.doc_id, r.other_doc_id) for r in rows} == {(8, 7)}


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables(spark, empty, name):
    assert queries()[name](spark, empty).count() == 0
