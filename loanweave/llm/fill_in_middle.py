"""Texts for fill-in-the-middle training: cut at two line ends, the middle moved to the end.

Where the two line ends lie comes from an indexable skip list over the lines of a text: lane 0 links every line to
the next one, every lane above links each ``SPAN``-th node of the lane below, and a link carries the lines and the code
points that it passes. From the top lane down, links are taken while the lines passed stay within the rank, so both
cuts are found exactly in a few steps a lane, whatever the number of lines.

What is cut and how comes from a hash of the document's id: the same for every partitioning and repeatable after
the loss of an executor. No row moves, so a hot source or a large group of copies costs no more than other rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed, quoted, slices

#: Marks of prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
#: A lane's nodes for each node of the lane above.
SPAN = 8


class Lanes:
    """An indexable skip list over lines, given by their code points."""

    def __init__(self, widths: Sequence[int]):
        units, chars = [1] * len(widths), list(widths)
        self.lanes = [(units, chars)]
        while len(units) > SPAN:
            starts = range(0, len(units), SPAN)
            units = [sum(units[k : k + SPAN]) for k in starts]
            chars = [sum(chars[k : k + SPAN]) for k in starts]
            self.lanes.append((units, chars))

    def place(self, rank: int) -> int:
        """Code points before the line of this rank (counted from 0)."""
        passed = place = node = 0
        for units, chars in reversed(self.lanes):
            node *= SPAN
            while node < len(units) and passed + units[node] <= rank:
                passed += units[node]
                place += chars[node]
                node += 1
        return place


def line_widths(text: str) -> list[int]:
    """Code points of each line with its line feed; what follows the last line feed is a line if it is not empty."""
    widths = [len(line) + 1 for line in text.split("\n")]
    widths[-1] -= 1
    return widths if widths[-1] else widths[:-1]


def transform(
    docs: DataFrame,
    keep: Sequence[str],
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = 7,
    percent: int = 100,
    percent_spm: int = 50,
    marks: tuple[str, str, str] = MARKS,
) -> DataFrame:
    """``doc`` (struct of the columns ``keep``), ``n`` (lines), ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    ``form`` is ``plain`` (the text as it is), ``psm`` or ``spm``. Of the texts that can be cut ``percent`` in a hundred
    are, and of these ``percent_spm`` in a hundred have their suffix first. An empty text and one that contains
    a mark stay plain, with no ``prefix_chars`` and ``middle_chars``. A null text is empty, a null id draws as an empty one;
    rows with the same id are cut at the same draws.
    """
    if len({m[0] for m in marks}) != 1 or any(marks[0][0] in m[1:] for m in marks) or len(set(marks)) != 3:
        raise ValueError("marks differ and share a first character that occurs nowhere else in them")
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(quoted(id_col)).cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(name, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)]
    text = F.coalesce(F.col(quoted(text_col)).cast("string"), F.lit(""))
    source = docs.select(packed(docs, keep), text.alias("_text"), F.array(*draws).alias("_draws"))
    fields = {"n": pa.int64(), "form": pa.string(), "prefix_chars": pa.int64(), "middle_chars": pa.int64(), "output": pa.string()}
    kinds = {"n": "bigint", "form": "string", "prefix_chars": "bigint", "middle_chars": "bigint", "output": "string"}
    schema = source.select("doc", *[F.lit(None).cast(kind).alias(c) for c, kind in kinds.items()]).schema
    prefix_mark, suffix_mark, middle_mark = marks

    def cut(text: str, draws: list[int]) -> tuple[int, str, int | None, int | None, str]:
        widths = line_widths(text)
        n = len(widths)
        if not text or any(mark in text for mark in marks) or draws[2] % 100 >= percent:
            return n, "plain", None, None, text
        lanes = Lanes(widths)
        start, end = (lanes.place(rank) for rank in sorted(draw % (n + 1) for draw in draws[:2]))
        prefix, middle, suffix = text[:start], text[start:end], text[end:]
        if draws[3] % 100 < percent_spm:
            return n, "spm", start, end - start, "".join((suffix_mark, suffix, prefix_mark, prefix, middle_mark, middle))
        return n, "psm", start, end - start, "".join((prefix_mark, prefix, suffix_mark, suffix, middle_mark, middle))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [cut(t, d) for t, d in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            columns = zip(zip(*rows, strict=True), fields.values(), strict=True) if rows else ([[], k] for k in fields.values())
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in columns]], names=["doc", *fields])

    return source.mapInArrow(run, schema)


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text from which ``transform`` has made this.

    No text that is cut holds a mark, and a mark's first character is at its beginning only, so none arises across a
    border either: the first one of each kind is the one that was put there.
    """
    prefix, suffix, middle = (re.escape(mark) for mark in marks)
    psm = F.split(output, f"{prefix}|{suffix}|{middle}")
    return (
        F.when(form == "psm", F.concat(psm[1], psm[3], psm[2]))
        .when(form == "spm", F.concat(psm[2], psm[3], psm[1]))
        .otherwise(output)
    )
