"""Character references and links of pages."""

from __future__ import annotations

import html
import random
import re
import time
from html.entities import html5

import duckdb
from pyspark.sql import functions as F

from loanweave.llm import character_references as R
from loanweave.llm import warc_derivatives as A
from loanweave.llm.queries import QUERIES


def random_texts(count=400):
    rng = random.Random(3)
    names = sorted(html5)
    numbers = [0, 9, 10, 13, 38, 65, 0x80, 0x99, 0xD7FF, 0xD800, 0xFEFF, 0xFFFD, 0x1F600, 0x10FFFF - 2, 0x110000, 10**12]

    def part():
        number = rng.choice(numbers)
        kinds = [f"&{rng.choice(names)}", f"&#{number};", f"&#x{number:x};", f"&#X00{number:X}", f"&#{number}"]
        return rng.choice([*kinds, "&", "&&", ";", "x", " ", "#", "&#;", "&#x;", "&amp;lt;", "&notit;", "&nosuch;", "é", "\n", "1"])

    every = "".join(f"&{name} " for name in names)
    return [None, "", "&", every, *("".join(part() for _ in range(rng.randrange(12))) for _ in range(count))]


def test_references_are_those_of_the_standard_library(spark):
    texts = random_texts()
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string").select("id", R.resolved(F.col("text")).alias("text"))
    got = {r.id: r.text for r in rows.collect()}
    assert all(got[i] == (None if text is None else html.unescape(text)) for i, text in enumerate(texts))


def test_references_in_sql_are_the_same():
    texts = random_texts()
    connection = duckdb.connect()
    connection.execute("CREATE TABLE texts (id INTEGER, text VARCHAR)")
    connection.executemany("INSERT INTO texts VALUES (?, ?)", list(enumerate(texts)))
    sql = f"SELECT id, {R.sql_resolved('text', 'names')} FROM texts, (SELECT {R.sql_names()} AS names) WHERE text IS NOT NULL"
    assert all(text == html.unescape(texts[i]) for i, text in connection.execute(sql).fetchall())


def test_controls_and_noncharacters_give_nothing(spark):
    text = "a&#1;&#x81;&#xFFFE;&#x1FFFF;&#xFDD0;b"
    assert spark.range(1).select(R.resolved(F.lit(text))).first()[0] == "ab"


def test_links_in_every_kind_of_quotes(spark):
    page = (
        "<a href='x y'>1</a><A class=q HREF = \"/a?b=1&amp;c=2\">2</a><a\nhref=/plain>3</a><a data-href='no' title=\"t\"href=/t>4</a>"
        "<abbr href=no><a name=n><a href=''>5</a>"
    )
    pages = spark.createDataFrame([(1, "u", page)], "page_id int, url string, html string")
    fields = A.derivatives(A.responses(pages, "d"), ["page_id"]).where("record_type = 'metadata'").first().block
    assert re.findall(r"outlink: (.*) L a/@href", fields) == ["x y", "/a?b=1&c=2", "/plain", "/t", ""]


def test_long_runs_take_linear_time(spark):
    runs = [part * (1_000_000 // len(part)) for part in ("<a ", "<a href ", "<a href='", '<a href="', "&", "&a", "a", "&#1", "<", "<!--")]
    pages = spark.createDataFrame([(i, "u", run) for i, run in enumerate(runs)], "page_id int, url string, html string").repartition(8)
    began = time.time()
    A.derivatives(A.responses(pages, "d"), ["page_id"]).write.format("noop").mode("overwrite").save()
    assert time.time() - began < 60


def test_no_name_of_the_table_is_left_in_a_conversion_record(spark):
    records = QUERIES["op1_warc_derivatives"](spark, "/root/testdata/sf0.01").where("record_type = 'conversion'")
    left = {name for r in records.select("block").collect() for name in re.findall(r"&([A-Za-z][A-Za-z0-9]*;)", r.block)}
    assert not left & set(html5)


def test_white_space_and_hidden_parts_as_by_the_plain_patterns(spark):
    rng = random.Random(11)
    parts = [" ", "  ", "\n", "\t", "\r\n", "\f", "\x0b", " ", "a", "b<", "<!--", "-->", "<SCRIPT>", "</script >", "<style ", "</style>", "<scripts"]
    texts = ["", " ", "\n \n", *("".join(rng.choices(parts, k=rng.randrange(14))) for _ in range(500))]

    def joined(text):
        text = re.sub(r"[ \t\r\f\x0B]+", " ", re.sub(A.HIDDEN.replace(r"\z", r"\Z"), " ", text))
        return re.sub(r"^[ \n]+|[ \n]+\Z", "", re.sub(r" ?\n[ \n]*", "\n", text))

    rows = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    got = rows.select("id", A._joined(F.regexp_replace("t", A.HIDDEN_AT_ONCE, " ")).alias("t")).collect()
    assert {r.id: r.t for r in got} == {k: joined(t) for k, t in enumerate(texts)}
