"""Derivatives of WARC responses: a metadata record and a plain-text conversion record for each.

Both refer to the response by its record id, carry its address and date, and keep its HTTP headers and the digest of its
payload; each names the other as concurrent. Ids follow from the type, the response and the block, so a
repeated run makes the same records. One pass without a shuffle, built-in functions only.

A text leaves out comments, scripts and styles (unclosed ones run to the end), turns tags of blocks into line
breaks, drops other tags, resolves character references, and joins white space (a no-break space counts as a space). Links are
``href`` in double, single or no quotes, in the order of the text. Patterns are linear in the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .character_references import resolved

VERSION = "WARC/1.1"
HIDDEN = (
    r"(?is)<!--.*?(?:-->|\z)"
    r"|<script(?:[ \t\r\n\f/>]|\z).*?(?:</script[ \t\r\n\f]*>|\z)"
    r"|<style(?:[ \t\r\n\f/>]|\z).*?(?:</style[ \t\r\n\f]*>|\z)"
)
# The same, with one look at each place instead of three.
HIDDEN_AT_ONCE = "(?is)<(?:" + HIDDEN.removeprefix("(?is)<").replace("|<", "|") + ")"
BREAKS = (
    r"(?i)</?(?:p|div|br|hr|li|ul|ol|dl|dt|dd|h[1-6]|tr|table|article|section|nav|header|footer|main|aside|title|head|body|html|pre"
    r"|blockquote)(?:[ \t\r\n\f/][^>]*)?(?:>|\z)"
)
TAGS = r"</?[A-Za-z!][^>]*(?:>|\z)"
TITLE = r"(?is)<title(?:[ \t\r\n\f/][^>]*)?>(.*?)(?:</title[ \t\r\n\f/>]|\z)"
LINK = (
    r"""(?i)<a[ \t\r\n\f](?:[^<>]*?[ \t\r\n\f"'/])?href[ \t\r\n\f]*=[ \t\r\n\f]*("""
    r""""[^"<>]*"|'[^'<>]*'|[^ \t\r\n\f"'<>=`]+)"""
)
END = "\r\n"


def plain_text(html: Column) -> Column:
    text = F.regexp_replace(html, HIDDEN_AT_ONCE, " ")
    text = F.regexp_replace(text, BREAKS, "\n")
    text = F.regexp_replace(text, TAGS, "")
    return _joined(F.replace(resolved(text), F.lit("\u00a0"), F.lit(" ")))


def link_target(value: Column) -> Column:
    """An attribute's value without its quotes, references resolved, without tabs and line breaks."""
    return F.regexp_replace(resolved(F.regexp_replace(value, "^[\"']|[\"']$", "")), r"[\t\r\n]", "")


def _joined(text: Column) -> Column:
    """White space as single spaces, lines without blanks around them, no empty lines."""
    # Single spaces stay as they are, and are no match.
    text = F.regexp_replace(text, r"[\t\r\f\x0B][ \t\r\f\x0B]*| [ \t\r\f\x0B]+", " ")
    return F.btrim(F.regexp_replace(text, r" \n[ \n]*|\n[ \n]+", "\n"), F.lit(" \n"))


def digest(content: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(content.cast("binary"), 256))


def record_id(*parts: Column) -> Column:
    """A name-based id from the MD5 of the parts."""
    name = F.md5(F.concat_ws("\n", *parts).cast("binary"))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(name, a, n) for a, n in cuts]), F.lit(">"))


def responses(pages: DataFrame, date: str) -> DataFrame:
    """Response records of a table of pages: ``page_id``, ``record_id``, ``target_uri``, ``date``, ``block``.

    A null page is an empty one, a null address an empty address.
    """
    html = F.coalesce("html", F.lit(""))
    uri = F.coalesce("url", F.lit(""))
    head = F.concat_ws(
        END,
        F.lit("HTTP/1.1 200 OK"),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.octet_length(html).cast("string")),
        F.lit(END),
    )
    return pages.select(
        "page_id",
        record_id(F.lit("response"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), uri, html).alias("record_id"),
        uri.alias("target_uri"),
        F.lit(date).alias("date"),
        F.concat(head, html).alias("block"),
    )


def derivatives(source: DataFrame, keep: list[str]) -> DataFrame:
    """Two records per response: the columns ``keep`` and those of a record.

    A block without a blank line is all headers and has an empty payload; a null block gives records of an
    empty payload. Repeated responses give repeated records.
    """
    block = F.coalesce("block", F.lit(""))
    split = F.instr(block, END + END)
    head = F.when(split > 0, F.substring(block, F.lit(1), split - 1)).otherwise(block)
    body = F.when(split > 0, F.substring(block, split + 4, F.length(block))).otherwise("")
    parsed = source.select(
        *keep, "record_id", "target_uri", "date", head.alias("source_headers"), body.alias("payload")
    ).select(
        "*",
        digest(F.col("payload")).alias("source_payload_digest"),
        plain_text(F.col("payload")).alias("text"),
        F.replace(plain_text(F.regexp_extract("payload", TITLE, 1)), F.lit("\n"), F.lit(" ")).alias("title"),
        F.transform(F.regexp_extract_all("payload", F.lit(LINK), F.lit(1)), link_target).alias("links"),
    )
    fields = F.array(
        F.concat(F.lit("source-payload-digest: "), F.col("source_payload_digest")),
        F.concat(F.lit("source-payload-length: "), F.octet_length("payload").cast("string")),
        F.concat(F.lit("title: "), F.col("title")),
    )
    headers = F.transform(F.split("source_headers", END), lambda h: F.concat(F.lit("source-header: "), h))
    links = F.transform("links", lambda link: F.concat(F.lit("outlink: "), link, F.lit(" L a/@href")))
    lines = F.concat_ws(END, F.concat(headers, fields, links))
    made = parsed.select("*", F.concat(lines, F.lit(END)).alias("fields")).select(
        "*",
        record_id(F.lit("metadata"), F.col("record_id"), F.col("fields")).alias("metadata_id"),
        record_id(F.lit("conversion"), F.col("record_id"), F.col("text")).alias("conversion_id"),
    )

    def record(kind: str, own: str, other: str, content_type: str, content: str) -> Column:
        return F.struct(
            F.lit(kind).alias("record_type"),
            F.col(own).alias("record_id"),
            F.col(other).alias("concurrent_to"),
            F.lit(content_type).alias("content_type"),
            F.octet_length(content).cast("bigint").alias("content_length"),
            digest(F.col(content)).alias("block_digest"),
            F.col(content).alias("block"),
        )

    both = F.array(
        record("metadata", "metadata_id", "conversion_id", "application/warc-fields", "fields"),
        record("conversion", "conversion_id", "metadata_id", "text/plain; charset=utf-8", "text"),
    )
    return made.select(
        *keep,
        F.col("record_id").alias("refers_to"),
        "target_uri",
        "date",
        "source_headers",
        "source_payload_digest",
        F.explode(both).alias("record"),
    ).select(*keep, "record.*", "refers_to", "target_uri", "date", "source_headers", "source_payload_digest")


def written(records: DataFrame) -> Column:
    """A record as it stands in a WARC file."""
    named = [
        ("WARC-Type", "record_type"),
        ("WARC-Record-ID", "record_id"),
        ("WARC-Date", "date"),
        ("WARC-Target-URI", "target_uri"),
        ("WARC-Refers-To", "refers_to"),
        ("WARC-Refers-To-Target-URI", "target_uri"),
        ("WARC-Refers-To-Date", "date"),
        ("WARC-Concurrent-To", "concurrent_to"),
        ("WARC-Block-Digest", "block_digest"),
        ("Content-Type", "content_type"),
        ("Content-Length", "content_length"),
    ]
    lines = [F.concat(F.lit(f"{name}: "), records[column].cast("string")) for name, column in named]
    return F.concat(F.concat_ws(END, F.lit(VERSION), *lines), F.lit(END + END), records["block"], F.lit(END + END))
