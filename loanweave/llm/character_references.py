"""Character references of HTML as Spark expressions: named ones, decimal and hexadecimal ones.

Names come from the standard library's table of HTML 5. A name with its semicolon must match as a whole; of the
names that may stand without one, the longest at the start of the run counts. A number stands for its code point;
0, surrogates and numbers above 0x10FFFF give U+FFFD, 0x80 to 0x9F what Windows-1252 has there, controls and
noncharacters nothing. A run that is no reference stays as it is. Each text is read once, so what a
reference gives is never read as a reference again.
"""

from __future__ import annotations

import json
import zlib
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

REFERENCE = r"^(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*;?)"
WITHOUT_SEMICOLON = sorted((name for name in html5 if not name.endswith(";")), key=lambda name: (-len(name), name))
LEGACY = "^(?:" + "|".join(WITHOUT_SEMICOLON) + ")"
# What Windows-1252 has at 0x80 to 0x9F; its five gaps are controls and give nothing.
WINDOWS = [bytes([code]).decode("cp1252", "ignore") for code in range(0x80, 0xA0)]
TOO_LARGE = 0x110000
BUCKETS = 4096


def _buckets() -> list[dict[str, str]]:
    """Names by CRC-32, so that a lookup in Spark compares with one name or two instead of all."""
    table: list[dict[str, str]] = [{} for _ in range(BUCKETS)]
    for name, characters in html5.items():
        table[zlib.crc32(name.encode()) % BUCKETS][name] = characters
    return table


def resolved(text: Column) -> Column:
    """``text`` with its references resolved."""
    table = F.from_json(F.lit(json.dumps(_buckets())), "array<map<string,string>>")

    def found(name: Column) -> Column:
        return F.try_element_at(F.get(table, (F.crc32(name) % BUCKETS).cast("int")), name)

    def parsed(piece: Column) -> Column:
        return F.struct(piece.alias("piece"), F.regexp_extract(piece, REFERENCE, 0).alias("reference"))

    def named(row: Column) -> Column:
        return F.struct(row.piece.alias("piece"), row.reference.alias("reference"), found(row.reference).alias("named"))

    def run(row: Column) -> Column:
        behind = F.substring(row.piece, F.length(row.reference) + 1, F.length(row.piece))
        legacy = F.regexp_extract(row.reference, LEGACY, 0)
        return (
            F.when(row.reference == "", F.concat(F.lit("&"), row.piece))
            .when(row.named.isNotNull(), F.concat(row.named, behind))
            .when(row.reference.startswith("#"), F.concat(_character(_number(row.reference)), behind))
            .when(legacy == "", F.concat(F.lit("&"), row.piece))
            .otherwise(F.concat(found(legacy), F.substring(row.piece, F.length(legacy) + 1, F.length(row.piece))))
        )

    # One step after another, so that nothing is worked out twice for a piece.
    steps = F.transform(F.transform(F.split(text, "&"), parsed), named)
    return F.array_join(F.transform(steps, lambda row, place: F.when(place == 0, row.piece).otherwise(run(row))), "")


def _number(reference: Column) -> Column:
    hexadecimal = F.lower(F.substring(reference, 2, 1)) == "x"
    digits = F.regexp_replace(reference, "^#[xX]?0*|;$", "")
    # Seven digits hold every code point, in either base.
    short = F.when(hexadecimal, F.conv(F.concat(F.lit("0"), digits), 16, 10)).otherwise(F.concat(F.lit("0"), digits))
    return F.when(F.length(digits) > 7, TOO_LARGE).otherwise(short.cast("int"))


def _character(number: Column) -> Column:
    above = number - 0x10000
    units = F.when(number < 0x10000, F.lpad(F.hex(number), 4, "0")).otherwise(
        F.concat(F.hex(F.shiftright(above, 10) + 0xD800), F.hex(above.bitwiseAND(0x3FF) + 0xDC00))
    )
    windows = F.array(*[F.lit(character) for character in WINDOWS])
    return (
        F.when((number == 0) | number.between(0xD800, 0xDFFF) | (number >= TOO_LARGE), F.lit("�"))
        .when(number.between(0x80, 0x9F), F.get(windows, number - 0x80))
        .when(_nothing(number), F.lit(""))
        .otherwise(F.decode(F.unhex(units), "UTF-16BE"))
    )


def _nothing(number: Column) -> Column:
    """Controls other than white space, and noncharacters."""
    control = number.between(1, 8) | (number == 11) | number.between(14, 31) | (number == 127)
    return control | number.between(0xFDD0, 0xFDEF) | (number.bitwiseAND(0xFFFE) == 0xFFFE)


def sql_names() -> str:
    """The table of names as a DuckDB map."""

    def quoted(value: str) -> str:
        return "'" + value.replace("'", "''") + "'"

    return f"map([{', '.join(map(quoted, html5))}], [{', '.join(map(quoted, html5.values()))}])"


def sql_resolved(text: str, names: str) -> str:
    """The same in DuckDB; ``names`` is a column that holds ``sql_names()``."""
    parsed = f"""lambda p: {{'p': p, 'r': regexp_extract(p, '{REFERENCE}'),
      'l': regexp_extract(regexp_extract(p, '{REFERENCE}'), '{LEGACY}')}}"""
    number = """lambda s: {'p': s.p, 'r': s.r, 'l': s.l, 'd': regexp_replace(s.r, '^#[xX]?0*|;$', '', 'g')}"""
    valued = f"""lambda s: {{'p': s.p, 'r': s.r, 'l': s.l, 'n': CASE WHEN s.r NOT LIKE '#%' THEN -1
      WHEN length(s.d) > 7 THEN {TOO_LARGE} WHEN s.d = '' THEN 0
      WHEN lower(s.r[2]) = 'x' THEN CAST('0x' || s.d AS BIGINT) ELSE CAST(s.d AS BIGINT) END}}"""
    windows = "[" + ", ".join(f"'{character}'" for character in WINDOWS) + "]"
    character = f"""CASE WHEN s.n = 0 OR s.n BETWEEN 55296 AND 57343 OR s.n >= {TOO_LARGE} THEN chr(65533)
      WHEN s.n BETWEEN 128 AND 159 THEN {windows}[s.n - 127]
      WHEN s.n BETWEEN 1 AND 8 OR s.n = 11 OR s.n BETWEEN 14 AND 31 OR s.n = 127 OR s.n BETWEEN 64976 AND 65007
        OR s.n & 65534 = 65534 THEN '' ELSE chr(CAST(s.n AS INTEGER)) END"""
    made = f"""lambda s: CASE WHEN s.n >= 0 THEN {character} || substr(s.p, length(s.r) + 1)
      WHEN {names}[s.r] IS NOT NULL THEN {names}[s.r] || substr(s.p, length(s.r) + 1)
      WHEN s.l <> '' THEN {names}[s.l] || substr(s.p, length(s.l) + 1) ELSE '&' || s.p END"""
    pieces = f"string_split({text}, '&')"
    later = f"list_transform(list_transform(list_transform(list_transform({pieces}[2:], {parsed}), {number}), {valued}), {made})"
    return f"array_to_string(list_concat({pieces}[1:1], {later}), '')"
