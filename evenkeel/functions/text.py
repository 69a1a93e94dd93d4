"""Whitespace, markup and quoting of text columns."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space in the Unicode sense; the shorthand class alone is ASCII only.
SPACE = (r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}"
         r"\x{205f}\x{3000}]")

# Named character references of HTML: those that end in a semicolon, and the older
# ones that are also understood without it.
_NAMED = {name: text for name, text in html5.items() if name.endswith(";")}
_BARE = {name: text for name, text in html5.items() if not name.endswith(";")}
_BARE_NAME = "^&(" + "|".join(sorted(_BARE, key=len, reverse=True)) + ")"


def strip(column: Column) -> Column:
    return F.regexp_replace(column, f"^{SPACE}+|{SPACE}+$", "")


def one_line(column: Column) -> Column:
    """Runs of white space, line breaks included, become one space."""
    return F.regexp_replace(column, f"{SPACE}+", " ")


def _table(names: dict[str, str]) -> Column:
    """A constant map; it is folded once and not built per row."""
    return F.from_json(F.lit(json.dumps(names)), "map<string,string>")


# Numbers 128 to 159 stand for the characters that older pages meant by them.
_OLDER = {str(n): bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)}


def _character(code: Column) -> Column:
    """The character of a number as HTML reads it; NULL is a number beyond all characters."""
    given = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    low = code.bitwiseAND(0xFFFF)
    nothing = (code.between(1, 8) | (code == 0x0B) | code.between(0x0E, 0x1F) | (code == 0x7F)
               | code.between(0xFDD0, 0xFDEF) | (low == 0xFFFE) | (low == 0xFFFF))
    return (
        F.when(code.isNull() | (code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF),
               F.lit("\ufffd"))
        .when(code.between(0x80, 0x9F), F.try_element_at(_table(_OLDER), code.cast("string")))
        .when(nothing, F.lit(""))
        .otherwise(given))


def _decoded(piece: Column) -> Column:
    """A piece of text that starts with ``&``, its leading reference decoded."""
    decimal = F.regexp_extract(piece, r"^&#(\d+);?", 1)
    hexadecimal = F.regexp_extract(piece, r"^&#[xX]([0-9a-fA-F]+);?", 1)
    # Leading zeros count for nothing; what is longer than any character's number is none.
    digits = F.regexp_extract(decimal, "^0*(.*)$", 1)
    hex_digits = F.regexp_extract(hexadecimal, "^0*(.*)$", 1)
    code = (
        F.when(decimal != "", F.when(digits == "", 0).when(
            F.length(digits) <= 7, digits.try_cast("int")))
        .when(hexadecimal != "", F.when(hex_digits == "", 0).when(
            F.length(hex_digits) <= 6, F.conv(hex_digits, 16, 10).try_cast("int"))))
    numeric = F.regexp_extract(piece, r"^&#(?:\d+|[xX][0-9a-fA-F]+);?", 0)
    name = F.regexp_extract(piece, r"^&([A-Za-z][A-Za-z0-9]*;)", 1)
    bare = F.regexp_extract(piece, _BARE_NAME, 1)
    named = F.try_element_at(_table(_NAMED), name)

    def after(length: Column) -> Column:
        return F.substr(piece, length + 1)

    return (
        F.when(numeric != "", F.concat(_character(code), after(F.length(numeric))))
        .when((name != "") & named.isNotNull(), F.concat(named, after(F.length(name) + 1)))
        .when(bare != "", F.concat(
            F.try_element_at(_table(_BARE), bare), after(F.length(bare) + 1)))
        .otherwise(piece)
    )


def unescape(column: Column) -> Column:
    """Character references to characters, each decoded once."""
    decoded = F.array_join(F.transform(F.split(column, "(?=&)"), _decoded), "")
    return F.when(F.contains(column, F.lit("&")), decoded).otherwise(column)


def text_lines(fragment: Column) -> Column:
    """Non-blank lines of markup, with every tag a line break."""
    text = unescape(F.regexp_replace(fragment, "<[^>]+>", "\n"))
    lines = F.transform(F.split(text, "\n"), strip)
    return F.filter(lines, lambda line: line != "")


def quoted(column: Column) -> Column:
    """A string as a program would print it, for messages."""
    escaped = F.replace(column, F.lit("\\"), F.lit("\\\\"))
    for raw, shown in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        escaped = F.replace(escaped, F.lit(raw), F.lit(shown))
    single, double = F.lit("'"), F.lit('"')
    return F.when(
        F.contains(column, single) & ~F.contains(column, double),
        F.concat(double, escaped, double),
    ).otherwise(F.concat(single, F.replace(escaped, single, F.lit("\\'")), single))
