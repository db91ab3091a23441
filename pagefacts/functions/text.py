"""Text helpers shared by every operator.

Browsers trim and match a wider set of blanks than Java's ``\\s`` or Spark's ``trim``
do, so the class is spelled out once here and used everywhere.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a browser counts as white space.
BLANKS = "".join(
    map(
        chr,
        [9, 10, 11, 12, 13, 32, 0xA0, 0x1680, *range(0x2000, 0x200B),
         0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF],
    )
)

# The inside of a regex class for BLANKS, valid in Java and in RE2.
BLANK_CLASS = r"\t\n\x0B\f\r \x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}"
WS = f"[{BLANK_CLASS}]"

# References most pages have, looked at first; all others are in the table that the page reader uses, too.
COMMON_REFERENCES = ("amp;", "nbsp;", "lt;", "gt;", "quot;", "apos;", "ndash;", "mdash;", "bull;", "hellip;", "copy;", "reg;")
# Old names that count without a semicolon, as beginnings of longer words, too.
OPEN_REFERENCES = {name: char for name, char in html5.items() if not name.endswith(";")}
# Numbers of the C1 range mean characters of the Windows code page, where it has one.
C1 = [bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)]


def let(col: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``col`` computed once, where a projection of its own is not possible."""
    return F.get(F.transform(F.array(col), body), F.lit(0))


def trim(col: Column) -> Column:
    """Strip browser white space from both ends."""
    return F.btrim(col, F.lit(BLANKS))


def blank_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def first_text(col: Column) -> Column:
    """Trimmed text, or null when nothing is left."""
    return blank_to_null(trim(col))


def extract(col: Column, pattern: str, group: int = 1) -> Column:
    """``regexp_extract`` that yields null, not '', when nothing matched."""
    return blank_to_null(F.regexp_extract(col, pattern, group))


def contains_any(col: Column, words) -> Column:
    """True when any of the literal words occurs in the text."""
    hit = F.lit(False)
    for word in words:
        hit = hit | col.contains(word)
    return hit


def rlike_any(col: Column, patterns) -> Column:
    """One alternation over all patterns, so the text is matched in one expression."""
    return col.rlike("|".join(f"(?:{p})" for p in patterns))


def _table(values: dict[str, str]) -> Column:
    return F.from_json(F.lit(json.dumps(values)), "map<string,string>")


def _character(code: Column) -> Column:
    """Character of a numeric reference; numbers that are none have the replacement character or nothing."""
    nothing = code.between(1, 8) | (code == 0xB) | code.between(0xE, 0x1F) | (code == 0x7F) | code.between(0xFDD0, 0xFDEF)
    nothing = nothing | (code.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    return (
        F.when((code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF), "�")
        .when(code.between(0x80, 0x9F), F.get(F.array(*map(F.lit, C1)), (code - 0x80).cast("int")))
        .when(nothing, "")
        .otherwise(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
    )


def _numeric(piece: Column) -> Column:
    """What follows '&' where a '#' comes next: the character, and the rest."""

    def decoded(written: Column) -> Column:
        digits = F.regexp_extract(written, "([0-9a-fA-F]+);?$", 1)
        base = F.when(F.lower(F.substring(written, 2, 1)) == "x", 16).otherwise(10)
        short = F.ltrim(digits, F.lit("0"))
        conv = lambda n: F.conv(short, n, 10).cast("bigint")
        code = F.when(short == "", 0).when(F.length(short) > 8, 0x110000).otherwise(F.when(base == 16, conv(16)).otherwise(conv(10)))
        rest = F.substr(piece, F.length(written) + 1)
        return F.when(written == "", F.concat(F.lit("&"), piece)).otherwise(let(code, lambda c: F.concat(_character(c), rest)))

    return let(F.regexp_extract(piece, "^(#(?:[0-9]+|[xX][0-9a-fA-F]+);?)", 1), decoded)


def _named(piece: Column) -> Column:
    """What follows '&' where a name comes next: the longest known name's characters, and the rest."""

    def decoded(name: Column) -> Column:
        exact = F.try_element_at(_table(html5), name)
        starts = [F.substring(name, 1, n) for n in range(6, 1, -1)]
        begun = [F.when(F.length(name) > n, F.try_element_at(_table(OPEN_REFERENCES), s)) for n, s in zip(range(6, 1, -1), starts)]
        # '&' and the name stay where nothing is known.
        found = [F.concat(c, F.substr(piece, F.lit(n + 1))) for n, c in zip(range(6, 1, -1), begun)]
        return F.coalesce(F.concat(exact, F.substr(piece, F.length(name) + 1)), *found, F.concat(F.lit("&"), piece))

    return let(F.regexp_extract(piece, "^([^\\t\\n\\f <#;]{1,32}+;?)", 1), decoded)


def decode_entities(col: Column) -> Column:
    """Decode all named and numeric character references, in the JVM, as the page reader does.

    The text is split at '&' once; each piece behind one begins with a reference or not.
    """

    def one(piece: Column, i: Column) -> Column:
        out = F.when(i == 0, piece)
        for name in COMMON_REFERENCES:
            out = out.when(piece.startswith(name), F.concat(F.lit(html5[name]), F.substr(piece, F.lit(len(name) + 1))))
        out = out.when(piece.startswith("#"), _numeric(piece))
        return out.when(piece.rlike("^[A-Za-z]"), _named(piece)).otherwise(F.concat(F.lit("&"), piece))

    def decoded(text: Column) -> Column:
        return F.array_join(F.transform(F.split(text, "&"), one), "")

    return let(col, lambda text: F.when(text.contains("&"), decoded(text)).otherwise(text))
