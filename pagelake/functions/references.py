"""Character references of HTML text (``&eacute;``, ``&#8217;``, ``&#x27;``), decoded by column expressions.

The names are those of the standard library's table. One split at ``&`` per text; each part then looks up its own
reference in a two-level map, so the work does not grow with the number of names. As in browsers, some old names
count without their semicolon, by the longest one that fits; numbers that name no character give U+FFFD or nothing.
"""

from __future__ import annotations

import json
from functools import cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters of a name that choose its part of the map.
LEAD = 2


@cache
def _tables() -> tuple[str, str]:
    """The names by their first characters as JSON, and a pattern of those that need no semicolon, longest first."""
    parts: dict[str, dict[str, str]] = {}
    for name, text in html5.items():
        parts.setdefault(name[:LEAD], {})[name] = text
    bare = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
    return json.dumps(parts), "^(?:" + "|".join(bare) + ")"


@cache
def _windows() -> str:
    """Characters that the numbers 128 to 159 stand for, as JSON."""
    return json.dumps({str(n): bytes([n]).decode("cp1252", "replace").replace("�", chr(n)) for n in range(0x80, 0xA0)})


def _named(name: Column) -> Column:
    names = F.from_json(F.lit(_tables()[0]), "map<string, map<string, string>>")
    return F.try_element_at(F.try_element_at(names, F.substring(name, 1, LEAD)), name)


def _numbered(digits: Column, base: int) -> Column:
    """The character of a number, as browsers read it."""
    short = F.regexp_replace(digits, "^0+", "")
    # (eight digits are beyond the last character, which has seven)
    n = F.when(F.length(short) > 8, 1 << 40).otherwise(F.conv(F.when(short == "", "0").otherwise(short), base, 10).cast("bigint"))
    one = F.transform(
        F.array(n),
        lambda n: F.when((n == 0) | ((n >= 0xD800) & (n <= 0xDFFF)) | (n > 0x10FFFF), "�")
        .when(n == 13, "\r")
        .when((n >= 0x80) & (n <= 0x9F), F.try_element_at(F.from_json(F.lit(_windows()), "map<string, string>"), n.cast("string")))
        .when(((n >= 1) & (n <= 8)) | (n == 11) | ((n >= 14) & (n <= 31)) | (n == 127) | ((n >= 0xFDD0) & (n <= 0xFDEF)) | (n % 65536 >= 0xFFFE), "")
        .otherwise(F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")),
    )
    return F.get(one, F.lit(0))


def _part(p: Column) -> Column:
    """What follows an ampersand, with its reference decoded; with the ampersand again where it begins none."""
    number = F.regexp_extract(p, "^#([0-9]+);?", 1)
    hexed = F.regexp_extract(p, "^#[xX]([0-9a-fA-F]+);?", 1)
    name = F.regexp_extract(p, r"^[^\t\n\f <&#;]{1,32};", 0)
    bare = F.regexp_extract(p, _tables()[1], 0)
    return (
        F.when(number != "", F.concat(_numbered(number, 10), F.regexp_replace(p, "^#[0-9]+;?", "")))
        .when(hexed != "", F.concat(_numbered(hexed, 16), F.regexp_replace(p, "^#[xX][0-9a-fA-F]+;?", "")))
        .when((name != "") & _named(name).isNotNull(), F.concat(_named(name), F.substr(p, F.length(name) + 1)))
        .when(bare != "", F.concat(_named(bare), F.substr(p, F.length(bare) + 1)))
        .otherwise(F.concat(F.lit("&"), p))
    )


def unescape(text: Column) -> Column:
    """The text with its character references decoded; null stays null."""
    parts = F.transform(F.split(text, "&"), lambda p, i: F.when(i == 0, p).otherwise(_part(p)))
    return F.when(F.contains(text, F.lit("&")), F.array_join(parts, "")).otherwise(text)
