"""HTML character references as column expressions, by the rules of HTML 5.

References are cut out, resolved one by one and put back between the pieces of text around them. Named ones are looked up
in the standard's table, which Python's library holds; of those that browsers accept without a semicolon the longest
prefix counts. Numbers follow the standard's replacements.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from functools import cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from paylens.functions.expr import let, lookup

REFERENCE = r"&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
LEGACY = max(len(name) for name in html5 if not name.endswith(";"))
MOST = 0x10FFFF
COMMON = {name: html5[name] for name in ("lt;", "gt;", "amp;", "quot;", "nbsp;", "apos;")}  # nearly all of a posting's


@cache
def _table(legacy: bool) -> str:
    """Two levels, by the first character and by the rest, as look-ups in a map are linear."""
    levels: dict[str, dict[str, str]] = {}
    for name, text in html5.items():
        if not legacy or not name.endswith(";"):
            levels.setdefault(name[0], {})[name[1:]] = text
    return json.dumps(levels)


def _named(name: Column, legacy: bool = False) -> Column:
    levels = F.from_json(F.lit(_table(legacy)), "map<string,map<string,string>>")  # folded to a constant
    return F.try_element_at(F.try_element_at(levels, F.substring(name, 1, 1)), F.substr(name, F.lit(2)))


def _any(value: Column, spans: Iterable[tuple[int, int]]) -> Column:
    found = F.lit(False)
    for low, high in spans:
        found = found | value.between(low, high)
    return found


def _character(code: Column) -> Column:
    """The text of a number: C1 controls are read as Windows-1252, other controls and non-characters vanish."""
    c1 = [bytes([b]).decode("cp1252") if bytes([b]).decode("cp1252", "ignore") else chr(b) for b in range(0x80, 0xA0)]
    plain = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return (F.when(_any(code, [(0, 0), (0xD800, 0xDFFF), (MOST + 1, 2**31)]), "�").when(code == 13, "\r")
            .when(code.between(0x80, 0x9F), F.get(F.array(*map(F.lit, c1)), (code - 0x80).cast("int")))
            .when(_any(code, [(0x1, 0x8), (0xB, 0xB), (0xE, 0x1F), (0x7F, 0x7F), (0xFDD0, 0xFDEF)])
                  | (F.pmod(code, F.lit(0x10000)) >= 0xFFFE), "").otherwise(plain))


def _number(digits: Column, base: int, longest: int) -> Column:
    """Numbers beyond the last code point are cut off there."""
    short = F.regexp_replace(digits, "^0+", "")
    return F.when(short == "", 0).when(F.length(short) > longest, MOST + 1).otherwise(
        F.conv(F.when(F.length(short) <= longest, short).otherwise("0"), base, 10).cast("bigint"))


def _resolved(name: Column) -> Column:
    """The text of a reference given without its ampersand."""
    hexadecimal = F.regexp_extract(name, "^#[xX]([0-9a-fA-F]+)", 1)
    decimal = F.regexp_extract(name, "^#([0-9]+)", 1)
    prefixes = [F.when(F.length(name) > k, F.concat(_named(F.substring(name, 1, k), True), F.substr(name, F.lit(k + 1))))
                for k in range(LEGACY, 1, -1)]
    rare = (F.when(hexadecimal != "", let(_number(hexadecimal, 16, 6), _character))
            .when(decimal != "", let(_number(decimal, 10, 7), _character))
            .otherwise(F.coalesce(_named(name), *prefixes, F.concat(F.lit("&"), name))))
    return F.coalesce(lookup(COMMON, name), rare)


def unescape(text: Column) -> Column:
    """The text with all references resolved once."""
    between = F.split(text, REFERENCE, -1)
    found = F.transform(F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(1)), _resolved)
    joined = let(between, lambda b: F.concat(F.get(b, F.lit(0)), F.array_join(F.zip_with(
        found, F.slice(b, F.lit(2), F.size(b)), lambda x, y: F.concat(x, y)), "")))
    return F.when(text.contains("&"), joined).otherwise(text)
