"""Text cleaning and literal label matching."""

from __future__ import annotations

import re
from itertools import groupby

from pyspark.sql import Column
from pyspark.sql import functions as F

from paylens.functions import entities
from paylens.functions import vocab as v
from paylens.functions.expr import blank, col, let, lookup


def unescape(text: str | Column, passes: int = 1) -> Column:
    """Resolve HTML entities."""
    text = col(text)
    for _ in range(passes):
        text = entities.unescape(text)
    return text


def strip_html(text: str | Column, unescape_passes: int = 1) -> Column:
    """Plain text of escaped HTML: entities, then tags to spaces, then collapsed whitespace.

    Some boards escape twice; ``unescape_passes=2`` also resolves the inner level.
    """
    plain = F.regexp_replace(unescape(blank(col(text)), unescape_passes), "<[^>]+>", " ")
    return F.trim(F.regexp_replace(plain, r"(?U)[\s\x1c-\x1f]+", " "))


def canonical(raw: str | Column, catalog: dict[str, list[str]] = v.SKILLS) -> Column:
    """Canonical name of a raw label by exact, case-insensitive match, white space around it aside, else NULL."""
    return lookup(v.alias_map(catalog), F.lower(F.regexp_replace(col(raw), r"(?U)^\s+|\s+$", "")))


def clean_labels(labels: str | Column, catalog: dict[str, list[str]] = v.SKILLS) -> Column:
    """Canonical, distinct and sorted labels of an array; unknown ones are dropped, NULL stays NULL."""
    known = F.filter(F.transform(col(labels), lambda x: canonical(x, catalog)), lambda x: x.isNotNull())
    return F.array_sort(F.array_distinct(known))


def add_implied(labels: str | Column, implied: dict[str, list[str]] = v.IMPLIED_SKILLS) -> Column:
    """Add what a label implies, such as the language of a framework."""
    extra = F.create_map(*[x for k, names in implied.items()
                           for x in (F.lit(k), F.array(*[F.lit(n) for n in names]))])
    empty = F.array().cast("array<string>")
    return let(col(labels), lambda ls: F.array_sort(F.array_union(ls, F.flatten(
        F.transform(ls, lambda x: F.coalesce(F.try_element_at(extra, x), empty))))))


def _bounded(name: str) -> str:
    """Literal name with a word boundary on each side that is alphanumeric ('C++', '.NET')."""
    return (r"\b" if name[:1].isalnum() else "") + _literal(name) + (r"\b" if name[-1:].isalnum() else "")


def _literal(name: str) -> str:
    return re.sub(r"([^\w\s])", r"\\\1", name)


def mention_pattern(label: str, catalog: dict[str, list[str]]) -> str:
    return v.anywhere([_bounded(n) for n in (label, *catalog.get(label, []))])


def mentions(label: str, text: str | Column, catalog: dict[str, list[str]] = v.SKILLS) -> Column:
    """Does the label or one of its aliases occur literally?"""
    return blank(col(text)).rlike(mention_pattern(label, catalog))


def _all_names_pattern(names: list[str]) -> str:
    """One pattern giving the longest name that starts at each position; names are grouped by first character."""
    def branch(group: list[str]) -> str:
        tails = [_literal(n[1:]) + (r"\b" if n[-1].isalnum() else "") for n in sorted(group, key=len, reverse=True)]
        return _literal(group[0][0]) + v.any_of(tails)

    def side(chosen: list[str]) -> str:
        return v.any_of([branch(list(g)) for _, g in groupby(sorted(chosen), key=lambda n: n[0])])

    words = [n for n in names if n[0].isalnum()]
    marks = [n for n in names if not n[0].isalnum()]
    sides = ([r"\b" + side(words)] if words else []) + ([side(marks)] if marks else [])
    return rf"{v.FLAGS}(?=({v.any_of(sides)}))"


def _owners(aliases: dict[str, str], whole: dict[str, set[str]]) -> dict[str, list[str]]:
    """Every label mentioned when ``name`` is: its own, and those of names that are a bounded prefix of it."""
    def bounded_prefix(short: str, long: str) -> bool:
        rest = long[len(short):]
        if not long.startswith(short):
            return False
        return not rest or not short[-1].isalnum() or not (rest[0].isalnum() or rest[0] == "_")
    return {name: sorted(set().union(*[whole[s] for s in aliases if bounded_prefix(s, name)])) for name in aliases}


def literal_mentions(text: str | Column, catalog: dict[str, list[str]] = v.SKILLS) -> Column:
    """Sorted labels of the whole catalogue that occur literally in the whole text, found in one scan.

    A look-ahead visits every position, so overlapping names ("gitlab" inside "gitlab ci") all count.
    """
    whole: dict[str, set[str]] = {}
    for label, others in catalog.items():
        for name in (label, *others):
            whole.setdefault(name.casefold(), set()).add(label)
    aliases = {name: name for name in whole}
    owners = _owners(aliases, whole)
    table = F.create_map(*[x for name, labels in owners.items()
                           for x in (F.lit(name), F.array(*[F.lit(n) for n in labels]))])
    found = F.array_distinct(F.transform(
        F.regexp_extract_all(blank(col(text)), F.lit(_all_names_pattern(list(owners))), F.lit(1)),
        lambda m: F.lower(F.upper(m))))
    empty = F.array().cast("array<string>")
    return F.array_sort(F.array_distinct(F.flatten(
        F.transform(found, lambda m: F.coalesce(F.try_element_at(table, m), empty)))))


def grounded(labels: str | Column, text: str | Column, catalog: dict[str, list[str]] = v.SKILLS) -> Column:
    """Predicted labels that the text really mentions."""
    return F.array_sort(F.array_intersect(col(labels), literal_mentions(text, catalog)))


def ungrounded(labels: str | Column, text: str | Column, catalog: dict[str, list[str]] = v.SKILLS) -> Column:
    """Predicted labels that the text never mentions."""
    return F.array_sort(F.array_except(col(labels), literal_mentions(text, catalog)))
