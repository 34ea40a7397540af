"""List literals held in string columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioforge.functions.binding import bound
from folioforge.functions.text import clean_relevance_text, strip

# Literals other than lists that still stand for one passage: strings, numbers, and tuples, sets
# and dictionaries of these, as far as they are not nested.
_SCALAR = r"""("[^"]*"|'[^']*'|[-+]?[0-9]+(\.[0-9]*)?([eE][-+]?[0-9]+)?|None|True|False)"""
_ENTRY = rf"{_SCALAR}\s*:\s*{_SCALAR}"
_SEVERAL = rf"({_SCALAR}(\s*,\s*{_SCALAR})*\s*,?)"
_ENTRIES = rf"({_ENTRY}(\s*,\s*{_ENTRY})*\s*,?)"
SCALAR_LITERAL = (
    rf"^[ \t]*({_SCALAR}|\(\s*{_SEVERAL}?\s*\)|\{{\s*({_SEVERAL}|{_ENTRIES})?\s*\}})\s*$"
)


def parse_page_list(pages: Column) -> Column:
    """`[1, 2]` -> array('1', '2'); null unless bracketed and all integers."""
    inner = F.split(F.substring(pages, F.lit(2), F.length(pages) - 2), ",")
    numbers = F.transform(inner, lambda p: strip(p).try_cast("int").cast("string"))
    bracketed = pages.startswith("[") & pages.endswith("]") & (F.length(pages) >= 2)
    return bound(
        F.when(bracketed, numbers), lambda ns: F.when(~F.exists(ns, lambda p: p.isNull()), ns)
    )


def pages_zero_based(pages: Column) -> Column:
    """`[1, 2]` -> array('0', '1'), the keys under which pages are stored."""
    return F.transform(
        F.from_json(pages, "array<int>"), lambda p: (p - 1).cast("string")
    )


def zero_based_page_key(page: Column) -> Column:
    """One-based page number as a string -> the key under which it is stored."""
    return (page.try_cast("int") - 1).cast("string")


def _passages_of(text: Column) -> Column:
    # a trailing comma is legal in the source notation but not in JSON
    parsed = F.from_json(F.regexp_replace(text, r",\s*\]\s*$", "]"), "array<string>")
    return F.coalesce(parsed, F.when(text.rlike(SCALAR_LITERAL), F.array(text)))


def parse_passages(passages: Column) -> Column:
    """Annotated passages as an array; null when they cannot be read."""
    found = bound(clean_relevance_text(passages), _passages_of)
    return F.nullif(found, F.array().cast("array<string>"))


def _mended(text: Column) -> Column:
    but_last = F.substring(text, F.lit(1), F.length(text) - 1)
    return (
        F.when(text.rlike(r"^[{\]]"), F.concat(F.lit("["), F.substr(text, F.lit(2))))
        .when(text.rlike(r"[}\[]$"), F.concat(but_last, F.lit("]")))
        .otherwise(text)
    )


def _quoted_items(text: Column) -> Column:
    body = F.substring(text, F.lit(3), F.greatest(F.length(text) - 4, F.lit(0)))
    return F.when(text.startswith("[") & text.endswith("]"), F.split(body, '", ?"'))


def split_passages(passages: Column) -> Column:
    """Split a bracketed list of quoted passages, mending a wrong bracket."""
    return bound(bound(strip(passages), _mended), _quoted_items)
