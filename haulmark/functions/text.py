"""Text rules shared by the maintenance reports."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, functions as F

# Names holding one of these, case-sensitively, are left out of the reports.
EXCLUDED_NAME_PARTS = ("GROUP", "AA", "TM", "PRE-TRIP", "WITHOUT", "RETIRED", "MISC")

# Sort keys left out of the reports.
EXCLUDED_SORT_KEYS = ("AUXILIARY", "INFRASTRUCTURE")

# Fixed value: text that stands for a missing value in the source system.
NULL_TEXT = "NULL"

# Spelling of a make -> make it stands for, whole cell, lower case.
MAKE_SPELLINGS = {
    "terex/noel": "terex",
    "terex/noell": "terex",
    "terex noel": "terex",
    "terex noell": "terex",
    "noell": "terex",
    "terex/fantuzzi reggiane": "terex",
    "terex/fantuzzi": "terex",
    "fantuzzi reggiani": "fantuzzi",
    "fantuzzi": "fantuzzi",
    "fantuzzi reggiane": "fantuzzi",
    "chev": "chevrolet",
    "chevrolet": "chevrolet",
    "chevy": "chevrolet",
    "frueha": "fruehauf",
    "fruehauf": "fruehauf",
    "freuhauf": "fruehauf",
    "liebherr-america": "liebherr",
    "maffi": "mafi",
    "sterling/lorain": "sterling",
    "taylor dunn": "taylor",
    "theuer": "theurer",
    "utility enterprise": "utility",
    "tug mfg": "tug",
    "track mobile": "trackmobile",
    "treberg": "terberg",
    "fontai": "fontaine",
}


def _column(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def excludes_all(column: Column | str, parts: Iterable[str] = EXCLUDED_NAME_PARTS) -> Column:
    """True where the text holds none of `parts`; null text gives null, so a filter drops it."""
    column = _column(column)
    hits = [column.contains(part) for part in parts]
    return ~reduce(Column.__or__, hits) if hits else column.isNotNull()


def not_null_text(column: Column | str, marker: str = NULL_TEXT) -> Column:
    """True where the text is neither null nor the null marker."""
    return _column(column) != F.lit(marker)


def strip(column: Column | str) -> Column:
    """Remove blanks, tabs and line breaks at both ends."""
    return F.regexp_replace(_column(column), r"^\s+|\s+$", "")


def normalize_make(column: Column | str, spellings: Mapping[str, str] = MAKE_SPELLINGS) -> Column:
    """Strip, lower and recode a make; an unlisted make stays as it is."""
    cleaned = F.lower(strip(column))
    if not spellings:
        return cleaned
    table = F.create_map(*[F.lit(text) for pair in spellings.items() for text in pair])
    return F.coalesce(F.element_at(table, cleaned), cleaned)


def make_model_key(make: Column | str, model: Column | str) -> Column:
    """`make-model`, null when either is null."""
    return F.concat(_column(make), F.lit("-"), _column(model))
