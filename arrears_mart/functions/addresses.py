"""Free-text addresses and postal codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from arrears_mart.functions.text import digits_only, strip

# The patterns that split `<street> No <number> [Int <unit>] <district> CP <code>`.
_EXACT = "(?dU)"
_ANY_CASE = "(?idU)"
_POSTAL_LABEL = r"\bC\.?\s*P\.?\s*"
_NUMBER_LABEL = r"\bNo\.?\s+"
_UNIT_LABEL = r"\bInt\.?\s+"
_FIVE_DIGITS = r"\b(\d{5})\b"
ADDRESS_PATTERNS = {
    "labelled_code": _ANY_CASE + _POSTAL_LABEL + r"(\d{5})\b",
    "bare_code": _EXACT + _FIVE_DIGITS,
    "number": _ANY_CASE + _NUMBER_LABEL + r"(\d\S*)",
    "unit": _ANY_CASE + _UNIT_LABEL + r"(\S+)",
    "street": _ANY_CASE + r"^(.*?)\s+No\.?\s+\d",
    "has_number": _ANY_CASE + _NUMBER_LABEL + r"\d",
    "through_number": _ANY_CASE + r"^.*?" + _NUMBER_LABEL + r"\d\S*\s*",
    "unit_part": _ANY_CASE + _UNIT_LABEL + r"\S+\s*",
    "from_labelled_code": _ANY_CASE + _POSTAL_LABEL + r"\d{5}.*$",
    "from_bare_code": _EXACT + _FIVE_DIGITS + r".*$",
}
ADDRESS_PARTS = ("CALLE", "NUMERO_EXTERIOR", "NUMERO_INTERIOR", "COLONIA", "CODIGO_POSTAL")


def _find(text: Column, pattern: str) -> Column:
    return F.regexp_extract(text, ADDRESS_PATTERNS[pattern], 1)


def _cut(text: Column, *patterns: str) -> Column:
    for pattern in patterns:
        text = F.regexp_replace(text, ADDRESS_PATTERNS[pattern], "")
    return text


def split_address(address: Column) -> dict[str, Column]:
    """Street, outer and inner number, district and postal code; a part that is not recognised is null."""
    text = strip(F.coalesce(address, F.lit("")))
    numbered = text.rlike(ADDRESS_PATTERNS["has_number"])
    before_code = _cut(text, "from_labelled_code", "from_bare_code")
    after_number = _cut(text, "through_number", "unit_part", "from_labelled_code", "from_bare_code")
    parts = (
        strip(F.when(numbered, _find(text, "street")).otherwise(before_code)),
        _find(text, "number"),
        _find(text, "unit"),
        strip(F.when(numbered, after_number)),
        F.coalesce(F.nullif(_find(text, "labelled_code"), F.lit("")), _find(text, "bare_code")),
    )
    # No part has outer whitespace, so only empty ones are missing.
    return {name: F.nullif(part, F.lit("")) for name, part in zip(ADDRESS_PARTS, parts)}


def postal_code(text: Column) -> Column:
    """The last five digits of a text with at least five."""
    digits = digits_only(text)
    return F.when(F.length(digits) >= 5, F.right(digits, F.lit(5)))


def pad_postal_code(text: Column) -> Column:
    """Left-pad to five characters; longer codes stay whole."""
    code = strip(text)
    return F.when(F.length(code) < 5, F.lpad(code, 5, "0")).otherwise(code)
