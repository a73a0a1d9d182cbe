"""Text and number clean-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from arrears_mart.schemas import MONEY, NULL_WORDS

# The characters Python's str.strip() removes; Spark's trim removes the space only.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Any character that is not one of them, and one of them at either end.
_VISIBLE = r"(?U)[^\s\x1c-\x1f]"
_WHITE_END = r"(?U)^[\s\x1c-\x1f]|[\s\x1c-\x1f]\z"


def strip(text: Column) -> Column:
    """Remove Unicode whitespace at both ends; text without any, the usual case, is only looked at."""
    return F.when(text.rlike(_WHITE_END), F.trim(text, F.lit(WHITESPACE))).otherwise(text)


def has_text(text: Column) -> Column:
    """True where something other than whitespace is present; never null."""
    return F.coalesce(text.rlike(_VISIBLE), F.lit(False))


def blank_to_null(text: Column) -> Column:
    """Null for missing or blank text; other text is kept as it is, untrimmed."""
    return F.when(text.rlike(_VISIBLE), text)


def clean_key(text: Column) -> Column:
    """A join key without outer whitespace and without the `.0` a spreadsheet adds to numbers."""
    return F.regexp_replace(strip(text), r"\.0+$", "")


def digits_only(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def stripped(text: Column) -> Column:
    """Text without outer whitespace, null where nothing is left."""
    return F.nullif(strip(text), F.lit(""))


def join_words(*texts: Column) -> Column:
    """The non-blank texts joined with single spaces; `''` when all are blank."""
    joined = F.concat_ws(" ", *[stripped(t) for t in texts])
    return strip(F.regexp_replace(joined, r"(?U)\s+", " "))


def join_parts(*texts: Column) -> Column:
    """The non-blank texts without outer whitespace, joined with single spaces; blanks inside a text stay."""
    return F.concat_ws(" ", *[stripped(t) for t in texts])


def first_present(*texts: Column) -> Column:
    """The first text that is not blank."""
    return F.coalesce(*[blank_to_null(t) for t in texts])


def closing_code(first: Column, second: Column) -> Column:
    """The second pre-closing code if there is one, else the first, both without outer whitespace."""
    return F.coalesce(stripped(second), stripped(first))


def null_words_to_null(text: Column) -> Column:
    """Null for the words a CSV reader takes for a missing value."""
    return F.when(~text.isin(*NULL_WORDS), text)


def parse_money(text: Column) -> Column:
    return strip(text).try_cast(MONEY)
