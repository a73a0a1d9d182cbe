"""Column expressions and small helpers that several corpus operators share."""

from __future__ import annotations

import string
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears_mart.operators.lookups import BROADCAST_BYTES, measured_bytes

#: ASCII white space, the only separators between words.
BLANKS = " \\t\\n\\x0B\\f\\r"


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else; `lower` would change other letters too, so it serves ASCII texts only."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def words(text: Column) -> Column:
    """The runs between ASCII white space; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{BLANKS}]+"), "")


def byte_length(text: Column) -> Column:
    return F.coalesce(F.octet_length(text).cast("long"), F.lit(0).cast("long"))


def row_key(text: Column) -> Column:
    """With the document's id this tells rows apart; equal rows share it, and null and empty texts differ."""
    return F.xxhash64(text, text.isNull())


def named(column: str) -> Column:
    """A column by its name, whatever signs the name holds."""
    return F.col("`" + column.replace("`", "``") + "`")


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, which an operator carries beside its own columns, so that no name can clash."""
    return F.struct(*[named(c) for c in df.columns])


def fields(row: str, names: Sequence[str]) -> list[Column]:
    """Columns of a carried row."""
    return [F.col(row)[c].alias(c) for c in names]


def broadcast_if_small(table: DataFrame) -> DataFrame:
    """The stored table, marked for broadcast if its measured content allows it."""
    return F.broadcast(table) if measured_bytes(table) <= BROADCAST_BYTES else table


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is worked out once, also where `use` names it several times or in a loop."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def scan(items: Column, zero: Column, step: Callable[[Column, Column], tuple[Column, Column]], kind: str, width: int = 256) -> Column:
    """What `step` puts out for each item, as an array of `kind`; it takes the state before and gives the next one with it.

    An array that grows by one item at a time is copied each time. Here parts of `width` items grow, and then an array of
    whole parts, so that an array of 40,000 items costs a few copies and not 40,000.
    """

    def put(a: Column, x: Column) -> Column:
        state, out = step(a["state"], x)
        return F.struct(state.alias("state"), F.concat(a["out"], F.array(out)).alias("out"))

    def part(whole: Column, a: Column, start: Column) -> Column:
        first = F.struct(a["state"].alias("state"), F.array().cast(f"array<{kind}>").alias("out"))
        inner = F.aggregate(F.slice(whole, start + 1, F.lit(width)), first, put)
        return let(inner, lambda i: F.struct(i["state"].alias("state"), F.concat(a["out"], F.array(i["out"])).alias("out")))

    def over(whole: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(whole) - 1, F.lit(0)), F.lit(width))
        first = F.struct(zero.alias("state"), F.array().cast(f"array<array<{kind}>>").alias("out"))
        return F.flatten(F.aggregate(starts, first, lambda a, s: part(whole, a, s), lambda a: a["out"]))

    return let(items, over)


def count_below(items: Column, below: Callable[[Column], Column]) -> Column:
    """How many items of a sorted array come before the first that is not `below`, found by halving."""

    def halve(a: Column, _: Column) -> Column:
        middle = F.floor((a["low"] + a["high"]) / 2).cast("int")
        ahead = (a["low"] < a["high"]) & below(F.get(items, middle))
        return F.when(ahead, F.struct((middle + 1).alias("low"), a["high"].alias("high"))).otherwise(
            F.struct(a["low"].alias("low"), F.greatest(F.least(a["high"], middle), a["low"]).alias("high"))
        )

    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(items) + 1)).cast("int"))
    first = F.struct(F.lit(0).alias("low"), F.size(items).alias("high"))
    return F.aggregate(steps, first, halve, lambda a: a["low"])
