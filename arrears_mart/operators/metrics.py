"""Counts of a run: processed, consolidated, new, excluded, flagged, and coverage of each source."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrears_mart.functions.text import clean_key
from arrears_mart.schemas import ARREARS, CLEANED_KEYS, CLIENTS, CONTACTS, TEXT, ZONES
from arrears_mart.sources.headers import ensure_columns

POSSIBLE_KEYS = T.StructType([T.StructField(k, TEXT) for k in CLEANED_KEYS])

# Sources whose coverage is reported, with the key they are matched by and the run count that holds it.
COVERED = (
    (CLIENTS, "NO_DAMA", "CRUCE_CLIENTES"),
    (ZONES, "ZONA", "CRUCE_ZONAS"),
    (ARREARS, "NO_DAMA", "CRUCE_MORA"),
    (CONTACTS, "NO_DAMA", "CRUCE_GESTIONES"),
)


def count_matches(master: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """One row: how many master rows have a key the source has, both keys cleaned; 0 if the source has no such column.

    Master rows are counted per key first, so a key with many rows is one row in the join.
    """
    mine = master.groupBy(clean_key(F.col(key)).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    theirs = ensure_columns(source, POSSIBLE_KEYS).select(clean_key(F.col(key)).alias("_k")).na.drop().distinct()
    return mine.join(theirs, "_k", "left_semi").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("CRUZARON"))


def coverage(master: DataFrame, sources: dict[str, DataFrame]) -> DataFrame:
    """The same shares for any master and sources, such as a published one: keys are matched anew."""
    total = F.greatest(master.agg(F.count(F.lit(1))).scalar(), F.lit(1))
    rows = None
    for name, key, _ in COVERED:
        matched = count_matches(master, sources[name], key)
        row = matched.select(
            F.lit(name).alias("FUENTE"), "CRUZARON", (F.lit(100.0) * F.col("CRUZARON") / total).alias("PORCENTAJE")
        )
        rows = row if rows is None else rows.unionByName(row)
    return rows


#: The struct that holds what each covered source gave a row in the builds' joins, by the run count it is reported as.
_JOINED = {"CRUCE_CLIENTES": "CLI", "CRUCE_ZONAS": "ZON", "CRUCE_MORA": "MORA", "CRUCE_GESTIONES": "GES"}


def match_flags() -> dict[str, Column]:
    """Whether each covered source had a row's key, seen from the join that was made with it."""
    return {count: F.col(struct).isNotNull() for count, struct in _JOINED.items()}


def matches(kept: Column) -> dict[str, Column]:
    """The number of kept rows that each covered source matched, as aggregates over rows with `match_flags`."""
    return {count: F.count_if(kept & F.col(count)) for _, _, count in COVERED}


def coverage_of_run(counts: DataFrame) -> DataFrame:
    """Matched rows and their share of the master for each covered source, from the run counts; no source is read."""
    total = F.greatest(F.col("REG_CONSOLIDADOS"), F.lit(1))
    rows = [
        F.struct(F.lit(name).alias("FUENTE"), F.col(count).alias("CRUZARON"), (F.lit(100.0) * F.col(count) / total).alias("PORCENTAJE"))
        for name, _, count in COVERED
    ]
    return counts.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


def run_totals(rows: DataFrame, aggregates: dict[str, Column], write: Callable[[DataFrame], DataFrame] | None) -> tuple[DataFrame, DataFrame]:
    """`rows`, and one row with their aggregates.

    With `write`, which stores the rows, the aggregates are observed while it writes and nothing is read again; without,
    they are one pass over the rows. Spark adds up what a task saw once it has succeeded, so a task that is repeated
    counts once.
    """
    named = [c.alias(n) for n, c in aggregates.items()]
    if write is None:
        return rows, rows.agg(*named)
    seen = Observation(f"totals-{uuid.uuid4().hex}")
    stored = write(rows.observe(seen, *named))
    return stored, rows.sparkSession.range(1).select(*[F.lit(seen.get[n]).alias(n) for n in aggregates])


def counted(df: DataFrame, step: str, counts: dict[str, Observation] | None, rows: Column | None = None) -> DataFrame:
    """`df`, which also counts its rows, or what `rows` counts, under `step` while it is written; as it is if nobody asks."""
    if counts is None:
        return df
    counts[step] = Observation(step)
    return df.observe(counts[step], (F.count(F.lit(1)) if rows is None else rows).alias("FILAS"))
