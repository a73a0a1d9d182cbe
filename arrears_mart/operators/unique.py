"""One row per key, and the rows that lost.

Both are plain aggregations, so every task first reduces its own rows: a key that holds a third of the table
reaches the shuffle as one row per task. The key is also known to the optimiser to be unique, which lets it drop
a left join whose columns nobody reads.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Discarded rows of one group are written by several tasks when there are more of them than this.
_COPIES_PER_TASK = 100_000


def ranked_row(order: Sequence[str], payload: Sequence[str], arrival: str | None = None) -> Column:
    """A row as a struct whose maximum is the row with the greatest `order` values, nulls last.

    Ties go to the lowest `arrival` (a numeric column with the file order, if the source has one) and then to the
    greatest `payload`, so the choice depends on content and never on where Spark put a row.
    """
    first_come = [(-F.col(arrival).cast("bigint")).alias("_arrival")] if arrival else []
    rest = [c for c in payload if c not in order]
    return F.struct(*order, *first_come, *rest)


def latest_row_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = (),
    payload: Sequence[str] | None = None,
    arrival: str | None = None,
    name: str = "_best",
) -> DataFrame:
    """The keys and the latest row of each as one struct column, which later joins copy as one value."""
    if payload is None:
        payload = [c for c in df.columns if c not in keys]
    ranked = df.select(*keys, ranked_row(order, payload, arrival).alias("_row"))
    return ranked.groupBy(*keys).agg(F.max("_row").alias(name))


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = (),
    payload: Sequence[str] | None = None,
    arrival: str | None = None,
) -> DataFrame:
    """One row per key: the latest by `order` (descending, nulls last), else the first one to arrive."""
    columns = [c for c in df.columns if c not in keys] if payload is None else payload
    best = latest_row_per_key(df, keys, order, columns, arrival)
    return best.select(*keys, *[F.col("_best")[c].alias(c) for c in columns])


def first_per_key(
    df: DataFrame, keys: Sequence[str], payload: Sequence[str] | None = None, arrival: str | None = None
) -> DataFrame:
    """One row per key for a lookup table."""
    return latest_per_key(df, keys, (), payload, arrival)


def discarded_rows(df: DataFrame, kept: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`columns` of the rows of `df` that are not in `kept`, a subset of its rows; copies stay separate rows.

    Rows are counted, the kept ones are taken off, and what is left is repeated. Nothing is ranked within a key.
    """
    total = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    minus = kept.select(*columns, F.lit(-1).cast("bigint").alias("_n"))
    left = total.unionByName(minus).groupBy(*columns).agg(F.sum("_n").alias("_n")).filter("_n > 0")
    return repeat_rows(left, "_n")


def grouped_rows(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    order: Sequence[str],
    payload: Sequence[str] | None = None,
    arrival: str | None = None,
) -> DataFrame:
    """`columns`, which include `keys`, with `_n`, the number of rows, `_best`, the best of them, and whether that is the one
    that `latest_per_key` keeps, `_kept`. One reading of `df` serves both `kept_rows` and `rows_not_kept`.

    Rows are first counted and reduced to their best one per distinct `columns`, with a map-side part; what is then sorted
    by key is one row for each of these. `payload` must hold the other `columns`, so that no two best rows are equal.
    """
    if payload is None:
        payload = [c for c in df.columns if c not in keys]
    best = F.max(ranked_row(order, payload, arrival)).alias("_best")
    grouped = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"), best)
    return grouped.withColumn("_kept", F.col("_best") == F.max("_best").over(Window.partitionBy(*keys)))


def kept_rows(grouped: DataFrame, keys: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """The row of each key that is kept."""
    return grouped.filter("_kept").select(*keys, *[F.col("_best")[c].alias(c) for c in payload])


def rows_not_kept(grouped: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`columns` of all other rows; copies stay separate rows."""
    left = grouped.select(*columns, (F.col("_n") - F.col("_kept").cast("bigint")).alias("_n")).filter("_n > 0")
    return repeat_rows(left, "_n")


def rows_not_latest(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Sequence[str], arrival: str | None = None
) -> DataFrame:
    """`columns`, which include `keys`, of all rows but the one `latest_per_key` keeps, from one reading of `df`."""
    return rows_not_kept(grouped_rows(df, keys, columns, order, arrival=arrival), columns)


def repeat_rows(df: DataFrame, times: str) -> DataFrame:
    """Each row as often as `times` says; the copies of a row with very many are spread over tasks.

    The number of tasks is stated, because adaptive execution sees only the few bytes before the copying and would
    put them into one task.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    few = df.filter(F.col(times) <= _COPIES_PER_TASK)
    many = df.filter(F.col(times) > _COPIES_PER_TASK)
    whole, rest = F.expr(f"{times} div {_COPIES_PER_TASK}"), F.col(times) % _COPIES_PER_TASK
    chunk = F.explode(F.sequence(F.lit(0).cast("bigint"), whole)).alias("_chunk")
    chunks = many.select("*", whole.alias("_whole"), rest.alias("_rest")).select("*", chunk)
    size = F.when(F.col("_chunk") < F.col("_whole"), F.lit(_COPIES_PER_TASK).cast("bigint")).otherwise(F.col("_rest"))
    spread = chunks.withColumn(times, size).repartition(tasks, *[c for c in df.columns if c != times], "_chunk")
    return _explode_copies(few, times).unionByName(_explode_copies(spread.select(*df.columns), times))


def _explode_copies(df: DataFrame, times: str) -> DataFrame:
    kept = [c for c in df.columns if c != times]
    copies = F.explode(F.array_repeat(F.lit(True), F.col(times).cast("int"))).alias("_copy")
    return df.select(*kept, copies).select(*kept)
