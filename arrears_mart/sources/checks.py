"""Checks made before a build starts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears_mart.functions.text import has_text
from arrears_mart.schemas import KEY_COLUMNS


def missing_sources(sources: dict[str, DataFrame], wanted: Iterable[str]) -> list[str]:
    """Names without a frame, in the order wanted."""
    return [name for name in wanted if sources.get(name) is None]


def missing_tables(spark: SparkSession, tables: Iterable[str]) -> list[str]:
    """Tables the catalogue does not have, in the order given."""
    return [t for t in tables if not spark.catalog.tableExists(t)]


def require_tables(spark: SparkSession, tables: Iterable[str]) -> None:
    missing = missing_tables(spark, tables)
    if missing:
        raise ValueError("Tablas fuente faltantes: " + ", ".join(missing))


def has_usable_key(portfolio: DataFrame) -> bool:
    return not portfolio.filter(has_text(F.col("NO_DAMA"))).isEmpty()


def diagnose(df: DataFrame, source: str) -> DataFrame:
    """One row: rows, columns, key columns that are absent, key columns without a single value."""
    keys = KEY_COLUMNS.get(source, ())
    present = [k for k in keys if k in df.columns]
    absent = [k for k in keys if k not in df.columns]
    empty = [F.when(F.count(k) == 0, F.lit(k)) for k in present]
    return df.agg(
        F.lit(source).alias("FUENTE"),
        F.count(F.lit(1)).alias("FILAS"),
        F.lit(",".join(df.columns)).alias("COLUMNAS"),
        F.lit(",".join(absent)).alias("CLAVES_FALTANTES"),
        F.concat_ws(",", *[F.lit(k) for k in absent], *empty).alias("CLAVES_SIN_DATOS"),
    )
