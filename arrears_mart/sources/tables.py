"""Readers and typed staging."""

from __future__ import annotations

import functools

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrears_mart.functions.dates import parse_clock, parse_date
from arrears_mart.functions.text import null_words_to_null, parse_money
from arrears_mart.schemas import (
    MANDATORY_SOURCES,
    PHASE2_SCHEMAS,
    SOURCE_SCHEMAS,
)
from arrears_mart.sources import quoted as Q
from arrears_mart.sources.headers import ensure_columns, normalise_source


_TOO_MANY = "_too_many"  # takes the first field beyond the header's
#: An empty field stays empty here, so that only a field that is not there is null.
_FORM = {"quote": '"', "escape": '"', "nullValue": "\x01", "emptyValue": ""}


def _csv(spark: SparkSession, multi_line: bool) -> DataFrameReader:
    return spark.read.options(**_FORM, multiLine=multi_line, header=True)


def _schema(header: tuple[str, ...]) -> T.StructType:
    return T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(header))]).add(_TOO_MANY, T.StringType())


def _fields(rows: DataFrame, header: tuple[str, ...]) -> DataFrame:
    refusal = F.raise_error(F.concat(F.lit("a row has more fields than its header: "), F.coalesce("c0", F.lit(""))))
    rows = rows.where(F.when(F.col(_TOO_MANY).isNull(), F.lit(True)).otherwise(refusal.cast("boolean")))
    return rows.select(*[null_words_to_null(F.col(f"c{i}")).alias(name) for i, name in enumerate(header)])


def _csv_of_one_header(spark: SparkSession, files: list[str], header: tuple[str, ...], multi_line: bool) -> DataFrame:
    return _fields(_csv(spark, multi_line).schema(_schema(header)).csv(files), header)


def _csv_of_records(spark: SparkSession, files: list[str], header: tuple[str, ...], facts: DataFrame) -> DataFrame:
    """Rows of files with line breaks inside quotes, by as many tasks as the files have byte ranges."""
    own = facts.join(F.broadcast(spark.createDataFrame([(f,) for f in files], "file string")), "file")  # the listed files
    text = Q.records(spark, files, own)
    parsed = F.from_csv("record", _schema(header).simpleString()[len("struct<") : -1].replace(":", " "), {**_FORM, "multiLine": "true"})
    return _fields(text.select(parsed.alias("f")).select("f.*"), header)


def read_csv_text(spark: SparkSession, path: str, multi_line: bool | None = None) -> DataFrame:
    """A CSV file or folder with every column as text, null words as null, canonical names and clean keys.

    Every file is read by its own header and files with different headers are united by column name; a column that a
    file does not have is null in its rows. Fields missing at the end of a row are null. A row with more fields than its
    header ends the job instead of losing them.

    One pass over all files finds their headers and counts their quotes. Files without a line break inside quotes are read
    line by line, the others are cut at the true ends of their records (`quoted`); both by many tasks a file. What counting
    cannot cut is read by one task a file, which turns a carriage return and line feed inside quotes into a line feed:
    quotes that do not pair up, and carriage returns as line ends. `multi_line` is
    for known files: True reads every file by one task, False says that no quotes hold a line break.
    """
    facts = Q.range_facts(spark, path)
    groups: dict[tuple[tuple[str, ...], str], list[str]] = {}
    for file in Q.file_facts(facts, spark.conf.get("spark.sql.caseSensitive") == "true"):
        header = file.header or tuple(_csv(spark, True).csv(file.path).columns)
        way = "lines" if file.split else "records" if file.quoted else "whole"
        if multi_line is not None:
            way = "whole" if multi_line else "lines"
        if header:
            groups.setdefault((header, way), []).append(file.path)
    parts = []
    for (header, way), files in groups.items():
        rows = _csv_of_records(spark, files, header, facts) if way == "records" else _csv_of_one_header(spark, files, header, way == "whole")
        parts.append(normalise_source(rows))
    if not parts:
        return spark.createDataFrame([], T.StructType([]))
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_sources(
    spark: SparkSession,
    folder: str,
    names: tuple[str, ...] = MANDATORY_SOURCES,
    file_format: str = "csv",
    **options: object,
) -> dict[str, DataFrame]:
    """Every source found as `<folder>/<name>.<file_format>`; those that are not there are left out, and so are rows
    without a single value.

    `options` go to the reader: `multi_line` for CSV, the format's own options otherwise.
    """
    found = {}
    for name in names:
        path = f"{folder}/{name}.{file_format}"
        try:
            if file_format == "csv":
                found[name] = drop_empty_rows(read_csv_text(spark, path, **options))
            else:
                found[name] = drop_empty_rows(normalise_source(spark.read.format(file_format).options(**options).load(path)))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return found


def drop_empty_rows(df: DataFrame) -> DataFrame:
    return df.na.drop("all") if df.columns else df


def _typed(column: Column, given: T.DataType, wanted: T.DataType) -> Column:
    if given == wanted:
        return column
    if isinstance(given, T.StringType):
        if isinstance(wanted, T.DecimalType):
            return parse_money(column)
        if isinstance(wanted, T.DateType):
            return parse_date(column)
        if isinstance(wanted, T.TimestampNTZType):
            return parse_clock(column)
    return column.try_cast(wanted) if not isinstance(given, T.NullType) else F.lit(None).cast(wanted)


def typed_scan(df: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns of `schema`, parsed where they are text (bad values become null), plus those to `keep`.

    Missing columns are null. Every other column is left behind here, so it is never read from the file.
    """
    full = ensure_columns(df, schema)
    typed = [_typed(F.col(f.name), full.schema[f.name].dataType, f.dataType).alias(f.name) for f in schema]
    return full.select(*typed, *[c for c in keep if c in df.columns])


def typed_sources(sources: dict[str, DataFrame], arrival: str | None = None) -> dict[str, DataFrame]:
    keep = (arrival,) if arrival else ()
    return {name: typed_scan(sources[name], schema, keep) for name, schema in SOURCE_SCHEMAS.items()}


def phase2_scan(df: DataFrame, name: str) -> DataFrame:
    """Typed scan of a payments, visits or reminders table."""
    return typed_scan(df, PHASE2_SCHEMAS[name])
