"""CSV files with line breaks inside quotes, cut into records by many tasks.

A line break ends a record only if an even number of quotes stands before it in the file. Every byte range that Spark
gives a task counts its quotes first; the sums of the ranges before tell whether a range starts inside quotes, and then
every task finds the true ends of records in its own range. Only the pieces of records that lie across ranges, two a range
at most, are exchanged.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arrears_mart.operators.lookups import BROADCAST_BYTES, measured_bytes
from arrears_mart.stages import stage_table

#: What a piece is: a whole record, the end of one from an earlier range, the start of one, or neither end.
_WHOLE, _TAIL, _HEAD, _MIDDLE = range(4)
_PIECES = "file string, start long, kind int, piece string"
_RANGE = ["file", "start"]


def physical_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(file, start, line): the lines between line feeds, with the file and the start of the byte range they begin in.

    A range's lines are consecutive rows of one partition, in order.
    """
    lines = spark.read.option("lineSep", "\n").text(paths)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line"))


def _quotes(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))


def range_facts(spark: SparkSession, path: str) -> DataFrame:
    """Stored, one row a byte range: file, start, quotes, and of its lines the number with an odd number of quotes, the
    number with a carriage return inside, and the first one. One pass over all files, however many there are."""
    lines = physical_lines(spark, path).withColumn("at", F.monotonically_increasing_id())
    inner = F.instr(F.rtrim(F.col("line"), F.lit("\r")), "\r") > 0
    facts = lines.withColumn("quotes", _quotes(F.col("line"))).groupBy(*_RANGE).agg(
        F.sum("quotes").alias("quotes"),
        F.count_if(F.col("quotes") % 2 == 1).alias("odd"),
        F.count_if(inner).alias("returns"),
        F.min_by("line", "at").alias("first"),
    )
    return stage_table(facts, "csv-ranges")


@dataclass(frozen=True)
class FileFacts:
    """`split`: lines are records; `quoted`: records have line breaks inside quotes, and the quotes are balanced.

    The header is unknown (none) if it is not one line.
    """

    path: str
    header: tuple[str, ...] | None
    split: bool
    quoted: bool


def file_facts(facts: DataFrame, case_sensitive: bool = False) -> list[FileFacts]:
    """What the ranges of each file say of it: one row a file comes to the driver, which lists the files anyway."""
    first = F.max(F.when(F.col("start") == 0, F.col("first"))).alias("first")
    rows = facts.groupBy("file").agg(F.sum("quotes").alias("quotes"), F.sum("odd").alias("odd"), F.sum("returns").alias("returns"), first)
    found = []
    for r in sorted(rows.collect(), key=lambda r: r.file):
        line = (r["first"] or "").lstrip("﻿").rstrip("\r")
        one_line = line.strip() and line.count('"') % 2 == 0 and not r["returns"]
        header = safe_names(next(csv.reader([line])), case_sensitive) if one_line else None
        found.append(FileFacts(r.file, header, not r.odd and not r["returns"], bool(r.odd) and not r["returns"] and r.quotes % 2 == 0))
    return found


def safe_names(names: Sequence[str], case_sensitive: bool = False) -> tuple[str, ...]:
    """Column names as Spark's own reader gives them: names that are empty or repeated get their place as a number."""
    same = (lambda n: n) if case_sensitive else str.lower
    seen = [same(n) for n in names]
    return tuple(f"_c{i}" if not n else f"{n}{i}" if seen.count(same(n)) > 1 else n for i, n in enumerate(names))


def _open_ranges(facts: DataFrame) -> DataFrame:
    """Stored (file, start) of the ranges that start inside quotes: an odd number of quotes stands before them."""
    before = F.sum("quotes").over(Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    return stage_table(facts.withColumn("before", before).where(F.col("before") % 2 == 1).select(*_RANGE, F.lit(True).alias("open")), "csv-open")


def _joined(lines: pa.Array, ends: np.ndarray, at: int) -> pa.Array:
    """One text for each run of lines that ends at one of `ends`, from line `at` on."""
    offsets = pa.array(np.concatenate([[at], ends + 1]), pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, lines), "\n")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records and pieces of records from the lines of whole ranges. A range's first record in a file's first range is its
    header, which is left out."""
    now, inside, entered, header, left = None, False, False, False, []

    def piece(kind: int, text: str) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"file": [now[0]], "start": [now[1]], "kind": pa.array([kind], pa.int32()), "piece": [text]})

    def rest() -> Iterator[pa.RecordBatch]:
        if left and not header:
            yield piece(_MIDDLE if entered else _HEAD, "\n".join(left))

    for batch in batches:
        files, starts = batch["file"].to_pylist(), batch["start"].to_pylist()
        edges = [0, *(i for i in range(1, len(files)) if (files[i], starts[i]) != (files[i - 1], starts[i - 1])), len(files)]
        for low, high in zip(edges, edges[1:]):
            if low == high:
                continue
            if now != (files[low], starts[low]):
                yield from rest()
                now, left = (files[low], starts[low]), []
                inside = entered = batch["open"][low].as_py() is True
                header = now[1] == 0
            lines = batch["line"].slice(low, high - low).cast(pa.large_string())
            odd = np.asarray(pc.count_substring(lines, '"')) % 2
            after = (np.cumsum(odd) + inside) % 2
            ends = np.flatnonzero(after == 0)
            inside = bool(after[-1])
            if not len(ends):
                left.extend(lines.to_pylist())
                continue
            first = "\n".join([*left, *lines.slice(0, ends[0] + 1).to_pylist()])
            if header:
                header = False
            else:
                yield piece(_TAIL if entered else _WHOLE, first)
            entered, left = False, lines.slice(ends[-1] + 1).to_pylist()
            if len(ends) > 1:
                records = _joined(lines.cast(pa.string()), ends[1:], int(ends[0]) + 1)
                n = len(records)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([now[0]] * n), pa.array([now[1]] * n, pa.int64()), pa.array(np.full(n, _WHOLE), pa.int32()), records],
                    names=["file", "start", "kind", "piece"],
                )
    yield from rest()


def records(spark: SparkSession, paths: Sequence[str], facts: DataFrame) -> DataFrame:
    """(record): all records of these files but their headers, as text.

    The ranges' numbers of quotes are counted again here, on the very lines that are cut: Spark sizes byte ranges by all
    the files of a read, so the ranges of `facts`, read with other files, need not be these. The lines are stored once
    so that counting and cutting see the same ranges.

    A record that holds line breaks and a quote that is neither around a field nor doubled ends the job, because its ends
    cannot be told by counting.
    """
    lines = stage_table(physical_lines(spark, paths).withColumn("at", F.monotonically_increasing_id()), "csv-lines")
    opened = _open_ranges(lines.groupBy(*_RANGE).agg(F.sum(_quotes(F.col("line"))).alias("quotes")))
    small = measured_bytes(opened) <= BROADCAST_BYTES
    ordered = lines.join(F.broadcast(opened) if small else opened, _RANGE, "left")
    marked = ordered.repartition(*_RANGE).sortWithinPartitions(*_RANGE, "at").drop("at")  # a range's lines in order
    pieces = stage_table(marked.select("file", "start", "line", "open").mapInArrow(_cut, _PIECES), "csv-pieces")
    whole = pieces.where(F.col("kind") == _WHOLE).select(F.col("piece").alias("record"))
    across = pieces.where(F.col("kind") != _WHOLE)
    order = [F.col("start"), F.col("kind")]  # a range's end of a record stands before the start of the next one
    number = F.count_if(F.col("kind") == _HEAD).over(Window.partitionBy("file").orderBy(*order))
    sorted_pieces = F.sort_array(F.collect_list(F.struct("start", "kind", "piece")))  # one record
    mended = across.withColumn("number", number).groupBy("file", "number").agg(sorted_pieces.alias("p"))
    found = whole.union(mended.select(F.array_join(F.col("p.piece"), "\n").alias("record")))
    record = F.rtrim(F.col("record"), F.lit("\r"))
    fields = F.regexp_replace(record, '"[^"]*+"', "\x01")
    stray = F.contains(record, F.lit("\n")) & fields.rlike("[^,\x01]\x01|\x01[^,\x01]")
    refusal = F.raise_error(F.concat(F.lit("a quote inside a field is not doubled; read the file with multi_line=True: "), F.substring(record, 1, 200)))
    fine = F.when(stray, refusal.cast("boolean")).otherwise(F.trim(record) != "")
    return found.select(record.alias("record")).where(fine)
