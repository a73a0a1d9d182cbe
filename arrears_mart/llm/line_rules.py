"""Quality rules by cross-document line frequency. DataFrame operations only.

Lines are normalised and hashed, and the distinct documents of each line are counted per host. Lines above the limits
count as boilerplate and are removed; documents that lose too much, or fail the plain rules, are rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears_mart.llm.columns import BLANKS, ascii_lower, broadcast_if_small, row_key, words
from arrears_mart.stages import stage_table

_RUN = 5  # words in a window that may repeat


@dataclass(frozen=True)
class Limits:
    """Lines are compared with A-Z lower-cased. One is boilerplate in more than `documents` of its host's documents and more than `share` of them; a document
    is rejected if it keeps less than `left` of its words."""

    documents: int = 10
    share: float = 0.001
    left: float = 0.5


def _lines(text: Column) -> Column:
    """The lines of a text that hold a word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: line.rlike(f"[^{BLANKS}]"))


def _line_hash(line: Column) -> Column:
    """White space collapsed to one space and cut at the ends, then hashed to 64 bits; most lines need no change."""
    ragged = line.rlike("[\\t\\x0B\\f\\r]|  |^ | $")
    plain = F.when(ragged, F.trim(F.regexp_replace(line, f"[{BLANKS}]+", " "))).otherwise(line)
    return F.xxhash64(plain)


def _covered(starts: Column) -> Column:
    """The places in windows that start at these places, which are sorted."""
    first = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-_RUN).alias("last"))
    step = lambda a, p: F.struct(
        (a["n"] + F.least(F.lit(_RUN), p - a["last"])).alias("n"), p.alias("last")
    )
    return F.aggregate(starts, first, step, lambda a: a["n"])


def plain_rules(docs: DataFrame, text: Column) -> DataFrame:
    """`docs` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    whole = F.coalesce(text, F.lit(""))
    listed = docs.withColumns({"_words": words(text), "_lines": _lines(text)})
    hashed = listed.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_symbols": F.length(F.regexp_replace(whole, "[^#*$%&|<>]+", "")).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_hashes": F.transform("_words", lambda w: F.xxhash64(w)),
        }
    ).drop("_words", "_lines")
    places = F.sequence(F.lit(0), F.size("_hashes") - _RUN)
    run = F.transform(places, lambda i: F.xxhash64(*[F.get("_hashes", i + k) for k in range(_RUN)]))
    hashed = hashed.withColumn("_runs", F.when(F.size("_hashes") > _RUN, run))
    repeats = F.size(F.array_distinct("_runs")) < F.size("_runs")
    ordered = F.sort_array(F.transform("_runs", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    hashed = hashed.withColumn("_ordered", F.when(repeats, ordered)).drop("_runs", "_hashes")
    same = lambda i, k: F.get("_ordered", i)["h"] == F.get("_ordered", i + k)["h"]
    twice = F.filter(
        F.sequence(F.lit(0), F.size("_ordered") - 1),
        lambda i: F.coalesce(same(i, 1), F.lit(False)) | F.coalesce((i > 0) & same(i, -1), F.lit(False)),
    )
    starts = F.sort_array(F.transform(twice, lambda i: F.get("_ordered", i)["i"]))
    counted = hashed.withColumn(
        "n_repeat_words", F.when(F.col("_ordered").isNotNull(), _covered(starts)).otherwise(0).cast("long")
    ).drop("_ordered")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def frequent_lines(docs: DataFrame, limits: Limits) -> DataFrame:
    """Stored (host, none, line) of the lines above the limits, counted by different documents; `docs` is `_hosted`."""
    # Rows of one id are one document; those without an id are told apart by their text.
    document = ["doc_id", F.when(F.col("doc_id").isNull(), F.col("key")).alias("lone")]
    hosts = docs.select("host", "none", *document).distinct().groupBy("host", "none").agg(F.count(F.lit(1)).alias("documents"))
    in_text = F.array_distinct(F.transform(_lines(ascii_lower(F.col("text"))), _line_hash))
    lines = docs.select("host", "none", *document, F.explode(in_text).alias("line")).distinct()
    counted = lines.groupBy("host", "none", "line").agg(F.count(F.lit(1)).alias("found"))
    counted = counted.where(F.col("found") > limits.documents)
    above = counted.join(broadcast_if_small(stage_table(hosts, "lines-hosts")), ["host", "none"])
    above = above.where(F.col("found") > limits.share * F.col("documents"))
    return stage_table(above.select("host", "none", "line"), "lines-frequent")


def _hosted(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    host = F.col(host_col).cast("string")
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(host, F.lit("")).alias("host"),
        host.isNull().alias("none"),
        row_key(F.col(text_col)).alias("key"),
        F.col(text_col).alias("text"),
    )


def judge_documents(
    docs: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text", host_col: str = "source"
) -> DataFrame:
    """Per row of `docs`: doc_id, the plain rules' columns, n_removed (words in removed lines) and kept.

    Null texts have no words and fail. A null host is a host of its own. Rows of one id are one document for the line
    frequencies, rows without an id are one for each different text; every row gives a result row. Long texts are read
    whole. Other columns are not read, whatever their names; an empty table gives an empty result.
    """
    rows = _hosted(docs, id_col, text_col, host_col)
    frequent = frequent_lines(rows, limits)
    lines = rows.select("doc_id", "host", "none", "key", F.explode(_lines(ascii_lower(F.col("text")))).alias("raw"))
    lines = lines.withColumn("line", _line_hash(F.col("raw")))
    row = ["doc_id", "host", "none", "key"]
    lost = lines.join(broadcast_if_small(frequent), ["host", "none", "line"])
    removed = lost.groupBy(*row).agg(F.sum(F.size(words(F.col("raw")))).alias("removed"))
    judged = plain_rules(rows, F.col("text")).drop("text")
    judged = judged.groupBy(*judged.columns).agg(F.count(F.lit(1)).cast("int").alias("copies"))
    on = F.expr("j.doc_id <=> r.doc_id and j.host = r.host and j.none = r.none and j.key = r.key")
    joined = judged.alias("j").join(removed.alias("r"), on, "left").select("j.*", "removed")
    # Equal rows were summed together.
    n_removed = (F.coalesce("removed", F.lit(0)) / F.col("copies")).cast("long")
    enough = F.col("n_words") - F.col("n_removed") >= limits.left * F.col("n_words")
    each = F.explode(F.sequence(F.lit(1), "copies")).alias("_copy")
    kept = joined.withColumn("n_removed", n_removed).withColumn("kept", ~F.col("base_failed") & enough)
    return kept.select("*", each).drop("_copy", "copies", "removed", "host", "none", "key")


def cleaned_texts(
    docs: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text", host_col: str = "source"
) -> DataFrame:
    """(doc_id, text) without the frequent lines, one row for each different (id, text, host); blank lines stay. A null text
    becomes an empty one. Other columns are not read, whatever their names; an empty table gives an empty result."""
    rows = _hosted(docs, id_col, text_col, host_col)
    frequent = frequent_lines(rows, limits).withColumn("_frequent", F.lit(True))
    row = ["doc_id", "host", "none", "key"]
    lines = rows.dropDuplicates(row).select(*row, F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("at", "raw"))
    lines = lines.withColumn("line", _line_hash(ascii_lower(F.col("raw"))))
    marked = lines.join(broadcast_if_small(frequent), ["host", "none", "line"], "left")
    left = F.collect_list(F.when(F.col("_frequent").isNull(), F.struct("at", "raw")))  # one document's lines
    texts = marked.groupBy(*row).agg(F.sort_array(left).alias("lines"))
    return texts.select("doc_id", F.array_join(F.col("lines.raw"), "\n").alias("text"))
