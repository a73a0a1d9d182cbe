"""Ranked lexical search: whole documents are indexed in K2-treaps, which queries descend best first.

Every block of documents is one grid of its terms by its documents, kept as a compressed quadtree with impact maxima
(`treap`). Blocks are made and searched apart, so neither grows with the corpus; a query's best documents of each block
meet in one ranking at the end. All numbers but a term's weight are whole, and results are exact.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrears_mart.llm import treap
from arrears_mart.operators.lookups import measured_bytes
from arrears_mart.stages import new_stage_path, stage_table

#: Bytes of text in a block, and of queries that are taken at a time.
BLOCK_BYTES, QUERY_BYTES = 8 << 20, 4 << 20
#: Fixed by the contract: impacts are (SCALE * tf) div (1000 * tf + 12 * m), m is FLAT + (25 * n * N) div L.
SCALE, FLAT = 1_000_000_000, 75
#: Digits, letters (A-Z lower-cased) and all that is not ASCII make terms; everything else parts them.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_INDEX = "block long, ids array<long>, terms binary, found binary, side int, mask binary, best binary, row binary, col binary"


def terms(text: str | None) -> list[bytes]:
    """The terms of a whole text, in UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


def term_count(text: Column) -> Column:
    @F.pandas_udf("long")
    def each(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([len(terms(t)) for t in batch], dtype="int64")

    return each(text)


def statistics(docs: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """The number of documents with a term, and of all their terms."""
    counted = docs.select(term_count(F.col(text_col)).alias("n"))
    documents, held = counted.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    return documents, held or 0


def impacts(tf: np.ndarray, n: np.ndarray, documents: int, held: int) -> np.ndarray:
    m = FLAT + (25 * n * documents) // held
    return (SCALE * tf) // (1000 * tf + 12 * m)


class _Block:
    """Documents of a block; of their texts only the numbers of the terms are kept."""

    def __init__(self):
        self.ids: list = []
        self.listed: list[np.ndarray] = []
        self.numbers: defaultdict[bytes, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.size = 0

    def add(self, doc_id, text: str | None) -> None:
        if found := terms(text):
            self.ids.append(doc_id)
            self.listed.append(np.fromiter(map(self.numbers.__getitem__, found), np.int32, len(found)))
            self.size += len(text)

    def row(self, number: int, documents: int, held: int) -> dict:
        """One row of the index. Documents stand by id, so that an equal score goes to the lesser id; terms stand by their
        greatest impact, which puts rows that are alike into the same cells."""
        order = sorted(range(len(self.ids)), key=lambda i: (pd.isna(self.ids[i]), 0 if pd.isna(self.ids[i]) else self.ids[i]))
        ids, listed = [self.ids[i] for i in order], [self.listed[i] for i in order]
        n = np.array([len(x) for x in listed], np.int64)
        cells = np.concatenate(listed).astype(np.int64)
        cells *= len(ids)
        cells += np.repeat(np.arange(len(ids), dtype=np.int32), n)
        cells, tf = np.unique(cells, return_counts=True)
        row, column = cells // len(ids), cells % len(ids)
        value = impacts(tf, n[column], documents, held)
        greatest = np.zeros(len(self.numbers), np.int64)
        np.maximum.at(greatest, row, value)
        ordered = np.lexsort((np.arange(len(greatest)), -greatest))
        place = np.empty_like(ordered)
        place[ordered] = np.arange(len(ordered))
        tree = treap.build(place[row], column, value)
        names = list(self.numbers)
        return {
            "block": number,
            "ids": [None if pd.isna(i) else int(i) for i in ids],
            "terms": b" ".join([names[i] for i in ordered]),
            "found": np.bincount(row, minlength=len(names))[ordered].astype(np.uint32).tobytes(),
            "side": tree.side,
            "mask": tree.mask.tobytes(),
            "best": tree.best.tobytes(),
            "row": tree.row.tobytes(),
            "col": tree.column.tobytes(),
        }


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The stored index of all terms of all documents that have any: one row and one file for each block of about
    `block_bytes` of text."""
    documents, held = statistics(docs, text_col)

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 32
        block = _Block()
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                block.add(doc_id, text)
                if block.size >= block_bytes:
                    yield pd.DataFrame([block.row(number, documents, held)])
                    block, number = _Block(), number + 1
        if block.ids:
            yield pd.DataFrame([block.row(number, documents, held)])

    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    path = new_stage_path(docs.sparkSession, "search-index")
    named.mapInPandas(blocks, _INDEX).write.option("maxRecordsPerFile", 1).parquet(path)
    return docs.sparkSession.read.schema(_INDEX).parquet(path)


def document_frequencies(index: DataFrame, wanted: set[bytes]) -> dict[bytes, int]:
    """In how many documents each wanted term stands; the wanted ones come from a bounded part of the queries."""
    shared = index.sparkSession.sparkContext.broadcast(wanted)

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for names, found in zip(batch["terms"], batch["found"]):
                own = [(t, n) for t, n in zip(names.split(b" "), np.frombuffer(found, np.uint32).tolist()) if t in shared.value]
                yield pd.DataFrame(own, columns=["term", "n"])

    found = index.select("terms", "found").mapInPandas(counts, "term binary, n long")
    return {bytes(r.term): r.n for r in found.groupBy("term").agg(F.sum("n").alias("n")).collect()}


def _best(index: DataFrame, queries: list[tuple[int, list[bytes], list[int]]], most: int) -> DataFrame:
    """(item, doc_id, score): the best documents of the blocks of each task, at most `most` a query and task."""
    shared = index.sparkSession.sparkContext.broadcast(queries)

    def searched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[int, list[tuple]] = defaultdict(list)
        for batch in batches:
            for b in batch.itertuples():
                tree = treap.Treap(
                    b.side, np.frombuffer(b.mask, np.uint8), np.frombuffer(b.best, np.int32), np.frombuffer(b.row, np.int32), np.frombuffer(b.col, np.int32)
                )
                place = {t: i for i, t in enumerate(b.terms.split(b" "))}
                for item, names, weights in shared.value:
                    here = [(place[t], w) for t, w in zip(names, weights) if t in place]
                    rows, w = np.array([x[0] for x in here], np.int64), np.array([x[1] for x in here], np.int64)
                    so_far = found[item]
                    least = so_far[-1][0] if len(so_far) == most else 1
                    columns, scores = treap.search(tree, rows, w, most, least)
                    so_far.extend((s, b.ids[c]) for s, c in zip(scores.tolist(), columns.tolist()))
                    so_far.sort(key=lambda x: (-x[0], x[1] is None or pd.isna(x[1]), 0 if pd.isna(x[1]) else x[1]))
                    del so_far[most:]
        rows = [(item, i, s) for item, best in found.items() for s, i in best]
        yield pd.DataFrame({"item": [r[0] for r in rows], "doc_id": pd.array([r[1] for r in rows], dtype="Int64"), "score": [r[2] for r in rows]})

    return index.drop("block", "found").mapInPandas(searched, "item long, doc_id long, score long")


def search(
    docs: DataFrame,
    items: DataFrame,
    most: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(item_id, rank, doc_id, score): for each item the `most` documents of the highest scores above 0.

    Every row of `items` is a query of its own, and every row of `docs` a document: repeated ones are ranked each. Equal
    scores go by id, null ids last. Null, empty and wordless texts are never found and find nothing; they count neither
    as documents nor for lengths. Empty tables give an empty result. Other columns are not read. Queries are taken in
    parts of about QUERY_BYTES, each of which is sent to all blocks.
    """
    spark = docs.sparkSession
    texts = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text")).where(F.length("text") > 0)
    texts = stage_table(texts.withColumn("item", F.monotonically_increasing_id()), "search-items")
    index = build_index(docs, id_col, text_col, block_bytes)
    documents = index.select(F.sum(F.size("ids"))).first()[0] or 0
    parts = max(1, math.ceil(measured_bytes(texts) / QUERY_BYTES))
    found = None
    for part in range(parts):
        rows = texts.where(F.pmod(F.xxhash64("item"), F.lit(parts)) == part).select("item", "text").collect()
        asked = [(r.item, Counter(terms(r.text))) for r in rows]
        df = document_frequencies(index, {t for _, held in asked for t in held})
        weight = {t: math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for t, n in df.items()}
        queries = [(item, [t for t in held if t in df], [n * weight[t] for t, n in held.items() if t in df]) for item, held in asked]
        best = _best(index, queries, most)
        found = best if found is None else found.union(best)
    ranked = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    top = found.withColumn("rank", ranked).where(F.col("rank") <= most)
    return top.join(texts.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
