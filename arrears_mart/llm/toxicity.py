"""Toxicity scores of whole texts by a bidirectional gated recurrent network over overlapping windows.

A text's score is that of its most suspicious window. Windows of 24 words start at every 12th word; around each that is
faintly suspicious all starts are scored too, so that the score hardly depends on where a passage begins.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears_mart.llm.birnn import Network, train


def held_out(doc_id: Column) -> Column:
    """Whether labels of this document are kept from training."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of the labelled documents that are not held out; one that has both labels counts as toxic."""
    marked = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    return marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))


def labelled_texts(docs: DataFrame, labels: DataFrame, per_class: int, longest: int) -> DataFrame:
    """(text, toxic): at most `per_class` labelled training documents of either label and of at most `longest` characters,
    least by a hash of the id."""
    short = docs.select("doc_id", "text").where(F.coalesce(F.length("text"), F.lit(0)) <= longest)
    marked = training_labels(labels).join(short.select("doc_id").distinct(), "doc_id", "left_semi")
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = marked.where("toxic = 1").orderBy(*order).limit(per_class)
    picked = picked.union(marked.where("toxic = 0").orderBy(*order).limit(per_class))
    texts = short.join(F.broadcast(picked), "doc_id")  # at most 2 * per_class ids
    texts = texts.groupBy("doc_id").agg(F.max("text").alias("text"), F.max("toxic").alias("toxic"))
    return texts.orderBy(*order).select("text", "toxic").limit(2 * per_class)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 1500, longest: int = 50_000) -> Network:
    """A network trained on a sample that fits the driver: at most `per_class` documents of either label, each of at most
    `longest` characters. Longer ones are scored like any other."""
    rows = labelled_texts(docs, labels, per_class, longest).collect()
    net = train([r.text for r in rows], [r.toxic for r in rows])
    # The sample has more toxic documents than the labels have: the offset goes back to their odds.
    toxic, clean = training_labels(labels).agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") == 0)).first()
    sampled = sum(r.toxic for r in rows)
    if toxic and clean and 0 < sampled < len(rows):
        net.offset += math.log(toxic / clean) - math.log(sampled / (len(rows) - sampled))
    return net


def toxicity_score(docs: DataFrame, net: Network, text: Column) -> Column:
    """Probability that the whole text is toxic, from its most suspicious window."""
    shared = docs.sparkSession.sparkContext.broadcast(net)  # a network has a fixed size of about 1 MB

    @F.pandas_udf("double")
    def each(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        score = shared.value.scorer()
        for batch in batches:
            yield pd.Series(score(batch.tolist()), dtype="float64")

    return each(text)


def score_documents(docs: DataFrame, labels: DataFrame, per_class: int = 1500, longest: int = 50_000) -> DataFrame:
    """`docs` with held_out, score and predicted (columns so named are replaced, all others kept).

    Null and empty texts are one empty window and get its score. Rows without a usable label (null id, null or other
    values) do not train. Repeated rows and null ids are scored like any row. Without labels of both classes the score
    is one constant. Only `text` enters a score. Long texts are scored to their end; an empty table gives an empty result.
    """
    net = fit(docs, labels, per_class, longest)
    scored = docs.withColumn("score", toxicity_score(docs, net, F.col("text")))
    return scored.withColumns(
        {"held_out": held_out(F.col("doc_id")), "predicted": (F.col("score") >= 0.5).cast("int")}
    )


def without_toxic(docs: DataFrame, labelled: DataFrame, labels: DataFrame, per_class: int = 1500, longest: int = 50_000) -> DataFrame:
    """The rows of `docs` with a score below one half, all columns as they are; the network learns from `labelled`.

    Null and empty texts have the score of one empty window. Repeated rows stay or go together, long texts are scored to
    their end, null ids are scored like any, and an empty table gives an empty result.
    """
    net = fit(labelled, labels, per_class, longest)
    return docs.where(toxicity_score(docs, net, F.col("text")) < 0.5)
