"""Languages of whole texts by a bidirectional gated recurrent network over bytes (`byte_network`)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrears_mart.llm.byte_network import CONTEXT, ByteNetwork, to_bytes, train

NONE = "und"
_PIECE = 96  # characters of a training piece
_TEXTS = 256


def held_out(doc_id: Column) -> Column:
    """Whether the language of this document is kept from training; a null id is not, but it does not train either."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike("\\p{L}"), F.lit(False))


def training_pieces(docs: DataFrame, per_label: int, pieces: int, most_labels: int) -> DataFrame:
    """(text, lang): `pieces` pieces of each of at most `per_label` documents of each label, least by a hash of the id.

    The first piece is a text's start, the others stand at places that a hash gives, all over the text. Of more than
    `most_labels` labels the commonest are learned.
    """
    usable = F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & has_letter(F.col("text"))
    known = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), "text").where(usable)
    ids = known.select("doc_id", "lang", F.xxhash64("doc_id").alias("code"))
    labels = ids.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_labels)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("code", "doc_id"))
    picked = ids.withColumn("rank", rank).where(F.col("rank") <= per_label).drop("rank", "code")
    picked = picked.join(F.broadcast(labels.select("lang")), "lang").distinct()
    texts = known.join(F.broadcast(picked), ["doc_id", "lang"])  # at most per_label * most_labels ids
    start = lambda i: F.pmod(F.xxhash64("doc_id", i), F.greatest(F.length("text") - _PIECE, F.lit(1)))
    places = F.transform(F.sequence(F.lit(0), F.lit(pieces - 1)), lambda i: F.when(i == 0, 0).otherwise(start(i)).cast("int"))
    cut = texts.select("doc_id", "lang", F.posexplode(F.transform(places, lambda p: F.substring(F.col("text"), p + 1, F.lit(_PIECE)))).alias("at", "text"))
    return cut.dropDuplicates(["doc_id", "lang", "at", "text"]).orderBy(F.xxhash64("doc_id"), "doc_id", "lang", "at", "text").select("at", "text", "lang")


def fit(docs: DataFrame, per_label: int = 400, pieces: int = 8, most_labels: int = 64) -> ByteNetwork:
    """A network trained on at most `per_label` documents of each of at most `most_labels` labels, `pieces` pieces each.

    These bounds are what keeps the sample in the driver's memory. Columns of `docs`: doc_id, text, lang.
    """
    rows = training_pieces(docs, per_label, pieces, most_labels).collect()
    # A text's start is learned with the padding that stands before it.
    return train(["\0" * CONTEXT * (r["at"] == 0) + r.text for r in rows], [r.lang for r in rows])


def _scored(texts: pd.Series, net: ByteNetwork) -> pd.DataFrame:
    best, score = [], []
    for at in range(0, len(texts), _TEXTS):
        pooled = net.pooled([to_bytes(t or "") for t in texts.iloc[at : at + _TEXTS]])
        top = pooled.argmax(axis=1)
        best.extend(net.labels[k] for k in top)
        score.extend(pooled[np.arange(len(top)), top])
    return pd.DataFrame({"lang": pd.Series(best, dtype="str"), "score": np.clip(np.array(score, np.float64), 0, 1)})


def language(docs: DataFrame, net: ByteNetwork, text: Column) -> Column:
    """(lang, score) of a whole text with a letter: the label of the highest mean probability, and that probability."""
    shared = docs.sparkSession.sparkContext.broadcast(net)  # a network has a fixed size of about 100 kB

    @F.pandas_udf("lang string, score double")
    def each(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield _scored(batch, shared.value)

    return each(text)


def identify(docs: DataFrame, net: ByteNetwork | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **bounds) -> DataFrame:
    """Per row of `docs`: doc_id, held_out, lang_pred and score.

    Null texts and such without a letter are `und` with score 0, and so is everything if no label can be learned. With
    one label all texts with a letter get it. Every position of every other text is labelled, however long it is. Rows
    without a label or an id do not train. Repeated rows are judged alike; an empty table gives an empty result. Other
    columns are not read, and only the text enters a prediction.
    """
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    net = net or fit(named, **bounds)
    named = named.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    if not net.labels:
        return named.select("doc_id", "held_out", F.lit(NONE).alias("lang_pred"), F.lit(0.0).alias("score"))
    lettered = has_letter(F.col("text"))
    judged = named.withColumns({"_letter": lettered, "_found": language(docs, net, F.when(lettered, F.col("text")))})
    return judged.select(
        "doc_id",
        "held_out",
        F.when(F.col("_letter"), F.col("_found.lang")).otherwise(NONE).alias("lang_pred"),
        F.when(F.col("_letter"), F.col("_found.score")).otherwise(0.0).alias("score"),
    )


def language_spans(docs: DataFrame, net: ByteNetwork, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, end, lang): the runs of bytes that the network labels alike, end exclusive; every byte of a text is
    in one run. Null and empty texts have none, and no text has any if the network knows no label."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                if not text or not shared.value.labels:
                    continue
                found = shared.value.labelled(to_bytes(text))
                starts = np.flatnonzero(np.diff(found, prepend=-1))
                names = [shared.value.labels[k] for k in found[starts]]
                yield pd.DataFrame({"doc_id": doc_id, "start": starts, "end": np.append(starts[1:], len(found)), "lang": names})

    kind = docs.schema[id_col].dataType.simpleString()
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return named.mapInPandas(runs, f"doc_id {kind}, start long, end long, lang string")
