"""Token counts of whole documents: pieces are counted once per distinct pre-token and summed per document.

A pre-token is a run of spaces with the characters up to the next space. No piece of the vocabulary goes on from
another character into a space, so the pieces of a text are those of its pre-tokens, one after another. No token ids
are kept. The commonest pre-tokens, whose number is bounded, reach every task by broadcast; all others are joined by
shuffling, where no single one can be hot. Long pre-tokens are known by a digest, so that a long one may be common.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears_mart.llm.columns import row_key
from arrears_mart.stages import stage_table

#: At most so many pre-tokens are broadcast; those of more bytes stand as a SHA-256 digest, which no shorter one equals.
COMMON, COMMON_BYTES = 1 << 18, 48
_SPACE_MARK = "▁"  # the vocabulary writes spaces with this sign, which a text may hold as well


def pre_tokens(text: Column) -> Column:
    """The pre-tokens of a text without their first space, which every text starts with for the tokenizer.

    The last one is empty if a single space ends the text. Null and empty texts have none.
    """
    cut = F.split(text, f"(?<=[^ {_SPACE_MARK}]) ")
    return F.when(F.length(text) > 0, cut).otherwise(F.array().cast("array<string>"))


def piece_counter(model: bytes) -> Column:
    """A function from pre-tokens to their numbers of pieces, for a column."""

    @F.pandas_udf("int")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokenizer = sentencepiece.SentencePieceProcessor(model_proto=model)
        for batch in batches:
            # Nothing stands for the space itself, which is a piece.
            yield pd.Series([len(p) or 1 for p in tokenizer.encode(batch.tolist(), num_threads=1)], dtype="int32")

    return count


def _known_by(token: Column) -> Column:
    """What stands for a pre-token in joins: itself, or the digest of a long one."""
    return F.when(F.octet_length(token) <= COMMON_BYTES, token).otherwise(F.sha2(token, 256)).alias("token")


def vocabulary(texts: DataFrame, model: bytes) -> DataFrame:
    """Stored (token, uses, pieces) of all distinct pre-tokens of the column `text`, by what they are known by."""
    used = texts.select(F.explode(pre_tokens(F.col("text"))).alias("token")).groupBy("token")
    counted = used.agg(F.count(F.lit(1)).alias("uses"))
    pieces = counted.withColumn("pieces", piece_counter(model)(F.col("token")))
    return stage_table(pieces.select(_known_by(F.col("token")), "uses", "pieces"), "tokens-vocabulary")


def _least_common_uses(words: DataFrame, most: int) -> int:
    """The least power of two of uses that at most `most` pre-tokens reach."""
    power = F.floor(F.log2("uses")).cast("int")
    steps = words.groupBy(power.alias("p")).count().collect()
    kept, least = 0, 64
    for row in sorted(steps, reverse=True):
        kept += row["count"]
        if kept > most:
            break
        least = row.p
    return 1 << least if least < 63 else (1 << 63) - 1


def count_tokens(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", common: int = COMMON
) -> DataFrame:
    """Per row of `docs`: doc_id, n_bytes and n_tokens of the whole text, as the library counts it.

    Null texts count as empty: 0 and 0. Repeated rows give repeated results; null ids are kept. Other columns are not
    read. An empty table gives an empty result.
    """
    with open(model_path, "rb") as file:
        model = file.read()  # the driver reads it, so executors need no such file
    texts = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ).withColumn("key", row_key(F.col("text")))
    words = vocabulary(texts, model)
    often = F.col("uses") >= _least_common_uses(words, common)
    top = F.broadcast(stage_table(words.where(often).select("token", "pieces"), "tokens-common"))
    row = ["doc_id", "key"]
    single = texts.select(*row, F.explode(pre_tokens(F.col("text"))).alias("token")).select(*row, _known_by(F.col("token")))
    common_sums = single.join(top, "token").groupBy(*row).agg(F.sum("pieces").alias("n"))
    # Frequencies of the others per document: dealt by pre-token once, for the counting and the join.
    others = single.join(top, "token", "left_anti").repartition("token").groupBy("token", *row).agg(F.count(F.lit(1)).alias("times"))
    other_sums = others.join(words.where(~often).select("token", "pieces"), "token").groupBy(*row).agg(
        F.sum(F.col("times") * F.col("pieces")).alias("n")
    )
    sums = common_sums.union(other_sums).groupBy(*row).agg(F.sum("n").alias("n"))
    rows = texts.groupBy(*row, F.octet_length("text").cast("long").alias("n_bytes")).agg(F.count(F.lit(1)).cast("int").alias("copies"))
    sums = sums.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "n")
    joined = rows.join(sums, rows.doc_id.eqNullSafe(sums["_id"]) & (rows.key == sums["_key"]), "left")
    # Equal rows were summed together.
    each = (F.coalesce("n", F.lit(0)) / F.col("copies")).cast("long").alias("n_tokens")
    return joined.select("doc_id", "n_bytes", each, F.explode(F.sequence(F.lit(1), "copies")).alias("_copy")).drop("_copy")
