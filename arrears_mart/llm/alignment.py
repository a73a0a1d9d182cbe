"""Alignment of two tokenizers over whole texts, with corpus-wide counts of the id pairs it links.

A text is cut where both tokenizers are sure to start anew, at a space after a character that is not white space, so a
piece is aligned once however often it occurs. Documents are numbered within blocks. Every id pair of a block has a
compressed bitmap of the documents that hold it, and bitmaps of the bits of their multiplicities (`bitmaps`). A pair's
document count is the popcount over all blocks; its score goes back to each block with the posting, and there to the
documents. What a block holds has a fixed bound, so no pair and no source makes a task larger than others.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears_mart.llm import bitmaps
from arrears_mart.stages import stage_table

#: Characters of text in a block.
BLOCK_CHARS = 4 << 20
_KNOWN_PIECES = 150_000
_AT_ONCE = 20_000  # pieces that are tokenized together
_CROWD = 4096  # links of a group from which equal ids are put together first
_SPACE_MARK = "▁"
_PAIR = 16  # bits of an id of the second tokenizer
#: Fixed value: how byte-level vocabularies cut a text before merging.
_WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_DOC = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
_STAGE = f"block bigint, place int, {_DOC}, a int, b int, docs binary, planes array<binary>, n_docs int"


def _byte_of_sign() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 characters as they are and the other bytes, in order, from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Aligned:
    """What is known of pieces, one after another: numbers of tokens and groups, the groups as text, and the different id
    pairs with how often each is linked, which lie in `pairs` and `times` from `first` on, `size` of them."""

    def __init__(self):
        none = np.zeros(0, np.int64)
        self.n_a = self.n_b = self.n_groups = self.size = self.pairs = self.times = none
        self.groups: list[str | None] = []  # each group ends with a semicolon; none: the bytes differ

    def add(self, columns: dict[str, list[np.ndarray]]) -> None:
        for name, parts in columns.items():
            setattr(self, name, np.concatenate([getattr(self, name), *parts]))
        self.first = np.cumsum(self.size) - self.size


def _library(first: str):
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_str(first)
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
    return tokenizer


def _ranked(ranks: dict[bytes, int]):
    """The same tokenizer in a library that merges by rank, which takes a third of the time."""
    import tiktoken

    return tiktoken.Encoding("ranked", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={})


def same_ranks(first: str) -> dict[bytes, int] | None:
    """Ranks of the tokens, if merging by them gives what the vocabulary's own library gives: it must be a plain
    byte-level one whose ids follow the order of its merges, and all of its tokens must be cut alike. Else none."""
    told = json.loads(first)
    model, cut = told["model"], told.get("pre_tokenizer") or {}
    plain = not told.get("normalizer") and cut == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
    if not plain or model["type"] != "BPE" or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix")):
        return None
    sign, special = _byte_of_sign(), {t["content"] for t in told.get("added_tokens", ())}
    names = {n: i for n, i in model["vocab"].items() if n not in special}
    merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    base = len(names) - len(merged)
    if base != 256 or any(names.get(n) != base + i for i, n in enumerate(merged)) or not all(c in sign for n in names for c in n):
        return None
    ranks = {bytes(sign[c] for c in n): i for n, i in names.items()}
    texts = [t.decode("utf-8", "ignore") for t in ranks]
    own, ranked = _library(first).encode_batch(texts, add_special_tokens=False), _ranked(ranks)
    return ranks if all(e.ids == ranked.encode_ordinary(t) for e, t in zip(own, texts)) else None


def _runs(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... for each size, one after another."""
    return np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


class Aligner:
    """Both tokenizers, and what pieces met before came to."""

    def __init__(self, first: str, second: bytes, ranks: dict[bytes, int] | None = None):
        import sentencepiece

        self.a, self.ranked = _library(first), _ranked(ranks) if ranks else None
        self.b = sentencepiece.SentencePieceProcessor(model_proto=second)
        sign = _byte_of_sign()
        size_a = self.a.get_vocab_size()
        names = [self.a.id_to_token(i) or "" for i in range(size_a)]
        self.bytes_a = [bytes(sign[c] for c in n) if all(c in sign for c in n) else n.encode() for n in names]
        ids_b = range(self.b.get_piece_size())
        pieces = [self.b.id_to_piece(i) for i in ids_b]
        self.bytes_b = [bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace(_SPACE_MARK, " ").encode() for i, p in zip(ids_b, pieces)]
        self.length_a, self.length_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        self.space = self.b.piece_to_id(_SPACE_MARK)
        # Only if no piece goes on from another character into a space do the pieces of a text follow one another.
        self.cuts = not any(_SPACE_MARK in p.lstrip(_SPACE_MARK) for p in pieces)
        text_of = lambda n, end: np.array([f"{i}{end}" for i in range(n)], object)
        self.text_a = {end: text_of(size_a, end) for end in ",|"}
        self.text_b = {end: text_of(len(pieces), end) for end in ",;"}
        self.number: dict[str, int] = {}
        self.known = Aligned()

    def split(self, text: str) -> list[str]:
        return re.split(r"(?<=\S) ", text) if self.cuts else [text]

    def learn(self, pieces: Sequence[str]) -> None:
        new = [p for p in dict.fromkeys(pieces) if p not in self.number]
        columns: dict[str, list[np.ndarray]] = defaultdict(list)
        for at in range(0, len(new), _AT_ONCE):
            part = new[at : at + _AT_ONCE]
            self.number.update(zip(part, range(len(self.number), len(self.number) + len(part))))
            for name, values in self._aligned(part).items():
                columns[name].append(values)
        if new:
            self.known.add(columns)

    def _tokens(self, new: Sequence[str]) -> tuple[list[list[int]], list[list[int]], np.ndarray]:
        """Ids of both tokenizers, none for pieces that are not given back byte for byte, and whether they are."""
        spaced = [f" {p}" for p in new]
        if self.ranked:
            ids_a = list(map(self.ranked.encode_ordinary, spaced))
        else:
            ids_a = [e.ids for e in self.a.encode_batch(spaced, add_special_tokens=False)]
        ids_b = [x or [self.space] for x in self.b.encode(list(new), num_threads=1)]
        wanted = [p.encode("utf-8", "surrogatepass") for p in spaced]
        right = np.ones(len(new), bool)
        for ids, names, length in ((ids_a, self.bytes_a, self.length_a), (ids_b, self.bytes_b, self.length_b)):
            n = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = list(chain.from_iterable(ids))
            sizes = np.add.reduceat(length[flat], np.cumsum(n) - n)
            same = sizes == np.fromiter(map(len, wanted), np.int64, len(ids))
            if not same.all() or b"".join([names[i] for i in flat]) != b"".join(wanted):
                same = np.array([b"".join([names[i] for i in x]) == w for x, w in zip(ids, wanted)])
            right &= same
        if not right.all():
            ids_a, ids_b = ([x if ok else [] for x, ok in zip(ids, right.tolist())] for ids in (ids_a, ids_b))
        return ids_a, ids_b, right

    def _aligned(self, new: Sequence[str]) -> dict[str, np.ndarray]:
        """Columns of `Aligned` for these pieces. All lie on one line of bytes, where both tokenizers end each of them."""
        ids_a, ids_b, right = self._tokens(new)
        n_a, n_b = (np.fromiter(map(len, ids), np.int64, len(ids)) for ids in (ids_a, ids_b))
        a, b = (np.fromiter(chain.from_iterable(ids), np.int64, n.sum()) for ids, n in ((ids_a, n_a), (ids_b, n_b)))
        end_a, end_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        cuts = np.intersect1d(end_a, end_b, assume_unique=True)
        group_a, group_b = np.searchsorted(cuts, end_a), np.searchsorted(cuts, end_b)
        in_a, in_b = np.bincount(group_a, minlength=len(cuts)), np.bincount(group_b, minlength=len(cuts))
        until_a, until_b = np.cumsum(in_a), np.cumsum(in_b)
        last_a = np.flatnonzero(np.diff(group_a, append=len(cuts)))
        last_b = np.flatnonzero(np.diff(group_b, append=len(cuts)))
        out, text_a, text_b = np.empty(len(a) + len(b), object), self.text_a[","][a], self.text_b[","][b]
        text_a[last_a], text_b[last_b] = self.text_a["|"][a[last_a]], self.text_b[";"][b[last_b]]
        out[np.arange(len(a)) + (until_b - in_b)[group_a]] = text_a
        out[np.arange(len(b)) + until_a[group_b]] = text_b
        text, ends = out.tolist(), np.concatenate([[0], np.cumsum(n_a + n_b)]).tolist()
        joined = ["".join(text[s:e]) for s, e in zip(ends, ends[1:])]
        self.known.groups.extend(joined if right.all() else [t if ok else None for t, ok in zip(joined, right.tolist())])
        # Links of a group: each of its first ids with each of its second ones. Large groups are counted apart.
        crowd = in_a * in_b > _CROWD
        piece_a = np.repeat(np.arange(len(new)), n_a)
        each = np.where(crowd[group_a], 0, in_b[group_a])
        at = _runs((until_b - in_b)[group_a], each)
        key = np.repeat((piece_a << 32) | (a << _PAIR), each) | b[at]
        times = np.ones(len(key), np.int64)
        for g in np.flatnonzero(crowd).tolist():
            (x, many_x), (y, many_y) = (
                np.unique(ids[until[g] - n[g] : until[g]], return_counts=True) for ids, until, n in ((a, until_a, in_a), (b, until_b, in_b))
            )
            whose = int(piece_a[until_a[g] - 1]) << 32
            key = np.concatenate([key, (whose | (x[:, None] << _PAIR) | y[None, :]).ravel()])
            times = np.concatenate([times, (many_x[:, None] * many_y[None, :]).ravel()])
        order = np.argsort(key, kind="stable")
        key, times = key[order], times[order]
        starts = np.flatnonzero(np.diff(key, prepend=-1))
        key, times = key[starts], np.add.reduceat(times, starts) if len(starts) else times
        piece_of_group = piece_a[until_a - 1] if len(cuts) else np.zeros(0, np.int64)
        return {
            "n_a": n_a,
            "n_b": n_b,
            "n_groups": np.bincount(piece_of_group, minlength=len(new)),
            "size": np.bincount(key >> 32, minlength=len(new)),
            "pairs": key & 0xFFFFFFFF,
            "times": times,
        }

    # ---- blocks -------------------------------------------------------------------------------------------

    def block(self, texts: Sequence[str | None]) -> tuple[dict[str, list], dict[str, list]]:
        """Columns of the documents of a block, and of its postings."""
        if len(self.number) > _KNOWN_PIECES:
            self.number.clear()
            self.known = Aligned()
        parts = [self.split(t) if t else [] for t in texts]
        self.learn([p for x in parts for p in x])
        known, number = self.known, self.number
        docs = {c: [0] * len(texts) for c in ("n_a", "n_b", "n_groups", "n_links")} | {"groups_sha256": [""] * len(texts)}
        numbers, sizes = [], np.zeros(len(texts), np.int64)
        for d, x in enumerate(parts):
            own = [number[p] for p in x]
            groups = [known.groups[i] for i in own]
            if not own or None in groups:
                continue
            numbers.append(np.array(own, np.int64))
            sizes[d] = len(own)
            docs["groups_sha256"][d] = hashlib.sha256("".join(groups)[:-1].encode()).hexdigest()
        if not numbers:
            return docs, {"a": [], "b": [], "docs": [], "planes": [], "n_docs": []}
        every = np.concatenate(numbers) * len(texts) + np.repeat(np.arange(len(texts)), sizes)
        cells, often = np.unique(every, return_counts=True)  # a piece and a document
        piece, doc = cells // len(texts), cells % len(texts)
        for name in ("n_a", "n_b", "n_groups"):
            sums = np.zeros(len(texts), np.int64)
            np.add.at(sums, doc, often * getattr(known, name)[piece])
            docs[name] = sums.tolist()
        each = known.size[piece]
        at = _runs(known.first[piece], each)
        where = (known.pairs[at] << _PAIR) | np.repeat(doc, each)  # a block has at most 2 ** 16 documents
        count = known.times[at] * np.repeat(often, each)
        links = np.zeros(len(texts), np.int64)
        np.add.at(links, where & (bitmaps.MOST - 1), count)
        docs["n_links"] = links.tolist()
        return docs, self._postings(where, count)

    @staticmethod
    def _postings(where: np.ndarray, count: np.ndarray) -> dict[str, list]:
        order = np.argsort(where)
        where = where[order]
        starts = np.flatnonzero(np.append(True, where[1:] != where[:-1]))
        count, where = np.add.reduceat(count[order], starts), where[starts]
        pair, doc = where >> _PAIR, where & (bitmaps.MOST - 1)
        starts = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
        ends = np.append(starts[1:], len(pair))
        many = np.maximum.reduceat(count, starts) > 1
        maps, planes = [], []
        for s, e, more in zip(starts.tolist(), ends.tolist(), many.tolist()):
            own = doc[s:e]
            maps.append(bitmaps.pack(own))
            planes.append(bitmaps.planes(count[s:e], own) if more else [])
        pair = pair[starts]
        return {"a": (pair >> _PAIR).tolist(), "b": (pair & ((1 << _PAIR) - 1)).tolist(), "docs": maps, "planes": planes, "n_docs": (ends - starts).tolist()}


_TYPES = {
    "block": pa.int64(), "place": pa.int32(), "doc_id": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(),
    "groups_sha256": pa.string(), "a": pa.int32(), "b": pa.int32(), "docs": pa.binary(), "planes": pa.list_(pa.binary()), "n_docs": pa.int32(),
}
_aligners: dict[int, Aligner] = {}


def _batch(rows: int, columns: dict[str, list]) -> pa.RecordBatch:
    arrays = [pa.array(columns[n], t) if n in columns else pa.nulls(rows, t) for n, t in _TYPES.items()]
    return pa.RecordBatch.from_arrays(arrays, names=list(_TYPES))


def align(
    docs: DataFrame, first_path: str, second_path: str, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """The stored alignment, for `documents_of`, `pair_counts` and `score_documents`: a row for each document, with its
    block and its place there, and one for each id pair of a block (`a` is not null).

    `first_path` is a byte-level vocabulary of the tokenizers library, `second_path` a sentencepiece model.
    """
    with open(first_path, encoding="utf-8") as f, open(second_path, "rb") as s:  # the driver reads them
        first, second = f.read(), s.read()
    models = docs.sparkSession.sparkContext.broadcast((first, second, same_ranks(first)))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A worker that runs several tasks keeps what it knows.
        known = hash(models.value[:2])
        if known not in _aligners:
            _aligners.clear()
            _aligners[known] = Aligner(*models.value)
        aligner, number = _aligners[known], TaskContext.get().partitionId() << 32
        ids, texts, size = [], [], 0

        def made() -> Iterator[pa.RecordBatch]:
            documents, postings = aligner.block(texts)
            block, n = [number] * len(ids), len(postings["a"])
            yield _batch(len(ids), {"block": block, "place": list(range(len(ids))), "doc_id": ids, **documents})
            for at in range(0, n, 50_000):
                part = {k: v[at : at + 50_000] for k, v in postings.items()}
                yield _batch(len(part["a"]), {"block": [number] * len(part["a"]), **part})

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                ids.append(doc_id)
                texts.append(text)
                size += len(text or "")
                if size >= block_chars or len(ids) == bitmaps.MOST:
                    yield from made()
                    ids, texts, size, number = [], [], 0, number + 1
        if ids:
            yield from made()

    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return stage_table(named.mapInArrow(blocks, _STAGE), "alignment")


def documents_of(aligned: DataFrame) -> DataFrame:
    return aligned.where("place is not null").select("block", "place", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(a, b, documents, links): in how many documents a pair is linked, and how often.

    The bitmaps of different blocks have no document in common, so the popcount of all is the sum of theirs; links are
    the popcounts of the multiplicity planes, each at its weight.
    """

    @F.pandas_udf("long")
    def links(maps: pd.Series, planes: pd.Series) -> pd.Series:
        return pd.Series([bitmaps.total(m, p) for m, p in zip(maps, planes)], dtype="int64")

    postings = aligned.where("a is not null")
    return postings.groupBy("a", "b").agg(F.sum("n_docs").alias("documents"), F.sum(links("docs", "planes")).alias("links"))


def _scores(aligned: DataFrame) -> DataFrame:
    """Stored (a, b, n, best): a pair's document count, and whether it is the highest of its first id."""
    counted = aligned.where("a is not null").groupBy("a", "b").agg(F.sum("n_docs").cast("long").alias("n"))
    counted = stage_table(counted, "alignment-pairs")
    highest = counted.groupBy("a").agg(F.max("n").alias("highest"))
    return counted.join(highest, "a").select("a", "b", "n", (F.col("n") == F.col("highest")).cast("int").alias("best"))


def _spread_scores(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """The scores of a block's pairs, added up in the documents that their postings name."""
    n, best = rows["n"].to_numpy(np.int64), rows["best"].to_numpy(np.int64)
    weights, maps = [np.arange(len(rows))], [rows["docs"].tolist()]
    factors = [np.ones(len(rows), np.int64)]
    planes = rows["planes"].tolist()
    deepest = max(map(len, planes), default=0)
    for k in range(deepest):
        own = [i for i, p in enumerate(planes) if len(p) > k]
        weights.append(np.array(own, np.int64))
        maps.append([planes[i][k] for i in own])
        factors.append(np.full(len(own), 1 << k, np.int64))
    row, factor = np.concatenate(weights), np.concatenate(factors)
    found = [bitmaps.unpack(m) for part in maps for m in part]
    sizes = np.array([len(x) for x in found], np.int64)
    doc = np.concatenate(found)
    sums = np.zeros((2, int(doc.max()) + 1), np.int64)
    for i, score in enumerate((best, n)):
        np.add.at(sums[i], doc, np.repeat(score[row] * factor, sizes))
    held = np.flatnonzero(sums[1])
    return pd.DataFrame({"block": key[0], "place": held.astype(np.int32), "n_best": sums[0][held], "count_sum": sums[1][held]})


def score_documents(aligned: DataFrame) -> DataFrame:
    """The documents of an alignment with n_best, the links whose pair has its first id's highest document count, and
    count_sum, the sum of the document counts of all links."""
    postings = aligned.where("a is not null").select("a", "b", "block", "docs", "planes")
    scored = postings.join(_scores(aligned), ["a", "b"]).select("block", "docs", "planes", "n", "best")
    sums = scored.groupBy("block").applyInPandas(_spread_scores, "block long, place int, n_best long, count_sum long")
    found = documents_of(aligned).join(sums, ["block", "place"], "left")
    zero = F.lit(0).cast("long")
    return found.withColumns({"n_best": F.coalesce("n_best", zero), "count_sum": F.coalesce("count_sum", zero)}).drop("block", "place")


def align_documents(docs: DataFrame, first_path: str, second_path: str, **options) -> DataFrame:
    """Per row of `docs`: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.

    Every row is a document, repeated ones too: they count for their pairs and have a result row each. Null and empty
    texts, and such that a tokenizer does not give back byte for byte, have no tokens: zeros and an empty digest. Null
    ids are kept. Other columns are not read; an empty table gives an empty result. A long text is one document of a
    block of its own.
    """
    return score_documents(align(docs, first_path, second_path, **options))
