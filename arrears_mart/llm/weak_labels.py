"""Quality classifier from weak labels: overlapping heuristics vote, their accuracies are estimated by expectation
maximisation, and the posterior labels train a hashed linear scorer."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears_mart.llm.columns import words
from arrears_mart.stages import stage_table

BUCKETS = 1 << 16
#: A heuristic accuses at most this share of good texts; it keeps a common fault from passing for a trait of good texts.
RARELY = 0.02
_TINY = 1e-6
_KNOWN_WORDS = 200_000


def votes(text: Column) -> dict[str, Column]:
    """What each heuristic says of a text: 1 good, 0 bad, -1 no opinion. They overlap on purpose."""
    whole = F.coalesce(text, F.lit(""))
    listed, size = words(text), F.greatest(F.length(whole), F.lit(1))
    n = F.size(listed)
    share = lambda pattern: F.length(F.regexp_replace(whole, pattern, "")) / size
    lines = F.filter(F.split(whole, "\n"), lambda line: F.length(F.trim(line)) > 0)
    vote = lambda good, bad: F.when(good, 1).when(bad, 0).otherwise(-1)
    mean = (size - n + 1) / F.greatest(n, F.lit(1))
    plain = F.size(F.filter(listed, lambda w: w.rlike("^\\p{L}+[.,;:]?$"))) / F.greatest(n, F.lit(1))
    different = F.size(F.array_distinct(listed)) / F.greatest(n, F.lit(1))
    repeated = 1 - F.size(F.array_distinct(lines)) / F.greatest(F.size(lines), F.lit(1))
    return {
        "length": vote(n.between(30, 20_000), n < 10),
        "word_length": vote(mean.between(3, 9), (mean < 2) | (mean > 14)),
        "symbols": vote(share("[^#*$%&|<>{}\\[\\]=_~^]+") < 0.01, share("[^#*$%&|<>{}\\[\\]=_~^]+") > 0.05),
        "letters": vote(share("[^\\p{L}]+") > 0.76, share("[^\\p{L}]+") < 0.7),
        "plain_words": vote(plain > 0.8, plain < 0.5),
        "upper": vote(share("[^A-Z]+") < 0.15, share("[^A-Z]+") > 0.3),
        "digits": vote(share("[^0-9]+") < 0.05, share("[^0-9]+") > 0.2),
        "sentences": vote(share("[^.?!]+").between(0.003, 0.08), (share("[^.?!]+") < 0.002) & (n >= 10)),
        "variety": vote(different > 0.35, different < 0.3),
        "lines": vote(repeated < 0.1, repeated > 0.3),
    }


@dataclass(frozen=True)
class LabelModel:
    """Share of good texts and, per heuristic and true class, the chances of the votes -1, 0 and 1."""

    good: float
    chances: np.ndarray  # heuristics x class (0 bad, 1 good) x vote + 1

    def posterior(self, pattern: Sequence[int]) -> float:
        odds = math.log(self.good / (1 - self.good))
        for j, v in enumerate(pattern):
            odds += math.log(self.chances[j, 1, v + 1] / self.chances[j, 0, v + 1])
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))


def estimate(patterns: Sequence[Sequence[int]], counts: Sequence[int], rounds: int = 200) -> LabelModel:
    """Expectation maximisation over vote patterns with their numbers of texts; heuristics vote independently given the
    class. Faults are of many kinds and a bad text mostly shows one of them, so it starts from texts with any vote for bad
    against the rest, which also settles which class is the good one."""
    p, n = np.asarray(patterns, np.int64), np.asarray(counts, np.float64)
    heuristics = p.shape[1]
    q = np.where((p == 0).any(axis=1), 0.1, 0.9)
    for _ in range(rounds):
        good = float(np.clip((q * n).sum() / n.sum(), _TINY, 1 - _TINY))
        chances = np.empty((heuristics, 2, 3))
        for j in range(heuristics):
            for v in range(3):
                hit = p[:, j] == v - 1
                chances[j, 1, v] = (q * n)[hit].sum() + 0.5
                chances[j, 0, v] = ((1 - q) * n)[hit].sum() + 0.5
        chances /= chances.sum(axis=2, keepdims=True)
        chances[:, 1, 1] = np.minimum(chances[:, 1, 1], RARELY)
        chances /= chances.sum(axis=2, keepdims=True)
        model = LabelModel(good, chances)
        new = np.array([model.posterior(row) for row in p])
        if np.abs(new - q).max() < 1e-9:
            break
        q = new
    return model


def _bucket(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "replace")) % BUCKETS


class Hasher:
    """Turns whole texts into buckets and weights; it keeps what it knows of words, up to a bound."""

    def __init__(self):
        self.words: dict[str, tuple[int, str]] = {}
        self.shapes: dict[str | tuple[str, str], int] = {}

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Buckets and weights (of length 1 together) of a text's words, word shapes and neighbouring shapes."""
        parts = (text or "").split()
        counts = Counter(parts)
        if len(self.words) > _KNOWN_WORDS:
            self.words.clear()
        known = self.words
        for w in [w for w in counts if w not in known]:
            known[w] = (_bucket(w.lower()), _shape(w))
        shapes = [known[w][1] for w in parts]
        grouped = Counter(shapes)
        grouped.update(zip(shapes, shapes[1:]))
        for s in grouped:
            if s not in self.shapes:
                self.shapes[s] = _bucket("\x01" + s if isinstance(s, str) else " ".join(s))
        size = len(counts) + len(grouped) + 1
        own = (_bucket(f"\x02size{len(parts).bit_length()}"),)
        at = np.fromiter(chain([known[w][0] for w in counts], [self.shapes[s] for s in grouped], own), np.int64, size)
        weight = np.log1p(np.fromiter(chain(counts.values(), grouped.values(), (1,)), np.float64, size))
        return at, weight / np.sqrt((weight**2).sum())


def _shape(word: str) -> str:
    """What a word is made of, and how long it is: letters, capitals, digits, other signs."""
    if word.isalpha():  # most words
        return f"{word.islower():d}{word.isupper():d}000{min(len(word), 24) // 3}"
    kinds = (word.islower(), word.isupper(), any(c.isdigit() for c in word), not word.isalnum(), word[-1:] in ".,;:!?")
    return "".join("01"[k] for k in kinds) + str(min(len(word), 24) // 3)


@dataclass
class Scorer:
    weights: np.ndarray
    bias: float

    def scores(self, texts: Sequence[str | None]) -> np.ndarray:
        logits, hashed = np.empty(len(texts)), Hasher()
        for i, text in enumerate(texts):
            at, weight = hashed(text)
            logits[i] = (self.weights[at] * weight).sum() + self.bias
        return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))


def train(texts: Sequence[str | None], labels: Sequence[float], epochs: int = 6, rate: float = 0.5) -> Scorer:
    """Logistic regression on soft labels by adaptive gradient steps, one text at a time in a fixed order."""
    weights, squares, bias, bias_square = np.zeros(BUCKETS), np.full(BUCKETS, 1e-6), 0.0, 1e-6
    rows = list(map(Hasher(), texts))
    order = np.random.default_rng(3).permutation(len(rows))
    for _ in range(epochs):
        for i in order:
            at, weight = rows[i]
            d = 1 / (1 + math.exp(-max(-30.0, min(30.0, float((weights[at] * weight).sum() + bias))))) - labels[i]
            g = d * weight
            np.add.at(squares, at, g * g)
            np.add.at(weights, at, -rate * g / np.sqrt(squares[at]))
            bias_square += d * d
            bias -= rate * d / math.sqrt(bias_square)
    return Scorer(weights.astype(np.float32), bias)


def _sample(voted: DataFrame, docs: DataFrame, most: int) -> DataFrame:
    """Text and votes of at most `most` different texts that are `able` to train, least by hash, half of them with a vote for
    bad."""
    names = [c for c in voted.columns if c.startswith("v_")]
    bad = F.least(*[F.abs(F.col(c)) for c in names]) == 0
    able = voted.where("able").select("hash", *names).distinct()
    half = [able.where(side).orderBy("hash").limit(most // 2) for side in (bad, ~bad)]
    picked = half[0].union(half[1])
    texts = docs.select("text", _text_hash().alias("hash")).join(F.broadcast(picked), "hash")  # at most `most` rows
    return texts.groupBy("hash", *names).agg(F.max("text").alias("text")).orderBy("hash")


def _text_hash() -> Column:
    return F.xxhash64("text", F.lit(11))


def fit(docs: DataFrame, most: int = 4000, longest: int = 50_000) -> tuple[LabelModel, Scorer]:
    """The label model from the votes on all texts, and a scorer trained on at most `most` of them, each of at most
    `longest` characters, so that the sample fits the driver; longer ones vote and are scored like any other.

    Votes are made once and stored with a hash of the text. Only the numbers of texts per vote pattern come to the
    driver, at most 3 to the number of heuristics rows, and the sample.
    """
    named = {f"v_{k}": c.cast("int") for k, c in votes(F.col("text")).items()}
    able = F.coalesce(F.length("text"), F.lit(0)) <= longest
    voted = docs.select(_text_hash().alias("hash"), able.alias("able"), *[c.alias(k) for k, c in named.items()])
    voted = stage_table(voted, "quality-votes")
    patterns = sorted(voted.groupBy(*named).agg(F.count(F.lit(1)).alias("n")).collect(), key=tuple)
    if not patterns:
        return LabelModel(0.5, np.full((len(named), 2, 3), 1 / 3)), train([], [])
    model = estimate([list(r)[:-1] for r in patterns], [r.n for r in patterns])
    rows = _sample(voted, docs, most).collect()
    return model, train([r.text for r in rows], [model.posterior([r[k] for k in named]) for r in rows])


def quality_score(docs: DataFrame, scorer: Scorer, text: Column) -> Column:
    shared = docs.sparkSession.sparkContext.broadcast(scorer)  # BUCKETS weights

    @F.pandas_udf("double")
    def each(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(shared.value.scores(batch.tolist()), dtype="float64")

    return each(text)


def score_quality(docs: DataFrame, most: int = 4000, threshold: float = 0.5, longest: int = 50_000) -> DataFrame:
    """`docs` (with text) and score, the chance that the whole text is good, and kept (columns so named are replaced).

    Null texts are empty ones. Every text votes and is scored, repeated rows too; an empty table gives an empty result.
    No label table is used.
    """
    _, scorer = fit(docs, most, longest)
    scored = docs.withColumn("score", quality_score(docs, scorer, F.col("text")))
    return scored.withColumn("kept", F.col("score") >= threshold)
