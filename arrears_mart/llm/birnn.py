"""A small bidirectional gated recurrent network with attention pooling, in numpy.

Inputs are windows of words. A word enters as the embedding of its hash beside the mean embedding of its hashed
character sequences, so unseen forms of a known stem still carry a signal. Everything here works on arrays of fixed
size; texts are cut into windows by `windows`.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np

WINDOW, STRIDE = 24, 12
#: Every STRIDE-th window is scored first; around one with a logit above NEAR all overlapping windows are.
NEAR = -2.0
HIDDEN, WORD_DIM, CHAR_DIM = 8, 8, 12
WORD_BUCKETS, CHAR_BUCKETS, GRAM_BUCKETS = 1 << 13, 1 << 14, 1 << 18  # each a multiple of the one before
_GRAMS = (3, 4, 5)
_EDGE = " .,;:!?\"'()[]{}<>|#$%&*-_=/\\"
_PAD = 0
_CACHED_WORDS = 200_000
_CHUNK = 1024
_WORDS_AT_ONCE = 20_000


def word_hashes(new: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per word its hash and the number of its character sequences; and the hashes of these, word after word."""
    bare = [w.strip(_EDGE) for w in new]
    buckets = np.array([zlib.crc32(w.encode("utf-8", "replace")) % WORD_BUCKETS for w in bare], np.int64)
    lengths = np.fromiter(map(len, bare), np.int64, len(bare)) + 2
    points = np.frombuffer("".join(f"\x02{w}\x03" for w in bare).encode("utf-32-le", "surrogatepass"), np.uint32)
    points = points.astype(np.uint64)
    owner = np.repeat(np.arange(len(bare)), lengths)
    # At every place the sequences that start there; those that would cross into the next word are masked out.
    hashes = np.zeros((len(points), len(_GRAMS)), np.int64)
    inside = np.zeros((len(points), len(_GRAMS)), bool)
    for j, n in enumerate(_GRAMS):
        size = max(0, len(points) - n + 1)
        h = np.full(size, n, np.uint64)
        for k in range(n if size else 0):
            h = h * np.uint64(1_000_003) + points[k : size + k]
        h ^= h >> np.uint64(29)
        hashes[:size, j] = h & np.uint64(GRAM_BUCKETS - 1)
        inside[:size, j] = owner[:size] == owner[n - 1 :]
    inside[np.cumsum(lengths) - lengths, 0] = True  # so that no word is without one
    counts = np.bincount(owner, inside.sum(axis=1), len(bare)).astype(np.int64)
    return buckets, counts, hashes[inside]


class Words:
    """Numbers for the words of training texts, with their hashes; number 0 stands for the places beyond a text's end."""

    def __init__(self, texts: Sequence[str | None]):
        parts = list(map(split, texts))
        new = list(dict.fromkeys(itertools.chain.from_iterable(parts)))
        number = {w: i + 1 for i, w in enumerate(new)}
        self.ids = [np.fromiter(map(number.__getitem__, p), np.int64, len(p)) for p in parts]
        buckets, counts, grams = [np.zeros(1, np.int64)], [np.zeros(2, np.int64)], [np.zeros(0, np.int32)]
        for at in range(0, len(new), _WORDS_AT_ONCE):
            b, c, g = word_hashes(new[at : at + _WORDS_AT_ONCE])
            buckets.append(b)
            counts.append(c)
            grams.append(g.astype(np.int32))
        self.buckets, self.grams = np.concatenate(buckets), np.concatenate(grams)
        self.first = np.cumsum(np.concatenate(counts))  # grams[first[i]:first[i + 1]] belong to number i


def split(text: str | None) -> list[str]:
    return (text or "").lower().split()


def all_windows(ids: np.ndarray) -> np.ndarray:
    """All overlapping windows of a text's words, padded at the end; one empty window for a text without words."""
    count = max(1, -(-(len(ids) - WINDOW) // STRIDE) + 1)
    padded = np.full((count - 1) * STRIDE + WINDOW, _PAD, np.int64)
    padded[: len(ids)] = ids
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW)


def windows(ids: np.ndarray) -> np.ndarray:
    """Every STRIDE-th window of a text, with which training does."""
    return all_windows(ids)[::STRIDE]


def _between(logits: np.ndarray, count: int) -> np.ndarray:
    """The starts of the windows around every STRIDE-th one with a logit above NEAR, of `count` windows in all."""
    hit = np.flatnonzero(logits > NEAR) * STRIDE
    starts = np.unique(hit[:, None] + np.arange(1 - STRIDE, STRIDE)[None, :])
    return starts[(starts % STRIDE != 0) & (starts >= 0) & (starts < count)]


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Network:
    """Weights as float32; `slope` and `offset` turn a text's greatest window logit into a probability."""

    p: dict[str, np.ndarray] = field(default_factory=dict)
    slope: float = 1.0
    offset: float = 0.0

    @classmethod
    def fresh(cls, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        d = WORD_DIM + CHAR_DIM

        def some(*shape, scale):
            return rng.normal(0, scale, shape).astype(np.float32)

        p = {"word": some(WORD_BUCKETS, WORD_DIM, scale=0.05), "char": some(CHAR_BUCKETS, CHAR_DIM, scale=0.3)}
        for way in "fb":
            p[f"W{way}"] = some(d, 3 * HIDDEN, scale=0.4)
            p[f"c{way}"] = np.zeros(3 * HIDDEN, np.float32)
            p[f"U{way}"] = some(HIDDEN, 3 * HIDDEN, scale=0.3)
        p["att"], p["out"] = some(2 * HIDDEN, scale=0.3), some(2 * HIDDEN, scale=0.5)
        p["bias"] = np.zeros(1, np.float32)
        return cls(p)

    # ---- one direction ------------------------------------------------------------------------------------

    def _run(self, x, way, keep=None):
        """States of shape (time, rows, HIDDEN) for projected inputs x of shape (time, rows, 3 * HIDDEN)."""
        u, h = self.p[f"U{way}"], np.zeros((x.shape[1], HIDDEN), np.float32)
        states = np.empty((x.shape[0], x.shape[1], HIDDEN), np.float32)
        for t in range(len(x)) if way == "f" else range(len(x) - 1, -1, -1):
            hu = h @ u
            zr = _sigmoid(x[t, :, : 2 * HIDDEN] + hu[:, : 2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            n = np.tanh(x[t, :, 2 * HIDDEN :] + r * hu[:, 2 * HIDDEN :])
            if keep is not None:
                keep[t] = (h, z, r, n, hu[:, 2 * HIDDEN :])
            h = n + z * (h - n)
            states[t] = h
        return states

    def _back(self, dstates, way, keep, grads):
        u, dx = self.p[f"U{way}"], np.empty((*dstates.shape[:2], 3 * HIDDEN), np.float32)
        dh, du = np.zeros(dstates.shape[1:], np.float32), np.zeros_like(u)
        for t in range(len(dstates) - 1, -1, -1) if way == "f" else range(len(dstates)):
            h, z, r, n, hn = keep[t]
            dh = dh + dstates[t]
            dn = dh * (1 - z) * (1 - n * n)
            dz = dh * (h - n) * z * (1 - z)
            dr = dn * hn * r * (1 - r)
            d = np.concatenate([dz, dr, dn], axis=1)
            dx[t] = d
            through = np.concatenate([dz, dr, dn * r], axis=1)
            du += h.T @ through
            dh = dh * z + through @ u.T
        grads[f"U{way}"] = du
        return dx

    # ---- whole network ------------------------------------------------------------------------------------

    def embed(self, buckets: np.ndarray, counts: np.ndarray, grams: np.ndarray) -> np.ndarray:
        """Embeddings of words with these hashes; each word has at least one character sequence."""
        sums = np.add.reduceat(self.p["char"][grams % CHAR_BUCKETS], np.cumsum(counts) - counts, axis=0)
        return np.concatenate([self.p["word"][buckets], sums / np.sqrt(counts)[:, None].astype(np.float32)], axis=1)

    def inputs(self, words: Words, numbers: np.ndarray) -> np.ndarray:
        """Embeddings of the words with these numbers; zeros for number 0."""
        lengths = words.first[numbers + 1] - words.first[numbers]
        out = np.zeros((len(numbers), WORD_DIM + CHAR_DIM), np.float32)
        if (real := numbers > 0).any():
            places = _places(words.first[numbers[real]], lengths[real])
            out[real] = self.embed(words.buckets[numbers[real]], lengths[real], words.grams[places])
        return out

    def projected(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """The projected inputs of all words, a part of them at a time."""
        starts = range(0, len(words.buckets), _WORDS_AT_ONCE)
        parts = [self.project(self.inputs(words, np.arange(a, min(a + _WORDS_AT_ONCE, len(words.buckets))))) for a in starts]
        return tuple(np.concatenate(x) for x in zip(*parts))

    def project(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return tuple(x @ self.p[f"W{w}"] + self.p[f"c{w}"] for w in "fb")

    def _pool(self, hf, hb, present):
        h = np.concatenate([hf, hb], axis=2)
        s = np.where(present, h @ self.p["att"], np.float32(-1e9))
        e = np.exp(s - s.max(axis=0))
        a = e / e.sum(axis=0)
        return h, a, (a[:, :, None] * h).sum(axis=0)

    def logits(self, rows: np.ndarray, projected: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """One logit for each row of a (rows, WINDOW) array of places in the projected inputs (place 0: padding)."""
        out = []
        for at in range(0, len(rows), _CHUNK):
            turned = rows[at : at + _CHUNK].T
            hf, hb = self._run(projected[0][turned], "f"), self._run(projected[1][turned], "b")
            _, _, c = self._pool(hf, hb, turned > 0)
            out.append(c @ self.p["out"] + self.p["bias"])
        return np.concatenate(out)

    def greatest(self, texts: Sequence[np.ndarray], projected: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """The greatest logit of each text, given as places in the projected inputs."""
        full = list(map(all_windows, texts))
        first = np.cumsum([0, *(-(-len(f) // STRIDE) for f in full)])
        coarse = self.logits(np.concatenate([f[::STRIDE] for f in full]), projected)
        top = np.maximum.reduceat(coarse, first[:-1])
        finer = [(i, _between(coarse[first[i] : first[i + 1]], len(full[i]))) for i in np.flatnonzero(top > NEAR).tolist()]
        finer = [(i, starts) for i, starts in finer if len(starts)]
        if finer:
            more = self.logits(np.concatenate([full[i][starts] for i, starts in finer]), projected)
            np.maximum.at(top, np.repeat([i for i, _ in finer], [len(s) for _, s in finer]), more)
        return top

    def step(self, rows: np.ndarray, target: np.ndarray, words: Words) -> dict[str, np.ndarray]:
        """Gradients of the mean logistic loss over these windows of word numbers."""
        numbers, places = np.unique(np.concatenate([[_PAD], rows.ravel()]), return_inverse=True)
        turned = places[1:].reshape(rows.shape).T
        x = self.inputs(words, numbers)
        pf, pb = self.project(x)
        kf, kb = [None] * WINDOW, [None] * WINDOW
        hf, hb = self._run(pf[turned], "f", kf), self._run(pb[turned], "b", kb)
        h, a, c = self._pool(hf, hb, turned > 0)
        grads: dict[str, np.ndarray] = {}
        d = ((_sigmoid(c @ self.p["out"] + self.p["bias"]) - target) / len(rows)).astype(np.float32)
        grads["out"], grads["bias"] = c.T @ d, d.sum(keepdims=True)
        dc = d[:, None] * self.p["out"]
        da = (h * dc).sum(axis=2)
        ds = a * (da - (a * da).sum(axis=0))
        grads["att"] = np.tensordot(ds, h, axes=2)
        dh = a[:, :, None] * dc + ds[:, :, None] * self.p["att"]
        dx = np.zeros_like(x)
        for way, keep, part in (("f", kf, dh[:, :, :HIDDEN]), ("b", kb, dh[:, :, HIDDEN:])):
            flat = self._back(part, way, keep, grads).reshape(-1, 3 * HIDDEN)
            summed = np.stack([np.bincount(turned.ravel(), flat[:, j], len(numbers)) for j in range(flat.shape[1])], 1)
            summed = summed.astype(np.float32)
            grads[f"W{way}"], grads[f"c{way}"] = x.T @ summed, summed.sum(axis=0)
            dx += summed @ self.p[f"W{way}"].T
        lengths = words.first[numbers + 1] - words.first[numbers]
        real = lengths > 0
        grams = words.grams[_places(words.first[numbers[real]], lengths[real])] % CHAR_BUCKETS
        share = np.repeat(dx[real, WORD_DIM:] / np.sqrt(lengths[real])[:, None], lengths[real], axis=0)
        buckets = words.buckets[numbers[real]]
        grads["char"] = np.stack([np.bincount(grams, share[:, j], CHAR_BUCKETS) for j in range(CHAR_DIM)], 1)
        grads["word"] = np.stack([np.bincount(buckets, dx[real, j], WORD_BUCKETS) for j in range(WORD_DIM)], 1)
        return grads

    # ---- use ----------------------------------------------------------------------------------------------

    def scorer(self):
        """A function from a list of texts to their probabilities; it keeps inputs of words it has met, up to a bound."""
        number: dict[str, int] = {}
        known: list[np.ndarray] = []

        def greatest(texts: Sequence[str | None]) -> np.ndarray:
            if not known or len(number) > _CACHED_WORDS:
                number.clear()
                known[:] = [np.zeros((1 << 16, 3 * HIDDEN), np.float32) + self.p[f"c{w}"] for w in "fb"]
            parts = list(map(split, texts))
            new = [w for w in dict.fromkeys(itertools.chain.from_iterable(parts)) if w not in number]
            if new:
                at = len(number) + 1
                number.update(zip(new, range(at, at + len(new))))
                while at + len(new) > len(known[0]):
                    known[:] = [np.concatenate([x, np.zeros_like(x)]) for x in known]
                for x, more in zip(known, self.project(self.embed(*word_hashes(new)))):
                    x[at : at + len(new)] = more
            return self.greatest([np.fromiter(map(number.__getitem__, p), np.int64, len(p)) for p in parts], known)

        def score(texts: Sequence[str | None], group: int = 256) -> np.ndarray:
            parts = [greatest(texts[i : i + group]) for i in range(0, len(texts), group)]
            return _sigmoid(self.slope * np.concatenate(parts).astype(np.float64) + self.offset) if parts else np.zeros(0)

        return score


def _places(first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... for each length, one after another."""
    return np.repeat(first - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())


def _suspicion(cut: Sequence[np.ndarray], label: np.ndarray, words: Words) -> np.ndarray:
    """For each window, how far its words' most telling character sequences point to positive texts (log odds, summed).

    Telling is a sequence that clearly more positive than negative texts have. The score is 0 below what nearly all
    negative texts reach somewhere, so that a stem which also starts some clean words only counts where it crowds.
    """
    grams = []
    for rows in cut:
        numbers = np.unique(rows)
        lengths = words.first[numbers + 1] - words.first[numbers]
        grams.append(np.unique(words.grams[_places(words.first[numbers], lengths)]))
    n = [max(1, int((label == k).sum())) for k in (0, 1)]
    have = [np.bincount(np.concatenate([g for g, x in zip(grams, label) if x == k]), minlength=GRAM_BUCKETS) for k in (0, 1)]
    clean, bad, mean = have[0] / n[0], have[1] / n[1], (have[0] + have[1]) / sum(n)
    sure = (bad - clean) / np.sqrt(mean * (1 - mean) * (1 / n[0] + 1 / n[1]) + 1e-12) > 4
    odds = np.log((have[1] + 0.1) / (n[1] + 0.2) * (n[0] + 0.2) / (have[0] + 0.1))
    odds[~(sure & (have[1] >= 3) & (odds > np.log(5)))] = 0
    by_word = np.zeros(len(words.buckets))
    real = np.flatnonzero(np.diff(words.first) > 0)
    by_word[real] = np.maximum.reduceat(odds[words.grams], words.first[real])
    found = [by_word[rows].sum(axis=1) for rows in cut]
    usual = np.quantile([f.max() for f, x in zip(found, label) if x == 0], 0.97)
    found = np.concatenate(found)
    return np.where(found > usual, found, 0)


def train(
    texts: Sequence[str], labels: Sequence[int], seed: int = 7, epochs: int = 8, per_epoch: int = 10_000, batch: int = 256
) -> Network:
    """A network for labelled texts. A window of a positive text counts as positive at first if its character sequences
    are suspicious, and from halfway on also if the network finds it positive. A fifth of the texts takes no part in
    this: on them the greatest logit of a text is calibrated against its label. Without both classes the result is a
    constant score."""
    net, rng = Network.fresh(seed), np.random.default_rng(seed)
    label = np.asarray(labels, np.float32)
    if not len(label) or label.min() == label.max():
        mean = (label.sum() + 1) / (len(label) + 2)
        net.slope, net.offset = 0.0, float(np.log(mean / (1 - mean)))
        return net
    aside = np.zeros(len(label), bool)
    for k in (0, 1):
        of_class = rng.permutation(np.flatnonzero(label == k))
        aside[of_class[: len(of_class) // 5]] = True
    words = Words(texts)
    cut = list(map(windows, words.ids))
    owner = np.repeat(np.arange(len(cut)), list(map(len, cut)))
    rows, learn = np.concatenate(cut).astype(np.int32), ~aside[owner]
    doubt = np.zeros(len(rows))
    doubt[learn] = _suspicion([c for c, x in zip(cut, aside) if not x], label[~aside], words)
    toxic = label[owner] == 1
    positive = learn & toxic & (doubt > 0)
    if not positive.any():
        positive = learn & toxic
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    v = {k: np.zeros_like(x) for k, x in net.p.items()}
    done = 0

    def window_logits():
        return net.logits(rows, net.projected(words))

    for epoch in range(epochs):
        if epoch == epochs // 2:
            positive = positive | (learn & toxic & (window_logits() > 0))
        sides = [np.flatnonzero(positive), np.flatnonzero(learn & ~positive & (~toxic | (doubt == 0)))]
        picked = np.concatenate([rng.choice(x, per_epoch // 2, len(x) < per_epoch // 2) for x in sides if len(x)])
        rng.shuffle(picked)
        rate = 0.01 if epoch < epochs - 2 else 0.003
        for at in range(0, len(picked), batch):
            now = picked[at : at + batch]
            done += 1
            for k, g in net.step(rows[now], positive[now].astype(np.float32), words).items():
                g = g + 1e-5 * net.p[k]
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.01 * (g * g - v[k])
                net.p[k] -= (rate * (m[k] / (1 - 0.9**done)) / (np.sqrt(v[k] / (1 - 0.99**done)) + 1e-6)).astype(np.float32)
    judged = aside if len(np.unique(label[aside])) == 2 else ~aside
    top = net.greatest([words.ids[i] for i in np.flatnonzero(judged)], net.projected(words)).astype(np.float64)
    net.slope, net.offset = _calibrated(top, label[judged])
    return net


def _calibrated(top: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through these logits, pulled a little to slope 1, by Newton steps.

    A step that would raise the penalised loss is halved until it does not, so logits that part the labels cleanly do
    not throw the curve off."""
    x, beta = np.stack([top, np.ones_like(top)], 1), np.array([0.5, 0.0])
    pull = np.array([1.0, 0.05])

    def loss(b: np.ndarray) -> float:
        z = x @ b
        return float(np.sum(np.logaddexp(0, z) - label * z) + 0.5 * pull @ (b - [1.0, 0.0]) ** 2)

    for _ in range(30):
        p = _sigmoid(x @ beta)
        gradient = x.T @ (p - label) + pull * (beta - [1.0, 0.0])
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(pull), gradient)
        now, size = loss(beta), 1.0
        while True:
            moved = beta - size * step
            moved[0] = np.clip(moved[0], 0.05, 3)
            if loss(moved) <= now + 1e-9 * (1 + abs(now)) or size < 1e-6:
                break
            size /= 2
        beta = moved
    return float(beta[0]), float(beta[1])
