"""A bidirectional gated recurrent network over bytes that labels every position, in numpy.

Texts are read in stretches with some bytes of context on either side, which is all that a label depends on; so a text of
any length is labelled in bounded memory, and many stretches at a time.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np

HIDDEN = 8
STRETCH, CONTEXT = 224, 16
_ROWS = 2048  # stretches that are read together
_LEARN, _BATCH = 64, 128  # bytes of a training piece that are labelled, and pieces in a step
_PAD = 0
#: Bytes that can belong to a letter: a-z, A-Z and all that is not ASCII. Others are labelled, but not counted.
_LETTER = np.array([97 <= (b | 32) <= 122 or b >= 128 for b in range(256)])


def _windows(data: np.ndarray) -> np.ndarray:
    """The stretches of a text with their context, padded at both ends."""
    count = max(1, -(-len(data) // STRETCH))
    padded = np.full(count * STRETCH + 2 * CONTEXT, _PAD, np.uint8)
    padded[CONTEXT : CONTEXT + len(data)] = data
    return np.lib.stride_tricks.sliding_window_view(padded, STRETCH + 2 * CONTEXT)[::STRETCH]


def to_bytes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)


@dataclass
class ByteNetwork:
    """Weights as float32 and the labels they tell apart. The gates' inputs are looked up: `in_f` and `in_b` hold, per byte,
    the embedding already projected."""

    labels: list[str]
    p: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, labels: Sequence[str], seed: int = 5) -> ByteNetwork:
        rng = np.random.default_rng(seed)
        some = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
        p = {}
        for way in "fb":
            p[f"in_{way}"] = some(256, 3 * HIDDEN, scale=0.5)
            p[f"u_{way}"] = some(HIDDEN, 3 * HIDDEN, scale=0.3)
            p[f"out_{way}"] = some(HIDDEN, len(labels), scale=0.3)
        p["bias"] = np.zeros(len(labels), np.float32)
        return cls(list(labels), p)

    # ---- one direction ------------------------------------------------------------------------------------

    def _states(self, x: np.ndarray, way: str, keep: list | None = None) -> np.ndarray:
        """States of shape (time, rows, HIDDEN) for bytes x of shape (time, rows)."""
        table, u, rows = self.p[f"in_{way}"], self.p[f"u_{way}"], x.shape[1]
        states = np.empty((*x.shape, HIDDEN), np.float32)
        h, hu, gate = np.zeros((rows, HIDDEN), np.float32), np.empty((rows, 3 * HIDDEN), np.float32), np.empty((rows, 2 * HIDDEN), np.float32)
        for t in _order(len(x), way):
            put = table[x[t]]
            np.matmul(h, u, out=hu)
            np.add(put[:, : 2 * HIDDEN], hu[:, : 2 * HIDDEN], out=gate)
            gate *= 0.5
            np.tanh(gate, out=gate)  # a sigmoid by way of tanh
            gate *= 0.5
            gate += 0.5
            z, r = gate[:, :HIDDEN], gate[:, HIDDEN:]
            n = np.tanh(put[:, 2 * HIDDEN :] + r * hu[:, 2 * HIDDEN :])
            if keep is not None:
                keep[t] = (h.copy(), z.copy(), r.copy(), n, hu[:, 2 * HIDDEN :].copy())
            h -= n
            h *= z
            h += n
            states[t] = h
        return states

    def _back(self, dstates: np.ndarray, x: np.ndarray, way: str, keep: list, grads: dict) -> None:
        """Backpropagation through time of one direction."""
        u = self.p[f"u_{way}"]
        dh, du = np.zeros(dstates.shape[1:], np.float32), np.zeros_like(u)
        dx = np.empty((*x.shape, 3 * HIDDEN), np.float32)
        for t in reversed(_order(len(x), way)):
            h, z, r, n, hn = keep[t]
            dh = dh + dstates[t]
            dn = dh * (1 - z) * (1 - n * n)
            dz = dh * (h - n) * z * (1 - z)
            dr = dn * hn * r * (1 - r)
            dx[t] = np.concatenate([dz, dr, dn], axis=1)
            through = np.concatenate([dz, dr, dn * r], axis=1)
            du += h.T @ through
            dh = dh * z + through @ u.T
        grads[f"u_{way}"] = du
        flat, places = dx.reshape(-1, 3 * HIDDEN), x.ravel()
        grads[f"in_{way}"] = np.stack([np.bincount(places, flat[:, j], 256) for j in range(3 * HIDDEN)], 1).astype(np.float32)

    # ---- whole network ------------------------------------------------------------------------------------

    def _probabilities(self, hf: np.ndarray, hb: np.ndarray) -> np.ndarray:
        logits = hf @ self.p["out_f"]
        logits += hb @ self.p["out_b"]
        logits += self.p["bias"]
        logits -= logits.max(axis=-1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=-1, keepdims=True)
        return logits

    def step(self, x: np.ndarray, label: np.ndarray, counted: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean cross entropy over the counted positions; x and counted are (time, rows)."""
        kf, kb = [None] * len(x), [None] * len(x)
        hf, hb = self._states(x, "f", kf), self._states(x, "b", kb)
        d = self._probabilities(hf, hb)
        d[:, np.arange(x.shape[1]), label] -= 1
        d *= (counted / max(1, counted.sum()))[:, :, None]
        d = d.astype(np.float32)
        grads = {"bias": d.sum(axis=(0, 1)), "out_f": np.tensordot(hf, d, ([0, 1], [0, 1])), "out_b": np.tensordot(hb, d, ([0, 1], [0, 1]))}
        self._back(d @ self.p["out_f"].T, x, "f", kf, grads)
        self._back(d @ self.p["out_b"].T, x, "b", kb, grads)
        return grads

    def positions(self, rows: np.ndarray) -> Iterator[np.ndarray]:
        """For groups of _ROWS windows, the label probabilities of their stretches: (STRETCH, windows, labels)."""
        for at in range(0, len(rows), _ROWS):
            x = np.ascontiguousarray(rows[at : at + _ROWS].T)
            inside = slice(CONTEXT, CONTEXT + STRETCH)
            hf, hb = self._states(x[: CONTEXT + STRETCH], "f")[inside], self._states(x[CONTEXT:], "b")[:STRETCH]
            yield self._probabilities(hf, hb)

    def pooled(self, texts: Sequence[np.ndarray]) -> np.ndarray:
        """Per text the mean label probabilities over all positions of letters; zeros without any."""
        cut = list(map(_windows, texts))
        rows = np.concatenate(cut)
        counted = _LETTER[rows[:, CONTEXT : CONTEXT + STRETCH]]
        sums, at = np.zeros((len(rows), len(self.labels))), 0
        for part in self.positions(rows):
            weight = counted[at : at + part.shape[1]].T
            sums[at : at + part.shape[1]] = np.einsum("twl,tw->wl", part, weight.astype(np.float32))
            at += part.shape[1]
        first = np.cumsum([0, *map(len, cut[:-1])])
        total, n = np.add.reduceat(sums, first, axis=0), np.add.reduceat(counted.sum(axis=1), first)
        return total / np.maximum(n, 1)[:, None]

    def labelled(self, text: np.ndarray) -> np.ndarray:
        """The number of the likeliest label at every position of a text."""
        found = [part.argmax(axis=2).T.ravel() for part in self.positions(_windows(text))]
        return np.concatenate(found)[: len(text)]


def _order(steps: int, way: str) -> range:
    return range(steps) if way == "f" else range(steps - 1, -1, -1)


def train(pieces: Sequence[str], labels: Sequence[str], seed: int = 5, epochs: int = 6, rate: float = 0.01) -> ByteNetwork:
    """A network for pieces of labelled texts. Every label weighs alike, however many pieces it has."""
    names = sorted(set(labels))
    net, rng = ByteNetwork.fresh(names, seed), np.random.default_rng(seed)
    if len(names) < 2:
        return net
    width = _LEARN + 2 * CONTEXT
    x = np.full((len(pieces), width), _PAD, np.uint8)
    for i, piece in enumerate(pieces):
        data = to_bytes(piece)[:width]
        x[i, : len(data)] = data
    label = np.array([names.index(y) for y in labels])
    of_label = [np.flatnonzero(label == k) for k in range(len(names))]
    each = max(1, min(max(len(pieces), 4096), 8192) // len(names))  # few pieces are taken several times
    m, v, done = {k: np.zeros_like(w) for k, w in net.p.items()}, {k: np.zeros_like(w) for k, w in net.p.items()}, 0
    for epoch in range(epochs):
        picked = np.concatenate([rng.choice(rows, each, len(rows) < each) for rows in of_label])
        rng.shuffle(picked)
        pace = rate if epoch < epochs - 2 else rate / 4
        for at in range(0, len(picked), _BATCH):
            now = picked[at : at + _BATCH]
            batch = np.ascontiguousarray(x[now].T)
            counted = _LETTER[batch]
            counted[:CONTEXT], counted[-CONTEXT:] = False, False
            done += 1
            for k, g in net.step(batch, label[now], counted).items():
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.01 * (g * g - v[k])
                net.p[k] -= (pace * (m[k] / (1 - 0.9**done)) / (np.sqrt(v[k] / (1 - 0.99**done)) + 1e-6)).astype(np.float32)
    return net
