"""A bidirectional gated recurrent network with attention pooling, in numpy.

A word's input is a vector of its own, if the word was frequent enough in training, and the
mean of the vectors of its character n-grams. The network reads windows of words in both
directions, weighs the states by attention and gives one logit per window. A text is toxic if one
of its windows is: the probabilities are joined as those of independent causes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from parvis.llm.words import LETTERS, Words, cut_words, mix, text_bytes

WINDOW, STRIDE = 32, 24
HIDDEN, WIDTH, GRAMS = 8, 8, 1 << 14
OWN_WORD = 5  # texts in which a word must occur to get a vector of its own


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Inputs:
    """Distinct words of some texts, their grams, and windows of their indices (-1: no word)."""

    hashes: np.ndarray
    grams: np.ndarray
    gram_start: np.ndarray
    windows: np.ndarray
    text: np.ndarray  # the text of each window


def inputs_of(words: Words) -> Inputs:
    hashes, sample, index = np.unique(words.hash, return_index=True, return_inverse=True)
    start, end = words.start[sample], words.end[sample]
    length = end - start
    first = np.concatenate([[0], np.cumsum(length)])
    at = np.arange(first[-1]) + np.repeat(start - first[:-1], length)
    begin, stop = np.repeat(start, length), np.repeat(end, length)
    data = np.append(words.data, np.zeros(3, np.uint8)).astype(np.uint64)
    before = np.where(at > begin, data[at - 1], 1)
    one = np.where(at + 1 < stop, data[at + 1], 2)
    two = np.where(at + 2 < stop, data[at + 2], 2)
    three = before << np.uint64(16) | data[at] << np.uint64(8) | one
    four = three << np.uint64(8) | two | np.uint64(1 << 40)
    grams = np.stack([mix(three), mix(four)], axis=1).ravel() % np.uint64(GRAMS)

    counts = np.diff(words.first)
    many = np.where(counts > 0, np.maximum(1, -(-(counts - WINDOW) // STRIDE) + 1), 0)
    text = np.repeat(np.arange(len(counts)), many)
    number = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
    place = number[:, None] * STRIDE + np.arange(WINDOW)
    inside = place < counts[text][:, None]
    where = np.minimum(words.first[:-1][text][:, None] + place, max(len(index) - 1, 0))
    windows = np.where(inside, index[where] if len(index) else 0, -1)
    return Inputs(hashes, grams.astype(np.int64), first[:-1] * 2, windows, text)


class Network:
    def __init__(self, vocabulary: np.ndarray, seed: int = 1) -> None:
        rng = np.random.default_rng(seed)
        small = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
        self.vocabulary = vocabulary  # sorted hashes; row 0 of the word vectors is for others
        self.p = {
            "word": np.zeros((len(vocabulary) + 1, WIDTH), np.float32), "gram": small(GRAMS, WIDTH),
            "in": small(2 * WIDTH, 6 * HIDDEN), "bias": np.zeros(6 * HIDDEN, np.float32),
            "back0": small(HIDDEN, 3 * HIDDEN), "back1": small(HIDDEN, 3 * HIDDEN),
            "att": small(2 * HIDDEN, HIDDEN), "look": small(HIDDEN),
            "out": small(2 * HIDDEN), "last": np.full(1, -4, np.float32)}

    def words(self, x: Inputs) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the word vectors, and the input vectors, of the distinct words."""
        if not len(self.vocabulary):
            own = np.zeros(len(x.hashes), np.int64)
        else:
            at = np.minimum(np.searchsorted(self.vocabulary, x.hashes), len(self.vocabulary) - 1)
            own = np.where(self.vocabulary[at] == x.hashes, at + 1, 0)
        sums = np.add.reduceat(self.p["gram"][x.grams], x.gram_start, axis=0)
        size = np.diff(np.append(x.gram_start, len(x.grams)))[:, None]
        return own, np.concatenate([self.p["word"][own], sums / size], axis=1).astype(np.float32)

    def forward(self, x: Inputs, keep: bool = False):
        """The logit of each window; with ``keep`` also what the gradient needs."""
        p, n = self.p, len(x.windows)
        own, vectors = self.words(x)
        ready = np.vstack([vectors @ p["in"] + p["bias"], np.zeros(6 * HIDDEN, np.float32)])
        states, steps = np.zeros((2, WINDOW, n, HIDDEN), np.float32), ([], [])
        mask = (x.windows >= 0).astype(np.float32)
        for way, order in ((0, range(WINDOW)), (1, range(WINDOW - 1, -1, -1))):
            h, back = np.zeros((n, HIDDEN), np.float32), p[f"back{way}"]
            part = np.ascontiguousarray(ready[:, way * 3 * HIDDEN:(way + 1) * 3 * HIDDEN])
            for t in order:
                given, own_part = part[x.windows[:, t]], h @ back
                gates = sigmoid(given[:, :2 * HIDDEN] + own_part[:, :2 * HIDDEN])
                z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
                new = np.tanh(given[:, 2 * HIDDEN:] + r * own_part[:, 2 * HIDDEN:])
                m = mask[:, t:t + 1]
                old, h = h, h + m * (1 - z) * (new - h)
                states[way, t] = h
                if keep:
                    steps[way].append((t, old, z, r, new, own_part[:, 2 * HIDDEN:]))
        both = np.concatenate([states[0], states[1]], axis=2)  # step, window, state
        seen = np.tanh(both @ p["att"])
        weight = np.exp(seen @ p["look"]) * mask.T
        weight /= weight.sum(axis=0) + 1e-9
        pooled = (weight[:, :, None] * both).sum(axis=0)
        logit = pooled @ p["out"] + p["last"]
        return (logit, (own, vectors, steps, both, seen, weight, pooled, mask)) if keep else logit

    def gradient(self, x: Inputs, kept, dlogit: np.ndarray) -> dict[str, np.ndarray]:
        p, g = self.p, {k: np.zeros_like(v) for k, v in self.p.items()}
        own, vectors, steps, both, seen, weight, pooled, mask = kept
        g["out"], g["last"] = pooled.T @ dlogit, dlogit.sum(keepdims=True)
        dpooled = dlogit[:, None] * p["out"]
        dboth = weight[:, :, None] * dpooled
        dweight = (both * dpooled).sum(axis=2)
        dscore = weight * (dweight - (weight * dweight).sum(axis=0))
        g["look"] = (seen * dscore[:, :, None]).sum(axis=(0, 1))
        dseen = dscore[:, :, None] * p["look"] * (1 - seen ** 2)
        g["att"] = np.einsum("tni,tnj->ij", both, dseen)
        dboth += dseen @ p["att"].T
        dready = np.zeros((len(vectors) + 1, 6 * HIDDEN), np.float32)
        for way in (0, 1):
            back, dh = p[f"back{way}"], np.zeros((len(x.windows), HIDDEN), np.float32)
            for t, old, z, r, new, from_state in reversed(steps[way]):
                dh = dh + dboth[t, :, way * HIDDEN:(way + 1) * HIDDEN]
                dm = dh * mask[:, t:t + 1]
                dz = dm * (old - new) * z * (1 - z)
                dnew = dm * (1 - z) * (1 - new ** 2)
                dr = dnew * from_state * r * (1 - r)
                dgiven = np.concatenate([dz, dr, dnew], axis=1)
                dpart = np.concatenate([dz, dr, dnew * r], axis=1)
                np.add.at(dready[:, way * 3 * HIDDEN:(way + 1) * 3 * HIDDEN], x.windows[:, t],
                          dgiven)
                g[f"back{way}"] += old.T @ dpart
                dh = dh - dm * (1 - z) + dpart @ back.T
        dready = dready[:-1]
        g["in"], g["bias"] = vectors.T @ dready, dready.sum(axis=0)
        dvectors = dready @ p["in"].T
        np.add.at(g["word"], own, dvectors[:, :WIDTH])
        g["word"][0] = 0
        size = np.diff(np.append(x.gram_start, len(x.grams)))
        np.add.at(g["gram"], x.grams, np.repeat(dvectors[:, WIDTH:] / size[:, None], size, axis=0))
        return g

    def scores(self, x: Inputs, texts: int) -> np.ndarray:
        """The probability of each of ``texts`` texts; 0 for texts without words."""
        if not len(x.windows):
            return np.zeros(texts)
        clean = np.log1p(-np.minimum(sigmoid(self.forward(x).astype(np.float64)), 1 - 1e-12))
        return -np.expm1(np.bincount(x.text, clean, texts))


def words_of(texts: list[str]) -> Words:
    return cut_words(*text_bytes(pa.array(texts, pa.string())), LETTERS)


def train(texts: list[str], labels: np.ndarray, steps: int = 240, size: int = 16,
          rate: float = 0.02, seed: int = 1) -> Network:
    """Fit on labelled texts; each step takes as many toxic as other texts, if there are any."""
    rng = np.random.default_rng(seed)
    known = [np.unique(words_of([t]).hash) for t in texts]
    found, counts = np.unique(np.concatenate([*known, np.empty(0, np.uint64)]), return_counts=True)
    net = Network(found[counts >= OWN_WORD], seed)
    groups = [g for g in (np.flatnonzero(labels == k) for k in (0, 1)) if len(g)]
    moment = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.p.items()}
    for step in range(1, steps + 1 if groups else 1):
        picked = np.concatenate([rng.choice(g, size // len(groups)) for g in groups])
        x = inputs_of(words_of([texts[i] for i in picked]))
        if not len(x.windows):
            continue
        logit, kept = net.forward(x, keep=True)
        chance = sigmoid(logit)
        clean = np.exp(np.bincount(x.text, np.log1p(-np.minimum(chance, 1 - 1e-6)), size))
        # d loss / d logit of a window, of -log of the probability of its text's label
        toxic = chance * clean[x.text] / np.maximum(1 - clean[x.text], 1e-6)
        slope = np.where(labels[picked][x.text] == 0, chance, -toxic)
        total = net.gradient(x, kept, (slope / size).astype(np.float32))
        for k, v in net.p.items():
            a, b = moment[k]
            a += 0.1 * (total[k] - a)
            b += 0.001 * (total[k] ** 2 - b)
            now = rate * min(1, 2 - 2 * step / steps)
            v -= now * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)
    return net
