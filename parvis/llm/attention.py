"""A small causal self-attention language model over classes of subword ids, in numpy.

The most frequent ids are classes of their own, all others share one; within that class the
corpus counts decide. One attention layer and one hidden layer work on windows; what the last
id says about the next is a table of its own.
"""

from __future__ import annotations

import numpy as np

WINDOW, STRIDE = 32, 24  # a window scores its last STRIDE places, the first of a text all
CLASSES, WIDTH, INNER = 128, 16, 32
LARGEST = np.float32(60)  # exponents beyond that, either way, are shifted
SCALE = np.float32(WIDTH ** -0.5)
BLOCK = 64
EVERY = np.ones((CLASSES, 1), np.float32)
START = CLASSES  # the input before the first id


def windows_of(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places (text, start, first scored place) of the windows of texts with ``counts`` ids."""
    many = np.where(counts > 0, np.maximum(1, -(-(counts - WINDOW) // STRIDE) + 1), 0)
    text = np.repeat(np.arange(len(counts)), many)
    number = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
    return text, number * STRIDE, np.where(number > 0, WINDOW - STRIDE, 0)


def _extreme(exponents: np.ndarray) -> bool:
    return exponents.size > 0 and (exponents.max() > LARGEST or exponents.min() < -LARGEST)


def _by_id(ids: np.ndarray, rows: np.ndarray, out: np.ndarray) -> None:
    """The sums of ``rows`` with the same id, for every id; ``ids`` ascend, and ``out`` holds zeros."""
    own, first = np.unique(ids, return_index=True)
    if rows.shape[1] <= WIDTH:
        out[own] = np.add.reduceat(rows, first, axis=0)
        return
    one, first = np.ones(len(ids), rows.dtype), first.tolist()
    for i, a, b in zip(own.tolist(), first, [*first[1:], len(ids)], strict=True):
        np.dot(one[:b - a], rows[a:b], out[i])  # a product is faster than adding wide rows


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a.T @ b`` for long and narrow arrays, in blocks of rows: BLAS is slow along so long a side."""
    whole = len(a) - len(a) % BLOCK
    out = a[whole:].T @ b[whole:]
    if whole:
        blocks = (c[:whole].reshape(-1, BLOCK, c.shape[1]) for c in (a, b))
        out += np.matmul(next(blocks).transpose(0, 2, 1), next(blocks)).sum(axis=0)
    return out


class Attention:
    def __init__(self, unigram: np.ndarray, seed: int = 3) -> None:
        rng = np.random.default_rng(seed)
        small = lambda *shape: rng.normal(0, 0.2, shape).astype(np.float32)
        zero = lambda *shape: np.zeros(shape, np.float32)
        p = {
            "id": small(CLASSES + 1, WIDTH), "at": small(WINDOW, WIDTH), "q": small(WIDTH, WIDTH),
            "k": small(WIDTH, WIDTH), "v": small(WIDTH, WIDTH), "up": small(WIDTH, INNER),
            "down": zero(INNER, WIDTH), "out": zero(WIDTH, CLASSES),
            "next": zero(CLASSES + 1, CLASSES), "bias": np.log(unigram).astype(np.float32)}
        names = sorted(p)
        ends = np.cumsum([p[k].size for k in names]).tolist()
        self.places = {k: (b - p[k].size, b, p[k].shape) for k, b in zip(names, ends, strict=True)}
        self.values = np.concatenate([p[k].ravel() for k in names])
        self.p = self.parts(self.values)
        self.seen = np.tril(np.ones((WINDOW, WINDOW), np.float32))
        self.hidden = np.triu(np.full((WINDOW, WINDOW), -1e9, np.float32), 1)

    def parts(self, values: np.ndarray) -> dict[str, np.ndarray]:
        """Views of the parameters, by name, in one vector of all."""
        return {k: values[a:b].reshape(shape) for k, (a, b, shape) in self.places.items()}

    def attend(self, ids: np.ndarray):
        """The attention layer on windows ``ids``: its weights are not divided by their ``total`` yet."""
        p, n = self.p, len(ids)
        x = p["id"].take(ids.ravel(), axis=0)
        whole = x.reshape(n, WINDOW * WIDTH)
        whole += p["at"].ravel()
        shares = np.hstack([p["q"] * SCALE, p["k"], p["v"]])
        q, k, v = np.split((x @ shares).reshape(n, WINDOW, 3 * WIDTH), 3, axis=2)
        weight = q @ k.transpose(0, 2, 1)
        if _extreme(weight):
            weight += self.hidden
            weight -= weight.max(axis=2, keepdims=True)
        np.exp(weight, out=weight)
        weight *= self.seen
        total = weight @ np.ones((WINDOW, 1), np.float32)
        mixed = weight @ v
        mixed /= total
        return x, shares, q, k, v, weight, total, mixed

    def hide(self, x: np.ndarray, mixed: np.ndarray, at: np.ndarray):
        """The hidden layer at places ``at`` of all windows: what enters it, itself, what leaves it."""
        y = mixed.reshape(-1, WIDTH).take(at, axis=0)
        y += x.take(at, axis=0)
        inner = y @ self.p["up"]
        np.maximum(inner, 0, out=inner)
        z = inner @ self.p["down"]
        z += y
        return y, inner, z

    def logits(self, z: np.ndarray, own: np.ndarray) -> np.ndarray:
        """The classes' logits, up to a shift, at places with ids ``own`` where the layers made ``z``."""
        logits = (self.p["next"] + self.p["bias"]).take(own, axis=0)
        logits += z @ self.p["out"]
        if _extreme(logits):
            logits -= logits.max(axis=1, keepdims=True)
        return logits

    def forward(self, ids: np.ndarray):
        """The classes' probabilities at every place of windows ``ids``, and what led to them."""
        inside = self.attend(ids)
        z = self.hide(inside[0], inside[-1], np.arange(ids.size))[-1]
        chances = np.exp(self.logits(z, ids.ravel()))
        chances /= chances @ EVERY
        return chances.reshape(*ids.shape, CLASSES), inside

    def score(self, ids: np.ndarray, wanted: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """Natural log probability of class ``wanted`` at the places with ``mask``, in their order."""
        x, *_, mixed = self.attend(ids)
        at = np.flatnonzero(mask)
        logits = self.logits(self.hide(x, mixed, at)[-1], ids.ravel().take(at))
        own = logits.ravel().take(np.arange(len(at)) * CLASSES + wanted.ravel().take(at))
        np.exp(logits, out=logits)
        return own - np.log(logits @ EVERY)[:, 0]

    def gradient(self, ids: np.ndarray, wanted: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """The gradient of the mean negative log likelihood over places with ``mask``, as one vector.

        Places go by their ids, so what belongs to one id is one run of rows.
        """
        values = np.zeros_like(self.values)
        p, g, kinds, n = self.p, self.parts(values), ids.ravel().astype(np.uint8), len(ids)
        at = np.flatnonzero(mask)
        if not len(at):
            return values
        at = at.take(np.argsort(kinds.take(at), kind="stable"))
        own = kinds.take(at)
        x, shares, q, k, v, weight, total, mixed = self.attend(ids)
        y, inner, z = self.hide(x, mixed, at)

        d = self.logits(z, own)
        np.exp(d, out=d)
        d *= 1 / (d @ EVERY * np.float32(len(at)))
        d.ravel()[np.arange(len(at)) * CLASSES + wanted.ravel().take(at)] -= np.float32(1 / len(at))
        _by_id(own, d, g["next"])
        g["bias"][:] = g["next"].sum(axis=0)
        g["out"][:] = _product(z, d)
        dz = d @ p["out"].T
        g["down"][:] = _product(inner, dz)
        dinner = dz @ p["down"].T
        dinner *= inner > 0
        g["up"][:] = _product(y, dinner)
        dz += dinner @ p["up"].T

        dx = np.zeros_like(x)
        dx[at] = dz
        dmixed = dx.reshape(mixed.shape) / total
        dscore = dmixed @ v.transpose(0, 2, 1)
        dscore -= np.einsum("nij,nij->ni", dmixed, mixed)[:, :, None]
        dscore *= weight
        dshares = np.empty((n, WINDOW, 3 * WIDTH), np.float32)
        dq, dk, dv = np.split(dshares, 3, axis=2)
        np.matmul(dscore, k, out=dq)
        np.matmul(dscore.transpose(0, 2, 1), q, out=dk)
        np.matmul(weight.transpose(0, 2, 1), dmixed, out=dv)
        dshares = dshares.reshape(-1, 3 * WIDTH)
        g["q"][:], g["k"][:], g["v"][:] = np.split(_product(x, dshares), 3, axis=1)
        g["q"] *= SCALE
        dx += dshares @ shares.T
        g["at"].ravel()[:] = dx.reshape(n, -1).sum(axis=0)
        order = np.argsort(kinds, kind="stable")
        _by_id(kinds.take(order), dx.take(order, axis=0), g["id"])
        return values

    def flat(self) -> np.ndarray:
        return self.values.copy()

    def load(self, values: np.ndarray) -> None:
        self.values[:] = values


class Adam:
    def __init__(self, net: Attention, rate: float) -> None:
        self.net, self.rate, self.step = net, rate, 0
        self.mean, self.square = np.zeros_like(net.values), np.zeros_like(net.values)

    def learn(self, ids: np.ndarray, wanted: np.ndarray, mask: np.ndarray) -> None:
        self.step += 1
        g = self.net.gradient(ids, wanted, mask)
        change = g - self.mean
        change *= np.float32(0.1)
        self.mean += change
        g *= g
        g -= self.square
        g *= np.float32(0.01)
        self.square += g
        np.multiply(self.square, np.float32(1 / (1 - 0.99 ** self.step)), out=g)
        np.sqrt(g, out=g)
        g += np.float32(1e-8)
        np.divide(self.mean, g, out=change)
        change *= np.float32(self.rate / (1 - 0.9 ** self.step))
        self.net.values -= change
