"""Token ids of texts by the ``tokenizers`` library, with each distinct piece encoded once.

A byte-level tokenizer splits a text before it merges bytes. Between a character that is no
white space and a single space, or around a single line break, it always splits; cutting there
changes no id. So texts are cut there, in the bytes of whole batches; the distinct pieces are
encoded, kept by their 64-bit hashes, and the ids of the texts are put together from them.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa

from parvis.llm.words import Words, range_hashes, slices, text_bytes

KNOWN = {"texts": 1_000_000, "words": 3_000_000}  # pieces a worker keeps; then it starts anew
TOGETHER = 2048
RECENT = 1 << 16  # pieces kept apart at least, so that few are not put among many again and again

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
# First bytes of characters some of which are white space, and the bytes before their last one.
_OPENS, _CLOSES = np.zeros(256, bool), np.zeros(256, bool)
_OPENS[[0xC2, 0xE1, 0xE2, 0xE3]] = True
_CLOSES[[0xC2, 0x80, 0x81, 0x9A]] = True
# Words without any byte of which a white space character may be made.
_CLEAR = re.compile(rb"[^\x00-\x20\x7F\xC2\xE1\xE2\xE3]+")


def cut_pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the pieces of the texts at ``offsets`` begin, and each text's first piece."""
    n = len(data)
    space = _SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    unclear = space | _OPENS[data]
    after = np.append(unclear[1:], True) | edge[1:]  # the next byte may be white space
    before = np.ones(n, bool)
    before[1:] = space[:-1]
    before[2:] |= (data[1:-1] >= 0x80) & _CLOSES[data[:-2]]
    before |= edge[:-1]
    alone = space & ~after & ~before
    begins = edge[:-1] | (alone & ((data == 0x20) | (data == 0x0A)))
    begins[1:] |= (alone & (data == 0x0A))[:-1]
    start = np.flatnonzero(begins)
    return start, np.searchsorted(start, offsets)


@dataclass
class Pieces:
    """Where the ids of pieces begin and how many they are, by the pieces' ascending hashes."""

    keys: np.ndarray
    begin: np.ndarray
    size: np.ndarray

    @staticmethod
    def none() -> Pieces:
        return Pieces(np.empty(0, np.uint64), np.empty(0, np.uint32), np.empty(0, np.uint32))

    def find(self, hashes: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Which hashes are here; ``begin`` and ``size`` are filled in for them."""
        if not len(self.keys):
            return np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        here = self.keys[at] == hashes
        begin[here], size[here] = self.begin[at[here]], self.size[at[here]]
        return here

    def with_more(self, more: Pieces) -> Pieces:
        """These and others, none of which is here."""
        at = np.searchsorted(self.keys, more.keys)
        return Pieces(np.insert(self.keys, at, more.keys), np.insert(self.begin, at, more.begin),
                      np.insert(self.size, at, more.size))


class Encoder:
    """Ids of texts, exactly as the tokenizer gives them for whole texts."""

    def __init__(self, path: str | None = None, known: int = KNOWN["texts"]) -> None:
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("byte_bpe_50k.json")
        self.path, self.known = path, known
        self._forget()

    def __reduce__(self):
        return Encoder, (self.path, self.known)

    def _forget(self) -> None:
        self.old, self.recent = Pieces.none(), Pieces.none()
        self.flat, self.used = np.empty(65536, np.uint16), 0

    @cached_property
    def tokenizer(self):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    @cached_property
    def spaced(self) -> np.ndarray:
        """Which ids begin with a space, in the letters of byte-level tokenizers."""
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        out = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        out[[i for token, i in vocabulary.items() if token.startswith("\u0120")]] = True
        return out

    def _each(self, texts: list[str]) -> tuple[list[int], list[int]]:
        """The sizes and the ids of texts, one by one."""
        sizes, parts = [], []
        for a in range(0, len(texts), TOGETHER):
            for e in self.tokenizer.encode_batch_fast(texts[a:a + TOGETHER],
                                                      add_special_tokens=False):
                ids = e.ids
                sizes.append(len(ids))
                parts += ids
        return sizes, parts

    def _spaced_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The sizes and the ids of words with a space before each.

        Clear words are encoded in a row, as the tokenizer splits before each space between them,
        and parted where ids begin with a space; if that gives other than one part a word, and for
        other words, each is encoded by itself.
        """
        clear = np.array([_CLEAR.fullmatch(w) is not None for w in words], bool)
        order = np.argsort(~clear, kind="stable")
        whole = [" " + words[i].decode(errors="replace") for i in order.tolist()]
        sizes, parts, many = [], [], int(clear.sum())
        for a in range(0, many, TOGETHER):
            some = whole[a:min(a + TOGETHER, many)]
            e, = self.tokenizer.encode_batch_fast(["".join(some)], add_special_tokens=False)
            ids = np.array(e.ids, np.int64)
            first = np.flatnonzero(self.spaced[ids])
            if len(first) != len(some) or first[0]:
                size, ids = self._each(some)
            else:
                size = np.diff(np.append(first, len(ids)))
            sizes.append(np.asarray(size, np.int64))
            parts.append(np.asarray(ids, np.int64))
        size, ids = self._each(whole[many:])
        size = np.concatenate([*sizes, np.asarray(size, np.int64)])
        ids = np.concatenate([*parts, np.asarray(ids, np.int64)])
        back = np.argsort(order)
        begin = (np.cumsum(size) - size)[back]
        size = size[back]
        ends = np.cumsum(size)
        return size, ids[np.arange(len(ids)) + np.repeat(begin - ends + size, size)]

    def look_up(self, hashes: np.ndarray, piece: Callable[[int], str | bytes],
                encode: Callable[[list], tuple] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Begin and size in ``flat`` of the ids of distinct pieces; ``piece(i)`` is the i-th.

        ``encode`` gives the sizes and the ids of new pieces.
        """
        begin, size = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
        known = self.old.find(hashes, begin, size) | self.recent.find(hashes, begin, size)
        new = np.flatnonzero(~known)
        if len(new):
            many = len(self.old.keys) + len(self.recent.keys)
            if many + len(new) > self.known and many:
                self._forget()
                return self.look_up(hashes, piece, encode)
            sizes, parts = (encode or self._each)([piece(i) for i in new.tolist()])
            size[new] = sizes
            begin[new] = self.used + np.cumsum(size[new]) - size[new]
            if self.used + len(parts) > len(self.flat):
                wider = np.empty((self.used + len(parts)) * 3 // 2, np.uint16)
                wider[:self.used] = self.flat[:self.used]
                self.flat = wider
            self.flat[self.used:self.used + len(parts)] = parts
            self.used += len(parts)
            order = new[np.argsort(hashes[new])]
            self.recent = self.recent.with_more(Pieces(
                hashes[order], begin[order].astype(np.uint32), size[order].astype(np.uint32)))
            if len(self.recent.keys) > max(RECENT, len(self.old.keys) // 8):
                self.old, self.recent = self.old.with_more(self.recent), Pieces.none()
        return begin, size

    def _gather(self, begin: np.ndarray, size: np.ndarray, index: np.ndarray,
                first: np.ndarray, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts made of pieces ``index``, each closed by ``end_id``, and their offsets."""
        length = size[index]
        total = np.concatenate([[0], np.cumsum(length)])
        closed = 0 if end_id is None else 1
        offsets = total[first] + closed * np.arange(len(first))
        ids = np.full(offsets[-1], end_id or 0, np.uint16)
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        place = np.arange(total[-1])
        source = place + np.repeat(begin[index] - total[:-1], length)
        ids[place + closed * np.repeat(text, length)] = self.flat[source]
        return ids, offsets

    def column_ids(self, column: pa.Array, end_id: int | None = None
                   ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """``(i, j, ids, offsets)`` of the texts i to j of a string column; null is empty."""
        data, offsets = text_bytes(column)
        for i, j in slices(offsets):
            part, at = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
            start, first = cut_pieces(part, at)
            end = np.append(start[1:], len(part)) if len(start) else start
            distinct, sample, index = np.unique(
                range_hashes(part, start, end), return_index=True, return_inverse=True)
            begin, size = self.look_up(distinct, lambda k: part[
                start[sample[k]]:end[sample[k]]].tobytes().decode())
            yield i, j, *self._gather(begin, size, index, first, end_id)

    def word_ids(self, words: Words, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words with a space before each, per text closed by ``end_id``, and offsets.

        An encoder is used either for words or for columns, as both keep pieces by own hashes.
        """
        distinct, sample, index = words.distinct
        begin, size = self.look_up(distinct, lambda k: words.word(sample[k]), self._spaced_words)
        return self._gather(begin, size, index, words.first, end_id)


_encoders: dict[tuple[str | None, str], Encoder] = {}


def encoder(path: str | None = None, use: str = "texts") -> Encoder:
    """This worker's encoder of a tokenizer file."""
    if (path, use) not in _encoders:
        _encoders[path, use] = Encoder(path, KNOWN[use])
    return _encoders[path, use]
