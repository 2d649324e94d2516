"""Byte-level BPE of whole texts with content-defined chunks, and its decoding.

A text is cut where a rolling hash of its last bytes is the smallest of its neighbourhood, so a
passage that several documents share gives the same chunks in each of them. A worker encodes
each distinct chunk once and keeps its ids; the words of a new chunk are looked up in the same way,
so the tokenizer itself sees a word once. What the tokenizer would do differently across a cut
is repaired: a window around each join is encoded by itself, from a place that is settled in
the chunk before it, and must come to a place where it agrees with the chunk after it; where
it doesn't, the two chunks are one and everything about them is encoded again.

Why agreement is exact: the tokenizer splits a text from left to right into pieces, and where a
piece ends depends on nothing before it and on at most two characters behind its end. Ids
within a piece depend on that piece alone. So where two encodings of one text both begin a piece,
they go on alike, up to two characters before the end of the shorter one.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parvis.llm.subwords import cut_pieces
from parvis.llm.tables import id_text
from parvis.llm.words import slices, text_bytes

HASHED, APART = 32, 128  # bytes in the rolling hash; a cut is the least hash this far around it
SETTLED = 8  # two characters of UTF-8
AHEAD = 24  # bytes of the next chunk that a window takes at first
# What a worker keeps of chunks and of words, in bytes with so many for each; then it starts anew.
KEPT_CHUNKS, KEPT_WORDS, ENTRY = 48 << 20, 144 << 20, 100
TOGETHER = 4096

# A space and characters of which neither the first nor the last is white space.
_SOLID = rb"(?:[!-~]|[\xc3-\xdf][\x80-\xbf]|[\xe4-\xed][\x80-\xbf]{2})"
_APART = re.compile(rb" " + _SOLID + rb"(?:[^ \t-\r]*" + _SOLID + rb")?")

_SCATTER = np.random.default_rng(20240612).integers(0, 1 << 32, 256, dtype=np.uint32)


def cut_places(data: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Where to cut texts that lie between ``edges``; only what is near a place decides on it."""
    n = len(data)
    if n < HASHED + 2 * APART:
        return np.empty(0, np.int64)
    rolled, step = _SCATTER[data], 1
    while step < HASHED:
        more = rolled.copy()
        turned = rolled[:-step]
        more[step:] ^= (turned << np.uint32(step)) | (turned >> np.uint32(32 - step))
        rolled, step = more, 2 * step
    rolled[(data & 0xC0) == 0x80] = 0xFFFFFFFF  # never inside a character
    least, step = rolled, 1
    while step < APART:  # the least of the next APART places
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    inner = np.arange(APART, n - APART)
    found = inner[(rolled[inner] < least[inner - APART]) & (rolled[inner] < least[inner + 1])]
    text = np.searchsorted(edges, found, side="right")
    return found[(found - APART - HASHED >= edges[text - 1]) & (found + APART < edges[text])]


def _byte_alphabet() -> dict[str, int]:
    """The printable characters that stand for bytes in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def _grown(a: np.ndarray, n: int) -> np.ndarray:
    if n <= len(a):
        return a
    more = np.empty(max(n, 2 * len(a)), a.dtype)
    more[:len(a)] = a
    return more


class _Kept:
    """Byte strings with their ids, and with a mark on each id that begins a piece of the split."""

    def __init__(self) -> None:
        self.place: dict[bytes, int] = {}
        self.kept, self.used = 0, 0
        self.begin, self.size = np.empty(1024, np.int64), np.empty(1024, np.int64)
        self.flat, self.opens = np.empty(65536, np.uint32), np.empty(65536, bool)

    def places(self, raw: bytes, start: np.ndarray, end: np.ndarray
               ) -> tuple[np.ndarray, list[bytes]]:
        """The places of byte ranges, and those that are new and get the next ones."""
        place, new = self.place, []
        pieces = [raw[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)]
        out = list(map(place.get, pieces))
        for i in [i for i, k in enumerate(out) if k is None]:
            k = place.get(pieces[i])
            if k is None:
                k = place[pieces[i]] = len(place)
                new.append(pieces[i])
                self.kept += len(pieces[i]) + ENTRY
            out[i] = k
        return np.array(out, np.int64), new

    def add(self, ids: np.ndarray, opens: np.ndarray, size: np.ndarray, first: int) -> None:
        """The ids of the byte strings from place ``first`` on."""
        last, here = first + len(size), slice(self.used, self.used + len(ids))
        self.begin, self.size = _grown(self.begin, last), _grown(self.size, last)
        self.begin[first:last] = self.used + np.cumsum(size) - size
        self.size[first:last] = size
        self.flat, self.opens = _grown(self.flat, here.stop), _grown(self.opens, here.stop)
        self.flat[here], self.opens[here] = ids, opens
        self.used = here.stop

    def gather(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of byte strings one after the other, whose they are, and the marks."""
        size = self.size[places]
        owner = np.repeat(np.arange(len(places)), size)
        source = np.arange(len(owner)) + np.repeat(
            self.begin[places] - (np.cumsum(size) - size), size)
        return self.flat[source], owner, self.opens[source]


class ChunkCoder:
    """Ids of texts exactly as the tokenizer gives them, and texts of ids."""

    def __init__(self, path: str | None = None) -> None:
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("byte_bpe_50k.json")
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        split, added = made["pre_tokenizer"] or {}, made["added_tokens"]
        if (made["normalizer"] or made["model"]["type"] != "BPE" or split.get("type") != "ByteLevel"
                or split["add_prefix_space"] or not split["use_regex"]
                or made["model"].get("dropout")
                or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added)):
            raise ValueError(f"{path} is no plain byte-level tokenizer")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        alphabet = _byte_alphabet()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        table = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            known = all(c in alphabet for c in token)
            table[i] = bytes(alphabet[c] for c in token) if known else token.encode()
        self.length = np.array([len(b) for b in table], np.int64)
        self.table_bytes = np.frombuffer(b"".join(table), np.uint8)
        self.table_at = np.cumsum(self.length) - self.length
        names = sorted((t["content"].encode() for t in added), key=len, reverse=True)
        self.added = re.compile(b"|".join(map(re.escape, names))) if names else None
        self.chunks, self.words = _Kept(), _Kept()

    def _gather(self, raw: bytes, start: np.ndarray, end: np.ndarray
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What encoding each byte range by itself gives; a range seen before is only looked up."""
        places, new = self.chunks.places(raw, start, end)
        if new:
            self._encode(len(self.chunks.place) - len(new), new)
        return self.chunks.gather(places)

    def _encode(self, first: int, chunks: list[bytes]) -> None:
        """New chunks, put together from words that the tokenizer sees once."""
        raw = b"".join(chunks)
        offsets = np.append(0, np.cumsum([len(c) for c in chunks]))
        start, first_word = cut_pieces(np.frombuffer(raw, np.uint8), offsets)
        places, new = self.words.places(raw, start, np.append(start[1:], len(raw)))
        at = len(self.words.place) - len(new)
        for a in range(0, len(new), TOGETHER):
            self._tokenize(at + a, new[a:a + TOGETHER])
        ids, owner, opens = self.words.gather(places)
        chunk = np.searchsorted(first_word, np.arange(len(places)), side="right") - 1
        self.chunks.add(ids, opens, np.bincount(chunk[owner], minlength=len(chunks)), first)

    def _tokenize(self, first: int, words: list[bytes], together: int = 64) -> None:
        """New words by the tokenizer; neighbours that a space parts for certain go together."""
        texts: list[bytes] = []
        room = 0
        for w in words:
            apart = _APART.fullmatch(w) is not None
            if apart and room:
                texts[-1] += w
            else:
                texts.append(w)
                room = together
            room = room - 1 if apart else 0
        parts, pieces = [], []
        for e in self.tokenizer.encode_batch([t.decode() for t in texts],
                                             add_special_tokens=False):
            parts += e.ids
            split = e.word_ids
            pieces += split if split and split[0] is not None else [-1] * len(split)
        ids = np.array(parts, np.uint32)
        word_end = np.cumsum([len(w) for w in words])
        token_end = np.append(0, np.cumsum(self.length[ids]))
        at = np.searchsorted(token_end, word_end)
        if together > 1 and not (token_end[at] == word_end).all():
            return self._tokenize(first, words, 1)
        piece = np.array(pieces, np.int64)
        opens = np.ones(len(ids), bool)
        opens[1:] = (piece[1:] != piece[:-1]) | (piece[1:] < 0)
        size = np.diff(at, prepend=0)
        opens[(at - size)[size > 0]] = True
        self.words.add(ids, opens, size, first)
        return None

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts at ``offsets`` of ``data`` and each text's first id."""
        if self.chunks.kept > KEPT_CHUNKS:
            self.chunks = _Kept()
        if self.words.kept > KEPT_WORDS:
            self.words = _Kept()
        n, raw = len(data), data.tobytes()
        edges = np.unique(np.append(offsets, self._added_places(raw, offsets)))
        if not n:
            return np.empty(0, np.uint32), np.zeros(len(offsets), np.int64)
        edge = np.zeros(n + 1, bool)
        edge[edges] = True
        start = np.union1d(edges[edges < n], cut_places(data, edges))
        while True:
            end = np.append(start[1:], n)
            ids, owner, opens = self._gather(raw, start, end)
            length = self.length[ids]
            at = np.cumsum(length) - length
            begins = at[opens]
            join = np.flatnonzero(~edge[end])  # of the chunks join and join + 1
            if not len(join):
                break
            cut, stop = end[join], end[join + 1]
            # What a chunk has settled ends here; the last chunk of a text is settled to its end.
            settled = end.copy()
            settled[join] = begins[np.searchsorted(begins, cut - SETTLED, side="right") - 1]
            low = settled[join]
            high = np.minimum(np.append(begins, n)[np.searchsorted(begins, cut + AHEAD)], stop)
            w_ids, w_owner, w_opens = self._gather(raw, low, high)
            w_length = self.length[w_ids]
            w_at = np.cumsum(w_length) - w_length
            w_at += low[w_owner] - w_at[np.searchsorted(w_owner, np.arange(len(low)))][w_owner]
            begun = np.zeros(n + 1, bool)
            begun[begins] = True
            agrees = (w_opens & begun[w_at] & (w_at >= cut[w_owner])
                      & ((w_at + SETTLED <= high[w_owner]) | edge[high[w_owner]]))
            meet = np.where(edge[high], high, n + 1)
            which, first = np.unique(w_owner[agrees], return_index=True)
            meet[which] = w_at[agrees][first]
            apart = meet > settled[join + 1]
            if not apart.any():
                since = np.zeros(len(start), np.int64)
                since[join + 1] = meet
                own = (at >= since[owner]) & (at < settled[owner])
                window = w_at < meet[w_owner]
                ids = np.concatenate([ids[own], w_ids[window]])
                at = np.concatenate([at[own], w_at[window]])
                order = np.argsort(at, kind="stable")
                ids, at = ids[order], at[order]
                break
            start = np.delete(start, join[apart] + 1)
        return ids, np.searchsorted(at, offsets)

    def _added_places(self, raw: bytes, offsets: np.ndarray) -> np.ndarray:
        """Begins and ends of added tokens; a text is split there before anything else."""
        out: list[int] = []
        for found in self.added.finditer(raw) if self.added else ():
            a, b = found.span()
            k = int(np.searchsorted(offsets, a, side="right"))
            if b <= offsets[k]:
                out += [a, b]
        return np.array(out, np.int64)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The texts of ids that lie at ``offsets``; broken UTF-8 is replaced, unknown ids left out."""
        known = (ids >= 0) & (ids < len(self.length))
        ids = np.where(known, ids, 0).astype(np.int64)
        length = np.where(known, self.length[ids], 0)
        total = np.append(0, np.cumsum(length))
        source = np.arange(total[-1]) + np.repeat(self.table_at[ids] - total[:-1], length)
        data, at = self.table_bytes[source].tobytes(), total[offsets].tolist()
        return [data[a:b].decode(errors="replace") for a, b in zip(at[:-1], at[1:], strict=True)]


_coders: dict[str | None, ChunkCoder] = {}


def coder(path: str | None = None) -> ChunkCoder:
    """This worker's coder of a tokenizer file."""
    if path not in _coders:
        _coders[path] = ChunkCoder(path)
    return _coders[path]


def encode_texts(docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id",
                 text_col: str = "text", decoded: bool = False) -> DataFrame:
    """``(doc_id, ids array<int>)`` of each row, with ``decoded`` also the text of those ids.

    Whole texts, as the tokenizer gives them without special tokens added; those written in a
    text are found. A null or empty text has no ids; a row without id keeps its null. Repeated
    rows come out as often. Bytes that are no UTF-8 count as U+FFFD. Other columns are left out.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(tokenizer)
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for i, j in slices(offsets):
                ids, first = code.encode(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                columns = [batch.column(0).slice(i, j - i),
                           pa.ListArray.from_arrays(first.astype(np.int32), ids.astype(np.int32))]
                if decoded:
                    columns.append(pa.array(code.decode(ids, first), pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "ids", "decoded"][:3 if decoded else 2]
    rows = id_text(docs, id_col, text_col).withColumn("text", F.make_valid_utf8("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>" + ", decoded string" * decoded)


def decode_texts(rows: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id",
                 ids_col: str = "ids") -> DataFrame:
    """``(doc_id, text)`` of rows with ids; null ids are an empty text, null entries left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(tokenizer)
        for batch in batches:
            lists = batch.column(1)
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            ids = np.nan_to_num(ids, nan=-1).astype(np.int64)
            size = np.nan_to_num(pa.compute.list_value_length(lists).to_numpy(
                zero_copy_only=False)).astype(np.int64)
            texts = code.decode(ids, np.append(0, np.cumsum(size)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(ids_col).cast("array<int>").alias("ids")).mapInArrow(
        run, "doc_id long, text string")
