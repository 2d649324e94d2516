"""New words go to the tokenizer in a row where that is safe; their ids are those of each alone."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from parvis.llm import subwords
from parvis.llm.subwords import Encoder
from parvis.llm.words import word_slices

WORDS = ["plain", "\u00e9t\u00e9", "'s", "x's", "...", "a\u00a0b", "\u00a0", "\u0085", "x\u2003", "\u3000y",
         "\u65e5\u672c", "\x00", "\x1c", "a\x1fb", "\x7f", "<|endoftext|>", "<|endoftext|>x", "12",
         "3rd", "\u017f", "\u200b", "\u180e", "\u00e9" * 50, "a" * 400, "\u0120", "\u0120\u0120a",
         "\ufffd", "\U0001f642"]


class Counting:
    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, 0

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **options)

    def __getattr__(self, name):
        return getattr(self.tokenizer, name)


def ids_of(encoder: Encoder, texts: list[str]) -> list[list[int]]:
    out = []
    for _, _, words in word_slices(pa.array(texts)):
        ids, first = encoder.word_ids(words, 50_256)
        out += [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)]
    return out


def test_ids_are_those_of_each_word_alone():
    texts = [" ".join(WORDS), " ".join(reversed(WORDS)), "", *WORDS,
             " ".join(f"{a}{b}" for a in WORDS for b in WORDS)]
    encoder = Encoder()
    got = ids_of(encoder, texts)
    for text, ids in zip(texts, got, strict=True):
        words = [ws.word(i) for _, _, ws in word_slices(pa.array([text]))
                 for i in range(len(ws.start))]
        alone = encoder.tokenizer.encode_batch([" " + w.decode() for w in words],
                                               add_special_tokens=False)
        assert ids == [i for e in alone for i in e.ids] + [50_256]


def test_new_words_go_together():
    encoder = Encoder()
    encoder.__dict__["tokenizer"] = counting = Counting(encoder.tokenizer)
    text = " ".join(f"w{np.base_repr(k, 36)}é" for k in range(5000))
    ids_of(encoder, [text])
    assert counting.texts <= 10  # 5000 before


def test_pieces_known_are_not_copied_for_a_few_new_ones(monkeypatch):
    monkeypatch.setattr(subwords, "RECENT", 100)
    copied, more = [], subwords.Pieces.with_more
    monkeypatch.setattr(subwords.Pieces, "with_more", lambda self, other: copied.append(
        len(self.keys) + len(other.keys)) or more(self, other))
    encoder, fresh = Encoder(), Encoder()
    texts = [" ".join(f"w{k + n}" for k in range(0, 2000, 7)) for n in range(40)]
    got = [ids_of(encoder, [t])[0] for t in texts]
    assert got == ids_of(fresh, texts)
    many = len(encoder.old.keys) + len(encoder.recent.keys)
    assert many == len({w for t in texts for w in t.split()})
    assert sum(copied) < 15 * many  # 20 times if all are put anew for each text


def test_an_encoder_that_forgets_gives_the_same_ids():
    texts = [" ".join(f"w{k * n}" for k in range(200)) for n in range(1, 30)]
    small = Encoder(known=500)
    assert [ids_of(small, [t])[0] for t in texts] == ids_of(Encoder(), texts)
    assert len(small.old.keys) + len(small.recent.keys) <= 500
