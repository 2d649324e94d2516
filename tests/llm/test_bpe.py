"""Chunked encoding against the tokenizers library on whole texts."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from odd_rows import SF, documents, none, odd  # noqa: F401
from parvis.llm import bpe, queries
from parvis.llm.words import text_bytes

PARTS = ["a", "b", "'", "'s", "'ll", " ", "  ", "\n", "\t", "é", "中", "文", "1", "23", ".", "!?",
         "<|endoftext|>", "<|endof", "text|>", " the", " ", "　", " ", "😀", "ing", "'v", "e"]


@pytest.fixture(scope="module")
def code():
    return bpe.ChunkCoder()


def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def same(code, texts):
    ids, first = code.encode(*text_bytes(pa.array(texts, pa.string())))
    plain, decoded = library(), code.decode(ids, first)
    for k, text in enumerate(texts):
        want = plain.encode(text or "", add_special_tokens=False).ids
        assert ids[first[k]:first[k + 1]].tolist() == want
        assert decoded[k] == plain.decode(want, skip_special_tokens=False)


def test_random_texts_of_awkward_parts(code):
    rng = random.Random(7)
    for _ in range(60):
        parts = rng.sample(PARTS, rng.choice([2, 4, 8, len(PARTS)]))
        same(code, ["".join(rng.choice(parts) for _ in range(rng.choice([0, 1, 50, 3000])))
                    for _ in range(5)])


def test_long_runs_without_a_place_to_cut_or_to_agree(code):
    rng = random.Random(8)
    letters = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(100_000))
    same(code, ["a" * 20_000, " " * 20_000, "中" * 9000, "'" * 5000, "\n" * 3000 + "x", letters,
                "hello " * 3000, None, ""])


def test_cuts_depend_on_what_is_near_and_chunks_are_encoded_once(code):
    rng = random.Random(9)
    shared = " ".join(str(rng.randint(0, 10 ** 9)) for _ in range(800))
    cuts = []
    for head in ("x" * 300, "other words " * 40):
        data = np.frombuffer((head + shared).encode(), np.uint8)
        found = bpe.cut_places(data, np.array([0, len(data)]))
        cuts.append({int(c) - len(head) for c in found if c > len(head) + 300})
    assert cuts[0] == cuts[1] and len(cuts[0]) > 10
    fresh, seen = bpe.ChunkCoder(), []
    fresh._tokenize, plain = (lambda first, words: (seen.extend(words), plain(first, words))
                              ), fresh._tokenize
    fresh.encode(*text_bytes(pa.array([shared])))
    before = len(fresh.chunks.place)
    fresh.encode(*text_bytes(pa.array([shared, shared])))
    assert len(fresh.chunks.place) == before and len(set(seen)) == len(seen)


def test_words_that_a_polynomial_hash_mixes_up(code):
    word = "a"
    for _ in range(11):
        word += word.translate(str.maketrans("ab", "ba"))
    same(code, [word, word.translate(str.maketrans("ab", "ba"))])


def test_query(spark, documents):  # noqa: F811
    plain = library()
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.QUERIES["op12_bpe_round_trip"](
        spark, SF).collect()}
    assert set(got) == set(documents)
    for doc_id, text in documents.items():
        ids = plain.encode(text or "", add_special_tokens=False).ids
        assert got[doc_id] == (
            len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(plain.decode(ids, skip_special_tokens=False).encode()).hexdigest())


def test_odd_rows_and_decoding(spark, odd, none):  # noqa: F811
    coded = bpe.encode_texts(odd)
    back = bpe.decode_texts(coded)
    want = sorted((str(r["doc_id"]), r["text"] or "") for r in odd.collect())
    assert sorted((str(r["doc_id"]), r["text"]) for r in back.collect()) == want
    assert bpe.encode_texts(none, decoded=True).count() == 0
    broken = spark.sql("select 1L as doc_id, cast(unhex('61FF62') as string) as text")
    assert bpe.encode_texts(broken, decoded=True).first()["decoded"] == "a�b"
    some = spark.createDataFrame([(1, [64, None, 10 ** 8, 65]), (2, None), (3, [])],
                                 "doc_id long, ids array<int>")
    assert sorted(tuple(r) for r in bpe.decode_texts(some).collect()) == [
        (1, "ab"), (2, ""), (3, "")]
