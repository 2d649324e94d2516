"""Words that a polynomial hash modulo 2^64 takes for one, and crowds of one query id."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from parvis.llm import lm, minhash, onebit, packing, subwords, tokenfile
from parvis.llm.words import range_hashes
from parvis.staging import new_scratch_path


def pair(size):
    word = "a"
    while len(word) < size:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("size", [1024, 2048, 8192])
def test_hashes_of_thue_morse_words_differ(size):
    data = np.frombuffer("".join(pair(size)).encode(), np.uint8)
    at = np.array([0, size, 2 * size])
    one, two = range_hashes(data, at[:-1], at[1:]).tolist()
    assert one != two
    again = np.concatenate([data[:5], data])
    assert range_hashes(again, at[:1] + 5, at[1:2] + 5).tolist() == [one]


def test_unlike_texts_are_not_linked_and_get_their_own_ids(spark):
    rows = [(2 * k + j, word) for k, size in enumerate((1024, 2048, 4096, 8192))
            for j, word in enumerate(pair(size))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert all(r["component_id"] == r["doc_id"] for r in minhash.near_duplicates(
        docs, 3, 85).collect())
    plain = subwords.Encoder().tokenizer
    want = {i: plain.encode(t, add_special_tokens=False).ids + [0] for i, t in rows}
    got: dict[int, list] = {i: [] for i in want}
    for r in packing.pack_documents(docs).orderBy("doc_id", "start").collect():
        got[r["doc_id"]] += np.frombuffer(r["ids"], "<u4").tolist()
    assert got == want
    path = new_scratch_path(spark, "collisions")
    tokenfile.write_token_file(docs, path)
    assert {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist()
            for r in tokenfile.read_token_file(spark, path).collect()} == want
    texts = [t for _, t in rows]
    ids = [w.hash.tolist() for _, _, w in lm.word_slices(pa.array(texts))]
    assert len({h for part in ids for h in part}) == len(texts)


def test_more_rows_of_one_query_id_than_a_wave_holds(spark, monkeypatch):
    monkeypatch.setattr(onebit, "WAVE", 7)
    rows = [(0, [float(k), 1.0]) for k in range(30)] + [(0, [1.0, 1.0])] * 20
    rows += [(k, [k + .25, 1.0]) for k in range(1, 40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = onebit.nearest(df, lambda i: i == 0, k=12).orderBy("rank").collect()
    near = sorted((min(abs(k + .25 - x) for x in range(30)), k) for k in range(1, 40))[:12]
    assert [(r["score"], r["vec_id"]) for r in got] == near
