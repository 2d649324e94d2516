"""The training-data operators against plain Python, and on odd and empty tables."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import plain
from parvis.llm import (
    automaton, chat, components, decontaminate, licenses, lm, minhash, onebit, packing, queries,
    secrets, subwords, tokenfile, toxicity,
)
from odd_rows import SF, documents, none, odd  # noqa: F401
from parvis.llm.words import LETTERS, SPACED, cut_words, text_bytes
from parvis.staging import new_scratch_path


def tokenizer():
    return subwords.Encoder().tokenizer


# Words and pieces ----------------------------------------------------------------------


@pytest.mark.parametrize(("kind", "split"), [(SPACED, plain.words), (LETTERS, plain.letters)])
def test_words_are_cut_within_texts(kind, split):
    texts = ["Ab cd", None, "", "é\tÜ,x", " a", "b ", "c"]
    found = cut_words(*text_bytes(pa.array(texts)), kind)
    for k, text in enumerate(texts):
        own = range(found.first[k], found.first[k + 1])
        assert [found.word(i).decode() for i in own] == split(text)
    assert len(set(found.hash.tolist())) == len({w for t in texts for w in split(t)})


def test_pieces_give_the_ids_of_whole_texts():
    rng = random.Random(4)
    parts = [" ", "  ", "\n", "\n\n", "\t", " ", " ", "　", "\u0085", "\x1c", "é", "à",
             "the", "'s", "12", ".", "¿", "😀", "中", " ", "Â"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(5000)]
    out = []
    for _, _, ids, at in subwords.Encoder().column_ids(pa.array(texts)):
        out += [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)]
    assert out == [e.ids for e in tokenizer().encode_batch(texts, add_special_tokens=False)]


# 1 Near-duplicates ---------------------------------------------------------------------


@pytest.mark.parametrize(("size", "threshold"), [(3, 85), (5, 80)])
def test_near_duplicates(spark, documents, size, threshold):
    rng = random.Random(1)
    texts = dict(documents)
    long = " ".join(f"w{i}" for i in range(150))
    for i in range(40):  # a crowd of near copies of one text, more and more changed
        w = long.split()
        for _ in range(i // 3):
            w[rng.randrange(len(w))] = "zz"
        texts[1000 + i] = " ".join(w)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r for r in minhash.near_duplicates(df, size, threshold).collect()}
    sets = {i: plain.shingles(t, size) for i, t in texts.items()}
    want = plain.components(sets, threshold)
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert {i: r["n_shingles"] for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    assert all(r["kept"] == (i == want[i]) for i, r in got.items())


def test_split_buckets_give_the_same_components(spark, monkeypatch):
    monkeypatch.setattr(minhash, "CHUNK", 4)
    rng = np.random.default_rng(2)
    base = np.sort(rng.integers(0, 1 << 63, 100, dtype=np.uint64))
    sets = [np.unique(np.where(rng.random(100) < i / 300, base + 1, base)) for i in range(20)]
    ids, whole = np.arange(20), np.zeros(20, int)
    one = minhash.star_edges(ids, whole, sets, 85)
    sides = ids % 5
    parts = []
    for low in range(5):
        for high in range(low, 5):
            at = np.flatnonzero((sides == low) | (sides == high))
            parts += minhash.star_edges(ids[at], sides[at], [sets[i] for i in at], 85)

    def joined(edges):
        label = list(range(20))
        for a, b in edges:
            label = [label[a] if x == label[b] else x for x in label]
        return [label.index(x) for x in label]

    assert joined(one) == joined(parts)
    assert len(one) <= 19


def test_components_of_a_long_path(spark):
    edges = spark.range(60).selectExpr("id AS a", "id + 1 AS b").union(
        spark.createDataFrame([(100, 100), (None, 5), (71, 70)], "a long, b long"))
    got = {r["node"]: r["component"] for r in components.connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 70: 70, 71: 70}
    assert components.connected_components(edges.where("false")).count() == 0


def test_near_duplicates_of_odd_rows(odd, none):
    got = minhash.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    by_id = {}
    for r in got:
        by_id.setdefault(r["doc_id"], []).append(r)
    assert by_id[None][0]["component_id"] is None and by_id[None][0]["kept"]
    assert {r["component_id"] for r in by_id[7]} == {7} and len(by_id[7]) == 3
    assert by_id[99][0]["component_id"] == 7 and not by_id[99][0]["kept"]
    assert by_id[0][0]["n_shingles"] == 0 and by_id[1][0]["component_id"] == 1
    assert minhash.near_duplicates(none).count() == 0


# 2 Secrets -----------------------------------------------------------------------------


def test_base_secrets_in_any_mixture():
    rng, scanner = random.Random(2), secrets.Scanner()
    parts = ["password", "PASSWD", "token", "secret", "apikey", "api_key", "=", ":", " ", "\"", "'",
             "AKIA", "ABCDEF0123456789", "AKIAAKIA", "0123456789abcdef", "abc", "é", "\n", "Z9",
             "deadbeefdeadbeefdeadbeef", "-", "ſ", "."]
    for _ in range(8000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert [s for s in scanner.spans(text) if s[1] < 3] == plain.base_secrets(text)


def test_other_secrets_and_masking(spark):
    key = "ghp_" + "Zk" * 18
    text = f"é {key} and -----BEGIN RSA PRIVATE KEY----- token: abcdefgh"
    df = spark.createDataFrame([(1, text, len(text), "x"), (2, None, None, "y")],
                               "doc_id long, text string, n_chars long, spans string")
    found = {r["doc_id"]: r["spans"] for r in secrets.find_secrets(df).collect()}
    assert [(s["kind"], text[s["start"]:s["end"]]) for s in found[1]] == [
        ("github", key), ("pem", "-----BEGIN RSA PRIVATE KEY-----"), ("assign", "token: abcdefgh")]
    assert found[2] == []
    clean = {r["doc_id"]: r for r in secrets.without_secrets(df).collect()}
    assert clean[1]["text"] == "é <secret> and <secret> <secret>"
    assert clean[1]["n_chars"] == len(clean[1]["text"]) and clean[2]["text"] is None
    assert clean[1]["spans"] == "x"


def test_secret_report(spark, documents):
    got = {r["doc_id"]: r for r in queries.op2_secret_scan(spark, SF).collect()}
    assert set(got) == set(documents)
    for i, text in documents.items():
        spans = plain.base_secrets(text)
        said = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in spans)
        assert got[i]["base_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert (got[i]["n_assign"], got[i]["n_access"], got[i]["n_hex"]) == tuple(
            sum(k == kind for _, k, _ in spans) for kind in range(3))


def test_secrets_of_odd_rows(odd, none):
    assert secrets.secret_report(secrets.find_secrets(odd)).count() == odd.count()
    assert secrets.without_secrets(odd).select(odd.columns).collect() == odd.collect()
    assert secrets.find_secrets(none).count() == 0


def test_the_automaton_is_minimal():
    one = automaton.Automaton([rb"ab+c", rb"[a]bb*c"])
    width = max(one.classes) + 1
    assert len(one.next) // width == 4
    assert list(one.scan(b"xabbc")) == [(5, [0, 1])]


# 3 Language model ----------------------------------------------------------------------


def test_base_scores(spark, documents, monkeypatch):
    monkeypatch.setattr(lm, "COMMON", 50)  # most words take the way of the rare ones
    monkeypatch.setattr(lm, "SAMPLE_STEPS", 5)
    rows = queries.op3_lm_score(spark, SF).collect()
    want = plain.base_scores(documents, 7, 2)
    assert len(rows) == len(want)
    for r in rows:
        held, n, known, score = want[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"]) == (held, n, known)
        assert r["base_score"] == pytest.approx(score)


def test_the_model_is_a_distribution_and_learns(spark, documents):
    from parvis.llm.attention import CLASSES, WINDOW, Attention

    counts = np.bincount(np.arange(lm.IDS) % 977, minlength=lm.IDS)
    classes = lm.Classes(counts)
    net = Attention(classes.unigram)
    ids = np.random.default_rng(0).integers(0, CLASSES, (3, WINDOW))
    every = np.ones_like(ids, bool)
    total = sum(np.exp(net.score(ids, np.full_like(ids, c), every)) for c in range(CLASSES))
    assert np.allclose(total, 1, atol=1e-4)
    inner = np.exp(classes.inner[classes.of == 0]).sum()
    assert inner == pytest.approx(1)
    later = ids.copy()
    later[:, -1] = 0
    shape = lambda x: net.score(x, ids, every).reshape(3, WINDOW)[:, :-1]
    assert np.allclose(shape(ids), shape(later), atol=1e-5)
    chance = np.log(np.take_along_axis(net.forward(ids)[0], ids[:, :, None], 2)[:, :-1, 0])
    assert np.allclose(shape(ids), chance, atol=1e-4)

    train = spark.createDataFrame(list(documents.items()), "doc_id long, text string")
    seen = np.zeros(lm.IDS)
    for _, _, words in lm.word_slices(pa.array(list(documents.values()))):
        seen += np.bincount(lm.subword_ids(words, None)[0], minlength=lm.IDS)
    classes = lm.Classes(seen)

    def loss(model):
        got = n = 0
        for _, _, words in lm.word_slices(pa.array(list(documents.values())[:40])):
            for _, inputs, wanted, mask, _ in lm.batches_of(
                    *lm.subword_ids(words, None), classes):
                got, n = got - model.score(inputs, wanted, mask).sum(), n + mask.sum()
        return got / n

    assert loss(lm.fit(train, None, classes)) < 0.9 * loss(Attention(classes.unigram))


def test_every_id_is_scored_once():
    classes = lm.Classes(np.ones(lm.IDS))
    ids, first = np.arange(1000) % 300, np.array([0, 0, 1, 40, 1000])
    places = np.concatenate([p[m] for _, _, _, m, p in lm.batches_of(ids, first, classes)])
    assert sorted(places.tolist()) == list(range(1000))


def test_every_window_is_learned_from(spark, documents, monkeypatch):
    texts = [" ".join(f"w{k % 90}" for k in range(n)) for n in (0, 5, 40, 300, 2000)]
    classes = lm.Classes(np.ones(lm.IDS))
    learned = []

    class Recorder:
        def __init__(self, net, rate):
            self.rate = rate

        def learn(self, inputs, wanted, mask):
            learned.append(wanted[mask])

    monkeypatch.setattr(lm, "Adam", Recorder)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    weights = lm.Attention(classes.unigram).flat()
    out, = lm._refine(None, classes, weights)(iter([batch]))
    ids = []
    for _, _, words in lm.word_slices(batch.column(1)):
        ids.append(lm.subword_ids(words, None))
    wanted = np.concatenate([classes.of[i] for i, _ in ids])
    windows = sum(len(lm.windows_of(np.diff(first))[0]) for _, first in ids)
    assert out.column(1)[-1].as_py() == windows
    np.testing.assert_array_equal(np.concatenate(learned), wanted)
    learned.clear()
    train = spark.createDataFrame(list(documents.items())[:30], "doc_id long, text string")
    lm.fit(train, None, classes)  # the workers have the true Adam: these are the first fit's
    first = sum(len(lm.subword_ids(w, None)[0]) for _, _, w in lm.word_slices(
        pa.array([t for _, t in list(documents.items())[:30]])))
    assert sum(map(len, learned)) >= first


def test_scores_of_odd_rows(odd, none):
    held = lambda c: toxicity.held_out(c, 7, 2)
    got = lm.score_texts(odd, held).collect()
    assert len(got) == odd.count()
    assert len({(r["base_score"], round(r["score"], 4)) for r in got if r["doc_id"] == 7}) == 1
    assert all(np.isfinite(r["score"]) for r in got)
    assert lm.score_texts(none, held).count() == 0


# 4 Chat --------------------------------------------------------------------------------


def said(turns):
    return hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()


def test_chat_round_trip(spark):
    got = {r["conv_id"]: r for r in queries.op4_chat_format(spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/conversations.parquet").orderBy("conv_id", "turn").collect()
    turns = {-1: [(r, "</s>[INST] ok [/INST]") for r in ("user", "assistant")]}
    for r in rows:
        turns.setdefault(r["conv_id"], []).append((r["role"], r["text"] or ""))
    assert set(got) == set(turns)
    for i, own in turns.items():
        loss = "".join(t for r, t in own if r == "assistant")
        assert (got[i]["n_turns"], got[i]["turns_sha256"]) == (len(own), said(own))
        assert (got[i]["loss_chars"], got[i]["loss_sha256"]) == (
            len(loss), hashlib.sha256(loss.encode()).hexdigest())


@pytest.mark.parametrize("n", [0, 1, 9, 300, 700])
def test_spans_are_found_for_any_template(n):
    turns = [(("user", "assistant")[k % 2], f"text {k} é") for k in range(n)]
    for template in (chat.marked_turns, lambda t: "<bos>" + "".join(
            f"{r}: {x.upper()}!\n" for r, x in t)):
        text, spans = chat.render(template, turns)
        assert text == template(turns) and len(spans) == n
        for (role, said_), (_, a, b) in zip(turns, spans, strict=True):
            assert text[a:b] in (said_, said_.upper())
    numbered = lambda t: "".join(f"{k}:{x};" for k, (_, x) in enumerate(t))
    assert chat.render(numbered, turns)[0] == numbered(turns)


def test_rewriting_templates_are_detected():
    last_first = lambda t: "".join(x for _, x in reversed(t))
    text, spans = chat.render(last_first, [("user", "a"), ("assistant", "b")])
    assert (text, spans) == ("ba", None)


@pytest.mark.parametrize("n", [150, 250, 500])
def test_late_rewriting_is_detected(n):
    turns = [("user" if k % 2 == 0 else "assistant", f"t{k}") for k in range(n)]

    def last_200(turns):
        return chat.marked_turns(turns[-200:])

    text, spans = chat.render(last_200, turns)
    assert text == last_200(turns)
    assert (spans is None) == (n > 200)


def test_odd_conversations(spark):
    df = spark.createDataFrame(
        [(1, 0, None, None), (1, 0, "tool", "\\[<s>"), (None, 1, "user", "x"), (2, None, "user", "")],
        "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(df)).collect()}
    assert got[1]["turns_sha256"] == said([("", ""), ("tool", "\\[<s>")])
    assert got[None]["n_turns"] == got[2]["n_turns"] == 1
    assert chat.format_conversations(df.where("false")).count() == 0


# 5 Packing -----------------------------------------------------------------------------


def check_packing(rows, texts):
    ids = {i: np.array([*e.ids, 0], "<u4") for i, e in zip(texts, tokenizer().encode_batch(
        [t or "" for t in texts.values()], add_special_tokens=False), strict=True)}
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
        part = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert zlib.crc32(part.tobytes()) == r["ids_crc32"]
        assert r["doc_tokens"] == len(ids[r["doc_id"]])
    for key, where in ((by_doc, "start"), (by_sequence, "offset")):
        for part in key.values():
            end = 0
            for r in sorted(part, key=lambda r: r[where]):
                assert r[where] == end
                end += r["length"]
    assert {i: sum(r["length"] for r in p) for i, p in by_doc.items()} == {
        i: len(x) for i, x in ids.items()}
    sizes = [sum(r["length"] for r in p) for p in by_sequence.values()]
    assert max(sizes) <= 1024
    return sum(1024 - s for s in sizes if s & (s - 1)) / sum(sizes)


def test_packed_documents(spark, documents):
    rows = queries.op5_packing(spark, SF).collect()
    assert check_packing(rows, documents) < 0.02


def test_packing_of_odd_rows(spark, odd, none):
    once = odd.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    rows = packing.pack_documents(once).withColumn("ids_crc32", F.crc32("ids")).collect()
    check_packing(rows, {r["doc_id"]: r["text"] for r in once.collect()})
    assert packing.pack_documents(odd).agg(F.sum("length")).first()[0] > 0
    assert packing.pack_documents(none).count() == 0


def test_vectors_keep_all_limits():
    rng = np.random.default_rng(3)
    tokens = rng.integers(1, 1025, 600)
    loss = np.minimum(rng.integers(0, 600, 600), tokens)
    limits = packing.Limits(1024, 5, 600)
    for cut in (False, True):
        bins = packing.pack_vectors(tokens, loss, limits, cut)
        seen = {}
        for b in bins:
            assert sum(p[2] for p in b) <= 1024 and len(b) <= 5 and sum(p[3] for p in b) <= 600
            for item, start, length, own in b:
                seen.setdefault(item, []).append((start, length, own))
        for item in range(600):
            parts = sorted(seen[item])
            assert [p[0] for p in parts] == [0, *np.cumsum([p[1] for p in parts])[:-1]]
            assert sum(p[1] for p in parts) == tokens[item] and sum(p[2] for p in parts) == loss[item]
            assert cut or len(parts) == 1
        least = max(tokens.sum() / 1024, loss.sum() / 600, 600 / 5)
        assert len(bins) < 1.25 * least
    with pytest.raises(ValueError):
        packing.pack_vectors(np.array([2000]), np.array([0]), limits, False)


def test_examples_are_packed_whole(spark):
    df = spark.createDataFrame([(1, 600, 10), (2, 500, 10), (3, 400, 10), (4, None, None),
                                (None, 24, 0)], "example_id long, tokens long, loss_tokens long")
    rows = {r["example_id"]: r for r in packing.pack_examples(df.coalesce(1)).collect()}
    assert rows[4]["sequence_id"] is None
    assert rows[1]["sequence_id"] == rows[3]["sequence_id"] != rows[2]["sequence_id"]
    assert packing.pack_examples(df.where("false")).count() == 0


# 6 Nearest neighbours ------------------------------------------------------------------


def brute_nearest(rows, k=10):
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], float)
    out = {}
    for q in np.flatnonzero(ids % 100 == 0):
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((ids, d)) if i != q][:k]
        out[int(ids[q])] = [(int(ids[i]), float(d[i])) for i in order]
    return out


def test_nearest_recall(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    want, got = brute_nearest(rows), {}
    for r in sorted(queries.op6_nearest(spark, SF).collect(), key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert set(got) == set(want)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_rows_of_one_id_are_one_candidate(spark):
    rng = np.random.default_rng(8)
    near = rng.normal(0, 1, 32)
    rows = [(0, near.tolist())] + [(1, (near + 0.001).tolist())] * 20
    rows += [(i, (near + rng.normal(0, 2, 32)).tolist()) for i in range(2, 400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)
    got = onebit.nearest(df, lambda i: i == 0).orderBy("rank").collect()
    far = {}
    for i, v in rows[1:]:
        far[i] = min(far.get(i, np.inf), float(np.linalg.norm(np.array(v) - near)))
    assert [r["vec_id"] for r in got] == sorted(far, key=far.get)[:10]


def test_nearest_with_ties_waves_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(onebit, "WAVE", 2)
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[5][1]) for i in range(30)]  # one very common vector
    odd = [(2000, None), (2001, [0.0] * 6), (2002, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (None, [1.0] * 6),
           (2003, [float("nan")] * 6), (2004, [float("inf")] * 6), (2005, [1.0, 2.0])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumn(
        "score", F.lit(1)).repartition(3)
    pick = lambda c: c % 100 == 0
    got = {}
    for r in sorted(onebit.nearest(df, pick).collect(), key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    want = brute_nearest(rows)
    assert set(got) == set(want) == {0, 100, 200, 1000}
    assert got[1000] == want[1000]
    hits = sum(len(set(got[q]) & set(want[q])) for q in want)
    assert hits >= 0.9 * 40
    assert onebit.nearest(df.where("false"), pick).count() == 0
    few = onebit.nearest(df.where("vec_id IN (0, 1, 2)"), pick).collect()
    assert [r["rank"] for r in sorted(few, key=lambda r: r["rank"])] == [1, 2]


# 7 Toxicity ----------------------------------------------------------------------------


def test_the_network_learns_a_bad_word(spark):
    rng = random.Random(5)
    plain_words = [f"{a}{b}" for a in ("lo", "mi", "ta", "ner") for b in ("ra", "sel", "ko", "du")]
    texts = []
    for i in range(240):
        w = [rng.choice(plain_words) for _ in range(rng.randint(5, 90))]
        if i % 4 == 0:
            for _ in range(3):
                w[rng.randrange(len(w))] = "vex" + rng.choice(("o", "ing", "ed"))
        texts.append((i, " ".join(w), int(i % 4 == 0)))
    df = spark.createDataFrame(texts, "doc_id long, text string, toxic int")
    net = toxicity.train_network(df.drop("toxic"), df.select("doc_id", "toxic"))
    got = {r["doc_id"]: r["score"] for r in toxicity.score_texts(df, net).collect()}
    held = {r["doc_id"] for r in df.where(toxicity.held_out(F.col("doc_id"))).collect()}
    right = sum((got[i] >= 0.5) == bool(t) for i, _, t in texts if i in held)
    assert len(held) > 30 and right >= 0.9 * len(held)
    stay = {r["doc_id"] for r in toxicity.without_toxic(df, net).collect()}
    assert stay == {i for i, s in got.items() if s < 0.5}


def test_gradient_of_the_network():
    from parvis.llm import gru

    net = gru.Network(np.empty(0, np.uint64))
    net.p = {k: v.astype(float) for k, v in net.p.items()}
    x = gru.inputs_of(gru.words_of(["one two three " * 20, "", "four"]))
    d = np.random.default_rng(0).normal(size=len(x.windows))
    g = net.gradient(x, net.forward(x, keep=True)[1], d)
    for k in ("gram", "in", "back0", "back1", "att", "look", "out", "last"):
        at = np.unravel_index(np.abs(g[k]).argmax(), g[k].shape)
        old, ends = net.p[k][at], []
        for step in (1e-2, -1e-2):
            net.p[k][at] = old + step
            ends.append(net.forward(x) @ d)
        net.p[k][at] = old
        assert (ends[0] - ends[1]) / 2e-2 == pytest.approx(g[k][at], rel=2e-2, abs=1e-4)


def test_toxicity_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(5, 0), (7, 1), (8, None), (None, 1), (99, 5)],
                                   "doc_id long, toxic int")
    net = toxicity.train_network(odd, labels)
    rows = toxicity.score_texts(odd, net).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["score"] for r in rows if r["doc_id"] in (0, 1, 2)} == {0.0}
    assert toxicity.score_texts(none, net).count() == toxicity.without_toxic(none, net).count() == 0
    assert toxicity.train_network(odd, labels.where("false")) is not None


# 8 Licenses ----------------------------------------------------------------------------


def test_license_phrases(spark, documents):
    got = {r["doc_id"]: r for r in queries.op8_license_scan(spark, SF).collect()}
    assert set(got) == set(documents)
    for i, text in documents.items():
        places, r = plain.phrase_places(text), got[i]
        assert (r["n_words"], r["n_base"]) == (len(plain.letters(text)), len(places))
        assert r["base_labels"] == ",".join(sorted({label for _, label in places}))
        assert (r["first_word"], r["last_word"]) == (
            (places[0][0], places[-1][0]) if places else (None, None))


def test_template_blocks_equal_brute_force(spark):
    rng = random.Random(8)
    texts = []
    for i in range(120):
        _, template = rng.choice(licenses.TEMPLATES)
        w = [x if rng.random() > i / 240 else "zzz" for x in template.split()]
        texts.append((i, " ".join(["pre"] * rng.randrange(60) + w + ["post"] * rng.randrange(60))))
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r["doc_id"]: {(b["label"], b["first_word"]) for b in r["blocks"]}
           for r in licenses.find_licenses(df).collect()}
    for i, text in texts:
        w, want = plain.letters(text), set()
        for label, template in licenses.TEMPLATES:
            t = plain.letters(template)
            for start in range(0, len(w), len(t)):
                block = set(w[start:start + 2 * len(t)])
                if 100 * len(block & set(t)) >= 80 * len(set(t)):
                    want.add((label, start))
        assert got[i] == want


def test_licenses_of_odd_rows(odd, none):
    assert licenses.license_report(licenses.find_licenses(odd)).count() == odd.count()
    assert licenses.find_licenses(none).count() == 0


# 9 Decontamination ---------------------------------------------------------------------


def test_substituted_passages_are_found(spark):
    rng = random.Random(9)
    items = [(k, " ".join(f"q{k}x{i}" for i in range(rng.randint(5, 50)))) for k in range(20)]
    docs = []
    for i in range(80):
        w = items[i % 20][1].split()
        for at in rng.sample(range(len(w)), min(i // 20, len(w) // 12)):
            w[at] = "other"
        docs.append((i, "Before it, " + " ".join(w).upper() + ". After."))
    docs += [(100 + i, "nothing of it " * 9) for i in range(5)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["matched"]
           for r in decontaminate.contaminated(df, bench).collect()}
    want = {}
    for i, text in docs:
        for k, item in items:
            n = plain.aligned(text, item)
            if 100 * n >= 80 * min(20, len(item.split())):
                want[i, k] = n
    assert got == want and len(want) == 80


def test_decontamination_equals_its_sql(spark):
    from compare import connect

    got = queries.op9_decontaminate(spark, SF).toPandas()
    want = connect(SF).execute(queries.SQL["op9_decontaminate"]).df()
    order = ["doc_id", "item_id"]
    left = got[sorted(got)].sort_values(order).reset_index(drop=True)
    assert left.equals(want[sorted(want)].sort_values(order).reset_index(drop=True))


def test_decontamination_of_odd_rows(spark, odd, none):
    items = spark.createDataFrame([(1, "one two one two one two"), (2, "a b"), (3, None), (None, "x"),
                                   (1, "one two one two one two")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(odd, items).collect()}
    assert got == {(7, 1), (99, 1)}
    assert decontaminate.contaminated(none, items).count() == 0
    assert decontaminate.contaminated(odd, items.where("false")).count() == 0


# 10 Token files ------------------------------------------------------------------------


@pytest.mark.parametrize("values", [[], [0], [0, 0, 0], [5], [1, 1, 2, 900, 900, 10**7],
                                    list(range(0, 70000, 7))])
def test_elias_fano(values):
    ef = tokenfile.EliasFano.of(np.array(values, int))
    back = tokenfile.EliasFano(ef.count, ef.low_bits, ef.low, ef.high, ef.samples.tobytes())
    assert back.values().tolist() == values
    assert [back.select(i) for i in range(len(values))] == values
    if len(values) > 1000:
        assert 8 * (len(ef.low) + len(ef.high)) < len(values) * (2 + np.log2(values[-1] / len(values)) + 1)
    with pytest.raises(IndexError):
        back.select(len(values))


def test_token_file_round_trip(spark, documents, monkeypatch):
    monkeypatch.setattr(tokenfile, "BLOCK_IDS", 5000)
    got = {r["doc_id"]: r for r in queries.op10_token_file(spark, SF).collect()}
    start = 0
    for i in sorted(documents):
        ids = np.array([*tokenizer().encode(documents[i], add_special_tokens=False).ids, 0], "<u4")
        assert tuple(got[i])[1:] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_token_file_of_odd_rows(spark, odd, none):
    for df in (odd, none):
        path = new_scratch_path(spark, "odd-file")
        tokenfile.write_token_file(df, path)
        rows = tokenfile.document_starts(spark, path, tokenfile.read_token_file(spark, path))
        rows = rows.orderBy("start").collect()
        assert [r["doc_id"] for r in rows] == sorted(
            [r["doc_id"] for r in df.collect()], key=lambda i: (i is not None, i))
        ends = 0
        for r in rows:
            assert r["start"] == ends and len(r["ids"]) == 4 * r["n_tokens"]
            ends += r["n_tokens"]
