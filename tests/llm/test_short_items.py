"""Benchmark items of five words and more are found at exactly the threshold."""

from __future__ import annotations

import random
from itertools import combinations

from parvis.llm import decontaminate


def test_items_of_five_words_and_more_are_found_at_the_threshold(spark):
    items, docs, want, none = [], [], set(), 10_000
    for n in range(5, 13):
        words = [f"i{n}w{k}" for k in range(n)]
        items.append((n, " ".join(words)))
        for gone in combinations(range(n), n - -(-n * 80 // 100)):
            text = [f"x{k}" if k in gone else w for k, w in enumerate(words)]
            docs.append((len(docs), " ".join(["a", "b", *text, "c"])))
            want.add((docs[-1][0], n))
            docs.append((len(docs), " ".join(w for k, w in enumerate(text) if k not in (
                gone if set(gone) <= {0} or set(gone) <= {n - 1} else ()))))
            want.add((docs[-1][0], n))
        few = [f"x{k}" if k <= n - -(-n * 80 // 100) else w for k, w in enumerate(words)]
        docs.append((none + n, " ".join(["a", *few, "c"])))
    got = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                                     spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == want


def test_items_of_one_to_four_words_and_the_sql(spark, tmp_path):
    import duckdb

    rng = random.Random(6)
    words = [f"w{k}" for k in range(12)]
    items = [(n * 10 + k, " ".join(rng.choice(words) for _ in range(n)))
             for n in range(13) for k in range(3)] + [(999, None), (1000, "?!")]
    docs = [(k, " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 3, 30])))
             + " Z. " + rng.choice(items[:39])[1]) for k in range(80)] + [(500, None)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark")
    read = lambda name: spark.read.parquet(f"{tmp_path}/{name}")
    found = decontaminate.contaminated(read("documents"), read("benchmark"))
    got = sorted(tuple(r) for r in found.select(
        "doc_id", "item_id", "doc_start", "matched", "window").collect())
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}/*.parquet'")
    assert got == sorted(con.execute(decontaminate.SQL).fetchall())
    text = {i: f" {' '.join((t or '').replace('.', '').lower().split())} " for i, t in docs}
    want = {(d, i) for d in text for i, t in items if t and 0 < len(t.split()) < 5 and "?" not in t
            and f" {t} " in text[d]}
    assert {(d, i) for d, i, _, _, window in got if window < 5} == want
