"""Benchmark passages in training texts, found by spaced seeds.

A mask such as ``11011`` looks at some of the words under it and ignores the others, so that a
substituted word in an ignored place does not hide a passage. The hashes of all masks at all
places of the benchmark set bits in a map of fixed size; places of the training texts that
miss the map are dropped before any shuffle, and the others are joined with the benchmark's
hashes. A hit gives a diagonal; along it the item is held against the text word by word.

Only DataFrame functions are used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parvis.llm.bitmap import bit_map, in_map
from parvis.staging import stage

MASKS = ("11011", "1101011", "11101101")
# For items of so many words, what MASKS would miss at the threshold.
SHORT_MASKS = {5: ("1111", "10111", "11101"), 6: ("1111",), 10: ("1111001111",)}
ALL_MASKS = tuple(dict.fromkeys(MASKS + sum(SHORT_MASKS.values(), ())))
LEAST = 5  # words of an item that has seeds; one of fewer words must be there word by word
WINDOW = 20
THRESHOLD = 80
SEPARATORS = r"[^\p{L}\p{N}]+"


def word_hashes(text: Column) -> Column:
    """The hashes of the lower-cased runs of letters and digits of a text."""
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _seeds(rows: DataFrame, masks: dict[str, list[int]], *keep: str) -> DataFrame:
    """``keep``, the place and the hash of every mask at every place of ``h``.

    ``masks`` gives the sizes of ``h`` that a mask is for; all if it gives none.
    """
    size, least = F.size("h"), min(map(len, masks))
    at = F.explode(F.when(size >= least, F.sequence(F.lit(0), size - least)))
    placed = rows.where(size >= least).select(*keep, "h", at.alias("place"))
    keys = []
    for mask, sizes in masks.items():
        seen = [F.get("h", F.col("place") + k) for k, bit in enumerate(mask) if bit == "1"]
        key = F.xxhash64(F.lit(ALL_MASKS.index(mask)), *seen)
        fits = F.col("place") + len(mask) <= F.size("h")
        keys.append(F.when(fits & F.size("h").isin(sizes) if sizes else fits, key))
    return placed.select(*keep, "place", F.explode(F.array(*keys)).alias("key")).where(
        "key is not null")


def _verbatim(texts: DataFrame, items: DataFrame) -> DataFrame:
    """``(doc_id, item_id, doc_start)``: where items of a few words first stand in a text as they are."""
    sizes = sorted(r["n"] for r in items.select(F.size("h").alias("n")).distinct().collect())

    def runs(n: int) -> Column:
        places = F.sequence(F.lit(0), F.size("h") - n)
        return F.when(F.size("h") >= n, F.transform(
            places, lambda p: F.xxhash64(F.lit(n), F.slice("h", p + 1, n)))).otherwise(
            F.array().cast("array<bigint>"))

    keys = stage(items.select("item_id", F.xxhash64(F.size("h"), "h").alias("key")), "short-items")
    wanted = bit_map(keys)
    hits = [texts.select("doc_id", F.posexplode(runs(n)).alias("doc_start", "key")).where(
        in_map(wanted, F.col("key"))) for n in sizes]
    first = reduce(lambda a, b: a.unionByName(b), hits).groupBy("doc_id", "key").agg(
        F.min("doc_start").alias("doc_start"))
    return first.join(keys, "key").select("doc_id", "item_id", "doc_start")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text", item_col: str = "item_id", item_text: str = "text"
                 ) -> DataFrame:
    """``(doc_id, item_id, doc_start, matched, window)``: a row per text and item found in it.

    An item is found where, along a diagonal that a mask hit, ``WINDOW`` consecutive words of it
    (all, if it has fewer) agree with the text in ``THRESHOLD`` percent of the places. Of several
    places the one with most agreeing words counts, then the first; ``doc_start`` is the
    word where the item begins there (it may lie before the text). Items of fewer than five words
    have no seeds; at the threshold none of their words may differ, and they are joined by the hash of
    all of them. Items without words are never found; null texts are empty; rows without an
    id are not searched.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text")).where("doc_id is not null")
    texts = rows.select("doc_id", word_hashes(F.col("text")).alias("h"))
    items = stage(
        benchmark.select(F.col(item_col).cast("long").alias("item_id"),
                         word_hashes(F.col(item_text).cast("string")).alias("h"))
        .where(F.col("item_id").isNotNull() & (F.size("h") > 0)).distinct(), "items")
    tiny = items.where(F.size("h") < LEAST)
    seeded = items.where(F.size("h") >= LEAST)
    short = [r["n"] for r in items.select(F.size("h").alias("n")).where(
        F.col("n").isin(list(SHORT_MASKS))).distinct().collect()]
    masks: dict[str, list[int]] = {m: [] for m in MASKS}
    for n in sorted(short):
        for m in SHORT_MASKS[n]:
            masks.setdefault(m, []).append(n)
    keys = stage(_seeds(seeded, masks, "item_id").withColumnRenamed("place", "item_place").distinct(),
                 "seeds")
    passed = _seeds(texts, {m: [] for m in masks}, "doc_id").where(in_map(bit_map(keys), F.col("key")))
    found = passed.join(keys, "key").select(
        "doc_id", "item_id", (F.col("place") - F.col("item_place")).alias("doc_start"))
    if tiny.limit(1).count():
        found = found.unionByName(_verbatim(texts, tiny))
    found = stage(found.distinct(), "diagonals")

    own = found.select(F.xxhash64("doc_id").alias("key"))
    again = (rows.where(in_map(bit_map(own), F.xxhash64("doc_id")))
             .select("doc_id", word_hashes(F.col("text")).alias("h")))
    pairs = found.join(again, "doc_id").join(
        items.withColumnRenamed("h", "item"), "item_id")
    agree = F.transform("item", lambda w, q: (
        F.coalesce(F.try_element_at("h", F.when(q + F.col("doc_start") >= 0,
                                                q + F.col("doc_start") + 1)) == w,
                   F.lit(False))).cast("int"))
    window = F.least(F.size("item"), F.lit(WINDOW))
    checked = pairs.select("doc_id", "item_id", "doc_start", agree.alias("agree"),
                           window.alias("window"))
    best = F.array_max(F.transform(
        F.sequence(F.lit(1), F.size("agree") - F.col("window") + 1),
        lambda s: F.aggregate(F.slice("agree", s, F.col("window")), F.lit(0), lambda a, x: a + x)))
    return (
        checked.withColumn("matched", best)
        .where(F.col("matched") * 100 >= F.col("window") * THRESHOLD)
        .groupBy("doc_id", "item_id")
        .agg(F.min(F.struct((-F.col("matched")).alias("less"), "doc_start", "window")).alias("m"))
        .select("doc_id", "item_id", F.col("m.doc_start").cast("long").alias("doc_start"),
                (-F.col("m.less")).cast("long").alias("matched"),
                F.col("m.window").cast("long").alias("window")))


def _sql_keys(items: bool) -> str:
    """The words under each mask at place p, and which items have that mask."""
    sizes = {m: f"len(h) >= {LEAST}" for m in MASKS}
    for n in range(1, LEAST):
        sizes["1" * n] = f"len(h) = {n}"
    for n, masks in SHORT_MASKS.items():
        for m in masks:
            sizes[m] = f"({sizes[m]} OR len(h) = {n})" if m in sizes else f"len(h) = {n}"
    return ", ".join(
        f"CASE WHEN p + {len(m)} <= len(h)" + f" AND {asked}" * items + " THEN [" + ", ".join(
            f"h[p + {k + 1}]" if bit == "1" else "''" for k, bit in enumerate(m)) + "] END"
        for m, asked in sizes.items())


# The same pairs without hashes: masks are joined on the words themselves.
SQL = """
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'),
                                      lambda w: w <> '') AS h FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'),
                                  lambda w: w <> '') AS h FROM benchmark),
dp AS (SELECT doc_id, h, unnest(range(0, len(h))) AS p FROM d),
bp AS (SELECT item_id, h, unnest(range(0, len(h))) AS p FROM b),
dk AS (SELECT doc_id, p, unnest([{DOC_KEYS}]) AS k FROM dp),
bk AS (SELECT item_id, p, unnest([{ITEM_KEYS}]) AS k FROM bp),
hit AS (SELECT DISTINCT doc_id, item_id, dk.p - bk.p AS g FROM dk JOIN bk USING (k)),
aligned AS (SELECT doc_id, item_id, g, least(len(b.h), 20) AS w, list_transform(range(0, len(b.h)),
   lambda q: CASE WHEN q + g >= 0 AND d.h[q + g + 1] = b.h[q + 1] THEN 1 ELSE 0 END) AS a
   FROM hit JOIN d USING (doc_id) JOIN b USING (item_id)),
best AS (SELECT doc_id, item_id, g, w, list_max(list_transform(range(1, len(a) - w + 2),
   lambda s: list_sum(a[s:s + w - 1]))) AS m FROM aligned)
SELECT doc_id, item_id, arg_min(g, 1000000 * (1000 - m) + g)::BIGINT AS doc_start,
   max(m)::BIGINT AS matched, max(w)::BIGINT AS "window"
FROM best WHERE m * 100 >= w * 80 GROUP BY doc_id, item_id
""".replace("{DOC_KEYS}", _sql_keys(False)).replace("{ITEM_KEYS}", _sql_keys(True))
