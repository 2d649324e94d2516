"""Language-model scores of whole texts, beside scores by word counts of the corpus.

1. One pass over the training texts counts words (by 64-bit hash) and subword ids.
2. The network of :mod:`parvis.llm.attention` is first fitted on a bounded sample of training
   texts; then every partition of the training texts goes on from there with every window of
   each text, and the results are averaged by the windows they have seen.
3. One pass over all texts scores every subword id once, in windows that overlap. The counts of
   the ``COMMON`` most frequent words are at hand there; rarer words are joined with theirs.

The probability of a text is that of its subword ids: its words, each with a space before
it, and the end id. An id that shares its class is weighed by its count plus one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parvis.llm.attention import CLASSES, START, WINDOW, Adam, Attention, windows_of
from parvis.llm.subwords import encoder
from parvis.llm.tables import id_text
from parvis.llm.words import Words, word_hash, word_slices
from parvis.staging import stage

IDS = 50_257
END_ID = IDS - 1
END_WORD = word_hash(" end")  # holds a space, so no word has it
COMMON = 1 << 17
SAMPLE_TEXTS, SAMPLE_STEPS = 256, 300
BATCH, SCORED_TOGETHER = 64, 128


def _signed(values) -> np.ndarray:
    return np.asarray(values, np.uint64).view(np.int64)


def subword_ids(words: Words, tokenizer: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts of a slice, each closed by the end id, and where each text begins."""
    ids, first = encoder(tokenizer, "words").word_ids(words, END_ID)
    return ids.astype(np.int64), first


class Classes:
    """Which class an id has, and its log probability within the shared class."""

    def __init__(self, counts: np.ndarray) -> None:
        top = np.lexsort((np.arange(IDS), -counts))[:CLASSES - 1]
        self.of = np.zeros(IDS, np.int64)
        self.of[top] = np.arange(1, CLASSES)
        rest = np.where(self.of == 0, counts + 1, 0)
        self.inner = np.where(self.of == 0, np.log(np.maximum(rest, 1) / rest.sum()), 0)
        self.unigram = np.bincount(self.of, counts + 1.0, CLASSES)
        self.unigram /= self.unigram.sum()


def batches_of(ids: np.ndarray, first: np.ndarray, classes: Classes,
               size: int = SCORED_TOGETHER):
    """Windows ``(text, inputs, wanted, mask, places)`` of the texts of a slice, in batches."""
    # What lies behind a text's end in its last window is masked, and nothing before sees it.
    kinds = np.append(classes.of[ids], np.zeros(WINDOW, np.int64)).astype(np.int32)
    before = np.append(np.int32(START), kinds[:-1])
    before[first[:-1]] = START
    text, start, scored = windows_of(np.diff(first))
    begin = (first[:-1][text] + start).astype(np.int32)
    left = np.minimum(first[1:][text] - begin, WINDOW)
    step = np.arange(WINDOW, dtype=np.int32)
    for a in range(0, len(text), size):
        part = slice(a, a + size)
        place = begin[part, None] + step
        mask = (step < left[part, None]) & (step >= scored[part, None])
        yield text[part], before[place], kinds[place], mask, place


def _counter(tokenizer: str | None):
    """Rows ``(kind, key, n)``: kind 0 words by hash, kind 1 subword ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_seen, ends = np.zeros(IDS, np.int64), 0

        def rows(kind, keys, n):
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys), pa.array(n)],
                names=["kind", "key", "n"])

        for batch in batches:
            for i, j, words in word_slices(batch.column(1)):
                keys, n = np.unique(words.hash, return_counts=True)
                yield rows(0, _signed(keys), n.astype(np.int64))
                ids, _ = subword_ids(words, tokenizer)
                ids_seen += np.bincount(ids, minlength=IDS)
                ends += j - i
        yield rows(0, _signed([END_WORD] * bool(ends)), np.array([ends] * bool(ends), np.int64))
        seen = np.flatnonzero(ids_seen)
        yield rows(1, seen.astype(np.int64), ids_seen[seen])
    return run


def _refine(tokenizer: str | None, classes: Classes, weights: np.ndarray):
    """Each task's weights after going on with its texts, times the windows seen; index -1 has these."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, seen = Attention(classes.unigram), 0
        net.load(weights)
        adam = Adam(net, 0.003)
        for batch in batches:
            for _, _, words in word_slices(batch.column(1)):
                ids, first = subword_ids(words, tokenizer)
                for _, inputs, wanted, mask, _ in batches_of(ids, first, classes, BATCH):
                    adam.learn(inputs, wanted, mask)
                    seen += len(inputs)
        values = np.append(net.flat().astype(np.float64) * seen, seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values)],
            names=["at", "value"])
    return run


def fit(train: DataFrame, tokenizer: str | None, classes: Classes) -> Attention:
    """Fit on a bounded sample, then on all partitions of ``train(doc_id, text)``, averaged."""
    net = Attention(classes.unigram)
    few = train.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).limit(SAMPLE_TEXTS)
    texts, adam = [r["text"] for r in few.collect()], Adam(net, 0.02)
    windows = []
    for _, _, words in word_slices(pa.array(texts, pa.string())):
        windows += list(batches_of(*subword_ids(words, tokenizer), classes, BATCH))
    order = np.random.default_rng(3).permutation(len(windows))
    steps = max(SAMPLE_STEPS, len(windows)) if windows else 0
    for step in range(steps):
        adam.rate = 0.02 * min(1, 1.5 - step / steps)
        _, inputs, wanted, mask, _ = windows[order[step % len(windows)]]
        adam.learn(inputs, wanted, mask)
    start = net.flat()
    parts = train.mapInArrow(_refine(tokenizer, classes, start), "at int, value double")
    sums = {r["at"]: r["v"] for r in parts.groupBy("at").agg(F.sum("value").alias("v")).collect()}
    if sums.get(len(start)):
        net.load(np.array([sums[i] for i in range(len(start))]) / sums[len(start)])
    return net


def _most_frequent(word_counts: DataFrame, most: int) -> DataFrame:
    """The words above a count that no more than ``most`` words have.

    The count is found from a histogram whose steps are single counts up to 511 and 256 a power of
    two beyond, so at most about 14 000 rows reach the driver, whatever the number of partitions.
    """
    rough = F.expr("greatest(length(bin(n)) - 9, 0)")
    step = F.expr("shiftleft(shiftright(n, rough), rough)")
    sizes = word_counts.withColumn("rough", rough).groupBy(step.alias("least")).agg(
        F.count("*").alias("words")).collect()
    least, words = None, 0
    for r in sorted(sizes, reverse=True):
        words += r["words"]
        if words > most:
            break
        least = r["least"]
    return word_counts.where("false" if least is None else F.col("n") >= least)


SCORED = ("row_key long, doc_id long, held_out boolean, n_tokens long, n_common long, "
          "common_log double, score double, rare array<long>, rare_n array<int>")


def _scorer(tokenizer: str | None, classes: Classes, net: Attention, common: np.ndarray,
            logs: np.ndarray):
    names = [c.split()[0] for c in SCORED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, words in word_slices(batch.column(3)):
                distinct, _, index = words.distinct
                at = np.minimum(np.searchsorted(common, distinct), max(len(common) - 1, 0))
                found = common[at] == distinct if len(common) else np.zeros(len(at), bool)
                at, known = at[index], found[index]
                text = np.repeat(np.arange(j - i), np.diff(words.first))
                n_common = np.bincount(text[known], minlength=j - i)
                log = np.bincount(text[known], logs[at[known]], j - i)
                pairs, rare_n = np.unique(text[~known] * len(distinct) + index[~known],
                                          return_counts=True)
                of, rare = np.divmod(pairs, max(len(distinct), 1))
                ends = pa.array(np.searchsorted(of, np.arange(j - i + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(ends, pa.array(v)) for v in (
                    _signed(distinct[rare]), rare_n.astype(np.int32))]
                ids, first = subword_ids(words, tokenizer)
                score = np.zeros(j - i)
                for of, inputs, wanted, mask, place in batches_of(ids, first, classes):
                    own = net.score(inputs, wanted, mask) + classes.inner[ids[place[mask]]]
                    score += np.bincount(np.repeat(of, mask.sum(axis=1)), own, j - i)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(k).slice(i, j - i) for k in range(3)]
                    + [pa.array(np.diff(words.first) + 1), pa.array(n_common),
                       pa.array(log.astype(np.float64)),
                       pa.array(score / np.log(10)), *lists],
                    names=names)
    return run


def score_texts(docs: DataFrame, held_out, tokenizer: str | None = None,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per text: counts of tokens, the score by word counts and the model's, both log10.

    Learned from rows whose ``held_out(doc_id)`` is false. A null text is empty and has the end
    token only; a null id is not held out. Rows that are alike get the same
    scores, up to rounding. Without
    training texts all counts are 0, and the base score of any token is -log10(1) = 0.
    """
    rows = id_text(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    train = rows.where(~held_out(F.col("doc_id")))
    counted = train.mapInArrow(_counter(tokenizer), "kind int, key long, n long")
    counts = stage(counted.groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")
    word_counts = counts.where("kind = 0").select("key", "n")
    totals = word_counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    subwords = np.zeros(IDS)
    for r in counts.where("kind = 1").collect():
        subwords[r["key"]] = r["n"]
    classes = Classes(subwords)
    net = fit(train, tokenizer, classes)

    top = _most_frequent(word_counts, COMMON).toPandas()
    keys = top["key"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    logs = np.log10(top["n"].to_numpy(np.float64) + 1)[order]
    known_end = int(totals[0] > 0)
    end_log = float(np.log10(word_counts.where(F.col("key") == int(_signed([END_WORD])[0]))
                             .agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] + 1))

    keyed = rows.select(F.xxhash64("doc_id", "text").alias("row_key"), "doc_id",
                        held_out(F.col("doc_id")).alias("held_out"), "text")
    scored = stage(keyed.mapInArrow(
        _scorer(tokenizer, classes, net, keys[order], logs), SCORED), "scored")
    pairs = scored.select("row_key", F.explode(F.arrays_zip("rare", "rare_n")).alias("r")).select(
        "row_key", F.col("r.rare").alias("key"), F.col("r.rare_n").alias("times"))
    rare = (pairs.join(word_counts, "key")
            .groupBy("row_key").agg(F.sum(F.log10(F.col("n") + 1) * F.col("times")).alias("log"),
                                    F.sum("times").alias("known")))
    alike = scored.groupBy("row_key").agg(F.count("*").alias("alike"))
    sums = rare.join(alike, "row_key").select(
        "row_key", (F.col("log") / F.col("alike")).alias("rare_log"),
        (F.col("known") / F.col("alike")).cast("long").alias("rare_known"))
    whole = F.log10(F.lit(float(totals[0] + totals[1] + 1)))
    return scored.drop("rare", "rare_n").join(sums, "row_key", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_common") + F.coalesce("rare_known", F.lit(0)) + known_end).alias("n_known"),
        F.lit(int(totals[0])).cast("long").alias("train_tokens"),
        (F.col("common_log") + F.coalesce("rare_log", F.lit(0.0)) + end_log
         - F.col("n_tokens") * whole).alias("base_score"), "score")
