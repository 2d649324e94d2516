"""Near-duplicates by one-permutation MinHash.

One hash orders the shingles of a set; its range is cut into equal bins, and the smallest
shingle of each bin is the signature. An empty bin borrows from the first filled bin of a fixed
random order of its own (optimal densification). Bands of the signature are bucket keys.
Inside a bucket one document after the other is the centre of a star: it is held against the
others that its component does not hold yet, and only star edges that join two components leave
the task. So a bucket of m documents gives at most m - 1 edges.

Buckets see sets folded to ``FOLD`` bytes a shingle. Folding can only raise the overlap of two
multisets, so it hides no link. Each distinct star edge is then confirmed on full sets, which
travel once an edge. A bucket with an edge that fails is looked at again on full sets, so no link
between different texts is lost.

Equal sets are one node. Buckets with the same members are looked at once. A bucket above
``CHUNK`` members is split into chunks, and each pair of chunks is a group of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parvis.llm.bitmap import bit_map, in_map
from parvis.llm.components import connected_components
from parvis.llm.tables import id_text
from parvis.llm.words import BASE, Words, mix, word_slices
from parvis.staging import stage

BANDS, ROWS = 32, 6  # misses a pair of similarity 0.85 with probability 3e-7
CHUNK = 2048
SALTS = 16
SKETCH = "doc_id long, n_shingles long, digest binary, bands array<long>"

_BINS = BANDS * ROWS
_EDGES = np.array([(k << 64) // _BINS for k in range(_BINS)], np.uint64)
_PROBES = np.argsort(np.random.default_rng(7).random((_BINS, _BINS)), axis=1)
_WEIGHTS = np.random.default_rng(11).integers(1, 1 << 63, _BINS, dtype=np.uint64) | np.uint64(1)


def shingle_sets(words: Words, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; fewer words than ``size`` are one shingle."""
    h, total = words.hash, None
    for k in range(size):
        part = h[k:len(h) - size + 1 + k] * np.uint64(pow(BASE, k, 1 << 64))
        total = part if total is None else total + part
    shingles = mix(total) if len(h) >= size else np.empty(0, np.uint64)
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if b - a >= size:
            yield np.unique(shingles[a:b - size + 1])
        elif b > a:
            weights = [pow(BASE, 100 + k, 1 << 64) for k in range(b - a)]
            yield mix((h[a:b] * np.array(weights, np.uint64)).sum(keepdims=True, dtype=np.uint64))
        else:
            yield np.empty(0, np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Smallest hash per bin of a sorted non-empty set, empty bins filled by densification."""
    at = np.searchsorted(shingles, _EDGES)
    filled = np.append(at[1:], len(shingles)) > at
    source = np.arange(_BINS)
    empty = np.flatnonzero(~filled)
    for width in (16, _BINS):
        if len(empty):
            found = filled[_PROBES[empty, :width]]
            hit = found.any(axis=1)
            source[empty[hit]] = _PROBES[empty[hit], found[hit].argmax(axis=1)]
            empty = empty[~hit]
    return shingles[at[source]]


def band_keys(sig: np.ndarray) -> np.ndarray:
    keys = mix((sig * _WEIGHTS).reshape(BANDS, ROWS).sum(axis=1, dtype=np.uint64))
    return mix(keys + np.arange(BANDS, dtype=np.uint64) * np.uint64(BASE)).view(np.int64)


def _sketches(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, bands = [], [], []
            for _, _, words in word_slices(batch.column(1)):
                for s in shingle_sets(words, size):
                    counts.append(len(s))
                    digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                                   if len(s) else None)
                    bands.append(band_keys(signature(s)) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "digest", "bands"])
    return run


SETS = "bucket long, low int, high int, node long, side int, shingles binary"
BATCH_BYTES = 1 << 23
FOLD = 3


def fold(shingles: np.ndarray, width: int = FOLD) -> bytes:
    """The highest ``width`` bytes of each hash of a sorted set."""
    high = (shingles >> np.uint64(64 - 8 * width)).astype("<u8").view(np.uint8)
    return high.reshape(-1, 8)[:, :width].tobytes()


def unfold(folded: bytes, width: int = FOLD) -> np.ndarray:
    """A folded set as distinct values: equal ones are numbered."""
    raw = np.frombuffer(folded, np.uint8).reshape(-1, width).astype(np.uint64)
    value = sum(raw[:, k] << np.uint64(8 * k) for k in range(width))
    every = np.arange(len(value))
    fresh = np.ones(len(value), bool)
    fresh[1:] = value[1:] != value[:-1]
    first = np.maximum.accumulate(np.where(fresh, every, 0))
    return value << np.uint64(32) | (every - first).astype(np.uint64)


def unpack(shingles: bytes) -> np.ndarray:
    return np.frombuffer(shingles, np.uint64)


def _sets(size: int, packed: Callable[[np.ndarray], bytes]):
    """For each text its set, once for every group of its buckets."""
    names = [c.split()[0] for c in SETS.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0

        def done() -> pa.RecordBatch:
            columns = zip(*rows, strict=True) if rows else [[]] * len(names)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            sets = (packed(s) for _, _, words in word_slices(batch.column(1))
                    for s in shingle_sets(words, size))
            nodes = batch.column(0).to_pylist()
            spread = mix(np.array(nodes, np.int64).view(np.uint64)).tolist()
            for node, number, own, s in zip(nodes, spread, batch.column(2), sets, strict=True):
                for bucket in own.as_py():
                    chunks = -(-bucket["members"] // CHUNK)
                    side = number % chunks
                    for other in range(chunks):
                        rows.append((bucket["bucket"], min(side, other), max(side, other), node,
                                     side, s))
                        held += len(s)
                        if held >= BATCH_BYTES:
                            yield done()
                            rows, held = [], 0
        yield done()
    return run


def star_edges(ids: np.ndarray, sides: np.ndarray, sets: list[np.ndarray], threshold: int
               ) -> list[tuple[int, int]]:
    """Edges that join the components of one group, found star by star.

    ``sides`` tells the chunk of each member; two members of different chunks are compared, or
    any two if all have the same.
    """
    order = np.argsort(ids, kind="stable")
    ids, sides, sets = ids[order], sides[order], [sets[i] for i in order]
    sizes = np.array([len(s) for s in sets])
    _, codes = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    mark = np.zeros(codes.max() + 1, np.int32)
    labels, split, out = np.arange(len(ids)), sides.min() != sides.max(), []
    for hub in range(len(ids) - 1):
        want = labels[hub + 1:] != labels[hub]
        if split:
            want &= sides[hub + 1:] != sides[hub]
        own, others = sizes[hub], sizes[hub + 1:]
        want &= 100 * np.minimum(own, others) >= threshold * np.maximum(own, others)
        leaves = np.flatnonzero(want) + hub + 1
        if not len(leaves):
            continue
        mine = codes[starts[hub]:starts[hub + 1]]
        mark[mine] = 1
        if len(leaves) * 3 > len(ids) - hub:
            common = np.add.reduceat(mark[codes[starts[hub + 1]:]], starts[hub + 1:-1]
                                     - starts[hub + 1])[leaves - hub - 1]
        else:
            common = np.array([mark[codes[starts[j]:starts[j + 1]]].sum() for j in leaves])
        mark[mine] = 0
        for leaf in leaves[100 * common >= threshold * (own + sizes[leaves] - common)]:
            if labels[leaf] != labels[hub]:
                out.append((int(ids[hub]), int(ids[leaf])))
                labels[labels == labels[leaf]] = labels[hub]
    return out


def _links(threshold: int, unpacked: Callable[[bytes], np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, sides, sets = None, [], [], []

        def done():
            edges = star_edges(np.array(ids), np.array(sides), sets, threshold)
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]] * len(edges), pa.int64()),
                 *[pa.array([e[k] for e in edges], pa.int64()) for k in (0, 1)]],
                names=["bucket", "a", "b"])

        for batch in batches:
            for *k, i, side, s in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if k != key:
                    if len(ids) > 1:
                        yield done()
                    key, ids, sides, sets = k, [], [], []
                ids.append(i)
                sides.append(side)
                sets.append(unpacked(s))
        if len(ids) > 1:
            yield done()
    return run


def _bucket_links(rows: DataFrame, members: DataFrame, size: int, threshold: int,
                  width: int | None) -> DataFrame:
    """``(bucket, a, b)``: star edges of the buckets of ``members(bucket, members, node)``.

    Sets are folded to ``width`` bytes a shingle, or whole if it is None.
    """
    packed, unpacked = (np.ndarray.tobytes, unpack) if width is None else (
        partial(fold, width=width), partial(unfold, width=width))
    # At most BANDS buckets a document.
    wanted = stage(members.groupBy("node").agg(
        F.collect_list(F.struct("bucket", "members")).alias("buckets")), "wanted")
    texts = _texts_of(rows, wanted).select("node", "text", "buckets")
    group = ["bucket", "low", "high"]
    return stage(
        texts.mapInArrow(_sets(size, packed), SETS)
        .repartition(*group).sortWithinPartitions(*group)
        .mapInArrow(_links(threshold, unpacked), "bucket long, a long, b long"),
        "links")


def _texts_of(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    seen = bit_map(wanted.select(F.xxhash64("node").alias("key")))
    return rows.where(in_map(seen, F.xxhash64("doc_id"))).join(
        wanted, F.col("doc_id") == F.col("node"))


STARS = "hub long, part int, side int, node long, shingles binary"


def _star_sets(size: int):
    """The set of each text, once for each part of a star it is in; a hub is on side 0."""
    names = [c.split()[0] for c in STARS.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0

        def done() -> pa.RecordBatch:
            columns = zip(*rows, strict=True) if rows else [[]] * len(names)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            sets = (s.tobytes() for _, _, words in word_slices(batch.column(1))
                    for s in shingle_sets(words, size))
            for node, own, s in zip(batch.column(0).to_pylist(), batch.column(2), sets,
                                    strict=True):
                for star in own.as_py():
                    rows.append((star["hub"], star["part"], int(star["hub"] != node), node, s))
                    held += len(s)
                    if held >= BATCH_BYTES:
                        yield done()
                        rows, held = [], 0
        yield done()
    return run


def _confirm(threshold: int):
    """``(a, b, linked)`` of each hub and leaf; the hub's sets come before those of its leaves.

    An id with several texts has several sets, and any pair of them may link.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        star, hubs = None, []
        for batch in batches:
            out = []
            for hub, part, side, node, s in zip(*(c.to_pylist() for c in batch.columns),
                                                strict=True):
                own = unpack(s)
                if (hub, part) != star:
                    star, hubs = (hub, part), []
                if side == 0:
                    hubs.append(own)
                    continue
                common = [(len(np.intersect1d(h, own, assume_unique=True)), len(h)) for h in hubs]
                out.append((hub, node, any(
                    100 * c >= threshold * (n + len(own) - c) for c, n in common)))
            columns = zip(*out, strict=True) if out else [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(
                    columns, (pa.int64(), pa.int64(), pa.bool_()), strict=True)],
                names=["a", "b", "linked"])
    return run


def _confirmed(rows: DataFrame, edges: DataFrame, size: int, threshold: int) -> DataFrame:
    """``(a, b, linked)`` for each edge, held on full sets; a star of many leaves is cut in parts."""
    hubs = stage(edges.groupBy("a").agg(
        F.ceil(F.count("*") / CHUNK).cast("int").alias("parts")), "hubs")
    leaves = edges.join(hubs, "a").select(
        F.col("b").alias("node"), F.col("a").alias("hub"),
        F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"))
    centres = hubs.select(F.col("a").alias("node"), F.col("a").alias("hub"),
                          F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    wanted = stage(leaves.unionByName(centres).groupBy("node").agg(
        F.collect_list(F.struct("hub", "part")).alias("stars")), "stars")
    checked = (_texts_of(rows, wanted).select("node", "text", "stars")
               .mapInArrow(_star_sets(size), STARS).repartition("hub", "part")
               .sortWithinPartitions("hub", "part", "side")
               .mapInArrow(_confirm(threshold), "a long, b long, linked boolean"))
    return stage(checked.groupBy("a", "b").agg(F.max("linked").alias("linked")), "confirmed")


def near_duplicates(docs: DataFrame, shingle_words: int = 5, threshold: int = 80,
                    id_col: str = "doc_id", text_col: str = "text",
                    fold_bytes: int = FOLD) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row of ``docs``.

    Two documents are linked if ``100 * common shingles >= threshold * all their shingles``;
    a component is what links reach, named by its smallest id. Null and empty texts and texts
    without words have no shingles and no links. Rows with the same id are one document, with a
    shingle count per row; a row without id has no component and counts as kept. The candidate
    search misses a link of similarity 0.85 with a chance of about 3e-7, of 0.8 with 5e-5.
    ``fold_bytes`` changes what travels, not the result.
    """
    rows = id_text(docs, id_col, text_col)
    sketch = stage(rows.mapInArrow(_sketches(shingle_words), SKETCH), "sketches")
    known = sketch.where("digest is not null and doc_id is not null")
    groups = stage(
        known.groupBy("digest").agg(F.min("doc_id").alias("node"), F.max("doc_id").alias("last"))
        .where("node < last").select("digest", "node"), "copies")
    spread = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    copies = stage(
        known.select("doc_id", "digest", F.pmod("doc_id", F.lit(SALTS)).cast("int").alias("salt"))
        .join(spread, ["digest", "salt"]).where("doc_id <> node")
        .select("doc_id", "digest", "node").distinct(), "copies")

    # By text too: another text of the same id has links of its own.
    single = known.select("doc_id", "digest", "bands").join(
        copies, ["doc_id", "digest"], "left_anti")
    buckets = single.select(F.col("doc_id").alias("node"), F.explode("bands").alias("bucket"))
    shared = stage(
        buckets.groupBy("bucket")
        .agg(F.count("*").alias("members"), F.bit_xor(F.xxhash64("node")).alias("x"),
             F.sum(F.xxhash64("node", F.lit(1)).bitwiseAND(0xFFFFFFFF)).alias("y"))
        .where("members > 1")
        .groupBy("members", "x", "y").agg(F.min("bucket").alias("bucket")), "buckets")
    filled = bit_map(shared.select(F.col("bucket").alias("key")))
    members = stage(
        buckets.where(in_map(filled, F.col("bucket")))
        .join(shared.select("bucket", "members"), "bucket").distinct(), "members")

    stars = _bucket_links(rows, members, shingle_words, threshold, fold_bytes)
    checked = _confirmed(rows, stars.select("a", "b").distinct(), shingle_words, threshold)
    links = checked.where("linked").select("a", "b")
    failed = stars.join(checked.where("not linked"), ["a", "b"]).select("bucket").distinct()
    if not failed.isEmpty():
        again = members.join(stage(failed, "failed"), "bucket")
        links = links.union(_bucket_links(
            rows, again, shingle_words, threshold, None).select("a", "b"))

    labels = connected_components(
        links.union(copies.select(F.col("doc_id").alias("a"), F.col("node").alias("b"))))
    out = sketch.select("doc_id", "n_shingles").join(
        labels, sketch.doc_id == labels.node, "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
