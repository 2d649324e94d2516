"""The corpus pipeline: ``documents`` to packed training sequences, stage by stage.

Each stage reads what the one before it wrote as Parquet. All but the last return the columns of
``documents`` with the rows that stay. Further columns stay as they are, whatever their names.
Rows of one id are one document: they stay or go together, but of those with one text a single one
stays. A row without an id is a document of its own; rows without an id that are equal in all columns
are one. An empty table gives an empty table in every stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parvis.llm import decontaminate, minhash, packing, secrets, toxicity
from parvis.llm.bitmap import bit_map, in_map
from parvis.llm.tables import bound_batches, read, ship
from parvis.staging import new_scratch_path, stage as staged

WITHOUT_ID = 1 << 62  # keys of rows without an id begin here, behind all usual ids


def row_key(docs: DataFrame) -> Column:
    """The id, or where it is null a number from all columns of the row.

    Different rows without an id get the same number with a chance of one in 2^62 for a pair; they
    would then count as one document.
    """
    own = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    return F.coalesce(F.col("doc_id").cast("long"),
                      own.bitwiseAND(WITHOUT_ID - 1) + F.lit(WITHOUT_ID))


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with the key in place of the id."""
    return docs.select(row_key(docs).alias("doc_id"), "text")


def without_repeats(docs: DataFrame) -> DataFrame:
    """One row for each key and text, of several the one with the least other columns.

    Only rows whose hash is there twice are shuffled.
    """
    key = row_key(docs)
    rows = docs.select(key.alias("key"), "text", F.struct("*").alias("row"))
    hashed = F.xxhash64("key", "text")
    twice = staged(rows.groupBy(hashed.alias("key")).agg(F.count("*").alias("n"))
                   .where("n > 1").select("key"), "repeats")
    repeated = in_map(bit_map(twice), hashed)
    once = rows.where(~repeated).select("row.*")
    return once.unionByName(rows.where(repeated).groupBy("key", "text").agg(
        F.min("row").alias("row")).select("row.*"))


def without_keys(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows whose key is not among the ids in ``gone``."""
    keys = gone.select(F.col("doc_id").alias("key")).distinct()
    rows = docs.select(row_key(docs).alias("key"), F.struct("*").alias("row"))
    return rows.join(keys, "key", "left_anti").select("row.*")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network scores below one half.

    Every row is scored by its own text. Null and empty texts have a score as well. Labels without
    a document, and documents without an id, take no part in learning.
    """
    ship(spark)
    bound_batches(spark)
    network = toxicity.train_network(docs, read(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, network)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id.

    Rows without an id are compared like all others and stay only if their group has no id.
    Null texts and texts without words are like nothing; of such rows, only repeats go.
    """
    ship(spark)
    bound_batches(spark)
    gone = minhash.near_duplicates(keyed(docs)).where("not kept")
    return without_repeats(without_keys(docs, gone))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark, rows without an id among them.

    Null and empty texts hold no passage; items without text are in no document.
    """
    found = decontaminate.contaminated(keyed(docs), read(spark, sf_dir, "benchmark"))
    return without_keys(docs, found)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with secrets replaced by a mark; null and empty texts stay as they are."""
    ship(spark)
    bound_batches(spark)
    return secrets.without_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 token ids.

    Every row is packed, with its id or null; a null or empty text is its end id alone.
    """
    ship(spark)
    bound_batches(spark)
    pieces = packing.pack_documents(docs)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_copies),
          ("decontamination", drop_benchmark), ("secrets", mask_secrets), ("packing", pack)]

ORACLE_SQL = None  # no stage but one can be said in SQL; the tests compare with plain Python


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = read(spark, sf_dir, "documents"), new_scratch_path(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{path}/{name}")
        docs = spark.read.parquet(f"{path}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
