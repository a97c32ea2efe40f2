"""Token counts with a digest cache.

Content digests and the tokenizer's digest are joined to stored counts; only distinct
misses are encoded, and their counts are appended to the cache. Texts leave their
partition only as misses, compressed, and once per distinct content and task, so a group
of copies that holds a third of all rows sends one text per task.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from importlib.metadata import version

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerwalk.session import run_folder

from .common import small_batches, store

CACHE_SCHEMA = "digest binary, n_tokens long, tokenizer string"


def normal_content(text: Column) -> Column:
    """The content whose tokens are counted: null is the empty text and nothing else changes,
    since a byte-level tokenizer counts every character as it stands."""
    return F.coalesce(text, F.lit(""))


def tokenizer_digest(path: str) -> str:
    """Digest of the vocabulary file and the version of the library that reads it."""
    library = "sentencepiece" if path.endswith(".model") else "tokenizers"
    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + f"{library} {version(library)}".encode()).hexdigest()


def read_cache(spark: SparkSession, path: str, tokenizer: str) -> DataFrame:
    """``digest, n_tokens`` stored for one tokenizer. A cache that doesn't exist yet is empty.

    Two runs at a time may append the same digest; ``one_per_digest`` settles that. Read without
    an aggregate, so that joins with it can be broadcast by its size or split at a frequent digest.
    """
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        stored = spark.read.schema(CACHE_SCHEMA).parquet(path)
    else:
        stored = spark.createDataFrame([], CACHE_SCHEMA)
    return stored.where(F.col("tokenizer") == tokenizer).select("digest", "n_tokens")


def one_per_digest(cache: DataFrame) -> DataFrame:
    """The cache with one row per digest. Equal contents have equal counts, so any row will do;
    only a cache that two runs have written to at once is stored anew."""
    if cache.groupBy("digest").count().where("count > 1").isEmpty():
        return cache
    return store(cache.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens")), "token-cache-once")


def _distinct_packed(batches: Iterator) -> Iterator:
    """(digest, text) -> (digest, compressed text), each content once per task."""
    import pyarrow as pa
    import zstandard

    pack, seen = zstandard.ZstdCompressor(level=1).compress, set()
    for b in batches:
        out = []
        for digest, text in zip(b["digest"].to_pylist(), b["text"].to_pylist()):
            if digest not in seen:
                seen.add(digest)
                out.append((digest, pack(text.encode())))
        yield pa.record_batch([pa.array([d for d, _ in out], pa.binary()),
                               pa.array([z for _, z in out], pa.binary())], ["digest", "packed"])


def _encode_distinct(path: str):
    def encode(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import zstandard

        from .encode import encoder

        unpack, seen, enc = zstandard.ZstdDecompressor().decompress, set(), encoder(path)
        for b in batches:
            new = {}
            for digest, packed in zip(b["digest"].to_pylist(), b["packed"].to_pylist()):
                if digest not in seen:
                    seen.add(digest)
                    new[digest] = unpack(packed).decode()
            counts = [len(ids) // 4 for ids in enc.ids(list(new.values()))]
            yield pa.record_batch([pa.array(list(new), pa.binary()), pa.array(counts, pa.int64())],
                                  ["digest", "n_tokens"])
    return encode


def count_tokens(docs: DataFrame, tokenizer_path: str, cache_path: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``id, n_bytes, n_tokens``: one row per row of ``docs``. Runs the encoding of the
    misses now and appends their counts to the cache at ``cache_path``.

    * null or empty text: 0 bytes, 0 tokens. Null ids and repeated rows stay as they are.
    * texts of any length are encoded whole. Empty table: no rows, the cache unchanged.
    * a digest that two runs have appended counts once. Other columns of ``docs`` aren't read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    tokenizer = tokenizer_digest(tokenizer_path)
    content = docs.select(F.col(id_col).alias("id"), normal_content(F.col(text_col)).alias("text"))
    content = content.withColumn("digest", F.unhex(F.sha2("text", 256)))
    texts = content.select("digest", "text").mapInArrow(_distinct_packed, "digest binary, packed binary")
    misses = texts.repartition("digest").join(read_cache(spark, cache_path, tokenizer), "digest", "left_anti")
    (misses.mapInArrow(_encode_distinct(tokenizer_path), "digest binary, n_tokens long")
     .withColumn("tokenizer", F.lit(tokenizer)).write.mode("append").partitionBy("tokenizer").parquet(cache_path))
    return (content.select("id", "digest", F.octet_length("text").cast("long").alias("n_bytes"))
            .join(one_per_digest(read_cache(spark, cache_path, tokenizer)), "digest", "left")
            .select("id", "n_bytes", F.coalesce("n_tokens", F.lit(0)).alias("n_tokens")))


def token_count_report(docs: DataFrame, tokenizer_path: str, cache_path: str | None = None,
                       limit: int = 512) -> DataFrame:
    """The contract's digest of ``count_tokens``; without a path the cache starts empty."""
    cache = cache_path or os.path.join(run_folder(docs.sparkSession, "token-cache"), "counts")
    d = count_tokens(docs, tokenizer_path, cache)
    return d.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens",
                    (F.col("n_tokens") > limit).alias("over_limit"))
