"""Token counts through a digest cache.

A count depends on the text and the tokenizer only, so it is stored under the
SHA-256 of the normalised text together with the digest of the tokenizer file.
Counting joins the texts' digests to the stored counts, then fetches and encodes each
distinct missing text once and appends the new counts to the cache. With no misses no text
moves, with few of them only theirs. Normalisation here
only maps null to the empty text: any other change could change the count.

Empty and null texts count as 0 tokens. Repeated rows and equal texts share one
cache entry; each input row gives one output row. Very long texts are encoded whole. An
empty table gives an empty result and leaves the cache as it was. Only the id and text
columns are read, so further columns may have any name.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from funnel_engine.session import checkpoint_dir

from .common import map_columns, shuffles_freed, stored, table, texts
from .sentencepiece_codec import model_path

#: So many missing digests of 32 bytes are broadcast, so that only their texts move; of more, all texts do.
FEW_MISSES = 50_000

CACHE_SCHEMA = "text_digest binary, tokenizer string, n_tokens bigint"


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    """Counts of a batch of texts by the library that the file belongs to; the ids of one text at a time are held."""
    if path.endswith(".model"):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda batch: [len(sp.encode(x)) for x in batch]
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return lambda batch: [len(tok.encode(x, add_special_tokens=False)) for x in batch]


def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def text_digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def read_cache(spark: SparkSession, cache_dir: str, tokenizer: str) -> DataFrame:
    """Stored counts of one tokenizer version; none if nothing has been stored there yet."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(cache_dir)
    there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    df = spark.read.schema(CACHE_SCHEMA).parquet(cache_dir) if there else spark.createDataFrame([], CACHE_SCHEMA)
    # Two runs that miss the same text at the same time store it twice, with the same count.
    return df.where(F.col("tokenizer") == tokenizer).select("text_digest", "n_tokens").dropDuplicates(["text_digest"])


def append_misses(docs: DataFrame, cache_dir: str, path: str, tokenizer: str, text_col: str = "text") -> None:
    """Encode each distinct text of ``docs`` that the cache lacks, once, and append its count."""

    def make():
        count = _tokenizer(path)
        return lambda digests, bodies: [digests, [tokenizer] * len(digests), count(bodies)]

    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = docs.select(text_digest(text).alias("text_digest"), text.alias("text"))
    # Digests first: texts that the cache has are never moved.
    cached = read_cache(spark, cache_dir, tokenizer).select("text_digest")
    misses = stored(found.select("text_digest").distinct().join(cached, "text_digest", "left_anti"), "token-count-misses")
    n = misses.count()
    if not n:
        return
    few = n <= FEW_MISSES
    if few:
        found = found.join(F.broadcast(misses), "text_digest", "left_semi")
    # any_value keeps one copy of a text per map task before the shuffle, so copies of one text never meet in number.
    missing = found.groupBy("text_digest").agg(F.any_value("text").alias("text"))
    if not few:
        missing = missing.join(misses, "text_digest", "left_semi")
    with shuffles_freed(spark):
        map_columns(missing, make, CACHE_SCHEMA, 64).write.mode("append").parquet(cache_dir)


def token_counts(
    docs: DataFrame,
    path: str | None = None,
    cache_dir: str | None = None,
    limit: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of each row's whole text.

    ``cache_dir`` is a shared folder; the default lies under the session's checkpoint folder.
    """
    spark = docs.sparkSession
    path = path or model_path()
    cache_dir = cache_dir or f"{checkpoint_dir(spark).rstrip('/')}/token-counts"
    version = tokenizer_digest(path)
    append_misses(docs, cache_dir, path, version, text_col)
    rows = texts(docs, id_col, text_col).select(
        "doc_id",
        F.octet_length("text").cast("long").alias("n_bytes"),
        text_digest(F.col("text")).alias("text_digest"),
    )
    return rows.join(read_cache(spark, cache_dir, version), "text_digest", "left").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
