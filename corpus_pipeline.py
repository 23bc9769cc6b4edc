"""Corpus pipeline: five training-data operators in sequence over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes
each stage's rows as Parquet into the shared checkpoint folder and reads them
again as the next one's ``docs``. All stages but the last return the columns of
``documents``:

1. ``toxicity`` drops the documents that its classifier predicts toxic;
2. ``near_duplicates`` keeps the smallest id of each group of documents whose sets
   of five-word shingles have a similarity of 0.8 or more;
3. ``secrets`` masks found secrets in the texts (``n_chars`` follows);
4. ``mix`` chooses rows to target weights, a row for each epoch it is in;
5. ``encode`` returns ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

Null and empty texts are not toxic, have no duplicates and no secrets; the mix
takes no document without words. Very long texts go through whole. Rows that repeat id
and text stay or go together in every stage; where one id has several texts, each is
judged by itself. Ties are settled as the operators say (a score of the threshold is
toxic, a similarity of the threshold a duplicate). Columns beyond those of ``documents``
pass the first four stages, whatever their names. Empty tables give no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnel_engine.llm.common import collected, shuffles_freed, table
from funnel_engine.llm.minhash_dedup import drop_near_duplicates
from funnel_engine.llm.mixing import document_levels, mix, n_words
from funnel_engine.llm.secret_scan import redact
from funnel_engine.llm.sentencepiece_codec import encoding_digests
from funnel_engine.llm.toxicity import drop_toxic, train
from funnel_engine.session import checkpoint_dir, delete_at_exit, delete_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, train(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact(docs).withColumn("n_chars", F.coalesce(F.length("text").cast("bigint"), "n_chars"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs, document_levels(), n_words(F.col("text"))).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encoding_digests(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mix", mixed),
    ("encode", encode),
]

#: SQL can express neither the trained models nor the encoder; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{name}-{uuid.uuid4().hex}"
        with collected(spark):
            out = stage(spark, docs, sf_dir)
            with shuffles_freed(spark):
                out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if before is not None:  # nothing reads the stage before any more
            delete_path(spark, before)
        before = path
    delete_at_exit(spark, before)
    return docs
