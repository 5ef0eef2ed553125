"""The corpus pipeline: from raw documents to packed token sequences.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. ``run`` writes each stage's
documents to the shared folder and reads them again, so a lost executor costs one stage at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.llm import exact, jaccard, packing, suffix, toxicity
from tallyweave.llm.common import numbered, table
from tallyweave.llm.queries import held_out
from tallyweave.sources.staging import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under 0.5, by a classifier fitted on the labels outside the held-out fold."""
    labels = table(spark, sf_dir, "labels").filter(~held_out())
    return toxicity.keep_clean(docs, toxicity.fit(docs, labels))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that agree after lower-casing A-Z, the one with the largest id."""
    return exact.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by a Jaccard similarity of 0.8 or more of their five-word shingles, the one with the smallest id."""
    return jaccard.one_per_component(docs, words=5, num=4, den=5)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without bytes of 50-byte strings that a document with a smaller id has; ``n_chars`` is counted anew."""
    inner, (own_id, own_text, own_count) = numbered(docs, "doc_id", "text", "n_chars")  # a column may have the name of a result
    text = F.when(F.col(own_text).isNotNull(), F.col("_kept_text"))
    done = suffix.without_repeats(inner, length=50, id_column=own_id, text_column=own_text)
    return done.withColumn(own_text, text).withColumn(own_count, F.char_length(own_text).cast("long")).select(*inner.columns).toDF(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of a document lies in the sequences of 4096 tokens."""
    return packing.packed_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("jaccard_join", drop_near_copies),
    ("suffix_array_dedup", cut_repeats),
    ("best_fit_packing", pack),
]

ORACLE_SQL = None  # a trained classifier and a tokenizer have no SQL; tests/llm/test_pipeline.py holds two stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
