"""A training corpus from raw documents: language, exact copies, near copies, mixture, tokens.

Each stage is a function of (spark, docs, sf_dir) that works on all rows of the stage before, which are written as
Parquet and read again in between. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import bpe, exact, jaccard, langid, mixing
from tillroll.llm.common import table, work_folder

#: Fixed value: the vocabulary of the last stage.
VOCABULARY = "byte_bpe_50k.json"
#: Most languages that the labels may name.
LANGUAGES = 4096


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents written in some language, with the predicted one as their ``lang``; the model is learned from those of
    them that are labelled. Null and empty texts, and those without a letter, go; without labels all go. Rows that repeat
    are judged alike; an empty table stays empty."""
    model = langid.learn(docs.where(~langid.held_out(F.col("doc_id"))), LANGUAGES)
    return langid.keep_languages(docs, model, into="lang")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: that of the largest id. Null counts as empty; of rows that repeat id and
    text one stays; a null id stays only where its group has no other."""
    return exact.drop_exact_duplicates(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the smallest id. Texts without words and rows without an id stay."""
    return jaccard.drop_near_duplicates(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them: a row for each time, none for some. A null text has no words and
    is not taken; a null source is one of its own; rows that repeat are taken alike."""
    return mixing.mixed(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of ids of each text, and digests of them and of what they decode to. Null counts as empty."""
    import public_tokenizers

    return bpe.round_trip(docs, public_tokenizers.path(VOCABULARY), keep=["doc_id", "lang", "source"])


STAGES = [
    ("language ID", language),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("mixing sources", mixture),
    ("BPE encoding", encoding),
]

#: SQL can't state a language model, so run() is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between goes to the folder that the session's jobs share."""
    folder = f"{work_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
    return docs
