"""From raw documents to packed training sequences, in stages.

Each stage takes all documents that the one before it kept; its result is
written as Parquet and read again for the next.  All but the last return the
columns of the documents.

Defined results: a null text is empty; an empty table gives no rows in any stage;
other columns, whatever their names, are carried along; nothing is read from them.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from texlode.llm.exact_dedup import drop_copies
from texlode.llm.near_dedup import drop_near
from texlode.llm.packing import pack_documents
from texlode.llm.quality_rules import keep_passing
from texlode.llm.substring_dedup import without_later
from texlode.llm.workers import reach
from texlode.plans.physical import new_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules on length and repetition.

    Each row is judged by its own text, so repeated rows stay or go together; null
    and empty texts have no words and go; very long texts are judged whole.
    """
    reach(spark)
    return keep_passing(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the one with the smallest id; null ids come after all others.

    Of repeated rows (equal id and text) one stays.
    """
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, similarity 0.8), the one with the smallest id.

    Texts without words are near nothing; rows that share an id but not a text are
    compared like others; of a group without ids, one set of words stays.
    """
    reach(spark)
    return drop_near(docs, percent=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the windows of 20 words that occurred earlier, by id and then place; null ids are first.

    A text that loses nothing stays as it is; of repeated rows none is earlier.
    """
    reach(spark)
    return without_later(docs, width=20)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 1024 tokens.

    Every row is packed, repeated ones and null ids too; an empty text is its end token.
    """
    reach(spark)
    return pack_documents(
        docs,
        vocabulary=public_tokenizers.path("byte_bpe_50k.tiktoken"),
        tokenizer=public_tokenizers.path("byte_bpe_50k.json"),
        end_id=0,
        capacity=1024,
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("packing", packing),
]

# SQL cannot express byte-level BPE and packing, so not the rows of the last stage either.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents; the result of the last one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
