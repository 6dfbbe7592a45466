"""From raw documents to packed training sequences: five stages, each over all that the one before it kept.

All stages: a null text is an empty one; an empty table gives no rows; very long texts are read whole; the columns doc_id,
text, lang and source are used, all others come through as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plumbline.llm.common import read
from plumbline.llm.exact_dedup import drop_copies
from plumbline.llm.mixing import apply_mix
from plumbline.llm.near_dedup import drop_near_copies
from plumbline.llm.packing import pack
from plumbline.llm.quality_rules import drop_rejected
from plumbline.llm.queries import tokenizer_path
from plumbline.sources.shared import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or are outliers of their language and source go.

    Null and empty texts have no words and go; null lang or source is a value; repeated rows are judged alike.
    """
    return drop_rejected(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays.

    A null doc_id is smaller than any other; of rows that share text and doc_id, null or not, one stays; null and empty texts are equal.
    """
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id stays.

    A null doc_id is larger than any other; of rows that share the smallest one, one stays; texts without words are
    linked with nothing and all stay.
    """
    return drop_near_copies(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources come to their target weights: rows are repeated or left out.

    A null source is a source of its own, not the empty one; rows that repeat doc_id and text are taken together;
    texts without words have size 0 and may be taken or not.
    """
    return apply_mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents become sequences of power-of-two length.

    Null and empty texts give the end id alone; repeated rows and null doc_ids give pieces of their own.
    """
    return pack(docs, tokenizer_path())


STAGES = [("quality rules", quality_rules), ("exact dedup", exact_dedup), ("near dedup", near_dedup), ("mixing", mixing), ("packing", packing)]

#: The mix samples by a hash and packing tokenizes: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs)
    return docs
