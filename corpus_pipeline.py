"""From raw documents to packed training sequences, one written stage after the other.

All stages but the last return rows of their input as they are, columns of any name included. An
empty table gives an empty one. NULL texts count as empty ones. Rows without an id are scored and
compared like others, but the near-duplicate stage keeps them all; rows that share an id share
its fate there. What each stage does with such rows is said beside it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripweave.llm import exact_dedup, language_id, ngram_join, packing, quality
from tripweave.llm.common import table, written
from tripweave.llm.queries import language_samples, quality_model, word_bpe


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules predict to be of quality 1 stay. Empty and NULL texts are
    scored like others; equal texts have equal scores."""
    return quality.keep_good(docs, quality_model(spark, docs, sf_dir))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language stay; those without a letter go, NULL and empty ones among
    them, and those that every learned language needs more than 5 bits a symbol for."""
    return language_id.keep_known(docs, language_samples(docs))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal without white space stays: the longest,
    then the one of smallest id; a row without id only where no other has one. Of rows that are
    equal in id and text one stays."""
    return exact_dedup.drop_duplicates(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked on five-word shingles at 0.8 or more, the one of smallest id stays.
    Texts without words are linked with nothing and stay."""
    return ngram_join.keep_one_of_each(docs, ngram_join.ngram_classes(docs, width=5, percent=80))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2,048 tokens with their place in training sequences. NULL and empty texts
    are their end alone; every row is a document of its own."""
    return packing.pack(docs, word_bpe(), capacity=2048, end_id=0)


STAGES = [
    ("quality classifier", quality_stage),
    ("language ID", language_stage),
    ("exact dedup", exact_stage),
    ("n-gram Jaccard join", near_stage),
    ("best-fit packing", packing_stage),
]

#: The classifiers are trained and packing follows an encoder: SQL cannot express them. Tests
#: compare stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents table; each reads what the one before has written."""
    docs = table(spark, sf_dir, "documents")
    *before, (_, last) = STAGES
    for name, stage in before:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return last(spark, docs, sf_dir)
