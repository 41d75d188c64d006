"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the
last return the columns of documents. A text without words fails the quality rules, so nulls in
``text`` end there; nulls elsewhere, repeated rows and empty tables go through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderloom.llm import line_dedup, mixing, packing, quality_rules, simhash_dedup
from orderloom.llm.queries import tokenizer_path, with_length
from orderloom.llm.work import stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the repetition rules."""
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that many sites share; ``n_chars`` follows the text."""
    return with_length(line_dedup.remove_boilerplate(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash_dedup.keep_one(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out to reach the weights of their sources, in random order."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences; copies of a document are packed one by one."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("simhash near-dedup", near_duplicates),
    ("source mixing", mixture),
    ("packing", packed),
]

#: Word hashes, tokenizer ids and the suffix order have no SQL form; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents; every stage is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, function) in enumerate(STAGES, 1):
        docs = function(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = stage(docs, f"pipeline-{number}")
    return docs
