"""From raw documents to packed sequences: rules, near duplicates, secrets, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. Null
and empty texts fail the quality rules, so later stages see text only; an empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwork.llm import jaccard, mixing, packing, quality, secrets
from leafwork.llm.common import materialize, table, word_count


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that policy v1 accepts, with their columns; a null or empty text fails, repeated rows are judged each."""
    return quality.keep_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 5-word shingles at a similarity of 0.8 or more: the smallest doc_id.

    Rows without words or without doc_id stay; rows of one doc_id with different texts are judged by their texts.
    """
    return jaccard.keep_one(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in the text replaced by a mark.

    Null and empty texts stay as they are, repeated rows are scanned each, other columns stay whatever their names.
    """
    return secrets.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, with its columns as they are.

    A null text has size 0; a null source is one source, the last. Which of repeated rows gets the extra copy is
    arbitrary, how many do is not. An empty table stays empty.
    """
    return mixing.copied(docs, word_count(F.col("text")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of at most 2048 ids.

    A null or empty text is one piece of the id 0; repeated rows are packed each; columns besides doc_id and text are
    not read. An empty table gives no pieces.
    """
    return packing.pack(packing.token_pieces(docs))


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("secret scan", secret_scan),
    ("source mix", source_mix),
    ("packing", pack_sequences),
]

#: The shingle hashes, the Markov scan and the tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; what a stage returns is stored and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs, name.replace(" ", "-"))
    return docs
