"""A corpus pipeline over ``documents``: quality, exact copies, near copies, mixing, packing.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept, and returns the
columns of documents; the last returns the packed pieces. What a stage returns is written as Parquet and
read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locus.llm import exact_dedup, jaccard_join, mixing, packing, quality
from locus.llm.common import in_written_order, table, whole, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are likelier good than bad stay, repeated rows each; a null text counts as empty."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (null: empty) the row with the largest doc_id stays; of rows that repeat its id, the
    least in the order of their columns. A null id is the smallest. Column names may be any."""
    kept = exact_dedup.exact_dedup(docs, keep="max").filter("kept").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col("doc_id").alias("__of"), F.sha2(whole(), 256).alias("__sha256"))
    same = F.col("__of").eqNullSafe(F.col("__id")) & (F.col("__sha256") == F.col("__sha"))
    return rows.join(kept, same, "left_semi").groupBy("__of", "__sha256").agg(F.min("__row").alias("__row")).select("__row.*")


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are linked by similar word n-grams the row with the smallest doc_id stays, one row
    where it is repeated; rows are told apart by id and text, null ids too."""
    return jaccard_join.without_near_copies(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mixture: of files, and of rows in them, which packing reads. Null
    sources are a source, repeated rows stay."""
    return mixing.mixed(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences, whose numbers follow the order of the mixture."""
    return packing.pack_documents(in_written_order(docs), packing.default_tokenizer(), place_col="__place")


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("n-gram Jaccard join", near_stage),
    ("mixing sources", mixing_stage),
    ("best-fit packing", packing_stage),
]

#: Compressed sizes, MinHash and a genetic search have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)
