"""From documents to packed training sequences, in five stages.

Each stage takes the documents that the one before kept, and all but the last
return the columns of documents, whatever others there are. Every stage judges
a row by its text: ids may be null or repeated, null and empty texts pass, long
ones count whole, and empty tables, labels and benchmark too, give what they
can. Only the second stage looks at ids, to say which of several rows stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.llm import decontaminate, durable, near_dedup, packing, pii, queries, toxicity
from tallyweave.shipping import ship

#: The stages' chain can't be put in SQL: a trained model and a tokenizer take part.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half; with no labels to learn from, all of them."""
    ship(spark)
    return toxicity.below(docs, queries.toxicity_model(spark, docs, sf_dir), 0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of the smallest id, of each group whose sets of five-word shingles are linked at 0.8 or more.

    Of rows alike in id and text one stays; rows without a word all do.
    """
    ship(spark)
    return near_dedup.one_of_each(docs, words=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage; equal texts share their fate."""
    ship(spark)
    return decontaminate.without_passages(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=decontaminate.WINDOW)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with pseudonyms in their texts; n_chars follows."""
    ship(spark)
    return pii.pseudonymise_rows(docs, queries.pseudonym_key(spark)).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens and the sequence each has its place in."""
    ship(spark)
    return packing.pack_documents(docs, queries.tokenizer_path(), size=2048)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("pii", replace_personal_data),
    ("pack", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each one's rows are written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = durable.rewritten(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
