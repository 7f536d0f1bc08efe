"""From raw documents to mixed, tokenised training data: five stages, each an operator of llm.

A NULL text counts as empty in every stage; an empty text is scored like others, is near to nothing,
holds no passage, and the mixture takes none of it. A NULL key is a key. Texts are read whole, of any
length. Of rows that are equal in key and text one passes the second stage, if it has a word. Columns other
than key, text and source are carried as they are, whatever their names. An empty table, or one that a stage
empties, gives empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelog.llm import decontaminate, mil_quality, mixing, near_join
from tablelog.llm.queries import token_digests
from tablelog.llm.storage import Storage, free_name

#: Documents that score less are rejected, as in op10.
LEAST_QUALITY = 0.3
#: Documents are near copies if their shingles of so many words agree to so many percent.
SHINGLE, NEAR = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    model = mil_quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    name = free_name(docs, "quality")
    scored = mil_quality.score(docs, model, name=name)
    return scored.filter(F.col(name) >= LEAST_QUALITY).drop(name)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, by five words and 0.8: the one with the smallest id."""
    return near_join.deduplicated(docs, k=SHINGLE, percent=NEAR)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture of sources takes it."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the documents, and what they hold of each."""
    return token_digests(docs)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", benchmark),
    ("mixing sources", mix),
    ("token files", tokens),
]

#: SQL has neither the classifier nor the tokenizer; tests hold the pipeline against plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``; each one's result is written and read again."""
    storage = Storage(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = storage.table(stage(spark, docs, sf_dir), f"stage-{number}")
        if number > 1:
            storage.drop(f"stage-{number - 1}")
    return docs
