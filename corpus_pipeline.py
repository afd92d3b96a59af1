"""A training-corpus pipeline: five stages, each written as Parquet and read by the next.

``STAGES`` lists (name, function); a function takes the session, the documents
its predecessor kept and the folder of the input tables.  All stages but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsfold.llm import decontaminate, neardup, packing, repeats, toxicity
from opsfold.llm.frames import documents, free_name, prepare, shared_folder

#: No SQL: classifiers, min-hashing and tokenizers have none; tests use plain versions.
ORACLE_SQL = None
# Workers of this stage have served those before it, so its cache is a small one.
PACK_CACHE_PIECES = 100_000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain, trained on the label table, finds toxic go."""
    prepare(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    chain = toxicity.train(docs, labels, toxicity.label_categories())
    return toxicity.below(docs, chain, "toxic")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays."""
    prepare(spark)
    return neardup.deduplicated(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of strings that start earlier go; documents left without text go too."""
    prepare(spark)
    had = free_name("__had", docs)
    cut = repeats.without_repeats(docs.withColumn(had, F.length("text") > 0))
    left = cut.filter(~F.col(had) | F.col(had).isNull() | (F.length("text") > 0)).drop(had)
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    prepare(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequence and offset."""
    prepare(spark)
    return packing.pack(docs, cache_pieces=PACK_CACHE_PIECES)


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates),
          ("repeated_bytes", cut_repeats), ("decontamination", drop_contaminated),
          ("packing", pack_sequences)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = shared_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
