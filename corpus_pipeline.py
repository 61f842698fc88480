"""The corpus pipeline: quality rules, near duplicates, decontamination,
mixing and token files, each on what the stage before it kept.

``run`` writes every stage's result as Parquet to the shared folder and reads
it as the next one's documents, so a lost executor costs tasks of one stage.
All stages but the last return the columns of ``documents``; the last returns
the documents of the token files.  Mixing may take a document several times:
it then stands as often in the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from equiframe.llm import decontam, jaccard, mixing, quality, token_files
from equiframe.llm.queries import END_ID, word_tokenizer
from equiframe.llm.shared import ship_package, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and their language's histograms accept."""
    ship_package(spark)
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of the n-gram Jaccard join."""
    ship_package(spark)
    return jaccard.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of ``benchmark``."""
    ship_package(spark)
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    ship_package(spark)
    return mixing.repeat(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix; one row per document in them."""
    ship_package(spark)
    return token_files.read(spark, token_files.write(docs, word_tokenizer(), END_ID))


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("source_mix", source_mix), ("token_output", token_output)]

#: Hash shingling, the trained references and the tokenizer are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, str(sf_dir)), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, str(sf_dir))
