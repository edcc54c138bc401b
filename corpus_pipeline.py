"""Corpus pipeline: toxic and poor documents go, near duplicates go but one of
each group, benchmark documents go, the rest is packed into sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdscope.llm import decontam, kneser, minhash, packing, toxicity
from crowdscope.llm.common import land, table
from crowdscope.llm.queries import BYTE_BPE


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the limit, by what all labels teach."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), F.lit(True))
    out, name = toxicity.score(docs, model)
    return out.where(F.col(f"{name}.predicted") == 0).select(*docs.columns)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within their language's limit on perplexity."""
    out, name = kneser.judge(docs, table(spark, sf_dir, "labels"))
    return out.where(f"{name}.good").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class: that of the smallest doc_id."""
    return minhash.drop_duplicates(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark text."""
    out, name = decontam.find_benchmark(docs, table(spark, sf_dir, "benchmark"))
    return out.where(F.col(f"{name}.n_hit") == 0).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all remaining documents in sequences of 2048 tokens."""
    return packing.pack(docs, BYTE_BPE, 2048)


STAGES = [("toxicity", drop_toxic), ("quality", drop_poor), ("near_duplicates", drop_near_duplicates),
          ("decontamination", drop_benchmark), ("packing", pack)]

#: No SQL can express the trained stages, nor near duplicates; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = land(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
