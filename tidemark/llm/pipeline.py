"""The stages from documents to token ids; each is one of the operators of this package.

A stage takes (spark, docs, folder of the tables) and works on all its predecessor kept.
All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import jaccard, mixing, quality, tiling, tokenids
from tidemark.llm.queries import remainder, tokenizer_path
from tidemark.llm.store import written
from tidemark.session import scratch_folder
from tidemark.sources.tables import read_table


def keep_quality(spark: SparkSession, docs: DataFrame, sf: str) -> DataFrame:
    """Documents that the rules score 0.5 or more."""
    model = quality.train(docs, read_table(spark, sf, "labels"), "quality", remainder(3) != 1)
    scored = quality.scored(docs.select(F.struct(*docs.columns).alias("doc"), "text"), model)
    return scored.filter("score >= 0.5").select("doc.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf: str) -> DataFrame:
    """One document of each group that shares 80 % of its shingles of five words."""
    return jaccard.representatives(docs, size=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf: str) -> DataFrame:
    """Documents that hold no test item."""
    return tiling.clean(docs, read_table(spark, sf, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf: str) -> DataFrame:
    """The mix of sources by weight; a document comes as often as the mix takes it."""
    return mixing.mix(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) read back from the files of ids."""
    path = scratch_folder(spark, "pipeline-ids")
    tokenids.write(docs, path, tokenizer_path())
    return tokenids.read(spark, path, with_ids=False)


STAGES = [
    ("quality_classifier", keep_quality),
    ("jaccard_join", drop_near_copies),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("token_ids", token_ids),
]

# The classifier's score is not to be had in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf)
