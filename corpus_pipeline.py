"""A corpus pipeline of five stages: each gets the rows that its predecessor kept, written as Parquet and read again.

All stages but the last return the columns of ``documents``. Rows with a null id pass the grouping stage, as they
can't be grouped; rows that repeat an id count as one document there and all stay or go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curiospark.llm import bpe, decontaminate, near, quality, substrings
from curiospark.llm.shared import keep, table
from curiospark.llm.token_files import tokenizer_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    scored = quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")), docs.columns)
    return scored.where(quality.accepted()).select("carried.*")


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the smallest id stays."""
    gone = near.near_groups(docs).where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in repeats of earlier passages go; documents of which nothing is left stay, empty."""
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    changed = substrings.dedup_substrings(docs, others)
    own = {"doc_id": F.col("doc_id").cast(docs.schema["doc_id"].dataType), "text": F.col("kept")}
    if "n_chars" in others:
        own["n_chars"] = F.length("kept").cast(docs.schema["n_chars"].dataType)
    return changed.select(*(own.get(c, F.col("carried")[c]).alias(c) for c in docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of any benchmark item go."""
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), carry=docs.columns)
    return found.where("n_hit = 0").select("carried.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the number of tokens, and digests of the ids and of the text decoded from them."""
    return bpe.digests(bpe.encode_decode(docs, tokenizer_path("word_bpe_49k.json")))


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", keep_one_of_near_copies),
    ("substring dedup", remove_repeated_passages),
    ("benchmark decontamination", drop_contaminated),
    ("BPE encoding and decoding", encode),
]

#: The classifier and the tokenizer aren't SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
