"""The corpus pipeline: documents in, places in training sequences out; each stage is stored and read again."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, jaccard, langid, lines, packing
from tidemark.session import checkpoint_dir

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# A text whose best language contains fewer of its n-grams is of no learned language.
LEAST_SCORE = 0.3
CAPACITY = 4096


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a learned language; texts without letters or of none of the languages go. Extra columns go too."""
    marked = docs.select(*COLUMNS)
    model = langid.fit(marked.where(~langid.held_out(F.col("doc_id"))))
    judged = langid.predict(marked, model)
    return judged.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that an earlier one holds; n_chars follows the text."""
    kept = lines.dedup_lines(docs.select(*COLUMNS))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles link at 0.8, the smallest doc_id; documents without words are in no group."""
    groups = jaccard.jaccard_components(docs, width=5, percent=80)
    gone = groups.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.select(*COLUMNS).join(gone, "doc_id", "left_anti").select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    marked = decontaminate.mark_leaks(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return marked.where(~F.col("contaminated")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per piece of each document its place in a sequence of at most 4096 tokens."""
    found = packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1, capacity=CAPACITY)
    return packing.best_fit_pack(found, CAPACITY)


STAGES = [
    ("language", language),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("pack", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        made = stage(spark, docs, sf_dir)
        made.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(made.schema).parquet(f"{folder}/{name}")
    return docs
