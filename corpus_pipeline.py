"""A training-data pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir), works on all rows that the one before kept and returns a DataFrame;
all but the last return the columns of ``documents``. ``run`` writes every stage's result as Parquet in the
shared folder and reads it back as the input of the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isohyet.llm import common, decontamination, packing, quality, simhash, suffixes


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity under trusted text, or whose likeness to flagged text, is out of range go."""
    common.ship(spark)
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles 0.8 alike, or fingerprints within 3 bits) the document with the smallest id stays."""
    common.ship(spark)
    return simhash.drop_near_duplicates(docs)


def repeated_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 50 bytes that a document with a smaller id has too are cut out; every document stays."""
    common.ship(spark)
    others = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    named = docs.withColumnsRenamed({c: f"__own_{k}" for k, c in enumerate(others)})  # whatever their names, results don't clash
    cut = suffixes.remove_substrings(named, carry=tuple(f"__own_{k}" for k in range(len(others))))
    own = {"doc_id": F.col("doc_id"), "text": F.col("text"), "n_chars": F.char_length("text").cast("long")} | {c: F.col(f"__own_{k}") for k, c in enumerate(others)}
    return cut.select(*(own[c].alias(c) for c in docs.columns))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark windows on a twentieth of their words or more go."""
    common.ship(spark)
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of power-of-two lengths, 1024 at most."""
    common.ship(spark)
    return packing.pack_documents(docs, with_ids=True)


STAGES = [
    ("quality classifier", quality_classifier),
    ("near duplicates", near_duplicates),
    ("repeated substrings", repeated_substrings),
    ("benchmark decontamination", benchmark_decontamination),
    ("packing", pack),
]
#: SQL can't say the fingerprints, the model or the tokens; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        kept = common.materialise(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
        if hasattr(docs, "_isohyet_path"):  # the table of the stage before has been read for the last time
            common.discard(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
