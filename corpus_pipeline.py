"""A training corpus from the table documents, in stages that each work on what the last one kept.

The stages return the columns of documents, the last one the packing plan of what is left:
quality classifier, near-duplicate removal, removal of repeated substrings, benchmark
decontamination, packing. Rows may share a doc_id or have none, tables may be empty, and columns that
the operators would name alike are kept; see the stages. SQL can't express the stages that learn or match approximately, so
ORACLE_SQL is None and tests hold each stage against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docloom.llm import decontam, minhash, packing, quality, suffix_dedup
from docloom.llm.common import durable

ORACLE_SQL = None


def _quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier scores at 0.3 or more, learned from this stage's labelled rows; null and empty texts have the model's bias."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def _near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8); texts without words, null and empty ones all stay."""
    return minhash.drop_near_duplicates(docs)


def _repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row, its text without the bytes that a 100-byte string covers which also starts earlier; null texts become empty."""
    return suffix_dedup.without_repeats(docs)


def _decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item; null, empty and wordless texts hold none."""
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def _pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packing plan of all rows that are left; a null or empty text has 0 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality", _quality),
    ("near_duplicates", _near_duplicates),
    ("repeats", _repeats),
    ("decontaminate", _decontaminate),
    ("pack", _pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. Between stages, rows are written to the shared checkpoint folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
