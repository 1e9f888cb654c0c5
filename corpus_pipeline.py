"""From raw documents to packed sequences: quality rules, line dedup, near-dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``documents``.  ``run`` writes each stage's result to the
shared folder and reads it back as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm import line_dedup, mixing, packing, quality_rules, simhash
from tripmart.llm.common import staged, table


def _documents(df: DataFrame, like: DataFrame) -> DataFrame:
    """``df`` with the columns of ``like``; n_chars follows the text."""
    if "n_chars" in like.columns:
        df = df.withColumn("n_chars", F.length("text").cast(dict(like.dtypes)["n_chars"]))
    return df.select(*[F.col(f"`{c}`") for c in like.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass their base rules and whose host is not rejected."""
    return quality_rules.keep_good_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the lines that an earlier one has, exactly or nearly."""
    return _documents(line_dedup.dedup_lines(docs, report=False), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class."""
    return simhash.keep_one_per_class(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in token sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_duplicates),
    ("source_mixing", mixture),
    ("packing", packed),
]

# Edit-distance joins, XXH64 fingerprints and tokens are beyond SQL; tests/llm/test_pipeline.py runs the chain by hand.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
