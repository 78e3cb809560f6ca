"""A training-data pipeline over `documents`: each stage works on all its predecessor kept.

Documents that the quality classifier rejects go; lines that repeat an earlier one go; of each group
of near duplicates the document with the smallest id stays; documents that quote a benchmark item go;
the rest is packed into sequences of token ids. All stages but the last return the columns of
`documents`. run() hands one stage's rows to the next through a table in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import decontamination, line_dedup, packing, quality, simhash_dedup
from orderloom.llm.shared import handover, prepare


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, _table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    left = line_dedup.drop_repeated_lines(docs)
    kind = dict(docs.dtypes).get("n_chars")
    if kind is None:
        return left
    size = F.coalesce(F.char_length("text").cast(kind), F.col("n_chars"))
    return left.withColumn("n_chars", size)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return simhash_dedup.keep_one_each(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their place; ids are kept as little-endian unsigned 32-bit numbers."""
    prepare(spark)
    return packing.packed(docs).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", benchmark_stage),
    ("packing", packing_stage),
]

#: Classifier scores, fingerprints and token ids are beyond SQL. No test holds run() against plain
#: Python yet; line dedup, SimHash, decontamination and packing have such tests of their own.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = handover(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
