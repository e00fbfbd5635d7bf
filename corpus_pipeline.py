"""A corpus pipeline: quality rules, near duplicates, benchmark copies, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next one's ``docs``. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tablewright.llm import decontaminate, neardup, packing, quality, secrets
from tablewright.llm.common import fresh, prepared, table
from tablewright.session import materialize


def _joined(docs: DataFrame, verdicts: DataFrame, how: str) -> DataFrame:
    """``docs`` joined to the (doc_id, text_hash) of ``verdicts``, null ids included."""
    its_id, its_hash = fresh(docs, "_its_id", "_its_hash")
    side = verdicts.select("doc_id", "text_hash").distinct().toDF(its_id, its_hash)
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(its_id)) & (F.xxhash64("text") == F.col(its_hash))
    return docs.join(side, same, how).select(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or lie far from their source go."""
    verdicts = quality.verdicts(prepared_docs(spark, docs))
    return _joined(docs, verdicts.filter(~F.col("kept")), "left_anti")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: that with the smallest id."""
    groups = neardup.linked(prepared_docs(spark, docs))
    kept = _joined(docs, groups.filter("kept"), "left_semi")
    # rows that repeat id and text are one document
    (nth,) = fresh(docs, "_nth")
    own = F.col("doc_id").cast("long"), F.xxhash64("text")
    rank = F.row_number().over(Window.partitionBy(*own).orderBy(*own))
    return kept.withColumn(nth, rank).filter(F.col(nth) == 1).select(*docs.columns)


def benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a copy of a test item go."""
    found = decontaminate.contaminated(prepared_docs(spark, docs), table(spark, sf_dir, "benchmark"))
    return _joined(docs, materialize(found, "contaminated"), "left_anti")


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are replaced by a mark; ``n_chars`` follows the text."""
    length = "n_chars" if "n_chars" in docs.columns else None
    return secrets.redacted(prepared_docs(spark, docs), length_col=length)


def best_fit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents in sequences of at most 2048 tokens."""
    return packing.packed(prepared_docs(spark, docs))


def prepared_docs(spark: SparkSession, docs: DataFrame) -> DataFrame:
    prepared(spark)
    return docs


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_copies),
    ("secret scans", secret_scan),
    ("best-fit packing", best_fit),
]

# Near duplicates, alignment and packing have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents, each one's result written and read again."""
    docs = table(prepared(spark), sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, name.replace(" ", "-"))
    return docs
