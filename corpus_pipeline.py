"""Corpus pipeline: raw documents to packed training sequences, stage after stage.

Each stage takes (spark, docs, sf_dir), works on everything its predecessor kept, and all but the last return the
columns of documents. Null ids and texts, empty tables, repeated rows and extra columns are treated as each operator's
docstring defines.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellscope.llm import decontaminate, line_minhash, minhash_hamming, pack_ffd, toxicity_knn
from cellscope.llm.common import table
from cellscope.session import ensure_checkpoint_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled examples call toxic go."""
    return toxicity_knn.remove_toxic(docs, table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines are taken out of the texts; n_chars follows, and a document left without text goes."""
    clash = {c: f"given_{c}" for c in ("n_lines", "n_kept") if c in docs.columns}
    found = line_minhash.dedup_lines(docs.withColumnsRenamed(clash))
    n = F.length("text").cast(dict(docs.dtypes)["n_chars"]) if "n_chars" in docs.columns else None
    emptied = (F.col("n_kept") < F.col("n_lines")) & (F.length(F.trim("text")) == 0)
    found = found.where(~F.coalesce(emptied, F.lit(False)))
    found = found.withColumn("n_chars", F.when(F.col("n_kept") < F.col("n_lines"), n).otherwise(F.col("n_chars"))) if n is not None else found
    return found.select(*[F.col(clash.get(c, c)).alias(c) for c in docs.columns])


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return minhash_hamming.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left is tokenized and packed into sequences; one row per piece."""
    return pack_ffd.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("minhash_dedup", dedup_documents),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: SQL can express neither the neighbours' votes nor the tokenizer; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each stage's rows are written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex[:12]}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
