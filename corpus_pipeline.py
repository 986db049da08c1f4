"""The corpus pipeline: documents -> packed training sequences.

Each stage is a function (spark, docs, sf_dir) -> DataFrame on all that the
stage before it kept; between stages the rows are written as Parquet to the
shared folder and read again.

1. toxicity: rows that score 0.5 or more go.
2. line_dedup: repeated lines go from the texts; n_chars follows.
3. jaccard_join: of each component of near duplicates the smallest doc_id stays.
4. decontamination: rows that hold a benchmark item go.
5. packing: the kept texts as pieces in sequences of 4096 tokens.

Rows with a null doc_id are never near duplicates. Of rows that share a
doc_id one stays in stage 3, the one with the smallest hash of all its columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.llm import decontaminate, jaccard_join, line_dedup, packing, toxicity
from meterflow.llm.common import keep, small_batches, table

#: SQL cannot express the toxicity model or the packing: see tests/llm.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    out = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    found = jaccard_join.near_duplicates(docs)
    stay = found.filter(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    kept = docs.join(keep(stay, "stay"), "doc_id", "left_semi")
    return one_of_each_id(kept).select(*docs.columns).unionAll(docs.filter("doc_id IS NULL"))


def one_of_each_id(docs: DataFrame) -> DataFrame:
    """Of rows that share a doc_id the one with the smallest hash of all columns
    (rows equal in all are one row). Only rows of repeated ids are shuffled."""
    whole = F.xxhash64(*[F.col(c) for c in docs.columns])
    repeated = keep(docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("__n"), F.min(whole).alias("__least")).filter("__n > 1"), "repeated-ids")
    if repeated.isEmpty():
        return docs
    some = docs.join(repeated.select("doc_id", "__least"), "doc_id").filter(whole == F.col("__least")).dropDuplicates(["doc_id"])
    return docs.join(repeated, "doc_id", "left_anti").unionByName(some.select(*docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return packing.pack_documents(docs, lasting=False)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("jaccard_join", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = keep(docs, f"stage-{name}")
    return docs
