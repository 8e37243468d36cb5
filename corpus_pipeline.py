"""A cleaning pipeline for a text corpus: five stages, each written and read again by the next.

The quality classifier drops what it rejects, the n-gram Jaccard join keeps one document of each group, benchmark
decontamination drops documents that hold an item, the secret scan replaces what it finds, and packing cuts the rest
into sequences. Every stage but the last returns the columns of its documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.llm import decontaminate, ngram_join, packing, quality_crf, secret_scan
from hourgrid.llm.ship import bound_batches, ship_package
from hourgrid.session import delete, job_scratch, scratch_path, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    ship_package(spark)
    bound_batches(spark)
    labels = quality_crf.clear_labels(spark.read.parquet(f"{sf_dir}/labels.parquet"), "quality")
    labels = labels.where(~quality_crf.held_out(F.col("doc_id"), 3, 1))
    model = quality_crf.fit(docs, labels)
    return quality_crf.score(docs, model).where("score >= 0.5").select(docs.columns)


def with_rows(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a key of each row, and its name; stored, so that the keys stay what they are.

    Null and repeated doc_ids do not tell rows apart.
    """
    key = "row"
    while key in docs.columns:
        key += "_"
    return stored(docs.withColumn(key, F.monotonically_increasing_id()), "rows"), key


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is linked by sets of five-word shingles of similarity 0.8 or more.

    The one with the least doc_id stays, null last; of several rows with one doc_id any one. Rows without a word stay.
    """
    ship_package(spark)
    bound_batches(spark)
    rows, key = with_rows(docs)
    groups = ngram_join.near_groups(rows.select(F.col(key).alias("doc_id"), "text"), words=5, num=80, den=100)
    groups = groups.select(F.col("doc_id").alias(key), F.col("component_id").alias("group"))
    ids = rows.select(key, F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", key).alias("place"))
    first = ids.join(groups, key).groupBy("group").agg(F.min("place")[key].alias(key))
    return rows.join(first.select(key), key, "left_semi").select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; each row is judged by itself, whatever its doc_id."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows, key = with_rows(docs)
    found = decontaminate.contaminated(rows.select(F.col(key).alias("doc_id"), "text"), items)
    gone = found.select(F.col("doc_id").alias(key)).distinct()
    return rows.join(gone, key, "left_anti").select(docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose secrets are replaced by a mark."""
    ship_package(spark)
    bound_batches(spark)
    return secret_scan.redact(docs, secret_scan.scan(docs)).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, each a sequence."""
    ship_package(spark)
    bound_batches(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", decontamination),
    ("secret scans", secrets),
    ("packing", pack),
]
#: The trained stages have no SQL; tests compare the stages with brute-force versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what one returns is written to the shared folder and read by the next.

    What a stage stored for itself goes when it is done, and its documents once the next are written; only those that packing still
    reads, whose secrets are replaced, are left for the cluster to expire.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        with job_scratch(spark):
            after = stage(spark, docs, sf_dir)
            after.write.parquet(path)
        if before:
            delete(spark, before)
        docs, before = spark.read.schema(after.schema).parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
