"""From raw documents to packed sequences: five stages, each over all rows that the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame.  run() writes each stage's rows as
Parquet to the shared folder and reads them again, so a lost executor costs one stage's tasks.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factline.llm import decontaminate, jaccard_join, packing, quality, substring_dedup
from factline.llm._common import discard, release, stage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` and row: a number for each row, the same whenever it is read.

    A table of files is numbered by file and place in it, anything else is staged with its numbers."""
    if docs._jdf.queryExecution().analyzed().getClass().getSimpleName() != "LogicalRelation":
        return stage(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()), "rows")
    files = sorted(r[0] for r in docs.select("_metadata.file_path").distinct().collect())
    place = docs.sparkSession.createDataFrame(list(enumerate(files)), "file long, file_path string")
    rows = docs.select(*COLUMNS, F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.row_index").alias("at"))
    return rows.join(F.broadcast(place), "file_path").select(*COLUMNS, (F.shiftleft("file", 40) + F.col("at")).alias("row"))


def _by_row(rows: DataFrame) -> DataFrame:
    """``rows`` as the operators take them, the row's number in place of its doc_id: they tell rows apart that share a doc_id or have none."""
    return rows.drop("doc_id").withColumnRenamed("row", "doc_id")


def _without(rows: DataFrame, bad: DataFrame) -> DataFrame:
    """``rows`` without those that an operator's rows ``bad`` name."""
    return rows.join(bad.select(F.col("doc_id").alias("row")), "row", "left_anti").select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    rows = _numbered(docs)
    return _without(rows, quality.judge(_by_row(rows)).filter("not kept"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group (one without a doc_id if none has one): five-word shingles, similarity of 0.8 or more."""
    rows = _numbered(docs)
    found = jaccard_join.jaccard_components(_by_row(rows), k=5, threshold=(4, 5)).select(F.col("doc_id").alias("row"), "component_id")
    found = stage(found.join(rows.select("row", F.col("doc_id").alias("id")), "row"), "components")
    release()
    first = found.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("first"), F.count("*").alias("n"))
    bad = found.join(first.filter("n > 1"), "component_id").filter(F.col("row") != F.col("first.row"))
    return _without(rows, bad.select(F.col("row").alias("doc_id")))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that one with a smaller doc_id has; those with no word left go.

    Rows of one doc_id count as one after another, rows without a doc_id as the last."""
    by = (F.col("doc_id").asc_nulls_last(), F.xxhash64("text").asc())
    ordered = docs.select(*COLUMNS).repartitionByRange(*by).sortWithinPartitions(*by)
    rows = stage(ordered.withColumn("row", F.monotonically_increasing_id()), "rows")  # in order of doc_id
    release()
    cut = stage(substring_dedup.remove_repeats(_by_row(rows), window=13).filter("n_removed > 0").select(F.col("doc_id").alias("row"), "kept_text", (F.col("n_removed") == F.col("n_words")).alias("gone")), "passages")
    release()
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.col("kept_text"))
    n_chars = F.when(F.col("gone").isNull(), F.col("n_chars")).otherwise(F.length("kept_text").cast("long"))
    joined = rows.join(cut, "row", "left").filter("not coalesce(gone, false)")
    return joined.select("doc_id", text.alias("text"), "lang", "source", n_chars.alias("n_chars"))


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no ten consecutive words with an item of ``benchmark``."""
    rows, benchmark = _numbered(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _without(rows, decontaminate.find_contamination(_by_row(rows), benchmark, width=10).filter("size(items) > 0"))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences of 4096 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end_id=1)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_passages", benchmark_passages),
    ("packed_sequences", packed_sequences),
]

#: No SQL says the graph of near duplicates, the tokenizer or the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
        if last is not None:  # what came of it is written
            discard(last)
        last = docs
    return docs
