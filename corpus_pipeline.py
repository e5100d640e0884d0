"""From raw documents to packed training batches: toxic documents go, exact and near copies go, sources are mixed, rows are packed.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on all rows that its predecessor kept.  All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from navloom.llm.common import broadcast_if_small, measured, table
from navloom.llm.exact_dedup import exact_dedup
from navloom.llm.jaccard import jaccard_components, mark_of
from navloom.llm.mixing import mix_sources
from navloom.llm.packing import pack
from navloom.llm.toxicity import learn, score_toxicity
from navloom.session import shared_dir


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxic passages, weighed by a model fitted to all labels, leave the score below one half."""
    model = learn(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model).where("predicted = 0").select("row.*")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the longest document, then the one with the smallest id; a row that repeats it goes too."""
    kept = exact_dedup(docs).where("kept")
    if not docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        kept = kept.withColumn("id", F.col("row.doc_id")).dropDuplicates(["id", "text_sha256"])
    return kept.select("row.*")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of 5-word shingle sets at 80 percent connect, the one with the smallest id; other texts of its id stay or go by their own links."""
    found = jaccard_components(docs, width=5, percent=80)
    losers, n = measured(found.where("NOT kept").select(F.col("id").alias("loser"), "mark").distinct())
    losers = broadcast_if_small(losers, n)
    return docs.join(losers, (docs.doc_id == losers.loser) & (mark_of("text") == losers.mark), "left_anti")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Poisson copies, so that a source's share follows the square root of its size."""
    return mix_sources(docs).select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every copy with its text, its bucket and its place in a batch."""
    found = pack(docs)
    return found.select("row.doc_id", "row.source", "row.text", "n_tokens", "bucket", "bucket_length", "batch", "place", "padding")


STAGES = [("toxicity", toxicity), ("exact_dedup", exact), ("jaccard_join", near), ("mixing", mix), ("packing", packing)]

#: The toxicity model and the packing plan are not SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written in the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/pipeline-{spark.sql('SELECT uuid()').first()[0]}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
