"""From raw documents to token ids: five stages, each written as Parquet before the next one reads it.

STAGES names the stages in order. Each takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of `documents`. The first three leave documents out, the fourth masks secrets, the last encodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepframe.llm import bpe, decontaminate, quality, secret_scan, simhash
from prepframe.llm.frames import column
from prepframe.llm.queries import VOCABULARY, fold, table
from prepframe.scratch import stored

#: Ids to leave out up to which their table is broadcast (8 bytes each); a join by shuffle beyond.
BROADCAST_IDS = 1_000_000


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality ranking accepts. It learns from the labelled rows of four folds in five."""
    ranking = quality.fit_ranking(docs, table(spark, sf_dir, "labels").where(fold(5) != 0))
    names = [f"c{i}" for i in range(len(docs.columns))]
    scored = quality.score_quality(docs.toDF(*names), ranking, names[docs.columns.index("text")])
    return scored.where("predicted = 1").select(*names).toDF(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (SimHash of three-word shingles, at most two bits apart): the one with
    the smallest id. Documents without an id stay.

    Rows of equal id are one document, of which one row stays.
    """
    found = stored(simhash.near_duplicates(docs), "groups")
    gone = found.where("component_id <> doc_id").select("doc_id").distinct()
    if gone.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    left = docs.join(gone, "doc_id", "left_anti")
    again = found.where("component_id = doc_id").groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1").select("doc_id")
    if again.limit(1).count():
        left = left.join(again, "doc_id", "left_anti").unionByName(docs.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id"]))
    return left.select(*[column(c) for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that don't hold benchmark passages."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark for each secret; n_chars follows the text."""
    masked = secret_scan.mask_secrets(docs)
    length = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))
    return masked.withColumn("n_chars", length).select(*[column(c) for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and their digests."""
    return bpe.encode(docs, VOCABULARY, "text", ["doc_id"])


STAGES = [
    ("quality", keep_good),
    ("near_copies", drop_near_copies),
    ("contamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("encoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Not to be said in SQL: the ranking's fit, XXH64 and the encoder.
ORACLE_SQL = None
