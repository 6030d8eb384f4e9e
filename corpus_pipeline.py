"""The corpus pipeline: quality filter, near-duplicate removal, source mix, token ids.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; all but the last return the columns of ``documents``.  A stage begins by
letting the executors give back the memory of the stages before it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import mixing, ngram_join, pieces, quality_crf
from tidewatch.llm.common import drop, free_heaps, materialise, table
from tidewatch.llm.queries import MIX_SHARE, MIX_WEIGHTS

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the line field rejects (score below one half).

    A null or empty text is one empty line and is scored as such; null ids,
    repeated rows and further columns change nothing, and further columns are
    not returned.  The field is fitted on the labelled rows outside the
    held-out third; without any, every document scores one half and stays.
    """
    free_heaps(spark)
    model = quality_crf.train(docs, table(spark, sf_dir, "labels"))
    score = quality_crf.scorer(model)
    return docs.select(*COLUMNS).withColumn("_score", score(F.col("text"))).where(F.col("_score") >= 0.5).drop("_score")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates: the one of smallest id.

    Rows without an id and rows that share one get ids of their own, above all
    others, so of repeated rows one stays, too; a group with an id keeps a row
    that has one.  A null or empty text is like no other and stays.  An empty
    table gives an empty result.
    """
    free_heaps(spark)
    rows = docs.select(*COLUMNS)
    ids = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    unclear, unclear_path = materialise(ids.where("n > 1 OR doc_id IS NULL").select(F.col("doc_id").alias("id"), F.lit(True).alias("unclear")), "unclear", slim=True)
    if unclear.isEmpty():
        drop(spark, unclear_path)
        joined = ngram_join.join_documents(rows)
        free_heaps(spark)
        gone = joined.where(F.col("doc_id") != F.col("component_id")).select("doc_id")
        return rows.join(gone, "doc_id", "left_anti").select(*COLUMNS)
    marked = rows.join(unclear, F.col("doc_id").eqNullSafe(F.col("id")), "left").drop("id")
    last = rows.agg(F.max("doc_id")).first()[0]
    # Written once, so that a row keeps its number.
    number = F.lit(max(last or 0, 0) + 1) + F.monotonically_increasing_id()
    own, _ = materialise(marked.withColumn("number", F.when(F.col("unclear"), number).otherwise(F.col("doc_id"))).drop("unclear"), "numbered")
    joined = ngram_join.join_documents(own, "number")
    free_heaps(spark)
    gone = joined.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("number"))
    return own.join(gone, "number", "left_anti").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each document as often as the mix of sources says, none to twice.

    A null source is a source of its own; a null or empty text has no words and
    is not taken; rows that are equal are taken alike.
    """
    free_heaps(spark)
    return mixing.repeat(mixing.mix(docs.select(*COLUMNS), MIX_WEIGHTS, MIX_SHARE)).select(*COLUMNS)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document of the mix, once for each time it is taken.

    A null or empty text has no ids; null ids and repeated rows stay.
    """
    free_heaps(spark)
    return pieces.encode_documents(docs, pieces.read_model())


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode_pieces),
]
#: SQL expresses no stage; the pipeline is tested against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written and read again, the last but one's stays."""
    docs, before = table(spark, sf_dir, "documents"), None
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs, path = materialise(docs, f"stage{k}")
            if before:
                drop(spark, before)
            before = path
    return docs
