"""From raw documents to packed training sequences.

``STAGES`` lists the stages; each takes ``(spark, docs, sf_dir)`` and returns a
DataFrame, which is written as Parquet and read again as the next stage's documents.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.llm import line_dedup, minhash, mixing, nbsvm, packing
from pagewright.llm.common import read, written
from pagewright.llm.q_corpus import tokenizer_path
from pagewright.operators.partitioning import size_checked_broadcast

#: A document of a lower score is rejected.
QUALITY = 0.3
#: Up to so many ids and hashes (16 bytes a row) are broadcast to leave out their rows.
BROADCAST_IDS = 2_000_000


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject.  It learns from the labels of the
    documents that it is given; without labels of both kinds it keeps all whose share of
    good labels is high enough, that is, every document or none.  Rows are judged alone."""
    model = nbsvm.fit(docs, read(spark, sf_dir, "labels"))
    return docs.where(nbsvm.scorer(model)(F.col("text")) >= QUALITY)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the later occurrences of long passages; ``n_chars`` is counted
    again where the text changed.  A document of which nothing is left goes."""
    out = line_dedup.remove_repeats(docs).where("removed_words = 0 OR removed_words < n_words")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("removed_words") > 0, F.length("text")).otherwise(F.col("n_chars"))
                             .cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: that of the smallest doc_id, and of rows that
    share it the one of the smallest text hash; repeated rows are copies.  Rows that are near
    to nothing all stay, whether or not they share a doc_id, and so do rows without a doc_id
    or without words."""
    place = F.struct("doc_id", "text_key")
    rows = written(minhash.groups(docs).where("group IS NOT NULL"))
    first = rows.groupBy("group").agg(F.min(place).alias("first"))
    marked = written(rows.join(first, "group").select("doc_id", "text_key", (place == F.col("first")).alias("kept")))
    gone = marked.where("NOT kept").select("doc_id", "text_key").distinct()
    several = marked.where("kept").groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    on = ["doc_id", "_text_key"]
    gone, several = (x.withColumnRenamed("text_key", "_text_key") for x in (gone, several))
    keyed = docs.withColumn("_text_key", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    rest = keyed.join(size_checked_broadcast(written(gone), BROADCAST_IDS), on, "left_anti")
    several = written(several)
    if not several.take(1):
        return rest.select(*docs.columns)
    few = size_checked_broadcast(several, BROADCAST_IDS)
    return rest.join(few, on, "left_anti").select(*docs.columns).unionByName(
        rest.join(few, on, "left_semi").dropDuplicates(on).select(*docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens: a row for each piece of a document, copies apart."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup_stage),
    ("near duplicates", near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: Trained models, tilted rates and tokens are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
