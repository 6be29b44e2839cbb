"""Partitioning helpers shared by the article operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.session import ensure_checkpoint_dir


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to a new folder below the shared ``spark.checkpoint.dir`` and
    read back: the lineage ends there, nothing stays in executor memory, and any executor
    can read it after another one is lost."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Names the row of an article where spans go without the text around them; rows of one id and text share it.
ROW = "_text_row"


def with_row(docs: DataFrame) -> DataFrame:
    """``docs`` with :data:`ROW`, by which spans find the text they come from again."""
    return docs.withColumn(ROW, F.xxhash64("doc_id", "text"))


def text_partitions(df: DataFrame) -> int:
    """Partition count for text stages: the shuffle-partition setting, at least
    the default parallelism.  Given explicitly, so AQE does not merge the
    partitions by byte size - text work is regex-bound, not byte-bound, and a
    few MB of text per partition already keeps a core busy."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    try:
        return max(n, spark.sparkContext.defaultParallelism)
    except Exception:
        return n


def by_doc(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Hash-partition documents by id once; later windows and joins on the id reuse it."""
    return docs.repartition(text_partitions(docs), F.col(id_col))


def size_checked_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``df`` only when its row count is proven below ``max_rows``.

    Used for dimension tables (gazetteers, id maps).  Above the bound the plain
    DataFrame is returned, so the join plans as a shuffle join on its keys.
    The count runs on the small side only.
    """
    n = df.count()
    return F.broadcast(df) if n <= max_rows else df


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition a scan by ``keys`` when it yields fewer partitions than the
    cluster's default parallelism (one unsplittable file); a multi-file dataset
    is left as it is, so this never adds a shuffle at cluster scale."""
    try:
        narrow = df.rdd.getNumPartitions() < df.sparkSession.sparkContext.defaultParallelism
    except Exception:          # no RDD view (e.g. a Connect session): spread to be safe
        narrow = True
    if not narrow:
        return df
    if keys:
        return df.repartition(text_partitions(df), *[F.col(k) for k in keys])
    return df.repartition(text_partitions(df))


def text_side(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The article-text side of a join back to the text: never broadcast.

    Article text grows with the corpus, so it is joined with a sort-merge join
    on ``doc_id``; documents already hash-partitioned by ``doc_id`` are not
    shuffled again, only the (small) span side is.  The text comes back as
    ``text_body`` with its length ``text_len`` computed once per article.
    """
    return docs.select(id_col, F.col("text").alias("text_body"),
                       F.length("text").alias("text_len")).hint("merge")
