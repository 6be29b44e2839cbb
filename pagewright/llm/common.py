"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.session import ensure_checkpoint_dir

#: A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def written(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to a new folder below ``spark.checkpoint.dir`` and
    read back: cuts the lineage, and every executor can read it after a loss."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pagewright-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of jobs that are over now: it does so once the
    driver has collected their plans, which a driver with little garbage puts off for long."""
    jvm = getattr(spark, "_jvm", None)
    if jvm is None:
        return
    # Python's references to plans are given up in the background, so it takes a moment and a second turn
    for _ in range(2):
        gc.collect()
        time.sleep(1)
        jvm.java.lang.System.gc()


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, also where ``body`` uses it
    inside a lambda over another array."""
    return F.transform(F.array(value), body)[0]


def count_words(text: Column) -> Column:
    """Words of a text as a long; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
