"""Queries of the deduplication operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagewright.llm import line_dedup as L
from pagewright.llm import minhash as N
from pagewright.llm import suffix_dedup as X
from pagewright.llm.common import read


def op4_minhash_dedup(spark, sf_dir):
    """Near-duplicates among all documents."""
    return N.near_duplicates(read(spark, sf_dir, "documents"))


def op10_line_dedup(spark, sf_dir):
    """All documents without the later occurrences of passages of 50 words or more."""
    return L.remove_repeats(read(spark, sf_dir, "documents")).select("doc_id", *L.ADDED, "text")


def op11_suffix_dedup(spark, sf_dir):
    """All documents without the bytes of strings of 100 bytes that start earlier too."""
    return X.remove_repeats(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op4_minhash_dedup": op4_minhash_dedup, "op10_line_dedup": op10_line_dedup,
           "op11_suffix_dedup": op11_suffix_dedup}
ORACLE: dict[str, str] = {}
