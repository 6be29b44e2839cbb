"""Queries of the operators that build a training mix."""

from __future__ import annotations

from pagewright.llm import mixing as M
from pagewright.llm import packing as P
from pagewright.llm.common import read


def op7_mixing(spark, sf_dir):
    """All documents mixed to their sources' targets."""
    return M.mix_documents(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "copies", "rate")


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op9_packing(spark, sf_dir):
    """All documents packed into sequences of 2048 tokens."""
    return P.pack_documents(read(spark, sf_dir, "documents"), tokenizer_path())


QUERIES = {"op7_mixing": op7_mixing, "op9_packing": op9_packing}
ORACLE: dict[str, str] = {}
