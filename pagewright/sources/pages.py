"""Page-text sources: page-grain cleaning (S2), article assembly (S1/A7), file filter (S3).

Input grain is one row per page: ``(doc_id, page_num, page_text)``.  Page
cleaning is a pure projection (no shuffle).  Assembly is the one shuffle of the
article pipeline: pages are grouped by ``doc_id`` and their texts joined in
``page_num`` order, which leaves the result hash-partitioned by ``doc_id`` for
every later per-article step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.config import PageConfig
from pagewright.functions import text as T

PAGE_SEPARATOR = "\n\n"


def clean_page_text(col: Column, cfg: PageConfig, flatten: bool) -> Column:
    """Header/footer removal, hyphen repair and (optionally) linebreak removal."""
    t = T.remove_header_footer(col) if cfg.remove_headers_footers else col
    t = T.fix_hyphenation(t)
    if flatten and cfg.remove_linebreaks:
        t = T.remove_linebreaks(t)
    return t


def pages_by_page(pages: DataFrame, cfg: PageConfig = PageConfig()) -> DataFrame:
    """Page grain: cleaned page text, linebreaks kept, nothing joined."""
    return pages.select("doc_id", "page_num",
                        clean_page_text(F.col("page_text"), cfg, flatten=False).alias("page_text"))


def assemble_articles(pages: DataFrame, cfg: PageConfig = PageConfig()) -> DataFrame:
    """One row per article: cleaned pages in page order, each followed by a blank line."""
    cleaned = pages.select("doc_id", "page_num",
                           clean_page_text(F.col("page_text"), cfg, flatten=True).alias("t"))
    grouped = cleaned.groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct("page_num", "t"))).alias("pages"))
    body = F.array_join(F.transform("pages", lambda p: F.concat(p["t"], F.lit(PAGE_SEPARATOR))), "")
    return grouped.select("doc_id", body.alias("raw_text"))


def keep_pdf_paths(files: DataFrame, path_col: str = "path") -> DataFrame:
    """Keep paths ending in ``.pdf`` in any letter case (directory scan filter)."""
    return files.where(F.lower(F.col(path_col)).endswith(".pdf"))


def list_pdf_files(spark, directory: str) -> DataFrame:
    """S3: non-recursive listing of ``*.pdf`` files in any letter case.

    Only path, size and modification time are selected, so the binary content
    is never read.  Listing problems of single files surface as rows with a
    ``status`` instead of failing the job (``ignoreCorruptFiles``).
    """
    df = (spark.read.format("binaryFile")
          .option("pathGlobFilter", "*.[pP][dD][fF]")
          .option("recursiveFileLookup", "false")
          .option("ignoreCorruptFiles", "true")
          .load(directory))
    return df.select("path", "length", "modificationTime",
                     F.when(F.col("length") > 0, F.lit("ok")).otherwise(F.lit("empty")).alias("status"))
