"""Structured Streaming entry for page text.

Page cleaning (header/footer removal, hyphen repair) is a stateless
projection, so it runs unchanged on a stream.  Article-level work needs all
pages of an article, whichever batch they land in; it runs as a batch job over
the landed pages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from pagewright.sources.pages import pages_by_page

PAGE_SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("page_num", T.LongType()),
                            T.StructField("page_text", T.StringType())])


def cleaned_page_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int = 100) -> DataFrame:
    """Streaming DataFrame of cleaned pages (page grain)."""
    raw = (spark.readStream.schema(PAGE_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger)
           .parquet(source_dir))
    return pages_by_page(raw)
