"""Article store tables, citations and retrieval.

The store holds six tables, each by article.  A load writes the hash buckets of ``doc_id`` that
its articles fall into, under a version of its own, with what the store had of other articles
in them; last comes a manifest that says which version each bucket has.  Readers follow the
newest manifest, so a load shows whole or not at all, and can be run again.

Global entities are keyed by ``(label, lower(text))``, relationships by
``(lower(entity1), entity1_type, relation, lower(entity2), entity2_type)``;
ids are 64-bit hashes of those keys, so loads in parallel never need a
central id counter.  Citations link each global key to the articles it
appears in (one row per key and article).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagewright.operators.partitioning import stored

ENTITY_KEY = ["label", "norm_text"]
RELATION_KEY = ["entity1_norm", "entity1_type", "relation", "entity2_norm", "entity2_type"]


def entity_citations(entities: DataFrame) -> DataFrame:
    """K8: (entity_id, label, norm_text, doc_id, first_start) from per-article first occurrences,
    of which an article has one per entity, so nothing is grouped again."""
    return entities.select(F.xxhash64("label", F.lower("text")).alias("entity_id"), "label", F.lower("text").alias("norm_text"),
                           "doc_id", F.col("start").alias("first_start"))


def global_entities(entities: DataFrame) -> DataFrame:
    """One row per global entity with its article count and an example surface text, from
    per-article first occurrences (one row per entity and article)."""
    e = entities.select("doc_id", "label", F.lower("text").alias("norm_text"), "text")
    g = e.groupBy("label", "norm_text").agg(F.count(F.lit(1)).alias("n_articles"),
                                            F.min("text").alias("example_text"))
    return g.select(F.xxhash64("label", "norm_text").alias("entity_id"), "label", "norm_text",
                    "n_articles", "example_text")


def relation_citations(relations: DataFrame) -> DataFrame:
    """K8: relationships per global key with the articles citing them."""
    r = relations.select("doc_id", F.lower("entity1").alias("entity1_norm"), "entity1_type", "relation",
                         F.lower("entity2").alias("entity2_norm"), "entity2_type", "confidence")
    g = r.groupBy(*RELATION_KEY, "doc_id").agg(F.count(F.lit(1)).alias("n_mentions"),
                                               F.max("confidence").alias("max_confidence"))
    return g.select(F.xxhash64(*RELATION_KEY).alias("relation_id"), *RELATION_KEY, "doc_id",
                    "n_mentions", "max_confidence")


def articles_by_entity(citations: DataFrame, label: str, text: str) -> DataFrame:
    """Articles mentioning one entity (equi-join on the hashed key, pushed as a filter)."""
    key = F.xxhash64(F.lit(label), F.lit(text.lower()))
    return citations.where(F.col("entity_id") == key).select("doc_id", "first_start")


def entities_by_article(citations: DataFrame) -> DataFrame:
    """``doc_id`` and the ``entities`` that the article cites, by label and text."""
    return citations.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("label", "norm_text", "entity_id", "first_start"))).alias("entities"))


#: Entities of an article that are paired in one piece of work.
PAIR_BLOCK = 256


def co_mentions(citations: DataFrame, block: int = PAIR_BLOCK) -> DataFrame:
    """``label1, text1, label2, text2, n_both, n1, n2`` for entities that articles cite
    together, with the articles of both and of each.

    Citations meet by article.  An article with more than ``block`` entities has them split by
    hash into blocks, and each pair of blocks is a key of its own, so an article of any size
    spreads over tasks.  Pairs are counted where they are made before they are shuffled, so an
    entity that most articles cite gives each task one row per partner.
    """
    e = stored(citations.select("doc_id", "label", "norm_text").distinct())
    size = e.groupBy("doc_id").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("_nb"))
    e = e.join(size, "doc_id").withColumn("_own", F.pmod(F.xxhash64("label", "norm_text"), F.col("_nb")).cast("int"))
    own = e.select("doc_id", F.struct("label", "norm_text").alias("_e"), "_own", F.explode(F.sequence(F.lit(0), F.col("_nb") - 1)).alias("_other"))
    a = own.select("doc_id", F.col("_e").alias("_a"), F.col("_own").alias("_x"), F.col("_other").alias("_y"))
    b = own.select("doc_id", F.col("_e").alias("_b"), F.col("_other").alias("_x"), F.col("_own").alias("_y"))
    both = a.join(b, ["doc_id", "_x", "_y"]).where(F.col("_a") < F.col("_b"))
    pairs = both.groupBy("_a", "_b").agg(F.count(F.lit(1)).alias("n_both"))
    n = e.groupBy(F.struct("label", "norm_text").alias("_e")).agg(F.count(F.lit(1)).alias("n"))
    out = pairs.join(n.select(F.col("_e").alias("_a"), F.col("n").alias("n1")), "_a").join(
        n.select(F.col("_e").alias("_b"), F.col("n").alias("n2")), "_b")
    return out.select(F.col("_a.label").alias("label1"), F.col("_a.norm_text").alias("text1"), F.col("_b.label").alias("label2"),
                      F.col("_b.norm_text").alias("text2"), "n_both", "n1", "n2")


STORE_TABLES = ("articles", "scientific_entities", "entity_aliases", "entity_relationships", "entity_citations", "relationship_citations")
#: Buckets of a new store, and files of a bucket that one load writes.
BUCKETS, FILES = 256, 4


def article_tables(articles: DataFrame, found) -> dict[str, DataFrame]:
    """The six tables of some articles (any columns with ``doc_id``) and what was extracted from
    them (an ``Extraction``).  Aliases and relationships are written here, so that articles are
    searched and entities paired once, however many tables and loads read them."""
    aliases, relations = stored(found.aliases), stored(found.relations)
    return {"articles": articles, "scientific_entities": found.entities, "entity_aliases": aliases, "entity_relationships": relations,
            "entity_citations": entity_citations(found.entities), "relationship_citations": relation_citations(relations)}


def _bucket(buckets: int):
    return F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(buckets)).cast("int")


def manifest(spark: SparkSession, base: str) -> DataFrame | None:
    """``bucket, load, buckets`` of the newest manifest (a row per bucket), or None for a new store."""
    try:
        found = spark.read.parquet(f"{base.rstrip('/')}/manifest")
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    newest = found.agg(F.max("version")).first()[0]
    return found.where(F.col("version") == newest)


def read_store(spark: SparkSession, base: str, table: str) -> DataFrame:
    """K7: the present rows of a store's table.  The manifest's few rows pick the folders."""
    now = manifest(spark, base).select("bucket", "load")
    base = base.rstrip("/")
    # the schema stands apart, for a table without rows yet
    schema = T.StructType([*spark.read.parquet(f"{base}/schema/{table}").schema.fields, T.StructField("load", T.IntegerType()),
                           T.StructField("bucket", T.IntegerType())])
    rows = spark.read.schema(schema).parquet(f"{base}/{table}")
    return rows.join(F.broadcast(now), ["bucket", "load"]).drop("bucket", "load")


def write_store(tables: dict[str, DataFrame], base: str, buckets: int = BUCKETS) -> int:
    """K7: put articles into the store below ``base`` in place of what it has of them; the version
    written.

    ``tables`` has ``articles`` and the tables by article (``doc_id`` in each).  All rows of the
    given articles are replaced in all tables, also where there are none now; other articles
    stay.  Loading the same articles again changes nothing but the version, and a load that
    breaks off leaves the store as it was.  Rows without a doc_id cannot be replaced, and are left out.  The number
    of buckets is that of the first load.
    """
    base = base.rstrip("/")
    spark = tables["articles"].sparkSession
    old = manifest(spark, base)
    state = {r["bucket"]: r["load"] for r in old.collect()} if old is not None else {}
    if old is not None:
        buckets = old.first()["buckets"]
    version = (old.agg(F.max("version")).first()[0] if old is not None else 0) + 1
    ids = stored(tables["articles"].where("doc_id IS NOT NULL").select("doc_id").distinct())
    touched = [r[0] for r in ids.select(_bucket(buckets).alias("b")).distinct().collect()]     # at most one row per bucket
    for name, df in tables.items():
        new = df.where("doc_id IS NOT NULL")
        if state:
            kept = read_store(spark, base, name).where(_bucket(buckets).isin(touched)).join(ids, "doc_id", "left_anti")
            new = kept.select(*df.columns).unionByName(new)
        # a bucket's rows go to a few tasks, whatever its size in the whole
        salt = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(FILES))
        new = new.withColumn("bucket", _bucket(buckets)).repartition(F.col("bucket"), salt)
        new.write.mode("overwrite").partitionBy("bucket").parquet(f"{base}/{name}/load={version}")
        if old is None:
            df.limit(0).write.mode("overwrite").parquet(f"{base}/schema/{name}")
    state |= {b: version for b in touched}
    rows = [(b, v, buckets) for b, v in sorted(state.items())]
    spark.createDataFrame(rows, "bucket int, load int, buckets int").coalesce(1).write.mode("overwrite").parquet(f"{base}/manifest/version={version}")
    return version
