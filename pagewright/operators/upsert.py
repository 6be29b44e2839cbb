"""Keyed writes as DataFrame algebra (K1-K6, J7, K2 surrogate ids).

"First"/"last" always means by an explicit ordinal column carried from the
scan (array position, file order, change-log sequence); Spark row order is
never relied on.  Every function returns the new table state; writing it is
the caller's choice (a fresh path swapped in, or ``MERGE INTO`` on a table
format that supports it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order: list[str], last: bool = True) -> DataFrame:
    """One row per key: the last (or first) by ``order``.  An aggregate, so it
    combines partially on the map side before the shuffle by key."""
    others = [c for c in df.columns if c not in keys]
    ordk = F.struct(*[F.col(c) for c in order])
    pick = F.max_by if last else F.min_by
    g = df.groupBy(*keys).agg(pick(F.struct(*others), ordk).alias("_r"))
    return g.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in others])


def dense_ids(keys: DataFrame, key: str, base: int = 0, id_col: str = "id") -> DataFrame:
    """Number distinct keys ``base+1, base+2, ...`` in key order, without a single-task window.

    Keys are range-partitioned and materialised once (checkpoint, so a lost
    executor recomputes nothing differently); per-partition counts give each
    partition its offset, and ``row_number`` runs inside each partition.  Null
    keys get no id.
    """
    from pagewright.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(keys.sparkSession)
    k = keys.select(key).where(F.col(key).isNotNull()).distinct().repartitionByRange(F.col(key)) \
        .withColumn("_pid", F.spark_partition_id()).checkpoint()
    counts = k.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offs = counts.select("_pid", F.coalesce(F.sum("_n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    rn = F.row_number().over(Window.partitionBy("_pid").orderBy(key))
    out = k.withColumn("_rn", rn).join(F.broadcast(offs), "_pid")   # one row per partition
    return out.select(key, (F.lit(base) + F.col("_off") + F.col("_rn")).cast("long").alias(id_col))


def upsert_last_wins(existing: DataFrame, incoming: DataFrame, key: str, order: list[str],
                     id_col: str = "id") -> DataFrame:
    """K1/K2: attributes from the last incoming row per key; the existing
    surrogate id is kept, new keys get ids after the current maximum."""
    latest = latest_per_key(incoming, [key], order, last=True)
    attrs = [c for c in latest.columns if c != key]
    old = existing.select(key, id_col, *[F.col(c).alias(f"_old_{c}") for c in attrs])
    merged = old.join(latest.withColumn("_in", F.lit(True)), key, "full_outer")
    base = existing.agg(F.max(id_col)).first()[0] or 0     # one scalar
    ids = dense_ids(merged.where(F.col(id_col).isNull()).select(key), key, int(base), "_new_id")
    merged = merged.join(ids, key, "left")
    has_new = F.col("_in").isNotNull()
    return merged.select(
        key, F.coalesce(F.col(id_col), F.col("_new_id")).alias(id_col),
        *[F.when(has_new, F.col(c)).otherwise(F.col(f"_old_{c}")).alias(c) for c in attrs])


def _not_in(rows: DataFrame, existing: DataFrame, columns: list[str]) -> DataFrame:
    """Rows whose ``columns`` are not in ``existing``; two nulls are equal, so a row
    with a null is not added again on a rerun."""
    have = existing.select(*[F.col(c).alias(f"_have_{c}") for c in columns])
    same = None
    for c in columns:
        one = F.col(c).eqNullSafe(F.col(f"_have_{c}"))
        same = one if same is None else same & one
    return rows.join(have, same, "left_anti")


def insert_first_wins(existing: DataFrame, incoming: DataFrame, key: str, order: list[str]) -> DataFrame:
    """K3: ``ON CONFLICT DO NOTHING`` on a primary key - the first incoming row
    per key, only for keys not already present.  Null is a key like any other."""
    first = latest_per_key(incoming, [key], order, last=False)
    return existing.unionByName(_not_in(first, existing, [key]).select(*existing.columns))


def append_idempotent(existing: DataFrame, incoming: DataFrame, natural: list[str]) -> DataFrame:
    """K4: append rows whose natural columns are not yet present (a rerun adds nothing)."""
    return existing.unionByName(_not_in(incoming.dropDuplicates(natural), existing, natural).select(*existing.columns))


def upsert_concept_classes(classes: DataFrame) -> DataFrame:
    """K5: one row per class id, last processed (concept ordinal, position) wins."""
    return latest_per_key(classes, ["concept_class_id"], ["concept_ordinal", "pos"], last=True) \
        .drop("concept_ordinal", "pos")


def upsert_concept_relationships(relationships: DataFrame, contrasts: DataFrame) -> DataFrame:
    """Relationships then contrasts per concept; the last per
    (concept_id, related_concept_id) wins, so a contrast beats a relationship."""
    rel = relationships.select("concept_id", F.coalesce("related_concept_id", F.lit("")).alias("related_concept_id"),
                               F.coalesce("relationship", F.lit("")).alias("relationship"),
                               F.coalesce("direction", F.lit("")).alias("direction"),
                               F.lit(0).alias("phase"), "pos")
    con = contrasts.select("concept_id", F.coalesce("task_id", F.lit("")).alias("related_concept_id"),
                           F.coalesce("relationship", F.lit("")).alias("relationship"),
                           F.lit("MEASUREDBY").alias("direction"), F.lit(1).alias("phase"), "pos")
    both = rel.unionByName(con)
    # (phase, pos) orders the rows; the payload breaks ties between rows that
    # share an ordinal, so the result never depends on row arrival order.
    return latest_per_key(both, ["concept_id", "related_concept_id"],
                          ["phase", "pos", "relationship", "direction"], last=True).drop("phase", "pos")


def append_all(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """K4 parity mode: plain append (the reference's unkeyed inserts; a rerun duplicates)."""
    return existing.unionByName(incoming.select(*existing.columns))
