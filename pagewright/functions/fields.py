"""Field parsing for loaded vocabulary records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: ISO-8601 date or date-time forms accepted as timestamps.
ISO_TIMESTAMP_RE = (r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}"
                    r"(?:[T ][0-9]{2}:[0-9]{2}(?::[0-9]{2}(?:\.[0-9]{1,6})?)?(?:Z|[+-][0-9]{2}:[0-9]{2})?)?\z")


def epoch_millis_to_timestamp(col: Column) -> Column:
    """Integer milliseconds since the epoch; anything else NULL (session zone UTC)."""
    return F.timestamp_millis(col.try_cast("long"))


def iso_to_timestamp(col: Column) -> Column:
    """ISO date / date-time text, with or without an offset from UTC (which
    is applied); bad text or NULL gives NULL."""
    return F.when(col.rlike(ISO_TIMESTAMP_RE), F.try_to_timestamp(F.translate(col, "T", " ")))


def json_field(js: Column, key: str, default: Column) -> Column:
    """``obj.get(key, default)`` - the default only when the key is absent;
    an explicit JSON null stays NULL, and so does every field of text that is no object."""
    keys = F.json_object_keys(js)
    return F.when(F.array_contains(keys, key), F.get_json_object(js, f"$.{key}")).when(keys.isNotNull(), default)


def split_valid(df: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows violating NOT NULL go to a quarantine frame instead of failing the load."""
    ok = None
    for c in required:
        cond = F.col(c).isNotNull()
        ok = cond if ok is None else ok & cond
    return df.where(ok), df.where(~ok)
