"""Broadcasts only of a measured size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_BROADCAST_BYTES = 64 << 20


def measured_bytes(df: DataFrame) -> int:
    """Bytes of the rows: what strings and binaries hold, and 16 for every field."""
    wide = [F.octet_length(F.col(f"`{f.name}`").cast("string") if not isinstance(f.dataType, T.BinaryType) else F.col(f"`{f.name}`"))
            for f in df.schema.fields if not isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType))]
    total = F.count(F.lit(1)) * F.lit(16 * len(df.columns))
    for w in wide:
        total = total + F.coalesce(F.sum(w.cast("long")), F.lit(0))
    return int(df.agg(total.alias("b")).first()[0])


def small_side(df: DataFrame, limit: int | None = None) -> DataFrame:
    """``df`` with a broadcast hint if its measured size allows; else as it is, for a shuffle
    join. ``df`` is read for that: hand in a stored result."""
    return F.broadcast(df) if measured_bytes(df) <= (MAX_BROADCAST_BYTES if limit is None else limit) else df
