"""Reconciliation.

(a) ``reconcile_totals``: control totals (a delimited control file per date:
    ``effective_date|row_count|amount_total``) against the table's own totals by date.
    The table side is one grouped aggregate over only the control's dates (a literal
    filter, so partitions of other dates are never read); amounts are summed as
    decimals, so the comparison is exact.
(b) ``reconcile_rows``: key-level compare of a source and a target frame. Each side is
    first reduced to ONE row per key: ``count`` and the summed pieces of the xxhash64 of
    the compared columns (a multiset fingerprint that cannot overflow below 2**41 rows of a
    key). A hot or duplicated key therefore collapses map-side, and the full outer join that
    follows matches one row to one row, never all pairs of a key.

Columns whose types differ between the sides are compared in a type that holds both, so a value
is never rounded to the other side's type; a text that is no value of the other side's type is
different from every value of it. ``operators/hashtree.py`` compares the same rows by a tree of
fingerprints first.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value (our design): the columns of a control file, in file order.
CONTROL_SCHEMA = "effective_date string, row_count long, amount_total decimal(18,2)"
AMOUNT_TYPE = "decimal(18,2)"


def control_schema(scale: int = 2) -> T.StructType:
    return T.DataType.fromDDL(CONTROL_SCHEMA.replace(AMOUNT_TYPE, f"decimal({16 + scale},{scale})"))


def control_totals(df: DataFrame, date_column: str, amount_column: str | None, scale: int = 2) -> DataFrame:
    """What a control file holds: rows and amount per date (used to produce fixtures and
    by ``reconcile_totals`` for the table side). Amounts are taken to ``scale`` decimals."""
    kind = f"decimal({16 + scale},{scale})"
    amount = (
        F.sum(F.col(amount_column).cast(kind)).cast(kind)
        if amount_column else F.lit(None).cast(kind)
    )
    return df.groupBy(F.col(date_column).cast("string").alias("effective_date")).agg(
        F.count(F.lit(1)).alias("row_count"), amount.alias("amount_total")
    )


def reconcile_totals(
    control: DataFrame, target: DataFrame, date_column: str = "effective_date", amount_column: str | None = None,
    dates: Sequence[str] | None = None, scale: int = 2,
) -> DataFrame:
    """``effective_date, control_count, target_count, control_amount, target_amount, is_match``
    for the dates of the control and for ``dates`` (the batch's, or all of the target's with
    ``dates="all"``): a date with rows and no control is a mismatch."""
    scoped = target
    if dates != "all":
        # The control holds one row per date: its dates become a literal filter, which prunes a
        # partitioned target to those partitions.
        wanted = {r[0] for r in control.select("effective_date").distinct().collect() if r[0] is not None} | {str(d) for d in dates or ()}
        scoped = target.where(F.col(date_column).cast("string").isin(sorted(wanted)))
    kind = f"decimal({16 + scale},{scale})"
    tgt = control_totals(scoped, date_column, amount_column, scale).alias("t")
    c = control.alias("c")
    j = c.join(tgt, F.col("c.effective_date").eqNullSafe(F.col("t.effective_date")), "full_outer")
    out = j.select(
        F.coalesce(F.col("c.effective_date"), F.col("t.effective_date")).alias("effective_date"),
        F.coalesce(F.col("c.row_count"), F.lit(0)).cast("long").alias("control_count"),
        F.coalesce(F.col("t.row_count"), F.lit(0)).cast("long").alias("target_count"),
        F.col("c.amount_total").cast(kind).alias("control_amount"),
        F.col("t.amount_total").cast(kind).alias("target_amount"),
    )
    return out.withColumn(
        "is_match",
        (F.col("control_count") == F.col("target_count"))
        & F.col("control_amount").eqNullSafe(F.col("target_amount")),
    )


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """A type in which values of both types can be compared without loss (text against decimals:
    18 places at least)."""
    text = (T.StringType, T.VarcharType, T.CharType)
    if isinstance(a, text) and isinstance(b, text):
        return T.StringType()
    if a == b:
        return a
    if isinstance(a, text):
        a, b = b, a
    if isinstance(b, text):
        if isinstance(a, (T.FloatType, T.DoubleType)):
            return T.DoubleType()
        if isinstance(a, T.DecimalType):
            return T.DecimalType(38, max(18, a.scale))
        if isinstance(a, T.IntegralType):
            return T.DecimalType(38, 18)
        if isinstance(a, T.DateType):
            return T.TimestampNTZType()
        return a if isinstance(a, (T.TimestampType, T.TimestampNTZType, T.BooleanType, T.BinaryType)) else T.StringType()
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        if isinstance(a, (T.FloatType, T.DoubleType)) or isinstance(b, (T.FloatType, T.DoubleType)):
            return T.DoubleType()
        digits = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
        if type(a) in digits and type(b) in digits:
            return a if digits[type(a)] > digits[type(b)] else b
        (pa, sa), (pb, sb) = [(t.precision, t.scale) if isinstance(t, T.DecimalType) else (digits[type(t)], 0) for t in (a, b)]
        scale = max(sa, sb)
        return T.DecimalType(min(38, max(pa - sa, pb - sb) + scale), scale)
    times = (T.DateType, T.TimestampType, T.TimestampNTZType)
    if isinstance(a, times) and isinstance(b, times):
        return T.TimestampNTZType()
    return T.StringType()


class Pair:
    """The two sides of a key-level compare: every row as its key, in common types, and the
    fingerprint of its compared columns."""

    def __init__(self, source: DataFrame, target: DataFrame, keys: Sequence[str], compare: Sequence[str] | None = None):
        self.keys = list(keys)
        if compare is None:
            compare = [c for c in source.columns if c not in self.keys and c in target.columns]
        self.compare = list(compare)
        kinds = [{f.name: f.dataType for f in df.schema.fields} for df in (source, target)]
        self.mixed = {c: kinds[0][c] != kinds[1][c] for c in [*self.keys, *self.compare]}
        self.types = {c: common_type(kinds[0][c], kinds[1][c]) for c in self.mixed}
        text = (T.StringType, T.VarcharType, T.CharType)
        #: keys that are text on one side only: the result gives them as text
        self.as_text = {k for k in self.keys if isinstance(kinds[0][k], text) != isinstance(kinds[1][k], text)}
        self.source, self.target = self._side(source), self._side(target)

    def _value(self, name: str) -> tuple[Column, Column]:
        """(value in the common type, the text of a value that has none in it)."""
        c = F.col(f"`{name}`")
        if not self.mixed[name]:
            return c, F.lit(None).cast("string")
        v = c.try_cast(self.types[name])
        return v, F.when(v.isNull(), c.cast("string"))

    def _side(self, df: DataFrame) -> DataFrame:
        out = []
        for i, k in enumerate(self.keys):
            v, raw = self._value(k)
            out += [v.isNull().alias(f"_kn{i}"), F.coalesce(v, _placeholder(self.types[k])).alias(f"_kv{i}")]
            if self.mixed[k]:
                out.append(F.coalesce(raw, F.lit("")).alias(f"_kr{i}"))
        parts = [self._value(c) for c in self.compare]
        hashed = [v for v, _ in parts] + [v.isNull() for v, _ in parts] + [raw for (_, raw), c in zip(parts, self.compare) if self.mixed[c]]
        out += [F.xxhash64(*hashed).alias("_h1"), F.xxhash64(F.lit(1), *hashed).alias("_h2")] if hashed else [F.lit(0).cast("long").alias("_h1"), F.lit(0).cast("long").alias("_h2")]
        return df.select(*out)

    @property
    def key_columns(self) -> list[str]:
        return [c for i, k in enumerate(self.keys) for c in ([f"_kn{i}", f"_kv{i}"] + ([f"_kr{i}"] if self.mixed[k] else []))]

    def output_keys(self) -> list[Column]:
        out = []
        for i, k in enumerate(self.keys):
            v = F.when(~F.col(f"_kn{i}"), F.col(f"_kv{i}"))
            if k in self.as_text:  # whole numbers as they are written, the other side's text as it is
                v = v.cast("string")
                if isinstance(self.types[k], T.DecimalType):
                    v = F.regexp_replace(F.regexp_replace(v, r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")
                v = F.coalesce(v, F.nullif(F.col(f"_kr{i}"), F.lit("")))
            out.append(v.alias(k))
        return out


def hash_sums(name: str, tag: str) -> list[Column]:
    """Sums of three pieces of a 64-bit hash: a fingerprint of a multiset of rows. The pieces
    have 22 bits at most, so the sums hold 2**41 rows."""
    h = F.col(name)
    return [F.sum(F.shiftrightunsigned(h, at).bitwiseAND(F.lit((1 << 22) - 1))).alias(f"{tag}{at}") for at in (0, 22, 44)]


def _placeholder(dtype: T.DataType) -> Column:
    """A non-null value of ``dtype`` that stands in for null inside a join key (paired
    with an is-null flag, so it never collides with a real value)."""
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        return F.lit("")
    if isinstance(dtype, T.BooleanType):
        return F.lit(False)
    if isinstance(dtype, T.DateType):
        return F.lit("1970-01-01").cast("date")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01 00:00:00").cast(dtype)
    if isinstance(dtype, T.BinaryType):
        return F.lit(b"")
    return F.lit(0).cast(dtype)


def compare_keys(pair: Pair, source: DataFrame, target: DataFrame) -> DataFrame:
    """Keys that differ between two frames of ``pair``'s rows."""
    sides = []
    for df, tag in ((source, "s"), (target, "t")):
        sides.append(df.groupBy(*pair.key_columns).agg(F.count(F.lit(1)).alias(f"{tag}_n"), *hash_sums("_h1", f"{tag}_")))
    # Plain equality on the (is-null flag, value-or-placeholder) grouping columns: null
    # keys match each other and the join reuses the aggregates' hash partitioning.
    j = sides[0].join(sides[1], pair.key_columns, "full_outer")
    differs = F.lit(False)
    for what in ("n", "0", "22", "44"):
        differs = differs | (F.col(f"s_{what}") != F.col(f"t_{what}"))
    status = F.when(F.col("t_n").isNull(), F.lit("missing")).when(F.col("s_n").isNull(), F.lit("extra")).when(differs, F.lit("changed"))
    return j.select(*pair.output_keys(), status.alias("status")).where(F.col("status").isNotNull())


def reconcile_rows(source: DataFrame, target: DataFrame, keys: Sequence[str], compare: Sequence[str] | None = None) -> DataFrame:
    """Keys that differ: ``<keys>, status`` with status ``missing`` (in source, not in
    target), ``extra`` (in target only) or ``changed`` (different rows under the key)."""
    pair = Pair(source, target, keys, compare)
    return compare_keys(pair, pair.source, pair.target)
