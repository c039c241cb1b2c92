"""Column profiles.

All columns are profiled in ONE aggregation (partial aggregates per task, one small row
per task shuffled), then unpivoted to one row per column with ``inline``. Distinct counts
are HyperLogLog++ estimates (``approx_count_distinct``), a fixed-size sketch per task. With
``exact=True`` this pass also tells how many distinct values there are about, and a second one counts
them: few by Spark's distinct aggregates, whose tables per task hold the distinct values; many after
rows were dealt to as many tasks as their size asks for, so no task's table grows with the input.

Top values, exact, of all columns in two scans: the first keeps a mergeable heavy-hitter sketch
of each column's value hashes (``approx_top_k``), whose counts are off by a share of the rows at
most; the second counts exactly the values that can be among the k most frequent by those bounds.
Where the k-th exact count is not above what an unlisted value may have (columns of nearly
distinct values), that column is counted whole by a grouped count and a top-k.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.session import scratch_path

PROFILE_SCHEMA = (
    "column_name string, data_type string, row_count long, null_count long, distinct_count long, "
    "min_length long, max_length long, min_value double, max_value double, mean_value double, stddev_value double"
)


def _is_numeric(dt: T.DataType) -> bool:
    return isinstance(dt, T.NumericType)


def _is_text(dt: T.DataType) -> bool:
    return isinstance(dt, (T.StringType, T.VarcharType, T.CharType))


def hashed(c: Column) -> Column:
    """What a distinct sketch is fed: the value's hash (sketches leave empty strings out)."""
    return F.when(c.isNotNull(), F.xxhash64(c))


# Exact distinct counts: up to so many values (by estimate, of all columns together) are kept in
# each task's table; of more, a task gets rows whose values take so many bytes.
KEPT_VALUES = 200_000
TASK_BYTES = 128 << 20


def _hashable(dtype: T.DataType) -> bool:
    return "map<" not in dtype.simpleString() and "variant" not in dtype.simpleString()


def _value(f: T.StructField) -> tuple[Column, T.DataType]:
    """A column's value as a grouping key. Floats as text, which tells all of them apart: Spark would
    deal them anew to make zeros and NaNs equal."""
    c = F.col(f"`{f.name}`")
    if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
        return _plain(c, f.dataType).cast("string"), T.StringType()
    return c, f.dataType


def _bytes(fields: Sequence[T.StructField]) -> Column:
    """Bytes that the values of the rows take in a task's table, about."""
    total = F.count(F.lit(1)) * (len(fields) * (64 + 16 * len({_value(f)[1] for f in fields})))
    for f in fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ArrayType, T.StructType)):
            c = F.to_json(c)
        if _is_text(f.dataType) or isinstance(f.dataType, (T.BinaryType, T.ArrayType, T.StructType)):
            total = total + F.coalesce(F.sum(F.octet_length(c).cast("long")), F.lit(0))
    return total


def _dealt_distinct(df: DataFrame, fields: Sequence[T.StructField], parts: int) -> DataFrame:
    """One row, ``_nd<i>``: the distinct values of each column. Rows are dealt by their hash; each
    group of rows keeps one (column, value) of each, and these are dealt by value."""
    place = F.pmod(F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if _hashable(f.dataType)]), F.lit(8 * parts))
    kinds = list(dict.fromkeys(_value(f)[1] for f in fields))
    keys = ["_i", *[f"_v{k}" for k in range(len(kinds))]]
    entries = []
    for i, f in enumerate(fields):
        c, kind = _value(f)
        values = [(c if k == kind else F.lit(None).cast(k)).alias(f"_v{n}") for n, k in enumerate(kinds)]
        entries.append(F.when(F.col(f"`{f.name}`").isNotNull(), F.struct(F.lit(i).alias("_i"), *values)))
    rows = df.select(place.alias("_place"), *[F.col(f"`{f.name}`") for f in fields]).repartition(parts, "_place")
    some = rows.select("_place", F.inline(F.filter(F.array(*entries), lambda x: x.isNotNull()))).groupBy("_place", *keys).agg(F.count(F.lit(1)))
    values = some.select(*keys).repartition(parts, *keys).groupBy(*keys).agg(F.count(F.lit(1))).select("_i")
    return values.agg(*[F.count_if(F.col("_i") == i).alias(f"_nd{i}") for i in range(len(fields))])


def _exact_distinct(df: DataFrame, fields: Sequence[T.StructField], estimates: Sequence[int], size: int) -> DataFrame:
    parts = -(-size // TASK_BYTES)
    if sum(estimates) <= KEPT_VALUES or parts < 2 or not all(_hashable(f.dataType) for f in fields):
        return df.agg(*[F.count_distinct(F.col(f"`{f.name}`")).alias(f"_nd{i}") for i, f in enumerate(fields)])
    return _dealt_distinct(df, fields, parts)


def profile_columns(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = False, digits: int = 4) -> DataFrame:
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    if not fields:
        raise ValueError("no columns to profile")
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        aggs.append(F.count(c).alias(f"_nn{i}"))
        aggs.append(F.approx_count_distinct(c).alias(f"_nd{i}"))
        if _is_text(f.dataType):
            aggs += [F.min(F.length(c)).alias(f"_minl{i}"), F.max(F.length(c)).alias(f"_maxl{i}")]
        if _is_numeric(f.dataType):
            d = c.cast("double")
            aggs += [
                F.min(d).alias(f"_min{i}"), F.max(d).alias(f"_max{i}"),
                F.avg(d).alias(f"_avg{i}"), F.stddev_samp(d).alias(f"_sd{i}"),
            ]
    if exact:
        first = df.agg(*aggs, _bytes(fields).alias("_size"))
        found = first.first()
        estimates = [found[f"_nd{i}"] for i in range(len(fields))]
        known = df.sparkSession.createDataFrame([found], first.schema).drop("_size", *[f"_nd{i}" for i in range(len(fields))])
        wide = known.crossJoin(_exact_distinct(df, fields, estimates, found["_size"]))
    else:
        wide = df.agg(*aggs)

    def opt(name: str, present: bool, kind: str):
        return F.col(name).cast(kind) if present else F.lit(None).cast(kind)

    entries = []
    for i, f in enumerate(fields):
        text, num = _is_text(f.dataType), _is_numeric(f.dataType)
        entries.append(F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col("_rows").cast("long").alias("row_count"),
            (F.col("_rows") - F.col(f"_nn{i}")).cast("long").alias("null_count"),
            F.col(f"_nd{i}").cast("long").alias("distinct_count"),
            opt(f"_minl{i}", text, "long").alias("min_length"),
            opt(f"_maxl{i}", text, "long").alias("max_length"),
            opt(f"_min{i}", num, "double").alias("min_value"),
            opt(f"_max{i}", num, "double").alias("max_value"),
            F.round(opt(f"_avg{i}", num, "double"), digits).alias("mean_value"),
            F.round(opt(f"_sd{i}", num, "double"), digits).alias("stddev_value"),
        ))
    return wide.select(F.inline(F.array(*entries)))


# Values that a column's sketch tracks. The sketch's table has the next power of two above 4/3 of
# them, and a count is off by 3.5 / table size of the rows at most (frequent-items sketch).
TRACKED = 2048
_TABLE = 1 << (-(-TRACKED * 4 // 3) - 1).bit_length()
_ERROR = 3.5 / _TABLE


def _plain(c: Column, dtype: T.DataType) -> Column:
    return F.when(c == 0, F.lit(0).cast(dtype)).otherwise(c) if isinstance(dtype, (T.FloatType, T.DoubleType)) else c


def _as_text(c: Column, dtype: T.DataType) -> Column:
    return F.hex(c) if isinstance(dtype, T.BinaryType) else c.cast("string")


def _ranked(counts: DataFrame, name: str, k: int) -> DataFrame:
    """``counts`` (_v in its own type, n): the first k by count, then value."""
    top = counts.orderBy(F.col("n").desc(), F.col("_v").asc()).limit(k)  # k rows
    ranked = top.withColumn("rk", F.row_number().over(Window.orderBy(F.col("n").desc(), F.col("_v").asc())).cast("long"))
    return ranked.select(F.lit(name).alias("column_name"), F.col("_v").cast("string").alias("value"), "n", "rk")


def _counted_whole(df: DataFrame, name: str, k: int) -> DataFrame:
    c = F.col(f"`{name}`")
    return _ranked(df.where(c.isNotNull()).groupBy(c.alias("_v")).agg(F.count(F.lit(1)).alias("n")), name, k)


def _candidates(df: DataFrame, columns: Sequence[str], k: int) -> tuple[dict[str, list[int]], dict[str, float]]:
    """First scan: per column the hashes of the values that may be among the k most frequent, and
    the count that a value without such a hash does not exceed."""
    aggs = []
    for i, name in enumerate(columns):
        h = F.when(F.col(f"`{name}`").isNotNull(), F.xxhash64(F.col(f"`{name}`")))
        aggs += [F.call_function("approx_top_k", h, F.lit(TRACKED), F.lit(TRACKED)).alias(f"t{i}"), F.count(h).alias(f"n{i}")]
    row = df.agg(*aggs).first()  # TRACKED pairs of numbers per column at most
    hashes, bounds = {}, {}
    for i, name in enumerate(columns):
        error = _ERROR * row[f"n{i}"]
        found = [(x["item"], x["count"]) for x in row[f"t{i}"] or () if x["item"] is not None]  # in descending order; counts are upper bounds
        least = found[k - 1][1] - error if len(found) >= k else 0
        hashes[name] = [h for h, n in found if n >= least]
        # a value that is not listed has 2 * error rows at most: the sketch lists those whose lower
        # bound (its count less the error) is above the error
        bounds[name] = 2 * error if row[f"n{i}"] else 0.0
    return hashes, bounds


def top_values(df: DataFrame, columns: Sequence[str] | None = None, k: int = 3) -> DataFrame:
    """``column_name, value, n, rk``: the k most frequent values of each column, ties broken
    by the value in its own type order. Null values are not ranked."""
    columns = list(df.columns if columns is None else columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    hashes, bounds = _candidates(df, columns, k)
    entries = []
    for i, name in enumerate(columns):
        c = F.col(f"`{name}`")
        if hashes[name]:
            entries.append(F.when(F.xxhash64(c).isin(hashes[name]) & c.isNotNull(), F.struct(F.lit(i).alias("i"), _as_text(_plain(c, types[name]), types[name]).alias("v"))))
    parts = []
    if entries:
        path = scratch_path(df.sparkSession, "top_values")
        listed = df.select(F.explode(F.filter(F.array(*entries), lambda x: x.isNotNull())).alias("x")).groupBy("x.i", "x.v").agg(F.count(F.lit(1)).alias("n"))
        listed.write.parquet(path)
        listed = df.sparkSession.read.schema("i int, v string, n long").parquet(path)
        # the k-th count of each column: a row per column
        kth = {r[0]: r[1][k - 1] if len(r[1]) >= k else 0 for r in listed.groupBy("i").agg(F.slice(F.sort_array(F.collect_list("n"), asc=False), 1, k)).collect()}
    for i, name in enumerate(columns):
        if hashes[name] and kth.get(i, 0) > bounds[name]:
            v = F.unhex("v") if isinstance(types[name], T.BinaryType) else F.col("v").cast(types[name])
            parts.append(_ranked(listed.where(F.col("i") == i).select(v.alias("_v"), "n"), name, k))
        else:
            parts.append(_counted_whole(df, name, k))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
