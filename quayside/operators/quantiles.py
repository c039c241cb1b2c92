"""Exact per-group quantiles that stay distributed when one group, or one value, holds most rows.

Spark's exact ``percentile`` keeps every distinct value of a group in one aggregation
buffer, so a hot group lands whole in one task. Here quantiles are found by weighted selection:

1. rows become ``(group, value, n)``, combined on every task before the shuffle: a value with a
   third of all rows is one row per task;
2. the distinct pairs are range-partitioned (sampled boundaries, so a hot group spans many
   partitions) and sorted, and each partition counts up its weights, in a stream; this is written
   once and read below (partition numbers must not change between reads);
3. the counts of each (group, partition) block - a small table - give every block's first rank,
   and so the block of each wanted rank: for a probability ``p`` the two ranks that bracket
   ``p * (n - 1)`` (linear interpolation, as ``percentile_cont`` / ``quantile_cont``);
4. in a block, the row whose cumulated count passes the wanted rank is fetched by an equi-join on
   (partition, group), and the two ends are interpolated.

``method="approx"`` uses ``percentile_approx`` (a mergeable fixed-size sketch) instead.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.operators.broadcasts import small_side
from quayside.session import scratch_path


def _names(probs: Sequence[float]) -> list[str]:
    return [f"q{i}" for i in range(len(probs))]


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ranked_weights(df: DataFrame, groups: Sequence[str], value: str, partitions: int | None = None) -> DataFrame:
    """``<groups>, _v, _n, _pid, _cum``: the distinct values with their counts, sorted within the
    partitions of a range shuffle, and the count up to and with each row inside its partition."""
    keys = list(groups) or ["_all"]
    cols = [F.col(f"`{c}`").alias(c) for c in groups] or [F.lit(0).alias("_all")]
    base = df.select(*cols, F.col(f"`{value}`").cast("double").alias("_v")).where(F.col("_v").isNotNull())
    n_parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    weights = base.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n"))
    # the range shuffle samples its input: without this the source would be read again for that
    ranged = _stored(weights, "quantile_weights").repartitionByRange(n_parts, *[F.col(c) for c in keys], F.col("_v")).sortWithinPartitions(*keys, "_v")

    def count_up(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        pid, done = TaskContext.get().partitionId(), 0
        for batch in batches:
            cum = done + np.cumsum(batch.column(batch.num_columns - 1).to_numpy())
            done = int(cum[-1]) if len(cum) else done
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(batch), pid, np.int32)), pa.array(cum, pa.int64())], names=[*batch.schema.names, "_pid", "_cum"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema.fields)
    return _stored(ranged.mapInArrow(count_up, f"{schema}, _pid int, _cum long"), "quantile_ranks")


def exact_quantiles(df: DataFrame, groups: Sequence[str], value: str, probs: Sequence[float], partitions: int | None = None) -> DataFrame:
    """``<groups>, q0, q1, ...`` (doubles) for the given probabilities."""
    keys = list(groups) or ["_all"]
    ranked = ranked_weights(df, groups, value, partitions)

    def same(a: str, b: str) -> list:
        return [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in keys]

    def keep(a: str) -> list:
        return [F.col(f"{a}.{c}").alias(c) for c in keys]

    # Blocks: rows per (partition, group) and the rank each starts at inside its group. Range
    # partitions hold contiguous (group, value) ranges, so there are at most partitions + groups.
    grp = Window.partitionBy(*keys)
    blocks = ranked.groupBy("_pid", *keys).agg(F.sum("_n").alias("_bn"), F.min(F.col("_cum") - F.col("_n")).alias("_first"))
    blocks = _stored(blocks.select(
        "_pid", *keys, "_bn", "_first",
        F.coalesce(F.sum("_bn").over(grp.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"),
        F.sum("_bn").over(grp).alias("_total"),
    ), "quantile_blocks")

    # Wanted ranks: floor and ceil of p * (n - 1) for every probability.
    per_prob = F.array(*[F.struct(F.lit(i).alias("qi"), F.lit(float(p)).alias("p")) for i, p in enumerate(probs)])
    wanted = (
        blocks.where("_start = 0").select(*keys, "_total", F.inline(per_prob))
        .withColumn("_pos", F.col("p") * (F.col("_total") - 1))
        .withColumn("_lo", F.floor("_pos").cast("long"))
        .withColumn("_hi", F.ceil("_pos").cast("long"))
    )
    ranks = wanted.select(*keys, F.explode(F.array("_lo", "_hi")).alias("_rank")).dropDuplicates(keys + ["_rank"])
    located = _stored(ranks.alias("r").join(
        blocks.alias("b"),
        same("r", "b") + [F.col("r._rank") >= F.col("b._start"), F.col("r._rank") < F.col("b._start") + F.col("b._bn")],
    ).select(*keep("r"), F.col("r._rank").alias("_rank"), F.col("b._pid").alias("_pid"),
             (F.col("b._first") + F.col("r._rank") - F.col("b._start")).alias("_at")), "quantile_located")

    # At most two rows per group and probability; broadcast only if their bytes are few.
    place = [F.col("x._pid") == F.col("w._pid"), F.col("w._at") >= F.col("x._cum") - F.col("x._n"), F.col("w._at") < F.col("x._cum")]
    picked = ranked.alias("x").join(small_side(located).alias("w"), same("x", "w") + place).select(*keep("w"), F.col("w._rank").alias("_rank"), F.col("x._v").alias("_v"))

    # Both bracketing values of every (group, probability) in one join and one aggregate.
    ends = wanted.select(*keys, "qi", "_pos", "_lo", F.explode(F.array("_lo", "_hi")).alias("_rank"),
                         (F.col("_hi") != F.col("_lo")).alias("_two"))
    res = (
        ends.alias("w").join(picked.alias("a"), same("w", "a") + [F.col("w._rank") == F.col("a._rank")])
        .groupBy(*keep("w"), F.col("w.qi").alias("qi"))
        .agg(F.first("w._pos").alias("_pos"), F.first("w._lo").alias("_lo"),
             F.max(F.when(F.col("w._rank") == F.col("w._lo"), F.col("a._v"))).alias("_vlo"),
             F.max(F.when((F.col("w._rank") != F.col("w._lo")) | ~F.col("w._two"), F.col("a._v"))).alias("_vhi"))
    )
    q = F.col("_vlo") + (F.col("_pos") - F.col("_lo")) * (F.col("_vhi") - F.col("_vlo"))
    out = res.groupBy(*keys).agg(*[F.max(F.when(F.col("qi") == i, q)).alias(n) for i, n in enumerate(_names(probs))])
    return out.drop("_all") if not groups else out


def approx_quantiles(df: DataFrame, groups: Sequence[str], value: str, probs: Sequence[float], accuracy: int = 10000) -> DataFrame:
    qs = F.percentile_approx(F.col(f"`{value}`").cast("double"), list(probs), accuracy)
    out = df.groupBy(*groups).agg(qs.alias("_qs"))
    return out.select(*groups, *[F.col("_qs")[i].alias(n) for i, n in enumerate(_names(probs))])


def quantiles(df: DataFrame, groups: Sequence[str], value: str, probs: Sequence[float], method: str = "exact") -> DataFrame:
    if method == "exact":
        return exact_quantiles(df, groups, value, probs)
    if method == "approx":
        return approx_quantiles(df, groups, value, probs)
    raise ValueError(f"unknown quantile method {method!r}")
