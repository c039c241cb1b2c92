"""One pass over a source for the pre-load checks: quality rules, daily volume and the
column profile together.

A workflow's pre tasks each read the same source. Run separately that is one full parse
of the files per task. Here a single grouped aggregation per effective date collects
everything the three tasks need, as partial results that merge exactly (or as sketches
that merge):

- rows and per-rule failures per date (summed);
- per column: non-null count, an HLL sketch (``hll_sketch_agg``; unions of sketches
  estimate distinct counts over all dates), min/max, min/max length, and mean and
  population variance (merged with the parallel-variance formula);
- the per-date row counts are the daily volumes.

The per-date table (one row per date) is checkpointed once; the three results are small
queries over it.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.operators.anomaly import score_daily
from quayside.operators.profile import _is_numeric, _is_text, hashed
from quayside.operators.quality import Rule
from quayside.session import checkpoint_root

# Distinct counts of these profiles have a relative standard error of 5%, observed or grouped,
# for any number of columns: a sketch of a few hundred bytes per column and task. The stored
# daily state (``state.py``) has larger ones.
DISTINCT_RSD = 0.05
LG_K = 9  # 512 registers: 4.6%


@dataclass
class SourceChecks:
    quality: DataFrame  # rule_name, rule_type, column_name, checked_rows, failed_rows, passed
    daily: DataFrame  # dt, n, score, is_anomaly
    profile: DataFrame  # column_name, data_type, row_count, null_count, distinct_count, ... (approximate distinct)


def source_checks(df: DataFrame, date_column: str, rules: Sequence[Rule], columns: Sequence[str] | None = None, digits: int = 4) -> SourceChecks:
    checkpoint_root(df.sparkSession)
    fields = [f for f in df.schema.fields if (columns is None or f.name in columns) and f.name != date_column]
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.count_if(r.failing()).alias(f"f{i}") for i, r in enumerate(rules)]
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        aggs += [F.count(c).alias(f"nn{i}"), F.hll_sketch_agg(hashed(c), F.lit(LG_K)).alias(f"h{i}")]
        if _is_text(f.dataType):
            aggs += [F.min(F.length(c)).alias(f"minl{i}"), F.max(F.length(c)).alias(f"maxl{i}")]
        if _is_numeric(f.dataType):
            d = c.cast("double")
            aggs += [F.min(d).alias(f"min{i}"), F.max(d).alias(f"max{i}"), F.avg(d).alias(f"avg{i}"), F.var_pop(d).alias(f"vp{i}")]
    per_date = (
        df.groupBy(F.col(date_column).cast("string").alias("dt")).agg(*aggs).checkpoint(eager=True)
    )  # one row per date

    # Quality: sums over dates.
    q = per_date.agg(F.sum("n").alias("_checked"), *[F.sum(f"f{i}").alias(f"_f{i}") for i in range(len(rules))])
    entries = F.array(*[
        F.struct(
            F.lit(r.name).alias("rule_name"), F.lit(r.kind).alias("rule_type"),
            F.lit(r.column).cast("string").alias("column_name"),
            F.col("_checked").cast("long").alias("checked_rows"), F.col(f"_f{i}").cast("long").alias("failed_rows"),
        )
        for i, r in enumerate(rules)
    ])
    quality = q.select(F.inline(entries)).withColumn("passed", F.col("failed_rows") == 0) if rules else None

    # Daily volume: the per-date row counts, scored as in volume_anomalies.
    daily = score_daily(per_date.select("dt", F.col("n").cast("long").alias("n")).where(F.col("dt").isNotNull()), digits=digits)

    # Profile: merge partials. Weighted means, and M2 = sum(n_d * var_d) + sum(n_d * (mean_d - mean)^2).
    everything = Window.partitionBy()  # over the per-date table: one row per date
    merged = per_date
    prof_aggs = [F.sum("n").alias("_rows")]
    for i, f in enumerate(fields):
        prof_aggs += [F.sum(f"nn{i}").alias(f"_nn{i}"), F.hll_sketch_estimate(F.hll_union_agg(f"h{i}")).alias(f"_nd{i}")]
        if _is_text(f.dataType):
            prof_aggs += [F.min(f"minl{i}").alias(f"_minl{i}"), F.max(f"maxl{i}").alias(f"_maxl{i}")]
        if _is_numeric(f.dataType):
            mean = F.sum(F.col(f"nn{i}") * F.col(f"avg{i}")).over(everything) / F.sum(f"nn{i}").over(everything)
            merged = merged.withColumn(f"gm{i}", mean)
            prof_aggs += [
                F.min(f"min{i}").alias(f"_min{i}"), F.max(f"max{i}").alias(f"_max{i}"), F.first(f"gm{i}", ignorenulls=True).alias(f"_avg{i}"),
                (F.sum(F.col(f"nn{i}") * F.col(f"vp{i}")) + F.sum(F.col(f"nn{i}") * F.pow(F.col(f"avg{i}") - F.col(f"gm{i}"), 2))).alias(f"_m2{i}"),
            ]
    wide = merged.agg(*prof_aggs)

    def opt(name, present, kind):
        return F.col(name).cast(kind) if present else F.lit(None).cast(kind)

    rows = []
    for i, f in enumerate(fields):
        text, num = _is_text(f.dataType), _is_numeric(f.dataType)
        sd = F.sqrt(F.try_divide(F.col(f"_m2{i}"), F.col(f"_nn{i}") - 1)) if num else F.lit(None)
        rows.append(F.struct(
            F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col("_rows").cast("long").alias("row_count"),
            (F.col("_rows") - F.col(f"_nn{i}")).cast("long").alias("null_count"),
            F.col(f"_nd{i}").cast("long").alias("distinct_count"),
            opt(f"_minl{i}", text, "long").alias("min_length"), opt(f"_maxl{i}", text, "long").alias("max_length"),
            opt(f"_min{i}", num, "double").alias("min_value"), opt(f"_max{i}", num, "double").alias("max_value"),
            F.round(opt(f"_avg{i}", num, "double"), digits).alias("mean_value"),
            F.round(sd.cast("double"), digits).alias("stddev_value"),
        ))
    profile = wide.select(F.inline(F.array(*rows)))
    return SourceChecks(quality=quality, daily=daily, profile=profile)


# --------------------------------------------------------------------------- during the load
#
# When the pre tasks do not gate the load, their aggregates need no pass of their own:
# they are attached to the load's write as observed metrics, next to the per-date source
# counts, and the source is parsed once for the whole workflow. Observed metrics reach the
# driver as one partial buffer per task, so they are kept fixed-size and small: counts,
# min/max, mean and variance, and for distinct counts a HyperLogLog++ sketch of a few
# hundred bytes (``DISTINCT_RSD``).

_PREFIX = "pc_"


class ObservedChecks:
    """Quality rules and column profile of a source, as aggregate expressions for
    ``DataFrame.observe``; the per-date volumes come from the load's own date counts."""

    def __init__(self, fields: Sequence[T.StructField], rules: Sequence[Rule]):
        self.fields = list(fields)
        self.rules = list(rules)

    def exprs(self) -> list:
        p = _PREFIX
        out = [F.count(F.lit(1)).alias(f"{p}n")]
        out += [F.count_if(r.failing()).alias(f"{p}f{i}") for i, r in enumerate(self.rules)]
        for i, f in enumerate(self.fields):
            c = F.col(f"`{f.name}`")
            out += [F.count(c).alias(f"{p}nn{i}"), F.approx_count_distinct(c, DISTINCT_RSD).alias(f"{p}nd{i}")]
            if _is_text(f.dataType):
                out += [F.min(F.length(c)).alias(f"{p}minl{i}"), F.max(F.length(c)).alias(f"{p}maxl{i}")]
            if _is_numeric(f.dataType):
                d = c.cast("double")
                out += [F.min(d).alias(f"{p}min{i}"), F.max(d).alias(f"{p}max{i}"),
                        F.avg(d).alias(f"{p}avg{i}"), F.stddev_samp(d).alias(f"{p}sd{i}")]
        return out

    def results(self, spark, metrics: dict, per_date: dict, digits: int = 4, score=None) -> SourceChecks:
        """The three task results from the observed metrics and the per-date source counts
        (dates without rows are left out, as in the grouped pass)."""
        m = {k[len(_PREFIX):]: v for k, v in metrics.items() if k.startswith(_PREFIX)}
        n = int(m["n"])
        quality = spark.createDataFrame(
            [(r.name, r.kind, r.column, n, int(m[f"f{i}"]), int(m[f"f{i}"]) == 0) for i, r in enumerate(self.rules)],
            "rule_name string, rule_type string, column_name string, checked_rows long, failed_rows long, passed boolean",
        ) if self.rules else None
        daily = (score or (lambda x: score_daily(x, digits=digits)))(spark.createDataFrame(
            sorted((d, int(c)) for d, c in per_date.items() if d is not None and c), "dt string, n long"
        ))

        def rnd(v):
            return None if v is None else round(float(v), digits)

        rows = []
        for i, f in enumerate(self.fields):
            text, num = _is_text(f.dataType), _is_numeric(f.dataType)
            rows.append((
                f.name, f.dataType.simpleString(), n, n - int(m[f"nn{i}"]), int(m[f"nd{i}"]),
                m.get(f"minl{i}") if text else None, m.get(f"maxl{i}") if text else None,
                m.get(f"min{i}") if num else None, m.get(f"max{i}") if num else None,
                rnd(m.get(f"avg{i}")) if num else None, rnd(m.get(f"sd{i}")) if num else None,
            ))
        from quayside.operators.profile import PROFILE_SCHEMA

        profile = spark.createDataFrame(rows, PROFILE_SCHEMA)
        return SourceChecks(quality=quality, daily=daily, profile=profile)
