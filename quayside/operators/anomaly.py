"""Anomaly detection ("data quality ml") with robust statistics.

(a) ``volume_anomalies`` (and ``amount_anomalies`` for the daily sum of an amount):
    rows per day against the median and the median absolute
    deviation (MAD) of the daily counts; robust z-score ``0.6745 * (n - median) / MAD``.
    The daily counts are one grouped aggregate, checkpointed (one row per day); median and
    MAD are scalar subqueries over that small result, so the event table is scanned once.
(b) ``value_outliers``: rows outside the Tukey fences ``[q1 - k*IQR, q3 + k*IQR]`` of
    their group. Quartiles are exact by default (``quantiles.exact_quantiles``, which
    splits a hot group across tasks) or approximate (``method="approx"``); the quartile
    table (one row per group) is measured and joined back on the group key, broadcast only
    under a bound of its bytes (``broadcasts.small_side``).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators.broadcasts import small_side
from quayside.operators.quantiles import quantiles
from quayside.session import checkpoint_root

# The constant that makes the MAD comparable to a standard deviation for
# normal data, and the usual cut-offs for robust z-scores and Tukey fences.
MAD_SCALE = 0.6745
Z_THRESHOLD = 3.5
IQR_FACTOR = 1.5


def daily_counts(df: DataFrame, date_column: str) -> DataFrame:
    return df.groupBy(F.col(date_column).cast("string").alias("dt")).agg(F.count(F.lit(1)).alias("n"))


def volume_anomalies(df: DataFrame, date_column: str, threshold: float = Z_THRESHOLD, digits: int = 4) -> DataFrame:
    """``dt, n, score, is_anomaly`` for every day. When the MAD is 0 (most days equal) the
    score is null and every day off the median is an anomaly."""
    checkpoint_root(df.sparkSession)
    # One row per day, materialised once: the scalar subqueries below read this small
    # result instead of each re-scanning the fact table.
    return score_daily(daily_counts(df, date_column).checkpoint(eager=True), threshold, digits)


def score_daily(daily: DataFrame, threshold: float = Z_THRESHOLD, digits: int = 4, metric: str = "n", history: DataFrame | None = None) -> DataFrame:
    """Robust z-scores of a small per-day frame ``dt, <metric>`` (one row per day), by the
    median and MAD of ``history`` (a frame of other days) or, without one, of the days themselves."""
    m = F.col(metric)
    days = daily if history is None else history
    med = days.select(F.median(m)).scalar()
    mad = days.select(F.median(F.abs(m - med))).scalar()
    score = F.round(F.try_divide(F.lit(MAD_SCALE) * (m - med), mad), digits)
    flag = F.when(mad == 0, m != med).otherwise(F.abs(F.col("score")) > F.lit(threshold))
    return daily.select("dt", metric, score.alias("score")).withColumn("is_anomaly", flag)


def volume_against_history(daily: DataFrame, spark: SparkSession, table: str, date_column: str, dates: Sequence[str], threshold: float = Z_THRESHOLD, digits: int = 4, state_table: str | None = None) -> DataFrame:
    """Scores the days of a batch (``dt, n``) against the stored daily counts of ``table``, the
    batch's ``dates`` left out; against one another if the table holds no other day. With
    ``state_table`` (``state.update_state``) the counts come from there, a row per day, and no
    partition of ``table`` is read, but those of days that have no state yet (once)."""
    if state_table is not None and spark.catalog.tableExists(table):
        from quayside.operators.state import complete_state, daily_volumes

        complete_state(spark, table, state_table, date_column, but=dates)
        if spark.catalog.tableExists(state_table):
            kept = spark.table(state_table).where(~F.col(date_column).cast("string").isin([str(d) for d in dates]))
            history = daily_volumes(kept, date_column)
            if not history.isEmpty():
                return score_daily(daily, threshold, digits, history=history)
        return score_daily(daily, threshold, digits)
    if spark.catalog.tableExists(table) and date_column in spark.table(table).columns:
        checkpoint_root(spark)
        stored = spark.table(table).where(~F.col(date_column).cast("string").isin([str(d) for d in dates]))  # null dates drop out
        history = daily_counts(stored, date_column).checkpoint(eager=True)  # a row per day; reads no column
        if not history.isEmpty():
            return score_daily(daily, threshold, digits, history=history)
    return score_daily(daily, threshold, digits)


def amount_anomalies(df: DataFrame, date_column: str, amount_column: str, threshold: float = Z_THRESHOLD, digits: int = 4) -> DataFrame:
    """``dt, amount, score, is_anomaly``: the daily sum of ``amount_column`` against the
    median and MAD of the daily sums. The sum is exact (decimal(18,2), as control totals),
    then scored as a double."""
    checkpoint_root(df.sparkSession)
    daily = df.groupBy(F.col(date_column).cast("string").alias("dt")).agg(
        F.sum(F.col(f"`{amount_column}`").cast("decimal(18,2)")).cast("double").alias("amount")
    ).checkpoint(eager=True)
    return score_daily(daily.where(F.col("amount").isNotNull()), threshold, digits, metric="amount")


def value_outliers(df: DataFrame, groups: Sequence[str], value: str, k: float = IQR_FACTOR, method: str = "exact") -> DataFrame:
    """Rows of ``df`` outside their group's Tukey fences, with ``q1, q3``."""
    groups = list(groups)
    checkpoint_root(df.sparkSession)
    # One row per group, materialised once, then measured: broadcast to the rows only under a
    # proven bound; above it the join shuffles on the group key (AQE splits a hot group).
    q = quantiles(df, groups, value, [0.25, 0.75], method=method).withColumnsRenamed({"q0": "_q1", "q1": "_q3"})
    v = F.col(f"`{value}`")
    if groups:
        q = q.checkpoint(eager=True)
        joined, q1, q3 = df.join(small_side(q), groups), F.col("_q1"), F.col("_q3")
    else:  # one row of global quartiles: scalar subqueries, no join
        joined, q1, q3 = df, q.select("_q1").scalar(), q.select("_q3").scalar()
    iqr = q3 - q1
    return joined.where((v > q3 + F.lit(k) * iqr) | (v < q1 - F.lit(k) * iqr))
