"""Daily indicator series: moving average, rolling slope, fitted line, forecast.

Series are keyed, so many run at once; windows are by row, within a key. A
series without a key would need one task for all its rows, which a daily
indicator (a row a day) can afford.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from concordia.functions.scalars import exact_round


def with_metrics(series: DataFrame, keys: Sequence[str], day: str, value: str, average_rows: int = 7, slope_rows: int = 14) -> DataFrame:
    """``value_ma`` (mean of the trailing rows, 2 digits) and ``trend_slope`` (least squares over the trailing rows, 4 digits, 0 for a single row)."""
    order = Window.partitionBy(*keys).orderBy(day)
    numbered = series.withColumn("_n", F.row_number().over(order).cast("double"))
    mean = F.avg(value).over(order.rowsBetween(1 - average_rows, 0))
    slope = F.coalesce(F.regr_slope(F.col(value), F.col("_n")).over(order.rowsBetween(1 - slope_rows, 0)), F.lit(0.0))
    return numbered.withColumns({"value_ma": exact_round(mean, 2), "trend_slope": exact_round(slope, 4)}).drop("_n")


def fitted(series: DataFrame, keys: Sequence[str], day: str, value: str) -> DataFrame:
    """Per key: ``n``, ``slope``, ``intercept`` over row numbers from 0, ``last_day``, ``last_value``. A single row fits as its value."""
    rows = series.withColumn("_n", (F.row_number().over(Window.partitionBy(*keys).orderBy(day)) - 1).cast("double"))
    fit = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.regr_slope(F.col(value), F.col("_n")), F.lit(0.0)).alias("slope"),
        F.coalesce(F.regr_intercept(F.col(value), F.col("_n")), F.max(value)).alias("intercept"), F.max(day).alias("last_day"), F.max_by(value, day).alias("last_value"),
    )
    return fit


def trend_line(series: DataFrame, keys: Sequence[str], day: str, value: str) -> DataFrame:
    """The series with ``trend`` (2 digits), the fitted line over all its rows."""
    rows = series.withColumn("_n", (F.row_number().over(Window.partitionBy(*keys).orderBy(day)) - 1).cast("double"))
    fit = fitted(series, keys, day, value).select(*keys, "slope", "intercept")
    joined = rows.join(fit, list(keys)) if keys else rows.crossJoin(fit)  # one row of fit
    return joined.withColumn("trend", exact_round(F.col("intercept") + F.col("slope") * F.col("_n"), 2)).drop("_n", "slope", "intercept")


def forecast(series: DataFrame, keys: Sequence[str], day: str, value: str, days: int = 3) -> DataFrame:
    """keys, ``day``, ``forecast`` (2 digits) for the days after the last one; nothing for an empty series."""
    fit = fitted(series, keys, day, value)
    ahead = fit.withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(days))))
    return ahead.select(*keys, F.date_add("last_day", F.col("i")).alias("day"), exact_round(F.col("intercept") + F.col("slope") * (F.col("n") + F.col("i") - 1), 2).alias("forecast"))
