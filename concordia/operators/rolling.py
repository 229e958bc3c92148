"""Rolling totals over trailing periods by event-contribution deltas.

Each daily amount adds at its date and subtracts once it leaves a period; the
running sum of these deltas is the period's total. The sums exist only on days
on which something enters or leaves; the days between carry the value on, so
days without activity cost nothing until they are written out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_daily_amounts(rows: DataFrame, keys: Sequence[str], day: str, amount: Column, version: Sequence[str]) -> DataFrame:
    """One amount per key and day: that of the last version (later columns of ``version`` break ties), a null or NaN amount as 0.

    Rows with a null key or day take no part. The amount is kept in whole hundredths (``cents``), so all later sums are exact.
    """
    cents = F.coalesce(F.round(F.nanvl(amount, F.lit(0.0)) * 100).cast("long"), F.lit(0))
    known = rows.dropna(subset=[*keys, day])
    return known.groupBy(*keys, F.col(day).alias("day")).agg(F.max_by(cents, F.struct(*version)).alias("cents"))


def rolling_totals(daily: DataFrame, keys: Sequence[str], end_day: str, periods: Sequence[int] = (7, 30)) -> DataFrame:
    """``total_N`` (in hundredths) for each key, each day from the key's first to ``end_day``, and each trailing period of N days ending that day.

    ``daily``: keys, ``day``, ``cents``; at most one row per key and day, or several to be added up. Rows after end_day
    take no part. Also ``day_no``: 1 on the key's first day. An empty input gives an empty result.

    One shuffle: daily rows are exchanged by the keys once, before each is spread to its deltas; the sum per day and both windows use that partitioning. A key's group is bounded by the days in range,
    whatever the number of rows behind them.
    """
    end = F.lit(end_day).cast("date")
    used = daily.where(F.col("day") <= end).repartition(*keys)
    zero = F.lit(0).cast("long")
    steps = [F.struct(F.col("day").alias("day"), *[F.col("cents").alias(f"d{p}") for p in periods])]
    steps += [F.struct(F.date_add("day", p).alias("day"), *[(-F.col("cents") if q == p else zero).alias(f"d{q}") for q in periods]) for p in sorted(periods)]
    deltas = used.select(*keys, F.explode(F.array(*steps)).alias("s")).select(*keys, "s.*").where(F.col("day") <= end)
    by_day = deltas.groupBy(*keys, "day").agg(*[F.sum(f"d{p}").alias(f"d{p}") for p in periods])

    order = Window.partitionBy(*keys).orderBy("day")
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    levels = by_day.select(
        *keys, "day",
        *[F.sum(f"d{p}").over(running).alias(f"total_{p}") for p in periods],
        F.first("day").over(running).alias("first_day"),
        F.lead("day").over(order).alias("next_day"),
    )
    until = F.coalesce(F.date_sub("next_day", 1), end)
    return levels.withColumn("day", F.explode(F.sequence("day", until))).select(
        *keys, "day", (F.datediff("day", "first_day") + 1).alias("day_no"), *[f"total_{p}" for p in periods]
    )


def undirected(rows: DataFrame, a: str, b: str) -> DataFrame:
    """``rows`` with the smaller endpoint in ``a``; rows without two different endpoints left out."""
    lo, hi = F.least(a, b), F.greatest(a, b)
    return rows.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).withColumns({a: lo, b: hi})
