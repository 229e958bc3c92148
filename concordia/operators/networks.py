"""Country graphs, heatmaps, similarity and policy networks of events, for all windows and modes in one pass.

An event is a row with ``ts`` (timestamp), ``countries``, ``topics``,
``country_pairs`` and ``weight`` (decimal). Sums for the nested trailing windows
are conditional sums of one grouped scan; windows and modes are spread out over
the few groups that remain, not over the events.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordia.config import EU, TOPICS, Thresholds
from concordia.functions import scalars as S
from concordia.operators.events import eu_countries

WINDOW_DAYS = (7, 30, 90)
#: Trailing windows in days, or numbered spans of ``ts``.
Windows = tuple[int, ...] | dict[int, Column]


def _start(now: str, days: int) -> Column:
    return F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {24 * int(days)} HOURS")


def periods(now: str, days: int, ts: str = "ts") -> dict[int, Column]:
    """Spans to take the place of trailing windows: 1 is the current period of ``days`` up to ``now`` and later, 2 the one before."""
    return {1: F.col(ts) >= _start(now, days), 2: (F.col(ts) >= _start(now, 2 * days)) & (F.col(ts) < _start(now, days))}


def _spans(now: str, windows: Windows) -> dict[int, Column]:
    return windows if isinstance(windows, dict) else {d: F.col("ts") >= _start(now, d) for d in windows}


def _windowed_sums(rows: DataFrame, keys: list[str], now: str, windows: Windows) -> DataFrame:
    """keys, ``window_days``, ``weight``: the sum of ``weight`` of rows with ``ts`` in each trailing window (or other span), groups without a row in it left out."""
    inside = _spans(now, windows)
    sums = rows.where(reduce(lambda a, b: a | b, inside.values())).groupBy(*keys).agg(*[F.sum(F.when(c, F.col("weight"))).alias(f"w{d}") for d, c in inside.items()])
    spread = F.explode(F.array(*[F.struct(F.lit(d).alias("window_days"), F.col(f"w{d}").alias("weight")) for d in inside]))
    return sums.select(*keys, spread.alias("s")).select(*keys, "s.window_days", "s.weight").where("weight IS NOT NULL")


def valid_pairs(events: DataFrame) -> DataFrame:
    """``ts``, ``source`` < ``target``, ``kind``, ``weight``: one row per well-formed pair of an event, repeats included, external-external ones left out."""
    pairs = events.select("ts", "weight", F.explode("country_pairs").alias("p")).where(F.size("p") == 2)
    a, b = F.col("p")[0], F.col("p")[1]
    pairs = pairs.where(a.isNotNull() & b.isNotNull() & (a != "") & (b != "") & (a != b))
    return pairs.select("ts", F.least(a, b).alias("source"), F.greatest(a, b).alias("target"), "weight").withColumn("kind", S.pair_type(F.col("source"), F.col("target"))).where("kind <> 'other'")


def graph_edges(events: DataFrame, now: str, windows: Windows = WINDOW_DAYS) -> DataFrame:
    """``window_days``, ``mode``, ``source``, ``target``, ``weight``."""
    sums = _windowed_sums(valid_pairs(events), ["source", "target", "kind"], now, windows)
    return sums.select("window_days", F.explode(S.pair_modes(F.col("kind"))).alias("mode"), "source", "target", F.round("weight", 2).cast("double").alias("weight"))


def graph_nodes(events: DataFrame, now: str, windows: Windows = WINDOW_DAYS) -> DataFrame:
    """``window_days``, ``mode``, ``country``, ``weight``: the summed weight of a country's pairs."""
    sums = _windowed_sums(valid_pairs(events), ["source", "target", "kind"], now, windows)
    ends = sums.select("window_days", F.explode(S.pair_modes(F.col("kind"))).alias("mode"), F.explode(F.array("source", "target")).alias("country"), "weight")
    return ends.groupBy("window_days", "mode", "country").agg(F.round(F.sum("weight"), 2).cast("double").alias("weight"))


def event_counts(events: DataFrame, now: str, windows: Windows = WINDOW_DAYS) -> DataFrame:
    """``window_days``, ``event_count``: all events of the window, whatever they add to a graph."""
    windows = _spans(now, windows)
    counts = events.agg(*[F.count_if(c).alias(f"n{d}") for d, c in windows.items()])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(d).alias("window_days"), F.col(f"n{d}").alias("event_count")) for d in windows])).alias("s")).select("s.*")


def mode_countries(countries: Column, pairs: Column) -> Column:
    """(mode, country) of an event: all its countries; its EU countries; the endpoints of its external pairs."""
    everyone = F.array_distinct(F.filter(S.text_array(countries), lambda c: c.isNotNull()))
    inner = F.filter(everyone, lambda c: S.is_eu(c))
    external = F.filter(F.coalesce(pairs, F.array().cast("array<array<string>>")), lambda p: (F.size(p) == 2) & (S.pair_type(F.try_element_at(p, F.lit(1)), F.try_element_at(p, F.lit(2))) == "external"))
    ends = F.array_distinct(F.filter(F.flatten(external), lambda c: c.isNotNull()))
    tag = lambda mode, xs: F.transform(xs, lambda c: F.struct(F.lit(mode).alias("mode"), c.alias("country")))
    return F.concat(tag("all", everyone), tag("internal", inner), tag("external", ends))


def heatmap_long(events: DataFrame, now: str, windows: Windows = WINDOW_DAYS, topics: list[str] | None = None) -> DataFrame:
    """``window_days``, ``mode``, ``country``, ``topic``, ``weight`` (unrounded decimal): summed event weights."""
    topics = topics or TOPICS
    kept = F.filter(S.text_array(F.col("topics")), lambda t: t.isin(topics))
    cells = events.select("ts", "weight", F.explode(mode_countries(F.col("countries"), F.col("country_pairs"))).alias("m"), kept.alias("topics"))
    cells = cells.select("ts", "weight", "m.mode", "m.country", F.explode("topics").alias("topic"))
    return _windowed_sums(cells, ["mode", "country", "topic"], now, windows)


def heatmap(events: DataFrame, now: str, windows: Windows = WINDOW_DAYS, topics: list[str] | None = None) -> DataFrame:
    """One row per ``window_days``, ``mode`` and ``country`` with a column per topic (0 where nothing) and ``total``, rounded to 3 digits."""
    topics = topics or TOPICS
    wide = heatmap_long(events, now, windows, topics).groupBy("window_days", "mode", "country").pivot("topic", topics).agg(F.sum("weight")).na.fill(0)
    total = sum((F.col(t) for t in topics), F.lit(0).cast(S.DEC))
    rounded = [F.round(F.coalesce(F.col(t), F.lit(0)), 3).cast("double").alias(t) for t in topics]
    return wide.select("window_days", "mode", "country", *rounded, F.round(total, 3).cast("double").alias("total"))


def normalize_rows(rows: DataFrame, topics: list[str] | None = None) -> DataFrame:
    """Heatmap cells as signed shares of the row's absolute sum, 6 digits; ``total`` is that sum."""
    topics = topics or TOPICS
    size = sum((F.abs(F.col(t)) for t in topics), F.lit(0.0))
    keep = [c for c in rows.columns if c not in (*topics, "total")]
    sized = rows.withColumn("_size", size)
    cells = [F.when(F.col("_size") > 0, S.exact_round(F.col(t) / F.col("_size"), 6)).otherwise(0.0).alias(t) for t in topics]
    return sized.select(*keep, *cells, S.exact_round(F.col("_size"), 6).alias("total"))


def similarity_edges(normalized: DataFrame, least: float = Thresholds().min_similarity, topics: list[str] | None = None) -> DataFrame:
    """``window_days``, ``mode``, ``source``, ``target``, ``weight``: cosine of normalised rows, 3 digits, from ``least`` on.

    The self-join is on window and mode; its sides hold a row per country, far below any size that matters.
    """
    rows = normalized.select("window_days", "mode", "country", F.array(*[F.col(t) for t in topics or TOPICS]).alias("v"))
    other = rows.select("window_days", "mode", F.col("country").alias("target"), F.col("v").alias("u"))
    pairs = rows.withColumnRenamed("country", "source").join(other, ["window_days", "mode"]).where("source < target")
    return pairs.withColumn("cos", S.cosine(F.col("v"), F.col("u"))).where(F.col("cos") >= least).select("window_days", "mode", "source", "target", S.exact_round(F.col("cos"), 3).alias("weight"))


# networks of one day, and policy networks

def country_edges(events: DataFrame) -> DataFrame:
    """EU pairs with the number of times they are listed (``weight``) and per topic (``topics``: map)."""
    pairs = events.select(F.explode("country_pairs").alias("p"), S.text_array(F.col("topics")).alias("topics")).where(F.size("p") == 2)
    pairs = pairs.select(F.least(F.col("p")[0], F.col("p")[1]).alias("source"), F.greatest(F.col("p")[0], F.col("p")[1]).alias("target"), "topics")
    pairs = pairs.where((F.col("source") != F.col("target")) & S.is_eu(F.col("source")) & S.is_eu(F.col("target")))
    # one row per pair and topic, and one without topic that counts the pair itself
    spread = pairs.select("source", "target", F.explode(F.concat(F.array(F.lit(None).cast("string")), F.col("topics"))).alias("topic"))
    counted = spread.groupBy("source", "target", "topic").agg(F.count(F.lit(1)).alias("n"))
    entry = F.when(F.col("topic").isNotNull(), F.struct("topic", "n"))
    return counted.groupBy("source", "target").agg(F.sum(F.when(F.col("topic").isNull(), F.col("n"))).alias("weight"), F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("topics"))


def country_nodes(events: DataFrame) -> DataFrame:
    """How many times each EU country is listed."""
    return events.select(F.explode("countries").alias("country")).where(S.is_eu(F.col("country"))).groupBy("country").agg(F.count(F.lit(1)).alias("weight"))


def policy_edges(events: DataFrame) -> DataFrame:
    """EU pairs with the number of topics both have events of. The self-join is over distinct (topic, country)."""
    seen = events.select(F.explode(S.text_array(F.col("topics"))).alias("topic"), eu_countries(F.col("countries")).alias("cs"))
    seen = seen.select("topic", F.explode("cs").alias("country")).distinct()
    a, b = seen.withColumnRenamed("country", "source"), seen.withColumnRenamed("country", "target")
    return a.join(b, "topic").where("source < target").groupBy("source", "target").agg(F.count(F.lit(1)).alias("weight"))


def policy_nodes(events: DataFrame) -> DataFrame:
    """Summed number of topics of a country's events."""
    rows = events.select(F.size(S.text_array(F.col("topics"))).alias("n"), F.explode(eu_countries(F.col("countries"))).alias("country"))
    return rows.groupBy("country").agg(F.sum("n").alias("weight"))


def snapshot(events: DataFrame) -> DataFrame:
    """One row: ``event_count``, ``nodes``, ``edges`` (arrays bounded by the number of countries)."""
    edges = country_edges(events).select(F.struct("source", "target", "weight", "topics").alias("e")).agg(F.array_sort(F.collect_list(F.struct(F.col("e.source").alias("source"), F.col("e.target").alias("target"), F.col("e.weight").alias("weight")))).alias("edges"))
    nodes = country_nodes(events).agg(F.array_sort(F.collect_list(F.struct(F.col("country").alias("id"), "weight"))).alias("nodes"))
    count = events.agg(F.count(F.lit(1)).alias("event_count"))
    return count.join(nodes).join(edges)  # one row each
