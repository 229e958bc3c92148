"""Reports: top movers, topic moves, counters, and the text templates over them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concordia import texts
from concordia.config import LAYER_LABELS, MODE_LABELS, STATUS_LABELS, TOPIC_LABELS
from concordia.functions import scalars as S
from concordia.functions.text import label_map, signed
from concordia.operators import timeseries
from concordia.operators.events import upsert


def top_rows(rows: DataFrame, scope: Sequence[str], order: Sequence[Column], n: int, kind: str) -> DataFrame:
    """The first ``n`` rows of each scope, marked ``kind`` and numbered in ``place``; the order must be total. Reports read tables of a row per country or pair."""
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(*scope).orderBy(*order))).where(F.col("place") <= n).withColumn("kind", F.lit(kind))


def pair_moves(changes: DataFrame, scope: Sequence[str], n: int = 8) -> DataFrame:
    """Strongest moves, gained, lost, improved and declined pairs, ``n`` each; equal ones in the order of ``ordinal``."""
    at = F.col("ordinal")
    parts = [
        top_rows(changes, scope, [F.desc(F.abs("delta")), at], n, "strongest"),
        *[top_rows(changes.where(F.col("status") == s), scope, [at], n, s) for s in ("gained", "lost")],
        top_rows(changes.where("status = 'improved'"), scope, [F.desc("delta"), at], n, "improved"),
        top_rows(changes.where("status = 'declined'"), scope, [F.col("delta"), at], n, "declined"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def country_moves(countries: DataFrame, scope: Sequence[str], n: int = 8) -> DataFrame:
    """Countries by size of the change of their average and of their count, improving ones and declining ones, ``n`` each."""
    base = [F.desc(F.abs("average_delta")), F.col("country")]
    score = top_rows(countries, scope, base, n, "score")
    network = top_rows(countries, scope, [F.desc(F.abs("count_delta")), *base], n, "network")
    up = top_rows(countries.where("average_delta > 0"), scope, [F.desc("average_delta"), F.col("country")], n, "improving")
    down = top_rows(countries.where("average_delta < 0"), scope, [F.col("average_delta"), F.col("country")], n, "declining")
    return score.unionByName(network).unionByName(up).unionByName(down)


def topic_moves(changes: DataFrame, n: int = 8, examples: int = 5) -> DataFrame:
    """``topic``, its label, ``absolute_delta_total`` (3 digits), the ``examples`` largest changes of countries and ``place``; the ``n`` topics with the largest totals."""
    top = F.slice(F.array_sort(F.collect_list(F.struct((-F.abs("delta")).alias("k"), F.col("country"), F.col("delta")))), 1, examples)
    totals = changes.groupBy("topic").agg(F.sum(F.abs("delta").cast("decimal(18,3)")).cast("double").alias("absolute_delta_total"), top.alias("t"))
    rows = totals.select("topic", label_map(TOPIC_LABELS, F.col("topic")).alias("topic_label"), "absolute_delta_total", F.transform("t", lambda x: F.struct(x["country"].alias("country"), x["delta"].alias("delta"))).alias("examples"))
    return top_rows(rows, [], [F.desc("absolute_delta_total"), F.col("topic")], n, "topic").drop("kind")


def country_topic_shifts(changes: DataFrame, n: int = 12) -> DataFrame:
    """The topic with the largest change of each country; the ``n`` largest of these."""
    top = changes.groupBy("country").agg(F.min_by(F.struct("topic", "current", "previous", "delta"), F.struct((-F.abs("delta")).alias("k"), F.col("topic"))).alias("s"))
    return top.select("country", "s.*").orderBy(F.desc(F.abs("delta")), "country").limit(n)


def counters(events: DataFrame, sources: int = 10, topics: int = 10, countries: int = 15) -> DataFrame:
    """``what``, ``value``, ``n``: events with topics, with countries and with both, and the most frequent sources, topics and countries."""
    has_t, has_c = F.size(S.text_array(F.col("topics"))) > 0, F.size(S.text_array(F.col("countries"))) > 0
    flags = events.agg(F.count(F.lit(1)).alias("events"), F.count_if(has_t).alias("with_topics"), F.count_if(has_c).alias("with_countries"), F.count_if(has_t & has_c).alias("relevant"))
    out = flags.select(F.explode(F.array(*[F.struct(F.lit("events").alias("what"), F.lit(k).alias("value"), F.col(k).alias("n")) for k in flags.columns])).alias("s")).select("s.*")
    for what, rows, n in (
        ("source", events.select(F.coalesce("source_name", F.lit("")).alias("value")), sources),
        ("topic", events.select(F.explode(S.text_array(F.col("topics"))).alias("value")).where("value IS NOT NULL"), topics),
        ("country", events.select(F.explode(S.text_array(F.col("countries"))).alias("value")).where("value IS NOT NULL"), countries),
    ):
        out = out.unionByName(rows.groupBy("value").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value").limit(n).select(F.lit(what).alias("what"), "value", "n"))
    return out


def coded_counters(rows: DataFrame) -> DataFrame:
    """One row of counts over coded export rows: mapped actors and places, rows with any country, with a pair, and relevant ones."""
    a, b, c = (S.coded_country(F.col(x)) for x in ("Actor1CountryCode_raw", "Actor2CountryCode_raw", "ActionGeo_CountryCode_raw"))
    found = S.sorted_set(F.array(a, b, c))
    eu = F.exists(found, lambda x: S.is_eu(x))
    return rows.agg(
        F.count(F.lit(1)).alias("rows_total"), F.count_if(a.isNotNull()).alias("actor1_mapped"), F.count_if(b.isNotNull()).alias("actor2_mapped"), F.count_if(c.isNotNull()).alias("place_mapped"),
        F.count_if(F.size(found) > 0).alias("with_country"), F.count_if(F.size(found) >= 2).alias("with_pair"), F.count_if((F.size(found) >= 2) & eu).alias("relevant"),
        F.count_if((F.size(found) >= 2) & eu).alias("events_built"),
    )


def partner_map(country_row: DataFrame) -> DataFrame:
    """``partner``, ``current``, ``delta``, ``status`` of a country's lists; of a partner in several lists the last list counts (improved, declined, top_changes, gained, lost)."""
    lists = ["improved", "declined", "top_changes", "gained", "lost"]
    tagged = F.flatten(F.array(*[F.transform(F.coalesce(F.col(x), F.array().cast(country_row.schema[x].dataType)), lambda e, i=i: F.struct(F.lit(i).alias("rank"), e["partner"].alias("partner"), e["current_score"].alias("current"), e["delta"].alias("delta"), e["status"].alias("status"))) for i, x in enumerate(lists)]))
    rows = country_row.select(F.explode(tagged).alias("e")).select("e.*").where(F.coalesce("partner", F.lit("")) != "")
    return rows.groupBy("partner").agg(F.max_by(F.struct("current", "delta", "status"), "rank").alias("s")).select("partner", "s.*")


def focus(partners: DataFrame, codes: Sequence[str]) -> DataFrame:
    """The named partners in their order (``place``), status ``missing`` where there is none, with the averages over those present."""
    spark = partners.sparkSession
    wanted = spark.createDataFrame([(c, i) for i, c in enumerate(codes)], "partner string, place int")
    rows = wanted.join(partners, "partner", "left").withColumn("status", F.coalesce("status", F.lit("missing")))
    means = rows.agg(S.exact_round(F.avg("current"), 2).alias("average_current"), S.exact_round(F.avg("delta"), 2).alias("average_delta"))
    return rows.crossJoin(means)  # one row of averages


# texts

def _way(c: Column, words: dict[str, str]) -> Column:
    return F.when(c > 0, words["up"]).when(c < 0, words["down"]).otherwise(words["flat"])


def country_lines(items: DataFrame, scope: Sequence[str], n: int = 5) -> DataFrame:
    """scope, ``place``, ``country``, ``line``: what became of the first ``n`` countries of :func:`country_moves` (kind score)."""
    line = F.format_string(texts.COUNTRY, "country", _way(F.col("average_delta"), texts.COUNTRY_DIRECTION), "average_previous", "average_current", signed(F.col("average_delta")), _way(F.col("count_delta"), texts.COUNTRY_NETWORK))
    return items.where((F.col("kind") == "score") & (F.col("place") <= n)).select(*scope, "place", "country", line.alias("line"))


def pair_lines(items: DataFrame, scope: Sequence[str], n: int = 5) -> DataFrame:
    """scope, ``place``, ``source``, ``target``, ``line``: what became of the first ``n`` pairs of :func:`pair_moves` (kind strongest)."""
    line = F.format_string(texts.PAIR, "source", "target", label_map(STATUS_LABELS, F.col("status")), "previous_score", "current_score", signed(F.col("delta")))
    return items.where((F.col("kind") == "strongest") & (F.col("place") <= n)).select(*scope, "place", "source", "target", line.alias("line"))


def topic_lines(topics: DataFrame, n: int = 5, examples: int = 3) -> DataFrame:
    """``place``, ``topic``, ``line`` for the first ``n`` of :func:`topic_moves`."""
    named = F.array_join(F.transform(F.slice("examples", 1, examples), lambda x: F.concat(x["country"], F.lit(" ("), signed(x["delta"], 3), F.lit(")"))), ", ")
    return topics.where(F.col("place") <= n).select("place", "topic", F.format_string(texts.TOPIC, "topic_label", named).alias("line"))


def method_note(layer: str) -> str:
    return texts.METHOD_VOTES if layer == "votes" else texts.METHOD_EVENTS


def executive_summary(layer: str, window: str, modes: DataFrame, countries: DataFrame, pairs: DataFrame, topics: DataFrame | None = None) -> DataFrame:
    """``mode``, ``executive_summary`` for each mode of ``modes``, from the first country, pair and topic (of :func:`country_moves`, :func:`pair_moves`, :func:`topic_moves`); what there is none of is left out."""
    first = lambda d, kind: d.where((F.col("kind") == kind) & (F.col("place") == 1))
    c = first(countries, "score").select("mode", F.format_string(texts.LEAD_COUNTRY, "country", signed(F.col("average_delta")), _way(F.col("average_delta"), texts.DIRECTION)).alias("c"))
    p = first(pairs, "strongest").select("mode", F.format_string(texts.LEAD_PAIR, "source", "target", signed(F.col("delta"))).alias("p"))
    out = modes.join(c, "mode", "left").join(p, "mode", "left")
    if topics is not None:
        out = out.join(topics.where("place = 1").select(F.format_string(texts.LEAD_TOPIC, "topic_label").alias("t")), how="left")  # one row at most
    else:
        out = out.withColumn("t", F.lit(None).cast("string"))
    lead = F.format_string(texts.LEAD, F.lit(LAYER_LABELS.get(layer, layer)), F.lit(window), label_map(MODE_LABELS, F.col("mode")))
    rest = F.coalesce(F.nullif(F.concat_ws(" ", "c", "p", "t"), F.lit("")), F.lit(texts.LEAD_STABLE))
    return out.select("mode", F.concat_ws(" ", lead, rest).alias("executive_summary"))


def report(layer: str, window: str, changes: DataFrame, countries: DataFrame, topic_changes: DataFrame | None = None) -> DataFrame:
    """One row per mode that has changes: ``executive_summary``, ``method_note`` and the sections as arrays in order, of at most eight entries each.

    ``changes`` and ``countries``: as of :func:`relationship.pair_changes` and :func:`relationship.country_changes`; ``topic_changes`` as of :func:`votes.topic_changes`.
    """
    scope = ["mode"]
    c, p = country_moves(countries, scope), pair_moves(changes, scope)
    t = topic_moves(topic_changes) if topic_changes is not None else None
    out = executive_summary(layer, window, changes.select("mode").distinct(), c, p, t)

    def listed(rows: DataFrame, name: str, *columns: str) -> DataFrame:
        ordered = F.array_sort(F.collect_list(F.struct("place", *columns)))  # at most as many as places
        return rows.groupBy(*[k for k in scope if k in rows.columns]).agg(F.transform(ordered, lambda x: F.struct(*[x[k].alias(k) for k in columns])).alias(name))

    score, pair = ("country", "average_current", "average_previous", "average_delta", "count_delta"), ("source", "target", "current_score", "previous_score", "delta", "status")
    for rows, name, columns in (
        (c.where("kind = 'score'"), "country_items", score), (country_lines(c, scope), "country_lines", ("country", "line")), (p.where("kind = 'strongest'"), "pair_items", pair),
        (pair_lines(p, scope), "pair_lines", ("source", "target", "line")), (p.where("kind = 'gained'"), "gained_pairs", pair), (p.where("kind = 'lost'"), "lost_pairs", pair),
    ):
        out = out.join(listed(rows, name, *columns), "mode", "left")
    if t is not None:
        out = out.crossJoin(listed(t, "topic_items", "topic", "topic_label", "absolute_delta_total", "examples")).crossJoin(listed(topic_lines(t), "topic_lines", "topic", "line"))  # one row each
    return out.withColumns({"layer": F.lit(layer), "layer_label": F.lit(LAYER_LABELS.get(layer, layer)), "window": F.lit(window), "mode_label": label_map(MODE_LABELS, F.col("mode")), "method_note": F.lit(method_note(layer))})


def _one(rows: DataFrame, order: Sequence[Column], text: Column, name: str) -> DataFrame:
    """One row with ``name``: the text of the first row by ``order``, or that there is nothing."""
    return rows.select(F.struct(*[o.alias(f"k{i}") for i, o in enumerate(order)]).alias("k"), text.alias("t")).agg(F.coalesce(F.min_by("t", "k"), F.lit(texts.NOTHING)).alias(name))


def weekly_insight(countries: DataFrame, pairs: DataFrame, topics: DataFrame) -> DataFrame:
    """One row: the first country, pair and topic of a report's items, and the strongest approach and parting among its pairs, as texts."""
    c, p = countries.where("kind = 'score'"), pairs.where("kind = 'strongest'")
    delta, place = F.col("delta"), F.col("place")
    parts = [
        _one(c, [place], F.format_string(texts.TOP_COUNTRY, "country", S.trend_label(F.col("average_delta")), signed(F.col("average_delta")), "average_current"), "top_country_move"),
        _one(p, [place], F.format_string(texts.TOP_PAIR, "source", "target", S.relation_label(F.col("current_score")), S.trend_label(delta), signed(delta), "current_score"), "top_pair_move"),
        _one(topics, [place], F.format_string(texts.TOP_TOPIC, "topic_label", "absolute_delta_total"), "top_topic_shift"),
        _one(p.where("delta > 0"), [-delta, place], F.format_string(texts.TOP_GAINER, "source", "target", signed(delta)), "top_gainer"),
        _one(p.where("delta < 0"), [delta, place], F.format_string(texts.TOP_LOSER, "source", "target", signed(delta)), "top_loser"),
        _one(topics, [place], F.format_string(texts.WEEK_TOPIC, "topic_label", "absolute_delta_total"), "top_topic"),
    ]
    return reduce(lambda a, b: a.crossJoin(b), parts)  # one row each


def outside_indicator(given: DataFrame | None, spark) -> DataFrame:
    """One row: ``available``, ``value``, ``delta``, ``trend``, ``source_note`` of an indicator from elsewhere; ``given`` has these columns in part, None or no row: not available."""
    schema = "available boolean, value double, delta double, trend string, source_note string"
    empty = spark.createDataFrame([(False, None, None, None, texts.OUTSIDE_NOTHING)], schema)
    if given is None:
        return empty
    has = lambda c, kind: F.col(c).cast(kind) if c in given.columns else F.lit(None).cast(kind)
    value, delta = S.exact_round(has("value", "double"), 2), S.exact_round(has("delta", "double"), 2)
    trend = F.coalesce(F.nullif(has("trend", "string"), F.lit("")), F.when(delta.isNotNull(), S.trend_label(delta)))
    row = given.limit(1).select(F.coalesce(has("available", "boolean"), value.isNotNull()).alias("available"), value.alias("value"), delta.alias("delta"), trend.alias("trend"), F.coalesce(has("source_note", "string"), F.lit(texts.OUTSIDE_NOTE)).alias("source_note"))
    return row.unionByName(empty).limit(1) if row.isEmpty() else row


def country_focus(country: str, items: DataFrame, focused: DataFrame, outside: DataFrame) -> DataFrame:
    """One row of texts about a country: ``quick_view``, ``relation``, ``trend``, ``regional_summary``, ``focus_line``, with the averages of its focus group.

    ``items``: rows of :func:`country_moves`; ``focused``: as of :func:`focus`; ``outside``: as of :func:`outside_indicator`.
    """
    own = items.where((F.col("kind") == "score") & (F.col("country") == country)).agg(*[F.first(c).alias(c) for c in ("average_current", "average_previous", "average_delta")])
    entry = F.when(F.col("current").isNotNull() & F.col("delta").isNotNull(), F.struct("place", F.concat(F.col("partner"), F.format_string(": %.2f (", "current"), signed(F.col("delta")), F.lit(")")).alias("t")))
    group = focused.agg(F.array_sort(F.collect_list(entry)).alias("e"), F.first("average_current").alias("focus_average"), F.first("average_delta").alias("focus_average_delta"))  # a row per partner asked for
    row = own.crossJoin(group).crossJoin(outside.select("available", "value", F.col("delta").alias("outside_delta")))  # one row each
    now, delta, known = F.col("average_current"), F.col("average_delta"), F.col("average_current").isNotNull()
    seen = F.coalesce(F.col("available"), F.lit(False)) & F.col("value").isNotNull()
    or_empty = lambda cond, c: F.when(cond, c).otherwise("")
    extra = F.concat(or_empty(F.col("focus_average").isNotNull(), F.format_string(texts.QUICK_FOCUS, "focus_average")), or_empty(seen, F.format_string(texts.QUICK_OUTSIDE, "value")))
    away = F.concat(F.format_string(texts.REGION_OUTSIDE, "value"), or_empty(F.col("outside_delta").isNotNull(), F.concat(F.lit(" ("), signed(F.col("outside_delta")), F.lit(")"))))
    region = F.concat(F.concat_ws("; ", F.when(F.col("focus_average").isNotNull(), F.format_string(texts.REGION_FOCUS, "focus_average")), F.when(seen, away).otherwise(texts.REGION_NOTHING)), F.lit("."))
    return row.select(
        F.when(known, F.concat(F.format_string(texts.QUICK, S.trend_label(delta), now, S.relation_label(now)), extra)).otherwise(texts.QUICK_NOTHING).alias("quick_view"),
        F.when(known, F.format_string(texts.RELATION, now, "average_previous", S.relation_label(now))).otherwise(texts.RELATION_NOTHING).alias("relation"),
        F.when(known, F.format_string(texts.TREND, S.trend_label(delta), signed(delta))).otherwise(texts.TREND_NOTHING).alias("trend"),
        region.alias("regional_summary"), "focus_average", "focus_average_delta",
        F.when(F.size("e") > 0, F.format_string(texts.FOCUS, F.array_join(F.transform("e", lambda x: x["t"]), ", "))).otherwise(texts.FOCUS_NOTHING).alias("focus_line"),
    )


# history

def history_entry(day: str, country: str, items: DataFrame, pairs: DataFrame, note: str = texts.NOTHING, source: str = "votes_30d_weekly_report.json") -> DataFrame:
    """One row: a country's ``score`` and ``delta`` with labels, its strongest and its most dynamic partner; without an item of its own these partners' figures, else 0.

    ``items`` and ``pairs``: a report's countries (kind score) and pairs (kind strongest); of equal pairs the first in place counts.
    """
    own = items.where((F.col("kind") == "score") & (F.col("country") == country)).agg(F.first("average_current").alias("own_score"), F.first("average_delta").alias("own_delta"))
    mine = pairs.where((F.col("kind") == "strongest") & ((F.col("source") == country) | (F.col("target") == country))).withColumn("partner", S.partner_of(country, F.col("source"), F.col("target")))
    first = lambda key: F.max_by(F.struct("partner", "current_score", "delta"), F.struct(key.alias("k"), (-F.col("place")).alias("o")))
    best = mine.agg(first(F.col("current_score")).alias("strong"), first(F.abs("delta")).alias("moved"))
    score = F.coalesce("own_score", F.col("strong.current_score"), F.lit(0.0))
    delta = F.coalesce("own_delta", F.col("moved.delta"), F.lit(0.0))
    return own.crossJoin(best).select(  # one row each
        F.lit(day).cast("date").alias("date"), F.lit(source).alias("source_report"), S.exact_round(score, 2).alias("score"), S.exact_round(delta, 2).alias("delta"), S.relation_label(score).alias("relation_label"), S.trend_label(delta).alias("trend_label"),
        F.col("strong.partner").alias("main_partner"), F.col("strong.current_score").alias("main_partner_score"), F.col("moved.partner").alias("dynamic_partner"), F.col("moved.delta").alias("dynamic_partner_delta"), F.lit(note).alias("method_note"),
    )


HISTORY = "date date, source_report string, score double, delta double, relation_label string, trend_label string, main_partner string, main_partner_score double, dynamic_partner string, dynamic_partner_delta double, method_note string"


def normalized_history(items: DataFrame) -> DataFrame:
    """History rows as of :func:`history_entry`, whatever columns ``items`` have: without a day left out, missing figures 0, missing labels from the figures."""
    has = lambda c, kind="string": F.col(c).cast(kind) if c in items.columns else F.lit(None).cast(kind)
    score, delta = (F.coalesce(S.exact_round(has(c, "double"), 2), F.lit(0.0)) for c in ("score", "delta"))
    text = lambda c, other: F.coalesce(F.nullif(has(c), F.lit("")), other)
    return items.where(has("date", "date").isNotNull()).select(
        has("date", "date").alias("date"), F.coalesce(has("source_report"), F.lit("votes_30d_weekly_report.json")).alias("source_report"), score.alias("score"), delta.alias("delta"),
        text("relation_label", S.relation_label(score)).alias("relation_label"), text("trend_label", S.trend_label(delta)).alias("trend_label"), has("main_partner").alias("main_partner"), has("main_partner_score", "double").alias("main_partner_score"),
        has("dynamic_partner").alias("dynamic_partner"), has("dynamic_partner_delta", "double").alias("dynamic_partner_delta"), F.coalesce(has("method_note"), F.lit(texts.NOTHING)).alias("method_note"),
    )


def updated_history(history: DataFrame, entry: DataFrame) -> DataFrame:
    """The history with ``entry`` in the place of its day's row."""
    return upsert(normalized_history(history), entry, ["date"])


def chart(history: DataFrame, country: str, days: int = 3) -> DataFrame:
    """One row: ``series`` (with moving average and fitted line, by day), ``forecast_next`` and ``latest_summary`` of a daily history; a row a day, so one task holds it."""
    known = timeseries.with_metrics(history, [], "date", "score")
    line = timeseries.trend_line(history.select("date", "score"), [], "date", "score").select("date", "trend")
    point = F.struct("date", "score", "delta", F.col("value_ma").alias("score_ma7"), F.col("trend").alias("trend_line"), "main_partner", "dynamic_partner", "relation_label", "trend_label")
    series = known.join(line, "date").agg(F.array_sort(F.collect_list(point)).alias("series"))
    ahead = timeseries.forecast(history.select("date", "score"), [], "date", "score", days).agg(F.array_sort(F.collect_list(F.struct(F.col("day").alias("date"), F.col("forecast").alias("forecast_score")))).alias("forecast_next"))
    last = known.agg(F.max_by(F.struct("date", "score", "delta", F.col("value_ma").alias("score_ma7"), F.col("trend_slope").alias("trend_slope_14d")), "date").alias("latest_summary"))
    return series.crossJoin(ahead).crossJoin(last).withColumn("country", F.lit(country))  # one row each
