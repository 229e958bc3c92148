"""The event, network, vote, index, series and report operators over the driver's whole tables.

Coded messages and news items are event tables already. Votes are read off the
order tables: a part is a vote, a line item a member's vote, the supplier's
nation (numbered into the EU list) its country, the return flag its position.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concordia.config import EU, MODES, TOPICS, VOTE_WEIGHTS
from concordia.functions import scalars as S
from concordia.functions import text as X
from concordia.operators import artifacts, detect, events, networks, relationship, reports, timeseries, votes
from concordia.plans.reference_oracles import NAMES, ORACLE
from concordia.runtime import cut, settled, table

NOW = "2026-04-15T00:00:00Z"


def coded_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "coded_messages")
    ts = S.event_timestamp(NOW, F.col("published_at"), F.col("collected_at"))
    return rows.select("row_id", ts.alias("ts"), "countries", "topics", "country_pairs", S.event_weight(F.col("metadata")).alias("weight"))


def graph_edges(spark, sf_dir):
    return networks.graph_edges(coded_events(spark, sf_dir), NOW)


def graph_nodes(spark, sf_dir):
    return networks.graph_nodes(coded_events(spark, sf_dir), NOW)


def event_counts(spark, sf_dir):
    return networks.event_counts(coded_events(spark, sf_dir), NOW)


def heatmap(spark, sf_dir):
    return networks.heatmap(coded_events(spark, sf_dir), NOW)


def heatmap_norm(spark, sf_dir):
    return networks.normalize_rows(heatmap(spark, sf_dir))


def similarity(spark, sf_dir):
    return networks.similarity_edges(heatmap_norm(spark, sf_dir))


def _components(spark, sf_dir, windows: networks.Windows = networks.WINDOW_DAYS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Graph, similarity and normalised heatmap of each window (or period) and mode. Two scans, whose results (a row per country or pair) are written once."""
    rows = coded_events(spark, sf_dir)
    norm = cut(networks.normalize_rows(networks.heatmap(rows, NOW, windows)))
    return cut(networks.graph_edges(rows, NOW, windows)), networks.similarity_edges(norm), norm


def relationship_pairs(spark, sf_dir):
    return relationship.index_pairs(*_components(spark, sf_dir))


def _relationship(spark, sf_dir):
    parts = _components(spark, sf_dir)
    pairs = relationship.index_pairs(*parts)
    return pairs, relationship.by_country(pairs, relationship.universe(*parts))


def relationship_countries(spark, sf_dir):
    partners = F.array_join(F.transform("top_partners", lambda x: x["partner"]), ",")
    return _relationship(spark, sf_dir)[1].withColumn("top_partners", partners)


def _changes(spark, sf_dir):
    """Pair and country changes of the last 30 days against the 30 before; both periods come out of the same scans."""
    parts = _components(spark, sf_dir, networks.periods(NOW, 30))
    period = lambda d, n: d.where(F.col("window_days") == n).withColumn("window_days", F.lit(60))
    pairs = cut(relationship.index_pairs(*parts))
    countries = relationship.by_country(pairs, relationship.universe(*parts))
    changes = relationship.pair_changes(period(pairs, 1), period(pairs, 2))
    ends = parts[0].select(F.lit(60).alias("window_days"), "mode", F.explode(F.array("source", "target")).alias("country")).distinct()
    return changes, relationship.country_changes(changes, period(countries, 1), period(countries, 2), ends)


def relationship_change(spark, sf_dir):
    return _changes(spark, sf_dir)[0]


def country_change(spark, sf_dir):
    return _changes(spark, sf_dir)[1].select("window_days", "mode", "country", "count_current", "count_previous", "count_delta", "average_current", "average_previous", "average_delta",
                                             *[F.array_join(F.transform(c, lambda x: x["partner"]), ",").alias(c) for c in ("gained", "lost", "improved", "declined", "top_changes")])


def report_pairs(spark, sf_dir):
    return reports.pair_moves(_changes(spark, sf_dir)[0], relationship.SCOPE).select("mode", "kind", "source", "target", "delta", "status")


def report_countries(spark, sf_dir):
    return reports.country_moves(_changes(spark, sf_dir)[1], relationship.SCOPE).select("mode", "kind", "country", "average_delta", "count_delta")


def report_lines(spark, sf_dir):
    """The texts about countries and pairs, and the executive summary, of each mode."""
    changes, countries = _changes(spark, sf_dir)
    c, p = reports.country_moves(countries, ["mode"]), reports.pair_moves(changes, ["mode"])
    lead = reports.executive_summary("gdelt", "30d", changes.select("mode").distinct(), c, p)
    kinds = [("country", reports.country_lines(c, ["mode"])), ("pair", reports.pair_lines(p, ["mode"])), ("lead", lead.select("mode", F.lit(1).alias("place"), F.col("executive_summary").alias("line")))]
    return reduce(lambda a, b: a.unionByName(b), [rows.select(F.lit(k).alias("kind"), "mode", "place", "line") for k, rows in kinds])


def report_documents(spark, sf_dir):
    """The assembled report of each mode: the order of its sections, and its notes."""
    r = reports.report("gdelt", "30d", *_changes(spark, sf_dir))
    named = lambda c, *keys: F.array_join(F.transform(c, lambda x: F.concat_ws("-", *[x[k] for k in keys])), ",").alias(c)
    return r.select("layer_label", "window", "mode", "mode_label", F.length("method_note").alias("note_length"), F.size("country_lines").alias("n_country_lines"), F.size("pair_lines").alias("n_pair_lines"),
                    named("country_items", "country"), named("pair_items", "source", "target"), *[F.coalesce(named(c, "source", "target"), F.lit("")).alias(c) for c in ("gained_pairs", "lost_pairs")])


def _items(spark, sf_dir):
    """A report's countries and pairs, of all countries together."""
    changes, countries = _changes(spark, sf_dir)
    return countries.where("mode = 'all'"), reports.country_moves(countries, ["mode"]).where("mode = 'all'"), reports.pair_moves(changes, ["mode"]).where("mode = 'all'")


def focus_partners(spark, sf_dir):
    countries = _items(spark, sf_dir)[0]
    return reports.focus(reports.partner_map(countries.where("country = 'HU'")), ["PL", "CZ", "SK"])


def country_focus(spark, sf_dir):
    """Texts about the country that heads the report."""
    countries, items, _ = _items(spark, sf_dir)
    head = items.where("kind = 'score' AND place = 1").first()
    code = head["country"] if head else "HU"
    focused = reports.focus(reports.partner_map(countries.where(F.col("country") == code)), ["PL", "CZ", "SK"])
    outside = reports.outside_indicator(spark.createDataFrame([(42.5, 3.25)], "value double, delta double"), spark)
    return reports.country_focus(code, items, focused, outside)


def weekly_insight(spark, sf_dir):
    _, items, pairs = _items(spark, sf_dir)
    return reports.weekly_insight(items, pairs, reports.topic_moves(_vote_topic_change(spark, sf_dir)))


def history_row(spark, sf_dir):
    _, items, pairs = _items(spark, sf_dir)
    return reports.history_entry("2026-04-15", "HU", items, pairs).withColumn("date", F.date_format("date", "yyyy-MM-dd"))


def _history(spark, sf_dir):
    """A daily history read off the page views, as an indicator has it."""
    days = _daily(spark, sf_dir).where("event_type = 'click'")
    history = reports.normalized_history(days.select(F.col("day").alias("date"), F.col("value").alias("score"), F.lit(1.5).alias("delta")))
    return reports.updated_history(history, history.orderBy(F.desc("date")).limit(1).withColumn("score", F.lit(50.0)))


def history_chart(spark, sf_dir):
    """Points of the chart: the series with its fitted line, then the forecast."""
    c = cut(reports.chart(_history(spark, sf_dir), "HU"))
    day = lambda d: F.date_format(d, "yyyy-MM-dd").alias("day")
    series = c.select(F.explode("series").alias("s")).select(F.lit("series").alias("what"), day("s.date"), "s.score", F.col("s.score_ma7").alias("average"), F.col("s.trend_line").alias("line"))
    none = F.lit(None).cast("double")
    ahead = c.select(F.explode("forecast_next").alias("s")).select(F.lit("forecast").alias("what"), day("s.date"), none.alias("score"), none.alias("average"), F.col("s.forecast_score").alias("line"))
    last = c.select(F.lit("latest").alias("what"), day("latest_summary.date"), "latest_summary.score", F.col("latest_summary.score_ma7").alias("average"), F.col("latest_summary.trend_slope_14d").alias("line"))
    return series.unionByName(ahead).unionByName(last)


# documents: the order of their lists

def _order(c: str, *keys: str):
    return F.array_join(F.transform(c, lambda x: F.concat_ws("-", *[x[k] for k in keys])), ",").alias(f"{c}_order")


def graph_documents(spark, sf_dir):
    rows = coded_events(spark, sf_dir)
    counts = networks.event_counts(rows, NOW).withColumn("mode", F.explode(F.array(*map(F.lit, MODES))))
    d = artifacts.graph_documents(networks.graph_nodes(rows, NOW), networks.graph_edges(rows, NOW), counts, ["window_days", "mode"])
    return d.select("window_days", "mode", "event_count", _order("nodes", "id"), _order("edges", "source", "target"))


def relationship_documents(spark, sf_dir):
    d = artifacts.relationship_documents(*_relationship(spark, sf_dir), ["window_days", "mode"])
    return d.select("window_days", "mode", _order("pairs", "source", "target"), _order("by_country", "country"))


def change_documents(spark, sf_dir):
    d = artifacts.relationship_change_documents(*_changes(spark, sf_dir), ["window_days", "mode"])
    return d.select("mode", _order("pair_changes", "source", "target"), _order("by_country", "country"))


def vote_summary_documents(spark, sf_dir):
    d = artifacts.summary_documents(votes.summary(_windows(spark, sf_dir), ["window_days"]), ["window_days"])
    return votes.by_mode(d).select("window_days", "mode", "event_count", _order("by_country", "country"), _order("by_topic", "topic"), _order("by_country_topic", "country", "topic"))


def policy_snapshot(spark, sf_dir):
    d = artifacts.policy_snapshot(_news(spark, sf_dir))
    return d.select("event_count", _order("nodes", "id"), _order("edges", "source", "target"))


def day_snapshot(spark, sf_dir):
    """The network of the events with two EU countries."""
    d = networks.snapshot(events.network_events(_news(spark, sf_dir)))
    return d.select("event_count", _order("nodes", "id"), _order("edges", "source", "target"))


# text layer

def _news(spark, sf_dir):
    return table(spark, sf_dir, "news_items").withColumnRenamed("news_id", "ingest_seq")


def news_text(spark, sf_dir):
    n = _news(spark, sf_dir)
    return n.select("ingest_seq", X.searchable_text(F.col("title"), F.col("summary")).alias("text"), X.hash_title(F.col("title")).alias("title_hash"), X.topic_text(F.col("title")).alias("topic_text"))


def news_detect(spark, sf_dir):
    n = _news(spark, sf_dir).withColumn("t", settled(detect.from_parts(F.col("title"), F.col("summary"))))
    n = n.withColumn("scores", settled(detect.score_topics(F.col("t"))))
    scores = F.col("scores")
    return n.select("ingest_seq", F.array_join(detect.detect_countries(F.col("t"), NAMES), ",").alias("countries"), F.array_join(detect.detect_topics(F.col("t")), ",").alias("topics"),
                    detect.primary_topic(scores).alias("primary_topic"), F.coalesce(F.aggregate(F.map_values(scores), F.lit(0), lambda a, b: a + b), F.lit(0)).alias("keywords"))


def position_labels(spark, sf_dir):
    """The position that a title's words tell, if any."""
    return _news(spark, sf_dir).select("ingest_seq", X.vote_label(F.col("title")).alias("label"))


def vote_topics(spark, sf_dir):
    return _news(spark, sf_dir).select("ingest_seq", detect.vote_topic(F.col("title")).alias("vote_topic"))


def text_events(spark, sf_dir):
    """Event records built from the news items' texts, relevant ones only, deduplicated."""
    built = cut(events.relevant(events.build_text_events(_news(spark, sf_dir), aliases=NAMES)))
    joined = lambda c: F.array_join(c, ",")
    return events.dedup_events(built).select("ingest_seq", "layer", joined("topics").alias("topics"), "primary_topic", joined("countries").alias("countries"), joined("country_groups.eu").alias("eu"),
                                             joined("country_groups.external").alias("external"), joined(F.transform("country_pairs", lambda p: F.array_join(p, "-"))).alias("pairs"))


def coded_built(spark, sf_dir):
    """Event records built anew from the coded messages' metadata."""
    rows = table(spark, sf_dir, "coded_messages")
    keys = ["EventCode", "EventRootCode", "Actor1Name", "Actor2Name", "Actor1CountryCode_raw", "Actor2CountryCode_raw", "ActionGeo_CountryCode_raw"]
    built = events.build_coded_events(rows.select("row_id", *[F.try_element_at("metadata", F.lit(k)).alias(k) for k in keys]))
    return built.select("row_id", "title", "primary_topic", F.array_join("topics", ",").alias("topics"), F.array_join("countries", ",").alias("countries"), F.array_join(F.transform("country_pairs", lambda p: F.array_join(p, "-")), ",").alias("pairs"))


def dedup_news(spark, sf_dir):
    return events.dedup_events(_news(spark, sf_dir)).select("ingest_seq")


def dedup_coded(spark, sf_dir):
    rows = table(spark, sf_dir, "coded_messages")
    return events.dedup_coded(rows, F.try_element_at("metadata", F.lit("GlobalEventID")), ["row_id"]).select("row_id")


def country_edges(spark, sf_dir):
    topic = lambda t: F.coalesce(F.try_element_at("topics", F.lit(t)), F.lit(0)).alias(t)
    return networks.country_edges(events.network_events(_news(spark, sf_dir))).select("source", "target", "weight", *[topic(t) for t in TOPICS])


def country_nodes(spark, sf_dir):
    return networks.country_nodes(events.network_events(_news(spark, sf_dir)))


def policy_edges(spark, sf_dir):
    return networks.policy_edges(_news(spark, sf_dir))


def policy_nodes(spark, sf_dir):
    return networks.policy_nodes(_news(spark, sf_dir))


def debug_counters(spark, sf_dir):
    return reports.counters(_news(spark, sf_dir))


def coded_counters(spark, sf_dir):
    rows = table(spark, sf_dir, "coded_messages")
    keys = ["Actor1CountryCode_raw", "Actor2CountryCode_raw", "ActionGeo_CountryCode_raw"]
    return reports.coded_counters(rows.select(*[F.try_element_at("metadata", F.lit(k)).alias(k) for k in keys]))


def storage_days(spark, sf_dir):
    """Events by the day they are stored under."""
    day = F.date_format(S.storage_date(F.col("published_at"), F.col("collected_at")), "yyyy-MM-dd")
    return table(spark, sf_dir, "coded_messages").groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("n"))


# votes

def _members(spark, sf_dir):
    """Members vote with their part's parity or against it, some neither, so that countries of one parity mostly agree."""
    line = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag", "l_linenumber")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    eu = F.array(*map(F.lit, EU))
    joined = line.join(supplier, line.l_suppkey == supplier.s_suppkey)
    strays = F.col("l_returnflag") == "A"
    own = (F.col("l_partkey") % 2 == F.col("s_nationkey") % 2) != strays
    position = F.when(strays & (F.col("l_linenumber") % 3 == 0), "abstain").when(own, "for").otherwise("against")
    return joined.select(F.col("l_partkey").alias("vote_id"), eu[F.col("s_nationkey")].alias("country"), F.concat(F.lit("G"), F.col("l_linenumber").cast("string")).alias("grp"), position.alias("position"))


def _votes(spark, sf_dir):
    """Long votes with their day."""
    long = votes.country_positions(votes.fold(_members(spark, sf_dir)))
    topics = F.array(*map(F.lit, TOPICS))
    day = F.date_format(F.date_sub(F.lit("2026-04-15").cast("date"), (F.col("vote_id") % 100).cast("int")), "yyyy-MM-dd")
    return long.select("vote_id", topics[(F.col("vote_id") % 8).cast("int")].alias("topic"), "country", "position", day.alias("date"))


def _windows(spark, sf_dir):
    return votes.windowed(_votes(spark, sf_dir), NOW)


def _periods(spark, sf_dir):
    """The votes of the last 30 days and of the 30 before, as ``period``."""
    v = _votes(spark, sf_dir)
    return events.with_period(v.withColumn("ts", S.iso_or_mail_timestamp(F.col("date"))), "ts", NOW, 30)


def vote_fold(spark, sf_dir):
    return votes.fold(_members(spark, sf_dir))


def vote_majority(spark, sf_dir):
    return votes.country_positions(votes.fold(_members(spark, sf_dir)))


def vote_conflicts(spark, sf_dir):
    c = votes.conflicts(_votes(spark, sf_dir))
    return c.select("vote_id", "n_valid", "divisive", F.col("conflict").cast("double").alias("conflict"))


def _vote_edges(spark, sf_dir, rows, scope):
    named = F.array_join(F.transform("topics", lambda t: F.concat(t["topic"], F.lit(":"), F.format_string("%.3f", t["value"]))), ",")
    return votes.graph_edges(rows, [scope]).withColumn("topics", named)


def vote_edges(spark, sf_dir):
    return _vote_edges(spark, sf_dir, _windows(spark, sf_dir), "window_days")


def vote_nodes(spark, sf_dir):
    v = _windows(spark, sf_dir)
    return votes.graph_nodes(v, votes.graph_edges(v, ["window_days"]), ["window_days"])


def vote_window_counts(spark, sf_dir):
    return votes.vote_counts(_windows(spark, sf_dir), ["window_days"])


def vote_heatmap(spark, sf_dir):
    return votes.by_mode(votes.heatmap(_windows(spark, sf_dir), ["window_days"]))


def vote_summary(spark, sf_dir):
    return votes.summary(_windows(spark, sf_dir), ["window_days"])


def _vote_parts(spark, sf_dir):
    """Edges, similarity, heatmap and normalised heatmap of both periods; what is written has a row per country or pair."""
    v = _periods(spark, sf_dir)
    heat, edges = cut(votes.heatmap(v, ["period"])), cut(votes.graph_edges(v, ["period"]))
    norm = networks.normalize_rows(heat)
    sim = networks.similarity_edges(norm.select(F.lit(0).alias("window_days"), F.col("period").alias("mode"), "country", *TOPICS)).select(F.col("mode").alias("period"), "source", "target", "weight")
    return edges, sim, heat, norm


def vote_similarity(spark, sf_dir):
    return _vote_parts(spark, sf_dir)[1]


def vote_similarity_nodes(spark, sf_dir):
    return votes.similarity_nodes(_vote_parts(spark, sf_dir)[3], ["period"])


def vote_relationship(spark, sf_dir):
    edges, sim, _, norm = _vote_parts(spark, sf_dir)
    return relationship.index_pairs(edges, sim, norm, VOTE_WEIGHTS, scope=["period"])


def vote_change(spark, sf_dir):
    """The whole change report by country."""
    edges, _, heat, _ = _vote_parts(spark, sf_dir)
    of = lambda d, p: d.where(F.col("period") == p)
    out = votes.changes((of(edges, "current"), of(heat, "current")), (of(edges, "previous"), of(heat, "previous")))
    topics = lambda c: F.array_join(F.transform(c, lambda x: F.concat(x["topic"], F.lit(":"), F.format_string("%.3f", x["delta"]))), ",").alias(c)
    return out.select("ordinal", "country", *[F.array_join(c, ",").alias(c) for c in ("gained", "lost", "kept")], "partners_current", "partners_previous", "partner_delta", topics("all_topic_changes"), topics("top_topic_changes"))


def vote_partner_change(spark, sf_dir):
    return vote_change(spark, sf_dir).where("partners_current + partners_previous > 0").drop("ordinal", "all_topic_changes", "top_topic_changes")


def _vote_topic_change(spark, sf_dir):
    h = cut(votes.heatmap(_periods(spark, sf_dir), ["period"]))
    return votes.topic_changes(*(h.where(F.col("period") == p) for p in ("current", "previous")))


def vote_topic_change(spark, sf_dir):
    return _vote_topic_change(spark, sf_dir)


def report_topics(spark, sf_dir):
    return reports.topic_moves(_vote_topic_change(spark, sf_dir)).select("topic", "topic_label", "absolute_delta_total", "place", F.array_join(F.transform("examples", lambda x: x["country"]), ",").alias("countries"))


def report_topic_shifts(spark, sf_dir):
    return reports.country_topic_shifts(_vote_topic_change(spark, sf_dir))


def vote_record_rows(spark, sf_dir):
    """Vote records of parts, joined to the vote dimension."""
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("vote_id"), X.vote_title(F.col("p_name"), F.lit(None), F.col("p_type"), F.lit(None), F.col("p_partkey")).alias("title"), F.lit("2025-01-01").alias("date"))
    out = votes.vote_records(votes.fold(_members(spark, sf_dir)), part.withColumn("topic", detect.vote_topic(F.col("title"))))
    return out.select("id", "title", "topic", F.size("countries").alias("n_countries"), F.size("groups").alias("n_groups"), F.try_element_at("countries", F.lit("DE")).alias("de"))


def vote_run_summary(spark, sf_dir):
    """The counts that a run over the vote records reports."""
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("vote_id"), F.col("p_name").alias("title"), F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("p_partkey") % 400).cast("int")), "yyyy-MM-dd").alias("date"))
    records = votes.vote_records(votes.fold(_members(spark, sf_dir)), part.withColumn("topic", detect.vote_topic(F.col("title"))))
    counts = F.array_join(F.transform(F.map_entries("topic_counts"), lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string"))), ",")
    return votes.run_summary(records).withColumn("topic_counts", counts)


# series, upserts, top k

def _daily(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.groupBy("event_type", F.to_date("ts").alias("day")).agg(F.avg(F.col("value").cast("decimal(28,12)")).cast("double").alias("v")).select("event_type", "day", S.exact_round(F.col("v"), 2).alias("value"))


def series_metrics(spark, sf_dir):
    return timeseries.with_metrics(_daily(spark, sf_dir), ["event_type"], "day", "value").select("event_type", F.date_format("day", "yyyy-MM-dd").alias("day"), "value", "value_ma", "trend_slope")


def series_trend(spark, sf_dir):
    return timeseries.trend_line(_daily(spark, sf_dir), ["event_type"], "day", "value").select("event_type", F.date_format("day", "yyyy-MM-dd").alias("day"), "trend")


def series_forecast(spark, sf_dir):
    return timeseries.forecast(_daily(spark, sf_dir), ["event_type"], "day", "value").select("event_type", F.date_format("day", "yyyy-MM-dd").alias("day"), "forecast")


def upsert_orders(spark, sf_dir):
    """Orders of even customers re-priced: new rows take the place of old ones."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return events.upsert(o, o.where("o_custkey % 2 = 0").withColumn("o_orderstatus", F.lit("new")), ["o_orderkey"])


def upsert_customers(spark, sf_dir):
    """The last order of each customer, one with an even number before all others: several rows a key on either side."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    return events.upsert(o, o.where("o_orderkey % 2 = 0"), ["o_custkey"], ["o_orderkey"])


def newest_orders(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return events.newest_per_group(o, ["o_custkey"], [F.desc("o_orderdate"), F.col("o_orderkey")], 2).select("o_custkey", "o_orderkey")


_NAMES = [
    graph_edges, graph_nodes, event_counts, heatmap, heatmap_norm, similarity, relationship_pairs, relationship_countries, relationship_change, country_change,
    report_pairs, report_countries, report_lines, report_documents, focus_partners, country_focus, weekly_insight, history_row, history_chart,
    graph_documents, relationship_documents, change_documents, vote_summary_documents, policy_snapshot, day_snapshot,
    news_text, news_detect, position_labels, vote_topics, text_events, coded_built, dedup_news, dedup_coded,
    country_edges, country_nodes, policy_edges, policy_nodes, debug_counters, coded_counters, storage_days, vote_fold, vote_majority, vote_conflicts, vote_edges, vote_nodes, vote_window_counts, vote_heatmap, vote_summary,
    vote_similarity, vote_similarity_nodes, vote_relationship, vote_change, vote_partner_change, vote_topic_change, report_topics, report_topic_shifts, vote_record_rows, vote_run_summary,
    series_metrics, series_trend, series_forecast, upsert_orders, upsert_customers, newest_orders,
]
QUERIES = {f.__name__: f for f in _NAMES}
__all__ = ["ORACLE", "QUERIES"]
