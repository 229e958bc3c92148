"""Roll-call votes: folding member votes to country positions, and conflict-weighted networks of them.

Long form: one row per vote and country, ``vote_id``, ``topic``, ``country``,
``position`` (for, against, abstain; others are dropped). All builders take
``scope``, columns (a window or a period) that the result is grouped by as well.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from concordia.config import TOPICS, VOTE_SCORE, Thresholds
from concordia.functions import scalars as S

POSITIONS = ["for", "against", "abstain"]
_CW = "decimal(9,6)"


def fold(members: DataFrame) -> DataFrame:
    """Counts of positions by (vote, country), (vote, group) and vote, in one grouping-sets pass. ``level`` says which; ``key`` is the country or group.

    members: ``vote_id``, ``country``, ``group``, ``position``, already normalised; only valid positions of EU countries count, and groups only where not empty.
    """
    valid = members.where(F.col("position").isin(POSITIONS) & S.is_eu(F.col("country")))
    sets = valid.groupingSets([["vote_id", "country"], ["vote_id", "grp"], ["vote_id"]], "vote_id", "country", "grp").agg(
        *[F.count_if(F.col("position") == p).alias(f"n_{p}") for p in POSITIONS], F.grouping_id().alias("gid")
    )
    level = F.when(F.col("gid") == 1, "country").when(F.col("gid") == 2, "group").otherwise("vote")
    return sets.select("vote_id", level.alias("level"), F.coalesce("country", "grp").alias("key"), *[f"n_{p}" for p in POSITIONS]).where("NOT (level = 'group' AND coalesce(key, '') = '')")


def majority(*, n_for: Column, n_against: Column, n_abstain: Column) -> Column:
    """The position with the highest count, alphabetical among equals; null where all are zero."""
    ranked = F.array(*[F.struct(n.alias("n"), F.lit(-i).alias("at"), F.lit(p).alias("p")) for i, (p, n) in enumerate([("abstain", n_abstain), ("against", n_against), ("for", n_for)])])
    best = F.array_max(ranked)
    return F.when(best["n"] > 0, best["p"])


def country_positions(folded: DataFrame) -> DataFrame:
    """``vote_id``, ``country``, ``position`` by majority."""
    by = folded.where("level = 'country'")
    return by.select("vote_id", F.col("key").alias("country"), majority(n_for=F.col("n_for"), n_against=F.col("n_against"), n_abstain=F.col("n_abstain")).alias("position")).where("position IS NOT NULL")


def _spread(rows: DataFrame, scope: Sequence[str]) -> DataFrame:
    """A row for each entry of the scope's columns that are lists."""
    for c in scope:
        if isinstance(rows.schema[c].dataType, ArrayType):
            rows = rows.withColumn(c, F.explode(c))
    return rows


def gathered(votes: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """One row per vote: ``v`` (its countries with a valid position, sorted), ``n_valid``, ``divisive`` (two valid votes and two positions at least) and
    ``conflict`` = 1 - share of the largest position, 6 digits, over all countries. The one exchange by vote that all builders share; a vote has a row per country at most.
    """
    lists = votes.where(F.col("position").isin(POSITIONS)).groupBy(*scope, "vote_id", "topic").agg(
        F.array_sort(F.collect_list(F.struct("country", "position"))).alias("v"), *[F.count_if(F.col("position") == p).alias(f"n_{p}") for p in POSITIONS]
    )
    n = sum((F.col(f"n_{p}") for p in POSITIONS), F.lit(0))
    kinds = sum(((F.col(f"n_{p}") > 0).cast("int") for p in POSITIONS), F.lit(0))
    most = F.greatest(*[F.col(f"n_{p}") for p in POSITIONS])
    weight = F.round(1 - most.cast("decimal(18,0)") / n.cast("decimal(18,0)"), 6).cast(_CW)
    return _spread(lists, scope).withColumns({"n_valid": n, "divisive": (n >= Thresholds().divisive_min) & (kinds >= 2), "conflict": weight})


def conflicts(votes: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Per vote: counts, ``n_valid``, ``divisive`` and ``conflict``."""
    return gathered(votes, scope).drop("v")


def _worth(votes: DataFrame, scope: Sequence[str], limits: Thresholds) -> DataFrame:
    """Divisive votes on a known topic with enough conflict, with their EU countries in ``v``."""
    kept = gathered(votes, scope).where(F.col("divisive") & F.col("topic").isin(TOPICS) & (F.col("conflict") >= F.lit(limits.min_conflict_weight).cast(_CW)))
    return kept.select(*scope, "vote_id", "topic", "conflict", F.filter("v", lambda x: S.is_eu(x["country"])).alias("v"))


def counted(votes: DataFrame, scope: Sequence[str] = (), limits: Thresholds = Thresholds()) -> DataFrame:
    """EU votes that count in the networks: of divisive votes on a known topic with enough conflict, with ``conflict``."""
    return _worth(votes, scope, limits).select(*scope, "vote_id", "topic", "conflict", F.explode("v").alias("x")).select(*scope, "vote_id", "topic", "conflict", "x.country", "x.position")


def windowed(votes: DataFrame, now: str, windows: Sequence[int] = (7, 30, 90), date: str = "date") -> DataFrame:
    """The votes of any trailing window, with the windows they are in as the list ``window_days``: by their UTC day, later ones included.

    As part of a scope the list is spread out over the votes once these are gathered, not over the countries' rows.
    """
    inside = [F.when(S.iso_or_mail_timestamp(F.col(date)) >= F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {24 * int(d)} HOURS"), F.lit(int(d))) for d in windows]
    return votes.withColumn("window_days", F.array_compact(F.array(*inside))).where(F.size("window_days") > 0)


def by_mode(rows: DataFrame, modes: Sequence[str] = ("all", "internal", "external")) -> DataFrame:
    """Results of votes for each mode: all and internal ones are the same, as votes are of EU countries only; external ones have none."""
    return rows.withColumn("mode", F.explode(F.array(*[F.lit(m) for m in modes if m != "external"])))


def vote_counts(votes: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """scope, ``event_count``: all votes of the scope, also in modes that show none."""
    return _spread(votes.select(*scope, "vote_id").distinct(), scope).groupBy(*scope).agg(F.count(F.lit(1)).alias("event_count"))


def pair_score(a: Column, b: Column) -> Column:
    dec = lambda x: F.lit(x).cast("decimal(3,2)")
    return F.when((a == b) & (a != "abstain"), dec("1")).when(a == b, dec("0.75")).when((a == "abstain") | (b == "abstain"), dec("0.25")).otherwise(dec("0"))


def vote_pairs(votes: DataFrame, scope: Sequence[str] = (), limits: Thresholds = Thresholds()) -> DataFrame:
    """Country pairs of each vote that counts, made inside the row of the vote: at most a pair of EU countries each, no self-join."""
    made = F.flatten(F.transform("v", lambda x, i: F.transform(F.slice("v", i + 2, F.greatest(F.size("v"), F.lit(1))), lambda y: F.struct(x.alias("a"), y.alias("b")))))
    return _worth(votes, scope, limits).select(*scope, "vote_id", "topic", "conflict", F.explode(made).alias("p")).select(
        *scope, "vote_id", "topic", "conflict", F.col("p.a.country").alias("source"), F.col("p.b.country").alias("target"), F.col("p.a.position").alias("pa"), F.col("p.b.position").alias("pb")
    )


def graph_edges(votes: DataFrame, scope: Sequence[str] = (), limits: Thresholds = Thresholds()) -> DataFrame:
    """scope, ``source``, ``target``, ``weight`` (conflict-weighted agreement, 3 digits), ``count``, ``relation`` and ``topics`` (the three with the largest signed sums)."""
    pairs = vote_pairs(votes, scope, limits)
    same = F.when(F.col("pa") == F.col("pb"), F.col("conflict")).otherwise(-F.col("conflict"))
    per_topic = pairs.groupBy(*scope, "source", "target", "topic").agg(
        F.sum(pair_score(F.col("pa"), F.col("pb")) * F.col("conflict")).alias("agreed"), F.sum("conflict").alias("possible"),
        F.count(F.lit(1)).alias("n"), F.round(F.sum(same), 3).cast("double").alias("value"),
    )
    top = F.slice(F.array_sort(F.collect_list(F.struct((-F.abs("value")).alias("k"), F.col("topic"), F.col("value")))), 1, 3)
    edges = per_topic.groupBy(*scope, "source", "target").agg(F.sum("agreed").alias("agreed"), F.sum("possible").alias("possible"), F.sum("n").alias("count"), top.alias("top"))
    edges = edges.withColumn("raw", F.col("agreed").cast("double") / F.col("possible").cast("double"))
    kept = edges.where((F.col("count") >= limits.min_edge_count) & (F.col("raw") >= limits.min_edge_weight))
    return kept.select(*scope, "source", "target", S.exact_round(F.col("raw"), 3).alias("weight"), "count", S.vote_relation(F.col("raw")).alias("relation"), F.transform("top", lambda t: F.struct(t["topic"].alias("topic"), t["value"].alias("value"))).alias("topics"))


def graph_nodes(votes: DataFrame, edges: DataFrame, scope: Sequence[str] = (), limits: Thresholds = Thresholds()) -> DataFrame:
    """scope, ``country``, ``weight`` (sum of its rounded edges), ``count`` (votes it took part in that have two EU countries at least)."""
    took = _worth(votes, scope, limits).where(F.size("v") >= 2).select(*scope, F.explode("v.country").alias("country")).groupBy(*scope, "country").agg(F.count(F.lit(1)).alias("count"))
    ends = edges.select(*scope, F.explode(F.array("source", "target")).alias("country"), F.col("weight").cast("decimal(18,3)").alias("w")).groupBy(*scope, "country").agg(F.sum("w").alias("w"))
    return took.join(ends, [*scope, "country"], "left").select(*scope, "country", F.coalesce(F.col("w").cast("double"), F.lit(0.0)).alias("weight"), "count")


def heatmap(votes: DataFrame, scope: Sequence[str] = (), limits: Thresholds = Thresholds()) -> DataFrame:
    """scope, ``country``, a column per topic (signed, conflict-weighted, 3 digits) and ``total`` (sum of absolute cells)."""
    score = S.lookup(VOTE_SCORE, F.col("position")).cast("decimal(3,2)")
    long = counted(votes, scope, limits).withColumn("v", score * F.col("conflict"))
    wide = long.groupBy(*scope, "country").pivot("topic", TOPICS).agg(F.sum("v")).na.fill(0)
    cells = [F.round(F.coalesce(F.col(t), F.lit(0)), 3).cast("double").alias(t) for t in TOPICS]
    total = sum((F.abs(F.coalesce(F.col(t), F.lit(0))) for t in TOPICS), F.lit(0).cast("decimal(18,8)"))
    return wide.select(*scope, "country", *cells, F.round(total, 3).cast("double").alias("total"))


def similarity_nodes(normalized: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Length of each normalised row."""
    return normalized.select(*scope, "country", S.exact_round(F.sqrt(sum((F.col(t) * F.col(t) for t in TOPICS), F.lit(0.0))), 3).alias("weight"))


def summary(votes: DataFrame, scope: Sequence[str] = (), limits: Thresholds = Thresholds()) -> DataFrame:
    """Conflict-weighted sums by position at four levels (all, country, topic, country and topic) in one grouping-sets pass; ``total`` adds the rounded parts, ``votes`` counts those that any EU country took part in."""
    rows = counted(votes, scope, limits)
    keys = list(scope)
    sets = rows.groupingSets([[*keys], [*keys, "country"], [*keys, "topic"], [*keys, "country", "topic"]], *keys, "country", "topic").agg(
        *[F.round(F.sum(F.when(F.col("position") == p, F.col("conflict"))), 3).alias(p) for p in POSITIONS], F.grouping("country").alias("gc"), F.grouping("topic").alias("gt"), F.count_distinct("vote_id").alias("votes")
    )
    level = F.when((F.col("gc") == 1) & (F.col("gt") == 1), "all").when(F.col("gt") == 1, "country").when(F.col("gc") == 1, "topic").otherwise("country_topic")
    parts = [F.coalesce(F.col(p), F.lit(0)).cast("decimal(18,3)") for p in POSITIONS]
    return sets.select(*keys, level.alias("level"), "country", "topic", *[x.cast("double").alias(f"{p}_weight") for p, x in zip(POSITIONS, parts)], sum(parts, F.lit(0).cast("decimal(18,3)")).cast("double").alias("total"), "votes")


def partner_changes(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Per country: ``gained``, ``lost`` and ``kept`` partners (sorted) and counts, from the edges (source, target) of two periods. Lists are bounded by the number of countries."""
    both = lambda e, flag: e.select(F.explode(F.array(F.struct(F.col("source").alias("country"), F.col("target").alias("partner")), F.struct(F.col("target").alias("country"), F.col("source").alias("partner")))).alias("s")).select("s.*", F.lit(True).alias(flag))
    joined = both(current, "now").join(both(previous, "before"), ["country", "partner"], "full")
    now, before = F.col("now").isNotNull(), F.col("before").isNotNull()
    names = lambda cond: F.array_sort(F.collect_list(F.when(cond, F.col("partner"))))
    return joined.groupBy("country").agg(
        names(now & ~before).alias("gained"), names(before & ~now).alias("lost"), names(now & before).alias("kept"),
        F.count_if(now).alias("partners_current"), F.count_if(before).alias("partners_previous"),
    ).withColumn("partner_delta", F.col("partners_current") - F.col("partners_previous"))


def topic_changes(current: DataFrame, previous: DataFrame) -> DataFrame:
    """``country``, ``topic``, ``current``, ``previous``, ``delta`` (3 digits), over all topics for every country of either heatmap."""
    long = lambda h, name: h.select("country", F.explode(F.array(*[F.struct(F.lit(t).alias("topic"), F.col(t).alias(name)) for t in TOPICS])).alias("s")).select("country", "s.*")
    out = long(current, "current").join(long(previous, "previous"), ["country", "topic"], "full").na.fill(0.0, ["current", "previous"])
    return out.withColumn("delta", S.exact_round(F.col("current") - F.col("previous"), 3))


def changes(current: tuple[DataFrame, DataFrame], previous: tuple[DataFrame, DataFrame], top: int = 5) -> DataFrame:
    """The change report by country, from the (edges, heatmap) of two periods: partners gained, lost and kept with their counts, ``all_topic_changes`` and the ``top`` largest,
    and ``ordinal``, the rank by size of the partner change.
    """
    topics = topic_changes(current[1], previous[1]).withColumn("abs_delta", S.exact_round(F.abs("delta"), 3))
    entry = F.struct((-F.col("abs_delta")).alias("k"), "topic", "current", "previous", "delta", "abs_delta")
    listed = topics.groupBy("country").agg(F.array_sort(F.collect_list(entry)).alias("t"))  # a row per topic
    listed = listed.select("country", F.transform("t", lambda x: F.struct(*[x[c].alias(c) for c in ("topic", "current", "previous", "delta", "abs_delta")])).alias("all_topic_changes"))
    zero = F.array(*[F.struct(F.lit(t).alias("topic"), *[F.lit(0.0).alias(c) for c in ("current", "previous", "delta", "abs_delta")]) for t in sorted(TOPICS)])
    out = partner_changes(current[0], previous[0]).join(listed, "country", "full")
    none = F.array().cast("array<string>")
    filled = {c: F.coalesce(c, none) for c in ("gained", "lost", "kept")} | {c: F.coalesce(c, F.lit(0)) for c in ("partners_current", "partners_previous", "partner_delta")}
    out = out.withColumns(filled | {"all_topic_changes": F.coalesce("all_topic_changes", zero)}).withColumn("top_topic_changes", F.slice("all_topic_changes", 1, top))
    return out.withColumn("ordinal", F.row_number().over(Window.partitionBy().orderBy(F.desc(F.abs("partner_delta")), "country")))  # a row per country


def run_summary(records: DataFrame, saved: DataFrame | None = None) -> DataFrame:
    """One row over the vote records of a run: how many, how many are saved in all, first and last date, average number of countries (2 digits) and records by topic."""
    totals = records.agg(
        F.count(F.lit(1)).alias("new_records"), F.min("date").alias("min_date"), F.max("date").alias("max_date"),
        F.coalesce(S.exact_round(F.sum(F.size("countries")).cast("double") / F.count(F.lit(1)), 2), F.lit(0.0)).alias("average_countries_per_record"),
    )
    topics = records.groupBy(F.coalesce("topic", F.lit("unknown")).alias("topic")).agg(F.count(F.lit(1)).alias("n")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("topic", "n")))).alias("topic_counts"))  # a row per topic
    in_all = (records if saved is None else saved).agg(F.count(F.lit(1)).alias("total_saved_records"))
    return totals.crossJoin(in_all).crossJoin(topics)  # one row each


def vote_records(folded: DataFrame, votes: DataFrame, since: str = "2024-01-01") -> DataFrame:
    """One record per vote of the dimension ``votes`` (vote_id, title, topic, date) dated ``since`` or later: majority position of each country and group as maps, with counts.

    The inner join drops votes without member votes and member votes without a vote. Maps are bounded by countries and groups.
    """
    position = majority(n_for=F.col("n_for"), n_against=F.col("n_against"), n_abstain=F.col("n_abstain"))
    entry = lambda lv, v: F.map_from_entries(F.array_sort(F.collect_list(F.when((F.col("level") == lv) & position.isNotNull(), F.struct("key", v.alias("v"))))))
    counts = F.struct(*[F.col(f"n_{p}").alias(p) for p in POSITIONS])
    agg = folded.where("level <> 'vote'").groupBy("vote_id").agg(
        entry("country", position).alias("countries"), entry("group", position).alias("groups"), entry("country", counts).alias("country_vote_counts"), entry("group", counts).alias("group_vote_counts"),
    )
    recent = votes.where(F.col("date") >= since)
    return agg.join(recent, "vote_id").withColumn("id", F.concat(F.lit("vote_"), F.col("vote_id").cast("string")))
