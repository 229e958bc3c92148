"""The composite relationship index of country pairs, and its change between periods.

Everything is grouped by ``scope`` (window and mode, or a period as well), so all
artifacts of a layer come out of one job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concordia.config import TOPICS, Thresholds, Weights
from concordia.functions import scalars as S

SCOPE = ("window_days", "mode")


def _universe(edges: DataFrame, similarity: DataFrame, normalized: DataFrame, scope: Sequence[str]) -> DataFrame:
    ends = lambda e: e.select(*scope, F.explode(F.array("source", "target")).alias("country"))
    return ends(edges).union(ends(similarity)).union(normalized.select(*scope, "country")).distinct()


def index_pairs(edges: DataFrame, similarity: DataFrame, normalized: DataFrame, weights: Weights = Weights(), least: float = Thresholds().min_relationship, scope: Sequence[str] = SCOPE) -> DataFrame:
    """scope, ``source``, ``target``, ``score`` 0-100 (2 digits), ``band``, component scores and weights, for pairs at ``least`` and above.

    ``edges`` and ``similarity``: scope, source, target, weight; ``normalized``: heatmap rows. Missing components are 0; maxima of nothing are 1.
    The joins are on countries within a scope: at most some hundred rows each.
    """
    scope = list(scope)
    countries = _universe(edges, similarity, normalized, scope)
    profile = normalized.select(*scope, "country", F.array(*[F.col(t) for t in TOPICS]).alias("v"))
    known = countries.join(profile, [*scope, "country"], "left")
    a = known.select(*scope, F.col("country").alias("source"), F.col("v").alias("va"))
    b = known.select(*scope, F.col("country").alias("target"), F.col("v").alias("vb"))
    pairs = a.join(b, scope).where("source < target").withColumn("kind", S.pair_type(F.col("source"), F.col("target")))
    if "mode" in scope:
        pairs = pairs.where(F.array_contains(S.pair_modes(F.col("kind")), F.col("mode")))
    else:
        pairs = pairs.where("kind <> 'other'")
    direct = edges.select(*scope, "source", "target", F.col("weight").alias("direct_weight"))
    similar = similarity.select(*scope, "source", "target", F.col("weight").alias("similarity_weight"))
    peak = lambda e, name: e.groupBy(*scope).agg(F.coalesce(F.nullif(F.max("weight"), F.lit(0.0)), F.lit(1.0)).alias(name))
    joined = pairs.join(direct, [*scope, "source", "target"], "left").join(similar, [*scope, "source", "target"], "left")
    joined = joined.join(peak(edges, "direct_max"), scope, "left").join(peak(similarity, "similarity_max"), scope, "left").na.fill(0.0, ["direct_weight", "similarity_weight"]).na.fill(1.0, ["direct_max", "similarity_max"])
    scored = joined.withColumns({
        "d": S.clamp(F.col("direct_weight") / F.col("direct_max") * 100), "s": S.clamp(F.col("similarity_weight") / F.col("similarity_max") * 100),
        "t": S.clamp(S.profile_closeness(F.col("va"), F.col("vb")) * 100),
    })
    score = S.exact_round(S.clamp(F.col("d") * weights.direct + F.col("s") * weights.similarity + F.col("t") * weights.topic), 2)
    return scored.withColumn("score", score).where(F.col("score") >= least).select(
        *scope, "source", "target", "score", S.band(F.col("score")).alias("band"),
        *[S.exact_round(F.col(x), 2).alias(n) for x, n in (("d", "direct_score"), ("s", "similarity_score"), ("t", "topic_score"))],
        *[S.exact_round(F.col(x), 6).alias(x) for x in ("direct_weight", "similarity_weight")],
    )


def _both_ways(pairs: DataFrame, scope: Sequence[str], *values: str) -> DataFrame:
    ways = F.explode(F.array(*[F.struct(F.col(x).alias("country"), F.col(y).alias("partner")) for x, y in (("source", "target"), ("target", "source"))]))
    return pairs.select(*scope, ways.alias("s"), *values).select(*scope, "s.country", "s.partner", *values)


def by_country(pairs: DataFrame, universe: DataFrame, scope: Sequence[str] = SCOPE, top: int = 10) -> DataFrame:
    """scope, ``country``, ``relationship_count``, ``average_score``, ``strongest_partner``, ``strongest_score``, ``top_partners`` for every country of ``universe``."""
    scope = list(scope)
    seen = _both_ways(pairs, scope, "score")
    ranked = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("k"), F.col("partner"), F.col("score")))), 1, top)
    # of equal scores the pair that sorts first: with one country fixed, that is the partner's order
    rows = seen.groupBy(*scope, "country").agg(F.count(F.lit(1)).alias("relationship_count"), F.sum(F.col("score").cast("decimal(18,2)")).alias("sum"), ranked.alias("r"))
    out = universe.join(rows, [*scope, "country"], "left").withColumn("relationship_count", F.coalesce("relationship_count", F.lit(0)))
    mean = F.when(F.col("relationship_count") > 0, S.exact_round(F.col("sum").cast("double") / F.col("relationship_count"), 2)).otherwise(0.0)
    partners = F.coalesce(F.transform("r", lambda x: F.struct(x["partner"].alias("partner"), x["score"].alias("score"))), F.array().cast("array<struct<partner:string,score:double>>"))
    first = F.try_element_at(partners, F.lit(1))
    return out.select(*scope, "country", "relationship_count", mean.alias("average_score"), first["partner"].alias("strongest_partner"), first["score"].alias("strongest_score"), partners.alias("top_partners"))


def universe(edges: DataFrame, similarity: DataFrame, normalized: DataFrame, scope: Sequence[str] = SCOPE) -> DataFrame:
    """Countries that the graph, the similarity graph or the heatmap names."""
    return _universe(edges, similarity, normalized, scope)


def change_status(current: Column, previous: Column, delta: Column) -> Column:
    return F.when(previous.isNull() & current.isNotNull(), "gained").when(current.isNull() & previous.isNotNull(), "lost").when(delta > 0, "improved").when(delta < 0, "declined").otherwise("stable")


def pair_changes(current: DataFrame, previous: DataFrame, scope: Sequence[str] = SCOPE) -> DataFrame:
    """Full outer join of two periods' pairs: scores (missing 0), ``delta`` (2 digits), ``status``, bands and ``ordinal`` (rank by size of the change)."""
    scope = list(scope)
    pick = lambda d, p: d.select(*scope, "source", "target", F.col("score").alias(f"{p}_raw"), F.col("band").alias(f"{p}_band"))
    j = pick(current, "current").join(pick(previous, "previous"), [*scope, "source", "target"], "full")
    j = j.withColumns({"current_score": F.coalesce("current_raw", F.lit(0.0)), "previous_score": F.coalesce("previous_raw", F.lit(0.0))})
    j = j.withColumn("delta", S.exact_round(F.col("current_score") - F.col("previous_score"), 2))
    j = j.withColumn("status", change_status(F.col("current_raw"), F.col("previous_raw"), F.col("delta")))
    order = Window.partitionBy(*scope).orderBy(F.desc(F.abs("delta")), "source", "target")
    return j.select(*scope, "source", "target", "current_score", "previous_score", "delta", "status", "current_band", "previous_band", F.row_number().over(order).alias("ordinal"))


def country_changes(changes: DataFrame, current: DataFrame, previous: DataFrame, countries: DataFrame, scope: Sequence[str] = SCOPE) -> DataFrame:
    """Per country: counts and averages of both periods, their deltas, and the lists of gained, lost, improved, declined (10 each) and largest changes (12).

    ``current`` and ``previous``: as of :func:`by_country`. ``countries``: those of either graph; countries with a change are added.
    """
    scope = list(scope)
    seen = _both_ways(changes, scope, "current_score", "previous_score", "delta", "status")
    entry = lambda key: F.struct(key.alias("k"), F.col("partner"), F.col("current_score"), F.col("previous_score"), F.col("delta"), F.col("status"))

    def listed(status: str | None, key: Column, n: int) -> Column:
        e = entry(key)
        ranked = F.slice(F.array_sort(F.collect_list(F.when(F.col("status") == status, e) if status else e)), 1, n)
        return F.transform(ranked, lambda x: F.struct(*[x[c].alias(c) for c in ("partner", "current_score", "previous_score", "delta", "status")]))

    lists = seen.groupBy(*scope, "country").agg(
        listed("gained", -F.col("current_score"), 10).alias("gained"), listed("lost", -F.col("previous_score"), 10).alias("lost"),
        listed("improved", -F.col("delta"), 10).alias("improved"), listed("declined", F.col("delta"), 10).alias("declined"), listed(None, -F.abs("delta"), 12).alias("top_changes"),
    )
    keys = [*scope, "country"]
    every = lists.select(*keys).union(countries.select(*keys)).distinct()
    pick = lambda d, p: d.select(*keys, F.col("relationship_count").alias(f"count_{p}"), F.col("average_score").alias(f"average_{p}"))
    out = every.join(lists, keys, "left").join(pick(current, "current"), keys, "left").join(pick(previous, "previous"), keys, "left")
    out = out.na.fill(0, ["count_current", "count_previous"]).na.fill(0.0, ["average_current", "average_previous"])
    return out.withColumns({"count_delta": F.col("count_current") - F.col("count_previous"), "average_delta": S.exact_round(F.col("average_current") - F.col("average_previous"), 2)})
