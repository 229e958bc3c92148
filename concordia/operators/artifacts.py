"""Results as documents: one row each, with their lists in the order readers rely on.

Every list is bounded by the number of countries, pairs of countries or topics.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordia.config import TOPICS
from concordia.operators.networks import policy_edges, policy_nodes


def listed(rows: DataFrame, scope: Sequence[str], name: str, order: Sequence[Column], *columns: Column | str) -> DataFrame:
    """scope and ``name``: the rows of each scope as structs of ``columns``, sorted by ``order``."""
    fields = [F.col(c) if isinstance(c, str) else c for c in columns]
    entry = F.struct(*[o.alias(f"k{i}") for i, o in enumerate(order)], F.struct(*fields).alias("v"))
    return rows.groupBy(*scope).agg(F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["v"]).alias(name))


def graph_documents(nodes: DataFrame, edges: DataFrame, counts: DataFrame, scope: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """scope, ``event_count``, ``nodes`` by id, ``edges`` by source and target. ``counts``: all scopes that get a document, with their event_count."""
    own = [c for c in ("count",) if c in nodes.columns]
    n = listed(nodes, scope, "nodes", [F.col("country")], F.col("country").alias("id"), "weight", *own)
    e = listed(edges, scope, "edges", [F.col("source"), F.col("target")], "source", "target", "weight", *extra)
    out = counts.join(n, list(scope), "left").join(e, list(scope), "left")
    return out.withColumns({c: F.coalesce(c, F.array().cast(out.schema[c].dataType)) for c in ("nodes", "edges")})


def heatmap_documents(rows: DataFrame, counts: DataFrame, scope: Sequence[str], normalized: bool = False) -> DataFrame:
    """scope, ``event_count``, ``topics``, ``rows`` by country, ``normalized``."""
    out = counts.join(listed(rows, scope, "rows", [F.col("country")], "country", *TOPICS, "total"), list(scope), "left")
    return out.withColumns({"rows": F.coalesce("rows", F.array().cast(out.schema["rows"].dataType)), "topics": F.array(*map(F.lit, TOPICS)), "normalized": F.lit(normalized)})


def summary_documents(summary: DataFrame, scope: Sequence[str]) -> DataFrame:
    """scope, ``event_count``, ``totals``, ``by_country``, ``by_topic``, ``by_country_topic``, the lists by falling total, then name. ``summary``: as of :func:`votes.summary`."""
    parts = [F.col("for_weight").alias("for"), F.col("against_weight").alias("against"), F.col("abstain_weight").alias("abstain")]
    out = summary.where("level = 'all'").select(*scope, F.col("votes").alias("event_count"), F.struct(*parts).alias("totals"))
    for level, keys in (("country", ["country"]), ("topic", ["topic"]), ("country_topic", ["country", "topic"])):
        rows = summary.where(F.col("level") == level)
        out = out.join(listed(rows, scope, f"by_{level}", [-F.col("total"), *map(F.col, keys)], *keys, *parts, "total"), list(scope), "left")
    return out


def relationship_documents(pairs: DataFrame, countries: DataFrame, scope: Sequence[str]) -> DataFrame:
    """scope, ``pairs`` by falling score, ``by_country`` by falling average."""
    p = listed(pairs, scope, "pairs", [-F.col("score"), F.col("source"), F.col("target")], "source", "target", "score", "band", "direct_score", "similarity_score", "topic_score")
    c = listed(countries, scope, "by_country", [-F.col("average_score"), F.col("country")], "country", "relationship_count", "average_score", "strongest_partner", "strongest_score", "top_partners")
    return c.join(p, list(scope), "left").withColumn("pairs", F.coalesce("pairs", F.array().cast(p.schema["pairs"].dataType)))


def relationship_change_documents(changes: DataFrame, countries: DataFrame, scope: Sequence[str]) -> DataFrame:
    """scope, ``pair_changes`` by size of the change, ``by_country`` by size of the change of the average."""
    p = listed(changes, scope, "pair_changes", [F.col("ordinal")], "source", "target", "current_score", "previous_score", "delta", "status")
    keep = [c for c in countries.columns if c not in scope]
    c = listed(countries, scope, "by_country", [-F.abs("average_delta"), F.col("country")], *keep)
    return c.join(p, list(scope), "left")


def policy_snapshot(events: DataFrame) -> DataFrame:
    """One row: ``event_count``, ``nodes`` and ``edges`` of the policy network."""
    nodes = listed(policy_nodes(events), [], "nodes", [F.col("country")], F.col("country").alias("id"), "weight")
    edges = listed(policy_edges(events), [], "edges", [F.col("source"), F.col("target")], "source", "target", "weight")
    return events.agg(F.count(F.lit(1)).alias("event_count")).crossJoin(nodes).crossJoin(edges)  # one row each
