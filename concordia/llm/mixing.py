"""Mixing sources to target weights: raking, then systematic sampling.

Token weights of the cells source x language x topic are raked (iterative
proportional fitting) to the source shares wanted and to the corpus's own
language and topic marginals; a cell's factor is the expected number of copies
of each of its documents and never exceeds its source's cap. Documents are then
drawn with these expectations: whole copies are sure, the fraction is drawn
systematically along documents ordered by cell and size, so that every cell gets
its expectation to within a copy, from the one of several starting points that
comes nearest to the tokens asked for.

Scale: the raking sees the cell totals only, whose number is bounded by targets x
known languages x topics, whatever the documents. Documents of a source are drawn
in strata of about ``stratum`` documents, so no window holds a whole source.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from concordia.llm.bpe import count_column
from concordia.llm.langid import label_language
from concordia.runtime import blank_trim, cut


#: Starting points tried for the systematic draw of a stratum.
STARTS = 16


def source_key(c) -> F.Column:
    """Source name without regard to case and padding; null for a blank one."""
    return F.nullif(F.lower(blank_trim(c)), F.lit(""))


def sized(documents: DataFrame, doc_id: str, text: str, source: str, lang: str, topic: F.Column, path: str | None = None) -> DataFrame:
    """``doc_id``, ``source``, ``lang`` (und where the label names no language), ``topic`` and ``n_tokens`` of each document; materialised."""
    counted = count_column(
        documents.select(
            F.col(doc_id).cast("long").alias("doc_id"), source_key(F.col(source)).alias("source"),
            F.coalesce(label_language(F.col(lang)), F.lit("und")).alias("lang"), F.coalesce(topic, F.lit("none")).alias("topic"), F.col(text).alias("text"),
        ), "text", "n_tokens", path,
    )
    return cut(counted.select("doc_id", "source", "lang", "topic", "n_tokens"))


def _fill(factors: np.ndarray, tokens: np.ndarray, cap: float, wanted: float) -> np.ndarray:
    """Factors scaled by one number and cut at cap, so that the tokens are as wanted (or as near as the cap lets them)."""
    if cap * tokens.sum() <= wanted:
        return np.full(len(factors), float(cap))
    free, out = np.ones(len(factors), bool), factors.astype(float)
    while True:
        left = wanted - cap * tokens[~free].sum()
        now = (out[free] * tokens[free]).sum()
        if now <= 0:
            out[free] = left / max(1e-12, tokens[free].sum())
        else:
            out[free] *= left / now
        over = free & (out > cap)
        if not over.any():
            return out
        out[over], free = cap, free & ~over


def rake(cells: list[tuple[str, str, str, float]], wanted: dict[str, float], caps: dict[str, float], rounds: int = 200) -> list[float]:
    """Factor of each cell (source, lang, topic, tokens). The source totals in ``wanted`` are met exactly where the caps allow; language and topic shares follow the cells' own as near as that permits."""
    sources, langs, topics = (np.unique([c[k] for c in cells], return_inverse=True) for k in range(3))
    tokens = np.array([c[3] for c in cells], float)
    factors = np.ones(len(cells))
    total = sum(wanted[s] for s in sources[0])
    margins = [(axis[1], np.bincount(axis[1], tokens) / max(1e-12, tokens.sum()) * total) for axis in (langs, topics)]
    for _ in range(rounds):
        before = factors.copy()
        for index, goal in margins:
            now = np.bincount(index, tokens * factors, len(goal))
            factors = factors * np.where(now > 0, goal / np.maximum(now, 1e-12), 1)[index]
        for s, name in enumerate(sources[0]):
            own = sources[1] == s
            factors[own] = _fill(factors[own], tokens[own], caps[name], wanted[name])
        if np.abs(factors - before).max() < 1e-9:
            break
    return factors.tolist()


def _targets(targets: DataFrame) -> dict[str, tuple[float, int]]:
    """Share and cap by source key; repeated names add up their shares under the smaller cap. Rows without a name or a positive share take no part."""
    keyed = targets.select(source_key(F.col("source")).alias("source"), F.col("target_share").cast("double").alias("share"), F.col("max_repeats").cast("int").alias("cap"))
    merged = keyed.where("source IS NOT NULL AND share > 0 AND cap > 0").groupBy("source").agg(F.sum("share").alias("share"), F.min("cap").alias("cap"))
    return {r["source"]: (r["share"], r["cap"]) for r in merged.collect()}


def mix(sizes: DataFrame, targets: DataFrame, total_tokens: int | None = None, seed: int = 7, stratum: int = 50_000) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents drawn: ``doc_id``, ``source``, ``lang``, ``topic``, ``n_tokens``, ``copies``; report by source; report of the three marginals).

    The marginals: ``axis`` (source, lang, topic), ``value``, ``wanted_share`` (of a source as asked for, of a language or topic as in the documents
    of the present sources), ``raked_share`` (what the caps and the other axes let the raking reach) and ``drawn_share``.

    Without ``total_tokens`` the mix is the largest in which every present source reaches its share within its cap. With more, capped sources stay
    below their share and the report says so. Documents without tokens, without a source or of a source not asked for are not drawn. Sources asked for
    but absent leave their share to the others in proportion.
    """
    spark = sizes.sparkSession
    goal = _targets(targets)
    usable = sizes.where("n_tokens > 0 AND source IS NOT NULL")
    in_mix = usable.where(F.col("source").isin(list(goal)))
    cells = [(r["source"], r["lang"], r["topic"], float(r["t"])) for r in in_mix.groupBy("source", "lang", "topic").agg(F.sum("n_tokens").alias("t")).orderBy("source", "lang", "topic").collect()]
    held: dict[str, float] = {}
    for s, _, _, t in cells:
        held[s] = held.get(s, 0) + t
    shares = {s: goal[s][0] for s in held}
    shares = {s: x / sum(shares.values()) for s, x in shares.items()}
    total = total_tokens if total_tokens is not None else min((goal[s][1] * held[s] / shares[s] for s in held), default=0)
    factors = rake(cells, {s: x * total for s, x in shares.items()}, {s: float(goal[s][1]) for s in held}) if cells else []
    schema = "source string, lang string, topic string, factor double"
    known = spark.createDataFrame([(s, l, t, f) for (s, l, t, _), f in zip(cells, factors)], schema)
    strata = usable.groupBy("source").agg(F.ceil(F.count(F.lit(1)) / stratum).alias("strata"))

    drawn = in_mix.join(known, ["source", "lang", "topic"]).join(strata, "source")
    drawn = drawn.withColumn("stratum", F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.col("strata")))
    along = Window.partitionBy("source", "stratum").orderBy("lang", "topic", "n_tokens", F.xxhash64(F.lit(seed + 1), "doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    exact = F.col("factor").cast("decimal(20,12)")
    drawn = cut(drawn.select("doc_id", "source", "lang", "topic", "stratum", "n_tokens", "factor", F.sum(exact).over(along).alias("upto")))

    # of several starting points the one whose tokens come nearest to what the stratum should give
    def copies(k: int) -> F.Column:
        u = (F.lit((2 * k + 1) / (2 * STARTS)) + F.lit(0)).cast("decimal(20,12)")
        return (F.floor(F.col("upto") + u) - F.floor(F.col("upto") - exact + u)).cast("int")

    tried = drawn.groupBy("source", "stratum").agg(F.sum(F.col("factor") * F.col("n_tokens")).alias("due"), *[F.sum(copies(k) * F.col("n_tokens")).alias(f"t{k}") for k in range(STARTS)])
    nearest = F.array_min(F.array(*[F.struct(F.abs(F.col(f"t{k}") - F.col("due")), F.lit(k).alias("k")) for k in range(STARTS)]))["k"]
    best = tried.select("source", "stratum", nearest.alias("k"))
    taken = F.element_at(F.array(*[copies(k) for k in range(STARTS)]), F.col("k") + 1)
    chosen = drawn.join(best, ["source", "stratum"]).select("doc_id", "source", "lang", "topic", "n_tokens", taken.alias("copies")).where("copies > 0")

    asked = spark.createDataFrame([(s, x, shares.get(s, 0.0), c) for s, (x, c) in sorted(goal.items())], "source string, target_share double, share_among_present double, max_repeats int")
    stock = usable.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.sum("n_tokens").alias("tokens"))
    got = chosen.groupBy("source").agg(F.count(F.lit(1)).alias("drawn_documents"), F.sum("copies").cast("long").alias("drawn_copies"), F.sum(F.col("copies") * F.col("n_tokens")).alias("drawn_tokens"), F.max("copies").alias("most_copies"))
    report = asked.join(stock, "source", "full").join(got, "source", "left")
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("documents", "tokens", "drawn_documents", "drawn_copies", "drawn_tokens", "most_copies")]
    report = report.select("source", "target_share", "share_among_present", "max_repeats", *zero)
    sum_drawn = F.sum("drawn_tokens").over(Window.partitionBy())  # one row per source
    report = report.withColumn("reached_share", F.coalesce(F.try_divide(F.col("drawn_tokens").cast("double"), sum_drawn), F.lit(0.0)))

    rows = []
    for k, axis in enumerate(("source", "lang", "topic")):
        own, raked = Counter(), Counter()
        for cell, f in zip(cells, factors):
            own[cell[k]] += cell[3]
            raked[cell[k]] += cell[3] * f
        wanted = shares if axis == "source" else {v: t / max(1.0, own.total()) for v, t in own.items()}
        rows += [(axis, v, wanted[v], raked[v] / max(1e-12, raked.total())) for v in sorted(own)]
    axes = spark.createDataFrame(rows, "axis string, value string, wanted_share double, raked_share double")
    spread = F.explode(F.array(*[F.struct(F.lit(a).alias("axis"), F.col(a).alias("value")) for a in ("source", "lang", "topic")])).alias("s")
    per_cell = chosen.groupBy("source", "lang", "topic").agg(F.sum(F.col("copies") * F.col("n_tokens")).alias("t"))
    per = per_cell.select(spread, "t").groupBy("s.axis", "s.value").agg(F.sum("t").cast("double").alias("t"))
    per = per.withColumn("drawn_share", F.col("t") / F.sum("t").over(Window.partitionBy("axis")))  # a row per value of an axis
    marginals = axes.join(per.drop("t"), ["axis", "value"], "left").withColumn("drawn_share", F.coalesce("drawn_share", F.lit(0.0)))
    return chosen, report, marginals
