"""Queries of the language-model data problems (p1, p2, p6, p8, p9, p10) over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from concordia.llm import bpe, langid, mixing, neardup, pairs, sentences
from concordia.runtime import blank_trim, cut, table


def _news_items(news: DataFrame) -> Column:
    country = F.transform("countries", lambda c: F.upper(blank_trim(c)))
    country = F.transform(country, lambda c: F.when(c == "UK", "GB").when(c == "EL", "GR").otherwise(c))
    topic = F.transform("topics", lambda t: F.regexp_replace(F.lower(blank_trim(t)), r"[\s-]", "_"))
    empty = F.array().cast("array<string>")
    return F.filter(F.concat(F.coalesce(country, empty), F.coalesce(topic, empty)), lambda x: x != "")


def p1_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    news = table(spark, sf_dir, "news_items")
    return pairs.co_occurrence(news, _news_items(news)).withColumn("lift", F.round("lift", 6))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    news = table(spark, sf_dir, "news_items")
    found = pairs.co_occurrence(news, _news_items(news), min_count=3, min_share=0.003)
    exact = [F.col(c).cast("decimal(19,0)") for c in ("n_ab", "n_rows", "n_a", "n_b")]
    return found.where((F.col("n_ab") * 1000 >= 3 * F.col("n_rows")) & (exact[0] * exact[1] >= 2 * exact[2] * exact[3])).select("item_a", "item_b")


def _news_segments(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    news = table(spark, sf_dir, "news_items")
    label = F.try_element_at("metadata", F.lit("lang"))
    models = langid.train(news, "news_id", label, [F.col("title"), F.col("summary")])
    labels = news.select(F.col("news_id").alias("id"), label.alias("label"), langid.label_language(label).alias("named"))
    return langid.segment_languages(news, "news_id", "title", "summary", models), labels


def p2_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _news_segments(spark, sf_dir)[0].select(F.col("id").alias("news_id"), "part", "segment_no", "lang", "confidence")


def p2_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments, labels = _news_segments(spark, sf_dir)
    rows = labels.join(langid.row_languages(segments), "id", "left")
    return rows.select(F.col("id").alias("news_id"), "label", "named", F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"), "langs")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = p2_rows(spark, sf_dir).where(F.col("langs").isNotNull() & (F.col("named").isNull() | (F.size("langs") > 1) | (F.col("named") != F.col("langs")[0])))
    return rows.select("news_id", F.explode("langs").alias("lang"))


def _news_text() -> Column:
    return F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.coalesce("summary", F.lit("")))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.similar_pairs(table(spark, sf_dir, "news_items").select("news_id", "title", "summary"), "news_id", _news_text())
    return found.select(F.col("id_a").alias("news_id_a"), F.col("id_b").alias("news_id_b"))


def p6_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.groups(table(spark, sf_dir, "news_items").select("news_id", "title", "summary"), "news_id", _news_text())
    return found.withColumnRenamed("id", "news_id")


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_column(table(spark, sf_dir, "documents").select("doc_id", "text"), "text").select("doc_id", "ids")


def _sized_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = F.nullif(F.regexp_extract("dossier", r"\(([A-Z]{3})\)\s*$", 1), F.lit(""))  # the kind of dossier: three letters, so a bounded number
    return mixing.sized(table(spark, sf_dir, "documents"), "doc_id", "text", "source", "lang", topic)


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_sized_documents(spark, sf_dir), table(spark, sf_dir, "mix_targets"))[0].select("doc_id", "source", "n_tokens", "copies")


def p9_marginals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares of sources, languages and topics: wanted, raked and drawn."""
    return mixing.mix(_sized_documents(spark, sf_dir), table(spark, sf_dir, "mix_targets"))[2]


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_sized_documents(spark, sf_dir), table(spark, sf_dir, "mix_targets"))[1]


def p10_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = sentences.learn(documents, F.col("text"), F.col("lang"))
    return sentences.split_documents(documents, "doc_id", "text", "lang", model)


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p10_sentences(spark, sf_dir).select("doc_id", "sent_start", "sent_end")


QUERIES = {
    "p1_found": p1_found, "p1_pairs": p1_pairs, "p2_found": p2_found, "p2_rows": p2_rows, "p2_segments": p2_segments,
    "p6_found": p6_found, "p6_groups": p6_groups, "p8_ids": p8_ids, "p9_mix": p9_mix, "p9_shares": p9_shares, "p9_marginals": p9_marginals,
    "p10_found": p10_found, "p10_sentences": p10_sentences,
}

_P1 = """
WITH r AS (SELECT news_id, unnest(list_distinct(list_filter(list_concat(
  coalesce(list_transform(countries, lambda c: CASE upper(trim(c, E' \\t\\n\\r')) WHEN 'UK' THEN 'GB' WHEN 'EL' THEN 'GR' ELSE upper(trim(c, E' \\t\\n\\r')) END), []),
  coalesce(list_transform(topics, lambda t: regexp_replace(lower(trim(t, E' \\t\\n\\r')), '[ -]', '_', 'g')), [])), lambda x: x IS NOT NULL AND x <> ''))) AS item FROM news_items),
n AS (SELECT count(*) AS n_rows FROM news_items), k AS (SELECT item, count(*) AS n FROM r GROUP BY item),
p AS (SELECT a.item AS item_a, b.item AS item_b, count(*) AS n_ab FROM r a JOIN r b ON a.news_id = b.news_id AND a.item < b.item GROUP BY ALL),
q AS (SELECT p.*, ka.n AS n_a, kb.n AS n_b, n_rows FROM p JOIN k ka ON ka.item = item_a JOIN k kb ON kb.item = item_b, n)
"""

_P6 = """
WITH t AS (SELECT news_id, list_distinct(regexp_extract_all(lower(regexp_replace(regexp_replace(coalesce(title, '') || ' ' || coalesce(summary, ''), '<[^>]*>', ' ', 'g'), '&#?\\w+;', ' ', 'g')), '[\\pL\\pN]+')) AS w FROM news_items),
u AS (SELECT news_id, len(w) AS n, unnest(w) AS x FROM t),
c AS (SELECT a.news_id AS a, b.news_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS k FROM u a JOIN u b ON a.x = b.x AND a.news_id < b.news_id GROUP BY ALL)
SELECT a AS news_id_a, b AS news_id_b FROM c WHERE k * 100 >= 80 * (na + nb - k)
"""

_P6_GROUPS = """
WITH RECURSIVE """ + _P6[_P6.index("t AS"):].rsplit("SELECT a AS news_id_a", 1)[0] + """,
pair AS (SELECT a, b FROM c WHERE k * 100 >= 80 * (na + nb - k)), ways AS (SELECT a, b FROM pair UNION ALL SELECT b, a FROM pair),
reach(node, other) AS (SELECT a, b FROM ways UNION SELECT r.node, e.b FROM reach r JOIN ways e ON e.a = r.other),
grp AS (SELECT node, least(node, min(other)) AS group_id FROM reach GROUP BY node), deg AS (SELECT a, count(*) AS links FROM ways GROUP BY a),
cls AS (SELECT news_id, min(news_id) OVER (PARTITION BY list_sort(w)) AS class_id FROM t WHERE len(w) > 0)
SELECT news_id, class_id, coalesce(group_id, news_id) AS group_id, coalesce(links, 0) AS links FROM cls LEFT JOIN grp ON node = news_id LEFT JOIN deg ON deg.a = news_id
"""

ORACLE = {
    "p6_groups": _P6_GROUPS,
    "p1_pairs": _P1 + "SELECT item_a, item_b, n_ab, n_a, n_b, n_rows, round(CAST(n_ab AS DOUBLE) * n_rows / (CAST(n_a AS DOUBLE) * n_b), 6) AS lift FROM q",
    "p1_found": _P1 + "SELECT item_a, item_b FROM q WHERE n_ab >= 3 AND n_ab * 1000 >= 3 * n_rows AND n_ab * n_rows >= 2 * n_a * n_b",
    "p6_found": _P6,
}
