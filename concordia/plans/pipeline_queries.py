"""Queries of the general data-preparation problems (p3, p4, p5, p7) over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concordia.functions.timestamps import known_zones, with_utc_micros
from concordia.operators.deliveries import first_copies, keep_one_copy, numeric_identity, repeated_copies
from concordia.operators.drift import FIELDS, field_changes, file_fields, ingest, promotions, replay
from concordia.operators.rolling import latest_daily_amounts, rolling_totals, undirected
from concordia.runtime import cut, table

#: The columns the raw lines are read into.
EVENT_TARGET = {
    "layer": "string", "source_name": "string", "title": "string", "summary": "string", "url": "string", "published_at": "string",
    "topics": "array<string>", "primary_topic": "string", "language": "string",
    "country_groups.eu": "array<string>", "country_groups.external": "array<string>",
    "metadata.raw_source": "string", "num_mentions": "double", "is_main": "boolean",
}
_FILE = ["feed", "file_name", "file_date", "file_seq"]
P7_END = "2026-04-15"


def _p3_report(ingested: DataFrame) -> DataFrame:
    return field_changes(file_fields(ingested, _FILE, "line_no"), "feed", "file_name", ["file_date", "file_seq"])


def p3_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _p3_report(ingest(table(spark, sf_dir, "raw_lines"), "payload", EVENT_TARGET))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p3_report(spark, sf_dir).select("file_name", "field_path", "change_kind")


def p3_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines in one table: every promotion that the report proposes is approved and replayed."""
    ingested = cut(ingest(table(spark, sf_dir, "raw_lines"), "payload", EVENT_TARGET))
    return replay(ingested, promotions(_p3_report(ingested), EVENT_TARGET)).drop(FIELDS)


def _messages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict]:
    rows = with_utc_micros(table(spark, sf_dir, "coded_messages").select("row_id", "batch_id", "collected_at", "metadata"), "collected_micros", "collected_at")
    return rows, {"key": numeric_identity(F.try_element_at("metadata", F.lit("GlobalEventID"))), "instant": F.col("collected_micros")}


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, how = _messages(spark, sf_dir)
    return repeated_copies(rows, order_id=F.col("row_id"), **how).select(F.col("order_id").alias("row_id"))


def p4_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each identifier delivered more than once: how often, and the copy that stays."""
    rows, how = _messages(spark, sf_dir)
    return first_copies(rows, order_id=F.col("row_id"), **how).select(F.col("key").alias("global_event_id"), F.col("n").alias("copies"), F.col("order_id").alias("kept_row_id"))


def p4_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages that stay, whole, as ids and times."""
    rows, how = _messages(spark, sf_dir)
    return keep_one_copy(rows, order_id="row_id", **how).select("row_id", "batch_id", "collected_at")


def p5_instants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both fields of every news item, null where one denotes no instant."""
    sources = table(spark, sf_dir, "sources").groupBy("source_name").agg(F.min_by("home_zone", "home_zone").alias("home_zone"), F.min("date_order").alias("date_order"))
    news = table(spark, sf_dir, "news_items").select("news_id", "source_name", "published_at", "collected_at")
    known = news.join(sources, "source_name", "left")  # the optimizer broadcasts the lookup if its file is small enough
    zones = known_zones(spark)
    known = with_utc_micros(known, "published_micros", "published_at", F.col("home_zone"), F.col("date_order"), zones)
    known = with_utc_micros(known, "collected_micros", "collected_at", "UTC", F.col("date_order"), zones)
    return known.select("news_id", "published_micros", "collected_micros")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = p5_instants(spark, sf_dir)
    pairs = F.array(*[F.struct(F.lit(f"{k}_at").alias("field"), F.col(f"{k}_micros").alias("utc_micros")) for k in ("published", "collected")])
    return both.select("news_id", F.explode(pairs).alias("p")).select("news_id", "p.field", "p.utc_micros").where("utc_micros IS NOT NULL")


def p7_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = undirected(table(spark, sf_dir, "edge_weights"), "source", "target")
    keys = ["network", "source", "target"]
    daily = latest_daily_amounts(rows, keys, "edge_day", F.col("weight"), ["exported_at", "edge_row_id"])
    out = rolling_totals(daily, keys, P7_END)
    day = F.date_format("day", "yyyy-MM-dd")
    return out.select(*keys, day.alias("edge_day"), "day_no", F.col("total_7").alias("cents_7"), F.col("total_30").alias("cents_30"),
                      (F.col("total_7") / 700).alias("avg_7"), (F.col("total_30") / 3000).alias("avg_30"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = p7_rolling(spark, sf_dir).where("day_no >= 30")
    surge = (F.col("cents_7") >= 2000) & (F.col("cents_7") * 10 >= F.col("cents_30") * 7)
    silence = (F.col("cents_7") == 0) & (F.col("cents_30") >= 2000)
    kind = F.when(surge, "surge").when(silence, "silence")
    return t.select("network", "source", "target", "edge_day", kind.alias("kind")).where("kind IS NOT NULL")


QUERIES = {
    "p3_found": p3_found, "p3_report": p3_report, "p3_table": p3_table,
    "p4_found": p4_found, "p4_kept": p4_kept, "p4_messages": p4_messages,
    "p5_found": p5_found, "p5_instants": p5_instants,
    "p7_found": p7_found, "p7_rolling": p7_rolling,
}

_P4 = """
WITH m AS (SELECT row_id, CAST(collected_at AS TIMESTAMPTZ) AS sent, TRY_CAST(trim(metadata['GlobalEventID'], E' \\t\\n\\r') AS DECIMAL(38, 6)) AS id FROM coded_messages),
k AS (SELECT row_id, id, row_number() OVER (PARTITION BY id ORDER BY sent, row_id) AS rn, count(*) OVER (PARTITION BY id) AS n FROM m WHERE id IS NOT NULL)
"""

_P7 = f"""
WITH p AS (SELECT network, least(source, target) AS s, greatest(source, target) AS t, edge_day, weight, exported_at, edge_row_id
  FROM edge_weights WHERE source <> target AND network IS NOT NULL AND edge_day IS NOT NULL AND edge_day <= DATE '{P7_END}'),
d AS (SELECT network, s, t, edge_day, CAST(round(coalesce(weight, 0) * 100) AS BIGINT) AS cents
  FROM p QUALIFY row_number() OVER (PARTITION BY network, s, t, edge_day ORDER BY exported_at DESC, edge_row_id DESC) = 1),
b AS (SELECT network, s, t, min(edge_day) AS first_day FROM d GROUP BY ALL),
c AS (SELECT network, s, t, first_day, CAST(unnest(generate_series(first_day, DATE '{P7_END}', INTERVAL 1 DAY)) AS DATE) AS edge_day FROM b),
f AS (SELECT c.network, c.s, c.t, c.edge_day, c.first_day, coalesce(d.cents, 0) AS cents FROM c LEFT JOIN d USING (network, s, t, edge_day)),
r AS (SELECT network, s AS source, t AS target, edge_day, date_diff('day', first_day, edge_day) + 1 AS day_no,
  CAST(sum(cents) OVER (PARTITION BY network, s, t ORDER BY edge_day ROWS 6 PRECEDING) AS BIGINT) AS cents_7,
  CAST(sum(cents) OVER (PARTITION BY network, s, t ORDER BY edge_day ROWS 29 PRECEDING) AS BIGINT) AS cents_30 FROM f)
"""

_P3 = """
WITH leaf AS (SELECT r.feed, r.file_name, r.file_date, r.file_seq, r.line_no, substr(t.fullkey, 3) AS p, t.type AS jt, CASE WHEN t.type = 'ARRAY' THEN json_extract(r.payload, t.fullkey) END AS items
  FROM (SELECT * FROM raw_lines WHERE json_valid(payload) AND json_type(payload) = 'OBJECT') r, json_tree(r.payload) t WHERE t.type <> 'OBJECT' AND t.fullkey NOT LIKE '%[%' AND t.fullkey <> '$'),
inner_type AS (SELECT *, CASE WHEN jt = 'ARRAY' THEN list_filter(list_transform(json_extract(items, '$[*]'), lambda x: json_type(x)), lambda x: x <> 'NULL')[1] END AS it FROM leaf),
kinds AS (SELECT *, CASE jt WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN NULL WHEN 'ARRAY' THEN
  CASE it WHEN 'VARCHAR' THEN 'list of strings' WHEN 'OBJECT' THEN 'list of objects' WHEN 'BOOLEAN' THEN 'list of booleans' WHEN 'ARRAY' THEN 'list of lists' ELSE CASE WHEN it IS NOT NULL THEN 'list of numbers' END END ELSE 'number' END AS k FROM inner_type),
fields AS (SELECT feed, file_name, file_date, file_seq, p, arg_max(k, line_no) FILTER (k IS NOT NULL) AS k FROM kinds GROUP BY ALL),
files AS (SELECT *, row_number() OVER (PARTITION BY feed ORDER BY file_date, file_seq, file_name) AS no, count(*) OVER (PARTITION BY feed) AS last_no FROM (SELECT DISTINCT feed, file_name, file_date, file_seq FROM fields)),
st AS (SELECT f.feed, f.p, n.no, n.last_no, last_value(f.k IGNORE NULLS) OVER (PARTITION BY f.feed, f.p ORDER BY n.no) AS k FROM fields f JOIN files n USING (feed, file_name, file_date, file_seq)),
ev AS (SELECT a.feed, a.p, a.no, 'added' AS what, NULL AS old, a.k AS new FROM st a LEFT JOIN st b ON a.feed = b.feed AND a.p = b.p AND b.no = a.no - 1 WHERE a.no > 1 AND b.p IS NULL
  UNION ALL SELECT a.feed, a.p, a.no + 1, 'removed', a.k, NULL FROM st a LEFT JOIN st b ON a.feed = b.feed AND a.p = b.p AND b.no = a.no + 1 WHERE a.no < a.last_no AND b.p IS NULL
  UNION ALL SELECT a.feed, a.p, a.no, 'retyped', b.k, a.k FROM st a JOIN st b ON a.feed = b.feed AND a.p = b.p AND b.no = a.no - 1 WHERE a.k <> b.k),
pair AS (SELECT feed, no FROM ev WHERE what <> 'retyped' GROUP BY ALL HAVING count(*) = 2 AND count(*) FILTER (what = 'added') = 1 AND max(new) = max(old)),
out AS (SELECT feed, no, p AS field_path, what AS change_kind, old AS old_type, new AS new_type, NULL AS old_path FROM ev WHERE what = 'retyped' OR (feed, no) NOT IN (SELECT (feed, no) FROM pair)
  UNION ALL SELECT a.feed, a.no, a.p, 'renamed', r.old, a.new, r.p FROM pair JOIN ev a ON a.feed = pair.feed AND a.no = pair.no AND a.what = 'added' JOIN ev r ON r.feed = pair.feed AND r.no = pair.no AND r.what = 'removed')
"""

ORACLE = {
    "p3_found": _P3 + "SELECT file_name, field_path, change_kind FROM out JOIN files USING (feed, no)",
    "p3_report": _P3 + "SELECT feed, file_name, field_path, change_kind, old_type, new_type, old_path FROM out JOIN files USING (feed, no)",
    "p4_found": _P4 + "SELECT row_id FROM k WHERE rn > 1",
    "p4_kept": _P4 + "SELECT CAST(CAST(id AS BIGINT) AS VARCHAR) AS global_event_id, n AS copies, row_id AS kept_row_id FROM k WHERE rn = 1 AND n > 1",
    "p4_messages": _P4 + "SELECT row_id, batch_id, collected_at FROM coded_messages WHERE row_id NOT IN (SELECT row_id FROM k WHERE rn > 1)",
    "p7_rolling": _P7 + "SELECT network, source, target, strftime(edge_day, '%Y-%m-%d') AS edge_day, CAST(day_no AS INTEGER) AS day_no, cents_7, cents_30, cents_7 / 700 AS avg_7, cents_30 / 3000 AS avg_30 FROM r",
    "p7_found": _P7 + """SELECT network, source, target, strftime(edge_day, '%Y-%m-%d') AS edge_day,
  CASE WHEN cents_7 >= 2000 AND cents_7 * 10 >= cents_30 * 7 THEN 'surge' ELSE 'silence' END AS kind
FROM r WHERE day_no >= 30 AND ((cents_7 >= 2000 AND cents_7 * 10 >= cents_30 * 7) OR (cents_7 = 0 AND cents_30 >= 2000))""",
}
