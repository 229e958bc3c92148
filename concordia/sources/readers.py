"""Readers of the pipeline's inputs. All schemas are explicit; nothing is inferred from data.

Fetching over the network is a landing step outside the engine: these readers
take files that have landed.
"""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concordia.functions.scalars import export_timestamp, utc_date
from concordia.operators.events import newest_per_group
from concordia.runtime import existing_paths

EVENT = """layer string, source_name string, source_type string, title string, summary string, body string, url string, published_at string, collected_at string,
topics array<string>, primary_topic string, countries array<string>, country_groups struct<eu:array<string>,external:array<string>>, country_pairs array<array<string>>, metadata map<string,string>"""
VOTES = """id bigint, timestamp string, display_title string, reference string, description string, amendment_subject string, amendment_number string, is_main boolean,
procedure_reference string, procedure_title string, procedure_type string, procedure_stage string, count_for int, count_against int, count_abstention int, count_did_not_vote int, result string, texts_adopted_reference string"""
MEMBER_VOTES = "vote_id bigint, member_id bigint, position string, country_code string, group_code string"

#: Columns of a coded export by position.
EXPORT_COLUMNS = {
    0: "GlobalEventID", 6: "Actor1Name", 7: "Actor1CountryCode", 16: "Actor2Name", 17: "Actor2CountryCode", 26: "EventCode", 27: "EventBaseCode", 28: "EventRootCode",
    30: "GoldsteinScale", 31: "NumMentions", 32: "NumSources", 33: "NumArticles", 34: "AvgTone", 40: "Actor1Geo_CountryCode", 47: "Actor2Geo_CountryCode",
    54: "ActionGeo_CountryCode", 58: "SOURCEURL",
}


VOTE_RECORD = """id string, date string, title string, topic string, countries map<string,string>, groups map<string,string>,
country_vote_counts map<string,struct<`for`:int,against:int,abstain:int>>, group_vote_counts map<string,struct<`for`:int,against:int,abstain:int>>, source string, institution string, url string"""


def read_events(spark: SparkSession, *paths: str, day: str | None = None) -> DataFrame:
    """Events from JSON lines; malformed and empty lines are dropped, paths that are not there give none. With ``day`` only that ``event_date`` partition is read."""
    there = existing_paths(spark, *paths)
    if not there:
        return spark.createDataFrame([], EVENT)
    rows = spark.read.schema(EVENT).option("mode", "DROPMALFORMED").json(there)
    return rows.where(F.col("event_date") == day) if day else rows


def read_layer(spark: SparkSession, root: str, layer: str) -> DataFrame:
    """``rss``, ``gdelt`` or ``combined`` (both) events under ``root``/<layer>, without deduplication, with the older files of rss that lie in ``root`` itself; ``votes``: vote records."""
    if layer == "votes":
        return read_json_array(spark, f"{root}/votes/council_votes.json", VOTE_RECORD)
    names = {"rss": [f"{root}/rss", f"{root}/*.jsonl"], "gdelt": [f"{root}/gdelt"]}
    parts = [read_events(spark, p) for n in (["rss", "gdelt"] if layer == "combined" else [layer]) for p in names[n]]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of files that hold one JSON array each; files that are not there, are malformed or hold anything else give none."""
    if not existing_paths(spark, path):
        return spark.createDataFrame([], schema)
    whole = spark.read.text(path, wholetext=True).where(F.col("value").rlike(r"^\s*\["))
    return whole.select(F.inline(F.from_json("value", f"array<struct<{', '.join(_fields(schema))}>>")))


def _fields(schema: str) -> list[str]:
    """The columns of a schema in the form that a struct takes."""
    return [f"`{f.name}`: {f.dataType.simpleString()}" for f in T._parse_datatype_string(schema).fields]


def read_votes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(VOTES).option("header", True).csv(path)


def read_member_votes(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Member votes. gzip cannot be split, so one task reads a file; ``partitions`` spreads the rows for what follows."""
    rows = spark.read.schema(MEMBER_VOTES).option("header", True).csv(path)
    return rows.repartition(partitions) if partitions else rows


def manifest_urls(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """``url``, ``ts``: last tokens of manifest lines with three tokens at least that name an export; the first ``limit`` in file order."""
    lines = spark.read.text(path).withColumn("_at", F.monotonically_increasing_id())
    tokens = F.split(F.trim("value"), r"\s+")
    urls = lines.where(F.size(tokens) >= 3).select("_at", F.element_at(tokens, -1).alias("url")).where(F.col("url").endswith(".export.CSV.zip"))
    if limit is not None:
        urls = urls.orderBy("_at").limit(limit)
    return urls.select("url", export_timestamp(F.col("url")).alias("ts"))


def history_urls(urls: DataFrame, today: str, days_back: int = 14, per_day: int = 2) -> DataFrame:
    """The newest ``per_day`` files of each of the last ``days_back`` UTC days up to ``today``."""
    dated = urls.where("ts IS NOT NULL").withColumn("day", utc_date(F.col("ts")))
    recent = dated.where((F.col("day") <= F.lit(today).cast("date")) & (F.col("day") > F.date_sub(F.lit(today).cast("date"), days_back)))
    return newest_per_group(recent, ["day"], [F.desc("ts"), F.col("url")], per_day)


def read_exports(spark: SparkSession, *paths: str) -> DataFrame:
    """Rows of zipped tab-separated exports: the first member of each archive, columns by position, all strings. A file with a short row or no archive is dropped whole."""
    names = list(EXPORT_COLUMNS.values())

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, content in frame.itertuples(index=False):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z, z.open(z.namelist()[0]) as member:
                        text = io.TextIOWrapper(member, encoding="utf-8", errors="replace", newline="")
                        rows = [[path, *[row[i] for i in EXPORT_COLUMNS]] for row in csv.reader(text, delimiter="\t")]
                except (zipfile.BadZipFile, IndexError, csv.Error):
                    continue
                yield pd.DataFrame(rows, columns=["file", *names])

    files = spark.read.format("binaryFile").load(list(paths)).select("path", "content")
    return files.mapInPandas(parse, "file string, " + ", ".join(f"{n} string" for n in names))


def read_feeds(spark: SparkSession, path: str, source_name: str, collected_at: str) -> DataFrame:
    """Items of saved RSS files: title, summary, url, published_at. Malformed files give no rows."""
    items = spark.read.format("xml").option("rowTag", "item").option("mode", "DROPMALFORMED").schema("title string, description string, link string, pubDate string").load(path)
    return items.select(F.lit(source_name).alias("source_name"), F.lit("rss").alias("source_type"), "title", F.col("description").alias("summary"), F.lit("").alias("body"), F.col("link").alias("url"), F.col("pubDate").alias("published_at"), F.lit(collected_at).alias("collected_at"))


def read_all_feeds(spark: SparkSession, sources: list[dict], collected_at: str) -> DataFrame:
    """All enabled sources (name, path, enabled) together; one whose files are not there is reported and left out, not fatal."""
    parts = []
    for s in sources:
        if not s.get("enabled", True):
            continue
        if existing_paths(spark, s["path"]):
            parts.append(read_feeds(spark, s["path"], s["name"], collected_at))
        else:
            print(f"source {s['name']} left out: nothing at {s['path']}")
    empty = spark.createDataFrame([], "source_name string, source_type string, title string, summary string, body string, url string, published_at string, collected_at string")
    return reduce(lambda a, b: a.unionByName(b), parts) if parts else empty


def xml_links(pages: DataFrame, base: str) -> DataFrame:
    """Distinct absolute links to .xml files in a column ``html``."""
    href = F.explode(F.regexp_extract_all("html", F.lit(r"""(?i)href\s*=\s*["']([^"']+\.xml)["']"""), F.lit(1))).alias("href")
    root = base.rstrip("/")
    site = "/".join(root.split("/")[:3])
    full = F.when(F.col("href").rlike("^https?://"), F.col("href")).when(F.col("href").startswith("/"), F.concat(F.lit(site), F.col("href"))).otherwise(F.concat(F.lit(root + "/"), F.col("href")))
    return pages.select(href).select(full.alias("url")).distinct()


def inspect(table: DataFrame, sample: int = 5) -> dict:
    """Number of rows, column names and a few rows, for a look at an unknown file."""
    return {"rows": table.count(), "columns": table.columns, "sample": [r.asDict(recursive=True) for r in table.limit(sample).collect()]}
