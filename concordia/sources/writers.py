"""Writers of events, vote records and artifact documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from concordia.functions.scalars import storage_date
from concordia.operators.events import network_events, upsert
from concordia.operators.networks import snapshot
from concordia.operators.votes import run_summary
from concordia.runtime import existing_paths, write_text


def append_events(events: DataFrame, path: str, today: str) -> dict[str, int]:
    """Events appended under the day they belong to (``today`` where it cannot be told); {day: number written}. Nothing is deduplicated against what is there."""
    day = F.date_format(F.coalesce(storage_date(F.col("published_at"), F.col("collected_at")), F.lit(today).cast("date")), "yyyy-MM-dd")
    dated = events.withColumn("event_date", day).persist()  # written and counted
    try:
        dated.write.mode("append").partitionBy("event_date").json(path)
        return {r["event_date"]: r["count"] for r in dated.groupBy("event_date").count().orderBy("event_date").collect()}
    finally:
        dated.unpersist()


def append_day(events: DataFrame, path: str, day: str) -> None:
    events.withColumn("event_date", F.lit(day)).write.mode("append").partitionBy("event_date").json(path)


def overwrite_days(events: DataFrame, path: str, order: str = "ingest_seq", per_day: int | None = None) -> None:
    """The days of ``events`` (``event_date``) replaced, other days left alone. ``per_day`` keeps the first rows of a day in arrival order (the sink's own limit)."""
    if per_day is not None:
        rank = F.row_number().over(Window.partitionBy("event_date").orderBy(order))
        events = events.withColumn("_rank", rank).where(F.col("_rank") <= per_day).drop("_rank")
    events.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date").parquet(path)


def merge_records(spark, new: DataFrame, path: str, key: str, out: str) -> None:
    """Existing records at ``path`` (nothing there: an empty start) with ``new`` in their place, one per ``key``, by date and key, written to ``out``, another folder.

    Anything else that keeps the existing records from being read is an error: without them the merge would lose them.
    """
    existing = spark.read.schema(new.schema).option("mode", "FAILFAST").json(path) if existing_paths(spark, path) else new.limit(0)
    order = [c for c in ("date", key) if c in new.columns]
    upsert(existing, new, [key]).sort(*order).write.mode("overwrite").json(out)


def save_run(records: DataFrame, root: str, saved: DataFrame | None = None, sample: int = 10, newest: int = 100) -> None:
    """What a run over the vote records leaves for a look: its counts, a few records by date and id, and the newest ones."""
    run_summary(records, saved).coalesce(1).write.mode("overwrite").json(f"{root}/votes_summary")
    records.orderBy("date", "id").limit(sample).coalesce(1).write.mode("overwrite").json(f"{root}/votes_sample")
    latest(records, newest).coalesce(1).write.mode("overwrite").json(f"{root}/votes_latest_{newest}")


def latest(records: DataFrame, n: int = 100) -> DataFrame:
    """The newest records by date, then id."""
    return records.orderBy(F.desc("date"), F.desc("id")).limit(n)


def artifact_name(window: str, kind: str, mode: str) -> str:
    suffix = "" if mode == "all" else f"_{mode}"
    return f"{window}{kind and '_' + kind}{suffix}.json"


def save_documents(documents: DataFrame, roots: list[str], kind: str, scope: tuple[str, str] = ("window_days", "mode")) -> list[str]:
    """One JSON file per document under each of ``roots``, named by window, kind and mode; the names. There are as many documents as windows and modes."""
    window, mode = scope
    names = []
    for r in documents.select(window, mode, F.to_json(F.struct(*[F.col(c) for c in documents.columns if c not in scope], F.col(mode))).alias("text")).orderBy(window, mode).collect():
        names.append(artifact_name(f"{r[window]}d", kind, r[mode]))
        for root in roots:
            write_text(documents.sparkSession, f"{root}/{names[-1]}", r["text"])
    return names


def save_snapshot(events: DataFrame, path: str) -> None:
    """The network of one day's events as a JSON file."""
    text = snapshot(network_events(events)).select(F.to_json(F.struct("event_count", "nodes", "edges")).alias("text")).first()["text"]
    write_text(events.sparkSession, path, text)


def write_documents(rows: DataFrame, path: str, by: list[str]) -> None:
    """One JSON document per row, in folders by ``by``."""
    rows.write.mode("overwrite").partitionBy(*by).json(path)


def invalid_members(members: DataFrame) -> DataFrame:
    """Member records without a name, a country code or a group, with the reason; reported, never fatal."""
    reason = F.when(F.coalesce("full_name", F.lit("")) == "", "no name").when(F.coalesce("country_code", F.lit("")) == "", "no country").when(F.coalesce("group_short", F.lit("")) == "", "no group")
    return members.withColumn("reason", reason).where("reason IS NOT NULL")
