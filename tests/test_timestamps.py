"""The timestamp cascade against hand-worked cases and an independent parser built on datetime and zoneinfo."""

import re
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest

from concordia.functions.timestamps import ABBREVIATIONS, with_utc_micros
from concordia.plans.pipeline_queries import p5_found
from concordia.runtime import table

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def micros(y, mo, d, h=0, mi=0, s=0, us=0):
    return (datetime(y, mo, d, h, mi, s, us, tzinfo=timezone.utc) - EPOCH) // timedelta(microseconds=1)


CASES = [
    ("2025-10-01T01:02:03Z", "Europe/Paris", "DMY", micros(2025, 10, 1, 1, 2, 3)),
    (" 2025-10-01T01:02:03.1234567+02:00\t", None, None, micros(2025, 9, 30, 23, 2, 3, 123456)),
    ("2025-10-01 01:02:03-0430", None, None, micros(2025, 10, 1, 5, 32, 3)),
    ("2025-10-01", "Europe/Budapest", "DMY", micros(2025, 9, 30, 22)),
    ("2025-10-01", None, None, micros(2025, 10, 1)),
    ("2025-10-26T02:30:00", "Europe/Berlin", "DMY", micros(2025, 10, 26, 0, 30)),  # occurs twice: the first
    ("2026-03-29T02:30:00", "Europe/Berlin", "DMY", micros(2026, 3, 29, 1, 30)),  # skipped: moved forward
    ("2026-03-29T02:30:00[Europe/Berlin]", "Asia/Shanghai", "DMY", micros(2026, 3, 29, 1, 30)),
    ("2026-03-08T02:30:00 America/New_York", None, None, micros(2026, 3, 8, 7, 30)),
    ("2025-10-26T02:30:00+01:00[Europe/Berlin]", None, None, micros(2025, 10, 26, 1, 30)),
    ("2025-10-26T02:30:00 Europe/Nowhere", "Europe/Berlin", "DMY", None),
    ("Sun, 26 Oct 2025 07:18:42 CET", "Asia/Shanghai", "MDY", micros(2025, 10, 26, 6, 18, 42)),
    ("Wed, 01 Oct 2025 14:49:26 BST", None, None, micros(2025, 10, 1, 13, 49, 26)),
    ("1 Oct 2025 21:25:50 +0200", None, None, micros(2025, 10, 1, 19, 25, 50)),
    ("Sat, 09 May 2026 02:41:15 +0000", None, None, micros(2026, 5, 9, 2, 41, 15)),
    ("Wed, 01 Oct 2025 14:49:26 XYZ", None, None, None),
    ("01/02/2026 03:57", "UTC", "DMY", micros(2026, 2, 1, 3, 57)),
    ("01/02/2026 03:57 PM", "UTC", "MDY", micros(2026, 1, 2, 15, 57)),
    ("13/02/2026 03:57", "UTC", "MDY", None),
    ("01.02.2026 03:57", "UTC", "MDY", micros(2026, 2, 1, 3, 57)),
    ("March 9, 2026 12:05 AM", "UTC", "DMY", micros(2026, 3, 9, 0, 5)),
    ("March 9, 2026 12:05 PM", "UTC", "DMY", micros(2026, 3, 9, 12, 5)),
    ("March 9, 2026 13:05 PM", "UTC", "DMY", None),
    ("20251001072838", "Asia/Shanghai", "DMY", micros(2025, 10, 1, 7, 28, 38)),
    ("20251001T072838Z", "Asia/Shanghai", "DMY", micros(2025, 10, 1, 7, 28, 38)),
    ("20251301072838", None, None, None),
    ("1759362102", None, None, 1759362102000000),
    ("1759304503566", None, None, 1759304503566000),
    ("1759288887304870", None, None, 1759288887304870),
    ("175928888730", None, None, None),
    ("0000-00-00 00:00:00", None, None, None),
    ("2026-02-30T10:00:00Z", None, None, None),
    ("2026-02-28T24:00:00Z", None, None, None),
    ("2026-02-28T23:59:60Z", None, None, None),
    ("2026-02-28T10:00:00+9999", None, None, None),
    ("today, 14:05", None, None, None),
    ("n/a", None, None, None),
    ("", None, None, None),
    (None, "Europe/Berlin", "DMY", None),
    ("x" * 100_000, None, None, None),
    ("9" * 5000, None, None, None),
]


def test_cases(spark):
    rows = [(i, t, z, o, 7) for i, (t, z, o, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "id int, _text string, zone string, ord string, out_ int")
    from pyspark.sql import functions as F

    got = {r["id"]: r["out"] for r in with_utc_micros(df, "out", "_text", F.col("zone"), F.col("ord")).collect()}
    wrong = [(CASES[i], got[i]) for i in got if got[i] != CASES[i][3]]
    assert not wrong and len(got) == len(CASES)


def test_empty_table(spark):
    df = spark.createDataFrame([], "a string")
    assert with_utc_micros(df, "m", "a").count() == 0


FORMS = [  # strptime forms the independent parser tries, after the zone has been cut off
    "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M", "%Y-%m-%d %H:%M", "%Y-%m-%d", "%a, %d %b %Y %H:%M:%S", "%d %b %Y %H:%M:%S",
    "%d.%m.%Y %H:%M", "%B %d, %Y %I:%M %p", "%Y%m%dT%H%M%S",
]


def brute(text, home, order):
    s = (text or "").strip()
    if re.fullmatch(r"\d{10}|\d{13}|\d{16}", s):
        return int(s) * {10: 10**6, 13: 1000, 16: 1}[len(s)]
    if re.fullmatch(r"\d{14}", s):
        s = f"{s[:8]}T{s[8:]}Z"
    zone = None
    if m := re.search(r"(?:\[([^]]+)\]| ([A-Z][a-z]+/\w+))$", s):
        zone, s = ZoneInfo(m[1] or m[2]), s[: m.start()]
    elif m := re.search(r"(?<=[\d ])(Z|[A-Z]{2,4})$", s):
        if m[1] in ABBREVIATIONS:
            zone, s = timezone(timedelta(minutes=ABBREVIATIONS[m[1]])), s[: m.start()].strip()
    elif m := re.search(r"([+-])(\d\d):?(\d\d)$", s):
        if re.search(r":\d\d", s[: m.start()]):
            zone, s = timezone((1 if m[1] == "+" else -1) * timedelta(hours=int(m[2]), minutes=int(m[3]))), s[: m.start()].strip()
    us = 0
    if m := re.search(r"(:\d\d)\.(\d+)$", s):
        us, s = int(m[2][:6].ljust(6, "0")), s[: m.start()] + m[1]
    forms = [*FORMS, *(["%m/%d/%Y %I:%M %p", "%m/%d/%Y %H:%M"] if order == "MDY" else ["%d/%m/%Y %H:%M"])]
    for f in forms:
        try:
            t = datetime.strptime(s, f)
        except ValueError:
            continue
        t = t.replace(tzinfo=zone or ZoneInfo(home or "UTC"))  # fold=0: the first of two; a skipped time keeps the offset before it
        return (t - EPOCH) // timedelta(microseconds=1) + us if isinstance(t.tzinfo, timezone) else (t.astimezone(timezone.utc) - EPOCH) // timedelta(microseconds=1) + us
    return None


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.01"])
def test_all_rows_against_brute_force(spark, sf_dir):
    home = {r["source_name"]: (r["home_zone"], r["date_order"]) for r in table(spark, sf_dir, "sources").collect()}
    want = set()
    for r in table(spark, sf_dir, "news_items").select("news_id", "source_name", "published_at", "collected_at").collect():
        z, o = home.get(r["source_name"], (None, None))
        for field, default in (("published_at", z), ("collected_at", None)):
            if (v := brute(r[field], default, o)) is not None:
                want.add((r["news_id"], field, v))
    got = {tuple(r) for r in p5_found(spark, sf_dir).collect()}
    assert got == want
