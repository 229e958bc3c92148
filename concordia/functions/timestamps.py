"""Mixed timestamp strings to one UTC instant.

An ordered cascade of anchored patterns rewrites every accepted form into one
canonical field list (year|month|day|hour|minute|second|fraction|am-pm|zone);
strict field checks and the zone policy then apply once, whatever the form was.
Everything is a built-in expression, so a scan, the cascade and the result stay
in one code-generated stage.

Policy
------
* null, empty, words and impossible dates or times (24:00, 30 February, second 60): null.
* a zone in the text wins: offset, ``Z``, European and US abbreviations at their own fixed
  offset, IANA names, also in square brackets (after an offset the offset counts);
* without a zone the local time is in ``default_zone`` (null or unknown there: UTC);
* a local time that occurs twice means the first; one that is skipped moves forward by the
  skipped time;
* slashed dates follow ``date_order`` (``MDY``, else day first), dotted ones are day first;
  a date alone is local midnight;
* 14 digits are yyyyMMddHHmmss in UTC; 10, 13, 16 digits are epoch seconds, milliseconds,
  microseconds;
* digits finer than a microsecond are cut off.
"""

from __future__ import annotations

import zoneinfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from concordia.runtime import blank_trim, fresh_name

#: Minutes east of UTC of each zone abbreviation.
ABBREVIATIONS = {
    "Z": 0, "UT": 0, "UTC": 0, "GMT": 0,
    "WET": 0, "WEST": 60, "BST": 60, "CET": 60, "MET": 60, "CEST": 120, "MEST": 120, "EET": 120, "EEST": 180, "MSK": 180, "TRT": 180,
    "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420,
    "AKST": -540, "AKDT": -480, "HST": -600,
}

#: English month names by their first three letters.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]

_MONTH = r"(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)"
_LONG = {
    "jan": "uary", "feb": "ruary", "mar": "ch", "apr": "il", "may": "", "jun": "e",
    "jul": "y", "aug": "ust", "sep": "t(?:ember)?", "oct": "ober", "nov": "ember", "dec": "ember",
}
_MONTH_WORD = "(" + "|".join(f"{m}(?:{rest})?" if rest else m for m, rest in _LONG.items()) + r")\.?"
_DAY_WORD = r"(?:(?:mon|tues?|wed(?:nes)?|thu(?:rs)?|fri|sat(?:ur)?|sun)(?:day)?\.?,?\s+)?"
_ZONE = r"(?:\s*(z|[+-]\d{2}:?\d{2}(?::?\d{2})?|[+-]\d{2})(?:\s*\[[^\]|]*\])?|\s+([a-z]{1,5}|[a-z_]+/[a-z0-9_+/-]+)|\s*\[([a-z0-9_+/-]+)\])?"
_CLOCK = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d+))?)?(?:\s*([ap])\.?m\.?)?"

#: Anchored patterns in the order they are tried, each with the canonical field list it rewrites to.
#: The groups of _CLOCK and _ZONE follow the date's three groups.
_REST = "$4|$5|$6|$7|$8|$9$10$11"
CASCADE: list[tuple[str, str, str]] = [
    ("iso", rf"(\d{{4}})-(\d{{2}})-(\d{{2}})(?:[t\s]\s*{_CLOCK})?{_ZONE}", f"$1|$2|$3|{_REST}"),
    ("rfc", rf"{_DAY_WORD}(\d{{1,2}})[\s-]{_MONTH_WORD}[\s-](\d{{4}})(?:,?\s+{_CLOCK})?{_ZONE}", f"$3|$2|$1|{_REST}"),
    ("named", rf"{_DAY_WORD}{_MONTH_WORD}\s+(\d{{1,2}}),?\s+(\d{{4}})(?:,?\s+{_CLOCK})?{_ZONE}", f"$3|$1|$2|{_REST}"),
    ("slashed_mdy", rf"(\d{{1,2}})/(\d{{1,2}})/(\d{{4}})(?:,?\s+{_CLOCK})?{_ZONE}", f"$3|$1|$2|{_REST}"),
    ("slashed_dmy", rf"(\d{{1,2}})/(\d{{1,2}})/(\d{{4}})(?:,?\s+{_CLOCK})?{_ZONE}", f"$3|$2|$1|{_REST}"),
    ("slashed_ymd", rf"(\d{{4}})/(\d{{1,2}})/(\d{{1,2}})(?:[t\s]\s*{_CLOCK})?{_ZONE}", f"$1|$2|$3|{_REST}"),
    ("dotted", rf"(\d{{1,2}})\.(\d{{1,2}})\.(\d{{4}})(?:,?\s+{_CLOCK})?{_ZONE}", f"$3|$2|$1|{_REST}"),
    ("basic", r"(\d{4})(\d{2})(\d{2})t(\d{2})(\d{2})(\d{2})?(?:[.,](\d+))?(z|[+-]\d{2}:?\d{2})?", "$1|$2|$3|$4|$5|$6|$7||$8"),
    ("digits14", r"(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})", "$1|$2|$3|$4|$5|$6|||z"),
]


#: The commonest form, tried before all others: ISO-8601 with seconds and an offset reads as an instant without a field list.
DIRECT = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(?:\.\d+)?(?:Z|[+-](?:0\d|1[0-4]):[0-5]\d)$"


def known_zones(spark: SparkSession | None = None) -> list[str]:
    """IANA names the executors' JVM understands (asked from the driver's JVM; its own table where there is none)."""
    spark = spark or SparkSession.getActiveSession()
    try:
        jvm = spark._jvm
        names = jvm.java.lang.String.join("|", jvm.java.time.ZoneId.getAvailableZoneIds()).split("|")
    except Exception:
        names = sorted(zoneinfo.available_timezones())
    return sorted(n for n in names if "/" in n or n == "UTC")


def with_utc_micros(df: DataFrame, out: str, text: Column | str, default_zone: Column | str = "UTC", date_order: Column | str = "DMY", zones: list[str] | None = None) -> DataFrame:
    """``df`` with ``out``: microseconds since 1970-01-01 UTC of ``text``, null where it denotes no instant (see the module's policy).

    ``default_zone`` and ``date_order`` are columns or plain values. The work is split into projections: each reads
    the one before several times, so the optimizer keeps them apart and every regular expression runs once.
    """
    zones = zones if zones is not None else known_zones(df.sparkSession)
    col = lambda x: x if isinstance(x, Column) else F.lit(x)
    text = F.col(text) if isinstance(text, str) else text
    names = [fresh_name(df, f"_{n}") for n in ("text", "fields", "part", "local", "zone", "direct")]
    s, fields, part, local, zone, direct = map(F.col, names)
    before = list(df.columns)

    df = df.withColumn(names[0], blank_trim(text))
    df = df.withColumn(names[5], F.when(s.rlike(DIRECT), s.try_cast("timestamp")))
    month_first = F.coalesce(F.upper(F.trim(col(date_order))) == "MDY", F.lit(False))
    canonical = F.lit(None).cast("string")
    low = F.lower(s)
    for kind, pattern, to in reversed(CASCADE):
        whole = f"^{pattern}$"
        hit = low.rlike(whole)
        if kind == "slashed_mdy":
            hit = hit & month_first
        canonical = F.when(hit, F.regexp_replace(low, whole, to)).otherwise(canonical)
    df = df.withColumn(names[1], F.when(direct.isNull(), canonical))
    df = df.withColumn(names[2], F.split(fields, r"\|", -1))

    def number(i: int) -> Column:
        return F.nullif(part[i], F.lit("")).cast("int")

    month = F.when(part[1].rlike(r"^\d+$"), F.regexp_extract(part[1], r"^(\d+)$", 1).try_cast("int")).otherwise(
        F.nullif(F.array_position(F.array(*map(F.lit, MONTHS)), F.substring(part[1], 1, 3)).cast("int"), F.lit(0))
    )
    hour = F.coalesce(number(3), F.lit(0))
    hour = F.when(part[7] == "", hour).when(hour.between(1, 12), hour % 12 + F.when(part[7] == "p", 12).otherwise(0))
    minute, second = F.coalesce(number(4), F.lit(0)), F.coalesce(number(5), F.lit(0))
    # hours, minutes and seconds out of range, and days a month does not have, give null
    sane = (second <= 59) & (hour <= 23)
    stamp = F.when(sane, F.try_make_timestamp(number(0), month, number(2), hour, minute, second.cast("decimal(16,6)"), F.lit("UTC")))
    fraction = F.when(part[6] == "", F.lit("0")).otherwise(F.rpad(F.substring(part[6], 1, 6), 6, "0")).cast("long")
    df = df.withColumn(names[3], F.struct(stamp.alias("at"), fraction.alias("micros")))
    df = df.withColumn(names[4], part[8])

    minutes = F.create_map(*(F.lit(x) for kv in ABBREVIATIONS.items() for x in kv))
    bare = F.regexp_replace(zone, ":", "")
    off_h, off_m = F.substring(bare, 2, 2).try_cast("int"), F.coalesce(F.nullif(F.substring(bare, 4, 2), F.lit("")).try_cast("int"), F.lit(0))
    east = F.when(zone.startswith("-"), F.lit(-1)).otherwise(F.lit(1)) * (off_h * 60 + off_m)
    offset = F.when(zone.rlike(r"^[+-]\d"), F.when((off_h <= 18) & (off_m <= 59), east)).otherwise(F.try_element_at(minutes, F.upper(zone)))
    written = F.regexp_extract(s, r"(?<![A-Za-z_])([A-Za-z_]+(?:/[A-Za-z0-9_+-]+)+|UTC)\]?$", 1)
    home = F.when(col(default_zone).isin(zones), col(default_zone)).otherwise(F.lit("UTC"))
    local_zone = F.when(zone == "", home).when(zone.isNotNull() & written.isin(zones), written)
    df = df.withColumn(names[2], F.struct(offset.cast("long").alias("offset"), local_zone.alias("zone")))

    digits = F.length(s)
    epoch = F.when(digits.isin(10, 13, 16) & s.rlike(r"^\d+$"), s.try_cast("long") * F.when(digits == 10, 1_000_000).when(digits == 13, 1_000).otherwise(1))
    at = F.when(part["offset"].isNotNull(), F.unix_micros(local["at"]) - part["offset"] * 60_000_000).when(
        part["zone"].isNotNull(), F.unix_micros(F.to_utc_timestamp(local["at"], F.coalesce(part["zone"], F.lit("UTC"))))
    )
    return df.select(*[F.col(f"`{c}`") for c in before], F.coalesce(F.unix_micros(direct), epoch, at + local["micros"]).alias(out))
