"""Messages delivered more than once: exactly one copy of each identifier stays.

One Bloom filter per time bucket screens identifiers that no other bucket can
hold; only possible repeats are verified, exactly, and only against the entries
of the buckets whose filter matched.

Spark form: a filter is a table of 64-bit words keyed (word) with one entry per
bucket, each identifier setting a few bits of one word. Building it is a
map-side-combined ``bit_or``; probing it is one equi-join that meets all
buckets of a word at once, without a shuffle while the filters are small enough
to be sent to every executor. What is definitely new never leaves its task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordia.runtime import blank_trim, cut, settled

#: Later than any instant a message can carry; for copies whose time cannot be read.
_NEVER = (1 << 63) - 1


def numeric_identity(raw: Column) -> Column:
    """Identifier as text, equal where the identifiers are equal as numbers, blanks aside; null where blank.

    What is no number keeps its trimmed spelling, marked so that it cannot meet a number.
    """
    s = blank_trim(raw)
    usual = s.rlike(r"^[1-9]\d*$")
    plain = s.rlike(r"^[+-]?\d+(\.\d*)?$")
    body = F.regexp_replace(F.regexp_replace(s, r"^\+", ""), r"(\.\d*?)0+$", "$1")
    body = F.regexp_replace(F.regexp_replace(body, r"\.$", ""), r"^(-?)0+(?=\d)", "$1")
    body = F.when(body == "-0", "0").otherwise(body)
    other = F.try_to_number(F.lit("x"), F.lit("9")).cast("string")  # typed null
    sci = F.when(s.rlike(r"(?i)^[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d{1,2})?$"), s.try_cast("decimal(38,6)").cast("string"))
    sci = F.regexp_replace(F.regexp_replace(sci, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    return F.when(usual, s).when(s != "", F.coalesce(F.when(plain, body), sci, other, F.concat(F.lit("text:"), s)))


def _mask(code: Column, bits: int) -> Column:
    """``bits`` bits of a 64-bit word, from disjoint parts of a hash."""
    return reduce(lambda a, b: a.bitwiseOR(b), (F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(code, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(bits)))


def _keyed(messages: DataFrame, key: Column, instant: Column, order_id: Column) -> DataFrame:
    """``key``, ``instant``, ``order_id`` of the messages with an identifier, worked out once and written."""
    rows = messages.select(settled(key).alias("key"), F.coalesce(instant, F.lit(_NEVER)).alias("instant"), order_id.cast("long").alias("order_id"))
    return cut(rows.where("key IS NOT NULL"))


def _first(rows: DataFrame, bucket_days: int = 7, bits_per_id: int = 10, probes: int = 4, broadcast_bytes: int = 8 << 20) -> DataFrame:
    width = bucket_days * 86_400_000_000
    rows = rows.withColumn("bucket", F.when(F.col("instant") < _NEVER, F.floor(F.col("instant") / width)).otherwise(F.lit(_NEVER)).cast("long"))

    # the storage, bucket by bucket: one entry per identifier and bucket
    storage = cut(
        rows.groupBy("bucket", "key")
        .agg(F.min(F.struct("instant", "order_id")).alias("first"), F.count(F.lit(1)).alias("n"))
        .withColumn("code", F.xxhash64(F.lit("bloom"), "key"))
    )
    size = storage.groupBy("bucket").count().agg(F.max("count").alias("largest"), F.count(F.lit(1)).alias("buckets")).first()
    words = max(64, int((size["largest"] or 1) * bits_per_id / 64) + 1)

    stored = storage.withColumn("word", F.pmod(F.xxhash64(F.lit("word"), "key"), F.lit(words))).withColumn("mask", _mask(F.col("code"), probes))
    filters = stored.groupBy("word", "bucket").agg(F.bit_or("mask").alias("bits")).groupBy("word").agg(F.collect_list(F.struct("bucket", "bits")).alias("filters"))  # one entry per bucket at most
    if words * size["buckets"] * 16 <= broadcast_bytes:  # both factors are known: the filters cannot be larger; beyond this they are joined by shuffle
        filters = F.broadcast(filters)
    elsewhere = F.expr("exists(filters, f -> f.bucket <> bucket AND (f.bits & mask) = mask)")
    # an identifier alone in its bucket that no other bucket's filter knows is new for certain; of the others every entry is possibly repeated,
    # and as the filter of each of its buckets matched the entry from each other one, all entries that must meet are among them
    possible = stored.join(filters, "word").where(elsewhere | (F.col("n") > 1))
    exact = possible.groupBy("key").agg(F.min("first").alias("first"), F.sum("n").alias("n"))  # a row per bucket at most
    return exact.where("n > 1").select("key", "n", "first.instant", "first.order_id")


def first_copies(messages: DataFrame, key: Column, instant: Column, order_id: Column, **options) -> DataFrame:
    """The copy that stays of each identifier that occurs more than once.

    Columns: ``key``, ``n`` (copies), ``instant`` and ``order_id`` of the copy that stays: the earliest instant, among
    equals the smallest order_id. ``instant`` is in microseconds (null: later than all others). Rows with a null key are
    no messages with an identifier and take no part.

    Options: ``bucket_days``, ``bits_per_id``, ``probes``, and ``broadcast_bytes``, up to which the filters are sent to every executor.
    A hot identifier is combined map-side within its bucket; after that a group holds at most one row per bucket.
    """
    return _first(_keyed(messages, key, instant, order_id), **options)


def repeated_copies(messages: DataFrame, key: Column, instant: Column, order_id: Column, **options) -> DataFrame:
    """``key`` and ``order_id`` of every copy to drop.

    Rows with a null, empty or blank identifier are never dropped. order_id must be unique; it is the tie-break.
    The join below has one row per repeated identifier on its right; a hot identifier on the left is split by
    adaptive skew handling, since the right row can be copied to every split.
    """
    rows = _keyed(messages, key, instant, order_id)
    keep = _first(rows, **options).select("key", F.col("order_id").alias("kept_id"))
    return rows.select("key", "order_id").join(keep, "key").where("order_id <> kept_id").select("key", "order_id")


def keep_one_copy(messages: DataFrame, key: Column, instant: Column, order_id: str, **options) -> DataFrame:
    """``messages`` without the copies to drop, all columns as they were."""
    drop = repeated_copies(messages, key, instant, F.col(order_id), **options).select(F.col("order_id").alias(order_id))
    return messages.join(drop, order_id, "left_anti").select(*[F.col(f"`{c}`") for c in messages.columns])
