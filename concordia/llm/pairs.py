"""Items that appear together: exact pair counts and lift by a heavy-light decomposition.

Frequent (heavy) items are few by counting: an item in at least ``heavy_share``
of the records can exist only avg-items / heavy_share times. Their pairs are
counted with a dense bit matrix, a row of bits per item, and popcounts of ANDs.
Pairs of two rare (light) items are counted by hash; mixed pairs by probing the
heavy items of the records on a light item's list. Every task sums its counts
before the only shuffle, which carries (a, b, n).

Repeated items of a record count once. Null and empty lists are records without
items; they count in N.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordia.runtime import cut

#: Products expanded at once by a task.
CHUNK = 2_000_000


def _expand(left_rows, left_items, right_rows, right_items, n_rows: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All (left item, right item) of equal rows, in chunks. The right side is sorted by row."""
    start = np.searchsorted(right_rows, np.arange(n_rows + 1))
    count = (start[1:] - start[:-1])[left_rows]
    total = np.cumsum(count)
    at = 0
    while at < len(left_rows):
        stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + CHUNK, "right")))
        c, r = count[at:stop], left_rows[at:stop]
        if n := int(c.sum()):
            inside = np.arange(n) - np.repeat(np.cumsum(c) - c, c)
            yield np.repeat(left_items[at:stop], c), right_items[np.repeat(start[r], c) + inside]
        at = stop


def _partial_counts(column: str, heavy: list[str], only: frozenset[str] | None):
    place = {x: i for i, x in enumerate(heavy)}

    def emit(a: list[str], b: list[str], n) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(n, pa.int64())], names=["item_a", "item_b", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = np.zeros((len(heavy), len(heavy)), np.int64)
        for batch in batches:
            lists = batch.column(column)
            sizes = np.diff(lists.offsets.to_numpy())
            coded = lists.flatten().dictionary_encode()
            names, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
            rows = np.repeat(np.arange(len(sizes)), sizes)
            slot = np.array([place.get(x, -1) for x in names] or [-1], np.int64)
            fit = np.array([only is None or x in only or x in place for x in names] or [False])
            rows, codes = rows[fit[codes]], codes[fit[codes]]
            is_heavy = slot[codes] >= 0

            # heavy x heavy: bit matrix and popcounts
            bits = np.zeros((len(heavy), -(-len(sizes) // 64) * 64), bool)
            bits[slot[codes[is_heavy]], rows[is_heavy]] = True
            words = np.packbits(bits, axis=1).view(np.uint64)
            for i in range(len(heavy)):
                dense[i, i + 1 :] += np.bitwise_count(words[i] & words[i + 1 :]).sum(axis=1, dtype=np.int64)

            # light items: their lists probe the records' heavy items, and meet each other in a hash count
            light_rows, light = rows[~is_heavy], codes[~is_heavy].astype(np.int64)
            if not len(light):
                continue
            found: dict[int, int] = {}
            width = len(names)
            for a, b in _expand(light_rows, light, rows[is_heavy], codes[is_heavy].astype(np.int64), len(sizes)):
                for k, n in zip(*(x.tolist() for x in np.unique(a * width + b, return_counts=True))):
                    found[k] = found.get(k, 0) + n
            for a, b in _expand(light_rows, light, light_rows, light, len(sizes)):
                once = a < b
                for k, n in zip(*(x.tolist() for x in np.unique(a[once] * width + b[once], return_counts=True))):
                    found[k] = found.get(k, 0) + n
                if len(found) > CHUNK:
                    yield emit([names[k // width] for k in found], [names[k % width] for k in found], list(found.values()))
                    found = {}
            if found:
                yield emit([names[k // width] for k in found], [names[k % width] for k in found], list(found.values()))
        i, j = np.nonzero(dense)
        if len(i):
            yield emit([heavy[x] for x in i], [heavy[x] for x in j], dense[i, j])

    return run


def co_occurrence(records: DataFrame, items: Column, min_count: int = 1, min_share: float = 0.0, heavy_share: float = 0.005, most_heavy: int = 1024) -> DataFrame:
    """``item_a`` < ``item_b`` (byte order), ``n_ab``, ``n_a``, ``n_b``, ``n_rows`` (all records) and ``lift`` = n_ab * N / (n_a * n_b).

    Only pairs with n_ab >= min_count and n_ab >= min_share * N. With a min_share, items below it are left out of the pass, as none of
    their pairs can reach it; how many items remain is bounded by avg-items / min_share. Which items are heavy (at most
    ``most_heavy``) affects speed only, never the result.
    """
    clean = F.array_distinct(F.array_compact(F.coalesce(items, F.array().cast("array<string>"))))
    sets = records.select(clean.alias("items"))
    # one entry without an item for each record counts the records in the same pass; the table, a row per item, is read several times
    every = sets.select(F.explode(F.concat("items", F.array(F.lit(None).cast("string")))).alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    every = cut(every)
    counts, total = every.where("item IS NOT NULL"), every.where("item IS NULL").first()
    n_rows = total["n"] if total else 0
    frequent = counts.where(F.col("n") >= max(1, heavy_share * n_rows)).orderBy(F.desc("n"), "item").limit(most_heavy)
    heavy = [r["item"] for r in frequent.collect()]
    least = max(min_count, min_share * n_rows)
    only = None
    if min_share >= 1e-4:
        only = frozenset(r["item"] for r in counts.where(F.col("n") >= least).select("item").collect())

    partial = sets.mapInArrow(_partial_counts("items", heavy, only), "item_a string, item_b string, n bigint")
    lo, hi = F.least("item_a", "item_b").alias("item_a"), F.greatest("item_a", "item_b").alias("item_b")
    pairs = partial.select(lo, hi, "n").groupBy("item_a", "item_b").agg(F.sum("n").alias("n_ab")).where(F.col("n_ab") >= least)
    n_a = counts.select(F.col("item").alias("item_a"), F.col("n").alias("n_a"))
    n_b = counts.select(F.col("item").alias("item_b"), F.col("n").alias("n_b"))
    out = pairs.join(n_a, "item_a").join(n_b, "item_b").withColumn("n_rows", F.lit(n_rows).cast("long"))
    lift = F.col("n_ab").cast("double") * F.col("n_rows") / (F.col("n_a").cast("double") * F.col("n_b"))
    return out.select("item_a", "item_b", "n_ab", "n_a", "n_b", "n_rows", lift.alias("lift"))
