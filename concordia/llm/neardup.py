"""Near-duplicate records: all pairs of word sets with Jaccard similarity at or above a threshold, exactly.

T-occurrence search with DivideSkip. Records with equal word sets are one class,
searched once. Words are put in one global order, rare ones first; two similar
records must share a word among the first n - ceil(t*n) + 1 of each (what is
left could not reach the overlap T). So each of these words' lists is a cell in
which the search runs: a record's lists within the cell are split into a few
long ones and the short rest; the short ones are merged with a heap, what
reaches T minus the number of long lists is probed in these by binary search,
and what reaches T stays. A pair is reported in the cell of its first common
word only.

Scale: rare and frequent are told apart by a sketch of fixed size, a count for
each of 2^22 buckets of words; a bucket met once is a list of one record and
leaves before anything is shuffled. Any order finds the same pairs; the better
it puts rare words first, the shorter the lists. A list longer than ``block`` is
cut into blocks and searched block pair by block pair, so a task's memory is
bounded whatever the list's length, and no row is dropped.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from heapq import merge
from itertools import combinations, groupby
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordia.runtime import cut, settled

#: Buckets of the sketch of word frequencies, as a power of two.
SKETCH_BITS = 22
#: Bits of a word's code that hold its hash; above them stands its frequency class.
_HASH_BITS = 57


def word_set(text: Column) -> Column:
    """Distinct words of a text: tags (``<`` to ``>``) and character references read as blanks, lower case, longest runs of letters or digits."""
    plain = F.regexp_replace(F.regexp_replace(text, r"<[^>]*>", " "), r"&#?\w+;", " ")
    return F.array_distinct(F.regexp_extract_all(F.lower(plain), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1)))


def need(n: int, percent: int) -> int:
    """The least overlap of a record of n words with any record similar enough."""
    return -(-n * percent // 100)


def _sketch(reps: DataFrame) -> np.ndarray:
    """How often words of each bucket occur; at most 2 ** SKETCH_BITS rows are collected, whatever the data."""
    words = reps.select(F.explode("hashes").alias("w")).groupBy(F.col("w").bitwiseAND(F.lit((1 << SKETCH_BITS) - 1)).cast("int").alias("b")).agg(F.count(F.lit(1)).alias("n"))
    found = words.toArrow()
    out = np.zeros(1 << SKETCH_BITS, np.int32)
    out[found.column("b").to_numpy()] = np.minimum(found.column("n").to_numpy(), (1 << 31) - 1)
    return out


def _order(shared, percent: int, leading: bool):
    """Word hashes to codes whose natural order is rare words first: (rep, word) of the leading ones that may meet another record's, or (rep, sorted codes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = shared.value
        for batch in batches:
            lists = batch.column("hashes")
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            n = sketch[flat & ((1 << SKETCH_BITS) - 1)]
            kind = np.floor(2 * np.log2(np.maximum(n, 1))).astype(np.int64)  # at most 61
            codes = kind << _HASH_BITS | (flat >> (64 - _HASH_BITS)) & ((1 << _HASH_BITS) - 1)
            rows = np.repeat(np.arange(len(sizes)), sizes)
            at = np.lexsort((codes, rows))
            codes = codes[at]
            if not leading:
                offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([batch.column("rep"), pa.ListArray.from_arrays(offsets, pa.array(codes, pa.int64()))], names=["rep", "codes"])
                continue
            inside = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            first = (inside < np.repeat(sizes - -(-sizes * percent // 100) + 1, sizes)) & (n[at] > 1)
            reps = batch.column("rep").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(reps[rows[first]]), pa.array(codes[first], pa.int64())], names=["rep", "word"])

    return run


def _merged(lists: list[list[int]]) -> Iterator[tuple[int, int]]:
    """(record, in how many of the sorted lists it is), by a heap over the lists' heads."""
    if len(lists) == 1:
        yield from ((m, 1) for m in lists[0])
        return
    last, count = -1, 0
    for m in merge(*lists):
        if m == last:
            count += 1
        else:
            if count:
                yield last, count
            last, count = m, 1
    if count:
        yield last, count


def _search(cell: int, own: list[tuple[int, int, list[int]]], i: int, j: int, percent: int) -> Iterator[tuple[int, int]]:
    """DivideSkip within one cell: pairs (rep, rep) whose first common word is ``cell``. own: (rep, block, sorted codes)."""
    own.sort(key=lambda r: len(r[2]))
    at = [bisect_left(codes, cell) for _, _, codes in own]
    heads = [set(codes[:n]) for n, (_, _, codes) in zip(at, own)]
    if len(own) <= 8 and not any(a.isdisjoint(b) for a, b in combinations(heads, 2)):
        return  # all of them meet in an earlier cell
    lists: dict[int, list[int]] = {}
    for k, (rep, block, codes) in enumerate(own):
        n = len(codes)
        least = need(n, percent)
        words = codes[at[k] + 1 :]  # before the cell's word nothing may be common
        held = sorted((lists[w] for w in words if w in lists), key=len)
        # T counts the cell's own word, which all share
        target = least - 1
        if len(held) >= target:
            longest = len(held[-1]) if held else 1
            n_long = min(max(0, target - 1), int(target / (0.01 * log(max(2, longest)) + 1)), max(0, len(held) - 1)) if longest > 8 else 0
            short, long_ = held[: len(held) - n_long], held[len(held) - n_long :]
            for m, count in _merged(short) if target > 0 else ((m, 0) for m in range(k)):
                other_rep, other_block, other = own[m]
                if count + n_long < target or len(other) < least or (i != j and block == other_block):
                    continue
                for posting in long_:
                    p = bisect_left(posting, m)
                    count += p < len(posting) and posting[p] == m
                # overlap / union >= t, in whole numbers; nothing common before the cell's word
                common = count + 1
                if common * 100 >= percent * (n + len(other) - common):
                    if heads[k].isdisjoint(heads[m]):
                        yield (other_rep, rep) if other_rep < rep else (rep, other_rep)
        for w in words:
            lists.setdefault(w, []).append(k)


def _cells(percent: int):
    def rows(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            yield from zip(*[batch.column(k).to_pylist() for k in ("word", "i", "j", "rep", "block", "codes")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int]] = []

        def flush():
            a, b = zip(*out)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for (word, i, j), group in groupby(rows(batches), key=lambda r: r[:3]):
            for pair in _search(word, [r[3:] for r in group], i, j, percent):
                out.append(pair)
                if len(out) >= 50_000:
                    yield flush()
        if out:
            yield flush()

    return run


def classes(records: DataFrame, record_id: str, text: Column) -> DataFrame:
    """``id``, ``rep`` (the least id with the same word set), ``hashes`` (of the representatives only): records that have words; materialised."""
    words = records.select(F.col(record_id).cast("long").alias("id"), settled(word_set(text)).alias("words"))
    hashed = words.select("id", settled(F.array_sort(F.array_distinct(F.transform("words", lambda w: F.xxhash64(w))))).alias("hashes")).where("id IS NOT NULL AND size(hashes) > 0")
    keyed = cut(hashed.withColumns({"k1": F.xxhash64("hashes"), "k2": F.xxhash64(F.lit(2), "hashes"), "size": F.size("hashes")}))
    reps = keyed.groupBy("k1", "k2", "size").agg(F.min("id").alias("rep"))
    return cut(keyed.join(reps, ["k1", "k2", "size"]).select("id", "rep", F.when(F.col("id") == F.col("rep"), F.col("hashes")).alias("hashes")))


def similar_classes(members: DataFrame, percent: int = 80, block: int = 2000) -> DataFrame:
    """``a`` < ``b``: class representatives at or above the threshold. ``members`` as of :func:`classes`."""
    reps = members.where("id = rep").select("rep", "hashes")
    shared = members.sparkSession.sparkContext.broadcast(_sketch(reps))
    postings = reps.mapInArrow(_order(shared, percent, True), "rep bigint, word bigint")
    ordered = reps.mapInArrow(_order(shared, percent, False), "rep bigint, codes array<bigint>")
    sizes = postings.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / block).cast("int")
    at = postings.join(sizes, "word").withColumns({"blocks": blocks, "block": F.pmod(F.xxhash64("rep"), blocks).cast("int")})
    other = F.explode(F.expr("sequence(0, blocks - 1)"))
    placed = at.select("word", "rep", "block", other.alias("o")).select("word", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"), "rep", "block")
    full = placed.join(ordered, "rep")
    return full.repartition("word", "i", "j").sortWithinPartitions("word", "i", "j").mapInArrow(_cells(percent), "a bigint, b bigint")


def similar_pairs(records: DataFrame, record_id: str, text: Column, percent: int = 80) -> DataFrame:
    """``id_a`` < ``id_b``: every pair of records at or above the threshold, copies included. Records without words (null, empty) have none.

    ids must be unique. Exact copies are found as classes; their pairs are written out here because this form asks for pairs.
    """
    members = classes(records, record_id, text)
    links = similar_classes(members, percent)
    ids = members.select("id", "rep")
    left, right = ids.select(F.col("id").alias("x"), F.col("rep").alias("a")), ids.select(F.col("id").alias("y"), F.col("rep").alias("b"))
    across = links.join(left, "a").join(right, "b").select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))
    within = left.join(right, F.col("a") == F.col("b")).where("x < y").select(F.col("x").alias("id_a"), F.col("y").alias("id_b"))
    return across.unionByName(within)


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``node``, ``root``: the least node reachable over ``links`` (a, b). Each round takes the least root around and then jumps to the root's root, so rounds grow with the logarithm of the longest chain."""
    roots = nodes.select(F.col("node"), F.col("node").alias("root"))
    both = cut(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    while True:
        around = both.join(roots.select(F.col("node").alias("b"), F.col("root").alias("near")), "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        best = roots.join(around, "node", "left").select("node", "root", F.least("root", F.coalesce("near", "root")).alias("next"))
        best = cut(best)
        jump = best.select(F.col("node").alias("next"), F.col("next").alias("far"))
        after = cut(best.join(jump, "next", "left").select("node", "root", F.least("next", F.coalesce("far", "next")).alias("new")))
        roots = after.select("node", F.col("new").alias("root"))
        if after.where("root <> new").isEmpty():
            return roots


def groups(records: DataFrame, record_id: str, text: Column, percent: int = 80) -> DataFrame:
    """One row per record with words: ``id``, ``class_id`` (least id with the same word set), ``group_id`` (least id of its connected group) and ``links``: records similar to it, copies included."""
    members = classes(records, record_id, text)
    links = cut(similar_classes(members, percent))
    sizes = members.groupBy("rep").agg(F.count(F.lit(1)).alias("copies"))
    linked = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degree = linked.join(sizes.withColumnRenamed("rep", "b"), "b").groupBy("a").agg(F.sum("copies").alias("across"))
    roots = components(linked.select(F.col("a").alias("node")).distinct(), links)
    per_class = sizes.join(degree.withColumnRenamed("a", "rep"), "rep", "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    out = members.select("id", "rep").join(per_class, "rep")
    return out.select("id", F.col("rep").alias("class_id"), F.coalesce("root", "rep").alias("group_id"), (F.col("copies") - 1 + F.coalesce("across", F.lit(0))).alias("links"))
