"""Deliveries, rolling totals and schema drift: edge cases by hand, and brute force over whole tables."""

import json
from collections import defaultdict

from pyspark.sql import functions as F

from concordia.operators.deliveries import keep_one_copy, numeric_identity, repeated_copies
from concordia.operators.drift import field_changes, file_fields, ingest, leaves, parse_object, promotions, replay, type_of
from concordia.operators.rolling import latest_daily_amounts, rolling_totals, undirected
from concordia.plans.pipeline_queries import p3_found, p3_table
from concordia.runtime import table

# deliveries


def _messages(spark, rows):
    return spark.createDataFrame(rows, "row_id long, raw string, at long, key string")


def test_identity(spark):
    raw = ["12", " 12", "0012", "12.0", "+12", "12.50", "12.5", "1.2e1", "", " ", None, "x1", "-0", "0", "120"]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in raw], "raw string").select(numeric_identity(F.col("raw"))).collect()]
    assert got == ["12"] * 5 + ["12.5", "12.5", "12", None, None, None, "text:x1", "0", "0", "120"]


def test_earliest_stays(spark):
    day = 86_400_000_000
    rows = [
        (1, "7", 50 * day, "k"), (2, "07", 3 * day, "k"), (3, "7.0", 3 * day, "k"), (4, "7", None, "k"),  # across buckets, a tie, no time
        (5, None, 1, "k"), (6, None, 1, "k"), (7, " ", 1, "k"), (8, "9", 1, "k"), (9, "11", None, "k"), (10, "11", None, "k"),
    ]
    df = _messages(spark, rows)
    found = repeated_copies(df, numeric_identity(F.col("raw")), F.col("at"), F.col("row_id"))
    assert sorted(r["order_id"] for r in found.collect()) == [1, 3, 4, 10]
    kept = keep_one_copy(df, numeric_identity(F.col("raw")), F.col("at"), "row_id")
    assert kept.columns == df.columns and kept.count() == 6
    assert repeated_copies(df.limit(0), F.col("raw"), F.col("at"), F.col("row_id")).count() == 0


def test_bloom_filter_loses_nothing(spark):
    """Even one crowded word per bucket only costs lookups, never a row."""
    df = spark.range(3000).select(F.col("id").alias("row_id"), (F.col("id") % 1000).cast("string").alias("raw"), (F.col("id") * 10**10).alias("at"))
    for bits in (1, 10):
        found = repeated_copies(df, F.col("raw"), F.col("at"), F.col("row_id"), bits_per_id=bits, probes=1)
        assert sorted(r["order_id"] for r in found.collect()) == list(range(1000, 3000))


# rolling totals


def test_totals_by_hand(spark):
    rows = [(1, "n", "B", "A", "2026-01-01", 1.25, 1), (2, "n", "A", "B", "2026-01-01", 2.0, 2), (3, "n", "A", "B", "2026-01-01", 3.0, 2), (4, "n", "A", "B", "2026-01-09", None, 1),
            (5, "n", "A", "B", "2026-01-09", float("nan"), 1), (6, "n", "A", "A", "2026-01-01", 9.0, 1), (7, "n", None, "B", "2026-01-01", 9.0, 1), (8, "n", "A", "B", "2026-03-01", 9.0, 1)]
    df = spark.createDataFrame(rows, "id long, net string, a string, b string, d string, w double, v long").withColumn("d", F.col("d").cast("date"))
    daily = latest_daily_amounts(undirected(df, "a", "b"), ["net", "a", "b"], "d", F.col("w"), ["v", "id"])
    out = rolling_totals(daily, ["net", "a", "b"], "2026-02-05", (7, 30)).orderBy("day").collect()
    assert len(out) == 36 and {r["a"] for r in out} == {"A"}
    assert [r["total_7"] for r in out] == [300] * 7 + [0] * 29
    assert [r["total_30"] for r in out] == [300] * 30 + [0] * 6
    assert [r["day_no"] for r in out] == list(range(1, 37))
    assert rolling_totals(daily.limit(0), ["net", "a", "b"], "2026-02-05").count() == 0


# schema drift


def test_types_and_malformed():
    assert [type_of(v) for v in (None, [], [None], "a", 1, 1.5, True, ["a"], [{}], [1])] == [None, None, None, "string", "number", "number", "boolean", "list of strings", "list of objects", "list of numbers"]
    assert [parse_object(x) for x in (None, "", "{", "[1]", '{"a": NaN}', '"x"')] == [None] * 6
    assert dict(leaves({"a": {"b": 1, "c": {}}, "d": [{"e": 1}]})) == {"a.b": 1, "d": [{"e": 1}]}


def _report(spark, files):
    rows = [("f", f"f/{n}", n, i, json.dumps(o) if isinstance(o, dict) else o) for n, lines in enumerate(files) for i, o in enumerate(lines)]
    df = spark.createDataFrame(rows, "feed string, file string, seq int, no int, payload string")
    out = field_changes(file_fields(ingest(df, "payload", {"a": "double"}), ["feed", "file", "seq"], "no"), "feed", "file", ["seq"])
    return sorted((r["file"], r["field_path"], r["change_kind"]) for r in out.collect())


def test_changes(spark):
    assert _report(spark, [[{"a": 1}], [{"b": 2}]]) == [("f/1", "b", "renamed")]
    assert _report(spark, [[{"a": 1}], [{"b": "x"}]]) == [("f/1", "a", "removed"), ("f/1", "b", "added")]
    assert _report(spark, [[{"a": 1, "k": 1}], [{"k": None}], [{"a": 1, "k": "s"}]]) == [("f/1", "a", "removed"), ("f/2", "a", "added"), ("f/2", "k", "retyped")]
    assert _report(spark, [[{"a": []}], [{"a": ["x"]}, "{bad", None, ""], [{"a": []}, {"a": []}]]) == []
    assert _report(spark, [[{"m": "x"}], [{"m": {"x": 1}}]]) == [("f/1", "m", "removed"), ("f/1", "m.x", "added")]
    assert _report(spark, [[{"A": 1}], [{"a": 1}]]) == [("f/1", "a", "renamed")]


def test_whole_table_against_loops(spark):
    sf = "/root/testdata/sf0.01"
    seen, order = defaultdict(lambda: defaultdict(list)), defaultdict(set)
    for r in table(spark, sf, "raw_lines").orderBy("line_no").collect():
        if (o := parse_object(r["payload"])) is not None:
            order[r["feed"]].add((r["file_date"], r["file_seq"], r["file_name"]))
            for path, v in leaves(o):
                seen[r["file_name"]][path].append(type_of(v))
    want = set()
    for files in order.values():
        known, before = {}, None
        for *_, name in sorted(files):
            now = {p: ([t for t in ts if t] or [known.get(p)])[-1] for p, ts in seen[name].items()}
            if before is not None:
                plus, minus = now.keys() - before.keys(), before.keys() - now.keys()
                if len(plus) == len(minus) == 1 and now[[*plus][0]] == before[[*minus][0]]:
                    want.add((name, [*plus][0], "renamed"))
                else:
                    want |= {(name, p, "added") for p in plus} | {(name, p, "removed") for p in minus}
                want |= {(name, p, "retyped") for p in now.keys() & before.keys() if now[p] != before[p]}
            known |= {p: t for p, t in now.items() if t}
            before = now
    assert {tuple(r) for r in p3_found(spark, sf).collect()} == want


def test_rescue_and_replay(spark):
    rows = [(1, '{"a": "x", "n": 3, "u": {"v": 1}}', "old"), (2, '{"a": 5, "n": "many"}', "old"), (3, "{broken", "old"), (4, None, "old"), (5, '{"b": "late"}', "old")]
    df = spark.createDataFrame(rows, "id int, payload string, a string")
    out = ingest(df, "payload", {"a": "string", "n": "double"})
    got = {r["id"]: (r["source_a"], r["a"], r["n"], r["_rescued"] and json.loads(r["_rescued"])) for r in out.collect()}
    assert got == {1: ("old", "x", 3.0, {"u.v": 1}), 2: ("old", None, None, {"a": 5, "n": "many"}), 3: ("old", None, None, {"_malformed": "{broken"}), 4: ("old", None, None, None), 5: ("old", None, None, {"b": "late"})}
    again = {r["id"]: (r["a"], r["uv"], r["_rescued"] and json.loads(r["_rescued"])) for r in replay(out, {"b": ("a", "string"), "u.v": ("uv", "bigint")}).collect()}
    assert again == {1: ("x", 1, None), 2: (None, None, {"a": 5, "n": "many"}), 3: (None, None, {"_malformed": "{broken"}), 4: (None, None, None), 5: ("late", None, None)}


def test_promotions_follow_names_and_replay_keeps_values(spark):
    target = {"n": "double", "g.x": "array<string>", "t": "string", "b": "boolean"}
    change = lambda p, kind, old=None, new=None: ("f", "f/1", p, kind, None, new, old)
    rows = [change("g.y", "renamed", "g.x", "string"), change("z", "renamed", "g.y", "list of objects"), change("T", "added", None, "string"), change("k", "added", None, "number"), change("k", "retyped", None, "string"), change("gone", "removed")]
    report = spark.createDataFrame(rows, "feed string, file_name string, field_path string, change_kind string, old_type string, new_type string, old_path string")
    approved = promotions(report, target)
    assert approved == {"n": ("n", "double"), "g.x": ("g_x", "array<string>"), "t": ("t", "string"), "b": ("b", "boolean"), "g.y": ("g_x", "array<string>"), "z": ("g_x", "array<string>"), "T": ("t", "string"), "k": ("k", "double")}
    assert promotions(report.limit(0), {}) == {} and replay(report, {}) is report
    lines = ['{"n": "7.5", "g": {"y": "A; B"}, "T": 4, "b": "yes"}', '{"z": [{"c": 1}], "k": "x", "b": 3, "t": ["q"]}', '{"g": {"x": ["A"], "y": ["B"]}, "k": 2, "T": null}']
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "id int, payload string")
    got = {r["id"]: (r["n"], r["g_x"], r["t"], r["b"], r["k"], r["_rescued"] and json.loads(r["_rescued"])) for r in replay(ingest(df, "payload", target), approved).collect()}
    assert got == {0: (7.5, ["A", "B"], "4", True, None, None), 1: (None, ['{"c":1}'], '["q"]', None, None, {"k": "x", "b": 3}), 2: (None, ["A"], None, None, 2.0, {"g.y": ["B"]})}


def test_table_leaves_little_rescued(spark):
    rows = p3_table(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == table(spark, "/root/testdata/sf0.01", "raw_lines").count()
    left = [r for r in rows if r["_rescued"] and not r["_rescued"].startswith('{"_malformed"')]
    assert len(left) < 0.05 * len(rows)
    given = {r["line_id"]: parse_object(r["payload"]) for r in table(spark, "/root/testdata/sf0.01", "raw_lines").collect()}
    for r in rows:
        o = given[r["line_id"]] or {}
        if "num_mentions" in o:
            assert r["num_mentions"] == (None if o["num_mentions"] is None else float(o["num_mentions"]))
        external = (o.get("country_groups") or {}).get("external")
        if isinstance(external, list) and all(isinstance(x, str) for x in external):
            assert r["country_groups_external"] == external
