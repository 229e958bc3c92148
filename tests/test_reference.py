"""Event, network, vote and report operators on small fixtures worked by hand."""

import io
import zipfile

from pyspark.sql import functions as F

from concordia.config import TOPICS, Thresholds
from concordia.functions import scalars as S
from concordia.functions import text as X
from concordia import texts
from concordia.operators import artifacts, detect, events, networks, relationship, reports, timeseries, votes
from concordia.sources import pages, readers, writers

NOW = "2026-03-31T00:00:00Z"


def one(spark, c, value=None, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(c).first()[0]


def test_text_functions(spark):
    v = F.col("v")
    assert one(spark, X.basic_clean(v), "a&amp;lt;b\r\n “c” – d ") == "a&lt;b \"c\" - d"
    assert one(spark, detect.from_parts(v), "A&amp;lt;B") == "a<b"
    assert one(spark, X.normalize_text(v), "See https://x.y/z and me@site.org NOW") == "see and now"
    assert one(spark, X.strip_accents(v), "Ťažké") == "Tazke"
    assert one(spark, X.person_name(v), "O'Brién-Szabó, Á.") == "o brien szabo a"
    assert one(spark, X.vote_label(v), "Voted AGAINST it") == "against"
    assert one(spark, X.vote_title(v, F.lit(" "), F.lit("d"), F.lit("p"), F.lit(5)), None) == "d"
    assert one(spark, X.vote_title(v, v, v, v, F.lit(5)), None) == "EP vote 5"


def test_detectors(spark):
    v = F.col("v")
    # an alias that ends in a period needs a word character after it
    assert one(spark, detect.detect_countries(v), "the u.s. army met  the czech republic in hollandia") == ["CZ"]
    assert one(spark, detect.detect_countries(v), "the u.s.a met") == ["US"]
    assert one(spark, detect.detect_topics(v), "boiling gasoline tariffs") == ["energy", "trade"]
    assert one(spark, detect.primary_topic(detect.score_topics(v)), "tariff on gas") == "energy"
    assert one(spark, detect.primary_topic(detect.score_topics(v)), "nothing") is None
    assert one(spark, detect.vote_topic(v), "Budget for asylum") == "migration"
    assert one(spark, detect.vote_topic(v), None) == "trade"


def test_scalars(spark):
    m = "map<string,string>"
    w = S.event_weight(F.col("v"))
    assert [float(one(spark, w, x, m)) for x in ({"NumMentions": "0", "NumArticles": "0"}, {"NumMentions": "abc", "NumArticles": ""}, None, {"NumMentions": "10", "NumArticles": "2", "GoldsteinScale": "-4.5"})] == [1.0, 1.0, 1.0, 5.95]
    assert one(spark, S.country_pairs(F.col("v")), ["A", "B", "C"], "array<string>") == [["A", "B"], ["A", "C"], ["B", "C"]]
    assert one(spark, S.country_pairs(F.col("v")), ["A"], "array<string>") == []
    assert one(spark, S.coded_country(F.col("v")), " ger ") == "DE" and one(spark, S.coded_country(F.col("v")), "XX") is None
    assert one(spark, S.coded_topics(F.col("v"), F.lit("1121")), "19") == ["defence", "fiscal", "trade", "ukraine_russia"]
    assert [one(spark, S.band(F.lit(x))) for x in (80, 60, 40, 20, 19.99)] == ["very_high", "high", "medium", "low", "very_low"]
    stamp = lambda x: str(one(spark, S.iso_or_mail_timestamp(F.col("v")), x))
    assert stamp("Thu, 12 Mar 2026 15:18:52 GMT") == "2026-03-12 15:18:52" and stamp("2026-03-12T01:00:00+02:00") == "2026-03-11 23:00:00" and stamp("soon") == "None"


def _events(spark):
    rows = [
        (1, "2026-03-30", ["DE", "FR"], ["energy"], [["FR", "DE"], ["DE", "FR"], ["DE", "DE"], ["DE"]], "2"),
        (2, "2026-03-01", ["DE", "US"], ["energy", "trade"], [["DE", "US"]], "3"),
        (3, "2026-01-15", ["FR", "US", "CN"], ["trade", "odd"], [["CN", "US"], ["FR", "US"]], "1"),
        (4, None, ["DE"], None, None, "5"),
    ]
    df = spark.createDataFrame(rows, "id int, d string, countries array<string>, topics array<string>, country_pairs array<array<string>>, w string")
    return df.select("*", S.event_timestamp(NOW, F.col("d")).alias("ts"), F.col("w").cast(S.DEC).alias("weight"))


def test_graph_and_heatmap(spark):
    e = _events(spark)
    edges = {(r["window_days"], r["mode"], r["source"], r["target"]): r["weight"] for r in networks.graph_edges(e, NOW).collect()}
    assert edges[7, "all", "DE", "FR"] == 4.0 and edges[30, "external", "DE", "US"] == 3.0 and (7, "all", "DE", "US") not in edges and not any(k[2:] == ("CN", "US") for k in edges)
    nodes = {(r["window_days"], r["mode"], r["country"]): r["weight"] for r in networks.graph_nodes(e, NOW).collect()}
    assert nodes[90, "all", "DE"] == 7.0 and nodes[90, "internal", "DE"] == 4.0
    assert {r["window_days"]: r["event_count"] for r in networks.event_counts(e, NOW).collect()} == {7: 2, 30: 3, 90: 4}
    heat = {(r["window_days"], r["mode"], r["country"]): r for r in networks.heatmap(e, NOW).collect()}
    assert heat[30, "all", "DE"]["energy"] == 5.0 and heat[30, "all", "DE"]["total"] == 8.0 and (90, "external", "CN") not in heat and heat[90, "all", "CN"]["trade"] == 1.0
    norm = {(r["window_days"], r["mode"], r["country"]): r for r in networks.normalize_rows(networks.heatmap(e, NOW)).collect()}
    assert norm[30, "all", "DE"]["energy"] == 0.625
    sim = {(r["source"], r["target"]): r["weight"] for r in networks.similarity_edges(networks.normalize_rows(networks.heatmap(e, NOW))).where("window_days = 90 AND mode = 'all'").collect()}
    assert sim["CN", "US"] == round(4 / 25**0.5, 3) and networks.graph_edges(e.limit(0), NOW).count() == 0
    assert {r["period"] for r in events.with_period(e, "ts", NOW, 30).collect()} == {"current"} and events.with_period(e, "ts", NOW, 40).count() == 4


def test_country_and_policy_networks(spark):
    e = _events(spark)
    assert [(r["source"], r["target"], r["weight"], r["topics"]) for r in networks.country_edges(e).collect()] == [("DE", "FR", 2, {"energy": 2})]
    assert {r["country"]: r["weight"] for r in networks.country_nodes(e).collect()} == {"DE": 3, "FR": 2}
    assert [tuple(r) for r in networks.policy_edges(e).collect()] == [("DE", "FR", 2)]
    assert {r["country"]: r["weight"] for r in networks.policy_nodes(e).collect()} == {"DE": 3, "FR": 3}
    assert networks.snapshot(e).first()["event_count"] == 4


def test_dedup(spark):
    rows = [(1, "u", "A"), (2, "u", "B"), (3, "", " a "), (4, None, ""), (5, "v", None), (6, "w", "C")]
    df = spark.createDataFrame(rows, "ingest_seq long, url string, title string")
    assert sorted(r[0] for r in events.dedup_by_url(df).collect()) == [1, 3, 4, 5, 6]
    assert sorted(r[0] for r in events.dedup_events(df).collect()) == [1, 4, 6]


def test_votes(spark):
    rows = [("v1", "energy", c, p) for c, p in (("DE", "for"), ("FR", "for"), ("IT", "abstain"), ("PL", "against"), ("HU", "against"))]
    rows += [("v2", "migration", c, p) for c, p in (("DE", "for"), ("FR", "for"), ("IT", "for"), ("PL", "against"), ("HU", "against"))]
    rows += [("v3", "trade", c, "for") for c in ("DE", "FR")]
    v = spark.createDataFrame(rows, "vote_id string, topic string, country string, position string")
    got = {r["vote_id"]: (float(r["conflict"]), r["divisive"]) for r in votes.conflicts(v).collect()}
    assert got == {"v1": (0.6, True), "v2": (0.4, True), "v3": (0.0, False)}
    loose = Thresholds(min_edge_count=1)
    edges = votes.graph_edges(v, limits=loose)
    assert {(r["source"], r["target"]): (r["weight"], r["count"]) for r in edges.collect()} == {("DE", "FR"): (1.0, 2), ("HU", "PL"): (1.0, 2)}
    assert votes.graph_edges(v).count() == 0
    assert {r["country"]: r["weight"] for r in votes.graph_nodes(v, edges, limits=loose).collect()}["DE"] == 1.0
    heat = {r["country"]: (r["energy"], r["migration"], r["total"]) for r in votes.heatmap(v).collect()}
    assert heat["IT"] == (0.15, 0.4, 0.55) and heat["HU"] == (-0.6, -0.4, 1.0)
    total = votes.summary(v).where("level = 'all'").first()
    assert (total["for_weight"], total["against_weight"], total["abstain_weight"], total["total"]) == (2.4, 2.0, 0.6, 5.0)


def test_fold_ties_are_alphabetical(spark):
    m = spark.createDataFrame([(1, "DE", "A", "for"), (1, "DE", "A", "against"), (1, "DE", "", "for"), (1, "DE", "", "against"), (1, "US", "A", "for"), (1, "FR", "A", "none")], "vote_id int, country string, grp string, position string")
    folded = votes.fold(m)
    assert [tuple(r) for r in votes.country_positions(folded).collect()] == [(1, "DE", "against")]
    assert {(r["level"], r["key"]): r["n_for"] for r in folded.collect()} == {("country", "DE"): 2, ("group", "A"): 1, ("vote", None): 2}


def test_relationship(spark):
    e = _events(spark)
    norm = networks.normalize_rows(networks.heatmap(e, NOW))
    parts = (networks.graph_edges(e, NOW), networks.similarity_edges(norm), norm)
    pairs = relationship.index_pairs(*parts)
    r = {(x["window_days"], x["mode"], x["source"], x["target"]): x for x in pairs.collect()}
    assert r[7, "all", "DE", "FR"]["score"] == 100.0 and r[7, "all", "DE", "FR"]["band"] == "very_high" and not any(k[2:] == ("CN", "US") for k in r)
    ch = relationship.pair_changes(pairs.where("window_days = 7").withColumn("window_days", F.lit(0)), pairs.where("window_days = 30").withColumn("window_days", F.lit(0)))
    status = {(x["mode"], x["source"], x["target"]): x["status"] for x in ch.collect()}
    assert status["all", "DE", "US"] == "lost" and status["all", "DE", "FR"] in ("improved", "stable")
    by = relationship.by_country(pairs, relationship.universe(*parts)).where("window_days = 7 AND mode = 'all' AND country = 'DE'").first()
    assert by["relationship_count"] == 1 and by["strongest_partner"] == "FR"
    assert relationship.index_pairs(*(p.limit(0) for p in parts)).count() == 0


def test_series(spark):
    rows = [("k", f"2026-01-0{i}", float(i)) for i in range(1, 6)] + [("one", "2026-01-01", 3.0)]
    s = spark.createDataFrame(rows, "k string, d string, v double").withColumn("d", F.col("d").cast("date"))
    m = timeseries.with_metrics(s, ["k"], "d", "v").where("k = 'k'").orderBy("d").collect()
    assert [x["value_ma"] for x in m] == [1.0, 1.5, 2.0, 2.5, 3.0] and [x["trend_slope"] for x in m] == [0.0, 1.0, 1.0, 1.0, 1.0]
    f = {(x["k"], str(x["day"])): x["forecast"] for x in timeseries.forecast(s, ["k"], "d", "v").collect()}
    assert f["k", "2026-01-06"] == 6.0 and f["one", "2026-01-04"] == 3.0 and timeseries.forecast(s.limit(0), ["k"], "d", "v").count() == 0


def test_readers_and_writers(spark, tmp_path):
    row = [str(i) for i in range(61)]
    for name, rows in (("20260310120000.zip", [row]), ("bad.zip", [row, row[:5]])):
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w") as z:
            z.writestr("x.csv", "\n".join("\t".join(r) for r in rows))
        (tmp_path / name).write_bytes(buffer.getvalue())
    got = readers.read_exports(spark, str(tmp_path / "*.zip")).collect()
    assert len(got) == 1 and got[0]["EventCode"] == "26" and got[0]["SOURCEURL"] == "58"
    (tmp_path / "manifest.txt").write_text("1 a http://x/20260310120000.export.CSV.zip\nshort\n1 b http://x/20260310130000.export.CSV.zip\n1 c http://x/y.zip\n1 d http://x/20260201130000.export.CSV.zip\n")
    urls = readers.manifest_urls(spark, str(tmp_path / "manifest.txt"))
    assert urls.count() == 3 and [r["url"] for r in readers.history_urls(urls, "2026-03-11", 14, 1).collect()] == ["http://x/20260310130000.export.CSV.zip"]
    (tmp_path / "feed.xml").write_text("<rss><channel><item><title>T</title><link>l</link><description>d</description><pubDate>p</pubDate></item></channel></rss>")
    feed = readers.read_all_feeds(spark, [{"name": "s", "path": str(tmp_path / "feed.xml")}, {"name": "off", "path": "x", "enabled": False}], "2026-03-10T00:00:00+00:00")
    assert [(r["source_name"], r["title"]) for r in feed.collect()] == [("s", "T")]
    e = events.build_text_events(spark.createDataFrame([("s", "rss", "Tariffs", "France and &amp; Germany", "", "u", "Thu, 12 Mar 2026 15:18:52 GMT", "2026-03-13T00:00:00+00:00")], feed.schema))
    assert (e.first()["countries"], e.first()["topics"], e.first()["country_pairs"]) == (["DE", "FR"], ["trade"], [["DE", "FR"]])
    assert writers.append_events(e, str(tmp_path / "store"), "2026-01-01") == {"2026-03-12": 1}
    assert readers.read_events(spark, str(tmp_path / "store")).count() == 1
    linked = spark.createDataFrame([("<a href='/a.xml'>x</a><a href=\"b.xml\">y</a><a href='b.xml'>z</a><a href='c.html'>",)], "html string")
    assert sorted(r[0] for r in readers.xml_links(linked, "https://h.org/p").collect()) == ["https://h.org/a.xml", "https://h.org/p/b.xml"]
    xml = spark.createDataFrame([("<r><For><m>Ana Kovács</m></For><Against><m name='Ana  Kovacs'/><m>X</m></Against></r>",), ("<broken",), (None,)], "xml string")
    names = pages.name_candidates(xml)
    assert ("Ana Kovacs", "against") in {(" ".join(r["name"].split()), r["vote"]) for r in names.collect()}
    members = spark.createDataFrame([("ANA KOVÁCS", "HU", "EPP")], "full_name string, country_code string, group_short string")
    assert "HU" in {r["country_code"] for r in pages.match_members(names, members).collect()}


def test_position_words(spark):
    words = ["Adopted", "Rejected", "Approved", "igen", "elutasítva", "An excellent text", "tartózkodott", "Abstentions against", "", None, "mellette", "Favor"]
    got = [r[0] for r in spark.createDataFrame([(w,) for w in words], "v string").select(X.vote_label(F.col("v"))).collect()]
    assert got == ["for", "against", "for", "for", "against", None, "abstain", "abstain", None, None, "for", "for"]


def test_roll_call(spark):
    doc = "<x:doc xmlns:x='u'><vote><p name='Bo Ek'>for</p><abstention>abstain</abstention><p persname='Cid Dun'/><p persname='Cid Dun'/><p>One</p></vote><vote><p>Bo Ek against</p></vote></x:doc>"
    got = list(pages.vote_candidates(doc))
    assert (1, "Bo Ek", "bo ek", "for", "p") in got and got.count((1, "Cid Dun", "cid dun", "abstain", "p")) == 2 and (2, "Bo Ek against", "bo ek against", "against", "p") in got
    rows = [tuple(r) for r in pages.name_candidates(spark.createDataFrame([(doc,)], "xml string")).collect()]
    assert len(rows) == len({r[2:4] for r in rows}) and pages.name_candidates(spark.createDataFrame([(doc,)], "xml string"), most=1).count() == 1


COUNTRIES, GROUPS = {"Niger": "NE", "Nigeria": "NG", "Hungary": "HU"}, {"Group A": "A", "Group A/B": "AB"}


def test_member_pages(spark):
    card = "<div><p>x</p><div><a href='/meps/en/1'>Ana <b>Kov</b></a><br>Group A/B Hungary Party P</div><li><a href='/other'>No</a> Group A Hungary</li>"
    html = f"<body>{card}{card}</div></div>"
    got = pages.member_records(html, "https://h.org/list", COUNTRIES, GROUPS, least=1)
    assert [(r["full_name"], r["country"], r["group"], r["source_url"]) for r in got] == [("Ana Kov", "HU", "A", "https://h.org/meps/en/1")]
    lines = "<p>Zed Ohm Group A/B Nigeria Party Q</p><p>One Group A Hungary</p><p>Members of it Group A Hungary</p><p>Abe Low Group A Hungary</p><p>Abe Low Group A Hungary</p>"
    got = pages.member_records(lines, "https://h.org", COUNTRIES, GROUPS)
    assert [(r["full_name"], r["country"], r["group"], r["national_party"]) for r in got] == [("Abe Low", "HU", "A", ""), ("Zed Ohm", "NG", "AB", "Party Q")]
    df = spark.createDataFrame([(lines,), (None,), ("",)], "html string")
    assert pages.members_from_html(df, "https://h.org", COUNTRIES, GROUPS).count() == 2


def test_reading_what_is_not_there(spark, tmp_path):
    assert readers.read_events(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "array.json").write_text('[{"id": "a", "countries": {"DE": "for"}}, {"id": "b"}]')
    (tmp_path / "object.json").write_text('{"id": "a"}')
    (tmp_path / "bad.json").write_text('[{"id": ')
    count = lambda name: readers.read_json_array(spark, str(tmp_path / name), readers.VOTE_RECORD).where("id IS NOT NULL").count()
    assert [count(n) for n in ("array.json", "object.json", "bad.json", "none.json")] == [2, 0, 0, 0]
    root = tmp_path / "events"
    for place, name in (("rss", "2026-03-12.jsonl"), ("", "2026-03-10.jsonl"), ("gdelt", "2026-03-12.jsonl")):
        (root / place).mkdir(parents=True, exist_ok=True)
        (root / place / name).write_text('{"layer":"%s","title":"t"}\nbroken\n' % (place or "old"))
    (root / "votes").mkdir()
    (root / "votes" / "council_votes.json").write_text('[{"id": "v"}]')
    layers = {n: sorted(r[0] for r in readers.read_layer(spark, str(root), n).select("id" if n == "votes" else "layer").where("layer IS NOT NULL" if n != "votes" else "true").collect()) for n in ("rss", "gdelt", "combined", "votes")}
    assert layers == {"rss": ["old", "rss"], "gdelt": ["gdelt"], "combined": ["gdelt", "old", "rss"], "votes": ["v"]}
    (root / "store" / "event_date=2026-03-12").mkdir(parents=True)
    (root / "store" / "event_date=2026-03-12" / "a.json").write_text('{"layer":"rss"}')
    assert readers.read_events(spark, str(root / "store"), day="2026-03-12").count() == 1 and readers.read_events(spark, str(root / "store"), day="2026-03-13").count() == 0


def test_writers(spark, tmp_path):
    record = lambda i, d, t: (i, d, t, "trade", {"DE": "for"})
    schema = "id string, date string, title string, topic string, countries map<string,string>"
    old = spark.createDataFrame([record("a", "2026-01-01", "old"), record("b", "2026-01-02", "old")], schema)
    writers.merge_records(spark, old, str(tmp_path / "none"), "id", str(tmp_path / "one"))
    writers.merge_records(spark, spark.createDataFrame([record("b", "2026-01-02", "new"), record("b", "2026-01-03", "newer")], schema), str(tmp_path / "one"), "id", str(tmp_path / "two"))
    assert sorted((r["id"], r["title"]) for r in spark.read.json(str(tmp_path / "two")).collect()) in ([("a", "old"), ("b", "new")], [("a", "old"), ("b", "newer")])
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "x.json").write_text("{broken\n")
    try:
        writers.merge_records(spark, old, str(tmp_path / "broken"), "id", str(tmp_path / "three"))
        raise AssertionError("unreadable records must not count as none")
    except Exception as e:
        assert not isinstance(e, AssertionError)
    writers.save_run(old, str(tmp_path / "run"))
    run = spark.read.json(str(tmp_path / "run" / "votes_summary")).first()
    assert (run["new_records"], run["min_date"], run["max_date"], run["average_countries_per_record"], run["topic_counts"]["trade"]) == (2, "2026-01-01", "2026-01-02", 1.0, 2)
    assert [r["id"] for r in writers.latest(old, 1).collect()] == ["b"] and spark.read.json(str(tmp_path / "run" / "votes_latest_100")).count() == 2
    docs = spark.createDataFrame([(7, "all", 3), (30, "internal", 4)], "window_days int, mode string, event_count int")
    assert writers.save_documents(docs, [str(tmp_path / "d1"), str(tmp_path / "d2")], "heatmap") == ["7d_heatmap.json", "30d_heatmap_internal.json"]
    assert (tmp_path / "d2" / "7d_heatmap.json").read_text() == '{"event_count":3,"mode":"all"}'
    e = _events(spark)
    writers.save_snapshot(e, str(tmp_path / "snap.json"))
    assert '"event_count":1' in (tmp_path / "snap.json").read_text()
    writers.append_day(e.select("id"), str(tmp_path / "days"), "2026-01-01")
    dated = e.select("id", F.lit("2026-01-02").alias("event_date"))
    writers.overwrite_days(dated, str(tmp_path / "p"), "id", per_day=2)
    writers.overwrite_days(dated.where("id = 1").withColumn("event_date", F.lit("2026-01-03")), str(tmp_path / "p"), "id")
    assert sorted((str(r["event_date"]), r["id"]) for r in spark.read.parquet(str(tmp_path / "p")).collect()) == [("2026-01-02", 1), ("2026-01-02", 2), ("2026-01-03", 1)]
    bad = spark.createDataFrame([("A", "HU", "EPP"), ("", "HU", "EPP"), ("B", "", "EPP"), ("C", "HU", None)], "full_name string, country_code string, group_short string")
    assert sorted(r["reason"] for r in writers.invalid_members(bad).collect()) == ["no country", "no group", "no name"]


def test_upsert_keeps_one_row_a_key(spark):
    old = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], "k int, v string, at int")
    new = spark.createDataFrame([(1, "x", 5), (1, "y", 4), (3, None, None)], "k int, v string, at int")
    assert sorted((r["k"], r["v"]) for r in events.upsert(old, new, ["k"], ["at"]).collect()) == [(1, "x"), (2, "c"), (3, None)]
    assert sorted((r["k"], r["v"]) for r in events.upsert(old, new.limit(0), ["k"], ["at"]).collect()) == [(1, "b"), (2, "c")]
    assert events.upsert(old.select("k"), new.select("k"), ["k"]).count() == 3


def test_first_rows_with_null_order(spark):
    df = spark.createDataFrame([(None, "u", "A"), (2, "u", "B"), (3, "v", "C"), (None, "", "D")], "ingest_seq long, url string, title string")
    assert sorted(r["title"] for r in events.dedup_by_url(df).collect()) == ["A", "C", "D"]


def test_times_do_not_depend_on_the_session(spark):
    given = ["2026-03-12", "2026-03-12 01:30:00", "2026-03-12T23:30:00-02:00", "Thu, 12 Mar 2026 23:30:00 -0200", "20260312001000", None]
    df = spark.createDataFrame([(x,) for x in given], "v string")
    v = F.col("v")
    ask = lambda: [tuple(r) for r in df.select(F.unix_seconds(S.iso_or_mail_timestamp(v)), S.storage_date(v, v), F.unix_seconds(S.export_timestamp(v))).collect()]
    here = ask()
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert ask() == here
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert str(here[0][1]) == "2026-03-12" and str(here[2][1]) == "2026-03-13" and here[4][2] == 1773274200


def test_build_with_own_dictionaries(spark):
    items = spark.createDataFrame([("s", "RSS", "The Council of Oz", "on &amp;amp; grids", "", "u", None, None)], "source_name string, source_type string, title string, summary string, body string, url string, published_at string, collected_at string")
    e = events.build_text_events(items, " RSS ", {"OZ": ["council of oz"], "AT": ["oz"]}, {"power": ["grid"]}).first()
    assert (e["layer"], e["countries"], e["topics"], e["primary_topic"], e["country_groups"]["external"]) == ("rss", ["AT", "OZ"], ["power"], "power", ["OZ"])
    try:
        events.build_text_events(items, "blog").collect()
        raise AssertionError("an unknown layer must not pass")
    except Exception as error:
        assert "unknown layer" in str(error)


def test_codes_used_nowhere_else(spark):
    v = F.col("v")
    assert [one(spark, S.vote_country(v), x) for x in ("hun", "HU", "GBR", "US", None)] == ["HU", "HU", "", "", ""]
    assert [one(spark, S.vote_group(v), x) for x in ("verts/ale", "new", None)] == ["Greens/EFA", "NEW", ""]
    assert [one(spark, S.vote_position(v), x) for x in ("in favour", "ABSTENTION", "DID_NOT_VOTE", None)] == ["for", "abstain", "", ""]
    assert [one(spark, S.relation_label(F.lit(x))) for x in (70, 40, 39.9)] == ["erős", "közepes", "gyenge"] and [one(spark, S.trend_label(F.lit(x))) for x in (5.1, 5, -5.1)] == ["javuló", "stabil", "romló"]


def test_vote_windows_and_change(spark):
    rows = [(f"v{i}", "energy", c, p, d) for i, d in enumerate(["2026-03-30", "2026-03-29", "2026-03-28", "2026-03-05", "2026-02-10"]) for c, p in (("DE", "for"), ("FR", "for"), ("HU", "against"), ("US", "for"))]
    v = spark.createDataFrame(rows, "vote_id string, topic string, country string, position string, date string")
    w = votes.windowed(v, NOW)
    assert {r["window_days"]: r["event_count"] for r in votes.vote_counts(w, ["window_days"]).collect()} == {7: 3, 30: 4, 90: 5}
    loose = Thresholds(min_edge_count=3)
    edges = votes.graph_edges(w, ["window_days"], loose)
    assert {(r["window_days"], r["source"], r["target"], r["count"]) for r in edges.collect()} == {(7, "DE", "FR", 3), (30, "DE", "FR", 4), (90, "DE", "FR", 5)}
    assert {r["mode"] for r in votes.by_mode(edges).collect()} == {"all", "internal"}
    summary = votes.summary(w, ["window_days"])
    assert {r["window_days"]: r["votes"] for r in summary.where("level = 'all'").collect()} == {7: 3, 30: 4, 90: 5}
    doc = artifacts.summary_documents(summary, ["window_days"]).where("window_days = 7").first()
    assert [x["country"] for x in doc["by_country"]] == ["DE", "FR", "HU"] and doc["event_count"] == 3 and doc["totals"]["for"] == 1.5
    heat = votes.heatmap(w, ["window_days"])
    of = lambda d, n: d.where(F.col("window_days") == n)
    got = {r["country"]: r for r in votes.changes((of(edges, 7), of(heat, 7)), (of(edges.limit(0), 7), of(heat, 30))).collect()}
    assert got["DE"]["gained"] == ["FR"] and got["DE"]["ordinal"] == 1 and got["HU"]["ordinal"] == 3 and len(got["HU"]["all_topic_changes"]) == 8 and got["HU"]["top_topic_changes"][0]["delta"] == 0.25


def _report_items(spark):
    changes = spark.createDataFrame([("all", "DE", "HU", 45.0, 40.0, 5.0, "improved", 2), ("all", "FR", "HU", 10.0, 30.5, -20.5, "declined", 1), ("all", "DE", "PL", 8.0, 0.0, 4.5, "gained", 3)],
                                    "mode string, source string, target string, current_score double, previous_score double, delta double, status string, ordinal int")
    countries = spark.createDataFrame([("all", "HU", 27.5, 35.25, -7.75, 0), ("all", "DE", 26.5, 20.0, 6.5, 1), ("all", "PL", 8.0, 8.0, 0.0, -1)],
                                      "mode string, country string, average_current double, average_previous double, average_delta double, count_delta int")
    return changes, countries


def test_report_texts(spark):
    changes, countries = _report_items(spark)
    topics = spark.createDataFrame([("DE", "energy", 1.0, 0.5, 0.5), ("HU", "energy", 0.0, 0.25, -0.25), ("HU", "trade", 0.0, 0.0, 0.0)], "country string, topic string, current double, previous double, delta double")
    r = reports.report("votes", "30d", changes, countries, topics).first()
    assert r["method_note"] == texts.METHOD_VOTES and r["layer_label"] == "Votes" and r["mode_label"] == "teljes nézet"
    assert [x["country"] for x in r["country_items"]] == ["HU", "DE", "PL"] and [(x["source"], x["target"]) for x in r["pair_items"]] == [("FR", "HU"), ("DE", "HU"), ("DE", "PL")]
    assert [x["line"] for x in r["country_lines"]][0] == "HU országkapcsolati profilja gyengült: az átlagos kapcsolatindex 35.25-ről 27.50-re módosult (-7.75), miközben a hálózat változatlan kapcsolatszámmal járt együtt."
    assert [x["line"] for x in r["pair_lines"]][1] == "DE és HU viszonyában erősödő elmozdulás látszik: a kapcsolatindex 40.00-ről 45.00-re változott (+5.00)."
    assert [x["line"] for x in r["topic_lines"]][0].endswith("a leginkább érintett országok: DE (+0.500), HU (-0.250).") and [x["topic"] for x in r["topic_items"]] == ["energy", "trade"]
    assert len(r["gained_pairs"]) == 1 and r["lost_pairs"] is None
    lead = r["executive_summary"]
    assert lead.startswith("A Votes alapú, 30d időablakra és teljes nézet nézetre") and "-7.75" in lead and "FR és HU" in lead and "energia" in lead
    nothing = reports.executive_summary("rss", "7d", spark.createDataFrame([("all",)], "mode string"), reports.country_moves(countries.limit(0), ["mode"]), reports.pair_moves(changes.limit(0), ["mode"])).first()
    assert nothing["executive_summary"].endswith(texts.LEAD_STABLE) and reports.method_note("rss") == texts.METHOD_EVENTS
    assert reports.report("rss", "7d", changes.limit(0), countries.limit(0)).count() == 0


def test_insight_focus_and_history(spark):
    changes, countries = _report_items(spark)
    c, p = reports.country_moves(countries, ["mode"]), reports.pair_moves(changes, ["mode"])
    topics = spark.createDataFrame([(1, "energy", "energia", 3.5)], "place int, topic string, topic_label string, absolute_delta_total double")
    w = reports.weekly_insight(c, p, topics).first()
    assert w["top_country_move"] == "HU mutatta a legerősebb országos elmozdulást: romló irányú változás (-7.75), aktuális átlagos kapcsolati szint 27.50."
    assert w["top_gainer"] == "A legerősebb közeledés DE és HU között jelent meg, +5.00 változással." and w["top_loser"].startswith("A legnagyobb eltávolodás FR és HU") and "3.50" in w["top_topic"]
    none = reports.weekly_insight(c.limit(0), p.limit(0), topics.limit(0)).first()
    assert set(none) == {texts.NOTHING}

    partners = spark.createDataFrame([("PL", 30.0, 1.5, "improved"), ("SK", 10.0, -2.0, "declined")], "partner string, current double, delta double, status string")
    focused = reports.focus(partners, ["PL", "CZ", "SK"])
    outside = reports.outside_indicator(spark.createDataFrame([(42.0, 6.0)], "value double, delta double"), spark)
    assert tuple(outside.first()) == (True, 42.0, 6.0, "javuló", texts.OUTSIDE_NOTE)
    f = reports.country_focus("HU", c, focused, outside).first()
    assert f["focus_line"] == "A V4-en belüli együttmozgás: PL: 30.00 (+1.50), SK: 10.00 (-2.00)." and f["focus_average"] == 20.0 and f["focus_average_delta"] == -0.25
    assert f["regional_summary"] == "A V4-átlag 20.00; Ukrajna külön indikátora 42.00 (+6.00)." and "gyenge pozíciónak felel meg. A V4-átlag jelenleg 20.00. Az Ukrajnához" in f["quick_view"]
    alone = reports.country_focus("XX", c, reports.focus(partners.limit(0), ["PL"]), reports.outside_indicator(None, spark)).first()
    assert (alone["quick_view"], alone["focus_line"], alone["regional_summary"]) == (texts.QUICK_NOTHING, texts.FOCUS_NOTHING, texts.REGION_NOTHING + ".")
    lists = spark.createDataFrame([([("PL", 1.0, 0.0, 1.0, "improved")], [], [("PL", 2.0, 0.0, 2.0, "gained"), ("", 1.0, 0.0, 1.0, "x")], None, [])], "improved array<struct<partner:string,current_score:double,previous_score:double,delta:double,status:string>>, " + ", ".join(f"{x} array<struct<partner:string,current_score:double,previous_score:double,delta:double,status:string>>" for x in ("declined", "top_changes", "gained", "lost")))
    assert [tuple(r) for r in reports.partner_map(lists).collect()] == [("PL", 2.0, 2.0, "gained")]

    h = reports.history_entry("2026-04-15", "HU", c, p).first()
    assert (h["score"], h["delta"], h["trend_label"], h["main_partner"], h["dynamic_partner"]) == (27.5, -7.75, "romló", "DE", "FR")
    other = reports.history_entry("2026-04-15", "FR", c.where("country <> 'FR'"), p).first()
    assert (other["score"], other["delta"], other["main_partner"]) == (10.0, -20.5, "HU") and reports.history_entry("2026-04-15", "XX", c, p).first()["score"] == 0.0
    old = reports.normalized_history(spark.createDataFrame([("2026-04-14", "50", "6.1", None), ("2026-04-15", None, None, "kept"), (None, "1", "1", None)], "date string, score string, delta string, trend_label string"))
    assert sorted((str(r["date"]), r["score"], r["trend_label"]) for r in old.collect()) == [("2026-04-14", 50.0, "javuló"), ("2026-04-15", 0.0, "kept")]
    history = reports.updated_history(old, reports.history_entry("2026-04-15", "HU", c, p))
    assert sorted((str(r["date"]), r["score"]) for r in history.collect()) == [("2026-04-14", 50.0), ("2026-04-15", 27.5)]
    chart = reports.chart(history, "HU").first()
    assert [x["trend_line"] for x in chart["series"]] == [50.0, 27.5] and [x["forecast_score"] for x in chart["forecast_next"]] == [5.0, -17.5, -40.0] and chart["latest_summary"]["trend_slope_14d"] == -22.5


def test_documents_are_in_order(spark):
    e = _events(spark)
    counts = networks.event_counts(e, NOW).withColumn("mode", F.lit("all"))
    d = artifacts.graph_documents(networks.graph_nodes(e, NOW), networks.graph_edges(e, NOW), counts, ["window_days", "mode"]).where("window_days = 90").first()
    assert [n["id"] for n in d["nodes"]] == ["DE", "FR", "US"] and [(x["source"], x["target"]) for x in d["edges"]] == [("DE", "FR"), ("DE", "US"), ("FR", "US")] and d["event_count"] == 4
    h = artifacts.heatmap_documents(networks.heatmap(e, NOW), counts, ["window_days", "mode"]).where("window_days = 7").first()
    assert [x["country"] for x in h["rows"]] == ["DE", "FR"] and h["topics"] == TOPICS
    empty = artifacts.graph_documents(networks.graph_nodes(e.limit(0), NOW), networks.graph_edges(e.limit(0), NOW), counts, ["window_days", "mode"]).first()
    assert empty["nodes"] == [] and empty["edges"] == []
    assert [x["source"] for x in artifacts.policy_snapshot(e).first()["edges"]] == ["DE"]


def test_streams(spark, tmp_path):
    from concordia.streaming.events import once_per_id, stream_events

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"id":"7","ts":"2026-03-01T00:00:00Z"}\n{"id":"07","ts":"2026-03-01T01:00:00Z"}\n{"id":null,"ts":"2026-03-01T00:00:00Z"}\n{"id":null,"ts":"2026-03-01T00:00:00Z"}\n')
    q = once_per_id(stream_events(spark, str(tmp_path / "in"), "id string, ts timestamp"), "ts", "id").writeStream.format("memory").queryName("once").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("once").count() == 3


def test_topics_are_complete():
    assert len(TOPICS) == 8
