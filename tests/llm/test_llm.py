"""The language-model data operators against brute force, an independent encoder, held-out accuracy and cases by hand."""

import itertools
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from concordia.llm import bpe, langid, mixing, neardup, pairs, queries, sentences
from concordia.runtime import table

# pairs


def _brute_pairs(rows):
    out = {}
    for r in rows:
        for a, b in itertools.combinations(sorted({x for x in r or [] if x is not None}), 2):
            out[a, b] = out.get((a, b), 0) + 1
    return out


@pytest.mark.parametrize("heavy_share", [0.0, 0.05, 0.3, 2.0])
def test_pairs_whatever_is_heavy(spark, heavy_share):
    rnd = random.Random(5)
    rows = [[rnd.choice("abcdefghij") + rnd.choice(["", "", "x", "yz"]) for _ in range(rnd.randint(0, 9))] for _ in range(300)]
    rows += [None, [], ["a", "a", None], [None]]
    df = spark.createDataFrame([(r, 1) for r in rows], "items array<string>, n int")
    got = {(r["item_a"], r["item_b"]): r["n_ab"] for r in pairs.co_occurrence(df, F.col("items"), heavy_share=heavy_share).collect()}
    assert got == _brute_pairs(rows)
    top = pairs.co_occurrence(df, F.col("items"), min_count=3, min_share=0.02, heavy_share=heavy_share).collect()
    assert {(r["item_a"], r["item_b"]): r["n_ab"] for r in top} == {k: n for k, n in got.items() if n >= max(3, 0.02 * len(rows))}
    assert all(r["n_rows"] == len(rows) for r in top)


def test_pairs_of_nothing(spark):
    assert pairs.co_occurrence(spark.createDataFrame([], "items array<string>"), F.col("items")).count() == 0


# near-duplicates


def _brute_similar(rows):
    sets = {i: w for i, w in rows.items() if w}
    return {(a, b) for a, b in itertools.combinations(sorted(sets), 2) if len(sets[a] & sets[b]) * 100 >= 80 * len(sets[a] | sets[b])}


@pytest.mark.parametrize("block", [2000, 3])
def test_similar_against_all_pairs(spark, block):
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(40)]
    texts = {}
    for i in range(0, 400, 4):
        base = rnd.sample(words, rnd.randint(1, 14))
        for k in range(4):
            own = [w for w in base if rnd.random() > 0.06] + ([f"n{i}{k}"] if rnd.random() < 0.3 else [])
            rnd.shuffle(own)
            texts[i + k] = " ".join(own).upper()
    texts |= {1000: "", 1001: None, 1002: "<b>&nbsp;</b> ...", 1003: "lone", 1004: "LONE <i>", 1005: "a " * 20_000}
    df = spark.createDataFrame(list(texts.items()), "id long, t string").withColumn("rep", F.lit("clash"))
    members = neardup.classes(df, "id", F.col("t"))
    links = {tuple(r) for r in neardup.similar_classes(members, block=block).collect()}
    reps = {r["id"]: r["rep"] for r in members.collect()}
    want = _brute_similar({i: set((t or "").lower().replace("<b>&nbsp;</b> ...", "").replace("<i>", "").split()) for i, t in texts.items()})
    assert links == {(min(reps[a], reps[b]), max(reps[a], reps[b])) for a, b in want if reps[a] != reps[b]}
    if block == 2000:
        assert {tuple(r) for r in neardup.similar_pairs(df, "id", F.col("t")).collect()} == want
        found = {r["id"]: r for r in neardup.groups(df, "id", F.col("t")).collect()}
        degree = {i: sum(i in p for p in want) for i in found}
        assert {i: r["links"] for i, r in found.items()} == degree
        for a, b in want:
            assert found[a]["group_id"] == found[b]["group_id"] <= a
        assert neardup.similar_pairs(df.limit(0), "id", F.col("t")).count() == 0


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    got = {r["node"]: r["root"] for r in neardup.components(spark.createDataFrame([(i,) for i in [*range(61), 100, 101]], "node long"), links).collect()}
    assert set(got[i] for i in range(61)) == {0} and got[101] == 100


# byte-pair encoding


@pytest.fixture(scope="module")
def ours():
    return bpe.encoder(bpe.default_vocabulary()).encode


@pytest.fixture(scope="module")
def theirs():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.default_vocabulary())
    t.encode_special_tokens = True
    return lambda s: t.encode(s, add_special_tokens=False).ids


HARD = ["", " ", "\n\n  x", "a" * 3000, " " * 500, "=" * 300, "<|endoftext|>", "I'll they're 'sixties", "१२३ ไทย ภาษา", "裁判所は宁河州和社", "é́", "x​ÿ\x00\x1c\x85 　y", "👩‍👩‍👧‍👦🏳️‍🌈", "0123456789" * 50]


@pytest.mark.parametrize("text", HARD)
def test_encode_hard_texts(ours, theirs, text):
    assert ours(text) == theirs(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab 1\n\u3000\x1c.'s\t", max_size=30), max_size=6))
def test_encode_many_texts_with_white_space(theirs, texts):
    assert [list(memoryview(b).cast("i")) for b in bpe.encoder(bpe.default_vocabulary()).packed(texts)] == [theirs(t) for t in texts]


def test_encoder_forgets_without_harm(theirs, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 20)
    own, rnd = bpe.PrefixEncoder(bpe.default_vocabulary()), random.Random(1)
    for _ in range(30):
        texts = [" ".join(str(rnd.randint(0, 99)) * rnd.choice([1, 1, 40]) for _ in range(12)), None, ""]
        assert [list(memoryview(b).cast("i")) for b in own.packed(texts)] == [theirs(texts[0]), [], []]
    assert len(own.known) < 60


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="aeinorst THE'.,0123\n", max_size=120))
def test_encode_any_text(ours, theirs, text):
    assert ours(text) == theirs(text)


def test_every_token_encodes_as_the_other_encoder_says(ours, theirs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.default_vocabulary())
    for i in range(0, 50257, 7):
        s = t.decode([i])
        assert ours(s) == theirs(s)


def test_encode_column(spark, theirs):
    df = spark.createDataFrame([(1, None, 5), (2, "", 5), (3, "Hi there", 5)], "doc_id long, text string, ids int")
    got = {r["doc_id"]: r["ids"] for r in bpe.encode_column(df, "text").collect()}
    assert got == {1: [], 2: [], 3: theirs("Hi there")} and bpe.encode_column(df.limit(0), "text").count() == 0


# languages


def test_labels(spark):
    labels = ["en", "EN", "en_GB", "pt-BR", "deu", "ger", " French ", "und", "n/a", "xx", "", None, "unknown", "-", "e"]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in labels], "l string").select(langid.label_language(F.col("l"))).collect()]
    assert got == ["en", "en", "en", "pt", "de", "de", "fr", None, None, None, None, None, None, None, None]


def test_held_out_accuracy(spark):
    """Models fitted on one half of the rows agree with the labels of the other half as often as these labels are right (about one in ten is wrong, more of those that say English)."""
    news = table(spark, "/root/testdata/sf0.1", "news_items")
    label = F.try_element_at("metadata", F.lit("lang"))
    models = langid.train(news.where("news_id % 2 = 0"), "news_id", label, [F.col("title"), F.col("summary")])
    held = news.where("news_id % 2 = 1").select(langid.label_language(label).alias("l"), "title").where("l IS NOT NULL AND title IS NOT NULL AND l <> 'en'").collect()
    langs, confidence = models.decide([r["title"] for r in held])
    assert sum(a == r["l"] for a, r in zip(langs, held)) / len(held) > 0.85 and confidence.max() <= 1
    again, _ = models.decide(["", "12345 !!", "The council of the city approved a new budget after a long session"])
    assert again == ["und", "und", "en"]
    assert models.decide(["zxq qqxz wvvk jjkq zzxw qkkj xxqz wwvq kkjz qqwx " * 3])[0] == ["und"]


def test_confidence_is_calibrated(spark):
    """Of held-out sentences, as many are right as their confidence says; and what is sure is right more often than what is not."""
    news = table(spark, "/root/testdata/sf0.1", "news_items")
    pool = langid.sample(news, "news_id", F.try_element_at("metadata", F.lit("lang")), [F.col("title"), F.col("summary")], rows_per_label=120)
    asked = pool[::6]
    models = langid.fitted([x for k, x in enumerate(pool) if k % 6])
    pieces = [(" ".join(p), lang) for x, lang in asked for p in langid._short_pieces(x)]
    for texts in (asked, pieces):
        langs, confidence = models.decide([x for x, _ in texts])
        right = [(a == b, c) for a, (_, b), c in zip(langs, texts, confidence) if a != "und"]
        assert len(right) > 0.9 * len(texts) and abs(sum(r for r, _ in right) / len(right) - sum(c for _, c in right) / len(right)) < 0.05
        sure, unsure = [r for r, c in right if c >= 0.9], [r for r, c in right if c < 0.9]
        assert not unsure or sum(sure) / len(sure) > sum(unsure) / len(unsure)


def test_no_language_has_a_confidence_of_its_own():
    """A rejected text is not as sure as the language that it resembles most; the further beyond the limit, the surer it is none."""
    models = langid.fit({"en": ["the council of the city approved the budget after a long debate on the plan"] * 3, "de": ["der rat der stadt genehmigte den haushalt nach langer debatte"] * 3})
    langid._calibrate(models, {"en": ["the council approved the plan", "a debate on the budget of the city"], "de": ["der rat genehmigte den haushalt", "nach langer debatte der stadt"]})
    langs, confidence = models.decide(["the city approved the debate", "zxqj wvkq xxzz qqjw zzkx vwqj", "zxqj wvkq xxzz qqjw zzkx vwqj" * 4, ""])
    assert langs[0] == "en" and confidence[0] > 0.5 and set(langs[1:]) == {"und"} and all(0 <= c < 1.0001 for c in confidence) and confidence[3] == 0


def test_probabilities_add_up():
    """After any context the probabilities of all characters of a fitted model and the share kept for unseen ones (the product of the lower-order weights) sum to one."""
    texts = ["the cat sat on the mat and the dog sat on the log", "a cat and a dog and a log"]
    models = langid.fit({"en": texts})
    alphabet = sorted(set("".join(texts)))
    for context in ("the", "cat", "zzz", " a "):
        total = 0.0
        for c in alphabet:
            kept = 1.0
            codes = langid._text_codes([context + c])[0][: 3 + len(context) + 1]
            keys = langid._keys(codes)
            p = 1e-4
            for n in range(langid.ORDER):
                place = lambda t, k: t.searchsorted(k) if k in t else None
                at = place(models.contexts[n][0], keys[n - 1][-2]) if n else 0
                weight = models.contexts[n][1][at, 0] if at is not None else 1
                p, kept = p * weight, kept * weight
                at = place(models.grams[n][0], keys[n][-1])
                p += models.grams[n][1][at, 0] if at is not None else 0
            total += p
        assert abs(total + kept * (1 - 1e-4 * len(alphabet)) - 1) < 1e-3


def test_segments(spark):
    models = langid.fit({"en": ["the council of the city approved the budget", "nobody objected to the plan"], "de": ["der rat der stadt genehmigte den haushalt", "niemand widersprach dem plan"]})
    langid._calibrate(models, {"en": ["the plan of the council"], "de": ["der plan der stadt"]})
    df = spark.createDataFrame([(1, "The budget of the city", "<p>Der Rat der Stadt genehmigte den Plan.</p> Niemand widersprach dem Rat der Stadt."), (2, None, None), (3, "", " ")], "i long, t string, s string")
    got = langid.row_languages(langid.segment_languages(df, "i", "t", "s", models)).collect()
    assert [(r["id"], r["langs"], r["lang"]) for r in got] == [(1, ["de", "en"], "de")]


WHOLE = [
    ("Der Rat tagt … Le conseil a voté. The talks go on. Nobody objected !", ["Der Rat tagt …", "Le conseil a voté.", "The talks go on.", "Nobody objected !"]),
    ("Es waren 768477. Rada souhlasí? Am 19. März kam er. Die 3. Kammer tagt.", ["Es waren 768477.", "Rada souhlasí?", "Am 19. März kam er.", "Die 3. Kammer tagt."]),
    ("It passed with 12. Dr. K. Lum of the U.S. Office left.The end", ["It passed with 12.", "Dr. K. Lum of the U.S. Office left.", "The end"]),
    ("Dne 14. března; Rada … 委员会推迟了。法院！", ["Dne 14. března; Rada …", "委员会推迟了。", "法院！"]),
    ("Ποιος; Κανείς. It is at x.example.org today. 7 left", ["Ποιος;", "Κανείς.", "It is at x.example.org today.", "7 left"]),
    ("", []), (" <p> </p>", []),
]


@pytest.mark.parametrize("text,want", WHOLE)
def test_whole_sentences(text, want):
    assert langid.sentences(text) == want


def test_short_sentences_count_by_themselves(spark):
    """Rows that lost the language of a sentence glued to its neighbour; a short sentence of a row in another language has less confidence than a long one."""
    news = table(spark, "/root/testdata/sf0.1", "news_items")
    label = F.try_element_at("metadata", F.lit("lang"))
    models = langid.train(news, "news_id", label, [F.col("title"), F.col("summary")])
    rows = news.where("news_id IN (4129, 11067, 11560)").select("news_id", "title", "summary")
    rows = rows.union(spark.createDataFrame([(-1, None, "Súdna komora v Tinutazu zamietla všetkých 899907 námietok pre spor s Zadupar, a podrobnosti budú nasledovať budúci týždeň … The talks go on.")], rows.schema))
    segments = langid.segment_languages(rows, "news_id", "title", "summary", models)
    got = {r["id"]: r["langs"] for r in langid.row_languages(segments).collect()}
    assert got == {4129: ["it", "uk"], 11067: ["sk", "uk"], 11560: ["bg", "ro"], -1: ["en", "sk"]}
    (_, long_), (_, short) = sorted((r["segment_no"], r["confidence"]) for r in segments.where("id = -1").collect())
    assert short < long_


# mixing


def test_rake_meets_sources_and_caps():
    cells = [("a", "en", "x", 100.0), ("a", "de", "y", 50.0), ("b", "en", "y", 10.0), ("b", "de", "x", 30.0)]
    f = mixing.rake(cells, {"a": 60.0, "b": 60.0}, {"a": 1.0, "b": 2.0})
    tokens = [c[3] * x for c, x in zip(cells, f)]
    assert abs(tokens[0] + tokens[1] - 60) < 1e-6 and abs(tokens[2] + tokens[3] - 60) < 1e-6
    assert max(f[:2]) <= 1 and max(f[2:]) <= 2
    short = mixing.rake(cells, {"a": 60.0, "b": 600.0}, {"a": 1.0, "b": 2.0})
    assert short[2:] == [2.0, 2.0]


def test_mix(spark):
    rows = [(i, "a" if i % 4 else "b", ["en", "de"][i % 2], "t", 10 + i % 37) for i in range(2000)] + [(9001, None, "en", "t", 5), (9002, "a", "en", "t", 0), (9003, "c", "en", "t", 5)]
    sizes = spark.createDataFrame(rows, "doc_id long, source string, lang string, topic string, n_tokens long")
    targets = spark.createDataFrame([(" A ", 3.0, 1), ("B", 2.0, 4), ("gone", 1.0, 2), (None, 1.0, 1)], "source string, target_share double, max_repeats int")
    chosen, report, _ = mixing.mix(sizes, targets, stratum=300)
    got = {r["source"]: r for r in report.collect()}
    assert abs(got["a"]["reached_share"] - 0.6) < 0.005 and abs(got["b"]["reached_share"] - 0.4) < 0.005 and got["gone"]["drawn_tokens"] == 0 and got["c"]["target_share"] is None
    copies = {r["doc_id"]: (r["source"], r["copies"]) for r in chosen.collect()}
    assert max(c for s, c in copies.values() if s == "a") == 1 and max(c for s, c in copies.values() if s == "b") <= 4 and not {9001, 9002, 9003} & copies.keys()
    assert sorted(copies.items()) == sorted({r["doc_id"]: (r["source"], r["copies"]) for r in mixing.mix(sizes, targets, stratum=300)[0].collect()}.items())
    assert mixing.mix(sizes.limit(0), targets)[0].count() == 0 and mixing.mix(sizes, targets.limit(0))[0].count() == 0


def test_mix_of_documents(spark):
    report = queries.p9_shares(spark, "/root/testdata/sf0.01").where("drawn_tokens > 0").collect()
    assert all(abs(r["reached_share"] - r["share_among_present"]) < 0.03 and r["most_copies"] <= r["max_repeats"] for r in report)


def test_marginals_of_documents_hold(spark):
    """The raking reaches the wanted shares where the caps allow, and the draw keeps within a hundredth of it on every axis."""
    rows = queries.p9_marginals(spark, "/root/testdata/sf0.1").collect()
    assert {r["axis"] for r in rows} == {"source", "lang", "topic"} and {r["value"] for r in rows if r["axis"] == "topic"} >= {"COD", "BUD", "INI", "NLE", "none"}
    assert all(abs(r["drawn_share"] - r["raked_share"]) < 0.01 and abs(r["wanted_share"] - r["raked_share"]) < 0.01 for r in rows)


@pytest.mark.parametrize("stratum", [40, 700, 10_000])
def test_shares_hold_whatever_the_strata(spark, stratum):
    sizes = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("source"), F.when(F.col("id") % 5 == 0, "en").otherwise("de").alias("lang"),
                                     F.lit("t").alias("topic"), (10 + F.col("id") % 37).alias("n_tokens"))
    targets = spark.createDataFrame([("a", 1.0, 2), ("b", 1.0, 1)], "source string, target_share double, max_repeats int")
    chosen, report, marginals = mixing.mix(sizes, targets, stratum=stratum)
    assert all(abs(r["reached_share"] - 0.5) < 0.01 for r in report.collect())
    assert all(abs(r["drawn_share"] - r["wanted_share"]) < 0.02 for r in marginals.collect())
    assert chosen.groupBy("doc_id").count().where("count > 1").count() == 0


# sentences


@pytest.fixture(scope="module")
def model():
    m = sentences.Model(
        abbreviations={"en": {"Dr": False, "etc": True, "approx": False, "No": False, "e.g": False}, "de": {"z": False, "B": False}},
        starters={"the", "it", "a", "der"}, goes_on={"said"},
    )
    m.anywhere = {w: c for d in m.abbreviations.values() for w, c in d.items()}
    return m


SPLITS = [
    ("It rained. The end.", ["It rained.", "The end."]),
    ("Dr. K. Lum came. It ended.", ["Dr. K. Lum came.", "It ended."]),
    ("He saw gas, oil, etc. The talks go on.", ["He saw gas, oil, etc.", "The talks go on."]),
    ("At approx. 7.8 per cent, e.g. in No. 12 of it.", ["At approx. 7.8 per cent, e.g. in No. 12 of it."]),
    ("“Is it true?” said the clerk. The end", ["“Is it true?” said the clerk.", "The end"]),
    ("He left… and came back. Then... He ran!", ["He left… and came back.", "Then...", "He ran!"]),
    ("It was over.The council met via portal.x.example today.", ["It was over.", "The council met via portal.x.example today."]),
    ("A heading\n\nIt broke\nover lines. \r\n\r\nEnd", ["A heading", "It broke\nover lines.", "End"]),
    ("the plan passed. it was late. he met dr. lum.", ["the plan passed.", "it was late.", "he met dr. lum."]),
    ("(See the annex.) The end.", ["(See the annex.)", "The end."]),
    ("“It fell.” “The end.”", ["“It fell.”", "“The end.”"]),
    ("Am 24. März kam er. Der Rat tagt.", ["Am 24. März kam er.", "Der Rat tagt."]),
    ("委员会推迟了。法院说：“驳回！”电网报告26.3%。", ["委员会推迟了。", "法院说：“驳回！”", "电网报告26.3%。"]),
    ("「承認した。」と代表は述べた。記者は『なぜか？』と尋ねた。", ["「承認した。」と代表は述べた。", "記者は『なぜか？』と尋ねた。"]),
    ("समिति ने मतदान टाल दिया। परिषद ने कहा?", ["समिति ने मतदान टाल दिया।", "परिषद ने कहा?"]),
    ("ศาลยกคำร้อง 570507 ฉบับ สภาเมือง Bat อนุมัติงบ คณะกรรมการ", ["ศาลยกคำร้อง 570507 ฉบับ", "สภาเมือง Bat อนุมัติงบ", "คณะกรรมการ"]),
    ("Ποιος είναι; Κανείς.", ["Ποιος είναι;", "Κανείς."]),
    ("", []), ("  \n\n  ", []), ("...", ["..."]),
]


@pytest.mark.parametrize("text,want", SPLITS)
def test_splits(model, text, want):
    spans = sentences.sentence_spans(text, "de" if "März" in text else "en", model)
    assert [text[a:b] for a, b in spans] == want


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aB .!?…\n\r ;“”」。と9ไ", max_size=60))
def test_sentences_cover_all_but_blanks(text):
    spans = sentences.sentence_spans(text, "en", sentences.Model())
    at = 0
    for a, b in spans:
        assert a >= at and a < b and not text[a].isspace() and not text[b - 1].isspace() and not text[at:a].strip()
        at = b
    assert not text[at:].strip()


def _plain_counts(lang, text):
    """What :class:`sentences.Counts` counts, word by word."""
    out, lower = {}, sentences.is_lower(text.split())

    def count(kind, word, after=""):
        for w in {word, ""} if kind in ("p", "w", "s", "n") else {word}:
            out.setdefault((lang, w, after), [0] * len(sentences.KINDS))[sentences.KINDS.index(kind)] += 1

    out[lang, "", ""] = [0] * len(sentences.KINDS)
    for a, b in sentences.blocks(text):
        block = text[a:b]
        if not lower and (first := sentences._NEXT.match(block)):
            count("s", first.group().lower())
        for m in sentences._WORD.finditer(block):
            word, end = m.group(), m.end()
            if word[0].isdigit():
                continue
            dotted = word[-1] == "." and word[-2:] != ".." and (end == len(block) or block[end].isspace() or block[end] in ",;:)”’»“\"'!?")
            body = word.rstrip(".")
            count("p" if dotted else "w", body)
            count("f", body.lower())
            if not dotted or lower or end < len(block) and not block[end].isspace():
                continue
            rest = block[end:].lstrip()
            if not rest:
                count("e", body)
                continue
            after = m.group().lower() if (m := sentences._NEXT.match(rest)) else ""
            if after:
                count("n", body)
                count("b", body, after)
                count("a", after)
            if rest[0].islower() or rest[0].isdigit():
                count("c", body)
            elif after and len(body) >= 5 and "." not in body and rest[0].isupper():
                count("s", after)
        if not lower:
            for m in sentences.regex.finditer(r"[!?]+[”’»“]\s+([\p{Lu}\p{Ll}][\p{L}\p{M}]*)", block):
                count("qs" if m.group(1)[0].isupper() else "qc", m.group(1).lower())
    return out


def _settled(counts):
    return {(lang, w, a): row for lang, words, after, sums in counts.settle() for w, a, row in zip(words, after, sums.tolist())}


COUNTED = [
    "Dr. Lum met Mr. K. in Town. The end.\n\nHe left, etc. “Why?” asked a clerk. “No!” Then it rained... 12. May",
    "Lines\r\nbroken. And\rone\n \nmore e.g. this (see p. 3). End.” Next",
    "all lower. no capitals here. at all", "", "  ", "...", "A\u2029B. c",
]


@pytest.mark.parametrize("text", COUNTED)
def test_counts_by_hand(text):
    counts = sentences.Counts()
    counts.add("xx", text)
    assert _settled(counts) == _plain_counts("xx", text) and counts.size() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aBc .!?”“\n\r9,(", max_size=50))
def test_counts_of_any_text(text):
    counts = sentences.Counts()
    counts.add("xx", text)
    assert _settled(counts) == _plain_counts("xx", text)


def test_single_line_break_of_any_kind_ends_nothing():
    assert [len(list(sentences.blocks(f"a{x}b"))) for x in ("\n", "\r", "\r\n", "\n\n", "\r\n\r\n", "\r\r", "\n \n", "\u2029")] == [1, 1, 1, 2, 2, 2, 2, 2]


def test_learned_from_documents(spark):
    documents = table(spark, "/root/testdata/sf0.01", "documents")
    m = sentences.learn(documents, F.col("text"), F.col("lang"))
    assert m.abbreviation("Dr", "en") is False and m.abbreviation("usw", "de") is True and "the" in m.starters
    assert m.abbreviation("objections", "en") is None
    assert sentences.learn(documents.limit(0), F.col("text"), F.col("lang")).starters == set()
    out = sentences.split_documents(spark.createDataFrame([(1, None, "en"), (2, "One. Two " * 20_000, None)], "d long, t string, l string"), "d", "t", "l", m)
    assert out.where("doc_id = 1").count() == 0 and out.where("doc_id = 2").count() > 0


def _learned(spark, rows):
    return sentences.learn(spark.createDataFrame(rows, "t string, l string"), F.col("t"), F.col("l"))


def test_starters_are_of_a_language(spark):
    """A large language's uses within sentences neither hide a small one's starter nor does the small one lend it to the large one."""
    rows = [("The council met a man on a road with a dog and a cat in a car. The talks go on.", "en")] * 600 + [("A tanács ülésezett. A bizottság döntött ma este. A polgármester hallgatott.", "hu")] * 8
    m = _learned(spark, rows)
    assert m.starts("a", "hu") and not m.starts("a", "en") and m.starts("the", "en") and m.starts("the", "hu")
    text = "A bíró elutasította 12. A tanács hallgatott."
    assert len(sentences.sentence_spans(text, "hu", m)) == 2 and len(sentences.sentence_spans(text, "en", m)) == 1


def test_pairs_around_a_period(spark):
    """A closing abbreviation ends no sentence before the word it forms a fixed pair with."""
    rows = [("He saw gas, oil, etc.", "en")] * 8 + [("He met etc. Bell in town today. Nobody objected.", "en")] * 12 + [("He saw gas, etc. Later on they all left. Nothing happened.", "en")] * 12 + [("Later on they all left the building. Later on it rained.", "en")] * 30
    m = _learned(spark, rows)
    assert m.abbreviation("etc", "en") is True and m.pairs == {"en": {("etc", "bell")}}
    assert len(sentences.sentence_spans("He met etc. Bell in town.", "en", m)) == 1 and len(sentences.sentence_spans("He saw etc. Later on he left.", "en", m)) == 2


def test_rare_abbreviation_of_a_large_language(spark):
    """What is learned of a word does not depend on how large the rest of its language is."""
    words = spark.range(8).select(F.repeat(F.lit("rada mesta "), 500_000).alias("t"), F.lit("sk").alias("l"))
    few = spark.createDataFrame([("Prišiel p. Kolo a riad. Novak spolu. Hotovo, riad. konal.", "sk")] * 6, "t string, l string")
    m = sentences.learn(words.union(few), F.col("t"), F.col("l"))
    assert m.abbreviation("riad", "sk") is not None
