"""Language of documents and of their segments: interpolated Kneser-Ney character models.

One model per language over characters, with continuation counts below the
highest order. All models share sorted arrays of n-gram hashes; a row of the
value table holds one number per language, so one binary search serves all
languages and a batch is scored with array operations. The language with the
least length-normalised cross-entropy wins; if even that is further above the
language's usual value than ``reject`` standard deviations the segment has no
language (``und``). Confidence is the softmax of the total log-likelihoods at a
temperature fitted on held-out segments; that of ``und`` grows with the distance
beyond the limit, from 0 at it towards 1.

Fitting uses a bounded sample of labelled rows (``rows_per_label`` each). Labels
may be wrong or texts mixed: segments in another script than most of their label
are left out of the sample, and each segment is then relabelled by models fitted
on the other half of the sample, twice over.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: ISO 639-1 code, three-letter codes and English names of the languages known.
LANGUAGES = {
    "en": "eng english", "de": "deu ger german", "fr": "fra fre french", "es": "spa spanish castilian", "pt": "por portuguese", "it": "ita italian",
    "nl": "nld dut dutch flemish", "pl": "pol polish", "cs": "ces cze czech", "sk": "slk slo slovak", "hu": "hun hungarian", "ro": "ron rum romanian moldavian",
    "sv": "swe swedish", "da": "dan danish", "el": "ell gre greek", "bg": "bul bulgarian", "uk": "ukr ukrainian", "tr": "tur turkish",
    "ru": "rus russian", "ar": "ara arabic", "hi": "hin hindi", "th": "tha thai", "zh": "zho chi chinese", "ja": "jpn japanese",
}
#: Scripts told apart where a sample is cleaned.
_SCRIPTS = {k: regex.compile(rf"[\p{{{k}}}]") for k in ("Latin", "Cyrillic", "Greek", "Arabic", "Devanagari", "Thai", "Han")} | {"Kana": regex.compile(r"[\p{Hiragana}\p{Katakana}]")}
ORDER = 4
#: Characters of segments judged as short ones, and from which on as whole sentences usually are; between them in proportion.
SHORT, LONG = 20, 80
_MIX = np.uint64(0x9E3779B97F4A7C15)


def label_language(label: Column) -> Column:
    """ISO 639-1 code a label names (codes of two or three letters with or without region, English names, any case), else null."""
    names = {x: code for code, rest in LANGUAGES.items() for x in [code, *rest.split()]}
    base = F.regexp_extract(F.lower(label), r"^\s*([a-z]+)(?:[-_].*)?\s*$", 1)
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), base)


_NOISE = regex.compile(r"[^\p{L}\p{M}]+")
_MARKUP = regex.compile(r"<[^>]*>|&#?\w+;")
#: Final marks; the Greek question mark only after Greek. Marks of their own scripts need no blank after them.
_FINAL = regex.compile(
    r"(?P<mark>[.!?…。！？।॥؟]+|(?<=\p{Greek}\s?);)[\p{Pe}\p{Pf}\"']*(?P<gap>\s*)(?=[\p{Pi}\p{Ps}\"'¿¡]*(?P<next>[\p{Lu}\p{Lt}\p{Lo}][\p{L}\p{M}]*|\d))"
)
_STRONG = frozenset("。！？।॥؟")
#: Before a period that ends nothing: an initial, a word with inner periods, a title; a figure of one or two digits in a German date or after what asks for an ordinal, or as the number of an item.
_BOUND = regex.compile(r"(?:^|[^\p{L}\p{M}\d.])(?:\p{Lu}\p{M}*|\p{L}+(?:\.\p{L}+)+|Dr|Mr|Mrs|Ms|Prof|St|Nr|No)$")
_FIGURE = regex.compile(r"(?:(\p{L}+),?\s+|^\s*)\d{1,2}$")
_MONTHS = frozenset("Januar Jänner Februar Feber März April Mai Juni Juli August September Oktober November Dezember".split())
_ASKS_ORDINAL = frozenset("am vom zum bis der die das dem den des im ab seit zur beim".split())


def letters(text: str) -> str:
    """What the models see of a text: letters and marks in lower case, all else a blank."""
    return _NOISE.sub(" ", text.lower()).strip()


def _ends(text: str, m: regex.Match) -> bool:
    """Whether the final mark ``m`` ends a sentence."""
    mark, gap, follows, at = m["mark"], m["gap"], m["next"], m.start()
    if mark[-1] in _STRONG:
        return True
    if not gap:  # left out by mistake, or inside an address, a figure, an abbreviation
        return text[at - 2 : at].islower() and text[at - 2 : at].isalpha() and follows[1:].islower() and text[m.end() + len(follows) :][:1].isspace()
    if mark != ".":
        return True
    before = text[max(0, at - 40) : at]
    if before[-1:].isdigit():
        if follows.isdigit():
            return False
        figure = _FIGURE.search(before)
        return figure is None or figure[1] is not None and follows not in _MONTHS and figure[1].lower() not in _ASKS_ORDINAL
    if _BOUND.search(before):
        return False
    return not follows.isdigit() or not before[-1:].isalpha() or before[-4:].isalpha()


def sentences(text: str) -> list[str]:
    """Whole sentences of a text with markup, roughly: cut at every final mark, however short the sentences and also where a blank or a figure stands before the mark."""
    text = _MARKUP.sub(" ", text)
    out: list[str] = []
    at = 0
    for m in _FINAL.finditer(text):
        if _ends(text, m):
            out.append(text[at : m.end()].strip())
            at = m.end()
    out.append(text[at:].strip())
    return [x for x in out if x]



def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _keys(codes: np.ndarray) -> list[np.ndarray]:
    """Hash of the n-gram that ends at each position, for n = 1 .. ORDER; the hash of its context is that of n - 1 one place before."""
    keys = [_mix(codes + np.uint64(1))]
    for _ in range(1, ORDER):
        before = np.concatenate([[np.uint64(0)], keys[-1][:-1]])
        keys.append(_mix(before * _MIX + codes + np.uint64(1)))
    return keys


def _text_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each led by ORDER - 1 blanks and closed by one, and where each begins."""
    padded = [" " * (ORDER - 1) + t + " " for t in texts]
    starts = np.cumsum([0] + [len(p) for p in padded])[:-1]
    return np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64), starts


@dataclass
class Models:
    """Sorted hash arrays of all languages' models. grams[n]: (keys, discounted share per language); contexts[n]: (keys, weight of the lower order)."""

    languages: list[str]
    grams: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    contexts: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    usual: np.ndarray | None = None
    spread: np.ndarray | None = None
    temperature: float = 1.0
    #: the same of pieces of about ``SHORT`` characters, which are harder to tell
    short_usual: np.ndarray | None = None
    short_spread: np.ndarray | None = None
    short_temperature: float = 1.0

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Total log-likelihood of each text under each language, and the number of characters scored."""
        totals = np.zeros((len(texts), len(self.languages)))
        sizes = np.array([len(t) + 1 for t in texts])
        at = 0
        while at < len(texts):
            stop, n = at, 0
            while stop < len(texts) and (stop == at or n + len(texts[stop]) < 250_000):
                n += len(texts[stop])
                stop += 1
            totals[at:stop] = self._chunk(texts[at:stop])
            at = stop
        return totals, sizes

    def _chunk(self, texts: list[str]) -> np.ndarray:
        codes, starts = _text_codes(texts)
        keys = _keys(codes)
        # a character's probability depends on its longest n-gram only: work out each of these once
        _, where, inverse = np.unique(keys[-1], return_index=True, return_inverse=True)
        p = np.full((len(where), len(self.languages)), 1e-4, np.float32)
        for n in range(ORDER):
            if n:
                context = keys[n - 1][where - 1]
                table, weight = self.contexts[n]
                place = np.minimum(np.searchsorted(table, context), len(table) - 1)
                known = table[place] == context
                p[known] *= weight[place[known]]
            else:
                p *= self.contexts[0][1]
            gram = keys[n][where]
            table, share = self.grams[n]
            place = np.minimum(np.searchsorted(table, gram), len(table) - 1)
            known = table[place] == gram
            p[known] += share[place[known]]
        logs = np.log(p)[inverse]
        logs[(starts[:, None] + np.arange(ORDER - 1)).ravel()] = 0  # the leading blanks are context only
        return np.add.reduceat(logs, starts, axis=0)

    def decide(self, texts: list[str], reject: float = 6.0) -> tuple[list[str], np.ndarray]:
        """Language (or ``und``) and confidence of each text; a text without letters is ``und`` with confidence 0."""
        if not texts:
            return [], np.zeros(0)
        seen = [letters(t) for t in texts]
        totals, sizes = self.scores(seen)
        best = totals.argmax(axis=1)
        rows = np.arange(len(texts))
        # 1 for short segments, 0 from LONG characters on
        short = np.clip((LONG - sizes) / (LONG - SHORT), 0, 1)
        scaled = totals / (self.temperature + short * (self.short_temperature - self.temperature))[:, None]
        confidence = 1 / np.exp(scaled - scaled[rows, best][:, None]).sum(axis=1)
        entropy = -totals[rows, best] / sizes
        spread = (1 - short) * self.spread[best] + short * self.short_spread[best] * np.sqrt(np.maximum(1, SHORT / sizes))
        limit = (1 - short) * self.usual[best] + short * self.short_usual[best] + reject * spread
        blank = np.array([not s for s in seen])
        lost = (entropy > limit) | blank
        confidence = np.where(lost, 1 - np.exp(-np.maximum(entropy - limit, 0) / spread), confidence)
        return ["und" if x else self.languages[b] for b, x in zip(best, lost)], np.where(blank, 0.0, confidence)


def _fit_one(texts: list[str]) -> tuple[list, list]:
    """Per order: (keys, discounted shares), (context keys, lower-order weights) of one language."""
    codes, starts = _text_codes(texts)
    keys = _keys(codes)
    scored = np.ones(len(codes), bool)
    for k in range(ORDER - 1):
        scored[starts + k] = False
    at = np.flatnonzero(scored)
    grams, contexts = [], []
    types: tuple[np.ndarray, np.ndarray] | None = None
    for n in range(ORDER - 1, -1, -1):
        if types is None:
            key, where, count = np.unique(keys[n][at], return_index=True, return_counts=True)
            where = at[where]
        else:  # continuation counts: distinct longer types that end in this one
            _, longer_at = types
            key, first, count = np.unique(keys[n][longer_at], return_index=True, return_counts=True)
            where = longer_at[first]
        ones, twos = (count == 1).sum(), (count == 2).sum()
        discount = ones / (ones + 2 * twos) if ones else 0.5
        context = keys[n - 1][where - 1] if n else np.zeros(len(where), np.uint64)
        c_key, inverse = np.unique(context, return_inverse=True)
        mass = np.bincount(inverse, count, len(c_key))
        kinds = np.bincount(inverse, minlength=len(c_key))
        grams.append((key, ((count - discount) / mass[inverse]).astype(np.float32)))
        contexts.append((c_key, (discount * kinds / mass).astype(np.float32)))
        types = (key, where)
    return grams[::-1], contexts[::-1]


def fit(samples: dict[str, list[str]]) -> Models:
    """Models of each language with samples (texts as of :func:`letters`)."""
    languages = sorted(k for k, v in samples.items() if v)
    models = Models(languages)
    fitted = [_fit_one(samples[x]) for x in languages]
    for kind, empty, out in ((0, 0.0, models.grams), (1, 1.0, models.contexts)):
        for n in range(ORDER):
            keys = np.unique(np.concatenate([f[kind][n][0] for f in fitted]))
            values = np.full((len(keys), len(languages)), empty, np.float32)
            for j, f in enumerate(fitted):
                values[np.searchsorted(keys, f[kind][n][0]), j] = f[kind][n][1]
            out.append((keys, values))
    return models


def _calibrate(models: Models, held: dict[str, list[str]]) -> None:
    """Usual cross-entropy per language, its spread, and the temperature of the confidence, on held-out segments whole and cut into short pieces."""
    models.usual, models.spread, models.temperature = _usual(models, held)
    cut = {x: [" ".join(p) for t in texts for p in _short_pieces(t)] for x, texts in held.items()}
    models.short_usual, models.short_spread, models.short_temperature = _usual(models, cut)
    models.short_temperature = max(models.temperature, models.short_temperature)


def _short_pieces(text: str) -> Iterator[list[str]]:
    """The words of a text in runs of about ``SHORT`` characters."""
    run: list[str] = []
    for word in text.split():
        run.append(word)
        if sum(map(len, run)) + len(run) > SHORT:
            yield run
            run = []


def _usual(models: Models, held: dict[str, list[str]]) -> tuple[np.ndarray, np.ndarray, float]:
    n = len(models.languages)
    usual, spread, temperature = np.full(n, 2.5), np.full(n, 0.3), 1.0
    logs, right = [], []
    for j, x in enumerate(models.languages):
        if texts := held.get(x):
            totals, sizes = models.scores(texts)
            entropy = -totals[:, j] / sizes
            usual[j], spread[j] = entropy.mean(), max(0.05, entropy.std())
            logs.append(totals)
            right += [j] * len(texts)
    if right:
        all_logs, rows = np.concatenate(logs), np.arange(len(right))

        def loss(t: float) -> float:
            z = all_logs / t
            z = z - z.max(axis=1, keepdims=True)
            return float(-(z[rows, right] - np.log(np.exp(z).sum(axis=1))).mean())

        temperature = min((1.0, 2.0, 4.0, 8.0, 16.0, 32.0), key=loss)
    return usual, spread, temperature


def script(text: str) -> str:
    """The script most letters of a text are in."""
    return max(_SCRIPTS, key=lambda k: len(_SCRIPTS[k].findall(text)))


def _relabel(pool: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Each segment with the language that models fitted on the other half of the pool give it.

    A model must not judge what it was fitted on: it would know a wrongly labelled text by heart.
    """
    new = list(pool)
    for half in (0, 1):
        seen: dict[str, list[str]] = {}
        for k, (x, lang) in enumerate(pool):
            if k % 2 != half:
                seen.setdefault(lang, []).append(x)
        asked = [k for k in range(len(pool)) if k % 2 == half]
        if not seen or not asked:
            continue
        models = fit(seen)
        best = models.scores([pool[k][0] for k in asked])[0].argmax(axis=1)
        for k, b in zip(asked, best):
            new[k] = (pool[k][0], models.languages[b])
    return new


def sample(rows: DataFrame, row_id: str, label: Column, parts: list[Column], rows_per_label: int = 300, relabelled: int = 2) -> list[tuple[str, str]]:
    """(text, language) of the sentences of at most about ``rows_per_label`` rows of each named language (twice that at the very most over all), relabelled by cross-fitting.

    Which rows are taken follows a hash of the id, so a run can be repeated.
    """
    text = F.concat_ws("\n", *parts)
    named = rows.select(F.xxhash64(F.lit("sample"), row_id).alias("h"), label_language(label).alias("lang"), *[p.alias(f"part{i}") for i, p in enumerate(parts)]).where(F.col("lang").isNotNull() & (F.length(F.trim(text)) > 0))
    counts = {r["lang"]: r["count"] for r in named.groupBy("lang").count().collect()}
    if not counts:
        return []
    share = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, rows_per_label / n)))])
    picked = named.where(F.pmod("h", F.lit(1_000_000)) < F.element_at(share, F.col("lang")) * 1_000_000).orderBy("h").limit(2 * rows_per_label * len(LANGUAGES)).collect()
    labelled: dict[str, list[str]] = {}
    for r in picked:
        for i in range(len(parts)):
            if r[f"part{i}"]:
                labelled.setdefault(r["lang"], []).extend(x for s in sentences(r[f"part{i}"]) if len(x := letters(s)) >= 12)
    pool = []
    for lang in sorted(labelled):
        texts = sorted(set(labelled[lang]))
        usual = Counter(script(x) for x in texts).most_common(1)[0][0]
        pool += [(x, lang) for x in texts if script(x) == usual]
    for _ in range(relabelled):
        pool = _relabel(pool)
    return pool


def train(rows: DataFrame, row_id: str, label: Column, parts: list[Column], **options) -> Models | None:
    """Models fitted on a :func:`sample`; None where no row has a label. One in five of its segments is held out for calibration."""
    pool = sample(rows, row_id, label, parts, **options)
    return fitted(pool) if pool else None


def fitted(pool: list[tuple[str, str]]) -> Models:
    again: dict[str, list[str]] = {}
    held: dict[str, list[str]] = {}
    for k, (x, lang) in enumerate(pool):
        (held if k % 5 == 4 else again).setdefault(lang, []).append(x)
    models = fit(again)
    _calibrate(models, held)
    return models


def segment_languages(rows: DataFrame, row_id: str, title: str, summary: str, models: Models) -> DataFrame:
    """``id``, ``part``, ``segment_no``, ``lang``, ``confidence``, ``letters``: the title as one segment, each whole sentence of the summary as one."""
    shared = rows.sparkSession.sparkContext.broadcast(models)
    narrow = rows.select(F.col(row_id).cast("long").alias("id"), F.col(title).alias("title"), F.col(summary).alias("summary"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), 2000):
                found: list[tuple] = []
                texts: list[str] = []
                for i, t, s in frame.iloc[at : at + 2000].itertuples(index=False):
                    for part, pieces in (("title", [_MARKUP.sub(" ", t)] if t else []), ("summary", sentences(s) if s else [])):
                        for k, piece in enumerate(x for x in pieces if x.strip()):
                            found.append((i, part, k))
                            texts.append(piece)
                if not found:
                    continue
                langs, confidence = shared.value.decide(texts)
                out = pd.DataFrame(found, columns=["id", "part", "segment_no"])
                out["lang"], out["confidence"], out["letters"] = langs, confidence, [len(letters(t)) for t in texts]
                yield out

    return narrow.mapInPandas(run, "id bigint, part string, segment_no int, lang string, confidence double, letters int")


def row_languages(segments: DataFrame, least_letters: int = 25, sure: float = 0.95) -> DataFrame:
    """``id``, ``langs`` (sorted) and the row's ``lang`` (most letters) and ``confidence``; segments of fewer letters count only where they are sure or a row has no other."""
    known = segments.where("lang <> 'und'")
    long_enough = (F.col("letters") >= least_letters) | (F.col("confidence") >= sure)
    per = known.groupBy("id", "lang").agg(F.sum("letters").alias("n"), F.max(long_enough).alias("clear"), (F.sum(F.col("confidence") * F.col("letters")) / F.sum(F.greatest("letters", F.lit(1)))).alias("confidence"))
    rows = per.groupBy("id").agg(F.collect_list(F.struct("n", "lang", "clear", "confidence")).alias("all"))  # one entry per language
    rows = rows.withColumn("kept", F.when(F.exists("all", lambda x: x["clear"]), F.filter("all", lambda x: x["clear"])).otherwise(F.slice(F.sort_array("all", asc=False), 1, 1)))
    top = F.array_max("kept")
    return rows.select("id", F.array_sort(F.transform("kept", lambda x: x["lang"])).alias("langs"), top["lang"].alias("lang"), top["confidence"].alias("confidence"))
