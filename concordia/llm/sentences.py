"""Sentence boundaries across languages and scripts, from statistics of the corpus itself.

Learned without labels, per language: which words are abbreviations (their
period belongs to them far more often than chance lets it: log-likelihood ratio,
weighted by length, inner periods and the share of uses without a period), which
of these also close sentences (they stand at the end of a paragraph), which
words start sentences (log-likelihood ratio of first words), which words follow
a closing abbreviation as a fixed pair (log-likelihood ratio of the pair around
the period), and which words go on after a closed quotation. Each
possible boundary is then classified by its mark, what stands around it, and
these statistics.

Counting is one pass over all documents; a task sums its counts before they are
shuffled, the ratios are worked out in Spark for every word of every language,
and only words judged abbreviations, starters, pairs or continuations reach the
driver, with what the other languages make of the same words.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain
from operator import itemgetter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordia.llm.langid import label_language
from concordia.runtime import cut

#: Marks that end a sentence by themselves, in the scripts that have them.
STRONG = "。！？｡।॥؟۔።፧"
_QUOTES = "\"'”’»›"
_MARK = regex.compile(
    rf"(?P<mark>[.!?…{STRONG}]+|(?<=[\p{{Greek}}\d»\)]);)"
    rf"(?P<close>(?:[”’»›」』\)\]）］】〉》]|[\"'](?![\p{{L}}\d])|[“«](?=\s|$|[\p{{P}}&&[^“„「«]])|[   ]»(?![\p{{L}}\d]))*)",
    regex.V1,
)
_LINE_END = r"(?:\r\n|\n|\r(?!\n)|\u2028)"
_BLANK_LINE = regex.compile(rf"{_LINE_END}[^\S\n\r\u2028\u2029]*{_LINE_END}\s*|\s*\u2029\s*")
#: Whether a text has a blank line at all; cheaper than looking for each.
_BREAK = regex.compile(rf"{_LINE_END}[^\S\n\r\u2028\u2029]*{_LINE_END}|\u2029")
_WORD = regex.compile(r"[\p{L}\p{M}][\p{L}\p{M}.]*|\d+")
_NEXT = regex.compile(r"[\p{L}\p{M}]+")
_THAI = regex.compile(r"\p{Thai}")
_BLANKS_INSIDE = regex.compile(r"(?<=\S)\s+(?=\S)")
_NO_WORD_THEN_THAI = regex.compile(r"\W\p{Thai}")
_LATIN, _LETTER = regex.compile(r"\p{Latin}"), regex.compile(r"\p{L}")
_TWO_LATIN_WORDS = regex.compile(r"[\p{Latin}\p{M}'’-]+[ \n]+[\p{Latin}\p{M}]")
_EAST_ASIAN = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}]")
_CASED = regex.compile(r"[\p{Lu}\p{Ll}]")
_OPENING = set("“„«‹「『‘\"'([（【¿¡《〈")
_GOES_ON = set(",;:，、；：-–—‑")
_JOINS_QUOTE = ("と", "って", "という")


def _nfc(s: str) -> str:
    return s if s.isascii() else unicodedata.normalize("NFC", s)


def blocks(text: str) -> Iterator[tuple[int, int]]:
    """Paragraphs (between blank lines) without white space around them."""
    at = 0
    for m in [*_BLANK_LINE.finditer(text), None]:
        end = m.start() if m else len(text)
        a, b = at, end
        while a < b and text[a].isspace():
            a += 1
        while b > a and text[b - 1].isspace():
            b -= 1
        if a < b:
            yield a, b
        if m:
            at = m.end()


def _whole(text: str) -> Iterator[tuple[int, int]]:
    """As :func:`blocks`, of a text without a blank line."""
    end = len(text.rstrip())
    if end:
        yield len(text) - len(text.lstrip()), end


def _word_before(text: str, a: int, end: int) -> str:
    """The figure, or the word with its inner periods, that ends at ``end`` and begins at ``a`` or later; "" if there is none."""
    at = end
    if at > a and text[at - 1].isdigit():
        while at > a and text[at - 1].isdigit():
            at -= 1
        return text[at:end]
    while at > a and ((c := text[at - 1]) == "." and at < end and text[at] != "." or c.isalpha() or unicodedata.category(c)[0] == "M"):
        at -= 1
    return text[at:end].lstrip(".")


class _Case(dict):
    """Character -> 1 for a capital, -1 for a small letter, else 0."""

    def __missing__(self, c: str) -> int:
        found = self[c] = 0 if _CASED.match(c) is None else 1 if c.isupper() else -1
        return found


_CASE = _Case()


def is_lower(words: list[str]) -> bool:
    """Whether a text, given as its stretches between blanks, is written without capitals: hardly one of those that begin with a cased letter begins with a capital (stray tokens may)."""
    upper = lower = 0
    for c, n in Counter(map(_FIRST, words)).items():
        if (case := _CASE[c]) > 0:
            upper += n
        elif case:
            lower += n
    return upper + lower > 0 and upper <= 0.03 * (upper + lower)


_FIRST = itemgetter(0)
#: Columns of the counts. p, w: followed by a period or not; e: with its period at the end of a paragraph; c: with its period, then a small letter or a figure;
#: n: with its period, then a word; b: this pair of words around a period. Of words in lower case: f: all uses; s: starts a paragraph or follows a long word with a period;
#: a: follows any word with a period; qs, qc: capital or small after a closed quotation that ends in ! or ?. The row of the word "" holds a language's totals of f (as w), s and n.
KINDS = ["p", "w", "e", "c", "n", "b", "f", "s", "a", "qs", "qc"]
_P, _W, _E, _C, _N, _B, _F, _S, _A, _QS, _QC = range(len(KINDS))
_QUOTED_END = regex.compile(r"[!?]+[”’»“]$")
_AFTER_QUOTE = regex.compile(r"[\p{Lu}\p{Ll}][\p{L}\p{M}]*")


def _token_words(token: str) -> tuple[list[tuple[str, bool]], str | None]:
    """(word, whether a period follows it) of each word of a stretch between blanks; and the word whose period ends the stretch as far as words go (closing marks may follow)."""
    words, last = [], None
    for m in _WORD.finditer(token):
        word = m.group()
        if word[0].isdigit():
            continue
        word, after = _nfc(word), token[m.end() : m.end() + 1]
        dotted = word[-1] == "." and word[-2:] != ".." and (not after or after in ",;:)”’»“\"'!?")
        body = word.rstrip(".") if word[-1] == "." else word
        words.append((body, dotted))
        last = body if dotted and m.end() == len(token) else None
    return words, last


#: Entries that a task's counts hold before they are handed on; bounds its memory, not what is counted.
MOST_COUNTS = 1_000_000


class Counts:
    """Counts of words by language, summed up over many texts. Words keep their case; starters and words after are in lower case.

    What stands between two blanks is looked at once, however often it occurs; only at periods and paragraph ends the neighbour counts as well.
    """

    def __init__(self) -> None:
        self._tokens: dict[str, Counter] = {}
        self._words: dict[str, dict[str, list[int]]] = {}
        self._pairs: dict[str, dict[tuple[str, str], int]] = {}
        self._ends: dict[str, str | None] = {}
        self._starts: dict[str, tuple[str, str, str]] = {}

    def _end(self, token: str) -> str | None:
        """The word whose period ends a stretch; "?" if a quotation closed after ! or ? does; else None."""
        found = self._ends[token] = _token_words(token)[1] if token[-1] == "." else "?" if _QUOTED_END.search(token) else None
        return found

    def _start(self, token: str) -> tuple[str, str, str]:
        """The word a stretch starts with, in lower case; how its first character counts (l: small letter or figure, u: capital); and the word after a quotation."""
        word, first, cased = _NEXT.match(token), token[0], _AFTER_QUOTE.match(token)
        kind = "l" if first.islower() or first.isdigit() else "u" if first.isupper() else ""
        found = self._starts[token] = (_nfc(word.group()).lower() if word else "", kind, ("C" if first.isupper() else "c") + _nfc(cased.group()).lower() if cased else "")
        return found

    def add(self, lang: str, text: str) -> None:
        tokens = self._tokens.get(lang)
        if tokens is None:
            tokens, self._words[lang], self._pairs[lang] = self._tokens.setdefault(lang, Counter()), {"": [0] * len(KINDS)}, {}
        rows, pairs, ends, starts = self._words[lang], self._pairs[lang], self._ends, self._starts
        total = rows[""]

        def row(word: str) -> list[int]:
            found = rows.get(word)
            if found is None:
                found = rows[word] = [0] * len(KINDS)
            return found

        every = text.split()
        tokens.update(every)
        if is_lower(every):
            return
        for words in [every] if _BREAK.search(text) is None else [text[a:b].split() for a, b in blocks(text)]:
            if not words:
                continue
            if first := (starts.get(words[0]) or self._start(words[0]))[0]:
                row(first)[_S] += 1
                total[_S] += 1
            for k in [k for k, w in enumerate(words) if w[-1] in ".”’»“"]:
                token = words[k]
                body = ends[token] if token in ends else self._end(token)
                if body is None:
                    continue
                after, kind, quoted = (starts.get(words[k + 1]) or self._start(words[k + 1])) if k + 1 < len(words) else ("", "", "")
                if body == "?":
                    if quoted:
                        row(quoted[1:])[_QS if quoted[0] == "C" else _QC] += 1
                    continue
                mine = row(body)
                if k + 1 == len(words):
                    mine[_E] += 1
                    continue
                if after:
                    mine[_N] += 1
                    total[_N] += 1
                    pairs[body, after] = pairs.get((body, after), 0) + 1
                    row(after)[_A] += 1
                if kind == "l":
                    mine[_C] += 1
                elif kind == "u" and after and len(body) >= 5 and "." not in body:
                    row(after)[_S] += 1
                    total[_S] += 1

    def settle(self) -> list[tuple[str, list[str], list[str], np.ndarray]]:
        """(language, words, words after or "", a column per kind) of the sums so far, which start afresh."""
        out = []
        for lang, tokens in self._tokens.items():
            rows = self._words[lang]
            plain, folded, dotted = {}, {}, {}
            for token, n in tokens.items():
                for body, by in [(_nfc(token), False)] if token.isalpha() else _token_words(token)[0]:
                    counts = dotted if by else plain
                    counts[body] = counts.get(body, 0) + n
                    low = body.lower()
                    folded[low] = folded.get(low, 0) + n
            rows[""][_P], rows[""][_W] = sum(dotted.values()), sum(plain.values())
            words = list(dict.fromkeys(chain(rows, plain, folded, dotted)))
            none = [0] * len(KINDS)
            sums = np.array([rows.get(w, none) for w in words], np.int64).reshape(-1, len(KINDS))
            for kind, counts in ((_P, dotted), (_W, plain), (_F, folded)):
                sums[1:, kind] = [counts.get(w, 0) for w in words[1:]]
            pairs = np.zeros((len(self._pairs[lang]), len(KINDS)), np.int64)
            pairs[:, _B] = list(self._pairs[lang].values())
            out.append((lang, words + [a for a, _ in self._pairs[lang]], [""] * len(words) + [b for _, b in self._pairs[lang]], np.concatenate([sums, pairs])))
        self.__init__()
        return out

    def size(self) -> int:
        return len(self._ends) + len(self._starts) + sum(map(len, chain(self._tokens.values(), self._words.values(), self._pairs.values())))


@dataclass
class Model:
    """What was learned. abbreviations: language -> word -> whether it also closes sentences; words known not to be ones per language, too."""

    abbreviations: dict[str, dict[str, bool]] = field(default_factory=dict)
    plain: dict[str, set[str]] = field(default_factory=dict)
    anywhere: dict[str, bool] = field(default_factory=dict)
    starters: set[str] = field(default_factory=set)
    goes_on: set[str] = field(default_factory=set)
    #: What each language makes of a word that starts sentences (goes on after quotations) in some language, if it knows; ``starters`` and ``goes_on`` hold what the language that uses it most makes of it.
    starters_of: dict[str, dict[str, bool]] = field(default_factory=dict)
    goes_on_of: dict[str, dict[str, bool]] = field(default_factory=dict)
    #: (closing abbreviation, word after) per language
    pairs: dict[str, set[tuple[str, str]]] = field(default_factory=dict)

    def starts(self, word: str, lang: str) -> bool:
        return self.starters_of.get(lang, {}).get(word, word in self.starters)

    def continues(self, word: str, lang: str) -> bool:
        return self.goes_on_of.get(lang, {}).get(word, word in self.goes_on)

    def abbreviation(self, word: str, lang: str) -> bool | None:
        """None: no abbreviation; else whether it also closes sentences. A language that does not know a word takes it as the language does that uses it most."""
        if lang != "und":
            own = self.abbreviations.get(lang, {})
            if word in own:
                return own[word]
            if word in self.plain.get(lang, ()):
                return None
        return self.anywhere.get(word)


def dunning(n_word: int, n_both: int, share: float) -> float:
    """Log-likelihood ratio of a word's period belonging to it (0.99) against its following by chance (``share``)."""
    share = min(max(share, 1e-9), 1 - 1e-9)
    chance = n_both * math.log(share) + (n_word - n_both) * math.log(1 - share)
    bound = n_both * math.log(0.99) + (n_word - n_both) * math.log(0.01)
    return -2 * (chance - bound)


def abbreviation_score(word: str, with_period: int, without: int, period_share: float) -> float:
    """The ratio, weighted down for long words and for use without a period, up for inner periods."""
    length = max(1, len(word.replace(".", "")))
    inner = word.count(".") + 1
    ratio = dunning(with_period + without, with_period, period_share)
    return ratio * math.exp(-length) * inner * max(2, length) ** (-100 * without / (with_period + without))


def _abbreviation_score(period_share: Column) -> Column:
    """:func:`abbreviation_score` of the columns ``word``, ``p`` and ``w``."""
    share = F.least(F.greatest(period_share, F.lit(1e-9)), F.lit(1 - 1e-9))
    p, w = F.col("p").cast("double"), F.col("w").cast("double")
    ratio = -2 * (p * F.log(share) + w * F.log(1 - share) - p * math.log(0.99) - w * math.log(0.01))
    letters = F.length(F.replace("word", F.lit("."), F.lit("")))
    length = F.greatest(F.lit(1), letters)
    return ratio * F.exp(-length.cast("double")) * (F.length("word") - letters + 1) * F.pow(F.greatest(F.lit(2), length).cast("double"), -100 * w / (p + w))


def association(a: Column, b: Column, both: Column, n: Column) -> Column:
    """Dunning's log-likelihood ratio of two events counted ``a`` and ``b`` times, ``both`` together, among ``n``; negative if they avoid each other."""
    a, b, both, n = (x.cast("double") for x in (a, b, both, n))
    b = F.greatest(b, both)
    n = F.greatest(n, a + b)

    def likelihood(k: Column, of: Column, share: Column) -> Column:
        share = F.least(F.greatest(share, F.lit(1e-12)), F.lit(1 - 1e-12))
        return k * F.log(share) + (of - k) * F.log(1 - share)

    free, own, rest = b / n, both / a, (b - both) / (n - a)
    ratio = 2 * (likelihood(both, a, own) + likelihood(b - both, n - a, rest) - likelihood(both, a, free) - likelihood(b - both, n - a, free))
    return F.when(own > free, ratio).otherwise(-ratio)


def _judged(rows: DataFrame, yes: str) -> list:
    """The rows of every word that ``yes`` is true of in some language: bounded by the words so judged times the languages."""
    words = rows.where(yes).select("word").distinct()
    return rows.join(words, "word", "left_semi").orderBy("word", "lang").collect()


def learn(documents: DataFrame, text: Column, label: Column, least_count: int = 5, threshold: float = 0.3, closing_share: float = 0.015, significant: float = 7.88) -> Model:
    """A model of all documents. Texts without a known label count as language ``und``; null texts count nothing.

    A word is a starter, or a pair of a closing abbreviation and the word after it is fixed, from a log-likelihood ratio of ``significant`` on; starters make no fixed pairs.
    Pairs are judged among all words around periods, so a word that merely often starts sentences makes none. Pairs after figures and initials need not be known: these end a sentence only before a starter.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts()

        def rows() -> Iterator[pa.RecordBatch]:
            for lang, words, after, sums in counts.settle():
                columns = [pa.array([lang] * len(words)), pa.array(words, pa.string()), pa.array(after, pa.string()), *[pa.array(np.ascontiguousarray(v)) for v in sums.T]]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "word", "after", *KINDS])

        for batch in batches:
            for lang, t in zip(batch.column("lang").to_pylist(), batch.column("t").to_pylist()):
                if t:
                    counts.add(lang, t)
                    if counts.size() > MOST_COUNTS:
                        yield from rows()
        yield from rows()

    texts = documents.select(F.coalesce(label_language(label), F.lit("und")).alias("lang"), text.alias("t"))
    counted = texts.mapInArrow(count, "lang string, word string, after string, " + ", ".join(f"{k} bigint" for k in KINDS))
    raw = counted.groupBy("lang", "word", "after").agg(*[F.sum(k).alias(k) for k in KINDS])
    # a word seen once, or less than least_count times beside a period, can be judged nothing below: the ratio of one use is at most twice the logarithm of its odds
    raw = raw.where(" OR ".join(["word = ''", "f >= 2", "qc + qs >= 1", *[f"{k} >= {int(least_count)}" for k in "psab"]])).persist()
    try:
        totals = raw.where("word = '' AND after = ''").select("lang", F.col("p").alias("all_p"), (F.col("p") + F.col("w")).alias("all_f"), F.col("s").alias("all_s"), F.col("n").alias("all_n")).where("all_f > 0").collect()
        if not totals:
            return Model()
        per_language = F.broadcast(documents.sparkSession.createDataFrame(totals))  # a row per known language
        # words that only ever end sentences are followed by capitals or nothing; short ones must show that they are abbreviations some other way
        ends_only = (F.col("c") == 0) & ~F.contains("word", F.lit(".")) & (F.length("word") > 4) & (F.col("w") > 0.02 * (F.col("p") + F.col("w")))
        score = _abbreviation_score(F.col("all_p") / F.col("all_f"))
        one = F.col("after") == ""
        dotted = one & (F.col("p") >= least_count)
        ratio = association(F.col("all_s"), F.col("f"), F.col("s"), F.col("all_f"))
        flags = {
            "is_one": dotted & (score >= threshold) & ~ends_only, "closes": (F.col("e") >= closing_share * F.col("p")) & (F.col("e") >= 1),
            "starts": one & (F.col("s") >= least_count) & (ratio >= significant), "not_start": one & (F.col("f") > 0) & (ratio <= -significant),
            "goes": one & (F.col("qc") >= 2) & (F.col("qc") > F.col("qs")), "stays": one & (F.col("qs") > 0) & (F.col("qs") >= F.col("qc")),
        }
        judged = raw.where("word <> ''").join(per_language, "lang").withColumns(flags)
        # what says nothing about a boundary leaves here: most words, and most pairs
        judged = cut(judged.where(dotted | F.col("starts") | F.col("not_start") | F.col("goes") | F.col("stays") | one & (F.col("a") >= least_count) | ~one & (F.col("b") >= least_count)))
    finally:
        raw.unpersist()

    words = judged.where("after = ''")
    abbreviations = _judged(words.where(F.col("p") >= least_count).select("lang", "word", "is_one", "closes", (F.col("p") + F.col("w")).alias("uses"), "n"), "is_one")
    starters = _judged(words.where("starts OR not_start").select("lang", "word", "starts", "not_start", F.col("f").alias("uses")), "starts")
    quoted = _judged(words.where("goes OR stays").select("lang", "word", "goes", "stays", F.expr("qc + qs").alias("uses")), "goes")
    closing = documents.sparkSession.createDataFrame([(r["lang"], r["word"], r["n"]) for r in abbreviations if r["is_one"] and r["closes"]], "lang string, word string, n_word long")
    around = judged.where("after <> ''").select("lang", "word", "after", "b", "all_n").join(closing, ["lang", "word"])
    around = around.join(words.where(F.col("a") >= least_count).select("lang", F.col("word").alias("after"), F.col("a").alias("n_after"), "starts"), ["lang", "after"])
    fixed = around.where(~F.col("starts") & (association(F.col("n_word"), F.col("n_after"), F.col("b"), F.col("all_n")) >= significant)).select("lang", "word", "after").collect()

    model = Model()
    most: dict[str, int] = {}
    for r in abbreviations:
        word = r["word"]
        found = r["closes"] if r["is_one"] else None
        if found is None:
            model.plain.setdefault(r["lang"], set()).add(word)
        else:
            model.abbreviations.setdefault(r["lang"], {})[word] = found
        if r["uses"] > most.get(word, 0):
            most[word] = r["uses"]
            if found is None:
                model.anywhere.pop(word, None)
            else:
                model.anywhere[word] = found
    for rows, yes, no, own, anywhere in ((starters, "starts", "not_start", model.starters_of, model.starters), (quoted, "goes", "stays", model.goes_on_of, model.goes_on)):
        most = {}
        for r in rows:
            if not (r[yes] or r[no]):
                continue
            if r["lang"] != "und":
                own.setdefault(r["lang"], {})[r["word"]] = r[yes]
            if r["uses"] > most.get(r["word"], 0):
                most[r["word"]] = r["uses"]
                (anywhere.add if r[yes] else anywhere.discard)(r["word"])
    for r in fixed:
        model.pairs.setdefault(r["lang"], set()).add((r["word"], r["after"]))
    return model


def sentence_spans(text: str | None, lang: str, model: Model) -> list[tuple[int, int]]:
    """(start, end) of each sentence in code points, end exclusive, no white space at either end; together they cover all else. None and blank texts have none."""
    spans: list[tuple[int, int]] = []
    if not text:
        return spans
    lower = _Lower(text)
    for a, b in blocks(text) if _BREAK.search(text) else _whole(text):
        cuts = sorted(set(_mark_cuts(text, a, b, lang, lower, model)) | set(_thai_cuts(text, a, b)))
        at = a
        for cut in [*cuts, b]:
            s, e = at, cut
            while s < e and text[s].isspace():
                s += 1
            while e > s and text[e - 1].isspace():
                e -= 1
            if s < e:
                spans.append((s, e))
            at = cut
    return spans


class _Lower:
    """:func:`is_lower` of a text, worked out when first asked for."""

    def __init__(self, text: str):
        self.text, self.found = text, None

    def __call__(self) -> bool:
        if self.found is None:
            self.found = is_lower(self.text.split())
        return self.found


def _thai_cuts(text: str, a: int, b: int) -> Iterator[int]:
    """In Thai a blank ends a sentence, unless it is next to a figure or a Latin-script name. Two Latin words in a row are no name but another language."""
    if _THAI.search(text, a, b) is None:
        return
    for m in _BLANKS_INSIDE.finditer(text[a:b]):
        s, e = a + m.start(), a + m.end()
        left, right = text[s - 1], text[e]
        thai_left, thai_right = bool(_THAI.match(left)), bool(_THAI.match(right))
        if thai_left and (thai_right or right in _OPENING and _NO_WORD_THEN_THAI.match(text, e, e + 2)):
            yield s
        elif thai_left and _LATIN.match(right):
            if _TWO_LATIN_WORDS.match(text, e, b):
                yield s
        elif thai_left and _LETTER.match(right):
            yield s


def _mark_cuts(text: str, a: int, b: int, lang: str, lower: _Lower, model: Model) -> Iterator[int]:
    for m in _MARK.finditer(text, a, b):
        end = m.end()
        if end >= b:
            continue
        mark, close = m.group("mark"), m.group("close")
        n = end
        while n < b and text[n].isspace():
            n += 1
        if n >= b:
            continue
        if _ends(text, a, b, m.start(), mark, close, end, n, lang, lower, model):
            yield end


def _ends(text: str, a: int, b: int, start: int, mark: str, close: str, end: int, n: int, lang: str, lower: _Lower, model: Model) -> bool:
    """Whether the mark at ``start`` (its closing quotes end at ``end``, the next visible character is at ``n``) ends a sentence."""
    nxt, spaced = text[n], n > end
    follows = _NEXT.match(text, n, b)
    word = _nfc(follows.group()).lower() if follows else ""
    starter = model.starts(word, lang)
    strong = mark[-1] in STRONG or mark[0] in STRONG or mark[0] == "…" and set(mark) == {"…"} and bool(_EAST_ASIAN.match(text[start - 1 : start]))
    quoted = bool(close.strip(" )]）】   "))
    if nxt in _GOES_ON and not (nxt in "-–—" and not quoted and spaced and mark[-1] not in "."):
        return False
    if nxt in ")]）」』":
        return False
    if strong:
        return not (close and text.startswith(_JOINS_QUOTE, n) and not spaced)
    small = nxt.islower() and bool(_CASED.match(nxt))
    dots = mark[-1] == "…" or mark.endswith("..")

    if mark[-1] in "!?;" or dots:
        if not spaced and not close and nxt not in _OPENING:
            if nxt.isdigit() or not nxt.isalpha() or mark == ";":
                return False
        if small:
            if not lower():
                return False
            if quoted:
                return starter and not model.continues(word, lang)
            return starter if dots else True
        return True

    # a single period
    if close:
        if small:
            return lower() and starter
        return nxt.isalpha() or nxt in _OPENING or (spaced and not nxt.isdigit())
    body = _nfc(_word_before(text, a, start))
    if not spaced:
        # no blank after the mark: inside figures, addresses and abbreviations it ends nothing
        if not body or body.isdigit() or nxt.isdigit():
            return False
        if "." in body or len(body) < 2 or _abbreviation(body, lang, model) is not None:
            return False
        if nxt in _OPENING:
            return True
        if not follows:
            return False
        after = text[follows.end() : follows.end() + 1]
        if small or not _CASED.match(nxt):
            return (not small or lower() and starter) and (after.isspace() or after == "" or after in ",")
        return after != "." and (len(follows.group()) > 1 or after.isspace())
    if not body:
        return not small and not nxt.isdigit()
    if body.isdigit():
        if nxt.isdigit():
            return False
        return starter and not (small and not lower()) if nxt.isalpha() else nxt in _OPENING
    if nxt.isdigit():
        return _abbreviation(body, lang, model) is None and len(body) > 3
    initial = len(body) == 1 and body.isupper()
    closes = _abbreviation(body, lang, model)
    if small:
        if not lower():
            return False
        if closes is not None:
            return closes and starter
        return not (len(body) == 1 and body.isalpha())
    if closes is not None:
        return closes and (body, word) not in model.pairs.get(lang, ()) and not (follows and len(follows.group()) == 1 and text[follows.end() : follows.end() + 1] == ".")
    if initial:
        return starter and not text[follows.end() : follows.end() + 1] == "." if follows else False
    return True


def _abbreviation(word: str, lang: str, model: Model) -> bool | None:
    """As :meth:`Model.abbreviation`; a capital at the start of a sentence, all capitals and words after an apostrophe are tried as they would be elsewhere."""
    for form in (word, word.lower(), word[:1].upper() + word[1:].lower()):
        found = model.abbreviation(form, lang)
        if found is not None:
            return found
    return None


def split_documents(documents: DataFrame, doc_id: str, text: str, label: str, model: Model) -> DataFrame:
    """``doc_id``, ``sent_no`` from 0, ``sent_start``, ``sent_end`` of every sentence of every document."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    narrow = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(label_language(F.col(label)), F.lit("und")).alias("lang"), F.col(text).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                found = [sentence_spans(t, lang, model) for lang, t in zip(part.column("lang").to_pylist(), part.column("t").to_pylist())]
                sizes = np.fromiter(map(len, found), np.int64, len(found))
                flat = np.array([x for spans in found for x in spans], np.int64).reshape(-1, 2)
                ids = np.repeat(part.column("doc_id").to_numpy(zero_copy_only=False), sizes)
                number = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                columns = [pa.array(ids), pa.array(number.astype(np.int32)), pa.array(np.ascontiguousarray(flat[:, 0])), pa.array(np.ascontiguousarray(flat[:, 1]))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "sent_no", "sent_start", "sent_end"])

    return narrow.mapInArrow(run, "doc_id bigint, sent_no int, sent_start bigint, sent_end bigint")
