"""Lists of members from saved pages, and members' votes from roll-call XML: parsing that built-in readers cannot do, one page or document at a time."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordia.config import POSITION_WORDS
from concordia.functions.text import person_key

_CARDS = {"article", "li", "div"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
MEMBER = "full_name string, country string, country_name string, group string, group_full string, national_party string, source_url string"


class _Page(HTMLParser):
    """The cards of a page in the order they begin, each with its text and first link, and all text of the page."""

    def __init__(self, html: str):
        super().__init__()
        self.cards: list[dict] = []
        self.texts: list[str] = []
        self.open: list[tuple[str, dict | None]] = []
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        if tag in _VOID:
            return
        card = None
        if tag in _CARDS:
            card = {"text": [], "href": None, "name": []}
            self.cards.append(card)
        elif tag == "a" and (href := dict(attrs).get("href")) is not None:
            card = {"first_of": [c for t, c in self.open if t in _CARDS and c["href"] is None]}
            for c in card["first_of"]:
                c["href"] = href
        self.open.append((tag, card))

    def handle_endtag(self, tag):
        at = next((i for i in range(len(self.open) - 1, -1, -1) if self.open[i][0] == tag), None)
        if at is not None:
            del self.open[at:]

    def handle_data(self, data):
        text = " ".join(data.split())
        if not text:
            return
        self.texts.append(text)
        for tag, card in self.open:
            if tag in _CARDS:
                card["text"].append(text)
            elif tag == "a" and card:
                for c in card["first_of"]:
                    c["name"].append(text)


def _cards(page: _Page, base: str, mark: str, countries: dict[str, str], groups: dict[str, str]) -> Iterator[dict]:
    for card in page.cards:
        text, name = " ".join(card["text"]), " ".join(card["name"])
        country, group = next((c for c in countries if c in text), None), next((g for g in groups if g in text), None)
        if name and country and group and mark in (card["href"] or ""):
            yield {"full_name": name, "country_name": country, "group_full": group, "national_party": text.split(country, 1)[1].strip(), "source_url": urljoin(base, card["href"])}


def _lines(page: _Page, countries: dict[str, str], groups: dict[str, str]) -> Iterator[dict]:
    """What a page of plain lines gives: name, then group, then country on a line; of names that contain each other the longest counts."""
    longest = lambda names: sorted(names, key=len, reverse=True)
    for line in page.texts:
        group, country = next((g for g in longest(groups) if g in line), None), next((c for c in longest(countries) if c in line), None)
        name = line.split(group)[0].strip() if group and country else ""
        if len(name.split()) >= 2 and "Group" not in name and "Members" not in name:
            yield {"full_name": name, "country_name": country, "group_full": group, "national_party": line.split(country, 1)[1].strip(), "source_url": ""}


def member_records(html: str, base: str, countries: dict[str, str], groups: dict[str, str], mark: str = "/meps/en/", least: int = 100) -> list[dict]:
    """Members of a page, sorted by country and name: from its cards, or from its lines where these give fewer than ``least``. Of repeated members the first on the page counts.

    ``countries``: name -> code, ``groups``: full name -> short name; of several names contained in a card the first of these counts.
    """
    page = _Page(html)

    def distinct(found: Iterator[dict]) -> list[dict]:
        seen: dict[tuple, dict] = {}
        for r in found:
            r |= {"country": countries.get(r["country_name"], ""), "group": groups.get(r["group_full"], r["group_full"])}
            seen.setdefault((r["full_name"], r["country"], r["group"]), r)
        return list(seen.values())

    out = distinct(_cards(page, base, mark, countries, groups))
    if len(out) < least:
        out = distinct(_lines(page, countries, groups))
    return sorted(out, key=lambda r: (r["country"], r["full_name"]))


def members_from_html(pages: DataFrame, base: str, countries: dict[str, str], groups: dict[str, str], **options) -> DataFrame:
    """:func:`member_records` of each page in a column ``html``; null pages have none."""
    columns = [f.split()[0] for f in MEMBER.split(", ")]

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame([r for html in frame["html"] if html for r in member_records(html, base, countries, groups, **options)], columns=columns)

    return pages.select("html").mapInPandas(parse, MEMBER)


# roll-call XML

# Tags (without separators of their names) that hold one vote, and tags and attributes that hold its parts.
VOTE_TAGS = {"rollcallvoteresult", "rollcallvote.result", "roll-call-vote", "vote", "voting", "rcv", "rollcall", "result"}
SECTION_TAGS = {"for", "against", "abstention", "abstain"}
NAME_ATTRIBUTES = ["name", "fullname", "fullName", "mepname", "membername", "persname"]


def _label(text: str) -> str | None:
    low = " ".join(text.split()).lower()
    return next((k for k, words in POSITION_WORDS.items() if any(w in low for w in words)), None)


def vote_candidates(xml: str) -> Iterator[tuple[int, str, str, str, str]]:
    """(block, name as written, match key, vote, tag) in document order. A block is an element that holds one vote, or the whole document where there is none.

    What an element's tag, text and attributes say is its vote, else what the last section said; the first of its name attributes and its text that
    has two words and five characters as a key is the name. Malformed documents have none.
    """
    try:
        root = ET.fromstring(xml)
    except (ET.ParseError, TypeError):
        return
    bare = lambda e: e.tag.rsplit("}", 1)[-1].lower()
    for number, block in enumerate([e for e in root.iter() if bare(e) in VOTE_TAGS] or [root], 1):
        section = None
        for e in block.iter():
            tag, text = bare(e), " ".join(e.itertext()).strip()
            vote = _label(" ".join([tag, text, *[f"{k}={v}" for k, v in e.attrib.items()]]))
            if tag in SECTION_TAGS and vote:
                section = vote
                continue
            vote = vote or section
            names = [e.attrib[a].strip() for a in NAME_ATTRIBUTES if a in e.attrib] + ([text] if text else [])
            found = next(((n, k) for n in names if len((k := person_key(n)).split()) >= 2 and len(k) >= 5), None)
            if vote and found:
                yield number, *found, vote, tag


def name_candidates(documents: DataFrame, most: int | None = None) -> DataFrame:
    """:func:`vote_candidates` of a column ``xml``, as ``block``, ``name``, ``key``, ``vote``, ``tag``; of the same key and vote in a document the first; at most ``most`` of a document, where a look at it is all that is wanted."""

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out: list[tuple] = []
            for xml in frame["xml"]:
                seen: dict[tuple[str, str], tuple] = {}
                for row in vote_candidates(xml):
                    seen.setdefault((row[2], row[3]), row)
                out += list(seen.values())[:most]
            yield pd.DataFrame(out, columns=["block", "name", "key", "vote", "tag"])

    return documents.select("xml").mapInPandas(walk, "block int, name string, key string, vote string, tag string")


def match_members(names: DataFrame, members: DataFrame) -> DataFrame:
    """Names left-joined to members by match key; of members with the same key the first by full name counts."""
    from concordia.functions.text import person_name

    keyed = members.withColumn("key", person_name(F.col("full_name"))).groupBy("key").agg(F.min_by(F.struct("full_name", "country_code", "group_short"), "full_name").alias("m"))
    return names.join(keyed, "key", "left").select(*names.columns, "m.full_name", "m.country_code", "m.group_short")
