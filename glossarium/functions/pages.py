"""Extraction from crawled dictionary pages with the standard library's HTML parser, in Arrow batches.

Pages become a small tree of elements; fields are then read by class names. Two shapes of page are known: entries
with sense blocks and entries that list definition blocks directly.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MAIN_SOURCE = "main learner's dictionary"


class Node:
    """An element with its classes, attributes, children (elements and texts) and parent."""

    __slots__ = ("tag", "attrs", "classes", "children", "parent", "place")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None, place: int) -> None:
        self.tag, self.attrs, self.parent, self.place = tag, attrs, parent, place
        self.classes = frozenset((attrs.get("class") or "").split())
        self.children: list[Node | str] = []

    def walk(self) -> Iterator[Node]:
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            node = stack.pop()
            yield node
            stack += [c for c in reversed(node.children) if isinstance(c, Node)]

    def strings(self) -> Iterator[str]:
        stack: list[Node | str] = list(reversed(self.children))
        while stack:
            c = stack.pop()
            if isinstance(c, str):
                yield c
            else:
                stack += list(reversed(c.children))

    def raw(self) -> str:
        return "".join(self.strings()).strip()

    def text(self) -> str:
        """Stripped strings joined by blanks."""
        return " ".join(s for part in self.strings() if (s := part.strip()))

    def all(self, *classes: str, tag: str | None = None, where: Callable[[Node], bool] | None = None) -> list[Node]:
        """Elements below that have all the classes."""
        want = frozenset(classes)
        return [n for n in self.walk() if want <= n.classes and (tag is None or n.tag == tag) and (where is None or where(n))]

    def first(self, *options: tuple[str, ...]) -> Node | None:
        """The first element below, in page order, that has all the classes of one of the options."""
        wants = [frozenset(o) for o in options]
        return next((n for n in self.walk() if any(w <= n.classes for w in wants)), None)

    def up(self, *classes: str) -> Node | None:
        node = self.parent
        while node is not None and not node.classes.intersection(classes):
            node = node.parent
        return node


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.count = 0
        self.root = self.at = Node("", {}, None, 0)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.count += 1
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at, self.count)
        self.at.children.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.at = self.at.parent or self.root

    def handle_endtag(self, tag: str) -> None:
        node = self.at
        while node.parent is not None and node.tag != tag:
            node = node.parent
        if node.parent is not None:
            self.at = node.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def tree(html: str | None) -> Node:
    parser = _Tree()
    parser.feed(html or "")
    parser.close()
    return parser.root


def _text(node: Node | None) -> str:
    return node.text() if node is not None else ""


def _under(node: Node, outer: tuple[str, ...], inner: tuple[str, ...]) -> Node | None:
    """The first element with the inner classes inside one with the outer classes."""
    for box in node.all(*outer):
        found = box.first(inner)
        if found is not None:
            return found
    return None


def _grammar(box: Node | None) -> str:
    if box is None:
        return ""
    codes = box.all("gc", "dgc")
    return f"[ {' '.join(c.text() for c in codes)} ]" if codes else box.text()


def _sound(block: Node, region: str) -> str:
    for box in block.all(region, "dpron-i"):
        for player in box.all("daud"):
            sources = player.all(tag="source")
            best = next((s for s in sources if s.attrs.get("type") == "audio/mpeg"), sources[0] if sources else None)
            if best is not None:
                src = best.attrs.get("src", "")
                return f"https:{src}" if src.startswith("//") else src
    return ""


def _link_slug(href: str) -> str:
    return href.split("?")[0].rstrip("/").rsplit("/", 1)[-1]


def _thesaurus(box: Node, antonym: Callable[[Node], bool]) -> list[dict]:
    links = box.all(tag="a", where=lambda a: "/thesaurus/" in a.attrs.get("href", "") and "articles" not in a.attrs["href"])
    return [{"synonym": a.raw(), "slug": _link_slug(a.attrs["href"]), "is_antonym": int(antonym(a))} for a in links]


def _heading_says_opposite(root: Node, link: Node) -> bool:
    """Whether the element before a link, of the kinds that hold headings, speaks of opposites."""
    before = [n for n in root.walk() if n.place < link.place and n.tag in ("span", "div", "h3", "h4")]
    return bool(before) and any(w in before[-1].raw().lower() for w in ("opposite", "antonym"))


def _inflections(block: Node) -> list[dict]:
    def whole(form: str) -> bool:
        return bool(form) and not (form.startswith("-") and form.endswith("-"))

    groups = [g for g in block.walk() if ("inf-group" in g.classes and g.up("irreg-infls")) or ("dinfg" in g.classes and g.up("dinfls"))]
    if groups:
        found = [(_text(g.first(("lab",), ("inf-lab",))), _text(g.first(("inf",)))) for g in groups]
    else:
        found = [("", n.text()) for n in block.all("inf") if n.up("irreg-infls", "dinfls")]
    return [{"form_type": t, "inflected_form": f} for t, f in found if whole(f)]


def _sense(root: Node, block: Node, guideword: str, order: int) -> dict | None:
    definition = _text(block.first(("def", "ddef_d"))).rstrip(":").strip()
    if not definition:
        return None
    phrase = block.up("phrase-block") or block.up("idiom-block")
    title = phrase.first(("phrase-title",), ("di-title",)) if phrase is not None else None
    labels = [u.text() for box in block.all("lab", "dlab") for u in box.all("usage", "dusage")]
    examples = [{"text": eg.text(), "collocation": _text(box.first(("lu", "dlu"))), "is_extra": 0} for box in block.all("examp", "dexamp") if (eg := box.first(("eg", "deg"))) is not None]
    return {
        "sense_order": order,
        "guideword": guideword,
        "definition": definition,
        "cefr_level": _text(block.first(("epp-xref",))),
        "grammar": _grammar(_under(block, ("ddef_h",), ("gram", "dgram"))),
        "domain": _text(block.first(("domain", "ddomain"))),
        "labels": [label for label in labels if label],
        "phrase_title": title.raw() if title is not None else None,
        "synonyms": _thesaurus(block, lambda a: _heading_says_opposite(root, a)),
        "examples": examples,
    }


def _extras(sense_block: Node, sense: dict) -> None:
    """Thesaurus links and further examples from the folded boxes of a sense block."""
    seen = {e["text"] for e in sense["examples"]}
    for box in sense_block.all("daccord"):
        if "smartt" in box.classes:
            continue
        head = box.first(("daccord_lt",))
        title = head.raw().lower() if head is not None else ""
        if any(w in title for w in ("thesaurus", "synonym", "opposite")):
            opposite = "opposite" in title or "antonym" in title
            sense["synonyms"] += _thesaurus(box, lambda _, o=opposite: o)
            continue
        for item in box.all("eg", "dexamp", "hax", tag="li"):
            text = item.text()
            if text and text not in seen:
                seen.add(text)
                sense["examples"].append({"text": text, "collocation": "", "is_extra": 1})


def _senses(root: Node, block: Node) -> list[dict]:
    out: list[dict] = []
    boxes = block.all("dsense")
    for box in boxes or [block]:
        guideword = _text(box.first(("guideword", "dsense_gw"))).strip("()") if boxes else ""
        for part in box.all("ddef_block"):
            sense = _sense(root, part, guideword, len(out))
            if sense is not None:
                if boxes:
                    _extras(box, sense)
                out.append(sense)
    return out


def _source(block: Node, headword: str) -> str:
    home = block if "dictionary" in block.classes else block.up("dictionary")
    head = next((n for n in home.walk() if (n.tag == "h2" and "c_hh" in n.classes) or "di-title" in n.classes), None) if home is not None else None
    if head is None:
        return ""
    return MAIN_SOURCE if head.raw().lower() == headword.lower() else head.raw()


def _dictionary_slugs(box: Node) -> list[str]:
    found = [re.search(r"/dictionary/english/([^?\s]+)", a.attrs.get("href", "")) for a in box.all(tag="a")]
    return [m.group(1).strip() for m in found if m]


def _topics(root: Node) -> list[dict]:
    out = []
    for box in root.all("smartt", "daccord"):
        link = next((a for head in box.all("daccord_lt") for a in head.all(tag="a")), None)
        if link is None:
            continue
        url = link.attrs.get("href", "").strip()
        m = re.search(r"/topics/[^/]+/([^/?]+)/?", url) or re.search(r"/([^/?]+)/?$", url)
        related = [s for body in box.all("daccord_lb") for s in _dictionary_slugs(body)]
        out.append({"slug": m.group(1) if m else url, "title": link.text(), "url": url, "related_slugs": related})
    return out


def parse_page(html: str | None) -> list[dict]:
    """Entries of a page in order; topics, further slugs and the collocation flag stand in the first one."""
    root = tree(html)
    entries = []
    for order, block in enumerate(root.all("entry-body__el") or root.all("di-body")):
        headword = _text(block.first(("hw",), ("dhw",), ("headword",)))
        entry = {
            "entry_order": order,
            "headword": headword,
            "pos": _text(block.first(("pos", "dpos"))),
            "grammar": _grammar(_under(block, ("posgram",), ("gram", "dgram"))),
            "pronunciation_uk": _text(_under(block, ("uk", "dpron-i"), ("ipa",))),
            "pronunciation_us": _text(_under(block, ("us", "dpron-i"), ("ipa",))),
            "audio_uk_url": _sound(block, "uk"),
            "audio_us_url": _sound(block, "us"),
            "dictionary_source": _source(block, headword),
            "inflections": _inflections(block),
            "senses": _senses(root, block),
            "topics": [],
            "more_meanings": [],
            "has_collocations": False,
        }
        if entry["headword"] or entry["pos"] or entry["senses"]:
            entries.append(entry)
    if entries:
        entries[0]["topics"] = _topics(root)
        entries[0]["more_meanings"] = [s for box in root.all("cdo-more-results") for s in _dictionary_slugs(box)]
        entries[0]["has_collocations"] = any("/collocation/" in a.attrs.get("href", "") for a in root.all(tag="a"))
    return entries


def parse_collocations(html: str | None) -> list[dict]:
    """Collocation, example and source of each box of a collocation page."""
    out = []
    for box in tree(html).all("eg", "lbb", "lb-cm", "lpt-10", tag="div"):
        link = next(iter(box.all("hdib", "tb", "lmb-10", tag="a")), None)
        if link is None:
            continue
        example = next(iter(box.all("dexamp", tag="div")), None)
        exact, loose = box.first(("dsource_e",)), box.first(("dsource",))
        source = exact.raw() if exact is not None else ""
        if not source and loose is not None:
            source = loose.raw().replace("From", "").replace("the", "").strip()
        out.append({"collocation": link.raw(), "example": example.raw() if example is not None else "", "source": source})
    return out


ENTRY = (
    "array<struct<entry_order:int,headword:string,pos:string,grammar:string,pronunciation_uk:string,pronunciation_us:string,audio_uk_url:string,audio_us_url:string,dictionary_source:string,"
    "inflections:array<struct<form_type:string,inflected_form:string>>,"
    "senses:array<struct<sense_order:int,guideword:string,definition:string,cefr_level:string,grammar:string,domain:string,labels:array<string>,phrase_title:string,"
    "synonyms:array<struct<synonym:string,slug:string,is_antonym:int>>,examples:array<struct<text:string,collocation:string,is_extra:int>>>>,"
    "topics:array<struct<slug:string,title:string,url:string,related_slugs:array<string>>>,more_meanings:array<string>,has_collocations:boolean>>"
)
COLLOCATION = "array<struct<collocation:string,example:string,source:string>>"


def parse_page_column(html: str | Column) -> Column:
    """Entries of each page, as nested arrays to be exploded."""

    def parse(pages: pd.Series) -> pd.Series:
        return pages.map(parse_page)

    return F.pandas_udf(parse, ENTRY)(html)


def parse_collocations_column(html: str | Column) -> Column:
    def parse(pages: pd.Series) -> pd.Series:
        return pages.map(parse_collocations)

    return F.pandas_udf(parse, COLLOCATION)(html)


def links(html: str | Column, pattern: str, base: str = "") -> Column:
    """array<string>: distinct link targets matching a pattern with one group, in page order, relative ones made absolute."""
    found = F.regexp_extract_all(html, F.lit(pattern), 1)
    return F.array_distinct(F.transform(found, lambda u: F.when(u.startswith("/"), F.concat(F.lit(base), u)).otherwise(u)))


def deep_links(urls: Column, parts: int = 7) -> Column:
    """Those of at least so many parts between slashes, without the trailing one."""
    return F.filter(urls, lambda u: F.size(F.split(F.regexp_replace(u, "/+$", ""), "/")) >= parts)


def entry_links(html: str | Column) -> Column:
    """array<struct<slug, title>> of a list page, the first title of each slug."""
    pattern = r'href="/dictionary/english/([^"]+)"[^>]*title="([^"]*)"'
    slugs, titles = F.regexp_extract_all(html, F.lit(pattern), 1), F.regexp_extract_all(html, F.lit(pattern), 2)
    pairs = F.zip_with(slugs, titles, lambda s, t: F.struct(F.trim(s).alias("slug"), F.trim(t).alias("title")))
    firsts = F.filter(pairs, lambda p, i: F.array_position(F.transform(pairs, lambda q: q["slug"]), p["slug"]) == i + 1)
    return F.filter(firsts, lambda p: p["slug"] != "")
