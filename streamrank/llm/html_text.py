"""Main text of web pages by maximum-scoring subsequence.

A page is a sequence of words, which score positive, and tags, which score negative.
The weights are learned from labelled pages: those that declare their main part
themselves (``article``, ``main``, a content class), whose tokens inside are compared
with those outside. One linear scan finds the contiguous run of blocks with the
highest score. A declaration adds to the score where it holds a fair share of the page's
words. Menus, footers and the like are skipped as whole elements by tag or role, unless
an article or main part begins in them; the words of elements named like notices,
comments or forms score negative, unless such an element wraps the page's text.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import mapped, table

# Names of HTML elements and words that pages use in class and id names.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table "
    "tbody td tfoot th thead tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style title textarea noscript template iframe svg math canvas audio video object".split())
SKIPPED_TAGS = frozenset("nav header footer aside button select menu dialog label".split())
#: Elements that may wrap a whole page: like those with a name in ``SKIPPED_WORDS`` they score negative.
NEGATIVE_TAGS = frozenset(["form", "fieldset"])
#: Elements of text, which no name makes negative inside a declared part.
TEXT_TAGS = frozenset("h1 h2 h3 h4 h5 h6 section p blockquote pre table ul ol dl figure".split())
HEADING_TAGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PROSE_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre".split())
SKIPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
SKIPPED_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored sponsors promo promotion "
    "nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager header masthead topbar footer "
    "colophon copyright sidebar aside rail widget widgets cookie cookies consent gdpr notice notices popup modal "
    "overlay newsletter subscribe subscription signup login register share sharing social related recommended "
    "recommendations trending comment comments commentlist disqus respond reply replies discussion form search "
    "searchform toolbar skip hidden".split())
#: Names made of these alone, one of the first at least, speak against an element wherever it stands.
STRONG_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored sponsors promo promotion "
    "comment comments commentlist disqus respond reply replies cookie cookies consent gdpr newsletter subscribe "
    "subscription signup login related recommended recommendations trending share sharing social popup modal "
    "overlay widget widgets".split())
FILLER_WORDS = frozenset(
    "list lists box area section wrapper wrap container block item items thread panel bar notice notices form "
    "posts articles stories links buttons inner outer".split())
#: Block elements that end an open paragraph or item of their kind, and elements beyond which none is ended.
CLOSING_TAGS = frozenset("p li dt dd tr td th div".split())
FENCE_TAGS = frozenset("ul ol dl table div article section main body".split())
CONTENT_WORDS = frozenset("article content main post entry story body text maincontent articlebody".split())
TURNED_OFF = frozenset("with has no without".split())

_TOKEN = re.compile(
    r"<!--(?P<comment>.*?)(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/<>]*+)(?P<rest>(?:\"[^\"]*+\"|'[^']*+'|[^'\"<>])*+)>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

#: Words and tags that no labelled page has shown.
PLAIN_WORD, LINK_WORD, UNKNOWN_TAG = 1.0, 0.1, -1.0
#: The least that a word counts, and the most that a tag does.
LEAST_WORD, LIGHTEST_TAG = 0.01, -0.01
#: The share of a page's words that a declaration must hold to count.
BELIEVED = 0.3
#: What a declaration adds for a block and for each word in it, and what words beside it keep.
BLOCK_BONUS, WORD_BONUS, BESIDE = 24.0, 2.0, 0.1
#: What a word of a negative element costs.
NEGATIVE_WORD = -1.0


def name_words(value: str) -> Iterator[list[str]]:
    """The words of each class or id name in ``value``."""
    for name in value.split():
        yield [w.lower() for w in _NAME_PART.findall(name)]


def attributes(rest: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(rest)} if rest.strip("/ ") else {}


def is_skipped(tag: str, attrs: dict[str, str], declared: bool) -> bool:
    """Whether an element is no part of any article. A header in an article is."""
    if tag in ("html", "body", "main"):
        return False
    if tag in SKIPPED_TAGS and not (tag == "header" and declared):
        return True
    if not attrs:
        return False
    if attrs.get("role", "").lower() in SKIPPED_ROLES:
        return True
    return is_hidden(attrs)


def is_hidden(attrs: dict[str, str]) -> bool:
    return ("hidden" in attrs or attrs.get("aria-hidden") == "true"
            or "display:none" in attrs.get("style", "").replace(" ", "").lower())


def is_negative(tag: str, attrs: dict[str, str], declared: bool) -> int:
    """How much an element's tag or names speak against its being text: 2 clearly, 1 somewhat, 0 not."""
    if tag in ("html", "body", "main"):
        return 0
    found = int(tag in NEGATIVE_TAGS)
    for key in ("class", "id"):
        for words in name_words(attrs.get(key, "")):
            if not words or words[0] in TURNED_OFF or SKIPPED_WORDS.isdisjoint(words) or (
                    declared and tag.startswith("h") and "header" in words):
                continue
            strong = not STRONG_WORDS.isdisjoint(words) and all(w in STRONG_WORDS or w in FILLER_WORDS for w in words)
            found = max(found, 2 if strong and tag not in HEADING_TAGS else 1)
    return found


def declares(tag: str, attrs: dict[str, str]) -> int:
    """How clearly an element says that it is the main part: 3 article, 2 main, 1 by its name, 0 not."""
    if tag == "article" or attrs.get("itemprop") == "articleBody":
        return 3
    if tag == "main" or attrs.get("role") == "main":
        return 2
    if tag in ("div", "section", "td"):
        return int(any(words and CONTENT_WORDS.issuperset(words)
                       for key in ("class", "id") for words in name_words(attrs.get(key, ""))))
    return 0


@dataclass
class Doubt:
    """An open element whose tag or name speaks against it, and what is in it."""

    tag: str
    inside: bool  # a declared part
    strong: bool
    around: Doubt | None
    wraps: bool = False  # a declared part, or most of a page's words
    n: int = 0
    prose: int = 0
    most: bool = False
    against: bool = False

    def holds(self, declared: bool) -> bool:
        """Whether its words count against it, on a page with an article or main part or without.

        A clear name always does, unless it wraps the declared part; a form does that
        does not hold most of the page; others are outweighed by text, where a declared
        part has them.
        """
        if self.wraps:
            return False
        if self.strong:
            return True
        if self.most and (not declared or self.tag in NEGATIVE_TAGS):
            return False
        return not self.inside or self.tag in NEGATIVE_TAGS or self.tag not in TEXT_TAGS and 2 * self.prose <= self.n


@dataclass
class Block:
    """A run of text between two block boundaries, and the tags since the one before."""

    parts: list[str] = field(default_factory=list)
    words: Counter = field(default_factory=Counter)
    tags: list[str] = field(default_factory=list)
    levels: frozenset[int] = frozenset()
    doubt: Doubt | None = None  # the innermost

    def negative(self) -> bool:
        return self.doubt is not None and self.doubt.against

    def size(self) -> int:
        return self.words.total()

    def text(self) -> str:
        return " ".join(html.unescape("".join(self.parts)).split())


@dataclass(frozen=True)
class Open:
    """An open element, with what holds inside it, so that no look at the others is needed."""

    tag: str = ""
    level: int = 0
    levels: frozenset[int] = frozenset()
    doubt: Doubt | None = None
    context: str = ""  # the innermost block element
    near: dict[str, int] = field(default_factory=dict)  # places of paragraphs and items that a block may end


class Stack:
    """The open elements. Every step costs the same however deep they are, or closes what it passes."""

    def __init__(self) -> None:
        self.elements = [Open()]
        self.counts: Counter = Counter()

    @property
    def top(self) -> Open:
        return self.elements[-1]

    def push(self, tag: str, kind: int, doubt: Doubt | None) -> None:
        top, place = self.top, len(self.elements)
        near = {} if tag in FENCE_TAGS else {**top.near, tag: place} if tag in CLOSING_TAGS else top.near
        self.elements.append(Open(
            tag, max(top.level, kind), top.levels | {kind} if kind else top.levels, doubt or top.doubt,
            tag if tag in BLOCK_TAGS else top.context, near))
        self.counts[tag] += 1

    def cut(self, place: int) -> None:
        for element in self.elements[place:]:
            self.counts[element.tag] -= 1
        del self.elements[place:]

    def close(self, tag: str) -> None:
        if self.counts[tag]:
            while self.top.tag != tag:
                self.cut(len(self.elements) - 1)
            self.cut(len(self.elements) - 1)

    def close_items(self, tag: str) -> None:
        """A block closes an open paragraph, and an item the item before it."""
        places = [self.top.near[t] for t in {"p", tag} if t in self.top.near]
        if places:
            self.cut(max(places))

    def in_link(self) -> bool:
        return any(e.tag == "a" for e in self.elements[-4:])


def blocks_of(page: str | None, keep_skipped: bool = False) -> list[Block]:
    """The page's blocks in order, skipped elements left out unless asked for."""
    blocks, current = [], Block()
    stack, doubts = Stack(), []
    skipping, hidden, depth, at = "", False, 0, 0
    page = page or ""

    def ended() -> None:
        nonlocal current
        if any(not p.isspace() for p in current.parts):
            current.levels, current.doubt = stack.top.levels, stack.top.doubt
            if current.doubt:
                current.doubt.n += current.size()
                current.doubt.prose += sum(n for kind, n in current.words.items() if kind in PROSE_TAGS)
            blocks.append(current)
            current = Block()
        else:
            current.parts.clear()

    def said(text: str) -> None:
        if text and not skipping:
            current.parts.append(text)
            current.words["a" if stack.in_link() else stack.top.context] += len(text.split())

    while at < len(page):
        found = _TOKEN.search(page, at)
        if not found:
            said(page[at:])
            break
        said(page[at:found.start()])
        at = found.end()
        tag = (found["tag"] or "").lower()
        if not tag:
            continue
        if found["close"]:
            if skipping:
                if tag == skipping:
                    depth -= 1
                elif skipping == "p" and tag in BLOCK_TAGS or tag in ("body", "html"):
                    depth = 0
                if depth > 0:
                    continue
                if tag == skipping:
                    skipping = ""
                    continue
                skipping = ""
            if tag in BLOCK_TAGS:
                ended()
            current.tags.append(tag)
            stack.close(tag)
            continue
        if tag in RAW_TAGS:
            if not found["rest"].endswith("/"):
                closed = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = closed.end() if closed else len(page)
            continue
        attrs = attributes(found["rest"])
        if skipping:
            ends = skipping == "p" and tag in BLOCK_TAGS or not hidden and (tag == "main" or tag == "article" and not (
                is_skipped(tag, attrs, False) or is_negative(tag, attrs, False)))
            if not ends:
                depth += tag == skipping
                continue
            skipping = ""
        if tag in BLOCK_TAGS:
            ended()
            if tag in CLOSING_TAGS:
                stack.close_items(tag)
        if not keep_skipped and tag not in VOID_TAGS and is_skipped(tag, attrs, stack.top.level > 0):
            ended() if tag in BLOCK_TAGS else None
            skipping, hidden, depth = tag, is_hidden(attrs), 1
            current.tags.append(tag)
            continue
        if tag == "br":
            current.parts.append(" ")
        if tag not in VOID_TAGS and not found["rest"].endswith("/"):
            doubt, kind = None, declares(tag, attrs)
            against = is_negative(tag, attrs, stack.top.level > 0)
            if against == 2 or against and kind < 2:
                doubt, kind = Doubt(tag, stack.top.level > 0, against == 2, stack.top.doubt), 0
                doubts.append(doubt)
            elif kind > 1 and stack.top.doubt:
                stack.top.doubt.wraps = True
            stack.push(tag, kind, doubt)
        current.tags.append(tag)
    ended()
    weigh(doubts, blocks)
    return blocks


def weigh(doubts: list[Doubt], blocks: list[Block]) -> None:
    """Decides of each doubtful element whether it counts against its words; outer ones come first."""
    for doubt in reversed(doubts):
        if doubt.around:
            doubt.around.n += doubt.n
            doubt.around.prose += doubt.prose
            doubt.around.wraps |= doubt.wraps
    whole = sum(b.size() for b in blocks)
    declared = any(b.levels & {2, 3} for b in blocks)
    for doubt in doubts:
        doubt.most = 2 * doubt.n > whole
        doubt.against = doubt.holds(declared) or doubt.around is not None and doubt.around.against


def believed(blocks: list[Block]) -> int:
    """The clearest declaration that holds a fair share of the words not spoken against, 0 without one."""
    sizes = [(b.levels, b.size()) for b in blocks if not b.negative()]
    whole = sum(n for _, n in sizes)
    held = {kind: sum(n for levels, n in sizes if kind in levels) for kind in (3, 2, 1)}
    most = max(held.values())
    return next((kind for kind, n in held.items() if n and n >= BELIEVED * whole and 2 * n >= most), 0)


@dataclass(frozen=True)
class HtmlModel:
    """Learned weights of words, by the tag around them, and of tags."""

    words: dict[str, float]
    tags: dict[str, float]

    def score(self, block: Block, main: int, negative: bool = False) -> tuple[float, float]:
        """What the words of a block add and the tags before it cost.

        ``main`` is the declaration that is believed on the page, which adds a bonus
        inside and lets words beside it count less.
        """
        cost = sum(self.tags.get(t, UNKNOWN_TAG) for t in block.tags)
        if negative:
            return NEGATIVE_WORD * max(1, block.size()), cost
        words = sum(n * self.words.get(kind, LINK_WORD if kind == "a" else PLAIN_WORD)
                    for kind, n in block.words.items())
        if main and main in block.levels:
            return words + WORD_BONUS * block.size() + BLOCK_BONUS, cost
        return BESIDE * words if main else words, cost

    def extract(self, page: str | None) -> str:
        """The text of the best contiguous run of blocks, one to a line."""
        blocks = blocks_of(page)
        main, against = believed(blocks), [b.negative() for b in blocks]
        best, start, end = 0.0, 0, 0
        total, since = 0.0, 0
        for i, block in enumerate(blocks):
            gain, cost = self.score(block, main, against[i])
            if total + cost <= 0:
                total, since = 0.0, i
            else:
                total += cost
            total = max(0.0, total + gain)
            if total > best:
                best, start, end = total, since, i + 1
        # Amid the run, what scores negative by itself is a break in the text, no part of it.
        chosen = [b for b, no in zip(blocks[start:end], against[start:end]) if not no]
        return "\n".join(filter(None, (b.text() for b in chosen)))


def _counted(batch: dict[str, list]) -> Iterable[dict]:
    counts: Counter = Counter()
    known = BLOCK_TAGS | VOID_TAGS | frozenset("a b i em strong span small u code sub sup font label button".split())
    for page in batch["html"]:
        blocks = blocks_of(page, keep_skipped=True)
        main = believed(blocks)
        if not main:
            continue
        for block in blocks:
            inside = main in block.levels
            for kind, n in block.words.items():
                counts["word", kind, inside] += n
            for tag in block.tags:
                counts["tag", tag if tag in known else "other", inside] += 1
    yield {"kind": [k for k, _, _ in counts], "name": [n for _, n, _ in counts],
           "inside": [i for _, _, i in counts], "n": list(counts.values())}


def train_html(pages: DataFrame) -> HtmlModel:
    """Learns the weights from all ``pages`` (html) that declare their main part.

    Tags are counted under their names, others than HTML's under one, so the number
    of counts that reach the driver does not depend on the pages.
    """
    rows = mapped(pages.select("html"), "kind string, name string, inside boolean, n long", _counted).groupBy(
        "kind", "name", "inside").agg(F.sum("n").alias("n")).collect()
    n = {(r["kind"], r["name"], r["inside"]): r["n"] for r in rows}
    odds = {(k, name): math.log((n.get((k, name, True), 0) + 1) / (n.get((k, name, False), 0) + 1))
            for k, name, _ in n}
    return HtmlModel(
        {name: min(3.0, max(LEAST_WORD, w)) for (k, name), w in odds.items() if k == "word"},
        {name: max(-3.0, min(LIGHTEST_TAG, w - 1.0)) for (k, name), w in odds.items() if k == "tag"})


def _extracted(batch: dict[str, list], model: HtmlModel) -> Iterable[dict]:
    texts = [model.extract(page) for page in batch["html"]]
    yield {"page_id": batch["page_id"], "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts]}


def extract_text(pages: DataFrame, model: HtmlModel) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row of ``pages``.

    Null or empty pages, and pages without a scoring word, have an empty text; an empty
    table gives no rows. Long pages take time in proportion to their length, however
    they are nested. Repeated rows give repeated results; other columns are left out.
    """
    return mapped(pages.select("page_id", "url", "html"), "page_id long, url string, text string, n_chars long",
                  _extracted, model)


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf_dir, "pages")
    return extract_text(pages, train_html(pages))
