"""Main text of web pages by scoring the element tree.

Every paragraph earns points for its length and commas and passes them to its ancestors, less with each level;
a container's points are discounted by the share of its text that is links. The best container is the article;
where it is part of an <article> or <main>, that whole element is. Siblings are kept with it: those that score well
enough themselves, and headings and text with few links.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from .arrow import Sender, arrow_schema, fields, map_batches

TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*+>?|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*+)"
    r"(?P<attributes>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+(?:>|\Z))", re.S)
#: Any attribute: what is quoted belongs to its name and is never one itself.
ATTRIBUTE = re.compile(r"""([^\s"'>/=]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]++))?""")
#: White space of HTML; a no-break space that a character reference stands for is text to the decoder, space to us.
BLANK = re.compile(r"\s+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Raw text: their content is no text of the page, up to their end tag.
RAW = frozenset("script style title textarea iframe noframes noembed xmp".split())
#: Elements like others whose content is not shown: pictures, what stands in for media, and a formula's source next to it.
UNSHOWN = frozenset("svg object canvas audio video template noscript annotation annotation-xml".split())
#: Of these one cannot be in another.
UNNESTED = frozenset("canvas audio video noscript annotation annotation-xml".split())
UNSHOWN_TAG = {tag: re.compile(rf"<(/?){tag}(?=[\s/>])", re.I) for tag in UNSHOWN}
#: Inside these a tag that ends in "/>" has no content.
FOREIGN = ("svg", "math")
RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I) for tag in RAW}
#: Whole elements that are never the article.
CHROME = frozenset("nav header footer aside form button select option menu dialog fieldset label datalist".split())
CHROME_ROLE = frozenset("navigation banner contentinfo complementary search form menu menubar toolbar dialog alert "
                        "alertdialog tablist".split())
#: Words of class names and ids that mark such elements.
CHROME_WORD = frozenset(
    "ad ads adv advert advertisement advertising advertorial sponsor sponsored promo promotion banner menu nav "
    "navbar navigation topnav subnav sidebar sidenav rail footer header masthead comment comments commentlist disqus "
    "respond reply replies discussion notice notices cookie cookies consent gdpr newsletter subscribe subscription "
    "signup login popup modal overlay breadcrumb breadcrumbs share sharing social related recommended "
    "recommendations pagination pager toolbar widget widgets skip alert outbrain taboola".split())
#: Those that can also name a part of an article: inside one they count only with links or form fields to agree.
DOUBTFUL_WORD = frozenset(
    "promotion banner menu nav navigation rail footer header comment discussion notice notices respond reply replies "
    "related recommended recommendations share sharing social overlay subscription login toolbar widget widgets skip "
    "alert".split())
#: Names of these alone, or with something behind them for what readers write, mark blocks inside an article too.
SURE_NAME = frozenset(
    "comment comments reply replies respond notice notices alert toolbar widget widgets share sharing social login menu nav "
    "navigation banner promotion subscription skip".split())
SURE_START = ("comment-", "comments-", "comment_", "comments_", "reply-", "replies-")
#: What readers write, if more than the name says so: who and when, articles within, a heading that counts them.
TALK_WORD = frozenset("comment reply replies respond discussion".split())
WHO_WORD = frozenset("author byline user username avatar vcard commenter poster".split())
WHEN_WORD = frozenset("date datetime time timestamp posted published".split())
WHO, WHEN, ARTICLE, COUNTED = 1, 2, 4, 8
TALK_HEADING = re.compile(
    r"\W*(?:[\d.,]+\s+)?(?:reader\s+)?(?:comments?|repl(?:y|ies)|responses?)\W*\d*\W*|"
    r"(?:leave|post|add|write)\s+(?:a|your)\s+(?:comment|reply)\W*|join\s+the\s+(?:discussion|conversation)\W*", re.I)
#: Without one of these at the end of something, short text of a doubtful name is a label or a notice.
SENTENCE = re.compile(r"[.!?…。！？][\"'”’»)\]]*(?:\s|$)")
SHORT_BLOCK, SHORT_PARAGRAPH = 140, 50
FORM = frozenset("form input button select textarea".split())
#: Never dropped for a name: these hold the article.
TRUSTED = frozenset(["html", "body", "main", "article"])
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var math mi mn mo ms mtext mspace mrow mfrac msqrt mroot "
                   "mstyle merror mpadded mphantom mfenced menclose msub msup msubsup munder mover munderover "
                   "mmultiscripts mprescripts mtable mtr mtd semantics".split()) | VOID - {"hr"} | UNSHOWN
PARAGRAPH = frozenset("p pre li td th dt dd blockquote figcaption caption summary h1 h2 h3 h4 h5 h6".split())
#: What a start tag ends that is still open, and where the search for it stops.
ENDS = {"li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
        "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"})}
BASE_POINTS = {"article": 10, "main": 10, "div": 5, "section": 5, "pre": 3, "td": 3, "blockquote": 3, "ul": -3,
               "ol": -3, "dl": -3, "li": -3, "address": -3, "body": 0}
SCORED_FROM, LEVELS = 25, 5
SIBLING_SHARE, SIBLING_LEAST = 0.2, 10
#: Text with no larger share of links reads as text; a list of links has more.
LOW_LINKS = 1 / 3
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Of no meaning of their own: without points they are taken for text only if a heading is in them.
PLAIN = frozenset("div span center address".split()) | INLINE


class Element:
    __slots__ = ("tag", "parent", "depth", "dropped", "points", "chars", "links", "doubt", "forms", "mark", "talk", "signs",
                 "titles", "outer", "inner")

    def __init__(self, tag: str, parent: "Element | None", dropped: bool):
        self.tag, self.parent, self.dropped = tag, parent, dropped
        self.depth = parent.depth + 1 if parent else 0
        self.points: float | None = None
        self.chars = self.links = 0
        self.doubt: Element | None = parent.doubt if parent else None  # the nearest of doubtful name around it
        self.forms = self.talk = False
        self.signs = 0  # that a doubtful one, or an article within an article, holds what readers write
        # the outermost article around or at it, and the outermost in that one
        self.outer: Element | None = parent.outer if parent else None
        self.inner: Element | None = parent.inner if parent else None
        if tag == "article":
            if self.outer is None:
                self.outer = self
            elif self.inner is None:
                self.inner = self
        self.titles = False  # of what is dropped here, headings are not
        self.mark: tuple[int, int, int] | None = None  # of a doubtful inline element: blocks, texts, link text before it


def chrome(tag: str, attributes: str) -> tuple[int, frozenset]:
    """2 for menus, headers, footers, sidebars, notices, adverts, forms, comments and what is hidden, 1 for what only
    a name that parts of articles have too speaks for, 0 for others; and the words of its names."""
    if tag in CHROME:
        return 2, frozenset()
    if "=" not in attributes and "hidden" not in attributes.lower():
        return 0, frozenset()
    found, names = 0, frozenset()
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return 0 if tag in TRUSTED else 2, names
        if name == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return 2, names
        elif name == "role":
            if value in CHROME_ROLE:
                return 2, names
        elif name in ("class", "id"):
            said = frozenset(re.split(r"[^a-z]+", value))
            names |= said
            if tag in TRUSTED or tag in HEADING:
                continue
            words = CHROME_WORD & said
            if words:
                sure = tag not in INLINE and tag != "p" and any(
                    one in SURE_NAME or one.startswith(SURE_START) and tag != "section" for one in value.split())
                found = max(found, 1 if words <= DOUBTFUL_WORD and not sure else 2)
    return found, names


class Page:
    """Elements and text blocks of one page, built in one pass over its tags."""

    def __init__(self, html: str):
        self.root = self.at = Element("#page", None, False)
        self.open: dict[str, list[Element]] = {}  # by tag, outermost first
        self.articles = 0
        self.blocks: list[tuple[Element, str]] = []
        self.text: list[str] = []
        self.link_chars = 0
        self.last_end: dict[str, int] = {}
        start, size = 0, len(html)
        while start < size:
            hit = TAG.search(html, start)
            if hit is None:
                self._say(html[start:])
                break
            if hit.start() > start:
                self._say(html[start:hit.start()])
            start = hit.end()
            tag = hit["tag"]
            if tag is None:
                continue
            tag = tag.lower()
            if hit["close"]:
                self._end(tag)
            elif hit["attributes"].endswith("/>") and (tag in UNSHOWN or tag in FOREIGN or any(map(self.open.get, FOREIGN))):
                continue
            elif tag in UNSHOWN and self._unclosed(html, tag, start):
                continue
            elif tag in RAW:
                if tag in FORM and self.at.doubt:
                    self.at.doubt.forms = True
                end = RAW_END[tag].search(html, start)
                start = end.end() if end else size
            else:
                self._start(tag, hit["attributes"])
        self._flush()

    def _unclosed(self, html: str, tag: str, start: int) -> bool:
        """True if no end tag can be that of the ``tag`` before ``start``, which then holds nothing."""
        if tag not in self.last_end:
            self.last_end[tag] = max((hit.start() for hit in UNSHOWN_TAG[tag].finditer(html, start) if hit[1]), default=-1)
        return self.last_end[tag] < start or tag in UNNESTED and not UNSHOWN_TAG[tag].search(html, start)[1]

    def _say(self, text: str) -> None:
        if self.at.dropped:
            return
        self.text.append(text)
        if self.open.get("a"):
            self.link_chars += len(text)

    def _block(self) -> Element:
        element = self.at
        while element.tag in INLINE or element.dropped:
            element = element.parent
        return element

    def _flush(self) -> None:
        if self.text:
            said = BLANK.sub(" ", unescape("".join(self.text))).strip()
            if said:
                self._count(self._block(), said)
            self.text = []
        self.link_chars = 0

    def _count(self, element: Element, said: str) -> None:
        self.blocks.append((element, said))
        size, linked = len(said), min(self.link_chars, len(said))
        element.chars += size
        element.links += linked
        if size < SCORED_FROM:
            return
        points = 1 + said.count(",") + said.count("，") + min(size / 100, 3)
        points *= 1 - linked / size
        above = element.parent if element.tag in PARAGRAPH and element.parent else element
        for level in range(LEVELS):
            if above is None or above.parent is None:
                break
            if above.points is None:
                above.points = BASE_POINTS.get(above.tag, 0)
            above.points += points / (1, 2, 6, 9, 12)[level]
            above = above.parent

    def _push(self, tag: str, dropped: bool) -> None:
        self.at = Element(tag, self.at, dropped)
        self.open.setdefault(tag, []).append(self.at)

    def _pop(self) -> None:
        if self.at.mark is not None and self.at.mark[0] == len(self.blocks):
            _, texts, links = self.at.mark
            said = sum(map(len, self.text[texts:]))
            if self.at.forms or self.link_chars - links > LOW_LINKS * said:
                del self.text[texts:]
                self.link_chars = links
        if self.text and not self.at.dropped and self.at.tag not in INLINE:
            self._flush()
        self.open[self.at.tag].pop()
        self.at = self.at.parent

    def _start(self, tag: str, attributes: str) -> None:
        if tag in VOID:
            if tag in FORM and self.at.doubt:
                self.at.doubt.forms = True
            if tag == "hr":
                self._flush()
            elif not self.at.dropped and tag != "wbr":
                self.text.append(" ")
            return
        if tag not in INLINE:
            if not self.at.dropped:
                self._flush()
            if self.open.get("p"):
                self._close_to("p", TRUSTED | UNSHOWN | {"td", "th", "table", "li", "div", "section", "blockquote"})
            if tag in ENDS:
                ended, stops = ENDS[tag]
                self._close_any(ended, stops | UNSHOWN)
        elif tag == "a" and self.open.get("a"):
            self._close_to("a", {"td", "table"} | UNSHOWN)
        if tag in FORM and self.at.doubt:
            self.at.doubt.forms = True
        inside = bool(self.open.get("article") or self.open.get("main"))
        if self.at.dropped:
            # the title stands in the header of its article
            self._push(tag, not (tag in HEADING and self.at.titles))
            self.at.titles = self.at.parent.titles and (tag in PLAIN or tag == "hgroup")
            return
        named, names = chrome(tag, attributes)
        doubtful = named == 1 and inside
        if tag == "article":
            # one after or in another article that is named for it
            if inside and (self.open.get("article") or self.articles) and names & (TALK_WORD | {"comments"}):
                named = 2
            self.articles += 1
        self._sign(tag, names)
        nested = tag == "article" and self.open.get("article")
        self._push(tag, tag in UNSHOWN or bool(named) and not doubtful)
        if tag == "header" and self.open.get("article"):
            self.at.titles = True
        if doubtful:
            self.at.doubt = self.at
            self.at.talk = bool(names & TALK_WORD)
            if tag in INLINE:
                self.at.mark = (len(self.blocks), len(self.text), self.link_chars)
        elif nested and not self.at.dropped:
            self.at.signs |= ARTICLE
            self._sign(tag, names)

    def _sign(self, tag: str, names: frozenset) -> None:
        """Note who, when and articles for the doubtful element and the inner article around."""
        signs = WHO * bool(names & WHO_WORD) | WHEN * (tag == "time" or bool(names & WHEN_WORD)) | ARTICLE * (tag == "article")
        if not signs:
            return
        if self.at.doubt:
            self.at.doubt.signs |= signs
        articles = self.open.get("article", ())
        if len(articles) > 1:
            articles[-1].signs |= signs & ~ARTICLE

    def _end(self, tag: str) -> None:
        if tag not in INLINE and not self.at.dropped:
            self._flush()
        if self.open.get(tag):
            own = tag not in INLINE or tag in UNSHOWN
            self._close_to(tag, () if own else PARAGRAPH | TRUSTED | UNSHOWN | {"div", "section", "table"})

    def _innermost(self, tags) -> int:
        """Depth of the nearest open element of these tags; the page itself is at 0."""
        return max((self.open[tag][-1].depth for tag in tags if self.open.get(tag)), default=0)

    def _leave(self, element: Element) -> None:
        while self.at is not element:
            self._pop()
        self._pop()

    def _close_to(self, tag: str, stops) -> None:
        """End the nearest open ``tag`` and all in it, unless one of ``stops`` lies between."""
        found = self.open.get(tag)
        if found and self._innermost(s for s in stops if s != tag) < found[-1].depth:
            self._leave(found[-1])

    def _close_any(self, tags: set[str], stops: set[str]) -> None:
        """End the outermost open element of ``tags`` within the nearest of ``stops``."""
        limit = self._innermost(stops)
        first = [found[bisect_right(found, limit, key=lambda e: e.depth):][:1] for found in map(self.open.get, tags) if found]
        inner = [e for part in first for e in part]
        if inner:
            self._leave(min(inner, key=lambda e: e.depth))

    def article(self) -> list[str]:
        """The blocks of the best container and of its good siblings, in page order."""
        self._drop_doubtful()
        if not self.blocks:
            return []
        scored: dict[Element, float] = {}
        totals: dict[Element, list[int]] = {}
        elements: dict[Element, None] = {}
        for element, _ in self.blocks:
            while element is not None and element not in elements:
                elements[element] = None
                element = element.parent
        for element in elements:
            totals[element] = [element.chars, element.links]
        for element in sorted(elements, key=lambda e: -e.depth):  # text of a whole subtree
            if element.parent is not None:
                above = totals[element.parent]
                above[0] += totals[element][0]
                above[1] += totals[element][1]
        for element in elements:
            if element.points is not None:
                chars, links = totals[element]
                scored[element] = element.points * (1 - links / chars)
        own: set[Element] = set()
        if scored:
            best = max(scored, key=scored.get)  # of equal ones the first
            kept = self._kept(best, scored, totals)
            outer = next(iter(kept)).parent  # of all that is kept
            if outer is not None and outer.links <= LOW_LINKS * outer.chars:
                own = {outer}  # its own text stands between them
        else:  # nothing long enough to score
            named = [e for e in elements if e.tag in ("article", "main")]
            kept = {max(named, key=lambda e: totals[e][0]) if named else self.root}
        inside: dict[Element, bool] = {}
        out = []
        for element, said in self.blocks:
            trail = []
            above = element
            while above is not None and above not in inside and above not in kept:
                trail.append(above)
                above = above.parent
            found = above is not None and (above in kept or inside[above])
            for e in trail:
                inside[e] = found
            if found or element in own:
                out.append(said)
        return out

    def _drop_doubtful(self) -> None:
        """Take out what has a doubtful name and is mostly links, holds form fields or what readers write, or is a short
        label; and articles after the text of the article around them, if there are several or they say who and when."""
        self._drop_articles()
        plain: set[Element] = set()  # those that say a sentence, or have a heading
        for element, said in self.blocks:
            if element.doubt:
                if element.tag in HEADING:
                    plain.add(element.doubt)
                    if TALK_HEADING.fullmatch(said):
                        element.doubt.signs |= COUNTED
                elif SENTENCE.search(said):
                    plain.add(element.doubt)
        sums: dict[Element, list[int]] = {}
        for element, _ in self.blocks:
            if element.doubt and element not in sums:
                sums[element] = [element.chars, element.links]
        if not sums:
            return
        inner: dict[Element, list[int]] = {}
        for element, (chars, links) in sums.items():
            of = inner.setdefault(element.doubt, [0, 0])
            of[0] += chars
            of[1] += links
        nested = set(inner)
        for doubt in inner:
            above = doubt.parent.doubt
            while above is not None and above not in nested:
                nested.add(above)
                above = above.parent.doubt
        for doubt in sorted(nested, key=lambda e: -e.depth):  # inner ones first
            of, above = inner.setdefault(doubt, [0, 0]), doubt.parent.doubt
            if above is not None:
                into = inner.setdefault(above, [0, 0])
                into[0] += of[0]
                into[1] += of[1]
                above.forms |= doubt.forms
                above.signs |= doubt.signs
                if doubt in plain:
                    plain.add(above)
        gone = {}
        for doubt in sorted(nested, key=lambda e: e.depth):
            chars, links = inner[doubt]
            signs = doubt.signs
            talk = doubt.talk and (signs & (ARTICLE | COUNTED) or signs & WHO and signs & WHEN)
            short = SHORT_PARAGRAPH if doubt.tag in PARAGRAPH else 0 if doubt.tag in INLINE else SHORT_BLOCK
            label = doubt not in plain and chars < short
            gone[doubt] = bool(gone.get(doubt.parent.doubt, False) or doubt.forms or links > LOW_LINKS * chars or talk or label)
        left = [(element, said) for element, said in self.blocks if not gone.get(element.doubt, False)]
        for element, _ in self.blocks:
            if gone.get(element.doubt, False):
                element.chars = element.links = 0
        self.blocks = left

    def _drop_articles(self) -> None:
        last: dict[Element, int] = {}  # of an article, its last own long text
        first: dict[Element, int] = {}
        for at, (element, said) in enumerate(self.blocks):
            if element.inner:
                first.setdefault(element.inner, at)
            elif element.outer and len(said) >= SHORT_BLOCK:
                last[element.outer] = at
        after: dict[Element, list[Element]] = {}
        for article, at in first.items():
            if last.get(article.outer, at) < at:
                after.setdefault(article.outer, []).append(article)
        gone = {article for found in after.values() for article in found
                if len(found) > 1 or article.signs & WHO and article.signs & WHEN}
        if gone:
            for element, _ in self.blocks:
                if element.inner in gone:
                    element.chars = element.links = 0
            self.blocks = [(element, said) for element, said in self.blocks if element.inner not in gone]

    def _kept(self, best: Element, scored: dict[Element, float], totals: dict[Element, list[int]]) -> set[Element]:
        """The article around the best container, and its siblings that belong to it; ``totals`` is in page order."""
        article, holders, above = best, {}, best
        while above is not None:
            if above.tag in ("article", "main"):
                holders[above.tag] = above  # the outermost
            above = above.parent
        article = holders.get("article") or holders.get("main") or best
        while article.parent is not None and totals[article.parent][0] == totals[article][0]:
            article = article.parent  # it holds no other text
        kept, outer = {article}, article.parent
        if outer is None:
            return kept
        headed = set()
        for element, _ in self.blocks:
            if element.tag in HEADING:
                while element is not None and element not in headed:
                    headed.add(element)
                    element = element.parent
        share = SIBLING_SHARE * scored[best]
        page = outer.tag in ("body", "html", self.root.tag)
        follows = True  # is what comes after a heading kept
        for sibling in reversed([e for e in totals if e.parent is outer]):
            if sibling is article:
                follows = True
                continue
            chars, links = totals[sibling]
            points, few = scored.get(sibling), links <= LOW_LINKS * chars
            if sibling.tag in HEADING:
                good = follows
            elif points is None:
                good = few and (sibling.tag not in PLAIN or sibling in headed or "main" in holders)
            else:
                good = points >= max(SIBLING_LEAST, share) or few and (
                    sibling.tag not in PLAIN or not page or points >= share)
            if good:
                kept.add(sibling)
            if sibling.tag not in HEADING:
                follows = good
        return kept


def main_text(html: str) -> str:
    return "\n".join(Page(html).article())


def extract(df: DataFrame, keep: list[str], html: str = "html", text: str = "text") -> DataFrame:
    """``keep`` columns and ``text``: the main text of every page, one block of the page per line.

    Character references are decoded, white space inside a block is one space. A page that is null, empty or
    without text has an empty text. One row of output per row of input, repeated ones too; other columns of
    ``df`` are left out, and a kept column called ``text`` is replaced. No shuffle; the page is one row's value.
    """
    kept = [name for name in keep if name != text]
    ddl = ", ".join([fields(df, *kept), f"`{text}` string"] if kept else [f"`{text}` string"])
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Sender(schema)
        for batch in batches:
            rows = zip(*(column.to_pylist() for column in batch.columns[:-1])) if kept else [()] * batch.num_rows
            for row, page in zip(rows, batch.column(batch.num_columns - 1)):
                said = main_text(page.as_py() or "")
                if out.add(*row, said, size=len(said) + 64):
                    yield out.batch()
        yield out.batch()

    return map_batches(df.select(*kept, html), ddl, run)
