"""Main text of web pages by tree scoring.

Paragraphs pass points for their length and commas to their ancestors, less with each level and
discounted by the share of their text that is links. The best container, raised to the article or
main element around it, gives the text together with those siblings that score near it or are
plain paragraphs. Menus, page headers, footers, sidebars, notices, adverts, forms and comments are
cut off beforehand by element, role or class and id; a class or id counts if all its words speak
for it, so that ``comments-area`` goes and ``social-history`` stays, and counts for paragraphs too:
``<p class="notice">`` is a notice. Of an article's own header the headings and whole sentences stay,
bylines and dates go. Formulas stay in their line; buttons, pictures and scripts within a line go
without breaking it.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements by role in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg".split())
DROPPED = frozenset("nav footer aside annotation annotation-xml button select option datalist dialog menu object audio video canvas map head".split()) | RAW
#: Elements that go and do not end the line they stand in.
INLINE = frozenset("script style noscript template svg textarea iframe button select object audio video canvas map annotation annotation-xml".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ENDS_P = BLOCKS - frozenset("body dd dt html head li tbody td tfoot th thead tr title".split())
#: What an opening tag ends among the elements up to a boundary.
CLOSES = {"li": ("li", {"ul", "ol", "menu", "dir"}), "dt": ("dd dt", {"dl"}), "dd": ("dd dt", {"dl"}), "tr": ("tr td th", {"table"}), "td": ("td th", {"tr", "table"}), "th": ("td th", {"tr", "table"}), "option": ("option", {"select"}), "tbody": ("tbody thead tr td th", {"table"}), "thead": ("tbody thead tr td th", {"table"})}
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog menu menubar toolbar form alert".split())
UNLIKELY = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disqus footer foot gdpr header hidden masthead menu modal nav navbar navigation newsletter notice notices notification pager pagination popup promo promoted promotion recommended related reply replies respond share sharing shoutbox sidebar sidebars signup skip social sponsor sponsored sponsors subscribe subscription toc toolbar tooltip widget widgets".split()
)
#: Words that say nothing of themselves beside the ones above.
NEUTRAL = frozenset(
    "area article articles bar block blog body bottom box btn button buttons center class col column container content desktop div entry fixed form global group holder icon icons id inline inner item items js label layout left link links list main message mobile module my new news outer page panel panels policy post posts primary reader readers region right row secondary section side site slot sticky stories story text top unit user view wrap wrapper zone".split()
)
#: Elements that may stand in a page's head.
IN_HEAD = frozenset("base link meta noscript script style template title".split())
TAG_POINTS = {"article": 15, "main": 12, "section": 4, "div": 5, "pre": 3, "td": 3, "blockquote": 3, "ul": -3, "ol": -3, "dl": -3, "li": -3, "address": -3, "th": -5}
GOOD = frozenset("article body content entry main page post text blog story hentry prose".split())

_TAG = re.compile(r"""<!--(?:.*?-->|.*)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?|"[^"]*"|'[^']*'""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_RAW_END = {t: re.compile(rf"</{t}\s*>", re.I) for t in RAW}


class _Node:
    __slots__ = ("tag", "up", "dropped", "words", "points", "chars", "linked", "depth", "items", "in_article", "form", "holds_article")

    def __init__(self, tag: str, up: _Node | None, words: list[str], dropped: bool):
        self.tag, self.up, self.words = tag, up, words
        self.dropped = dropped or up is not None and up.dropped
        self.depth = up.depth + 1 if up else 0
        self.in_article = tag == "article" or up is not None and up.in_article
        self.points = self.chars = self.linked = self.items = 0
        self.form = self if tag == "form" else up.form if up else None
        self.holds_article = False
        if tag in ("article", "main", "h1"):
            form = self.form
            while form is not None and not form.holds_article:
                form.holds_article = True
                form = form.up.form if form.up else None


def _names_unlikely(value: str) -> bool:
    """Whether a class or id names something to cut off: one of its words does so, and none speaks
    for something else."""
    for name in value.split():
        words = [w.lower() for w in _WORD.findall(name)]
        found = UNLIKELY.intersection(words)
        if found and all(w in UNLIKELY or w in NEUTRAL or w.isdigit() for w in words) and not ("header" in found and len(found) == 1 and GOOD.intersection(words) - {"page", "main", "body"}):
            return True
    return False


def _unlikely(tag: str, attributes: str, in_article: bool) -> tuple[list[str], bool]:
    """The words of class and id, and whether the element is cut off."""
    if tag in DROPPED or tag == "header" and not in_article:
        return [], True
    words: list[str] = []
    unlikely = False
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = (m[1] or "").lower(), m[2] or m[3] or m[4] or ""
        if name == "role":
            if value.strip().lower() in ROLES:
                return words, True
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return words, True
        elif name in ("class", "id"):
            words += [w.lower() for w in _WORD.findall(value)]
            unlikely = unlikely or _names_unlikely(value)
    if tag in ("html", "body", "main") or tag in HEADINGS or tag == "article" and not {"comment", "comments", "reply"} & set(words):
        return words, False
    return words, unlikely


class _Page:
    """Blocks of text with the element that each stands in."""

    def __init__(self, page: str):
        self.root = self.at = _Node("html", None, [], False)
        self.blocks: list[tuple[_Node, str, int]] = []
        self._text: list[str] = []
        self._linked = 0
        self._in_link = 0
        pos, n = 0, len(page)
        while pos < n:
            m = _TAG.search(page, pos)
            if m is None:
                self._write(page[pos:])
                break
            if m.start() > pos:
                self._write(page[pos : m.start()])
            pos = m.end()
            if (name := m[2]) is None:
                continue
            tag = name.lower()
            if m[1]:
                self._close(tag)
            else:
                self._open(tag, m[3])
                if tag in RAW and not m[3].endswith("/"):
                    end = _RAW_END[tag].search(page, pos)
                    if tag not in ("noscript", "template", "svg") or end:
                        pos = end.end() if end else n
                    self._close(tag)
        self._flush()
        self._drop_forms()

    def _drop_forms(self) -> None:
        """Forms to fill in go; one around the article, or around most of the page, stays."""
        chars: dict[int, int] = {}
        for node, text, _ in self.blocks:
            form = node.form
            while form is not None:
                chars[id(form)] = chars.get(id(form), 0) + len(text)
                form = form.up.form
        most = sum(len(text) for _, text, _ in self.blocks) / 2

        def stays(form: _Node | None) -> bool:
            return form is None or (form.holds_article or chars[id(form)] > most and chars[id(form)] >= 100) and stays(form.up.form)

        if chars:
            self.blocks = [block for block in self.blocks if stays(block[0].form)]

    def _write(self, text: str) -> None:
        if self.at.tag == "head" and text.strip():
            self._leave(self.at)
        if not self.at.dropped:
            self._text.append(text)
            if self._in_link:
                self._linked += len(text.strip())

    def _flush(self) -> None:
        if self._text:
            text = "".join(self._text)
            text = " ".join((html.unescape(text) if "&" in text else text).split())
            if text:
                node = self.at
                while node.tag in INLINE and node.up is not None:
                    node = node.up
                self.blocks.append((node, text, min(self._linked, len(text))))
            self._text = []
        self._linked = 0

    def _leave(self, node: _Node) -> None:
        if node.tag not in INLINE:
            self._flush()
        self.at = node.up or self.root

    def _open(self, tag: str, attributes: str) -> None:
        if self.at.tag == "head" and tag not in IN_HEAD:
            self._leave(self.at)
        if tag in ("html", "body") and self.at.depth > (tag == "body"):
            return
        if tag == "br":
            self._text.append(" ")
            return
        if tag in VOID:
            if tag == "hr":
                self._flush()
            return
        if tag == "a":
            self._in_link = 1
        if tag not in BLOCKS and tag not in DROPPED:
            return
        if tag not in INLINE:
            self._flush()
        if tag in ENDS_P:
            self._close_up_to("p", {"table", "td", "th", "button", "li", "div", "article", "section", "blockquote", "body", "html"})
        if tag in CLOSES:
            ended, stops = CLOSES[tag]
            for one in ended.split():
                self._close_up_to(one, stops)
        words, dropped = _unlikely(tag, attributes, self.at.in_article)
        self.at = _Node(tag, self.at, words, dropped)

    def _close_up_to(self, tag: str, stops: set[str]) -> None:
        node = self.at
        while node.up is not None and node.tag != tag:
            if node.tag in stops:
                return
            node = node.up
        if node.up is not None:
            self._leave(node)

    def _close(self, tag: str) -> None:
        if tag == "a":
            self._in_link = 0
        if tag not in BLOCKS and tag not in DROPPED:
            return
        node = self.at
        if tag not in INLINE:
            self._flush()
        while node.up is not None and node.tag != tag:
            node = node.up
        if node.up is not None:
            self._leave(node)


def _score(page: _Page) -> list[_Node]:
    seen: dict[int, _Node] = {}
    for node, text, linked in page.blocks:
        holder = node if node.tag in BLOCKS else page.root
        share = linked / len(text)
        points = (1 + text.count(",") + min(len(text) / 100, 3)) * (1 - share)
        if holder.tag in HEADINGS:
            points = 0
        first = holder if holder.tag in ("div", "article", "section", "main", "td", "body", "html") else holder.up
        up, level = first, 0
        while up is not None:
            if id(up) not in seen:
                seen[id(up)] = up
                up.points += TAG_POINTS.get(up.tag, 0) + 5 * bool(GOOD.intersection(up.words))
            up.points += points / (1, 2, 6, 9)[min(level, 3)]
            up, level = up.up, level + 1
        up = holder
        while up is not None:
            up.chars += len(text)
            up.linked += linked
            up.items += 1
            up = up.up
    return list(seen.values())


def _inside(node: _Node, top: _Node) -> bool:
    while node.depth > top.depth:
        node = node.up
    return node is top


def extract(page: str | None) -> str:
    """The main text of one page, its blocks joined by line breaks; '' where there is none."""
    if not page:
        return ""
    tree = _Page(page)
    if not tree.blocks:
        return ""
    scored = _score(tree)
    final = lambda n: n.points * (1 - n.linked / n.chars if n.chars else 1)
    best = max(scored, key=lambda n: (final(n), -n.depth))
    up = best
    while up is not None:
        if up.tag in ("article", "main"):
            best = up
            if up.tag == "article":
                break
        up = up.up
    if best.tag in ("td", "th", "tr", "tbody", "thead"):
        table = best
        while table.up is not None and table.tag != "table":
            table = table.up
        if best.chars < table.chars / 2 and table.linked < table.chars / 4:
            best = table
    tops = [best]
    if best.tag == "article" and best.up is not None:
        around = best.up
        while around.up is not None and around.tag != "main":
            around = around.up
        # several articles of one main element, or side by side
        near = (lambda n: _inside(n, around)) if around.tag == "main" else (lambda n: n.up is best.up)
        tops += [n for n in scored if n.tag == "article" and n is not best and near(n) and not _inside(n, best) and not _inside(best, n) and final(n) >= final(best) / 5]
    if best.tag not in ("article", "main", "body", "html") and best.up is not None:
        least = max(10, final(best) / 5)
        for node, text, linked in tree.blocks:
            side = node
            while side.depth > best.depth:
                side = side.up
            if side is best or side.up is not best.up or side in tops:
                continue
            plain = side.tag == "p" and (len(text) > 80 and linked < len(text) / 4 or not linked and text[-1:] in ".!?")
            if final(side) >= least and side in scored or plain or side.tag == "h1":
                tops.append(side)

    kept: list[str] = []
    led = False  # whether a heading or a line with a colon stands before
    listed: dict[int, bool] = {}
    named = best.tag not in ("body", "html") and bool(GOOD.intersection(best.words))

    def menu(node: _Node, sentence: bool) -> bool:
        while node.depth > best.depth:
            if node.tag in ("ul", "ol") and not node.in_article and node.items > 1 and node.linked > 0.8 * node.chars:
                # sources of a text that is named as such, or that a heading leads in
                if not listed.setdefault(id(node), bool(kept) and (named or led)):
                    return True
            if node.tag == "header" and node.in_article and not sentence:
                return True
            node = node.up
        return False

    for node, text, linked in tree.blocks:
        sentence = not linked and (len(text) > 80 or text[-1:] in ".!?")
        if any(_inside(node, top) for top in tops) and (node.tag in HEADINGS or not menu(node, sentence)):
            kept.append(text)
            led = node.tag in HEADINGS or text.endswith(":")
    return "\n".join(kept)


def extract_pages(pages: DataFrame, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """``pages`` with ``out_col`` in place of ``html_col``: each page's main text, '' for null,
    empty and textless pages. Other columns pass through, but for one named ``out_col``; repeated
    rows get equal texts. Pages are read whole, one after the other, in time that grows with their
    length; of equal scores the container that opens first counts. Broken markup is read as browsers
    do for the common cases: end tags left out (also of head, p, li and td), stray end tags,
    unclosed comments."""
    rest = [c for c in pages.columns if c not in (html_col, out_col)]
    rows = pages.select(*rest, F.col(html_col).cast("string").alias(out_col))

    def run(batches):
        for batch in batches:
            texts = pa.array([extract(x.as_py()) for x in batch.column(len(rest))], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], texts], [*rest, out_col])

    return rows.mapInArrow(run, rows.schema)
