"""Pages of known publishers: one interpreter over a table of rules, on a tolerant tree.

What is a pattern over the raw page (titles, dates, links, sitemaps) has column functions; what
needs the tree (containers, headings, bylines) is one function per page behind an Arrow UDF.
"""

from __future__ import annotations

import html as entities
import json
import re
from dataclasses import dataclass, field
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from corpusloom.functions.text import meta_content
from corpusloom.schemas import DISCOVERY_CAP

STD7 = frozenset("script style noscript iframe nav footer header".split())
STD10 = STD7 | frozenset("form button aside".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADS = ("h1", "h2", "h3", "h4", "h5", "h6")


@dataclass(frozen=True)
class Rule:
    """How a publisher's pages are found and read. ``body`` is tried in order: ("class", pattern,
    tags), ("attr", name, pattern), ("heading", pattern, deepest level) or ("tag", name)."""

    body: tuple[tuple, ...]
    link: str = ""
    reject: frozenset[str] = frozenset()
    drop: frozenset[str] = STD7
    guests: str = ""
    cut: str = ""
    strict: bool = False
    assets: str = ""
    cap: int = 20
    suffix: str = ""
    #: Fields of the page's JSON-LD that name guests, where no label does.
    people: tuple[str, ...] = ()
    #: Where the transcript's PDF is linked: tiers in order, each of (link text, address) patterns.
    transcript: tuple[tuple[tuple[str, str], ...], ...] = ()


_ARTICLE, _MAIN = ("tag", "article"), ("tag", "main")
_SLUG = r"[a-z0-9][a-z0-9\-]*"
#: Links, containers and labels of each publisher's pages.
RULES: dict[str, Rule] = {
    "acquired": Rule((("class", r"transcript", ("div",)), ("heading", r"transcript", 6)), rf'href="(?:https?://(?:www\.)?acquired\.fm)?/episodes/({_SLUG})/?"', assets="external", cap=25, people=("actor", "performer", "guest")),
    "a16z": Rule((_ARTICLE, ("attr", "id", r"^content$")), rf"<loc>\s*https?://a16z\.com/podcast/({_SLUG})/?\s*</loc>", guests="Guests?", assets="pdf", cap=25),
    "bcg": Rule((("class", r"podcast-transcript|rich-text", ("div",)), _MAIN), r"<loc>\s*https?://(?:www\.)?bcg\.com/featured-insights/podcasts/(?!page/)([a-z0-9][a-z0-9\-]*/[a-z0-9][a-z0-9\-]*)/?\s*</loc>", guests="Guests?", assets="pdf", transcript=((("transcript", ""), ("", r"web-assets\.bcg\.com.*transcript")),)),
    "deutsche_bank": Rule((("heading", r"^transcript\b", 3), _ARTICLE, _MAIN), r'href="(?:https?://flow\.db\.com)?/media/flow-incorporatetreasury-podcasts/([a-z0-9][a-z0-9\-]+[a-z0-9])(?:[?#][^"]*)?/?"', drop=STD10, suffix="-transcript"),
    "exit_five": Rule((("heading", r"transcription|transcript", 6), _ARTICLE), rf'href="(?:https?://(?:www\.)?exitfive\.com)?/podcast/({_SLUG})/?"', guests="Guests?", assets="external"),
    "frog": Rule((_ARTICLE, _MAIN), rf'href="(?:https?://(?:www\.)?frog\.co)?/designmind/(design-mind-frogcast-{_SLUG})/?"'),
    "imd": Rule((("attr", "data-elementor-type", r"^wp-post$"), _MAIN), r'href="(?:https?://(?:www\.)?imd\.org)?/ibyimd/podcasts/(?!page/)([a-z0-9][a-z0-9\-/]*[a-z0-9])/?"', guests="Guest|Featuring|Interviewed", cut="article"),
    "masters_of_scale": Rule((("heading", r"^transcript\b", 6),), rf"<loc>\s*https?://mastersofscale\.com/episode/({_SLUG})/?\s*</loc>", guests="Guests?", strict=True, assets="external"),
    "mckinsey": Rule((_ARTICLE, _MAIN), guests="Guests?", cut=r"related (articles|insights)", assets="pdf"),
    "microsoft_cyber": Rule((_ARTICLE, _MAIN), r"<loc>\s*https?://wwps\.microsoft\.com/((?:episodes|infrastructure-episodes)/[a-z0-9][a-z0-9\-]*)/?\s*</loc>", assets="pdf"),
    "ncsc": Rule((_MAIN, _ARTICLE)),
    "people_matters": Rule((_ARTICLE, ("class", r"article-content", ("div",))), r"<loc>\s*https?://(?:www\.)?peoplematters\.in/podcast/(?=[a-z0-9][a-z0-9\-:]*/[a-z0-9])([a-z0-9][a-z0-9\-/:]*?[a-z0-9])/?\s*</loc>", guests="Guest|In conversation with"),
    "rbc_disruptors": Rule((("heading", r"transcript", 6), _ARTICLE, _MAIN), r'href="(?:https?://(?:www\.)?rbc\.com)?/en/thought-leadership/disruptors/([a-z0-9][a-z0-9\-]*?)/?"', reject=frozenset(["", "subscribe", "about", "podcast", "podcasts", *(f"season-{k}" for k in range(1, 11))]), drop=STD10),
    "rics": Rule((_ARTICLE, _MAIN), assets="pdf"),
    "ted_worklife": Rule((_MAIN, _ARTICLE), r'href="(?:https?://)?(?:www\.)?(?:ted\.com)?/?podcasts/([a-z0-9][a-z0-9\-]*?)-transcript/?(?:[?#][^"]*)?"', reject=frozenset({"", "worklife", "worklife-transcripts", "subscribe"}), drop=STD10),
    "thomson_reuters": Rule((_ARTICLE, _MAIN), r"<loc>\s*https?://(?:www\.)?thomsonreuters\.com/en-us/posts/([a-z0-9\-]+/podcast-[a-z0-9\-]+)/?\s*</loc>", drop=STD10, assets="pdf", transcript=((("episode transcript", ""),), ((r"^transcript$", r"/wp-content/uploads/"),))),
    "wef_radio_davos": Rule((("attr", "data-gtm-section", r"transcript"), ("class", r"transcript", ("div", "section")), ("attr", "class", r"hypernova"), _ARTICLE, _MAIN), r'href="(?:https?://(?:www\.)?weforum\.org)?/podcasts/radio-davos/episodes/([^"/?#]+)/?"', drop=STD10, guests="Guests?"),
}


@dataclass
class Element:
    tag: str
    attrs: dict[str, str] = field(default_factory=dict)
    up: Element | None = None
    inner: list = field(default_factory=list)

    def walk(self):
        for x in self.inner:
            if isinstance(x, Element):
                yield x
                yield from x.walk()

    def text(self, joint: str = "\n") -> str:
        parts: list[str] = []
        todo = [self]
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                parts.append(x)
            else:
                todo += reversed(x.inner)
        return joint.join(parts)

    def words(self) -> str:
        return " ".join(self.text(" ").split())


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Element("root")

    def handle_starttag(self, tag, attrs):
        if tag in ("p", *HEADS) and self.at.tag == "p" or tag == "li" and self.at.tag == "li":
            self.at = self.at.up
        new = Element(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.inner.append(new)
        if tag not in VOID:
            self.at = new

    def handle_startendtag(self, tag, attrs):
        self.at.inner.append(Element(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        node = self.at
        while node.up is not None and node.tag != tag:
            node = node.up
        if node.up is not None:
            self.at = node.up

    def handle_data(self, data):
        self.at.inner.append(data)


def parse(page: str) -> Element:
    builder = _Builder()
    builder.feed(page)
    builder.close()
    return builder.root


def without(top: Element, tags: frozenset[str]) -> Element:
    for x in [top, *top.walk()]:
        x.inner = [y for y in x.inner if isinstance(y, str) or y.tag not in tags]
    return top


def collapse_lines(text: str) -> str:
    text = re.sub(r"\n{3,}", "\n\n", text.replace("\r\n", "\n").replace("\r", "\n"))
    return "\n".join(line.rstrip() for line in text.split("\n")).strip()


def markdown(top: Element) -> str:
    """Text of the tree, headings as lines with number signs."""
    for x in [top, *top.walk()]:
        if x.tag in HEADS:
            x.inner = [f"\n{'#' * int(x.tag[1])} {''.join(s.strip() for s in [x.text('')])}\n"]
    return collapse_lines(top.text("\n"))


def base_markdown(page: str | None) -> str:
    return markdown(without(parse(page or ""), STD7))


def _after_heading(top: Element, pattern: str, deepest: int) -> Element | None:
    for h in top.walk():
        if h.tag in HEADS[:deepest] and re.search(pattern, h.words(), re.I):
            got, siblings = Element("section"), h.up.inner
            for x in siblings[next(k for k, y in enumerate(siblings) if y is h) + 1 :]:
                if isinstance(x, Element) and x.tag in ("h1", "h2"):
                    break
                got.inner.append(x)
            return got
    return None


def container(top: Element, rule: Rule) -> Element | None:
    for kind, *args in rule.body:
        if kind == "heading":
            found = _after_heading(top, *args)
        elif kind == "tag":
            found = next((x for x in top.walk() if x.tag == args[0]), None)
        elif kind == "class":
            found = next((x for x in top.walk() if x.tag in args[1] and re.search(args[0], x.attrs.get("class", ""), re.I)), None)
        else:
            found = next((x for x in top.walk() if re.search(args[1], x.attrs.get(args[0], ""), re.I)), None)
        if found is not None:
            return found
    return None


def source_markdown(page: str | None, source: str, tree: Element | None = None) -> str:
    """The transcript of a publisher's page; of a page without its container the whole page, or
    nothing where the rule is strict."""
    rule = RULES[source]
    top = without(tree or parse(page or ""), rule.drop)
    body = container(top, rule)
    if body is None:
        return "" if rule.strict else markdown(top)
    if rule.cut == "article":
        without(body, frozenset({"article"}))
    elif rule.cut:
        for h in list(body.walk()):
            if h.tag in HEADS and re.search(rule.cut, h.words(), re.I):
                h.up.inner = h.up.inner[: next(k for k, y in enumerate(h.up.inner) if y is h)]
                break
    return markdown(body)


def guests(page: str | None, source: str, tree: Element | None = None) -> list[str]:
    """Names behind the publisher's label, from the first paragraph that has it."""
    rule = RULES[source]
    if not rule.guests:
        return ld_people(page, *rule.people)
    wanted = re.compile(rf"^(?:{rule.guests})\s*[:—–-]\s*(.+)$", re.I)
    for x in (tree or parse(page or "")).walk():
        if x.tag in ("p", "li", "div", "span") and (m := wanted.match(x.words())):
            return [n.strip() for n in re.split(r",| and ", m[1]) if n.strip()]
    return []


def assets(page: str | None, source: str, url: str, tree: Element | None = None) -> list[str]:
    """PDF or outside links of a page, absolute, each once, up to the rule's cap."""
    rule, found = RULES[source], {}
    own = re.sub(r"^https?://(?:www\.)?([^/]+).*$", r"\1", url)
    for x in (tree or parse(page or "")).walk():
        if x.tag == "a" and (href := x.attrs.get("href", "")):
            link = urljoin(url, href)
            if rule.assets == "pdf" and re.search(r"\.pdf(?:[?#]|$)", link, re.I) or rule.assets == "external" and link.startswith("http") and own not in link:
                found[link] = None
    return list(found)[: rule.cap]


def transcript_link(page: str | None, source: str, url: str, tree: Element | None = None) -> str | None:
    """The PDF that a page links as its transcript, absolute: the first link of the first tier that
    has one."""
    links = [(x.words().lower().strip(". "), urljoin(url, href)) for x in (tree or parse(page or "")).walk() if x.tag == "a" and (href := x.attrs.get("href", "")).lower().endswith(".pdf")]
    for tier in RULES[source].transcript:
        for words, link in links:
            if any(re.search(a, words) and re.search(b, link, re.I) for a, b in tier):
                return link
    return None


def json_ld(page: str | None) -> list[dict]:
    """Objects of the page's JSON-LD scripts, arrays and graphs replaced by their items;
    malformed ones are left out."""
    out: list[dict] = []
    for body in re.findall(r"(?is)<script[^>]*type=[\"']application/ld\+json[\"'][^>]*>(.*?)</script>", page or ""):
        try:
            held = json.loads(re.sub(r"(?m)^\s*//\s*<!\[CDATA\[|//\s*\]\]>\s*$", "", body))
        except ValueError:
            continue
        todo = held if isinstance(held, list) else [held]
        for x in todo:
            if isinstance(x, dict):
                out += [y for y in x["@graph"] if isinstance(y, dict)] if isinstance(x.get("@graph"), list) else [x]
    return out


def is_type(item: dict, *wanted: str) -> bool:
    kinds = item.get("@type", [])
    return bool(set(kinds if isinstance(kinds, list) else [kinds]) & set(wanted))


def ld_people(page: str | None, *fields: str) -> list[str]:
    names: dict[str, None] = {}
    for item in json_ld(page):
        for f in fields:
            held = item.get(f, [])
            for x in held if isinstance(held, list) else [held]:
                name = x.get("name") if isinstance(x, dict) else x
                if isinstance(name, str) and name.strip():
                    names[name.strip()] = None
    return list(names)


def slugs(page: str | None, source: str, cap: int = DISCOVERY_CAP) -> list[str]:
    rule, found = RULES[source], {}
    for m in re.finditer(rule.link, page or "") if rule.link else ():
        slug = m[1].removesuffix(rule.suffix) if rule.suffix else m[1]
        if slug not in rule.reject:
            found[slug] = None
    return list(found)[:cap]


def slugs_native(c: Column, source: str, cap: int = DISCOVERY_CAP) -> Column:
    """``slugs`` without Python: the same pattern in the JVM."""
    rule = RULES[source]
    if not rule.link:
        return F.array().cast("array<string>")
    found = F.regexp_extract_all(c, F.lit(rule.link), F.lit(1))
    if rule.suffix:
        found = F.transform(found, lambda s: F.regexp_replace(s, re.escape(rule.suffix) + "$", ""))
    return F.slice(F.array_distinct(F.filter(found, lambda s: ~s.isin(list(rule.reject)) if rule.reject else F.lit(True))), 1, cap)


def safe_slug(slug: str) -> str:
    return slug.replace("/", "_")


def unescaped(text: str) -> str:
    return entities.unescape(text)


_PAGE_TYPE = StructType([StructField("markdown", StringType()), StructField("guests", ArrayType(StringType())), StructField("assets", ArrayType(StringType())), StructField("transcript", StringType()), StructField("error", StringType())])


@F.pandas_udf(_PAGE_TYPE)
def read_page(source: pd.Series, url: pd.Series, page: pd.Series) -> pd.DataFrame:
    """Everything the tree gives of one page; a page that fails has its error and no text."""
    rows = []
    for s, u, p in zip(source, url, page, strict=True):
        try:
            tree = parse(p or "")
            found = guests(p, s, tree), assets(p, s, u or "", tree), transcript_link(p, s, u or "", tree)
            rows.append((source_markdown(p, s, tree), *found, None))  # last, since it cuts the tree
        except Exception as e:  # one bad page must not end the job; its error is data
            rows.append((None, [], [], None, f"{type(e).__name__}: {e}"))
    return pd.DataFrame(rows, columns=["markdown", "guests", "assets", "transcript", "error"])


@F.pandas_udf(StringType())
def page_markdown(page: pd.Series) -> pd.Series:
    return page.map(base_markdown)


@F.pandas_udf(ArrayType(StringType()))
def page_people(page: pd.Series) -> pd.Series:
    """Names in the JSON-LD of a page, in order, each once."""
    return page.map(lambda p: ld_people(p, "actor", "performer", "guest"))


def page_description(c: Column) -> Column:
    return F.coalesce(F.nullif(meta_content(c, "description"), F.lit("")), meta_content(c, "og:description"))
