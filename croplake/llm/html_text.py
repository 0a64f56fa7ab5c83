"""Main text of web pages by two passes of rules over blocks.

A page becomes blocks (paragraphs, headings, items, cells) with their text, links and place in the page. The first
pass labels blocks: those in menus, headers, footers and the like are boilerplate; for all others density of links,
length and density of stop words decide, and short or middling blocks stay open. In the second pass open blocks take
the label of their nearest decided neighbours. Where a page has articles, these are a prior: text within needs less to
be good and more to be bad, text outside the reverse, and the borders of the article count as good neighbours within
and as bad ones outside. The stop words are of four languages: bounds of density go down with the page's own density,
and where that is next to nothing length and links alone decide.

Elements that are only named like boilerplate (by class or id), and forms, are judged by what they hold when the whole
page is known: one that wraps the page's only article or most of its text without links is a wrapper, and forms and
lists of related pages count only where they have no long text without links (:func:`_is_boilerplate`). Such a wrapper hands
nothing on to what is below it.

Null and empty html give an empty text. Markup may be broken: unclosed elements end with their parents, unknown end
tags are skipped, an unclosed comment, script or style runs to the end. A quote opens a value only after ``=``; where
quotes are so broken that a tag would not end, tags end at their first ``>`` from there on. What is nested deeper than
``DEEPEST`` elements is taken as flat, as browsers do. All of this takes time in proportion to the page. Whole pages are
read. Repeated rows are repeated in the result. An empty table gives no rows.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import common

# possessive throughout: a tag is read once, whatever its quotes are like
_OPEN = re.compile(r"""<([a-zA-Z][^\s/>]*+)((?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+|["'])*+)>""")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]*+)))?+""")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# Elements by what they are.
RAW = {"script", "style", "title", "textarea", "iframe", "noembed", "noframes", "xmp", "template", "noscript", "svg", "math"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
BOILERPLATE = {"nav", "footer", "aside", "head", "button", "select", "menu", "dialog", "object", "canvas", "search"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu", "menubar", "note", "status"}
# words of class and id attributes
HINTS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices notification "
    "alert popup modal overlay newsletter subscribe subscription signup login sidebar aside widget widgets menu nav navbar navigation navigator breadcrumb breadcrumbs "
    "footer masthead comment comments commentlist disqus reply replies respond related recommended recommendations share sharing social toolbar pagination pager "
    "copyright legal disclaimer skip outbrain taboola teaser teasers".split()
)
# of these, the ones that long text without links speaks against
LISTS = set("related recommended recommendations share sharing social form".split())
# a class that begins so tells what the page has, not what the element is
NOT_OWN = {"has", "with", "no", "without", "show", "hide"}
ROOTS = {"article", "main"}
ROOT_HINTS = {"article", "content", "post", "entry", "story", "main"}
STOP_WORDS = set(
    "the of and to in that is was with for on are by this it from at as be an or a not have which "
    "der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch es er "
    "le la les de du et en un une que qui est pour dans par sur au avec il ne pas ce se plus "
    "el los las y del por con no para su al lo como más o".split()
)

MANY_LINKS, LONG, SHORT, HIGH, LOW = 0.5, 140, 70, 0.30, 0.15
#: A list of links has at least this share of its characters in links.
LISTED = 0.25
DEEPEST = 512
#: Scripts without spaces and other wide characters: one of them is as long as two letters.
_WIDE = re.compile("[\u1100-\u11ff\u2e80-\ua4cf\uac00-\ud7ff\uf900-\ufaff\uff00-\uffef\U00020000-\U0003ffff]")
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}


@dataclass
class Block:
    text: str
    links: int  # characters within links
    tag: str
    within: str  # "boilerplate", "root" or ""
    label: str = field(default="")
    suspect: int = -1  # the innermost element around it that is named like boilerplate


@dataclass
class Suspect:
    """An element that may be boilerplate, with what it holds."""

    parent: int
    lists: bool  # a form, or named like a list of other pages
    chars: int = 0
    links: int = 0
    longest: int = 0  # of its blocks with few links
    roots: int = 0
    bad: bool = False


def _attributes(raw: str) -> Iterator[tuple[str, str]]:
    for name, double, single, bare in _ATTRIBUTE.findall(raw):
        yield name.lower(), double or single or bare.strip("\"'")


def _traits(tag: str, attributes: list[tuple[str, str]], in_root: bool) -> tuple[bool, bool, set[str]]:
    """(boilerplate, root, words by which it is named like boilerplate) of an element."""
    bad = tag in BOILERPLATE or (tag == "header" and not in_root)
    root = tag in ROOTS
    named = {"form"} if tag == "form" else set()
    for name, value in attributes:
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            bad = True
        elif name == "style":
            bad |= "display:none" in value.replace(" ", "").lower()
        elif name == "role":
            bad |= value.lower() in ROLES
            named |= {"form"} & {value.lower()}
            root |= value.lower() in ("main", "article")
        elif name == "itemprop":
            root |= value.lower() == "articlebody"
        elif name in ("class", "id") and tag not in ("html", "body") and tag not in ROOTS:
            for own in value.split():
                parts = [w.lower() for w in _PARTS.findall(own)]
                if parts and parts[0] not in NOT_OWN:
                    named |= {w for w in parts if w in HINTS or (w == "header" and not in_root)}
    return bad, root and not bad, named


def _root_hint(attributes: list[tuple[str, str]]) -> bool:
    return any(n in ("class", "id") and {w.lower() for w in _PARTS.findall(v)} & ROOT_HINTS for n, v in attributes)


def _raw_end(page: str, tag: str, at: int) -> int:
    """Where the content of a script or the like ends, with its end tag."""
    m = re.compile(rf"</{tag}(?=[\s/>])", re.I | re.A).search(page, at)
    end = page.find(">", m.end()) if m else -1
    return end + 1 if end >= 0 else len(page)


def _tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, tag or text, attributes) of a page: ``text``, ``open``, ``single`` (closed at once), ``close`` or ``gap``."""
    at, plain = 0, False  # plain: quotes don't count any more
    begin = 0
    while (at := page.find("<", at)) >= 0:
        following = page[at + 1 : at + 2]
        letter = page[at + 2 : at + 3] if following == "/" else following
        if following not in "!?" and not (letter.isascii() and letter.isalpha()) or not following:
            at += 1  # a mere character
            continue
        comment = "-->" if page.startswith("<!--", at) else "]]>" if page.startswith("<![CDATA[", at) else ""
        if comment:
            end = page.find(comment, at + 4)
            end = len(page) if end < 0 else end + 3
            m = None
        else:
            m = _OPEN.match(page, at) if following not in "!?/" and not plain else None
            end = m.end() if m else page.find(">", at) + 1
            if not end:
                break  # no tag ends any more: the rest is text
            plain |= m is None and following not in "!?/"
        if at > begin:
            yield "text", page[begin:at], ""
        if comment == "]]>":
            yield "gap", "", ""
        elif following == "/":
            yield "close", re.match(r"[^\s/>]*", page[at + 2 : end]).group().lower(), ""
        elif following not in "!?":
            name, attributes = (m[1], m[2]) if m else re.match(r"([^\s/>]*)(.*)", page[at + 1 : end - 1], re.S).groups()
            name = name.lower()
            single = attributes.rstrip().endswith("/")
            yield "single" if single else "open", name, attributes
            if name in RAW and not single:
                end = _raw_end(page, name, end)
        at = begin = end
    if begin < len(page):
        yield "text", page[begin:], ""


# a paragraph, item or cell ends where the next one begins
_CLOSES = {"li": ("li", "p"), "dd": ("dd", "dt", "p"), "dt": ("dd", "dt", "p"), "tr": ("tr", "td", "th", "p"), "td": ("td", "th", "p"), "th": ("td", "th", "p"), "option": ("option",)}
_BOUNDS = ("ul", "ol", "dl", "table", "article", "section", "div", "main", "body")


def blocks(page: str) -> list[Block]:
    """The page's blocks in order."""
    out: list[Block] = []
    hinted: list[bool] = []
    suspects: list[Suspect] = []
    parts: list[str] = []
    links = 0
    top = ("", False, False, False, -1)
    stack: list[tuple[str, bool, bool, bool, int]] = []  # tag, in boilerplate, in a root, in an element named like one, in a suspect
    _, bad, root, named, suspect = top
    anchors = roots = 0

    def flush(tag: str) -> None:
        nonlocal links
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(text, min(links, len(text)), tag, "boilerplate" if bad else "root" if root else "", suspect=suspect))
                hinted.append(named)
            parts.clear()
        links = 0

    def innermost() -> str:
        return next((s[0] for s in reversed(stack) if s[0] in BLOCKS), "")

    for kind, tag, raw in _tokens(page):
        if kind == "text":
            text = references.unescape(tag) if "&" in tag else tag
            parts.append(text)
            if anchors:
                links += len(" ".join(text.split()))
        elif kind == "gap":
            parts.append(" ")
        elif kind == "close":
            if any(s[0] == tag for s in stack):
                if tag in BLOCKS:
                    flush(innermost())
                while stack:
                    name = stack[-1][0]
                    if name in BLOCKS and name != tag:
                        flush(name)
                    stack.pop()
                    anchors -= name == "a"
                    if name == tag:
                        break
                _, bad, root, named, suspect = stack[-1] if stack else top
            elif tag in BLOCKS:
                flush(innermost())
        elif tag not in RAW:
            if tag in BLOCKS:
                flush(innermost())
                closes = _CLOSES.get(tag, ("p",))
                k = len(stack) - 1
                while k >= 0 and stack[k][0] not in _BOUNDS and stack[k][0] not in closes:
                    k -= 1
                if k >= 0 and stack[k][0] in closes:
                    anchors -= sum(s[0] == "a" for s in stack[k:])
                    del stack[k:]
                    _, bad, root, named, suspect = stack[-1] if stack else top
            elif tag == "br":
                parts.append(" ")
            if tag in VOID or kind == "single" or len(stack) >= DEEPEST:
                continue
            attributes = list(_attributes(raw)) if raw else []
            own_bad, own_root, words = _traits(tag, attributes, root)
            inner = suspect
            if words and not bad and not own_bad:
                suspects.append(Suspect(suspect, words <= LISTS))
                inner = len(suspects) - 1
            if own_root and not root and not bad:
                roots += 1
                k = inner
                while k >= 0:
                    suspects[k].roots += 1
                    k = suspects[k].parent
            stack.append((tag, bad or own_bad, root or own_root, named or _root_hint(attributes), inner))
            _, bad, root, named, suspect = stack[-1]
            anchors += tag == "a"
    flush(innermost())
    _settle(out, suspects, roots)
    if not any(b.within == "root" for b in out) and any(h and b.within == "" for h, b in zip(hinted, out, strict=True)):
        for h, b in zip(hinted, out, strict=True):
            if h and b.within == "":
                b.within = "root"
    return out


def _settle(found: list[Block], suspects: list[Suspect], roots: int) -> None:
    """Blocks in an element that is boilerplate, by what all of the page holds, become boilerplate."""
    free = 0  # characters without links, of the whole page
    for b in found:
        if b.within != "boilerplate":
            free += len(b.text) - b.links
            k = b.suspect
            while k >= 0:
                s = suspects[k]
                s.chars, s.links = s.chars + len(b.text), s.links + b.links
                if b.links <= LISTED * len(b.text):
                    s.longest = max(s.longest, _length(b.text))
                k = s.parent
    for s in suspects:  # parents first
        s.bad = s.parent >= 0 and suspects[s.parent].bad or _is_boilerplate(s, free, roots)
    for b in found:
        if b.suspect >= 0 and suspects[b.suspect].bad:
            b.within = "boilerplate"


def _is_boilerplate(s: Suspect, free: int, roots: int) -> bool:
    """Not so are wrappers: of the page's only articles, or, where no article lies outside, of most of its text without links."""
    most = 2 * (s.chars - s.links) > free
    if (s.roots or most) and s.roots == roots or s.roots and most:
        return False
    return not (s.lists and not s.roots and s.longest >= LONG and s.links <= LISTED * s.chars)


def _stop_density(text: str) -> float:
    words = re.findall(r"\w+", text.lower())
    return sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0


def _length(text: str) -> int:
    return len(text) if text.isascii() else len(text) + len(_WIDE.findall(text))


def _page_density(found: list[Block]) -> float:
    """Density of the listed words over the page's longer blocks of text."""
    texts = [b.text for b in found if b.within != "boilerplate" and b.links / len(b.text) <= MANY_LINKS and _length(b.text) >= SHORT]
    return _stop_density(" ".join(texts))


def _first_pass(b: Block, rooted: bool, page: float) -> str:
    if b.within == "boilerplate":
        return "bad"
    inside, outside = b.within == "root", rooted and b.within != "root"
    if b.links / len(b.text) > MANY_LINKS:
        return "open" if inside and b.tag in HEADINGS else "bad"  # a title may link to its page
    length = _length(b.text)
    if length < SHORT:
        return "open"
    if page < LOW:  # the page's language isn't among the listed ones: length and links decide
        return "good" if not outside or length >= LONG else "open"
    density, scale = _stop_density(b.text), min(1.0, page / HIGH)
    if density < LOW * scale:
        return "open" if inside else "bad"
    if outside:
        return "good" if density >= HIGH * scale and length >= LONG else "open"
    return "good" if inside or density >= HIGH * scale or length >= LONG else "open"


def _second_pass(found: list[Block], prior: str) -> None:
    """Open blocks take the label of their neighbours; ``prior`` stands before the first and after the last block, if there is one."""
    decided = [(i, b.label) for i, b in enumerate(found) if b.label != "open"]
    if prior:
        decided = [(-1, prior), *decided, (len(found), prior)]
    at = 0
    for i, b in enumerate(found):
        if b.label != "open":
            continue
        while at < len(decided) and decided[at][0] < i:
            at += 1
        before, after = decided[at - 1] if at else None, decided[at] if at < len(decided) else None
        if before is None and after is None:
            b.label = "good"
        elif before is None or after is None:
            b.label = (before or after)[1]
        elif before[1] == after[1]:
            b.label = before[1]
        elif b.tag in HEADINGS:
            b.label = after[1]  # a heading belongs to what follows
        else:
            b.label = before[1] if i - before[0] < after[0] - i else after[1] if after[0] - i < i - before[0] else "good"


def label(found: list[Block]) -> list[Block]:
    """Both passes; every block gets ``good`` or ``bad``."""
    rooted = any(b.within == "root" for b in found)
    page = _page_density(found)
    for b in found:
        b.label = _first_pass(b, rooted, page)
    if rooted:
        # what is boilerplate by its element is no neighbour within an article
        _second_pass([b for b in found if b.within == "root"], "good")
        _second_pass([b for b in found if b.within != "root"], "bad")
    else:
        _second_pass(found, "")
    return found


def main_text(page: str | None) -> str:
    return "\n\n".join(b.text for b in label(blocks(page or "")) if b.label == "good")


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row of ``pages(page_id, url, html)``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [main_text(page.as_py()) for page in part.column("html")]
                yield {"page_id": part.column("page_id"), "url": part.column("url"), "text": texts, "n_chars": [len(t) for t in texts]}

    return common.over_batches(pages.select("page_id", "url", "html"), "page_id long, url string, text string, n_chars long", work)


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(common.table(spark, sf_dir, "pages"))


# of the pages' form in the tables: one article of headings and paragraphs
ORACLE_SQL = r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*?)(</article>|$)', 1, 's') AS h FROM pages),
b AS (
  SELECT page_id, url, list_filter(list_transform(string_split_regex(h, '</?(?:p|h[1-6]|div|article)(?:\s[^>]*)?>'), lambda x:
    trim(regexp_replace(replace(regexp_replace(replace(replace(replace(replace(regexp_replace(replace(x, '<br>', ' '), '<[^>]*>', '', 'g'),
      '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&#39;', chr(39)), '&amp([^;]|$)', '&amp;\1', 'g'), '&amp;', '&'), '\s+', ' ', 'g'))), lambda x: x <> '') AS t FROM a
)
SELECT page_id, url, array_to_string(t, chr(10) || chr(10)) AS text, length(array_to_string(t, chr(10) || chr(10))) AS n_chars FROM b
"""
