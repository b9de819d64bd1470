"""Main text of web pages by consensus host paths.

A first pass scores the containers of every page and takes the generalised tag-class path of
its best one as the page's vote. Spark counts the votes per host; a second pass extracts every
page again from the containers on its host's winning path. A page that has none of them, or little text
in them beside its own best container, falls back on that one.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickloom.llm.common import map_batches, strings
from tickloom.llm.url_filter import host_of
from tickloom.session import materialize

#: One piece of markup: comment, declaration, or tag (closing mark, name, attributes).
MARKUP = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)(?:>|\Z)""", re.S)
NAMED = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
#: The heading that a container begins with.
FIRST_HEADING = re.compile(r"(?:\s|<(?:a|span|header|div)\b[^>]*>|</(?:a|span)>){0,50}<(h[1-6])\b[^>]*>(.{0,1000}?)</\1", re.S | re.I)
CLASS = re.compile(r"""(?<![\w-])class\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORD = re.compile(r"[a-z]+")
TAG = re.compile(r"<[^>]*>")
SLUG = re.compile(r"[^\W_]+")
SPACE = re.compile(r"\s+")
#: Kinds of elements in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noframes template svg object select button datalist annotation annotation-xml".split())
#: Of these, the ones that do not reach beyond their block where they are never closed.
IN_BLOCK = frozenset("svg object select button datalist annotation annotation-xml".split())
BLOCKS = frozenset(
    "html body main article section div nav header footer aside form fieldset menu dialog search p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th "
    "caption blockquote pre figure figcaption details summary address hr center legend".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTAINERS = frozenset("html body main article section div td blockquote figure details center nav header footer aside form".split())
#: Blocks that may be boilerplate as a whole inside an article.
PARTS = CONTAINERS | frozenset("ul ol dl table".split())
#: Elements that an opening tag of the same group closes, up to the next container.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
#: What is never part of the main text: by tag, and by a word of the class, id or role.
DROP_TAGS = frozenset("nav footer aside menu dialog search head".split())
DROP_WORDS = frozenset(
    "nav navbar navigation menu header masthead footer sidebar aside ad ads advert adverts advertisement advertising banner promo promotion sponsor sponsored "
    "notice notices cookie cookies consent gdpr comment comments disqus reply replies respond share sharing social related recommended breadcrumb breadcrumbs "
    "newsletter subscribe signup login search popup modal overlay widget toolbar pagination pager copyright form contentinfo complementary alert".split()
)
#: Of these, the ones that tell nothing about a single paragraph, heading or inline element.
SOFT_WORDS = frozenset("header notice notices comment comments reply replies respond share social related search copyright form alert menu response".split())
#: Words that say where a part stands or how it is built: with a word of DROP_WORDS they are its class.
PLACES = frozenset(
    "site main top bottom left right primary secondary box block wrapper wrap container inner outer area bar list links link buttons button items item posts articles "
    "global mobile sticky fixed slot unit zone col column row toggle dropdown collapse panel group holder frame".split()
)
#: Characters of text for each field or button of a form that is part of the page's text, as one that holds the whole page.
FORM_TEXT = 200
FORM_EDGE = re.compile(r"</?form(?=[\s/>])", re.I)
CODE = re.compile(r"<(script|style)\b.*?(?:</\1\b|\Z)", re.S | re.I)
CONTROL = re.compile(r"""<(?:input\b(?![^>]*type\s*=\s*["']?hidden)|select\b|textarea\b|button\b)""", re.I)
#: Share of a container's score that its parent gets, and the weight of elements that are meant for the main text.
UPWARD = 0.6
MEANT = {"article": 1.5, "main": 1.3}
#: A page whose containers on the winning path have less than this share of its own best score has another template.
LITTLE = 0.2


@dataclass
class Element:
    tag: str
    path: bytes  # digest of the parent's path and the own step
    parent: int
    dropped: bool
    score: float = 0.0


@dataclass
class Page:
    """Containers in page order, and blocks as (container, text, characters in links, dropped)."""

    elements: list[Element] = field(default_factory=lambda: [Element("", b"", -1, False)])
    blocks: list[tuple[int, str, int, bool]] = field(default_factory=list)


def _is_title(name: str, page: str, at: int) -> bool:
    """Whether an id is only the slug of the heading that its element, whose content begins at `at`, begins with."""
    found = FIRST_HEADING.match(page, at)
    return found is not None and SLUG.findall(entities.unescape(TAG.sub("", found[2])).lower()) == SLUG.findall(name.lower())


def _boilerplate(tag: str, attributes: str, in_article: bool, page: str, at: int) -> bool:
    """Whether an element is boilerplate by its tag or by its class, id or role; its content begins at `at` of the page.

    Whole classes, ids and roles of blocks that hold others tell; outside of articles also those that join such a word with
    a place ("top-menu"), and those of other elements, but for words that are mostly about the text ("alert"). Ids made
    from titles never tell. A form is boilerplate unless it holds far more text than fields.
    """
    if tag in DROP_TAGS or (tag == "header" and not in_article) or (tag == "form" and not _holds_text(page, at)):
        return True
    if "=" not in attributes or tag in ("body", "html", "article", "main") or in_article and tag not in PARTS:
        return False
    for m in NAMED.finditer(attributes):
        value, kind = (m[2] or m[3] or m[4] or "").lower(), m[1].lower()
        words = set(value.split()) & DROP_WORDS
        if in_article:
            words.discard("header")
        else:
            telling = DROP_WORDS if tag in PARTS else DROP_WORDS - SOFT_WORDS
            words = {w for w in value.split() if (parts := set(WORD.findall(w))) & telling and parts <= telling | PLACES}
        if tag in ("form", "fieldset"):
            words.discard("form")
        if words and not (kind == "id" and (tag in HEADINGS or _is_title(value, page, at))):
            return True
    return False


def _holds_text(page: str, at: int) -> bool:
    """Whether the form whose content begins here, up to the next form tag, has much text for its fields."""
    edge = FORM_EDGE.search(page, at)
    inside = page[at : edge.start() if edge else len(page)]
    return len(SPACE.sub(" ", TAG.sub("", CODE.sub("", inside)))) >= FORM_TEXT * (1 + len(CONTROL.findall(inside)))


def _ends(tag: str, page: str) -> dict[int, int]:
    """Where each element of this tag, by the place of its opening tag, ends: behind its closing tag, or at the next block tag where it has none."""
    closed, cut, opened, waiting = {}, {}, [], []
    for m in _marks(tag).finditer(page):
        if not m[2]:
            continue
        if m[2].lower() != tag:
            cut.update(dict.fromkeys(waiting, m.start()))
            waiting.clear()
        elif not m[1] and not m[0].endswith("/>"):
            opened.append(m.start())
            waiting.append(m.start())
        elif m[1] and opened:
            closed[opened.pop()] = m.end()
    return dict.fromkeys(waiting, len(page)) | cut | closed


@cache
def _marks(tag: str) -> re.Pattern:
    """Comments, scripts, and the tags of an element and of blocks."""
    names = "|".join(map(re.escape, [tag, *sorted(BLOCKS)]))
    return re.compile(rf"<!--.*?(?:-->|\Z)|<script\b.*?(?:</script|\Z)|<(/?)({names})(?=[\s/>]|\Z)[^>]*>?", re.I | re.S)


def _step(tag: str, attributes: str) -> str:
    """Tag and generalised classes: sorted words without digits."""
    found = CLASS.search(attributes) if "=" in attributes else None
    words = sorted({w for w in (re.sub(r"[\d_-]+$|\d+", "", c) for c in (found[1] or found[2] or found[3] or "").lower().split()) if w}) if found else []
    return ".".join([tag, *words])


def parse(page: str) -> Page:
    """Containers and text blocks of one page. Unclosed, crossing and cut-off tags are taken as far as they go."""
    out = Page()
    # open elements: (tag, container number, dropped, in article)
    stack: list[tuple[str, int, bool, bool]] = [("", 0, False, False)]
    opened: Counter[str] = Counter()
    buffer: list[str] = []
    linked = links = nested = 0
    muted = ""  # inline element of boilerplate whose text is left out, up to its end or that of its block

    def flush() -> None:
        nonlocal linked
        if buffer:
            text = SPACE.sub(" ", entities.unescape("".join(buffer))).strip()
            if text:
                out.blocks.append((stack[-1][1], text, linked, stack[-1][2]))
            buffer.clear()
        linked = 0

    def leave(k: int) -> None:
        """The k-th open element and all in it end."""
        opened.subtract(tag for tag, *_ in stack[k:])
        del stack[k:]

    raw: dict[str, dict[int, int]] = {}
    at, end = 0, len(page)
    while at < end:
        m = MARKUP.search(page, at)
        begin = m.start() if m else end
        if begin > at and not muted:
            buffer.append(page[at:begin])
            if links:
                linked += begin - at
        if not m:
            break
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        tag, closing, attributes = name.lower(), m[1] or m[4], m[3] or m[6] or ""
        if tag in RAW:
            if tag in ("select", "button", "datalist", "svg", "object", "title"):
                buffer.append(" ")
            if not closing and not attributes.endswith("/"):
                if tag in IN_BLOCK:
                    if tag not in raw:
                        raw[tag] = _ends(tag, page)
                    at = max(at, raw[tag].get(begin, at))
                else:
                    close = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*>?", re.I).search(page, at)
                    at = close.end() if close else end
        elif tag == "a" and not muted:
            links = 0 if closing else 1
            if links and "=" in attributes and _boilerplate(tag, attributes, stack[-1][3], page, at):
                muted, nested = tag, 1
        elif tag == "br":
            buffer.append(" ")
        elif tag in BLOCKS or tag == "head":
            flush()
            links, muted = 0, ""
            if tag in VOID:
                continue
            if closing:
                for k in range(len(stack) - 1, 0, -1) if opened[tag] > 0 else ():
                    if stack[k][0] == tag:
                        leave(k)
                        break
                    if tag not in CONTAINERS and stack[k][0] in CONTAINERS:
                        break
                continue
            closes = CLOSES.get(tag, ())
            if tag not in ("p", "li", "dt", "dd", "tr", "td", "th") and stack[-1][0] == "p":
                leave(len(stack) - 1)
            for k in range(len(stack) - 1, 0, -1) if any(opened[x] > 0 for x in closes) else ():
                if stack[k][0] in closes:
                    leave(k)
                    break
                if stack[k][0] in CONTAINERS and stack[k][0] not in ("td",) or stack[k][0] in ("ul", "ol", "table"):
                    break
            if tag == "body" and stack[-1][0] == "head":
                leave(len(stack) - 1)
            _, container, dropped, in_article = stack[-1]
            dropped = dropped or _boilerplate(tag, attributes, in_article, page, at)
            if tag in CONTAINERS:
                path = hashlib.blake2b(out.elements[container].path + _step(tag, attributes).encode("utf-8", "replace"), digest_size=16).digest()
                out.elements.append(Element(tag, path, container, dropped))
                container = len(out.elements) - 1
            stack.append((tag, container, dropped, in_article or tag in ("article", "main")))
            opened[tag] += 1
        elif tag == muted:
            nested += -1 if closing else 1
            muted = muted if nested else ""
        elif tag not in VOID and not closing and not muted and "=" in attributes and _boilerplate(tag, attributes, stack[-1][3], page, at):
            muted, nested = tag, 1
    flush()
    return out


def path_scores(page: Page) -> dict[bytes, float]:
    """The highest score of each path's containers: their blocks' characters outside links, less those in links,
    and a falling share of what their descendants have. In page order; paths without any text are left out."""
    for element in page.elements:
        element.score = 0.0
    for container, text, linked, dropped in page.blocks:
        if not dropped:
            page.elements[container].score += len(text) - 2 * linked
    for element in reversed(page.elements[1:]):  # children stand behind their parents
        page.elements[element.parent].score += UPWARD * element.score
    out: dict[bytes, float] = {}
    for e in page.elements:
        if not e.dropped and e.score > 0:
            out[e.path] = max(out.get(e.path, 0.0), e.score * MEANT.get(e.tag, 1.0))
    return out


def best_path(page: Page) -> bytes | None:
    """Path of the container with the highest score. Ties go to the first. None without any text."""
    found = path_scores(page)
    return max(found, key=found.__getitem__) if found else None


def text_by(page: Page, path: bytes | None) -> str:
    """Text on the host's winning path; on the page's own best one where the page has little or nothing there."""
    found = path_scores(page)
    if not found:
        return (text_of(page, path) if path is not None else None) or ""
    own = max(found, key=found.__getitem__)
    # A path may be that of several containers, which are all part of the text.
    there = sum(e.score * MEANT.get(e.tag, 1.0) for e in page.elements if e.path == path and not e.dropped and e.score > 0)
    text = text_of(page, path) if path is not None and there >= LITTLE * found[own] else None
    return text or text_of(page, own) or ""


def text_of(page: Page, path: bytes) -> str | None:
    """Blocks in containers on this path, in page order, without boilerplate; None if the page has no such container."""
    inside = set()
    for k, e in enumerate(page.elements):
        if e.parent in inside or e.path == path and not e.dropped:
            inside.add(k)
    return "\n".join(t for c, t, _, dropped in page.blocks if c in inside and not dropped) if inside else None


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths = [best_path(parse(h)) for h in strings(batch.column(1))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(paths, pa.binary())], names=["host", "path"])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for source, path in zip(strings(batch.column(2)), batch.column(3).to_pylist(), strict=True):
            texts.append(text_by(parse(source), path))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["key", "url", "text"])


def winning_paths(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """`host`, `path`: the path (as a digest) with most votes of each host's pages; of equal votes the last in byte order."""
    rows = pages.select(host_of(F.col(url).cast("string")).alias("host"), F.col(html).cast("string").alias("html"))
    votes = map_batches(rows, _vote, "host string, path binary").where(F.col("path").isNotNull()).groupBy("host", "path").agg(F.count("*").alias("votes"))
    return votes.groupBy("host").agg(F.max_by("path", F.struct("votes", "path")).alias("path"))


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", broadcast_hosts: int = 200_000) -> DataFrame:
    """Main text of every page: the key, `url`, `text` (blocks joined by one line feed; empty if there are none).

    Null and empty pages have an empty text; pages without a host vote among themselves. Repeated rows are each
    extracted; other columns are left out. The winners (one short row per host) are stored and counted, and
    broadcast only up to `broadcast_hosts`; beyond that the join is left to adaptive execution.
    """
    winners = materialize(winning_paths(pages, url, html), "host-paths").select(F.col("host").alias("__host"), "path")
    if winners.count() <= broadcast_hosts:
        winners = F.broadcast(winners)
    said = F.col(url).cast("string")
    rows = pages.select(F.col(key).alias("key"), said.alias("url"), F.col(html).cast("string").alias("html"), host_of(said).alias("__host"))
    joined = rows.join(winners, "__host", "left").select("key", "url", "html", "path")
    kind = pages.schema[key].dataType.simpleString()
    return map_batches(joined, _extract, f"key {kind}, url string, text string").select(F.col("key").alias(key), "url", "text")
