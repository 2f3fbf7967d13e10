"""Operator 1: main text of web pages by wrappers, one for each host, inferred without unions."""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm.common import Scratch

#: Hosts whose wrappers one task keeps before it hands them on; it then starts new ones, which are joined later.
HOSTS_KEPT = 500
#: Joining of one host's wrappers is spread over so many groups first.
SPREAD = 64
#: Elements nested deeper stay open until they end, but their text belongs to the last level, or to the element apart or
#: of the main text below it that holds them.
DEPTH = 50

# Elements of HTML by their part in a page.
HIDDEN = frozenset("script style noscript template head title svg math iframe object audio video canvas map select textarea button".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
SPACE = frozenset("br hr wbr img input td th tr li dt dd option".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BOUND = frozenset("table ul ol dl menu div section article main aside nav body td th".split())
APART = frozenset("nav aside footer form menu dialog".split())
APART_WORDS = frozenset("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies consent disqus footer form login masthead menu nav navbar navigation newsletter notice notices pagination pager popup promo promoted promotion related replies responses share sharing sidebar signup social sponsor sponsored subscribe subscription teaser teasers toolbar widget widgets".split())
HEADER_WORDS = frozenset("header topbar site-header".split())
MAIN_WORDS = frozenset("article content entry main post story text body".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
_MARKED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_RAW = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in ("script", "style", "textarea", "title", "noscript", "template", "svg", "iframe", "select", "button")}


class Element:
    """An element of a page: its label (tag and telling words of class, id and role), children and texts in order."""

    __slots__ = ("label", "tag", "words", "kids", "link_chars", "chars")

    def __init__(self, tag: str, words: tuple[str, ...]) -> None:
        self.tag, self.words, self.kids = tag, words, []
        self.label = tag if not words else f"{tag}.{'.'.join(words)}"
        self.chars = self.link_chars = 0


_KNOWN = APART_WORDS | HEADER_WORDS | MAIN_WORDS


def telling(attributes: str) -> tuple[str, ...]:
    """The words of class, id and role that say what an element is for."""
    if "=" not in attributes:
        return ()
    words = set()
    for match in _MARKED.finditer(attributes):
        words.update(re.split(r"[^a-z]+", next(filter(None, match.groups()), "").lower()))
    return tuple(sorted(words & _KNOWN))


def parsed(page: str) -> Element:
    """The block elements of a page as a tree. Inline elements are part of the text; missing ends are supplied."""
    root = Element("html", ())
    # Open elements: tag, the element of the tree that takes the text, and what that is below DEPTH.
    stack, run, at, links = [("html", root, "")], [], 0, 0

    def flush() -> None:
        text = "".join(run)
        run.clear()
        if text and not text.isspace():
            stack[-1][1].kids.append(text)

    def add(text: str) -> None:
        if text:
            run.append(html.unescape(text) if "&" in text else text)
            size = len(text) - text.count(" ")
            stack[-1][1].chars += size
            if links:
                stack[-1][1].link_chars += size

    while match := _TOKEN.search(page, at):
        add(page[at : match.start()])
        at = match.end()
        closing, tag, attributes = (match[1], match[2], match[3]) if match[2] else (match[4], match[5], match[6])
        if not tag:
            if match[0].startswith("<![CDATA["):
                add(match[0][9:].removesuffix("]]>"))
            continue
        tag = tag.lower()
        if not closing and tag in HIDDEN:
            if tag == "head":
                continue
            end = _RAW.get(tag) or re.compile(rf"</{re.escape(tag)}\s*>", re.I)
            if not attributes.endswith("/") and (stop := end.search(page, at)):
                at = stop.end()
            elif not attributes.endswith("/"):
                at = len(page)
            run.append(" ")
            continue
        if tag in INLINE:
            if tag == "a":
                links = 0 if closing else 1
            continue
        if tag in VOID:
            run.append(" ")
            if tag == "hr":
                flush()
            continue
        if tag in ("html", "body", "head"):
            flush()
            continue
        flush()
        if closing:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    del stack[depth:]
                    break
            links = 0
            continue
        if tag in CLOSES_P:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == "p":
                    del stack[depth:]
                    break
                if stack[depth][0] in BOUND:
                    break
        if tag in SAME:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] in SAME[tag]:
                    del stack[depth:]
                    break
                if stack[depth][0] in BOUND and stack[depth][0] not in ("td", "th"):
                    break
        element = Element(tag, telling(attributes))
        _, outer, within = stack[-1]
        part = ""
        if len(stack) >= DEPTH:
            part = "apart" if apart(element.label, False) else "main" if is_main(element.label) else ""
            if within == "apart" or part in ("", within):
                element, part = outer, within
        if element is not outer:
            outer.kids.append(element)
        if not attributes.endswith("/"):
            stack.append((tag, element, part))
    add(page[at:])
    flush()
    return root


def slots(kids: list) -> tuple[list[str], list[int]]:
    """Labels of children with repeated groups (up to three elements) folded, and the fold of each child."""
    labels, place = [], []
    for kid in kids:
        label = kid.label if isinstance(kid, Element) else "#"
        for back in range(1, min(3, len(labels)) + 1):
            if labels[-back] == label:
                place.append(len(labels) - back)
                break
        else:
            labels.append(label)
            place.append(len(labels) - 1)
    return labels, place


def aligned(a: list[str], b: list[str]) -> list[tuple[int | None, int | None]]:
    """The longest common subsequence of two lists of labels as pairs; None where one side has no partner."""
    if a == b:
        return [(i, i) for i in range(len(a))]
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            table[i][j] = table[i + 1][j + 1] + 1 if a[i] == b[j] else max(table[i + 1][j], table[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif j == len(b) or i < len(a) and table[i + 1][j] >= table[i][j + 1]:
            out.append((i, None))
            i += 1
        else:
            out.append((None, j))
            j += 1
    return out


# A wrapper is a nested list: label, pages, optional, repeated, characters, link characters, the text where it never
# differed (null: it did), children. "#" is a text slot.
LABEL, PAGES, OPTIONAL, REPEATED, CHARS, LINKS, CONSTANT, KIDS = range(8)


def wrapper_of(element: Element | str) -> list:
    """The wrapper of a single page."""
    if isinstance(element, str):
        text = " ".join(element.split())
        return ["#", 1, False, False, len(text), 0, text[:80], []]
    labels, place = slots(element.kids)
    kids: list = [None] * len(labels)
    for kid, at in zip(element.kids, place):
        own = wrapper_of(kid)
        if kids[at] is None:
            kids[at] = own
        else:
            joined(kids[at], own)
            kids[at][REPEATED] = True
            kids[at][PAGES] = 1
    return [element.label, 1, False, False, element.chars, element.link_chars, None, kids]


def joined(a: list, b: list) -> list:
    """Aligns wrapper b into a: what only one has becomes optional, texts that differ become slots."""
    if a[CONSTANT] != b[CONSTANT]:
        a[CONSTANT] = None
    kids = []
    for i, j in aligned([k[LABEL] for k in a[KIDS]], [k[LABEL] for k in b[KIDS]]):
        if j is None:
            kid = a[KIDS][i]
            kid[OPTIONAL] = True
        elif i is None:
            kid = b[KIDS][j]
            kid[OPTIONAL] = True
        else:
            kid = joined(a[KIDS][i], b[KIDS][j])
        # Alignment can bring equal labels together: another repetition.
        same = next((k for k in kids[-3:] if k[LABEL] == kid[LABEL]), None)
        if same is not None:
            pages = max(same[PAGES], kid[PAGES])
            joined(same, kid)
            same[REPEATED], same[PAGES] = True, pages
        else:
            kids.append(kid)
    a[PAGES] += b[PAGES]
    a[OPTIONAL] |= b[OPTIONAL]
    a[REPEATED] |= b[REPEATED]
    a[CHARS] += b[CHARS]
    a[LINKS] += b[LINKS]
    a[KIDS] = kids
    return a


def expression(wrapper: list) -> str:
    """The wrapper as a union-free regular expression."""
    inner = "#TEXT" if wrapper[LABEL] == "#" else f"<{wrapper[LABEL]}>{''.join(map(expression, wrapper[KIDS]))}</>"
    if wrapper[CONSTANT] and wrapper[PAGES] > 1:
        inner = json.dumps(wrapper[CONSTANT])
    mark = "+" if wrapper[REPEATED] else ""
    return f"({inner}){mark}" + "?" * wrapper[OPTIONAL] if mark or wrapper[OPTIONAL] else inner


def apart(label: str, inside: bool) -> bool:
    """Whether an element is not part of an article: menus, adverts, comments and the like."""
    tag, *words = label.split(".")
    if tag in APART or APART_WORDS & set(words) and not (tag in ("article", "main") and "comment" not in words and "comments" not in words):
        return True
    return not inside and (tag == "header" or bool(HEADER_WORDS & set(words)))


def is_main(label: str) -> int:
    tag, *words = label.split(".")
    return 3 if tag == "article" else 2 if tag == "main" or "main" in words else 1 if MAIN_WORDS & set(words) and tag != "p" else 0


def text_size(wrapper: list) -> tuple[int, int]:
    """Characters and link characters below, without elements apart."""
    chars, links = (wrapper[CHARS], wrapper[LINKS])
    for kid in wrapper[KIDS]:
        if kid[LABEL] != "#" and not apart(kid[LABEL], True):
            more = text_size(kid)
            chars, links = chars + more[0], links + more[1]
    return chars, links


def content(wrapper: list) -> set[int]:
    """The wrapper's nodes (by identity) that hold the main text: articles; else main elements; else elements marked as
    content; else the smallest element with most of the text that is not in links."""
    levels: dict[int, list[list]] = {1: [], 2: [], 3: []}

    def look(node: list) -> None:
        for kid in node[KIDS]:
            if kid[LABEL] == "#" or apart(kid[LABEL], False):
                continue
            if level := is_main(kid[LABEL]):
                if text_size(kid)[0]:
                    levels[level].append(kid)
            look(kid)

    look(wrapper)
    for level in (3, 2, 1):
        if levels[level]:
            return {id(node) for node in levels[level]}
    node = wrapper
    while True:
        whole = sum(text_size(node)) or 1
        inner = [k for k in node[KIDS] if k[LABEL] != "#" and not apart(k[LABEL], False) and k[KIDS] and not k[REPEATED]]
        best = max(inner, key=lambda k: text_size(k)[0] - text_size(k)[1], default=None)
        if best is None or text_size(best)[0] - text_size(best)[1] < 0.6 * (whole - 2 * text_size(node)[1]):
            return {id(node)}
        node = best


def extracted(page: Element, wrapper: list, chosen: set[int]) -> list[str]:
    """The blocks of a page that align with the wrapper's chosen nodes, in page order."""
    out: list[str] = []

    def walk(element: Element, node: list | None, inside: bool, plain: bool) -> None:
        labels, place = slots(element.kids)
        partner: list[list | None] = [None] * len(labels)
        if node is not None:
            for i, j in aligned([k[LABEL] for k in node[KIDS]], labels):
                if i is not None and j is not None:
                    partner[j] = node[KIDS][i]
        for kid, at in zip(element.kids, place):
            if isinstance(kid, str):
                if inside:
                    out.append(" ".join(kid.split()))
                continue
            here = partner[at]
            begins = here is not None and id(here) in chosen
            if apart(kid.label, inside) or plain and inside and kid.link_chars * 2 > kid.chars:
                continue
            walk(kid, here, inside or begins, plain)

    marked = id(wrapper) in chosen
    walk(page, wrapper, marked, marked)
    return [x for x in out if x]


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def page_wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper): one wrapper for each host, aligned over all of its pages.

    Each task aligns its pages into one wrapper per host; only wrappers are shuffled, so a host with a third of all pages
    sends one per task. They are joined in two steps, the first spread over groups.
    """

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, list] = {}

        def out() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_arrays(
                [pa.array(kept.keys(), pa.string()), pa.array([json.dumps(w) for w in kept.values()], pa.string())], ["host", "wrapper"])
            kept.clear()
            return rows

        for batch in batches:
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1)):
                page = page.as_py()
                if not page:
                    continue
                own = wrapper_of(parsed(page))
                if host in kept:
                    joined(kept[host], own)
                else:
                    if len(kept) >= HOSTS_KEPT:
                        yield out()
                    kept[host] = own
        if kept:
            yield out()

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        first, *others = sorted(rows.wrapper)
        whole = json.loads(first)
        for other in others:
            joined(whole, json.loads(other))
        return pd.DataFrame({"host": [rows.host.iloc[0]], "wrapper": [json.dumps(whole)]})

    learned = pages.select(host_of(F.col("url")).alias("host"), "html").mapInArrow(learn, "host string, wrapper string")
    part = F.pmod(F.xxhash64("wrapper"), F.lit(SPREAD)).alias("part")
    return (learned.groupBy("host", part).applyInPandas(join, "host string, wrapper string")
            .groupBy("host").applyInPandas(join, "host string, wrapper string"))


def main_text(pages: DataFrame) -> DataFrame:
    """The main text of each page: page_id, url, text, n_chars.

    A host's pages are aligned into a wrapper (see ``page_wrappers``), which names the elements that hold the article; a
    page's blocks that align with them are its text, without menus, adverts, forms, comments and other elements apart. A
    page that has none of the named elements is read by its own wrapper. White space in a block becomes one space; blocks
    are joined by one space. Null or empty html has no text; a null url belongs to a host of its own; null and
    repeated ids are rows like others; empty tables give no rows; other columns are not read. Wrappers are read per
    host by a join that splits hot hosts, not broadcast.
    """
    scratch = Scratch(pages.sparkSession, "pages")
    wrappers = scratch.store("wrappers", page_wrappers(pages))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, tuple[list, set[int]]] = {}
        for batch in batches:
            texts = []
            for page, own in zip(batch.column(2), batch.column(3).to_pylist()):
                page, blocks = page.as_py(), []
                if page:
                    element = parsed(page)
                    if own is not None:
                        if own not in kept:
                            if len(kept) >= HOSTS_KEPT:
                                kept.clear()
                            wrapper = json.loads(own)
                            kept[own] = wrapper, content(wrapper)
                        blocks = extracted(element, *kept[own])
                    if not blocks:
                        mine = wrapper_of(element)
                        blocks = extracted(element, mine, content(mine))
                texts.append(" ".join(blocks))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    rows = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    return (rows.join(wrappers, "host", "left").select("page_id", "url", "html", "wrapper")
            .mapInArrow(read, "page_id long, url string, text string, n_chars long"))


def op1_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return main_text(spark.read.parquet(f"{folder}/pages.parquet"))
