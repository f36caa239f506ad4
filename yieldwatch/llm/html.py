"""Main text of web pages by paths that the pages of a host agree on.

A page is parsed into blocks of text, each with the path of its container: tags with their
classes, digits generalised, from the outside in. Every container of the page is scored by
the text below it, links counting against it; the page votes for its best path. Per host,
Spark counts the votes; paths with at least a fifth of them win, so a host has five at
most. Each page is then extracted again by the winning path it has with the most votes, or
by its own best where it has none, so a page whose comments outweigh its article still
yields the article.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader
comments are left out by tag, role, class or id before anything is scored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yieldwatch.llm.columns import free_name, without
from yieldwatch.llm.urls import host_of
from yieldwatch.sources.scratch import settle

#: Share of a host's votes that a winning path needs.
SHARE = 0.2
#: Open elements at once, steps of a path and letters of a step's classes; beyond, deeper
#: elements count as their outer one and classes as their hash. No text is left out for it.
DEEPEST = 512
LONGEST_PATH = 64
LONGEST_NAMES = 48
ROOT_FACTOR = 0.7

# Elements by their meaning in HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
#: Elements that begin and end a block of text and are steps of a path; all others are inline.
BLOCK = set(
    "html head body address article aside blockquote caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup legend li main menu nav ol optgroup option p pre search section "
    "summary table tbody td tfoot th thead title tr ul".split()
)
LEFT_OUT = set(
    "head nav footer aside form script style noscript template iframe button select option textarea title search "
    "dialog menu svg math canvas object audio video xmp noembed noframes datalist map".split()
)
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = HEADINGS | {"p", "li"}
#: Elements that an opening tag ends, unless one of the second set lies between.
P_SCOPE = {"button", "td", "th", "caption", "table", "object"}
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
# Words of a class or an id that tell what an element is for, and beginnings of such words.
ASIDE_WORDS = set(
    "ad ads adv banner promo comment comments respond reply replies gdpr consent notice notices notification alert popup "
    "modal overlay subscribe subscription signup login share sharing social related recommended pager nav menu masthead "
    "widget toolbar skip search form aside rail disclaimer legal copyright announcement toast teaser".split()
)
ASIDE_BEGINNINGS = tuple("advert adsby banner breadcrumb comment cookie disqus footer navbar navigation newsletter pagination popup sidebar sponsor".split())
ASIDE_ENDINGS = tuple("nav menu sidebar footer banner comments".split())
#: What an <article> is not: its other words name the article's topic or layout.
NO_ARTICLE = ("comment", "advert", "promo", "related", "sponsor", "teaser")
HEADER_WORDS = {"header", "topbar"}
ARTICLE_WORDS = set("article entry post story".split())
TEXT_WORDS = ARTICLE_WORDS | set("body content main prose text".split())
WHOLE = {"html", "body", "main"}

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)"""  # a comment
    r"""|<(/?)([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=)*+)>"""  # a tag
    r"""|<[!?/][^>]*+>"""  # a declaration
    r"""|<[A-Za-z!?/][^>]*+\Z""",  # cut off
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
_DIGITS = re.compile(r"[0-9]+")

BLOCKS = "array<struct<path:string,text:string>>"


def _words(name: str) -> list[str]:
    """The words of a class name or an id; what follows `has`, `with`, `no` or `without` is dropped."""
    out, negated = [], False
    for word in _WORD.findall(name):
        word = word.lower()
        if word in ("has", "with", "no", "without"):
            negated = True
        elif not negated:
            out.append(word)
    return out


class _Element:
    """An open element; left_out, link and article also hold for what is inside."""

    __slots__ = ("article", "block", "factor", "left_out", "link", "path", "steps", "tag")

    def __init__(self, tag: str) -> None:
        self.tag, self.path, self.steps, self.factor = tag, "", 0, ROOT_FACTOR
        self.block, self.left_out, self.link, self.article = True, False, False, False


def _attributes(text: str) -> dict[str, str]:
    if not text or text.isspace():
        return {}
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in reversed(list(_ATTRIBUTE.finditer(text)))}


def _for_something_else(tag: str, found: dict[str, str], inside_article: bool) -> bool:
    """True for an element that is not part of the main text, whatever it holds."""
    if tag in LEFT_OUT or (tag == "header" and not inside_article):
        return True
    if not found or tag in WHOLE:
        return False
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or found.get("role", "").lower() in ROLES:
        return True
    if re.search(r"display\s*:\s*none", found.get("style", ""), re.I):
        return True
    for name in [*found.get("class", "").split(), *found.get("id", "").split()]:
        words = set(_words(name))
        if tag == "article":
            if any(w.startswith(NO_ARTICLE) for w in words):
                return True
            continue
        if words & ASIDE_WORDS or any(w.startswith(ASIDE_BEGINNINGS) or w.endswith(ASIDE_ENDINGS) for w in words):
            return True
        if words & HEADER_WORDS and not (inside_article or tag in HEADINGS or words & ARTICLE_WORDS):
            return True
    return False


def _step(tag: str, classes: list[str]) -> str:
    """A container's step of the path: its tag and generalised classes, long ones by their hash."""
    names = ".".join(classes)
    if len(names) > LONGEST_NAMES:
        names = hashlib.md5(names.encode(), usedforsecurity=False).hexdigest()
    return f"{tag}.{names}".replace("/", "_") if names else tag


def _factor(tag: str, classes: list[str]) -> float:
    """How much more the text of a container counts for what the container says of itself."""
    if tag == "article":
        return 3.0
    factor = {"main": 1.3, "body": 0.8, "html": ROOT_FACTOR}.get(tag, 1.0)
    return factor * (1.3 if any(TEXT_WORDS & set(_words(c)) for c in classes) else 1.0)


class Page:
    """blocks: (path, text) in page order. scores: of each path that holds text."""

    def __init__(self, html: str | None) -> None:
        self.blocks: list[tuple[str, str]] = []
        self.scores: dict[str, float] = {}
        self._stack = [_Element("")]
        self._pieces: list[str] = []
        self._linked = 0
        self._parse(html or "")
        self._flush()

    def best(self) -> str | None:
        """The path with the largest score; the deepest, then the first by name, among equals."""
        if not self.scores:
            return None
        return min(self.scores, key=lambda p: (-self.scores[p], -p.count("/"), p))

    def _parse(self, html: str) -> None:
        place, n = 0, len(html)
        while place < n:
            found = _TAG.search(html, place)
            if found is None:
                self._text(html[place:])
                return
            if found.start() > place:
                self._text(html[place : found.start()])
            place = found.end()
            if found[2] is None:
                continue  # a comment or a declaration
            tag, rest = found[2].lower(), found[3]
            if found[1]:
                self._close(tag)
                continue
            self._open(tag, rest)
            if tag in RAW:
                end = re.compile(f"</{tag}(?=[\\s/>])[^>]*>", re.I).search(html, place)
                place = end.end() if end else n
                self._close(tag)

    def _text(self, raw: str) -> None:
        top = self._stack[-1]
        if top.left_out:
            return
        text = unescape(raw) if "&" in raw else raw
        self._pieces.append(text)
        if top.link:
            self._linked += len(text)

    def _flush(self) -> None:
        """End the block of text before this place."""
        if not self._pieces:
            return
        text = " ".join("".join(self._pieces).split())
        linked, self._pieces, self._linked = self._linked, [], 0
        if not text:
            return
        self.blocks.append((self._stack[-1].path, text))
        credit, seen = len(text) - 2 * min(linked, len(text)), set()
        for element in self._stack:
            # A paragraph is no container; beyond the longest path elements share one.
            if element.tag in PARAGRAPHS:
                break
            if element.path not in seen:
                seen.add(element.path)
                self.scores[element.path] = self.scores.get(element.path, 0.0) + credit * element.factor

    def _open(self, tag: str, rest: str) -> None:
        stack = self._stack
        if tag in VOID:
            self._between(tag)
            return
        block = tag in BLOCK
        if block:
            self._flush()
            self._end({"p"}, P_SCOPE)
            if tag in ENDS:
                self._end(*ENDS[tag])
        elif rest.endswith("/") and tag not in RAW:
            return  # <path/> and the like hold nothing
        if len(stack) >= DEEPEST:
            return  # as in browsers: what comes is read as if one level higher
        found, top, element = _attributes(rest), stack[-1], _Element(tag)
        element.block, element.link = block, top.link or tag == "a"
        element.article = top.article or tag == "article"
        element.left_out = top.left_out or _for_something_else(tag, found, top.article)
        element.path, element.steps, element.factor = top.path, top.steps, top.factor
        if block and top.steps < LONGEST_PATH:
            classes = sorted({_DIGITS.sub("#", c.lower()) for c in found.get("class", "").split()})
            element.path = f"{top.path}/{_step(tag, classes)}"
            element.steps += 1
            element.factor = _factor(tag, classes)
        stack.append(element)

    def _between(self, tag: str) -> None:
        if tag == "br":
            self._text(" ")
        elif tag == "hr":
            self._flush()

    def _end(self, tags: set[str], scope: set[str]) -> None:
        """End the innermost open element of these tags, unless one of `scope` lies between."""
        for i in range(len(self._stack) - 1, 0, -1):
            if self._stack[i].tag in tags:
                self._flush()
                del self._stack[i:]
                return
            if self._stack[i].tag in scope:
                return

    def _close(self, tag: str) -> None:
        if tag in VOID:
            self._between(tag)
        elif tag not in BLOCK:
            # An inline element ends inside its block.
            for i in range(len(self._stack) - 1, 0, -1):
                if self._stack[i].tag == tag:
                    del self._stack[i:]
                    return
                if self._stack[i].block:
                    return
        else:
            self._flush()
            cells = {"td", "th", "caption"} - {tag}
            self._end({tag}, set() if tag in ("table", "tr", "tbody", "thead", "tfoot") else cells)


def parse_pages(df: DataFrame, html: str, blocks: str, best: str) -> DataFrame:
    """All columns but `html`, with the page's blocks and its best path (null without text)."""
    kept = without(df, [html, blocks, best])
    source = free_name(df, "_html")
    rows = df.select(*kept, F.col(html).cast("string").alias(source))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("path", pa.string()), ("text", pa.string())]))
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for first, last in _runs(texts):
                part = batch.slice(first, last - first)
                pages = [Page(texts[i].as_py()) for i in range(first, last)]
                found = [[{"path": p, "text": t} for p, t in page.blocks] for page in pages]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(found, kind), pa.array([page.best() for page in pages], pa.string())],
                    [*part.schema.names[:-1], blocks, best],
                )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    return rows.mapInArrow(task, ", ".join([*fields, f"`{blocks}` {BLOCKS}", f"`{best}` string"]))


#: Bytes of HTML that are parsed before their blocks are sent on; one longer page is alone.
PART_BYTES = 4 << 20


def _runs(texts: pa.Array) -> Iterator[tuple[int, int]]:
    first, held = 0, 0
    for i in range(len(texts)):
        size = texts[i].as_buffer().size if texts[i].is_valid else 0
        if i > first and held + size > PART_BYTES:
            yield first, i
            first, held = i, 0
        held += size
    if first < len(texts):
        yield first, len(texts)


def winning_paths(parsed: DataFrame, host: str, best: str) -> DataFrame:
    """host and `paths`: those with at least SHARE of the host's votes, most votes first,
    then by name. One row per host that has a vote; hosts and paths are counted, not gathered."""
    votes = parsed.filter(F.col(best).isNotNull()).groupBy(host, best).agg(F.count("*").alias("votes"))
    totals = votes.groupBy(host).agg(F.sum("votes").alias("total"))
    won = votes.join(totals, host).filter(F.col("votes") >= SHARE * F.col("total"))
    entry = F.struct((-F.col("votes")).alias("votes"), F.col(best).alias("path"))
    ranked = won.groupBy(host).agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    return ranked.select(host, F.col("entries.path").alias("paths"))


def _within(block: Column, path: Column) -> Column:
    return (block["path"] == path) | F.startswith(block["path"], F.concat(path, F.lit("/")))


def extract(df: DataFrame, html: str = "html", url: str = "url", out: str = "text") -> DataFrame:
    """All columns but `html`, with the main text in `out`: blocks in page order, joined by
    two line ends, white space inside a block turned into one space.

    A null or empty page, or one without main text, has an empty text; its other columns
    may be null. Pages whose url is null or has no host vote together as one host. Repeated
    rows stay. Without rows there are none. Any length of page is parsed whole; characters
    are decoded as browsers do, unknown references stay as they are. A column named like
    `out` is replaced. Runs jobs: the blocks are written to the shared folder once.
    """
    blocks, best, host, paths, path = (free_name(df, n) for n in ("_blocks", "_best", "_host", "_paths", "_path"))
    parsed = parse_pages(df.withColumn(host, F.coalesce(host_of(F.col(url)), F.lit(""))), html, blocks, best)
    parsed = settle(parsed)
    # Written, so that the planner knows the size and does not broadcast a large one.
    winners = settle(winning_paths(parsed, host, best).withColumnRenamed("paths", paths))
    joined = parsed.join(winners, host, "left")
    has = F.filter(F.col(paths), lambda p: F.exists(F.col(blocks), lambda b: _within(b, p)))
    chosen = joined.withColumn(path, F.coalesce(F.get(has, F.lit(0)), F.col(best)))
    kept = F.filter(F.col(blocks), lambda b: _within(b, F.col(path)))
    text = F.coalesce(F.array_join(F.transform(kept, lambda b: b["text"]), "\n\n"), F.lit(""))
    return chosen.select(*[c for c in without(df, [html, out])], text.alias(out))
