"""Main text of web pages: the slots of their host's template that hold the article."""

from __future__ import annotations

import html
import re
from collections import Counter
from hashlib import blake2b
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starweave.llm import text
from starweave.llm.scratch import Scratch
from starweave.llm.templates import Templates, templates

# Element names of HTML by what they do to text.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "svg", "math", "object"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
    "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong",
    "sub", "sup", "time", "tt", "u", "var",
}
NO_TEXT = RAW | {
    "head", "button", "select", "option", "form", "nav", "aside", "footer", "menu", "dialog", "audio", "video",
    "canvas", "map", "fieldset",
}
MAIN = {"article", "main"}
#: An element of a kind ends an open one of these kinds.
ENDS = {
    "p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "option": {"option"},
    "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"},
}
CLOSES_P = {
    "address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4",
    "h5", "h6", "header", "hr", "main", "nav", "ol", "pre", "section", "table", "ul", "figure", "details",
}
#: Elements that a start tag inside them does not end from within.
SCOPE = {"table", "ul", "ol", "dl", "td", "th", "div", "section", "article", "main", "aside", "nav", "body", "blockquote"}
#: Classes, ids and roles that mark what is not the article, and elements on which they say
#: something else, as those of a whole page or a heading.
UNMARKED = {"html", "body", "main", "article", "h1", "h2", "h3", "h4", "h5", "h6"}
MARKS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs",
    "comment", "comments", "contentinfo", "consent", "cookie", "cookies", "disqus", "footer", "gdpr", "header",
    "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "pagination",
    "popup", "promo", "related", "respond", "search", "share", "sharing", "sidebar", "skip", "social", "sponsor",
    "sponsored", "subscribe", "toolbar", "widget",
}

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTE = re.compile(r"""[\s/]*(?:([^\s=/>][^\s=/>]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?)?""")
_SPACE = re.compile(r"\s+")


def _tag(page: str, at: int) -> tuple[str, dict[str, str], int]:
    """Name, marking attributes and end of the tag whose name is at ``at``; the end of
    the page if it is not closed."""
    name = _NAME.match(page, at)
    at, found = name.end(), {}
    while True:
        if page.startswith(">", at):
            return name[0].lower(), found, at + 1
        m = _ATTRIBUTE.match(page, at)
        if m.end() == at or m.end() >= len(page):
            end = page.find(">", m.end())
            return name[0].lower(), found, len(page) if end < 0 else end + 1
        if m[1] and m[1].lower() in ("class", "id", "role", "hidden"):
            found[m[1].lower()] = m[2] or m[3] or m[4] or ""
        at = m.end()


def _tokens(page: str):
    """Texts and tags: ("text", value), ("open", name, attributes) or ("close", name)."""
    at = 0
    while at < len(page):
        sign = page.find("<", at)
        if sign < 0:
            yield ("text", page[at:])
            return
        if sign > at:
            yield ("text", page[at:sign])
        after = page[sign + 1 : sign + 2]
        if page.startswith("<!--", sign):
            end = page.find("-->", sign + 4)
            at = len(page) if end < 0 else end + 3
        elif after in ("!", "?"):
            end = page.find(">", sign)
            at = len(page) if end < 0 else end + 1
        elif after == "/" and _NAME.match(page, sign + 2):
            name, _, at = _tag(page, sign + 2)
            yield ("close", name)
        elif _NAME.match(page, sign + 1):
            name, attributes, at = _tag(page, sign + 1)
            yield ("open", name, attributes)
            if name in RAW and name not in ("svg", "math", "object"):
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.IGNORECASE).search(page, at)
                at = len(page) if end is None else end.start()
        else:
            yield ("text", "<")
            at = sign + 1


def _marks(name: str, attributes: dict[str, str]) -> bool:
    if name in UNMARKED:
        return False
    if "hidden" in attributes:
        return True
    return any(not MARKS.isdisjoint(v.lower().split()) for v in attributes.values())


def _key(*parts: str) -> int:
    digest = blake2b("\0".join(parts).encode("utf-8", "replace"), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


class Block(NamedTuple):
    """Text between two tags that break lines. ``free`` is false inside elements that are
    menus, forms and the like by name or mark; ``main`` tells whether an article element
    encloses it; ``linked`` and ``size`` count characters of links and of all; ``at`` is its
    place among the page's tokens."""

    text: str
    at: int
    path: int
    free: bool
    main: bool
    headline: bool
    linked: int
    size: int


def blocks(page: str, marks: bool = True) -> tuple[list[Block], dict[int, list[int]]]:
    """Blocks of text of a page in order, with character references decoded and white space
    made one space, and the places of each of its tokens.

    A token is an element with its path, or a text with the path that it stands at. A page of
    which marks leave nothing (of its article elements, if it has text in any) is cut
    without them.
    """
    out: list[Block] = []
    places: dict[int, list[int]] = {}
    # Open elements: name, hash of the path, no article, in main.
    stack: list[tuple[str, int, bool, bool]] = [("", 0, False, False)]
    is_open: Counter[str] = Counter()
    parts: list[str] = []
    linked = total = at = 0

    def place(token: int) -> int:
        nonlocal at
        places.setdefault(token, []).append(at)
        at += 1
        return at - 1

    def flush():
        nonlocal linked, total
        if parts:
            body = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
            if body:
                _, path, off, main = stack[-1]
                spot = place(_key("text", str(path), body))
                out.append(Block(body, spot, path, not off, main, is_open["h1"] > 0, linked, total))
            parts.clear()
        linked = total = 0

    def close(depth: int):
        if any(e[0] not in INLINE for e in stack[depth:]):
            flush()
        is_open.subtract(e[0] for e in stack[depth:])
        del stack[depth:]

    for token in _tokens(page):
        if token[0] == "text":
            if stack[-1][0] not in RAW:
                parts.append(token[1])
                total += len(token[1])
                linked += len(token[1]) if is_open["a"] > 0 else 0
        elif token[0] == "open":
            name, attributes = token[1], token[2]
            if name == "br":
                parts.append(" ")
                continue
            ends = ENDS.get(name, set()) | ({"p"} if name in CLOSES_P else set())
            if any(is_open[e] for e in ends):
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth][0] in ends:
                        close(depth)
                        break
                    if stack[depth][0] in SCOPE:
                        break
            if name not in INLINE:
                flush()
            if name in VOID:
                continue
            _, path, off, main = stack[-1]
            if name not in INLINE:
                # The hash of the path to the element is its token.
                path = _key(str(path), name, attributes.get("class", ""), attributes.get("id", ""))
                place(path)
            header = name == "header" and not main
            off = off or name in NO_TEXT or header or marks and _marks(name, attributes)
            stack.append((name, path, off, main or name in MAIN))
            is_open[name] += 1
        elif is_open[token[1]]:
            name = token[1]
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == name:
                    close(depth)
                    break
                if name in INLINE and stack[depth][0] not in INLINE:
                    break  # a stray end tag
    flush()
    inside = [b for b in out if b.main] or out
    if marks and inside and not any(b.free for b in inside):
        return blocks(page, False)
    return out, places


# Columns of the blocks: their name, field and type.
_COLUMNS = [
    ("texts", "text", "string"), ("places", "at", "int"), ("paths", "path", "long"), ("free", "free", "boolean"),
    ("main", "main", "boolean"), ("headline", "headline", "boolean"), ("linked", "linked", "int"), ("sizes", "size", "int"),
]
_ARROW = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_()}


def _parse(batches):
    for batch in text.blocks(batches, "html"):
        made = [blocks(page or "") for page in batch.column("html").to_pylist()]
        columns = {
            "_row": batch.column("_row"),
            "host": batch.column("host"),
            "body": pa.array([_key(*(f"{b.path} {b.text}" for b in found)) for found, _ in made], pa.int64()),
            "tokens": pa.array([list(p) for _, p in made], pa.list_(pa.int64())),
            "ats": pa.array([list(p.values()) for _, p in made], pa.list_(pa.list_(pa.int32()))),
        }
        for name, field, kind in _COLUMNS:
            values = [[getattr(b, field) for b in found] for found, _ in made]
            columns[name] = pa.array(values, pa.list_(_ARROW[kind]))
        yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def article(found: list[Block], slots: dict[int, tuple[int, int] | None], links: set[tuple[int, int]]) -> str:
    """Texts of the blocks that are the article's, one a line.

    ``slots`` has a slot for each place, or None for the template's own texts; it is empty for a
    page without a template, whose slots are the paths of its blocks.
    """
    if not slots:
        sums: dict[int, list[int]] = {}
        for b in found:
            s = sums.setdefault(b.path, [0, 0])
            s[0] += b.linked
            s[1] += b.size
        menus = {p for p, (linked, size) in sums.items() if 2 * linked > size}
    region = [b for b in found if b.free]
    if any(b.main for b in region):
        region = [b for b in region if b.main or b.headline]
    free = [b for b in region if not slots or slots[b.at] is not None]
    free = free or region
    kept = [b for b in free if b.main or b.headline or not (slots[b.at] in links if slots else b.path in menus)]
    return "\n".join(b.text for b in kept or free)


def _articles(batches):
    made = Templates()
    for batch in batches:
        names = ["host", "tokens", "ats", *(c for c, _, _ in _COLUMNS)]
        out = []
        known = batch.column("roles").is_valid().to_pylist()
        for i, r in enumerate(batch.select(names).to_pylist()):
            found = [Block(*values) for values in zip(*(r[c] for c, _, _ in _COLUMNS))]
            slots, links = {}, set()
            if known[i]:
                template = made(batch, i, r["host"])
                _, slots = template.walk(r["tokens"], r["ats"], r["places"])
                links = template.links
            out.append(article(found, slots, links))
        yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(out, pa.string())], names=["_row", "text"])


def main_text(pages: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """All rows as ``_row`` (without html) with the ``text`` of the article.

    Pages are cut into blocks in one pass. Blocks that are menus, forms, notices and the
    like by their element or its marks are left out, and so are the texts of the host's template
    and, outside ``article`` and ``main`` elements, slots whose texts are mostly links over all pages of the
    host. Of a page with such an element what is inside is taken, and first-level headings outside; else all
    blocks. If nothing is left, the template's texts or the links are not taken away.

    Null html is an empty page with an empty text. Pages without a host in their url
    and those of hosts with one or two different pages have no template; their slots are the paths of
    their own blocks. Repeated rows each have their text. An empty table gives no rows. Blocks are joined by line ends.
    """
    scratch = scratch or Scratch(pages.sparkSession, "pages")
    url = F.lower(F.coalesce(F.col("url").cast("string"), F.lit("")))
    host = F.regexp_extract(url, r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    rows = pages.select(
        F.struct(*(F.col(f"`{c}`") for c in pages.columns if c != "html")).alias("_row"),
        host.alias("host"),
        F.col("html").cast("string").alias("html"),
    )
    kind = rows.schema["_row"].dataType.simpleString()
    columns = ", ".join(f"{name} array<{of}>" for name, _, of in _COLUMNS)
    parsed = scratch.keep(
        rows.mapInArrow(
            _parse, f"_row {kind}, host string, body long, tokens array<long>, ats array<array<int>>, {columns}"
        ),
        "parsed",
    )
    template = templates(parsed, scratch)
    joined = parsed.drop("body").join(template, F.col("host") == F.col("_host"), "left").drop("_host")
    return joined.mapInArrow(_articles, f"_row {kind}, text string")
