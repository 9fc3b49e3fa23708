"""HTML main text by tree scoring.

A page becomes a tree of elements whose text is gathered in blocks (the text
between two block-level tags). Subtrees that are never part of an article
(menus, forms, notices, adverts, comments, hidden parts) are left out. Every
remaining block then passes points, for its length and its commas, to its
ancestors, less with each step, and an element's points are discounted by the
share of its text that stands in links. The element with most points is the
article's container (or the ``article`` or ``main`` around it); its siblings
are kept when they have points enough or are plain paragraphs of prose.

Defined results: null html is an empty page; a page without kept text gives the
empty string; unclosed and stray tags are repaired the way browsers do for
paragraphs, lists and tables; repeated rows are extracted alike; a null page_id
or url is passed on; other columns are ignored. Pages are read whole, one at a
time, in time linear in their length.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[\s/](?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)?)>"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs2>[^<>]*)>"
    r"|<[!?][^>]*>", re.S)
ATTR = re.compile(r"""([a-zA-Z_:][\w:.-]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")

#: Elements whose content is not markup; it ends at their own closing tag.
RAW = {"script", "style", "textarea", "title", "xmp", "noembed", "noframes", "iframe"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div",
    "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header",
    "hr", "html", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "select", "summary", "table",
    "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
#: What an opening tag closes, and what stops the search for it.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "option": ({"option"}, {"select"})}
NEVER = {"script", "style", "noscript", "template", "nav", "footer", "aside", "form", "button", "select", "option",
         "textarea", "title", "iframe", "svg", "math", "canvas", "audio", "video", "object", "embed", "dialog", "menu",
         "head", "input", "label", "fieldset", "xmp", "noembed", "noframes", "map"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "dialog", "alert", "alertdialog", "search", "form",
         "menu", "menubar", "toolbar", "status"}
#: Words of class and id attributes.
UNLIKELY = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner\w*|cookie\w*|consent|gdpr|notices?|alert|popup|modal|overlay|"
    r"newsletter|subscri\w*|signup|login|sidebar\w*|side|rail|menu\w*|nav|navbar|navigation|breadcrumbs?|footer|foot|"
    r"header|masthead|topbar|comments?|commentlist|discussion|disqus|respond|repl(?:y|ies)|share\w*|sharing|social\w*|"
    r"related|recommend\w*|widgets?|toolbar|pagination|pager|skip|hidden|copyright|disclaimer|legal|tags?|byline-ads?)(?=$|[\s_-])",
    re.I)
CONTENT = {"article", "main"}
REACH = 64  # ancestors that a block's points reach; the last gets 1/189 of them
BASE = {"article": 30.0, "main": 25.0, "section": 3.0, "div": 3.0, "blockquote": 2.0, "pre": 2.0, "td": 2.0,
        "ul": -3.0, "ol": -3.0, "dl": -3.0, "li": -3.0, "address": -3.0, "th": -5.0}


class Page:
    """The element tree of one page and its text blocks."""

    def __init__(self, source: str):
        self.parent, self.tag, self.out, self.holds = [-1], ["#root"], [False], [False]
        self.blocks: list[tuple[int, str, int]] = []  # (element, text, characters in links)
        self._parts: list[str] = []
        self._linked = 0
        self._links = 0
        self._owner = 0
        self._open_of: dict[str, int] = {}  # open elements by name
        self._content = 0
        self._parse(source)

    def _flush(self, owner: int) -> None:
        if self._parts:
            text = " ".join("".join(self._parts).split())
            if text:
                self.blocks.append((self._owner, text, min(self._linked, len(text))))
            self._parts, self._linked = [], 0
        self._owner = owner

    def _text(self, raw: str, stack: list[int]) -> None:
        if raw and not self.out[stack[-1]]:
            text = entities.unescape(raw) if "&" in raw else raw
            self._parts.append(text)
            if self._links:
                self._linked += len(text.strip())

    def _open(self, name: str, attrs: str, stack: list[int]) -> None:
        out = self.out[stack[-1]] or name in NEVER
        unlikely = False
        if attrs and not out and name not in ("html", "body"):
            for key, value in ATTR.findall(attrs):
                key, value = key.lower(), value.strip("\"'")
                if key in ("class", "id") and name not in CONTENT:
                    unlikely = unlikely or bool(UNLIKELY.search(value))
                elif key == "role":
                    unlikely = unlikely or value.lower() in ROLES
                elif key == "hidden" or key == "aria-hidden" and value.lower() == "true":
                    out = True
                elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                    out = True
        if name == "header" and not self._content:
            unlikely = True
        self.parent.append(stack[-1])
        self.tag.append(name)
        self.out.append(out)
        self.holds.append(unlikely)
        if name in CONTENT:  # a part around an article is not dropped for its name
            for e in reversed(stack):
                self.holds[e] = False
                if self.tag[e] in CONTENT:  # those above were cleared by it
                    break
            self._content += 1
        self._open_of[name] = self._open_of.get(name, 0) + 1
        stack.append(len(self.tag) - 1)

    def _pop(self, stack: list[int], to: int) -> None:
        for e in stack[to:]:
            tag = self.tag[e]
            self._open_of[tag] -= 1
            if tag == "a":
                self._links -= 1
            if tag in CONTENT:
                self._content -= 1
        del stack[to:]

    def _end(self, stack: list[int], names: set[str], stops: set[str]) -> None:
        """Close the innermost of ``names`` unless one of ``stops`` is nearer."""
        if not any(self._open_of.get(name) for name in names):
            return
        for k in range(len(stack) - 1, 0, -1):
            tag = self.tag[stack[k]]
            if tag in names:
                self._pop(stack, k)
                return
            if tag in stops:
                return

    def _parse(self, source: str) -> None:
        stack, at, size = [0], 0, len(source)
        lower = None
        while at < size:
            m = MARKUP.search(source, at)
            if m is None:
                self._text(source[at:], stack)
                break
            self._text(source[at:m.start()], stack)
            at = m.end()
            name = m["name"] or m["name2"]
            if not name:
                continue
            name, attrs = name.lower(), m["attrs"] or m["attrs2"] or ""
            if m["close"] or m["close2"]:
                if name in BLOCK:
                    self._end(stack, {name}, {"table"} if name in ("li", "p") else set())
                    self._flush(stack[-1])
                elif name not in VOID:
                    self._end(stack, {name}, BLOCK)
                continue
            if name in BLOCK:
                if name in CLOSES:
                    self._end(stack, *CLOSES[name])
                elif name not in ("option", "html", "body"):
                    self._end(stack, {"p"}, BLOCK - {"p"})
            elif name == "a":
                self._end(stack, {"a"}, BLOCK)
            if name == "br":
                self._parts.append(" ")
                continue
            if name in VOID:
                if name == "hr":
                    self._flush(stack[-1])
                continue
            if name in RAW:
                if not attrs.rstrip().endswith("/"):
                    if lower is None:
                        lower = source.lower()
                        if len(lower) != size:  # a few characters change their length
                            lower = "".join(c.lower() if c.isascii() else c for c in source)
                    end = lower.find(f"</{name}", at)
                    if end < 0:
                        break
                    close = source.find(">", end)
                    at = size if close < 0 else close + 1
                continue
            self._open(name, attrs, stack)
            if name in BLOCK:
                self._flush(stack[-1])
            elif name == "a":
                self._links += 1
        self._flush(0)

    def text(self) -> str:
        """The blocks of the best container and its kept siblings."""
        n = len(self.tag)
        gone = [False] * n
        for e in range(1, n):  # parents come before children
            gone[e] = gone[self.parent[e]] or self.out[e] or self.holds[e]
        blocks = [b for b in self.blocks if not gone[b[0]]]
        if not blocks:
            return ""
        points, length, linked = [0.0] * n, [0] * n, [0] * n
        for e, text, links in blocks:
            own = (text.count(",") + text.count("，") + 1 + min(len(text) / 100, 3.0)) * (1 - links / len(text))
            if self.tag[e] in ("h1", "h2", "h3", "h4", "h5", "h6"):
                own *= 0.2
            # a bare text block of a container counts as a paragraph in it
            up, share = (self.parent[e] if self.tag[e] in ("p", "h1", "h2", "h3", "h4", "h5", "h6") else e), 1.0
            step = 0
            while up > 0 and step < REACH:
                points[up] += own * share
                up, step = self.parent[up], step + 1
                share = 1.0 / (2 if step == 1 else step * 3)
            length[e] += len(text)
            linked[e] += links
        for e in range(n - 1, 0, -1):  # children come after parents
            length[self.parent[e]] += length[e]
            linked[self.parent[e]] += linked[e]
        best, most = 0, float("-inf")
        for e in range(1, n):
            if length[e] and not gone[e] and self.tag[e] not in ("html", "body", "p"):
                value = (points[e] + BASE.get(self.tag[e], 0.0)) * (1 - linked[e] / length[e])
                if value > most:
                    best, most = e, value
        if best == 0:
            best = next((e for e in range(1, n) if self.tag[e] == "body" and length[e]), 0)
            chosen = {best}
        else:
            up = best
            while up > 0:
                if self.tag[up] in CONTENT:
                    best = up
                up = self.parent[up]
            chosen = {best} | self._siblings(best, most, points, length, linked, gone)
        inside = [False] * n
        for e in range(n):
            inside[e] = e in chosen or (e > 0 and inside[self.parent[e]])
        return "\n".join(text for e, text, _ in blocks if inside[e])

    def _siblings(self, best, most, points, length, linked, gone) -> set[int]:
        kept, least = set(), max(10.0, most * 0.2)
        if self.tag[best] in CONTENT:
            return kept
        for e in range(1, len(self.tag)):
            if e == best or self.parent[e] != self.parent[best] or gone[e] or not length[e]:
                continue
            density = linked[e] / length[e]
            if (points[e] + BASE.get(self.tag[e], 0.0)) * (1 - density) >= least or (
                    self.tag[e] in ("p", "pre", "blockquote", "h1", "h2", "h3") and density < 0.25):
                kept.add(e)
        return kept


def main_text(source: str | None) -> str:
    return Page(source or "").text()


def _extracted(batches):
    for batch in batches:
        texts = [main_text(s.as_py()) for s in batch.column("html")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row."""
    return (pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.col("html").cast("string").alias("html"))
            .mapInArrow(_extracted, "page_id long, url string, text string, n_chars long"))
