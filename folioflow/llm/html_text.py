"""Main text of web pages: flat text blocks classified by a decision tree."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from folioflow.llm.common import free_name, table
from folioflow.llm.labelled_blocks import labelled_pages

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)",
    re.DOTALL,
)
#: Attributes one after the other, each with its value, so that no value is taken for a name.
_ATTRIBUTE = re.compile(r"([^\s/>][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)(?:\"|\Z)|'([^']*)(?:'|\Z)|([^\s>]+)))?")
_NAME = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")

#: Elements whose content is no text of the page.
RAW = frozenset(("script", "style", "noscript", "template", "iframe", "svg", "math", "object", "canvas", "head", "title", "textarea", "select", "option", "button", "audio", "video"))
_RAW_TEXT = frozenset(("script", "style", "textarea", "title", "iframe", "noscript"))
#: Elements inside a line of text; every other one ends a block.
INLINE = frozenset(("a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"))
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
#: Elements that a start tag of the same group closes.
_CLOSED_BY = {"p": frozenset(("p",)), "li": frozenset(("li", "p")), "td": frozenset(("td", "th", "p")), "th": frozenset(("td", "th", "p")), "tr": frozenset(("tr", "td", "th", "p")), "dt": frozenset(("dt", "dd", "p")), "dd": frozenset(("dt", "dd", "p"))}
#: Elements that close an open paragraph.
_ENDS_P = frozenset(("address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "pre", "section", "table", "ul", "body"))
#: Elements and name parts around a page's text, as against in it.
FRAME_ELEMENTS = frozenset(("nav", "footer", "aside", "form", "menu", "dialog", "fieldset"))
FRAME_ROLES = frozenset(("navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar"))
FRAME_NAMES = frozenset(("ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "adbox", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "cookie", "cookies", "consent", "copyright", "disqus", "footer", "gdpr", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "popup", "promo", "promoted", "related", "replies", "respond", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "teaser", "toolbar", "topbar", "widget"))
TEXT_ELEMENTS = frozenset(("article", "main"))
TEXT_NAMES = frozenset(("article", "story", "post", "entry", "content", "main"))

FEATURES = (
    "words",
    "link_density",
    "words_before",
    "link_density_before",
    "words_after",
    "link_density_after",
    "in_frame",
    "in_text",
    "page_has_text_element",
)


@dataclass
class Block:
    """A run of text without a block element in it."""

    text: str
    words: int
    linked: int
    in_frame: bool
    in_text: bool

    @property
    def link_density(self) -> float:
        return self.linked / self.words if self.words else 0.0


@dataclass
class _Open:
    name: str
    in_frame: bool
    in_text: bool
    raw: bool = False
    linked: bool = False


@dataclass
class _Flat:
    blocks: list[Block] = field(default_factory=list)
    parts: list[tuple[str, bool]] = field(default_factory=list)

    def end_block(self, top: _Open) -> None:
        text = _SPACE.sub(" ", html.unescape("".join(p for p, _ in self.parts))).strip()
        if text:
            linked = sum(len(html.unescape(p).split()) for p, link in self.parts if link)
            self.blocks.append(Block(text, len(text.split()), linked, top.in_frame, top.in_text))
        self.parts.clear()


def flat_blocks(page: str) -> list[Block]:
    """Text blocks of a page in order. Unclosed and misplaced tags are taken as browsers do in
    the common cases; comments, scripts, styles and other unseen content give no block."""
    stack = [_Open("", False, False)]
    flat = _Flat()
    at, length = 0, len(page)
    while at < length:
        tag = _MARKUP.search(page, at)
        text = page[at : tag.start()] if tag else page[at:]
        top = stack[-1]
        if text and not top.raw:
            flat.parts.append((text, top.linked))
        if not tag:
            break
        at = tag.end()
        name = tag[2]
        if name is None:
            continue
        name = name.lower()
        if tag[1]:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].name == name), 0)
            if name not in INLINE:
                flat.end_block(top)
            if depth and (name not in INLINE or all(o.name in INLINE for o in stack[depth:])):
                del stack[depth:]
            continue
        if name not in INLINE:
            flat.end_block(top)
            if name in _ENDS_P or name in _CLOSED_BY:
                closing = _CLOSED_BY.get(name, frozenset(("p",)))
                # Inline elements left open end with their paragraph.
                depth = len(stack) - 1
                while depth and stack[depth].name in INLINE:
                    depth -= 1
                while depth and stack[depth].name in closing:
                    del stack[depth:]
                    depth = len(stack) - 1
                    while depth and stack[depth].name in INLINE:
                        depth -= 1
        elif name == "br":
            flat.parts.append((" ", False))
        if name in VOID or tag[3].endswith("/") and name in ("svg", "path"):
            continue
        top = stack[-1]
        frame, text_part = _kind(name, tag[3], top)
        stack.append(
            _Open(
                name,
                top.in_frame or frame,
                top.in_text or text_part,
                top.raw or name in RAW,
                top.linked or name == "a",
            )
        )
        if name in _RAW_TEXT:
            end = re.compile(rf"</{name}[\s/>]", re.I).search(page, at)
            at = end.start() if end else length
    flat.end_block(stack[-1])
    return flat.blocks


def _kind(name: str, attributes: str, top: _Open) -> tuple[bool, bool]:
    """Whether the element frames a page's text, and whether it holds it."""
    words: set[str] = set()
    role = ""
    hidden = False
    if attributes:
        for found in _ATTRIBUTE.finditer(attributes):
            key = found[1].lower()
            value = (found[2] or found[3] or found[4] or "").lower()
            if key == "hidden":
                hidden = True
            elif key == "role":
                role = value
            elif key in ("class", "id"):
                words.update(_NAME.findall(value))
    frame = (
        hidden
        or name in FRAME_ELEMENTS
        or role in FRAME_ROLES
        or name == "header" and not top.in_text
        or bool(words & FRAME_NAMES) and name not in ("body", "html", "article", "main")
    )
    return frame, name in TEXT_ELEMENTS or (bool(words & TEXT_NAMES) and not frame)


def features(blocks: list[Block]) -> np.ndarray:
    """One row of FEATURES per block."""
    words = np.array([b.words for b in blocks], float)
    density = np.array([b.link_density for b in blocks], float)
    n = len(blocks)
    out = np.zeros((n, len(FEATURES)))
    if n:
        out[:, 0], out[:, 1] = words, density
        out[1:, 2], out[1:, 3] = words[:-1], density[:-1]
        out[:-1, 4], out[:-1, 5] = words[1:], density[1:]
        out[:, 6] = [b.in_frame for b in blocks]
        out[:, 7] = [b.in_text for b in blocks]
        out[:, 8] = any(b.in_text for b in blocks)
    return out


@dataclass(frozen=True)
class Tree:
    """A leaf (`keep`) or a question: is the feature at most the limit?"""

    keep: bool = False
    feature: int = -1
    limit: float = 0.0
    at_most: "Tree | None" = None
    above: "Tree | None" = None

    def predict(self, rows: np.ndarray) -> np.ndarray:
        if self.feature < 0:
            return np.full(len(rows), self.keep)
        low = rows[:, self.feature] <= self.limit
        out = np.empty(len(rows), bool)
        out[low] = self.at_most.predict(rows[low])
        out[~low] = self.above.predict(rows[~low])
        return out


def grow(rows: np.ndarray, keep: np.ndarray, depth: int = 8, least: int = 2) -> Tree:
    """Binary splits of least Gini impurity, ties to the earlier feature and smaller limit."""
    share = keep.mean() if len(keep) else 0.0
    if depth == 0 or share in (0.0, 1.0) or len(keep) < 2 * least:
        return Tree(keep=bool(share >= 0.5))
    best = (2 * share * (1 - share) * len(keep) - 1e-9, None)
    for feature in range(rows.shape[1]):
        values = np.unique(rows[:, feature])
        for limit in (values[1:] + values[:-1]) / 2:
            low = rows[:, feature] <= limit
            if least <= low.sum() <= len(keep) - least:
                a, b = keep[low].mean(), keep[~low].mean()
                impurity = 2 * a * (1 - a) * low.sum() + 2 * b * (1 - b) * (~low).sum()
                if impurity < best[0] - 1e-12:
                    best = (impurity, (feature, float(limit)))
    if best[1] is None:
        return Tree(keep=bool(share >= 0.5))
    feature, limit = best[1]
    low = rows[:, feature] <= limit
    return Tree(
        feature=feature,
        limit=limit,
        at_most=grow(rows[low], keep[low], depth - 1, least),
        above=grow(rows[~low], keep[~low], depth - 1, least),
    )


def labelled_rows() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the small labelled table."""
    rows, keep = [], []
    for page, letters in labelled_pages():
        blocks = flat_blocks(page)
        if len(blocks) != len(letters):
            raise ValueError(f"{len(letters)} labels for {[b.text for b in blocks]}")
        rows.append(features(blocks))
        keep += [letter == "k" for letter in letters]
    return np.concatenate(rows), np.array(keep)


@lru_cache(1)
def trained_tree() -> Tree:
    return grow(*labelled_rows())


def main_text(page: str | None, tree: Tree) -> str:
    """Kept blocks, one per line."""
    blocks = flat_blocks(page or "")
    if not blocks:
        return ""
    keep = tree.predict(features(blocks))
    return "\n".join(b.text for b, k in zip(blocks, keep) if k)


def extract_text(pages: DataFrame, column: str = "html", to: str = "text") -> DataFrame:
    """`pages` without the html column and with the main text of each page as column `to`.

    Every block of the whole page is judged by its own and its neighbours' word counts and link
    densities and by where it stands; see FEATURES. One pass, no shuffle; a task holds one page.

    Defined cases: a null or empty page, and one with no kept block, has the empty text; broken
    markup ends with the page; unknown elements end a block. Repeated rows are answered one by
    one. Other columns pass through; one named as `to` is replaced. Empty tables give no rows.
    """
    tree = trained_tree()
    kept = [c for c in pages.columns if c not in (column, to)]
    markup = free_name("_html", pages.columns)
    rows = pages.select(*kept, F.col(column).cast("string").alias(markup))
    n = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(h.as_py(), tree) for h in batch.column(markup)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:n], pa.array(found, pa.string())], names=[*batch.schema.names[:n], to]
            )

    schema = T.StructType([*pages.select(*kept).schema, T.StructField(to, T.StringType())])
    return rows.mapInArrow(run, schema)


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_text(pages).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars")
    )
