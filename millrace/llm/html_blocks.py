"""Main text of web pages by two passes over their blocks.

First pass: what surrounds a block (menus, forms, adverts, ... or the article
element), its link density, its length and its share of stop words decide it or
leave it open.  Second pass: open blocks, which are short or hardly prose,
inherit from the nearest decided blocks before and after them.

Where a page's prose holds hardly any known stop word, its language is another
one; length, sentence ends and link density decide alone there.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import map_batches
from millrace.llm.quality import VOCABULARY

# Elements and names by their meaning in HTML.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table "
    "tbody tfoot thead title tr ul".split()
)
# Elements that stay open until their end tag; a paragraph ends wherever the next block begins.
HOLDERS = frozenset(
    "article aside blockquote center details dialog div dl fieldset figure footer form head header li main menu nav ol "
    "section table ul".split()
)
RAW = frozenset("script style title textarea template iframe svg annotation annotation-xml select canvas audio video".split())
FURNITURE = frozenset("nav aside footer form menu dialog head fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
# Names of classes and ids, as a whole or as a part of a compound (see `_named`).
COMMENT_NAMES = frozenset("comment comments commentlist commentary disqus replies reply respond discussion".split())
HEADER_NAMES = frozenset("header masthead banner".split())
FURNITURE_NAMES = frozenset(
    "ad ads adbox adsense advert adverts advertisement advertising banners breadcrumb breadcrumbs consent cookie "
    "cookies copyright disclaimer footer gdpr legal login menu modal nav navbar navigation newsletter "
    "notice notices notification overlay pager pagination popup promo promotion promoted recommended recommendations "
    "related search share sharing sidebar signup skip social sponsor sponsored subscribe subscription teaser toolbar "
    "topbar widget widgets".split()
)
# A class that begins so tells how a page is laid out, not what the element holds.
LAYOUT_WORDS = frozenset("has no not with without is show hide".split())
# A header after one of these is that of the article (article-header).
CONTENT_WORDS = frozenset("article entry post story".split())
READERS = frozenset("article blog child guest post reader single user visitor".split())
# A name before one of these is that of the container.
PART_WORDS = frozenset(
    "actions area articles bar blocks block body bottom box button buttons col column container content entries footer form "
    "group head header heading holder icons inner item items label left line link links list main message module outer "
    "panel posts primary right row secondary section slot space stories strip text title top tray unit wrap wrapper".split()
)
STOP_WORDS = frozenset(VOCABULARY)

SHORT, LONG = 70, 200
LOW_STOP, HIGH_STOP = 0.15, 0.30
MAX_LINKS = 0.33
GOOD, BAD, SHORT_OPEN, PROSE_OPEN = range(4)

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_NAME = re.compile(r"[a-z]+")
_HEADING = re.compile(r"h[1-6]$|hgroup$")
_CAMEL = re.compile(r"([a-z])([A-Z])")
_SENTENCE_END = re.compile(r"[.!?…][\"'»”’)]*(?:\s|$)|[。！？؟।]")
_WIDE = re.compile(r"[\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af]")  # one character says as much as some letters
_NOTICE = re.compile(r"\W*(?:©|\(c\)\s*\d|copyright\b\s*(?:©|\(c\)|\d|by\b|notice\b|$))", re.I)
_ENDS = {name: re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I) for name in RAW}


class Block:
    """A run of text without block markup inside it."""

    __slots__ = ("text", "linked", "place", "heading")

    def __init__(self, text: str, linked: int, place: str, heading: bool):
        self.text, self.linked, self.place, self.heading = text, linked, place, heading


def _named(name: str) -> str:
    """What one class or id says: '', 'header', 'furniture' or 'comment'."""
    words = _NAME.findall(_CAMEL.sub(r"\1 \2", name).lower())
    if not words or words[0] in LAYOUT_WORDS:
        return ""
    first, last = words[0], words[-1]
    if len(words) == 1:
        parts = [first]
    else:
        parts = [first] if last in PART_WORDS else []
        if last == "comment":
            parts += [last] if first in READERS else []
        elif first not in CONTENT_WORDS or last not in HEADER_NAMES:
            parts.append(last)
        if first in COMMENT_NAMES and first != "discussion":
            return "comment"
    for kind, names in (("comment", COMMENT_NAMES), ("furniture", FURNITURE_NAMES), ("header", HEADER_NAMES)):
        if any(p in names for p in parts):
            return kind
    return ""


def _standing(name: str, attributes: str) -> str:
    """What an element says of its content: '', 'main', 'header', 'furniture' or 'comment'."""
    found = {}
    for key, *values in _ATTRIBUTE.findall(attributes) if attributes.strip() else ():
        found.setdefault(key.lower(), "".join(values))
    said = {_named(n) for key in ("class", "id") for n in found.get(key, "").split()}
    role = found.get("role", "").lower()
    if "comment" in said:
        return "comment"
    if "hidden" in found or found.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", found.get("style", "")):
        return "furniture"
    if name in ("article", "main") or role in ("main", "article"):
        return "main"
    if name in FURNITURE or role in ROLES or "furniture" in said:
        return "furniture"
    return "header" if name == "header" or ("header" in said and not _HEADING.match(name)) else ""


def blocks(html: str) -> list[Block]:
    """Blocks with text in page order, and where they stand."""
    found: list[Block] = []
    parts: list[str] = []
    linked = links = 0
    heading = False
    own = ""  # standing of a block that is no holder
    stack: list[tuple[str, str]] = []  # open holders and their standing
    at, size = 0, len(html)

    def place() -> str:
        inside = ""
        for standing in (*(s for _, s in stack), own):
            # the header of an article is a part of it
            if standing in ("comment", "furniture") or (standing == "header" and inside != "main"):
                return "furniture"
            inside = "main" if "main" in (standing, inside) else ""
        return inside

    def close() -> None:
        nonlocal parts, linked
        text = " ".join(unescape("".join(parts)).split())
        if text:
            found.append(Block(text, linked, place(), heading))
        parts, linked = [], 0

    while at < size:
        tag = _TAG.search(html, at)
        end = tag.start() if tag else size
        if end > at:
            parts.append(html[at:end])
            if links:
                linked += len("".join(html[at:end].split()))
        if not tag:
            break
        at = tag.end()
        name = (tag[2] or tag[5] or "").lower()
        if not name:
            continue
        closing = bool(tag[1] or tag[4])
        if name in RAW:
            if not closing and not tag[0].endswith("/>"):
                stop = _ENDS[name].search(html, at)
                at = stop.end() if stop else size
            parts.append(" ")
            continue
        if name == "a":
            links = 0 if closing else 1
        elif name in ("br", "td", "th", "wbr", "img", "input"):
            parts.append("" if name == "wbr" else " ")
        elif name in BLOCKS:
            close()
            links = 0
            heading = not closing and len(name) == 2 and name[0] == "h" and name[1].isdigit()
            own = "" if closing or name in HOLDERS or name == "body" else _standing(name, tag[3] or tag[6] or "")
            if name == "body":
                stack.clear()
            elif name in HOLDERS:
                if not closing:
                    standing = _standing(name, tag[3] or tag[6] or "")
                    if standing == "main" and not any(s == "comment" for _, s in stack):
                        # whatever furniture is still open was never closed
                        stack[:] = [x for x in stack if x[1] not in ("furniture", "header")]
                    stack.append((name, standing))
                elif any(x[0] == name for x in stack):
                    while stack.pop()[0] != name:
                        pass
    close()
    return found


def _letters(block: Block) -> int:
    return max(1, len(block.text) - block.text.count(" "))


def _stops(text: str) -> float:
    words = text.lower().split()
    return sum(w.strip(".,;:!?\"()") in STOP_WORDS for w in words) / len(words)


def _foreign(found: list[Block]) -> bool:
    """Whether the page's sentences, menus aside, are in a language without known stop words."""
    prose = [b.text for b in found if b.place != "furniture" and not b.linked and len(b.text) >= SHORT and _SENTENCE_END.search(b.text)]
    prose += [b.text for b in found if _WIDE.search(b.text) and not b.linked and b.place != "furniture"]
    return bool(prose) and _stops(" ".join(prose)) < LOW_STOP


def _first_pass(block: Block, foreign: bool = False) -> int:
    text = block.text
    if block.place:
        return GOOD if block.place == "main" else BAD
    if block.linked / _letters(block) > MAX_LINKS and not block.heading:
        return BAD
    # a notice, or a short line that names one; prose about copyright is judged as prose
    if _NOTICE.match(text) or (len(text) < SHORT and "copyright" in text.lower()):
        return BAD
    size = len(text) + 2 * len(_WIDE.findall(text)) if foreign else len(text)
    if size < SHORT or block.heading:
        return BAD if block.linked and not block.heading else SHORT_OPEN
    if foreign:
        return GOOD if size > LONG and _SENTENCE_END.search(text) else PROSE_OPEN
    stops = _stops(text)
    if stops >= HIGH_STOP and len(text) > LONG:
        return GOOD
    return PROSE_OPEN if stops >= LOW_STOP else BAD


def classify(found: list[Block]) -> list[bool]:
    """Whether each block belongs to the main text."""
    foreign = _foreign(found)
    first = [_first_pass(b, foreign) for b in found]
    n = len(found)
    before, after = [(n + 1, BAD)] * n, [(n + 1, BAD)] * n
    for i in range(1, n):
        before[i] = (1, first[i - 1]) if first[i - 1] in (GOOD, BAD) else (before[i - 1][0] + 1, before[i - 1][1])
    for i in range(n - 2, -1, -1):
        after[i] = (1, first[i + 1]) if first[i + 1] in (GOOD, BAD) else (after[i + 1][0] + 1, after[i + 1][1])
    labels = []
    for i, label in enumerate(first):
        if label == PROSE_OPEN:
            label = GOOD if GOOD in (before[i][1], after[i][1]) or n == first.count(PROSE_OPEN) + first.count(SHORT_OPEN) else BAD
        elif label == SHORT_OPEN:
            if found[i].heading:
                label = after[i][1]
            elif before[i][1] == after[i][1]:
                label = before[i][1]
            else:
                # as near to both: a short block belongs to what it follows
                label = before[i][1] if before[i][0] <= after[i][0] else after[i][1]
        labels.append(label == GOOD)
    return labels


def main_text(html: str) -> str:
    """The blocks of the main text, joined by two line ends; empty if there are none."""
    found = blocks(html)
    return "\n\n".join(b.text for b, good in zip(found, classify(found)) if good)


def _extract_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = [main_text(h) if h else "" for h in batch.column("html").to_pylist()]
    arrays = [*batch.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """`page_id`, `url`, `text`, `n_chars` per row of `pages`.

    Null and empty pages give the empty text.  Broken markup is read as far as
    it goes: open comments and tags end with the page, open scripts take the
    rest of it.  Very long pages take linear time.  Rows are read one by one, so
    ids may be null or repeated.
    Other columns are not read.
    """
    chosen = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.col(html_col).cast("string").alias("html"),
    )
    return map_batches(chosen, _extract_batch, "page_id long, url string, text string, n_chars long")
