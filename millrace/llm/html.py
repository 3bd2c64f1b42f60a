"""Main text of web pages by two-pass block rules.

A page is cut into blocks of text at its block elements. The first pass decides each block by itself: blocks in menus, footers, forms, adverts, comments and the like, and
blocks made of links, are boilerplate; long blocks with running text, seen by their share of stop words, are content; the others, short or without
enough stop words, stay open. In the second pass an open block takes the label of the nearest decided block of its own container.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Content has at least so many characters and this share of stop words; more of its characters than this in links, and it is none.
CONTENT_CHARS, CONTENT_STOP_WORDS, LINKED = 80, 0.12, 0.5
#: Running text of so many characters, with few links, overrules the name of an element around it.
LONG_CHARS = 240
#: A block below this length with a copyright mark, or with any link beside other text, is boilerplate outside an article.
SHORT_CHARS, SHORT_LINKED = 80, 0.25

#: Frequent words of four languages. Fixed values.
STOP_WORDS = frozenset([
    "the", "of", "and", "to", "in", "is", "that", "for", "it", "as", "was", "with", "be", "by", "on", "not", "he", "this", "are", "or", "his", "from", "at", "which", "but", "have", "an", "they", "you", "were",
    "der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "dem", "nicht", "ein", "eine", "als", "auch", "es", "werden", "aus", "er", "hat", "dass", "sie", "nach", "wird", "bei",
    "de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "par", "plus", "pas", "au", "sur", "ne", "se", "ce", "il", "sont", "avec", "ou", "son", "aux", "cette",
    "el", "los", "y", "las", "del", "por", "con", "una", "su", "para", "al", "lo", "como", "más", "pero", "sus", "o", "este", "sí", "porque", "esta", "entre", "cuando", "muy", "sin", "sobre", "ser", "tiene", "no", "a",
])

#: Elements that end a block of text.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html "
    "legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements whose content is no text of the page, and elements that hold boilerplate.
SILENT = frozenset("script style noscript template svg math head iframe object canvas audio video select button textarea option datalist map applet".split())
BOILERPLATE = frozenset("nav footer aside form menu dialog fieldset".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Names in class, id and role that mark boilerplate, as whole parts of a name.
_MARKED = re.compile(
    r"(?:^|[\s_-])(?<!has-)(?<!with-)(?<!no-)(?<!has_)(?<!with_)(?<!no_)(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|nav|navbar|navigation|menu\w*|breadcrumbs?|footer|sidebar|side-?bar|comments?|commentlist|respond|replies|disqus|cookies?|consent|gdpr|notice|"
    r"alert|popup|modal|overlay|newsletter|subscri\w*|signup|login|share|sharing|social|related|recommend\w*|trending|widget|search|pagination|pager|toolbar|masthead|copyright|legal|disclaimer|"
    r"complementary|contentinfo|skip-?link\w*|tags?|toc)(?=$|[\s_-])",
    re.I,
)
#: Of these, names that running text has no part in; any other is overruled by long running text.
_FOREIGN = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|comments?|commentlist|respond|replies|disqus|cookies?|consent|gdpr|popup|modal|overlay|newsletter|subscri\w*)(?=$|[\s_-])", re.I)
#: Names of the text itself, which outweigh a mark that is not foreign.
_OWN = re.compile(r"(?:^|\s)(?:article|post|entry|page|main|story)[_-]{1,2}(?:body|content|text)(?=$|\s)", re.I)
_NAMES = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?=$|[\s=/])|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)>|<[!?/][^>]*>|<(?=[a-zA-Z/!?])[^>]*\Z|[^<]+|<""", re.S)
_WORD = re.compile(r"\w+")


class Block(NamedTuple):
    text: str
    linked: int
    boilerplate: bool
    heading: bool
    container: int
    article: bool
    #: Numbers of the elements around it that a name alone marks as boilerplate.
    marks: tuple[int, ...] = ()


def mark(tag: str, attributes: str, article: bool) -> str | None:
    """What class, id and role say of an element: "foreign" or "named" boilerplate, or nothing.

    Ids of headings are anchors, and so are ids in an article unless the whole id is such a name; headings and sections of an article have no mark.
    """
    if not attributes or tag in ("html", "body", "article", "main") or article and (tag in HEADING or tag == "section"):
        return None
    found = [(k.lower(), v.strip("\"'")) for k, v in _NAMES.findall(attributes)]
    ids = [v for k, v in found if k == "id" and tag not in HEADING]
    ids = [v for v in ids if not article or (m := _MARKED.search(v)) and m[0] == v]
    names = " ".join([*(v for k, v in found if k != "id"), *ids])
    if not _MARKED.search(names):
        return None
    return "foreign" if _FOREIGN.search(names) else None if _OWN.search(names) else "named"


def blocks(page: str) -> list[Block]:
    """The blocks of a page, in order. Unclosed elements end with the element around them."""
    found: list[Block] = []
    # open block elements: tag, boilerplate, article, number of the container, marks
    stack: list[tuple[str, bool, bool, int, tuple[int, ...]]] = [("", False, False, 0, ())]
    pieces: list[str] = []
    linked = containers = link_depth = 0

    def flush() -> None:
        nonlocal pieces, linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                _, boilerplate, article, container, marks = stack[-1]
                found.append(Block(text, linked, boilerplate, any(e[0] in HEADING for e in stack[-2:]), container, article, marks))
        pieces, linked = [], 0

    at = 0
    while at < len(page):
        m = _TOKEN.match(page, at)
        if m is None:  # an unfinished tag with an open quote: the rest is no text
            break
        at = m.end()
        token, tag = m[0], (m[2] or "").lower()
        if not tag:
            if token[0] != "<" or token == "<":
                text = unescape(token)
                pieces.append(text)
                if link_depth:
                    linked += len("".join(text.split()))
            continue
        closing = bool(m[1])
        if tag in SILENT and not closing:
            if not m[3].rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*>" if tag != "head" else r"</head\b[^>]*>|(?=<body\b)", re.I).search(page, at)
                # a head or option that is not closed ends at once, any other silent element at the end
                at = end.end() if end else (at if tag in ("head", "option") else len(page))
            pieces.append(" ")
            continue
        if tag == "a":
            link_depth = 0 if closing else 1
        elif tag == "br":
            pieces.append(" ")
        elif tag in BLOCK or tag in BOILERPLATE:
            flush()
            link_depth = 0
            if closing:
                if any(e[0] == tag for e in stack):
                    while stack.pop()[0] != tag:
                        pass
                continue
            if tag in VOID:
                continue
            # a paragraph ends where the next block begins, a list item or cell at the next one
            while stack[-1][0] == "p" or stack[-1][0] in HEADING or stack[-1][0] == tag and tag in ("li", "dt", "dd", "td", "th", "tr", "option"):
                stack.pop()
            _, boilerplate, article, container, marks = stack[-1]
            named = mark(tag, m[3], article)
            own = tag in BOILERPLATE or (tag == "header" and not article) or named == "foreign"
            own = own or bool(m[3] and _HIDDEN.search(m[3]))
            if tag in ("article", "main") or (own or named) and not boilerplate:
                containers += 1
                container = containers
            if named == "named" and not own and not boilerplate:
                marks = (*marks, containers)
            stack.append((tag, boilerplate or own, article or tag in ("article", "main"), container, marks))
    flush()
    return found


def running(block: Block) -> bool:
    words = _WORD.findall(block.text.lower())
    return bool(words) and sum(w in STOP_WORDS for w in words) >= CONTENT_STOP_WORDS * len(words)


def weighed(found: list[Block]) -> list[Block]:
    """The blocks, those of marked elements as boilerplate unless long running text with few links stands in each of these."""
    if not any(b.marks for b in found):
        return found
    long = [b for b in found if b.marks and not b.boilerplate and len(b.text) >= LONG_CHARS and b.linked < SHORT_LINKED * (len(b.text) - b.text.count(" ")) and running(b)]
    overruled = {n for b in long for n in b.marks}
    return [b._replace(boilerplate=b.boilerplate or not overruled.issuperset(b.marks)) for b in found]


def first_pass(block: Block) -> bool | None:
    """True for content, False for boilerplate, None where the block by itself does not tell."""
    chars = len(block.text)
    solid = max(1, chars - block.text.count(" "))
    share = block.linked / solid
    if block.boilerplate or share >= LINKED:
        return False
    if not block.article and chars < SHORT_CHARS and (share >= SHORT_LINKED or "©" in block.text):
        return False
    if chars >= CONTENT_CHARS and not block.heading:
        if running(block):
            return True
    return None


def second_pass(found: list[Block], labels: list[bool | None]) -> list[bool]:
    """Open blocks take the label of the nearest decided block in their container, at equal distance of the one after for headings, before for others.

    An article is a container that its author has decided: what the first pass leaves open in it is content. Where a container has no decided block, the nearest one
    of the page counts, and without any the block is content unless the page has an article.
    """

    def nearest(keys: list[int]) -> tuple[list, list]:
        before, after = [None] * len(found), [None] * len(found)
        for order, out in ((range(len(found)), before), (range(len(found) - 1, -1, -1), after)):
            last: dict[int, int] = {}
            for i in order:
                if labels[i] is not None:
                    last[keys[i]] = i
                out[i] = last.get(keys[i])
        return before, after

    inside = nearest([b.container for b in found])
    page = nearest([0] * len(found))
    has_article = any(b.article for b in found)

    def pick(i: int, sides: tuple[list, list]) -> bool | None:
        a, b = sides[0][i], sides[1][i]
        if a is None or b is None:
            return labels[b if a is None else a] if a is not None or b is not None else None
        near, far = i - a, b - i
        return labels[b] if far < near or (far == near and found[i].heading) else labels[a]

    out = []
    for i, block in enumerate(found):
        label = labels[i]
        if label is None:
            label = True if block.article else pick(i, inside)
        if label is None:
            label = pick(i, page)
        out.append(not has_article if label is None else label)
    return out


def main_text(page: str) -> str:
    found = weighed(blocks(page))
    return "\n".join(b.text for b, keep in zip(found, second_pass(found, [first_pass(b) for b in found])) if keep)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: ``id_col``, ``url_col``, ``text`` (blocks joined by a line feed) and ``n_chars`` in code points.

    Null and empty pages, and pages without content, have an empty text. Null ids and urls and repeated rows stay as they are. A page that ends in the middle of a tag
    loses that tag only. An empty table gives no row; other columns are not read.
    """
    given = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                texts = [main_text(p.as_py() or "") for p in part.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["id", "url", "text", "n_chars"]
                )

    kinds = [given.schema[c].dataType.simpleString() for c in ("id", "url")]
    out = given.mapInArrow(task, f"id {kinds[0]}, url {kinds[1]}, text string, n_chars bigint")
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars")
