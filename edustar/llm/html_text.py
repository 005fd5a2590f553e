"""HTML main text by two-pass block rules.

A page is cut into blocks at block-level tags. Pass one decides blocks: parts of menus, headers, footers,
side bars, notices, adverts, forms, scripts, styles and reader comments (by element, or by words of class, id or role) are
boilerplate; of the others, many links or a copyright sign make boilerplate, and enough text with enough
stop words (in writing without blanks, function signs) makes content; short blocks stay undecided. Pass two lets each undecided block inherit the label
of its nearest decided neighbours: alike ones give theirs, unlike ones give the nearer one's, and on a tie
content if the block lies in an article. On a page without content and article the undecided blocks, if there are two or more, are the text.

Names are weaker than elements, and a form counts as a name. A heading's names and words behind has-, no-, with- or without- do not count, nor do
ids that title a section of a text (TITLES), nor the header of an article. An element named as boilerplate is taken for a mere wrapper, and its name dropped,
if it holds the main element, or the article with the most text (unless it is named as comments), or, on a page without these, if no content is left
outside of it and it holds most of the page's content (comments never do).

Character references are decoded, white space inside a block (line-break elements count as such) becomes one
space, blocks are trimmed and joined in page order by one space. Nothing else is dropped or cut.

Defined cases: null html counts as empty; a page without content has the empty text; markup cut off at the
end of the page is dropped; an unclosed script, style, textarea or template runs to the end of the page, of other skipped elements without an
end tag only the tag is skipped; repeated rows are kept; very long pages are read whole; an empty table gives an empty result; other columns, whatever
their names, are not read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edustar.llm.text_stats import FUNCTION_WORDS

LONG_BLOCK, SOME_STOP_WORDS, MANY_LINKS = 70, 0.10, 0.5
#: The same for writing without blanks (NO_BLANKS code points a word or more, on average).
LONG_SIGNS, SOME_FUNCTION_SIGNS, NO_BLANKS = 30, 0.04, 12

#: Fixed lists of HTML elements.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section "
    "summary table tbody td tfoot th thead title tr ul".split())
SPACES = frozenset("br wbr img input".split())
RAW = frozenset("script style noscript template textarea iframe svg math object canvas select button".split())
BOILERPLATE = frozenset("nav footer aside menu dialog head".split())
LINES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd tr td th pre blockquote figcaption caption option".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Fixed list: words of class, id or role that name boilerplate.
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu menubar breadcrumb breadcrumbs header "
    "masthead topbar footer foot sidebar aside rail widget cookie cookies consent notice notices alert popup modal overlay newsletter subscribe signup login "
    "form search share sharing social related recommended comment comments reply replies disqus discussion respond pagination pager copyright legal toolbar contentinfo complementary".split())

#: Fixed lists: names of comments; section ids that a text's own sections have; words beside which "header" names a part of the text.
COMMENTS = frozenset("comment comments reply replies disqus respond".split())
TITLES = frozenset("discussion related legal copyright notice notices form search consent recommended navigation menu sharing respond alert banner".split())
OF_TEXT = frozenset("article post entry content story section page title chapter paper".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NEGATING = frozenset("has no with without".split())
TO_THE_END = frozenset("script style textarea template".split())
PARTS = frozenset("body html article main".split())
#: Fixed list: frequent function signs of Chinese and Japanese, whose words are not set apart by blanks.
FUNCTION_SIGNS = frozenset("的了是在和有不这也就与及这為为而のにはをがとでもた")

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(?:^|[\s/])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_STOP = frozenset(FUNCTION_WORDS)

CONTENT, SHORT, BAD = "content", "short", "bad"


@dataclass
class Block:
    text: str
    linked: int  # code points inside links
    tag: str
    inside: bool  # in an article or main element
    named: bool  # in boilerplate by element or name
    box: int  # number of the innermost container
    marks: tuple[int, ...] = ()  # numbers of the elements around it that are boilerplate by name
    articles: tuple[int, ...] = ()  # numbers of the article and main elements around it


def _hidden(attributes: str) -> bool:
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and _HIDDEN.search(value):
            return True
    return False


def _boilerplate_words(element: str, attributes: str, inside: bool) -> set[str]:
    """The words of class, id and role that name the element as boilerplate."""
    out: set[str] = set()
    if element in HEADINGS:
        return out
    found = [(n.lower(), v.strip("\"'")) for n, v in _ATTRIBUTE.findall(attributes)]
    section = element == "section" or any(n == "class" and "section" in v.lower().split() for n, v in found)
    for name, value in found:
        if name in ("class", "id", "role"):
            for token in value.split():
                words = [w.lower() for w in _WORD.findall(token)]
                if words and words[0] in NEGATING:
                    continue
                named = NAMES.intersection(words)
                if inside or OF_TEXT.intersection(words):
                    named -= {"header"}
                if name == "id" and section:
                    named -= TITLES
                out |= named
    return out


def blocks(page: str) -> list[Block]:
    """The page's text blocks in order."""
    out: list[Block] = []
    pieces: list[str] = []
    linked = 0
    # (element, boilerplate, inside an article, container, marks, articles)
    stack: list[tuple[str, bool, bool, int, tuple[int, ...], tuple[int, ...]]] = []
    links = boxes = 0
    marks: list[bool] = []  # whether the mark is one of comments
    articles: list[tuple[bool, tuple[int, ...]]] = []  # whether it is main, and the marks around it
    unclosed: set[str] = set()

    def close_block() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                tag, named, inside, box, *around = stack[-1] if stack else ("", False, False, 0, (), ())
                out.append(Block(text, min(linked, len(text)), tag, inside, named, box, *around))
            pieces.clear()
        linked = 0

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        raw = page[at:m.start()] if m else page[at:]
        if raw:
            pieces.append(raw)
            if links:
                linked += len(html.unescape(raw).strip())
        if m is None:
            break
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:  # an end tag
            if name == "a":
                links = max(0, links - 1)
            if any(s[0] == name for s in stack):
                close_block()
                while stack.pop()[0] != name:
                    pass
            elif name in BLOCKS:
                close_block()
            continue
        attributes = m[3] or ""
        if name in RAW:
            if not attributes.endswith("/") and name not in unclosed:
                stop = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                if stop:
                    at = stop.end()
                elif name in TO_THE_END:
                    at = end
                else:
                    unclosed.add(name)
            pieces.append(" ")
        elif name in SPACES:
            pieces.append(" ")
        elif name == "a":
            links += 1
        elif name in BLOCKS:
            close_block()
            links = 0
            if name in ("p", "li", "dt", "dd", "tr", "td", "th", "option"):
                _close_open(stack, name)
            if name not in VOID:
                _, bad, inside, box, of_marks, of_articles = stack[-1] if stack else ("", False, False, 0, (), ())
                if name not in LINES:
                    boxes += 1
                    box = boxes
                article = inside or name in ("article", "main")
                named = name in BOILERPLATE or name == "header" and not inside
                if name not in PARTS and attributes:
                    named = named or _hidden(attributes)
                words = _boilerplate_words(name, attributes, inside) if name not in PARTS and attributes else set()
                if words or name == "form":
                    of_marks += (len(marks),)
                    marks.append(bool(words & COMMENTS))
                if name in ("article", "main"):
                    of_articles += (len(articles),)
                    articles.append((name == "main", of_marks))
                stack.append((name, bad or named, article, box, of_marks, of_articles))
    close_block()
    _drop_wrappers(out, marks, articles)
    return out


def _drop_wrappers(page_blocks: list[Block], marks: list[bool], articles: list[tuple[bool, tuple[int, ...]]]) -> None:
    """Blocks under a name become boilerplate, unless the named element only wraps the text (see above)."""
    if not marks:
        return
    text = [0] * len(articles)
    for b in page_blocks:
        for i in b.articles if not b.named else ():
            text[i] += len(b.text)
    wrappers: set[int] = {i for main, around in articles if main for i in around}
    if articles:
        most = text.index(max(text))
        wrappers |= {i for i in articles[most][1] if not marks[i] and text[most]}
    content = [b for b in page_blocks if decide(b) == CONTENT]  # without regard to names
    if any(t and not any(marks[i] for i in around) for t, (_, around) in zip(text, articles)):
        content = []  # the text is the article's, however short
    while content and all(set(b.marks) - wrappers for b in content):
        size: dict[int, int] = {}
        for b in content:
            for i in set(b.marks) - wrappers:
                size[i] = size.get(i, 0) + len(b.text) * (not marks[i])
        largest = max(size, key=lambda i: (size[i], -i))
        if 2 * size[largest] <= sum(len(b.text) for b in content):
            break  # several named parts, none of them most of the page
        wrappers.add(largest)
    for b in page_blocks:
        b.named = b.named or any(i not in wrappers for i in b.marks)


def _close_open(stack: list[tuple], name: str) -> None:
    """A new paragraph, list item or cell closes an open one of its kind in the same container."""
    for i in range(len(stack) - 1, -1, -1):
        if stack[i][0] == name:
            del stack[i:]
            return
        if stack[i][0] not in ("p", "dt", "dd", "td", "th"):
            return


def decide(b: Block) -> str:
    """Pass one."""
    if b.named or b.text.startswith("©") or b.linked >= MANY_LINKS * len(b.text):
        return BAD
    if not b.text.isascii() and len(b.text) >= max(LONG_SIGNS, NO_BLANKS * (b.text.count(" ") + 1)):
        signs = sum(map(b.text.count, FUNCTION_SIGNS))
        if signs >= SOME_FUNCTION_SIGNS * len(b.text):
            return CONTENT
    if len(b.text) < LONG_BLOCK:
        return SHORT
    words = b.text.lower().split()
    stop = sum(w.strip(".,;:!?\"'()") in _STOP for w in words)
    if stop >= SOME_STOP_WORDS * len(words) or b.inside:
        return CONTENT
    return SHORT


def classify(page_blocks: list[Block]) -> list[bool]:
    """Both passes: whether each block is content. A block's neighbours are looked for in its own container
    first, then in the article, if it is in one, then on the page."""
    labels = [decide(b) for b in page_blocks]
    if CONTENT not in labels and labels.count(SHORT) > 1 and not any(b.inside for b in page_blocks):
        return [x == SHORT for x in labels]  # nothing to inherit: a page of short blocks is its undecided blocks
    left, right = _nearest(page_blocks, labels, range(len(labels))), _nearest(page_blocks, labels, range(len(labels) - 1, -1, -1))
    out = []
    for i, (b, x) in enumerate(zip(page_blocks, labels)):
        if x != SHORT:
            out.append(x == CONTENT)
            continue
        for l, r in zip(left[i], right[i]):  # noqa: E741
            if l is not None or r is not None:
                break
        if l is None and r is None:
            out.append(b.inside)
        elif l is None or r is None or labels[l] == labels[r]:
            out.append(labels[r if l is None else l] == CONTENT)
        elif i - l == r - i:
            out.append(b.inside)
        else:
            out.append(labels[l if i - l < r - i else r] == CONTENT)
    return out


def _nearest(page_blocks: list[Block], labels: list[str], order: range) -> list[tuple[int | None, int | None, int | None]]:
    """For each block the last decided one met in the given order: in its container, in an article, anywhere (for
    a block in an article: in an article again)."""
    out: list[tuple[int | None, int | None, int | None]] = [(None, None, None)] * len(labels)
    box: dict[int, int] = {}
    inside = anywhere = None
    for i in order:
        b = page_blocks[i]
        out[i] = (box.get(b.box), inside, inside) if b.inside else (box.get(b.box), None, anywhere)
        if labels[i] != SHORT:
            box[b.box], anywhere = i, i
            inside = i if b.inside else inside
    return out


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    return " ".join(b.text for b, keep in zip(found, classify(found)) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """pages (page_id, url, html, ...) -> page_id, url, text, n_chars."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            text = [main_text(p) for p in b["html"]]
            yield pd.DataFrame({"page_id": b["page_id"].astype("Int64"), "url": b["url"], "text": text, "n_chars": [len(t) for t in text]})
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInPandas(
        run, "page_id long, url string, text string, n_chars long")
