"""Main text of web pages by block rules in two passes.

A page is cut into blocks at block-level tags.  Pass one decides a block where
its evidence is clear:

* boilerplate: it stands in a menu, header, footer, sidebar, form or the like,
  by its tag, role, class or id; or most of its characters are in links.  A class or
  id tells by its whole or its first part (``sidebar``, ``comment-list``), where no
  <main> is inside; by its last part (``with-sidebar``) only where no <article> is
  inside either and it does not hold the greater part of the page's words, and the
  same goes for <form>.  <article> is marked by whole or first parts only, <main> never;
* content: it is long, or has a good share of stop words, and few links, in a
  landmark or not;
* a heading, and any other short block, stays undecided.

In pass two undecided blocks take the label of the nearest decided neighbour
inside the same landmark (<article>, <main>), at equal distance that of content.
What stands in a menu and the like has no say for blocks of more than a few words.
In a landmark that has no decided block they are content.  Where landmarks hold the
greater part of a page's content words, all text outside of them is boilerplate;
where they do not, they are elements like others.

Stop words are those of the corpus, counted over all pages: for each language that
pages declare (<html lang>) the words that the greatest share of its pages has in
their paragraphs.  Pages that declare none may be of many: of their words also all
that one page in a hundred has.

Markup is read leniently: unclosed and stray tags, omitted ends of <head> and others,
comments and scripts that hold tags, attributes in any form.  Time is in proportion to
a page's length.  Character references are decoded, white
space inside a block becomes one space.  Null and empty pages have no text.
Repeated rows get equal results.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from scholarlake.llm.common import map_batches, slices, stored

# Names of HTML.  What they stand for is in the comments.
# Their content is no text.
HIDDEN = (
    "script style noscript template svg iframe object canvas select textarea head title"
    " annotation annotation-xml"
)
# They may stand in <head>; any other one ends it.
IN_HEAD = "base link meta noscript script style template title"
# Never part of an article's text.
BOILERPLATE = "nav header footer aside form button menu dialog fieldset"
# They end a block.
BLOCK = (
    "address article aside blockquote body br button caption center dd details dialog div dl dt"
    " fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main"
    " menu nav ol option p pre section summary table tbody td tfoot th thead tr ul"
)
# They have no end tag.
VOID = "area base br col embed hr img input link meta param source track wbr"
ROLES = "navigation banner contentinfo complementary search form menu dialog alert"
# Names in a class or an id that mark boilerplate: each as a whole, or as a part.
WHOLE_NAMES = "form skip social notice notices reply replies tags"
NAMES = (
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment"
    " comments consent cookie cookies copyright disclaimer disqus feedback footer gdpr header"
    " login masthead menu modal nav navbar navigation newsletter notification"
    " overlay pagination pager popup promo promoted promotion recommended related"
    " respond share sharing sidebar signup sponsor sponsored subscribe toolbar"
    " widget"
)
# First parts of names whose last part tells of the article itself.
OWN_PARTS = "article content entry post story"

_HIDDEN, _IN_HEAD, _BOILERPLATE, _BLOCK, _VOID, _ROLES, _NAMES, _OWN_PARTS = (
    frozenset(names.split())
    for names in (HIDDEN, IN_HEAD, BOILERPLATE, BLOCK, VOID, ROLES, NAMES, OWN_PARTS)
)
_WHOLE_NAMES = _NAMES | frozenset(WHOLE_NAMES.split())
_LANDMARKS = frozenset({"article", "main"})
# A start of any of these closes an open one of the same kind.
_CLOSES_ITSELF = frozenset("p li dd dt option tr td th".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

LONG = 12  # words
SHORT = 3
STOP_SHARE = 0.25  # of a block's words
LINK_SHARE = 0.5  # of a block's characters
STOP_WORDS = 60  # of a language
UNDECLARED_SHARE = 0.01  # of the pages that declare no language
UNDECLARED_PAGES = 5

# A quote counts behind an equals sign only; what has no end ends with the page.
_TOKEN = re.compile(
    r"<(?:!--.*?(?:-->|\Z)"
    r"|(?P<raw>script|style|noscript|template|textarea|title|iframe)\b[^>]*>"
    r".*?(?:</(?P=raw)\s*>|\Z)"
    r"|[!?][^>]*(?:>|\Z)"
    r"|(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)"
    r"(?P<rest>(?:[^>=]++|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))?)*+)(?:>|\Z))",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(
    r"\b(class|id|role|hidden|aria-hidden|style)\b\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?",
    re.IGNORECASE,
)
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# How surely an element is boilerplate.
NO, WEAK, STRONG, HARD = range(4)


def _named(value: str) -> int:
    """What the names of a class or an id say."""
    most = NO
    for name in value.split():
        parts = [part.lower() for part in _NAME_PART.findall(name)]
        if name.lower() in _WHOLE_NAMES or parts and parts[0] in _NAMES:
            return STRONG
        if parts and parts[-1] in _NAMES and parts[0] not in _OWN_PARTS:
            most = WEAK
    return most


def _marked(rest: str) -> int:
    """How surely a tag's attributes mark its content as boilerplate."""
    most = NO
    for name, value in _ATTRIBUTE.findall(rest):
        name, value = name.lower(), value.strip("\"' ")
        if name in ("class", "id"):
            most = max(most, _named(value))
        elif name == "role":
            if value.lower() in _ROLES:
                most = HARD
        elif name == "hidden":
            most = HARD
        elif name == "aria-hidden":
            if value.lower() == "true":
                most = HARD
        elif re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE):
            most = HARD
    return most


class Element:
    """An open or closed element, as far as its marks and landmarks go."""

    __slots__ = ("name", "parent", "mark", "holds", "words", "hard", "bad", "landmark")

    def __init__(self, name: str, parent: Element | None, mark: int):
        self.name = name
        self.parent = parent
        self.mark = mark
        self.hard = mark == HARD or parent is not None and parent.hard
        self.holds = 0  # 1 an <article>, 2 a <main>
        self.words = 0
        self.bad = False
        self.landmark = 0  # 0 is none


class Block:
    """A run of text without a block-level tag."""

    __slots__ = ("text", "linked", "heading", "element", "size")

    def __init__(self, text: str, linked: int, heading: bool, element: Element):
        self.text = text
        self.linked = linked  # characters inside links
        self.heading = heading
        self.element = element
        self.size = _n_words(text)

    @property
    def bad(self) -> bool:
        return self.element.bad

    @property
    def landmark(self) -> int:
        return self.element.landmark


def _mark(name: str, rest: str) -> int:
    """How surely an element is boilerplate by itself."""
    if name in ("html", "body", "main"):  # the page is not marked by what it is called
        return NO
    if name == "form":
        return max(WEAK, _marked(rest))
    if name in _BOILERPLATE:
        return HARD
    mark = _marked(rest)
    return NO if name == "article" and mark == WEAK else mark


def blocks_of(page: str) -> list[Block]:
    out: list[Block] = []
    parts: list[str] = []
    linked = 0
    root = Element("", None, NO)
    elements = [root]
    stack = [root]
    opened: dict[str, int] = {}  # names on the stack
    hidden = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            heading = any(element.name in _HEADINGS for element in stack[-3:])
            out.append(Block(text, linked, heading, stack[-1]))
        parts.clear()
        linked = 0

    def close(upto: int) -> None:
        nonlocal hidden
        for element in stack[upto:]:
            hidden -= element.name in _HIDDEN
            opened[element.name] -= 1
        del stack[upto:]

    def last(name: str) -> int:
        return next(i for i in range(len(stack) - 1, -1, -1) if stack[i].name == name)

    def add(text: str) -> None:
        nonlocal linked
        if text and opened.get("head") and not text.isspace() and stack[-1].name == "head":
            close(last("head"))
        if text and not hidden:
            parts.append(text)
            if any(element.name == "a" for element in stack[-4:]):
                linked += len(" ".join(text.split()))

    at = 0
    for token in _TOKEN.finditer(page):
        add(page[at : token.start()])
        at = token.end()
        name = token["name"]
        if not name:
            continue
        name = name.lower()
        if token["end"]:
            if name in _BLOCK:
                flush()
            if opened.get(name):
                close(last(name))
            continue
        if name in _BLOCK:
            flush()
            if name in _CLOSES_ITSELF and name in (element.name for element in stack[-2:]):
                close(last(name))
        if opened.get("head") and name not in _IN_HEAD:
            close(last("head"))
        if name in _VOID or token["rest"].endswith("/"):
            continue
        element = Element(name, stack[-1], _mark(name, token["rest"]))
        if name in _LANDMARKS and not element.hard and element.mark < STRONG:
            kind, above = (2 if name == "main" else 1), stack[-1]
            while above is not None and above.holds < kind:
                above.holds = kind
                above = above.parent
        elements.append(element)
        stack.append(element)
        opened[name] = opened.get(name, 0) + 1
        hidden += name in _HIDDEN
    add(page[at:])
    flush()
    _settle(elements, out)
    return out


def _settle(elements: list[Element], blocks: list[Block]) -> None:
    """Which elements are boilerplate and which landmark they are in, top down."""
    for block in blocks:
        if not block.element.hard:
            block.element.words += block.size
    for element in reversed(elements[1:]):
        element.parent.words += element.words
    total = elements[0].words
    landmarks = 0
    for element in elements[1:]:
        above, mark = element.parent, element.mark
        excused = element.holds == 2 or mark == WEAK and (
            element.holds == 1 or 2 * element.words > total
        )
        element.bad = above.bad or mark == HARD or mark != NO and not excused
        element.landmark = above.landmark
        if element.name in _LANDMARKS and not element.bad:
            landmarks += 1
            element.landmark = landmarks


# Scripts that put no spaces between words; a word has about four characters or fewer.
_UNSPACED = re.compile(
    "[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\U00020000-\U0003ffff]"
)


def _n_words(text: str) -> int:
    n = len(text.split())
    return n if text.isascii() else max(n, len(_UNSPACED.findall(text)) // 4)


def labels(blocks: list[Block], stop_words: frozenset[str]) -> list[bool]:
    """For each block whether it is content."""
    decided: list[bool | None] = []
    words_in = words_out = 0
    for block in blocks:
        words = block.text.lower().split()
        stops = sum(map(stop_words.__contains__, words)) / len(words)
        links = block.linked / len(block.text)
        if block.bad or links > LINK_SHARE:
            decided.append(False)
        elif block.heading or block.size <= SHORT:
            decided.append(None)
        elif block.size >= LONG or stops >= STOP_SHARE:
            decided.append(True)
            words_in += block.size if block.landmark else 0
            words_out += 0 if block.landmark else block.size
        else:
            decided.append(None)
    has_landmark = any(block.landmark for block in blocks) and words_in >= words_out
    nearest, any_content = _nearest(blocks, decided), any(decided)
    out = []
    for block, own, near in zip(blocks, decided, nearest, strict=True):
        label = near if own is None else own
        if label is None:
            label = bool(block.landmark) or not has_landmark and not any_content
        out.append(label and (bool(block.landmark) or not has_landmark))
    return out


def _nearest(blocks: list[Block], decided: list[bool | None]) -> list[bool | None]:
    """For undecided blocks the label of the nearest decided one in the same landmark.

    One walk from either end: per landmark the last decided block, and the last one that
    does not stand in a menu and the like.
    """
    out: list[tuple[int, bool] | None] = [None] * len(blocks)
    for order in (range(len(blocks)), range(len(blocks) - 1, -1, -1)):
        seen: dict[tuple[int, bool], int] = {}
        for i in order:
            block = blocks[i]
            if decided[i] is None:
                no_bad = bool(block.landmark) or block.size > SHORT
                j = seen.get((block.landmark, no_bad))
                if j is not None:
                    found = (abs(i - j), not decided[j])
                    out[i] = found if out[i] is None else min(out[i], found)
                continue
            seen[block.landmark, False] = i
            if not block.bad:
                seen[block.landmark, True] = i
    return [None if found is None else not found[1] for found in out]


def main_text(page: str, stop_words: frozenset[str]) -> str:
    blocks = blocks_of(page)
    kept = labels(blocks, stop_words)
    return " ".join(b.text for b, keep in zip(blocks, kept, strict=True) if keep)


_PARAGRAPH = re.compile(r"<p[\s>].*?(?=</?p[\s>]|\Z)", re.DOTALL | re.IGNORECASE)
_ANY_TAG = re.compile(r"<[^>]*>")


_LANGUAGE = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?\s*([a-z]{2,3})\b", re.IGNORECASE)


def _language(page: str) -> str:
    """What a page declares itself to be written in; empty if it does not."""
    found = _LANGUAGE.search(page)
    return found[1].lower() if found else ""


def stop_words(
    pages: DataFrame, most: int = STOP_WORDS, share: float | None = None
) -> frozenset[str]:
    """The words of at most four letters that most pages of a language have in their paragraphs.

    With ``share``, also all that this share of the pages without a language has.
    """

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            counts: dict[tuple[str, str], int] = {}
            for page in batch.column("html").to_pylist():
                language = _language(page or "")
                seen: set[str] = {""}  # counts the pages
                for part in _PARAGRAPH.findall(page or ""):
                    seen.update(_ANY_TAG.sub(" ", part).lower().split())
                for word in seen:
                    if not word or len(word) <= 4 and word.isalpha():
                        counts[language, word] = counts.get((language, word), 0) + 1
            yield pa.RecordBatch.from_pydict(
                {
                    "language": [language for language, _ in counts],
                    "word": [word for _, word in counts],
                    "n": list(counts.values()),
                },
                schema=pa.schema(
                    [("language", pa.string()), ("word", pa.string()), ("n", pa.int64())]
                ),
            )

    counted = (
        pages.select("html")
        .mapInArrow(distinct, "language string, word string, n bigint")
        .groupBy("language", "word")
        .agg(F.sum("n").alias("n"))
    )
    if share is not None:
        counted = stored(counted)
    words = counted.where("word != ''")
    place = F.row_number().over(Window.partitionBy("language").orderBy(F.desc("n"), "word"))
    best = words.withColumn("place", place).where(F.col("place") <= most)
    out = {row.word for row in best.collect()}
    if share is not None:
        undeclared = F.col("language") == ""
        total = counted.where(undeclared & (F.col("word") == "")).first()
        if total:
            least = max(UNDECLARED_PAGES, share * total.n)
            out.update(row.word for row in words.where(undeclared & (F.col("n") >= least)).collect())
    return frozenset(out)


def extracted(pages: DataFrame) -> DataFrame:
    """Per row of (page_id, url, html): page_id, url, text, n_chars."""
    stops = stop_words(pages, share=UNDECLARED_SHARE)

    def read(batch: pa.RecordBatch) -> dict:
        texts = [main_text(page or "", stops) for page in batch.column("html").to_pylist()]
        return {
            "page_id": batch.column("page_id"),
            "url": batch.column("url"),
            "text": texts,
            "n_chars": list(map(len, texts)),
        }

    kind = pages.schema["page_id"].dataType.simpleString()
    return map_batches(
        pages.select("page_id", F.col("url").cast("string"), "html"),
        read,
        f"page_id {kind}, url string, text string, n_chars bigint",
    )
