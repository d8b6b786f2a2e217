"""Main text of web pages: the maximum-scoring stretch of words and tags.

Words score positive and tags negative, by weights counted on pages whose markup names
their article. One scan finds the contiguous stretch with the highest sum. Inside it, parts that are no
article (adverts, forms, comments and the like) are left out.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm.common import map_batches, table

# Kinds of elements of HTML. Fixed values, in natural order.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section summary"
    " table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes script style svg math template textarea title xmp".split())
NEVER_CONTENT = frozenset(
    "aside button canvas datalist dialog footer form head iframe input label math menu nav noscript object option"
    " script search select style svg template textarea title".split()
)
ARTICLE = frozenset("article main".split())
# Tags that a stretch crosses only for very much text.
BOUNDS = ARTICLE | frozenset("body html".split())
# Words in class, id and role that name parts of a page other than the article.
HINTS = frozenset(
    "ad ads adsense advert advertisement advertising adverts alert banner breadcrumb breadcrumbs colophon"
    " comment commentlist comments complementary consent contentinfo cookie cookies copyright disclaimer disqus footer footnav gdpr"
    " header login masthead menu menubar modal nav navbar navigation newsletter notice pagination pager"
    " paywall popup promo promoted promotion recommended related replies reply responses search share sharing sidebar"
    " signup skip social sponsor sponsored subscribe subscription toolbar widget".split()
)
# Names that tell what a container has or may have, not what it is.
STATES = re.compile(r"(?:has|with|no|is|show|hide|supports)[-_]|.*[-_](?:open|closed|enabled|disabled|visible)$")
WHOLE = frozenset("body html main".split())

TAG_NAME = re.compile(r"[^\s/>]*")
TAG_MARK = re.compile(r"""["'>]""")
# Numeric references of leading zeros, and of more digits than any character has.
ZEROS, TOO_LONG = re.compile(r"&#0+(?=[0-9])"), re.compile(r"&#[0-9]{9,};?")
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.IGNORECASE)

# What the counts start from, as rows of content and of other parts, for words and for tags.
WORD_START, TAG_START = (4.0, 2.0), (2.0, 4.0)


def hinted(name: str, rest: str, in_article: bool) -> bool:
    """Do the element's class, id or role name a part that is no article?

    A header within an article is its own, as its title often stands there.
    """
    if "=" not in rest or name in WHOLE:
        return False
    for m in NAMED.finditer(rest):
        for value in next(g for g in m.groups() if g is not None).split():
            if STATES.match(value):
                continue
            named = {p.lower() for p in PARTS.findall(value)} & HINTS
            if named - {"header"} if in_article else named:
                return True
    return bool(HIDDEN.search(rest))


class Tags:
    """Where tags end. Every stretch of the page is searched once, however many tags are left open in it."""

    def __init__(self, page: str):
        self.page = page
        self.name_end = 0
        self.mark_from, self.mark = 0, -1  # no quote or > lies between the two
        self.unclosed: set[int] = set()  # quotes from which no tag ends

    def _next_mark(self, at: int) -> int:
        if not self.mark_from <= at <= self.mark:
            found = TAG_MARK.search(self.page, at)
            self.mark_from, self.mark = at, found.start() if found else len(self.page)
        return self.mark

    def end(self, start: int) -> tuple[int, int] | None:
        """Where the name that starts here and its tag end, the latter at a > outside of quotes; None without one."""
        page = self.page
        if start >= self.name_end:
            self.name_end = TAG_NAME.match(page, start).end()
        passed = []
        at = self._next_mark(self.name_end)
        while at < len(page) and page[at] != ">" and at not in self.unclosed:
            passed.append(at)
            close = page.find(page[at], at + 1)
            if close < 0:
                break
            at = self._next_mark(close + 1)
        else:
            if at < len(page) and page[at] == ">":
                return self.name_end, at
        self.unclosed.update(passed)
        return None


def tokens(page: str) -> Iterator[tuple[str, str | None, str]]:
    """Texts as (text, None, ""), tags as ("" or "/" if closing, name, rest) in page order, in linear time.

    Comments, CDATA sections and declarations are passed over; an open comment takes the rest of the page. A < that
    opens nothing is text.
    """
    tags = Tags(page)
    at, n = 0, len(page)
    no_section = no_declaration = False
    while at < n:
        start = page.find("<", at)
        if start < 0:
            yield page[at:], None, ""
            return
        if start > at:
            yield page[at:start], None, ""
        at = start + 1
        if page.startswith("<!--", start):
            close = page.find("-->", start + 4)
            if close < 0:
                return
            at = close + 3
            continue
        if not no_section and page.startswith("<![CDATA[", start):
            close = page.find("]]>", start + 9)
            if close >= 0:
                at = close + 3
                continue
            no_section = True
        if page.startswith(("<!", "<?"), start):
            close = -1 if no_declaration else page.find(">", start + 2)
            no_declaration = close < 0
            if close >= 0:
                at = close + 1
                continue
        else:
            closing = page.startswith("/", start + 1)
            first = start + 1 + closing
            if page[first : first + 1].isalpha() and page[first].isascii():
                ends = tags.end(first)
                if ends:
                    yield "/" if closing else "", page[first : ends[0]].lower(), page[ends[0] : ends[1]]
                    at = ends[1] + 1
                    continue
        yield "<", None, ""


class Open:
    """The open elements, with what is asked of them at every word."""

    def __init__(self):
        self.stack: list[tuple[str, bool]] = []  # names, and whether each is off
        self.blocks: list[str] = []
        self.named: Counter = Counter()
        self.off = self.articles = 0

    def push(self, name: str, is_off: bool) -> None:
        self.stack.append((name, is_off))
        self.named[name] += 1
        self.off += is_off
        if name in BLOCKS:
            self.blocks.append(name)
            self.articles += name in ARTICLE

    def pop(self) -> str:
        name, was_off = self.stack.pop()
        self.named[name] -= 1
        self.off -= was_off
        if name in BLOCKS:
            self.blocks.pop()
            self.articles -= name in ARTICLE
        return name

    def close(self, name: str) -> None:
        """Close the innermost element of the name and all within it; nothing if none is open."""
        if self.named[name]:
            while self.pop() != name:
                pass


def pieces(page: str) -> Iterator[tuple[str, str, bool, bool]]:
    """The page as (kind, text, starts a block, is content's own) in page order.

    Kind is `tag <name>` or `word <block> [link] [off]`; text is empty for tags. `off` marks what lies in an
    element that is never content. The last value tells whether an article element is open.
    """
    opened = Open()
    skip_to = None
    for text, name, rest in tokens(page):
        if skip_to is not None:
            if text != "/" or name != skip_to:
                continue
        elif name is None:
            block = opened.blocks[-1] if opened.blocks else "body"
            kind = f"word {block}{' link' if opened.named['a'] else ''}{' off' if opened.off else ''}"
            yield kind, text, False, opened.articles > 0
            continue
        is_block = name in BLOCKS
        if not text:
            if is_block and opened.stack and opened.stack[-1][0] == "p":
                # a block ends an open paragraph
                opened.pop()
            if name in ("li", "dd", "dt", "tr", "td", "th", "option") and any(e == name for e, _ in opened.stack[-3:]):
                opened.close(name)
            articles = opened.articles > 0
            is_off = name in NEVER_CONTENT or hinted(name, rest, articles) or (name == "header" and not articles)
            yield f"tag {name if is_block or name == 'a' else 'inline'}{' off' if is_off else ''}", "", is_block, articles
            if name in VOID or rest.endswith("/"):
                if name == "br":
                    yield "word br", " ", False, articles
                continue
            if name in RAW:
                skip_to = name
            opened.push(name, is_off)
        else:
            skip_to = None
            opened.close(name)
            yield f"tag {name if is_block or name == 'a' else 'inline'}", "", is_block, opened.articles > 0


def count_kinds(page: str) -> Counter:
    """(kind, inside) to number of words or tags, on a page whose markup names an article.

    Inside is what lies in an article element and in none that is off. Other pages count nothing.
    """
    found: Counter = Counter()
    any_article = False
    for kind, text, _, inside in pieces(page):
        any_article |= inside
        n = len(text.split()) if kind.startswith("word") else 1
        if n:
            found[kind, inside and not kind.endswith(" off")] += n
    return found if any_article else Counter()


def weights(counts: dict[tuple[str, bool], int]) -> dict[str, float]:
    """Log odds of lying in the article, by kind; words at least a little positive, tags negative.

    Words in parts that are never content are negative, and so may be words of links. Tags within an article cost
    little, so that lists and links in it hold together.
    """
    out = {}
    for kind in {k for k, _ in counts}:
        start = WORD_START if kind.startswith("word") else TAG_START
        odds = log((counts.get((kind, True), 0) + start[0]) / (counts.get((kind, False), 0) + start[1]))
        out[kind] = _signed(kind, odds)
    return out


def _signed(kind: str, odds: float) -> float:
    if kind.startswith("word"):
        if kind.endswith(" off"):
            return min(max(odds, -3.0), -0.5)
        if kind.endswith(" link"):
            return min(max(odds, -3.0), 0.2)
        return min(max(odds, 0.2), 2.0)
    if kind.removeprefix("tag ") in BOUNDS:
        return min(8 * odds, -12.0)
    return min(max(odds - 1.0, -6.0 if kind.endswith(" off") else -1.0), -0.1)


def weight(known: dict[str, float], kind: str) -> float:
    return known[kind] if kind in known else _signed(kind, 1.0 if kind.startswith("word") else -1.0)


def unescaped(text: str) -> str:
    """Character references decoded; numbers beyond all characters, of any length, become U+FFFD."""
    if "&#" in text:
        text = TOO_LONG.sub("\ufffd", ZEROS.sub("&#", text))
    return html.unescape(text)


def main_text(page: str | None, known: dict[str, float]) -> str:
    """The article: blocks in page order, joined by one line break; empty if there is none."""
    if not page:
        return ""
    items = list(pieces(page))
    best = total = 0.0
    start = first = last = 0
    for i, (kind, text, _, _) in enumerate(items):
        n = len(text.split()) if kind.startswith("word") else 1
        total += n * weight(known, kind)
        if total <= 0:
            total, start = 0.0, i + 1
        elif total > best:
            best, first, last = total, start, i + 1
    blocks: list[list[str]] = [[]]
    for kind, text, starts_block, _ in items[first:last]:
        if starts_block:
            blocks.append([])
        elif text and not kind.endswith(" off"):
            blocks[-1].append(text)
    lines = (" ".join(unescaped("".join(b)).split()) for b in blocks)
    return "\n".join(line for line in lines if line)


def learn_weights(pages: DataFrame, column: str = "html") -> dict[str, float]:
    """Weights counted over all pages. The kinds are bounded by the elements of HTML."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for page in batch.column(column).to_pylist():
                if page:
                    total.update(count_kinds(page))
        kinds, inside, n = zip(*[(k, i, c) for (k, i), c in total.items()]) if total else ((), (), ())
        arrays = [pa.array(kinds, pa.string()), pa.array(inside, pa.bool_()), pa.array(n, pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, names=["kind", "inside", "n"])

    counted = map_batches(pages.select(column), count, "kind string, inside boolean, n bigint")
    rows = counted.groupBy("kind", "inside").agg(F.sum("n").alias("n")).collect()
    return weights({(r["kind"], r["inside"]): r["n"] for r in rows})


def extract(pages: DataFrame, known: dict[str, float], column: str = "html", keep: list[str] | None = None) -> DataFrame:
    """Add the main `text` and `n_chars`, its code points, keeping `keep` (all other columns).

    A NULL or empty page has the empty text. Columns named `text` or `n_chars` are replaced.
    """
    kept = [c for c in (pages.columns if keep is None else keep) if c not in ("text", "n_chars")]
    schema = "".join(f"`{c}` {pages.schema[c].dataType.simpleString()}, " for c in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p, known) for p in batch.column("_page").to_pylist()]
            new = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            names = [*kept, "text", "n_chars"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *new], names=names)

    return map_batches(pages.select(*kept, F.col(column).alias("_page")), run, f"{schema}text string, n_chars bigint")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages, by weights counted on all pages."""
    pages = table(spark, sf_dir, "pages")
    return extract(pages, learn_weights(pages), keep=["page_id", "url"])
