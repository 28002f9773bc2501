"""Main text of web pages, by markup and by differencing with the page of the nearest URL.

A page is read into lines, one per block of text. Markup decides where it speaks: menus, headers, footers, sidebars, notices,
adverts, forms and comments go, the lines of an article stay. All other lines are aligned by longest common subsequence with those of
the nearest page with a different text in the order of URL paths of its host, before and behind; what both share with the page, its template, is deleted.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from itertools import chain, groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import as_bytes, batch, ship
from weirflow.llm.ordered import in_runs
from weirflow.llm.urls import split_url

LOOSE, MAIN, ARTICLE, TEMPLATE, _TITLE = range(5)

_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_SKIPPED = set("script style noscript template head title textarea select button svg iframe object canvas audio video math datalist".split())
_TEMPLATE_TAGS = set("nav header footer aside form menu dialog".split())
_CONTAINERS = _TEMPLATE_TAGS | set("html body article main div section ul ol dl table tbody thead tfoot tr figure details blockquote fieldset center".split())
_BLOCKS = _CONTAINERS | set("p h1 h2 h3 h4 h5 h6 li dt dd td th pre address caption figcaption summary hr hgroup legend".split())
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6", "hgroup"}
_TEMPLATE_WORDS = set(
    "ad ads advert advertisement adverts banner sponsor sponsored promo promotion sidebar widget menu nav navbar navigation breadcrumb "
    "breadcrumbs footer header masthead topbar cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe "
    "subscription signup login search share sharing social related recommended comment comments disqus respond replies pagination pager toolbar".split()
)
_COMMENTS = set("comment comments disqus respond replies".split())
_HEADERS = set("header masthead".split())
#: Beginnings of names that say what is beside or around an element, and not what it is: ``has-sidebar``.
_MODIFIERS = ("has-", "with-", "no-", "without-", "not-", "is-", "js-", "has_", "with_", "no_")
_TEMPLATE_ROLES = set("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
_WORD = re.compile(r"[^a-z0-9]+")


class _Reader(HTMLParser):
    """Collects (line, kind) of a page. End tags may be missing, and tags may close what is open below them."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int]] = []
        self.open: list[tuple[str, int]] = [("", LOOSE)]
        self.skipped: list[str] = []
        self.parts: list[str] = []
        self.heading = False

    def flush(self) -> None:
        line = " ".join("".join(self.parts).split())
        if line:
            kind = self.open[-1][1]
            self.lines.append((line, ARTICLE if kind == _TITLE and self.heading else TEMPLATE if kind == _TITLE else kind))
        self.parts = []

    def kind_of(self, tag: str, attrs: list) -> int:
        above = self.open[-1][1]
        if above == TEMPLATE:
            return above
        known = {k: v or "" for k, v in attrs}
        role = known.get("role", "").lower()
        if tag == "header" and above == ARTICLE:
            return _TITLE  # of an article's own header, its headings are the article's
        named = self.named(tag, role, known, above == ARTICLE)
        if named in (_TITLE, LOOSE):
            return named
        if (
            tag in _TEMPLATE_TAGS
            or role in _TEMPLATE_ROLES
            or named == TEMPLATE
            or "hidden" in known
            or known.get("aria-hidden") == "true"
            or "display:none" in known.get("style", "").replace(" ", "").lower()
        ):
            return TEMPLATE
        if tag == "article" or role == "article" or "articlebody" in known.get("itemprop", "").lower():
            return ARTICLE
        if (tag == "main" or role == "main") and above == LOOSE:
            return MAIN
        return above

    def named(self, tag: str, role: str, known: dict[str, str], within: bool) -> int | None:
        """What class and id say of an element: TEMPLATE, _TITLE or, where that is in doubt ``within`` an article, LOOSE; None if nothing.

        Names never overrule ``main``, ``body`` or an article that is no comment. Outside an article a part of a name is enough; within one
        a class has to be the very word, an id that of the comments, and the rest is left to differencing.
        """
        classes, ids = (set(x for x in known.get(k, "").lower().split() if not x.startswith(_MODIFIERS)) for k in ("class", "id"))
        if tag in ("html", "body", "main") or role == "main":
            return None
        if tag == "article" or role == "article":
            return TEMPLATE if classes & _COMMENTS else None
        if not within:
            return TEMPLATE if set(_WORD.split(" ".join(classes | ids))) & _TEMPLATE_WORDS else None
        if classes & _HEADERS:
            return _TITLE
        if classes & _TEMPLATE_WORDS or ids & _COMMENTS:
            return TEMPLATE
        return LOOSE if set(_WORD.split(" ".join(classes | ids))) & _TEMPLATE_WORDS else None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self.skipped:
            if tag == self.skipped[-1]:
                self.skipped.append(tag)
            elif self.skipped == ["head"] and tag == "body":  # an open head ends where the body begins
                self.skipped.clear()
            elif self.skipped == ["head"] and tag in _SKIPPED:
                self.skipped.append(tag)
            return
        if tag in _SKIPPED:
            if tag not in ("head", "title"):
                self.parts.append(" ")
            self.skipped.append(tag)
        elif tag == "br":
            self.parts.append(" ")
        elif tag in _BLOCKS:
            self.flush()
            self.heading = tag in _HEADINGS
            if tag in _CONTAINERS:
                self.open.append((tag, self.kind_of(tag, attrs)))
            elif tag not in _VOID and self.kind_of(tag, attrs) == TEMPLATE != self.open[-1][1]:
                self.open.append((tag, TEMPLATE))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)  # HTML knows no empty-element form

    def handle_endtag(self, tag: str) -> None:
        if self.skipped:
            if tag in self.skipped:
                while self.skipped.pop() != tag:
                    pass
            return
        if tag in _BLOCKS:
            self.flush()
            self.heading = False
            if any(t == tag for t, _ in self.open):
                while self.open.pop()[0] != tag:
                    pass

    def handle_data(self, data: str) -> None:
        if not self.skipped:
            self.parts.append(data)


def page_lines(html: str) -> list[tuple[str, int]]:
    """The lines of a page and what its markup says of each."""
    reader = _Reader()
    reader.feed(html)
    reader.close()
    reader.flush()
    return reader.lines


def _rows(a: list[int], b_bits: dict[int, int], m: int, keep: bool):
    """Bit rows of the longest common subsequence of each beginning of ``a`` with b; a zero bit is one more in common."""
    full = (1 << m) - 1
    row, out = full, []
    for x in a:
        u = row & b_bits.get(x, 0)
        row = ((row + u) | (row - u)) & full
        if keep:
            out.append(row)
    return out if keep else row


def _bits(b: list[int]) -> dict[int, int]:
    where: dict[int, int] = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | (1 << j)
    return where


def _common(a: list[int], b: list[int], most: int) -> list[int]:
    """Positions in ``a`` of a longest common subsequence with ``b``; halves ``a`` where the rows would take over ``most`` bits."""
    n, m = len(a), len(b)
    if not n or not m:
        return []
    if n == 1:
        return [0] if a[0] in b else []
    if n * m <= most:
        rows, found, i, j = _rows(a, _bits(b), m, True), [], n, m
        while i and j:
            if rows[i - 1] >> (j - 1) & 1:
                j -= 1
            else:
                i -= 1
                if not i or rows[i - 1] >> (j - 1) & 1:
                    found.append(i)
                    j -= 1
        return found[::-1]
    half = n // 2
    head, tail = _rows(a[:half], _bits(b), m, False), _rows(a[half:][::-1], _bits(b[::-1]), m, False)
    ahead, behind = [0], [0]
    for j in range(m):
        ahead.append(ahead[-1] + 1 - (head >> j & 1))
        behind.append(behind[-1] + 1 - (tail >> j & 1))
    cut = max(range(m + 1), key=lambda j: ahead[j] + behind[m - j])
    return _common(a[:half], b[:cut], most) + [half + i for i in _common(a[half:], b[cut:], most)]


def shared_lines(a: list[str], b: list[str], most: int = 1 << 28) -> list[int]:
    """Positions of the lines of ``a`` that a longest common subsequence of lines pairs with lines of ``b``."""
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    names: dict[str, int] = {}
    theirs = [names.setdefault(x, len(names)) for x in b[start : len(b) - end]]
    # Lines that the other page lacks are in no common subsequence.
    mine = [(i, names[x]) for i, x in enumerate(a[start : len(a) - end], start) if x in names]
    own = {x for _, x in mine}
    found = _common([x for _, x in mine], [x for x in theirs if x in own], most)
    return [*range(start), *(mine[i][0] for i in found), *range(len(a) - end, len(a))]


def main_text(lines: list[tuple[str, int]], neighbours: list[list[str]]) -> str:
    """The text of a page from its lines, and the lines of the pages beside it.

    A line that markup leaves open goes if it is shared with all neighbours, so a near copy on one side takes nothing.
    """
    gone: set[int] = set()
    if neighbours and any(kind in (LOOSE, MAIN) for _, kind in lines):
        own = [text for text, _ in lines]
        gone = set.intersection(*(set(shared_lines(own, other)) for other in neighbours))
    return "\n".join(text for i, (text, kind) in enumerate(lines) if kind == ARTICLE or (kind != TEMPLATE and i not in gone))


def _judged(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(page_id, url, text) of each page that is no guest, from rows in the order of host and path.

    Pages in a row with the same lines are copies; their neighbours are the pages before and behind all of them.
    """
    before = copies = None
    for _, group in chain(groupby(rows, key=lambda r: (r[0], r[1], r[5])), [(None, ())]):
        lines, after = None, []
        for row in group:
            lines = row[5]
            after.append((*row[:5], row[6], row[7]))
        after = (lines, after)
        if copies:
            run, host = copies[1][0][:2]
            near = [s[0] for s in (before, after) if s and s[1] and s[1][0][:2] == (run, host) and host]
            for row in copies[1]:
                if not row[6]:
                    yield row[3], row[4], main_text(list(zip(copies[0], row[5])), near)
        before, copies = copies, after


def extract_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of each page (page_id, url, html).

    Character references are decoded, white space inside a block becomes one space, blocks are joined by line breaks in page order. A
    null or empty html, and one without text of its own, has an empty text. A page without a host has no neighbour. Repeated rows are
    pages of their own. Other columns are not read; an empty table gives no rows.
    """
    ship(pages.sparkSession)
    own = split_url(pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html"))
    place = F.concat_ws("\1", "host", "path", F.lpad(F.coalesce(F.col("page_id").cast("string"), F.lit("")), 20, "0"))
    own = own.withColumn("place", place)
    head = "run int, host string, path string, page_id long, url string"

    def read(batches):
        for part in batches:
            for at in range(0, part.num_rows, 64):
                some = part.slice(at, 64)
                lines = [page_lines(h.decode("utf-8", "replace")) for h in as_bytes(some.column(some.schema.get_field_index("html")))]
                columns = {n: some.column(some.schema.get_field_index(n)) for n in ("run", "host", "path", "page_id", "url")}
                columns["lines"] = pa.array([[t for t, _ in x] for x in lines], pa.list_(pa.string()))
                columns["kinds"] = pa.array([[k for _, k in x] for x in lines], pa.list_(pa.int8()))
                columns |= {n: some.column(some.schema.get_field_index(n)) for n in ("guest", "place")}
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    def parsed(placed: DataFrame) -> DataFrame:
        return placed.mapInArrow(read, f"{head}, lines array<string>, kinds array<tinyint>, guest boolean, place string")

    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def judge(batches):
        rows = (row for part in batches for row in zip(*(part.column(i).to_pylist() for i in range(8))))
        held, size = [], 0
        for page_id, url, text in _judged(rows):
            held.append((page_id, url, text, len(text)))
            size += len(text)
            if size >= 4 << 20:
                yield batch(schema, *zip(*held))
                held, size = [], 0
        if held:
            yield batch(schema, *zip(*held))

    placed = in_runs(own, "place", before=True, prepare=parsed)
    return placed.sortWithinPartitions("run", "place").drop("place").mapInArrow(judge, "page_id long, url string, text string, n_chars long")
