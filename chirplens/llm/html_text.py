"""Main text of web pages by differencing pages of near addresses.

A page is read as lines, one per block.  Parts that markup names as navigation, advert, form and
the like are left out at once.  Of what remains, lines that a page shares with the page next to
it in address order, aligned by a longest common subsequence, are boilerplate of the site.  Every
page is aligned.  Lines inside an ``article`` or ``main`` element are content by the page's own
word and stay even if they are shared; all others stay if they are not shared.  A page without
such an element that is a copy of its neighbour keeps all lines.
"""

from __future__ import annotations

import html
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chirplens.llm.common import as_text, bound_batches

# Two pages of which so large a part is shared are copies of one another.
COPY_SHARE = 0.8
# Pages in a range of addresses that is read in one go, and most rows sampled for the ranges.
RANGE_PAGES = 500
SAMPLE_ROWS = 8192
# A table of at most so many bits is kept to trace an alignment; longer lists are halved.
_TRACE_BITS = 1 << 26

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([A-Za-z][A-Za-z0-9:-]*)([^>]*)>",
    re.DOTALL,
)
_RAW = {"script", "style", "textarea", "title", "xmp"}
_RAW_END = {tag: re.compile(rf"</{tag}\b[^>]*>", re.IGNORECASE) for tag in _RAW}
_DROPPED = _RAW | {
    "nav", "footer", "aside", "form", "noscript", "template", "iframe", "svg", "button",
    "select", "menu", "dialog", "object", "canvas", "head",
}
_VOID = {"br", "hr", "img", "input", "meta", "link", "wbr", "source", "area", "base", "col", "embed", "track"}
_INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
    "img", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
    "time", "tt", "u", "var", "wbr",
}
_CONTENT = {"article", "main"}
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)|\b(hidden)\b")
_NAMED = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adbox|advert\w*|banner|sponsor\w*|promo\w*|cookie\w*|consent|notice|sidebar|menu|nav"
    r"|navbar|navigation|breadcrumbs?|comments?|commentlist|disqus|footer|header|masthead|share|sharing|social|related|popup|modal"
    r"|newsletter|subscribe|login|signup|widget)(?:$|[\s_-])"
)
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert"}


def _unwanted(tag: str, attributes: str, inside: bool) -> bool:
    """Whether an element is left out by its tag or by what its attributes call it."""
    if tag in _DROPPED or tag == "header" and not inside:
        return True
    if not attributes or tag in ("body", "html"):
        return False
    for name, value, hidden in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if hidden or name == "aria-hidden" and value == "true":
            return True
        if name in ("class", "id") and _NAMED.search(value) or name == "role" and value in _ROLES:
            return True
        if name == "style" and "display:none" in value.replace(" ", ""):
            return True
    return False


def page_lines(page: str | None) -> list[tuple[bool, str]]:
    """``(in content, text)`` of each block of a page that is not left out, in page order."""
    page = page or ""
    lines: list[tuple[bool, str]] = []
    text: list[str] = []
    skipped, depth, content = "", 0, 0
    at = 0

    def close() -> None:
        line = " ".join(html.unescape("".join(text)).split())
        if line:
            lines.append((content > 0, line))
        text.clear()

    while True:
        m = _TAG.search(page, at)
        if not skipped:
            text.append(page[at : m.start() if m else len(page)])
        if not m:
            break
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        ends, attributes = bool(m[1] or m[4]), m[3] or m[6] or ""
        if not ends and tag in _RAW:
            end = _RAW_END[tag].search(page, at)
            at = end.end() if end else len(page)
            if not skipped and tag not in _INLINE:
                close()
            continue
        if skipped:
            if tag in _CONTENT and not ends and not _unwanted(tag, attributes, True):
                # Content never lies in a part left out: that part was not closed.
                skipped = ""
            else:
                if tag == skipped:
                    depth += -1 if ends else 1
                    if not depth:
                        skipped = ""
                continue
        if tag in ("br", "hr"):
            text.append(" ")
            continue
        if tag not in _INLINE and tag not in _VOID:
            close()
        if ends:
            if tag in _CONTENT and content:
                content -= 1
        elif tag not in _VOID and not attributes.endswith("/") and _unwanted(tag, attributes, content > 0):
            close()
            skipped, depth = tag, 1
        elif tag in _CONTENT:
            content += 1
    close()
    return lines


def _lengths(a: list[int], b: list[int]) -> list[int]:
    """After each line of ``a`` a number whose zero bits are where the common length grows."""
    places: dict[int, int] = {}
    for i, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(b)) - 1
    row, rows = full, []
    for x in a:
        hit = row & places.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
        rows.append(row)
    return rows


def shared_lines(a: list[int], b: list[int]) -> list[int]:
    """Places in ``a`` of a longest common subsequence of ``a`` and ``b``."""
    first = 0
    while first < min(len(a), len(b)) and a[first] == b[first]:
        first += 1
    last = 0
    while last < min(len(a), len(b)) - first and a[-1 - last] == b[-1 - last]:
        last += 1
    head, tail = list(range(first)), list(range(len(a) - last, len(a)))
    a, b = a[first : len(a) - last], b[first : len(b) - last]
    common = set(a) & set(b)
    place = [i for i, x in enumerate(a) if x in common]
    inner = _aligned([a[i] for i in place], [x for x in b if x in common])
    return head + [first + place[i] for i in inner] + tail


def _aligned(a: list[int], b: list[int]) -> list[int]:
    if not a or not b:
        return []
    if len(a) > 1 and len(a) * len(b) > _TRACE_BITS:
        half = len(a) // 2
        left, right = _lengths(a[:half], b)[-1], _lengths(a[half:][::-1], b[::-1])[-1]
        rise_left = [0]
        for j in range(len(b)):
            rise_left.append(rise_left[-1] + (not left >> j & 1))
        rise_right = [0]
        for j in range(len(b)):
            rise_right.append(rise_right[-1] + (not right >> j & 1))
        cut = max(range(len(b) + 1), key=lambda j: rise_left[j] + rise_right[len(b) - j])
        return _aligned(a[:half], b[:cut]) + [half + i for i in _aligned(a[half:], b[cut:])]
    rows = [(1 << len(b)) - 1, *_lengths(a, b)]

    def length(i: int, j: int) -> int:
        return j - (rows[i] & ((1 << j) - 1)).bit_count()

    found, i, j = [], len(a), len(b)
    here = length(i, j)
    while here:
        if length(i - 1, j) == here:
            i -= 1
            continue
        while length(i, j - 1) == here:
            j -= 1
        found.append(i - 1)
        i, j, here = i - 1, j - 1, here - 1
    return found[::-1]


def main_lines(
    lines: list[str], own: list[int], other: list[int] | None, content: list[bool] | None = None
) -> list[str]:
    """The lines without those shared with a neighbour, or all of them if the two are copies.

    Lines marked as ``content`` stay in any case.  Where no neighbour can tell, they are all that
    stays of a page that has some.
    """
    marks = content or [False] * len(lines)
    if other is None:
        return [x for x, mark in zip(lines, marks, strict=True) if mark] or lines
    shared = set(shared_lines(own, other))
    size = sum(map(len, lines))
    if not any(marks) and sum(len(lines[i]) for i in shared) >= COPY_SHARE * size:
        return lines
    return [x for i, x in enumerate(lines) if marks[i] or i not in shared]


def address(url: str | None) -> tuple[str, str]:
    """Host and path of a URL; what cannot be parsed is all path."""
    try:
        parts = urlsplit(url or "")
        return (parts.hostname or "").lower(), parts.path
    except ValueError:
        return "", url or ""


def _ranges(pages: DataFrame, id_col: str, url_col: str) -> list[tuple]:
    """Where the ranges of addresses begin: evenly spaced rows of a sample by hash, which has
    about ``SAMPLE_ROWS`` rows at any table size."""
    n = pages.count()
    every = 1 + n // SAMPLE_ROWS
    key = F.xxhash64(url_col, id_col)
    rows = pages.select(url_col, F.col(id_col).cast("string").alias("id"), key.alias("h"))
    rows = rows.where(F.pmod("h", F.lit(every)) == 0).distinct().collect()
    keys = sorted((*address(r[url_col]), r[url_col] or "", r["id"] or "") for r in rows)
    wanted = min(len(keys), n // RANGE_PAGES)
    return [keys[len(keys) * i // (wanted + 1)] for i in range(1, wanted + 1)]


def extract_main_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every page.

    Pages are sorted by host and path within ranges of addresses, which split a host with very
    many pages; a page is compared with the one before it of the same host and range, the first
    with the one after it, one page in memory at a time.  A page alone in its host is not
    compared: of its lines those in an ``article`` or ``main`` element count, or all.  Character references are decoded, white space in a block is one space, blocks are
    joined by one space.

    NULL and empty pages have an empty text; NULL URLs belong to the host without a name.
    Repeated rows are copies of each other and keep their text.  Texts are whole.
    """
    bound_batches(pages.sparkSession)
    starts = _ranges(pages, id_col, url_col)
    kind = pages.schema[id_col].dataType
    parsed = T.StructType(
        [
            T.StructField("id", T.StringType()),
            T.StructField("url", T.StringType()),
            T.StructField("range", T.IntegerType()),
            T.StructField("host", T.StringType()),
            T.StructField("path", T.StringType()),
            T.StructField("content", T.BinaryType()),
            T.StructField("lines", T.BinaryType()),
            T.StructField("hashes", T.BinaryType()),
        ]
    )

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for url, name, page in zip(batch["url"], batch["name"], batch["html"], strict=True):
                host, path = address(url)
                lines = page_lines(page)
                marks = np.array([inside for inside, _ in lines], bool)
                hashes = np.array([xxhash.xxh3_64_intdigest(t) for _, t in lines], np.uint64)
                packed = zlib.compress("\n".join(t for _, t in lines).encode("utf-8", "replace"), 1)
                place = bisect_right(starts, (host, path, url or "", name or ""))
                out.append((url, place, host, path, marks.tobytes(), packed, hashes.tobytes()))
            frame = pd.DataFrame(out, columns=parsed.names[1:])
            frame.insert(0, "id", batch["id"].array)
            yield frame

    result = T.StructType(
        [
            T.StructField(id_col, T.StringType()),
            T.StructField(url_col, T.StringType()),
            T.StructField("text", T.StringType()),
            T.StructField("n_chars", T.LongType()),
        ]
    )

    def difference(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        before = waiting = None
        out: list[tuple] = []

        def put(row, other) -> None:
            marks = np.frombuffer(row.content, bool).tolist()
            lines = zlib.decompress(row.lines).decode("utf-8").split("\n") if marks else []
            hashes = np.frombuffer(row.hashes, np.uint64).tolist()
            near = None if other is None else np.frombuffer(other.hashes, np.uint64).tolist()
            text = " ".join(main_lines(lines, hashes, near, marks))
            out.append((row.id, row.url, text, len(text)))

        def told() -> pd.DataFrame:
            frame = pd.DataFrame(out, columns=result.names)
            out.clear()
            return frame

        for batch in batches:
            for row in batch.itertuples(index=False):
                if before is not None and (before.range, before.host) == (row.range, row.host):
                    if waiting is not None:
                        put(waiting, row)
                        waiting = None
                    put(row, before)
                else:
                    if waiting is not None:
                        put(waiting, None)
                    waiting = row
                before = row
            yield told()
        if waiting is not None:
            put(waiting, None)
        yield told()

    rows = pages.select(
        as_text(id_col).alias("id"),
        F.col(url_col).alias("url"),
        F.col(id_col).cast("string").alias("name"),
        F.col(html_col).alias("html"),
    )
    lines = rows.mapInPandas(parse, parsed)
    order = ["range", "host", "path", "url", F.col("id").cast(kind)]
    ordered = lines.repartition("range").sortWithinPartitions(*order)
    return ordered.mapInPandas(difference, result).withColumn(id_col, F.col(id_col).cast(kind))
