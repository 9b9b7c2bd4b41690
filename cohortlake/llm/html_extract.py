"""HTML extraction by nearest-URL page differencing.

Each page becomes text lines: white space folds within a block, and block elements end lines. Pages are
ordered by host and URL path; a page's partner is the neighbour of the same host that shares the longer
piece of its path, or both neighbours where they share as much. The longest common subsequence of the two
pages' lines is what their site repeats, and these shared lines are deleted. Markup then corrects the differencing where it is explicit: lines in menus,
headers, footers, sidebars, notices, adverts, forms and comments go even if no neighbour shares them, and
where a page marks its article (``main``, else ``article`` outside of menus and sidebars), its lines stay even if a neighbour repeats them,
and what lies outside goes. A name that only has a word of these in it (``share-price``, ``related-none``) leaves its element's
lines to the differencing. What holds the article, or most of a page without one, is never side, whatever its names say.

Only lines that may stay travel, compressed, with the hashes of all lines, in one shuffle. A host may hold
any share of the pages: the order of all URLs is cut into blocks at sampled keys (at most 2**16, chosen by
hash), so that neighbours meet whatever the host. The first page of a block travels to the block before it as
well, and the last one to the block behind, so that every page meets both its neighbours wherever the cuts lie.

Defined cases: null html is empty; a page alone on its host has no shared lines; a neighbour that shares all
lines which may stay is a copy of the page and no partner; null urls form a host of their own; null ids and
repeated rows each give a row; an unclosed element ends with its parent; a table row is a block; an empty table
gives an empty result; other columns are left out.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from html import unescape
from itertools import takewhile

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names and the words in class, id and role that mark what isn't main text.
BLOCKS = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody tfoot thead title tr ul".split())
CLOSES_P = BLOCKS - {"body", "head", "html", "title", "option", "legend"}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe svg math object select title".split())
SIDE = frozenset("nav aside footer header form button dialog menu head".split())
SIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login sidebar aside menu nav navbar navigation breadcrumb breadcrumbs toc comment comments disqus reply replies share sharing social related recommended footer header masthead toolbar pagination pager widget search form copyright legal disclaimer complementary contentinfo hidden".split()
)
_piece = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)|[^<]+|<""", re.S)
_attribute = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
_space = re.compile(r"\s+")
# Words that say where a part stands or what it is made of, not what it is.
NEUTRAL_WORDS = frozenset("site page top bottom left right primary secondary main global inner outer box block bar area wrap wrapper container section list item items link links panel content body text title head post entry slot unit module component group row column col sm md lg xl 1 2 3 4 5 6".split())
MAIN, SIDE_LINE, DOUBTFUL = 1, 2, 4
WEAK, STRONG = 1, 2


def _level(tag: str, attributes: str, in_main: bool) -> int:
    """STRONG where tag or attributes say that an element isn't main text, WEAK where a name only has such a word in it (``share-price``), else 0."""
    level = STRONG * (tag in SIDE and not (tag == "header" and in_main))
    for m in _attribute.finditer(attributes) if attributes and not level else ():
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
            return STRONG
        if name in ("class", "id", "role"):
            for token in value.split():
                words = {w for w in re.split("[_-]+", token) if w}
                if words & SIDE_WORDS:
                    level = max(level, STRONG if words <= SIDE_WORDS | NEUTRAL_WORDS else WEAK)
    return level


class Page:
    """Elements and lines as they are parsed; what an element means is settled once all are known."""

    def __init__(self):
        self.parent, self.tag, self.own, self.letters = [-1], [""], [0], [0]
        self.lines: list[tuple[str, int]] = []  # with the element

    def opened(self, parent: int, tag: str, level: int) -> int:
        for column, value in ((self.parent, parent), (self.tag, tag), (self.own, level), (self.letters, 0)):
            column.append(value)
        return len(self.tag) - 1

    def above(self, element: int) -> Iterator[int]:
        while element >= 0:
            yield element
            element = self.parent[element]

    def marked(self) -> list[tuple[str, int]]:
        """The lines with their marks: MAIN in the page's main element, else in its articles outside of menus and the like; SIDE_LINE and DOUBTFUL by the elements around.

        What holds the main text isn't side whatever its names say, nor is, on a page without such an element, one that holds most of the page's letters.
        """
        count = range(1, len(self.tag))
        inside = [False]  # of an element that is side by its tag
        for e in count:
            inside.append(inside[self.parent[e]] or self.tag[e] in SIDE - {"form", "header"})
        found = [e for e in count if self.tag[e] == "main"] or [e for e in count if self.tag[e] == "article" and not inside[e]] or [e for e in count if self.tag[e] == "article"]
        spared = {0} | {e for e in count if self.tag[e] in ("html", "body")}
        for e in found:
            spared.update(self.above(e))
        if not found:
            for text, element in self.lines:
                for e in self.above(element):
                    self.letters[e] += len(text)
            spared |= {e for e in count if 2 * self.letters[e] > self.letters[0]}
        main, level, regions = [False], [0], set(found)
        for e in count:
            main.append(main[self.parent[e]] or e in regions)
            level.append(max(level[self.parent[e]], 0 if e in spared else self.own[e]))
        return [(text, MAIN * main[e] | SIDE_LINE * (level[e] == STRONG) | DOUBTFUL * (level[e] == WEAK)) for text, e in self.lines]


def lines(html: str) -> list[tuple[str, int]]:
    """The page's lines with their marks."""
    page = Page()
    open_: list[tuple[str, bool, int, int]] = []  # tag, in main text's element, element, level
    text: list[str] = []
    main, element = False, 0

    def end_line() -> None:
        line = _space.sub(" ", unescape("".join(text))).strip()
        text.clear()
        if line:
            page.lines.append((line, element))

    def close(depth: int) -> None:
        nonlocal main, element
        end_line()
        del open_[depth:]
        main, element = open_[-1][1:3] if open_ else (False, 0)

    at, size = 0, len(html)
    while at < size:
        m = _piece.match(html, at)
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            if not m[0].startswith(("<!", "<?")):
                text.append(m[0])
            continue
        if m[1] or m[4]:
            depth = next((i for i in range(len(open_) - 1, -1, -1) if open_[i][0] == tag), None)
            if depth is not None and (tag in BLOCKS or any(x[0] in BLOCKS or x[3] for x in open_[depth:])):
                close(depth)
            elif depth is not None:
                del open_[depth:]
                main, element = open_[-1][1:3] if open_ else (False, 0)
            elif tag in BLOCKS:
                end_line()
            continue
        if tag in RAW:
            # Its content isn't text: go on behind its end tag.
            stop = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(html, at)
            at = stop.end() if stop else size
            text.append(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                end_line()
            else:
                text.append(" " if tag == "br" else "")
            continue
        if tag in CLOSES_P or tag in ("li", "tr", "dd", "dt", "option"):
            ends = {"p"} | ({tag} if tag in ("li", "tr", "dd", "dt", "option") else set())
            for i in range(len(open_) - 1, -1, -1):
                if open_[i][0] in ends:
                    close(i)
                    break
                if open_[i][0] in BLOCKS:
                    break
        level = _level(tag, m[3] or m[6] or "", main)
        if tag in BLOCKS or level:
            end_line()
        elif tag in ("td", "th"):
            text.append(" ")
        # An inline element without such names is where its line stands.
        main, element = main or tag in ("article", "main"), page.opened(element, tag, level) if tag in BLOCKS or tag in SIDE or level else element
        open_.append((tag, main, element, level))
    end_line()
    return page.marked()


def split_url(url: str | None) -> tuple[str, str]:
    """Host and path."""
    m = re.match(r"(?:[A-Za-z][\w+.-]*:)?//([^/?#]*)([^?#]*)", url or "")
    return (m[1].lower(), m[2]) if m else ("", re.split(r"[?#]", url or "", maxsplit=1)[0])


def _rising(places: list) -> list[bool]:
    """Which indices lie on a longest rising run, one place taken from each list (in falling order)."""
    tails: list[int] = []
    cells: list[tuple] = []  # (index, cell before)
    for i, js in enumerate(places):
        for j in js:
            k = bisect_left(tails, j)
            cell = (i, cells[k - 1] if k else None)
            if k == len(tails):
                tails.append(j)
                cells.append(cell)
            else:
                tails[k], cells[k] = j, cell
    out, cell = [False] * len(places), cells[-1] if cells else None
    while cell:
        out[cell[0]] = True
        cell = cell[1]
    return out


def _prefix_lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Lengths of the longest common subsequences of ``a`` with each beginning of ``b``, by the bits of long integers."""
    where: dict[int, int] = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    row = full = (1 << len(b)) - 1
    for x in a:
        hit = row & where.get(x, 0)
        row = (row + hit | row - hit) & full
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(b)]
    return np.r_[0, np.cumsum(bits == 0)]


def _halved(a: list[int], b: list[int]) -> list[bool]:
    """Which items of ``a`` lie on a longest common subsequence: halves of ``a`` against the best cut of ``b``, in memory that grows with one of the lists."""
    out = [False] * len(a)
    open_ = [(0, len(a), 0, len(b))]
    while open_:
        i, j, k, m = open_.pop()
        if i == j or k == m:
            continue
        if j - i == 1:
            out[i] = a[i] in b[k:m]
            continue
        middle = (i + j) // 2
        ahead = _prefix_lengths(a[i:middle], b[k:m])
        behind = _prefix_lengths(a[middle:j][::-1], b[k:m][::-1])[::-1]
        cut = k + int(np.argmax(ahead + behind))
        open_ += [(i, middle, k, cut), (middle, j, cut, m)]
    return out


def shared(a: list[int], b: list[int], many_pairs: int = 200_000) -> list[bool]:
    """Which items of ``a`` lie on its longest common subsequence with ``b``: by the rising places of equal items, or by halves where these are ``many_pairs``."""
    where: dict[int, list[int]] = {}
    for j, x in enumerate(b):
        where.setdefault(x, []).append(j)
    seen = Counter(a)
    if sum(n * len(where.get(x, ())) for x, n in seen.items()) <= many_pairs:
        return _rising([where.get(x, ())[::-1] for x in a])
    some = [i for i, x in enumerate(a) if x in where]
    out = [False] * len(a)
    for i, on in zip(some, _halved([a[i] for i in some], [x for x in b if x in seen]), strict=True):
        out[i] = on
    return out


def _place(url: str | None, page_id: int | None) -> tuple:
    return (*split_url(url), page_id is None, page_id or 0)


def _last_batches(cuts: list[tuple]):
    """block, host, path, no_id, id: the last page of each block in a task; reads no html."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: dict[int, tuple] = {}
        for batch in batches:
            for url, page_id in zip(batch.column("url").to_pylist(), batch.column("page_id").to_pylist(), strict=True):
                place = _place(url, page_id)
                block = bisect_right(cuts, place)
                last[block] = max(place, last.get(block, place))
        columns = zip(*((k, *v) for k, v in last.items()), strict=True) if last else [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.string(), pa.string(), pa.bool_(), pa.int64()), strict=True)], ["block", "host", "path", "no_id", "id"])

    return run


def _line_batches(cuts: list[tuple], lasts: set[tuple]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int32(), pa.bool_(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]
        names = ["block", "guest", "host", "path", "page_id", "url", "hashes", "stays", "texts"]
        # Parts of a batch, so that few pages are held at a time however long they are.
        for batch in (b.slice(i, 256) for b in batches for i in range(0, b.num_rows, 256)):
            rows = []
            for page_id, url, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True):
                place = _place(url, page_id)
                host, path = place[:2]
                found = lines(html or "")
                marked = any(mark & MAIN and not mark & SIDE_LINE for _, mark in found)
                stays = [i for i, (_, mark) in enumerate(found) if not mark & SIDE_LINE and bool(mark & MAIN) == marked]
                doubtful = [not marked or found[i][1] & DOUBTFUL > 0 for i in stays]
                block = bisect_right(cuts, place)
                hashes = [xxhash.xxh64_intdigest(line) - 2**63 for line, _ in found]
                texts = zlib.compress("\n".join(found[i][0] for i in stays).encode("utf-8", "surrogatepass"), 1)
                # Odd for a line that goes if a neighbour shares it.
                row = (host, path, page_id, url, hashes, [2 * i + d for i, d in zip(stays, doubtful, strict=True)], texts)
                rows.append((block, False, *row))
                others = [block - 1] * (block > 0 and cuts[block - 1] == place) + [block + 1] * (place in lasts)
                rows += [(other, True, host, path, page_id, None, hashes, [], b"") for other in others]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [()] * 9, kinds, strict=True)], names)

    return run


def _common_prefix(a: str, b: str) -> int:
    return sum(1 for _ in takewhile(lambda x: x[0] == x[1], zip(a, b, strict=False)))


def _pair_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def decided(before: dict | None, row: dict, after: dict | None) -> tuple:
        stays = [s >> 1 for s in row["stays"]]
        found = []
        near = [x for x in (before, after) if x and x["block"] == row["block"] and x["host"] == row["host"]]
        for x in sorted(near, key=lambda x: -_common_prefix(x["path"], row["path"])):
            if found and _common_prefix(x["path"], row["path"]) < _common_prefix(partner["path"], row["path"]):
                break
            partner, same = x, shared(row["hashes"], x["hashes"])
            if not stays or not all(same[i] for i in stays):
                found.append(same)
        deleted = [any(f) for f in zip(*found, strict=True)] if found else [False] * len(row["hashes"])
        texts = zlib.decompress(row["texts"]).decode("utf-8", "surrogatepass").split("\n") if stays else []
        text = "\n\n".join(t for s, t in zip(row["stays"], texts, strict=True) if not (s & 1 and deleted[s >> 1]))
        return row["page_id"], row["url"], text, len(text), sum(deleted)

    def made(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [()] * 5, kinds, strict=True)], ["page_id", "url", "text", "n_chars", "n_shared_lines"])

    before = row = None
    for batch in batches:
        out = []
        for i in range(0, batch.num_rows, 128):
            for after in batch.slice(i, 128).to_pylist():
                if row and not row["guest"]:
                    out.append(decided(before, row, after))
                before, row = row, after
        yield made(out)
    yield made([decided(before, row, None)] if row and not row["guest"] else [])


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars, n_shared_lines."""
    pages = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    # About 8 blocks for each partition, 2**16 at most: the cuts are pages chosen by hash.
    blocks = min(2**16, 8 * int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    every = max(32, pages.count() // blocks)
    chosen = pages.where(F.pmod(F.xxhash64("url", "page_id"), F.lit(every)) == 0).select("url", "page_id").distinct().limit(2 * 2**16).collect()
    cuts = sorted({_place(r["url"], r["page_id"]) for r in chosen})
    lasts = set()
    if cuts:
        ends = pages.select("url", "page_id").mapInArrow(_last_batches(cuts), "block int, host string, path string, no_id boolean, id long")
        ends = ends.groupBy("block").agg(F.max(F.struct("host", "path", "no_id", "id")).alias("last")).where(F.col("block") < len(cuts))
        lasts = {tuple(r["last"]) for r in ends.collect()}  # one for each cut
    rows = pages.mapInArrow(_line_batches(cuts, lasts), "block int, guest boolean, host string, path string, page_id long, url string, hashes array<long>, stays array<int>, texts binary")
    order = ["block", "host", "path", F.col("page_id").isNull(), "page_id", F.xxhash64("hashes")]
    return rows.repartition("block").sortWithinPartitions(*order).mapInArrow(_pair_batches, "page_id long, url string, text string, n_chars long, n_shared_lines long")
