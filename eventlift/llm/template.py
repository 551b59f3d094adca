"""Main text of web pages by the containers and repeated blocks of a host's pages.

Tokens of a page are its containers, named by their path with class names, and the blocks of text in them.
A token's occurrence vector says how often it is on which pages; tokens of one vector form an equivalence class.
Containers on enough pages of a host are its template, and what lies between them are its slots.  The main one is
found by going down from the root, as long as one container that is on its pages once holds most of
the text; containers for menus, adverts, comments and the like are never entered.  Blocks of the
slot's own class, on the very pages that the slot is on and once on each, belong to the template as the slot does: where
that many pages agree and most text differs, they are menus or notices, and are left out.  Classes of other vectors are content.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlift.llm.tables import written

#: Share of a host's pages that a valid class is on, and share of the text that a container is entered for.
SUPPORT, MOST = 0.3, 0.6
#: Pages that a class must be on for its blocks to be template text; on fewer, equal vectors may be chance.
LEAST_PAGES = 10

# Fixed values of the markup language.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title iframe noembed noframes noscript xmp template".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr del".split())
_CONTAINER = frozenset("html head body main article section div header footer nav aside form table tbody tr td ul ol dl figure fieldset details dialog".split())
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_NO_TEXT = frozenset("head header footer nav aside form button select script style dialog svg math object".split())
_NO_NAME = re.compile(
    r"(?:^|[-_ ])(?:ad|ads|advert\w*|sponsor\w*|promo\w*|banner|cookie\w*|consent|notice\w*|alert|popup|modal|newsletter|subscribe|menu\w*|nav\w*|breadcrumb\w*|sidebar|side|footer|header|masthead|comment\w*|reply|replies|disqus|share|sharing|social|related|recommend\w*|pagination|pager|login|signup|search)(?:$|[-_ ])",
    re.I,
)
_TAG = re.compile(r"<!--.*?(?:-->|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.S)
#: Elements that hold whole pages or articles: names of theirs say what else is on the page.
_WHOLE = frozenset("html body main article".split())
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)


class Element:
    __slots__ = ("tag", "path", "hidden")

    def __init__(self, tag: str, path: str, hidden: bool):
        self.tag, self.path, self.hidden = tag, path, hidden


def _not_shown(attributes: str) -> bool:
    """Whether attributes have the one named hidden, or aria-hidden as true."""
    for name, *values in _ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name == "hidden" or name == "aria-hidden" and "".join(values).strip().lower() == "true":
            return True
    return False


def walk(page: str, by_name: bool = True) -> Iterator[tuple[str, Element, str]]:
    """("open", element, ""), ("text", element it is in, text) and ("break", element, "") of a page in order.

    Elements are hidden by their tag, their attributes and, unless ``by_name`` is false, their names.
    Tolerant: end tags are implied where the language implies them, and ignored without a start.
    """
    stack = [Element("", "", False)]
    at = 0
    find = _TAG.search
    while True:
        found = find(page, at)
        text = page[at : found.start() if found else len(page)]
        if text:
            yield "text", stack[-1], text
        if not found:
            return
        at = found.end()
        tag = found[2] and found[2].lower()
        if not tag:
            continue
        if found[1]:
            if tag not in _INLINE:
                yield "break", stack[-1], ""
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
            continue
        if tag not in _INLINE:
            yield "break", stack[-1], ""
            ends = _CLOSES.get(tag, set()) | {"p"}
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in ends:
                    del stack[i:]
                    break
                if stack[i].tag in _CONTAINER:
                    break
        if tag == "br":
            yield "text", stack[-1], " "
        if tag in _VOID:
            continue
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if found[3].endswith("/") and tag in ("svg", "path"):
            continue
        above = stack[-1]
        names = " ".join(next(filter(None, n[1:]), "") for n in _NAMES.findall(found[3])) if found[3] else ""
        hidden = above.hidden or tag in _NO_TEXT or bool(by_name and names and tag not in _WHOLE and _NO_NAME.search(names)) or "hidden" in found[3].lower() and _not_shown(found[3])
        path = above.path
        if tag in _CONTAINER:
            shown = ".".join([tag, *sorted(w for w in names.split() if not re.search(r"\d", w))])
            path = f"{path}/{shown}"
        here = Element(tag, path, hidden)
        stack.append(here)
        yield "open", here, ""


def blocks_of(page: str, slot: str = "", by_name: bool = True) -> tuple[bool, list[tuple[str, str]]]:
    """Whether a page has containers of a path, and (path, text) of the shown blocks inside them in order."""
    blocks, block = [], []
    inside = slot + "/"
    met, place = not slot, slot

    def end():
        text = " ".join(html.unescape("".join(block)).split())
        if text:
            blocks.append((place, text))
        block.clear()

    for kind, element, text in walk(page, by_name):
        if kind == "text":
            if not element.hidden and (not slot or element.path == slot or element.path.startswith(inside)):
                if not block:
                    place = element.path
                block.append(text)
        elif kind == "break":
            end()
        elif element.path == slot:
            met = True
    end()
    return met, blocks


def block_hash(path: str, text: str) -> int:
    """A signed 64-bit hash of a block at its path."""
    return int.from_bytes(hashlib.blake2b(f"{path}\n{text}".encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def main_text(page: str, slot: str, by_name: bool = True, template: frozenset[int] = frozenset()) -> str | None:
    """Text of all blocks inside the containers of a path, joined by line ends; None if it has no such container.

    Blocks of the template are left out, unless the page has no other.
    """
    met, blocks = blocks_of(page, slot, by_name)
    own = [text for path, text in blocks if block_hash(path, text) not in template] if template else []
    return "\n".join(own or [text for _, text in blocks]) if met else None


def tokens(page: str, by_name: bool = True) -> dict[str, list]:
    """By container path: how many there are, characters of text in it and not in a deeper one, whether hidden."""
    out: dict[str, list] = {"": [1, 0, False]}
    for kind, element, text in walk(page, by_name):
        own = out.get(element.path)
        if own is None:
            own = out[element.path] = [0, 0, element.hidden]
        if kind == "open":
            if element.tag in _CONTAINER:
                own[0] += 1
            own[2] = own[2] and element.hidden
        elif kind == "text" and not element.hidden:
            own[1] += len(text.strip())
    return out


def main_slot(rows: list[tuple[str, int, int, int]], pages: int) -> str:
    """Path of the main slot from (path, pages, count, characters) of a host's containers; those on enough pages are nested by path."""
    valid = {r[0]: r for r in rows if r[1] >= max(1, SUPPORT * pages)}
    held: dict[str, int] = defaultdict(int)
    for path, _, _, chars in rows:
        parts = path.split("/")
        for i in range(1, len(parts) + 1):
            held["/".join(parts[:i])] += chars
    inner = defaultdict(list)
    for path in valid:
        if path:
            above = path.rpartition("/")[0]
            while above and above not in valid:
                above = above.rpartition("/")[0]
            inner[above].append(path)
    at = ""
    while True:
        once = [p for p in inner[at] if valid[p][2] == valid[p][1]]
        best = max(once, key=lambda p: (held[p], p), default=None)
        if best is None or not held[best] or held[best] < MOST * held[at]:
            return at
        at = best


def template_blocks(slot: str, rows: list[tuple[str, int | None, int, int, int, int]]) -> list[int]:
    """Hashes of the blocks in the slot's class, from (path, block, vector, pages, count, characters) of a host's tokens."""
    own = next(r for r in rows if r[0] == slot and r[1] is None)
    if own[3] < LEAST_PAGES:
        return []
    inside = [r for r in rows if not slot or r[0] == slot or r[0].startswith(slot + "/")]
    blocks = [r for r in inside if r[1] is not None and r[2:5] == own[2:5]]
    # what holds most of the text is no menu or notice: pages that are copies of each other
    if sum(r[5] for r in blocks) > (1 - MOST) * sum(r[5] for r in inside if r[1] is None):
        return []
    return [r[1] for r in blocks]


def host_of(column: str):
    """Lower-case host of an address, empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(F.col(column), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
    for batch in batches:
        out = [[], [], [], [], [], []]
        for page, host, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).fill_null("").to_pylist()):
            rows = [(path, None, count, chars) for path, (count, chars, _) in tokens(text).items()]
            blocks = Counter(blocks_of(text)[1])
            rows += [(path, block_hash(path, block), count, count * len(block)) for (path, block), count in blocks.items()]
            for path, block, count, chars in rows:
                for column, value in zip(out, (page, host, path, block, count, chars)):
                    column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["page", "host", "path", "block", "count", "chars"])


def _chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        slots, blocks = [], []
        for pages, rows in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            rows = [tuple(r.values()) for r in rows]
            slots.append(main_slot([(r[0], *r[3:]) for r in rows if r[1] is None], pages))
            blocks.append(template_blocks(slots[-1], rows))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(slots, pa.string()), pa.array(blocks, pa.list_(pa.int64()))], names=["host", "slot", "blocks"])


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for page, slot, blocks in zip(batch.column(2).fill_null("").to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist()):
            text = None if slot is None else main_text(page, slot, template=frozenset(blocks))
            for by_name in (True, False):
                # a page off its host's template: its own containers decide; where names leave nothing, without them
                if text is None or not by_name and not text:
                    text = main_text(page, main_slot([(p, 1, c, n) for p, (c, n, _) in tokens(page, by_name).items()], 1), by_name)
            texts.append(text)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def templates(pages: DataFrame) -> DataFrame:
    """(host, slot, blocks) of every host of ``pages`` (page, host, html)."""
    found = pages.mapInArrow(_counted, "page long, host string, path string, block long, count long, chars long")
    # pages and counts as one number: sums besides, as equal rows cancel out in an exclusive or
    one = F.xxhash64("page", "count")
    vectors = found.groupBy("host", "path", "block").agg(
        F.xxhash64(F.bit_xor(one), F.sum(F.shiftrightunsigned(one, 30))).alias("vector"), F.count("*").alias("pages"), F.sum("count").alias("count"), F.sum("chars").alias("chars")
    )
    number = pages.groupBy("host").agg(F.count("*").alias("all"))
    # what is on enough pages: as many tokens as a few pages have, whatever the number of pages
    kept = vectors.join(number, "host").where(f"pages >= {SUPPORT} * all AND (block IS NULL OR pages >= {LEAST_PAGES})")
    lists = kept.groupBy("host").agg(F.max("all").alias("all"), F.collect_list(F.struct("path", "block", "vector", "pages", "count", "chars")).alias("rows"))
    return lists.mapInArrow(_chosen, "host string, slot string, blocks array<long>")


def main_texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html; others are ignored).

    A null html is an empty page, whose text is empty.  Pages without a host in their url form
    one host.  Repeated rows are repeated in the result.  A block that stands once on every page of the
    host's main slot, ten pages at least, is template text and left out.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    hosts = written(templates(rows.select(F.col("page_id").alias("page"), host_of("url").alias("host"), "html")), "page-templates")
    marked = rows.withColumn("host", host_of("url")).join(hosts, "host", "left").select("page_id", "url", "html", "slot", "blocks")
    return marked.mapInArrow(_extracted, "page_id long, url string, text string, n_chars long")
