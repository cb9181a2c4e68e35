"""Main text of web pages by wrappers: union-free regular expressions inferred for each host.

A page becomes a tree of elements and text slots (end tags that are missing
are implied, also at the end of a cut page; scripts, styles and comments go).
A wrapper is such a tree whose items have a quantifier: once, optional (?),
repeated (+) or both (*), and groups of several items that repeat; no
alternatives. It is inferred by folding neighbouring equal items of a page
into repeated groups and then aligning page after page with the wrapper so
far: equal items are merged, what only one side has becomes optional, and
differing texts become slots. Every task merges its own pages of a host before
anything is shuffled, then partial wrappers are merged over SALTS parts of
a host and at last for the host, so a host with a third of all pages sends a
few wrappers, not its pages.

A page is read through its host's wrapper: its items are matched with the
wrapper's, and the texts that fall into the wrapper's content slots are its
main text. A slot is content if no element around it is page furniture (by
element name, role, or words in class or id: FURNITURE below; the header of
an article itself holds its title and is none) and, where
the page has them, if it lies in article or main. A repeated group all of
whose text lies in links is a menu, outside article and main. Everywhere a
block whose slots all hold the same whole text on every page of the host that
has them, CONSTANT_PAGES different pages or more, is furniture too. Pages
whose text by the tag rules is the same count as one page, so copies prove
nothing. Paragraphs that the wrapper folds into one repeated item are one slot:
a constant one among differing ones stays.

Inline elements do not part blocks; br and everything else does. Character
references are decoded, white space in a block becomes one space.

Null and empty pages: empty text. Null urls form a host. Pages that repeat
are extracted alike. Rows with null ids and other columns do no harm.
Wrappers are deterministic up to the order of merging, which does not change
what they accept of the pages merged. An item that a wrapper does not accept
(a page that was not merged) is judged by its own tags.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 16
CONSTANT_PAGES = 20
MAX_PERIOD = 3
MAX_DEPTH = 120  # the depth of the tree; deeper elements are part of the item there (see parse)
MAX_ALIGN = 1 << 22  # longer unlike stretches are parted in linear memory first
#: Elements of HTML by their role here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template noscript textarea title svg math iframe object canvas".split())
FOREIGN = frozenset(("svg", "math"))  # of the raw ones, these may be closed by their start tag
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
FURNITURE_TAGS = frozenset("nav header footer aside form button select option fieldset dialog menu head".split())
MAIN = frozenset(("article", "main"))
#: An element that begins ends these, if they are the innermost block.
ENDS = {t: ("p",) for t in "p div ul ol dl table section article aside nav header footer main form h1 h2 h3 h4 h5 h6 pre blockquote hr address figure fieldset".split()}
ENDS |= {"li": ("p", "li"), "dt": ("p", "dt", "dd"), "dd": ("p", "dt", "dd"), "tr": ("td", "th", "tr"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
#: These hold back the search for what an element ends.
SCOPE = frozenset("ul ol dl table body article main section nav aside div header footer form".split())
FURNITURE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|comment-?list|cookies?|disqus|footer|header|masthead|menu|nav\w*|newsletter|notice|popup|promo\w*|related|replies|reply|share|sharing|sidebar|social|sponsor\w*|subscribe|teaser|toolbar|widget)(?:$|[\s_-])", re.I)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|$)|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|$)", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")

# An item of a page or wrapper is [label, quantifier, children, extra]; label "#" is a text slot
# (extra: the text, None once texts differ; in wrappers [digest, the pages that have it, None from CONSTANT_PAGES on]), "()" a group of items that repeats, else "tag" or "tag!" (furniture).


def _furniture(tag: str, attributes: str, in_main: bool = False) -> bool:
    """Whether an element is page furniture by itself. A header within
    article or main holds the article's own title, whatever it is called."""
    own = tag == "header" and in_main
    if tag in FURNITURE_TAGS and not own:
        return True
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        value = a or b or c
        name = name.lower()
        if own and name in ("class", "id"):
            value = re.sub("(?i)header|masthead", "", value)
        if name == "role" and value.lower() in ROLES or name in ("class", "id") and FURNITURE.search(value):
            return True
    return False


@dataclass(slots=True)
class _Open:
    """An element that is not closed yet. item: where its content goes;
    parted: it is a block whose content goes to an outer item, MAX_DEPTH up."""

    item: list
    tag: str
    furniture: bool
    main: bool
    parted: bool = False


def parse(page: str | None) -> list:
    """The page's tree: ["html", "1", children, None]; text slots hold decoded text.

    Elements nest as deep as they like. Below MAX_DEPTH the content of an
    element goes to the item at that depth, its blocks parted as by br; only
    furniture in the text and an article in the page still get items of their
    own, so what is furniture or main does not depend on the depth.
    """
    root: list = ["html", "1", [], None]
    stack = [_Open(root, "html", False, False)]
    open_tags: Counter = Counter()  # of the elements that are open
    page = page or ""
    at, n = 0, len(page)

    def text(raw: str) -> None:
        if raw:
            kids = stack[-1].item[2]
            if kids and kids[-1][0] == "#":
                kids[-1][3] += html.unescape(raw)
            else:
                kids.append(["#", "1", [], html.unescape(raw)])

    def close(names, scope: bool) -> None:
        if not any(open_tags[t] for t in names):
            return
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in names:
                for x in stack[k:]:
                    open_tags[x.tag] -= 1
                    if x.parted:
                        x.item[2].append(["br", "1", [], None])
                del stack[k:]
                return
            if scope and stack[k].tag in SCOPE:
                return

    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at:m.start()])
        at = m.end()
        end, tag = m.group(1), m.group(2)
        if end:
            close((end.lower(),), False)
        elif tag:
            tag, attributes = tag.lower(), m.group(3)
            if not m.group(4):
                break  # the page ends within a tag
            if tag in RAW:
                if tag in FOREIGN and attributes.rstrip().endswith("/"):
                    continue
                stop = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = stop.end() if stop else n
                continue
            if tag in ENDS:
                close(ENDS[tag], True)
            if tag in MAIN and not any(_furniture_label(x.item[0]) and x.tag not in ("nav", "ul", "header") for x in stack):
                close(("nav", "header"), False)
            if tag == "br" or tag == "hr":
                stack[-1].item[2].append([tag, "1", [], None])
            elif tag not in VOID and tag not in ("html", "body"):
                up = stack[-1]
                bad = _furniture(tag, attributes, up.main and not up.furniture)
                empty = attributes.rstrip().endswith("/")
                new = _Open(up.item, tag, up.furniture or bad, up.main or tag in MAIN)
                if len(stack) < MAX_DEPTH or not up.furniture and bad or not up.main and tag in MAIN:
                    new.item = [tag + "!" * bad, "1", [], None]
                    up.item[2].append(new.item)
                elif tag not in INLINE:
                    new.parted = True
                    up.item[2].append(["br", "1", [], None])
                if not empty:
                    stack.append(new)
                    open_tags[tag] += 1
    return root


def _furniture_label(label: str) -> bool:
    return label.endswith("!")


def skeleton(item: list, page: int = 0) -> list:
    """The item for inference: texts by a digest, blank texts dropped, repeats folded; ``page``: digest of the page's text."""
    if item[0] == "#":
        return ["#", "1", [], None if item[3] is None else [hash_text(item[3]), [page]]]
    kids = [skeleton(x, page) for x in item[2] if x[0] != "#" or x[3].strip()]
    return [item[0], "1", fold(kids), None]


def hash_text(text: str) -> int:
    """64-bit digest of all words."""
    return int.from_bytes(hashlib.blake2b(" ".join(text.split()).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def _shared(a: list | None, b: list | None) -> list | None:
    """[digest, pages] of a slot's text; None once texts differ, pages None once there are CONSTANT_PAGES."""
    if a is None or b is None or a[0] != b[0]:
        return None
    seen = None if a[1] is None or b[1] is None else sorted({*a[1], *b[1]})
    return [a[0], None if seen is None or len(seen) >= CONSTANT_PAGES else seen]


def settled(item: list) -> list:
    """The wrapper with only those texts that count as constant."""
    return [item[0], item[1], [settled(x) for x in item[2]], item[3] if item[3] is not None and item[3][1] is None else None]


def _joint(a: str, b: str) -> str:
    maybe, many = (a in "?*") or (b in "?*"), (a in "+*") or (b in "+*")
    return "*" if maybe and many else "?" if maybe else "+" if many else "1"


def _same(a: list, b: list) -> bool:
    return a[0] == b[0] and (a[0] != "()" or [x[0] for x in a[2]] == [x[0] for x in b[2]])


def merged(a: list, b: list) -> list:
    """The item that stands for both."""
    if a[0] == "#":
        return ["#", _joint(a[1], b[1]), [], _shared(a[3], b[3])]
    return [a[0], _joint(a[1], b[1]), [merged(x, y) for x, y in zip(a[2], b[2], strict=True)] if a[0] == "()" else align(a[2], b[2]), None]


def fold(items: list) -> list:
    """Neighbouring equal runs of 1 to MAX_PERIOD items as one repeated item or group."""
    for period in range(1, MAX_PERIOD + 1):
        out: list = []
        i = 0
        while i < len(items):
            run = items[i:i + period]
            j = i + period
            while len(run) == period and j + period <= len(items) and all(_same(x, y) for x, y in zip(run, items[j:j + period], strict=True)) \
                    and not (period > 1 and all(x[1] in "+*" for x in run)):
                run = [merged(x, y) for x, y in zip(run, items[j:j + period], strict=True)]
                j += period
            if j > i + period:
                out.append([run[0][0], "+" if run[0][1] in "1+" else "*", *run[0][2:]] if period == 1 else ["()", "+", run, None])
                i = j
            else:
                out.append(items[i])
                i += 1
        items = out
    return items


def _lengths(x: list[int], y: list[int]) -> np.ndarray:
    """Length of the longest common sequence of x and each beginning of y."""
    row, of = np.zeros(len(y) + 1, dtype=np.int32), np.array(y, dtype=np.int32)
    for c in x:
        row[1:] = np.maximum.accumulate(np.where(of == c, row[:-1] + 1, row[1:]))
    return row


def _parted(x: list, y: list) -> list[tuple[list, list]]:
    """Stretches of at most MAX_ALIGN cells, in order, whose longest common sequences make up one of x and y."""
    done, todo = [], [(x, y)]
    number: dict[tuple, int] = {}

    def numbers(items: list) -> list[int]:
        return [number.setdefault((i[0], *([k[0] for k in i[2]] if i[0] == "()" else ())), len(number)) for i in items]

    while todo:
        x, y = todo.pop()
        if len(x) * len(y) <= MAX_ALIGN or len(x) + len(y) < 3:
            done.append((x, y))
            continue
        turned = len(x) < len(y)
        long, short = (y, x) if turned else (x, y)
        half = len(long) // 2
        n, m = numbers(long), numbers(short)
        at = int(np.argmax(_lengths(n[:half], m) + _lengths(n[half:][::-1], m[::-1])[::-1]))
        todo += [(short[at:], long[half:]), (short[:at], long[:half])] if turned else [(long[half:], short[at:]), (long[:half], short[:at])]
    return done


def align(a: list, b: list) -> list:
    """Children of the wrapper for two child lists: longest common labels merged, the rest optional."""
    head = 0
    while head < min(len(a), len(b)) and _same(a[head], b[head]):
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and _same(a[-1 - tail], b[-1 - tail]):
        tail += 1
    x, y = a[head:len(a) - tail], b[head:len(b) - tail]
    out = [merged(p, q) for p, q in zip(a[:head], b[:head], strict=True)]
    for part in _parted(x, y):
        out += _align(*part)
    return out + [merged(p, q) for p, q in zip(a[len(a) - tail:], b[len(b) - tail:], strict=True)]


def _align(x: list, y: list) -> list:
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x) - 1, -1, -1):
        for j in range(len(y) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if _same(x[i], y[j]) else max(best[i + 1][j], best[i][j + 1])
    out: list = []
    i = j = 0
    while i < len(x) or j < len(y):
        if i < len(x) and j < len(y) and _same(x[i], y[j]) and best[i][j] == best[i + 1][j + 1] + 1:
            out.append(merged(x[i], y[j]))
            i, j = i + 1, j + 1
        elif j == len(y) or i < len(x) and best[i + 1][j] >= best[i][j + 1]:
            out.append([x[i][0], _joint(x[i][1], "?"), *x[i][2:]])
            i += 1
        else:
            out.append([y[j][0], _joint(y[j][1], "?"), *y[j][2:]])
            j += 1
    return out


def matches(items: list, wrapper: list) -> list:
    """The wrapper's item for each page item (None where none fits): repeated items and groups as far as they go.

    Both are walked from left to right with the set of places that the
    wrapper may be in, so optional items cost no backtracking.
    """
    flat: list = []  # (item, first of its loop, last of its loop, may be skipped)

    def lay(xs: list, loop: tuple[int, int] | None) -> None:
        for x in xs:
            if x[0] == "()":
                start = len(flat)
                lay(x[2], (start, start + len(x[2]) - 1))
                for k in range(start, len(flat)):
                    flat[k] = (*flat[k][:3], x[1] in "?*")
            else:
                own = (len(flat), len(flat)) if x[1] in "+*" else loop
                flat.append((x, own, loop, x[1] in "?*"))

    lay(wrapper, None)

    def after(k: int) -> Iterator[int]:
        """Places that may come next after place k (-1: the start)."""
        seen = set()
        todo = [k + 1]
        if k >= 0:
            todo += [loop[0] for loop in flat[k][1:3] if loop and loop[1] == k]
        while todo:
            j = todo.pop()
            if j >= len(flat) or j in seen:
                continue
            seen.add(j)
            yield j
            if flat[j][3]:
                todo.append(j + 1)
                if flat[j][2] and flat[j][2][1] == j:
                    todo.append(flat[j][2][0])

    steps: list[dict[int, int]] = []
    states = {-1: -1}
    nexts: dict[int, dict[str, int]] = {}
    for x in items:
        new: dict[int, int] = {}
        for k in states:
            if k not in nexts:
                table: dict[str, int] = {}
                for j in sorted(after(k)):
                    table.setdefault(flat[j][0][0], j)
                nexts[k] = table
            j = nexts[k].get(x[0])
            if j is not None and j not in new:
                new[j] = k
        steps.append(new)
        if new:
            states = new
        # an item that does not fit is left out; the places stay
    out: list = [None] * len(items)
    if steps:
        k = None
        for i in range(len(items) - 1, -1, -1):
            if not steps[i]:
                continue
            if k is None or k not in steps[i]:
                k = min(steps[i])
            out[i] = flat[k][0]
            k = steps[i][k]
    return out


def _linked(item: list, inside: bool = False) -> bool | None:
    """Whether all text of the item lies in links; None without text."""
    if item[0] == "#":
        return inside
    found = [y for x in item[2] if (y := _linked(x, inside or item[0] == "a")) is not None]
    return all(found) if found else None


def _has_main(item: list, furniture: bool = False) -> bool:
    furniture = furniture or _furniture_label(item[0])
    return not furniture and (item[0] in MAIN or any(_has_main(x) for x in item[2]))


def extract(page: str | None, wrapper: list | None, pages: int) -> str:
    """The main text of a page by its host's wrapper."""
    return _main_text(parse(page), wrapper, pages)


def _main_text(tree: list, wrapper: list | None, pages: int) -> str:
    tree = [*tree[:2], [x for x in tree[2] if x[0] != "#" or x[3].strip()], None]
    only_main = _has_main(tree)
    # (text, whether it is a constant of the host)
    blocks: list[list[tuple[str, bool]]] = [[]]

    def walk(items: list, wrapped: list | None, inside: bool) -> None:
        found = matches([x for x in items if x[0] != "#" or x[3].strip()], wrapped) if wrapped is not None else []
        place = 0
        for x in items:
            if x[0] == "#" and not x[3].strip():
                blocks[-1].append((" " if x[3] else "", True))
                continue
            w = found[place] if wrapped is not None else None
            place += 1
            if x[0] == "#":
                if inside or not only_main:
                    constant = (pages >= CONSTANT_PAGES and w is not None and w[1] in "1"
                                and w[3] is not None and w[3][1] is None and w[3][0] == hash_text(x[3]))
                    blocks[-1].append((x[3], constant))
                continue
            label = x[0] if w is None else w[0]
            if _furniture_label(label):
                continue
            if w is not None and w[1] in "+*" and label not in INLINE and not inside and _linked(w):
                continue
            block = label not in INLINE
            if block:
                blocks.append([])
            walk(x[2], None if w is None else w[2], inside or label in MAIN)
            if block:
                blocks.append([])

    walk(tree[2], None if wrapper is None else wrapper[2], False)
    kept = ("".join(t for t, _ in b) for b in blocks if not all(constant for _, constant in b))
    return " ".join(t for t in (" ".join(b.split()) for b in kept) if t)


def host(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][\w+.-]*://([^/?#]*)", 1)), F.lit(""))


def _combine(rows: Iterator[tuple[str, str, int]]) -> Iterator[tuple[str, str, int]]:
    held: dict[str, tuple[list, int]] = {}
    for h, text, n in rows:
        new = json.loads(text)
        old = held.get(h)
        held[h] = (new, n) if old is None else (merged(old[0], new), old[1] + n)
    for h, (w, n) in held.items():
        yield h, json.dumps(w, separators=(",", ":")), n


_SCHEMA = "host string, wrapper string, n long"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"host": pa.array([r[0] for r in rows], pa.string()), "wrapper": pa.array([r[1] for r in rows], pa.string()),
                                       "n": pa.array([r[2] for r in rows], pa.int64())})


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper as JSON, n pages) for each host of ``pages (url, html)``."""

    def own(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[list, int]] = {}
        for b in frames:
            for h, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                tree = parse(page)
                tree = skeleton(tree, hash_text(_main_text(tree, None, 0)))
                old = held.get(h)
                held[h] = (tree, 1) if old is None else (merged(old[0], tree), old[1] + 1)
        yield _batch([(h, json.dumps(w, separators=(",", ":")), n) for h, (w, n) in held.items()])

    def together(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("host", "wrapper", "n")), strict=True))
        return pa.Table.from_batches([_batch(list(_combine(iter(rows))))])

    def whole(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows = together(key, table).to_pylist()
        return pa.Table.from_batches([_batch([(r["host"], json.dumps(settled(json.loads(r["wrapper"])), separators=(",", ":")), r["n"]) for r in rows])])

    parts = pages.select(host(F.col("url")).alias("host"), F.col("html")).mapInArrow(own, _SCHEMA)
    salted = parts.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS)))
    return salted.groupBy("host", "salt").applyInArrow(together, _SCHEMA).groupBy("host").applyInArrow(whole, _SCHEMA)


def main_text(pages: DataFrame) -> DataFrame:
    """``pages (page_id, url, html)`` -> page_id, url, text, n_chars."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list] = {}
        for b in frames:
            texts = []
            for page, w, n in zip(*(b.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
                if w is not None and w not in known:
                    known.clear() if len(known) > 1000 else None
                    known[w] = json.loads(w)
                texts.append(extract(page, known.get(w), n or 0))
            yield pa.RecordBatch.from_pydict({"page_id": b.column(0), "url": b.column(1), "text": pa.array(texts, pa.string()),
                                              "n_chars": pa.array([len(t) for t in texts], pa.int64())})

    p = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host(F.col("url")).alias("h"))
    w = wrappers(pages)
    return (p.join(w, p["h"] == w["host"], "left").select("page_id", "url", "html", "wrapper", "n")
            .mapInArrow(run, "page_id long, url string, text string, n_chars long"))
