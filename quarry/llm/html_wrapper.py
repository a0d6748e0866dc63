"""Main text of web pages by wrappers: union-free regular expressions inferred per host.

A page's token stream (tags and texts) is read into nested groups: an element
holds its text blocks and inner elements; formatting tags are transparent, and
missing end tags are implied. All distinct pages of a host are aligned, in
parts of some ``PART_PAGES`` pages one after another, then the parts' wrappers
likewise, level by level. The wrapper starts as the first page; where the next
page differs,

* unequal texts at one place become a text slot,
* neighbouring groups of one kind become a repeated group (+),
* groups that only one side has become optional (?).

From the wrapper follows the content group: the deepest group with most of the
slot text outside links; an ``article`` or ``main`` is taken if it holds as
much, or if a host's pages leave no slots. Pages that lack the group are read by their own structure, and pages of
a host with one content group are a layout. Template texts are counted over
all distinct pages of a layout, as hashes: a text that nearly all of them hold
at one place is template, unless little else tells the pages apart, which then
are copies of one another. A page's text is its blocks inside the content
group, without template texts and groups that are boilerplate by tag or class.

Reading is linear in the page. Groups nest up to ``DEPTH`` levels; deeper
elements keep their blocks, order and kind beside each other at that level.

Defined results: null, empty and blank pages have empty text; a page without
tags is one block; an unfinished tag at a page's end is text; pages without a url share one nameless host; repeated rows
count once in the wrapper and each get a result; other columns are ignored.
"""

from __future__ import annotations

import bisect
import hashlib
import html
import json
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import map_arrow, slices
from quarry.session import materialize

PART_PAGES = 64               # distinct pages of a host that one group aligns, about
MERGED = 16                   # wrappers of parts that one group aligns
TEMPLATE_PAGES = 4            # pages that must agree before constant text counts as template
TEMPLATE_SHARE = 0.9          # of a layout's distinct pages that hold a template text
CONTENT_SHARE = 0.6           # slot text that the content group must hold
BROADCAST_BYTES = 32 << 20    # wrappers up to this size are broadcast; beyond, the join shuffles

# fixed values: element kinds of HTML
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math object".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rp rt s
    samp small span strike strong sub sup time tt u var br wbr img""".split())
CLOSES_P = frozenset("""address article aside blockquote center details dialog dir div dl fieldset figure footer form
    h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul""".split())
SAME_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
               "th": {"td", "th"}, "option": {"option"}}
HOLDS = {"li": {"ul", "ol", "menu"}, "tr": {"table"}, "td": {"tr"}, "th": {"tr"}, "dt": {"dl"}, "dd": {"dl"}}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BLOCKS = HEADINGS | frozenset("p li dt dd blockquote pre caption figcaption".split())     # one block, not a content group
BOILERPLATE_TAGS = frozenset("nav footer aside form button select menu dialog head".split())
BOILERPLATE_NAMES = frozenset("""ad ads advert adverts advertisement advertising banner sponsor sponsored promo sidebar
    menu nav navbar navigation breadcrumb breadcrumbs pagination pager footer header masthead cookie cookies consent
    notice notices popup modal newsletter subscribe signup login share sharing social related recommended comment comments
    disqus replies widget toolbar""".split())

MARK = re.compile(r"<!--|<!\[CDATA\[|<[!?]|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
PLAIN = re.compile(r"[^>\"']*")
NAMED = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
HIDDEN = re.compile(r"\bhidden\b|display\s*:\s*none", re.IGNORECASE)
WORDS = re.compile(r"[a-zA-Z]+")


DEPTH = 120                   # levels of groups; deeper ones stand beside each other at this level


class Tokens:
    """Tags, comments and texts of a page, each character looked at a bounded number of times."""

    def __init__(self, page: str):
        self.page, self.at, self.quotes = page, 0, True

    def _tag_end(self, at: int) -> int:
        """Place of the > that ends a tag whose name ends at ``at``, -1 if none does. Quoted parts may hold a >; from the
        first quote on that never closes, quotes mean nothing in this page."""
        start = at
        while self.quotes:
            at = PLAIN.match(self.page, at).end()
            if at == len(self.page):
                return -1
            if self.page[at] == ">":
                return at
            at = self.page.find(self.page[at], at + 1) + 1
            if not at:
                self.quotes = False
        return self.page.find(">", start)

    def _until(self, mark: str, start: int, length: int) -> tuple[int, int]:
        end = self.page.find(mark, start)
        return (end, end + length) if end >= 0 else (len(self.page), len(self.page))

    def __iter__(self) -> Iterator[tuple[str, str, bool, str]]:
        """(kind, name or text, whether it is an end tag, attributes); kind is "text", "tag" or "cdata"."""
        page, begin = self.page, 0
        while True:
            m = MARK.search(page, self.at)
            tag = -1
            if m and m[2]:
                tag = self._tag_end(m.end())
            if not m or m[2] and tag < 0:         # an open tag at the end of the page is text, as all that follows
                if begin < len(page):
                    yield "text", page[begin:], False, ""
                return
            if m.start() > begin:
                yield "text", page[begin:m.start()], False, ""
            if m[2]:
                self.at = tag + 1
                yield "tag", m[2].lower(), bool(m[1]), page[m.end():tag]
            elif m[0] == "<!--":
                self.at = self._until("-->", m.end(), 3)[1]
            elif m[0] == "<![CDATA[":
                end, self.at = self._until("]]>", m.end(), 3)
                yield "cdata", page[m.end():end], False, ""
            else:
                self.at = self._until(">", m.end(), 1)[1]
            begin = self.at

    def skip(self, tag: str) -> None:
        """Go on behind the end tag of a raw element."""
        stop = RAW_END[tag].search(self.page, self.at)
        self.at = stop.end() if stop else len(self.page)


RAW_END = {tag: re.compile(rf"</{tag}\b[^>]*>", re.IGNORECASE) for tag in RAW}


class Group:
    """An element: its kind (tag and class), and blocks (str) and inner groups in order."""

    __slots__ = ("kind", "tag", "skip", "parts", "links")

    def __init__(self, kind: str, tag: str, skip: bool):
        self.kind, self.tag, self.skip = kind, tag, skip
        self.parts: list = []
        self.links = 0                # characters of its own blocks inside links


def _named(tag: str, attributes: str, in_article: bool) -> tuple[str, bool]:
    """Kind of an element, and whether tag or names say that it is boilerplate. An article's own header is not."""
    skip = tag in BOILERPLATE_TAGS
    if not attributes or "=" not in attributes and "hidden" not in attributes.lower():
        return tag, skip
    kind = tag
    for m in NAMED.finditer(attributes):
        value = (m[2] or m[3] or m[4] or "").strip()
        if m[1].lower() == "class" and value:
            kind = f"{tag}.{'.'.join(value.split())}"
        if m[1].lower() in ("class", "id") and tag not in ("html", "body", "article", "main"):
            names = {w.lower() for w in WORDS.findall(value)} & BOILERPLATE_NAMES
            skip = skip or bool(names - {"header"} if in_article else names)
        if m[1].lower() == "role":
            skip = skip or value.lower() in ("navigation", "banner", "contentinfo", "complementary", "search", "alert")
            if value.lower() == "main":
                kind = "main"
        if m[1].lower() == "itemprop" and value.lower() == "articlebody":
            kind = "article"
    return kind, skip or bool(HIDDEN.search(attributes))


def read(page: str | None) -> Group:
    """The page's nested groups."""
    top = Group("", "", False)
    stack = [top]
    text: list[str] = []
    in_link, linked = 0, 0
    open_tags: Counter[str] = Counter()

    def flush():
        nonlocal linked
        if text:
            block = " ".join(html.unescape("".join(text)).split())
            text.clear()
            if block:
                stack[-1].parts.append(block)
                stack[-1].links += linked
        linked = 0

    def place(group: Group):
        (stack[-1] if len(stack) <= DEPTH else stack[DEPTH - 1]).parts.append(group)

    def close(depth: int):
        flush()
        open_tags.subtract(g.tag for g in stack[depth:])
        del stack[depth:]
        if depth > DEPTH:            # what follows in the outer element comes after the inner one
            outer = stack.pop()
            again = Group(outer.kind, outer.tag, outer.skip)
            place(again)
            stack.append(again)

    tokens = Tokens(page or "")
    for what, name, ending, attributes in tokens:
        if what == "text":
            text.append(name)
            if in_link:
                linked += len(name)
            continue
        if what == "cdata":
            text.append(html.escape(name))
            continue
        tag = name
        if tag in INLINE:
            if tag == "a":
                in_link = 0 if ending else 1
            elif tag == "br":
                text.append(" ")
            continue
        if tag in RAW:
            if not ending and not attributes.endswith("/"):
                tokens.skip(tag)
            continue
        flush()
        if tag in VOID:
            continue
        in_link = 0
        if ending:
            for depth in range(len(stack) - 1 if open_tags[tag] else 0, 0, -1):
                if stack[depth].tag == tag:
                    close(depth)
                    break
            continue
        if tag in CLOSES_P and open_tags["p"]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == "p":
                    close(depth)
                    break
                if stack[depth].tag in ("td", "th", "table", "button", "object"):
                    break
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in SAME_CLOSES.get(tag, ()):
                close(depth)
                break
            if stack[depth].tag in HOLDS.get(tag, ()) or tag not in SAME_CLOSES:
                break
        if not attributes.endswith("/"):
            inside = any(g.kind.split(".")[0] in ("article", "main") for g in stack[:DEPTH]) if attributes else False
            kind, skip = _named(tag, attributes, inside)
            group = Group(kind, tag, skip)
            place(group)
            stack.append(group)
            open_tags[tag] += 1
    flush()
    return top


# ---------------------------------------------------------------- wrapper inference

TEXT = "#"


class Wrapper:
    """A node of the expression: a text place or a group, with how often it occurs."""

    __slots__ = ("kind", "optional", "repeated", "parts", "text", "pages", "chars", "links", "skip")

    def __init__(self, kind: str):
        self.kind = kind
        self.optional = self.repeated = self.skip = False
        self.parts: list[Wrapper] = []
        self.text: str | None = None      # constant text; None in a text place is a slot
        self.pages = 1
        self.chars = self.links = 0       # characters of slots, seen over all pages, and those in links


def _of(part) -> Wrapper:
    """Expression of one page's part, neighbouring groups of one kind folded."""
    if isinstance(part, str):
        w = Wrapper(TEXT)
        w.text, w.chars = part, len(part)
        return w
    w = Wrapper(part.kind)
    w.skip, w.links = part.skip, part.links
    for p in part.parts:
        inner = _of(p)
        if w.parts and w.parts[-1].kind == inner.kind:
            w.parts[-1] = align(w.parts[-1], inner, same_page=True)
            w.parts[-1].repeated = True
        else:
            w.parts.append(inner)
    return w


TABLE = 1 << 16               # cells of an alignment table; longer streams are aligned in one pass


def _pairs(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """A longest common subsequence, as index pairs: equal ends first, then a table. Where that would be too large, the
    next equal element of the shorter rest is taken each time."""
    low = 0
    while low < min(len(a), len(b)) and a[low] == b[low]:
        low += 1
    high = 0
    while high < min(len(a), len(b)) - low and a[-1 - high] == b[-1 - high]:
        high += 1
    ends = [(i, i) for i in range(low)], [(len(a) - k, len(b) - k) for k in range(high, 0, -1)]
    a, b = a[low:len(a) - high], b[low:len(b) - high]
    out = []
    if len(a) * len(b) > TABLE:
        places: dict[str, list[int]] = {}
        for j, x in enumerate(b):
            places.setdefault(x, []).append(j)
        j = 0
        for i, x in enumerate(a):
            k = bisect.bisect_left(places.get(x, ()), j)
            # an element whose next place skips more than is left of the other side is passed over
            if k < len(places.get(x, ())) and places[x][k] - j <= len(a) - i + 8:
                out.append((i, places[x][k]))
                j = places[x][k] + 1
    elif a and b:
        size = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a) - 1, -1, -1):
            for j in range(len(b) - 1, -1, -1):
                size[i][j] = size[i + 1][j + 1] + 1 if a[i] == b[j] else max(size[i + 1][j], size[i][j + 1])
        i = j = 0
        while i < len(a) and j < len(b):
            if a[i] == b[j]:
                out.append((i, j))
                i, j = i + 1, j + 1
            elif size[i + 1][j] >= size[i][j + 1]:
                i += 1
            else:
                j += 1
    return [*ends[0], *((i + low, j + low) for i, j in out), *ends[1]]


def align(a: Wrapper, b: Wrapper, same_page: bool = False) -> Wrapper:
    """The expression that covers both; mismatches become slots, optional and repeated groups."""
    out = Wrapper(a.kind)
    out.optional, out.repeated = a.optional or b.optional, a.repeated or b.repeated
    out.skip = a.skip and b.skip
    out.pages = max(a.pages, b.pages) if same_page else a.pages + b.pages
    out.chars, out.links = a.chars + b.chars, a.links + b.links
    if a.kind == TEXT:
        out.text = a.text if a.text == b.text else None
        return out
    matched = _pairs([p.kind for p in a.parts], [p.kind for p in b.parts])
    i = j = 0
    for x, y in [*matched, (len(a.parts), len(b.parts))]:
        for rest in (a.parts[i:x], b.parts[j:y]):
            for p in rest:
                p.optional = True
                out.parts.append(p)
        if x < len(a.parts):
            out.parts.append(align(a.parts[x], b.parts[y], same_page))
        i, j = x + 1, y + 1
    # an inserted group beside one of its kind is the same group repeated
    folded: list[Wrapper] = []
    for p in out.parts:
        if folded and folded[-1].kind == p.kind:
            both = align(folded[-1], p, same_page=True)
            both.repeated, both.optional = True, folded[-1].optional and p.optional
            folded[-1] = both
        else:
            folded.append(p)
    out.parts = folded
    return out


def infer(pages: list[Group]) -> Wrapper:
    """Wrapper of pages of one host, aligned in order."""
    wrapper = _of(pages[0])
    for page in pages[1:]:
        wrapper = align(wrapper, _of(page))
    return wrapper


def expression(w: Wrapper) -> str:
    """The wrapper as text: kind(inner ...), # for slots, quoted constants, ? and + for optional and repeated."""
    body = (json.dumps(w.text, ensure_ascii=False) if w.text is not None else TEXT) if w.kind == TEXT else \
        f"{w.kind}({' '.join(expression(p) for p in w.parts)})"
    return body + ("+" if w.repeated else "") + ("?" if w.optional else "")


def _slots(w: Wrapper) -> int:
    """Characters of slots outside links and boilerplate."""
    if w.skip:
        return 0
    own = sum(p.chars for p in w.parts if p.kind == TEXT and p.text is None) - w.links
    return max(0, own) + sum(_slots(p) for p in w.parts if p.kind != TEXT)


def _marked(w: Wrapper, path: tuple[str, ...] = ()) -> tuple[str, ...] | None:
    """Path of the first article, or else main, outside boilerplate."""
    for wanted in ("article", "main"):
        level = [(p, path) for p in w.parts]
        while level:
            below = []
            for p, at in level:
                if p.kind == TEXT or p.skip:
                    continue
                if p.kind.split(".")[0] == wanted:
                    return (*at, p.kind)
                below += [(q, (*at, p.kind)) for q in p.parts]
            level = below
    return None


def _at(w: Wrapper, path: tuple[str, ...]) -> list[Wrapper]:
    """Groups of the expression at a path of kinds."""
    level = [w]
    for kind in path:
        level = [p for q in level for p in q.parts if p.kind == kind]
    return level


def content_path(w: Wrapper) -> tuple[str, ...]:
    """Path of kinds to the content group: the deepest group that holds most of the slot text. An article or main is
    taken if it holds as much of it, or if there are no slots to tell by."""
    total = _slots(w)
    marked = _marked(w)
    if marked and sum(map(_slots, _at(w, marked))) >= CONTENT_SHARE * total:
        return marked
    path: list[str] = []
    while total:
        best = max((p for p in w.parts if p.kind != TEXT), key=_slots, default=None)
        if best is None or best.repeated or best.kind.split(".")[0] in BLOCKS or _slots(best) < CONTENT_SHARE * total:
            break
        path.append(best.kind)
        w = best
    return tuple(path)


def differs(rest: int, rest_chars: int, constant_chars: int) -> bool:
    """Whether what a page holds besides constant texts shows that it is no copy: two blocks, or most of its text."""
    return rest >= 2 or rest == 1 and rest_chars >= constant_chars


def template_texts(w: Wrapper, path: tuple[str, ...], pages: list[Group]) -> list[tuple[str, str]]:
    """(path, text) of the template texts of one layout's distinct pages, as ``templates`` counts them.

    None if half of the pages are copies of one another, since what they share then is data.
    """
    if w.pages < TEMPLATE_PAGES:
        return []
    held = [dict.fromkeys(placed(p, path)) for p in pages]
    count = Counter(b for blocks_ in held for b in blocks_)
    constant = {b for b, n in count.items() if n >= TEMPLATE_SHARE * len(pages)}
    apart = 0
    for blocks_ in held:
        rest = [b for b in blocks_ if b not in constant]
        apart += differs(len(rest), sum(len(t) for _, t in rest), sum(len(t) for _, t in blocks_ if (_, t) in constant))
    return [b for b in count if b in constant] if 2 * apart > len(pages) else []


# ---------------------------------------------------------------- extraction

def placed(page: Group, path: tuple[str, ...]) -> Iterator[tuple[str, str]]:
    """(path, text) of the content group's blocks in page order."""
    def walk(group: Group, at: tuple[str, ...]):
        inside = len(at) >= len(path) and at[:len(path)] == path
        if not inside and at != path[:len(at)]:
            return
        header = "header" in (k.split(".")[0] for k in at)
        for p in group.parts:
            if isinstance(p, str):
                if inside and (not header or group.tag in HEADINGS):
                    yield "/".join(at), p
            elif not p.skip:
                yield from walk(p, (*at, p.kind))

    return walk(page, ())


def layout(group: Group, path: tuple[str, ...] | None) -> tuple[tuple[str, ...], list[tuple[str, str]]]:
    """Path of the page's content group and its placed blocks: the host's, or the page's own if that has none."""
    found = list(placed(group, path)) if path is not None else []
    if not found:
        path = content_path(_of(group))
        found = list(placed(group, path))
    return path, found


def mark(block: tuple[str, str]) -> int:
    """Hash of a placed block."""
    data = "\0".join(block).encode("utf-8", "surrogatepass")
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


class Marks:
    """Template texts known by their hashes."""

    def __init__(self, marks: list[int]):
        self.marks = frozenset(marks)

    def __contains__(self, block: tuple[str, str]) -> bool:
        return mark(block) in self.marks


def main_text(page: str | None, path: tuple[str, ...] | None, template: set[tuple[str, str]] | dict[str, Marks]) -> str:
    """The page's text without the template texts, given for the path alone or by layout."""
    own, found = layout(read(page), path)
    if isinstance(template, dict):
        template = template.get("/".join(own), ())
    elif own != path:
        template = ()
    return "\n".join(b[1] for b in found if b not in template) if template else "\n".join(b[1] for b in found)


def host(url: Column) -> Column:
    """Lower-case host of a url; empty for null or no host."""
    return F.lower(F.coalesce(F.regexp_extract(url, "^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def dump(w: Wrapper) -> str:
    """The wrapper as JSON, all its fields kept."""
    def plain(x: Wrapper) -> list:
        return [x.kind, x.optional * 1 + x.repeated * 2 + x.skip * 4, x.text, x.pages, x.chars, x.links, [plain(p) for p in x.parts]]

    return json.dumps(plain(w))


def load(text: str) -> Wrapper:
    """The wrapper that ``dump`` wrote."""
    def made(x: list) -> Wrapper:
        w = Wrapper(x[0])
        w.optional, w.repeated, w.skip = bool(x[1] & 1), bool(x[1] & 2), bool(x[1] & 4)
        w.text, w.pages, w.chars, w.links = x[2:6]
        w.parts = [made(p) for p in x[6]]
        return w

    return made(json.loads(text))


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, expression, path) of every host, from all its distinct pages.

    No group aligns more than some ``PART_PAGES`` pages or ``MERGED`` wrappers,
    so a host of very many pages is read by many tasks. Order and parts follow
    from the pages' hashes alone.
    """
    keyed = pages.select(host(F.col("url")).alias("host"), F.xxhash64("html").alias("k"), F.col("html").cast("string").alias("html")) \
        .filter("html is not null")
    sizes = materialize(keyed.select("host", "k").distinct().groupBy("host").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(float(PART_PAGES))).alias("n_parts")), "host-parts")
    most = sizes.agg(F.max("n_parts")).first()[0] or 1

    def page_wrappers(batches):
        seen = set()          # of the task: a page that is repeated very often is read and sent once for each task
        for b in slices(batches):
            new = []
            for i, key in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
                if key not in seen:
                    seen.add(key)
                    new.append(i)
            b = b.take(pa.array(new, pa.int64()))
            made = [dump(_of(read(h))) for h in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(made, pa.string())], names=["host", "at", "wrapper"])

    def merge(table: pa.Table) -> pa.Table:
        order = table.sort_by("at")
        found, last = None, None
        for at, w in zip(order["at"].to_pylist(), order["wrapper"].to_pylist()):
            if at != last:
                found, last = load(w) if found is None else align(found, load(w)), at
        return pa.table({"host": order["host"][:1], "at": order["part"][:1], "wrapper": [dump(found)]})

    def named(batches):
        for b in slices(batches):
            made = [load(w) for w in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([expression(w) for w in made], pa.string()),
                                              pa.array([json.dumps(content_path(w)) for w in made], pa.string())],
                                             names=["host", "expression", "path"])

    row = "host string, at bigint, wrapper string"
    level = map_arrow(keyed, page_wrappers, row).join(_bounded(sizes, "host"), "host") \
        .withColumn("part", F.pmod("at", "n_parts")).drop("n_parts").groupBy("host", "part").applyInArrow(merge, row)
    while most > 1:
        level = level.withColumn("part", F.floor(F.col("at") / MERGED)).groupBy("host", "part").applyInArrow(merge, row)
        most = -(-most // MERGED)
    return map_arrow(level.select("host", "wrapper"), named, "host string, expression string, path string")


def _bounded(small: DataFrame, *columns: str) -> DataFrame:
    """A broadcast of ``small`` if the texts and arrays in it are within the bound."""
    kinds = dict(small.dtypes)
    size = small.agg(F.sum(sum((8 * F.size(c) if kinds[c].startswith("array") else F.length(c) for c in columns), F.lit(0)))).first()[0]
    return F.broadcast(small) if (size or 0) <= BROADCAST_BYTES else small


def templates(pages: DataFrame, paths: DataFrame) -> DataFrame:
    """(host, layouts): hashes of the template texts of each layout, over all distinct pages of (url, html)."""
    keyed = pages.select(host(F.col("url")).alias("host"), F.xxhash64("html").alias("k"), F.col("html").cast("string").alias("html")) \
        .filter("html is not null").join(_bounded(paths, "host", "path"), "host")

    def run(batches):
        for b in slices(batches):
            layouts, marks, chars = [], [], []
            for page, path in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                own, found = layout(read(page), tuple(json.loads(path)))
                distinct = {mark(x): len(x[1]) for x in found}
                layouts.append("/".join(own))
                marks.append(list(distinct))
                chars.append(list(distinct.values()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(layouts, pa.string()),
                                              pa.array(marks, pa.list_(pa.int64())), pa.array(chars, pa.list_(pa.int32()))],
                                             names=["host", "k", "layout", "marks", "chars"])

    read_ = map_arrow(keyed.select("host", "k", "html", "path"), run,
                      "host string, k bigint, layout string, marks array<bigint>, chars array<int>")
    # repeated pages count once
    held = materialize(read_.filter(F.size("marks") > 0).dropDuplicates(["host", "k"]), "blocks")
    by = ["host", "layout"]
    n = held.groupBy(*by).agg(F.count("*").alias("n")).filter(F.col("n") >= TEMPLATE_PAGES)
    count = held.select(*by, F.explode("marks").alias("mark")).groupBy(*by, "mark").agg(F.count("*").alias("c")) \
        .filter(F.col("c") >= TEMPLATE_PAGES * TEMPLATE_SHARE)
    # at most a page's blocks / TEMPLATE_SHARE for each layout
    constant = materialize(count.join(n, by).filter(F.col("c") >= TEMPLATE_SHARE * F.col("n"))
                           .groupBy(*by).agg(F.collect_list("mark").alias("constant")), "constants")
    known = held.join(_bounded(constant, "host", "layout", "constant"), by)
    each = F.arrays_zip("marks", "chars")
    rest = F.filter(each, lambda x: ~F.array_contains("constant", x["marks"]))
    total = lambda a: F.aggregate(a, F.lit(0).cast("bigint"), lambda s, x: s + x["chars"])
    page = known.select(*by, F.size(rest).alias("rest"), total(rest).alias("rest_chars"), total(each).alias("all_chars"))
    apart = (F.col("rest") >= 2) | ((F.col("rest") == 1) & (2 * F.col("rest_chars") >= F.col("all_chars")))
    differing = page.groupBy(*by).agg(F.avg(apart.cast("double")).alias("share")).filter("share > 0.5")
    return constant.join(differing, by).groupBy("host").agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct("layout", "constant")))).alias("layouts"))


def extract(pages: DataFrame) -> DataFrame:
    """op2: (page_id, url, text, n_chars) of every page."""
    pages = pages.select("page_id", "url", "html")
    paths = materialize(wrappers(pages).select("host", "path"), "wrappers")
    rules = materialize(paths.join(templates(pages, paths), "host", "left").select(
        "host", F.concat(F.lit("["), "path", F.lit(","), F.coalesce("layouts", F.lit("{}")), F.lit("]")).alias("rules")), "rules")
    rules = _bounded(rules, "host", "rules")
    joined = pages.withColumn("host", host(F.col("url"))).join(rules, "host", "left") \
        .select("page_id", "url", F.col("html").cast("string"), "rules")

    def run(batches):
        known: dict[str | None, tuple] = {None: (None, {})}
        for b in slices(batches):
            texts = []
            for page, rule in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                if rule not in known:
                    if len(known) > 10_000:
                        known = {None: (None, {})}
                    path, layouts = json.loads(rule)
                    known[rule] = (tuple(path), {at: Marks(marks) for at, marks in layouts.items()})
                texts.append(main_text(page, *known[rule]))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    kinds = {c: pages.schema[c].dataType.simpleString() for c in ("page_id", "url")}
    return map_arrow(joined, run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint")
