"""Main text of web pages by inferred wrappers (union-free regular expressions).

A page is a stream of units: container tags that open and close (with class and
id names), and block tags with the text that follows them; neighbouring units
(and runs of two to four) that repeat become one repeated unit. A wrapper starts
as one page's stream and is aligned with others by a longest common subsequence:
units that differ on either side become optional, units that recur repeated, and
texts that differ become slots. Texts that never differ are the host's template.

The main container of a host is the article (or main) element that holds its
slots' text or, without one, the deepest container that still holds most of it.
A page's text is what its main container holds, without the containers that are
menus, footers, sidebars, notices, adverts, forms or comments by name, without
headers that stand in no article or main element, without blocks that are notices or adverts by
name and, where it is no article or main element, without the template's texts.

Wrappers are fitted on all pages of a host. Pages of one shape (the same units in
the same containers) are counted together in each task, whatever the tasks: counts
and sums add up, and a text is one or several. The shapes' wrappers are then
aligned, at most about ``GROUP`` in a task, in rounds until each host has one;
shapes are dealt by hash and aligned by falling pages, so neither the files' layout
nor the tasks change the result, and a hot host is spread like any other. A host's
wrapper meets its pages in a broadcast if hosts were counted to be few, else in a
join.

Character references are decoded, white space in a block becomes one space, and
blocks are joined in page order by one space. Defined results: null and empty
pages give the empty text; a null url, or one without a host, belongs to the host
``''``; cut pages, unclosed and unknown tags are read to their end; a host's only
page is extracted by the same rules from its own wrapper; repeated rows give
equal rows; an empty table gives an empty result; only the id, url and html
columns are read, whatever other columns are called.
"""

from __future__ import annotations

import hashlib
import html as references
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm import common as C

#: Units (repeats folded) that are aligned at once: longer streams are aligned in segments.
LONGEST = 4000
#: Wrappers that a task aligns, about, and units that it holds while it reads pages.
GROUP, HELD = 64, 100_000
#: Pages that must agree on a text before it is the host's template.
AGREE = 4
#: The share of slot text that the main container holds.
MOST = 0.6
#: Hosts whose wrappers may be broadcast.
FEW_HOSTS = 20_000

CONTAINERS = frozenset("html head body div nav header footer aside article main section form ul ol "
                       "table tbody thead tr td th dl figure fieldset details dialog select".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
SKIPPED = frozenset("head nav footer aside form select dialog button menu".split())
RAW = "script|style|noscript|template|svg|iframe|textarea|object|math|title"
_NOISE = re.compile(
    r"(?:^|[-_ ])(?:ads?|adverts?|advertisement|banner|breadcrumbs?|comments?|cookies?|consent|footer|"
    r"header|login|masthead|menu|modal|nav|navbar|navigation|newsletter|notices?|popup|promo|related|"
    r"respond|share|sharing|sidebar|signup|social|sponsor(?:ed)?|subscribe|toolbar|widget)(?:$|[-_ ])",
    re.I)
#: Names that make a single block (a paragraph, a heading) none of the article.
_ASIDE = re.compile(
    r"(?:^|[-_ ])(?:ads?|adverts?|advertisement|cookies?|consent|newsletter|notices?|promo|"
    r"sponsor(?:ed)?|subscribe)(?:$|[-_ ])", re.I)
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*(?:>|\Z)",
    re.S | re.I)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_DIGITS = re.compile(r"\d+")

Path = tuple[str, ...]


class Unit:
    """A container tag, or a block tag with the text behind it."""
    __slots__ = ("sign", "text", "path", "times")

    def __init__(self, sign: str, path: Path, text: str = ""):
        self.sign, self.path, self.text, self.times = sign, path, text, 1


def _container(name: str, attributes: str) -> str:
    found = sorted({_DIGITS.sub("", v.strip("\"'")).strip().lower()
                    for _, v in _NAMES.findall(attributes)} - {""})
    return ".".join([name, *found])


def stream(page: str) -> list[Unit]:
    """A page's units, each with the containers it stands in."""
    units, path, text, sign, at, aside = [], (), [], "", 0, False

    def block() -> None:
        whole = " ".join(references.unescape("".join(text)).split())
        text.clear()
        if whole and not aside:
            units.append(Unit(f"<{sign}>#" if sign else "#", path, whole))

    for m in _TOKEN.finditer(page):
        if m.start() > at:
            text.append(page[at:m.start()])
        at = m.end()
        name = (m[3] or "").lower()
        if not name or name in INLINE:
            if not name:
                text.append(" ") if m[1] else None
            continue
        block()
        sign, aside = "", aside and name == "br"
        if name not in CONTAINERS:
            sign = "" if m[2] else name
            if not m[2] and name != "br":
                aside = any(_ASIDE.search(v.strip("\"'")) for _, v in _NAMES.findall(m[4]))
        elif not m[2]:
            if not m[4].rstrip().endswith("/"):
                own = _container(name, m[4])
                path = (*path, own)
                units.append(Unit(f"<{own}>", path))
        else:
            for k in range(len(path) - 1, -1, -1):
                if path[k].partition(".")[0] == name:
                    units.append(Unit(f"</{path[k]}>", path[:k + 1]))
                    path = path[:k]
                    break
    rest = page[at:]
    cut = rest.rfind("<")
    text.append(rest if cut < 0 or not re.match(r"</?[a-zA-Z!]", rest[cut:]) else rest[:cut])
    block()
    return units


def folded(units: list[Unit]) -> list[tuple[str, list[Unit]]]:
    """The stream with repeats of one to four units as one repeated unit."""
    runs = [(u.sign, [u]) for u in units]
    for size in (1, 2, 3, 4):
        out: list[tuple[str, list[Unit]]] = []
        i = 0
        while i < len(runs):
            sign = [s for s, _ in runs[i:i + size]]
            j = i + size
            while len(sign) == size and [s for s, _ in runs[j:j + size]] == sign:
                j += size
            if j > i + size:
                body = [u for _, us in runs[i:j] for u in us]
                out.append((f"({''.join(sign)})+" if size > 1 else sign[0], body))
                i = j
            else:
                out.append(runs[i])
                i += 1
        runs = out
    return runs


class Node:
    """A unit of a wrapper: the pages that have it, and what it was found to be.
    ``text`` is its text while that is one (``single``) on all of them."""
    __slots__ = ("sign", "path", "pages", "optional", "repeated", "text", "single", "chars")

    def __init__(self, sign: str, path: Path, pages: int = 1, optional: bool = False,
                 repeated: bool = False, text: str | None = None, single: bool = False, chars: int = 0):
        self.sign, self.path, self.pages, self.optional = sign, path, pages, optional
        self.repeated, self.text, self.single, self.chars = repeated, text, single, chars

    @classmethod
    def of(cls, sign: str, units: list[Unit]) -> Node:
        texts = {u.text for u in units if u.text}
        return cls(sign, units[0].path, 1, False,
                   len(units) > 1 and units[0].sign == units[1].sign or sign[0] == "(",
                   next(iter(texts)) if len(texts) == 1 else None, len(texts) == 1,
                   sum(len(u.text) for u in units))

    def meet(self, other: Node) -> None:
        self.pages += other.pages
        self.optional |= other.optional
        self.repeated |= other.repeated
        self.chars += other.chars
        if self.text != other.text or not other.single:
            self.text, self.single = None, False

    def __str__(self) -> str:
        sign = self.sign.replace("#", self.text) if self.single and self.pages > 1 else self.sign
        sign += "+" if self.repeated and not sign.endswith("+") else ""
        return f"({sign})?" if self.optional else sign


class Wrapper:
    """The nodes of ``pages`` pages, and the smallest hashes of different texts
    among these (``AGREE`` at most: whether there are so many)."""
    __slots__ = ("pages", "seen", "nodes")

    def __init__(self, pages: int, seen: list[int], nodes: list[Node]):
        self.pages, self.seen, self.nodes = pages, seen, nodes

    @classmethod
    def of(cls, units: list[Unit]) -> Wrapper:
        return cls(1, [_long("\0".join(u.text for u in units))],
                   [Node.of(sign, us) for sign, us in folded(units)])

    def shape(self) -> int:
        return _long(json.dumps([(n.sign, n.path) for n in self.nodes]))

    def meet(self, other: Wrapper) -> None:
        """Align another wrapper with this one, which becomes that of all their pages."""
        self.pages += other.pages
        self.seen = sorted({*self.seen, *other.seen})[:AGREE]
        nodes: list[Node] = []
        for what, a, b, c, d in aligned([n.sign for n in self.nodes], [n.sign for n in other.nodes]):
            if what == "equal":
                for node, met in zip(self.nodes[a:b], other.nodes[c:d]):
                    node.meet(met)
                nodes += self.nodes[a:b]
            else:
                for node in (alone := self.nodes[a:b] + other.nodes[c:d]):
                    node.optional = True
                nodes += alone
        self.nodes = nodes

    def dump(self) -> str:
        paths: dict[Path, int] = {}
        nodes = [(n.sign, paths.setdefault(n.path, len(paths)), n.pages, n.optional, n.repeated,
                  n.text, n.single, n.chars) for n in self.nodes]
        return json.dumps([self.pages, self.seen, list(paths), nodes])

    @classmethod
    def load(cls, dumped: str) -> Wrapper:
        pages, seen, paths, nodes = json.loads(dumped)
        paths = [tuple(p) for p in paths]
        return cls(pages, seen, [Node(sign, paths[k], *rest) for sign, k, *rest in nodes])


def _long(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "big", signed=True)


def common(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """The places of a longest common subsequence, by rows of bits: a bit of
    ``rows[j]`` is 0 where one more sign of ``a`` fits into ``b``'s first j + 1."""
    at: dict[str, int] = {}
    for i, sign in enumerate(a):
        at[sign] = at.get(sign, 0) | 1 << i
    every = (1 << len(a)) - 1
    row, rows = every, []
    for sign in b:
        fits = row & at.get(sign, 0)
        row = (row + fits | row - fits) & every
        rows.append(row)
    out, i, j = [], len(a), len(b)
    while i and j:
        if rows[j - 1] >> i - 1 & 1:
            i -= 1
        else:
            j -= 1
            if not j or rows[j - 1] >> i - 1 & 1:
                i -= 1
                out.append((i, j))
    return out[::-1]


def aligned(a: list[str], b: list[str], longest: int = LONGEST) -> list[tuple[str, int, int, int, int]]:
    """Opcodes ``("equal" or "replace", i, i_end, j, j_end)`` that cover both. What
    both begin and end with is equal; beyond ``longest`` signs the rest is aligned
    segment by segment."""
    least = min(len(a), len(b))
    head = next((k for k in range(least) if a[k] != b[k]), least)
    tail = next((k for k in range(least - head) if a[-1 - k] != b[-1 - k]), least - head)
    m, n = len(a) - head - tail, len(b) - head - tail
    pairs = [(k, k) for k in range(head)]
    if m and n:
        parts = -(-max(m, n) // longest)
        for k in range(parts):
            i, j = head + m * k // parts, head + n * k // parts
            x, y = a[i:head + m * (k + 1) // parts], b[j:head + n * (k + 1) // parts]
            pairs += [(p + i, q + j) for p, q in common(x, y)]
    pairs += [(len(a) - k, len(b) - k) for k in range(tail, 0, -1)]
    out: list[tuple[str, int, int, int, int]] = []
    i = j = 0
    for p, q in [*pairs, (len(a), len(b))]:
        if p > i or q > j:
            out.append(("replace", i, p, j, q))
        if p < len(a) and q < len(b):
            if out and out[-1][0] == "equal":
                out[-1] = ("equal", out[-1][1], p + 1, out[-1][3], q + 1)
            else:
                out.append(("equal", p, p + 1, q, q + 1))
        i, j = p + 1, q + 1
    return out


def noise(name: str) -> bool:
    """Whether a container is none of the article by its tag, class or id."""
    tag, _, names = name.partition(".")
    return tag in SKIPPED or any(map(_NOISE.search, names.split("."))) if names else tag in SKIPPED


def outside(path: Path, inner: int = 0) -> bool:
    """Whether a unit stands in what is none of the article, from the path's
    ``inner``-th container on. A header within an article or main element is its own."""
    tags = [name.partition(".")[0] for name in path]
    own = next((k for k, tag in enumerate(tags) if tag in ("article", "main")), len(path))
    return "header" in tags[inner:own] or any(map(noise, path[inner:]))


def main_container(wrapper: list[Node]) -> Path:
    """The container that holds the pages' own text."""
    share: dict[Path, int] = {}
    total = 0
    for node in wrapper:
        if not node.chars or outside(node.path) or node.single and node.pages > 1:
            continue
        total += node.chars
        for k in range(1, len(node.path) + 1):
            share[node.path[:k]] = share.get(node.path[:k], 0) + node.chars
    for tag in ("article", "main"):
        named = [p for p in share if p[-1].partition(".")[0] == tag and share[p] >= 0.3 * total]
        if named:
            return min(named, key=lambda p: (len(p), -share[p], p))
    held = [p for p in share if share[p] >= MOST * total]
    return max(held, key=lambda p: (len(p), share[p], p)) if held else ()


def _hash(sign: str, text: str) -> str:
    return hashlib.blake2b(f"{sign}\0{text}".encode(), digest_size=8).hexdigest()


def fitted(wrapper: Wrapper) -> dict:
    """A wrapper's main container, its template's texts, and its regular
    expression in words. Without units ``main`` is None."""
    main = main_container(wrapper.nodes)
    # An article element is the page's own text, whatever pages have in common.
    own = bool(main) and main[-1].partition(".")[0] in ("article", "main")
    # Pages that are copies of one another would make a template of their text.
    template = sorted({_hash(n.sign, n.text) for n in wrapper.nodes
                       if not own and len(wrapper.seen) >= AGREE and n.path[:len(main)] == main
                       and n.single and not n.optional})
    return {"main": list(main) if wrapper.nodes else None, "template": template,
            "regex": "".join(map(str, wrapper.nodes))}


def fit(pages: list[str]) -> dict:
    """``fitted`` of the wrapper of some pages."""
    out = Wrapper(0, [], [])
    for k, units in enumerate(filter(None, map(stream, pages))):
        if k:
            out.meet(Wrapper.of(units))
        else:
            out = Wrapper.of(units)
    return fitted(out)


def extract(page: str | None, main: Path | None, template: frozenset[str]) -> str:
    """A page's main text by its host's wrapper or, without one, by its own."""
    units = stream(page or "")
    if main is None or not any(u.path[:len(main)] == main for u in units):
        main = main_container([Node.of(u.sign, [u]) for u in units])
    n = len(main)
    return " ".join(
        u.text for u in units if u.text and u.path[:n] == main
        and not outside(u.path, n)
        and not (template and _hash(u.sign, u.text) in template))


_ROWS = "host string, shape long, part long, wrapper string"


def _shapes(pages: DataFrame) -> DataFrame:
    """``(host, shape, part, wrapper)`` of ``(host, html)``: the pages of one shape that
    a task (``part``) read make one row, or several where it read many shapes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], Wrapper] = {}
        held, task = 0, TaskContext.get().partitionId()

        def rows() -> Iterator[pa.RecordBatch]:
            of = list(found)
            for k in range(0, len(of), C.BATCH_ROWS):
                part = of[k:k + C.BATCH_ROWS]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([h for h, _ in part], pa.string()), pa.array([s for _, s in part], pa.int64()),
                     pa.array([task] * len(part), pa.int64()),
                     pa.array([found[x].dump() for x in part], pa.string())],
                    names=["host", "shape", "part", "wrapper"])

        for batch in batches:
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                units = stream(page or "")
                if not units:
                    continue
                wrapper = Wrapper.of(units)
                key = host, wrapper.shape()
                if key in found:
                    found[key].meet(wrapper)
                else:
                    found[key] = wrapper
                    held += len(wrapper.nodes)
            if held > HELD:
                yield from rows()
                found.clear()
                held = 0
        yield from rows()

    return pages.select("host", "html").mapInArrow(run, _ROWS)


def _joined(rows: DataFrame, keys: list[str], place: str, group: int) -> DataFrame:
    """The stored ``rows`` with one wrapper for all of the same keys, stored; ``rows``
    are deleted. Where more than ``group`` have the same keys, they are dealt by
    ``place`` to several tasks, in rounds."""
    def run(_: tuple, table: pa.Table) -> pa.Table:
        parts = [(Wrapper.load(w), s) for w, s in zip(table.column("wrapper").to_pylist(),
                                                      table.column("shape").to_pylist())]
        parts.sort(key=lambda p: (-p[0].pages, p[1]))
        out = parts[0][0]
        for other, _shape in parts[1:]:
            out.meet(other)
        one = table.slice(0, 1)
        return pa.table({**{c: one.column("deal" if c == place else c) for c in ("host", "shape", "part")},
                         "wrapper": pa.array([out.dump()], pa.string())})

    while True:
        many = rows.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")
        if many.isEmpty():
            return rows
        once = rows.join(C.few(many), keys, "left").withColumn(
            "deal", F.pmod(place, F.ceil(F.coalesce("n", F.lit(1)) / group)))
        once = C.stored(once.groupBy(*keys, "deal").applyInArrow(run, _ROWS), "wrappers")
        C.dropped(rows)
        rows = once


def host_wrappers(pages: DataFrame, group: int = GROUP) -> DataFrame:
    """``(host, pages, main, template, regex)`` of all hosts of ``(host, html)``,
    from all their pages."""
    shapes = _joined(C.stored(_shapes(pages), "shapes"), ["host", "shape"], "part", group)
    hosts = _joined(shapes, ["host"], "shape", group)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wrappers = [Wrapper.load(w) for w in batch.column("wrapper").to_pylist()]
            found = [fitted(w) for w in wrappers]
            yield pa.RecordBatch.from_arrays(
                [batch.column("host"), pa.array([w.pages for w in wrappers], pa.int64()),
                 pa.array([json.dumps(w["main"]) for w in found], pa.string()),
                 pa.array([" ".join(w["template"]) for w in found], pa.string()),
                 pa.array([w["regex"] for w in found], pa.string())],
                names=["host", "pages", "main", "template", "regex"])

    out = C.stored(hosts.mapInArrow(
        run, "host string, pages long, main string, template string, regex string"), "wrappers")
    C.dropped(hosts)
    return out


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html", group: int = GROUP) -> DataFrame:
    """One row per input row: the id, the url and ``text``."""
    C.small_batches(pages.sparkSession)
    host = F.lower(F.regexp_extract(F.coalesce(url_col, F.lit("")), r"^[a-zA-Z][\w+.-]*://([^/?#]*)", 1))
    own = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                       F.col(html_col).alias("html"), host.alias("host"))
    found = host_wrappers(own.filter("html <> ''"), group).select("host", "main", "template")
    small = found.limit(FEW_HOSTS + 1).count() <= FEW_HOSTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for page, main, template in zip(*(batch.column(c).to_pylist()
                                              for c in ("html", "main", "template"))):
                path = json.loads(main) if main else None
                texts.append(extract(page, None if path is None else tuple(path),
                                     frozenset((template or "").split())))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("url"), pa.array(texts, pa.string())],
                names=["id", "url", "text"])

    kind = pages.schema[id_col].dataType.simpleString()
    return (own.join(F.broadcast(found) if small else found, "host", "left")
            .select("id", "url", "html", "main", "template")
            .mapInArrow(run, f"id {kind}, url string, text string")
            .withColumnRenamed("id", id_col).withColumnRenamed("url", url_col))
