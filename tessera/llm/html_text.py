"""Main text of web pages by wrapper induction.

Pages become small trees: containers, and blocks of text as leaves. A host's pages are aligned with a few sample pages
of the host, and with a few of their own layout (the set of their label paths), by simple tree matching (the largest order-preserving match of equal labels, children by dynamic
programming). Over all pages of the host it is counted how often each leaf of a sample is met and how often with the
same text; leaves that stay the same on nearly all pages are the template, slots that vary are content. A page keeps
the leaves of its article that are neither template nor in a part that is marked as a menu, header, footer, sidebar,
notice, advert, form or comments.
"""

from __future__ import annotations

import html
import re
import sys
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import stored

#: Elements by their part in a page.
RAW = frozenset("script style noscript template svg iframe object textarea select title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var math mfrac mi mn mo mover mroot mrow ms mspace msqrt mstyle msub msubsup msup mtext munder munderover semantics".split())
BOILER_TAGS = frozenset("head nav footer aside form button menu dialog fieldset label datalist".split()) | RAW
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
BOILER_NAMES = frozenset(
    "ad ads advert adverts advertisement adsense banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs header masthead topbar footer colophon copyright "
    "sidebar aside rail widget notice cookie cookies consent gdpr popup modal overlay alert subscribe subscription newsletter signup login share sharing social comment comments disqus "
    "replies responses related recommended pagination pager toolbar search searchbox form".split()
)
#: Names that mean the site's parts outside an article, but in one its own: a heading, a call-out, a layout.
OUTSIDE_ONLY = frozenset("alert banner form header masthead menu overlay rail widget".split())
#: Names that say of an article element itself that it is none.
NOT_ARTICLE = frozenset("ad ads advert comment comments promo related reply sponsored teaser".split())
MAIN_NAMES = frozenset("article content main post entry story maincontent".split())
#: A tag with one of these ends an open one of the same group.
ENDS = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HOLDS = frozenset("ul ol dl table tbody thead tfoot div section article main body html aside nav header footer form blockquote".split())
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+|[^>]*)>""", re.S)
MARK = re.compile(r"""\b(class|id|role|hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
NAME = re.compile(r"[a-z]+")
DIGITS = re.compile(r"[0-9]+")
LEAST_PAGES, LEAST_SHARE = 10, 0.9
NEARLY = 0.6
#: Sample pages are kept by every worker up to this total size, else joined by host.
BROADCAST_BYTES = 32 << 20
CELLS = 1 << 18
COUNTS = ["host", "part", "sample", "leaf", "inside", "met", "same", "low", "high"]


class Node:
    __slots__ = ("boiler", "children", "inside", "label", "main", "n", "tag", "text")

    def __init__(self, tag: str, label: str, boiler: bool = False, main: bool = False, text: str | None = None, inside: bool = False) -> None:
        self.tag, self.label, self.boiler, self.main, self.text, self.inside = tag, label, boiler, main, text, inside
        self.children: list[Node] = []
        self.n = -1


def _node(tag: str, attributes: str, parent: Node) -> Node:
    inside = _holds(parent)
    label, boiler, main = tag, tag in BOILER_TAGS, tag in ("article", "main")
    if attributes and not attributes.isspace():
        for name, *values in MARK.findall(attributes):
            name, value = name.lower(), "".join(values).lower()
            if name == "hidden":
                boiler = True
            elif name == "role":
                boiler |= value.strip() in BOILER_ROLES
                main |= value.strip() == "main"
            else:
                label += f".{value}"
                if tag not in ("html", "body"):
                    words = {*NAME.findall(value), *re.split(r"\s+", value), *re.split(r"[\s_-]+", value)}
                    boiler |= not (NOT_ARTICLE if tag in ("article", "main") else BOILER_NAMES - OUTSIDE_ONLY if inside else BOILER_NAMES).isdisjoint(words)
                    main |= not MAIN_NAMES.isdisjoint(words)
    return Node(tag, label, boiler, main and not boiler, inside=inside)


def _holds(node: Node) -> bool:
    """Whether what is in this node is in an article or a part named as content."""
    return node.inside or node.main or node.tag == "article"


def parsed(page: str) -> Node:
    """The page's tree; what is left open is closed where HTML says so, or at the end."""
    root = Node("#page", "#page")
    stack, held = [root], []
    at, end = 0, len(page)

    def flush():
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            held.clear()
            if text:
                stack[-1].children.append(Node("#text", "#text", text=text, inside=_holds(stack[-1])))

    while at < end:
        m = TOKEN.search(page, at)
        if not m:
            held.append(page[at:])
            break
        if m.start() > at:
            held.append(page[at : m.start()])
        at = m.end()
        tag = m[2]
        if not tag:
            if m[0].startswith("<![CDATA["):
                held.append(html.escape(m[0][9:].removesuffix("]]>")))
            continue
        tag = tag.lower()
        if tag in INLINE:
            # An inline part that is marked as no content is a part of its own.
            if not m[1] and m[3] and (node := _node(tag, m[3], stack[-1])).boiler:
                flush()
                stack[-1].children.append(node)
                stack.append(node)
            elif m[1] and len(stack) > 1 and stack[-1].tag == tag:
                flush()
                stack.pop()
            continue
        flush()
        if m[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}\s*>", re.I).search(page, at) if not m[3].endswith("/") else None
            if close or not m[3].endswith("/"):
                at = close.end() if close else end
            continue
        if tag in VOID:
            continue
        ends = ENDS.get(tag)
        if tag in ENDS_P or ends:
            for k in range(len(stack) - 1, 0, -1):
                open_ = stack[k].tag
                if (ends and open_ in ends) or (tag in ENDS_P and open_ == "p"):
                    del stack[k:]
                    break
                if open_ in HOLDS:
                    break
        node = _node(tag, m[3], stack[-1])
        stack[-1].children.append(node)
        stack.append(node)
    flush()
    return root


def leaves(root: Node) -> list[Node]:
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        if node.text is not None:
            node.n = len(out)
            out.append(node)
        else:
            todo += reversed(node.children)
    return out


def layout(root: Node) -> str:
    """A hash of the page's label paths, whatever their number and whatever numbers are in the labels."""
    paths, todo = set(), [(root, 0)]
    while todo:
        node, path = todo.pop()
        for c in node.children:
            own = zlib.crc32(DIGITS.sub("0", f"/{c.label}").encode("utf-8", "replace"), path)
            paths.add(own)
            todo.append((c, own))
    whole = np.array(sorted(paths), np.uint32).tobytes()
    return f"{zlib.crc32(whole):08x}{zlib.adler32(whole):08x}{len(paths):x}"


def matched(a: Node, b: Node) -> tuple[int, list[tuple[Node, Node]]]:
    """``match`` for pages nested to any depth: Python's own calls take no room on the system's stack."""
    need, deep = 0, [(a, 1)]
    while deep:
        node, depth = deep.pop()
        need = max(need, depth)
        deep += [(c, depth + 1) for c in node.children]
    if 3 * need + 500 > sys.getrecursionlimit():
        sys.setrecursionlimit(3 * need + 500)
    return match(a, b)


def match(a: Node, b: Node) -> tuple[int, list[tuple[Node, Node]]]:
    """Simple tree matching: (matched nodes, pairs of leaves) of two nodes with one label.

    Two lists of children that are too long for one table are matched in linear memory, to the same score.
    """
    x, y = a.children, b.children
    if not x or not y:
        return 1, [(a, b)] if a.text is not None and b.text is not None else []
    pairs: list[tuple[Node, Node]] = []
    if len(x) * len(y) > CELLS:
        score = 1
        for p, q in _long_match(x, y):
            s, found = _one(p, q)
            score += s
            pairs += found
        return score, pairs
    own: dict[tuple[int, int], tuple[int, list]] = {}
    table = [[0] * (len(y) + 1)]
    for i, p in enumerate(x):
        above, row = table[-1], [0]
        for j, q in enumerate(y):
            best = max(above[j + 1], row[j])
            if p.label == q.label:
                own[i, j] = got = _one(p, q)
                best = max(best, above[j] + got[0])
            row.append(best)
        table.append(row)
    i, j = len(x), len(y)
    while i and j:
        got = own.get((i - 1, j - 1))
        if got and table[i][j] == table[i - 1][j - 1] + got[0]:
            pairs += got[1]
            i, j = i - 1, j - 1
        elif table[i][j] == table[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return 1 + table[-1][-1], pairs


def _one(p: Node, q: Node) -> tuple[int, list[tuple[Node, Node]]]:
    """What two children of one label add to a match."""
    if p.text is not None and q.text is not None:
        return (2 if p.text == q.text else 1), [(p, q)]
    return match(p, q)


def _same(p: Node, q: Node) -> bool:
    todo = [(p, q)]
    while todo:
        a, b = todo.pop()
        if a.label != b.label or a.text != b.text or len(a.children) != len(b.children):
            return False
        todo += zip(a.children, b.children, strict=True)
    return True


def _chain(node: Node) -> tuple[tuple[str, ...] | None, str | None]:
    """Labels down to the only leaf below a node, and its text; (None, None) where there is not just one."""
    labels = []
    while node.text is None:
        if len(node.children) != 1:
            return None, None
        labels.append(node.label)
        node = node.children[0]
    return tuple(labels), node.text


def _long_match(x: list[Node], y: list[Node]) -> list[tuple[Node, Node]]:
    """Pairs of a best match of two long lists of children, by Hirschberg's division of the table that match() fills.

    Equal parts at both ends are a best match of those parts. Scores of chains to one leaf are made a row at a time.
    """
    k = min(len(x), len(y))
    front = next((i for i in range(k) if not _same(x[i], y[i])), k)
    back = next((i for i in range(k - front) if not _same(x[-1 - i], y[-1 - i])), k - front)
    pairs = [*zip(x[:front], y[:front], strict=True), *zip(x[len(x) - back :], y[len(y) - back :], strict=True)]
    x, y = x[front : len(x) - back], y[front : len(y) - back]
    codes: dict = {}

    def coded(nodes: list[Node]) -> np.ndarray:
        rows = []
        for node in nodes:
            labels, text = _chain(node)
            shape = -1 if labels is None else codes.setdefault(("shape", labels), len(codes))
            rows.append((codes.setdefault(("label", node.label), len(codes)), shape, codes.setdefault(("text", text), len(codes)), len(labels or ())))
        return np.array(rows, np.int64).reshape(-1, 4)

    cx, cy = coded(x), coded(y)

    def gains(i: int, j0: int, j1: int) -> np.ndarray:
        label, shape, text, depth = cx[i]
        those = cy[j0:j1]
        chains = (those[:, 1] == shape) & (shape >= 0)
        out = np.where(chains, depth + 1 + (those[:, 2] == text), 0)
        for j in np.flatnonzero((those[:, 0] == label) & ~chains).tolist():
            out[j] = _one(x[i], y[j0 + j])[0]
        return out

    def row_after(above: np.ndarray, gain: np.ndarray) -> np.ndarray:
        row = above.copy()
        np.maximum(row[1:], above[:-1] + gain, out=row[1:])
        return np.maximum.accumulate(row)

    todo = [(0, len(x), 0, len(y))]
    while todo:
        i0, i1, j0, j1 = todo.pop()
        if i0 == i1 or j0 == j1:
            continue
        if i1 - i0 > 1 and (i1 - i0) * (j1 - j0) > CELLS:
            middle = (i0 + i1) // 2
            down, up = np.zeros(j1 - j0 + 1, np.int64), np.zeros(j1 - j0 + 1, np.int64)
            for i in range(i0, middle):
                down = row_after(down, gains(i, j0, j1))
            for i in reversed(range(middle, i1)):
                up = row_after(up, gains(i, j0, j1)[::-1])
            cut = j0 + int(np.argmax(down + up[::-1]))
            todo += [(i0, middle, j0, cut), (middle, i1, cut, j1)]
            continue
        table, gain = [np.zeros(j1 - j0 + 1, np.int64)], []
        for i in range(i0, i1):
            gain.append(gains(i, j0, j1))
            table.append(row_after(table[-1], gain[-1]))
        i, j = i1 - i0, j1 - j0
        while i and j:
            g = gain[i - 1][j - 1]
            if g and table[i][j] == table[i - 1][j - 1] + g:
                pairs.append((x[i0 + i - 1], y[j0 + j - 1]))
                i, j = i - 1, j - 1
            elif table[i][j] == table[i - 1][j]:
                i -= 1
            else:
                j -= 1
    return pairs


class Sample:
    """A sample page of a host or layout and which of its leaves are template."""

    def __init__(self, page: str, template: list[int] | None = None, root: Node | None = None) -> None:
        self.root = root or parsed(page)
        leaves(self.root)
        self.template = set(template or ())


def aligned(root: Node, samples: list[Sample], every: bool = False, known: dict | None = None) -> list[tuple[int, list[tuple[Node, Node]]]]:
    """(number, pairs of its leaves and the page's) of the samples that fit the page nearly as well as the best one.

    A sample page fits itself best, so it is the others of its layout that tell its template. Samples of the page's own
    layout are all taken (``every``). ``known`` holds matches of this page by sample tree.
    """
    known = {} if known is None else known
    found = []
    for s in samples:
        if id(s.root) not in known:
            known[id(s.root)] = matched(s.root, root)
        found.append(known[id(s.root)])
    best = max((score for score, _ in found), default=0)
    return [(k, pairs) for k, (score, pairs) in enumerate(found) if every or score >= NEARLY * best]


def _text_size(node: Node) -> int:
    size, todo = 0, [node]
    while todo:
        x = todo.pop()
        size += len(x.text) if x.text is not None else 0
        todo += [c for c in x.children if not c.boiler]
    return size


def _kept(node: Node, template: set[int]) -> list[str]:
    """The texts of a node's leaves without the template and what is marked as no content."""
    out: list[str] = []
    todo = [(c, node.tag == "article") for c in reversed(node.children)]
    while todo:
        c, in_article = todo.pop()
        if c.boiler or (in_article and c.tag == "article"):  # an article in an article is a comment
            continue
        if c.text is not None:
            if c.n not in template:
                out.append(c.text)
        elif not (c.tag == "header" and not in_article and not any(x.main for x in c.children)):
            todo += [(x, in_article or c.tag == "article") for x in reversed(c.children)]
    return out


def _mains(node: Node, tag: str | None) -> list[Node]:
    """Topmost parts that are the article, by tag or by name."""
    out: list[Node] = []
    todo = list(reversed(node.children))
    while todo:
        c = todo.pop()
        if c.boiler or c.text is not None:
            continue
        if c.tag == tag if tag else c.main:
            out.append(c)
        else:
            todo += reversed(c.children)
    return out


def main_text(root: Node, template: set[int]) -> str:
    """The text of the largest article, else of the largest part named as content, else of the whole page.

    Where the template leaves nothing of an article, the pages share the article itself, and it stays.
    """
    for tag in ("article", None):
        if mains := _mains(root, tag):
            best = max(mains, key=_text_size)
            if out := _kept(best, template) or _kept(best, set()):
                return " ".join(out)
    return " ".join(_kept(root, template))


def _lookup(shared):
    """Samples of a part of a row's host, "" or a layout: from the shared table, or from the row itself."""
    cache: dict[tuple[str, str], list[Sample]] = {}
    roots: dict[str, Node] = {}

    def get(host: str, part: str, pages: list[str] | None, templates: list[list[int]] | None) -> list[Sample]:
        if (host, part) not in cache:
            if len(cache) > 256:
                cache.clear()
                roots.clear()
            if shared is not None:
                pages, templates = shared.value.get((host, part), ([], []))
            pages = pages or []
            for p in pages:
                if p not in roots:
                    roots[p] = parsed(p)
            cache[host, part] = [Sample(p, t, roots[p]) for p, t in zip(pages, templates or [[]] * len(pages), strict=True)]
        return cache[host, part]

    return get


def _layouts(batches):
    for batch in batches:
        parts = pa.array([layout(parsed(x or "")) for x in batch.column("html").to_pylist()], pa.string())
        kept = [c for c in batch.schema.names if c != "html" or "page_id" in batch.schema.names]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), parts], [*kept, "part"])


def _rows(batch, *names):
    columns = [batch.column(n).to_pylist() if n in batch.schema.names else [None] * batch.num_rows for n in names]
    return zip(*columns, strict=True)


def _count(shared):
    def run(batches):
        get = _lookup(shared)
        counts: dict[tuple[str, str, int, int, bool], list[int]] = {}
        for batch in batches:
            for host, page, h, pages, own in _rows(batch, "host", "html", "h", "samples", "own_samples"):
                if not page:
                    continue
                root, known = parsed(page), {}
                for part, some in (("", pages), (layout(root), own)):
                    samples = get(host, part, some, None)
                    fitting = {k for k, _ in aligned(root, samples, bool(part), known)}
                    for k, pairs in aligned(root, samples, True, known):
                        # What is in an article is judged by the host alone, by all its pages (those that fit best are
                        # often those with the same words), and not by copies of one article.
                        inner = 0 if part else sum(len(q.text) if p.text == q.text else -len(q.text) for p, q in pairs if p.inside)
                        seen = [(p.n, p.inside, p.text == q.text) for p, q in pairs if (not part and inner <= 0 if p.inside else k in fitting)]
                        if not part and inner <= 0:
                            seen.append((-1, True, True))  # the page itself
                        for leaf, inside, same in seen:
                            entry = counts.setdefault((host, part, k, leaf, inside), [0, 0, h, h])
                            entry[0] += 1
                            entry[1] += same
                            entry[2:] = min(entry[2], h), max(entry[3], h)
        rows = [(*key, *entry) for key, entry in counts.items()]
        kinds = (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * len(kinds), kinds, strict=True)], COUNTS)

    return run


def _extract(shared):
    def run(batches):
        get = _lookup(shared)
        for batch in batches:
            out = []
            for host, page, *given in _rows(batch, "host", "html", "samples", "templates", "own_samples", "own_templates"):
                root = parsed(page or "")
                leaves(root)
                template, known = set(), {}
                for part, pages, templates in (("", *given[:2]), (layout(root), *given[2:])):
                    samples = get(host, part, pages, templates)
                    if any(s.template for s in samples):
                        template |= {q.n for k, pairs in aligned(root, samples, bool(part), known) for p, q in pairs if p.n in samples[k].template and p.text == q.text}
                out.append(main_text(root, template))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(out, pa.string())], ["page_id", "url", "text"])

    return run


def page_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: ``page_id``, ``url``, ``text``, ``n_chars``.

    A null or empty page has the text "". Pages without a host form one group. Leaves are counted over all pages of the
    host against its two samples, and over all pages of each layout against that layout's two. A leaf is template where
    LEAST_PAGES pages, or all where there are fewer, met it, two or more of them differ, and LEAST_SHARE of them had its
    text. In an article common passages are no template: there only the host counts, only pages whose article is not for
    the most part the sample's, and the share of all these by Laplace's rule, (same + 1) / (pages + 2). Repeated rows each get a row; ids are only carried. Other columns are ignored; an empty table gives an empty
    table. A host of any size costs a worker its sample pages and one small count a leaf.
    """
    spark = pages.sparkSession
    kind = pages.schema[id_col].dataType.simpleString()
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url_col).cast("string"), r"^[a-zA-Z][\w+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1)), F.lit(""))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"), host.alias("host"))
    # The samples are the pages of smallest hash: picked by hash alone, so that only they are carried with their html.
    full = rows.where("length(html) > 0")
    ranked = full.select("host", F.xxhash64("html").alias("h"), "html").mapInArrow(_layouts, "host string, h long, part string")
    ranked = stored(ranked.groupBy("host", "part", "h").agg(F.count("*").alias("n")), "layouts")
    ranked = ranked.select("host", F.explode(F.array(F.lit(""), "part")).alias("part"), "h", "n")
    lowest = ranked.groupBy("host", "part").agg(F.min("h").alias("h1"), F.max("h").alias("last"), F.sum("n").alias("n")).where("part = '' or h1 < last")
    lowest = stored(lowest, "lowest")
    second = ranked.join(lowest.select("host", "part", "h1"), ["host", "part"]).where("h > h1").groupBy("host", "part").agg(F.min("h").alias("h"))
    chosen = stored(lowest.select("host", "part", F.col("h1").alias("h")).unionByName(second), "chosen")
    htmls = full.select("host", F.xxhash64("html").alias("h"), "html").join(chosen.select("host", "h").distinct(), ["host", "h"]).groupBy("host", "h").agg(F.first("html").alias("html"))
    samples = chosen.join(htmls, ["host", "h"]).groupBy("host", "part").agg(F.array_sort(F.collect_list(F.struct("h", "html"))).alias("s"))
    samples = stored(samples.select("host", "part", F.col("s.html").alias("samples")), "samples")
    size = samples.agg(F.sum(F.length(F.concat_ws("", "samples")))).first()[0] or 0
    small = size <= BROADCAST_BYTES

    def joined(known: DataFrame) -> DataFrame:
        """Rows with the samples of their host and of their layout."""
        columns = [c for c in known.columns if c not in ("host", "part")]
        own = known.where("part <> ''").select("host", "part", *(F.col(c).alias(f"own_{c}") for c in columns))
        parted = rows.mapInArrow(_layouts, f"page_id {kind}, url string, html string, host string, part string")
        return parted.join(known.where("part = ''").drop("part"), "host", "left").join(own, ["host", "part"], "left")

    shared = spark.sparkContext.broadcast({(r["host"], r["part"]): (r["samples"], [[]] * len(r["samples"])) for r in samples.collect()}) if small else None
    counted = (rows if small else joined(samples)).withColumn("h", F.xxhash64("html")).mapInArrow(_count(shared), "host string, part string, sample int, leaf int, inside boolean, met long, same long, low long, high long")
    counted = counted.groupBy("host", "part", "sample", "leaf", "inside").agg(F.sum("met").alias("met"), F.sum("same").alias("same"), F.min("low").alias("low"), F.max("high").alias("high"))
    counted = stored(counted, "counts")
    counted = counted.where((F.col("same") >= LEAST_SHARE * F.col("met")) & (F.col("low") < F.col("high"))).join(lowest.select("host", "part", "n"), ["host", "part"])
    asked = counted.where("leaf < 0").select("host", "part", "sample", F.col("met").alias("asked"))
    counted = counted.where("leaf >= 0").join(asked, ["host", "part", "sample"], "left")
    often = F.when(F.col("inside"), F.col("same") + 1 >= LEAST_SHARE * (F.col("asked") + 2)).otherwise(F.col("met") >= F.least(F.lit(LEAST_PAGES), F.col("n")))
    template = counted.where(often).groupBy("host", "part", "sample").agg(F.collect_list("leaf").alias("leaves"))
    template = template.groupBy("host", "part").agg(F.map_from_entries(F.collect_list(F.struct("sample", "leaves"))).alias("m"))
    known = samples.join(template, ["host", "part"], "left").select("host", "part", "samples", F.transform(F.sequence(F.lit(0), F.size("samples") - 1), lambda k: F.coalesce(F.try_element_at("m", k), F.array().cast("array<int>"))).alias("templates"))
    known = stored(known, "templates")
    shared = spark.sparkContext.broadcast({(r["host"], r["part"]): (r["samples"], r["templates"]) for r in known.collect()}) if small else None
    out = (rows if small else joined(known)).mapInArrow(_extract(shared), f"page_id {kind}, url string, text string")
    return out.select(F.col("page_id").alias(id_col), F.col("url").alias(url_col), "text", F.char_length("text").cast("long").alias("n_chars"))


def op8_page_text(spark, sf_dir: str) -> DataFrame:
    return page_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
