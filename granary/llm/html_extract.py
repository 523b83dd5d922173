"""Main text of web pages through a site style tree.

The DOMs of a host's pages are merged to one tree. Its element nodes are the
chains of block elements (tag and class) that occur; below an element node are
its presentation styles, the sequences of children it was seen with (repeats
of a child taken together), and its contents, the distinct texts.

* A content's importance is 1 - log(pages with it) / log(pages with the node +
  sqrt(pages of the host)): 1 for what one page says, near 0 for what all say.
  The root stands for pages not seen: the smaller the part of the host that
  has the node, and the fewer pages the host has, the more must agree. The
  contents of a node together are a leaf, as important as they are on average.
* A node's presentation importance is the entropy of its styles, to the base
  of the pages that have it, and 1 for a node of one page.
* The composite importance of a node with l styles is (1 - GAMMA^l) x its
  presentation importance + GAMMA^l x the mean over its children and its leaf,
  weighted by the pages that have them.

A branch is noise if its composite importance and that of everything below it
is low; it is cut from each page, as are single contents of low importance and
elements whose tag, role or class says that they are furniture. Equal pages of
a host count as one page.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.runtime import stage

# Elements by kind.
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html"
    " legend li main menu nav ol option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
FURNITURE = frozenset("nav footer aside form head menu dialog button select option template svg canvas audio video object map search datalist".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog alertdialog menu menubar toolbar".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adbox adslot sponsor sponsored promo promos promotion banner nav navbar navigation menu breadcrumb breadcrumbs sidebar side"
    " footer masthead cookie cookies consent gdpr notice notices popup modal newsletter subscribe signup login share sharing social comment comments disqus reply replies"
    " respond discussion related recommended pagination pager widget widgets toolbar copyright legal alert overlay".split()
)
#: Parts of a class that say where or what shape an element is; they do not change what the other parts say.
NEUTRAL = frozenset(
    "site page global main primary secondary top bottom left right inner outer box bar block container wrapper wrap area region zone list item items section group row col column content body text title"
    " heading header message label buttons button btn links link icons icon panel form slot unit space js is has the of and count policy bars trail tools posts articles stories".split()
)
HEADER_NAMES = frozenset("header topbar hero".split())
COMMENT_NAMES = frozenset("comment comments reply replies".split())
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
}

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?][^>]*>""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[^\W\d_]+")

#: Importance below which a branch goes: outside and inside an article or main element.
NOISE_OUTSIDE, NOISE_INSIDE = 0.4, 0.15

#: Where a text stands: in neither, in main, in an article, in an article inside main.
NOWHERE, MAIN, ARTICLE, BOTH = 0, 1, 2, 3
#: Share of a main element's text from which its articles are taken for all of it.
MOST = 0.5
GAMMA = 0.9
#: Separator of path labels; it sorts before all that labels hold.
SEP = "\x01"


def _says(names: str, words: frozenset[str]) -> bool:
    """Whether a whole name among classes and ids is one of the words, up to neutral parts and numbers."""
    for name in names.split():
        parts = [x.lower() for x in NAME_PARTS.findall(name)]
        if any(x in words for x in parts) and all(x in words or x in NEUTRAL for x in parts):
            return True
    return False


def _furniture(tag: str, attributes: str, in_main: bool) -> tuple[bool, str]:
    """(is the element furniture, its class for the path)"""
    if tag in FURNITURE or (tag == "header" and not in_main):
        return True, ""
    if not attributes or attributes.isspace():
        return False, ""
    a = {k.lower(): entities.unescape(v.strip("\"'")) for k, v in ATTRIBUTE.findall(attributes)}
    style = a.get("class", "")
    if "hidden" in a or a.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", a.get("style", ""), re.I):
        return True, style
    if a.get("role", "").lower() in ROLES:
        return True, style
    names = f"{style} {a.get('id', '')}"
    if tag in ("body", "html", "article", "main"):  # their classes describe the page, but for a comment's article
        return tag == "article" and _says(names, COMMENT_NAMES), style
    return _says(names, NAMES) or (not in_main and _says(names, HEADER_NAMES)), style


def blocks(page: str, styles: dict[str, list[str]] | None = None) -> list[tuple[str, int, str]]:
    """(path, where, text) of each block of text outside furniture, in page order.

    styles takes the children of each path outside furniture: block elements
    by label, text by an empty one, a run of equal children once.
    """
    out: list[tuple[str, int, str]] = []
    stack: list[tuple[str, bool, int, str]] = []  # tag, furniture, where, path
    held: list[str] = []
    state = (False, NOWHERE, "")
    owner: tuple[bool, int, str] | None = None  # state at the block's first text outside furniture

    def take(text: str) -> None:
        nonlocal owner
        if state[0]:
            text = " "  # inline furniture still parts the words around it
        elif owner is None:
            owner = state
        held.append(text)

    def child(path: str, label: str) -> None:
        if styles is not None:
            seen = styles.setdefault(path, [])
            if not seen or seen[-1] != label:
                seen.append(label)

    def flush() -> None:
        nonlocal owner
        if owner:
            text = " ".join(entities.unescape("".join(held)).split())
            if text:
                out.append((owner[2], owner[1], text))
                child(owner[2], "")
        held.clear()
        owner = None

    def drop(n: int) -> None:
        nonlocal state
        if any(t[0] in BLOCK for t in stack[n:]):
            flush()
        del stack[n:]
        state = stack[-1][1:] if stack else (False, NOWHERE, "")

    at, end = 0, len(page)
    while at < end:
        m = TOKEN.search(page, at)
        text = page[at : m.start() if m else end]
        if text:
            take(text)
        if m is None:
            break
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            if m[0].startswith("<![CDATA["):
                take(entities.escape(m[0][9:-3]))
            continue
        if m[1] or m[4]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    drop(i)
                    break
            else:
                if tag in BLOCK:
                    flush()
            continue
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
            at = close.start() if close else end
            if close:
                at = page.find(">", at) + 1 or end
            continue
        if tag == "br":
            take(" ")
            continue
        if tag in BLOCK:
            flush()
            if tag in CLOSES:
                ends, stops = CLOSES[tag]
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in stops:
                        break
                    if stack[i][0] in ends:
                        drop(i)
                        break
            else:
                for i in range(len(stack) - 1, -1, -1):  # a block ends an open paragraph
                    if stack[i][0] == "p":
                        drop(i)
                        break
                    if stack[i][0] in BLOCK:
                        break
        attributes = m[3] or m[6] or ""
        if tag in VOID:
            continue
        noise, where, path = state
        bad, style = _furniture(tag, attributes, where > NOWHERE)
        if tag == "article":
            where |= ARTICLE
        elif tag == "main" or 'role="main"' in attributes:
            where |= MAIN
        if tag in BLOCK:
            label = tag + ("." + ".".join(style.split()) if style else "")
            if not (noise or bad):
                child(path, label)
            path = f"{path}{SEP}{label}"
        state = (noise or bad, where, path)
        stack.append((tag, *state))
    flush()
    return out


def _hash(x: str) -> int:
    from xxhash import xxh64_intdigest

    return (xxh64_intdigest(x.encode("utf-8", "surrogatepass")) >> 1) or 1


def _host_of(url: Column) -> Column:
    """The host of a url, lower case; empty without one."""
    return F.lower(F.regexp_replace(F.regexp_extract(F.coalesce(url, F.lit("")), "^\\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1), "^.*@", ""))


def _content(path: str, text: str) -> int:
    return _hash(f"{path}\0{text}")


def _seen(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """(host, path, style, content, pages): how many pages of a host have a path (style and content
    0), a path in a style, and a path with a content; the host itself is the path null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["host", "path", "style", "content"]
        kinds = [pa.string(), pa.string(), pa.int64(), pa.int64()]

        def rows(seen: dict) -> pa.RecordBatch:
            columns = list(zip(*seen, strict=True)) or [()] * 4
            out = pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(columns, kinds, strict=True)), pa.array(list(seen.values()), pa.float64())], names=[*names, "pages"])
            seen.clear()
            return out

        seen: dict[tuple, float] = {}
        for b in batches:
            for host, page, rows_of_page in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                styles: dict[str, list[str]] = {}
                on = {(host, None, 0, 0)}
                for path, _, text in blocks(page or "", styles):
                    on.add((host, path, 0, _content(path, text)))
                for path, children in styles.items():
                    on.add((host, path, 0, 0))
                    on.add((host, path, _hash(SEP.join(children)), 0))
                for k in on:
                    seen[k] = seen.get(k, 0) + 1 / rows_of_page
                if len(seen) > 50_000:
                    yield rows(seen)
        yield rows(seen)

    # Equal pages share the weight of one. The table of such pages is written, so that a small one is known to be small and no page is shuffled.
    keyed = pages.select(_host_of(F.col(url_col)).alias("h"), F.col(html_col).alias("html"), F.xxhash64(F.col(html_col)).alias("k"))
    copies = stage(keyed.groupBy("h", "k").agg(F.count("*").alias("n")).where("n > 1"), "site-copies")
    seen = keyed.join(copies, ["h", "k"], "left").select("h", "html", F.coalesce("n", F.lit(1)).alias("n")).mapInArrow(run, "host string, path string, style long, content long, pages double")
    return stage(seen.groupBy("host", "path", "style", "content").agg(F.round(F.sum("pages"), 3).alias("pages")), "site-counts")


def composite(nodes: Iterator[tuple[str, float, int, float, float | None]]) -> Iterator[tuple[str, float, bool]]:
    """(path, composite importance, the highest one of its branch) of a tree.

    nodes are (path, pages, styles, presentation importance, importance of the
    contents or null) in order of paths, so that a node's descendants follow
    it; only the nodes above the current one are held.
    """
    open_: list[list] = []  # path, pages, styles, presentation, weight of children, weighted importance, highest below

    def close() -> tuple[str, float, float]:
        path, pages, styles, shown, weight, total, highest = open_.pop()
        keep = GAMMA**styles if weight else 0.0
        value = (1 - keep) * shown + (keep * total / weight if weight else 0.0)
        highest = max(highest, value)
        if open_:
            above = open_[-1]
            above[4] += pages
            above[5] += pages * value
            above[6] = max(above[6], highest)
        return path, value, highest

    for path, pages, styles, shown, leaf in nodes:
        while open_ and not path.startswith(open_[-1][0] + SEP):
            yield close()
        open_.append([path, pages, styles, shown, pages if leaf is not None else 0.0, pages * leaf if leaf is not None else 0.0, -1.0 if leaf is None else leaf])
    while open_:
        yield close()


def site_nodes(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """(host, outside, inside): hashes of the branches and of the contents to cut outside and inside the main element."""
    counts = _seen(pages, url_col, html_col)
    p = F.col("pages")
    is_style, is_content = F.col("style") != 0, F.col("content") != 0
    whole = F.max(F.when(~is_style & ~is_content, p))
    # The entropy of the styles from sums: -sum(x/t log(x/t)) = log t - sum(x log x)/t.
    t, xlogx = F.sum(F.when(is_style, p)), F.sum(F.when(is_style, p * F.log(p)))
    nodes = counts.where("path IS NOT NULL").groupBy("host", "path").agg(
        whole.alias("m"), F.count(F.when(is_style, 1)).alias("styles"), (F.log(t) - xlogx / t).alias("entropy"), F.avg(F.when(is_content, F.log(p))).alias("shared")
    )
    hosts = counts.where("path IS NULL").select("host", F.col("pages").alias("n"))
    nodes = nodes.join(hosts, "host").withColumn("whole", F.log(F.col("m") + F.sqrt("n")))
    shown = F.when(F.col("m") > 1, F.least(F.col("entropy") / F.log("m"), F.lit(1.0))).otherwise(1.0)
    nodes = stage(nodes.select("host", "path", "m", "whole", F.col("styles").cast("int").alias("styles"), F.coalesce(shown, F.lit(0.0)).alias("shown"), (1 - F.col("shared") / F.col("whole")).alias("leaf")), "site-tree")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from itertools import groupby

        def flat() -> Iterator[tuple]:
            for b in batches:
                yield from zip(*(b.column(k).to_pylist() for k in range(6)), strict=True)

        def write(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.float64())], names=["host", "cut", "importance"])

        held: list[tuple] = []
        for host, rows in groupby(flat(), key=lambda r: r[0]):
            for path, _, highest in composite(r[1:] for r in rows):
                if highest < NOISE_OUTSIDE:
                    held.append((host, _hash(path), highest))
                if len(held) >= 10_000:
                    yield write(held)
                    held = []
        yield write(held)

    # Paths of a host, not pages or contents, come to one task, and stream through it.
    tree = nodes.select("host", "path", "m", "styles", "shown", "leaf").repartition("host").sortWithinPartitions("host", "path")
    branches = tree.mapInArrow(run, "host string, cut long, importance double")
    # A content of one page has importance 1.
    contents = counts.where("content <> 0 AND pages > 1").join(nodes, ["host", "path"]).select("host", F.col("content").alias("cut"), (1 - F.log("pages") / F.col("whole")).alias("importance"))
    # Text of a node that has children too is a leaf of its own.
    leaves = nodes.where("leaf IS NOT NULL").select("host", "path", F.col("leaf").alias("importance")).where(F.col("importance") < NOISE_OUTSIDE)

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([_leaf(x) for x in b.column(1).to_pylist()], pa.int64()), b.column(2)], names=["host", "cut", "importance"])

    leaves = leaves.select("host", "path", "importance").mapInArrow(name, "host string, cut long, importance double")
    low = branches.unionByName(leaves).unionByName(contents).where(F.col("importance") < NOISE_OUTSIDE)
    inside = F.when(F.col("importance") < NOISE_INSIDE, F.col("cut"))
    return low.groupBy("host").agg(F.collect_list("cut").alias("outside"), F.collect_list(inside).alias("inside"))


def _leaf(path: str) -> int:
    return _hash(f"{path}{SEP}")


def main_text(page: str | None, outside: set[int], inside: set[int]) -> str:
    found = blocks(page or "")
    size = [0, 0, 0, 0]
    for _, where, text in found:
        size[where] += len(text)
    if size[BOTH] >= MOST * (size[MAIN] + size[BOTH]) > 0:
        wanted = (BOTH,)
    elif size[MAIN] + size[BOTH]:
        wanted = (MAIN, BOTH)
    else:
        wanted = (ARTICLE,) if size[ARTICLE] else (NOWHERE,)
    cut = outside if wanted == (NOWHERE,) else inside
    low: dict[str, bool] = {}

    def noise(path: str) -> bool:
        if path not in low:
            low[path] = _leaf(path) in cut or any(_hash(path[:i]) in cut for i in range(1, len(path) + 1) if i == len(path) or path[i] == SEP)
        return low[path]

    return " ".join(text for path, where, text in found if where in wanted and not (cut and (noise(path) or _content(path, text) in cut)))


def extract_main(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id_col, url_col, text, n_chars) per row.

    Text is that of the main element where a page has one (of the articles in
    it, if they hold most of it), else of article, else of the whole body,
    without furniture and without the branches and contents that the site
    style tree of its host finds to be noise. Null html gives empty text;
    pages without a host in their url share one tree. Broken markup is read
    as far as it goes, and very long pages are read whole, one at a time.
    Repeated rows are extracted each; an empty table gives an empty result.
    Columns other than id, url and html are not read.
    """
    host = _host_of(F.col(url_col))
    nodes = stage(site_nodes(pages, url_col, html_col), "site-nodes")
    kind = pages.schema[id_col].dataType.simpleString()
    joined = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host.alias("host")).join(nodes, "host", "left").select("id", "url", "html", "outside", "inside")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(page, set(o or ()), set(i or ())) for page, o, i in zip(*(b.column(k).to_pylist() for k in (2, 3, 4)), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], names=["id", "url", "text", "n_chars"])

    return joined.mapInArrow(run, f"id {kind}, url string, text string, n_chars long").withColumnsRenamed({"id": id_col, "url": url_col})
