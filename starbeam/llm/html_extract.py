"""Main text of web pages by a site style tree.

1. Each page is parsed to its block elements. An element's presentation is its tag with its class,
   id and role words (digits taken out); its place in the site's style tree is the chain of
   presentations from the root, so equal chains on pages of one host are one tree node.
2. Per host and node the pages are merged: how often each text stands in the node (content), and
   how often each sequence of child presentations does (layout). Counts are added up inside the
   tasks first and then by Spark's partial aggregation, so a host with a third of all pages costs a
   row per distinct value and task.
3. Importance. A content value on k of a node's m pages has entropy log_m k; the content importance
   of a node is one minus the mean entropy of the content in its subtree, so text that every page
   repeats scores 0 and text of one page 1. The layout importance is the entropy of the child
   sequences, -sum p log_m p. Both are combined as (1 - g^l) layout + g^l content for l distinct
   layouts, where g = 0.9, so nodes with one layout are judged by content.
4. Each page is cut: branches whose presentation names furniture (menus, headers, footers, sidebars,
   notices, adverts, forms, comments) go. So do noisy branches, everywhere: those whose node and
   all nodes with text below it have an importance under ``LEAST`` on at least ``PAGES`` pages. In
   articles, headings and the parts of lists and tables go only with the branch around them.
   Headings and inline elements of an article stay whatever their class or id, and slug ids
   ("related-work") name no furniture there. A class names furniture by its last word ("share-prices"
   does not) unless it says that a page has or lacks some ("has-sidebar"). A branch named by class, or
   a form, that holds the page's main element or all its articles with half of its text stays; so does
   a form around the page's headings and half of its text.
5. Of the text that is left (named furniture apart, all text if everything is noisy), the zone is
   the articles if they hold at least half of its characters, else main if that does, else all.

Low-importance nodes travel to the pages by a join on host and salt, so pages of a hot host are
spread; the list per host has at most the nodes of its templates.

Character references are decoded text node by text node, so tags never join halves of one. Scripts,
styles and templates leave nothing between the text around them, other embedded elements a blank.

Defined results: null or empty html gives an empty text; a page of an unparsable url belongs to the
host ''; unclosed elements close at the end, an unclosed tag or comment at the end is dropped;
repeated rows each give a row; null ids are kept; further columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from starbeam.llm import common

PAGES, LEAST, GAMMA, SALTS = 4, 0.2, 0.9, 16
BY_NAME, BY_TAG = 1, 2

#: HTML element classes.
RAW = ("script", "style", "title", "textarea", "noscript", "iframe", "template", "svg", "math", "select", "button", "object", "video", "audio", "canvas", "noframes", "xmp")
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: element -> open elements that its start closes, up to the given borders.
SIBLINGS = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table", "tbody", "thead", "tfoot")), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table"))}
FURNITURE_TAGS = frozenset(("nav", "footer", "aside", "form", "menu", "dialog", "fieldset", "search"))
FORMS = frozenset(("form", "fieldset"))
FURNITURE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs byline-share comment comments commentlist consent cookie cookies copyright disclaimer disqus footer gdpr header hidden login masthead menu menubar modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted promotion recommended related reply replies respond rss share sharing sidebar signup skip social sponsor sponsored subscribe subscription tags teaser toolbar topbar widget widgets alert complementary contentinfo".split()
)
#: Of these the ones that are as often the topic of a paragraph; on a paragraph of an article they name nothing.
TOPIC_WORDS = frozenset("alert banner copyright header hidden login menu recommended related reply replies respond rss share sharing skip social tags".split())
#: First words of classes that say what a page has or lacks.
PREDICATES = frozenset("has have with without no not".split())
#: Words that stand beside furniture words in the id of a furniture element; any other word makes the id a slug.
LAYOUT_WORDS = frozenset(
    "area articles bar block body bottom box button buttons center col column container content div form global group head heading holder icon icons inner item items left link links list lower main message module outer page panel placeholder post posts primary rail region right row secondary section site slot space stories strip text thread title top unit upper wrap wrapper zone".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements whose text many pages of a template share ("Ingredients", column titles) though it belongs to each page's text.
PARTS = HEADINGS | frozenset("hgroup li dt dd caption figcaption legend thead tbody tfoot tr th td".split())

_TOKEN = re.compile(
    r"""<(?:!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*'|["'])*?)(?:>|\Z))""", re.S
)
#: One attribute, values included, so that no name is looked for inside another name or value.
_ATTRIBUTE = re.compile(r"""([^\s/=][^\s/=]*)(?:\s*=\s*(?:"([^"]*)(?:"|\Z)|'([^']*)(?:'|\Z)|([^\s]+)))?""")
#: Raw elements that show nothing, so that the text before and after them is one.
UNSHOWN = frozenset(("script", "style", "title", "noscript", "template", "noframes"))
_RAW_END = {name: re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I) for name in RAW}
_WORDS = re.compile(r"[a-z]+")


@functools.lru_cache(maxsize=1 << 16)
def node_key(parent: int, presentation: str) -> int:
    """Signed 64-bit key of the style-tree node ``presentation`` under ``parent``."""
    return int.from_bytes(hashlib.blake2b(f"{parent} {presentation}".encode(), digest_size=8).digest(), "little", signed=True)


def _class_names(values: str, tag: str, inside: bool) -> set[str]:
    """Furniture words that the class names in ``values`` stand for: the last word decides, "ad-slot" and "nav__item" by a word before it."""
    named: set[str] = set()
    for value in values.split():
        words = _WORDS.findall(value)
        if not words or words[0] in PREDICATES:
            continue
        while len(words) > 1 and words[-1] not in FURNITURE_WORDS and (words[-1] in LAYOUT_WORDS or len(words[-1]) < 3):
            words.pop()
        if words[-1] in FURNITURE_WORDS:
            named.add(words[-1])
    if inside:
        named -= TOPIC_WORDS if tag == "p" else {"header"}
    return named


@functools.lru_cache(maxsize=1 << 16)
def presentation(tag: str, attributes: str, inside: bool = False) -> tuple[str, int, bool]:
    """(presentation, names furniture, is hidden) of an element; ``inside`` an article or main element or not.

    Furniture is ``BY_TAG`` by tag or role, ``BY_NAME`` by class or id or as a form, else 0. A tag or role
    names furniture everywhere, a class on blocks, and outside of articles also on headings and inline
    elements. An id word does on blocks only; where ids are slugs (in articles and
    on sections) every word of the id must be one of furniture or layout.
    """
    values: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(attributes):
        values.setdefault(m.group(1).lower(), (m.group(2) or m.group(3) or m.group(4) or "").lower())
    hidden = "hidden" in values or values.get("aria-hidden") == "true" or bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", values.get("style", "")))
    role, own, by_id = (_WORDS.findall(" ".join(values.get(name, "") for name in names)) for names in (("role",), ("class", "itemprop"), ("id",)))
    text = tag in HEADINGS or tag not in BLOCKS
    named: set[str] = set()
    if not (text and inside):
        named.update(_class_names(f"{values.get('class', '')} {values.get('itemprop', '')}", tag, inside))
    if not text and not ((inside or tag in ("section", "article")) and not FURNITURE_WORDS.union(LAYOUT_WORDS).issuperset(by_id)):
        named.update(by_id)
    furniture = 0
    if tag not in ("html", "body", "main", "article") or "comment" in named:
        furniture = BY_TAG if not FURNITURE_WORDS.isdisjoint(role) else BY_NAME if not FURNITURE_WORDS.isdisjoint(named) else 0
    if tag in FURNITURE_TAGS:
        furniture = max(furniture, BY_NAME if tag in FORMS else BY_TAG)
    words = {*role, *own, *by_id}
    return f"{tag}.{'.'.join(sorted(words))}" if words else tag, furniture, hidden


class Page:
    """Block elements of a page in order, as parallel lists; ``blocks`` are (element, text)."""

    __slots__ = ("keys", "parents", "tags", "labels", "furniture", "inside", "blocks")

    def __init__(self, source: str):
        self.keys, self.parents, self.tags, self.labels, self.furniture, self.inside, self.blocks = [0], [-1], [""], [""], [0], [False], []
        # pieces of the line that each open element has so far: an inline element does not end the line around it
        stack, lines, n = [0], [[]], len(source)

        def flush(down_to: int = 0) -> None:
            first = len(stack) - 1
            while first > down_to and self.tags[stack[first]] not in BLOCKS:
                first -= 1
            for k in range(first, len(stack)):
                if lines[k]:
                    joined = " ".join("".join(lines[k]).split())
                    lines[k].clear()
                    if joined:
                        self.blocks.append((stack[k], joined))

        def close(down_to: int) -> None:
            inline = all(self.tags[i] not in BLOCKS for i in stack[down_to:])
            flush(down_to if inline else 0)
            del stack[down_to:], lines[down_to:]

        position = 0
        while position < n:
            m = _TOKEN.search(source, position)
            if m is None:
                lines[-1].append(html.unescape(source[position:]))
                break
            if m.start() > position:
                lines[-1].append(html.unescape(source[position : m.start()]))
            position = m.end()
            if m.group(2) is None:
                continue
            tag = m.group(2).lower()
            if m.group(1):
                if tag in BLOCKS:
                    for k in range(len(stack) - 1, 0, -1):
                        if self.tags[stack[k]] == tag:
                            close(k)
                            break
                elif tag not in VOID:
                    for k in range(len(stack) - 1, 0, -1):
                        if self.tags[stack[k]] == tag:
                            close(k)
                            break
                        if self.tags[stack[k]] in BLOCKS:
                            break
                continue
            attributes = m.group(3)
            if tag in _RAW_END:
                if not attributes.rstrip().endswith("/") or tag not in ("svg", "math"):
                    end = _RAW_END[tag].search(source, position)
                    position = end.end() if end else n
                if tag not in UNSHOWN:
                    lines[-1].append(" ")
                continue
            if tag in VOID:
                if tag in ("br", "hr"):
                    lines[-1].append(" ")
                if tag != "hr":
                    continue
            block = tag in BLOCKS
            if block:
                self._close_before(tag, stack, close)
                flush()
            if tag in VOID:
                continue
            parent = stack[-1]
            inside = self.inside[parent]
            label, furniture, hidden = presentation(tag, attributes, inside)
            if not block and not furniture and not hidden:
                continue
            self.keys.append(node_key(self.keys[parent], label))
            self.parents.append(parent)
            self.tags.append(tag)
            self.labels.append(label)
            self.furniture.append(BY_TAG if hidden or tag == "header" and not inside else furniture)
            self.inside.append(inside or tag in ("article", "main"))
            stack.append(len(self.keys) - 1)
            lines.append([])
        flush()

    def _close_before(self, tag: str, stack: list[int], close) -> None:
        for k in range(len(stack) - 1, 0, -1):
            open_tag = self.tags[stack[k]]
            if open_tag == "p":
                close(k)
                break
            if open_tag in BLOCKS:
                break
        if tag in SIBLINGS:
            ends, borders = SIBLINGS[tag]
            for k in range(len(stack) - 1, 0, -1):
                if self.tags[stack[k]] in borders:
                    break
                if self.tags[stack[k]] in ends.split():
                    close(k)
                    break

    def _cut(self) -> list[bool]:
        """Is the element furniture? One named by class or a form is not if it holds the page's main text (see 4. above)."""
        n = len(self.keys)
        sizes, articles, mains, headings = [0] * n, [0] * n, [0] * n, [0] * n
        for i, t in self.blocks:
            sizes[i] += len(t)
        for i in range(n - 1, -1, -1):
            if not self.furniture[i]:
                articles[i] += self.tags[i] == "article"
                mains[i] += self.tags[i] == "main"
                headings[i] += self.tags[i] == "h1"
            if i and self.furniture[i] != BY_TAG:
                for own in (sizes, articles, mains, headings):
                    own[self.parents[i]] += own[i]

        def holds(i: int) -> bool:
            half = 2 * sizes[i] >= sizes[0]
            if mains[i] or half and articles[i] and articles[i] == articles[0]:
                return True
            return half and self.tags[i] in FORMS and headings[i] > 0 and headings[i] == headings[0] and not articles[0] + mains[0]

        return [f == BY_TAG or f == BY_NAME and not holds(i) for i, f in enumerate(self.furniture)]

    def text(self, low: frozenset[int] = frozenset()) -> str:
        """The text of the branches that stay, in the zone that holds most of it."""
        n = len(self.keys)
        furniture = self._cut()
        filled, keeps, noisy = [False] * n, [False] * n, [False] * n
        for i, _ in self.blocks:
            filled[i] = True
        for i in range(n - 1, 0, -1):
            noisy[i] = self.keys[i] in low and not keeps[i]
            if filled[i] and not furniture[i]:
                filled[self.parents[i]] = True
                keeps[self.parents[i]] |= not noisy[i]
        gone, weak, zones = [False] * n, [False] * n, {"article": [False] * n, "main": [False] * n}
        for i in range(1, n):
            p = self.parents[i]
            gone[i] = gone[p] or furniture[i]
            weak[i] = weak[p] or noisy[i] and not (self.inside[i] and self.tags[i] in PARTS)
            for name, zone in zones.items():
                zone[i] = zone[p] or self.tags[i] == name
        left = [(i, t) for i, t in self.blocks if not gone[i]]
        left = [(i, t) for i, t in left if not weak[i]] or left
        for zone in zones.values():
            own = [t for i, t in left if zone[i]]
            if own and 2 * sum(map(len, own)) >= sum(len(t) for _, t in left):
                return "\n".join(own)
        return "\n".join(t for _, t in left)


def _value(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)


def observations(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """(host, node, above, kind, value, n): contents and layouts per style-tree node, counted per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        above: dict[int, list[int]] = {}

        def out() -> Iterator[pa.RecordBatch]:
            rows = list(counts.items())
            for i in range(0, len(rows), 1 << 13):
                part = rows[i : i + (1 << 13)]
                yield pa.record_batch({
                    "host": pa.array([k[0] for k, _ in part], pa.string()),
                    "node": pa.array([k[1] for k, _ in part], pa.int64()),
                    "above": pa.array([above[k[1]] for k, _ in part], pa.list_(pa.int64())),
                    "kind": pa.array([k[2] for k, _ in part], pa.int32()),
                    "value": pa.array([k[3] for k, _ in part], pa.int64()),
                    "n": pa.array([v for _, v in part], pa.int64()),
                })
            counts.clear()
            above.clear()

        for batch in batches:
            for host, source in zip(batch.column("host").to_pylist(), batch.column(html_col).to_pylist()):
                page = Page(source or "")
                children: list[list[str]] = [[] for _ in page.keys]
                for i in range(1, len(page.keys)):
                    children[page.parents[i]].append(page.labels[i])
                seen = set()
                for i, own in enumerate(children):
                    seen.add((i, 0, _value(" ".join(own))))  # of elements without children too: it counts the node's pages
                seen.update((i, 1, _value(t)) for i, t in page.blocks)
                for i, kind, value in {(page.keys[i], k, v): (i, k, v) for i, k, v in seen}.values():
                    key = page.keys[i]
                    counts[(host, key, kind, value)] += 1
                    if key not in above:
                        chain = []
                        while i > 0:
                            chain.append(page.keys[i])
                            i = page.parents[i]
                        above[key] = chain
            if len(counts) > 200_000:
                yield from out()
        yield from out()

    return common.map_arrow(pages.select("host", html_col), run, "host string, node long, above array<long>, kind int, value long, n long")


def importance(seen: DataFrame) -> DataFrame:
    """(host, node, pages, importance) from the observations."""
    value = seen.groupBy("host", "node", "kind", "value").agg(F.sum("n").alias("n"), F.first("above").alias("above"))
    node = value.groupBy("host", "node", "kind").agg(
        F.first("above").alias("above"), F.sum("n").alias("n"), F.sum(F.col("n") * F.log("n")).alias("nlogn"), F.count(F.lit(1)).alias("values"), F.max("n").alias("most")
    )
    # a node's own layouts; the contents of its whole subtree
    layout = node.where("kind = 0").select("host", "node", F.col("n").alias("pages"), (F.log("n") - F.col("nlogn") / F.col("n")).alias("spread"), "values")
    content = (
        node.where("kind = 1")
        .select("host", F.explode("above").alias("node"), "n", "nlogn", "most")
        .groupBy("host", "node")
        .agg(F.sum("n").alias("texts"), F.sum("nlogn").alias("nlogn"), F.max("most").alias("most"))
    )
    joined = content.join(layout, ["host", "node"], "left")
    pages = F.greatest(F.coalesce("pages", F.lit(0)), "most", F.lit(2))
    own = F.lit(1.0) - F.least(F.lit(1.0), F.col("nlogn") / F.col("texts") / F.log(pages))
    weight = F.when(F.col("values") > 1, F.pow(F.lit(GAMMA), F.col("values"))).otherwise(F.lit(1.0))
    spread = F.coalesce(F.col("spread") / F.log(pages), F.lit(0.0))
    return joined.select("host", "node", pages.cast("long").alias("pages"), ((F.lit(1.0) - weight) * spread + weight * own).alias("importance"))


def with_host(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    salt = F.pmod(F.xxhash64(F.col(id_col), F.col(url_col)), F.lit(SALTS)).cast("int")
    return pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host.alias("host"), salt.alias("salt"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: float = LEAST, support: int = PAGES) -> DataFrame:
    """Per page: ``page_id``, ``url``, ``text`` and ``n_chars`` (code points)."""
    source = with_host(pages, id_col, url_col, html_col)
    weak = importance(observations(source)).where((F.col("pages") >= support) & (F.col("importance") < least))
    low = common.written(weak.groupBy("host").agg(F.collect_list("node").alias("low")))
    spread = low.select(F.col("host").alias("low_host"), "low", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("low_salt"))
    rows = source.join(spread, (F.col("host") == F.col("low_host")) & (F.col("salt") == F.col("low_salt")), "left").select("page_id", "url", "html", "low")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lows: dict[tuple, frozenset[int]] = {}
            texts = []
            for source, own in zip(batch.column("html").to_pylist(), batch.column("low").to_pylist()):
                key = tuple(own or ())
                if key not in lows:
                    lows[key] = frozenset(key)
                texts.append(Page(source or "").text(lows[key]))
            yield pa.record_batch([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    schema = T.StructType([T.StructField("page_id", source.schema["page_id"].dataType), T.StructField("url", T.StringType()), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return common.map_arrow(rows, run, schema)
