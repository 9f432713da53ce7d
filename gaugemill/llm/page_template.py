"""Main text of web pages by equivalence classes of same-host tokens.

1. *Tokens.*  A page is a sequence of tokens: structural tags and texts, each with the path
   of elements it stands in, so that equal strings in different places differ.
2. *Occurrence vectors.*  For every host and token, how often it occurs on each page.  A
   vector is never gathered: sums of hashes of (page, count) stand for it, which Spark
   adds up in parts, so a host with a third of all pages is no single task's work.
3. *Classes.*  Tokens of a host with the same vector form an equivalence class.  Those of
   at least MIN_TOKENS tokens on MIN_PAGES pages and on more than half of the pages of the
   host's largest class are candidates for the template.  Exact copies of a page count once.
4. *Order and nesting.*  The largest class is the outer one; its elements cut a page into
   gaps.  A token stays in the template if it first occurs in the same gap, behind the same
   outer elements, of every page it is on: tokens of the outer class then follow each other
   in one order, and those of a class on fewer pages are nested between two of them.
5. *Slots.*  What stands between template tokens is a slot.  If the template has an article
   or main element, the content slots of every page that has this element are those inside
   it; otherwise, all that are not in an element that says it holds something else.  Texts
   that are tokens of the template are no slots.  Only where they are more than half of an
   article's texts they stay: such pages are near copies, not one template filled in several ways.

A host with too few pages has no template; its pages, and pages without the element that
holds their host's content, are read by their own elements.  What a page says of itself
(nav, footer, forms, an element's class or role) is left out in either case.

Defined results: a null html is empty and gives empty text; unclosed or stray tags, cut
pages and bad references are read as browsers read them; a null url belongs to a host of
its own; repeated rows are returned as often as they come; other columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from gaugemill.llm.common import arrow_slices, materialize
from gaugemill.session import discard

MIN_PAGES = 3
MIN_TOKENS = 2
FRAME_SHARE = 0.5
# Templates of so many tokens in all are broadcast; each is a few numbers.
BROADCAST_TOKENS = 500_000

# HTML's element kinds.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li "
    "main menu nav noscript ol optgroup option p pre search section select summary table tbody td "
    "template tfoot th thead tr ul button svg".split()
)
VOID = frozenset("hr br img input meta link area base col embed source track wbr".split())
CLOSES_P = BLOCKS - frozenset("td th tr tbody thead tfoot caption option optgroup html head body button".split())
P_SCOPE = frozenset("td th table caption html body button template object".split())
SAME_CLOSES = {
    "li": frozenset(("ul", "ol", "menu")), "dd": frozenset(("dl",)), "dt": frozenset(("dl",)),
    "tr": frozenset(("table",)), "td": frozenset(("table", "tr")), "th": frozenset(("table", "tr")),
    "option": frozenset(("select",)),
}

# Elements and names that say they hold no article text.
OTHER = frozenset(
    "head nav header footer aside form noscript template button select option svg dialog menu search".split()
)
CONTENT = frozenset(("article", "main"))
# Kinds of tokens: a text, an element, an article or main element.
TEXT, ELEMENT, ROOT = range(3)
OTHER_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|banner|promos?|promotion|sponsor(?:ed|s)?|"
    r"cookies?|consent|gdpr|notice|notices|newsletter|subscribe|sidebar|menu|nav|navbar|navigation|"
    r"breadcrumbs?|footer|header|masthead|comments?|commentlist|disqus|replies|related|share|sharing|"
    r"social|popup|modal|widget|pagination|contentinfo|complementary|dialog|alert|search)(?:$|[\s_-])",
    re.IGNORECASE,
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)|[^<]+|<",
    re.DOTALL,
)
_NAMING = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)


@dataclass
class Open:
    """An open element: its path so far, whether it says it holds other things, and the
    paths of the article and main elements it stands in."""

    name: str
    path: int
    other: bool
    roots: tuple[int, ...]


@dataclass
class Page:
    """Tokens by count, in the order they first occur, their kinds, and blocks of text:
    (text, token, paths of the articles around it, elsewhere by its own words)."""

    tokens: Counter
    kinds: dict[int, int]
    blocks: list[tuple[str, int, tuple[int, ...], bool]]
    roots: set[int]


@dataclass
class Template:
    """Tokens of a host's template, and those of them that are its content elements."""

    tokens: frozenset[int] = frozenset()
    content: frozenset[int] = frozenset()


def _hash(text: str, path: int) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(text.encode("utf-8", "surrogatepass"), path)


def parse(html: str | None) -> Page:
    """One pass over a page; work is linear in its length."""
    page = Page(Counter(), {}, [], set())
    stack = [Open("", 0, False, ())]
    held: list[str] = []
    open_names: Counter[str] = Counter()

    def flush() -> None:
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            top = stack[-1]
            token = _hash(text, top.path)
            page.blocks.append((text, token, top.roots, top.other))
            page.tokens[token] += 1

    def close(until: int) -> None:
        flush()
        while len(stack) > until:
            gone = stack.pop()
            open_names[gone.name] -= 1

    def close_open(name: str, scope: frozenset) -> None:
        if open_names[name] > 0:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == name:
                    close(i)
                    return
                if stack[i].name in scope:
                    return

    html = html or ""
    at, end = 0, len(html)
    while at < end:
        m = _TOKEN.match(html, at)
        at = m.end()
        name = m[2]
        if name is None:
            if not m[0].startswith(("<!", "<?")):
                held.append(unescape(m[0]))
            continue
        name = name.lower()
        if m[1]:
            if name == "br":
                held.append(" ")
            elif open_names[name] > 0:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].name == name:
                        close(i)
                        break
            elif name in BLOCKS:
                flush()
            continue
        if name in RAW:
            stop = re.compile(f"</{name}(?=[\\s/>])", re.IGNORECASE).search(html, at)
            at = stop.start() if stop else end
            continue
        if name == "br":
            held.append(" ")
            continue
        block = name in BLOCKS
        names = " ".join("".join(x) for x in _NAMING.findall(m[3])) if m[3] else ""
        says_other = name in OTHER or (
            name not in CONTENT and name not in ("html", "body") and bool(names)
            and OTHER_NAMES.search(names) is not None
        )
        if not block and not says_other or name in VOID:
            if block:
                flush()
            continue
        flush()
        if name in CLOSES_P:
            close_open("p", P_SCOPE)
        if name in SAME_CLOSES:
            close_open(name, SAME_CLOSES[name])
        up = stack[-1]
        here = Open(name, _hash(f"<{name} {names}>", up.path), up.other or says_other, up.roots)
        kind = ELEMENT
        if name in CONTENT:
            here.roots += (here.path,)
            if not here.other:
                kind = ROOT
                page.roots.add(here.path)
        stack.append(here)
        open_names[name] += 1
        page.tokens[here.path] += 1
        page.kinds[here.path] = kind
        if m[3].rstrip().endswith("/") and name == "svg":
            close(len(stack) - 1)
    flush()
    return page


def host(url: Column) -> Column:
    """Host of a url in lower case; null for a null url."""
    return F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _numbered(pages: DataFrame) -> DataFrame:
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
        F.xxhash64(host(F.col("url")), F.col("url").isNull()).alias("host"),
    )


def _signed(token: int) -> int:
    return token - (1 << 64) if token >> 63 else token


def token_counts(pages: DataFrame) -> DataFrame:
    """(host, page, token, n, kind, at): how often and where first a token occurs on a page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrow_slices(batch, "html"):
                columns = [[] for _ in range(6)]
                hosts, ids, tokens, counts, kinds, places = columns
                for site, page_id, html in zip(*(part.column(i).to_pylist() for i in range(3))):
                    page = parse(html)
                    found = page.tokens
                    hosts.extend([site] * len(found))
                    ids.extend([page_id] * len(found))
                    tokens.extend(map(_signed, found))
                    counts.extend(found.values())
                    kinds.extend(page.kinds.get(t, TEXT) for t in found)
                    places.extend(range(len(found)))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    names = ["host", "page", "token", "n", "kind", "at"]
    # Copies of a page are one page: they tell nothing of what a template leaves open.
    narrow = _numbered(pages).select("host", F.xxhash64("html").alias("page"), "html")
    every = narrow.mapInArrow(run, ", ".join(f"{c} long" for c in names))
    return every.groupBy("host", "page", "token").agg(*[F.min(c).alias(c) for c in names[3:]])


def equivalence_classes(counts: DataFrame) -> DataFrame:
    """(host, token, kind, pages, total, vector, tokens): tokens with their valid class and its size."""
    # Three order-free sums stand for a vector: two tokens share all three only if they
    # occur equally often on the same pages (or by a chance of about 2**-64).
    mark = F.xxhash64("page", "n")
    vectors = counts.groupBy("host", "token").agg(
        F.max("kind").alias("kind"), F.count(F.lit(1)).alias("pages"), F.sum("n").alias("total"),
        F.bit_xor(mark).alias("vector"),
    ).filter(F.col("pages") >= MIN_PAGES)
    named = ["host", "pages", "total", "vector"]
    sizes = vectors.groupBy(*named).agg(F.count(F.lit(1)).alias("tokens"))
    return vectors.join(sizes.filter(F.col("tokens") >= MIN_TOKENS), named)


def frames(classes: DataFrame) -> DataFrame:
    """(host, token, kind, outer): tokens of the classes on most pages of each host; ``outer``
    are elements of its largest class."""
    key = F.struct("pages", "tokens", "total", "vector")
    largest = classes.groupBy("host").agg(F.max(key).alias("largest"))
    return classes.join(largest, "host").filter(
        F.col("pages") > FRAME_SHARE * F.col("largest.pages")
    ).select("host", "token", "kind", ((F.col("kind") > TEXT) & (key == F.col("largest"))).alias("outer"))


def nested(counts: DataFrame, frame: DataFrame) -> DataFrame:
    """(host, token, kind) of the tokens that lie in the same gap on all their pages.

    A gap is named by the hashes of all outer elements before it, so what stands in an
    element that moves about moves with it.  A page's tokens are one window.
    """
    before = Window.partitionBy("host", "page").orderBy("at").rowsBetween(
        Window.unboundedPreceding, -1)
    gap = F.bit_xor(F.when(F.col("outer"), F.xxhash64("token"))).over(before)
    met = counts.select("host", "page", "token", "at").join(frame, ["host", "token"])
    return met.withColumn("gap", F.coalesce(gap, F.lit(0))).groupBy("host", "token").agg(
        F.max("kind").alias("kind"), (F.min("gap") == F.max("gap")).alias("one")
    ).filter("one").drop("one")


def templates(pages: DataFrame) -> DataFrame:
    """(host, frame, content): the tokens of each host's template, and its content elements."""
    counts = materialize(token_counts(pages), "tokens")
    frame = materialize(frames(equivalence_classes(counts)), "frames")
    side = F.broadcast(frame) if frame.count() <= BROADCAST_TOKENS else frame
    known = materialize(nested(counts, side).groupBy("host").agg(
        F.collect_list("token").alias("frame"),
        F.collect_list(F.when(F.col("kind") == ROOT, F.col("token"))).alias("content"),
    ), "templates")
    discard(counts)
    return known


def slots(page: Page, template: Template) -> list[str]:
    """Texts of the content slots of a page, in order."""
    if roots := template.content & page.roots:
        inside = [(text, token) for text, token, around, other in page.blocks
                  if not other and not roots.isdisjoint(around)]
        own = [text for text, token in inside if token not in template.tokens]
        whole = [text for text, _ in inside]
        return own if 2 * len(own) >= len(whole) else whole
    if page.roots:
        return [text for text, _, around, other in page.blocks if around and not other]
    return [text for text, token, _, other in page.blocks if not other and token not in template.tokens]


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages`` (page_id, url, html)."""
    known = templates(pages)
    size = known.agg(F.sum(F.size("frame"))).first()[0] or 0
    side = F.broadcast(known) if size <= BROADCAST_TOKENS else known

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Template] = {}
        for batch in batches:
            for part in arrow_slices(batch, "html"):
                texts = []
                columns = (part.column(n).to_pylist() for n in ("host", "html", "frame", "content"))
                for site, html, *sides in zip(*columns):
                    if site not in held:
                        if len(held) > 1000:
                            held.clear()
                        held[site] = Template(*(frozenset(t & ((1 << 64) - 1) for t in x or ()) for x in sides))
                    texts.append("\n".join(slots(parse(html), held[site])))
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                     pa.array(map(len, texts), pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    joined = _numbered(pages).join(side, "host", "left").select(
        "page_id", "url", "html", "host", "frame", "content")
    return joined.mapInArrow(run, "page_id long, url string, text string, n_chars long")
