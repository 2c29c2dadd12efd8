"""Operator 6: main text of web pages by a site style tree.

Every page is read into elements (all block elements, menus, footers and
adverts too; named by tag, id and classes along their path) and text blocks.
The DOMs of one host are merged into a style tree whose nodes are element
paths and, as leaves, each text at its path. A node met on m pages has two entropies to base m: that of its child
sequences (presentation) and, for each text block below it, that of the pages
that repeat the block (content). Its importance is
(1 - GAMMA) * presentation entropy + GAMMA * (1 - mean content entropy): near 0
for what looks and says the same on every page; a leaf that k of the m pages
have has GAMMA * (1 - log k / log m). Branches and leaves below ``LOW`` are
removed from each page, if at least ``EVIDENCE`` different pages tell; the
paragraphs of a marked article are never judged by their host, only
containers in it: paths start anew at the article. A page that would lose more
than ``MOST`` of its text is a near copy of others and no evidence: the tree is
counted again without such pages, and only what is low there as well goes, then
from every page, also from one that has nothing else.

Names add to the tree, as text that differs on every page looks important to
it: what says by tag, role, class or id that it is a menu, header, footer,
sidebar, notice, advert, form or reader comment is no text on any page, and
if a page marks its article, only that is read. A class counts as a whole (all
its words say so: cookie-notice, but not related-work) and, as roles and ids
do, only on containers; an id not in an article and not on a section, whose id
is an anchor, unless it names reader comments. Buttons, labels and hidden
inline elements are no text either. An element with more than ``MOST`` of the page's text is its
wrapper and goes by no name.

Scale: the tree is counts by (host, path, child sequence), (host, path,
block) and (host, leaf), partial sums first; no host is ever gathered. Copies of a page within
a host count once.

Defined cases: null html is empty and gives the empty text; a null url or one
without a host has no site, so nothing is removed by importance; repeated rows
give repeated results; unclosed and stray tags, unterminated comments and
truncated pages are read as browsers do, in one pass; elements nested deeper
than ``DEPTH`` count as parts of their ancestor there, so a page costs no more
than its length times a constant; an empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm import workers

GAMMA, LOW, EVIDENCE, MOST = 0.9, 0.2, 8, 0.8
DEPTH = 256  # levels of the tree; browsers bound theirs alike

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg object video audio canvas select".split())
TO_THE_END = frozenset("script style textarea title".split())  # without an end tag, the rest of the page is theirs
NOISE_TAGS = frozenset("head nav footer aside form button menu dialog header label fieldset".split())
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption
 figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot
 th thead tr ul""".split())
CONTAINERS = frozenset("div section ul ol table dl figure center details".split())
#: What is a node of the tree outside a marked article; in one, CONTAINERS are.
NODES = BLOCKS - frozenset("html body article main hr".split())
#: Words of class, id and role names that say a part is not the article.
NOISE_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising adsbygoogle banner breadcrumb breadcrumbs
 comment comments commentlist complementary consent contentinfo cookie cookies disclaimer disqus footer gdpr login masthead
 menu modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup promo promoted
 promotion recommended related reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe
 subscription teaser toolbar topbar widget""".split())
#: What may stand before one of them in a whole name.
PLACES = frozenset("bottom left main page post reader right side site top user".split())
COMMENT_WORDS = frozenset("comment comments commentlist reply disqus reviews".split())
COMMENT_IDS = frozenset("comments commentlist disqus reviews".split())
#: Whose reviews are comments; a review by itself may be the article.
READERS = frozenset("customer guest reader user visitor".split())
INLINE = frozenset("button label".split())  # no text, without a block of their own
IN_HEAD = frozenset("title meta link script style base noscript template".split())
CLOSES = {  # an opening tag ends these if open, up to the nearest of the second set
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])), "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])), "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
}
_CUTS_P = BLOCKS - {"html", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}

_TOKEN = re.compile(r"<!--(?:.*?-->|.*)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
                    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|</?[a-zA-Z][^>]*$|</[^>]*(?:>|$)", re.S)
_ATTR = re.compile(r"""(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=[\s/>]|$)""", re.I)
_NAME = re.compile(r"[a-z]+|[0-9]+")


class _Open:
    """An open element."""

    __slots__ = ("tag", "noise", "article", "path", "number", "mute", "tagged", "chars")

    def __init__(self, tag, noise, article, path, number=None, mute=False, tagged=False):
        self.tag, self.noise, self.article, self.path = tag, noise, article, path
        self.number, self.mute, self.tagged = number, mute, tagged  # if named; if silent; if in a noise tag
        self.chars = 0  # of text in it and in what was closed in it


def _says(name: str) -> set[str]:
    """The words of a whole class, id or role name if they say that it is not the article."""
    # lower and mixed case names alike: cookieNotice, cookie-notice
    words = _NAME.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower())
    words = [w for w in words if not w.isdigit()]
    if len(words) > 1 and words[-1] in ("review", "reviews") and all(w in READERS for w in words[:-1]):
        return {"reviews", "comments"}
    return set(words) if words and words[-1] in NOISE_WORDS and all(w in NOISE_WORDS or w in PLACES for w in words) else set()


def _mark(tag: str, attrs: str, article) -> tuple[bool, bool, bool, bool, str]:
    """(is not shown, is hidden, is noise, is a comment, name) of an element by its attributes."""
    if not attrs or attrs.isspace():
        return False, False, False, False, tag
    words, label, off, silent = set(), [], False, False
    holds = tag in CONTAINERS or tag in NOISE_TAGS or tag in ("article", "main")
    for m in _ATTR.finditer(attrs):
        key, value = m[1].lower(), (m[2] or "").strip("\"'")
        if key in ("class", "id"):
            label.append(value)
            if holds:
                said = set().union(*map(_says, value.split()))
                if key == "id" and (article or tag == "section") and not said & COMMENT_IDS:
                    said = set()
                words |= said
        elif key == "role":
            if holds:
                words.update(*map(_says, value.split()))
        elif key == "hidden" or key == "style" and "display:none" in value.replace(" ", "").lower():
            off = True
        elif key == "aria-hidden" and value.lower() == "true":
            silent = True
    return off, off or silent, bool(words & NOISE_WORDS), bool(words & COMMENT_WORDS), ".".join([tag, *label])


def parse(source: str, spare: frozenset = frozenset()) -> tuple[list, dict[str, list[str]], list]:
    """Blocks (text, nodes around it) that are the text by name, the child sequence of each path, and all blocks.

    A block's nodes are the element paths around it and, outside a marked
    article, its leaf; in the list of all blocks the leaf stands apart, and a flag says which are the text by name.
    ``spare``: which elements, counted by their names, are wrappers.
    """
    named, held, total = 0, {}, 0
    blocks: list = []  # number among all, nodes, in an article, in an article whose surroundings are noise
    every: list = []  # text, paths, leaf or None
    stack = [_Open("", False, 0, ())]
    count: dict[str, int] = {}  # open elements by tag
    endless: set[str] = set()  # skipped elements of which no end follows
    kids: dict[str, list[str]] = {"": []}
    run: list[str] = []
    first_article = [False]

    def flush():
        nonlocal total
        if run:
            text = " ".join("".join(run).split())
            run.clear()
            if text:
                top = stack[-1]
                leaf = None if top.article or top.noise == 2 else f"{top.path[-1] if top.path else ''}\t{text}"
                if not top.tagged:
                    total += len(text)
                    top.chars += len(text)
                nodes = top.path if leaf is None else (*top.path, leaf)
                if not top.noise:
                    blocks.append((len(every), nodes, top.article))
                elif top.noise == 2:
                    blocks.append((len(every), nodes, 2))
                every.append((text, top.path, leaf))

    def close(i):
        if any(e.tag in BLOCKS for e in stack[i:]):
            flush()
        while len(stack) > i:
            e = stack.pop()
            stack[-1].chars += e.chars
            count[e.tag] -= 1
            if e.number is not None:
                held[e.number] = e.chars

    def say(text):
        if stack[-1].tag == "head" and not text.isspace():
            close(len(stack) - 1)
        if not stack[-1].mute:
            run.append(text)

    at, n = 0, len(source)
    while at < n:
        m = _TOKEN.search(source, at)
        if not m:
            say(entities.unescape(source[at:]))
            break
        if m.start() > at:
            say(entities.unescape(source[at:m.start()]))
        at = m.end()
        slash, tag, attrs = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if slash:
            if count.get(tag):
                i = len(stack) - 1
                while stack[i].tag != tag:
                    i -= 1
                close(i)
            continue
        if stack[-1].tag == "head" and tag not in IN_HEAD:
            close(len(stack) - 1)
        if tag in ("svg", "math") and attrs.endswith("/") and not re.search(r"=\s*[^\s\"'>]*/$", attrs):
            continue
        if tag in RAW or tag == "xmp":
            end = None if tag in endless else re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(source, at)
            if not end:
                endless.add(tag)
            if tag == "xmp":  # shown as it stands
                flush()
                say(source[at:end.start() if end else n])
                flush()
            if end or tag in TO_THE_END or tag == "xmp":
                at = end.end() if end else n
            continue
        if tag == "br":
            say(" ")
            continue
        if tag == "hr":
            flush()
        if tag in VOID:
            continue
        if tag in _CUTS_P or tag in CLOSES:
            ends, stops = CLOSES.get(tag, ((), ()))
            open_ones = any(count.get(t) for t in ends) or tag in _CUTS_P and count.get("p")
            for i in range(len(stack) - 1 if open_ones else 0, 0, -1):
                t = stack[i].tag
                if t in ends or t == "p" and tag in _CUTS_P:
                    close(i)
                    break
                if t in stops or t in ("td", "th", "li", "article", "main", "body") and tag not in ("td", "th"):
                    break
        if tag in BLOCKS:
            flush()
        top = stack[-1]
        article = top.article
        unseen, hidden, noisy, comment, name = _mark(tag, attrs, article)
        mute = tag not in ("article", "main") and (top.mute or tag in INLINE or unseen and tag not in BLOCKS and tag not in ("html", "body"))
        number = None
        if noisy and not comment and tag in CONTAINERS:
            noisy = named not in spare
            number = named
            named += 1
        noisy = noisy or hidden
        if tag in ("article", "main"):
            noisy = comment
            if not top.noise:
                article = article or not comment
        elif tag in ("html", "body"):
            noisy = False
        elif tag in NOISE_TAGS:
            noisy = noisy or not (tag == "header" and article)
        noise = 1 if noisy and top.noise != 2 else top.noise
        if noisy and top.noise == 2:
            noise = 1
        if tag in ("article", "main") and top.noise == 1 and not comment and not first_article[0]:
            noise = 2  # perhaps something before it was never closed
        if tag in ("article", "main"):
            first_article[0] = True
        path = top.path
        inside = article or noise == 2
        if inside and (tag == "main" and not top.article or tag == "article" and not count.get("article")):
            path = ()
        base = "/article" if inside else ""
        if len(path) >= DEPTH:
            pass
        elif tag in (CONTAINERS if inside else NODES):
            kids.setdefault(path[-1] if path else base, []).append(name)
            path = (*path, _step(path[-1] if path else base, name))
            kids.setdefault(path[-1], [])
        elif tag in BLOCKS and (path or not inside):
            kids[path[-1] if path else ""].append(tag)
        stack.append(_Open(tag, noise, article, path, number, mute, top.tagged or tag in NOISE_TAGS))
        count[tag] = count.get(tag, 0) + 1
    flush()
    close(1)
    wrappers = spare.union(i for i, chars in held.items() if chars > MOST * total)
    if wrappers != spare:
        return parse(source, wrappers)
    marked = [b for b in blocks if b[2] == 1 or b[2] is True]
    chosen = marked or [b for b in blocks if b[2] == 2] or [b for b in blocks if not b[2]]
    of = {i for i, _, _ in chosen}
    return [(every[i][0], nodes) for i, nodes, _ in chosen], kids, [(*e, i in of) for i, e in enumerate(every)]


def _step(path: str, name: str) -> str:
    """The path one element further: in words as long as it is short, then its digest, so that depth does not lengthen it."""
    longer = f"{path}/{name}"
    return longer if len(longer) <= 200 else f"#{_hash(longer) & (1 << 64) - 1:016x}"


def host_of(url):
    """The host of a URL column in lower case, without user and port; null if there is none."""
    found = F.regexp_extract(url, r"^\s*(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.nullif(F.lower(found), F.lit(""))


def _hash(text: str) -> int:
    import xxhash
    return int(np.uint64(xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace"))).view(np.int64))


_SHAPES = ("host string, digest long, chars long, "
           "blocks array<struct<block:long,paths:array<long>,leaf:long,at:long,n:long>>, nodes array<struct<path:long,kids:long>>")


def shape_batches(batches):
    """(host, html) rows as host, digest, chars of the text by name, blocks and nodes (path, child sequence).

    A block is its digest, the paths around it, its leaf, the path of the leaf, and n: its length if it is text by name, else 0.
    """
    block = pa.list_(pa.struct([("block", pa.int64()), ("paths", pa.list_(pa.int64())), ("leaf", pa.int64()), ("at", pa.int64()),
                                ("n", pa.int64())]))
    node = pa.list_(pa.struct([("path", pa.int64()), ("kids", pa.int64())]))
    for batch in batches:
        digests, chars, blocks, nodes = [], [], [], []
        for source in batch.column(1):
            texts, kids, found = parse(source.as_py() or "")
            ids = {p: _hash(p) for p in kids}
            blocks.append([{"block": _hash(t), "paths": [ids[p] for p in paths], "leaf": None if leaf is None else _hash(leaf),
                            "at": ids[paths[-1] if paths else ""], "n": len(t) if chosen else 0}
                           for t, paths, leaf, chosen in found if paths or leaf is not None])
            nodes.append([{"path": ids[p], "kids": _hash(" ".join(k))} for p, k in kids.items()])
            digests.append(_hash("\n".join(t + "\t" + "".join(p[-1:]) for t, p, _, _ in found) + "\n".join(kids)))
            chars.append(sum(len(t) for t, _ in texts))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.int64()), pa.array(chars, pa.int64()),
                                          pa.array(blocks, block), pa.array(nodes, node)],
                                         ["host", "digest", "chars", "blocks", "nodes"])


def text_batches(batches):
    """(page_id, url, html, removed) rows as page_id, url, text; removed: paths and leaves of low importance."""
    for batch in batches:
        texts = []
        for source, removed in zip(batch.column(2), batch.column(3), strict=True):
            gone = set(removed.as_py() or ())
            blocks = parse(source.as_py() or "")[0]
            texts.append("\n".join(t for t, nodes in blocks if not gone or gone.isdisjoint(map(_hash, nodes))))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def _rows(pages: DataFrame) -> DataFrame:
    url = F.col("url").cast("string")
    return pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url"),
                        F.col("html").cast("string").alias("html"), host_of(url).alias("host"))


def page_shapes(pages: DataFrame) -> DataFrame:
    """host, digest, blocks and nodes of every page that has a host and text to judge; no texts."""
    shapes = _rows(pages).filter("host is not null").select("host", "html").mapInArrow(
        workers.task(__name__, "shape_batches"), _SHAPES)
    return shapes.filter("size(blocks) > 0")


def node_importance(shapes: DataFrame) -> DataFrame:
    """(host, path, pages, importance) of every element path of every host's style tree, and of each leaf that may be low."""
    one = shapes.groupBy("host", "digest").agg(F.first("nodes").alias("nodes"), F.first("blocks").alias("blocks"))
    nodes = one.select("host", F.explode("nodes").alias("n")).select("host", "n.path", "n.kids")
    seqs = nodes.groupBy("host", "path", "kids").agg(F.count("*").alias("c"))
    look = seqs.groupBy("host", "path").agg(F.sum("c").alias("pages"), F.sum(F.col("c") * F.log("c")).alias("clogc"))
    texts = one.select("host", F.explode(F.array_distinct("blocks")).alias("b"))
    said = texts.select("host", "b.block", F.explode("b.paths").alias("path"))
    on = said.groupBy("host", "path", "block").agg(F.count("*").alias("k"))
    repeats = on.groupBy("host", "path").agg(F.sum("k").alias("all"), F.sum(F.col("k") * F.log("k")).alias("klogk"))
    both = look.join(repeats, ["host", "path"], "left")
    logm = F.log(F.greatest(F.col("pages"), F.lit(2)))
    presentation = (F.log("pages") - F.col("clogc") / F.col("pages")) / logm
    content = F.coalesce(1 - F.least(F.lit(1.0), F.col("klogk") / F.col("all") / logm), F.lit(0.0))
    paths = both.filter(F.col("path") != _hash("")).select("host", "path", "pages", ((1 - GAMMA) * presentation + GAMMA * content).alias("importance"))
    # a leaf is below LOW if k > pages ** (1 - LOW / GAMMA): texts of few pages never are and meet no join
    leaves = texts.filter("b.leaf is not null").groupBy("host", "b.leaf", "b.at").agg(F.count("*").alias("k")) \
        .filter(F.col("k") > EVIDENCE ** (1 - LOW / GAMMA))
    alone = leaves.join(look.select("host", F.col("path").alias("at"), "pages"), ["host", "at"]) \
        .select("host", F.col("leaf").alias("path"), "pages", (GAMMA * (1 - F.least(F.lit(1.0), F.log("k") / logm))).alias("importance"))
    return paths.unionAll(alone)


def low_nodes(shapes: DataFrame) -> DataFrame:
    """(host, removed): paths and leaves that enough pages show to be of low importance."""
    low = node_importance(shapes).filter((F.col("pages") >= EVIDENCE) & (F.col("importance") < LOW))
    return low.groupBy("host").agg(F.collect_set("path").alias("removed"))


def telling_pages(shapes: DataFrame, removed: DataFrame) -> DataFrame:
    """The pages of hosts with low nodes that keep a part of their text without these: the others are near copies."""
    nodes = lambda b: F.concat(b["paths"], F.array_compact(F.array(b["leaf"])))
    lost = F.aggregate(F.filter("blocks", lambda b: (b["n"] > 0) & F.arrays_overlap(nodes(b), "removed")), F.lit(0).cast("long"),
                       lambda so_far, b: so_far + b["n"])
    return shapes.join(removed, "host").filter(lost <= MOST * F.col("chars")).drop("removed")


def main_texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages``.

    The first pass keeps digests of the pages' elements and blocks only.
    The nodes to remove (at most the paths and leaves that a host repeats on
    ``EVIDENCE`` pages) are written, so that the planner knows their size when
    it joins them to the pages of their host, which are read a second time.
    """
    shapes = workers.keep(page_shapes(pages), "shapes")
    first = workers.keep(low_nodes(shapes), "low")
    removed = workers.keep(low_nodes(telling_pages(shapes, first)), "removed")
    workers.drop(shapes)
    workers.drop(first)
    rows = _rows(pages).join(removed, "host", "left").select("page_id", "url", "html", "removed")
    return rows.mapInArrow(workers.task(__name__, "text_batches"), "page_id long, url string, text string") \
        .withColumn("n_chars", F.length("text").cast("long"))
