"""Main text of web pages by wrapper induction."""

from __future__ import annotations

import html
import re
from urllib.parse import urlsplit

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tessera.llm.common import stored

# Element and naming conventions of HTML pages.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "noscript", "template", "iframe", "object", "svg", "canvas", "textarea", "title"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "input", "ins", "kbd", "label", "mark",
    "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
SKIPPED = {"nav", "footer", "aside", "form", "button", "select", "option", "menu", "dialog", "head", "fieldset"}
BOILERPLATE = {
    "menu", "nav", "navbar", "navigation", "topnav", "header", "masthead", "footer", "sidebar", "aside", "ad", "ads", "adv", "advert", "adverts", "advertisement", "adsense",
    "banner", "sponsor", "sponsored", "promo", "promotion", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "alert", "popup", "modal", "overlay", "newsletter",
    "subscribe", "subscription", "signup", "login", "share", "sharing", "social", "breadcrumb", "breadcrumbs", "related", "recommended", "recommendations", "comment",
    "comments", "commentlist", "disqus", "respond", "replies", "widget", "toolbar", "pagination", "pager", "copyright", "legal", "search",
}
#: Words that name boilerplate as often as the subject of a section.
WEAK = {"related", "legal", "search", "notice", "notices", "alert", "share", "sharing", "social", "recommended"}
KEEPERS = {"article", "post", "entry", "story", "content", "main", "body", "title"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu"}
CLOSES_P = re.compile(r"(?:p|h[1-6]|ul|ol|li|dl|dd|dt|div|table|form|section|article|aside|header|footer|nav|main|pre|blockquote|hr|address|figure|fieldset)$")
SELF_NESTED = {"li": {"ul", "ol", "menu"}, "dd": {"dl"}, "dt": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}

#: A quote opens a value only behind "="; elsewhere, as in an unquoted value, it
#: is a character like others.
TAG = re.compile(r"""<!--.*?(?:-->|$)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=(?!\s*["'])|=\s*"[^"]*"|=\s*'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|$)""", re.S)
ATTR = re.compile(r"""([a-zA-Z][\w:-]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*)))?""")
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
SPACE = re.compile(r"\s+")


class Node:
    """A block-level element; runs of like siblings are one node."""

    __slots__ = ("sig", "last", "many", "bad", "sure", "hard", "named", "weight", "size", "zone", "number", "tag", "up", "depth")

    def __init__(self, tag, sig, bad, zone, hard=False, named="", up=None, number=0):
        self.tag, self.sig, self.bad, self.zone, self.hard, self.named, self.up, self.number = tag, sig, bad, zone, hard, named, up, number
        self.last, self.many, self.sure, self.weight, self.size, self.depth = None, False, False, 0, 0, up.depth + 1 if up else 0

    def decide(self, whole: int) -> None:
        """Whether it is boilerplate, and surely so. A modifier does not name an
        element that holds most of the page's text, and a weak name none of an
        article whose text is mostly no links."""
        weak = self.named == "weak" and (not self.zone or 2 * self.weight < self.size)
        soft = self.named == "soft" and 2 * self.weight <= whole
        self.sure = self.hard or soft or (self.up is not None and self.up.sure)
        self.bad = self.sure or weak or (self.up is not None and self.up.bad)


def attributes(text: str) -> dict:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTR.finditer(text)} if text.strip() else {}


def boilerplate(label: str, main: bool) -> str:
    """How class and id name an element boilerplate: hard; soft, by a modifier
    ('has-sidebar') beside a keeper's own name ('content'); weak, by a word that
    may as well be of its subject ('related-work'); or not at all. A modifier
    does not name an article or main element."""
    names = {x.lower() for x in NAME.findall(label)}
    found = names & BOILERPLATE
    if not found or (names & KEEPERS and not names & {"ad", "ads", "comment", "comments", "sidebar", "related", "share", "menu", "nav", "footer"}):
        return ""
    tokens = [{x.lower() for x in NAME.findall(t)} for t in label.split()]
    if any(t and t <= BOILERPLATE for t in tokens):
        return "hard"
    if main:
        return ""
    return "soft" if any(t and t <= KEEPERS for t in tokens) else "weak" if found <= WEAK else "hard"


class Page:
    """Blocks of a page: (node, text, share of its characters in links), and its
    DOM with like siblings folded: `nodes` in document order, `shape` as text, a
    line of depth and signature for each."""

    def __init__(self, source: str):
        self.root = Node("", "", False, "")
        self.nodes = [self.root]
        self.blocks: list[tuple[Node, str, float]] = []
        stack, open_links, parts, linked, at, n = [self.root], 0, [], [], 0, len(source)

        def flush():
            if parts:
                text = SPACE.sub(" ", html.unescape("".join(parts))).strip()
                if text:
                    size, within = len(text) - text.count(" "), len(SPACE.sub("", html.unescape("".join(linked)))) if linked else 0
                    self.blocks.append((stack[-1], text, within / size))
                    stack[-1].weight += max(size - within, 0)
                    stack[-1].size += size
                parts.clear()
            linked.clear()

        def text(s):
            parts.append(s)
            if open_links:
                linked.append(s)

        while at < n:
            m = TAG.search(source, at)
            if not m:
                text(source[at:])
                break
            if m.start() > at:
                text(source[at : m.start()])
            at = m.end()
            tag = m[2] or m[5]
            if not tag:
                continue
            tag, close, rest = tag.lower(), m[1] or m[4], m[3] if m[2] else m[6]
            if tag in RAW and not close:
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at)
                at = end.end() if end else n
                continue
            if tag in INLINE:
                if tag == "br":
                    text(" ")
                elif tag == "a":
                    open_links = 0 if close else 1
                continue
            flush()
            if close:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == tag:
                        del stack[k:]
                        break
                open_links = 0
                continue
            if tag in VOID:
                continue
            if CLOSES_P.match(tag) and stack[-1].tag == "p":
                stack.pop()
            if tag in SELF_NESTED:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == tag or (tag in ("dd", "dt") and stack[k].tag in ("dd", "dt")) or (tag in ("td", "th") and stack[k].tag in ("td", "th")):
                        del stack[k:]
                        break
                    if stack[k].tag in SELF_NESTED[tag]:
                        break
            up, a = stack[-1], attributes(rest)
            label = f"{a.get('class', '')} {a.get('id', '')}"
            named = boilerplate(label, tag in ("article", "main") or a.get("role") == "main") if tag not in ("html", "body") else ""
            hidden = "hidden" in a or a.get("aria-hidden") == "true" or "display:none" in a.get("style", "").replace(" ", "").lower()
            head = tag == "header" and not up.zone
            hard = tag in SKIPPED or head or hidden or a.get("role", "").lower() in ROLES or named == "hard"
            bad = up.bad or hard or named != ""
            zone = up.zone or ("article" if tag == "article" else "main" if tag == "main" or a.get("role") == "main" or a.get("itemprop") == "articleBody" else "")
            if tag == "article" and up.zone == "main":
                zone = "article"
            sig = tag + "".join(sorted("." + re.sub(r"\d+", "0", c) for c in label.split()))
            last = up.last
            if last is not None and last.sig == sig and last.bad == bad and last.hard == hard and last.zone == zone:
                last.many, node = True, last
            else:
                # only a last child is opened again, so nodes stay in document order
                node = up.last = Node(tag, sig, bad, zone, hard, named, up, len(self.nodes))
                self.nodes.append(node)
            stack.append(node)
            open_links = 0
        flush()
        for node in reversed(self.nodes[1:]):
            node.up.weight += node.weight
            node.up.size += node.size
        for node in self.nodes:
            node.decide(self.root.weight)
        self.shape = "\n".join(f"{x.depth} {x.sig}{'*' * x.many}" for x in self.nodes)

    def slots(self) -> dict[int, int]:
        """Folded node -> digest of its texts."""
        texts: dict[int, list] = {}
        for node, text, _ in self.blocks:
            texts.setdefault(node.number, []).append(text)
        return {k: xxhash.xxh3_64_intdigest("\n".join(v)) - (1 << 63) for k, v in texts.items()}

    def identity(self) -> int:
        """Digest of what names alone take for the text: pages that differ in it
        are distinct, copies under another menu are not."""
        return xxhash.xxh3_64_intdigest(self.main_text()) - (1 << 63)

    def main_text(self, template: frozenset = frozenset(), content: frozenset = frozenset(), names: bool = True) -> str:
        """Blocks that are not slots of the host's template. Of slots that the
        alignment has not found to be content, only those of the article (else
        main, else of the body) stay, and there no run of like siblings made of
        links alone. A weak name says nothing of a slot that was found to be content.
        Without `names` no element's name is looked at."""
        gone = lambda x: x.number in template or (names and (x.sure if x.number in content else x.bad))
        left = [b for b in self.blocks if not gone(b[0])]
        zones = {b[0].zone for b in left} if names else set()
        zone = "article" if "article" in zones else "main" if "main" in zones else ""
        menu = [a[0] is b[0] and a[2] >= 0.8 and b[2] >= 0.8 for a, b in zip(left, left[1:])]
        links = [not zone and (x or y) for x, y in zip([False, *menu], [*menu, False])]
        return "\n".join(b[1] for b, run in zip(left, links) if b[0].number in content or ((not zone or b[0].zone == zone) and not run))


def flat(shape: str) -> list[tuple]:
    """(number, signature, kids) of each node of a shape."""
    out: list[tuple] = []
    path: list[int] = []
    for at, line in enumerate(shape.split("\n")):
        depth, _, sig = line.partition(" ")
        del path[int(depth) :]
        if path:
            out[path[-1]][2].append(at)
        path.append(at)
        out.append((at, sig.rstrip("*"), []))
    return out


def match(a: list, b: list) -> dict[int, int]:
    """Simple tree matching: the largest order-preserving match of two trees
    that pairs only like nodes under paired parents. Node of b -> node of a.
    Pairs are visited from a list, not by recursion: pages may be deep."""
    if a[0][1] != b[0][1]:
        return {}
    pairs = [(0, 0)]
    for x, y in pairs:
        pairs += [(p, q) for p in a[x][2] for q in b[y][2] if a[p][1] == b[q][1]]
    size, tables = {}, {}
    for x, y in reversed(pairs):
        ka, kb = a[x][2], b[y][2]
        m = [[0] * (len(kb) + 1) for _ in range(len(ka) + 1)]
        for i, p in enumerate(ka, 1):
            for j, q in enumerate(kb, 1):
                m[i][j] = max(m[i - 1][j], m[i][j - 1], m[i - 1][j - 1] + size.get((p, q), 0))
        tables[x, y], size[x, y] = m, 1 + m[-1][-1]
    found, open_ = {}, [(0, 0)]
    while open_:
        x, y = open_.pop()
        found[y] = x
        m, i, j = tables[x, y], len(a[x][2]), len(b[y][2])
        while i and j:
            pair = a[x][2][i - 1], b[y][2][j - 1]
            if (n := size.get(pair, 0)) and m[i][j] == m[i - 1][j - 1] + n:
                open_.append(pair)
                i, j = i - 1, j - 1
            elif m[i][j] == m[i - 1][j]:
                i -= 1
            else:
                j -= 1
    return found


def grown(wrapper: str, shape: str) -> str:
    """The wrapper with the nodes of `shape` that it does not match yet."""
    trees = flat(wrapper), flat(shape)
    back = match(*trees)
    forward = {x: y for y, x in back.items()}
    out, open_ = [], [(0, 0, 0)]  # which tree, node, depth
    while open_:
        tree, x, depth = open_.pop()
        _, sig, kids = trees[tree][x]
        out.append(f"{depth} {sig}")
        kids = [(tree, k, depth + 1) for k in kids]
        if not tree and x in forward:
            own, kids = kids, []
            for q in trees[1][forward[x]][2]:
                if q not in back:
                    kids.append((1, q, depth + 1))
                    continue
                upto = next(i for i, k in enumerate(own) if k[1] == back[q]) + 1
                kids, own = kids + own[:upto], own[upto:]
            kids += own
        open_ += reversed(kids)
    return "\n".join(out)


def host(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


#: Wrappers of a host that a task merges into one, about; those are merged again.
FAN = 32
#: Share of a host's distinct pages (two at least) that a slot must be on to be template.
SHARE = 0.25
#: A slot outside article and main is template too if its texts are at most so
#: many a distinct page, and REPEATS fewer; above VARIES a slot is content.
REPEATED, REPEATS, VARIES = 0.75, 3, 0.9
#: (host, skeleton) rules to broadcast at most; beyond, they are joined.
BROADCAST_RULES = 100_000


def slot_texts(pages: DataFrame) -> DataFrame:
    """host, skeleton (a hash), slot, digest of its texts, identity of the page
    and whether it is in article or main, of each slot of each page. Slot -1
    stands for the page, and brings the skeleton's tree once in a batch."""

    def run(batches):
        for b in batches:
            out, seen = [], set()
            for url, source in zip(b["url"].to_pylist(), b["html"].to_pylist()):
                page = Page(source or "")
                name, page_id = host(url), page.identity()
                shape = xxhash.xxh3_64_intdigest(page.shape) - (1 << 63)
                out.append((name, shape, -1, page_id, page_id, False, None if (name, shape) in seen else page.shape))
                seen.add((name, shape))
                out += [(name, shape, slot, d, page_id, page.nodes[slot].zone != "", None) for slot, d in page.slots().items()]
            cols = list(zip(*out)) or [()] * 7
            kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["host", "shape", "slot", "text", "page", "zoned", "tree"])

    return pages.select("url", "html").mapInArrow(run, "host string, shape long, slot int, text long, page long, zoned boolean, tree string")


def host_wrappers(shapes: DataFrame) -> DataFrame:
    """host and wrapper, grown from all its trees: each round merges slices of
    about FAN of a host's trees into one, until every host has one."""

    def grow(batches):
        for b in batches:
            out = []
            for first, *rest in b["trees"].to_pylist():
                for tree in rest:
                    first = grown(first, tree)
                out.append(first)
            yield pa.RecordBatch.from_arrays([b["host"], pa.array(out, pa.string()), b["n"]], ["host", "tree", "n"])

    level = shapes.select("host", "tree", "n")
    while True:
        sizes = level.groupBy("host").agg(F.count("*").alias("_k"))
        if (sizes.agg(F.max("_k")).first()[0] or 0) <= 1:
            return level.select("host", F.col("tree").alias("wrapper"))
        parts = level.join(sizes, "host").withColumn("_slice", F.pmod(F.xxhash64("tree"), F.ceil(F.col("_k") / FAN)))
        order = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "tree")))
        lists = parts.groupBy("host", "_slice").agg(F.transform(order, lambda s: s.tree).alias("trees"), F.sum("n").alias("n"))
        level = stored(lists.select("host", "trees", "n").mapInArrow(grow, "host string, tree string, n long"), "wrappers")


def slot_rules(slots: DataFrame) -> DataFrame:
    """host, shape, and the slots of that skeleton that are template and content.

    Slots that align to one node of the host's wrapper are compared over the
    host's distinct pages. A node with one text for all of them, or whose texts
    come back on page after page, is template; one with a text of its own for
    nearly every page is content. Texts and pages are counted by sketches that
    are summed before anything is shuffled, so a host with a third of all pages
    is no larger than another."""
    on = slots.filter("slot = -1").groupBy("host").agg(F.hll_sketch_estimate(F.hll_sketch_agg("page", 11)).alias("of")).filter("of >= 2")
    shapes = slots.filter("tree IS NOT NULL").join(on.select("host"), "host").groupBy("host", "shape").agg(F.min("tree").alias("tree"), F.count("*").alias("n"))
    shapes = stored(shapes, "shapes")

    def align(batches):
        for b in batches:
            out = []
            for name, shape, tree, wrapper in zip(*(b[c].to_pylist() for c in ("host", "shape", "tree", "wrapper"))):
                out += [(name, shape, slot, node) for slot, node in match(flat(wrapper), flat(tree)).items()]
            cols = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, [pa.string(), pa.int64(), pa.int32(), pa.int32()])], ["host", "shape", "slot", "node"])

    nodes = shapes.select("host", "shape", "tree").join(host_wrappers(shapes), "host").mapInArrow(align, "host string, shape long, slot int, node int")
    sums = slots.filter("slot >= 0").groupBy("host", "shape", "slot").agg(*[F.hll_sketch_agg(c, 11).alias(c) for c in ("text", "page")], F.max("zoned").alias("zoned"))
    aligned = stored(sums.join(nodes, ["host", "shape", "slot"]), "aligned")
    counts = aligned.groupBy("host", "node").agg(*[F.hll_sketch_estimate(F.hll_union_agg(c)).alias(f"{c}s") for c in ("text", "page")], F.max("zoned").alias("zoned")).join(on, "host")
    texts, seen = F.col("texts"), F.col("pages")
    often = (seen >= 2) & (seen >= SHARE * F.col("of"))
    back = ~F.col("zoned") & (texts <= REPEATED * seen) & (texts <= seen - REPEATS)
    kinds = counts.select("host", "node", F.when(often & ((texts == 1) | back), "template").when(often & (texts >= VARIES * seen), "content").alias("kind")).filter("kind IS NOT NULL")
    which = [F.array_sort(F.collect_set(F.when(F.col("kind") == k, F.col("slot")))).alias(k) for k in ("template", "content")]
    return aligned.select("host", "shape", "slot", "node").join(kinds, ["host", "node"]).groupBy("host", "shape").agg(*which)


def extract(pages: DataFrame, names: bool = True) -> DataFrame:
    """page_id, url, text and n_chars (code points) of each row.

    Each page becomes a tree of its block elements with runs of like siblings
    folded. Same-host trees are aligned by simple tree matching to a wrapper
    grown from all of the host's trees; `slot_rules` tells its constant nodes
    (template) from its varying ones (content). Template slots go, content
    stays; where a host has too few pages to tell, the article's slots (else
    main's, else the body's) stay. What varies like content but is none (reader
    comments, adverts, forms and the like) goes by the names of elements,
    classes and roles; `names=False` leaves all to the alignment.

    Null html counts as empty, null url as a host without name; a page without
    content has the empty text. Repeated rows get a row each. Extra columns are
    ignored; an empty table gives none."""
    rules = stored(slot_rules(stored(slot_texts(pages), "slots")), "rules")
    plain = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    if rules.limit(BROADCAST_RULES + 1).count() > BROADCAST_RULES:
        return _measured(_joined(plain, rules, names))
    table = {(r[0], r[1]): (frozenset(r[2]), frozenset(r[3])) for r in rules.collect()}
    shared = pages.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        known, none = shared.value, (frozenset(), frozenset())
        for b in batches:
            out = []
            for url, source in zip(b["url"].to_pylist(), b["html"].to_pylist()):
                page = Page(source or "")
                out.append(page.main_text(*known.get((host(url), xxhash.xxh3_64_intdigest(page.shape) - (1 << 63)), none), names))
            yield pa.RecordBatch.from_arrays([b["page_id"], b["url"], pa.array(out, pa.string())], ["page_id", "url", "text"])

    return _measured(plain.mapInArrow(run, "page_id long, url string, text string"))


def _measured(found: DataFrame) -> DataFrame:
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def _joined(plain: DataFrame, rules: DataFrame, names: bool) -> DataFrame:
    """As `extract`, with the rules joined: for more rules than can be sent."""

    def shapes(batches):
        for b in batches:
            keys = [(host(u), xxhash.xxh3_64_intdigest(Page(s or "").shape) - (1 << 63)) for u, s in zip(b["url"].to_pylist(), b["html"].to_pylist())]
            yield b.append_column("host", pa.array([k[0] for k in keys], pa.string())).append_column("shape", pa.array([k[1] for k in keys], pa.int64()))

    def run(batches):
        for b in batches:
            out = [Page(s or "").main_text(frozenset(t or ()), frozenset(c or ()), names) for s, t, c in zip(*(b[n].to_pylist() for n in ("html", "template", "content")))]
            yield pa.RecordBatch.from_arrays([b["page_id"], b["url"], pa.array(out, pa.string())], ["page_id", "url", "text"])

    keyed = plain.mapInArrow(shapes, "page_id long, url string, html string, host string, shape long")
    return keyed.join(rules, ["host", "shape"], "left").select("page_id", "url", "html", "template", "content").mapInArrow(run, "page_id long, url string, text string")
