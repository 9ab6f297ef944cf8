"""HTML main-text extraction by site style trees.

Pages of one host share templates.  Each page becomes a tree of elements, an element's style being
its tag and classes, with its texts as leaves.  The trees of a host are merged from the root into
one: an element node holds the child sequences that pages have under it (its style nodes; several
siblings of one style in a row count as one step of the sequence), and the children of each sequence
are element nodes again.

Importance is entropy, with m pages on a node and k of them having one feature of it, to base m:
an element's features are its child sequences (presentation: the more ways pages fill it, the more
important), a leaf's are its texts (content: a text that every page has says nothing).  Composite
importance adds up the branches from the leaves to the root: an element with l child sequences has

    (1 - GAMMA^l) * presentation + GAMMA^l * mean over its sequences and their children.

A leaf seen on m pages keeps 1 / m^2 of its importance whatever its texts, so that few pages prove
little.  A branch under THRESHOLD is removed from every page of the host, unless half of the page's
important text is in it.

What a style says by itself is taken as prior.  Menus, footers, asides and hidden elements are out.
Forms, headers and elements that class or id names as sidebar, comments, notice, advert and so on
are out unless the page's article or main element, or nearly all of its text, is inside.  Where a
page has an article or main element, the main text is what that holds.  The tree judges that too, by
IN_ARTICLE: what goes is a branch that nearly every page of the host has there, in the same words, on
ARTICLE_PAGES or more.  A list or table in an article goes whole or not at all, a heading only with all that
it heads, and an article of which nothing would be left stays as it is.

The pages are parsed twice: once for the statistics (hashes only, packed a page), once to cut the text.
Statistics are counts over (node, feature), added before they move; node hashes include the host, so no
key is a host.  Sums go up the tree by doubling: as many rounds as the logarithm of its depth.  Pages of a
host that are copies of each other, or nearly, count once: those whose widest-spread texts are the
same up to NEAR of their characters.  Removed nodes go to the pages as one sorted array if they are
few, and are joined with each page's nodes otherwise; html moves only in the second case, evenly.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from factline.llm._common import discard, release, stage

THRESHOLD = 0.2
#: The threshold of branches in an article or main element, and the pages that must have them.
IN_ARTICLE = 0.02
ARTICLE_PAGES = 10
GAMMA = 0.9
#: Share of a page's characters in which near copies agree.
NEAR = 0.8
#: Removed nodes that are sent to every executor, 8 bytes each; more are joined.
SENT_NODES = 2_000_000
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg|iframe|textarea|object)\b[^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*>.*?(?:</\1\s*>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*)(?:>|\Z)""", re.S | re.I)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|\b(hidden)\b""")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul head title".split())
_CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = frozenset("article aside body div dl footer form header main nav ol section table td th tr ul html".split())
#: Parts of a list or table, which in an article don't go without the rest of it.
_PARTS = frozenset("caption dd dt figcaption legend li summary tbody td tfoot th thead tr".split())
_HEADING = re.compile(r"h([1-6])(?![a-z0-9-])")
#: Out whatever they hold.
_NEVER = frozenset("nav footer aside button select option input dialog menu head title".split())
#: Out unless the main text is inside; the second also if they stand in an article.
_RARELY = frozenset("form fieldset".split())
_HEADS = frozenset("header label".split())
_OUT_WORDS = frozenset(
    "ad ads advert adverts advertisement banner banners breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer footer form gdpr header login masthead menu modal nav navbar navigation newsletter notice notices overlay pager pagination popup promo promoted promotion related replies respond search share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget".split()
)
#: Words that may stand beside one of the above in a class without changing what it means.
_BESIDE = frozenset("app area bar bottom box block button buttons container content el global group head inner item items js left link links list main module outer page post posts primary right row secondary section site sub text title top ui view wrap wrapper".split())
_OUT_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog alertdialog form menu menubar toolbar".split())
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
_BLANK = re.compile(r"\s+")
#: Share of a page's text beyond which a branch named as something else holds the main text after all.
_NEARLY_ALL = 0.9
_IN, _HEAD, _WEAK, _STRONG = range(4)


def names_noise(token: str) -> int:
    """Whether a class or id names a part that is no main text: some word of it says so, and no other says more ('site-footer', not 'no-sidebar')."""
    words = {w.lower() for w in _WORD.findall(token) if not w.isdigit()}
    noise = words & _OUT_WORDS
    if not noise or words - noise - _BESIDE:
        return _IN
    return _HEAD if noise == {"header"} else _WEAK


def _prior(tag: str, attributes: str) -> tuple[str, int, bool]:
    """Style name, whether the style alone rules the branch out, and whether it is where main text stands."""
    ruled = _STRONG if tag in _NEVER else _WEAK if tag in _RARELY else _HEAD if tag in _HEADS else _IN
    main = tag in ("article", "main")
    if not attributes.strip():
        return tag, ruled, main
    a = {(m[1] or m[5]).lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
    classes = a.get("class", "").split()
    role = a.get("role", "").lower()
    main = main or role == "main"
    if tag not in ("body", "html") and not main:
        ruled = max(ruled, *(names_noise(t) for t in [*classes, a.get("id", "")]))
        if role in _OUT_ROLES:
            ruled = max(ruled, _WEAK if role in ("form", "banner", "search") else _STRONG)
    if "hidden" in a or a.get("aria-hidden", "").lower() == "true" or "display:none" in a.get("style", "").replace(" ", "").lower():
        ruled = _STRONG
    return ".".join([tag, *sorted(c.lower() for c in classes)]) + (" main" if role == "main" else ""), ruled, main


class Page:
    """A parsed page: elements (parent, style, prior, main) from the root on, and its text blocks in order."""

    def __init__(self, page: str | None):
        self.parents, self.styles, self.ruled, self.main = [0], [""], [_IN], [False]
        self.owner: list[int] = []  # element of each block
        self.text: list[str] = []
        if page:
            self._parse(page)
        self._resolve()

    def _parse(self, page: str) -> None:
        stack: list[tuple[str, int, int, int]] = [("", 0, 0, _IN)]  # tag, element, the element that texts belong to, ruled here
        open_tags: dict[str, int] = {}
        buffer: list[str] = []
        owner, inline = 0, _IN

        def flush() -> None:
            if buffer:
                text = _BLANK.sub(" ", html.unescape("".join(buffer))).strip()
                if text:
                    self.owner.append(owner), self.text.append(text)
                buffer.clear()

        def text(piece: str) -> None:
            nonlocal owner, inline
            if piece:
                _, _, own, ruled = stack[-1]
                if buffer and ruled != inline:  # an inline element that is ruled out
                    flush()
                if not buffer:
                    owner, inline = own, ruled
                buffer.append(piece)

        def cut(k: int) -> None:
            for s in stack[k:]:
                open_tags[s[0]] -= 1
            del stack[k:]

        at = 0
        for m in _TAG.finditer(page):
            text(page[at : m.start()])
            at = m.end()
            if m[3] is None:
                if m[0].startswith("<![CDATA["):
                    text(html.escape(m[0][9:].removesuffix("]]>"), quote=False))
                elif m[1]:
                    buffer and buffer.append(" ")
                continue
            tag = m[3].lower()
            if m[2]:
                if not open_tags.get(tag):
                    if tag in _BLOCK:
                        flush()
                    continue
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == tag:
                        if any(s[0] in _BLOCK for s in stack[k:]):
                            flush()
                        cut(k)
                        break
                    if stack[k][0] in _SCOPE and tag not in _SCOPE:
                        break
                continue
            if tag in _VOID:
                if tag == "br":
                    text(" ")
                elif tag in _BLOCK:
                    flush()
                continue
            if tag in _BLOCK:
                flush()
                closes = _CLOSES.get(tag, {"p"})
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] in closes:
                        cut(k)
                        break
                    if stack[k][0] in _SCOPE or stack[k][0] in ("li", "dd", "dt"):
                        break
            _, parent, own, above = stack[-1]
            style, ruled, main = _prior(tag, m[4] or "")
            element = len(self.styles)
            self.parents.append(parent), self.styles.append(style), self.ruled.append(ruled), self.main.append(main)
            stack.append((tag, element, element if tag in _BLOCK or ruled else own, max(ruled, above)))
            open_tags[tag] = open_tags.get(tag, 0) + 1
        text(page[at:])
        flush()

    def _resolve(self) -> None:
        """Which elements are out, and which stand in an article."""
        n = len(self.styles)
        never, size, holds = [False] * n, [0] * n, [False] * n
        for e in range(1, n):
            never[e] = self.ruled[e] == _STRONG or never[self.parents[e]]
        for e, t in zip(self.owner, self.text, strict=True):
            size[e] += 0 if never[e] else len(t)
        for e in range(n - 1, 0, -1):
            size[self.parents[e]] += size[e]
        best = max((e for e in range(n) if self.main[e] and size[e]), key=lambda e: (size[e], -e), default=0)
        e = best
        while e:  # what holds the largest article is not out for its name
            e = self.parents[e]
            holds[e] = True
        least = _NEARLY_ALL * size[0]
        self.inside, self.out = [False] * n, [False] * n
        for e in range(1, n):
            p = self.parents[e]
            self.inside[e] = self.inside[p] or self.main[e]
            named = self.ruled[e] == _WEAK or self.ruled[e] == _HEAD and not self.inside[p]
            self.out[e] = self.out[p] or never[e] or named and not holds[e] and (best > 0 or size[e] < least)
        self.kept = [k for k, e in enumerate(self.owner) if not self.out[e]]
        self.in_article = [self.inside[e] for e in self.owner]

    def judged(self) -> list[int]:
        """The blocks that the host's tree judges."""
        return self.kept

    def nodes(self, host: str) -> tuple[list[tuple[int, int, int, int, bool]], dict[int, int], dict[int, int]]:
        """The page's part of the host's tree: rows (node, parent node, sequence of it, own sequence; a leaf has none: 0; whether in an article),
        the node of each judged block, and of each element above one."""
        children: dict[int, list[int]] = {}  # in order; block k as -1 - k
        for k in self.judged():
            child, e = -1 - k, self.owner[k]
            while True:
                new = e not in children
                children.setdefault(e, []).append(child)
                if not new or not e:
                    break
                child, e = e, self.parents[e]
        rows: list[tuple[int, int, int, int, bool]] = []
        leaf: dict[int, int] = {}
        place = {0: (_hash(f"host\x00{host}"), 0, 0)}
        for e in sorted(children):  # parents come first
            node, parent, sequence = place[e]
            names = [self.styles[c] if c > 0 else "" for c in children[e]]
            steps = [name for i, name in enumerate(names) if not i or names[i - 1] != name]
            own = _hash("\x00".join([str(node), *steps]))
            rows.append((node, parent, sequence, own, self.inside[e]))
            run, j = -1, 0
            for i, (c, name) in enumerate(zip(children[e], names, strict=True)):
                run, j = (run, j + 1) if i and names[i - 1] == name else (run + 1, 0)
                child = _hash(f"{own}/{run}/{j}")
                if c > 0:
                    place[c] = (child, node, own)
                else:
                    leaf[-1 - c] = child
                    rows.append((child, node, own, 0, self.inside[e]))
        return rows, leaf, {e: place[e][0] for e in children}

    def main_text(self, host: str, low: np.ndarray) -> str:
        """The blocks that are left; ``low``: removed nodes, sorted."""
        article = [k for k in self.kept if self.in_article[k]]
        left = self._left(host, low) if len(low) else self.kept
        if article:  # never emptied
            left = self._headed(article, {k for k in left if self.in_article[k]}) or article
        return "\n\n".join(self.text[k] for k in left)

    def _left(self, host: str, low: np.ndarray) -> list[int]:
        """The blocks outside removed branches."""
        _, leaf, element = self.nodes(host)
        removed = lambda node: (i := int(np.searchsorted(low, node))) < len(low) and low[i] == node
        part = {0: False}  # stands in a list or table of an article
        for e in sorted(element):
            if e:
                part[e] = part[self.parents[e]] or self.inside[e] and re.split("[. ]", self.styles[e], maxsplit=1)[0] in _PARTS
        stay = [k for k in self.kept if part[self.owner[k]] or not removed(leaf[k])]
        size = dict.fromkeys(element, 0)  # important text in each branch
        for k in stay:
            size[self.owner[k]] += len(self.text[k])
        for e in sorted(element, reverse=True):
            if e:
                size[self.parents[e]] += size[e]
        gone = {}
        for e in sorted(element):
            gone[e] = e > 0 and (gone[self.parents[e]] or not part[e] and 2 * size[e] < size[0] and removed(element[e]))
        return [k for k in stay if not gone[self.owner[k]]]

    def _headed(self, blocks: list[int], stay: set[int]) -> list[int]:
        """Those of an article's blocks that stay, and the headings of what stays."""
        if not stay:
            return []
        out, under = [], [False] * 7  # whether something stays before the next heading of a rank or a higher one
        for k in reversed(blocks):
            heading = _HEADING.match(self.styles[self.owner[k]])
            rank = int(heading[1]) if heading else 7
            keep = k in stay or rank < 7 and under[rank]
            if keep:
                out.append(k)
                under[1:rank] = [True] * (rank - 1)
            under[rank:] = [False] * (7 - rank)
        return out[::-1]


def host(url: Column) -> Column:
    """Lower-case host of a URL without port; '' if there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def _hash(data: str) -> int:
    return int.from_bytes(hashlib.blake2b(data.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


_LEAF, _INSIDE = 1, 2
#: Packed statistics of a page: an array a column, with an entry a row of the tree.
_PACKED = {"nodes": np.int64, "features": np.int64, "above": np.int32, "kinds": np.uint8, "lengths": np.int32}


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, html) -> host (hash), page (hash of its tree and texts) and, packed, each node, its feature (a leaf's text, else the own
    sequence), the place of the element above (-1: none), its kind (bits _LEAF, _INSIDE) and a leaf's length."""
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            out: list[list] = [[] for _ in range(2 + len(_PACKED))]
            for name, markup in zip(batch.column(0).slice(at, 500).to_pylist(), batch.column(1).slice(at, 500).to_pylist(), strict=True):
                page = Page(markup)
                rows, leaf, _ = page.nodes(name)
                if not rows:
                    continue
                text = {node: page.text[k] for k, node in leaf.items()}
                place = {0: -1} | {row[0]: i for i, row in enumerate(rows)}
                out[0].append(_hash(f"host\x00{name}")), out[1].append(_hash("\x00".join(f"{node}\x01{t}" for node, t in text.items())))
                own = [
                    [r[0] for r in rows], [_hash(text[r[0]]) if r[0] in text else r[3] for r in rows], [place[r[1]] for r in rows],
                    [_LEAF * (r[0] in text) + _INSIDE * r[4] for r in rows], [len(text.get(r[0], "")) for r in rows],
                ]
                for column, values, kind in zip(out[2:], own, _PACKED.values(), strict=True):
                    column.append(np.array(values, kind).tobytes())
            types = [pa.int64()] * 2 + [pa.binary()] * len(_PACKED)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], ["host", "page", *_PACKED])


def _unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """The row of ``batch`` that each entry is of, and the packed columns, ``above`` counted over the batch."""
    columns = [np.frombuffer(b"".join(batch.column(name).to_pylist()), kind) for name, kind in _PACKED.items()]
    counts = np.array([len(x) for x in batch.column("kinds").to_pylist()], np.int64)
    row = np.repeat(np.arange(len(counts)), counts)
    columns[2] = np.where(columns[2] < 0, -1, columns[2] + (np.cumsum(counts) - counts)[row])
    return row, *columns


def _tree_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed pages -> node, parent, sequence, feature, leaf, inside."""
    for batch in batches:
        _, nodes, features, above, kinds, _ = _unpacked(batch)
        if len(nodes):
            parent, sequence = (np.where(above < 0, 0, x[above]) for x in (nodes, features))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (nodes, parent, sequence, features, kinds & _LEAF > 0, kinds & _INSIDE > 0)], ["node", "parent", "sequence", "feature", "leaf", "inside"])


def _page_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed pages -> host, page, feature, length: each text of a page once, with all its characters there."""
    for batch in batches:
        row, _, features, _, kinds, lengths = _unpacked(batch)
        leaf = np.flatnonzero(kinds & _LEAF)
        leaf = leaf[np.lexsort((features[leaf], row[leaf]))]
        if len(leaf):
            row, feature = row[leaf], features[leaf]
            at = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (feature[1:] != feature[:-1])])
            host, page = (batch.column(i).to_numpy()[row[at]] for i in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (host, page, feature[at], np.add.reduceat(lengths[leaf].astype(np.int64), at))], ["host", "page", "feature", "length"])


def _once(texts: DataFrame) -> DataFrame:
    """page: one of each set of near copies."""
    spread = texts.groupBy("host", "feature").agg(F.count("*").alias("on"))
    by = W.partitionBy("host", "page")
    before = F.coalesce(F.sum("length").over(by.orderBy(F.desc("on"), "feature").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    most = texts.join(spread, ["host", "feature"]).withColumn("before", before).withColumn("all", F.sum("length").over(by)).filter(F.col("before") < NEAR * F.col("all"))
    near = most.groupBy("host", "page").agg(F.sort_array(F.collect_list("feature")).alias("most"))
    return near.groupBy("host", "most").agg(F.min("page").alias("page")).select("page")


def style_tree(pages: DataFrame, gamma: float = GAMMA) -> DataFrame:
    """node, leaf, inside (an article), pages, importance of the merged trees of all hosts."""
    packed = "host long, page long, " + ", ".join(f"{name} binary" for name in _PACKED)
    seen = pages.select(host(F.col("url")).alias("host"), "html").mapInArrow(_statistics, packed)
    every = stage(seen.dropDuplicates(["page"]), "elements")
    release()
    once = stage(_once(every.mapInArrow(_page_texts, "host long, page long, feature long, length long")), "once")
    release()
    per = every.join(once, "page", "left_semi").mapInArrow(_tree_rows, "node long, parent long, sequence long, feature long, leaf boolean, inside boolean")
    k = F.col("k")
    features = stage(per.groupBy("node", "feature").agg(F.count("*").alias("k"), F.first("leaf").alias("leaf"), F.first("inside").alias("inside"), F.first("parent").alias("parent"), F.first("sequence").alias("sequence")), "features")
    discard(every, once)
    release()
    nodes = features.groupBy("node").agg(
        F.sum("k").alias("m"), F.sum(k * F.log(k)).alias("spread"), F.count("*").alias("l"), F.first("leaf").alias("leaf"), F.first("inside").alias("inside"), F.first("parent").alias("parent"), F.first("sequence").alias("sequence")
    )
    m = F.col("m")
    entropy = F.when(m > 1, F.col("spread") / (m * F.log(m))).otherwise(0.0)  # 1: all pages alike
    share = F.pow(F.lit(gamma), F.col("l"))
    own = F.when(F.col("leaf"), 1 - entropy * (1 - 1 / (m * m))).otherwise((1 - share) * (1 - entropy))
    nodes = stage(nodes.select("node", "leaf", "inside", "m", "parent", "sequence", own.alias("own"), F.when(F.col("leaf"), 0.0).otherwise(share).alias("share")), "nodes")
    # what an element takes of a child: its share for children, by sequence, by child
    taken = features.filter("not leaf").select(F.col("feature").alias("sequence"), "k")
    below = nodes.groupBy("sequence").agg(F.sum("m").alias("of"))
    above = nodes.filter("not leaf").select(F.col("node").alias("parent"), F.col("m").alias("p_m"), F.col("share").alias("p_share"))
    weights = nodes.filter("parent <> 0").join(taken, "sequence").join(below, "sequence").join(above, "parent")
    weights = weights.select("node", "parent", (F.col("p_share") * F.col("k") / F.col("p_m") * F.col("m") / F.col("of")).alias("w"))
    state = nodes.join(weights, ["node", "parent"], "left").select("node", "leaf", "inside", F.col("m").alias("pages"), F.col("own").alias("importance"), F.when(F.col("w").isNotNull(), F.col("parent")).alias("up"), "w")
    state = stage(state, "branches")
    discard(features, nodes)
    release()
    while not state.filter("up is not null").isEmpty():  # each node holds the sum of 2^i levels, ``up`` is 2^i levels above
        sums = state.filter("up is not null").groupBy(F.col("up").alias("node")).agg(F.sum(F.col("w") * F.col("importance")).alias("more"))
        high = state.select(F.col("node").alias("up"), F.col("up").alias("up2"), F.col("w").alias("w2"))
        far = state.join(high, "up", "left").join(sums, "node", "left")
        last, state = state, stage(far.select("node", "leaf", "inside", "pages", (F.col("importance") + F.coalesce("more", F.lit(0.0))).alias("importance"), F.col("up2").alias("up"), (F.col("w") * F.col("w2")).alias("w")), "branches")
        discard(last)
    return state.select("node", "leaf", "inside", "pages", "importance")


def _extract(removed):
    """(..., host, html[, low]) -> the other columns, text, n_chars; ``removed()``: the removed nodes if no column has the page's own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                names = part.schema.names
                low = part.column("low").to_pylist() if "low" in names else None
                texts = []
                for k, (name, markup) in enumerate(zip(part.column("host").to_pylist(), part.column("html").to_pylist(), strict=True)):
                    texts.append(Page(markup).main_text(name, np.sort(np.array(low[k] or [], np.int64)) if low is not None else removed()))
                keep = [n for n in names if n not in ("host", "html", "low")]
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in keep), pa.array([t.encode("utf-8", "replace").decode() for t in texts], pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*keep, "text", "n_chars"])

    return run


def _page_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, host, html) -> key and each judged node of the page."""
    for batch in batches:
        for key, name, markup in zip(*(batch.column(i) for i in range(3)), strict=True):
            nodes = [r[0] for r in Page(markup.as_py()).nodes(name.as_py())[0]]
            yield pa.RecordBatch.from_arrays([pa.array([key.as_py()] * len(nodes), pa.int64()), pa.array(nodes, pa.int64())], ["key", "node"])


def extract_text(pages: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """page_id, url, text (blocks of main text joined by two line feeds; empty if none), n_chars.

    A null html counts as empty; a null url, or one without a host, belongs to host ''.  Markup that
    is cut off or not closed is read as far as it goes, to any depth.  Rows that repeat a page_id
    each give a row; copies of a page have the same text; other columns are ignored; an empty table
    gives an empty result."""
    kind = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    pages = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    tree = style_tree(pages)
    article = (F.col("importance") < min(threshold, IN_ARTICLE)) & (F.col("pages") >= ARTICLE_PAGES)
    low = stage(tree.filter(F.when(F.col("inside"), article).otherwise(F.col("importance") < threshold)).select("node"), "removed")
    schema = f"page_id {kind['page_id']}, url string, text string, n_chars long"
    named = pages.withColumn("host", host(F.col("url")))
    if low.count() <= SENT_NODES:
        sent = pages.sparkSession.sparkContext.broadcast(np.sort(np.array([r[0] for r in low.toLocalIterator()], np.int64)))
        return named.mapInArrow(_extract(lambda: sent.value), schema)
    named = named.withColumn("key", F.xxhash64("url", "html"))  # copies share a key
    nodes = named.select("key", "host", "html").mapInArrow(_page_nodes, "key long, node long").distinct()
    own = nodes.join(low, "node", "left_semi").groupBy("key").agg(F.collect_set("node").alias("low"))
    joined = named.join(own, "key", "left").drop("key")
    return joined.mapInArrow(_extract(None), schema)
