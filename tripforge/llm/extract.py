"""Main text of web pages by wrapper induction.

Pages of a host are rendered by one template or a few.  All differing pages of a
host are learnt from, whatever their number and size; nothing depends on how the
rows are dealt.  Their DOM trees, equal-labelled siblings taken as one, are aligned
by simple tree matching: the heaviest set of matched nodes that keeps ancestors and
sibling order, a node matching only its like (tag, classes, role).  Every distinct
tree belongs to the template whose leader it is most alike (matched for the most
part); leaders are told in steps of bounded groups, and trees that no leader is
like go through another round until none is left.

Every page counts: texts that most pages of a template hold at nodes aligned with
that of the first page that has it (by hash) are common to it, menus and the like
included; the others are slots.  Pages whose slots are for the most part those of
pages before them, or that hardly have any (under ``LEAST_SLOTS`` of the text that
names alone do not rule out), say nothing about the template; the constants are the
texts that most of the others, and at least ``support`` + 1, hold at aligned nodes.
The wrapper of a host holds the constants of its templates; every slot stays.

A page's text is then its blocks inside the article (``article``, ``main``, or
else the whole body) that are neither constants of its host nor inside menus, page
headers, footers, sidebars, notices, adverts, forms, scripts or reader comments
that vary from page to page, which are told by tag, role and the names of class
and id.  A name counts when all its words are such (``cookie-notice``,
``site-header``), never by one word of several (``entry-header``,
``share-prices``); inside an article ``HAZY`` words do not count by themselves.
Blocks that are mostly links in lists count as menus.  Character references are
decoded, white space inside a block becomes one space, and blocks are joined by
one newline.  Every page is extracted whole.

Null and empty html give the empty text.  Pages without host, and templates with too
few differing pages, have no constants.  Repeated rows are each returned.  Extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripforge.llm.common import spread, staged
from tripforge.llm.dom import Block, Node, parse

# Fixed sets: what is never part of an article.
NEVER = frozenset("head nav aside form button select option script style noscript template svg iframe textarea dialog menu "
                  "canvas object audio video fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar form".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion promoted banner "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay nav navbar navigation menu submenu "
    "breadcrumb breadcrumbs sidebar aside widget footer header masthead topbar toolbar comment comments commentlist "
    "discussion replies disqus related recommended share sharing social newsletter subscribe subscription paywall login "
    "signup search pagination pager skip".split())
# what may stand beside them in a name, and what an article may call its own parts
BESIDE = frozenset(
    "site page global top bottom left right main primary secondary bar box area block container wrapper wrap inner outer list "
    "links link button buttons form section item items group row col column posts articles stories unit slot".split())
HAZY = frozenset("header masthead widget notice notices notification alert search banner aside promotion discussion overlay modal".split())
HOLDERS = frozenset("html body main article #root".split())
BUCKETS = 64                     # a host's trees are dealt to so many groups
ALIKE = 0.6                      # of two trees: matched share above which their template is one
MOST = 0.8                       # of a template's pages: share that holds a constant
LEAST_SLOTS = 0.2                # of a page's text: least share in slots


def host_of(url: Column) -> Column:
    """The host of a url, lower-case; null without one."""
    h = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(h != "", h)


def _chrome(names: frozenset, but: frozenset = frozenset()) -> bool:
    """Whether a name says, with all its words, that a node is no part of the article."""
    for name in names:
        words = set(filter(None, re.split("[-_/:.]+", name)))
        if words & (NAMES - but) and words <= NAMES | BESIDE:
            return True
    return False


def _out(n: Node, inside: bool) -> bool:
    """A node that is never part of the article, with all below it; ``inside``: of one."""
    if n.tag in NEVER or n.tag == "footer" or (n.tag == "header" and not inside):
        return True
    # a holder's names tell of the page, but an article can be a reader's comment
    if n.tag in HOLDERS:
        return n.tag == "article" and not n.names.isdisjoint(("comment", "reply", "ad", "advert", "sponsored", "related"))
    return n.role in ROLES or bool(n.names) and _chrome(n.names, HAZY if inside else frozenset())


def _marks(root: Node) -> tuple[set[int], dict[int, Node], list[Node]]:
    """Ids of nodes that are out; of nodes inside an article or main, the
    outermost one; all nodes in order."""
    out, holder, order, stack = set(), {}, [], [root]
    while stack:
        n = stack.pop()
        order.append(n)
        up = n.parent
        h = holder.get(id(up))
        if id(up) in out or _out(n, h is not None):
            out.add(id(n))
        elif h is not None or n.tag in ("article", "main") or n.role == "main":
            holder[id(n)] = h or n
        stack.extend(reversed(n.children))
    return out, holder, order


def _paths(order: list[Node]) -> dict[int, int]:
    """Hash of the labels from the root to each node; parents come first."""
    at: dict[int, int] = {}
    for n in order:
        at[id(n)] = xxhash.xxh64_intdigest(f"{at.get(id(n.parent), 0)}>{n.label}") - (1 << 63)
    return at


def _key(path: int, text: str) -> int:
    return xxhash.xxh64_intdigest(f"{path}\0{text}") - (1 << 63)


def _menu(b: Block) -> bool:
    return b.node.tag in ("li", "td", "dd") and b.linked * 2 > len(b.text) and len(b.text) < 100


def main_text(page: str | None, constants=frozenset()) -> str:
    """The text of one page, given its host's constants."""
    root, blocks = parse(page or "")
    out, holder, order = _marks(root)
    left = [b for b in blocks if id(b.node) not in out]
    marked = [b for b in left if id(b.node) in holder]
    articles = [b for b in marked if holder[id(b.node)].tag == "article" or _within(b.node, "article")]
    if articles or marked:
        left = articles or marked
    else:
        left = [b for b in left if not _menu(b)]
    if len(constants):
        path = _paths(order)
        left = [b for b in left if _key(path[id(b.node)], b.text) not in constants]
    return "\n".join(b.text for b in left)


def _within(n: Node, tag: str) -> bool:
    while n is not None and n.tag != tag:
        n = n.parent
    return n is not None


# -- the wrapper of a host ---------------------------------------------------------------
def shape(page: str) -> dict:
    """A page's tree as flat lists: for every block node in page order its depth,
    label, text and what it is."""
    root, blocks = parse(page)
    out, holder, order = _marks(root)
    texts = defaultdict(list)
    for b in blocks:
        texts[id(b.node)].append(b.text)
    path = _paths(order)
    # one text of a node: its key tells the block in main_text; several: each its own
    return {"depth": [n.depth for n in order], "path": [path[id(n)] for n in order],
            "label": [xxhash.xxh64_intdigest(n.label) - (1 << 63) for n in order],
            "keys": [[_key(path[id(n)], t) for t in texts[id(n)]] for n in order],
            "size": [list(map(len, texts[id(n)])) for n in order], "out": [id(n) in out for n in order],
            "marked": bool(holder)}


def _rising(pairs: list[tuple[int, int, int]], width: int) -> tuple[int, list[tuple[int, int]]]:
    """Of (p, q, weight), q below ``width``, the heaviest set in which p and q rise
    together: its weight and its (p, q).  Work grows with the pairs and a logarithm."""
    pairs = sorted(pairs, key=lambda x: (x[0], -x[1]))
    best = [(0, -1)] * (width + 1)               # a Fenwick tree of prefix maxima over q
    before, top = [], (0, -1)
    for k, (_, q, w) in enumerate(pairs):
        s, i = (0, -1), q
        while i:
            s = max(s, best[i])
            i &= i - 1
        before.append(s[1])
        now, i = (s[0] + w, k), q + 1
        top = max(top, now)
        while i <= width:
            best[i] = max(best[i], now)
            i += i & -i
    weight, k = top
    chosen = []
    while k >= 0:
        chosen.append(pairs[k][:2])
        k = before[k]
    return weight, chosen[::-1]


def matched(a: dict, b: dict) -> list[tuple[int, int]]:
    """Simple tree matching of two shapes: pairs of matched nodes."""
    def family(t):
        kids, last = [[] for _ in t["depth"]], {}
        for i, d in enumerate(t["depth"]):
            if i:
                kids[last[d - 1]].append(i)
            last[d] = i
        return kids

    def like(i, j):
        """Places (p, q) of the children of i and j that may match."""
        where = defaultdict(list)
        for q, y in enumerate(kb[j]):
            where[b["label"][y]].append(q)
        return [(p, q) for p, x in enumerate(ka[i]) for q in where.get(a["label"][x], ())]
    ka, kb = family(a), family(b)
    stack = [(0, 0)] if a["label"][0] == b["label"][0] else []
    may: dict[tuple[int, int], list] = {}
    while stack:
        i, j = stack.pop()
        may[i, j] = like(i, j)
        stack.extend((ka[i][p], kb[j][q]) for p, q in may[i, j])
    weight: dict[tuple[int, int], int] = {}
    chosen = {}
    # children before parents: both lists are in page order, so from the end
    for i, j in sorted(may, reverse=True):
        below, chosen[i, j] = _rising([(p, q, weight[ka[i][p], kb[j][q]]) for p, q in may[i, j]], len(kb[j]))
        weight[i, j] = below + 2 + (2 if a["keys"][i] and a["keys"][i] == b["keys"][j] else 0)
    out, stack = [], [(0, 0)] if may else []
    while stack:
        i, j = stack.pop()
        out.append((i, j))
        stack.extend((ka[i][p], kb[j][q]) for p, q in chosen[i, j])
    return out


def collapsed(s: dict) -> dict:
    """A shape as wrappers are learnt from: its tree with equal-labelled siblings as
    one node, and its texts' keys, each with its node and its size (0 for what is
    out by its names: it may be a constant, but says nothing about slots)."""
    kids, label, last = defaultdict(list), {}, {}
    for i, (d, p) in enumerate(zip(s["depth"], s["path"])):
        if p not in label:
            label[p] = s["label"][i]
            kids[last[d - 1] if i else None].append(p)
        last[d] = p
    depth, path, stack = [], [], [(0, p) for p in kids[None]]
    while stack:
        d, p = stack.pop()
        depth.append(d)
        path.append(p)
        stack.extend((d + 1, k) for k in reversed(kids[p]))
    place = {p: i for i, p in enumerate(path)}
    size: dict[int, int] = {}
    at: dict[int, int] = {}
    for p, ks, ns, o in zip(s["path"], s["keys"], s["size"], s["out"]):
        for k, n in zip(ks, ns):
            size[k] = max(size.get(k, 0), 0 if o else n)
            at[k] = place[p]
    return {"depth": depth, "path": path, "label": [label[p] for p in path],
            "keys": list(size), "size": list(size.values()), "at": list(at.values())}


def _texts(s: dict) -> dict:
    """A collapsed shape with the keys of each node's texts, as ``matched`` takes it."""
    keys: list[list[int]] = [[] for _ in s["path"]]
    for k, i in zip(s["keys"], s["at"]):
        keys[i].append(k)
    return {"depth": s["depth"], "label": s["label"], "keys": keys}


def likeness(a: dict, b: dict) -> float:
    """Share of two collapsed trees that simple tree matching matches."""
    m, n = len(a["path"]), len(b["path"])
    return 2 * len(matched({**a, "keys": [[]] * m}, {**b, "keys": [[]] * n})) / (m + n)


def nearest(tree: dict, leaders: list[dict]) -> int | None:
    """The place of the leader that a tree is most alike, if more than ``ALIKE``
    (matched nodes have equal paths, so most trees are told apart by these)."""
    paths, best, at = set(tree["path"]), ALIKE, None
    for i, g in enumerate(leaders):
        if 2 * len(paths & g["paths"]) > best * (len(tree["path"]) + len(g["path"])):
            share = 1.0 if tree["skel"] == g["skel"] else likeness(g, tree)
            if share > best:
                best, at = share, i
    return at


def held(pages: list[dict], most: float = MOST) -> Counter:
    """For each text how many of ``pages`` (as ``_texts`` gives them) hold it at
    nodes aligned with that of the first page that has it.

    Pages so late that a text of theirs alone cannot reach ``most`` of all pages
    are aligned with those before them, but not with those after."""
    count: Counter = Counter()
    seen: set[int] = set()
    for r, ref in enumerate(pages):
        if len(pages) - r < most * len(pages):
            break
        own = [set(ks) - seen for ks in ref["keys"]]
        count.update(k for ks in own for k in ks)
        for other in pages[r + 1:]:
            count.update(k for i, j in matched(ref, other) if own[i] for k in own[i].intersection(other["keys"][j]))
        seen.update(*own)
    return count


def induce(shapes: list[dict], support: int = 2) -> set[int]:
    """Constants of some pages of one template, few enough for memory: the texts that
    at least ``support + 1`` of them, and ``MOST`` of them, hold at aligned nodes.
    ``wrappers`` finds the same for all pages of all templates."""
    def common(which):
        return {k for k, n in held([texts[i] for i in which]).items() if n > support and n >= MOST * len(which)}
    texts, told = [_texts(s) for s in shapes], []
    same = common(range(len(shapes)))
    seen: set[int] = set()
    for i, s in enumerate(shapes):
        p = dict(zip(s["keys"], s["size"]))
        own = p.keys() - same
        size = sum(p[k] for k in own)
        # copies of a page differ in little, or repeat the slots of others
        if size and size >= LEAST_SLOTS * sum(p.values()) and 2 * sum(p[k] for k in own & seen) <= size:
            told.append(i)
        seen |= own
    return common(told) if len(told) > support else set()


TREE = ["depth", "path", "label"]
TEMPLATE = ["host", "template"]


def shapes(pages: DataFrame) -> DataFrame:
    """(host, hash, skel, keys, size, at, depth, path, label) of every page with host
    and html; the tree at its first page in a task alone, for others null."""
    names = ["host", "hash", "skel", "keys", "size", "at", *TREE]

    def run(batches):
        seen: set[tuple[str, int]] = set()
        for b in batches:
            for k in range(0, len(b), 500):
                rows = []
                for host, page in zip(b["host"][k:k + 500], b["html"][k:k + 500]):
                    s = collapsed(shape(page))
                    skel = xxhash.xxh64_intdigest(np.array([s["depth"], s["path"]], np.int64).tobytes()) - (1 << 63)
                    if len(seen) > 100_000:
                        seen.clear()
                    tree = [None] * 3 if (host, skel) in seen else [s[c] for c in TREE]
                    seen.add((host, skel))
                    rows.append((host, xxhash.xxh64_intdigest(page) - (1 << 63), skel, s["keys"], s["size"], s["at"], *tree))
                yield pd.DataFrame(rows, columns=names)
    return pages.select(host_of(F.col("url")).alias("host"), "html").filter("host IS NOT NULL AND html IS NOT NULL").mapInPandas(
        run, "host string, hash long, skel long, keys array<long>, size array<int>, at array<int>, "
        "depth array<int>, path array<long>, label array<long>")


def _streamed(trees: DataFrame, schema: str, row) -> DataFrame:
    """``row(tree, leaders)`` for the trees of each host and bucket in order, leaders
    first, then frequent ones; a task keeps the leaders of one group alone."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        group, leaders = None, []
        for b in batches:
            out = []
            for r in b.to_dict("records"):
                if (r["host"], r["bucket"]) != group:
                    group, leaders = (r["host"], r["bucket"]), []
                tree = {**r, **{c: list(r[c]) for c in TREE}, "paths": set(r["path"])}
                if (got := row(tree, leaders)) is not None:
                    out.append([got[c] for c in names])
            yield pd.DataFrame(out, columns=names)
    return spread(trees, "host", "bucket").sortWithinPartitions("host", "bucket", F.desc("lead"), F.desc("n"), "skel").mapInPandas(run, schema)


SKEL = "host string, skel long, n long, depth array<int>, path array<long>, label array<long>"


def leaders_of(trees: DataFrame, buckets: int) -> DataFrame:
    """The trees that are like no leader before them in their host's bucket."""
    def row(tree, leaders):
        if nearest(tree, leaders) is None:
            leaders.append(tree)
            return tree
    return _streamed(trees.withColumn("bucket", F.pmod("skel", F.lit(buckets))).withColumn("lead", F.lit(False)), SKEL, row)


def templates(trees: DataFrame) -> DataFrame:
    """(host, skel, template) of every distinct tree (``SKEL``) of each host; a
    template has the number of its leader."""
    def row(tree, leaders):
        if tree["lead"]:
            leaders.append(tree)
            return None
        at = nearest(tree, leaders)
        # a number that pandas does not make a double of
        return {**tree, "found": at is not None, "template": 0 if at is None else leaders[at]["skel"]}
    left, done = trees, None
    while True:
        # first within buckets, so that no task compares all trees of a host
        leaders = leaders_of(leaders_of(left, BUCKETS), 1)
        dealt = left.withColumn("bucket", F.pmod("skel", F.lit(BUCKETS))).withColumn("lead", F.lit(False))
        both = dealt.unionByName(leaders.join(dealt.select("host", "bucket").distinct(), "host").withColumn("lead", F.lit(True)))
        got = staged(_streamed(both, SKEL + ", found boolean, template long", row), "templates")
        now = got.filter("found").select("host", "skel", "template")
        done = now if done is None else done.unionByName(now)
        left = got.filter("NOT found").select("host", "skel", "n", *TREE)
        if left.isEmpty():               # every leader is found by itself, so fewer are left each time
            return done


def common(voters: DataFrame, trees: DataFrame, support: int) -> DataFrame:
    """(host, template, key): the texts that over ``support`` and ``MOST`` of all
    ``voters`` (distinct pages) of a template hold at nodes aligned with that of the
    first of them that has it."""
    often = (F.col("n") > support) & (F.col("n") >= F.lit(MOST) * F.col("pages"))
    sizes = voters.groupBy(*TEMPLATE).agg(F.count("*").alias("pages"))
    # held at all, before order decides: no more than a page holds divided by MOST
    may = staged(voters.select(*TEMPLATE, "hash", F.explode("keys").alias("key")).groupBy(*TEMPLATE, "key").agg(
        F.count("*").alias("n"), F.min("hash").alias("hash")).filter(F.col("n") > support).join(sizes, TEMPLATE).filter(often), "candidates")
    refs = (may.groupBy(*TEMPLATE, "hash").agg(F.collect_list("key").alias("own")).join(voters, [*TEMPLATE, "hash"])
            .join(trees, ["host", "skel"]).groupBy(*TEMPLATE)
            .agg(F.collect_list(F.struct("hash", "own", "depth", "path", "label", "keys", "at")).alias("refs")))

    def run(batches):
        for b in batches:
            count: Counter = Counter()
            for r in b.to_dict("records"):
                page, texts = set(r["keys"]), None
                for ref in r["refs"]:
                    own = page.intersection(ref["own"])
                    if own and ref["hash"] != r["hash"]:
                        texts = texts or _texts(r)
                        first = _texts(ref)
                        own = {k for i, j in matched(first, texts) for k in own.intersection(first["keys"][i]).intersection(texts["keys"][j])}
                    count.update((r["host"], r["template"], k) for k in own)
            yield pd.DataFrame([(*k, n) for k, n in count.items()], columns=[*TEMPLATE, "key", "n"])
    return (voters.join(refs, TEMPLATE).join(trees, ["host", "skel"]).select(*TEMPLATE, "hash", "depth", "path", "label", "keys", "at", "refs")
            .mapInPandas(run, "host string, template long, key long, n long").groupBy(*TEMPLATE, "key").agg(F.sum("n").alias("n"))
            .join(sizes, TEMPLATE).filter(often).select(*TEMPLATE, "key"))


def wrappers(pages: DataFrame, support: int = 2) -> DataFrame:
    """(host, constants): hosts whose wrapper changes anything."""
    found = staged(shapes(pages), "shapes")
    distinct = found.select("host", "hash", "skel", "keys", "size", "at").dropDuplicates(["host", "hash"])
    trees = found.filter("depth IS NOT NULL").groupBy("host", "skel").agg(*(F.first(c).alias(c) for c in TREE))
    often = distinct.groupBy("host", "skel").agg(F.count("*").alias("n"))
    trees = staged(trees.join(often, ["host", "skel"]).select("host", "skel", "n", *TREE), "trees")
    placed = staged(distinct.join(templates(trees), ["host", "skel"]), "pages")
    trees = trees.drop("n")
    same = staged(common(placed, trees, support), "common")

    # how much of a page's slots it is the first to hold
    flat = placed.select(*TEMPLATE, "hash", F.explode(F.arrays_zip("keys", "size")).alias("t")).select(
        *TEMPLATE, "hash", F.col("t.keys").alias("key"), F.col("t.size").alias("size"))
    shared = flat.groupBy(*TEMPLATE, "key").agg(F.count("*").alias("n"), F.min("hash").alias("first")).filter("n > 1").join(
        same.withColumn("same", F.lit(True)), [*TEMPLATE, "key"], "left")
    slot = F.col("same").isNull()
    told = (flat.join(shared, [*TEMPLATE, "key"], "left").groupBy(*TEMPLATE, "hash").agg(
        F.sum("size").alias("total"), F.sum(F.when(slot, F.col("size")).otherwise(0)).alias("own"),
        F.sum(F.when(slot & (F.col("first") != F.col("hash")), F.col("size")).otherwise(0)).alias("again"))
        .filter((F.col("own") > 0) & (F.col("own") >= F.lit(LEAST_SLOTS) * F.col("total")) & (2 * F.col("again") <= F.col("own"))))
    voters = placed.join(told.select(*TEMPLATE, "hash"), [*TEMPLATE, "hash"], "left_semi")
    return common(voters, trees, support).groupBy("host").agg(F.sort_array(F.collect_set("key")).alias("constants"))


def main_texts(pages: DataFrame, support: int = 2) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    learnt = staged(wrappers(pages, support), "wrappers")
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host_of(F.col("url")).alias("host"))

    def run(batches):
        for b in batches:
            text = [main_text(h, frozenset(() if c is None else c)) for h, c in zip(b["html"], b["constants"])]
            yield pd.DataFrame({"page_id": b["page_id"].astype("Int64"), "url": b["url"], "text": text, "n_chars": [len(t) for t in text]})
    return own.join(learnt, "host", "left").select("page_id", "url", "html", "constants").mapInPandas(
        run, "page_id long, url string, text string, n_chars long")
