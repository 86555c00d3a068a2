"""SimHash near-duplicates by tiled exact comparison of 64-bit fingerprints.

Fingerprint: A-Z lower-cased, words joined by one space into shingles of
``shingle`` words with repeats (a text of fewer words is one shingle; a text
without words has fingerprint zero); a bit is set when it is set in more than
half of the shingles' XXH64 hashes (UTF-8, seed 42).  Fingerprints link when
they differ in at most ``radius`` bits; components of links are the groups.

Exact copies and equal fingerprints meet first, by a grouping with map-side
minimum, so a group of copies of any size is one fingerprint afterwards.
Distinct fingerprints are then compared exactly, tile against tile: the 64
bits are cut into ``radius + 1`` blocks, and two fingerprints within the radius
agree on one block at least, so tiles only hold fingerprints that agree on a
block.  Inside a tile, and between the tiles of one large block value, the
rows are ordered by population count, pairs of tiles (and of strips inside a
tile) whose counts differ beyond the radius are skipped, and the rest are
compared by numpy exclusive-or and bit counts.  A block value of more than
``tile`` fingerprints is cut into tiles by population count and hash, and its
tile pairs are spread over tasks.  A tile pair returns a spanning forest of its
links (as many rows as fingerprints at most), never all its pairs.

Null text counts as empty.  Rows with a null ``doc_id`` take part; the smallest
non-null id names the component (null when there is none).  Repeated rows and
ties fall into one group.  Extra columns are ignored.  An empty table gives no
rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripforge.llm.common import bits_of, give_back, marked, numbered, small_batches, staged
from tripforge.llm.components import components

SEED = 42
CHUNK = 1 << 15


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The 64-bit fingerprint of one text, unsigned."""
    words = (text or "").encode("utf-8").lower().split()  # ASCII only, both
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    starts, ends = starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist()
    h64, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for i in range(0, len(starts), CHUNK):
        h = np.array([h64(joined[s:e], SEED) for s, e in zip(starts[i:i + CHUNK], ends[i:i + CHUNK])], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns of ``carry``, and fp: the fingerprint as a signed 64-bit integer."""
    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in b["text"]], np.uint64)
            yield b[list(carry)].assign(fp=fp.view(np.int64))
        give_back()
    types = dict(docs.dtypes)
    return docs.select(*carry, "text").mapInPandas(run, ", ".join(f"{c} {types[c]}" for c in carry) + ", fp long")


def forest(fps: np.ndarray, keys: np.ndarray, side: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links among rows of equal key; with ``side``, of
    those between the two sides only.  Rows come ordered by key and population
    count, so each row's partners lie in one stretch after it."""
    n = len(fps)
    pop = np.bitwise_count(fps).astype(np.int64)
    # last row of the same key whose count is within the radius
    rank = np.concatenate(([0], np.cumsum(keys[1:] != keys[:-1]))) * 128 + pop if n else pop
    last = np.searchsorted(rank, rank + radius, side="right")
    parent = np.arange(n)

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i
    strip = 256
    for i in range(0, n, strip):
        j1 = int(last[i:i + strip].max())
        near = np.bitwise_count(fps[i:i + strip, None] ^ fps[None, i:j1]) <= radius
        near &= np.arange(i, j1)[None, :] > np.arange(i, min(n, i + strip))[:, None]
        near &= keys[i:i + strip, None] == keys[None, i:j1]
        if side is not None:
            near &= side[i:i + strip, None] != side[None, i:j1]
        for a, b in zip(*(x.tolist() for x in np.nonzero(near))):
            ra, rb = root(i + a), root(i + b)
            if ra != rb:
                parent[max(ra, rb)] = min(ra, rb)
    roots = np.array([root(i) for i in range(n)], np.int64)
    moved = np.nonzero(roots != np.arange(n))[0]
    return moved, roots[moved]


def links(distinct: DataFrame, radius: int = 2, tile: int = 4096) -> DataFrame:
    """(a, b): links that connect what lies within the radius, for a table of
    distinct fingerprints ``fp``."""
    n_blocks = radius + 1
    cuts = [64 * i // n_blocks for i in range(n_blocks + 1)]
    blocks = distinct.select("fp", F.bit_count("fp").cast("int").alias("pop"), F.explode(F.array(*[
        F.struct(F.lit(i).alias("block"), F.expr(
            f"shiftrightunsigned(shiftleft(fp, {64 - cuts[i + 1]}), {64 - cuts[i + 1] + cuts[i]})").alias("value"))
        for i in range(n_blocks)])).alias("k")).select("fp", "pop", "k.block", "k.value")
    rows = staged(blocks, "blocks")
    # only block values that several fingerprints share can hold a link
    counts = rows.groupBy("block", "value", "pop").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("block", "value").agg(F.sum("n").alias("total")).filter("total > 1")
    counts, totals = staged(counts.join(totals, ["block", "value"]), "counts"), staged(totals, "totals")
    rows = rows.join(totals, ["block", "value"])
    n_small = totals.filter(F.col("total") <= tile).agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    bins = max(1, -(-n_small // (4 * tile)))

    def small_bins(pdf: pd.DataFrame) -> pd.DataFrame:
        fps = pdf["fp"].to_numpy().view(np.uint64)
        key = pdf.groupby(["block", "value"], sort=False).ngroup().to_numpy()
        o = np.lexsort((np.bitwise_count(fps), key))
        a, b = forest(fps[o], key[o], None, radius)
        return pd.DataFrame({"a": fps[o][a].view(np.int64), "b": fps[o][b].view(np.int64)})

    small = (rows.filter(F.col("total") <= tile)
             .withColumn("bin", F.pmod(F.xxhash64("block", "value"), F.lit(bins)))
             .groupBy("bin").applyInPandas(small_bins, "a long, b long"))

    # tiles of the large block values: a population count, cut further by hash
    cut = (F.ceil(F.col("n") / F.lit(tile))).cast("long")
    tiles = (counts.filter(F.col("total") > tile).withColumn("cuts", cut)
             .select("block", "value", "pop", "cuts", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cuts") - 1))
                     .alias("cut")))
    left = tiles.select("block", "value", F.col("pop").alias("pop1"), F.col("cut").alias("cut1"))
    right = tiles.select("block", "value", F.col("pop").alias("pop2"), F.col("cut").alias("cut2"))
    pairs = left.join(right, ["block", "value"]).filter(
        F.col("pop2").between(F.col("pop1"), F.col("pop1") + radius)
        & ((F.col("pop1") < F.col("pop2")) | (F.col("cut1") <= F.col("cut2"))))
    sided = pairs.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("side")).select(
        "*", F.when(F.col("side") == 0, F.col("pop1")).otherwise(F.col("pop2")).alias("pop"),
        F.when(F.col("side") == 0, F.col("cut1")).otherwise(F.col("cut2")).alias("cut")).filter(
        "side = 0 OR pop1 <> pop2 OR cut1 <> cut2")
    large = (rows.filter(F.col("total") > tile)
             .join(counts.select("block", "value", "pop", cut.alias("cuts")), ["block", "value", "pop"])
             .withColumn("cut", F.pmod(F.xxhash64("fp"), F.col("cuts")))
             .join(sided, ["block", "value", "pop", "cut"]))

    def tile_pair(pdf: pd.DataFrame) -> pd.DataFrame:
        fps, side = pdf["fp"].to_numpy().view(np.uint64), pdf["side"].to_numpy()
        o = np.lexsort((side, np.bitwise_count(fps)))
        a, b = forest(fps[o], np.zeros(len(o), np.int64), side[o] if side.any() else None, radius)
        return pd.DataFrame({"a": fps[o][a].view(np.int64), "b": fps[o][b].view(np.int64)})

    hot = large.groupBy("block", "value", "pop1", "cut1", "pop2", "cut2").applyInPandas(tile_pair, "a long, b long")
    return small.unionByName(hot)


def _with_component(reps: DataFrame, radius: int, tile: int) -> DataFrame:
    """Distinct fingerprints with the component each lies in."""
    comp = components(links(reps.select("fp"), radius, tile), "a", "b")
    return reps.join(comp.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp"))


def simhash_groups(docs: DataFrame, shingle: int = 3, radius: int = 2, tile: int = 4096) -> DataFrame:
    """(doc_id, fp, component_id): one row per document."""
    with small_batches(docs.sparkSession):
        fp = staged(fingerprints(docs, shingle), "fingerprints")
    reps = staged(fp.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    named = _with_component(reps, radius, tile)
    least = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = staged(named.join(least, "component").select("fp", "component_id"), "components")
    return fp.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 2, tile: int = 4096) -> DataFrame:
    """One row of each group: the one with the smallest ``doc_id``, rows without
    id last; of equal ids, and of rows without id, the one that hashes lowest.
    Rows are told apart by a key of their own, never by ``doc_id``."""
    plain = [f"`{c}`" for c, t in docs.dtypes if "map<" not in t]      # maps have no hash
    keyed = numbered(docs)
    hashed = keyed.withColumn("__hash", F.xxhash64(*plain))
    with small_batches(docs.sparkSession):
        fp = staged(fingerprints(hashed, shingle, ("doc_id", "__hash", "__row")), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__hash", "__row"))
    reps = staged(fp.groupBy("fp").agg(first.alias("first")), "distinct")
    kept = staged(bits_of(_with_component(reps, radius, tile).groupBy("component").agg(F.min("first").alias("first"))
                          .select("first.__row")), "kept")
    return marked(keyed, kept, "__kept").filter("__kept").select(*[F.col(f"`{c}`") for c in docs.columns])
