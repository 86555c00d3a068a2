"""Hard-negative mining (operator 13) by threshold joins in the manner of L2AP.

A row's score with an anchor is the inner product of their whole-number vectors
(floor(256 * x)).  Every round joins the open anchors with all rows at a
threshold for each anchor.  Rows are taken in blocks, and each block gets an
inverted index: dimensions in order of falling energy, in groups of ``GROUP``,
the postings of a group being the rows that index it.  A row omits the groups
from where its suffix norm times the longest anchor stays below the least
threshold.  Anchors, in batches that tasks read from the shared folder, add up
partial scores group by group; rows whose partial scores plus the product of the
remaining norms reach no anchor's threshold are dropped on the way, and the
pairs that are left get their omitted dimensions.  A block gives at most k rows
for each anchor and window, so what is shuffled does not grow with pairs.

Positives first: thresholds fall by round until an anchor has its k rows of the
same label, which no lower threshold can better.  Each positive's score then sets a window
(half of it up to 95 hundredths of it); thresholds inside it fall from its upper
end until enough rows of other labels are found, down to the lower end.

Defined cases: rows with a null id or label, a null vector or a null or
non-finite entry take no part, nor do rows whose whole-number vector is 2 ** 31
long or more (scores would not fit a long); shorter vectors count as filled up
with zeros; equal scores come by smaller id, then in any one order; a repeated
row is a row of its own, another than the anchor it equals; an anchor without
positives, or with windows that hold no row, gives none.  An empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripforge.llm.common import keys, open_fs, scratch_path, spread, staged

GROUP = 8
BLOCK = 4096                  # rows indexed at a time
BATCH = 256                   # anchors at a time
ALL = -(2 ** 63) + 1          # a threshold that every score reaches
EXACT = 2.0 ** 53             # inner products below this are exact in doubles
HITS = "anchor long, place int, score long, vec_id long, key long"
OUTPUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mining_rows(df: DataFrame, vector: str = "embedding", scale: int = 256, relabel: int = 7, labels: int = 10) -> DataFrame:
    """(key, vec_id, label, q): the rows that take part; where ``relabel`` divides
    the id, the label is the next one of ``labels``."""
    c = F.col(vector).cast("array<double>")
    sound = F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(2.0 ** 31 / scale)))
    vec_id, label = F.col("vec_id").cast("long"), F.col("label").cast("long")
    rows = (df.select(vec_id.alias("vec_id"), F.when(vec_id % relabel == 0, F.pmod(label + 1, F.lit(labels))).otherwise(label).alias("label"),
                      F.when(sound, F.transform(c, lambda e: F.floor(e * F.lit(float(scale))))).alias("q"))
            .filter("vec_id IS NOT NULL AND label IS NOT NULL AND q IS NOT NULL")
            .filter(F.aggregate("q", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double")) < F.lit(2.0 ** 62)))
    d = rows.agg(F.max(F.size("q"))).first()[0] or 0
    filled = F.concat("q", F.array_repeat(F.lit(0).cast("long"), F.lit(d) - F.size("q")))
    return rows.select(keys().alias("key"), "vec_id", "label", filled.alias("q"))


def matrix(column: pa.Array, rows: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(rows, len(flat) // rows if rows else 0)


class BlockIndex:
    """The inverted index of a block of rows for anchors no longer than
    ``longest`` and thresholds not below ``least``."""

    def __init__(self, q: np.ndarray, longest: float, least: float):
        self.d = q.shape[1]
        self.order = np.argsort(-(q.astype(float) ** 2).sum(0), kind="stable")
        y = q[:, self.order]
        self.norms = self.suffix_norms(y)
        self.groups = self.norms.shape[1] - 1
        # the first group from which on the rest of a row cannot lift a pair to a threshold
        self.first = (self.norms * longest >= least).sum(1) if np.isfinite(least) else np.full(len(y), self.groups + 1)
        self.first = np.minimum(self.first, self.groups)
        self.rows = np.argsort(-self.first, kind="stable")
        self.first, self.norms, self.y = self.first[self.rows], self.norms[self.rows], y[self.rows]

    @staticmethod
    def suffix_norms(v: np.ndarray) -> np.ndarray:
        """The length of each row's dimensions from each group's start, and 0."""
        starts = np.arange(0, v.shape[1], GROUP)
        energy = np.add.reduceat(v.astype(float) ** 2, starts, axis=1) if len(starts) else np.zeros((len(v), 0))
        tail = np.cumsum(energy[:, ::-1], axis=1)[:, ::-1]
        # a little longer than it is, so that rounding never prunes a pair at its threshold
        return np.concatenate([np.sqrt(tail) * (1 + 1e-9), np.zeros((len(v), 1))], axis=1)

    def scores(self, anchors: np.ndarray, thresholds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(anchors x rows of scores, the rows): every pair that reaches the
        anchor's threshold has its score; those pruned have the least long."""
        a = anchors[:, self.order]
        lengths = self.suffix_norms(a)
        big = lengths.max(initial=0) * self.norms.max(initial=0) >= EXACT
        kind = np.int64 if big else float
        x, y, first, norms, rows = a.astype(kind), self.y.astype(kind), self.first, self.norms, self.rows
        part = np.zeros((len(a), len(y)), kind)
        for g in range(self.groups):
            k = int(np.searchsorted(-first, -g, side="left"))          # rows that index this group
            if not k:
                break
            s = slice(g * GROUP, (g + 1) * GROUP)
            part[:, :k] += x[:, s] @ y[:k, s].T
            if g % 2 and g + 1 < self.groups:
                reach = np.minimum(first, g + 1)
                rest = lengths[:, g + 1:g + 2] * norms[np.arange(len(y)), g + 1][None, :]
                # rows that stopped before have their own, longer, rest
                early = reach < g + 1
                if early.any():
                    rest[:, early] = lengths[:, first[early]] * norms[early, first[early]][None, :]
                alive = (part + rest >= thresholds[:, None] - 1e-6).any(0)
                if alive.sum() < 0.7 * len(y):
                    part, y, first, norms, rows = part[:, alive], y[alive], first[alive], norms[alive], rows[alive]
        open_rows = np.flatnonzero(first < self.groups)
        out = part.astype(np.int64)
        if len(open_rows):
            f = first[open_rows]
            bound = part[:, open_rows] + lengths[:, f] * norms[open_rows, f][None, :]
            i, j = np.nonzero(bound >= thresholds[:, None] - 1e-6)
            out[:, open_rows] = np.iinfo(np.int64).min
            for at in range(0, len(i), 1 << 15):
                m, r = i[at:at + (1 << 15)], open_rows[j[at:at + (1 << 15)]]
                out[m, r] = np.einsum("ij,ij->i", x[m], y[r]).astype(np.int64)
        return out, rows


def best(score: np.ndarray, fits: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, row) places of the first ``k`` fitting rows of each anchor, by falling score and id."""
    if not fits.any():
        return np.zeros(0, int), np.zeros(0, int)
    s = np.where(fits, score, np.iinfo(np.int64).min)
    if s.shape[1] > k:
        fits = fits & (s >= np.partition(s, s.shape[1] - k, axis=1)[:, -k][:, None])
    i, j = np.nonzero(fits)
    order = np.lexsort((ids[j], -s[i, j], i))
    i, j = i[order], j[order]
    at = np.arange(len(i)) - np.searchsorted(i, i)
    return i[at < k], j[at < k]


def threshold_join(rows: DataFrame, anchors: str, same_label: bool, k: int) -> DataFrame:
    """HITS of all rows with the anchors written in folder ``anchors`` (key, label, q,
    low: a threshold for each window, high): up to ``k`` a window from each block."""
    def batches() -> Iterator[tuple]:
        from pyarrow import fs as pafs

        f, path = open_fs(anchors)
        for info in sorted(f.get_file_info(pafs.FileSelector(path)), key=lambda i: i.path):
            if info.path.endswith(".parquet"):
                with f.open_input_file(info.path) as file:
                    for b in pq.ParquetFile(file).iter_batches(batch_size=BATCH):
                        n = len(b)
                        if n:
                            yield (b["key"].to_numpy(), b["label"].to_numpy(), matrix(b["q"], n),
                                   matrix(b["low"], n), matrix(b["high"], n))

    def joined(block: pa.Table) -> Iterator[pa.RecordBatch]:
        key, vec_id, label = (block[c].to_numpy() for c in ("key", "vec_id", "label"))
        q = matrix(block["q"].combine_chunks(), len(block))
        longest, least = 0.0, np.inf
        for _, _, a, low, _ in batches():
            longest = max(longest, float(np.sqrt((a.astype(float) ** 2).sum(1)).max(initial=0)))
            least = min(least, float(low.min()))
        index = BlockIndex(q, longest * (1 + 1e-9), least if least > ALL else -np.inf)
        for a_key, a_label, a, low, high in batches():
            score, at = index.scores(a, low.min(1).astype(float))
            pairs = a_label[:, None] == label[at][None, :]
            pairs = pairs & (a_key[:, None] != key[at][None, :]) if same_label else ~pairs
            for w in range(low.shape[1]):
                i, j = best(score, pairs & (score >= low[:, w:w + 1]) & (score <= high[:, w:w + 1]), vec_id[at], k)
                if len(i):
                    r = at[j]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(a_key[i]), pa.array(np.full(len(i), w, np.int32)), pa.array(score[i, j]),
                         pa.array(vec_id[r]), pa.array(key[r])], ["anchor", "place", "score", "vec_id", "key"])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for p in parts:
            for at in range(0, len(p), BLOCK):
                held.append(p.slice(at, BLOCK))
                size += len(held[-1])
                if size >= BLOCK:
                    yield from joined(pa.Table.from_batches(held))
                    held, size = [], 0
        if size:
            yield from joined(pa.Table.from_batches(held))
    return rows.mapInArrow(run, HITS)


def _first(hits: DataFrame, k: int) -> DataFrame:
    by = Window.partitionBy("anchor", "place").orderBy(F.col("score").desc(), "vec_id", "key")
    return hits.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)


def _written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def positives(rows: DataFrame, anchors: DataFrame, k: int, steps: tuple = (0.5, 0.35, 0.2)) -> DataFrame:
    """(anchor, score, vec_id, rank): the first ``k`` other rows of each anchor's label.

    The threshold falls from a share of the anchor's own squared length to the
    next, then to none."""
    squared = F.aggregate("q", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double"))
    still, out = anchors, None
    for step in (*steps, None):
        low = F.lit(ALL) if step is None else F.floor(squared * F.lit(step))
        asked, path = _written(still.select("key", "label", "q", F.array(low.cast("long")).alias("low"),
                                            F.array(F.lit(2 ** 63 - 1)).alias("high")), "negatives-anchors")
        got = staged(_first(threshold_join(rows, path, True, k), k), "negatives-positives")
        if step is not None:
            full = got.filter(F.col("rank") == k).select(F.col("anchor").alias("key"))
            still = staged(asked.drop("low", "high").join(full, "key", "left_anti"), "negatives-open")
            got = got.join(full.withColumnRenamed("key", "anchor"), "anchor", "left_semi")
        out = got if out is None else out.unionByName(got)
        if step is None or still.isEmpty():
            return out.select("anchor", "score", "vec_id", "rank")
    return out


def mine(df: DataFrame, vector: str = "embedding", every: int = 50, n_positives: int = 5, n_negatives: int = 3,
         steps: tuple = (0.1, 0.4), scale: int = 256, relabel: int = 7, labels: int = 10) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)."""
    rows = staged(mining_rows(df, vector, scale, relabel, labels), "negatives-rows")
    anchors = staged(spread(rows.filter(F.col("vec_id") % every == 0)), "negatives-queries")
    found = staged(positives(rows, anchors, n_positives), "negatives-positives")

    # a window for each score of a positive: half of it <= score <= 95 hundredths of it
    score = F.col("score")
    high, low = F.expr("score - score div 20 - cast(score % 20 != 0 as int)"), F.expr("score div 2 + score % 2")
    windows = staged(found.filter(score >= 0).select(
        "anchor", F.col("score").alias("positive_score"), low.alias("lowest"), high.alias("highest"))
        .distinct().filter("lowest <= highest"), "negatives-windows")
    still, out = windows, None
    for step in (*steps, 1.0):
        # the upper end less a share of the window; at last its lower end
        least = F.greatest("lowest", F.col("highest") - F.ceil((F.col("highest") - F.col("lowest")) * F.lit(step))) if step < 1 else F.col("lowest")
        most = F.row_number().over(Window.partitionBy("anchor").orderBy("positive_score")) - 1
        placed = staged(still.withColumn("place", most.cast("int")).withColumn("least", least), "negatives-placed")
        # as many windows for each anchor: those it lacks are empty
        sides = placed.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "least", "highest"))).alias("w"))

        def filled(name: str, empty: int):
            side = F.transform("w", lambda s: s[name])
            return F.concat(side, F.array_repeat(F.lit(empty), F.lit(n_positives) - F.size("w")))
        asked = (anchors.join(sides, anchors["key"] == sides["anchor"])
                 .select("key", "label", "q", filled("least", 2 ** 63 - 1).alias("low"), filled("highest", ALL).alias("high")))
        _, path = _written(asked, "negatives-anchors")
        hits = _first(threshold_join(rows, path, False, n_negatives), n_negatives)
        got = staged(hits.join(placed.select("anchor", "place", "positive_score"), ["anchor", "place"])
                     .select("anchor", "positive_score", "rank", "score", "vec_id"), "negatives-found")
        if step < 1:
            full = got.filter(F.col("rank") == n_negatives).select("anchor", "positive_score")
            still = staged(placed.drop("place", "least").join(full, ["anchor", "positive_score"], "left_anti"), "negatives-open")
            got = got.join(full, ["anchor", "positive_score"], "left_semi")
        out = got if out is None else out.unionByName(got)
        if step == 1 or still.isEmpty():
            break
    return (found.select("anchor", F.col("score").alias("positive_score"), F.col("vec_id").alias("positive_id"))
            .join(out, ["anchor", "positive_score"])
            .join(anchors.select(F.col("key").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor")
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))
