"""Benchmark decontamination by spaced-seed hashing.

Texts are lower-cased and cut into words of ASCII letters and digits and all
characters beyond ASCII.  A seed is a fixed mask over ``SPAN`` words: the hash
of the words at its ones, whatever stands at its zeros.  Training positions and
benchmark positions with equal seed hashes are joined; around each such hit the
two texts are aligned word by word, without gaps, and the stretch with the best
score (+1 for an equal word, -2 for a substituted one) must hold ``min_words``
equal words at a share of ``min_share`` or more; where it does not, the stretch
with the most equal words among all that do is taken.  Of an item too short for
``min_words`` at that share, the share of its own words is asked for.  Items
shorter than ``SPAN`` words are sought by masks of their own length, which ignore
as many words as may be substituted; items under ``MIN_ITEM`` words match where
they are a whole line or a whole text, word for word.

Equal benchmark texts are one item, named by the smallest ``item_id``.  Null and
empty texts on either side match nothing.  Repeated rows of an id are one
document here.  A null ``doc_id`` is reported as such.  Extra columns are ignored; empty
tables give no rows.

The benchmark's hashes set bits in a map of fixed size (``2 ** BITS`` bits, 8
MB), which tasks test before anything is shuffled; it only saves work, as the
join decides.  Of a document with hits only the words around them travel, as
64-bit word hashes, so texts never move.  A seed that thousands of documents
hold meets one row for each distinct benchmark text that holds it.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripforge.llm.common import bits_of, give_back, marked, numbered, small_batches, staged
from tripforge.llm.hashing import ODD, hash_words, mixed

# Fixed masks.  The places fall into four groups of three, and each mask ignores two
# of the groups, so for any two substituted words of 12 some mask ignores both.
MASKS = ("001110011100", "010100111001", "011010100101", "100101011010", "101011000110", "110001100011")
SPAN = 12
MIN_ITEM = 5
BITS = 26
REACH = 48                       # words looked at on either side of a seed

_LETTERS = np.array([chr(b).isalnum() for b in range(256)], bool)
_LETTERS[128:] = True


def word_hashes(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every word of all texts in order, first word of each text
    and one past the last)."""
    return hash_words([(t or "").lower().encode("utf-8") for t in texts], _LETTERS)


def seed_hashes(words: np.ndarray, mask: str) -> np.ndarray:
    """The mask's hash at every place where it fits."""
    with np.errstate(over="ignore"):
        n = len(words) - len(mask) + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        h = np.full(n, np.uint64(int("1" + mask, 2)), np.uint64)
        for i, c in enumerate(mask):
            if c == "1":
                h = h * ODD + words[i:i + n]
        return mixed(h)


def needed(size: int, min_words: int, min_share: float) -> int:
    """Equal words that an item of ``size`` words must have."""
    if size < MIN_ITEM:
        return size
    return max(1, min(min_words, math.ceil(min_share * size - 1e-9)))


def short_masks(size: int, min_share: float) -> list[str]:
    """Masks of an item's own length: its words fall into groups, and for any
    words that may be substituted some mask ignores their groups."""
    wrong = size - needed(size, size, min_share)
    groups = min(wrong + 2, size)
    of = [i * groups // size for i in range(size)]
    return ["".join("0" if g in gone else "1" for g in of) for gone in itertools.combinations(range(groups), wrong)]


def masks_for(item_sizes: set[int], min_share: float = 0.8) -> list[str]:
    return list(MASKS) + [m for n in sorted(item_sizes) if 0 < n < SPAN for m in short_masks(n, min_share)]


def best_stretch(equal: np.ndarray) -> tuple[int, int]:
    """The stretch of the highest sum of +1 (equal) and -2 (not)."""
    s = np.concatenate(([0], np.cumsum(np.where(equal, 1, -2))))
    low = np.minimum.accumulate(s)
    end = int(np.argmax(s - low))
    return int(np.argmin(s[:end + 1])), end


def any_stretch(equal: np.ndarray, least: int, share: float) -> tuple[int, int] | None:
    """Of the stretches with ``least`` equal words at ``share`` or more the one
    with the most equal words, then the shortest, then the first."""
    have = np.concatenate(([0], np.cumsum(equal)))
    over = have - share * np.arange(len(have))
    # the leftmost start that an end still bears holds the most equal words
    start = np.searchsorted(-np.minimum.accumulate(over), -over - 1e-9)
    n = have - have[start]
    n[n < max(1, least)] = 0
    if not n.any():
        return None
    found = []
    for e in np.flatnonzero(n == n.max()).tolist():
        inside = np.flatnonzero(equal[start[e]:e]) + start[e]
        found.append((int(inside[-1] + 1 - inside[0]), int(inside[0])))
    size, s = min(found)
    return s, s + size


def item_seeds(items: DataFrame, masks: list[str]) -> DataFrame:
    """(hash, item_id, at, mask) for every item."""
    def run(batches):
        for b in batches:
            words, first = word_hashes(b["text"].tolist())
            rows = []
            for i, item in enumerate(b["item_id"]):
                w = words[first[i]:first[i + 1]]
                for k, m in enumerate(masks):
                    if len(m) == SPAN or len(m) == len(w):
                        h = seed_hashes(w, m)
                        rows.append(pd.DataFrame({"hash": h.view(np.int64), "item_id": item, "at": np.arange(len(h)), "mask": np.int32(k)}))
            if rows:
                yield pd.concat(rows)
    return items.select("item_id", "text").mapInPandas(run, "hash long, item_id long, at long, mask int")


def item_words(items: DataFrame) -> DataFrame:
    """(item_id, words): the items' word hashes."""
    def run(batches):
        for b in batches:
            words, first = word_hashes(b["text"].tolist())
            yield pd.DataFrame({"item_id": b["item_id"].astype("Int64"), "words": [
                words[first[i]:first[i + 1]].view(np.int64) for i in range(len(b))]})
    return items.select("item_id", "text").mapInPandas(run, "item_id long, words array<long>")


def _bit_map(seeds: DataFrame) -> np.ndarray:
    """Bits of the hashes that occur: at most 2 ** (BITS - 6) rows of 64 bits."""
    place = F.shiftrightunsigned("hash", 64 - BITS)
    rows = seeds.groupBy(F.shiftright(place, 6).alias("w")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, CAST(shiftrightunsigned(hash, {64 - BITS}) & 63 AS INT))")).alias("bits")).toPandas()
    bits = np.zeros(1 << (BITS - 6), np.int64)
    bits[rows["w"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    return bits.view(np.uint64)


def overlaps(docs: DataFrame, benchmark: DataFrame, min_words: int = 12, min_share: float = 0.8) -> DataFrame:
    """(doc_id, item_id, first_word, n_words, n_equal): the best verified overlap
    of each document and benchmark text; ``n_words`` spans the substitutions too."""
    spark = docs.sparkSession
    items = staged(benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text IS NOT NULL")
                   .groupBy("text").agg(F.min("item_id").alias("item_id")), "items")
    texts = staged(item_words(items).groupBy("words").agg(F.min("item_id").alias("item_id"))
                   .filter(F.size("words") > 0), "item-words")
    short = {r[0] for r in texts.filter(F.size("words") < SPAN).select(F.size("words")).distinct().collect()}
    masks = masks_for(short, min_share)
    seeds = staged(item_seeds(items.join(texts.select("item_id"), "item_id", "left_semi"), masks), "item-seeds")
    bits = spark.sparkContext.broadcast(_bit_map(seeds))

    def hits(batches):
        for b in batches:
            for lo in range(0, len(b), 2000):
                yield from _hits(b.iloc[lo:lo + 2000], masks, bits.value)
        give_back()

    with small_batches(spark):
        found = staged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(
            hits, "doc_id long, first long, words array<long>, at array<long>, mask array<int>, hash array<long>"), "hits")
    # candidates: a stretch of a document and a diagonal of an item
    keyed = found.select(F.monotonically_increasing_id().alias("stretch"), "*")
    keyed = staged(keyed, "stretches")
    flat = keyed.select("stretch", F.explode(F.arrays_zip("at", "mask", "hash")).alias("h")).select(
        "stretch", "h.at", "h.mask", "h.hash")
    cand = (flat.join(seeds.select("hash", "mask", "item_id", F.col("at").alias("item_at")), ["hash", "mask"])
            .select("stretch", "item_id", (F.col("at") - F.col("item_at")).alias("shift"))
            .distinct())
    pairs = (cand.join(keyed.select("stretch", "doc_id", "first", "words"), "stretch")
             .join(texts.select("item_id", F.col("words").alias("item")), "item_id"))

    def verify(batches):
        for b in batches:
            rows = []
            for doc, item_id, first, shift, words, item in zip(*(b[c] for c in (
                    "doc_id", "item_id", "first", "shift", "words", "item"))):
                w, q = np.asarray(words), np.asarray(item)
                lo, hi = max(0, -shift), min(len(q), len(w) - shift)
                equal = w[lo + shift:hi + shift] == q[lo:hi]
                need = needed(len(q), min_words, min_share)
                s, e = best_stretch(equal)
                n = int(equal[s:e].sum())
                if n < need or n < min_share * (e - s):      # others can pass where the best one does not
                    s, e = any_stretch(equal, need, min_share) or (0, 0)
                    n = int(equal[s:e].sum())
                if n:
                    rows.append((None if pd.isna(doc) else int(doc), int(item_id), int(first + shift + lo + s), e - s, n))
            out = pd.DataFrame(rows, columns=["doc_id", "item_id", "first_word", "n_words", "n_equal"])
            yield out.astype({"doc_id": "Int64"})
    good = pairs.mapInPandas(verify, "doc_id long, item_id long, first_word long, n_words long, n_equal long")
    best = good.groupBy("doc_id", "item_id").agg(F.max(F.struct(
        "n_equal", (-F.col("n_words")).alias("n"), (-F.col("first_word")).alias("f"))).alias("best"))
    return best.select("doc_id", "item_id", (-F.col("best.f")).alias("first_word"),
                       (-F.col("best.n")).alias("n_words"), F.col("best.n_equal").alias("n_equal"))


def _sizes_at(first: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` words the size of the text that starts there, or zero."""
    out, size = np.zeros(n, np.int64), np.diff(first)
    out[first[:-1][size > 0]] = size[size > 0]
    return out


def _hits(b: pd.DataFrame, masks: list[str], bits: np.ndarray):
    """A row for each stretch of words around places that the bit map lets through."""
    texts = b["text"].tolist()
    words, first = word_hashes(texts)
    doc_of = np.repeat(np.arange(len(b)), np.diff(first))
    at, mask, hashes = [], [], []
    if any(len(m) < MIN_ITEM for m in masks):
        # the words are the same line by line; size of the line and text that start at a word
        line = word_hashes([x for t in texts for x in (t or "").splitlines()])[1]
        of_line, of_text = (_sizes_at(ends, len(words)) for ends in (line, first))
    for k, m in enumerate(masks):
        h = seed_hashes(words, m)
        place = (h >> np.uint64(64 - BITS)).astype(np.int64)
        hit = np.flatnonzero((bits[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1))
        hit = hit[doc_of[hit] == doc_of[hit + len(m) - 1]]
        if len(m) < MIN_ITEM:
            hit = hit[(of_line[hit] == len(m)) | (of_text[hit] == len(m))]
        at.append(hit)
        mask.append(np.full(len(hit), k, np.int32))
        hashes.append(h[hit])
    at, mask, hashes = np.concatenate(at), np.concatenate(mask), np.concatenate(hashes)
    if not len(at):
        return
    o = np.lexsort((mask, at))
    at, mask, hashes = at[o], mask[o], hashes[o]
    doc = doc_of[at]
    # stretches: runs of hits of one document not further apart than the reach
    cut = np.flatnonzero((np.diff(at) > REACH) | (np.diff(doc) > 0)) + 1
    rows = []
    for s, e in zip(np.concatenate(([0], cut)), np.concatenate((cut, [len(at)]))):
        d = doc[s]
        lo, hi = max(first[d], at[s] - REACH), min(first[d + 1], at[e - 1] + SPAN + REACH)
        rows.append((b["doc_id"].iat[d], lo - first[d], words[lo:hi].view(np.int64), at[s:e] - lo, mask[s:e], hashes[s:e].view(np.int64)))
    out = pd.DataFrame(rows, columns=["doc_id", "first", "words", "at", "mask", "hash"])
    out["doc_id"] = out["doc_id"].astype("Int64")
    yield out


def keep_clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows without a verified overlap, with the columns they came with; each
    row is judged by its own text, whatever other rows of its ``doc_id`` hold."""
    keyed = numbered(docs)
    rows = keyed.select(F.col("__row").alias("doc_id"), "text")
    bad = staged(bits_of(overlaps(rows, benchmark, **options).select(F.col("doc_id").alias("__row"))), "leaks")
    return marked(keyed, bad, "__leaks").filter("NOT __leaks").select(*[F.col(f"`{c}`") for c in docs.columns])
