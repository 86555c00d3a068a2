"""Toxicity (operator 11): a weighted lexicon matched by Aho-Corasick.

Texts are folded first: compatibility forms, case, letters that look like Latin
ones, characters of no width, and digits or signs that stand for a letter inside
a word; ``l`` reads as ``i``, since ``1`` and ``|`` may be either.  The lexicon
holds whole words and beginnings of words, learnt from labelled documents by
their log-likelihood ratio.  Texts that begin alike down to their smallest
shingle count once, so that a group of copies is one witness.  Pairs of
neighbouring words that hold a term, yet stand in clean documents, become
exception phrases: a term inside one does not count.

The score is a logistic curve over the logarithm of the weights found for each
hundred words.  Nothing but the text enters it.

Defined cases: a null text is the empty one; texts without words have nothing
found; every row is scored by itself, so repeated rows and ids get a row each;
a null id reads as the empty text where folds are told apart, and is held out;
labels without id or other than 0 and 1 are ignored, an id with both labels is
toxic; without labels of both kinds the lexicon is empty and all scores are the
smoothed share of toxic labels (0 without any label).  Other columns are not
read.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripforge.llm.common import staged, text_of

# fixed values: letters of other scripts that look like Latin ones, and signs for letters
GLYPHS = {
    "а": "a", "в": "b", "с": "c", "е": "e", "ё": "e", "һ": "h", "і": "i", "ї": "i", "ј": "j", "к": "k", "м": "m", "н": "h",
    "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "l", "ь": "b",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ɩ": "i", "ʀ": "r", "ꜱ": "s", "ᴄ": "c", "ᴏ": "o", "ᴠ": "v", "ᴡ": "w", "ᴢ": "z", "ø": "o",
    "օ": "o", "ո": "n", "ս": "u", "հ": "h",
}
NO_WIDTH = "­​‌‍⁠﻿"
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "i"}

_GLYPHS = str.maketrans(GLYPHS | dict.fromkeys(NO_WIDTH))
_SIGNS = str.maketrans(SIGNS)
_ODD = re.compile("[" + "".join(GLYPHS) + NO_WIDTH + "]")
_SIGN = re.compile(r"(?<=[^\W\d_])[0134578@$]+|[0134578@$!|]+(?=[^\W\d_])")
WORD = re.compile(r"[^\W\d_]+")
_HASHES = np.array([1, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)   # odd: hashes of a hash modulo 2 ** 64


def folded_words(text: str) -> list[str]:
    """The words of a text (runs of letters) after folding."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    text = text.lower()
    if not text.isascii() and _ODD.search(text):
        text = text.translate(_GLYPHS)
    text = _SIGN.sub(lambda m: m[0].translate(_SIGNS), text)
    return WORD.findall(text.replace("l", "i"))


def in_fold(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """Held out: the CRC-32 of the id as text divides by ``folds``."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds == 0


@dataclass
class Lexicon:
    """Terms ``" word "`` and beginnings ``" begin"`` of folded words with their
    weights, exception phrases, and the curve from density to score."""

    terms: dict[str, float]
    exceptions: set[str] = field(default_factory=set)   # " word word "
    slope: float = 0.0
    intercept: float = -math.inf

    def matcher(self):
        import ahocorasick

        a = ahocorasick.Automaton()
        for t, w in self.terms.items():
            a.add_word(t, (len(t), w))
        for t in self.exceptions - self.terms.keys():
            a.add_word(t, (len(t), None))
        if len(a):
            a.make_automaton()
        return a if len(a) else None


def hits(matcher, words: list[str]) -> tuple[str, dict[int, float]]:
    """The joined words, and the weight of the heaviest term at each place where a
    term starts outside exception phrases."""
    text = f" {' '.join(words)} "
    found: dict[int, float] = {}
    spared: list[tuple[int, int]] = []
    if matcher is not None:
        for end, (size, weight) in matcher.iter(text):
            start = end - size + 1
            if weight is None:
                spared.append((start, end))
            elif weight > found.get(start, 0.0):
                found[start] = weight
    for s, e in spared if found else ():
        for at in [at for at in found if s <= at < e]:
            del found[at]
    return text, found


def density(found: dict[int, float], words: list[str]) -> float:
    """log(1 + weight a hundred words)."""
    return math.log1p(100.0 * sum(found.values()) / max(len(words), 1))


# -- learning ----------------------------------------------------------------------

def training_rows(docs: DataFrame, labels: DataFrame, bound: int, seed: int) -> DataFrame:
    """(text, toxic) of about ``bound`` labelled documents of each label outside the
    held-out fold, chosen by a hash of their ids; one text of those with an equal
    smallest shingle, by each of three hashes in turn."""
    flag = F.col("toxic").cast("int")
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), flag.alias("toxic"))
             .filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~in_fold())
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    count = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    share = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id")), 11) / F.lit(float(1 << 53))
    keep = F.lit(False)
    for t, n in count.items():
        keep = keep | ((F.col("toxic") == t) & (share < F.lit(bound / n)))
    few = known.filter(keep)                      # 2 * bound ids or so, whatever the corpus holds
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
            .join(F.broadcast(few), "doc_id").select("text", "toxic"))

    def sketched(batches):
        import xxhash

        for b in batches:
            out = []
            for t in b["text"]:
                w = folded_words(t)
                runs = [" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))]
                h = np.array([xxhash.xxh64_intdigest(r) for r in runs], np.uint64)
                out.append([int((h * m).min() >> np.uint64(1)) for m in _HASHES])
            yield b.assign(**{f"s{i}": [o[i] for o in out] for i in range(len(_HASHES))})
    names = [f"s{i}" for i in range(len(_HASHES))]
    rows = rows.mapInPandas(sketched, f"text string, toxic int, {', '.join(f'{s} long' for s in names)}")
    for s in names:
        others = [F.min_by(c, "text").alias(c) for c in names if c > s]
        rows = rows.groupBy(s, "toxic").agg(F.min("text").alias("text"), *others)
    return rows.select("text", "toxic")


def _terms_of(words: set[str], least: int, most: int) -> set[str]:
    out = set()
    for w in words:
        if len(w) > 2:
            out.add(f" {w} ")
        out.update(f" {w[:k]}" for k in range(least, min(len(w) - 1, most) + 1))
    return out


def _counted(rows: DataFrame, per_text, flush: int = 200_000) -> DataFrame:
    """(term, toxic, clean): in how many texts of each label a term stands."""
    def run(batches):
        counts: dict[str, list[int]] = {}

        def out():
            frame = pd.DataFrame([(t, *c) for t, c in counts.items()], columns=["term", "toxic", "clean"])
            counts.clear()
            return frame
        look = per_text()
        for b in batches:
            for text, toxic in zip(b["text"], b["toxic"]):
                for term in look(text):
                    counts.setdefault(term, [0, 0])[0 if toxic else 1] += 1
                if len(counts) > flush:
                    yield out()
        yield out()
    return (rows.select("text", "toxic").mapInPandas(run, "term string, toxic long, clean long")
            .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))


def _evidence(t: float, c: float, n_t: int, n_c: int) -> float:
    """Twice the log-likelihood ratio of a term's counts, 0 where it is not likelier in toxic texts."""
    if t * n_c <= c * n_t:
        return 0.0
    g, n = 0.0, n_t + n_c
    for seen, label, total in ((t, n_t, t + c), (c, n_c, t + c), (n_t - t, n_t, n - t - c), (n_c - c, n_c, n - t - c)):
        if seen > 0:
            g += seen * math.log(seen * n / (label * total))
    return 2 * g


def choose_terms(rows: list[tuple[str, int, int]], n_t: int, n_c: int, least: float, most: int) -> dict[str, float]:
    """Weights of the terms with the strongest evidence; of terms that begin
    alike, the one with the most stands for all (the longest, if equal)."""
    scored = sorted(((-_evidence(t, c, n_t, n_c), -len(term), term, t, c) for term, t, c in rows))
    chosen: dict[str, float] = {}
    heads: set[str] = set()                        # beginnings of chosen terms
    for g, _, term, t, c in scored:
        if -g < least or len(chosen) >= most:
            break
        bare = term.rstrip(" ")
        if term in heads or bare in heads or any(bare[:k] in chosen for k in range(3, len(bare) + 1)):
            continue
        weight = math.log((t + 0.5) / (n_t + 1)) - math.log((c + 0.5) / (n_c + 1))
        if weight > math.log(4):                   # four times as often in toxic texts
            chosen[term] = weight
            heads.update(bare[:k] for k in range(3, len(bare) + 1))
    return chosen


def curve(table: list[tuple[float, int, int]], steps: int = 60, ridge: float = 1e-2) -> tuple[float, float]:
    """Slope and intercept of a logistic curve over (density, toxic, count) by
    Newton's method, both labels weighing alike; the ridge keeps separable data finite."""
    x = np.array([r[0] for r in table])
    y = np.array([r[1] for r in table], float)
    n = np.array([r[2] for r in table], float)
    w = np.where(y > 0, n / max(n[y > 0].sum(), 1), n / max(n[y == 0].sum(), 1)) * 100
    X, beta = np.stack([x, np.ones_like(x)], 1), np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(X @ beta, -30, 30)))
        grad = X.T @ (w * (p - y)) + ridge * beta
        hess = (X * (w * p * (1 - p))[:, None]).T @ X + ridge * np.eye(2)
        step = np.linalg.solve(hess, grad)
        beta -= step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
    return float(beta[0]), float(beta[1])


def learn(docs: DataFrame, labels: DataFrame, bound: int = 20_000, seed: int = 17, exceptions: tuple[str, ...] = (),
          least_begin: int = 4, most_begin: int = 8, evidence: float = 14.0, max_terms: int = 5_000) -> Lexicon:
    """A lexicon from at most about ``bound`` labelled documents of each label.

    ``exceptions`` are phrases of two words that are always spared, beside the learnt ones."""
    rows = staged(training_rows(docs, labels, bound, seed), "toxicity-training")
    count = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n_t, n_c = count.get(1, 0), count.get(0, 0)
    given = {f" {' '.join(folded_words(p))} " for p in exceptions}
    if not n_t or not n_c:
        share = (n_t + 0.5) / (n_t + n_c + 1) if n_t + n_c else 0.0
        return Lexicon({}, given, 0.0, math.log(share / (1 - share)) if share else -math.inf)

    terms = _counted(rows, lambda: lambda text: _terms_of(set(folded_words(text)), least_begin, most_begin))
    strong = (terms.filter((F.col("toxic") >= 3) & (F.col("toxic") * F.lit(n_c) > F.col("clean") * F.lit(4 * n_t)))
              .orderBy(F.col("toxic") - F.col("clean") * F.lit(n_t / n_c), "term", ascending=[False, True])
              .limit(10 * max_terms))              # the size of the model: a sort of the terms' counts
    chosen = choose_terms([tuple(r) for r in strong.collect()], n_t, n_c, evidence, max_terms)
    lexicon = Lexicon(chosen, given)

    def phrases():
        matcher = lexicon.matcher()

        def look(text: str) -> set[str]:
            words = folded_words(text)
            joined, found = hits(matcher, words)
            out = set()
            for at in found:
                end = joined.index(" ", at + 1)
                before = joined.rfind(" ", 0, at)
                after = joined.find(" ", end + 1)
                if before >= 0:
                    out.add(joined[before:end + 1])
                if after > 0:
                    out.add(joined[at:after + 1])
            return out
        return look
    spare = (_counted(rows, phrases).filter((F.col("clean") >= 3) & (F.col("clean") * F.lit(n_t) > F.col("toxic") * F.lit(4 * n_c)))
             .orderBy("clean", "term", ascending=[False, True]).limit(max_terms))
    lexicon.exceptions = given | {r.term for r in spare.collect()}

    def places(batches):
        matcher = lexicon.matcher()
        for b in batches:
            seen = Counter()
            for text, toxic in zip(b["text"], b["toxic"]):
                words = folded_words(text)
                seen[round(density(hits(matcher, words)[1], words), 2), toxic] += 1
            yield pd.DataFrame([(x, t, n) for (x, t), n in seen.items()], columns=["x", "toxic", "n"])
    table = (rows.select("text", "toxic").mapInPandas(places, "x double, toxic int, n long")
             .groupBy("x", "toxic").agg(F.sum("n").alias("n")).orderBy("x", "toxic").collect())
    lexicon.slope, lexicon.intercept = curve([(r.x, r.toxic, r.n) for r in table])
    return lexicon


# -- scoring -----------------------------------------------------------------------

def score(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.5) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_words, n_terms) of every row."""
    def run(batches):
        matcher = lexicon.matcher()
        for b in batches:
            scores, sizes, counts = [], [], []
            for text in b["text"]:
                words = folded_words(text)
                _, found = hits(matcher, words)
                z = lexicon.intercept + lexicon.slope * density(found, words)
                scores.append(1 / (1 + math.exp(-z)) if z > -700 else 0.0)
                sizes.append(len(words))
                counts.append(len(found))
            got = np.array(scores, float)
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "held_out": b["held_out"], "score": got,
                                "predicted": (got >= threshold).astype(np.int32),
                                "n_words": np.array(sizes, np.int64), "n_terms": np.array(counts, np.int64)})
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), in_fold().alias("held_out"), text_of().alias("text")).mapInPandas(
        run, "doc_id long, held_out boolean, score double, predicted int, n_words long, n_terms long")


def toxicity(docs: DataFrame, labels: DataFrame, lexicon: Lexicon | None = None, **options) -> DataFrame:
    """Scores of all documents by a lexicon learnt from ``labels``, or by a given one."""
    return score(docs, lexicon or learn(docs, labels, **options))
