"""Secret scan: fixed patterns, and formats learnt from what they find.

Base patterns, leftmost and non-overlapping for each kind
  assign   a name of a credential, ``:`` or ``=``, and a value of 6+ characters
  access   ``AKIA`` and capitals or digits, 20+ characters in all
  hex      24+ lower-case hexadecimal digits

Grammar inference.  The values that the patterns find are labelled credentials.
A bounded seeded sample of each kind (``sample`` rows, a parameter) goes to the
driver, where they become a prefix tree over character classes whose states are
merged while their outgoing frequencies are compatible (Hoeffding bound, as in
the ALERGIA algorithm), which gives a probabilistic automaton for each kind.
The sample's held-out part sets, for each automaton, how far below their average
a candidate's mean log-likelihood of a character may lie (by the root of its
length) so that ``recall`` of the credentials are found; the same on ordinary words of the corpus sets a second automaton to compare with.  Every
candidate (a run of 6+ characters that a labelled value may hold, outside the
base spans) of every text is then scored; those above the threshold and likelier
by ``margin`` than as an ordinary word are ``grammar`` spans.  Of a run that is
none, the parts between ``=``, and of these the parts between ``.``, are scored.
Base spans always stay.

Spans are kind:start:end in code points, end exclusive, ordered by start, then
kind as listed (assign, access, hex, grammar), then end, and joined by commas.
Null and empty texts have no spans, and every row is returned, repeated ones
too.  Without labelled credentials nothing is learnt and base spans remain.
Extra columns are ignored.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import math
import re
import zlib
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripforge.llm.common import staged, text_of

# Fixed patterns: the kinds, and the group and length that a match must have.
PATTERNS = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
)
KINDS = ("assign", "access", "hex", "grammar")
LONG_HEX = re.compile(r"[0-9a-f]{24,}")      # the same matches as hex after its test, faster
NAMES = re.compile(r"passw|secret|token|api_?key", re.I | re.A)
LEAST = 6                                    # of a labelled value, and so of a candidate
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{6,}")
PARTS = (re.compile(r"[A-Za-z0-9+/_.-]{1,}=*"), re.compile(r"[A-Za-z0-9+/_-]{1,}=*"))
LONG_WORD = re.compile(r"[^\W_]{6,40}")
END = "$"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's place, end) of the base spans, ordered."""
    out = []
    for k, (kind, pattern, group, least) in enumerate(PATTERNS):
        if kind == "assign" and not NAMES.search(text) or kind == "access" and "AKIA" not in text:
            continue
        for m in (LONG_HEX if kind == "hex" else pattern).finditer(text):
            if len(m[group]) >= least:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


# -- probabilistic automata -----------------------------------------------------------
def symbol(c: str) -> str:
    """The class of a character: digits, a-f, other small letters, the same for
    capitals, and every other character for itself."""
    if "0" <= c <= "9":
        return "9"
    if "a" <= c <= "z":
        return "f" if c <= "f" else "z"
    if "A" <= c <= "Z":
        return "F" if c <= "F" else "Z"
    return c


# the same for a whole text; candidates are found in the classes as in the text
CLASSES = {ord(c): symbol(c) for c in map(chr, range(128)) if c.isalnum()}


@dataclass
class Automaton:
    """Deterministic probabilistic automaton: edges with their counts."""

    edges: list[dict[str, int]] = field(default_factory=lambda: [{}])      # state -> symbol -> state
    counts: list[dict[str, int]] = field(default_factory=lambda: [{}])     # state -> symbol or END -> times
    mean: float = 0.0        # of the held-out credentials' likelihoods
    low: float = 0.0         # the least accepted distance from it, times the root of the length

    def add(self, word: str) -> None:
        s = 0
        for c in map(symbol, word):
            self.counts[s][c] = self.counts[s].get(c, 0) + 1
            if c not in self.edges[s]:
                self.edges[s][c] = len(self.edges)
                self.edges.append({})
                self.counts.append({})
            s = self.edges[s][c]
        self.counts[s][END] = self.counts[s].get(END, 0) + 1

    def likelihood(self, word: str) -> float:
        """Mean log-likelihood of a character; an unseen step costs a lot."""
        s, total = 0, 0.0
        for c in map(symbol, word):
            n = self.counts[s].get(c, 0) if s >= 0 else 0
            total += math.log((n + 0.01) / (sum(self.counts[s].values()) + 1)) if s >= 0 else math.log(0.01)
            s = self.edges[s].get(c, -1) if s >= 0 else -1
        return total / max(1, len(word))


def _compatible(a: Automaton, p: int, q: int, bound: float) -> bool:
    """Hoeffding's test on all steps out of two states, and of what follows them."""
    stack = [(p, q)]
    while stack:
        p, q = stack.pop()
        cp, cq = a.counts[p], a.counts[q]
        n, m = sum(cp.values()), sum(cq.values())
        if n and m:
            limit = bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            if any(abs(cp.get(c, 0) / n - cq.get(c, 0) / m) > limit for c in {*cp, *cq}):
                return False
        stack.extend((a.edges[p][c], a.edges[q][c]) for c in a.edges[q] if c in a.edges[p])
    return True


def _merge(a: Automaton, p: int, q: int, into: dict[int, tuple[int, str]]) -> None:
    """Fold the tree below state q into p."""
    parent, c = into[q]
    a.edges[parent][c] = p
    stack = [(p, q)]
    while stack:
        p, q = stack.pop()
        for c, n in a.counts[q].items():
            a.counts[p][c] = a.counts[p].get(c, 0) + n
        for c, child in a.edges[q].items():
            if c in a.edges[p]:
                stack.append((a.edges[p][c], child))
            else:
                a.edges[p][c] = child
                into[child] = (p, c)


def infer(words: list[str], alpha: float = 0.05) -> Automaton:
    """The prefix tree of some words with its compatible states merged."""
    a = Automaton()
    for w in sorted(words):
        a.add(w)
    bound = math.sqrt(0.5 * math.log(2 / alpha))
    into = {child: (s, c) for s, es in enumerate(a.edges) for c, child in es.items()}
    red = [0]
    blue = sorted(set(a.edges[0].values()))
    while blue:
        q = blue.pop(0)
        for p in red:
            if _compatible(a, p, q, bound):
                _merge(a, p, q, into)
                break
        else:
            red.append(q)
        blue = sorted({child for s in red for child in a.edges[s].values()} - set(red))
    # keep what is reached, numbered anew
    name = {s: i for i, s in enumerate(red)}
    return Automaton([{c: name[t] for c, t in a.edges[s].items()} for s in red], [a.counts[s] for s in red])


@dataclass
class Grammar:
    """Automata of the credential kinds and of ordinary words."""

    kinds: dict[str, Automaton]
    words: Automaton
    margin: float = 0.5

    def accepts(self, token: str) -> bool:
        plain = self.words.likelihood(token)
        root = math.sqrt(len(token))
        return any(((x := a.likelihood(token)) - a.mean) * root >= a.low and x >= plain + self.margin
                   for a in self.kinds.values())


class Scorer:
    """Spans of a text that a grammar accepts; scores hang on the characters'
    classes alone, so those of many candidates are remembered."""

    def __init__(self, grammar: Grammar, most: int = 1 << 17):
        self.grammar, self.most, self.known = grammar, most, {}

    def accepts(self, classes: str) -> bool:
        got = self.known.get(classes)
        if got is None:
            if len(self.known) >= self.most:
                self.known.clear()
            got = self.grammar.accepts(classes)
            if len(classes) <= 64:
                self.known[classes] = got
        return got

    def spans(self, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
        spans, out = sorted((s, e) for s, _, e in base), []
        # where base spans start, and how far those up to each of them reach
        covered = [s for s, _ in spans], list(itertools.accumulate((e for _, e in spans), max))
        classes = text.translate(CLASSES)
        for m in CANDIDATE.finditer(classes):
            self._score(classes, m.start(), m.end(), covered, 0, out)
        return out

    def _score(self, classes: str, s: int, e: int, covered, level: int, out: list) -> None:
        run = classes[s:e]
        a, z = s + len(run) - len(run.lstrip(".=")), e - len(run) + len(run.rstrip("."))
        if z - a < LEAST:
            return
        before = bisect.bisect_left(covered[0], z)
        if not (before and covered[1][before - 1] > a) and self.accepts(classes[a:z]):
            out.append((a, z))
            return
        for level in range(level, len(PARTS)):
            parts = [m.span() for m in PARTS[level].finditer(classes, a, z)]
            if parts != [(a, z)]:
                for x, y in parts:
                    self._score(classes, x, y, covered, level + 1, out)
                return


def fit(credentials: dict[str, list[str]], words: list[str], recall: float = 0.95, margin: float = 0.5) -> Grammar:
    """Automata from labelled credentials; every fifth is held out for the threshold."""
    kinds = {}
    for kind, values in credentials.items():
        values = sorted(set(values), key=lambda v: hashlib.md5(v.encode()).digest())
        held, rest = values[::5], [v for i, v in enumerate(values) if i % 5]
        if len(rest) >= 4:
            a = infer(rest)
            scores = [a.likelihood(v) for v in held]
            a.mean = sum(scores) / len(scores)
            # a mean over few characters strays further: distances count by the root of the length
            apart = sorted((x - a.mean) * math.sqrt(len(v)) for x, v in zip(scores, held))
            a.low = apart[int((1 - recall) * len(apart))]
            kinds[kind] = a
    return Grammar(kinds, infer(words), margin)


def labelled(docs: DataFrame, sample: int = 2000, seed: int = 17) -> tuple[dict[str, list[str]], list[str]]:
    """A seeded sample of the values that the base patterns find (``sample`` a
    kind) and of words of 6+ characters outside them (``sample``)."""
    def run(batches):
        for b in batches:
            rows = []
            for t in b["text"]:
                spans, inside = base_spans(t), False
                for s, k, e in spans:
                    m = PATTERNS[k][1].match(t, s)
                    rows.append((KINDS[k], m[PATTERNS[k][2]]))
                # the first word after a place that the text itself decides
                m = None if spans or not t else LONG_WORD.search(t, zlib.crc32(t.encode()) % len(t))
                if m:
                    rows.append(("words", m[0]))
            yield pd.DataFrame(rows, columns=["kind", "value"])
    found = staged(docs.select(text_of().alias("text")).mapInPandas(run, "kind string, value string").distinct(), "labelled")
    # hashes are even: those below twice the wanted share hold the smallest ``sample``,
    # and no task sorts more than them
    share = F.xxhash64(F.lit(seed), "value") / F.lit(2.0 ** 64) + F.lit(0.5)
    counts = found.groupBy("kind").count().collect()                 # a row a kind
    # written as a literal: a join by kind would deal all words to one task
    wanted = F.lit(0.0)
    for kind, n in counts:
        wanted = F.when(F.col("kind") == kind, (2.0 * sample + 100) / n).otherwise(wanted)
    found = found.filter(share <= wanted)
    pick = F.row_number().over(Window.partitionBy("kind").orderBy(F.xxhash64(F.lit(seed), "value"), "value"))
    rows = found.withColumn("n", pick).filter(F.col("n") <= sample).select("kind", "value").collect()
    by = {}
    for kind, value in rows:
        by.setdefault(kind, []).append(value)
    words = by.pop("words", [])
    return by, words


def scan(docs: DataFrame, grammar: Grammar | None = None, sample: int = 2000) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_grammar, base_sha256, spans)."""
    if grammar is None:
        grammar = fit(*labelled(docs, sample))

    def run(batches):
        scorer = Scorer(grammar)
        for b in batches:
            rows = []
            for t in b["text"]:
                base = base_spans(t)
                n = [sum(k == i for _, k, _ in base) for i in range(3)]
                more = [(a, 3, z) for a, z in scorer.spans(t, base)]
                rows.append((*n, len(more), hashlib.sha256(written(base).encode()).hexdigest(), written(sorted(base + more))))
            out = pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "n_grammar", "base_sha256", "spans"])
            out.insert(0, "doc_id", b["doc_id"].astype("Int64").values)
            yield out
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInPandas(
        run, "doc_id long, n_assign long, n_access long, n_hex long, n_grammar long, base_sha256 string, spans string")
