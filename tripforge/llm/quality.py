"""Quality rules, line first (built-in column functions only).

Base signals of a text
  n_words          words
  word_chars       code points in words
  n_symbols        characters of ``[#*$%&|<>]``
  n_dup_lines      lines with a word that equal an earlier line of the text
  n_repeat_words   words covered by 3-word windows found twice or more

``base_failed``: fewer than ``min_words`` words, or more than half of the words
repeated.  The line rules then judge every line that has a word:

  punctuation   a line of at least ``min_line_words`` words is prose when it
                ends in closing punctuation; a shorter one without it fails
  navigation    separators of a menu or breadcrumb, or a short menu phrase
  boilerplate   a short line holding a stock phrase (cookies, rights, log-in)
  symbols       over ``max_symbol_share`` of its characters are symbols

Failing lines are removed; a document that loses over ``max_lost_share`` of its
words that way is rejected.  Null, empty and blank texts have no words and are
rejected by the base rule.  Repeated rows are judged alike; extra columns pass
through untouched.

Windows are compared by 64-bit hashes inside one document (a document of a
million words meets a chance collision with probability below 1e-7).  All of a
row's work stays in its row: no shuffle, and no group grows with the corpus.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripforge.llm.common import ASCII_SPACE, text_of, words_of

SYMBOLS = "#*$%&|<>"
SIGNALS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
HAS_WORD = r"[^\x20\x09-\x0D]"
CLOSED = r"""[.!?:;…。！？]["'”’»)\]]*[\x20\x09-\x0D]*$"""
CLOSERS, QUOTES = ".!?:;…。！？", "\"'”’»)]"      # the parts of CLOSED
SEPARATORS = r"[\x20\x09-\x0D][|»›>•·][\x20\x09-\x0D][^\n]*[\x20\x09-\x0D][|»›>•·][\x20\x09-\x0D]"
MENU = (
    r"(?i)^[\x20\x09-\x0D]*(?:home|menu|next|previous|back|back to top|skip to content|read more|more|share|tweet|reply|"
    r"search|login|log in|sign in|sign up|register|contact|about|about us|sitemap)\W*$")
BOILERPLATE = (
    r"(?i)all rights reserved|cookie policy|uses? cookies|privacy policy|terms of (?:use|service)|"
    r"enable javascript|click here|subscribe to|sign up for|follow us on|powered by|lorem ipsum")


@dataclass(frozen=True)
class QualityRules:
    min_words: int = 50
    max_repeat_share: int = 50        # percent of the words
    min_line_words: int = 5
    boilerplate_chars: int = 200      # a stock phrase condemns lines up to this long
    menu_chars: int = 30              # as does a menu phrase
    max_symbol_share: float = 0.10
    max_lost_share: float = 0.50


def _symbols(c: Column) -> Column:
    return F.length(F.regexp_replace(c, f"[^{SYMBOLS}]+", ""))


def _closed(line: Column) -> Column:
    """CLOSED, without a search through the line: white space, then closing quotes
    are cut off its end, and the last character is looked at."""
    bare = F.rtrim(F.rtrim(line, F.lit(ASCII_SPACE)), F.lit(QUOTES))
    return (F.length(bare) > 0) & (F.instr(F.lit(CLOSERS), F.right(bare, F.lit(1))) > 0)


def _lost(line: Column, has_symbols: Column, rules: QualityRules) -> Column:
    """Words that go with this line: all of them if a rule removes it, else 0.

    The tests run from cheap to dear, and words are counted only in lines
    that a test on characters has caught."""
    size = F.length(line)
    n = F.size(words_of(line)).cast("long")
    return (F.when(line.rlike(SEPARATORS)
                   | ((size <= rules.menu_chars) & line.rlike(MENU))
                   | ((size <= rules.boilerplate_chars) & line.rlike(BOILERPLATE))
                   | (has_symbols & (_symbols(line) > size * F.lit(rules.max_symbol_share))), n)
            .when(~_closed(line) & (n < rules.min_line_words), n)
            .otherwise(F.lit(0).cast("long")))


def quality_signals(docs: DataFrame, text: str = "text", rules: QualityRules = QualityRules(),
                    prefix: str = "") -> DataFrame:
    """``docs`` with the base signals, ``base_failed``, ``lost_words`` and
    ``kept``; ``prefix`` is put before the names of the new columns."""
    p = lambda n: f"{prefix}{n}"
    w, x, ls = p("__words"), p("__windows"), p("__lines")
    # the arrays are columns of their own projection so that each is built once
    df = docs.withColumn(p("__text"), text_of(text))
    t = F.col(p("__text"))
    df = df.withColumns({w: words_of(t), ls: F.filter(F.split(t, "\n"), lambda v: v.rlike(HAS_WORD))})
    df = df.withColumn(x, F.when(F.size(w) >= 3, F.expr(
        f"slice(transform(`{w}`, (a, i) -> xxhash64(a, get(`{w}`, i + 1), get(`{w}`, i + 2))), 1, size(`{w}`) - 2)")))
    # windows sorted with their places: equal ones are neighbours.  Only texts
    # that have any equal windows are sorted.
    s = p("__sorted")
    df = df.withColumn(s, F.when(F.size(F.array_distinct(x)) < F.size(x), F.expr(
        f"sort_array(transform(`{x}`, (h, i) -> struct(h AS h, i AS i)))")))
    # first words of the repeated windows in text order; a window covers three
    # words less those that the next one covers too
    at = p("__starts")
    df = df.withColumn(at, F.expr(
        f"sort_array(array_distinct(flatten(transform(filter("
        f"zip_with(`{s}`, slice(`{s}`, 2, size(`{s}`)), (a, b) -> struct(a AS a, b AS b)),"
        f" z -> coalesce(z.a.h = z.b.h, false)), z -> array(z.a.i, z.b.i)))))"))
    repeat = F.expr(f"aggregate(zip_with(`{at}`, slice(`{at}`, 2, size(`{at}`)), (a, b) ->"
                    " least(3, coalesce(b - a, 3))), 0L, (n, v) -> n + v)")
    df = df.withColumns({
        p("n_words"): F.size(w).cast("long"),
        p("word_chars"): F.length(F.array_join(w, "")).cast("long"),
        p("n_symbols"): _symbols(t).cast("long"),
        p("n_dup_lines"): (F.size(ls) - F.size(F.array_distinct(ls))).cast("long"),
        p("n_repeat_words"): F.coalesce(repeat, F.lit(0).cast("long")),
    })
    df = df.withColumn(p("lost_words"), F.aggregate(ls, F.lit(0).cast("long"), lambda a, v: a + _lost(
        v, F.col(p("n_symbols")) > 0, rules)))
    n, r = F.col(p("n_words")), F.col(p("n_repeat_words"))
    df = df.withColumn(p("base_failed"), (n < rules.min_words) | (r * 100 > n * rules.max_repeat_share))
    df = df.withColumn(p("kept"), ~F.col(p("base_failed"))
                       & (F.col(p("lost_words")) <= n * F.lit(rules.max_lost_share)))
    return df.drop(p("__text"), w, x, s, ls, at)


def clean_lines(text: Column, rules: QualityRules = QualityRules()) -> Column:
    """The text without the lines that the rules remove (blank lines stay)."""
    return F.array_join(F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda v: _lost(
        v, F.lit(True), rules) == 0), "\n")


def keep_documents(docs: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """The documents that pass, whole, with the columns they came with."""
    # The test also reads the partition's number, which keeps Catalyst from moving
    # it below the arrays it is made of: their expressions would be copied into
    # each other, and the words split anew for every window.
    tag = "__quality_"
    judged = quality_signals(docs, "text", rules, tag).withColumn(f"{tag}part", F.spark_partition_id())
    return judged.filter(F.col(f"{tag}kept") & (F.col(f"{tag}part") >= 0)).select(*[F.col(f"`{c}`") for c in docs.columns])
