"""Column profiles (P1-P3) and the deterministic head sample.

Counts, null fractions, min, max and mean are ONE aggregate (partial
aggregation per task, one-row result).  The exact median needs ranks; Spark's
exact ``percentile`` keeps every distinct value of a group in one buffer, which
does not survive 100 TB, so the median is found by radix selection:

1. every double has a whole-number key that orders as the values do (the bits of
   its sign, exponent and fraction, computed with arithmetic),
2. one pass counts a column's keys by digit, with the least and greatest value of
   each digit; the digit that holds the wanted rank is the range of the next pass,
3. a digit of one value is the answer, however many rows hold it; ranks that lie in
   two digits are the greatest value of one and the least of the next.

No value is sorted or collected, infinities are keys like any other, and the path
is the same at every size: a pass narrows a column's range to one digit in 4096, so
64 bits need six passes at most and n distinct values about log(n) / log(4096).
All columns advance together; the driver sees at most columns x digits counts a pass.
"""

from __future__ import annotations

import math
import struct
from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                 T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    """Columns pandas would call "number" (no booleans, no datetimes)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]


def head_sample(df: DataFrame, n: int, order_by: Sequence[str] | None = None) -> DataFrame:
    """First ``n`` rows (n <= 0 means all); ordered for determinism."""
    if n <= 0:
        return df
    if order_by:
        df = df.orderBy(*order_by)
    return df.limit(n)


def dtypes(df: DataFrame) -> DataFrame:
    """(ordinal, column_name, dtype) plus the row count on every row."""
    n = df.agg(F.count(F.lit(1)).alias("rows"))
    cols = F.array(*[
        F.struct(F.lit(i).alias("ordinal"), F.lit(f.name).alias("column_name"),
                 F.lit(f.dataType.simpleString()).alias("dtype"))
        for i, f in enumerate(df.schema.fields)
    ])
    return n.select("rows", F.inline(cols))


def _plain(df: DataFrame) -> DataFrame:
    """Columns named by place (names may hold dots or repeat), NaN read as missing."""
    out = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return out.select(*[
        F.when(~F.isnan(f.name), F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)) else F.col(f.name) for f in out.schema.fields])


def null_fractions(df: DataFrame, digits: int = 4) -> DataFrame:
    """Share of missing values (NULL or NaN) per column, rounded."""
    aggs = [F.avg(F.col(f"c{i}").isNull().cast("double")).alias(f"_p{i}")
            for i in range(len(df.columns))]
    wide = _plain(df).agg(*aggs)
    entries = F.array(*[
        F.struct(F.lit(c).alias("column_name"),
                 F.round(F.col(f"_p{i}"), digits).alias("null_fraction"))
        for i, c in enumerate(df.columns)
    ])
    return wide.select(F.inline(entries))


# ---------------------------------------------------------------------------
# exact quantiles by radix selection
# ---------------------------------------------------------------------------

DIGITS = 4096                             # of a pass; a power of two
_NORMAL = 2.0 ** -1022                    # the least double whose fraction has a hidden one


def ordered_key(v: float) -> int:
    """A whole number that orders as doubles do: the bits of the size, negative
    for negative values (both zeros give 0)."""
    bits = struct.unpack("<q", struct.pack("<d", abs(v)))[0]
    return -bits if v < 0 else bits


def value_of_key(key: int) -> float:
    v = struct.unpack("<d", struct.pack("<q", abs(key)))[0]
    return -v if key < 0 else v


def with_ordered_key(df: DataFrame, value: str = "v", key: str = "key") -> DataFrame:
    """``ordered_key`` of a double column, by arithmetic (Spark has no function for
    a double's bits): the exponent from a logarithm set right by one comparison,
    the fraction by a division by that power of two, which is exact."""
    inf, least, one = "CAST('Infinity' AS DOUBLE)", f"CAST('{_NORMAL!r}' AS DOUBLE)", str(2 ** 52)
    two, half = "CAST(2 AS DOUBLE)", f"{2.0 ** 537!r}D"     # two halves lift the least double to 1
    rows = df.selectExpr("*", f"abs({value}) AS _a")
    # powers of two are looked up: a call of ``pow`` costs more than all the rest
    powers = "array(" + ", ".join(f"{2.0 ** e!r}D" for e in range(-1023, 1024)) + ")"
    rows = rows.selectExpr("*", f"CASE WHEN _a >= {least} AND _a < {inf} THEN least(1023, CAST(floor(ln(_a) * {1 / math.log(2)!r}D) AS INT)) END AS _g")
    rows = rows.selectExpr("*", f"element_at({powers}, _g + 1024) AS _p")
    rows = rows.selectExpr("*", f"CASE WHEN _p > _a THEN -1 WHEN _p * {two} <= _a THEN 1 ELSE 0 END AS _s")
    power = f"CASE WHEN _s = 0 THEN _p WHEN _s < 0 THEN _p / {two} ELSE _p * {two} END"
    rows = rows.selectExpr("*", f"CASE WHEN _g IS NOT NULL THEN (_g + _s + 1023) * {one}L + CAST((_a / ({power}) - 1) * {one} AS BIGINT)"
                                f" WHEN _a = {inf} THEN {2047 * 2 ** 52}L ELSE CAST(_a * {half} * {half} AS BIGINT) END AS _k")
    return rows.selectExpr("*", f"CASE WHEN {value} < 0 THEN -_k ELSE _k END AS {key}").drop("_a", "_g", "_p", "_s", "_k")


@dataclass
class _Range:
    """Where a column's wanted ranks (0-based, among values that are not null) lie."""

    column: str
    ranks: list[int]
    low: float                             # least and greatest value of the range
    high: float
    below: int = 0                         # values before the range
    found: dict[int, float] = field(default_factory=dict)

    def narrow(self, digits: list[tuple[int, float, float]]) -> None:
        """Take (count, least, greatest) of the range's digits in order."""
        at, left = self.below, []
        for n, low, high in digits:
            here = [k for k in self.ranks if at <= k < at + n]
            if low == high:
                self.found.update(dict.fromkeys(here, low))
            else:
                # the ends of a digit are known; another rank needs a look inside
                self.found.update({k: low for k in here if k == at} | {k: high for k in here if k == at + n - 1})
                inside = [k for k in here if k not in self.found]
                if inside:
                    left.append((inside, low, high, at))
            at += n
        # two neighbouring ranks are never both inside different digits
        self.ranks = left[0][0] if left else []
        if left:
            _, self.low, self.high, self.below = left[0]


def _digit_pass(work: DataFrame, ranges: list[_Range], digits: int) -> None:
    """Count the keys of every open range by digit and narrow the ranges: one
    aggregate of at most ranges x digits rows."""
    entries, shifts = [], []
    for i, r in enumerate(ranges):
        lo, hi = ordered_key(r.low), ordered_key(r.high)
        shifts.append(next(s for s in range(64) if (hi >> s) - (lo >> s) < digits))
        c = f"`{r.column}`"
        entries.append(f"named_struct('c', {i}, 'v', CASE WHEN {c} >= CAST('{r.low!r}' AS DOUBLE) AND "
                       f"{c} <= CAST('{r.high!r}' AS DOUBLE) THEN {c} END)")
    values = work.selectExpr(f"inline(array({', '.join(entries)}))").filter("v IS NOT NULL")
    got: dict[int, list] = {}
    for row in (with_ordered_key(values)
                .selectExpr("c", "v", f"shiftright(key, element_at(array({', '.join(map(str, shifts))}), c + 1)) AS digit")
                .groupBy("c", "digit").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
                .collect()):
        got.setdefault(row.c, []).append((row.digit, row.n, row.lo, row.hi))
    for i, r in enumerate(ranges):
        r.narrow([d[1:] for d in sorted(got.get(i, []))])


def exact_quantiles(df: DataFrame, columns: Sequence[str], q: float = 0.5,
                    counts: dict[str, int] | None = None, bounds: dict[str, tuple] | None = None,
                    digits: int = DIGITS) -> dict[str, float | None]:
    """Exact linear-interpolated quantile per column (pandas/``quantile_cont``).

    ``counts`` and ``bounds`` (least, greatest value) are read in one aggregate
    unless they are known.  Null without values, and between two infinities of
    different sign; NaN must have been made null."""
    work = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    if counts is None or bounds is None:
        row = work.agg(*[f(F.col(c)).alias(f"_{n}{i}") for i, c in enumerate(columns)
                         for n, f in (("n", F.count), ("lo", F.min), ("hi", F.max))]).first()
        counts = {c: row[f"_n{i}"] for i, c in enumerate(columns)}
        bounds = {c: (row[f"_lo{i}"], row[f"_hi{i}"]) for i, c in enumerate(columns)}
    wanted: dict[str, tuple[int, int, float]] = {}
    ranges: list[_Range] = []
    for c in columns:
        n = counts[c]
        if n:
            pos = (n - 1) * q
            k0 = math.floor(pos)
            wanted[c] = k0, min(k0 + 1, n - 1) if pos > k0 else k0, pos - k0
            r = _Range(c, sorted(set(wanted[c][:2])), *bounds[c])
            r.narrow([(n, *bounds[c])])             # the whole column is one digit
            ranges.append(r)
    while still := [r for r in ranges if r.ranks]:
        _digit_pass(work, still, digits)
    found = {r.column: r.found for r in ranges}
    result: dict[str, float | None] = dict.fromkeys(columns)
    for c, (k0, k1, share) in wanted.items():
        v0, v1 = found[c][k0], found[c][k1]
        v = v0 if v0 == v1 else v0 + (v1 - v0) * share
        result[c] = None if math.isnan(v) else v
    return result


def _stats_row(df: DataFrame, cols: Sequence[str], with_nulls: bool):
    """ONE aggregate: null share of every column + min/max/avg/count of ``cols``."""
    aggs = []
    if with_nulls:
        aggs += [F.avg(F.col(c).isNull().cast("double")).alias(f"_p{i}") for i, c in enumerate(df.columns)]
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.min(x).alias(f"_mn{i}"), F.max(x).alias(f"_mx{i}"),
                 F.avg(x).alias(f"_av{i}"), F.count(x).alias(f"_n{i}")]
    return df.agg(*aggs).first()


STATS_SCHEMA = "column_name string, min double, max double, mean double, p50 double"


def _numeric_rows(df, cols, row, digits):
    counts = {c: row[f"_n{i}"] for i, c in enumerate(cols)}
    bounds = {c: (row[f"_mn{i}"], row[f"_mx{i}"]) for i, c in enumerate(cols)}
    med = exact_quantiles(df, cols, 0.5, counts=counts, bounds=bounds)
    rnd = lambda v: None if v is None else _round_half_up(v, digits)
    return {c: (row[f"_mn{i}"], row[f"_mx{i}"], rnd(row[f"_av{i}"]), rnd(med[c]))
            for i, c in enumerate(cols)}


def _round_half_up(v: float, digits: int) -> float:
    """Spark's ``round`` on a double (HALF_UP on the shortest decimal text)."""
    import math
    from decimal import ROUND_HALF_UP, Decimal
    if not math.isfinite(v):
        return v
    return float(Decimal(repr(v)).quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP))


def numeric_stats(df: DataFrame, columns: Sequence[str] | None = None, digits: int = 4) -> DataFrame:
    """Min, max, mean (rounded) and exact median p50 (rounded) per numeric column.

    Only one number per column and statistic reaches the driver."""
    cols = list(columns) if columns is not None else numeric_columns(df)
    spark = df.sparkSession
    if not cols:
        return spark.createDataFrame([], STATS_SCHEMA)
    plain, place = _plain(df), {c: f"c{i}" for i, c in enumerate(df.columns)}
    own = [place[c] for c in cols]
    stats = _numeric_rows(plain, own, _stats_row(plain, own, False), digits)
    return spark.createDataFrame([(c, *stats[place[c]]) for c in cols], STATS_SCHEMA)


def profile(df: DataFrame, digits: int = 4) -> DataFrame:
    """P1-P3 in one relation: one row per column (null share for all, stats
    for numeric ones).  One aggregate for the simple statistics, then the
    exact-median selection jobs."""
    plain = _plain(df)
    cols = numeric_columns(plain)
    row = _stats_row(plain, cols, True)
    stats = _numeric_rows(plain, cols, row, digits) if cols else {}
    out = []
    for i, f in enumerate(df.schema.fields):
        p = row[f"_p{i}"]
        out.append((i, f.name, f.dataType.simpleString(),
                    None if p is None else _round_half_up(p, digits),
                    *stats.get(f"c{i}", (None, None, None, None))))
    return df.sparkSession.createDataFrame(
        out, "ordinal int, column_name string, dtype string, null_fraction double, "
             "min double, max double, mean double, p50 double")
