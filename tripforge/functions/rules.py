"""Declarative row rules compiled to Spark ``Column`` predicates.

A rule is (column, check, argument).  ``Rule.bad()`` returns a predicate that
is TRUE when the row violates the rule, FALSE when it passes and NULL when the
rule does not apply (a null value never fails a value check, only
``not_nullable``).  Inside ``when`` a NULL predicate simply drops out, which
gives exactly the "ignore missing values" semantics of a column contract.

Rules compile to Spark SQL expression text (``Rule.sql``): a list of 31
predicates then costs one ``F.expr`` call instead of hundreds of py4j round
trips for ``F.col``/``F.lit``/operators; Catalyst sees the same expressions.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce
from typing import Any, Callable, Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_TEXT = "None"
# Names of the columns that a row's file did not have, each between commas.
ABSENT_COL = "_absent_columns"


def ident(name: str) -> str:
    """Quoted SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def sql_literal(v: Any) -> str:
    """SQL literal with the Python type kept (floats as DOUBLE, not DECIMAL)."""
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, float):
        return f"CAST('{v!r}' AS DOUBLE)"
    s = str(v).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{s}'"


@dataclass(frozen=True)
class Rule:
    """One contract rule.  ``kind`` is one of not_nullable/isin/ge/le/before/expr."""

    column: str
    check: str
    kind: str
    arg: Any = None
    show_value: bool = True

    @property
    def key(self) -> str:
        return f"{self.column}:{self.check}"

    def columns(self) -> tuple[str, ...]:
        if self.kind == "before":
            return (self.column, self.arg)
        return (self.column,)

    @property
    def sql(self) -> str | None:
        """Predicate as SQL text (None only for Column-factory custom rules)."""
        c = ident(self.column)
        if self.kind == "not_nullable":
            return f"({c} IS NULL)"
        if self.kind == "isin":
            return f"(NOT ({c} IN ({', '.join(sql_literal(v) for v in self.arg)})))"
        if self.kind == "ge":
            return f"({c} < {sql_literal(self.arg)})"
        if self.kind == "le":
            return f"({c} > {sql_literal(self.arg)})"
        if self.kind == "before":
            return f"({c} < {ident(self.arg)})"
        if self.kind == "expr":
            return f"({self.arg})" if isinstance(self.arg, str) else None
        raise ValueError(f"unknown rule kind {self.kind!r}")

    def bad(self) -> Column:
        s = self.sql
        if s is not None:
            return F.expr(s)
        return self.arg()


# -- rule builders -----------------------------------------------------------

def not_nullable(column: str) -> Rule:
    return Rule(column, "not_nullable", "not_nullable")


def isin(column: str, values: Iterable[Any]) -> Rule:
    return Rule(column, "isin", "isin", tuple(values))


def ge(column: str, bound: float) -> Rule:
    return Rule(column, "ge", "ge", bound)


def le(column: str, bound: float) -> Rule:
    return Rule(column, "le", "le", bound)


def before(column: str, other: str, check: str | None = None) -> Rule:
    """Cross-column rule: ``column`` must not be earlier than ``other``."""
    return Rule(column, check or f"lt_{other}", "before", other, show_value=False)


def custom(column: str, check: str, predicate: str | Callable[[], Column],
           show_value: bool = True) -> Rule:
    """User rule: ``predicate`` (SQL text or Column factory) is TRUE when bad."""
    return Rule(column, check, "expr", predicate, show_value)


# -- compilation ---------------------------------------------------------------

def applicable(rules: Sequence[Rule], columns: Iterable[str]) -> list[Rule]:
    """Rules whose columns exist.  A missing column is a schema-level issue
    (reported by schema drift), never a per-row failure."""
    present = set(columns)
    here = [r for r in rules if all(c in present for c in r.columns())]
    if ABSENT_COL not in present:
        return here
    return [replace(r, kind="expr", arg=f"{r.sql} AND instr({ABSENT_COL}, {sql_literal(f',{r.column},')}) = 0")
            if r.kind == "not_nullable" else r for r in here]


def all_sql(rules: Sequence[Rule]) -> bool:
    return all(r.sql is not None for r in rules)


def _is_string(rule: Rule, schema: T.StructType) -> bool:
    field = next((f for f in schema.fields if f.name == rule.column), None)
    return field is not None and isinstance(field.dataType, T.StringType)


def reason_sql(rule: Rule, schema: T.StructType) -> str:
    """``column:check=value`` with the value rendered like a Python repr."""
    key = sql_literal(rule.key)
    if not rule.show_value:
        return key
    c = ident(rule.column)
    text = f"concat('''', {c}, '''')" if _is_string(rule, schema) else f"CAST({c} AS STRING)"
    return f"concat({sql_literal(rule.key + '=')}, coalesce({text}, {sql_literal(NULL_TEXT)}))"


def any_true_sql(rules: Sequence[Rule]) -> str:
    if not rules:
        return "FALSE"
    return "(" + " OR ".join(f"coalesce({r.sql}, FALSE)" for r in rules) + ")"


def any_true(predicates: Sequence[Column]) -> Column:
    """OR of predicates with NULL read as FALSE (never NULL itself)."""
    if not predicates:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [F.coalesce(p, F.lit(False)) for p in predicates])


def any_bad(rules: Sequence[Rule]) -> Column:
    """TRUE when at least one rule is violated (never NULL)."""
    if all_sql(rules):
        return F.expr(any_true_sql(rules))
    return any_true([r.bad() for r in rules])


def reasons_column(rules: Sequence[Rule], schema: T.StructType, sep: str = "; ") -> Column:
    """All violated rules of a row joined in rule order; '' when none.

    ``concat_ws`` skips the NULLs produced by non-matching CASEs, so this
    stays a flat codegen'd expression (no lambdas, no arrays)."""
    if not rules:
        return F.lit("")
    if all_sql(rules):
        parts = ", ".join(f"CASE WHEN {r.sql} THEN {reason_sql(r, schema)} END" for r in rules)
        return F.expr(f"concat_ws({sql_literal(sep)}, {parts})")
    texts = []
    for r in rules:
        texts.append(F.when(r.bad(), F.expr(reason_sql(r, schema))))
    return F.concat_ws(sep, *texts)


def violated_codes(rules: Sequence[Rule]) -> Column:
    """Comma-separated numbers (1-based) of the violated rules."""
    if all_sql(rules):
        parts = ", ".join(f"CASE WHEN {r.sql} THEN '{i}' END" for i, r in enumerate(rules, start=1))
        return F.expr(f"concat_ws(',', {parts})")
    return F.concat_ws(",", *[F.when(r.bad(), F.lit(str(i))) for i, r in enumerate(rules, start=1)])


def count_exprs(rules: Sequence[Rule], prefix: str, extra: str | None = None) -> list[Column]:
    """``count_if`` per rule (optionally AND-ed with ``extra`` SQL), aliased prefix+i."""
    out = []
    for i, r in enumerate(rules):
        if r.sql is not None:
            cond = r.sql if extra is None else f"({extra}) AND {r.sql}"
            out.append(F.expr(f"count_if({cond}) AS {prefix}{i}"))
        else:
            cond = r.bad() if extra is None else (F.expr(extra) & r.bad())
            out.append(F.count_if(cond).alias(f"{prefix}{i}"))
    return out
