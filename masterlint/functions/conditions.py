"""Builders for rule conditions.

A condition is a Spark SQL boolean expression held as text. Text keeps rules plain
data: conditions can be listed, compared, deduplicated and stored in the rule
dimension, and they need no running session until a plan is built from them.
"""

from __future__ import annotations

from collections.abc import Iterable

ALWAYS = "TRUE"

# Every character with the Unicode White_Space property.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009"
    "\u200a\u2028\u2029\u202f\u205f\u3000"
)


def text(value: str) -> str:
    """A SQL string literal, safe for quotes and backslashes."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def listed(values: Iterable[str]) -> str:
    return "(" + ", ".join(text(v) for v in values) + ")"


def trimmed(column: str) -> str:
    """Strips all Unicode white space, where plain TRIM would strip only spaces."""
    return f"btrim({column}, {text(WHITE_SPACE)})"


def blank_to_null(column: str) -> str:
    return f"nullif({trimmed(column)}, '')"


def both(*conditions: str) -> str:
    return " AND ".join(f"({c})" for c in conditions if c != ALWAYS) or ALWAYS


def either(*conditions: str) -> str:
    return " OR ".join(f"({c})" for c in conditions)


def is_in(column: str, values: Iterable[str]) -> str:
    return f"{column} IN {listed(values)}"


def missing(column: str, *, or_empty: bool = False) -> str:
    """Completeness: null, and for ``or_empty`` also the empty (untrimmed) string."""
    return f"{column} IS NULL OR {column} = ''" if or_empty else f"{column} IS NULL"


def present(column: str) -> str:
    return f"{column} IS NOT NULL"


def outside(column: str, *allowed: str, null_fails: bool = True) -> str:
    """Domain: the value is none of ``allowed``; a null fails unless told otherwise."""
    wrong = f"{column} <> {text(allowed[0])}" if len(allowed) == 1 else f"{column} NOT IN {listed(allowed)}"
    return either(wrong, missing(column)) if null_fails else wrong


def zero_or_missing(column: str) -> str:
    return f"{column} = 0 OR {column} IS NULL"


def length_outside(column: str, low: int, high: int) -> str:
    """Format: missing, or a number of characters outside ``low``..``high``."""
    return f"{column} IS NULL OR length({column}) NOT BETWEEN {low} AND {high}"


def decide(*branches: tuple[str, str], otherwise: str | None = None) -> str:
    """Decision table: the outcome of the first branch whose condition holds."""
    arms = " ".join(f"WHEN {condition} THEN {text(outcome)}" for condition, outcome in branches)
    return f"CASE {arms} ELSE {'NULL' if otherwise is None else text(otherwise)} END"
