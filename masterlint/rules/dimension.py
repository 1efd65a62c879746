"""A rule dimension made from the rules themselves."""

from __future__ import annotations

from masterlint.rules.model import Computed, Keys, Measure, Pairs, Repeats, Rows, Rule
from masterlint.sources.schemas import SOURCES


def measured_tables(measure: Measure) -> list[str]:
    """Table codes a measure names, first mention first."""
    codes: dict[str, None] = {}
    for part in measure:
        if isinstance(part, Rows | Repeats):
            codes[part.table] = None
        elif isinstance(part, Keys):
            codes.update(dict.fromkeys(part.term))
        elif isinstance(part, Pairs):
            codes.update(dict.fromkeys(code for term in part.terms for code in term))
    return list(codes)


def condition_text(rule: Rule) -> str:
    """The failure condition, one line per term."""
    part = rule.fails[0] if rule.fails else None
    if part is None or isinstance(part, Computed):
        return rule.check
    if isinstance(part, Rows | Repeats):
        return f"{part.table}: {part.where}"
    terms = part.terms if isinstance(part, Pairs) else (part.term,)
    return "\n".join("; ".join(f"{code}: {where}" for code, where in term.items()) for term in terms)


def description(rule: Rule, stamp: object) -> tuple:
    """One dimension row; ``stamp`` is the creation and update time."""
    codes = measured_tables(rule.fails) or measured_tables(rule.total)
    return (
        rule.id,
        f"{rule.domain}_{rule.id:03d}",
        rule.note.strip(),
        SOURCES[codes[0]].table,
        condition_text(rule),
        "HIGH" if rule.policy.pass_at >= 99 else "MEDIUM",
        rule.policy.pass_at,
        True,
        stamp,
        stamp,
        rule.tag,
        SOURCES[codes[0]].key,
        ",".join(SOURCES[code].table for code in codes),
        rule.domain.upper(),
    )
