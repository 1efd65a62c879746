"""Counting failures and populations for many rules in few passes.

Rows of one table are counted by a single global aggregate per table.

Counts over joins never build the join. A rule on a join asks how many row pairs
(m, c) with the same key meet A(m) and B(c); per key that is the number of m meeting
A times the number of c meeting B. So each table is first reduced to one row per key
holding one counter per condition, these rows are joined one to one, and the products
are summed. The reduction combines on the map side, so a key that holds a third of a
table costs its tasks one row each, and duplicate keys on both sides multiply numbers
rather than rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from masterlint.functions.conditions import ALWAYS, either, text
from masterlint.rules.model import Computed, Keys, Pairs, Part, Repeats, Rows, Rule, Term
from masterlint.sources.catalog import Catalog
from masterlint.sources.schemas import SOURCES


@dataclass(frozen=True, eq=False)
class Slot:
    """Which number a part contributes to."""

    rule: Rule
    failed: bool
    part: Part


def counts(catalog: Catalog, rules: Iterable[Rule]) -> DataFrame:
    """One row per rule with its grading policy, TOTAL_RECORDS and FAILED_RECORDS."""
    slots = [
        Slot(rule, failed, part)
        for rule in rules
        for failed, measure in ((True, rule.fails), (False, rule.total))
        for part in measure
    ]
    frames = [*_row_frames(catalog, slots), *_key_frames(catalog, slots), *_computed_frames(catalog, slots)]
    rows = reduce(DataFrame.union, frames)
    if len(frames) == 1:
        return rows
    return rows.groupBy("RULE_ID", "PASS_AT", "INCLUSIVE", "FAIL_BELOW", "COARSE_RATE", "NOTE").agg(
        F.sum("TOTAL_RECORDS").alias("TOTAL_RECORDS"), F.sum("FAILED_RECORDS").alias("FAILED_RECORDS")
    )


def _per_rule(wide: DataFrame, numbers: dict[Slot, str]) -> DataFrame:
    """Turns a one-row frame into one row per rule, given a SQL number for each slot."""
    by_rule: dict[int, list[Slot]] = defaultdict(list)
    for slot in numbers:
        by_rule[slot.rule.id].append(slot)

    def added(slots: list[Slot]) -> str:
        return " + ".join(["0L", *[f"{getattr(s.part, 'sign', 1)}L * ({numbers[s]})" for s in slots]])

    def entry(slots: list[Slot]) -> str:
        rule = slots[0].rule
        fields = {
            "RULE_ID": f"{rule.id}L",
            "PASS_AT": f"{rule.policy.pass_at}D",
            "INCLUSIVE": str(rule.policy.inclusive),
            "FAIL_BELOW": f"{rule.policy.fail_below}D",
            "COARSE_RATE": str(rule.coarse_rate),
            "NOTE": text(rule.note),
            "TOTAL_RECORDS": added([s for s in slots if not s.failed]),
            "FAILED_RECORDS": added([s for s in slots if s.failed]),
        }
        return f"named_struct({', '.join(f'{text(name)}, {value}' for name, value in fields.items())})"

    return wide.selectExpr(f"inline(array({', '.join(entry(slots) for slots in by_rule.values())}))")


class _Counters:
    """The distinct conditions asked of one table, each with a column name."""

    def __init__(self, table: str):
        self.table = table
        self.names: dict[str, str] = {}

    def name(self, condition: str) -> str:
        return self.names.setdefault(condition, f"{self.table}_{len(self.names)}")

    def columns(self) -> list[Column]:
        # The condition stays inside the aggregate function: generated code then gets one small
        # method per counter. COUNT_IF would be planned as a projection of all conditions below
        # the aggregate, one method too large for the JVM to compile.
        return [
            F.expr(f"{'count(1)' if condition == ALWAYS else f'count(CASE WHEN {condition} THEN 1 END)'} AS {name}")
            for condition, name in self.names.items()
        ]

    def source(self, catalog: Catalog) -> DataFrame:
        """The table; a lone counter's condition reaches the scan as its filter."""
        df = catalog.table(self.table)
        if ALWAYS in self.names or len(self.names) > 1:
            return df
        return df.filter(F.expr(*self.names))


def _row_frames(catalog: Catalog, slots: list[Slot]) -> list[DataFrame]:
    by_table: dict[str, list[Slot]] = defaultdict(list)
    for slot in slots:
        if isinstance(slot.part, Rows):
            by_table[slot.part.table].append(slot)
    frames = []
    for table, members in by_table.items():
        counters = _Counters(table)
        numbers = {slot: counters.name(slot.part.where) for slot in members}
        frames.append(_per_rule(counters.source(catalog).agg(*counters.columns()), numbers))
    return frames


def _spine(part: Part) -> str | None:
    """The table whose keys drive a keyed count."""
    if isinstance(part, Pairs):
        return next(iter(part.terms[0]))
    if isinstance(part, Keys):
        return next(iter(part.term))
    if isinstance(part, Repeats):
        return part.table
    return None


def _key_frames(catalog: Catalog, slots: list[Slot]) -> list[DataFrame]:
    by_spine: dict[str, list[Slot]] = defaultdict(list)
    for slot in slots:
        spine = _spine(slot.part)
        if spine is not None:
            by_spine[spine].append(slot)
    return [frame for spine, members in by_spine.items() for frame in _spine_frames(catalog, spine, members)]


def _spine_frames(catalog: Catalog, spine: str, slots: list[Slot]) -> list[DataFrame]:
    """Keyed counts that share a spine table, one frame per group of tables joined with it.

    The reduced spine is the same plan in every frame, so its shuffle is run once and
    reused. Its counters travel as one array column for that reason: single columns
    would be pruned differently in each frame.
    """
    key = SOURCES[spine].key
    tables: dict[str, _Counters] = {spine: _Counters(spine)}

    def counter(table: str, condition: str) -> str:
        name = tables.setdefault(table, _Counters(table)).name(condition)
        return f"{spine}[{list(tables[spine].names).index(condition)}]" if table == spine else name

    def product(term: Term) -> str:
        return " * ".join(counter(table, condition) for table, condition in term.items())

    per_key: dict[Slot, str] = {}
    for slot in slots:
        part = slot.part
        if isinstance(part, Pairs):
            per_key[slot] = " + ".join(product(term) for term in part.terms)
        elif isinstance(part, Keys):
            per_key[slot] = f"if({key} IS NOT NULL AND {product(part.term)} > 0, 1L, 0L)"
        else:
            copies = counter(part.table, part.where)
            per_key[slot] = f"if({copies} > 1, {copies}, 0L)"

    reduced = {code: _by_key(catalog, counters, key) for code, counters in tables.items() if code != spine}
    spine_rows = _by_key(catalog, tables[spine], key, keep_null=True).selectExpr(
        key, f"array({', '.join(tables[spine].names.values())}) AS {spine}"
    )
    frames = []
    for joined in _join_groups([(_tables(slot.part) - {spine}) for slot in slots]):
        members = {slot: value for slot, value in per_key.items() if _tables(slot.part) - {spine} <= joined}
        if joined:
            members = {slot: value for slot, value in members.items() if _tables(slot.part) != {spine}}
        # a key that a joined table lacks has null counters there; its null product adds nothing
        rows = spine_rows
        for code in sorted(joined):
            rows = rows.join(reduced[code], key, "left")
        # several slots may ask for the same number, such as a population shared by many rules
        names = {value: f"N_{index}" for index, value in enumerate(dict.fromkeys(members.values()))}
        sums = rows.agg(*[F.expr(f"coalesce(sum({value}), 0L) AS {name}") for value, name in names.items()])
        frames.append(_per_rule(sums, {slot: names[value] for slot, value in members.items()}))
    return frames


def _join_groups(needed: list[set[str]]) -> list[set[str]]:
    """Merges overlapping sets of tables, so that each table is reduced and joined once."""
    groups: list[set[str]] = []
    for tables in needed:
        overlapping = [group for group in groups if group & tables or group == tables]
        groups = [group for group in groups if group not in overlapping]
        groups.append(tables.union(*overlapping))
    return groups


def _tables(part: Part) -> set[str]:
    if isinstance(part, Pairs):
        return {table for term in part.terms for table in term}
    return set(part.term) if isinstance(part, Keys) else {part.table}


def _by_key(catalog: Catalog, counters: _Counters, key: str, keep_null: bool = False) -> DataFrame:
    df = counters.source(catalog)
    if not keep_null:
        df = df.filter(F.col(key).isNotNull())
    return df.groupBy(key).agg(*counters.columns())


def _computed_frames(catalog: Catalog, slots: list[Slot]) -> list[DataFrame]:
    by_frame: dict[object, list[Slot]] = defaultdict(list)
    for slot in slots:
        if isinstance(slot.part, Computed):
            by_frame[slot.part.frame].append(slot)
    return [
        _per_rule(frame(catalog), {slot: f"coalesce({slot.part.column}, 0L)" for slot in members})
        for frame, members in by_frame.items()
    ]
