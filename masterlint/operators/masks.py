"""The failing rows of many rules, each relation read and joined once.

A relation is the tables a listing joins. Every table packs its part of all rules' conditions into bits before
the join, so a joined row carries one number a table, however many rules look at it. Of the bits come the rules
that the row fails, a mask again, and the row is given once for each of them.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from masterlint.functions.conditions import ALWAYS
from masterlint.operators.listing import dealt_anew
from masterlint.rules.model import Rule, Term
from masterlint.sources.catalog import Catalog
from masterlint.sources.schemas import SOURCES

#: Bits of one number.
WORD = 62


def relations(rules: Iterable[Rule]) -> dict[tuple[str, ...], list[Rule]]:
    """The rules whose listings are conditions on one relation; those with a plan of their own are in none."""
    found: dict[tuple[str, ...], list[Rule]] = defaultdict(list)
    for rule in rules:
        if rule.listing.frame is None:
            found[tuple(rule.terms()[0])].append(rule)
    return dict(found)


class _Bits:
    """The conditions on a table as bits of a few numbers."""

    def __init__(self, code: str):
        self.code = code
        self.places: dict[str, int] = {}

    def place(self, condition: str) -> int:
        return self.places.setdefault(condition, len(self.places))

    def _name(self, place: int) -> str:
        return f"{self.code}_BITS_{place // WORD}"

    def columns(self) -> dict[str, Column]:
        """The numbers; a condition that is null is not met."""
        words: dict[str, list[Column]] = defaultdict(list)
        for condition, place in self.places.items():
            words[self._name(place)].append(F.when(F.expr(condition), F.lit(1 << place % WORD).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
        return {name: reduce(Column.bitwiseOR, bits) for name, bits in words.items()}

    def has(self, condition: str) -> Column:
        place = self.places[condition]
        return F.col(self._name(place)).bitwiseAND(F.lit(1 << place % WORD)) != 0

    def any(self) -> Column:
        names = dict.fromkeys(map(self._name, self.places.values()))
        return reduce(Column.__or__, [F.col(name) != 0 for name in names])


def _sides(catalog: Catalog, codes: tuple[str, ...], rules: list[Rule]) -> tuple[DataFrame, dict[str, _Bits]]:
    """The relation's joined rows with each table's bits, without rows of a table that meet nothing there."""
    bits = {code: _Bits(code) for code in codes}
    always = {code: False for code in codes}
    for rule in rules:
        for term in rule.terms():
            for code, condition in term.items():
                if condition == ALWAYS:
                    always[code] = True
                else:
                    bits[code].place(condition)
    sides = []
    for code in codes:
        df = catalog.table(code).filter(F.col(SOURCES[code].key).isNotNull())
        if bits[code].places:
            df = df.withColumns(bits[code].columns())
            if not always[code]:
                df = df.filter(bits[code].any())
        sides.append(df.alias(code))
    first, key = codes[0], SOURCES[codes[0]].key
    rows = sides[0]
    for position, (code, side) in enumerate(zip(codes[1:], sides[1:], strict=True)):
        left = F.col(f"{first}.{key}") if position == 0 else dealt_anew(f"{first}.{key}")
        rows = rows.join(side, left == F.col(f"{code}.{key}"))
    return rows, bits


def failing_rows(catalog: Catalog, codes: tuple[str, ...], rules: list[Rule]) -> DataFrame:
    """RULE_ID, VALUES (the listing's columns and hidden ones, as text) and COPIES of the rows that rules on the
    relation of codes fail.

    Equal rows of a rule are counted on the map side, so that copies travel once; in a distinct listing they
    count as one. A key that holds many rows of both sides is a join's hot key, which adaptive execution splits.
    """
    if len(codes) == 1:
        # no join to carry bits through: the conditions decide at once
        rows, bits = catalog.table(codes[0]).alias(codes[0]), None
    else:
        rows, bits = _sides(catalog, codes, rules)

    def meets(term: Term) -> Column:
        if bits is None:
            return F.expr(term[codes[0]])
        return reduce(Column.__and__, [bits[code].has(condition) for code, condition in term.items() if condition != ALWAYS], F.lit(True))

    failed = [F.when(reduce(Column.__or__, map(meets, rule.terms())), F.lit(rule.id)) for rule in rules]
    each = rows.withColumn("RULE_ID", F.explode(F.array_except(F.array(*failed), F.array(F.lit(None).cast("int")))))
    values = F.when(F.lit(False), F.array(F.lit("")))
    for rule in rules:
        items = [F.expr(item).cast("string") for item in (*rule.listing.columns, *rule.listing.hidden)]
        values = values.when(F.col("RULE_ID") == rule.id, F.array(*items))
    counted = each.select("RULE_ID", values.alias("VALUES")).groupBy("RULE_ID", "VALUES").agg(F.count(F.lit(1)).alias("COPIES"))
    once = F.col("RULE_ID").isin([rule.id for rule in rules if rule.listing.distinct])
    return counted.withColumn("COPIES", F.when(once, F.lit(1).cast("bigint")).otherwise(F.col("COPIES")))
