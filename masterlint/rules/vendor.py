"""Rules on vendor master data (tables V, L, F, K, A, W)."""

from __future__ import annotations

from functools import partial

from masterlint.functions.conditions import ALWAYS, both, either, is_in, missing, outside, present
from masterlint.operators import grouped, listing
from masterlint.operators.grouped import IN_SCOPE
from masterlint.rules.model import (
    G90,
    G95,
    G99,
    H93,
    H100,
    Computed,
    Listing,
    Measure,
    Pairs,
    Policy,
    Repeats,
    Rows,
    Rule,
    Term,
)
from masterlint.rules.notes import NOTES

SHORT = "LIFNR5 AS LIFNR"
VENDORS = (Rows("L", IN_SCOPE),)
CONTACTS = (Pairs(({"L": IN_SCOPE, "K": ALWAYS},)),)
PARTNERS = (Rows("W", IN_SCOPE),)


def _rule(id: int, check: str, policy: Policy, tag: str, fails: Measure, total: Measure, rows: Listing) -> Rule:
    return Rule(id, "vendor", check, fails, total, policy, NOTES[id], tag, rows)


def on_vendor(id: int, check: str, policy: Policy, wrong: str, *columns: str, scope: str = IN_SCOPE) -> Rule:
    """A rule on single vendors: rows in ``scope`` that are ``wrong``."""
    fails = (Rows("V", both(scope, wrong)),)
    return _rule(id, check, policy, "LFA1", fails, (Rows("V", scope),), Listing((SHORT, *columns)))


def filled(id: int, policy: Policy, column: str, *more: str) -> Rule:
    return on_vendor(id, "COMPLETENESS", policy, missing(column, or_empty=True), column, *more)


def on_join(
    other: str,
    tag: str,
    total: Measure,
    id: int,
    check: str,
    policy: Policy,
    wrong: str,
    *columns: str,
    scope: str = IN_SCOPE,
    listed_rows: tuple[Term, ...] | None = None,
) -> Rule:
    """A rule on vendors joined with another table.

    The scope digit comes from the join key, so a condition on the other table may
    use it too, which is how a failure can lie outside ``scope``.
    """
    terms: tuple[Term, ...] = ({"L": scope, other: wrong},)
    return _rule(id, check, policy, tag, (Pairs(terms),), total, Listing(columns, terms=listed_rows))


def vendor_rules() -> list[Rule]:
    purchasing = partial(on_join, "F", "LFM1", VENDORS)
    contact = partial(on_join, "K", "KNVK", CONTACTS)
    blank = partial(missing, or_empty=True)
    foreign = both(IN_SCOPE, "LAND1 <> 'ES'")
    commercial = is_in("PAFKT", ("Z3", "Z4"))
    repeated = partial(listing.repeated_keys, code="V", where=IN_SCOPE, shown="right(lpad(LIFNR, 10, '0'), 5) AS LIFNR", copies="registros")
    return [
        _rule(
            93, "UNIQUE", H93, "LFA1", (Repeats("V", IN_SCOPE),), (Rows("V", IN_SCOPE),), Listing(frame=repeated)
        ),
        filled(94, G95, "LAND1"),
        filled(95, H100, "NAME1"),
        filled(96, G90, "NAME2"),
        filled(97, H100, "ORT01"),
        filled(98, G95, "PSTLZ"),
        filled(99, G95, "REGIO"),
        filled(100, G90, "SORTL"),
        filled(101, G99, "STRAS"),
        on_vendor(102, "DOMAIN", G99, outside("KTOKK", "Z001"), "KTOKK"),
        filled(105, G95, "SPRAS"),
        filled(106, G99, "STCD1", "LAND1"),
        on_vendor(107, "COMPLETENESS", G99, blank("STCEG"), "LAND1", "STCEG", scope=foreign),
        _rule(
            108, "COMPLETENESS", G99, "LFA1", (Rows("L", both(IN_SCOPE, blank("ZZDIAPED"))),), VENDORS,
            Listing(
                (SHORT, "SCOPE_DIGIT AS d1", "ZZDIAPED"), distinct=True,
                terms=({"L": both(IN_SCOPE, either(blank("ZZDIAPED"), "ZZDIAPED NOT IN ('0', '1')"))},),
            ),
        ),
        purchasing(
            109, "COMPLETENESS", G90, either(both(IN_SCOPE, missing("WAERS")), "WAERS = ''"), "L.LIFNR", "F.WAERS",
            scope=ALWAYS,
        ),
        purchasing(110, "COMPLETENESS", G99, blank("WEBRE"), "L.LIFNR", "F.WEBRE"),
        purchasing(111, "DOMAIN", G90, outside("EKGRP", "001", "Z15", "Z12"), "L.LIFNR", "F.EKGRP"),
        purchasing(112, "DOMAIN", G99, outside("BSTAE", "Z004", null_fails=False), "L.LIFNR", "F.BSTAE"),
        # a (vendor, contact number) group holds one contact number, so it never has two: nothing to count
        _rule(113, "UNIQUE", G90, "KNVK", (), CONTACTS, Listing(frame=listing.repeated_contacts)),
        contact(114, "COMPLETENESS", G90, blank("NAMEV"), "L.LIFNR", "K.NAMEV"),
        on_join(
            "K", "KNVK", (Pairs(({"L": IN_SCOPE, "K": commercial},)),), 115, "COMPLETENESS", G90,
            both(commercial, blank("TELF1")), "L.LIFNR", "K.TELF1", "K.PAFKT",
        ),
        contact(
            116, "DOMAIN", G90,
            both(present("PARNR"), outside("PAFKT", "10", "Z0", "Z3", "Z4", "Z5", "Z6", "Z7", "Z8", "Z9", null_fails=False)),
            "L.LIFNR", "K.PARNR", "K.PAFKT",
        ),
        contact(
            117, "COMPLETENESS", G90, either(both(IN_SCOPE, present("PARNR"), missing("PARLA")), "PARLA = ''"),
            "L.LIFNR5 AS LIFNR", "K.PARNR", "K.PARLA", scope=ALWAYS,
            listed_rows=({"L": IN_SCOPE, "K": both(present("PARNR"), blank("PARLA"))},),
        ),
        _rule(
            118, "COMPLETENESS", G95, "ADR6", (Computed(grouped.contact_mail, "FAILED"),), CONTACTS,
            Listing(frame=listing.unreachable_contacts),
        ),
        _rule(
            119, "REQUIRED_ROLES", G95, "WYT3", (Computed(grouped.required_roles, "FAILED"),), PARTNERS,
            Listing(order=("LIFNR",), frame=listing.vendors_with_role_faults),
        ),
        _rule(
            120, "CROSS_REFERENCE", G95, "WYT3", (Computed(grouped.partner_references, "FAILED"),), PARTNERS,
            Listing(order=("LIFNR",), frame=listing.listed_references),
        ),
    ]
