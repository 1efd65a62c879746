"""All rules."""

from __future__ import annotations

from functools import cache

from masterlint.rules.material import material_rules
from masterlint.rules.model import Rule
from masterlint.rules.vendor import vendor_rules

DOMAINS = ("material", "vendor")


@cache
def all_rules() -> dict[int, Rule]:
    return {rule.id: rule for rule in [*material_rules(), *vendor_rules()]}


def rules_of(domain: str) -> list[Rule]:
    return [rule for rule in all_rules().values() if rule.domain == domain]
