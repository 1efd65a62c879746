"""All rules over the sample tables: golden counts, and DuckDB side by side."""

from __future__ import annotations

import re

import pytest
from compare import connect, duck_bag, spark_bag
from conftest import ROOT

import __spark_entry__ as entry_point
from masterlint.plans.report import results
from masterlint.rules.registry import DOMAINS, all_rules, rules_of

GOLDEN_ROW = re.compile(r"^\| (\d+) \| (\d+) \| (\d+) \| ([\d.]+) \| (\w+) \|$", re.MULTILINE)
RULES = sorted(all_rules())


@pytest.fixture(scope="module")
def duck(samples):
    return connect(samples)


def test_rule_ids():
    assert RULES == sorted(set(range(1, 121)) - {4, 10, 48, 59, 103, 104})
    assert [len(rules_of(domain)) for domain in DOMAINS] == [88, 26]


def test_every_query_has_a_check():
    own = {name for name in entry_point.queries() if name.split("_")[0] in ("rule", "viol", "suite", "daily", "cube", "fact", "export")}
    assert len(own) == 2 * len(RULES) + len(DOMAINS) + 4
    assert own <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("domain", DOMAINS)
def test_golden_counts(catalog, domain):
    golden = {
        int(rule): (int(total), int(failed), float(rate), status)
        for rule, total, failed, rate, status in GOLDEN_ROW.findall((ROOT / "FIXTURES.md").read_text())
    }
    found = {
        row.RULE_ID: (row.TOTAL_RECORDS, row.FAILED_RECORDS, round(row.PASSED_PERCENTAGE, 2), row.STATUS)
        for row in results(catalog, rules_of(domain)).collect()
    }
    assert found == {rule.id: golden[rule.id] for rule in rules_of(domain)}


@pytest.mark.parametrize("name", ["suite_material", "suite_vendor", "daily_cube", "cube_history", "fact_rows", "export_gate"])
def test_fused_queries(spark, samples, duck, name):
    assert spark_bag(entry_point.queries()[name](spark, samples)) == duck_bag(duck, entry_point.oracle_sql()[name])


@pytest.mark.parametrize("rule_id", RULES)
def test_listings(spark, samples, duck, rule_id):
    name = f"viol_{rule_id:03d}"
    assert spark_bag(entry_point.queries()[name](spark, samples)) == duck_bag(duck, entry_point.oracle_sql()[name])


@pytest.mark.parametrize("rule_id", [1, 3, 9, 15, 16, 24, 40, 43, 69, 72, 74, 82, 85, 88, 92, 93, 107, 113, 117, 118, 120])
def test_single_rules(spark, samples, duck, rule_id):
    name = f"rule_{rule_id:03d}"
    assert spark_bag(entry_point.queries()[name](spark, samples)) == duck_bag(duck, entry_point.oracle_sql()[name])


def test_entry_returns_every_rule(spark):
    assert entry_point.entry(spark).count() == len(RULES)
