"""Plan shapes that scale: no pair-building joins, few scans, pushed filters."""

from __future__ import annotations

import re

import pytest

from masterlint.functions.conditions import ALWAYS
from masterlint.operators.grouped import equal_quantities
from masterlint.operators.listing import violations
from masterlint.operators.masks import failing_rows, relations
from masterlint.plans.report import results
from masterlint.rules.model import Pairs
from masterlint.rules.registry import DOMAINS, all_rules, rules_of
from masterlint.sources.catalog import Catalog
from masterlint.sources.schemas import SOURCES


@pytest.fixture(scope="module")
def staged(spark, catalog, tmp_path_factory):
    """The sample tables written out as staging tables."""
    root = str(tmp_path_factory.mktemp("staging"))
    for code, source in SOURCES.items():
        catalog.table(code).select(*source.schema.names).write.parquet(f"{root}/{source.table}")
    return Catalog.of_parquet(spark, root)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("domain", DOMAINS)
def test_suite_plan(staged, domain):
    df = results(staged, rules_of(domain))
    initial = plan(df)
    assert "Cartesian" not in initial
    assert "NestedLoop" not in initial
    # 351 table reads in a rule-by-rule run
    assert initial.count("FileScan parquet") <= {"material": 20, "vendor": 14}[domain]
    df.collect()
    final = plan(df)
    assert domain == "vendor" or "ReusedExchange" in final or final.count("FileScan parquet") < initial.count("FileScan")


def test_staged_tables_give_the_same_results(catalog, staged):
    rules = all_rules().values()
    assert set(results(staged, rules).collect()) == set(results(catalog, rules).collect())


@pytest.mark.parametrize("rule_id", sorted(all_rules()))
def test_listing_plans_build_no_cross_products(staged, rule_id):
    text = plan(violations(staged, all_rules()[rule_id]))
    assert "Cartesian" not in text
    assert "NestedLoop" not in text


def test_failing_rows_of_a_relation_take_one_scan_a_table(staged):
    found = relations(all_rules().values())
    assert sum(map(len, found.values())) == 101
    for codes, rules in found.items():
        text = plan(failing_rows(staged, codes, rules))
        assert text.count("FileScan parquet") == len(codes)
        assert "Cartesian" not in text and "NestedLoop" not in text and "Python" not in text


def test_filters_and_columns_reach_the_scan(staged):
    text = plan(violations(staged, all_rules()[45]))
    pushed = " ".join(re.findall(r"PushedFilters: \[(.*?)\]", text))
    assert "IsNull(HERKL)" in pushed
    assert "In(MTART" in pushed
    schemas = re.findall(r"ReadSchema: struct<(.*?)>", text)
    assert sorted(len(schema.split(",")) for schema in schemas) == [2, 4]


def test_equal_quantities_shuffle_each_side_once(spark, staged):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(equal_quantities(staged))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert text.count("Exchange hashpartitioning") == 2


def test_terms_of_a_rule_are_disjoint(staged):
    """Counting adds up terms, so no joined row may meet two of them."""
    for rule in all_rules().values():
        for part in rule.fails:
            if not isinstance(part, Pairs) or len(part.terms) == 1:
                continue
            codes = list(part.terms[0])
            assert all(list(term) == codes for term in part.terms)
            for index, left in enumerate(part.terms):
                for right in part.terms[index + 1 :]:
                    overlaps = [
                        staged.table(code).filter(f"({left[code]}) AND ({right[code]})").isEmpty()
                        for code in codes
                        if ALWAYS not in (left[code], right[code])
                    ]
                    assert any(overlaps), rule.id
