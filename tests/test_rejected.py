"""Values that cannot be read: null for the rules on their column, reported, and no harm to the rest."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from compare import connect, duck_bag, spark_bag
from masterlint.plans.report import results
from masterlint.plans.run import run_rules
from masterlint.rules.registry import all_rules, rules_of
from masterlint.sinks.store import REJECTED, Store
from masterlint.sources import samples
from masterlint.sources.catalog import Catalog
from masterlint.sources.schemas import SOURCES


@pytest.fixture(scope="module")
def spoiled(spark, samples_small):
    """Tables of texts only, of which one UMREZ is no number, and the same tables without that value."""
    whole = {code: samples.derive(spark, samples_small, code) for code in SOURCES}
    one = whole["R"].filter("MEINH = 'PAL' AND UMREZ = 72").agg(F.min("MATNR")).first()[0]
    mine = f"MATNR = '{one}' AND MEINH = 'PAL'"
    texts = {code: df.selectExpr(*[f"cast({c} AS string) AS {c}" for c in df.columns]) for code, df in whole.items()}
    texts["R"] = texts["R"].withColumn("UMREZ", F.expr(f"IF({mine}, '7Z', UMREZ)"))
    without = whole | {"R": whole["R"].withColumn("UMREZ", F.expr(f"IF({mine}, NULL, UMREZ)"))}
    return one, texts, without, whole


@pytest.fixture(scope="module")
def samples_small() -> str:
    return "/root/testdata/sf0.001"


def test_one_bad_value_leaves_the_other_rules_right(spark, spoiled, tmp_path):
    key, texts, without, whole = spoiled
    rules = rules_of("material")
    store = Store(spark, str(tmp_path))
    run = run_rules(Catalog.of_frames(spark, texts), rules, store, run_id="a")
    assert run.rejected == {("bqt_ztbw_marm", "UMREZ"): 1}
    assert {tuple(row) for row in run.results} == {tuple(row) for row in results(Catalog.of_frames(spark, without), rules).collect()}
    clean = {row.RULE_ID: tuple(row) for row in results(Catalog.of_frames(spark, whole), rules).collect()}
    # of the rules only those on the largest pallet can differ
    assert {row.RULE_ID for row in run.results if tuple(row) != clean[row.RULE_ID]} <= {84, 85}
    # a repeated run keeps its values once
    run_rules(Catalog.of_frames(spark, texts), [all_rules()[84]], store, run_id="a")
    assert [tuple(row) for row in store.read(REJECTED).collect()] == [("bqt_ztbw_marm", key, "UMREZ", "7Z", "a")]


def test_typed_tables_have_none_and_are_not_read(spark, samples_small):
    catalog = Catalog.of_samples(spark, samples_small)
    for code in SOURCES:
        catalog.table(code)
    assert catalog.rejected() is None


def test_texts_that_are_all_numbers_write_nothing(spark, spoiled, tmp_path):
    _, texts, _, _ = spoiled
    store = Store(spark, str(tmp_path))
    run = run_rules(Catalog.of_frames(spark, texts), [all_rules()[2]], store)
    assert run.rejected == {} and not store.has(REJECTED)


def test_kinds_of_values(spark):
    names = SOURCES["R"].schema.names
    given = [("1", "12", 1e30), ("2", " 12 ", 2.5), ("3", "1.5", None), ("4", "", 0.0004), ("5", None, float("nan")), (None, "9" * 30, 1.0)]
    frame = spark.createDataFrame(given, "MATNR string, UMREZ string, BRGEW double")
    frame = frame.selectExpr("*", *[f"cast(NULL AS string) AS {name}" for name in names if name not in frame.columns])
    catalog = Catalog.of_frames(spark, {"R": frame})
    read = {row.MATNR: (row.UMREZ, row.BRGEW) for row in catalog.table("R").collect()}
    assert [v[0] for v in read.values()] == [12, 12, None, None, None, None]
    assert [v[1] for v in read.values()] == [None, Decimal("2.5"), None, Decimal("0.0004"), None, Decimal(1)]
    found = {(row.ROW_KEY, row.COLUMN_NAME, row.VALUE) for row in catalog.rejected().collect()}
    assert found == {
        ("1", "BRGEW", "1.0E30"),
        ("3", "UMREZ", "1.5"),
        ("4", "UMREZ", ""),
        ("5", "BRGEW", "NaN"),
        (None, "UMREZ", "9" * 30),
    }


def test_rejected_values_of_a_database(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS dq_rejected LOCATION '{tmp_path}/dq_rejected'")
    store = Store(spark, database="dq_rejected")
    rows = spark.createDataFrame([("t", "1", "A", "x"), ("t", "2", "A", "y")], "SOURCE_TABLE string, ROW_KEY string, COLUMN_NAME string, VALUE string")
    for run_id in ("a", "b", "a"):
        assert store.put_rejected(rows, run_id) == {("t", "A"): 2}
    assert sorted((row.ROW_KEY, row.RUN_ID) for row in store.read(REJECTED).collect()) == [("1", "a"), ("1", "b"), ("2", "a"), ("2", "b")]
    spark.sql("DROP DATABASE dq_rejected CASCADE")


@pytest.mark.parametrize("name", ["rejected_values", "rejected_suite"])
def test_queries_agree_with_sql(spark, samples, name):
    assert spark_bag(entry_point.queries()[name](spark, samples)) == duck_bag(connect(samples), entry_point.oracle_sql()[name])
