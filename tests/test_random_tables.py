"""Every rule over small random tables full of nulls, blanks, duplicates and hot keys.

The engine counts by per-key reductions; DuckDB evaluates row-level predicates over
the real joins of the same tables.
"""

from __future__ import annotations

import random
from decimal import Decimal
from functools import cache

import duckdb
import pyarrow as pa
import pytest
from compare import duck_bag, spark_bag
from pyspark.sql import types as T

from masterlint.operators.listing import violations
from masterlint.plans.report import results
from masterlint.rules.registry import all_rules
from masterlint.sources.catalog import Catalog
from masterlint.sources.schemas import SOURCES
from oracle import duck as oracle

ROWS = 160
MATERIALS = ["10001", "10002", "30003", "40004", "20005", "7", "000000000000010001", "123456789012345678901"]
VENDORS = ["0000010001", "0000010002", "0000020003", "0000010004", "77"]
PLANTS = ["6440", "6443", "6240", "6245", "6340", "6344", "4400", "4300", "6445", " 6440 ", "06440", " ", "", "x", None]
VALUES: dict[str, list] = {
    "MATNR": MATERIALS,
    "LIFNR": VENDORS,
    "ADRNR": ["1", "2", "3", None],
    "ADDRNUMBER": ["1", "2", "3", None],
    "MTART": ["ZMER", "ZFRE", "ZSEC", "ROH", None],
    "MEINS": ["ST", "CS", "KG", None],
    "MEINH": ["ST", "CS", "KG", "PAL", "CAP", None],
    "BISMT": ["000001", "000002", "000003", "AB12", "", None],
    "ZZSUSTITUTO": ["10001", "10002", "30003", "40004", "99999", "", None],
    "PRDHA": ["101010010510000001", "101010010510", "   ", "201010010510000001", None],
    "MATKL": ["METRO", " METRO ", "OTHER", "  ", None],
    "WERKS": PLANTS,
    "LGPRO": ["6444", "6443", "6440", "6240", "6344", " 6440", "", None],
    "LGFSB": ["6444", "6243", "6440", None],
    "PRCTR": ["F6444", "F6443", "F6440", None],
    "STAWN": ["12345", "123456", "1234567890", "12345678901", None],
    "EKGRP": ["001", "Z15", "Z12", "Z99", "", None],
    "SOBSL": ["42", "Z4", "44", "43", "XX", None],
    "SPRAS": ["S", "E", "", None],
    "TXTMD": ["plain", "jamón", "quote'", 'double"', "back\\slash", "ñandú", "niño", "  ", "y" * 41, None],
    "EAN11": ["8400000000017", "18400000000014", "123", "", None],
    "NUMTP": ["HE", "IC", "UC", None],
    "MEGRU": ["Z001", "Z002", " Z002 ", "Z009", None],
    "BKLAS": ["PT01", "PT03", "PT04", None],
    "VPRSV": ["V", " V ", "S", "", None],
    "LAND1": ["ES", "PT", "", None],
    "ZZDIAPED": ["0", "1", "7", "", None],
    "PARVW": ["BA", " lf", "RS", "ZE", "ze ", "ZO", "DP", "PR", "EF", "", None],
    "LIFN2": [*VENDORS, "0c0x", "0C0", " 0000010001 ", "", None],
    "NAME1": ["a", "b", "", None],
    "PARNR": ["1", "2", "", None],
    "PAFKT": ["Z3", "10", "99", None],
    "ZZTEMPERATURA": ["CONGELADO", "SECO", "REFRIGERAD", "OTRO", None],
    "CWM_XCWMAT": ["X", "", None],
    "CWM_TOLGR": ["T1", "", None],
}
NUMBERS = {
    "UMREN": [0, 1, 2, 3, None],
    "UMREZ": [0, 1, 2, 3, 6, 70, 72, None],
    "BSTRF": [0, 3, 4, None],
    "BSTMI": [2, 6, 8, 9, None],
}
QUANTITIES = [Decimal(q) for q in ("0.000", "0.500", "1.000", "1.500", "2.000", "3.000", "0.333", "9.000")]
OTHER_TEXT = ["A", "X", "10", "0001", "KG", "M3", "MM", "Z2", "ZNORM", "ES14", "Z01", "", None]


def _value(rng: random.Random, field: T.StructField, hot: bool):
    if isinstance(field.dataType, T.DecimalType):
        return rng.choice([*QUANTITIES, None])
    if isinstance(field.dataType, T.LongType):
        return rng.choice(NUMBERS.get(field.name, [0, 1, 5, None]))
    choices = VALUES.get(field.name, OTHER_TEXT)
    if field.name in ("MATNR", "LIFNR") and hot:
        return choices[0]
    return rng.choice(choices)


def _table(rng: random.Random, code: str) -> list[tuple]:
    schema = SOURCES[code].schema
    rows = [tuple(_value(rng, field, rng.random() < 0.33) for field in schema) for _ in range(ROWS)]
    return rows + rows[:10]


@pytest.fixture(scope="module")
def tables(spark):
    """Engine catalog and DuckDB connection over the same tables, by seed."""
    return cache(lambda seed: _both(spark, seed))


def _both(spark, seed: int):
    rng = random.Random(seed)
    connection = duckdb.connect()
    frames = {}
    for code, source in SOURCES.items():
        rows = _table(rng, code)
        frames[code] = spark.createDataFrame(rows, source.schema)
        arrow = {str: pa.string(), "int": pa.int32()}
        columns = []
        for index, field in enumerate(source.schema):
            if isinstance(field.dataType, T.DecimalType):
                kind = pa.decimal128(13, 3)
            else:
                kind = arrow["int"] if isinstance(field.dataType, T.LongType) else arrow[str]
            columns.append(pa.array([row[index] for row in rows], kind))
        table = pa.table(columns, names=source.schema.names)
        connection.register(f"{code}_rows", table)
        connection.execute(f"CREATE TABLE {code} AS SELECT * FROM {code}_rows")
    return Catalog.of_frames(spark, frames), connection


@pytest.mark.parametrize("seed", [1, 2])
def test_counts(tables, seed):
    catalog, connection = tables(seed)
    rules = all_rules()
    found = spark_bag(results(catalog, rules.values()))
    assert found == duck_bag(connection, oracle.results(rules, staged=True))


def test_one_rule_at_a_time_equals_fused(tables):
    catalog, _ = tables(1)
    rules = [all_rules()[i] for i in (1, 15, 24, 72, 74, 90, 113, 118)]
    fused = {row.RULE_ID: row for row in results(catalog, rules).collect()}
    assert {rule.id: results(catalog, [rule]).first() for rule in rules} == fused


@pytest.mark.parametrize("rule_id", sorted(all_rules()))
def test_listings(tables, rule_id):
    catalog, connection = tables(1)
    found = spark_bag(violations(catalog, all_rules()[rule_id]))
    assert found == duck_bag(connection, oracle.violations(rule_id, staged=True))
