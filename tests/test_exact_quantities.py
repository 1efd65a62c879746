"""Quantities with more places than three are neither rounded nor lost."""

from __future__ import annotations

import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import types as T

from masterlint.operators.listing import violations
from masterlint.plans.report import results
from masterlint.rules.registry import all_rules
from masterlint.sources.catalog import Catalog
from masterlint.sources.schemas import FINE_QUANTITY, QUANTITY, SOURCES


def staged(spark, kind, **rows) -> Catalog:
    """Staging tables whose quantities are of another type; unnamed columns are null, unnamed tables empty."""
    frames = {}
    for code, source in SOURCES.items():
        schema = T.StructType([T.StructField(f.name, kind if f.dataType == QUANTITY else f.dataType) for f in source.schema])
        frames[code] = spark.createDataFrame([tuple(row.get(name) for name in schema.names) for row in rows.get(code, [])], schema)
    return Catalog.of_frames(spark, frames)


def failed(catalog, rule_id):
    return results(catalog, [all_rules()[rule_id]]).first().FAILED_RECORDS


GOOD = {"MTART": "ZMER", "MEINS": "ST"}


@pytest.mark.parametrize("kind", [T.DecimalType(13, 4), FINE_QUANTITY, T.StringType(), T.DoubleType()])
def test_small_weights_are_weights(spark, kind):
    convert = {T.StringType(): str, T.DoubleType(): float}.get(kind, Decimal)
    small, none = convert("0.0004"), convert("0")
    catalog = staged(
        spark, kind, M=[{"MATNR": "1", "BRGEW": small, "NTGEW": small, "VOLUM": small, **GOOD}, {"MATNR": "2", "BRGEW": none, "NTGEW": none, "VOLUM": none, **GOOD}]
    )
    for rule_id in (29, 30, 32):
        assert failed(catalog, rule_id) == 1
    assert [row.BRGEW for row in violations(catalog, all_rules()[29]).collect()] == [0]


def test_types_of_quantities(spark):
    three = staged(spark, T.DecimalType(10, 2))
    assert three.table("M").schema["BRGEW"].dataType == QUANTITY
    assert staged(spark, T.DecimalType(20, 3)).table("M").schema["BRGEW"].dataType == T.DecimalType(20, 3)
    assert staged(spark, T.LongType()).table("R").schema["BRGEW"].dataType == QUANTITY
    assert staged(spark, T.StringType()).table("R").schema["BRGEW"].dataType == FINE_QUANTITY


@pytest.mark.parametrize("seed", [1, 2])
def test_case_weights_are_compared_exactly(spark, seed):
    source = random.Random(seed)
    places = Decimal("0.000000001")
    goods, cases = [], []
    for i in range(200):
        matnr = str(10_000 + i % 120)
        unit = source.choice([Decimal(source.randrange(0, 5_000)) / 1000, Decimal(source.randrange(-100, 3_000_000)) / 10**6, Decimal("0.0004"), Decimal("0.000499999"), Decimal("0.0005"), None])
        goods.append({"MATNR": matnr, "BRGEW": unit, "NTGEW": source.choice([unit, Decimal("0.1"), Decimal("0.333333333")]), **GOOD})
        for _ in range(2):
            units = source.choice([1, 2, 3, 7, 24, 1000, 0, -2, None])
            whole = unit * units if unit is not None and units is not None else Decimal(3)
            case = source.choice([whole, whole, whole + Decimal("0.0004"), whole + Decimal("0.0005"), whole - Decimal("0.0005"), whole + Decimal("0.001"), None])
            cases.append({"MATNR": matnr, "MEINH": "CS", "UMREZ": units, "UMREN": 1, "BRGEW": None if case is None else case.quantize(places)})
            cases.append({"MATNR": matnr, "MEINH": "KG", "UMREZ": source.choice([10, 3, 0]), "UMREN": 1})
    catalog = staged(spark, FINE_QUANTITY, M=goods, R=cases)

    def rounded(x):
        return x.quantize(Decimal("0.001"), ROUND_HALF_UP)

    pairs = [(m, r) for m in goods for r in cases if m["MATNR"] == r["MATNR"]]
    known = [(m, r) for m, r in pairs if r["MEINH"] == "CS" and None not in (m["BRGEW"], r["BRGEW"], r["UMREZ"])]
    wrong = [(m, r) for m, r in known if rounded(m["BRGEW"] * r["UMREZ"]) != rounded(r["BRGEW"])]
    assert 0 < len(wrong) < len(known)
    assert failed(catalog, 74) == len(wrong) == violations(catalog, all_rules()[74]).count()
    ratios = [(m, r) for m, r in pairs if r["MEINH"] == "KG" and r["UMREZ"] and m["NTGEW"] is not None]
    unequal = [(m, r) for m, r in ratios if 1 / r["UMREZ"] != float(m["NTGEW"])]
    assert 0 < len(unequal) < len(ratios)
    assert failed(catalog, 82) == len(unequal) == violations(catalog, all_rules()[82]).count()
