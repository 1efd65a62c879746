"""One key, code or value holding a third of all rows.

The joins behind these counts have up to 10**9 row pairs; the engine must reach the
right numbers without building them.
"""

from __future__ import annotations

from functools import partial

import pytest

from masterlint.operators.listing import violations
from masterlint.plans.report import results
from masterlint.rules.registry import all_rules
from masterlint.sources.catalog import Catalog
from masterlint.sources.schemas import SOURCES

ROWS = 90_000
HOT = ROWS // 3


def frame(spark, code: str, **columns: str):
    schema = SOURCES[code].schema
    cells = [f"cast({columns.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema]
    return spark.range(ROWS).selectExpr(*cells)


@pytest.fixture(scope="module")
def skewed(spark):
    table = partial(frame, spark)
    material = f"if(id < {HOT}, '10001', concat('5', lpad(id, 9, '0')))"
    vendor = f"if(id < {HOT}, '0000010001', lpad(id + 9000000, 10, '0'))"
    frames = {
        "M": table(
            "M", MATNR=material, MTART="'ZMER'", MEINS="'ST'", BRGEW="2.5", NTGEW="0.5",
            BISMT=f"if(id < {HOT}, '000001', '000002')", ZZSUSTITUTO=f"if(id < {HOT}, '10001', NULL)",
        ),
        "C": table("C", MATNR=material),
        "R": table(
            "R", MATNR=material, MEINH="if(id % 2 = 0, 'CS', 'KG')", UMREN="1", UMREZ="2",
            BRGEW="if(id % 4 = 0, 5.0, 6.0)",
        ),
        "S": table("S", MATNR=material, MEGRU="'Z001'"),
        "V": table("V", LIFNR=vendor, ADRNR="'a'", NAME1="cast(id % 7 AS string)"),
        "L": table("L", LIFNR=vendor),
        "K": table("K", LIFNR=vendor),
        "A": table("A", ADDRNUMBER=f"if(id < {HOT}, 'a', 'b')"),
        "W": table("W", LIFNR=vendor, PARVW="'DP'", LIFN2="cast(id % 5 AS string)"),
    }
    return Catalog.of_frames(spark, frames)


def failed(catalog: Catalog, rule_id: int) -> int:
    return results(catalog, [all_rules()[rule_id]]).first().FAILED_RECORDS


def test_hot_join_key(skewed):
    assert failed(skewed, 45) == HOT * HOT + (ROWS - HOT)
    assert failed(skewed, 40) == 1 + (ROWS - HOT)
    assert failed(skewed, 1) == HOT


def test_hot_key_in_three_tables(skewed):
    cases = HOT // 2
    assert failed(skewed, 72) == HOT * HOT * cases + (ROWS - HOT) // 2


def test_hot_key_compared_by_value(skewed):
    # half of the hot cases weigh 2 x 2.5, the other half do not; KG ratios are all 0.5
    assert failed(skewed, 74) == HOT * (HOT // 4) + (ROWS - HOT) // 4
    assert failed(skewed, 82) == 0


def test_hot_group_and_link(skewed):
    # the hot group has one material and HOT substitutes of it
    assert failed(skewed, 15) == ROWS
    assert failed(skewed, 16) == 0


def test_hot_vendor_and_address(skewed):
    assert failed(skewed, 118) == HOT * HOT * HOT
    assert failed(skewed, 120) == 7 * 5


@pytest.fixture
def splitting(spark):
    """Joins by sorting, and partitions that count as skewed at the size of this test."""
    wanted = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.fixture(scope="module")
def hot_listings(spark):
    """A hot key in one table of each join, next to few rows of it in the others."""
    table = partial(frame, spark)
    spread = "concat('5', lpad(id, 9, '0'))"
    vendor = "lpad(id + 9000000, 10, '0')"
    frames = {
        "M": table(
            "M", MATNR=f"if(id < {HOT}, '10001', {spread})", MTART="'ZMER'", MEINS="'ST'",
            BISMT=f"if(id < {HOT}, NULL, lpad(id, 6, '0'))", ZZSUSTITUTO=f"if(id < {HOT}, NULL, {spread})",
        ),
        "R": table("R", MATNR=f"if(id = 0, '10001', {spread})", MEINH="'CS'"),
        "S": table("S", MATNR=f"if(id = 0, '10001', {spread})", MEGRU="'Z001'"),
        "K": table("K", LIFNR=f"if(id < {HOT}, '0000010001', {vendor})", PARNR="cast(id AS string)"),
        "L": table("L", LIFNR=f"if(id < 2, '0000010001', {vendor})"),
    }
    return Catalog.of_frames(spark, frames)


@pytest.mark.parametrize(("rule_id", "joins", "rows"), [(15, 2, ROWS), (72, 2, ROWS), (113, 1, HOT)])
def test_hot_keys_of_listings_are_split(hot_listings, splitting, rule_id, joins, rows):
    listed = violations(hot_listings, all_rules()[rule_id])
    assert len(listed.collect()) == rows
    final = listed._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0]
    assert final.count("SortMergeJoin(skew=true)") == joins, final
