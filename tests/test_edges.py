"""Hand-made cases for semantics that are easy to get wrong."""

from __future__ import annotations

from decimal import Decimal

import pytest

from masterlint.functions.conditions import text, trimmed
from masterlint.operators.listing import violations
from masterlint.plans.report import grade, results
from masterlint.rules.model import G90, G95, G99, H93, H100, S90, S95, S99
from masterlint.rules.registry import all_rules
from masterlint.sources.catalog import Catalog
from masterlint.sources.schemas import SOURCES

COUNTED = (
    "RULE_ID long, PASS_AT double, INCLUSIVE boolean, FAIL_BELOW double, COARSE_RATE boolean, NOTE string, "
    "TOTAL_RECORDS long, FAILED_RECORDS long"
)


def tables(spark, **rows: list[dict]) -> Catalog:
    """Staging tables holding the given rows; unnamed columns are null, unnamed tables empty."""
    frames = {}
    for code, source in SOURCES.items():
        values = [tuple(row.get(name) for name in source.schema.names) for row in rows.get(code, [])]
        frames[code] = spark.createDataFrame(values, source.schema)
    return Catalog.of_frames(spark, frames)


def outcome(catalog: Catalog, rule_id: int) -> tuple[int, int]:
    row = results(catalog, [all_rules()[rule_id]]).first()
    return row.TOTAL_RECORDS, row.FAILED_RECORDS


@pytest.mark.parametrize(
    ("policy", "total", "failed", "status"),
    [
        (S99, 100, 1, "ERROR"),
        (S99, 1000, 9, "PASSED"),
        (S99, 1000, 11, "FAILED"),
        (S95, 100, 5, "ERROR"),
        (S90, 10, 1, "ERROR"),
        (G99, 100, 1, "PASSED"),
        (G95, 100, 5, "PASSED"),
        (G90, 1000, 101, "FAILED"),
        (H100, 1000, 1, "FAILED"),
        (H93, 1000, 0, "PASSED"),
        (H93, 1000, 1, "ERROR"),
        (H93, 100, 1, "ERROR"),
        (H93, 1000, 11, "FAILED"),
        (S99, 0, 0, "PASSED"),
        (S99, 0, 7, "PASSED"),
    ],
)
def test_status(spark, policy, total, failed, status):
    row = (1, policy.pass_at, policy.inclusive, policy.fail_below, False, "!", total, failed)
    graded = grade(spark.createDataFrame([row], COUNTED)).first()
    assert graded.STATUS == status
    assert graded.DETAILS == f"Total: {total}, Failed: {failed}!"
    if total == 0:
        assert graded.PASSED_PERCENTAGE == 100


def test_rates(spark):
    def rate(total: int, failed: int, coarse: bool) -> float:
        row = (1, 99.0, False, 99.0, coarse, "", total, failed)
        return grade(spark.createDataFrame([row], COUNTED)).first().PASSED_PERCENTAGE

    assert rate(3, 1, False) == 66.67
    assert rate(3, 1, True) == pytest.approx(66.7)
    assert rate(2, 5, False) == -150
    assert rate(0, 0, True) == 100


@pytest.mark.parametrize(("copies", "failed"), [([1], 0), ([3, 1], 3), ([3, 2, 1], 5)])
def test_duplicate_groups(spark, copies, failed):
    keys = [str(10000 + i) for i, n in enumerate(copies) for _ in range(n)]
    catalog = tables(
        spark, M=[{"MATNR": key, "MTART": "ZMER", "MBRSH": "B"} for key in keys], V=[{"LIFNR": key} for key in keys]
    )
    assert outcome(catalog, 1) == (sum(copies), failed)
    assert outcome(catalog, 2) == (sum(copies), sum(copies))
    # vendor 10000 padded to ten has its scope digit at 1
    assert outcome(catalog, 93) == (sum(copies), failed)


def test_null_keys_count_as_one_group_but_never_join(spark):
    catalog = tables(
        spark,
        M=[{"MTART": "ZMER", "SPART": "20", "TRAGR": "0002"}] * 2,
        C=[{"MATNR": None}] * 3,
    )
    assert outcome(catalog, 1) == (2, 2)
    assert outcome(catalog, 8) == (0, 2)
    assert outcome(catalog, 41) == (2, 0)
    assert outcome(catalog, 45) == (0, 0)


def test_zero_divisors_are_not_flagged(spark):
    unit = {"MATNR": "10001"}
    catalog = tables(
        spark,
        M=[{**unit, "MTART": "ZMER", "NTGEW": None}, {**unit, "MTART": "ZMER", "NTGEW": Decimal(2)}],
        R=[
            {**unit, "MEINH": "KG", "UMREN": 1, "UMREZ": 0},
            {**unit, "MEINH": "PAL", "UMREZ": 72},
            {**unit, "MEINH": "CAP", "UMREZ": 0},
            {**unit, "MEINH": "CS", "UMREZ": 0},
        ],
    )
    assert [outcome(catalog, rule)[1] for rule in (82, 84, 85)] == [0, 0, 0]


def test_short_material_number(spark):
    catalog = tables(spark, M=[{"MATNR": "7", "MTART": "ZMER"}, {"MATNR": "1", "MTART": "ZMER"}])
    # unpadded, the first of the last five characters of '1' is '1'; padded, it is '0'
    assert outcome(catalog, 3) == (2, 1)
    assert violations(catalog, all_rules()[3]).count() == 2


def test_blank_substitute_counts_as_substitute(spark):
    row = {"MATNR": "10001", "MTART": "ZMER", "BISMT": "000001"}
    assert outcome(tables(spark, M=[{**row, "ZZSUSTITUTO": ""}]), 16) == (1, 1)
    assert outcome(tables(spark, M=[{**row, "ZZSUSTITUTO": None}]), 16) == (1, 0)
    assert outcome(tables(spark, M=[{**row, "ZZSUSTITUTO": ""}]), 15) == (1, 1)


def test_group_with_unknown_material_hides_strays(spark):
    group = {"MTART": "ZMER", "BISMT": "000001"}
    rows = [{**group, "MATNR": "10001", "ZZSUSTITUTO": "99999"}, {**group, "MATNR": "10002"}]
    assert outcome(tables(spark, M=rows), 15) == (2, 1)
    catalog = tables(spark, M=[*rows, {**group, "MATNR": None}])
    assert outcome(catalog, 15) == (3, 0)
    assert [row.switch_fuera_de_grupo for row in violations(catalog, all_rules()[15]).orderBy("MATNR").collect()] == [
        False,
        None,
        False,
    ]


def test_escaped_scope_makes_rate_negative(spark):
    catalog = tables(
        spark,
        L=[{"LIFNR": "0000010001"}, {"LIFNR": "0000020002"}],
        F=[{"LIFNR": "0000010001", "WAERS": ""}, *[{"LIFNR": "0000020002", "WAERS": ""}] * 2],
    )
    row = results(catalog, [all_rules()[109]]).first()
    assert (row.TOTAL_RECORDS, row.FAILED_RECORDS, row.PASSED_PERCENTAGE, row.STATUS) == (1, 3, -200, "FAILED")


def test_blank_role(spark):
    partners = [{"LIFNR": "0000010001", "PARVW": role} for role in ("BA", " lf", "RS ", "ZE", "  ", None)]
    assert outcome(tables(spark, W=partners), 119) == (6, 0)
    assert outcome(tables(spark, W=partners[1:]), 119) == (5, 1)
    listed = violations(tables(spark, W=[*partners[1:], {"LIFNR": "0000010001", "PARVW": "zo"}]), all_rules()[119]).first()
    assert listed.MOTIVO_ERROR == "Falta la clave DP(BA); Contiene la clave no permitida ZO"


def test_trim_strips_every_white_space(spark):
    value = " \t V 　\n"
    df = spark.createDataFrame([(value,)], "x string")
    assert df.selectExpr(f"{trimmed('x')} AS y").first().y == "V"


def test_text_literals_keep_quotes_and_backslashes(spark):
    value = "a'b\"c\\d\\n"
    assert spark.range(1).selectExpr(f"{text(value)} AS y").first().y == value
