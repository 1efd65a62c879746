"""What the command line prints, and which days of the cube a run replaces."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from masterlint.__main__ import own_rows
from masterlint.plans.report import DIMENSION_SCHEMA, FACT_SCHEMA, utc_date
from masterlint.rules.dimension import description
from masterlint.rules.registry import all_rules
from masterlint.sinks.store import PARTITION, RESULTS, Store
from masterlint.sources.catalog import Catalog
from masterlint.sources.schemas import SOURCES

DAYS = ("2024-03-01", "2024-03-02", "2024-03-03")


@pytest.fixture
def store(spark, tmp_path):
    rule_ids = [*[rule for rule in all_rules()][:3], 93, 94]
    values = {"TOTAL_RECORDS": 10, "FAILED_RECORDS": 1, "PASSED_PERCENTAGE": 90.0, "STATUS": "s" * 80, "DETAILS": "d" * 200}
    facts = spark.createDataFrame([(i, d) for i in rule_ids for d in DAYS], "RULE_ID int, DAY string")
    for field in FACT_SCHEMA:
        if field.name == "EXECUTION_TIME":
            column = F.expr("to_timestamp(DAY || ' 12:00:00')")
        elif field.name == "RESULT_ID":
            column = F.expr("DAY || RULE_ID")
        else:
            column = F.col("RULE_ID") if field.name == "RULE_ID" else F.lit(values.get(field.name))
        facts = facts.withColumn(field.name, column.cast(field.dataType))
    out = Store(spark, str(tmp_path))
    out.write(RESULTS, facts.select(*FACT_SCHEMA.names, utc_date("EXECUTION_TIME").alias(PARTITION)), "append", PARTITION)
    return out


@pytest.fixture
def dimension(spark):
    stamp = datetime(2024, 1, 1)
    return spark.createDataFrame([description(rule, stamp) for rule in all_rules().values()], DIMENSION_SCHEMA)


def test_a_range_replaces_its_days_only(store, dimension):
    assert store.replace_cube(dimension).count() == 15
    changed = dimension.withColumn(dimension.columns[-1], F.lit(None).cast(dimension.schema[-1].dataType))
    cube = store.replace_cube(changed, DAYS[1], DAYS[1])
    assert cube.count() == 15
    anew = cube.where(F.col(cube.columns[-1]).isNull()).select(PARTITION).distinct().collect()
    assert [str(row[0]) for row in anew] == [DAYS[1]] or dimension.where(F.col(dimension.columns[-1]).isNull()).count()


def test_a_run_shows_all_its_rows_and_no_others(store, dimension):
    cube = store.replace_cube(dimension)
    rows = own_rows(cube, [93, 94], date(2024, 3, 3)).collect()
    assert [(row.RULE_ID, str(row.EXECUTION_DATE)) for row in rows] == [(93, DAYS[2]), (94, DAYS[2])]
    assert len(rows[0].DETAILS) == 200


def test_dimension_in_store_is_seen(store):
    assert store.has(RESULTS) and not store.has("DIM_DQ_RULES")


def test_missing_column_is_an_error(spark, tmp_path):
    source = SOURCES["S"]
    spark.createDataFrame([("1",)], "MATNR string").write.parquet(f"{tmp_path}/{source.table}")
    with pytest.raises(ValueError, match=f"{source.table} has no column MEGRU"):
        Catalog.of_parquet(spark, str(tmp_path)).table("S")


def test_warehouse_types_are_read(spark, tmp_path):
    source = SOURCES["B"]
    row = spark.createDataFrame([("1", "b", "S", 5_000_000_000)], "MATNR string, BKLAS string, VPRSV string, PEINH bigint")
    row.write.parquet(f"{tmp_path}/{source.table}")
    assert Catalog.of_parquet(spark, str(tmp_path)).table("B").first().PEINH == 5_000_000_000
