"""From counts to graded results, and from results to the daily cube."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from masterlint.operators.counting import counts
from masterlint.rules.model import Rule
from masterlint.sources.catalog import Catalog

GRADING_COLUMNS = ("PASS_AT", "INCLUSIVE", "FAIL_BELOW", "COARSE_RATE", "NOTE")

FACT_SCHEMA = T.StructType(
    [
        T.StructField("RESULT_ID", T.StringType()),
        T.StructField("RULE_ID", T.LongType()),
        T.StructField("EXECUTION_TIME", T.TimestampType()),
        T.StructField("TOTAL_RECORDS", T.LongType()),
        T.StructField("FAILED_RECORDS", T.LongType()),
        T.StructField("PASSED_PERCENTAGE", T.DoubleType()),
        T.StructField("STATUS", T.StringType()),
        T.StructField("DETAILS", T.StringType()),
    ]
)

DIMENSION_SCHEMA = T.StructType(
    [
        T.StructField("RULE_ID", T.LongType()),
        T.StructField("RULE_NAME", T.StringType()),
        T.StructField("RULE_DESCRIPTION", T.StringType()),
        T.StructField("TARGET_TABLE", T.StringType()),
        T.StructField("SQL_CONDITION", T.StringType()),
        T.StructField("SEVERITY", T.StringType()),
        T.StructField("THRESHOLD", T.DoubleType()),
        T.StructField("ACTIVE", T.BooleanType()),
        T.StructField("CREATED_AT", T.TimestampType()),
        T.StructField("UPDATED_AT", T.TimestampType()),
        T.StructField("TABLE", T.StringType()),
        T.StructField("TABLE_FIELD", T.StringType()),
        T.StructField("TABLE_SOURCE", T.StringType()),
        T.StructField("MASTER", T.StringType()),
    ]
)


def grade(counted: DataFrame) -> DataFrame:
    """Adds pass rate, status and details to rule counts.

    The rate of an empty population is 100. Failures may exceed the population, so
    the rate may be negative; it is not clamped. A coarse rate rounds the ratio to
    three decimals before it becomes a percentage.
    """
    share = 1 - F.try_divide(F.col("FAILED_RECORDS"), F.col("TOTAL_RECORDS"))
    fine = F.round(F.coalesce(share * 100, F.lit(100.0)), 2)
    coarse = F.coalesce(F.round(share, 3) * 100, F.lit(100.0))
    rate = F.col("PASSED_PERCENTAGE")
    passed = (rate > F.col("PASS_AT")) | (F.col("INCLUSIVE") & (rate == F.col("PASS_AT")))
    kept = [name for name in counted.columns if name not in GRADING_COLUMNS]
    details = "concat('Total: ', TOTAL_RECORDS, ', Failed: ', FAILED_RECORDS, NOTE) AS DETAILS"
    return counted.select("*", F.when(F.col("COARSE_RATE"), coarse).otherwise(fine).alias("PASSED_PERCENTAGE")).select(
        *kept,
        rate,
        F.when(passed, "PASSED").when(rate < F.col("FAIL_BELOW"), "FAILED").otherwise("ERROR").alias("STATUS"),
        F.expr(details),
    )


def results(catalog: Catalog, rules: Iterable[Rule]) -> DataFrame:
    """One graded row per rule, all rules evaluated in one plan."""
    return grade(counts(catalog, rules))


def stamped(graded: DataFrame, result_id: Column, at: Column) -> DataFrame:
    """Graded rows as recorded: with an id, a time, and the UTC day they are filed under."""
    rows = graded.withColumn("RESULT_ID", result_id).withColumn("EXECUTION_TIME", at)
    return rows.select(*FACT_SCHEMA.names, utc_date("EXECUTION_TIME").alias("EXECUTION_DATE"))


def utc_date(instant: str) -> Column:
    """The UTC calendar date of a timestamp, whatever the session time zone."""
    days = F.floor(F.unix_seconds(instant) / 86400).cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), days)


MAXIMA = ("RESULT_ID", "TOTAL_RECORDS", "FAILED_RECORDS", "PASSED_PERCENTAGE", "STATUS", "DETAILS")


def daily_maxima(facts: DataFrame) -> DataFrame:
    """Per rule and UTC day the column-wise maxima of its results; of maxima again the same maxima."""
    day = F.col("EXECUTION_DATE") if "EXECUTION_DATE" in facts.columns else utc_date("EXECUTION_TIME")
    return facts.groupBy("RULE_ID", day.alias("EXECUTION_DATE")).agg(*[F.max(name).alias(name) for name in MAXIMA])


def described(daily: DataFrame, dimension: DataFrame) -> DataFrame:
    """Daily maxima with the rule's description. The dimension is left to Catalyst, which broadcasts it if its
    size allows."""
    shown = [name for name in DIMENSION_SCHEMA.names if name != "RULE_ID"]
    return daily.join(dimension.select("RULE_ID", *shown), "RULE_ID", "left")


def daily_cube(facts: DataFrame, dimension: DataFrame) -> DataFrame:
    """Per rule and UTC day the maxima of its results, with the rule's description.

    The maxima are taken column by column, so two runs on one day may mix.
    """
    return described(daily_maxima(facts.select(*FACT_SCHEMA.names)), dimension)
