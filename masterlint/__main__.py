"""Command line: run the rules of one or both domains."""

from __future__ import annotations

import argparse
import sys
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from masterlint.plans.report import DIMENSION_SCHEMA
from masterlint.plans.run import report, run_rules
from masterlint.rules.dimension import description
from masterlint.rules.registry import DOMAINS, all_rules, rules_of
from masterlint.session import session
from masterlint.sinks.store import DIMENSION, Store
from masterlint.sources.catalog import Catalog


def main() -> None:
    parser = argparse.ArgumentParser(prog="masterlint", description=__doc__)
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--database", help="metastore database with the staging tables")
    source.add_argument("--parquet", help="folder with one parquet folder per staging table")
    source.add_argument("--samples", help="folder with the sample star schema")
    target = parser.add_mutually_exclusive_group(required=True)
    target.add_argument("--store", help="folder for the result tables")
    target.add_argument("--store-database", help="metastore database for the result tables")
    parser.add_argument("--exports", help="folder for the CSV exports; none are written without it")
    parser.add_argument("--domain", choices=DOMAINS, action="append", help="default: all")
    options = parser.parse_args()

    spark = session()
    if options.database:
        catalog = Catalog.of_database(spark, options.database)
    elif options.parquet:
        catalog = Catalog.of_parquet(spark, options.parquet)
    else:
        catalog = Catalog.of_samples(spark, options.samples)
    store = Store(spark, options.store, options.store_database)
    rules = [rule for domain in options.domain or DOMAINS for rule in rules_of(domain)]
    started = datetime.now(UTC).date()
    for (table, column), count in run_rules(catalog, rules, store, options.exports).rejected.items():
        print(f"{table}.{column}: {count} values could not be read and count as missing", file=sys.stderr)
    if store.has(DIMENSION):
        dimension = store.dimension()
    else:
        now = datetime.now(UTC).replace(microsecond=0)
        dimension = spark.createDataFrame([description(rule, now) for rule in all_rules().values()], DIMENSION_SCHEMA)
    for row in own_rows(report(store, dimension), [rule.id for rule in rules], started).collect():
        print("\t".join(str(value) for value in row))


def own_rows(cube: DataFrame, rule_ids: list[int], since: date) -> DataFrame:
    """A run's part of the cube: its rules, on the days since it began, which are one or two."""
    return cube.filter(F.col("RULE_ID").isin(rule_ids) & (F.col("EXECUTION_DATE") >= F.lit(since))).orderBy("RULE_ID", "EXECUTION_DATE")


if __name__ == "__main__":
    main()
