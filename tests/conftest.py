from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

SAMPLES = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from masterlint.session import session

    spark = session(
        "masterlint-tests",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            # sizes of shuffled partitions follow their rows, however alike these are
            "spark.shuffle.compress": "false",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def samples() -> str:
    return SAMPLES


@pytest.fixture(scope="session")
def catalog(spark):
    from masterlint.sources.catalog import Catalog

    return Catalog.of_samples(spark, SAMPLES)
