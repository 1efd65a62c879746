"""Normalised keys and lookups added to the staging tables.

They are ordinary projected columns: a plan that does not use one never computes it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from masterlint.functions.conditions import blank_to_null, is_in

MATERIAL_WIDTH = 18
VENDOR_WIDTH = 10
SHORT = 5

# The first plant number of each temperature zone, by material digit
# (1 frozen, 3 chilled, 4 dry), and the platforms whose stock sits in a zone plant.
ZONE_START = {"1": 6440, "3": 6240, "4": 6340}
PLATFORM_OFFSET = {4400: 4, 4300: 3}
PROFIT_CENTRE = {"4400": "F6444", "4300": "F6443"}


def padded(column: str, width: int) -> Column:
    return F.lpad(F.col(column), width, "0")


def short_code(column: str, width: int = MATERIAL_WIDTH) -> Column:
    return F.right(padded(column, width), F.lit(SHORT))


def zone_digit(column: str = "MATNR") -> Column:
    return F.substring(padded(column, MATERIAL_WIDTH), MATERIAL_WIDTH - SHORT + 1, 1)


def material_keys(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "MATNR18": padded("MATNR", MATERIAL_WIDTH),
            "MATNR5": short_code("MATNR"),
            "DIGIT": zone_digit(),
            "RAW_DIGIT": F.left(F.right("MATNR", F.lit(SHORT)), F.lit(1)),
        }
    )


def substitute_key(df: DataFrame) -> DataFrame:
    return df.withColumn("SUBSTITUTE5", short_code("ZZSUSTITUTO"))


def storage_by_plant() -> dict[str, str]:
    """The storage location expected for a digit and plant number, keyed by their concatenation."""
    expected = {}
    for zone, start in ZONE_START.items():
        expected |= {f"{zone}{platform}": str(start + offset) for platform, offset in PLATFORM_OFFSET.items()}
        expected |= {f"{zone}{plant}": str(plant) for plant in range(start, start + 8)}
    # Fixed value: the one frozen plant that dry goods may use.
    return expected | {"46445": "6445"}


def _expected_profit_centre(digit: Column, plant: Column) -> Column:
    derived = F.when(~plant.isin(*PROFIT_CENTRE), F.concat(F.lit("F64"), F.substring(plant, 3, 2)))
    for platform, centre in PROFIT_CENTRE.items():
        derived = derived.when(digit.isin(*ZONE_START) & (plant == platform), centre)
    return derived


def _normalised(column: str) -> Column:
    """The trimmed value, null if blank. A known plant code is taken as it is: most rows skip the trimming."""
    known = sorted({*storage_by_plant().values(), *PROFIT_CENTRE})
    return F.expr(f"if({is_in(column, known)}, {column}, {blank_to_null(column)})")


def plant_keys(df: DataFrame) -> DataFrame:
    keyed = df.withColumns({"PLANT": _normalised("WERKS"), "STORAGE": _normalised("LGPRO")})
    digit, plant = F.col("DIGIT"), F.col("PLANT")
    number = plant.try_cast("bigint")
    storage = F.create_map(*[F.lit(item) for pair in storage_by_plant().items() for item in pair])
    return keyed.withColumns(
        {
            "PLANT_NUMBER": number,
            "STORAGE_EXPECTED": F.try_element_at(storage, F.concat(digit, number.cast("string"))),
            "CENTRE_EXPECTED": _expected_profit_centre(digit, plant),
        }
    )


def vendor_keys(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "LIFNR5": short_code("LIFNR", VENDOR_WIDTH),
            "SCOPE_DIGIT": F.substring(padded("LIFNR", VENDOR_WIDTH), 6, 1),
        }
    )
