"""Declared schemas of the staging tables, by one-letter code.

M materials, C plant data, T texts, R units of measure, S sales data, B valuation,
V vendors, L vendor general data, F purchasing data, K contacts, A e-mail addresses,
W partner roles.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

QUANTITY = T.DecimalType(13, 3)
#: Quantities that come with more places, or as text or floating point.
FINE_QUANTITY = T.DecimalType(38, 9)
COUNT = T.LongType()


def read_as(declared: T.DataType, given: T.DataType) -> T.DataType:
    """The type a column is read as: quantities keep the places that their source has."""
    if declared != QUANTITY or given == QUANTITY:
        return declared
    if isinstance(given, T.DecimalType):
        fits = given.scale <= QUANTITY.scale and given.precision - given.scale <= QUANTITY.precision - QUANTITY.scale
        return QUANTITY if fits else given
    return FINE_QUANTITY if isinstance(given, (T.StringType, T.FractionalType)) else QUANTITY


def always_fits(given: T.DataType, kind: T.DataType) -> bool:
    """Whether every value of the given type is one of the type it is read as."""
    if given == kind or isinstance(kind, T.StringType):
        return True
    if isinstance(given, T.DecimalType):
        return kind == QUANTITY
    return isinstance(given, (T.ByteType, T.ShortType, T.IntegerType))


@dataclass(frozen=True)
class Source:
    table: str
    key: str
    schema: T.StructType


def _source(table: str, key: str, texts: str, **typed: T.DataType) -> Source:
    fields = [T.StructField(name, T.StringType()) for name in texts.split()]
    fields += [T.StructField(name, kind) for name, kind in typed.items()]
    return Source(table, key, T.StructType(fields))


SOURCES: dict[str, Source] = {
    "M": _source(
        "bqt_material_attr",
        "MATNR",
        "MATNR MTART MBRSH SPART MATKL MEINS PRDHA BISMT ZZSUSTITUTO CWM_XCWMAT CWM_TOLGR MTPOS_MARA "
        "ZZMARCADOR ZZTEMPERATURA ZZMOVIMIENTO ZZMARCA ZZCLASIFICACION INHME VABME ZZFRAGIL EAN11 NUMTP "
        "GEWEI VOLEH MEABM XCHPF TRAGR BSTME TEMPB MSTAV",
        INHAL=QUANTITY,
        BRGEW=QUANTITY,
        NTGEW=QUANTITY,
        VOLUM=QUANTITY,
        LAENG=QUANTITY,
        BREIT=QUANTITY,
        HOEHE=QUANTITY,
    ),
    "C": _source(
        "bqt_mat_plant_attr",
        "MATNR",
        "MATNR WERKS LGPRO KOKRS MTVFP LADGR PRCTR STAWN HERKL MTVER HERKR EKGRP MMSTA DISMM DISGR DISPO "
        "DISLS BESKZ SOBSL LGFSB FHORI SHFLG SHZET STRGR PERKZ MAABC",
        WEBAZ=COUNT,
        PLIFZ=COUNT,
        BSTRF=COUNT,
        BSTMI=COUNT,
    ),
    "T": _source("bqt_material_text", "MATNR", "MATNR SPRAS TXTMD"),
    "R": _source(
        "bqt_ztbw_marm",
        "MATNR",
        "MATNR MEINH EAN11 NUMTP GEWEI VOLEH MEABM",
        UMREN=COUNT,
        UMREZ=COUNT,
        BRGEW=QUANTITY,
        VOLUM=QUANTITY,
        LAENG=QUANTITY,
        BREIT=QUANTITY,
        HOEHE=QUANTITY,
    ),
    "S": _source("bqt_mat_sales_attr", "MATNR", "MATNR MEGRU"),
    "B": _source("bqt_zvbw_zv_mbewh", "MATNR", "MATNR BKLAS VPRSV", PEINH=COUNT),
    "V": _source(
        "bqt_vendor_attr",
        "LIFNR",
        "LIFNR ADRNR LAND1 NAME1 NAME2 ORT01 PSTLZ REGIO SORTL STRAS SPRAS STCD1 KTOKK STCEG",
    ),
    "L": _source("bqt_zlfa1", "LIFNR", "LIFNR ZZDIAPED"),
    "F": _source("bqt_zlfm1", "LIFNR", "LIFNR WAERS WEBRE EKGRP BSTAE"),
    "K": _source("bqt_zknvk", "LIFNR", "LIFNR PARNR NAMEV TELF1 PAFKT PARLA PRSNR"),
    "A": _source("bqt_zadr6", "ADDRNUMBER", "ADDRNUMBER SMTP_ADDR"),
    "W": _source("bqt_zwyt3", "LIFNR", "LIFNR PARVW LIFN2"),
}
