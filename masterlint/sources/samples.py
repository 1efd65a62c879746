"""Staging tables derived from the sample star schema.

The sample data has no material or vendor tables, so each staging table is
defined here as a projection of ``part`` or ``customer``. Tables with several
rows per key repeat each base row ``fan_out`` times, numbered by ``n_nationkey``.
The expressions are the ones listed in FIXTURES.md; they are plain SQL that means
the same in Spark and in DuckDB.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

MATERIAL_KEY = (
    "cast(((p_partkey - p_partkey % 10000) * 10) + (CASE p_partkey % 5 WHEN 0 THEN 1 WHEN 1 THEN 3 "
    "WHEN 2 THEN 4 WHEN 3 THEN 1 ELSE 2 END) * 10000 + p_partkey % 10000 AS string)"
)
VENDOR_KEY = (
    "lpad(cast(((c_custkey - c_custkey % 10000) * 10) + CASE WHEN c_custkey % 4 = 0 THEN 20000 "
    "ELSE 10000 END + c_custkey % 10000 AS string),10,'0')"
)


@dataclass(frozen=True)
class Derivation:
    base: str
    fan_out: int
    columns: dict[str, str]


# The fixture definitions of FIXTURES.md.
DERIVATIONS: dict[str, Derivation] = {
    "M": Derivation(
        base="part",
        fan_out=1,
        columns={
            "MATNR": "cast((((p_partkey - CASE WHEN p_partkey % 97 = 0 THEN 5 ELSE 0 END) - (p_partkey - CASE WHEN p_partkey % 97 = 0 THEN 5 ELSE 0 END) % 10000) * 10) + (CASE (p_partkey - CASE WHEN p_partkey % 97 = 0 THEN 5 ELSE 0 END) % 5 WHEN 0 THEN 1 WHEN 1 THEN 3 WHEN 2 THEN 4 WHEN 3 THEN 1 ELSE 2 END) * 10000 + (p_partkey - CASE WHEN p_partkey % 97 = 0 THEN 5 ELSE 0 END) % 10000 AS string)",
            "MTART": "CASE p_partkey % 5 WHEN 0 THEN 'ZMER' WHEN 1 THEN 'ZFRE' WHEN 2 THEN 'ZSEC' WHEN 3 THEN 'ZMER' ELSE CASE WHEN p_partkey % 10 = 4 THEN 'ZMER' ELSE 'ROH' END END",
            "MBRSH": "CASE WHEN p_partkey % 53 = 0 THEN NULL WHEN p_partkey % 59 = 1 THEN 'B' ELSE 'A' END",
            "SPART": "CASE WHEN p_partkey % 61 = 0 THEN NULL WHEN p_partkey % 67 = 1 THEN '20' ELSE '10' END",
            "MATKL": "CASE WHEN p_partkey % 29 = 0 THEN NULL WHEN p_partkey % 23 = 1 THEN CASE WHEN p_partkey % 2 = 0 THEN 'OTHER' ELSE '  ' END ELSE 'METRO' END",
            "MEINS": "CASE WHEN p_partkey % 71 = 0 THEN NULL WHEN p_partkey % 31 = 1 THEN 'KG' ELSE CASE WHEN p_partkey % 2 = 0 THEN 'ST' ELSE 'CS' END END",
            "PRDHA": "CASE WHEN p_partkey % 37 = 0 THEN NULL WHEN p_partkey % 41 = 1 THEN '1010' ELSE CASE WHEN p_partkey % 3 = 0 THEN '101010010510000001' ELSE '201010010510000001' END END",
            "BISMT": "CASE WHEN p_partkey % 13 = 0 THEN NULL WHEN p_partkey % 19 = 1 THEN CASE WHEN p_partkey % 2 = 0 THEN 'AB12' ELSE '' END ELSE lpad(cast((p_partkey - p_partkey % 3) AS string),6,'0') END",
            "ZZSUSTITUTO": "CASE WHEN p_partkey % 3 = 1 THEN cast((((p_partkey - 1) - (p_partkey - 1) % 10000) * 10) + (CASE (p_partkey - 1) % 5 WHEN 0 THEN 1 WHEN 1 THEN 3 WHEN 2 THEN 4 WHEN 3 THEN 1 ELSE 2 END) * 10000 + (p_partkey - 1) % 10000 AS string) WHEN p_partkey % 29 = 2 THEN '99999' WHEN p_partkey % 31 = 2 THEN '' ELSE NULL END",
            "CWM_XCWMAT": "CASE WHEN p_partkey % 43 = 0 THEN NULL ELSE CASE WHEN p_partkey % 2 = 0 THEN 'X' ELSE '' END END",
            "CWM_TOLGR": "CASE WHEN p_partkey % 7 = 0 THEN 'T1' ELSE NULL END",
            "MTPOS_MARA": "CASE WHEN p_partkey % 47 = 0 THEN NULL WHEN p_partkey % 51 = 1 THEN 'ZLEER' ELSE 'ZNORM' END",
            "ZZMARCADOR": "CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE 'M' END",
            "ZZTEMPERATURA": "CASE WHEN p_partkey % 33 = 0 THEN NULL WHEN p_partkey % 27 = 1 THEN 'SECO' ELSE CASE p_partkey % 5 WHEN 1 THEN 'REFRIGERAD' WHEN 2 THEN 'SECO' ELSE 'CONGELADO' END END",
            "ZZMOVIMIENTO": "CASE WHEN p_partkey % 39 = 0 THEN NULL WHEN p_partkey % 49 = 1 THEN 'BAJA' ELSE CASE WHEN p_partkey % 2 = 0 THEN 'ALTA' ELSE 'ALTA-SUSTITUCIÓN' END END",
            "ZZMARCA": "CASE WHEN p_partkey % 57 = 0 THEN NULL ELSE 'BRAND' END",
            "ZZCLASIFICACION": "CASE WHEN p_partkey % 63 = 0 THEN NULL WHEN p_partkey % 21 = 1 THEN 'BASICO' ELSE 'BÁSICO' END",
            "INHAL": "cast(CASE WHEN p_partkey % 22 = 1 THEN 9.5 WHEN p_partkey % 4 = 2 THEN 0 ELSE 0.5 END AS decimal(13,3))",
            "INHME": "CASE WHEN p_partkey % 25 = 0 THEN NULL WHEN p_partkey % 28 = 1 THEN 'G' ELSE 'KG' END",
            "BRGEW": "cast(CASE WHEN p_partkey % 69 = 0 THEN NULL WHEN p_partkey % 73 = 1 THEN 0 ELSE 2.5 END AS decimal(13,3))",
            "NTGEW": "cast(CASE WHEN p_partkey % 77 = 0 THEN NULL WHEN p_partkey % 79 = 1 THEN 0 ELSE 2 END AS decimal(13,3))",
            "VABME": "CASE WHEN p_partkey % 18 = 0 THEN NULL WHEN p_partkey % 83 = 1 THEN '2' ELSE '1' END",
            "ZZFRAGIL": "CASE WHEN p_partkey % 10 = 0 THEN NULL WHEN p_partkey % 14 = 1 THEN '' ELSE 'X' END",
            "EAN11": "CASE WHEN p_partkey % 87 = 0 THEN NULL ELSE '8400000000017' END",
            "NUMTP": "CASE WHEN p_partkey % 89 = 0 THEN NULL ELSE 'HE' END",
            "GEWEI": "CASE WHEN p_partkey % 91 = 0 THEN NULL WHEN p_partkey % 93 = 1 THEN 'G' ELSE 'KG' END",
            "VOLUM": "cast(CASE WHEN p_partkey % 95 = 0 THEN NULL WHEN p_partkey % 62 = 1 THEN 0 ELSE 0.012 END AS decimal(13,3))",
            "VOLEH": "CASE WHEN p_partkey % 58 = 0 THEN NULL WHEN p_partkey % 54 = 1 THEN 'L' ELSE 'M3' END",
            "LAENG": "cast(CASE WHEN p_partkey % 52 = 0 THEN NULL WHEN p_partkey % 45 = 1 THEN 0 ELSE 300 END AS decimal(13,3))",
            "BREIT": "cast(CASE WHEN p_partkey % 46 = 0 THEN NULL WHEN p_partkey % 44 = 1 THEN 0 ELSE 200 END AS decimal(13,3))",
            "HOEHE": "cast(CASE WHEN p_partkey % 42 = 0 THEN NULL WHEN p_partkey % 38 = 1 THEN 0 ELSE 100 END AS decimal(13,3))",
            "MEABM": "CASE WHEN p_partkey % 36 = 0 THEN NULL WHEN p_partkey % 35 = 1 THEN 'CM' ELSE 'MM' END",
            "XCHPF": "CASE WHEN p_partkey % 34 = 0 THEN NULL WHEN p_partkey % 32 = 1 THEN '' ELSE 'X' END",
            "TRAGR": "CASE WHEN p_partkey % 26 = 0 THEN NULL WHEN p_partkey % 24 = 1 THEN '0002' ELSE '0001' END",
            "BSTME": "CASE WHEN p_partkey % 15 = 0 THEN NULL ELSE 'CS' END",
            "TEMPB": "CASE WHEN p_partkey % 55 = 0 THEN NULL ELSE '01' END",
            "MSTAV": "CASE WHEN p_partkey % 20 = 0 THEN NULL ELSE 'Z5' END",
        },
    ),
    "C": Derivation(
        base="part",
        fan_out=4,
        columns={
            "MATNR": MATERIAL_KEY,
            "WERKS": "CASE (p_partkey * 4 + n_nationkey) % 29 WHEN 0 THEN '4400' WHEN 1 THEN '4300' WHEN 2 THEN '9999' WHEN 3 THEN ' ' ELSE cast(6240 + 100 * ((p_partkey * 4 + n_nationkey) % 3) + (p_partkey * 4 + n_nationkey) % 8 AS string) END",
            "LGPRO": "CASE WHEN (p_partkey * 4 + n_nationkey) % 31 = 0 THEN NULL ELSE CASE WHEN (p_partkey * 4 + n_nationkey) % 29 = 0 THEN '6444' WHEN (p_partkey * 4 + n_nationkey) % 29 = 1 THEN '6443' ELSE cast(6240 + 100 * ((p_partkey * 4 + n_nationkey) % 3) + (p_partkey * 4 + n_nationkey) % 8 AS string) END END",
            "KOKRS": "CASE WHEN (p_partkey * 4 + n_nationkey) % 37 = 0 THEN NULL WHEN (p_partkey * 4 + n_nationkey) % 41 = 1 THEN 'ES10' ELSE 'ES14' END",
            "MTVFP": "CASE WHEN (p_partkey * 4 + n_nationkey) % 43 = 0 THEN NULL WHEN (p_partkey * 4 + n_nationkey) % 47 = 1 THEN 'Z1' ELSE 'Z2' END",
            "LADGR": "CASE WHEN (p_partkey * 4 + n_nationkey) % 53 = 0 THEN NULL WHEN (p_partkey * 4 + n_nationkey) % 59 = 1 THEN '0003' ELSE '0001' END",
            "PRCTR": "CASE WHEN (p_partkey * 4 + n_nationkey) % 61 = 0 THEN NULL WHEN (p_partkey * 4 + n_nationkey) % 67 = 1 THEN 'F0000' ELSE CASE WHEN (p_partkey * 4 + n_nationkey) % 29 = 0 THEN 'F6444' WHEN (p_partkey * 4 + n_nationkey) % 29 = 1 THEN 'F6443' ELSE concat('F64', substr(cast(6240 + (p_partkey * 4 + n_nationkey) % 8 AS string),3,2)) END END",
            "STAWN": "CASE WHEN (p_partkey * 4 + n_nationkey) % 71 = 0 THEN NULL WHEN (p_partkey * 4 + n_nationkey) % 73 = 1 THEN '020' ELSE '02071400' END",
            "HERKL": "CASE WHEN (p_partkey * 4 + n_nationkey) % 79 = 0 THEN NULL ELSE 'ES' END",
            "MTVER": "CASE WHEN (p_partkey * 4 + n_nationkey) % 83 = 0 THEN NULL WHEN (p_partkey * 4 + n_nationkey) % 89 = 1 THEN '0002' ELSE '0001' END",
            "HERKR": "CASE WHEN (p_partkey * 4 + n_nationkey) % 97 = 0 THEN NULL WHEN (p_partkey * 4 + n_nationkey) % 101 = 1 THEN '28' ELSE '08' END",
            "EKGRP": "CASE WHEN (p_partkey * 4 + n_nationkey) % 103 = 0 THEN NULL WHEN (p_partkey * 4 + n_nationkey) % 39 = 1 THEN 'Z99' ELSE CASE p_partkey % 5 WHEN 1 THEN 'Z15' WHEN 2 THEN 'Z12' ELSE '001' END END",
            "MMSTA": "CASE WHEN (p_partkey * 4 + n_nationkey) % 3 = 0 THEN NULL ELSE 'Z1' END",
            "DISMM": "CASE WHEN (p_partkey * 4 + n_nationkey) % 107 = 0 THEN NULL ELSE CASE WHEN n_nationkey % 2 = 0 THEN 'ND' ELSE 'PD' END END",
            "DISGR": "CASE WHEN (p_partkey * 4 + n_nationkey) % 109 = 0 THEN NULL WHEN (p_partkey * 4 + n_nationkey) % 113 = 1 THEN '3000' ELSE '3060' END",
            "DISPO": "CASE WHEN (p_partkey * 4 + n_nationkey) % 51 = 0 THEN NULL WHEN (p_partkey * 4 + n_nationkey) % 49 = 1 THEN 'Z02' ELSE 'Z01' END",
            "DISLS": "CASE WHEN (p_partkey * 4 + n_nationkey) % 33 = 0 THEN NULL WHEN (p_partkey * 4 + n_nationkey) % 57 = 1 THEN 'HB' ELSE CASE WHEN n_nationkey % 2 = 0 THEN 'WB' ELSE 'EX' END END",
            "BESKZ": "CASE WHEN (p_partkey * 4 + n_nationkey) % 63 = 0 THEN NULL WHEN (p_partkey * 4 + n_nationkey) % 69 = 1 THEN 'E' ELSE 'F' END",
            "SOBSL": "CASE (p_partkey * 4 + n_nationkey) % 11 WHEN 0 THEN '42' WHEN 1 THEN 'Z4' WHEN 2 THEN '44' WHEN 3 THEN '43' WHEN 4 THEN 'XX' ELSE NULL END",
            "LGFSB": "CASE WHEN (p_partkey * 4 + n_nationkey) % 23 = 0 THEN NULL WHEN (p_partkey * 4 + n_nationkey) % 27 = 1 THEN '0001' ELSE CASE WHEN (p_partkey * 4 + n_nationkey) % 29 = 0 THEN '6244' ELSE cast(6240 + 100 * ((p_partkey * 4 + n_nationkey) % 3) + (p_partkey * 4 + n_nationkey) % 8 AS string) END END",
            "WEBAZ": "cast(CASE WHEN (p_partkey * 4 + n_nationkey) % 77 = 0 THEN NULL WHEN (p_partkey * 4 + n_nationkey) % 81 = 1 THEN 2 ELSE 1 END AS int)",
            "PLIFZ": "cast(CASE WHEN (p_partkey * 4 + n_nationkey) % 17 = 0 THEN NULL ELSE 5 END AS int)",
            "FHORI": "CASE WHEN (p_partkey * 4 + n_nationkey) % 87 = 0 THEN NULL WHEN (p_partkey * 4 + n_nationkey) % 91 = 1 THEN '001' ELSE '000' END",
            "SHFLG": "CASE WHEN (p_partkey * 4 + n_nationkey) % 93 = 0 THEN NULL WHEN (p_partkey * 4 + n_nationkey) % 21 = 1 THEN '1' ELSE '2' END",
            "SHZET": "CASE WHEN (p_partkey * 4 + n_nationkey) % 99 = 0 THEN NULL WHEN (p_partkey * 4 + n_nationkey) % 19 = 1 THEN '10' ELSE '12' END",
            "STRGR": "CASE WHEN (p_partkey * 4 + n_nationkey) % 5 = 0 THEN NULL ELSE '40' END",
            "PERKZ": "CASE WHEN (p_partkey * 4 + n_nationkey) % 111 = 0 THEN NULL WHEN (p_partkey * 4 + n_nationkey) % 117 = 1 THEN 'M' ELSE 'T' END",
            "BSTRF": "cast(CASE WHEN (p_partkey * 4 + n_nationkey) % 13 = 0 THEN NULL WHEN (p_partkey * 4 + n_nationkey) % 25 = 1 THEN 0 ELSE 4 END AS int)",
            "BSTMI": "cast(CASE WHEN (p_partkey * 4 + n_nationkey) % 119 = 0 THEN NULL WHEN (p_partkey * 4 + n_nationkey) % 22 = 1 THEN 6 ELSE 8 END AS int)",
            "MAABC": "CASE WHEN (p_partkey * 4 + n_nationkey) % 121 = 0 THEN NULL WHEN (p_partkey * 4 + n_nationkey) % 123 = 1 THEN 'D' ELSE 'A' END",
        },
    ),
    "T": Derivation(
        base="part",
        fan_out=2,
        columns={
            "MATNR": MATERIAL_KEY,
            "SPRAS": "CASE n_nationkey WHEN 0 THEN 'S' ELSE 'E' END",
            "TXTMD": "CASE WHEN p_partkey % 41 = 0 THEN NULL WHEN p_partkey % 43 = 1 THEN '   ' WHEN p_partkey % 37 = 1 THEN concat(p_name,' jamón') WHEN p_partkey % 31 = 1 THEN concat(p_name,' xxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxx') ELSE substr(p_name,1,40) END",
        },
    ),
    "R": Derivation(
        base="part",
        fan_out=5,
        columns={
            "MATNR": MATERIAL_KEY,
            "MEINH": "CASE n_nationkey WHEN 0 THEN 'ST' WHEN 1 THEN 'CS' WHEN 2 THEN 'KG' WHEN 3 THEN 'PAL' ELSE 'CAP' END",
            "UMREN": "cast(CASE WHEN (p_partkey * 5 + n_nationkey) % 31 = 0 THEN NULL WHEN (p_partkey * 5 + n_nationkey) % 37 = 1 THEN 0 WHEN (p_partkey * 5 + n_nationkey) % 29 = 1 THEN 90 WHEN n_nationkey = 2 THEN 2 ELSE 1 END AS int)",
            "UMREZ": "cast(CASE WHEN n_nationkey < 2 AND (p_partkey * 5 + n_nationkey) % 41 = 0 THEN NULL ELSE CASE n_nationkey WHEN 0 THEN 1 WHEN 1 THEN CASE WHEN p_partkey % 4 = 0 THEN 1 ELSE 6 END WHEN 2 THEN 1 WHEN 3 THEN CASE WHEN p_partkey % 13 = 0 THEN 70 ELSE 72 END ELSE CASE WHEN p_partkey % 17 = 0 THEN 9 ELSE 12 END END END AS int)",
            "EAN11": "CASE WHEN (p_partkey * 5 + n_nationkey) % 43 = 0 THEN NULL WHEN (p_partkey * 5 + n_nationkey) % 47 = 1 THEN '' WHEN (p_partkey * 5 + n_nationkey) % 53 = 1 THEN '123' WHEN (p_partkey * 5 + n_nationkey) % 2 = 0 THEN '18400000000014' ELSE '8400000000017' END",
            "NUMTP": "CASE WHEN (p_partkey * 5 + n_nationkey) % 19 = 0 THEN 'UC' WHEN (p_partkey * 5 + n_nationkey) % 2 = 0 THEN 'IC' ELSE 'HE' END",
            "BRGEW": "cast(CASE WHEN (p_partkey * 5 + n_nationkey) % 59 = 0 THEN NULL WHEN (p_partkey * 5 + n_nationkey) % 23 = 1 THEN 99 WHEN p_partkey % 4 = 0 THEN 2.5 ELSE 15 END AS decimal(13,3))",
            "GEWEI": "CASE WHEN (p_partkey * 5 + n_nationkey) % 61 = 0 THEN NULL WHEN (p_partkey * 5 + n_nationkey) % 67 = 1 THEN 'G' ELSE 'KG' END",
            "VOLUM": "cast(CASE WHEN (p_partkey * 5 + n_nationkey) % 71 = 0 THEN NULL WHEN (p_partkey * 5 + n_nationkey) % 17 = 1 THEN 0 ELSE 0.1 END AS decimal(13,3))",
            "VOLEH": "CASE WHEN (p_partkey * 5 + n_nationkey) % 73 = 0 THEN NULL WHEN (p_partkey * 5 + n_nationkey) % 39 = 1 THEN 'L' ELSE 'M3' END",
            "LAENG": "cast(CASE WHEN (p_partkey * 5 + n_nationkey) % 79 = 0 THEN NULL WHEN (p_partkey * 5 + n_nationkey) % 83 = 1 THEN 0 ELSE 300 END AS decimal(13,3))",
            "BREIT": "cast(CASE WHEN (p_partkey * 5 + n_nationkey) % 89 = 0 THEN NULL WHEN (p_partkey * 5 + n_nationkey) % 97 = 1 THEN 0 ELSE 200 END AS decimal(13,3))",
            "HOEHE": "cast(CASE WHEN (p_partkey * 5 + n_nationkey) % 57 = 0 THEN NULL WHEN (p_partkey * 5 + n_nationkey) % 51 = 1 THEN 0 ELSE 100 END AS decimal(13,3))",
            "MEABM": "CASE WHEN (p_partkey * 5 + n_nationkey) % 49 = 0 THEN NULL WHEN (p_partkey * 5 + n_nationkey) % 33 = 1 THEN 'CM' ELSE 'MM' END",
        },
    ),
    "S": Derivation(
        base="part",
        fan_out=1,
        columns={
            "MATNR": MATERIAL_KEY,
            "MEGRU": "CASE WHEN p_partkey % 16 = 0 THEN NULL WHEN p_partkey % 25 = 1 THEN 'Z009' ELSE CASE WHEN p_partkey % 2 = 0 THEN 'Z001' ELSE 'Z002' END END",
        },
    ),
    "B": Derivation(
        base="part",
        fan_out=1,
        columns={
            "MATNR": MATERIAL_KEY,
            "BKLAS": "CASE WHEN p_partkey % 37 = 0 THEN NULL WHEN p_partkey % 29 = 1 THEN 'PT09' ELSE CASE p_partkey % 5 WHEN 1 THEN 'PT03' WHEN 2 THEN 'PT04' ELSE 'PT01' END END",
            "VPRSV": "CASE WHEN p_partkey % 41 = 0 THEN NULL WHEN p_partkey % 43 = 1 THEN 'S' ELSE 'V' END",
            "PEINH": "cast(CASE WHEN p_partkey % 47 = 0 THEN NULL WHEN p_partkey % 53 = 1 THEN 100 ELSE 1 END AS int)",
        },
    ),
    "V": Derivation(
        base="customer",
        fan_out=1,
        columns={
            "LIFNR": "lpad(cast((((c_custkey - CASE WHEN c_custkey % 101 = 0 THEN 4 ELSE 0 END) - (c_custkey - CASE WHEN c_custkey % 101 = 0 THEN 4 ELSE 0 END) % 10000) * 10) + CASE WHEN (c_custkey - CASE WHEN c_custkey % 101 = 0 THEN 4 ELSE 0 END) % 4 = 0 THEN 20000 ELSE 10000 END + (c_custkey - CASE WHEN c_custkey % 101 = 0 THEN 4 ELSE 0 END) % 10000 AS string),10,'0')",
            "ADRNR": "cast(900000 + c_custkey AS string)",
            "LAND1": "CASE WHEN c_custkey % 31 = 0 THEN NULL WHEN c_custkey % 37 = 1 THEN '' ELSE CASE WHEN c_nationkey % 2 = 0 THEN 'ES' ELSE 'PT' END END",
            "NAME1": "CASE WHEN c_custkey % 41 = 0 THEN NULL WHEN c_custkey % 43 = 1 THEN '' ELSE c_name END",
            "NAME2": "CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 11 = 1 THEN '' ELSE c_mktsegment END",
            "ORT01": "CASE WHEN c_custkey % 47 = 0 THEN NULL WHEN c_custkey % 53 = 1 THEN '' ELSE 'MADRID' END",
            "PSTLZ": "CASE WHEN c_custkey % 29 = 0 THEN NULL WHEN c_custkey % 23 = 1 THEN '' ELSE '28001' END",
            "REGIO": "CASE WHEN c_custkey % 19 = 0 THEN NULL WHEN c_custkey % 59 = 1 THEN '' ELSE '28' END",
            "SORTL": "CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 61 = 1 THEN '' ELSE 'KEY' END",
            "STRAS": "CASE WHEN c_custkey % 67 = 0 THEN NULL WHEN c_custkey % 71 = 1 THEN '' ELSE 'STREET' END",
            "SPRAS": "CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 73 = 1 THEN '' ELSE 'S' END",
            "STCD1": "CASE WHEN c_custkey % 79 = 0 THEN NULL WHEN c_custkey % 15 = 1 THEN '' ELSE 'B0' END",
            "KTOKK": "CASE WHEN c_custkey % 27 = 0 THEN NULL WHEN c_custkey % 33 = 1 THEN 'Z002' ELSE 'Z001' END",
            "STCEG": "CASE WHEN c_custkey % 9 = 0 THEN NULL WHEN c_custkey % 21 = 1 THEN '' ELSE 'PT1' END",
        },
    ),
    "L": Derivation(
        base="customer",
        fan_out=1,
        columns={
            "LIFNR": VENDOR_KEY,
            "ZZDIAPED": "CASE WHEN c_custkey % 25 = 0 THEN NULL WHEN c_custkey % 14 = 1 THEN CASE WHEN c_custkey % 2 = 0 THEN '' ELSE '7' END ELSE CASE WHEN c_custkey % 2 = 0 THEN '0' ELSE '1' END END",
        },
    ),
    "F": Derivation(
        base="customer",
        fan_out=1,
        columns={
            "LIFNR": VENDOR_KEY,
            "WAERS": "CASE WHEN c_custkey % 35 = 0 THEN NULL WHEN c_custkey % 39 = 1 THEN '' ELSE 'EUR' END",
            "WEBRE": "CASE WHEN c_custkey % 22 = 0 THEN NULL WHEN c_custkey % 26 = 1 THEN '' ELSE 'X' END",
            "EKGRP": "CASE WHEN c_custkey % 45 = 0 THEN NULL WHEN c_custkey % 49 = 1 THEN 'Z99' ELSE '001' END",
            "BSTAE": "CASE WHEN c_custkey % 51 = 0 THEN NULL WHEN c_custkey % 57 = 1 THEN 'Z001' ELSE 'Z004' END",
        },
    ),
    "K": Derivation(
        base="customer",
        fan_out=2,
        columns={
            "LIFNR": VENDOR_KEY,
            "PARNR": "CASE WHEN (c_custkey * 2 + n_nationkey) % 63 = 0 THEN NULL WHEN (c_custkey * 2 + n_nationkey) % 65 = 1 THEN '' ELSE cast((c_custkey * 2 + n_nationkey) AS string) END",
            "NAMEV": "CASE WHEN (c_custkey * 2 + n_nationkey) % 31 = 0 THEN NULL WHEN (c_custkey * 2 + n_nationkey) % 37 = 1 THEN '' ELSE 'ANA' END",
            "TELF1": "CASE WHEN (c_custkey * 2 + n_nationkey) % 11 = 0 THEN NULL WHEN (c_custkey * 2 + n_nationkey) % 17 = 1 THEN '' ELSE '600' END",
            "PAFKT": "CASE WHEN (c_custkey * 2 + n_nationkey) % 41 = 0 THEN NULL WHEN (c_custkey * 2 + n_nationkey) % 43 = 1 THEN '99' ELSE CASE WHEN n_nationkey = 0 THEN 'Z3' ELSE '10' END END",
            "PRSNR": "lpad(cast(c_custkey * 2 + n_nationkey AS string), 10, '0')",
            "PARLA": "CASE WHEN (c_custkey * 2 + n_nationkey) % 47 = 0 THEN NULL WHEN (c_custkey * 2 + n_nationkey) % 53 = 1 THEN '' ELSE 'S' END",
        },
    ),
    "A": Derivation(
        base="customer",
        fan_out=1,
        columns={
            "ADDRNUMBER": "cast(900000 + c_custkey AS string)",
            "SMTP_ADDR": "CASE WHEN c_custkey % 19 = 0 THEN NULL WHEN c_custkey % 23 = 1 THEN '' ELSE concat(c_name,'@x.es') END",
        },
    ),
    "W": Derivation(
        base="customer",
        fan_out=5,
        columns={
            "LIFNR": VENDOR_KEY,
            "PARVW": "CASE n_nationkey WHEN 0 THEN CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE 'BA' END WHEN 1 THEN CASE WHEN c_custkey % 17 = 0 THEN 'PR' ELSE ' lf' END WHEN 2 THEN CASE WHEN c_custkey % 19 = 0 THEN 'EF' ELSE 'RS' END WHEN 3 THEN CASE WHEN c_custkey % 23 = 0 THEN 'DP' ELSE 'ZE' END ELSE CASE WHEN c_custkey % 11 = 0 THEN 'ZO' ELSE 'LF' END END",
            "LIFN2": "CASE WHEN (c_custkey * 5 + n_nationkey) % 29 = 0 THEN NULL WHEN (c_custkey * 5 + n_nationkey) % 31 = 1 THEN 'X' WHEN n_nationkey = 3 AND c_custkey % 3 > 0 THEN concat('0c0', cast(c_custkey AS string)) ELSE lpad(cast(((c_custkey - c_custkey % 10000) * 10) + CASE WHEN c_custkey % 4 = 0 THEN 20000 ELSE 10000 END + c_custkey % 10000 AS string),10,'0') END",
        },
    ),
}


# The base columns the derivations read, so that no schema has to be inferred.
BASE_SCHEMAS = {
    "part": "p_partkey bigint, p_name string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
}


def derive(spark: SparkSession, sample_dir: str, code: str) -> DataFrame:
    """The staging table ``code`` over the sample parquet files in ``sample_dir``."""
    spec = DERIVATIONS[code]
    base = spark.read.schema(BASE_SCHEMAS[spec.base]).parquet(f"{sample_dir}/{spec.base}.parquet")
    if spec.fan_out > 1:
        ordinals = ", ".join(str(n) for n in range(spec.fan_out))
        base = base.selectExpr("*", f"explode(array({ordinals})) AS n_nationkey")
    return base.selectExpr(*[f"{sql} AS {name}" for name, sql in spec.columns.items()])
