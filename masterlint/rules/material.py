"""Rules on material master data (tables M, C, T, R, S, B)."""

from __future__ import annotations

from functools import partial

from masterlint.functions.conditions import (
    ALWAYS,
    blank_to_null,
    both,
    decide,
    either,
    is_in,
    length_outside,
    listed,
    missing,
    outside,
    present,
    text,
    trimmed,
    zero_or_missing,
)
from masterlint.operators import grouped, listing
from masterlint.operators.grouped import GOODS
from masterlint.rules.model import S90, S95, S99, Computed, Keys, Listing, Measure, Pairs, Policy, Repeats, Rows, Rule, Term
from masterlint.rules.notes import NOTES

FILE_TAG = "MARA"
KEYED_GOODS = both(GOODS, present("MATNR"))
SHORT = "MATNR5 AS MATNR"
M_SHORT = "M.MATNR5 AS MATNR"

# Characters that a description must not contain.
FORBIDDEN_CHARACTERS = r"""['"¡!#*\\`´ÁÉÍÓÚáéíóú]"""


# The platforms, the plants of each temperature zone, those that sell and those that hold stock.
PLATFORMS = ("4300", "4400")
CHILLED_PLANTS = ("6240", "6241", "6242", "6243", "6244", "6245", "6246", "6247")
DRY_PLANTS = ("6340", "6341", "6342", "6343", "6344", "6345", "6346", "6347")
FROZEN_PLANTS = ("6440", "6441", "6442", "6443", "6444", "6445", "6446", "6447")
SALES_PLANTS = ("6440", "6441", "6442", "6240", "6241", "6242", "6340", "6341", "6342", "4300", "4400")
STOCK_PLANTS = (
    "6443", "6444", "6445", "6446", "6447", "6243", "6244", "6245", "6246", "6247", "6343", "6344", "6345", "6346", "6347",
)
PLANNED_STOCK_PLANTS = ("6443", "6444", "6445", "6446", "6447", "6343", "6344", "6345", "6346", "6347")
# Plants without special procurement, plants an external platform supplies, plants without a
# strategy group.
UNPROCURED_PLANTS = ("6443", "6444", "6445", "6343", "6344", "6345", "6243", "6244", "6245")
EXTERNAL_PLANTS = {"4400": ("6444", "6344", "6244"), "4300": ("6443", "6343", "6243")}
MADE_TO_STOCK_PLANTS = ("6443", "6444", "6445", "6340", "6341", "6342", "6343", "6344", "6345")
# Plants whose replenishment settings are checked.
REPLENISHED_PLANTS = ("6440", "6441", "6442", "4300", "4400", "6340", "6341", "6342", "6242")


def unmet(condition: str) -> str:
    return f"NOT coalesce({condition}, FALSE)"


def _rule(id: int, check: str, policy: Policy, fails: Measure, total: Measure, rows: Listing, **more: bool) -> Rule:
    return Rule(id, "material", check, fails, total, policy, NOTES[id], FILE_TAG, rows, **more)


def on_material(
    id: int,
    check: str,
    policy: Policy,
    wrong: str,
    *columns: str,
    scope: str = GOODS,
    population: str = GOODS,
    order: tuple[str, ...] = (),
    distinct: bool = False,
    listed_rows: str | None = None,
    hidden: tuple[str, ...] = (),
    distinct_count: bool = False,
    **more: bool,
) -> Rule:
    """A rule on single materials: rows in ``scope`` that are ``wrong``."""
    where = both(scope, wrong)
    fails = Keys({"M": where}) if distinct_count else Rows("M", where)
    rows = Listing(columns, order, distinct, None if listed_rows is None else ({"M": listed_rows},), hidden=hidden)
    return _rule(id, check, policy, (fails,), (Rows("M", population),), rows, **more)


def on_join(
    other: str,
    id: int,
    check: str,
    policy: Policy,
    wrong: str | tuple[Term, ...],
    *columns: str,
    total: Measure | None = None,
    material: str = GOODS,
    order: tuple[str, ...] = (),
    distinct: bool = False,
    listed_rows: tuple[Term, ...] | None = None,
    distinct_count: bool = False,
) -> Rule:
    """A rule on materials joined with another table.

    ``wrong`` is a condition on the other table for goods in scope, or disjoint terms.
    """
    terms = ({"M": material, other: wrong},) if isinstance(wrong, str) else wrong
    fails = Keys(terms[0]) if distinct_count else Pairs(terms)
    total = total or (Pairs(({"M": GOODS, other: ALWAYS},)),)
    return _rule(id, check, policy, (fails,), total, Listing(columns, order, distinct, listed_rows))


on_plant = partial(on_join, "C")
on_value = partial(on_join, "B")


def on_unit(id: int, check: str, policy: Policy, wrong: str | tuple[Term, ...], *columns: str, units: tuple[str, ...], **more) -> Rule:
    """A rule on units of measure, whose population is the goods' rows for ``units``."""
    total = (Pairs(({"M": GOODS, "R": is_in("MEINH", units)},)),)
    return on_join("R", id, check, policy, wrong, *columns, total=total, **more)


def text_rule(id: int, language: str) -> Rule:
    wrong = both(
        f"SPRAS = {text(language)}",
        either(
            f"TXTMD RLIKE {text(FORBIDDEN_CHARACTERS)}",
            missing("TXTMD"),
            "length(TXTMD) > 40",
            f"{trimmed('TXTMD')} = ''",
        ),
    )
    return on_join(
        "T", id, "FORMAT", S95, wrong, "T.MATNR", "T.SPRAS", "T.TXTMD", total=(Rows("M", KEYED_GOODS),)
    )


def _special(id: int, check: str, policy: Policy, fails: Measure, total: Measure, frame, order=()) -> Rule:
    return _rule(id, check, policy, fails, total, Listing(order=order, frame=frame))


def _materials() -> list[Rule]:
    repeated = partial(
        listing.repeated_keys, code="M", where=ALWAYS, shown="MATNR", copies="total_ocurrencias"
    )
    temperature_fits = either(
        "ZZTEMPERATURA = 'CONGELADO' AND MTART = 'ZMER'",
        "ZZTEMPERATURA = 'SECO' AND MTART = 'ZSEC'",
        "ZZTEMPERATURA = 'REFRIGERAD' AND MTART = 'ZFRE'",
    )
    group = blank_to_null("MATKL")
    hierarchy = blank_to_null("PRDHA")
    hierarchy_branch = "substring(lpad(PRDHA, 18, '0'), 1, 12)"
    filled = both(GOODS, "INHAL <> 0")
    on = on_material
    return [
        _rule(
            1, "UNIQUE", S99, (Repeats("M"),), (Rows("M"),), Listing(order=("MATNR",), frame=repeated), export_when_failed=True
        ),
        on(2, "DOMAIN", S99, outside("MBRSH", "A"), SHORT, "MBRSH", export_when_failed=True),
        on(
            3, "DECISION_TABLE", S99, "RAW_DIGIT NOT IN ('1', '3', '4')", SHORT, "MTART", order=("MATNR",),
            listed_rows=both(GOODS, "DIGIT NOT IN ('1', '3', '4')"), coarse_rate=True, export_when_failed=True,
        ),
        on(8, "DOMAIN", S99, outside("SPART", "10"), SHORT, "MTART", population=KEYED_GOODS),
        on(
            12, "DOMAIN", S90, outside(group, "SUPPLIER", "SYSCO", "NO.BRAND", "METRO", "MAKRO", "PAP", "CUSTOMER"),
            SHORT, f"{group} AS MATKL", "MTART", order=("MATNR",),
        ),
        on(13, "DOMAIN", S99, outside("MEINS", "ST", "CS", null_fails=False), SHORT, "MTART", "MEINS", order=("MATNR DESC",)),
        on(
            14, "FORMAT", S99, either(both(GOODS, missing("PRDHA")), "length(PRDHA) <> 18"), SHORT, "MTART",
            decide(
                (f"{hierarchy} IS NULL", "INCORRECTO: jerarquía nula"),
                (f"length({hierarchy}) <> 18", "INCORRECTO: campo de jerarquia menor a 18 carcateres"),
            ) + " AS motivo",
            scope=ALWAYS, order=("MATNR",), listed_rows=both(GOODS, length_outside(hierarchy, 18, 18)),
        ),
        _special(
            15, "GROUP_MEMBERSHIP", S99, (Computed(grouped.group_membership, "FAILED"),), (Rows("M", GOODS),),
            listing.flagged_groups,
        ),
        _special(
            16, "SELF_REFERENCE", S99, (Computed(grouped.substitute_links, "FAILED"),), (Rows("M", KEYED_GOODS),),
            listing.broken_links, ("MATNR",),
        ),
        on(
            17, "DECISION_TABLE", S99, both("CWM_XCWMAT = 'X'", present("CWM_TOLGR")), SHORT, "CWM_XCWMAT AS XCWMAT",
            "CWM_TOLGR AS TOLGR", scope=ALWAYS, population=KEYED_GOODS,
        ),
        on(
            18, "FORMAT", S99, either(missing("MTPOS_MARA"), "MTPOS_MARA NOT LIKE '%NORM'"), SHORT, "MTART", "MTPOS_MARA",
            order=("MATNR",),
        ),
        on(19, "COMPLETENESS", S90, missing("ZZMARCADOR"), SHORT, "MTART", "ZZMARCADOR", order=("MATNR DESC",)),
        on(
            20, "DECISION_TABLE", S99, unmet(temperature_fits), SHORT, "MTART", "ZZTEMPERATURA",
            "'INCORRECTO' AS condicion", population=KEYED_GOODS, order=("MATNR",),
        ),
        on(
            21, "DOMAIN", S90, outside("ZZMOVIMIENTO", "ALTA", "ALTA-SUSTITUCIÓN", "ALTA-ALTERNATIVA"), SHORT,
            "ZZMOVIMIENTO", population=KEYED_GOODS, order=("MATNR",), distinct=True,
        ),
        on(
            22, "COMPLETENESS", S90, missing("ZZMARCA"), "MATNR", "MTART", "ZZMARCA", order=("MATNR DESC",),
            export_when_failed=True,
        ),
        on(
            23, "DOMAIN", S90, outside("ZZCLASIFICACION", "BÁSICO", "VENTAJOSO", "EXCLUSIVO"), SHORT, "ZZCLASIFICACION",
            population=KEYED_GOODS, order=("MATNR",), distinct=True,
        ),
        on(
            24, "NUMERIC", S90, either("INHAL >= BRGEW", "INHAL >= NTGEW", both(missing("INHME"), "INHAL <> 0")), SHORT,
            "INHAL", "NTGEW", "BRGEW", "INHME", population=both(filled, present("MATNR")), distinct_count=True,
        ),
        on(
            25, "DECISION_TABLE", S95, either("VABME = '2'", both("MEINS = 'ST'", missing("VABME"))), SHORT, "MTART",
            "VABME", "MEINS", order=("MATNR",),
        ),
        on(
            26, "DECISION_TABLE", S95, both(f"{hierarchy_branch} = '101010010510'", outside("ZZFRAGIL", "X")), SHORT,
            f"{hierarchy_branch} AS PRDHA", "ZZFRAGIL", "MTART",
        ),
        on(27, "COMPLETENESS", S95, missing("EAN11"), SHORT, "EAN11", order=("MATNR DESC",)),
        on(28, "COMPLETENESS", S95, missing("NUMTP"), "MATNR5 AS MATERIAL", "MEINS", "NUMTP", order=("MATERIAL",)),
        on(
            29, "NUMERIC", S99, zero_or_missing("BRGEW"), SHORT, "BRGEW", "NTGEW", hidden=("MATNR AS SORT_KEY",),
            order=("SORT_KEY DESC",),
        ),
        on(
            30, "NUMERIC", S99, zero_or_missing("NTGEW"), SHORT, "NTGEW", "MTART", hidden=("MATNR AS SORT_KEY",),
            order=("SORT_KEY DESC",),
        ),
        on(31, "DOMAIN", S99, outside("GEWEI", "KG", null_fails=False), "MATNR", "MTART", "GEWEI", order=("MATNR DESC",)),
        on(32, "NUMERIC", S99, zero_or_missing("VOLUM"), SHORT, "MEINS", "VOLUM"),
        on(33, "DOMAIN", S99, either(both(GOODS, missing("VOLEH")), "VOLEH <> 'M3'"), SHORT, "MEINS", "VOLEH", scope=ALWAYS),
        on(34, "NUMERIC", S99, both("MEINS = 'CS'", zero_or_missing("LAENG")), SHORT, "MEINS", "LAENG", "MEABM"),
        on(
            35, "NUMERIC", S99, zero_or_missing("BREIT"), SHORT, "MEINS", "BREIT", "MEABM",
            listed_rows=both(GOODS, "MEINS = 'CS'", zero_or_missing("BREIT")),
        ),
        on(
            36, "NUMERIC", S99, zero_or_missing("HOEHE"), SHORT, "MEINS", "HOEHE", "MEABM",
            listed_rows=both(GOODS, "MEINS = 'CS'", zero_or_missing("HOEHE")),
        ),
        on(37, "DOMAIN", S99, outside("MEABM", "MM"), SHORT, "MEINS", "MEABM"),
        on(38, "DOMAIN", S99, outside("INHME", "KG"), SHORT, "INHME", scope=filled, population=filled),
        _rule(
            39, "DOMAIN", S99, (Rows("M", both(GOODS, outside("XCHPF", "X", null_fails=False))),), (Rows("M", GOODS),),
            Listing(
                frame=partial(
                    listing.code_frequencies, code="M", column="XCHPF",
                    where=both(GOODS, outside("XCHPF", "X", null_fails=False)),
                )
            ),
        ),
        on(
            41, "DOMAIN", S99, outside("TRAGR", "0001"), SHORT, "TRAGR", listed_rows=both(GOODS, missing("TRAGR")),
            distinct_count=True,
        ),
        on(
            68, "DECISION_TABLE", S99, both(present("CWM_TOLGR"), "CWM_XCWMAT <> 'X'"), SHORT, "CWM_XCWMAT", "CWM_TOLGR",
            listed_rows=both(present("CWM_TOLGR"), "CWM_XCWMAT <> 'X'"),
        ),
    ]


def _plants() -> list[Rule]:
    on = on_plant
    type_fits = either(
        "RAW_DIGIT = '1' AND MTART = 'ZMER'", "RAW_DIGIT = '3' AND MTART = 'ZFRE'", "RAW_DIGIT = '4' AND MTART = 'ZSEC'"
    )
    wrong_plant = either(
        both("DIGIT IN ('1', '3')", outside("PLANT", *FROZEN_PLANTS, *CHILLED_PLANTS, *PLATFORMS)),
        both("DIGIT = '4'", outside("PLANT", *DRY_PLANTS, *PLATFORMS)),
    )
    buyer_fits = either(
        "DIGIT = '1' AND EKGRP = '001'", "DIGIT = '3' AND EKGRP = 'Z15'", "DIGIT = '4' AND EKGRP = 'Z12'"
    )
    purchase_fits = either(
        both(is_in("WERKS", STOCK_PLANTS), missing("MMSTA")), both(is_in("WERKS", SALES_PLANTS), present("MMSTA"))
    )
    planning_fits = either(
        both(is_in("WERKS", PLANNED_STOCK_PLANTS), "DISMM = 'ND'"),
        both(is_in("WERKS", SALES_PLANTS), is_in("DISMM", ("ND", "PD"))),
    )
    # Special procurement keys and the plant each must not be used in.
    procurement_fits = both(
        f"WERKS NOT IN {listed(UNPROCURED_PLANTS)}",
        either(
            "SOBSL = '42' AND WERKS <> '6442'",
            "SOBSL = 'Z4' AND WERKS <> '4400'",
            "SOBSL = '44' AND WERKS <> '6342'",
            "SOBSL = '43' AND WERKS <> '4300'",
        ),
    )
    external_fits = either(
        *[
            both(is_in("LGFSB", plants), f"WERKS = '{platform}'")
            for platform, plants in EXTERNAL_PLANTS.items()
        ],
        "LGFSB = WERKS",
    )
    strategy_fits = both(
        "DIGIT IN ('1', '3', '4')",
        either(
            both(is_in("WERKS", SALES_PLANTS), "STRGR = '40'"),
            both(
                is_in("WERKS", MADE_TO_STOCK_PLANTS),
                missing("STRGR", or_empty=True),
            ),
        ),
    )
    replenished = is_in("WERKS", REPLENISHED_PLANTS)
    not_multiple = both(
        present("BSTRF"), present("BSTMI"), "BSTRF <> 0", either("BSTRF > BSTMI", "try_mod(BSTMI, BSTRF) <> 0")
    )
    outcome = ("C.MMSTA", "M.MTART", "C.WERKS")
    return [
        on(
            5, "DECISION_TABLE", S99, wrong_plant, "'INCORRECTO' AS estado", M_SHORT, "C.DIGIT AS d5", "C.PLANT AS WERKS",
            material=ALWAYS, order=("MATNR",),
        ),
        on(
            6, "DECISION_TABLE", S99,
            both(
                "DIGIT IN ('1', '3', '4')",
                either(missing("STORAGE"), missing("STORAGE_EXPECTED"), "STORAGE <> STORAGE_EXPECTED"),
            ),
            "M.MATNR18 AS MATNR", "M.MTART", "C.DIGIT AS d5", "cast(C.PLANT_NUMBER AS string) AS WERKS",
            "C.STORAGE AS LGPRO", "C.STORAGE_EXPECTED AS LGPRO_esperado",
            decide(
                ("C.STORAGE IS NULL", "INCORRECTO: LGPRO nulo"),
                ("C.STORAGE_EXPECTED IS NULL", "FUERA_DE_REGLA: combinación no contemplada d5/WERKS"),
                otherwise="INCORRECTO: LGPRO no cumple con la regla de validación",
            ) + " AS motivo",
            order=("WERKS", "MATNR"),
        ),
        on(
            7, "DECISION_TABLE", S99, "KOKRS <> 'ES14'", "M.MATNR", "M.MTART", "C.KOKRS", "M.RAW_DIGIT AS d5",
            decide(
                ("M.RAW_DIGIT = '1'", "ZMER"), ("M.RAW_DIGIT = '3'", "ZFRE"), ("M.RAW_DIGIT = '4'", "ZSEC"),
                otherwise="TIPO DESCONOCIDO",
            ) + " AS valor_esperado",
            material=type_fits,
        ),
        on(40, "DOMAIN", S99, outside("MTVFP", "Z2"), M_SHORT, "C.WERKS", "C.MTVFP", distinct_count=True),
        on(42, "DOMAIN", S99, outside("LADGR", "0001"), M_SHORT, "C.LADGR", "C.WERKS"),
        on(
            43, "DECISION_TABLE", S99, either("PRCTR <> CENTRE_EXPECTED", missing("CENTRE_EXPECTED")), M_SHORT,
            "C.PLANT AS WERKS", "C.PRCTR", "M.MTART", "C.CENTRE_EXPECTED AS cebe_correcto",
        ),
        on(44, "FORMAT", S99, length_outside("STAWN", 6, 10), M_SHORT, "C.WERKS", "C.MMSTA", "C.STAWN"),
        on(45, "COMPLETENESS", S99, missing("HERKL"), M_SHORT, "C.WERKS", "C.HERKL", "M.MTART", "C.MMSTA"),
        on(46, "DOMAIN", S99, outside("MTVER", "0001"), M_SHORT, "C.WERKS", "C.MTVER", "M.MTART", distinct=True),
        on(
            47, "DOMAIN", S99, outside("HERKR", "08"), M_SHORT, "C.WERKS", "C.HERKR", "M.MTART", distinct=True,
            listed_rows=({"M": GOODS, "C": missing("HERKR")}, {"M": ALWAYS, "C": "HERKR <> '08'"}),
        ),
        on(
            49, "DECISION_TABLE", S99, unmet(buyer_fits), M_SHORT, "C.WERKS", "C.EKGRP", "M.MTART",
            "'INCORRECTO' AS resultado", "C.MMSTA", distinct=True, order=("MATNR DESC",),
        ),
        on(
            50, "DECISION_TABLE", S99, unmet(purchase_fits), M_SHORT, "C.WERKS", "C.MMSTA", "C.DISMM", "M.MTART",
            "M.MSTAV", "'REVISAR' AS control_relacion", order=("MMSTA",),
        ),
        on(
            51, "COMPLETENESS", S99, ALWAYS, M_SHORT, "C.WERKS", "M.BSTME", "M.MEINS", distinct=True,
            material=both(GOODS, missing("BSTME"), "MEINS = 'ST'"),
        ),
        on(
            52, "DECISION_TABLE", S99, unmet(planning_fits), M_SHORT, "C.MMSTA", "C.DISMM", "M.MTART", "C.WERKS",
            "M.MSTAV", "'REVISAR' AS control_relacion",
        ),
        on(53, "DOMAIN", S95, outside("DISGR", "3060"), M_SHORT, "C.WERKS", "C.DISGR", distinct=True),
        on(54, "DOMAIN", S95, outside("DISPO", "Z01"), M_SHORT, "C.WERKS", "C.DISPO", distinct=True),
        on(
            55, "DOMAIN", S99, outside("DISLS", "WB", "EX"), M_SHORT, "C.MMSTA", "C.DISLS", "M.MTART", "C.WERKS",
            "'INCORRECTOS' AS resultado",
        ),
        on(56, "DOMAIN", S99, outside("BESKZ", "F", null_fails=False), M_SHORT, *outcome, "C.BESKZ"),
        on(
            57, "DECISION_TABLE", S99, both(present("SOBSL"), unmet(procurement_fits)), M_SHORT, "C.MMSTA", "C.SOBSL",
            "M.MTART", "C.WERKS", "'INCORRECTO' AS resultado",
        ),
        on(
            58, "DECISION_TABLE", S99, both(present("LGFSB"), unmet(external_fits)), M_SHORT, "C.MMSTA", "C.LGFSB",
            "M.MTART", "C.WERKS", "'INCORRECTOS' AS resultado",
        ),
        on(60, "NUMERIC", S95, "WEBAZ <> 1", M_SHORT, *outcome, "C.WEBAZ"),
        on(61, "COMPLETENESS", S99, both(replenished, missing("PLIFZ")), M_SHORT, *outcome, "C.PLIFZ"),
        on(62, "DOMAIN", S95, outside("FHORI", "000"), M_SHORT, *outcome, "C.FHORI"),
        on(63, "DOMAIN", S90, both(outside("SHFLG", "2"), replenished), M_SHORT, *outcome, "C.SHFLG"),
        on(
            64, "DOMAIN", S90, both(outside("SHZET", "12", "13", "14", null_fails=False), replenished), M_SHORT, *outcome,
            "C.SHFLG",
        ),
        on(
            65, "DECISION_TABLE", S90, unmet(strategy_fits), M_SHORT, "C.DIGIT AS d5", *outcome, "C.STRGR",
            "'INCORRECTO' AS resultado",
        ),
        on(
            66, "COMPLETENESS", S99, ALWAYS, M_SHORT, *outcome, "M.TEMPB", material=both(GOODS, missing("TEMPB")),
        ),
        on(67, "DOMAIN", S90, outside("PERKZ", "T"), M_SHORT, *outcome, "C.PERKZ"),
        on(
            87, "NUMERIC", S99, not_multiple, SHORT, "WERKS", "BSTRF", "BSTMI", listed_rows=({"C": not_multiple},),
        ),
        on(
            88, "DOMAIN", S90,
            ({"M": GOODS, "C": missing("MAABC")}, {"M": ALWAYS, "C": outside("MAABC", "A", "B", "C", null_fails=False)}),
            M_SHORT, "C.WERKS", "C.MAABC",
        ),
    ]


def _units() -> list[Rule]:
    on = on_unit
    pieces, cases = both(GOODS, "MEINS = 'ST'"), both(GOODS, "MEINS = 'CS'")
    any_pieces, any_cases = "MEINS = 'ST'", "MEINS = 'CS'"
    conversion = (M_SHORT, "M.MEINS", "R.UMREN", "R.MEINH")
    case_blank = both("MEINH = 'CS'", missing("EAN11", or_empty=True))
    piece_blank = both("MEINH = 'ST'", missing("EAN11", or_empty=True))
    case, both_units = ("CS",), ("CS", "ST")
    weighed = both(pieces, present("BRGEW"))
    case_weighed = both("MEINH = 'CS'", present("UMREZ"), present("BRGEW"))
    netted = both(GOODS, present("NTGEW"))
    ratio_known = both("MEINH = 'KG'", present("UMREN"), "UMREZ <> 0")
    goods_with = lambda *units: (Pairs(({"M": GOODS, "R": is_in("MEINH", units)},)),)
    measured = partial(on, units=case)
    return [
        on(
            69, "NUMERIC", S99,
            (
                {"M": pieces, "R": "MEINH = 'ST' AND (UMREN IS NULL OR UMREN <> 1)"},
                {"M": any_cases, "R": "MEINH = 'ST' AND (UMREN IS NULL OR UMREN < 1)"},
            ),
            *conversion, units=both_units,
        ).with_total((Rows("M", GOODS),)),
        on(
            70, "NUMERIC", S99,
            (
                {"M": pieces, "R": "MEINH = 'CS' AND UMREZ < UMREN"},
                {"M": any_cases, "R": "MEINH = 'CS' AND UMREZ <> UMREN AND UMREN <> 1"},
            ),
            *conversion, units=both_units,
        ),
        on(
            71, "NUMERIC", S99,
            (
                {"M": cases, "R": "MEINH = 'CS' AND (UMREZ IS NULL OR UMREZ <> 1)"},
                {"M": any_pieces, "R": "MEINH = 'CS' AND (UMREZ IS NULL OR UMREZ < 1)"},
            ),
            *conversion, units=both_units,
        ),
        on(
            72, "COMPLETENESS", S95,
            (
                {"M": GOODS, "R": case_blank, "S": ALWAYS},
                {"M": unmet(GOODS), "R": case_blank, "S": is_in("MEGRU", ("Z001", "Z002"))},
                {"M": any_pieces, "R": piece_blank, "S": "MEGRU = 'Z001'"},
            ),
            M_SHORT, "M.MEINS", "S.MEGRU", "R.MEINH", "R.EAN11", units=both_units,
        ),
        on(
            73, "FORMAT", S95,
            both(
                present("EAN11"), "EAN11 <> ''",
                either(
                    "length(EAN11) = 14 AND NUMTP <> 'IC' AND MEINH <> 'CS'",
                    "length(EAN11) = 13 AND NUMTP <> 'HE' AND MEINH <> 'ST'",
                    both("length(EAN11) NOT IN (13, 14)", is_in("MEINH", both_units)),
                ),
            ),
            M_SHORT, "M.MEINS", "R.MEINH", "R.EAN11", "R.NUMTP", "length(R.EAN11) AS longitud_ean", units=both_units,
        ),
        # differing pairs = comparable pairs - equal pairs; with UMREZ 0 only a zero weight is equal
        _special(
            74, "NUMERIC", S99,
            (
                Pairs(({"M": weighed, "R": case_weighed},)),
                Pairs(({"M": weighed, "R": both(case_weighed, "UMREZ = 0", "round(BRGEW, 3) = 0")},), sign=-1),
                Computed(grouped.equal_quantities, "CASES", sign=-1),
            ),
            goods_with(*both_units), listing.unbalanced_weights,
        ),
        measured(
            75, "DOMAIN", S99, both("MEINH = 'CS'", outside("GEWEI", "KG", null_fails=False)), M_SHORT, "R.MEINH",
            "R.GEWEI", material=pieces,
        ),
        measured(
            76, "NUMERIC", S99, both("MEINH = 'CS'", either(missing("VOLUM"), "VOLUM <= 0")), M_SHORT, "R.MEINH",
            "R.VOLUM", material=pieces,
        ),
        measured(
            77, "DOMAIN", S99, both("MEINH = 'CS'", outside("VOLEH", "M3", null_fails=False), present("VOLUM")), M_SHORT,
            "R.MEINH", "R.VOLUM", "R.VOLEH",
        ),
        measured(
            78, "NUMERIC", S99, both("MEINH = 'CS'", zero_or_missing("LAENG")), M_SHORT, "R.MEINH", "R.LAENG",
            listed_rows=({"M": GOODS, "R": both("MEINH = 'CS'", missing("LAENG"))},),
        ),
        measured(79, "NUMERIC", S99, both("MEINH = 'CS'", zero_or_missing("BREIT")), M_SHORT, "R.MEINH", "R.LAENG"),
        measured(80, "NUMERIC", S99, both("MEINH = 'CS'", zero_or_missing("HOEHE")), M_SHORT, "R.MEINH", "R.LAENG"),
        measured(81, "DOMAIN", S99, both("MEINH = 'CS'", outside("MEABM", "MM")), M_SHORT, "R.MEINH", "R.MEABM"),
        _special(
            82, "NUMERIC", S99,
            (Pairs(({"M": netted, "R": ratio_known},)), Computed(grouped.equal_quantities, "RATIOS", sign=-1)),
            goods_with("CS"), listing.unbalanced_ratios,
        ),
        on(
            83, "NUMERIC", S99, both("MEINH = 'PAL'", "UMREN <> 1"), M_SHORT, "R.MEINH", "R.UMREN", units=("PAL",),
        ),
        _special(
            84, "UNIT_PIVOT", S99, (Computed(grouped.pack_divisibility, "PALLET"),), goods_with("PAL"),
            partial(listing.indivisible_packs, condition=grouped.PALLET_INDIVISIBLE),
        ),
        _special(
            85, "UNIT_PIVOT", S99, (Computed(grouped.pack_divisibility, "LAYER"),), goods_with("CAP"),
            partial(listing.indivisible_packs, condition=grouped.LAYER_INDIVISIBLE),
        ),
        on(
            86, "NUMERIC", S99, both("MEINH = 'CAP'", "UMREN <> 1"), M_SHORT, "R.MEINH", "R.UMREN", units=("CAP",),
        ),
    ]


def _values() -> list[Rule]:
    on = on_value
    price = trimmed("VPRSV")
    group = trimmed("MEGRU")
    return [
        on(
            89, "DECISION_TABLE", S99,
            (
                {"M": GOODS, "B": "DIGIT = '1' AND BKLAS <> 'PT01'"},
                {"M": ALWAYS, "B": either("DIGIT = '4' AND BKLAS <> 'PT04'", "DIGIT = '3' AND BKLAS <> 'PT03'")},
            ),
            M_SHORT, "B.BKLAS", "B.DIGIT AS d1",
        ),
        on(
            90, "DOMAIN", S99, ({"M": GOODS, "B": missing("VPRSV")}, {"M": ALWAYS, "B": f"{price} <> 'V'"}), M_SHORT,
            "B.VPRSV",
        ),
        on(
            91, "NUMERIC", S99, ({"M": GOODS, "B": missing("PEINH")}, {"M": ALWAYS, "B": "PEINH <> 1"}), M_SHORT, "B.PEINH"
        ),
        on_join(
            "S", 92, "DECISION_TABLE", S99,
            (
                {"M": both(GOODS, "MEINS = 'ST'"), "S": missing("MEGRU")},
                {"M": both(GOODS, "MEINS = 'CS'"), "S": either(missing("MEGRU"), f"{group} <> 'Z002'")},
            ),
            M_SHORT, "M.MEINS", "M.MTART", "S.MEGRU", total=(Rows("M", GOODS),), distinct=True,
        ),
    ]


def material_rules() -> list[Rule]:
    rules = [*_materials(), *_plants(), *_units(), text_rule(9, "S"), text_rule(11, "E"), *_values()]
    return sorted(rules, key=lambda rule: rule.id)
