"""DuckDB SQL for every registered query, over the sample tables."""

from __future__ import annotations

import re
from collections.abc import Iterable

from masterlint.rules.notes import NOTES
from masterlint.sources.samples import DERIVATIONS
from oracle.checks import CHECKS, LISTED, LISTINGS

RELATIONS = {
    "M": "M AS m",
    "C": "C AS c",
    "V": "V AS v",
    "L": "L AS l",
    "W": "W AS w",
    "MC": "M AS m JOIN C AS c ON m.MATNR = c.MATNR",
    "MR": "M AS m JOIN R AS r ON m.MATNR = r.MATNR",
    "MRS": "M AS m JOIN R AS r ON m.MATNR = r.MATNR JOIN S AS s ON m.MATNR = s.MATNR",
    "TM": "T AS t JOIN M AS m ON t.MATNR = m.MATNR",
    "MS": "M AS m JOIN S AS s ON m.MATNR = s.MATNR",
    "BM": "B AS b JOIN M AS m ON b.MATNR = m.MATNR",
    "LF": "L AS l JOIN F AS f ON l.LIFNR = f.LIFNR",
    "KL": "K AS k JOIN L AS l ON k.LIFNR = l.LIFNR",
    "KVA": "K AS k JOIN V AS v ON k.LIFNR = v.LIFNR JOIN A AS a ON v.ADRNR = a.ADDRNUMBER",
}

DIGIT = "substr(lpad(m.MATNR,18,'0'),14,1)"
PLANT = "nullif(trim(c.WERKS),'')"
PLANT_NUMBER = f"try_cast({PLANT} AS bigint)"


def _storage(zone: str, start: int) -> str:
    return (
        f"WHEN {DIGIT} = '{zone}' AND {PLANT_NUMBER} = 4400 THEN '{start + 4}' "
        f"WHEN {DIGIT} = '{zone}' AND {PLANT_NUMBER} = 4300 THEN '{start + 3}' "
        f"WHEN {DIGIT} = '{zone}' AND {PLANT_NUMBER} BETWEEN {start} AND {start + 7} THEN cast({PLANT_NUMBER} AS varchar) "
    )


WORDS = {
    "MT": "m.MTART IN ('ZMER','ZSEC','ZFRE')",
    "WG": "c.WERKS IN ('6440','6441','6442','4300','4400','6340','6341','6342','6242')",
    "d5": DIGIT,
    "d5s": "left(right(m.MATNR,5),1)",
    "WERKS_N": PLANT,
    "LGPRO_N": "nullif(trim(c.LGPRO),'')",
    "LGPRO_E": (
        f"(CASE {_storage('1', 6440)}{_storage('3', 6240)}{_storage('4', 6340)}"
        f"WHEN {DIGIT} = '4' AND {PLANT_NUMBER} = 6445 THEN '6445' END)"
    ),
    "PRCTR_E": (
        f"(CASE WHEN {PLANT} NOT IN ('4400','4300') THEN 'F64' || substr({PLANT},3,2) "
        f"WHEN {DIGIT} IN ('1','3','4') AND {PLANT} = '4400' THEN 'F6444' "
        f"WHEN {DIGIT} IN ('1','3','4') AND {PLANT} = '4300' THEN 'F6443' END)"
    ),
}
CALLS = {
    "VS": r"(substr(lpad(\1.LIFNR,10,'0'),6,1) = '1')",
    "RX": r"regexp_matches(\1, '[''\"¡!#*\\\\`´ÁÉÍÓÚáéíóú]')",
    "MATNR5": r"right(lpad(\1.MATNR,18,'0'),5)",
    "LIFNR5": r"right(lpad(\1.LIFNR,10,'0'),5)",
}


def expand(sql: str) -> str:
    sql = re.sub(r"\br\.UMREN / r\.UMREZ\b", "r.UMREN / nullif(r.UMREZ, 0)", sql)
    for word, meaning in WORDS.items():
        sql = re.sub(rf"(?<!AS )\b{word}\b", lambda _, meaning=meaning: meaning, sql)
    for name, meaning in CALLS.items():
        sql = re.sub(rf"\b{name}\(([\w.]+)\)", meaning, sql)
    return sql


def staging(codes: Iterable[str]) -> list[str]:
    """The staging tables as common table expressions."""
    parts = []
    for code in sorted(set(codes)):
        spec = DERIVATIONS[code]
        source = spec.base
        if spec.fan_out > 1:
            source += f" CROSS JOIN nation WHERE n_nationkey < {spec.fan_out}"
        columns = ", ".join(f"{sql} AS {name}" for name, sql in spec.columns.items())
        parts.append(f"{code} AS (SELECT {columns} FROM {source})")
    return parts


GROUP_FLAGS = """
    SELECT MATNR, BISMT, ZZSUSTITUTO,
        coalesce(NOT regexp_full_match(BISMT, '[0-9]{6}'), FALSE) AS formato_bismt,
        ZZSUSTITUTO IS NOT NULL AND coalesce(BISMT, '') = '' AS bismt_nulo_con_switch,
        BISMT IS NOT NULL AND of_group > 0 AND switched <> of_group - 1 AS grupo_n_vs_nmenos1,
        BISMT IS NOT NULL AND ZZSUSTITUTO IS NOT NULL AND NOT EXISTS (
            SELECT 1 FROM M AS m WHERE MT AND m.BISMT = item.BISMT AND MATNR5(m) = item.ZZSUSTITUTO) AS switch_fuera_de_grupo
    FROM (
        SELECT MATNR5(m) AS MATNR, BISMT, right(lpad(ZZSUSTITUTO, 18, '0'), 5) AS ZZSUSTITUTO,
            count(DISTINCT MATNR5(m)) OVER (PARTITION BY BISMT) AS of_group, count(ZZSUSTITUTO) OVER (PARTITION BY BISMT) AS switched
        FROM M AS m WHERE MT
    ) AS item"""

LINKS = """
    SELECT MATNR, BISMT, ZZSUSTITUTO, BISMT_SUSTITUTO, coalesce(climate, ungrouped, unknown, regrouped) AS tipo_error
    FROM (
        SELECT link.*, target.BISMT AS BISMT_SUSTITUTO,
            if(link.MATNR[1] <> link.ZZSUSTITUTO[1], 'error_temperatura', NULL) AS climate,
            if(coalesce(link.BISMT, '') = '', 'error_sin_codigo_agrupador', NULL) AS ungrouped,
            if(target.MATNR IS NULL, 'error_sustituto_no_existe', NULL) AS unknown,
            if(link.BISMT <> target.BISMT, 'error_bismt_distinto', NULL) AS regrouped
        FROM (SELECT MATNR5(m) AS MATNR, BISMT, right(lpad(ZZSUSTITUTO, 18, '0'), 5) AS ZZSUSTITUTO FROM M AS m WHERE ZZSUSTITUTO IS NOT NULL) AS link
        LEFT JOIN (SELECT MATNR5(m) AS MATNR, BISMT FROM M AS m) AS target ON target.MATNR = link.ZZSUSTITUTO
    )"""

PACKS = """
    SELECT MATNR5(m) AS MATNR, max(UMREZ) FILTER (MEINH = 'PAL') AS umrez_pal,
        max(UMREZ) FILTER (MEINH = 'CAP') AS umrez_cap, max(UMREZ) FILTER (MEINH = 'CS') AS umrez_cj
    FROM R JOIN M AS m USING (MATNR) WHERE MT AND list_contains(['CAP', 'CS', 'PAL'], MEINH) GROUP BY ALL"""
PALLET_WRONG = "len(list_filter([umrez_cap, umrez_cj], lambda x: umrez_pal % nullif(x, 0) <> 0)) > 0"
LAYER_WRONG = "len(list_filter([umrez_pal % nullif(umrez_cap, 0), umrez_cap % nullif(umrez_cj, 0)], lambda x: x <> 0)) > 0"

ROLES = """
    SELECT LIFNR, len(list_filter(held, lambda x: x = 'BA')) AS NUM_DP, len(list_filter(held, lambda x: x = 'LF')) AS NUM_PR,
        len(list_filter(held, lambda x: x = 'RS')) AS NUM_EF, len(list_filter(held, lambda x: x = 'ZE')) AS NUM_ZE,
        len(list_filter(held, lambda x: x = 'ZO')) AS NUM_ZO
    FROM (SELECT LIFNR, list(upper(trim(coalesce(PARVW, '')))) AS held FROM W AS w WHERE VS(w) GROUP BY ALL)"""
ROLES_WRONG = "least(NUM_DP, NUM_PR, NUM_EF, NUM_ZE) = 0 OR NUM_ZO <> 0"

REFERENCES = """
    SELECT v.LIFNR, NAME1, PARVW, LIFN2 FROM V AS v JOIN W AS w USING (LIFNR)
    WHERE VS(v) AND list_contains(['DP', 'EF', 'PR'], upper(trim(PARVW))) AND trim(coalesce(LIFN2, '')) <> trim(coalesce(v.LIFNR, ''))
    UNION
    SELECT v.LIFNR, NAME1, PARVW, LIFN2 FROM V AS v JOIN W AS w USING (LIFNR)
    WHERE VS(v) AND upper(trim(PARVW)) = 'ZE' AND coalesce(upper(trim(LIFN2)) NOT LIKE '0C0%', TRUE)"""

MATERIAL_COPIES = "SELECT MATNR, count(*) AS total_ocurrencias FROM M GROUP BY MATNR HAVING count(*) > 1"
VENDOR_COPIES = (
    "SELECT LIFNR5(v) AS LIFNR, count(*) AS registros FROM V AS v WHERE VS(v) GROUP BY v.LIFNR HAVING count(*) > 1"
)

# Rules that group rows: tables used, failure count, listing.
GROUPED: dict[int, tuple[str, str, str]] = {
    1: ("M", f"SELECT coalesce(sum(total_ocurrencias), 0) FROM ({MATERIAL_COPIES})", MATERIAL_COPIES),
    15: (
        "M",
        "SELECT count_if(formato_bismt OR bismt_nulo_con_switch OR grupo_n_vs_nmenos1 OR switch_fuera_de_grupo) "
        f"FROM ({GROUP_FLAGS})",
        GROUP_FLAGS,
    ),
    16: (
        "M",
        f"SELECT count(tipo_error) FROM ({LINKS})",
        f"SELECT * FROM ({LINKS}) WHERE tipo_error IS NOT NULL",
    ),
    84: (
        "MR",
        f"SELECT count_if({PALLET_WRONG}) FROM ({PACKS})",
        f"SELECT * FROM ({PACKS}) WHERE {PALLET_WRONG}",
    ),
    85: (
        "MR",
        f"SELECT count_if({LAYER_WRONG}) FROM ({PACKS})",
        f"SELECT * FROM ({PACKS}) WHERE {LAYER_WRONG}",
    ),
    93: ("V", f"SELECT coalesce(sum(registros), 0) FROM ({VENDOR_COPIES})", VENDOR_COPIES),
    113: (
        "KL",
        "SELECT count(*) FROM (SELECT 1 FROM K AS k JOIN L AS l ON k.LIFNR = l.LIFNR WHERE VS(l) "
        "GROUP BY l.LIFNR, k.PARNR HAVING count(DISTINCT k.PARNR) > 1)",
        "SELECT l.LIFNR, k.PARNR FROM K AS k JOIN L AS l ON k.LIFNR = l.LIFNR WHERE VS(l) "
        "GROUP BY l.LIFNR, k.PARNR HAVING count(*) > 1",
    ),
    119: (
        "W",
        f"SELECT count(*) FROM ({ROLES}) WHERE {ROLES_WRONG}",
        "SELECT LIFNR, concat_ws('; ', CASE WHEN NUM_DP = 0 THEN 'Falta la clave DP(BA)' END, "
        "CASE WHEN NUM_PR = 0 THEN 'Falta la clave PR(LF)' END, CASE WHEN NUM_EF = 0 THEN 'Falta la clave EF(RS)' END, "
        "CASE WHEN NUM_ZE = 0 THEN 'Falta la clave ZE' END, "
        "CASE WHEN NUM_ZO > 0 THEN 'Contiene la clave no permitida ZO' END) AS MOTIVO_ERROR, "
        f"NUM_DP, NUM_PR, NUM_EF, NUM_ZE, NUM_ZO FROM ({ROLES}) WHERE {ROLES_WRONG}",
    ),
    120: ("WV", f"SELECT count(*) FROM ({REFERENCES})", REFERENCES),
}


def literal(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _count_row(rule: int) -> tuple[str, str]:
    """Tables used, and a SELECT of one row of counts for a rule."""
    check = CHECKS[rule]
    total = f"SELECT count(*) FROM {RELATIONS[check.population]} WHERE {expand(check.scope)}"
    if rule in GROUPED:
        used, failed, _ = GROUPED[rule]
        failed = expand(failed)
    else:
        used = check.relation
        failed = f"SELECT {check.metric} FROM {RELATIONS[used]} WHERE {expand(check.failed)}"
    row = (
        f"SELECT {rule} AS RULE_ID, '{check.policy}' AS POLICY, {literal(NOTES[rule])} AS NOTE, "
        f"({total}) AS TOTAL_RECORDS, ({failed}) AS FAILED_RECORDS"
    )
    return used + check.population, row


RATED = """
    SELECT *, CASE WHEN RULE_ID = 3
        THEN coalesce(round(1 - FAILED_RECORDS / nullif(TOTAL_RECORDS, 0), 3) * 100, 100.0)
        ELSE round(coalesce((1 - FAILED_RECORDS / nullif(TOTAL_RECORDS, 0)) * 100, 100.0), 2) END AS RATE
    FROM {counts}"""
GRADED = """
    SELECT {kept}cast(RULE_ID AS bigint) AS RULE_ID, cast(TOTAL_RECORDS AS bigint) AS TOTAL_RECORDS,
        cast(FAILED_RECORDS AS bigint) AS FAILED_RECORDS, RATE AS PASSED_PERCENTAGE,
        CASE POLICY
            WHEN 'S99' THEN CASE WHEN RATE > 99 THEN 'PASSED' WHEN RATE < 99 THEN 'FAILED' ELSE 'ERROR' END
            WHEN 'S95' THEN CASE WHEN RATE > 95 THEN 'PASSED' WHEN RATE < 95 THEN 'FAILED' ELSE 'ERROR' END
            WHEN 'S90' THEN CASE WHEN RATE > 90 THEN 'PASSED' WHEN RATE < 90 THEN 'FAILED' ELSE 'ERROR' END
            WHEN 'G99' THEN CASE WHEN RATE >= 99 THEN 'PASSED' ELSE 'FAILED' END
            WHEN 'G95' THEN CASE WHEN RATE >= 95 THEN 'PASSED' ELSE 'FAILED' END
            WHEN 'G90' THEN CASE WHEN RATE >= 90 THEN 'PASSED' ELSE 'FAILED' END
            WHEN 'H100' THEN CASE WHEN RATE = 100 THEN 'PASSED' ELSE 'FAILED' END
            WHEN 'H93' THEN CASE WHEN RATE = 100 THEN 'PASSED' WHEN RATE < 99 THEN 'FAILED' ELSE 'ERROR' END
        END AS STATUS,
        concat('Total: ', cast(TOTAL_RECORDS AS bigint), ', Failed: ', cast(FAILED_RECORDS AS bigint), NOTE) AS DETAILS
    FROM (""" + RATED + ")"


def _with(parts: list[str], query: str) -> str:
    return f"WITH {', '.join(parts)} {query}" if parts else query


def results(rules: Iterable[int], staged: bool = False) -> str:
    """Graded results of the given rules. ``staged`` means that M, C, ... exist as tables."""
    tables, rows = zip(*[_count_row(rule) for rule in rules], strict=True)
    counts = "counts AS (" + " UNION ALL ".join(rows) + ")"
    sources = [] if staged else staging("".join(tables))
    return _with([*sources, counts], GRADED.format(kept="", counts="counts"))


def fact_rows(at: str) -> str:
    """Graded results of all rules as recorded at the UTC time ``at``."""
    return (
        f"SELECT *, 'result-' || RULE_ID AS RESULT_ID, TIMESTAMP {literal(at)} AS EXECUTION_TIME, "
        f"DATE {literal(at[:10])} AS EXECUTION_DATE FROM ({results(CHECKS)})"
    )


# Unit rows whose numbers came as texts with a unit behind them.
UNREAD = {"UMREZ": ("NUMTP = 'UC'", " EA"), "BRGEW": ("EAN11 = '123'", " kg")}


def rejected_values() -> str:
    """The numbers of unit rows that could not be read, as delivered."""
    columns = " UNION ALL ".join(
        f"SELECT 'bqt_ztbw_marm' AS SOURCE_TABLE, MATNR AS ROW_KEY, '{name}' AS COLUMN_NAME, {name} || '{unit}' AS VALUE "
        f"FROM R WHERE {name} IS NOT NULL AND {unread}"
        for name, (unread, unit) in UNREAD.items()
    )
    return _with(staging("R"), columns)


def suite_of_texts(rules: list[int]) -> str:
    """Graded results where the numbers of ``rejected_values`` are missing."""
    codes = "".join(_count_row(rule)[0] for rule in rules)
    missing = ", ".join(f"CASE WHEN {unread} THEN NULL ELSE {name} END AS {name}" for name, (unread, _) in UNREAD.items())
    units = _with(staging("R"), f"SELECT * REPLACE ({missing}) FROM R")
    others = [part for part in staging(codes) if not part.startswith("R AS ")]
    return _with([*others, f"R AS ({units})"], f"SELECT * FROM ({results(rules, staged=True)})")


# Rules exported only when their status is FAILED.
EXPORTED_WHEN_FAILED = (1, 2, 3, 22)


def export_gate() -> str:
    """All rules, and whether a run exports their failing rows."""
    return (
        f"SELECT RULE_ID, STATUS = 'FAILED' AS WANTED FROM ({results(CHECKS)}) WHERE RULE_ID IN {EXPORTED_WHEN_FAILED} "
        f"UNION ALL SELECT RULE_ID, PASSED_PERCENTAGE <> 100 FROM ({results(CHECKS)}) WHERE RULE_ID NOT IN {EXPORTED_WHEN_FAILED}"
    )


def violations(rule: int, staged: bool = False) -> str:
    """The rows behind a rule's failures."""
    used, query = _listing(rule)
    return _with([] if staged else staging(used), query)


def _listing(rule: int) -> tuple[str, str]:
    """Tables used, and the SELECT of a rule's failing rows."""
    if rule == 39:
        return "M", (
            f"SELECT XCHPF, count(*) AS registros FROM M AS m "
            f"WHERE {expand(CHECKS[39].failed)} GROUP BY XCHPF"
        )
    if rule in GROUPED:
        used, _, rows = GROUPED[rule]
        return used, expand(rows)
    relation, predicate = LISTED.get(rule, (CHECKS[rule].relation, CHECKS[rule].failed))
    return relation, f"SELECT {expand(LISTINGS[rule])} FROM {RELATIONS[relation]} WHERE {expand(predicate)}"


def _described(dimension: list[tuple]) -> str:
    """The rule dimension as a table expression; tuples of rule id and the described columns."""

    def shown(value: object) -> str:
        return literal(value) if isinstance(value, str) else "NULL" if value is None else str(value)

    return (
        "dimension(RULE_ID, RULE_NAME, RULE_DESCRIPTION, TARGET_TABLE, SQL_CONDITION, SEVERITY, THRESHOLD, ACTIVE, "
        'CREATED_AT, UPDATED_AT, "TABLE", TABLE_FIELD, TABLE_SOURCE, MASTER) AS (VALUES '
        + ", ".join("(" + ", ".join(shown(v) for v in row) + ")" for row in dimension)
        + ")"
    )


def _cube(facts: str) -> str:
    """The cube of the table expression ``facts``."""
    return (
        "SELECT a.*, b.RULE_NAME, b.RULE_DESCRIPTION, b.TARGET_TABLE, b.SQL_CONDITION, b.SEVERITY, "
        "cast(b.THRESHOLD AS double) AS THRESHOLD, b.ACTIVE, cast(b.CREATED_AT AS timestamp) AS CREATED_AT, "
        'cast(b.UPDATED_AT AS timestamp) AS UPDATED_AT, b."TABLE", b.TABLE_FIELD, b.TABLE_SOURCE, b.MASTER '
        "FROM (SELECT RULE_ID, cast(EXECUTION_TIME AS date) AS EXECUTION_DATE, max(RESULT_ID) AS RESULT_ID, "
        "max(TOTAL_RECORDS) AS TOTAL_RECORDS, max(FAILED_RECORDS) AS FAILED_RECORDS, "
        "max(PASSED_PERCENTAGE) AS PASSED_PERCENTAGE, max(STATUS) AS STATUS, max(DETAILS) AS DETAILS "
        f"FROM {facts} GROUP BY RULE_ID, cast(EXECUTION_TIME AS date)) a LEFT JOIN dimension b ON a.RULE_ID = b.RULE_ID"
    )


def daily_cube(runs: list[tuple[str, str, int]], dimension: list[tuple]) -> str:
    """The cube over replayed runs; a run is (name, UTC time, divisor of the failures)."""
    tables, rows = zip(*[_count_row(rule) for rule in CHECKS], strict=True)
    counted = "counted AS (" + " UNION ALL ".join(rows) + ")"
    replayed = (
        "replayed AS (SELECT RULE_ID, POLICY, NOTE, TOTAL_RECORDS, FAILED_RECORDS // divisor AS FAILED_RECORDS, "
        "name || '-' || RULE_ID AS RESULT_ID, cast(started AS timestamp) AS EXECUTION_TIME FROM counted, (VALUES "
        + ", ".join(f"({literal(name)}, {literal(at)}, {divisor})" for name, at, divisor in runs)
        + ") AS run(name, started, divisor))"
    )
    graded = f"graded AS ({GRADED.format(kept='RESULT_ID, EXECUTION_TIME, ', counts='replayed')})"
    return f"WITH {', '.join([*staging(''.join(tables)), counted, replayed, graded, _described(dimension)])} {_cube('graded')}"


def cube_history(rule_numbers: int, dimension: list[tuple]) -> str:
    """The cube over facts that stand for the events."""
    facts = (
        f"facts AS (SELECT user_id % {rule_numbers} AS RULE_ID, ts AS EXECUTION_TIME, event_type || '-' || event_id AS RESULT_ID, "
        "event_id AS TOTAL_RECORDS, event_id % 100 AS FAILED_RECORDS, value AS PASSED_PERCENTAGE, event_type AS STATUS, "
        "props AS DETAILS FROM events)"
    )
    return f"WITH {facts}, {_described(dimension)} {_cube('facts')}"
