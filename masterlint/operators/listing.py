"""The rows behind a rule's failures."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from masterlint.functions.conditions import ALWAYS, either, missing
from masterlint.operators import grouped
from masterlint.rules.model import Rule, Term
from masterlint.sources.catalog import Catalog
from masterlint.sources.schemas import SOURCES


def dealt_anew(key: str) -> Column:
    """``key`` as the key of a join below which Spark places a shuffle of its own.

    Adaptive execution splits a hot key only if nothing stands between a join and its
    shuffles. After a grouping or a join on the plain column their partitioning would be
    used instead, and the hot key stay in one task.
    """
    return F.concat(F.col(key), F.lit(""))


def violations(catalog: Catalog, rule: Rule) -> DataFrame:
    """The failing rows of ``rule`` with its display columns, in no particular order."""
    listing = rule.listing
    if listing.frame is not None:
        return listing.frame(catalog)
    terms = rule.terms()
    codes = list(terms[0])
    if len(codes) == 1:
        rows = _single(catalog, codes[0], terms)
    else:
        rows = _joined(catalog, codes, terms, _distinct_columns(rule, codes[0]))
    picked = rows.select(*[F.expr(item) for item in listing.columns])
    return picked.distinct() if listing.distinct else picked


def _single(catalog: Catalog, code: str, terms: tuple[Term, ...]) -> DataFrame:
    return catalog.table(code).alias(code).filter(F.expr(either(*[term[code] for term in terms])))


def _distinct_columns(rule: Rule, code: str) -> list[str] | None:
    """For a distinct listing, the columns shown of table ``code``; else None."""
    if not rule.listing.distinct:
        return None
    items = " ".join(rule.listing.columns)
    return sorted(set(re.findall(rf"\b{code}\.(\w+)", items)))


def _joined(catalog: Catalog, codes: list[str], terms: tuple[Term, ...], shown: list[str] | None) -> DataFrame:
    """Joined rows meeting any term.

    Each table decides its own part of every term before the join, so rows that can
    meet no term are dropped at the scan and only flags travel with the rest.
    """
    flags: dict[tuple[int, str], Column] = {}
    sides: list[DataFrame] = []
    for code in codes:
        df = catalog.table(code).filter(F.col(SOURCES[code].key).isNotNull())
        conditions = [term[code] for term in terms]
        if ALWAYS not in conditions:
            df = df.filter(F.expr(either(*dict.fromkeys(conditions))))
        named: dict[str, str] = {}
        for index, condition in enumerate(conditions):
            if condition == ALWAYS or len(terms) == 1:
                continue
            name = named.setdefault(condition, f"{code}_MEETS_{len(named)}")
            flags[index, code] = F.col(name)
        df = df.withColumns({name: F.expr(condition) for condition, name in named.items()})
        if shown is not None and code == codes[0]:
            # copies of a row on this side can only repeat rows that the listing drops
            key = SOURCES[code].key
            df = df.select(*dict.fromkeys([key, *shown, *named.values()])).distinct()
        sides.append(df.alias(code))
    first = codes[0]
    key = SOURCES[first].key
    rows = sides[0]
    for position, (code, side) in enumerate(zip(codes[1:], sides[1:], strict=True)):
        left = F.col(f"{first}.{key}") if position == 0 else dealt_anew(f"{first}.{key}")
        rows = rows.join(side, left == F.col(f"{code}.{key}"))
    if len(terms) == 1:
        return rows
    met = [
        reduce(Column.__and__, [flags[i, code] for code in codes if (i, code) in flags], F.lit(True))
        for i in range(len(terms))
    ]
    return rows.filter(reduce(Column.__or__, met))


def repeated_keys(catalog: Catalog, code: str, where: str, shown: str, copies: str) -> DataFrame:
    """Keys held by more than one row, with their number of rows."""
    key = SOURCES[code].key
    return (
        catalog.table(code)
        .filter(F.expr(where))
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias(copies))
        .filter(F.col(copies) > 1)
        .select(F.expr(shown), copies)
    )


def flagged_groups(catalog: Catalog) -> DataFrame:
    """Every material in scope with the four grouping-code flags."""
    goods = catalog.table("M").filter(F.expr(grouped.GOODS)).select("MATNR5", "BISMT", "SUBSTITUTE5")
    facts = grouped.group_facts(catalog).select("BISMT", "MATERIALS", "SWITCHES", "UNKNOWN_ITEMS")
    members = (
        grouped.group_codes(catalog)
        .filter("ITEMS > 0 AND CODE IS NOT NULL AND BISMT IS NOT NULL")
        .select(dealt_anew("BISMT").alias("MEMBER_OF"), "CODE", F.lit(True).alias("FOUND"))
    )
    facts = facts.withColumn("GROUP", dealt_anew("BISMT")).drop("BISMT")
    found = (F.col("BISMT") == F.col("MEMBER_OF")) & (F.col("SUBSTITUTE5") == F.col("CODE"))
    rows = goods.join(members, found, "left").join(facts, F.col("BISMT") == F.col("GROUP"), "left")
    grouping = F.col("BISMT").isNotNull()
    switch = F.col("SUBSTITUTE5").isNotNull()
    absent = F.when(F.col("FOUND"), False).when(F.col("UNKNOWN_ITEMS") == 0, True)
    return rows.select(
        F.col("MATNR5").alias("MATNR"),
        "BISMT",
        F.col("SUBSTITUTE5").alias("ZZSUSTITUTO"),
        (grouping & F.expr(grouped.BAD_GROUP_FORMAT)).alias("formato_bismt"),
        (switch & F.expr(missing("BISMT", or_empty=True))).alias("bismt_nulo_con_switch"),
        (grouping & F.expr(grouped.BAD_GROUP_SIZE)).alias("grupo_n_vs_nmenos1"),
        (grouping & switch & absent).alias("switch_fuera_de_grupo"),
    )


def broken_links(catalog: Catalog) -> DataFrame:
    """Materials with a substitute, next to each substitute row they disagree with."""
    materials = catalog.table("M")
    links = materials.filter("SUBSTITUTE5 IS NOT NULL").select("MATNR5", "BISMT", "SUBSTITUTE5")
    targets = materials.filter("MATNR5 IS NOT NULL").select(
        F.col("MATNR5").alias("TARGET"), F.col("BISMT").alias("BISMT_SUSTITUTO")
    )
    cause = (
        F.when(F.left("MATNR5", F.lit(1)) != F.left("SUBSTITUTE5", F.lit(1)), "error_temperatura")
        .when(F.expr(missing("BISMT", or_empty=True)), "error_sin_codigo_agrupador")
        .when(F.col("TARGET").isNull(), "error_sustituto_no_existe")
        .when(F.col("BISMT") != F.col("BISMT_SUSTITUTO"), "error_bismt_distinto")
    )
    return (
        links.join(targets, F.col("SUBSTITUTE5") == F.col("TARGET"), "left")
        .select(
            F.col("MATNR5").alias("MATNR"),
            "BISMT",
            F.col("SUBSTITUTE5").alias("ZZSUSTITUTO"),
            "BISMT_SUSTITUTO",
            cause.alias("tipo_error"),
        )
        .filter("tipo_error IS NOT NULL")
    )


def indivisible_packs(catalog: Catalog, condition: str) -> DataFrame:
    return grouped.pack_sizes(catalog).filter(F.expr(condition))


def unbalanced_weights(catalog: Catalog) -> DataFrame:
    """Cases whose gross weight is not the unit weight times the units per case."""
    unit = catalog.table("M").filter(F.expr(f"{grouped.GOODS} AND MEINS = 'ST'")).alias("M")
    case = catalog.table("R").filter("MEINH = 'CS'").alias("R")
    return (
        unit.join(case, "MATNR")
        .filter(f"{grouped.case_weight('M.BRGEW', 'R.UMREZ')} <> round(R.BRGEW, 3)")
        .select(
            F.col("M.MATNR5").alias("MATNR"),
            "R.UMREZ",
            "M.MEINS",
            "M.BRGEW",
            F.col("R.BRGEW").alias("peso_bruto_MARM"),
            "R.MEINH",
        )
    )


def unbalanced_ratios(catalog: Catalog) -> DataFrame:
    """KG units whose conversion factor is not the net weight."""
    goods = catalog.table("M").filter(F.expr(grouped.GOODS)).alias("M")
    units = catalog.table("R").filter("MEINH = 'KG'").alias("R")
    ratio = F.try_divide(F.col("R.UMREN"), F.col("R.UMREZ"))
    return (
        goods.join(units, "MATNR")
        .filter(ratio != F.col("M.NTGEW"))
        .select(
            F.col("M.MATNR5").alias("MATNR"), "R.MEINH", "R.UMREN", "R.UMREZ", "M.BRGEW", "M.NTGEW", ratio.alias("ratio")
        )
    )


def code_frequencies(catalog: Catalog, code: str, where: str, column: str) -> DataFrame:
    return catalog.table(code).filter(F.expr(where)).groupBy(column).agg(F.count(F.lit(1)).alias("registros"))


def repeated_contacts(catalog: Catalog) -> DataFrame:
    """(Vendor, contact number) keys that the join of contacts and vendors holds more than once."""
    contacts = (
        catalog.table("K").filter(F.expr(grouped.IN_SCOPE)).groupBy("LIFNR", "PARNR").agg(F.count(F.lit(1)).alias("ROWS"))
    )
    vendors = catalog.table("L").filter(F.expr(grouped.IN_SCOPE)).groupBy("LIFNR").agg(F.count(F.lit(1)).alias("COPIES"))
    contacts = contacts.withColumn("VENDOR", dealt_anew("LIFNR"))
    vendors = vendors.select(dealt_anew("LIFNR").alias("VENDOR"), "COPIES")
    return contacts.join(vendors, "VENDOR").filter(F.col("ROWS") * F.col("COPIES") > 1).select("LIFNR", "PARNR")


def unreachable_contacts(catalog: Catalog) -> DataFrame:
    """Contacts of vendors in scope whose address has no e-mail."""
    contacts = catalog.table("K").filter(F.expr(grouped.IN_SCOPE)).alias("K")
    vendors = catalog.table("V").filter(F.expr(grouped.IN_SCOPE)).alias("V")
    blank = catalog.table("A").filter(F.expr(missing("SMTP_ADDR", or_empty=True))).alias("A")
    reached = vendors.join(blank, F.col("V.ADRNR") == F.col("A.ADDRNUMBER"))
    return contacts.join(reached, F.col("K.LIFNR") == F.col("V.LIFNR")).select(
        "V.LIFNR", "V.ADRNR", "K.PRSNR", "A.SMTP_ADDR"
    )


def vendors_with_role_faults(catalog: Catalog) -> DataFrame:
    faults = [
        F.when(F.col(grouped.ROLE_COUNTERS[role]) == 0, f"Falta la clave {shown}")
        for role, shown in grouped.REQUIRED_ROLES.items()
    ]
    forbidden = grouped.FORBIDDEN_ROLE
    faults.append(
        F.when(F.col(grouped.ROLE_COUNTERS[forbidden]) > 0, f"Contiene la clave no permitida {forbidden}")
    )
    return grouped.role_faults(grouped.role_counts(catalog)).select(
        "LIFNR", F.concat_ws("; ", *faults).alias("MOTIVO_ERROR"), *grouped.ROLE_COUNTERS.values()
    )


def listed_references(catalog: Catalog) -> DataFrame:
    return (
        grouped.wrong_references(catalog)
        .join(grouped.vendor_names(catalog), "LIFNR")
        .select("LIFNR", "NAME1", "PARVW", "LIFN2")
    )
