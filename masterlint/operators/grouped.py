"""Checks that look at groups of rows instead of single rows.

Each function returns a one-row frame of counts. Groups are never gathered: a group
is described by sums that combine on the map side, and where a check compares
members of a group with each other the comparison is made by a second grouping on
the compared value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from masterlint.functions.conditions import either, is_in, missing, trimmed
from masterlint.functions.keys import short_code
from masterlint.sources.catalog import Catalog

# Material types in scope, and the vendor scope digit.
GOODS = is_in("MTART", ("ZMER", "ZSEC", "ZFRE"))
IN_SCOPE = "SCOPE_DIGIT = '1'"

# Partner roles that must exist, with the name shown for each, and the forbidden one.
REQUIRED_ROLES = {"BA": "DP(BA)", "LF": "PR(LF)", "RS": "EF(RS)", "ZE": "ZE"}
FORBIDDEN_ROLE = "ZO"
ROLE_COUNTERS = {"BA": "NUM_DP", "LF": "NUM_PR", "RS": "NUM_EF", "ZE": "NUM_ZE", "ZO": "NUM_ZO"}

# Roles that refer to the vendor itself, and the prefix the ZE reference needs.
SELF_ROLES = ("DP", "PR", "EF")
EXTERNAL_ROLE = "ZE"
EXTERNAL_PREFIX = "0C0"

ROLE = f"upper({trimmed('PARVW')})"
REFERENCE = trimmed("coalesce(LIFN2, '')")
WRONG_REFERENCE = either(
    f"{is_in(ROLE, SELF_ROLES)} AND {REFERENCE} <> {trimmed('LIFNR')}",
    f"{ROLE} = '{EXTERNAL_ROLE}' AND NOT startswith(upper({REFERENCE}), '{EXTERNAL_PREFIX}')",
)

BAD_GROUP_FORMAT = "length(BISMT) <> 6 OR BISMT RLIKE '[^0-9]'"
BAD_GROUP_SIZE = "(MATERIALS = 1 AND SWITCHES <> 0) OR (MATERIALS > 1 AND SWITCHES <> MATERIALS - 1)"


def _items_and_links(materials: DataFrame) -> DataFrame:
    """Each material twice: under its own short code, and under its substitute's."""
    codes = F.array(
        F.struct(F.col("MATNR5").alias("CODE"), F.lit(False).alias("LINK")),
        F.struct(F.col("SUBSTITUTE5").alias("CODE"), F.lit(True).alias("LINK")),
    )
    return materials.select("BISMT", "MATNR5", "SUBSTITUTE5", F.inline(codes))


def group_codes(catalog: Catalog) -> DataFrame:
    """Per grouping code and short material code: rows linking to it, and rows being it."""
    goods = catalog.table("M").filter(F.expr(GOODS))
    return (
        _items_and_links(goods)
        .groupBy("BISMT", "CODE")
        .agg(F.count_if("LINK").alias("LINKS"), F.count_if(~F.col("LINK")).alias("ITEMS"))
    )


def group_facts(catalog: Catalog) -> DataFrame:
    """Per grouping code: distinct materials, rows with a substitute, and strays.

    A stray is a row whose substitute is no material of the group.
    """
    known = F.col("CODE").isNotNull()
    return group_codes(catalog).groupBy("BISMT").agg(
        F.sum("LINKS").alias("MEMBERS"),
        F.count_if(known & (F.col("ITEMS") > 0)).alias("MATERIALS"),
        F.sum(F.when(known, F.col("LINKS")).otherwise(0)).alias("SWITCHES"),
        F.sum(F.when(known & (F.col("ITEMS") == 0), F.col("LINKS")).otherwise(0)).alias("STRAYS"),
        F.sum(F.when(known, 0).otherwise(F.col("ITEMS"))).alias("UNKNOWN_ITEMS"),
    )


def group_membership(catalog: Catalog) -> DataFrame:
    """Rows breaking the grouping-code rules (format, missing, group size, stray substitute)."""
    # a group with an unidentified material might contain any substitute
    strays = F.when(F.col("UNKNOWN_ITEMS") == 0, F.col("STRAYS")).otherwise(0)
    failing = (
        F.when(F.col("BISMT").isNull(), F.col("SWITCHES"))
        .when(F.expr(either(BAD_GROUP_FORMAT, BAD_GROUP_SIZE)), F.col("MEMBERS"))
        .otherwise(strays)
    )
    return group_facts(catalog).agg(F.sum(failing).alias("FAILED"))


def substitute_links(catalog: Catalog) -> DataFrame:
    """Pairs (material, substitute row) that disagree, and links to nowhere.

    A link that is wrong by itself fails once per row it reaches, at least once; any
    other link fails once if it reaches nothing, else once per reached row whose
    grouping code is known and different.
    """
    links = _items_and_links(catalog.table("M")).filter("CODE IS NOT NULL")
    wrong_itself = F.coalesce(F.left("MATNR5", F.lit(1)) != F.left("SUBSTITUTE5", F.lit(1)), F.lit(False)) | F.expr(
        missing("BISMT", or_empty=True)
    )
    by_group = links.groupBy("CODE", "BISMT").agg(
        F.count_if(F.col("LINK") & wrong_itself).alias("WRONG"),
        F.count_if(F.col("LINK") & ~wrong_itself).alias("LINKS"),
        F.count_if(~F.col("LINK")).alias("ITEMS"),
    )
    by_code = by_group.groupBy("CODE").agg(
        F.sum("WRONG").alias("WRONG"),
        F.sum("LINKS").alias("LINKS"),
        F.sum("ITEMS").alias("ITEMS"),
        F.sum(F.when(F.col("BISMT").isNotNull(), F.col("ITEMS")).otherwise(0)).alias("GROUPED_ITEMS"),
        F.sum(F.col("LINKS") * F.col("ITEMS")).alias("AGREEING"),
    )
    failing = F.col("WRONG") * F.greatest(F.col("ITEMS"), F.lit(1)) + F.when(
        F.col("ITEMS") == 0, F.col("LINKS")
    ).otherwise(F.col("LINKS") * F.col("GROUPED_ITEMS") - F.col("AGREEING"))
    return by_code.agg(F.sum(failing).alias("FAILED"))


# The column of the largest pack per unit.
PACK_COLUMNS = {"PAL": "umrez_pal", "CAP": "umrez_cap", "CS": "umrez_cj"}
PALLET_BY_LAYER = "umrez_pal IS NOT NULL AND try_mod(umrez_pal, umrez_cap) <> 0"
PALLET_BY_CASE = "umrez_pal IS NOT NULL AND umrez_cj IS NOT NULL AND try_mod(umrez_pal, umrez_cj) <> 0"
LAYER_BY_CASE = "umrez_cap IS NOT NULL AND umrez_cj IS NOT NULL AND try_mod(umrez_cap, umrez_cj) <> 0"
PALLET_INDIVISIBLE = either(PALLET_BY_LAYER, PALLET_BY_CASE)
LAYER_INDIVISIBLE = either(PALLET_BY_LAYER, LAYER_BY_CASE)


def pack_sizes(catalog: Catalog) -> DataFrame:
    """Per short material code, the largest pallet, layer and case of goods in scope.

    The pivot over the three units is written as one conditional maximum each, so it
    needs a single grouping, and packs are reduced to one row per material before the
    scope is checked.
    """
    units = catalog.table("R").filter(F.expr(is_in("MEINH", PACK_COLUMNS)))
    goods = catalog.table("M").filter(F.expr(GOODS)).select("MATNR").distinct()
    packs = units.groupBy("MATNR").agg(
        *[F.max(F.when(F.col("MEINH") == unit, F.col("UMREZ"))).alias(name) for unit, name in PACK_COLUMNS.items()]
    )
    return (
        packs.join(goods, "MATNR", "left_semi")
        .groupBy(short_code("MATNR").alias("MATNR"))
        .agg(*[F.max(name).alias(name) for name in PACK_COLUMNS.values()])
    )


def pack_divisibility(catalog: Catalog) -> DataFrame:
    return pack_sizes(catalog).agg(
        F.count_if(F.expr(PALLET_INDIVISIBLE)).alias("PALLET"), F.count_if(F.expr(LAYER_INDIVISIBLE)).alias("LAYER")
    )


def role_counts(catalog: Catalog) -> DataFrame:
    """Per vendor in scope, how often each partner role occurs."""
    role = F.expr(f"coalesce({ROLE}, '')")
    partners = catalog.table("W").filter(F.expr(IN_SCOPE))
    return partners.groupBy("LIFNR").agg(
        *[F.count_if(role == code).alias(name) for code, name in ROLE_COUNTERS.items()]
    )


def role_faults(counted: DataFrame) -> DataFrame:
    """Vendors lacking a required role or having the forbidden one."""
    faults = [f"{ROLE_COUNTERS[code]} = 0" for code in REQUIRED_ROLES]
    return counted.filter(F.expr(either(*faults, f"{ROLE_COUNTERS[FORBIDDEN_ROLE]} > 0")))


def required_roles(catalog: Catalog) -> DataFrame:
    return role_faults(role_counts(catalog)).agg(F.count(F.lit(1)).alias("FAILED"))


def wrong_references(catalog: Catalog) -> DataFrame:
    """Distinct partner entries in scope whose reference does not fit their role."""
    partners = catalog.table("W").filter(F.expr(IN_SCOPE)).filter(F.expr(WRONG_REFERENCE))
    return partners.select("LIFNR", "PARVW", "LIFN2").distinct()


def vendor_names(catalog: Catalog) -> DataFrame:
    return catalog.table("V").filter(F.expr(IN_SCOPE)).select("LIFNR", "NAME1").distinct()


def partner_references(catalog: Catalog) -> DataFrame:
    """Distinct (vendor, name, role, reference): names times entries, per vendor."""
    entries = wrong_references(catalog).groupBy("LIFNR").agg(F.count(F.lit(1)).alias("ENTRIES"))
    names = vendor_names(catalog).groupBy("LIFNR").agg(F.count(F.lit(1)).alias("NAMES"))
    return entries.join(names, "LIFNR").agg(F.sum(F.col("ENTRIES") * F.col("NAMES")).alias("FAILED"))


def contact_mail(catalog: Catalog) -> DataFrame:
    """Joined rows contact - vendor - address whose e-mail is missing."""
    blank = (
        catalog.table("A")
        .filter(F.expr(missing("SMTP_ADDR", or_empty=True)))
        .groupBy(F.col("ADDRNUMBER").alias("ADRNR"))
        .agg(F.count(F.lit(1)).alias("BLANKS"))
    )
    vendors = (
        catalog.table("V")
        .filter(F.expr(IN_SCOPE))
        .groupBy("LIFNR", "ADRNR")
        .agg(F.count(F.lit(1)).alias("VENDORS"))
        .join(blank, "ADRNR")
        .groupBy("LIFNR")
        .agg(F.sum(F.col("VENDORS") * F.col("BLANKS")).alias("VENDOR_BLANKS"))
    )
    contacts = catalog.table("K").filter(F.expr(IN_SCOPE)).groupBy("LIFNR").agg(F.count(F.lit(1)).alias("CONTACTS"))
    return contacts.join(vendors, "LIFNR").agg(F.sum(F.col("CONTACTS") * F.col("VENDOR_BLANKS")).alias("FAILED"))


def case_weight(unit: str, units: str) -> str:
    """Weight of so many units, rounded to thousandths: exact for weights of up to 17 digits before the point and
    9 behind it, and for numbers of up to 11 digits. Wider types would lose places of the product."""
    return f"round(cast({unit} AS decimal(26,9)) * cast({units} AS decimal(11,0)), 3)"


def equal_quantities(catalog: Catalog) -> DataFrame:
    """Pairs (material, unit) whose quantities agree, for cases and for KG units.

    CASES: unit weight times UMREZ, in thousandths, is the case weight. RATIOS: UMREN / UMREZ is the net weight.
    Either way the comparison becomes an equality of one value on each side, so equal pairs come from an
    equi-join of counts per value, and differing pairs never have to be built. If unit weights have three places,
    the only one that fits a case is an exact quotient. Of finer ones a small range fits: their joint value is
    the thousandth they lie in, of which a case's range touches two at most, and what shares one is compared.
    The values travel as texts: a join on doubles would normalise its key and shuffle the counts once more.
    """
    thousandths = "cast(round(BRGEW, 3) * 1000 AS bigint)"
    ratio = "cast({} + 0.0D AS string)".format  # without a negative zero
    goods = catalog.table("M").filter(F.expr(f"{GOODS} AND MATNR IS NOT NULL"))
    fine = goods.schema["BRGEW"].dataType.scale > 3
    weight = "cast(floor(cast(BRGEW AS decimal(26,9)) * 1000) AS bigint)" if fine else thousandths
    asked = goods.selectExpr(
        "MATNR",
        f"""inline(array(
            named_struct('KIND', 'CASES', 'VALUE', cast(if(MEINS = 'ST', {weight}, NULL) AS string), 'WEIGHT', BRGEW),
            named_struct('KIND', 'RATIOS', 'VALUE', {ratio('cast(NTGEW AS double)')}, 'WEIGHT', NULL)))""",
    )
    units = catalog.table("R").filter("MATNR IS NOT NULL AND UMREZ <> 0 AND MEINH IN ('CS', 'KG')")
    if fine:
        # rounded products lie from half a thousandth below the case weight to half a thousandth above
        doubled = [f"(2 * {thousandths} {sign} 1) * if(UMREZ < 0, -1, 1)" for sign in "-+"]
        ends = [f"({twice} - pmod({twice}, 2 * abs(UMREZ))) div (2 * abs(UMREZ))" for twice in doubled]
        values = f"sequence(least({', '.join(ends)}), greatest({', '.join(ends)}))"
        cases = f"transform({values}, v -> cast(v AS string))"
    else:
        cases = f"array(cast(if(try_mod({thousandths}, UMREZ) = 0, {thousandths} div UMREZ, NULL) AS string))"
    offered = units.selectExpr(
        "MATNR",
        "if(MEINH = 'CS', 'CASES', 'RATIOS') AS KIND",
        f"explode(if(MEINH = 'CS', if(BRGEW IS NULL, NULL, {cases}), array({ratio('try_divide(UMREN, UMREZ)')}))) AS VALUE",
        "if(MEINH = 'CS', UMREZ, NULL) AS UNITS",
        "if(MEINH = 'CS', round(BRGEW, 3), NULL) AS CASE_WEIGHT",
    )
    if fine:
        sides = _copies(asked, "ASKED", "WEIGHT"), _copies(offered, "OFFERED", "UNITS", "CASE_WEIGHT")
        agree = f"KIND = 'RATIOS' OR {case_weight('WEIGHT', 'UNITS')} = CASE_WEIGHT"
    else:
        sides, agree = (_copies(asked, "ASKED"), _copies(offered, "OFFERED")), "TRUE"
    pairs = sides[0].join(sides[1], ["MATNR", "KIND", "VALUE"]).filter(agree)
    return pairs.agg(
        *[F.expr(f"sum(CASE WHEN KIND = '{kind}' THEN ASKED * OFFERED END) AS {kind}") for kind in ("CASES", "RATIOS")]
    )


def _copies(values: DataFrame, name: str, *exact: str) -> DataFrame:
    """Rows per material, kind, value and what else decides."""
    return values.filter("VALUE IS NOT NULL").groupBy("MATNR", "KIND", "VALUE", *exact).agg(F.count(F.lit(1)).alias(name))
