"""Parsing of printed values, units and names, as column expressions.

Everything here stays in the JVM.  Null input gives null output unless stated.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Power of ten that takes each unit to nM.
UNIT_POWERS = {"pM": -3, "nM": 0, "µM": 3, "mM": 6, "M": 9}
# Tokens that stand for a missing value.
MISSING_TOKENS = ("", "nd", "n.d.", "na", "n/a", "-", "–", "—")
# Canonical spelling of relations.
RELATIONS = {"≤": "<=", "≥": ">=", "≈": "~"}
# Fixed patterns: a number, a printed value, a unit inside text.
NUMBER = r"(?:[0-9]{1,3}(?:,[0-9]{3})+|[0-9]+)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?"
VALUE = rf"(?U)^\s*(<=|>=|<|>|=|≤|≥|~|≈)?\s*({NUMBER})(?:\s*±\s*({NUMBER}))?\s*([pnmµμu]?M)?\s*$"
UNIT = r"(?<![A-Za-z])([pnmµμu]?M)(?![A-Za-z])"
KIND_PATTERNS = {
    "Ki": r"(?iu)(?<![A-Za-z])K\s*i(?:\s*app|,\s*app)?(?![A-Za-z])",
    "IC50": r"(?iu)(?<![A-Za-z])IC\s*50(?!\d)",
    "Kd": r"(?iu)(?<![A-Za-z])K\s*d(?![A-Za-z])",
}
FORMULA_CALCULATED = r"(?i)(?:calcd\.?|calculated|calc\.)\s*(?:for|\.)?\s*(?:\[?M\s*[+-]\s*(?:H|Na|K)\]?\+?\s*)?[:,]?\s*\(?((?:C\d*H\d*)(?:[A-Z][a-z]?\d*)*)"
FORMULA_BARE = r"\b(C\d{1,3}H\d{1,3}(?:[A-Z][a-z]?\d{0,3}){0,8})\b"
# Furthest printed magnitude that counts as a number.
MOST_MAGNITUDE = 100


def canonical_relation(column: Column) -> Column:
    """``≤ ≥ ≈`` as ``<= >= ~``; null and '' are ``=``."""
    out = F.coalesce(F.nullif(column, F.lit("")), F.lit("="))
    for sign, plain in RELATIONS.items():
        out = F.when(column == sign, plain).otherwise(out)
    return out


def clean_relation(column: Column) -> Column:
    """A database relation without quotes; null is ``=``."""
    return F.regexp_replace(F.coalesce(column, F.lit("=")), "'", "")


def _shifted(number: Column, power: Column) -> Column:
    """``number`` (text) times ten to ``power`` as double, rounded once: the exponent is moved in the text."""
    plain = F.regexp_replace(number, ",", "")
    mantissa = F.regexp_extract(plain, r"^([0-9.]+)", 1)
    exponent = F.coalesce(F.nullif(F.regexp_extract(plain, r"[eE]([+-]?[0-9]+)$", 1), F.lit("")).try_cast("int"), F.lit(0))
    return F.concat(mantissa, F.lit("e"), (exponent + power).cast("string")).try_cast("double")


def _magnitude(number: Column) -> Column:
    """Place of the leading digit of a number text (0 for 1 to 9)."""
    plain = F.regexp_replace(number, ",", "")
    whole = F.regexp_replace(F.regexp_extract(plain, r"^([0-9]+)", 1), "^0+", "")
    exponent = F.coalesce(F.nullif(F.regexp_extract(plain, r"[eE]([+-]?[0-9]+)$", 1), F.lit("")).try_cast("double"), F.lit(0.0))
    fraction = F.regexp_extract(plain, r"\.([0-9]+)", 1)
    zeros = F.length(F.regexp_extract(fraction, "^(0*)", 1))
    place = F.when(F.length(whole) > 0, F.length(whole) - 1).when(F.length(fraction) > zeros, -zeros - 1).otherwise(0)
    return exponent + place


def parse_value(raw: Column, unit: Column) -> Column:
    """Struct ``value, relation, unit, normalized_value_nm, uncertainty, flags`` of a printed cell.

    The cell's own unit beats ``unit``.  No sign, leading dot, range or alternative is a
    value.  The uncertainty stays in the reported unit.  A null cell is a missing value.
    """
    text = F.coalesce(raw, F.lit(""))
    candidate = F.regexp_replace(F.translate(text, "−μ", "-µ"), r"(?U)(?<=[0-9])[\s  ]+(?=[0-9]{3}(?:[^0-9]|$))", "")
    missing = F.lower(F.regexp_replace(text, r"(?U)^\s+|\s+$", "")).isin(*MISSING_TOKENS)
    # the pattern runs once: its groups come as one array, and the lambda binds that array
    groups = F.split(F.regexp_replace(candidate, VALUE, "$1\u0001$2\u0001$3\u0001$4\u0001"), "\u0001")

    def read(g: Column) -> Column:
        part = lambda n: F.when(F.size(g) > 1, F.nullif(F.get(g, F.lit(n)), F.lit("")))
        number, spread = part(1), part(2)
        good = number.isNotNull() & (_magnitude(number) <= MOST_MAGNITUDE)
        own = F.translate(part(3), "uμ", "µµ")
        final = F.coalesce(F.when(number.isNotNull(), own), unit)
        power = F.lit(None).cast("int")
        for name, n in UNIT_POWERS.items():
            power = F.when(final == name, n).otherwise(power)
        relation = F.when(good, canonical_relation(part(0)))
        flags = F.array_compact(
            F.array(
                F.when(own.isNotNull() & unit.isNotNull() & (unit != "") & (own != unit), "cell_unit_overrides_header"),
                F.when(number.isNull() & missing, "missing_value"),
                F.when((number.isNull() & ~missing) | (number.isNotNull() & ~good), "unparsed_value"),
                F.when(good & power.isNull(), "missing_unit"),
                F.when(good & (relation != "="), "qualified_value"),
            )
        )
        return F.struct(
            F.when(good, _shifted(number, F.lit(0))).alias("value"),
            relation.alias("relation"),
            final.alias("unit"),
            F.when(good, _shifted(number, power)).alias("normalized_value_nm"),
            F.when(good, _shifted(spread, F.lit(0))).alias("uncertainty"),
            flags.alias("flags"),
        )

    return F.get(F.transform(F.array(groups), read), F.lit(0))


def unit_in(text: Column) -> Column:
    """The one unit a header or caption names, else null; SEM and SD are not units."""
    plain = F.regexp_replace(text, r"S\.\s?E\.\s?M\.?|\bSEM\b|S\.\s?D\.?", "")
    units = F.array_distinct(F.transform(F.regexp_extract_all(plain, F.lit(UNIT), 1), lambda u: F.translate(u, "uμ", "µµ")))
    return F.when(F.size(units) == 1, F.get(units, F.lit(0)))


def measurement_kind(text: Column) -> Column:
    """``Ki``, ``IC50`` or ``Kd`` if exactly one is named, else null."""
    plain = F.regexp_replace(text, r"[_{}]", "")
    found = F.array_compact(F.array(*[F.when(plain.rlike(p), k) for k, p in KIND_PATTERNS.items()]))
    return F.when(F.size(found) == 1, F.get(found, F.lit(0)))


def normalize_unit(value: Column, unit: Column) -> Column:
    """``value`` in nM; null for an unknown unit."""
    factor = F.lit(None).cast("double")
    for name, n in UNIT_POWERS.items():
        factor = F.when(unit == name, F.lit(10.0**n)).otherwise(factor)
    return value * factor


def repair_unit(unit: Column) -> Column:
    """Off-list spellings as one of the known units: Greek mu, leading u, lower case; else null."""
    plain = F.translate(F.trim(unit), "μ", "µ")
    plain = F.regexp_replace(plain, "^u(?=M$)", "µ")
    out = F.when(plain.isin(*UNIT_POWERS), plain)
    for name in UNIT_POWERS:
        if name != "M":
            out = F.coalesce(out, F.when(F.lower(plain) == name.lower(), F.lit(name)))
    return F.coalesce(out, F.when(F.lower(plain) == "um", F.lit("µM")))


def name_candidates(label: Column) -> Column:
    """Lower-case names a label may carry: the label without bracketed notes, then each parenthesis.

    A name has 5 to 41 letters, hyphens, apostrophes or blanks, three lower-case ones in a row, and no trailing number.
    """
    plain = F.trim(F.regexp_replace(F.coalesce(label, F.lit("")), r"\s*\[[^\]]*\]", ""))
    inner = F.regexp_extract_all(plain, F.lit(r"\(([^()]+)\)"), 1)
    tidy = F.transform(
        F.concat(F.array(plain), inner),
        lambda x: F.trim(F.regexp_replace(F.trim(F.regexp_replace(x, r"\s*\([^()]*\)", "")), r"\s+\d+[a-z]?$", "")),
    )
    return F.transform(F.filter(tidy, lambda x: x.rlike(r"^[A-Za-z][A-Za-z\-' ]{4,40}$") & x.rlike("[a-z]{3}")), F.lower)


def alternate_name(label: Column) -> Column:
    """A label without parentheses, brackets, daggers and trailing number, lower case."""
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(label, r"\([^)]*\)|\[[^\]]*\]|[*†‡]", ""), r"\s+\d+$", "")))


def clean_label(label: Column) -> Column:
    """A label without bracketed notes and trailing footnote digits."""
    return F.trim(F.regexp_replace(F.trim(F.regexp_replace(label, r"\s*\[[^\]]*\]", "")), r"\s+\d+$", ""))


def figure_label(label: Column) -> Column:
    """A label as drawn in figures: no 'compound', notes, blanks or long dashes; primes as apostrophes."""
    plain = F.regexp_replace(F.trim(label), r"(?i)^(?:compound|cpd\.?|comp\.?)\s*", "")
    plain = F.regexp_replace(plain, r"\s*\[[^\]]*\]|\s*\([^)]*\)", "")
    return F.translate(F.regexp_replace(plain, r"(?U)[\s‐–]", ""), "′", "'")


def grounding_form(text: Column) -> Column:
    """Text without blanks and commas, one micro sign, one minus: for substring tests."""
    return F.translate(F.regexp_replace(text, r"(?U)[\s,]", ""), "μ−", "µ-")


def locate_form(text: Column) -> Column:
    """Cell text for locating: also without daggers and stars, dashes as minus, lower case."""
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)[\s,*†‡§#]", "")
    return F.lower(F.translate(plain, "μ−–", "µ--"))


def is_grounded(value_text: Column, table_text: Column) -> Column:
    """Whether the printed value occurs in the table's text; null if either is."""
    return F.contains(grounding_form(table_text), grounding_form(value_text))


def header_family_conflict(target: Column, header: Column) -> Column:
    """Whether the header names the target's family with other numbers only (``CA9`` under ``CA2``)."""
    family = F.regexp_extract(target, r"^([A-Z]+)-?(\d+)$", 1)
    number = F.regexp_extract(target, r"^([A-Z]+)-?(\d+)$", 2)
    named = F.regexp_extract_all(header, F.concat(F.lit("(?i)(?<![A-Za-z])"), family, F.lit(r"\s?-?(\d+)")), F.lit(1))
    return F.coalesce((family != "") & (F.size(named) > 0) & ~F.array_contains(named, number), F.lit(False))


def number_set(text: Column) -> Column:
    """Distinct numbers in a text, decimal commas as points."""
    found = F.regexp_extract_all(F.translate(text, ",", "."), F.lit(r"[0-9]+(?:\.[0-9]+)?"), 0)
    return F.array_distinct(F.filter(F.transform(found, lambda x: x.try_cast("double")), lambda x: x.isNotNull()))


def formula_counts(formula: Column) -> Column:
    """Element counts of a sum formula as a map; repeated elements add up."""
    atoms = F.regexp_extract_all(formula, F.lit(r"([A-Z][a-z]?)(\d*)"), 0)
    pairs = F.transform(
        atoms,
        lambda a: F.struct(
            F.regexp_extract(a, r"^([A-Z][a-z]?)", 1).alias("e"),
            F.coalesce(F.nullif(F.regexp_extract(a, r"(\d+)$", 1), F.lit("")).cast("int"), F.lit(1)).alias("n"),
        ),
    )
    elements = F.array_distinct(F.transform(pairs, lambda p: p["e"]))
    totals = F.transform(elements, lambda e: F.aggregate(F.filter(pairs, lambda p: p["e"] == e), F.lit(0), lambda s, p: s + p["n"]))
    return F.map_from_arrays(elements, totals)


def _count(counts: Column, element: str) -> Column:
    return F.coalesce(F.try_element_at(counts, F.lit(element)), F.lit(0))


def formula_matches(formula: Column, stated: Column) -> Column:
    """Whether a stated formula is the molecule's or one of its ions: M, M+H, M-H, M+Na, M+K, M-H+Na."""
    own = formula_counts(formula)
    want = formula_counts(F.regexp_replace(stated, r"(?<=[A-Z])(?:79|81)(?=Br)", ""))
    same = F.lit(False)
    for hydrogen, extra in ((0, None), (1, None), (-1, None), (0, "Na"), (0, "K"), (-1, "Na")):
        moved = {"H": hydrogen} | ({extra: 1} if extra else {})
        names = F.array_distinct(F.concat(F.map_keys(own), F.map_keys(want), F.array(*map(F.lit, moved))))

        def agreement(moved: dict[str, int] = moved):
            def agrees(e: Column) -> Column:
                change = F.lit(0)
                for k, v in moved.items():
                    change = F.when(e == k, v).otherwise(change)
                return F.coalesce(F.try_element_at(own, e), F.lit(0)) + change == F.coalesce(F.try_element_at(want, e), F.lit(0))

            return agrees

        same = same | F.forall(names, agreement())
    return F.coalesce((_count(want, "C") > 0) & same, F.lit(False))


def formula_mentions(text: Column, most: int = 1500) -> Column:
    """Formulas stated in the first ``most`` characters: after 'calcd for', else bare ones."""
    window = F.substring(text, 1, most)
    calculated = F.regexp_extract_all(window, F.lit(FORMULA_CALCULATED), 1)
    return F.when(F.size(calculated) > 0, calculated).otherwise(F.regexp_extract_all(window, F.lit(FORMULA_BARE), 1))
