"""Columns derived from structure text (line notation), without a UDF."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# One atom of the line notation, and the element symbol inside it.
ATOM_TOKEN = r"\[[^\]]+\]|Br|Cl|[BCNOPSFI]|[bcnops]|\*"
ELEMENT = r"^\[?[0-9]*([A-Z][a-z]?|[a-z]{1,2}|\*)"

# Standard atomic weights of the halogens.
HALOGEN_MASS = {"F": 18.998, "Cl": 35.453, "Br": 79.904, "I": 126.904}

# Functional groups and the text pattern that stands for each.
GROUP_PATTERNS = {
    "aldehyde": r"C=O$|^O=C[^(]",
    "ketone": r"CC\(=O\)C",
    "carboxylic_ester": r"C\(=O\)O[Cc]",
    "carboxylic_acid": r"C\(=O\)O(?:$|\.)|OC\(=O\)",
    "ether": r"[Cc]O[Cc]",
    "thioether": r"[Cc]S[Cc]",
    "lactone": r"O=C[0-9][^.]*O[0-9]",
    "lactam": r"O=C[0-9][^.]*N[0-9]",
    "alcohol": r"CO$|CO\.|^OC[^(]",
    "phenol": r"Oc1|c\(O\)",
    "amine": r"[Cc]N|NC|Nc",
    "arylhalide": r"c1?(?:Br|Cl|F|I)|c\((?:Br|Cl|F|I)\)",
    "alkylhalide": r"C(?:Br|Cl|F|I)|C\((?:Br|Cl|F|I)\)",
    "urea": r"NC\(=O\)N",
    "thiourea": r"NC\(=S\)N",
    "sulfonamide": r"S\(=O\)\(=O\)N",
}


def atom_tokens(text: Column) -> Column:
    """The atoms of a structure text, in order."""
    return F.regexp_extract_all(text, F.lit(ATOM_TOKEN), 0)


def element_of(token: Column) -> Column:
    """The element symbol of one atom token."""
    return F.regexp_extract(token, ELEMENT, 1)


def heavy_atom_count(text: Column) -> Column:
    """Atoms other than hydrogen."""
    return F.size(F.filter(atom_tokens(text), lambda a: element_of(a) != "H"))


# How a ring bond is numbered, outside of atoms in brackets.
RING_NUMBER = r"%[0-9]{2}|%\([0-9]+\)|[0-9]"
BRACKET_ATOM = r"\[[^\]]*\]"


def _ring_numbers(part: Column) -> Column:
    found = F.regexp_extract_all(F.regexp_replace(part, BRACKET_ATOM, ""), F.lit(RING_NUMBER), 0)
    return F.transform(found, lambda t: F.regexp_replace(t, "[%()]", "").try_cast("bigint"))


def _tied(parts: Column) -> Column:
    """Parts joined by an open ring bond as one, in the order of their first parts."""
    uses = F.flatten(
        F.transform(
            parts, lambda part, at: F.transform(_ring_numbers(part), lambda k: F.struct(k.alias("ring"), at.alias("at")))
        )
    )
    # a part's label is the first part it is tied to so far
    start = F.struct(
        F.array().cast("array<struct<ring:bigint,at:int>>").alias("open"),
        F.transform(parts, lambda _, at: at).alias("label"),
    )

    def step(state: Column, use: Column) -> Column:
        other = F.get(F.filter(state["open"], lambda o: o["ring"] == use["ring"]), 0)
        mine, theirs = F.get(state["label"], use["at"]), F.get(state["label"], other["at"])
        joined = F.transform(
            state["label"], lambda x: F.when(x == F.greatest(mine, theirs), F.least(mine, theirs)).otherwise(x)
        )
        closed = F.struct(F.filter(state["open"], lambda o: o["ring"] != use["ring"]).alias("open"), joined.alias("label"))
        opened = F.struct(F.array_append(state["open"], use).alias("open"), state["label"].alias("label"))
        return F.when(other.isNotNull(), closed).otherwise(opened)

    labels = F.array(F.aggregate(uses, start, step, lambda state: state["label"]))
    together = F.transform(
        labels,
        lambda label: F.transform(
            F.array_distinct(label),
            lambda head: F.concat_ws(".", F.filter(parts, lambda _, at: F.get(label, at) == head)),
        ),
    )
    return F.get(together, 0)


def fragments(text: Column) -> Column:
    """The fragments of a structure text: its parts between dots, in order.

    Parts between which a ring bond is open, as in ``C1.C1``, are one fragment; its text
    is that of its parts, joined by dots. A number that is used again after its bond was
    closed is a new bond, and one that is never closed ties nothing.
    """
    parts = F.split(text, r"\.")
    across = F.regexp_replace(text, BRACKET_ATOM, "").rlike(r"(?s)[0-9].*\..*[0-9]")
    return F.when(across, _tied(parts)).otherwise(parts)


def largest_fragment(text: Column) -> Column:
    """The fragment with most heavy atoms; the first one on a tie. See :func:`fragments`."""
    sized = F.transform(
        fragments(text),
        lambda frag, pos: F.struct(
            (-heavy_atom_count(frag)).alias("neg_atoms"), pos.alias("pos"), frag.alias("frag")
        ),
    )
    return F.array_min(sized)["frag"]


def _halogens(text: Column) -> Column:
    elements = F.transform(atom_tokens(text), element_of)
    return F.filter(elements, lambda e: e.isin(*HALOGEN_MASS))


def halogen_count(text: Column) -> Column:
    """Number of halogen atoms; null text gives null."""
    return F.when(text.isNotNull(), F.size(_halogens(text)))


def halogen_mass(text: Column) -> Column:
    """Summed mass of the halogen atoms; null text gives null."""

    def mass(element: Column) -> Column:
        value = F.lit(0.0)
        for symbol, weight in HALOGEN_MASS.items():
            value = F.when(element == symbol, weight).otherwise(value)
        return value

    return F.aggregate(_halogens(text), F.lit(0.0), lambda total, e: total + mass(e))


def guarded_ratio(part: Column, whole: Column) -> Column:
    """``part / whole``, null when the whole is 0 or either is missing."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def rule_of_five(hba: Column, hbd: Column, weight: Column, logp: Column) -> Column:
    """1 when all four limits hold, 0 when one is broken, null if an input is missing."""
    known = hba.isNotNull() & hbd.isNotNull() & weight.isNotNull() & logp.isNotNull()
    # The limits of the rule.
    holds = (hba <= 10) & (hbd <= 5) & (weight <= 500) & (logp <= 5)
    return F.when(known, holds.cast("int"))


def pattern_columns(
    text: Column, patterns: Mapping[str, str] = GROUP_PATTERNS, *, counts: bool = True, prefix: str = "fr_"
) -> dict[str, Column]:
    """One column per named pattern: number of matches, or 0/1 for presence.

    All columns are computed in the same scan. Null text gives null.
    """
    if not patterns:
        raise ValueError("the pattern table is empty")
    columns = {}
    for name, regex in patterns.items():
        if regex != regex.strip():
            raise ValueError(f"pattern {name!r} starts or ends with white space")
        found = F.regexp_count(text, F.lit(regex))
        columns[prefix + name] = found if counts else (found > 0).cast("int")
    return columns
