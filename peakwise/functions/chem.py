"""Exact mass from a molecular formula."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mass in Da of the most abundant isotope of each element.
ELEMENT_MASSES = {
    "H": 1.00782503223,
    "Li": 7.0160034366,
    "Be": 9.012183065,
    "B": 11.00930536,
    "C": 12.0,
    "N": 14.00307400443,
    "O": 15.99491461957,
    "F": 18.99840316273,
    "Na": 22.989769282,
    "Mg": 23.985041697,
    "Al": 26.98153853,
    "Si": 27.97692653465,
    "P": 30.97376199842,
    "S": 31.9720711744,
    "Cl": 34.968852682,
    "K": 38.9637064864,
    "Ca": 39.962590863,
    "Ti": 47.94794198,
    "V": 50.94395704,
    "Cr": 51.94050623,
    "Mn": 54.93804391,
    "Fe": 55.93493633,
    "Co": 58.93319429,
    "Ni": 57.93534241,
    "Cu": 62.92959772,
    "Zn": 63.92914201,
    "Ge": 73.921177761,
    "As": 74.92159457,
    "Se": 79.9165218,
    "Br": 78.9183376,
    "Ag": 106.9050916,
    "Sn": 119.90220163,
    "Sb": 120.903812,
    "Te": 129.906222748,
    "I": 126.9044719,
    "Pt": 194.9647917,
    "Au": 196.96656879,
    "Hg": 201.9706434,
    "Pb": 207.9766525,
    "Bi": 208.9803991,
}

_TERM = "([A-Z][a-z]?)([0-9]*)"


def formula_mass(formula: Column) -> Column:
    """Exact mass of a formula such as ``C2H6O``; a trailing charge is ignored.

    Null when the text is not a plain formula or names an element without a known mass.
    """
    masses = F.create_map(*[F.lit(x) for item in ELEMENT_MASSES.items() for x in item])
    terms = F.regexp_extract_all(formula, F.lit(_TERM), F.lit(0))

    def term_mass(term: Column) -> Column:
        count = F.regexp_extract(term, "([0-9]+)$", 1).try_cast("int")
        symbol = F.regexp_extract(term, "^([A-Z][a-z]?)", 1)
        return F.try_element_at(masses, symbol) * F.coalesce(count, F.lit(1))

    total = F.aggregate(terms, F.lit(0.0), lambda acc, term: acc + term_mass(term))
    return F.when(formula.rlike(r"^([A-Z][a-z]?[0-9]*)+([+-][0-9]*)?$"), total)
