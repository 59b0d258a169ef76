import pytest
from pyspark.sql import functions as F

from peakwise.functions.chem import formula_mass
from peakwise.functions.rounding import adduct_mz, rounded_mass_key, truncated_mass_key
from peakwise.operators import masses, matching


def keys(spark, function, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    return [r[0] for r in df.select(function(F.col("x"))).collect()]


def test_truncated_key(spark):
    values = [478.1479, 478.1, 478.0, 0.29, 1000.9999999, 100.0010000001]
    cut = []
    for v in values:
        whole, fraction = str(v).split(".")
        cut.append(int(whole) * 1000 + int(fraction[:3].ljust(3, "0")))
    assert keys(spark, truncated_mass_key, values) == cut
    assert cut[:3] == [478147, 478100, 478000]


def test_rounded_key(spark):
    assert keys(spark, rounded_mass_key, [478.1479, 478.1475, 478.0, None]) == [
        478148,
        478148,
        478000,
        None,
    ]


def test_adducts(spark):
    got = keys(spark, lambda c: adduct_mz(c, "+"), [100.0]) + keys(
        spark, lambda c: adduct_mz(c, "-"), [100.0]
    )
    assert got == [101.007276, 98.992724]
    df = spark.createDataFrame([(100.0, "+"), (100.0, "anything")], "m double, mode string")
    assert [r[0] for r in df.select(adduct_mz(F.col("m"), F.col("mode"))).collect()] == got


@pytest.mark.parametrize(
    "formula, mass",
    [
        ("C2H6O", 46.0418648),
        ("CH4", 16.0313001),
        ("NaCl", 57.9586219),
        ("C6H12O6", 180.0633881),
        ("C5H14NO+", 104.1075391),
        ("Xx2", None),
        ("not a formula", None),
        ("", None),
        (None, None),
    ],
)
def test_formula_mass(spark, formula, mass):
    df = spark.createDataFrame([(formula,)], "f string")
    got = df.select(formula_mass(F.col("f"))).first()[0]
    assert got is None if mass is None else got == pytest.approx(mass, abs=1e-6)


def test_molecules_without_a_mass_never_match(spark):
    library = masses.with_library_key(
        spark.createDataFrame([(7, "a", 100.0), (8, "b", None)], "library_id long, smile string, exact_mass double"), "+"
    )
    assert {r.smile: r.mass_key for r in library.collect()} == {"a": 101007, "b": None}
    queries = spark.createDataFrame([(1, 101007), (2, None), (3, 5)], "spectrum_id int, mass_key long")
    matched = matching.match_candidates(queries, library).collect()
    assert [(r.spectrum_id, r.n_candidates, r.first_candidate) for r in matched] == [(1, 1, 7)]
    missing = matching.unmatched_queries(queries, library).collect()
    assert sorted(r.spectrum_id for r in missing) == [2, 3]


def test_measured_key_modes(spark):
    df = spark.createDataFrame([(478.1479,)], "precursor double")
    assert masses.with_measured_mass_key(df).first().mass_key == 478147
    assert masses.with_measured_mass_key(df, "round").first().mass_key == 478148
    with pytest.raises(ValueError):
        masses.with_measured_mass_key(df, "other")


def test_attach_properties_keeps_unknown_structures(spark):
    spectra = spark.createDataFrame([("C",), ("N",)], "smile string")
    molecules = spark.createDataFrame(
        [("C", "ABCDEFGHIJKLMN-OPQ", 16.0)], "smile string, inchikey string, exact_mass double"
    )
    got = {tuple(r) for r in masses.attach_properties(spectra, molecules, "exact_mass").collect()}
    assert got == {("C", "ABCDEFGHIJKLMN", 16.0), ("N", None, None)}


def test_a_join_of_counted_tasks_gives_the_same_properties(spark):
    smile = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(
        F.concat(F.lit("C"), F.col("id") % 40)
    )
    spectra = spark.range(3000).select(
        smile.alias("smile"), F.struct(F.lit("f"), F.col("id")).alias("ordinal"), "id"
    )
    names = [("hot",), *[(f"C{i}",) for i in range(30)]]
    molecules = spark.createDataFrame(names, "smile string").select(
        "smile", F.rpad("smile", 20, "x").alias("inchikey"), F.length("smile").alias("n")
    )
    plain = masses.attach_properties(spectra, molecules, "n")
    dealt = masses.attach_properties(spectra, molecules.hint("merge"), "n", tasks=50)
    assert dealt.columns == plain.columns
    assert dealt.rdd.getNumPartitions() == 50
    assert sorted(dealt.collect(), key=lambda r: r.id) == sorted(plain.collect(), key=lambda r: r.id)
    places = dealt.where("smile = 'hot'").select(F.spark_partition_id()).distinct().count()
    assert places > 2
