import numpy as np
from pyspark.sql import functions as F

from peakwise.operators import peak_rows, pooling
from peakwise.plans import identify
from tests.test_peaks import brute_bins, brute_clean, random_spectra

def test_first_rows(spark):
    df = spark.createDataFrame(
        [("k2", "A", 2.0, 5), ("k1", "B", 1.0, 7), ("k1", "C", 3.0, 6), (None, "D", 1.0, 1), ("k3", "C", 9.0, 8)],
        "structure_key string, smile string, precursor double, ordinal long",
    )
    first = pooling.first_per_key(df, "structure_key", ("smile", "precursor"))
    assert {tuple(r) for r in first.collect()} == {("k2", "A", 2.0), ("k1", "C", 3.0), ("k3", "C", 9.0)}
    # k3 repeats the structure string of the smaller key k1.
    assert {r.structure_key for r in pooling.dedupe_by_smile(first).collect()} == {"k1", "k2"}
    by_id = pooling.dedupe_by_id(df.withColumnRenamed("smile", "spectrum_id"))
    assert {(r.spectrum_id, r.ordinal) for r in by_id.collect()} == {("A", 5), ("B", 7), ("C", 6), ("D", 1)}


def test_pooled_peaks_keep_input_order_and_first_representative(spark):
    spectra = spark.createDataFrame(
        [("s2", "k", "second", 20.0, 2), ("s1", "k", "first", 10.0, 1), ("s3", None, "none", 10.0, 3),
         ("s0", "k", "no peaks", 5.0, 0)],
        "spectrum_id string, structure_key string, smile string, precursor double, ordinal long",
    )
    peaks = spark.createDataFrame(
        [("s2", 0, 5.0, 1.0), ("s2", 1, 4.0, 1.0), ("s1", 0, 7.0, 1.0), ("s3", 0, 7.0, 1.0)],
        "spectrum_id string, pos int, mz double, intensity double",
    )
    pooled = pooling.pool_by_structure(spectra, peaks)
    assert "SortAggregate" not in pooled._jdf.queryExecution().executedPlan().toString()
    pooled = pooled.orderBy("ordinal", "pos")
    assert [(r.smile, r.precursor, r.mz) for r in pooled.collect()] == [
        ("first", 10.0, 7.0),
        ("first", 10.0, 5.0),
        ("first", 10.0, 4.0),
    ]


def _annotated(spark, spectra, smile_of):
    records = [
        (smile_of(i), precursor, i, peaks) for i, (_, precursor, peaks) in enumerate(spectra)
    ]
    return records, spark.createDataFrame(
        records,
        "smile string, precursor double, ordinal long, peaks array<struct<mz:double,intensity:double>>",
    )


def _expected(records, key_of):
    pooled = {}
    for smile, precursor, _, peaks in records:
        cleaned = brute_clean(precursor, peaks)
        if cleaned and key_of(smile):
            entry = pooled.setdefault(key_of(smile), (smile, precursor, []))
            entry[2].extend(cleaned)
    return {
        key: (smile, precursor, brute_bins(precursor, peaks))
        for key, (smile, precursor, peaks) in pooled.items()
        if precursor <= 1000
    }


def test_annotated_features_with_a_hot_structure(spark):
    """One structure owns a third of the spectra; results equal brute force."""
    spectra = random_spectra(600, seed=11)
    smile_of = lambda i: "hot" if i % 3 == 0 else f"m{i % 50}"
    records, df = _annotated(spark, spectra, smile_of)
    names = sorted({r[0] for r in records} - {"m7"})
    # m3 and m4 share a structure; m7 is unknown.
    keys = {n: ("SAMEKEY0000000" if n in ("m3", "m4") else f"{n:X<14}") for n in names}
    molecules = spark.createDataFrame(
        [(n, k + "-TAIL") for n, k in keys.items()], "smile string, inchikey string"
    )
    cleaned = identify.cleaned_annotated(df, molecules)
    got = {
        r.structure_key: (r.smile, r.precursor, r.bins)
        for r in identify.features_annotated(cleaned).collect()
    }
    assert got == _expected(records, keys.get)


def test_merging_moves_bounded_rows_for_a_hot_key(spark):
    """Peaks are summed into cells before the shuffle, whatever their number."""
    n = 200_000
    rng = np.random.default_rng(0)
    cells = rng.integers(0, 40, 400)
    rows = spark.range(n).select(
        F.lit("hot").alias("k"),
        (F.lit(100.0) + F.element_at(F.array(*[F.lit(int(c)) for c in cells]), (F.col("id") % 400 + 1).cast("int")) * 0.1).alias("mz"),
        F.lit(1.0).alias("intensity"),
    )
    merged = peak_rows.merge_peaks(rows, "k")
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "partial_sum" in plan
    got = merged.collect()
    assert len(got) == len(set(cells.tolist()))
    assert sum(r.n_merged for r in got) == n


def test_first_rows_are_cut_ahead_of_the_shuffle(spark):
    df = spark.createDataFrame([("a", 1)], "spectrum_id string, ordinal long")
    plan = pooling.dedupe_by_id(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_unannotated_features_keep_the_first_surviving_spectrum(spark):
    schema = (
        "spectrum_id string, precursor double, ordinal long, "
        "peaks array<struct<mz:double,intensity:double>>"
    )
    spectra = [
        ("a", 100.0, 1, [(300.0, 1.0)]),  # nothing inside the window
        ("a", 200.0, 2, [(150.0, 1.0), (20.0, 0.5)]),
        ("a", 300.0, 3, [(10.0, 1.0)]),
        ("heavy", 1000.5, 4, [(10.0, 1.0)]),  # first of its id, and too heavy
        ("heavy", 500.0, 5, [(10.0, 1.0)]),
    ]
    got = identify.features_unannotated(spark.createDataFrame(spectra, schema)).collect()
    assert [(r.spectrum_id, r.precursor, r.mz) for r in got] == [("a", 200.0, [150.0, 20.0])]
    assert got[0].bins == brute_bins(200.0, brute_clean(200.0, spectra[1][3]))
