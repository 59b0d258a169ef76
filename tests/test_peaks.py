"""Peak operators against hand cases and plain numpy."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from peakwise.functions import binning, peaks
from peakwise.functions.rounding import round_even
from peakwise.operators import matching, peak_rows, records

SCHEMA = (
    "spectrum_id string, precursor double, peaks array<struct<mz:double,intensity:double>>"
)


def frame(spark, *spectra):
    return spark.createDataFrame(list(spectra), SCHEMA)


def listed(row):
    return [(p.mz, p.intensity) for p in row]


def one(spark, expr, spectrum):
    return frame(spark, ("a", 100.0, spectrum)).select(expr.alias("x")).first().x


def test_window_edge(spark):
    kept = one(spark, peaks.within_precursor(F.col("peaks"), F.col("precursor")), [(100.5, 1.0), (100.5001, 1.0)])
    assert listed(kept) == [(100.5, 1.0)]


def test_null_precursor_drops_the_spectrum(spark):
    df = frame(spark, ("a", None, [(1.0, 1.0)]), ("b", 5.0, [(1.0, 1.0)]))
    assert [r.spectrum_id for r in records.clean(df).collect()] == ["b"]


def test_threshold_edge(spark):
    scaled = peaks.scale_to_base_peak(F.col("peaks"))
    kept = one(spark, peaks.above_relative_intensity(scaled, 1), [(1.0, 100.0), (2.0, 1.0), (3.0, 0.99)])
    assert [p.mz for p in kept] == [1.0, 2.0]


def test_all_zero_spectrum_is_dropped(spark):
    df = frame(spark, ("zero", 100.0, [(50.0, 0.0), (60.0, 0.0)]), ("empty", 100.0, []))
    assert records.clean(df).count() == 0


def test_total_ion_scaling_sums_to_one(spark):
    cleaned = one(spark, peaks.clean_peaks(F.col("peaks"), F.col("precursor"), 1.0), [(5.0, 3.0), (6.0, 5.0), (7.0, 0.001), (200.0, 9.0)])
    assert [p.mz for p in cleaned] == [5.0, 6.0]
    assert sum(p.intensity for p in cleaned) == pytest.approx(1.0)


@pytest.mark.parametrize(
    "mzs, expected",
    [
        ([100.0, 100.008, 100.016], [100.01]),
        ([100.0, 100.01], [100.0, 100.01]),
        ([5.0], [5.0]),
        ([3.0, 1.0, 2.0], [1.0, 2.0, 3.0]),
        ([], []),
    ],
)
def test_merge_close_peaks(spark, mzs, expected):
    got = one(spark, peaks.merge_close_peaks(F.col("peaks"), 0.01), [(m, 1.0) for m in mzs])
    assert [p.mz for p in got] == expected
    assert sum(p.intensity for p in got) == len(mzs)


def test_rounding_is_half_even_on_the_scaled_value(spark):
    values = spark.createDataFrame([(230.0045,), (1.0005,), (2.675,)], "x double")
    got = [r[0] for r in values.select(round_even(F.col("x"), 3)).collect()]
    assert got == [float(np.round(x, 3)) for x in (230.0045, 1.0005, 2.675)]
    assert got[0] == 230.004


def test_bins(spark):
    values = [0.01, -0.01, 699.99, 700.0, 1000.0, 0.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(binning.bin_index(F.col("x"), 0.01, 700)).collect()]
    assert got == [1, 0, 69999, 69999, 69999, 0]
    assert binning.grid_size(0.01, 700) == 70_000


def test_bins_equal_a_search_on_the_grid(spark):
    rng = np.random.default_rng(5)
    exact = rng.integers(0, 71_000, 20_000) / 100
    values = np.concatenate([exact, np.round(rng.uniform(-1, 710, 20_000), 3)])
    grid = np.arange(0, 700, 0.01)
    expected = np.minimum(np.searchsorted(grid, values), len(grid) - 1)
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = [r[0] for r in df.select(binning.bin_index(F.col("x"), 0.01, 700)).collect()]
    assert got == expected.tolist()


# ------------------------------------------------------------------ brute force


def brute_clean(precursor, spectrum, threshold=1.0):
    kept = [(m, i) for m, i in spectrum if m <= precursor + 0.5]
    if not kept or max(i for _, i in kept) == 0:
        return []
    top = max(i for _, i in kept)
    scaled = [(m, i / top * 100) for m, i in kept]
    top = max(i for _, i in scaled)
    scaled = [(m, i) for m, i in scaled if i / top * 100 >= threshold]
    total = sum(i for _, i in scaled)
    return [(m, i / total) for m, i in scaled]


def brute_merge(spectrum, tolerance):
    groups = []
    for mz, intensity in sorted(spectrum):
        if groups and mz - groups[-1][-1][0] <= tolerance:
            groups[-1].append((mz, intensity))
        else:
            groups.append([(mz, intensity)])
    out = []
    for g in groups:
        total = 0.0
        for mz, _ in g:
            total += mz
        out.append((np.round(np.round(total / len(g), 3), 2), sum(i for _, i in g)))
    return out


def brute_bins(precursor, spectrum, tolerance=0.01, resolution=0.01, max_mz=700):
    mzs = [m for m, _ in brute_merge(spectrum, tolerance)]
    limit = np.round(precursor, 3) + 0.5
    values = mzs + [np.round(limit - np.round(m, 3), 3) for m in mzs]
    grid = np.arange(0, max_mz, resolution)
    return sorted({int(min(np.searchsorted(grid, v), len(grid) - 1)) for v in values})


def random_spectra(n, seed=3):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        k = int(rng.integers(0, 60))
        # Dense m/z values, so that chains of several peaks occur.
        mz = np.round(rng.uniform(50, 55 if i % 2 else 900, k), 4)
        out.append(
            (f"s{i}", float(np.round(rng.uniform(50, 1100), 4)),
             [(float(m), float(np.round(v, 3))) for m, v in zip(mz, rng.uniform(0, 100, k))])
        )
    return out


def test_record_features_equal_brute_force(spark):
    spectra = random_spectra(300)
    expected = {}
    for key, precursor, spectrum in spectra:
        cleaned = brute_clean(precursor, spectrum)
        if cleaned and precursor <= 1000:
            expected[key] = brute_bins(precursor, cleaned)
    df = records.encode(records.precursor_cutoff(records.clean(frame(spark, *spectra))))
    got = {r.spectrum_id: r for r in df.collect()}
    assert {k: r.bins for k, r in got.items()} == expected
    assert all(r.len_frag == len(r.bins) for r in got.values())


def test_single_steps_compose_to_clean(spark):
    df = frame(spark, *random_spectra(60, seed=8))
    steps = records.drop_empty(records.precursor_window(df))
    steps = records.intensity_threshold(records.base_peak_scale(steps))
    steps = records.total_ion_scale(steps)
    clean = {r.spectrum_id: listed(r.peaks) for r in records.clean(df).collect()}
    assert {r.spectrum_id: listed(r.peaks) for r in steps.collect()} == clean


@pytest.mark.parametrize("tolerance", [0.01, 0.5, 0.0])
def test_peak_rows_equal_records(spark, tolerance):
    df = frame(spark, *random_spectra(200, seed=4))
    rows = peak_rows.explode_peaks(df, "spectrum_id", "precursor")
    by_rows = peak_rows.encode(peak_rows.clean(rows, "spectrum_id"), "spectrum_id", tolerance)
    by_record = records.encode(records.precursor_cutoff(records.clean(df)), tolerance)
    assert {r.spectrum_id: r.bins for r in by_rows.collect()} == {
        r.spectrum_id: r.bins for r in by_record.collect()
    }


def test_chains_of_three_decimals_have_one_mean_by_both_paths(spark):
    rng = np.random.default_rng(9)
    spectra = []
    for i in range(3000):
        start = round(float(rng.uniform(50, 600)), 3)
        steps = rng.integers(1, 10, int(rng.integers(2, 8))) / 1000
        mzs = [start, *(round(start + float(x), 3) for x in np.cumsum(steps))]
        spectra.append((f"s{i}", 900.0, [(m, 1.0) for m in mzs]))
    df = frame(spark, *spectra)
    rows = peak_rows.explode_peaks(df, "spectrum_id", "precursor")
    by_rows = {r.spectrum_id: r.bins for r in peak_rows.encode(rows, "spectrum_id").collect()}
    by_record = {r.spectrum_id: r.bins for r in records.encode(df, 0.01).collect()}
    assert len(by_rows) == 3000 and by_rows == by_record


def skewed_joins(df):
    """Joins of the final adaptive plan that were split."""
    df.write.format("noop").mode("overwrite").save()
    query = df._jdf.queryExecution()
    query.executedPlan().execute().count()
    return query.executedPlan().toString().count("skew=true")


def test_a_spectrum_with_a_third_of_all_peaks_is_split(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k",
    }
    before = {k: spark.conf.get(k) for k in settings}
    hot = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 5000)
    rows = spark.range(0, 300_000, 1, 8).select(
        hot.cast("string").alias("spectrum_id"), F.lit(900.0).alias("precursor"),
        (F.col("id") % 600 + 50.5).alias("mz"), (F.col("id") % 97 + 1.0).alias("intensity"))
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        for scale in (peak_rows.base_peak_scale, peak_rows.total_ion_scale):
            assert skewed_joins(scale(rows, "spectrum_id")) >= 1
        keyed = rows.select(F.col("spectrum_id").cast("int").alias("mass_key"), "mz")
        library = keyed.where("mass_key % 2 = -1 or mass_key % 4 = 0").select(
            "mass_key", F.col("mass_key").alias("library_id"))
        assert skewed_joins(matching.match_candidates(keyed, library)) >= 1
        assert skewed_joins(matching.unmatched_queries(keyed, library)) >= 1
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_negative_base_peak(spark):
    df = frame(spark, ("n", 100.0, [(1.0, -5.0), (2.0, -10.0)]))
    rows = peak_rows.explode_peaks(df, "spectrum_id", "precursor")
    by_rows = {(r.mz, r.intensity) for r in peak_rows.clean(rows, "spectrum_id").collect()}
    by_record = set(listed(records.clean(df).first().peaks))
    assert by_rows == by_record == set(brute_clean(100.0, [(1.0, -5.0), (2.0, -10.0)]))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(0, 400).map(lambda i: i / 1000), min_size=1, max_size=40))
def test_chains_cover_all_peaks(spark, mzs):
    spectrum = [(50.0 + m, 1.0) for m in mzs]
    merged = one(spark, peaks.merge_close_peaks(F.col("peaks"), 0.01), spectrum)
    assert math.isclose(sum(p.intensity for p in merged), len(mzs))
    assert [(p.mz, p.intensity) for p in merged] == [
        (float(m), i) for m, i in brute_merge(spectrum, 0.01)
    ]


def test_clean_runs_the_expression_once(spark):
    plan = records.clean(frame(spark, ("a", 1.0, [])))._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("array_max") == 2  # one per scaling step


def test_exploded_rows_know_their_position(spark):
    df = frame(spark, ("a", 1.0, [(5.0, 1.0), (4.0, 2.0)]))
    rows = peak_rows.explode_peaks(df, "spectrum_id", position=True).collect()
    assert [(r.pos, r.mz, r.intensity) for r in rows] == [(0, 5.0, 1.0), (1, 4.0, 2.0)]


def test_merging_written_records_reads_only_mz(spark, work):
    from peakwise.sources.tables import write_table

    written = write_table(frame(spark, ("a", 1.0, [(1.0, 2.0)])), work)
    merged = peak_rows.merge_peaks(peak_rows.explode_peaks(written, "spectrum_id"), "spectrum_id")
    plan = merged.select("spectrum_id", "mz")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<spectrum_id:string,peaks:array<struct<mz:double>>>" in plan


def test_any_finite_mz_is_merged_and_encoded(spark):
    """Peaks too large for decimals and for integer bins, by records and by rows."""
    mzs = [1e12, 1e12, 2e12, 5e15, 5e15 + 1, 1e17, 1e18, 1e300, 1e300, 50.0, 50.004]
    df = frame(spark, ("a", 2e300, [(m, 1.0) for m in mzs]), ("b", 100.0, [(60.0, 1.0)]))
    expected = sorted({50.0, 1e12, 2e12, 5e15, 5e15 + 1, 1e17, 1e18, 1e300})
    merged = records.merge_peaks(df).where("spectrum_id = 'a'").first().merged
    rows = peak_rows.explode_peaks(df, "spectrum_id", "precursor")
    grouped = peak_rows.merge_peaks(rows, "spectrum_id").where("spectrum_id = 'a'").collect()
    for got in ([p.mz for p in merged], sorted(r.mz for r in grouped)):
        np.testing.assert_allclose(got, expected, rtol=1e-12)
    assert sorted(r.n_merged for r in grouped) == [1, 1, 1, 1, 1, 2, 2, 2]
    values = [1e300, -1e300, 1e17, 700.0, 0.01, -0.01]
    last = binning.grid_size(0.01, 700) - 1
    bins = one(spark, F.transform(F.array(*map(F.lit, values)),
                                  lambda v: binning.bin_index(v, 0.01, 700)), [])
    assert bins == [last, 0, last, last, 1, 0]


def test_a_huge_precursor_does_not_end_the_annotated_job(spark):
    from peakwise.plans import identify

    schema = "smile string, precursor double, ordinal int, peaks array<struct<mz:double,intensity:double>>"
    spectra = [("C", 5e12, 1, [(2e12, 1.0)]), ("CC", 100.0, 2, [(50.0, 1.0)])]
    molecules = spark.createDataFrame([("C", "A" * 27), ("CC", "B" * 27)], "smile string, inchikey string")
    cleaned = identify.cleaned_annotated(spark.createDataFrame(spectra, schema), molecules)
    assert [r.smile for r in identify.features_annotated(cleaned).collect()] == ["CC"]


def test_tasks_of_merging_follow_the_input(spark, work, monkeypatch):
    from peakwise.sources import tables

    made = spark.range(6000).select(
        (F.col("id") % 500).alias("spectrum_id"),
        F.lit(900.0).alias("precursor"),
        (F.col("id") * 7919 % 6007 / 10).alias("mz"),
        F.rand(1).alias("intensity"),
    )
    rows = tables.write_table(made, work)
    plain = sorted(peak_rows.encode(rows, "spectrum_id").collect())
    assert tables.tasks_for(rows) == 1
    monkeypatch.setattr(tables, "TASK_BYTES", 1000)
    tasks = tables.tasks_for(rows)
    assert tasks > 30
    dealt = peak_rows.encode(rows, "spectrum_id")
    assert dealt.rdd.getNumPartitions() == tasks
    assert sorted(dealt.collect()) == plain
    joined = tables.spread(rows, "spectrum_id").join(rows.select("spectrum_id").distinct(), "spectrum_id")
    plan = peak_rows.merge_peaks(joined, "spectrum_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 3  # two of them for the join
    assert tables.tasks_for(made) == 0
