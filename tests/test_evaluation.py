import pytest
from pyspark.sql import functions as F

from peakwise.operators import evaluation
from peakwise.plans import identify
from peakwise.sources import msp

RANKED = (
    "spectrum_id string, rank int, smile string, inchikey string, precursor_mz double, "
    "cosine double, tanimoto double, n_candidates long"
)


def ranked(spark):
    def query(key, tanimotos, size):
        return [
            (key, r, f"{key}{r}", f"K{r}", 100.0 + r, 1.0 / r, t, size)
            for r, t in enumerate(tanimotos, 1)
        ]

    rows = (
        query("first", [0.95, 1.0], 2)
        + query("third", [0.1, None, 0.99, 0.99, 0.2], 9)
        + query("sixth", [0.1, 0.1, 0.1, 0.1, 0.1, 1.0], 6)
        + query("never", [0.94999], 1)
    )
    return spark.createDataFrame(rows, RANKED)


def test_hits(spark):
    hits = evaluation.first_hit_rank(ranked(spark))
    assert {r.spectrum_id: r.hit_rank for r in hits.collect()} == {
        "first": 1,
        "third": 3,
        "sixth": None,
        "never": None,
    }
    histogram = {r.bucket: (r.n_queries, r.sum_candidates) for r in evaluation.hit_histogram(hits).collect()}
    assert histogram == {1: (1, 2), 3: (1, 9), 11: (2, 7)}


def test_accuracy_counts_queries_without_candidates(spark):
    hits = evaluation.first_hit_rank(ranked(spark))
    queries = spark.createDataFrame(
        [(k,) for k in ("first", "third", "sixth", "never", "no candidates")], "spectrum_id string"
    )
    got = evaluation.topk_accuracy(queries, hits).orderBy("rank").collect()
    assert [tuple(r) for r in got] == [
        (1, 1, 20.0, 20.0),
        (2, 0, 0.0, 20.0),
        (3, 1, 20.0, 40.0),
        (4, 0, 0.0, 40.0),
        (5, 0, 0.0, 40.0),
    ]


def test_detail(spark):
    frame = ranked(spark)
    detail = evaluation.hit_detail(frame, evaluation.first_hit_rank(frame))
    got = {r.spectrum_id: (r.bucket, r.smile, r.inchikey) for r in detail.collect()}
    assert got == {
        "first": (1, "first1", "K1"),
        "third": (3, "third3", None),
        "sixth": (11, "sixth1", None),
        "never": (11, "never1", None),
    }


def test_tanimoto_of_missing_fingerprints_is_null(spark):
    frame = spark.createDataFrame(
        [([1, 2], [2, 1]), (None, [1]), ([], [])], "ground_fp array<int>, fp_bits array<int>"
    )
    assert [r.tanimoto for r in evaluation.with_tanimoto(frame).select(F.col("tanimoto")).collect()] == [1.0, None, None]


def summing_model(sign):
    def load():
        import numpy as np

        return lambda bins: np.array([[sign * float(b[0] + 1), 1.0] for b in bins])

    return load


LIBRARY = [(i, f"C{i}", f"{i:014}-K", 100.0 + i % 3, [float(i), 1.0], [i % 4, 9]) for i in range(30)]
LIBRARY_COLUMNS = (
    "library_id long, smile string, inchikey string, exact_mass double, embedding array<float>, "
    "fp_bits array<int>"
)


@pytest.fixture()
def rankings(monkeypatch):
    """How many rankings each written table runs."""
    found, write = [], identify.write_table

    def spy(df, *args, **options):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        found.append(plan.count("FlatMapCoGroupsInArrow"))
        return write(df, *args, **options)

    monkeypatch.setattr(identify, "write_table", spy)
    return found


def test_models_are_ranked_one_after_another(spark, work, tmp_path, rankings):
    (tmp_path / "in.msp").write_text("".join(
        f"smile: C{i % 30}\nPrecursor: {101 + i % 3}.007\n{20 + i % 7}.5 5\n50.0 {i + 1}\n"
        for i in range(60)))
    spectra = msp.read_annotated(spark, str(tmp_path / "in.msp"))
    library = spark.createDataFrame(LIBRARY, LIBRARY_COLUMNS)
    molecules = library.select("smile", "inchikey", "exact_mass", "fp_bits")
    models = {n: identify.Model(summing_model(s), library, {"dense": False})
              for n, s in (("a", 1.0), ("b", -1.0))}
    got = identify.evaluate_models(spectra, molecules, models, f"{work}/both")
    assert sum(rankings) == 2 and max(rankings) == 1
    columns = ("spectrum_id", "rank", "smile", "cosine", "tanimoto")
    for name, model in models.items():
        alone = identify.evaluate_retrieval(
            spectra, molecules, library, model.load, f"{work}/{name}", dense=False).ranked
        own = got.ranked.where(F.col("model") == name)
        assert own.count() > 100
        assert sorted(map(tuple, own.select(*columns).collect())) == sorted(
            map(tuple, alone.select(*columns).collect()))


def test_ion_modes_are_ranked_one_after_another(spark, work, tmp_path, rankings):
    library = spark.createDataFrame(LIBRARY, LIBRARY_COLUMNS).drop("fp_bits")
    spectra, loaders = {}, {}
    for mode, shift, sign in (("+", 1.007, 1.0), ("-", -1.007, -1.0)):
        path = tmp_path / f"in{sign}.msp"
        path.write_text("".join(
            f"Name: n{mode}{i}\nPrecursor: {100 + i % 3 + shift:.3f}2\n{20 + i % 7}.5 5\n50.0 {i + 1}\n"
            for i in range(30)))
        spectra[mode], loaders[mode] = msp.read_named(spark, str(path)), summing_model(sign)
    both = msp.union_ion_modes(spectra["+"], spectra["-"])
    got = identify.identify_by_mode(both, library, loaders, f"{work}/both", dense=False)
    assert sum(rankings) == 2 and max(rankings) == 1
    assert "FlatMapCoGroupsInArrow" not in got._jdf.queryExecution().optimizedPlan().toString()
    rows = sorted(map(tuple, got.drop("ion_mode").collect()))
    assert {r.ion_mode for r in got.collect()} == {"+", "-"}
    alone = [tuple(r) for m in "+-" for r in identify.identify_unannotated(
        spectra[m], library, loaders[m], f"{work}/{'np'[m == '+']}", m, dense=False).collect()]
    assert rows == sorted(alone) and len(rows) == 300


def shuffled(spark):
    """Bytes of the shuffle files that lie on disk."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    found = [files.apply(i) for i in range(files.size())]
    return sum(f.length() for f in found if f.getName().startswith("shuffle_"))


def spectra_text(tag, n=2000):
    return "".join(
        f"{tag} C{i % 1500}\nPrecursor: {101 + i % 3}.0074\n"
        + "".join(f"{20 + (i * k) % 701 / 10} {i % 17 + k}\n" for k in range(1, 6))
        for i in range(n))


def test_unannotated_spectra_leave_no_shuffles_of_written_tables(spark, work, tmp_path):
    for i in range(12):
        (tmp_path / f"{i}.msp").write_text(spectra_text("Name:", 1000 + i * 100))
    spectra = msp.read_named(spark, str(tmp_path))
    library = spark.createDataFrame(LIBRARY, LIBRARY_COLUMNS)
    before = shuffled(spark)
    ranked = identify.identify_unannotated(
        spectra, library, summing_model(1.0), f"{work}/job", dense=False)
    assert shuffled(spark) - before < 10_000  # those of single rows
    assert ranked.count() == 1500 * 5  # of the first of its id


def test_an_evaluation_leaves_no_shuffles_of_written_tables(spark, work, tmp_path):
    (tmp_path / "in.msp").write_text(spectra_text("smile:"))
    spectra = msp.read_annotated(spark, str(tmp_path / "in.msp"))
    library = spark.createDataFrame(
        [(i, f"C{i}", f"{i:014}-K", 100.0 + i % 3, [float(i), 1.0], [i % 4, 9]) for i in range(1500)],
        LIBRARY_COLUMNS)
    molecules = library.select("smile", "inchikey", "exact_mass", "fp_bits")
    before = shuffled(spark)
    detail = identify.evaluate_retrieval(
        spectra, molecules, library, summing_model(1.0), f"{work}/job", dense=False).detail
    assert shuffled(spark) - before < 10_000
    assert detail.count() == 1500
