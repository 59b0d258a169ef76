import numpy as np
import pytest
from pyspark.errors import PySparkException

from peakwise.plans import identify, resumable
from peakwise.sources import msp, tables

SETTINGS = identify.Settings(parts=6, max_mz=5)


def features(spark, n=120):
    rows = [(f"s{i}", [i % 7, 10 + i % 11], 2) for i in range(n)]
    return spark.createDataFrame(rows, "spectrum_id string, bins array<int>, len_frag int")


def logging_model(folder):
    """Writes a file per spectrum it embeds; while there is a file ``stop`` beside the folder, it
    fails after so many as that says.  A worker keeps a model by its key."""

    def load():
        import uuid

        stop = folder.parent / "stop"

        def predict(bins):
            if stop.exists() and len(list(folder.iterdir())) >= int(stop.read_text()):
                raise RuntimeError("ended")
            for _ in bins:
                (folder / uuid.uuid4().hex).touch()
            return np.array([[float(sum(b))] for b in bins])

        return predict

    return load


@pytest.fixture()
def log(tmp_path):
    folder = tmp_path / "log"
    folder.mkdir()
    return folder


def test_a_run_goes_on_where_it_was_ended(spark, work, log):
    df = tables.write_table(features(spark), f"{work}/in")
    path = f"{work}/out"
    model = {"dense": False, "model_key": "m1"}
    (log.parent / "stop").write_text("60")
    with pytest.raises(PySparkException, match="ended"):
        identify.predict(df, logging_model(log), path, SETTINGS, **model)
    (log.parent / "stop").unlink()
    done = [k for k in range(6) if tables.finished(spark, f"{path}/predictions/_part={k}")]
    assert 0 < len(done) < 6
    first = spark.read.parquet(*[f"{path}/predictions/_part={k}" for k in done]).count()
    before = len(list(log.iterdir()))
    got = identify.predict(df, logging_model(log), path, SETTINGS, **model)
    assert len(list(log.iterdir())) - before == 120 - first
    assert sorted((r.spectrum_id, r.embedding) for r in got.collect()) == sorted(
        (f"s{i}", [float(i % 7 + 10 + i % 11)]) for i in range(120))
    assert got.columns == ["spectrum_id", "len_frag", "embedding"]


def test_other_models_and_settings_are_refused(spark, work, log):
    df = tables.write_table(features(spark, 12), f"{work}/in")
    run = lambda settings, key: identify.predict(
        df, logging_model(log), f"{work}/out", settings, dense=False, model_key=key).count()
    assert run(SETTINGS, "m3") == run(SETTINGS, "m3") == len(list(log.iterdir())) == 12
    with pytest.raises(resumable.OtherInputs, match="model"):
        run(SETTINGS, "m4")
    with pytest.raises(resumable.OtherInputs, match="settings"):
        run(identify.Settings(parts=6, max_mz=6), "m3")
    with pytest.raises(ValueError):
        resumable.predict_in_parts(df, lambda x: x, f"{work}/none", 0)


def test_no_features_and_repeated_rows(spark, work, log):
    nothing = identify.predict(features(spark).limit(0), logging_model(log), f"{work}/a",
                               SETTINGS, dense=False)
    assert nothing.count() == 0
    same = features(spark, 1)
    for _ in range(4):
        same = same.unionByName(same)
    got = identify.predict(same, logging_model(log), f"{work}/b", SETTINGS, dense=False)
    assert [r.embedding for r in got.collect()] == [[10.0]] * 16


def test_whole_jobs_are_run_again(spark, work, log, tmp_path):
    text = "".join(f"Name: n{i // 2}\nPrecursor: {2 + i % 3}.0\n1.0 5\n1.5 {i + 1}\n" for i in range(40))
    source = tmp_path / "in.msp"
    source.write_text(text + "Name: bad\nPrecursor: x\n1 2\n")
    library = spark.createDataFrame(
        [(i, f"C{i}", f"K{i}", 1 + i % 3 - 0.007276, [float(i)]) for i in range(9)],
        "library_id long, smile string, inchikey string, exact_mass double, embedding array<float>")

    def run(path=source):
        spectra = msp.read_named(spark, str(path))
        return sorted(map(tuple, identify.identify_unannotated(
            spectra, library, logging_model(log), f"{work}/job", settings=SETTINGS, dense=False,
        ).collect()))

    (tmp_path / "stop").write_text("8")
    with pytest.raises(PySparkException, match="ended"):
        run()
    (tmp_path / "stop").unlink()
    first = run()
    (tmp_path / "stop").write_text("0")
    assert first and run() == first and len(list(log.iterdir())) >= 20
    assert spark.read.parquet(f"{work}/job/rejected").count() == 1
    source.rename(tmp_path / "other.msp")
    with pytest.raises(resumable.OtherInputs, match="inputs"):
        run(tmp_path / "other.msp")
