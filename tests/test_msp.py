import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from peakwise.sources import msp

NAMED = """Name: A
Precursor: 478.1479
Adduct: [M+H]+
Num Peaks: 3
50.1 3 "note"

60.25\t4
70.5
smile: ignored

Name: B
Num Peaks: 1
12.5 1e2
  Name: C
Precursor: 100
Precursor: 200.5
10 1
Name:
Precursor: 3
11 1
Name: D
"""


def write(tmp_path, text, name="in.msp"):
    path = tmp_path / name
    path.write_bytes(text.encode())
    return str(path)


def rows(df, key="spectrum_id"):
    out = {}
    for r in df.collect():
        out[r[key]] = (r.precursor, r.adduct, [(p.mz, p.intensity) for p in r.peaks])
    return out


EXPECTED = {
    "A": (478.1479, "[M+H]+", [(50.1, 3.0), (60.25, 4.0)]),
    "B": (None, None, [(12.5, 100.0)]),
    "C": (200.5, None, [(10.0, 1.0)]),
    "D": (None, None, []),
}


@pytest.mark.parametrize("whole_files", [False, True])
@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_named_blocks(spark, tmp_path, whole_files, newline):
    path = write(tmp_path, NAMED.replace("\n", newline))
    assert rows(msp.read_named(spark, path, whole_files=whole_files)) == EXPECTED


def test_whole_files_skip_text_before_the_first_block(spark, tmp_path):
    path = write(tmp_path, "Precursor: 9\n1 2\n" + NAMED)
    assert rows(msp.read_named(spark, path, whole_files=True)) == EXPECTED


def test_annotated_blocks(spark, tmp_path):
    path = write(tmp_path, "smile: C:C\nName: x\nPrecursor: 5.5\n1 2\n\nsmile: CC\n3 4\n")
    assert rows(msp.read_annotated(spark, path), "smile") == {
        "C:C": (5.5, None, [(1.0, 2.0)]),
        "CC": (None, None, [(3.0, 4.0)]),
    }


def test_headers_carry_over_on_request(spark, tmp_path):
    path = write(tmp_path, NAMED)
    got = rows(msp.read_named(spark, path, inherit_headers=True))
    assert got["B"][:2] == (478.1479, "[M+H]+")
    assert got["C"][:2] == (200.5, "[M+H]+")
    # The block without an id is dropped but still passes on its precursor.
    assert got["D"][:2] == (3.0, "[M+H]+")


def test_malformed_numbers(spark, tmp_path):
    path = write(tmp_path, "Name: A\nPrecursor: abc\n1 2\nName: B\n1x 2\nName: C\n1 2\n")
    kept = {r.spectrum_id: r._corrupt for r in msp.read_named(spark, path).collect()}
    assert kept["C"] is None and "abc" in kept["A"] and "1x" in kept["B"]
    assert set(rows(msp.read_named(spark, path, mode="DROPMALFORMED"))) == {"C"}
    with pytest.raises(PySparkException, match="malformed MSP block"):
        msp.read_named(spark, path, mode="FAILFAST").collect()


def test_splits_keep_every_block_in_file_order(spark, tmp_path):
    blocks = [f"Name: n{i}\nPrecursor: {i}.25\n{i} 1\n{i}.5 2\n\n" for i in range(2000)]
    write(tmp_path, "".join(blocks[:1200]), "a.msp")
    write(tmp_path, "".join(blocks[1200:]), "b.msp")
    settings = {
        "spark.sql.files.maxPartitionBytes": "1000",
        "spark.sql.files.openCostInBytes": "10",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        scan = msp.read_named(spark, str(tmp_path))
        assert scan.select(F.spark_partition_id()).distinct().count() > 8
        ids = [r.spectrum_id for r in scan.orderBy("ordinal").collect()]
        carried = msp.read_named(spark, str(tmp_path), inherit_headers=True)
        assert carried.count() == 2000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert ids == [f"n{i}" for i in range(2000)]


def test_headers_carry_over_across_splits(spark, tmp_path):
    text = "Name: first\nPrecursor: 7.5\n1 1\n" + "".join(
        f"Name: n{i}\n{i} 1\n" for i in range(500)
    )
    path = write(tmp_path, text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    try:
        got = msp.read_named(spark, path, inherit_headers=True).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(got) == 501 and {r.precursor for r in got} == {7.5}


def test_ion_mode_belongs_to_the_source(spark, tmp_path):
    path = write(tmp_path, NAMED)
    both = msp.union_ion_modes(msp.read_named(spark, path), msp.read_named(spark, path))
    counts = {r.ion_mode: r["count"] for r in both.groupBy("ion_mode").count().collect()}
    assert counts == {"+": 4, "-": 4}


@pytest.mark.parametrize("whole_files", [False, True])
def test_text_ahead_of_the_first_id_line_is_no_spectrum(spark, tmp_path, whole_files):
    for name, text in {
        "a.msp": "# exported by tool\n\nName: A\nPrecursor: 5\n1 2\n",
        "b.msp": "\ufeffName: B\n3 4\nName: C\n5 6\n",
        "c.msp": "only a note\n",
        "d.msp": "\n  Name: D\n7 8\n",
    }.items():
        (tmp_path / name).write_text(text)
    got = msp.read_named(spark, str(tmp_path), whole_files=whole_files).collect()
    assert sorted((r.spectrum_id, len(r.peaks)) for r in got) == [
        ("A", 1), ("B", 1), ("C", 1), ("D", 1)]


def test_a_malformed_precursor_is_not_filled(spark, tmp_path):
    path = tmp_path / "f.msp"
    path.write_text("Name: A\nPrecursor: 200.0\n1 2\nName: B\nPrecursor: x300\n1 2\n"
                    "Name: C\n1 2\nName: D\nPrecursor: 7\n1 2\nName: E\n1 2\n")
    got = {r.spectrum_id: (r.precursor_text, r.precursor) for r in
           msp.read_named(spark, str(path), inherit_headers=True).collect()}
    assert got == {"A": ("200.0", 200.0), "B": ("x300", None), "C": ("x300", None),
                   "D": ("7", 7.0), "E": ("7", 7.0)}


def test_jobs_leave_out_malformed_blocks_and_write_them(spark, tmp_path, work):
    from peakwise.plans import identify

    path = tmp_path / "f.msp"
    path.write_text("Name: A\nPrecursor: 200.0\n50.0 2\n60.0 abc\nName: B\nPrecursor: 200\n"
                    "50.0 2\n70.0 1\n")
    kept = identify.sound_spectra(msp.read_named(spark, str(path)), work)
    assert [r.spectrum_id for r in kept.collect()] == ["B"] and "_corrupt" not in kept.columns
    rejected = spark.read.parquet(f"{work}/rejected").collect()
    assert len(rejected) == 1 and "60.0 abc" in rejected[0]._corrupt


def _small_parts(spark):
    """Set small splits and batches; returns what they were."""
    settings = {
        "spark.sql.files.maxPartitionBytes": "700",
        "spark.sql.files.openCostInBytes": "10",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "3",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    return before


def test_files_are_scanned_once(spark, tmp_path):
    path = write(tmp_path, NAMED)
    plan = msp.read_named(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1 and "Exchange" not in plan


def test_numbers_of_blocks_over_splits_and_batches(spark, tmp_path):
    """Splits, batches, indented id lines, text ahead of the first block, files without one."""
    expected = {}
    for f in range(4):
        lines, names = ["a note\n"] * (f % 2), []
        for i in range(0 if f == 3 else 150):
            names.append(f"{f}-{i}")
            lines.append(f"{'  ' if i % 7 == f else ''}Name: {f}-{i}\n{i} 1\n" + "\n" * (i % 3))
        expected[f"{f}.msp"] = names
        write(tmp_path, "".join(lines), f"{f}.msp")
    before = _small_parts(spark)
    try:
        blocks = msp.read_blocks(spark, str(tmp_path), msp.NAMED_TAG)
        assert blocks.select(F.spark_partition_id()).distinct().count() > 8
        numbered = msp.number_blocks(blocks).collect()
        across = msp.number_blocks(blocks, across_files=True).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    got = {}
    for r in sorted(numbered, key=lambda r: (r.ordinal.file, r.number)):
        got.setdefault(r.ordinal.file.rsplit("/", 1)[1], []).append(
            (r.number, r.block.split()[1]))
    assert got == {f: list(enumerate(names)) for f, names in expected.items() if names}
    in_order = sorted(numbered, key=lambda r: tuple(r.ordinal))
    assert [r.number for r in in_order] == [*range(150)] * 3
    across.sort(key=lambda r: tuple(r.ordinal))
    assert [r.number for r in across] == list(range(450))


def test_repeated_tags_in_a_line_open_one_block(spark, tmp_path):
    path = write(tmp_path, "Name:Name: A\n1 2\nName: Name: B\n1 2\nX Name: C\rName: D\n3 4\n")
    got = msp.read_named(spark, path).orderBy("ordinal").collect()
    assert [r.spectrum_id for r in got] == ["Name: A", "Name: B", "D"]


def test_numbers_beyond_a_double_are_malformed(spark, tmp_path):
    path = write(tmp_path, "Name: A\n60.0 1e400\nName: B\nPrecursor: 1e999\n1 2\n"
                 "Name: C\n1e400 5\nName: D\nPrecursor: nan\n1 2\nName: E\n1e300 1e300\n")
    got = {r.spectrum_id: r._corrupt is None for r in msp.read_named(spark, path).collect()}
    assert got == {"A": False, "B": False, "C": False, "D": False, "E": True}


def test_tasks_of_annotated_files_follow_the_input(spark, work, monkeypatch):
    from peakwise.plans import identify
    from peakwise.sources import tables
    from workload import views

    n = 600
    spectra = tables.write_table(
        spark.range(n).select(
            F.col("id").alias("spectrum_id"),
            F.concat(F.lit("C"), F.col("id") % 90).alias("id"),
            (F.col("id") % 300 + 100.5).alias("precursor"),
            F.lit("[M+H]+").alias("adduct"),
        ),
        f"{work}/made",
    )
    peaks = tables.write_table(
        spark.range(n * 20).select(
            (F.col("id") % (n + 20)).alias("spectrum_id"),
            (F.col("id") * 7919 % 4001 / 10).alias("mz"),
            (F.col("id") % 17 + 1.5).alias("intensity"),
        ),
        f"{work}/peaks",
    )
    molecules = spark.createDataFrame([(f"C{i}", f"{i:027}"[::-1]) for i in range(80)],
                                      "smile string, inchikey string")

    def run(name):
        path = views.write_msp(spectra, peaks, "smile:", f"{work}/{name}")
        read = msp.read_annotated(spark, path)
        blocks = msp.read_blocks(spark, path, msp.ANNOTATED_TAG)
        cleaned = identify.cleaned_annotated(read, molecules.hint("merge"))
        # The last block of a file keeps the end of its last line.
        in_order = [r.block.rstrip() for r in blocks.orderBy("ordinal").collect()]
        text = F.btrim("_corrupt", F.lit(" \r\n"))
        rows = sorted(str(r) for r in cleaned.drop("ordinal").withColumn("_corrupt", text).collect())
        files = len(spark.read.text(path).inputFiles())
        return in_order, rows, files, cleaned.rdd.getNumPartitions()

    in_order, rows, files, tasks = run("few")
    monkeypatch.setattr(tables, "TASK_BYTES", 2000)
    again, same_rows, more_files, more_tasks = run("many")
    assert again == in_order and same_rows == rows
    assert files <= 8 < more_files
    assert tasks <= 8 < more_tasks


def test_msp_files_take_one_shuffle_of_rows(spark, work):
    """Lines of spectra that repeat, have no id or no peaks, and of peaks without a spectrum."""
    from workload import views

    rows = [(0, "A", 100.5, "+"), (2, "B", 2.0, None), (2, "B", 2.0, None), (4, "D", 4.0, "+"),
            (7, None, 7.0, "+"), (None, "N", 9.0, "+")]
    spectra = spark.createDataFrame(rows, "spectrum_id long, id string, precursor double, adduct string")
    peaks = spark.createDataFrame(
        [(2, 60.0, 1.0), (0, 51.0, 3.0), (0, 50.0, 2.0), (0, 50.0, 1.0), (4, None, 1.0),
         (9, 1.0, 1.0), (None, 1.0, 1.0)], "spectrum_id long, mz double, intensity double")
    plan = views._msp_lines(
        views._msp_rows(spectra, peaks).repartitionByRange(3, "spectrum_id"), "Name:"
    )._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Exchange rangepartitioning" in plan
    path = views.write_msp(spectra, peaks, "Name:", work)
    files = sorted(spark.read.text(path).inputFiles())
    text = "".join(spark.read.text(f, wholetext=True).first()[0] for f in files)
    assert text.split("\n") == [
        "Name: N", "Precursor: 9.0", "Adduct: +", "Num Peaks: 0",
        "# exported by a tool",
        "Name: A", "Precursor: 100.5", "Adduct: +", "Num Peaks: 3", "50.0 1.0", "50.0 2.0", "51.0 3.0",
        "  Name: B", "  Name: B", "Precursor: 2.0", "Precursor: 2.0", "", "", "Num Peaks: 1",
        "Num Peaks: 1", "60.0 1.0",
        "Name: D\r", "Precursor: 4.0\r", "Adduct: +\r", "Num Peaks: 1\r", "",
        "", "Precursor: x7.0\r", "Adduct: +\r", "Num Peaks: 0\r", "",
    ]
