import math

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from peakwise.functions import similarity
from peakwise.operators import matching
from peakwise.sources import tables

QUERY = "spectrum_id string, mass_key long, embedding array<float>"
LIBRARY = "library_id long, smile string, inchikey string, mass_key long, embedding array<float>"


def brute(queries, library, n):
    out = {}
    for key, mass, q in queries:
        scored = []
        for _, smile, inchikey, library_mass, v in library:
            if mass is not None and mass == library_mass:
                a, b = np.float32(q).astype(float), np.float32(v).astype(float)
                norm = np.linalg.norm(a) * np.linalg.norm(b)
                cosine = round(float(a @ b / norm), 12) if norm else None
                scored.append((-(cosine if cosine is not None else -9), smile, inchikey, cosine))
        if scored:
            out[key] = [(s, i, c) for _, s, i, c in sorted(scored)[:n]], len(scored)
    return out


def ranked(df):
    out = {}
    for r in df.orderBy("spectrum_id", "rank").collect():
        entries, _ = out.setdefault(r.spectrum_id, ([], r.n_candidates))
        entries.append((r.smile, r.inchikey, r.cosine))
        assert r["rank"] == len(entries)
    return out


def same(got, expected):
    assert got.keys() == expected.keys()
    for key, (entries, size) in expected.items():
        assert got[key][1] == size
        assert [e[:2] for e in got[key][0]] == [e[:2] for e in entries]
        for (_, _, a), (_, _, b) in zip(got[key][0], entries):
            assert (a is None and b is None) or math.isclose(a, b, abs_tol=1e-9)


def data(hot=True, seed=0):
    """A third of both sides shares one mass, and a third of that is copies of one molecule."""
    rng = np.random.default_rng(seed)
    mass = lambda: 1 if hot and rng.random() < 0.34 else int(rng.integers(2, 12))
    vector = lambda: [float(x) for x in rng.normal(size=8)]
    queries = [(f"q{i}", mass(), vector()) for i in range(120)]
    library = []
    for i in range(300):
        m = mass()
        if m == 1 and i % 3 == 0:
            library.append((i, "copy", "COPY", 1, [1.0] * 8))
        else:
            library.append((i, f"m{i:03d}", f"K{i}", m, vector()))
    queries += [("unmatched", 99, vector()), ("no mass", None, vector()), ("zero", 1, [0.0] * 8)]
    library += [(900, "null mass", "N", None, vector()), (901, "zero", "Z", 2, [0.0] * 8)]
    return queries, library


@pytest.mark.parametrize("tile_rows", [5, 37, 4096])
@pytest.mark.parametrize("n", [1, 5, 40])
def test_tiles_equal_brute_force(spark, tile_rows, n):
    queries, library = data()
    got = matching.top_candidates(
        spark.createDataFrame(queries, QUERY),
        spark.createDataFrame(library, LIBRARY),
        n,
        tile_rows=tile_rows,
    )
    same(ranked(got), brute(queries, library, n))


def test_masses_of_many_shapes_equal_brute_force(spark, monkeypatch):
    """Buckets hold masses with every number of rows on either side; stacks are cut."""
    monkeypatch.setattr(matching, "GATHERED", 100)
    monkeypatch.setattr(matching, "SCORES", 50)
    rng = np.random.default_rng(5)
    vector = lambda: [float(x) for x in rng.integers(-2, 3, size=3)]
    queries, library = [], []
    for mass in range(60):
        queries += [(f"q{mass}-{i}", mass, vector()) for i in range(mass % 7)]
        library += [(100 * mass + i, f"m{i}", f"K{mass}", mass, vector()) for i in range(mass % 11)]
    got = matching.top_candidates(
        spark.createDataFrame(queries, QUERY), spark.createDataFrame(library, LIBRARY), 3)
    same(ranked(got), brute(queries, library, 3))


@pytest.mark.parametrize("tile_rows", [1, 4096])
def test_missing_vectors_rank_last(spark, tile_rows):
    queries = [("a", 1, [1.0, 0.0]), ("b", 1, None), ("c", 2, None), ("d", 1, [1.0, None])]
    library = [(1, "x", "X", 1, None), (2, "y", "Y", 1, [1.0, 0.0]), (3, "z", "Z", 2, None),
               (4, "w", "W", 1, [-1.0, 0.0])]
    got = ranked(matching.top_candidates(
        spark.createDataFrame(queries, QUERY), spark.createDataFrame(library, LIBRARY),
        tile_rows=tile_rows))
    last = [("w", "W", None), ("x", "X", None), ("y", "Y", None)]
    assert got == {"a": ([("y", "Y", 1.0), ("w", "W", -1.0), ("x", "X", None)], 3),
                   "b": (last, 3), "c": ([("z", "Z", None)], 1), "d": (last, 3)}


def test_a_hot_mass_is_cut_into_tiles(spark):
    queries, library = data()
    q, lib = matching._tiles(
        spark.createDataFrame(queries, QUERY),
        spark.createDataFrame(library, LIBRARY).where("mass_key is not null"),
        10,
    )
    for side in (q, lib):
        sizes = side.groupBy("mass_key", "_q", "_l").count().agg(F.max("count")).first()[0]
        assert sizes <= 30  # blocks of ten on average
    assert q.select("mass_key", "_q", "_l").where("mass_key = 1").distinct().count() > 20
    meets = q.join(lib, ["mass_key", "_q", "_l"]).groupBy("spectrum_id", "library_id").count()
    assert meets.where("count > 1").count() == 0


def test_rows_of_a_growing_mass_move_no_more_often(spark):
    def side(n, name):
        return spark.range(n).select(F.concat(F.lit(name), "id").alias(f"{name}_id"),
                                     F.lit(1).cast("bigint").alias("mass_key"))

    for n in (600, 2400):
        q, lib = matching._tiles(side(n, "spectrum"), side(n, "library"), 16)
        assert q.count() <= matching.BLOCKS * n and lib.count() <= matching.BLOCKS * n
        pairs = q.join(lib, ["_tile", "_q", "_l"]).count()
        assert pairs == n * n  # each pair meets once


def test_blocks_are_as_large_as_a_task_holds(spark, monkeypatch):
    """Rows of a mass move once while its vectors fit, whatever their number."""
    monkeypatch.setattr(matching, "TILE_ROWS", 16)
    monkeypatch.setattr(matching, "BLOCK_ROWS", 1000)
    vector = F.sequence(F.lit(1), F.lit(64)).cast("array<float>").alias("embedding")
    mass = F.when(F.col("id") < 40, 1).otherwise(F.col("id") + 1).cast("bigint").alias("mass_key")

    def side(name, n):
        return spark.range(n).select(F.concat(F.lit(name), "id").alias(f"{name}_id"), mass, vector)

    monkeypatch.setattr(matching, "TILES_PER_CORE", 1 / spark.sparkContext.defaultParallelism)
    q, lib = side("spectrum", 60), side("library", 50)
    for blocks, block_bytes in ((1, 64 * 64 * 8), (3, 16 * 64 * 8)):
        monkeypatch.setattr(matching, "BLOCK_BYTES", block_bytes)
        found_q, found_lib = matching._tiles(q, lib, matching._block_rows(lib))
        found_q, found_lib = (f.where("mass_key = 1") for f in (found_q, found_lib))
        assert found_q.count() == 40 * blocks and found_lib.count() == 40 * blocks
        assert found_q.join(found_lib, ["_tile", "_q", "_l"]).count() == 40 * 40
    # Few masses are cut among the tasks, by their queries.
    monkeypatch.setattr(matching, "BLOCK_BYTES", 64 * 64 * 8)
    monkeypatch.setattr(matching, "TILES_PER_CORE", 4)
    found_q, found_lib = matching._tiles(q, lib, matching._block_rows(lib))
    found_q, found_lib = (f.where("mass_key = 1") for f in (found_q, found_lib))
    assert found_q.count() == 40 and found_lib.count() == 40 * 3


def test_large_blocks_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(matching, "TILE_ROWS", 8)
    queries, library = data()
    for rows in (8, 20, 1000):
        monkeypatch.setattr(matching, "BLOCK_ROWS", rows)
        got = matching.top_candidates(
            spark.createDataFrame(queries, QUERY), spark.createDataFrame(library, LIBRARY))
        same(ranked(got), brute(queries, library, 5))


@pytest.mark.parametrize("bucket", [-1, 0])
def test_a_tile_is_ranked_in_little_memory(bucket):
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    n = 3000
    vectors = pa.array(list(np.random.default_rng(1).random((n, 16), np.float32)))
    ids = pa.array(range(n))
    mass = pa.array([1] * n)
    q = pa.table({"spectrum_id": ids, "mass_key": mass, "embedding": vectors,
                  "_q": pa.array([bucket] * n)})
    lib = pa.table({"smile": ids, "mass_key": mass, "embedding": vectors})
    schema = pa.schema([("spectrum_id", pa.int64()), ("smile", pa.int64()), ("cosine", pa.float64())])
    rank = matching._tile_ranker(5, ["spectrum_id"], ["smile"], ["smile"], schema)
    tracemalloc.start()
    found = rank(q, lib)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == 5 * n
    assert peak < 40 << 20


def test_plan_has_no_pairs(spark):
    queries, library = data()
    plan = (
        matching.top_candidates(
            spark.createDataFrame(queries, QUERY), spark.createDataFrame(library, LIBRARY)
        )
        ._jdf.queryExecution()
        .executedPlan()
        .toString()
    )
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert plan.count("WindowGroupLimit") >= 2


def test_embeddings_of_other_length_fail(spark):
    queries = spark.createDataFrame([("a", 1, [1.0, 2.0])], QUERY)
    library = spark.createDataFrame([(1, "s", "k", 1, [1.0, 2.0, 3.0])], LIBRARY)
    with pytest.raises(PySparkException, match="differ in length"):
        matching.top_candidates(queries, library).collect()


def test_wide_results_and_csv(spark, work):
    queries, library = data()
    top = matching.top_candidates(
        spark.createDataFrame(queries, QUERY).where("spectrum_id in ('q1', 'zero')"),
        spark.createDataFrame(library, LIBRARY).where("library_id < 30 or mass_key = 2"),
        3,
    )
    wide = matching.wide_unannotated(top, 3)
    assert wide.columns == ["Unique_ID"] + [
        f"Top_{i}_{label}" for label in ("cosine", "SMILE", "InChIKey") for i in (1, 2, 3)
    ]
    two = spark.createDataFrame(
        [("x", 1, 0.5, "A", None), ("x", 2, None, "B", 0.25)],
        "spectrum_id string, rank int, cosine double, smile string, tanimoto double",
    )
    row = matching.wide_annotated(two, 3).first()
    assert row.Top_1_SMILE == "A" and row.Top_2_SMILE == "B" and row.Top_3_SMILE is None
    tables.write_results_csv(matching.wide_annotated(two, 3), work)
    lines = [r.value for r in spark.read.text(work).collect()]
    assert lines[1] == "x,0.5,NA,NA,A,B,NA,NA,0.25,NA"


def test_similarities(spark):
    df = spark.createDataFrame(
        [([1.0, 0.0], [1.0, 1.0], [1, 2, 3], [2, 3, 4]), ([0.0, 0.0], [1.0, 1.0], [], [])],
        "a array<float>, b array<float>, x array<int>, y array<int>",
    ).select(
        similarity.cosine(F.col("a"), F.col("b")).alias("c"),
        similarity.tanimoto(F.col("x"), F.col("y")).alias("t"),
    )
    first, second = df.collect()
    assert first.c == pytest.approx(2**-0.5) and first.t == 0.5
    assert second.c is None and second.t is None
    packed = spark.createDataFrame([([0b1110, 1], [0b11100, 1])], "x array<long>, y array<long>")
    value = packed.select(similarity.tanimoto_packed(F.col("x"), F.col("y"))).first()[0]
    assert value == pytest.approx(3 / 5)


def test_library_layouts(spark, work):
    spark.createDataFrame(
        [("C", [1.0, 2.0], "K")], "smiles string, cls_embedding array<double>, inchikey string"
    ).write.parquet(work)
    library = tables.read_library(spark, work, tables.CHEMBERTA_COLUMNS)
    assert library.columns == ["library_id", "smile", "embedding", "inchikey"]
    assert library.first().embedding == [1.0, 2.0]


@pytest.mark.parametrize("tile_rows", [5, 37, 4096])
def test_a_laid_out_library_equals_brute_force(spark, work, tile_rows):
    queries, library = data()
    matching.write_by_mass(spark.createDataFrame(library, LIBRARY), work, tile_rows, buckets=3)
    asked = spark.createDataFrame(queries, QUERY)
    for n in (1, 40):
        same(ranked(matching.top_of_laid_out(asked, work, n)), brute(queries, library, n))
    # Another session knows the files only.
    spark.sql(f"DROP TABLE {matching._table_name(work)}")
    same(ranked(matching.top_of_laid_out(asked, work)), brute(queries, library, 5))
    unmatched = asked.where("mass_key is null or mass_key = 99")
    assert matching.top_of_laid_out(unmatched, work).count() == 0


def test_rows_of_a_laid_out_library_are_not_moved(spark, work):
    queries, library = data(hot=False)
    columns = "library_id long, smile string, inchikey string, mass_key long, embedding array<float>, fp_bits array<int>"
    rows = [(*r, [1, 2]) for r in library]
    matching.write_by_mass(spark.createDataFrame(rows, columns), work, 40, buckets=3)
    asked = spark.createDataFrame(queries, QUERY)
    top = matching.top_of_laid_out(asked, work, library_columns=("smile", "inchikey", "fp_bits"))
    assert all(r.fp_bits == [1, 2] for r in top.collect())
    plan = top._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    side = plan[plan.index("FlatMapCoGroupsInArrow"):]
    # The library is the second side of the cogroup: no shuffle between it and its scan.
    library_side = side[side.rindex("hashpartitioning(mass_slot"):]
    assert "Bucketed: true" in library_side and library_side.count("Exchange hashpartitioning") == 0
    assert plan.count("Exchange hashpartitioning(mass_slot") == 1
