from collections import defaultdict

import numpy as np
import pytest

from peakwise.llm import embedding_dedup, queries

SF_DIR = "/root/testdata/sf0.01"


def brute(rows, threshold=0.95, kind=np.float32):
    """``(vec_id, n_links, component_id, kept)`` by all pairs, in double precision."""
    sound = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v)
             and any(v) for _, v in rows]
    vectors = [np.array(v, kind).astype(float) if s else None for (_, v), s in zip(rows, sound)]
    # Cosines do not depend on the scale; powers of two round nothing.
    vectors = [v if v is None else np.ldexp(v, -np.frexp(np.abs(v).max())[1]) for v in vectors]
    root = list(range(len(rows)))
    links = [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(vectors):
        for j in range(i):
            b = vectors[j]
            if a is None or b is None or len(a) != len(b):
                continue
            if a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b)) >= threshold:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    members = defaultdict(list)
    for i, (x, _) in enumerate(rows):
        members[find(i)].append(x)
    least = [min(members[find(i)]) for i in range(len(rows))]
    return sorted((x, links[i], least[i], x == least[i]) for i, (x, _) in enumerate(rows))


def got(df):
    return sorted(map(tuple, df.select("vec_id", "n_links", "component_id", "kept").collect()))


def test_query_against_all_pairs(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding")
    df = queries.op6_embedding_near_dedup(spark, SF_DIR)
    assert got(df) == brute([tuple(r) for r in rows.collect()])


@pytest.mark.parametrize("tile_rows", [16, 100_000])
def test_clusters_copies_scaled_copies_and_unusable_vectors(spark, monkeypatch, tile_rows):
    monkeypatch.setattr(embedding_dedup, "TILE_ROWS", tile_rows)
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(9, 8))
    rows = [(i, (centres[rng.integers(0, 9)] + rng.normal(size=8) * 0.15).tolist())
            for i in range(220)]
    rows += [(300 + i, rows[5][1]) for i in range(30)]
    rows += [(400 + i, [2 * x for x in rows[i][1]]) for i in range(15)]
    rows += [(500, None), (501, []), (502, [0.0] * 8), (503, [float("nan")] * 8),
             (504, [None] + [1.0] * 7), (505, [1.0, 2.0]), (506, [2.0, 4.1]),
             (507, [float("inf")] * 8), (508, [-0.0] * 8)]
    frame = spark.createDataFrame(
        [(*r, "a", 1) for r in rows], "vec_id bigint, embedding array<float>, kept string, uid int")
    df = embedding_dedup.embedding_components(frame)
    expected = brute(rows)
    assert sum(r[1] for r in expected) > 1000
    assert got(df) == expected


def test_empty_table_and_rows_without_id(spark):
    schema = "vec_id bigint, embedding array<float>"
    assert embedding_dedup.embedding_components(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, [1.0, 0.0]), (4, [1.0, 0.0]), (None, [0.0, 1.0]), (4, [1.0, 0.01])]
    found = embedding_dedup.embedding_components(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.n_links, r.component_id or -1, r.kept) for r in found) == [
        (0, -1, False), (2, 4, False), (2, 4, True), (2, 4, True)]


def test_doubles_at_the_threshold_and_at_any_scale(spark):
    def at(cosine, scale=1.0):
        return [cosine * scale, (1 - cosine * cosine) ** 0.5 * scale]

    rows = [(1, [1.0, 0.0]), (2, at(0.95 + 1e-9)), (3, [-x for x in at(0.95 - 1e-9)]), (4, [-1.0, 0.0]),
            (5, [0.0, 1e300]), (6, [0.0, 2e300]), (7, [0.0, -1e-60]), (8, [0.0, -3e-60]),
            (9, [0.0, -5e-324])]
    frame = spark.createDataFrame(
        [(*r, "v", 2) for r in rows],
        "vec_id bigint, embedding array<double>, _vector string, `a.b` int")
    df = embedding_dedup.embedding_components(frame)
    assert df.columns == ["vec_id", "_vector", "a.b", "n_links", "component_id", "kept"]
    expected = brute(rows, kind=np.float64)
    assert [r[1] for r in expected] == [1, 1, 0, 0, 1, 1, 2, 2, 2]
    assert got(df) == expected


def test_random_doubles_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "TILE_ROWS", 16)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 6))
    rows = [(i, ((centres[rng.integers(12)] + rng.normal(size=6) * 0.2)
                 * 10.0 ** rng.integers(-200, 200)).tolist()) for i in range(250)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    expected = brute(rows, kind=np.float64)
    assert sum(r[1] for r in expected) > 1000
    assert got(embedding_dedup.embedding_components(frame)) == expected


def test_vectors_go_to_tiles_within_reach_only():
    """Tiles that hold a partner are always among those asked, and most others are not."""
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(4000, 24)) * np.geomspace(3, 0.05, 24)
    tiles = embedding_dedup.Tiles(vectors, 64, 0.95)
    turned = tiles.turned(vectors)
    home = tiles.home(turned)
    row, tile = tiles.near(turned, home)
    asked = set(zip(row.tolist(), tile.tolist()))
    assert len(asked) == len(row) < 4000 * 12  # 32 later tiles on average
    close = turned @ turned.T >= 0.95
    for i, j in zip(*np.nonzero(close)):
        if home[j] > home[i]:
            assert (i, home[j]) in asked
