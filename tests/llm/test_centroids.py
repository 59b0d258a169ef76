import hashlib
import math

import numpy as np
import pytest

from peakwise.llm import centroids, queries

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "vec_id bigint, embedding array<float>, cluster string, `__x.y` int, distance int"


def brute_force(rows, k, rounds, size, seed=2):
    """``(vec_id, cluster, distance)`` and centroids of plain integer clustering."""
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == size
            and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: "" if i is None else str(i)
    key = lambda r: (hashlib.sha256(f"{seed}:{name(r[0])}".encode()).hexdigest(), r[1])
    points = [v for _, v in sorted(kept, key=key)[:k]]

    def assign():
        found = []
        for _, v in kept:
            found.append(min((sum((a - b) ** 2 for a, b in zip(v, p)), c)
                             for c, p in enumerate(points)))
        return found

    for _ in range(rounds):
        found = assign()
        for c in range(len(points)):
            own = [v for (_, v), (_, at) in zip(kept, found) if at == c]
            if own:
                points[c] = [sum(x) // len(own) for x in zip(*own)]
    return [(i, c, d) for (i, _), (d, c) in zip(kept, assign())], points


def same(spark, rows, k, rounds, size):
    floats = lambda v: v and [x if x is None else float(x) for x in v]
    df = spark.createDataFrame([(i, floats(v), "x", 1, 2) for i, v in rows], SCHEMA)
    got, found = centroids.cluster_vectors(df, k, rounds, size, leading=2)
    wanted, points = brute_force(rows, k, rounds, size)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(wanted, key=key)
    assert found.points.tolist() == points
    return got, found


def test_unsound_vectors_ties_and_repeated_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.0, 1, 2]), (1, [0.0, 1, 2]), (1, [4.0, -1, -2]), (None, [1.0, 1, 1]), (2, None),
            (3, []), (4, [1.0, 2]), (5, [1.0, 2, 3, 4]), (6, [1.0, None, 3]), (7, [nan, 1, 1]),
            (8, [1.0, -inf, 1]), (9, [-0.001, 0.001, -3.5]), (None, [1.0, 1, 1]), (10, [2.0, 0, 0])]
    for k in (1, 3, 40):
        same(spark, rows, k, 3, 3)
    same(spark, rows[:2], 2, 4, 3)  # one of two equal centroids stays empty


def test_no_vectors_and_limits(spark):
    got, found = same(spark, [(1, None), (2, [1.0])], 4, 2, 3)
    assert centroids.with_inertia(got, found).count() == 0
    same(spark, [], 4, 2, 3)
    with pytest.raises(ValueError):
        centroids.cluster_vectors(spark.createDataFrame([], SCHEMA), k=1 << 20)
    far = spark.createDataFrame([(1, [1e30, 0.0])], "vec_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        centroids.cluster_vectors(far, 1, 1, 2)[0].collect()


def test_random_vectors_against_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), v.tolist()) for i, v in enumerate(np.round(rng.normal(size=(300, 4)), 1))]
    got, found = same(spark, rows, 7, 5, 4)
    whole = centroids.with_inertia(got, found).collect()
    distance = {c: sum(r.distance for r in whole if r.cluster == c) for c in range(7)}
    for r in whole:
        assert (r.cluster_inertia, r.inertia) == (distance[r.cluster], sum(distance.values()))
        text = ",".join(map(str, found.points[r.cluster].tolist()))
        assert r.centroid_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_bounds_rule_out_but_never_the_nearest():
    rng = np.random.default_rng(4)
    for scale in (1, 1000, 2**20):
        axes = np.linalg.qr(rng.normal(size=(64, 64)))[0]
        spread = axes * np.geomspace(1, 0.01, 64)
        middles = rng.normal(size=(40, 64)) @ spread.T
        vectors = middles[rng.integers(40, size=2000)] + 0.2 * rng.normal(size=(2000, 64)) @ spread.T
        vectors, points = (np.floor(scale * 30 * x).astype(np.int64) for x in (vectors, middles))
        plain = centroids.Centroids(points, vectors.mean(axis=0), axes)
        turned = plain.turned(vectors, 16).astype(np.float32).astype(np.float64)
        cluster, distance, measured = centroids.nearest(
            vectors, turned, points, plain.turned(points, 16))
        exact = np.array([np.square(vectors - p).sum(axis=1) for p in points]).T
        assert (cluster == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
        assert measured < 2000 * 10


def test_query_against_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in
            spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    wanted, _ = brute_force(rows, 40, 5, 64)
    got = queries.op13_centroid_clusters(spark, SF_DIR).collect()
    assert sorted((r.vec_id, r.cluster, r.distance) for r in got) == sorted(wanted)
