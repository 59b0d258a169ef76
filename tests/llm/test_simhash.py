import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from peakwise.llm import components, queries, simhash

SF_DIR = "/root/testdata/sf0.001"


def fingerprint(text):
    data = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    words = re.findall(rb"[^\x20\x09-\x0D]+", data)
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def least_reachable(ids, linked):
    """Smallest id of each position's component, by trying all pairs."""
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i + 1, len(ids)):
            if linked(i, j):
                root[find(i)] = find(j)
    members = defaultdict(list)
    for i, x in enumerate(ids):
        members[find(i)].append(x)
    return [min((x for x in members[find(i)] if x is not None), default=None)
            for i in range(len(ids))]


def expected(rows):
    prints = [fingerprint(t) for _, t in rows]
    least = least_reachable(
        [i for i, _ in rows], lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4
    )
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    return sorted(((rows[i][0], f"{prints[i]:016x}", least[i]) for i in range(len(rows))), key=key)


def found(df):
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    return sorted(map(tuple, df.collect()), key=key)


def test_query_against_all_pairs(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    df = queries.op2_simhash_near_dedup(spark, SF_DIR)
    assert df.columns == ["doc_id", "fingerprint", "component_id"]
    assert found(df) == expected([(r.doc_id, r.text) for r in docs])


EDGES = [
    (1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one  TWO"), (5, "one  TWO"),
    (None, "a b c d e f"), (7, "a b c d e f"), (8, "a b c d"), (9, "É b c d e"),
    (10, "é b c d e"), (11, "x " * 70_000), (12, "a\x0bb c d e"), (None, "lonely words here now"),
]


def test_nulls_empty_long_repeated_rows_and_clashing_columns(spark):
    rows = [(i, t, "x", -1, None) for i, t in EDGES]
    schema = "doc_id bigint, text string, fp string, component_id int, `__others` string"
    df = simhash.simhash_components(spark.createDataFrame(rows, schema))
    assert df.count() == len(rows)
    from pyspark.sql import functions as F

    df = df.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0"), "component_id")
    assert found(df) == expected(EDGES)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert simhash.simhash_components(docs).count() == 0
    assert simhash.one_per_component(docs).count() == 0


def test_one_document_of_each_component_stays(spark):
    rows = [(i, t, "s") for i, t in EDGES]
    kept = simhash.one_per_component(
        spark.createDataFrame(rows, "doc_id bigint, text string, component_fp string")
    )
    assert kept.columns == ["doc_id", "text", "component_fp"]
    classes = {c for _, _, c in expected(EDGES) if c is not None}
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(classes)
    assert ids.count(None) == 1


@pytest.mark.parametrize("distance", [0, 1, 4, 5])
def test_a_home_anchor_is_in_reach_of_every_near_fingerprint(distance):
    rng = np.random.default_rng(distance)
    a = rng.integers(0, 2**63, 300, dtype=np.int64)
    b = a.view(np.uint64).copy()
    for _ in range(distance):
        b ^= np.uint64(1) << rng.integers(0, 64, len(b)).astype(np.uint64)
    row, anchor, home = simhash.anchors(a, distance)
    homes = defaultdict(set)
    for r, x in zip(row[home].tolist(), anchor[home].tolist()):
        homes[r].add(x)
    row, anchor, _ = simhash.anchors(b.view(np.int64), distance)
    reach = defaultdict(set)
    for r, x in zip(row.tolist(), anchor.tolist()):
        reach[r].add(x)
    assert all(homes[r] & reach[r] for r in range(len(a)))


def test_crowded_anchors_are_split_and_lose_nothing(spark, monkeypatch):
    rng = np.random.default_rng(3)
    base = int(rng.integers(0, 2**62))
    values = {base}
    while len(values) < 300:
        value = base
        for bit in rng.integers(0, 64, rng.integers(0, 9)).tolist():
            value ^= 1 << bit
        values.add(value if value < 2**63 else value - 2**64)
    values = sorted(values)
    monkeypatch.setattr(simhash, "TILE_HOMES", 4)
    reps = spark.createDataFrame([(v,) for v in values], "fp bigint")
    mask = 2**64 - 1
    least = least_reachable(
        values, lambda i, j: ((values[i] ^ values[j]) & mask).bit_count() <= 4
    )
    for broadcast in (1_000_000, 0):
        monkeypatch.setattr(simhash, "BROADCAST_ANCHORS", broadcast)
        nodes = dict(map(tuple, components.connected_components(
            simhash.fingerprint_links(reps)).collect()))
        assert [nodes.get(v, v) for v in values] == least


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_links(spark, seed):
    rng = np.random.default_rng(seed)
    links = [tuple(map(int, p)) for p in rng.integers(0, 60, (45, 2))]
    links += [(100 + i, 101 + i) for i in range(40)] + [(5, None)]
    joined = {frozenset(p) for p in links}
    nodes = sorted({x for p in links for x in p if x is not None})
    least = least_reachable(nodes, lambda i, j: frozenset((nodes[i], nodes[j])) in joined)
    got = dict(map(tuple, components.connected_components(
        spark.createDataFrame(links, "a bigint, b bigint")).collect()))
    assert got == {n: c for n, c in zip(nodes, least) if n != c}


def test_rows_of_files_are_named_by_their_place(spark, work):
    from peakwise.llm.worker import numbered

    rows = [(i, t, "s") for i, t in EDGES]
    spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(
        3).write.parquet(work)
    docs = spark.read.parquet(work)
    named = numbered(docs, "rows")
    assert dict(named.dtypes)["__row"].startswith("struct<")
    assert named.select("__row").distinct().count() == len(rows)
    # A frame that may repeat a file's rows is written instead.
    twice = numbered(docs.unionByName(docs), "rows")
    assert twice.select("__row").distinct().count() == 2 * len(rows)
    kept = [r.doc_id for r in simhash.one_per_component(docs).collect()]
    classes = {c for _, _, c in expected(EDGES) if c is not None}
    assert sorted(i for i in kept if i is not None) == sorted(classes) and kept.count(None) == 1


def test_frames_of_csv_files_and_columns_with_dots(spark, work):
    rows = [(1, "one two three four five", "x"), (2, "one two three four five", "y"), (3, "six", "z")]
    spark.createDataFrame(rows, "doc_id bigint, text string, c string").write.csv(work)
    docs = spark.read.schema("doc_id bigint, text string, `a.b` string").csv(work)
    kept = simhash.one_per_component(docs)
    assert kept.columns == ["doc_id", "text", "a.b"]
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3]
    assert "a.b" in simhash.simhash_components(docs).columns
