import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from peakwise.llm import mixing, queries

SF_DIR = "/root/testdata/sf0.001"


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def fill(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Targets by dealing out again and again what is above the cap."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = share * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(most * sizes[s] for s in capped)
        rate = left / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if weight[s] * rate > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in capped else weight[s] * rate for s in names}
        capped |= over


def taken(rows):
    """``(doc_id, size, taken)`` by walking through each source in key order."""
    sizes = {}
    for _, source, text in rows:
        sizes[source] = sizes.get(source, 0) + words(text)
    goal = fill(sizes)
    result = []
    for source in sizes:
        key = lambda r: (hashlib.md5(str("" if r[0] is None else r[0]).encode()).hexdigest(),
                         words(r[2]))
        own = sorted((r for r in rows if r[1] == source), key=key)
        budget = int(goal[source] + 0.5)
        epochs, rest = divmod(budget, sizes[source]) if sizes[source] else (0, 0)
        for r in own:
            n = words(r[2])
            part = min(n, rest)
            rest -= part
            result.append((r[0], n, epochs * n + part))
    order = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    return sorted(result, key=order), goal


EDGES = [
    (1, "b", "one two three"), (2, "b", None), (3, "b", ""), (4, "a", "x " * 2000),
    (5, None, "null source"), (6, None, None), (7, "B", "\x0bodd\x0cspaces\rhere"),
    (8, "é", "a b c"), (9, "b", "four five"), (9, "b", "four five"), (9, "b", "six"),
    (None, "b", "no id at all"), (11, "empty", ""), (12, "a", "y z"),
]


def check(spark, rows, df):
    expected, goal = taken(rows)
    order = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    got = df.collect()
    assert sorted(((r.doc_id, r.size, r.taken) for r in got), key=order) == expected
    for r in got:
        assert r.taken <= 2 * r.size
    return goal


def test_query_against_a_walk_through_each_source(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "source", "text")
    check(spark, list(map(tuple, docs.collect())), queries.op7_mix_sources(spark, SF_DIR))


def test_nulls_ties_and_clashing_columns(spark):
    rows = [(*r, 1, "k") for r in EDGES]
    docs = spark.createDataFrame(
        rows, "doc_id bigint, source string, text string, size int, _key string")
    for range_rows in (20_000, 1):
        df = mixing.mix(docs, range_rows=range_rows)
        goal = check(spark, EDGES, df)
        assert df.count() == len(EDGES) and "_key" in df.columns
        for r in df.collect():
            assert abs(r.target - goal[r.source]) < 1e-6


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, source string, text string")
    assert mixing.mix(docs).count() == 0
    assert mixing.mixed_documents(docs).count() == 0


def test_the_mix_holds_the_words_taken(spark):
    docs = spark.createDataFrame(
        [(*r, "x") for r in EDGES], "doc_id bigint, source string, text string, taken string")
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    shares = {}
    for r in mixing.mix(docs).collect():
        shares[r.doc_id] = shares.get(r.doc_id, 0) + r.taken
    rows = mixed.collect()
    for doc_id, total in shares.items():
        assert sum(words(r.text) for r in rows if r.doc_id == doc_id) == total
    texts = {t for _, _, t in EDGES if t}
    assert all(any(t.startswith(r.text) for t in texts) for r in rows)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(0, 50), min_size=1, max_size=7))
def test_targets(spark, sizes):
    table = {f"s{i}": n for i, n in enumerate(sizes)}
    frame = spark.createDataFrame(list(table.items()), "source string, source_size bigint")
    got = {r.source: r.target for r in mixing.targets(frame).collect()}
    expected = fill(table)
    assert all(abs(got[s] - expected[s]) < 1e-6 for s in table)


def test_half_of_the_rows_without_an_id_or_with_one_id(spark):
    """Ranges stay small and the words taken are those of a walk in key order."""
    from pyspark.sql import functions as F

    rows = [(i, "ab"[i % 2], "w " * (i % 40 + 1)) for i in range(1000)]
    rows += [(None, "ab"[i % 2], "v " * (i % 3)) for i in range(1000)]
    rows += [(7, "a", "one two")] * 600
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string").repartition(6)
    check(spark, rows, mixing.mix(docs, range_rows=50))
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    keyed = docs.select(
        F.col("source").alias("_source"), mixing.word_count(F.col("text")).alias("size"),
        key.alias("_key"), F.substring(key, 1, 1).alias("_prefix"),
        F.lpad(F.hex(F.xxhash64(F.monotonically_increasing_id())), 16, "0").alias("_tie"))
    ranged = mixing._with_ranges(keyed, 50)
    sizes = [r["count"] for r in ranged.groupBy("_source", "_range").count().collect()]
    assert sum(sizes) == len(rows) and max(sizes) <= 4 * 50
    ordered = ranged.orderBy("_source", "_range", "_key", "size", "_tie").collect()
    plain = ranged.orderBy("_source", "_key", "size", "_tie").collect()
    assert ordered == plain


def test_frames_that_are_no_parquet_files(spark, work):
    spark.createDataFrame([(1, "a", "x y z"), (2, "b", "u v")], "doc_id bigint, source string, text string"
                          ).write.option("header", True).csv(work)
    docs = spark.read.schema("doc_id bigint, source string, text string").option("header", True).csv(work)
    mixed = mixing.mixed_documents(docs)
    assert sum(words(r.text) for r in mixed.collect()) == sum(r.taken for r in mixing.mix(docs).collect())
