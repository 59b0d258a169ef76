import random
import re
import zlib
from collections import Counter

import pytest

from peakwise.llm import queries, spelling

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, word string, `n.id` int, key string"


def near(a, b):
    """Whether one code point inserted, deleted or replaced makes one word of the other."""
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_force(docs, length=7, least=2, every=31):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= length and n >= least}
    found = {}
    for w, n in words.items():
        others = [v for v in words if abs(len(v) - len(w)) < 2 and near(w, v)]
        best = min(others, key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] < 10 * n:
            best = None
        found[w] = (best, n, len(others), words.get(best))
    rows = []
    for w, (form, n, others, form_n) in found.items():
        root = w
        while found[root][0] is not None:
            root = found[root][0]
        rows.append((w, form, root, n, others, form_n))
    return sorted(rows, key=str)


def variants(spark, docs, **options):
    df = spark.createDataFrame([(i, t, "x", 1, "k") for i, t in docs], SCHEMA)
    got = spelling.spelling_variants(df, **options)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, got.collect()), key=str)


def test_random_words_of_few_letters(spark, monkeypatch):
    """Runs of equal letters, ties, chains of forms, words of one letter more or less; sides
    named by digests from a length that words pass and reach."""
    rng = random.Random(8)
    docs = []
    for i in range(400):
        words = ["".join(rng.choices("aab×", k=rng.choice([6, 7, 8, 9, 10]))) for _ in range(9)]
        words += rng.choices(["abababa", "abababab", "aaaaaaa"], [100, 10, 1], k=20)
        docs.append((rng.choice([i, None, 7]), rng.choice([" ", "1", "\n-"]).join(words)))
    wanted = brute_force(docs, every=7)
    assert any(r[1] and r[1] != r[2] for r in wanted) and any(r[4] > 4 for r in wanted)
    assert variants(spark, docs, every=7) == wanted
    for name, rows in (("short", 64), ("digests", 8), ("all", 0)):
        keys = {}
        monkeypatch.setattr(spelling, "LONG", rows)
        for w in {r[0] for r in wanted}:
            for key, x, counts in spelling.rotations_of(w):
                keys.setdefault(key, {})[x] = (w, counts)
        pairs = Counter()
        for group in keys.values():
            for x, (a, a_counts) in group.items():
                for y, (b, b_counts) in group.items():
                    if a < b and (x or b_counts) and (y or a_counts):
                        pairs[a, b] += 1
        assert set(pairs.values()) <= {1}, name
        assert len(pairs) * 2 == sum(r[4] for r in wanted), name


def test_long_words_and_texts(spark):
    rng = random.Random(9)
    long = "".join(rng.choices("abcdé", k=5000))
    texts = [long, long[:900] + long[901:], long + "a", "B" + long, long[:64], long[:65], long[:66],
             long[1:65], "a" * 3000, "a" * 3001, long[:70], long[:40] + "z" + long[41:70]]
    docs = [(i, " ".join(t for t in texts)) for i in range(3)]
    docs += [(9, " ".join([long] * 40 + ["short"] * 100_000))]
    assert variants(spark, docs) == brute_force(docs)


def test_nulls_case_and_nothing(spark):
    docs = [(None, None), (1, ""), (1, "Straßen STRAßEN Éclairs éclairs Éclairs"),
            (1, "Straßen"), (2, "x" * 6 + " 1234567 ______ a-b"), (3, "Wörterbuch Wörterbuch")]
    got = variants(spark, docs)
    assert got == brute_force(docs)
    assert {"straßen", "Éclairs"} <= {r[0] for r in got}
    assert variants(spark, docs[:2]) == [] and variants(spark, []) == []
    with pytest.raises(ValueError):
        variants(spark, docs, factor=1)


def test_few_words_are_counted_at_a_time(spark, monkeypatch):
    """Closures carry module globals of tasks' own; a text over the bound is counted whole."""
    rng = random.Random(10)
    docs = [(i, " ".join("".join(rng.choices("abcdefgh", k=7)) for _ in range(50)) + " abcdefgh")
            for i in range(200)]
    df = spark.createDataFrame([(i, t, "x", 1, "k") for i, t in docs], SCHEMA)
    monkeypatch.setattr(spelling, "COUNTED", 10)
    counted = spelling.word_counts(df, least=1)
    words = counted.collect()
    assert [r.word for r in sorted(words, key=lambda r: r.id)] == sorted(r.word for r in words)
    assert sum(r.n for r in words if r.word == "abcdefgh") > 150


def test_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in
            spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, queries.op11_spelling_variants(spark, SF_DIR).collect()), key=str)
    assert got == brute_force(docs) and any(r[1] for r in got)
