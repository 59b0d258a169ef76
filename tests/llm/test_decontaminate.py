import re

import numpy as np
import pytest

from peakwise.llm import decontaminate, queries

SF_DIR = "/root/testdata/sf0.01"


def least_edits(item, text):
    """Fewest word edits between an item and any run of a text's words."""
    row = [0] * (len(text) + 1)
    for i, w in enumerate(item, 1):
        new = [i]
        for j, v in enumerate(text, 1):
            new.append(min(row[j - 1] + (w != v), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def words(text):
    return re.findall(r"\w+", (text or "").lower())


def test_query_finds_every_passage_and_no_other(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()
    got = queries.op10_benchmark_decontamination(spark, SF_DIR).collect()
    texts, asked = {d.doc_id: words(d.text) for d in docs}, {i.item_id: words(i.text) for i in items}
    joined = {d: " ".join(["", *w, ""]) for d, w in texts.items()}
    exact = {(d, i) for d, t in joined.items() for i, w in asked.items()
             if " ".join(["", *w, ""]) in t}
    found = {(r.doc_id, r.item_id) for r in got}
    assert len(found) == len(got) and exact <= found and exact
    for r in got:
        assert r.edits == least_edits(asked[r.item_id], texts[r.doc_id])
        assert r.edits <= len(asked[r.item_id]) // 5 and r.n_words == len(asked[r.item_id])
        passage = texts[r.doc_id][r.start_word : r.end_word]
        assert least_edits(asked[r.item_id], passage) == r.edits


def edited(rng, item, edits, vocabulary):
    out = list(item)
    for _ in range(edits):
        at, kind = int(rng.integers(0, len(out))), rng.integers(0, 3)
        if kind == 0:
            out[at] = "edit" + str(rng.choice(vocabulary))
        elif kind == 1:
            out.insert(at, str(rng.choice(vocabulary)))
        else:
            del out[at]
    return out


@pytest.mark.parametrize("common", [False, True])
def test_recall_of_edited_passages(spark, common):
    """Items of rare words, and items whose words every item has."""
    rng = np.random.default_rng(5 + common)
    vocabulary = [f"w{i}" for i in range(60 if common else 5000)]
    items = [(i, list(map(str, rng.choice(vocabulary, int(n))))) for i, n in
             enumerate(rng.integers(10, 50, 25))]
    rows, truth = [], {}
    for k in range(250):
        i, item = items[int(rng.integers(0, len(items)))]
        most = int(len(item) * 0.2)
        body = edited(rng, item, int(rng.integers(0, most + 1)), vocabulary)
        noise = list(map(str, rng.choice([f"n{i}" for i in range(300)], 120)))
        rows.append((k, " ".join(noise[:60] + body + noise[60:])))
        truth[k] = i
    found = decontaminate.benchmark_passages(
        spark.createDataFrame(rows, "doc_id bigint, text string"),
        spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id bigint, text string"),
    ).collect()
    pairs = {(r.doc_id, r.item_id) for r in found}
    assert sum((k, i) in pairs for k, i in truth.items()) >= 0.95 * len(truth)
    texts, asked = dict(rows), dict(items)
    for r in found[:60]:
        assert least_edits(asked[r.item_id], words(texts[r.doc_id])) == r.edits


EDGES = [
    (1, None), (2, ""), (3, "..."), (4, "one two three"), (5, "x one, TWO (three) y"),
    (6, "alpha beta gamma delta epsilon zeta eta theta iota kappa"),
    (7, "alpha beta GAMMA delta epsilon zeta eta theta iota changed"),
    (7, "nothing of it"), (None, "one two three"), (8, "one two four"), (9, "filler " * 60_000 + "one two three"),
]
ITEMS = [(1, "one two three"), (2, "Alpha beta gamma, delta epsilon zeta; eta theta iota kappa."),
         (3, None), (4, ""), (None, "nothing of it"), (5, "one two three")]


@pytest.mark.parametrize("slice_words", [2_000_000, 4])
def test_nulls_ties_short_items_and_long_texts(spark, slice_words):
    docs = spark.createDataFrame([(*r, "q") for r in EDGES], "doc_id bigint, text string, edits string")
    items = spark.createDataFrame([(*r, 0) for r in ITEMS], "item_id bigint, text string, doc_id int")
    got = decontaminate.benchmark_passages(docs, items, slice_words=slice_words).collect()
    found = {(r.doc_id, r.item_id): (r.edits, r.start_word, r.end_word) for r in got}
    assert found == {
        (4, 1): (0, 0, 3), (4, 5): (0, 0, 3), (5, 1): (0, 1, 4), (5, 5): (0, 1, 4),
        (None, 1): (0, 0, 3), (None, 5): (0, 0, 3), (9, 1): (0, 60_000, 60_003),
        (9, 5): (0, 60_000, 60_003), (6, 2): (0, 0, 10), (7, 2): (1, 0, 9),
    }


def test_clean_documents_stay_row_by_row(spark):
    docs = spark.createDataFrame([(*r, "q") for r in EDGES], "doc_id bigint, text string, item_id string")
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    kept = decontaminate.clean_documents(docs, items)
    assert kept.columns == docs.columns
    # Row 7 that holds "nothing of it" goes too: an item needs no id to be kept out.
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 8]
    assert decontaminate.clean_documents(docs.limit(0), items).count() == 0
    assert decontaminate.clean_documents(docs, items.limit(0)).count() == len(EDGES)


def test_slices_count_words_of_every_script(spark):
    items = spark.createDataFrame(
        [(i, f"слово δέκα 漢字 {chr(0x430 + i % 20) * (i + 1)}") for i in range(40)], "item_id bigint, text string")
    indices = list(decontaminate._slices_of(items, 0.2, 0.98, 40))
    assert len(indices) > 2 and max(i.lengths.sum() for i in indices) < 120
    assert sorted(x for i in indices for x in i.item_ids) == list(range(40))


@pytest.mark.parametrize("n_words", [70, 300, 600, 1000])
def test_recall_of_long_items(spark, n_words):
    """Passages with as many edits as allowed, all over or all in one place."""
    rng = np.random.default_rng(n_words)
    vocabulary = [f"w{i}" for i in range(3000)]
    items = [(f"item {i}", list(map(str, rng.choice(vocabulary, n_words + i)))) for i in range(4)]
    rows, truth = [], {}
    for k in range(40):
        i, item = items[k % 4]
        most = int(len(item) * 0.2)
        body = edited(rng, item, most, vocabulary)
        if k % 5 == 0:
            at = int(rng.integers(0, len(item) - most))
            body = item[:at] + [f"x{j}" for j in range(most)] + item[at + most :]
        noise = list(map(str, rng.choice(vocabulary, 200)))
        rows.append((f"doc {k}", " ".join(noise[:90] + body + noise[90:])))
        truth[f"doc {k}"] = i
    found = decontaminate.benchmark_passages(
        spark.createDataFrame(rows, "doc_id string, text string").repartition(8),
        spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id string, text string"),
    ).collect()
    pairs = {(r.doc_id, r.item_id) for r in found}
    assert len(pairs & set(truth.items())) >= 0.95 * len(truth)
    texts, asked = dict(rows), dict(items)
    for r in found[:3]:
        assert least_edits(asked[r.item_id], words(texts[r.doc_id])) == r.edits


def test_a_recall_that_walks_miss_is_refused(spark):
    items = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(60)))], "item_id int, text string")
    docs = spark.createDataFrame([(1, "a")], "doc_id int, `a.b` string")
    with pytest.raises(ValueError, match="recall"):
        decontaminate.benchmark_passages(docs, items, edit_share=0.6, text="a.b")
    assert decontaminate.benchmark_passages(docs, items, text="a.b").count() == 0
    assert decontaminate.clean_documents(docs, items, text="a.b").columns == ["doc_id", "a.b"]
