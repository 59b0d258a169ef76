import zlib

import numpy as np
import pytest

from peakwise.llm import queries, toxicity

SF_DIR = "/root/testdata/sf0.01"


def documents(n=600):
    """Every tenth document holds words that no other has."""
    rng = np.random.default_rng(1)
    common = ["".join(rng.choice(list("aeioulnrst"), 5)) for _ in range(200)]
    rows, labels = [], []
    for i in range(n):
        words = list(rng.choice(common, 40))
        if i % 10 == 0:
            words[3:3] = ["zqfool" + str(rng.choice(["s", "ed", "ish"]))]
        rows.append((i, " ".join(words)))
        labels.append((i, 0, int(i % 10 == 0)))
    return rows, labels


def frames(spark, rows, labels):
    return (
        spark.createDataFrame(rows, "doc_id bigint, text string"),
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
    )


def test_held_out_accuracy(spark):
    docs, labels = frames(spark, *documents())
    rows = toxicity.fit(docs, labels).score(docs).collect()
    held_out = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(held_out) > 90
    assert all(r.predicted == (r.doc_id % 10 == 0) for r in held_out)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_held_out_labels_are_never_learnt_from(spark):
    rows, labels = documents(300)
    fold = lambda i: zlib.crc32(str(i).encode()) % 5
    turned = [(i, q, 1 - t if fold(i) == 0 else t) for i, q, t in labels]
    scores = []
    for some in (labels, turned):
        docs, known = frames(spark, rows, some)
        scores.append({r.doc_id: r.score for r in toxicity.fit(docs, known).score(docs).collect()})
    assert scores[0] == scores[1]


def test_query(spark):
    df = queries.op1_toxicity(spark, SF_DIR)
    assert df.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = df.collect()
    assert len(rows) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    toxic = [r.score for r in rows if r.held_out and labels.get(r.doc_id) == 1]
    clean = [r.score for r in rows if r.held_out and labels.get(r.doc_id) == 0]
    wins = np.mean([[(a > b) + (a == b) / 2 for b in clean] for a in toxic])
    assert wins > 0.85
    assert np.mean(np.array(clean) >= 0.5) < 0.03


def test_nulls_empty_texts_clashing_columns_and_repeated_rows(spark):
    rows, labels = documents(300)
    docs, known = frames(spark, rows, labels + [(None, 1, 1), (1, 1, None), (2, 0, 0)])
    model = toxicity.fit(docs, known)
    odd = [(1, None, "a", 9), (2, "", "b", 9), (None, "zqfools here", "c", 9), (2, "", "b", 9),
           (3, "?! ...", "d", 9), (4, "word " * 30_000, "e", 9)]
    schema = "doc_id bigint, text string, score string, __features int"
    frame = spark.createDataFrame(odd, schema)
    found = model.score(frame).collect()
    assert len(found) == len(odd)
    assert len({r.score for r in found if not r.text or r.text == "?! ..."}) == 1
    kept = toxicity.ordinary_documents(spark.createDataFrame(
        [(i, t, "x", 1) for i, t in rows] + odd, schema), known)
    assert kept.columns == frame.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(2) == 3 and 10 not in ids and 11 in ids


def test_without_labels_nothing_is_toxic(spark):
    rows, labels = documents(100)
    for some in ([], [x for x in labels if not x[2]]):
        docs, known = frames(spark, rows, some)
        found = toxicity.fit(docs, known).score(docs).collect()
        assert {(r.score, r.predicted) for r in found} == {(0.0, 0)}
    docs, known = frames(spark, [], labels)
    assert toxicity.fit(docs.limit(0), known.limit(0)).score(docs.limit(0)).count() == 0


def test_letters_of_a_known_word_are_near_certain_in_its_class(spark):
    rows = [(1, "badword")] * 5 + [(0, "goodword")] * 5
    shares, backoffs = toxicity.fit_evidence(
        spark.createDataFrame(rows, "cls int, text string"))
    evidence = toxicity.WordEvidence(shares, backoffs)
    evidence.learn(["badword", "goodword", "unseen"])
    assert evidence["badword"] > 2 > abs(evidence["unseen"]) and evidence["goodword"] < -2


def test_backoff_shares_sum_to_one(spark):
    """Over all letters seen after a context, share and backoff weight make up one."""
    rows = [(c, t) for c, t in [(1, "abab"), (1, "abac"), (0, "aabb"), (0, "abcd")] * 3]
    shares, backoffs = toxicity.fit_evidence(spark.createDataFrame(rows, "cls int, text string"))
    letters, place, _ = toxicity._spelt(["ab" + x for x in "abcdefgh" + toxicity.END])
    grams = toxicity._grams(letters, place)
    at = np.flatnonzero(place == 3)
    for cls in (0, 1):
        own = np.unique(toxicity._slot(grams[4])[at])
        context = toxicity._slot(grams[3])[at[0] - 1]
        total = shares[cls, 4][own].sum() + backoffs[cls, 4][context]
        assert abs(total - 1) < 1e-5


def test_no_two_grams_share_a_count(spark):
    """Shares of many random words against counts by their letters."""
    from collections import Counter, defaultdict

    rng = np.random.default_rng(5)
    words = sorted({"".join(rng.choice(list("abcdefghijklmnopqrstuvwxyzäжб漢"), 9))
                    for _ in range(40_000)})
    rows = [(0, " ".join(words[i : i + 500])) for i in range(0, len(words), 500)]
    shares, backoffs = toxicity.fit_evidence(spark.createDataFrame(rows, "cls int, text string"))
    counts, totals, kinds = Counter(), Counter(), defaultdict(set)
    for word in words:
        marked = toxicity.START + word + toxicity.END
        for i in range(1, len(marked)):
            counts[marked[max(0, i - 5) : i + 1]] += 1
    for gram, n in counts.items():
        totals[gram[:-1]] += n
        kinds[gram[:-1]].add(gram)
    letters, place, word = toxicity._spelt(words[:2000])
    grams = toxicity._grams(letters, place)
    at = np.flatnonzero(place > 0)
    found = shares[0, 6][toxicity._slot(grams[6])[at]]
    weights = backoffs[0, 6][toxicity._slot(toxicity._before(grams[5]))[at]]
    marked = [toxicity.START + w + toxicity.END for w in words[:2000]]
    own = [m[max(0, i - 5) : i + 1] for m in marked for i in range(1, len(m))]
    expected = [(counts[g] - toxicity.DISCOUNT) / totals[g[:-1]] for g in own]
    assert np.abs(found - expected).max() < 1e-6
    expected = [toxicity.DISCOUNT * len(kinds[g[:-1]]) / totals[g[:-1]] for g in own]
    assert np.abs(weights - expected).max() < 1e-6


def test_a_model_too_large_for_a_worker_is_refused(spark, monkeypatch):
    docs, labels = frames(spark, *documents(60))
    monkeypatch.setattr(toxicity, "MOST_GRAMS", 100)
    with pytest.raises(ValueError, match="more than the 100"):
        toxicity.fit(docs, labels)


def test_a_text_is_moved_once(spark, monkeypatch):
    moved = []
    with_features = toxicity._with_features

    def spied(rows, *others):
        moved.append(rows.schema.simpleString().lower().count("text:"))
        return with_features(rows, *others)

    monkeypatch.setattr(toxicity, "_with_features", spied)
    docs, labels = frames(spark, *documents())
    found = toxicity.ordinary_documents(docs, labels)
    assert moved[-1] == 1
    assert sorted(r.doc_id for r in found.collect() if r.doc_id % 10) == [
        i for i in range(600) if i % 10]
    assert dict(found.collect()).items() <= dict(docs.collect()).items()
    named = toxicity.ordinary_documents(docs.withColumnRenamed("text", "Text"), labels)
    assert named.columns == ["doc_id", "Text"]
    assert sorted(named.collect()) == sorted(found.collect())
