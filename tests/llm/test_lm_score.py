import functools
import math
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from peakwise.llm import lm_score, queries

SF_DIR = "/root/testdata/sf0.001"


def test_query(spark):
    rows = queries.op3_lm_score(spark, SF_DIR).collect()
    assert len(rows) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    for r in rows:
        assert (r.n_tokens == 0) == (r.mean_log_prob is None)
        if r.n_tokens:
            assert r.log_prob < 0 and math.isclose(r.mean_log_prob, r.log_prob / r.n_tokens)


def test_word_order_is_learnt(spark):
    """Each word follows from its neighbours; shuffled documents of the same words score less."""
    rng = np.random.default_rng(0)
    rows = []
    for i in range(300):
        start = int(rng.integers(0, 40))
        rows.append((i, " ".join(f"w{(start + k) % 40}" for k in range(400))))
    for i in range(30):
        rows.append((1000 + i, " ".join(rng.permutation(rows[i][1].split()))))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: r.mean_log_prob for r in lm_score.score_documents(docs).collect()}
    ordered = [found[i] for i in range(30)]
    shuffled = [found[1000 + i] for i in range(30)]
    assert min(ordered) > max(shuffled)
    assert np.mean(ordered) > -np.log(40) * 0.75


def test_scores_are_sums_of_conditional_log_probabilities():
    rng = np.random.default_rng(2)
    net = lm_score.Network.fresh()
    net.values += rng.normal(0, 0.2, len(net.values)).astype(np.float32)
    ids = rng.integers(0, lm_score.VOCABULARY, 30)
    padded, places, counts = lm_score._padded([ids[:10].astype("<u2").tobytes(), b"",
                                               ids[10:].astype("<u2").tobytes()])
    assert counts.tolist() == [10, 0, 20]
    got = net.log_probabilities(padded, places)
    for at, value in zip(places, got):
        hidden = net.hidden.astype(float).copy()
        for p, w in enumerate(lm_score.WINDOW):
            hidden += net.embedding[padded[at + w]].astype(float) @ net.position[p]
        hidden = np.tanh(hidden)
        total = 0.0
        chances = []
        for c in range(lm_score.CLASSES):
            outer = hidden @ net.classes + net.class_bias
            inner = hidden @ net.members[c] + net.member_bias[c]
            share = np.exp(outer[c]) / np.exp(outer).sum()
            chances.append(share * np.exp(inner) / np.exp(inner).sum())
            total += chances[-1].sum()
        assert abs(total - 1) < 1e-9
        assert abs(np.log(np.concatenate(chances)[padded[at]]) - value) < 1e-4


def test_gradient_of_a_step():
    """A step lowers the loss of its own batch."""
    rng = np.random.default_rng(4)
    context = rng.integers(0, 50, (64, 4))
    target = rng.integers(0, 50, 64)
    net = lm_score.Network.fresh()
    squares = np.full(net.SIZE, 0.01, np.float32)

    def loss():
        padded = np.concatenate([np.r_[c[:2], t, c[2:]] for c, t in zip(context, target)])
        return -net.log_probabilities(padded, np.arange(64) * 5 + 2).mean()

    before = loss()
    for _ in range(60):
        net.train(context, target, squares)
    assert loss() < before * 0.5


def test_vocabulary_counts_all_words(spark):
    docs = spark.createDataFrame([(1, "a A b!"), (2, None), (2, "a ?!")], "doc_id int, text string")
    counts = lm_score.word_counts(docs)
    assert dict(map(tuple, counts.collect())) == {"a": 3, "b": 1, "!": 1, "?!": 1}
    vocabulary = lm_score.fit_vocabulary(counts)
    place = {w: i for i, w in enumerate(vocabulary.words)}
    ids, n = vocabulary.encode(pa.array(["A new b", None, "", "new"]))
    assert n.tolist() == [3, 0, 0, 1] and ids[[0, 2]].tolist() == [place["a"], place["b"]]
    assert ids[1] == ids[3] == lm_score.VOCABULARY - lm_score.BUCKETS + lm_score.buckets(pa.array(["new"]))[0]


def test_words():
    texts = ["Don't  STOP_1!?\u00a0x²\n\tÉa--b", None, " ", "日本 🙂🙂"]
    words, counts = lm_score.words_of(pa.array(texts))
    assert counts.tolist() == [9, 0, 0, 2]
    assert words.to_pylist() == [
        "don", "'", "t", "stop_1", "!?", "x²", "éa", "--", "b", "日本", "🙂🙂"]
    for at in range(1, 5):
        words, counts = lm_score.words_of(pa.array(["x"] * at + texts).slice(at))
        assert counts.tolist() == [9, 0, 0, 2] and words[0].as_py() == "don"


def test_buckets_do_not_depend_on_the_neighbours():
    words = pa.array([f"word{i}" for i in range(500)])
    every = lm_score.buckets(words)
    assert every.tolist() == [lm_score.buckets(words.slice(i, 1))[0] for i in range(500)]
    assert np.bincount(every, minlength=lm_score.BUCKETS).min() > 0


def test_nulls_repeated_rows_clashing_columns_and_the_empty_table(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, "a b c", "x"), (3, "a b c", "x"), (3, "a b c", "x"),
            (4, "a b c " * 20_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, log_prob string")
    found = lm_score.score_documents(docs).collect()
    assert len(found) == len(rows)
    assert len({(r.n_tokens, r.log_prob) for r in found if r.n_tokens == 3}) == 1
    assert {(r.n_tokens, r.log_prob, r.mean_log_prob) for r in found if not r.n_tokens} == {(0, 0.0, None)}
    assert lm_score.score_documents(docs.limit(0)).count() == 0


def test_every_window_is_trained_on(spark):
    """In a text of period 16 each word stands at places of one residue only."""
    text = " ".join(f"w{k % 16}" for k in range(160_000))
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    (row,) = lm_score.score_documents(docs).collect()
    assert row.mean_log_prob > -1


def test_counterparts_are_sql():
    assert all(isinstance(sql, str) for sql in queries.ORACLES.values())


@functools.cache
def by_hand(texts):
    """Scores of documents in one partition from the definitions, one window at a time."""
    def words(text):
        return re.findall(r"\w+|[^\w\s]+", (text or "").lower())

    counts = Counter(w for t in texts for w in words(t))
    top = sorted(counts, key=lambda w: (-counts[w], w))[: lm_score.VOCABULARY - lm_score.BUCKETS]
    place = {w: i for i, w in enumerate(top)}
    slot = {w: int(lm_score.buckets(pa.array([w]))[0]) for w in counts if w not in place}
    total = Counter()
    for w, b in slot.items():
        total[b] += counts[w]
    ids = [[place.get(w, lm_score.VOCABULARY - lm_score.BUCKETS + slot.get(w, 0)) for w in words(t)]
           for t in texts]
    edge = lm_score.VOCABULARY
    windows = []
    for doc in ids:
        padded = [edge] * 2 + doc + [edge] * 2
        windows += [([padded[i + 2 + w] for w in lm_score.WINDOW], doc[i]) for i in range(len(doc))]
    net = lm_score.Network.fresh()

    def forward(context):
        hidden = net.hidden + sum(net.embedding[c] @ net.position[p] for p, c in enumerate(context))
        return np.tanh(hidden)

    def softmax(x):
        e = np.exp(x - x.max())
        return e / e.sum()

    for turn in range(lm_score.ROUNDS):
        net = lm_score.Network(net.values.copy())
        squares = np.full(net.SIZE, 0.01, np.float64)
        own = windows[turn :: lm_score.ROUNDS]
        full = len(own) // lm_score.BATCH * lm_score.BATCH
        order = list(np.random.default_rng(turn).permutation(full))
        batches = [order[i : i + lm_score.BATCH] for i in range(0, full, lm_score.BATCH)]
        batches.append(list(range(full, len(own))))
        for batch in filter(None, batches):
            grad = lm_score.Network(np.zeros(net.SIZE))
            for context, target in (own[i] for i in batch):
                hidden = forward(context)
                c, m = divmod(target, lm_score.PER_CLASS)
                outer, inner = softmax(hidden @ net.classes + net.class_bias), softmax(
                    hidden @ net.members[c] + net.member_bias[c])
                outer[c] -= 1
                inner[m] -= 1
                grad.classes += np.outer(hidden, outer)
                grad.class_bias += outer
                grad.members[c] += np.outer(hidden, inner)
                grad.member_bias[c] += inner
                back = (outer @ net.classes.T + inner @ net.members[c].T) * (1 - hidden**2)
                grad.hidden += back
                for p, token in enumerate(context):
                    grad.position[p] += np.outer(net.embedding[token], back)
                    grad.embedding[token] += net.position[p] @ back
            step = grad.values / len(batch)
            squares += step**2
            net.values -= (lm_score.RATE * step / np.sqrt(squares + 1e-8)).astype(np.float32)
    result = []
    at = 0
    for t, doc in zip(texts, ids):
        score = 0.0
        for w, target in zip(words(t), doc):
            hidden = forward(windows[at][0])
            at += 1
            c, m = divmod(target, lm_score.PER_CLASS)
            score += math.log(softmax(hidden @ net.classes + net.class_bias)[c])
            score += math.log(softmax(hidden @ net.members[c] + net.member_bias[c])[m])
            if w in slot:
                score += math.log(counts[w] / total[slot[w]])
        result.append((len(doc), score))
    return result


@pytest.mark.parametrize("known", [lm_score.KNOWN, 100, 0])
def test_whole_operator_against_brute_force(spark, monkeypatch, known):
    """Vocabulary, order of training steps, parameters and scores, with more distinct words than
    the vocabulary holds and steps of more than a batch."""
    monkeypatch.setattr(lm_score, "KNOWN", known)
    rng = np.random.default_rng(12)
    texts = []
    for i in range(60):
        rare = [f"rare{int(x)}" for x in rng.integers(0, 900, 60)]
        usual = [f"w{int(x)}" for x in rng.integers(0, 400, 140)]
        texts.append(" ".join(rng.permutation(usual + rare)) + ("! é" if i % 7 else ""))
    texts += [None, "", "rare1 rare1 once-only"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").coalesce(1)
    found = {r.doc_id: (r.n_tokens, r.log_prob) for r in lm_score.score_documents(docs).collect()}
    wanted = by_hand(tuple(texts))
    for i, (n, score) in enumerate(wanted):
        assert found[i][0] == n
        assert math.isclose(found[i][1], score, rel_tol=2e-4, abs_tol=1e-6), i


def test_the_vocabulary_grows_with_the_distinct_words(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "CLASSES", 3)
    docs = spark.range(3000).selectExpr("id", "concat('w', id, ' ', 'w', id div 2, ' x.y') AS `a.b`")
    counts = lm_score.word_counts(docs.withColumnRenamed("a.b", "text"))
    vocabulary = lm_score.fit_vocabulary(counts)
    assert vocabulary.classes == round(counts.count() ** 0.25) > 5
    assert len(vocabulary.words) == vocabulary.classes * (vocabulary.classes - 1)
    total = {r["word"]: r["n"] for r in counts.collect()}
    rest = [w for w in total if w not in set(vocabulary.words)]
    assert vocabulary.totals.sum() == sum(total[w] for w in rest)
    scored = lm_score.score_documents(docs, text="a.b").collect()
    assert len(scored) == 3000 and all(r.log_prob < 0 and r.n_tokens == 5 for r in scored)


def test_columns_with_dots_and_ids(spark):
    docs = spark.createDataFrame([(1, "x", "a b", [7])], "`a.b` int, row string, text string, ids array<int>")
    got = lm_score.score_documents(docs)
    assert got.columns == ["a.b", "row", "ids", "n_tokens", "log_prob", "mean_log_prob"]
    assert got.first()[:4] == (1, "x", [7], 2)


def test_steps_share_their_arrays():
    """A step of a full batch makes no array of its size anew, and so takes no pages."""
    rng = np.random.default_rng(5)
    n = lm_score.LATER_BATCH
    context = rng.integers(0, lm_score.VOCABULARY, (n, 4)).astype("<u2")
    target = rng.integers(0, lm_score.VOCABULARY, n).astype("<u2")
    net = lm_score.Network.fresh()
    squares = np.full(net.SIZE, 0.01, np.float32)
    net.train(context, target, squares)
    tracemalloc.start()
    try:
        net.train(context, target, squares)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < n * lm_score.HIDDEN * 4 * 2


def test_large_logits_are_bounded():
    """Steps and scores stay finite where logits pass the bound, and rows stay in their places."""
    rng = np.random.default_rng(6)
    net = lm_score.Network.fresh()
    net.values *= 200
    padded = rng.integers(0, lm_score.VOCABULARY, 300)
    places = np.arange(2, 298)
    got = net.log_probabilities(padded, places)
    one = [net.log_probabilities(padded, places[i : i + 1])[0] for i in range(len(places))]
    assert np.allclose(got, one, rtol=1e-4) and got.min() > -250
    context = np.stack([padded[places + w] for w in lm_score.WINDOW], axis=1)
    net.train(context, padded[places], np.full(net.SIZE, 0.01, np.float32))
    assert np.isfinite(net.values).all()


def test_known_words_of_one_digest_are_joined(monkeypatch):
    """The first of them is found, the others are left for the join; none is taken for another."""
    monkeypatch.setattr(lm_score, "digests", lambda words: np.zeros(len(words), np.uint64))
    known = pa.array(["one", "two", "three"])
    vocabulary = lm_score.Vocabulary(["top"], np.zeros(32), known, np.array([5, 4, 3]))
    _, n, shares, (row, word, k) = vocabulary.with_rest(pa.array(["top one two", "new one one two two"]))
    assert n.tolist() == [3, 5]
    assert shares.tolist() == [lm_score.log_units(np.array([5]))[0] * i for i in (1, 2)]
    assert sorted(zip(row.to_pylist(), word.to_pylist(), k.to_pylist())) == [
        (0, "two", 1), (1, "new", 1), (1, "two", 2)]


def test_parameters_are_averaged_by_windows(spark):
    """Of two partitions, in whole numbers of either sign."""
    vocabulary = lm_score.Vocabulary(["a"], np.zeros(32), pa.array([], pa.string()), np.array([]))
    rng = np.random.default_rng(7)
    docs = [rng.integers(0, 1024, n).astype("<u2") for n in (700, 2900)]
    start = lm_score.Network.fresh().values
    total = np.zeros(len(start))
    for ids in docs:
        own = spark.createDataFrame([(ids.tobytes(),)], "ids binary").coalesce(1)
        part = lm_score._train_round(own, start, vocabulary, 0, 1)
        total += part.astype(float) * len(ids)
    both = spark.createDataFrame([(d.tobytes(),) for d in docs], "ids binary").repartitionByRange(
        2, "ids")
    assert both.select(F.spark_partition_id()).distinct().count() == 2
    got = lm_score._train_round(both, start, vocabulary, 0, 1)
    assert np.abs(got - total / sum(map(len, docs))).max() < 2 * lm_score.UNIT
    assert got.min() < 0 < got.max()
