"""Toxic documents by class-conditional Kneser-Ney models of words.

A word is spelt letter by letter, from a start to an end mark.  For either class an
interpolated Kneser-Ney model of order six gives each letter's probability after the letters
before it; the orders up to two use continuation counts shared by both classes, so that rare
expressions fall back on the same ground in both.  A word's evidence is the logarithm of its
toxic over its ordinary likelihood.

Evidence is compared by length.  The mean per word over a whole document is the difference of
the two log-likelihoods normalised by length; beside it stand the means over the strongest words
and the excess of strong words against the square root of the length.  A logistic curve over
these turns the evidence into a score.

Counts come from all labelled rows of the learning folds, one for each gram that occurs: a
gram is named by its letters, so that no two share a count, and a model grows with the number
of distinct grams.  The driver and every worker hold the model, so a corpus with more grams than
``MOST_GRAMS`` is refused.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peakwise.llm.worker import carried, kept, slices
from peakwise.session import shared_path
from peakwise.sources.tables import write_table

ORDER = 6
SHARED_ORDER = 2
DISCOUNT = 0.75

#: Bits of a letter: a gram's last three letters are one number, those before them another.
LETTER_BITS = 21
HALF = 3

#: Grams and contexts that the driver and every worker may hold, 28 bytes each.
MOST_GRAMS = 50_000_000

#: Rows of the learning folds the curve is fitted on; the first by a digest of their ids.
CURVE_ROWS = 50_000

#: Labels that are broadcast, 16 bytes each; more of them are joined.
BROADCAST_LABELS = 4_000_000

#: Words whose evidence a worker remembers, about 150 bytes each.
REMEMBERED = 250_000

#: Bytes of texts that a task works on at a time.
SLICE_BYTES = 4 << 20

#: Words spelt at a time: 3 MB for each array of their grams.
SPELT = 20_000

START, END = "\x02", "\x03"
MIX = np.uint64(0x9E3779B97F4A7C15)
GRAM = np.dtype([("high", "<u8"), ("low", "<u8")])


def words_of(text: str | None) -> list[str]:
    """Lower-case runs of letters, digits and underscores."""
    import re

    return re.findall(r"\w+", (text or "").lower())


def _spelt(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters of all words with their marks, each one's place and word."""
    raw = "".join([START + w + END for w in words]).encode("utf-32-le", "surrogatepass")
    letters = np.frombuffer(raw, dtype="<u4").astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    word = np.repeat(np.arange(len(words)), lengths)
    place = np.arange(len(letters)) - (np.cumsum(lengths) - lengths)[word]
    return letters, place, word


def _grams(letters: np.ndarray, place: np.ndarray) -> list[np.ndarray]:
    """The last 0, 1, ... ORDER letters up to each one, cut at a word's start."""
    grams = [np.zeros(len(letters), dtype=GRAM)]
    for back in range(ORDER):
        shifted = np.zeros_like(letters)
        shifted[back:] = letters[: max(0, len(letters) - back)]
        shifted = np.where(place >= back, shifted, np.uint64(0))
        gram = grams[-1].copy()
        gram["low" if back < HALF else "high"] |= shifted << np.uint64(back % HALF * LETTER_BITS)
        grams.append(gram)
    return grams


def _before(values: np.ndarray) -> np.ndarray:
    """The value of the letter before each one (never asked for at a word's start)."""
    shifted = np.zeros_like(values)
    shifted[1:] = values[:-1]
    return shifted


def _slot(grams: np.ndarray) -> np.ndarray:
    """What a :class:`Shares` is asked for: the grams themselves."""
    return grams


class GramIndex:
    """Places of distinct grams, and one past the last place for all others."""

    def __init__(self, grams: np.ndarray):
        grams = grams[np.lexsort((grams["low"], grams["high"]))]
        grams = grams[np.append(True, grams[1:] != grams[:-1])[: len(grams)]]
        self.salt = 0
        while True:
            digests = self._digest(grams)
            order = np.argsort(digests, kind="stable")
            self.digests, self.grams = digests[order], grams[order]
            if not (self.digests[1:] == self.digests[:-1]).any():
                break
            self.salt += 1

    def __len__(self) -> int:
        return len(self.grams)

    def _digest(self, grams: np.ndarray) -> np.ndarray:
        mixed = (grams["high"] + np.uint64(self.salt)) * MIX
        mixed = ((mixed ^ (mixed >> np.uint64(29))) + grams["low"]) * MIX
        mixed = (mixed ^ (mixed >> np.uint64(32))) * MIX
        return mixed ^ (mixed >> np.uint64(29))

    def find(self, grams: np.ndarray) -> np.ndarray:
        grams = np.atleast_1d(grams)
        if not len(self):
            return np.zeros(len(grams), np.int64)
        digests = self._digest(grams)
        at = np.searchsorted(self.digests, digests)
        near = np.minimum(at, len(self) - 1)
        # Digests are distinct, so that one comparison of the letters decides.
        known = (self.digests[near] == digests) & (self.grams["low"][near] == grams["low"])
        known &= self.grams["high"][near] == grams["high"]
        return np.where(known, near, len(self))


class Shares:
    """A number for each gram of an index, and one for all others."""

    def __init__(self, index: GramIndex, grams: np.ndarray, x: np.ndarray, empty: float):
        self.index = index
        self.values = np.full(len(index) + 1, empty, np.float32)
        self.values[index.find(grams)] = x

    def __getitem__(self, grams: np.ndarray) -> np.ndarray:
        return self.values[self.index.find(grams)]


class WordEvidence(dict):
    """Logarithm of a word's toxic over its ordinary likelihood, remembered."""

    def __init__(self, shares: dict, backoffs: dict):
        """Discounted shares by ``[class, order][gram]`` and weights of the lower order by
        ``[class, order][context]``; class 2 is both.  A context is a gram of the order below
        and has its place in that order's index."""
        self.shares, self.backoffs = shares, backoffs

    def learn(self, words: list[str]) -> None:
        letters, place, word = _spelt(words)
        grams = _grams(letters, place)
        chance = np.full(len(letters), 1e-3)
        context = self.backoffs[2, 1].index.find(grams[0])
        for order in range(1, SHARED_ORDER + 1):
            at = self.shares[2, order].index.find(grams[order])
            chance = self.shares[2, order].values[at] + (
                self.backoffs[2, order].values[_before(context)] * chance
            )
            context = at
        chances = [chance, chance]
        for order in range(SHARED_ORDER + 1, ORDER + 1):
            at = self.shares[0, order].index.find(grams[order])
            chances = [
                self.shares[c, order].values[at]
                + self.backoffs[c, order].values[_before(context)] * chances[c]
                for c in (0, 1)
            ]
            context = at
        gain = np.where(place > 0, np.log(chances[1] + 1e-12) - np.log(chances[0] + 1e-12), 0.0)
        self.update(zip(words, np.bincount(word, gain, len(words)).tolist()))

    def features(self, texts: list[str | None]) -> list[list[float]]:
        """Evidence of each text by its length; zeros without words."""
        documents = [words_of(t) for t in texts]
        if len(self) > REMEMBERED:
            self.clear()
        new = [w for w in set().union(*documents) if w not in self]
        for cut in range(0, len(new), SPELT):
            self.learn(new[cut : cut + SPELT])
        return [self._features(words) for words in documents]

    def _features(self, words: list[str]) -> list[float]:
        if not words:
            return [0.0] * N_FEATURES
        gains = np.fromiter(map(self.__getitem__, words), np.float64, len(words))
        best = np.sort(np.fromiter(map(self.__getitem__, set(words)), np.float64))[::-1][:3]
        strong = gains[gains > 2.0].sum()
        return [
            np.clip(gains.mean(), -3, 3),
            np.clip(best[0], -5, 25),
            np.clip(best.sum() / 3, -5, 25),
            min(strong / np.sqrt(len(words) + 5.0), 10.0),
            min(10.0 * (gains > 5.0).mean(), 2.0),
        ]


N_FEATURES = 5


def _spelt_grams(words: DataFrame) -> DataFrame:
    """``(cls, ord, high, low, n)`` from ``(cls, word, n)``: class and order of a gram, the gram
    one letter longer (the gram itself in the highest order), and the documents with the words
    it occurs in."""
    import pyarrow as pa

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters, place, word = _spelt(batch.column(1).to_pylist())
            grams = _grams(letters, place)
            inner = place > 0
            own = batch.column(0).to_numpy().astype(np.int64)[word][inner]
            times = batch.column(2).to_numpy()[word][inner]
            for order in range(1, ORDER + 1):
                longer = grams[min(order + 1, ORDER)][inner]
                cls = own if order > SHARED_ORDER else np.full(len(own), 2, np.int64)
                by = np.lexsort((longer["low"], longer["high"], cls))
                cls, high, low = cls[by], longer["high"][by], longer["low"][by]
                new = np.ones(len(by), dtype=bool)
                new[1:] = (cls[1:] != cls[:-1]) | (high[1:] != high[:-1]) | (low[1:] != low[:-1])
                first = np.flatnonzero(new)
                total = np.add.reduceat(times[by], first) if len(first) else times[by]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(cls[first].astype(np.int32)),
                        pa.array(np.full(len(first), order, np.int32)),
                        pa.array(high[first].astype(np.int64)),
                        pa.array(low[first].astype(np.int64)),
                        pa.array(total.astype(np.int64)),
                    ],
                    names=["cls", "ord", "high", "low", "n"],
                )

    return words.mapInArrow(spell, "cls int, ord int, high bigint, low bigint, n bigint")


def _word_documents(labelled: DataFrame) -> DataFrame:
    """``(cls, word, n)``: the number of documents of a class that hold a word."""
    from collections import Counter

    import pyarrow as pa

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = (Counter(), Counter())
            for part in slices(batch, 1, SLICE_BYTES):
                for cls, text in zip(*(c.to_pylist() for c in part.columns)):
                    found[cls].update(set(words_of(text)))
            for cls, words in enumerate(found):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(words), cls, np.int32)),
                        pa.array(list(words), pa.string()),
                        pa.array(list(words.values()), pa.int64()),
                    ],
                    names=["cls", "word", "n"],
                )

    found = labelled.mapInArrow(count, "cls int, word string, n bigint")
    return found.groupBy("cls", "word").agg(F.sum("n").alias("n"))


def fit_evidence(labelled: DataFrame) -> tuple[dict, dict]:
    """The tables of :class:`WordEvidence` from ``(cls, text)``, 1 for toxic, 0 for ordinary.

    The highest order counts documents; lower orders count distinct continuations.  Grams are
    counted in Spark, and a share per gram and a weight per context reach the driver; more than
    ``MOST_GRAMS`` of them are an error.
    """
    spark = labelled.sparkSession
    order = F.col("ord")

    def last(half: str, before: int):
        """A half of the gram of ``ord`` letters that ends a longer one."""
        mask = F.lit(-1).cast("bigint")
        for o in range(1, ORDER):
            bits = LETTER_BITS * min(HALF, max(0, o - before))
            mask = F.when(order == o, F.lit((1 << bits) - 1).cast("bigint")).otherwise(mask)
        return F.col(half).bitwiseAND(mask).alias(half)

    letter = (1 << LETTER_BITS) - 1
    context = {
        "context_high": F.shiftright("high", LETTER_BITS),
        "context_low": F.shiftright("low", LETTER_BITS).bitwiseOR(
            F.shiftleft(F.col("high").bitwiseAND(letter), LETTER_BITS * (HALF - 1))
        ),
    }
    grams = (
        _spelt_grams(_word_documents(labelled))
        .groupBy("cls", "ord", "high", "low")
        .agg(F.sum("n").alias("n"))
        .groupBy("cls", "ord", last("high", HALF), last("low", 0))
        .agg(F.sum(F.when(order == ORDER, F.col("n")).otherwise(1)).alias("n"))
        .withColumns(context)
    )
    grams = write_table(grams, shared_path(spark, "grams"))
    by = ["cls", "ord", "context_high", "context_low"]
    contexts = grams.groupBy(*by).agg(
        F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds")
    )
    contexts = write_table(contexts, shared_path(spark, "contexts"))
    n = grams.count() + contexts.count()
    if n > MOST_GRAMS:
        raise ValueError(f"{n} grams and contexts are more than the {MOST_GRAMS} a worker may hold")
    backoff = contexts.select(
        "cls", "ord", F.col("context_high").alias("high"), F.col("context_low").alias("low"),
        (F.col("kinds") * DISCOUNT / F.col("total")).cast("float").alias("x"),
    )
    share = grams.join(contexts, by).select(
        "cls", "ord", "high", "low",
        ((F.col("n") - DISCOUNT) / F.col("total")).cast("float").alias("x"),
    )
    names = [(2, o) for o in range(1, SHARED_ORDER + 1)]
    names += [(c, o) for c in (0, 1) for o in range(SHARED_ORDER + 1, ORDER + 1)]

    def rows(frame: DataFrame) -> dict:
        found = frame.toArrow()
        cls, order = found["cls"].to_numpy(), found["ord"].to_numpy()
        keys = np.empty(len(cls), dtype=GRAM)
        keys["high"], keys["low"] = found["high"].to_numpy(), found["low"].to_numpy()
        x = found["x"].to_numpy()
        parts = ((name, np.flatnonzero((cls == name[0]) & (order == name[1]))) for name in names)
        return {name: (keys[own], x[own]) for name, own in parts}

    shares, backoffs = rows(share), rows(backoff)
    known = []
    for o in range(ORDER + 1):
        own = [shares[n][0] for n in names if n[1] == o]
        own += [backoffs[n][0] for n in names if n[1] == o + 1]
        known.append(GramIndex(np.concatenate(own)))
    return (
        {n: Shares(known[n[1]], *shares[n], 0.0) for n in names},
        {n: Shares(known[n[1] - 1], *backoffs[n], 1.0) for n in names},
    )


def _with_features(
    rows: DataFrame, model: tuple[dict, dict], key: str, inside: list[int] | None = None
) -> DataFrame:
    """``rows`` without ``__text`` but with ``__features``.

    ``inside`` says where in the struct ``__others`` the text lies, so that it is moved once.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    tables = rows.sparkSession.sparkContext.broadcast(model)
    names = [c for c in rows.columns if c != "__text"]
    schema = rows.select(*names).schema.add("__features", T.ArrayType(T.DoubleType()))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evidence = kept("evidence", key, lambda: WordEvidence(*tables.value))
        for batch in batches:
            if inside:
                text = pc.struct_field(batch.column("__others"), inside)
                batch = pa.RecordBatch.from_arrays([*batch.columns, text], names=[*names, "__text"])
            for part in slices(batch, "__text", SLICE_BYTES):
                features = evidence.features(part.column("__text").to_pylist())
                columns = [part.column(c) for c in names]
                columns.append(pa.array(features, pa.list_(pa.float64())))
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "__features"])

    return rows.select(*names, *([] if inside else ["__text"])).mapInArrow(compute, schema)


def fit_curve(features: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Weights of a logistic curve, the constant last, by Newton steps with a small penalty."""
    x = np.column_stack([features, np.ones(len(features))])
    weights = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], 0.05)
    penalty[-1] = 1e-6
    for _ in range(60):
        chance = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (chance - labels) + penalty * weights
        curvature = (x * (chance * (1 - chance))[:, None]).T @ x + np.diag(penalty + 1e-9)
        step = np.linalg.solve(curvature, slope)
        weights -= step * min(1.0, 5.0 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-9:
            break
    return weights


def fold_of(doc_id: str = "doc_id", folds: int = 5):
    """Fold of a row by its id; a null id is in fold 0, which is never learnt from."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), folds),
                      F.lit(0)).cast("int")


class ToxicityModel:
    """Tables, curve and a name, as :func:`fit` returns them."""

    def __init__(self, tables: tuple[dict, dict], weights: np.ndarray | None):
        import uuid

        self.tables, self.weights, self.key = tables, weights, uuid.uuid4().hex

    def score(self, docs: DataFrame, text: str = "text", struct: str | None = None) -> DataFrame:
        """``docs``, whose texts may lie in a column ``struct``, with ``score`` from 0 to 1, higher for likelier toxic, and ``predicted``, 1
        from one half on.

        Null and empty texts, and texts without words, have the evidence of no words.
        Without a label of either class to learn from all scores are 0.  Columns named like
        a result are replaced.
        """
        packed, others = carried(docs, "score", "predicted")
        if self.weights is None:
            return docs.select(*packed).select(
                *others, F.lit(0.0).alias("score"), F.lit(0).alias("predicted")
            )
        held = [c for c in docs.columns if c not in ("score", "predicted")]
        if struct:
            inside = [held.index(struct), docs.schema[struct].dataType.names.index(text)]
        else:
            inside = [held.index(text)] if text in held else None
        alone = [] if inside else [F.col(text).alias("__text")]
        rows = _with_features(docs.select(*alone, *packed), self.tables, self.key, inside)
        total = F.lit(float(self.weights[-1]))
        for i, w in enumerate(self.weights[:-1]):
            total = total + F.get("__features", F.lit(i)) * float(w)
        rows = rows.select(*others, (1 / (1 + F.exp(-total))).alias("score"))
        return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    curve_rows: int = CURVE_ROWS,
) -> ToxicityModel:
    """Learn from labelled documents outside fold 0 of :func:`fold_of`.

    Folds 1 to 3 give the word models, all rows of them; fold 4 gives the curve, from its
    first ``curve_rows`` rows by a digest of the id.  Of several labels of an id the highest
    counts; null labels count as none.
    """
    spark = docs.sparkSession
    known = (
        labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("cls"))
        .where("cls in (0, 1) and _id is not null")
        .groupBy("_id")
        .agg(F.max("cls").alias("cls"))
        .withColumn("_fold", fold_of("_id"))
        .where("_fold > 0")
    )
    known = write_table(known, shared_path(spark, "labels"))
    sizes = {r["_fold"]: r for r in known.groupBy("_fold").agg(
        F.count(F.lit(1)).alias("n"), F.sum("cls").alias("toxic")).collect()}
    words = [sizes[f] for f in (1, 2, 3) if f in sizes]
    enough = 0 < sum(r["toxic"] for r in words) < sum(r["n"] for r in words)
    if not enough or 4 not in sizes or not 0 < sizes[4]["toxic"] < sizes[4]["n"]:
        return ToxicityModel(({}, {}), None)
    if sum(r["n"] for r in sizes.values()) <= BROADCAST_LABELS:
        known = F.broadcast(known)
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("__text")).join(known, "_id")
    tables = fit_evidence(rows.where("_fold < 4").select("cls", "__text"))
    digest = F.xxhash64(F.col("_id").cast("string"))
    curve = rows.where("_fold = 4").select(digest.alias("_digest"), "cls", "__text")
    model = ToxicityModel(tables, None)
    found = _with_features(curve, tables, model.key).orderBy("_digest", "cls", "__features")
    found = found.limit(curve_rows).toArrow()
    features = np.array(found["__features"].to_pylist(), dtype=np.float64)
    model.weights = fit_curve(features, found["cls"].to_numpy().astype(np.float64))
    return model


def ordinary_documents(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
) -> DataFrame:
    """The rows of ``docs`` that a model learnt from their labels does not predict toxic."""
    model = fit(docs, labels, doc_id, text, label)
    # Other spellings of a column's name find it as well.
    text = next((c for c in docs.columns if c == text),
                next((c for c in docs.columns if c.lower() == text.lower()), text))
    row = F.struct(*[F.col(f"`{c}`").alias(c) for c in docs.columns])
    clean = model.score(docs.select(row.alias("__row")), text, "__row").where("predicted = 0")
    return clean.select(*[F.col("__row")[c].alias(c) for c in docs.columns])
