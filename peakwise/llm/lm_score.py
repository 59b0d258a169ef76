"""Documents scored by masked pseudo-likelihood.

A small network predicts every token from the two on either side: their embeddings, weighted
by position, make a hidden layer, and a two-level softmax over classes of tokens and tokens of
a class gives the token's probability.  The sum of the logarithms over a document is its
score.

The vocabulary holds the most frequent words of the whole corpus, as many as the square root of
its distinct words and 1024 at least.  Other words share buckets; within its bucket a word has
its share of the occurrences that the corpus has there, which a join with the word counts tells.

Training runs where the documents are: in each round every partition trains on another share of
its windows, in all rounds together on every window once, and the parameters are averaged by the
number of windows.  Sums are of whole numbers, so that they do not depend on the order they
arrive in; the parameters do depend on how the rows are dealt to partitions.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peakwise.llm.worker import carried, ranges, slices
from peakwise.session import shared_path
from peakwise.sources.tables import write_table

#: Classes of the smallest vocabulary; a class has as many tokens, and the last one is buckets.
CLASSES = 32
PER_CLASS = BUCKETS = CLASSES
VOCABULARY = CLASSES * CLASSES

WINDOW = (-2, -1, 1, 2)
WIDTH = 16
HIDDEN = 32

#: In each of so many rounds every so many-th window is trained on, another one each time.
ROUNDS = 2
#: Windows of a step, at first and after so many windows.
BATCH, LATER_BATCH, LATER = 2048, 4096, 1 << 17
RATE = 0.15

#: Words without an id whose counts go to every task, some 20 bytes each; others are joined.
KNOWN = 1 << 18

#: Logarithms of odds count up to this, so that their exponentials stay finite.
MOST = 60.0

#: Bytes of texts or ids that a task works on at a time.
SLICE_BYTES = 4 << 20

#: Tokens scored at a time: 1 MB for each array of hidden values, which stays in a cache.
CHUNK = 1 << 13
#: Parameters are summed in units of this.
UNIT = 2.0**-20


def words_of(texts):
    """Words of an Arrow array of texts, one after the other, and how many each text has.

    Words are lower-case runs of letters, digits and underscores, and runs of other characters
    but white space.  Null texts have none.
    """
    import pyarrow.compute as pc

    lower = pc.utf8_lower(texts.fill_null(""))
    apart = pc.replace_substring_regex(lower, r"([^\p{L}\p{N}_\s\p{Z}]+)", r" \1 ")
    split = pc.utf8_split_whitespace(apart)
    words = split.flatten()
    # White space at either end of a text leaves an empty word there.
    full = pc.greater(pc.binary_length(words), 0)
    upto = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    offsets = split.offsets.to_numpy()
    return words.filter(full), np.diff(upto[offsets - offsets[0]])


def digests(words) -> np.ndarray:
    """A weighted sum of the bytes of each word of an Arrow array."""
    if not len(words):
        return np.empty(0, np.uint64)
    words = words.cast("binary")
    _, offsets, data = words.buffers()
    cuts = np.frombuffer(offsets, np.int32)[words.offset : words.offset + len(words) + 1]
    values = np.frombuffer(data, np.uint8)[cuts[0] : cuts[-1]].astype(np.uint64)
    _, place = ranges(np.diff(cuts))
    weights = np.random.default_rng(3).integers(1, 1 << 40, 61, dtype=np.uint64)
    total = np.add.reduceat(values * weights[place % 61], cuts[:-1] - cuts[0])
    return total * np.uint64(0x9E3779B97F4A7C15)


def buckets(words, n: int = BUCKETS) -> np.ndarray:
    """Bucket, of ``n``, of each word of an Arrow array, by its digest."""
    return _bucket(digests(words), n)


def _bucket(mixed: np.ndarray, n: int) -> np.ndarray:
    return ((mixed >> np.uint64(32)) % np.uint64(n)).astype(np.int64)


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(word, n)`` over all documents."""
    import pyarrow as pa
    import pyarrow.compute as pc

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for part in slices(batch, 0, SLICE_BYTES):
                counts = pc.value_counts(words_of(part.column(0))[0])
                parts.append(pa.table({"word": counts.field(0), "n": counts.field(1)}))
            if parts:
                total = pa.concat_tables(parts).group_by("word").aggregate([("n", "sum")])
                yield from total.select(["word", "n_sum"]).rename_columns(["word", "n"]).to_batches()

    rows = docs.select(F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(count, "word string, n bigint").groupBy("word").agg(
        F.sum("n").alias("n")
    )


def log_units(counts: np.ndarray) -> np.ndarray:
    """Logarithms in whole units, so that the order of a sum does not matter."""
    return np.rint(np.log(counts) / UNIT).astype(np.int64)


class Vocabulary:
    """Ids of the most frequent words, then of the buckets, the number of occurrences that other
    words have in each bucket, and the counts of the most frequent of those."""

    def __init__(self, words: list[str], totals: np.ndarray, known, known_counts: np.ndarray):
        import pyarrow as pa

        self.words, self.totals = words, totals
        mixed = digests(known)
        order = np.argsort(mixed, kind="stable")
        self.known, self.known_digests = known.take(pa.array(order)), mixed[order]
        self.known_units = log_units(known_counts)[order]
        self.classes = len(totals)
        self.type = "<u2" if self.classes**2 < 1 << 16 else "<u4"

    def _known(self, words, mixed: np.ndarray) -> np.ndarray:
        """Places of words among the known ones, -1 for others.  A known word behind another of
        the same digest is not found, and then joined like those that are not known."""
        import pyarrow as pa
        import pyarrow.compute as pc

        if not len(self.known):
            return np.full(len(words), -1)
        at = np.minimum(np.searchsorted(self.known_digests, mixed), len(self.known) - 1)
        same = pc.equal(words, self.known.take(pa.array(at))).to_numpy(zero_copy_only=False)
        return np.where(same, at, -1)

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of an Arrow array of texts, one after the other, and how many each text has."""
        return self.with_rest(texts)[:2]

    def with_rest(self, texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
        """Ids and counts as :meth:`encode`, each text's sum of the known words' logarithms of
        counts, and ``(row, word, n)`` of the other words without an id, in three Arrow arrays."""
        import pyarrow as pa
        import pyarrow.compute as pc

        words, counts = words_of(texts)
        coded = words.dictionary_encode()
        at = pc.index_in(coded.dictionary, value_set=pa.array(self.words, pa.string()))
        ids = at.fill_null(-1).to_numpy().astype(np.int64)
        unknown = np.flatnonzero(ids < 0)
        rest = coded.dictionary.take(pa.array(unknown))
        mixed = digests(rest)
        ids[unknown] = self.classes * (self.classes - 1) + _bucket(mixed, self.classes)
        index = coded.indices.to_numpy().astype(np.int64)
        row = np.repeat(np.arange(len(counts)), counts)
        at = self._known(rest, mixed)
        units = np.zeros(len(ids), dtype=np.int64)
        units[unknown] = np.append(self.known_units, 0)[at]
        upto = np.concatenate([[0], np.cumsum(units[index])])
        shares = np.diff(upto[np.cumsum(counts)], prepend=0)
        other = np.flatnonzero(at < 0)
        place = np.full(len(ids), -1)
        place[unknown[other]] = other
        found = place[index] >= 0
        pair, n = np.unique(row[found] * len(ids) + place[index][found], return_counts=True)
        own = [pa.array(pair // max(1, len(ids))), rest.take(pa.array(pair % max(1, len(ids)))),
               pa.array(n)]
        return ids.astype(self.type)[index], counts, shares, own


def fit_vocabulary(counts: DataFrame) -> Vocabulary:
    """From all word counts; the vocabulary's words, as many as the square root of the number of
    distinct words, ``KNOWN`` others and one number per bucket reach the driver."""
    import pyarrow as pa

    classes = max(CLASSES, round(counts.count() ** 0.25))
    n_words = classes * (classes - 1)
    top = counts.orderBy(F.desc("n"), "word").limit(n_words + KNOWN)
    top = top.toArrow().sort_by([("n", "descending"), ("word", "ascending")]).combine_chunks()
    words = top["word"].slice(0, n_words).to_pylist()
    known = pa.array(top["word"].slice(n_words).to_pylist(), pa.string())

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(classes, dtype=np.int64)
        for batch in batches:
            unknown = pa.compute.is_in(batch.column(0), value_set=pa.array(words, pa.string()))
            rest = batch.filter(pa.compute.invert(unknown))
            np.add.at(total, buckets(rest.column(0), classes), rest.column(1).to_numpy())
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(classes)), pa.array(total)], names=["slot", "n"]
        )

    rows = counts.select("word", "n").mapInArrow(sizes, "slot bigint, n bigint")
    found = rows.groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    totals = np.zeros(classes, dtype=np.int64)
    totals[found["slot"].to_numpy()] = found["n"].to_numpy()
    return Vocabulary(words, totals, known, top["n"].slice(n_words).to_numpy())


class Network:
    """Parameters as one vector, with named views.  The id past the last token stands for the
    places before a document's first and after its last token."""

    def __init__(self, values: np.ndarray | None, classes: int = CLASSES):
        shapes = {
            "embedding": (classes * classes + 1, WIDTH),
            "position": (len(WINDOW), WIDTH, HIDDEN),
            "hidden": (HIDDEN,),
            # Of each of these the last row of weights is the bias.
            "outer": (HIDDEN + 1, classes),
            "inner": (classes, HIDDEN + 1, classes),
        }
        self.n_classes = classes
        self._rooms: dict[str, np.ndarray] = {}
        self._gradient: Network | None = None
        self.SIZE = sum(math.prod(s) for s in shapes.values())
        self.values = np.zeros(self.SIZE, dtype=np.float32) if values is None else values
        at = 0
        for name, shape in shapes.items():
            size = math.prod(shape)
            setattr(self, name, self.values[at : at + size].reshape(shape))
            at += size
        self.classes, self.class_bias = self.outer[:-1], self.outer[-1]
        self.members, self.member_bias = self.inner[:, :-1], self.inner[:, -1]

    @classmethod
    def fresh(cls, seed: int = 11, classes: int = CLASSES) -> Network:
        rng = np.random.default_rng(seed)
        net = cls(None, classes)
        for name in ("embedding", "position", "classes", "members"):
            part = getattr(net, name)
            part[...] = rng.normal(0, 0.3 if name != "embedding" else 0.5, part.shape)
        return net

    def _room(self, name: str, *shape: int) -> np.ndarray:
        """An array that the steps share: fresh ones would come from the machine page by page."""
        size = math.prod(shape)
        if name not in self._rooms or self._rooms[name].size < size:
            self._rooms[name] = np.empty(size, dtype=np.float32)
        return self._rooms[name][:size].reshape(shape)

    def _hidden(self, total: np.ndarray) -> np.ndarray:
        """Hidden values, and a column of ones for the biases."""
        hidden = self._room("hidden", len(total), HIDDEN + 1)
        hidden[:, HIDDEN] = 1
        np.tanh(total, out=hidden[:, :HIDDEN])
        return hidden

    def _by_class(self, target: np.ndarray):
        """Order of the rows by class, and the cuts between classes."""
        cls = (target // self.n_classes).astype(np.uint16)
        order = np.argsort(cls, kind="stable")
        return order, np.searchsorted(cls.take(order), np.arange(self.n_classes + 1)).tolist()

    def train(self, context: np.ndarray, target: np.ndarray, squares: np.ndarray) -> None:
        """One step of adaptive gradient descent over a batch."""
        n, classes = len(target), self.n_classes
        if self._gradient is None:
            self._gradient = Network(None, classes)
        grad = self._gradient
        grad.values[...] = 0
        # Rows of a class lie side by side in all that follows.
        order, cuts = self._by_class(target)
        target = target.take(order).astype(np.int64)
        token = context.take(order, axis=0).reshape(-1)
        runs = [(c, slice(i, j)) for c, (i, j) in enumerate(zip(cuts, cuts[1:])) if i < j]
        cls = target // classes
        position = self.position.reshape(-1, HIDDEN)
        near = self._room("near", len(token), WIDTH)
        near = self.embedding.take(token, axis=0, out=near, mode="clip").reshape(n, -1)
        total = np.dot(near, position, out=self._room("total", n, HIDDEN))
        total += self.hidden
        hidden = self._hidden(total)

        error = np.dot(hidden, self.outer, out=self._room("error", n, classes))
        _softmax(error, _reach(self.outer), 1 / n)
        first = np.arange(0, n * classes, classes)
        error.reshape(-1)[first + cls] -= 1 / n
        np.dot(hidden.T, error, out=grad.outer)
        back = np.dot(error, self.classes.T, out=self._room("back", n, HIDDEN))

        for c, rows in runs:
            np.dot(hidden[rows], self.inner[c], out=error[rows])
        _softmax(error, _reach(self.inner), 1 / n)
        first += target
        first -= cls * classes
        error.reshape(-1)[first] -= 1 / n
        within = total
        for c, rows in runs:
            part = error[rows]
            np.dot(hidden[rows].T, part, out=grad.inner[c])
            np.dot(part, self.members[c].T, out=within[rows])
        back += within

        slope = np.multiply(hidden[:, :HIDDEN], hidden[:, :HIDDEN], out=total)
        back *= np.subtract(1, slope, out=slope)
        np.dot(np.ones(n, dtype=np.float32), back, out=grad.hidden)
        np.dot(near.T, back, out=grad.position.reshape(-1, HIDDEN))
        # What the embeddings get, summed by token; pairs of numbers take half the additions.
        parts = np.dot(back, position.T, out=near).reshape(-1, WIDTH)
        order = np.argsort(token, kind="stable")  # two-byte tokens are sorted by their digits
        token = token.take(order)
        other = np.ones(len(token), dtype=bool)
        np.not_equal(token[1:], token[:-1], out=other[1:])
        first = np.flatnonzero(other)
        parts = parts.take(order, axis=0, out=self._room("sorted", *parts.shape), mode="clip")
        sums = np.add.reduceat(parts.view(np.complex64), first, axis=0).view(np.float32)
        grad.embedding[token.take(first)] = sums

        step, root = grad.values, self._room("root", self.SIZE)
        squares += np.multiply(step, step, out=root)
        np.add(squares, 1e-8, out=root)
        step *= RATE
        step /= np.sqrt(root, out=root)
        self.values -= step

    def log_probabilities(self, padded: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Of the tokens at ``places``, two or more from either end of ``padded``."""
        classes = self.n_classes
        pushed = [self.embedding @ self.position[p] for p in range(len(WINDOW))]
        pushed[0] += self.hidden
        target = padded.take(places)
        order, cuts = self._by_class(target)
        target = target.take(order).astype(np.int64)
        result = np.empty(len(places))
        ones = np.ones(classes, dtype=np.float32)
        for c in np.flatnonzero(np.diff(cuts)):
            # Logits of the classes and of the class's members in one product.
            weights = np.concatenate([self.outer, self.inner[c]], axis=1)
            reach = _reach(weights)
            for start in range(cuts[c], cuts[c + 1], CHUNK):
                own = order[start : min(start + CHUNK, cuts[c + 1])]
                at = places.take(own)
                total = self._room("total", len(at), HIDDEN)
                pushed[0].take(padded.take(at + WINDOW[0]), axis=0, out=total, mode="clip")
                for p in range(1, len(WINDOW)):
                    total += pushed[p].take(padded.take(at + WINDOW[p]), axis=0)
                logits = self._room("logits", len(at), 2 * classes)
                np.dot(self._hidden(total), weights, out=logits)
                _bounded(logits, reach)
                member = target[start : start + len(at)] - (c - 1) * classes
                member += np.arange(0, logits.size, 2 * classes)
                found = logits[:, c] + logits.reshape(-1).take(member)
                np.exp(logits, out=logits)
                logs = np.log(logits.reshape(-1, classes) @ ones)
                found -= logs[::2]
                found -= logs[1::2]
                result[own] = found
        return result


def _reach(weights: np.ndarray) -> float:
    """What no logit is beyond, since hidden values are -1 to 1."""
    return float(np.abs(weights).sum(axis=-2).max())


def _bounded(logits: np.ndarray, reach: float) -> np.ndarray:
    return logits if reach <= MOST else np.clip(logits, -MOST, MOST, out=logits)


def _softmax(logits: np.ndarray, reach: float, total: float) -> None:
    """In place, with rows that sum to ``total``."""
    np.exp(_bounded(logits, reach), out=logits)
    logits *= (total / (logits @ np.ones(logits.shape[1], logits.dtype)))[:, None]


def _padded(
    rows: list[bytes], kind: str = "<u2", edge: int = VOCABULARY
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of documents with two edges around each, the places of the tokens, and how many
    each document has."""
    counts = np.array([len(r) for r in rows], dtype=np.int64) // np.dtype(kind).itemsize
    padded = np.full(counts.sum() + 2 * (len(counts) + 1), edge, dtype=kind)
    places = np.arange(counts.sum()) + 2 * np.repeat(np.arange(1, len(counts) + 1), counts)
    padded[places] = np.frombuffer(b"".join(rows), kind)
    return padded, places, counts


def _train_round(
    encoded: DataFrame, start: np.ndarray, vocabulary: Vocabulary, turn: int, rounds: int
) -> np.ndarray:
    """Parameters averaged over what every partition makes of ``start`` on its windows of a
    round: of every ``rounds`` the one at ``turn``."""
    import pyarrow as pa

    classes, kind = vocabulary.classes, vocabulary.type

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network(start.copy(), classes)
        squares = np.full(net.SIZE, 0.01, dtype=np.float32)
        seen = 0
        rest = np.empty((0, len(WINDOW)), kind), np.empty(0, kind)
        for batch in (part for whole in batches for part in slices(whole, 0, SLICE_BYTES)):
            padded, places, _ = _padded(batch.column(0).to_pylist(), kind, classes * classes)
            at = places[turn::rounds].copy()
            before = len(rest[1])
            context = np.empty((before + len(at), len(WINDOW)), kind)
            context[:before] = rest[0]
            for p, w in enumerate(WINDOW):
                context[before:, p] = padded.take(at + w)
            target = np.concatenate([rest[1], padded.take(at)])
            # Neighbouring windows differ little: a batch takes them from all over.
            size = BATCH if seen < LATER else LATER_BATCH
            full = len(target) // size * size
            mixed = np.random.default_rng(turn).permutation(full)
            for cut in range(0, full, size):
                some = mixed[cut : cut + size]
                net.train(context.take(some, axis=0), target.take(some), squares)
            seen += full
            rest = context[full:].copy(), target[full:]
        if len(rest[1]):
            net.train(*rest, squares)
            seen += len(rest[1])
        if seen:
            parts = np.rint(net.values.astype(np.float64) / UNIT).astype(np.int64)
            parts = np.append(1, parts)
            # Two halves of a whole number: neither sum passes 64 bits.
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(-1, len(parts) - 1)), pa.array((parts >> 16) * seen),
                 pa.array((parts & 0xFFFF) * seen)],
                names=["at", "high", "low"],
            )

    rows = encoded.select("ids").mapInArrow(train, "at bigint, high bigint, low bigint")
    sums = rows.groupBy("at").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).toArrow()
    if not len(sums):
        return start
    result = np.zeros(len(start) + 1)
    result[sums["at"].to_numpy() + 1] = sums["high"].to_numpy() * 65536.0 + sums["low"].to_numpy()
    return (result[1:] / result[0] * UNIT).astype(np.float32)


def _shares(encoded: DataFrame, counts: DataFrame) -> DataFrame:
    """``(row, share)``: the sum over a document's words that are not known of the logarithms of
    their counts.  They are joined once per document; the frequent words are known, so none of
    them is a hot key."""
    words = encoded.select("row", F.explode("rest").alias("word")).select("row", "word.*")
    found = words.join(counts.select("word", F.log("n").alias("log_n")), "word")
    part = F.rint(F.col("log_n") / UNIT).cast("bigint") * F.col("k")
    return found.groupBy("row").agg(F.sum(part).alias("share"))


def score_documents(
    docs: DataFrame, text: str = "text", rounds: int = ROUNDS
) -> DataFrame:
    """``docs`` without its text, with ``n_tokens``, ``log_prob`` and ``mean_log_prob``.

    ``log_prob`` is the sum of the logarithms of every token's probability given the two tokens
    before and after it.  Null and empty texts have no tokens, the sum 0 and a null mean.  All
    rows are counted, trained on and scored, repeated ones each time; the other columns go
    along, those named like a result are replaced.
    """
    import pyarrow as pa

    spark = docs.sparkSession
    packed, unpacked = carried(docs, text, "n_tokens", "log_prob", "mean_log_prob")
    counts = write_table(word_counts(docs, text), shared_path(spark, "word-counts"))
    vocabulary = fit_vocabulary(counts)
    classes, kind = vocabulary.classes, vocabulary.type
    width = np.dtype(kind).itemsize
    element = pa.struct([("word", pa.string()), ("k", pa.int64())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 0, SLICE_BYTES)):
            ids, n, shares, (row, word, k) = vocabulary.with_rest(batch.column(0))
            raw, ends = ids.tobytes(), np.cumsum(width * n.astype(np.int64)).tolist()
            cut = [raw[i:j] for i, j in zip([0, *ends[:-1]], ends)]
            cuts = np.searchsorted(row.to_numpy(), np.arange(len(n) + 1)).astype(np.int32)
            words = pa.StructArray.from_arrays([word, k], fields=list(element))
            rest = pa.ListArray.from_arrays(pa.array(cuts), words)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(cut, pa.binary()), pa.array(shares), rest],
                names=[*batch.schema.names[1:], "ids", "known", "rest"],
            )

    rows = docs.select(F.col(f"`{text}`").alias("__text"), *packed)
    carried_fields = rows.drop("__text").schema.fields
    schema = [*carried_fields, T.StructField("ids", T.BinaryType()), T.StructField("known", T.LongType())]
    with_rest = T.StructType([*schema, T.StructField("rest", T.ArrayType(T.StructType([
        T.StructField("word", T.StringType()), T.StructField("k", T.LongType())])))])
    encoded = rows.mapInArrow(encode, with_rest).withColumn("row", F.monotonically_increasing_id())
    encoded = write_table(encoded, shared_path(spark, "lm-ids"))
    values = Network.fresh(classes=classes).values
    for turn in range(rounds):
        values = _train_round(encoded, values, vocabulary, turn, rounds)
    extra = np.zeros(classes * classes)
    extra[classes * (classes - 1) :] = -np.log(np.maximum(vocabulary.totals, 1))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network(values, classes)
        for batch in (part for whole in batches for part in slices(whole, "ids", SLICE_BYTES)):
            ids = batch.column("ids").to_pylist()
            padded, places, n = _padded(ids, kind, classes * classes)
            found = net.log_probabilities(padded, places) + extra[padded[places]]
            ends = np.concatenate([[0], np.cumsum(found)])[np.cumsum(n)]
            sums = np.where(n > 0, np.diff(ends, prepend=0.0), 0.0)
            at = batch.schema.get_field_index("ids")
            columns = [c for i, c in enumerate(batch.columns) if i != at]
            names = [c for c in batch.schema.names if c != "ids"]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(n), pa.array(sums)], names=[*names, "n_tokens", "within"]
            )

    scored = encoded.drop("rest").mapInArrow(
        score,
        T.StructType([
            *carried_fields,
            T.StructField("known", T.LongType()),
            T.StructField("row", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("within", T.DoubleType()),
        ]),
    )
    scored = scored.join(_shares(encoded, counts), "row", "left")
    log_prob = F.col("within") + (F.col("known") + F.coalesce("share", F.lit(0))) * F.lit(UNIT)
    mean = F.when(F.col("n_tokens") > 0, log_prob / F.col("n_tokens"))
    return scored.select(
        *unpacked, "n_tokens", log_prob.alias("log_prob"), mean.alias("mean_log_prob")
    )
