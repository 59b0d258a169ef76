"""Benchmark passages in documents, exact or edited, by edit distance over words.

The CGK walk turns edit distance into Hamming distance: it reads a word sequence through a
pointer, writes the word it points at in every step, and moves on or stays as a random
function of the step and the word says.  Two sequences a few edits apart soon walk in step
again after each edit.  Tables of a few sampled steps each are then bit-sampling LSH: a window
of a document and an item that agree in all steps of some table are a candidate pair, and an
exact alignment decides.

Walks start at every word, forwards over the start of an item and backwards over its end: of
``k`` edits, one of the two halves has ``k / 2`` at most.  A walk takes no more steps than the
item has words, so that it never leaves the item-sized window.  Windows are walked only if
enough of their words occur in any item, and enough of them are rare words of one item:
``k`` edits leave all but ``k`` of an item's words, and of its rare words, in place.

Walks lose their step the sooner the more edits there are, so an item of many words is walked
in pieces: of ``m`` pieces one has ``k / m`` edits at most.  A piece that is found says where its
item would begin, and the whole item is aligned there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peakwise.llm.worker import carried, ranges, slices

#: Largest share of an item's words that may be edited: similarity 0.8 or more.
EDIT_SHARE = 0.2

#: Steps sampled by a table, and tables that share a walk.
SAMPLED = 3
TABLES_PER_WALK = 4

#: Chance to make a candidate of a passage with as many edits as allowed.
RECALL = 0.98

#: Items of similar length walk alike: lengths of a class are within this factor.
CLASS_FACTOR = 1.3

#: Items of more words are walked in pieces of up to so many.
PIECE_WORDS = 64

#: Most walks in each direction; an edit share that needs more for the recall is refused.
MOST_WALKS = 32

#: A word is rare when at most so many items have it.
RARE_ITEMS = 3

#: Words of items held by a task at a time, 40 bytes each; more items take more passes.
SLICE_WORDS = 2_000_000

#: Bytes of texts that a task searches at a time.
SLICE_BYTES = 8 << 20

#: Windows walked and candidates aligned at a time.
WINDOWS = 200_000
ALIGNED = 4096


def words_of(text: str | None) -> list[str]:
    """Lower-case runs of letters, digits and underscores."""
    import re

    return re.findall(r"\w+", (text or "").lower())


def allowed_edits(n_words, edit_share: float = EDIT_SHARE):
    return np.floor(np.asarray(n_words) * edit_share + 1e-9).astype(np.int64)


def _bits(seed: int, steps: int, n_symbols: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2, (steps, n_symbols), dtype=np.int8)


def walk(symbols: np.ndarray, starts: np.ndarray, bits: np.ndarray, direction: int) -> np.ndarray:
    """What the CGK walks from ``starts`` write, a row per step.  ``symbols`` must reach as many
    places beyond any start as there are steps."""
    at = starts.copy()
    written = np.empty((len(bits), len(starts)), dtype=symbols.dtype)
    for step, moves in enumerate(bits):
        written[step] = symbols[at]
        at += direction * moves[written[step]]
    return written


def _keys(written: np.ndarray, samples: np.ndarray) -> np.ndarray:
    """One 64-bit key per table and walk, from the sampled steps."""
    keys = np.zeros((len(samples), written.shape[1]), dtype=np.uint64)
    for column in samples.T:
        keys = (keys ^ written[column].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(31)
    return keys


def walks_for(steps: int, edits: int, recall: float, seed: int = 7) -> int:
    """Walks in each direction that reach ``recall``, by trial on random edited sequences; an
    error if ``MOST_WALKS`` do not."""
    rng = np.random.default_rng(seed)
    trials, near = 300, -(-edits // 2)
    sampled = min(SAMPLED, steps)
    n = 2 * steps + 2
    match = np.empty((trials, 8))
    for trial in range(trials):
        x = rng.integers(1, 1 << 10, n)
        y = x.tolist()
        for _ in range(near):
            place = int(rng.integers(0, max(1, steps // 2)))
            kind = rng.integers(0, 3)
            if kind == 0:
                y[place] = int(rng.integers(1, 1 << 10))
            elif kind == 1:
                y.insert(place, int(rng.integers(1, 1 << 10)))
            else:
                del y[place]
        both = np.concatenate([x, np.array(y + [0] * n)[:n]])
        for w in range(match.shape[1]):
            bits = _bits(1000 * w + trial, steps, 1 << 10)
            a, b = walk(both, np.array([0, n]), bits, 1).T
            match[trial, w] = (a == b).mean()
    hit = match**sampled
    for walks in range(1, MOST_WALKS + 1):
        missed = (1 - hit.mean(axis=1)) ** (walks * TABLES_PER_WALK)
        if 1 - missed.mean() >= recall:
            return walks
    raise ValueError(f"{MOST_WALKS} walks of {steps} words with {edits} edits miss a recall of {recall}")


def _union(low: np.ndarray, high: np.ndarray, end: int) -> np.ndarray:
    """Places below ``end`` in any of the ranges from ``low`` to ``high``, both included."""
    sound = (low <= high) & (low < end)
    low, high = low[sound], np.minimum(high[sound], end - 1)
    order = np.argsort(low, kind="stable")
    low, high = low[order], np.maximum.accumulate(high[order])
    low[1:] = np.maximum(low[1:], high[:-1] + 1)
    row, place = ranges(np.maximum(high - low + 1, 0))
    return low[row] + place


class ItemIndex:
    """Items of a slice as word numbers, with the LSH tables of their length classes."""

    def __init__(self, item_ids: list, texts: list, edit_share: float, recall: float):
        ids_of: dict[tuple, list] = {}
        for i, text in zip(item_ids, texts):
            ids_of.setdefault(tuple(words_of(text)), []).append(i)
        ids_of.pop((), None)
        items = sorted(ids_of, key=len)
        self.number: dict[str, int] = {}
        coded = [
            np.array([self.number.setdefault(w, len(self.number) + 1) for w in words], np.int32)
            for words in items
        ]
        #: Items are distinct word sequences; each may stand for several ids.
        self.n_ids = np.array([len(ids_of[w]) for w in items], dtype=np.int64)
        self.item_ids = [i for w in items for i in ids_of[w]]
        self.lengths = np.array([len(c) for c in coded], dtype=np.int64)
        self.edits = allowed_edits(self.lengths, edit_share)
        self.ends = np.cumsum(self.lengths)
        self.words = np.concatenate([*coded, np.zeros(1, np.int32)])

        word = self.words[:-1]
        owner = np.repeat(np.arange(len(items)), self.lengths)
        word_items = np.unique(np.stack([word, owner]), axis=1)
        having = np.bincount(word_items[0], minlength=len(self.number) + 1)
        rare = (having > 0) & (having <= RARE_ITEMS)
        #: Items of each rare word, and how many rare words of an item edits must leave.
        self.rare_items = word_items[1][rare[word_items[0]]]
        self.n_rare = np.where(rare, having, 0)
        self.rare_from = np.cumsum(self.n_rare) - self.n_rare
        self.left = np.bincount(owner, rare[word], len(items)).astype(np.int64) - self.edits
        #: Pieces of items: the item, where in it the piece begins, its words and edits.
        m = -(-self.lengths // PIECE_WORDS)
        self.piece_item, number = ranges(m)
        self.piece_words = (self.lengths // np.maximum(m, 1))[self.piece_item]
        self.piece_from = number * self.piece_words
        self.piece_edits = (self.edits // np.maximum(m, 1))[self.piece_item]
        #: How far edits outside a piece may move it within its item.
        self.moved = np.where(m > 1, self.edits, 0)[self.piece_item]
        self.classes = []
        left = self.left[self.piece_item]
        for some in (np.flatnonzero(left > 1), np.flatnonzero(left <= 1)):
            some = some[np.argsort(self.piece_words[some], kind="stable")]
            first = 0
            while first < len(some):
                steps = int(self.piece_words[some[first]])
                last = np.searchsorted(self.piece_words[some], steps * CLASS_FACTOR, "right")
                last = max(int(last), first + 1)
                self.classes.append(self._class(some[first:last], steps, recall))
                first = last

    def _class(self, members: np.ndarray, steps: int, recall: float) -> dict:
        edits = int(self.piece_edits[members].max())
        walks = walks_for(steps, edits, recall)
        tables = []
        for direction in (1, -1):
            item = self.piece_item[members]
            starts = self.ends[item] - self.lengths[item] + self.piece_from[members]
            if direction < 0:
                starts = starts + self.piece_words[members] - 1
            for w in range(walks):
                seed = 100 * steps + 2 * w + (direction > 0)
                bits = _bits(seed, steps, len(self.number) + 1)
                rng = np.random.default_rng(seed + 1_000_000)
                sampled = min(SAMPLED, steps)
                samples = np.stack(
                    [rng.permutation(steps)[:sampled] for _ in range(TABLES_PER_WALK)]
                )
                keys = _keys(walk(self.words, starts, bits, direction), samples)
                order = np.argsort(keys, axis=1, kind="stable")
                tables.append(
                    (direction, bits, samples, np.take_along_axis(keys, order, 1), members[order])
                )
        return {"steps": steps, "edits": edits, "members": members, "tables": tables}

    def candidates(self, symbols: np.ndarray, margin: int) -> np.ndarray:
        """Pairs of an item and the place in ``symbols`` where it would begin.

        ``margin`` places of -1 surround every document, at least as many as an item has words
        and may have edits.
        """
        known = np.concatenate([[0], np.cumsum(symbols > 0, dtype=np.int32)])
        item, first, last = self._rare_runs(symbols)
        reach = self.lengths + self.edits
        found = []
        for c in self.classes:
            steps = c["steps"]
            pieces = c["members"][np.argsort(self.piece_item[c["members"]], kind="stable")]
            owner = self.piece_item[pieces]
            begin = np.searchsorted(owner, item, "left")
            run, place = ranges(np.searchsorted(owner, item, "right") - begin)
            piece = pieces[begin[run] + place]
            # Where the piece's item may begin, and end, by the item's rare words.
            span = reach[item[run]]
            low, high = last[run] - span + 1, first[run]
            for direction in (1, -1):
                if (self.left[owner] > 1).all():
                    shift, moved = self.piece_from[piece], self.moved[piece]
                    if direction < 0:
                        left = self.lengths[item[run]] - shift - self.piece_words[piece]
                        bounds = last[run] - left - moved, first[run] + span - 1 - left + moved
                    else:
                        bounds = low + shift - moved, high + shift + moved
                    places = _union(
                        np.maximum(bounds[0], margin), bounds[1], len(symbols) - margin
                    )
                else:
                    places = np.arange(margin, len(symbols) - margin)
                if direction > 0:
                    in_window = known[places + steps] - known[places]
                else:
                    in_window = known[places + 1] - known[places + 1 - steps]
                starts = places[(in_window >= steps - c["edits"]) & (symbols[places] >= 0)]
                for cut in range(0, len(starts), WINDOWS):
                    part = starts[cut : cut + WINDOWS]
                    for table in c["tables"]:
                        if table[0] == direction:
                            found.extend(self._probe(symbols, part, *table))
        if not found:
            return np.empty((0, 2), np.int64)
        return np.unique(np.concatenate(found), axis=0)

    def _rare_runs(self, symbols: np.ndarray):
        """Items with the first and last places of runs of as many of their rare words as edits
        must leave, within an item's reach."""
        word = np.maximum(symbols, 0)
        at = np.flatnonzero(self.n_rare[word])
        row, place = ranges(self.n_rare[word[at]])
        item = self.rare_items[self.rare_from[word[at]][row] + place]
        pairs = np.sort(item * len(symbols) + at[row])
        item, at = pairs // len(symbols), pairs % len(symbols)
        until = np.arange(len(pairs)) + np.maximum(self.left[item], 1) - 1
        run = until < len(pairs)
        run[run] = item[until[run]] == item[run]
        run[run] = at[until[run]] - at[run] < (self.lengths + self.edits)[item[run]]
        return item[run], at[run], at[until[run]]

    def _probe(self, symbols, part, direction, bits, samples, keys, members):
        written = walk(symbols, part, bits, direction)
        for own, table, items in zip(_keys(written, samples), keys, members):
            low = np.searchsorted(table, own, "left")
            hits = np.flatnonzero(table[np.minimum(low, len(table) - 1)] == own)
            if not len(hits):
                continue
            count = np.searchsorted(table, own[hits], "right") - low[hits]
            row, place = ranges(count)
            piece = items[low[hits][row] + place]
            item = self.piece_item[piece]
            begin = part[hits][row] - self.piece_from[piece]
            if direction < 0:
                begin = begin - self.piece_words[piece] + 1
            yield np.stack([item, begin], axis=1)

    def align(self, symbols: np.ndarray, item: np.ndarray, begin: np.ndarray):
        """Least edits between each item and any run of words around its place, with the end
        and the begin of the first such run."""
        edits, ends, begins = [], [], []
        order = np.argsort(self.lengths[item], kind="stable")
        back = np.argsort(order)
        item, begin = item[order], begin[order]
        for cut in range(0, len(item), ALIGNED):
            some, place = item[cut : cut + ALIGNED], begin[cut : cut + ALIGNED]
            height, slack = int(self.lengths[some].max()), int(self.edits[some].max())
            width = height + 2 * slack
            at = np.arange(width)
            spot = np.clip(place[:, None] - slack + at, 0, len(symbols) - 1)
            text = np.maximum(symbols[spot], 0)
            text[at >= (self.lengths[some] + 2 * slack)[:, None]] = 0
            cost = np.zeros((len(some), width + 1), dtype=np.int32)
            origin = np.tile(np.arange(width + 1, dtype=np.int32), (len(some), 1))
            base = self.ends[some] - self.lengths[some]
            for i in range(height):
                word = self.words[np.minimum(base + i, len(self.words) - 1)]
                step = cost[:, :-1] + (text != word[:, None])
                best = np.empty_like(cost)
                best[:, 0] = cost[:, 0] + 1
                best[:, 1:] = np.minimum(step, cost[:, 1:] + 1)
                came = origin.copy()
                came[:, 1:] = np.where(step <= cost[:, 1:] + 1, origin[:, :-1], origin[:, 1:])
                # A word more in the text: costs one per place moved to the right.
                level = best - np.arange(width + 1)
                least = np.minimum.accumulate(level, axis=1)
                source = np.maximum.accumulate(
                    np.where(level == least, np.arange(width + 1), 0), axis=1
                )
                fresh = least + np.arange(width + 1)
                live = (i < self.lengths[some])[:, None]
                cost = np.where(live, fresh, cost)
                origin = np.where(live, np.take_along_axis(came, source, axis=1), origin)
            end = cost.argmin(axis=1)
            rows = np.arange(len(some))
            edits.append(cost[rows, end])
            ends.append(place - slack + end)
            begins.append(place - slack + origin[rows, end])
        if not edits:
            return (np.empty(0, np.int64),) * 3
        return tuple(np.concatenate(x)[back] for x in (edits, ends, begins))


def _passages(index: ItemIndex, texts: list[str | None]):
    """``(text, item, edits, begin, end)`` of passages of items in texts, as word numbers."""
    margin = int(index.lengths.max()) + int(index.edits.max()) + 1
    gap = np.full(margin, -1, np.int32)
    get = index.number.get
    parts, begins, at = [gap], [], margin
    for text in texts:
        words = words_of(text)
        begins.append(at)
        parts += [np.array([get(w, 0) for w in words], np.int32), gap]
        at += len(words) + margin
    # Gaps are -1: no word, and not a place to begin; as a symbol they act like 0.
    symbols = np.concatenate(parts)
    pairs = index.candidates(symbols, margin)
    edits, ends, starts = index.align(symbols, pairs[:, 0], pairs[:, 1])
    begins = np.array(begins)
    text = np.searchsorted(begins, starts, "right") - 1
    good = (edits <= index.edits[pairs[:, 0]]) & (text >= 0) & (ends > starts)
    text, item, edits, ends, starts = (
        x[good] for x in (text, pairs[:, 0], edits, ends, starts)
    )
    return text, item, edits, starts - begins[text], ends - begins[text]


def _matches(index: ItemIndex, kind):
    """Tasks over ``(_doc, text)``: a row for each passage and item id of an Arrow type."""
    import pyarrow as pa

    item_ids = pa.array(index.item_ids, kind)

    names = ["_doc", "item_id", "edits", "n_words", "start_word", "end_word"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 1, SLICE_BYTES)):
            doc, item, edits, starts, ends = _passages(index, batch.column(1).to_pylist())
            row, place = ranges(index.n_ids[item])
            item_id = item_ids.take(
                pa.array((np.cumsum(index.n_ids) - index.n_ids)[item[row]] + place)
            )
            numbers = (edits, index.lengths[item], starts, ends)
            columns = [batch.column(0).take(pa.array(doc[row])), item_id]
            columns += [pa.array(x[row].astype(np.int64)) for x in numbers]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return search


def _without_passages(index: ItemIndex):
    """Tasks over rows with ``__text``: those without a passage, less that column."""
    import pyarrow as pa

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "__text", SLICE_BYTES)):
            doc, *_ = _passages(index, batch.column("__text").to_pylist())
            kept = np.ones(batch.num_rows, dtype=bool)
            kept[doc] = False
            yield batch.drop_columns(["__text"]).filter(pa.array(kept))

    return search


#: Words of every script, as :func:`words_of` finds them.
WORDS = r"(?U)\w+"


def _slices_of(benchmark: DataFrame, edit_share: float, recall: float, slice_words: int):
    """Indexes over slices of the items that have a text."""
    items = benchmark.select("item_id", "text").where("text is not null")
    n_words = F.regexp_count("text", F.lit(WORDS))
    total = items.agg(F.sum(n_words)).first()[0] or 0
    slices = max(1, -(-total // slice_words))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(slices))
    for i in range(slices):
        chosen = items.where(part == i).orderBy("item_id", "text").toArrow()
        index = ItemIndex(
            chosen["item_id"].to_pylist(), chosen["text"].to_pylist(), edit_share, recall
        )
        if len(index.item_ids):
            yield index


def benchmark_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    edit_share: float = EDIT_SHARE,
    recall: float = RECALL,
    doc_id: str = "doc_id",
    text: str = "text",
    slice_words: int = SLICE_WORDS,
) -> DataFrame:
    """``(doc_id, item_id, edits, n_words, start_word, end_word)``: for each document and each
    item found in it the passage with the fewest edits, the first of such.

    Words are compared in lower case and without what stands between them.  An item of ``n``
    words matches a passage at most ``floor(n * edit_share)`` word edits away, so items of
    under five words match exactly; items without words, null or empty, match nothing.  Rows
    that repeat a document's id are one document; a null id is one too.  Items with the same
    id count as one item, and those without an id are left out.  Ids are of any type.  The
    benchmark goes to the tasks in slices of about ``slice_words`` words, one pass over the
    documents for each.  An edit share for which the walks miss ``recall`` is an error.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    rows = docs.select(F.col(f"`{doc_id}`").alias("_doc"), F.col(f"`{text}`").alias("text"))
    benchmark = benchmark.where("item_id is not null")
    kind = benchmark.schema["item_id"].dataType
    schema = (
        f"_doc {rows.schema['_doc'].dataType.simpleString()}, item_id {kind.simpleString()}, "
        "edits bigint, n_words bigint, start_word bigint, end_word bigint"
    )
    found = None
    for index in _slices_of(benchmark, edit_share, recall, slice_words):
        passages = rows.mapInArrow(_matches(index, to_arrow_type(kind)), schema)
        found = passages if found is None else found.unionByName(passages)
    if found is None:
        found = docs.sparkSession.createDataFrame([], schema)
    passage = F.struct("edits", "start_word", "end_word", "n_words")
    best = found.groupBy("_doc", "item_id").agg(F.min(passage).alias("_best"))
    return best.select(F.col("_doc").alias("doc_id"), "item_id", "_best.*").select(
        "doc_id", "item_id", "edits", "n_words", "start_word", "end_word"
    )


def clean_documents(
    docs: DataFrame,
    benchmark: DataFrame,
    edit_share: float = EDIT_SHARE,
    recall: float = RECALL,
    text: str = "text",
    slice_words: int = SLICE_WORDS,
) -> DataFrame:
    """The rows of ``docs`` that hold no passage of the benchmark, of items without an id too.

    Rows are judged where they are, one by one, so a row is not dropped for another with the
    same id or without one.
    """
    packed, others = carried(docs)
    rows = docs.select(*packed)
    for index in _slices_of(benchmark, edit_share, recall, slice_words):
        searched = rows.withColumn("__text", F.col("__others").getField(text))
        rows = searched.mapInArrow(_without_passages(index), rows.schema)
    return rows.select(*others)
