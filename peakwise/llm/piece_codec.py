"""Texts as ids of a BPE piece vocabulary with byte fallback, by vectorised merge rounds.

Distinct words of a slice of texts become one flat numpy array of symbols, at first one for
each character.  In a round every word finds the best rank among its neighbouring symbols,
merges all such pairs at once, the leftmost first where two overlap, and the arrays are
compacted; words without a pair that the vocabulary knows are finished.  What is left of a
character outside the vocabulary are the ids of its bytes.

The rounds give what merging one pair at a time gives: a merge that makes a pair at least as
good as itself ends the round for its word, so that the next round takes that pair first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from peakwise.llm.worker import carried, kept, slices

# The vocabulary's sign for a space, kinds of pieces and of models in its file.
SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
BPE = 2

END_ID = 2

#: Bytes of texts that a task works on at a time.
SLICE_BYTES = 4 << 20

#: Words remembered by a worker, and the longest of them in bytes.
REMEMBERED = 250_000
REMEMBERED_BYTES = 64

#: More than any code point.
POINTS = 0x110000

_NONE = np.iinfo(np.int64).max


class PieceCodec:
    """Ids of texts and texts of ids under a vocabulary file.

    The vocabulary must be BPE with byte fallback and without a normalisation of its own beyond
    the sign for spaces and one space ahead of a text; others are refused.
    """

    def __init__(self, path: str):
        import pyarrow as pa
        from sentencepiece import sentencepiece_model_pb2 as files

        with open(path, "rb") as file:
            model = files.ModelProto.FromString(file.read())
        rules = model.normalizer_spec
        kinds = np.array([p.type for p in model.pieces])
        if (
            model.trainer_spec.model_type != BPE
            or rules.precompiled_charsmap
            or rules.remove_extra_whitespaces
            or not (rules.add_dummy_prefix and rules.escape_whitespaces)
            or model.trainer_spec.treat_whitespace_as_suffix
            or (kinds == BYTE).sum() != 256
            or not set(kinds.tolist()) <= {NORMAL, UNKNOWN, CONTROL, BYTE}
        ):
            raise ValueError("only plain BPE vocabularies with byte fallback can be used")
        self.path = path
        self.size = len(model.pieces)
        self._pairs(model)
        self._texts(model, kinds)
        self.known = pa.array([], pa.string())
        self.flat = np.empty(0, np.int32)
        self.cuts = np.zeros(1, dtype=np.int64)

    def _pairs(self, model) -> None:
        """Symbols and the pairs that merge.  A symbol is the id of a piece, or a number beyond
        them for characters that only occur within pieces, or beyond those a code point."""
        number = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        rank_of = np.unique([-p.score for p in model.pieces], return_inverse=True)[1]
        pieces = list(number)
        for char in sorted(set("".join(pieces)) - number.keys()):
            number[char] = self.size + len(number.keys() - set(pieces))
        #: Whether spaces stand at the start of pieces only, so that texts split before them.
        self.spaced = not any(SPACE in p.lstrip(SPACE) for p in pieces)
        self.width = max(self.size, *number.values()) + 1
        self.base = self.width + POINTS
        chars = sorted((ord(c), i) for c, i in number.items() if len(c) == 1)
        self.char_points = np.array([c for c, _ in chars])
        self.char_symbols = np.array([i for _, i in chars])
        self.within = {i: ord(c) for c, i in number.items() if i >= self.size}
        found = sorted(
            (number[p[:k]] * self.base + number[p[k:]], number[p])
            for p in pieces
            for k in range(1, len(p))
            if p[:k] in number and p[k:] in number
        )
        self.keys = np.array([key for key, _ in found] + [_NONE])
        self.merges = np.array([to for _, to in found] + [0])
        self.ranks = rank_of[self.merges]
        self.ranks[-1] = self.size
        #: Whether a merge never makes a pair that is as good as itself.
        rank_of = np.append(rank_of, np.full(self.base - len(rank_of), -1))
        sides = np.divmod(self.keys[:-1], self.base)
        self.orderly = bool((np.maximum(*(rank_of[s] for s in sides)) < self.ranks[:-1]).all())
        self.beside = np.unique([ord(a) * POINTS + ord(b) for p in pieces for a, b in zip(p, p[1:])])

    def _texts(self, model, kinds: np.ndarray) -> None:
        """Bytes of every id, and of every id that opens a text."""
        import pyarrow as pa

        texts = [p.piece.replace(SPACE, " ").encode() for p in model.pieces]
        for value, i in enumerate(np.flatnonzero(kinds == BYTE)):
            texts[i] = bytes([value])
        for i in np.flatnonzero(kinds == UNKNOWN):
            texts[i] = model.trainer_spec.unk_surface.encode()
        for i in np.flatnonzero(kinds == CONTROL):
            texts[i] = b""
        opening = [t[1:] if k == NORMAL and t[:1] == b" " else t for t, k in zip(texts, kinds)]
        self.texts = pa.array(texts + opening, pa.binary())
        self.silent = kinds == CONTROL
        self.byte_ids = np.flatnonzero(kinds == BYTE)

    # Encoding

    def _rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair and what it merges to; ``size`` where it does not."""
        wanted = left * self.base + right
        at = np.searchsorted(self.keys, wanted)
        at[self.keys[at] != wanted] = len(self.keys) - 1
        return self.ranks[at], self.merges[at]

    def _merged(self, symbols: np.ndarray, part: np.ndarray) -> np.ndarray:
        """``symbols`` after all merges within equal values of ``part``; a merged pair's first
        symbol holds the result, its second -1."""
        result = symbols.copy()
        at, held, owner = np.arange(len(symbols)), symbols.copy(), part
        # Rank of each symbol and the next one, and what they merge to.
        rank = np.full(len(held), self.size)
        to = np.zeros(len(held), dtype=np.int64)
        pair = np.flatnonzero(owner[:-1] == owner[1:])
        rank[pair], to[pair] = self._rank(held[pair], held[pair + 1])
        while len(at):
            first = np.flatnonzero(np.diff(owner, prepend=owner[0] - 1))
            best = np.minimum.reduceat(rank, first)
            best = np.repeat(best, np.diff(first, append=len(at)))
            live = best < self.size
            hit = np.flatnonzero((rank == best) & live)
            if not len(hit):
                break
            # Every second one of hits that follow each other, from the left.
            opens = np.diff(hit, prepend=-2) != 1
            place = np.arange(len(hit))
            hit = hit[(place - np.maximum.accumulate(np.where(opens, place, 0))) % 2 == 0]
            if not self.orderly:
                hit = self._undisturbed(hit, held, owner, to, best)
            held[hit] = to[hit]
            result[at[hit]] = held[hit]
            result[at[hit + 1]] = -1
            live[hit + 1] = False
            hit = (np.cumsum(live) - 1)[hit]
            at, held, owner, rank, to = at[live], held[live], owner[live], rank[live], to[live]
            # Pairs with a merged symbol are new.
            rank[hit] = self.size
            pair = np.concatenate([hit, hit[hit > 0] - 1])
            pair = pair[pair < len(at) - 1]
            pair = pair[owner[pair] == owner[pair + 1]]
            rank[pair], to[pair] = self._rank(held[pair], held[pair + 1])
        return result

    def _undisturbed(self, hit, held, owner, to, best) -> np.ndarray:
        """Hits up to the first of each word whose merge makes a pair as good or better."""
        made = to[hit]
        last = len(held) - 1
        follows = np.flatnonzero((hit[1:] - hit[:-1] == 2) & (owner[hit[1:]] == owner[hit[:-1]])) + 1
        before = held[np.maximum(hit - 1, 0)]
        before[follows] = made[follows - 1]
        has_before = (hit > 0) & (owner[np.maximum(hit - 1, 0)] == owner[hit])
        after = np.minimum(hit + 2, last)
        has_after = (hit + 2 <= last) & (owner[after] == owner[hit])
        left = np.where(has_before, self._rank(before, made)[0], self.size)
        right = np.where(has_after, self._rank(made, held[after])[0], self.size)
        worse = np.minimum(left, right) > best[hit]
        if worse.all():
            return hit
        # Hits behind a disturbing one of the same word wait.
        disturbing = np.flatnonzero(~worse)
        words, at = np.unique(owner[hit][disturbing], return_index=True)
        cut = np.full(len(hit), len(hit))
        word = np.searchsorted(words, owner[hit])
        found = (word < len(words)) & (words[np.minimum(word, len(words) - 1)] == owner[hit])
        cut[found] = disturbing[at][word[found]]
        return hit[np.arange(len(hit)) <= cut]

    def _encoded(self, words) -> tuple[np.ndarray, np.ndarray]:
        """Ids of an Arrow array of words, one after the other, and how many each has."""
        offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset :][: len(words) + 1]
        raw = words.buffers()[2]
        raw = raw[offsets[0] : offsets[-1]].to_pybytes() if raw else b""
        starts = np.frombuffer(raw, np.uint8) & 0xC0 != 0x80
        points = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32).astype(np.int64)
        if not len(points):
            return np.empty(0, np.int32), np.zeros(len(words), dtype=np.int64)
        points[points == 0x20] = ord(SPACE)
        word_ends = np.concatenate([[0], np.cumsum(starts)])[offsets[1:] - offsets[0]]
        # Characters that stand side by side in no piece are in parts of their own.
        beside = points[:-1] * POINTS + points[1:]
        near = np.searchsorted(self.beside, beside)
        cut = np.ones(len(points), dtype=bool)
        cut[1:] = self.beside[np.minimum(near, len(self.beside) - 1)] != beside
        cut[word_ends[word_ends < len(points)]] = True
        char = np.minimum(np.searchsorted(self.char_points, points), len(self.char_points) - 1)
        known = self.char_points[char] == points
        symbols = np.where(known, self.char_symbols[char], self.width + points)
        symbols = self._merged(symbols, np.cumsum(cut))
        left = np.flatnonzero(symbols >= 0)
        counts = np.diff(np.searchsorted(left, word_ends), prepend=0)
        ids = symbols[left]
        odd = np.flatnonzero(ids >= self.size)
        if not len(odd):
            return ids.astype(np.int32), counts
        chars, entry = np.unique(points[left[odd]], return_inverse=True)
        spelt = [self.byte_ids[list(chr(c).encode())] for c in chars]
        lengths = np.ones(len(ids), dtype=np.int64)
        lengths[odd] = np.array([len(s) for s in spelt])[entry]
        result = np.repeat(ids, lengths)
        ends = np.cumsum(lengths)
        for k in range(4):
            has = lengths[odd] > k
            value = np.array([s[k] if k < len(s) else 0 for s in spelt])[entry]
            result[(ends[odd] - lengths[odd] + k)[has]] = value[has]
        owner = np.repeat(np.arange(len(words)), counts)
        counts = np.bincount(owner, weights=lengths, minlength=len(words)).astype(np.int64)
        return result.astype(np.int32), counts

    def _words(self, texts):
        """Distinct words of an Arrow array of texts, the word at each place, and how many
        words each text has."""
        import pyarrow as pa
        import pyarrow.compute as pc

        texts = pc.replace_substring(texts.fill_null(""), SPACE, " ")
        led = pc.binary_join_element_wise(pa.scalar(" "), texts, "")
        texts = pc.if_else(pc.equal(pc.binary_length(texts), 0), texts, led)
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset :][: len(texts) + 1]
        filled = offsets[:-1][np.diff(offsets) > 0]
        if not len(filled):
            return pa.array([], pa.string()), np.empty(0, np.int64), np.zeros(len(texts), np.int64)
        raw = np.frombuffer(texts.buffers()[2], np.uint8)[: offsets[-1]]
        starts = filled
        if self.spaced:
            space = raw == 0x20
            opens = space.copy()
            opens[1:] &= ~space[:-1]
            opens[: offsets[0]] = False
            opens[filled] = True
            starts = np.flatnonzero(opens)
        ends = np.append(starts, offsets[-1]).astype(np.int32)
        buffers = [None, pa.py_buffer(ends), texts.buffers()[2]]
        words = pa.Array.from_buffers(pa.string(), len(starts), buffers).dictionary_encode()
        counts = np.diff(np.searchsorted(starts, offsets))
        return words.dictionary, words.indices.to_numpy(), counts

    def _ids_of(self, words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct words: a table of them, its cuts, and each word's entry."""
        import pyarrow as pa
        import pyarrow.compute as pc

        at = pc.index_in(words, value_set=self.known)
        fresh = np.flatnonzero(at.is_null().to_numpy(zero_copy_only=False))
        new = words.take(pa.array(fresh))
        short = pc.less_equal(pc.binary_length(new), REMEMBERED_BYTES).to_numpy(zero_copy_only=False)
        # Words worth remembering first, so that they end the remembered table.
        order = np.argsort(~short, kind="stable")
        new = new.take(pa.array(order))
        ids, counts = self._encoded(new)
        entry = at.fill_null(-1).to_numpy().astype(np.int64)
        entry[fresh[order]] = len(self.known) + np.arange(len(new))
        flat = np.concatenate([self.flat, ids])
        cuts = np.concatenate([self.cuts, self.cuts[-1] + np.cumsum(counts)])
        kept_words = len(self.known) + int(short.sum())
        if kept_words <= REMEMBERED:
            self.known = pa.concat_arrays([self.known, new.slice(0, int(short.sum()))])
            self.cuts = cuts[: kept_words + 1]
            self.flat = flat[: self.cuts[-1]]
        return flat, cuts, entry

    def encode(self, texts, end: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
        """Ids of an Arrow array of texts, one after the other and each followed by ``end``, and
        how many each text has.  A null text counts as empty."""
        words, index, counts = self._words(texts)
        flat, cuts, entry = self._ids_of(words)
        flat = np.concatenate([flat, np.array(end, np.int32)])
        ends = np.cumsum(counts)
        index = np.insert(entry[index], ends, len(cuts) - 1)
        cuts = np.append(cuts, len(flat))
        lengths = np.diff(cuts)[index]
        upto = np.cumsum(lengths)
        place = np.arange(upto[-1] if len(upto) else 0)
        ids = flat[np.repeat(cuts[index] - upto + lengths, lengths) + place]
        ends = ends + np.arange(1, len(ends) + 1)
        return ids, np.diff(np.concatenate([[0], upto])[ends], prepend=0)

    # Decoding

    def decode(self, ids: np.ndarray, counts: np.ndarray):
        """Arrow array of the texts of ids, so many for each.

        Control ids have no text, the space ahead of a text goes.  Bytes that are no UTF-8,
        which encoding never makes, and ids out of range are left to the library.
        """
        import pyarrow as pa
        import pyarrow.compute as pc

        if len(ids) and not (0 <= ids.min() and ids.max() < self.size):
            raise ValueError(f"ids must be from 0 to {self.size - 1}")
        ends = np.cumsum(counts)
        entry = ids.astype(np.int64)
        said = np.flatnonzero(~self.silent[entry])
        if len(said):
            opening = np.searchsorted(said, ends - counts)
            inside = np.flatnonzero(opening < len(said))
            inside = inside[said[opening[inside]] < ends[inside]]
            entry[said[opening[inside]]] += self.size
        pieces = self.texts.take(pa.array(entry))
        offsets = np.frombuffer(pieces.buffers()[1], np.int32)[pieces.offset :][: len(entry) + 1]
        cuts = np.ascontiguousarray(offsets[np.concatenate([[0], ends])])
        raw = pieces.buffers()[2] or pa.py_buffer(b"")
        texts = pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(cuts), raw])
        try:
            return pc.cast(texts, pa.string())
        except pa.ArrowInvalid:
            return pa.array(self._by_library(texts, ids, ends), pa.string())

    def _by_library(self, texts, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=self.path)
        result = []
        for text, end, before in zip(texts.to_pylist(), ends, [0, *ends]):
            try:
                result.append(text.decode())
            except UnicodeDecodeError:
                result.append(library.decode(ids[before:end].tolist()))
        return result


def _schema(docs: DataFrame, packed: list, name: str, kind) -> StructType:
    others = docs.select(*packed).schema.fields
    return StructType([*others, StructField(name, kind)])


def encoded(
    docs: DataFrame, model_path: str, end_id: int | None = END_ID, text: str = "text",
    ids: str = "ids",
) -> DataFrame:
    """The columns of ``docs`` but the text, and ``ids ARRAY<INT>`` of the whole text.

    The text is encoded as the vocabulary's own library does without sampling, followed by
    ``end_id`` unless that is None.  A null text counts as empty and has the end id alone.
    Rows stay as they are, repeated ones too, and nothing is shuffled.  Another column called
    like the result is replaced.  ``model_path`` must be readable where tasks run.
    """
    import pyarrow as pa

    end = () if end_id is None else (end_id,)
    packed, unpacked = carried(docs, text, ids)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = kept("pieces", model_path, lambda: PieceCodec(model_path))
        for batch in batches:
            for rows in slices(batch, 0, SLICE_BYTES):
                flat, counts = codec.encode(rows.column(0), end)
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
                coded = pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns[1:], coded], names=[*batch.schema.names[1:], ids]
                )

    rows = docs.select(F.col(f"`{text}`").cast("string").alias("__text"), *packed)
    schema = _schema(docs, packed, ids, ArrayType(IntegerType()))
    return rows.mapInArrow(encode, schema).select(*unpacked, F.col(f"`{ids}`"))


def decoded(
    docs: DataFrame, model_path: str, ids: str = "ids", text: str = "decoded"
) -> DataFrame:
    """The columns of ``docs`` and ``text``, the text of ``ids ARRAY<INT>``; a null array has a
    null text, a null within one is an error.  Another column called ``text`` is replaced."""
    import pyarrow as pa

    packed, unpacked = carried(docs, text)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = kept("pieces", model_path, lambda: PieceCodec(model_path))
        for batch in batches:
            for rows in _id_slices(batch, SLICE_BYTES // 4):
                lists = rows.column(0)
                counts = lists.value_lengths().fill_null(0).to_numpy().astype(np.int64)
                flat = lists.flatten()
                if flat.null_count:
                    raise ValueError("an array of ids holds a null")
                texts = codec.decode(flat.to_numpy(), counts)
                missing = lists.is_null()
                if lists.null_count:
                    texts = pa.compute.if_else(missing, pa.scalar(None, pa.string()), texts)
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns[1:], texts], names=[*batch.schema.names[1:], text]
                )

    rows = docs.select(F.col(f"`{ids}`").cast("array<int>").alias("__ids"), *packed)
    schema = _schema(docs, packed, text, StringType())
    return rows.mapInArrow(decode, schema).select(*unpacked, F.col(f"`{text}`"))


def _id_slices(batch, size: int) -> Iterator:
    """Runs of a batch's rows with up to so many ids, and a row at least."""
    ends = np.cumsum(batch.column(0).value_lengths().fill_null(0).to_numpy())
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
        yield batch.slice(at, upto - at)
        at = upto
