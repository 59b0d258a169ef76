"""Documents as token ids in files of frequency-ranked, byte-aligned variable-length codes.

Ids are ranked by their number of occurrences in the corpus, so that frequent ids are short.
A file is a Parquet table of blocks of whole documents in id order.  A block holds

``control``  one byte for four ids: two bits each, the number of bytes of the rank less one,
             the first id in the lowest bits;
``data``     the bytes of the ranks, little-endian, without their leading zero bytes;
``doc_ids``, ``counts``  the documents of the block and their numbers of ids.

The rank table is a second Parquet table.  Blocks are decoded by looking up each control
byte's four lengths in a table.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from peakwise.llm.worker import kept, ranges, slices
from peakwise.session import shared_path
from peakwise.sources.tables import write_table

END_ID = 2

#: Ids of a block; a block ends with the document that reaches it.
BLOCK_IDS = 1 << 18

#: Documents per file, on average.
FILE_DOCS = 20_000

# Fixed value: single ASCII characters that are pieces of their own after letters.
PUNCTUATION = frozenset('!"#$%&()*+,-./:;<=>?@[]^_`{|}~' + chr(92))

#: Bytes of texts or ids that a task works on at a time.
SLICE_BYTES = 4 << 20

#: Chunks and pieces of text remembered by a worker, about 200 bytes each.
REMEMBERED = 250_000

# The pre-tokenization pattern of tokenizers whose texts split into chunks.
CHUNK_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class ChunkEncoder:
    """Ids of texts through a remembered table of their white-space separated chunks.

    With a tokenizer that lower-cases, drops white space and splits texts into letters, single
    digits and other characters, a chunk's ids do not depend on its surroundings.  An unseen
    chunk is split into pieces by the tokenizer's own pattern, and the library's model encodes
    each piece once.  Chunks with marks of special tokens, control characters or characters
    beyond Latin script go through the library as they are; so do all texts of tokenizers of
    any other kind.
    """

    def __init__(self, path: str):
        import json
        import os

        import regex

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.type = _id_type(self.tokenizer)
        self.pieces = _Remembered(self._piece)
        #: Remembered chunks, their ids one after the other, and where each one's begin and end.
        self.known = None
        self.flat = np.empty(0, self.type)
        self.cuts = np.zeros(1, dtype=np.int64)
        self.find = regex.compile(CHUNK_PATTERN).findall
        self.odd = regex.compile(r"[\x00-\x1f\x7f-\xa0\u0250-\U0010ffff]|<\|").search
        self.tokenize = self.tokenizer.model.tokenize
        # Byte-level names: printable bytes name themselves, others the code points from 256.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in plain]
        self.names = {b: b for b in plain} | {b: 256 + i for i, b in enumerate(other)}
        parts = json.loads(self.tokenizer.to_str())
        steps = parts["pre_tokenizer"].get("pretokenizers", []) if parts["pre_tokenizer"] else []
        lower = {"type": "Lowercase"} in ((parts["normalizer"] or {}).get("normalizers") or [])
        self.chunked = lower and bool(steps) and (
            steps[0].get("pattern") == {"Regex": CHUNK_PATTERN}
        )

    def _piece(self, piece: str) -> bytes:
        if not piece.isascii():
            piece = piece.encode().decode("latin-1").translate(self.names)
        return array(self.type, [t.id for t in self.tokenize(piece)]).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        if chunk.isascii():
            if chunk.isalpha():
                return self.pieces[chunk.lower()]
            if chunk[-1:] in PUNCTUATION and chunk[:-1].isalpha():
                return self.pieces[chunk[:-1].lower()] + self.pieces[chunk[-1]]
        if self.odd(chunk):
            return self._whole(chunk)
        return b"".join(map(self.pieces.__getitem__, self.find(chunk.lower())))

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return array(self.type, ids).tobytes()

    def __call__(self, text: str | None) -> list[int]:
        """Ids of a text; none for null."""
        import pyarrow as pa

        return self.rows(pa.array([text], pa.string()))[0].tolist()

    def rows(self, texts, end: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
        """Ids of an Arrow array of texts, one after the other and each followed by ``end``, and
        how many each text has.  Equal chunks are looked up once."""
        import pyarrow.compute as pc

        texts = texts.fill_null("")
        if self.chunked:
            split = pc.ascii_split_whitespace(texts)
            ends = np.cumsum(np.diff(split.offsets.to_numpy()))
            coded = split.flatten().dictionary_encode()
            flat, cuts, index = self._ids_of(coded.dictionary)
            index = index[coded.indices.to_numpy()]
        else:
            ends = np.arange(1, len(texts) + 1)
            index = np.arange(len(texts))
            flat, cuts = self._joined([self._whole(t) for t in texts.to_pylist()])
        # One more entry, the end of each text.
        flat = np.concatenate([flat, np.array(end, self.type)])
        index = np.insert(index, ends, len(cuts) - 1)
        cuts = np.append(cuts, len(flat))
        ends = ends + np.arange(1, len(ends) + 1)
        counts = np.diff(cuts)[index]
        upto = np.cumsum(counts)
        result = flat[np.repeat(cuts[index] - upto + counts, counts) + np.arange(counts.sum())]
        return result, np.diff(np.concatenate([[0], upto])[ends], prepend=0)

    def _joined(self, ids: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        flat = np.frombuffer(b"".join(ids), self.type)
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // flat.itemsize
        return flat, np.concatenate([[0], np.cumsum(lengths)])

    def _ids_of(self, chunks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct chunks: a table of them, its cuts, and each chunk's entry."""
        import pyarrow as pa
        import pyarrow.compute as pc

        known = chunks.slice(0, 0) if self.known is None else self.known
        at = pc.index_in(chunks, value_set=known)
        new = chunks.filter(at.is_null())
        flat, cuts = self._joined([self._chunk(c) if c else b"" for c in new.to_pylist()])
        index = at.fill_null(-1).to_numpy().astype(np.int64)
        index[index < 0] = len(known) + np.arange(len(new))
        flat = np.concatenate([self.flat, flat])
        cuts = np.concatenate([self.cuts, cuts[1:] + self.cuts[-1]])
        if len(known) + len(new) <= REMEMBERED:
            self.known, self.flat, self.cuts = pa.concat_arrays([known, new]), flat, cuts
        return flat, cuts, index


class _Remembered(dict):
    """Values by key, worked out when first asked for; the first so many stay."""

    def __init__(self, make: Callable):
        self.make = make

    def __missing__(self, key):
        value = self.make(key)
        if len(self) < REMEMBERED:
            self[key] = value
        return value


def _id_type(tokenizer) -> str:
    """Two bytes for each id if all fit, else four."""
    return "H" if tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "I"


def code(ranks: np.ndarray, counts: np.ndarray):
    """Control and data bytes of documents one after the other, each from a control byte of its
    own, and where each document's control and data bytes end."""
    ranks = ranks.astype("<u4")
    longer = (ranks > 0xFF).astype(np.uint8)
    longer += ranks > 0xFFFF
    longer += ranks > 0xFFFFFF
    padded = -(-counts // 4) * 4
    row, place = ranges(counts)
    lanes = np.zeros(padded.sum(), dtype=np.uint8)
    lanes[(np.cumsum(padded) - padded)[row] + place] = longer
    a, b, c, d = lanes.reshape(-1, 4).T
    control = a | b << 2 | c << 4 | d << 6
    used = np.arange(4, dtype=np.uint8) <= longer[:, None]
    data = ranks.view(np.uint8).reshape(-1, 4)[used]
    data_ends = np.concatenate([[0], np.cumsum(longer + np.int64(1))])[np.cumsum(counts)]
    return control, np.cumsum(padded) // 4, data, data_ends


def decode(control: bytes, data: bytes, counts: np.ndarray) -> np.ndarray:
    """Ranks of documents coded one after the other, each from a control byte of its own."""
    lengths_of = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1
    lengths = lengths_of[np.frombuffer(control, np.uint8)].ravel()
    padded = -(-counts // 4) * 4
    owner_end = np.repeat(np.cumsum(padded) - padded + counts, padded)
    lengths = lengths[np.arange(len(lengths)) < owner_end]
    at = np.cumsum(lengths) - lengths
    raw = np.frombuffer(data + bytes(4), np.uint8)
    ranks = raw[at].astype(np.uint32)
    for i in (1, 2, 3):
        longer = np.flatnonzero(lengths > i)
        ranks[longer] |= raw[at[longer] + i].astype(np.uint32) << np.uint32(8 * i)
    return ranks


def tokenized(
    docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``(doc_id, ids BINARY)``: a document's ids and ``end_id`` as :class:`ChunkEncoder` has
    them."""
    import pyarrow as pa


    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept("encoder", tokenizer_path, lambda: ChunkEncoder(tokenizer_path))
        for batch in batches:
            for rows in slices(batch, 1, SLICE_BYTES):
                ids, counts = encoder.rows(rows.column(1), (end_id,))
                ends = np.cumsum(counts) * ids.itemsize
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), _binary(ids, ends)], names=["doc_id", "ids"]
                )

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text)
    return rows.mapInArrow(encode, "doc_id bigint, ids binary")


def _binary(values: np.ndarray, ends: np.ndarray):
    """Arrow array of the bytes of ``values`` cut at ``ends``."""
    import pyarrow as pa

    offsets = np.concatenate([[0], ends]).astype(np.int32)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))]
    return pa.Array.from_buffers(pa.binary(), len(ends), buffers)


def _id_ranks(table: DataFrame, wide: str, n_ids: int) -> np.ndarray:
    """Rank of every id, by falling count and rising id; one row per id reaches the driver."""
    import pyarrow as pa

    def count(batches):
        total = np.zeros(n_ids, dtype=np.int64)
        for batch in batches:
            for rows in slices(batch, 0, SLICE_BYTES):
                flat = np.frombuffer(b"".join(rows.column(0).to_pylist()), wide)
                total += np.bincount(flat, minlength=n_ids)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen), pa.array(total[seen])], names=["id", "n"]
        )

    rows = table.select("ids").mapInArrow(count, "id bigint, n bigint")
    counted = rows.groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(n_ids, dtype=np.int64)
    counts[counted["id"].to_numpy()] = counted["n"].to_numpy()
    ranks = np.empty(n_ids, dtype=np.uint32)
    ranks[np.lexsort((np.arange(n_ids), -counts))] = np.arange(n_ids)
    return ranks


#: What rows without an id are bounded as.
NO_ID = np.iinfo(np.int64).min


def _bounds(table: DataFrame, file_docs: int) -> np.ndarray:
    """Largest ids of the files but the last."""
    n = table.count()
    files = max(1, -(-n // file_docs))
    if files == 1:
        return np.empty(0, np.int64)
    shares = [i / files for i in range(1, files)]
    found = table.agg(F.percentile_approx("doc_id", shares, 100 * files)).first()[0]
    return np.unique(np.array(found or [], dtype=np.int64))


def _cuts(table: DataFrame, file_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Largest ids of the stretches of ids but the last, and the files of each stretch.

    A stretch is a file, but for ids that over ``file_docs`` rows share: each of those is a
    stretch of its own, of as many files as its rows need.  They are looked for where a file
    would have several times its share of rows, and are no more than there are files.
    """
    import pyarrow as pa

    bounds = _bounds(table, file_docs)
    key = F.coalesce("doc_id", F.lit(int(NO_ID)))

    def count(batches):
        total = np.zeros(len(bounds) + 1, dtype=np.int64)
        for batch in batches:
            file = np.searchsorted(bounds, batch.column(0).to_numpy(), "left")
            total += np.bincount(file, minlength=len(total))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(total))), pa.array(total)], names=["file", "n"]
        )

    rows = table.select(key.alias("key"))
    sizes = rows.mapInArrow(count, "file bigint, n bigint").groupBy("file").agg(F.sum("n").alias("n"))
    crowded = [r.file for r in sizes.where(F.col("n") > 4 * file_docs).collect()]
    hot = []
    if crowded:
        lows = [None if f == 0 else int(bounds[f - 1]) for f in crowded]
        highs = [None if f == len(bounds) else int(bounds[f]) for f in crowded]
        within = F.lit(False)
        for low, high in zip(lows, highs):
            own = F.lit(True) if low is None else F.col("key") > low
            within = within | (own if high is None else own & (F.col("key") <= high))
        counted = rows.where(within).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        hot = counted.where(F.col("n") > file_docs).collect()
    before = [r["key"] - 1 for r in hot if r["key"] > NO_ID]
    cuts = np.unique(np.array([*bounds, *before, *[r["key"] for r in hot]], dtype=np.int64))
    files = np.ones(len(cuts) + 1, dtype=np.int64)
    for r in hot:
        files[np.searchsorted(cuts, r["key"], "left")] = -(-r["n"] // file_docs)
    return cuts, files


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int = END_ID,
    doc_id: str = "doc_id",
    text: str = "text",
    file_docs: int = FILE_DOCS,
    block_ids: int = BLOCK_IDS,
) -> str:
    """Write every document, in ascending id order, below ``path``: ``blocks`` and ``ranks``.

    Null texts count as empty, and an empty document is its end id.  Documents without an id
    come first.  Rows that repeat an id all go to the file, ordered by their codes, or by a
    digest of their place if over ``file_docs`` of them do: those are dealt over several files.
    Other columns are ignored.  Texts are encoded once; the ids wait in a written table for the
    corpus-wide ranks.
    """
    import pyarrow as pa
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    tokenizer = Tokenizer.from_file(tokenizer_path)
    n_ids = max(tokenizer.get_vocab_size(with_added_tokens=True), end_id + 1)
    wide = {"H": "<u2", "I": "<u4"}[_id_type(tokenizer)]
    stage = shared_path(spark, "token-ids")
    coded = tokenized(docs, tokenizer_path, end_id, doc_id, text)
    coded = coded.withColumn("row", F.monotonically_increasing_id())
    coded.write.option("compression", "zstd").parquet(stage)
    table = spark.read.schema("doc_id bigint, ids binary, row bigint").parquet(stage)
    ranks = _id_ranks(table, wide, n_ids)
    cuts, files = _cuts(table, file_docs)
    first = np.cumsum(files) - files

    def encode(batches):
        for batch in batches:
            for rows in slices(batch, 1, SLICE_BYTES):
                stretch = np.searchsorted(
                    cuts, rows.column(0).fill_null(int(NO_ID)).to_numpy(), "left"
                )
                several = files[stretch]
                # A digest of the row's place deals a hot id's rows over its files, in its order.
                tie = rows.column(2).to_numpy().astype(np.uint64) + np.uint64(1)
                tie = (tie * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
                tie = np.where(several > 1, tie.astype(np.int64), 0)
                file = first[stretch] + (tie * several >> 32)
                raw = rows.column(1).to_pylist()
                values = ranks[np.frombuffer(b"".join(raw), wide)]
                counts = np.fromiter(map(len, raw), np.int64, len(raw)) // np.dtype(wide).itemsize
                control, control_ends, data, data_ends = code(values, counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(file.astype(np.int32)),
                        rows.column(0),
                        pa.array(tie),
                        pa.array(counts),
                        _binary(control, control_ends),
                        _binary(data, data_ends),
                    ],
                    names=["file", "doc_id", "tie", "n", "control", "data"],
                )

    names = ["file", "block", "n_ids", "doc_ids", "counts", "control", "data"]

    def block(file, number, rows):
        doc_ids, counts, control, data = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([file], pa.int32()),
                pa.array([number], pa.int32()),
                pa.array([sum(counts)], pa.int64()),
                pa.array([list(doc_ids)], pa.list_(pa.int64())),
                pa.array([list(counts)], pa.list_(pa.int64())),
                pa.array([b"".join(control)], pa.binary()),
                pa.array([b"".join(data)], pa.binary()),
            ],
            names=names,
        )

    def pack(batches):
        file, number, rows, size = None, 0, [], 0
        for batch in (part for whole in batches for part in slices(whole, 5, SLICE_BYTES)):
            for f, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if rows and (f != file or size >= block_ids):
                    yield block(file, number, rows)
                    number, rows, size = number + 1, [], 0
                if f != file:
                    file, number = f, 0
                rows.append((row[0], *row[2:]))
                size += row[2]
        if rows:
            yield block(file, number, rows)

    coded = "file int, doc_id bigint, tie bigint, n bigint, control binary, data binary"
    schema = (
        "file int, block int, n_ids bigint, doc_ids array<bigint>, counts array<bigint>, "
        "control binary, data binary"
    )
    (
        table.mapInArrow(encode, coded)
        .repartitionById(int(files.sum()), "file")
        .sortWithinPartitions("file", "doc_id", "tie", "n", "data")
        .mapInArrow(pack, schema)
        .write.option("compression", "uncompressed")
        .parquet(f"{path}/blocks")
    )
    order = np.argsort(ranks)
    table = pa.table({"rank": np.arange(n_ids), "id": order.astype(np.int64)})
    spark.createDataFrame(table).coalesce(1).write.parquet(f"{path}/ranks")
    return path


def _starts(blocks: DataFrame) -> DataFrame:
    """Ids ahead of each block: sums over the blocks of a file, and over the files."""
    so_far = Window.partitionBy("file").orderBy("block")
    sizes = blocks.select("file", "block", "n_ids")
    files = sizes.groupBy("file").agg(F.sum("n_ids").alias("_file_ids"))
    files = files.select(
        "file",
        (F.sum("_file_ids").over(Window.orderBy("file")) - F.col("_file_ids")).alias("_base"),
    )
    within = F.sum("n_ids").over(so_far) - F.col("n_ids")
    return sizes.withColumn("_within", within).join(files, "file").select(
        "file", "block", (F.col("_base") + F.col("_within")).alias("_start")
    )


def _read(spark: SparkSession, path: str, result: Callable, result_type: str, name: str):
    import pyarrow as pa

    pairs = spark.read.parquet(f"{path}/ranks").select("rank", "id").toArrow()
    id_of = np.zeros(len(pairs), dtype="<u4")
    id_of[pairs["rank"].to_numpy()] = pairs["id"].to_numpy()
    blocks = spark.read.parquet(f"{path}/blocks")
    schema = f"file int, block int, doc_id bigint, _ahead bigint, n_tokens bigint, {result_type}"

    def documents(batches):
        for batch in (part for whole in batches for part in slices(whole, 6, SLICE_BYTES)):
            for file, number, _, doc_ids, counts, control, data in zip(
                *(c.to_pylist() for c in batch.columns)
            ):
                counts = np.array(counts, dtype=np.int64)
                ids = id_of[decode(control, data, counts)]
                ends = np.cumsum(counts)
                values = [result(ids[e - n : e]) for e, n in zip(ends.tolist(), counts.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(counts), file, np.int32)),
                        pa.array(np.full(len(counts), number, np.int32)),
                        pa.array(doc_ids, pa.int64()),
                        pa.array(ends - counts),
                        pa.array(counts),
                        pa.array(values),
                    ],
                    names=["file", "block", "doc_id", "_ahead", "n_tokens", name],
                )

    columns = ("file", "block", "n_ids", "doc_ids", "counts", "control", "data")
    rows = blocks.select(*columns).mapInArrow(documents, schema)
    return rows.join(_starts(blocks), ["file", "block"]).select(
        "doc_id", (F.col("_start") + F.col("_ahead")).alias("start"), "n_tokens", name
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids ARRAY<BIGINT>)`` from written files; ``start`` counts the
    ids of all documents before."""
    return _read(spark, path, lambda ids: ids.astype(np.int64), "ids array<bigint>", "ids")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """As :func:`read_token_files` with ``ids_crc32``, of the ids as little-endian unsigned
    32-bit integers, in place of the ids."""

    def digest(ids: np.ndarray) -> int:
        return zlib.crc32(ids.astype("<u4").tobytes())

    return _read(spark, path, digest, "ids_crc32 bigint", "ids_crc32")
