"""WARC archives of pages, and a reader that salvages damaged ones.

Archives are written by Spark's text sink: the line separator is the four bytes that end a
record, so that a file is its records one after the other, written and committed like any
table.  A payload that occurs more than once is stored once; other pages revisit it.

The reader takes archives plain or gzipped record by record.  A record counts when its version
line, header, length, trailer and digest hold.  Where one of them fails, the reader searches
for the next version line or gzip member that begins a sound record, goes on there, and logs
the bytes in between as a gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from peakwise.session import shared_path
from peakwise.sources.tables import write_table

#: Bytes of an archive, on average; the reader holds an archive in memory.
FILE_BYTES = 8 << 20

#: Bytes of a record beside its payload, about.
HEADER_BYTES = 512

#: Payloads that occur more than once and are broadcast, 100 bytes each; more are joined.
BROADCAST_PAYLOADS = 500_000

# Fixed values of the format.
VERSION = "WARC/1.1"
END = "\r\n\r\n"
DATE = "1970-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
BASE32_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(data: Column) -> Column:
    """SHA-1 of binary data in upper-case base 32: eight groups of 20 bits, 4 digits each."""
    digest = F.sha1(data)
    groups = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32_DIGITS)


def _named(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def write_archives(
    pages: DataFrame,
    path: str,
    min_payload: int = 0,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    file_bytes: int = FILE_BYTES,
) -> str:
    """Write a record per row to archives below ``path``.

    Of the rows with equal payloads of ``min_payload`` bytes or more, that with the smallest id
    is a response and the others are revisits of it; smaller payloads are responses.  A null
    payload is an empty one.  Rows that repeat both id and payload are responses each, and so
    are rows without an id where no equal payload has one.  Line breaks in a url are written
    as ``%0D`` and ``%0A``; a null url has no header.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(
        F.col(page_id).cast("bigint").alias("id"), F.col(url).alias("url"), payload.alias("payload")
    ).withColumns(
        {
            "bytes": F.octet_length("payload"),
            "key": F.unhex(F.sha2(F.col("payload").cast("binary"), 256)),
            "digest": base32_sha1(F.col("payload").cast("binary")),
        }
    )
    groups = rows.groupBy("key").agg(
        F.min("id").alias("first"), F.count(F.lit(1)).alias("n"), F.max("bytes").alias("bytes")
    )
    groups = write_table(groups, shared_path(spark, "payloads"))
    n_rows, total = groups.agg(
        F.sum("n"), F.sum(F.col("n") * (F.col("bytes").cast("bigint") + HEADER_BYTES))
    ).first()
    shared = groups.where((F.col("bytes") >= min_payload) & (F.col("n") > 1))
    shared = shared.where("first is not null").select("key", "first")
    if shared.count() <= BROADCAST_PAYLOADS:
        shared = F.broadcast(shared)
    rows = rows.join(shared, "key", "left")
    again = F.coalesce(
        (F.col("bytes") >= min_payload) & ~F.col("id").eqNullSafe(F.col("first"))
        & F.col("first").isNotNull(), F.lit(False)
    )
    head = F.concat(F.lit(HTTP_HEAD), F.col("bytes").cast("string"), F.lit(END))
    rows = rows.withColumn("again", again).select(
        "id",
        "url",
        "bytes",
        "digest",
        F.when(F.col("again"), F.col("first")).alias("first"),
        "again",
        F.when(F.col("again"), head).otherwise(F.concat(head, "payload")).alias("block"),
    )
    safe_url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    record = F.concat(
        F.lit(f"{VERSION}\r\n"),
        line("WARC-Type", F.when(F.col("again"), "revisit").otherwise("response")),
        line("WARC-Record-ID", _named(F.col("id"))),
        line("WARC-Date", F.lit(DATE)),
        F.coalesce(line("WARC-Target-URI", safe_url), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        line("WARC-Payload-Length", F.col("bytes").cast("string")),
        F.when(
            F.col("again"),
            F.concat(
                line("WARC-Profile", F.lit(REVISIT_PROFILE)),
                line("WARC-Refers-To", _named(F.col("first"))),
            ),
        ).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length("block").cast("string")),
        F.lit("\r\n"),
        "block",
    )
    # Tasks write what they read, so no payload is shuffled; a full archive is followed by the
    # next one of the same task.
    most = max(1, file_bytes * (n_rows or 0) // max(1, total or 0))
    (
        rows.select(record.alias("value"))
        .write.option("lineSep", END)
        .option("maxRecordsPerFile", most)
        .text(path)
    )
    return path


class Damaged(ValueError):
    """Bytes that are not a sound record or member, and the records that can be saved."""

    def __init__(self, reason: str, records: list[dict] = ()):
        super().__init__(reason)
        self.records = records


class Short(Damaged):
    """Bytes that may begin a sound record, which goes on beyond them, up to ``end`` if known."""

    end = None


_CANDIDATE = re.compile(rb"WARC/1\.[01]\r\n|\x1f\x8b\x08")

#: Bytes that a member is unpacked by.
PIECE_BYTES = 1 << 20


def _record(data: bytes, at: int) -> tuple[dict, int]:
    """The record that begins at a place, and where it ends."""
    if not re.compile(rb"WARC/1\.[01]\r\n").match(data, at):
        begun = data[at : at + 10]
        if len(begun) < 10 and (b"WARC/1.0\r\n".startswith(begun) or b"WARC/1.1\r\n".startswith(begun)):
            raise Short("no version line")
        raise Damaged("no version line")
    headers: dict[str, str] = {}
    start = data.find(b"\r\n", at) + 2
    # Line by line, whatever their length: another record's version line has no colon.
    while True:
        line_end = data.find(b"\r\n", start)
        if line_end < 0:
            raise Short("header does not end")
        line, start = data[start:line_end], line_end + 2
        if not line:
            break
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header line without a colon")
        key = name.strip().lower().decode("latin-1")
        if key in headers and key != "warc-concurrent-to":
            raise Damaged("two records in one header")
        headers[key] = value.strip().decode("utf-8", "replace")
    length = headers.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        raise Damaged("no content length")
    end = start + int(length)
    if end + 4 > len(data):
        short = Short("cut off")
        short.end = end + 4
        raise short
    if data[end : end + 4] != b"\r\n\r\n":
        raise Damaged("content ends elsewhere")
    block = bytes(data[start:end])
    kind = headers.get("warc-type", "")
    payload = block
    if headers.get("content-type", "").startswith("application/http"):
        _, mark, payload = block.partition(b"\r\n\r\n")
        if not mark:
            raise Damaged("no HTTP header")
    algorithm, _, told = headers.get("warc-payload-digest", "").partition(":")
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    size = len(payload)
    if kind == "revisit":
        digest = told or None
        told_size = headers.get("warc-payload-length", "")
        size = int(told_size) if told_size.isascii() and told_size.isdigit() else None
        payload = None
    elif told and algorithm.lower() == "sha1" and told.upper() != digest:
        raise Damaged("payload differs from its digest")
    record = {
        "record_type": kind,
        "record_id": headers.get("warc-record-id"),
        "target_uri": headers.get("warc-target-uri"),
        "payload_digest": digest,
        "payload_bytes": size,
        "refers_to": headers.get("warc-refers-to"),
        "payload": payload,
        "checked": bool(told),
    }
    return record, end + 4


def _header_end(data: bytes, at: int) -> int:
    """Where the header of the gzip member at a place ends."""
    if data[at : at + 3] != b"\x1f\x8b\x08" or at + 10 > len(data):
        raise Damaged("gzip: no header")
    flags, end = data[at + 3], at + 10
    if flags & 0xE0:
        raise Damaged("gzip: unknown flags")
    if flags & 4:
        end += 2 + int.from_bytes(data[end : end + 2], "little")
    for flag in (8, 16):
        if flags & flag:
            end = data.find(b"\0", end) + 1
            if not end:
                raise Damaged("gzip: header does not end")
    return end + (2 if flags & 2 else 0)


class _Member:
    """Content of the gzip member at a place, in pieces of up to ``PIECE_BYTES``.

    After the last piece ``end`` is where the member, or what could be read of it, ends, and
    ``fault`` says what is wrong with it.
    """

    def __init__(self, data: bytes, at: int):
        self.data, self.end, self.fault = data, _header_end(data, at), None

    def _unpacked(self, unpack, piece: bytes) -> Iterator[bytes]:
        while piece and not unpack.eof:
            yield unpack.decompress(piece, PIECE_BYTES)
            piece = unpack.unconsumed_tail

    def __iter__(self) -> Iterator[bytes]:
        unpack, size, crc = zlib.decompressobj(-15), 0, 0
        step = 1 << 16
        while not unpack.eof:
            piece = bytes(self.data[self.end : self.end + step])
            if not piece:
                self.fault = "gzip member cut off"
                return
            # A piece that fails is read again byte by byte, up to the fault.
            before, held = unpack.copy(), []
            try:
                for part in self._unpacked(unpack, piece):
                    held.append(part)
                    if len(held) > 1:  # beyond one part, what is unpacked is handed on
                        before = None
                        crc, size = zlib.crc32(held[0], crc), size + len(held[0])
                        yield held.pop(0)
            except zlib.error as error:
                if before is None or step == 1:
                    self.fault = f"gzip: {error}"
                    return
                unpack, step = before, 1
                continue
            self.end += len(piece) - len(unpack.unused_data)
            for part in held:
                crc, size = zlib.crc32(part, crc), size + len(part)
                yield part
        trailer = self.data[self.end : self.end + 8]
        self.end += len(trailer)
        if len(trailer) < 8:
            self.fault = "gzip member cut off"
        elif trailer != crc.to_bytes(4, "little") + (size & 0xFFFFFFFF).to_bytes(4, "little"):
            self.fault = "gzip: checksum differs"


def _plain(data: bytes, at: int) -> tuple[list[tuple[dict, int, int]], int, list]:
    record, end = _record(data, at)
    return [(record, at, end)], end, []


def _in_pieces(pieces: Iterator[bytes], goes_on: bool = False) -> Iterator[tuple]:
    """What :func:`salvage` gives for a content that comes in pieces; held at a time are a piece
    and the record that it belongs to.  If the content ``goes_on`` elsewhere, there is also
    ``("open", start, end, None)`` for what would be a sound record with the bytes up to there."""
    data, low, gap, reason = bytearray(), 0, None, ""
    pieces = iter(pieces)
    more = True
    while True:
        try:
            record, end = _record(data, 0)
        except Short as error:
            fault, end = str(error), None
            if more:
                piece = next(pieces, None)
                more = piece is not None
                data += piece or b""
                continue
            if not data:
                break
            if goes_on and error.end:
                yield "open", low, low + error.end, None
        except Damaged as error:
            fault, end = str(error), None
        if end is None:
            if gap is None:
                gap, reason = low, fault
            found = re.compile(rb"WARC/1\.").search(data, 1)
            # The last bytes may begin a version line.
            skip = found.start() if found else max(1, len(data) - 6) if more else len(data)
            low += skip
            del data[:skip]
            continue
        if gap is not None:
            yield "gap", gap, low, reason
            gap = None
        yield "record", low, low + end, record
        low += end
        del data[:end]
    if gap is not None:
        yield "gap", gap, low, reason


def _sound(data: bytes, at: int) -> tuple[list[tuple[dict, int, int]], int, list]:
    """Records of the record or member at a place, where it ends, and gaps within a member."""
    if data[at : at + 2] != b"\x1f\x8b":
        return _plain(data, at)
    member = _Member(data, at)
    found = list(_in_pieces(member))
    end = member.end
    records = [x[3] for x in found if x[0] == "record"]
    if member.fault:
        raise Damaged(member.fault, _before_damage(found))
    if not records:
        raise Damaged("gzip member without a record")
    gaps = [
        (at, end, f"in a gzip member, bytes {low} to {high}: {reason}")
        for kind, low, high, reason in found
        if kind == "gap"
    ]
    return [(r, at, end) for r in records], end, gaps


def _before_damage(found: list[tuple]) -> list[dict]:
    """Records of a damaged member that surely lie before its damage: their digest holds, and
    bytes that begin another record follow."""
    records, upto = [], 0
    for at, (kind, _, _, item) in enumerate(found):
        if kind == "gap":
            break
        records.append(item)
        follows = found[at + 1] if at + 1 < len(found) else None
        if follows and (follows[0] == "record" or follows[3] != "no version line"):
            upto = len(records)
    return [r for r in records[:upto] if r["checked"]]


def salvage(data: bytes) -> Iterator[tuple]:
    """``("record", start, end, record)`` and ``("gap", start, end, reason)`` in file order.

    Records of a gzip member have the bytes of the member.  A gap over the bytes of a damaged one
    follows the records that were saved of it.
    """
    at = 0
    while at < len(data):
        try:
            records, end, gaps = _sound(data, at)
        except Damaged as error:
            low, at = at, len(data)
            for found in _CANDIDATE.finditer(data, low + 1):
                try:
                    _sound(data, found.start())
                except Damaged as other:
                    if not other.records:
                        continue
                at = found.start()
                break
            for record in error.records:
                yield "record", low, at, record
            yield "gap", low, at, str(error)
            continue
        for low, high, reason in gaps:
            yield "gap", low, high, reason
        for record, low, high in records:
            yield "record", low, high, record
        at = end


_FIELDS = (
    "record_type string, record_id string, target_uri string, payload_digest string, "
    "payload_bytes bigint, refers_to string, payload binary"
)
SCHEMA = f"archive string, kind string, start bigint, end bigint, reason string, {_FIELDS}"

#: What Spark splits plain archives by: the end of a record and the begin of the next.
_END, _BEGIN = b"\r\n\r\n", b"WARC/1."

#: File splits whose places are broadcast, 200 bytes each; more are joined.
BROADCAST_SPLITS = 500_000

#: Plain archives that are read whole because their ranges do not add up.
MOST_WHOLE = 1000

#: Files that are not gzipped, as a path pattern.
_PLAIN_FILES = "{*[^z],*[^g]z,*[^.]gz,z,gz}"


def _batches(rows: Iterator[tuple], schema: str) -> Iterator:
    """Arrow batches of rows of about 4 MB."""
    import pyarrow as pa

    kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
    names, types = zip(*(field.split() for field in schema.split(", ")))

    def batch(held: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(column, kinds[t]) for column, t in zip(zip(*held), types)]
        return pa.RecordBatch.from_arrays(columns, names=names)

    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 200 + sum(len(v) for v in row if isinstance(v, bytes))
        if size > 4 << 20:
            yield batch(held)
            held, size = [], 0
    if held:
        yield batch(held)


def _values(record: dict | None, payloads: bool) -> tuple:
    """Fields of a record, all null without one."""
    names = [field.split()[0] for field in _FIELDS.split(", ")]
    values = [record[n] if record else None for n in names]
    return tuple(values if payloads else [*values[:-1], None])


def _read_ranges(payloads: bool):
    """Task over ``(archive, size, split, length, final, value)``, the stretches between separators of
    plain archives in their order: rows of :data:`SCHEMA` with ``split``, positions counted from
    the split's first stretch, and a row of kind ``split`` whose end is the number of the split's
    bytes.

    A split that is not the file's last is read as if a record's end followed it, unless it is
    marked as ``final``: the file's last stretch may begin in a split before the last.
    """
    schema = SCHEMA + ", split bigint, size bigint"

    def read(batches: Iterator) -> Iterator:
        from itertools import groupby

        stretches = (
            (tuple(c[i].as_py() for c in batch.columns[:5]), batch.column(5)[i])
            for batch in batches
            for i in range(batch.num_rows)
        )

        def rows():
            for (archive, size, split, length, final), own in groupby(stretches, lambda x: x[0]):
                goes_on, total = split + length < size and not final, 0

                def pieces(own=own, split=split, goes_on=goes_on):
                    nonlocal total
                    opening = _BEGIN if split else b""
                    for _, value in own:
                        piece = opening + value.as_py()
                        total += len(piece)
                        yield piece
                        opening = _END + _BEGIN
                    if goes_on:
                        total += len(_END)
                        yield _END

                for kind, start, end, item in _in_pieces(pieces(), goes_on):
                    record = item if kind == "record" else None
                    reason = item if kind == "gap" else None
                    values = _values(record, payloads)
                    yield archive, kind, start, end, reason, *values, split, size
                told = "goes on" if goes_on else None
                yield archive, "split", 0, total, told, *_values(None, False), split, size

        return _batches(rows(), schema)

    return read, schema


def _placed_splits(facts: DataFrame) -> DataFrame:
    """``(archive, split, _base, _bytes, _size, _over)``: where each split's first stretch begins,
    and whether a record's end was read that does not follow the file's last stretch."""
    along = Window.partitionBy("archive").orderBy("split")
    before = F.sum("end").over(along.rowsBetween(Window.unboundedPreceding, -1))
    over = F.lead("split").over(along).isNull() & F.col("reason").isNotNull()
    return facts.where("kind = 'split'").select(
        "archive", "split", F.coalesce(before, F.lit(0)).alias("_base"), F.col("end").alias("_bytes"),
        F.col("size").alias("_size"), over.alias("_over"),
    )


def _gaps(facts: DataFrame, splits: DataFrame, crossing: DataFrame | None) -> DataFrame:
    """``(archive, start, end, reason)`` of what the splits could not read and no crossing record
    covers, joined where one ends and the next begins."""
    gaps = facts.where("kind = 'gap'").join(splits, ["archive", "split"]).select(
        "archive", (F.col("_base") + F.col("start")).alias("start"),
        (F.col("_base") + F.col("end")).alias("end"), "reason",
    )
    zero, none = F.lit(0), F.lit(None).cast("string")
    events = gaps.select("archive", F.col("start").alias("at"), F.lit(1).alias("g"), zero.alias("r"), "reason")
    ends = gaps.select("archive", F.col("end").alias("at"), F.lit(-1).alias("g"), zero.alias("r"), none.alias("reason"))
    events = events.unionByName(ends)
    if crossing is not None:
        for side, step in (("start", 1), ("end", -1)):
            events = events.unionByName(crossing.select(
                "archive", F.col(side).alias("at"), zero.alias("g"), F.lit(step).alias("r"),
                none.alias("reason"),
            ))
    events = events.groupBy("archive", "at").agg(
        F.sum("g").alias("g"), F.sum("r").alias("r"), F.max("reason").alias("reason")
    )
    along = Window.partitionBy("archive").orderBy("at")
    parts = events.select(
        "archive", F.col("at").alias("start"), F.lead("at").over(along).alias("end"),
        F.sum("g").over(along).alias("g"), F.sum("r").over(along).alias("r"),
        F.last("reason", ignorenulls=True).over(along).alias("reason"),
    ).where("g > 0 and r = 0")
    by_start = Window.partitionBy("archive").orderBy("start")
    apart = (F.col("start") != F.lag("end", 1, -1).over(by_start)).cast("int")
    parts = parts.withColumn("_new", apart).withColumn("_gap", F.sum("_new").over(by_start))
    return parts.groupBy("archive", "_gap").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("reason", "start").alias("reason")
    ).drop("_gap")


def _crossing(stretches: DataFrame, facts: DataFrame, splits: DataFrame, payloads: bool) -> DataFrame:
    """Sound records that a payload with a record in it carries over a split's end.

    The splits that such a record would touch are read again, and their bytes within it put
    together, a record a group.
    """
    import pyarrow as pa

    opened = facts.where("kind = 'open'").join(splits, ["archive", "split"]).select(
        "archive", (F.col("_base") + F.col("start")).alias("start"),
        (F.col("_base") + F.col("end")).alias("end"),
    )
    sizes = splits.groupBy("archive").agg(F.max("_size").alias("_size"))
    opened = opened.join(sizes, "archive").where("end <= _size").drop("_size")
    touched = splits.join(opened, "archive").where("_base < end and _base + _bytes > start")
    touched = write_table(
        touched.select("archive", "split", "_base", "start", "end"),
        shared_path(facts.sparkSession, "crossing"),
    )

    def cut(batches: Iterator) -> Iterator:
        from itertools import groupby

        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))

        def stretches():
            for (archive, size, split, length, final), own in groupby(rows, lambda r: r[:5]):
                at, opening = 0, _BEGIN if split else b""
                for *_, value in own:
                    yield archive, split, at, opening + value
                    at += len(opening + value)
                    opening = _END + _BEGIN
                if split + length < size and not final:
                    yield archive, split, at, _END

        return _batches(stretches(), "archive string, split bigint, at bigint, bytes binary")

    def whole(key, rows):
        archive, start, end = (k.as_py() for k in key)
        parts = sorted(zip(rows["at"].to_pylist(), rows["bytes"].to_pylist()))
        data = b"".join(part for _, part in parts)[start - parts[0][0] :][: end - start]
        found = []
        try:
            record, upto = _record(data, 0)
            if upto == end - start:
                found = [(archive, "record", start, end, None, *_values(record, payloads))]
        except Damaged:
            pass
        return pa.Table.from_batches(list(_batches(iter(found), SCHEMA)) or [], schema=schema)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = to_arrow_schema(_parse_datatype_string(SCHEMA))
    wanted = touched.select("archive", "split").distinct()
    again = stretches.join(F.broadcast(wanted), ["archive", "split"], "left_semi").select(
        "archive", "size", "split", "length", "final", "value"
    )
    parts = again.mapInArrow(cut, "archive string, split bigint, at bigint, bytes binary")
    parts = parts.join(F.broadcast(touched), ["archive", "split"]).withColumn(
        "at", F.col("at") + F.col("_base")
    )
    parts = parts.where("at < end and at + octet_length(bytes) > start")
    return parts.select("archive", "start", "end", "at", "bytes").groupBy(
        "archive", "start", "end"
    ).applyInArrow(whole, SCHEMA)


def _read_plain(spark: SparkSession, path: str, payloads: bool) -> DataFrame:
    """Rows of the plain archives; two passes over them, the first for the places of splits."""
    separator = (_END + _BEGIN).decode()
    text = spark.read.option("pathGlobFilter", _PLAIN_FILES).text(path, lineSep=separator)
    stretches = text.select(
        F.col("_metadata.file_path").alias("archive"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("split"),
        F.col("_metadata.file_block_length").alias("length"),
        F.col("value").cast("binary").alias("value"),
    )
    columns = ["archive", "size", "split", "length", "final", "value"]

    def facts_of(some: DataFrame, label: str) -> DataFrame:
        found = some.select(*columns).mapInArrow(*_read_ranges(False)).where("kind <> 'record'")
        found = found.select("archive", "split", "kind", "start", "end", "reason", "size")
        return write_table(found, shared_path(spark, label))

    facts = facts_of(stretches.withColumn("final", F.lit(False)), "archive-splits")
    splits = write_table(_placed_splits(facts), shared_path(spark, "archive-places"))
    ends = splits.where("_over").select("archive", "split", F.lit(True).alias("_end"))
    if ends.count() > BROADCAST_SPLITS:
        raise ValueError(f"over {BROADCAST_SPLITS} archives at a time")
    # A broadcast leaves the stretches in their order.
    stretches = stretches.join(F.broadcast(ends), ["archive", "split"], "left")
    stretches = stretches.withColumn("final", F.coalesce("_end", F.lit(False)))
    if ends.limit(1).count():
        again = facts_of(stretches.where("final"), "final-splits")
        facts = facts.join(ends, ["archive", "split"], "left_anti").unionByName(again)
        splits = write_table(_placed_splits(facts), shared_path(spark, "archive-places"))
    # Spark's splits could lose stretches where one ends within line breaks that look like the
    # begin of a separator.  The bytes would tell; such an archive is read whole.
    files = splits.groupBy("archive").agg(
        F.max(F.col("_base") + F.col("_bytes")).alias("_read"), F.max("_size").alias("_size")
    )
    lossy = [r.archive for r in files.where("_read <> _size").limit(MOST_WHOLE + 1).collect()]
    if len(lossy) > MOST_WHOLE:
        raise ValueError(f"over {MOST_WHOLE} archives cannot be split; gzip them")
    whole = None
    if lossy:
        whole = _read_whole(spark.read.format("binaryFile").load(lossy), payloads)
        splits = splits.where(~F.col("archive").isin(lossy))
        facts = facts.where(~F.col("archive").isin(lossy))
    if splits.count() <= BROADCAST_SPLITS:
        splits = F.broadcast(splits)
    rows = stretches.select(*columns).mapInArrow(*_read_ranges(payloads)).where("kind = 'record'")
    columns = [field.split()[0] for field in SCHEMA.split(", ")]
    rows = rows.join(splits, ["archive", "split"])
    rows = rows.withColumns({c: F.col("_base") + F.col(c) for c in ("start", "end")}).select(*columns)
    crossing = None
    if facts.where("kind = 'open'").limit(1).count():
        found = _crossing(stretches, facts, splits, payloads)
        crossing = write_table(found, shared_path(spark, "crossing-records"))
        taken = crossing.select(
            F.col("archive").alias("_in"), F.col("start").alias("_from"), F.col("end").alias("_upto")
        )
        inside = (F.col("archive") == F.col("_in")) & (F.col("start") < F.col("_upto"))
        deeper = inside & (F.col("start") > F.col("_from"))
        crossing = crossing.join(F.broadcast(taken), deeper, "left_anti")
        rows = rows.join(
            F.broadcast(taken), inside & (F.col("start") >= F.col("_from")), "left_anti"
        ).unionByName(crossing)
    gaps = _gaps(facts, splits, crossing)
    empty = {c: F.lit(None).cast(rows.schema[c].dataType) for c in columns[5:]}
    gaps = gaps.withColumns({"kind": F.lit("gap"), **empty}).select(*columns)
    rows = rows.unionByName(gaps)
    return rows.unionByName(whole) if whole else rows


def _read_whole(files: DataFrame, payloads: bool) -> DataFrame:
    """Rows of archives that are a value each."""
    def parse(batches: Iterator) -> Iterator:
        contents = (
            (batch.column(0)[i].as_py(), batch.column(1)[i].as_py() or b"")
            for batch in batches
            for i in range(batch.num_rows)
        )

        def rows():
            for archive, data in contents:
                for kind, start, end, item in salvage(data):
                    record = item if kind == "record" else None
                    reason = item if kind == "gap" else None
                    yield archive, kind, start, end, reason, *_values(record, payloads)

        return _batches(rows(), SCHEMA)

    return files.select("path", "content").mapInArrow(parse, SCHEMA)


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """A row per record (``kind`` record) and per unreadable stretch (``kind`` gap) of all
    archives below ``path``, with the bytes they take up; within a gzipped archive those are
    the bytes of the member.

    Digests are bare upper-case base 32; a revisit has those of what it revisits.  With
    ``payloads`` off payloads are read and checked but not returned.  Empty files have no rows.

    Plain archives of any size are read in ranges, a record at a time; a payload that holds
    another record is one record, also over the end of a range.  Files called ``.gz`` are read
    whole, so they must be below 2 GB, and so are the few whose ranges do not add up.
    """
    packed = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return _read_plain(spark, path, payloads).unionByName(_read_whole(packed, payloads))


def page_of(record_id: Column) -> Column:
    """Page id of a record id of :func:`write_archives`, null for others."""
    return F.nullif(F.regexp_extract(record_id, r"^<urn:page:(-?\d+)>$", 1), F.lit("")).cast("bigint")
