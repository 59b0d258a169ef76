import base64
import gzip
import hashlib
import random
import zlib

import pytest

from peakwise.llm import queries, warc
from peakwise.session import shared_path

SF_DIR = "/root/testdata/sf0.01"


def sha1(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def expected(rows):
    first = {}
    for i, _, html in rows:
        if i is not None:
            key = (html or "").encode()
            first[key] = min(i, first.get(key, i))
    result = []
    for i, _, html in rows:
        data = (html or "").encode()
        to = first.get(data)
        again = to is not None and to != i
        result.append((i, len(data), sha1(data), "revisit" if again else "response",
                       to if again else None))
    return sorted(result, key=str)


def read_back(spark, path):
    from pyspark.sql import functions as F

    records = warc.read_archives(spark, path)
    assert records.where("kind = 'gap'").count() == 0
    return records.select(
        warc.page_of(F.col("record_id")), "payload_bytes", "payload_digest", "record_type",
        warc.page_of(F.col("refers_to")), "payload", "target_uri").collect()


def test_query(spark):
    rows = spark.read.parquet(f"{SF_DIR}/pages.parquet").select("page_id", "url", "html").collect()
    df = queries.op8_warc_salvage(spark, SF_DIR)
    assert df.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, df.collect()), key=str) == expected([tuple(r) for r in rows])


def test_nulls_copies_and_texts_that_look_like_records(spark):
    rows = [
        (1, "http://a", "same é"), (2, None, "same é"), (3, "http://c\r\nX: y", None), (4, "d", ""),
        (5, "e", "WARC/1.1\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"), (None, "f", "same é"),
        (None, "g", "alone"), (7, "h", "\r\n\r\n"), (8, "i", "x" * 300_000), (8, "i", "x" * 300_000),
        (9, "j", "\x00\x1f\ufeff"), (-3, "k", "same é"),
    ]
    frame = spark.createDataFrame(
        [(*r, "z") for r in rows], "page_id bigint, url string, html string, key string")
    path = warc.write_archives(frame, shared_path(spark, "warc"), file_bytes=1000)
    got = read_back(spark, path)
    assert sorted((tuple(r)[:5] for r in got), key=str) == expected(rows)
    texts = {(h or "").encode() for _, _, h in rows}
    assert {bytes(r.payload) for r in got if r.payload is not None} == texts
    assert "http://c%0D%0AX: y" in {r.target_uri for r in got}


def test_small_payloads_are_all_responses_and_the_empty_table(spark):
    rows = [(1, "a", "xx"), (2, "b", "xx"), (3, "c", "long text"), (4, "d", "long text")]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    path = warc.write_archives(frame, shared_path(spark, "warc"), min_payload=5)
    kinds = {r[0]: r.record_type for r in read_back(spark, path)}
    assert kinds == {1: "response", 2: "response", 3: "response", 4: "revisit"}
    path = warc.write_archives(frame.limit(0), shared_path(spark, "warc"))
    assert read_back(spark, path) == []


def record(i, body):
    head = (f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{i}>\r\n"
            f"WARC-Payload-Digest: sha1:{sha1(body)}\r\nContent-Type: application/http\r\n"
            f"Content-Length: {len(body) + 19}\r\n\r\nHTTP/1.1 200 OK\r\n\r\n")
    return head.encode() + body + b"\r\n\r\n"


RECORDS = [record(i, f"page {i} WARC/1.1\r\n {i}".encode() * 3) for i in range(6)]


def outline(data):
    found = list(warc.salvage(data))
    assert [f[1] for f in found[1:]] == [f[2] for f in found[:-1]]
    assert not found or (found[0][1] == 0 and found[-1][2] == len(data))
    return [f[3]["record_id"][10:-1] if f[0] == "record" else f"gap {f[2] - f[1]}" for f in found]


def test_sound_archives_have_no_gaps():
    assert outline(b"".join(RECORDS)) == list("012345")
    assert outline(b"".join(gzip.compress(r) for r in RECORDS)) == list("012345")
    assert outline(gzip.compress(RECORDS[0]) + RECORDS[1]) == ["0", "1"]
    assert list(warc.salvage(b"")) == []


def test_later_records_are_recovered_and_gaps_logged():
    r = RECORDS
    damaged = r[3].replace(b"page", b"pagf")
    data = b"".join([r[0], r[1][:60], r[2], damaged, b"junk", r[4], r[5][:-30]])
    assert outline(data) == ["0", "gap 60", "2", f"gap {len(damaged) + 4}", "4",
                             f"gap {len(r[5]) - 30}"]
    for cut in range(1, len(r[1]), 7):
        assert outline(r[0] + r[1][:cut] + r[2]) == ["0", f"gap {cut}", "2"]


def test_damaged_gzip_members():
    z = [gzip.compress(r) for r in RECORDS]
    for at in range(0, len(z[2]), 11):
        broken = bytearray(z[2])
        broken[at] ^= 0x55
        found = outline(z[0] + bytes(broken) + z[3] + z[4][:30] + RECORDS[5])
        # A flipped bit of a member's file name, time or the like does no harm.
        assert found in (["0", f"gap {len(z[2])}", "3", "gap 30", "5"],
                         ["0", "2", "3", "gap 30", "5"])


def test_records_before_the_damage_of_a_member():
    """A member of many records, cut or flipped: whatever lies before the damage is there."""
    records = [record(i, bytes(f"page {i} {hash(str(i))} " * 9, "ascii")) for i in range(100)]
    whole = b"".join(records)
    ends = [len(b"".join(records[: i + 1])) for i in range(100)]
    packed = gzip.compress(whole)
    for at in (len(packed) * 6 // 10, len(packed) // 4, len(packed) - 40):
        sound = zlib.decompressobj(31).decompress(packed[:at])
        n = sum(end <= len(sound) for end in ends)
        flipped = bytearray(packed)
        flipped[at] ^= 0x55
        for damaged in (packed[:at], bytes(flipped)):
            found = list(warc.salvage(damaged + RECORDS[5]))
            ids = [int(f[3]["record_id"][10:-1]) for f in found if f[0] == "record"]
            assert ids[:n] == list(range(n)) and n > 20 and ids[-1] == 5
            assert any(f[0] == "gap" for f in found)
            assert all(f[3]["payload"] in records[i] for f, i in zip(
                [f for f in found if f[0] == "record"], ids[:n]))


def test_members_in_small_pieces(monkeypatch):
    monkeypatch.setattr(warc, "PIECE_BYTES", 7)
    body = b"".join(RECORDS[:3]) + b"junk WARC/1." + RECORDS[3] + RECORDS[4][:-40] + RECORDS[5]
    found = list(warc.salvage(gzip.compress(body)))
    ids = [f[3]["record_id"][10:-1] for f in found if f[0] == "record"]
    assert ids == ["0", "1", "2", "3", "5"]
    assert [f[3].split(":")[0] for f in found if f[0] == "gap"] == [
        f"in a gzip member, bytes {len(body[:a])} to {len(body[:b])}" for a, b in (
            (body.index(b"junk"), body.index(b"junk") + 12),
            (body.index(RECORDS[4][:-40]), body.index(RECORDS[5])))]
    bomb = gzip.compress(record(1, bytes(30_000_000)) + record(2, b"x"))
    monkeypatch.setattr(warc, "PIECE_BYTES", 1 << 20)
    assert [f[3]["payload_bytes"] for f in warc.salvage(bomb)] == [30_000_000, 1]


def test_payloads_are_not_shuffled_and_archives_stay_small(spark):
    rows = [(i, "u", str(i) * 300) for i in range(400)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(2)
    path = warc.write_archives(frame, shared_path(spark, "warc"), file_bytes=30_000)
    sizes = [len(r.content) for r in spark.read.format("binaryFile").load(path).collect()]
    assert len(sizes) > 12 and max(sizes) < 100_000
    assert sorted(r[0] for r in read_back(spark, path)) == list(range(400))


def test_half_of_the_rows_without_an_id(spark):
    """Rows that repeat an id or have none are spread like any others."""
    rows = [(None if i % 2 else 7, "u", "same") for i in range(1000)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(4)
    path = warc.write_archives(frame, shared_path(spark, "warc"), file_bytes=20_000)
    assert spark.read.format("binaryFile").load(path).count() >= 4
    assert sorted((tuple(r)[:5] for r in read_back(spark, path)), key=str) == expected(rows)


def test_a_gap_in_a_table(spark):
    path = shared_path(spark, "warc")
    text = (RECORDS[0] + b"junk" + RECORDS[1]).decode()
    spark.createDataFrame([(text[:-4],)], "value string").coalesce(1).write.option(
        "lineSep", "\r\n\r\n").text(path)
    rows = sorted(map(tuple, warc.read_archives(spark, path).select(
        "start", "end", "kind", "reason").collect()))
    n = len(RECORDS[0])
    assert rows == [(0, n, "record", None), (n, n + 4, "gap", "no version line"),
                    (n + 4, n + 4 + len(RECORDS[1]), "record", None)]


def test_urls_of_any_length(spark):
    rows = [(1, "data:text/html," + "x" * 70_000, "one"), (2, "http://a?q=" + "y" * 600_000, "two"),
            (3, "http://b", "one")]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = read_back(spark, warc.write_archives(frame, shared_path(spark, "warc")))
    assert sorted((tuple(r)[:5] for r in got), key=str) == expected(rows)
    assert {r.target_uri for r in got} == {url for _, url, _ in rows}


def ranges_of(spark, path, size):
    """Rows of all archives below a path, read in splits of so many bytes."""
    settings = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "1",
                "spark.sql.execution.arrow.maxRecordsPerBatch": "2"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = warc.read_archives(spark, str(path))
        return [(r.archive.rsplit("/", 1)[1], r.start, r.end, r.kind, r.reason, r.record_id,
                 r.payload and bytes(r.payload)) for r in df.collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("size", [150, 333, 1000, 1 << 20])
def test_ranges_of_plain_archives_equal_one_reader(spark, tmp_path, size):
    """Damage, records within payloads, ends that are missing, and gzipped archives beside them."""
    rng = random.Random(size)
    for f in range(12):
        parts = []
        for i in range(rng.randrange(12)):
            body = rng.choice([b"x" * rng.randrange(300), RECORDS[1], b"\r\n\r\n".join(RECORDS[:3]),
                               b"WARC/1." * 9, b"\r\n\r\nWARC/1.1\r\nno record"])
            whole = record(100 * f + i, body)
            kind = rng.randrange(8)
            if kind == 0:
                whole = whole[: rng.randrange(len(whole))]
            elif kind == 1:
                at = rng.randrange(len(whole))
                whole = whole[:at] + bytes([whole[at] ^ 5]) + whole[at + 1 :]
            parts += [whole, rng.choice([b"", b"", b"junk", b"\r\n\r\n"])]
        data = b"".join(parts)
        (tmp_path / f"{f}.warc").write_bytes(data[: len(data) - (f % 3) * 2])
    (tmp_path / "z.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in RECORDS))
    (tmp_path / "empty.warc").write_bytes(b"")
    expected = []
    for path in sorted(tmp_path.iterdir()):
        for kind, start, end, item in warc.salvage(path.read_bytes()):
            own = (None, item["record_id"], item["payload"]) if kind == "record" else (item, None, None)
            expected.append((path.name, start, end, kind, *own))
    assert len([e for e in expected if e[3] == "gap"]) > 8
    got = ranges_of(spark, tmp_path, size)
    key = lambda r: (r[0], r[1], r[2], r[3])
    assert [r[:4] + r[5:] for r in sorted(got, key=key)] == [
        r[:4] + r[5:] for r in sorted(expected, key=key)]


def test_large_archives_are_several_tasks(spark, tmp_path):
    from pyspark.sql import functions as F

    (tmp_path / "a.warc").write_bytes(b"".join(record(i, b"y" * 900) for i in range(200)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = warc.read_archives(spark, str(tmp_path), payloads=False)
        assert df.select(F.spark_partition_id()).distinct().count() > 5
        assert df.where("kind = 'record' and payload is null").count() == 200
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
