"""URL rules looked up in a sorted, memory-mapped array of 64-bit digests.

A rule is a host and a path prefix.  For a url every combination of a host suffix and a path
prefix of a length that occurs in the list is hashed, and all digests of a batch are looked up
by one vectorised binary search.  A hit counts only when the stored rule's full text equals the
probe, so digests may collide.

The list is one sorted file that Spark ships to every executor and each Python worker maps
into memory; its size is checked against a documented bound.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peakwise.llm.worker import carried, kept
from peakwise.session import shared_path

#: Bytes of a rule file; longer lists are refused.
MAX_BYTES = 1 << 30

#: Digests of probes looked up at a time.
PROBES = 1_000_000


def host_and_path(url: str | None) -> tuple[str, str]:
    """Host with A-Z lower-cased and path; both empty for null or without ``://``."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = len(rest)
    for c in "?#":
        at = rest.find(c, 0, end)
        end = at if at >= 0 else end
    slash = rest.find("/", 0, end)
    slash = end if slash < 0 else slash
    return _lower(rest[:slash]), rest[slash:end]


def _lower(text: str) -> str:
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def digest(text: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(text)


class RuleFile:
    """A written list: header, sorted digests, offsets, verdicts, then the rules' texts."""

    MAGIC = b"URLRULE1"

    @staticmethod
    def pack(rules: Iterable[tuple[str, str, str]], hash_of=digest) -> bytes:
        """The file of ``(verdict, host, path)`` rules; one both blocked and allowed blocks."""
        texts: dict[bytes, int] = {}
        lengths = {0}
        for verdict, host, prefix in rules:
            if verdict not in ("block", "allow") or not host or "/" in host:
                raise ValueError(f"not a rule: {verdict} {host}{prefix}")
            key = (_lower(host) + "\n" + prefix).encode()
            texts[key] = max(texts.get(key, 0), int(verdict == "block"))
            lengths.add(len(prefix))
        keys = sorted(texts, key=lambda k: (hash_of(k), k))
        body = b"".join(keys)
        lengths = np.array(sorted(lengths), dtype="<i8")
        digests = np.array([hash_of(k) for k in keys], dtype="<u8")
        offsets = np.cumsum([0, *map(len, keys)]).astype("<i8")
        verdicts = np.array([texts[k] for k in keys], dtype="u1")
        head = np.array([len(keys), len(lengths)], dtype="<i8")
        parts = (head, lengths, digests, offsets, verdicts)
        packed = b"".join([RuleFile.MAGIC, *(part.tobytes() for part in parts), body])
        if len(packed) > MAX_BYTES:
            raise ValueError(f"{len(packed)} bytes of rules, more than {MAX_BYTES}")
        return packed

    def __init__(self, path: str, hash_of=digest):
        raw = np.memmap(path, dtype=np.uint8, mode="r")
        if raw[:8].tobytes() != self.MAGIC:
            raise ValueError(f"not a rule file: {path}")
        n, n_lengths = raw[8:24].view("<i8").tolist()
        at = 24
        parts = []
        for count in (n_lengths, n, n + 1):
            parts.append(raw[at : at + 8 * count].view("<u8" if len(parts) == 1 else "<i8"))
            at += 8 * count
        self.lengths, self.digests, self.offsets = parts
        self.verdicts, self.body = raw[at : at + n], raw[at + n :]
        self.hash_of = hash_of

    def find(self, probes: list[bytes]) -> np.ndarray:
        """Position of each probe's rule, or -1."""
        found = np.full(len(probes), -1, dtype=np.int64)
        if not len(self.digests):
            return found
        keys = np.fromiter(map(self.hash_of, probes), dtype="<u8", count=len(probes))
        low = np.searchsorted(self.digests, keys, "left")
        high = np.searchsorted(self.digests, keys, "right")
        for i in np.flatnonzero(high > low):
            for at in range(low[i], high[i]):
                if self.body[self.offsets[at] : self.offsets[at + 1]].tobytes() == probes[i]:
                    found[i] = at
        return found

    def judge(self, urls: list[tuple[str, str]]) -> list[tuple[str | None, str | None]]:
        """Rule and its verdict for each host and path, nulls where no rule fits."""
        results: list[tuple[str | None, str | None]] = [(None, None)] * len(urls)
        lengths = self.lengths.tolist()
        start = 0
        while start < len(urls):
            probes: list[bytes] = []
            owners: list[int] = []
            stop = start
            while stop < len(urls) and len(probes) < PROBES:
                host, path = urls[stop]
                labels = host.split(".") if host else []
                suffixes = [".".join(labels[i:]) for i in range(len(labels))]
                prefixes = [path[:n] for n in lengths if n <= len(path)]
                new = [f"{s}\n{p}".encode("utf-8", "surrogatepass")
                       for s in suffixes if s for p in prefixes]
                probes += new
                owners += [stop] * len(new)
                stop += 1
            found = self.find(probes)
            best: dict[int, tuple[int, int, int]] = {}
            for i in np.flatnonzero(found >= 0):
                host, _, prefix = probes[i].decode("utf-8", "surrogatepass").partition("\n")
                rank = (len(host) + len(prefix), len(host), int(i))
                best[owners[i]] = max(best.get(owners[i], (-1, -1, -1)), rank)
            for owner, (_, _, i) in best.items():
                rule = probes[i].decode("utf-8", "surrogatepass").replace("\n", "", 1)
                results[owner] = (rule, "block" if self.verdicts[found[i]] else "allow")
            start = stop
        return results


def filter_urls(
    pages: DataFrame,
    rules: Iterable[tuple[str, str, str]],
    otherwise: str = "allow",
    url: str = "url",
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` are ``(verdict, host, path)``.  A rule fits its host and all subdomains where the
    url's path starts with the rule's.  The longest rule that fits wins, among equally long
    ones that with the longer host; a rule listed with both verdicts blocks.  Urls that no
    rule fits get a null rule and ``otherwise``; so do null and empty urls and those without
    ``://``.  Columns named like a result are replaced.
    """
    import pyarrow as pa

    spark = pages.sparkSession
    name = _ship(spark, rules)
    made = ["host", "path", "rule", "verdict"]
    others, unpacked = carried(pages, *made)
    rows = pages.select(F.col(f"`{url}`").alias("__url"), *others)
    schema = rows.drop("__url").schema
    for column in made:
        schema = schema.add(column, "string")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import SparkFiles

        listed = kept("url_rules", name, lambda: RuleFile(SparkFiles.get(name)))
        for batch in batches:
            split = [host_and_path(u) for u in batch.column(0).to_pylist()]
            verdicts = listed.judge(split)
            columns = [
                pa.array([h for h, _ in split], pa.string()),
                pa.array([p for _, p in split], pa.string()),
                pa.array([r for r, _ in verdicts], pa.string()),
                pa.array([v or otherwise for _, v in verdicts], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], *columns], names=[*batch.schema.names[1:], *made]
            )

    return rows.mapInArrow(judge, schema).select(*unpacked, *made)


def _ship(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> str:
    """Put the list into the shared folder and have Spark copy it to every executor."""
    path = shared_path(spark, "url-rules")
    write_bytes(spark, path, RuleFile.pack(rules))
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[1]


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """Write a file of any file system Spark knows."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(conf).create(target, False)
    try:
        for start in range(0, len(data), 1 << 20):
            out.write(bytearray(data[start : start + (1 << 20)]))
    finally:
        out.close()
