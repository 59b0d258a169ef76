"""Near-duplicate documents by SimHash, linked through covering-code anchors.

A fingerprint is 64 bits.  Two fingerprints at most ``d`` bits apart are at most ``d // 2``
apart in their lower half or at most ``d - d // 2 - 1`` in their upper half.  Each half is 23
bits in the binary Golay code, a perfect covering code of radius 3, and 9 plain bits.  A
fingerprint lives at its nearest anchor of each half and is replicated to every anchor within
the covering radius plus the half's threshold, so that it meets there all fingerprints that
may link with it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peakwise.llm.components import connected_components
from peakwise.llm.worker import carried, merged, numbered, ranges, slices
from peakwise.session import shared_path
from peakwise.sources.tables import write_table

SHINGLE_WORDS = 4
MAX_DISTANCE = 4

# The binary Golay code.
GOLAY_BITS = 23
GOLAY_GENERATOR = 0xAE3
GOLAY_RADIUS = 3

#: Bytes of texts that a task works on at a time.
SLICE_BYTES = 8 << 20

#: Homes of an anchor that one task compares its replicas with; an anchor with more is
#: compared by several tasks, each with a share of the replicas.
TILE_HOMES = 2048

#: Crowded anchors that are broadcast, 16 bytes each; more of them are joined.
BROADCAST_ANCHORS = 1_000_000

#: Pairs compared at a time: 8 MB for each array of them.
PAIRS = 1_000_000


def text_fingerprint(text: bytes | None, width: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of UTF-8 text; 0 for null or without words.

    A-Z are lower-cased and words end at ASCII white space.  A bit is set when it is set in
    more than half the XXH64 digests (seed 42) of the shingles, repeats included.
    """
    import xxhash

    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) <= width:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    last = ends[width - 1 :].tolist()
    first = [0, *(ends[: len(last) - 1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(last), 65_536):
        spans = zip(first[start : start + 65_536], last[start : start + 65_536])
        hashes = np.array([digest(joined[i:j], 42) for i, j in spans], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(last)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = SHINGLE_WORDS, text: str = "text") -> DataFrame:
    """``docs`` without its text but with ``fp BIGINT``, the fingerprint's bits."""
    import pyarrow as pa

    packed, unpacked = carried(docs, text, "fp")

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 0, SLICE_BYTES)):
            texts = batch.column(0).to_pylist()
            values = np.fromiter((text_fingerprint(t, width) for t in texts), "<u8", len(texts))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(values.view("<i8"))],
                names=[*batch.schema.names[1:], "fp"],
            )

    rows = docs.select(F.col(f"`{text}`").cast("binary").alias("__text"), *packed)
    schema = rows.drop("__text").schema.add("fp", T.LongType())
    return rows.mapInArrow(compute, schema).select(*unpacked, "fp")


def _syndromes() -> np.ndarray:
    """Remainder of every 23-bit word modulo the generator, one bit at a time."""
    single = []
    for i in range(GOLAY_BITS):
        value = 1 << i
        for shift in range(i - 11, -1, -1):
            if value >> (shift + 11) & 1:
                value ^= GOLAY_GENERATOR << shift
        single.append(value)
    table = np.zeros(1, dtype=np.int64)
    for value in single:
        table = np.concatenate([table, table ^ value])
    return table


def _reach(threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each syndrome the changes to a half that lead to an anchor in reach.

    Returns offsets per syndrome, changes, and whether a change leads to the home anchor.
    """
    table = _syndromes()
    changes, owners, home = [], [], []
    plain = 32 - GOLAY_BITS
    for flips in range(threshold + 1):
        free = [
            sum(1 << (GOLAY_BITS + i) for i in chosen)
            for chosen in combinations(range(plain), flips)
        ]
        for errors in range(GOLAY_RADIUS + threshold - flips + 1):
            words = np.array(
                [sum(1 << i for i in c) for c in combinations(range(GOLAY_BITS), errors)],
                dtype=np.int64,
            )
            for extra in free:
                changes.append(words | extra)
                owners.append(table[words])
                home.append(np.full(len(words), flips == 0 and errors <= GOLAY_RADIUS))
    changes, owners, home = map(np.concatenate, (changes, owners, home))
    order = np.argsort(owners, kind="stable")
    offsets = np.searchsorted(owners[order], np.arange((1 << 11) + 1))
    return offsets, changes[order], home[order]


def anchors(fps: np.ndarray, max_distance: int, homes_only: bool = False):
    """``(row, anchor, home)`` of every replica of the given fingerprints (as int64)."""
    table = _syndromes()
    words = fps.view(np.uint64)
    found = []
    lower = max_distance // 2
    for half, threshold in ((0, lower), (1, max_distance - lower - 1)):
        if threshold < 0:
            continue
        offsets, changes, home = _reach(0 if homes_only else threshold)
        bits = ((words >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        syndrome = table[bits & ((1 << GOLAY_BITS) - 1)]
        row, place = ranges(offsets[syndrome + 1] - offsets[syndrome])
        pick = offsets[syndrome][row] + place
        anchor = (bits[row] ^ changes[pick]) | (half << 32)
        found.append((row, anchor, home[pick]))
    return tuple(np.concatenate(parts) for parts in zip(*found))


def _replicas(reps: DataFrame, max_distance: int, homes_only: bool) -> DataFrame:
    import pyarrow as pa

    def spread(batches):
        for batch in batches:
            fps = batch.column(0).to_numpy()
            for start in range(0, len(fps), 8192):
                part = fps[start : start + 8192]
                row, anchor, home = anchors(part, max_distance, homes_only)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(part[row]), pa.array(home)],
                    names=["anchor", "fp", "home"],
                )

    return reps.select("fp").mapInArrow(spread, "anchor bigint, fp bigint, home boolean")


def _compare(max_distance: int):
    """Tasks over replicas sorted by anchor, salt and homes first.  They return as many links
    as connect what is connected within a batch, at most one per replica."""
    import pyarrow as pa

    def connect(root, homes, home_group, fps, group):
        """``root`` over homes, then fingerprints, after linking those of equal groups.  Both
        are sorted by group; pairs exist a bounded number at a time."""
        first = np.searchsorted(home_group, group, "left")
        count = np.searchsorted(home_group, group, "right") - first
        upto = np.cumsum(count)
        done = 0
        while done < (upto[-1] if len(upto) else 0):
            pair = np.arange(done, min(done + PAIRS, int(upto[-1])))
            row = np.searchsorted(upto, pair, "right")
            home = first[row] + pair - (upto[row] - count[row])
            far = np.bitwise_count((fps[row] ^ homes[home]).view(np.uint64))
            near = far <= max_distance
            root = merged(root, len(homes) + row[near], home[near])
            done += PAIRS
        return root

    def compare(batches):
        homes = np.empty(0, np.int64)
        home_group = np.empty((0, 2), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(0).to_numpy(), batch.column(3).to_numpy()], axis=1)
            fps = batch.column(1).to_numpy()
            kind = batch.column(2).to_numpy()
            # Homes of the group that began in an earlier batch, then those of this one.
            if len(homes):
                still = (home_group == key[0]).all(axis=1)
                homes, home_group = homes[still], home_group[still]
            homes = np.concatenate([homes, fps[kind > 0]])
            home_group = np.concatenate([home_group, key[kind > 0]])
            both = np.concatenate([home_group, key])
            new = np.ones(len(both), dtype=bool)
            number = np.empty(len(both), dtype=np.int64)
            order = np.lexsort((both[:, 1], both[:, 0]))
            new[1:] = (both[order][1:] != both[order][:-1]).any(axis=1)
            number[order] = np.cumsum(new)
            asked = kind != 1
            nodes = np.concatenate([homes, fps[asked]])
            root = connect(
                np.arange(len(nodes)), homes, number[: len(homes)], fps[asked],
                number[len(homes) :][asked],
            )
            a, b = nodes, nodes[root]
            linked = a != b
            a, b = a[linked], b[linked]
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return compare


def fingerprint_links(reps: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """Links ``(a, b)`` that connect the distinct, non-null ``fp`` of ``reps`` exactly as all
    pairs at ``max_distance`` bits or fewer do."""
    if not 0 <= max_distance <= 8:
        raise ValueError("max_distance must be from 0 to 8")
    spark = reps.sparkSession
    crowded = (
        _replicas(reps, max_distance, homes_only=True)
        .groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("_homes"))
        .where(F.col("_homes") > TILE_HOMES)
        .select("anchor", F.ceil(F.col("_homes") / TILE_HOMES).cast("int").alias("_salts"))
    )
    crowded = write_table(crowded, shared_path(spark, "anchors"))
    if crowded.count() <= BROADCAST_ANCHORS:
        crowded = F.broadcast(crowded)
    salts = F.coalesce("_salts", F.lit(1))
    own = F.pmod(F.xxhash64("fp"), salts).cast("bigint")
    everywhere = F.sequence(F.lit(0).cast("bigint"), (salts - 1).cast("bigint"))
    rows = (
        _replicas(reps, max_distance, homes_only=False)
        .join(crowded, "anchor", "left")
        .select("anchor", "fp", "home", own.alias("_own"),
                F.explode(F.when(F.col("home"), everywhere).otherwise(F.array(own))).alias("salt"))
        # 0: asks, 1: is asked, 2: both.
        .select("anchor", "fp",
                F.when(~F.col("home"), 0).when(F.col("_own") == F.col("salt"), 2)
                .otherwise(1).cast("int").alias("kind"), "salt")
    )
    rows = rows.repartition("anchor", "salt").sortWithinPartitions(
        "anchor", "salt", F.desc(F.col("kind") > 0)
    )
    return rows.mapInArrow(_compare(max_distance), "a bigint, b bigint")


def simhash_components(
    docs: DataFrame,
    width: int = SHINGLE_WORDS,
    max_distance: int = MAX_DISTANCE,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``docs`` without its text, with ``fp``, ``component_id`` and ``component_fp``.

    Documents link when their fingerprints differ in ``max_distance`` bits or fewer.
    ``component_id`` is the smallest id of a document's component and ``component_fp`` its
    smallest fingerprint.  Null and empty texts have the fingerprint 0 and link like any
    other.  Documents without an id have a component too; it is null when no member has an
    id.  Every input row is returned once, repeated rows included.  Other columns go along,
    except that a column named like a result is replaced.
    """
    spark = docs.sparkSession
    results = ("fp", "component_id", "component_fp")
    docs = docs.drop(*[c for c in docs.columns if c in results and c not in (doc_id, text)])
    table = write_table(fingerprints(docs, width, text), shared_path(spark, "fingerprints"))
    reps = table.groupBy("fp").agg(F.min(doc_id).alias("_least"))
    reps = write_table(reps, shared_path(spark, "distinct-fingerprints"))
    root = connected_components(fingerprint_links(reps, max_distance))
    named = reps.join(root.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "_least", F.coalesce("component", "fp").alias("component_fp")
    )
    named = write_table(named, shared_path(spark, "named-fingerprints"))
    least = named.groupBy("component_fp").agg(F.min("_least").alias("component_id"))
    least = write_table(least, shared_path(spark, "component-ids"))
    classes = named.drop("_least").join(least, "component_fp")
    classes = write_table(classes, shared_path(spark, "components"))
    return table.join(classes, "fp")


def one_per_component(
    docs: DataFrame,
    width: int = SHINGLE_WORDS,
    max_distance: int = MAX_DISTANCE,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` with one document of each component: that of the smallest id.

    Of repeated rows with that id the one with the smallest fingerprint, then any equal one,
    stays.  A component without any id keeps one row.
    """
    from pyspark.sql.window import Window

    rows = numbered(docs, "numbered")
    classes = simhash_components(
        rows.select("__row", doc_id, text), width, max_distance, doc_id, text
    )
    candidates = classes.where(F.col(doc_id).eqNullSafe(F.col("component_id")))
    best = Window.partitionBy("component_fp").orderBy("fp", "__row")
    chosen = candidates.withColumn("__n", F.row_number().over(best)).where("__n = 1")
    return rows.join(chosen.select("__row"), "__row", "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
