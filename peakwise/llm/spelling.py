"""Spelling variants of the words of a corpus, through sorted rotations of marked words.

A word gets a terminator and is turned in all ways.  Turned so that a character ``x`` of
``AxB`` comes last, it reads ``B$Ax``; all words that have another character in that place, or
none, share the prefix ``B$A``.  A replacement and an insertion or deletion are so one range of
the sorted rotations, that of a prefix that skips the edited character.  A range holds a word
per character of the alphabet and the word without one; two members of a range are near words,
and two near words meet in a range.  Where a character stands in a run of equal ones, leaving
out any of the run gives the same word; only the first of the run counts such a pair.

Words are numbered in code-point order, and rotations carry numbers.  The two sides of a long
word's rotation are named by digests, so that a word's rotations stay short.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from peakwise.llm.worker import slices
from peakwise.session import shared_path
from peakwise.sources.tables import write_table

#: A word is a run of these, all of which are code points of one UTF-16 unit.
LETTERS = "A-Za-zÀ-ÿ"

#: Ends a word; sorts before every letter.
END = "$"

#: Code points of a rotation's shared prefix from which its sides are named by digests.
LONG = 64

#: Distinct words that a task counts before it hands them on.
COUNTED = 200_000

#: Bytes of texts that a task reads at a time.
SLICE_BYTES = 4 << 20

#: Rotations in a batch of rows.
BATCH = 20_000


def runs_of(text: str, length: int) -> Iterator[str]:
    """Lower-cased runs of at least so many letters; only A-Z have a lower case here."""
    import re

    for run in re.findall(f"[{LETTERS}]{{{length},}}", text):
        yield run.lower() if run.isascii() else re.sub("[A-Z]+", lambda m: m[0].lower(), run)


def written(doc_id: str, run: str, every: int) -> str:
    """The run as this document writes it: one in ``every`` lacks a letter."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(
    docs: DataFrame,
    length: int = 7,
    least: int = 2,
    every: int = 31,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``(id, word, n)``: words of at least ``length`` letters that occur ``least`` times in all
    texts, numbered in code-point order.

    Tasks count what they read, at most ``COUNTED`` words at a time, before words are shuffled.
    """
    import pyarrow as pa

    def table(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
            names=["word", "n"],
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for rows in slices(batch, 1, SLICE_BYTES):
                for name, value in zip(rows.column(0), rows.column(1)):
                    name, own = name.as_py() or "", Counter(runs_of(value.as_py() or "", length))
                    start = zlib.crc32(f"{name}:".encode())
                    for run, n in own.items():
                        if not zlib.crc32(run.encode(), start) % every:
                            run = written(name, run, every)
                            if len(run) < length:
                                continue
                        counts[run] += n
                    if len(counts) >= COUNTED:
                        yield table(counts)
                        counts.clear()
        yield table(counts)

    spark = docs.sparkSession
    rows = docs.select(
        F.col(f"`{doc_id}`").cast("string").alias("name"), F.col(f"`{text}`").alias("text")
    )
    total = rows.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    total = write_table(total.where(F.col("n") >= least), shared_path(spark, "spelt-words"))
    # As many ranges as the session shuffles to: a word's rotations are many times its size.
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = total.repartitionByRange(ranges, "word").sortWithinPartitions("word")
    numbered = ordered.select(F.monotonically_increasing_id().alias("id"), "word", "n")
    return write_table(numbered, shared_path(spark, "numbered-words"))


def _side_names(letters: str) -> list[str]:
    """A name for every prefix of ``letters``, each from the one before."""
    digest, names = hashlib.blake2b(digest_size=16), []
    names.append(digest.hexdigest())
    for letter in letters:
        digest.update(letter.encode())
        names.append(digest.copy().hexdigest())
    return names


def rotations_of(word: str) -> Iterator[tuple[str, str, bool]]:
    """``(key, x, counts)`` of all rotations of a word.

    ``key`` is the prefix that skips the last character ``x``, or the whole rotation where ``x``
    is empty.  ``counts`` is false where an equal character stands before ``x``.
    """
    n = len(word)
    if n <= LONG:
        for i in range(n + 1):
            yield word[i:] + END + word[:i], "", True
            if i < n:
                yield word[i + 1 :] + END + word[:i], word[i], not i or word[i - 1] != word[i]
        return
    heads, tails = _side_names(word), _side_names(word[::-1])[::-1]
    for i in range(n + 1):
        yield f"{n} {tails[i]}{END}{heads[i]}", "", True
        if i < n:
            if n - 1 <= LONG:
                key = word[i + 1 :] + END + word[:i]
            else:
                key = f"{n - 1} {tails[i + 1]}{END}{heads[i]}"
            yield key, word[i], not i or word[i - 1] != word[i]


def rotations(words: DataFrame) -> DataFrame:
    """``(key, x, counts, id, n)`` of all rotations of ``words(id, word, n)``."""
    import pyarrow as pa

    names = ["key", "x", "counts", "id", "n"]
    kinds = [pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.int64()]

    def table(rows: list) -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for number, word, n in zip(*(c.to_pylist() for c in batch.columns)):
                for rotation in rotations_of(word):
                    rows.append((*rotation, number, n))
                    if len(rows) == BATCH:
                        yield table(rows)
                        rows = []
        if rows:
            yield table(rows)

    schema = "key string, x string, counts boolean, id bigint, n bigint"
    return words.select("id", "word", "n").mapInArrow(turn, schema)


def _neighbours(words: DataFrame) -> DataFrame:
    """``(id, n_near, best)`` of words with near words; ``best(n, least)`` is the near word of
    largest count, and of equal counts the negative of the smallest number.

    A key has a row for each letter of the alphabet at most, so its two best members and three
    numbers tell every member what it needs, and no pairs are made.
    """
    group = Window.partitionBy("key")
    member = F.struct("n", (-F.col("id")).alias("least"))
    ranked = group.orderBy(member.desc()).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    short = F.col("x") == ""
    members = (
        rotations(words)
        .withColumn("members", F.count(F.lit(1)).over(group))
        .where("members > 1")
        .withColumn("shorts", F.sum(short.cast("int")).over(group))
        .withColumn("counted", F.sum((~short & F.col("counts")).cast("int")).over(group))
        .withColumn("first", F.first(member).over(ranked))
        .withColumn("second", F.nth_value(member, 2).over(ranked))
    )
    others = F.when(short, F.col("counted")).otherwise(
        F.col("members") - F.col("shorts") - 1 + F.col("shorts") * F.col("counts").cast("int")
    )
    best = F.when(F.col("first.least") == -F.col("id"), F.col("second")).otherwise(F.col("first"))
    return members.select("id", others.alias("others"), best.alias("best")).groupBy("id").agg(
        F.sum("others").alias("n_near"), F.max("best").alias("best")
    )


def _roots(forms: DataFrame) -> DataFrame:
    """``(id, root)`` of ``forms(id, form)``: the end of the chain of forms from every word.

    A form's count is at least ten times the word's, so a chain is no longer than a count has
    digits, and each round doubles the steps taken.
    """
    spark = forms.sparkSession
    state = write_table(
        forms.select("id", F.col("form").alias("root")), shared_path(spark, "spelling-roots")
    )
    while True:
        ahead = state.select(F.col("id").alias("root"), F.col("root").alias("further"))
        moved = state.join(ahead, "root", "left").select(
            "id", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
        )
        moved = write_table(moved, shared_path(spark, "spelling-roots"))
        if not moved.where("moved").limit(1).count():
            return moved.select("id", "root")
        state = moved.select("id", "root")


def spelling_variants(
    docs: DataFrame,
    length: int = 7,
    least: int = 2,
    every: int = 31,
    factor: int = 10,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of the words of whole texts.

    Words are the maximal runs of letters with A-Z lower-cased; where ``every`` divides the
    CRC-32 ``h`` of ``<doc_id>:<run>``, the run's letter ``h % length`` is left out.  Kept are
    words of at least ``length`` letters that occur ``least`` times.  Near words differ by one
    letter inserted, deleted or replaced.  ``form`` is the near word of largest count, of equal
    counts the first in code-point order, if it occurs ``factor`` times as often as the word,
    else null; ``root`` is the end of the chain of forms, the word itself without one.

    Null texts hold no words; a null id counts as empty.  Rows that repeat count as often as
    they stand there; other columns play no part.  No words give no rows.  Words of any length
    are compared whole, the sides of those beyond ``LONG`` letters by 128-bit digests.
    """
    if factor < 2:
        raise ValueError("factor must be at least 2, else chains of forms could close")
    words = word_counts(docs, length, least, every, doc_id, text)
    spark = docs.sparkSession
    near = write_table(_neighbours(words), shared_path(spark, "near-words"))
    near = words.select("id", "n").join(near, "id").select(
        "id",
        "n_near",
        F.when(F.col("best.n") >= factor * F.col("n"), -F.col("best.least")).alias("form"),
        F.when(F.col("best.n") >= factor * F.col("n"), F.col("best.n")).alias("form_n"),
    )
    near = write_table(near, shared_path(spark, "word-forms"))
    roots = _roots(near.where("form IS NOT NULL").select("id", "form"))
    named = near.join(roots, "id", "left")
    for column in ("form", "root"):
        names = words.select(F.col("id").alias(column), F.col("word").alias(f"{column}_word"))
        named = named.join(names, column, "left")
    named = named.select("id", "n_near", "form_n", "form_word", "root_word")
    return words.join(named, "id", "left").select(
        "word",
        F.col("form_word").alias("form"),
        F.coalesce("root_word", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        "form_n",
    )
