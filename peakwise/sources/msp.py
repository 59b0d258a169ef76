"""MSP text: blocks of headers and peak lines, one block per spectrum.

A block starts at its id line (``smile:`` for annotated files, ``Name:`` otherwise); blank
lines mean nothing.  The default scan makes the id line the record separator, so a file of
any size splits over tasks and no shuffle is needed to find the blocks.  Arrow tasks follow the
rows of the scan and see where a file begins, so that one read is enough.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from peakwise.session import shared_path
from peakwise.sources.tables import write_table

ANNOTATED_TAG = "smile:"
NAMED_TAG = "Name:"
#: File splits whose block counts are broadcast, 200 bytes each; more are joined.
BROADCAST_SPLITS = 500_000

_PRECURSOR = "Precursor:"
_ADDUCT = "Adduct:"

_PEAK_LIST = T.ArrayType(
    T.StructType([T.StructField("mz", T.DoubleType()), T.StructField("intensity", T.DoubleType())])
)


def _block_splitter(id_tag: str, separated: bool):
    """Arrow function of a scan's rows ``(file, start, value)`` in their order: a row per block,
    ``(file, start, seq, block)``, numbered within the file split."""

    def split(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        # A line that starts with the tag; lines end as the parser's regular expressions have it.
        opening = re.compile(
            r"(?:\A\ufeff?|(?<=\n)|(?<=\r)(?!\n)|(?<=[\x85\u2028\u2029]))[ \t\x0b\f]*"
            + re.escape(id_tag)
        )
        place, number = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            file, start, value = batch.columns
            changed = np.ones(len(file), dtype=bool)
            for column in (file, start):
                same = pc.equal(column.slice(1), column.slice(0, len(column) - 1))
                changed[1:] &= same.to_numpy(zero_copy_only=False)
            changed[1:] = ~changed[1:]
            changed[0] = place != (file[0].as_py(), start[0].as_py())
            # The separator swallows the tag of every record but the first of a file, which
            # holds its own tag or none.
            first = changed & (start.to_numpy() == 0) if separated else np.ones(len(file), bool)
            tagged = pc.binary_join_element_wise(pa.scalar(id_tag), value, "")
            value = pc.if_else(pa.array(first), value, tagged)
            # Indented id lines (and all of them in whole files) are found here.
            odd = first | (pc.count_substring(value, id_tag).to_numpy() > 1)
            counts = np.ones(len(file), dtype=np.int64)
            blocks, at = [], 0
            for i in np.flatnonzero(odd):
                text = value[i].as_py()
                cuts = [m.start() for m in opening.finditer(text)]
                counts[i] = len(cuts)
                found = [text[a:b] for a, b in zip(cuts, [*cuts[1:], len(text)])]
                blocks += [value.slice(at, i - at), pa.array(found, pa.string())]
                at = i + 1
            block = pa.concat_arrays([*blocks, value.slice(at)])
            # Blocks ahead of a row within its split: those since the split began, here or in
            # an earlier batch.
            ahead = np.cumsum(counts) - counts
            begun = np.maximum.accumulate(np.where(changed, np.arange(len(file)), -1))
            ahead = np.where(begun < 0, ahead + number, ahead - ahead[begun])
            row = np.repeat(np.arange(len(file)), counts)
            within = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            place, number = (file[-1].as_py(), start[-1].as_py()), int(ahead[-1] + counts[-1])
            rows = pa.array(row)
            columns = [file.take(rows), start.take(rows), pa.array(ahead[row] + within), block]
            yield pa.RecordBatch.from_arrays(columns, names=["file", "start", "seq", "block"])

    return split


def read_blocks(
    spark: SparkSession, path: str | list[str], id_tag: str, whole_files: bool = False
) -> DataFrame:
    """Scan files into ``(ordinal, block)``; every file is read once.

    ``ordinal`` is ``struct(file, start, seq)`` and sorts in file order: split offset, then
    number of the block within the split.  Text ahead of a file's first id line belongs to no
    block.  ``whole_files`` reads each file as one value; use it for files of moderate size.
    """
    if whole_files:
        text = spark.read.text(path, wholetext=True)
    else:
        text = spark.read.text(path, lineSep="\n" + id_tag)
    text = text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        "value",
    )
    blocks = text.mapInArrow(
        _block_splitter(id_tag, not whole_files),
        "file string, start bigint, seq bigint, block string",
    )
    return blocks.select(F.struct("file", "start", "seq").alias("ordinal"), "block")


def number_blocks(blocks: DataFrame, across_files: bool = False) -> DataFrame:
    """Blocks of :func:`read_blocks` with ``number``: 0, 1, ... in each file, or in all files in
    the order of their paths.

    The number is the one within the split plus the blocks of the splits before it, from one
    row per split; up to :data:`BROADCAST_SPLITS` of them are broadcast.  The first pass reads
    ``ordinal`` alone, so pass a written table.
    """
    file, start, seq = (F.col(f"ordinal.{c}") for c in ("file", "start", "seq"))
    splits = blocks.groupBy(file.alias("_file"), start.alias("_start")).agg(
        (F.max(seq) + 1).alias("_n")
    )
    before = Window.orderBy("_file", "_start")
    if not across_files:
        before = Window.partitionBy("_file").orderBy("_start")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    splits = write_table(splits, shared_path(blocks.sparkSession, "splits"))
    if splits.count() <= BROADCAST_SPLITS:
        splits = F.broadcast(splits)
    own = (file == F.col("_file")) & (start == F.col("_start"))
    numbered = blocks.join(splits, own).withColumn("number", seq + F.col("_before"))
    return numbered.drop("_file", "_start", "_n", "_before")


# Blanks within a line, and a peak line: two tokens, the first one starting with a digit.
_BLANK = r"[^\S\r\n]"
_PEAK_LINE = rf"(?m)^{_BLANK}*([0-9]\S*){_BLANK}+(\S+)"


def _header(tag: str) -> Column:
    """Text after ``tag`` on the last line starting with it; null without such a line."""
    line = F.lit(rf"(?m)^{_BLANK}*{tag}{_BLANK}*([^\r\n]*)")
    last = F.try_element_at(F.regexp_extract_all("block", line, F.lit(1)), F.lit(-1))
    return F.rtrim(last, F.lit(" \t"))


def _finite(number: Column) -> Column:
    """Whether a number is one: not null, infinite or undefined."""
    return F.coalesce(F.abs(number) < F.lit(float("inf")), F.lit(False))


def _peaks() -> Column:
    def token(group: int) -> Column:
        return F.regexp_extract_all("block", F.lit(_PEAK_LINE), F.lit(group))

    return F.zip_with(
        token(1),
        token(2),
        lambda mz, intensity: F.struct(
            mz.try_cast("double").alias("mz"), intensity.try_cast("double").alias("intensity")
        ),
    )


def parse_blocks(
    blocks: DataFrame,
    id_tag: str,
    mode: str = "PERMISSIVE",
    inherit_headers: bool = False,
) -> DataFrame:
    """Blocks to spectrum records.

    The id column is ``smile`` for :data:`ANNOTATED_TAG` and ``spectrum_id`` otherwise.
    Blocks with an empty id are dropped.  A block with a malformed number, or one that a double
    holds as infinite, keeps its text in ``_corrupt`` (``PERMISSIVE``), goes away
    (``DROPMALFORMED``) or fails the job (``FAILFAST``).  ``inherit_headers`` fills a missing precursor or adduct from the block
    before it in the same file.
    """
    if mode not in ("PERMISSIVE", "DROPMALFORMED", "FAILFAST"):
        raise ValueError(f"unknown mode {mode!r}")
    id_column = "smile" if id_tag == ANNOTATED_TAG else "spectrum_id"
    first_line = rf"^\x{{FEFF}}?\s*{id_tag}{_BLANK}*([^\r\n]*)"
    record = F.struct(
        F.rtrim(F.regexp_extract("block", first_line, 1), F.lit(" \t")).alias(id_column),
        _header(_PRECURSOR).alias("precursor_text"),
        _header(_ADDUCT).alias("adduct"),
        _peaks().alias("peaks"),
    )
    # A generator is parsed once per block; a filter on a projection would parse again.
    parsed = blocks.select("ordinal", "block", F.inline(F.array(record))).select(
        "ordinal",
        id_column,
        "precursor_text",
        F.col("precursor_text").try_cast("double").alias("precursor"),
        "adduct",
        "peaks",
        "block",
    )
    malformed = (F.col("precursor_text").isNotNull() & ~_finite(F.col("precursor"))) | F.exists(
        "peaks", lambda p: ~_finite(p["mz"]) | ~_finite(p["intensity"])
    )
    if mode == "FAILFAST":
        checked = F.when(
            malformed, F.raise_error(F.concat(F.lit("malformed MSP block: "), F.col("block")))
        ).otherwise(F.col("peaks"))
        parsed = parsed.withColumn("peaks", checked.cast(_PEAK_LIST)).drop("block")
    elif mode == "DROPMALFORMED":
        parsed = parsed.where(~malformed).drop("block")
    else:
        parsed = parsed.withColumn("_corrupt", F.when(malformed, F.col("block"))).drop("block")
    if inherit_headers:
        # A malformed precursor stays one: text and number travel together.
        number = F.struct("precursor_text", "precursor")
        parsed = parsed.withColumn(
            "precursor", F.when(F.col("precursor_text").isNotNull(), number)
        )
        parsed = _fill_from_previous(parsed, ["precursor", "adduct"])
        parsed = parsed.withColumns(
            {c: F.col("precursor")[c] for c in ("precursor_text", "precursor")}
        )
    return parsed.where(F.col(id_column) != "")


def _fill_from_previous(records: DataFrame, columns: list[str]) -> DataFrame:
    """Last non-null value at or before each record of a file.

    Filled inside each file split first; what a split passes on comes from a one-row summary
    per split, so no task ever holds a whole file.
    """
    split = [F.col("ordinal.file").alias("_file"), F.col("ordinal.start").alias("_start")]
    tagged = records.select("*", *split)
    inside = Window.partitionBy("_file", "_start").orderBy("ordinal")
    across = Window.partitionBy("_file").orderBy("_start")
    tails = (
        tagged.groupBy("_file", "_start")
        .agg(
            *[
                F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("ordinal"))).alias(c)
                for c in columns
            ]
        )
        .select(
            "_file",
            "_start",
            *[
                F.last(c, ignorenulls=True)
                .over(across.rowsBetween(Window.unboundedPreceding, -1))
                .alias(f"_carry_{c}")
                for c in columns
            ],
        )
    )
    filled = tagged.withColumns(
        {c: F.last(c, ignorenulls=True).over(inside) for c in columns}
    ).join(tails, ["_file", "_start"])
    return filled.withColumns(
        {c: F.coalesce(F.col(c), F.col(f"_carry_{c}")) for c in columns}
    ).select(*records.columns)


def read_annotated(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    """Annotated MSP files as records keyed by ``smile``."""
    whole_files = options.pop("whole_files", False)
    return parse_blocks(
        read_blocks(spark, path, ANNOTATED_TAG, whole_files), ANNOTATED_TAG, **options
    )


def read_named(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    """Unannotated MSP files as records keyed by ``spectrum_id``."""
    whole_files = options.pop("whole_files", False)
    return parse_blocks(read_blocks(spark, path, NAMED_TAG, whole_files), NAMED_TAG, **options)


def tag_ion_mode(records: DataFrame, ion_mode: str) -> DataFrame:
    """Mark all records of a source with its ion mode, ``+`` or ``-``.

    The mode belongs to the source; the adduct of a record has no say in it.
    """
    if ion_mode not in ("+", "-"):
        raise ValueError("ion_mode is '+' or '-'")
    return records.withColumn("ion_mode", F.lit(ion_mode))


def union_ion_modes(positive: DataFrame, negative: DataFrame) -> DataFrame:
    """Both ion modes in one frame, so one job serves them."""
    return tag_ion_mode(positive, "+").unionByName(tag_ion_mode(negative, "-"))
