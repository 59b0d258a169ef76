"""Mixing sources to target weights by distributed prefix sums over hash-random keys.

Documents of a source are ordered by a random key, the MD5 digest of their id.  Its leading
digits cut a source into ranges of a bounded number of documents; the words of the ranges are
summed first, prefix sums over the ranges give each range its offset, and prefix sums within a
range are windows of bounded size however large a source is.  A document's share of every
epoch then follows from its own offset alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from peakwise.llm.worker import carried, numbered
from peakwise.session import shared_path
from peakwise.sources.tables import write_table

WEIGHTS = (5, 2, 1)
TOTAL_SHARE = 1.5
MAX_EPOCHS = 2

#: Documents per key range at most, on average: ranges are prefixes of a uniform key.
RANGE_ROWS = 4_000

# Fixed value: characters that end a word.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(
    sizes: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = TOTAL_SHARE,
    max_epochs: float = MAX_EPOCHS,
) -> DataFrame:
    """``sizes(source, source_size)``, one row per source, with ``weight`` and ``target``.

    Sources in code point order, null last, take the weights in turn.  ``share`` of all words
    is dealt out by weight; a target stops at ``max_epochs`` times its source and the excess
    goes to the others by weight until none is above.  In order of size per weight the sources
    that stop come first, and the first that does not stop fixes the rate for all others.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_room = Window.orderBy("_room", F.col("source").asc_nulls_last())
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    after = by_room.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    turns = F.array(*[F.lit(float(w)) for w in weights])
    turn = ((F.row_number().over(by_name) - 1) % len(weights)).cast("int")
    ranked = (
        sizes.withColumn("weight", F.get(turns, turn))
        .withColumn("_cap", F.col("source_size") * float(max_epochs))
        .withColumn("_room", F.col("_cap") / F.col("weight"))
        .withColumn("_total", F.sum("source_size").over(everything) * float(share))
        .withColumn("_capped", F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
        .withColumn("_rate", (F.col("_total") - F.col("_capped")) / F.sum("weight").over(after))
    )
    # From the first source that does not stop on, rates only fall.
    rate = F.max(F.when(F.col("_rate") <= F.col("_room"), F.col("_rate")))
    ranked = ranked.withColumn("_level", rate.over(everything))
    target = F.when(
        F.col("_level").isNull() | (F.col("_room") <= F.col("_level")), F.col("_cap")
    ).otherwise(F.col("weight") * F.col("_level"))
    return ranked.select("source", "source_size", "weight", target.alias("target"))


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = TOTAL_SHARE,
    max_epochs: float = MAX_EPOCHS,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """``docs`` without its text, with ``size``, ``source_size``, ``target`` and ``taken``.

    ``taken`` is the number of words the mix takes of a document, repeats counted: whole
    epochs of its source and, in the last epoch, documents in key order up to the budget
    ``round(target)``.  The document at the cut gives the words before the cut only, so that
    the words taken of a source are its budget exactly.  Ties of the key (repeated ids) are
    ordered by size, and documents alike in both by a digest of their place in a written table.
    Null and empty texts have size 0 and take 0; a null source is a source of its own; a null
    id is keyed like an empty one.  Any number of rows may share an id.
    """
    spark = docs.sparkSession
    made = ("size", "source_size", "target", "taken")
    packed, others = carried(docs, doc_id, source, text, *made)
    kept = [doc_id, source]
    key = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))
    place = F.lpad(F.hex(F.xxhash64(F.monotonically_increasing_id())), 16, "0")
    sized = docs.select(
        *kept, *packed, word_count(F.col(text)).alias("size"), key.alias("_key"),
        place.alias("_tie"),
    )
    sized = write_table(sized, shared_path(spark, "sizes"))

    counted = sized.groupBy(F.col(source).alias("source")).agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_docs")
    )
    counted = write_table(counted, shared_path(spark, "sources"))
    goals = targets(counted.drop("_docs"), weights, share, max_epochs).join(
        counted.select(F.col("source").alias("_s"), "_docs"), F.col("source").eqNullSafe(F.col("_s"))
    )
    # Digits of the key that name a range: 16 ** digits ranges of a source.
    digits = F.greatest(F.lit(0), F.ceil(F.log(16.0, F.col("_docs") / range_rows)))
    goals = goals.select(
        "source", "source_size", "target", digits.cast("int").alias("_digits")
    )
    goals = write_table(goals, shared_path(spark, "targets"))

    renamed = goals.withColumnRenamed("source", "_source")
    rows = sized.join(
        renamed, F.col(source).eqNullSafe(F.col("_source"))
    ).withColumn("_prefix", F.expr("substr(_key, 1, _digits)"))
    rows = _with_ranges(rows, range_rows)
    ranges = rows.groupBy("_source", "_range").agg(F.sum("size").alias("_words"))
    along = Window.partitionBy("_source").orderBy("_range")
    so_far = F.sum("_words").over(along) - F.col("_words")
    ranges = ranges.select(
        F.col("_source").alias("_s"), F.col("_range").alias("_r"), so_far.alias("_offset")
    )
    ranges = write_table(ranges, shared_path(spark, "ranges"))

    within = Window.partitionBy("_source", "_range").orderBy("_key", "size", "_tie")
    before = F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("_before", F.coalesce(before, F.lit(0)))
    rows = rows.join(
        ranges,
        F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_range") == F.col("_r")),
    )
    budget = F.round("target").cast("bigint")
    epochs = F.when(F.col("source_size") > 0, F.expr("cast(round(target) as bigint) div source_size"))
    rest = budget - F.col("_epochs") * F.col("source_size") - F.col("_offset") - F.col("_before")
    rows = rows.withColumn("_epochs", F.coalesce(epochs, F.lit(0)))
    last = F.greatest(F.lit(0).cast("bigint"), F.least(F.col("size"), rest))
    return rows.select(
        *kept,
        *others,
        "size",
        "source_size",
        "target",
        (F.col("_epochs") * F.col("size") + last).alias("taken"),
    )


def _with_ranges(rows: DataFrame, range_rows: int) -> DataFrame:
    """``rows`` with ``_range``, a struct whose order is that of ``(_key, size, _tie)``.

    Most ranges are prefixes of the key.  A prefix with over four times ``range_rows`` rows holds
    repeated ids: there every key and size is a range, and one that many rows share is cut by
    the tie's digits.
    """
    spark = rows.sparkSession
    none = F.lit("")
    plain = F.struct(
        F.col("_prefix").alias("prefix"), none.alias("key"), F.lit(0).cast("bigint").alias("size"),
        none.alias("tie"),
    )
    counted = rows.groupBy("_source", "_prefix").agg(F.count(F.lit(1)).alias("_n"))
    crowded = counted.where(F.col("_n") > 4 * range_rows).select(
        F.col("_source").alias("_cs"), F.col("_prefix").alias("_cp")
    )
    crowded = write_table(crowded, shared_path(spark, "crowded-ranges"))
    if not crowded.limit(1).count():
        return rows.withColumn("_range", plain)
    own = F.col("_source").eqNullSafe(F.col("_cs")) & (F.col("_prefix") == F.col("_cp"))
    alike = rows.join(crowded, own, "left_semi").groupBy("_source", "_key", "size").agg(
        F.ceil(F.log(16.0, F.count(F.lit(1)) / range_rows)).cast("int").alias("_cut")
    )
    alike = write_table(
        alike.select(F.col("_source").alias("_as"), F.col("_key").alias("_ak"),
                     F.col("size").alias("_az"), F.greatest(F.lit(0), "_cut").alias("_cut")),
        shared_path(spark, "alike-documents"),
    )
    same = (
        F.col("_source").eqNullSafe(F.col("_as")) & (F.col("_key") == F.col("_ak"))
        & (F.col("size") == F.col("_az"))
    )
    fine = F.struct(
        F.col("_prefix").alias("prefix"), F.col("_key").alias("key"), F.col("size").alias("size"),
        F.expr("substr(_tie, 1, _cut)").alias("tie"),
    )
    cut = rows.join(alike, same, "left")
    cut = cut.withColumn("_range", F.when(F.col("_cut").isNull(), plain).otherwise(fine))
    return cut.drop("_as", "_ak", "_az", "_cut")


def mixed_documents(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = TOTAL_SHARE,
    max_epochs: float = MAX_EPOCHS,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as the mix takes it.

    The document at a source's cut ends after the last word taken; columns other than the
    text are left as they are.  Documents without words have nothing to take and are left out.
    """
    rows = numbered(docs, "numbered")
    shares = mix(
        rows.select("__row", doc_id, source, text), weights, share, max_epochs, doc_id,
        source, text,
    ).where("taken > 0").select("__row", F.col("size").alias("__size"), "taken")
    whole = F.expr("taken div __size").cast("int")
    part = (F.col("taken") % F.col("__size")).cast("int")
    copies = F.concat(
        F.array_repeat(F.col("__size").cast("int"), whole),
        F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<int>")),
    )
    shares = shares.select("__row", "__size", F.explode(copies).alias("__words"))
    rows = rows.join(shares, "__row")
    spaced = F.regexp_extract_all(F.col(text), F.lit(r"([\x20\x09-\x0D]*" + WORD + ")"), F.lit(1))
    cut = F.array_join(F.slice(spaced, F.lit(1), F.col("__words")), "")
    whole_text = F.col("__words") == F.col("__size")
    text_column = F.when(whole_text, F.col(text)).otherwise(cut)
    return rows.withColumn(text, text_column).select(*[F.col(f"`{c}`") for c in docs.columns])
