"""Molecule library scan and the written tables of a run."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peakwise.functions.chem import formula_mass

#: Column layouts of the two published kinds of library, as ``{source: target}``.
MOL2VEC_COLUMNS = {"smile": "smile", "up_molvec": "embedding", "inchikey": "inchikey"}
CHEMBERTA_COLUMNS = {"smiles": "smile", "cls_embedding": "embedding", "inchikey": "inchikey"}

#: Bytes of files whose rows a task sorts and groups: 100,000 to 500,000 peaks.
TASK_BYTES = 4 << 20

#: As many peaks as text take this much more.
TEXT_FACTOR = 4


def read_library(
    spark: SparkSession,
    path: str,
    columns: Mapping[str, str] = MOL2VEC_COLUMNS,
    keep: tuple[str, ...] = (),
    formula: str | None = None,
) -> DataFrame:
    """Library Parquet under the names the operators use.

    ``library_id`` numbers rows by file split and position.  Taken straight from the scan it
    is the same on every attempt of a task, which is what spreading copies of one molecule
    over tasks relies on.  ``formula`` names a column of molecular formulas that gives
    ``exact_mass``; molecules whose formula is not one have a null mass.
    """
    masses = [formula_mass(F.col(formula)).alias("exact_mass")] if formula else []
    return spark.read.parquet(path).select(
        F.monotonically_increasing_id().alias("library_id"),
        *[F.col(source).alias(target) for source, target in columns.items()],
        *keep,
        *masses,
    )


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a writer committed a table to ``path``."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


#: Spark's setting that removes the shuffle files of a job when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Jobs started within remove their shuffle files when they end.

    For those that write a table, which is read back from then on.  Otherwise the files stay
    until the driver happens to collect its garbage, beside those of all later jobs.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def write_table(
    df: DataFrame, path: str, apart_by: str | None = None, resume: bool = False
) -> DataFrame:
    """Write Parquet and return a frame that reads it back.

    Used for features and for predictions: it cuts the lineage, so neither parsing nor
    inference runs again for the next stage or after a lost executor.  Rows with different
    values of ``apart_by`` lie in folders of their own, and a filter on it skips the others'.
    With ``resume`` a table that an earlier run finished is read back as it is, and one that it
    left unfinished is replaced.
    """
    if not (resume and finished(df.sparkSession, path)):
        writer = df.write.mode("overwrite" if resume else "errorifexists")
        if apart_by:
            writer = writer.partitionBy(apart_by)
        with shuffles_removed(df.sparkSession):
            writer.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    return back.select(*[F.col(f"`{c}`") for c in df.columns]) if apart_by else back


def tasks_for(df: DataFrame) -> int:
    """Tasks that a shuffle of a frame's rows deserves, from the files it reads.

    One per :data:`TASK_BYTES` of the folder with most bytes, so that a frame and its joins with
    smaller tables get the same number.  Frames that read no files have 0.
    """
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    sizes: Counter[str] = Counter()
    for file in df.inputFiles():
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
        status = path.getFileSystem(conf).getFileStatus(path)
        sizes[file.rpartition("/")[0]] += status.getLen()
    return -(-max(sizes.values(), default=0) // TASK_BYTES)


def dealt_tasks(df: DataFrame, factor: int = 1) -> int:
    """Tasks to deal a frame's rows over, with ``factor`` times :data:`TASK_BYTES` each, or 0 to
    leave that to the session.

    The session's number of shuffle partitions does not follow the input, and what a task holds
    would grow with it.  Up to as many tasks as run at a time it is kept; beyond that it is the
    least number.
    """
    spark, tasks = df.sparkSession, -(-tasks_for(df) // factor)
    if tasks <= spark.sparkContext.defaultParallelism:
        return 0
    return max(tasks, int(spark.conf.get("spark.sql.shuffle.partitions")))


def spread(df: DataFrame, *columns: str, like: DataFrame | None = None) -> DataFrame:
    """``df`` shuffled by ``columns`` over as many tasks as its files, or those of ``like``,
    deserve; see :func:`dealt_tasks`.  A join that follows takes their number over."""
    tasks = dealt_tasks(df if like is None else like)
    return df.repartition(tasks, *columns) if tasks else df


def write_results_csv(wide: DataFrame, path: str) -> None:
    """Wide results with a header; missing candidates are the text ``NA``."""
    wide.write.mode("errorifexists").option("header", True).option("nullValue", "NA").csv(path)
