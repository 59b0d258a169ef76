"""Spectra, libraries and MSP files derived from the test tables."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from peakwise.functions.binning import grid_size
from peakwise.functions.rounding import PROTON_MASS
from peakwise.session import shared_path
from peakwise.sources.tables import dealt_tasks, shuffles_removed, spread

N_BINS = grid_size(0.01, 700)
WIDTH = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders_as_spectra(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order; two neighbouring customers share a structure string."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("spectrum_id"),
        F.col("o_orderkey").alias("ordinal"),
        F.col("o_custkey").alias("structure_key"),
        F.concat("o_orderstatus", F.lit("-"), F.expr("o_custkey div 2")).alias("smile"),
        (F.col("o_totalprice") / 400).alias("precursor"),
    )


def order_peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("spectrum_id"),
        F.col("l_linenumber").alias("pos"),
        (F.col("l_extendedprice") / 150).alias("mz"),
        # The root keeps shares of a total off the decimals where rounding ties.
        (F.col("l_quantity") * F.col("l_quantity") + F.sqrt("l_extendedprice") / 100).alias(
            "intensity"
        ),
    )


def peak_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Peak rows: an order is a spectrum and its lines are peaks."""
    spectra = orders_as_spectra(spark, sf_dir).select("spectrum_id", "precursor")
    peaks = order_peaks(spark, sf_dir).drop("pos")
    return spread(peaks, "spectrum_id").join(spectra, "spectrum_id")


def on_bits(embedding) -> F.Column:
    """Fingerprint stand-in: positions of the positive components."""
    positions = F.transform(embedding, lambda x, i: F.when(x > 0, i))
    return F.filter(positions, lambda i: i.isNotNull())


def vector_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query per vector: its components in reverse, the label as mass key."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("spectrum_id"),
        F.col("label").cast("bigint").alias("mass_key"),
        F.reverse("embedding").alias("embedding"),
        on_bits(F.col("embedding")).alias("ground_fp"),
    )


def vector_library(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A molecule per vector; those of label 9 have no mass."""
    smile = F.concat(F.lit("V"), F.col("vec_id"))
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("library_id"),
        smile.alias("smile"),
        F.upper(F.md5(smile)).alias("inchikey"),
        F.expr("nullif(label, 9)").cast("bigint").alias("mass_key"),
        (F.col("label") + PROTON_MASS).alias("precursor_mz"),
        F.col("embedding"),
        on_bits(F.col("embedding")).alias("fp_bits"),
    )


def customer_mass() -> F.Column:
    return 100 + F.floor((F.col("c_acctbal") + 1000) / 50) * 5.0


def customers_as_molecules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A molecule per customer with the vector of ``c_custkey`` modulo the vector count."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    n_vectors = vectors.count()
    molecules = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("library_id"),
        F.col("c_name").alias("smile"),
        F.upper(F.md5("c_name")).alias("inchikey"),
        customer_mass().alias("exact_mass"),
        (F.col("c_custkey") % n_vectors).alias("vec_id"),
    )
    return (
        molecules.join(vectors, "vec_id")
        .withColumn("fp_bits", on_bits(F.col("embedding")))
        .drop("vec_id")
    )


def weight_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(row, w)``: the sums of all vectors whose id has the same remainder, as many rows as
    there are vectors, and one per grid point at most."""
    vectors = table(spark, sf_dir, "embeddings")
    n = min(vectors.count(), N_BINS)
    parts = vectors.select(
        (F.col("vec_id") % n).alias("row"), F.posexplode("embedding").alias("dim", "x")
    )
    sums = parts.groupBy("row", "dim").agg(F.sum(F.col("x").cast("double")).alias("x"))
    # At most as many entries as a vector has components.
    listed = F.array_sort(F.collect_list(F.struct("dim", "x")))
    return sums.groupBy("row").agg(F.transform(listed, lambda e: e["x"]).alias("w"))


def written_weights(spark: SparkSession, sf_dir: str) -> str:
    path = shared_path(spark, "weight-rows")
    weight_rows(spark, sf_dir).write.parquet(path)
    return path


def weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(bin, w)`` for every grid point; rows repeat along the grid."""
    rows = spark.read.parquet(written_weights(spark, sf_dir))
    grid = spark.range(N_BINS).select(
        F.col("id").cast("int").alias("bin"), (F.col("id") % rows.count()).alias("row")
    )
    return grid.join(rows, "row").drop("row")


class VectorWeights:
    """Loader of a one-layer network from written weight rows, with ReLU."""

    def __init__(self, path: str):
        self.path = path

    def __call__(self):
        import pyarrow.parquet as pq
        from pyarrow import fs

        if ":" in self.path:
            uri = self.path.replace(":/", ":///", 1) if ":///" not in self.path and (
                "://" not in self.path) else self.path
            files, path = fs.FileSystem.from_uri(uri)
        else:
            files, path = fs.LocalFileSystem(), self.path
        rows = pq.read_table(path, filesystem=files).sort_by("row")
        w = np.stack(rows["w"].to_numpy())

        def predict(bin_lists: list[np.ndarray]) -> np.ndarray:
            sums = [w[np.asarray(bins) % len(w)].sum(axis=0) for bins in bin_lists]
            return np.maximum(np.stack(sums), 0.0)

        return predict


def unloadable() -> Callable:
    """Loader of a model that is not there."""
    raise FileNotFoundError("no model")


def vector_model(spark: SparkSession, sf_dir: str, negated: bool = False) -> Callable:
    """The model of the test tables; the negative one returns the opposite."""
    return (NegatedWeights if negated else VectorWeights)(written_weights(spark, sf_dir))


class NegatedWeights(VectorWeights):
    def __call__(self):
        predict = super().__call__()
        return lambda bins: -predict(bins)


def _msp_rows(spectra: DataFrame, peaks: DataFrame) -> DataFrame:
    """The rows that lines are made of, by ``section``: the title (-1), headers (0), peaks (4)."""
    kinds = dict(spectra.dtypes) | dict(peaks.dtypes)

    def row(section: int, *own: str) -> list:
        others = ("id", "precursor", "adduct", "mz", "intensity")
        nulls = [F.lit(None).cast(kinds[c]).alias(c) for c in others if c not in own]
        return ["spectrum_id", F.lit(section).alias("section"), *own, *nulls]

    head = spectra.select(*row(0, "id", "precursor", "adduct"))
    body = peaks.where(F.col("spectrum_id").isNotNull()).select(*row(4, "mz", "intensity"))
    number = F.lit(-1).cast(kinds["spectrum_id"]).alias("spectrum_id")
    title = spectra.sparkSession.range(1).select(number).select(*row(-1))
    return head.unionByName(body).unionByName(title)


def _msp_lines(rows: DataFrame, id_tag: str) -> DataFrame:
    """Lines of the rows of :func:`_msp_rows`, all rows of a spectrum in one task, in its order.
    Peaks without a spectrum have none."""
    group = Window.partitionBy("spectrum_id")
    rows = rows.withColumns({
        "n_peaks": F.count_if(F.col("section") == 4).over(group),
        "n_heads": F.count_if(F.col("section") == 0).over(group),
    }).where((F.col("section") != 4) | (F.col("n_heads") > 0))
    headers = [
        F.concat(F.when(F.col("spectrum_id") % 5 == 2, "  ").otherwise(""),
                 F.lit(f"{id_tag} "), F.col("id")),
        F.concat(F.lit("Precursor: "), F.when(F.col("spectrum_id") % 50 == 7, "x").otherwise(""),
                 F.col("precursor")),
        F.concat(F.lit("Adduct: "), F.col("adduct")),
        F.concat(F.lit("Num Peaks: "), F.col("n_peaks")),
    ]
    texts = (
        F.when(F.col("section") == 0, F.array(*headers))
        .when(F.col("section") == -1, F.array(F.lit("# exported by a tool")))
        .otherwise(F.array(F.lit(None).cast("string")))
    )
    peak = F.concat(F.col("mz"), F.lit(" "), F.col("intensity"))
    crlf = F.when(F.col("spectrum_id") % 3 == 1, "\r").otherwise("")
    return (
        rows.select("spectrum_id", "section", "mz", "intensity",
                    F.posexplode(texts).alias("line", "text"))
        .sortWithinPartitions("spectrum_id", F.greatest("section", "line"), "mz", "intensity")
        .select(F.concat(F.when(F.col("section") == 4, peak).otherwise(F.col("text")), crlf)
                .alias("value"))
    )


def write_msp(spectra: DataFrame, peaks: DataFrame, id_tag: str, path: str) -> str:
    """Write ``(spectrum_id, id, precursor, adduct)`` and peak rows as MSP files in id order.

    As found in the wild: a line ahead of the first block, some blocks with CRLF, some id lines
    indented, and some precursors that are no numbers.  Rows are shuffled once, a spectrum's and
    its peaks' to one task, and become text there.  Lines are sorted, not gathered: no task holds
    the peaks of a spectrum in memory.
    """
    tasks = dealt_tasks(peaks)
    rows = _msp_rows(spectra, peaks).repartitionByRange(*[tasks] * (tasks > 0), "spectrum_id")
    with shuffles_removed(spectra.sparkSession):
        _msp_lines(rows, id_tag).write.text(path)
    return path


def customer_spectra(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the mass of their customer as precursor, off by up to 0.0009."""
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"),
        F.col("c_name"),
        (customer_mass() + PROTON_MASS).alias("mz"),
    )
    return (
        table(spark, sf_dir, "orders")
        .join(customers, "o_custkey")
        .select(
            F.col("o_orderkey").alias("spectrum_id"),
            F.col("c_name").alias("smile"),
            F.concat(F.lit("order-"), F.expr("o_orderkey div 2")).alias("name"),
            (F.col("mz") + F.expr("o_orderkey % 10") * 0.0001).alias("precursor"),
            F.when(F.col("o_orderstatus") == "F", "-").otherwise("+").alias("ion_mode"),
            F.lit("[M+H]+").alias("adduct"),
        )
    )


def annotated_msp(spark: SparkSession, sf_dir: str) -> str:
    spectra = customer_spectra(spark, sf_dir).withColumnRenamed("smile", "id")
    peaks = order_peaks(spark, sf_dir)
    return write_msp(spectra, peaks, "smile:", shared_path(spark, "annotated-msp"))


def named_msp(spark: SparkSession, sf_dir: str, ion_mode: str | None = None) -> str:
    """All spectra, or those of one ion mode."""
    spectra = customer_spectra(spark, sf_dir).withColumnRenamed("name", "id")
    if ion_mode:
        spectra = spectra.where(F.col("ion_mode") == ion_mode)
    peaks = order_peaks(spark, sf_dir)
    return write_msp(spectra, peaks, "Name:", shared_path(spark, "named-msp"))
