"""One query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peakwise.functions import similarity
from peakwise.functions.chem import formula_mass as mass_of
from peakwise.functions.rounding import (
    PROTON_MASS,
    adduct_mz as mz_of,
    rounded_mass_key,
    truncated_mass_key,
)
from peakwise.operators import (
    embedding,
    evaluation,
    masses,
    matching,
    peak_rows,
    pooling,
    records,
)
from peakwise.plans import identify
from peakwise.session import shared_path
from peakwise.sources import msp, tables
from workload import views
from workload.views import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: Gaps between the test peaks are wide, so merging them needs a wide tolerance.
WIDE_TOLERANCE = 20.0

#: Similarity of the test fingerprints that counts as the same structure.
MATCH = 0.4


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def _r(column, digits: int = 6):
    return F.round(column, digits)


# ---------------------------------------------------------------- sources and sinks


@query
def msp_scan(spark, sf_dir):
    blocks = msp.read_blocks(spark, views.named_msp(spark, sf_dir), msp.NAMED_TAG)
    lines = F.split(F.btrim("block", F.lit(" \r\n")), "[\r\n]+")
    return blocks.select(F.get(lines, F.lit(0)).alias("id_line"), F.size(lines).alias("n_lines"))


def _parsed_rows(parsed: DataFrame, key: str) -> DataFrame:
    return parsed.select(
        key,
        _r("precursor").alias("precursor"),
        "adduct",
        F.posexplode_outer("peaks").alias("pos", "peak"),
    ).select(
        key,
        "precursor",
        "adduct",
        "pos",
        _r("peak.mz").alias("mz"),
        F.col("peak.intensity").alias("intensity"),
    )


@query
def block_numbers(spark, sf_dir):
    blocks = msp.read_blocks(spark, views.named_msp(spark, sf_dir), msp.NAMED_TAG)
    blocks = tables.write_table(blocks, shared_path(spark, "blocks"))
    numbered = msp.number_blocks(blocks, across_files=True)
    name = F.regexp_extract("block", r"Name: (\S+)", 1).alias("spectrum_id")
    return numbered.select(name, "number")


@query
def msp_parse_annotated(spark, sf_dir):
    parsed = msp.read_annotated(spark, views.annotated_msp(spark, sf_dir))
    return _parsed_rows(parsed, "smile")


@query
def msp_parse_named(spark, sf_dir):
    parsed = msp.read_named(spark, views.named_msp(spark, sf_dir))
    return _parsed_rows(parsed, "spectrum_id")


@query
def library_scan(spark, sf_dir):
    path = shared_path(spark, "library")
    views.vector_library(spark, sf_dir).select(
        F.col("smile").alias("smiles"),
        F.col("embedding").alias("cls_embedding"),
        "inchikey",
        "precursor_mz",
    ).write.parquet(path)
    library = tables.read_library(spark, path, tables.CHEMBERTA_COLUMNS, keep=("precursor_mz",))
    return library.select(
        "smile",
        "inchikey",
        _r("precursor_mz").alias("precursor_mz"),
        F.size("embedding").alias("width"),
        _r(similarity.norm(F.col("embedding"))).alias("norm"),
    )


def _feature_text(features: DataFrame, key: str = "spectrum_id") -> DataFrame:
    return features.select(
        key,
        _r("precursor").alias("precursor"),
        F.array_join(F.col("bins").cast("array<string>"), ",").alias("bins"),
        "len_frag",
    )


def _named_features(spark, sf_dir) -> DataFrame:
    spectra = msp.read_named(spark, views.named_msp(spark, sf_dir))
    return identify.features_unannotated(spectra)


@query
def features_write(spark, sf_dir):
    written = tables.write_table(
        _named_features(spark, sf_dir), shared_path(spark, "features")
    )
    return _feature_text(written)


@query
def results_csv(spark, sf_dir):
    path = shared_path(spark, "results")
    wide = matching.wide_unannotated(_vector_top(spark, sf_dir, 60), 60)
    tables.write_results_csv(wide, path)
    back = spark.read.option("header", True).option("inferSchema", False).csv(path)
    missing = sum((F.when(F.col(c) == "NA", 1).otherwise(0) for c in back.columns), F.lit(0))
    return back.select(
        F.col("Unique_ID").cast("bigint").alias("Unique_ID"),
        _r(F.col("Top_1_cosine").try_cast("double")).alias("Top_1_cosine"),
        "Top_5_SMILE",
        "Top_60_InChIKey",
        missing.alias("n_missing"),
    )


def _vector_summary(predictions: DataFrame, *columns: str) -> DataFrame:
    """A prediction as its width and two sums, one of which depends on the order."""
    value = F.transform("embedding", lambda x: x.cast("double"))
    weighted = F.transform(value, lambda x, i: x * (i + 1))
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda t, x: t + x)
    return predictions.select(
        *columns,
        F.size("embedding").alias("width"),
        _r(total(value), 3).alias("total"),
        _r(total(weighted), 3).alias("weighted"),
    )


def _embedded(spark, sf_dir, features: DataFrame) -> DataFrame:
    return embedding.embed_spectra(
        features, views.vector_model(spark, sf_dir), n_bins=views.N_BINS, dense=False
    )


@query
def predictions_checkpoint(spark, sf_dir):
    predictions = tables.write_table(
        _embedded(spark, sf_dir, _row_features(spark, sf_dir)).drop("bins"),
        shared_path(spark, "predictions"),
    )
    return _vector_summary(predictions, "spectrum_id", "len_frag")


@query
def predictions_resumed(spark, sf_dir):
    """Predictions in parts, read back by a second run whose model cannot be loaded."""
    features = tables.write_table(
        _row_features(spark, sf_dir), shared_path(spark, "features")
    )
    path = shared_path(spark, "predictions")
    settings = identify.Settings(parts=4)
    model = {"dense": False, "model_key": "vectors"}
    load = views.vector_model(spark, sf_dir)
    identify.predict(features, load, path, settings, **model)
    again = identify.predict(features, views.unloadable, path, settings, **model)
    return _vector_summary(again, "spectrum_id", "len_frag")


def _both_modes(spark, sf_dir) -> DataFrame:
    return msp.union_ion_modes(
        msp.read_named(spark, views.named_msp(spark, sf_dir, "+")),
        msp.read_named(spark, views.named_msp(spark, sf_dir, "-")),
    )


@query
def ion_mode_route(spark, sf_dir):
    return _both_modes(spark, sf_dir).select(
        "spectrum_id",
        "ion_mode",
        _r("precursor").alias("precursor"),
        F.size("peaks").alias("n_peaks"),
    )


# ---------------------------------------------------------------- peaks


def _windowed(spark, sf_dir) -> DataFrame:
    return peak_rows.precursor_window(views.peak_rows(spark, sf_dir))


def _scaled(spark, sf_dir) -> DataFrame:
    return peak_rows.base_peak_scale(_windowed(spark, sf_dir), "spectrum_id")


def _cleaned(spark, sf_dir) -> DataFrame:
    return peak_rows.clean(views.peak_rows(spark, sf_dir), "spectrum_id")


def _kept(spark, sf_dir) -> DataFrame:
    """Surviving peaks.  Total-ion scaling moves no peak, so features do without it."""
    return peak_rows.intensity_threshold(_scaled(spark, sf_dir)).drop("base_pct")


def _merged(spark, sf_dir) -> DataFrame:
    return peak_rows.merge_peaks(_kept(spark, sf_dir), "spectrum_id", carry=("precursor",))


def _peak_values(rows: DataFrame) -> DataFrame:
    return rows.select(
        "spectrum_id", _r("mz").alias("mz"), _r("intensity").alias("intensity")
    )


@query
def precursor_window(spark, sf_dir):
    return _peak_values(_windowed(spark, sf_dir))


@query
def drop_empty(spark, sf_dir):
    return peak_rows.remaining_spectra(_windowed(spark, sf_dir), "spectrum_id")


@query
def base_peak_scale(spark, sf_dir):
    return _peak_values(_scaled(spark, sf_dir))


@query
def intensity_threshold(spark, sf_dir):
    return _peak_values(_kept(spark, sf_dir))


@query
def total_ion_scale(spark, sf_dir):
    return _peak_values(_cleaned(spark, sf_dir))


@query
def peak_group(spark, sf_dir):
    merged = peak_rows.merge_peaks(_cleaned(spark, sf_dir), "spectrum_id", WIDE_TOLERANCE)
    return merged.select(
        "spectrum_id", "mz", _r("intensity").alias("intensity"), "n_merged"
    )


@query
def precursor_cutoff(spark, sf_dir):
    kept = records.precursor_cutoff(_merged(spark, sf_dir))
    return kept.select("spectrum_id", _r("precursor").alias("precursor"), "mz")


@query
def unzip_peaks(spark, sf_dir):
    spectra = records.clean(msp.read_named(spark, views.named_msp(spark, sf_dir)))
    return (
        records.unzip_peaks(spectra)
        .select("spectrum_id", "mz", F.posexplode("ints").alias("pos", "ints"))
        .select(
            "spectrum_id",
            "pos",
            _r(F.get("mz", F.col("pos"))).alias("mz"),
            _r("ints").alias("ints"),
        )
    )


def _values(spark, sf_dir) -> DataFrame:
    kept = records.precursor_cutoff(_merged(spark, sf_dir))
    return peak_rows.with_neutral_losses(kept, "spectrum_id")


@query
def neutral_loss(spark, sf_dir):
    loss = F.when(F.col("kind") == 1, F.col("value"))
    return _values(spark, sf_dir).select("spectrum_id", loss.alias("loss")).where(
        F.col("loss").isNotNull()
    )


@query
def mz_plus_loss(spark, sf_dir):
    return _values(spark, sf_dir)


@query
def spectrum_bins(spark, sf_dir):
    from peakwise.functions.binning import bin_index

    return _values(spark, sf_dir).select(
        "spectrum_id",
        "kind",
        bin_index(F.col("value"), records.RESOLUTION, records.MAX_MZ).alias("bin"),
    )


@query
def sparse_encode(spark, sf_dir):
    return peak_rows.bin_rows(_values(spark, sf_dir), "spectrum_id")


def _row_features(spark, sf_dir) -> DataFrame:
    return peak_rows.encode(_kept(spark, sf_dir), "spectrum_id")


@query
def len_frag(spark, sf_dir):
    return _row_features(spark, sf_dir).select("spectrum_id", "len_frag")


@query
def feature_project(spark, sf_dir):
    return _feature_text(_row_features(spark, sf_dir))


# ---------------------------------------------------------------- pooling


@query
def pool_by_structure(spark, sf_dir):
    pooled = pooling.pool_by_structure(
        views.orders_as_spectra(spark, sf_dir), views.order_peaks(spark, sf_dir)
    )
    return pooled.select(
        "structure_key",
        "smile",
        _r("precursor").alias("precursor"),
        "ordinal",
        "pos",
        _r("mz").alias("mz"),
        "intensity",
    )


def _first(spark, sf_dir) -> DataFrame:
    return pooling.first_per_key(
        views.orders_as_spectra(spark, sf_dir), "structure_key", ("smile", "precursor")
    )


@query
def first_per_key(spark, sf_dir):
    return _first(spark, sf_dir).withColumn("precursor", _r("precursor"))


@query
def dedupe_by_id(spark, sf_dir):
    spectra = views.orders_as_spectra(spark, sf_dir).select(
        F.col("structure_key").alias("spectrum_id"),
        "ordinal",
        "smile",
        _r("precursor").alias("precursor"),
    )
    return pooling.dedupe_by_id(spectra)


@query
def dedupe_by_smile(spark, sf_dir):
    return pooling.dedupe_by_smile(_first(spark, sf_dir)).withColumn("precursor", _r("precursor"))


# ---------------------------------------------------------------- masses and joins


def _part_masses(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", "p_retailprice", "p_size")


@query
def adduct_mz(spark, sf_dir):
    mass = F.col("p_retailprice")
    return _part_masses(spark, sf_dir).select(
        "p_partkey",
        _r(mz_of(mass, "+")).alias("mz_positive"),
        _r(mz_of(mass, "-")).alias("mz_negative"),
    )


@query
def mass_key_rounded(spark, sf_dir):
    key = rounded_mass_key(mz_of(F.col("p_retailprice"), "+"))
    return _part_masses(spark, sf_dir).select("p_partkey", key.alias("mass_key"))


@query
def mass_key_truncated(spark, sf_dir):
    precursor = F.col("p_retailprice") + F.lit(1.0075) + F.col("p_size") * 0.0001
    return _part_masses(spark, sf_dir).select(
        "p_partkey", truncated_mass_key(precursor).alias("mass_key")
    )


def _part_library(spark, sf_dir) -> DataFrame:
    """Parts as molecules; those of a size divisible by ten have no mass."""
    library = _part_masses(spark, sf_dir).select(
        F.col("p_partkey").alias("library_id"),
        F.concat(F.lit("P"), F.col("p_partkey")).alias("smile"),
        F.when(F.col("p_size") % 10 != 0, F.col("p_retailprice")).alias("exact_mass"),
    )
    return masses.with_library_key(library, "+")


def _part_queries(spark, sf_dir) -> DataFrame:
    """Parts as measured precursors, some far enough off to lose their match."""
    off = F.col("p_partkey") % 11 * 0.0001
    queries = _part_masses(spark, sf_dir).select(
        F.col("p_partkey").alias("spectrum_id"),
        (F.col("p_retailprice") + PROTON_MASS + off).alias("precursor"),
    )
    return masses.with_measured_mass_key(queries)


@query
def null_mass_skip(spark, sf_dir):
    """Every molecule of the library and the number of queries it can answer."""
    library = _part_library(spark, sf_dir)
    per_mass = _part_queries(spark, sf_dir).groupBy("mass_key").agg(
        F.count(F.lit(1)).alias("n")
    )
    per_mass = tables.write_table(per_mass, shared_path(spark, "queries-per-mass"))
    return library.join(per_mass, "mass_key", "left").select(
        "library_id", "mass_key", F.coalesce("n", F.lit(0)).alias("n_queries")
    )


@query
def formula_mass(spark, sf_dir):
    formula = F.concat(
        F.lit("C"), F.col("p_size"), F.lit("H"), F.col("p_partkey") % 60 + 1, F.lit("NO2Cl")
    )
    return table(spark, sf_dir, "part").select(
        "p_partkey", formula.alias("formula"), _r(mass_of(formula)).alias("exact_mass")
    )


@query
def attach_properties(spark, sf_dir):
    """Orders against customers; some order structures are unknown."""
    spectra = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("spectrum_id"),
        F.concat(
            F.lit("Customer#"), F.lpad((F.col("o_custkey") + 100).cast("string"), 9, "0")
        ).alias("smile"),
    )
    molecules = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("smile"),
        F.upper(F.md5("c_name")).alias("inchikey"),
        views.customer_mass().alias("exact_mass"),
    )
    return masses.attach_properties(spectra, molecules, "exact_mass")


@query
def candidates(spark, sf_dir):
    return matching.match_candidates(
        _part_queries(spark, sf_dir).select("spectrum_id", "mass_key"),
        _part_library(spark, sf_dir),
    )


@query
def unmatched_queries(spark, sf_dir):
    return matching.unmatched_queries(
        _part_queries(spark, sf_dir).select("spectrum_id", "mass_key"),
        _part_library(spark, sf_dir),
    )


# ---------------------------------------------------------------- similarity


def _neighbours(spark, sf_dir) -> DataFrame:
    """Each vector next to the one with the following id."""
    vectors = table(spark, sf_dir, "embeddings")
    following = vectors.select(
        (F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other")
    )
    return vectors.join(following, "vec_id")


def _neighbour_tanimoto(spark, sf_dir) -> DataFrame:
    pairs = _neighbours(spark, sf_dir)
    a, b = views.on_bits(F.col("embedding")), views.on_bits(F.col("other"))
    return pairs.select("vec_id", similarity.tanimoto(a, b).alias("tanimoto"))


@query
def cosine(spark, sf_dir):
    value = similarity.cosine(F.col("embedding"), F.col("other"))
    return _neighbours(spark, sf_dir).select("vec_id", _r(value).alias("cosine"))


@query
def tanimoto(spark, sf_dir):
    return _neighbour_tanimoto(spark, sf_dir).withColumn("tanimoto", _r("tanimoto"))


@query
def structure_match(spark, sf_dir):
    match = similarity.same_structure(F.col("tanimoto"), MATCH)
    return _neighbour_tanimoto(spark, sf_dir).select("vec_id", match.alias("same_structure"))


# ---------------------------------------------------------------- ranking


def _vector_top(spark, sf_dir, n: int, **columns) -> DataFrame:
    return matching.top_candidates(
        views.vector_queries(spark, sf_dir), views.vector_library(spark, sf_dir), n, **columns
    )


def _ranked_columns(ranked: DataFrame) -> DataFrame:
    return ranked.select(
        "spectrum_id", "rank", "smile", "n_candidates", _r("cosine").alias("cosine")
    )


@query
def topn_candidates(spark, sf_dir):
    return _ranked_columns(_vector_top(spark, sf_dir, 5))


@query
def topn_laid_out(spark, sf_dir):
    """The same from a library laid out by mass, in slots of few rows."""
    path = shared_path(spark, "library")
    matching.write_by_mass(views.vector_library(spark, sf_dir), path, tile_rows=64)
    return _ranked_columns(
        matching.top_of_laid_out(views.vector_queries(spark, sf_dir), path, 5)
    )


def _vector_ranked(spark, sf_dir) -> DataFrame:
    """Top five with the similarity to the true structure."""
    ranked = _vector_top(
        spark,
        sf_dir,
        5,
        query_columns=("ground_fp",),
        library_columns=("smile", "inchikey", "precursor_mz", "fp_bits"),
    )
    return evaluation.with_tanimoto(ranked)


def _rounded(ranked: DataFrame, *columns: str) -> DataFrame:
    return ranked.withColumns({c: _r(c) for c in columns})


@query
def wide_annotated(spark, sf_dir):
    ranked = _rounded(_vector_ranked(spark, sf_dir), "cosine", "tanimoto")
    return matching.wide_annotated(ranked)


@query
def wide_unannotated(spark, sf_dir):
    return matching.wide_unannotated(_rounded(_vector_top(spark, sf_dir, 5), "cosine"))


def _hits(spark, sf_dir) -> DataFrame:
    return evaluation.first_hit_rank(_vector_ranked(spark, sf_dir), MATCH)


@query
def first_hit_rank(spark, sf_dir):
    return _hits(spark, sf_dir)


@query
def hit_histogram(spark, sf_dir):
    return evaluation.hit_histogram(_hits(spark, sf_dir)).select("bucket", "n_queries")


@query
def candidate_counts(spark, sf_dir):
    return evaluation.hit_histogram(_hits(spark, sf_dir)).drop("n_queries")


def _accuracy(accuracy: DataFrame) -> DataFrame:
    return _rounded(accuracy, "pct", "cumulative_pct")


@query
def topk_accuracy(spark, sf_dir):
    queries = views.vector_queries(spark, sf_dir)
    return _accuracy(evaluation.topk_accuracy(queries, _hits(spark, sf_dir)))


@query
def hit_detail(spark, sf_dir):
    ranked = tables.write_table(_vector_ranked(spark, sf_dir), shared_path(spark, "ranked"))
    detail = evaluation.hit_detail(ranked, evaluation.first_hit_rank(ranked, MATCH))
    return _rounded(detail, "tanimoto", "cosine", "precursor_mz")


# ---------------------------------------------------------------- embedding


@query
def embed_spectra(spark, sf_dir):
    return _vector_summary(
        _embedded(spark, sf_dir, _row_features(spark, sf_dir)), "spectrum_id", "len_frag"
    )


@query
def sparse_linear(spark, sf_dir):
    weights = tables.write_table(views.weights(spark, sf_dir), shared_path(spark, "weights"))
    features = _row_features(spark, sf_dir).select("spectrum_id", "bins")
    bias = [0.25 * (d % 4) for d in range(views.WIDTH)]
    activations = embedding.sparse_linear(features, weights, views.WIDTH, bias=bias)
    layer = activations.select(
        "spectrum_id", F.col("activation").cast("array<float>").alias("embedding")
    )
    return _vector_summary(layer, "spectrum_id")


@query
def embed_by_mode(spark, sf_dir):
    mode = F.when(F.col("spectrum_id") % 2 == 0, "+").otherwise("-")
    features = tables.write_table(
        _row_features(spark, sf_dir).withColumn("ion_mode", mode), shared_path(spark, "features")
    )
    loaders = {m: views.vector_model(spark, sf_dir, m == "-") for m in "+-"}
    embedded = embedding.embed_by_mode(features, loaders, n_bins=views.N_BINS, dense=False)
    return _vector_summary(embedded, "spectrum_id", "ion_mode")


# ---------------------------------------------------------------- whole jobs


def _molecule_table(spark, sf_dir) -> DataFrame:
    """The library as a file, the way it is handed to a job."""
    return tables.write_table(
        views.customers_as_molecules(spark, sf_dir), shared_path(spark, "library")
    )


@query
def identify_annotated(spark, sf_dir):
    molecules = _molecule_table(spark, sf_dir)
    ranked = identify.identify_annotated(
        msp.read_annotated(spark, views.annotated_msp(spark, sf_dir)),
        molecules.select("smile", "inchikey", "exact_mass", "fp_bits"),
        molecules,
        views.vector_model(spark, sf_dir),
        shared_path(spark, "predictions"),
        dense=False,
    )
    return matching.wide_annotated(_rounded(ranked, "cosine", "tanimoto"))


@query
def identify_unannotated(spark, sf_dir):
    ranked = identify.identify_unannotated(
        msp.read_named(spark, views.named_msp(spark, sf_dir)),
        _molecule_table(spark, sf_dir),
        views.vector_model(spark, sf_dir),
        shared_path(spark, "predictions"),
        dense=False,
    )
    return matching.wide_unannotated(_rounded(ranked, "cosine"))


@query
def identify_laid_out(spark, sf_dir):
    """The same against a library laid out by mass."""
    path = shared_path(spark, "library")
    keyed = masses.with_library_key(_molecule_table(spark, sf_dir), "+")
    matching.write_by_mass(keyed, path)
    ranked = identify.identify_unannotated(
        msp.read_named(spark, views.named_msp(spark, sf_dir)),
        path,
        views.vector_model(spark, sf_dir),
        shared_path(spark, "predictions"),
        dense=False,
    )
    return matching.wide_unannotated(_rounded(ranked, "cosine"))


def _retrieval(spark, sf_dir) -> identify.Retrieval:
    molecules = _molecule_table(spark, sf_dir)
    return identify.evaluate_retrieval(
        msp.read_annotated(spark, views.annotated_msp(spark, sf_dir)),
        molecules.select("smile", "inchikey", "exact_mass", "fp_bits"),
        molecules,
        views.vector_model(spark, sf_dir),
        shared_path(spark, "evaluation"),
        dense=False,
    )


@query
def evaluate_retrieval(spark, sf_dir):
    return _accuracy(_retrieval(spark, sf_dir).accuracy)


@query
def retrieval_histogram(spark, sf_dir):
    return _retrieval(spark, sf_dir).histogram


@query
def retrieval_detail(spark, sf_dir):
    return _rounded(_retrieval(spark, sf_dir).detail, "tanimoto", "cosine", "precursor_mz")


@query
def evaluate_models(spark, sf_dir):
    """Two models over shared features; the second returns the opposite vectors."""
    molecules = _molecule_table(spark, sf_dir)
    models = {
        name: identify.Model(
            views.vector_model(spark, sf_dir, name == "opposite"), molecules, {"dense": False}
        )
        for name in ("vectors", "opposite")
    }
    retrieval = identify.evaluate_models(
        msp.read_annotated(spark, views.annotated_msp(spark, sf_dir)),
        molecules.select("smile", "inchikey", "exact_mass", "fp_bits"),
        models,
        shared_path(spark, "evaluation"),
    )
    return _accuracy(retrieval.accuracy)


@query
def identify_by_mode(spark, sf_dir):
    """Both ion modes in one job; the negative model returns the opposite vectors."""
    ranked = identify.identify_by_mode(
        _both_modes(spark, sf_dir),
        _molecule_table(spark, sf_dir),
        {m: views.vector_model(spark, sf_dir, m == "-") for m in "+-"},
        shared_path(spark, "predictions"),
        dense=False,
    )
    return ranked.select(
        "spectrum_id", "ion_mode", "rank", "smile", "n_candidates", _r("cosine").alias("cosine")
    )


@query
def library_formula(spark, sf_dir):
    """Parts as a library file whose masses come from a formula column."""
    path = shared_path(spark, "library")
    formula = F.concat(
        F.lit("C"), F.col("p_size"), F.lit("H"), F.col("p_partkey") % 60 + 1, F.lit("NO2Cl")
    )
    table(spark, sf_dir, "part").select(
        F.concat(F.lit("P"), F.col("p_partkey")).alias("smile"),
        F.when(F.col("p_size") % 10 != 0, formula).alias("formula"),
    ).write.parquet(path)
    library = tables.read_library(spark, path, {"smile": "smile"}, formula="formula")
    keyed = masses.with_library_key(library, "-")
    return keyed.select("smile", _r("exact_mass").alias("exact_mass"), "mass_key")
