"""Identification of annotated and unannotated spectra, and retrieval evaluation.

Each job writes what it reads twice below ``work_path``: cleaned spectra, the predictions and
the keyed queries.  The input is parsed once, in the pass that writes the cleaned spectra, and
inference runs once per spectrum.  Blocks that the parser marked as malformed take no part;
their text is written to ``rejected``.
Results come back in long form (``rank`` per candidate); :mod:`peakwise.operators.matching`
has the wide form.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peakwise.functions.binning import grid_size
from peakwise.plans import resumable
from peakwise.operators import embedding, evaluation, masses, matching, peak_rows, pooling, records
from peakwise.session import shared_path
from peakwise.sources.tables import TEXT_FACTOR, dealt_tasks, write_table


@dataclass(frozen=True)
class Settings:
    tolerance: float = records.TOLERANCE
    resolution: float = records.RESOLUTION
    max_mz: float = records.MAX_MZ
    intensity_threshold: float = records.INTENSITY_THRESHOLD
    top_n: int = 5
    #: Parts that predictions are written in.  A job run again on its ``work_path`` goes on with
    #: those that are missing; 0 writes all at once, and a job cannot be run again there.
    parts: int = 0

    @property
    def n_bins(self) -> int:
        return grid_size(self.resolution, self.max_mz)


#: Surviving spectra whose row numbers are broadcast, 8 bytes each; more are joined.
BROADCAST_ROWS = 8_000_000


def _check_inputs(spectra: DataFrame, work_path: str, settings: Settings) -> None:
    """Refuse to go on in a ``work_path`` that holds results of other files or settings."""
    if settings.parts:
        resumable.check_manifest(
            spectra.sparkSession,
            f"{work_path}/manifest",
            settings=asdict(settings),
            inputs=sorted(spectra.inputFiles()),
        )


def _malformed(spectra: DataFrame) -> Column:
    return F.col("_corrupt").isNotNull() if "_corrupt" in spectra.columns else F.lit(False)


def sound_spectra(spectra: DataFrame, work_path: str, resume: bool = False) -> DataFrame:
    """Spectra without the malformed blocks, whose text goes to ``work_path/rejected``.

    One pass over the input writes both to ``work_path/spectra``, apart by a flag, so that
    reading either skips the other's files.  ``_row`` is a number of its own for every row.
    """
    flagged = spectra.withColumns(
        {"_row": F.monotonically_increasing_id(), "_malformed": _malformed(spectra).cast("int")}
    )
    flagged = write_table(flagged, f"{work_path}/spectra", "_malformed", resume)
    if "_corrupt" in spectra.columns:
        rejected = flagged.where("_malformed = 1").select("ordinal", "_corrupt")
        write_table(rejected, f"{work_path}/rejected", resume=resume)
    return flagged.where("_malformed = 0").drop("_malformed", "_corrupt")


def _cleaned(spectra: DataFrame, settings: Settings, *columns: str) -> DataFrame:
    """Cleaned records with the named columns; malformed blocks stay, without peaks."""
    corrupt = [c for c in spectra.columns if c == "_corrupt"]
    rows = spectra.select(*columns, "precursor", "ordinal", "peaks", *corrupt)
    return records.clean(rows, settings.intensity_threshold, keep=_malformed(rows))


def cleaned_annotated(
    spectra: DataFrame, molecules: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Cleaned records with the structure key of their molecule; see :func:`sound_spectra` for
    malformed blocks, which stay."""
    tasks = dealt_tasks(spectra, TEXT_FACTOR)
    rows = _cleaned(spectra, settings, "smile")
    cleaned = masses.attach_properties(rows, molecules, tasks=tasks)
    return cleaned.where(F.col("structure_key").isNotNull() | _malformed(cleaned))


def features_annotated(cleaned: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Sparse records of pooled structures: ``structure_key, smile, precursor, bins, len_frag``.

    Reads :func:`cleaned_annotated` twice, once without peaks; pass a written table.  Peaks
    are merged per structure before the representative is joined, so what the join moves is
    bounded per structure.
    """
    first = pooling.dedupe_by_smile(
        pooling.first_per_key(cleaned, "structure_key", ("smile", "precursor"))
    )
    rows = peak_rows.explode_peaks(cleaned, "structure_key")
    merged = peak_rows.merge_peaks(rows, "structure_key", settings.tolerance)
    merged = merged.join(records.precursor_cutoff(first), "structure_key")
    keys = ("smile", "precursor")
    values = peak_rows.with_neutral_losses(merged, "structure_key", *keys)
    bins = peak_rows.bin_rows(
        values, "structure_key", *keys, resolution=settings.resolution, max_mz=settings.max_mz
    )
    return peak_rows.collect_bins(bins, "structure_key", *keys)


def first_features(cleaned: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Sparse records of the first spectrum per id, from :func:`sound_spectra`.

    Which rows are the first is found without peaks; only those rows' peaks are encoded, where
    they lie unless the row numbers are too many to broadcast.
    """
    heads = cleaned.select("spectrum_id", "precursor", "ordinal", "_row")
    first = pooling.first_row(heads, "spectrum_id", "ordinal", "_row")
    first = records.precursor_cutoff(first).select("_row")
    first = write_table(first, shared_path(cleaned.sparkSession, "first-rows"))
    if first.count() <= BROADCAST_ROWS:
        first = F.broadcast(first)
    encoded = records.encode(
        cleaned.join(first, "_row", "left_semi"),
        settings.tolerance,
        settings.resolution,
        settings.max_mz,
    )
    return encoded.select("spectrum_id", "precursor", "mz", "ints", "bins", "len_frag")


def features_unannotated(
    spectra: DataFrame, settings: Settings = Settings(), work_path: str | None = None
) -> DataFrame:
    """Sparse records of the first spectrum per id; malformed blocks take no part.

    Cleaned spectra are written below ``work_path``, or below the session's shared folder, when
    this is called.
    """
    path = work_path or shared_path(spectra.sparkSession, "unannotated")
    cleaned = _cleaned(spectra, settings, "spectrum_id")
    return first_features(sound_spectra(cleaned, path, settings.parts > 0), settings)


def predict(
    features: DataFrame, load: Callable, work_path: str, settings: Settings, **model: object
) -> DataFrame:
    """Embed and write predictions; the bins stay behind.

    In ``settings.parts`` parts, what is finished depends on the settings, on ``model_key`` and
    on the input files as far as ``features`` shows them.
    """
    drop = [c for c in ("bins", "mz", "ints") if c in features.columns]

    def embed(rows: DataFrame) -> DataFrame:
        return embedding.embed_spectra(rows, load, n_bins=settings.n_bins, **model).drop(*drop)

    if not settings.parts:
        return write_table(embed(features), work_path)
    facts = {"settings": asdict(settings), "model": model.get("model_key")}
    return resumable.predict_in_parts(features, embed, work_path, settings.parts, **facts)


def predict_annotated(
    spectra: DataFrame,
    molecules: DataFrame,
    load: Callable,
    work_path: str,
    settings: Settings,
    **model: object,
) -> DataFrame:
    """Clean, pool, encode and embed; cleaned spectra and predictions are written."""
    _check_inputs(spectra, work_path, settings)
    cleaned = cleaned_annotated(spectra, molecules, settings)
    cleaned = sound_spectra(cleaned, work_path, settings.parts > 0)
    features = features_annotated(cleaned, settings)
    return predict(features, load, f"{work_path}/predictions", settings, **model)


def identify_annotated(
    spectra: DataFrame,
    molecules: DataFrame,
    library: DataFrame,
    load: Callable,
    work_path: str,
    ion_mode: str = "+",
    settings: Settings = Settings(),
    **model: object,
) -> DataFrame:
    """Ranked candidates of pooled annotated spectra with ``tanimoto`` to the true structure.

    ``molecules`` is ``(smile, inchikey, exact_mass, fp_bits)`` and ``library`` is
    ``(library_id, smile, inchikey, exact_mass, fp_bits, embedding)``.  A structure is
    identified by its ``smile``.
    """
    predictions = predict_annotated(spectra, molecules, load, work_path, settings, **model)
    queries = annotated_queries(predictions, molecules, ion_mode)
    queries = write_table(queries, f"{work_path}/queries", resume=settings.parts > 0)
    keyed = masses.with_library_key(library, ion_mode)
    ranked = matching.top_candidates(
        queries,
        keyed,
        settings.top_n,
        library_columns=("smile", "inchikey", "precursor_mz", "fp_bits"),
    )
    truth = queries.select("spectrum_id", F.col("fp_bits").alias("ground_fp"))
    return evaluation.with_tanimoto(ranked.join(truth, "spectrum_id"))


def annotated_queries(predictions: DataFrame, molecules: DataFrame, ion_mode: str) -> DataFrame:
    """Predictions keyed by the mass of their known structure; ``smile`` is the query id."""
    known = masses.attach_properties(
        predictions.drop("structure_key"), molecules, "exact_mass", "fp_bits"
    )
    return masses.with_structure_mass_key(known, ion_mode).withColumnRenamed(
        "smile", "spectrum_id"
    )


def identify_by_mode(
    spectra: DataFrame,
    library: DataFrame,
    loaders: dict[str, Callable],
    work_path: str,
    settings: Settings = Settings(),
    key_mode: str = "truncate",
    **model: object,
) -> DataFrame:
    """Unannotated spectra of both ion modes in one job, each with its mode's model and masses.

    ``spectra`` come from :func:`peakwise.sources.msp.union_ion_modes`, ``loaders`` are by
    mode.  The result has ``ion_mode``.  A mode's ranking is written, below the session's shared
    folder, before the next mode's turn: the shuffles of one mode lie on disk at a time.
    """
    ranked = []
    for mode, load in loaders.items():
        best = identify_unannotated(
            spectra.where(F.col("ion_mode") == mode),
            library,
            load,
            f"{work_path}/{'positive' if mode == '+' else 'negative'}",
            mode,
            settings,
            key_mode,
            **model,
        )
        best = write_table(best, shared_path(spectra.sparkSession, "ranked"))
        ranked.append(best.withColumn("ion_mode", F.lit(mode)))
    return reduce(DataFrame.unionByName, ranked)


def identify_unannotated(
    spectra: DataFrame,
    library: DataFrame | str,
    load: Callable,
    work_path: str,
    ion_mode: str = "+",
    settings: Settings = Settings(),
    key_mode: str = "truncate",
    **model: object,
) -> DataFrame:
    """Ranked candidates of unannotated spectra.

    ``library`` is a frame, or the path of one that :func:`peakwise.operators.matching.write_by_mass`
    laid out with the keys of the ion mode; jobs that share one then move queries only.
    """
    _check_inputs(spectra, work_path, settings)
    predictions = predict(
        features_unannotated(spectra, settings, work_path),
        load,
        f"{work_path}/predictions",
        settings,
        **model,
    )
    queries = masses.with_measured_mass_key(predictions, key_mode)
    if isinstance(library, str):
        return matching.top_of_laid_out(queries, library, settings.top_n)
    keyed = masses.with_library_key(library, ion_mode)
    return matching.top_candidates(queries, keyed, settings.top_n)


@dataclass(frozen=True)
class Retrieval:
    """What an evaluation reports."""

    ranked: DataFrame
    hits: DataFrame
    accuracy: DataFrame
    histogram: DataFrame
    detail: DataFrame


def evaluate_retrieval(
    spectra: DataFrame,
    molecules: DataFrame,
    library: DataFrame,
    load: Callable,
    work_path: str,
    settings: Settings = Settings(),
    threshold: float = evaluation.MATCH_THRESHOLD,
    **model: object,
) -> Retrieval:
    """Top-1 to top-5 accuracy of annotated spectra, masses always in positive mode."""
    predictions = predict_annotated(spectra, molecules, load, work_path, settings, **model)
    queries = annotated_queries(predictions, molecules, "+")
    queries = write_table(queries, f"{work_path}/queries", resume=settings.parts > 0)
    keyed = masses.with_library_key(library, "+")
    ranked = matching.top_candidates(
        queries,
        keyed,
        evaluation.MAX_RANK,
        library_columns=("smile", "inchikey", "precursor_mz", "fp_bits"),
    )
    truth = queries.select("spectrum_id", F.col("fp_bits").alias("ground_fp"))
    ranked = evaluation.with_tanimoto(ranked.join(truth, "spectrum_id"))
    ranked = write_table(ranked, f"{work_path}/ranked", resume=settings.parts > 0)
    hits = evaluation.first_hit_rank(ranked, threshold)
    return Retrieval(
        ranked=ranked,
        hits=hits,
        accuracy=evaluation.topk_accuracy(queries, hits),
        histogram=evaluation.hit_histogram(hits),
        detail=evaluation.hit_detail(ranked, hits),
    )


@dataclass(frozen=True)
class Model:
    """A network and the library that its embeddings are compared with."""

    load: Callable
    library: DataFrame
    options: Mapping[str, object] = field(default_factory=dict)


def evaluate_models(
    spectra: DataFrame,
    molecules: DataFrame,
    models: Mapping[str, Model],
    work_path: str,
    settings: Settings = Settings(),
    threshold: float = evaluation.MATCH_THRESHOLD,
) -> Retrieval:
    """:func:`evaluate_retrieval` of several models, every result with a column ``model``.

    Spectra are parsed, cleaned and encoded once, and their true structures and mass keys are
    looked up once; each model then embeds the written features and ranks its own library, whose
    best are written before the next model's turn: the shuffles of one model lie on disk at a time.
    """
    by = ("model",)
    resume = settings.parts > 0
    _check_inputs(spectra, work_path, settings)
    cleaned = sound_spectra(cleaned_annotated(spectra, molecules, settings), work_path, resume)
    features = features_annotated(cleaned, settings)
    features = write_table(features, f"{work_path}/features", resume=resume)
    truth = annotated_queries(features.select("smile", "precursor"), molecules, "+")
    truth = write_table(truth, f"{work_path}/truth", resume=resume)
    parts = []
    for number, (name, model) in enumerate(models.items()):
        path = f"{work_path}/predictions-{number}"
        predictions = predict(features, model.load, path, settings, **model.options)
        embedded = predictions.select(F.col("smile").alias("spectrum_id"), "embedding")
        ranked = matching.top_candidates(
            embedded.join(truth.select("spectrum_id", "mass_key"), "spectrum_id"),
            masses.with_library_key(model.library, "+"),
            evaluation.MAX_RANK,
            library_columns=("smile", "inchikey", "precursor_mz", "fp_bits"),
        )
        ranked = write_table(ranked, f"{work_path}/ranked-{number}", resume=resume)
        parts.append(ranked.withColumn("model", F.lit(name)))
    known = truth.select("spectrum_id", F.col("fp_bits").alias("ground_fp"))
    ranked = evaluation.with_tanimoto(reduce(DataFrame.unionByName, parts).join(known, "spectrum_id"))
    ranked = write_table(ranked, f"{work_path}/ranked", "model", resume)
    names = F.explode(F.array(*[F.lit(name) for name in models]))
    queries = truth.select("spectrum_id", names.alias("model"))
    hits = evaluation.first_hit_rank(ranked, threshold, by)
    return Retrieval(
        ranked=ranked,
        hits=hits,
        accuracy=evaluation.topk_accuracy(queries, hits, by),
        histogram=evaluation.hit_histogram(hits, by),
        detail=evaluation.hit_detail(ranked, hits, by),
    )
