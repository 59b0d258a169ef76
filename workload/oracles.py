"""The SQL counterpart of each query, for DuckDB."""

from __future__ import annotations

# Common table expressions, each with the ones it needs.
_CTE: dict[str, tuple[tuple[str, ...], str]] = {
    "rows_": (
        (),
        """SELECT o_orderkey AS spectrum_id, o_totalprice / 400 AS precursor,
                  l_extendedprice / 150 AS mz, l_quantity * l_quantity + sqrt(l_extendedprice) / 100 AS intensity
           FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
    ),
    "windowed": (("rows_",), "SELECT * FROM rows_ WHERE mz <= precursor + 0.5"),
    "scaled": (
        ("windowed",),
        """SELECT * EXCLUDE (intensity),
                  intensity / max(intensity) OVER (PARTITION BY spectrum_id) * 100 AS intensity
           FROM windowed""",
    ),
    "kept": (("scaled",), "SELECT * FROM scaled WHERE intensity / 100 * 100 >= 1"),
    "cleaned": (
        ("kept",),
        """SELECT * EXCLUDE (intensity),
                  intensity / sum(intensity) OVER (PARTITION BY spectrum_id) AS intensity
           FROM kept""",
    ),
    "first_structure": (
        (),
        """SELECT structure_key, smile, precursor FROM (
             SELECT o_custkey AS structure_key,
                    o_orderstatus || '-' || (o_custkey // 2) AS smile,
                    o_totalprice / 400 AS precursor,
                    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n
             FROM orders) WHERE n = 1""",
    ),
    "part_library": (
        (),
        """SELECT p_partkey AS library_id, 'P' || p_partkey AS smile,
                  CASE WHEN p_size % 10 <> 0
                       THEN CAST(round(round(p_retailprice + 1.007276, 3) * 1000) AS BIGINT)
                  END AS mass_key
           FROM part""",
    ),
    "part_queries": (
        (),
        """SELECT p_partkey AS spectrum_id,
                  CAST(floor(round((p_retailprice + 1.007276 + p_partkey % 11 * 0.0001) * 1000, 4))
                       AS BIGINT) AS mass_key
           FROM part""",
    ),
    "neighbours": (
        (),
        """SELECT a.vec_id, a.embedding AS a, b.embedding AS b
           FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
    ),
    "neighbour_tanimoto": (
        ("neighbours",),
        """SELECT vec_id, len(list_filter(list_zip(a, b), lambda t: t[1] > 0 AND t[2] > 0))
                  / len(list_filter(list_zip(a, b), lambda t: t[1] > 0 OR t[2] > 0)) AS tanimoto
           FROM neighbours""",
    ),
    "vector_queries": (
        (),
        """SELECT vec_id AS spectrum_id, label AS mass_key, list_reverse(embedding) AS embedding,
                  embedding AS truth
           FROM embeddings""",
    ),
    "vector_library": (
        (),
        """SELECT 'V' || vec_id AS smile, upper(md5('V' || vec_id)) AS inchikey,
                  nullif(label, 9) AS mass_key, label + 1.007276::DOUBLE AS precursor_mz, embedding
           FROM embeddings""",
    ),
    "vector_pairs": (
        ("vector_queries", "vector_library"),
        """SELECT spectrum_id, truth, smile, inchikey, precursor_mz, l.embedding AS vector,
                  list_cosine_similarity(q.embedding::DOUBLE[], l.embedding::DOUBLE[]) AS cosine,
                  count(*) OVER (PARTITION BY spectrum_id) AS n_candidates
           FROM vector_queries q JOIN vector_library l USING (mass_key)""",
    ),
    "vector_ranked": (
        ("vector_pairs",),
        """SELECT *, row_number() OVER (PARTITION BY spectrum_id
                       ORDER BY round(cosine, 12) DESC, smile) AS rank
           FROM vector_pairs""",
    ),
    "vector_top": (
        ("vector_ranked",),
        """SELECT *, len(list_filter(list_zip(truth, vector), lambda t: t[1] > 0 AND t[2] > 0))
                  / len(list_filter(list_zip(truth, vector), lambda t: t[1] > 0 OR t[2] > 0))
                  AS tanimoto
           FROM vector_ranked WHERE rank <= 5""",
    ),
    "hits": (
        ("vector_top",),
        """SELECT spectrum_id, min(CASE WHEN tanimoto >= 0.4 THEN rank END) AS hit_rank,
                  max(n_candidates) AS n_candidates
           FROM vector_top GROUP BY spectrum_id""",
    ),
    "buckets": (("hits",), "SELECT *, coalesce(hit_rank, 11) AS bucket FROM hits"),
    "weights": (
        (),
        """SELECT vec_id % n_weights AS vec_id, n_weights, dim, sum(w) AS w
           FROM (SELECT vec_id, least((SELECT count(*) FROM embeddings), 70000) AS n_weights,
                        unnest(embedding)::DOUBLE AS w, generate_subscripts(embedding, 1) AS dim
                 FROM embeddings)
           GROUP BY vec_id % n_weights, n_weights, dim""",
    ),
    # MSP records
    "spectra": (
        (),
        """SELECT o_orderkey AS ordinal, c_name AS smile, 'order-' || (o_orderkey // 2) AS name,
                  o_orderstatus AS status, c_custkey AS custkey,
                  CASE WHEN o_orderkey % 50 <> 7 THEN
                    100 + floor((c_acctbal + 1000) / 50) * 5.0 + 1.007276
                      + o_orderkey % 10 * 0.0001 END AS precursor
           FROM orders JOIN customer ON o_custkey = c_custkey""",
    ),
    "order_peaks": (
        (),
        """SELECT l_orderkey AS ordinal, l_extendedprice / 150 AS mz,
                  l_quantity * l_quantity + sqrt(l_extendedprice) / 100 AS intensity
           FROM lineitem""",
    ),
    "record_rows": (
        ("spectra", "order_peaks"),
        """SELECT s.*, mz, intensity,
                  row_number() OVER (PARTITION BY ordinal ORDER BY mz, intensity) - 1 AS pos
           FROM spectra s JOIN order_peaks USING (ordinal)
           WHERE mz <= precursor + 0.5""",
    ),
    "record_scaled": (
        ("record_rows",),
        """SELECT * EXCLUDE (intensity),
                  intensity / max(intensity) OVER (PARTITION BY ordinal) * 100 AS intensity
           FROM record_rows""",
    ),
    "record_kept": (
        ("record_scaled",),
        """SELECT * EXCLUDE (intensity, pos),
                  row_number() OVER (PARTITION BY ordinal ORDER BY pos) - 1 AS pos,
                  intensity / sum(intensity) OVER (PARTITION BY ordinal) AS intensity
           FROM record_scaled WHERE intensity >= 1""",
    ),
    "molecules": (
        (),
        """SELECT c_custkey AS custkey, c_name AS smile, upper(md5(c_name)) AS inchikey,
                  100 + floor((c_acctbal + 1000) / 50) * 5.0 AS exact_mass, embedding
           FROM customer JOIN embeddings
             ON vec_id = c_custkey % (SELECT count(*) FROM embeddings)""",
    ),
    "library": (
        ("molecules",),
        """SELECT *, CAST(round(round(exact_mass + 1.007276, 3) * 1000) AS BIGINT) AS mass_key
           FROM molecules""",
    ),
    # Annotated: pooled by structure
    "annotated_peaks": (
        ("record_kept",),
        """SELECT substr(upper(md5(smile)), 1, 14) AS id, smile, ordinal, precursor, mz, intensity
           FROM record_kept""",
    ),
    "annotated_first": (
        ("annotated_peaks",),
        """SELECT id, arg_min(smile, ordinal) AS smile, arg_min(precursor, ordinal) AS precursor
           FROM annotated_peaks GROUP BY id""",
    ),
    "annotated_source": (
        ("annotated_peaks", "annotated_first"),
        """SELECT id, f.precursor, p.mz, p.intensity
           FROM annotated_peaks p JOIN annotated_first f USING (id)""",
    ),
    # Unannotated: first record per name
    "named_first": (
        ("record_kept",),
        "SELECT name, min(ordinal) AS ordinal FROM record_kept GROUP BY name",
    ),
    "named_source": (
        ("record_kept", "named_first"),
        """SELECT name AS id, precursor, mz, intensity
           FROM record_kept JOIN named_first USING (name, ordinal)""",
    ),
    "named_positive_source": (
        ("record_kept",),
        """SELECT name AS id, precursor, mz, intensity FROM record_kept
           WHERE status <> 'F' AND (name, ordinal) IN (
             SELECT (name, min(ordinal)) FROM record_kept WHERE status <> 'F' GROUP BY name)""",
    ),
    "named_negative_source": (
        ("record_kept",),
        """SELECT name AS id, precursor, mz, intensity FROM record_kept
           WHERE status = 'F' AND (name, ordinal) IN (
             SELECT (name, min(ordinal)) FROM record_kept WHERE status = 'F' GROUP BY name)""",
    ),
    "row_source": (
        ("cleaned",),
        "SELECT spectrum_id AS id, precursor, mz, intensity FROM cleaned",
    ),
}


def _feature_ctes(source: str, tolerance: float = 0.01) -> dict[str, tuple[tuple[str, ...], str]]:
    """Merging, neutral losses, bins and embeddings over one source of cleaned peaks."""
    return {
        "flagged": (
            (source,),
            f"""SELECT *, CASE WHEN mz - lag(mz) OVER (PARTITION BY id ORDER BY mz)
                              <= {tolerance} THEN 0 ELSE 1 END AS is_new
                FROM {source}""",
        ),
        "chained": (
            ("flagged",),
            """SELECT *, sum(is_new) OVER (PARTITION BY id ORDER BY mz
                           ROWS UNBOUNDED PRECEDING) AS chain
               FROM flagged""",
        ),
        "merged": (
            ("chained",),
            """SELECT id, precursor, chain, sum(intensity) AS intensity, count(*) AS n_merged,
                      round_even(round_even(sum(mz::VARCHAR::DECIMAL(28, 16))::DOUBLE
                        / count(*) * 1000, 0) / 1000 * 100, 0) / 100 AS mz
               FROM chained GROUP BY id, precursor, chain""",
        ),
        "light": (("merged",), "SELECT * FROM merged WHERE precursor <= 1000"),
        "valued": (
            ("light",),
            """SELECT id, precursor, 0 AS kind, mz AS value FROM light
               UNION ALL
               SELECT id, precursor, 1,
                      round_even((round_even(precursor * 1000, 0) / 1000 + 0.5
                        - round_even(mz * 1000, 0) / 1000) * 1000, 0) / 1000
               FROM light""",
        ),
        "binned": (
            ("valued",),
            """SELECT *, least(greatest(
                      CASE WHEN (ceil(value / 0.01) - 1) * 0.01::DOUBLE >= value
                             THEN ceil(value / 0.01) - 1
                           WHEN ceil(value / 0.01) * 0.01::DOUBLE < value
                             THEN ceil(value / 0.01) + 1
                           ELSE ceil(value / 0.01) END, 0), 69999)::INTEGER AS bin
               FROM valued""",
        ),
        "bins": (("binned",), "SELECT DISTINCT id, precursor, bin FROM binned"),
        "features": (
            ("bins",),
            """SELECT id, precursor, string_agg(bin, ',' ORDER BY bin) AS bins,
                      count(*)::INTEGER AS len_frag
               FROM bins GROUP BY id, precursor""",
        ),
        "activations": (
            ("bins", "weights"),
            """SELECT id, precursor, dim, greatest(sum(w), 0)::FLOAT AS value,
                      count(*)::INTEGER AS len_frag
               FROM bins JOIN weights ON vec_id = bin % n_weights
               GROUP BY id, precursor, dim""",
        ),
        "embedded": (
            ("activations",),
            """SELECT id, precursor, any_value(len_frag) AS len_frag,
                      list(value ORDER BY dim) AS embedding
               FROM activations GROUP BY id, precursor""",
        ),
        "vector_sums": (
            ("activations",),
            """SELECT id, any_value(len_frag) AS len_frag, count(*)::INTEGER AS width,
                      sum(value::DOUBLE) AS total, sum(value::DOUBLE * dim) AS weighted
               FROM activations GROUP BY id""",
        ),
    }


def _with(
    select: str,
    *needs: str,
    source: str = "row_source",
    tolerance: float = 0.01,
    sign: int = 1,
) -> str:
    """``select`` under the common table expressions it needs, in dependency order.

    ``sign`` is that of the ion mode: of the proton's mass in library keys, and of what the
    mode's model returns.
    """
    known = {**_CTE, **_feature_ctes(source, tolerance), **_job_ctes()}
    if sign < 0:
        known = {
            name: (needed, body.replace("exact_mass + 1.007276", "exact_mass - 1.007276")
                   .replace("list(value ORDER BY dim)", "list(-value ORDER BY dim)"))
            for name, (needed, body) in known.items()
        }
    ordered: list[str] = []

    def add(name: str) -> None:
        if name not in ordered:
            for needed in known[name][0]:
                add(needed)
            ordered.append(name)

    for name in needs:
        add(name)
    body = ",\n".join(f"{name} AS ({known[name][1]})" for name in ordered)
    return f"WITH {body}\n{select}" if body else select


def _ranked(pairs: str) -> str:
    return f"""SELECT *, row_number() OVER (PARTITION BY spectrum_id
                           ORDER BY round(cosine, 12) DESC NULLS LAST, smile, inchikey) AS rank,
                      count(*) OVER (PARTITION BY spectrum_id) AS n_candidates
               FROM ({pairs})"""


def _job_ctes() -> dict[str, tuple[tuple[str, ...], str]]:
    similarity = (
        "list_cosine_similarity(q.embedding::DOUBLE[], l.embedding::DOUBLE[]) AS cosine"
    )
    return {
        "annotated_queries": (
            ("embedded", "annotated_first", "library"),
            """SELECT f.smile AS spectrum_id, t.mass_key, e.embedding, t.embedding AS truth
               FROM embedded e JOIN annotated_first f USING (id)
                 JOIN library t ON t.smile = f.smile""",
        ),
        "annotated_ranked": (
            ("annotated_queries", "library"),
            _ranked(
                f"""SELECT spectrum_id, l.smile, l.inchikey, truth, l.embedding AS vector,
                           round(l.exact_mass + 1.007276, 3) AS precursor_mz, {similarity}
                    FROM annotated_queries q JOIN library l USING (mass_key)"""
            ),
        ),
        "annotated_top": (
            ("annotated_ranked",),
            """SELECT *, len(list_filter(list_zip(truth, vector),
                               lambda t: t[1] > 0 AND t[2] > 0))
                      / len(list_filter(list_zip(truth, vector),
                               lambda t: t[1] > 0 OR t[2] > 0)) AS tanimoto
               FROM annotated_ranked WHERE rank <= 5""",
        ),
        "annotated_hits": (
            ("annotated_top",),
            """SELECT spectrum_id, min(CASE WHEN tanimoto >= 0.95 THEN rank END) AS hit_rank,
                      max(n_candidates) AS n_candidates
               FROM annotated_top GROUP BY spectrum_id""",
        ),
        "named_ranked": (
            ("embedded", "library"),
            _ranked(
                f"""SELECT q.id AS spectrum_id, l.smile, l.inchikey, {similarity}
                    FROM embedded q JOIN library l
                      ON l.mass_key = CAST(floor(round(q.precursor * 1000, 4)) AS BIGINT)"""
            ),
        ),
    }


def _wide(table: str, columns: dict[str, str], n: int = 5) -> str:
    picks = [
        f'max(CASE WHEN rank = {i} THEN {expr} END) AS "Top_{i}_{label}"'
        for label, expr in columns.items()
        for i in range(1, n + 1)
    ]
    return (
        f"SELECT spectrum_id AS \"Unique_ID\", {', '.join(picks)} FROM {table} "
        f"WHERE rank <= {n} GROUP BY spectrum_id"
    )


_COSINE = "round(cosine, 6)"
_ANNOTATED = {"cosine": _COSINE, "SMILE": "smile", "Tanimoto": "round(tanimoto, 6)"}
_UNANNOTATED = {"cosine": _COSINE, "SMILE": "smile", "InChIKey": "inchikey"}

_PEAK_VALUES = "SELECT spectrum_id, round(mz, 6) AS mz, round(intensity, 6) AS intensity FROM "
_FEATURE_TEXT = "SELECT id AS spectrum_id, round(precursor, 6) AS precursor, bins, len_frag FROM features"
_VECTOR_SUMS = "width, round(total, 3) AS total, round(weighted, 3) AS weighted"
_ACCURACY = """SELECT r::INTEGER AS rank, hits, round(hits * 100.0 / n, 6) AS pct,
                      round(sum(hits) OVER (ORDER BY r) * 100.0 / n, 6) AS cumulative_pct
               FROM (SELECT r, count(h.spectrum_id) AS hits, any_value(total.n) AS n
                     FROM range(1, 6) t(r)
                     CROSS JOIN (SELECT count(*) AS n FROM {queries}) total
                     LEFT JOIN {hits} h ON h.hit_rank = r
                     GROUP BY r)"""
_MSP_ROWS = """SELECT {id}, round(precursor, 6) AS precursor, '[M+H]+' AS adduct,
                      (row_number() OVER (PARTITION BY ordinal ORDER BY mz, intensity) - 1)::INTEGER
                        AS pos,
                      round(mz, 6) AS mz, intensity
               FROM spectra JOIN order_peaks USING (ordinal)
               UNION ALL
               SELECT {id}, round(precursor, 6), '[M+H]+', NULL, NULL, NULL
               FROM spectra WHERE ordinal NOT IN (SELECT ordinal FROM order_peaks)"""


def oracles() -> dict[str, str]:
    return {
        "msp_scan": _with(
            """SELECT 'Name: ' || name AS id_line, (4 + count(mz))::INTEGER AS n_lines
               FROM spectra LEFT JOIN order_peaks USING (ordinal) GROUP BY ordinal, name""",
            "spectra",
            "order_peaks",
        ),
        "block_numbers": _with(
            """SELECT name AS spectrum_id, row_number() OVER (ORDER BY ordinal) - 1 AS number
               FROM spectra""",
            "spectra",
        ),
        "msp_parse_annotated": _with(_MSP_ROWS.format(id="smile"), "spectra", "order_peaks"),
        "msp_parse_named": _with(
            _MSP_ROWS.format(id="name AS spectrum_id"), "spectra", "order_peaks"
        ),
        "library_scan": _with(
            """SELECT smile, inchikey, round(precursor_mz, 6) AS precursor_mz,
                      len(embedding)::INTEGER AS width,
                      round(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x))), 6)
                        AS norm
               FROM vector_library""",
            "vector_library",
        ),
        "features_write": _with(_FEATURE_TEXT, "features", source="named_source"),
        "results_csv": _with(
            """SELECT spectrum_id AS "Unique_ID",
                      round(max(CASE WHEN rank = 1 THEN cosine END), 6) AS "Top_1_cosine",
                      max(CASE WHEN rank = 5 THEN smile END) AS "Top_5_SMILE",
                      coalesce(max(CASE WHEN rank = 60 THEN inchikey END), 'NA')
                        AS "Top_60_InChIKey",
                      (180 - 3 * count(CASE WHEN rank <= 60 THEN 1 END))::INTEGER AS n_missing
               FROM vector_ranked GROUP BY spectrum_id""",
            "vector_ranked",
        ),
        "predictions_checkpoint": _with(
            f"SELECT id AS spectrum_id, len_frag, {_VECTOR_SUMS} FROM vector_sums", "vector_sums"
        ),
        "predictions_resumed": _with(
            f"SELECT id AS spectrum_id, len_frag, {_VECTOR_SUMS} FROM vector_sums", "vector_sums"
        ),
        "ion_mode_route": _with(
            """SELECT name AS spectrum_id, CASE WHEN status = 'F' THEN '-' ELSE '+' END AS ion_mode,
                      round(precursor, 6) AS precursor, count(mz)::INTEGER AS n_peaks
               FROM spectra LEFT JOIN order_peaks USING (ordinal)
               GROUP BY ordinal, name, status, precursor""",
            "spectra",
            "order_peaks",
        ),
        "precursor_window": _with(_PEAK_VALUES + "windowed", "windowed"),
        "drop_empty": _with(
            "SELECT spectrum_id, count(*) AS n_peaks FROM windowed GROUP BY spectrum_id",
            "windowed",
        ),
        "base_peak_scale": _with(_PEAK_VALUES + "scaled", "scaled"),
        "intensity_threshold": _with(_PEAK_VALUES + "kept", "kept"),
        "total_ion_scale": _with(_PEAK_VALUES + "cleaned", "cleaned"),
        "peak_group": _with(
            """SELECT id AS spectrum_id, mz, round(intensity, 6) AS intensity, n_merged
               FROM merged""",
            "merged",
            tolerance=20,
        ),
        "precursor_cutoff": _with(
            "SELECT id AS spectrum_id, round(precursor, 6) AS precursor, mz FROM light", "light"
        ),
        "unzip_peaks": _with(
            """SELECT name AS spectrum_id, pos::INTEGER AS pos, round(mz, 6) AS mz,
                      round(intensity, 6) AS ints
               FROM record_kept""",
            "record_kept",
        ),
        "neutral_loss": _with(
            "SELECT id AS spectrum_id, value AS loss FROM valued WHERE kind = 1", "valued"
        ),
        "mz_plus_loss": _with("SELECT id AS spectrum_id, kind, value FROM valued", "valued"),
        "spectrum_bins": _with("SELECT id AS spectrum_id, kind, bin FROM binned", "binned"),
        "sparse_encode": _with("SELECT id AS spectrum_id, bin FROM bins", "bins"),
        "len_frag": _with("SELECT id AS spectrum_id, len_frag FROM features", "features"),
        "feature_project": _with(_FEATURE_TEXT, "features"),
        "pool_by_structure": _with(
            """SELECT f.structure_key, f.smile, round(f.precursor, 6) AS precursor,
                      o_orderkey AS ordinal, l_linenumber AS pos,
                      round(l_extendedprice / 150, 6) AS mz, l_quantity * l_quantity + sqrt(l_extendedprice) / 100 AS intensity
               FROM (SELECT o_custkey AS structure_key,
                            arg_min(o_orderstatus || '-' || (o_custkey // 2), o_orderkey) AS smile,
                            arg_min(o_totalprice / 400, o_orderkey) AS precursor
                     FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)
                     GROUP BY o_custkey
                     QUALIFY row_number() OVER (PARTITION BY smile ORDER BY structure_key) = 1) f
                 JOIN orders ON o_custkey = f.structure_key
                 JOIN lineitem ON l_orderkey = o_orderkey"""
        ),
        "first_per_key": _with(
            """SELECT structure_key, smile, round(precursor, 6) AS precursor
               FROM first_structure""",
            "first_structure",
        ),
        "dedupe_by_id": """SELECT o_custkey AS spectrum_id, o_orderkey AS ordinal,
                                  o_orderstatus || '-' || (o_custkey // 2) AS smile,
                                  round(o_totalprice / 400, 6) AS precursor
                           FROM orders
                           QUALIFY row_number() OVER (PARTITION BY o_custkey
                                                      ORDER BY o_orderkey) = 1""",
        "dedupe_by_smile": _with(
            """SELECT structure_key, smile, round(precursor, 6) AS precursor FROM first_structure
               QUALIFY row_number() OVER (PARTITION BY smile ORDER BY structure_key) = 1""",
            "first_structure",
        ),
        "adduct_mz": """SELECT p_partkey, round(p_retailprice + 1.007276, 6) AS mz_positive,
                               round(p_retailprice - 1.007276, 6) AS mz_negative
                        FROM part""",
        "mass_key_rounded": """SELECT p_partkey,
                                 CAST(round(round(p_retailprice + 1.007276, 3) * 1000) AS BIGINT)
                                   AS mass_key
                               FROM part""",
        "mass_key_truncated": r"""SELECT p_partkey,
                 CAST(regexp_extract(t, '^(\d+)', 1) ||
                      rpad(regexp_extract(t, '\.(\d{1,3})', 1), 3, '0') AS BIGINT) AS mass_key
               FROM (SELECT p_partkey,
                            CAST(p_retailprice + 1.0075::DOUBLE + p_size * 0.0001::DOUBLE
                                 AS VARCHAR) AS t
                     FROM part)""",
        "null_mass_skip": _with(
            """SELECT library_id, mass_key, coalesce(n, 0) AS n_queries
               FROM part_library
                 LEFT JOIN (SELECT mass_key, count(*) AS n FROM part_queries GROUP BY mass_key)
                 USING (mass_key)""",
            "part_library",
            "part_queries",
        ),
        "formula_mass": """SELECT p_partkey,
                   'C' || p_size || 'H' || (p_partkey % 60 + 1) || 'NO2Cl' AS formula,
                   round(p_size * 12.0 + (p_partkey % 60 + 1) * 1.00782503223
                     + 14.00307400443 + 2 * 15.99491461957 + 34.968852682, 6)::DOUBLE AS exact_mass
               FROM part""",
        "attach_properties": """SELECT o_orderkey AS spectrum_id,
                   'Customer#' || lpad((o_custkey + 100)::VARCHAR, 9, '0') AS smile,
                   substr(upper(md5(c_name)), 1, 14) AS structure_key,
                   100 + floor((c_acctbal + 1000) / 50) * 5.0 AS exact_mass
               FROM orders LEFT JOIN customer
                 ON c_name = 'Customer#' || lpad((o_custkey + 100)::VARCHAR, 9, '0')""",
        "candidates": _with(
            """SELECT spectrum_id, mass_key, count(*) AS n_candidates,
                      min(library_id) AS first_candidate, max(library_id) AS last_candidate
               FROM part_queries JOIN part_library USING (mass_key)
               GROUP BY spectrum_id, mass_key""",
            "part_queries",
            "part_library",
        ),
        "unmatched_queries": _with(
            """SELECT spectrum_id, mass_key FROM part_queries q
               WHERE NOT EXISTS (SELECT 1 FROM part_library l WHERE l.mass_key = q.mass_key)""",
            "part_queries",
            "part_library",
        ),
        "cosine": _with(
            """SELECT vec_id, round(list_cosine_similarity(a::DOUBLE[], b::DOUBLE[]), 6) AS cosine
               FROM neighbours""",
            "neighbours",
        ),
        "tanimoto": _with(
            "SELECT vec_id, round(tanimoto, 6) AS tanimoto FROM neighbour_tanimoto",
            "neighbour_tanimoto",
        ),
        "structure_match": _with(
            "SELECT vec_id, tanimoto >= 0.4 AS same_structure FROM neighbour_tanimoto",
            "neighbour_tanimoto",
        ),
        "topn_candidates": _with(
            """SELECT spectrum_id, rank::INTEGER AS rank, smile, n_candidates,
                      round(cosine, 6) AS cosine
               FROM vector_ranked WHERE rank <= 5""",
            "vector_ranked",
        ),
        "topn_laid_out": _with(
            """SELECT spectrum_id, rank::INTEGER AS rank, smile, n_candidates,
                      round(cosine, 6) AS cosine
               FROM vector_ranked WHERE rank <= 5""",
            "vector_ranked",
        ),
        "wide_annotated": _with(_wide("vector_top", _ANNOTATED), "vector_top"),
        "wide_unannotated": _with(_wide("vector_ranked", _UNANNOTATED), "vector_ranked"),
        "first_hit_rank": _with(
            "SELECT spectrum_id, hit_rank::INTEGER AS hit_rank, n_candidates FROM hits", "hits"
        ),
        "hit_histogram": _with(
            "SELECT bucket::INTEGER AS bucket, count(*) AS n_queries FROM buckets GROUP BY bucket",
            "buckets",
        ),
        "candidate_counts": _with(
            """SELECT bucket::INTEGER AS bucket, sum(n_candidates)::BIGINT AS sum_candidates,
                      min(n_candidates) AS min_candidates, max(n_candidates) AS max_candidates
               FROM buckets GROUP BY bucket""",
            "buckets",
        ),
        "topk_accuracy": _with(
            _ACCURACY.format(queries="embeddings", hits="hits"), "hits"
        ),
        "hit_detail": _with(
            """SELECT spectrum_id, bucket::INTEGER AS bucket, smile, round(tanimoto, 6) AS tanimoto,
                      round(cosine, 6) AS cosine, t.n_candidates,
                      CASE WHEN bucket = 1 THEN inchikey END AS inchikey,
                      CASE WHEN bucket = 1 THEN round(precursor_mz, 6) END AS precursor_mz
               FROM vector_top t JOIN buckets b USING (spectrum_id)
               WHERE rank = coalesce(hit_rank, 1)""",
            "vector_top",
            "buckets",
        ),
        "embed_spectra": _with(
            f"SELECT id AS spectrum_id, len_frag, {_VECTOR_SUMS} FROM vector_sums", "vector_sums"
        ),
        "sparse_linear": _with(
            """SELECT spectrum_id, count(*)::INTEGER AS width, round(sum(value), 3) AS total,
                      round(sum(value * dim), 3) AS weighted
               FROM (SELECT id AS spectrum_id, dim,
                            greatest(sum(w) + 0.25::DOUBLE * ((dim - 1) % 4), 0)::FLOAT::DOUBLE
                              AS value
                     FROM bins JOIN weights ON vec_id = bin % n_weights
                     GROUP BY id, dim)
               GROUP BY spectrum_id""",
            "bins",
            "weights",
        ),
        "embed_by_mode": _with(
            """SELECT id AS spectrum_id, CASE WHEN id % 2 = 0 THEN '+' ELSE '-' END AS ion_mode,
                      width, round(CASE WHEN id % 2 = 0 THEN total ELSE -total END, 3) AS total,
                      round(CASE WHEN id % 2 = 0 THEN weighted ELSE -weighted END, 3) AS weighted
               FROM vector_sums""",
            "vector_sums",
        ),
        "identify_annotated": _with(
            _wide("annotated_top", _ANNOTATED), "annotated_top", source="annotated_source"
        ),
        "identify_unannotated": _with(
            _wide("named_ranked", _UNANNOTATED), "named_ranked", source="named_source"
        ),
        "identify_laid_out": _with(
            _wide("named_ranked", _UNANNOTATED), "named_ranked", source="named_source"
        ),
        "evaluate_retrieval": _with(
            _ACCURACY.format(queries="annotated_queries", hits="annotated_hits"),
            "annotated_queries",
            "annotated_hits",
            source="annotated_source",
        ),
        "evaluate_models": " UNION ALL ".join(
            f"SELECT '{name}' AS model, * FROM ("
            + _with(
                _ACCURACY.format(queries="annotated_queries", hits="annotated_hits"),
                "annotated_queries",
                "annotated_hits",
                source="annotated_source",
            ).replace("list(value ORDER BY dim)", f"list({sign}value ORDER BY dim)")
            + ")"
            for name, sign in (("vectors", ""), ("opposite", "-"))
        ),
        "retrieval_histogram": _with(
            """SELECT coalesce(hit_rank, 11)::INTEGER AS bucket, count(*) AS n_queries,
                      sum(n_candidates)::BIGINT AS sum_candidates,
                      min(n_candidates) AS min_candidates, max(n_candidates) AS max_candidates
               FROM annotated_hits GROUP BY bucket""",
            "annotated_hits",
            source="annotated_source",
        ),
        "retrieval_detail": _with(
            """SELECT spectrum_id, coalesce(hit_rank, 11)::INTEGER AS bucket, smile,
                      round(tanimoto, 6) AS tanimoto, round(cosine, 6) AS cosine, t.n_candidates,
                      CASE WHEN hit_rank = 1 THEN inchikey END AS inchikey,
                      CASE WHEN hit_rank = 1 THEN round(precursor_mz, 6) END AS precursor_mz
               FROM annotated_top t JOIN annotated_hits h USING (spectrum_id)
               WHERE rank = coalesce(hit_rank, 1)""",
            "annotated_top",
            "annotated_hits",
            source="annotated_source",
        ),
        "identify_by_mode": " UNION ALL ".join(
            "SELECT * FROM ("
            + _with(
                f"""SELECT spectrum_id, '{mode}' AS ion_mode, rank::INTEGER AS rank, smile,
                           n_candidates, round(cosine, 6) AS cosine
                    FROM named_ranked WHERE rank <= 5""",
                "named_ranked",
                source=source,
                sign=sign,
            )
            + ")"
            for mode, sign, source in (
                ("+", 1, "named_positive_source"),
                ("-", -1, "named_negative_source"),
            )
        ),
        "library_formula": """SELECT smile, round(mass, 6)::DOUBLE AS exact_mass,
                   CAST(round(round(mass::DOUBLE - 1.007276, 3) * 1000) AS BIGINT) AS mass_key
               FROM (SELECT 'P' || p_partkey AS smile,
                            CASE WHEN p_size % 10 <> 0 THEN
                              p_size * 12.0 + (p_partkey % 60 + 1) * 1.00782503223
                                + 14.00307400443 + 2 * 15.99491461957 + 34.968852682 END AS mass
                     FROM part)""",
    }
