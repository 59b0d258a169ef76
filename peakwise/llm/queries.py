"""One query per operator over its whole table, with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peakwise.llm import (
    centroids,
    decontaminate,
    embedding_dedup,
    html_text,
    lm_score,
    mixing,
    piece_codec,
    simhash,
    spelling,
    token_file,
    toxicity,
    url_rules,
    warc,
)
from peakwise.session import shared_path

#: Tokenizer of the token files.
TOKENIZER = "word_bpe_49k.json"

#: Vocabulary of the piece ids.
PIECES = "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.simhash_components(docs).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def tokenizer_path(name: str = TOKENIZER) -> str:
    """A public tokenizer's file, of a package every executor has."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pseudo-likelihood of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return lm_score.score_documents(docs)


#: Verdict, host and path of the rules for pages.
URL_RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the url of every page."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.filter_urls(pages, URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict"
    )


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document written to token files and read back."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    path = token_file.write_token_files(
        docs, shared_path(spark, "token-files"), tokenizer_path()
    )
    return token_file.read_digests(spark, path)


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return embedding_dedup.embedding_components(vectors)


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of every document by the mix of its source."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    held_out = toxicity.fold_of() == 0
    return model.score(docs).select(
        "doc_id", held_out.alias("held_out"), "score", "predicted"
    )


def op8_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back."""
    path = warc.write_archives(_table(spark, sf_dir, "pages"), shared_path(spark, "archives"))
    records = warc.read_archives(spark, path, payloads=False).where("kind = 'record'")
    return records.select(
        warc.page_of(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.page_of(F.col("refers_to")).alias("refers_to"),
    )


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract_text(pages)


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.benchmark_passages(docs, _table(spark, sf_dir, "benchmark"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, each with its most frequent spelling."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.spelling_variants(docs).select(
        "word", "form", "root", "n", "n_near", "form_n"
    )


def op12_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as piece ids and back: number and digests."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    path = tokenizer_path(PIECES)
    texts = piece_codec.decoded(piece_codec.encoded(docs, path), path)
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    return texts.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(joined, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector after five rounds from forty centroids."""
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    assigned, found = centroids.cluster_vectors(vectors)
    return centroids.with_inertia(assigned, found).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_lm_score": op3_lm_score,
    "op4_url_filter": op4_url_filter,
    "op5_token_files": op5_token_files,
    "op6_embedding_near_dedup": op6_embedding_near_dedup,
    "op7_mix_sources": op7_mix_sources,
    "op8_warc_salvage": op8_warc_salvage,
    "op9_html_text": op9_html_text,
    "op10_benchmark_decontamination": op10_benchmark_decontamination,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_piece_codec": op12_piece_codec,
    "op13_centroid_clusters": op13_centroid_clusters,
}

# Columns of `documents` that the mix needs, and the targets of its sources.
_MIX = r'''
WITH d AS (
  SELECT doc_id, source, md5(coalesce(doc_id::VARCHAR, '')) AS k,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, source_size * 2.0::DOUBLE AS cap,
         [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
  FROM s
), r AS (
  SELECT *, cap / weight AS room, sum(source_size) OVER ()::DOUBLE * 1.5::DOUBLE AS total,
         coalesce(sum(cap) OVER before, 0) AS capped, sum(weight) OVER after AS weights
  FROM w
  WINDOW before AS (ORDER BY cap / weight, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         after AS (ORDER BY cap / weight, source NULLS LAST
                   ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), l AS (
  SELECT *, max((total - capped) / weights) FILTER (WHERE (total - capped) / weights <= room)
              OVER () AS level
  FROM r
), t AS (
  SELECT source, source_size,
         CASE WHEN level IS NULL OR room <= level THEN cap ELSE weight * level END AS target
  FROM l
), b AS (
  SELECT *, round(target)::BIGINT AS budget,
         CASE WHEN source_size > 0 THEN round(target)::BIGINT // source_size ELSE 0 END AS epochs
  FROM t
)
SELECT doc_id, size, source_size, target,
       epochs * size + greatest(0, least(size, budget - epochs * source_size -
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
       ))::BIGINT AS taken
FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source
'''

_URLS = r'''
WITH u AS (
  SELECT page_id, contains(url, '://') AS sound,
         regexp_extract(substr(url, strpos(url, '://') + 3), '^([^/?#]*)([^?#]*)', 1) AS h,
         regexp_extract(substr(url, strpos(url, '://') + 3), '^([^/?#]*)([^?#]*)', 2) AS p
  FROM pages
), v AS (
  SELECT page_id, CASE WHEN sound THEN translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                   'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
         CASE WHEN sound THEN p ELSE '' END AS path
  FROM u
), w AS (
  SELECT *, CASE
    WHEN ends_with('.' || host, '.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN ends_with('.' || host, '.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN ends_with('.' || host, '.net') AND starts_with(path, '/') THEN 'net/'
  END AS rule FROM v
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM w
'''


# SQL has no CRC-32: it is folded over the bytes of each distinct run of a document.  Pairs are
# joined on the word without one letter.
_SPELLING = r'''
WITH RECURSIVE t AS MATERIALIZED (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
           lambda c, step: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc
), r AS MATERIALIZED (
  SELECT doc_id, run, count(*) AS n
  FROM (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')),
                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
        FROM documents)
  WHERE length(run) >= 7 GROUP BY doc_id, run
), h AS MATERIALIZED (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(
           string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
           lambda ch: CASE WHEN unicode(ch) < 128 THEN [unicode(ch)::BIGINT]
             ELSE [192 + unicode(ch) // 64, 128 + unicode(ch) % 64]::BIGINT[] END))),
         lambda c, b: xor(c >> 8, crc[xor(c & 255, b) + 1])), 4294967295) AS h
  FROM r, t
), w AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n
  FROM (SELECT n, CASE WHEN h % 31 = 0
                       THEN run[1 : h % length(run)] || run[h % length(run) + 2 :]
                       ELSE run END AS word FROM h)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), d AS MATERIALIZED (
  SELECT word, n, i, word[1 : i - 1] || word[i + 1 :] AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)
), near AS MATERIALIZED (
  SELECT a.word, b.word AS other FROM d a JOIN d b ON a.i = b.i AND a.rest = b.rest
  WHERE a.word <> b.word
  UNION SELECT a.word, b.word FROM d a JOIN w b ON a.rest = b.word
  UNION SELECT b.word, a.word FROM d a JOIN w b ON a.rest = b.word
), best AS MATERIALIZED (
  SELECT near.word, count(*) AS n_near, max(w.n) AS most,
         arg_min(other, (-w.n, other)) AS other
  FROM near JOIN w ON w.word = other GROUP BY near.word
), f AS MATERIALIZED (
  SELECT w.word, n, coalesce(n_near, 0) AS n_near,
         CASE WHEN most >= 10 * n THEN other END AS form,
         CASE WHEN most >= 10 * n THEN most END AS form_n
  FROM w LEFT JOIN best USING (word)
), chain AS (
  SELECT word, word AS root, form AS ahead FROM f
  UNION ALL
  SELECT chain.word, ahead, f.form FROM chain JOIN f ON f.word = ahead
)
SELECT f.word, form, root, n, n_near, form_n
FROM f JOIN chain ON chain.word = f.word AND ahead IS NULL
'''


def _clusters(k: int = 40, rounds: int = 5) -> str:
    """SQL of the clusters: a vector is a row per component, every round four tables."""
    steps = [
        f"""
  v AS MATERIALIZED (
    SELECT vec_id, i, floor(256.0::DOUBLE * embedding[i]::DOUBLE)::BIGINT AS x
    FROM (SELECT vec_id, embedding, unnest(range(1, 65)) AS i FROM embeddings
          WHERE len(embedding) = 64
            AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64)
  ), c0 AS MATERIALIZED (
    SELECT number::INTEGER AS cluster, i, x
    FROM (SELECT vec_id, row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS number
          FROM (SELECT DISTINCT vec_id FROM v)) JOIN v USING (vec_id)
    WHERE number < {k}
  )"""
    ]
    for n in range(rounds + 1):
        steps.append(f"""
  a{n} AS MATERIALIZED (
    SELECT vec_id, cluster, distance
    FROM (SELECT vec_id, cluster, sum((v.x - c.x) * (v.x - c.x))::BIGINT AS distance
          FROM v JOIN c{n} c USING (i) GROUP BY vec_id, cluster)
    QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) = 1
  )""")
        if n < rounds:
            steps.append(f"""
  m{n} AS MATERIALIZED (
    SELECT cluster, i, sum(x)::BIGINT AS total, count(*) AS members
    FROM v JOIN a{n} USING (vec_id) GROUP BY cluster, i
  ), c{n + 1} AS MATERIALIZED (
    SELECT cluster, i, CASE WHEN members IS NULL THEN x
                            ELSE (total - ((total % members) + members) % members) // members
                       END AS x
    FROM c{n} LEFT JOIN m{n} USING (cluster, i)
  )""")
    return f"""
WITH {",".join(steps)},
  named AS (SELECT cluster, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS centroid_sha256
            FROM c{rounds} GROUP BY cluster)
SELECT vec_id, cluster, distance,
       sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
       sum(distance) OVER ()::BIGINT AS inertia, centroid_sha256
FROM a{rounds} JOIN named USING (cluster)
"""


ORACLES: dict[str, str] = {
    "op4_url_filter": _URLS,
    "op7_mix_sources": _MIX,
    "op11_spelling_variants": _SPELLING,
    "op13_centroid_clusters": _clusters(),
}
