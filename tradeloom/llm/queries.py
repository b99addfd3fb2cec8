"""Registered queries of the operators, each over its whole tables, and their SQL for DuckDB where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm import decontamination, html_extraction, license_scan, quality_rules, sanitisation, sentence_pieces, sharded_lloyd, simhash, spelling_variants, suffix_dedup, token_counts, url_filter, word_windows
from tradeloom.llm.shipping import ship

TOKEN_LIMIT = 1024

# The rules of op3 as (host, path, verdict).
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "documents").select("doc_id", "text")


def op1_word_windows(spark: SparkSession, folder: str) -> DataFrame:
    kept = word_windows.remove_repeats(_documents(spark, folder))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


_OP1_SQL = r"""
WITH texts AS (
    SELECT row_number() OVER () AS place, doc_id,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
),
positions AS (
    SELECT place, nth, words[nth] AS word,
        CASE WHEN nth + 34 <= len(words) THEN array_to_string(words[nth:nth + 34], ' ') END AS sequence
    FROM texts, unnest(range(1, len(words) + 1)) AS t(nth)
),
repeated AS (
    SELECT sequence FROM positions WHERE sequence IS NOT NULL GROUP BY sequence HAVING count(*) > 1
),
marked AS (
    SELECT place, nth, word,
        max(r.sequence IS NOT NULL) OVER (PARTITION BY place ORDER BY nth ROWS 34 PRECEDING) AS gone
    FROM positions p LEFT JOIN repeated r ON p.sequence = r.sequence
),
kept AS (
    SELECT place, count(*) FILTER (WHERE gone) AS n_removed,
        string_agg(word, ' ' ORDER BY nth) FILTER (WHERE NOT gone) AS rest
    FROM marked GROUP BY place
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
    sha256(coalesce(rest, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (place)
"""


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = token_counts.count_tokens(_documents(spark, folder), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    judged = url_filter.judge(_table(spark, folder, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


_RULE_ROWS = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in URL_RULES)
_OP3_SQL = f"""
WITH rules(rule_host, rule_path, verdict) AS (VALUES {_RULE_ROWS}),
urls AS (
    SELECT row_number() OVER () AS place, page_id,
        translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
    FROM pages
),
fitting AS (
    SELECT place, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
        arg_max(verdict, length(rule_host || rule_path)) AS verdict
    FROM urls JOIN rules
        ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY place
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM urls LEFT JOIN fitting USING (place)
"""


def op4_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    extracted = html_extraction.extract(_table(spark, folder, "pages").select("page_id", "url", "html"))
    return extracted.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op5_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan(_documents(spark, folder)).drop("text", "places")


def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    near = simhash.near_duplicates(_documents(spark, folder))
    return near.select("doc_id", F.lower(F.hex("fingerprint")).alias("fingerprint"), "component_id")


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.matches(_documents(spark, folder), _table(spark, folder, "benchmark"))


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.judge(_documents(spark, folder), _table(spark, folder, "labels"))
    return judged.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept")


def op9_sentence_pieces(spark: SparkSession, folder: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    decoded = sentence_pieces.encode_and_decode(_documents(spark, folder), model)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = suffix_dedup.remove_repeats(_documents(spark, folder))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants.variants(spelling_variants.count_words(_documents(spark, folder)))


def op12_sanitisation(spark: SparkSession, folder: str) -> DataFrame:
    found = sanitisation.sanitise(_documents(spark, folder), everywhere=True)
    return found.select(
        "doc_id",
        *[sanitisation.count_of(kind).alias(f"n_{kind}") for kind in sanitisation.KINDS],
        F.sha2(sanitisation.span_text(), 256).alias("base_sha256"),
        sanitisation.span_text(terms="terms").alias("spans"),
    )


def op13_sharded_lloyd(spark: SparkSession, folder: str) -> DataFrame:
    clustered = sharded_lloyd.cluster(_table(spark, folder, "embeddings"))
    written = F.concat_ws(",", F.col("centroid").cast("array<string>"))
    return clustered.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.sha2(written, 256).alias("centroid_sha256"))


def _lloyd_sql(clusters: int = 8, rounds: int = 10, dimensions: int = 64) -> str:
    """A relation per round; vectors are known by their row, since ids may repeat."""

    def assigned(centroids: str) -> str:
        return f"""
    SELECT place, arg_min(cluster, (distance, cluster)) AS cluster, min(distance) AS distance
    FROM (SELECT place, cluster, CAST(sum((x - y) * (x - y)) AS BIGINT) AS distance
          FROM cells JOIN {centroids} USING (d) GROUP BY place, cluster)
    GROUP BY place"""

    parts = [f"""vectors AS MATERIALIZED (
    SELECT row_number() OVER () AS place, vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS vector
    FROM embeddings
    WHERE len(embedding) = {dimensions} AND len([1 FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = {dimensions}
),
cells AS MATERIALIZED (SELECT place, d, vector[d] AS x FROM vectors, unnest(range(1, {dimensions + 1})) AS t(d)),
centroids_0 AS MATERIALIZED (
    SELECT cluster, d, vector[d] AS y
    FROM (SELECT row_number() OVER (ORDER BY sha256('3:' || coalesce(CAST(vec_id AS VARCHAR), '')), vector) - 1 AS cluster, vector
          FROM vectors QUALIFY cluster < {clusters}), unnest(range(1, {dimensions + 1})) AS t(d)
)"""]
    for n in range(rounds):
        parts.append(f"""assigned_{n} AS MATERIALIZED ({assigned(f"centroids_{n}")}
),
centroids_{n + 1} AS MATERIALIZED (
    SELECT cluster, d, coalesce((total - ((total % n) + n) % n) // n, y) AS y
    FROM centroids_{n} LEFT JOIN (
        SELECT cluster, d, CAST(sum(x) AS BIGINT) AS total, count(*) AS n
        FROM cells JOIN assigned_{n} USING (place) GROUP BY cluster, d) USING (cluster, d)
)""")
    parts.append(f"""final AS MATERIALIZED ({assigned(f"centroids_{rounds}")}
),
written AS (SELECT cluster, sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM centroids_{rounds} GROUP BY cluster)""")
    return "WITH " + ",\n".join(parts) + """
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance,
    CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
    CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM vectors JOIN final USING (place) JOIN written USING (cluster)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def shipped(query):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship(spark)
            return query(spark, folder)

        return run

    return {f.__name__: shipped(f) for f in (op1_word_windows, op2_token_counts, op3_url_filter, op4_html_extraction, op5_license_scan, op6_simhash, op7_decontamination, op8_quality_rules, op9_sentence_pieces, op10_suffix_dedup, op11_spelling_variants, op12_sanitisation, op13_sharded_lloyd)}


def oracle_sql() -> dict[str, str]:
    return {"op1_word_windows": _OP1_SQL, "op3_url_filter": _OP3_SQL, "op13_sharded_lloyd": _lloyd_sql()}
