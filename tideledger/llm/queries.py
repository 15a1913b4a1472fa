"""The registered queries: each operator over its whole table, and SQL where that can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideledger.llm import bpe, clustering, counts, lines, passages, quality, secrets, sharding, toxicity
from tideledger.llm.hardnegatives import hard_negatives
from tideledger.llm.minhash import near_duplicates
from tideledger.llm.neighbours import nearest
from tideledger.llm.packing import packed, word_count
from tideledger.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(
        table(spark, folder, "documents"), width=3, percent=85, coordinates=130, rows=5
    )


def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secret_findings(table(spark, folder, "documents"))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxic_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op4_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    file = public_tokenizers.path("word_bpe_49k.json")
    rows = bpe.decoded(bpe.encoded(table(spark, folder, "documents"), file), file)
    return rows.select(
        "doc_id", "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = lines.drop_boilerplate(table(spark, folder, "documents"))
    return rows.select("doc_id", "source", "n_lines", "clean_text")


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Totals after four batches: all documents with words estimated from their length; words
    counted by a second tokenizer version, a batch that is sent twice; the estimates revised to
    counts; documents that repeat an earlier one's text deleted."""
    docs = table(spark, folder, "documents")
    ledger = counts.TokenLedger(spark, scratch_path(spark, "ledger"))

    def change(op: str, version: str, tokens: Column) -> DataFrame:
        return docs.select(F.lit(op).alias("op"), "doc_id", "source", "lang",
                           F.lit(version).alias("tokenizer_version"), tokens.alias("tokens"))

    text = F.coalesce("text", F.lit(""))
    ledger.commit("load", change("insert", "words", F.floor(F.length(text) / 6).cast("long")))
    parts = change("insert", "parts", F.regexp_count(text, F.lit(PARTS)).cast("long"))
    ledger.commit("parts", parts)
    ledger.commit("parts", parts)
    ledger.commit("count", change("revise", "words", word_count(text)))
    keys = docs.select("doc_id", F.md5("text").alias("key"))
    first = keys.groupBy("key").agg(F.min("doc_id").alias("first_id"))
    copies = keys.join(first, "key").where(F.col("doc_id") != F.col("first_id")).select("doc_id")
    gone = copies.select(
        F.lit("delete").alias("op"), "doc_id", F.lit(None).cast("string").alias("source"),
        F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("tokenizer_version"),
        F.lit(None).cast("long").alias("tokens"),
    )
    ledger.commit("copies", gone)
    return ledger.totals()


# Runs of letters and digits, and single other characters that are not white space.
PARTS = "[A-Za-z0-9\\x80-\\x{10FFFF}]+|[^A-Za-z0-9\\x80-\\x{10FFFF}\\x20\\x09-\\x0D]"


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_verdicts(table(spark, folder, "documents"))


def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return passages.repeated_passages(table(spark, folder, "documents"))


def op9_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(table(spark, folder, "embeddings"))


def op10_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed(table(spark, folder, "documents"))


def op11_sharding(spark: SparkSession, folder: str) -> DataFrame:
    rows = sharding.sharded(table(spark, folder, "documents"))
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, folder, "embeddings").withColumn("label", shifted))


def op13_centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    return clustering.cluster_report(*clustering.clustered(table(spark, folder, "embeddings")))


def queries() -> dict[str, Query]:
    own = (op1_minhash_near_dedup, op2_secret_scan, op3_toxicity, op4_bpe_round_trip, op5_line_dedup,
           op6_token_counts, op7_quality_rules, op8_substring_dedup, op9_nearest_neighbours,
           op10_best_fit_packing, op11_sharding, op12_hard_negatives, op13_centroid_clustering)
    return {q.__name__: q for q in own}


WORD = "[^\\x20\\x09-\\x0D]+"
SPACE = "[\\x20\\x09-\\x0D]+"

OP5_SQL = f"""
WITH pieces AS (
    SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) AS pos
    FROM documents
), keyed AS (
    SELECT *, trim(lower(regexp_replace(line, '{SPACE}', ' ', 'g'))) AS key FROM pieces
), pages AS (
    SELECT source, count(*) AS n_host FROM documents GROUP BY source
), boilerplate AS (
    SELECT source, key FROM keyed JOIN pages USING (source) WHERE key <> ''
    GROUP BY source, key, n_host
    HAVING count(DISTINCT doc_id) > {lines.RATIO} * n_host AND count(DISTINCT doc_id) >= {lines.MIN_PAGES}
)
SELECT doc_id, k.source, count(*) AS n_lines,
       coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE b.key IS NULL), '') AS clean_text
FROM keyed k LEFT JOIN boilerplate b ON k.source = b.source AND k.key = b.key
GROUP BY doc_id, k.source
"""

OP6_SQL = f"""
WITH kept AS (
    SELECT * FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1
), counted AS (
    SELECT source, lang, 'words' AS tokenizer_version,
           len(regexp_extract_all(text, '{WORD}')) AS n FROM kept
    UNION ALL
    SELECT source, lang, 'parts', len(regexp_extract_all(text, '{PARTS}')) FROM kept
)
SELECT source, lang, tokenizer_version, count(*) AS docs, CAST(sum(n) AS BIGINT) AS tokens
FROM counted GROUP BY ALL
"""

OP7_SQL = f"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(text, '{WORD}') AS w, text, source FROM documents
), placed AS (
    SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM words WHERE len(w) >= 3
), threes AS (
    SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS t FROM placed
), twice AS (
    SELECT doc_id, i FROM threes QUALIFY count(*) OVER (PARTITION BY doc_id, t) > 1
), covered AS (
    SELECT doc_id, count(DISTINCT p) AS n_repeat_words
    FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id
), lines AS (
    SELECT doc_id, source, line, len(regexp_extract_all(line, '{WORD}')) AS n_words,
           trim(regexp_replace(line, '{SPACE}', ' ', 'g')) AS shown
    FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM documents)
), own_lines AS (
    SELECT *, translate(shown, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines WHERE n_words > 0
), repeats AS (
    SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM own_lines GROUP BY doc_id
), hosts AS (
    SELECT source, count(*) AS n_host FROM documents GROUP BY source
), frequent AS (
    SELECT source, key FROM own_lines JOIN hosts USING (source) GROUP BY source, key, n_host
    HAVING count(DISTINCT doc_id) >= {quality.HOST_DOCS}
       AND count(DISTINCT doc_id) > {quality.HOST_SHARE} * n_host
), gone AS (
    SELECT doc_id, sum(n_words) AS n_gone FROM own_lines SEMI JOIN frequent USING (source, key)
    GROUP BY doc_id
), base AS (
    SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
           len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
           coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
           CAST(len(w) - coalesce(n_gone, 0) AS BIGINT) AS words_left
    FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN repeats USING (doc_id) LEFT JOIN gone USING (doc_id)
)
SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.REPEAT_PERCENT} * n_words AS base_failed,
       NOT (n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.REPEAT_PERCENT} * n_words)
           AND words_left >= {quality.LEFT_SHARE} * n_words AS kept
FROM base
"""

FINE = "len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

OP12_SQL = f"""
WITH fine AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND {FINE}
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
           CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
    FROM fine a JOIN fine b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) <= 5
"""


def _op13_sql() -> str:
    """Each round is an assignment and the new centroids, one list of lists in a single row."""
    assign = """
assigned_{r} AS MATERIALIZED (
    SELECT vec_id, v, list_position(d, list_min(d)) - 1 AS cluster, list_min(d) AS distance FROM (
        SELECT vec_id, v, list_transform(cs, lambda c: list_sum(list_transform(range(1, 65),
                   lambda i: (v[i] - c[i]) * (v[i] - c[i])))) AS d
        FROM kept, centroids_{r}
    )
)"""
    move = """
centroids_{next} AS MATERIALIZED (
    SELECT list(coalesce(c, cs[k]) ORDER BY k) AS cs
    FROM (SELECT cs, unnest(range(1, len(cs) + 1)) AS k FROM centroids_{r}) LEFT JOIN (
        SELECT cluster + 1 AS k, list(m ORDER BY i) AS c FROM (
            SELECT cluster, i, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS m
            FROM (SELECT cluster, unnest(v) AS x, unnest(range(1, 65)) AS i FROM assigned_{r})
            GROUP BY cluster, i
        ) GROUP BY cluster
    ) USING (k)
)"""
    rounds = "".join(
        "," + assign.format(r=r) + "," + move.format(r=r, next=r + 1) for r in range(clustering.ROUNDS)
    )
    last = clustering.ROUNDS
    return f"""
WITH kept AS MATERIALIZED (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE len(embedding) = 64 AND {FINE}
), centroids_0 AS MATERIALIZED (
    SELECT list(v ORDER BY key, v) AS cs FROM (
        SELECT v, sha256('3:' || vec_id) AS key FROM kept WHERE vec_id IS NOT NULL
        ORDER BY key, v LIMIT {clustering.CENTROIDS}
    )
){rounds},{assign.format(r=last)}
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
       CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(cs[cluster + 1], ',')) AS centroid_sha256
FROM assigned_{last}, centroids_{last}
"""


def oracle_sql() -> dict[str, str]:
    return {"op5_line_dedup": OP5_SQL, "op6_token_counts": OP6_SQL, "op7_quality_rules": OP7_SQL,
            "op12_hard_negatives": OP12_SQL, "op13_centroid_clustering": _op13_sql()}
