"""Registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapelake.llm import (
    exact_dedup,
    language_model,
    lexical_search,
    licenses,
    ngram_join,
    packing,
    pieces,
    quality,
    simhash,
    spotsigs,
    toxicity,
    warc,
    whitening,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    new, history = exact_dedup.split_history(table(spark, sf_dir, "documents"))
    found = exact_dedup.exact_duplicates(new, history)
    return found.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_digests(table(spark, sf_dir, "documents"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_summary(licenses.license_places(table(spark, sf_dir, "documents")))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.toxicity(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best and n-th best segmentation of every text, decoded again."""
    docs = table(spark, sf_dir, "documents")
    found = pieces.encode(docs)
    return found.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_pieces"),
        F.crc32("ids").alias("ids_crc32"),
        F.sha2(pieces.decode_udf()("ids"), 256).alias("decoded_sha256"),
        F.col("score").alias("best_score"),
        (F.size("alternatives") + 1).cast("long").alias("n_best"),
        F.coalesce(F.array_min("alternatives.score"), "score").alias("last_score"),
    )


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_archives(manifest).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.grades(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_texts(table(spark, sf_dir, "documents"))


def op10_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.edited_likeness(table(spark, sf_dir, "documents")).drop("signatures")


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_texts(table(spark, sf_dir, "documents"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = lexical_search.index(table(spark, sf_dir, "documents"))
    return lexical_search.best_documents(blocks, table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Query]:
    return {
        q.__name__: q
        for q in (
            op1_exact_dedup,
            op2_best_fit_packing,
            op3_simhash_near_dedup,
            op4_license_scan,
            op5_toxicity,
            op6_sentencepiece,
            op7_warc,
            op8_quality_classifier,
            op9_language_model,
            op10_spotsigs,
            op11_ngram_join,
            op12_embedding_whitening,
            op13_lexical_search,
        )
    }


# Oracle SQL. What SQL cannot express is tested against brute force in tests/llm.

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1_SQL = f"""
    WITH hashed AS (SELECT doc_id, sha256({LOWER}) AS text_sha256 FROM documents),
    classed AS (
        SELECT *, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
               count(*) OVER (PARTITION BY text_sha256) AS group_size
        FROM hashed
    )
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM classed
"""


# Base 32 of the digest: hex digits to bits, and five bits to each letter.
BIT = "CAST(substr(bits, 5 * i + {n}, 1) AS INT)"
FIVE = " + ".join(f"{16 >> n} * {BIT.format(n=n + 1)}" for n in range(5))
OP7_SQL = f"""
    WITH payloads AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    hashed AS (
        SELECT page_id, strlen(html) AS payload_bytes, html,
               list_aggregate([lpad(bin(strpos('0123456789abcdef', c) - 1), 4, '0')
                               for c in string_split(sha1(html), '')], 'string_agg', '') AS bits
        FROM payloads
    ),
    named AS (
        SELECT page_id, payload_bytes, min(page_id) OVER (PARTITION BY html) AS first,
               list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + {FIVE}, 1)
                               for i in range(32)], 'string_agg', '') AS payload_digest
        FROM hashed
    )
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> first THEN first END AS refers_to
    FROM named
"""


# Rows are told apart by number: texts may be missing or repeated.
OP11_SQL = f"""
    WITH RECURSIVE texts AS (
        SELECT doc_id, row_number() OVER () AS r,
               [x for x in regexp_split_to_array({LOWER}, '[\\x20\\x09-\\x0D]+') if x <> ''] AS w
        FROM documents
    ),
    words AS (SELECT r, len(w) AS k, generate_subscripts(w, 1) AS p, unnest(w) AS word FROM texts),
    runs AS (
        SELECT r, k, p, concat_ws(' ', word, lead(word) OVER o, lead(word, 2) OVER o,
                                  lead(word, 3) OVER o, lead(word, 4) OVER o) AS run
        FROM words WINDOW o AS (PARTITION BY r ORDER BY p)
    ),
    singles AS (SELECT DISTINCT r, hash(run) AS h FROM runs WHERE p <= greatest(k - 4, 1)),
    shingles AS (SELECT r, h, count(*) OVER (PARTITION BY r) AS n FROM singles),
    links AS (
        SELECT a.r AS a, b.r AS b
        FROM shingles a JOIN shingles b ON a.h = b.h AND a.r <> b.r
        GROUP BY a.r, b.r, a.n, b.n
        HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
    ),
    reached AS (
        SELECT r AS a, r AS b FROM texts
        UNION
        SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
    ),
    named AS (SELECT a AS r, min(doc_id) AS component_id
              FROM reached JOIN texts ON texts.r = reached.b GROUP BY a),
    sizes AS (SELECT r, count(*) AS n FROM singles GROUP BY r)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
    FROM texts JOIN named USING (r) LEFT JOIN sizes USING (r)
"""

TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
OP13_SQL = f"""
    WITH held AS (SELECT doc_id, regexp_extract_all({LOWER}, '{TERM}') AS t FROM documents),
    docs AS (SELECT doc_id, t, len(t) AS n FROM held WHERE len(t) > 0),
    totals AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM docs),
    tf AS (SELECT doc_id, n, term, count(*) AS tf
           FROM (SELECT doc_id, n, unnest(t) AS term FROM docs) GROUP BY doc_id, n, term),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
    asked AS (SELECT item_id, unnest(regexp_extract_all({LOWER}, '{TERM}')) AS term FROM benchmark),
    weighed AS (
        SELECT item_id, term, count(*) AS uses,
               CAST(floor(1000 * ln((2 * big_n + 2) / (2 * df + 1))) AS BIGINT) AS w
        FROM asked JOIN df USING (term), totals GROUP BY item_id, term, df, big_n
    ),
    scored AS (
        SELECT item_id, doc_id,
               CAST(sum(uses * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * big_n) // big_l))))
                    AS BIGINT) AS score
        FROM weighed JOIN tf USING (term), totals GROUP BY item_id, doc_id
    ),
    ranked AS (SELECT item_id, doc_id, score,
                      CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank
               FROM scored WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_dedup": OP1_SQL,
        "op7_warc": OP7_SQL,
        "op11_ngram_join": OP11_SQL,
        "op13_lexical_search": OP13_SQL,
    }
