"""Registered queries of the subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.llm import alignment, bpe, chat_format, exact_dedup, importance, jaccard_join, kdtree_search, labelled, license_scan, packing, pii, quality, sharding, toxicity
from paddock.llm.common import LOWER, UPPER, materialise, table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def pack_digests(docs: DataFrame) -> DataFrame:
    """Pack every document; of each piece's ids only their CRC-32 goes on."""
    pieces = packing.tokenise(docs, RANKS, PATTERN).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    packed = packing.place(materialise(docs.sparkSession, pieces, "pieces"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_digests(table(spark, sf_dir, "documents"))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.repair(table(spark, sf_dir, "conversations"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def bpe_digests(docs: DataFrame) -> DataFrame:
    """Encode every text, decode the ids, and digest both."""
    coded = bpe.decode(bpe.encode(docs, RANKS, PATTERN), RANKS)
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.ToxicityModel:
    return toxicity.train(docs, table(spark, sf_dir, "labels"), F.col("toxic"))


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality.OrdinalModel:
    """Grades 0: junk, 1: well-formed but toxic, 2: good."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("quality") == 1, 2)
    return quality.train(docs, table(spark, sf_dir, "labels"), grade, 3)


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality_model(spark, docs, sf_dir))
    return scored.withColumn("selected", F.col(quality.TAIL) >= 0.5)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity_model(spark, docs, sf_dir))
    return scored.select("doc_id", labelled.held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"), "clauses")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op10_kdtree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kdtree_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.spans(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    counts = [F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}") for kind in pii.KINDS]  # noqa: B023
    return found.select("doc_id", *counts, F.sha2(F.encode(pii.written(base), "UTF-8"), 256).alias("base_sha256"),
                        pii.written(F.col("spans")).alias("spans"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.link_scores(table(spark, sf_dir, "documents"), RANKS, PATTERN, PIECES)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_chat_format": op2_chat_format,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_license_scan": op7_license_scan,
    "op8_toxicity": op8_toxicity,
    "op9_sharding": op9_sharding,
    "op10_kdtree_search": op10_kdtree_search,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_pii": op12_pii,
    "op13_token_alignment": op13_token_alignment,
}

ORACLE: dict[str, str] = {
    "op4_exact_dedup": f"""
        WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) AS text_sha256
                   FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, text_sha256
        FROM d WINDOW w AS (PARTITION BY text_sha256)""",
    # CRC-32 byte by byte over a table of 256 remainders, for distinct words.
    "op11_importance_resampling": rf"""
        WITH tab AS MATERIALIZED (
            SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
                   lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)) AS t),
        d AS MATERIALIZED (
            SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
            FROM documents),
        b AS (
            SELECT regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
            FROM benchmark),
        dw AS MATERIALIZED (SELECT r, word, count(*) AS n FROM (SELECT r, unnest(words) AS word FROM d) GROUP BY r, word),
        bw AS (SELECT word, count(*) AS n FROM (SELECT unnest(words) AS word FROM b) GROUP BY word),
        names AS (SELECT word FROM dw UNION SELECT word FROM bw),
        bytes AS (
            SELECT word, list_transform(range(1, octet_length(encode(word)) * 2, 2),
                   lambda i: ('0x' || substr(hex(encode(word)), i::BIGINT, 2))::BIGINT) AS x
            FROM names),
        hashed AS MATERIALIZED (
            SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, x),
                   lambda c, y: xor(c >> 8, t[(xor(c, y) & 255) + 1])), 4294967295::BIGINT) % 10000 AS bucket
            FROM bytes, tab),
        s AS (SELECT bucket, sum(n) AS n FROM dw JOIN hashed USING (word) GROUP BY bucket),
        t AS (SELECT bucket, sum(n) AS n FROM bw JOIN hashed USING (word) GROUP BY bucket),
        both_sizes AS (SELECT coalesce((SELECT sum(n) FROM s), 0)::DOUBLE AS sn, coalesce((SELECT sum(n) FROM t), 0)::DOUBLE AS tn),
        gain AS (
            SELECT bucket, floor(1000 * ln(((coalesce(t.n, 0) + 1)::DOUBLE * (sn + 10000)) /
                   ((coalesce(s.n, 0) + 1)::DOUBLE * (tn + 10000))))::BIGINT AS g
            FROM s FULL JOIN t USING (bucket), both_sizes),
        weighed AS (SELECT r, sum(n * g)::BIGINT AS weight FROM dw JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY r),
        scored AS (
            SELECT doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
                   coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || doc_id)[1:8])::BIGINT + 0.5::DOUBLE) /
                   4294967296::DOUBLE)))::BIGINT AS score
            FROM d LEFT JOIN weighed USING (r)),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY n_features >= 20 AND score IS NOT NULL ORDER BY score DESC, doc_id) AS place,
                   count(*) OVER (PARTITION BY n_features >= 20 AND score IS NOT NULL) AS many
            FROM scored)
        SELECT doc_id, n_features, weight, score,
               CASE WHEN n_features >= 20 AND score IS NOT NULL AND place <= many * 10 // 100 THEN place END AS rank
        FROM placed""",
}
