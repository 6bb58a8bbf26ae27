"""The queries of the operators and of the pipeline, and SQL for what SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import conversation_repair, decontamination, exact_dedup, extraction, jaccard_join, packing, pii, quality, records, resampling, sharding, suffix_dedup, token_counts


def tokenizer(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), 16)


def op2_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "class_distance", "word_distance")
    return quality.quality(table(spark, sf_dir, "documents")).select(*columns)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), tokenizer())


def op7_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.token_records(table(spark, sf_dir, "documents"), tokenizer()).drop("ids")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer())


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(table(spark, sf_dir, "documents"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversation_repair.report(conversation_repair.damaged(rows), rows)


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_sharding, op2_extraction, op3_jaccard_join, op4_suffix_dedup, op5_quality, op6_packing, op7_records, op8_token_counts, op9_decontamination, op10_pii, op11_exact_dedup, op12_conversation_repair, op13_resampling)
}

ORACLE_SQL: dict[str, str] = {
    "op3_jaccard_join": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), shingles AS (
            SELECT DISTINCT doc_id, unnest(CASE
                WHEN len(w) = 0 THEN []
                WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
            FROM words
        ), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
        ), common AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
            FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
        ), links AS (
            SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 75 * (p.n + q.n - c)
        ), edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links
        ), reach AS (
            SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, e.y FROM reach r JOIN edges e ON r.y = e.x
        )
        SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
        FROM documents d LEFT JOIN sizes USING (doc_id) JOIN (SELECT x, min(y) AS component_id FROM reach GROUP BY x) c ON c.x = d.doc_id
    """,
    "op11_exact_dedup": r"""
        WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, sha256(text) AS text_sha256
        FROM t WINDOW w AS (PARTITION BY text)
    """,
    "op13_resampling": r"""
        WITH bits AS (
            SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS crc
        ), words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
        ), aims AS (
            SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS f FROM benchmark
        ), own AS (SELECT doc_id, unnest(w) AS f FROM words
        ), distinct_words AS (SELECT f, hex(encode(f)) AS x FROM (SELECT f FROM own UNION SELECT f FROM aims)
        ), hashed AS (
            SELECT f, xor(list_reduce(list_transform(range(1, len(x), 2), lambda i: ('0x' || substr(x, i, 2))::BIGINT), lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket
            FROM distinct_words, bits
        ), s AS (SELECT bucket, count(*) AS s FROM own JOIN hashed USING (f) GROUP BY bucket
        ), t AS (SELECT bucket, count(*) AS t FROM aims JOIN hashed USING (f) GROUP BY bucket
        ), gains AS (
            SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM own) + 10000) / ((s + 1)::DOUBLE * ((SELECT count(*) FROM aims) + 10000))))::BIGINT AS gain FROM s LEFT JOIN t USING (bucket)
        ), means AS (SELECT doc_id, floor(sum(gain) / count(*))::BIGINT AS weight FROM own JOIN hashed USING (f) JOIN gains USING (bucket) GROUP BY doc_id
        ), scored AS (
            SELECT doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
                coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
            FROM words LEFT JOIN means USING (doc_id)
        ), able AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
        SELECT doc_id, n_features, weight, score, r::BIGINT AS rank FROM scored LEFT JOIN (SELECT doc_id, r FROM able WHERE r <= 10 * n // 100) USING (doc_id)
    """,
}
