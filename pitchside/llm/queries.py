"""One query per operator, over its whole table and with production parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TOKENIZER = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


HELD_OUT = 5
KEEP_FROM = 0.3


def learnt(parts: int = HELD_OUT, held: int = 0) -> Column:
    """Rows that a model may learn from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts != held


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix

    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_ngram(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ngram import scores

    return scores(table(spark, sf_dir, "documents"), ~learnt(7, 2))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import fit, with_scores

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"), learnt())
    scored = with_scores(docs, model)
    return scored.select("doc_id", (~learnt()).alias("held_out"), "score", (F.col("score") >= KEEP_FROM).cast("int").alias("predicted"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import assign

    return assign(table(spark, sf_dir, "documents"))


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import archive, keyed, materialise, read_records, resolved

    pages = table(spark, sf_dir, "pages")
    root, index = archive(spark, pages)
    records = materialise(read_records(index.find(keyed(pages)), root), "warc-read")
    return resolved(records).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .rules import verdicts

    return verdicts(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed_words")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_duplicates

    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .tokenfile import write_and_read

    return write_and_read(table(spark, sf_dir, "documents"), tokenizer_path())


def op6_mpegts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mpegts import read_streams, stored

    columns = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "first_pts", "last_pts", "raps"]
    return read_streams(stored(table(spark, sf_dir, "documents"))).select(*columns)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


QUERIES = {
    "op1_warc": op1_warc,
    "op2_rules": op2_rules,
    "op3_packing": op3_packing,
    "op4_simhash": op4_simhash,
    "op5_token_files": op5_token_files,
    "op6_mpegts": op6_mpegts,
    "op7_mixing": op7_mixing,
    "op8_ngram": op8_ngram,
    "op9_quality": op9_quality,
    "op10_sharding": op10_sharding,
}

ORACLE_SQL: dict[str, str] = {
    "op1_warc": """
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
        d AS (SELECT page_id, octet_length(b) AS payload_bytes, sha256(b) AS payload_digest FROM p),
        f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM d)
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
               CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first <> page_id THEN first END AS refers_to
        FROM f""",
    # words and lines of whole texts, five-word windows, lines by host
    "op2_rules": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, source AS host, coalesce(text, '') AS text FROM documents),
        w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
        g AS (SELECT r, unnest(range(1, len(ws) - 3)) AS i, ws FROM w WHERE len(ws) >= 5),
        h AS (SELECT r, i, count(*) OVER (PARTITION BY r, ws[i], ws[i + 1], ws[i + 2], ws[i + 3], ws[i + 4]) AS c FROM g),
        n AS (SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM h, range(5) AS t(k) WHERE c > 1 GROUP BY r),
        l AS (SELECT r, doc_id, host, text, unnest(string_split(text, chr(10))) AS line FROM d),
        m AS (SELECT r, doc_id, host, text, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS ws FROM l),
        s AS (SELECT r, doc_id, host, text, line, len(ws) AS n, translate(array_to_string(ws, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM m WHERE len(ws) > 0),
        dup AS (SELECT r, sum(k - 1) AS n_dup_lines FROM (SELECT r, line, count(*) AS k FROM s GROUP BY r, line) GROUP BY r),
        x AS (SELECT host, norm, count(DISTINCT (doc_id, text)) AS docs, count(DISTINCT text) AS texts FROM s GROUP BY host, norm),
        f AS (SELECT host, text, min(doc_id) AS first FROM d GROUP BY host, text),
        gone AS (SELECT s.r, sum(s.n) AS removed_words FROM s JOIN x ON s.host IS NOT DISTINCT FROM x.host AND s.norm = x.norm JOIN f ON s.host IS NOT DISTINCT FROM f.host AND s.text = f.text
                 WHERE docs > 25 AND NOT (texts <= 25 AND s.doc_id IS NOT DISTINCT FROM first) GROUP BY s.r),
        a AS (SELECT w.r, doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars, CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                     CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(removed_words, 0) AS BIGINT) AS removed_words
              FROM w LEFT JOIN n USING (r) LEFT JOIN dup USING (r) LEFT JOIN gone USING (r)),
        b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, n_words - removed_words AS l FROM a)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, removed_words, NOT base_failed AND NOT (removed_words > 0 AND (l < 10 OR l < 0.3 * n_words)) AS kept FROM b""",
}
