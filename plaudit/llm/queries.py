"""One registered query per operator, over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

import zlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from plaudit.llm import audit, forest, itq, minhash, mixing, pieces, pii, quality, rules, secrets, spelling, tokens, toxicity
from plaudit.llm.common import remainder, table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scores = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scores.select(
        "doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = F.col("_mix")
    return mixing.mixed(table(spark, sf_dir, "documents")).select(
        "doc_id", mix.size.alias("size"), mix.source_size.alias("source_size"), mix.target.alias("target"),
        (mix.size * mix.copies).alias("taken"),
    )


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.nearest(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 50 == 0)


def op5_near_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq.near_embeddings(table(spark, sf_dir, "embeddings")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    )


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(table(spark, sf_dir, "documents"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(table(spark, sf_dir, "documents"))


def op9_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.groups(table(spark, sf_dir, "documents")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    )


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scores = quality.fit_and_score(docs, table(spark, sf_dir, "labels"))
    return scores.select(
        "doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return rules.judged(docs, rules.references(docs)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES = {
    query.__name__: query
    for query in (
        op1_toxicity, op2_mix_sources, op3_token_counts, op4_nearest,
        op5_near_embeddings, op6_personal_data, op7_sentencepiece, op8_secrets, op9_near_copies,
        op10_quality, op11_quality_rules, op12_filter_audit, op13_spelling_variants,
    )
}

#: The CRC-32 of each byte, by the rule of its polynomial (fixed value).
CRC_TABLE = ", ".join(str(zlib.crc32(bytes([byte]), 0xFFFFFFFF) ^ 0xFFFFFFFF) for byte in range(256))

ORACLE = {
    "op2_mix_sources": r"""
        WITH sized AS (
            SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
            FROM documents
        ), sources AS (
            SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
        ), ranked AS (
            SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight,
                source_size * 3 AS most
            FROM sources
        ), leveled AS (
            SELECT *, (sum(source_size) OVER () - coalesce(sum(most) OVER (
                    ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                )::DOUBLE / (sum(weight) OVER (
                    ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
                )::DOUBLE AS level
            FROM ranked
        ), targets AS (
            SELECT source, source_size, least(max(level) OVER () * weight, most::DOUBLE) AS target FROM leveled
        ), rated AS (
            SELECT d.doc_id, d.size, t.source_size, t.target,
                CASE WHEN t.source_size > 0 THEN least(t.target / t.source_size, 3.0::DOUBLE) ELSE 0 END AS rate,
                ('0x' || substr(md5('mix:' || coalesce(d.doc_id::VARCHAR, '')), 1, 13))::BIGINT
                    / 4503599627370496.0::DOUBLE AS draw
            FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
        )
        SELECT doc_id, size, source_size, target,
            size * (floor(rate)::BIGINT + (draw < rate - floor(rate))::BIGINT) AS taken
        FROM rated
    """,
    "op12_filter_audit": r"""
        WITH texts AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
                regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
            FROM documents
        ), failed AS (
            SELECT doc_id, part,
                CASE WHEN len(words) < 100 THEN 1 ELSE 0 END
                + CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 2 ELSE 0 END
                + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 4 ELSE 0 END
                + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
                + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask
            FROM texts
        ), marks AS (
            SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS bad
            FROM labels GROUP BY doc_id
        ), counts AS (
            SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(bad, 0)) AS bad
            FROM failed LEFT JOIN marks USING (doc_id) GROUP BY part, mask
        ), letters(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)
        ), orders AS (
            SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
            FROM letters a, letters b, letters c, letters d, letters e
            WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31
        ), steps AS (
            SELECT filter_order, step, l.bit,
                coalesce((SELECT sum(p.bit) FROM letters p WHERE contains(substr(filter_order, 1, step - 1), p.letter)), 0)::INT AS earlier
            FROM orders, (VALUES (1), (2), (3), (4), (5)) s(step), letters l WHERE l.letter = substr(filter_order, step, 1)
        ), numbers AS (
            SELECT part, filter_order, step, bit,
                sum(n) FILTER (mask & (earlier | bit) = 0) AS kept,
                sum(n) FILTER (mask & earlier = 0 AND mask & bit <> 0) AS removed,
                sum(n) FILTER (mask & earlier <> 0 AND mask & bit <> 0) AS redundant,
                sum(n) FILTER (mask = bit) AS unique_fails,
                sum(good) FILTER (mask & earlier = 0 AND mask & bit <> 0) AS good_lost,
                sum(bad) FILTER (mask & earlier = 0 AND mask & bit <> 0) AS toxic_lost
            FROM counts, steps GROUP BY part, filter_order, step, bit, earlier
        )
        SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
            coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
            coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
            coalesce(sum(removed) OVER (PARTITION BY part, bit), 0)::BIGINT AS shapley
        FROM numbers
    """,
    "op13_spelling_variants": rf"""
        WITH runs AS (
            SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run
            FROM documents
        ), once AS (
            SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS keyed, run, count(*) AS n FROM runs GROUP BY doc_id, run
        ), hashed AS (
            SELECT run, n, xor(list_reduce(
                list_prepend(4294967295::BIGINT, list_transform(
                    range(0, strlen(keyed)), lambda i: ('0x' || substr(hex(encode(keyed)), 2 * i + 1, 2))::BIGINT)),
                lambda crc, byte: xor(crc >> 8, [{CRC_TABLE}][(xor(crc, byte) & 255) + 1])), 4294967295::BIGINT) AS h
            FROM once
        ), dropped AS (
            SELECT CASE WHEN h % 97 = 0
                THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n
            FROM hashed
        ), words AS (
            SELECT word, sum(n)::BIGINT AS n FROM dropped WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
        ), shorter AS (
            SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
            FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)
        ), pairs AS (
            SELECT a.word, b.word AS near FROM shorter a JOIN shorter b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
            UNION ALL SELECT DISTINCT s.word, s.rest FROM shorter s JOIN words w ON w.word = s.rest
            UNION ALL SELECT DISTINCT s.rest, s.word FROM shorter s JOIN words w ON w.word = s.rest
        ), best AS (
            SELECT p.word, w.n, p.near, v.n AS near_n, count(*) OVER (PARTITION BY p.word) AS n_near,
                row_number() OVER (PARTITION BY p.word ORDER BY v.n DESC, encode(p.near)) AS place
            FROM pairs p JOIN words w ON w.word = p.word JOIN words v ON v.word = p.near
        ), formed AS (
            SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN near_n >= 2 * w.n THEN near END AS form,
                CASE WHEN near_n >= 2 * w.n THEN near_n END AS form_n
            FROM words w LEFT JOIN (SELECT * FROM best WHERE place = 1) b ON b.word = w.word
        ), chains AS (
            WITH RECURSIVE chain AS (
                SELECT word, word AS root, 0 AS far FROM formed
                UNION ALL SELECT c.word, f.form, far + 1 FROM chain c JOIN formed f ON f.word = c.root WHERE f.form IS NOT NULL
            ) SELECT word, arg_max(root, far) AS root FROM chain GROUP BY word
        )
        SELECT word, form, root, n, n_near, form_n FROM formed JOIN chains USING (word)
    """,
}
