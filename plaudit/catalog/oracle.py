"""The registered queries as SQL over the same tables."""

from __future__ import annotations

from collections.abc import Iterable

from plaudit.catalog import corpus
from plaudit.functions import presets


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values: Iterable[str]) -> str:
    return "(" + ", ".join(_text(value) for value in values) + ")"


def _pairs(values: dict[str, float]) -> str:
    return ", ".join(f"({_text(word)}, {value!r}::DOUBLE)" for word, value in sorted(values.items()))


ASCII_CUT = r"'[ \t\n\x0B\f\r]'"
UNICODE_CUT = (
    r"'[ \t\n\x0B\f\r\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+'"
)

PLACE = "CAST('0x' || substring(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) % 100"

RAW_WORDS = f"""
all_words AS (
  SELECT doc_id, {PLACE} AS place, unnest(string_split_regex(lower(text), {ASCII_CUT})) AS word
  FROM documents)"""

WORDS = f"""{RAW_WORDS},
words AS (
  SELECT * FROM all_words
  WHERE word <> '' AND word NOT IN {_list(presets.ENGLISH_STOP_WORDS)})"""

FRACTION_ROWS = ", ".join(f"({p})" for p in presets.FRACTIONS)

LISTED = f"lexicon(word, polarity) AS (VALUES {_pairs(corpus.LEXICON.polarity)})"
SCORED = f"""
{LISTED},
modifiers(word, intensity) AS (VALUES {_pairs(corpus.LEXICON.intensity)}),
split_texts AS (
  SELECT doc_id, regexp_extract_all(lower(text), '\\p{{L}}+(?:''\\p{{L}}+)*') AS ws FROM documents),
placed AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM split_texts),
neighbours AS (
  SELECT doc_id, w, lag(w, 1, '') OVER seq AS p1, lag(w, 2, '') OVER seq AS p2
  FROM placed WINDOW seq AS (PARTITION BY doc_id ORDER BY pos)),
hits AS (
  SELECT n.doc_id, CAST(round(
      least(1.0::DOUBLE, greatest(-1.0::DOUBLE, l.polarity * coalesce(m.intensity, 1.0::DOUBLE)))
      * CASE WHEN n.p1 IN {_list(corpus.LEXICON.negations)}
               OR (n.p2 IN {_list(corpus.LEXICON.negations)} AND (m.word IS NOT NULL OR length(n.p1) = 1))
             THEN -0.5::DOUBLE ELSE 1.0::DOUBLE END * 1000000.0::DOUBLE) AS BIGINT) AS unit
  FROM neighbours n JOIN lexicon l ON n.w = l.word LEFT JOIN modifiers m ON n.p1 = m.word),
summed AS (SELECT doc_id, sum(unit) AS s, count(*) AS c FROM hits GROUP BY doc_id),
polarities AS (
  SELECT d.doc_id, d.text, coalesce(CAST(s AS DOUBLE) / (CAST(c AS DOUBLE) * 1000000.0::DOUBLE), 0.0::DOUBLE) AS polarity
  FROM documents d LEFT JOIN summed USING (doc_id)),
scored AS (
  SELECT *, CASE WHEN polarity > 0.05::DOUBLE THEN 'positive'
                 WHEN polarity < -0.05::DOUBLE THEN 'negative' ELSE 'neutral' END AS category
  FROM polarities)"""

CATEGORY_ROWS = ", ".join(f"({_text(name)})" for name in presets.CATEGORIES)
COUNTS = f"""
categories(category) AS (VALUES {CATEGORY_ROWS}),
counts AS (
  SELECT c.category, count(s.doc_id) AS count
  FROM categories c LEFT JOIN scored s USING (category) GROUP BY c.category)"""

KEYWORD_HIT = " OR ".join(f"contains(lower(text), {_text(word)})" for word in corpus.KEYWORDS)

# A review lies in the five windows that start in the five minutes up to its own.
WINDOWED = f"""{SCORED},
sent AS (
  SELECT s.*, e.ts FROM scored s JOIN events e ON e.event_id = s.doc_id WHERE {KEYWORD_HIT}),
sent_words AS (
  SELECT epoch_us(date_trunc('minute', ts)) // 1000000 AS minute, category,
         unnest(string_split_regex(lower(text), {UNICODE_CUT})) AS word
  FROM sent),
in_windows AS (
  SELECT minute - 60 * back AS window_start, minute - 60 * back + 300 AS window_end, word, category
  FROM sent_words, (VALUES (0), (1), (2), (3), (4)) b(back)
  WHERE word <> '' AND word NOT IN {_list(presets.STREAM_STOP_WORDS)}),
window_counts AS (
  SELECT window_start, window_end, word, count(*) AS total,
         count(*) FILTER (category = 'positive') AS positive,
         count(*) FILTER (category = 'negative') AS negative,
         count(*) FILTER (category = 'neutral') AS neutral
  FROM in_windows GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY total DESC, word) AS rank FROM window_counts)"""

# The long lexicon: all words of the documents, polarities by hash.
HASHED = f"""lexicon AS (
  SELECT DISTINCT word, (CAST('0x' || substring(md5(word), 1, 8) AS BIGINT) % 2001 - 1000) / 1000.0::DOUBLE AS polarity
  FROM (SELECT unnest(regexp_extract_all(lower(text), '\\p{{L}}+(?:''\\p{{L}}+)*')) AS word FROM documents))"""
SENT = f"""
SELECT doc_id AS review_id, lower(text) AS "cleaned_reviewText", epoch_us(ts) AS send_us, polarity, category
FROM scored JOIN events ON event_id = doc_id WHERE {KEYWORD_HIT}"""

LIMIT_ROWS = ", ".join(f"({label}, {n})" for label, n in corpus.ROW_LIMITS.items())
LIMITS = f"""
limits(pct, n) AS (VALUES {LIMIT_ROWS}),
numbered AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS nth FROM documents WHERE doc_id IS NOT NULL)"""

FREQUENCY = f"WITH {WORDS} SELECT word, count(*) AS frequency FROM words GROUP BY word"
TOP = f"{FREQUENCY} ORDER BY frequency DESC, word LIMIT {presets.TOP_WORDS}"
SWEEP = f"""WITH {WORDS}, fractions(pct) AS (VALUES {FRACTION_ROWS})
SELECT pct, word, count(*) AS frequency FROM words JOIN fractions ON place < pct GROUP BY pct, word"""
SCORES = f"WITH {SCORED} SELECT doc_id, polarity, category FROM scored"
CLEAN_ONLY = "SELECT lower(text) AS \"cleaned_reviewText\" FROM documents"
CLEAN = "SELECT doc_id, lower(text) AS \"cleaned_reviewText\" FROM documents"
PUNCT = r"""[!-/:-@\[-`{-~]"""

ORACLE: dict[str, str] = {
    "ingest_clean": f"{CLEAN} WHERE regexp_matches(text, '\\S')",
    "ingest_json": f"{CLEAN_ONLY} WHERE text IS NOT NULL",
    "malformed_lines": "SELECT regexp_replace(html, '[\\r\\n]', ' ', 'g') AS line FROM pages",
    "ingest_quarantine": """
SELECT 'clean' AS status, doc_id AS review_id, lower(text) AS "cleaned_reviewText", CAST(NULL AS VARCHAR) AS line, false AS has_file
FROM documents WHERE text IS NOT NULL
UNION ALL SELECT 'without_text', doc_id, NULL, CAST(to_json({doc_id: doc_id}) AS VARCHAR), true FROM documents WHERE text IS NULL
UNION ALL SELECT 'without_text', NULL, NULL, CAST(props AS VARCHAR), true FROM events
UNION ALL SELECT 'malformed', NULL, NULL, regexp_replace(html, '[\\r\\n]', ' ', 'g'), true FROM pages""",
    "mixed_files_convert": """
SELECT NULL AS own_id, lower(text) AS "cleaned_reviewText" FROM documents WHERE lang IS DISTINCT FROM 'en'
UNION ALL SELECT 'doc ' || doc_id, lower(text) FROM documents WHERE lang = 'en'
UNION ALL SELECT CAST(doc_id AS VARCHAR), lower(text) FROM documents WHERE doc_id % 3 = 1""",
    "json_glob": f"{CLEAN_ONLY} WHERE regexp_matches(text, '\\S')",
    "incremental_convert": CLEAN_ONLY,
    "incremental_convert_stream": CLEAN_ONLY,
    "report_json": TOP,
    "output_size": "SELECT count(*) AS rows, true AS bytes_match, true AS gib_match FROM documents WHERE regexp_matches(text, '\\S')",
    "source_files": "SELECT lang, count(*) AS rows, true AS listed FROM documents GROUP BY lang",
    "partition_report": "SELECT count(*) AS rows, 16 AS partitions FROM documents",
    "bernoulli_sample": "SELECT true AS subset, true AS same_again, true AS size_fits",
    "exclude_texts": f"{CLEAN} WHERE regexp_matches(text, '\\S') AND lower(text) NOT IN {_list(corpus.PLACEHOLDERS)}",
    "keyword_filter": f"{CLEAN} WHERE {KEYWORD_HIT}",
    "keyword_filter_whole_word": f"""{CLEAN}
WHERE regexp_matches(lower(text), '(^|[^\\p{{L}}])({"|".join(corpus.WHOLE_WORDS)})([^\\p{{L}}]|$)')""",
    "keyword_table_filter": f"""
WITH cut AS (SELECT text, string_split_regex(text, '[ \\t\\n\\x0B\\f\\r]+') AS words FROM benchmark),
keywords AS (
  SELECT DISTINCT lower(keyword) AS keyword FROM (
    SELECT unnest(words) AS keyword FROM cut UNION ALL SELECT array_to_string(words[1:4], ' ') FROM cut)
  WHERE length(keyword) >= 12 OR contains(keyword, ' '))
{CLEAN} WHERE regexp_matches(text, '\\S') AND EXISTS (SELECT 1 FROM keywords WHERE contains(lower(text), keyword))""",
    "default_keyword_filter": f"{CLEAN} WHERE "
    + " OR ".join(f"contains(lower(text), {_text(word)})" for word in presets.STREAM_KEYWORDS),
    "sample_fraction": f"SELECT doc_id, text FROM documents WHERE {PLACE} < 40",
    "bernoulli_sample_all": "SELECT doc_id FROM documents",
    "word_frequency": FREQUENCY,
    "word_frequency_sorted": FREQUENCY,
    "word_frequency_with_empty": f"""
WITH trimmed AS (SELECT lower(text) AS t, regexp_replace(lower(text), '[ \\t\\n\\x0B\\f\\r]+$', '') AS b FROM documents),
w AS (SELECT unnest(string_split_regex(b, {ASCII_CUT})) AS word FROM trimmed WHERE b <> '' OR t = '')
SELECT word, count(*) AS frequency FROM w GROUP BY word""",
    "word_frequency_stripped": f"""
WITH {RAW_WORDS}, w AS (
  SELECT regexp_replace(regexp_replace(word, '^{PUNCT}+', ''), '{PUNCT}+$', '') AS word FROM all_words)
SELECT word, count(*) AS frequency FROM w
WHERE word <> '' AND word NOT IN {_list(presets.ENGLISH_STOP_WORDS)} GROUP BY word""",
    "word_frequency_stop_table": f"""
WITH {RAW_WORDS}, stop AS (SELECT unnest(string_split_regex(lower(text), {ASCII_CUT})) AS word FROM benchmark)
SELECT word, count(*) AS frequency FROM all_words
WHERE word <> '' AND word NOT IN (SELECT word FROM stop) GROUP BY word""",
    "top_words": TOP,
    "top_words_limited": f"""
WITH first_rows AS (SELECT * FROM documents ORDER BY doc_id LIMIT {corpus.TOP_LIMITED_ROWS}),
w AS (SELECT unnest(string_split_regex(lower(text), {ASCII_CUT})) AS word FROM first_rows)
SELECT word, count(*) AS frequency FROM w
WHERE word <> '' AND word NOT IN {_list(presets.ENGLISH_STOP_WORDS)}
GROUP BY word ORDER BY frequency DESC, word LIMIT {presets.TOP_WORDS}""",
    "row_limit_words": f"""
WITH {WORDS}, {LIMITS}
SELECT pct, word, count(*) AS frequency FROM words JOIN numbered USING (doc_id) JOIN limits ON nth <= n
GROUP BY pct, word""",
    "stream_word_frequency": f"""
WITH w AS (SELECT unnest(string_split_regex(lower(text), {UNICODE_CUT})) AS word FROM documents)
SELECT word, count(*) AS frequency FROM w
WHERE word <> '' AND word NOT IN {_list(presets.STREAM_STOP_WORDS)} GROUP BY word""",
    "fraction_sweep": SWEEP,
    "fraction_sweep_range_join": SWEEP,
    "fraction_tables": SWEEP,
    "sentiment_scores": SCORES,
    "sentiment_scores_arrow": SCORES,
    "sentiment_scores_join": SCORES,
    "sentiment_scores_salted": SCORES,
    "sentiment_counts_limited": f"""
WITH {SCORED}, {COUNTS.replace("LEFT JOIN scored s", f"LEFT JOIN (SELECT * FROM scored ORDER BY doc_id LIMIT {corpus.TOP_LIMITED_ROWS}) s")}
SELECT category, count FROM counts""",
    "row_limit_metrics": f"""
WITH {SCORED}, {LIMITS}, within AS (SELECT * FROM scored JOIN numbered USING (doc_id) JOIN limits ON nth <= n)
SELECT pct, count(doc_id) AS total_records, round(coalesce(avg(polarity), 0.0::DOUBLE), 6) AS avg_sentiment,
       count(doc_id) FILTER (category = 'positive') AS positive_count,
       count(doc_id) FILTER (category = 'negative') AS negative_count,
       count(doc_id) FILTER (category = 'neutral') AS neutral_count
FROM limits LEFT JOIN within USING (pct) GROUP BY pct""",
    "sentiment_counts": f"WITH {SCORED}, {COUNTS} SELECT category, count FROM counts",
    "sentiment_mean": f"WITH {SCORED} SELECT round(coalesce(avg(polarity), 0.0::DOUBLE), 6) AS avg_sentiment FROM scored",
    "sentiment_share": f"""
WITH {SCORED}, {COUNTS}
SELECT category, count, round(count / (SELECT count(*) FROM documents)::DOUBLE, 6) AS share,
       category || ' (' || count || ')' AS label FROM counts""",
    "run_metrics": f"""
WITH {SCORED}
SELECT count(*) AS total_records, round(coalesce(avg(polarity), 0.0::DOUBLE), 6) AS avg_sentiment,
       count(*) FILTER (category = 'positive') AS positive_count,
       count(*) FILTER (category = 'negative') AS negative_count,
       count(*) FILTER (category = 'neutral') AS neutral_count FROM scored""",
    # A kept input is scanned by the first task alone, another by each task that uses it.
    "run_tasks": """
SELECT * FROM (VALUES (true, 'read', true), (true, 'words', false), (true, 'sentiment', false),
  (false, 'read', false), (false, 'words', true), (false, 'sentiment', true)) t(kept, task, scans)""",
    "fraction_metrics": f"""
WITH {SCORED}, fractions(pct) AS (VALUES {FRACTION_ROWS})
SELECT pct, count(doc_id) AS total_records, round(coalesce(avg(polarity), 0.0::DOUBLE), 6) AS avg_sentiment,
       count(doc_id) FILTER (category = 'positive') AS positive_count,
       count(doc_id) FILTER (category = 'negative') AS negative_count,
       count(doc_id) FILTER (category = 'neutral') AS neutral_count
FROM fractions LEFT JOIN scored ON {PLACE} < pct GROUP BY pct""",
    "profile": f"""
WITH {WORDS}, {SCORED}, {COUNTS},
best AS (
  SELECT word, count(*) AS n FROM words GROUP BY word ORDER BY n DESC, word LIMIT {presets.TOP_WORDS})
SELECT 'words' AS task, word AS key, n AS value FROM best
UNION ALL SELECT 'sentiment', category, count FROM counts""",
    "run_compare": f"""
WITH sides AS (
  SELECT user_id AS task,
         max(value) FILTER (event_type = {_text(corpus.COMPARED_MODES[0])}) AS b,
         max(value) FILTER (event_type = {_text(corpus.COMPARED_MODES[1])}) AS o
  FROM events WHERE event_type IN {_list(corpus.COMPARED_MODES)} GROUP BY user_id)
SELECT task, b AS base_seconds, o AS other_seconds, printf('%.3f s', b) AS base_label,
       printf('%.3f s', o) AS other_label,
       round(CASE WHEN o > 0 THEN b / o WHEN o <= 0 THEN 1.0::DOUBLE END, 6) AS speedup FROM sides""",
    "window_word_counts": f"WITH {WINDOWED} SELECT * FROM window_counts",
    "window_top_words": f"WITH {WINDOWED} SELECT * FROM ranked WHERE rank <= {presets.WINDOW_TOP_WORDS}",
    # A stream closes the windows that end before its latest record less the delay.
    "window_top_words_stream": f"""
WITH {WINDOWED}
SELECT * FROM ranked WHERE rank <= {presets.WINDOW_TOP_WORDS}
  AND window_end * 1000000 <= (SELECT max(epoch_us(ts)) FROM sent) - {corpus.REPLAY_DELAY_SECONDS} * 1000000""",
    "scored_records_stream": f"""
WITH {WINDOWED}
SELECT doc_id AS review_id, lower(text) AS "cleaned_reviewText", epoch_us(ts) AS send_us, polarity, category FROM sent""",
    "event_times": "SELECT event_id, epoch_us(ts) / 1000000.0::DOUBLE AS send_time, epoch_us(ts) AS send_us FROM events",
    "publish_roundtrip": """
SELECT doc_id AS review_id, lower(text) AS "cleaned_reviewText", epoch_us(ts) AS send_us
FROM documents JOIN events ON event_id = doc_id""",
    "dedup_stream": """
SELECT doc_id AS review_id, lower(text) AS "cleaned_reviewText" FROM documents JOIN events ON event_id = doc_id""",
    "late_rows_stream": f"""
WITH sent AS (SELECT doc_id, text, epoch_us(ts) AS us FROM documents JOIN events ON event_id = doc_id)
SELECT doc_id AS review_id, lower(text) AS "cleaned_reviewText" FROM sent
WHERE doc_id % 10 <> 0
   OR us // 1000 > (SELECT max(us) // 1000 FROM sent WHERE doc_id % 10 <> 0) - {corpus.LATE_DELAY_SECONDS} * 1000""",
    "late_drops_stream": f"""
WITH sent AS (SELECT doc_id, epoch_us(ts) AS us FROM documents JOIN events ON event_id = doc_id WHERE text IS NOT NULL),
marked AS (
  SELECT *, doc_id % 10 = 0
    AND us < (SELECT max(us) FROM sent WHERE doc_id % 10 <> 0) - {corpus.LATE_DELAY_SECONDS}::BIGINT * 1000000 AS late FROM sent)
SELECT count(*) AS records, count(*) FILTER (NOT late) AS kept, count(*) FILTER (late) AS late, 0 AS repeats FROM marked""",
    "late_progress_stream": f"""
WITH sent AS (SELECT doc_id, epoch_us(ts) AS us FROM documents JOIN events ON event_id = doc_id WHERE text IS NOT NULL),
marked AS (
  SELECT *, doc_id % 10 = 0
    AND us // 1000 <= (SELECT max(us) // 1000 FROM sent WHERE doc_id % 10 <> 0) - {corpus.LATE_DELAY_SECONDS}::BIGINT * 1000 AS late FROM sent)
SELECT count(*) AS records, count(*) FILTER (NOT late) AS kept, count(*) FILTER (late) AS late FROM marked""",
    "scored_records_large_lexicon_stream": f"WITH {SCORED.replace(LISTED, HASHED)} {SENT}",
    "sentiment_scores_large_lexicon": f"WITH {SCORED.replace(LISTED, HASHED)} SELECT doc_id, polarity, category FROM scored",
    "crash_restart_stream": f"WITH {SCORED} {SENT}",
    "restart_stream": """
SELECT doc_id AS review_id, lower(text) AS "cleaned_reviewText" FROM documents JOIN events ON event_id = doc_id""",
    "pipeline_stream": f"""
WITH {SCORED}
SELECT lower(text) AS "cleaned_reviewText", polarity, category FROM scored WHERE {KEYWORD_HIT}""",
    "quarantine_stream": """
SELECT html AS value, 'not valid JSON' AS problem FROM pages
UNION ALL SELECT props, 'no text' FROM events
UNION ALL SELECT CAST(to_json({cleaned_reviewText: text, send_time: 0.5::DOUBLE}) AS VARCHAR), 'no id' FROM benchmark""",
    "publish_new_files_stream": 'SELECT doc_id AS review_id, lower(text) AS "cleaned_reviewText" FROM documents',
}
