"""SQL fragments for the DuckDB oracle, built from the same constants the
Spark expressions use (whitespace set, URL patterns, time bounds)."""

from __future__ import annotations

from postlake.functions.text import whitespace_chars, whitespace_class
from postlake.functions.time import EPOCH_SECONDS_MAX, EPOCH_SECONDS_MIN
from postlake.functions.url import AUTHORITY_PATTERN, BRACKETED_HOST_PATTERN, nfkc_delimiters


def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def ws_chars_sql() -> str:
    """The whitespace set as a DuckDB string expression (chr(..) || ...)."""
    return " || ".join(f"chr({ord(c)})" for c in whitespace_chars())


def strip_sql(x: str) -> str:
    return f"trim({x}, {ws_chars_sql()})"


def word_count_sql(x: str) -> str:
    return f"CAST(coalesce(len(regexp_extract_all({x}, {sql_str(whitespace_class(True) + '+')})), 0) AS INTEGER)"


def question_sql(x: str) -> str:
    return f"CAST(regexp_matches({x}, '\\?\\n?$') AS INTEGER)"


def epoch_ts_sql(x: str) -> str:
    return (f"CASE WHEN {x} BETWEEN {EPOCH_SECONDS_MIN} AND {EPOCH_SECONDS_MAX} "
            f"THEN make_timestamp(CAST({x} AS BIGINT) * 1000000) END")


def domain_sql(x: str) -> str:
    cleaned = (f"regexp_replace(regexp_replace(coalesce({x}, ''), '^[\\x00-\\x20]+', ''), "
               f"'[\\t\\r\\n]', '', 'g')")
    netloc = f"regexp_extract({cleaned}, {sql_str(AUTHORITY_PATTERN)}, 1)"
    host = f"regexp_extract({netloc}, '([^@]*)$', 1)"
    first = f"split_part(lower({netloc}), ':', 1)"
    ok = (f"((NOT contains({netloc}, '[') AND NOT contains({netloc}, ']')) OR "
          f"(contains({netloc}, '[') AND contains({netloc}, ']') AND "
          f"regexp_matches({host}, {sql_str(BRACKETED_HOST_PATTERN)})))")
    ok += f" AND NOT regexp_matches({netloc}, {sql_str('[' + nfkc_delimiters() + ']')})"
    return f"CASE WHEN {ok} AND {first} <> '' THEN {first} ELSE 'no_url' END"


def lenient_int_sql(x: str) -> str:
    """T10 for text input, truncating like pandas' astype(int)."""
    from postlake.functions.numeric import NUMERIC_TEXT
    d = f"CASE WHEN regexp_matches(lower(CAST({x} AS VARCHAR)), {sql_str(NUMERIC_TEXT)}) " \
        f"THEN TRY_CAST(trim(CAST({x} AS VARCHAR)) AS DOUBLE) END"
    whole = f"CASE WHEN regexp_matches(CAST({x} AS VARCHAR), '^\\s*[+-]?\\d+\\s*$') THEN TRY_CAST(trim(CAST({x} AS VARCHAR)) AS BIGINT) END"
    return (f"coalesce({whole}, CASE WHEN isfinite({d}) THEN TRY_CAST(trunc({d}) AS BIGINT) END, CAST(0 AS BIGINT))")


def tabular_sql(src: str, threshold: int = 100) -> str:
    """Tabular features over a relation ``src`` with item columns."""
    return f"""
SELECT id, title,
       CAST(length(title) AS INTEGER) AS title_len,
       {word_count_sql('title')} AS n_words_title,
       CAST(hour(created_ts) AS INTEGER) AS hour,
       CAST(isodow(created_ts) - 1 AS INTEGER) AS weekday,
       CAST(length(coalesce(url, '')) > 0 AS INTEGER) AS has_url,
       {question_sql('title')} AS has_question,
       {domain_sql('url')} AS domain,
       coalesce("by", 'unknown') AS by_author,
       type, url, score, created_ts,
       CAST(score >= {threshold} AS INTEGER) AS vai_bombar
FROM (
  SELECT id, type, "by", url, CAST(title AS VARCHAR) AS title, CAST(score AS BIGINT) AS score,
         {epoch_ts_sql('"time"')} AS created_ts
  FROM {src}
  WHERE type = 'story' AND title IS NOT NULL AND "time" IS NOT NULL AND score IS NOT NULL
) s WHERE created_ts IS NOT NULL
"""


def text_sql(src: str) -> str:
    return f"""
SELECT id, title, url, score, by_author, created_ts FROM (
  SELECT id, {strip_sql('CAST(title AS VARCHAR)')} AS title, coalesce(url, '') AS url,
         CAST(coalesce(score, 0) AS BIGINT) AS score, coalesce("by", 'unknown') AS by_author,
         {epoch_ts_sql('"time"')} AS created_ts,
         row_number() OVER (PARTITION BY id ORDER BY "time" DESC NULLS LAST, score DESC NULLS LAST) AS rn
  FROM {src}
  WHERE type = 'story' AND title IS NOT NULL AND "time" IS NOT NULL
    AND length({strip_sql('CAST(title AS VARCHAR)')}) > 0
) WHERE rn = 1
"""


def metrics_sql(scored: str) -> str:
    """A5..A8 over a relation ``scored(model, y, p)``: one row per model."""
    return f"""
WITH s AS (SELECT model, CAST(y AS INTEGER) AS y, CAST(p AS DOUBLE) AS p,
                  CAST(p >= 0.5 AS INTEGER) AS pred FROM {scored} WHERE p IS NOT NULL AND y IS NOT NULL),
cls AS (SELECT model, avg(CAST(y = pred AS DOUBLE)) AS accuracy,
               sum(y * pred) AS tp, sum((1 - y) * pred) AS fp, sum(y * (1 - pred)) AS fn,
               sum(y) AS n_pos, count(*) - sum(y) AS n_neg FROM s GROUP BY model),
g AS (SELECT model, p, sum(y) AS pos, count(*) AS cnt FROM s GROUP BY model, p),
c AS (SELECT g.*, sum(pos) OVER w AS cp, sum(cnt) OVER w AS cn FROM g
      WINDOW w AS (PARTITION BY model ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
a AS (SELECT c.model, sum(pos * ((n_neg - (cn - cp)) + (cnt - pos) / 2.0)) / (n_pos * n_neg) AS roc_auc,
             sum(pos / n_pos * cp / cn) AS pr_auc
      FROM c JOIN cls USING (model) GROUP BY c.model, n_pos, n_neg)
SELECT cls.model, accuracy,
       coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0.0) AS f1, roc_auc, pr_auc
FROM cls LEFT JOIN a USING (model)"""


def hashed_terms_sql(src: str, id_col: str, text_col: str, dim: int = 384) -> str:
    """E2 long form ``(id, bucket, weight)`` in SQL."""
    return f"""
SELECT id, bucket, tf / sqrt(sum(tf * tf) OVER (PARTITION BY id)) AS weight FROM (
  SELECT id, CAST(CAST(('0x' || substr(md5(tok), 1, 8)) AS BIGINT) % {dim} AS INTEGER) AS bucket,
         count(*) AS tf
  FROM (SELECT {id_col} AS id, unnest(regexp_split_to_array(lower({text_col}), '[^\\p{{L}}\\p{{N}}]+')) AS tok
        FROM {src}) _t
  WHERE tok <> '' GROUP BY 1, 2) _c"""
