"""SQL of the queries that DuckDB can express, written from their definitions."""

_BLANKS = r"\x20\x09-\x0D"
_DOCS = "SELECT doc_id, coalesce(text, '') AS text FROM documents"
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

OP8 = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, * FROM ({_DOCS})),
lines AS (
    SELECT r, doc_id, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) AS pos
    FROM docs),
keyed AS (
    SELECT *, translate(regexp_replace(line, '^[{_BLANKS}]+|[{_BLANKS}]+$', '', 'g'), {_LOWER}) AS key FROM lines),
shared AS (
    SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
    GROUP BY key HAVING count(DISTINCT doc_id) + max(CASE WHEN doc_id IS NULL THEN 1 ELSE 0 END) >= 3),
marked AS (
    SELECT k.r, k.pos, k.line, s.key IS NOT NULL AND k.doc_id IS DISTINCT FROM s.keeper AS dropped
    FROM keyed k LEFT JOIN shared s ON k.key = s.key AND length(k.key) >= 20)
SELECT any_value(d.doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked m JOIN docs d USING (r) GROUP BY r
"""

OP9 = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, * FROM ({_DOCS})),
lists AS (SELECT r, regexp_extract_all(text, '[^{_BLANKS}]+') AS w FROM docs),
words AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM lists),
windows AS (
    SELECT r, i, count(*) OVER eight AS n, list(word) OVER eight AS gram FROM words
    WINDOW eight AS (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)),
twice AS (
    SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS seen FROM windows WHERE n = 8) WHERE seen > 1),
covered AS (
    SELECT r, sum(least(8, coalesce(next_i - i, 8)))::BIGINT AS n_repeat_words
    FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS next_i FROM twice) GROUP BY r),
lines AS (
    SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
    FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs)
    WHERE regexp_matches(line, '[^{_BLANKS}]') GROUP BY r),
measured AS (
    SELECT doc_id, len(w)::BIGINT AS n_words,
           length(regexp_replace(text, '[{_BLANKS}]', '', 'g')) AS word_chars,
           length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
           coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
           coalesce(n_lines, 0) AS n_lines,
           length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_upper
    FROM docs JOIN lists USING (r) LEFT JOIN covered USING (r) LEFT JOIN lines USING (r)),
judged AS (
    SELECT *, CASE WHEN n_words < 20 THEN 1 ELSE 0 END
        + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
        + CASE WHEN 4 * n_symbols > n_words THEN 4 ELSE 0 END
        + CASE WHEN 100 * n_dup_lines > 30 * n_lines THEN 8 ELSE 0 END
        + CASE WHEN 2 * n_upper > word_chars THEN 16 ELSE 0 END
        + CASE WHEN word_chars > 20 * n_words OR word_chars < 2 * n_words THEN 32 ELSE 0 END
        + CASE WHEN n_dup_lines >= 3 AND 100 * n_dup_lines > 30 * n_lines THEN 64 ELSE 0 END AS bits
    FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper,
       bits::BIGINT AS failed, bits & 3 <> 0 AS base_failed, bits & 119 = 0 AS kept
FROM judged
"""

OP11 = rf"""
WITH cut AS (
    SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS u,
           sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
    FROM ({_DOCS})),
hashed AS (
    SELECT *, len(u)::BIGINT AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS x, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS y,
           ('0x' || h[17:24])::BIGINT % 100 AS plain, ('0x' || h[25:32])::BIGINT % 100 AS kind
    FROM cut),
parted AS (
    SELECT doc_id, text, n, array_to_string(u[1:least(x, y)], '') AS prefix,
           array_to_string(u[least(x, y) + 1:greatest(x, y)], '') AS middle,
           array_to_string(u[greatest(x, y) + 1:], '') AS suffix,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR plain >= 90
                THEN 'plain' WHEN kind < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM hashed)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parted
"""

# floor(64 * x) are small whole numbers, whose products doubles sum exactly.
OP12 = """
WITH vectors AS (
    SELECT vec_id, [floor(64 * x::DOUBLE) for x in embedding] AS x FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
    SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.x, v.x)::BIGINT AS score
    FROM vectors q JOIN vectors v ON q.vec_id <> v.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
"""


def oracle_sql() -> dict[str, str]:
    return {"op8_line_dedup": OP8, "op9_quality_rules": OP9, "op11_fill_middle": OP11, "op12_topk_search": OP12}
