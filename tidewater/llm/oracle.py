"""Check SQL of this package's queries, where DuckDB can express them."""

from __future__ import annotations

OP10 = r"""
WITH split AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
    SELECT doc_id, i, sha256(array_to_string(words[i:i + 34], ' ')) AS w
    FROM split, unnest(range(1, len(words) - 33)) AS t(i)
), twice AS (
    SELECT w FROM windows GROUP BY w HAVING count(*) > 1
), gone AS (
    SELECT DISTINCT doc_id, i + k AS i FROM windows SEMI JOIN twice USING (w), range(35) AS r(k)
), places AS (
    SELECT doc_id, i, words[i] AS word FROM split, unnest(range(1, len(words) + 1)) AS t(i)
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM places ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
), lost AS (
    SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
    sha256(coalesce(kept.text, '')) AS kept_sha256
FROM split LEFT JOIN lost USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


OP12 = r"""
WITH split AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || doc_id) AS h,
        regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
    FROM documents
), drawn AS (
    SELECT *, len(units) AS n, CAST('0x' || substr(h, 1, 8) AS UBIGINT) % (len(units) + 1) AS r1,
        CAST('0x' || substr(h, 9, 8) AS UBIGINT) % (len(units) + 1) AS r2,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
            OR CAST('0x' || substr(h, 17, 8) AS UBIGINT) % 100 >= 50 THEN 'plain'
            WHEN CAST('0x' || substr(h, 25, 8) AS UBIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
    FROM split
), cut AS (
    SELECT doc_id, text, n, form, array_to_string(units[1:least(r1, r2)], '') AS prefix,
        array_to_string(units[least(r1, r2) + 1:greatest(r1, r2)], '') AS middle,
        array_to_string(units[greatest(r1, r2) + 1:], '') AS suffix
    FROM drawn
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
    CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM cut
"""


def oracle_sql() -> dict[str, str]:
    return {"op10_fm_index": OP10, "op12_fill_in_middle": OP12}
