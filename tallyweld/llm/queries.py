"""The registered queries of this subpackage and their DuckDB equivalents."""

from __future__ import annotations

from . import chat, infill, license, mixing, quality
from .chat import op2_chat_formatting
from .exact import op8_exact_dedup
from .ffd import op13_packing
from .infill import op12_fill_in_middle
from .jaccard import op10_ngram_jaccard_join
from .langid import op7_language_id
from .late import op11_late_overwrite
from .license import op1_license_scan
from .mixing import op5_mixing
from .packing import op4_best_fit_packing
from .pii import op3_pii
from .quality import op9_quality_rules
from .substring import op6_substring_dedup

QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_chat_formatting": op2_chat_formatting,
    "op3_pii": op3_pii,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_mixing": op5_mixing,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_language_id": op7_language_id,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_quality_rules": op9_quality_rules,
    "op10_ngram_jaccard_join": op10_ngram_jaccard_join,
    "op11_late_overwrite": op11_late_overwrite,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_packing": op13_packing,
}

WORDS = r"regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+')"

ORACLE_SQL = {
    "op1_license_scan": license.duckdb_sql(),
    "op2_chat_formatting": chat.duckdb_sql(),
    "op5_mixing": mixing.duckdb_sql(),
    "op8_exact_dedup": """
SELECT doc_id, max(doc_id) OVER t AS keep_id, count(*) OVER t AS group_size, doc_id = max(doc_id) OVER t AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW t AS (PARTITION BY coalesce(text, ''))""",
    "op9_quality_rules": quality.duckdb_sql(),
    "op12_fill_in_middle": infill.duckdb_sql(),
    "op10_ngram_jaccard_join": f"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS words FROM documents),
s AS (SELECT doc_id, list_distinct(list_transform(range(1, greatest(len(words) - 3, least(len(words), 1) + 1)), lambda i: list_slice(words, i, i + 4))) AS grams FROM w),
g AS (SELECT doc_id, unnest(grams) AS gram FROM s),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both FROM g a JOIN g b USING (gram) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
e AS MATERIALIZED (SELECT a, b FROM o JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b WHERE 100 * n_both >= 75 * (len(x.grams) + len(y.grams) - n_both)),
r AS (SELECT doc_id, doc_id AS to_id FROM s UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.to_id = e.a)
SELECT s.doc_id, len(any_value(grams))::BIGINT AS n_shingles, min(to_id) AS component_id FROM s JOIN r USING (doc_id) GROUP BY s.doc_id""",
    "op6_substring_dedup": f"""
WITH w AS (SELECT doc_id, {WORDS.format('text')} AS words FROM documents),
win AS (SELECT doc_id, i, list_slice(words, i, i + 12) AS g FROM w, unnest(range(1, len(words) - 11)) t(i)),
hit AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS least FROM win) WHERE least < doc_id),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM hit, range(13) r(j)),
gs AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
 sha256(array_to_string(CASE WHEN ps IS NULL THEN words ELSE list_transform(list_filter(range(1, len(words) + 1), lambda i: NOT list_contains(ps, i)), lambda i: words[i]) END, ' ')) AS kept_sha256
FROM w LEFT JOIN gs ON gs.doc_id = w.doc_id""",
}
