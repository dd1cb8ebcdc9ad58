"""The operators of this subpackage as registered queries, and their DuckDB SQL."""
from __future__ import annotations

import public_tokenizers

from . import (chat_rotation, conversation_repair, conversation_trie, fingerprint, fss_neardup, html_template, license_scan,
               line_spread, packing, piece_codec, pu_quality, token_counts, wu_manber)
from .common import read_table


def op1_fingerprint(spark, sf_dir):
    return fingerprint.edited_fingerprints(read_table(spark, sf_dir, "documents"))


def op2_line_spread(spark, sf_dir):
    return line_spread.report(read_table(spark, sf_dir, "documents"))


def op3_license_scan(spark, sf_dir):
    return license_scan.scan(read_table(spark, sf_dir, "documents"))


def op4_chat_rotation(spark, sf_dir):
    return chat_rotation.rotate(read_table(spark, sf_dir, "conversations"))


def op5_packing(spark, sf_dir):
    return packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_token_counts(spark, sf_dir):
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_quality(spark, sf_dir):
    return pu_quality.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op8_html_text(spark, sf_dir):
    return html_template.extract(read_table(spark, sf_dir, "pages"))


def op9_decontamination(spark, sf_dir):
    return wu_manber.find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).drop("spans")


def op10_near_duplicates(spark, sf_dir):
    return fss_neardup.link(read_table(spark, sf_dir, "documents"), k=2)


def op11_conversation_repair(spark, sf_dir):
    return conversation_repair.repair(read_table(spark, sf_dir, "conversations"))


def op12_conversation_trie(spark, sf_dir):
    return conversation_trie.prefix_nodes(read_table(spark, sf_dir, "conversations"))


def op13_piece_codec(spark, sf_dir):
    return piece_codec.round_trip(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {f.__name__: f for f in (
    op1_fingerprint, op2_line_spread, op3_license_scan, op4_chat_rotation, op5_packing, op6_token_counts, op7_quality,
    op8_html_text, op9_decontamination, op10_near_duplicates, op11_conversation_repair, op12_conversation_trie,
    op13_piece_codec)}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

LINE_SPREAD_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, text, string_split(coalesce(text, ''), chr(10)) AS ls
           FROM documents),
u AS (SELECT r, doc_id, source, unnest(range(1, len(ls) + 1)) AS i, ls FROM d),
l AS (SELECT r, doc_id, source, i, trim(ls[i], ' ') AS line FROM u),
s AS (SELECT line, min(doc_id) AS first FROM l WHERE line <> '' GROUP BY line
      HAVING count(DISTINCT source) >= {line_spread.MIN_SITES}),
own AS (SELECT DISTINCT r FROM l LEFT JOIN s USING (line) WHERE line <> '' AND s.line IS NULL),
copies AS (SELECT coalesce(text, '') AS t FROM documents GROUP BY 1
           HAVING count(DISTINCT doc_id) + count(*) FILTER (WHERE doc_id IS NULL) >= 2),
whole AS (SELECT r FROM d WHERE coalesce(text, '') IN (SELECT t FROM copies) AND r NOT IN (SELECT r FROM own)),
g AS (SELECT r, i FROM l JOIN s USING (line)
      WHERE r NOT IN (SELECT r FROM whole) AND coalesce(doc_id <> first, true)),
k AS (SELECT u.r, string_agg(u.ls[u.i], chr(10) ORDER BY u.i) AS kept, count(g.i) AS gone
      FROM u LEFT JOIN g ON u.r = g.r AND u.i = g.i GROUP BY u.r),
c AS (SELECT u.r, string_agg(u.ls[u.i], chr(10) ORDER BY u.i) AS kept
      FROM u WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.r = u.r AND g.i = u.i) GROUP BY u.r)
SELECT doc_id, CASE WHEN text IS NULL THEN 0 ELSE len(ls) END::BIGINT AS n_lines, gone::BIGINT AS n_removed,
       CASE WHEN text IS NULL THEN NULL ELSE coalesce(c.kept, '') END AS text
FROM d JOIN k USING (r) LEFT JOIN c USING (r)"""

LEAKS_SQL = f"""
WITH b AS (SELECT DISTINCT item_id::VARCHAR AS item, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
bw AS (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item, list_slice(w, i, i + 9) AS pat FROM bw),
d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
lens AS (SELECT DISTINCT len(pat) AS m FROM win),
dw AS (SELECT r, m, w, unnest(range(1, len(w) - m + 2)) AS i FROM d, lens WHERE len(w) >= m),
hit AS (SELECT r, i, m, item FROM (SELECT r, i, m, list_slice(w, i, i + m - 1) AS pat FROM dw) JOIN win USING (pat)),
pos AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + m)) AS p FROM (SELECT DISTINCT r, i, m FROM hit))
        GROUP BY r),
its AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (r) LEFT JOIN its USING (r)"""

ORACLES = {
    "op2_line_spread": LINE_SPREAD_SQL,
    "op3_license_scan": license_scan.oracle(),
    "op4_chat_rotation": chat_rotation.oracle(),
    "op9_decontamination": LEAKS_SQL,
}
