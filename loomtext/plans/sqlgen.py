"""DuckDB SQL text for the oracle side of the registered queries.

The oracle re-states each query's semantics in plain SQL (RE2 regex, list
lambdas). Tables (entities, compatibility forms, emoji names) are one-row CTEs of
maps built by the rules the Spark side uses. Where RE2 lacks a Java feature (look-around, back-references) the
SQL uses an equivalent construction: two-pass boundary matching for
numbers, an index lambda over characters for repeated characters.
"""
from __future__ import annotations

import html.entities
import sys
import unicodedata

from ..functions import fixed as X
from ..functions import text as TX

W = X.WORD
SP = X.SPACE


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def rx(expr: str, pat: str, rep: str) -> str:
    return f"regexp_replace({expr}, {lit(pat)}, {lit(rep)}, 'g')"


EMAIL_SQL = "[" + W + ".+-]+@[" + W + "-]+\\.[" + W + ".-]*[" + W + "]"
NUM_SQL = "(^|[^" + W + "])" + X.DIGIT + "+([^" + W + "]|$)"


def let(expr: str, var: str, body: str) -> str:
    """``body`` with ``var`` standing for ``expr``, evaluated once."""
    return f"list_transform([{expr}], lambda {var}: {body})[1]"


def table_map(pairs: dict[str, str]) -> str:
    rows = lit("\x02".join(f"{k}\x01{v}" for k, v in pairs.items()))
    cells = f"list_transform(string_split({rows}, chr(2)), lambda e: string_split(e, chr(1)))"
    return f"map(list_transform({cells}, lambda e: e[1]), list_transform({cells}, lambda e: e[2]))"


def compatibility_pairs() -> dict[str, str]:
    """Characters whose compatibility decomposition is not their canonical one."""
    every = (chr(n) for n in range(0x80, sys.maxunicode + 1) if not 0xD800 <= n <= 0xDFFF)
    return {c: unicodedata.normalize("NFKD", c) for c in every
            if unicodedata.normalize("NFKD", c) != unicodedata.normalize("NFD", c)}


def char_class(chars) -> str:
    ranges: list[list[int]] = []
    for n in sorted(map(ord, chars)):
        if ranges and ranges[-1][1] == n - 1:
            ranges[-1][1] = n
        else:
            ranges.append([n, n])
    return "[" + "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in ranges) + "]"


_COMPAT = compatibility_pairs()
TABLES_SQL = (f"SELECT {table_map(dict(html.entities.html5))} AS ent, {table_map(_COMPAT)} AS compat, "
              f"{table_map(TX.emoji_names())} AS emo")


def mojibake(expr: str) -> str:
    src, dst = TX.cp1252_pairs()
    codes = f"list_transform(string_split(translate(v, {lit(src)}, {lit(dst)}), ''), lambda c: printf('%02x', unicode(c)))"
    return let(expr, "v", f"CASE WHEN regexp_matches(v, {lit(TX.MOJIBAKE_RE)}) AND regexp_full_match(v, {lit(TX.CP1252_ONLY_RE)}) "
               f"THEN coalesce(try(decode(unhex(array_to_string({codes}, '')))), v) ELSE v END")


def entities(expr: str) -> str:
    c1, latin = TX.cp1252_pairs()
    char = (f"CASE WHEN n = 0 OR n BETWEEN 55296 AND 57343 OR n > 1114111 THEN chr(65533) "
            f"WHEN n BETWEEN 128 AND 159 THEN translate(chr(n), {lit(latin)}, {lit(c1)}) "
            "WHEN n BETWEEN 1 AND 8 OR n BETWEEN 14 AND 31 OR n = 127 OR n BETWEEN 64976 AND 65007 OR n = 11 "
            "OR (n & 65534) = 65534 THEN '' ELSE chr(n) END")
    hexa, deci = "regexp_extract(m, '^#[xX]0*([0-9a-fA-F]*)', 1)", "regexp_extract(m, '^#0*([0-9]*)', 1)"
    code = (f"CASE WHEN regexp_matches(m, '^#[xX]') THEN CASE WHEN length({hexa}) > 6 THEN 1114112 ELSE "
            f"CAST('0x0' || {hexa} AS INTEGER) END WHEN length({deci}) > 7 THEN 1114112 ELSE CAST('0' || {deci} AS INTEGER) END")
    named = let(f"regexp_extract(m, {lit(TX.BARE_RE)}, 1)", "b",
                "coalesce(ent[m], CASE WHEN b <> '' THEN ent[b] || substr(m, length(b) + 1) END, '&' || m)")
    part = let(f"regexp_extract(p, {lit(TX.REFERENCE_RE)}, 1)", "m",
               f"(CASE WHEN m = '' THEN '&' WHEN starts_with(m, '#') THEN {let(code, 'n', char)} ELSE {named} END) "
               "|| substr(p, length(m) + 1)")
    return let(expr, "v", "CASE WHEN contains(v, '&') THEN string_split(v, '&')[1] || array_to_string("
               f"list_transform(string_split(v, '&')[2:], lambda p: {part}), '') ELSE v END")


def compatibility_form(expr: str) -> str:
    return "nfc_normalize(" + let(expr, "v", f"CASE WHEN regexp_matches(v, {lit(char_class(_COMPAT))}) THEN array_to_string("
                                  "list_transform(string_split(v, ''), lambda c: coalesce(compat[c], c)), '') ELSE v END") + ")"


def fix_unicode(expr: str) -> str:
    """Needs ``TABLES_SQL``'s row beside it, as do ``entities`` and ``emoji_to_text``."""
    return compatibility_form(entities(mojibake(f"coalesce({expr}, '')")))


def contractions(expr: str) -> str:
    left, right = "(?<![" + W + "])", "(?![" + W + "])"
    out = "v"
    for pat, rep in X.CONTRACTIONS:
        two = pat.replace(left, "(^|[^" + W + "])").replace(right, "([^" + W + "]|$)")
        for _ in range(2):  # neighbours share the character between them
            out = rx(out, two, "\\1" + rep.replace("$1", "\\2") + "\\3")
    return let(expr, "v", f"CASE WHEN regexp_matches(v, {lit(chr(91) + chr(39) + '’' + chr(93))}) THEN {out} ELSE v END")


def emoji_to_text(expr: str) -> str:
    parts = f"{TX.EMOJI_CLASS}{TX.EMOJI_TAIL}|[^{TX.EMOJI_CLASS[1:-1]}]+"
    return let(expr, "v", f"CASE WHEN regexp_matches(v, {lit(TX.EMOJI_CLASS)}) THEN array_to_string(list_transform("
               f"regexp_extract_all(v, {lit(parts)}), lambda p: coalesce(emo[substr(p, 1, 1)], p)), '') ELSE v END")


def blank(expr: str) -> str:
    return f"({expr} IS NULL OR NOT regexp_matches({expr}, {lit('[^' + SP + ']')}))"


def pre_collapse(expr: str) -> str:
    """URL, e-mail, phone, mention, hashtag (the steps before B10)."""
    e = rx(expr, X.URL_RE, X.URL_TOKEN)
    e = rx(e, EMAIL_SQL, X.EMAIL_TOKEN)
    e = rx(e, X.PHONE_RE, X.PHONE_TOKEN)
    e = rx(e, X.MENTION_RE, X.USER_TOKEN)
    return rx(e, X.HASHTAG_RE, " \\1 ")


def collapse_list(chars: str) -> str:
    """B10 over a character list column: drop a char equal to both previous."""
    return (f"array_to_string(list_filter({chars}, lambda c, i: NOT coalesce("
            f"i > 2 AND c <> chr(10) AND c = {chars}[i - 1] AND c = {chars}[i - 2], false)), '')")


def mask_numbers(expr: str) -> str:
    return rx(rx(expr, NUM_SQL, "\\1 <NUM> \\2"), NUM_SQL, "\\1 <NUM> \\2")


def strip_punct(expr: str, keep: str) -> str:
    drop = "".join(ch for ch in X.ASCII_PUNCT if ch not in keep)
    return f"translate({expr}, {lit(drop)}, '')"


def norm_ws(expr: str) -> str:
    return f"trim({rx(expr, '[' + SP + ']+', ' ')})"


def post_collapse(expr: str, kind: str, lower: bool = True) -> str:
    keep = {"embeddings": X.KEEP_EMBEDDINGS, "classification": X.KEEP_CLASSIFICATION,
            "sentiment": X.KEEP_SENTIMENT}[kind]
    e = f"lower({expr})" if lower else expr
    if kind == "classification":
        e = mask_numbers(e)
    return norm_ws(strip_punct(e, keep))


def clean_cte(src: str, keys: str, text: str, kind: str, out: str = "text_clean",
              name: str = "cleaned", extra: str = "") -> str:
    """CTE text defining ``name(keys..., extra..., out)`` from ``src``.

    ``src`` is a table name or a parenthesised subquery."""
    ex = (", " + extra) if extra else ""
    return (
        f"{name}_t AS MATERIALIZED ({TABLES_SQL}),\n"
        f"{name}_u AS (SELECT {keys}{ex}, {blank(text)} AS __blank, {fix_unicode(text)} AS __u, emo FROM {src}, {name}_t),\n"
        f"{name}_a AS (SELECT * EXCLUDE (__u, emo), string_split({emoji_to_text(contractions(pre_collapse('__u')))}, '') AS __ch "
        f"FROM {name}_u),\n"
        f"{name} AS (SELECT * EXCLUDE (__blank, __ch), CASE WHEN __blank THEN '' ELSE "
        f"{post_collapse(collapse_list('__ch'), kind)} END AS {out} FROM {name}_a)"
    )


TOKEN_SQL = X.TOKEN_RE
STOP_SQL = "(" + ", ".join(lit(w) for w in X.STOPWORDS) + ")"


def remove_stopwords(arr: str) -> str:
    return f"list_filter({arr}, lambda t: lower(t) NOT IN {STOP_SQL} AND length(t) > 1)"


def lemma(t: str) -> str:
    irregular = " ".join(f"WHEN {t} = {lit(k)} THEN {lit(v)}" for k, v in X.IRREGULAR_NOUNS.items())
    return (f"CASE {irregular} "
            f"WHEN length({t}) > 4 AND suffix({t}, 'ies') THEN regexp_replace({t}, 'ies$', 'y') "
            f"WHEN length({t}) > 4 AND regexp_matches({t}, '(?:ss|sh|ch|x|z)es$') "
            f"THEN regexp_replace({t}, 'es$', '') "
            f"WHEN length({t}) > 3 AND suffix({t}, 's') AND NOT regexp_matches({t}, '(?:ss|us|is)$') "
            f"THEN regexp_replace({t}, 's$', '') ELSE {t} END")


def lemmatize(arr: str) -> str:
    return f"list_transform({arr}, lambda t: {lemma('t')})"


def tokenize(expr: str) -> str:
    return f"regexp_extract_all(coalesce({expr}, ''), {lit(TOKEN_SQL)})"


def md5key(expr: str, seed: int = X.SEED) -> str:
    return f"md5('{seed}:' || CAST({expr} AS VARCHAR))"
