"""Text scalar functions as Spark Column expressions.

Every step is a JVM expression, so a whole cleaner is one projection: regex and
translate steps, table-driven rewriting (HTML entities, emoji names: the text is
cut at what a table may know, and each cut part is looked up, longest name first)
and, for NFKC, the normaliser of the ICU library that Spark carries.
"""
from __future__ import annotations

import html.entities
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed as X

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lookaround_boundary() -> str:
    w = X.WORD
    return r"(?:(?<=[" + w + r"])(?![" + w + r"])|(?<![" + w + r"])(?=[" + w + r"]))"


_B = _lookaround_boundary()
EMAIL_RE = _B + X.EMAIL_BODY + _B
NUMBER_RE = r"(?=" + X.DIGIT + r")(?<![" + X.WORD + r"])" + X.DIGIT + r"+(?![" + X.WORD + r"])"
REPEAT_RE = r"([^\n])\1{2,}"
# runs of white space other than one space, which stays as it is
SPACES_RE = r"(?![\x21-\x7E])(?:\x20[" + X.SPACE + r"]|[" + X.SPACE + r"&&[^\x20]])[" + X.SPACE + r"]*"
NONBLANK_RE = r"[^" + X.SPACE + r"]"


def _let(x: Column, f: Callable[[Column], Column]) -> Column:
    """``f(x)`` with ``x`` evaluated once, however often ``f`` uses it."""
    return F.transform(F.array(x), f)[0]


def _where(c: ColumnOrName, part: str, f: Callable[[Column], Column]) -> Column:
    """``f`` of the texts that hold ``part``; no other is changed by it."""
    return _let(col(c), lambda v: F.when(v.contains(part), f(v)).otherwise(v))


def _table(pairs: dict[str, str]) -> Column:
    """A map literal (folded once per plan)."""
    return F.str_to_map(F.lit("\x02".join(f"{k}\x01{v}" for k, v in pairs.items())), F.lit("\x02"), F.lit("\x01"))


# --------------------------------------------------------------------------
# B1 Unicode repair
# --------------------------------------------------------------------------
def cp1252_pairs() -> tuple[str, str]:
    """The characters that cp1252 has for bytes 0x80-0x9F, and those bytes as characters."""
    pairs = [(bytes([b]).decode("cp1252"), chr(b)) for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


MOJIBAKE_RE = "[ÃÂâ][\\x{80}-ÿ‘-›€ŒœŠšŸŽžƒˆ˜]"
CP1252_ONLY_RE = "[\\x00-\\x7F\\x{A0}-\\x{FF}" + cp1252_pairs()[0] + "]*"


def repair_mojibake(c: ColumnOrName) -> Column:
    """UTF-8 that was read as cp1252, read anew where the whole text allows it."""
    src, dst = cp1252_pairs()

    def repaired(v: Column) -> Column:
        read = F.try_validate_utf8(F.encode(F.translate(v, src, dst), "ISO-8859-1").cast("string"))
        return F.when(v.rlike(MOJIBAKE_RE) & v.rlike("\\A" + CP1252_ONLY_RE + "\\z"), F.coalesce(read, v)).otherwise(v)

    return _let(col(c), repaired)


# What may follow "&" in a character reference, and the names valid without ";" (longest first).
REFERENCE_RE = r"^(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
BARE_NAMES = sorted((k for k in html.entities.html5 if not k.endswith(";")), key=lambda k: (-len(k), k))
BARE_RE = "^(" + "|".join(BARE_NAMES) + ")"


def _numeric_reference(m: Column) -> Column:
    hexa = F.regexp_extract(m, "^#[xX]0*([0-9a-fA-F]*)", 1)
    deci = F.regexp_extract(m, "^#0*([0-9]*)", 1)
    is_hex = m.rlike("^#[xX]")
    code = F.when(is_hex, F.when(F.length(hexa) > 6, 0x110000).otherwise(F.conv(F.concat(F.lit("0"), hexa), 16, 10).cast("int"))) \
        .otherwise(F.when(F.length(deci) > 7, 0x110000).otherwise(F.concat(F.lit("0"), deci).cast("int")))
    char = lambda n: F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    c1, latin = cp1252_pairs()
    nothing = (n_in(code, 0x1, 0x8) | n_in(code, 0xE, 0x1F) | n_in(code, 0x7F, 0x9F) | n_in(code, 0xFDD0, 0xFDEF)
               | (code == 0xB) | (code.bitwiseAND(0xFFFE) == 0xFFFE))
    return (F.when((code == 0) | n_in(code, 0xD800, 0xDFFF) | (code > 0x10FFFF), "�")
            .when(n_in(code, 0x80, 0x9F), F.translate(char(code), latin, c1))
            .when(nothing, "").otherwise(char(code)))


def n_in(n: Column, low: int, high: int) -> Column:
    return (n >= low) & (n <= high)


def unescape_entities(c: ColumnOrName) -> Column:
    """All HTML character references: numeric, named, and names without ";" as longest prefix."""
    # Spark looks through a map from its start: one map for every first letter
    by_letter = F.array(*[_table({k: v for k, v in html.entities.html5.items() if ord(k[0]) == i} or {"": ""}) for i in range(128)])

    def value(m: Column) -> Column:
        return F.try_element_at(F.get(by_letter, F.ascii(m)), m)

    def named(m: Column) -> Column:
        # a name without ";" is its own longest prefix: only one with ";" is looked up whole
        return F.coalesce(F.when(m.endswith(";"), value(m)), _let(F.regexp_extract(m, BARE_RE, 1), lambda bare: F.when(
            bare != "", F.concat(value(bare), F.substr(m, F.length(bare) + 1))).otherwise(F.concat(F.lit("&"), m))))

    def part(p: Column) -> Column:
        return _let(F.regexp_extract(p, REFERENCE_RE, 1), lambda m: F.concat(
            F.when(m == "", "&").when(m.startswith("#"), _numeric_reference(m)).otherwise(named(m)),
            F.substr(p, F.length(m) + 1)))

    def whole(v: Column) -> Column:
        return F.when(v.contains("&"), _let(F.split(v, "&", -1), lambda a: F.concat(
            a[0], F.array_join(F.transform(F.slice(a, 2, F.size(a)), part), "")))).otherwise(v)

    return _let(col(c), whole)


def compatibility_form(c: ColumnOrName) -> Column:
    """NFKC; null stays null."""
    t = F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), F.coalesce(col(c), F.lit("")), F.lit(True))
    return F.when(col(c).isNotNull(), t)


def fix_unicode(c: ColumnOrName) -> Column:
    """B1: null -> '', UTF-8-read-as-cp1252 repair, HTML entities, NFKC."""
    t = unescape_entities(repair_mojibake(F.coalesce(col(c), F.lit(""))))
    return F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), t, F.lit(True))


# Entity subset expressible in SQL (used by the oracle-checked query).
HTML_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
                 ("&apos;", "'"), ("&nbsp;", " "), ("&amp;", "&"))


def unescape_basic_entities(c: ColumnOrName) -> Column:
    """Named entities of ``HTML_ENTITIES``, ``&amp;`` last (no double decode)."""
    out = col(c)
    for ent, ch in HTML_ENTITIES:
        out = F.replace(out, F.lit(ent), F.lit(ch))
    return out


# --------------------------------------------------------------------------
# B2-B6 masks
# --------------------------------------------------------------------------
def mask_urls(c: ColumnOrName) -> Column:
    return F.regexp_replace(col(c), X.URL_RE, X.URL_TOKEN)


def mask_emails(c: ColumnOrName) -> Column:
    return _where(c, "@", lambda v: F.regexp_replace(v, EMAIL_RE, X.EMAIL_TOKEN))


def mask_phones(c: ColumnOrName) -> Column:
    return F.regexp_replace(col(c), X.PHONE_RE, X.PHONE_TOKEN)


def mask_mentions(c: ColumnOrName) -> Column:
    return _where(c, "@", lambda v: F.regexp_replace(v, X.MENTION_RE, X.USER_TOKEN))


def unwrap_hashtags(c: ColumnOrName) -> Column:
    return _where(c, "#", lambda v: F.regexp_replace(v, X.HASHTAG_RE, " $1 "))


def mask_contacts(c: ColumnOrName) -> Column:
    """URL, then e-mail, then phone: the order decides overlaps."""
    return mask_phones(mask_emails(mask_urls(c)))


# --------------------------------------------------------------------------
# B7 contractions (fixed rule list, JVM regex)
# --------------------------------------------------------------------------
def expand_contractions(c: ColumnOrName) -> Column:
    def chain(v: Column) -> Column:
        out = v
        for pat, rep in X.CONTRACTIONS:
            out = F.regexp_replace(out, pat, rep)
        return out

    # no rule reaches over a space: of rows with an apostrophe, only the parts between spaces that have one take the chain
    marked = lambda v: v.contains("'") | v.contains("’")
    parts = lambda v: F.transform(F.split(v, " ", -1), lambda p: F.when(marked(p), chain(p)).otherwise(p))
    return _let(col(c), lambda v: F.when(marked(v), F.array_join(parts(v), " ")).otherwise(v))


# --------------------------------------------------------------------------
# B8/B9 emoji (names from the Unicode database)
# --------------------------------------------------------------------------
EMOJI_RANGES = ((0x2194, 0x2199), (0x21A9, 0x21AA), (0x231A, 0x231B), (0x2328, 0x2328), (0x23CF, 0x23CF), (0x23E9, 0x23FA),
                (0x25AA, 0x25AB), (0x25B6, 0x25B6), (0x25C0, 0x25C0), (0x25FB, 0x25FE), (0x2600, 0x27BF), (0x2934, 0x2935),
                (0x2B05, 0x2B07), (0x2B1B, 0x2B1C), (0x2B50, 0x2B50), (0x2B55, 0x2B55), (0x3030, 0x3030), (0x303D, 0x303D),
                (0x1F000, 0x1FAFF))
_EMOJI_SET = "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in EMOJI_RANGES)
EMOJI_CLASS = f"[{_EMOJI_SET}]"
EMOJI_SPAN = rf"[\x{{{EMOJI_RANGES[0][0]:X}}}-\x{{{EMOJI_RANGES[-1][1]:X}}}]"  # one range that holds them all: quick to look for
EMOJI_TAIL = r"\x{FE0F}?\x{200D}?"  # variation selector, joiner to the next emoji


def emoji_names() -> dict[str, str]:
    """Emoji -> ' :unicode_name: '."""
    named = ((chr(cp), unicodedata.name(chr(cp), None)) for a, b in EMOJI_RANGES for cp in range(a, b + 1))
    return {ch: " :" + n.lower().replace(" ", "_").replace("-", "_") + ": " for ch, n in named if n}


def emoji_to_text(c: ColumnOrName) -> Column:
    """Emoji -> ' :unicode_name: '; of joined ones every part is named."""
    parts = f"{EMOJI_CLASS}{EMOJI_TAIL}|[^{_EMOJI_SET}]+"
    names = _table(emoji_names())

    def named(v: Column) -> Column:
        told = F.transform(F.regexp_extract_all(v, F.lit(parts), F.lit(0)),
                           lambda p: F.coalesce(F.try_element_at(names, F.substring(p, 1, 1)), p))
        return F.when(v.rlike(EMOJI_SPAN) & v.rlike(EMOJI_CLASS), F.array_join(told, "")).otherwise(v)

    return _let(col(c), named)


def remove_emojis(c: ColumnOrName) -> Column:
    """Delete emoji code points with a following variation selector and joiner."""
    return _let(col(c), lambda v: F.when(v.rlike(EMOJI_SPAN), F.regexp_replace(v, EMOJI_CLASS + EMOJI_TAIL, "")).otherwise(v))


# --------------------------------------------------------------------------
# B10-B16
# --------------------------------------------------------------------------
def collapse_repeats(c: ColumnOrName) -> Column:
    """Any run of 3+ equal characters (newline excluded) -> 2."""
    return F.regexp_replace(col(c), REPEAT_RE, "$1$1")


def strip_punct(c: ColumnOrName, keep: str = "") -> Column:
    """Delete ASCII punctuation except ``keep``."""
    drop = "".join(ch for ch in X.ASCII_PUNCT if ch not in keep)
    return F.translate(col(c), drop, "")


def mask_numbers(c: ColumnOrName) -> Column:
    """Standalone digit runs -> ' <NUM> '."""
    return F.regexp_replace(col(c), NUMBER_RE, X.NUM_TOKEN)


def norm_whitespace(c: ColumnOrName) -> Column:
    """Collapse Unicode whitespace runs to one space, trim."""
    return F.trim(F.regexp_replace(col(c), SPACES_RE, " "))


def to_ascii(c: ColumnOrName) -> Column:
    """Latin letters with diacritics -> base letters, ligatures -> their letters (fixed table)."""
    src, dst = _latin_table()
    out = F.translate(col(c), src, dst)
    for letter, ascii_form in X.LATIN_LETTERS:
        if len(ascii_form) > 1:
            out = F.replace(out, F.lit(letter), F.lit(ascii_form))
    return out


def _latin_table() -> tuple[str, str]:
    # Built by rule: every Latin-1/Latin-A letter whose NFKD form is one
    # ASCII letter plus combining marks.
    src, dst = [], []
    for cp in range(0x00C0, 0x0180):
        ch = chr(cp)
        base = unicodedata.normalize("NFKD", ch)
        if base and base[0].isascii() and base[0].isalpha() and all(
                unicodedata.combining(x) for x in base[1:]) and len(base) > 1:
            src.append(ch)
            dst.append(base[0])
    single = [(a, b) for a, b in X.LATIN_LETTERS if len(b) == 1]
    return "".join(src + [a for a, _ in single]), "".join(dst + [b for _, b in single])


def strip_nonprintable(c: ColumnOrName) -> Column:
    """B15."""
    return F.regexp_replace(col(c), X.NON_PRINTABLE_RE, "")


def lower_text(c: ColumnOrName) -> Column:
    """B16."""
    return F.lower(col(c))


def is_blank(c: ColumnOrName) -> Column:
    return col(c).isNull() | ~col(c).rlike(NONBLANK_RE)


# --------------------------------------------------------------------------
# B17-B19 composed cleaners
# --------------------------------------------------------------------------
def clean_shared(c: ColumnOrName) -> Column:
    """The steps that all cleaners begin with."""
    t = unwrap_hashtags(mask_mentions(mask_contacts(fix_unicode(c))))
    return collapse_repeats(emoji_to_text(expand_contractions(t)))


def _clean(c: ColumnOrName, *, keep: str, lower: bool, numbers: bool, shared: ColumnOrName | None = None) -> Column:
    src = col(c)
    t = clean_shared(src) if shared is None else col(shared)
    if lower:
        t = F.lower(t)
    if numbers:
        t = mask_numbers(t)
    t = norm_whitespace(strip_punct(t, keep))
    return F.when(is_blank(src), F.lit("")).otherwise(t)


def clean_for_embeddings(c: ColumnOrName, *, shared: ColumnOrName | None = None) -> Column:
    """Keeps ``<>:_-``. ``shared``: a column that holds ``clean_shared`` of the text, as for the other cleaners."""
    return _clean(c, keep=X.KEEP_EMBEDDINGS, lower=True, numbers=False, shared=shared)


def clean_for_classification(c: ColumnOrName, *, lower: bool = True, shared: ColumnOrName | None = None) -> Column:
    """Numbers masked after lower-casing, keeps ``<>:_!?``."""
    return _clean(c, keep=X.KEEP_CLASSIFICATION, lower=lower, numbers=True, shared=shared)


def clean_for_sentiment(c: ColumnOrName, *, shared: ColumnOrName | None = None) -> Column:
    """Keeps ``<>:_!?'-``."""
    return _clean(c, keep=X.KEEP_SENTIMENT, lower=True, numbers=False, shared=shared)


CLEANERS = {
    "embeddings": clean_for_embeddings,
    "classification": clean_for_classification,
    "sentiment": clean_for_sentiment,
}
