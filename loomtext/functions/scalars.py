"""Row-level helpers B25-B46 as Column expressions (all JVM-side)."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import fixed as X
from .text import ColumnOrName, col

_WS = "[" + X.SPACE + "]"


def strip_ws(c: ColumnOrName) -> Column:
    """Python ``str.strip()``: trims every Unicode whitespace character."""
    return F.regexp_replace(col(c), "^" + _WS + "+|" + _WS + "+$", "")


def merge_text_columns(cols: Sequence[ColumnOrName]) -> Column:
    """NULL -> '', joined by one space (empty slots kept), stripped."""
    return strip_ws(F.concat_ws(" ", *[F.coalesce(col(c).cast("string"), F.lit("")) for c in cols]))


def preview(c: ColumnOrName, n: int = 220) -> Column:
    """Collapse whitespace, cut at n, right-strip, add '...'."""
    flat = F.trim(F.regexp_replace(F.coalesce(col(c), F.lit("")), _WS + "+", " "))
    cut = F.concat(F.regexp_replace(F.substring(flat, 1, n), _WS + "+$", ""), F.lit("..."))
    return F.when(F.length(flat) <= n, flat).otherwise(cut)


def norm_category(c: ColumnOrName) -> Column:
    """NULL -> '', strip, lower."""
    return F.lower(strip_ws(F.coalesce(col(c).cast("string"), F.lit(""))))


def city_of(c: ColumnOrName) -> Column:
    """Normalised text before the first comma."""
    return strip_ws(F.split(norm_category(c), ",", 2).getItem(0))


def scam_features(text: ColumnOrName, tokens_str_col: ColumnOrName) -> list[Column]:
    """len_chars, len_tokens, has_url, has_phone, has_money."""
    t = col(text)
    return [
        F.length(t).alias("len_chars"),
        word_count(tokens_str_col).alias("len_tokens"),
        t.rlike(X.HAS_URL_RE).cast("int").alias("has_url"),
        t.rlike(X.HAS_PHONE_RE).cast("int").alias("has_phone"),
        t.rlike(X.HAS_MONEY_RE).cast("int").alias("has_money"),
    ]


def word_count(c: ColumnOrName) -> Column:
    """Number of whitespace-separated words."""
    return F.size(F.filter(F.split(F.coalesce(col(c), F.lit("")), _WS + "+"),
                           lambda w: w != ""))


def render_prompt(facts: ColumnOrName) -> Column:
    """Bulleted facts inside the fixed prompt template."""
    bullets = F.array_join(F.transform(col(facts), lambda f: F.concat(F.lit("- "), f)), "\n")
    return F.format_string(X.PROMPT_TEMPLATE, bullets)


def build_chat_record(persona_id: ColumnOrName, bio: ColumnOrName, icebreaker: ColumnOrName,
                      gen_model: str, temperature: ColumnOrName) -> Column:
    """Nested record with a two-message chat."""
    msgs = F.array(
        F.struct(F.lit("user").alias("role"),
                 F.format_string(X.CHAT_USER_TEMPLATE, col(bio)).alias("content")),
        F.struct(F.lit("assistant").alias("role"), col(icebreaker).alias("content")))
    return F.struct(col(persona_id).alias("persona_id"), F.lit(gen_model).alias("gen_model"),
                    col(temperature).cast("double").alias("temperature"), msgs.alias("messages"))


_REPLY_SCHEMA = T.StructType([T.StructField("bio", T.StringType()),
                              T.StructField("icebreaker", T.StringType())])
_EMBEDDED_OBJ = r'(?s)\{[^{}]*?"bio"[^{}]*?"icebreaker"[^{}]*?\}'


def parse_llm_json(c: ColumnOrName) -> Column:
    """Whole text as JSON with non-empty bio+icebreaker, else the first
    embedded object holding both keys, else NULL."""
    t = strip_ws(col(c))

    def ok(s: Column) -> Column:
        return (F.coalesce(F.length(s.bio), F.lit(0)) > 0) & (F.coalesce(F.length(s.icebreaker), F.lit(0)) > 0)

    whole = F.from_json(t, _REPLY_SCHEMA)
    inner = F.from_json(F.regexp_extract(t, _EMBEDDED_OBJ, 0), _REPLY_SCHEMA)
    return F.when(ok(whole), whole).when(ok(inner), inner)


def parse_custom_id(c: ColumnOrName) -> list[Column]:
    """``p<persona>_t<temp index>`` -> two ints (NULL when absent)."""
    pat = r"p(\d+)_t(\d+)"
    m = col(c).rlike(pat)
    return [F.when(m, F.regexp_extract(col(c), pat, 1).cast("long")).alias("persona_id"),
            F.when(m, F.regexp_extract(col(c), pat, 2).cast("int")).alias("temp_idx")]


def parse_bio(c: ColumnOrName) -> Column:
    """Remove a leading 'Bio: ', keep the first line, strip."""
    return strip_ws(F.split(F.regexp_replace(col(c), "^Bio: ", ""), "\n", 2).getItem(0))


def fact_signature(facts: ColumnOrName) -> Column:
    """Trimmed, lower-cased, non-empty facts, sorted (duplicates kept)."""
    return F.array_sort(F.filter(F.transform(col(facts), lambda f: F.lower(strip_ws(f))),
                                 lambda f: f != ""))


def rating_to_sentiment(c: ColumnOrName) -> Column:
    """Right-closed bins [0,2] neg, (2,3] neutral, (3,5] pos, else NULL."""
    r = col(c).cast("double")
    return (F.when((r >= 0) & (r <= 2), "negative").when((r > 2) & (r <= 3), "neutral")
            .when((r > 3) & (r <= 5), "positive"))


def class_to_label(c: ColumnOrName, positive_class: int = 0) -> Column:
    """The given class -> 1, everything else -> 0."""
    return (col(c) == positive_class).cast("int")


def map_score(c: ColumnOrName, mapping: Mapping[str, float] = X.EMOTION_SCORE) -> Column:
    """Category -> number, unknown -> NULL."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.element_at(m, col(c))


def softmax(scores: ColumnOrName) -> Column:
    """Max-shifted softmax over an array; uniform when the sum is 0."""
    s = col(scores)
    mx = F.array_max(s)
    ex = F.transform(s, lambda v: F.exp(v - mx))
    den = F.aggregate(ex, F.lit(0.0).cast("double"), lambda a, v: a + v)
    n = F.size(s).cast("double")
    return F.when(den == 0, F.transform(s, lambda v: F.lit(1.0) / n)).otherwise(
        F.transform(ex, lambda v: v / den))


def argmax_label(score_map: ColumnOrName) -> Column:
    """struct(label, score) of the best entry (tie: smaller label)."""
    entries = F.map_entries(col(score_map))
    ordered = F.array_sort(entries, lambda a, b: F.when(a["value"] > b["value"], -1)
                           .when(a["value"] < b["value"], 1)
                           .when(a["key"] < b["key"], -1)
                           .when(a["key"] > b["key"], 1).otherwise(0))
    top = F.element_at(ordered, 1)
    return F.struct(top["key"].alias("label"), top["value"].alias("confidence"))


def apply_threshold(prob: ColumnOrName, t: float = 0.5) -> Column:
    """B43."""
    return (col(prob) >= F.lit(t)).cast("int")


def confidence_band(prob: ColumnOrName, t: float = 0.5) -> Column:
    """Distance to threshold < 0.08 borderline, < 0.20 moderate, else high."""
    d = F.abs(col(prob) - F.lit(t))
    return (F.when(d < F.lit(X.BAND_BORDERLINE), X.BAND_LABELS[0])
            .when(d < F.lit(X.BAND_MODERATE), X.BAND_LABELS[1]).otherwise(X.BAND_LABELS[2]))


def clip(c: ColumnOrName, lo: float, hi: float) -> Column:
    """B45."""
    return F.least(F.greatest(col(c), F.lit(lo)), F.lit(hi))


def round4(c: ColumnOrName, digits: int = 4) -> Column:
    """B46."""
    return F.round(col(c), digits)
