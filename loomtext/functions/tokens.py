"""Tokens (B20-B24): regex tokenizer, stop words, rule lemmas, token chain.

All of it is array expressions evaluated in the JVM (``regexp_extract_all``,
``filter``, ``transform``); the stop-word test is an ``IN`` list that
Catalyst turns into a hash set.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed as X
from .text import CLEANERS, ColumnOrName, col


def tokenize(c: ColumnOrName) -> Column:
    """Words (inner hyphens kept), apostrophe clitics, single symbols."""
    return F.regexp_extract_all(F.coalesce(col(c), F.lit("")), F.lit(X.TOKEN_RE), 0)


def remove_stopwords(tokens: ColumnOrName, stopwords=X.STOPWORDS) -> Column:
    """Drop stop words (case-insensitive) and one-character tokens."""
    words = list(stopwords)
    return F.filter(col(tokens),
                    lambda t: ~F.lower(t).isin(words) & (F.length(t) > 1))


def lemma(t: Column) -> Column:
    """B22 for one token: irregular noun table, then plural suffix rules."""
    irregular = F.create_map(*[F.lit(x) for kv in X.IRREGULAR_NOUNS.items() for x in kv])
    n = F.length(t)
    rule = (F.when(~t.endswith("s"), t)
            .when((n > 4) & t.endswith("ies"), F.regexp_replace(t, "ies$", "y"))
            .when((n > 4) & t.rlike("(?:ss|sh|ch|x|z)es$"), F.regexp_replace(t, "es$", ""))
            .when((n > 3) & t.endswith("s") & ~t.rlike("(?:ss|us|is)$"),
                  F.regexp_replace(t, "s$", ""))
            .otherwise(t))
    # the set is hashed, the map is looked through from its start
    return F.when(t.isin(list(X.IRREGULAR_NOUNS)), F.element_at(irregular, t)).otherwise(rule)


def lemmatize(tokens: ColumnOrName) -> Column:
    return F.transform(col(tokens), lemma)


def token_chain(c: ColumnOrName, *, cleaner: str | None = "embeddings",
                drop_stopwords: bool = True, do_lemmatize: bool = True,
                **clean_opts) -> Column:
    """Clean -> tokenize -> stop words? -> lemmas?"""
    text = CLEANERS[cleaner](c, **clean_opts) if cleaner else col(c)
    toks = tokenize(text)
    if drop_stopwords:
        toks = remove_stopwords(toks)
    if do_lemmatize:
        toks = lemmatize(toks)
    return toks


def tokens_str(tokens: ColumnOrName) -> Column:
    """B24."""
    return F.array_join(col(tokens), " ")


def terms(c: ColumnOrName) -> Column:
    """F1 unigrams: lower-cased runs of two or more word characters."""
    return F.regexp_extract_all(F.lower(F.coalesce(col(c), F.lit(""))), F.lit(X.TERM_RE), 0)


def ngrams_1_2(c: ColumnOrName) -> Column:
    """unigrams followed by adjacent-pair bigrams."""
    u = terms(c)
    big = F.transform(F.sequence(F.lit(1), F.size(u) - 1),
                      lambda i: F.concat(F.element_at(u, i), F.lit(" "), F.element_at(u, i + 1)))
    return F.when(F.size(u) > 1, F.concat(u, big)).otherwise(u)
