"""TF-IDF (F1-F5), dense vectors (F6, G2), sparse/dense top-k.

Sparse vectors live in a long table ``(id, term, weight)``; dense vectors in
an ``ARRAY<FLOAT>`` column. Similarity search never materialises all pairs:

* sparse: postings joined on term, summed per (query, candidate); top-k reads
  only the postings that a query's bounds leave (``topk.py``); the query side is
  broadcast only below a counted row bound, otherwise both sides are salted on
  the candidate hash so a frequent term spreads over many tasks;
* dense: candidates lie in cells around pivots, queries visit the cells whose
  bound reaches the score they need (``cells.py``); candidates are sent in bounded
  blocks, queries stream by in tiles, and no vector is shuffled for a pair;
* sparse top-k is two-stage (per query and candidate bucket, then per query),
  so no task sorts all candidates of one query.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import tokens as TK
from ..plans.prefix import position
from ..session import written_table
from .blocks import Rows, drop_self, hits
from .cells import Cells, vectors
from .rowvectors import TermModel, fit_terms, frequency_cut, frequent_terms, term_stats
from .sparsetiles import sparse_best_pairs
from .topk import meet, pruned_pairs, topk_per_query


# ---------------------------------------------------------------------------
# F1-F5 TF-IDF
# ---------------------------------------------------------------------------
def term_counts(df: DataFrame, id_col: str, text: Column | str, bigrams: bool = True) -> DataFrame:
    """``(id, term, tf)`` from unigrams (+ bigrams)."""
    t = F.col(text) if isinstance(text, str) else text
    uni = df.select(F.col(id_col).alias("id"), TK.terms(t).alias("__u"))
    if bigrams:
        big = F.transform(F.sequence(F.lit(1), F.size("__u") - 1),
                          lambda i: F.concat(F.element_at("__u", i), F.lit(" "), F.element_at("__u", i + 1)))
        grams = F.when(F.size("__u") > 1, F.concat("__u", big)).otherwise(F.col("__u"))
    else:
        grams = F.col("__u")
    # partitioned by document: the count, the idf join (broadcast) and the
    # per-document norm then run without further shuffles
    return (uni.select("id", F.explode(grams).alias("term")).repartition("id")
            .groupBy("id", "term").agg(F.count("*").alias("tf")))


def build_vocabulary(tf: DataFrame, n_docs: int | Column, min_df: int = 2, max_df: float = 1.0,
                     max_features: int | None = None) -> DataFrame:
    """``(term, df, cf)`` with df >= min_df, df <= max_df * n_docs, then
    the ``max_features`` most frequent terms (tie: term ascending)."""
    return vocabulary_of(tf.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf")),
                         n_docs, min_df, max_df, max_features)


def text_vocabulary(df: DataFrame, id_col: str, text: Column | str, min_df: int = 2, max_df: float = 1.0,
                    max_features: int | None = None) -> DataFrame:
    """F2 of texts: ``(term, df, cf)`` as ``build_vocabulary`` has it from their ``term_counts``. Where every id has one
    row, documents are counted in the tasks, and only what can be in a capped vocabulary is shuffled."""
    units = written_table(df.select(F.col(id_col).alias("id"), TK.terms(text).alias("units")), "units")
    n_docs = units.count()
    if units.groupBy("id").count().where("count > 1").limit(1).count():  # rows of an id are one document
        return build_vocabulary(term_counts(df, id_col, text), n_docs, min_df, max_df, max_features)
    stats = frequent_terms(units, "units", n_docs, max_features, min_df, max_df) if max_features else term_stats(units, "units")
    return vocabulary_of(stats, n_docs, min_df, max_df, max_features)


def vocabulary_of(stats: DataFrame, n_docs: int | Column, min_df: int = 2, max_df: float = 1.0,
                  max_features: int | None = None) -> DataFrame:
    """F2 from ``(term, df, cf)``."""
    n = F.lit(n_docs) if isinstance(n_docs, int) else n_docs
    kept = stats.filter((F.col("df") >= min_df) & (F.col("df") <= F.lit(float(max_df)) * n))
    if max_features:
        # read by the cutoff, the tie ranking and the result: written once
        kept = _top_by_frequency(written_table(kept, "terms"), max_features)
    return kept


def _top_by_frequency(stats: DataFrame, k: int) -> DataFrame:
    """The ``k`` terms with the largest ``cf`` (tie: term ascending), exact.

    A global ``orderBy().limit(k)`` merges k rows from every partition in one
    task. Instead: the histogram of distinct ``cf`` values (small: distinct
    frequencies, not terms) gives the cutoff frequency; every term above it is
    kept, and only the terms *at* the cutoff are ordered by name."""
    found = frequency_cut(stats, k)
    if not found:                     # fewer than k terms: keep all
        return stats
    cut, cum_at, n_at = found
    above = stats.filter(F.col("cf") > cut)
    need = k - (cum_at - n_at)        # how many of the tied terms fit
    tied = position(stats.filter(F.col("cf") == cut), ["term"], "__pos")
    return above.unionByName(tied.filter(F.col("__pos") <= need).drop("__pos"))


def idf_table(vocab: DataFrame, n_docs: int) -> DataFrame:
    """F3 idf: ``ln((1 + n) / (1 + df)) + 1``."""
    return vocab.select("term", (F.log((F.lit(1.0) + n_docs) / (F.col("df") + 1.0)) + 1.0).alias("idf"))


def tfidf_weights(tf: DataFrame, idf: DataFrame, bounded_vocab: bool) -> DataFrame:
    """``(id, term, weight)``, sublinear tf, L2-normalised per id.

    Terms outside the vocabulary are ignored. The idf table is broadcast
    only when the vocabulary is capped (``bounded_vocab``)."""
    side = F.broadcast(idf) if bounded_vocab else idf
    w = tf.join(side, "term").withColumn("w", (F.lit(1.0) + F.log("tf")) * F.col("idf"))
    if bounded_vocab:
        # stream side keeps its partitioning by id: a window needs no shuffle
        norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("id")))
        return w.select("id", "term", (F.col("w") / norm).alias("weight"))
    norms = w.groupBy("id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("__n"))
    return (w.join(norms, "id").select("id", "term", (F.col("w") / F.col("__n")).alias("weight")))


class TfidfModel:
    """Fitted vocabulary + idf; ``transform`` weights new text (F4). A capped vocabulary weighs row by row
    (``rows``), any other by a join with ``idf``."""

    def __init__(self, bigrams: bool, idf: DataFrame | None = None, rows: TermModel | None = None):
        self.bigrams, self.idf, self.rows = bigrams, idf, rows

    def transform(self, df: DataFrame, id_col: str, text: Column | str) -> DataFrame:
        if self.rows is not None:
            return self.rows.long(df.select(F.col(id_col).alias("id"), TK.terms(text).alias("units")), "units", ["id"])
        return tfidf_weights(term_counts(df, id_col, text, self.bigrams), self.idf, False)

    def vectors(self, df: DataFrame, id_col: str, text: Column | str) -> DataFrame:
        """``(id, idx, weight)``, one row a document, of a capped vocabulary."""
        return self.rows.vectors(df.select(F.col(id_col).alias("id"), TK.terms(text).alias("units")), "units", ["id"])


def fit_tfidf(df: DataFrame, id_col: str, text: Column | str, min_df: int = 2,
              max_df: float = 1.0, max_features: int | None = None,
              bigrams: bool = True) -> tuple[TfidfModel, DataFrame]:
    """fit on ``df``, one row a document, and return (model, weights of ``df``).

    The cleaned words feed the vocabulary and the weights, so they are kept (spilling to disk; lost blocks recompute)."""
    if max_features:
        model, units = fit_tfidf_units(df, id_col, text, min_df, max_df, max_features, bigrams)
        return model, model.rows.long(units, "units", ["id"])
    tf = term_counts(df, id_col, text, bigrams).persist(StorageLevel.MEMORY_AND_DISK)
    n_docs = df.count()
    vocab = build_vocabulary(tf, n_docs, min_df, max_df)
    model = TfidfModel(bigrams, idf=idf_table(vocab, n_docs))
    return model, tfidf_weights(tf, model.idf, False)


def fit_tfidf_units(df: DataFrame, id_col: str, text: Column | str, min_df: int, max_df: float, max_features: int,
                    bigrams: bool = True) -> tuple[TfidfModel, DataFrame]:
    """The model of a capped vocabulary and the kept words ``(id, units)`` that it was fitted on."""
    units = written_table(df.select(F.col(id_col).alias("id"), TK.terms(text).alias("units")), "units")
    rows = fit_terms(units, "units", units.count(), max_features, min_df, max_df, bigrams)
    return TfidfModel(bigrams, rows=rows), units


def fit_joint_corpus(a: DataFrame, b: DataFrame, id_col: str, text: str, **kw):
    """vocabulary fitted on both sides stacked; ids must not collide."""
    both = a.select(id_col, text).unionByName(b.select(id_col, text))
    return fit_tfidf(both, id_col, text, **kw)


# ---------------------------------------------------------------------------
# G1 sparse cosine
# ---------------------------------------------------------------------------
def cosine_sparse(q: DataFrame, c: DataFrame, exclude_self: bool = False, salts: int = 16) -> DataFrame:
    """G1: ``(qid, cid, score)`` for every pair sharing a term.

    ``q``/``c``: ``(id, term, weight)`` with unit-length vectors."""
    pairs = meet(q.select(F.col("id").alias("qid"), "term", F.col("weight").alias("wq")), c, exclude_self, salts)
    return pairs.groupBy("qid", "cid").agg(F.sum("part").alias("score"))


def fill_topk(top: DataFrame, queries: DataFrame, qid: str, cands: DataFrame, cid: str, k: int,
              exclude_self: bool = False) -> DataFrame:
    """Candidates of score 0 by ascending id where fewer than ``k`` scored, so that every query has ``k`` rows
    when there are ``k`` candidates. Only the least ``2 k + 1`` ids can be needed: no pairing with the bank."""
    spare = [r[0] for r in cands.select(F.col(cid).alias("c")).where("c IS NOT NULL").distinct().orderBy("c").limit(2 * k + 1).collect()]
    if not spare:
        return top
    have = top.groupBy("qid").agg(F.collect_set("cid").alias("__cids"))
    short = (queries.select(F.col(qid).alias("qid")).distinct().join(have, "qid", "left")
             .withColumn("__cids", F.coalesce("__cids", F.array().cast("array<bigint>"))).where(F.size("__cids") < k))
    taken = F.array_union("__cids", F.array("qid")) if exclude_self else F.col("__cids")
    free = F.slice(F.array_except(F.array(*[F.lit(c).cast("bigint") for c in spare]), taken), F.lit(1), F.lit(k) - F.size("__cids"))
    fill = (short.select("qid", F.size("__cids").alias("__n"), F.posexplode(free).alias("__p", "cid"))
            .select("qid", "cid", F.lit(0.0).alias("score"), (F.col("__n") + F.col("__p") + 1).cast("int").alias("rank")))
    return top.select("qid", "cid", "score", "rank").unionByName(fill)


def sparse_topk(q: DataFrame, c: DataFrame, k: int, exclude_self: bool = False,
                queries: tuple[DataFrame, str] | None = None, cands: tuple[DataFrame, str] | None = None) -> DataFrame:
    """Top-k candidates per query by sparse cosine. Long tables ``(id, term, weight)``: postings pruned by
    bounds (``topk.py``). Rows ``(id, idx, weight)`` of one fitted vocabulary: scored in tiles, each of which gives its
    best (``sparsetiles.py``), no term is shuffled alone. With ``queries`` and ``cands`` (a table and its id
    column) candidates without a common term rank too, at score 0, as do all of a query without terms."""
    if "idx" in c.columns:
        scored = sparse_best_pairs(q, c, k, exclude_self)
    else:
        scored = pruned_pairs(q, c, k, exclude_self).where(F.round("score", 6) > 0)
    top = topk_per_query(scored, k)
    # read twice by the filling
    return fill_topk(written_table(top, "top"), *queries, *cands, k, exclude_self) if queries and cands else top


def require_id(df: DataFrame, id_col: str, value) -> DataFrame:
    """The row of a known id; an unknown one is an IndexError."""
    row = df.where(F.col(id_col) == value)
    if not row.limit(1).count():
        raise IndexError(f"no profile {value!r}")
    return row


# ---------------------------------------------------------------------------
# F6, G2 dense vectors
# ---------------------------------------------------------------------------
def l2_normalize(v: Column | str) -> Column:
    """unit-length vector (zero vectors stay zero)."""
    a = F.col(v) if isinstance(v, str) else v
    x = F.transform(a, lambda e: e.cast("double"))
    n = F.sqrt(F.aggregate(x, F.lit(0.0), lambda s, e: s + e * e))
    # the norm stands outside the lambda: computed for a vector, not for each of its elements
    return F.when(n > 0, F.zip_with(x, F.array_repeat(n, F.size(x)), lambda e, m: e / m)).otherwise(x)


def dot(a: Column | str, b: Column | str) -> Column:
    """G2 for one pair: sum of element products (cosine for unit vectors)."""
    ac = F.col(a) if isinstance(a, str) else a
    bc = F.col(b) if isinstance(b, str) else b
    return F.aggregate(F.zip_with(ac, bc, lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0), lambda s, e: s + e)


_PAIR_SCHEMA = "qid long, cid long, score double"
TILE_Q, TILE_C = 2048, 8192  # queries in a tile; candidates that eight cells have
STEP = 1 << 19  # products at a time of a pair of tiles


def _steps(q: Rows, c: Rows, vec: str = "vec"):
    """(slice of the queries, products with all candidates), a bounded block at a time."""
    qm, cm = q[vec], c[vec].T
    step = max(1, STEP // max(1, len(c)))
    for at in range(0, len(q), step):
        yield slice(at, at + step), qm[at:at + step] @ cm


def _top_of(s: np.ndarray, cids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the ``k`` best scores of each row, best first (tie: least id); -inf never."""
    kk = min(k, len(cids))
    least = np.partition(s, len(cids) - kk, axis=1)[:, len(cids) - kk]
    row, col = np.nonzero((s >= least[:, None]) & np.isfinite(s))
    order = np.lexsort((cids[col], -s[row, col], row))
    row, col = row[order], col[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < kk], col[place < kk]


def _block_scores(q: Rows, c: Rows, exclude_self: bool, digits: int, min_score: float) -> pd.DataFrame:
    qids, cids, out = q["id"], c["id"], []
    for part, s in _steps(q, c):
        if exclude_self:
            drop_self(s, qids[part], cids)
        row, col = hits(s >= min_score - _slack(digits))
        score = np.round(s[row, col], digits)  # of those near enough
        keep = score >= min_score
        out.append((qids[part][row[keep]], cids[col[keep]], score[keep]))
    return pd.DataFrame(dict(zip(("qid", "cid", "score"), map(np.concatenate, zip(*out)))))


def dense_pairs(queries: DataFrame, qid: str, qvec: Column | str, cands: DataFrame, cid: str,
                cvec: Column | str, min_score: float, exclude_self: bool = False, tile_q: int = TILE_Q,
                tile_c: int = TILE_C, digits: int = 6) -> DataFrame:
    """Every pair whose rounded product is at least ``min_score`` (theta join); a query meets only the cells
    that can hold such a candidate (``cells.py``)."""
    cells = Cells(cands, cid, cvec, tile_c)
    q = vectors(queries, qid, qvec)
    q = q.withColumn("cells", cells.within("vec", F.lit(min_score - _slack(digits))))
    return cells.search(q, tile_q, lambda a, b: _block_scores(a, b, exclude_self, digits, min_score), _PAIR_SCHEMA)


def dense_topk(queries: DataFrame, qid: str, qvec: Column | str, cands: DataFrame, cid: str,
               cvec: Column | str, k: int, exclude_self: bool = False, tile_q: int = TILE_Q,
               tile_c: int = TILE_C, digits: int = 6, cells: Cells | None = None) -> DataFrame:
    """Exact top-k by dot product (cosine on unit vectors): the nearest cells first, then those whose bound
    reaches the k-th score found there."""
    cells = cells or Cells(cands, cid, cvec, tile_c)
    pairs = cells.best(vectors(queries, qid, qvec), tile_q, k, exclude_self, digits, _slack(digits), STEP)
    w = Window.partitionBy("qid").orderBy(F.desc("score"), "cid")
    return pairs.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _slack(digits: int) -> float:
    """What rounding of two scores can hide."""
    return 1.001 * 10.0 ** -digits


_COUNT_SCHEMA = "qid long, n_before long"


def _block_count(q: Rows, c: Rows, digits: int) -> pd.DataFrame:
    cids, counts, slack = c["id"], [], _slack(digits)
    for part, s in _steps(q, c):
        s_star, c_star = q["s_star"][part][:, None], q["c_star"][part]
        sure = s > s_star + slack
        row, col = hits((s >= s_star - slack) & ~sure)  # rounding decides
        near, star = np.round(s[row, col], digits), s_star[row, 0]
        before = (near > star) | ((near == star) & (cids[col] < c_star[row]))
        counts.append(sure.sum(axis=1) + np.bincount(row[before], minlength=len(s)))
    return pd.DataFrame({"qid": q["id"], "n_before": np.concatenate(counts).astype(np.int64)})


_BEST_SCHEMA = "qid long, n_relevant long, s_star double, c_star long"


def _best_of(rel: np.ndarray, s: np.ndarray, qids: np.ndarray, cids: np.ndarray) -> pd.DataFrame:
    """Of each row with relevant candidates: how many, and the best by score (tie: least id)."""
    row, col = np.nonzero(rel)
    return _best_of_pairs(row, cids[col], s[row, col], qids)


def _best_of_pairs(row: np.ndarray, cid: np.ndarray, score: np.ndarray, qids: np.ndarray) -> pd.DataFrame:
    """The same of relevant pairs, in the order of their rows."""
    some, start, n = np.unique(row, return_index=True, return_counts=True)
    best = np.maximum.reduceat(score, start) if len(some) else score
    first = np.minimum.reduceat(np.where(score == np.repeat(best, n), cid, np.iinfo(np.int64).max), start) if len(some) else cid
    return pd.DataFrame({"qid": qids[some], "n_relevant": n.astype(np.int64), "s_star": best, "c_star": first})


def _merged_best(parts: pd.DataFrame) -> pd.DataFrame:
    n = parts.groupby("qid")["n_relevant"].sum()
    best = parts.sort_values(["qid", "s_star", "c_star"], ascending=[True, False, True]).drop_duplicates("qid").set_index("qid")
    return best.assign(n_relevant=n).reset_index()


def merge_best(parts: DataFrame) -> DataFrame:
    """``(qid, n_relevant, s_star, c_star)`` of all candidates from those of tiles."""
    return (parts.groupBy("qid").agg(F.sum("n_relevant").alias("n_relevant"), F.min(F.struct((-F.col("s_star")).alias("ns"), "c_star")).alias("b"))
            .select("qid", "n_relevant", (-F.col("b.ns")).alias("s_star"), F.col("b.c_star").alias("c_star")))


def dense_best(queries: DataFrame, qid: str, rel_vec: Column | str, rank_vec: Column | str, cands: DataFrame, cid: str,
               min_score: float, tile_q: int = TILE_Q, tile_c: int = TILE_C, digits: int = 6, cells: Cells | None = None) -> DataFrame:
    """Of every query with candidates whose rounded product of ``rel_vec`` is at least ``min_score``: how many, and which
    of them ``rank_vec`` ranks first, with its score. Counted in the tiles: no pair leaves them. ``cells``: of the
    candidates by ``rel_vec``, where ``rank_vec`` is the same."""
    same = isinstance(rel_vec, str) and rel_vec == rank_vec
    more = [] if same else [(F.col(rank_vec) if isinstance(rank_vec, str) else rank_vec).alias("rank_vec")]
    cells = cells if cells is not None and same else Cells(cands, cid, rel_vec, tile_c, more=more)
    q = vectors(queries, qid, rel_vec, *more)
    q = q.withColumn("cells", cells.within("vec", F.lit(min_score - _slack(digits))))

    def block(a: Rows, b: Rows) -> pd.DataFrame:
        out = []
        for part, r in _steps(a, b):
            row, col = hits(r >= min_score - _slack(digits))
            near = np.round(r[row, col], digits)
            row, col, near = (x[near >= min_score] for x in (row, col, near))
            score = near if same else np.round((a["rank_vec"][part] @ b["rank_vec"].T)[row, col], digits)
            out.append(_best_of_pairs(row, b["id"][col], score, a["id"][part]))
        return pd.concat(out)

    return merge_best(cells.search(q, tile_q, block, _BEST_SCHEMA, _merged_best))


def dense_rank_of(queries: DataFrame, qid: str, qvec: Column | str, s_star: str, c_star: str,
                  cands: DataFrame, cid: str, cvec: Column | str, tile_q: int = TILE_Q,
                  tile_c: int = TILE_C, digits: int = 6, cells: Cells | None = None) -> DataFrame:
    """Number of candidates ranked before ``(s_star, c_star)`` per query (score desc, id asc), counted tile by
    tile in the cells that can hold such a candidate; nothing is emitted per pair."""
    cells = cells or Cells(cands, cid, cvec, tile_c)
    q = vectors(queries, qid, qvec, F.col(s_star).alias("s_star"), F.col(c_star).alias("c_star"))
    q = q.withColumn("cells", cells.within("vec", F.col("s_star") - _slack(digits)))
    counts = cells.search(q, tile_q, lambda a, b: _block_count(a, b, digits), _COUNT_SCHEMA,
                          lambda parts: parts.groupby("qid", as_index=False)["n_before"].sum())
    none = queries.select(F.col(qid).alias("qid"), F.lit(0).cast("long").alias("n_before"))
    return counts.unionByName(none).groupBy("qid").agg(F.sum("n_before").alias("n_before"))
