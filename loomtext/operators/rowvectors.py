"""TF-IDF and linear scoring row by row (F3, F4, F11-F13), against a fitted vocabulary.

A fitted vocabulary of at most ``max_features`` terms (a documented bound) is two arrays, sent to
the workers once. A row's terms are counted, weighted and scored inside the row, a batch of rows at a
time: no shuffle, grouping or window, so a table and a stream take the same path. Only the fit
shuffles, and of it only ``(term, counts)``, combined before the shuffle.

Every row is a document of its own. A null or empty text, or one without a known term, has an empty
vector and keeps its row; its margins are the intercepts.
"""
from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import argmax_label, softmax
from ..functions.tokens import col
from ..session import ship_package, written_table
from .blocks import trim


def _words(units: pa.ListArray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Row and code of every unigram (null: -1), and the distinct unigrams."""
    row = np.repeat(np.arange(len(units), dtype=np.int32), units.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    words = units.flatten().dictionary_encode()
    return row, pc.fill_null(words.indices, -1).to_numpy(zero_copy_only=False), words.dictionary


def _neighbours(row: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Whether another unigram of their row follows, for all unigrams but the last."""
    return (row[1:] == row[:-1]) & (code[1:] >= 0) & (code[:-1] >= 0)


def _counted(code: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct codes (int64, overwritten), ascending, in how many of the ``n`` rows each stands, and how often."""
    if not len(code):
        return (np.zeros(0, np.int64),) * 3
    first = None
    if int(code.max()) + 1 >= (1 << 62) // n:
        first, code = np.unique(code, return_inverse=True)
    code *= n
    code += row
    code.sort()  # one number for a code and its row: nothing else of this size is held
    new = np.empty(len(code), dtype=bool)
    new[0] = True
    np.not_equal(code[1:], code[:-1], out=new[1:])
    code //= n
    start = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
    df, cf = np.add.reduceat(new, start, dtype=np.int64), np.diff(start, append=len(code))
    code = code[start]
    return code if first is None else first[code], df, cf


class _Grams:
    """Terms of some rows by number: unigrams, then bigrams; their texts are made a slice at a time."""

    def __init__(self, units: pa.ListArray, bigrams: bool, most: int | None = None):
        row, code, self.words = _words(units)
        n, self.size, self.least = max(1, len(units)), len(self.words), 0
        own = code >= 0
        if bigrams and pc.any(pc.match_substring(self.words, " ")).as_py():  # a unigram may read as a bigram does: count by the text
            at = np.flatnonzero(_neighbours(row, code))
            texts = pa.concat_arrays([self.words.take(pa.array(code[own])), pc.binary_join_element_wise(
                self.words.take(pa.array(code[at])), self.words.take(pa.array(code[at + 1])), " ")]).dictionary_encode()
            self.words, self.size = texts.dictionary, len(texts.dictionary)
            parts = [_counted(texts.indices.to_numpy().astype(np.int64), np.concatenate([row[own], row[at]]), n)]
        else:
            parts = [_counted(code[own].astype(np.int64), row[own], n)]
            if bigrams:
                at = _neighbours(row, code)
                pair = code[:-1][at].astype(np.int64)
                pair += 1  # after all unigrams
                pair *= self.size
                pair += code[1:][at]
                row = row[:-1][at]
                del code, at
                parts.append(_counted(pair, row, n))
        del row
        if most is not None and sum(len(p[2]) for p in parts) > most:
            cf = np.concatenate([p[2] for p in parts])
            cf.partition(len(cf) - most - 1)
            self.least = int(cf[len(cf) - most - 1])
            parts = [tuple(x[p[2] > self.least] for x in p) for p in parts]
        self.code, self.df, self.cf = (np.concatenate(x) for x in zip(*parts))

    def terms(self, of: slice = slice(None)) -> pa.Array:
        code, at = self.code[of], int(np.searchsorted(self.code[of], self.size))
        one, two = self.words.take(pa.array(code[:at])).cast(pa.string()), code[at:]
        if not len(two):
            return one
        return pa.concat_arrays([one, pc.binary_join_element_wise(self.words.take(pa.array(two // self.size - 1)),
                                                                  self.words.take(pa.array(two % self.size)), " ").cast(pa.string())])


def gram_counts(units: pa.ListArray, bigrams: bool, most: int | None = None) -> tuple[pa.Array, np.ndarray, np.ndarray, int]:
    """Terms of some rows, the rows and places that each has, and the count that none of those left out exceeds: with
    ``most``, only that many of the most frequent are kept (fewer at a tie)."""
    found = _Grams(units, bigrams, most)
    return found.terms(), found.df, found.cf, found.least


def runs(batches, column: str, words: int):
    """List arrays of consecutive batches that hold about ``words`` entries together (one batch more at most)."""
    held, n = [], 0
    for b in batches:
        held.append(_list(b.column(column)))
        n += len(held[-1].flatten())
        if n >= words:
            yield pa.concat_arrays(held)
            held, n = [], 0
    if held:
        yield pa.concat_arrays(held)


def term_stats(df: DataFrame, units: Column | str, bigrams: bool = True, most: int | None = None) -> DataFrame:
    """``(term, df, cf)`` of an array column of unigrams, counted in the tasks, ``COUNT_WORDS`` words at a time, before
    they are shuffled. With ``most`` (see ``frequent_terms``) the counts are lower bounds, ``left_out`` says by how much
    the parts that sent a term bound it otherwise, and a null term has the sum of all parts."""
    ship_package(df.sparkSession)
    rows = df.select(F.coalesce(col(units), F.array().cast("array<string>")).alias("__units"))

    def count(batches):
        whole = (p for b in batches for p in pieces(b, "__units", COUNT_WORDS))
        for lists in runs(whole, "__units", COUNT_WORDS):
            found = _Grams(lists, bigrams, most)
            del lists
            for at in range(0, len(found.code), SENT):
                to = slice(at, at + SENT)
                yield sent(found.terms(to), found.df[to], found.cf[to], found.least)
            if found.least:
                yield sent(pa.nulls(1, pa.string()), [0], [0], found.least)
            del found
        trim()

    def sent(terms, df, cf, least):
        return pa.RecordBatch.from_arrays([terms, pa.array(df, pa.int64()), pa.array(cf, pa.int64()), pa.array(np.full(len(terms), least))],
                                          ["term", "df", "cf", "left_out"])

    parts = rows.mapInArrow(count, "term string, df long, cf long, left_out long")
    more = [] if most is None else [F.sum("left_out").alias("left_out")]
    return parts.groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"), *more)


def frequent_terms(df: DataFrame, units: Column | str, n_docs: int, max_features: int, min_df: int = 2, max_df: float = 1.0,
                   bigrams: bool = True, most: int | None = None) -> DataFrame:
    """``(term, df, cf)``, exact, of all terms that can be among the ``max_features`` most frequent ones within the
    bounds on df (others may be there too).

    Every part of the rows sends its ``most`` most frequent terms; a term that a part left out has at most its largest
    count left out. Terms whose sums are sure to hold give a count that the last of the ``max_features`` reaches; those
    whose upper bound stays below it are out, and the few that are left are counted anew in all rows. If the bounds
    don't tell enough, all terms are counted."""
    most = most or 4 * max_features
    seen = written_table(term_stats(df, units, bigrams, most), "seen")
    out = seen.where("term IS NULL").select("left_out").collect()
    if not out:  # no part left out a term
        return seen.select("term", "df", "cf")
    unseen = F.lit(out[0][0]) - F.col("left_out")
    seen = seen.where("term IS NOT NULL").withColumn("most", F.col("cf") + unseen)
    sure = seen.where((F.col("df") >= min_df) & (F.col("df") + unseen <= F.lit(float(max_df)) * n_docs))
    floor = frequency_cut(sure, max_features)
    if floor is not None and floor[0] > out[0][0]:
        names = seen.where(F.col("most") >= floor[0]).select("term")
        if names.count() <= 2 * most:
            return counts_of(df, units, names.toArrow()["term"].combine_chunks(), bigrams)
    return term_stats(df, units, bigrams)


def frequency_cut(stats: DataFrame, k: int):
    """``cf`` of the ``k``-th most frequent term, how many terms reach it, and how many have it; none if there are fewer."""
    hist = stats.groupBy("cf").agg(F.count("*").alias("__n"))
    w = Window.orderBy(F.desc("cf")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = hist.withColumn("__cum", F.sum("__n").over(w))
    row = cum.filter(F.col("__cum") >= k).orderBy("__cum").limit(1).collect()
    return (row[0]["cf"], row[0]["__cum"], row[0]["__n"]) if row else None


def counts_of(df: DataFrame, units: Column | str, terms: pa.Array, bigrams: bool = True) -> DataFrame:
    """``(term, df, cf)`` of the given terms, summed in every task."""
    ship_package(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(Known(terms))
    rows = df.select(F.coalesce(col(units), F.array().cast("array<string>")).alias("__units"))

    def count(batches):
        known = shared.value
        df, cf = np.zeros(len(known.terms), np.int64), np.zeros(len(known.terms), np.int64)
        for lists in (_list(p.column("__units")) for b in batches for p in pieces(b, "__units")):
            _, idx, tf = row_counts(lists, known, bigrams)
            df += np.bincount(idx, minlength=len(df))
            cf += np.bincount(idx, tf, minlength=len(cf)).astype(np.int64)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([known.terms.take(pa.array(at)), pa.array(df[at]), pa.array(cf[at])], ["term", "df", "cf"])
        trim()

    return rows.mapInArrow(count, "term string, df long, cf long").groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))


class Known:
    """Terms to be found in rows of unigrams. A term is a unigram, or two of them with a space between: those are
    looked up by the numbers of their words, after a table of bits that most other pairs don't pass."""

    BITS = 22

    def __init__(self, terms: pa.Array):
        self.terms = terms = terms.combine_chunks() if isinstance(terms, pa.ChunkedArray) else terms
        pairs = [(t[:i], t[i + 1:], n) for n, t in enumerate(terms.to_pylist()) for i, c in enumerate(t) if c == " "]
        self.words = pa.array(sorted({w for p in pairs for w in p[:2]}), pa.string())
        number = {w: i for i, w in enumerate(self.words.to_pylist())}
        keys = np.array([number[a] * len(number) + number[b] for a, b, _ in pairs], dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.key_term = keys[order], np.array([n for *_, n in pairs], dtype=np.int64)[order]
        self.bits = np.zeros(1 << self.BITS, dtype=bool)
        self.bits[self._bit(self.keys)] = True

    def _bit(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.BITS)

    def of_pairs(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the known pairs among ``(a, b)``, numbers in ``words``, and their terms."""
        if not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        keys = a * len(self.words) + b
        at = np.flatnonzero(self.bits[self._bit(keys)])
        place = np.minimum(np.searchsorted(self.keys, keys[at]), len(self.keys) - 1)
        same = self.keys[place] == keys[at]
        return at[same], self.key_term[place[same]]


def row_counts(units: pa.ListArray, known: Known, bigrams: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term number and count of every known term of each row, in this order."""
    row, code, words = _words(units)
    row = row.astype(np.int64)
    number = lambda table: np.append(pc.fill_null(pc.index_in(words, value_set=table), -1).to_numpy(zero_copy_only=False), -1).astype(np.int64)
    term = number(known.terms)[code]
    found, rows = [term[term >= 0]], [row[term >= 0]]
    if bigrams and len(code) > 1:
        word = number(known.words)[code]
        at = np.flatnonzero(_neighbours(row, word))
        place, term = known.of_pairs(word[at], word[at + 1])
        found.append(term)
        rows.append(row[at[place]])
    size = max(1, len(known.terms))
    cell, tf = np.unique(np.concatenate(rows) * size + np.concatenate(found), return_counts=True)
    return cell // size, cell % size, tf


def row_tfidf(units: pa.ListArray, terms: pa.Array | Known, idf: np.ndarray, bigrams: bool) -> tuple[pa.ListArray, pa.ListArray]:
    """Sorted term indices and L2-normalised weights ``(1 + ln tf) * idf`` of each row of unigrams."""
    n = len(units)
    row, idx, tf = row_counts(units, terms if isinstance(terms, Known) else Known(terms), bigrams)
    w = (1.0 + np.log(tf)) * idf[idx]
    w /= np.sqrt(np.bincount(row, w * w, minlength=n))[row]
    ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))]), pa.int32())
    return pa.ListArray.from_arrays(ends, pa.array(idx, pa.int32())), pa.ListArray.from_arrays(ends, pa.array(w, pa.float64()))


def row_margins(idx: pa.ListArray, weight: pa.ListArray, coef: np.ndarray, intercept: np.ndarray) -> np.ndarray:
    """``(rows, classes)`` margins of sparse rows."""
    n = len(idx)
    row = np.repeat(np.arange(n), np.diff(idx.offsets.to_numpy()))
    i, w = idx.flatten().to_numpy(), weight.flatten().to_numpy()
    return np.stack([np.bincount(row, w * c[i], minlength=n) + b for c, b in zip(coef, intercept)], axis=1)


def _list(column) -> pa.ListArray:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


PIECE = 1 << 18  # words or terms that a step of a task holds at a time
COUNT_WORDS = 1 << 21  # words that a task counts together
SENT = 1 << 16  # counts in a batch


def pieces(batch: pa.RecordBatch, column: str, size: int | None = None):
    """The batch in runs of rows that hold ``size`` (``PIECE``) list entries together (a longer row is a run of its own)."""
    ends, size = _list(batch.column(column)).offsets.to_numpy(), size or PIECE
    at = 0
    while at < len(batch):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + size, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to


_VECTOR = [T.StructField("idx", T.ArrayType(T.IntegerType(), False)), T.StructField("weight", T.ArrayType(T.DoubleType(), False))]


class TermModel:
    """A fitted vocabulary: terms in ascending order, their idf, and whether bigrams are terms."""

    def __init__(self, spark: SparkSession, terms: Sequence[str], idf: Sequence[float], bigrams: bool = True):
        ship_package(spark)
        order = sorted(range(len(terms)), key=lambda i: terms[i])
        self.terms, self.idf, self.bigrams = [terms[i] for i in order], np.array([idf[i] for i in order], dtype=float), bigrams
        self.shared = spark.sparkContext.broadcast((Known(pa.array(self.terms, pa.string())), self.idf))

    def weighed(self, df: DataFrame, units: Column | str, keep: Sequence[str]) -> RowVectors:
        """The vectors of a column of unigrams, made in the worker that scores or ranks them."""
        keep = list(keep)
        rows = df.select(*keep, F.coalesce(col(units), F.array().cast("array<string>")).alias("__units"))
        return RowVectors(self, rows, {f.name: f for f in rows.schema.fields[:len(keep)]})

    def vectors(self, df: DataFrame, units: Column | str, keep: Sequence[str]) -> DataFrame:
        """``keep`` columns, ``idx array<int>`` and ``weight array<double>`` of a column of unigrams."""
        keep = list(keep)
        source, fields, read = _source(self.weighed(df, units, keep))

        def weigh(batches):
            for row in read(batches):
                yield pa.RecordBatch.from_arrays([row(c) for c in (*keep, "idx", "weight")], [*keep, "idx", "weight"])
            trim()

        return source.mapInArrow(weigh, T.StructType([fields[c] for c in (*keep, "idx", "weight")]))

    def long(self, df: DataFrame, units: Column | str, keep: Sequence[str]) -> DataFrame:
        """``(keep, term, weight)``, one row per term of a row of ``df``."""
        shared, bigrams, keep = self.shared, self.bigrams, list(keep)
        rows = df.select(*keep, F.coalesce(col(units), F.array().cast("array<string>")).alias("__units"))

        def weigh(batches):
            terms, idf = shared.value
            for b in (p for b in batches for p in pieces(b, "__units")):
                idx, w = row_tfidf(_list(b.column("__units")), terms, idf, bigrams)
                row = pa.array(np.repeat(np.arange(len(idx)), np.diff(idx.offsets.to_numpy())))
                yield pa.RecordBatch.from_arrays([*[b.column(c).take(row) for c in keep], terms.terms.take(idx.flatten()), w.flatten()],
                                                 [*keep, "term", "weight"])

        return rows.mapInArrow(weigh, T.StructType([*rows.schema.fields[:len(keep)], T.StructField("term", T.StringType()),
                                                    T.StructField("weight", T.DoubleType())]))


class RowVectors:
    """Rows of unigrams, weighed by a model in the worker that uses them: one worker for all steps of a task, and no vector
    goes back to Spark between two steps."""

    def __init__(self, model: TermModel, rows: DataFrame, fields: dict[str, T.StructField], classed=None):
        self.model, self.rows, self.fields, self.classed, self.sparkSession = model, rows, fields, classed, rows.sparkSession

    def with_class(self, name: str, coef: np.ndarray, intercept: Sequence[float], digits: int = 9) -> RowVectors:
        """With the number of the class of the largest margin, rounded to ``digits`` (tie: the first)."""
        shared = self.sparkSession.sparkContext.broadcast((np.atleast_2d(coef), np.asarray(intercept, dtype=float)))

        def classed(idx: pa.ListArray, weight: pa.ListArray) -> pa.Array:
            return pa.array(np.round(row_margins(idx, weight, *shared.value), digits).argmax(axis=1).astype(np.int32))

        return RowVectors(self.model, self.rows, self.fields | {name: T.StructField(name, T.IntegerType())}, (name, classed))


def _source(vectors: DataFrame | RowVectors):
    """The table to map, its fields by name, and a function from its batches to the columns, by name, of bounded pieces."""
    if isinstance(vectors, RowVectors):
        shared, bigrams, classed = vectors.model.shared, vectors.model.bigrams, vectors.classed

        def read(batches):
            terms, idf = shared.value
            for b in (p for b in batches for p in pieces(b, "__units")):
                idx, w = row_tfidf(_list(b.column("__units")), terms, idf, bigrams)
                own = {"idx": idx, "weight": w} | ({classed[0]: classed[1](idx, w)} if classed else {})
                yield lambda c, b=b, own=own: own[c] if c in own else b.column(c)

        return vectors.rows, vectors.fields | {f.name: f for f in _VECTOR}, read

    def read(batches):
        for b in (p for b in batches for p in pieces(b, "idx")):
            yield b.column

    return vectors, {f.name: f for f in vectors.schema.fields}, read


def fit_terms(df: DataFrame, units: Column | str, n_docs: int, max_features: int, min_df: int = 2,
              max_df: float = 1.0, bigrams: bool = True) -> TermModel:
    """the ``max_features`` most frequent terms (tie: term ascending) and their smoothed idf."""
    from .vectors import idf_table, vocabulary_of
    vocab = idf_table(vocabulary_of(frequent_terms(df, units, n_docs, max_features, min_df, max_df, bigrams), n_docs, min_df, max_df, max_features), n_docs)
    rows = vocab.toArrow()  # at most max_features rows
    return TermModel(df.sparkSession, rows["term"].to_pylist(), rows["idf"].to_pylist(), bigrams)


def margins(vectors: DataFrame | RowVectors, keep: Sequence[str], coef: np.ndarray, intercept: Sequence[float]) -> DataFrame:
    """``keep`` columns and ``margins array<double>``, one per class; ``coef`` is (classes, terms)."""
    keep = list(keep)
    shared = vectors.sparkSession.sparkContext.broadcast((np.atleast_2d(coef), np.asarray(intercept, dtype=float)))
    source, fields, read = _source(vectors)

    def score(batches):
        c, b0 = shared.value
        for row in read(batches):
            m = row_margins(_list(row("idx")), _list(row("weight")), c, b0)
            ends = pa.array(np.arange(m.shape[0] + 1) * m.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays([*[row(k) for k in keep], pa.ListArray.from_arrays(ends, pa.array(m.ravel()))], [*keep, "margins"])
        trim()

    return source.mapInArrow(score, T.StructType([*[fields[c] for c in keep], T.StructField("margins", T.ArrayType(T.DoubleType(), False))]))


def score_binary_rows(vectors: DataFrame | RowVectors, keep: Sequence[str], coef: np.ndarray, intercept: float = 0.0, threshold: float = 0.5) -> DataFrame:
    """probability of the second class and the label at ``threshold``."""
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("margins")[0]))
    return (margins(vectors, keep, coef, [intercept]).select(*keep, p.alias("prob"))
            .withColumn("pred", (F.col("prob") >= threshold).cast("int")))


def score_multiclass_rows(vectors: DataFrame | RowVectors, keep: Sequence[str], coef: np.ndarray, intercept: Sequence[float], labels: Sequence[str]) -> DataFrame:
    """softmax of the margins as a map, its best label (tie: smaller label) and confidence."""
    scores = F.map_from_arrays(F.array(*[F.lit(x) for x in labels]), softmax("margins"))
    best = argmax_label(F.col("scores"))
    return (margins(vectors, keep, coef, intercept).select(*keep, scores.alias("scores"))
            .select(*keep, "scores", best["label"].alias("label_pred"), best["confidence"].alias("confidence")))


def top_features_rows(vectors: DataFrame | RowVectors, keep: Sequence[str], model: TermModel, coef: np.ndarray, n: int,
                      positive_only: bool = False, cls: str | None = None) -> DataFrame:
    """``keep``, ``term``, ``contribution``, ``rank``: per row the ``n`` largest products of weight and coefficient
    (tie: term ascending), of the class whose number ``cls`` holds (null or unknown: no rows), else of the first."""
    keep, terms = list(keep), model.shared
    shared = vectors.sparkSession.sparkContext.broadcast(np.atleast_2d(coef))
    source, fields, read = _source(vectors)

    def best(batches):
        names = terms.value[0].terms
        c = shared.value
        for column in read(batches):
            idx, w = _list(column("idx")), _list(column("weight"))
            row = np.repeat(np.arange(len(idx)), np.diff(idx.offsets.to_numpy()))
            i = idx.flatten().to_numpy()
            k = np.zeros(len(idx), dtype=np.int64) if cls is None else pc.fill_null(column(cls), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            known = (k >= 0) & (k < len(c))
            v = np.round(w.flatten().to_numpy() * c[np.where(known, k, 0)[row], i], 9)
            use = np.flatnonzero(known[row] & ~np.isnan(v) & ((v > 0) | (not positive_only)))  # NaN: a term without a coefficient
            use = use[np.lexsort((i[use], -v[use], row[use]))]
            r = row[use]
            place = np.arange(len(r)) - np.searchsorted(r, r)
            use, place = use[place < n], place[place < n]
            yield pa.RecordBatch.from_arrays([*[column(x).take(pa.array(row[use])) for x in keep], names.take(pa.array(i[use])),
                                              pa.array(v[use]), pa.array(place + 1, pa.int32())], [*keep, "term", "contribution", "rank"])

        trim()

    return source.mapInArrow(best, T.StructType([*[fields[x] for x in keep], T.StructField("term", T.StringType()), T.StructField("contribution", T.DoubleType()),
                                                  T.StructField("rank", T.IntegerType())]))
