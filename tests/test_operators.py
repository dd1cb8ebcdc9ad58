"""Operators against hand fixtures and brute force."""
import math

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from loomtext.functions import scalars as S
from loomtext.operators import classify as C
from loomtext.operators import lang as LG
from loomtext.operators import models as M
from loomtext.operators import recmetrics as RM
from loomtext.operators import retrieval as RT
from loomtext.operators import rows as R
from loomtext.operators import splits as SP
from loomtext.operators import stats as ST
from loomtext.operators import vectors as V
from loomtext.sources import io as IO
from loomtext.plans.prefix import position, prefix_sum, prefix_sums


def test_dedup_first_source_wins(spark):
    df = spark.createDataFrame([("same", 1, 0, 5), ("same", 0, 1, 1), ("other", 0, 0, 2)],
                               "text string, label int, source_rank int, id long")
    out = {r.text: r.label for r in R.dedup_keep_first(df, ["text"], ["source_rank", "id"]).collect()}
    assert out == {"same": 1, "other": 0}


def test_dedup_drop_empty_key(spark):
    df = spark.createDataFrame([("", 1), ("a", 2), ("", 3)], "k string, id long")
    assert [r.id for r in R.dedup_keep_first(df, ["k"], ["id"], drop_empty_key=True).collect()] == [2]


def test_first_ids(spark):
    df = spark.createDataFrame([("", 1), ("a", 9), ("a", 4), (None, 6), ("b", 7), (None, 5)], "k string, id long")
    assert sorted(r.id for r in R.first_ids(df, "k", "id", drop_empty_key=True).collect()) == [4, 5, 7]
    assert sorted(r.id for r in R.first_ids(df, "k", "id").collect()) == [1, 4, 5, 7]


def test_first_ids_is_a_hash_aggregate(spark):
    df = spark.range(100).select(F.concat(F.lit("text "), F.col("id") % 7).alias("k"), "id")
    plan = R.first_ids(df, "k", "id", drop_empty_key=True)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_digest_positions_match_window(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise("rest").alias("g"),
                                  R.seeded_key("id").alias("k"))
    got = position(df, ["k", "id"], "pos", partition=["g"], digest=True)
    want = df.withColumn("pos", F.row_number().over(Window.partitionBy("g").orderBy("k", "id")).cast("long"))
    assert got.count() == 5000 and got.select("id", "pos").exceptAll(want.select("id", "pos")).count() == 0


def test_scan_tsv_labelled_latin1(spark, tmp_path):
    (tmp_path / "in.tsv").write_bytes("ham\tcaf\xe9 \xa35\n\nSpam \t  win\tnow \nham\n".encode("latin-1"))
    rows = {(r.label, r.text, r.label_bin) for r in IO.scan_tsv_labelled(spark, str(tmp_path / "in.tsv")).collect()}
    assert rows == {("ham", "caf\xe9 \xa35", 0), ("Spam", "win\tnow", 1), ("ham", "", 0)}


def test_build_chat_record(spark):
    df = spark.createDataFrame([(3, "I ski", "Best slope?")], "id long, bio string, reply string")
    r = df.select(S.build_chat_record("id", "bio", "reply", "m", F.lit(0.5)).alias("r")).first().r
    assert (r.persona_id, r.gen_model, r.temperature) == (3, "m", 0.5)
    assert [m.role for m in r.messages] == ["user", "assistant"]
    assert "I ski" in r.messages[0].content and r.messages[1].content == "Best slope?"


def test_kmeans_finds_two_groups(spark):
    df = spark.createDataFrame([(i, [1.0, 0.01 * i] if i % 2 else [0.01 * i, 1.0]) for i in range(12)],
                               "id long, v array<double>")
    by = {r.id: r.cluster for r in M.kmeans(df, "v", k=2).collect()}
    assert len({by[i] for i in range(0, 12, 2)}) == 1 and len({by[i] for i in range(1, 12, 2)}) == 1
    assert by[0] != by[1]
    assert len({r.cluster for r in M.kmeans(df.limit(3), "v", k=100).collect()}) <= 3


def test_top_features_fixed_coefficients(spark):
    weights = spark.createDataFrame([(1, "x", 0.5), (1, "y", 0.5), (1, "z", 1.0), (2, "x", 1.0), (2, "w", 1.0)],
                                    "id long, term string, weight double")
    coefs = spark.createDataFrame([("x", 2.0), ("y", 2.0), ("z", -1.0)], "term string, coef double")
    got = [(r.id, r["rank"], r.term, r.contribution) for r in
           M.top_features(weights, coefs, n=2).orderBy("id", "rank").collect()]
    assert got == [(1, 1, "x", 1.0), (1, 2, "y", 1.0), (2, 1, "x", 2.0)]
    assert "z" not in [r.term for r in M.top_features(weights, coefs, positive_only=True).collect()]


def test_persona_structured_long_matches_brute_force(spark):
    # personas 1 and 3 hold the same facts (order, case, padding differ);
    # persona 4 has only blank facts and disappears; 5 repeats a fact
    rows = [(1, 0, " I like cats "), (1, 1, "I run"), (2, 0, "i like cats"),
            (3, 0, "i run"), (3, 1, "I LIKE CATS"), (4, 0, "   "), (5, 0, "i run"), (5, 1, "i run")]
    df = spark.createDataFrame(rows, "pid long, turn int, text string")
    out = R.persona_structured_long(df, "pid", ["turn"], "text").collect()
    facts = {}
    for r in out:
        facts.setdefault(r.id, []).append((r.turn, r.fact))
    assert {k: [f for _, f in sorted(v)] for k, v in facts.items()} == {
        1: ["I like cats", "I run"], 2: ["i like cats"], 5: ["i run", "i run"]}
    # brute force: first id per sorted lower-cased fact list
    by_id = {}
    for pid, _, t in sorted(rows):
        if t.strip():
            by_id.setdefault(pid, []).append(t.strip().lower())
    first = {}
    for pid in sorted(by_id):
        first.setdefault(tuple(sorted(by_id[pid])), pid)
    assert set(facts) == set(first.values())


def test_persona_blocks_long(spark):
    lines = ["hello", "3 your persona: before any start", "1 your persona:  I like cats ", "hello there",
             "2 Your Persona: I run", "1 your persona: i run", "2 your persona: I LIKE CATS",
             "1 your persona:", "2 your persona: I swim", None, "10 your persona: I sing\nsecond line", "your persona: no number"]
    df = spark.createDataFrame(list(enumerate(lines)), "line int, text string")
    out = R.persona_blocks(df, None, ["line"], "text").collect()
    assert sorted((r.block_no, r.line, r.fact) for r in out) == [
        (0, 1, "before any start"), (1, 2, "I like cats"), (1, 4, "I run"), (3, 8, "I swim"), (3, 10, "I sing")]
    # by file: block numbers start anew, equal blocks of a later file go
    two = df.withColumn("f", F.lit("a")).unionByName(df.withColumn("f", F.lit("b")))
    out = R.persona_blocks(two, "f", ["line"], "text").collect()
    assert {r.f for r in out} == {"a"} and len(out) == 5
    assert R.persona_blocks(df.limit(0), None, ["line"], "text").count() == 0


def test_detect_layout(spark):
    def kind(rows, schema):
        return R.detect_layout(spark.createDataFrame(rows, schema))
    assert kind([("x", ["a"])], "persona string, other array<string>") == ("structured", "other")
    assert kind([(["a"], ["b"])], "other array<string>, personas array<string>") == ("structured", "personas")
    assert kind([([], "1 your persona: a")], "persona array<string>, text string") == ("text", "text")
    assert kind([("hello",)], "text string") == ("unknown", None)
    assert kind([(1,)], "n int") == ("unknown", None)
    assert kind([], "text string") == ("unknown", None)


def test_linear_scores_and_dictionary_keep_rows_without_terms(spark):
    w = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (2, "zz", 1.0)], "id long, term string, weight double")
    ids = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    coefs = spark.createDataFrame([("a", 0, 1.0), ("b", 0, 0.5), ("a", 1, 3.0)], "term string, cls int, coef double")
    b = {r.id: r for r in M.score_binary_sql(w, coefs.filter("cls = 0").drop("cls"), ids, intercept=-1.0).collect()}
    assert abs(b[1].prob - 1 / (1 + math.exp(-1.0))) < 1e-12 and b[1].pred == 1
    assert all(abs(b[i].prob - 1 / (1 + math.exp(1.0))) < 1e-12 and b[i].pred == 0 for i in (2, 3))
    m = {r.id: r.label_pred for r in M.score_multiclass_sql(w, coefs, ids, ["x", "y"], [0.5, 0.0]).collect()}
    assert m == {1: "y", 2: "x", 3: "x"}
    toks = spark.createDataFrame([(1, ["cats", "run", "cats"]), (2, []), (3, None)], "id long, tokens array<string>")
    dic = spark.createDataFrame([("cats", "cat")], "form string, value string")
    out = {r.id: r.mapped for r in M.dictionary_join(toks, "id", "tokens", dic).collect()}
    assert out == {1: ["cat", "run", "cat"], 2: [], 3: []}


def test_detect_language_reads_whole_texts(spark, monkeypatch):
    # the telling trigrams stand beyond a long common start
    start = "0123456789 " * 60
    train = spark.createDataFrame([(start + "the quick brown fox " * 5, "en"), (start + "der schnelle braune " * 5, "de"),
                                   ("no label here", None)], "text string, lang string")
    test = spark.createDataFrame([(1, start + "the quick fox"), (2, start + "der schnelle"), (3, "short"), (4, None),
                                  (5, "")], "id long, text string")
    prof = LG.fit_profiles(train, "text", "lang")
    want = {1: "en", 2: "de", 3: "und", 4: "und", 5: "und"}
    assert {r.id: r.lang_pred for r in LG.detect_language(test, "id", "text", prof).collect()} == want
    monkeypatch.setattr(LG, "BROADCAST_BYTES", 0)  # the salted join of large profiles
    assert {r.id: r.lang_pred for r in LG.detect_language(test, "id", "text", prof).collect()} == want


def test_prefix_sum_hot_group_matches_window(spark):
    rows = [(0 if i % 3 else 1, i, i % 7) for i in range(3000)]  # group 0 holds 2/3
    df = spark.createDataFrame(rows, "g int, o long, v long")
    got = prefix_sum(df, ["o"], "v", "cs", partition=["g"], slices=16)
    w = Window.partitionBy("g").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    exp = df.withColumn("cs", F.sum("v").over(w))
    assert sorted(got.select("g", "o", "cs").collect()) == sorted(exp.select("g", "o", "cs").collect())
    pos = position(df, ["o"], "p", start=0)
    assert sorted(r.p for r in pos.collect()) == list(range(3000))


def test_null_groups_are_groups(spark):
    df = spark.range(600).select(F.col("id").alias("o"), F.when(F.col("id") % 3 > 0, F.col("id") % 2).alias("g"),
                                 F.md5(F.col("id").cast("string")).alias("m"))
    w = Window.partitionBy("g")
    for order, digest in ((["o"], False), (["m", "o"], True)):
        got = position(df, order, "p", partition=["g"], slices=8, digest=digest).withColumn("e", F.row_number().over(w.orderBy(*order)))
        assert got.count() == 600 and got.where("p <> e").count() == 0
    s = SP.stratified_split(df, "g", "o")
    shares = {(r.g, r.split): r["count"] for r in s.groupBy("g", "split").count().collect()}
    assert shares == {(g, x): n for g in (None, 0, 1) for x, n in (("train", 140), ("val", 30), ("test", 30))}
    lines = spark.createDataFrame([(None, 1, "1 your persona: a"), (None, 2, "2 your persona: b"), ("f", 1, "1 your persona: c")],
                                  "file string, n int, line string")
    assert sorted(r.fact for r in R.persona_blocks(lines, "file", ["n"], "line").collect()) == ["a", "b", "c"]


def test_stratified_split_shares_and_disjoint_groups(spark):
    df = spark.createDataFrame([(i, i % 4 == 0) for i in range(400)], "id long, y boolean")
    s = SP.stratified_split(df, "y", "id")
    counts = {(r.y, r.split): r["count"] for r in s.groupBy("y", "split").count().collect()}
    assert counts[(True, "train")] == 70 and counts[(True, "val")] == 15 and counts[(True, "test")] == 15
    assert counts[(False, "train")] == 210 and counts[(False, "test")] == 45
    g = spark.createDataFrame([(i // 5, i) for i in range(500)], "grp long, id long")
    gs = SP.group_split(g, "grp")
    assert gs.groupBy("grp").agg(F.countDistinct("split").alias("n")).filter("n > 1").count() == 0


def test_diverse_sample_round_robin(spark):
    df = spark.createDataFrame([(1, "A"), (2, "A"), (3, "A"), (4, "B"), (5, "C")], "id long, c string")
    out = R.diverse_sample(df, "c", "id", 4).collect()
    clusters = [r.c for r in out]
    assert sorted(clusters[:3]) == ["A", "B", "C"] and clusters[3] == "A"


def test_same_value_at_k_nulls(spark):
    prof = spark.createDataFrame(
        [(0, "m", "sf, ca", 30.0), (1, "m", "sf, ca", 40.0), (2, "f", "la, ca", None), (3, "", "", 20.0),
         (4, "", "sf", 31.0)], "id long, sex string, loc string, age double")
    recs = spark.createDataFrame(
        [("x", 0, 1), ("x", 0, 2), ("x", 0, 3), ("x", 4, 1), ("x", 1, 3)], "method string, qid long, cid long")
    m = {r.qid: r for r in RM.metadata_metrics(recs, prof, "id", {"sex": "sex"}, "loc", "age").collect()}
    assert m[0].same_sex_at_k == 0.5          # one equal, one different, one blank
    assert m[4].same_sex_at_k is None         # query value blank
    assert m[1].same_sex_at_k is None         # all candidates blank
    assert m[0].same_city_at_k == 0.5
    assert m[0].avg_age_diff == 10.0          # |40-30|, |20-30|; missing age dropped


def test_summarize_eval_skips_null(spark):
    d = spark.createDataFrame([("tfidf", 1, 5, 0.2), ("tfidf", 2, 5, None), ("tfidf", 3, 5, 0.4)],
                              "method string, qid long, top_k int, same_job_at_k double")
    r = RM.summarize_eval(d).first()
    assert r.n_queries == 3 and abs(r.same_job_at_k - 0.3) < 1e-12


def test_prf_zero_not_null(spark):
    df = spark.createDataFrame([("a", "a"), ("b", "a")], "y string, p string")
    prf = {r.label: r for r in C.precision_recall_f1(C.confusion_matrix(df, "y", "p", ["a", "b"])).collect()}
    assert prf["b"].precision == 0.0 and prf["b"].f1 == 0.0 and prf["b"].support == 1


def test_auc_with_ties_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 300)
    s = np.round(rng.random(300) * 0.5 + y * 0.2, 1)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, score double")
    got = C.roc_auc(df, "y", "score", 12).first().auc
    pos, neg = s[y == 1], s[y == 0]
    brute = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert abs(got - brute) < 1e-9


def test_threshold_sweep_lower_cut_on_tie(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.1)], "y int, score double")
    best = C.best_threshold(C.threshold_sweep(df, "y", "score")).first()
    assert best.f1 == 1.0 and abs(best.threshold - 0.30) < 1e-9
    sweep = C.threshold_sweep(df, "y", "score").collect()
    assert len(sweep) == 100


def _vecs(n, d, seed):
    rng = np.random.default_rng(seed)
    m = rng.normal(size=(n, d))
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def test_dense_topk_matches_brute_force(spark):
    q, c = _vecs(30, 8, 1), _vecs(200, 8, 2)
    qdf = spark.createDataFrame([(i, q[i].tolist()) for i in range(30)], "id long, v array<double>")
    cdf = spark.createDataFrame([(i, c[i].tolist()) for i in range(200)], "id long, v array<double>")
    got = V.dense_topk(qdf, "id", "v", cdf, "id", "v", 5, tile_q=7, tile_c=33)
    got = {(r.qid, r.rank): r.cid for r in got.collect()}
    s = np.round(q @ c.T, 6)
    for i in range(30):
        order = sorted(range(200), key=lambda j: (-s[i, j], j))[:5]
        assert [got[(i, k + 1)] for k in range(5)] == order


def test_sparse_topk_matches_brute_force(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(
        ["red apple pie", "green apple", "apple pie recipe", "blue car", "red car fast", "pie"])],
        "id long, text string")
    model, w = V.fit_tfidf(docs, "id", "text", min_df=1, bigrams=False)
    got = V.sparse_topk(w, w, 2, exclude_self=True)
    wl = w.collect()
    vec = {}
    for r in wl:
        vec.setdefault(r.id, {})[r.term] = r.weight
    for qid in range(6):
        scores = {c: round(sum(vec[qid].get(t, 0) * x for t, x in vec[c].items()), 6) for c in vec if c != qid}
        want = [c for c in sorted(scores, key=lambda c: (-scores[c], c)) if scores[c] > 0][:2]
        have = [r.cid for r in sorted(got.filter(F.col("qid") == qid).collect(), key=lambda r: r.rank)]
        assert have == want


def test_tfidf_formula(spark):
    docs = spark.createDataFrame([(0, "a a b"), (1, "aa bb"), (2, "bb")], "id long, text string")
    _, w = V.fit_tfidf(docs, "id", "text", min_df=1, bigrams=False)
    got = {(r.id, r.term): r.weight for r in w.collect()}
    # doc 1: aa (df 1), bb (df 2); n = 3
    w_aa = (1 + math.log(1)) * (math.log(4 / 2) + 1)
    w_bb = (1 + math.log(1)) * (math.log(4 / 3) + 1)
    n = math.hypot(w_aa, w_bb)
    assert abs(got[(1, "aa")] - w_aa / n) < 1e-12 and abs(got[(1, "bb")] - w_bb / n) < 1e-12
    assert (0, "a") not in got  # single characters are not terms


def test_random_baseline_distinct_others(spark):
    c = spark.createDataFrame([(i,) for i in range(20)], "id long")
    r = RM.random_baseline(c.filter("id < 5"), c, "id", 4).collect()
    by_q = {}
    for x in r:
        by_q.setdefault(x.qid, []).append(x.cid)
    assert len(by_q) == 5
    for q, cs in by_q.items():
        assert len(set(cs)) == 4 and q not in cs


def test_retrieval_no_relevant_gives_zero(spark):
    q = spark.createDataFrame([(100, [1.0, 0.0]), (101, [0.0, 1.0])], "id long, v array<double>")
    b = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.6, 0.8])], "id long, v array<double>")
    pq = {r.qid: r for r in RT.per_query_metrics(q, b, "id", "v", "v", threshold=0.99, k_values=(1, 3)).collect()}
    assert pq[101].p_at_1 == 0 and pq[101].r_at_1 == 0 and pq[101].rr == 0
    assert pq[100].p_at_1 == 1 and pq[100].rr == 1.0


def test_mrr_rank_of_first_relevant(spark):
    q = spark.createDataFrame([(100, [1.0, 0.0])], "id long, v array<double>")
    b = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.8, 0.6]), (3, [0.6, 0.8])], "id long, rv array<double>")
    b = b.withColumn("v", F.when(F.col("id") == 3, F.array(F.lit(1.0), F.lit(0.0)))
                     .otherwise(F.array(F.lit(0.0), F.lit(1.0))))
    qq = q.withColumn("rv", F.col("v"))
    r = RT.per_query_metrics(qq, b, "id", "rv", "v", threshold=0.99, k_values=(1, 3)).first()
    assert r.n_relevant == 1 and abs(r.rr - 1 / 3) < 1e-12 and r.p_at_1 == 0 and abs(r.p_at_3 - 1 / 3) < 1e-12


def test_overlap_between_splits(spark):
    df = spark.createDataFrame([("x", "train"), ("x", "test"), ("y", "train"), ("z", "val")],
                               "text string, split string")
    o = {(r.split_a, r.split_b): (r.overlap, r.n_unique_a, r.pct) for r in R.overlap_between_splits(df).collect()}
    assert o[("train", "test")] == (1, 2, 50.0) and o[("val", "test")] == (0, 1, 0.0)



def test_positions_in_any_number_of_slices(spark):
    """Nothing in the plan or on the driver grows with the number of slices."""
    rows = [(i % 7 if i % 5 else None, (i * 7919) % 20011, i % 3) for i in range(20000)]
    df = spark.createDataFrame(rows, "g long, o long, v long").withColumn("pos", F.lit("x"))
    sizes = set()
    for n in (8, 400, 5000):
        got = position(df, ["o"], "p", start=0, slices=n)
        sizes.add(len(got._jdf.queryExecution().optimizedPlan().toString().splitlines()))
        ranked = {r.o: r.p for r in got.collect()}
        assert [ranked[o] for o in sorted(ranked)] == list(range(20000))
        if n == 8:
            sums = prefix_sums(df, ["o"], {"a": "v", "b": 1}, partition=["g"], slices=n, inclusive=False)
            want = {}
            run = {}
            for g, o, v in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
                want[g, o] = run.get(g, (0, 0))
                run[g] = (want[g, o][0] + v, want[g, o][1] + 1)
            assert {(r.g, r.o): (r.a, r.b) for r in sums.collect()} == want
    assert len(sizes) == 1


def test_box_stats_of_hot_null_and_empty_groups(spark):
    rows = [("hot", float((i * 7919) % 1009)) for i in range(3000)] + [("one", 4.0), (None, 1.0), (None, 2.0), ("two", None),
                                                                       ("gap", None), ("gap", 3.0), ("gap", 3.0), ("gap", 9.0)]
    df = spark.createDataFrame(rows, "g string, v double").withColumn("n", F.lit("clash")).repartition(4)
    got = {r.g: r for r in ST.box_stats(df, "v", "g").collect()}
    assert set(got) == {"hot", "one", None, "two", "gap"}
    for g in ("hot", "one", None, "gap"):
        values = [v for k, v in rows if k == g and v is not None]
        assert [got[g].q1, got[g].median, got[g].q3] == pytest.approx(list(np.quantile(values, [0.25, 0.5, 0.75])))
        assert (got[g].min, got[g].max, got[g].n) == (min(values), max(values), sum(k == g for k, _ in rows))
    assert got["two"].n == 1 and got["two"].median is None
    assert ST.box_stats(df.limit(0), "v", "g").count() == 0


def test_dictionary_join_splits_hot_tokens(spark):
    rows = [(i, ["the", f"w{i % 1500}", None, "the", f"x{i}"]) for i in range(3000)] + [(3000, []), (3001, None)]
    df = spark.createDataFrame(rows, "id long, tokens array<string>").withColumn("value", F.lit("clash")).repartition(4)
    entries = [("the", "THE"), ("x7", "seven")] + [(f"w{i}", f"W{i}") for i in range(0, 1500, 2)]
    dic = spark.createDataFrame(entries, "form string, value string")
    table = dict(entries)
    want = {i: [table.get(t, t) for t in ts or []] for i, ts in rows}
    for bounded in (True, False):
        assert {r.id: r.mapped for r in M.dictionary_join(df, "id", "tokens", dic, bounded=bounded).collect()} == want
    assert M.dictionary_join(df.limit(0), "id", "tokens", dic, bounded=False).count() == 0


def test_record_layout_by_row(spark):
    df = spark.createDataFrame([(["a"], "x"), (None, "2 your persona: I ski"), ([], "plain"), (None, None)],
                               "persona array<string>, text string")
    assert [tuple(r.l) for r in df.select(R.record_layout(df).alias("l")).collect()] == [
        ("structured", "persona"), ("text", "text"), ("unknown", None), ("unknown", None)]
