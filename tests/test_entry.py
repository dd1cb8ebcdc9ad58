"""Driver contract, registry consistency and a few oracle comparisons."""
import duckdb

import __spark_entry__ as E
from conftest import SF0001

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["source", "toxic", "n"]


def test_registry_consistent():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 130
    own = set(E.llm_queries.QUERIES) | {"pipeline"} if E.llm_queries else set()
    for name in set(q) - own:
        assert "pipeline" not in name and not name.startswith("op")


def _duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return con


def _norm(rows):
    out = []
    for r in rows:
        out.append(tuple(round(v, 6) if isinstance(v, float) else (tuple(v) if isinstance(v, list) else v)
                         for v in r))
    return sorted(out, key=repr)


def test_oracles_match_on_sf0001(spark):
    con = _duck()
    q, o = E.queries(), E.oracle_sql()
    for name in ["label_by_source", "stratified_split", "roc_auc", "threshold_sweep", "persona_blocks",
                 "assign_row_id", "diverse_sample", "detect_language", "cosine_dense", "mrr"]:
        sdf = q[name](spark, SF0001)
        cols = sorted(sdf.columns)
        srows = _norm([tuple(r[c] for c in cols) for r in sdf.collect()])
        res = con.execute(o[name])
        dcols = [d[0] for d in res.description]
        drows = _norm([tuple(r[dcols.index(c)] for c in cols) for r in res.fetchall()])
        assert srows == drows, name


def test_streaming_clean(spark):
    df = E.queries()["stream_clean"](spark, SF0001)
    assert df.count() == spark.read.parquet(f"{SF0001}/documents.parquet").count()


def test_streams_read_a_table_in_part_files(spark, tmp_path):
    """A table may be a folder of part files: every row is streamed; one without rows gives none."""
    src = spark.read.parquet(f"{SF0001}/documents.parquet")
    src.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = E.queries()["stream_clean"](spark, str(tmp_path))
    want = E.queries()["stream_clean"](spark, SF0001)
    assert got.count() == src.count() and got.exceptAll(want).count() == 0
    src.limit(0).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert E.queries()["stream_clean"](spark, str(tmp_path / "none")).count() == 0
