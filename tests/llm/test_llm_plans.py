"""Plan shape of the operators: no cartesian products or nested-loop joins, and no Python in the native ones."""
from concurrent.futures import ThreadPoolExecutor

from conftest import SF0001
from loomtext.llm import queries

NATIVE = {"op1_fingerprint", "op2_line_spread", "op3_license_scan", "op4_chat_rotation"}
PY_NODES = ("ArrowEvalPython", "BatchEvalPython", "InPandas", "MapInArrow")


def test_plans(spark):
    names = sorted(queries.QUERIES)
    with ThreadPoolExecutor(8) as pool:  # many queries run jobs while they are built
        found = pool.map(lambda n: queries.QUERIES[n](spark, SF0001)._jdf.queryExecution().executedPlan().toString(), names)
        plans = dict(zip(names, found))
    assert not [n for n, p in plans.items() if "CartesianProduct" in p or "BroadcastNestedLoopJoin" in p]
    assert not [n for n in NATIVE if any(x in plans[n] for x in PY_NODES)]
