"""Every registered query against its SQL in DuckDB on the smallest tables, and checks of their plans."""

import re

import pytest

from suite import ORDERED
from suite.base import ORACLES, QUERIES
from suite.compare import difference, oracle

SF = "/root/testdata/sf0.001"
# Queries that write and read back; their plan starts at a written table.
EAGER = ("a0", "b03_state", "b06", "c99")


@pytest.fixture(scope="module")
def con():
    return oracle(SF)


@pytest.mark.parametrize("name", ORDERED())
def test_matches_sql(spark, con, name):
    assert name in ORACLES
    assert difference(spark, con, name, SF) is None


@pytest.mark.parametrize("name", [n for n in ORDERED() if not n.startswith(EAGER)])
def test_plan(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    if name not in ("c02_html_to_text", "c11_tag_terms", "c11_tag_terms_long"):
        assert not re.search(r"EvalPython|InPandas|InArrow|BatchEvalPython", plan), "Python in the plan"
    # No window over everything: each names its partition keys, so none gathers in a single partition.
    for line in plan.splitlines():
        if re.search(r"\bWindow \[", line):
            assert re.search(r"windowspecdefinition\(\w+#", line) and not line.rstrip().endswith("[]"), line
    # A ranking with a limit cuts rows on every task before the shuffle.
    if "WindowGroupLimit" in plan:
        assert ", Partial" in plan


def test_contract_file():
    import __spark_entry__ as entry
    assert set(ORDERED()) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_every_operator_is_registered():
    """One query or more per operator of the inventory."""
    have = {n.split("_")[0] for n in ORDERED()}
    wanted = {f"{g}{i:02d}" for g, n in (("a", 9), ("b", 6), ("c", 16), ("d", 5), ("e", 9), ("f", 36)) for i in range(1, n + 1)}
    assert wanted <= have
