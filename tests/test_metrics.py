"""Measures against brute force; one group holds a third of the rows."""

import random

import pytest
from pyspark.sql import functions as F

from vacancy_lake.functions.rules import PlaceRules
from vacancy_lake.operators import metrics as M
from vacancy_lake.plans import views as V

DIMS = 400


@pytest.fixture(scope="module")
def fact(spark):
    r = random.Random(7)
    data = [(g, f"d{i:04d}", r.choice([1, 1, 1, 2, 3, 50])) for g in ("a", "hot", "c") for i in range(DIMS if g == "hot" else 30)]
    return data, spark.createDataFrame(data, "g string, dim string, job_count long").repartition(6).cache()


def _by_group(data):
    out = {}
    for g, d, n in data:
        out.setdefault(g, []).append((d, n))
    return {g: sorted(v, key=lambda x: (-x[1], x[0])) for g, v in out.items()}


@pytest.mark.parametrize("bounded", [True, False])
def test_pareto(fact, bounded):
    data, df = fact
    got = {(r["g"], r["dim"]): r for r in M.pareto(df, ["g"], "dim", bounded=bounded).collect()}
    for g, ranked in _by_group(data).items():
        total, run = sum(n for _, n in ranked), 0
        for i, (d, n) in enumerate(ranked, 1):
            run += n
            r = got[(g, d)]
            assert r["pareto_rank"] == i
            assert r["share_of_total"] == pytest.approx(n / total)
            assert r["cumulative_job_pct"] == pytest.approx(100 * run / total)
        assert run == total and len(ranked) == sum(k[0] == g for k in got)


def test_pareto_spreads_one_group(spark):
    """The whole table is one group: its running sum is taken per slice."""
    df = spark.range(5000).select(F.lit("x").alias("g"), F.col("id").cast("string").alias("dim"), F.lit(1).cast("long").alias("job_count"))
    out = M.running_total(df, ["g"], [F.desc("job_count"), F.asc("dim")], "job_count")
    rows = out.orderBy("rank").collect()
    assert [r["rank"] for r in rows] == list(range(1, 5001)) == [r["running"] for r in rows]
    assert [r["dim"] for r in rows] == sorted(str(i) for i in range(5000))
    assert "_slice" in out._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("n", [1, 5, 1000])
def test_top_n_other_keeps_mass(fact, n):
    data, df = fact
    got = {}
    for r in M.top_n_other(df, ["g"], "dim", n).collect():
        got.setdefault(r["g"], {})[r["label"]] = r["job_count"]
    for g, ranked in _by_group(data).items():
        expected = dict(ranked[:n])
        rest = sum(c for _, c in ranked[n:])
        assert got[g] == ({**expected, "Other": rest} if rest else expected)


def test_hhi_and_topk(fact):
    data, df = fact
    hhi = {r["g"]: r["hhi"] for r in M.hhi(df, ["g"]).collect()}
    top = {r["g"]: r["topk_share"] for r in M.topk_share(df, ["g"], "dim", 3).collect()}
    for g, ranked in _by_group(data).items():
        total = sum(n for _, n in ranked)
        assert hhi[g] == pytest.approx(sum((n / total) ** 2 for _, n in ranked))
        assert 1 / len(ranked) - 1e-9 <= hhi[g] <= 1
        assert top[g] == pytest.approx(sum(n for _, n in ranked[:3]) / total)


def test_shares_sum_to_one_and_empty_universe_is_null(spark, fact):
    _, df = fact
    sums = M.with_share(df, ["g"]).groupBy("g").agg(F.sum("share").alias("s")).collect()
    assert all(r["s"] == pytest.approx(1) for r in sums)
    zero = spark.createDataFrame([("z", "d", 0)], "g string, dim string, job_count long")
    assert M.with_share(zero, ["g"]).first()["share"] is None
    assert M.hhi(zero, ["g"]).first()["hhi"] is None


def test_flow_edges_with_hot_pair(spark):
    r = random.Random(3)
    data = [("m", "hot", "big", "v1")] * 500 + [("m", f"s{r.randrange(30)}", f"t{r.randrange(30)}", f"v{r.randrange(3)}") for _ in range(700)]
    df = spark.createDataFrame(data, "m string, s string, t string, v string").repartition(5)
    got = {(x["source_bucket"], x["target_bucket"]): (x["edge_weight"], x["latest_v"])
           for x in M.flow_edges(df, ["m"], "s", "t", 4, 3, version="v").collect()}

    def best(i, k):
        mass = {}
        for row in data:
            mass[row[i]] = mass.get(row[i], 0) + 1
        return {v for v, _ in sorted(mass.items(), key=lambda x: (-x[1], x[0]))[:k]}
    left, right, expected = best(1, 4), best(2, 3), {}
    for _, s, t, v in data:
        key = (s if s in left else "Other", t if t in right else "Other")
        n, latest = expected.get(key, (0, ""))
        expected[key] = (n + 1, max(latest, v))
    assert got == expected


GEO = [
    ("", "unmapped"), (None, "unmapped"), ("India", "unmapped_country"), ("Kerala", "kerala"), ("Bengaluru", "karnataka"),
    ("anantapur", "andhra pradesh"), ("Chandigarh", "chandigarh"), ("Nowhere", "unmapped_single"), ("Delhi, India", "delhi"),
    ("New Delhi, India", "delhi"), ("Dehradun, IN", "uttarakhand"), ("Anantapur, India", "unmapped_state_india"),
    ("Nowhere, India", "unmapped_state_india"), ("Noida, Ghaziabad", "uttar pradesh"), ("Kochi, Ernakulam District", "kerala"),
    ("Durgapur, Paschim Bardhaman", "west bengal"), ("Pune,  Maharashtra, India", "maharashtra"), ("A, B", "unmapped_pair"),
    ("Port Blair, Andaman and Nicobar Islands", "andaman and nicobar islands"),
]


def test_geo_states(spark):
    df = spark.createDataFrame(list(enumerate(p for p, _ in GEO)), "i int, location_raw string")
    got = [r["state_name"] for r in V.geo_states(df, PlaceRules()).orderBy("i").collect()]
    assert got == [e for _, e in GEO]


def test_chart_labels_are_numbered(spark):
    df = spark.createDataFrame([("s", "2024-01", "r", n, c) for n, c in (("acme gmbh", 9), ("acme ag", 8), ("zeta", 7))],
                               "source string, posted_month string, run_id string, company_name string, job_count long")
    got = [(r["label"], r["chart_label"], r["original"]) for r in V.ranked_display(df, "company_name", "company").orderBy("rank").collect()]
    assert got == [("Acme", "Acme", "acme gmbh"), ("Acme", "Acme (2)", "acme ag"), ("Zeta", "Zeta", None)]


def test_grain_summary(spark):
    df = spark.createDataFrame([("s", "2024-01", "r", str(i), i) for i in range(1, 102)],
                               "source string, posted_month string, run_id string, skill string, job_count long")
    assert V.grain_summary(df).first()["quartiles"] == [1, 26, 51, 76, 101]


def test_funnel_is_monotone(spark):
    base = spark.createDataFrame([("s", "2024-01", "r1", loc, sk, mode) for loc in ("", "india", "goa") for sk in ([], ["x"], None)
                                  for mode in ("unknown", "remote")],
                                 "source string, posted_month string, bronze_run_id string, location_raw string, skills array<string>, remote_type string")
    got = [r["job_count"] for r in V.coverage_funnel(base).orderBy("stage_order").collect()]
    assert got == [18, 6, 2, 1]


def test_profile_json_kinds(spark):
    from vacancy_lake.operators.audit import profile_json
    df = spark.createDataFrame([('{"a": 1, "b": "x", "c": null, "d": {"e": 1}}',), ('{"a": 1.5, "b": " ", "d": [1]}',), ("bad",), (None,)], "j string")
    got = {r["key"]: (r["present"], r["null"], r["empty_str"], r["kinds"]) for r in profile_json(df, "j").collect()}
    assert got == {"a": (2, 0, 0, ["float", "int"]), "b": (1, 0, 1, ["str"]), "c": (0, 1, 0, ["null"]), "d": (2, 0, 0, ["array", "object"]),
                   "(unparsed)": (1, 0, 0, ["unparsed"])}
