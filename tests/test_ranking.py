"""Ranks and medians of groups of any size against plain Python."""

import random
import statistics

import pytest

from strataloom.operators import ranking as R

SCHEMA = "g string, h int, i int, value double"


def table(spark, seed, n, values, groups=("a", "b", None)):
    rng = random.Random(seed)
    rows = [(rng.choice(groups), rng.choice([0, 1]), i, rng.choice(values)) for i in range(n)]
    return rows, spark.createDataFrame(rows, SCHEMA)


def brute_ranks(rows):
    groups = {}
    for g, h, _, v in rows:
        if v is not None:
            groups.setdefault((g, h), []).append(v)
    key = lambda v: (v != v, v)
    out = {}
    for g, h, i, v in rows:
        of = groups.get((g, h), [])
        below = sum(key(x) < key(v) for x in of) if v is not None else 0
        same = sum(x == v or (x != x and v != v) for x in of) if v is not None else 0
        out[i] = (None, None) if v is None else (below + (same + 1) / 2, len(of))
    return out


@pytest.mark.parametrize("values", [[1.0, 2.0, 2.5, None], [None], [float(x) for x in range(900)], [0.0, -0.0, float("nan"), float("inf"), -1.5]])
def test_average_rank_equals_brute_force(spark, values):
    rows, df = table(spark, 1, 600, values)
    got = {r["i"]: (r["rank"], r["k"]) for r in R.average_rank(df, ["g", "h"], name="rank", size="k").collect()}
    assert got == brute_ranks(rows)


def test_ranks_of_an_empty_table_and_clashing_names(spark):
    assert R.average_rank(spark.createDataFrame([], SCHEMA), ["g"]).collect() == []
    df = spark.createDataFrame([("a", 1, 2.0, 7), ("a", 1, 1.0, 8)], "g string, _part int, value double, n int")
    assert {(r["n"], r["average_rank"]) for r in R.average_rank(df.withColumnRenamed("_part", "part"), ["g", "part"]).collect()} == {(7, 2.0), (8, 1.0)}


def test_a_large_group_takes_many_partitions(spark):
    """Nine tenths of the rows are of one group: no partition holds more than half of its values."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        rows = [("big" if i % 10 else f"small{i % 3}", 0, i, float((i * 7919) % 20011)) for i in range(20000)]
        df = spark.createDataFrame(rows, SCHEMA)
        dealt = R.dealt_values(df, ["g", "h"])
        parts = [r["count"] for r in dealt.where("g = 'big'").groupBy("_part").count().collect()]
        assert len(parts) >= 5 and max(parts) < 18000 / 2
        own = sorted(v for g, _, _, v in rows if g == "big")
        got = {r["value"]: r["_before"] for r in R.places(dealt, ["g", "h"]).where("g = 'big'").collect()}
        assert got == {v: k for k, v in enumerate(own)}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("accuracy", [40_000, 100, 40])
@pytest.mark.parametrize("values", [[1.0, 2.0, 2.5, None], [float(x * x) for x in range(1500)], [5.0]])
def test_medians_equal_brute_force_below_and_above_the_sketch(spark, monkeypatch, accuracy, values):
    monkeypatch.setattr(R, "ACCURACY", accuracy)
    rows, df = table(spark, 2, 1400, values)
    rows += [("one", 1, -1, 3.25), ("none", 1, -2, None)]
    df = df.unionByName(spark.createDataFrame(rows[-2:], SCHEMA))
    groups = {}
    for g, h, _, v in rows:
        if v is not None:
            groups.setdefault((g, h), []).append(v)
    got = {(r["g"], r["h"]): (r["n"], r["median"]) for r in R.medians(df, ["g", "h"]).collect()}
    assert got == {k: (len(v), pytest.approx(statistics.median(v))) for k, v in groups.items()}


@pytest.mark.parametrize("accuracy", [10_000, 40_000])
def test_groups_around_the_size_that_a_sketch_holds(spark, monkeypatch, accuracy):
    """From many partitions, so that sketches are merged many times."""
    monkeypatch.setattr(R, "ACCURACY", accuracy)
    rng, sizes = random.Random(5), (4_998, 4_999, 5_000, 5_001, 9_999, 19_999, 20_001)
    rows = [(str(n), 0, i, rng.random() * 1e6) for n in sizes for i in range(n)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(13)
    got = {r["g"]: r["median"] for r in R.medians(df, ["g"]).collect()}
    assert got == {str(n): pytest.approx(statistics.median([v for g, _, _, v in rows if g == str(n)]), abs=1e-9) for n in sizes}


@pytest.mark.parametrize("q", [0.0, 0.01, 0.25, 0.5, 0.99, 1.0])
@pytest.mark.parametrize("accuracy", [40_000, 60])
def test_quantiles_equal_interpolation(spark, monkeypatch, accuracy, q):
    monkeypatch.setattr(R, "ACCURACY", accuracy)
    rows, df = table(spark, 8, 700, [None, 3.0, *[x / 7 for x in range(500)]])
    groups = {}
    for g, _, _, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    want = {}
    for g, v in groups.items():
        at = q * (len(v) - 1)
        s, k = sorted(v), int(at)
        want[g] = pytest.approx(s[k] + (s[min(k + 1, len(v) - 1)] - s[k]) * (at - k))
    assert {r["g"]: r["quantile"] for r in R.quantile(df, ["g"], q).collect()} == want


def test_a_bracket_beside_its_place_is_opened(spark):
    rows = [("a", 0, i, float(i)) for i in range(101)] + [("b", 0, i, float(i)) for i in range(11)]
    df = spark.createDataFrame(rows, SCHEMA)
    brackets = spark.createDataFrame([("a", 0, 50.0, 70.0, 80.0), ("a", 1, 25.5, 20.0, 30.0), ("b", 0, 5.0, 90.0, 99.0)], "g string, i int, at double, lo double, hi double")
    assert {(r["g"], r["i"], r["x"]) for r in R.selected(df, brackets, ["g"]).collect()} == {("a", 0, 50.0), ("a", 1, 25.5), ("b", 0, 5.0)}
