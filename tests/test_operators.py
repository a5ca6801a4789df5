"""Operators against brute force on small data."""

import hashlib
import random
import statistics

import pytest
from pyspark.sql import functions as F

from reqlytics.functions.labels import DELAY, EFFECTIVE, INSUFFICIENT, PRIORITY, ROOT_CAUSE
from reqlytics.operators import canonical, joins, median, periods, quadrant, runs


def sample(seed=7, n=4000):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if r.random() < 0.4 else f"k{r.randrange(30)}"
        kind = r.randrange(6)
        value = [
            float(r.randrange(50)), r.uniform(-1000, 1000), r.gauss(0, 1e-3), r.uniform(0, 1e12), None, float("nan"),
        ][kind]
        rows.append((key, value))
    return rows + [("alone", 3.5), ("empty", None)]


@pytest.mark.parametrize("max_values", [0, median.MAX_VALUES])
def test_median_equals_brute_force(spark, max_values):
    rows = sample()
    frame = spark.createDataFrame(rows, "k string, v double")
    want = {}
    for k, v in rows:
        if v is not None and v == v:
            want.setdefault(k, []).append(v)
    got = {r["k"]: r["median"] for r in median.exact_median(frame, ["k"], "v", max_values=max_values).collect()}
    assert got == pytest.approx({k: statistics.median(v) for k, v in want.items()}, rel=1e-12, abs=1e-15)


@pytest.mark.parametrize("max_values", [0, median.MAX_VALUES])
def test_global_median(spark, max_values):
    values = [v for _, v in sample(3, 901) if v is not None and v == v]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    assert median.exact_median(frame, [], "v", max_values=max_values).first()[0] == pytest.approx(
        statistics.median(values), rel=1e-12
    )
    assert median.exact_median(frame.limit(0), [], "v", max_values=max_values).count() == 0


@pytest.mark.parametrize("max_values", [0, 3, 60, median.MAX_VALUES])
def test_median_of_rows_with_sums_and_null_keys(spark, max_values):
    """Few and many rows, values that repeat and that do not, a null key, a group without values."""
    rows = sample(5, 1200) + [(None, float(i % 7)) for i in range(400)] + [("same", 4.25)] * 300 + [("two", float(i % 2)) for i in range(99)]
    frame = spark.createDataFrame(rows, "k string, v double")
    got = median.aggregate_rows_with_median(
        frame, ["k"], "v", [F.count(F.lit(1)).alias("n")], [F.sum("n").alias("rows")], "m", max_values
    ).collect()
    groups = {}
    for k, v in rows:
        groups.setdefault(k, []).append(v)
    assert {r["k"]: r["rows"] for r in got} == {k: len(v) for k, v in groups.items()}
    usable = {k: [x for x in v if x is not None and x == x] for k, v in groups.items()}
    want = {k: statistics.median(v) if v else None for k, v in usable.items()}
    assert {r["k"]: r["m"] for r in got} == {k: v if v is None else pytest.approx(v, rel=1e-12, abs=1e-15) for k, v in want.items()}


def test_median_of_rows_writes_few_values(spark, monkeypatch):
    """Continuous values: what is written is a small part of the rows."""
    written = []
    for name in ("materialise", "materialise_counted"):
        def watch(df, label, real=getattr(median, name), pair=name.endswith("counted")):
            made = real(df, label)
            written.append((made[0] if pair else made).count())
            return made
        monkeypatch.setattr(median, name, watch)
    rows = spark.range(30_000).selectExpr("id % 3 AS k", "rand(7) * 1e6 + id / 1e9 AS v")
    got = {r.k: r.median for r in median.exact_median(rows, ["k"], "v", max_values=500).collect()}
    assert got == {r.k: r.m for r in rows.groupBy("k").agg(F.percentile("v", 0.5).alias("m")).collect()}
    assert sum(written) < 300


def test_coarse_buckets_do_not_change_the_result(spark):
    rows = sample(11, 1500)
    frame = spark.createDataFrame(rows, "k string, v double").groupBy("k", "v").agg(F.count("*").alias("n"))
    fine = median.select_by_rank(frame, ["k"], "v", "n", "m")
    coarse = median.select_by_rank(frame, ["k"], "v", "n", "m", per_octave=1)
    assert sorted(map(tuple, fine.collect())) == sorted(map(tuple, coarse.collect()))


@pytest.mark.parametrize("chunk", [4, 64, runs.CHUNK_ROWS])
def test_runs_equal_brute_force(spark, chunk):
    r = random.Random(5)
    rows, want = [], []
    for key in ("f1", "f2", "f3"):
        number, previous, run = 0, object(), 0
        for _ in range(300):
            number += r.choice([1, 1, 2, 9])
            label = r.choice("AAAAAAAB") if key != "f3" else "A"
            rows.append((key, number, label))
            if label != previous:
                run += 1
                want.append([key, run, label, number, number, 0])
            want[-1][4], want[-1][5] = number, want[-1][5] + 1
            previous = label
    frame = spark.createDataFrame(rows, "k string, n long, l string")
    got = runs.label_runs(frame, ["k"], "n", "l", chunk)
    assert sorted(tuple(x) for x in got.collect()) == sorted(tuple(w) for w in want)


@pytest.mark.parametrize("how", ["left", "inner", "left_anti"])
def test_salted_join_equals_broadcast_join(spark, how):
    big = spark.range(2000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 != 0, F.concat(F.lit("k"), F.col("id") % 40)).alias("k")
    )
    lookup = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), ("unused", 4)], "k string, v int")
    spread = F.col("id")
    one = joins.lookup_join(big, lookup, "k", how, spread, small=True)
    two = joins.lookup_join(big, lookup, "k", how, spread, small=False, hot_rows=100)
    assert one.columns == two.columns
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))


def test_only_hot_keys_are_copied(spark):
    big = spark.range(1000).selectExpr("id", "if(id % 2 = 0, 0, id) AS k")
    lookup = spark.range(1000).selectExpr("id AS k", "id * 2 AS v")
    joined = joins.lookup_join(big, lookup, "k", "inner", F.col("id"), small=False, hot_rows=100)
    assert joined.count() == 1000 and joined.where("v <> k * 2").count() == 0
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan and "_hot" in plan


def test_broadcast_needs_a_measured_size(spark):
    frame = spark.range(100).selectExpr("id", "repeat('x', 100) AS t")
    assert joins.fits_broadcast(frame)
    assert joins.fit_broadcast([frame, frame.limit(3)], max_rows=50) == [False, True]
    assert not joins.fits_broadcast(frame, max_bytes=500)


def test_quadrant(spark):
    cases = [
        ((True, 5.0, 5.0, 0.2, 0.2), EFFECTIVE),
        ((True, 5.0, 5.0, 0.3, 0.2), ROOT_CAUSE),
        ((True, 6.0, 5.0, 0.2, 0.2), DELAY),
        ((True, 6.0, 5.0, 0.3, 0.2), PRIORITY),
        ((False, 5.0, 5.0, 0.2, 0.2), INSUFFICIENT),
        ((True, None, 5.0, 0.2, 0.2), INSUFFICIENT),
        ((True, 5.0, None, 0.2, 0.2), PRIORITY),
        ((True, 5.0, 5.0, 0.2, None), PRIORITY),
    ]
    frame = spark.createDataFrame(
        [(i, *c) for i, (c, _) in enumerate(cases)], "i int, e boolean, s double, sl double, r double, rl double"
    )
    group = quadrant.quadrant(F.col("e"), F.col("s"), F.col("sl"), F.col("r"), F.col("rl"))
    assert [r[0] for r in frame.orderBy("i").select(group).collect()] == [w for _, w in cases]


def test_verdicts(spark):
    frame = spark.createDataFrame([("a", 5.0), ("b", 4.0), ("c", 4.0), ("d", 9.0)], "p string, v double")
    seen = periods.with_previous(frame, "p", ["v"]).select(
        "p", "prev_p", periods.judge(F.col("v") - F.col("prev_v")).alias("j"),
        periods.judge(F.col("v") - F.col("prev_v"), lower_is_better=False).alias("up"),
    )
    assert [tuple(r) for r in seen.orderBy("p").collect()] == [
        ("a", None, None, None), ("b", "a", "good", "bad"), ("c", "b", None, None), ("d", "c", "bad", "good"),
    ]


def test_variants_and_truncated_names(spark):
    issues = ["tank - a", "tank a", "tank a", "(other)", None]
    frame = spark.createDataFrame([(v,) for v in issues], "t string")
    got = {r["spelling"]: (r["canonical"], r["n_spellings"]) for r in canonical.spelling_variants(frame, "t").collect()}
    assert got == {"tank - a": ("tank a", 2), "tank a": ("tank a", 2), "(other)": ("(other)", 1)}
    groups = {r["documents"]: r for r in canonical.text_groups(frame, "t").collect()}
    assert set(groups) == {3, 1} and groups[3]["spellings"] == 2
    assert groups[3]["canonical_digest"] == hashlib.md5(b"tank a").hexdigest()
    names = spark.createDataFrame([(v,) for v in ["king", "king a", "king b", "queen", "queen c", "kingdom d"]], "t string")
    assert [tuple(r) for r in canonical.truncated_names(names, "t").collect()] == [("king", 2)]


def test_rank_selection_orders_few_values(spark):
    """Narrow, far and extreme ranges: buckets are refined until few values are left, and the result is exact."""
    values = {
        "far": [1e9 + i / 1e4 for i in range(3000)],
        "tiny": [i * 1e-12 for i in range(2001)],
        "wide": [-1.7e308, 1.7e308],
        "steep": [2.0**i for i in range(-500, 500)],
        "same": [5.0],
        "gap": [1.0, 2.0, 1e6, 1e6 + 1],
    }
    rows = [(k, v, 1) for k, vs in values.items() for v in vs]
    frame = spark.createDataFrame(rows, "k string, v double, n long")
    for most in (2, 100, 20_000):
        got = {r["k"]: r["m"] for r in median.select_by_rank(frame, ["k"], "v", "n", "m", most=most).collect()}
        for k, vs in values.items():
            vs = sorted(vs)
            low, high = vs[(len(vs) - 1) // 2], vs[len(vs) // 2]
            assert got[k] == (low if low == high else 0.5 * low + 0.5 * high), (k, most)
