"""Running aggregates over ranges, and the operators that use them, with one group of half the rows."""

import random

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import joins, matrix, running, sets, splits, windows


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(8)
    return [(rnd.choice(["hot", "hot", "hot", None, "a", "b"]), k, rnd.choice([None, *range(30)])) for k in range(600)]


def _by_group(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return out


def test_numbered_and_accumulated(spark, rows):
    df = spark.createDataFrame(rows, "g string, id int, v int")
    got = {r.id: r.no for r in running.numbered(df, ["g"], [F.desc("id")], "no").collect()}
    want = {r[1]: k for group in _by_group(rows).values() for k, r in enumerate(sorted(group, key=lambda r: -r[1]), 1)}
    assert got == want
    laid = running.ranges(df, ["g"], [F.asc("id")], 7)
    assert laid.filter("g = 'hot'").select("__part").distinct().count() > 1  # the large group lies over several ranges
    forth = {r.id: r.s for r in running.accumulated(laid, ["g"], [F.asc("id")], "s", "sum", F.coalesce("v", F.lit(0))).collect()}
    back = {r.id: r.m for r in running.accumulated(laid, ["g"], [F.desc("id")], "m", "min", F.col("v"), backwards=True).collect()}
    for group in _by_group(rows).values():
        group.sort(key=lambda r: r[1])
        for k, r in enumerate(group):
            assert forth[r[1]] == sum(x[2] or 0 for x in group[: k + 1])
            assert back[r[1]] == min((x[2] for x in group[k:] if x[2] is not None), default=None)
    assert running.numbered(df.limit(0), ["g"], [F.desc("id")], "no").collect() == []


def test_average_ranks_with_nulls_and_ties(spark, rows):
    df = spark.createDataFrame(rows, "g string, id int, v int")
    got = {r.id: r.rank_no for r in matrix.average_ranks(df, ["g"], "v").collect()}
    for group in _by_group(rows).values():
        order = sorted(-1 if r[2] is None else r[2] for r in group)
        for r in group:
            v = -1 if r[2] is None else r[2]
            assert got[r[1]] == order.index(v) + (order.count(v) + 1) / 2


def test_scaled_and_sampled(spark, rows):
    import statistics as st

    df = spark.createDataFrame(rows, "g string, id int, v int")
    got = {r.id: r.z for r in windows.scaled(df, ["g"], "v").collect()}
    sample = {}
    for r in sets.sample_by_group(df, "g", ["id"], 0.1).collect():
        sample.setdefault(r.g, []).append(r.id)
    for g, group in _by_group(rows).items():
        v = [r[2] for r in group if r[2] is not None]
        for r in group:
            assert got[r[1]] is None if r[2] is None else abs(got[r[1]] - (r[2] - st.mean(v)) / st.stdev(v)) < 1e-9
        assert len(sample[g]) == -(-len(group) // 10)


def test_adjusted_p_in_families(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice(["x", "x", "y", None]), k, rnd.choice([None, 0.01, 0.02, rnd.random()])) for k in range(300)]
    df = spark.createDataFrame(rows, "g string, id int, p double")
    for by in (["g"], []):
        got = {r.id: r.q for r in windows.adjust_p(df, "p", by).collect()}
        families = _by_group(rows) if by else {0: rows}
        for group in families.values():
            tests = sorted((r for r in group if r[2] is not None), key=lambda r: r[2])
            for r in tests:
                q = min(x[2] * len(tests) / sum(y[2] <= x[2] for y in tests) for x in tests if x[2] >= r[2])
                assert abs(got[r[1]] - min(1.0, q)) < 1e-12
        assert len(got) == sum(r[2] is not None for r in rows)


def test_salted_join(spark):
    rnd = random.Random(5)
    left = [(rnd.choice(["hot", "hot", "hot", "a", "b", None]), k) for k in range(300)]
    right = [(k, n) for n, k in enumerate(["hot", "hot", "a", "c", None])]
    a, b = spark.createDataFrame(left, "k string, i int"), spark.createDataFrame(right, "k string, n int")
    want = sorted((k, i, n) for k, i in left for q, n in right if k == q and k is not None)
    for tasks in (1, 4, 50):
        assert sorted(map(tuple, joins.salted_join(a, b, ["k"], tasks).collect())) == want
    assert joins.salted_join(a.limit(0), b, ["k"]).collect() == []


def test_splits(spark):
    rows = [(k, "hot" if k % 2 else f"k{k % 7}" if k % 10 else None) for k in range(101)]
    df = spark.createDataFrame(rows, "id int, key string")
    sizes = [r["count"] for r in splits.chunks(df, ["id"], 30).groupBy("chunk_no").count().orderBy("chunk_no").collect()]
    assert sizes == [30, 30, 30, 11]
    half = splits.chunks(df, ["id"], 10, 0.5).collect()
    assert 30 < len(half) < 70 and [r.chunk_no for r in sorted(half)] == [k // 10 + 1 for k in range(len(half))]
    sizes = [r["count"] for r in splits.parts_of(df, ["id"], 4).groupBy("part_no").count().collect()]
    assert sorted(sizes) == [25, 25, 25, 26]
    got = splits.on_key_boundaries(df, "key", F.lit(1), 20).collect()
    assert len(got) == 101
    parts = {}
    for r in got:
        parts.setdefault(r.key, set()).add(r.part_no)
    assert all(len(p) == 1 for p in parts.values())  # a key is never cut
    assert parts[None] == {1} and [min(parts[k]) for k in sorted(k for k in parts if k)] == sorted(min(parts[k]) for k in parts if k)
    assert splits.chunks(df.limit(0), ["id"], 5).collect() == [] == splits.parts_of(df.limit(0), ["id"], 5).collect() == splits.on_key_boundaries(df.limit(0), "key", F.lit(1), 5).collect()
