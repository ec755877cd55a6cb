"""Operators of the general data problems, on small fixtures against brute force."""

import json
import random
from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyloom.functions import labels, text
from tallyloom.operators import heavy_keys, shred, wide
from tallyloom.operators.latest import latest_by

T = [datetime(2023, 1, d) for d in range(1, 9)]


# ---------------------------------------------------------------- keys


@pytest.mark.parametrize(
    ("raw", "key"),
    [("1-2-3", "1-2-3"), (" 01-002-3\t", "1-2-3"), ("1", "1-1-1"), ("96", "1-1-96"), ("97", "1-2-1"), ("884736", "96-96-96"), ("0-5-7", "0-5-7"), ("x", None), ("", None), (None, None), (" ", None), ("0", None), ("1-2", None), (" 5 ", "1-1-5"), ("9" * 30, None)],
)
def test_cell_label_key(spark, raw, key):
    df = spark.createDataFrame([(raw,)], "s string")
    assert df.select(labels.cell_label_key(F.col("s"))).first()[0] == key


@pytest.mark.parametrize(("raw", "key"), [("aim2|NM_1|end", "AIM2"), (" Cd3 |x", "CD3"), ("*", None), ("", None), (None, None), ("|x", None), ("　a\xa0", "A"), ("*|x", None)])
def test_gene_key(spark, raw, key):
    df = spark.createDataFrame([(raw,)], "s string")
    assert df.select(labels.gene_key(F.col("s"))).first()[0] == key


@pytest.mark.parametrize(("raw", "key"), [(" SAMPLETAG1_HS ", "SampleTag01_hs"), ("SampleTag12_mm|stAbO", "SampleTag12_mm"), ("SampleTag123_hs", None), ("Multiplet", None), (None, None), ("", None), ("xSampleTag01_hs", None), ("SampleTag01_", None)])
def test_sample_tag_key(spark, raw, key):
    df = spark.createDataFrame([(raw,)], "s string")
    assert df.select(labels.sample_tag_key(F.col("s"))).first()[0] == key


def test_label_index_round_trip(spark):
    df = spark.range(1, 884737, 97).select(F.col("id"), labels.label_to_index(labels.index_to_label(F.col("id"))).alias("back"))
    assert df.filter("id != back OR back IS NULL").count() == 0


def test_white_space_is_what_python_calls_space():
    assert set(text.WHITE_SPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


# ---------------------------------------------------------------- newest version


def test_latest_by(spark):
    rows = [(1, T[0], "old"), (1, T[2], "new"), (1, None, "undated"), (2, None, "only"), (None, T[1], "no key"), (3, T[1], "b"), (3, T[1], "a"), (3, T[1], "b"), (4, T[1], None)]
    df = spark.createDataFrame(rows, "k int, stamp timestamp, v string")
    got = latest_by(df, {"k": F.col("k")}, F.col("stamp"), {"v": F.col("v")})
    assert sorted(map(tuple, got.collect())) == [(1, "new"), (2, "only"), (3, "b"), (4, None)]
    assert latest_by(df.limit(0), {"k": F.col("k")}, F.col("stamp"), {"v": F.col("v")}).collect() == []


def test_latest_by_with_clashing_names(spark):
    df = spark.createDataFrame([(1, T[0], "x", 5, 6)], "k int, stamp timestamp, v string, __stamp int, __last int")
    assert latest_by(df, {"k": F.col("k")}, F.col("stamp"), {"v": F.col("v")}).collect()[0][1] == "x"


# ---------------------------------------------------------------- 1: heavy keys


def test_heavy_keys(spark):
    rows = [("a", "g")] * 49 + [("b", None)] + [(f"c{i}", "h") for i in range(49)] + [(None, "h")]
    df = spark.createDataFrame(rows, "cell string, gene string")
    counts = heavy_keys.count_by_each_key(df, {"cell": F.col("cell"), "gene": F.col("gene")}, {"n_chars": F.length("gene")})
    assert counts.filter("key_value IS NULL").count() == 2
    got = {(r.key_kind, r.key_value): (r.n_records, r.is_heavy) for r in heavy_keys.mark_heavy(counts, 0.02).collect()}
    assert got[("cell", "a")] == (49, True)
    assert got[("cell", "b")] == (1, False)
    assert got[("gene", "h")] == (50, True)
    assert len(got) == 53


def test_heavy_share_is_exact_and_empty_input(spark):
    df = spark.createDataFrame([("a",), *[("b",)] * 49], "k string")
    marked = heavy_keys.mark_heavy(heavy_keys.count_by_each_key(df, {"k": F.col("k")}), 0.02)
    assert {r.key_value for r in marked.filter("is_heavy").collect()} == {"a", "b"}
    assert heavy_keys.mark_heavy(heavy_keys.count_by_each_key(df.limit(0), {"k": F.col("k")}), 0.02).count() == 0


# ---------------------------------------------------------------- 3: shredding

_JSON = st.recursive(st.none() | st.booleans() | st.integers(-9, 9) | st.text(max_size=3), lambda c: st.lists(c, max_size=3) | st.dictionaries(st.sampled_from("abc"), c, max_size=3), max_leaves=12)


@settings(max_examples=400, deadline=None)
@given(st.lists(_JSON, max_size=5))
def test_round_trip(records):
    assert shred.rebuild(shred.shred(records), len(records)) == records


@pytest.mark.parametrize("x", [{"Hits": None}, {"Hits": []}, {"Hits": {}}, {"Hits": [None]}, {"Hits": [[]]}, {"[]": 1, "\\[]": [2]}, {}, [], None, 1, [1, {"a": 2}, [3], "a"]])
def test_round_trip_of_what_is_empty(x):
    others = [{"Hits": [{"gene": "A"}]}, {"Hits": {"gene": []}}, {"Hits": 5}, {"Hits": None}]
    assert shred.rebuild(shred.shred([x, *others, x]), 6) == [x, *others, x]
    assert shred.rebuild(shred.shred([x]), 1) == [x]


@settings(max_examples=200, deadline=None)
@given(st.lists(_JSON, max_size=5))
def test_every_shape_is_shredded(records):
    columns = shred.shred(records)
    for c in columns.values():
        assert c.rep.count(0) == len(records)
        assert max(c.defined, default=0) <= c.max_def


def _hits_by_hand(payload):
    """Plain recursion, as TESTDATA states the cases."""
    try:
        x = json.loads(payload)
    except (TypeError, ValueError):
        return []
    r = x if isinstance(x, dict) and "Hits" in x else next((v for v in x.values() if isinstance(v, dict) and "Hits" in v), {}) if isinstance(x, dict) else {}
    h = r.get("Hits")
    if isinstance(h, str):
        try:
            h = json.loads(h)
        except ValueError:
            return []
    found = []

    def walk(v):
        if isinstance(v, dict):
            if "gene" in v:
                found.append(v)
            else:
                for w in v.values():
                    walk(w)
        elif isinstance(v, list):
            for w in v:
                walk(w)

    walk(h)
    out = []
    for i, v in enumerate(found, 1):
        s = v.get("bit_score")
        try:
            ok = not isinstance(s, bool) and isinstance(s, (int, float, str)) and float(s) == float(s)
        except ValueError:
            ok = False
        if isinstance(v["gene"], str) and v["gene"].strip() and ok:
            out.append((i, v["gene"].strip()))
    return out


def test_hits_of_the_test_table(spark):
    from tallyloom.plans.problems import p3_found
    from tallyloom.plans.tables import read

    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        rows = {r.record_id: r.payload for r in read(spark, sf, "pyir_records").collect()}
        want = sorted((k, *h) for k, p in rows.items() for h in _hits_by_hand(p))
        assert sorted(map(tuple, p3_found(spark, sf).collect())) == want
        assert want


def test_hit_table_cases(spark):
    rows = [
        (1, '{"Hits": [{"gene": "A", "bit_score": 1}, {"gene": " B ", "bit_score": " 2.5 "}, {"bit_score": 3}, {"gene": null, "bit_score": 1}]}', 7),
        (1, '{"Hits": [{"gene": "A", "bit_score": 1}, {"gene": " B ", "bit_score": " 2.5 "}, {"bit_score": 3}, {"gene": null, "bit_score": 1}]}', 7),
        (2, '{"Hits": [{"gene": "A", "bit', 7),
        (3, None, 7),
        (4, "", 7),
        (5, "[1, 2]", 7),
        (6, '{"x": {"y": {"Sequence ID": "s", "Hits": "[[{\\"gene\\": \\"D\\", \\"bit_score\\": true, \\"inner\\": {\\"gene\\": \\"no\\"}}]]"}}}', 7),
        (None, '{"Hits": [{"gene": "Z", "bit_score": 1}]}', 7),
        (7, '{"Hits": {"V": [], "J": {"gene": "E", "bit_score": "1e2"}, "D": null}, "Rejected": [{"gene": "R", "bit_score": 1}]}', 7),
        (8, '{"Hits": [{"gene": "\\ud800x", "bit_score": 1, "alignment_start": 1e300}]}', 7),
        (9, '{"a":' * 3000 + "1" + "}" * 3000, 7),
    ]
    df = spark.createDataFrame(rows, "record_id long, payload string, gene int")
    got = {(r.record_id, r.hit_no): (r.gene, r.bit_score, r.sequence_id) for r in shred.hit_table(df, stamp_col=None).collect()}
    assert got == {
        (1, 1): ("A", 1.0, None),
        (1, 2): ("B", 2.5, None),
        (1, 3): (None, 1.0, None),
        (6, 1): ("D", None, "s"),
        (7, 1): ("E", 100.0, None),
        (8, 1): ("�x", 1.0, None),
    }
    assert shred.hit_table(df.limit(0), stamp_col=None).collect() == []
    assert shred.record_table(df, stamp_col=None).filter("is_complete").count() == 4


def test_segments_link_to_hits(spark):
    p = json.dumps({"Hits": [{"gene": "A", "segments": [{"region": "F", "span": {"from": 1, "to": "2"}}, {"region": "G"}]}, {"gene": "B"}, {"gene": "C", "segments": []}, {"gene": "D", "segments": [{"matches": 5}]}]})
    df = spark.createDataFrame([(1, p)], "record_id long, payload string")
    got = sorted(map(tuple, shred.segment_table(df, stamp_col=None).collect()))
    assert got == [(1, 1, 1, "F", 1, 2, None), (1, 1, 2, "G", None, None, None), (1, 4, 1, None, None, None, 5)]


def test_a_cut_off_copy_never_wins(spark):
    full = '{"Hits": [{"gene": "A", "bit_score": 1}]}'
    df = spark.createDataFrame([(1, full, T[0]), (1, full[:20], T[3])], "record_id long, payload string, loaded_at timestamp")
    assert shred.hit_table(df).count() == 1


# ---------------------------------------------------------------- 4: wide tables


def _widen(df, **kw):
    rows = wide.narrow_rows(df, F.col("cell"), F.col("tag"), F.col("at"), {"reads": F.col("reads"), "mols": F.col("mols")})
    return wide.widen(rows, {"reads": "int", "mols": "int"}, entity="cell", **kw)


@pytest.mark.parametrize("plan_tables", [2, 3, 100])
def test_wide_against_brute_force(spark, plan_tables):
    rnd = random.Random(5)
    rows = [(rnd.choice([None, *range(12)]), rnd.choice([None, *"abcdefg"]), rnd.choice([None, 1, 2, 3]), rnd.choice([None, 5]), rnd.choice(T)) for _ in range(400)]
    df = spark.createDataFrame(rows, "cell int, tag string, reads int, mols int, at timestamp")
    best = {}
    for c, t, r, m, at in rows:
        if c is not None and t is not None:
            key = (at, r if r is not None else -1, m if m is not None else -1)
            if (c, t) not in best or key > best[c, t][0]:
                best[c, t] = (key, r, m)
    w = _widen(df, plan_tables=plan_tables)
    assert w.columns == ["cell", *[f"{t}_{v}" for t in "abcdefg" for v in ("reads", "mols")]]
    got = {(r["cell"], t): (r[f"{t}_reads"], r[f"{t}_mols"]) for r in w.collect() for t in "abcdefg"}
    assert got == {(c, t): best[c, t][1:] if (c, t) in best else (None, None) for c in {c for c, _ in best} for t in "abcdefg"}
    full = {tuple(r) for r in wide.filled(w, "cell", list("abcdefg"), ["reads", "mols"]).collect()}
    assert full == {k for k, v in best.items() if v[1] is not None and v[2] is not None}


def test_wide_edges(spark):
    schema = "cell int, tag string, reads string, mols long, at timestamp, attribute int, entity int"
    df = spark.createDataFrame([(1, "a b/=%", "12", 1 << 40, None, 0, 0), (2, "a b/=%", "x", 1, T[0], 0, 0)], schema)
    got = {r["cell"]: (r["a b/=%_reads"], r["a b/=%_mols"]) for r in _widen(df).collect()}
    assert got == {1: (12, None), 2: (None, 1)}
    assert _widen(df.limit(0)).columns == ["cell"]
    more = df.union(df.withColumn("tag", F.lit("b"))).union(df.withColumn("tag", F.lit("c.`d")))
    assert {r["cell"]: r["a b/=%_reads"] for r in _widen(more, plan_tables=2).collect()} == {1: 12, 2: None}
    two = df.union(df.withColumn("tag", F.lit("b")))
    with pytest.raises(ValueError, match="more than 1 attributes"):
        _widen(two, limit=1)
    rows = wide.narrow_rows(two, F.col("cell"), F.col("tag"), F.col("at"), {"reads": F.col("reads"), "mols": F.col("mols")})
    parts = wide.blocks(rows, {"reads": "int", "mols": "int"}, entity="cell", limit=1)
    assert [(names, t.columns, {r["cell"]: r[1] for r in t.collect()}) for names, t in parts] == [(["a b/=%"], ["cell", "a b/=%_reads", "a b/=%_mols"], {1: 12, 2: None}), (["b"], ["cell", "b_reads", "b_mols"], {1: 12, 2: None})]


def test_wide_moves_each_row_once(spark):
    df = spark.createDataFrame([(c, f"t{c * a % 19:02d}", a, a, T[0]) for c in range(200) for a in range(30)], "cell int, tag string, reads int, mols int, at timestamp")
    w = _widen(df)
    assert len(w.columns) == 39
    plan = w._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 19 + 3  # each narrow table, and the spine once for each group
