import json

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import numpy as np

from papyrine.operators.shredding import Path, ordinals, read_json, relation, relations, shred, shred_value

AUTHORS = st.one_of(st.none(), st.dictionaries(st.sampled_from(["x"]), st.one_of(st.none(), st.text(max_size=2), st.lists(st.one_of(st.none(), st.dictionaries(st.sampled_from(["y"]), st.integers(0, 3)), st.integers(0, 2)), max_size=3)), max_size=1))
DOCUMENTS = st.dictionaries(st.sampled_from(["a", "b"]), st.one_of(AUTHORS, st.lists(AUTHORS, max_size=4)), max_size=2)


def places(value):
    return value if isinstance(value, list) else [] if value is None else [value]


def expected(doc):
    """Positions by walking the document."""
    outer, inner = [], []
    for i, a in enumerate(places(doc.get("a")), 1):
        if a is None:
            continue
        outer.append((i,))
        inner += [(i, j) for j, f in enumerate(places(a.get("x") if isinstance(a, dict) else None), 1) if f is not None]
    return outer, inner


@given(DOCUMENTS)
@settings(max_examples=300, deadline=None)
def test_positions_come_back_from_levels(doc):
    path = Path("a[].x[].y")
    values, rep, dfn = shred_value(doc, path.steps)
    assert len(values) == len(rep) == len(dfn) and rep[0] == 0
    for depth, wanted in zip((1, 2), expected(doc), strict=True):
        start, positions = ordinals(np.array(rep), np.array(dfn), path.ancestors, depth)
        assert [tuple(int(p[k]) for p in positions) for k in np.flatnonzero(start)] == wanted


def test_read_json():
    assert read_json('{"a": 1}') == (True, {"a": 1})
    assert read_json('"{\\"a\\": 1}"') == (True, {"a": 1})
    assert read_json("null") == (True, None)
    for bad in (None, "", "{", '"text"', "NaN", "[" * 200_000):
        assert read_json(bad)[0] is False


def rows(spark, *docs):
    return spark.createDataFrame([(k, d if d is None or isinstance(d, str) else json.dumps(d), v, "extra") for k, d, v in docs], "id string, doc string, at long, k string")


def test_latest_readable_version_and_null_elements(spark):
    df = rows(
        spark,
        ("p", {"a": [{"x": "old"}]}, 1), ("p", {"a": [None, {"x": [None, "f", "g"]}, "plain"]}, 2), ("p", "{broken", 3),
        ("bare", {"a": {"x": {"y": 1}}}, 1), ("empty", {"a": []}, 1), ("none", {}, 1), ("bad", "[1", 1), ("null", None, 1), (None, {"a": [{}]}, 1),
        ("inner", json.dumps(json.dumps({"message": {"a": [{}]}})), 1), ("nullmessage", {"message": None, "a": [{}]}, None),
    )
    base = shred(df, "id", "doc", "at", {"leaf": "a[].x[]"}, unwrap="message", values=False)
    specs = {"author": ("leaf", "a[].x[]", 1), "place": ("leaf", "a[].x[]", 2)}
    got = {tuple(r) for r in relations(base, "id", specs).collect()}
    assert got == {("author", "p", 2, 0), ("author", "p", 3, 0), ("place", "p", 2, 2), ("place", "p", 2, 3), ("author", "bare", 1, 0), ("place", "bare", 1, 1), ("author", "inner", 1, 0), ("author", "nullmessage", 1, 0)}


def test_values_stay_with_their_rows(spark):
    df = rows(spark, ("p", {"a": [{"n": "one"}, {"m": 2}, None, {"n": None}, {"n": [1]}]}, 1))
    base = shred(df, "id", "doc", "at", {"s": "a[]", "n": "a[].n", "m": "a[].m"})
    got = sorted(tuple(r) for r in relation(base, "id", "s", "a[]", 1, {"n": "n", "m": "m"}).collect())
    assert [(r[1], r[3], r[4]) for r in got] == [(1, "one", None), (2, None, "2"), (4, None, None), (5, None, None)]


def test_empty_table_and_repeated_rows(spark):
    empty = rows(spark, ("p", {"a": [{}]}, 1)).where("false")
    assert relations(shred(empty, "id", "doc", "at", {"s": "a[]"}, values=False), "id", {"r": ("s", "a[]", 1)}).count() == 0
    twice = rows(spark, *[("p", {"a": [{}, {}]}, 1)] * 5)
    assert relations(shred(twice, "id", "doc", "at", {"s": "a[]"}, values=False), "id", {"r": ("s", "a[]", 1)}).count() == 2


def test_many_versions_of_one_key_are_reduced_before_the_shuffle(spark):
    df = spark.range(20_000).select(F.lit("hot").alias("id"), F.concat(F.lit('{"a":[{"n":"'), F.col("id").cast("string"), F.lit('"}]}')).alias("doc"), F.col("id").alias("at"))
    base = shred(df, "id", "doc", "at", {"n": "a[].n"})
    assert base.first()["n_val"] == ["19999"]
    assert "MapInPandas" in base._jdf.queryExecution().toString() and "partial_max_by" in base._jdf.queryExecution().toString()
