import numpy as np

from papyrine.llm.neighbours import VantageTree, clean_vectors, nearest


def vectors(n, seed=1, size=8):
    random = np.random.default_rng(seed)
    centres = random.normal(size=(n // 20 + 1, size))
    m = centres[random.integers(0, len(centres), n)] + 0.3 * random.normal(size=(n, size))
    return (m / np.linalg.norm(m, axis=1, keepdims=True)).astype(np.float32)


def test_tree_with_factor_one_is_exact():
    m = vectors(1500)
    best, rows = np.full((len(m), 5), -2, np.float32), np.full((len(m), 5), -1)
    VantageTree(m, leaf=16).search(m, best, rows, 1.0, np.arange(len(m)))
    s = m @ m.T
    np.fill_diagonal(s, -9)
    np.testing.assert_allclose(best, -np.sort(-s, axis=1)[:, :5], atol=1e-5)
    same = np.ones((100, 8), np.float32) / np.sqrt(8).astype(np.float32)
    VantageTree(same, leaf=4).search(same, best[:100], rows[:100], 1.0, np.arange(100))


def test_table_recall_and_shards(spark, monkeypatch):
    from papyrine.llm import neighbours

    monkeypatch.setattr(neighbours, "SHARD_ROWS", 100)
    monkeypatch.setattr(neighbours, "QUERY_ROWS", 150)
    m = vectors(900)
    df = spark.createDataFrame([(f"v{i:04}", [float(x) * (i + 1) for x in row]) for i, row in enumerate(m)], "id string, v array<double>")
    got = {}
    for r in nearest(df, "id", "v", 8, factor=1.0).collect():
        got.setdefault(r.id, set()).add(r.neighbour)
    s = m @ m.T
    np.fill_diagonal(s, -9)
    want = {f"v{i:04}": {f"v{j:04}" for j in np.argsort(-s[i])[:5]} for i in range(len(m))}
    assert all(len(v) == 5 for v in got.values())
    assert sum(len(got[k] & want[k]) for k in want) / (5 * len(want)) > 0.999


def test_copies_unusable_vectors_and_small_tables(spark):
    rows = [(f"c{i:03}", [1.0, 2.0]) for i in range(40)] + [("far", [-1.0, 0.5]), ("zero", [0.0, 0.0]), ("null", None), ("nan", [1.0, float("nan")]), ("long", [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), ("c000", [1.0, 2.0])]
    df = spark.createDataFrame(rows, "id string, vec array<double>").selectExpr("*", "1 as copy", "2 as cell")
    got = {}
    for r in nearest(df, "id", "vec", 2).collect():
        got.setdefault(r.id, []).append((r.neighbour, round(r.similarity, 6)))
    assert set(got) == {f"c{i:03}" for i in range(40)} | {"far"}
    assert all(len(v) == 5 and k not in {n for n, _ in v} for k, v in got.items())
    assert all(s == 1 for k, v in got.items() if k != "far" for _, s in v)
    assert nearest(df.where("false"), "id", "vec", 2).count() == 0
    assert nearest(df.where("id = 'far'"), "id", "vec", 2).count() == 0
    assert clean_vectors(df, "id", "vec", 2).count() == 41
