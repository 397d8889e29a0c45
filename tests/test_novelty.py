import datetime as dt
import itertools
import random

from papyrine.operators.novelty import novelty


def frame(spark, rows):
    return spark.createDataFrame(rows, "article_id string, author_id string, institution_id string, dt date")


def sequential(rows):
    """The index by going through the articles in order with counters of pairs."""
    by = {}
    for a, author, inst, day in set(rows):
        entry = by.setdefault((day, a), (set(), set()))
        entry[0].add(author)
        entry[1].add(inst)
    authors, institutions, out = {}, {}, {}
    for (_, a), (who, where) in sorted(by.items()):
        pairs = list(itertools.combinations(sorted(who), 2))
        places = list(itertools.combinations(sorted(where), 2)) if pairs else []
        old = sum(p in authors for p in pairs)
        for p in pairs:
            authors[p] = authors.get(p, 0) + 1
        for p in places:
            institutions[p] = institutions.get(p, 0) + 1
        n_a = sum(1 / (1 + authors[p]) for p in pairs) if pairs else 1
        out[a] = n_a * (1 + sum(1 / (1 + institutions[p]) for p in places)) / (1 + old)
    return out


def test_five_steps(spark):
    day = lambda i: dt.date(2020, 1, i)
    at = {"A": "I1", "B": "I2", "C": "I2", "D": "I1", "E": "I2", "F": "I1", "G": "I3"}
    rows = [(t, p, at[p], day(i)) for i, (t, who) in enumerate([("t1", "BC"), ("t2", "ABC"), ("t3", "ABCD"), ("t4", "EF"), ("t5", "ABCDG")], 1) for p in who]
    index = {r[0]: round(r[1], 4) for r in novelty(frame(spark, rows))[0].collect()}
    assert index == {"t1": 0.5, "t2": 1.0, "t3": 0.8056, "t4": 0.625, "t5": 1.1629}


def test_random_graph_equals_sequential(spark):
    rnd = random.Random(3)
    rows = [(f"a{i}", f"p{rnd.randrange(12)}", f"i{rnd.randrange(4)}", dt.date(2020, 1, 1 + i // 5)) for i in range(60) for _ in range(rnd.randrange(1, 5))]
    got = {r[0]: r[1] for r in novelty(frame(spark, rows))[0].collect()}
    want = sequential(rows)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_flags_and_edge_rows(spark):
    d1, d2 = dt.date(2020, 1, 1), dt.date(2020, 1, 2)
    rows = [("x", "a", "i", d1), ("x", "b", "j", d1), ("x", "b", "j", d1), ("y", "c", "i", d2), ("y", "d", "j", d2), ("z", "a", "i", d2), ("z", "a", "j", d2), ("n", None, "i", d1), ("m", "a", None, d1)]
    index, metadata, pairs = novelty(frame(spark, rows))
    assert {r[0]: round(r[1], 4) for r in index.collect()} == {"x": 0.75, "y": round(0.5 * (1 + 1 / 3), 4), "z": 1.0}
    flags = {(r[0], r[1]): (r[3], r[4]) for r in metadata.collect()}
    assert flags["x", "a"] == (True, True)
    assert flags["y", "c"] == (True, True)  # the pair of institutions is old, but new for these authors
    assert flags["z", "a"] == (False, False)
    assert pairs.count() == 2
    assert all(f.count() == 0 for f in novelty(frame(spark, rows).where("false")))
