import random

import numpy as np
import pytest

from papyrine.llm.leakage import SEED, FMIndex, Phrases, leaks, passage, search_shard, suffix_array, words

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega one two three four five six seven eight nine ten".split()


def test_index_against_naive_search():
    rnd = random.Random(5)
    for sigma in (3, 7, 40):
        docs = [[rnd.randrange(1, sigma) for _ in range(rnd.randrange(0, 40))] for _ in range(20)] * 2
        text = np.array([c for d in docs for c in (*d, 0)], np.int32)
        order = suffix_array(text)
        assert sorted(order.tolist()) == list(range(len(text)))
        index = FMIndex(text, sigma)
        for n in (1, 2, 5):
            starts = [i for i in range(len(text) - n) if 0 not in text[i : i + n]][:30]
            phrases = np.array([text[i : i + n] for i in starts], np.int64)
            for phrase, low, high in zip(phrases, *index.search(phrases), strict=True):
                want = [i for i in range(len(text) - n + 1) if (text[i : i + n] == phrase).all()]
                assert sorted(index.locate(np.arange(low, high)).tolist()) == want


def test_words():
    assert words("Co-\nauthors &amp; <b>café</b> 1,395 сat s­oft ＡＢ") == ["coauthors", "cafe", "1395", "cat", "soft", "ab"]
    assert words(None) == words("") == words(" \n") == []


def test_passages():
    item = list(range(2, 42))
    assert passage(item, item, 5, 5)[0] == 40
    changed = [*item[:20], 99, *item[21:]]
    assert passage(item, changed, 0, 0)[0] == 40
    left_out = [*item[:20], *item[21:]]
    assert passage(item, left_out, 0, 0)[0] == 40
    assert passage(item, [1] * 5 + item[:16] + [1] * 5, 0, 5) is None  # 16 words and at most one error
    every_fifth = [1 if i % 5 == 4 else c for i, c in enumerate(item)]
    assert all(passage(item, every_fifth, i, i) is None for i in range(0, 30, 5))


def test_every_copy_is_reported(spark, monkeypatch):
    rnd = random.Random(8)
    item = [f"w{i}" for i in range(40)]
    phrases = Phrases({1: item})
    text = [*item[:20], *["x"] * 9, *item, *["y"] * 5, *item[10:31]]
    coded, own = [phrases.code.get(w, 1) for w in text], phrases.items[1]
    got = search_shard(phrases, [coded])
    tried = [passage(own, coded, i, j) for i in range(len(own) - SEED + 1) for j in range(len(coded) - SEED + 1) if own[i : i + SEED] == coded[j : j + SEED]]
    assert {x[2:] for x in got} == {p for p in tried if p and not any(q and q != p and q[1] <= p[1] and p[2] <= q[2] for q in tried)}
    spans = sorted(x[3:] for x in got)
    for first, last in [(0, 19), (29, 68), (74, 94)]:  # three passages of one item
        assert sum(a <= first and last <= b for a, b in spans) == 1
    tag = "<a href='" + "long " * 100 + "'>"
    docs = spark.createDataFrame([(1, " ".join(text)), (2, " ".join([*item[:15], tag, *item[15:]]))], "doc_id long, text string")
    items = spark.createDataFrame([(k, " ".join(item if k == 3 else [rnd.choice(WORDS) + str(k) for _ in range(20)])) for k in range(6)], "item_id long, item_text string")
    whole = sorted(tuple(r) for r in leaks(docs, "doc_id", "text", items, "item_id", "item_text").collect())
    assert [r[:2] for r in whole] == [(1, 3)] * len(spans) + [(2, 3)]
    monkeypatch.setattr("papyrine.llm.leakage.ITEM_BLOCK", 2)
    assert sorted(tuple(r) for r in leaks(docs, "doc_id", "text", items, "item_id", "item_text").collect()) == whole


def sentence(rnd, n):
    return " ".join(rnd.choice(WORDS) for _ in range(n))


def test_leaks(spark):
    rnd = random.Random(2)
    first, second = sentence(rnd, 40), sentence(rnd, 30)
    items = [(1, f"Read the text and choose. {first}"), (2, f"Read the text and choose. {second}"), (3, None), (None, "x"), (4, "short item")]
    w = first.split()
    docs = [
        (10, f"intro {first} end"), (11, " ".join(w[:25]).upper().replace(" ", ",\n")), (12, " ".join(w[:12])), (13, " ".join([*w[:10], "changed", *w[11:22]])), (14, f"{first} and {second}"),
        (15, "Read the text and choose."), (16, None), (17, ""), (10, f"intro {first} end"), (18, sentence(rnd, 5000)), (19, " ".join(x if i % 4 else "z" for i, x in enumerate(w))),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as item_id", "'x' as k")
    it = spark.createDataFrame(items, "item_id long, item_text string")
    got = sorted((r.doc_id, r.item_id) for r in leaks(df, "doc_id", "text", it, "item_id", "item_text").collect())
    assert got == [(10, 1), (10, 1), (11, 1), (13, 1), (14, 1), (14, 2)]
    assert leaks(df.where("false"), "doc_id", "text", it, "item_id", "item_text").count() == 0
    assert leaks(df, "doc_id", "text", it.where("false"), "item_id", "item_text").count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_every_run_is_tried(seed):
    rnd = random.Random(seed)
    text = [f"w{i}" for i in range(60)]
    if seed:  # as it is, the first words give the first seed
        rnd.shuffle(text)
    wrong = lambda own, *at: [("other" if i in at else w) for i, w in enumerate(own)]
    added = [*text[:6], "x", *text[6:12], "x", "x", *text[12:27], "x", "x", *text[27:60]]  # 5 words added, so shifts up to 5
    docs = [wrong(text, *range(10, 16), *range(36, 60)), wrong(text, *range(24), *range(44, 50)), wrong(text[:30], 12, 14, 16), wrong(text[:30], 12, 13, 14, 16), added, text[:16]]
    for items in ({1: text}, {1: text[::-1]}, {1: text, 2: text[:30]}):
        phrases = Phrases(items)
        coded = [[phrases.code.get(w, 1) for w in own] for own in docs + [own[::-1] for own in docs]]
        want = {}
        for d, own in enumerate(coded):
            for key, item in phrases.items.items():
                got = [passage(item, own, i, j) for i in range(len(item) - SEED + 1) for j in range(len(own) - SEED + 1) if item[i : i + SEED] == own[j : j + SEED]]
                if any(got):
                    want[d, key] = max(x for x in got if x)
        assert {(d, key): tuple(rest) for d, key, *rest in search_shard(phrases, coded)} == want
        assert len({d for d, _ in want}) == 4  # the same four of each direction
