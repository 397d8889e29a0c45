import itertools
import json
import random

import numpy as np
import pytest

from papyrine.llm import names
from papyrine.llm.entities import SHARED_KEY, doi_key, matches, near_titles, orcid_key, propagate, shared_works, title_key, titles_of, with_prior
from papyrine.llm.entities import alike_without_a_letter, without_two_parts
from papyrine.llm.names import cluster, form, join_shard, link, nickname, one_edit, similarity, spellings, weights


class Counts(dict):
    def get(self, part, default=0):
        return super().get(part, -len(part))


def score(a, b):
    return similarity(*sorted((form(a).split(" "), form(b).split(" "))), Counts())[0]


def test_forms():
    assert form("Dr. Astrid Zorkmark, PhD") == "astrid zorkmark"
    assert form("Zorkmark, Astrid") == form("ASTRID ZORKMARK") == form("Astrid  Zorkmark")
    assert form("Zorkmark A.K.") == form("A. K. Zorkmark") == "a k zorkmark"
    assert form("Zorkmark PP") == "p p zorkmark" and form("Zorkmark J-L.") == "j-l zorkmark"
    assert form("Urška Żak") == form("Urska Zak") and form("Ilmovič") == form("Ilmovich")
    assert form("") == form("123 --") == ""


def test_similarity():
    assert one_edit("abcd", "abdc") and one_edit("abcd", "abd") and not one_edit("abcd", "badc")
    assert nickname("lola", "dolores") and not nickname("lola", "maria")
    for a, b in [("Astrid Zorkmark", "Zorkmark A."), ("Lola Zorkmark", "Dolores Zorkmark"), ("Astrid Zorkmrak", "Astrid Zorkmark"), ("Anne-Marie Zorkmark", "Zorkmark A-M."), ("Zorkmark Astrid", "Astrid Zorkmark"), ("Astrid Zorkmark", "Zorkmark A.M.")]:
        assert score(a, b) >= names.SIMILARITY, (a, b)
    for a, b in [("Astrid M. Zorkmark", "Zorkmark A."), ("Zorkmark A.M.", "Zorkmark A."), ("Astrid Zorkmark-Belling", "Zorkmark A.")]:
        assert names.SUPPORTED <= score(a, b) < names.SIMILARITY, (a, b)
    for a, b in [("Astrid Zorkmark", "Anna Zorkmark"), ("Astrid Zorkmark", "Astrid Belling"), ("Zorkmark A-M.", "Zorkmark A."), ("Zorkmark A.B.", "Zorkmark A.C."), ("Zorkmark", "Astrid Zorkmark"), ("Zorkmark Č.", "Zorkmark C.")]:
        assert score(a, b) < names.SIMILARITY, (a, b)


def test_join_finds_every_pair_above_the_cosine():
    rnd = np.random.default_rng(2)
    firsts, lasts = ["astrid", "anna", "bo", "carl", "c", "a"], ["zorkmark", "zorkmrak", "belling", "bellinger", "tavori", "ostberg"]
    forms = sorted({f"{firsts[i]} {lasts[j]}" for i, j in zip(rnd.integers(0, 6, 80), rnd.integers(0, 6, 80), strict=True)})
    frequencies = np.bincount(weights(forms, None, 1).feature, minlength=1 << names.BITS)
    got = {(a, b) for a, b, *_ in join_shard(forms, None, frequencies, len(forms), Counts())}
    rows = weights(forms, frequencies, len(forms))
    dense = np.zeros((len(forms), 1 << names.BITS), np.float32)
    dense[rows.owner(), rows.feature] = rows.weight
    cosine = dense @ dense.T
    want = {(forms[i], forms[j]) for i, j in itertools.combinations(range(len(forms)), 2) if cosine[i, j] >= names.COSINE and similarity(forms[i].split(" "), forms[j].split(" "), Counts())[0] >= names.SUPPORTED}
    assert got == want and want
    halves = [join_shard(forms, np.arange(1 << names.BITS) % 3 == k, frequencies, len(forms), Counts()) for k in range(3)]
    assert sorted((a, b) for own in halves for a, b, *_ in own) == sorted(want)  # each pair from one shard


def test_short_surnames_are_joined(spark):
    spelled = ["Wei Li", "Li W.", "Li, Wei", "Mei Wu", "Wu M.", "Bo Ng", "Ng B.", "Xu Li", "Anna de Zorkmark", "Zorkmark A. de"]
    fields = [("Wei", "Li"), ("Mei", "Wu"), ("Bo", "Ng"), ("Xu", "Li"), ("Anna", "de Zorkmark")]
    _, pairs, _ = link(spark.createDataFrame([(x,) for x in spelled], "name string"), spark.createDataFrame(fields, "given string, family string"))
    assert {(r.a, r.b) for r in pairs.collect()} == {("w li", "wei li"), ("m wu", "mei wu"), ("b ng", "bo ng"), ("a de zorkmark", "anna de zorkmark")}
    assert not len(weights(["de a", "li a"], None, 1).take(np.array([0])).feature) and len(weights(["li a"], None, 1).feature) == 1


def test_clusters():
    pairs = [("a z", "anna z", 0.85), ("a z", "astrid z", 0.8), ("astrid z", "astrd z", 0.9)]
    assert cluster(pairs) == [True, False, True]  # an abbreviated form is clustered like all others
    chain = [("anna marie zorkmark", "anna zorkmark", 0.97), ("anna zorkmark", "anna zofia zorkmark", 0.97)]
    assert sum(cluster(chain)) == 1  # average linkage doesn't chain two middle names


def test_link(spark):
    cross = spark.createDataFrame([("Astrid", "Zorkmark"), ("Dr. Astrid", "Zorkmark"), (None, "Zorkmark, Astrid"), ("Anna", "Belling"), (None, None), ("", " "), ("Astrid", "Zorkmark"), ("Bo", "Ostberg")], "author_given_name string, author_family_name string")
    other = spark.createDataFrame([("Zorkmark A.",), ("Belling A.",), (None,), ("---",)], "author_indexed_name string")
    formed, pairs, weak = link(spellings(cross, other))
    assert weak.count() == 0
    assert {r.name for r in formed.collect()} == {"Astrid Zorkmark", "Dr. Astrid Zorkmark", "Zorkmark, Astrid", "Anna Belling", "Bo Ostberg", "Zorkmark A.", "Belling A.", "---"}
    assert {(r.a, r.b) for r in pairs.collect()} == {("a zorkmark", "astrid zorkmark"), ("a belling", "anna belling")}
    formed, pairs, _ = link(spellings(cross.where("false"), other.where("false")))
    assert formed.count() == pairs.count() == 0


CROSSREF = "article_doi string, author_sequence_index int, author_orcid string, author_given_name string, author_family_name string"
ELSEVIER = "article_doi string, author_sequence string, author_id string, author_indexed_name string, author_first_name string, author_last_name string"


def test_bearers(spark):
    cross = spark.createDataFrame([("10.1/A", 1, None, "Astrid", "Zorkmark"), ("10.1/A", 1, None, "Astrid", "Zorkmark"), ("10.1/B", 1, "0000-0001-0000-000X", "A.", "Belling"), ("10.1/C", 1, "https://x/000000010000000x", "Anna", "Belling"), (None, None, None, None, None), ("10.1/D", 2, None, " ", " ")], CROSSREF)
    els = spark.createDataFrame([("10.1/a ", "1", "7", "Zorkmark A.", "A.", "Zorkmark"), (None, "1", "7", "Zorkmark A.K.", None, None), ("10.1/D", "x", None, "Ostberg B.", "Bo", None), (None, None, "8", None, None, None)], ELSEVIER)
    got = {(r.name, r.bearer): r.firsts for r in names.bearers(cross, els).collect()}
    assert got == {
        ("Astrid Zorkmark", "id 7"): ["Astrid"], ("Zorkmark A.", "id 7"): ["Astrid"], ("Zorkmark A.K.", "id 7"): ["Astrid"],
        ("A. Belling", "orcid 000000010000000X"): ["Anna"], ("Anna Belling", "orcid 000000010000000X"): ["Anna"], ("Ostberg B.", "name Ostberg B."): None,
    }
    formed, pairs, weak = link(names.bearers(cross, els), names.roles(cross, els))
    assert {(r.name, r.form) for r in formed.collect()} >= {("Zorkmark A.", "astrid zorkmark"), ("Zorkmark A.K.", "astrid k zorkmark"), ("A. Belling", "anna belling"), ("Ostberg B.", "b ostberg")}
    assert {(r.a, r.b) for r in pairs.collect()} == {("astrid k zorkmark", "astrid zorkmark")} and weak.count() == 0
    empty = link(names.bearers(cross.where("false"), els.where("false")), names.roles(cross.where("false"), els.where("false")))
    assert [x.count() for x in empty] == [0, 0, 0]


def test_written_out():
    assert names.written_out("a k zorkmark", ["Astrid", "Bo"]) == ["astrid k zorkmark"]
    assert names.written_out("a k zorkmark", ["Astrid Karla"]) == ["astrid karla zorkmark"]
    assert names.written_out("b zorkmark", ["William"]) == ["b zorkmark"]
    assert names.written_out("a zorkmark", ["Anna", "Astrid", "A.", ""]) == ["anna zorkmark", "astrid zorkmark"]
    assert names.written_out("anna zorkmark", ["Astrid"]) == ["anna zorkmark"] and names.written_out("", []) == [""]


def test_roles_tell_surnames(spark):
    hashed = lambda parts: np.bincount([names._place(p) for p in parts], minlength=1 << names.PARTS_BITS)
    given, family = hashed(["guillermo", "astrid", "li", "anna"]), hashed(["zorkmark", "belling", "wu", "ostberg"])
    counts = names.RoleCounts(given + family, given, family)
    of = lambda a, b: similarity(a.split(" "), b.split(" "), counts)[0]
    assert of("guillermo i belling", "guillermo ilmovic") == 0  # a given name is no surname in common
    assert of("li wu", "l wu") >= names.SIMILARITY  # short surnames are surnames
    assert of("astrid zorkmark", "astrid belling zorkmark") < names.SIMILARITY <= of("astrid m zorkmark", "astrid zorkmark")
    assert of("astrid zorkmark", "astrid van zorkmark") < names.SIMILARITY


def test_forms_of_initials_and_particles():
    assert form("Zorkmark MS") == "m s zorkmark" and form("Richard Zorkmark MD") == "ricard zorkmark"
    assert form("Zorkmark J. de") == "j de zorkmark"


def test_keys(spark):
    rows = spark.createDataFrame([("https://doi.example.org/10.1/A", "http://orcid.example.org/0000-0001-2345-678x", "A <i>long</i> title &amp; more"), (" 10.1/a", "0000000123456781", "short"), (None, None, None), ("", "12", "")], "d string, o string, t string")
    got = [tuple(r) for r in rows.select(doi_key(rows.d), orcid_key(rows.o), title_key(rows.t)).collect()]
    assert got == [("10.1/a", "0000-0001-2345-678X", "alongtitlemore"), ("10.1/a", "0000-0001-2345-6781", None), (None, None, None), (None, None, None)]


def test_propagation_against_all_assignments(spark):
    prior = {("m1", "a1"): 1.0, ("m1", "a2"): 0.5, ("m2", "a1"): 0.3, ("m3", "a3"): 2.0, ("m4", "a3"): 1.5}
    got = {(r.member_id, r.author_id): r.probability for r in propagate(spark.createDataFrame([(m, a, x) for (m, a), x in prior.items()] + [("m9", "a1", -9.0)], "member_id string, author_id string, prior double")).collect()}
    keys, total, marginal = list(prior), 0.0, dict.fromkeys(prior, 0.0)
    for choice in itertools.product((0, 1), repeat=len(keys)):
        on = [k for k, c in zip(keys, choice, strict=True) if c]
        if len({a for _, a in on}) < len(on):
            continue
        extra = len(on) - len({m for m, _ in on})
        weight = np.exp(sum(prior[k] for k in on)) * 0.3**extra
        total += weight
        for k in on:
            marginal[k] += weight
    assert all(abs(got[k] - marginal[k] / total) < 0.02 for k in keys)  # the graph is a tree, so beliefs are exact
    assert got["m9", "a1"] < 0.001
    assert propagate(spark.createDataFrame([], "member_id string, author_id string, prior double")).count() == 0


@pytest.mark.parametrize("rows", [True, False])
def test_matches(spark, rows):
    works = spark.createDataFrame([("m1", "10.1/x", None, "The first title of all"), ("m1", None, "e2", "Another title here"), ("m2", None, None, "the FIRST title of all"), (None, "10.1/x", None, "t"), ("m3", None, None, None)], "member_id string, article_doi string, article_eid string, article_title string")
    person = lambda g, f: json.dumps({"name": {"given-names": {"value": g}, "family-name": {"value": f}}})
    persons = spark.createDataFrame([("m1", person("Astrid", "Zorkmark"), 1), ("m2", person("Bo", "Belling"), 1), ("m3", "{", 1)], "member_id string, member_person string, row_created_at long")
    crossref = spark.createDataFrame([("10.1/x", "0000", "A", "Z")], "article_doi string, author_orcid string, author_given_name string, author_family_name string")
    article = lambda i, d, e, t, a, n: (i, d, e, t, a, n, None, None)
    els = spark.createDataFrame([article("1", "10.1/X", "e1", "The first title of all", "a1", "Zorkmark A."), article("1", "10.1/X", "e1", "The first title of all", "a2", "Belling B."), article("2", None, "e2", "zzz", "a1", "Zorkmark A."), article("2", None, "e2", "zzz", "a3", "Tavori C."), article(None, None, None, None, None, None)], "article_id string, article_doi string, article_eid string, article_title string, author_id string, author_indexed_name string, author_first_name string, author_last_name string")
    if not rows:
        assert matches(works.where("false"), persons, crossref, els.where("false")).count() == 0
        return
    got = {(r.member_id, r.author_id) for r in matches(works, persons, crossref, els).where("probability >= 0.5").collect()}
    assert got == {("m1", "a1"), ("m2", "a2")}


def test_frequent_keys_name_works(spark):
    many, more = SHARED_KEY + 10, 2 * SHARED_KEY
    works = spark.createDataFrame([(f"m{i}", 1) for i in range(many)] + [("n", 2), ("n", 3)], "member_id string, key long")
    articles = spark.createDataFrame([("a", 1), ("b", 1)] + [(f"c{i}", 2) for i in range(more)] + [("c0", 3)], "article_id string, key long")
    got = {(r.member_id, r.article_id): r.weight for r in shared_works(works, articles).collect()}
    assert got == {**{(f"m{i}", x): 1.0 for i in range(many) for x in "ab"}, **{("n", f"c{i}"): 0.5 for i in range(1, more)}, ("n", "c0"): 1.0}


def test_titles_with_a_typing_error(spark):
    mine = ["Guide RNAs in rural districts", "Guide RNAs: part 2 of three", "Žuželke v gozdovih Slovenije", "short", None, "The same title"]
    theirs = ["Guide RNAs in rual districts", "Guide RNAs in rurak districtss", "Guide RNAsxin rural districts", "Guide RNAs: part 3 of three", "Žuželkev gozdoviih Slovenije", "Guide RNA in rural distrct", "short", None, "The same title", "Rural districts in guide RNAs"]
    sides = [titles_of(spark.createDataFrame([(x,) for x in own], "article_title string")) for own in (mine, theirs)]
    names_of = [{r.key: r.text for r in side.collect()} for side in sides]
    got = {(names_of[0][r.key], names_of[1][r.near]) for r in near_titles(*sides).collect()}
    assert got == {("guidernasinruraldistricts", x) for x in ("guidernasinrualdistricts", "guidernasxinruraldistricts")} | {("žuželkevgozdovihslovenije", "žuželkevgozdoviihslovenije")}


def test_a_work_with_a_misspelt_title_gives_a_match(spark):
    works = spark.createDataFrame([("m1", None, None, "Towards irregular label noise")], "member_id string, article_doi string, article_eid string, article_title string")
    persons = spark.createDataFrame([("m1", json.dumps({"name": {"given-names": {"value": "Astrid"}, "family-name": {"value": "Zorkmark"}}}), 1)], "member_id string, member_person string, row_created_at long")
    crossref = spark.createDataFrame([], "article_doi string, author_orcid string, author_given_name string, author_family_name string")
    els = spark.createDataFrame([("1", None, "e1", "Towards irregular label noie", "a1", "Zorkmark A.", None, None)], "article_id string, article_doi string, article_eid string, article_title string, author_id string, author_indexed_name string, author_first_name string, author_last_name string")
    assert [(r.member_id, r.author_id) for r in matches(works, persons, crossref, els).where("probability >= 0.5").collect()] == [("m1", "a1")]


def test_crowded_surnames_are_clustered(spark, monkeypatch):
    monkeypatch.setattr(names, "RARITY", 0.0)  # so that the forms of a made-up crowd are candidates of each other
    letters = "abcdefghijklmnopqrst"
    crowd = [(f"Annabe{x}la Margari{y}ta", "Zorkmark") for x in letters for y in letters]  # 72,200 strong pairs of this surname
    chain = [("Annika", "Zorkmark"), ("Anika Sofia", "Zorkmark"), ("Anniika Maria", "Zorkmark")]
    given = "author_given_name string, author_family_name string"
    none = spark.createDataFrame([], "author_indexed_name string")
    want = {tuple(r) for r in link(spellings(spark.createDataFrame(chain, given), none))[1].select("a", "b").collect()}
    pairs = link(spellings(spark.createDataFrame(crowd + chain, given), none))[1].collect()
    own = {form(" ".join(x)) for x in chain}
    assert len(pairs) > 50_000
    assert {(r.a, r.b) for r in pairs if r.a in own and r.b in own} == want and len(want) == 1


def test_clusters_against_plain_average_linkage():
    rnd = np.random.default_rng(4)
    for _ in range(30):
        forms = sorted([f"given{i} zorkmark" for i in range(14)] + ["a zorkmark", "b zorkmark"])
        pairs = [(a, b, float(rnd.uniform(0.5, 1))) for a, b in itertools.combinations(forms, 2) if rnd.random() < 0.6]
        score = {frozenset(p[:2]): p[2] for p in pairs}
        groups = {x: [x] for x in forms}
        while True:
            average = lambda a, b, g=groups: sum(score.get(frozenset((x, y)), 0) for x in g[a] for y in g[b]) / len(g[a]) / len(g[b])
            best = max(((average(a, b), a, b) for a, b in itertools.combinations(groups, 2)), key=lambda t: (round(t[0], 9), -forms.index(t[1]), -forms.index(t[2])), default=(0,))
            if best[0] < names.LINKAGE - 1e-9:
                break
            groups[best[1]] += groups.pop(best[2])
        of = {x: g for g in groups.values() for x in g}
        for (a, b, _), holds in zip(pairs, cluster(pairs), strict=True):
            assert holds == (of[a] is of[b])


def test_prior_of_a_surname_with_a_typing_error(spark):
    ana = [form("Ana Novak")]
    rows = [("m1", "a1", 1.0, 1.0, ana, [form("Nowak A.")]), ("m1", "a2", 1.0, 1.0, ana, [form("Zorkmark A.")]), ("m1", "a3", 1.0, 1.0, None, [form("Nowak A.")]), ("m1", "a4", 500.0, 1.0, ana, ana)]
    got = {r.author_id: r.prior for r in with_prior(spark.createDataFrame(rows, "member_id string, author_id string, works double, share double, member_names array<string>, author_names array<string>")).collect()}
    assert got["a2"] < got["a3"] < 0 < got["a1"] < got["a4"]  # an error in the middle of the surname; more works always count


def test_many_hopeless_pairs_weigh_together(spark):
    rows = [("m0", "a", 1.0)] + [(f"m{i}", "a", -3.5) for i in range(1, 40)]
    got = {r.member_id: r.probability for r in propagate(spark.createDataFrame(rows, "member_id string, author_id string, prior double")).collect()}
    total = 1 + np.e + 39 * np.exp(-3.5)
    assert got["m0"] == pytest.approx(np.e / total, abs=0.01) and got["m5"] == pytest.approx(np.exp(-3.5) / total, abs=0.01)
    with pytest.warns(UserWarning, match="have not settled"):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr("papyrine.llm.entities.ROUNDS", 1)
            propagate(spark.createDataFrame(rows, "member_id string, author_id string, prior double"))


def test_parts_left_out_find_every_pair():
    rnd = random.Random(3)
    for _ in range(300):
        whole = "".join(rnd.choice("abcdé") for _ in range(rnd.randrange(12, 40)))
        i, j = rnd.randrange(len(whole)), rnd.randrange(len(whole) + 1)
        one = rnd.choice([whole, whole[:i] + whole[i + 1 :], whole[:i] + rnd.choice("xyz") + whole[i:], whole[:i] + "z" + whole[i + 1 :]])
        # a letter left out of each of two texts makes them equal
        other = one[:i] + one[i + 1 :] if rnd.random() < 0.4 else (one[:i] + one[i + 1 :])[: min(j, len(one) - 1)] + rnd.choice("abxy") + (one[:i] + one[i + 1 :])[min(j, len(one) - 1) :]
        if one == other or min(len(one), len(other)) < 12:
            continue
        assert alike_without_a_letter(one, other) and alike_without_a_letter(other, one)
        for a, b in ((one, other), (other, one)):
            asked, there = (set(without_two_parts([x], y)[1].tolist()) for x, y in ((a, True), (b, False)))
            assert asked & there, (a, b)
    assert not alike_without_a_letter("abcdefgh", "axcdexgh") and not alike_without_a_letter("abcdefgh", "abcdef")
    place, hashes = without_two_parts(["", "abcdefghijklmn", ""], True)
    assert set(place.tolist()) <= {0, 1, 2} and len(place) == len(hashes)
