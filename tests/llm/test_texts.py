import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from papyrine.llm import abuse, language, subjects
from papyrine.llm.features import Ftrl, Sparse, char_ngrams, plain, sentences, softmax, word_ngrams

SAMPLES = {
    "en": ["The results of this study show that the values have changed.", "We compare the limits of the model with data from the area.", "Little has been written about what happens over time."],
    "de": ["Die Ergebnisse der Studie zeigen, dass sich die Werte geändert haben.", "Wir vergleichen die Grenzen des Modells mit Daten aus der Gegend.", "Bisher wurde wenig darüber geschrieben, was im Laufe der Zeit geschieht."],
    "fr": ["Les résultats de cette étude montrent que les valeurs ont changé.", "Nous comparons les limites du modèle avec des données de la région.", "Peu de travaux ont été consacrés à ce qui se passe avec le temps."],
}


def test_features():
    rows = char_ngrams(["abc", "", "abcabc"], (3,), 12)
    assert rows.sizes.tolist() == [3, 0, 6]
    assert word_ngrams([["a", "b"], [], ["a"]], 2, 12).sizes.tolist() == [3, 0, 1]
    out = Sparse(np.array([0, 1, 1]), np.ones(3, np.float32), np.array([2, 0, 1])).times(np.array([[1.0], [2.0]]))
    assert out.ravel().tolist() == [3, 0, 2]
    f = Ftrl(4, 1, l1=0.0)
    for _ in range(50):
        f.step(Sparse(np.array([0, 1]), np.ones(2, np.float32), np.array([1, 1])), np.array([[-1.0], [1.0]]))
    assert f.coefficients[0, 0] > 0 > f.coefficients[1, 0] and f.coefficients[2, 0] == 0
    assert plain("a &amp;amp; <p>b</p>") == "a & \nb\n" and plain(None) == ""
    assert sentences("One. Two! Three\nfour") == ["One.", "Two!", "Three", "four"]


@pytest.fixture(scope="module")
def languages(spark):
    rnd = random.Random(1)
    texts, labels = [], []
    for i in range(150):
        code = list(SAMPLES)[i % 3]
        texts.append((f"a{i}", " ".join(rnd.choice(SAMPLES[code]) for _ in range(3))))
        labels.append((f"a{i}", {"en": " EN", "de": "German", "fr": "fr_FR"}[code] if i % 10 else "en"))
    df = spark.createDataFrame(texts, "id string, text string")
    return df, language.fit(df, spark.createDataFrame(labels, "id string, label string"))


def test_languages_of_sentences(spark, languages):
    _, model = languages
    mixed = f"<p>{SAMPLES['fr'][0]}</p> {SAMPLES['de'][1]} (school belonging)"
    rows = spark.createDataFrame([("m", mixed), ("e", ""), ("n", None), ("s", "Abstract")], "id string, text string").withColumn("words", F.lit("clash"))
    got = [(r.id, r.language_code) for r in language.classify(rows, model).where("words >= 4").orderBy("id", "sentence_no").collect()]
    assert got == [("m", "fr"), ("m", "de")]


def test_language_without_labels(spark, languages):
    df, _ = languages
    model = language.fit(df, spark.createDataFrame([("a1", None), (None, "en"), ("a2", "unknown")], "id string, label string"))
    assert np.allclose(model.probabilities(["the"]), 1 / len(language.LANGUAGES))
    assert language.fit(df.where("false"), spark.createDataFrame([("a1", "en")], "id string, label string")).temperature == 1
    code = lambda x: spark.createDataFrame([(x,)], "l string").select(language.language_code(F.col("l"))).first()[0]
    assert [code(x) for x in ("en-GB", " English", "SLV", "xx", "", None)] == ["en", "en", "sl", None, None, None]


FRENCH_AND_DUTCH = {
    "De plus, cette démarche permet de préciser le lien entre l'âge et la performance.": "fr",
    "L'article se termine par des recommandations valables sur plusieurs sites.": "fr",
    "On comprend ainsi mieux le cadre juridique actuel qu'auparavant.": "fr",
    "Het artikel eindigt met aanbevelingen die ook vergeleken met eerder werk gelden.": "nl",
    "Even so, wound care rose in two phases under routine conditions.": "en",
}


def test_languages_of_the_small_tables(spark):
    texts, labels = language.abstracts(spark, "/root/testdata/sf0.01"), language.article_labels(spark, "/root/testdata/sf0.01")
    model = language.fit(texts, labels)
    assert 0.1 < model.temperature < 4  # inside the grid
    again = language.fit(texts.repartition(5), labels.repartition(3))
    assert model.temperature == again.temperature and np.array_equal(model.coefficients, again.coefficients)
    chances = model.probabilities([language.letters(s) for s in FRENCH_AND_DUTCH])
    assert [language.LANGUAGES[i] for i in chances.argmax(axis=1)] == list(FRENCH_AND_DUTCH.values())
    assert chances.max(axis=1).min() >= language.CONFIDENCE


def test_temperature_with_labels_wrong_mostly_for_one_language():
    rnd = np.random.default_rng(1)
    true = np.where(rnd.random(1000) < 0.75, 0, rnd.integers(0, 8, 1000))
    named = np.where(true == 0, rnd.integers(0, 8, 1000), true)
    scores = rnd.normal(0, 0.5, (1000, 8))
    scores[np.arange(1000), true] += 6
    chances = softmax(scores / language._temperature(scores, named))
    assert chances.max(axis=1).min() >= language.CONFIDENCE  # clear sentences stay clear whatever their labels say
    assert language._temperature(scores[:0], named[:0]) == 1


def test_copies_of_texts_leave_the_model_as_it_is(spark):
    texts, labels = language.abstracts(spark, "/root/testdata/sf0.01"), language.article_labels(spark, "/root/testdata/sf0.01")
    copied = lambda df: df.select("*", F.explode(F.array(*map(F.lit, range(5)))).alias("copy")).withColumn("id", F.concat_ws("-", "id", "copy")).drop("copy")
    models = [language.fit(texts, labels), language.fit(copied(texts), copied(labels))]
    chances = [m.probabilities([language.letters(s) for s in FRENCH_AND_DUTCH]) for m in models]
    assert np.abs(chances[0] - chances[1]).max() < 0.03


def test_passages_of_several_abstracts(spark, monkeypatch):
    sure = lambda k, n, code: ("a", k, n, 9, code, 0.9)
    rows = [sure(1, 1, "en"), sure(1, 2, "fr"), ("a", 1, 3, 1, "de", 0.3), sure(2, 1, "fr"), sure(2, 2, "fr"), ("a", 3, 1, 2, "it", 0.4), sure(3, 2, "nl")]
    df = spark.createDataFrame(rows, "id string, text_key long, sentence_no int, words int, language_code string, confidence double")
    monkeypatch.setattr(language, "classified", lambda *_: (df, None))
    got = sorted((r.abstract_key, r.passage_no, r.first_sentence, r.last_sentence, r.language_code) for r in language.passages(spark, "").collect())
    assert got == [(1, 1, 1, 1, "en"), (1, 2, 2, 3, "fr"), (2, 1, 1, 2, "fr"), (3, 1, 1, 2, "nl")]


def test_spellings_of_abuse():
    assert abuse.normal_words("V3rm1n s c u m, nakkkked p.u.r.g.e fоol t**p 2020") == ["vermin", "scum", "naked", "purge", "fool", "t**p"]
    assert abuse.passages("One thing; another thing - third, and fourth") == [["one", "thing"], ["another", "thing"], ["third"], ["fourth"]]
    assert np.allclose(abuse.noisy_or(np.array([0.5, 0.5, 0.1]), np.array([0, 0, 2]), 3), [0.75, 0, 0.1])


def test_abuse_from_document_labels(spark):
    rnd = random.Random(4)
    neutral = [f"The {a} of the {b} was measured in {c}." for a in ("size", "value", "rate") for b in ("river", "cell", "court") for c in ("spring", "two phases", "all cases")]
    bad = ["You are a stupid fool.", "Get out, you filthy pig.", "Only an idiot writes such trash."]
    docs, labels = [], []
    for i in range(200):
        parts = [rnd.choice(neutral) for _ in range(4)]
        if i % 3 == 0:
            parts[rnd.randrange(4)] = rnd.choice(bad)
        docs.append((i, " ".join(parts)))
        labels.append((i, int(i % 3 == 0) if i % 15 else 1 - int(i % 3 == 0)))
    df = spark.createDataFrame(docs, "id long, text string")
    model = abuse.fit(df, spark.createDataFrame([*labels, (1, None), (None, 1)], "id long, label int"))
    test = spark.createDataFrame([(1, f"{neutral[0]} {bad[1]}"), (2, " ".join(neutral)), (3, None), (4, ""), (5, "Y0u are a st​upid f00l."), (1, neutral[1])], "id long, text string").withColumn("score", F.lit(9))
    got = [(r.id, r.flagged) for r in abuse.score(test, model).collect()]
    assert got == [(1, True), (2, False), (3, False), (4, False), (5, True), (1, False)]
    assert abuse.score(test, model).where("id = 1 and flagged").first()["worst_passage"] == 2
    assert not abuse.score(test, abuse.fit(df, spark.createDataFrame([(1, 1)], "id long, label int"))).where("flagged").count()


def test_subjects(spark):
    rnd = random.Random(3)
    terms = {"A1": "reef tide kelp coral plankton shoal".split(), "B2": "court clause treaty statute ruling verdict".split(), "C3": "lattice phonon spin magnet quantum vortex".split()}
    names = {"A1": "Marine life", "B2": "Law", "C3": "Solid state"}
    say = lambda c: f"We study how {rnd.choice(terms[c])} and {rnd.choice(terms[c])} respond to change."
    rows, labels = [], []
    for i in range(300):
        a, b = rnd.sample(list(terms), 2)
        double = i % 5 == 0
        rows.append((f"t{i}", f"Journal of {names[a]}", " ".join([say(a)] * 4 + [say(b) for _ in range(4 if double else i % 2)])))
        labels += [(f"t{i}", a if i % 7 else b), *([(f"t{i}", f" {b[0]} {b[1:]}")] if double and i % 2 else [])]
    df = spark.createDataFrame(rows, "id string, path string, text string")
    areas = spark.createDataFrame([(f"{c[0]} {c[1:]}", n) for c, n in names.items()], "code string, name string")
    model, listed = subjects.fit(df, spark.createDataFrame([*labels, (None, "A1"), ("t1", None)], "id string, code string"), areas)
    say_all = lambda *cs: " ".join(say(c) for c in cs)
    test = spark.createDataFrame([("one", "x", say_all("A1", "A1", "A1", "B2")), ("two", None, say_all("A1", "A1", "A1", "A1", "B2", "B2", "B2", "B2")), ("empty", "x", " "), ("null", "x", None)], "id string, path string, text string").withColumn("code", F.lit("clash"))
    got = {}
    for r in subjects.classify(test, model, listed).collect():
        got.setdefault(r.id, set()).add(r.code)
    assert got == {"one": {"A1"}, "two": {"A1", "B2"}}
    assert subjects.fit(df.where("false"), spark.createDataFrame([("t1", "A1")], "id string, code string"), areas)[0].further.min() > 0
    assert model.first.shape == model.further.shape == (3,) and len(set(model.further.round(6))) > 1  # a threshold for each area


def test_every_area_is_held_against_its_own_threshold(spark):
    says = ["reef tide.", "court clause.", "spin quantum."]
    model = subjects.Model(["A1", "B2", "C3"], np.zeros((1 << subjects.BITS, 3), np.float32), np.full(3, -20.0), np.zeros(3), np.array([1.5, 3.5, 1.5]))
    for k, sentence in enumerate(says):
        model.coefficients[word_ngrams(subjects.sentence_words(sentence), subjects.LONGEST, subjects.BITS).feature, k] = 40
    text = lambda *times: " ".join(" ".join([s] * n) for s, n in zip(says, times, strict=True))
    df = spark.createDataFrame([("third", "x", text(5, 3, 2)), ("second", "x", text(5, 4, 2)), ("one", "x", text(5, 3, 1))], "id string, path string, text string")
    got = sorted((r.id, r.code, r.first) for r in subjects.classify(df, model, {}).collect())
    assert got == [("one", "A1", True), ("second", "A1", True), ("second", "B2", False), ("third", "A1", True), ("third", "C3", False)]
    none = subjects.Model([], np.zeros((1 << subjects.BITS, 0), np.float32), np.zeros(0), np.zeros(0), np.zeros(0))
    assert not subjects.classify(df, none, {}).count()
