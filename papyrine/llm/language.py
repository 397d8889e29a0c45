"""The language of each document and of each passage in another language (problem 1).

A sparse multinomial logistic regression on TF-IDF character n-grams is trained on labelled texts with
follow-the-regularised-leader and L1 and L2 penalties; a temperature, fitted on texts kept apart, calibrates its
probabilities. It is applied to each sentence; sentences in a row of one language are one passage. All rows of
TF-IDF weights have one sum, so texts and sentences are alike.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from papyrine.llm.features import Ftrl, Sparse, char_ngrams, plain, sentences, softmax
from papyrine.session import checkpointed, read_table

#: The languages, and the names under which labels give them (lower case, without region).
NAMES = {
    "en": ["en", "eng", "english"],
    "sl": ["sl", "slv", "slovenian", "slovene"],
    "de": ["de", "deu", "ger", "german"],
    "fr": ["fr", "fra", "fre", "french"],
    "it": ["it", "ita", "italian"],
    "es": ["es", "spa", "spanish"],
    "pt": ["pt", "por", "portuguese"],
    "nl": ["nl", "nld", "dut", "dutch"],
}
LANGUAGES = list(NAMES)
BITS, LENGTHS = 16, (1, 2, 3)
#: The sum of each row's TF-IDF weights.
SCALE = 30
#: The most labelled texts the model is trained on (different ones, those with the least hashes, as many as possible of each label).
SAMPLE_TEXTS = 3200
#: The most sentences of a language a model is trained on, the learner's rate, and the rounds in which the shares of wrong
#: labels are fitted.
SENTENCES, ALPHA, NOISE_ROUNDS = 1500, 0.1, 6
#: A sentence has so many words at least, and counts for its language from this confidence on.
LEAST_WORDS, CONFIDENCE = 4, 0.7
_BRACKETS = re.compile(r"\([^()]*\)|\[[^\[\]]*\]|\{[^{}]*\}")
_LETTERS = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")


def language_code(label: Column) -> Column:
    """The lower-case two-letter code that a label names in any style ("EN", "en-GB", " English"), or null."""
    word = F.element_at(F.split(F.lower(F.trim(label)), "[-_]"), 1)
    code = F.when(F.lit(False), F.lit(""))
    for name, styles in NAMES.items():
        code = code.when(F.trim(word).isin(styles), F.lit(name))
    return code


def letters(sentence: str) -> str:
    """What of a sentence tells its language: lower-case words. Terms in brackets, digits and marks are left out, and
    capitalised words (names) that don't begin it, unless most words are capitalised."""
    if "(" in sentence or "[" in sentence or "{" in sentence:
        sentence = _BRACKETS.sub(" ", sentence)
    found = _LETTERS.findall(sentence)
    rest = [w for i, w in enumerate(found) if i == 0 or not w[0].isupper()]
    return " ".join(rest if len(rest) * 2 > len(found) else found).lower()


@dataclass
class Model:
    idf: np.ndarray
    coefficients: np.ndarray
    temperature: float

    def probabilities(self, texts: list[str]) -> np.ndarray:
        """Of each language, for texts as letters() gives them."""
        return softmax(char_ngrams(texts, LENGTHS, BITS).scaled(self.idf, SCALE).times(self.coefficients) / self.temperature)


def document_frequencies(texts: DataFrame) -> np.ndarray:
    """In how many rows of the column "text" each hashed n-gram occurs, over all rows. Each task sums its own rows first."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(1 << BITS, np.int64)
        for batch in batches:
            for at in range(0, len(batch), 200):
                rows = char_ngrams([letters(plain(t)) for t in batch["text"].iloc[at : at + 200]], LENGTHS, BITS)
                total += np.bincount(np.unique(rows.owner() << BITS | rows.feature) & (1 << BITS) - 1, minlength=1 << BITS)
        used = np.flatnonzero(total)
        yield pd.DataFrame({"feature": used.astype("int32"), "n": total[used]})

    rows = texts.select("text").mapInPandas(count, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).toPandas()  # at most 2 ** BITS rows
    out = np.zeros(1 << BITS)
    out[rows["feature"].to_numpy(int)] = rows["n"]
    return out


def _learn(rows: Sparse, y: np.ndarray, epochs: int = 4, batch: int = 64) -> np.ndarray:
    """Coefficients of the regression of y on the rows. Rare languages weigh as much as frequent ones, within a factor."""
    ftrl = Ftrl(1 << BITS, len(LANGUAGES), alpha=ALPHA, l1=1e-3, l2=1e-3)
    random = np.random.default_rng(5)
    counts = np.bincount(y, minlength=len(LANGUAGES))
    weight = np.clip((len(y) / max(1, (counts > 0).sum()) / np.maximum(1, counts)) ** 0.5, 0.5, 4.0)[y]
    for _ in range(epochs):
        order = random.permutation(len(y))
        for at in range(0, len(order), batch):
            own = order[at : at + batch]
            part = rows.take(own)
            error = softmax(part.times(ftrl.coefficients))
            error[np.arange(len(own)), y[own]] -= 1
            ftrl.step(part, error * weight[own, None])
    return ftrl.coefficients


def _temperature(scores: np.ndarray, y: np.ndarray) -> float:
    """The temperature under which the scores of held-out sentences best explain the labels y of their texts. A label may
    name another language than its sentence's, as often as it does for sentences of that language (fitted with the
    temperature), so wrong labels are no reason to doubt a sentence that is told clearly. A weak normal prior of its
    logarithm keeps it finite where no sentence is doubtful."""
    best, found = np.inf, 1.0
    count = len(LANGUAGES)
    for t in np.geomspace(0.05, 5, 40) if len(y) else []:
        own = softmax(scores / t)
        share = own
        for _ in range(NOISE_ROUNDS):
            seen = np.stack([np.bincount(y, share[:, z], count) for z in range(count)])
            named = (seen + 1 / count) / (seen.sum(axis=1, keepdims=True) + 1)  # language x label that sentences of it have
            joint = own * named[:, y].T
            share = joint / np.maximum(joint.sum(axis=1, keepdims=True), 1e-300)
        loss = -np.log(joint.sum(axis=1) + 1e-12).sum() + np.log(t) ** 2 / 2
        if loss < best:
            best, found = loss, float(t)
    return found


def train(texts: list[str], labels: list[str], frequencies: np.ndarray, documents: int) -> Model:
    """A model from whole texts whose labels may be wrong and which may hold passages in other languages.

    Every tenth text is kept apart for the temperature, with all of its sentences. Of the others each third is judged by a
    model of all sentences of the other two: a text stays if most of its sentences are given its label, and of these texts a
    sentence stays if it is given the label. So no model judges what it has learnt from. The last model is trained on what
    stays, at most SENTENCES sentences of a language. Without texts the model gives equal probabilities.
    """
    idf = np.log((1 + documents) / (1 + frequencies)) + 1
    parts = [[s for s in (letters(s) for s in sentences(plain(t))) if s.count(" ") + 1 >= LEAST_WORDS] for t in texts]
    text_of = np.repeat(np.arange(len(parts)), [len(x) for x in parts])
    if not len(text_of):
        return Model(idf, np.zeros((1 << BITS, len(LANGUAGES)), np.float32), 1.0)
    y = np.array([LANGUAGES.index(x) for x in labels], int)[text_of]
    rows = char_ngrams([s for own in parts for s in own], LENGTHS, BITS).scaled(idf, SCALE)
    apart, fold = text_of % 10 == 9, text_of % 3
    good = np.zeros(len(y), bool)
    for k in range(3):
        own, others = np.flatnonzero((fold == k) & ~apart), np.flatnonzero((fold != k) & ~apart)
        good[own] = rows.take(own).times(_learn(rows.take(_some(others, y)), y[_some(others, y)], epochs=2)).argmax(axis=1) == y[own]
    share = np.bincount(text_of, good, len(parts)) / np.maximum(1, np.bincount(text_of, minlength=len(parts)))
    kept = np.flatnonzero(good & (share[text_of] > 0.5) & ~apart)
    used = _some(kept if len(kept) else np.flatnonzero(~apart), y)
    coefficients = _learn(rows.take(used), y[used]) if len(used) else np.zeros((1 << BITS, len(LANGUAGES)))
    held = np.flatnonzero(apart)
    return Model(idf, coefficients.astype(np.float32), _temperature(rows.take(held).times(coefficients), y[held]))


def _some(rows: np.ndarray, y: np.ndarray) -> np.ndarray:
    """At most SENTENCES of rows of each language, those that come first in a fixed order."""
    rows = np.random.default_rng(9).permutation(rows)
    return rows[pd.Series(y[rows]).groupby(y[rows]).cumcount().to_numpy() < SENTENCES]


def fit(texts: DataFrame, labels: DataFrame) -> Model:
    """A model from (id, text) and (id, label); labels may be missing, wrong or double, in any style.

    All texts count for the document frequencies. The labelled sample is at most SAMPLE_TEXTS different texts, those with
    the least hashes: of each language an equal share at most. A text that many ids repeat counts once, else its copies would
    judge each other's labels and leave less of the sample to other texts.
    """
    frequencies = document_frequencies(texts)
    coded = labels.select("id", language_code(F.col("label")).alias("code")).where("code is not null and id is not null").distinct()
    keyed = texts.withColumn("key", F.xxhash64("text"))
    share = Window.partitionBy("code").orderBy("key")
    drawn = coded.join(keyed.select("id", "key"), "id").select("code", "key").distinct().withColumn("n", F.row_number().over(share)).where(F.col("n") <= SAMPLE_TEXTS // len(LANGUAGES))
    rows = keyed.join(F.broadcast(drawn), "key").groupBy("code", "n").agg(F.min("text").alias("text")).toPandas()  # at most SAMPLE_TEXTS rows
    rows = rows.sort_values(["code", "n"], ignore_index=True)
    documents = int(texts.count())
    order = np.random.default_rng(3).permutation(len(rows))
    return train([rows["text"].iloc[i] for i in order], [rows["code"].iloc[i] for i in order], frequencies, documents)


def classify(texts: DataFrame, model: Model) -> DataFrame:
    """(id, text_key, sentence_no, words, language_code, confidence) of each sentence of each text. text_key tells the texts
    of an id apart."""
    # 2 ** BITS numbers for each language, and as many; arrays, which executors read without this package
    shared = texts.sparkSession.sparkContext.broadcast((model.idf, model.coefficients, model.temperature))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = Model(*shared.value)
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.iloc[at : at + 500]
                own = [[letters(s) for s in sentences(plain(t))] for t in part["text"]]
                sizes = [len(x) for x in own]
                flat = [s for x in own for s in x]
                if not flat:
                    continue
                chances = model.probabilities(flat)
                best = chances.argmax(axis=1)
                yield pd.DataFrame(
                    {
                        "id": np.repeat(part["id"].to_numpy(), sizes),
                        "text_key": np.repeat(part["text_key"].to_numpy(), sizes),
                        "sentence_no": np.concatenate([np.arange(1, n + 1) for n in sizes]).astype("int32"),
                        "words": np.array([s.count(" ") + 1 if s else 0 for s in flat], "int32"),
                        "language_code": np.array(LANGUAGES, object)[best],
                        "confidence": chances.max(axis=1),
                    }
                )

    return texts.select("id", "text", F.xxhash64("text").alias("text_key")).mapInPandas(run, "id string, text_key long, sentence_no int, words int, language_code string, confidence double")


def abstracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, text): each article's different non-blank abstracts."""
    rows = read_table(spark, sf_dir, "crossref_publication_parsed").select(F.col("article_doi").alias("id"), F.col("article_abstract").alias("text"))
    return rows.where("id is not null and trim(text) <> ''").distinct()


def article_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "article_language").select(F.col("article_id").alias("id"), F.col("article_language").alias("label"))


def classified(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    texts, labels = checkpointed(abstracts(spark, sf_dir)), article_labels(spark, sf_dir)
    return classify(texts, fit(texts, labels)), labels


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The languages of whole sentences of an article's abstract that no label of the article names."""
    rows, labels = classified(spark, sf_dir)
    held = rows.where((F.col("words") >= LEAST_WORDS) & (F.col("confidence") >= CONFIDENCE)).select(F.col("id").alias("article_id"), "language_code").distinct()
    named = labels.select(F.col("id").alias("article_id"), language_code(F.col("label")).alias("language_code")).where("language_code is not null")
    return held.join(named, ["article_id", "language_code"], "left_anti")


def passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences in a row of one language, as (article_id, abstract_key, passage_no, first_sentence, last_sentence,
    language_code, confidence), numbered within each different abstract of an article. Sentences too short or uncertain to
    tell belong to the passage before them, or to the first one."""
    rows, _ = classified(spark, sf_dir)
    text = Window.partitionBy("id", "text_key")
    by = text.orderBy("sentence_no")
    sure = F.when((F.col("words") >= LEAST_WORDS) & (F.col("confidence") >= CONFIDENCE), F.col("language_code"))
    rows = rows.withColumn("own", F.coalesce(F.last(sure, ignorenulls=True).over(by), F.first(sure, ignorenulls=True).over(by.rowsBetween(Window.currentRow, Window.unboundedFollowing))))
    rows = rows.withColumn("new", F.when(F.lag("own").over(by).eqNullSafe(F.col("own")) & (F.col("sentence_no") > 1), 0).otherwise(1))
    rows = rows.withColumn("passage_no", F.sum("new").over(by).cast("int"))
    return rows.groupBy(F.col("id").alias("article_id"), F.col("text_key").alias("abstract_key"), "passage_no").agg(
        F.min("sentence_no").alias("first_sentence"), F.max("sentence_no").alias("last_sentence"), F.first("own").alias("language_code"), F.avg("confidence").alias("confidence")
    )


def queries() -> dict:
    return {"p1_found": found, "p1_passages": passages}


def oracle_sql() -> dict[str, str]:
    return {}
