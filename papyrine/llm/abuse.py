"""Abusive, hateful or sexual content (problem 9) by multiple-instance learning.

A document is a bag of passages: sentences, or clauses of them. A linear model scores each; a document's score is the
noisy-or of their probabilities, so one offending passage is enough. The model learns from labels of documents alone: the gradient of the
document's loss shares the blame among its passages. Afterwards the passages' own probabilities locate the offence.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyrine.llm.features import COMBINING, Ftrl, Sparse, char_ngrams, plain, sentences, word_ngrams
from papyrine.session import bounded_sample, read_table

BITS = 18
#: The most labelled documents the model is trained on (those with the least hashes of their id).
SAMPLE_DOCUMENTS = 4000
#: A feature counts if so many documents of the sample have it.
LEAST_DOCUMENTS = 2
FOLDS, EPOCHS, BATCH = 4, 8, 32

_NOTHING = dict.fromkeys([0xAD, 0x34F, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF])
#: Letters of other scripts and digits or signs that stand for Latin letters.
_LOOKALIKE = str.maketrans("аеорсухіјѕԁһοανρικτвкмнт", "aeopcyxijsdhoavpiktbkmht")
_LETTERS = {**COMBINING, **_LOOKALIKE, **_NOTHING}
_SIGNS = str.maketrans("013457@$!", "oieastasi")
_MIXED = re.compile(r"(?<![\w@$])(?=[\w@$!]*[a-z])(?=[\w@$!]*[\d@$!])[\w@$!]*[\w@$]")
_SIGN = re.compile(r"[\d@$!]")
_SPACED = re.compile(r"(?<!\w)(?:\w[ .\-_*]){3,}\w(?!\w)")
_REPEATED = re.compile(r"([a-z])\1{2,}")
_CLAUSE = re.compile(r";\s+|\s+[-–—]\s+|,\s+and\s+")
_WORDS = re.compile(r"[^\W\d_]+(?:\*+[^\W\d_]*)*")


def normal_words(sentence: str) -> list[str]:
    """The words of a sentence in any spelling: case, accents, look-alikes, letters set apart, signs for letters and
    repeated letters are undone. Numbers are left out; a word with masked letters keeps its asterisks."""
    s = sentence.lower()
    if not s.isascii():
        s = unicodedata.normalize("NFKD", s).lower().translate(_LETTERS)
    s = _SPACED.sub(lambda m: re.sub(r"[ .\-_*]", "", m[0]), s)
    if _SIGN.search(s):
        s = _MIXED.sub(lambda m: m[0].translate(_SIGNS) if len(m[0]) > 2 and sum(c.isalpha() for c in m[0]) * 2 >= len(m[0]) - 1 and not m[0][-1].isdigit() else m[0], s)
    s = _REPEATED.sub(r"\1", s)
    return _WORDS.findall(s)


def passages(text: str) -> list[list[str]]:
    """The words of each passage of a plain text: sentences, cut where a clause is loosely joined. None is empty."""
    return [words for s in sentences(text) for part in _CLAUSE.split(s) if (words := normal_words(part))]


def features(texts: list[list[str]]) -> Sparse:
    """The words, word pairs and character n-grams of each sentence."""
    words = word_ngrams(texts, 2, BITS - 1)
    chars = char_ngrams([" ".join(own) for own in texts], (4,), BITS - 1)
    owner = np.concatenate([words.owner(), chars.owner()])
    order = np.argsort(owner, kind="stable")
    feature = np.concatenate([words.feature, chars.feature + (1 << BITS - 1)])[order]
    return Sparse(feature, np.ones(len(feature), np.float32), np.bincount(owner, minlength=len(texts)))


@dataclass
class Model:
    coefficients: np.ndarray
    bias: float
    threshold: float

    def sentence_probabilities(self, rows: Sparse) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(rows.times(self.coefficients)[:, 0] + self.bias, -30, 30)))


def noisy_or(chances: np.ndarray, bag: np.ndarray, bags: int) -> np.ndarray:
    """1 - product of (1 - chance) of each bag; an empty bag gives 0."""
    return 1 - np.exp(np.bincount(bag, np.log(np.maximum(1 - chances, 1e-12)), bags))


def _learn(rows: Sparse, bag: np.ndarray, y: np.ndarray, chosen: np.ndarray, known: np.ndarray) -> Model:
    """A model from the chosen bags. known: features that count."""
    ftrl = Ftrl(1 << BITS, 1, alpha=0.2, l1=0.03, l2=0.2)
    bias, seen = -3.0, 1.0
    begin, end = np.searchsorted(bag, np.arange(len(y))), np.searchsorted(bag, np.arange(len(y)), side="right")
    rows = Sparse(rows.feature, rows.weight * known[rows.feature], rows.sizes)
    random = np.random.default_rng(4)
    for _ in range(EPOCHS):
        order = random.permutation(chosen)
        for at in range(0, len(order), BATCH):
            own = order[at : at + BATCH]
            lines = np.concatenate([np.arange(begin[i], end[i]) for i in own])
            if not len(lines):
                continue
            number = np.repeat(np.arange(len(own)), end[own] - begin[own])
            part = rows.take(lines)
            chance = Model(ftrl.coefficients, bias, 0.5).sentence_probabilities(part)
            whole = np.clip(noisy_or(chance, number, len(own)), 1e-6, 1 - 1e-6)
            # loss of label y: -y log P - (1 - y) log(1 - P); d log(1 - P) / d score = -chance
            error = np.where(y[own][number] == 1, -(1 - whole[number]) / whole[number], 1.0) * chance
            ftrl.step(part, error[:, None])
            slope = error.sum() / len(own)
            seen += slope**2
            bias -= 0.3 * slope / np.sqrt(seen)
    return Model(ftrl.coefficients, bias, 0.5)


def train(texts: list[str], labels: list[int]) -> Model:
    """A model from whole documents and labels of which some are wrong.

    Each fold is judged by a model of the others. A document whose label its judge firmly rejects is left out of the last
    model; the threshold is the one that best agrees with the remaining labels. Without both labels nothing is flagged.
    """
    y = np.array(labels, int)
    none = Model(np.zeros((1 << BITS, 1), np.float32), -9.0, 0.5)
    if len(set(y.tolist())) < 2:
        return none
    parts = [passages(plain(t)) for t in texts]
    rows = features([s for own in parts for s in own])
    bag = np.repeat(np.arange(len(y)), [len(own) for own in parts])
    pairs = np.unique(bag[rows.owner()].astype(np.int64) << BITS | rows.feature)
    known = np.bincount(pairs & (1 << BITS) - 1, minlength=1 << BITS) >= LEAST_DOCUMENTS
    judged = np.zeros(len(y))
    fold = np.arange(len(y)) % FOLDS
    for k in range(FOLDS):
        judge = _learn(rows, bag, y, np.flatnonzero(fold != k), known)
        judged += np.where(fold == k, noisy_or(judge.sentence_probabilities(rows), bag, len(y)), 0)
    right = np.where(y == 1, judged > 0.2, judged < 0.8)
    model = _learn(rows, bag, y, np.flatnonzero(right), known)
    scores, truth = judged[right], y[right]
    best = max(np.arange(0.3, 0.71, 0.05), key=lambda t: (2 * ((scores >= t) & (truth == 1)).sum() / max(1, (scores >= t).sum() + truth.sum()), -abs(t - 0.5)))
    return Model(model.coefficients.astype(np.float32), model.bias, float(best))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """From documents (id, text) and labels (id, label 0 or 1, perhaps null, double or contradictory: the mean decides, and
    a draw counts for nothing). At most SAMPLE_DOCUMENTS documents are used."""
    agreed = labels.where("id is not null and label is not null").groupBy("id").agg(F.avg("label").alias("m")).where("m <> 0.5").select("id", (F.col("m") > 0.5).cast("int").alias("label"))
    chosen = bounded_sample(agreed, "id", SAMPLE_DOCUMENTS, agreed.count())
    rows = docs.where("text is not null").join(chosen, "id").orderBy(F.xxhash64("id"), "id", "text").limit(SAMPLE_DOCUMENTS).toPandas()
    return train(rows["text"].tolist(), rows["label"].tolist())


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(id, source if docs have one, score, flagged, worst_passage, worst_score) for every row: null, empty and blank texts
    score 0 and have no worst passage. No shuffle; the model (2 ** BITS numbers, plain arrays) is sent to the tasks."""
    shared = docs.sparkSession.sparkContext.broadcast((model.coefficients, model.bias, model.threshold))
    carried = [c for c in ("id", "source") if c in docs.columns]
    kinds = dict(docs.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = Model(*shared.value)
        for batch in batches:
            for at in range(0, len(batch), 300):
                part = batch.iloc[at : at + 300]
                own = [passages(plain(t)) for t in part["text"]]
                flat = [s for x in own for s in x]
                bag = np.repeat(np.arange(len(part)), [len(x) for x in own])
                chance = model.sentence_probabilities(features(flat)) if flat else np.zeros(0)
                whole = noisy_or(chance, bag, len(part)) if flat else np.zeros(len(part))
                begin = np.searchsorted(bag, np.arange(len(part)))
                worst = [int(chance[a : a + len(x)].argmax()) + 1 if x else None for a, x in zip(begin.tolist(), own, strict=True)]
                high = [float(chance[a : a + len(x)].max()) if x else None for a, x in zip(begin.tolist(), own, strict=True)]
                yield pd.DataFrame({**{c: part[c].to_numpy() for c in carried}, "score": whole, "flagged": whole >= model.threshold, "worst_passage": pd.array(worst, "Int32"), "worst_score": pd.array(high, "Float64")})

    return docs.select(*carried, "text").mapInPandas(run, ", ".join(f"{c} {kinds[c]}" for c in carried) + ", score double, flagged boolean, worst_passage int, worst_score double")


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "source", "text")
    labels = read_table(spark, sf_dir, "doc_label").select(F.col("doc_id").alias("id"), F.col("is_unwanted").alias("label"))
    return score(docs, fit(docs, labels))


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir).where("flagged").select(F.col("id").alias("doc_id")).distinct()


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir).drop("source").withColumnRenamed("id", "doc_id")


def source_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source: documents, flagged documents, their rate, and the mean score. A null source is one of its own."""
    return scored(spark, sf_dir).groupBy("source").agg(F.count("*").alias("documents"), F.sum(F.col("flagged").cast("long")).alias("flagged"), F.avg(F.col("flagged").cast("double")).alias("rate"), F.avg("score").alias("mean_score"))


def queries() -> dict:
    return {"p9_found": found, "p9_scores": scores, "p9_source_rates": source_rates}


def oracle_sql() -> dict[str, str]:
    return {}
