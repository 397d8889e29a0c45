"""Subject areas of documents (problem 4): one-versus-rest linear classifiers on hashed word n-grams.

They are trained on sentences with weak labels: the area that the document's section path (here its journal) names, and
the areas that partial and partly wrong label rows give. Applied to a text, each sentence spreads one unit of evidence over
the areas; a text's evidence for an area is the sum over its sentences. What evidence makes an area is calibrated on the
label rows: they name a true area at some rate, and any other area at a much lower one, so the rate at which an area is
named, as a function of the evidence, tells the share of true areas; the threshold is where that share passes one half.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from papyrine.llm.features import Ftrl, Sparse, plain, sentences, word_ngrams
from papyrine.session import bounded_sample, checkpointed, read_table

BITS, LONGEST = 17, 2
#: The most documents the classifiers and thresholds are fitted on (those with the least hashes of their id).
SAMPLE_DOCUMENTS = 4000
#: Evidence that a section path adds to the area that it names, in sentences.
PATH_EVIDENCE = 1.0
#: As many texts of an area as weigh as much as the threshold of all areas.
PRIOR_TEXTS = 100
#: More evidence than one sentence gives, with the little that all others add.
ONE_SENTENCE = 1.1
#: As many areas a text deals with at most, by the definition of the problem.
MOST_AREAS = 2
EPOCHS, BATCH = 4, 256
_WORD = re.compile(r"[^\W\d_]+(?:[-'’][^\W\d_]+)*")


def area_code(code: Column) -> Column:
    """A code without the blanks in it; null if nothing is left."""
    return F.nullif(F.regexp_replace(code, r"\s+", ""), F.lit(""))


def sentence_words(text: str) -> list[list[str]]:
    """The words of each sentence; capitalised words (names) within a sentence are left out unless most are capitalised."""
    found = []
    for s in sentences(plain(text)):
        words = _WORD.findall(s)
        rest = [w for i, w in enumerate(words) if i == 0 or not w[0].isupper()]
        if words:
            found.append([w.lower() for w in (rest if len(rest) * 2 > len(words) else words)])
    return found


@dataclass
class Model:
    areas: list[str]
    coefficients: np.ndarray
    bias: np.ndarray
    #: Of each area: the least evidence of it as a text's first area, and as a further one.
    first: np.ndarray
    further: np.ndarray

    def chances(self, rows: Sparse) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(rows.times(self.coefficients) + self.bias, -30, 30)))

    def evidence(self, texts: list[str], paths: list[int]) -> np.ndarray:
        """Texts x areas. paths: the number of the area that the section path names, or -1."""
        parts = [sentence_words(t) for t in texts]
        flat = [s for own in parts for s in own]
        out = np.zeros((len(texts), len(self.areas)))
        if flat:
            chance = self.chances(word_ngrams(flat, LONGEST, BITS))
            chance /= np.maximum(1, chance.sum(axis=1, keepdims=True))
            np.add.at(out, np.repeat(np.arange(len(texts)), [len(own) for own in parts]), chance)
        place = np.array(paths, int)
        out[np.flatnonzero(place >= 0), place[place >= 0]] += PATH_EVIDENCE
        return out


def train(texts: list[str], paths: list[int], named: list[set[int]], areas: list[str]) -> Model:
    """From texts, the areas that their paths name (-1: none) and those that label rows name."""
    model = Model(areas, np.zeros((1 << BITS, len(areas)), np.float32), np.full(len(areas), -3.0), np.zeros(len(areas)), np.full(len(areas), 1.5))
    parts = [sentence_words(t) for t in texts]
    flat = [s for own in parts for s in own]
    if not flat:
        return model
    owner = np.repeat(np.arange(len(texts)), [len(own) for own in parts])
    target = np.zeros((len(texts), len(areas)))
    for i, (path, labels) in enumerate(zip(paths, named, strict=True)):
        own = {path} if path >= 0 else labels  # a path is better than a label row
        target[i, list(own)] = 1
    rows, target = word_ngrams(flat, LONGEST, BITS), target[owner]
    ftrl = Ftrl(1 << BITS, len(areas), alpha=0.2, l1=0.05, l2=0.2)
    random = np.random.default_rng(6)
    for _ in range(EPOCHS):
        order = random.permutation(len(flat))
        for at in range(0, len(order), BATCH):
            own = order[at : at + BATCH]
            part = rows.take(own)
            model.coefficients = ftrl.coefficients
            error = model.chances(part) - target[own]
            ftrl.step(part, error / 4)
            model.bias -= 0.05 * error.mean(axis=0)
    model.coefficients = ftrl.coefficients.astype(np.float32)
    model.first, model.further = thresholds(model.evidence(texts, paths), named)
    return model


def thresholds(evidence: np.ndarray, named: list[set[int]]) -> tuple[np.ndarray, np.ndarray]:
    """For each area the evidence from which it is more likely true than not, as a text's first area and as a further one
    (see the module's text).

    Label rows are partial, so an area counts as likely from where they name it half as often above their rate by chance
    as where evidence is strongest. Each area has a threshold of its own from its own texts, drawn towards that of all areas
    by as many texts as PRIOR_TEXTS.
    """
    areas = evidence.shape[1]
    labelled = [i for i, labels in enumerate(named) if labels]
    if not labelled:
        return np.zeros(areas), np.full(areas, 1.5)
    values = evidence[labelled]
    hit = np.array([[a in named[i] for a in range(areas)] for i in labelled])
    leads = np.zeros(values.shape, bool)
    leads[np.arange(len(values)), values.argmax(axis=1)] = True
    rest, rest_hit = values[~leads], hit[~leads]
    low = rest_hit[rest < 0.25].mean() if (rest < 0.25).any() else 0.0
    strong = np.sort(rest)[::-1][: max(20, int(0.004 * len(rest)))].min()
    wanted = (low + rest_hit[rest >= strong].mean()) / 2
    found = []
    for some in (leads, ~leads):
        start = 0.5 if some is not leads else 0.0
        overall = _edge(values[some], hit[some], wanted, start, float(strong) if start else 0.0)
        own = np.full(areas, overall)
        for a in range(areas):
            mine = some[:, a] & (values[:, a] >= 0.25)
            n = int(mine.sum())
            own[a] = (n * _edge(values[mine, a], hit[mine, a], wanted, start, overall) + PRIOR_TEXTS * overall) / (n + PRIOR_TEXTS)
        found.append(own)
    return found[0], np.maximum(found[1], ONE_SENTENCE)  # a single sentence on another field makes no area


def _edge(values: np.ndarray, hit: np.ndarray, wanted: float, start: float, default: float) -> float:
    """The least evidence from start on around which labels name the area as often as wanted; the default if there is none,
    or too few values below it to tell otherwise."""
    for edge in np.arange(start, 4.0, 0.1):
        window = (values >= edge) & (values < edge + 0.4)
        if window.sum() >= 10 and hit[window].mean() >= wanted:
            # in a gap without any values the middle is as good as its end
            below, above = values[values < edge], values[values >= edge]
            if len(below) < 10:
                return default
            return float((below.max() + above.min()) / 2) if above.min() - below.max() > 0.2 else float(edge)
    return default


def fit(texts: DataFrame, labels: DataFrame, areas: DataFrame) -> tuple[Model, dict[str, str]]:
    """A model and the areas' names, from texts (id, path, text), label rows (id, code) and the list of areas (code, name)."""
    listed = {r["code"]: r["name"] for r in areas.where("code is not null").groupBy(area_code(F.col("code")).alias("code")).agg(F.min("name").alias("name")).collect()}  # the list of areas is small by nature
    codes = sorted(listed)
    named = labels.select("id", area_code(F.col("code")).alias("code")).where(F.col("code").isin(codes)).groupBy("id").agg(F.collect_set("code").alias("codes"))  # at most all codes
    sample = bounded_sample(texts.where("text is not null"), "id", SAMPLE_DOCUMENTS, texts.count())
    rows = sample.join(named, "id", "left").orderBy("id", "text").toPandas()
    rows = rows.sample(frac=1, random_state=1)
    number = {code: i for i, code in enumerate(codes)}
    model = train(
        rows["text"].tolist(),
        [path_area(p, listed, number) for p in rows["path"]],
        [{number[c] for c in own} if own is not None else set() for own in rows["codes"]],
        codes,
    )
    return model, listed


def path_area(path: str | None, names: dict[str, str], number: dict[str, int]) -> int:
    """The number of the area whose name is in a section path (the longest such name), or -1."""
    lower = (path or "").lower()
    found = [(len(name), code) for code, name in names.items() if name and name.lower() in lower]
    return number[max(found)[1]] if found else -1


def classify(texts: DataFrame, model: Model, names: dict[str, str]) -> DataFrame:
    """(id, code, evidence, first) of the one or two areas of each text (id, path, text): of the areas that reach their
    thresholds those with most evidence. Blank and null texts have none."""
    # 2 ** BITS numbers for each area; plain arrays, which executors read without this package
    shared = texts.sparkSession.sparkContext.broadcast((model.areas, model.coefficients, model.bias, model.first, model.further, names))
    kind = dict(texts.dtypes)["id"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        *own, names = shared.value
        model = Model(*own)
        number = {code: i for i, code in enumerate(model.areas)}
        codes = np.array(model.areas, object)
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.iloc[at : at + 500]
                paths = [path_area(p, names, number) for p in part["path"]]
                value = model.evidence(part["text"].tolist(), paths)
                top = np.argsort(-value, axis=1, kind="stable")[:, :1]
                least = np.tile(model.further, (len(part), 1))
                np.put_along_axis(least, top, model.first[top], 1)
                # every area is held against its own threshold before the strongest are taken
                value = np.where(value >= least, value, 0)
                order = np.argsort(-value, axis=1, kind="stable")[:, :MOST_AREAS]
                best = np.take_along_axis(value, order, 1)
                ids = part["id"].to_numpy()
                for place in range(order.shape[1]):
                    keep = best[:, place] > 0
                    yield pd.DataFrame({"id": ids[keep], "code": codes[order[keep, place]], "evidence": best[keep, place], "first": order[keep, place] == top[keep, 0]})

    return texts.where("trim(text) <> ''").select("id", "path", "text").mapInPandas(run, f"id {kind}, code string, evidence double, first boolean")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, path, text): each article's different non-blank abstracts, with its journal."""
    rows = read_table(spark, sf_dir, "elsevier_publication_parsed").select(F.col("article_id").alias("id"), F.col("article_journal").alias("path"), F.col("article_abstract").alias("text"))
    return rows.where("id is not null and trim(text) <> ''").groupBy("id", "text").agg(F.max("path").alias("path"))


def classified(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    texts = checkpointed(articles(spark, sf_dir))
    labels = read_table(spark, sf_dir, "article_research_area").select(F.col("article_id").alias("id"), F.col("research_area_code").alias("code"))
    areas = read_table(spark, sf_dir, "cerif_research_area").select(F.col("research_area_code").alias("code"), F.col("research_area_name").alias("name"))
    return classify(texts, *fit(texts, labels, areas)), labels


def spelled(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    """rows with their code as the list of areas spells it."""
    areas = read_table(spark, sf_dir, "cerif_research_area").groupBy(area_code(F.col("research_area_code")).alias("code")).agg(F.min("research_area_code").alias("research_area_code"))
    return rows.join(areas, "code")


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, labels = classified(spark, sf_dir)
    named = labels.select("id", area_code(F.col("code")).alias("code")).where("code is not null and id is not null")
    return spelled(spark, sf_dir, rows.join(named, ["id", "code"], "left_anti")).select(F.col("id").alias("article_id"), "research_area_code").distinct()


def areas_of_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = classified(spark, sf_dir)
    return spelled(spark, sf_dir, rows).select(F.col("id").alias("article_id"), "research_area_code", "evidence", "first")


def area_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles of each area, an article of two areas counting half for each, and the areas' shares of the corpus."""
    rows = areas_of_articles(spark, sf_dir).groupBy("article_id", "research_area_code").agg(F.max("evidence").alias("evidence"))
    each = rows.join(rows.groupBy("article_id").agg(F.count("*").alias("n")), "article_id").groupBy("research_area_code").agg(F.count("*").alias("articles"), F.sum(1 / F.col("n")).alias("weight"))
    return each.crossJoin(F.broadcast(each.agg(F.sum("weight").alias("total")))).select("research_area_code", "articles", (F.col("weight") / F.col("total")).alias("share"))  # the total is one row


def queries() -> dict:
    return {"p4_found": found, "p4_areas": areas_of_articles, "p4_area_shares": area_shares}


def oracle_sql() -> dict[str, str]:
    return {}
