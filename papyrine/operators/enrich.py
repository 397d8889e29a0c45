"""Enrichment: nearest labelled vectors, language, keywords and text vectors. The models behind them are seams; the defaults
here need no network and stay in the JVM where they can."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The most seed vectors that are broadcast at once; more are compared in blocks.
SEED_BLOCK = 20_000


def nearest_labels(vectors: DataFrame, key: str, vector: str, seeds: DataFrame, seed_key: str, seed_vector: str, label: str, k: int = 3) -> DataFrame:
    """For each vector the labels of the k seeds of highest cosine similarity, ranked from 1: (key, label, rank,
    similarity). Ties go by seed id, then label; a seed under two labels counts twice; zero, null and other-sized vectors
    have no neighbours. Vectors are compared a batch at a time with a matrix of seeds; nothing of the vectors' side is
    shuffled unless there are more than SEED_BLOCK seeds."""
    spark = vectors.sparkSession
    table = seeds.where(F.col(seed_vector).isNotNull()).select(F.col(seed_key).cast("string").alias("s"), F.col(label).cast("string").alias("l"), F.col(seed_vector).cast("array<double>").alias("v")).distinct()
    kind, label_kind = dict(vectors.dtypes)[key], dict(seeds.dtypes)[label]
    schema = f"k {kind}, label string, seed string, similarity double"
    result, pending = None, []

    def part(rows: list) -> DataFrame:
        rows = sorted(rows, key=lambda r: (r["s"], r["l"]))
        matrix = np.array([r["v"] for r in rows], float)
        length = np.linalg.norm(matrix, axis=1)
        good = length > 0
        shared = spark.sparkContext.broadcast((matrix[good] / length[good, None], np.array([r["l"] for r in rows], object)[good], np.array([r["s"] for r in rows], object)[good]))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            m, labels, names = shared.value
            for batch in batches:
                usable = batch["v"].map(lambda v: v is not None and len(v) == m.shape[1] and bool(np.any(v)) and bool(np.isfinite(v).all())).to_numpy(bool) if len(m) else np.zeros(len(batch), bool)
                if not usable.any():
                    continue
                v = np.stack(batch["v"][usable].to_numpy()).astype(float)
                s = (v / np.linalg.norm(v, axis=1, keepdims=True)) @ m.T
                top = np.argsort(-np.round(s, 12), axis=1, kind="stable")[:, :k]
                yield pd.DataFrame({"k": np.repeat(batch["k"][usable].to_numpy(), top.shape[1]), "label": labels[top].ravel(), "seed": names[top].ravel(), "similarity": np.take_along_axis(s, top, 1).ravel()})

        return vectors.select(F.col(key).alias("k"), F.col(vector).cast("array<double>").alias("v")).mapInPandas(run, schema)

    for row in table.toLocalIterator():
        pending.append(row)
        if len(pending) == SEED_BLOCK:
            result, pending = (part(pending) if result is None else result.unionByName(part(pending))), []
    if pending or result is None:
        result = (part(pending) if result is None else result.unionByName(part(pending))) if pending else spark.createDataFrame([], schema)
    rank = F.row_number().over(Window.partitionBy("k").orderBy(F.desc(F.round("similarity", 12)), "seed", "label"))
    return result.withColumn("rank", rank).where(F.col("rank") <= k).select(F.col("k").alias(key), F.col("label").cast(label_kind).alias(label), "rank", "similarity")


#: Frequent words of eight languages.
FREQUENT_WORDS = {
    "de": "und der die das nicht mit auf für von eine dass sich wurde ist den dem", "en": "the and of to in is that for with are was this from by which on", "es": "el los las que con del una para por se en como más sobre y este",
    "fr": "les des une dans est que pour nous cette sur avec aux par du et pas", "it": "il gli che della per con una sono nel questo alla dei di è non anche", "nl": "het een van en de is dat op zijn voor met wordt niet aan deze door", "pt": "os uma não para com dos que em mais por como foi ao das e nos", "sl": "je in se na za da so pri ki kot tudi ali smo bi ter po",
}


def frequent_word_language(text: Column) -> Column:
    """E5 without a trained model: the language of which the text has most frequent words, ties in order of codes; 'n/a' if it
    has none or is null. A pure expression: no Python runs."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}]+"), lambda w: w != "")
    among = lambda own: F.size(F.filter(words, lambda w: w.isin(own.split())))
    counts = {code: among(own) for code, own in FREQUENT_WORDS.items()}
    best = F.greatest(*counts.values())
    chain = F.when(best == 0, F.lit("n/a"))
    for code in sorted(counts):
        chain = chain.when(counts[code] == best, F.lit(code))
    return chain


def joined_text(separator: str, *columns: str) -> Column:
    """the columns joined, null as empty text."""
    return F.concat_ws(separator, *(F.coalesce(c, F.lit("")) for c in columns))


def hashed_vectors(df: DataFrame, key: str, text: str, size: int = 64) -> DataFrame:
    """E6 without a transformer: (key, vector): words counted into `size` places by hash and scaled to length one; null for
    text without words. Counted where the rows are before anything is shuffled."""
    words = df.select(key, F.explode(F.split(F.lower(text), r"[^\p{L}\p{N}]+")).alias("w")).where("w <> ''")
    places = words.groupBy(key, F.pmod(F.hash("w"), F.lit(size)).alias("p")).agg(F.count("*").cast("double").alias("n"))
    lists = places.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("p", "n"))).alias("m"), F.sqrt(F.sum(F.col("n") * F.col("n"))).alias("length"))  # at most `size` places
    vector = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0.0)) / F.col("length"))
    return df.select(key).distinct().join(lists.select(key, vector.alias("vector")), key, "left")


def embed(df: DataFrame, text: str, model: Callable[[list[str]], np.ndarray], batch: int = 64) -> DataFrame:
    """The seam for a real model: model(texts) gives a matrix, called with at most `batch` texts; null texts get null."""

    @F.pandas_udf("array<double>")
    def run(texts: pd.Series) -> pd.Series:
        out = pd.Series([None] * len(texts), dtype=object)
        at = np.flatnonzero(texts.notna().to_numpy())
        for some in np.array_split(at, max(1, -(-len(at) // batch))):
            if len(some):
                for i, row in zip(some, model(texts.iloc[some].tolist()), strict=True):
                    out.iloc[i] = [float(x) for x in row]
        return out

    return df.withColumn("embedding", run(F.col(text)))


def top_terms(df: DataFrame, key: str, text: str, k: int = 5) -> DataFrame:
    """E7 without a language model: (key, keywords): each text's k words of highest TF-IDF (over four letters; ties by word).
    Counts are over all rows; texts without such words have an empty list."""
    words = df.select(key, F.explode(F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}{5,})"), 1)).alias("w")).groupBy(key, "w").agg(F.count("*").alias("tf"))
    weight = words.join(words.groupBy("w").agg(F.count("*").alias("df")), "w").crossJoin(F.broadcast(df.agg(F.countDistinct(key).alias("n"))))  # the count is one row
    ranked = weight.withColumn("s", F.col("tf") * F.log(F.col("n") / F.col("df"))).withColumn("r", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("s"), "w"))).where(F.col("r") <= k)
    lists = ranked.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("r", "w"))), lambda x: x["w"]).alias("keywords"))  # at most k words
    return df.select(key).distinct().join(lists, key, "left").withColumn("keywords", F.coalesce("keywords", F.array().cast("array<string>")))


def batches_of(rows: DataFrame, size: int) -> int:
    """How many batches of a size the rows make."""
    return -(-rows.count() // size)


def next_batch(rows: DataFrame, done: DataFrame, key: str, date: str, size: int) -> DataFrame:
    """The oldest `size` keys not done yet, with all their rows."""
    open_keys = rows.join(done.select(key).distinct(), key, "left_anti").groupBy(key).agg(F.min(date).alias("_d")).orderBy("_d", key).limit(size)
    return rows.join(open_keys.select(key), key, "left_semi")
