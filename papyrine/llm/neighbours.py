"""The most similar vectors of every vector (problem 3): a vantage-point tree per shard, searched with triangle-inequality
pruning that a factor relaxes. Factor one restores exact search.

Vectors are scaled to length one, so cosine similarity s and distance sqrt(2 - 2 s) have the same order. Centres fitted on
a bounded sample cut the space into cells; every vector is indexed, in a shard of its nearest centre's cell (a cell with
many vectors has several shards). First each shard answers for its own vectors. The distance to the k-th best found so
far then bounds what can be better elsewhere: a cell, and inside a shard a branch of the tree, is left out if
factor * (least distance that the triangle inequality allows) is at least that bound.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from papyrine.session import bounded_sample, checkpointed, read_table

#: Vectors a shard is made for, rows on which the centres are fitted, and the most cells there are.
SHARD_ROWS, SAMPLE_ROWS, MOST_CELLS = 4000, 20_000, 2048
#: Queries that one task answers against one shard.
QUERY_ROWS = 50_000
LEAF = 64
#: Pruning factor: 1 is exact; more prunes more.
FACTOR = 3.0


class VantageTree:
    """A vantage-point tree over the rows of a matrix of unit vectors."""

    def __init__(self, data: np.ndarray, leaf: int = LEAF) -> None:
        self.data, self.leaf = data, leaf
        self.nodes: list[tuple] = []  # (vantage row, inner, outer, limits of the distances in both) or (None, rows)
        random = np.random.default_rng(7)
        todo: list[tuple[np.ndarray, int, int]] = [(np.arange(len(data)), -1, 0)]
        while todo:
            rows, parent, side = todo.pop()
            number = len(self.nodes)
            if parent >= 0:
                self.nodes[parent][1][side] = number
            split = self._split(rows, random) if len(rows) > leaf else None
            if split is None:
                self.nodes.append((None, rows))
                continue
            vantage, distance, middle = split
            inside = distance <= middle
            limits = [(distance[x].min(), distance[x].max()) for x in (inside, ~inside)]
            self.nodes.append((vantage, [0, 0], middle, limits))
            todo += [(rows[inside], number, 0), (rows[~inside], number, 1)]

    def _split(self, rows: np.ndarray, random: np.random.Generator) -> tuple[int, np.ndarray, float] | None:
        """The vantage point, of a few, whose distances spread most; None if all rows are in one place."""
        probe = rows if len(rows) <= 256 else random.choice(rows, 256, replace=False)
        tried = random.choice(rows, min(8, len(rows)), replace=False)
        spread = distances(self.data[tried], self.data[probe]).std(axis=1)
        vantage = int(tried[spread.argmax()])
        distance = distances(self.data[vantage : vantage + 1], self.data[rows])[0]
        middle = float(np.median(distance))
        if not (distance > middle).any():
            middle = float((distance.min() + distance.max()) / 2)
        return (vantage, distance, middle) if (distance > middle).any() and (distance <= middle).any() else None

    def search(self, queries: np.ndarray, best: np.ndarray, rows: np.ndarray, factor: float, own: np.ndarray | None = None) -> None:
        """Improves best (similarities, descending) and rows (their rows here) of each query in place. own: each query's
        row here, which isn't a neighbour."""
        home = np.zeros(len(queries), np.int64)
        todo = [(0, np.arange(len(queries)))]
        while todo:  # first the leaf where the query itself would be
            number, active = todo.pop()
            node = self.nodes[number]
            if node[0] is None:
                home[active] = number
                self._scan(node[1], active, queries, best, rows, own)
                continue
            inside = distances(queries[active], self.data[node[0]][None])[:, 0] <= node[2]
            todo += [(child, part) for child, part in zip(node[1], (active[inside], active[~inside]), strict=True) if len(part)]
        todo = [(0, np.arange(len(queries)))]
        while todo:  # then all others that can't be left out
            number, active = todo.pop()
            node = self.nodes[number]
            if node[0] is None:
                if len(active := active[home[active] != number]):
                    self._scan(node[1], active, queries, best, rows, own)
                continue
            distance = distances(queries[active], self.data[node[0]][None])[:, 0]
            bound = np.sqrt(np.maximum(0, 2 - 2 * best[active, -1]))
            for child, (low, high) in zip(node[1], node[3], strict=True):
                part = active[factor * np.maximum(distance - high, low - distance) < bound]
                if len(part):
                    todo.append((child, part))

    def _scan(self, leaf: np.ndarray, active: np.ndarray, queries: np.ndarray, best: np.ndarray, rows: np.ndarray, own: np.ndarray | None) -> None:
        similar = queries[active] @ self.data[leaf].T
        if own is not None:
            similar[own[active][:, None] == leaf[None]] = -9
        better = np.flatnonzero(similar.max(axis=1) > best[active, -1])
        if not len(better):
            return
        active, k = active[better], best.shape[1]
        both = np.concatenate([best[active], similar[better]], axis=1)
        names = np.concatenate([rows[active], np.broadcast_to(leaf, (len(active), len(leaf)))], axis=1)
        top = np.argpartition(-both, k - 1, axis=1)[:, :k]
        both = np.take_along_axis(both, top, 1)
        order = np.argsort(-both, axis=1, kind="stable")
        best[active] = np.take_along_axis(both, order, 1)
        rows[active] = np.take_along_axis(np.take_along_axis(names, top, 1), order, 1)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * (a @ b.T)))


def fit_centres(sample: np.ndarray, number: int, rounds: int = 8) -> np.ndarray:
    """Unit centres of `number` cells, by spherical k-means."""
    random = np.random.default_rng(11)
    centres = sample[np.sort(random.choice(len(sample), number, replace=False))].copy()
    for _ in range(rounds):
        nearest = (sample @ centres.T).argmax(axis=1)
        total = np.zeros_like(centres)
        np.add.at(total, nearest, sample)
        length = np.linalg.norm(total, axis=1, keepdims=True)
        centres = np.where(length > 1e-6, total / np.maximum(length, 1e-6), centres).astype(np.float32)
    return centres


def clean_vectors(df: DataFrame, key: str, vector: str, size: int) -> DataFrame:
    """(id, vec): one row per key. Vectors that are null, not of the given length, zero or with a NaN or infinity take no
    part, nor do null keys. Of several vectors of a key the greatest counts. vec is the unit vector as float32 bytes."""

    def unit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                matrix = np.stack(batch["v"].to_numpy()).astype(np.float64)
                matrix /= np.abs(matrix).max(axis=1, keepdims=True)  # no overflow of very long vectors
                matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
                yield pd.DataFrame({"id": batch["id"], "vec": [row.tobytes() for row in matrix.astype(np.float32)]})

    v = F.col(vector).cast("array<double>")
    usable = (F.size(v) == size) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    kept = df.where(F.col(key).isNotNull() & v.isNotNull()).where(usable).select(F.col(key).cast("string").alias("id"), v.alias("v"))
    return kept.groupBy("id").agg(F.max("v").alias("v")).mapInPandas(unit, "id string, vec binary")


def _matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.float32).reshape(len(column), -1) if len(column) else np.zeros((0, 1), np.float32)


def nearest(df: DataFrame, key: str, vector: str, size: int, k: int = 5, factor: float = FACTOR) -> DataFrame:
    """(id, neighbour, similarity): the k most similar keys of each key (fewer if the table has fewer).

    Exact copies of a vector under more than k + 1 keys: the first k + 1 keys are indexed, and answer for all others (their
    similarity is 1), so a vector that a third of the rows share costs no more than the rows it has. Ties are cut by key
    order among copies, else by chance. At most SAMPLE_ROWS vectors are used to fit centres; all are indexed and asked.
    """
    spark = df.sparkSession
    vectors = clean_vectors(df, key, vector, size)
    vectors = checkpointed(vectors.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(64))))
    heads = vectors
    for group in (["vec", "salt"], ["vec"]):  # a limit of k + 1 in each group, which Spark applies before it shuffles
        heads = heads.withColumn("copy", F.row_number().over(Window.partitionBy(*group).orderBy("id"))).where(F.col("copy") <= k + 1)
    heads = checkpointed(heads.select("id", "vec", "copy"))
    total = heads.count()
    empty = spark.createDataFrame([], "id string, neighbour string, similarity double")
    if total < 2:
        return empty
    number = max(1, min(MOST_CELLS, round(total / SHARD_ROWS)))
    sample = bounded_sample(heads.select("id", "vec"), "id", SAMPLE_ROWS, total).select("vec").toPandas()["vec"]
    data = _matrix(sample)
    centres = fit_centres(data, min(number, len(data)))
    shared = spark.sparkContext.broadcast(centres)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cell = (_matrix(batch["vec"]) @ shared.value.T).argmax(axis=1) if len(batch) else np.zeros(0, int)
            yield batch.assign(cell=cell.astype("int32"))

    celled = heads.select("id", "vec").mapInPandas(assign, "id string, vec binary, cell int")
    sizes = {r["cell"]: r["count"] for r in celled.groupBy("cell").count().collect()}  # at most MOST_CELLS rows
    parts = {cell: max(1, round(count / (2 * SHARD_ROWS))) for cell, count in sizes.items()}
    first = dict(zip(parts, np.cumsum([0, *parts.values()]).tolist()[:-1], strict=True))
    plan = F.broadcast(spark.createDataFrame([(c, first[c], parts[c]) for c in parts], "cell int, first int, parts int"))  # at most MOST_CELLS rows
    indexed = checkpointed(celled.join(plan, "cell").select("id", "vec", "cell", (F.col("first") + F.pmod(F.xxhash64("id"), "parts").cast("int")).alias("shard")))

    def answer(frame: pd.DataFrame) -> pd.DataFrame:
        names, mine = frame["id"].to_numpy(), _matrix(frame["vec"])
        best, rows = np.full((len(mine), k), -2, np.float32), np.full((len(mine), k), -1)
        VantageTree(mine).search(mine, best, rows, factor, np.arange(len(mine)))
        return pd.DataFrame({"id": names, "vec": frame["vec"], "cell": frame["cell"], "shard": frame["shard"], "best": list(best.astype(np.float64)), "near": [[names[j] if j >= 0 else None for j in r] for r in rows]})

    own = checkpointed(indexed.groupBy("shard").applyInPandas(answer, "id string, vec binary, cell int, shard int, best array<double>, near array<string>"))

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The other shards where a query may have something better."""
        for batch in batches:
            if not len(batch):
                continue
            kth = np.array([x[-1] for x in batch["best"]], np.float32)
            bound = np.sqrt(np.maximum(0, 2 - 2 * kth))
            distance = distances(_matrix(batch["vec"]), shared.value)
            mine = distance[np.arange(len(batch)), batch["cell"].to_numpy()]
            wanted = factor * (distance - mine[:, None]) / 2 < bound[:, None]
            query, cell = np.nonzero(wanted)
            known = np.isin(cell, list(parts))
            query, cell = query[known], cell[known]
            times = np.array([parts[c] for c in cell.tolist()], int) if len(cell) else np.zeros(0, int)
            shard = np.repeat([first[c] for c in cell.tolist()], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            query = np.repeat(query, times)
            away = shard != batch["shard"].to_numpy()[query]
            query, shard = query[away], shard[away]
            yield pd.DataFrame({"id": batch["id"].to_numpy()[query], "vec": batch["vec"].to_numpy()[query], "bound": kth[query].astype(np.float64), "shard": shard.astype("int32")})

    routed = checkpointed(own.mapInPandas(route, "id string, vec binary, bound double, shard int"))
    results = [own.select("id", F.explode(F.arrays_zip(F.col("near").alias("neighbour"), F.col("best").alias("similarity"))).alias("x")).select("id", "x.neighbour", "x.similarity").where("neighbour is not null")]
    counts = routed.groupBy("shard").agg(F.ceil(F.count("*") / QUERY_ROWS).cast("int").alias("blocks"))
    asked = routed.join(counts, "shard").withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int")).drop("blocks")
    asking = indexed.join(counts, "shard").select("id", "vec", "shard", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))

    def elsewhere(data: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(data) or not len(queries):
            return pd.DataFrame({"id": [], "neighbour": [], "similarity": []})
        names = data["id"].to_numpy()
        best = np.repeat(queries["bound"].to_numpy(np.float32)[:, None], k, axis=1)
        rows = np.full(best.shape, -1)
        VantageTree(_matrix(data["vec"])).search(_matrix(queries["vec"]), best, rows, factor)
        query, place = np.nonzero(rows >= 0)
        return pd.DataFrame({"id": queries["id"].to_numpy()[query], "neighbour": names[rows[query, place]], "similarity": best[query, place].astype(np.float64)})

    results.append(asking.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInPandas(elsewhere, "id string, neighbour string, similarity double"))
    ranked = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("similarity"), "neighbour"))
    top = reduce(DataFrame.unionByName, results).withColumn("n", ranked).where(F.col("n") <= k).drop("n")
    others = vectors.join(heads, "id", "left_anti").select("id", "vec")
    answers = heads.where(F.col("copy") <= k).select(F.col("id").alias("neighbour"), "vec")
    return top.unionByName(others.join(answers, "vec").select("id", "neighbour", F.lit(1.0).alias("similarity")))


#: table -> key and vector columns.
TABLES = {"article_text_embedding": ("article_id", "article_text_embedding"), "author_embedding": ("author_id", "embedding_tensor_data")}


def top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vector_table, id, neighbour, similarity: the five most similar keys of each key of both tables."""
    return reduce(DataFrame.unionByName, [nearest(read_table(spark, sf_dir, t), key, vector, 64).select(F.lit(t).alias("vector_table"), "*") for t, (key, vector) in TABLES.items()])


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top5(spark, sf_dir).select("vector_table", F.least("id", "neighbour").alias("id_a"), F.greatest("id", "neighbour").alias("id_b")).distinct()


def queries() -> dict:
    return {"p3_found": found, "p3_top5": top5}


def _exact_sql(table: str, key: str, vector: str) -> str:
    """The five most similar keys of each key by comparing all with all."""
    clean = f"SELECT {key} AS id, max({vector})::DOUBLE[] AS v FROM {table} WHERE {key} IS NOT NULL AND len({vector}) = 64 AND NOT list_bool_or(list_transform({vector}, lambda x: x IS NULL OR isnan(x) OR isinf(x))) AND list_bool_or(list_transform({vector}, lambda x: x <> 0)) GROUP BY 1"
    return f"SELECT '{table}' AS vector_table, id, other FROM (SELECT a.id, b.id AS other, row_number() OVER (PARTITION BY a.id ORDER BY list_cosine_similarity(a.v, b.v) DESC, b.id) AS n FROM ({clean}) a JOIN ({clean}) b ON a.id <> b.id) WHERE n <= 5"


def oracle_sql() -> dict[str, str]:
    both = " UNION ALL ".join(_exact_sql(t, *columns) for t, columns in TABLES.items())
    return {"p3_found": f"SELECT DISTINCT vector_table, least(id, other) AS id_a, greatest(id, other) AS id_b FROM ({both})"}
