"""The collaboration novelty index as window functions over pairs, without a stateful graph.

Articles are ordered by (date, article id). A pair's weight at an article is how often it has occurred up to and including
it, so a running count over the pair's occurrences replaces the graph. Articles with fewer than two authors have no pairs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _pairs(rows: DataFrame, item: str) -> DataFrame:
    """Unordered pairs (x < y) of the different items of each article, with the article's date."""
    left, right = rows.select("article_id", "dt", F.col(item).alias("x")), rows.select("article_id", F.col(item).alias("y"))
    return left.join(right, "article_id").where("x < y")


def _weighted(pairs: DataFrame) -> DataFrame:
    """pairs with their weight: how often the pair has occurred up to the row. Occurrences are counted by day and summed over
    the days before; only those of one day are put in order, so that a frequent pair is no task of its own."""
    day = Window.partitionBy("x", "y", "d")
    ranked = pairs.withColumn("d", F.coalesce(F.col("dt").cast("timestamp").cast("long"), F.lit(2**62))).withColumn("nth", F.row_number().over(day.orderBy("article_id")))
    days = ranked.groupBy("x", "y", "d").agg(F.max("nth").alias("n"))
    before = F.sum("n").over(Window.partitionBy("x", "y").orderBy("d").rowsBetween(Window.unboundedPreceding, -1))
    days = days.select("x", "y", "d", F.coalesce(before, F.lit(0)).alias("before"))
    return ranked.join(days, ["x", "y", "d"]).withColumn("weight", F.col("before") + F.col("nth")).select("article_id", "dt", "x", "y", "weight")


def novelty(collaboration: DataFrame, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(index, metadata, author pairs) from (article_id, author_id, institution_id, dt).

    index: article_id, collaboration_novelty_index = N_A * (1 + N_I) * S_A, where N sums 1 / (1 + weight) over the article's
    author (institution) pairs (N_A is 1 without pairs) and S_A is 1 / (1 + author pairs seen before). metadata: article_id,
    author_id, institution_id with has_new_author_collaboration and has_new_institution_collaboration. pairs: article_id,
    author_id, co_author_id, is_new_author_pair. Rows with a null article, author or institution count for nothing;
    repeated rows count once. Pairs grow with the square of an article's authors, so cap those before (see the marts).
    keep: applied to what all three share (a checkpoint, where more than one of them is used).
    """
    rows = collaboration.where("article_id is not null and author_id is not null and institution_id is not null").select("article_id", "author_id", "institution_id", "dt").distinct()
    rows = keep(rows)
    authors = rows.select("article_id", "dt", "author_id").distinct()
    size = authors.groupBy("article_id").agg(F.count("*").alias("authors"))
    author_pairs = keep(_weighted(_pairs(authors, "author_id")))
    shared = rows.join(size.where("authors > 1"), "article_id", "left_semi")
    institution_pairs = keep(_weighted(_pairs(shared.select("article_id", "dt", "institution_id").distinct(), "institution_id")))
    of_authors = author_pairs.groupBy("article_id").agg(F.sum(1 / (1 + F.col("weight"))).alias("n_a"), F.count(F.when(F.col("weight") > 1, 1)).alias("old"))
    of_institutions = institution_pairs.groupBy("article_id").agg(F.sum(1 / (1 + F.col("weight"))).alias("n_i"))
    index = rows.select("article_id").distinct().join(of_authors, "article_id", "left").join(of_institutions, "article_id", "left")
    index = index.select("article_id", (F.coalesce("n_a", F.lit(1.0)) * (1 + F.coalesce("n_i", F.lit(0.0))) / (1 + F.coalesce("old", F.lit(0)))).alias("collaboration_novelty_index"))
    # an institution pair is new for an article if it is the first one of the pair for each of its authors
    by_author = institution_pairs.select("article_id", "dt", "x", "y").join(authors.select("article_id", "author_id"), "article_id")
    first = by_author.groupBy("x", "y", "author_id").agg(F.min(F.struct(F.col("dt").isNull().alias("no"), "dt", "article_id")).alias("first"))
    first = first.groupBy(F.col("first.article_id").alias("article_id"), "x", "y").agg(F.count("*").alias("firsts"))
    new_institutions = first.join(size, "article_id").where("firsts = authors")
    new_authors = author_pairs.where("weight = 1")
    ends = lambda pairs, name: pairs.select("article_id", F.explode(F.array("x", "y")).alias(name)).distinct()
    metadata = (
        rows.select("article_id", "author_id", "institution_id")
        .join(ends(new_authors, "author_id").withColumn("a", F.lit(True)), ["article_id", "author_id"], "left")
        .join(ends(new_institutions, "institution_id").withColumn("i", F.lit(True)), ["article_id", "institution_id"], "left")
        .select("article_id", "author_id", "institution_id", F.coalesce("a", F.lit(False)).alias("has_new_author_collaboration"), F.coalesce("i", F.lit(False)).alias("has_new_institution_collaboration"))
    )
    pairs = author_pairs.select("article_id", F.col("x").alias("author_id"), F.col("y").alias("co_author_id"), (F.col("weight") == 1).alias("is_new_author_pair"))
    return index, metadata, pairs
