"""Operators one by one on the star-schema tables, each with its DuckDB SQL.

Stand-ins: an article is an order, an author a supplier, an institution the supplier's nation, the place of an author the line
number, citations the order's price, an area the customer's segment, keywords the words of part names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from papyrine.functions.scalars import array_text, clamped_date, cosine, institution_code, json_date, keyword_list, mean_pool, snake_case, strip_quotes, truncated_quotient, unit
from papyrine.operators.enrich import FREQUENT_WORDS, batches_of, frequent_word_language, hashed_vectors, joined_text, nearest_labels, next_batch, top_terms
from papyrine.operators.novelty import novelty
from papyrine.operators.parse import TITLES, latest, parse_crossref, parse_publications, primary_ids
from papyrine.plans.model_queries import PATTERNS, _clean, _items
from papyrine.plans.model_queries import SQL as MODEL_SQL
from papyrine.plans.models import author_role, best_non_null, co_author_edges, collaboration_flags, documents_of, earlier_works, keyword_trend, normalized_citations, with_default_member
from papyrine.session import read_table
from papyrine.sources.sinks import delete_insert, not_in, unprocessed, upsert
from papyrine.streaming.incremental import windowed_counts

QUERIES: dict = {}
SQL: dict[str, str] = {}


def register(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def collaborations(spark: SparkSession, d: str) -> DataFrame:
    supplier = read_table(spark, d, "supplier").join(read_table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("author_id"), F.col("n_name").alias("institution_id"))
    lines = read_table(spark, d, "lineitem").select(F.col("l_orderkey").alias("article_id"), F.col("l_suppkey").alias("author_id"), F.col("l_linenumber").alias("author_sequence"))
    orders = read_table(spark, d, "orders").select(F.col("o_orderkey").alias("article_id"), F.col("o_orderdate").cast("date").alias("dt"))
    return lines.join(supplier, "author_id").join(orders, "article_id")


_C = "WITH c AS (SELECT l_orderkey AS article_id, l_suppkey AS author_id, l_linenumber AS author_sequence, n_name AS institution_id, o_orderdate::DATE AS dt FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey JOIN orders ON o_orderkey = l_orderkey)"


@register(f"{_C} SELECT a.author_id, b.author_id AS co_author_id, min(strftime(a.dt, '%Y%m%d')) AS time, count(DISTINCT CASE WHEN a.institution_id = 'NATION_1' THEN a.article_id END) AS alliance_collaboration_count FROM c a JOIN c b ON b.article_id = a.article_id AND b.author_id <> a.author_id GROUP BY 1, 2 HAVING count(DISTINCT a.article_id) >= 20")
def coauthor_edges(spark: SparkSession, d: str) -> DataFrame:
    # marked: the first author is of one nation, so both directions are built
    rows = collaborations(spark, d).groupBy("article_id", "author_id").agg(F.min("dt").alias("dt"), F.bool_or(F.col("institution_id") == "NATION_1").alias("m"))
    pairs = rows.join(rows.select("article_id", F.col("author_id").alias("co_author_id")), "article_id").where("author_id <> co_author_id")
    return pairs.groupBy("author_id", "co_author_id").agg(F.count("*").alias("n"), F.date_format(F.min("dt"), "yyyyMMdd").alias("time"), F.count(F.when(F.col("m"), 1)).alias("alliance_collaboration_count")).where("n >= 20").drop("n")


@register(f"{_C} SELECT a.author_id, b.author_id AS co_author_id, min(strftime(a.dt, '%Y%m%d')) AS time, count(DISTINCT CASE WHEN year(a.dt) >= 1998 THEN a.article_id END) AS alliance_collaboration_count FROM c a JOIN c b ON b.article_id = a.article_id AND b.author_id <> a.author_id GROUP BY 1, 2 HAVING count(DISTINCT a.article_id) >= 20")
def mirrored_coauthor_edges(spark: SparkSession, d: str) -> DataFrame:
    return co_author_edges(collaborations(spark, d).withColumn("m", F.year("dt") >= 1998), "article_id", "author_id", "dt", "m", 20)


@register(f"{_C} SELECT article_id, author_id, institution_id, max(author_sequence)::BIGINT AS author_sequence FROM c WHERE article_id IN (SELECT article_id FROM c GROUP BY 1 HAVING count(DISTINCT author_id) <= 8) GROUP BY ALL")
def collaboration_author_cap(spark: SparkSession, d: str) -> DataFrame:
    c = collaborations(spark, d)
    kept = c.groupBy("article_id").agg(F.countDistinct("author_id").alias("n")).where("n <= 8").select("article_id")
    return c.join(kept, "article_id", "left_semi").groupBy("article_id", "author_id", "institution_id").agg(F.max("author_sequence").cast("bigint").alias("author_sequence"))


@register(f"{_C} SELECT article_id, count(DISTINCT author_id) = 1 AND count(DISTINCT institution_id) = 1 AS is_single_author_collaboration, count(DISTINCT author_id) > 1 AND count(DISTINCT institution_id) = 1 AS is_internal_collaboration, count(DISTINCT institution_id) > 1 AS is_external_collaboration, count(DISTINCT institution_id) > 1 AS is_alliance_collaboration FROM c GROUP BY article_id")
def collaboration_kinds(spark: SparkSession, d: str) -> DataFrame:
    return collaboration_flags(collaborations(spark, d), "article_id", "author_id", "institution_id")


@register(f"{_C} SELECT article_id, author_id, CASE WHEN s = 1 AND m = 1 THEN 'singleAuthor' WHEN s = 1 THEN 'firstAuthor' WHEN s = m THEN 'lastAuthor' ELSE 'middleAuthor' END AS role FROM (SELECT article_id, author_id, max(author_sequence) AS s, max(max(author_sequence)) OVER (PARTITION BY article_id) AS m FROM c GROUP BY 1, 2)")
def author_roles(spark: SparkSession, d: str) -> DataFrame:
    c = collaborations(spark, d).groupBy("article_id", "author_id").agg(F.max("author_sequence").alias("s"))
    return c.join(c.groupBy("article_id").agg(F.max("s").alias("m")), "article_id").select("article_id", "author_id", author_role(F.col("s"), F.col("m")).alias("role"))


@register(f"{_C} SELECT author_id, article_id, n AS article_count FROM (SELECT author_id, article_id, count(*) OVER (PARTITION BY author_id ORDER BY dt RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 DAY PRECEDING) AS n FROM (SELECT DISTINCT author_id, article_id, dt FROM c)) WHERE n > 0")
def author_experience(spark: SparkSession, d: str) -> DataFrame:
    return earlier_works(collaborations(spark, d), "author_id", "article_id", "dt")


@register("WITH o AS (SELECT o_orderkey AS article_id, c_mktsegment AS r, year(o_orderdate) AS y, CAST(round(o_totalprice) AS BIGINT) AS n FROM orders JOIN customer ON c_custkey = o_custkey) SELECT article_id, n AS article_citation_count, round(n / log10(sum(n) OVER (PARTITION BY r, y)::DOUBLE), 2) AS article_citation_normalized_count FROM o")
def citation_normalized(spark: SparkSession, d: str) -> DataFrame:
    o = read_table(spark, d, "orders").join(read_table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return normalized_citations(o.select(F.col("o_orderkey").alias("article_id"), F.col("c_mktsegment").alias("research_area_code"), F.year("o_orderdate").alias("publication_year"), F.round("o_totalprice").cast("bigint").alias("article_citation_count")))


@register("SELECT k, max(a) AS a, max(b) AS b FROM (SELECT c_nationkey AS k, c_name AS a, CASE WHEN c_acctbal > 0 THEN c_mktsegment END AS b FROM customer UNION ALL SELECT s_nationkey, NULL, s_name FROM supplier) GROUP BY k")
def best_non_null_merge(spark: SparkSession, d: str) -> DataFrame:
    one = read_table(spark, d, "customer").select(F.col("c_nationkey").alias("k"), F.col("c_name").alias("a"), F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).alias("b"))
    other = read_table(spark, d, "supplier").select(F.col("s_nationkey").alias("k"), F.lit(None).cast("string").alias("a"), F.col("s_name").alias("b"))
    return best_non_null(one.unionAll(other), "k", ["a", "b"])


@register("SELECT DISTINCT o_custkey, o_orderpriority, max(o_shippable) OVER (PARTITION BY o_custkey ORDER BY o_shippable) AS running_max, first_value(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS first_priority FROM (SELECT o_custkey, o_orderpriority, year(o_orderdate) AS o_shippable FROM orders)")
def running_max_window(spark: SparkSession, d: str) -> DataFrame:
    o = read_table(spark, d, "orders").select("o_custkey", "o_orderpriority", F.year("o_orderdate").cast("bigint").alias("y"))
    by = lambda c: Window.partitionBy("o_custkey").orderBy(c)
    return o.select("o_custkey", "o_orderpriority", F.max("y").over(by("y")).alias("running_max"), F.first("o_orderpriority").over(by("o_orderpriority")).alias("first_priority")).distinct()


@register("SELECT user_id, event_id, event_type FROM events QUALIFY rank() OVER (PARTITION BY user_id ORDER BY date_trunc('day', ts) DESC) = 1")
def latest_row_rank(spark: SparkSession, d: str) -> DataFrame:
    return latest(read_table(spark, d, "events").withColumn("day", F.date_trunc("day", "ts")), "user_id", "day").select("user_id", "event_id", "event_type")


@register("SELECT DISTINCT p_brand, p_type FROM (SELECT p_brand, p_type, rank() OVER (PARTITION BY p_brand ORDER BY CASE WHEN min_name LIKE '%' || p_type || '%' THEN 1 ELSE 0 END DESC) AS r FROM (SELECT DISTINCT p_brand, p_type, 'x' || substr(p_type, 1, 3) || p_brand AS min_name FROM part)) WHERE r = 1")
def primary_id_rank(spark: SparkSession, d: str) -> DataFrame:
    p = read_table(spark, d, "part").select("p_brand", "p_type", F.concat(F.lit("x"), F.substring("p_type", 1, 3), "p_brand").alias("u"))
    return primary_ids(p, "p_brand", "u", "p_type")


@register("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def not_in_orders(spark: SparkSession, d: str) -> DataFrame:
    urgent = read_table(spark, d, "orders").where("o_orderpriority = '1-URGENT'")
    return not_in(read_table(spark, d, "customer"), "c_custkey", urgent, "o_custkey").select("c_custkey", "c_name")


@register("SELECT n_name FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 0) ")
def not_in_null_aware(spark: SparkSession, d: str) -> DataFrame:
    return not_in(read_table(spark, d, "nation"), "n_nationkey", read_table(spark, d, "supplier").where("s_acctbal > 0"), "s_nationkey").select("n_name")


@register("SELECT n_name FROM nation WHERE n_nationkey NOT IN (SELECT CASE WHEN s_acctbal > 0 THEN s_nationkey END FROM supplier)")
def not_in_with_null(spark: SparkSession, d: str) -> DataFrame:
    others = read_table(spark, d, "supplier").select(F.when(F.col("s_acctbal") > 0, F.col("s_nationkey")).alias("k"))
    return not_in(read_table(spark, d, "nation"), "n_nationkey", others, "k").select("n_name")


@register("SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def anti_unprocessed(spark: SparkSession, d: str) -> DataFrame:
    return unprocessed(read_table(spark, d, "orders"), read_table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey").select("o_orderkey", "o_custkey")


@register("WITH open AS (SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 10) GROUP BY o_orderkey ORDER BY min(o_orderdate), o_orderkey LIMIT 100) SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN (FROM open)")
def oldest_batch(spark: SparkSession, d: str) -> DataFrame:
    done = read_table(spark, d, "lineitem").where("l_quantity > 10").select(F.col("l_orderkey").alias("o_orderkey"))
    return next_batch(read_table(spark, d, "orders"), done, "o_orderkey", "o_orderdate", 100).select("o_orderkey", "o_custkey")


@register("SELECT CAST(ceil(count(*) / 1000.0) AS BIGINT) AS batches FROM orders")
def batch_count(spark: SparkSession, d: str) -> DataFrame:
    return spark.createDataFrame([(batches_of(read_table(spark, d, "orders"), 1000),)], "batches bigint")


@register("SELECT s.s_suppkey, a.o AS urgent, b.o AS low FROM supplier s LEFT JOIN (SELECT DISTINCT l_suppkey AS k, l_linenumber::BIGINT AS o FROM lineitem WHERE l_returnflag = 'R') a ON a.k = s.s_suppkey LEFT JOIN (SELECT DISTINCT l_suppkey AS k, l_linenumber::BIGINT AS o FROM lineitem WHERE l_returnflag = 'A') b ON b.k = s.s_suppkey")
def self_join_pivot(spark: SparkSession, d: str) -> DataFrame:
    lines = read_table(spark, d, "lineitem").select(F.col("l_suppkey").alias("s_suppkey"), F.col("l_linenumber").cast("bigint").alias("o"), "l_returnflag").distinct()
    one = lambda flag, name: lines.where(F.col("l_returnflag") == flag).select("s_suppkey", F.col("o").alias(name))
    return read_table(spark, d, "supplier").select("s_suppkey").join(one("R", "urgent"), "s_suppkey", "left").join(one("A", "low"), "s_suppkey", "left")


@register("SELECT r_name AS name, r_regionkey::VARCHAR AS code FROM region UNION ALL SELECT 'Other', 'n/a'")
def dim_with_default_member(spark: SparkSession, d: str) -> DataFrame:
    return with_default_member(read_table(spark, d, "region").select(F.col("r_name").alias("name"), F.col("r_regionkey").cast("string").alias("code")), ["name", "code"], name="Other")


_N = f"{_C}, a AS (SELECT DISTINCT article_id, author_id, dt FROM c), i AS (SELECT DISTINCT article_id, institution_id, dt FROM c WHERE article_id IN (SELECT article_id FROM a GROUP BY 1 HAVING count(*) > 1)), ap AS (SELECT p.article_id, p.author_id AS x, q.author_id AS y, row_number() OVER (PARTITION BY p.author_id, q.author_id ORDER BY p.dt, p.article_id) AS w FROM a p JOIN a q ON q.article_id = p.article_id AND p.author_id < q.author_id), ip AS (SELECT p.article_id, p.institution_id AS x, q.institution_id AS y, row_number() OVER (PARTITION BY p.institution_id, q.institution_id ORDER BY p.dt, p.article_id) AS w FROM i p JOIN i q ON q.article_id = p.article_id AND p.institution_id < q.institution_id)"


@register(f"{_N} SELECT article_id, round(coalesce(na, 1) * (1 + coalesce(ni, 0)) / (1 + coalesce(old, 0)) + 1e-9, 6) AS collaboration_novelty_index FROM (SELECT DISTINCT article_id FROM a) LEFT JOIN (SELECT article_id, sum(1.0::DOUBLE / (1 + w)) AS na, count(*) FILTER (WHERE w > 1) AS old FROM ap GROUP BY 1) USING (article_id) LEFT JOIN (SELECT article_id, sum(1.0::DOUBLE / (1 + w)) AS ni FROM ip GROUP BY 1) USING (article_id)")
def novelty_index(spark: SparkSession, d: str) -> DataFrame:
    return novelty(collaborations(spark, d))[0].withColumn("collaboration_novelty_index", F.round(F.col("collaboration_novelty_index") + 1e-9, 6))


@register(f"{_N} SELECT article_id, x AS author_id, y AS co_author_id, w = 1 AS is_new_author_pair FROM ap")
def new_author_pairs(spark: SparkSession, d: str) -> DataFrame:
    return novelty(collaborations(spark, d))[2]


@register(f"{_N}, s AS (SELECT ip.article_id, x, y, max(seen) AS seen FROM (SELECT ip.article_id, ip.x, ip.y, row_number() OVER (PARTITION BY ip.x, ip.y, a.author_id ORDER BY a.dt, ip.article_id) AS seen FROM ip JOIN a ON a.article_id = ip.article_id) ip GROUP BY 1, 2, 3) SELECT DISTINCT c.article_id, c.author_id, c.institution_id, (c.article_id, c.author_id) IN (SELECT article_id, unnest([x, y]) FROM ap WHERE w = 1) AS has_new_author_collaboration, (c.article_id, c.institution_id) IN (SELECT article_id, unnest([x, y]) FROM s WHERE seen = 1) AS has_new_institution_collaboration FROM c")
def novelty_flags(spark: SparkSession, d: str) -> DataFrame:
    return novelty(collaborations(spark, d))[1]


@register("WITH s AS (SELECT vec_id AS seed, label, embedding::DOUBLE[] AS v FROM embeddings WHERE label IS NOT NULL) SELECT vec_id, label, CAST(r AS BIGINT) AS rank, round(sim, 6) AS similarity FROM (SELECT e.vec_id, s.label::BIGINT AS label, list_cosine_similarity(e.embedding::DOUBLE[], s.v) AS sim, row_number() OVER (PARTITION BY e.vec_id ORDER BY round(list_cosine_similarity(e.embedding::DOUBLE[], s.v), 12) DESC, s.seed::VARCHAR, s.label::VARCHAR) AS r FROM embeddings e, s) WHERE r <= 3")
def nearest_area_top3(spark: SparkSession, d: str) -> DataFrame:
    """Every vector against all labelled vectors."""
    e = read_table(spark, d, "embeddings")
    seeds = e.where(F.col("label").isNotNull())
    return nearest_labels(e, "vec_id", "embedding", seeds, "vec_id", "embedding", "label").select("vec_id", F.col("label").cast("bigint").alias("label"), F.col("rank").cast("bigint").alias("rank"), F.round("similarity", 6).alias("similarity"))


@register("SELECT a.vec_id, b.vec_id AS other, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS similarity FROM embeddings a JOIN embeddings b ON b.label = a.label AND b.vec_id = a.vec_id + 10")
def cosine_expression(spark: SparkSession, d: str) -> DataFrame:
    e = read_table(spark, d, "embeddings")
    return e.join(e.select((F.col("vec_id") - 10).alias("vec_id"), F.col("vec_id").alias("other"), "label", F.col("embedding").alias("v")), ["vec_id", "label"]).select("vec_id", "other", F.round(cosine(F.col("embedding"), F.col("v")), 6).alias("similarity"))


@register("SELECT vec_id, round(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[]) / list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[]), 6) AS length, round((embedding[1]::DOUBLE + embedding[3]::DOUBLE) / 2, 6) AS pooled FROM embeddings")
def unit_and_mean_pool(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("embedding")
    rows = F.transform(F.sequence(F.lit(0), F.lit(2)), lambda i: F.array(F.get(v, i).cast("double")))
    length = F.aggregate(unit(v), F.lit(0.0), lambda s, x: s + x * x)
    return read_table(spark, d, "embeddings").select("vec_id", F.round(length, 6).alias("length"), F.round(F.get(mean_pool(rows, F.array(F.lit(1), F.lit(0), F.lit(1))), F.lit(0)), 6).alias("pooled"))


def _keyword_use(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    part = read_table(spark, d, "part").select("p_partkey", F.explode(F.split("p_name", " ")).alias("article_keyword"))
    lines = read_table(spark, d, "lineitem").join(read_table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select("l_partkey", F.year("o_orderdate").alias("article_publication_year"))
    counts = lines.join(part, F.col("l_partkey") == F.col("p_partkey")).groupBy("article_keyword", "article_publication_year").agg(F.count("*").cast("int").alias("publication_count"))
    uses = part.join(read_table(spark, d, "part").select("p_partkey", F.col("p_type").alias("research_area_code")), "p_partkey").select("article_keyword", "research_area_code")
    return counts, uses


_T = "WITH w AS (SELECT p_partkey, p_type AS r, unnest(string_split(p_name, ' ')) AS k FROM part), t AS (SELECT k, year(o_orderdate) AS y, count(*) AS n FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN w ON p_partkey = l_partkey GROUP BY 1, 2), j AS (SELECT t.*, w.r FROM t JOIN w ON w.k = t.k), g AS (SELECT r, y, sum(n) AS total FROM j GROUP BY 1, 2), m AS (SELECT DISTINCT k, r, y, n, CASE WHEN n <= 1 THEN n ELSE CAST(trunc(n::DOUBLE / log10(1 + total)) AS BIGINT) END AS norm FROM j JOIN g USING (r, y)), q AS (SELECT *, avg(yoy) OVER (PARTITION BY k, r ORDER BY y, n ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS roll FROM (SELECT *, (norm - p) / nullif(p, 0) AS yoy FROM (SELECT *, lag(norm) OVER (PARTITION BY k, r ORDER BY y, n) AS p FROM m)))"


@register(f"{_T} SELECT k AS article_keyword, r AS research_area_code, y AS article_publication_year, n AS publication_count, norm AS publication_normalized_count, round(yoy, 6) AS publication_count_yoy, round(roll, 6) AS rolling, round(b, 6) AS baseline, coalesce(roll > b + 0.02, false) AS is_trend_positive FROM q JOIN (SELECT r, y, quantile_cont(roll, 0.5) AS b FROM q GROUP BY 1, 2) USING (r, y)")
def keyword_trends(spark: SparkSession, d: str) -> DataFrame:
    t = keyword_trend(*_keyword_use(spark, d))
    return t.select("article_keyword", "research_area_code", F.col("article_publication_year").cast("bigint").alias("article_publication_year"), F.col("publication_count").cast("bigint").alias("publication_count"), "publication_normalized_count", F.round("publication_count_yoy", 6).alias("publication_count_yoy"), F.round("publication_count_yoy_3yr_rolling_avg", 6).alias("rolling"), F.round("publication_count_yoy_3yr_rolling_avg_baseline", 6).alias("baseline"), "is_trend_positive")


@register("SELECT event_id, CAST(props::JSON ->> '$.k' AS BIGINT) AS k, json_array_length('[' || props || ',null]') AS n FROM events")
def json_extract(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"), F.json_array_length(F.concat(F.lit("["), "props", F.lit(",null]"))).cast("bigint").alias("n"))


def _sql_date(json: str, lenient: bool = False) -> str:
    """json_date in DuckDB."""
    moment = f"CAST(TRY_STRPTIME(substr({json} ->> '$.\"date-time\"', 1, 10), '%Y-%m-%d') AS DATE)"
    millis = f"(DATE '1970-01-01' + CAST(floor(TRY_CAST({json} ->> '$.timestamp' AS BIGINT) / 86400000.0) AS INTEGER))"
    y, m, day = (f"TRY_CAST({json} ->> '$.\"date-parts\"[0][{i}]' AS INTEGER)" for i in range(3))
    if lenient:
        m, day = f"coalesce({m}, 1)", f"coalesce({day}, 1)"
    parts = f"CASE WHEN {y} IS NOT NULL AND {m} IS NOT NULL AND {day} IS NOT NULL THEN TRY_CAST(printf('%04d-%02d-%02d', {y}, {m}, {day}) AS DATE) END"
    return f"coalesce({millis}, {moment}, {parts})" if lenient else f"coalesce({moment}, {millis}, {parts})"


#: The readable publications without their wrapper.
_DOCUMENTS = f"WITH x_documents AS ({MODEL_SQL['x_documents'][1]})"
DATE_MEMBERS = ("indexed", "published", "created", "issued")


@register(f"{_DOCUMENTS} SELECT publication_doi, m AS member, CAST({_sql_date('j')} AS VARCHAR) AS strict, CAST({_sql_date('j', True)} AS VARCHAR) AS lenient FROM ({' UNION ALL '.join(f"SELECT publication_doi, '{m}' AS m, d -> '$.{m}' AS j FROM x_documents" for m in DATE_MEMBERS)})")
def json_dates(spark: SparkSession, d: str) -> DataFrame:
    """F16 on every readable publication: the dates of its members in all their forms, strict and lenient."""
    docs = documents_of(read_table(spark, d, "crossref_publication"))
    each = docs.select("publication_doi", F.explode(F.array(*(F.struct(F.lit(m).alias("member"), F.get_json_object("doc", f"$.{m}").alias("j")) for m in DATE_MEMBERS))).alias("x")).select("publication_doi", "x.*")
    return each.select("publication_doi", "member", json_date(F.col("j")).cast("string").alias("strict"), json_date(F.col("j"), lenient=True).cast("string").alias("lenient"))


_CLAMPED = "CAST(make_date(greatest(y, 1900), greatest(m, 1), 1) + CAST(CASE WHEN least(d, day(last_day(make_date(greatest(y, 1900), greatest(m, 1), 1)))) >= 1 THEN least(d, day(last_day(make_date(greatest(y, 1900), greatest(m, 1), 1)))) - 1 END AS INTEGER) AS VARCHAR)"
_PARTS = "SELECT l_orderkey, l_linenumber, CAST(CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE year(l_shipdate) - CASE WHEN l_suppkey % 5 = 0 THEN 150 ELSE 0 END END AS INTEGER) AS y, CAST(CASE WHEN l_suppkey % 11 = 0 THEN NULL ELSE l_partkey % 15 END AS INTEGER) AS m, CAST(l_quantity - 5 AS INTEGER) AS d FROM lineitem"


@register(f"WITH p AS ({_PARTS}), c AS (SELECT l_orderkey, l_linenumber, y, m, d FROM p UNION ALL SELECT l_orderkey, -l_linenumber, coalesce(y, 1900), coalesce(m, 1), greatest(coalesce(d, 1), 1) FROM p) SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS line, CASE WHEN y IS NOT NULL AND m IS NOT NULL AND d IS NOT NULL AND m <= 12 THEN {_CLAMPED} END AS dt FROM c")
def safe_dates(spark: SparkSession, d: str) -> DataFrame:
    """F14, F15 on every order line: years too early, months and days too small or large, parts missing. A negative line is
    the date with lifted days."""
    parts = read_table(spark, d, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "cast(if(l_suppkey % 7 = 0, null, year(l_shipdate) - if(l_suppkey % 5 = 0, 150, 0)) as int) as y", "cast(if(l_suppkey % 11 = 0, null, l_partkey % 15) as int) as m", "cast(l_quantity - 5 as int) as d",
    )
    y, m, day = F.col("y"), F.col("m"), F.col("d")
    plain = parts.select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("line"), clamped_date(y, m, day).cast("string").alias("dt"))
    return plain.unionByName(parts.select("l_orderkey", (-F.col("l_linenumber")).cast("bigint").alias("line"), clamped_date(y, m, day, lift_day=True).cast("string").alias("dt")))


@register("SELECT doc_id, CASE WHEN lower(text) LIKE '%brenholm%' THEN 'INST_A' WHEN lower(text) LIKE '%academy%' THEN 'INST_B' WHEN lower(text) LIKE '%technical%' THEN 'INST_C' WHEN lower(text) LIKE '%research council%' THEN 'INST_D' ELSE 'OTHER' END AS code FROM documents")
def institution_classifier(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "documents").select("doc_id", institution_code(F.col("text"), PATTERNS).alias("code"))


@register("SELECT p_partkey, lower(replace(trim(p_name || ' (New)'), ' ', '_')).replace('(', '').replace(')', '') AS snake, string_split('[' || p_name || ', b,, c ]', ',')[2].trim() AS second, p_name || ', ' || coalesce(NULL, '') || ', ' || p_brand AS told, replace(replace('“' || p_name || '\"', '“', ''), '\"', '') AS bare FROM part")
def text_cleanup(spark: SparkSession, d: str) -> DataFrame:
    name = F.col("p_name")
    p = read_table(spark, d, "part").withColumn("nothing", F.lit(None).cast("string"))
    return p.select("p_partkey", snake_case(F.concat(name, F.lit(" (New)"))).alias("snake"), F.get(keyword_list(F.concat(F.lit("["), name, F.lit(", b,, c ]"))), F.lit(1)).alias("second"), joined_text(", ", "p_name", "nothing", "p_brand").alias("told"), strip_quotes(F.concat(F.lit("“"), name, F.lit('"'))).alias("bare"))


@register("SELECT p_brand, '{' || string_agg(CASE WHEN p_type LIKE '% %' THEN '\"' || p_type || '\"' ELSE p_type END, ',' ORDER BY p_type) || '}' AS types FROM (SELECT DISTINCT p_brand, p_type FROM part) GROUP BY p_brand")
def array_as_text(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "part").groupBy("p_brand").agg(F.array_sort(F.collect_set("p_type")).alias("t")).select("p_brand", array_text(F.col("t")).alias("types"))


@register("SELECT l_orderkey, string_agg(l_suppkey::VARCHAR, ', ' ORDER BY l_linenumber, l_suppkey, l_partkey) AS first_three FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey, l_partkey, l_quantity) AS rn FROM lineitem) WHERE rn <= 3 GROUP BY l_orderkey")
def top3_string_agg(spark: SparkSession, d: str) -> DataFrame:
    by = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_suppkey", "l_partkey", "l_quantity")
    top = read_table(spark, d, "lineitem").select("l_orderkey", "l_suppkey", F.row_number().over(by).alias("rn")).where("rn <= 3")
    return top.groupBy("l_orderkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rn", "l_suppkey"))), lambda x: x["l_suppkey"].cast("string")), ", ").alias("first_three"))


@register("SELECT o.o_custkey, o.o_orderkey, l.l_linenumber::BIGINT AS l_linenumber FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey WHERE l.l_shipdate::DATE BETWEEN o.o_orderdate::DATE AND o.o_orderdate::DATE + 30")
def interval_join(spark: SparkSession, d: str) -> DataFrame:
    o = read_table(spark, d, "orders").select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("a"))
    l = read_table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linenumber").cast("bigint").alias("l_linenumber"), F.col("l_shipdate").cast("date").alias("s"))  # noqa: E741
    return o.join(l, "o_orderkey").where(F.col("s").between(F.col("a"), F.date_add("a", 30))).select("o_custkey", "o_orderkey", "l_linenumber")


@register("SELECT k, v, CASE WHEN k % 2 = 0 AND k < 20 THEN 'old' ELSE 'new' END AS stamp FROM (SELECT n_nationkey AS k, CASE WHEN n_nationkey % 2 = 0 THEN 'target' ELSE 'source' END AS v FROM nation WHERE n_nationkey % 2 = 1 UNION ALL SELECT n_nationkey, 'source' FROM nation WHERE n_nationkey % 2 = 0 AND n_nationkey < 20) ")
def upsert_merge(spark: SparkSession, d: str) -> DataFrame:
    n = read_table(spark, d, "nation").select(F.col("n_nationkey").alias("k"))
    target = n.where("k % 2 = 0 and k < 20").select("k", F.lit("target").alias("v"), F.lit("old").alias("stamp"))
    source = n.where("k % 2 = 1 or k < 20").select("k", F.lit("source").alias("v"), F.lit("new").alias("stamp"))
    return upsert(target, source, ["k"], keep=("stamp",))


@register("SELECT o_orderkey, o_orderstatus FROM orders WHERE NOT (o_orderdate::DATE BETWEEN DATE '1996-01-01' AND DATE '1996-12-31') UNION ALL SELECT o_orderkey, 'X' FROM orders WHERE year(o_orderdate) = 1996 AND o_orderkey % 2 = 0")
def delete_insert_window(spark: SparkSession, d: str) -> DataFrame:
    o = read_table(spark, d, "orders").withColumn("dt", F.col("o_orderdate").cast("date"))
    fresh = o.where("year(dt) = 1996 and o_orderkey % 2 = 0").withColumn("o_orderstatus", F.lit("X"))
    return delete_insert(o, fresh, F.col("dt").between("1996-01-01", "1996-12-31")).select("o_orderkey", "o_orderstatus")


@register("SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, CAST(trunc((l_discount - 0.05) * 1000 / l_quantity) AS BIGINT) AS q FROM lineitem")
def truncated_division(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), truncated_quotient((F.col("l_discount") - 0.05) * 1000, F.col("l_quantity")).alias("q"))


@register("SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def hourly_windows(spark: SparkSession, d: str) -> DataFrame:
    return windowed_counts(read_table(spark, d, "events"), "ts", "event_type").withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


_W = {code: "len(list_filter(w, lambda x: x IN (" + ", ".join(f"'{x}'" for x in sorted(set(own.split()))) + ")))" for code, own in FREQUENT_WORDS.items()}


@register("SELECT doc_id, CASE WHEN greatest(" + ", ".join(f"n_{c}" for c in sorted(_W)) + ") = 0 THEN 'n/a' " + " ".join(f"WHEN n_{c} = greatest({', '.join(f'n_{x}' for x in sorted(_W))}) THEN '{c}'" for c in sorted(_W)) + " END AS language FROM (SELECT doc_id, " + ", ".join(f"{x} AS n_{c}" for c, x in _W.items()) + " FROM (SELECT doc_id, regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}]+') AS w FROM documents))")
def language_by_frequent_words(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "documents").select("doc_id", frequent_word_language(F.col("text")).alias("language"))


@register("WITH t AS (SELECT doc_id, w, count(*) AS tf FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '\\p{L}{5,}')) AS w FROM documents) GROUP BY 1, 2), f AS (SELECT w, count(*) AS df FROM t GROUP BY 1), r AS (SELECT doc_id, w, row_number() OVER (PARTITION BY doc_id ORDER BY tf * ln((SELECT count(DISTINCT doc_id) FROM documents)::DOUBLE / df) DESC, w) AS r FROM t JOIN f USING (w)) SELECT d.doc_id, coalesce(string_agg(w, '|' ORDER BY r), '') AS keywords FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN (SELECT * FROM r WHERE r <= 5) USING (doc_id) GROUP BY 1")
def top_terms_of_documents(spark: SparkSession, d: str) -> DataFrame:
    return top_terms(read_table(spark, d, "documents"), "doc_id", "text").withColumn("keywords", F.array_join("keywords", "|"))


@register()
def hashed_document_vectors(spark: SparkSession, d: str) -> DataFrame:
    return hashed_vectors(read_table(spark, d, "documents"), "doc_id", "text")


@register(f"SELECT DISTINCT e.publication_id AS article_id, e.publication_eid AS article_eid, e.publication_doi AS article_doi, e.publication_title AS article_title, e.publication_journal AS article_journal, e.publication_type AS article_type, e.publication_abstract AS article_abstract, e.publication_citation_count AS article_citation_count, CAST(e.publication_dt AS VARCHAR) AS article_publication_dt, nullif(e.kw, '') AS article_keywords, a ->> '$.author_id' AS author_id, a ->> '$.author_initials' AS author_initials, a ->> '$.author_last_name' AS author_last_name, a ->> '$.author_first_name' AS author_first_name, a ->> '$.author_indexed_name' AS author_indexed_name, a ->> '$.author_sequence' AS author_sequence, CAST(TRY_CAST(a ->> '$.is_first_author' AS BOOLEAN) AS VARCHAR) AS is_first_author, y ->> '$.id' AS affiliation_id FROM (SELECT e.*, array_to_string(list_filter(list_transform({_items(_clean('publication_keywords'))}, lambda z: z ->> '$.keyword'), lambda z: z IS NOT NULL), ', ') AS kw, {_items(_clean('publication_authors'))} AS al FROM elsevier_publication e WHERE publication_dt IS NOT NULL) e LEFT JOIN LATERAL (SELECT unnest(e.al) AS a) ON true LEFT JOIN LATERAL (SELECT unnest({_items(chr(40) + 'a -> ' + chr(39) + '$.author_affiliation_ids' + chr(39) + chr(41))}) AS y) ON true")
def parsed_publications(spark: SparkSession, d: str) -> DataFrame:
    """All rows of all dates."""
    rows = parse_publications(read_table(spark, d, "elsevier_publication"), "0001-01-01", "9999-12-31")
    return rows.withColumns({c: F.col(c).cast("string") for c in ("article_publication_dt", "is_first_author")})


def _quoted(key: str) -> str:
    return f"'$.\"{key}\"'"


_LISTS = ", ".join(f"CASE WHEN json_type(d, {_quoted(k)}) = 'ARRAY' THEN list_transform(CAST(d -> {_quoted(k)} AS JSON[]), lambda x: x ->> '$') ELSE [] END AS {c}" for c, k in TITLES.items())
_PLAIN = ", ".join(f"d ->> {_quoted(k)} AS article_{c}" for c, k in {"url": "URL", "institution": "institution", "publisher": "publisher"}.items())
_MEMBERS = {"author_given_name": "given", "author_family_name": "family", "author_sequence": "sequence"}


@register(
    f"{_DOCUMENTS}, p AS (SELECT publication_doi AS article_doi, {_PLAIN}, {_LISTS}, d ->> '$.abstract' AS article_abstract, {_sql_date("(d -> '$.indexed')", True)} AS article_indexed_dt, {_sql_date("(d -> '$.published')", True)} AS article_publication_dt, TRY_CAST(d ->> '$.\"is-referenced-by-count\"' AS BIGINT) AS article_referenced_by_count, {_items("(d -> '$.author')")} AS al FROM x_documents), "
    f"t AS (SELECT * EXCLUDE ({', '.join(TITLES)}), unnest(generate_series(1, greatest({', '.join(f'len({c})' for c in TITLES)}))) AS n, {', '.join(TITLES)} FROM p WHERE coalesce(article_publication_dt, article_indexed_dt) IS NOT NULL), "
    f"a AS (SELECT t.*, x.a, x.place FROM t LEFT JOIN LATERAL (SELECT unnest(t.al) AS a, generate_subscripts(t.al, 1) AS place) x ON true) "
    f"SELECT DISTINCT article_doi, article_url, article_institution, article_publisher, {', '.join(f'{c}[n] AS {c}' for c in TITLES)}, article_abstract, CAST(article_indexed_dt AS VARCHAR) AS article_indexed_dt, CAST(article_publication_dt AS VARCHAR) AS article_publication_dt, article_referenced_by_count, "
    f"{', '.join(f"a ->> '$.{k}' AS {c}" for c, k in _MEMBERS.items())}, CAST(place AS BIGINT) AS author_sequence_index, regexp_replace(a ->> '$.ORCID', '^http://[^/]+/', '') AS author_orcid, y ->> '$.name' AS affiliation_identifier FROM a LEFT JOIN LATERAL (SELECT unnest({_items("(a.a -> '$.affiliation')")}) AS y) ON true",
)
def parsed_crossref(spark: SparkSession, d: str) -> DataFrame:
    """All rows of all dates."""
    rows = parse_crossref(read_table(spark, d, "crossref_publication"), "0001-01-01", "9999-12-31")
    return rows.withColumns({c: F.col(c).cast("string") for c in ("article_indexed_dt", "article_publication_dt")} | {c: F.col(c).cast("bigint") for c in ("article_referenced_by_count", "author_sequence_index")})


def queries() -> dict:
    return QUERIES


def oracle_sql() -> dict[str, str]:
    return SQL
