import pytest

import __spark_entry__
from papyrine.plans import catalogue, model_queries, nested_records
from tests.compare import canonical, connection

QUERIES = {**nested_records.queries(), **model_queries.queries(), **catalogue.queries()}
SQL = {**nested_records.oracle_sql(), **model_queries.oracle_sql(), **catalogue.oracle_sql()}
#: One of each kind; the driver compares all of them.
CHOSEN = ["p6_found", "stg_crossref_publication_top_3_reference", "stg_orcid_member_person", "mart_article", "int_collaboration", "fct_article_keyword_trend", "coauthor_edges", "author_experience", "novelty_index", "novelty_flags", "nearest_area_top3", "not_in_with_null", "keyword_trends", "upsert_merge", "safe_dates", "json_dates", "parsed_crossref", "not_in_orders", "text_cleanup", "running_max_window"]


@pytest.mark.parametrize("name", CHOSEN)
def test_query_equals_its_sql(spark, data, name):
    got = QUERIES[name](spark, data).toPandas()
    expected = connection(data).execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert canonical(got) == canonical(expected)


def test_publications_of_all_dates(spark, data):
    got = QUERIES["parsed_publications"](spark, data).toPandas()
    expected = connection(data).execute(SQL["parsed_publications"]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert canonical(got) == canonical(expected)
    documents = spark.read.parquet(f"{data}/elsevier_publication.parquet").where("publication_dt is not null")
    assert set(got["article_id"]) == {r[0] for r in documents.select("publication_id").collect()}
    assert str(got["article_publication_dt"].max()) > "2014-12-31"


def test_all_labelled_vectors_are_seeds(spark, data):
    got = QUERIES["nearest_area_top3"](spark, data).toPandas()
    assert canonical(got) == canonical(connection(data).execute(SQL["nearest_area_top3"]).df())
    best = got[got["rank"] == 1].set_index("vec_id")["similarity"]
    assert len(best) and (best == 1).all()  # a labelled vector is its own nearest


def test_entry(spark):
    assert __spark_entry__.entry(spark).limit(1).count() == 1
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
