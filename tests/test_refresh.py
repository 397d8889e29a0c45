import datetime as dt
import json
import shutil
from pathlib import Path

import pytest

from papyrine.config import EngineConfig
from papyrine.operators.parse import parse_affiliations, record_affiliations, record_authors, record_references
from papyrine.plans.refresh import STEPS, run_refresh, window
from papyrine.sources.readers import access_token, fetch_each, final, member_documents, with_retries, yearly_counts
from papyrine.sources.sinks import append_in_parts


class Failed(Exception):
    def __init__(self, status):
        super().__init__(str(status))
        self.status = status


def test_giving_up():
    tries = []

    def call(status):
        tries.append(status)
        raise Failed(status)

    for status, times in ((404, 1), (503, 3)):
        tries.clear()
        with pytest.raises(Failed):
            with_retries(lambda s=status: call(s), 3, sleep=lambda s: None)
        assert len(tries) == times
    assert not final(OSError()) and access_token(lambda form: {"access_token": form["client_id"]}, "id", "s") == "id"
    with pytest.raises(PermissionError):
        access_token(lambda form: {"error": "denied"}, "id", "s")


def test_members_and_counts(spark):
    members = spark.createDataFrame([("m1",), (None,), ("m1",), ("m2",)], "member_id string")
    answer = lambda path: json.dumps({"group": [{"work-summary": []}], "affiliation-group": [1]}) if path.startswith("m1/") else (_ for _ in ()).throw(Failed(404))
    assert sorted((r.member_id, r.member_works, r.error is None) for r in member_documents(members, "works", answer).collect()) == [("m1", '[{"work-summary":[]}]', True), ("m2", None, False)]
    assert {r.member_id: r.member_employments for r in member_documents(members, "employments", answer).collect()}["m1"] == "[1]"
    assert fetch_each(members, "member_id", lambda k: k, per_second=2).rdd.getNumPartitions() <= 2  # calls of all tasks together
    words = spark.createDataFrame([("soil science",), ("soil science",), (None,)], "k string")
    got = yearly_counts(words, "k", lambda key: json.dumps({"message": {"total-results": int(key[:4])}}), 2019, 2020)
    assert sorted(tuple(r) for r in got.collect()) == [("soil science", 2019, 2019), ("soil science", 2020, 2020)]


def test_parts_of_a_run(spark, tmp_path):
    keys, path, calls = spark.createDataFrame([(i,) for i in range(7)] + [(None,), (3,)], "k int"), str(tmp_path / "t"), []

    def step(rows):
        calls.append(rows.count())
        if len(calls) == 3:
            raise RuntimeError("lost")
        return rows.selectExpr("k", "k * 2 as v")

    with pytest.raises(RuntimeError):
        append_in_parts(keys, "k", step, path, 3)
    assert spark.read.parquet(path).count() == 6
    assert append_in_parts(keys, "k", step, path, 3) == 1
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == list(range(7))


def test_records(spark):
    record = {"coredata": {"eid": "e", "prism:doi": "d"}, "affiliation": {"@id": "6", "affilname": "N", "affiliation-city": "C"}, "authors": {"author": [{"@auid": "1", "@seq": ""}, {"@auid": "2", "@seq": "9"}]}, "item": {"bibrecord": {"tail": {"bibliography": {"reference": [{"@id": "r", "ref-info": {"ref-text": "t"}}, {"@id": "s", "ref-info": None}]}}}}}
    assert [a["author_sequence"] for a in record_authors(record)] == ["0", "9"]
    assert record_references(record) == [{"reference_id": "r", "reference_title": "t"}, {"reference_id": "s", "reference_title": None}]
    assert record_affiliations(record) == [{"affiliation_id": "6", "affiliation_name": "N", "affiliation_city": "C", "affiliation_country": None}]
    rows = parse_affiliations(spark.createDataFrame([("9", json.dumps(record)), ("9", json.dumps(record)), ("x", "{"), ("n", json.dumps({"affiliation": [{"affilname": "no id"}]}))], "scopus_id string, record string")).collect()
    assert [(r.publication_id, r.publication_eid, r.publication_affiliation_id, json.loads(r.publication_affiliations)) for r in rows] == [("9", "e", "6", [{"affiliation_name": "N", "affiliation_city": "C"}])]


def test_windows():
    assert window("week", dt.date(2024, 3, 3)) == ("2024-02-25", "2024-03-03") and window("month", dt.date(2024, 3, 1))[0] == "2024-01-31"
    with pytest.raises(KeyError):
        window("year", dt.date(2024, 1, 1))


def test_refresh(spark, data, tmp_path):
    lake = tmp_path / "lake"
    for file in Path(data).glob("*.parquet"):  # tables of a lake are folders
        (lake / file.name).mkdir(parents=True)
        shutil.copyfile(file, lake / file.name / "part.parquet")
    config, today = EngineConfig(lake=str(lake), warehouse=str(tmp_path / "warehouse")), dt.date(2020, 1, 15)
    before = spark.read.parquet(f"{lake}/elsevier_publication_parsed.parquet").count()
    doc = {"URL": "u", "title": ["A new one"], "published": {"date-parts": [[2020, 1, 10]]}, "author": [{"given": "A", "family": "B"}]}

    def publications(run):
        assert (run.start, run.end) == ("2019-12-16", "2020-01-15")
        return spark.createDataFrame([("10.1/new", json.dumps(doc))], "publication_doi string, publication_metadata string")

    seams = {"crossref_publication": publications, "language": lambda rows: rows.selectExpr("article_id", "'xx' as article_language")}
    ingestion = tuple(name for name, _ in STEPS if name.startswith(("fetch", "parse")))
    assert run_refresh(spark, config, "month", today, seams, only=ingestion) == list(ingestion)
    assert run_refresh(spark, config, "month", today, seams, only=ingestion) == []
    assert spark.read.parquet(f"{lake}/crossref_publication_parsed.parquet").where("article_doi = '10.1/new'").count() == 1
    assert spark.read.parquet(f"{lake}/elsevier_publication_parsed.parquet").count() >= before * 0.9
    spark.createDataFrame([("a1", "10.1/x", "T", "soils and rivers"), ("a2", None, "U", None)], "article_id string, article_doi string, article_title string, article_abstract string").write.parquet(f"{config.warehouse}/mart_article.parquet")
    enrichment = ("classify_language", "embed_articles", "generate_keywords")
    assert run_refresh(spark, config, "month", today, seams, only=enrichment) == list(enrichment)
    table = lambda name: spark.read.parquet(f"{lake}/{name}.parquet")
    assert table("article_language").where("article_language = 'xx'").count() == 2
    assert table("article_keywords").where("article_id = 'a1'").first()["article_keywords_arr"]
    assert table("article_text_embedding").where("article_id in ('a1', 'a2') and article_text_embedding is not null").count() == 2
    run_refresh(spark, config, "week", today, seams, only=enrichment)
    assert table("article_language").where("article_language = 'xx'").count() == 2  # what is there isn't done again
