import json

import pytest
from pyspark.sql import functions as F

from papyrine.operators.enrich import batches_of, embed, frequent_word_language, hashed_vectors, nearest_labels, next_batch, top_terms
from papyrine.operators.parse import as_list, latest, parse_crossref, parse_member_works, parse_store_records, path_value, primary_ids, record_map
from papyrine.plans.models import MODELS, Context
from papyrine.plans.pipeline import run, select
from papyrine.sources.readers import RateLimiter, area_hierarchy, fetch_each, html_rows, page_starts, read_documents, registry, search_top, with_retries
from papyrine.sources.sinks import append, audited, delete_insert, fingerprint, is_done, mark_done, not_in, refresh, replace_partitions, upsert
from papyrine.streaming.incremental import process_new


def test_documents_by_time(spark, tmp_path):
    (tmp_path / "d.json").write_text('{"id":"1","last_modified":"2020-01-01"}\n{"id":"2","last_modified":"2020-02-01"}\n{broken\n')
    got = read_documents(spark, str(tmp_path), "id string, last_modified string", "2020-01-15", "2020-02-01")
    assert [r.id for r in got.collect()] == ["2"]


def test_fetching(spark):
    keys = spark.createDataFrame([("a",), ("a",), ("bad",), (None,)], "doi string")

    def fetch(key):
        if key == "bad":
            raise ValueError("404")
        return key.upper()

    got = {r.doi: (r.document, r.error) for r in fetch_each(keys, "doi", fetch, tries=1, per_second=100).collect()}
    assert got == {"a": ("A", None), "bad": (None, "ValueError: 404")}
    tries = []
    with pytest.raises(OSError):
        with_retries(lambda: tries.append(1) or (_ for _ in ()).throw(OSError()), 3, sleep=lambda s: None)
    assert len(tries) == 3
    now, slept = [0.0], []
    limiter = RateLimiter(2, lambda: now[0], lambda s: slept.append(s) or now.__setitem__(0, now[0] + s))
    for _ in range(3):
        limiter.wait()
    assert slept == [1.0]
    assert [tuple(r) for r in page_starts(spark, 200, 100).collect()] == [(0, 0), (1, 100), (2, 200)]
    docs = spark.createDataFrame([("soil one", 1.0, "x"), ("SOIL two", 2.0, None), ("soil three", 3.0, "y")], "t string, s double, a string")
    assert [r.t for r in search_top(docs, "t", "Soil", "s", 5, "a").collect()] == ["soil three", "soil one"]
    assert registry(spark, {"k": {"a": "1"}}, "id", ["a", "b"]).collect() == [("k", "1", None)]


def test_html_hierarchy(spark):
    html = '<table><tr class="H"><td><b>Nature N 100</b></td></tr><tr class="R"><td>N 110</td><td>Sea &amp; shore</td></tr><tr class="S"><td>Earth N 120</td></tr><tr class="R"><td>N 121</td><td>Rock č</td></tr><tr class="H"><td>Law L 200</td></tr><tr class="R"><td>L 210</td><td>Courts</td></tr></table>'
    files = spark.createDataFrame([("f", html.encode("windows-1250")), ("none", None)], "path string, content binary")
    got = [tuple(r) for r in area_hierarchy(html_rows(files, "windows-1250"), "H", "S", "R").orderBy("research_area_code").collect()]
    assert got == [("L 200", "Law", "n/a", "Other", "L 210", "Courts"), ("N 100", "Nature", "n/a", "Other", "N 110", "Sea & shore"), ("N 100", "Nature", "N 120", "Earth", "N 121", "Rock č")]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", "old"), (2, "b", "old"), (None, "n", "old")], "k int, v string, row_created_at string")
    new = spark.createDataFrame([(2, "B", "new"), (3, "C", "new"), (None, "N", "new")], "k int, v string, row_created_at string")
    assert sorted((r.k or 0, r.v, r.row_created_at) for r in upsert(rows, new, ["k"]).collect()) == [(0, "N", "new"), (0, "n", "old"), (1, "a", "old"), (2, "B", "old"), (3, "C", "new")]
    assert sorted(r.v for r in delete_insert(rows, new, F.col("k") >= 2).collect()) == ["B", "C", "N", "a", "n"]
    path = str(tmp_path / "t")
    for _ in range(2):
        replace_partitions(new.where("k is not null"), path, "k")
    assert spark.read.parquet(path).count() == 2
    refresh(rows, path + "2")
    append(rows, path + "2")
    assert spark.read.parquet(path + "2").count() == 6
    assert fingerprint(b=1, a="x") == "a:x,b:1" and audited(rows, "s").columns[-1] == "task_params_spec"
    marker = str(tmp_path / "out" / "done.json")
    assert not is_done(spark, marker)
    mark_done(spark, marker, rows=3)
    assert is_done(spark, marker) and json.loads((tmp_path / "out" / "done.json").read_text()) == {"rows": 3}


@pytest.mark.parametrize(("values", "expected"), [([1], [2]), ([1, None], []), ([], [None, 1, 2])])
def test_not_in(spark, values, expected):
    left = spark.createDataFrame([(1,), (2,), (None,)], "a int")
    got = not_in(left, "a", spark.createDataFrame([(v,) for v in values], "b int"), "b").collect()
    assert sorted((r.a for r in got), key=lambda x: x or 0) == expected


def test_parsers(spark):
    assert path_value({"a": {"b": "text"}}, "a.b.c") == "text" and path_value({"a": {}}, "a.b", 5) == 5
    assert as_list(None) == [] and as_list({"a": 1}) == [{"a": 1}]
    doc = {"message": {"URL": "u", "title": ["t1", "t2"], "subtitle": ["s"], "published": {"date-parts": [[2020, 5]]}, "author": [{"given": "A", "family": "B", "ORCID": "http://orcid.example.org/0000", "affiliation": [{"name": "x"}, {"name": "y"}]}, {"family": "C"}]}}
    raw = spark.createDataFrame([("d", json.dumps(doc)), ("no titles", json.dumps({"message": {"published": {"date-parts": [[2020]]}}})), ("bad", "{"), ("late", json.dumps({"message": {"title": ["z"], "indexed": {"timestamp": 1}}}))], "publication_doi string, publication_metadata string")
    got = parse_crossref(raw, "2020-01-01", "2020-12-31")
    assert sorted((r.article_title, r.article_subtitle or "", r.author_family_name, r.affiliation_identifier or "", r.author_sequence_index) for r in got.collect()) == [("t1", "s", "B", "x", 1), ("t1", "s", "B", "y", 1), ("t1", "s", "C", "", 2), ("t2", "", "B", "x", 1), ("t2", "", "B", "y", 1), ("t2", "", "C", "", 2)]
    assert {r.author_orcid for r in got.collect()} == {"0000", None}
    ids = [{"external-id-type": "doi", "external-id-value": v, "external-id-relationship": "self"} for v in ("10.1/a", "10.1/b")]
    work = {"put-code": 7, "url": {"value": "https://x/10.1/b"}, "title": {"title": {"value": "T"}}, "publication-date": {"year": {"value": "2020"}, "month": {"value": "02"}, "day": {"value": "31"}}, "external-ids": {"external-id": ids}}
    works = spark.createDataFrame([("m", json.dumps([{"work-summary": [work]}]), 2), ("m", "[]", 1)], "member_id string, member_works string, row_updated_at int")
    (row,) = parse_member_works(works, 2020).collect()
    assert (row.article_id, row.article_doi, row.article_eid, str(row.article_publication_dt)) == ("7", "10.1/b", None, "2020-02-29")
    assert parse_member_works(works, 2021).count() == 0
    record = {"coredata": {"eid": "e", "citedby-count": "3", "prism:coverDate": "2020-01-02", "dc:creator": {"author": {"@auid": "1", "@seq": "1"}}}, "authors": {"author": [{"@auid": "1"}, {"@auid": "2", "affiliation": {"@id": "f"}}]}, "authkeywords": {"author-keyword": {"$": "k"}}}
    (r,) = parse_store_records(spark.createDataFrame([("9", json.dumps(record)), ("x", "{")], "scopus_id string, record string")).collect()
    authors = json.loads(r.publication_authors)
    assert [(a["author_id"], a["author_sequence"], a["is_first_author"]) for a in authors] == [("1", "1", True), ("2", "2", False)] and authors[1]["author_affiliation_ids"] == [{"id": "f"}]
    assert r.publication_citation_count == 3 and json.loads(r.publication_keywords) == [{"keyword": "k"}]
    m = spark.createDataFrame([('{"a":{"n":1},"b":2}',)], "j string")
    assert sorted((x.record_key, x.record) for x in record_map(m, F.col("j")).collect()) == [("a", '{"n":1}'), ("b", "2")]


def test_latest_and_primary(spark):
    rows = spark.createDataFrame([("k", 1, "u/a", "a"), ("k", 2, "u/a", "b"), ("k", 2, "u/a", "a"), ("q", None, None, "z")], "k string, at int, u string, v string")
    assert latest(rows, "k", "at").count() == 3
    assert sorted(tuple(r) for r in primary_ids(rows, "k", "u", "v").collect()) == [("k", "a"), ("q", "z")]


def test_enrichment(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [1.0]), (5, [1.0, 1.0])], "id int, v array<double>")
    seeds = spark.createDataFrame([("s1", [1.0, 0.0], "A"), ("s1", [1.0, 0.0], "B"), ("s2", [0.0, 1.0], "C"), ("s0", [2.0, 0.0], "D")], "s string, v array<double>, l string")
    got = {(r.id, r["rank"]): r.l for r in nearest_labels(v, "id", "v", seeds, "s", "v", "l").collect()}
    assert got == {(1, 1): "D", (1, 2): "A", (1, 3): "B", (5, 1): "D", (5, 2): "A", (5, 3): "B"}
    assert nearest_labels(v, "id", "v", seeds.where("false"), "s", "v", "l").count() == 0
    texts = spark.createDataFrame([(1, "the cat and the dog in the house"), (2, "der Hund und die Katze"), (3, ""), (4, None)], "id int, t string")
    assert [r[0] for r in texts.orderBy("id").select(frequent_word_language(F.col("t"))).collect()] == ["en", "de", "n/a", "n/a"]
    terms = {r.id: r.keywords for r in top_terms(texts, "id", "t", 2).collect()}
    assert terms[3] == terms[4] == [] and terms[2] == ["katze"]
    assert {r.id for r in hashed_vectors(texts, "id", "t", 8).where("vector is not null").collect()} == {1, 2}
    assert [r.embedding for r in embed(texts, "t", lambda ts: [[len(x)] for x in ts], batch=1).orderBy("id").collect()][2:] == [[0.0], None]
    rows = spark.createDataFrame([("b", 2), ("a", 1), ("a", 3), ("c", 1)], "k string, d int")
    assert sorted(tuple(r) for r in next_batch(rows, spark.createDataFrame([("c",)], "k string"), "k", "d", 1).collect()) == [("a", 1), ("a", 3)]
    assert batches_of(rows, 3) == 2


def test_pipeline(spark, data, tmp_path):
    assert len(MODELS) == 58 and select("dim_author")[-1] == "dim_author" and select("data_ingestion").index("mart_article") > 0
    made = run(Context(spark, data), str(tmp_path), "dim_author", run_id="r1")
    assert "dim_author" in made and run(Context(spark, data), str(tmp_path), "dim_author", run_id="r1") == []
    assert spark.read.parquet(f"{tmp_path}/dim_author.parquet").count() > 0


def test_stream(spark, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "id int, t string"
    for batch in ([(1, "the and of")], [(2, "und der die")]):
        spark.createDataFrame(batch, schema).write.mode("append").parquet(source)
        process_new(spark, source, schema, lambda df: df.withColumn("l", frequent_word_language(F.col("t"))), sink, str(tmp_path / "c")).awaitTermination()
    assert sorted((r.id, r.l) for r in spark.read.parquet(sink).collect()) == [(1, "en"), (2, "de")]
