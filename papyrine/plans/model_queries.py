"""Every model as a query over the lake tables, and the DuckDB SQL that checks it.

The SQL of a model is written on its own, with the models it reads as common table expressions. Both sides show doubles to
six places (a billionth up, so that halves go the same way), dates as text, arrays as text or as their length.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyrine.plans.models import MODELS, REFERENCE_KEYS, TITLE_KEYS, Context

#: Patterns for the institutions that the invented affiliations of the test tables name.
PATTERNS = (("%brenholm%", "INST_A"), ("%academy%", "INST_B"), ("%technical%", "INST_C"), ("%research council%", "INST_D"))
CUT = frozenset({"mart_collaboration", "mart_article", "mart_collaboration_by_article", "int_collaboration"})


def shown(df: DataFrame) -> DataFrame:
    """Columns in a form that both engines print alike."""
    forms = {"double": lambda c: F.round(F.col(c) + 1e-9, 6), "date": lambda c: F.col(c).cast("string"), "int": lambda c: F.col(c).cast("bigint"), "array<string>": lambda c: F.array_join(c, "|"), "array<double>": lambda c: F.size(c).cast("bigint")}
    return df.select(*((forms[kind](c) if kind in forms else F.col(c)).alias(c) for c, kind in df.dtypes))


def query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = shown(Context(spark, sf_dir, patterns=PATTERNS, cut=CUT).ref(name))
        return out.drop("row_created_at").withColumns({c: F.col(c).cast("string") for c in _THREE_VALUED.get(name, ())})

    return run


#: Booleans that may be null are shown as text.
_THREE_VALUED = {"int_collaboration": ("has_new_author_collaboration", "has_new_institution_collaboration"), "fct_article": ("is_new_collaboration",)}


def queries() -> dict:
    return {name: query(name) for name in MODELS}


_CLEAN = "CASE WHEN json_valid({c}) THEN CASE WHEN json_type({c}::JSON) = 'VARCHAR' THEN CASE WHEN json_valid({c}::JSON ->> '$') THEN ({c}::JSON ->> '$')::JSON END ELSE {c}::JSON END END"


def _clean(column: str) -> str:
    return _CLEAN.format(c=column)


def _items(value: str) -> str:
    return f"CASE json_type({value}) WHEN 'ARRAY' THEN ({value})::JSON[] WHEN 'OBJECT' THEN [{value}] END"


def _code(text: str) -> str:
    return "CASE " + " ".join(f"WHEN lower({text}) LIKE '{p}' THEN '{c}'" for p, c in PATTERNS) + " ELSE 'OTHER' END"


_TEXT = "'Reference:' || coalesce(' ' || reference_article_title, '') || coalesce(' ' || reference_article_author, '') || coalesce(' ' || reference_article_unstructured, '') || coalesce(' ' || reference_article_journal_title, '')"
_KEYS = ", ".join(f"r ->> '$.\"{name}\"' AS reference_article_{column}" for column, name in REFERENCE_KEYS.items())
_FLAGS = "is_single_author_collaboration, is_internal_collaboration, is_external_collaboration, is_alliance_collaboration"

#: name -> (other expressions it reads, SQL).
SQL: dict[str, tuple[tuple[str, ...], str]] = {
    # lake tables that are made from others
    "x_affiliation": ((), "SELECT DISTINCT article_id, article_eid, article_doi, affiliation_id FROM elsevier_publication_parsed WHERE affiliation_id IS NOT NULL"),
    "x_employment": ((), "SELECT regexp_extract(author_orcid, '(\\d{4}-\\d{4}-\\d{4}-\\d{3}[\\dX])$', 1) AS member_id, affiliation_identifier AS organization_name, min(year(article_publication_dt)) AS a, max(year(article_publication_dt)) AS b FROM crossref_publication_parsed WHERE affiliation_identifier IS NOT NULL AND article_publication_dt IS NOT NULL AND regexp_extract(author_orcid, '(\\d{4}-\\d{4}-\\d{4}-\\d{3}[\\dX])$', 1) <> '' GROUP BY ALL"),
    "x_keywords": ((), "SELECT article_id, string_split(max(article_keywords), ', ') AS article_keywords_arr FROM elsevier_publication_parsed WHERE article_keywords IS NOT NULL GROUP BY article_id"),
    "x_trend": (("x_keywords",), "SELECT k AS article_keyword, y AS year, count(*) AS publication_count FROM (SELECT article_id, unnest(list_distinct(article_keywords_arr)) AS k FROM x_keywords) JOIN (SELECT article_id, year(max(article_publication_dt)) AS y FROM elsevier_publication_parsed GROUP BY article_id) USING (article_id) GROUP BY ALL"),
    "x_documents": ((), f"SELECT publication_doi, row_created_at, CASE WHEN coalesce(json_type(d, '$.message'), 'NULL') = 'NULL' THEN d ELSE d -> '$.message' END AS d FROM (SELECT publication_doi, row_created_at, {_clean('publication_metadata')} AS d FROM crossref_publication) WHERE d IS NOT NULL"),
    "x_pair_rows": (("mart_collaboration", "mart_collaboration_by_article"), "SELECT article_id, author_id, institution_id, article_publication_dt AS dt FROM mart_collaboration JOIN mart_collaboration_by_article USING (article_id) WHERE NOT is_single_author_collaboration AND article_publication_dt >= DATE '2000-01-01' AND author_id IS NOT NULL AND institution_id IS NOT NULL"),
    "x_author_pair": (("x_pair_rows",), "SELECT a.article_id, a.author_id AS x, b.author_id AS y, row_number() OVER (PARTITION BY a.author_id, b.author_id ORDER BY a.dt, a.article_id) AS w FROM (SELECT DISTINCT article_id, author_id, dt FROM x_pair_rows) a JOIN (SELECT DISTINCT article_id, author_id FROM x_pair_rows) b ON a.article_id = b.article_id AND a.author_id < b.author_id"),
    "x_institution_pair": (("x_pair_rows",), "SELECT a.article_id, a.dt, a.institution_id AS x, b.institution_id AS y, row_number() OVER (PARTITION BY a.institution_id, b.institution_id ORDER BY a.dt, a.article_id) AS w FROM (SELECT DISTINCT article_id, institution_id, dt FROM x_pair_rows WHERE article_id IN (SELECT article_id FROM x_pair_rows GROUP BY 1 HAVING count(DISTINCT author_id) > 1)) a JOIN (SELECT DISTINCT article_id, institution_id FROM x_pair_rows) b ON a.article_id = b.article_id AND a.institution_id < b.institution_id"),
    "x_new_institution_pair": (("x_pair_rows", "x_institution_pair"), "SELECT p.article_id, p.x, p.y FROM x_institution_pair p WHERE NOT EXISTS (SELECT 1 FROM x_institution_pair q JOIN x_pair_rows u ON u.article_id = q.article_id JOIN x_pair_rows v ON v.article_id = p.article_id AND v.author_id = u.author_id WHERE q.x = p.x AND q.y = p.y AND (q.dt < p.dt OR (q.dt = p.dt AND q.article_id < p.article_id)))"),
    # staging
    "stg_crossref_publication_reference": (("x_documents",), f"SELECT publication_doi AS article_doi, no, {_KEYS} FROM (SELECT publication_doi, unnest(l) AS r, generate_subscripts(l, 1) AS no FROM (SELECT publication_doi, {_items(chr(40) + 'd -> ' + chr(39) + '$.reference' + chr(39) + chr(41))} AS l FROM x_documents))"),
    "stg_crossref_publication_top_3_reference": (("x_documents",), f"SELECT article_doi, string_agg({_TEXT}, ', ' ORDER BY rn) AS article_references FROM (SELECT *, row_number() OVER (PARTITION BY article_doi ORDER BY row_created_at DESC, no) AS rn FROM (SELECT publication_doi AS article_doi, row_created_at, no, {_KEYS} FROM (SELECT publication_doi, row_created_at, unnest(l) AS r, generate_subscripts(l, 1) AS no FROM (SELECT publication_doi, row_created_at, {_items(chr(40) + 'd -> ' + chr(39) + '$.reference' + chr(39) + chr(41))} AS l FROM x_documents))) WHERE coalesce(reference_article_title, reference_article_author, reference_article_unstructured, reference_article_journal_title) IS NOT NULL) WHERE rn <= 3 GROUP BY article_doi"),
    "stg_crossref_article": (("stg_crossref_publication_top_3_reference",), "SELECT p.*, t.article_references FROM (SELECT DISTINCT article_doi, article_publisher, article_title, article_short_title, article_subtitle, article_original_title, article_container_title, article_short_container_title, article_abstract, article_publication_dt, article_referenced_by_count AS article_citation_count FROM crossref_publication_parsed) p LEFT JOIN stg_crossref_publication_top_3_reference t USING (article_doi)"),
    "stg_crossref_author_sequence": ((), "SELECT DISTINCT article_doi, author_sequence, author_sequence_index, author_orcid FROM crossref_publication_parsed"),
    "x_seed": ((), "SELECT publication_doi, row_created_at, d, (SELECT list_sort(list(DISTINCT research_area_code)) FROM cerif_research_area) AS areas FROM x_documents"),
    "x_seed_text": (("x_documents",), f"SELECT publication_doi, string_agg({_TEXT}, ', ' ORDER BY no, {_TEXT}) AS article_references FROM (SELECT publication_doi, no, {_KEYS} FROM (SELECT publication_doi, unnest(l) AS r, generate_subscripts(l, 1) AS no FROM (SELECT publication_doi, {_items(chr(40) + 'd -> ' + chr(39) + '$.reference' + chr(39) + chr(41))} AS l FROM x_documents))) GROUP BY 1"),
    "stg_crossref_seed_article": (("x_documents", "x_seed", "x_seed_text"), "SELECT lower(publication_doi) AS article_doi, areas[length(publication_doi) % len(areas) + 1] AS research_area_code, d ->> '$.URL' AS article_url, d ->> '$.publisher' AS article_publisher, * EXCLUDE (publication_doi, areas, d, article_references, pd, dd, i, p), d ->> '$.abstract' AS article_abstract, CAST(d ->> '$.is-referenced-by-count' AS BIGINT) AS is_referenced_by_count, article_references, i AS article_indexed_dt, coalesce(p, i) AS article_publication_dt, concat_ws('\\n', 'Title: ' || coalesce(article_title, 'n/a'), 'Container Title: ' || coalesce(article_container_title, 'n/a'), 'Abstract: ' || coalesce(d ->> '$.abstract', 'n/a'), 'References: ' || coalesce(article_references, 'n/a')) AS article_embedding_input FROM (SELECT publication_doi, areas, d, " + ", ".join(f"unnest(CASE WHEN json_type(d -> '$.{k}') = 'ARRAY' THEN CAST(d -> '$.{k}' AS VARCHAR[]) ELSE [] END) AS article_{k.replace('-', '_')}" for k in TITLE_KEYS) + " FROM x_seed) LEFT JOIN x_seed_text USING (publication_doi) LEFT JOIN (SELECT DISTINCT publication_doi AS pd, d AS dd, " + ", ".join(f"coalesce(try_cast(substr(d -> '$.{k}' ->> '$.date-time', 1, 10) AS DATE), CAST(epoch_ms(try_cast(d -> '$.{k}' ->> '$.timestamp' AS BIGINT)) AS DATE), try_cast((d ->> '$.{k}.date-parts[0][0]') || '-' || lpad(d ->> '$.{k}.date-parts[0][1]', 2, '0') || '-' || lpad(d ->> '$.{k}.date-parts[0][2]', 2, '0') AS DATE)) AS {a}" for k, a in (("indexed", "i"), ("published", "p"))) + " FROM x_documents) ON pd = publication_doi AND dd = d"),
    "stg_elsevier_publication_reference": ((), f"SELECT article_id, no, r ->> '$.reference_id' AS reference_id, r ->> '$.reference_title' AS reference_title FROM (SELECT article_id, unnest(l) AS r, generate_subscripts(l, 1) AS no FROM (SELECT article_id, {_items('d')} AS l FROM (SELECT publication_id AS article_id, {_clean('publication_references')} AS d FROM elsevier_publication)))"),
    "stg_elsevier_publication_top_3_reference": ((), f"SELECT article_id, string_agg(t, ', ' ORDER BY rn) AS article_references FROM (SELECT article_id, t, row_number() OVER (PARTITION BY article_id ORDER BY row_created_at DESC, no) AS rn FROM (SELECT article_id, row_created_at, no, r ->> '$.reference_title' AS t FROM (SELECT article_id, row_created_at, unnest(l) AS r, generate_subscripts(l, 1) AS no FROM (SELECT article_id, row_created_at, {_items('d')} AS l FROM (SELECT publication_id AS article_id, row_created_at, {_clean('publication_references')} AS d FROM elsevier_publication)))) WHERE t IS NOT NULL) WHERE rn <= 3 GROUP BY article_id"),
    "stg_elsevier_article": (("stg_elsevier_publication_top_3_reference",), "SELECT p.*, t.article_references FROM (SELECT DISTINCT article_id, article_eid, article_doi, article_title, article_journal, article_abstract, article_keywords, article_citation_count, article_publication_dt FROM elsevier_publication_parsed) p LEFT JOIN stg_elsevier_publication_top_3_reference t USING (article_id)"),
    "stg_elsevier_affiliation": (("x_affiliation", "dim_institution"), f"SELECT DISTINCT article_id, article_eid, article_doi, coalesce(institution_id, 'n/a') AS institution_id FROM (SELECT a.article_id, a.article_eid, a.article_doi, i.institution_id FROM x_affiliation a LEFT JOIN dim_institution i ON a.affiliation_id = i.scopus_affiliation_id UNION ALL SELECT a.article_id, a.article_eid, a.article_doi, {_code(chr(39) + 'institute ' + chr(39) + ' || b.affiliation_id || ' + chr(39) + '_city_country' + chr(39))} FROM x_affiliation a JOIN x_affiliation b USING (article_id))"),
    "stg_orcid_article": ((), "SELECT DISTINCT article_id, article_doi, article_eid, article_title, article_journal_title, article_publication_dt FROM orcid_member_works_parsed"),
    "stg_orcid_member_employment": (("x_employment",), "SELECT member_id, md5(member_id || organization_name) AS employment_id, organization_name AS affiliation_identifier, organization_name, NULL AS organization_city, NULL AS organization_region, NULL AS organization_country, NULL AS department_name, NULL AS role_title, make_date(greatest(a, 1900), 1, 1) AS start_dt, make_date(CASE WHEN b > a THEN b ELSE 2100 END, 1, 1) AS end_dt FROM x_employment"),
    "stg_orcid_member_employment_by_work": (("stg_orcid_member_employment",), "SELECT e.member_id, e.employment_id, e.affiliation_identifier, w.article_id FROM stg_orcid_member_employment e, orcid_member_works_parsed w WHERE w.member_id = e.member_id AND w.article_publication_dt >= e.start_dt AND w.article_publication_dt <= e.end_dt"),
    "x_person": ((), f"SELECT member_id, d FROM (SELECT member_id, {_clean('member_person')} AS d FROM orcid_member_person) WHERE d IS NOT NULL"),
    "x_person_id": (("x_person",), f"SELECT member_id, x ->> '$.external-id-type' AS kind, x ->> '$.external-id-value' AS v FROM (SELECT member_id, unnest({_items(chr(40) + 'd -> ' + chr(39) + '$.external-identifiers.external-identifier' + chr(39) + chr(41))}) AS x FROM x_person)"),
    "stg_orcid_member_person": (("x_person", "x_person_id"), "SELECT p.member_id, d ->> '$.name.family-name.value' AS member_family_name, d ->> '$.name.given-names.value' AS member_given_names, s.v AS member_scopus_id, r.v AS member_researcher_id, l.v AS member_loop_id FROM x_person p LEFT JOIN (SELECT * FROM x_person_id WHERE kind = 'Scopus Author ID') s USING (member_id) LEFT JOIN (SELECT * FROM x_person_id WHERE kind = 'ResearcherID') r USING (member_id) LEFT JOIN (SELECT * FROM x_person_id WHERE kind = 'Loop profile') l USING (member_id)"),
    # marts
    "mart_elsevier_collaboration": (("stg_elsevier_affiliation",), "SELECT article_id, author_id, coalesce(institution_id, 'OTHER') AS institution_id, crossref_article_doi, author_sequence FROM (SELECT p.article_id, p.author_id, f.institution_id, c.article_doi AS crossref_article_doi, max(TRY_CAST(p.author_sequence AS INTEGER)) AS author_sequence FROM elsevier_publication_parsed p LEFT JOIN stg_elsevier_affiliation f ON f.article_id = p.article_id LEFT JOIN (SELECT DISTINCT article_doi FROM crossref_publication_parsed) c ON c.article_doi = p.article_doi GROUP BY ALL)"),
    "mart_elsevier_article": (("mart_elsevier_collaboration", "stg_elsevier_article", "stg_crossref_article"), "SELECT k.article_id, e.article_doi, e.article_eid, coalesce(e.article_title, c.article_title) AS article_title, coalesce(e.article_journal, c.article_container_title) AS article_journal_title, coalesce(e.article_abstract, c.article_abstract) AS article_abstract, coalesce(e.article_references, c.article_references) AS article_references, greatest(e.article_citation_count, c.article_citation_count, 0) AS article_citation_count, least(e.article_publication_dt, c.article_publication_dt) AS article_publication_dt FROM (SELECT DISTINCT article_id, crossref_article_doi FROM mart_elsevier_collaboration) k LEFT JOIN stg_elsevier_article e ON e.article_id = k.article_id LEFT JOIN stg_crossref_article c ON c.article_doi = k.crossref_article_doi"),
    "mart_elsevier_author": ((), "SELECT DISTINCT author_id, coalesce(author_indexed_name, author_first_name || ' ' || author_last_name) AS author_name FROM elsevier_publication_parsed"),
    "mart_orcid_collaboration_with_duplicates": (("stg_crossref_author_sequence", "stg_orcid_member_person", "stg_orcid_member_employment_by_work"), f"""SELECT * FROM (SELECT r.article_id, r.author_id, r.institution_id, max(r.article_doi) AS article_doi, min(s.author_sequence) AS author_sequence, max(s.author_sequence_index) AS author_sequence_index FROM (
        SELECT m.article_id, coalesce(p.member_scopus_id, m.member_id) AS author_id, coalesce(m.institution_id, 'OTHER') AS institution_id, m.article_doi FROM (
            SELECT o.article_id, o.member_id, c.institution_id, c.article_doi FROM x_new_works o LEFT JOIN x_places c ON c.article_doi = o.article_doi
            UNION SELECT o.article_id, o.member_id, e.institution_id, c.article_doi FROM x_new_works o LEFT JOIN x_places c ON c.article_doi = o.article_doi LEFT JOIN (SELECT member_id, article_id, {_code('affiliation_identifier')} AS institution_id FROM stg_orcid_member_employment_by_work) e ON e.member_id = o.member_id AND e.article_id = o.article_id) m
        LEFT JOIN stg_orcid_member_person p ON p.member_id = m.member_id) r
        LEFT JOIN stg_crossref_author_sequence s ON s.article_doi = r.article_doi AND s.author_orcid = r.author_id WHERE r.article_id IS NOT NULL GROUP BY 1, 2, 3) q
        WHERE article_id IN (SELECT article_id FROM (SELECT m.article_id, m.institution_id FROM (SELECT o.article_id, c.institution_id FROM x_new_works o JOIN x_places c ON c.article_doi = o.article_doi UNION SELECT o.article_id, {_code('affiliation_identifier')} FROM x_new_works o JOIN stg_orcid_member_employment_by_work e ON e.member_id = o.member_id AND e.article_id = o.article_id) m) WHERE institution_id NOT IN ('n/a', 'OTHER'))"""),
    "x_new_works": ((), "SELECT article_id, member_id, article_doi FROM orcid_member_works_parsed WHERE article_eid NOT IN (SELECT publication_eid FROM elsevier_publication)"),
    "x_places": ((), f"SELECT DISTINCT article_doi, {_code('affiliation_identifier')} AS institution_id FROM crossref_publication_parsed"),
    "mart_orcid_article_with_duplicates": (("mart_orcid_collaboration_with_duplicates", "stg_orcid_article", "stg_crossref_article"), "SELECT k.article_id, coalesce(k.article_doi, o.article_eid, o.article_doi, k.article_id) AS new_article_id, k.article_doi, o.article_eid, coalesce(o.article_title, c.article_title) AS article_title, coalesce(o.article_journal_title, c.article_container_title) AS article_journal_title, c.article_abstract, c.article_references, greatest(c.article_citation_count, 0) AS article_citation_count, least(o.article_publication_dt, c.article_publication_dt) AS article_publication_dt FROM (SELECT DISTINCT article_id, article_doi FROM mart_orcid_collaboration_with_duplicates) k LEFT JOIN stg_orcid_article o ON o.article_id = k.article_id LEFT JOIN stg_crossref_article c ON c.article_doi = k.article_doi"),
    "mart_orcid_article": (("mart_orcid_article_with_duplicates",), "SELECT DISTINCT new_article_id AS article_id, article_doi, article_eid, article_title, article_journal_title, article_abstract, article_references, article_citation_count, article_publication_dt FROM mart_orcid_article_with_duplicates"),
    "mart_orcid_author": (("stg_orcid_member_person",), "SELECT coalesce(member_scopus_id, member_id) AS author_id, member_given_names || ' ' || member_family_name AS author_name FROM stg_orcid_member_person"),
    "mart_orcid_collaboration": (("mart_orcid_collaboration_with_duplicates", "mart_orcid_article_with_duplicates"), "SELECT DISTINCT coalesce(a.new_article_id, c.article_id) AS article_id, c.author_id, c.institution_id, CASE c.author_sequence WHEN 'first' THEN 1 WHEN 'additional' THEN c.author_sequence_index END AS author_sequence FROM mart_orcid_collaboration_with_duplicates c LEFT JOIN (SELECT DISTINCT article_id, new_article_id FROM mart_orcid_article_with_duplicates) a ON a.article_id = c.article_id"),
    "x_merged": (("mart_elsevier_collaboration", "mart_orcid_collaboration"), "SELECT article_id, author_id, institution_id, author_sequence FROM mart_elsevier_collaboration UNION ALL SELECT article_id, author_id, institution_id, author_sequence FROM mart_orcid_collaboration"),
    "mart_collaboration": (("x_merged",), "SELECT article_id, author_id, institution_id, max(author_sequence) AS author_sequence FROM x_merged WHERE article_id IN (SELECT article_id FROM x_merged GROUP BY article_id HAVING count(DISTINCT author_id) <= 40) GROUP BY ALL"),
    "mart_article": (("mart_elsevier_article", "mart_orcid_article", "mart_collaboration"), "SELECT article_id, max(article_doi) AS article_doi, max(article_eid) AS article_eid, max(article_title) AS article_title, max(article_journal_title) AS article_journal_title, max(article_abstract) AS article_abstract, max(article_references) AS article_references, max(article_citation_count) AS article_citation_count, max(article_publication_dt) AS article_publication_dt FROM (SELECT * FROM mart_elsevier_article UNION ALL SELECT * FROM mart_orcid_article) WHERE article_id IN (SELECT article_id FROM mart_collaboration) GROUP BY article_id"),
    "mart_author": (("mart_elsevier_author", "mart_orcid_author", "mart_collaboration"), "SELECT author_id, max(author_name) AS author_name FROM (SELECT * FROM mart_elsevier_author UNION ALL SELECT * FROM mart_orcid_author) WHERE author_id IN (SELECT author_id FROM mart_collaboration) GROUP BY author_id"),
    "mart_collaboration_by_article": (("mart_collaboration", "mart_article"), "SELECT a.article_id, a.article_publication_dt, a.article_citation_count, coalesce(n = 1 AND i = 1, false) AS is_single_author_collaboration, coalesce(n > 1 AND i = 1, false) AS is_internal_collaboration, coalesce(i > 1, false) AS is_external_collaboration, coalesce(k > 1, false) AS is_alliance_collaboration FROM mart_article a LEFT JOIN (SELECT article_id, count(DISTINCT author_id) AS n, count(DISTINCT institution_id) AS i, count(DISTINCT institution_id) FILTER (WHERE institution_id NOT IN ('n/a', 'OTHER')) AS k FROM mart_collaboration GROUP BY 1) c USING (article_id)"),
    # analytics
    "stg_article_keyword_trend": (("x_trend",), "SELECT article_keyword, year AS article_publication_year, publication_count FROM x_trend"),
    "stg_article_keywords": (("x_keywords",), "SELECT article_id, array_to_string(article_keywords_arr, '|') AS article_keywords_arr FROM x_keywords"),
    "stg_article_keywords_flattened": (("x_keywords",), "SELECT article_id, translate(k, '”“\"', '') AS article_keyword FROM (SELECT article_id, unnest(article_keywords_arr) AS k FROM x_keywords)"),
    "stg_article_language": ((), "SELECT article_id, article_language FROM article_language"),
    "stg_article_research_area": ((), "SELECT DISTINCT article_id, research_area_code FROM article_research_area WHERE research_area_rank = 1"),
    "stg_collaboration_novelty_index": (("x_pair_rows", "x_author_pair", "x_institution_pair"), "SELECT article_id, coalesce(na, 1) * (1 + coalesce(ni, 0)) / (1 + coalesce(old, 0)) AS collaboration_novelty_index FROM (SELECT DISTINCT article_id FROM x_pair_rows) LEFT JOIN (SELECT article_id, sum(1 / (1 + w)) AS na, count(*) FILTER (WHERE w > 1) AS old FROM x_author_pair GROUP BY 1) USING (article_id) LEFT JOIN (SELECT article_id, sum(1 / (1 + w)) AS ni FROM x_institution_pair GROUP BY 1) USING (article_id)"),
    "stg_collaboration_novelty_metadata": (("x_pair_rows", "x_author_pair", "x_new_institution_pair"), "SELECT DISTINCT article_id, author_id, institution_id, (article_id, author_id) IN (SELECT article_id, unnest([x, y]) FROM x_author_pair WHERE w = 1) AS has_new_author_collaboration, (article_id, institution_id) IN (SELECT article_id, unnest([x, y]) FROM x_new_institution_pair) AS has_new_institution_collaboration FROM x_pair_rows"),
    "stg_new_author_pair": (("x_author_pair",), "SELECT article_id, x AS author_id, y AS co_author_id, w = 1 AS is_new_author_pair FROM x_author_pair"),
    # intermediate
    "int_article_citation_normalized": (("mart_article", "stg_article_research_area"), "SELECT article_id, n::BIGINT AS article_citation_count, round(CASE WHEN c IS NULL OR c IN (0, 1) THEN n ELSE n / log10(c) END, 2) AS article_citation_normalized_count FROM (SELECT article_id, research_area_code AS r, year(article_publication_dt) AS y, sum(article_citation_count) AS n FROM mart_article LEFT JOIN stg_article_research_area USING (article_id) GROUP BY ALL) LEFT JOIN (SELECT research_area_code AS r, year(article_publication_dt) AS y, sum(article_citation_count) AS c FROM mart_article LEFT JOIN stg_article_research_area USING (article_id) GROUP BY ALL) USING (r, y)"),
    "int_article_keyword": (("stg_article_keywords_flattened", "stg_article_research_area"), "SELECT k.article_id, k.article_keyword, r.research_area_code FROM stg_article_keywords_flattened k LEFT JOIN stg_article_research_area r USING (article_id)"),
    "int_article_keyword_trend": (("x_trend",), "SELECT trim(translate(article_keyword, '”“\"', '')) AS article_keyword, year AS article_publication_year, publication_count FROM x_trend"),
    "int_collaboration": (("mart_collaboration", "mart_collaboration_by_article", "stg_article_research_area", "stg_collaboration_novelty_metadata"), f"SELECT c.article_id, c.author_id, coalesce(r.research_area_code, 'n/a') AS research_area_code, c.institution_id, CASE WHEN c.author_sequence = 1 AND m = 1 THEN 'singleAuthor' WHEN c.author_sequence = 1 THEN 'firstAuthor' WHEN c.author_sequence = m THEN 'lastAuthor' WHEN c.author_sequence IS NOT NULL THEN 'middleAuthor' ELSE 'n/a' END AS author_sequence_type, a.article_publication_dt, {_FLAGS}, v.has_new_author_collaboration, v.has_new_institution_collaboration FROM (SELECT *, max(author_sequence) OVER (PARTITION BY article_id) AS m FROM mart_collaboration) c JOIN mart_collaboration_by_article a ON a.article_id = c.article_id AND a.article_publication_dt >= DATE '2000-01-01' LEFT JOIN stg_article_research_area r ON r.article_id = c.article_id LEFT JOIN stg_collaboration_novelty_metadata v ON v.article_id = c.article_id AND v.author_id = c.author_id AND v.institution_id = c.institution_id"),
    "int_author_experience_by_article": (("int_collaboration",), "SELECT c.author_id, c.article_id, count(DISTINCT d.article_id) AS article_count FROM (SELECT DISTINCT author_id, article_id, article_publication_dt AS t FROM int_collaboration) c JOIN (SELECT DISTINCT author_id, article_id, article_publication_dt AS t FROM int_collaboration) d ON d.author_id = c.author_id AND d.t < c.t GROUP BY ALL"),
    # final
    "dim_article": (("mart_article", "x_keywords", "mart_collaboration_by_article"), f"SELECT a.article_id, coalesce(a.article_doi, 'n/a') AS article_doi, coalesce(a.article_eid, 'n/a') AS article_eid, coalesce(a.article_title, 'n/a') AS article_title, coalesce(a.article_journal_title, 'n/a') AS article_journal_title, a.article_publication_dt, coalesce('{{' || array_to_string(list_transform(k.article_keywords_arr, lambda x: CASE WHEN x = '' OR upper(x) = 'NULL' OR regexp_matches(x, '[\\s,{{}}\"\\\\]') THEN '\"' || replace(replace(x, '\\', '\\\\'), '\"', '\\\"') || '\"' ELSE x END), ',') || '}}', 'n/a') AS article_keywords, coalesce(l.article_language, 'n/a') AS article_language, {_FLAGS} FROM mart_article a LEFT JOIN x_keywords k USING (article_id) LEFT JOIN article_language l USING (article_id) LEFT JOIN mart_collaboration_by_article c USING (article_id)"),
    "dim_author": (("mart_author",), "SELECT author_id, coalesce(author_name, 'n/a') AS author_name FROM mart_author"),
    "dim_institution": ((), "SELECT * FROM (VALUES ('INST_A', 'Institute A', 'A', 'Norvia', '60900001', 'no', 'NO'), ('INST_B', 'Institute B', 'B', 'Caldora', '60900017', 'ca', 'CA'), ('INST_C', 'Institute C', 'C', 'Quorin', '60900010', 'qu', 'QU'), ('OTHER', 'Other', 'n/a', 'n/a', 'n/a', 'n/a', 'n/a')) t(institution_id, institution_name, institution_pretty_name, institution_country, scopus_affiliation_id, institution_language, institution_country_iso2)"),
    "dim_research_area": ((), "SELECT research_branch_code, research_branch_name, research_subbranch_code, research_subbranch_name, research_area_code, research_area_name FROM cerif_research_area UNION ALL SELECT 'n/a', 'n/a', 'n/a', 'n/a', 'n/a', 'n/a'"),
    "fct_article": (("mart_collaboration_by_article", "stg_article_research_area", "int_article_citation_normalized", "stg_collaboration_novelty_index", "int_collaboration"), f"SELECT c.article_id, coalesce(r.research_area_code, 'n/a') AS research_area_code, n.article_citation_count, n.article_citation_normalized_count, c.article_publication_dt, {_FLAGS}, w.is_new_collaboration, coalesce(i.collaboration_novelty_index, 0) AS collaboration_novelty_index FROM mart_collaboration_by_article c LEFT JOIN stg_article_research_area r USING (article_id) LEFT JOIN int_article_citation_normalized n USING (article_id) LEFT JOIN stg_collaboration_novelty_index i USING (article_id) LEFT JOIN (SELECT article_id, bool_or(has_new_author_collaboration) OR bool_or(has_new_institution_collaboration) AS is_new_collaboration FROM int_collaboration GROUP BY 1) w USING (article_id)"),
    "fct_article_keyword": (("int_article_keyword",), "SELECT article_id, article_keyword, research_area_code FROM int_article_keyword"),
    "x_trend_area": (("int_article_keyword_trend", "int_article_keyword"), "SELECT t.article_keyword AS k, t.article_publication_year AS y, t.publication_count AS n, m.research_area_code AS r FROM int_article_keyword_trend t JOIN int_article_keyword m ON m.article_keyword = t.article_keyword"),
    "x_trend_norm": (("x_trend_area",), "SELECT DISTINCT k, y, n, r, CASE WHEN n <= 1 THEN n ELSE CAST(trunc(n::DOUBLE / log10(1 + total)) AS BIGINT) END AS norm FROM x_trend_area JOIN (SELECT r, y, sum(n) AS total FROM x_trend_area GROUP BY r, y) USING (r, y)"),
    "x_trend_roll": (("x_trend_norm",), "SELECT *, avg(yoy) OVER (PARTITION BY k, r ORDER BY y, n ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS roll FROM (SELECT *, (norm - p) / nullif(p, 0) AS yoy FROM (SELECT *, lag(norm) OVER (PARTITION BY k, r ORDER BY y, n) AS p FROM x_trend_norm))"),
    "fct_article_keyword_trend": (("x_trend_roll",), "SELECT k AS article_keyword, r AS research_area_code, y AS article_publication_year, n AS publication_count, norm AS publication_normalized_count, yoy AS publication_count_yoy, roll AS publication_count_yoy_3yr_rolling_avg, b1 AS publication_count_baseline, b2 AS publication_normalized_count_baseline, b3 AS publication_count_yoy_baseline, b4 AS publication_count_yoy_3yr_rolling_avg_baseline, roll - b4 AS publication_count_yoy_3yr_rolling_avg_diff, CAST(trunc((roll - b4) / CASE WHEN b4 = 0 THEN 1 ELSE b4 END) AS BIGINT) AS publication_count_yoy_3yr_rolling_avg_diff_pct, coalesce(roll > b4 + 0.02, false) AS is_trend_positive FROM x_trend_roll JOIN (SELECT r, y, quantile_cont(n, 0.5) AS b1, quantile_cont(norm, 0.5) AS b2, quantile_cont(yoy, 0.5) AS b3, quantile_cont(roll, 0.5) AS b4 FROM x_trend_roll GROUP BY r, y) USING (r, y)"),
    "fct_article_by_keyword_popularity": (("fct_article", "fct_article_keyword", "fct_article_keyword_trend"), "SELECT f.article_id, CASE WHEN f.is_new_collaboration THEN 'new' ELSE 'existing' END AS collaboration_type, count(DISTINCT w.article_keyword) FILTER (WHERE t.is_trend_positive) AS keyword_popularity, sum(t.publication_count_yoy_3yr_rolling_avg_diff) AS keyword_popularity_index FROM fct_article f JOIN fct_article_keyword w ON w.article_id = f.article_id JOIN (SELECT DISTINCT article_keyword, research_area_code, article_publication_year, is_trend_positive, publication_count_yoy_3yr_rolling_avg_diff FROM fct_article_keyword_trend) t ON t.article_keyword = w.article_keyword AND t.research_area_code = w.research_area_code AND t.article_publication_year = year(f.article_publication_dt) WHERE NOT f.is_single_author_collaboration GROUP BY ALL"),
    "fct_collaboration": (("int_collaboration", "int_author_experience_by_article"), "SELECT * EXCLUDE (article_count) REPLACE (coalesce(has_new_author_collaboration, false) AS has_new_author_collaboration, coalesce(has_new_institution_collaboration, false) AS has_new_institution_collaboration), coalesce(article_count, 0) AS author_article_count FROM (SELECT i.*, e.article_count FROM int_collaboration i LEFT JOIN int_author_experience_by_article e ON e.article_id = i.article_id AND e.author_id = i.author_id)"),
    "fct_new_author_pair": (("stg_new_author_pair",), "SELECT * FROM stg_new_author_pair"),
    # graph
    "graph_author": (("int_collaboration",), "SELECT author_id FROM int_collaboration GROUP BY author_id HAVING count(DISTINCT article_id) >= 5"),
    "graph_article": (("int_collaboration", "graph_author"), "SELECT DISTINCT article_id, article_publication_dt FROM int_collaboration WHERE author_id IN (SELECT author_id FROM graph_author)"),
    "graph_article_embedding": (("graph_article",), "SELECT a.article_id, a.article_publication_dt, coalesce(len(e.article_text_embedding), NULL) AS article_embedding FROM graph_article a JOIN article_text_embedding e ON e.article_id = a.article_id"),
    "graph_author_top_keywords": (("fct_article_keyword", "graph_article", "fct_article_keyword_trend"), "SELECT w.article_id, a.article_publication_dt, w.article_keyword, w.research_area_code, t.article_publication_year - year(a.article_publication_dt) AS kpi_year, t.publication_count_yoy_3yr_rolling_avg_diff AS keyword_popularity_index FROM fct_article_keyword w JOIN graph_article a ON a.article_id = w.article_id JOIN (SELECT article_keyword FROM fct_article_keyword GROUP BY 1 ORDER BY count(DISTINCT article_id) DESC, article_keyword LIMIT 200) k ON k.article_keyword = w.article_keyword JOIN fct_article_keyword_trend t ON t.article_keyword = w.article_keyword AND t.research_area_code = w.research_area_code AND t.article_publication_year BETWEEN year(a.article_publication_dt) - 5 AND year(a.article_publication_dt) - 1"),
    "x_graph": (("int_collaboration", "graph_author", "graph_article"), "SELECT * FROM int_collaboration WHERE author_id IN (SELECT author_id FROM graph_author) AND article_id IN (SELECT article_id FROM graph_article)"),
    "graph_edge_co_authors": (("x_graph",), "SELECT p.author_id, q.author_id AS co_author_id, min(strftime(p.article_publication_dt, '%Y%m%d')) AS time, count(DISTINCT CASE WHEN p.is_alliance_collaboration THEN p.article_id END) AS alliance_collaboration_count FROM x_graph p JOIN x_graph q ON q.article_id = p.article_id AND q.author_id <> p.author_id GROUP BY ALL HAVING count(DISTINCT p.article_id) >= 5"),
    "graph_temporal_edge_co_authors": (("graph_edge_co_authors",), "SELECT * FROM graph_edge_co_authors"),
    "graph_node_author_article": (("x_graph", "int_article_citation_normalized", "stg_collaboration_novelty_index"), "SELECT g.author_id, g.article_id, g.article_publication_dt, sum(n.article_citation_normalized_count) AS article_citation_normalized_count, quantile_cont(v.collaboration_novelty_index, 0.5) AS collaboration_novelty_index FROM x_graph g LEFT JOIN int_article_citation_normalized n USING (article_id) LEFT JOIN stg_collaboration_novelty_index v USING (article_id) GROUP BY ALL"),
    "graph_edge_publishes": (("x_graph",), "SELECT DISTINCT author_id, article_id, strftime(article_publication_dt, '%Y%m%d') AS time FROM x_graph"),
    "graph_node_article": (("fct_article", "graph_article_embedding"), "SELECT e.article_id, e.article_embedding, f.article_citation_normalized_count, CASE WHEN f.is_alliance_collaboration THEN 1 ELSE 0 END AS is_alliance_collaboration, f.collaboration_novelty_index FROM graph_article_embedding e JOIN fct_article f ON f.article_id = e.article_id"),
    "graph_node_author": (("graph_author",), "SELECT author_id, 1 AS dummy_feature FROM graph_author"),
}
SQL["mart_orcid_collaboration_with_duplicates"] = ((*SQL["mart_orcid_collaboration_with_duplicates"][0], "x_new_works", "x_places"), SQL["mart_orcid_collaboration_with_duplicates"][1])

#: Columns that are shown as text (dates) or to six places (doubles).
_DATES = {"article_publication_dt", "article_indexed_dt", "start_dt", "end_dt"}
_DOUBLES = {"article_citation_normalized_count", "collaboration_novelty_index", "keyword_popularity_index", "publication_count_yoy", "publication_count_yoy_3yr_rolling_avg", "publication_count_baseline", "publication_normalized_count_baseline", "publication_count_yoy_baseline", "publication_count_yoy_3yr_rolling_avg_baseline", "publication_count_yoy_3yr_rolling_avg_diff"}


def _sql(name: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        for dep in SQL[n][0]:
            if dep not in order:
                visit(dep)
        order.append(n)

    visit(name)
    body = f"WITH {', '.join(f'{n} AS MATERIALIZED ({SQL[n][1]})' for n in order)} " if order else ""
    replaced = [f"CAST({c} AS VARCHAR) AS {c}" for c in sorted(_DATES) if _gives(name, c)] + [f"round({c} + 1e-9, 6) AS {c}" for c in sorted(_DOUBLES) if _gives(name, c)]
    replaced += [f"CAST({c} AS VARCHAR) AS {c}" for c in _THREE_VALUED.get(name, ())] + [f"CAST({c} AS BIGINT) AS {c}" for c in _INTEGERS.get(name, ())]
    return body + f"SELECT *{' REPLACE (' + ', '.join(replaced) + ')' if replaced else ''} FROM {name}"


def _gives(name: str, column: str) -> bool:
    return column in GIVES.get(name, ())


#: Whole numbers that are narrower in the tables than in the query.
_INTEGERS = {
    "stg_crossref_article": ("article_citation_count",), "stg_crossref_author_sequence": ("author_sequence_index",), "stg_elsevier_article": ("article_citation_count",), "mart_elsevier_collaboration": ("author_sequence",), "mart_elsevier_article": ("article_citation_count",), "mart_collaboration": ("author_sequence",),
    "mart_orcid_collaboration_with_duplicates": ("author_sequence_index",), "mart_orcid_article_with_duplicates": ("article_citation_count",), "mart_orcid_article": ("article_citation_count",), "mart_orcid_collaboration": ("author_sequence",), "mart_article": ("article_citation_count",),
    "mart_collaboration_by_article": ("article_citation_count",), "graph_node_author": ("dummy_feature",), "graph_node_article": ("is_alliance_collaboration",),
}
#: Which of those columns a model gives.
GIVES = {
    "stg_crossref_seed_article": ("article_indexed_dt", "article_publication_dt"), "stg_orcid_member_employment": ("start_dt", "end_dt"), "stg_crossref_article": ("article_publication_dt",), "stg_elsevier_article": ("article_publication_dt",), "stg_orcid_article": ("article_publication_dt",), "mart_elsevier_article": ("article_publication_dt",), "mart_orcid_article_with_duplicates": ("article_publication_dt",),
    "mart_orcid_article": ("article_publication_dt",), "mart_article": ("article_publication_dt",), "mart_collaboration_by_article": ("article_publication_dt",), "stg_collaboration_novelty_index": ("collaboration_novelty_index",), "int_article_citation_normalized": ("article_citation_normalized_count",),
    "int_collaboration": ("article_publication_dt",), "dim_article": ("article_publication_dt",), "fct_article": ("article_publication_dt", "article_citation_normalized_count", "collaboration_novelty_index"), "fct_article_keyword_trend": tuple(c for c in _DOUBLES if c.startswith("publication")),
    "fct_article_by_keyword_popularity": ("keyword_popularity_index",), "fct_collaboration": ("article_publication_dt",), "graph_article": ("article_publication_dt",), "graph_article_embedding": ("article_publication_dt",), "graph_author_top_keywords": ("article_publication_dt", "keyword_popularity_index"),
    "graph_node_author_article": ("article_publication_dt", "article_citation_normalized_count", "collaboration_novelty_index"), "graph_node_article": ("article_citation_normalized_count", "collaboration_novelty_index"),
}


def oracle_sql() -> dict[str, str]:
    return {name: _sql(name) for name in MODELS}
