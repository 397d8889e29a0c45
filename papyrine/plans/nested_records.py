"""Flat tables of the nested lake documents (problem 6): authors, affiliations, references, external identifiers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from papyrine.operators.shredding import relation, relations, shred
from papyrine.session import read_table

#: name of the shredded set -> table, key column, document column, member that may wrap the document, leaf columns.
#: The first leaf column of a relation carries its structure only.
SOURCES = {
    "crossref": ("crossref_publication", "publication_doi", "publication_metadata", "message"),
    "person": ("orcid_member_person", "member_id", "member_person", None),
    "elsevier": ("elsevier_publication", "publication_id", "publication_authors", None),
}

#: relation -> source, leaf path that carries its structure, depth of the ancestor whose elements are its rows, value leaves.
RELATIONS = {
    "crossref_author": ("crossref", "author[].affiliation[]", 1, {"given": "author[].given", "family": "author[].family", "orcid": "author[].ORCID", "sequence": "author[].sequence"}),
    "crossref_affiliation": ("crossref", "author[].affiliation[]", 2, {"name": "author[].affiliation[].name"}),
    "crossref_reference": ("crossref", "reference[]", 1, {"key": "reference[].key", "doi": "reference[].DOI", "article_title": "reference[].article-title", "year": "reference[].year", "unstructured": "reference[].unstructured"}),
    "person_external_identifier": ("person", "external-identifiers.external-identifier[]", 1, {"id_type": "external-identifiers.external-identifier[].external-id-type", "id_value": "external-identifiers.external-identifier[].external-id-value"}),
    "elsevier_author": ("elsevier", "[].author_affiliation_ids[]", 1, {"author_id": "[].author_id", "indexed_name": "[].author_indexed_name", "first_name": "[].author_first_name", "last_name": "[].author_last_name"}),
    "elsevier_author_affiliation": ("elsevier", "[].author_affiliation_ids[]", 2, {"affiliation_id": "[].author_affiliation_ids[].id"}),
}


def _shredded(spark: SparkSession, sf_dir: str, source: str, paths: dict[str, str], values: bool) -> DataFrame:
    table, key, document, unwrap = SOURCES[source]
    return shred(read_table(spark, sf_dir, table), key, document, "row_created_at", paths, unwrap, values)


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each flattened child of every relation: relation_name, parent_key, child_no, grandchild_no.

    Only level sequences are carried; no leaf value is shuffled.
    """
    parts = []
    for source, (_, key, _, _) in SOURCES.items():
        own = {name: spec for name, spec in RELATIONS.items() if spec[0] == source}
        leaf = {path: f"leaf{i}" for i, path in enumerate(dict.fromkeys(spec[1] for spec in own.values()))}
        base = _shredded(spark, sf_dir, source, {v: k for k, v in leaf.items()}, values=False)
        parts.append(relations(base, key, {name: (leaf[path], path, depth) for name, (_, path, depth, _) in own.items()}))
    return reduce(DataFrame.unionByName, parts)


def table(name: str):
    """A query that gives one relation with its values, linked to its parents by key and positions."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        source, path, depth, values = RELATIONS[name]
        key = SOURCES[source][1]
        leaves = {"levels": path, **{f"v_{column}": leaf for column, leaf in values.items()}}
        base = _shredded(spark, sf_dir, source, leaves, values=True)
        return relation(base, key, "levels", path, depth, {column: f"v_{column}" for column in values})

    return query


def queries() -> dict:
    return {"p6_found": found, **{f"p6_{name}": table(name) for name in RELATIONS}}


def _latest_sql(table: str, key: str, document: str) -> str:
    """The latest readable version of each key as (parent_key, doc JSON), for DuckDB."""
    return f"""SELECT k AS parent_key, doc FROM (
        SELECT k, row_created_at, CASE WHEN json_type(CAST(raw AS JSON)) = 'VARCHAR' THEN CASE WHEN json_valid(CAST(raw AS JSON) ->> '$') THEN CAST(CAST(raw AS JSON) ->> '$' AS JSON) END ELSE CAST(raw AS JSON) END AS doc
        FROM (SELECT {key} AS k, row_created_at, CASE WHEN json_valid({document}) THEN {document} END AS raw FROM {table}) WHERE raw IS NOT NULL AND k IS NOT NULL
    ) WHERE doc IS NOT NULL QUALIFY row_number() OVER (PARTITION BY k ORDER BY row_created_at DESC, CAST(doc AS VARCHAR)) = 1"""


def _list_sql(value: str) -> str:
    """A JSON value as a list of JSON: a list as it is, null or absent as empty, else a list of one."""
    return f"CASE json_type({value}) WHEN 'ARRAY' THEN CAST({value} AS JSON[]) WHEN 'NULL' THEN CAST([] AS JSON[]) ELSE CASE WHEN {value} IS NULL THEN CAST([] AS JSON[]) ELSE [{value}] END END"


def _children_sql(parent: str, value: str) -> str:
    return f"SELECT parent_key, unnest({_list_sql(value)}) AS item, generate_subscripts({_list_sql(value)}, 1) AS no FROM {parent}"


def _table_sql(name: str) -> str:
    """The SQL of table(name)."""
    source, path, depth, values = RELATIONS[name]
    table_name, key, document, unwrap = SOURCES[source]
    base = _latest_sql(table_name, key, document)
    if unwrap:
        base = f"SELECT parent_key, CASE WHEN json_type(doc -> '$.{unwrap}') IS NULL OR json_type(doc -> '$.{unwrap}') = 'NULL' THEN doc ELSE doc -> '$.{unwrap}' END AS doc FROM ({base})"
    steps = [step.removesuffix(".") for step in path.split("[]")][:depth]
    first = f"(doc -> '$.{steps[0]}')" if steps[0] else "doc"
    rows = f"SELECT parent_key, no AS child_no, 0 AS grandchild_no, item FROM (SELECT parent_key, unnest(l) AS item, generate_subscripts(l, 1) AS no FROM (SELECT parent_key, {_list_sql(first)} AS l FROM ({base})))"
    if depth == 2:
        rows = f"SELECT parent_key, child_no, no AS grandchild_no, item FROM (SELECT parent_key, child_no, unnest(l) AS item, generate_subscripts(l, 1) AS no FROM (SELECT parent_key, child_no, {_list_sql(chr(40) + 'item -> ' + chr(39) + '$' + steps[1] + chr(39) + chr(41))} AS l FROM ({rows})))"
    shown = ", ".join(f"item ->> '$.\"{leaf.rpartition('[].')[2]}\"' AS {column}" for column, leaf in values.items())
    return f"SELECT parent_key, child_no::INTEGER AS child_no, grandchild_no::INTEGER AS grandchild_no, {shown} FROM ({rows}) WHERE json_type(item) IS NOT NULL AND json_type(item) <> 'NULL'"


def oracle_sql() -> dict[str, str]:
    tables = {f"p6_{name}": _table_sql(name) for name in RELATIONS}
    live = "json_type(item) IS NOT NULL AND json_type(item) <> 'NULL'"
    return tables | {
        "p6_found": f"""WITH c0 AS ({_latest_sql("crossref_publication", "publication_doi", "publication_metadata")}),
    c AS (SELECT parent_key, CASE WHEN json_type(doc -> '$.message') IS NULL OR json_type(doc -> '$.message') = 'NULL' THEN doc ELSE doc -> '$.message' END AS doc FROM c0),
    p AS ({_latest_sql("orcid_member_person", "member_id", "member_person")}),
    e AS ({_latest_sql("elsevier_publication", "publication_id", "publication_authors")}),
    ca AS ({_children_sql("c", "(doc -> '$.author')")}),
    cr AS ({_children_sql("c", "(doc -> '$.reference')")}),
    px AS ({_children_sql("p", "(doc -> '$.external-identifiers.external-identifier')")}),
    ea AS ({_children_sql("e", "doc")}),
    caf AS (SELECT parent_key, parent_no, unnest(l) AS item, generate_subscripts(l, 1) AS no FROM (SELECT parent_key, no AS parent_no, {_list_sql("(item -> '$.affiliation')")} AS l FROM ca)),
    eaf AS (SELECT parent_key, parent_no, unnest(l) AS item, generate_subscripts(l, 1) AS no FROM (SELECT parent_key, no AS parent_no, {_list_sql("(item -> '$.author_affiliation_ids')")} AS l FROM ea)),
    r AS (SELECT 'crossref_author' AS relation_name, parent_key, no AS child_no, 0 AS grandchild_no FROM ca WHERE {live}
    UNION ALL SELECT 'crossref_reference', parent_key, no, 0 FROM cr WHERE {live}
    UNION ALL SELECT 'crossref_affiliation', parent_key, parent_no, no FROM caf WHERE {live}
    UNION ALL SELECT 'person_external_identifier', parent_key, no, 0 FROM px WHERE {live}
    UNION ALL SELECT 'elsevier_author', parent_key, no, 0 FROM ea WHERE {live}
    UNION ALL SELECT 'elsevier_author_affiliation', parent_key, parent_no, no FROM eaf WHERE {live})
SELECT relation_name, parent_key, CAST(child_no AS INTEGER) AS child_no, CAST(grandchild_no AS INTEGER) AS grandchild_no FROM r"""
    }
