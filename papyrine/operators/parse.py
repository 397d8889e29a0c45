"""Raw documents to flat rows: publications of both sources, works of members, and records of the document store."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from papyrine.functions.scalars import clamped_date, json_date, json_items, json_text, readable, wrapped

#: Lists of titles in publication metadata, by output column.
TITLES = {"article_title": "title", "article_short_title": "short-title", "article_subtitle": "subtitle", "article_original_title": "original-title", "article_container_title": "container-title", "article_short_container_title": "short-container-title"}


def parse_crossref(raw: DataFrame, start: str, end: str) -> DataFrame:
    """One row for each publication, combination of titles side by side, author and affiliation, of publications published
    from start to end (or, without a date, indexed then). Unreadable documents give nothing; a publication whose lists of
    titles are all empty vanishes; one without authors keeps a row with null authors."""
    docs = raw.select("publication_doi", readable(F.col("publication_metadata")).alias("d")).where("d is not null").select("publication_doi", wrapped(F.col("d"), "message").alias("d"))
    doc = F.col("d")
    date = lambda k: json_date(F.get_json_object(doc, f"$.{k}"), lenient=True)
    docs = docs.withColumns({"article_indexed_dt": date("indexed"), "article_publication_dt": date("published")})
    docs = docs.where(F.coalesce("article_publication_dt", "article_indexed_dt").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    lists = [F.coalesce(F.from_json(F.get_json_object(doc, f"$['{k}']"), "array<string>"), F.array().cast("array<string>")).alias(c) for c, k in TITLES.items()]
    rows = docs.select(
        F.col("publication_doi").alias("article_doi"), *(json_text(doc, k).alias(f"article_{c}") for c, k in (("url", "URL"), ("institution", "institution"), ("publisher", "publisher"))),
        F.inline(F.arrays_zip(*lists)).alias(*TITLES), json_text(doc, "abstract").alias("article_abstract"), "article_indexed_dt", "article_publication_dt", json_text(doc, "is-referenced-by-count").try_cast("int").alias("article_referenced_by_count"), F.get_json_object(doc, "$.author").alias("authors"),
    )
    rows = rows.select("*", F.posexplode_outer(json_items(F.col("authors"))).alias("at", "a")).drop("authors")
    rows = rows.select("*", F.explode_outer(json_items(F.get_json_object("a", "$.affiliation"))).alias("f"))
    author = F.col("a")
    rows = rows.withColumns({
        "author_given_name": json_text(author, "given"), "author_family_name": json_text(author, "family"), "author_sequence": json_text(author, "sequence"), "author_sequence_index": F.col("at") + 1,
        "author_orcid": F.regexp_replace(json_text(author, "ORCID"), r"^http://[^/]+/", ""), "affiliation_identifier": json_text(F.col("f"), "name"),
    })
    return rows.drop("at", "a", "f").distinct()


def parse_publications(raw: DataFrame, start: str, end: str) -> DataFrame:
    """One row for each publication, author and affiliation, of publications dated from start to end; keywords of the
    publication as text in order."""
    window = raw.where(F.col("publication_dt").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    keywords = F.filter(F.transform(json_items(readable(F.col("publication_keywords"))), lambda k: F.get_json_object(k, "$.keyword")), lambda k: k.isNotNull())
    same = {f"article_{c}": f"publication_{c}" for c in ("id", "eid", "doi", "title", "journal", "type", "abstract", "citation_count")}
    rows = window.select(*(F.col(v).alias(k) for k, v in same.items()), F.col("publication_dt").alias("article_publication_dt"), F.when(F.size(keywords) > 0, F.array_join(keywords, ", ")).alias("article_keywords"), F.explode_outer(json_items(readable(F.col("publication_authors")))).alias("a"))
    rows = rows.select("*", F.explode_outer(json_items(F.get_json_object("a", "$.author_affiliation_ids"))).alias("f"))
    a = F.col("a")
    return rows.select(
        *(c for c in rows.columns if c not in ("a", "f")), *(json_text(a, c).alias(c) for c in ("author_id", "author_initials", "author_last_name", "author_first_name", "author_indexed_name", "author_sequence")),
        json_text(a, "is_first_author").try_cast("boolean").alias("is_first_author"), json_text(F.col("f"), "id").alias("affiliation_id"),
    ).distinct()


def latest(rows: DataFrame, key: str, at: str) -> DataFrame:
    """The rows of each key with its greatest `at`; ties stay."""
    return rows.withColumn("_r", F.rank().over(Window.partitionBy(key).orderBy(F.col(at).desc_nulls_last()))).where("_r = 1").drop("_r")


def primary_ids(rows: DataFrame, key: str, url: str, value: str) -> DataFrame:
    """Of each key's identifiers those that its URL contains, or all if it contains none. LIKE wildcards in an
    identifier stay active."""
    inside = F.coalesce(F.expr(f"{url} like concat('%', {value}, '%')"), F.lit(False)).cast("int")
    ranked = rows.select(key, value, inside.alias("_in")).distinct().withColumn("_r", F.rank().over(Window.partitionBy(key).orderBy(F.desc("_in"))))
    return ranked.where("_r = 1").select(key, value).distinct()


def parse_member_works(raw: DataFrame, year: int) -> DataFrame:
    """The works of a year of each member's latest version, with the identifiers of their own: (member_works is a JSON list of
    groups of summaries). A work with several best identifiers gives several rows."""
    works = latest(raw, "member_id", "row_updated_at").select("member_id", F.explode(json_items(readable(F.col("member_works")))).alias("g"))
    works = works.select("member_id", F.explode(json_items(F.get_json_object("g", "$['work-summary']"))).alias("w"))
    at = lambda path: F.get_json_object("w", path)
    part = lambda unit: at(f"$['publication-date'].{unit}.value").try_cast("int")
    works = works.where(part("year") == year).select(
        "member_id", at("$['put-code']").alias("article_id"), at("$.url.value").alias("url"), at("$.title.title.value").alias("article_title"), clamped_date(part("year"), part("month"), part("day"), lift_day=True).alias("dt"), at("$.type").alias("article_type"),
        F.to_date(F.timestamp_seconds(F.floor(at("$['last-modified-date'].value").try_cast("bigint") / 1000))).alias("modified"), at("$['journal-title'].value").alias("article_journal_title"), at("$['external-ids']['external-id']").alias("ids"),
    )
    each = works.select("article_id", "url", F.explode(json_items(F.col("ids"))).alias("x")).select("article_id", "url", json_text(F.col("x"), "external-id-type").alias("type"), json_text(F.col("x"), "external-id-value").alias("value"), json_text(F.col("x"), "external-id-relationship").alias("relation")).where("relation = 'self'")
    best = lambda kind: primary_ids(each.where(F.col("type") == kind), "article_id", "url", "value").withColumnRenamed("value", f"article_{kind}")
    rows = works.groupBy("member_id", "article_id", "article_title", "article_type", "article_journal_title").agg(F.max("modified").alias("article_last_modified_dt"), F.max("dt").alias("article_publication_dt"))
    return rows.join(best("doi"), "article_id", "left").join(best("eid"), "article_id", "left").select("member_id", "article_id", "article_doi", "article_eid", "article_title", "article_publication_dt", "article_type", "article_last_modified_dt", "article_journal_title").distinct()


def path_value(record: object, path: str, default: object = None) -> object:
    """The value at a dotted path of a nested dictionary. The default where a member on the way is absent or null; a value
    that is no dictionary on the way is returned as it is. A null at the path's end is null."""
    head, _, rest = path.partition(".")
    if record is None:
        return default
    if not isinstance(record, dict):
        return record
    if head not in record:
        return default
    return path_value(record[head], rest, default) if rest else record[head]


def as_list(value: object) -> list:
    """A list as it is, null as empty, anything else as a list of one."""
    return value if isinstance(value, list) else [] if value is None else [value]


def record_authors(record: dict) -> list[dict]:
    """Creators, then authors; of one id the first counts (a missing id counts as an id)."""
    found, seen = [], set()
    for at, a in enumerate([*as_list(path_value(record, "coredata.dc:creator.author")), *as_list(path_value(record, "authors.author"))]):
        if not isinstance(a, dict) or a.get("@auid") in seen:
            continue
        seen.add(a.get("@auid"))
        sequence = a.get("@seq")
        found.append({
            "author_id": a.get("@auid"), "author_first_name": a.get("ce:given-name"), "author_last_name": a.get("ce:surname"), "author_indexed_name": a.get("ce:indexed-name"), "author_initials": a.get("ce:initials"),
            "author_sequence": str(sequence or at), "is_first_author": sequence == "1" or (sequence is None and at == 0), "author_affiliation_ids": [{"id": f.get("@id")} for f in as_list(a.get("affiliation")) if isinstance(f, dict)],
        })
    return found


def record_references(record: dict) -> list[dict]:
    """A reference's id and title; without a title its text."""
    out = []
    for r in as_list(path_value(record, "item.bibrecord.tail.bibliography.reference")):
        title = path_value(r, "ref-info.ref-title.ref-titletext")
        out.append({"reference_id": path_value(r, "@id"), "reference_title": path_value(r, "ref-info.ref-text") if title is None else title})
    return out


def record_affiliations(record: dict) -> list[dict]:
    """The affiliations of a record: id, name, city and country."""
    members = {"affiliation_id": "@id", "affiliation_name": "affilname", "affiliation_city": "affiliation-city", "affiliation_country": "affiliation-country"}
    return [{name: a.get(key) for name, key in members.items()} for a in as_list(path_value(record, "affiliation")) if isinstance(a, dict)]


def parse_affiliations(raw: DataFrame) -> DataFrame:
    """(publication_id, publication_eid, publication_doi, publication_affiliation_id, publication_affiliations) of the
    document store's records (scopus_id, record as JSON text), one row for each affiliation, in the JVM. Unreadable records
    and affiliations without an id give none; repeated ones count once."""
    a = F.col("a")
    rows = raw.select(F.col("scopus_id").alias("publication_id"), readable(F.col("record")).alias("r")).where("r is not null")
    at = lambda path: F.get_json_object("r", path)
    rows = rows.select("publication_id", at("$.coredata.eid").alias("publication_eid"), at("$.coredata['prism:doi']").alias("publication_doi"), F.explode(json_items(at("$.affiliation"))).alias("a"))
    item = F.struct(json_text(a, "affilname").alias("affiliation_name"), json_text(a, "affiliation-city").alias("affiliation_city"), json_text(a, "affiliation-country").alias("affiliation_country"))
    rows = rows.select("publication_id", "publication_eid", "publication_doi", json_text(a, "@id").alias("publication_affiliation_id"), F.to_json(F.array(item)).alias("publication_affiliations"))
    return rows.where("publication_affiliation_id is not null").distinct()


def parse_store_records(raw: DataFrame) -> DataFrame:
    """Publications of the document store (scopus_id, record as JSON text) as rows with JSON lists of authors, keywords
    and references. Unreadable records are left out."""
    import json

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, text in zip(batch["scopus_id"], batch["record"], strict=True):
                try:
                    r = json.loads(text)
                except (TypeError, ValueError):
                    continue
                core = lambda k, r=r: path_value(r, f"coredata.{k}")
                words = [{"keyword": k.get("$")} for k in as_list(path_value(r, "authkeywords.author-keyword")) if isinstance(k, dict)]
                count = core("citedby-count")
                out.append((key, core("eid"), core("prism:doi"), core("dc:title"), core("prism:publicationName"), core("prism:aggregationType"), core("dc:description"), int(count) if str(count).isdigit() else None, core("prism:coverDate"), *(json.dumps(x, ensure_ascii=False) for x in (record_authors(r), words, record_references(r)))))
            yield pd.DataFrame(out, columns=[c.split(" ")[0] for c in fields]).astype({"publication_citation_count": "Int32"})

    fields = [f"publication_{c} string" for c in ("id", "eid", "doi", "title", "journal", "type", "abstract")] + ["publication_citation_count int", "publication_dt string"] + [f"publication_{c} string" for c in ("authors", "keywords", "references")]
    return raw.select("scopus_id", "record").mapInPandas(run, ", ".join(fields)).withColumn("publication_dt", F.try_to_timestamp(F.col("publication_dt"), F.lit("yyyy-MM-dd")).cast("date"))


def record_map(rows: DataFrame, records: Column) -> DataFrame:
    """F: a JSON object keyed by record id as rows (record_key, record)."""
    return rows.select("*", F.explode(F.from_json(records, "map<string,string>")).alias("record_key", "record"))
