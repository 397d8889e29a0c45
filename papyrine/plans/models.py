"""The transformation models: staging, marts, analytics, intermediate, final, graph. A model is a function of a Context and
lazy; the pipeline decides what is written."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from papyrine.functions.scalars import array_text, clamped_date, institution_code, json_date, json_items, json_text, readable, strip_quotes, truncated_quotient, wrapped
from papyrine.operators.novelty import novelty
from papyrine.session import checkpointed, read_table

#: Members of a reference in publication metadata, by output column.
REFERENCE_KEYS = {
    "key": "key", "doi": "DOI", "issn": "ISSN", "isbn": "ISBN", "issue": "issue", "series_title": "series-title", "doi_asserted_by": "doi-asserted-by", "first_page": "first-page", "component": "component",
    "title": "article-title", "volume_title": "volume-title", "volume": "volume", "author": "author", "year": "year", "unstructured": "unstructured", "edition": "edition", "journal_title": "journal-title",
}
TITLE_KEYS = ("title", "short-title", "subtitle", "original-title", "container-title", "short-container-title")
#: Articles with more authors than this are left out of collaborations.
MOST_AUTHORS = 40
#: First year of collaborations; least articles of a graph author; least common articles of an edge; keywords in the graph.
FIRST_DATE, GRAPH_ARTICLES, EDGE_ARTICLES, TOP_KEYWORDS = "2000-01-01", 5, 5, 200
UNKNOWN = ("n/a", "OTHER")


@dataclass(frozen=True)
class Model:
    name: str
    layer: str
    build: Callable[[Context], DataFrame]
    refs: tuple[str, ...]


MODELS: dict[str, Model] = {}
#: Tags that select layers, as the refresh does.
TAGS = {"data_ingestion": ("staging", "mart"), "data_enrichment": ("analytics", "intermediate", "final", "graph")}


def model(layer: str, *refs: str) -> Callable:
    def register(build: Callable[[Context], DataFrame]) -> Callable[[Context], DataFrame]:
        MODELS[build.__name__] = Model(build.__name__, layer, build, refs)
        return build

    return register


@dataclass
class Context:
    """Where models find lake tables and each other. Given frames take precedence over files and derived tables."""

    spark: SparkSession
    directory: str | None = None
    tables: dict[str, DataFrame] = field(default_factory=dict)
    patterns: tuple[tuple[str, str], ...] | None = None
    #: Models that several others use are cut by a checkpoint when they are first asked for.
    cut: frozenset[str] = frozenset()
    built: dict[str, DataFrame] = field(default_factory=dict)
    novelty: tuple[DataFrame, ...] = ()

    def table(self, name: str) -> DataFrame:
        if name not in self.tables:
            self.tables[name] = DERIVED[name](self) if name in DERIVED else read_table(self.spark, self.directory, name)
        return self.tables[name]

    def ref(self, name: str) -> DataFrame:
        if name not in self.built:
            frame = MODELS[name].build(self)
            self.built[name] = checkpointed(frame) if name in self.cut else frame
        return self.built[name]

    def institution(self, text: Column) -> Column:
        return institution_code(text, self.patterns) if self.patterns else institution_code(text)


# ------------------------------------------------------------------------------------------------ lake tables made from others


def _affiliations(ctx: Context) -> DataFrame:
    """elsevier_publication_affiliation from parsed rows: one row for each article and affiliation."""
    rows = ctx.table("elsevier_publication_parsed").where("affiliation_id is not null").select("article_id", "article_eid", "article_doi", "affiliation_id").distinct()
    name = F.to_json(F.array(F.struct(F.concat(F.lit("Institute "), F.col("affiliation_id")).alias("affiliation_name"), F.lit("City").alias("affiliation_city"), F.lit("Country").alias("affiliation_country"))))
    return rows.select(F.concat(F.lit("SCOPUS_ID:"), "article_id").alias("publication_id"), F.col("article_eid").alias("publication_eid"), F.col("article_doi").alias("publication_doi"), F.col("affiliation_id").alias("publication_affiliation_id"), name.alias("publication_affiliations"))


def _employments(ctx: Context) -> DataFrame:
    """orcid_member_employments from the affiliations that publications give for an ORCID, from first to last year."""
    rows = ctx.table("crossref_publication_parsed").where("author_orcid is not null and affiliation_identifier is not null and article_publication_dt is not null")
    rows = rows.groupBy(F.regexp_extract("author_orcid", r"(\d{4}-\d{4}-\d{4}-\d{3}[\dX])$", 1).alias("member_id"), "affiliation_identifier").agg(F.min(F.year("article_publication_dt")).alias("a"), F.max(F.year("article_publication_dt")).alias("b")).where("member_id <> ''")
    date = lambda c: F.struct(F.struct(F.col(c).cast("string").alias("value")).alias("year"))
    summary = F.struct(F.md5(F.concat("member_id", "affiliation_identifier")).alias("put-code"), F.struct(F.col("affiliation_identifier").alias("name")).alias("organization"), date("a").alias("start-date"), F.when(F.col("b") > F.col("a"), date("b")).alias("end-date"))
    return rows.select("member_id", F.to_json(F.array(F.struct(F.array(F.struct(summary.alias("employment-summary"))).alias("summaries")))).alias("member_employments"))


def _keywords(ctx: Context) -> DataFrame:
    rows = ctx.table("elsevier_publication_parsed").where("article_keywords is not null").groupBy("article_id").agg(F.max("article_keywords").alias("k"))
    return rows.select("article_id", F.split("k", ", ").alias("article_keywords_arr"))


def _keyword_trend(ctx: Context) -> DataFrame:
    """S8, E8 without a network: the articles of each keyword and year."""
    years = ctx.table("elsevier_publication_parsed").groupBy("article_id").agg(F.year(F.max("article_publication_dt")).alias("year"))
    each = ctx.table("article_keywords").select("article_id", F.explode(F.array_distinct("article_keywords_arr")).alias("article_keyword"))
    return each.join(years, "article_id").groupBy("article_keyword", "year").agg(F.count("*").cast("int").alias("publication_count"))


def _seeds(ctx: Context) -> DataFrame:
    """crossref_top_n_research_area_publication: publications without their wrapper, with an area of the list of areas."""
    areas = ctx.table("cerif_research_area").agg(F.array_sort(F.collect_set("research_area_code")).alias("areas"))  # one row
    rows = ctx.table("crossref_publication").select("publication_doi", readable(F.col("publication_metadata")).alias("doc")).where("doc is not null")
    number = F.length("publication_doi") % F.size("areas")
    return rows.crossJoin(F.broadcast(areas)).select(F.get("areas", number).alias("cerif_research_area_code"), "publication_doi", wrapped(F.col("doc"), "message").alias("publication_metadata"))


def _novelty_rows(ctx: Context) -> DataFrame:
    facts = ctx.ref("mart_collaboration_by_article").where(~F.col("is_single_author_collaboration") & (F.col("article_publication_dt") >= FIRST_DATE))
    return ctx.ref("mart_collaboration").join(facts.select("article_id", F.col("article_publication_dt").alias("dt")), "article_id")


def _novelty(ctx: Context, which: int) -> DataFrame:
    """One of the three tables of the novelty index; the pairs that they share are built once."""
    if not ctx.novelty:
        ctx.novelty = novelty(_novelty_rows(ctx), checkpointed)
    return ctx.novelty[which]


INSTITUTION_COLUMNS = ("institution_id", "institution_name", "institution_pretty_name", "institution_country", "scopus_affiliation_id", "institution_language", "institution_country_iso2")
DERIVED: dict[str, Callable[[Context], DataFrame]] = {
    "elsevier_publication_affiliation": _affiliations,
    "orcid_member_employments": _employments,
    "article_keywords": _keywords,
    "article_keyword_trend": _keyword_trend,
    "crossref_top_n_research_area_publication": _seeds,
    "alliance_institution": lambda ctx: ctx.spark.createDataFrame([("INST_A", "Institute A", "A", "Norvia", "60900001", "no", "NO"), ("INST_B", "Institute B", "B", "Caldora", "60900017", "ca", "CA"), ("INST_C", "Institute C", "C", "Quorin", "60900010", "qu", "QU")], ", ".join(f"{c} string" for c in INSTITUTION_COLUMNS)),
    "collaboration_novelty_index": lambda ctx: _novelty(ctx, 0),
    "collaboration_novelty_metadata": lambda ctx: _novelty(ctx, 1),
    "new_author_pair": lambda ctx: _novelty(ctx, 2),
}

# ------------------------------------------------------------------------------------------------------------------- staging


def _references(rows: DataFrame, doc: Column, key: str, *keep: str) -> DataFrame:
    """One row per reference of a publication, in order; `no` is its place in the list."""
    each = rows.select(key, *keep, F.posexplode(json_items(F.get_json_object(doc, "$.reference"))).alias("no", "r"))
    return each.select(F.col(key).alias("article_doi"), *keep, (F.col("no") + 1).alias("no"), *(json_text(F.col("r"), name).alias(f"reference_article_{column}") for column, name in REFERENCE_KEYS.items()))


def _reference_text() -> Column:
    parts = ("title", "author", "unstructured", "journal_title")
    return F.concat(F.lit("Reference:"), *(F.coalesce(F.concat(F.lit(" "), f"reference_article_{p}"), F.lit("")) for p in parts))


def documents_of(publications: DataFrame) -> DataFrame:
    """(publication_doi, row_created_at, doc) of the readable publications, without their wrapper."""
    rows = publications.select("publication_doi", "row_created_at", readable(F.col("publication_metadata")).alias("doc"))
    return rows.where("doc is not null").select("publication_doi", "row_created_at", wrapped(F.col("doc"), "message").alias("doc"))


def _documents(ctx: Context) -> DataFrame:
    return documents_of(ctx.table("crossref_publication"))


@model("staging")
def stg_crossref_publication_reference(ctx: Context) -> DataFrame:
    return _references(_documents(ctx), F.col("doc"), "publication_doi", "row_created_at")


@model("staging", "stg_crossref_publication_reference")
def stg_crossref_publication_top_3_reference(ctx: Context) -> DataFrame:
    """The first three references that say something: of the latest version, in order of the list."""
    told = F.coalesce(*(f"reference_article_{p}" for p in ("title", "author", "unstructured", "journal_title"))).isNotNull()
    order = Window.partitionBy("article_doi").orderBy(F.desc("row_created_at"), "no")
    top = ctx.ref("stg_crossref_publication_reference").where(told).withColumn("rn", F.row_number().over(order)).where("rn <= 3")
    return top.groupBy("article_doi").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rn", _reference_text().alias("t")))), lambda x: x["t"]), ", ").alias("article_references"))


@model("staging", "stg_crossref_publication_top_3_reference")
def stg_crossref_article(ctx: Context) -> DataFrame:
    columns = ["article_doi", "article_publisher", "article_title", "article_short_title", "article_subtitle", "article_original_title", "article_container_title", "article_short_container_title", "article_abstract", "article_publication_dt"]
    rows = ctx.table("crossref_publication_parsed").select(*columns, F.col("article_referenced_by_count").alias("article_citation_count")).distinct()
    return rows.join(ctx.ref("stg_crossref_publication_top_3_reference"), "article_doi", "left")


@model("staging")
def stg_crossref_author_sequence(ctx: Context) -> DataFrame:
    return ctx.table("crossref_publication_parsed").select("article_doi", "author_sequence", "author_sequence_index", "author_orcid").distinct()


@model("staging")
def stg_crossref_seed_article(ctx: Context) -> DataFrame:
    """Seed publications of each area: the lists of titles side by side (a publication without any title vanishes)."""
    rows = ctx.table("crossref_top_n_research_area_publication")
    references = _references(rows, F.col("publication_metadata"), "publication_doi").groupBy("article_doi").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("no", _reference_text().alias("t")))), lambda x: x["t"]), ", ").alias("article_references"))
    doc = F.col("publication_metadata")
    lists = [F.coalesce(F.from_json(json_member, "array<string>"), F.array().cast("array<string>")).alias(k.replace("-", "_")) for k in TITLE_KEYS for json_member in [F.get_json_object(doc, f"$['{k}']")]]
    date = lambda k: json_date(F.get_json_object(doc, f"$.{k}"))
    base = rows.select(
        "publication_doi", F.lower("publication_doi").alias("article_doi"), F.col("cerif_research_area_code").alias("research_area_code"), json_text(doc, "URL").alias("article_url"), json_text(doc, "publisher").alias("article_publisher"),
        F.inline(F.arrays_zip(*lists)).alias("article_title", "article_short_title", "article_subtitle", "article_original_title", "article_container_title", "article_short_container_title"),
        json_text(doc, "abstract").alias("article_abstract"), json_text(doc, "is-referenced-by-count").try_cast("int").alias("is_referenced_by_count"), date("indexed").alias("article_indexed_dt"), F.coalesce(date("published"), date("indexed")).alias("article_publication_dt"),
    )
    told = [("Title: ", "article_title"), ("Container Title: ", "article_container_title"), ("Abstract: ", "article_abstract"), ("References: ", "article_references")]
    joined = base.join(references.withColumnRenamed("article_doi", "publication_doi"), "publication_doi", "left").drop("publication_doi")
    return joined.withColumn("article_embedding_input", F.concat_ws("\\n", *(F.concat(F.lit(label), F.coalesce(c, F.lit("n/a"))) for label, c in told)))


@model("staging")
def stg_elsevier_publication_reference(ctx: Context) -> DataFrame:
    rows = ctx.table("elsevier_publication").select(F.col("publication_id").alias("article_id"), "row_created_at", F.posexplode(json_items(readable(F.col("publication_references")))).alias("no", "r"))
    return rows.select("article_id", "row_created_at", (F.col("no") + 1).alias("no"), json_text(F.col("r"), "reference_id").alias("reference_id"), json_text(F.col("r"), "reference_title").alias("reference_title"))


@model("staging", "stg_elsevier_publication_reference")
def stg_elsevier_publication_top_3_reference(ctx: Context) -> DataFrame:
    order = Window.partitionBy("article_id").orderBy(F.desc("row_created_at"), "no")
    top = ctx.ref("stg_elsevier_publication_reference").where("reference_title is not null").withColumn("rn", F.row_number().over(order)).where("rn <= 3")
    return top.groupBy("article_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rn", F.col("reference_title").alias("t")))), lambda x: x["t"]), ", ").alias("article_references"))


@model("staging", "stg_elsevier_publication_top_3_reference")
def stg_elsevier_article(ctx: Context) -> DataFrame:
    rows = ctx.table("elsevier_publication_parsed").select("article_id", "article_eid", "article_doi", "article_title", "article_journal", "article_abstract", "article_keywords", "article_citation_count", "article_publication_dt").distinct()
    return rows.join(ctx.ref("stg_elsevier_publication_top_3_reference"), "article_id", "left")


@model("staging", "dim_institution")
def stg_elsevier_affiliation(ctx: Context) -> DataFrame:
    rows = ctx.table("elsevier_publication_affiliation").select(F.regexp_replace("publication_id", "SCOPUS_ID:", "").alias("article_id"), F.col("publication_eid").alias("article_eid"), F.col("publication_doi").alias("article_doi"), "publication_affiliation_id", "publication_affiliations")
    dim = ctx.ref("dim_institution").select("institution_id", "scopus_affiliation_id")
    named = rows.join(dim, rows["publication_affiliation_id"] == dim["scopus_affiliation_id"], "left").select("article_id", "article_eid", "article_doi", "institution_id")
    each = rows.select("article_id", F.explode(json_items(F.col("publication_affiliations"))).alias("a"))
    other = each.select("article_id", ctx.institution(F.concat_ws("_", *(json_text(F.col("a"), f"affiliation_{x}") for x in ("name", "city", "country")))).alias("institution_id")).distinct()
    both = named.unionAll(named.drop("institution_id").distinct().join(other, "article_id").select("article_id", "article_eid", "article_doi", "institution_id"))
    return both.withColumn("institution_id", F.coalesce("institution_id", F.lit("n/a"))).distinct()


@model("staging")
def stg_orcid_article(ctx: Context) -> DataFrame:
    return ctx.table("orcid_member_works_parsed").select("article_id", "article_doi", "article_eid", "article_title", "article_journal_title", "article_publication_dt").distinct()


@model("staging")
def stg_orcid_member_employment(ctx: Context) -> DataFrame:
    each = ctx.table("orcid_member_employments").select("member_id", F.explode(json_items(F.col("member_employments"))).alias("e"))
    each = each.select("member_id", F.explode(json_items(F.get_json_object("e", "$.summaries"))).alias("s"))
    at = lambda path: F.get_json_object("s", f"$['employment-summary']{path}")
    texts = {"organization_name": ".organization.name", "organization_city": ".organization.address.city", "organization_region": ".organization.address.region", "organization_country": ".organization.address.country", "department_name": "['department-name']", "role_title": "['role-title']"}
    part = lambda end, unit, missing: F.coalesce(at(f"['{end}-date'].{unit}.value").try_cast("int"), F.lit(missing))
    date = lambda end, year: clamped_date(part(end, "year", year), part(end, "month", 1), part(end, "day", 1))
    return each.select("member_id", at("['put-code']").alias("employment_id"), F.concat_ws("_", *(at(p) for p in texts.values())).alias("affiliation_identifier"), *(at(p).alias(c) for c, p in texts.items()), date("start", 1).alias("start_dt"), date("end", 2100).alias("end_dt"))


@model("staging", "stg_orcid_member_employment")
def stg_orcid_member_employment_by_work(ctx: Context) -> DataFrame:
    works = ctx.table("orcid_member_works_parsed").select("member_id", "article_id", "article_publication_dt")
    return ctx.ref("stg_orcid_member_employment").join(works, "member_id").where("article_publication_dt between start_dt and end_dt").select("member_id", "employment_id", "affiliation_identifier", "article_id")


@model("staging")
def stg_orcid_member_person(ctx: Context) -> DataFrame:
    """A row for each version, and for each combination of a member's identifiers of the three types."""
    rows = ctx.table("orcid_member_person").select("member_id", readable(F.col("member_person")).alias("doc")).where("doc is not null")
    ids = rows.select("member_id", F.explode(json_items(F.get_json_object("doc", "$['external-identifiers']['external-identifier']"))).alias("x"))
    ids = ids.select("member_id", json_text(F.col("x"), "external-id-type").alias("type"), json_text(F.col("x"), "external-id-value").alias("value"))
    out = rows.select("member_id", F.get_json_object("doc", "$.name['family-name'].value").alias("member_family_name"), F.get_json_object("doc", "$.name['given-names'].value").alias("member_given_names"))
    for column, kind in (("member_scopus_id", "Scopus Author ID"), ("member_researcher_id", "ResearcherID"), ("member_loop_id", "Loop profile")):
        out = out.join(ids.where(F.col("type") == kind).select("member_id", F.col("value").alias(column)), "member_id", "left")
    return out


# --------------------------------------------------------------------------------------------------------------------- marts


@model("mart", "stg_elsevier_affiliation")
def mart_elsevier_collaboration(ctx: Context) -> DataFrame:
    rows = ctx.table("elsevier_publication_parsed").select("article_id", "article_doi", "author_id", F.col("author_sequence").try_cast("int").alias("seq"))
    rows = rows.join(ctx.ref("stg_elsevier_affiliation").select("article_id", "institution_id"), "article_id", "left")
    known = ctx.table("crossref_publication_parsed").select(F.col("article_doi").alias("crossref_article_doi")).distinct()
    rows = rows.join(known, rows["article_doi"] == known["crossref_article_doi"], "left")
    return rows.groupBy("article_id", "author_id", "institution_id", "crossref_article_doi").agg(F.max("seq").alias("author_sequence")).withColumn("institution_id", F.coalesce("institution_id", F.lit("OTHER")))


MART_ARTICLE = ["article_id", "article_doi", "article_eid", "article_title", "article_journal_title", "article_abstract", "article_references", "article_citation_count", "article_publication_dt"]


@model("mart", "mart_elsevier_collaboration", "stg_elsevier_article", "stg_crossref_article")
def mart_elsevier_article(ctx: Context) -> DataFrame:
    m = ctx.ref("mart_elsevier_collaboration").select("article_id", "crossref_article_doi").distinct()
    e = ctx.ref("stg_elsevier_article").select("article_id", "article_doi", "article_eid", *(F.col(c).alias(f"e_{c}") for c in ("article_title", "article_journal", "article_abstract", "article_references", "article_citation_count", "article_publication_dt")))
    c = ctx.ref("stg_crossref_article").select(F.col("article_doi").alias("crossref_article_doi"), *(F.col(c).alias(f"c_{c}") for c in ("article_title", "article_container_title", "article_abstract", "article_references", "article_citation_count", "article_publication_dt")))
    first = lambda a, b, name: F.coalesce(f"e_{a}", f"c_{b}").alias(name)
    return m.join(e, "article_id", "left").join(c, "crossref_article_doi", "left").select(
        "article_id", "article_doi", "article_eid", first("article_title", "article_title", "article_title"), first("article_journal", "article_container_title", "article_journal_title"), first("article_abstract", "article_abstract", "article_abstract"), first("article_references", "article_references", "article_references"),
        F.greatest("e_article_citation_count", "c_article_citation_count", F.lit(0)).alias("article_citation_count"), F.least("e_article_publication_dt", "c_article_publication_dt").alias("article_publication_dt"),
    )


@model("mart")
def mart_elsevier_author(ctx: Context) -> DataFrame:
    return ctx.table("elsevier_publication_parsed").select("author_id", F.coalesce("author_indexed_name", F.concat("author_first_name", F.lit(" "), "author_last_name")).alias("author_name")).distinct()


@model("mart", "stg_crossref_author_sequence", "stg_orcid_member_person", "stg_orcid_member_employment_by_work")
def mart_orcid_collaboration_with_duplicates(ctx: Context) -> DataFrame:
    """Works that the other source lacks: those with an EID that is none of its EIDs. As NOT IN over a set with a null is
    never true, such a set leaves no work; works without an EID never pass."""
    eids = ctx.table("elsevier_publication").select("publication_eid").distinct()
    holes = F.broadcast(eids.where("publication_eid is null").limit(1).agg(F.count("*").alias("holes")))  # one row
    works = ctx.table("orcid_member_works_parsed").where("article_eid is not null").join(eids, F.col("article_eid") == F.col("publication_eid"), "left_anti").crossJoin(holes).where("holes = 0").select("article_id", "member_id", F.col("article_doi").alias("doi"))
    places = ctx.table("crossref_publication_parsed").select("article_doi", ctx.institution(F.col("affiliation_identifier")).alias("institution_id")).distinct()
    employed = ctx.ref("stg_orcid_member_employment_by_work").select("member_id", "article_id", ctx.institution(F.col("affiliation_identifier")).alias("institution_id")).distinct()
    one = works.join(places, works["doi"] == places["article_doi"], "left").select("article_id", "member_id", "institution_id", "article_doi")
    other = works.join(places.select("article_doi").distinct(), F.col("doi") == F.col("article_doi"), "left").join(employed, ["member_id", "article_id"], "left").select("article_id", "member_id", "institution_id", "article_doi")
    merged = one.distinct().unionAll(other.distinct())
    scopus = ctx.ref("stg_orcid_member_person").select("member_id", "member_scopus_id").distinct()
    r = merged.join(scopus, "member_id", "left").select("article_id", F.coalesce("member_scopus_id", "member_id").alias("author_id"), F.coalesce("institution_id", F.lit("OTHER")).alias("institution_id"), "article_doi").where("article_id is not null")
    s = ctx.ref("stg_crossref_author_sequence").select(F.col("article_doi").alias("s_doi"), F.col("author_orcid").alias("s_author"), "author_sequence", "author_sequence_index")
    j = r.join(s, (r["article_doi"] == s["s_doi"]) & (r["author_id"] == s["s_author"]), "left")
    # the running maximum of the sequence index keeps several values a key; a later maximum takes the last, so it is taken here
    rows = j.groupBy("article_id", "author_id", "institution_id").agg(F.max("article_doi").alias("article_doi"), F.min("author_sequence").alias("author_sequence"), F.max("author_sequence_index").alias("author_sequence_index"))
    return rows.join(rows.where(~F.col("institution_id").isin(*UNKNOWN)).select("article_id").distinct(), "article_id", "left_semi")


@model("mart", "mart_orcid_collaboration_with_duplicates", "stg_orcid_article", "stg_crossref_article")
def mart_orcid_article_with_duplicates(ctx: Context) -> DataFrame:
    m = ctx.ref("mart_orcid_collaboration_with_duplicates").select("article_id", "article_doi").distinct()
    o = ctx.ref("stg_orcid_article").select("article_id", F.col("article_doi").alias("o_doi"), "article_eid", F.col("article_title").alias("o_title"), F.col("article_journal_title").alias("o_journal"), F.col("article_publication_dt").alias("o_dt"))
    c = ctx.ref("stg_crossref_article").select("article_doi", F.col("article_title").alias("c_title"), "article_container_title", "article_abstract", "article_references", F.col("article_citation_count").alias("c_count"), F.col("article_publication_dt").alias("c_dt"))
    return m.join(o, "article_id", "left").join(c, "article_doi", "left").select(
        "article_id", F.coalesce("article_doi", "article_eid", "o_doi", "article_id").alias("new_article_id"), "article_doi", "article_eid", F.coalesce("o_title", "c_title").alias("article_title"), F.coalesce("o_journal", "article_container_title").alias("article_journal_title"),
        "article_abstract", "article_references", F.greatest("c_count", F.lit(0)).alias("article_citation_count"), F.least("o_dt", "c_dt").alias("article_publication_dt"),
    )


@model("mart", "mart_orcid_article_with_duplicates")
def mart_orcid_article(ctx: Context) -> DataFrame:
    return ctx.ref("mart_orcid_article_with_duplicates").drop("article_id").withColumnRenamed("new_article_id", "article_id").select(*MART_ARTICLE).distinct()


@model("mart", "stg_orcid_member_person")
def mart_orcid_author(ctx: Context) -> DataFrame:
    return ctx.ref("stg_orcid_member_person").select(F.coalesce("member_scopus_id", "member_id").alias("author_id"), F.concat("member_given_names", F.lit(" "), "member_family_name").alias("author_name"))


@model("mart", "mart_orcid_collaboration_with_duplicates", "mart_orcid_article_with_duplicates")
def mart_orcid_collaboration(ctx: Context) -> DataFrame:
    rekeyed = ctx.ref("mart_orcid_article_with_duplicates").select("article_id", "new_article_id").distinct()
    sequence = F.when(F.col("author_sequence") == "first", 1).when(F.col("author_sequence") == "additional", F.col("author_sequence_index"))
    return ctx.ref("mart_orcid_collaboration_with_duplicates").join(rekeyed, "article_id", "left").select(F.coalesce("new_article_id", "article_id").alias("article_id"), "author_id", "institution_id", sequence.alias("author_sequence")).distinct()


@model("mart", "mart_elsevier_collaboration", "mart_orcid_collaboration")
def mart_collaboration(ctx: Context) -> DataFrame:
    columns = ["article_id", "author_id", "institution_id", "author_sequence"]
    merged = ctx.ref("mart_elsevier_collaboration").select(*columns).unionAll(ctx.ref("mart_orcid_collaboration").select(*columns))
    rows = merged.groupBy(*columns[:3]).agg(F.max("author_sequence").alias("author_sequence"))
    kept = rows.groupBy("article_id").agg(F.countDistinct("author_id").alias("n")).where(F.col("n") <= MOST_AUTHORS)
    return rows.join(kept.select("article_id"), "article_id", "left_semi")


def best_non_null(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """For each key the greatest non-null value of every column: one aggregate, no window."""
    return rows.groupBy(key).agg(*(F.max(c).alias(c) for c in columns))


@model("mart", "mart_elsevier_article", "mart_orcid_article", "mart_collaboration")
def mart_article(ctx: Context) -> DataFrame:
    both = ctx.ref("mart_elsevier_article").select(*MART_ARTICLE).unionAll(ctx.ref("mart_orcid_article").select(*MART_ARTICLE))
    return best_non_null(both.join(ctx.ref("mart_collaboration").select("article_id").distinct(), "article_id", "left_semi"), "article_id", MART_ARTICLE[1:])


@model("mart", "mart_elsevier_author", "mart_orcid_author", "mart_collaboration")
def mart_author(ctx: Context) -> DataFrame:
    both = ctx.ref("mart_elsevier_author").unionAll(ctx.ref("mart_orcid_author"))
    return best_non_null(both.join(ctx.ref("mart_collaboration").select("author_id").distinct(), "author_id", "left_semi"), "author_id", ["author_name"])


def collaboration_flags(rows: DataFrame, article: str, author: str, institution: str) -> DataFrame:
    """Which articles are by one author of one institution, within one, across several, or across several known ones."""
    known = F.when(~F.col(institution).isin(*UNKNOWN), F.col(institution))
    counts = rows.groupBy(article).agg(F.countDistinct(author).alias("a"), F.countDistinct(institution).alias("i"), F.countDistinct(known).alias("k"))
    return counts.select(
        article, ((F.col("a") == 1) & (F.col("i") == 1)).alias("is_single_author_collaboration"), ((F.col("a") > 1) & (F.col("i") == 1)).alias("is_internal_collaboration"), (F.col("i") > 1).alias("is_external_collaboration"), (F.col("k") > 1).alias("is_alliance_collaboration"),
    )


FLAGS = ["is_single_author_collaboration", "is_internal_collaboration", "is_external_collaboration", "is_alliance_collaboration"]


@model("mart", "mart_collaboration", "mart_article")
def mart_collaboration_by_article(ctx: Context) -> DataFrame:
    flags = collaboration_flags(ctx.ref("mart_collaboration"), "article_id", "author_id", "institution_id")
    return ctx.ref("mart_article").select("article_id", "article_publication_dt", "article_citation_count").join(flags, "article_id", "left").select("article_id", "article_publication_dt", "article_citation_count", *(F.coalesce(f, F.lit(False)).alias(f) for f in FLAGS))


# ----------------------------------------------------------------------------------------------------------------- analytics


@model("analytics")
def stg_article_keyword_trend(ctx: Context) -> DataFrame:
    return ctx.table("article_keyword_trend").select("article_keyword", F.col("year").alias("article_publication_year"), "publication_count")


@model("analytics")
def stg_article_keywords(ctx: Context) -> DataFrame:
    return ctx.table("article_keywords").select("article_id", "article_keywords_arr")


@model("analytics", "stg_article_keywords")
def stg_article_keywords_flattened(ctx: Context) -> DataFrame:
    return ctx.ref("stg_article_keywords").select("article_id", F.explode("article_keywords_arr").alias("k")).select("article_id", strip_quotes(F.col("k")).alias("article_keyword"))


@model("analytics")
def stg_article_language(ctx: Context) -> DataFrame:
    return ctx.table("article_language").select("article_id", "article_language")


@model("analytics")
def stg_article_research_area(ctx: Context) -> DataFrame:
    return ctx.table("article_research_area").where("research_area_rank = 1").select("article_id", "research_area_code").distinct()


@model("analytics")
def stg_collaboration_novelty_index(ctx: Context) -> DataFrame:
    return ctx.table("collaboration_novelty_index").groupBy("article_id").agg(F.max("collaboration_novelty_index").alias("collaboration_novelty_index"))


@model("analytics")
def stg_collaboration_novelty_metadata(ctx: Context) -> DataFrame:
    flags = ["has_new_author_collaboration", "has_new_institution_collaboration"]
    return ctx.table("collaboration_novelty_metadata").groupBy("article_id", "author_id", "institution_id").agg(*(F.bool_or(f).alias(f) for f in flags))


@model("analytics")
def stg_new_author_pair(ctx: Context) -> DataFrame:
    return ctx.table("new_author_pair").select("article_id", "author_id", "co_author_id", "is_new_author_pair")


# -------------------------------------------------------------------------------------------------------------- intermediate


def normalized_citations(rows: DataFrame) -> DataFrame:
    """Citations over log10 of the citations of their area and year, from (article_id, research_area_code, publication_year,
    article_citation_count). A null area or year has no such total; a total of null, 0 or 1 leaves the count as it is."""
    own = rows.groupBy("article_id", "research_area_code", "publication_year").agg(F.sum("article_citation_count").alias("n"))
    total = rows.groupBy("research_area_code", "publication_year").agg(F.sum("article_citation_count").alias("c"))
    plain = F.col("c").isNull() | F.col("c").isin(0, 1)
    value = F.when(plain, F.col("n").cast("double")).otherwise(F.col("n") / F.log10(F.col("c")))
    return own.join(total, ["research_area_code", "publication_year"], "left").select("article_id", F.col("n").alias("article_citation_count"), F.round(value, 2).alias("article_citation_normalized_count"))


@model("intermediate", "mart_article", "stg_article_research_area")
def int_article_citation_normalized(ctx: Context) -> DataFrame:
    rows = ctx.ref("mart_article").select("article_id", "article_citation_count", F.year("article_publication_dt").alias("publication_year"))
    return normalized_citations(rows.join(ctx.ref("stg_article_research_area"), "article_id", "left"))


@model("intermediate", "stg_article_keywords_flattened", "stg_article_research_area")
def int_article_keyword(ctx: Context) -> DataFrame:
    return ctx.ref("stg_article_keywords_flattened").join(ctx.ref("stg_article_research_area"), "article_id", "left")


@model("intermediate", "stg_article_keyword_trend")
def int_article_keyword_trend(ctx: Context) -> DataFrame:
    return ctx.ref("stg_article_keyword_trend").withColumn("article_keyword", F.trim(strip_quotes(F.col("article_keyword"))))


def author_role(sequence: Column, last: Column) -> Column:
    return F.when((sequence == 1) & (last == 1), "singleAuthor").when(sequence == 1, "firstAuthor").when(sequence == last, "lastAuthor").when(sequence.isNotNull(), "middleAuthor").otherwise("n/a")


@model("intermediate", "mart_collaboration", "mart_collaboration_by_article", "stg_article_research_area", "stg_collaboration_novelty_metadata")
def int_collaboration(ctx: Context) -> DataFrame:
    c = ctx.ref("mart_collaboration")
    last = c.groupBy("article_id").agg(F.max("author_sequence").alias("last"))
    dated = ctx.ref("mart_collaboration_by_article").where(F.col("article_publication_dt") >= FIRST_DATE).drop("article_citation_count")
    rows = c.join(dated, "article_id").join(ctx.ref("stg_article_research_area"), "article_id", "left").join(ctx.ref("stg_collaboration_novelty_metadata"), ["article_id", "author_id", "institution_id"], "left").join(last, "article_id", "left")
    return rows.select(
        "article_id", "author_id", F.coalesce("research_area_code", F.lit("n/a")).alias("research_area_code"), "institution_id", author_role(F.col("author_sequence"), F.col("last")).alias("author_sequence_type"), "article_publication_dt", *FLAGS,
        "has_new_author_collaboration", "has_new_institution_collaboration",
    )


def earlier_works(rows: DataFrame, author: str, article: str, date: str) -> DataFrame:
    """For each article of an author, how many of the author's articles are of earlier days (none: no row). One window
    over the days instead of a self-join."""
    days = F.unix_date(F.col(date).cast("date"))
    window = Window.partitionBy(author).orderBy("d").rangeBetween(Window.unboundedPreceding, -1)
    each = rows.where(F.col(date).isNotNull() & F.col(author).isNotNull() & F.col(article).isNotNull()).select(author, article, days.alias("d")).distinct()
    return each.withColumn("article_count", F.count("*").over(window)).where("article_count > 0").select(author, article, "article_count")


@model("intermediate", "int_collaboration")
def int_author_experience_by_article(ctx: Context) -> DataFrame:
    return earlier_works(ctx.ref("int_collaboration"), "author_id", "article_id", "article_publication_dt")


# --------------------------------------------------------------------------------------------------------------------- final


@model("final", "mart_article", "stg_article_keywords", "stg_article_language", "mart_collaboration_by_article")
def dim_article(ctx: Context) -> DataFrame:
    rows = ctx.ref("mart_article").join(ctx.ref("stg_article_keywords").select("article_id", array_text(F.col("article_keywords_arr")).alias("article_keywords")), "article_id", "left").join(ctx.ref("stg_article_language"), "article_id", "left")
    rows = rows.join(ctx.ref("mart_collaboration_by_article").select("article_id", *FLAGS), "article_id", "left")
    named = lambda c: F.coalesce(c, F.lit("n/a")).alias(c)
    return rows.select("article_id", *(named(c) for c in ("article_doi", "article_eid", "article_title", "article_journal_title")), "article_publication_dt", named("article_keywords"), named("article_language"), *(F.coalesce(f, F.lit(False)).alias(f) for f in FLAGS))


@model("final", "mart_author")
def dim_author(ctx: Context) -> DataFrame:
    return ctx.ref("mart_author").select("author_id", F.coalesce("author_name", F.lit("n/a")).alias("author_name"))


def with_default_member(rows: DataFrame, columns: list[str], **values: str) -> DataFrame:
    """The rows and one more whose columns are 'n/a' but for the given values."""
    return rows.select(*columns).unionByName(rows.sparkSession.range(1).select(*(F.lit(values.get(c, "n/a")).alias(c) for c in columns)))


@model("final")
def dim_institution(ctx: Context) -> DataFrame:
    return with_default_member(ctx.table("alliance_institution"), list(INSTITUTION_COLUMNS), institution_id="OTHER", institution_name="Other")


@model("final")
def dim_research_area(ctx: Context) -> DataFrame:
    return with_default_member(ctx.table("cerif_research_area"), [f"research_{level}_{kind}" for level in ("branch", "subbranch", "area") for kind in ("code", "name")])


@model("final", "mart_collaboration_by_article", "stg_article_research_area", "int_article_citation_normalized", "stg_collaboration_novelty_index", "int_collaboration")
def fct_article(ctx: Context) -> DataFrame:
    new = ctx.ref("int_collaboration").groupBy("article_id").agg((F.bool_or("has_new_author_collaboration") | F.bool_or("has_new_institution_collaboration")).alias("is_new_collaboration"))
    rows = ctx.ref("mart_collaboration_by_article").drop("article_citation_count").join(ctx.ref("stg_article_research_area"), "article_id", "left").join(ctx.ref("int_article_citation_normalized"), "article_id", "left")
    rows = rows.join(ctx.ref("stg_collaboration_novelty_index"), "article_id", "left").join(new, "article_id", "left")
    return rows.select(
        "article_id", F.coalesce("research_area_code", F.lit("n/a")).alias("research_area_code"), "article_citation_count", "article_citation_normalized_count", "article_publication_dt", *FLAGS, "is_new_collaboration",
        F.coalesce("collaboration_novelty_index", F.lit(0.0)).alias("collaboration_novelty_index"),
    )


@model("final", "int_article_keyword")
def fct_article_keyword(ctx: Context) -> DataFrame:
    return ctx.ref("int_article_keyword").select("article_id", "article_keyword", "research_area_code")


def keyword_trend(counts: DataFrame, uses: DataFrame) -> DataFrame:
    """Trends of keywords within areas, from counts (article_keyword, article_publication_year, publication_count) and uses
    (article_keyword, research_area_code), a row for each article that has the keyword.

    An area's total of a year counts a keyword once for each article. The normalised count is the count over log10(1 +
    total), cut to a whole number; its growth over the year before (the row before) is averaged over three rows and
    compared with the area's median. Equal years of a keyword are ordered by count.
    """
    area_year = ["research_area_code", "article_publication_year"]
    used = counts.join(uses.groupBy("article_keyword", "research_area_code").agg(F.count("*").alias("times")), "article_keyword")
    total = used.groupBy(*area_year).agg(F.sum(F.col("publication_count") * F.col("times")).alias("total"))
    n, t = F.col("publication_count"), F.col("total")
    rows = used.drop("times").distinct().join(total, area_year)
    rows = rows.withColumn("norm", F.when(n <= 1, n.cast("bigint")).otherwise(truncated_quotient(n.cast("double"), F.log10(1 + t))))
    by = Window.partitionBy("article_keyword", "research_area_code").orderBy("article_publication_year", "publication_count")
    rows = rows.withColumn("before", F.lag("norm").over(by)).withColumn("yoy", F.when(F.col("before") != 0, (F.col("norm") - F.col("before")) / F.col("before")))
    rows = rows.withColumn("rolling", F.avg("yoy").over(by.rowsBetween(-2, 0)))
    median = lambda c: F.percentile(c, 0.5)
    base = rows.groupBy(*area_year).agg(median("publication_count").alias("b_n"), median("norm").alias("b_norm"), median("yoy").alias("b_yoy"), median("rolling").alias("b_rolling"))
    diff = F.col("rolling") - F.col("b_rolling")
    return rows.join(base, area_year, "left").select(
        "article_keyword", *area_year, "publication_count", F.col("norm").alias("publication_normalized_count"), F.col("yoy").alias("publication_count_yoy"), F.col("rolling").alias("publication_count_yoy_3yr_rolling_avg"),
        F.col("b_n").alias("publication_count_baseline"), F.col("b_norm").alias("publication_normalized_count_baseline"), F.col("b_yoy").alias("publication_count_yoy_baseline"), F.col("b_rolling").alias("publication_count_yoy_3yr_rolling_avg_baseline"),
        diff.alias("publication_count_yoy_3yr_rolling_avg_diff"), truncated_quotient(diff, F.when(F.col("b_rolling") == 0, 1.0).otherwise(F.col("b_rolling"))).alias("publication_count_yoy_3yr_rolling_avg_diff_pct"),
        F.coalesce(F.col("rolling") > F.col("b_rolling") + 0.02, F.lit(False)).alias("is_trend_positive"),
    )


@model("final", "int_article_keyword_trend", "int_article_keyword")
def fct_article_keyword_trend(ctx: Context) -> DataFrame:
    return keyword_trend(ctx.ref("int_article_keyword_trend"), ctx.ref("int_article_keyword").select("article_keyword", "research_area_code"))


@model("final", "fct_article", "fct_article_keyword", "fct_article_keyword_trend")
def fct_article_by_keyword_popularity(ctx: Context) -> DataFrame:
    articles = ctx.ref("fct_article").where(~F.col("is_single_author_collaboration")).select("article_id", F.year("article_publication_dt").alias("article_publication_year"), F.when(F.col("is_new_collaboration"), "new").otherwise("existing").alias("collaboration_type"))
    trend = ctx.ref("fct_article_keyword_trend").select("article_keyword", "research_area_code", "article_publication_year", "is_trend_positive", F.col("publication_count_yoy_3yr_rolling_avg_diff").alias("d")).distinct()
    rows = ctx.ref("fct_article_keyword").join(articles, "article_id").join(trend, ["article_keyword", "research_area_code", "article_publication_year"])
    return rows.groupBy("article_id", "collaboration_type").agg(F.countDistinct(F.when(F.col("is_trend_positive"), F.col("article_keyword"))).alias("keyword_popularity"), F.sum("d").alias("keyword_popularity_index"))


@model("final", "int_collaboration", "int_author_experience_by_article")
def fct_collaboration(ctx: Context) -> DataFrame:
    flags = ["has_new_author_collaboration", "has_new_institution_collaboration"]
    rows = ctx.ref("int_collaboration").join(ctx.ref("int_author_experience_by_article"), ["article_id", "author_id"], "left")
    return rows.select("article_id", "author_id", "research_area_code", "author_sequence_type", "institution_id", "article_publication_dt", *FLAGS, *(F.coalesce(f, F.lit(False)).alias(f) for f in flags), F.coalesce("article_count", F.lit(0)).alias("author_article_count"))


@model("final", "stg_new_author_pair")
def fct_new_author_pair(ctx: Context) -> DataFrame:
    return ctx.ref("stg_new_author_pair")


# --------------------------------------------------------------------------------------------------------------------- graph


@model("graph", "int_collaboration")
def graph_author(ctx: Context) -> DataFrame:
    return ctx.ref("int_collaboration").groupBy("author_id").agg(F.countDistinct("article_id").alias("n")).where(F.col("n") >= GRAPH_ARTICLES).select("author_id")


@model("graph", "int_collaboration", "graph_author")
def graph_article(ctx: Context) -> DataFrame:
    return ctx.ref("int_collaboration").join(ctx.ref("graph_author"), "author_id", "left_semi").select("article_id", "article_publication_dt").distinct()


@model("graph", "graph_article")
def graph_article_embedding(ctx: Context) -> DataFrame:
    return ctx.table("article_text_embedding").join(ctx.ref("graph_article"), "article_id").select("article_id", "article_publication_dt", F.col("article_text_embedding").alias("article_embedding"))


@model("graph", "fct_article_keyword", "graph_article", "fct_article_keyword_trend")
def graph_author_top_keywords(ctx: Context) -> DataFrame:
    """Trends, over the five years before each article, of those of its keywords that are among the most used ones."""
    words = ctx.ref("fct_article_keyword")
    top = words.groupBy("article_keyword").agg(F.countDistinct("article_id").alias("n")).orderBy(F.desc("n"), "article_keyword").limit(TOP_KEYWORDS).select("article_keyword")
    rows = words.join(ctx.ref("graph_article").select("article_id", "article_publication_dt"), "article_id").join(F.broadcast(top), "article_keyword", "left_semi").withColumn("y", F.year("article_publication_dt"))  # TOP_KEYWORDS rows
    trend = ctx.ref("fct_article_keyword_trend").select("article_keyword", "research_area_code", F.col("article_publication_year").alias("t"), F.col("publication_count_yoy_3yr_rolling_avg_diff").alias("keyword_popularity_index"))
    return rows.join(trend, ["article_keyword", "research_area_code"]).where("t between y - 5 and y - 1").select("article_id", "article_publication_dt", "article_keyword", "research_area_code", (F.col("t") - F.col("y")).alias("kpi_year"), "keyword_popularity_index")


def co_author_edges(rows: DataFrame, article: str, author: str, date: str, marked: str, least: int) -> DataFrame:
    """Directed edges of authors with at least `least` common articles: first common day as yyyyMMdd, and how many common
    articles are marked. Pairs are built once (a < b) and mirrored, which halves the shuffle."""
    each = rows.groupBy(article, author).agg(F.min(date).alias("d"), F.bool_or(marked).alias("m"))
    pairs = each.select(article, F.col(author).alias("a"), "d", "m").join(each.select(article, F.col(author).alias("b")), article).where("a < b")
    edges = pairs.groupBy("a", "b").agg(F.count("*").alias("n"), F.min("d").alias("d"), F.count(F.when(F.col("m"), 1)).alias("alliance_collaboration_count")).where(F.col("n") >= least)
    ends = F.explode(F.array(F.struct(F.col("a").alias("author_id"), F.col("b").alias("co_author_id")), F.struct(F.col("b").alias("author_id"), F.col("a").alias("co_author_id"))))
    return edges.select(ends.alias("e"), F.date_format("d", "yyyyMMdd").alias("time"), "alliance_collaboration_count").select("e.*", "time", "alliance_collaboration_count")


def _graph_rows(ctx: Context) -> DataFrame:
    return ctx.ref("int_collaboration").join(ctx.ref("graph_author"), "author_id", "left_semi").join(ctx.ref("graph_article").select("article_id").distinct(), "article_id", "left_semi")


@model("graph", "int_collaboration", "graph_author", "graph_article")
def graph_edge_co_authors(ctx: Context) -> DataFrame:
    return co_author_edges(_graph_rows(ctx), "article_id", "author_id", "article_publication_dt", "is_alliance_collaboration", EDGE_ARTICLES)


@model("graph", "graph_edge_co_authors")
def graph_temporal_edge_co_authors(ctx: Context) -> DataFrame:
    """The other graph has the same edges."""
    return ctx.ref("graph_edge_co_authors")


@model("graph", "int_collaboration", "graph_author", "graph_article", "int_article_citation_normalized", "stg_collaboration_novelty_index")
def graph_node_author_article(ctx: Context) -> DataFrame:
    rows = _graph_rows(ctx).select("author_id", "article_id", "article_publication_dt").join(ctx.ref("int_article_citation_normalized").select("article_id", "article_citation_normalized_count"), "article_id", "left").join(ctx.ref("stg_collaboration_novelty_index"), "article_id", "left")
    return rows.groupBy("author_id", "article_id", "article_publication_dt").agg(F.sum("article_citation_normalized_count").alias("article_citation_normalized_count"), F.percentile("collaboration_novelty_index", 0.5).alias("collaboration_novelty_index"))


@model("graph", "int_collaboration", "graph_author", "graph_article")
def graph_edge_publishes(ctx: Context) -> DataFrame:
    return _graph_rows(ctx).select("author_id", "article_id", F.date_format("article_publication_dt", "yyyyMMdd").alias("time")).distinct()


@model("graph", "fct_article", "graph_article_embedding")
def graph_node_article(ctx: Context) -> DataFrame:
    facts = ctx.ref("fct_article").select("article_id", "article_citation_normalized_count", F.when(F.col("is_alliance_collaboration"), 1).otherwise(0).alias("is_alliance_collaboration"), "collaboration_novelty_index")
    return ctx.ref("graph_article_embedding").select("article_id", "article_embedding").join(facts, "article_id")


@model("graph", "graph_author")
def graph_node_author(ctx: Context) -> DataFrame:
    return ctx.ref("graph_author").select("author_id", F.lit(1).alias("dummy_feature"))
