"""A whole refresh: what is fetched for a window of days, parsed, modelled, enriched and modelled again, each step once."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyrine.config import EngineConfig
from papyrine.operators.enrich import frequent_word_language, hashed_vectors, joined_text, nearest_labels, top_terms
from papyrine.operators.novelty import novelty
from papyrine.operators.parse import parse_affiliations, parse_crossref, parse_member_works, parse_publications
from papyrine.plans.models import Context
from papyrine.plans.pipeline import run as run_models
from papyrine.session import checkpointed, read_table
from papyrine.sources.sinks import append, audited, delete_insert, fingerprint, is_done, mark_done, refresh, unprocessed

#: Days that a period looks back (ST5).
PERIODS = {"week": 7, "month": 30}


def window(period: str, today: dt.date) -> tuple[str, str]:
    """F17, ST5: the first and last day of a period that ends today."""
    return str(today - dt.timedelta(days=PERIODS[period])), str(today)


@dataclass
class Run:
    """One refresh. A step gets this and returns nothing; it reads and writes tables of the lake."""

    spark: SparkSession
    config: EngineConfig
    start: str
    end: str
    #: Seams: a source's name -> a function of this run that gives the rows fetched for the window (K1), or a model's name
    #: ("language", "embedding", "keywords") -> a function of (rows with article_id and text) that gives its table.
    seams: Mapping[str, Callable]

    @property
    def spec(self) -> str:
        return fingerprint(updated_date_start=self.start, updated_date_end=self.end)

    def has(self, name: str) -> bool:
        return is_done(self.spark, f"{self.config.lake}/{name}.parquet")

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.config.lake, name)

    def add(self, name: str, rows: DataFrame) -> None:
        """Appends rows with their audit columns, in place of those that a run of the same window left (K3)."""
        path = f"{self.config.lake}/{name}.parquet"
        fresh = audited(rows, self.spec)
        if not self.has(name):
            append(fresh, path)
            return
        old = self.table(name)
        if "task_params_spec" not in old.columns:
            fresh = fresh.drop("task_params_spec")
            if "row_created_at" not in old.columns:
                fresh = fresh.drop("row_created_at")
            append(fresh, path)
        else:
            refresh(checkpointed(delete_insert(old, fresh, F.col("task_params_spec") == self.spec)), path)


def fetch(source: str) -> Callable[[Run], None]:
    def step(run: Run) -> None:
        if source in run.seams:
            run.add(source, run.seams[source](run))

    return step


def parse(source: str, target: str, of: Callable[[DataFrame, Run], DataFrame], date: str | None) -> Callable[[Run], None]:
    """Parses the window's rows of a source; those of the target with a date of the window give way (K4)."""

    def step(run: Run) -> None:
        if not run.has(source):
            return
        fresh = of(run.table(source), run)
        if run.has(target):
            old = run.table(target)
            same = [c for c in old.columns if c in fresh.columns]
            inside = F.col(date).between(F.lit(run.start).cast("date"), F.lit(run.end).cast("date")) if date else F.lit(True)
            fresh = delete_insert(old.select(same), fresh.select(same), inside)
        refresh(checkpointed(fresh.withColumn("row_created_at", F.current_timestamp()) if "row_created_at" not in fresh.columns else fresh), f"{run.config.lake}/{target}.parquet")

    return step


def member_works(raw: DataFrame, run: Run) -> DataFrame:
    years = range(max(run.config.first_year, int(run.start[:4])), int(run.end[:4]) + 1)
    parts = [parse_member_works(raw, year) for year in years]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def models(tag: str) -> Callable[[Run], None]:
    def step(run: Run) -> None:
        run_models(Context(run.spark, run.config.lake), run.config.warehouse, tag)

    return step


def texts(run: Run, done: str) -> DataFrame:
    """(article_id, text) of the articles that the table `done` lacks (ST1): title and abstract."""
    rows = read_table(run.spark, run.config.warehouse, "mart_article").select("article_id", joined_text(" ", "article_title", "article_abstract").alias("text"))
    return unprocessed(rows, run.table(done), "article_id") if run.has(done) else rows


def enrich(name: str, target: str, default: Callable[[DataFrame], DataFrame]) -> Callable[[Run], None]:
    """A model's table for articles that it lacks, by its seam or else the default that needs no model."""

    def step(run: Run) -> None:
        run.add(target, run.seams.get(name, default)(texts(run, target)))

    return step


def novelty_tables(run: Run) -> None:
    """The history is gone through anew, as later articles never change earlier ones."""
    facts = read_table(run.spark, run.config.warehouse, "mart_collaboration_by_article").where(~F.col("is_single_author_collaboration")).select("article_id", F.col("article_publication_dt").alias("dt"))
    rows = read_table(run.spark, run.config.warehouse, "mart_collaboration").join(facts, "article_id").where(F.year("dt") >= run.config.first_year)
    names = ("collaboration_novelty_index", "collaboration_novelty_metadata", "new_author_pair")
    for name, table in zip(names, novelty(rows, checkpointed), strict=True):
        refresh(audited(table, run.spec), f"{run.config.lake}/{name}.parquet")


def areas(run: Run) -> None:
    """Articles get the areas of the three nearest seeds; seeds are embedded as articles are."""
    seeds_of = "crossref_top_n_research_area_publication"
    if not run.has("article_text_embedding") or not run.has(seeds_of):
        return
    doc = F.col("publication_metadata")
    seeds = run.table(seeds_of).select(F.col("publication_doi").alias("article_id"), "cerif_research_area_code", F.concat_ws(" ", F.get_json_object(doc, "$.title[0]"), F.get_json_object(doc, "$.abstract")).alias("text"))
    embedded = run.seams.get("embedding", vectors)(seeds.select("article_id", "text").distinct())
    seeds = embedded.join(seeds.select("article_id", "cerif_research_area_code").distinct(), "article_id")
    new = run.table("article_text_embedding")
    if run.has("article_research_area"):
        new = unprocessed(new, run.table("article_research_area"), "article_id")
    got = nearest_labels(new, "article_id", "article_text_embedding", seeds, "article_id", "article_text_embedding", "cerif_research_area_code")
    run.add("article_research_area", got.select("article_id", F.col("cerif_research_area_code").alias("research_area_code"), F.col("rank").alias("research_area_rank")))


def languages(rows: DataFrame) -> DataFrame:
    return rows.select("article_id", frequent_word_language(F.col("text")).alias("article_language"))


def vectors(rows: DataFrame) -> DataFrame:
    return hashed_vectors(rows, "article_id", "text").withColumnRenamed("vector", "article_text_embedding")


def keywords(rows: DataFrame) -> DataFrame:
    return top_terms(rows, "article_id", "text").withColumnRenamed("keywords", "article_keywords_arr")


#: The steps in order: (name, step). Steps whose source has no seam leave their table as it is.
STEPS: tuple[tuple[str, Callable[[Run], None]], ...] = (
    *((f"fetch_{s}", fetch(s)) for s in ("elsevier_publication", "elsevier_publication_affiliation", "orcid_modified_member", "orcid_member_works", "orcid_member_person", "orcid_member_employments", "crossref_publication", "cerif_research_area")),
    ("parse_elsevier_affiliations", parse("elsevier_record", "elsevier_publication_affiliation", lambda raw, run: parse_affiliations(raw), None)),
    ("parse_elsevier_publications", parse("elsevier_publication", "elsevier_publication_parsed", lambda raw, run: parse_publications(raw, run.start, run.end), "article_publication_dt")),
    ("parse_orcid_member_works", parse("orcid_member_works", "orcid_member_works_parsed", member_works, "article_publication_dt")),
    ("parse_crossref_publications", parse("crossref_publication", "crossref_publication_parsed", lambda raw, run: parse_crossref(raw, run.start, run.end), "article_publication_dt")),
    ("model_data_ingestion", models("data_ingestion")),
    ("calculate_novelty", novelty_tables),
    ("classify_language", enrich("language", "article_language", languages)),
    ("fetch_seeds", fetch("crossref_top_n_research_area_publication")),
    ("embed_articles", enrich("embedding", "article_text_embedding", vectors)),
    ("classify_research_area", areas),
    ("generate_keywords", enrich("keywords", "article_keywords", keywords)),
    ("fetch_keyword_trend", fetch("article_keyword_trend")),
    ("model_data_enrichment", models("data_enrichment")),
)


def run_refresh(spark: SparkSession, config: EngineConfig, period: str = "week", today: dt.date | None = None, seams: Mapping[str, Callable] | None = None, only: tuple[str, ...] | None = None) -> list[str]:
    """All steps (or those named) for the window of the period; returns the names of those done now. Each leaves a marker of
    the window (K9), so a refresh that was interrupted goes on where it stopped."""
    start, end = window(period, today or dt.date.today())
    run = Run(spark, config, start, end, seams or {})
    done = []
    for name, step in STEPS:
        marker = f"{config.warehouse}/_refresh/{start}_{end}/{name}.json"
        if (only is None or name in only) and not is_done(spark, marker):
            step(run)
            mark_done(spark, marker, step=name, start=start, end=end)
            done.append(name)
    return done
