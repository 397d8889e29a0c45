"""Sources: JSON documents by time, HTML tables, registries, and a seam for network APIs."""

from __future__ import annotations

import random
import time
from collections import deque
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_documents(spark: SparkSession, path: str, schema: str, start: str | None = None, end: str | None = None, at: str = "last_modified") -> DataFrame:
    """JSON lines with an explicit schema, `start` <= at <= `end` (both included; None is open). Unreadable lines are left
    out; nothing is inferred, and the range is a filter that Spark pushes to the scan."""
    rows = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    if start is not None:
        rows = rows.where(F.col(at) >= F.lit(start))
    return rows if end is None else rows.where(F.col(at) <= F.lit(end))


def registry(spark: SparkSession, rows: dict[str, dict[str, str]], key: str, columns: list[str]) -> DataFrame:
    """A small dictionary of records as a table, absent members as null."""
    return spark.createDataFrame([(k, *(v.get(c) for c in columns)) for k, v in sorted(rows.items())], ", ".join(f"{c} string" for c in (key, *columns)))


class RateLimiter:
    """Waits so that no more than `most` calls begin within any second of this process."""

    def __init__(self, most: int, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> None:
        self.most, self.clock, self.sleep, self.calls = most, clock, sleep, deque()

    def wait(self) -> None:
        now = self.clock()
        while self.calls and now - self.calls[0] >= 1:
            self.calls.popleft()
        if len(self.calls) >= self.most:
            self.sleep(1 - (now - self.calls[0]))
            now = self.clock()
            self.calls.popleft()
        self.calls.append(now)


def final(error: Exception) -> bool:
    """Whether trying again is of no use: the error carries an HTTP status (its own or its response's) under 500."""
    status = getattr(error, "status", None) or getattr(getattr(error, "response", None), "status_code", None) or getattr(error, "code", None)
    return isinstance(status, int) and status < 500


def with_retries(call: Callable[[], object], tries: int = 8, first_wait: float = 0.5, sleep: Callable[[float], None] = time.sleep, gives_up: Callable[[Exception], bool] = final) -> object:
    """call() with exponential backoff and jitter; the last failure, or one that gives_up tells is final, is raised."""
    for k in range(tries):
        try:
            return call()
        except Exception as error:
            if k == tries - 1 or gives_up(error):
                raise
            sleep(first_wait * 2**k * (1 + random.random()))
    return None


def fetch_each(keys: DataFrame, key: str, fetch: Callable[[str], str | None], tries: int = 8, per_second: int | None = None) -> DataFrame:
    """(key, document, error) of fetch(key) for each distinct non-null key, run by the tasks. A key whose fetch
    keeps failing has a null document and the error's text. fetch is the seam: a network call, or a lookup in tests.
    per_second (ST4) holds for all tasks together: there are no more tasks than that, and each has its share of the calls."""
    rows = keys.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("k")).distinct()
    share = None
    if per_second:
        tasks = max(1, min(per_second, keys.sparkSession.sparkContext.defaultParallelism))
        rows, share = rows.repartition(tasks, "k"), per_second // tasks

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        limiter = RateLimiter(share) if share else None
        for batch in batches:
            rows = []
            for k in batch["k"]:
                if limiter:
                    limiter.wait()
                try:
                    rows.append((k, with_retries(lambda k=k: fetch(k), tries), None))
                except Exception as e:  # noqa: BLE001
                    rows.append((k, None, f"{type(e).__name__}: {e}"[:500]))
            yield pd.DataFrame(rows, columns=["k", "document", "error"])

    return rows.mapInPandas(run, "k string, document string, error string").withColumnRenamed("k", key)


def access_token(post: Callable[[dict[str, str]], dict], client_id: str, client_secret: str) -> str:
    """The token that a server gives for client credentials. post sends the form and returns the answer's object; an
    answer without a token is an error."""
    answer = post({"client_id": client_id, "client_secret": client_secret, "grant_type": "client_credentials", "scope": "/read-public"})
    if not answer.get("access_token"):
        raise PermissionError(f"no token: {answer.get('error', 'empty answer')}")
    return answer["access_token"]


def member_documents(members: DataFrame, part: str, fetch: Callable[[str], str | None], per_second: int = 12) -> DataFrame:
    """(member_id, member_<part>, error) for members (member_id): their works, person or employments. fetch gets the path
    below the service's root, <member>/<part>. Of works the list of groups is kept, of employments that of affiliation groups."""
    inside = {"works": "$.group", "employments": "$['affiliation-group']"}
    paths = members.where("member_id is not null").select(F.concat_ws("/", "member_id", F.lit(part)).alias("path"))
    got = fetch_each(paths, "path", fetch, per_second=per_second)
    document = F.get_json_object("document", inside[part]) if part in inside else F.col("document")
    return got.select(F.substring_index("path", "/", 1).alias("member_id"), document.alias(f"member_{part}"), "error")


def yearly_counts(keywords: DataFrame, keyword: str, fetch: Callable[[str], str | None], first: int, last: int, per_second: int | None = None) -> DataFrame:
    """(keyword, year, publication_count) of each distinct keyword and year from first to last. fetch gets "year keyword"
    and returns the answer, whose total of hits counts; keys that fail have a null count."""
    words = keywords.where(F.col(keyword).isNotNull()).select(F.col(keyword).alias("w")).distinct()
    years = keywords.sparkSession.range(first, last + 1).select(F.col("id").cast("string").alias("y"))
    keys = words.crossJoin(F.broadcast(years)).select(F.concat_ws(" ", "y", "w").alias("key"))  # a row a year
    got = fetch_each(keys, "key", fetch, per_second=per_second)
    total = F.get_json_object("document", "$.message['total-results']").try_cast("int")
    return got.select(F.expr("substring(key, 6)").alias(keyword), F.substring("key", 1, 4).cast("int").alias("year"), total.alias("publication_count"))


def page_starts(spark: SparkSession, found: int, page: int) -> DataFrame:
    """(page_no, start) of each page of a search with `found` hits; an exact multiple has a last empty page."""
    return spark.range(found // page + 1).select(F.col("id").cast("int").alias("page_no"), (F.col("id") * page).alias("start"))


def search_top(documents: DataFrame, text: str, keyword: str, score: str, n: int, needs: str) -> DataFrame:
    """The n best documents that hold the keyword and whose column `needs` is not null; ties by text."""
    return documents.where(F.contains(F.lower(text), F.lit(keyword.lower())) & F.col(needs).isNotNull()).orderBy(F.desc(score), text).limit(n)


class _Rows(HTMLParser):
    """The rows of tables: (class of the row, texts of its cells)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[tuple[str, list[str]]] = []
        self.cell: list[str] | None = None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "tr":
            self.rows.append((dict(attrs).get("class") or "", []))
        elif tag in ("td", "th") and self.rows:
            self.cell = []

    def handle_data(self, data: str) -> None:
        if self.cell is not None:
            self.cell.append(data)

    def handle_endtag(self, tag: str) -> None:
        if tag in ("td", "th") and self.cell is not None:
            self.rows[-1][1].append(" ".join("".join(self.cell).split()))
            self.cell = None


def html_rows(files: DataFrame, encoding: str = "utf-8") -> DataFrame:
    """(path, row_no, row_class, cells) of all table rows of HTML files (path, content), as Spark's binaryFile reader
    gives them. Bytes that the encoding lacks are replaced; null content has no rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for path, content in zip(batch["path"], batch["content"], strict=True):
                parser = _Rows()
                parser.feed((content or b"").decode(encoding, "replace"))
                out += [(path, i, kind, cells) for i, (kind, cells) in enumerate(parser.rows)]
            yield pd.DataFrame(out, columns=["path", "row_no", "row_class", "cells"])

    return files.select("path", "content").mapInPandas(run, "path string, row_no int, row_class string, cells array<string>")


def area_hierarchy(rows: DataFrame, branch: str, subbranch: str, area: str) -> DataFrame:
    """Areas with the branch and sub-branch above them, carried forward from header rows; a new branch resets the
    sub-branch ('n/a', 'Other' where there is none). Header cells read "name CODE 123"; area rows have code and name."""
    head = F.get("cells", F.lit(0))
    name, code = F.trim(F.regexp_replace(head, r"[A-Z]\s*\d+\s*$", "")), F.regexp_extract(head, r"([A-Z]\s*\d+)\s*$", 1)
    by = Window.partitionBy("path").orderBy("row_no")
    is_branch, is_sub = F.col("row_class") == branch, F.col("row_class") == subbranch
    rows = rows.withColumn("b", F.last(F.when(is_branch, F.struct(code.alias("code"), name.alias("name"))), ignorenulls=True).over(by))
    rows = rows.withColumn("bn", F.sum(is_branch.cast("int")).over(by))
    within = Window.partitionBy("path", "bn").orderBy("row_no")
    rows = rows.withColumn("s", F.last(F.when(is_sub, F.struct(code.alias("code"), name.alias("name"))), ignorenulls=True).over(within))
    return rows.where(F.col("row_class") == area).select(
        F.col("b.code").alias("research_branch_code"), F.col("b.name").alias("research_branch_name"), F.coalesce("s.code", F.lit("n/a")).alias("research_subbranch_code"), F.coalesce("s.name", F.lit("Other")).alias("research_subbranch_name"),
        F.get("cells", F.lit(0)).alias("research_area_code"), F.get("cells", F.lit(1)).alias("research_area_name"),
    )
