"""The same researchers in sources without a common key (problem 5), matched by loopy belief propagation.

Candidate pairs of a member and an author share at least one work (by DOI, by EID or by title, also with a typing error). Each pair is a variable
whose prior odds come from the agreement of the names and the number of shared works. Two kinds of factors tie the pairs:
an author belongs to at most one member, and a member seldom has more than one author id. Messages go back and forth
through joins until the beliefs settle; the result is every pair's marginal probability.
"""

from __future__ import annotations

import itertools
import math
import warnings
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from papyrine.llm.names import form, similarity
from papyrine.operators.shredding import shred
from papyrine.session import checkpointed, read_table

#: A key (DOI, EID or title) that more articles than this hold tells less which of them is meant: each counts as so many of a
#: work as this is of their number. Keys that more members than this hold are joined in parts.
SHARED_KEY = 50
#: Log odds: without agreement of names; where a name is missing; with agreement, and what a full agreement adds to a bare
#: one; for shared works (times the logarithm of 1 + half their number); for sharing a greater part of the member's works.
NO_NAME, UNKNOWN_NAME, NAME, FULL_NAME, WORK, SHARE = -7.0, -4.0, 0.5, 2.5, 2.0, 2.0
#: Factor on the odds of each further author id of a member.
FURTHER_AUTHOR = 0.3
#: Exchanges of messages after which a warning says that they haven't settled, the change of a probability that counts as
#: settled, damping, and prior log odds under which a pair's own messages stay as its prior gives them.
ROUNDS, SETTLED, DAMPING, HOPELESS = 60, 0.01, 0.2, -3.0


def doi_key(doi: Column) -> Column:
    """A DOI in lower case without a resolver or prefix; null if nothing is left."""
    return F.nullif(F.regexp_replace(F.lower(F.trim(doi)), r"^(https?://[^/]+/|doi:\s*)", ""), F.lit(""))


def orcid_key(orcid: Column) -> Column:
    """The sixteen characters of an ORCID in any style, in groups of four; null if there are none."""
    raw = F.upper(F.regexp_extract(orcid, r"(\d{4}-?\d{4}-?\d{4}-?\d{3}[\dXx])\s*/?$", 1))
    compact = F.regexp_replace(raw, "-", "")
    return F.when(F.length(compact) == 16, F.concat_ws("-", *(F.substring(compact, i, 4) for i in (1, 5, 9, 13))))


def title_key(title: Column) -> Column:
    """The letters and digits of a title in lower case, without markup; null if under twelve."""
    text = F.regexp_replace(F.regexp_replace(F.lower(title), r"<[^>]*>|&#?\w+;", " "), r"[^\p{L}\p{N}]+", "")
    return F.when(F.length(text) >= 12, text)


def short_title_key(title: Column) -> Column:
    """As title_key, of the titles that are shorter than that needs. Many works may share one, so it tells little."""
    text = F.regexp_replace(F.regexp_replace(F.lower(title), r"<[^>]*>|&#?\w+;", " "), r"[^\p{L}\p{N}]+", "")
    return F.when((F.length(text) < 12) & (F.length(text) > 0), text)


def keyed(rows: DataFrame, owner: str, keys: dict[str, Column]) -> DataFrame:
    """(owner, key): a hash of each non-null key with its kind. Two keys share a hash with a chance of 2 ** -64. Keys are
    hashed before anything is shuffled."""
    each = F.array(*(F.when(column.isNotNull(), F.xxhash64(F.lit(kind), column)) for kind, column in keys.items()))
    return rows.select(owner, each.alias("keys")).distinct().select(owner, F.explode(F.array_compact("keys")).alias("key")).distinct()


def without_two_parts(texts: list[str], asked: bool) -> tuple[np.ndarray, np.ndarray]:
    """(place in texts, hash) of each text without two of its PARTS parts, for every two.

    A part reaches one letter over its ends, so a letter left out of each of two texts leaves all outside of some two parts
    alike. Texts that are asked for give the hashes that such a partner would have: of their length, with all in its place
    or what stands between the two parts moved by one, or of one letter more or less with both errors in neighbouring parts.
    """
    sizes = np.array([len(x) for x in texts], np.int64)
    letters = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    starts = np.cumsum(sizes) - sizes
    place = np.arange(len(letters)) - np.repeat(starts, sizes)
    longest = int(sizes.max(initial=0)) + 1
    powers, back = np.ones(longest, np.uint64), np.ones(longest, np.uint64)
    for own, base in ((powers, _BASE), (back, pow(_BASE, -1, 1 << 64))):
        np.multiply.accumulate(np.full(longest - 1, base, np.uint64), out=own[1:])
    # the hash of a stretch is a polynomial of its letters modulo 2 ** 64
    upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum((letters + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) * powers[place])])
    owners, hashes = [], []
    for i, j in itertools.combinations(range(PARTS), 2):
        moves = [(0, 0)] if not asked else [(0, t) for t in (-1, 0, 1)] if j == i + 1 else [(-1, 0), (1, 0)]
        for shift, more in moves:
            n = sizes - more  # the partner's letters
            left = np.maximum(0, i * n // PARTS - 1)
            middle, until = (i + 1) * n // PARTS + 1, j * n // PARTS - 1
            right = np.maximum(0, n - (j + 1) * n // PARTS - 1)
            until = np.maximum(middle, until)
            at = np.flatnonzero((n > 0) & (left + right <= sizes) & ((until == middle) | (until + shift <= sizes)))
            begin, end = starts[at], starts[at] + sizes[at]
            a, b = np.minimum(middle[at] + shift, sizes[at]), np.minimum(until[at] + shift, sizes[at])
            value = (upto[begin + left[at]] - upto[begin]) * np.uint64(0xBF58476D1CE4E5B9)
            value += (upto[begin + b] - upto[begin + a]) * back[a] * np.uint64(0x94D049BB133111EB)
            value += (upto[end] - upto[end - right[at]]) * back[sizes[at] - right[at]]
            value += (n[at].astype(np.uint64) * np.uint64(PARTS * PARTS) + np.uint64(i * PARTS + j)) * np.uint64(0xD6E8FEB86659FD93)
            owners.append(at)
            hashes.append((value ^ value >> np.uint64(29)).view(np.int64))
    return np.concatenate(owners), np.concatenate(hashes)


def alike_without_a_letter(a: str, b: str) -> bool:
    """Whether two different texts are equal after a letter is left out of one or of each."""
    if len(a) > len(b):
        a, b = b, a
    p = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    q = next((i for i, (x, y) in enumerate(zip(a[p:][::-1], b[p:][::-1], strict=False)) if x != y), len(a) - p)
    x, y = a[p : len(a) - q], b[p : len(b) - q]
    return (len(x), len(y)) == (0, 1) or (len(x) == len(y) and (x[1:] == y[:-1] or x[:-1] == y[1:]))


#: Into how many parts a title is cut to find those with one error.
PARTS = 5
_BASE = 0xD6E8FEB86659FD93


def titles_of(rows: DataFrame) -> DataFrame:
    """(key, text): every title's key as in keyed, with its letters and digits."""
    texts = rows.select(title_key(F.col("article_title")).alias("text")).where("text is not null").distinct()
    return texts.select(F.xxhash64(F.lit("title"), "text").alias("key"), "text")


def near_titles(mine: DataFrame, theirs: DataFrame) -> DataFrame:
    """(key, near): keys of different titles (key, text) of both sides that are equal after a letter is left out of one or of
    each, so all pairs with one letter changed, added or left out. Titles with different numbers name different works."""

    def parts(rows: DataFrame, name: str, asked: bool) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch):
                    place, hashes = without_two_parts(batch["text"].tolist(), asked)
                    yield pd.DataFrame({name: batch["key"].to_numpy()[place], "h": hashes})

        return rows.mapInPandas(run, f"{name} long, h long")

    def alike(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            good = [alike_without_a_letter(a, b) for a, b in zip(batch["text"], batch["other"], strict=True)]
            yield batch.loc[np.array(good, bool), ["key", "near"]]

    both = parts(mine, "key", True).join(parts(theirs, "near", False), "h").where("key <> near").select("key", "near").distinct()
    both = both.join(mine, "key").join(theirs.select(F.col("key").alias("near"), F.col("text").alias("other")), "near")
    numbers = lambda text: F.regexp_replace(text, r"\P{N}+", " ")
    both = both.where((F.levenshtein("text", "other", 2) >= 0) & (numbers("text") == numbers("other")))
    return both.select("key", "near", "text", "other").mapInPandas(alike, "key long, near long")


def meet(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """left joined with right by key, whole: the rows of left that share a key beyond SHARED_KEY are spread over as many parts
    by hash, each with a copy of right's rows of that key, so no task joins a frequent key alone."""
    parts = left.groupBy(key).agg(F.ceil(F.count("*") / SHARED_KEY).cast("int").alias("_parts")).where("_parts > 1")
    spread = F.coalesce("_parts", F.lit(1))
    one = left.join(parts, key, "left").withColumn("_part", F.pmod(F.xxhash64(*left.columns), spread).cast("int")).drop("_parts")
    other = right.join(parts, key, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), spread - 1))).drop("_parts")
    return one.join(other, [key, "_part"]).drop("_part")


def shared_works(works: DataFrame, articles: DataFrame) -> DataFrame:
    """(member_id, article_id, weight): works (member_id, key) met with articles (article_id, key) by any key. The weight is 1,
    or SHARED_KEY of the articles of the pair's most telling key if more hold that."""
    crowd = articles.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > SHARED_KEY).select("key", (SHARED_KEY / F.col("n")).alias("weight"))
    weighed = articles.join(crowd, "key", "left").withColumn("weight", F.coalesce("weight", F.lit(1.0)))
    return meet(works, weighed, "key").groupBy("member_id", "article_id").agg(F.max("weight").alias("weight"))


def with_prior(pairs: DataFrame) -> DataFrame:
    """pairs (member_id, author_id, works, share, member_names, author_names; names as forms) with their prior log odds."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[tuple[str, ...], tuple[list[tuple[list[str], set[str]]], set[str]]] = {}

        def forms(names: tuple[str, ...]) -> tuple[list[tuple[list[str], set[str]]], set[str]]:
            """Of each form the parts, and these with and (if so long that a typing error counts) without each letter: names
            that agree in a surname share one of these. And what all of them have."""
            if names not in known:
                if len(known) > 30_000:
                    known.clear()
                each = []
                for name in names:
                    own = name.split(" ")
                    long = [x for t in own for x in t.split("-") if len(x) > 1]
                    each.append((own, {*long, *(x[:i] + x[i + 1 :] for x in long if len(x) > 3 for i in range(len(x)))}))
                known[names] = each, set().union(*(keys for _, keys in each))
            return known[names]

        for batch in batches:
            odds = []
            for works, share, mine, theirs in zip(batch["works"], batch["share"], batch["member_names"], batch["author_names"], strict=True):
                if mine is None or theirs is None or not len(mine) or not len(theirs):
                    value = UNKNOWN_NAME
                else:
                    (a, p), (b, q) = forms(tuple(mine)), forms(tuple(theirs))
                    best = 0.0
                    if not p.isdisjoint(q):
                        best = max((similarity(*sorted((x, y)), _NO_COUNTS)[0] for x, u in a for y, v in b if not u.isdisjoint(v)), default=0.0)
                    value = NAME + FULL_NAME * best if best > 0 else NO_NAME
                odds.append(value + WORK * math.log1p(works / 2) + SHARE * (share - 0.5))
            yield pd.DataFrame({"member_id": batch["member_id"], "author_id": batch["author_id"], "prior": odds})

    return pairs.mapInPandas(run, "member_id string, author_id string, prior double")


def formed(rows: DataFrame, key: str) -> DataFrame:
    """(key, form): the different forms of the names of rows (key, name) that have a letter."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({key: batch[key], "form": [form(x) for x in batch["name"]]})

    return rows.where("trim(name) <> ''").select(key, "name").distinct().mapInPandas(run, f"{key} string, form string").where("form <> ''").distinct()


class _Longest:
    """Stands for the counts of parts where there are none: the longer a part, the rarer."""

    def get(self, part: str, default: int = 0) -> int:
        return -len(part)


_NO_COUNTS = _Longest()


def propagate(pairs: DataFrame) -> DataFrame:
    """(member_id, author_id, probability) from pairs (member_id, author_id, prior), by loopy belief propagation.

    Factor of an author: at most one of its pairs holds. Factor of a member: each pair beyond the first costs
    FURTHER_AUTHOR. Both send their messages in closed form, from a sum over the author's or member's pairs (map-side
    summed, then joined back), so that no group is gathered in one task. Messages are exchanged until no probability changes
    by SETTLED; if that takes more than ROUNDS rounds, a warning tells the last change. Pairs whose prior log odds are under
    HOPELESS hardly weigh, so what they say is fixed by their prior and enters the sums once; they hear the others' messages
    at the end and have a marginal probability like all.
    """
    prior = F.greatest(F.lit(-20.0), F.least(F.lit(20.0), "prior"))
    live = F.col("prior") >= HOPELESS
    pairs = checkpointed(pairs.select("member_id", "author_id", prior.alias("prior")))
    one, r = F.lit(1.0), F.lit(FURTHER_AUTHOR)
    apart = pairs.where(~live).select("member_id", "author_id", F.exp("prior").alias("odds"))
    fixed_u = apart.groupBy("author_id").agg(F.sum("odds").alias("fixed_u"))
    fixed_v = apart.groupBy("member_id").agg(F.sum(F.log1p(r * F.col("odds"))).alias("fixed_v"))
    state = pairs.where(live).join(fixed_u, "author_id", "left").join(fixed_v, "member_id", "left").select(
        "member_id", "author_id", F.exp("prior").alias("odds"), F.coalesce("fixed_u", F.lit(0.0)).alias("fixed_u"), F.coalesce("fixed_v", F.lit(0.0)).alias("fixed_v"), one.alias("to_author"), one.alias("to_member"), F.lit(0.0).alias("probability"), F.lit(0.0).alias("old")
    )
    state = checkpointed(state)
    mixed = lambda old: F.pow(old, F.lit(DAMPING)) * F.pow("new", F.lit(1 - DAMPING))
    other_u, other_v = (F.greatest(F.lit(0.0), F.col(f"all_{x}") - F.col(x)) for x in "uv")
    says_author, p = 1 / (1 + other_u), F.exp(other_v)
    says_member = p / (1 + (p - 1) / r)
    for _ in range(ROUNDS):
        # to_member: what the author's factor says; to_author: what the member's factor says (ratios of true to false)
        said = state.withColumn("u", F.col("odds") * F.col("to_author"))
        total = said.groupBy("author_id").agg((F.sum("u") + F.max("fixed_u")).alias("all_u"))
        said = said.join(total, "author_id").withColumn("new", says_author)
        said = said.withColumn("to_member", mixed("to_member")).withColumn("v", F.log1p(r * F.col("odds") * F.col("to_member"))).drop("u", "all_u", "new")
        total = said.groupBy("member_id").agg((F.sum("v") + F.max("fixed_v")).alias("all_v"))
        said = said.join(total, "member_id").withColumn("new", says_member).withColumn("to_author", mixed("to_author"))
        belief = F.col("odds") * F.col("to_member") * F.col("to_author")
        state = checkpointed(said.select("member_id", "author_id", "odds", "fixed_u", "fixed_v", "to_author", "to_member", (belief / (1 + belief)).alias("probability"), F.col("probability").alias("old")))
        change = state.agg(F.max(F.abs(F.col("probability") - F.col("old")))).first()[0]
        if change is None or change < SETTLED:
            break
    else:
        warnings.warn(f"messages have not settled after {ROUNDS} rounds: a probability still changes by {change:.3f}", stacklevel=2)
    live_u = state.groupBy("author_id").agg(F.sum(F.col("odds") * F.col("to_author")).alias("live_u"))
    live_v = state.groupBy("member_id").agg(F.sum(F.log1p(r * F.col("odds") * F.col("to_member"))).alias("live_v"))
    for some, key in ((live_u, "author_id"), (fixed_u, "author_id"), (live_v, "member_id"), (fixed_v, "member_id")):
        apart = apart.join(some, key, "left")
    zero = lambda x: F.coalesce(x, F.lit(0.0))
    apart = apart.withColumn("u", F.col("odds")).withColumn("v", F.log1p(r * F.col("odds"))).withColumn("all_u", zero("live_u") + zero("fixed_u")).withColumn("all_v", zero("live_v") + zero("fixed_v"))
    belief = F.col("odds") * says_author * says_member
    return state.select("member_id", "author_id", "probability").unionByName(apart.select("member_id", "author_id", (belief / (1 + belief)).alias("probability")))


def matches(works: DataFrame, persons: DataFrame, crossref: DataFrame, elsevier: DataFrame) -> DataFrame:
    """(member_id, author_id, probability) of every candidate pair.

    works: orcid_member_works_parsed; persons: orcid_member_person; the others as their tables. Rows with a null member,
    author or article id link nothing. Repeated rows count once.
    """
    crossref = crossref.select(orcid_key(F.col("author_orcid")).alias("member_id"), "article_doi", F.concat_ws(" ", "author_given_name", "author_family_name").alias("name")).where("member_id is not null").distinct()
    # what several steps read is kept: identifiers and titles, not whole rows
    named = ["article_doi", "article_eid", "article_title"]
    own_works = checkpointed(works.where("member_id is not null").select("member_id", *named).distinct())
    columns = {"doi": doi_key(F.col("article_doi")), "eid": F.col("article_eid"), "title": title_key(F.col("article_title")), "short": short_title_key(F.col("article_title"))}
    keys = keyed(own_works, "member_id", columns)
    keys = keys.unionByName(keyed(crossref.join(own_works.select("member_id").distinct(), "member_id", "left_semi"), "member_id", {"doi": columns["doi"]})).distinct()
    slim = elsevier.where("article_id is not null and author_id is not null")
    titled = checkpointed(slim.select("article_id", *named).distinct())
    articles = checkpointed(keyed(titled, "article_id", columns))
    keys = checkpointed(keys)
    near = near_titles(titles_of(own_works), titles_of(titled))
    keys = checkpointed(keys.unionByName(keys.join(near, "key").select("member_id", F.col("near").alias("key"))).distinct())
    met = checkpointed(shared_works(keys, articles))
    totals = met.groupBy("member_id").agg(F.sum("weight").alias("total"))
    authors = slim.select("article_id", "author_id").distinct()
    pairs = met.join(authors, "article_id").groupBy("member_id", "author_id").agg(F.sum("weight").alias("works"))
    pairs = pairs.join(totals, "member_id").select("member_id", "author_id", "works", (F.col("works") / F.col("total")).alias("share"))
    shredded = shred(persons, "member_id", "member_person", "row_created_at", {"given": "name.given-names.value", "family": "name.family-name.value"})
    persons_named = shredded.select("member_id", F.concat_ws(" ", F.get("given_val", F.lit(0)), F.get("family_val", F.lit(0))).alias("name"))
    member_names = formed(persons_named.unionByName(crossref.select("member_id", "name")), "member_id").groupBy("member_id").agg(F.collect_set("form").alias("member_names"))
    full = F.concat_ws(" ", "author_first_name", "author_last_name")
    spelled = slim.select("author_id", F.explode(F.array("author_indexed_name", full)).alias("name"))
    author_names = formed(spelled, "author_id").groupBy("author_id").agg(F.collect_set("form").alias("author_names"))
    candidates = pairs.join(member_names, "member_id", "left").join(author_names, "author_id", "left")
    return propagate(with_prior(candidates))


def matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches(*(read_table(spark, sf_dir, t) for t in ("orcid_member_works_parsed", "orcid_member_person", "crossref_publication_parsed", "elsevier_publication_parsed")))


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matched(spark, sf_dir).where("probability >= 0.5").select("member_id", "author_id")


def queries() -> dict:
    return {"p5_found": found, "p5_matches": matched}


def oracle_sql() -> dict[str, str]:
    return {}
