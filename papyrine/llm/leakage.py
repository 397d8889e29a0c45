"""Evaluation texts inside a training corpus (problem 8): an FM-index per shard of documents, searched for the phrases of
the test items.

Documents are read as words (see `words`). A shard is the sequence of its documents' words, coded by the items' own
vocabulary, with a separator after each document. Its suffixes are sorted by prefix doubling, the Burrows-Wheeler
transform is held in a wavelet matrix, and every phrase of SEED words of every item is searched backwards through the
matrix's ranks. Occurrences are located by walking back to sampled suffix positions. An occurrence is then checked
exactly: the passage around it is extended in both directions with words changed, left out or added.

Why SEED words are enough: a passage of n >= 18 item words with at most n // 10 errors has an unbroken run of at least
ceil((n - e) / (e + 1)) words, e = n // 10, which is never under 6.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyrine.llm.features import COMBINING
from papyrine.session import read_table

SEED, LEAST_WORDS, WORDS_PER_ERROR = 6, 18, 10
#: Words of one FM-index; a task with more makes several, one after the other.
SHARD_WORDS = 1_000_000
#: Every so many words a suffix position is kept.
SAMPLE = 16
#: Items are searched in blocks of so many, so that the phrases sent to the tasks stay within a bound.
ITEM_BLOCK = 5_000
SEPARATOR, OTHER = 0, 1

_TAG = re.compile(r"</?[A-Za-z][^<>]*>")
_BREAK = re.compile(r"[-‐‑]\s*\n\s*")
_WORD = re.compile(r"[^\W_]+")
_JOIN = re.compile(r"(?<=[^\W_])[-‐‑'’.,:/](?=[^\W_])")
#: Characters that take no place, and letters of other scripts that look like Latin ones.
_NOTHING = dict.fromkeys([0xAD, 0x34F, 0x200B, 0x200C, 0x200D, 0x200E, 0x200F, 0x2060, 0xFEFF])
_LOOKALIKE = str.maketrans("аеорсухіјѕԁһɡıοανρικτвкмнт", "aeopcyxijsdhgioavpiktbkmht")
_LETTERS = {**COMBINING, **_LOOKALIKE, **_NOTHING}


def words(text: str | None) -> list[str]:
    """The words of a text whatever its case, punctuation, spacing, markup or character forms.

    Tags are dropped, entities read, words broken at a line end joined, compatibility forms, accents, invisible characters
    and look-alike letters undone. Marks between two letters or digits are dropped, so "1,395" and "co-author" are one word.
    """
    if not text:
        return []
    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = _TAG.sub(" ", text)
    if "\n" in text:
        text = _BREAK.sub("", text)
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text).casefold().translate(_LETTERS)
    return _WORD.findall(_JOIN.sub("", text.lower()))


def opening(text: str) -> tuple[str, str]:
    """The first sentence of an item, and what follows it (nothing if there is only one)."""
    parts = re.split(r"(?<=[.?!:])\s+", text.strip(), maxsplit=1)
    return parts[0], parts[1] if len(parts) > 1 else ""


def item_words(items: DataFrame) -> DataFrame:
    """(item_id, words): the words of each item (item_id, text), without an opening sentence that several items share (an
    instruction line)."""

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = [opening(t) for t in batch["text"]]
            yield pd.DataFrame({"item_id": batch["item_id"], "opening": [" ".join(words(a)) for a, _ in parts], "whole": [words(t) for t in batch["text"]], "rest": [words(b) for _, b in parts]})

    parts = items.mapInPandas(split, "item_id long, opening string, whole array<string>, rest array<string>")
    shared = parts.groupBy("opening").agg((F.count("*") > 1).alias("shared"))
    return parts.join(shared, "opening").select("item_id", F.when(F.col("shared") & (F.size("rest") > 0), F.col("rest")).otherwise(F.col("whole")).alias("words"))


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The suffixes of a sequence of codes in order. Separators differ from each other (the earlier is less), so no two
    suffixes are compared beyond a document's end. Only suffixes that are not yet told apart are sorted again."""
    n = len(text)
    first = text.astype(np.int64) + n
    ends = np.flatnonzero(text == SEPARATOR)
    first[ends] = np.arange(len(ends))
    order = np.argsort(first, kind="stable")
    rank = np.empty(n, np.int64)
    changed = np.flatnonzero(np.diff(first[order], prepend=-1))
    rank[order] = np.repeat(changed, np.diff(changed, append=n))
    open_slots = np.flatnonzero(np.repeat(np.diff(changed, append=n) > 1, np.diff(changed, append=n)))
    step = 1
    while len(open_slots):
        at = order[open_slots]
        keys = rank[at] * (n + 1) + rank[np.minimum(at + step, n - 1)] + 1
        by = np.argsort(keys, kind="stable")
        at, keys = at[by], keys[by]
        order[open_slots] = at
        new = np.flatnonzero(np.diff(keys, prepend=-1))
        size = np.diff(new, append=len(keys))
        rank[at] = np.repeat(open_slots[new], size)
        open_slots = open_slots[np.repeat(size > 1, size)]
        step *= 2
    return order


class FMIndex:
    """Backward search and location over a sequence of codes 0..sigma-1."""

    def __init__(self, text: np.ndarray, sigma: int) -> None:
        order = suffix_array(text)
        n = self.n = len(text)
        bwt = text[order - 1]
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma))])
        # a wavelet matrix: at each level zeros go left and ones right, stably; `zeros` counts the zeros before a place
        self.bits = max(1, int(sigma - 1).bit_length())
        self.zeros, self.levels, column = [], [], bwt.astype(np.int32)
        for level in reversed(range(self.bits)):
            bit = (column >> level) & 1
            self.levels.append(bit.astype(bool))
            self.zeros.append(np.concatenate([[0], np.cumsum(bit == 0)]).astype(np.int32))
            column = np.concatenate([column[bit == 0], column[bit == 1]])
        sampled = (order % SAMPLE == 0) | (text[order - 1] == SEPARATOR)
        self.sampled, self.kept = sampled, order[sampled]
        self.kept_before = np.cumsum(sampled) - sampled

    def rank(self, code: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often code stands in the transform before `at` (element by element)."""
        start = np.zeros_like(at)
        for i, level in enumerate(reversed(range(self.bits))):
            zeros = self.zeros[i]
            one = ((code >> level) & 1).astype(bool)
            total = zeros[-1]
            start, at = np.where(one, total + start - zeros[start], zeros[start]), np.where(one, total + at - zeros[at], zeros[at])
        return at - start

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row of codes, the range of suffixes that begin with it."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        for column in reversed(range(phrases.shape[1])):
            code = phrases[:, column]
            low, high = (self.before[code] + self.rank(code, x) for x in (low, high))
            high = np.maximum(low, high)
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The text positions of suffixes, by steps back to sampled ones."""
        out, walked, left = np.zeros(len(rows), np.int64), 0, np.arange(len(rows))
        rows = rows.copy()
        while len(left):
            done = self.sampled[rows]
            out[left[done]] = self.kept[self.kept_before[rows[done]]] + walked
            left, rows = left[~done], rows[~done]
            code, at = np.zeros(len(rows), np.int64), rows
            for i in range(self.bits):
                bit = self.levels[i][at]
                code = code * 2 + bit
                at = np.where(bit, self.zeros[i][-1] + at - self.zeros[i][at], self.zeros[i][at])
            rows = self.before[code] + self.rank(code, rows)
            walked += 1
        return out


def reach(item: list[int], text: list[int], i: int, j: int, step: int, most: int) -> list[tuple[int, int]]:
    """For 0..most errors, the largest number of item words that can be covered from item[i], text[j] on in the direction
    of step, and the number of text words that takes. An error changes, leaves out or adds a word."""

    def run(a: int, b: int) -> tuple[int, int]:
        while 0 <= i + step * a < len(item) and 0 <= j + step * b < len(text) and item[i + step * a] == text[j + step * b] > OTHER:
            a, b = a + 1, b + 1
        return a, b

    room = (len(item) - i) if step > 0 else i + 1
    edge = {0: run(0, 0)}  # words of the text less words of the item -> furthest
    out = [edge[0]]
    for _ in range(most):
        new: dict[int, tuple[int, int]] = {}
        for shift, (a, b) in edge.items():
            for s, da, db in ((shift, 1, 1), (shift - 1, 1, 0), (shift + 1, 0, 1)):
                if a + da <= room:
                    got = run(a + da, b + db)
                    if s not in new or got > new[s]:
                        new[s] = got
        edge = new or edge
        out.append(max(out[-1], *edge.values()))
    return out


def passage(item: list[int], text: list[int], i: int, j: int) -> tuple[int, int, int] | None:
    """The longest passage through the seed item[i], text[j] that keeps to the limits, as (item words, first and last text
    word), or None."""
    most = len(item) // WORDS_PER_ERROR
    right = reach(item, text, i + SEED, j + SEED, 1, most)
    left = reach(item, text, i - 1, j - 1, -1, most)
    best = None
    for a, (n, x) in enumerate(right):
        for b, (m, y) in enumerate(left):
            total = n + m + SEED
            if total >= max(LEAST_WORDS, WORDS_PER_ERROR * (a + b)) and (best is None or total > best[0]):
                best = (total, j - y, j + SEED + x - 1)
    return best


def codes(vocabulary: set[str]) -> dict[str, int]:
    return {word: k + 2 for k, word in enumerate(sorted(vocabulary))}


class Phrases:
    """The items' words as codes (of the words of these items, or of all), and all their phrases of SEED words."""

    def __init__(self, items: dict[int, list[str]], code: dict[str, int] | None = None) -> None:
        self.code = code or codes({w for own in items.values() for w in own})
        self.sigma = len(self.code) + 2
        self.items = {key: [self.code[w] for w in own] for key, own in items.items() if len(own) >= LEAST_WORDS - 1}
        rows = sorted((tuple(own[i : i + SEED]), key, i) for key, own in self.items.items() for i in range(len(own) - SEED + 1))
        self.phrases = np.array([r[0] for r in rows], np.int64).reshape(-1, SEED)
        self.unique, inverse = np.unique(self.phrases, axis=0, return_inverse=True)
        self.keys, self.starts = np.array([r[1] for r in rows], np.int64), np.array([r[2] for r in rows], np.int64)
        self.by_phrase = np.argsort(inverse.ravel(), kind="stable")
        self.counts = np.bincount(inverse.ravel(), minlength=len(self.unique))
        self.offsets = np.cumsum(self.counts) - self.counts
        self.longest = max(map(len, self.items.values()), default=0)
        self.table = np.full((len(self.items), self.longest), -1, np.int32)
        self.row = {key: k for k, key in enumerate(self.items)}
        for key, own in self.items.items():
            self.table[self.row[key], : len(own)] = own


def joined(docs: list[list[int]]) -> np.ndarray:
    return np.array([c for own in docs for c in (*own, SEPARATOR)], np.int32)


def search_shard(phrases: Phrases, docs: list[list[int]], index: FMIndex | None = None) -> list[tuple[int, int, int, int, int]]:
    """(document number, item, item words, first and last word of the passage) of one shard: every longest passage through a
    seed that lies in no other one of the same document and item, the longest ones last. index: of the joined docs, if it is
    there already."""
    text = joined(docs)
    if not len(phrases.unique) or len(text) <= SEED:
        return []
    index = index or FMIndex(text, phrases.sigma)
    low, high = index.search(phrases.unique)
    hits = high - low
    which = np.repeat(np.arange(len(hits)), hits)
    rows = np.arange(len(which)) - np.repeat(np.cumsum(hits) - hits, hits) + np.repeat(low, hits)
    at = index.locate(rows)
    each = phrases.counts[which]
    entry = phrases.by_phrase[np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each) + np.repeat(phrases.offsets[which], each)]
    at, key, start = np.repeat(at, each), phrases.keys[entry], phrases.starts[entry]
    # one seed for each item, diagonal and unbroken run, then only those with enough words of the item nearby, in any shift that
    # the errors of a passage can make: with floor(n / 10) errors, some 18 words in sequence of n have at most 3
    order = np.lexsort((start, at - start, key))
    at, key, start = at[order], key[order], start[order]
    goes_on = (key[1:] == key[:-1]) & (at[1:] == at[:-1] + 1) & (start[1:] == start[:-1] + 1)
    pick = np.flatnonzero(np.concatenate([np.ones(min(1, len(at)), bool), ~goes_on]))
    at, key, start = at[pick], key[pick], start[pick]
    row = np.array([phrases.row[k] for k in key.tolist()], np.int64)
    keep = []
    most = phrases.longest // WORDS_PER_ERROR
    margin = np.full(most + 1, SEPARATOR, np.int32)
    padded = np.concatenate([margin, text, margin])
    for part in np.array_split(np.arange(len(at)), max(1, len(at) // 20_000)):
        if not len(part):
            continue
        place = (at - start)[part, None] + np.arange(phrases.longest)
        own = phrases.table[row[part]]
        near = np.zeros(place.shape, bool)
        for shift in range(-most, most + 1):
            near |= padded[np.clip(place + shift + most + 1, 0, len(padded) - 1)] == own
        total = np.concatenate([np.zeros((len(part), 1), np.int32), np.cumsum(near, axis=1, dtype=np.int32)], axis=1)
        if phrases.longest < LEAST_WORDS:
            enough = total[:, -1] >= LEAST_WORDS - 3
        else:
            enough = (total[:, LEAST_WORDS:] - total[:, :-LEAST_WORDS]).max(axis=1) >= LEAST_WORDS - 3
        keep.append(part[enough])
    ends = np.flatnonzero(text == SEPARATOR)
    found: dict[tuple[int, int], set[tuple[int, int, int]]] = {}
    for h in np.concatenate(keep).tolist() if keep else []:
        doc = int(np.searchsorted(ends, at[h]))
        begin = int(ends[doc - 1]) + 1 if doc else 0
        item = int(key[h])
        if got := passage(phrases.items[item], docs[doc], int(start[h]), int(at[h]) - begin):
            found.setdefault((doc, item), set()).add(got)
    return [(doc, item, *got) for (doc, item), own in found.items() for got in outermost(own)]


def outermost(passages: set[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The passages (item words, first word, last word) that lie in no other one, in order of their item words. Of those of
    the same place the one of the most item words stays."""
    kept, reached = [], -1
    for got in sorted(passages, key=lambda x: (x[1], -x[2], -x[0])):
        if got[2] > reached:
            kept.append(got)
            reached = got[2]
    return sorted(kept)


def leaks(docs: DataFrame, key: str, text: str, items: DataFrame, item_key: str, item_text: str) -> DataFrame:
    """(key, item_id, item_words, first_word, last_word): every passage of an item in a document, as the places of its first
    and last word there; of passages within each other the outer one.

    A passage is at least LEAST_WORDS words in sequence of the item with at most one in WORDS_PER_ERROR changed, left out or
    added. Null or empty texts hold none; repeated document keys give repeated rows. Items with a null key or without
    enough words can't be leaked; repeated item keys count once (the greatest text).

    Each task indexes its own documents once, in shards of SHARD_WORDS words, and searches every block of ITEM_BLOCK items
    in each; nothing is shuffled. Items are held-out tests: the driver reads them block by block, and keeps their vocabulary.
    """
    context = docs.sparkSession.sparkContext
    clean = items.where(F.col(item_key).isNotNull() & F.col(item_text).isNotNull()).groupBy(F.col(item_key).cast("long").alias("item_id")).agg(F.max(item_text).alias("text"))
    own: dict[int, list[str]] = {}
    vocabulary: set[str] = set()
    blocks = []
    for row in item_words(clean).toLocalIterator():
        own[row["item_id"]] = list(row["words"])
        vocabulary.update(row["words"])
        if len(own) == ITEM_BLOCK:
            blocks.append(context.broadcast(own))
            own = {}
    blocks.append(context.broadcast(own))
    known = context.broadcast(codes(vocabulary))
    kind = dict(docs.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code = known.value
        only = Phrases(blocks[0].value, code) if len(blocks) == 1 else None
        held: list[list[int]] = []
        keys: list = []
        size = 0

        def search() -> Iterator[pd.DataFrame]:
            text = joined(held)
            index = FMIndex(text, len(code) + 2) if code and len(text) > SEED else None
            for block in blocks if index else []:
                rows = search_shard(only or Phrases(block.value, code), held, index)
                yield pd.DataFrame([(keys[d], *rest) for d, *rest in rows], columns=["k", "item_id", "item_words", "first_word", "last_word"])

        for batch in batches:
            for k, t in zip(batch["k"], batch["t"], strict=True):
                coded = [code.get(w, OTHER) for w in words(t)]
                held.append(coded)
                keys.append(k)
                size += len(coded) + 1
                if size >= SHARD_WORDS:
                    yield from search()
                    held.clear()
                    keys.clear()
                    size = 0
        if held:
            yield from search()

    source = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    return source.mapInPandas(run, f"k {kind}, item_id long, item_words int, first_word int, last_word int").withColumnRenamed("k", key)


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(read_table(spark, sf_dir, "documents"), "doc_id", "text", read_table(spark, sf_dir, "eval_item"), "item_id", "item_text")


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans(spark, sf_dir).select("doc_id", "item_id").distinct()


def removal_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each leaking document the word ranges to remove: overlapping and touching passages are merged."""
    ordered = F.array_sort(F.collect_list(F.struct("first_word", "last_word")))
    kind = "array<struct<first_word:int,last_word:int>>"
    merged = F.aggregate(
        ordered,
        F.array().cast(kind),
        lambda done, x: F.when(
            (F.size(done) > 0) & (x["first_word"] <= F.element_at(done, -1)["last_word"] + 1),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(F.element_at(done, -1)["first_word"].alias("first_word"), F.greatest(F.element_at(done, -1)["last_word"], x["last_word"]).alias("last_word")))),
        ).otherwise(F.concat(done, F.array(x))),
    )
    return spans(spark, sf_dir).groupBy("doc_id").agg(merged.alias("s")).select("doc_id", F.inline("s"))


def queries() -> dict:
    return {"p8_found": found, "p8_removal_spans": removal_spans}


def oracle_sql() -> dict[str, str]:
    return {}
