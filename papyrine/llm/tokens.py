"""Encoding of a corpus with a public byte-level BPE vocabulary (problem 7).

Text is split by the vocabulary's own pattern; each piece is merged over a segment tree whose leaves are the byte
positions of the piece and hold rank * length + position of the pair that begins there, so that the root names the
leftmost pair of least rank. A merge updates the leaves of its live neighbours only, in logarithmic time: a piece of n
bytes takes O(n log n), however long. Pieces recur, so each task keeps the ids of the short ones in a bounded cache.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyrine.session import read_table

#: Ranks of the vocabulary: one "base64(token) rank" a line.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the public pattern that splits text before the merges of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A task's cache is cleared when it holds so many pieces; longer pieces are not kept.
CACHE_PIECES, CACHE_BYTES = 200_000, 64
NONE = 1 << 60


def read_ranks(lines: bytes) -> dict[bytes, int]:
    """The vocabulary as token -> rank; the rank is the id."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines.splitlines()) if token}


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one piece."""
    n = len(piece)
    if n < 2:
        return [ranks[piece]] if n else []
    base = 1 << (n - 2).bit_length() if n > 2 else 1
    tree = [NONE] * (2 * base)
    for i in range(n - 1):
        if (rank := ranks.get(piece[i : i + 2])) is not None:
            tree[base + i] = rank * n + i
    for i in range(base - 1, 0, -1):
        left, right = tree[2 * i], tree[2 * i + 1]
        tree[i] = left if left < right else right
    after, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))

    def put(i: int, value: int) -> None:
        i += base
        tree[i] = value
        while i > 1:
            i >>= 1
            left, right = tree[2 * i], tree[2 * i + 1]
            least = left if left < right else right
            if tree[i] == least:
                break
            tree[i] = least

    while (least := tree[1]) < NONE:
        i = least % n
        j = after[i]
        k = after[j]
        end[i], after[i] = end[j], k
        if j < n - 1:
            put(j, NONE)
        if k < n:
            before[k] = i
            rank = ranks.get(piece[i : end[k]])
            put(i, NONE if rank is None else rank * n + i)
        else:
            put(i, NONE)
        if (h := before[i]) >= 0:
            rank = ranks.get(piece[h : end[i]])
            put(h, NONE if rank is None else rank * n + h)
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : end[i]]])
        i = after[i]
    return ids


class Encoder:
    """Text to ids; an empty text and None give no ids. Lone surrogates are encoded as U+FFFD."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        import regex

        self.ranks, self.cache, self.split = ranks, {}, regex.compile(PATTERN).findall

    def encode(self, text: str | None) -> list[int]:
        ids: list[int] = []
        cache = self.cache
        for piece in self.split(text) if text else ():
            own = cache.get(piece)
            if own is None:
                raw = piece.encode("utf-8", "surrogatepass") if piece.isascii() else piece.encode("utf-16", "surrogatepass").decode("utf-16", "replace").encode()
                own = merge_piece(raw, self.ranks)
                if len(raw) <= CACHE_BYTES:
                    if len(cache) >= CACHE_PIECES:
                        cache.clear()
                    cache[piece] = own
            ids += own
        return ids


def encode(df: DataFrame, key: str, text: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, ids): the ids of every row's whole text, without special tokens; empty and null texts give an empty list.

    No shuffle: rows are encoded where they are read. The vocabulary (50,256 tokens, under 1 MB) is the only thing sent
    to the tasks. Repeated keys and texts give repeated rows; other columns are left out.
    """
    with open(vocabulary, "rb") as file:
        lines = df.sparkSession.sparkContext.broadcast(file.read())
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(read_ranks(lines.value))
        for batch in batches:
            yield pd.DataFrame({"k": batch["k"], "ids": [encoder.encode(t) for t in batch["t"]]})

    out = df.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInPandas(run, f"k {kind}, ids array<int>")
    return out.select(F.col("k").alias(key), "ids")


def ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(read_table(spark, sf_dir, "documents"), "doc_id", "text")


def queries() -> dict:
    return {"p7_ids": ids}


def oracle_sql() -> dict[str, str]:
    return {}
