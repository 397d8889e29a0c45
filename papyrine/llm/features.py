"""Hashed sparse features and the learners shared by the text classifiers of this subpackage (numpy only)."""

from __future__ import annotations

import html
import re
import unicodedata
import zlib

import numpy as np

_TAG = re.compile(r"</?[A-Za-z][^<>]*>")
#: Accents and other marks that combine with the letter before them, for str.translate.
COMBINING = dict.fromkeys(c for c in range(0x300, 0x110000) if unicodedata.combining(chr(c)))
_SENTENCE_END = re.compile(r"(?<=[.!?。？！])[\"'”’)\]]?\s+|\n+")


def plain(text: str | None) -> str:
    """Text with its entities read (also doubly encoded ones) and its tags turned into line breaks."""
    if not text:
        return ""
    for _ in range(2):
        if "&" in text:
            text = html.unescape(text)
    return _TAG.sub("\n", text) if "<" in text else text


def sentences(text: str) -> list[str]:
    """The non-blank sentences of a plain text; a line break also ends one."""
    return [s for s in (part.strip() for part in _SENTENCE_END.split(text)) if s]


class Sparse:
    """Rows of hashed features: flat feature numbers and weights, row by row, and where each row begins."""

    def __init__(self, feature: np.ndarray, weight: np.ndarray, sizes: np.ndarray) -> None:
        self.feature, self.weight, self.sizes = feature, weight, sizes
        self.starts = np.cumsum(sizes) - sizes

    def __len__(self) -> int:
        return len(self.sizes)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.sizes)), self.sizes)

    def take(self, rows: np.ndarray) -> Sparse:
        sizes = self.sizes[rows]
        at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(self.starts[rows], sizes)
        return Sparse(self.feature[at], self.weight[at], sizes)

    def scaled(self, idf: np.ndarray, total: float = 1) -> Sparse:
        """Weighted by idf, then each row to the same sum, so that short and long texts are alike."""
        weight = self.weight * idf[self.feature]
        own = np.bincount(self.owner(), weight, len(self.sizes))
        return Sparse(self.feature, (weight * total / np.maximum(np.repeat(own, self.sizes), 1e-12)).astype(np.float32), self.sizes)

    def times(self, coefficients: np.ndarray) -> np.ndarray:
        """Rows x columns of coefficients; rows without features are zero."""
        out = np.zeros((len(self.sizes), coefficients.shape[1]), np.float64)
        full = np.flatnonzero(self.sizes > 0)
        if len(full):
            step = 200_000
            cuts = np.searchsorted(np.cumsum(self.sizes[full]), np.arange(step, self.sizes.sum() + step, step)) + 1
            at = 0
            for cut in [*cuts.tolist(), len(full)]:
                rows = full[at : min(cut, len(full))]
                if len(rows):
                    a, b = self.starts[rows[0]], self.starts[rows[-1]] + self.sizes[rows[-1]]
                    out[rows] = np.add.reduceat(coefficients[self.feature[a:b]] * self.weight[a:b, None], self.starts[rows] - a, axis=0)
                at = max(at, cut)
        return out


def char_ngrams(texts: list[str], lengths: tuple[int, ...], bits: int) -> Sparse:
    """Counts (one entry an occurrence) of hashed character n-grams of each text, with a blank added at both ends."""
    padded = [f" {t} " for t in texts]
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    size = np.array([len(t) for t in padded], np.int64)
    owner = np.repeat(np.arange(len(texts)), size)
    found, rows = [], []
    for n in lengths:
        if len(codes) < n:
            continue
        last = len(codes) - n + 1
        mixed = np.full(last, np.uint64(n))
        for k in range(n):
            mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + codes[k : k + last]
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        inside = owner[:last] == owner[n - 1 :]
        found.append((mixed >> np.uint64(64 - bits))[inside].astype(np.int32))
        rows.append(owner[:last][inside])
    if not found:
        return Sparse(np.zeros(0, np.int32), np.zeros(0, np.float32), np.zeros(len(texts), np.int64))
    row, feature = np.concatenate(rows), np.concatenate(found)
    order = np.argsort(row, kind="stable")
    return Sparse(feature[order], np.ones(len(row), np.float32), np.bincount(row, minlength=len(texts)))


def word_ngrams(texts: list[list[str]], longest: int, bits: int, cache: dict[str, int] | None = None) -> Sparse:
    """Counts of hashed word n-grams (1..longest words) of each list of words."""
    cache = {} if cache is None else cache
    for own in texts:
        for w in own:
            if w not in cache:
                if len(cache) > 500_000:
                    cache.clear()
                cache[w] = zlib.crc32(w.encode("utf-8", "replace")) * 2 + 1
    codes = np.array([cache.get(w) or zlib.crc32(w.encode("utf-8", "replace")) * 2 + 1 for own in texts for w in own], np.uint64)
    size = np.array([len(own) for own in texts], np.int64)
    owner = np.repeat(np.arange(len(texts)), size)
    found, rows = [], []
    for n in range(1, longest + 1):
        if len(codes) < n:
            break
        last = len(codes) - n + 1
        mixed = np.full(last, np.uint64(n))
        for k in range(n):
            mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + codes[k : k + last]
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        inside = owner[:last] == owner[n - 1 :]
        found.append((mixed >> np.uint64(64 - bits))[inside].astype(np.int32))
        rows.append(owner[:last][inside])
    if not found:
        return Sparse(np.zeros(0, np.int32), np.zeros(0, np.float32), size)
    row, feature = np.concatenate(rows), np.concatenate(found)
    order = np.argsort(row, kind="stable")
    return Sparse(feature[order], np.ones(len(row), np.float32), np.bincount(row, minlength=len(texts)))


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class Ftrl:
    """Follow-the-regularised-leader (proximal, per-coordinate rates) with L1 and L2 penalties, over hashed features."""

    def __init__(self, features: int, outputs: int, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.001, l2: float = 0.001) -> None:
        self.z, self.n = np.zeros((features, outputs)), np.zeros((features, outputs))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.coefficients = np.zeros((features, outputs))

    def step(self, rows: Sparse, error: np.ndarray) -> None:
        """One step against the gradient of the rows' scores (error: rows x outputs)."""
        if len(rows.feature) * 4 > len(self.z):
            used, place = np.arange(len(self.z)), rows.feature
        else:
            used, place = np.unique(rows.feature, return_inverse=True)
        owner = rows.owner()
        gradient = np.stack([np.bincount(place, rows.weight * error[owner, c], len(used)) for c in range(error.shape[1])], axis=1)
        n = self.n[used]
        more = n + gradient**2
        z = self.z[used] + gradient - (np.sqrt(more) - np.sqrt(n)) / self.alpha * self.coefficients[used]
        self.n[used], self.z[used] = more, z
        self.coefficients[used] = np.where(np.abs(z) <= self.l1, 0, -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(more)) / self.alpha + self.l2))
