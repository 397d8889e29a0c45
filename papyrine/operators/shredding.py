"""Columnar shredding of nested JSON into leaf columns with repetition and definition levels, and back into flat tables.

A path is written like ``author[].affiliation[].name``; ``[]`` marks a repeated step, and a path may start with ``[]``
when the document itself is the list. Every leaf column of a document is three sequences of equal length:

* the value (text; None where the leaf is absent),
* the repetition level: 0 starts a document, r > 0 says that the r-th repeated step got a further element,
* the definition level: how many optional steps of the path are there. A plain step counts 1 if its value is not null. A
  repeated step counts 1 for a place in a list, and 1 more if what stands there is not null.

So a null element keeps its place (it has the first, not the second), and an empty, null or absent list gives no place.
A bare value where a list is expected counts as a list of one. The tables of repeated ancestors are made from the level
sequences alone: positions come from counting repetition levels.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Path:
    """A leaf path, cut into (key or None, repeated?) steps."""

    text: str

    @property
    def steps(self) -> tuple[tuple[str | None, bool], ...]:
        found = []
        for part in self.text.split("."):
            repeated = part.endswith("[]")
            found.append(((part[:-2] if repeated else part) or None, repeated))
        return tuple(found)

    @property
    def ancestors(self) -> list[tuple[int, int]]:
        """For each repeated step: the definition level of a place in its list, and of a non-null element there."""
        level, found = 0, []
        for _, repeated in self.steps:
            if repeated:
                found.append((level + 1, level + 2))
            level += 1 + repeated
        return found


def read_json(text: str | None) -> tuple[bool, object]:
    """(readable?, value). Readable: complete JSON, or a JSON string whose content is complete JSON (then its content).

    NaN and Infinity are not JSON. Text nested deeper than the interpreter's recursion limit counts as unreadable.
    """
    value: object = text
    for _ in range(2):
        if not isinstance(value, str):
            break
        try:
            value = json.loads(value, parse_constant=_not_json)
        except (ValueError, RecursionError):
            return False, None
    return text is not None, value


def _not_json(name: str) -> None:
    raise ValueError(name)


def shred_value(node: object, steps: tuple[tuple[str | None, bool], ...]) -> tuple[list[str | None], bytearray, bytearray]:
    """Values, repetition levels and definition levels of one leaf path of one document."""
    values: list[str | None] = []
    rep, dfn = bytearray(), bytearray()

    def put(value: str | None, r: int, d: int) -> None:
        values.append(value)
        rep.append(r)
        dfn.append(d)

    def walk(node: object, at: int, r: int, d: int, depth: int) -> None:
        if at == len(steps):
            put(node if isinstance(node, str) else json.dumps(node, ensure_ascii=False) if not isinstance(node, dict | list) else None, r, d)
            return
        key, repeated = steps[at]
        child = node if key is None else node.get(key) if isinstance(node, dict) else None
        if not repeated:
            if child is None:
                put(None, r, d)
            else:
                walk(child, at + 1, r, d + 1, depth)
            return
        places = child if isinstance(child, list) else [] if child is None else [child]
        if not places:
            put(None, r, d)
        for place in places:
            if place is None:
                put(None, r, d + 1)
            else:
                walk(place, at + 1, r, d + 2, depth + 1)
            r = depth + 1

    walk(node, 0, 0, 0, 0)
    return values, rep, dfn


def shred(df: DataFrame, key: str, document: str, version: str, paths: dict[str, str], unwrap: str | None = None, values: bool = True) -> DataFrame:
    """The latest readable version of each key's JSON document, shredded.

    Columns: `key`, and for each name in `paths` (name -> leaf path) `<name>_rep` and `<name>_def` (one byte a level) and,
    if `values`, `<name>_val` (array of text). `unwrap` names a member that holds the real document in some versions; if
    it is absent or null, the document is taken as it is.

    Rows whose key is null have no parent to link to and give nothing; a null or unreadable document is no version. Of
    versions with equal `version`, the one with the larger text hash counts (equal texts are the same). A null `version`
    is the oldest. Documents are parsed before the shuffle, which carries only the asked leaves; the choice of the latest
    is an aggregate with a map-side part, so a key with very many versions is reduced before it is shuffled.
    """
    leaves = {name: Path(path).steps for name, path in paths.items()}

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, v, h, text in zip(batch["k"], batch["v"], batch["h"], batch["doc"], strict=True):
                good, node = read_json(text)
                if not good:
                    continue
                if unwrap is not None and isinstance(node, dict) and node.get(unwrap) is not None:
                    node = node[unwrap]
                row = [k, v, h]
                for steps in leaves.values():
                    val, rep, dfn = shred_value(node, steps)
                    row += [bytes(rep), bytes(dfn), val] if values else [bytes(rep), bytes(dfn)]
                rows.append(row)
            yield pd.DataFrame(rows, columns=names)

    kinds = [("rep", "binary"), ("def", "binary"), ("val", "array<string>")][: 3 if values else 2]
    fields = [(f"{name}_{suffix}", kind) for name in paths for suffix, kind in kinds]
    names = ["k", "v", "h", *(f for f, _ in fields)]
    schema = ", ".join(["k string", "v long", "h long", *(f"`{f}` {kind}" for f, kind in fields)])
    text = F.col(document)
    slim = df.where(F.col(key).isNotNull() & text.isNotNull()).select(F.col(key).cast("string").alias("k"), _as_micros(df, version).alias("v"), F.xxhash64(text).alias("h"), text.alias("doc"))
    latest = slim.mapInPandas(parse, schema).groupBy("k").agg(F.max_by(F.struct(*(F.col(f) for f, _ in fields)), F.struct("v", "h")).alias("r"))
    return latest.select(F.col("k").alias(key), "r.*")


def _as_micros(df: DataFrame, version: str) -> Column:
    kind = dict(df.dtypes)[version]
    if kind == "timestamp_ntz":
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{version}`)")
    return F.unix_micros(version) if kind == "timestamp" else F.col(version).cast("long")


def ordinals(rep: np.ndarray, dfn: np.ndarray, ancestors: list[tuple[int, int]], depth: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Which entries start a non-null element of the depth-th repeated step (from 1), and the 1-based positions of each
    entry in the lists of the steps 1..depth. rep and dfn are the level sequences of any number of documents in a row."""
    at = np.arange(len(rep))
    positions = []
    for r, (place, _) in enumerate(ancestors[:depth], 1):
        starts = (rep <= r) & (dfn >= place)
        count = np.cumsum(starts)
        reset = np.maximum.accumulate(np.where(rep < r, at, 0))
        positions.append(count - count[reset] + starts[reset])
    return (rep <= depth) & (dfn >= ancestors[depth - 1][1]), positions


def relation(shredded: DataFrame, key: str, name: str, path: str, depth: int, values: dict[str, str] | None = None) -> DataFrame:
    """The flat table of the depth-th repeated ancestor of the leaf column `name`: parent_key, child_no, grandchild_no.

    `values` (column -> name of a shredded leaf below the same ancestor, with no further repeated step) adds the values of
    leaves: all leaves of one ancestor start their elements in the same order, so the i-th start of each is the same one.
    """
    values = values or {}
    ancestors = Path(path).ancestors
    used = {name, *values.values()}

    def rebuild(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            rep, dfn = (np.frombuffer(b"".join(batch[f"{name}_{s}"]), np.uint8) for s in ("rep", "def"))
            owner = np.repeat(np.arange(len(batch)), batch[f"{name}_rep"].map(len))
            start, positions = ordinals(rep, dfn, ancestors, depth)
            out = {"parent_key": batch["k"].to_numpy()[owner[start]], "child_no": positions[0][start].astype("int32")}
            out["grandchild_no"] = positions[1][start].astype("int32") if depth > 1 else np.zeros(int(start.sum()), "int32")
            for column, leaf in values.items():
                r, d = (np.frombuffer(b"".join(batch[f"{leaf}_{s}"]), np.uint8) for s in ("rep", "def"))
                first = (r <= depth) & (d >= ancestors[depth - 1][1])
                texts = np.empty(len(r), object)
                texts[:] = [x for one in batch[f"{leaf}_val"] for x in one]
                out[column] = texts[first]
            yield pd.DataFrame(out)

    wanted = [c for leaf in sorted(used) for c in (f"{leaf}_rep", f"{leaf}_def", *([f"{leaf}_val"] if leaf in values.values() else []))]
    schema = ", ".join(["parent_key string", "child_no int", "grandchild_no int", *(f"`{c}` string" for c in values)])
    return shredded.select(F.col(key).alias("k"), *wanted).mapInPandas(rebuild, schema)


def relations(shredded: DataFrame, key: str, specs: dict[str, tuple[str, str, int]]) -> DataFrame:
    """The positions of several relations in one pass over the level columns: relation_name, parent_key, child_no,
    grandchild_no. specs: relation -> (name of the leaf column, its path, depth)."""
    ancestors = {name: Path(path).ancestors for name, (_, path, _) in specs.items()}
    leaves = sorted({leaf for leaf, _, _ in specs.values()})

    def rebuild(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            keys = batch["k"].to_numpy()
            for name, (leaf, _, depth) in specs.items():
                rep, dfn = (np.frombuffer(b"".join(batch[f"{leaf}_{s}"]), np.uint8) for s in ("rep", "def"))
                owner = np.repeat(np.arange(len(batch)), batch[f"{leaf}_rep"].map(len))
                start, positions = ordinals(rep, dfn, ancestors[name], depth)
                second = positions[1][start] if depth > 1 else 0
                yield pd.DataFrame({"relation_name": name, "parent_key": keys[owner[start]], "child_no": positions[0][start], "grandchild_no": second})

    columns = [f"{leaf}_{s}" for leaf in leaves for s in ("rep", "def")]
    return shredded.select(F.col(key).alias("k"), *columns).mapInPandas(rebuild, "relation_name string, parent_key string, child_no int, grandchild_no int")
