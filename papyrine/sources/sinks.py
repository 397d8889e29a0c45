"""Write semantics: append, replace by condition, upsert, full refresh, audit columns, completion markers. Tables are folders
of Parquet files."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fingerprint(**params: object) -> str:
    """K3: the parameters of a run as text: "name:value" pairs in order of names, joined by commas."""
    return ",".join(f"{k}:{params[k]}" for k in sorted(params))


def audited(df: DataFrame, spec: str) -> DataFrame:
    """K8: with the time of the write and the run's parameters."""
    return df.withColumn("row_created_at", F.current_timestamp()).withColumn("task_params_spec", F.lit(spec))


def append(df: DataFrame, path: str) -> None:
    """K1."""
    df.write.mode("append").parquet(path)


def refresh(df: DataFrame, path: str) -> None:
    """K5: replaces the whole table."""
    df.write.mode("overwrite").parquet(path)


def without(target: DataFrame, condition: Column) -> DataFrame:
    """The rows of the target that a delete by the condition leaves: those for which it is false or null."""
    return target.where(~F.coalesce(condition, F.lit(False)))


def delete_insert(target: DataFrame, source: DataFrame, condition: Column) -> DataFrame:
    """K3, K4: the state of the target after its rows that meet the condition gave way to the source."""
    return without(target, condition).unionByName(source)


def replace_partitions(df: DataFrame, path: str, *columns: str) -> None:
    """K3, K4 on disk: replaces just those partitions of the table that df has rows of; running it again changes nothing."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path)


def upsert(target: DataFrame, source: DataFrame, keys: list[str], keep: tuple[str, ...] = ("row_created_at",)) -> DataFrame:
    """K2: the state of the target after a merge: rows with the source's keys take its values but for `keep`, other rows of
    the source are inserted. Null keys match nothing. Several source rows of a key give several rows."""
    rest = target.join(source.select(keys).distinct(), keys, "left_anti")
    kept = [c for c in keep if c in target.columns and c in source.columns]
    if not kept:
        return rest.unionByName(source.select(*target.columns))
    old = target.groupBy(*keys).agg(*(F.min(c).alias(f"_{c}") for c in kept))
    fresh = source.join(old, keys, "left").select(*(F.coalesce(f"_{c}", c).alias(c) if c in kept else F.col(c) for c in target.columns))
    return rest.unionByName(fresh)


def _file(spark, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def mark_done(spark, path: str, **facts: object) -> None:
    """K9: a small JSON file whose existence says that a step is done; written to any file system Spark knows."""
    system, target = _file(spark, path)
    out = system.create(target, True)
    out.write(bytearray(json.dumps(facts, sort_keys=True).encode()))
    out.close()


def is_done(spark, path: str) -> bool:
    system, target = _file(spark, path)
    return system.exists(target)


def append_in_parts(keys: DataFrame, key: str, step: Callable[[DataFrame], DataFrame], path: str, size: int) -> int:
    """K7: step(keys) is appended to the table `path` for `size` keys at a time, so that an interrupted run keeps what it has:
    keys that the table holds are not taken again. step gives at least one row for each key, with the key. Returns the number
    of parts written. Only a part's keys are in flight; the driver sees counts."""
    spark = keys.sparkSession
    distinct = keys.where(F.col(key).isNotNull()).select(key).distinct()
    parts = 0
    while True:
        rest = unprocessed(distinct, spark.read.parquet(path), key) if is_done(spark, path) else distinct
        part = rest.orderBy(key).limit(size)
        if part.isEmpty():
            return parts
        append(step(part), path)
        parts += 1


def unprocessed(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """The rows whose key isn't done yet."""
    return rows.join(done.select(key).distinct(), key, "left_anti")


def not_in(rows: DataFrame, column: str, others: DataFrame, other: str) -> DataFrame:
    """SQL's NOT IN: no row if `others` holds a null, all rows if it is empty, else those whose value is not null and not
    among them. An equality anti join and a look at the null instead of a broadcast of all values."""
    values = others.select(F.col(other).alias("_v")).distinct()
    state = values.agg(F.count("*").alias("_n"), F.count(F.when(F.col("_v").isNull(), 1)).alias("_holes"))
    left = rows.join(values, F.col(column) == F.col("_v"), "left_anti").crossJoin(F.broadcast(state))  # the state is one row
    return left.where((F.col("_n") == 0) | ((F.col("_holes") == 0) & F.col(column).isNotNull())).drop("_n", "_holes")


def union_all(frames: list[DataFrame]) -> DataFrame:
    """U1, by name."""
    return reduce(DataFrame.unionByName, frames)
