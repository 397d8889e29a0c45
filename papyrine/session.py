"""Session settings and the few facts about a session that operators need."""

from __future__ import annotations

import math
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Settings every result of this package assumes; a caller's own session should have them too.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session with this package's settings; conf adds to or overrides them."""
    builder = SparkSession.builder.master(master).appName("papyrine")
    for key, value in {**SETTINGS, "spark.sql.shuffle.partitions": str(shuffle_partitions), **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """The Parquet table `name` of the lake directory."""
    return spark.read.parquet(f"{directory}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """df with its lineage cut by a reliable checkpoint.

    The folder is the one that the cluster names in spark.checkpoint.dir. Only where that is unset and the session runs on
    one machine, as in tests, a temporary folder is used; elsewhere it is an error.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="papyrine-checkpoint-"))
    return df.checkpoint(eager=True)


def bounded_sample(df: DataFrame, key: str, most: int, total: int) -> DataFrame:
    """At most `most` of df's rows (about `total`), the same ones in every run, for the driver to read. A filter on the key's
    hash first leaves about twice as many, so no task sends more than its share."""
    share = math.ceil(1_000_003 * 2 * most / max(1, total))
    hashed = F.pmod(F.xxhash64(key, F.lit(17)), F.lit(1_000_003))
    return df.where(hashed < share).orderBy(hashed, key, *(c for c in df.columns if c != key and dict(df.dtypes)[c] == "string")).limit(most)
