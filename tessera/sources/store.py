"""Collections stored as Parquet with a VARIANT column, from which scans take only the paths that a query touches."""

from __future__ import annotations

import tempfile
import uuid

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The temporary folder of each application that has no shared one.
_local: dict[str, str] = {}
_stored: dict[tuple[str, str, str], str] = {}


def shared_folder(spark: SparkSession) -> str:
    """A folder that all executors see; a temporary one only where none is configured."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = _local.setdefault(spark.sparkContext.applicationId, "") or tempfile.mkdtemp(prefix="tessera-")
        _local[spark.sparkContext.applicationId] = root
    return root.rstrip("/")


def spread(df: DataFrame) -> DataFrame:
    """df in at least as many partitions as there are cores. For source rows: documents made of them are far wider to deal out."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.queryExecution().toRdd().getNumPartitions() < cores else df


@contextmanager
def _whole(spark: SparkSession) -> Iterator[None]:
    """VARIANT is written in one piece meanwhile. Split into columns by type it takes twice the time to write, and whole documents of
    this size are scanned as fast."""
    key = "spark.sql.variant.writeShredding.enabled"
    was = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, was)


def stored_documents(spark: SparkSession, key: str, name: str, make, small: bool = False) -> DataFrame:
    """The documents of make() (JSON text in `json`, and other columns), written once in a session as `doc`; into one
    file if small, else into as many files as there are cores at least."""
    at = (spark.sparkContext.applicationId, key, name)
    if at not in _stored:
        path = f"{shared_folder(spark)}/documents-{uuid.uuid4().hex}/{name}"
        df = make().coalesce(1) if small else spread(make())
        with _whole(spark):
            df.withColumn("doc", F.try_parse_json("json")).drop("json").write.parquet(path)
        _stored[at] = path
    return spark.read.parquet(_stored[at])


def unbroadcast(docs: DataFrame, typed: DataFrame) -> DataFrame:
    """typed, kept from being broadcast in a join by size if docs, its source, is above the threshold. Spark takes a VARIANT for 2048
    bytes, so that a few typed columns of it count as a hundredth of the files or less. Small sources may be broadcast as ever,
    also into a join with a large one, and an explicit broadcast hint outside wins."""
    spark = typed.sparkSession
    session, plans = spark._jsparkSession, spark._jvm.org.apache.spark.sql.catalyst.plans.logical
    if docs.isStreaming or docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() <= session.sessionState().conf().autoBroadcastJoinThreshold():
        return typed
    never = getattr(getattr(plans, "NO_BROADCAST_HASH$"), "MODULE$")
    plan = plans.ResolvedHint(typed._jdf.queryExecution().analyzed(), plans.HintInfo(spark._jvm.scala.Some(never)))
    return DataFrame(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(session, plan), spark)


def dealt(df: DataFrame, *keys: str, most: int = 16 << 20) -> DataFrame:
    """df dealt out by keys into so many parts that each comes from about most bytes of files, where these are more than there
    are cores: what sorts or holds a part then takes the same memory for tables of any size. Left to itself Spark puts small
    parts together until there is one for each core."""
    spark = df.sparkSession
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(leaves.apply(k).stats().sizeInBytes()) for k in range(leaves.size()))
    if size >= int(spark._jsparkSession.sessionState().conf().defaultSizeInBytes()) or size <= most * spark.sparkContext.defaultParallelism:  # not known, or small
        return df
    return df.repartition(-(-size // most), *keys)


def written(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read back: cuts the lineage, and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/written-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
