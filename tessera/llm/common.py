"""Helpers shared by the corpus operators: table paths, shared scratch tables, ASCII folding, hashing."""

from __future__ import annotations

import re
import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: The temporary folder of each application that has no shared one.
_local: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """df in at least as many partitions as there are cores. Only a small table, of fewer files than cores, is dealt out
    anew; a large one is left as its files are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.queryExecution().toRdd().getNumPartitions() < cores else df


def shared_root(spark: SparkSession) -> str:
    """The folder that the driver and all executors see; a temporary one only in local runs, where none is configured."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("on a cluster, spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = _local.setdefault(spark.sparkContext.applicationId, "") or tempfile.mkdtemp(prefix="tessera-")
        _local[spark.sparkContext.applicationId] = root
    return root.rstrip("/")


class Scratch:
    """Intermediate tables in the shared folder. Written data cuts the lineage and outlives a lost executor."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
        self._count = 0

    def write(self, df: DataFrame) -> DataFrame:
        """Write df and read it back."""
        self._count += 1
        path = f"{self.root}/{self._count:04d}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        """Delete tables that this scratch wrote and that no later plan reads."""
        jvm = self.spark._jvm
        for frame in frames:
            path = jvm.org.apache.hadoop.fs.Path(frame._scratch_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def hash_sample(df: DataFrame, keys: list[str], bound: int, distinct: bool = False) -> DataFrame:
    """At most bound rows of df, those with the smallest hashes of their keys; the same rows each time. Only about as many
    rows as asked for take part in the sort, so that no task sends more than its share. distinct: rows that are equal in keys
    count once."""
    h = F.xxhash64(F.lit(5), *keys)
    if distinct:
        df = df.dropDuplicates(keys)
    n = df.count()
    if n <= bound:
        return df
    some = df.filter(F.pmod(h, F.lit(1 << 40)) < int((1 << 40) * min(1.0, 1.2 * bound / n + 100 / n)))
    return some.orderBy(F.pmod(h, F.lit(1 << 40)), *keys).limit(bound)


def aside(df: DataFrame, taken: set[str]) -> tuple[DataFrame, list[Column]]:
    """df with the columns whose names are taken put under other names, and the select that gives df's columns back."""
    name = {c: f"__aside_{k}" if c.lower() in taken else c for k, c in enumerate(df.columns)}
    moved = df.select(*[F.col(f"`{c}`").alias(n) for c, n in name.items()])
    return moved, [F.col(f"`{n}`").alias(c) for c, n in name.items()]


def unused(df: DataFrame, *names: str) -> list[str]:
    """names, with underscores in front until no column of df has them."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n in taken:
            n = f"_{n}"
        out.append(n)
    return out


def whole(df: DataFrame) -> Column:
    """All columns of df as one struct, so that no name can clash with those of an operator."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def parts(df: DataFrame, row: str, leave: set[str] = frozenset()) -> list[Column]:
    """The columns of df again, out of the struct that whole() made, but for those named (in lower case)."""
    return [F.col(row).getField(c).alias(c) for c in df.columns if c.lower() not in leave]


def ascii_lower(col: Column) -> Column:
    return F.translate(col, UPPER, LOWER)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finalizer over uint64 (the public splitmix64 constants)."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(30))
        x = x * np.uint64(0xBF58476D1CE4E5B9)
        x = x ^ (x >> np.uint64(27))
        x = x * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class WordIds(dict):
    """word -> 64-bit hash, remembered for words seen in this worker; emptied when it has grown to its limit. Words of more
    than 64 bytes are not remembered, so that the limit bounds bytes, too."""

    def __init__(self, limit: int = 300_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        import xxhash

        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[word] = h
        return h

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_STEP = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """The hash of each run of width word hashes, in order (width at most 5)."""
    if len(words) < width or width == 0:
        return np.zeros(0, np.uint64)
    n = len(words) - width + 1
    with np.errstate(over="ignore"):
        out = np.full(n, np.uint64(width))
        for k in range(width):
            out += words[k : k + n] * _STEP[k]
    return mix64(out)
