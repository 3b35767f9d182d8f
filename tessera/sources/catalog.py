"""Databases of document collections as typed tables.

A collection is a DataFrame with a VARIANT column `doc` (or a way to get one); a table is a select of materialized
columns over it. Everything stays lazy: what a table costs is what Spark's optimizer leaves of it.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import EngineConfig
from ..errors import InvalidArgumentError, NotFoundError, SchemaError, UnsupportedError
from ..functions import cells as mat
from ..functions.infer import decode, schema_of_documents
from ..functions.types import settle
from ..plans.partitions import Sharding, counts_agree, group_shards, obstacle
from .cache import TtlCache
from .overrides import DeclaredField, read_override
from .store import unbroadcast

log = logging.getLogger(__name__)
# The store's own attributes of documents and of edges.
SYSTEM, EDGE = ("_key", "_id", "_rev"), ("_from", "_to")


@dataclass(frozen=True)
class ColumnInfo:
    name: str
    type: T.DataType
    hidden: bool = False


@dataclass
class Collection:
    """source: a DataFrame with `doc`, or a function that makes one. order: a column that makes samples stable."""

    source: DataFrame | Callable[[], DataFrame]
    edge: bool = False
    sharding: Sharding | None = None
    shard: str | None = None
    order: str | None = None
    rows: Callable[[], int] | None = None
    json: str | None = None

    def documents(self) -> DataFrame:
        return self.source() if callable(self.source) else self.source


class Engine:
    def __init__(self, spark: SparkSession, config: EngineConfig | None = None, clock: Callable[[], float] = time.monotonic):
        self.spark, self.config = spark, config or EngineConfig()
        self.databases: dict[str, dict[str, Collection]] = {}
        self._schemas = TtlCache(self.config.schema_cache_ttl, clock)
        self._counts = TtlCache(self.config.statistics_cache_ttl, clock)
        self.search_views: set[tuple[str, str]] = set()

    # -- registering ---------------------------------------------------------------------------------------------

    def create_database(self, database: str) -> Engine:
        self.databases.setdefault(database, {})
        return self

    def register(self, database: str, name: str, source: DataFrame | Callable[[], DataFrame], *, json: str | None = None, edge: bool = False, sharding: Sharding | None = None, shard: str | None = None, order: str | None = None, rows: Callable[[], int] | None = None) -> Engine:
        """Makes a collection known. json: the column of JSON text if the source has no VARIANT column `doc`; text that is no
        JSON is a document without fields."""
        if json is not None:
            given = source
            source = lambda: (given() if callable(given) else given).withColumn("doc", F.try_parse_json(json))
        self.create_database(database).databases[database][name] = Collection(source, edge, sharding, shard, order, rows, json)
        return self

    def register_path(self, database: str, name: str, path: str, format: str = "parquet", **options) -> Engine:
        """A folder of Parquet with a VARIANT `doc`, or of text with one JSON document a line (format "json")."""
        if format == "json":
            return self.register(database, name, lambda: self.spark.read.text(path).withColumnRenamed("value", "_json"), json="_json", **options)
        return self.register(database, name, lambda: self.spark.read.format(format).load(path), **options)

    def discover(self, root: str | None = None) -> Engine:
        """Registers every collection under root/<database>/: "<name>" or "<name>.parquet" as Parquet with a VARIANT
        `doc`, "<name>.json" as JSON lines. Listed through Hadoop's file systems, so any store that Spark reads will do."""
        root = root or self.config.root
        if root is None:
            raise InvalidArgumentError("there is no root to look under")
        path = self.spark._jvm.org.apache.hadoop.fs.Path(root)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        for database in fs.listStatus(path):
            if not database.isDirectory():
                continue
            name = database.getPath().getName()
            self.create_database(name)
            for entry in fs.listStatus(database.getPath()):
                stem, _, ending = entry.getPath().getName().partition(".")
                if stem and not entry.getPath().getName().startswith("."):
                    self.register_path(name, stem, entry.getPath().toString(), "json" if ending in ("json", "jsonl") else "parquet")
        return self

    # -- the catalog ---------------------------------------------------------------------------------------------

    def list_schemas(self) -> list[str]:
        return sorted(self.databases)

    def list_tables(self, database: str | None = None) -> list[tuple[str, str]]:
        """(database, table); nothing for an unknown database. Collections that begin with an underscore are the store's own."""
        some = self.databases if database is None else {database: self.databases.get(database, {})}
        return sorted((d, t) for d, tables in some.items() for t in tables if not t.startswith("_"))

    def find(self, database: str, name: str, version=None) -> Collection | None:
        if version is not None:
            raise UnsupportedError("tables have no versions")
        if database not in self.databases:
            raise NotFoundError(f"database {database} does not exist")
        return None if name.startswith("_") else self.databases[database].get(name)

    def _collection(self, database: str, name: str, version=None) -> Collection:
        found = self.find(database, name, version)
        if found is None:
            raise NotFoundError(f"table {database}.{name} does not exist")
        return found

    def describe(self, database: str, name: str) -> list[ColumnInfo]:
        """User columns, then _key, _id and _rev (hidden), then _from and _to of an edge collection."""
        found = self._collection(database, name)
        return self._schemas.get((database, name), lambda: self._resolve(database, name, found))

    def _resolve(self, database: str, name: str, found: Collection) -> list[ColumnInfo]:
        declared = self._declared(database, name)
        if declared is not None:
            columns = [ColumnInfo(f.name, f.type, f.hidden) for f in declared]
        else:
            own = {*SYSTEM, *(EDGE if found.edge else ())}
            columns = [ColumnInfo(k, settle(t)) for k, t in schema_of_documents(self.sample(found), own).items()]
        text = T.StringType()
        columns += [ColumnInfo(k, text, True) for k in SYSTEM]
        columns += [ColumnInfo(k, text) for k in EDGE] if found.edge else []
        if len({c.name.lower() for c in columns}) < len(columns) and self.spark.conf.get("spark.sql.caseSensitive") != "true":
            raise SchemaError(f"columns of {database}.{name} differ in case only; set spark.sql.caseSensitive to true")
        return columns

    def sample(self, found: Collection) -> list[dict]:
        """At most schema_sample_size documents, on the driver. JSON text keeps the order of its fields; a VARIANT has its
        fields in the order of their names."""
        df, n = found.documents(), self.config.schema_sample_size
        if self.config.schema_sample_random:
            df = df.orderBy(F.rand())
        elif found.order:
            df = df.orderBy(found.order)
        there = df.filter(F.col("doc").isNotNull())
        texts = there.select((F.col(found.json) if found.json else F.to_json("doc")).alias("j")).limit(n).collect()
        return [d for r in texts if isinstance(d := decode(r["j"]), dict)]

    def _declared(self, database: str, name: str) -> list[DeclaredField] | None:
        found = self.databases[database].get(self.config.schema_collection)
        if found is None:
            return None
        mine = found.documents().filter(F.try_variant_get("doc", "$.table", "string") == name)
        return read_override([decode(r["j"]) for r in mine.select(F.to_json("doc").alias("j")).limit(2).collect()], name)

    # -- tables --------------------------------------------------------------------------------------------------

    def table(self, database: str, name: str, columns: list[str] | None = None, hidden: bool = False, version=None, extra: list[str] | None = None) -> DataFrame:
        """The typed table: its visible columns; with hidden, all; with columns, those by name, hidden ones too. A
        declared timestamp with time zone can also be read as `<name>__offset_minutes`. extra: columns of the source to
        take along. In strict mode a query fails at the first value that does not fit in a row and a column that it reads,
        whether a filter would drop the row or not."""
        found = self._collection(database, name, version)
        known = self.describe(database, name)
        return self._typed(found.documents(), known, columns, hidden, extra or [])

    def _typed(self, docs: DataFrame, known: list[ColumnInfo], columns, hidden: bool, extra: list[str]) -> DataFrame:
        by_name = {c.name: c for c in known}
        if columns is None:
            out = [self._column(c) for c in known if hidden or not c.hidden]
        else:
            out = []
            for n in columns:
                base = n.removesuffix("__offset_minutes")
                c = by_name.get(n) or by_name.get(base)
                if c is None or n != c.name and not isinstance(c.type, T.TimestampType):
                    raise NotFoundError(f"column {n} does not exist")
                out.append(self._column(c) if n == c.name else mat.with_offset(mat.field(F.col("doc"), base)).alias(n))
        return unbroadcast(docs, docs.select(*out, *extra))

    def _column(self, c: ColumnInfo) -> Column:
        value = mat.field(F.col("doc"), c.name)
        cell = mat.strict(value, c.type, c.name) if self.config.strict else mat.materialize(value, c.type)
        return cell.alias(c.name, metadata={"hidden": c.hidden, "path": [c.name]})

    def views(self, database: str) -> list[str]:
        """Registers each table as a temporary view of its visible columns and `<name>__all` of all. A table whose schema is
        broken is left out; it fails when it is used."""
        done = []
        for _, name in self.list_tables(database):
            try:
                self.table(database, name, hidden=True).createOrReplaceTempView(f"{name}__all")
                self.table(database, name).createOrReplaceTempView(name)
                done.append(name)
            except SchemaError as e:
                log.warning("%s.%s has no view: %s", database, name, e)
        return done

    # -- splits --------------------------------------------------------------------------------------------------

    def splits(self, database: str, name: str, aggregated: bool = False) -> list[list[str]]:
        """Groups of shards to scan side by side; one empty group is the whole collection. Any doubt gives that."""
        why = self.obstacle(database, name, aggregated)
        if why:
            log.info("%s.%s is scanned whole: %s", database, name, why)
            return [[]]
        return group_shards(list(self._collection(database, name).sharding.shards), self.config.shards_per_split, self.config.max_splits)

    def obstacle(self, database: str, name: str, aggregated: bool = False) -> str | None:
        """Why a collection is not scanned by shards, or None. Its shards' counts, taken once while statistics are cached, must
        prove that they are apart."""
        found = self._collection(database, name)
        if aggregated:
            return "rows are aggregated at the store"
        if not self.config.shard_parallelism_enabled:
            return "it is switched off"
        if found.shard is None:
            return "the shard of a document is not known"
        why = obstacle(found.sharding)
        if why is None and not self._counts.get((database, name, "shards"), lambda: self._apart(database, name, found)):
            why = "the counts of its shards do not add up"
        return why

    def _apart(self, database: str, name: str, found: Collection) -> bool:
        each = {r[0]: r[1] for r in found.documents().groupBy(found.shard).count().filter(F.col(found.shard).isin(list(found.sharding.shards))).collect()}
        return counts_agree(self.row_count(database, name), [each.get(s, 0) for s in found.sharding.shards])

    def scan_split(self, database: str, name: str, shards: list[str], columns: list[str] | None = None) -> DataFrame:
        found = self._collection(database, name)
        docs = found.documents()
        return self._typed(docs.filter(F.col(found.shard).isin(shards)) if shards else docs, self.describe(database, name), columns, False, [])

    # -- statistics ----------------------------------------------------------------------------------------------

    def row_count(self, database: str, name: str) -> int:
        found = self._collection(database, name)
        return self._counts.get((database, name), lambda: found.rows() if found.rows else found.documents().count())

    def statistics(self, database: str, name: str | None, *, passthrough: bool = False, grouped: bool | None = None, limit: int | None = None) -> int | None:
        """The estimated rows of a scan, or None if unknown. grouped: None is no aggregation, False a global one. Filters
        do not change the estimate."""
        if not self.config.statistics_enabled or passthrough:
            return None
        if grouped is False:
            return 1
        if grouped:
            return limit
        try:
            n = self.row_count(database, name)
        except (AnalysisException, NotFoundError, OSError, RuntimeError) as e:
            log.warning("rows of %s.%s are not known: %s", database, name, e)
            return None
        return n if limit is None or self.config.shard_parallelism_enabled else min(n, limit)

    # -- search views, passthrough ---------------------------------------------------------------------------------------------

    def register_search_view(self, database: str, name: str) -> Engine:
        """Makes the name of a search view known, so that a query over it is refused for what it is."""
        self.create_database(database).search_views.add((database, name))
        return self

    def query(self, database: str | None, text: str | None) -> DataFrame:
        from ..plans.passthrough import run

        return run(self, database, text)
