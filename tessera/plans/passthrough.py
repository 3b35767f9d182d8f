"""The passthrough query: SQL text over a database's collections, run only if its plan provably just reads.

The order is fixed: arguments, parse, gate, and only then anything that executes. The gate walks the parsed plan, with CTEs and
subqueries, and knows a short list of nodes; whatever it does not know is refused. Text is never searched, so a
statement quoted inside a literal is harmless.
"""

from __future__ import annotations

from functools import lru_cache
from typing import TYPE_CHECKING

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import InvalidArgumentError, NotFoundError, NotReadOnlyError, SchemaError, UnsupportedError
from ..functions import cells as mat
from ..functions.infer import decode, schema_of_documents
from ..functions.types import settle

if TYPE_CHECKING:
    from ..sources.catalog import Engine

NODES = {
    "Project", "Filter", "Aggregate", "Sort", "GlobalLimit", "LocalLimit", "Offset", "Join", "LateralJoin", "Union", "Distinct", "Intersect", "Except",
    "SubqueryAlias", "UnresolvedWith", "UnresolvedHaving", "UnresolvedRelation", "UnresolvedSubqueryColumnAliases", "OneRowRelation", "LocalRelation",
    "UnresolvedInlineTable", "ResolvedInlineTable", "UnionLoop", "UnionLoopRef", "WithWindowDefinition", "Generate", "Pivot", "Unpivot", "UnresolvedTVFAliases", "View",
}
SUBQUERIES = {"ScalarSubquery", "Exists", "ListQuery", "LateralSubquery"}
#: Functions that call code or read what is outside the collections.
BARRED = {"reflect", "try_reflect", "java_method", "input_file_name", "input_file_block_start", "input_file_block_length"}


def _seq(jvm_seq) -> list:
    return [jvm_seq.apply(k) for k in range(jvm_seq.size())]


def _simple(node) -> str:
    return node.getClass().getSimpleName().rstrip("$")


@lru_cache(maxsize=1)
def _builtin(spark) -> frozenset[str]:
    return frozenset(r[0].lower() for r in spark.sql("SHOW SYSTEM FUNCTIONS").collect())


def relations(engine: Engine, plan) -> set[str]:
    """The names that a parsed plan reads, without its CTEs. NotReadOnlyError for anything that is not known to be a read."""
    spark, found, ctes = engine.spark, [], set()

    def expression(e) -> None:
        kind = _simple(e)
        if kind == "UnresolvedFunction":
            parts = _seq(e.nameParts())
            if len(parts) != 1 or parts[0].lower() in BARRED or parts[0].lower() not in _builtin(spark):
                raise NotReadOnlyError(f"function {'.'.join(parts)} is not allowed")
        if kind in SUBQUERIES:
            node(e.plan())
        elif kind.endswith("Subquery") and kind != "InSubquery" or kind.endswith("SubqueryExpression"):
            raise NotReadOnlyError(f"{kind} is not allowed")
        for child in _seq(e.children()):
            expression(child)

    def node(p) -> None:
        kind = _simple(p)
        if kind not in NODES:
            raise NotReadOnlyError(f"{kind} is not allowed")
        if kind == "UnresolvedRelation":
            parts = _seq(p.multipartIdentifier())
            if len(parts) != 1:
                raise NotReadOnlyError(f"{'.'.join(parts)} is not a collection of the database")
            found.append(parts[0])
        if kind == "UnresolvedWith":
            for pair in _seq(p.cteRelations()):
                ctes.add(pair._1().lower())
                node(pair._2())
        for e in _seq(p.expressions()):
            expression(e)
        for child in _seq(p.children()):
            node(child)

    node(plan)
    return {n for n in found if n.lower() not in ctes}


def run(engine: Engine, database: str | None, text: str | None) -> DataFrame:
    """Collections are visible as tables with their system attributes. A query whose one column is VARIANT returns
    documents: these get columns from their first rows as a collection does, none of them hidden."""
    if not engine.config.query_function_enabled:
        raise UnsupportedError("the query function is not registered")
    if database is None or text is None:
        raise InvalidArgumentError("database and query must not be null")
    if database not in engine.databases:
        raise NotFoundError(f"database {database} does not exist")
    spark = engine.spark
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    except ParseException as e:
        raise InvalidArgumentError(f"query cannot be parsed: {e}") from e
    names = sorted(relations(engine, plan))
    for n in names:
        if n.startswith("_"):
            raise NotReadOnlyError(f"{n} is one of the store's own collections")
        if (database, n) in engine.search_views:
            raise UnsupportedError(f"{n} is a search view; there is no full-text index to search")
        if n not in engine.databases[database]:
            raise InvalidArgumentError(f"collection {n} does not exist in {database}")
    tables = {n: engine.table(database, n, hidden=True, extra=["doc"]) for n in names}
    held = spark._jsparkSession.sessionState().catalog()
    own = {n: held.getRawTempView(n) for n in names}
    try:
        for n, t in tables.items():
            t.createOrReplaceTempView(n)
        out = spark.sql(text)
    except AnalysisException as e:
        raise InvalidArgumentError(f"query cannot be run: {e}") from e
    finally:  # the plan is resolved; the names are the user's again
        for n, was in own.items():
            if was.isDefined():
                held.createTempView(n, was.get(), True)
            else:
                spark.catalog.dropTempView(n)
    if len(out.columns) == 1 and isinstance(out.schema[0].dataType, T.VariantType):
        return of_documents(engine, out)
    return out


def of_documents(engine: Engine, rows: DataFrame) -> DataFrame:
    """rows: one VARIANT column. A row that is no object fails the query, early or late."""
    rows = rows.toDF("doc")
    first = [r["j"] for r in rows.select(F.to_json("doc").alias("j")).limit(engine.config.schema_sample_size).collect()]
    if not first:
        raise InvalidArgumentError("the query returns no rows to take columns from")
    docs = [None if j is None else decode(j) for j in first]
    if not all(isinstance(d, dict) for d in docs):
        raise InvalidArgumentError("the query returns a row that is no object")
    if not any(docs):
        raise InvalidArgumentError("the query returns empty objects only")
    if any("" in d for d in docs):
        raise InvalidArgumentError("the query returns an object with an empty key")
    fields = {k: settle(t) for k, t in schema_of_documents(docs).items()}
    if len({k.lower() for k in fields}) < len(fields) and engine.spark.conf.get("spark.sql.caseSensitive") != "true":
        raise SchemaError("keys differ in case only; set spark.sql.caseSensitive to true")
    kind = F.schema_of_variant("doc")
    sure = F.when(kind.startswith("OBJECT<"), F.col("doc")).otherwise(F.raise_error("the query returns a row that is no object").cast("variant"))
    cell = (lambda k, t: mat.strict(mat.field(F.col("doc"), k), t, k)) if engine.config.strict else lambda k, t: mat.materialize(mat.field(F.col("doc"), k), t)
    return rows.select(sure.alias("doc")).select(*[cell(k, t).alias(k) for k, t in fields.items()])
