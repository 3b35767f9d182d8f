"""The engine's own queries over documents derived from the supplied tables, each with its DuckDB SQL.

The SQL states the expected relational result over the base tables; it knows nothing of documents. Collections:

- items: lineitem as documents. `quantity` is dirty by l_orderkey % 10: 3 text, 4 a fraction, 5 a boolean, 6 far out of
  range, 7 null, 8 absent. Its schema comes from an override document.
- sales: clean documents of orders, whose schema is sampled.
- orders_declared: totals as decimal text and dates as ISO text, with an override.
- people: customers with nested objects and lists, some of them dirty.
- places, lies_in: nations and regions as vertices and edges.

A session writes each collection once, as Parquet with a VARIANT column, and reads that from then on.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .config import EngineConfig
from .operators import neighbors, shortest_paths, traverse
from .plans.partitions import Sharding
from .sources import Engine
from .sources.store import dealt, shared_folder, spread, stored_documents
from .streaming import typed_stream

QueryFn = Callable[[SparkSession, str], DataFrame]


def _json(**parts) -> F.Column:
    """A JSON object text; a part that is NULL is left out."""
    pairs = [F.concat(F.lit(f'"{k.rstrip("_")}":' if not k.startswith("_") else f'"{k}":'), v) for k, v in parts.items()]
    return F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit("}"))


def _text(c) -> F.Column:
    return F.concat(F.lit('"'), c, F.lit('"'))


def engine(spark: SparkSession, sf: str, config: EngineConfig | None = None) -> Engine:
    def read(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf}/{name}.parquet")

    def items() -> DataFrame:
        k, q = F.col("l_orderkey") % 10, F.col("l_quantity").cast("int").cast("string")
        quantity = F.when(k == 3, _text(q)).when(k == 4, F.concat(q, F.lit(".5"))).when(k == 5, F.lit("true")).when(k == 6, F.lit("1e19")).when(k == 7, F.lit("null")).when(k == 8, F.lit(None).cast("string")).otherwise(q)
        name = F.concat_ws("-", F.col("l_orderkey"), F.col("l_linenumber"))
        price = F.when(k == 9, _text(F.lit("n/a"))).otherwise(F.col("l_extendedprice").cast("string"))
        tags = F.concat(F.lit("["), F.col("l_linenumber").cast("string"), F.lit(","), _text(F.col("l_returnflag")), F.lit(","), (F.col("l_linenumber") * 2).cast("string"), F.lit(".0]"))
        ship = _json(date=_text(F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss")), status=F.when(k != 2, _text(F.col("l_linestatus"))))
        doc = _json(_key=_text(name), _id=_text(F.concat(F.lit("items/"), name)), _rev=_text(F.lit("r1")), order=F.col("l_orderkey").cast("string"), line=F.col("l_linenumber").cast("string"), quantity=quantity, price=price, flag=F.when(k == 1, F.lit("42")).otherwise(_text(F.col("l_returnflag"))), taxed=F.when(k == 0, _text(F.lit("yes"))).otherwise((F.col("l_tax") > 0.04).cast("string")), tags=tags, ship=ship)
        return spread(read("lineitem")).select(doc.alias("json"), F.pmod("l_orderkey", F.lit(4)).cast("string").alias("shard"))

    def sales() -> DataFrame:
        doc = _json(_key=_text(F.col("o_orderkey").cast("string")), id=F.col("o_orderkey").cast("string"), customer=F.col("o_custkey").cast("string"), status=_text(F.col("o_orderstatus")), total=F.concat(F.floor("o_totalprice").cast("string"), F.lit(".5")), urgent=F.col("o_orderpriority").startswith("1").cast("string"))
        return spread(read("orders")).select(doc.alias("json"), F.col("o_orderkey").alias("at"))

    def declared() -> DataFrame:
        day = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
        cents = F.concat((F.col("o_orderkey") * 7).cast("string"), F.lit("."), F.lpad((F.col("o_orderkey") % 100).cast("string"), 2, "0"))
        total = F.when(F.col("o_orderkey") % 5 == 0, F.concat(cents, F.lit("1"))).otherwise(cents)
        doc = _json(id=F.col("o_orderkey").cast("string"), total=_text(total), placed=_text(F.concat(day, F.when(F.col("o_orderkey") % 3 == 0, ".1234").otherwise(".250"))), seen=_text(F.concat(day, F.when(F.col("o_orderkey") % 2 == 0, "+05:30").otherwise("Z"))), big=F.when(F.col("o_orderkey") % 4 == 0, F.lit("18446744073709551615")).otherwise(F.col("o_orderkey").cast("string")), note=_text(F.lit("secret")))
        return spread(read("orders")).select(doc.alias("json"))

    def people() -> DataFrame:
        k = F.col("c_custkey") % 4
        address = F.when(k == 3, F.lit('"nowhere"')).otherwise(_json(nation=F.col("c_nationkey").cast("string"), segment=_text(F.col("c_mktsegment")), zip=F.when(k != 1, F.col("c_custkey").cast("string"))))
        big = F.when(k == 1, F.lit("9007199254740993")).when(k == 2, F.lit("18014398509481983")).otherwise(F.col("c_custkey").cast("string"))
        zero = F.when(k == 0, F.lit("0")).when(k == 1, F.lit("-0.0")).when(k == 2, F.lit("0.0")).otherwise(F.lit("-0.0e0"))
        doc = _json(_key=_text(F.col("c_custkey").cast("string")), id=F.col("c_custkey").cast("string"), name=_text(F.col("c_name")), address=address, big=big, near=big, zero=zero, balance=F.col("c_acctbal").cast("string"))
        return spread(read("customer")).select(doc.alias("json"))

    def places() -> DataFrame:
        nation = _json(_key=_text(F.concat(F.lit("n"), F.col("n_nationkey"))), _id=_text(F.concat(F.lit("places/n"), F.col("n_nationkey"))), name=_text(F.col("n_name")))
        region = _json(_key=_text(F.concat(F.lit("r"), F.col("r_regionkey"))), _id=_text(F.concat(F.lit("places/r"), F.col("r_regionkey"))), name=_text(F.col("r_name")))
        return read("nation").select(nation.alias("json")).unionByName(read("region").select(region.alias("json")))

    def edges() -> DataFrame:
        """Nation to region, and each region to the nation that has its number."""
        up = _json(_key=_text(F.concat(F.lit("u"), F.col("n_nationkey"))), _from=_text(F.concat(F.lit("places/n"), F.col("n_nationkey"))), _to=_text(F.concat(F.lit("places/r"), F.col("n_regionkey"))), since=(F.col("n_nationkey") + 2000).cast("string"))
        down = _json(_key=_text(F.concat(F.lit("d"), F.col("r_regionkey"))), _from=_text(F.concat(F.lit("places/r"), F.col("r_regionkey"))), _to=_text(F.concat(F.lit("places/n"), F.col("r_regionkey"))), since=(F.col("r_regionkey") + 1000).cast("string"))
        return read("nation").select(up.alias("json")).unionByName(read("region").select(down.alias("json")))

    def overrides() -> DataFrame:
        rows = [
            ("""{"table":"items","fields":[{"name":"order","type":"bigint"},{"name":"line","type":"bigint"},{"name":"quantity","type":"bigint"},{"name":"price","type":"double"},{"name":"flag","type":"varchar"},{"name":"taxed","type":"boolean"},{"name":"tags","type":"array(bigint)"},{"name":"ship","type":"row(date timestamp(3), status varchar, gone bigint)"}]}""",),
            ("""{"table":"orders_declared","fields":[{"name":"id","type":"bigint"},{"name":"total","type":"decimal(12,2)"},{"name":"placed","type":"timestamp(3)"},{"name":"seen","type":"timestamp(3) with time zone"},{"name":"big","type":"decimal(38,0)"},{"name":"note","type":"varchar","hidden":true},{"name":"misspelled","type":"varchar"}]}""",),
            ("""{"table":"people","fields":[{"name":"id","type":"bigint"},{"name":"name","type":"varchar"},{"name":"address","type":"row(nation bigint, segment varchar, zip bigint)"},{"name":"big","type":"bigint"},{"name":"near","type":"double"},{"name":"zero","type":"bigint"},{"name":"balance","type":"double"}]}""",),
        ]
        return spark.createDataFrame(rows, "json string")

    def stored(name: str, make: Callable[[], DataFrame], small: bool = False) -> Callable[[], DataFrame]:
        return lambda: stored_documents(spark, sf, name, make, small)

    e = Engine(spark, config)
    e.register("shop", "items", stored("items", items), shard="shard", sharding=Sharding(("0", "1", "2", "3")))
    e.register("shop", "sales", stored("sales", sales), order="at")
    e.register("shop", "orders_declared", stored("orders_declared", declared))
    e.register("shop", "people", stored("people", people))
    e.register("shop", "places", stored("places", places, True))
    e.register("shop", "lies_in", stored("lies_in", edges, True), edge=True)
    e.register("shop", e.config.schema_collection, stored("overrides", overrides, True))
    return e


QUERIES: dict[str, QueryFn] = {}
SQL: dict[str, str] = {}

# The dirty columns of items as SQL.
_Q = "CASE WHEN l_orderkey % 10 IN (3,4,5,6,7,8) THEN NULL ELSE CAST(l_quantity AS BIGINT) END"
_P = "CASE WHEN l_orderkey % 10 = 9 THEN NULL ELSE l_extendedprice END"
_F = "CASE WHEN l_orderkey % 10 = 1 THEN NULL ELSE l_returnflag END"
_T = "CASE WHEN l_orderkey % 10 = 0 THEN NULL ELSE l_tax > 0.04 END"
_ITEMS = f"(SELECT l_orderkey AS \"order\", CAST(l_linenumber AS BIGINT) AS line, {_Q} AS quantity, {_P} AS price, {_F} AS flag, {_T} AS taxed, l_orderkey, l_linenumber, l_shipdate, l_linestatus, l_returnflag FROM lineitem) i"
_SALES = "(SELECT o_orderkey AS id, o_custkey AS customer, o_orderstatus AS status, floor(o_totalprice) + 0.5 AS total, o_orderpriority LIKE '1%' AS urgent FROM orders) s"
_BIG = "CASE WHEN c_custkey % 4 = 1 THEN 9007199254740993 WHEN c_custkey % 4 = 2 THEN 18014398509481983 ELSE c_custkey END"
_PEOPLE = f"(SELECT c_custkey AS id, c_name AS name, CASE WHEN c_custkey % 4 = 3 THEN NULL ELSE c_nationkey END AS nation, CASE WHEN c_custkey % 4 = 3 THEN NULL ELSE c_mktsegment END AS segment, CASE WHEN c_custkey % 4 IN (1, 3) THEN NULL ELSE c_custkey END AS zip, {_BIG} AS big, CAST({_BIG} AS DOUBLE) AS near, c_acctbal AS balance FROM customer) p"
_EDGES = "(SELECT 'places/n' || n_nationkey AS _from, 'places/r' || n_regionkey AS _to, CAST(n_nationkey + 2000 AS BIGINT) AS since, 'u' || n_nationkey AS _key FROM nation UNION ALL SELECT 'places/r' || r_regionkey, 'places/n' || r_regionkey, r_regionkey + 1000, 'd' || r_regionkey FROM region) e"
_PLACES = "(SELECT 'n' || n_nationkey AS _key, 'places/n' || n_nationkey AS _id, n_name AS name FROM nation UNION ALL SELECT 'r' || r_regionkey, 'places/r' || r_regionkey, r_name FROM region) v"


def _query(sql: str | None = None, name: str | None = None, config: EngineConfig | None = None):
    def put(f):
        key = name or f.__name__.lstrip("_")
        QUERIES[key] = lambda spark, sf: f(engine(spark, sf, config))
        if sql:
            SQL[key] = sql
        return f

    return put


def _items(e: Engine, *columns: str) -> DataFrame:
    return e.table("shop", "items", list(columns) or None)


@_query(f"SELECT flag, count(*) AS n, count(quantity) AS n_quantity, CAST(sum(quantity) AS BIGINT) AS sum_quantity, round(sum(price), 2) AS sum_price FROM {_ITEMS} GROUP BY flag")
def flagship(e):
    return _items(e).groupBy("flag").agg(F.count("*").alias("n"), F.count("quantity").alias("n_quantity"), F.sum("quantity").alias("sum_quantity"), F.round(F.sum("price"), 2).alias("sum_price"))


# -- sources and projections


@_query(f'SELECT "order", line, quantity, price, flag, taxed FROM {_ITEMS}')
def scan_typed(e):
    return _items(e, "order", "line", "quantity", "price", "flag", "taxed")


@_query(f"SELECT * FROM {_SALES}")
def scan_sampled(e):
    return e.table("shop", "sales")


@_query(f"SELECT count(*) AS n FROM {_ITEMS}")
def scan_no_columns(e):
    return _items(e).agg(F.count("*").alias("n"))


@_query(f"SELECT since, _from, _to FROM {_EDGES}")
def scan_edge_from_to(e):
    return e.table("shop", "lies_in")


@_query(f"SELECT _key, _id, name FROM {_PLACES}")
def hidden_columns(e):
    return e.table("shop", "places", ["_key", "_id", "name"])


@_query(f'SELECT "order", line, quantity FROM {_ITEMS}')
def scan_splits(e):
    parts = [e.scan_split("shop", "items", g, ["order", "line", "quantity"]) for g in e.splits("shop", "items")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@_query("SELECT * FROM (VALUES ('shop', 'items'), ('shop', 'lies_in'), ('shop', 'orders_declared'), ('shop', 'people'), ('shop', 'places'), ('shop', 'sales'), ('shop', 'schema_overrides')) t(database_name, table_name)")
def list_tables(e):
    return e.spark.createDataFrame(e.list_tables("shop"), "database_name string, table_name string")


@_query("SELECT 'shop' AS database_name UNION ALL SELECT 'spare'")
def list_databases(e):
    return e.spark.createDataFrame([(d,) for d in e.create_database("spare").list_schemas()], "database_name string")


_SALES_SCHEMA = "SELECT * FROM (VALUES ('id','bigint',false),('customer','bigint',false),('status','string',false),('total','double',false),('urgent','boolean',false),('_key','string',true),('_id','string',true),('_rev','string',true)) t(name, type, hidden)"


@_query(_SALES_SCHEMA, config=EngineConfig(schema_sample_random=True, schema_sample_size=50))
def infer_random_sample(e):
    return infer_schema(e)


@_query(_SALES_SCHEMA)
def infer_schema(e):
    return e.spark.createDataFrame([(c.name, c.type.simpleString(), c.hidden) for c in e.describe("shop", "sales")], "name string, type string, hidden boolean")


@_query("SELECT * FROM (VALUES ('a','double'),('b','string'),('c','array<string>'),('d','struct<x:bigint,y:string>'),('e','decimal(38,0)'),('f','string'),('g','bigint')) t(name, type)")
def infer_merge_schema(e):
    rows = ['{"a":1,"b":"x","c":[],"d":{"x":1},"e":1,"f":null,"g":1.0}', '{"a":1.5,"b":2,"c":[1],"d":{"x":2.0,"y":null},"e":18446744073709551615}']
    e.register("shop", "mixed", e.spark.createDataFrame([(k, r) for k, r in enumerate(rows)], "k int, json string"), json="json", order="k")
    return e.spark.createDataFrame([(c.name, c.type.simpleString()) for c in e.describe("shop", "mixed") if not c.hidden], "name string, type string")


@_query(f"SELECT id, nation, segment FROM {_PEOPLE}")
def project_nested(e):
    return e.table("shop", "people").select("id", F.col("address.nation").alias("nation"), F.col("address.segment").alias("segment"))


@_query(f"SELECT id, nation, zip, nation IS NULL AND segment IS NULL AS gone FROM {_PEOPLE}")
def row_absent_field(e):
    return e.table("shop", "people").select("id", F.col("address.nation").alias("nation"), F.col("address.zip").alias("zip"), F.col("address").isNull().alias("gone"))


@_query('SELECT l_orderkey AS "order", CAST(l_linenumber AS BIGINT) AS line, CAST(l_linenumber AS BIGINT) AS first, CAST(NULL AS BIGINT) AS second, CAST(l_linenumber * 2 AS BIGINT) AS third, CAST(3 AS BIGINT) AS n FROM lineitem')
def array_leaf_null(e):
    return _items(e).select("order", "line", *[F.get("tags", F.lit(k)).alias(n) for k, n in enumerate(("first", "second", "third"))], F.size("tags").cast("bigint").alias("n"))


@_query('SELECT l_orderkey AS "order", CAST(l_linenumber AS BIGINT) AS line, pos, CASE pos WHEN 0 THEN l_linenumber WHEN 1 THEN NULL ELSE l_linenumber * 2 END AS tag FROM lineitem, (VALUES (0), (1), (2)) t(pos)')
def unnest_array(e):
    return _items(e).select("order", "line", F.posexplode("tags").alias("pos", "tag"))


@_query(f'SELECT "order", line, quantity * 2 + line AS x, upper(flag) || \'!\' AS y FROM {_ITEMS}')
def project_computed(e):
    return _items(e).select("order", "line", (F.col("quantity") * 2 + F.col("line")).alias("x"), F.concat(F.upper("flag"), F.lit("!")).alias("y"))


# -- filters


def _filter(key: str, condition: str, columns: str = '"order", line, quantity', base: str = _ITEMS, table: str = "items"):
    chosen = [c.strip().strip('"') for c in columns.split(",")]
    spark_text = condition.replace('"', "`")
    _query(f"SELECT {columns} FROM {base} WHERE {condition}", key)(lambda e: e.table("shop", table).filter(spark_text).select(*chosen))


_filter("filter_eq_bigint", "quantity = 17")
_filter("filter_eq_varchar", "flag = 'R'")
_filter("filter_eq_boolean", "taxed = true")
_filter("filter_eq_double", "near = 4", "id, near", _PEOPLE, "people")
_filter("filter_in_bigint", "quantity IN (1, 2, 50)")
_filter("filter_in_varchar", "flag IN ('A', 'N')")
_filter("filter_in_double", "near IN (3, 4, 7, 8, 9007199254740992)", "id, near", _PEOPLE, "people")
_filter("filter_in_boolean", "taxed IN (true, false)")
_filter("filter_range_bigint_dirty", "quantity > 10 AND quantity <= 45")
_filter("filter_range_double", "total BETWEEN 1000 AND 90000.5", "id, total", _SALES, "sales")
_filter("filter_multi_range", "quantity < 5 OR quantity >= 48 OR quantity = 20")
_filter("filter_is_null_coerced", "quantity IS NULL")
_filter("filter_is_not_null_coerced", "quantity IS NOT NULL")
_filter("filter_not_equal", "quantity <> 17 AND flag <> 'R'")
_filter("filter_not_in", "quantity NOT IN (1, 2, 3)")
_filter("filter_like", "flag LIKE 'R%'")
_filter("filter_columns", "quantity > line")
_filter("filter_or_columns", "quantity = 1 OR flag = 'A'")
_filter("filter_and_columns", "quantity > 30 AND flag = 'N' AND taxed = false AND price > 1000")
_filter("filter_unsatisfiable", "quantity > 10 AND quantity < 5")
_filter("filter_varchar_no_stringify", "flag = '42'")
_filter("filter_varchar_range", "flag > 'B'")
_filter("filter_2p53_double", "near > 9007199254740992", "id, near", _PEOPLE, "people")
_filter("filter_2p54_double", "near = 18014398509481984", "id, near", _PEOPLE, "people")
_filter("filter_2p53_bigint", "big = 9007199254740993", "id, big", _PEOPLE, "people")
_filter("filter_null_safe", "quantity IS NOT DISTINCT FROM 7")


@_query(f"SELECT id, nation FROM {_PEOPLE} WHERE nation = 3")
def filter_nested(e):
    return e.table("shop", "people").filter("address.nation = 3").select("id", F.col("address.nation").alias("nation"))


# -- aggregates


@_query(f"SELECT count(*) AS n, count(1) AS one FROM {_ITEMS}")
def agg_count_star(e):
    return _items(e).agg(F.count("*").alias("n"), F.count(F.lit(1)).alias("one"))


@_query(f'SELECT count(quantity) AS q, count(price) AS p, count(flag) AS f, count(taxed) AS t, count(*) AS tags FROM {_ITEMS}')
def agg_count_col(e):
    return _items(e).agg(*[F.count(c).alias(a) for c, a in (("quantity", "q"), ("price", "p"), ("flag", "f"), ("taxed", "t"), ("tags", "tags"))])


@_query(f"SELECT min(quantity) AS q0, max(quantity) AS q1, min(price) AS p0, max(price) AS p1, min(flag) AS f0, max(flag) AS f1, min(taxed) AS t0, max(taxed) AS t1 FROM {_ITEMS}")
def agg_min_max(e):
    return _items(e).agg(*[f(c).alias(f"{c[0]}{k}") for c in ("quantity", "price", "flag", "taxed") for k, f in enumerate((F.min, F.max))])


@_query(f"SELECT status, round(sum(total), 2) AS s, round(avg(total), 6) AS a FROM {_SALES} GROUP BY status")
def agg_sum_avg_double(e):
    return e.table("shop", "sales").groupBy("status").agg(F.round(F.sum("total"), 2).alias("s"), F.round(F.avg("total"), 6).alias("a"))


@_query(f"SELECT line, CAST(sum(quantity) AS BIGINT) AS s FROM {_ITEMS} GROUP BY line")
def agg_sum_bigint(e):
    return _items(e).groupBy("line").agg(F.sum("quantity").alias("s"))


@_query(f"SELECT line, round(avg(quantity), 9) AS a FROM {_ITEMS} GROUP BY line")
def agg_avg_bigint(e):
    return _items(e).groupBy("line").agg(F.round(F.avg("quantity"), 9).alias("a"))


@_query(f"SELECT count(*) AS n, count(quantity) AS q, CAST(sum(quantity) AS BIGINT) AS s, avg(price) AS a, min(price) AS m FROM {_ITEMS} WHERE line < 0")
def agg_empty_input(e):
    return _items(e).filter("line < 0").agg(F.count("*").alias("n"), F.count("quantity").alias("q"), F.sum("quantity").alias("s"), F.avg("price").alias("a"), F.min("price").alias("m"))


@_query(f'SELECT "order" % 10 AS k, count(*) AS n, count(quantity) AS c, CAST(sum(quantity) AS BIGINT) AS s, max(quantity) AS m FROM {_ITEMS} GROUP BY 1')
def agg_all_null_group(e):
    return _items(e).groupBy((F.col("order") % 10).alias("k")).agg(F.count("*").alias("n"), F.count("quantity").alias("c"), F.sum("quantity").alias("s"), F.max("quantity").alias("m"))


@_query(f"SELECT flag, taxed, line, count(*) AS n FROM {_ITEMS} GROUP BY flag, taxed, line")
def group_by_multi(e):
    return _items(e).groupBy("flag", "taxed", "line").agg(F.count("*").alias("n"))


@_query(f"SELECT segment, count(*) AS n, round(sum(balance), 2) AS s FROM {_PEOPLE} GROUP BY segment")
def group_by_nested(e):
    return e.table("shop", "people").groupBy(F.col("address.segment").alias("segment")).agg(F.count("*").alias("n"), F.round(F.sum("balance"), 2).alias("s"))


@_query("SELECT CAST(0 AS BIGINT) AS zero, count(*) AS n FROM customer")
def group_signed_zero(e):
    return e.table("shop", "people").groupBy("zero").agg(F.count("*").alias("n"))


@_query(f"SELECT quantity, count(*) AS n FROM {_ITEMS} GROUP BY quantity")
def group_null_merge(e):
    return _items(e).groupBy("quantity").agg(F.count("*").alias("n"))


@_query(f"SELECT nation, segment, zip IS NULL AS z, count(*) AS n FROM {_PEOPLE} GROUP BY ALL")
def group_by_struct(e):
    a = F.col("address")
    return e.table("shop", "people").groupBy(F.when(a.isNotNull(), F.struct(a.nation.alias("nation"), a.segment.alias("segment"))).alias("a"), a.zip.isNull().alias("z")).agg(F.count("*").alias("n")).select("a.nation", "a.segment", "z", "n")


@_query(f"SELECT flag, count(*) AS n FROM {_ITEMS} WHERE quantity = 17 AND price > 1000 GROUP BY flag")
def agg_over_filter(e):
    return _items(e).filter("quantity = 17 AND price > 1000").groupBy("flag").agg(F.count("*").alias("n"))


@_query(f"SELECT flag, count(*) AS n FROM {_ITEMS} WHERE quantity BETWEEN 5 AND 25 GROUP BY flag")
def agg_over_bigint_range(e):
    return _items(e).filter("quantity BETWEEN 5 AND 25").groupBy("flag").agg(F.count("*").alias("n"))


@_query(f'SELECT "order", count(*) AS n FROM {_ITEMS} GROUP BY "order" HAVING count(*) > 4')
def having(e):
    return _items(e).groupBy("order").agg(F.count("*").alias("n")).filter("n > 4")


@_query(f'SELECT count(DISTINCT flag) AS f, count(DISTINCT quantity) AS q, CAST(sum(DISTINCT line) AS BIGINT) AS s FROM {_ITEMS}')
def count_distinct(e):
    return _items(e).agg(F.countDistinct("flag").alias("f"), F.countDistinct("quantity").alias("q"), F.sum_distinct("line").alias("s"))


@_query(f"SELECT line, count(*) FILTER (WHERE flag = 'R') AS r, CAST(sum(quantity) FILTER (WHERE taxed) AS BIGINT) AS s FROM {_ITEMS} GROUP BY line")
def agg_filter(e):
    _items(e).createOrReplaceTempView("items_for_filter")
    return e.spark.sql("SELECT line, count(*) FILTER (WHERE flag = 'R') AS r, sum(quantity) FILTER (WHERE taxed) AS s FROM items_for_filter GROUP BY line")


@_query(f'SELECT "order", string_agg(line, \',\' ORDER BY line DESC) AS lines FROM {_ITEMS} GROUP BY "order"')
def agg_ordered(e):
    return _items(e).groupBy("order").agg(F.array_join(F.transform(F.sort_array(F.collect_list("line"), False), lambda x: x.cast("string")), ",").alias("lines"))


_SETS = f"SELECT flag, taxed, count(*) AS n FROM {_ITEMS} GROUP BY "
_query(_SETS + "ROLLUP (flag, taxed)", "rollup")(lambda e: _items(e).rollup("flag", "taxed").agg(F.count("*").alias("n")))
_query(_SETS + "CUBE (flag, taxed)", "cube")(lambda e: _items(e).cube("flag", "taxed").agg(F.count("*").alias("n")))


@_query(_SETS + "GROUPING SETS ((flag), (taxed), ())")
def grouping_sets(e):
    return _items(e).groupingSets([["flag"], ["taxed"], []], "flag", "taxed").agg(F.count("*").alias("n"))


@_query(f"SELECT flag, round(sum(price * quantity), 2) AS s FROM {_ITEMS} GROUP BY flag")
def agg_expression(e):
    return _items(e).groupBy("flag").agg(F.round(F.sum(F.col("price") * F.col("quantity")), 2).alias("s"))


@_query(f"SELECT line, count_if(quantity > 25) AS c, bool_and(quantity > 0) AS b, any_value(line) AS v FROM {_ITEMS} GROUP BY line")
def agg_other(e):
    return _items(e).groupBy("line").agg(F.count_if(F.col("quantity") > 25).alias("c"), F.bool_and(F.col("quantity") > 0).alias("b"), F.any_value("line").alias("v"))


@_query(f"SELECT flag, count(*) AS n, min(flag) AS m, CAST(sum(quantity) AS BIGINT) AS s, round(sum(price), 2) AS p FROM {_ITEMS} GROUP BY flag")
def agg_mixed(e):
    return _items(e).groupBy("flag").agg(F.count("*").alias("n"), F.min("flag").alias("m"), F.sum("quantity").alias("s"), F.round(F.sum("price"), 2).alias("p"))


@_query("SELECT count(CASE WHEN o_orderkey % 5 <> 0 THEN 1 END) AS n, max(CASE WHEN o_orderkey % 5 <> 0 THEN CAST((o_orderkey * 7) || '.' || lpad((o_orderkey % 100)::VARCHAR, 2, '0') AS DECIMAL(12,2)) END) AS d, strftime(min(CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate END), '%Y-%m-%d') AS t, CAST(max(epoch(o_orderdate) - CASE WHEN o_orderkey % 2 = 0 THEN 19800 ELSE 0 END) AS BIGINT) AS z FROM orders")
def agg_min_max_declared(e):
    t = e.table("shop", "orders_declared", ["total", "placed", "seen"])
    return t.agg(F.count("total").alias("n"), F.max("total").alias("d"), F.date_format(F.min("placed"), "yyyy-MM-dd").alias("t"), F.unix_timestamp(F.max("seen")).alias("z"))


@_query("SELECT CASE WHEN o_orderkey % 4 = 0 THEN '18446744073709551615' ELSE o_orderkey::VARCHAR END AS big, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day, count(*) AS n FROM orders GROUP BY 1, 2")
def group_by_declared(e):
    t = e.table("shop", "orders_declared", ["big", "placed"]).groupBy("big", "placed").agg(F.count("*").alias("c"))
    return t.groupBy(F.col("big").cast("string").alias("big"), F.date_format("placed", "yyyy-MM-dd").alias("day")).agg(F.sum("c").alias("n"))


@_query("SELECT l_linenumber AS first, l_returnflag AS seen, count(*) AS n FROM (SELECT CAST(l_linenumber AS BIGINT) AS l_linenumber, l_returnflag FROM lineitem WHERE l_orderkey % 10 <> 1) x GROUP BY 1, 2")
def group_by_array(e):
    out = _items(e).filter("flag IS NOT NULL").groupBy("tags", "flag").agg(F.count("*").alias("n"))
    return out.select(F.get("tags", F.lit(0)).alias("first"), F.col("flag").alias("seen"), "n")


@_query(f"SELECT line, count(DISTINCT flag) AS f, count(DISTINCT taxed) AS t FROM {_ITEMS} GROUP BY line")
def agg_approx_distinct(e):
    """Exact at so few values; what approx_count_distinct gives beyond its precision is an estimate."""
    return _items(e).groupBy("line").agg(F.approx_count_distinct("flag").alias("f"), F.approx_count_distinct("taxed").alias("t"))


@_query(f"SELECT DISTINCT flag, taxed FROM {_ITEMS}")
def distinct_values(e):
    return _items(e).select("flag", "taxed").distinct()


# -- scalar functions over materialized columns


@_query("SELECT c_custkey AS id, upper(c_name) AS u, length(c_name) AS n, substring(c_name, 1, 4) AS s, replace(c_name, '#', '-') AS r, reverse(c_name) AS v, lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS p, concat(c_name, '/', c_custkey) AS c, position('#' IN c_name) AS i, split_part(c_name, '#', 1) AS h, regexp_extract(c_name, '[0-9]+') AS d FROM customer")
def scalar_string(e):
    name, id_ = F.col("name"), F.col("id").cast("string")
    return e.table("shop", "people").select("id", F.upper(name).alias("u"), F.length(name).cast("bigint").alias("n"), F.substring(name, 1, 4).alias("s"), F.replace(name, F.lit("#"), F.lit("-")).alias("r"), F.reverse(name).alias("v"), F.lpad(id_, 8, "0").alias("p"), F.concat(name, F.lit("/"), id_).alias("c"), F.instr(name, "#").cast("bigint").alias("i"), F.split_part(name, F.lit("#"), F.lit(1)).alias("h"), F.regexp_extract(name, "[0-9]+", 0).alias("d"))


@_query(f'SELECT "order", line, abs(quantity - 25) AS a, quantity % 7 AS m, floor(price) AS f, ceil(price) AS c, CAST(sign(quantity - 25) AS BIGINT) AS s, round(sqrt(price), 6) AS r, greatest(quantity, line) AS g, coalesce(quantity, -1) AS z, nullif(line, 1) AS y, CASE WHEN quantity > 25 THEN \'many\' WHEN quantity IS NULL THEN \'none\' ELSE \'few\' END AS w FROM {_ITEMS} WHERE quantity IS NOT NULL')
def scalar_math(e):
    q, p = F.col("quantity"), F.col("price")
    word = F.when(q > 25, "many").when(q.isNull(), "none").otherwise("few")
    return _items(e).filter("quantity IS NOT NULL").select("order", "line", F.abs(q - 25).alias("a"), (q % 7).alias("m"), F.floor(p).cast("double").alias("f"), F.ceil(p).cast("double").alias("c"), F.sign(q - 25).cast("bigint").alias("s"), F.round(F.sqrt(p), 6).alias("r"), F.greatest(q, "line").alias("g"), F.coalesce(q, F.lit(-1)).alias("z"), F.nullif("line", F.lit(1)).alias("y"), word.alias("w"))


@_query("SELECT o_orderkey AS id, year(o_orderdate) AS y, month(o_orderdate) AS m, day(o_orderdate) AS d, quarter(o_orderdate) AS q, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS t, strftime(o_orderdate + INTERVAL 30 DAY, '%Y-%m-%d') AS a, date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) AS n FROM orders WHERE o_orderkey % 3 <> 0")
def scalar_date(e):
    d, long = F.col("placed"), "bigint"
    parts = [f(d).cast(long).alias(a) for f, a in ((F.year, "y"), (F.month, "m"), (F.day, "d"), (F.quarter, "q"))]
    days = F.date_diff(F.to_date(d), F.to_date(F.lit("1992-01-01"))).cast(long)
    return e.table("shop", "orders_declared").filter("placed IS NOT NULL").select("id", *parts, F.date_format(F.date_trunc("month", d), "yyyy-MM-dd").alias("t"), F.date_format(d + F.expr("INTERVAL 30 DAYS"), "yyyy-MM-dd").alias("a"), days.alias("n"))


@_query('SELECT l_orderkey AS "order", CAST(l_linenumber AS BIGINT) AS line, CAST(3 * l_linenumber AS BIGINT) AS s, CAST(2 * l_linenumber AS BIGINT) AS m, CAST(2 AS BIGINT) AS n, true AS h, CAST(l_linenumber * 10 AS BIGINT) AS t FROM lineitem')
def scalar_array(e):
    known = F.filter("tags", lambda x: x.isNotNull())
    total = F.aggregate(known, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return _items(e).select("order", "line", total.alias("s"), F.array_max("tags").alias("m"), F.size(known).cast("bigint").alias("n"), F.array_contains(known, F.col("line")).alias("h"), F.get(F.transform("tags", lambda x: x * 10), F.lit(0)).alias("t"))


@_query(f'SELECT "order", line, quantity AS q, CAST(line * 2 AS BIGINT) AS double_, CAST(2 AS BIGINT) AS n, quantity IS NULL AS lacks, flag AS f FROM {_ITEMS}')
def scalar_map(e):
    m = F.create_map(F.lit("line"), F.col("line"), F.lit("quantity"), F.col("quantity"))
    doubled = F.transform_values(m, lambda _, v: v * 2)
    kept = F.map_filter(m, lambda _, v: v.isNotNull())
    names = F.map_from_entries(F.array(F.struct(F.lit("f"), F.col("flag"))))
    return _items(e).select("order", "line", F.element_at(m, "quantity").alias("q"), F.element_at(doubled, "line").alias("double_"), F.size(F.map_keys(m)).cast("bigint").alias("n"), (~F.map_contains_key(kept, "quantity")).alias("lacks"), F.element_at(names, "f").alias("f"))


@_query(f"""SELECT id, segment AS s, CASE WHEN nation IS NULL THEN NULL ELSE '{{"nation":' || nation || '}}' END AS j, nation AS n, CAST(json_extract(CASE WHEN nation IS NULL THEN '[]' ELSE '[' || nation || ',7]' END, '$[1]') AS BIGINT) AS second FROM {_PEOPLE}""")
def scalar_json(e):
    nation, text = F.col("address.nation"), F.to_json("address")
    one = F.when(nation.isNotNull(), F.to_json(F.struct(nation.alias("nation"))))
    listed = F.when(nation.isNull(), F.lit("[]")).otherwise(F.to_json(F.array(nation, F.lit(7).cast("bigint"))))
    return e.table("shop", "people").select("id", F.get_json_object(text, "$.segment").alias("s"), one.alias("j"), F.from_json(text, "nation bigint")["nation"].alias("n"), F.get(F.from_json(listed, "array<bigint>"), F.lit(1)).alias("second"))


_FORMS = ["Z", "a", "e\u0301", "\u00e9", "\u00c9", "soft\u00adhyphen", "softhyphen", "\ufffd", "\U0001f600", "z", "Straße", "STRASSE", "a", "\u00e9"]
_NAMED = "(SELECT * FROM (VALUES " + ", ".join(f"({k}, '{n}')" for k, n in enumerate(_FORMS)) + ") t(k, name)) t"


def _forms(e) -> DataFrame:
    rows = [(k, f'{{"name":"{n}"}}') for k, n in enumerate(_FORMS)]
    return e.register("shop", "forms", e.spark.createDataFrame(rows, "k int, json string"), json="json", order="k").table("shop", "forms")


@_query(f"SELECT name, count(*) AS n, count(*) FILTER (WHERE name = '\u00e9') AS composed, count(*) FILTER (WHERE name = 'softhyphen') AS soft FROM {_NAMED} GROUP BY name")
def text_byte_exact(e):
    return _forms(e).groupBy("name").agg(F.count("*").alias("n"), F.count_if(F.col("name") == "\u00e9").alias("composed"), F.count_if(F.col("name") == "softhyphen").alias("soft"))


@_query(f"SELECT name, name > 'z' AS after, name < '\ufffd' AS before, rank() OVER (ORDER BY name) AS r FROM (SELECT DISTINCT name FROM {_NAMED}) d")
def text_code_point_order(e):
    t = _forms(e).distinct()
    return t.select("name", (F.col("name") > "z").alias("after"), (F.col("name") < "\ufffd").alias("before"), F.rank().over(Window.orderBy("name")).cast("bigint").alias("r"))


# -- sort, limit, set operations


@_query(f'SELECT "order", line, price FROM {_ITEMS} ORDER BY price DESC NULLS LAST, "order", line LIMIT 20')
def order_topk(e):
    return _items(e).orderBy(F.desc_nulls_last("price"), "order", "line").select("order", "line", "price").limit(20)


@_query(f'SELECT "order", line FROM {_ITEMS} ORDER BY "order", line LIMIT 10 OFFSET 30')
def order_offset(e):
    return _items(e).orderBy("order", "line").select("order", "line").offset(30).limit(10)


@_query("SELECT 7 AS n")
def limit_scan(e):
    return _items(e).filter("line = 1").limit(7).agg(F.count("*").cast("int").alias("n"))


@_query(f"SELECT line, count(*) AS n FROM {_ITEMS} GROUP BY line ORDER BY line LIMIT 3")
def limit_after_group(e):
    return _items(e).groupBy("line").agg(F.count("*").alias("n")).orderBy("line").limit(3)


@_query(f'SELECT * FROM (SELECT "order", line, quantity FROM {_ITEMS} ORDER BY "order", line, quantity NULLS FIRST LIMIT 50) x WHERE quantity > 10')
def limit_then_filter(e):
    return _items(e).orderBy("order", "line", "quantity").limit(50).filter("quantity > 10").select("order", "line", "quantity")


@_query("SELECT 2 AS n")
def limit_tightest(e):
    return _items(e).limit(5).limit(2).limit(9).agg(F.count("*").cast("int").alias("n"))


@_query(f"SELECT count(*) AS n FROM (SELECT DISTINCT line FROM {_ITEMS} LIMIT 4) x")
def distinct_limit(e):
    return _items(e).select("line").distinct().limit(4).agg(F.count("*").alias("n"))


def _sets(e):
    a = _items(e).filter("quantity > 20").select("flag", "line")
    return a, _items(e).filter("quantity <= 20 AND line <= 4").select("flag", "line")


_A, _B = f"SELECT flag, line FROM {_ITEMS} WHERE quantity > 20", f"SELECT flag, line FROM {_ITEMS} WHERE quantity <= 20 AND line <= 4"
for _name, _sql, _f in (
    ("set_union_all", "UNION ALL", lambda a, b: a.unionByName(b)),
    ("set_union", "UNION", lambda a, b: a.unionByName(b).distinct()),
    ("set_intersect", "INTERSECT", lambda a, b: a.intersect(b)),
    ("set_intersect_all", "INTERSECT ALL", lambda a, b: a.intersectAll(b)),
    ("set_except", "EXCEPT", lambda a, b: a.subtract(b)),
    ("set_except_all", "EXCEPT ALL", lambda a, b: a.exceptAll(b)),
):
    _query(f"{_A} {_sql} {_B}", _name)(lambda e, f=_f: f(*_sets(e)))


# -- joins and windows


def _join(key: str, how: str, sql: str):
    """All sales and all people; half of the people have no zip, a null key that matches nothing on either side."""

    def f(e):
        s, p = e.table("shop", "sales").select("id", "customer", "total"), e.table("shop", "people").select(F.col("address.zip").alias("pid"), "name")
        out = s.join(p, s.customer == p.pid, how)
        return out.select("id", "total", "name") if how in ("inner", "left", "right", "full") else out.select("id", "total")

    _query(f"WITH a AS (SELECT id, customer, total FROM {_SALES}), b AS (SELECT zip AS pid, name FROM {_PEOPLE}) {sql}", key)(f)


for _how in ("inner", "left", "right", "full"):
    _join(f"join_{_how}", _how, f"SELECT id, total, name FROM a {_how.upper()} JOIN b ON customer = pid")
_join("join_semi", "left_semi", "SELECT id, total FROM a WHERE EXISTS (SELECT 1 FROM b WHERE pid = customer)")
_join("join_anti", "left_anti", "SELECT id, total FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE pid = customer)")


@_query(f"SELECT count(*) AS n FROM {_PLACES}, {_EDGES}")
def join_cross(e):
    return e.table("shop", "places").crossJoin(e.table("shop", "lies_in")).agg(F.count("*").alias("n"))


@_query(f"SELECT a._from AS x, b._from AS y FROM {_EDGES.removesuffix(' e')} a JOIN {_EDGES.removesuffix(' e')} b ON a.since < b.since AND b.since <= a.since + 3")
def join_range(e):
    a, b = (e.table("shop", "lies_in").select(F.col("_from").alias(x), F.col("since").alias(f"s{x}")) for x in ("x", "y"))
    return a.join(b, (F.col("sx") < F.col("sy")) & (F.col("sy") <= F.col("sx") + 3)).select("x", "y")


@_query(f"SELECT v.name AS source, w.name AS target, since FROM {_EDGES} JOIN {_PLACES} ON e._from = v._id JOIN {_PLACES.removesuffix(' v')} w ON e._to = w._id")
def join_vertex_edge(e):
    v = e.table("shop", "places", ["_id", "name"])
    a, b = v.select(F.col("_id").alias("_from"), F.col("name").alias("source")), v.select(F.col("_id").alias("_to"), F.col("name").alias("target"))
    return e.table("shop", "lies_in").join(a, "_from").join(b, "_to").select("source", "target", "since")


#: Orders the lines of an order; lines that tie in all of these look the same.
_LINES = ("line", "price", "quantity", "flag")


def _orders(e: Engine) -> DataFrame:
    """The lines, those of an order together."""
    return dealt(_items(e).select("order", *_LINES), "order")


@_query(f'SELECT "order", line, row_number() OVER w AS r, rank() OVER v AS k, dense_rank() OVER v AS d, lag(line) OVER w AS p FROM {_ITEMS} WINDOW w AS (PARTITION BY "order" ORDER BY line, price NULLS FIRST, quantity NULLS FIRST, flag NULLS FIRST), v AS (PARTITION BY "order" ORDER BY flag NULLS FIRST)')
def window_rank(e):
    w, v = Window.partitionBy("order").orderBy(*_LINES), Window.partitionBy("order").orderBy(F.asc_nulls_first("flag"))
    return _orders(e).select("order", "line", F.row_number().over(w).alias("r"), F.rank().over(v).alias("k"), F.dense_rank().over(v).alias("d"), F.lag("line").over(w).alias("p"))


@_query(f'SELECT "order", line, CAST(sum(quantity) OVER (PARTITION BY "order" ORDER BY line, price NULLS FIRST, quantity NULLS FIRST, flag NULLS FIRST ROWS UNBOUNDED PRECEDING) AS BIGINT) AS s, max(quantity) OVER (PARTITION BY "order" ORDER BY line, price NULLS FIRST, quantity NULLS FIRST, flag NULLS FIRST ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS m, count(*) OVER (PARTITION BY "order" ORDER BY line RANGE BETWEEN 2 PRECEDING AND CURRENT ROW) AS c FROM {_ITEMS}')
def window_running_sum(e):
    w, by_line = Window.partitionBy("order").orderBy(*_LINES), Window.partitionBy("order").orderBy("line")
    return _orders(e).select("order", "line", F.sum("quantity").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"), F.max("quantity").over(w.rowsBetween(-1, 1)).alias("m"), F.count("*").over(by_line.rangeBetween(-2, 0)).alias("c"))


@_query(f'SELECT "order", line, ntile(2) OVER w AS t, round(percent_rank() OVER w, 9) AS p, round(cume_dist() OVER w, 9) AS c, first_value(line) OVER w AS f, lead(line, 1) OVER w AS l FROM {_ITEMS} WINDOW w AS (PARTITION BY "order" ORDER BY line, price NULLS FIRST, quantity NULLS FIRST, flag NULLS FIRST)')
def window_distribution(e):
    w = Window.partitionBy("order").orderBy(*_LINES)
    return _orders(e).select("order", "line", F.ntile(2).over(w).alias("t"), F.round(F.percent_rank().over(w), 9).alias("p"), F.round(F.cume_dist().over(w), 9).alias("c"), F.first("line").over(w).alias("f"), F.lead("line", 1).over(w).alias("l"))


# -- declared types


@_query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST((o_orderkey * 7) || '.' || lpad((o_orderkey % 100)::VARCHAR, 2, '0') AS DECIMAL(12,2)) END AS total FROM orders")
def decimal_declared(e):
    return e.table("shop", "orders_declared", ["id", "total"])


@_query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 = 0 THEN '18446744073709551615' ELSE o_orderkey::VARCHAR END AS big FROM orders")
def decimal_uint64(e):
    return e.table("shop", "orders_declared", ["id", "big"]).select("id", F.col("big").cast("string").alias("big"))


@_query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '.250' END AS placed FROM orders")
def ts_declared(e):
    return e.table("shop", "orders_declared", ["id", "placed"]).select("id", F.date_format("placed", "yyyy-MM-dd HH:mm:ss.SSS").alias("placed"))


@_query("SELECT o_orderkey AS id, CAST(epoch(o_orderdate) AS BIGINT) - CASE WHEN o_orderkey % 2 = 0 THEN 19800 ELSE 0 END AS seconds, CASE WHEN o_orderkey % 2 = 0 THEN 330 ELSE 0 END AS minutes FROM orders")
def tstz_instant(e):
    return e.table("shop", "orders_declared", ["id", "seen", "seen__offset_minutes"]).select("id", F.unix_timestamp("seen").alias("seconds"), F.col("seen__offset_minutes").alias("minutes"))


@_query("SELECT * FROM (VALUES ('id','bigint',false),('total','decimal(12,2)',false),('placed','timestamp_ntz',false),('seen','timestamp',false),('big','decimal(38,0)',false),('note','string',true),('misspelled','string',false),('_key','string',true),('_id','string',true),('_rev','string',true)) t(name, type, hidden)")
def override_schema(e):
    return e.spark.createDataFrame([(c.name, c.type.simpleString(), c.hidden) for c in e.describe("shop", "orders_declared")], "name string, type string, hidden boolean")


@_query("SELECT o_orderkey AS id, CAST(NULL AS VARCHAR) AS misspelled, 'secret' AS note FROM orders")
def override_misspelled(e):
    return e.table("shop", "orders_declared", ["id", "misspelled", "note"])


# -- strict mode: columns that fit read as ever, and dirty columns that a query does not read do no harm

_STRICT = EngineConfig(type_coercion="STRICT")


@_query(f'SELECT "order", count(*) AS n, max(line) AS m FROM {_ITEMS} GROUP BY "order"', config=_STRICT)
def strict_clean_columns(e):
    return e.table("shop", "items").groupBy("order").agg(F.count("*").alias("n"), F.max("line").alias("m"))


@_query(f"SELECT * FROM {_SALES} WHERE total > 1000", config=_STRICT)
def strict_scan(e):
    return e.table("shop", "sales").filter("total > 1000")


@_query(f'SELECT line, count(*) AS n FROM {_ITEMS} GROUP BY line', config=_STRICT)
def strict_passthrough(e):
    return e.query("shop", "SELECT line, count(*) AS n FROM items GROUP BY line")


@_query(f"SELECT status, max(id) AS m FROM {_SALES} GROUP BY status", config=_STRICT)
def strict_passthrough_documents(e):
    return e.query("shop", "SELECT doc FROM sales").groupBy("status").agg(F.max("id").alias("m"))


# -- streaming


@_query(f"SELECT id, status, total FROM {_SALES}")
def stream_typed(e):
    """All stored sales as a stream that ends with what is there, written by micro-batches and read back."""
    stored, folder = e.databases["shop"]["sales"].documents(), f"{shared_folder(e.spark)}/stream-{uuid.uuid4().hex}"
    files = stored.inputFiles()[0].rpartition("/")[0]
    fields = {c.name: c.type for c in e.describe("shop", "sales") if c.name in ("id", "status", "total")}
    stream = typed_stream(e.spark.readStream.schema(stored.schema).parquet(files), fields)
    q = stream.writeStream.format("parquet").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start(f"{folder}/out")
    q.awaitTermination()
    return e.spark.read.schema(stream.schema).parquet(f"{folder}/out")


# -- passthrough, traversal, statistics


@_query(f"SELECT flag, count(*) AS n, CAST(sum(quantity) AS BIGINT) AS s FROM {_ITEMS} WHERE line IN (SELECT line FROM {_ITEMS} WHERE quantity = 50) GROUP BY flag")
def passthrough_agg(e):
    return e.query("shop", "WITH full_ AS (SELECT line FROM items WHERE quantity = 50) SELECT flag, count(*) AS n, sum(quantity) AS s FROM items WHERE line IN (SELECT line FROM full_) GROUP BY flag")


@_query(f"SELECT status, max(id) AS m FROM {_SALES} GROUP BY status")
def passthrough_documents(e):
    return e.query("shop", "SELECT doc FROM sales").groupBy("status").agg(F.max("id").alias("m"))


_STEP = f"SELECT r.start, e._to AS vertex, r.depth + 1 AS depth, r.used || '|' || e._key || '|' AS used FROM reach r JOIN {_EDGES} ON e._from = r.vertex AND NOT contains(r.used, '|' || e._key || '|') WHERE r.depth < "


@_query(f"WITH RECURSIVE reach(start, vertex, depth, used) AS (SELECT 'places/n' || n_nationkey, 'places/n' || n_nationkey, 0, '' FROM nation UNION ALL {_STEP} 3) SELECT start, vertex, depth FROM reach WHERE depth >= 1")
def traverse_1_3_out(e):
    starts = e.table("shop", "places", ["_id"]).filter("_id LIKE 'places/n%'")
    return traverse(e.table("shop", "lies_in", ["_key", "_from", "_to"]), starts, "_id", 1, 3).select("start", "vertex", "depth")


@_query(f"WITH RECURSIVE reach(start, vertex, depth, used) AS (SELECT _id, _id, 0, '' FROM {_PLACES} UNION ALL {_STEP} 4) SELECT start, vertex, min(depth) AS depth FROM reach GROUP BY 1, 2")
def neighbors_4_out(e):
    return neighbors(e.table("shop", "lies_in"), e.table("shop", "places", ["_id"]), "_id", 4)


@_query(f"SELECT e._to AS start, e._from AS vertex, since FROM {_EDGES} WHERE e._to LIKE 'places/r%'")
def traverse_1_inbound(e):
    edges = e.table("shop", "lies_in", ["_key", "_from", "_to", "since"])
    starts = e.table("shop", "places", ["_id"]).filter("_id LIKE 'places/r%'")
    found = traverse(edges, starts, "_id", 1, 1, "inbound").select("start", "vertex")
    return found.join(edges.select(F.col("_from").alias("vertex"), F.col("_to").alias("start"), "since"), ["start", "vertex"]).select("start", "vertex", "since")


_BOTH = f"(SELECT _from AS a, _to AS b, _key FROM {_EDGES.removesuffix(' e')} x UNION ALL SELECT _to, _from, _key FROM {_EDGES.removesuffix(' e')} y)"


@_query(f"SELECT p.a AS start, q.b AS vertex, CAST(2 AS INTEGER) AS depth FROM {_BOTH} p JOIN {_BOTH} q ON p.b = q.a AND p._key <> q._key WHERE p.a LIKE 'places/n%'")
def traverse_2_any(e):
    starts = e.table("shop", "places", ["_id"]).filter("_id LIKE 'places/n%'")
    return traverse(e.table("shop", "lies_in", ["_key", "_from", "_to"]), starts, "_id", 2, 2, "any").select("start", "vertex", "depth")


_WALK = f"SELECT r.start, e._to AS vertex, r.depth + 1 AS depth, list_append(r.path, e._to) AS path FROM reach r JOIN {_EDGES} ON e._from = r.vertex AND NOT list_contains(r.path, e._to) WHERE r.depth < 6"


@_query(f"WITH RECURSIVE reach(start, vertex, depth, path) AS (SELECT _id, _id, 0, [_id] FROM {_PLACES} UNION ALL {_WALK}) SELECT start, min(depth) AS depth, array_to_string(min({{'d': depth, 'p': path}}).p, ' > ') AS path FROM reach WHERE vertex = 'places/n1' GROUP BY start")
def shortest_path(e):
    found = shortest_paths(e.table("shop", "lies_in"), e.table("shop", "places", ["_id"]), "_id", "places/n1", 6)
    return found.select("start", "depth", F.array_join("path", " > ").alias("path"))


_TWICE = f"(SELECT _from, _to FROM {_EDGES} UNION ALL SELECT _from, _to FROM {_EDGES})"


@_query(f"SELECT p._from AS start, q._to AS vertex, count(*) AS n FROM {_TWICE} p JOIN {_TWICE} q ON p._to = q._from GROUP BY 1, 2")
def traverse_parallel(e):
    """Every edge twice and without a key; no two successive edges of these are the same, so all combinations are paths."""
    edges = e.table("shop", "lies_in", ["_from", "_to"])
    return traverse(edges.unionByName(edges), e.table("shop", "places", ["_id"]), "_id", 2, 2).groupBy("start", "vertex").agg(F.count("*").alias("n"))


@_query(f"WITH RECURSIVE reach(v, d) AS (SELECT 'places/n1', 0 UNION ALL SELECT e._to, reach.d + 1 FROM reach JOIN {_EDGES} ON e._from = reach.v WHERE reach.d < 3) SELECT v, d FROM reach")
def passthrough_traversal(e):
    return e.query("shop", "WITH RECURSIVE reach(v, d) AS (SELECT 'places/n1', 0 UNION ALL SELECT l._to, reach.d + 1 FROM reach JOIN lies_in l ON l._from = reach.v WHERE reach.d < 3) SELECT v, d FROM reach")


@_query("SELECT count(*) AS items, CAST(1 AS BIGINT) AS global_, CAST(NULL AS BIGINT) AS grouped, CAST(9 AS BIGINT) AS grouped_limit FROM lineitem")
def statistics(e):
    rows = [(e.statistics("shop", "items"), e.statistics("shop", "items", grouped=False), e.statistics("shop", "items", grouped=True), e.statistics("shop", "items", grouped=True, limit=9))]
    return e.spark.createDataFrame(rows, "items long, global_ long, grouped long, grouped_limit long")
