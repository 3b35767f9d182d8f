import pytest
from pyspark.sql import functions as F

from tessera import Engine, EngineConfig
from tessera.errors import InvalidArgumentError, NotFoundError, NotReadOnlyError, SchemaError, UnsupportedError
from tessera.operators import graph_edges, neighbors, shortest_paths, traverse
from tessera.plans.partitions import Sharding, counts_agree, eligible, group_shards, obstacle
from tessera.sources.cache import TtlCache
from tessera.sources.overrides import read_override


def docs(spark, *texts):
    return spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, json string")


def shop(spark, config=None, **collections):
    e = Engine(spark, config or EngineConfig())
    for name, texts in collections.items():
        e.register("shop", name, docs(spark, *texts), json="json", order="k", edge=name == "knows")
    return e


USERS = ['{"_key":"1","_id":"users/ada","name":"ada","age":36}', '{"_key":"2","_id":"users/bob","name":"bob","age":41}']


def test_listing_and_lookup(spark):
    e = shop(spark, users=USERS, _graphs=["{}"]).create_database("empty")
    assert e.list_schemas() == ["empty", "shop"] and e.list_tables() == [("shop", "users")] and e.list_tables("nowhere") == []
    assert e.find("shop", "_graphs") is None and e.find("shop", "none") is None
    with pytest.raises(NotFoundError):
        e.table("nowhere", "users")
    with pytest.raises(NotFoundError):
        e.table("shop", "none")
    with pytest.raises(UnsupportedError):
        e.table("shop", "users", version=3)


def test_hidden_and_edge_columns(spark):
    e = shop(spark, users=USERS, knows=['{"_from":"users/ada","_to":"users/bob","since":2020}'], none=[])
    assert e.table("shop", "users").columns == ["name", "age"]
    assert e.table("shop", "users", hidden=True).columns == ["name", "age", "_key", "_id", "_rev"]
    assert [r[0] for r in e.table("shop", "users", ["_id"]).orderBy("_id").collect()] == ["users/ada", "users/bob"]
    assert e.table("shop", "knows").columns == ["since", "_from", "_to"]
    assert [(c.name, c.hidden) for c in e.describe("shop", "none")] == [("_key", True), ("_id", True), ("_rev", True)]
    assert e.table("shop", "users").schema["name"].metadata == {"hidden": False, "path": ["name"]}
    with pytest.raises(NotFoundError):
        e.table("shop", "users", ["nme"])


def test_views(spark):
    e = shop(spark, users=USERS, schema_overrides=['{"table":"broken","fields":[{"name":"x","type":"nope"}]}'], broken=['{"x":1}'])
    assert e.views("shop") == ["schema_overrides", "users"]
    assert spark.sql("SELECT * FROM users").columns == ["name", "age"] and "_key" in spark.sql("SELECT * FROM users__all").columns
    with pytest.raises(SchemaError):
        e.table("shop", "broken")


def test_sample_size_decides_the_schema(spark):
    skewed = ['{"val":10}', '{"val":20}', '{"val":"not-a-number"}', '{"val":42.5}']
    t = shop(spark, EngineConfig(schema_sample_size=2), skewed=skewed).table("shop", "skewed")
    assert sorted(r[0] for r in t.filter("val > 5").collect()) == [10, 20] == sorted(r[0] for r in t.filter("val IS NOT NULL").collect())
    assert shop(spark, skewed=skewed).table("shop", "skewed").schema["val"].dataType.simpleString() == "string"
    r = shop(spark, EngineConfig(schema_sample_random=True), skewed=skewed).table("shop", "skewed")
    assert r.schema["val"].dataType.simpleString() == "string"


def test_text_columns_do_not_show_numbers(spark):
    t = shop(spark, mixed=['{"code":42,"label":"num"}', '{"code":"42","label":"str"}']).table("shop", "mixed")
    assert [r["label"] for r in t.filter("code = '42'").collect()] == ["str"]


def test_strict_mode_raises_even_behind_a_filter(spark):
    texts = ['{"n":1,"id":1}', '{"n":2,"id":2}', '{"n":"x","id":3}']
    e = shop(spark, EngineConfig(type_coercion="STRICT", schema_sample_size=2), c=texts)
    for query in (e.table("shop", "c").filter("id < 0"), e.table("shop", "c").filter("n > 5").select("n"), e.table("shop", "c").select("n").distinct(), e.table("shop", "c").groupBy("id").agg(F.max("n"))):
        with pytest.raises(Exception, match=r"TYPE_CONVERSION_ERROR.*n: x"):
            query.collect()
    assert e.table("shop", "c", ["id"]).count() == 3 == e.table("shop", "c").count()
    assert sorted(r[0] for r in e.table("shop", "c").select("id").collect()) == [1, 2, 3]
    assert e.table("shop", "c").limit(2).select("n").count() == 2
    nested = shop(spark, EngineConfig(type_coercion="STRICT", schema_sample_size=1), c=['{"a":[{"b":1}]}', '{"a":[{"b":1},{"b":true}]}'])
    with pytest.raises(Exception, match=r"a\[1\]\.b: true"):
        nested.table("shop", "c").collect()


def test_strict_mode_through_the_passthrough(spark):
    texts = ['{"n":1,"id":1}', '{"n":2,"id":2}', '{"n":"x","id":3}']
    strict = lambda: shop(spark, EngineConfig(type_coercion="STRICT", schema_sample_size=2), c=texts)
    assert [r[0] for r in strict().query("shop", "SELECT id FROM c ORDER BY id").collect()] == [1, 2, 3]
    for q in ("SELECT n FROM c", "SELECT id FROM c WHERE n = 1", "SELECT max(n) FROM c", "SELECT doc FROM c"):
        with pytest.raises(Exception, match=r"TYPE_CONVERSION_ERROR.*n: x"):
            strict().query("shop", q).collect()
    lenient = shop(spark, EngineConfig(schema_sample_size=2), c=texts)
    assert sorted(map(str, (r["n"] for r in lenient.query("shop", "SELECT doc FROM c").collect()))) == ["1", "2", "None"]


def test_the_passthrough_leaves_the_users_views_alone(spark):
    spark.sql("SELECT 'mine' AS x").createOrReplaceTempView("users")
    e = shop(spark, users=USERS, others=USERS)
    out = e.query("shop", "SELECT u.name FROM users u JOIN others o ON u.age = o.age WHERE u.age > 40")
    assert [r[0] for r in spark.table("users").collect()] == ["mine"] and not spark.catalog.tableExists("others")
    assert [r[0] for r in out.collect()] == ["bob"]
    with pytest.raises(InvalidArgumentError):
        e.query("shop", "SELECT nme FROM users")
    assert [r[0] for r in spark.table("users").collect()] == ["mine"]
    spark.catalog.dropTempView("users")


def test_search_views_and_recursion_in_query_text(spark):
    e = shop(spark, users=USERS, knows=['{"_from":"users/ada","_to":"users/bob"}', '{"_from":"users/bob","_to":"users/eve"}']).register_search_view("shop", "people_search")
    with pytest.raises(UnsupportedError, match="search view"):
        e.query("shop", "SELECT * FROM people_search")
    reach = "WITH RECURSIVE r(v, d) AS (SELECT 'users/ada', 0 UNION ALL SELECT k._to, r.d + 1 FROM r JOIN knows k ON k._from = r.v WHERE r.d < 3) SELECT v, d FROM r WHERE d > 0"
    assert sorted(tuple(r) for r in e.query("shop", reach).collect()) == [("users/bob", 1), ("users/eve", 2)]


def test_sums_that_overflow_are_errors(spark):
    e = shop(spark, c=['{"n":9223372036854775807}', '{"n":1}'])
    with pytest.raises(Exception, match="ARITHMETIC_OVERFLOW|overflow"):
        e.table("shop", "c").agg(F.sum("n")).collect()


def test_names_that_differ_in_case(spark):
    e = shop(spark, c=['{"Name":1,"name":2}'])
    with pytest.raises(SchemaError):
        e.describe("shop", "c")
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        assert shop(spark, c=['{"Name":1,"name":2}']).table("shop", "c").collect()[0] == (1, 2)
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_overrides(spark):
    e = shop(spark, invoices=['{"total":"12.34","note":"s","extra":1}'], schema_overrides=['{"table":"invoices","fields":[{"name":"total","type":"decimal(12,2)"},{"name":"note","type":"varchar","hidden":true},{"name":"misspelled","type":"varchar"}]}'])
    assert [str(x) for x in e.table("shop", "invoices").collect()[0]] == ["12.34", "None"]
    assert e.table("shop", "invoices", ["note"]).collect()[0][0] == "s"
    assert ("shop", "schema_overrides") in e.list_tables()


FIELD = {"name": "x", "type": "bigint"}


@pytest.mark.parametrize("doc", [
    {"table": "t"}, {"table": "t", "fields": []}, {"table": "t", "fields": {}}, {"table": "t", "fields": [1]}, {"table": "t", "fields": [FIELD], "other": 1}, {"table": "t", "fields": [FIELD | {"path": "a"}]},
    {"table": "t", "fields": [{"type": "bigint"}]}, {"table": "t", "fields": [{"name": "", "type": "bigint"}]}, {"table": "t", "fields": [{"name": 1, "type": "bigint"}]}, {"table": "t", "fields": [{"name": "_x", "type": "bigint"}]},
    {"table": "t", "fields": [FIELD, {"name": "X", "type": "double"}]}, {"table": "t", "fields": [{"name": "x"}]}, {"table": "t", "fields": [{"name": "x", "type": 1}]}, {"table": "t", "fields": [{"name": "x", "type": "int"}]},
    {"table": "t", "fields": [FIELD | {"hidden": None}]}, {"table": "t", "fields": [FIELD | {"hidden": "yes"}]},
])
def test_bad_overrides(doc):
    with pytest.raises(SchemaError):
        read_override([doc], "t")


def test_override_counts():
    good = {"table": "t", "_key": "1", "fields": [FIELD]}
    assert read_override([], "t") is None and read_override([good], "t")[0].name == "x"
    with pytest.raises(SchemaError):
        read_override([good, good], "t")


def test_caches_expire_and_keep_no_failures(spark):
    now, calls = [0.0], []
    c = TtlCache(10, lambda: now[0])
    load = lambda: calls.append(1) or len(calls)
    assert [c.get("a", load), c.get("a", load)] == [1, 1]
    now[0] = 10
    assert c.get("a", load) == 2
    with pytest.raises(ZeroDivisionError):
        c.get("b", lambda: 1 / 0)
    assert c.get("b", load) == 3
    assert TtlCache(0).get("a", load) == 4 and len(calls) == 4


def test_groups_of_shards():
    for n in range(1, 41):
        for per in range(1, 7):
            for most in range(1, 13):
                shards = [str(k) for k in range(n)]
                groups = group_shards(shards, per, most)
                assert [s for g in groups for s in g] == shards and len(groups) == min(-(-n // per), most)
                assert max(map(len, groups)) - min(map(len, groups)) <= 1
    assert group_shards([], 1, 1) == [[]]
    assert counts_agree(5, [2, 3]) and not counts_agree(5, [5, 5]) and not counts_agree(5, [5])


def test_eligibility():
    two = ("a", "b")
    assert eligible(Sharding(two)) and eligible(Sharding(two, "community-compat"))
    assert not any(map(eligible, (None, Sharding(("a",)), Sharding(two, None), Sharding(two, "other"), Sharding(two, "hash", "attr"))))
    assert "not known" in obstacle(None) and "1 shards" in obstacle(Sharding(("a",))) and "other" in obstacle(Sharding(two, "other")) and "attr" in obstacle(Sharding(two, "hash", "attr"))


def test_splits_cover_a_collection_once(spark):
    rows = spark.range(1000).select(F.concat(F.lit('{"v":'), F.col("id"), F.lit("}")).alias("json"), (F.col("id") % 3).cast("string").alias("shard"))
    e = Engine(spark).register("shop", "c", rows, json="json", shard="shard", sharding=Sharding(("0", "1", "2")))
    groups = e.splits("shop", "c")
    assert len(groups) == 3 and e.splits("shop", "c", aggregated=True) == [[]]
    got = [r[0] for g in groups for r in e.scan_split("shop", "c", g).collect()]
    assert sorted(got) == list(range(1000))
    wrong = Engine(spark).register("shop", "c", rows, json="json", shard="shard", sharding=Sharding(("0", "1")))
    assert wrong.splits("shop", "c") == [[]] and "add up" in wrong.obstacle("shop", "c") and e.obstacle("shop", "c") is None
    off = Engine(spark, EngineConfig(shard_parallelism_enabled=False)).register("shop", "c", rows, json="json", shard="shard", sharding=Sharding(("0", "1", "2")))
    assert off.splits("shop", "c") == [[]] and off.scan_split("shop", "c", []).count() == 1000


def test_statistics(spark):
    e = shop(spark, users=USERS)
    assert e.statistics("shop", "users") == 2 == e.statistics("shop", "users", limit=1) and e.statistics("shop", "users", passthrough=True) is None
    assert (e.statistics("shop", "users", grouped=False), e.statistics("shop", "users", grouped=True), e.statistics("shop", "users", grouped=True, limit=4)) == (1, None, 4)
    assert shop(spark, EngineConfig(shard_parallelism_enabled=False), users=USERS).statistics("shop", "users", limit=1) == 1
    assert shop(spark, EngineConfig(statistics_enabled=False), users=USERS).statistics("shop", "users") is None
    assert e.statistics("shop", "none") is None
    calls = []
    e.register("shop", "counted", docs(spark, "{}"), json="json", rows=lambda: calls.append(1) or 77)
    assert e.statistics("shop", "counted") == 77 == e.statistics("shop", "counted") and len(calls) == 1


@pytest.mark.parametrize("text", [
    "INSERT INTO users SELECT 'x', 1", "DROP TABLE users", "CREATE TABLE t AS SELECT * FROM users", "WITH a AS (SELECT 1) INSERT INTO users SELECT * FROM a", "SET x = 1", "CACHE TABLE users", "DELETE FROM users", "UPDATE users SET age = 1",
    "MERGE INTO users u USING users v ON u.age = v.age WHEN MATCHED THEN DELETE", "SELECT reflect('java.lang.System', 'exit', 1)", "SELECT * FROM users WHERE age IN (SELECT java_method('a.B', 'c'))", "SELECT * FROM parquet.`/etc`", "SELECT * FROM _graphs", "SELECT no_such_function(age) FROM users",
    "SELECT * FROM range(5)", "SHOW TABLES", "FROM users INSERT INTO users SELECT name, age", "TRUNCATE TABLE users", "EXPLAIN SELECT * FROM users",
])
def test_the_gate_refuses(spark, text):
    with pytest.raises(NotReadOnlyError):
        shop(spark, users=USERS, _graphs=["{}"]).query("shop", text)


def test_the_gate_lets_reads_pass(spark):
    e = shop(spark, users=USERS)
    one = lambda q: sorted(tuple(r) for r in e.query("shop", q).collect())
    assert one("SELECT name, 'INSERT INTO users' AS t FROM users WHERE age > 40") == [("bob", "INSERT INTO users")]
    assert one("WITH a AS (SELECT max(age) AS m FROM users) SELECT name FROM users, a WHERE age = m") == [("bob",)]
    assert one("SELECT name, row_number() OVER (ORDER BY age) AS r FROM users WHERE EXISTS (SELECT 1 FROM users) UNION ALL SELECT _id, 9 FROM users LIMIT 3") != []
    assert one("SELECT u.name FROM users u JOIN users v ON u.age < v.age GROUP BY u.name HAVING count(*) = 1") == [("ada",)]


def test_passthrough_errors(spark):
    e = shop(spark, users=USERS)
    for database, text in ((None, "SELECT 1"), ("shop", None), ("shop", "SELEC 1"), ("shop", "SELECT nme FROM users"), ("shop", "SELECT * FROM none")):
        with pytest.raises(InvalidArgumentError):
            e.query(database, text)
    with pytest.raises(NotFoundError):
        e.query("nowhere", "SELECT 1")
    with pytest.raises(UnsupportedError):
        shop(spark, EngineConfig(query_function_enabled=False), users=USERS).query("shop", "SELECT 1")


def test_documents_from_a_passthrough_query(spark):
    e = shop(spark, EngineConfig(schema_sample_size=2), d=['{"a":1,"_key":"x"}', '{"a":2,"_key":"y"}', '{"a":"z","b":4}'])
    out = e.query("shop", "SELECT doc FROM d ORDER BY try_variant_get(doc, '$.b', 'int') NULLS FIRST")
    assert out.columns in (["_key", "a"], ["a", "_key"]) and sorted(str(r["a"]) for r in out.collect()) == ["1", "2", "None"]
    for q in ("SELECT doc FROM d WHERE false", "SELECT parse_json('42') AS x", "SELECT parse_json('{}') AS x", "SELECT parse_json('{\"\":1}') AS x"):
        with pytest.raises(InvalidArgumentError):
            e.query("shop", q)
    late = e.query("shop", "SELECT parse_json(x) AS d FROM VALUES ('{\"a\":1}'), ('{\"a\":2}'), ('42') t(x)")
    with pytest.raises(Exception, match="no object"):
        late.collect()


EDGES = [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d")]


def test_traversal(spark):
    edges = spark.createDataFrame([(f"k{k}", a, b) for k, (a, b) in enumerate(EDGES)], "_key string, _from string, _to string")
    starts = spark.createDataFrame([("a",), (None,)], "v string")
    got = sorted((r["vertex"], r["depth"]) for r in traverse(edges, starts, "v", 1, 5).collect())
    assert got == [("a", 3), ("b", 1), ("c", 2), ("d", 3)]  # no edge twice
    assert sorted(r["vertex"] for r in traverse(edges, starts, "v", 0, 1, "any").collect()) == ["a", "b", "c"]
    assert [r["path"] for r in traverse(edges, starts, "v", 2, 2, "inbound").collect()] == [["a", "c", "b"]]
    assert sorted((r["vertex"], r["depth"]) for r in neighbors(edges, starts, "v", 9).collect()) == [("a", 0), ("b", 1), ("c", 2), ("d", 3)]
    assert [tuple(r) for r in shortest_paths(edges, starts, "v", "d", 5).collect()] == [("a", 3, ["a", "b", "c", "d"])]
    assert [tuple(r) for r in shortest_paths(edges, starts, "v", "a", 5).collect()] == [("a", 0, ["a"])] and shortest_paths(edges, starts, "v", "d", 2).count() == 0
    with pytest.raises(InvalidArgumentError):
        traverse(edges, starts, "v", 2, 1)
    with pytest.raises(InvalidArgumentError):
        traverse(edges, starts, "v", direction="up")


def test_parallel_edges_are_edges_of_their_own(spark):
    ends = [("a", "b"), ("a", "b"), ("b", "a"), ("a|b", "c"), ("a", "b|c")]
    for edges in (spark.createDataFrame(ends, "_from string, _to string"), spark.createDataFrame([(str(k), *e) for k, e in enumerate(ends)], "_key string, _from string, _to string")):
        starts = spark.createDataFrame([("a",)], "v string")
        assert sorted((r["vertex"], r["depth"]) for r in traverse(edges, starts, "v", 2, 3).collect()) == [("a", 2), ("a", 2), ("b", 3), ("b", 3), ("b|c", 3), ("b|c", 3)]
        assert [tuple(r["path"]) for r in traverse(edges, starts, "v", 2, 2, "any").collect() if r["vertex"] == "a"].count(("a", "b", "a")) == 6


def test_named_graphs(spark):
    e = shop(spark, knows=['{"_key":"1","_from":"a","_to":"b"}'], likes=['{"_key":"1","_from":"b","_to":"c"}'], _graphs=['{"_key":"g","edgeDefinitions":[{"collection":"knows"},{"collection":"likes"}]}'])
    e.databases["shop"]["likes"].edge = True
    starts = spark.createDataFrame([("a",)], "v string")
    assert [tuple(r["path"]) for r in traverse(graph_edges(e, "shop", "g"), starts, "v", 2, 2).collect()] == [("a", "b", "c")]
    with pytest.raises(NotFoundError):
        graph_edges(e, "shop", "none")


def test_configuration():
    c = EngineConfig.from_properties({"schema.sample-size": "5", "schema.cache-ttl": "2m", "type-coercion": "strict", "statistics-enabled": "false", "max-splits": "3"})
    assert (c.schema_sample_size, c.schema_cache_ttl, c.strict, c.statistics_enabled, c.max_splits) == (5, 120, True, False, 3)
    for bad in ({"nope": "1"}, {"schema.sample-size": "0"}, {"schema.cache-ttl": "-1s"}, {"schema.cache-ttl": "5"}, {"type-coercion": "x"}, {"statistics-enabled": "maybe"}, {"max-splits": "0"}, {"schema.mixed-type-strategy": "x"}):
        with pytest.raises(InvalidArgumentError):
            EngineConfig.from_properties(bad)


def test_only_the_paths_in_use_are_read(spark, tmp_path):
    docs(spark, *USERS).select(F.parse_json("json").alias("doc")).write.parquet(str(tmp_path / "u"))
    e = Engine(spark).register_path("shop", "users", str(tmp_path / "u"))
    plan = e.table("shop", "users").groupBy("age").count()._jdf.queryExecution().executedPlan().toString()
    assert "struct<doc:struct<0:variant>>" in plan  # one path of the document, not the document
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "a.json").write_text("\n".join([*USERS, "not json"]))
    j = Engine(spark).register_path("shop", "users", str(tmp_path / "j"), format="json")
    assert sorted(str(r["name"]) for r in j.table("shop", "users").collect()) == ["None", "ada", "bob"]


def test_a_stream_of_documents(spark, tmp_path):
    from pyspark.sql import types as T

    from tessera.streaming import typed_stream

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text('{"n":1,"s":"x"}\n{"n":"bad","s":2}\n')
    stream = typed_stream(spark.readStream.text(str(tmp_path / "in")), {"n": T.LongType(), "s": T.StringType()}, json="value")
    q = stream.writeStream.format("memory").queryName("typed").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted(map(str, spark.table("typed").collect())) == ["Row(n=1, s='x')", "Row(n=None, s=None)"]


def test_collections_under_a_root(spark, tmp_path):
    (tmp_path / "shop" / "logs.json").mkdir(parents=True)
    (tmp_path / "shop" / "logs.json" / "a.txt").write_text("\n".join(USERS))
    docs(spark, *USERS).select(F.parse_json("json").alias("doc")).write.parquet(str(tmp_path / "shop" / "users"))
    e = Engine(spark, EngineConfig(root=str(tmp_path))).discover()
    assert e.list_tables() == [("shop", "logs"), ("shop", "users")]
    assert sorted(r["age"] for t in ("logs", "users") for r in e.table("shop", t).collect()) == [36, 36, 41, 41]
    with pytest.raises(InvalidArgumentError):
        Engine(spark).discover()


def test_a_large_collection_is_not_broadcast_for_its_few_columns(spark, tmp_path):
    for name, rows in (("large", 20_000), ("small", 5)):
        spark.range(rows).select(F.to_json(F.struct("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))).alias("json")).select(F.parse_json("json").alias("doc")).coalesce(1).write.parquet(str(tmp_path / name))
    e = Engine(spark).register_path("shop", "large", str(tmp_path / "large")).register_path("shop", "small", str(tmp_path / "small"))
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")
    try:
        large, other, small = (e.table("shop", t).select("id") for t in ("large", "large", "small"))
        for how, table, shown in (("right", other, "SortMergeJoin"), ("inner", other, "SortMergeJoin"), ("inner", small, "BuildRight"), ("left", small, "BuildRight")):
            out = large.join(table, "id", how)
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert shown in plan and ("Broadcast" in plan) == (shown == "BuildRight"), (how, plan)
            assert out.count() == (5 if (how, table) == ("inner", small) else 20_000)
        assert "BroadcastHashJoin" in small.join(F.broadcast(large), "id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
