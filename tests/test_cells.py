import datetime as dt
import math
import time
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import materialize, mismatch, with_offset


def cells(spark, t, texts):
    df = spark.createDataFrame([(k, x) for k, x in enumerate(texts)], "k int, j string").select("k", F.parse_json("j").alias("v"))
    return [(r["x"], r["m"]) for r in df.select("k", materialize(F.col("v"), t).alias("x"), mismatch(F.col("v"), t, "c").alias("m")).orderBy("k").collect()]


def check(spark, t, good: dict, bad: list):
    got = cells(spark, t, [*good, *bad])
    assert [x for x, _ in got[: len(good)]] == list(good.values())
    assert all(m is None for _, m in got[: len(good)])
    assert all(x is None and m.startswith("c: ") for x, m in got[len(good) :]), got[len(good) :]


def test_bigint(spark):
    good = {x: int(float(x)) if "." in x or "e" in x else int(x) for x in ("42", "0", "9007199254740993", "-9007199254740993", "9223372036854775807", "-9223372036854775808", "42.0", "-0.0", "1e3", "-0.0e0")}
    check(spark, T.LongType(), good | {"null": None}, ["42.5", "-0.5", "1e19", "-1e19", '"x"', '"42"', "true", "9223372036854775808", "18446744073709551615", "[1]", "{}", "9223372036854775808.0e0"])


def test_boolean_double_and_text(spark):
    check(spark, T.BooleanType(), {"true": True, "false": False, "null": None}, ["1", '"true"', "[]"])
    check(spark, T.DoubleType(), {"1": 1.0, "1.5": 1.5, "1e300": 1e300, "9007199254740993": 9007199254740992.0, "18446744073709551615": 1.8446744073709552e19, "null": None}, ["true", '"1"', "[]"])
    check(spark, T.StringType(), {'"a"': "a", '""': "", "null": None}, ["1", "1.5", "true", "[]", "{}"])


def test_declared_decimal(spark):
    good = {'"12.34"': "12.34", '"1E+2"': "100", '"+12.34"': "12.34", "0.25": "0.25", "42.0": "42", "42": "42", '"-0.10"': "-0.1", '"12.3400"': "12.34", "-0.75": "-0.75", "9999999999": "9999999999", '"0e99999"': "0"}
    bad = ['" 12.34"', '"12.34 "', '"abc"', '""', '"."', '"e5"', "12.34", "123456789012", "true", '"1E+900000000"', '"1E-900000000"', '"12.345"', "10000000000", "[]", '"1e99999999999999999999"']
    check(spark, T.DecimalType(12, 2), {k: Decimal(v) for k, v in good.items()}, bad)


def test_big_decimal(spark):
    good = {"42": "42", "42.0": "42", '"42"': "42", "1e19": "10000000000000000000", "18446744073709551615": "18446744073709551615", "1e23": "99999999999999991611392", "-1e22": "-1e22", "9" * 38: "9" * 38}
    check(spark, T.DecimalType(38, 0), {k: Decimal(v) for k, v in good.items()}, ["42.5", "1" + "0" * 39, "1e39", '"1e38"', "9" * 41])


def test_a_huge_exponent_is_cheap(spark):
    cells(spark, T.DecimalType(38, 0), ["1"])
    begin = time.monotonic()
    assert cells(spark, T.DecimalType(38, 0), ['"1E+900000000"'])[0][0] is None
    assert time.monotonic() - begin < 5


@settings(max_examples=6, deadline=None)
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=20, max_size=60), st.integers(0, 12))
def test_doubles_as_decimals_are_exact(spark, values, scale):
    values = [*values, *[float(round(v * 2**scale)) / 2**scale for v in values if abs(v) < 1e25]]
    t = T.DecimalType(38, scale)
    texts = [repr(v) if "e" in repr(v) else repr(v) + "e0" for v in values]
    for v, (got, _) in zip(values, cells(spark, t, texts), strict=True):
        exact = Decimal(v)
        fits = -exact.normalize().as_tuple().exponent <= scale and abs(exact) < Decimal(10) ** (38 - scale)
        assert got == (exact if fits else None), (v, scale)


@pytest.mark.parametrize("scale", [0, 2])
def test_doubles_at_powers_of_ten(spark, scale):
    """The double nearest to a power of ten lies below it, on it or above it."""
    for k in range(20, 39 - scale):
        t, around = T.DecimalType(k + scale, scale), []
        for v in (10.0**k, math.nextafter(10.0**k, 0), math.nextafter(10.0**k, math.inf)):
            around += [v, -v]
        for v, (got, _) in zip(around, cells(spark, t, [repr(v) if "e" in repr(v) else repr(v) + "e0" for v in around]), strict=True):
            assert got == (Decimal(v) if abs(Decimal(v)) < Decimal(10) ** k else None), (v, k)


def test_timestamps(spark):
    at = dt.datetime
    local = {'"2026-08-05T12:34:56.789"': at(2026, 8, 5, 12, 34, 56, 789000), '"2026-08-05t12:34"': at(2026, 8, 5, 12, 34), '"2026-08-05T12:34:56.7000"': at(2026, 8, 5, 12, 34, 56, 700000)}
    check(spark, T.TimestampNTZType(), local, ['"2026-08-05T12:34:56.7891"', '"2026-08-05T12:34:56Z"', '"2026-08-05 12:34"', "5", '"2026-02-30T00:00"', '"2026-08-05"', '"x2026-08-05T12:34"', '"2026-08-05T25:00"'])
    zoned = {'"2026-08-05T12:34:56.789+05:30"': at(2026, 8, 5, 7, 4, 56, 789000), '"2026-08-05T12:34Z"': at(2026, 8, 5, 12, 34), '"2026-08-05T00:00:00-14:00"': at(2026, 8, 5, 14)}
    df = spark.createDataFrame([(k, j) for k, j in enumerate(zoned)], "k int, j string").select("k", F.parse_json("j").alias("v"))
    rows = df.select(F.unix_millis(materialize(F.col("v"), T.TimestampType())).alias("x"), with_offset(F.col("v")).alias("o")).orderBy("k").collect()
    assert [r["x"] for r in rows] == [int(v.replace(tzinfo=dt.timezone.utc).timestamp() * 1000) for v in zoned.values()]
    assert [r["o"] for r in rows] == [330, 0, -840]
    check(spark, T.TimestampType(), {"null": None}, ['"2026-08-05T12:34:56"', '"2026-08-05T12:34:56+14:01"', '"2026-08-05T12:34:56+05:30:15"', "1"])


def test_arrays_and_rows_fail_at_their_leaves(spark):
    got = cells(spark, T.ArrayType(T.LongType()), ['[1,"x",2]', "[]", "{}", "[null]", "5"])
    assert [x for x, _ in got] == [[1, None, 2], [], None, [None], None]
    assert [m for _, m in got] == ["c[1]: x", None, "c: {}", None, "c: 5"]
    t = T.StructType([T.StructField("a", T.LongType()), T.StructField("b.c", T.ArrayType(T.StructType([T.StructField("d'", T.StringType())])))])
    got = cells(spark, t, ['{"a":1,"b.c":[{"d\'":"x"},{"d\'":5},7],"z":0}', "{}", "[1]", '{"a":"q"}'])
    assert got[0][0] == (1, [("x",), (None,), None]) and got[0][1] == "c.b.c[1].d': 5"
    assert got[1] == ((None, None), None) and got[2][0] is None and got[3] == ((None, None), "c.a: q")


def test_long_values_are_cut_in_messages(spark):
    assert len(cells(spark, T.LongType(), ['"' + "x" * 500 + '"'])[0][1]) == len("c: ") + 100


@pytest.mark.parametrize("t", [T.DateType(), T.MapType(T.StringType(), T.LongType())])
def test_other_types_are_refused(spark, t):
    with pytest.raises(TypeError):
        materialize(F.lit(None).cast("variant"), t)


def test_plain_numbers_and_booleans_make_no_cast_of_a_variant(spark):
    df = spark.sql("SELECT parse_json(j) AS v FROM VALUES ('9223372036854775807'), ('-9223372036854775808'), ('9223372036854775808'), ('true'), ('false'), ('\"1\"'), ('\"true\"'), ('null'), ('1.0'), ('1e0'), ('1.5'), ('[1]') t(j)")
    out = df.select(materialize(F.col("v"), T.LongType()).alias("n"), materialize(F.col("v"), T.BooleanType()).alias("b"))
    none = [None]
    assert [r["n"] for r in out.collect()] == [2**63 - 1, -(2**63)] + none * 6 + [1, 1] + none * 2
    assert [r["b"] for r in out.collect()] == none * 3 + [True, False] + none * 7
    plan = out.select("b")._jdf.queryExecution().optimizedPlan().toString()
    assert "BooleanType" not in plan
