import pytest
from pyspark.sql import types as T

from tessera.errors import SchemaError
from tessera.functions import UNKNOWN, infer_value, merge, parse_declared, schema_of_documents, settle
from tessera.functions.infer import decode

B, D, S, L, BIG = T.BooleanType(), T.DoubleType(), T.StringType(), T.LongType(), T.DecimalType(38, 0)


def row(**fields):
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


@pytest.mark.parametrize("text, kind", [
    ("null", UNKNOWN), ("true", B), ("42", L), ("42.0", L), ("-0.0", L), ("42.5", D), ("9223372036854775807", L), ("9223372036854775808", BIG), ("18446744073709551615", BIG),
    ("9007199254740992.0", D), ("1e19", D), ("1e400", D), ('"2026-01-01T00:00:00"', S), ("[]", T.ArrayType(S)), ("[1, 2.5]", T.ArrayType(D)), ('[1, "x"]', T.ArrayType(S)), ("[null]", T.ArrayType(UNKNOWN)),
    ('{"b": 1, "a": null}', row(b=L, a=UNKNOWN)), ('[{"a": 1}, {"b": true}]', T.ArrayType(row(a=L, b=B))),
])
def test_inference(text, kind):
    assert infer_value(decode(text)) == kind


@pytest.mark.parametrize("a, b, both", [
    (UNKNOWN, L, L), (L, L, L), (L, D, D), (BIG, D, D), (L, BIG, BIG), (L, S, S), (B, L, S), (T.DecimalType(12, 2), D, S),
    (T.ArrayType(L), T.ArrayType(D), T.ArrayType(D)), (T.ArrayType(S), T.ArrayType(L), T.ArrayType(S)), (T.ArrayType(L), L, S), (row(a=L, b=S), row(c=B, a=D), row(a=D, b=S, c=B)), (row(a=L), T.ArrayType(L), S),
])
def test_merge(a, b, both):
    assert merge(a, b) == both
    if not isinstance(both, T.StructType):
        assert merge(b, a) == both


def test_an_empty_list_makes_its_elements_text():
    got = schema_of_documents([decode('{"x": [], "y": null}'), decode('{"x": [1], "z": {"q": null}, "_key": 1}')], ["_key"])
    assert got == {"x": T.ArrayType(S), "y": UNKNOWN, "z": row(q=UNKNOWN)}
    assert {k: settle(t) for k, t in got.items()} == {"x": T.ArrayType(S), "y": S, "z": row(q=S)}
    assert settle(T.StructType([])) == S


@pytest.mark.parametrize("text, kind", [
    ("boolean", B), ("BIGINT", L), (" double ", D), ("varchar", S), ("decimal", BIG), ("decimal(12)", T.DecimalType(12, 0)), ("decimal(12, 2)", T.DecimalType(12, 2)),
    ("timestamp", T.TimestampNTZType()), ("timestamp(3)", T.TimestampNTZType()), ("timestamp(3) without time zone", T.TimestampNTZType()), ("timestamp(3) with time zone", T.TimestampType()),
    ("array(array(bigint))", T.ArrayType(T.ArrayType(L))), ('row(A bigint, "B c" varchar, d row(e double))', T.StructType([T.StructField("a", L), T.StructField("B c", S), T.StructField("d", row(e=D))])),
])
def test_declared(text, kind):
    assert parse_declared(text) == kind


@pytest.mark.parametrize("text", ["", "integer", "smallint", "tinyint", "real", "date", "time", "json", "uuid", "varbinary", "char(3)", "varchar(10)", "map(varchar, bigint)", "interval", "timestamp(6)", "timestamp(0)", "timestamp(3) with", "decimal(39, 0)", "decimal(5, 6)", "decimal(0)", "array(date)", "array(bigint", "row()", "row(bigint)", "row(a bigint, A double)", "bigint bigint", "not_a_type", 'row("" bigint)', 'row("a bigint)'])
def test_not_declared(text):
    with pytest.raises(SchemaError):
        parse_declared(text)
