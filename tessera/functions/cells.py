"""VARIANT values as typed columns: the one place that says which stored values a type accepts.

Everything is a Catalyst expression over the document, so filters, aggregates and joins on a materialized column see exactly what
a select would show, wherever the optimizer moves them. Recursion is over the schema. A value that does not fit is
NULL at its own leaf; in strict mode it is an error that names that leaf.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LOCAL = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[Tt][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,3}0{0,6})?)?"
_OFFSET = r"([Zz]|[+-](0[0-9]|1[0-3]):[0-5][0-9](:00)?|[+-]14:00(:00)?)$"
_DECIMAL = r"^([+-]?)([0-9]*)\.?([0-9]*)(?:[eE]([+-]?[0-9]+))?$"


def field(x: Column, name: str) -> Column:
    """A member of an object; absent members and all members of other values are NULL."""
    if "'" in name or "\\" in name or not name:
        return F.try_element_at(F.try_variant_get(x, "$", "map<string,variant>"), F.lit(name))
    return F.try_variant_get(x, f"$['{name}']", "variant")


def _kind(x: Column) -> Column:
    return F.schema_of_variant(x)


def _is_number(kind: Column) -> Column:
    return kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL(")


def _is_integer(kind: Column) -> Column:
    return (kind == "BIGINT") | (kind.startswith("DECIMAL(") & kind.endswith(",0)"))


def _get(x: Column, t: str) -> Column:
    """Spark makes an expression for each value that it casts so; the text of a number or a boolean is cheaper to have."""
    return F.try_variant_get(x, "$", t)


def _let(value: Column, body) -> Column:
    """body(value) with value computed once. Keeps large expressions small: uses of a Column repeat its whole tree."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _placed(sign: Column, digits: Column, t: T.DecimalType) -> Column:
    """A decimal from its sign and unscaled digits, which must fit."""
    padded = F.lpad(digits, F.greatest(F.length(digits), F.lit(t.scale + 1)), F.lit("0"))

    def put(d: Column) -> Column:
        whole = F.substring(d, F.lit(1), F.length(d) - t.scale)
        text = F.concat(sign, whole, F.lit("."), F.substring(d, F.length(d) - t.scale + 1, F.lit(t.scale))) if t.scale else F.concat(sign, whole)
        return text.try_cast(t)

    return _let(padded, put)


def _whole(d: Column) -> Column:
    """The exact decimal(38,0) of an integral, nonnegative double below 1e38: split at powers of two, which is exact."""

    def low(parts: Column) -> Column:
        mid = F.floor(parts.rest / 2.0**32)
        last = (parts.rest - mid.cast("double") * 2.0**32).cast("bigint")
        big = F.try_multiply(parts.high.cast("decimal(19,0)"), F.lit("18446744073709551616").cast("decimal(20,0)"))
        small = F.try_add(F.try_multiply(mid.cast("decimal(19,0)"), F.lit("4294967296").cast("decimal(10,0)")).cast("decimal(38,0)"), last.cast("decimal(38,0)"))
        return F.try_add(big.cast("decimal(38,0)"), small)

    high = F.floor(d / 2.0**64)
    return _let(F.struct(high.alias("high"), (d - high.cast("double") * 2.0**64).alias("rest")), low)


def _below(x: Column, digits: int) -> Column:
    """x < 10**digits, exactly: the double nearest to that power may lie on either side of it."""
    near = 10.0**digits
    return x < near if int(near) >= 10**digits else x <= near


def _decimal_of_double(d: Column, t: T.DecimalType) -> Column:
    """Only if the double's exact binary value has the type's scale and precision. A double m / 2**k in lowest terms
    needs k decimal places, so scale s fits exactly where d * 2**s is integral, and that product is exact."""

    def place(p: Column) -> Column:
        fits = (p.scaled == F.rint(p.scaled)) & _below(p.size, t.precision - t.scale) & _below(p.scaled, 38)
        unscaled = F.try_multiply(_whole(p.scaled), F.lit(str(5**t.scale)).cast("decimal(38,0)")).cast("decimal(38,0)").cast("string")
        return F.when(fits, _let(unscaled, lambda u: F.when(F.length(u) <= t.precision, _placed(p.sign, u, t))))

    return _let(F.struct(F.abs(d).alias("size"), (F.abs(d) * 2.0**t.scale).alias("scaled"), F.when(d < 0, "-").otherwise("").alias("sign")), place)


def _decimal_of_string(s: Column, t: T.DecimalType) -> Column:
    """Only plain or scientific numbers without blanks that fit exactly; judged by digit counts, so that a huge exponent
    costs nothing."""

    def split(s: Column) -> Column:
        part = [F.regexp_extract(s, _DECIMAL, k) for k in range(5)]
        exponent = F.when(part[4] == "", F.lit(0)).otherwise(part[4].try_cast("int")).cast("bigint")
        return F.struct(F.when(part[1] == "-", "-").otherwise("").alias("sign"), F.concat(part[2], part[3]).alias("all"), (F.length(part[3]) - exponent).alias("places"))

    def bare(p: Column) -> Column:
        digits = F.regexp_replace(p["all"], "^0+", "")
        kept = F.regexp_replace(digits, "0+$", "")
        return F.struct(p.sign.alias("sign"), kept.alias("digits"), (p.places - F.length(digits) + F.length(kept)).alias("places"), (F.length(p["all"]) > 0).alias("number"))

    def place(p: Column) -> Column:
        fits = (p.places <= t.scale) & (F.length(p.digits) - p.places <= t.precision - t.scale)
        full = F.concat(p.digits, F.repeat(F.lit("0"), F.least(F.lit(t.precision), t.scale - p.places).cast("int")))
        return F.when(p.number, F.when(p.digits == "", F.lit(0).cast(t)).when(fits, _placed(p.sign, full, t)))

    return F.when(s.rlike(_DECIMAL), _let(_let(_let(s, split), bare), place))


def _decimal(x: Column, t: T.DecimalType) -> Column:
    return _let(
        x,
        lambda v: F.when(_is_integer(_kind(v)), _get(v, "decimal(38,0)").try_cast(t))
        .when(_is_number(_kind(v)), _decimal_of_double(_get(v, "double"), t))
        .when(_kind(v) == "STRING", _decimal_of_string(_get(v, "string"), t)),
    )


def _bigint(x: Column) -> Column:
    kind, d = _kind(x), _get(x, "double")
    inside = (d == F.rint(d)) & (d >= -(2.0**63)) & (d < 2.0**63)
    return F.when(kind == "BIGINT", F.to_json(x).try_cast("bigint")).when(_is_integer(kind), _get(x, "bigint")).when(kind.isin("DOUBLE", "FLOAT"), F.when(inside, d.try_cast("bigint")))


def _time(x: Column, t: T.DataType) -> Column:
    s = _get(x, "string")
    zoned = isinstance(t, T.TimestampType)
    plain = F.regexp_replace(F.translate(s, "tz", "TZ"), r"(\.[0-9]{1,3})0*", "$1")
    plain = F.regexp_replace(plain, r"(T[0-9]{2}:[0-9]{2})([Z+-]|$)", "$1:00$2")
    if zoned:
        plain = F.regexp_replace(plain, r"([+-][0-9]{2}:[0-9]{2}):00$", "$1")
    return F.when((_kind(x) == "STRING") & s.rlike(_LOCAL + (_OFFSET if zoned else "$")), plain.try_cast(t))


def materialize(x: Column, t: T.DataType) -> Column:
    """The typed column of a VARIANT column; NULL where a value, or a part of it, does not fit."""
    if isinstance(t, T.BooleanType):
        return F.when(_kind(x) == "BOOLEAN", F.to_json(x) == "true")
    if isinstance(t, T.LongType):
        return _bigint(x)
    if isinstance(t, T.DoubleType):
        return F.when(_is_number(_kind(x)), _get(x, "double"))
    if isinstance(t, T.StringType):
        return F.when(_kind(x) == "STRING", _get(x, "string"))
    if isinstance(t, T.DecimalType):
        return _decimal(x, t)
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        return _time(x, t)
    if isinstance(t, T.ArrayType):
        return F.when(_kind(x).startswith("ARRAY<"), F.transform(_get(x, "array<variant>"), lambda e: materialize(e, t.elementType)))
    if isinstance(t, T.StructType):
        return F.when(_kind(x).startswith("OBJECT<"), F.struct(*[materialize(field(x, f.name), f.dataType).alias(f.name) for f in t]))
    raise TypeError(f"no stored value has the type {t.simpleString()}")


def mismatch(x: Column, t: T.DataType, path: str) -> Column:
    """For strict mode: "path: value" of the first part of x that does not fit, with at most 100 characters of the
    value; NULL where all fit. Null and absent values always fit."""
    there = x.isNotNull() & (_kind(x) != "VOID")
    here = F.concat(F.lit(f"{path}: "), F.substring(F.coalesce(_get(x, "string"), F.to_json(x)), 1, 100))
    if isinstance(t, T.ArrayType):
        parts = F.transform(_get(x, "array<variant>"), lambda e, k: F.concat(F.lit("["), k.cast("string"), F.lit("]"), mismatch(e, t.elementType, "")))
        inside = F.concat(F.lit(path), F.get(F.filter(parts, lambda p: p.isNotNull()), F.lit(0)))
        return F.when(there, F.when(_kind(x).startswith("ARRAY<"), inside).otherwise(here))
    if isinstance(t, T.StructType):
        inside = F.coalesce(*[mismatch(field(x, f.name), f.dataType, f"{path}.{f.name}") for f in t], F.lit(None).cast("string"))
        return F.when(there, F.when(_kind(x).startswith("OBJECT<"), inside).otherwise(here))
    return F.when(there & materialize(x, t).isNull(), here)


def strict(x: Column, t: T.DataType, path: str) -> Column:
    """As materialize(), but a value that does not fit is an error. The test counts as one that may give another answer next time,
    so that no filter is moved past it; a column that a query does not read is dropped with its test."""
    bad = mismatch(x, t, path)
    said = F.raise_error(F.concat(F.lit("[TYPE_CONVERSION_ERROR] value does not fit "), bad)).cast(t)
    return F.when(bad.isNotNull() & (F.monotonically_increasing_id() >= 0), said).otherwise(materialize(x, t))


def with_offset(x: Column) -> Column:
    """Minutes east of UTC that a timestamp with time zone was written with; a TimestampType keeps the instant only."""
    s = _get(x, "string")
    sign = F.when(F.regexp_extract(s, r"[0-9]([+-])[0-9]{2}:[0-9:]+$", 1) == "-", -1).otherwise(1)
    hours, minutes = (F.regexp_extract(s, r"[0-9][+-]([0-9]{2}):([0-9]{2})(:00)?$", k) for k in (1, 2))
    given = F.when(hours == "", F.lit(0)).otherwise(sign * (hours.try_cast("int") * 60 + minutes.try_cast("int")))
    return F.when(materialize(x, T.TimestampType()).isNotNull(), given)
