"""The type lattice of sampled values, and the grammar of declared types.

NullType is the bottom of the lattice and means that no value has told a type yet.
"""

from __future__ import annotations

from pyspark.sql import types as T

from ..errors import SchemaError

UNKNOWN = T.NullType()
BIG = T.DecimalType(38, 0)
_NUMBERS = (T.LongType(), T.DoubleType(), BIG)


def merge(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that both have; STRING where they have nothing in common."""
    if a == UNKNOWN:
        return b
    if b == UNKNOWN or a == b:
        return a
    if a in _NUMBERS and b in _NUMBERS:
        return T.DoubleType() if T.DoubleType() in (a, b) else BIG
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(merge(a.elementType, b.elementType))
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        found = {f.name: f.dataType for f in a}
        for f in b:
            found[f.name] = merge(found[f.name], f.dataType) if f.name in found else f.dataType
        return T.StructType([T.StructField(k, v) for k, v in found.items()])
    return T.StringType()


def settle(t: T.DataType) -> T.DataType:
    """What stayed unknown becomes STRING, at any depth. An object that never had a field is STRING too (and so reads
    NULL), because a row without fields cannot be stored."""
    if isinstance(t, T.ArrayType):
        return T.ArrayType(settle(t.elementType))
    if isinstance(t, T.StructType) and len(t):
        return T.StructType([T.StructField(f.name, settle(f.dataType)) for f in t])
    return T.StringType() if t == UNKNOWN or isinstance(t, T.StructType) else t


_SIMPLE = {"boolean": T.BooleanType(), "bigint": T.LongType(), "double": T.DoubleType(), "varchar": T.StringType()}


class _Reader:
    """Recursive descent over one declaration."""

    def __init__(self, text: str):
        self.text, self.at = text, 0

    def fail(self, why: str):
        raise SchemaError(f"type {self.text!r}: {why}")

    def space(self) -> None:
        while self.at < len(self.text) and self.text[self.at].isspace():
            self.at += 1

    def take(self, symbol: str) -> bool:
        self.space()
        if self.text.startswith(symbol, self.at):
            self.at += len(symbol)
            return True
        return False

    def need(self, symbol: str) -> None:
        if not self.take(symbol):
            self.fail(f"{symbol!r} expected at {self.at}")

    def word(self) -> str:
        self.space()
        begin = self.at
        while self.at < len(self.text) and (self.text[self.at].isalnum() or self.text[self.at] == "_"):
            self.at += 1
        return self.text[begin : self.at].lower()

    def number(self) -> int:
        w = self.word()
        return int(w) if w.isdecimal() and w.isascii() else self.fail("a number is expected")

    def name(self) -> str:
        """A field's name: quoted ones keep their case, others are lower-cased."""
        if not self.take('"'):
            return self.word() or self.fail("a field needs a name")
        out = ""
        while True:
            if self.at >= len(self.text):
                self.fail("a quote is open")
            c = self.text[self.at]
            self.at += 1
            if c == '"':
                if self.text[self.at : self.at + 1] != '"':
                    return out or self.fail("a field needs a name")
                self.at += 1
            out += c

    def type(self) -> T.DataType:
        kind = self.word()
        if kind in _SIMPLE:
            if self.take("("):
                self.fail("bounded types are not supported")
            return _SIMPLE[kind]
        if kind == "decimal":
            p, s = 38, 0
            if self.take("("):
                p = self.number()
                s = self.number() if self.take(",") else 0
                self.need(")")
            if not 1 <= p <= 38 or not 0 <= s <= p:
                self.fail("precision and scale are out of range")
            return T.DecimalType(p, s)
        if kind == "timestamp":
            if self.take("("):
                if self.number() != 3:
                    self.fail("only timestamp(3) is supported")
                self.need(")")
            return self._zone()
        if kind == "array":
            self.need("(")
            of = self.type()
            self.need(")")
            return T.ArrayType(of)
        if kind == "row":
            self.need("(")
            fields = []
            while True:
                name = self.name()
                fields.append(T.StructField(name, self.type()))
                if not self.take(","):
                    break
            self.need(")")
            if len({f.name.lower() for f in fields}) < len(fields):
                self.fail("field names repeat")
            return T.StructType(fields)
        self.fail("not a supported type")

    def _zone(self) -> T.DataType:
        begin = self.at
        first = self.word()
        if first in ("with", "without"):
            if self.word() == "time" and self.word() == "zone":
                return T.TimestampType() if first == "with" else T.TimestampNTZType()
            self.fail("'time zone' is expected")
        self.at = begin
        return T.TimestampNTZType()


def parse_declared(text: str) -> T.DataType:
    """boolean, bigint, double, varchar, decimal[(p[,s])], timestamp[(3)] [with|without time zone], array(t),
    row(name t, ...); anything else is a SchemaError."""
    reader = _Reader(text)
    found = reader.type()
    reader.space()
    if reader.at < len(text):
        reader.fail(f"unexpected text at {reader.at}")
    return found
