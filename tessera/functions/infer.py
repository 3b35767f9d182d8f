"""Types of JSON values, and the schema of a sample of documents. Runs on the driver over a bounded sample."""

from __future__ import annotations

import json
from collections.abc import Iterable
from decimal import Decimal

from pyspark.sql import types as T

from .types import BIG, UNKNOWN, merge

#: Below this size the store keeps an integral number as an integer, however it was written.
_EXACT = 2**53


def infer_value(value) -> T.DataType:
    """value: as decode() gives it. Strings are never looked into for dates or numbers."""
    if value is None:
        return UNKNOWN
    if isinstance(value, bool):
        return T.BooleanType()
    if isinstance(value, int):
        return T.LongType() if -(2**63) <= value < 2**63 else BIG
    if isinstance(value, (Decimal, float)):
        return T.LongType() if abs(value) < _EXACT and value == int(value) else T.DoubleType()
    if isinstance(value, list):
        if not value:
            return T.ArrayType(T.StringType())
        of = UNKNOWN
        for x in value:
            of = merge(of, infer_value(x))
        return T.ArrayType(of)
    if isinstance(value, dict):
        return T.StructType([T.StructField(k, infer_value(v)) for k, v in value.items()])
    return T.StringType()


def _number(text: str):
    d = Decimal(text)
    return d if d.adjusted() < 400 else float("inf")


def decode(text: str):
    """JSON text with numbers kept exactly."""
    return json.loads(text, parse_float=_number, parse_constant=lambda _: float("nan"))


def schema_of_documents(documents: Iterable[dict], skip: Iterable[str] = ()) -> dict[str, T.DataType]:
    """Field -> type in first-seen order. Types may still hold UNKNOWN; see settle()."""
    out, skip = {}, set(skip)
    for d in documents:
        for k, v in d.items():
            if k not in skip:
                out[k] = merge(out.get(k, UNKNOWN), infer_value(v))
    return out
