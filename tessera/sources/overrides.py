"""Override documents: a table's complete, user-written schema.

{"table": name, "fields": [{"name": ..., "type": ..., "hidden": true|false}, ...]}

What a document may hold is stated as data (the two shapes below); one pass checks any value against its shape.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import types as T

from ..errors import SchemaError
from ..functions.types import parse_declared


@dataclass(frozen=True)
class DeclaredField:
    name: str
    type: T.DataType
    hidden: bool = False


@dataclass(frozen=True)
class _Key:
    """What a key's value must be, in words and as a test; whether it must be there."""

    words: str
    test: Callable[[object], bool] = lambda _: True
    needed: bool = False


# The keys of an override document and of one of its fields.
_DOCUMENT = {
    "table": _Key("anything"),
    "fields": _Key("a list that is not empty", lambda x: isinstance(x, list) and bool(x), True),
    "_key": _Key("anything"),
    "_id": _Key("anything"),
    "_rev": _Key("anything"),
}
_FIELD = {
    "name": _Key("text that is not empty and begins with no underscore", lambda x: isinstance(x, str) and x[:1] not in ("", "_"), True),
    "type": _Key("text", lambda x: isinstance(x, str), True),
    "hidden": _Key("true or false", lambda x: isinstance(x, bool)),
}


def _faults(value: object, shape: dict[str, _Key], where: str) -> list[str]:
    """Everything in which a value departs from its shape."""
    if not isinstance(value, dict):
        return [f"{where} must be an object"]
    strange = [f"unknown key {k!r} in {where}" for k in sorted(value.keys() - shape.keys())]
    return strange + [f"{k} of {where} must be {rule.words}" for k, rule in shape.items() if (k in value or rule.needed) and not rule.test(value.get(k))]


def read_override(documents: list[dict], table: str) -> list[DeclaredField] | None:
    """documents: all override documents of a table. None if there are none; SchemaError, with all that is wrong, if what there is is
    not valid."""
    if not documents:
        return None
    faults = ["there is more than one"] if len(documents) > 1 else _faults(documents[0], _DOCUMENT, "the document")
    fields = [] if faults else documents[0]["fields"]
    for k, f in enumerate(fields):
        faults += _faults(f, _FIELD, f"field {k}")
    if not faults:
        faults = [f"the name {n!r} repeats" for n, times in Counter(f["name"].lower() for f in fields).items() if times > 1]
    if faults:
        raise SchemaError(f"override document of {table}: {'; '.join(faults)}")
    return [DeclaredField(f["name"], parse_declared(f["type"]), f.get("hidden", False)) for f in fields]
