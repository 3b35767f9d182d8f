"""Materialization over a stream: it is a stateless projection, so the batch expressions serve unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import cells as mat


def typed_stream(stream: DataFrame, fields: dict[str, T.DataType], json: str | None = None) -> DataFrame:
    """stream: documents in a VARIANT column `doc`, or as JSON text in the column named. fields: the schema, which a stream cannot
    sample."""
    docs = stream if json is None else stream.withColumn("doc", F.try_parse_json(json))
    return docs.select(*[mat.materialize(mat.field(F.col("doc"), k), t).alias(k) for k, t in fields.items()])
