"""Rows as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_KEPT = (T.NumericType, T.BooleanType, T.ArrayType, T.MapType, T.StructType)


def to_json_rows(rows: DataFrame, kind: str = "chunk", out: str = "json") -> DataFrame:
    """One JSON text per row.

    ``doc`` writes every value as a string; ``chunk`` keeps numbers, booleans,
    lists and maps as they are.
    """
    if kind not in ("doc", "chunk"):
        raise ValueError(f"kind must be 'doc' or 'chunk', not {kind!r}")
    fields = [
        F.col(f.name) if kind == "chunk" and isinstance(f.dataType, _KEPT)
        else F.col(f.name).cast("string").alias(f.name)
        for f in rows.schema.fields
    ]
    return rows.select(F.to_json(F.struct(*fields)).alias(out))
