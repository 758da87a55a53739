"""Deterministic keys: sha256 over the text of columns.

Values are joined with a double bar and null counts as empty text. That joiner
is part of the key's definition (a double bar inside the data is not escaped),
so keys stay comparable between releases.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: what stands between two hashed values.
JOINER = "||"


def _joined_sha256(values: Sequence[Column]) -> Column:
    filled = [F.coalesce(value, F.lit("")) for value in values]
    return F.sha2(F.concat_ws(JOINER, *filled), 256)


def record_hash(columns: Sequence[str]) -> Column:
    """Hash of a record's source columns."""
    return _joined_sha256([F.col(name).cast("string") for name in columns])


def entity_key(identity: Sequence[str], fallback: str = "_record_hash") -> Column:
    """Hash of the identity columns; of the record hash when there are none."""
    if not identity:
        return F.sha2(F.col(fallback), 256)
    return _joined_sha256([F.lower(F.trim(F.col(name).cast("string"))) for name in identity])


def feature_key(entity: str, record: str | None = "_record_hash") -> Column:
    """Hash of entity key and record hash, or of the entity key alone."""
    parts = [entity] if record is None else [entity, record]
    return F.sha2(F.concat_ws(JOINER, *[F.col(part) for part in parts]), 256)


def _canonical(value: Column, kind: T.DataType) -> Column:
    """A value as text that only equal values share; null stays null."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return (value + F.lit(0.0)).cast("string")  # -0.0 equals 0.0
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value).cast("string")
    if isinstance(kind, T.BinaryType):
        return F.hex(value)
    if isinstance(kind, T.StructType):
        parts = [_framed(value.getField(f.name), f.dataType) for f in kind.fields]
        return F.when(value.isNotNull(), F.concat(F.lit(""), *parts))
    if isinstance(kind, T.ArrayType):
        return F.array_join(F.transform(value, lambda x: _framed(x, kind.elementType)), "")
    if isinstance(kind, T.MapType):
        entry = T.StructType().add("key", kind.keyType).add("value", kind.valueType)
        entries = F.transform(F.map_entries(value), lambda e: _framed(e, entry))
        return F.array_join(F.array_sort(entries), "")
    if isinstance(kind, T.VariantType):
        return F.to_json(value)
    return value.cast("string")


def _framed(value: Column, kind: T.DataType) -> Column:
    """The text behind its length, so that neighbours never run together; a mark for null."""
    text = _canonical(value, kind)
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_digest(df: DataFrame) -> Column:
    """32 bytes that tell whole rows apart: null and empty text differ, -0.0 equals 0.0.

    Each value is hashed by its type at full precision, inside of structs, arrays and maps too.
    Instants are hashed as microseconds, so the session's time zone does not matter.
    """
    row = F.concat(F.lit(""), *[_framed(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields])
    return F.unhex(F.sha2(row, 256))
